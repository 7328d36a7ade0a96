"""Raw CRM / billing / product / support inputs.

Raw tables are read with explicit schemas, never ``inferSchema``: every
column arrives as text and the staging layer casts it, so a malformed value
fails the ANSI cast loudly instead of silently changing a column's type.

Quoted CSV fields may hold commas, doubled quotes and line breaks. A record that does not have the
table's columns ends up whole in ``BAD_RECORD``; it is left out of the relation, and ``READABLE_CHECKS`` count
such records, so one bad line neither ends a build nor passes unseen.
"""

from __future__ import annotations

import os

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from acctlens.operators.quality import Check


def _text_schema(*names: str) -> T.StructType:
    return T.StructType([T.StructField(n, T.StringType(), True) for n in names])


RAW_ACCOUNTS = _text_schema(
    "account_id", "company_name", "industry", "employee_count", "plan_tier",
    "account_owner", "region", "signup_date", "status",
)
RAW_SUBSCRIPTIONS = _text_schema(
    "subscription_id", "account_id", "product_name", "plan_tier", "mrr_amount",
    "start_date", "end_date", "status",
)
RAW_INVOICES = _text_schema(
    "invoice_id", "account_id", "invoice_date", "amount", "currency", "status", "line_items",
)
RAW_USAGE_EVENTS = _text_schema(
    "event_id", "account_id", "user_id", "event_name", "event_timestamp", "properties",
)
RAW_SUPPORT_TICKETS = _text_schema(
    "ticket_id", "account_id", "created_at", "resolved_at", "priority", "category",
    "status", "satisfaction_score",
)

RAW_SCHEMAS = {
    "raw_accounts": RAW_ACCOUNTS,
    "raw_subscriptions": RAW_SUBSCRIPTIONS,
    "raw_invoices": RAW_INVOICES,
    "raw_usage_events": RAW_USAGE_EVENTS,
    "raw_support_tickets": RAW_SUPPORT_TICKETS,
}


#: The column that holds a record that could not be parsed, else null.
BAD_RECORD = "_bad_record"
READABLE_CHECKS = [Check(name, None, "expression", predicate=f"{BAD_RECORD} IS NOT NULL", name="readable") for name in RAW_SCHEMAS]


class RawInputs:
    """The five raw relations every model is built from.

    Each relation is a DataFrame or a zero-argument function returning one;
    functions are called on first access, so a query that needs only the
    invoices never builds the plans of the other four inputs.
    """

    NAMES = ("accounts", "subscriptions", "invoices", "usage_events", "support_tickets")

    def __init__(
        self, accounts, subscriptions, invoices, usage_events, support_tickets, spark: SparkSession | None = None,
        bad_records: dict | None = None,
    ):
        """``bad_records``: for inputs that can hold unreadable records, functions giving frames with ``BAD_RECORD``, by ``raw_...`` name."""
        self._bad_records = bad_records or {}
        self._sources = dict(zip(self.NAMES, (accounts, subscriptions, invoices, usage_events, support_tickets)))
        self._built: dict[str, DataFrame] = {}
        self._spark = spark

    def _get(self, name: str) -> DataFrame:
        if name not in self._built:
            src = self._sources[name]
            self._built[name] = src() if callable(src) else src
        return self._built[name]

    @property
    def bad_records(self) -> dict[str, DataFrame]:
        return {name: build() for name, build in self._bad_records.items()}

    accounts = property(lambda self: self._get("accounts"))
    subscriptions = property(lambda self: self._get("subscriptions"))
    invoices = property(lambda self: self._get("invoices"))
    usage_events = property(lambda self: self._get("usage_events"))
    support_tickets = property(lambda self: self._get("support_tickets"))

    @property
    def spark(self) -> SparkSession:
        return self._spark if self._spark is not None else self.accounts.sparkSession

    def as_dict(self) -> dict[str, DataFrame]:
        return {f"raw_{n}": self._get(n) for n in self.NAMES}


_CSV = {"header": True, "quote": '"', "escape": '"'}


def scan_raw_csv(spark: SparkSession, path: str, table: str, multi_line: bool = True) -> DataFrame:
    """All records of CSV files with header, empty fields null, with ``BAD_RECORD``.

    ``multi_line``: quoted fields may hold line breaks. A file is then read by one task, so large exports should be
    many files; without it files are split.
    """
    schema = T.StructType([*RAW_SCHEMAS[table].fields, T.StructField(BAD_RECORD, T.StringType(), True)])
    # Every column is parsed whatever is read, so that a record's columns are counted.
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": BAD_RECORD, "columnPruning": False, "multiLine": multi_line}
    return spark.read.schema(schema).options(**_CSV, **options).csv(path)


def _bad_record(scan: DataFrame) -> Column:
    """The ``BAD_RECORD``. Spark does not read that column alone, so nothing of another is added."""
    nothing = F.substring(F.coalesce(F.col(scan.columns[0]), F.lit("")), 1, 0)
    return F.concat(nothing, F.col(BAD_RECORD))


def unreadable(scan: DataFrame) -> DataFrame:
    """Every record's ``BAD_RECORD``."""
    return scan.select(_bad_record(scan).alias(BAD_RECORD))


def read_raw_csv(spark: SparkSession, path: str, table: str, multi_line: bool = True) -> DataFrame:
    """The readable records of ``scan_raw_csv``."""
    scan = scan_raw_csv(spark, path, table, multi_line)
    return scan.filter(_bad_record(scan).isNull()).drop(BAD_RECORD)


def read_raw_csv_dir(spark: SparkSession, directory: str, multi_line: bool = True) -> RawInputs:
    """``raw_accounts.csv`` … ``raw_support_tickets.csv`` (files or folders of files) from one folder."""
    path = lambda name: f"{directory.rstrip('/')}/{name}.csv"
    get = lambda name: read_raw_csv(spark, path(name), name, multi_line)
    return RawInputs(
        accounts=lambda: get("raw_accounts"),
        subscriptions=lambda: get("raw_subscriptions"),
        invoices=lambda: get("raw_invoices"),
        usage_events=lambda: get("raw_usage_events"),
        support_tickets=lambda: get("raw_support_tickets"),
        spark=spark,
        bad_records={name: lambda name=name: unreadable(scan_raw_csv(spark, path(name), name, multi_line)) for name in RAW_SCHEMAS},
    )


def write_raw_csv_dir(raw: RawInputs, directory: str, names: tuple[str, ...] = tuple(RAW_SCHEMAS)) -> None:
    """The raw relations as folders of CSV files that ``read_raw_csv_dir`` reads back, every value as text."""
    for name in names:
        frame = getattr(raw, name.removeprefix("raw_"))
        text = frame.select(*[F.col(f.name).cast("string").alias(f.name) for f in RAW_SCHEMAS[name]])
        keep = {"quoteAll": True, "ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False}
        text.write.options(**_CSV, **keep).csv(os.path.join(directory, f"{name}.csv"))


def read_raw_tables(spark: SparkSession, names: dict[str, str] | None = None) -> RawInputs:
    """Named-relation scan (S6): raw inputs registered as tables or views."""
    names = names or {k: k for k in RAW_SCHEMAS}
    return RawInputs(
        accounts=lambda: spark.table(names["raw_accounts"]),
        subscriptions=lambda: spark.table(names["raw_subscriptions"]),
        invoices=lambda: spark.table(names["raw_invoices"]),
        usage_events=lambda: spark.table(names["raw_usage_events"]),
        support_tickets=lambda: spark.table(names["raw_support_tickets"]),
        spark=spark,
    )


def read_raw_parquet_dir(spark: SparkSession, directory: str) -> RawInputs:
    """``raw_accounts/`` … ``raw_support_tickets/`` parquet tables under one folder.

    Column types may be text or typed; staging casts either way. Filters on
    derived dates (``event_date >= …``) reach the scan as timestamp
    predicates, and only the referenced columns are read.
    """
    get = lambda name: spark.read.parquet(f"{directory.rstrip('/')}/{name}")
    return RawInputs(
        accounts=lambda: get("raw_accounts"),
        subscriptions=lambda: get("raw_subscriptions"),
        invoices=lambda: get("raw_invoices"),
        usage_events=lambda: get("raw_usage_events"),
        support_tickets=lambda: get("raw_support_tickets"),
        spark=spark,
    )
