"""CSV sources (explicit schemas, quoted commas, mixed date text) through staging."""

import datetime as dt
import os
import tempfile
from decimal import Decimal

from acctlens.plans import staging
from acctlens.sources.generated import date_series, literal_values
from acctlens.operators.quality import run_checks
from acctlens.sources.raw import (
    RAW_SCHEMAS, READABLE_CHECKS, read_raw_csv, read_raw_csv_dir, read_raw_tables, scan_raw_csv, unreadable, write_raw_csv_dir,
)
from acctlens.sources.sinks import register_views

ACCOUNTS = """account_id,company_name,industry,employee_count,plan_tier,account_owner,region,signup_date,status
ACC-0001,"Smith, Jones and Co", Technology ,120, Growth ,Jane O'Neil,EUROPE,2024-03-01,Active
,Nobody,tech,1,starter,x,apac,2024-01-01,active
"""
SUBSCRIPTIONS = """subscription_id,account_id,product_name,plan_tier,mrr_amount,start_date,end_date,status
SUB-00001,ACC-0001,novacrm_platform,growth,149.00,2024-05-11,,active
SUB-00002,ACC-0001,api_access,growth,29.00,2024-01-02T00:00:00,2024-03-02,cancelled
"""


def _write(text):
    d = tempfile.mkdtemp(prefix="acctlens-csv-")
    path = os.path.join(d, "t.csv")
    with open(path, "w") as fh:
        fh.write(text)
    return path


def test_accounts_csv_quoted_commas_and_cleaning(spark):
    raw = read_raw_csv(spark, _write(ACCOUNTS), "raw_accounts")
    rows = staging.stg_accounts(raw).collect()
    assert len(rows) == 1  # NULL key dropped
    r = rows[0]
    assert r.company_name == "Smith, Jones and Co"
    assert (r.industry, r.plan_tier, r.region, r.status) == ("technology", "growth", "europe", "active")
    assert r.account_owner == "Jane O'Neil" and r.employee_count == 120 and r.signup_date == dt.date(2024, 3, 1)


def test_subscriptions_mixed_date_text_and_empty_end(spark):
    raw = read_raw_csv(spark, _write(SUBSCRIPTIONS), "raw_subscriptions")
    rows = {r.subscription_id: r for r in staging.stg_subscriptions(raw).collect()}
    a, b = rows["SUB-00001"], rows["SUB-00002"]
    assert a.start_date == dt.date(2024, 5, 11) and a.end_date is None and a.duration_days is None and a.is_active
    assert b.start_date == dt.date(2024, 1, 2) and b.duration_days == 60 and not b.is_active
    assert a.mrr_amount == Decimal("149.00")


def test_generated_sources(spark):
    days = date_series(spark, dt.date(2023, 1, 1), dt.date(2025, 12, 31))
    assert days.count() == 1096
    assert sorted(r.t for r in literal_values(spark, "t", ["starter", "growth"]).collect()) == ["growth", "starter"]


def test_dim_date_attributes(spark):
    from acctlens.plans.core import dim_date

    d = {r.date_day: r for r in dim_date(spark).collect()}
    first = d[dt.date(2023, 1, 1)]
    assert (first.week_number, first.day_of_week, first.day_name, first.is_weekend) == (52, 1, "Sunday", True)
    assert first.month_name == "January" and first.year_month == "2023-01"
    assert d[dt.date(2024, 2, 10)].last_day_of_month == dt.date(2024, 2, 29)
    assert d[dt.date(2024, 5, 17)].first_day_of_quarter == dt.date(2024, 4, 1)


def test_line_breaks_and_quotes_in_fields(spark):
    text = ACCOUNTS.replace("Jane O'Neil", '"Jane ""J"" O\'Neil\nof Dublin, Ireland"')
    r = staging.stg_accounts(read_raw_csv(spark, _write(text), "raw_accounts")).first()
    assert r.account_owner == 'Jane "J" O\'Neil\nof Dublin, Ireland' and r.region == "europe"


def test_bad_records_are_counted_not_read(spark):
    path = _write(SUBSCRIPTIONS + "SUB-3,ACC-9\nSUB-4,a,b,c,5,2024-01-01,,active,more\n\n")
    assert read_raw_csv(spark, path, "raw_subscriptions").count() == 2
    for multi_line in (True, False):
        scan = scan_raw_csv(spark, path, "raw_subscriptions", multi_line)
        bad = [r._bad_record for r in unreadable(scan).filter("_bad_record IS NOT NULL").collect()]
        assert [b.strip() for b in bad] == ["SUB-3,ACC-9", "SUB-4,a,b,c,5,2024-01-01,,active,more"]
        check = [c for c in READABLE_CHECKS if c.relation == "raw_subscriptions"]
        assert run_checks({"raw_subscriptions": unreadable(scan)}, check).first().violations == 2


def test_csv_round_trip_of_all_raw_relations(spark):
    from acctlens.sources.driver_tables import load_raw_inputs

    out = tempfile.mkdtemp(prefix="acctlens-rawcsv-")
    given = load_raw_inputs(spark, "/root/testdata/sf0.001")
    write_raw_csv_dir(given, out)
    back = read_raw_csv_dir(spark, out).as_dict()
    for name, df in given.as_dict().items():
        text = df.select(*[df[c].cast("string").alias(c) for c in back[name].columns])
        assert sorted(map(repr, text.collect())) == sorted(map(repr, back[name].collect())), name


def test_raw_inputs_by_name(spark):
    frame = spark.createDataFrame([("a", "x", "t", "1", "growth", "o", "eu", "2024-01-01", "active")], RAW_SCHEMAS["raw_accounts"])
    register_views({"named_accounts": frame})
    raw = read_raw_tables(spark, {"raw_accounts": "named_accounts"})
    assert staging.stg_accounts(raw.accounts).first().account_id == "a"
