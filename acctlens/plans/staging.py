"""Staging layer (M1-M5): typed, trimmed, lower-cased raw relations.

Each function is ``DataFrame -> DataFrame`` and lazy. Audit columns
(``_loaded_at``) are optional and off by default so results are
reproducible.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from acctlens.functions import columns as X
from acctlens.functions.numeric import MONEY
from acctlens.functions.dates import date_from_text, days_between, to_utc_timestamp_ntz, whole_minutes_between


def _audit(df: DataFrame, audit: bool) -> DataFrame:
    return df.withColumn("_loaded_at", F.current_timestamp()) if audit else df


def stg_accounts(raw: DataFrame, audit: bool = False) -> DataFrame:
    out = raw.filter(F.col("account_id").isNotNull()).select(
        F.col("account_id").cast("string").alias("account_id"),
        X.clean_text(F.col("company_name")).alias("company_name"),
        X.clean_code(F.col("industry")).alias("industry"),
        F.col("employee_count").cast("bigint").alias("employee_count"),
        X.clean_code(F.col("plan_tier")).alias("plan_tier"),
        X.clean_text(F.col("account_owner")).alias("account_owner"),
        X.clean_code(F.col("region")).alias("region"),
        F.col("signup_date").cast("date").alias("signup_date"),
        X.clean_code(F.col("status")).alias("status"),
    )
    return _audit(out, audit)


def stg_subscriptions(raw: DataFrame, audit: bool = False) -> DataFrame:
    status = X.clean_code(F.col("status"))
    start = date_from_text(raw, "start_date")
    end = date_from_text(raw, "end_date")
    out = raw.filter(F.col("subscription_id").isNotNull()).select(
        F.col("subscription_id").cast("string").alias("subscription_id"),
        F.col("account_id").cast("string").alias("account_id"),
        X.clean_code(F.col("product_name")).alias("product_name"),
        X.clean_code(F.col("plan_tier")).alias("plan_tier"),
        F.col("mrr_amount").cast(MONEY).alias("mrr_amount"),
        start.alias("start_date"),
        end.alias("end_date"),
        status.alias("status"),
        X.flag_equals(status, "active").alias("is_active"),
        days_between(end, start).alias("duration_days"),
    )
    return _audit(out, audit)


def stg_invoices(raw: DataFrame, audit: bool = False) -> DataFrame:
    status = X.clean_code(F.col("status"))
    invoice_date = F.col("invoice_date").cast("date")
    out = raw.filter(F.col("invoice_id").isNotNull()).select(
        F.col("invoice_id").cast("string").alias("invoice_id"),
        F.col("account_id").cast("string").alias("account_id"),
        invoice_date.alias("invoice_date"),
        F.col("amount").cast(MONEY).alias("amount"),
        F.upper(X.clean_text(F.col("currency"))).alias("currency"),
        status.alias("status"),
        X.clean_text(F.col("line_items")).alias("line_items"),
        F.trunc(invoice_date, "month").alias("invoice_month"),
        X.flag_equals(status, "paid").alias("is_paid"),
    )
    return _audit(out, audit)


def stg_usage_events(raw: DataFrame, audit: bool = False) -> DataFrame:
    name = X.clean_code(F.col("event_name"))
    ts = to_utc_timestamp_ntz(raw, "event_timestamp")
    out = raw.filter(F.col("event_id").isNotNull()).select(
        F.col("event_id").cast("string").alias("event_id"),
        F.col("account_id").cast("string").alias("account_id"),
        F.col("user_id").cast("string").alias("user_id"),
        name.alias("event_name"),
        ts.alias("event_timestamp"),
        ts.cast("date").alias("event_date"),
        F.hour(ts).cast("bigint").alias("event_hour"),
        X.event_category(name).alias("event_category"),
    )
    return _audit(out, audit)


def stg_support_tickets(raw: DataFrame, audit: bool = False) -> DataFrame:
    created = to_utc_timestamp_ntz(raw, "created_at")
    resolved = to_utc_timestamp_ntz(raw, "resolved_at")
    priority = X.clean_code(F.col("priority"))
    minutes = whole_minutes_between(resolved, created)
    out = raw.filter(F.col("ticket_id").isNotNull()).select(
        F.col("ticket_id").cast("string").alias("ticket_id"),
        F.col("account_id").cast("string").alias("account_id"),
        created.alias("created_at"),
        resolved.alias("resolved_at"),
        priority.alias("priority"),
        X.clean_code(F.col("category")).alias("category"),
        X.clean_code(F.col("status")).alias("status"),
        F.col("satisfaction_score").cast("double").alias("satisfaction_score"),
        X.resolution_hours(minutes).alias("resolution_hours"),
        X.sla_target_hours(priority).alias("sla_target_hours"),
        X.is_sla_breach(minutes, priority).alias("is_sla_breach"),
        created.cast("date").alias("created_date"),
    )
    return _audit(out, audit)
