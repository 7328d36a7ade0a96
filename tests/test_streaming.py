"""The incremental usage fact equals the batch fact over all events, with a late
event arriving in a later micro-batch and a replayed batch."""

import datetime as dt
import os
import tempfile

from acctlens.plans.core import fct_usage
from acctlens.plans.staging import stg_usage_events
from acctlens.sources.raw import RAW_USAGE_EVENTS
from acctlens.streaming.usage import refresh_daily_usage, start_daily_usage_stream


def _events(spark, rows):
    return spark.createDataFrame(rows, RAW_USAGE_EVENTS)


def _rows(i, account, user, name, ts):
    return (f"e{i}", account, user, name, ts, None)


def _sorted(df):
    return sorted(tuple(r) for r in df.select(*sorted(df.columns)).collect())


def test_stream_matches_batch(spark):
    base = tempfile.mkdtemp(prefix="acctlens-stream-")
    src, staged, fact, ckpt = (os.path.join(base, x) for x in ("src", "staged", "fact", "ckpt"))
    first = [
        _rows(1, "a", "a-u1", "api_call", "2025-01-10T09:00:00"),
        _rows(2, "a", "a-u2", "report_created", "2025-01-10T11:30:00"),
        _rows(3, "b", "b-u1", "email_sent", "2025-01-11T08:00:00"),
    ]
    second = [
        _rows(4, "a", "a-u1", "api_call", "2025-01-10T23:59:00"),  # late event for an earlier day, same user
        _rows(5, "a", "a-u3", "made_up_event", "2025-01-12T07:00:00"),
    ]
    _events(spark, first).write.mode("append").json(src)
    stream = spark.readStream.schema(RAW_USAGE_EVENTS).json(src)
    q = start_daily_usage_stream(stream, staged, fact, ckpt, trigger={"availableNow": True})
    q.awaitTermination(120)
    _events(spark, second).write.mode("append").json(src)
    q = start_daily_usage_stream(stream, staged, fact, ckpt, trigger={"availableNow": True})
    q.awaitTermination(120)

    got = spark.read.parquet(fact)
    expected = fct_usage(stg_usage_events(_events(spark, first + second)))
    assert _sorted(got.select(*expected.columns)) == _sorted(expected)
    day = got.filter("account_id = 'a' AND event_date = DATE'2025-01-10'").first()
    assert (day.total_events, day.active_users) == (3, 2)


def test_replayed_batch_is_idempotent(spark):
    base = tempfile.mkdtemp(prefix="acctlens-replay-")
    staged, fact = os.path.join(base, "staged"), os.path.join(base, "fact")
    batch = _events(spark, [_rows(1, "a", "u", "api_call", "2025-01-10T09:00:00")])
    refresh_daily_usage(batch, 0, staged, fact)
    refresh_daily_usage(batch, 0, staged, fact)  # retry of the same batch id
    assert spark.read.parquet(fact).first().total_events == 1
    assert dt.date(2025, 1, 10) == spark.read.parquet(fact).first().event_date
