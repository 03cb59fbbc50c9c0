"""Registered queries: batch twins of the streams."""

from __future__ import annotations

from pyspark.sql import functions as F

from fundlens.session import read_table as rt
from fundlens.streaming import net


def stream_event_windows(spark, d):
    w = net.event_windows(rt(spark, d, "events"), late=None)
    return w.select(F.date_format("start", "yyyy-MM-dd HH:mm").alias("start"), "event_type", "n")


def stream_event_sessions(spark, d):
    s = net.event_sessions(rt(spark, d, "events"), late=None)
    return s.groupBy("user_id").agg(F.count(F.lit(1)).alias("sessions"), F.sum("n").cast("bigint").alias("events"))


def stream_net_positions(spark, d):
    return net.net_positions(rt(spark, d, "transparency"))


QUERIES = {f.__name__: f for f in (stream_event_windows, stream_event_sessions, stream_net_positions)}
ORACLES = {
    "stream_event_windows": "SELECT strftime(date_trunc('hour', ts), '%Y-%m-%d %H:%M') AS start, event_type, count(*) AS n FROM events GROUP BY ALL",
    "stream_event_sessions": "WITH e AS (SELECT user_id, ts, CASE WHEN ts - lag(ts) OVER (PARTITION BY user_id ORDER BY ts) < INTERVAL 30 MINUTE THEN 0 ELSE 1 END AS s FROM events) SELECT user_id, sum(s)::BIGINT AS sessions, count(*) AS events FROM e GROUP BY 1",
    "stream_net_positions": "SELECT ein, fiscal_year, sum(coalesce(amount, 0))::BIGINT AS net, count(*) AS n FROM transparency GROUP BY ALL",
}
