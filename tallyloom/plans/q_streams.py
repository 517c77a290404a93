"""Streams over the given files; what they wrote equals the batch result for closed windows."""

from __future__ import annotations

from pyspark.sql import functions as F

from tallyloom.plans import inputs
from tallyloom.plans.registry import query
from tallyloom.streaming import streams


def stream_of(t, name: str, delay: str = "1 hour"):
    base, columns, _ = inputs.DERIVED[name]
    raw = streams.read_table_stream(t.spark, t.folder, f"{base}.parquet")
    return streams.event_time(raw.selectExpr(*[c.replace("{TS}", "TIMESTAMP_NTZ") for c in columns]), "ts", delay)


def epoch(column: str):
    return F.unix_micros(column)


MARK = "mark AS (SELECT epoch_us(max(ts)) - 3600000000 AS mark FROM actions)"


@query("stream_session_counts", f"""WITH {MARK}, g AS (SELECT user_id, ts, CASE WHEN epoch_us(ts) - lag(epoch_us(ts)) OVER w <= 2400000000 THEN 0 ELSE 1 END AS f FROM actions WINDOW w AS (PARTITION BY user_id ORDER BY ts)),
 s AS (SELECT user_id, ts, sum(f) OVER (PARTITION BY user_id ORDER BY ts ROWS UNBOUNDED PRECEDING) AS sid FROM g),
 c AS (SELECT user_id, epoch_us(min(ts)) AS session_start, epoch_us(max(ts)) + 2400000000 AS session_end, count(*) AS events FROM s GROUP BY user_id, sid)
 SELECT c.* FROM c, mark WHERE session_end <= mark""", uses="actions")
def _(t):
    out = streams.drain(streams.session_counts(stream_of(t, "actions")), "stream-sessions")
    return out.select("user_id", epoch("session_start").alias("session_start"), epoch("session_end").alias("session_end"), "events")


KINDS = ["click", "order", "to_cart"]


@query("stream_daily_action_counts", f"""WITH {MARK} SELECT user_id, strftime(ts, '%Y-%m-%d') AS day, {', '.join(f"count(*) FILTER (WHERE action_type = '{k}') AS {k}_count" for k in KINDS)}
 FROM actions, mark WHERE epoch_us(cast(ts AS date) + INTERVAL 1 DAY) <= mark GROUP BY ALL""", uses="actions")
def _(t):
    out = streams.drain(streams.daily_action_counts(stream_of(t, "actions"), KINDS), "stream-days")
    return out.select("user_id", F.date_format("day", "yyyy-MM-dd").alias("day"), *[f"{k}_count" for k in KINDS])


@query("stream_sliding_trend", f"""WITH {MARK}, d AS (SELECT user_id, cast(ts AS date) + i::INT + 1 AS e FROM actions, range(7) AS r(i)) SELECT user_id, strftime(e, '%Y-%m-%d') AS window_end, count(*) AS actions
 FROM d, mark WHERE epoch_us(e::TIMESTAMP) <= mark GROUP BY ALL""", uses="actions")
def _(t):
    out = streams.drain(streams.sliding_trend(stream_of(t, "actions")), "stream-trend")
    return out.select("user_id", F.date_format("window_end", "yyyy-MM-dd").alias("window_end"), "actions")


@query("stream_search_conversion", """SELECT a.user_id, a.event_id, a.action_type, max(epoch_us(s.ts)) AS search_us FROM actions a JOIN searches s ON a.user_id = s.user_id
 AND a.ts >= s.ts AND a.ts <= s.ts + INTERVAL 60 MINUTE GROUP BY ALL""", uses="actions searches")
def _(t):
    pairs = streams.search_action_pairs(stream_of(t, "searches"), stream_of(t, "actions"))
    last = streams.last_search_per_action(streams.drain(pairs, "stream-pairs"))
    return last.select("user_id", "event_id", "action_type", epoch("search_ts").alias("search_us"))


@query("stream_dedup_points", "SELECT DISTINCT user_id, round(value + 0.001, 1) + 0.0 AS v FROM events", rounds="v")
def _(t):
    raw = streams.read_table_stream(t.spark, t.folder, "events.parquet")
    points = streams.event_time(raw, "ts", "40 days")
    keys = [F.col("user_id"), F.round(F.col("value") + 0.001, 1) + F.lit(0.0)]
    out = streams.drain(streams.dedup_points(points, keys).select("user_id", F.col("k1").alias("v")), "stream-points")
    return out
