"""Registered queries: streaming (T1–T4).  Each brings ``events`` into a
fresh folder in steps of event time, runs the stream with
``Trigger.AvailableNow`` after each step over one checkpoint, and returns
what the sink holds.  The oracle SQL is the batch twin, cut where event time
stops: results that wait appear only once the last watermark (newest event −
1 hour) leaves no other answer."""

from __future__ import annotations

from pyspark.sql import functions as F

from . import bindings as B
from .queries import register
from .queries_runs import _poll_starts
from .session import scratch_path
from .streaming import sources as SS
from .streaming import stateful as ST

SLICES = 3
WATERMARK = "1 hour"


def _events(spark, sf_dir):
    """``(table, folder, stream over the folder)``."""
    ev = B.table(spark, sf_dir, "events")
    folder = scratch_path(spark, "replay")
    ev.limit(0).write.parquet(folder)
    return ev, folder, SS.event_stream(spark, folder, ev.schema)


def _run_slices(spark, ev, folder, out, name, schema=None):
    """Run the stream ``out`` into a Parquet sink after each step of the replay."""
    sink, checkpoint = scratch_path(spark, f"{name}-sink"), scratch_path(spark, f"{name}-ckpt")
    for _ in SS.replay(ev, "ts", folder, SLICES):
        SS.run_available_now(spark, out.writeStream.format("parquet").option("path", sink).outputMode("append"), checkpoint)
    return (spark.read.schema(schema) if schema else spark.read).parquet(sink)


def _state(col: str):
    out = None
    for k, v in B.EVENT_STATE.items():
        out = F.when(F.col(col) == k, v) if out is None else out.when(F.col(col) == k, v)
    return out


_CUTOFF_SQL = "(SELECT max(ts) - INTERVAL 1 HOUR FROM events)"


@register(
    "t1_stream_poll_outcome",
    """
WITH obs AS (
  SELECT user_id AS run_id, ts, event_id,
    CASE event_type WHEN 'error' THEN 'failed' WHEN 'purchase' THEN 'success' WHEN 'signup' THEN 'skipped'
                    ELSE 'running' END AS state
  FROM events),
s AS (SELECT run_id, date_trunc('day', min(ts)) + INTERVAL 1 DAY AS start_ts FROM obs GROUP BY run_id
      UNION ALL SELECT 1000000 + c_custkey, TIMESTAMP '2024-01-01' + to_hours(CAST(c_custkey % 96 AS INTEGER)) FROM customer),
seen AS (
  SELECT s.run_id, first(o.state ORDER BY o.ts, o.event_id) FILTER (WHERE o.state <> 'running') AS decided, count(*) AS n_seen
  FROM s JOIN obs o ON o.run_id = s.run_id
  WHERE o.ts >= s.start_ts AND o.ts < s.start_ts + INTERVAL 360 MINUTE
  GROUP BY s.run_id)
SELECT s.run_id,
  CASE WHEN seen.decided IS NOT NULL THEN seen.decided
       WHEN coalesce(seen.n_seen, 0) > 0 THEN NULL ELSE 'unknown' END AS outcome,
  coalesce(seen.n_seen, 0) AS n_seen
FROM s LEFT JOIN seen ON seen.run_id = s.run_id
WHERE s.start_ts + INTERVAL 360 MINUTE < """
    + _CUTOFF_SQL,
)
def t1_stream_poll_outcome(spark, sf_dir):
    """Runs of users, and of customers that no event is about (``unknown``)."""
    ev, folder, stream = _events(spark, sf_dir)
    obs = stream.select(F.col("user_id").alias("run_id"), "ts", _state("event_type").alias("state"), "event_id")
    users = _poll_starts(B.observations(spark, sf_dir)).select(F.col("run_id").cast("long").alias("run_id"), "start_ts")
    never = B.table(spark, sf_dir, "customer").select(
        (F.col("c_custkey") + 1000000).cast("long").alias("run_id"),
        (F.lit("2024-01-01").cast("timestamp_ntz") + F.make_dt_interval(hours=(F.col("c_custkey") % 96).cast("int"))).alias("start_ts"),
    )
    begun = scratch_path(spark, "t1-starts")
    users.unionByName(never).write.parquet(begun)
    starts = SS.event_stream(spark, begun, spark.read.parquet(begun).schema, "start_ts")
    out = ST.stream_poll_outcome(obs, starts, 360, WATERMARK, tie="event_id")
    return _run_slices(spark, ev, folder, out, "t1", ST.POLL_OUTPUT)


@register(
    "t2_stream_upstream_ready",
    """
WITH c AS (SELECT event_id AS run_event_id, user_id AS key, ts AS run_ts FROM events WHERE event_type = 'click'),
p AS (SELECT event_id AS up_event_id, user_id AS up_key, ts AS up_ts FROM events WHERE event_type = 'purchase'),
j AS (SELECT c.run_event_id, c.key, c.run_ts, first(p.up_event_id ORDER BY p.up_ts, p.up_event_id) AS up_event_id, min(p.up_ts) AS up_ts
      FROM c LEFT JOIN p ON p.up_key = c.key AND p.up_ts >= c.run_ts AND p.up_ts <= c.run_ts + INTERVAL 1440 MINUTE
      GROUP BY c.run_event_id, c.key, c.run_ts),
w AS (SELECT least(max(ts) FILTER (WHERE event_type = 'click'), max(ts) FILTER (WHERE event_type = 'purchase')) - INTERVAL 1 HOUR AS wm FROM events)
SELECT run_event_id, key, run_ts, up_event_id,
  CASE WHEN up_event_id IS NOT NULL THEN 'ready' ELSE 'timed_out' END AS outcome
FROM j, w
WHERE CASE WHEN up_event_id IS NOT NULL THEN up_ts < wm ELSE run_ts + INTERVAL 1440 MINUTE < wm END
""",
)
def t2_stream_upstream_ready(spark, sf_dir):
    ev, folder, stream = _events(spark, sf_dir)
    clicks = stream.filter(F.col("event_type") == "click").select(
        F.col("event_id").alias("run_event_id"), F.col("user_id").alias("key"), F.col("ts").alias("run_ts")
    )
    purchases = stream.filter(F.col("event_type") == "purchase").select(
        F.col("event_id").alias("up_event_id"), F.col("user_id").alias("key"), F.col("ts").alias("up_ts")
    )
    out = ST.stream_upstream_ready(clicks, purchases, 1440, WATERMARK)
    return _run_slices(spark, ev, folder, out, "t2").select(
        "run_event_id", "key", F.col("run_ts").cast("timestamp_ntz").alias("run_ts"), "up_event_id", "outcome"
    )


@register(
    "t3_stream_failure_alerts",
    """
SELECT event_id, 'Task task-' || event_id || ' in user-' || user_id || ' failed at '
  || strftime(ts, '%Y-%m-%d %H:%M:%S') AS message
FROM events WHERE event_type = 'error'
""",
)
def t3_stream_failure_alerts(spark, sf_dir):
    """The first step is delivered again at the end: late, and every alert twice."""
    ev, folder, stream = _events(spark, sf_dir)
    tasks = stream.select("event_id", "user_id", "ts", _state("event_type").alias("state"))
    fields = {
        "task": F.concat(F.lit("task-"), F.col("event_id").cast("string")),
        "dag": F.concat(F.lit("user-"), F.col("user_id").cast("string")),
        "execution_time": F.date_format("ts", "yyyy-MM-dd HH:mm:ss"),
    }
    sink, checkpoint = scratch_path(spark, "t3-sink"), scratch_path(spark, "t3-ckpt")
    run = lambda: ST.stream_failure_alerts(tasks, fields, "Task {task} in {dag} failed at {execution_time}", sink, checkpoint)
    for _ in SS.replay(ev, "ts", folder, SLICES):
        run()
    middle = ev.agg(F.percentile_approx(F.unix_micros(F.col("ts").cast("timestamp")), 0.5).alias("m")).first()["m"]
    ev.filter(F.unix_micros(F.col("ts").cast("timestamp")) <= F.lit(middle)).write.mode("append").parquet(folder)
    run()
    return spark.read.parquet(sink).select("event_id", "message")


@register(
    "t1_stream_rolled_outcome",
    """
WITH runs AS (SELECT user_id AS run_id, ts, event_id, CASE event_type WHEN 'purchase' THEN 'success' WHEN 'signup' THEN 'skipped' ELSE 'running' END AS state
              FROM events WHERE event_type IN ('purchase', 'signup', 'view')),
tasks AS (SELECT user_id AS run_id, event_id % 5 AS task_id, ts, event_id, CASE event_type WHEN 'error' THEN 'failed' ELSE 'success' END AS state
          FROM events WHERE event_type IN ('error', 'click')),
s AS (SELECT user_id AS run_id, date_trunc('day', min(ts)) + INTERVAL 1 DAY AS start_ts FROM events GROUP BY user_id),
seen AS (SELECT s.run_id, count(*) AS n_seen, first(r.state ORDER BY r.ts, r.event_id) FILTER (WHERE r.state <> 'running') AS state,
                min(r.ts) FILTER (WHERE r.state <> 'running') AS at
         FROM s JOIN runs r ON r.run_id = s.run_id AND r.ts >= s.start_ts AND r.ts < s.start_ts + INTERVAL 1440 MINUTE GROUP BY s.run_id),
newest AS (SELECT seen.run_id, t.task_id, last(t.state ORDER BY t.ts, t.event_id) AS state
           FROM seen JOIN tasks t ON t.run_id = seen.run_id AND t.ts <= seen.at GROUP BY seen.run_id, t.task_id),
bad AS (SELECT DISTINCT run_id FROM newest WHERE state = 'failed'),
w AS (SELECT least(max(ts) FILTER (WHERE event_type IN ('purchase', 'signup', 'view')),
                   max(ts) FILTER (WHERE event_type IN ('error', 'click'))) - INTERVAL 1 HOUR AS wm FROM events)
SELECT s.run_id, CASE WHEN seen.state = 'success' AND bad.run_id IS NOT NULL THEN 'failed' WHEN seen.state IS NOT NULL THEN seen.state
                      WHEN coalesce(n_seen, 0) > 0 THEN NULL ELSE 'unknown' END AS outcome, coalesce(n_seen, 0) AS n_seen
FROM w, s LEFT JOIN seen ON seen.run_id = s.run_id LEFT JOIN bad ON bad.run_id = s.run_id
WHERE s.start_ts + INTERVAL 1440 MINUTE < w.wm
""",
)
def t1_stream_rolled_outcome(spark, sf_dir):
    """Waiting for runs whose state is rolled up from their tasks in the stream (A3, then W4):
    purchases, signups and views are the run's states, errors and clicks are attempts of its tasks."""
    ev, folder, stream = _events(spark, sf_dir)
    kind = F.col("event_type")
    obs = stream.filter(kind.isin("purchase", "signup", "view")).select(
        F.col("user_id").alias("run_id"), "ts", "event_id",
        F.when(kind == "purchase", "success").when(kind == "signup", "skipped").otherwise("running").alias("state"),
    )
    tasks = stream.filter(kind.isin("error", "click")).select(
        F.col("user_id").alias("run_id"), (F.col("event_id") % 5).alias("task_id"), "ts", "event_id",
        F.when(kind == "error", "failed").otherwise("success").alias("state"),
    )
    begun = scratch_path(spark, "t1-starts")
    users = _poll_starts(ev.select(F.col("user_id").alias("run_id"), "ts"))
    users.select(F.col("run_id").cast("long").alias("run_id"), "start_ts").write.parquet(begun)
    starts = SS.event_stream(spark, begun, spark.read.parquet(begun).schema, "start_ts")
    out = ST.stream_poll_outcome(obs, starts, 1440, WATERMARK, tie="event_id", task_states=tasks, task_tie="event_id")
    return _run_slices(spark, ev, folder, out, "t1r", ST.POLL_OUTPUT)


def _by_day(rows):
    return rows.withColumn("ds", F.date_format("ts", "yyyy-MM-dd"))


_DAILY = {"n_events": ("count", "1"), "total_value": ("sum", "CAST(value AS DECIMAL(12,2))")}


@register(
    "t4_incremental_run",
    """
SELECT strftime(ts, '%Y-%m-%d') AS ds, event_type, count(*) AS n_events,
       CAST(sum(CAST(value AS DECIMAL(12,2))) AS DOUBLE) AS total_value
FROM events GROUP BY 1, 2
""",
)
def t4_incremental_run(spark, sf_dir):
    """Scheduled runs over one checkpoint: the later two thirds of the events, then
    the first third (late), then nothing new; the ledger is compacted after the second."""
    ev, folder, stream = _events(spark, sf_dir)
    ledger, checkpoint, keys = scratch_path(spark, "t4-ledger"), scratch_path(spark, "t4-ckpt"), ["ds", "event_type"]
    at = F.unix_micros(F.col("ts").cast("timestamp"))
    third = ev.agg(F.percentile_approx(at, 0.33).alias("m")).first()["m"]
    for part in (ev.filter(at > F.lit(third)), ev.filter(at <= F.lit(third)), None):
        if part is not None:
            part.write.mode("append").parquet(folder)
        ST.incremental_run(_by_day(stream), keys, _DAILY, ledger, checkpoint)
        if part is not None:
            ST.compact_ledger(spark, ledger, keys, _DAILY)
    return ST.ledger_totals(spark, ledger, keys, _DAILY).withColumn("total_value", F.col("total_value").cast("double"))
