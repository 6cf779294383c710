"""Registered queries: run-state family (A3, A4, W1, W3, W4, J5, J6, A5),
sets (U1–U4), registry (P2–P4, O1, O2), handlers (P6)."""

from __future__ import annotations

from pyspark.sql import functions as F

from . import bindings as B
from .constants import SUPPORTED_HANDLER_TYPES
from .functions import tags as T
from .operators import classify, registry, runs, sets
from .queries import register

_LATEST_TASKS_SQL = """
tasks AS (
  SELECT run_id, task_id, ts, state FROM (
    SELECT l_orderkey AS run_id, l_linenumber AS task_id, l_shipdate AS ts,
           CASE WHEN l_returnflag = 'R' THEN 'failed' WHEN l_returnflag = 'A' THEN 'success'
                WHEN l_linestatus = 'O' THEN 'running' ELSE 'skipped' END AS state
    FROM lineitem)
  QUALIFY row_number() OVER (PARTITION BY run_id, task_id ORDER BY ts DESC, state DESC) = 1
)"""


@register(
    "a3_run_rollup",
    "WITH " + _LATEST_TASKS_SQL + """,
f AS (SELECT run_id, bool_or(state = 'failed') AS any_failed FROM tasks GROUP BY run_id)
SELECT o_orderkey AS run_id,
  CASE WHEN o_orderstatus = 'P' THEN NULL
       WHEN o_orderstatus = 'O' AND coalesce(f.any_failed, false) THEN 'failed'
       WHEN o_orderstatus = 'O' THEN 'success' ELSE 'failed' END AS outcome
FROM orders LEFT JOIN f ON f.run_id = o_orderkey
""",
)
def a3_run_rollup(spark, sf_dir):
    tasks = runs.latest_attempts(B.task_states(spark, sf_dir))
    return runs.run_rollup(B.runs(spark, sf_dir).select("run_id", "state"), tasks)


@register(
    "a4_trigger_gate",
    "WITH " + _LATEST_TASKS_SQL + """
SELECT run_id,
  bool_and(state IN ('success', 'failed', 'skipped', 'upstream_failed')) AS all_done,
  bool_and(state = 'success') AS all_success, count(*) AS n_tasks
FROM tasks GROUP BY run_id
""",
)
def a4_trigger_gate(spark, sf_dir):
    return runs.trigger_gate(runs.latest_attempts(B.task_states(spark, sf_dir)))


@register(
    "a4_task_gates",
    "WITH " + _LATEST_TASKS_SQL + """,
lines AS (SELECT DISTINCT o_orderstatus AS p, l_linenumber AS n FROM lineitem JOIN orders ON o_orderkey = l_orderkey),
edges AS (SELECT p, n - 1 AS parent, n AS child FROM lines WHERE n > 1 UNION SELECT p, 1, n FROM lines WHERE n > 1)
SELECT o_orderkey AS run_id, e.child AS task_id,
  CASE WHEN e.child % 3 = 0 THEN 'all_done' ELSE 'all_success' END AS rule,
  CASE WHEN e.child % 3 = 0 THEN bool_and(coalesce(t.state IN ('success', 'failed', 'skipped', 'upstream_failed'), false))
       ELSE bool_and(coalesce(t.state = 'success', false)) END AS eligible,
  count(*) AS n_parents
FROM orders JOIN edges e ON e.p = o_orderstatus LEFT JOIN tasks t ON t.run_id = o_orderkey AND t.task_id = e.parent
GROUP BY o_orderkey, e.child
""",
)
def a4_task_gates(spark, sf_dir):
    """A pipeline per order status.  Every task waits for the one before it
    and for the first; every third one cleans up (``all_done``)."""
    orders = B.table(spark, sf_dir, "orders")
    lines = B.table(spark, sf_dir, "lineitem").join(orders, F.col("l_orderkey") == F.col("o_orderkey"))
    lines = lines.select(F.col("o_orderstatus").alias("pipeline"), "l_linenumber").distinct()
    number = F.col("l_linenumber")
    before = F.array_distinct(F.array(number - 1, F.lit(1).cast(lines.schema["l_linenumber"].dataType)))
    e = lines.filter(number > 1).select("pipeline", F.explode(before).alias("parent"), number.alias("child"))
    rules = lines.filter(number % 3 == 0).select("pipeline", number.alias("task_id"), F.lit("all_done").alias("rule"))
    of_run = orders.select(F.col("o_orderkey").alias("run_id"), F.col("o_orderstatus").alias("pipeline"))
    return runs.task_gates(of_run, runs.latest_attempts(B.task_states(spark, sf_dir)), e, rules)


@register(
    "u4_dedupe_by_name",
    """
SELECT * FROM lineitem
QUALIFY row_number() OVER (PARTITION BY l_orderkey, l_linenumber
  ORDER BY l_shipdate DESC, l_partkey DESC, l_suppkey DESC, l_quantity DESC, l_extendedprice DESC,
           l_discount DESC, l_tax DESC, l_returnflag DESC, l_linestatus DESC) = 1
""",
)
def u4_dedupe_by_name(spark, sf_dir):
    li = B.table(spark, sf_dir, "lineitem")
    return sets.dedupe_by_name(li, ["l_orderkey", "l_linenumber"], ["l_shipdate"])


@register(
    "w1_latest_value",
    """
SELECT user_id AS run_id, event_type AS key, props AS value, ts FROM events
QUALIFY row_number() OVER (PARTITION BY user_id, event_type ORDER BY ts DESC, event_id DESC) = 1
""",
)
def w1_latest_value(spark, sf_dir):
    return runs.latest_value(B.kv(spark, sf_dir), tie="event_id")


@register(
    "w3_previous_run",
    """
SELECT pipeline_id, execution_ts, lag(execution_ts) OVER (PARTITION BY pipeline_id ORDER BY execution_ts) AS prev_ts
FROM (SELECT DISTINCT o_custkey AS pipeline_id, o_orderdate AS execution_ts FROM orders)
""",
)
def w3_previous_run(spark, sf_dir):
    return runs.previous_run(B.runs(spark, sf_dir))


def _poll_starts(obs):
    start = F.date_trunc("day", F.min("ts")) + F.expr("INTERVAL 1 DAY")
    return obs.groupBy("run_id").agg(start.cast("timestamp_ntz").alias("start_ts"))


@register(
    "w4_poll_outcome",
    """
WITH obs AS (
  SELECT user_id AS run_id, ts, event_id,
    CASE event_type WHEN 'error' THEN 'failed' WHEN 'purchase' THEN 'success' WHEN 'signup' THEN 'skipped'
                    ELSE 'running' END AS state
  FROM events),
s AS (SELECT run_id, date_trunc('day', min(ts)) + INTERVAL 1 DAY AS start_ts FROM obs GROUP BY run_id),
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
""",
)
def w4_poll_outcome(spark, sf_dir):
    obs = B.observations(spark, sf_dir)
    return runs.poll_outcome(obs, _poll_starts(obs), 360, tie="event_id")


_AS_OF_J5 = "2001-08-01 00:00:00"


_WAITS_SQL = f"""
WITH oc AS (SELECT c_nationkey AS nation, o_orderdate AS run_ts, o_orderpriority AS task, o_orderstatus
            FROM orders JOIN customer ON o_custkey = c_custkey),
nr AS (
  SELECT nation, run_ts, CAST(NULL AS VARCHAR) AS task,
    NOT bool_or(o_orderstatus = 'F') AND NOT bool_or(o_orderstatus = 'P') AS succeeded,
    run_ts + to_hours(CAST(count(*) * 12 AS BIGINT)) AS finished_ts
  FROM oc GROUP BY nation, run_ts),
tasks AS (SELECT nation, run_ts, task, bool_or(o_orderstatus = 'F') AS failed FROM oc GROUP BY nation, run_ts, task),
up AS (
  SELECT * FROM nr
  UNION ALL SELECT nation, run_ts, task, NOT failed, run_ts + INTERVAL 6 HOUR FROM tasks
  UNION ALL SELECT nation, run_ts, task, true, run_ts + INTERVAL 30 HOUR FROM tasks WHERE failed),
dep AS (
  SELECT n_nationkey AS pipeline_id, (n_nationkey + 1) % 25 AS up_id, CAST(NULL AS VARCHAR) AS up_task, n_nationkey % 5 <> 0 AS must FROM nation
  UNION ALL SELECT n_nationkey, (n_nationkey + 1) % 25, '1-URGENT', n_nationkey % 5 <> 0 FROM nation
  UNION ALL SELECT n_nationkey, n_nationkey + 1000, NULL, n_nationkey % 5 <> 0 FROM nation WHERE n_nationkey % 3 = 0
  UNION ALL SELECT n_nationkey, (n_nationkey + 1) % 25, 'no-such-task', n_nationkey % 5 <> 0 FROM nation WHERE n_nationkey % 3 = 0)
SELECT nr.nation AS pipeline_id, nr.run_ts, CAST(d.up_id AS INTEGER) AS up_pipeline_id, d.up_task AS up_task_id,
  CASE
    WHEN d.must AND NOT EXISTS (SELECT 1 FROM up u WHERE u.nation = d.up_id AND (d.up_task IS NULL OR u.task = d.up_task)) THEN 'missing'
    WHEN EXISTS (SELECT 1 FROM up u WHERE u.nation = d.up_id AND u.run_ts = nr.run_ts - INTERVAL 1 DAY
                 AND u.task IS NOT DISTINCT FROM d.up_task AND u.succeeded AND u.finished_ts <= nr.run_ts + INTERVAL 1 DAY) THEN 'ready'
    WHEN nr.run_ts + INTERVAL 1 DAY < TIMESTAMP '{_AS_OF_J5}' THEN 'timed_out'
    ELSE 'waiting' END AS outcome
FROM nr JOIN dep d ON d.pipeline_id = nr.nation
"""


@register("j5_upstream_ready", _WAITS_SQL)
def j5_upstream_ready(spark, sf_dir):
    return runs.upstream_ready(
        B.nation_runs(spark, sf_dir).select("pipeline_id", "run_ts"),
        B.nation_dependencies(spark, sf_dir),
        B.nation_upstream(spark, sf_dir),
        F.lit(_AS_OF_J5).cast("timestamp_ntz"),
    )


@register(
    "j5_start_gate",
    f"""
WITH r AS (SELECT DISTINCT c_nationkey AS pipeline_id, o_orderdate AS run_ts FROM orders JOIN customer ON o_custkey = c_custkey),
w AS (SELECT pipeline_id, run_ts, count(*) AS n_waits, count(*) FILTER (WHERE outcome = 'ready') AS n_ready,
             count(*) FILTER (WHERE outcome IN ('missing', 'timed_out')) AS lost
      FROM ({_WAITS_SQL}) WHERE dayofweek(run_ts) NOT IN (0, 6) GROUP BY 1, 2)
SELECT r.pipeline_id, r.run_ts, coalesce(n_waits, 0) AS n_waits, coalesce(n_ready, 0) AS n_ready,
       CASE WHEN coalesce(lost, 0) > 0 THEN 'failed' WHEN coalesce(n_ready, 0) = coalesce(n_waits, 0) THEN 'open' ELSE 'waiting' END AS gate
FROM r LEFT JOIN w ON w.pipeline_id = r.pipeline_id AND w.run_ts = r.run_ts
""",
)
def j5_start_gate(spark, sf_dir):
    """May each run start?  Runs on Saturdays and Sundays are ad-hoc ones."""
    r = B.nation_runs(spark, sf_dir).select("pipeline_id", "run_ts").withColumn("by_hand", F.dayofweek("run_ts").isin(1, 7))
    deps, up = B.nation_dependencies(spark, sf_dir), B.nation_upstream(spark, sf_dir)
    return runs.start_gate(r, deps, up, F.lit(_AS_OF_J5).cast("timestamp_ntz"), ad_hoc="by_hand")


@register(
    "j6_get_or_create",
    """
WITH req AS (SELECT DISTINCT 'exp-' || o_custkey AS name FROM orders),
ex AS (SELECT 'exp-' || c_custkey AS name, 'e' || c_custkey AS experiment_id,
              CASE WHEN c_acctbal < 0 THEN 'deleted' ELSE 'active' END AS lifecycle_stage
       FROM customer WHERE c_custkey % 2 = 0)
SELECT req.name, coalesce(ex.experiment_id, 'new:' || req.name) AS experiment_id,
  CASE WHEN ex.name IS NULL THEN 'created' WHEN ex.lifecycle_stage = 'deleted' THEN 'rejected' ELSE 'reused' END
    AS action
FROM req LEFT JOIN ex ON ex.name = req.name
""",
)
def j6_get_or_create(spark, sf_dir):
    o = B.table(spark, sf_dir, "orders")
    c = B.table(spark, sf_dir, "customer")
    requested = o.select(F.concat(F.lit("exp-"), F.col("o_custkey").cast("string")).alias("name"))
    existing = c.filter(F.col("c_custkey") % 2 == 0).select(
        F.concat(F.lit("exp-"), F.col("c_custkey").cast("string")).alias("name"),
        F.concat(F.lit("e"), F.col("c_custkey").cast("string")).alias("experiment_id"),
        F.when(F.col("c_acctbal") < 0, "deleted").otherwise("active").alias("lifecycle_stage"),
    )
    return runs.get_or_create(requested, existing)


@register(
    "a5_params_wide",
    """
SELECT o_orderkey AS run_id,
  CASE WHEN o_orderkey % 4 <> 0 THEN 'img-' || o_orderpriority END AS image,
  'dag-' || o_custkey AS dag_id,
  strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') AS execution_date
FROM orders
""",
)
def a5_params_wide(spark, sf_dir):
    o = B.table(spark, sf_dir, "orders")
    kv = F.struct
    long = o.select(
        F.col("o_orderkey").alias("run_id"),
        F.explode(
            F.filter(
                F.array(
                    F.when(
                        F.col("o_orderkey") % 4 != 0,
                        kv(F.lit("image").alias("key"), F.concat(F.lit("img-"), "o_orderpriority").alias("value")),
                    ),
                    kv(F.lit("dag_id").alias("key"), F.concat(F.lit("dag-"), F.col("o_custkey").cast("string")).alias("value")),
                    kv(
                        F.lit("execution_date").alias("key"),
                        F.date_format("o_orderdate", "yyyy-MM-dd HH:mm:ss").alias("value"),
                    ),
                ),
                lambda e: e.isNotNull(),
            )
        ).alias("e"),
    ).select("run_id", "e.key", "e.value")
    return runs.params_wide(long)


def _order_sets(spark, sf_dir):
    o = B.table(spark, sf_dir, "orders")
    name = F.concat(F.lit("o"), F.col("o_orderkey").cast("string")).alias("name")
    a = o.filter(F.col("o_orderpriority").isin("1-URGENT", "2-HIGH")).select(name, F.lit("pyspark").alias("group_type"))
    b = o.filter(F.col("o_orderstatus") == "F").select(name, F.lit("pyspark").alias("group_type"))
    return a, b


_SETS_SQL = """
WITH a AS (SELECT 'o' || o_orderkey AS name, 'pyspark' AS group_type FROM orders
           WHERE o_orderpriority IN ('1-URGENT', '2-HIGH')),
b AS (SELECT 'o' || o_orderkey AS name, 'pyspark' AS group_type FROM orders WHERE o_orderstatus = 'F')
"""


@register("u1_union_groups", _SETS_SQL + "SELECT * FROM a UNION SELECT * FROM b")
def u1_union_groups(spark, sf_dir):
    return sets.union_groups(*_order_sets(spark, sf_dir))


@register("u2_intersect_nodes", _SETS_SQL + "SELECT * FROM a INTERSECT SELECT * FROM b")
def u2_intersect_nodes(spark, sf_dir):
    return sets.intersect_nodes(*_order_sets(spark, sf_dir))


@register("u3_subtract_groups", _SETS_SQL + "SELECT * FROM a EXCEPT SELECT * FROM b")
def u3_subtract_groups(spark, sf_dir):
    return sets.subtract_groups(*_order_sets(spark, sf_dir))


# --------------------------------------------------------------------------
# Registry: P2, P3, P4, O1, O2.

@register(
    "p2_tags_with_prefix",
    "SELECT 'd' || doc_id AS dag_id FROM documents WHERE doc_id % 3 <> 0 AND source LIKE 'src1%'",
)
def p2_tags_with_prefix(spark, sf_dir):
    reg = B.registry(spark, sf_dir)
    return reg.filter(T.has_tag_prefix(T.tag_names("tags"), "source:src1")).select("dag_id")


@register(
    "p3_tag_value",
    """
SELECT 'd' || doc_id AS dag_id, CASE WHEN doc_id % 3 <> 0 THEN source
  WHEN doc_id % 2 = 0 THEN 'mirror-' || lang END AS source FROM documents
""",
)
def p3_tag_value(spark, sf_dir):
    reg = B.registry(spark, sf_dir)
    return reg.select("dag_id", T.tag_value(T.tag_names("tags"), "source").alias("source"))


@register(
    "p4_has_tag",
    "SELECT 'd' || doc_id AS dag_id, lang = 'en' AS is_en FROM documents",
)
def p4_has_tag(spark, sf_dir):
    reg = B.registry(spark, sf_dir)
    return reg.select("dag_id", T.has_tag(T.tag_names("tags"), "lang:en").alias("is_en"))


@register(
    "o2_first_match",
    """
SELECT 'd' || doc_id AS dag_id,
  CASE WHEN doc_id % 3 <> 0 AND doc_id % 2 = 0 THEN least('source:' || source, 'source:mirror-' || lang)
       WHEN doc_id % 3 <> 0 THEN 'source:' || source
       WHEN doc_id % 2 = 0 THEN 'source:mirror-' || lang END AS first_source
FROM documents
""",
)
def o2_first_match(spark, sf_dir):
    reg = B.registry(spark, sf_dir)
    return reg.select("dag_id", T.first_match(T.tag_names("tags"), "source:").alias("first_source"))


@register(
    "o1_list_pipelines",
    """
WITH r AS (
  SELECT 'd' || doc_id AS dag_id, lang AS name FROM documents WHERE doc_id % 3 <> 0 OR doc_id % 2 = 0)
SELECT row_number() OVER (ORDER BY name NULLS LAST, dag_id) - 1 AS position, name, dag_id FROM r
""",
)
def o1_list_pipelines(spark, sf_dir):
    return registry.list_pipelines(B.registry(spark, sf_dir), "source:", "lang")


@register(
    "p6_supported_handlers",
    """
SELECT event_id AS handler_id, 'conn-' || user_id AS connection_id,
  coalesce(CASE WHEN event_id % 2 = 0 THEN props END, 'Task failed!') AS message_template
FROM events WHERE event_type = 'error'
""",
)
def p6_supported_handlers(spark, sf_dir):
    ev = B.table(spark, sf_dir, "events")
    handlers = ev.select(
        F.col("event_id").alias("handler_id"),
        F.when(F.col("event_type") == "error", F.lit(SUPPORTED_HANDLER_TYPES[0])).otherwise(F.col("event_type")).alias("type"),
        F.concat(F.lit("conn-"), F.col("user_id").cast("string")).alias("connection_id"),
        F.when(F.col("event_id") % 2 == 0, F.col("props")).alias("message_template"),
    )
    from .constants import DEFAULT_FAILURE_MESSAGE

    return classify.supported_handlers(handlers).select(
        "handler_id", "connection_id", F.coalesce("message_template", F.lit(DEFAULT_FAILURE_MESSAGE)).alias("message_template")
    )
