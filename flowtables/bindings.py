"""Driver tables → pipeline tables.

Every pipeline table used by the registered queries is derived here, with
Spark, from the parquet tables in ``sf_dir``; sizes grow with the scale
factor.  The derivations are the ones written down in FIXTURES.md §3.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .constants import RESOURCES_PREFIX, SPARK_FRAME_CLASS, SPARK_GROUP_TAG
from .operators.classify import ROLE_IN, ROLE_OUT
from .session import cut_lineage

LAYERED = "layered"
BIPARTITE = "bipartite"
PANDAS_FRAME_CLASS = "pandas.core.frame.DataFrame"
#: Rows of a large table that one task sorts and aggregates, about: its memory then does not grow with the table.
TASK_ROWS = 1 << 18


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _name(prefix: str, key: str) -> Column:
    return F.concat(F.lit(prefix), F.col(key).cast("string"))


def _no_nulls(*cols: Column) -> Column:
    return F.filter(F.array(*cols), lambda x: x.isNotNull())


def _tasks(df: DataFrame) -> int:
    """Tasks for the rows of a stored table (counted from its files' footers)."""
    return max(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-df.count() // TASK_ROWS))


def layered_dag(spark: SparkSession, sf_dir: str, marks: str = "sparse", store_io: bool = False):
    """Pipeline ``layered``: part → order → customer → nation.

    Returns ``(nodes, node_io, catalog)``.  Spark marks come from all the
    rules of P1: parts by the group tag, orders by the return hint,
    customers by a parameter hint, and (``marks='dense'``) nations by the
    class of their output dataset in the catalog.
    """
    part = table(spark, sf_dir, "part")
    orders = table(spark, sf_dir, "orders")
    customer = table(spark, sf_dir, "customer")
    nation = table(spark, sf_dir, "nation")
    lineitem = table(spark, sf_dir, "lineitem")
    empty = F.array().cast("array<string>")
    pipe = F.lit(LAYERED).alias("pipeline")

    part_nodes = part.select(
        pipe,
        _name("p", "p_partkey").alias("node"),
        _no_nulls(
            F.when((F.col("p_type") == "PROMO") & (F.col("p_size") <= 5), F.lit(SPARK_GROUP_TAG)),
            F.when(F.col("p_size") != 1, F.concat(F.lit(RESOURCES_PREFIX), F.col("p_brand"))),
        ).alias("tags"),
        empty.alias("param_types"),
        F.lit(None).cast("string").alias("return_type"),
    )
    order_nodes = orders.select(
        pipe,
        _name("o", "o_orderkey").alias("node"),
        empty.alias("tags"),
        empty.alias("param_types"),
        F.when(F.col("o_orderpriority") == "1-URGENT", F.lit(SPARK_FRAME_CLASS))
        .otherwise(F.lit(PANDAS_FRAME_CLASS))
        .alias("return_type"),
    )
    customer_nodes = customer.select(
        pipe,
        _name("c", "c_custkey").alias("node"),
        empty.alias("tags"),
        F.array(
            F.when(F.col("c_mktsegment") == "BUILDING", F.lit(SPARK_FRAME_CLASS)).otherwise(
                F.lit(PANDAS_FRAME_CLASS)
            )
        ).alias("param_types"),
        F.lit(None).cast("string").alias("return_type"),
    )
    nation_nodes = nation.select(
        pipe,
        _name("n", "n_nationkey").alias("node"),
        empty.alias("tags"),
        empty.alias("param_types"),
        F.lit(None).cast("string").alias("return_type"),
    )
    nodes = part_nodes.unionByName(order_nodes).unionByName(customer_nodes).unionByName(nation_nodes)

    def io(df: DataFrame, node: Column, dataset: Column, role: str) -> DataFrame:
        return df.select(pipe, node.alias("node"), dataset.alias("dataset"), F.lit(role).alias("role"))

    # Both sides dealt by order to as many tasks as the rows ask for; join and distinct follow without a further shuffle.
    tasks = _tasks(lineitem)
    order_parts = (
        lineitem.select(F.col("l_orderkey").alias("o_orderkey"), "l_partkey")
        .repartition(tasks, "o_orderkey")
        .join(orders.select("o_orderkey").repartition(tasks, "o_orderkey"), "o_orderkey", "left_semi")
        .distinct()
    )
    node_io = (
        io(part, _name("p", "p_partkey"), _name("dp", "p_partkey"), ROLE_OUT)
        .unionByName(io(order_parts, _name("o", "o_orderkey"), _name("dp", "l_partkey"), ROLE_IN))
        .unionByName(io(orders, _name("o", "o_orderkey"), _name("do", "o_orderkey"), ROLE_OUT))
        .unionByName(io(orders, _name("c", "o_custkey"), _name("do", "o_orderkey"), ROLE_IN))
        .unionByName(io(customer, _name("c", "c_custkey"), _name("dc", "c_custkey"), ROLE_OUT))
        .unionByName(io(customer, _name("n", "c_nationkey"), _name("dc", "c_custkey"), ROLE_IN))
        .unionByName(io(nation, _name("n", "n_nationkey"), _name("dn", "n_nationkey"), ROLE_OUT))
    )
    if store_io:
        # For plans that read node_io several times (marks, edges, catalog).
        node_io = cut_lineage(node_io, "node-io")
    catalog = (
        node_io.filter(F.col("role") == ROLE_OUT)
        .select(
            "dataset",
            F.when((F.lit(marks == "dense")) & F.col("dataset").startswith("dn"), F.lit("SparkDataSet"))
            .otherwise(F.lit("CSVDataSet"))
            .alias("type"),
        )
        .withColumn("location", F.concat(F.lit("data/"), F.col("dataset"), F.lit(".csv")))
    )
    return nodes, node_io, catalog


def order_part_links(spark: SparkSession, sf_dir: str, *more: Column) -> DataFrame:
    """Whole order–part graph ``(pipeline, parent, child)``: every distinct pair of lineitem (and of ``more``)."""
    return (
        table(spark, sf_dir, "lineitem")
        .select(F.lit(BIPARTITE).alias("pipeline"), _name("o", "l_orderkey").alias("parent"), _name("p", "l_partkey").alias("child"), *more)
        .distinct()
    )


# --------------------------------------------------------------------------
# Run-state tables.

RUN_STATE = {"F": "failed", "O": "success", "P": "running"}


def _case(col: str, mapping: dict) -> Column:
    out = None
    for k, v in mapping.items():
        out = (F.when(F.col(col) == k, F.lit(v)) if out is None else out.when(F.col(col) == k, F.lit(v)))
    return out


def runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """orders → ``(pipeline_id, run_id, execution_ts, state)``."""
    return table(spark, sf_dir, "orders").select(
        F.col("o_custkey").alias("pipeline_id"),
        F.col("o_orderkey").alias("run_id"),
        F.col("o_orderdate").alias("execution_ts"),
        _case("o_orderstatus", RUN_STATE).alias("state"),
    )


def task_states(spark: SparkSession, sf_dir: str) -> DataFrame:
    """lineitem → ``(run_id, task_id, ts, state)``; repeated keys are attempts."""
    rf, ls = F.col("l_returnflag"), F.col("l_linestatus")
    state = (
        F.when(rf == "R", "failed")
        .when(rf == "A", "success")
        .when((rf == "N") & (ls == "O"), "running")
        .when((rf == "N") & (ls == "F"), "skipped")
    )
    return table(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").alias("run_id"),
        F.col("l_linenumber").alias("task_id"),
        F.col("l_shipdate").alias("ts"),
        state.alias("state"),
    )


EVENT_STATE = {"error": "failed", "purchase": "success", "signup": "skipped", "view": "running", "click": "running"}


def observations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """events → ``(run_id, ts, state, event_id)``."""
    return table(spark, sf_dir, "events").select(
        F.col("user_id").alias("run_id"), "ts", _case("event_type", EVENT_STATE).alias("state"), "event_id"
    )


def kv(spark: SparkSession, sf_dir: str) -> DataFrame:
    """events → keyed hand-off ``(run_id, key, value, ts)``."""
    return table(spark, sf_dir, "events").select(
        F.col("user_id").alias("run_id"), F.col("event_type").alias("key"), F.col("props").alias("value"), "ts", "event_id"
    )


def nation_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """orders ⋈ customer → distinct ``(pipeline_id = nation, run_ts)`` with
    the run's state (failed if any order failed, else running if any runs,
    else success) and finish time (12 hours per order)."""
    o = table(spark, sf_dir, "orders")
    c = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    joined = o.join(c, o.o_custkey == c.c_custkey)
    return joined.groupBy(F.col("c_nationkey").alias("pipeline_id"), F.col("o_orderdate").alias("run_ts")).agg(
        F.when(F.bool_or(F.col("o_orderstatus") == "F"), "failed")
        .when(F.bool_or(F.col("o_orderstatus") == "P"), "running")
        .otherwise("success")
        .alias("state"),
        (F.col("o_orderdate") + F.make_dt_interval(hours=F.count(F.lit(1)) * 12)).alias("finished_ts"),
    ).withColumn("task_id", F.lit(None).cast("string"))


def nation_upstream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What dependencies look at: the runs, and a task per order priority of
    each run, in two attempts where it had failed orders (the second one a
    day later and successful)."""
    o = table(spark, sf_dir, "orders")
    c = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    tasks = o.join(c, o.o_custkey == c.c_custkey).groupBy(
        F.col("c_nationkey").alias("pipeline_id"), F.col("o_orderdate").alias("run_ts"), F.col("o_orderpriority").alias("task_id")
    ).agg(F.bool_or(F.col("o_orderstatus") == "F").alias("_failed"))
    first = tasks.select(
        "pipeline_id", "run_ts", F.when(F.col("_failed"), "failed").otherwise("success").alias("state"),
        (F.col("run_ts") + F.make_dt_interval(hours=F.lit(6))).alias("finished_ts"), "task_id",
    )
    again = tasks.filter("_failed").select(
        "pipeline_id", "run_ts", F.lit("success").alias("state"),
        (F.col("run_ts") + F.make_dt_interval(hours=F.lit(30))).alias("finished_ts"), "task_id",
    )
    return nation_runs(spark, sf_dir).unionByName(first).unionByName(again)


def nation_dependencies(spark: SparkSession, sf_dir: str) -> DataFrame:
    """nation → upstream dependencies, one day earlier, default wait of 1440
    minutes: the next nation; its urgent task; and, for every third nation, a
    pipeline and a task that do not exist.  Existence is checked except for
    every fifth nation."""
    n = table(spark, sf_dir, "nation")
    nxt = ((F.col("n_nationkey") + 1) % 25).cast("int")
    dep = lambda pipeline, task: F.struct(pipeline.alias("p"), task.alias("t"))
    none = F.lit(None).cast("string")
    some = F.array(dep(nxt, none), dep(nxt, F.lit("1-URGENT")))
    more = F.array(dep((F.col("n_nationkey") + 1000).cast("int"), none), dep(nxt, F.lit("no-such-task")))
    wanted = F.when(F.col("n_nationkey") % 3 == 0, F.concat(some, more)).otherwise(some)
    return n.select(F.col("n_nationkey"), F.explode(wanted).alias("d")).select(
        F.col("n_nationkey").alias("pipeline_id"),
        F.col("d.p").alias("up_pipeline_id"),
        F.col("d.t").alias("up_task_id"),
        (F.col("n_nationkey") % 5 != 0).alias("check_existence"),
        F.lit(1440).alias("execution_delta_min"),
        F.lit(1440).alias("timeout_min"),
    )


def registry(spark: SparkSession, sf_dir: str) -> DataFrame:
    """documents → ``(dag_id, tags ARRAY<STRUCT<name>>)``: ``lang:``,
    ``source:`` (dropped on every third row) and, on even rows, a mirror
    ``source:mirror-<lang>``."""
    d = table(spark, sf_dir, "documents")
    tag = lambda c: F.struct(c.alias("name"))
    tags = F.filter(
        F.array(
            tag(F.concat(F.lit("lang:"), F.col("lang"))),
            F.when(F.col("doc_id") % 3 != 0, tag(F.concat(F.lit("source:"), F.col("source")))),
            F.when(F.col("doc_id") % 2 == 0, tag(F.concat(F.lit("source:mirror-"), F.col("lang")))),
        ),
        lambda t: t.isNotNull(),
    )
    return d.select(F.concat(F.lit("d"), F.col("doc_id").cast("string")).alias("dag_id"), tags.alias("tags"))


def settings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """customer → ``(c_custkey, c_mktsegment, c_nationkey, conf MAP)``:
    ``experiment_name`` = c_name; ``run_name`` = c_mktsegment, absent when
    c_custkey % 3 = 0 and null when = 1; ``acctbal`` in cents."""
    c = table(spark, sf_dir, "customer")
    k = F.col("c_custkey") % 3
    entries = F.filter(
        F.array(
            F.struct(F.lit("experiment_name").alias("key"), F.col("c_name").alias("value")),
            F.when(
                k != 0,
                F.struct(
                    F.lit("run_name").alias("key"),
                    F.when(k == 1, F.lit(None).cast("string")).otherwise(F.col("c_mktsegment")).alias("value"),
                ),
            ),
            F.struct(
                F.lit("acctbal").alias("key"),
                F.round(F.col("c_acctbal") * 100).cast("bigint").cast("string").alias("value"),
            ),
        ),
        lambda e: e.isNotNull(),
    )
    return c.select("c_custkey", "c_mktsegment", "c_nationkey", F.map_from_entries(entries).alias("conf"))
