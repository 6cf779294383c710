"""Registered queries: sources and sinks (S1, S2, S4, S5) and transform
chains (X1, X2 with S6, X3).  Stored copies go below the shared checkpoint
folder, one fresh folder per run."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import bindings as B
from .plans import group_run as GR
from .plans import transforms as TR
from .queries import ORACLES, register
from .functions.text import run_scoped_name
from .session import cut_lineage, scratch_path
from .sources import catalog_tables, files, staging


@register("s1_file_table_io", "SELECT * FROM orders")
def s1_file_table_io(spark, sf_dir):
    path = scratch_path(spark, "s1-orders")
    files.write_file_table(B.table(spark, sf_dir, "orders"), path, fmt="parquet")
    return files.file_table_io(spark, path, fmt="parquet")


@register("s2_metastore_table_io", "SELECT * FROM nation")
def s2_metastore_table_io(spark, sf_dir):
    """Half of the table is saved, the other half inserted; the table goes
    again, what was read from it stays."""
    name = f"ft_nation_{uuid.uuid4().hex[:12]}"
    nation = B.table(spark, sf_dir, "nation")
    odd = F.col("n_nationkey") % 2 == 1
    catalog_tables.write_metastore_table(nation.filter(odd), name, path=scratch_path(spark, name))
    catalog_tables.write_metastore_table(nation.filter(~odd), name, mode="append", insert=True)
    out = cut_lineage(catalog_tables.metastore_table_io(spark, name), "s2-nation")
    spark.sql(f"DROP TABLE {name}")
    return out


@register("s2_metastore_table_io_orders", "SELECT * FROM orders")
def s2_metastore_table_io_orders(spark, sf_dir):
    """The same on a table that grows with the data."""
    name = f"ft_orders_{uuid.uuid4().hex[:12]}"
    orders = B.table(spark, sf_dir, "orders")
    odd = F.coalesce(F.col("o_orderkey") % 2 == 1, F.lit(False))
    catalog_tables.write_metastore_table(orders.filter(odd), name, path=scratch_path(spark, name))
    catalog_tables.write_metastore_table(orders.filter(~odd), name, mode="append", insert=True)
    out = cut_lineage(catalog_tables.metastore_table_io(spark, name), "s2-orders")
    spark.sql(f"DROP TABLE {name}")
    return out


@register("s4_csv_table_io", "SELECT * FROM documents")
def s4_csv_table_io(spark, sf_dir):
    """Whole documents: quotes, separators, line breaks and empty texts come back as they were."""
    docs = B.table(spark, sf_dir, "documents")
    path = scratch_path(spark, "s4-documents")
    files.write_csv_table(docs, path)
    return files.csv_table_io(spark, path, docs.schema)


STAGED = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()


@register(
    "s5_stage_run_inputs",
    " UNION ALL ".join(f"SELECT '{t}' AS \"table\", count(*) AS n_rows FROM {t}" for t in STAGED),
)
def s5_stage_run_inputs(spark, sf_dir):
    when = F.lit("2024-01-02 03:04:05").cast("timestamp_ntz")
    name = spark.range(1).select(run_scoped_name(F.lit("Driver tables"), when)).first()[0]
    area = f"{scratch_path(spark, 'areas')}/{name}"
    return staging.stage_run_inputs(spark, sf_dir, area, STAGED).select("table", "n_rows")


# --------------------------------------------------------------------------
# Transform chain: revenue by nation in four steps.

def _line_revenue(lineitem: DataFrame) -> DataFrame:
    price = F.col("l_extendedprice").cast("decimal(12,2)") * (F.lit(1) - F.col("l_discount").cast("decimal(4,2)"))
    return lineitem.filter(F.col("l_returnflag") != "R").groupBy("l_orderkey").agg(F.sum(price).alias("revenue"))


def _order_revenue(line_revenue: DataFrame, orders: DataFrame) -> DataFrame:
    return (
        line_revenue.join(orders, line_revenue.l_orderkey == orders.o_orderkey)
        .groupBy("o_custkey")
        .agg(F.sum("revenue").alias("revenue"))
    )


def _customer_revenue(order_revenue: DataFrame, customer: DataFrame) -> DataFrame:
    return (
        order_revenue.join(customer, order_revenue.o_custkey == customer.c_custkey)
        .groupBy("c_nationkey")
        .agg(F.sum("revenue").alias("revenue"), F.count(F.lit(1)).alias("n_customers"))
    )


def _nation_revenue(customer_revenue: DataFrame, nation: DataFrame) -> DataFrame:
    return customer_revenue.join(nation, customer_revenue.c_nationkey == nation.n_nationkey).select(
        "n_nationkey", "n_name", F.col("revenue").cast("double").alias("revenue"), "n_customers"
    )


REVENUE_STEPS = (
    TR.step("line_revenue", _line_revenue, ["lineitem"], ["line_revenue"]),
    TR.step("order_revenue", _order_revenue, ["line_revenue", "orders"], ["order_revenue"]),
    TR.step("customer_revenue", _customer_revenue, ["order_revenue", "customer"], ["customer_revenue"]),
    TR.step("nation_revenue", _nation_revenue, ["customer_revenue", "nation"], ["nation_revenue"]),
)

_REVENUE_SQL = """
WITH lr AS (
  SELECT l_orderkey, sum(CAST(l_extendedprice AS DECIMAL(12,2)) * (1 - CAST(l_discount AS DECIMAL(4,2)))) AS revenue
  FROM lineitem WHERE l_returnflag <> 'R' GROUP BY l_orderkey),
cr AS (SELECT o_custkey, sum(revenue) AS revenue FROM lr JOIN orders ON o_orderkey = l_orderkey GROUP BY o_custkey),
nr AS (SELECT c_nationkey, sum(revenue) AS revenue, count(*) AS n_customers
       FROM cr JOIN customer ON c_custkey = o_custkey GROUP BY c_nationkey)
SELECT n_nationkey, n_name, CAST(revenue AS DOUBLE) AS revenue, n_customers
FROM nr JOIN nation ON n_nationkey = c_nationkey
"""


def _revenue_inputs(spark, sf_dir):
    return {t: B.table(spark, sf_dir, t) for t in ("lineitem", "orders", "customer", "nation")}


@register("x1_run_fused", _REVENUE_SQL)
def x1_run_fused(spark, sf_dir):
    return TR.run_fused(REVENUE_STEPS, _revenue_inputs(spark, sf_dir))["nation_revenue"]


@register("x2_run_materialised", _REVENUE_SQL)
def x2_run_materialised(spark, sf_dir):
    area = scratch_path(spark, "x2-area")
    return TR.run_materialised(REVENUE_STEPS, _revenue_inputs(spark, sf_dir), area)["nation_revenue"]


def _top_customers(order_revenue: DataFrame, customer: DataFrame) -> DataFrame:
    """The best customer of each nation, of equal revenues the smallest key."""
    best = F.max_by(F.struct("c_custkey", "revenue"), F.struct("revenue", -F.col("c_custkey")))
    named = order_revenue.join(customer, F.col("o_custkey") == F.col("c_custkey"))
    return named.groupBy("c_nationkey").agg(best.alias("b")).select(
        "c_nationkey", "b.c_custkey", F.col("b.revenue").cast("double").alias("top_revenue")
    )


def _nation_report(nation_revenue: DataFrame, top_customers: DataFrame) -> DataFrame:
    return nation_revenue.join(top_customers, F.col("n_nationkey") == F.col("c_nationkey")).drop("c_nationkey")


def _unused(lineitem: DataFrame) -> DataFrame:
    raise ValueError("nobody asked for this dataset")


@register(
    "x1_run_fused_outputs",
    _REVENUE_SQL.split("SELECT n_nationkey")[0].rstrip() + """,
best AS (SELECT c_nationkey, c_custkey, CAST(cr.revenue AS DOUBLE) AS top_revenue FROM cr JOIN customer ON c_custkey = o_custkey
         QUALIFY row_number() OVER (PARTITION BY c_nationkey ORDER BY cr.revenue DESC, c_custkey) = 1)
SELECT n_nationkey, n_name, CAST(revenue AS DOUBLE) AS revenue, n_customers, c_custkey, top_revenue
FROM nr JOIN nation ON n_nationkey = c_nationkey JOIN best ON best.c_nationkey = n_nationkey
""",
)
def x1_run_fused_outputs(spark, sf_dir):
    """One requested output of a forked chain: what both branches read is made once, a step nobody asked for does not run."""
    steps = (
        *REVENUE_STEPS,
        TR.step("top_customers", _top_customers, ["order_revenue", "customer"], ["top_customers"]),
        TR.step("nation_report", _nation_report, ["nation_revenue", "top_customers"], ["nation_report"]),
        TR.step("unused", _unused, ["lineitem"], ["unused"]),
    )
    return TR.run_fused(steps, _revenue_inputs(spark, sf_dir), outputs=["nation_report"])["nation_report"]


@register("x1_run_by_groups", ORACLES["x1_run_fused_outputs"])
def x1_run_by_groups(spark, sf_dir):
    """The forked chain in three groups of two steps: fused inside a group, only what crosses groups is stored."""
    steps = (
        *REVENUE_STEPS,
        TR.step("top_customers", _top_customers, ["order_revenue", "customer"], ["top_customers"]),
        TR.step("nation_report", _nation_report, ["nation_revenue", "top_customers"], ["nation_report"]),
    )
    rows = [(GR.PIPELINE, s.name, g) for s, g in zip(steps, ("sales", "sales", "customers", "report", "customers", "report"), strict=True)]
    groups = spark.createDataFrame(rows, "pipeline string, node string, group_name string")
    area = scratch_path(spark, "x1-groups")
    return GR.run_by_groups(spark, steps, _revenue_inputs(spark, sf_dir), groups, area)["nation_report"]


def _daily_counts(rows: DataFrame) -> DataFrame:
    return rows.groupBy("ds", "event_type").agg(
        F.count(F.lit(1)).alias("n_events"),
        F.sum(F.col("value").cast("decimal(12,2)")).cast("double").alias("total_value"),
    )


@register(
    "x3_run_for_date",
    """
SELECT strftime(ts, '%Y-%m-%d') AS ds, event_type, count(*) AS n_events,
       CAST(sum(CAST(value AS DECIMAL(12,2))) AS DOUBLE) AS total_value
FROM events GROUP BY 1, 2
""",
)
def x3_run_for_date(spark, sf_dir):
    """All dates in one job, then the first date again, first without rows
    (its partition is emptied) and then with them: a re-run replaces that
    date's partition and leaves the others alone."""
    events = B.table(spark, sf_dir, "events")
    sink = scratch_path(spark, "x3-daily")
    TR.run_for_date(_daily_counts, events, "ts", None, sink)
    first_day = "2024-01-01"
    TR.run_for_date(_daily_counts, events.filter(F.col("value") < 0), "ts", first_day, sink)
    out = TR.run_for_date(_daily_counts, events, "ts", first_day, sink)
    return out.select(F.col("ds").cast("string").alias("ds"), "event_type", "n_events", "total_value")
