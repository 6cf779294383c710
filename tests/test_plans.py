"""Plan checks: filters reach the Parquet scan, only needed columns are read."""

from pyspark.sql import functions as F

from conftest import SF_SMALL
from flowtables import bindings as B
from flowtables.plans import transforms as TR
from flowtables.session import scratch_path
from flowtables.sources import files
from test_oracle import explain


def test_file_dataset_pushes_filter_and_prunes(spark):
    df = files.file_table_io(spark, f"{SF_SMALL}/orders.parquet").filter(F.col("o_orderstatus") == "F").select("o_orderkey")
    plan = explain(df)
    assert "PushedFilters: [IsNotNull(o_orderstatus), EqualTo(o_orderstatus,F)]" in plan
    assert "ReadSchema: struct<o_orderkey:bigint,o_orderstatus:string>" in plan


def test_one_date_run_reads_one_day(spark):
    events = B.table(spark, SF_SMALL, "events")
    seen = {}

    def transform(rows):
        seen["plan"] = explain(rows)
        return rows.groupBy("ds").agg(F.count(F.lit(1)).alias("n"))

    out = TR.run_for_date(transform, events, "ts", "2024-01-05", scratch_path(spark, "plan-x3"))
    assert "GreaterThanOrEqual(ts,2024-01-05T00:00)" in seen["plan"]
    assert "LessThan(ts,2024-01-06T00:00)" in seen["plan"]
    assert out.count() == 1


def test_order_parts_are_dealt_by_their_rows(spark, monkeypatch):
    """A task joins and aggregates a bounded number of lineitem rows, however many there are."""
    path = scratch_path(spark, "plan-dealt")
    made = {
        "part": "id AS p_partkey, 'STD' AS p_type, 1 AS p_size, 'b' AS p_brand",
        "orders": "nullif(id,7L) AS o_orderkey, id % 9 AS o_custkey, '5-LOW' AS o_orderpriority",
        "customer": "id AS c_custkey, 0 AS c_nationkey, 'BUILDING' AS c_mktsegment",
        "nation": "id AS n_nationkey",
    }
    for name, cols in made.items():
        spark.range(600).selectExpr(*cols.split(", ")).write.parquet(f"{path}/{name}.parquet")
    lines = "IF(id % 50 = 0, NULL, id % 700) AS l_orderkey", "IF(id % 31 = 0, NULL, id % 11) AS l_partkey"
    spark.range(4000).selectExpr(*lines).write.parquet(f"{path}/lineitem.parquet")
    monkeypatch.setattr(B, "TASK_ROWS", 200)
    _, io, _ = B.layered_dag(spark, path)
    read = io.filter("role = 'in' AND node LIKE 'o%'")
    held = [r["count"] for r in read.groupBy(F.spark_partition_id()).count().collect()]
    assert len(held) > 10 and max(held) <= 400
    keys = ((None if i % 50 == 0 else i % 700, None if i % 31 == 0 else i % 11) for i in range(4000))
    want = {(f"o{o}", None if p is None else f"dp{p}") for o, p in keys if o is not None and o < 600 and o != 7}
    assert sorted(map(str, want)) == sorted(str((r.node, r.dataset)) for r in read.collect())
