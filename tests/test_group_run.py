"""Chains run group by group: same rows as fused, only boundaries on disk, resumable."""

import pytest
from pyspark.sql import functions as F

from flowtables.plans import group_run as GR
from flowtables.plans import transforms as TR
from flowtables.session import list_folder, scratch_path


def _chain(calls, broken=()):
    def named(name, func):
        def run(*dfs):
            calls.append(name)
            if name in broken:
                raise RuntimeError(name)
            return func(*dfs)

        return run

    def add(col):
        return lambda df: df.withColumn(col, F.col("x") + len(col))

    return (
        TR.step("a", named("a", add("a")), ["raw"], ["da"]),
        TR.step("b", named("b", add("bb")), ["da"], ["db"]),
        TR.step("c", named("c", add("ccc")), ["db"], ["dc"]),
        TR.step("d", named("d", lambda l, r: l.join(r.select("x", "ccc"), "x")), ["db", "dc"], ["dd"]),
        TR.step("e", named("e", lambda l: l.groupBy((F.col("x") % 3).alias("k")).agg(F.sum("ccc").alias("s"))), ["dd"], ["de"]),
    )


def _groups(spark, **of):
    return spark.createDataFrame([(GR.PIPELINE, n, g) for n, g in of.items()], "pipeline string, node string, group_name string")


def _rows(df):
    return sorted(map(tuple, df.collect()))


def test_equals_the_fused_run_and_stores_boundaries_only(spark):
    raw = {"raw": spark.range(50).withColumnRenamed("id", "x")}
    groups = _groups(spark, a="one", b="one", c="two/3", d="two/3")  # e is a group of its own
    area = scratch_path(spark, "groups-test")
    calls = []
    got = GR.run_by_groups(spark, _chain(calls), raw, groups, area)
    assert set(got) == {"de"} and _rows(got["de"]) == _rows(TR.run_fused(_chain([]), raw)["de"])
    assert calls == ["a", "b", "c", "d", "e"]
    assert sorted(list_folder(spark, area)) == ["_manifest", "db", "dd", "de"]


def test_goes_on_after_the_last_finished_group(spark):
    raw = {"raw": spark.range(50).withColumnRenamed("id", "x")}
    groups = _groups(spark, a="one", b="one", c="two", d="two", e="three")
    area = scratch_path(spark, "groups-test")
    calls = []
    with pytest.raises(RuntimeError):
        GR.run_by_groups(spark, _chain(calls, broken=("d",)), raw, groups, area)
    assert calls == ["a", "b", "c", "d"]
    calls.clear()
    got = GR.run_by_groups(spark, _chain(calls), raw, groups, area)
    assert calls == ["c", "d", "e"]
    assert _rows(got["de"]) == _rows(TR.run_fused(_chain([]), raw)["de"])
    # A first group with another output runs again, and with it all that is made from it.
    calls.clear()
    GR.run_by_groups(spark, _chain(calls), raw, groups, area, outputs=["da", "de"])
    assert calls == ["a", "b", "c", "d", "e"]
    calls.clear()
    GR.run_by_groups(spark, _chain(calls), raw, groups, area, outputs=["da", "de"])
    assert calls == []


def test_requested_outputs_and_given_datasets(spark):
    raw = spark.range(5).withColumnRenamed("id", "x")
    groups = _groups(spark, a="one", b="two", c="two")
    calls = []
    got = GR.run_by_groups(spark, _chain(calls), {"raw": raw}, groups, scratch_path(spark, "groups-test"), outputs=["db", "raw"])
    assert calls == ["a", "b"] and got["raw"] is raw and got["db"].count() == 5
    calls.clear()
    got = GR.run_by_groups(spark, _chain(calls), {"da": raw}, groups, scratch_path(spark, "groups-test"), outputs=["db"])
    assert calls == ["b"] and got["db"].columns == ["x", "bb"]
    assert GR.run_by_groups(spark, _chain(calls), {"raw": raw}, groups, "unused", outputs=["raw"]) == {"raw": raw}


def test_groups_that_need_each_other(spark):
    raw = {"raw": spark.range(5).withColumnRenamed("id", "x")}
    groups = _groups(spark, a="one", b="two", c="one", d="two", e="two")
    with pytest.raises(ValueError, match="wait for each other"):
        GR.run_by_groups(spark, _chain([]), raw, groups, scratch_path(spark, "groups-test"))
