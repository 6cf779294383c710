"""Quirks of the rebuilt behaviour, each pinned by a unit test."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from flowtables.constants import VAR_PREFIX
from flowtables.functions import dates as D
from flowtables.functions import settings as S
from flowtables.functions import tags as T
from flowtables.functions import text as X
from flowtables.operators import lookup, registry, runs


def one(spark, df_expr, schema, rows):
    df = spark.createDataFrame(rows, schema)
    return [r[0] for r in df.select(df_expr).collect()]


def test_missing_key_takes_default_but_null_stays(spark):
    df = spark.createDataFrame([({"a": "1"},), ({"a": None},), ({},)], "m map<string,string>")
    got = [r.v for r in df.select(S.setting("m", "a", "dflt").alias("v")).collect()]
    assert got == ["1", None, "dflt"]


def test_required_key_report_and_strict(spark):
    df = spark.createDataFrame([(1, {"a": None}), (2, {})], "id int, m map<string,string>")
    rows = S.missing_keys(df, "id", "m", ["a"], prefix="run_config.").collect()
    assert [(r.id, r.message) for r in rows] == [(2, "Missing required configuration: 'run_config.a'.")]
    with pytest.raises(Exception, match="Missing required configuration"):
        df.select(S.required("m", "a", "run_config.")).collect()
    assert df.filter("id = 1").select(S.required("m", "a")).collect()[0][0] is None


def test_dependent_default_needs_other_even_when_set(spark):
    df = spark.createDataFrame([({"experiment_name": "e", "run_name": "r"},), ({"experiment_name": "e"},)], "m map<string,string>")
    assert [r[0] for r in df.select(S.dependent_default("m", "run_name", "experiment_name")).collect()] == ["r", "e"]
    bad = spark.createDataFrame([({"run_name": "r"},)], "m map<string,string>")
    with pytest.raises(Exception, match="experiment_name"):
        bad.select(S.dependent_default("m", "run_name", "experiment_name")).collect()


def test_truthiness(spark):
    assert one(spark, S.truthy_or_empty("s"), "s string", [(None,), ("",), ("0",), ("x",)]) == ["", "", "0", "x"]
    assert one(spark, S.truthy_or_empty_number("n"), "n int", [(None,), (0,), (3,)]) == ["", "", "3"]
    assert one(spark, S.first_set("a", "b", default="d"), "a string, b string", [("", "x"), (None, ""), ("y", "x")]) == [
        "x",
        "d",
        "y",
    ]


def test_tag_prefix_and_value(spark):
    rows = [(["experiment_name:my-exp", "commit_sha:abc"],), (["commit_sha:abc"],), (None,)]
    df = spark.createDataFrame(rows, "tags array<string>")
    got = df.select(
        T.has_tag_prefix("tags", "experiment_name").alias("p"),
        T.tag_value("tags", "experiment_name").alias("v"),
        T.has_tag("tags", "commit_sha:abc").alias("h"),
        T.first_match("tags", "c").alias("f"),
    ).collect()
    assert [tuple(r) for r in got] == [
        (True, "my-exp", True, "commit_sha:abc"),
        (False, None, True, "commit_sha:abc"),
        (False, None, False, None),
    ]


def test_listing_puts_missing_names_last(spark):
    reg = spark.createDataFrame(
        [("d2", [{"name": "generated_with_x:1"}]), ("d1", [{"name": "generated_with_x:1"}, {"name": "experiment_name:b"}]),
         ("d3", [{"name": "generated_with_x:1"}, {"name": "experiment_name:a"}]), ("d4", [{"name": "other"}])],
        "dag_id string, tags array<struct<name:string>>",
    )
    out = registry.list_pipelines(reg, "generated_with", "experiment_name").orderBy("position")
    got = [(r.position, r.name, r.dag_id) for r in out.collect()]
    assert got == [(0, "a", "d3"), (1, "b", "d1"), (2, None, "d2")]


def test_slugify(spark):
    got = one(spark, X.slugify("s"), "s string", [("Ça  va, Straße!",), ("--Æther_Œuvre--",), ("[Test] local",)])
    assert got == ["ca-va-strasse", "aether-oeuvre", "test-local"]
    ts = dt.datetime(2024, 1, 2, 3, 4, 5)
    df = spark.createDataFrame([("My Project", ts)], "p string, t timestamp_ntz")
    assert df.select(X.run_scoped_name("p", "t")).first()[0] == "my-project.20240102t030405"


def test_params_round_trip_keeps_colons(spark):
    df = spark.createDataFrame([({"ds": "2024-01-01", "ts": "2024-01-01 10:11:12"},)], "m map<string,string>")
    text = df.select(X.render_params("m").alias("t")).first().t
    assert text == "ds:2024-01-01,ts:2024-01-01 10:11:12"
    padded = spark.createDataFrame([("\n    ds:2024-01-01,\n    ts:2024-01-01 10:11:12,\n  ",)], "t string")
    back = padded.select(X.parse_params("t").alias("m")).first().m
    assert back == {"ds": "2024-01-01", "ts": "2024-01-01 10:11:12"}


def test_substitute_placeholders(spark):
    df = spark.createDataFrame(
        [("img/${commit_id|dirty}:${branch_name|local}/${x}", {"commit_id": "abc", "branch_name": None}),
         ("${a$b|d}", {})],
        "t string, v map<string,string>",
    )
    got = [r[0] for r in df.select(X.substitute("t", "v")).collect()]
    assert got == ["img/abc:local/${x}", "d"]
    df2 = spark.createDataFrame([("v=${k|0} $", "a$1\\")], "t string, k string")
    assert df2.select(X.substitute("t", {"k": F.col("k")})).first()[0] == "v=a$1\\ $"


def test_prefixed_vars(spark):
    env = {VAR_PREFIX + "COMMIT_ID": "c1", "OTHER": "x", VAR_PREFIX + "A_" + VAR_PREFIX + "B": "y"}
    df = spark.createDataFrame([(env,)], "m map<string,string>")
    got = df.select(X.prefixed_vars("m").alias("v")).first().v
    assert got == {"commit_id": "c1", "branch_name": None, "a_b": "y"}


def test_start_date(spark):
    df = spark.createDataFrame([("20240102",), (None,), ("",)], "s string")
    got = [r[0] for r in df.select(D.start_date("s", F.lit("2024-06-01"))).collect()]
    assert got == [dt.date(2024, 1, 2), dt.date(2024, 5, 30), dt.date(2024, 5, 30)]


def test_run_calendar_presets(spark):
    df = spark.createDataFrame([(dt.datetime(2024, 1, 3, 10),)], "s timestamp_ntz")
    as_of = F.lit("2024-01-20 00:00:00")
    weekly = [r.run_ts for r in D.run_calendar(df, "s", "@weekly", as_of).collect()]
    # Sundays on or after the start whose week has ended by as_of.
    assert [t.date() for t in weekly] == [dt.date(2024, 1, 7)]
    daily = D.run_calendar(df, "s", "@daily", as_of).count()
    assert daily == 16  # Jan 4 .. Jan 19
    with pytest.raises(ValueError):
        D.run_calendar(df, "s", "0 * * * *", as_of)


def test_poll_outcome_cases(spark):
    t0 = dt.datetime(2024, 1, 1)
    obs = spark.createDataFrame(
        [
            (1, t0 + dt.timedelta(minutes=5), "running"),
            (1, t0 + dt.timedelta(minutes=9), "queued"),
            (1, t0 + dt.timedelta(minutes=20), "success"),
            (2, t0 + dt.timedelta(minutes=5), "running"),
            (2, t0 + dt.timedelta(minutes=90), "success"),
            (4, t0 + dt.timedelta(minutes=1), "failed"),
        ],
        "run_id int, ts timestamp_ntz, state string",
    )
    starts = spark.createDataFrame([(i, t0) for i in (1, 2, 3, 4)], "run_id int, start_ts timestamp_ntz")
    got = {r.run_id: r.outcome for r in runs.poll_outcome(obs, starts, 60).collect()}
    assert got == {1: "queued", 2: None, 3: "unknown", 4: "failed"}
    zero = {r.run_id: r.outcome for r in runs.poll_outcome(obs, starts, 0).collect()}
    assert set(zero.values()) == {"unknown"}


def test_run_rollup_cases(spark):
    runs_df = spark.createDataFrame([(1, "success"), (2, "success"), (3, "running"), (4, None), (5, "queued")], "run_id int, state string")
    tasks = spark.createDataFrame([(1, "a", "success"), (1, "b", "failed"), (2, "a", "success")], "run_id int, task_id string, state string")
    got = {r.run_id: r.outcome for r in runs.run_rollup(runs_df, tasks).collect()}
    assert got == {1: "failed", 2: "success", 3: None, 4: "unknown", 5: "queued"}


def test_unknown_profile_is_empty_unless_asked(spark):
    nodes = spark.createDataFrame(
        [("p", "a", ["resources:big"]), ("p", "b", ["resources:gone"]), ("p", "c", [])],
        "pipeline string, node string, tags array<string>",
    )
    profiles = spark.createDataFrame(
        [("__default__", "1"), ("big", "8")], "profile string, cpu string"
    )
    got = {r.node: (r.profile, r.cpu) for r in lookup.assign_profile(nodes, profiles).collect()}
    assert got == {"a": ("big", "8"), "b": (None, None), "c": ("__default__", "1")}
    doc = {r.node: (r.profile, r.cpu) for r in lookup.assign_profile(nodes, profiles, unknown_uses_default=True).collect()}
    assert doc["b"] == ("__default__", "1")


def test_overlay_present_null_wins(spark):
    layers = spark.createDataFrame(
        [("e", 0, "k", "base"), ("e", 1, "k", None), ("e", 0, "j", "keep")],
        "entity string, layer int, key string, value string",
    )
    got = {r.key: r.value for r in lookup.overlay(layers).collect()}
    assert got == {"k": None, "j": "keep"}
    m = lookup.overlay_map(layers).first().conf
    assert m == {"j": "keep", "k": None}
