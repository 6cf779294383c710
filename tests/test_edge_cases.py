"""Nulls, ties, late and repeated rows, empty re-runs and deep graphs."""

import contextlib
import datetime as dt
import io
import random
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as E
from conftest import SF_SMALL
from flowtables import session
from flowtables.functions import dates as D
from flowtables.functions import settings as S
from flowtables.functions import spark_conf as SC
from flowtables.functions import text as X
from flowtables.operators import edges, graph, runs
from flowtables.operators.ranking import dense_number_within, number_within
from flowtables.plans import transforms as TR
from flowtables.session import scratch_path
from flowtables.sources import files, staging
from flowtables.streaming import sources as SS
from flowtables.streaming import stateful as ST
from test_bruteforce import levels

T0 = dt.datetime(2024, 1, 1)


def at(minutes):
    return T0 + dt.timedelta(minutes=minutes)


def column(df, expr):
    return [r[0] for r in df.select(expr.alias("x")).collect()]


# --- scalars --------------------------------------------------------------


def test_slugs_in_ascii(spark):
    texts = ["Smørrebrød Łódź", "Привет, Ёлка", "Ελλάδα", "1,000 reasons, 2,345,678", "C'est déjà l'été", "日本", "", None, "ẞÆÞ"]
    got = column(spark.createDataFrame([(t,) for t in texts], "s string"), X.slugify("s"))
    assert got == ["smorrebrod-lodz", "privet-iolka", "ellada", "1000-reasons-2345678", "c-est-deja-l-ete", "", "", None, "ssaeth"]


@pytest.mark.parametrize("bad", ["junk", "20240230", "2024-13-45", "2024010"])
def test_bad_dates_fail(spark, bad):
    with pytest.raises(Exception, match="YYYYMMDD"):
        column(spark.createDataFrame([(bad,)], "s string"), D.start_date("s", F.lit("2024-06-01")))


def test_templates_are_read_once(spark):
    df = spark.createDataFrame([("x${b}y ${q|d} ${z} $ ${a|1}{k}", "${b}", "task-{dag}")], "t string, a string, task string")
    assert column(df, X.substitute("t", {"a": F.col("a"), "b": F.lit("${q|inj}"), "none": None})) == ["x${q|inj}y d ${z} $ ${b}{k}"]
    message = X.render_message(F.lit("{task} of {dag} {other}"), {"task": "task", "dag": F.lit(None).cast("string")}, "d")
    assert column(df, message) == ["task-{dag} of None {other}"]
    assert column(df, X.substitute(F.lit("${a.b|x}"), {"a.b": F.lit("1"), "aXb": F.lit("2")})) == ["1"]


def test_params_with_nulls_repeats_and_no_colon(spark):
    df = spark.createDataFrame([({"b": None, "a": "1"}, "a:1, b : x:y ,a:2,,")], "m map<string,string>, t string")
    assert column(df, X.render_params("m")) == ["a:1,b:None"]
    assert column(df, X.parse_params("t")) == [{"a": "2", "b": "x:y"}]
    with pytest.raises(Exception, match="without ':'"):
        column(df, X.parse_params(F.lit("abc")))


def test_prefixed_vars_that_become_equal(spark):
    df = spark.createDataFrame([({"P_A": "1", "P_a": "2"},)], "m map<string,string>")
    assert column(df, X.prefixed_vars("m", "P_", {})) == [{"a": "2"}]


def test_truthiness_by_type(spark):
    df = spark.createDataFrame([(0, 0.0, False, "0", "", 7)], "i int, d double, b boolean, s string, e string, n int")
    got = df.select(*[S.truthy_or_empty(c).alias(c) for c in df.columns]).first()
    assert tuple(got) == ("", "", "", "0", "", "7")


def test_empty_labels_and_secrets_stay(spark):
    df = spark.createDataFrame([("e", "", None, {"k": ""}, {"s": "v"})], "id string, limits_memory string, limits_cpu string, labels map<string,string>, secrets map<string,string>")
    df = df.withColumn("requests_cpu", F.lit("1"))
    got = {(r.conf_key, r.conf_value) for r in SC.fan_out_keys(df, "id", labels="labels", secrets="secrets").collect()}
    want = set()
    for w in ("driver", "executor"):
        want |= {(f"spark.{w}.cores", "1"), (f"spark.kubernetes.{w}.label.k", ""), (f"spark.kubernetes.{w}.secrets.s", "v")}
    assert got == want


def test_presets_by_row(spark):
    df = spark.createDataFrame([(1, "@daily"), (2, None), (3, "@hourly")], "id int, p string").withColumn("s", F.lit("2024-01-01 10:00:00").cast("timestamp_ntz"))
    got = D.run_calendar(df, "s", F.col("p"), F.lit("2024-01-03 00:00:00")).groupBy("id").count().collect()
    assert {r.id: r["count"] for r in got} == {1: 1, 3: 38}
    assert D.run_calendar(df, "s", None, F.lit("2024-01-03 00:00:00")).count() == 0
    with pytest.raises(Exception, match="unsupported schedule preset"):
        D.run_calendar(df, "s", F.lit("0 * * * *"), F.lit("2024-01-03 00:00:00")).collect()


# --- runs -----------------------------------------------------------------


def test_upstream_outcomes(spark):
    day = 24 * 60
    r = spark.createDataFrame([("a", at(day)), ("a", at(9 * day))], "pipeline_id string, run_ts timestamp_ntz")
    deps = spark.createDataFrame(
        [("a", "u", None, True, day, 60), ("a", "gone", None, True, day, 60), ("a", "gone", None, False, day, 60),
         ("a", "u", "t", True, day, 60), ("a", "u", "no", True, day, 60), ("a", "late", None, True, day, 60)],
        "pipeline_id string, up_pipeline_id string, up_task_id string, check_existence boolean, execution_delta_min int, timeout_min int",
    )
    up = spark.createDataFrame(
        [("u", at(0), None, "failed", at(day + 10)), ("u", at(0), None, "success", at(day + 50)), ("u", at(0), "t", "failed", at(day + 5)),
         ("late", at(0), None, "success", at(day + 61))],
        "pipeline_id string, run_ts timestamp_ntz, task_id string, state string, finished_ts timestamp_ntz",
    )
    got = runs.upstream_ready(r, deps, up, F.lit("2024-01-05 00:00:00").cast("timestamp_ntz")).collect()
    seen = sorted((x.run_ts.day, x.up_pipeline_id, x.up_task_id or "", x.outcome) for x in got)
    assert seen == [
        (2, "gone", "", "missing"), (2, "gone", "", "timed_out"), (2, "late", "", "timed_out"), (2, "u", "", "ready"),
        (2, "u", "no", "missing"), (2, "u", "t", "timed_out"),
        (10, "gone", "", "missing"), (10, "gone", "", "waiting"), (10, "late", "", "waiting"), (10, "u", "", "waiting"),
        (10, "u", "no", "missing"), (10, "u", "t", "waiting"),
    ]
    marked = r.withColumn("by_hand", F.when(F.dayofmonth("run_ts") == 2, True))  # null elsewhere: not ad hoc
    as_of = F.lit("2024-01-05 00:00:00").cast("timestamp_ntz")
    by_hand = runs.upstream_ready(marked, deps, up, as_of, ad_hoc="by_hand").collect()
    assert {x.run_ts.day for x in by_hand} == {10} and len(by_hand) == 6
    gates = {(x.run_ts.day, x.n_waits, x.gate) for x in runs.start_gate(marked, deps, up, as_of, ad_hoc="by_hand").collect()}
    assert gates == {(2, 0, "open"), (10, 6, "failed")}
    one = deps.filter("up_pipeline_id = 'u' AND up_task_id IS NULL")
    assert {(x.run_ts.day, x.gate) for x in runs.start_gate(r, one, up, as_of).collect()} == {(2, "open"), (10, "waiting")}
    outcomes = {x.outcome for x in E.queries()["j5_upstream_ready"](spark, SF_SMALL).collect()}
    assert outcomes == {"missing", "ready", "timed_out", "waiting"}


def test_gates_over_edges(spark):
    r = spark.createDataFrame([(1, "p"), (2, "p"), (3, "q")], "run_id int, pipeline string")
    states = spark.createDataFrame([(1, "a", "failed"), (1, "b", "success"), (2, "a", "success")], "run_id int, task_id string, state string")
    e = spark.createDataFrame([("p", "a", "end"), ("p", "b", "end"), ("p", "a", "clean"), ("p", "b", "clean")], "pipeline string, parent string, child string")
    rules = spark.createDataFrame([("p", "clean", "all_done")], "pipeline string, task_id string, rule string")
    got = {(x.run_id, x.task_id): x.eligible for x in runs.task_gates(r, states, e, rules).collect()}
    assert got == {(1, "end"): False, (1, "clean"): True, (2, "end"): False, (2, "clean"): False}


def test_null_keys_and_ties(spark):
    df = spark.createDataFrame([(None, at(1)), (None, at(2)), ("a", at(1)), ("a", at(3))], "pipeline_id string, execution_ts timestamp_ntz")
    got = {(x.pipeline_id, x.execution_ts): x.prev_ts for x in runs.previous_run(df).collect()}
    assert got == {(None, at(1)): None, (None, at(2)): at(1), ("a", at(1)): None, ("a", at(3)): at(1)}
    numbered = number_within(df, "pipeline_id", "execution_ts").collect()
    assert sorted((x.pipeline_id or "", x.rn) for x in numbered) == [("", 0), ("", 1), ("a", 0), ("a", 1)]
    assert dense_number_within(df, "pipeline_id", "execution_ts").count() == 4
    obs = spark.createDataFrame([(1, at(1), "failed", 9), (1, at(1), "success", 3)], "run_id long, ts timestamp_ntz, state string, event_id long")
    starts = spark.createDataFrame([(1, T0)], "run_id long, start_ts timestamp_ntz")
    assert runs.poll_outcome(obs, starts, 60, tie="event_id").first().outcome == "success"
    kv = spark.createDataFrame([(1, "k", "x", at(1), 3), (1, "k", "y", at(1), 9)], "run_id long, key string, value string, ts timestamp_ntz, event_id long")
    assert runs.latest_value(kv, tie="event_id").first().value == "y"


def test_lists_count_the_key_and_not_the_chunk(spark):
    g = spark.createDataFrame([("p", f"n{i:02d}", None if i % 2 else "g", "t") for i in range(50)], "pipeline string, node string, group_id string, group_type string")
    got = edges.group_members(g, max_per_row=10).collect()
    assert sorted((x.group_id or "", x.chunk, len(x.members), x.n_members) for x in got) == [
        (k, c, n, 25) for k in ("", "g") for c, n in ((0, 10), (1, 10), (2, 5))
    ]
    (one,) = edges.type_members(g).collect()
    assert one.n_members == 50 and one.member_list.startswith("n00,n01")


# --- graphs ---------------------------------------------------------------


def _levels(spark, pairs):
    e = spark.createDataFrame([("p", a, b) for a, b in pairs], "pipeline string, parent_group string, child_group string")
    return {r.group: r.level for r in graph.dag_levels(e).collect()}


def test_levels_of_a_deep_chain_and_a_cycle(spark):
    chain = [(f"c{i:05d}", f"c{i + 1:05d}") for i in range(12000)]
    more = [("c00100", "c09000"), ("x", "y"), ("y", "x"), ("y", "z"), ("z", "z2"), ("c11999", "z2")]
    pairs = chain + more
    got = _levels(spark, pairs)
    assert {n: got[n] for n in ("x", "y", "z", "z2")} == dict.fromkeys(("x", "y", "z", "z2"))
    assert all(got[f"c{i:05d}"] == i for i in range(12001))


def test_levels_of_random_graphs(spark):
    rnd = random.Random(5)
    for n, extra in ((30, 0), (40, 3), (60, 8)):
        pairs = {(f"n{a:02d}", f"n{b:02d}") for a, b in ((rnd.randrange(n - 1), 0) for _ in range(2 * n)) for b in [rnd.randrange(a + 1, n)]}
        pairs |= {(f"n{rnd.randrange(n):02d}", f"n{rnd.randrange(n):02d}") for _ in range(extra)}
        nodes = {x for p in pairs for x in p}
        assert _levels(spark, sorted(pairs)) == levels(nodes, pairs)


def test_absorption_plans_do_not_grow(spark, monkeypatch):
    """A ladder in which each round absorbs one node: the scans of a round stay the same."""
    e = [("p", "g", "d0"), ("p", "d0", "g")]
    for i in range(6):
        e += [("p", f"d{i}", f"d{i + 1}"), ("p", f"d{i + 1}", "g")]
    edge = spark.createDataFrame(e, "pipeline string, parent string, child string")
    groups = spark.createDataFrame([("p", "g", "g")], "pipeline string, node string, group_id string")
    default = spark.createDataFrame([("p", f"d{i}") for i in range(7)], "pipeline string, node string")
    scans = []
    real = graph.cut_lineage_counting

    def counting(df, name, **metrics):
        if name == "absorb-new":
            out = io.StringIO()
            with contextlib.redirect_stdout(out):
                df.explain("formatted")
            scans.append(out.getvalue().count("Scan"))
        return real(df, name, **metrics)

    monkeypatch.setattr(graph, "cut_lineage_counting", counting)
    got = {r.node for r in graph.absorb_sandwiched(edge, groups, default).collect()}
    assert got == {f"d{i}" for i in range(7)} and len(scans) == 8 and len(set(scans[1:])) == 1


# --- sinks ----------------------------------------------------------------


def test_csv_keeps_text(spark):
    data = [(1, 'say "hi", you\\ \n next\r\nline'), (2, ""), (3, None), (4, "  spaces  "), (5, "a,b;c"), (6, '"')]
    df = spark.createDataFrame(data, "i int, s string")
    path = scratch_path(spark, "csv")
    files.write_csv_table(df, path)
    assert sorted(map(tuple, files.csv_table_io(spark, path, df.schema).collect())) == data


def test_a_date_without_rows_is_emptied(spark):
    df = spark.createDataFrame([(at(0), 1), (at(1440), 2)], "ts timestamp_ntz, v int")
    sink = scratch_path(spark, "dates")
    keep = lambda rows: rows.select("ds", "v")
    TR.run_for_date(keep, df, "ts", None, sink)
    out = TR.run_for_date(keep, df.filter("v = 2"), "ts", "2024-01-01", sink)
    assert [(str(r.ds), r.v) for r in out.collect()] == [("2024-01-02", 2)]


def test_staging_skips_and_refuses_a_used_area(spark):
    area = scratch_path(spark, "area")
    copied = staging.stage_run_inputs(spark, SF_SMALL, area, ["nation", "region"]).collect()
    plain = staging.stage_run_inputs(spark, SF_SMALL, area, ["nation", "region"], skip=True).collect()
    assert [(r.table, r.n_rows) for r in copied] == [(r.table, r.n_rows) for r in plain]
    assert all(area in r.path for r in copied) and all(SF_SMALL in r.path for r in plain)
    with pytest.raises(Exception, match="already exists|PATH_ALREADY_EXISTS"):
        staging.stage_run_inputs(spark, SF_SMALL, area, ["nation"])


def test_an_explicit_checkpoint_folder_wins(spark):
    assert session.checkpoint_root(spark) == spark.sparkContext.getCheckpointDir()


# --- streams --------------------------------------------------------------


def _feed(spark, folder, rows, schema):
    spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(folder)


OBS = "run_id long, ts timestamp_ntz, state string, event_id long"


def _poll(spark, steps, starts, partitions=None):
    """Feed the steps one by one; returns all answers."""
    folder, begun = scratch_path(spark, "obs"), scratch_path(spark, "starts")
    sink, checkpoint = scratch_path(spark, "sink"), scratch_path(spark, "ckpt")
    _feed(spark, begun, starts, "run_id long, start_ts timestamp_ntz")
    _feed(spark, folder, [], OBS)
    before = spark.conf.get("spark.sql.shuffle.partitions")
    for i, rows in enumerate(steps):
        _feed(spark, folder, rows, OBS)
        obs = SS.event_stream(spark, folder, spark.read.parquet(folder).schema)
        st = SS.event_stream(spark, begun, spark.read.parquet(begun).schema, "start_ts")
        if partitions:
            spark.conf.set("spark.sql.shuffle.partitions", partitions[i])
        out = ST.stream_poll_outcome(obs, st, 60, "30 minutes", tie="event_id")
        SS.run_available_now(spark, out.writeStream.format("parquet").option("path", sink).outputMode("append"), checkpoint, state_partitions=partitions[i] if partitions else 2)
    spark.conf.set("spark.sql.shuffle.partitions", before)
    return sorted((r.run_id, r.outcome, r.n_seen) for r in spark.read.schema(ST.POLL_OUTPUT).parquet(sink).collect())


def test_polling_out_of_order_unseen_and_restarted(spark):
    obs = [(1, at(20), "success", 1), (1, at(10), "failed", 2), (1, at(5), "running", 3), (2, at(30), "running", 4), (4, at(70), "success", 5)]
    steps = [[obs[0]], [obs[1], obs[3]], [obs[2], obs[4]], [(99, at(200), "running", 6)]]
    starts = [(1, T0), (2, T0), (3, T0), (4, T0)]
    batch_obs = spark.createDataFrame(obs, OBS)
    batch_starts = spark.createDataFrame(starts, "run_id long, start_ts timestamp_ntz")
    want = sorted((r.run_id, r.outcome, r.n_seen) for r in runs.poll_outcome(batch_obs, batch_starts, 60, tie="event_id").collect())
    assert _poll(spark, steps, starts) == want
    assert [w[1] for w in want] == ["failed", None, "unknown", "unknown"]
    assert _poll(spark, steps, starts, partitions=[1, 2, 3, 4]) == want  # each run answered once


PROVIDER = "spark.sql.streaming.stateStore.providerClass"


@pytest.mark.parametrize("named", [None, "org.apache.spark.sql.execution.streaming.state.HDFSBackedStateStoreProvider"])
def test_streams_run_in_a_session_without_rocksdb(spark, named):
    """A cluster's session names no state store, or Spark's default one; it is as before afterwards."""
    before = spark.conf.get(PROVIDER)
    try:
        spark.conf.unset(PROVIDER) if named is None else spark.conf.set(PROVIDER, named)
        found = spark.conf.get(PROVIDER, None)
        steps = [[(1, at(20), "success", 1)], [(99, at(200), "running", 2)]]
        assert _poll(spark, steps, [(1, T0), (2, T0)]) == [(1, "success", 1), (2, "unknown", 0)]
        ready = _ready(spark, [([(1, 7, at(0))], [(10, 7, at(40))]), ([(2, 7, at(300))], [(11, 7, at(300))])])
        assert ready[-1] == [(1, 10, "ready")]
        assert spark.conf.get(PROVIDER, None) == found
    finally:
        spark.conf.set(PROVIDER, before)


def test_upstream_waits_for_the_watermark(spark):
    schema = "kind string, event_id long, key long, ts timestamp_ntz"
    steps = [
        [("run", 1, 7, at(0)), ("up", 10, 7, at(40))],
        [("up", 11, 7, at(20)), ("run", 2, 7, at(30))],  # earlier than the first, inside the watermark
        [("run", 3, 8, at(35)), ("up", 12, 9, at(45))],
        [("up", 13, 9, at(400)), ("run", 4, 9, at(401))],  # both feeds go on
    ]
    folder, sink, checkpoint = (scratch_path(spark, x) for x in ("up", "up-sink", "up-ckpt"))
    _feed(spark, folder, [], schema)
    for rows in steps:
        _feed(spark, folder, rows, schema)
        s = SS.event_stream(spark, folder, spark.read.parquet(folder).schema)
        r = s.filter("kind = 'run'").select(F.col("event_id").alias("run_event_id"), "key", F.col("ts").alias("run_ts"))
        u = s.filter("kind = 'up'").select(F.col("event_id").alias("up_event_id"), "key", F.col("ts").alias("up_ts"))
        out = ST.stream_upstream_ready(r, u, 60, "30 minutes")
        SS.run_available_now(spark, out.writeStream.format("parquet").option("path", sink).outputMode("append"), checkpoint, state_partitions=2)
    got = sorted((x.run_event_id, x.up_event_id, x.outcome) for x in spark.read.parquet(sink).collect())
    assert got == [(1, 11, "ready"), (2, 10, "ready"), (3, None, "timed_out")]


def _ready(spark, steps, timeout=60, watermark="30 minutes", partitions=(2,) * 9, **options):
    """Feed ``(runs, upstream)`` steps to two feeds; returns the answers after each step."""
    schemas = {"run": "run_event_id long, key long, run_ts timestamp_ntz", "up": "up_event_id long, key long, up_ts timestamp_ntz"}
    folders = {k: scratch_path(spark, f"feed-{k}") for k in schemas}
    sink, checkpoint = scratch_path(spark, "ready-sink"), scratch_path(spark, "ready-ckpt")
    for k, schema in schemas.items():
        _feed(spark, folders[k], [], schema)
    seen = []
    for i, step in enumerate(steps):
        for (k, schema), rows in zip(schemas.items(), step, strict=True):
            if rows:
                _feed(spark, folders[k], rows, schema)
        r, u = (SS.event_stream(spark, folders[k], spark.read.parquet(folders[k]).schema, f"{k}_ts") for k in schemas)
        out = ST.stream_upstream_ready(r, u, timeout, watermark, **options)
        SS.run_available_now(spark, out.writeStream.format("parquet").option("path", sink).outputMode("append"), checkpoint, state_partitions=partitions[i])
        got = spark.read.schema("run_event_id long, key long, up_event_id long, outcome string, run_ts timestamp").parquet(sink)
        seen.append(sorted((x.run_event_id, x.up_event_id, x.outcome) for x in got.collect()))
    return seen


def test_a_lagging_upstream_feed_delays_answers(spark):
    steps = [
        ([(1, 7, at(0)), (2, 7, at(400))], [(90, 7, at(-5))]),
        ([], [(91, 7, at(30)), (93, 7, at(30)), (92, 7, at(50))]),
        ([(3, 8, at(500))], [(94, 7, at(470))]),
        ([(4, 8, at(900))], [(95, 8, at(901))]),
    ]
    seen = _ready(spark, steps, timeout=120, partitions=[1, 2, 3, 2])
    assert seen[0] == seen[1] == [] and seen[2] == [(1, 91, "ready")]
    assert seen[3] == [(1, 91, "ready"), (2, 94, "ready"), (3, None, "timed_out")]
    r = spark.createDataFrame([x for s in steps for x in s[0]], "run_event_id long, key long, run_ts timestamp_ntz")
    u = spark.createDataFrame([x for s in steps for x in s[1]], "up_event_id long, up_key long, up_ts timestamp_ntz")
    meets = (F.col("key") == F.col("up_key")) & (F.col("up_ts") >= F.col("run_ts")) & (F.col("up_ts") <= F.col("run_ts") + F.expr("INTERVAL 120 MINUTES"))
    batch = r.join(u, meets, "left").groupBy("run_event_id").agg(F.min_by("up_event_id", F.struct("up_ts", "up_event_id")).alias("up")).collect()
    assert [(i, up) for i, up, _ in seen[3]] == sorted((x.run_event_id, x.up) for x in batch if x.run_event_id < 4)


def test_a_silent_upstream_feed_counts_as_idle(spark):
    steps = [([(1, 7, at(0))], [(90, 7, at(-5))]), ([(2, 7, at(400))], []), ([(3, 7, at(800))], [])]
    assert _ready(spark, steps)[-1] == []
    assert _ready(spark, steps, idle_after="60 minutes")[-1] == [(1, None, "timed_out"), (2, None, "timed_out")]


def test_many_open_runs_of_a_key(spark):
    """Runs over several windows of a key; answers at the border of the timeout; one answer per run."""
    runs_ = [(i, 5, at(i)) for i in range(400)]
    ups = [(1000 + i, 5, at(i)) for i in range(0, 400, 97)]
    seen = _ready(spark, [(runs_[::2], ups[:2]), (runs_[1::2], ups[2:]), ([(9999, 6, at(2000))], [(9998, 6, at(2000))])], partitions=[2, 1, 3], watermark="500 minutes")
    want = []
    for i, _, _ in runs_:
        found = [u - 1000 for u, _, _ in ups if i <= u - 1000 <= i + 60]
        want.append((i, 1000 + found[0] if found else None, "ready" if found else "timed_out"))
    assert seen[-1] == want


def test_rolled_up_runs(spark):
    """T1 over task states equals A3 as of the deciding observation, after W4."""
    obs = [(i, at(20 + i), s, i) for i, s in enumerate(["success"] * 6 + ["failed", "running"])] + [(0, at(5), "running", 50), (3, at(40), "failed", 51)]
    tasks = [
        (0, "a", at(10), "success", 1),
        (1, "a", at(10), "failed", 2),  # a failed task
        (2, "a", at(10), "failed", 3), (2, "a", at(15), "success", 4),  # a second attempt
        (3, "a", at(24), "failed", 5),  # after the decision
        (4, "a", at(10), "success", 6), (4, "b", at(24), "failed", 7),  # at its very time
        (5, "a", at(12), "success", 9), (5, "a", at(12), "failed", 8),  # of equal times the larger id
        (7, "a", at(1), "failed", 10),
    ]
    schema, end = "run_id long, task_id string, ts timestamp_ntz, state string, attempt long", at(500)
    folders = {k: scratch_path(spark, f"rolled-{k}") for k in ("obs", "tasks", "starts", "sink", "ckpt")}
    starts = [(i, T0) for i in range(9)]
    _feed(spark, folders["starts"], starts, "run_id long, start_ts timestamp_ntz")
    for o, t in ((obs[::2], []), (obs[1::2], tasks), ([(99, end, "running", 0)], [(99, "a", end, "running", 0)])):
        _feed(spark, folders["obs"], o, OBS)
        _feed(spark, folders["tasks"], t, schema)
        s, ts, st = (SS.event_stream(spark, folders[k], spark.read.parquet(folders[k]).schema, c) for k, c in (("obs", "ts"), ("tasks", "ts"), ("starts", "start_ts")))
        out = ST.stream_poll_outcome(s, st, 60, "30 minutes", tie="event_id", task_states=ts, task_tie="attempt")
        SS.run_available_now(spark, out.writeStream.format("parquet").option("path", folders["sink"]).outputMode("append"), folders["ckpt"], state_partitions=2)
    got = sorted((r.run_id, r.outcome, r.n_seen) for r in spark.read.schema(ST.POLL_OUTPUT).parquet(folders["sink"]).collect())
    batch = runs.poll_rolled_outcome(
        spark.createDataFrame(obs, OBS), spark.createDataFrame(tasks, schema), spark.createDataFrame(starts, "run_id long, start_ts timestamp_ntz"), 60, tie="event_id", task_tie="attempt"
    )
    assert got == sorted((r.run_id, r.outcome, r.n_seen) for r in batch.collect())
    assert [o for _, o, _ in got] == ["success", "failed", "success", "success", "failed", "success", "failed", None, "unknown"]


def test_late_alerts(spark):
    folder, sink, checkpoint = (scratch_path(spark, x) for x in ("late", "late-sink", "late-ckpt"))
    schema = "event_id long, ts timestamp_ntz, state string, value double"
    _feed(spark, folder, [], schema)
    stream = SS.event_stream(spark, folder, spark.read.parquet(folder).schema)
    steps = [[(1, at(3 * 1440), "failed", 1.0)], [(2, T0, "failed", 2.0)], [(1, at(3 * 1440), "failed", 1.0), (3, at(5), "ok", 4.0)]]
    for rows in steps:
        _feed(spark, folder, rows, schema)
        ST.stream_failure_alerts(stream, {"task": F.col("event_id")}, "{task}", f"{sink}-alerts", f"{checkpoint}-alerts")
    assert sorted(r.event_id for r in spark.read.parquet(f"{sink}-alerts").collect()) == [1, 2]


def test_ledger_of_partial_totals(spark):
    """Each run reads new files only, late files count, a batch that is run again
    replaces its entry, and compaction changes nothing but the number of entries."""
    folder, ledger, checkpoint = (scratch_path(spark, x) for x in ("led", "led-ger", "led-ckpt"))
    schema, keys = "k string, v decimal(12,2), at long", ["k"]
    measures = {"n": ("count", F.lit(1)), "total": ("sum", F.col("v")), "least": ("min", F.col("at")), "most": ("max", F.col("at"))}
    steps = [[("a", Decimal("1.50"), 5), ("b", Decimal("2.00"), 6), (None, None, None)], [("a", Decimal("0.25"), 1)], [], [("c", Decimal("9.00"), 9), ("b", None, 8)], [("a", Decimal("-1.00"), 7)]]
    _feed(spark, folder, [], schema)
    def totals():
        got = ST.ledger_totals(spark, ledger, keys, measures).collect()
        return sorted(((r.k, r.n, r.total, r.least, r.most) for r in got), key=str)

    def batch(rows):
        df = spark.createDataFrame(rows, schema).groupBy("k").agg(F.count(F.lit(1)), F.sum("v"), F.min("at"), F.max("at"))
        return sorted((tuple(r) for r in df.collect()), key=str)

    whole = []
    for i, rows in enumerate(steps):
        if rows:
            _feed(spark, folder, rows, schema)
        whole += rows
        stream = spark.readStream.schema(schema).parquet(folder)
        ST.incremental_run(stream, keys, measures, ledger, checkpoint)
        assert totals() == batch(whole)
        if i in (1, 3, 4):
            ST.compact_ledger(spark, ledger, keys, measures)
            assert totals() == batch(whole)
    names = session.list_folder(spark, f"{ledger}/batches")
    assert len([n for n in names if n.startswith("batch=")]) == 2  # the columns, and the newest entry
    newest = max(int(n.rpartition("=")[2]) for n in names if n.startswith("batch="))
    again = spark.createDataFrame(steps[-1], schema)
    ST._partial(again, keys, measures).write.mode("overwrite").parquet(f"{ledger}/batches/batch={newest}")
    assert totals() == batch(whole)
    assert ST.compact_ledger(spark, ledger, keys, measures) is None


# --- chains of steps ------------------------------------------------------


def test_fused_outputs_run_what_they_need_once(spark):
    ran = []

    def add(name):
        def run(*frames):
            ran.append(name)
            out = frames[0]
            for f in frames[1:]:
                out = out.unionByName(f)
            return out.withColumn("x", F.col("x") + 1)

        return run

    def fail(_):
        raise AssertionError("not asked for")

    steps = [
        TR.step("last", add("last"), ["left", "right"], ["out"]),
        TR.step("base", add("base"), ["raw"], ["shared"]),
        TR.step("left", add("left"), ["shared"], ["left"]),
        TR.step("right", add("right"), ["shared"], ["right"]),
        TR.step("other", fail, ["shared"], ["other"]),
    ]
    raw = spark.range(5).select(F.col("id").alias("x"))
    got = TR.run_fused(steps, {"raw": raw}, outputs=["out"])
    assert list(got) == ["out"] and sorted(ran) == ["base", "last", "left", "right"]
    assert sorted(r.x for r in got["out"].collect()) == sorted([i + 3 for i in range(5)] * 2)
    # Both branches read the stored dataset, nothing else is stored, and the range is not in the plan any more.
    plan = got["out"]._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Relation [") == 2 and "Range" not in plan
    single = TR.run_fused(steps, {"raw": raw}, outputs=["left"])["left"]
    assert "Range" in single._jdf.queryExecution().optimizedPlan().toString()
    assert TR.shared_datasets(steps[1:3], ["shared"]) == {"shared"}  # read by a step and by the caller
    given = TR.run_fused(steps, {"raw": raw, "left": raw, "right": raw}, outputs=["out", "raw"])
    assert given["raw"] is raw and given["out"].count() == 10
    with pytest.raises(ValueError, match="no step makes"):
        TR.run_fused(steps, {"raw": raw}, outputs=["nothing"])
    with pytest.raises(ValueError, match="is made by"):
        TR.run_fused([*steps, TR.step("again", add("again"), ["raw"], ["out"])], {"raw": raw}, outputs=["out"])
