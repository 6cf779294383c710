"""Run-state operators: roll-up (A3), trigger gates (A4), latest value (W1),
previous run (W3), polling outcome (W4), upstream readiness (J5),
get-or-create (J6) and wide run parameters (A5).

All are one or two shuffles: a partial aggregate per run and an equi join.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..constants import RUN_PARAM_KEYS, TERMINAL_STATES
from .ranking import previous_within


def _c(col: Column | str) -> Column:
    return F.col(col) if isinstance(col, str) else col


def latest_attempts(task_states: DataFrame, keys=("run_id", "task_id"), ts: str = "ts") -> DataFrame:
    """One row per task: the newest attempt (ties broken by the whole row)."""
    others = [c for c in task_states.columns if c not in keys]
    order = F.struct(F.col(ts), *[F.col(c) for c in others if c != ts])
    return (
        task_states.groupBy(*keys)
        .agg(F.max_by(F.struct(*others), order).alias("_row"))
        .select(*keys, "_row.*")
    )


def run_rollup(runs: DataFrame, task_states: DataFrame) -> DataFrame:
    """A3: ``(run_id, outcome)``.

    ``running`` → null (not finished); ``success`` with any failed task →
    ``failed``; any other state as it is; no readable state → ``unknown``.
    Task states should be one row per task (see ``latest_attempts``).
    """
    failed = task_states.groupBy("run_id").agg(F.bool_or(F.col("state") == "failed").alias("_any_failed"))
    state = F.col("state")
    return runs.join(failed, "run_id", "left").select(
        "run_id",
        F.when(state.isNull(), F.lit("unknown"))
        .when(state == "running", F.lit(None).cast("string"))
        .when((state == "success") & F.coalesce(F.col("_any_failed"), F.lit(False)), F.lit("failed"))
        .otherwise(state)
        .alias("outcome"),
    )


def trigger_gate(task_states: DataFrame, run_col: str = "run_id", terminal: Sequence[str] = TERMINAL_STATES) -> DataFrame:
    """A4: per run, may a task that waits on all the run's tasks start?

    ``all_done`` (clean-up rule): every upstream task is in a terminal
    state, whatever the result.  ``all_success`` (default rule): every one
    succeeded.
    """
    s = F.col("state")
    return task_states.groupBy(run_col).agg(
        F.bool_and(F.coalesce(s.isin(list(terminal)), F.lit(False))).alias("all_done"),
        F.bool_and(F.coalesce(s == "success", F.lit(False))).alias("all_success"),
        F.count(F.lit(1)).alias("n_tasks"),
    )


def task_gates(
    runs: DataFrame,
    task_states: DataFrame,
    edges: DataFrame,
    rules: DataFrame | str = "all_success",
    terminal: Sequence[str] = TERMINAL_STATES,
) -> DataFrame:
    """A4 over edges: per run and waiting task, may it start?

    ``runs(run_id, pipeline)``; ``task_states(run_id, task_id, state)`` with
    one row per task; ``edges(pipeline, parent, child)``; ``rules(pipeline,
    task_id, rule)`` or one rule for all.  ``all_done``: every parent is in a
    terminal state; ``all_success`` (also of tasks without a rule): every
    parent succeeded.  A parent without a state in the run has not been
    reached.  Output ``(run_id, task_id, rule, eligible, n_parents)`` for tasks with parents.
    """
    s = F.col("state")
    waits = runs.select("run_id", "pipeline").join(edges.select("pipeline", "parent", F.col("child").alias("task_id")), "pipeline")
    states = task_states.select("run_id", F.col("task_id").alias("parent"), "state")
    seen = (
        waits.join(states, ["run_id", "parent"], "left")
        .groupBy("run_id", "pipeline", "task_id")
        .agg(
            F.bool_and(F.coalesce(s.isin(list(terminal)), F.lit(False))).alias("_done"),
            F.bool_and(F.coalesce(s == "success", F.lit(False))).alias("_success"),
            F.count(F.lit(1)).alias("n_parents"),
        )
    )
    if isinstance(rules, str):
        seen = seen.withColumn("rule", F.lit(rules))
    else:
        seen = seen.join(rules.select("pipeline", "task_id", "rule"), ["pipeline", "task_id"], "left")
        seen = seen.withColumn("rule", F.coalesce("rule", F.lit("all_success")))
    eligible = F.when(F.col("rule") == "all_done", F.col("_done")).when(F.col("rule") == "all_success", F.col("_success"))
    wrong = F.raise_error(F.concat(F.lit("unknown trigger rule "), F.col("rule"))).cast("boolean")
    return seen.select("run_id", "task_id", "rule", F.coalesce(eligible, wrong).alias("eligible"), "n_parents")


def _newest(ts: str, tie: str | None) -> Column:
    """Order by time, then by ``tie``: no two rows are equal in it if the tie column tells them apart."""
    return F.struct(F.col(ts), F.col(tie)) if tie else F.col(ts)


def latest_value(
    kv: DataFrame, keys: Sequence[str] = ("run_id", "key"), ts: str = "ts", value: str = "value", tie: str | None = None
) -> DataFrame:
    """Newest value per ``keys`` (a partial aggregate, no sort); of equal
    times that with the largest ``tie``."""
    return kv.groupBy(*keys).agg(F.max_by(value, _newest(ts, tie)).alias(value), F.max(ts).alias(ts))


def previous_run(runs: DataFrame, pipeline_col: str = "pipeline_id", ts_col: str = "execution_ts") -> DataFrame:
    """``(pipeline, ts, prev_ts)`` over the distinct run times of each pipeline."""
    distinct_runs = runs.select(pipeline_col, ts_col).distinct()
    return previous_within(distinct_runs, pipeline_col, ts_col, ts_col, "prev_ts")


def poll_outcome(
    observations: DataFrame,
    starts: DataFrame,
    timeout_min: int | Column,
    run_col: str = "run_id",
    tie: str | None = None,
) -> DataFrame:
    """``(run, outcome, n_seen)`` of waiting for a run from its start.

    Only observations in ``[start, start + timeout)`` count.  The first one
    (by time, then by ``tie``) that is not ``running`` decides.  None deciding: null when
    something was seen (the run was still running at the deadline),
    ``unknown`` when nothing was seen or the timeout is not positive.
    """
    timeout = timeout_min if isinstance(timeout_min, Column) else F.lit(timeout_min)
    s = starts.select(run_col, "start_ts").withColumn("_timeout", timeout)
    deadline = F.col("start_ts") + F.make_dt_interval(mins=F.col("_timeout"))
    seen = (
        observations.select(run_col, "ts", "state", *([tie] if tie else []))
        .join(s, run_col)
        .filter((F.col("ts") >= F.col("start_ts")) & (F.col("ts") < deadline) & (F.col("_timeout") > 0))
        .groupBy(run_col)
        .agg(
            F.min_by("state", F.when(F.col("state") != "running", _newest("ts", tie))).alias("_decided"),
            F.count(F.lit(1)).alias("n_seen"),
        )
    )
    return (
        s.join(seen, run_col, "left")
        .select(
            run_col,
            F.when(F.col("_decided").isNotNull(), F.col("_decided"))
            .when(F.coalesce(F.col("n_seen"), F.lit(0)) > 0, F.lit(None).cast("string"))
            .otherwise(F.lit("unknown"))
            .alias("outcome"),
            F.coalesce(F.col("n_seen"), F.lit(0)).alias("n_seen"),
        )
    )


def poll_rolled_outcome(
    observations: DataFrame,
    task_states: DataFrame,
    starts: DataFrame,
    timeout_min: int | Column,
    tie: str | None = None,
    task_tie: str | None = None,
) -> DataFrame:
    """W4 of a run whose state is rolled up from its tasks (A3).

    ``observations(run_id, ts, state)`` are the run's own states and
    ``task_states(run_id, task_id, ts, state)`` those of its tasks.  The first
    observation that is not ``running`` decides; a ``success`` counts as
    ``failed`` if the newest attempt of any task, as of that time, failed.
    Output ``(run_id, outcome, n_seen)``.
    """
    polled = poll_outcome(observations, starts, timeout_min, tie=tie)
    timeout = timeout_min if isinstance(timeout_min, Column) else F.lit(timeout_min)
    # The decision's time: one row per run, so its tasks meet one time each.
    window = starts.select("run_id", "start_ts", (F.col("start_ts") + F.make_dt_interval(mins=timeout)).alias("_until"))
    decided = (
        observations.filter(F.col("state") != "running")
        .join(window, "run_id")
        .filter((F.col("ts") >= F.col("start_ts")) & (F.col("ts") < F.col("_until")))
        .groupBy("run_id")
        .agg(F.min("ts").alias("_at"))
    )
    asof = task_states.join(decided, "run_id").filter(F.col("ts") <= F.col("_at"))
    newest = asof.groupBy("run_id", "task_id").agg(F.max_by("state", _newest("ts", task_tie)).alias("state"))
    failed = newest.filter(F.col("state") == "failed").select("run_id").distinct().withColumn("_failed", F.lit(True))
    outcome = F.when((F.col("outcome") == "success") & F.col("_failed"), F.lit("failed")).otherwise(F.col("outcome"))
    return polled.join(failed, "run_id", "left").select("run_id", outcome.alias("outcome"), "n_seen")


def upstream_ready(
    runs: DataFrame,
    dependencies: DataFrame,
    upstream: DataFrame,
    as_of: Column | str,
    ad_hoc: Column | str | None = None,
) -> DataFrame:
    """Outcome of waiting for an upstream pipeline, per run and dependency.

    ``runs(pipeline_id, run_ts)``; ``dependencies(pipeline_id,
    up_pipeline_id, up_task_id, check_existence, execution_delta_min,
    timeout_min)``; ``upstream(pipeline_id, run_ts, task_id, state,
    finished_ts)`` with ``task_id`` null for a whole run; a run may have
    several rows (attempts).  The run at ``t`` waits for the upstream run, or
    its task, at ``t - delta``, at most ``timeout`` minutes.  Runs for which
    the boolean ``ad_hoc`` (a column of ``runs``) is true wait for nothing and
    have no rows.

    Outcome: ``missing`` (existence is checked, and the upstream pipeline, or
    its task, does not occur in ``upstream`` at all), ``ready`` (an attempt
    succeeded within the wait), ``timed_out`` (deadline before ``as_of``),
    else ``waiting``.
    """
    as_of = _c(as_of)
    up = upstream.select(
        F.col("pipeline_id").alias("u_pipeline"), F.col("run_ts").alias("u_ts"), F.col("task_id").alias("u_task"), "state", "finished_ts"
    )
    # Whether an id exists is a question about dependencies, not about runs.
    pipelines = up.select("u_pipeline").distinct().withColumn("_has_pipeline", F.lit(True))
    tasks = up.filter(F.col("u_task").isNotNull()).select("u_pipeline", "u_task").distinct().withColumn("_has_task", F.lit(True))
    deps = (
        dependencies.join(pipelines, F.col("up_pipeline_id") == F.col("u_pipeline"), "left")
        .drop("u_pipeline")
        .join(tasks, (F.col("up_pipeline_id") == F.col("u_pipeline")) & (F.col("up_task_id") == F.col("u_task")), "left")
        .drop("u_pipeline", "u_task")
    )
    exists = F.when(F.col("up_task_id").isNull(), F.col("_has_pipeline").isNotNull()).otherwise(F.col("_has_task").isNotNull())
    deps = deps.withColumn("_missing", F.col("check_existence") & ~exists).drop("_has_pipeline", "_has_task")
    if ad_hoc is not None:
        runs = runs.filter(~F.coalesce(_c(ad_hoc), F.lit(False)))
    waits = runs.select("pipeline_id", "run_ts").join(deps, "pipeline_id").withColumn(
        "_up_ts", F.col("run_ts") - F.make_dt_interval(mins=F.col("execution_delta_min"))
    )
    # One row per upstream run or task: when it first succeeded.
    done = up.filter(F.col("state") == "success").groupBy("u_pipeline", "u_ts", "u_task").agg(F.min("finished_ts").alias("_done_ts"))
    joined = waits.join(
        done,
        (F.col("up_pipeline_id") == F.col("u_pipeline")) & (F.col("_up_ts") == F.col("u_ts")) & F.col("up_task_id").eqNullSafe(F.col("u_task")),
        "left",
    )
    deadline = F.col("run_ts") + F.make_dt_interval(mins=F.col("timeout_min"))
    outcome = (
        F.when(F.col("_missing"), F.lit("missing"))
        .when(F.col("_done_ts") <= deadline, F.lit("ready"))
        .when(deadline < as_of, F.lit("timed_out"))
        .otherwise(F.lit("waiting"))
    )
    return joined.select("pipeline_id", "run_ts", "up_pipeline_id", "up_task_id", outcome.alias("outcome"))


def start_gate(
    runs: DataFrame, dependencies: DataFrame, upstream: DataFrame, as_of: Column | str, ad_hoc: Column | str | None = None
) -> DataFrame:
    """J5 per run: ``(pipeline_id, run_ts, n_waits, n_ready, gate)`` of all distinct ``runs``.

    ``gate`` is ``open`` when every wait is ready (also without any: runs without
    dependencies, and ad-hoc runs), ``failed`` when one is missing or timed
    out, else ``waiting``.
    """
    waits = upstream_ready(runs, dependencies, upstream, as_of, ad_hoc)
    n_ready, lost = F.count_if(F.col("outcome") == "ready"), F.count_if(F.col("outcome").isin("missing", "timed_out"))
    per = waits.groupBy("pipeline_id", "run_ts").agg(F.count(F.lit(1)).alias("n_waits"), n_ready.alias("n_ready"), lost.alias("_lost"))
    gate = F.when(F.col("_lost") > 0, "failed").when(F.col("n_ready") == F.col("n_waits"), "open").otherwise("waiting")
    out = runs.select("pipeline_id", "run_ts").distinct().join(per, ["pipeline_id", "run_ts"], "left").fillna(0, ["n_waits", "n_ready", "_lost"])
    return out.select("pipeline_id", "run_ts", "n_waits", "n_ready", gate.alias("gate"))


def get_or_create(requested: DataFrame, existing: DataFrame, new_id_prefix: str = "new:") -> DataFrame:
    """``(name, experiment_id, action)`` for each requested name.

    Absent → ``created`` with a new id; present and active → ``reused``
    with its id; present but deleted → ``rejected`` (the strict form of
    the caller raises on these rows).
    """
    ex = existing.select("name", "experiment_id", "lifecycle_stage")
    req = requested.select("name").distinct()
    created = req.join(ex, "name", "left_anti").select(
        "name", F.concat(F.lit(new_id_prefix), F.col("name")).alias("experiment_id"), F.lit("created").alias("action")
    )
    found = req.join(ex, "name").select(
        "name",
        "experiment_id",
        F.when(F.col("lifecycle_stage") == "deleted", F.lit("rejected")).otherwise(F.lit("reused")).alias("action"),
    )
    return created.unionByName(found)


def params_wide(run_params: DataFrame, keys: Sequence[str] = RUN_PARAM_KEYS) -> DataFrame:
    """A5: ``(run_id, <key>...)`` one row per run; the key list is given, so
    the pivot needs no extra job to find it.  An unset key is null."""
    return run_params.groupBy("run_id").pivot("key", list(keys)).agg(F.max("value"))
