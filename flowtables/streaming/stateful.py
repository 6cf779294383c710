"""Streaming twins of the polling behaviours.

Each result must equal the batch operator on the same rows, up to what
event time allows: a result that waits for a deadline is emitted once the
watermark has passed the deadline.
"""

from __future__ import annotations

from bisect import bisect_left
from collections.abc import Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.utils import AnalysisException
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from ..constants import DEFAULT_FAILURE_MESSAGE
from ..functions.text import render_message
from ..session import list_folder, remove_folder, ship_package
from .sources import run_available_now

POLL_OUTPUT = "run_id long, outcome string, n_seen long"


#: Keys are dealt to so many groups of state by a hash; part of a checkpoint, like its state.
BUCKETS = 256
#: A group of runs is cut into so many slices by the same hash, of which only those that rows or deadlines ask for are read.
POLL_SLICES = 64
#: Entries of rows that wait are folded into one beyond this number in a slice.
HELD_ENTRIES = 16
_RUN = ("run_id", "start_us", "deadline_us", "n_seen", "at_us", "tie", "decided")
_HELD = ("run_id", "kind", "us", "tie", "task", "state", "until")


def _columns(rows: list, width: int) -> list:
    return [list(c) for c in zip(*rows, strict=True)] if rows else [[] for _ in range(width)]


class _Poll(StatefulProcessor):
    """The runs of one hash bucket: of each its window, the earliest deciding observation
    in it, and how many were seen; a timer stands at the next deadline.

    Calls to the state server cost far more than rows, so a slice of the runs is one entry.
    What comes before a run's start is known is held in further entries, until
    the start comes or can no longer come; task states are held as
    well, since which of them count is known only with the decision.
    """

    def __init__(self, timeout_us: int) -> None:
        self.timeout_us = timeout_us

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        run = "run_id array<bigint>, start_us array<bigint>, deadline_us array<bigint>, n_seen array<bigint>, at_us array<bigint>, tie array<bigint>, decided array<string>"
        held = "run_id array<bigint>, kind array<string>, us array<bigint>, tie array<bigint>, task array<string>, state array<string>, until array<bigint>"
        self.runs = handle.getMapState("runs", "slice long", f"{run}, entries long, prune_us long")
        self.held = handle.getMapState("held", "slice long, entry long", held)
        # When a slice has to be looked at next, and the timer that is set.
        self.due = handle.getValueState("due", "us array<bigint>, ms long")

    def close(self) -> None:
        pass

    def _read(self, at: int):
        found = self.runs.getValue((at,))
        if found is None:
            return {}, 0, None
        return {r[0]: list(r[1:]) for r in zip(*found[: len(_RUN)], strict=True)}, found[len(_RUN)], found[len(_RUN) + 1]

    def _write(self, at: int, runs: dict, entries: int, prune):
        """Store a slice; returns when it has to be looked at next."""
        if not runs and not entries:
            self.runs.removeKey((at,))
            return None
        self.runs.updateValue((at,), (*_columns([(k, *v) for k, v in runs.items()], len(_RUN)), entries, prune))
        return min((t for t in (*(v[1] for v in runs.values()), prune) if t is not None), default=None)

    def _held_rows(self, at: int, entries: int) -> list:
        return [row for i in range(entries) for row in zip(*self.held.getValue((at, i)), strict=True)]

    def _hold(self, at: int, rows: list, entries: int) -> int:
        """Replace the entries of a slice by one."""
        for i in range(1 if rows else 0, entries):
            self.held.removeKey((at, i))
        if rows:
            self.held.updateValue((at, 0), tuple(_columns(rows, len(_HELD))))
        return int(bool(rows))

    def _set_timer(self, due: list, before) -> None:
        ahead = [t for t in due if t is not None]
        ms = min(ahead) // 1000 + 1 if ahead else None
        if ms is not None and ms != before:
            self.handle.registerTimer(ms)
        self.due.update((due, ms)) if ahead else self.due.clear()

    def handleInputRows(self, key, rows, timerValues):
        came: dict = {}
        for pdf in rows:
            pdf = pdf[pdf["ok"]]
            columns = [pdf[c].tolist() for c in ("slice", "known", "run_id", "kind", "ts_us", "tie", "task", "state")]
            for at, known, run, *rest in zip(*columns, strict=True):
                came.setdefault(at, []).append((run if known else None, *rest))
        if not came:
            return iter([])
        due, ms = self.due.get() if self.due.exists() else ([None] * POLL_SLICES, None)
        due = list(due)
        for at, new in came.items():
            due[at] = self._take(at, new)
        self._set_timer(due, ms)
        return iter([])

    def _take(self, at: int, new: list):
        runs, entries, prune = self._read(at)
        begun = {r[0]: r[2] for r in new if r[1] == "start" and r[0] not in runs}
        for run, start in begun.items():
            runs[run] = [start, start + self.timeout_us, 0, None, None, None]
        new = [r for r in new if r[1] != "start" and r[0] is not None]
        if begun and entries:
            waited = self._held_rows(at, entries)
            rest = [r for r in waited if r[0] not in begun]
            if len(rest) != len(waited):
                entries = self._hold(at, rest, entries)
                new = [r[:6] for r in waited if r[0] in begun] + new
        hold, until = [], {}
        for run, _, us, *_ in new:
            if run not in runs:  # after this time, only a start that is late itself could ask for them
                until[run] = max(until.get(run, us + self.timeout_us), us + self.timeout_us)
        for r in new:
            run, kind, us, tie, _, state = r
            v = runs.get(run)
            if v is None:
                hold.append((*r, until[run]))
            elif kind == "seen":
                if v[0] <= us < v[1]:
                    v[2] += 1
                    if state != "running" and (v[3] is None or (us, tie) < (v[3], v[4])):
                        v[3:] = us, tie, state
            elif us < v[1]:
                hold.append((*r, None))
        if hold:
            if entries >= HELD_ENTRIES:
                entries = self._hold(at, self._held_rows(at, entries) + hold, entries)
            else:
                self.held.updateValue((at, entries), tuple(_columns(hold, len(_HELD))))
                entries += 1
            if until and prune is None:
                prune = max(until.values())
        return self._write(at, runs, entries, prune)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo):
        wm = timerValues.getCurrentWatermarkInMs() * 1000
        if not self.due.exists():
            return iter([])
        due, ms = self.due.get()
        if ms > expiredTimerInfo.getExpiryTimeInMs():
            return iter([])  # a later one has taken its place
        due, answers = list(due), []
        for at, when in enumerate(due):
            if when is not None and when < wm:
                due[at] = self._answer(at, wm, answers)
        self._set_timer(due, ms)
        if not answers:
            return iter([])
        ids, outcome, n_seen = zip(*answers, strict=True)
        return iter([pd.DataFrame({"run_id": pd.array(ids, dtype="Int64"), "outcome": list(outcome), "n_seen": list(n_seen)})])

    def _answer(self, at: int, wm: int, answers: list):
        runs, entries, prune = self._read(at)
        over = {run: runs.pop(run) for run in [k for k, v in runs.items() if v[1] < wm]}
        tasks: dict = {}
        if entries and (over or prune is not None and prune < wm):
            waited = self._held_rows(at, entries)
            stay = []
            for r in waited:
                if r[0] in over:
                    tasks.setdefault(r[0], []).append(r)
                elif r[0] in runs or r[6] is None or r[6] >= wm:
                    stay.append(r)
            if len(stay) != len(waited):
                entries = self._hold(at, stay, entries)
            prune = max((r[6] for r in stay if r[0] not in runs and r[6] is not None), default=None)
        for run, (_, _, n_seen, when, _, decided) in over.items():
            if decided == "success":
                newest: dict = {}
                for _, _, us, tie, task, state, _ in tasks.get(run, ()):
                    if us <= when and (us, tie) >= newest.get(task, (us, tie))[:2]:
                        newest[task] = (us, tie, state)
                if any(state == "failed" for _, _, state in newest.values()):
                    decided = "failed"
            answers.append((run, decided if when is not None and decided is not None else (None if n_seen and when is None else "unknown"), n_seen))
        return self._write(at, runs, entries, prune)


def stream_poll_outcome(
    observations: DataFrame,
    starts: DataFrame,
    timeout_min: int,
    watermark: str = "1 hour",
    tie: str | None = None,
    task_states: DataFrame | None = None,
    task_tie: str | None = None,
) -> DataFrame:
    """Streaming W4.  ``observations(run_id, ts, state[, tie])`` and
    ``starts(run_id, start_ts)`` are streams.  One row per started run once
    the watermark of the observations passes ``start + timeout``, also for
    runs that were never seen (``unknown``); runs still open at the end of the
    input are not answered yet.

    With a stream ``task_states(run_id, task_id, ts, state[, task_tie])`` the
    run's state is rolled up first (A3): a run that would be a ``success`` is
    ``failed`` if the newest attempt of any of its tasks was, as of then.  Both
    inputs have a watermark, and the slower one counts.

    The state is entries of a hash bucket of runs and a timer at its next deadline, whatever
    the number of partitions.  A start counts in event time by its deadline, so it
    is late only when its run can no longer be answered; it does not move the
    watermark."""
    ship_package(observations.sparkSession)
    timeout = max(timeout_min, 0)
    none = F.lit(None).cast("string")

    def rows(df: DataFrame, kind: str, tie_col: str | None, task) -> DataFrame:
        t = F.coalesce(F.col(tie_col).cast("long"), F.lit(0)) if tie_col else F.lit(0).cast("long")
        return df.select("ts", "run_id", F.lit(kind).alias("kind"), F.unix_micros("ts").alias("ts_us"), t.alias("tie"), task.alias("task"), "state")

    all_rows = rows(observations.withWatermark("ts", watermark), "seen", tie, none)
    if task_states is not None:
        all_rows = all_rows.unionByName(rows(task_states.withWatermark("ts", watermark), "task", task_tie, F.col("task_id").cast("string")))
    begun = starts.withColumn("start_ts", F.col("start_ts").cast("timestamp")).withColumn("ts", F.col("start_ts") + F.make_dt_interval(mins=F.lit(timeout)))
    begun = begun.select(
        "ts", "run_id", F.lit("start").alias("kind"), F.unix_micros("start_ts").alias("ts_us"),
        F.lit(0).cast("long").alias("tie"), none.alias("task"), none.alias("state"),
    )
    deal = F.xxhash64("run_id")
    all_rows = all_rows.unionByName(begun).select(
        "ts", "kind", "tie", "task", "state",
        F.pmod(deal, F.lit(BUCKETS)).alias("bucket"), F.pmod(F.shiftright(deal, 32), F.lit(POLL_SLICES)).alias("slice"),
        # Whole numbers stay whole numbers in pandas where none is null.
        F.col("run_id").isNotNull().alias("known"), F.coalesce(F.col("run_id").cast("long"), F.lit(0)).alias("run_id"),
        F.col("ts_us").isNotNull().alias("ok"), F.coalesce("ts_us", F.lit(0)).alias("ts_us"),
    )
    return all_rows.groupBy("bucket").transformWithStateInPandas(
        _Poll(timeout * 60_000_000), POLL_OUTPUT, "Append", "EventTime"
    )


READY_OUTPUT = "run_event_id long, key long, run_ts_us long, up_event_id long, outcome string"
#: An entry of a group holds at most so many rows, and the newest one is filled up first.
READY_ROWS = 512


class _Ready(StatefulProcessor):
    """The keys of one hash bucket in one window of time: runs without an answer, and the upstream
    events that they can use, in entries of some hundred rows.

    A run is answered ``ready`` when the watermark has passed the earliest
    upstream event of its window (no earlier one can come any more),
    ``timed_out`` when it has passed the whole window.  Only entries that gain
    or lose rows are written; a timer stands at the next time at which a
    waiting run can be answered, and one at the end of the group.
    """

    def __init__(self, timeout_us: int, width_us: int) -> None:
        self.timeout_us, self.width_us = timeout_us, width_us

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.kept = {k: handle.getMapState(k, "entry long", "us array<bigint>, ids array<bigint>, keys array<bigint>") for k in ("run", "up")}
        self.next = handle.getValueState("next", "ms long")

    def close(self) -> None:
        pass

    def _entries(self, kind: str) -> dict:
        return {k[0]: list(zip(*v, strict=True)) for k, v in self.kept[kind].iterator()}

    def _answer(self, key, wm: int, came: dict):
        """Add the rows that came, answer what can be answered, drop what is of no use."""
        known = self.next.exists()  # without a timer the group holds nothing
        held = {k: self._entries(k) if known else {} for k in self.kept}
        changed = {k: set() for k in self.kept}
        for kind, rows in came.items():
            at = max(held[kind], default=0)
            while rows:
                entry = held[kind].setdefault(at, [])
                if room := READY_ROWS - len(entry):
                    entry += rows[:room]
                    rows = rows[room:]
                    changed[kind].add(at)
                at += 1
        ups: dict = {}
        for rows in held["up"].values():
            for us, i, k in rows:
                ups.setdefault(k, []).append((us, i))
        for found in ups.values():
            found.sort()
        answers, wake, oldest = [], None, {}
        for at, rows in held["run"].items():
            wait = []
            for row in rows:
                t, event, k = row
                events = ups.get(k, ()) if k is not None else ()
                i = bisect_left(events, (t,))
                found = i < len(events) and events[i][0] <= t + self.timeout_us
                due = events[i][0] if found else t + self.timeout_us
                if due < wm:
                    answers.append((event, k, t, events[i][1] if found else None, "ready" if found else "timed_out"))
                    continue
                wait.append(row)
                wake, oldest[k] = due if wake is None else min(wake, due), min(oldest.get(k, wm), t)
            if len(wait) != len(rows):
                held["run"][at] = wait
                changed["run"].add(at)
        last = (int(key[1]) + 1) * self.width_us + self.timeout_us  # no run of the group waits longer
        for at, rows in held["up"].items():
            use = [r for r in rows if r[0] >= oldest.get(r[2], wm)] if last >= wm else []
            if len(use) != len(rows):
                held["up"][at] = use
                changed["up"].add(at)
        for kind, entries in changed.items():
            for at in entries:
                if held[kind][at]:
                    self.kept[kind].updateValue((at,), tuple(_columns(held[kind][at], 3)))
                elif known:
                    self.kept[kind].removeKey((at,))
        if any(rows for entries in held.values() for rows in entries.values()):
            ms = max((wake if wake is not None else last) // 1000 + 1, wm // 1000 + 1)
            if not known or self.next.get()[0] != ms:
                self.handle.registerTimer(ms)
                self.next.update((ms,))
        elif known:
            self.next.clear()
        if not answers:
            return iter([])
        events, keys, at, found_ids, outcome = zip(*answers, strict=True)
        return iter([pd.DataFrame({
            "run_event_id": list(events), "key": pd.array(keys, dtype="Int64"), "run_ts_us": list(at),
            "up_event_id": pd.array(found_ids, dtype="Int64"), "outcome": list(outcome),
        })])

    def handleInputRows(self, key, rows, timerValues):
        came: dict = {"run": [], "up": []}
        for pdf in rows:
            for kind, us, event, known, k in zip(*[pdf[c].tolist() for c in ("kind", "ts_us", "event_id", "known", "key")], strict=True):
                if known or kind == "run":  # an upstream event without a key is nobody's
                    came[kind].append((us, event, k if known else None))
        for found in came.values():
            found.sort(key=lambda r: r[:2])
        return self._answer(key, timerValues.getCurrentWatermarkInMs() * 1000, came)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo):
        if not self.next.exists() or self.next.get()[0] > expiredTimerInfo.getExpiryTimeInMs():
            return iter([])  # a later one has taken its place
        return self._answer(key, timerValues.getCurrentWatermarkInMs() * 1000, {})


def stream_upstream_ready(
    runs: DataFrame,
    upstream: DataFrame,
    timeout_min: int,
    watermark: str = "1 hour",
    upstream_watermark: str | None = None,
    idle_after: str | None = None,
) -> DataFrame:
    """A run at ``run_ts`` waits for an upstream event of the same key in
    ``[run_ts, run_ts + timeout]``.  One row per run: ``ready`` with the
    earliest upstream event of the window (of equal times the smallest id),
    or ``timed_out``; both once the watermark leaves no other answer.

    Each input has a watermark of its own (``upstream_watermark`` defaults to
    ``watermark``), and the slower one counts: an upstream feed that lags
    behind delays answers instead of making them wrong.  A feed that has gone
    silent would delay them for ever; with ``idle_after`` (an interval) it is taken
    to have come as far as the other feed, less that interval.  (A query that is
    started again from its checkpoint knows how far both have come together; it
    goes on from there once each feed, or its stand-in, has brought rows.)

    Keyed state instead of a stream–stream join, which would emit every (run,
    upstream) pair of a key inside the window.  A key is cut into windows of
    time as long as the timeout, so a run needs the upstream events of its own
    and the next window: those go to two groups, and a hot key is many groups.
    A group holds the keys of a hash bucket, since a group costs far more than its rows.
    The state is entries with a timer, whatever the number of partitions."""
    ship_package(runs.sparkSession)
    timeout_us = int(timeout_min) * 60_000_000
    width_us = max(timeout_us, 60_000_000)
    sides = {
        "run": runs.select(F.lit("run").alias("kind"), F.col("run_event_id").alias("event_id"), "key", F.col("run_ts").alias("ts")),
        "up": upstream.select(F.lit("up").alias("kind"), F.col("up_event_id").alias("event_id"), "key", F.col("up_ts").alias("ts")),
    }
    marked = []
    for kind, other, delay in (("run", "up", watermark), ("up", "run", upstream_watermark or watermark)):
        rows = sides[kind]
        if idle_after is not None:
            beat = sides[other].withColumn("ts", F.col("ts") - F.expr(f"INTERVAL {idle_after}")).withColumn("kind", F.lit("beat"))
            rows = rows.unionByName(beat)
        marked.append(rows.withWatermark("ts", delay))
    first = F.lit(0) if timeout_us == 0 else F.when(F.col("kind") == "up", F.lit(timeout_us)).otherwise(F.lit(0))
    windows = F.sequence(F.floor((F.col("ts_us") - first) / width_us), F.floor(F.col("ts_us") / width_us))
    rows = marked[0].unionByName(marked[1]).withColumn("ts_us", F.unix_micros("ts"))
    # Naming the event time keeps this filter above the watermarks, which the beats are there to move.
    rows = rows.filter((F.col("kind") != "beat") & F.col("ts").isNotNull() | F.col("ts").isNull())
    return (
        # Whole numbers stay whole numbers in pandas where none is null.
        rows.withColumn("bucket", F.pmod(F.xxhash64("key"), F.lit(BUCKETS)))
        .withColumn("known", F.col("key").isNotNull())
        .withColumn("key", F.coalesce(F.col("key").cast("long"), F.lit(0)))
        .withColumn("window", F.explode(windows))
        .groupBy("bucket", "window")
        .transformWithStateInPandas(_Ready(timeout_us, width_us), READY_OUTPUT, "Append", "EventTime")
        .withColumn("run_ts", F.timestamp_micros("run_ts_us"))
        .drop("run_ts_us")
    )


def _written(spark, path: str) -> DataFrame | None:
    try:
        return spark.read.parquet(path)
    except AnalysisException:  # nothing has been written yet
        return None


def stream_failure_alerts(
    tasks: DataFrame,
    fields: dict,
    template: str | None,
    sink: str,
    checkpoint: str,
    id_col: str = "event_id",
) -> None:
    """One alert row per failed task, written by ``foreachBatch``.

    A delivery whose id has an alert already is dropped, however late it
    comes: a micro-batch is compared with the alerts written for the days
    that it holds (the event's own day, so repeats are found there).  No state
    is kept.  Each micro-batch overwrites its own folder ``batch=<id>``, so
    a batch re-run after a failure replaces, not repeats, its output.
    """
    root = sink.rstrip("/")
    alerts = tasks.filter(F.col("state") == "failed").select(
        id_col,
        "ts",
        render_message(F.lit(template) if template else None, fields, DEFAULT_FAILURE_MESSAGE).alias("message"),
        F.coalesce(F.date_format("ts", "yyyy-MM-dd"), F.lit("none")).alias("day"),
    )

    def write_batch(batch: DataFrame, batch_id: int) -> None:
        new = batch.dropDuplicates([id_col])
        before = _written(batch.sparkSession, root)
        if before is not None:
            old = before.filter(F.col("batch") != batch_id).select(id_col, F.col("day").cast("string").alias("day"))
            old = old.join(batch.select("day").distinct(), "day", "left_semi").select(id_col)
            new = new.join(old, id_col, "left_anti")
        new.write.mode("overwrite").partitionBy("day").parquet(f"{root}/batch={batch_id}")

    run_available_now(tasks.sparkSession, alerts.writeStream.foreachBatch(write_batch), checkpoint)


#: How the partial value of a measure is merged with others of its kind.
MERGES = {"count": F.sum, "sum": F.sum, "min": F.min, "max": F.max}
Measures = dict[str, tuple[str, Column | str]]


def _partial(rows: DataFrame, keys: Sequence[str], measures: Measures) -> DataFrame:
    first = {"count": F.count, "sum": F.sum, "min": F.min, "max": F.max}
    return rows.groupBy(*keys).agg(*[first[kind](F.expr(col) if isinstance(col, str) else col).alias(name) for name, (kind, col) in measures.items()])


def _merged(parts: DataFrame, keys: Sequence[str], measures: Measures) -> DataFrame:
    return parts.groupBy(*keys).agg(*[MERGES[kind](name).alias(name) for name, (kind, _) in measures.items()])


def _compacted_upto(spark, ledger: str) -> int | None:
    marks = _written(spark, f"{ledger}/marks")
    return None if marks is None else marks.agg(F.max("upto")).first()[0]


def incremental_run(stream: DataFrame, keys: Sequence[str], measures: Measures, ledger: str, checkpoint: str) -> None:
    """T4: pick up files that arrived since the last run, and nothing else.

    ``measures`` are ``name -> (kind, column or SQL expression)`` with a kind of ``MERGES``.  A
    micro-batch is aggregated to partial values per ``keys``, which become its
    entry in the ledger: a folder of its own, named by the batch id.  A batch
    that is run again after a failure replaces its entry.  A run reads the new
    files only; late files are entries like any other, and a run without new
    files adds none.  ``ledger_totals`` merges the entries, ``compact_ledger``
    folds old ones into one.
    """
    spark, root = stream.sparkSession, ledger.rstrip("/")

    def entry(rows: DataFrame, batch_id: int) -> None:
        _partial(rows, keys, measures).write.mode("overwrite").parquet(f"{root}/batches/batch={batch_id}")

    if _written(spark, f"{root}/batches") is None:
        entry(spark.createDataFrame([], stream.schema), -1)  # the columns, for a reader before the first file
    run_available_now(spark, stream.writeStream.foreachBatch(entry), checkpoint)


def ledger_totals(spark: SparkSession, ledger: str, keys: Sequence[str], measures: Measures) -> DataFrame:
    """The totals of all files read by ``incremental_run``: one row per ``keys``."""
    root = ledger.rstrip("/")
    parts, upto = _written(spark, f"{root}/batches"), _compacted_upto(spark, root)
    if upto is not None:
        base = spark.read.parquet(f"{root}/base/upto={upto}")
        parts = parts.filter(F.col("batch") > upto).select(*base.columns).unionByName(base)
    return _merged(parts, keys, measures)


def compact_ledger(spark: SparkSession, ledger: str, keys: Sequence[str], measures: Measures) -> int | None:
    """Fold all entries but the newest (which may still be run again) into one base.

    Returns the newest batch folded, None if there was nothing to fold.  The
    base counts from the moment its mark is written; a compaction that fails
    before leaves everything as it was, and is simply run again.
    """
    root = ledger.rstrip("/")
    entries, upto = _written(spark, f"{root}/batches"), _compacted_upto(spark, root)
    if entries is None:
        return None
    # Batch ids from the folder names, one small row each; an entry without rows counts as well.
    ids = sorted(int(name.rpartition("=")[2]) for name in list_folder(spark, f"{root}/batches") if name.startswith("batch="))
    old = [i for i in ids[:-1] if upto is None or i > upto]
    if not old:
        return None
    parts = entries.filter((F.col("batch") <= old[-1]) & (F.lit(True) if upto is None else F.col("batch") > upto)).drop("batch")
    if upto is not None:
        parts = parts.unionByName(spark.read.parquet(f"{root}/base/upto={upto}"))
    types = dict(parts.dtypes)
    folded = _merged(parts, keys, measures).select(*[F.col(c).cast(types[c]).alias(c) for c in parts.columns])
    folded.write.mode("overwrite").parquet(f"{root}/base/upto={old[-1]}")
    spark.range(1).select(F.lit(old[-1]).cast("long").alias("upto")).write.mode("append").parquet(f"{root}/marks")
    # Only the entry that holds the columns and those not folded stay.
    for i in old:
        if i >= 0:
            remove_folder(spark, f"{root}/batches/batch={i}")
    if upto is not None:
        remove_folder(spark, f"{root}/base/upto={upto}")
    return old[-1]
