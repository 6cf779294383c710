"""State of T1 and T2 by hash buckets: the processors on a plain state, many keys in a group, against brute force."""

import random
from types import SimpleNamespace

import pandas as pd

from flowtables.streaming import stateful as ST

MIN = 60_000_000


class _Store(dict):
    """Map and value state, with a count of what a call to the state server would be."""

    def __init__(self, calls):
        super().__init__()
        self.calls = calls

    def _call(self):
        self.calls.append(1)

    def getValue(self, k):
        self._call()
        return super().get(k)

    def updateValue(self, k, v):
        self._call()
        self[k] = v

    def removeKey(self, k):
        self._call()
        self.pop(k, None)

    def iterator(self):
        self._call()
        return iter(list(self.items()))

    def exists(self):
        return bool(self)

    def get(self):
        self._call()
        return super().get(0)

    def update(self, v):
        self._call()
        self[0] = v


class _Handle:
    def __init__(self):
        self.calls, self.timers, self.stores = [], set(), []

    def _new(self, *_):
        self.stores.append(_Store(self.calls))
        return self.stores[-1]

    getMapState = getValueState = _new

    def registerTimer(self, ms):
        self.timers.add(ms)


def _batch(proc, handle, key, rows, wm):
    """One micro-batch at the watermark ``wm`` (microseconds): rows, then timers."""
    times = SimpleNamespace(getCurrentWatermarkInMs=lambda: wm // 1000)
    out = list(proc.handleInputRows(key, iter([rows]), times)) if len(rows) else []
    for ms in sorted(t for t in handle.timers if t <= wm // 1000):
        handle.timers.discard(ms)
        out += proc.handleExpiredTimer(key, times, SimpleNamespace(getExpiryTimeInMs=lambda ms=ms: ms))
    return [tuple(None if pd.isna(x) else x for x in r) for df in out for r in df.itertuples(index=False)]


def _check_ready(monkeypatch, entry_rows, keys, n):
    monkeypatch.setattr(ST, "READY_ROWS", entry_rows)
    rnd, width = random.Random(n), 60 * MIN
    runs = [(rnd.randrange(0, width), i, rnd.randrange(keys)) for i in range(n)]
    ups = [(rnd.randrange(0, 2 * width), 10_000 + i, rnd.randrange(keys)) for i in range(n // 2)]
    no_key = (30 * MIN, 99_999)
    handle = _Handle()
    proc = ST._Ready(width, width)
    proc.init(handle)
    got = []
    for i in range(4):
        lo, hi = (-1 if i == 0 else i * width // 2), ((i + 1) * width // 2 if i < 3 else 9 * width)
        rows = [("run", t, e, True, k) for t, e, k in runs if lo <= t < hi] + [("up", t, e, True, k) for t, e, k in ups if lo <= t < hi]
        rows += [("run", *no_key, False, 0), ("up", *no_key, False, 0)] if i == 0 else []
        rnd.shuffle(rows)
        got += _batch(proc, handle, (5, 0), pd.DataFrame(rows, columns=["kind", "ts_us", "event_id", "known", "key"]), max(lo, 0))
    got += _batch(proc, handle, (5, 0), pd.DataFrame(), 9 * width)
    want = [(no_key[1], None, no_key[0], None, "timed_out")]
    for t, e, k in runs:
        found = min(((u, i) for u, i, key in ups if key == k and t <= u <= t + width), default=None)
        want.append((e, k, t, found and found[1], "ready" if found else "timed_out"))
    assert sorted(got, key=str) == sorted(want, key=str)
    assert not any(handle.stores)  # nothing is kept of what is answered
    return len(handle.calls)


def test_keys_of_a_bucket_share_state(monkeypatch):
    _check_ready(monkeypatch, 4, 7, 60)
    # 300 keys with 600 rows: what is asked of the state server grows with entries, not with keys.
    assert _check_ready(monkeypatch, 512, 300, 400) < 100


def test_runs_of_a_bucket_share_state(monkeypatch):
    monkeypatch.setattr(ST, "POLL_SLICES", 4)
    monkeypatch.setattr(ST, "HELD_ENTRIES", 2)
    rnd, timeout, n = random.Random(8), 60 * MIN, 200
    starts = {i: rnd.randrange(0, 40 * MIN) for i in range(n)}
    obs = [(rnd.randrange(n + 9), "seen", rnd.randrange(0, 180 * MIN), i, None, rnd.choice(["running", "running", "success", "failed", None])) for i in range(900)]
    tasks = [(rnd.randrange(n), "task", rnd.randrange(0, 90 * MIN), i, rnd.choice("ab"), rnd.choice(["success", "failed"])) for i in range(300)]
    handle = _Handle()
    proc = ST._Poll(timeout)
    proc.init(handle)
    got = []
    for i in range(6):
        lo, hi = i * 30 * MIN, (i + 1) * 30 * MIN
        rows = [r for r in obs + tasks if lo <= r[2] < hi]
        rows += [(r, "start", s, 0, None, None) for r, s in starts.items() if r % 2 == i]  # known at once, or after the first rows
        rows += [(0, "seen", 0, 0, None, "failed")]
        frame = pd.DataFrame([(r[0] % 4, True, *r, r[2:4] != (0, 0)) for r in rows], columns=["slice", "known", "run_id", "kind", "ts_us", "tie", "task", "state", "ok"])
        frame.loc[len(frame)] = (1, False, 0, "seen", 5, 1, None, "failed", True)  # of no run
        got += _batch(proc, handle, (3,), frame, max(lo - 10 * MIN, 0))
    got += _batch(proc, handle, (3,), pd.DataFrame(), 900 * MIN)
    want = []
    for run, s in starts.items():
        seen = [(us, tie, state) for r, _, us, tie, _, state in obs if r == run and s <= us < s + timeout]
        first = min(((us, tie, state) for us, tie, state in seen if state != "running"), key=lambda x: x[:2], default=None)
        outcome = first[2] or "unknown" if first else None if seen else "unknown"
        if outcome == "success":
            newest = {}
            for r, _, us, tie, task, state in tasks:
                if r == run and us <= first[0]:
                    newest[task] = max(newest.get(task, (us, tie, state)), (us, tie, state))
            if any(x[2] == "failed" for x in newest.values()):
                outcome = "failed"
        want.append((run, outcome, len(seen)))
    assert sorted(got) == sorted(want, key=lambda x: x[0]) and {o for _, o, _ in got} == {"success", "failed", "unknown", None}
    assert not any(handle.stores)
    assert len(handle.calls) < 400  # for 200 runs, 1,200 rows and 7 micro-batches
