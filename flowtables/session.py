"""Session set-up and lineage cutting.

Iterative operators (connected groups, absorption, levelling) loop on the
driver and run one distributed round per iteration.  After each round the
round's result is written as Parquet below the shared checkpoint folder and
read back, so the plan of the next round starts from stored files: lineage
stays one round deep and a lost executor only costs the current round.  What
the rounds stored is deleted when the loop is over (``stored_rounds``).
"""

from __future__ import annotations

import os
import tempfile
import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

_OWN_KEY = "flowtables.checkpoint.dir"


def build_session(
    master: str | None = None,
    shuffle_partitions: int | None = None,
    app_name: str = "flowtables",
    driver_memory: str = "16g",
) -> SparkSession:
    """Session used by tests and the benchmark.

    On a cluster the session comes from spark-submit; the library only needs
    AQE (runtime re-planning, partition coalescing, skew-join splitting) and
    UTC timestamps, which are the settings below.
    """
    master = master or os.environ.get("FLOWTABLES_MASTER", "local[8]")
    cores = master[len("local[") : -1] if master.startswith("local[") else "8"
    if shuffle_partitions is None:
        shuffle_partitions = int(cores) if cores.isdigit() else 8
    builder = (
        SparkSession.builder.master(master)
        .appName(app_name)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", driver_memory)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.sql.streaming.stateStore.providerClass",
                "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
    )
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def _is_local(spark: SparkSession) -> bool:
    try:
        master = spark.conf.get("spark.master", "")
    except Exception:  # pragma: no cover - Connect sessions
        master = ""
    return (master or "").startswith("local")


def checkpoint_root(spark: SparkSession) -> str:
    """Shared folder for lineage cuts: the folder given to
    ``setCheckpointDir`` if there is one, else the cluster's
    ``spark.checkpoint.dir``.

    Only when the session names none (local tests) a private folder is made;
    on a cluster a missing setting is an error, since a machine-local folder
    is not visible to other executors.
    """
    try:
        explicit = spark.sparkContext.getCheckpointDir()
    except Exception:  # pragma: no cover - Connect sessions
        explicit = None
    for value in (explicit, spark.conf.get("spark.checkpoint.dir", None), spark.conf.get(_OWN_KEY, None)):
        if value:
            return value
    if not _is_local(spark):
        raise RuntimeError(
            "spark.checkpoint.dir is not set; iterative operators need a "
            "shared folder to cut lineage"
        )
    value = tempfile.mkdtemp(prefix="flowtables-ckpt-")
    try:
        spark.sparkContext.setCheckpointDir(value)
    except Exception:  # pragma: no cover - Connect sessions
        pass
    spark.conf.set(_OWN_KEY, value)
    return value


def scratch_path(spark: SparkSession, name: str) -> str:
    return f"{checkpoint_root(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


_SCOPES: list[list[str]] = []


def _store(df: DataFrame, writer: DataFrame, name: str) -> DataFrame:
    path = scratch_path(df.sparkSession, name)
    writer.write.mode("overwrite").parquet(path)
    if _SCOPES:
        _SCOPES[-1].append(path)
    out = df.sparkSession.read.schema(df.schema).parquet(path)
    out._stored_at = path
    return out


def cut_lineage(df: DataFrame, name: str = "round") -> DataFrame:
    """Write ``df`` to the shared checkpoint folder and read it back.

    One pass over the data (``checkpoint()`` on an uncached frame computes
    it twice), columnar, and the read-back carries file-size statistics that
    AQE and the broadcast threshold can use in the next round.
    """
    return _store(df, df, name)


def stored_once(df: DataFrame, name: str) -> DataFrame:
    """``df`` itself if it is the read-back of a cut, else a cut of it."""
    return df if hasattr(df, "_stored_at") else cut_lineage(df, name)


def cut_lineage_counting(df: DataFrame, name: str, **metrics) -> tuple[DataFrame, dict]:
    """``cut_lineage`` that also returns aggregate ``metrics`` (name →
    Column) computed while the rows are written: no second job to count."""
    from pyspark.sql import Observation

    obs = Observation(f"{name}-{uuid.uuid4().hex[:8]}")
    observed = df.observe(obs, *[col.alias(key) for key, col in metrics.items()])
    out = _store(df, observed, name)
    values = obs.get
    return out, {k: values.get(k) for k in metrics}


@contextmanager
def stored_rounds(spark: SparkSession) -> Iterator[Callable[[DataFrame], DataFrame]]:
    """Delete what the rounds of a loop stored when the loop is over.

    Yields ``keep``: the frames it is given (made by ``cut_lineage``) stay and
    pass to the enclosing scope; all others stored inside go, so nothing that
    is returned may still read them.  After an error everything stays.
    """
    mine: list[str] = []
    kept: list[str] = []

    def keep(df: DataFrame) -> DataFrame:
        kept.append(df._stored_at)
        return df

    _SCOPES.append(mine)
    try:
        yield keep
    finally:
        _SCOPES.pop()
    for path in mine:
        if path in kept:
            if _SCOPES:
                _SCOPES[-1].append(path)
        else:
            remove_folder(spark, path)


def remove_folder(spark: SparkSession, path: str) -> None:
    """Delete a folder through Spark's own file system layer."""
    jvm = getattr(spark, "_jvm", None)
    if jvm is None:  # pragma: no cover - Connect sessions leave it
        return
    folder = jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


def path_exists(spark: SparkSession, path: str) -> bool:
    """Whether a file or folder is there, asked through Spark's own file system layer."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark._jsc.hadoopConfiguration()).exists(place)


def list_folder(spark: SparkSession, path: str) -> list[str]:
    """Names in a folder, through Spark's own file system layer."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    return [x.getPath().getName() for x in folder.getFileSystem(spark._jsc.hadoopConfiguration()).listStatus(folder)]


_SHIPPED_KEY = "flowtables.package.shipped"


def ship_package(spark: SparkSession) -> None:
    """Make this package importable in Python workers (operators whose
    functions run inside tasks need it), once per session: zip it on the
    driver and register it with ``addPyFile``, which serves it to every
    executor (``addArtifacts`` on Spark Connect)."""
    try:
        if spark.conf.get(_SHIPPED_KEY, None) == "1":
            return
    except Exception:
        pass
    import shutil

    pkg_dir = os.path.dirname(os.path.abspath(__file__))
    archive = shutil.make_archive(
        os.path.join(tempfile.mkdtemp(prefix="flowtables-pkg-"), "flowtables"),
        "zip",
        root_dir=os.path.dirname(pkg_dir),
        base_dir=os.path.basename(pkg_dir),
    )
    try:
        spark.sparkContext.addPyFile(archive)
    except Exception:
        spark.addArtifacts(archive, pyfile=True)
    spark.conf.set(_SHIPPED_KEY, "1")
