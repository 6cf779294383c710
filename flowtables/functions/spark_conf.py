"""Per-worker Spark settings (F10) and array-of-map settings to rows."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..constants import WORKER_TYPES

# Setting names written once per worker type ({w}).
RESOURCE_KEYS = {
    "limits_memory": "spark.{w}.memory",
    "limits_cpu": "spark.kubernetes.{w}.limit.cores",
    "requests_cpu": "spark.{w}.cores",
}
STORAGE_PREFIX = "spark.kubernetes.{w}.volumes.persistentVolumeClaim.spark-local-dir-1"
STORAGE_CLAIM = "OnDemand"
STORAGE_MOUNT = "/storage"
SECRET_KEY = "spark.kubernetes.{w}.secrets."
LABEL_KEY = "spark.kubernetes.{w}.label."


def _c(col: Column | str) -> Column:
    return F.col(col) if isinstance(col, str) else col


def _truthy(c: Column) -> Column:
    return c.isNotNull() & (c.cast("string") != "")


def _key(pattern: str, w: Column) -> Column:
    head, tail = pattern.split("{w}")
    return F.concat(F.lit(head), w, F.lit(tail))


def _prefixed_entry(prefix: str, w: Column):
    head, tail = prefix.split("{w}")

    def entry(e: Column) -> Column:
        return F.struct(F.concat(F.lit(head), w, F.lit(tail), e["key"]).alias("k"), e["value"].alias("v"))

    return entry


def fan_out_keys(
    df: DataFrame,
    entity_col: str,
    resources: Mapping[str, str] | None = None,
    storage_class: str | None = None,
    storage_size: str | None = None,
    secrets: str | None = None,
    labels: str | None = None,
) -> DataFrame:
    """``(entity, conf_key, conf_value)`` with each setting written once
    per worker type; unset (null or '') resource settings are left out;
    storage keys appear only when both class and size are set; every entry of
    the secrets and labels is written, empty values too.

    The two worker types come from ``explode`` of a literal array on each
    row (no join); map settings (secrets, labels) fan out with
    ``map_entries``.
    """
    resources = resources if resources is not None else {k: k for k in RESOURCE_KEYS}
    w = F.col("_w")
    pairs: list[Column] = []
    for name, col in resources.items():
        v = _c(col).cast("string")
        pairs.append(F.filter(F.array(F.struct(_key(RESOURCE_KEYS[name], w).alias("k"), v.alias("v"))), lambda e: _truthy(e["v"])))
    if storage_class and storage_size:
        cls, size = _c(storage_class).cast("string"), _c(storage_size).cast("string")
        both = _truthy(cls) & _truthy(size)
        storage = F.array(
            *[
                F.struct(_key(STORAGE_PREFIX + suffix, w).alias("k"), value.alias("v"))
                for suffix, value in (
                    (".options.claimName", F.lit(STORAGE_CLAIM)),
                    (".options.storageClass", cls),
                    (".options.sizeLimit", size),
                    (".mount.path", F.lit(STORAGE_MOUNT)),
                    (".mount.readOnly", F.lit("false")),
                )
            ]
        )
        pairs.append(F.when(both, storage).otherwise(F.array().cast("array<struct<k:string,v:string>>")))
    for prefix, mcol in ((SECRET_KEY, secrets), (LABEL_KEY, labels)):
        if mcol is None:
            continue
        pairs.append(
            F.transform(
                F.map_entries(F.coalesce(_c(mcol), F.create_map().cast("map<string,string>"))),
                _prefixed_entry(prefix, w),
            )
        )
    all_pairs = F.flatten(F.array(*pairs))
    return (
        df.select(entity_col, F.explode(F.array(*[F.lit(x) for x in WORKER_TYPES])).alias("_w"), *[
            c for c in df.columns if c != entity_col
        ])
        .select(entity_col, F.explode(all_pairs).alias("_p"))
        .select(entity_col, F.col("_p.k").alias("conf_key"), F.col("_p.v").alias("conf_value"))
    )


# Fields of a mounted secret, of a toleration, and the default deploy type.
MOUNT_FIELDS = ("secret", "deploy_type", "deploy_target", "key")
TOLERATION_FIELDS = ("effect", "key", "operator", "value")
DEFAULT_DEPLOY_TYPE = "env"


def explode_maps(df: DataFrame, id_col: str, array_col: str, fields: Sequence[str], defaults: Mapping[str, str] | None = None) -> DataFrame:
    """array-of-map settings → one row per element, missing fields null
    or their default.  Rows with an empty or null array are kept once with
    all fields null."""
    e = F.col("_m")
    cols = []
    for f in fields:
        value = F.try_element_at(e, F.lit(f))
        if defaults and f in defaults:
            value = F.when(e.isNull() | F.map_contains_key(e, f), value).otherwise(F.lit(defaults[f]))
        cols.append(value.alias(f))
    return df.select(id_col, F.posexplode_outer(array_col).alias("pos", "_m")).select(id_col, "pos", *cols)


def explode_mounts(df: DataFrame, id_col: str, array_col: str) -> DataFrame:
    """F12 for mounted secrets: ``deploy_type`` is ``env`` when absent."""
    return explode_maps(df, id_col, array_col, MOUNT_FIELDS, {"deploy_type": DEFAULT_DEPLOY_TYPE})


def explode_tolerations(df: DataFrame, id_col: str, array_col: str) -> DataFrame:
    """F12 for tolerations: effect, key, operator and value, null when absent."""
    return explode_maps(df, id_col, array_col, TOLERATION_FIELDS)
