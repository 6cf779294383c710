"""Layered lookups: tagged profiles (J2) and ordered overlays."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..constants import DEFAULT_PROFILE, RESOURCES_PREFIX
from ..functions.tags import tag_value


def assign_profile(
    nodes: DataFrame,
    profiles: DataFrame,
    prefix: str = RESOURCES_PREFIX,
    unknown_uses_default: bool = False,
) -> DataFrame:
    """The profile of each node.

    The node's ``prefix`` tag names the profile; no tag → ``__default__``;
    a tag naming an unknown profile → an empty profile (all settings null,
    maps empty) unless ``unknown_uses_default``.  Output: node keys,
    ``profile_key`` (asked for), ``profile`` (found, null if none) and the
    profile's columns.
    """
    key = F.coalesce(tag_value("tags", prefix, separator_len=0), F.lit(DEFAULT_PROFILE))
    asked = nodes.select("pipeline", "node", key.alias("profile_key"))
    lookup_key = F.col("profile_key")
    if unknown_uses_default:
        known = profiles.select(F.col("profile").alias("_known")).distinct()
        asked = asked.join(known, asked.profile_key == known._known, "left")
        lookup_key = F.when(F.col("_known").isNull(), F.lit(DEFAULT_PROFILE)).otherwise(F.col("profile_key"))
    asked = asked.withColumn("_lookup", lookup_key)
    p = profiles.withColumnRenamed("profile", "_p")
    prof_cols = [c for c in profiles.columns if c != "profile"]
    return asked.join(p, asked._lookup == p._p, "left").select(
        "pipeline", "node", "profile_key", F.col("_p").alias("profile"), *prof_cols
    )


def overlay(layers: DataFrame, entity: str = "entity") -> DataFrame:
    """``(entity, key, value)`` where the highest layer holding a key
    wins, also when its value is null (a present null overrides)."""
    return layers.groupBy(entity, "key").agg(F.max_by("value", "layer").alias("value"), F.max("layer").alias("layer"))


def overlay_map(layers: DataFrame, entity: str = "entity") -> DataFrame:
    """W5 as one ``MAP`` per entity, keys sorted."""
    return overlay(layers, entity).groupBy(entity).agg(
        F.map_from_entries(F.array_sort(F.collect_list(F.struct("key", "value")))).alias("conf")
    )
