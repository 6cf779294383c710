"""Pipeline registry listing (O1)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.tags import has_tag_prefix, tag_names, tag_value
from .ranking import number_within


def list_pipelines(registry: DataFrame, filter_prefix: str, name_prefix: str) -> DataFrame:
    """O1: ``(position, name, dag_id)`` of entries having a tag that starts
    with ``filter_prefix``; ``name`` is the value of the ``name_prefix``
    tag (null when missing, listed last); sorted by name then id.

    The filter comes first, so no entry is lost to paging.  ``position``
    is the 0-based place in the sorted list, computed by range partitions
    (no single task sorts the whole registry).
    """
    names = tag_names("tags")
    rows = registry.filter(has_tag_prefix(names, filter_prefix)).select(
        tag_value(names, name_prefix).alias("name"), "dag_id"
    )
    rows = rows.withColumn("_missing", F.col("name").isNull())
    return number_within(rows, [], ["_missing", "name", "dag_id"], out="position").drop("_missing")
