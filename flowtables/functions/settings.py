"""Settings read with defaults.

Settings are ``MAP<STRING,STRING>`` columns.  A missing key and a key whose
value is null are different: a default replaces only a missing key.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Fixed value: message of a missing required setting.
MISSING_MESSAGE = "Missing required configuration: '{name}'."


def _c(col: Column | str) -> Column:
    return F.col(col) if isinstance(col, str) else col


def _lit(value) -> Column:
    return value if isinstance(value, Column) else F.lit(value)


def setting(m: Column | str, key: str, default=None) -> Column:
    """Value of ``key``; ``default`` only when the key is absent.

    A present key with a null value stays null (``coalesce`` would wrongly
    replace it).
    """
    m = _c(m)
    return F.when(F.map_contains_key(m, key), F.try_element_at(m, F.lit(key))).otherwise(_lit(default))


def with_defaults(df: DataFrame, map_col: str, defaults: Mapping[str, object]) -> DataFrame:
    """P7 over a frame: one column per key in ``defaults``."""
    return df.select("*", *[setting(map_col, k, d).alias(k) for k, d in defaults.items()])


def missing_keys(df: DataFrame, id_col: str, map_col: str, keys: Iterable[str], prefix: str = "") -> DataFrame:
    """P8, report form: ``(id, key, message)`` for every required key that is
    absent.  A present key with a null value passes."""
    keys = list(keys)
    return (
        df.select(id_col, F.explode(F.array(*[F.lit(k) for k in keys])).alias("key"), map_col)
        .filter(~F.map_contains_key(F.col(map_col), F.col("key")))
        .select(
            id_col,
            "key",
            F.format_string(MISSING_MESSAGE.replace("{name}", "%s%s"), F.lit(prefix), F.col("key")).alias(
                "message"
            ),
        )
    )


def required(m: Column | str, key: str, prefix: str = "") -> Column:
    """P8, strict form: the value, or a task failure when the key is absent."""
    m = _c(m)
    return F.when(F.map_contains_key(m, key), F.try_element_at(m, F.lit(key))).otherwise(
        F.raise_error(F.lit(MISSING_MESSAGE.format(name=prefix + key))).cast("string")
    )


def dependent_default(m: Column | str, key: str, other: str, prefix: str = "") -> Column:
    """``key`` if present, else the value of ``other``.

    ``other`` is required in both cases (it is read before ``key`` is
    looked at), so its absence fails like P8.
    """
    m = _c(m)
    other_value = required(m, other, prefix)
    return F.when(F.map_contains_key(m, other), setting(m, key, other_value)).otherwise(other_value)


def truthy_or_empty(col: Column | str) -> Column:
    """P10: null, empty string, numeric zero and false become ''; other values
    are returned as strings.  The string '0' is kept."""
    c = _c(col)
    text, kind = c.cast("string"), F.typeof(c)
    zero = (kind != "string") & F.coalesce(text.try_cast("double") == 0, F.lit(False))
    return F.when(c.isNull() | zero | ((kind == "boolean") & (text == "false")), F.lit("")).otherwise(text)


def truthy_or_empty_number(col: Column | str) -> Column:
    """P10 for numeric columns: null and 0 → ''."""
    c = _c(col)
    return F.when(c.isNull() | (c == 0), F.lit("")).otherwise(c.cast("string"))


def truthy_map(m: Column | str) -> Column:
    """P10 for maps: drop entries whose value is null or ''."""
    return F.map_filter(_c(m), lambda k, v: v.isNotNull() & (v != ""))


def first_set(*cols: Column | str, default=None) -> Column:
    """First value that is neither null nor '', else ``default``."""
    parts = [F.nullif(_c(c), F.lit("")) for c in cols]
    return F.coalesce(*parts, _lit(default))
