"""String functions (F1, F2, F5, F6, F7, F8, F9) as Column expressions."""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..constants import VAR_DEFAULTS, VAR_PREFIX

# Latin letters that have no decomposition, and their spelling in ASCII when slugged.
SLUG_LETTERS = {
    "ß": "ss", "ẞ": "ss", "œ": "oe", "Œ": "oe", "æ": "ae", "Æ": "ae", "þ": "th", "Þ": "th",
    "ø": "o", "Ø": "o", "ł": "l", "Ł": "l", "đ": "d", "Đ": "d", "ð": "d", "Ð": "d", "ı": "i", "ħ": "h", "Ħ": "h",
    "ŋ": "ng", "Ŋ": "ng", "ŧ": "t", "Ŧ": "t", "ĸ": "k",
}

# Cyrillic and Greek letters (lower case) and their spelling in ASCII when slugged.
SLUG_ALPHABETS = {
    "а": "a", "б": "b", "в": "v", "г": "g", "д": "d", "е": "e", "ё": "io", "ж": "zh", "з": "z", "и": "i", "й": "i",
    "к": "k", "л": "l", "м": "m", "н": "n", "о": "o", "п": "p", "р": "r", "с": "s", "т": "t", "у": "u", "ф": "f",
    "х": "kh", "ц": "ts", "ч": "ch", "ш": "sh", "щ": "shch", "ъ": "", "ы": "y", "ь": "", "э": "e", "ю": "iu", "я": "ia",
    "є": "ie", "і": "i", "ї": "yi", "ґ": "g",
    "α": "a", "β": "b", "γ": "g", "δ": "d", "ε": "e", "ζ": "z", "η": "e", "θ": "th", "ι": "i", "κ": "k", "λ": "l",
    "μ": "m", "ν": "n", "ξ": "x", "ο": "o", "π": "p", "ρ": "r", "σ": "s", "ς": "s", "τ": "t", "υ": "u", "φ": "ph",
    "χ": "kh", "ψ": "ps", "ω": "o",
}


def _accent_table() -> tuple[str, str]:
    """Characters that decompose into a letter or digit of one of the known
    alphabets and combining marks, mapped to it; built by rule from the
    Unicode database, over all of it."""
    src, dst = [], []
    for cp in range(0x00C0, 0x110000):
        ch = chr(cp)
        if ch.lower() in SLUG_ALPHABETS or unicodedata.category(ch) in ("Cs", "Co", "Cn"):
            continue
        d = unicodedata.normalize("NFD", ch)
        if len(d) < 2 or not all(unicodedata.combining(x) for x in d[1:]):
            continue
        if d[0].isascii() and d[0].isalnum() or d[0].lower() in SLUG_ALPHABETS:
            src.append(ch)
            dst.append(d[0])
    return "".join(src), "".join(dst)


_ACCENTED, _PLAIN = _accent_table()


def _spelled(c: Column, letters: Mapping[str, str]) -> Column:
    """Replace letters by their spelling; rows without any are left alone."""
    single = [(k, v) for k, v in letters.items() if len(v) == 1]
    out = F.translate(c, "".join(k for k, _ in single), "".join(v for _, v in single))
    for k, v in letters.items():
        if len(v) != 1:
            out = F.replace(out, F.lit(k), F.lit(v))
    return F.when(c.rlike("[" + "".join(letters) + "]"), out).otherwise(c)


def _c(col: Column | str) -> Column:
    return F.col(col) if isinstance(col, str) else col


def slugify(col: Column | str) -> Column:
    """ASCII, lower case, every run of other characters → '-', trimmed.

    Accents are dropped, letters without decomposition and those of the
    Cyrillic and Greek alphabets are spelled in ASCII, and a comma between
    digits goes, before the text is lowered and cut down to ``[a-z0-9-]``.
    Letters of other alphabets count as other characters.  The whole text is processed.
    """
    whole = _c(col)
    spelled = _spelled(F.lower(_spelled(F.translate(whole, _ACCENTED, _PLAIN), SLUG_LETTERS)), SLUG_ALPHABETS)
    # A text of ASCII alone has nothing to spell.
    c = F.when(whole.rlike(r"[^\x00-\x7F]"), spelled).otherwise(F.lower(whole))
    c = F.regexp_replace(c, r"(?<=[0-9]),(?=[0-9])", "")
    c = F.regexp_replace(c, r"[^a-z0-9]+", "-")
    return F.btrim(c, F.lit("-"))


def ts_nodash(ts: Column | str) -> Column:
    return F.date_format(_c(ts), "yyyyMMdd'T'HHmmss")


def run_scoped_name(project: Column | str, ts: Column | str) -> Column:
    """``slug(project) + '.' + lower(ts_nodash)``, name of a run's area."""
    return F.concat(slugify(project), F.lit("."), F.lower(ts_nodash(ts)))


def _last_wins(entries: Column) -> Column:
    """``ARRAY<STRUCT<key, value>>`` → map; of equal keys the last one counts."""

    def kept(all_of: Column) -> Column:
        later = lambda i: F.slice(all_of, i + 2, F.size(all_of))
        return F.filter(all_of, lambda e, i: ~F.exists(later(i), lambda x: x["key"] == e["key"]))

    # Through an array of one, so that the entries are computed once.
    return F.map_from_entries(F.element_at(F.transform(F.array(entries), kept), 1))


def render_params(m: Column | str) -> Column:
    """``k:v`` pairs, sorted by key, joined by ','; a null value is written ``None``."""
    entries = F.array_sort(F.map_entries(_c(m)))
    pair = lambda e: F.concat(e["key"], F.lit(":"), F.coalesce(e["value"].cast("string"), F.lit("None")))
    return F.array_join(F.transform(entries, pair), ",")


def parse_params(text: Column | str) -> Column:
    """F5 back: ``k:v`` pairs split on ',' (blank pairs and padding ignored),
    each pair split on its first ':' so values may contain ':'.  Of repeated
    keys the last one counts; a pair without ':' fails."""
    pairs = F.filter(
        F.transform(F.split(_c(text), ","), lambda p: F.regexp_replace(p, r"^\s+|\s+$", "")),
        lambda p: p != "",
    )
    checked = lambda p: F.when(F.locate(":", p) > 0, p).otherwise(
        F.raise_error(F.concat(F.lit("parameter without ':': "), p)).cast("string")
    )
    entries = F.transform(
        F.transform(pairs, checked),
        lambda p: F.struct(
            F.regexp_replace(F.substring_index(p, ":", 1), r"\s+$", "").alias("key"),
            F.regexp_replace(F.substring(p, F.locate(":", p) + 1, F.length(p)), r"^\s+", "").alias("value"),
        ),
    )
    return _last_wins(entries)


def _filled(text: Column, token: str, value) -> Column:
    """Cut ``text`` once into the pieces that match ``token`` and the rest, and
    put ``value(piece)`` in place of each piece; what is put in is not read again."""
    pieces = F.regexp_extract_all(text, F.lit(rf"(?s)({token}|.)"), F.lit(1))
    return F.array_join(F.transform(pieces, value), "")


def render_message(template: Column | str | None, fields: Mapping[str, Column | str], default: str) -> Column:
    """fill ``{task}``, ``{dag}``, ``{execution_time}``, ``{url}`` in one
    reading of the template; a null value is written ``None``."""
    text = F.coalesce(_c(template), F.lit(default)) if template is not None else F.lit(default)
    if not fields:
        return text

    def value(p: Column) -> Column:
        out = None
        for name, v in fields.items():
            shown = F.coalesce(_c(v).cast("string"), F.lit("None"))
            out = (F if out is None else out).when(p == F.lit("{" + name + "}"), shown)
        return out.otherwise(p)

    return _filled(text, "|".join([*(r"\{" + re.escape(n) + r"\}" for n in fields), r"[^{]+"]), value)


def substitute(text: Column | str, variables: Column | str | Mapping[str, Column | str | None]) -> Column:
    """fill ``${name}`` and ``${name|default}`` placeholders in one reading.

    A variable that is set (not null) replaces both forms; otherwise
    ``${name|default}`` takes its default and ``${name}`` stays as written.
    ``variables`` is a per-row ``MAP<STRING,STRING>`` column or a dict of
    column expressions.  Names and values may hold any characters.
    """
    if isinstance(variables, Mapping):
        given = {k: v for k, v in variables.items() if v is not None}
        parts = [x for k, v in given.items() for x in (F.lit(k), _c(v).cast("string"))]
        known = F.create_map(*parts) if parts else F.create_map().cast("map<string,string>")
    else:
        known = _c(variables)

    def value(p: Column) -> Column:
        inner = F.substring(p, F.lit(3), F.length(p) - 3)
        bar = F.locate("|", inner)
        name = F.when(bar > 0, F.substring(inner, F.lit(1), bar - 1)).otherwise(inner)
        default = F.when(bar > 0, F.substring(inner, bar + 1, F.length(inner)))
        return F.when(p.startswith("${") & (F.length(p) > 3), F.coalesce(F.try_element_at(known, name), default, p)).otherwise(p)

    return _filled(_c(text), r"\$\{[^}]+\}|[^$]+", value)


def prefixed_vars(env: Column | str, prefix: str = VAR_PREFIX, defaults: Mapping[str, str | None] = VAR_DEFAULTS) -> Column:
    """F8: keys with ``prefix``, every occurrence of the prefix removed,
    lower-cased, laid over ``defaults`` (a set key wins over a default).  Of
    keys that become equal, the one that sorts last counts."""
    named = F.transform(
        F.array_sort(F.map_entries(F.map_filter(_c(env), lambda k, v: k.startswith(prefix)))),
        lambda e: F.struct(F.lower(F.replace(e["key"], F.lit(prefix), F.lit(""))).alias("key"), e["value"].alias("value")),
    )
    picked = _last_wins(named)
    if not defaults:
        return picked
    base = F.map_from_arrays(
        F.array(*[F.lit(k) for k in defaults]),
        F.array(*[F.lit(v).cast("string") for v in defaults.values()]),
    )
    kept = F.map_filter(base, lambda k, v: ~F.array_contains(F.map_keys(picked), k))
    return F.map_concat(kept, picked)


def split_list(col: Column | str, sep: str = ",") -> Column:
    """comma list → array (empty string → empty array)."""
    c = _c(col)
    return F.when((c.isNull()) | (c == ""), F.array().cast("array<string>")).otherwise(F.split(c, sep))


def join_list(arr: Column | str, sep: str = ",") -> Column:
    """array → comma list."""
    return F.concat_ws(sep, _c(arr))
