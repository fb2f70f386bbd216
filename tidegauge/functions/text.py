"""String repair: flags, codes, blanks, packed pairs, tokens."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def strip_quality_flag(col: Column) -> Column:
    """Measurement text to double: trace mark ``T`` is 0.0, a trailing ``s`` is dropped first."""
    text = F.trim(col)
    return F.when(F.upper(text) == "T", F.lit(0.0)).otherwise(
        F.regexp_replace(text, "s$", "").try_cast("double")
    )


def to_double_safe(col: Column) -> Column:
    """Keep digits, dot and minus; anything that is still not a number becomes null."""
    return F.nullif(F.regexp_replace(col, r"[^0-9.\-]", ""), F.lit("")).try_cast("double")


def normalise_code(col: Column) -> Column:
    return F.nullif(F.regexp_replace(F.upper(col), "[^A-Z0-9]", ""), F.lit(""))


def blank_to_null(col: Column, markers: Sequence[str] = ("", "NA")) -> Column:
    return F.when(~F.trim(col).isin(*markers), col)


def split_pair(col: Column, sep: str = ",") -> tuple[Column, Column]:
    """Packed ``"first, second"`` text to two doubles."""
    parts = F.split(F.regexp_replace(col, r"\s", ""), sep)
    return parts.getItem(0).try_cast("double"), F.get(parts, F.lit(1)).try_cast("double")


def composite_key(*cols: Column | str, sep: str = "|") -> Column:
    return F.concat_ws(sep, *[F.col(c) if isinstance(c, str) else c for c in cols])


def like_ladder(col: Column, rules: Sequence[tuple[str, object]], default: object) -> Column:
    """First matching LIKE pattern wins."""
    out = None
    for pattern, value in rules:
        out = F.when(col.like(pattern), F.lit(value)) if out is None else out.when(col.like(pattern), F.lit(value))
    return F.lit(default) if out is None else out.otherwise(F.lit(default))


def name_contains(col: Column, needles: Sequence[str]) -> Column:
    """Case-insensitive substring search for any of ``needles``."""
    upper = F.upper(col)
    hit = F.lit(False)
    for needle in needles:
        hit = hit | upper.contains(needle.upper())
    return hit


def tokens(col: Column) -> Column:
    """Lower-cased runs of ASCII letters."""
    return F.array_remove(F.split(F.lower(col), "[^a-z]+"), "")


def hash_unit(*cols: Column, seed: int = 0) -> Column:
    """Repeatable uniform number in [0, 1) from a key: the same in every engine that has md5."""
    text = F.concat_ws(":", *[c.cast("string") for c in cols], F.lit(str(seed)))
    return F.conv(F.substring(F.md5(text), 1, 8), 16, 10).cast("long") / F.lit(4294967296.0)
