"""Quality rules with limits learned from the data, in DataFrame functions only.

Each document is measured once: words, symbols, repeated lines, words inside repeated five-word windows.
The sketch of a measure is the count of documents in each bucket of its logarithm (steps of two per cent). Counts of groups
add up to those of their language and of everything, and neither order nor place of rows matters: two runs agree row by row.
Documents that pass the base rules and have more than nothing of a measure enter its sketches, one per language and source.
A group with fewer than ``least`` of them uses the sketch of its language, a small language that of all; where all together
have fewer, the measure has no limit yet.

A limit has no fixed part: with ``tail`` of the sketched documents above the value u, and the median m, it is
u * (u / m) ** ``reach`` (at least one step above u), and for low limits likewise below. So a source in which symbols or
repeats are common has wide limits and a uniform one narrow limits, and no fixed share of the documents has to go. A document is kept if
it passes the base rules and lies within all limits of its group. What a large part of a group has in common is normal there.

Null text: no words, which fails the base rules. Null lang or source: a group like any other. Equal values share a bucket, so ties get one verdict. Repeated
rows stay, an empty table gives an empty result. Columns of the input that are not asked for are dropped, and
those asked for may have any name.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import SPACE, WORD, stored

RUN = 5
SYMBOLS = r"[#*$%&|<>]"
#: measure -> whether low values are limited too
MEASURES = {"symbol_share": False, "dup_line_share": False, "repeat_share": False, "mean_word": True}
STEP = 1.02
BASE = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]


def _share(part: Column, whole: Column) -> Column:
    return F.when(whole > 0, part / whole).otherwise(F.lit(0.0)).cast("double")


def measure(docs: DataFrame, keep: Sequence[str] = ("doc_id",)) -> DataFrame:
    """The columns in ``keep`` as a struct ``own``, lang, source, the base counts and the measures.

    Each array is a column of its own step, so none is computed again for each element of another.
    Hashes of windows are compared; only texts with a repeated one are sorted to find the places.
    """
    gap = F.lit(" \t\n\x0b\x0c\r")
    df = docs.select(F.struct(*[F.col(f"`{c}`") for c in keep]).alias("own"), F.col("lang").alias("lang"), F.col("source").alias("source"), F.coalesce(F.col("text"), F.lit("")).alias("text"))
    df = df.withColumn("trimmed", F.btrim("text", gap))
    df = df.select("own", "lang", "source", F.when(F.col("trimmed") != "", F.split("trimmed", SPACE)).otherwise(F.array().cast("array<string>")).alias("words"),
                   F.filter(F.split("text", "\n"), lambda x: x.rlike(WORD)).alias("lines"), F.regexp_count("text", F.lit(SYMBOLS)).cast("long").alias("n_symbols"))
    df = df.select("own", "lang", "source", "n_symbols", F.size("words").cast("long").alias("n_words"), F.length(F.array_join("words", "")).cast("long").alias("word_chars"),
                   F.size("lines").cast("long").alias("n_lines"), (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
                   F.transform("words", lambda w: F.xxhash64(w)).alias("h"))
    run = F.transform(F.sequence(F.lit(0), F.size("h") - RUN), lambda i: F.xxhash64(*[F.get("h", i + k) for k in range(RUN)]))
    rest = [c for c in df.columns if c != "h"]
    df = df.select(*rest, F.when(F.size("h") >= RUN, run).alias("runs"))
    ordered = F.sort_array(F.transform("runs", lambda x, i: F.struct(x.alias("h"), i.alias("i"))))
    df = df.select(*rest, F.when(F.size(F.array_distinct("runs")) < F.size("runs"), ordered).alias("s"))

    def same(a: Column, i: Column) -> Column:
        return F.get("s", i)["h"].eqNullSafe(a["h"])

    twice = F.filter("s", lambda x, i: same(x, i - 1) | same(x, i + 1))
    df = df.select(*rest, F.sort_array(F.transform(twice, lambda x: x["i"])).alias("p"))
    covered = F.transform("p", lambda x, i: F.least(F.lit(RUN), F.coalesce(F.get("p", i + 1) - x, F.lit(RUN))))
    df = df.select(*rest, F.coalesce(F.aggregate(covered, F.lit(0).cast("long"), lambda a, x: a + x), F.lit(0)).cast("long").alias("n_repeat_words"))
    n = F.col("n_words")
    return df.select(
        "own", "lang", "source", *BASE, ((n < 10) | (100 * F.col("n_repeat_words") > 20 * n)).alias("base_failed"),
        _share(F.col("n_symbols"), n).alias("symbol_share"), _share(F.col("n_dup_lines"), F.col("n_lines")).alias("dup_line_share"),
        _share(F.col("n_repeat_words"), n).alias("repeat_share"), _share(F.col("word_chars"), n).alias("mean_word"))


def bucket(value: Column) -> Column:
    """Number of the step of the logarithm that a value above 0 lies in; null for 0."""
    return F.when(value > 0, F.ceil(F.log(value) / F.log(F.lit(STEP))).cast("long"))


def sketches(measured: DataFrame) -> DataFrame:
    """lang, source, measure, bucket, n: documents that pass the base rules."""
    values = F.array(*[F.struct(F.lit(m).alias("measure"), bucket(F.col(m)).alias("bucket")) for m in MEASURES])
    rows = measured.filter(~F.col("base_failed")).select("lang", "source", F.inline(values)).filter(F.col("bucket").isNotNull())
    return rows.groupBy("lang", "source", "measure", "bucket").agg(F.count(F.lit(1)).alias("n"))


def _limits_of(sketch: DataFrame, keys: Sequence[str], least: int, tail: int, reach: int) -> DataFrame:
    """A row per value of ``keys`` with the limits of all measures, in buckets; null where fewer than ``least`` documents are sketched.

    A window holds the buckets of one sketch, whose number does not grow with the documents.
    """
    merged = sketch.groupBy(*keys, "measure", "bucket").agg(F.sum("n").alias("n"))
    one = Window.partitionBy(*keys, "measure")
    ranked = merged.withColumns({"upto": F.sum("n").over(one.orderBy("bucket")), "all": F.sum("n").over(one)})

    def place(thousandths: int) -> Column:
        return F.min(F.when(1000 * F.col("upto") >= thousandths * F.col("all"), F.col("bucket")))

    found = ranked.groupBy(*keys, "measure").agg(F.max("all").alias("all"), place(tail).alias("l"), place(500).alias("m"), place(1000 - tail).alias("u"))
    low = F.col("l") - reach * F.greatest(F.col("m") - F.col("l"), F.lit(1))
    high = F.col("u") + reach * F.greatest(F.col("u") - F.col("m"), F.lit(1))
    enough = F.col("all") >= least
    return found.groupBy(*keys).agg(*[F.max(F.when(enough & (F.col("measure") == m), v)).alias(f"{m}_{n}") for m in MEASURES for n, v in (("low", low), ("high", high))])


def limits(measured: DataFrame, least: int = 100, tail: int = 20, reach: int = 1) -> DataFrame:
    """Lowest and highest bucket of each measure for each (lang, source); ``tail`` is in thousandths.

    The row of everything is kept apart under a constant key, so that an empty table has no row at all.
    """
    groups = measured.groupBy("lang", "source").agg(F.count(F.lit(1)).alias("n"))
    sketch = stored(sketches(measured), "sketches")
    names = [f"{m}_{n}" for m in MEASURES for n in ("low", "high")]
    own = _limits_of(sketch, ["lang", "source"], least, tail, reach).select(F.col("lang").alias("lang_g"), F.col("source").alias("source_g"), *[F.col(c).alias(f"{c}_g") for c in names])
    by_lang = _limits_of(sketch, ["lang"], least, tail, reach).select(F.col("lang").alias("lang_l"), *[F.col(c).alias(f"{c}_l") for c in names])
    row = _limits_of(sketch.withColumn("every", F.lit(1)), ["every"], least, tail, reach).first()  # at most one row
    joined = groups.join(own, F.col("lang").eqNullSafe(F.col("lang_g")) & F.col("source").eqNullSafe(F.col("source_g")), "left")
    joined = joined.join(by_lang, F.col("lang").eqNullSafe(F.col("lang_l")), "left")
    chosen = [F.coalesce(f"{c}_g", f"{c}_l", F.lit(row[c] if row else None).cast("long")).alias(c) for c in names]
    return joined.select(F.col("lang").alias("group_lang"), F.col("source").alias("group_source"), *chosen)


def judge(measured: DataFrame, bounds: DataFrame) -> DataFrame:
    """``measured`` (stored) with the verdict ``kept``; the bounds are a row per group and joined, not collected."""
    bounds = stored(bounds, "limits")
    fine = ~F.col("base_failed")
    for m, low in MEASURES.items():
        at = bucket(F.col(m))
        fine &= F.coalesce(at <= F.col(f"{m}_high"), F.lit(True))
        if low:
            fine &= F.coalesce(at >= F.col(f"{m}_low"), F.lit(True))
    joined = measured.join(bounds, measured["lang"].eqNullSafe(bounds["group_lang"]) & measured["source"].eqNullSafe(bounds["group_source"]), "left")
    return joined.select("own", *BASE, "base_failed", fine.alias("kept"), *MEASURES)


def verdicts(docs: DataFrame) -> DataFrame:
    """A row per document with the counts, the verdict of the base rules and the final one."""
    measured = stored(measure(docs), "measures")
    return judge(measured, limits(measured)).select("own.*", *BASE, "base_failed", "kept", *MEASURES)


def keep_good(docs: DataFrame) -> DataFrame:
    """The documents that pass, with their columns as they were."""
    measured = stored(measure(docs, docs.columns), "measures")
    return judge(measured, limits(measured)).filter("kept").select("own.*")
