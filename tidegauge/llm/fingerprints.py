"""Document fingerprints by I-Match: hashes of a document's terms in several randomised lexicons.

Terms are runs of ASCII letters and digits and of all characters beyond ASCII, with A-Z lower-cased. The
lexicon holds the terms whose inverse document frequency ln(N / df) lies in a band (``low`` to ``high``); both counts
are over all documents, equal texts included. A term is counted under its bucket, 24 bits of its md5, so the counts of
any corpus fit 2^24 numbers and the lexicon is a bit map of 2 MB, which goes to every task; terms of one bucket share a count.

Each of ``LISTS`` random functions thins the lexicon level by level: level l keeps one term in 2^l, as the upper half of the
term's md5 times the function's factor decides (64 bits), and a level's terms are among those of the level above. A document of n lexicon terms
uses the ``LEVELS`` levels from floor(log2 n) on, where a thinned lexicon holds one or two of its terms at first, then fewer. For each
level and function its distinct terms there are sorted and hashed; the fingerprint is the first level and the 160 hashes (four dots
if no term is there). The likeness of two fingerprints is the number of equal hashes at levels that both use, divided by
the number of places where either has a hash. It falls with the share of terms that differ, so half-changed texts still
agree in some places.

A document's successor is the next row in the order of id (no id first; equal ids by the text's hash, then its text), after
the last the first. Rows are dealt out by ranges of that order; an id that fills several ranges is cut by its hash.
The first row of a range is sent to the range before it, too, so every row meets its successor.

Null and empty texts have no terms; their fingerprint, and that of texts without a lexicon term, is ``--`` and a hash of all
their distinct terms, alike only to its equal. Equal texts have equal fingerprints. Repeated rows follow each other.
A lone row succeeds itself; an empty table gives no rows. Other input columns are ignored.
"""

from __future__ import annotations

import hashlib
import math
import re

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

from .common import stored

TERM = re.compile(rb"[0-9a-z\x80-\xff]+")
BITS = 24
LISTS = 32
LEVELS = 5
EMPTY = "...."
EMPTY_CODE = int.from_bytes(EMPTY.encode(), "little")
BARE = "--"
MAX_LEVEL = 28
#: Terms that a task remembers; it forgets all of them when there are more.
REMEMBERED = 200_000
LOW, HIGH = math.log(2), math.log(1 << 20)
RESULT = "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double"


def terms(text: str) -> set[bytes]:
    return set(TERM.findall(text.encode("utf-8").lower()))


def bucket(term: bytes) -> int:
    return int.from_bytes(hashlib.md5(term).digest()[:3], "big")


def factor(k: int) -> int:
    """The odd 32-bit number of a function."""
    return int(hashlib.md5(str(k).encode()).hexdigest()[:8], 16) | 1


FACTORS = np.array([factor(k) for k in range(LISTS)], np.uint64)


def count_terms(batches):
    """(bucket, number of documents with a term there), and the number of documents as bucket -1."""
    counts, n, known = np.zeros(1 << BITS, np.int32), 0, {}
    for batch in batches:
        for text in batch.column(0).to_pylist():
            n += 1
            found = terms(text)
            if len(known) > REMEMBERED:
                known.clear()
            for t in found.difference(known):
                known[t] = bucket(t)
            counts[list({known[t] for t in found})] += 1
    at = np.flatnonzero(counts)
    for first in range(0, len(at), 1 << 16):
        part = at[first : first + (1 << 16)]
        yield pa.RecordBatch.from_arrays([pa.array(part.astype(np.int32)), pa.array(counts[part].astype(np.int64))], names=["bucket", "n"])
    yield pa.RecordBatch.from_arrays([pa.array([-1], pa.int32()), pa.array([n])], names=["bucket", "n"])


def lexicon(docs: DataFrame, text: str, low: float, high: float) -> bytes:
    """Bit map of the buckets in the band; 2 MB for any corpus."""
    counts = docs.select(F.coalesce(F.col(text), F.lit("")).alias("text")).mapInArrow(count_terms, "bucket int, n long")
    counts = stored(counts.groupBy("bucket").agg(F.sum("n").alias("n")), "term-counts")
    n = counts.filter(F.col("bucket") == -1).first()["n"] or 1
    idf = F.log(F.lit(n) / F.col("n"))
    kept = counts.filter((F.col("bucket") >= 0) & (idf >= low) & (idf <= high))
    packed = kept.groupBy(F.shiftright("bucket", 5).alias("at")).agg(F.bit_or(F.expr("shiftleft(1L, bucket & 31)")).alias("bits")).toArrow()
    bits = np.zeros(1 << (BITS - 5), np.uint32)
    bits[packed["at"].to_numpy()] = packed["bits"].to_numpy().astype(np.uint32)
    return bits.tobytes()


class Fingerprinter:
    def __init__(self, bits: bytes):
        self.bits, self.known = np.frombuffer(bits, np.uint32).tolist(), {}

    def learn(self, found: set[bytes]) -> dict[bytes, bytes | None]:
        """md5 of known terms, with these among them; None for terms outside the lexicon."""
        if len(self.known) > REMEMBERED:
            self.known.clear()
        for t in found.difference(self.known):
            digest = hashlib.md5(t).digest()
            b = int.from_bytes(digest[:3], "big")
            self.known[t] = digest if self.bits[b >> 5] >> (b & 31) & 1 else None
        return self.known

    def __call__(self, text: str) -> str:
        found = terms(text)
        known = self.learn(found)
        own = sorted([t for t in found if known[t]])
        if not own:
            return BARE + hashlib.md5(b" ".join(sorted(found))).hexdigest()
        middle = min(len(own).bit_length() - 1, MAX_LEVEL)
        last = np.frombuffer(b"".join([known[t] for t in own]), ">u8")[1::2].astype(np.uint64)
        numbers = last[:, None] * FACTORS >> np.uint64(32)
        which, at = np.nonzero(numbers < np.uint64(1 << 32 - middle))  # row by row, so terms stay sorted
        zeros = 32 - np.frexp(numbers[which, at].astype(np.float64))[1]
        deepest = np.minimum(zeros - middle, LEVELS - 1)
        lists: list[list[bytes]] = [[] for _ in range(LISTS * LEVELS)]
        for w, k, d in zip(which.tolist(), at.tolist(), deepest.tolist()):
            for level in range(d + 1):
                lists[level * LISTS + k].append(own[w])
        return f"{middle:02d}" + "".join([EMPTY if not x else (known[x[0]] if len(x) == 1 else hashlib.md5(b" ".join(x)).digest())[:2].hex() for x in lists])


def likeness(a: str, b: str) -> float:
    """Share of equal hashes at common levels, from 0 to 1."""
    if a == b:
        return 1.0
    if a.startswith(BARE) or b.startswith(BARE):
        return 0.0
    ahead = int(a[:2]) - int(b[:2])
    if abs(ahead) >= LEVELS:
        return 0.0
    x, y = (np.frombuffer(m[2:].encode(), "<u4") for m in (a, b))
    x, y = x[max(-ahead, 0) * LISTS :], y[max(ahead, 0) * LISTS :]
    x, y = x[: len(y)], y[: len(x)]
    used = (x != EMPTY_CODE) | (y != EMPTY_CODE)
    places = int(used.sum())
    return int((used & (x == y)).sum()) / places if places else 0.0


def edited(text: str, successor: str) -> str:
    """The last half of the code points replaced by the first as many of the next document."""
    half = len(text) // 2
    return text[: len(text) - half] + successor[:half]


def ranges(docs: DataFrame, parts: int) -> DataFrame:
    """Rows with their place in the order (``_id``, ``_hash``, text) and their range of it, ``_part``.

    Bounds are quantiles of the id. An id that several bounds name has as many ranges, by its texts' hashes.
    """
    keyed = docs.withColumns({"_id": F.coalesce(F.col("doc_id").cast("double"), F.lit(-1e300)), "_hash": F.xxhash64("text")})
    found = keyed.select("_id").approxQuantile("_id", [(i + 1) / parts for i in range(parts - 1)], 0.1 / parts)
    bounds = np.sort(np.array(found, np.float64))

    @F.pandas_udf("int")
    def part(ids: pd.Series, hashes: pd.Series) -> pd.Series:
        low, high = np.searchsorted(bounds, ids, "left"), np.searchsorted(bounds, ids, "right")
        share = hashes.to_numpy().astype(np.float64) / 2.0**64 + 0.5
        return pd.Series(high - np.maximum(high - low - 1, 0) + np.floor(np.clip(share, 0, 1 - 1e-9) * np.maximum(high - low, 1)).astype(np.int64)).astype("int32")

    return keyed.withColumn("_part", part("_id", "_hash"))


def with_successors(docs: DataFrame, parts: int) -> DataFrame:
    """Rows dealt out by range and sorted; each range ends with the first row of the next one, marked ``_lent``."""
    rows = ranges(docs, parts)
    least = rows.groupBy("_part").agg(F.min("_id").alias("_id")).orderBy("_part").collect()  # one row per range
    ahead = [(r["_part"], r["_id"], least[i - 1]["_part"]) for i, r in enumerate(least)]
    ahead = docs.sparkSession.createDataFrame(ahead, "_part int, _id double, _to int")
    heads = rows.join(F.broadcast(ahead), ["_part", "_id"])
    order = Window.partitionBy("_part").orderBy("_hash", "text")
    heads = heads.withColumn("_place", F.row_number().over(order)).filter("_place = 1").withColumn("_part", F.col("_to"))
    columns = ["_part", "_id", "_hash", "doc_id", "text"]
    both = rows.select(*columns, F.lit(False).alias("_lent")).union(heads.select(*columns, F.lit(True)))
    return both.repartition(parts, "_part").sortWithinPartitions("_part", "_lent", "_id", "_hash", "text")


def fingerprint(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", low: float = LOW, high: float = HIGH) -> DataFrame:
    """Fingerprints of each text and of its edited text, with the likeness to the latter and to the successor's."""
    bits = lexicon(docs, text, low, high)
    docs = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    parts = 3 * int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))

    def run(batches):
        mark, before, out = Fingerprinter(bits), None, []
        for batch in batches:
            for part, i, t, lent in zip(*(c.to_pylist() for c in batch.columns)):
                own = mark(t)
                if before and before[0] == part:
                    out.append(row(mark, *before[1:], t, own))
                before = None if lent else (part, i, t, own)
                if len(out) >= 500:
                    yield table(out)
                    out = []
        if out:
            yield table(out)

    def row(mark, i, t, own, successor, following):
        changed = edited(t, successor)
        other = mark(changed)
        return i, len(t), hashlib.sha256(changed.encode("utf-8")).hexdigest(), own, other, likeness(own, other), likeness(own, following)

    def table(rows):
        kinds = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.float64()]
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names=[c.split()[0] for c in RESULT.split(", ")])

    return with_successors(docs, parts).select("_part", "doc_id", "text", "_lent").mapInArrow(run, RESULT)
