"""Helpers of the text operators: shared storage, batches of text, word hashes."""

from __future__ import annotations

import ctypes
import re
import tempfile
import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

WORD = r"[^\x20\x09-\x0D]+"
SPACE = r"[\x20\x09-\x0D]+"


def shared_folder(spark: SparkSession) -> str:
    """The folder in spark.checkpoint.dir, which every executor reaches. Only one-process runs get one of their own."""
    sc = spark.sparkContext
    folder = spark.conf.get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if not folder:
        if not re.match(r"local(\[|$)", sc.master):
            raise RuntimeError("set spark.checkpoint.dir to a folder every executor can reach")
        sc.setCheckpointDir(tempfile.mkdtemp(prefix="tidegauge-llm-"))
        folder = sc.getCheckpointDir()
    return folder.rstrip("/")


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared folder as Parquet and continue from the files.

    Lost executors then cost no recomputation, rows stay in the files they were written to,
    and the planner knows the size.
    """
    path = f"{shared_folder(df.sparkSession)}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def fresh(df: DataFrame, name: str) -> str:
    """A column name that ``df`` does not have."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def fold_of(doc_id: str, folds: int) -> Column:
    """crc32 of the id as text, modulo ``folds``; a null id counts as the empty text."""
    return F.crc32(F.coalesce(F.col(doc_id).cast("string"), F.lit("")).cast("binary")) % folds


def text_parts(batches: Iterator[pa.RecordBatch], text: str = "text", size: int = 4 << 20, lower: bool = False):
    """(rows, bytes, offsets) of slices of the batches with about ``size`` bytes of text; a null text is empty.

    A longer single text is a slice of its own. ``lower``: the bytes are of the lower-case text, letters of all scripts.
    """
    for batch in batches:
        column = pc.fill_null(batch.column(text).cast(pa.large_string()), "")
        column = pc.utf8_lower(column) if lower else column
        offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1]
        data = np.frombuffer(column.buffers()[2] or b"", np.uint8)
        first = 0
        while first < len(column):
            last = max(first + 1, int(np.searchsorted(offsets, offsets[first] + size, "right")) - 1)
            yield batch.slice(first, last - first), data[offsets[first] : offsets[last]], offsets[first : last + 1] - offsets[first]
            first = last


def give_back() -> None:
    """Hand memory that is no longer in use back to the system; workers live on from stage to stage."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim:
        trim(0)


def sparing(run: Callable) -> Callable:
    """``run`` for mapInArrow, giving back what earlier tasks of the worker left, and what its own leave."""

    def wrapped(batches):
        give_back()
        yield from run(batches)
        give_back()

    return wrapped


_rng = np.random.default_rng(20240229)
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_IS_SPACE = np.zeros(256, bool)
_IS_SPACE[[9, 10, 11, 12, 13, 32]] = True
_BYTE = _rng.integers(1, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_BYTE[_IS_SPACE] = 0
_BYTE_LOWER = _BYTE[_LOWER]
_MARKS = np.array([c < 128 and not chr(c).isalnum() for c in range(256)])
_BYTE_LETTERS = np.where(_MARKS, np.uint64(0), _BYTE_LOWER)
_BASE = np.uint64(0x9E3779B97F4A7C15)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective scramble of 64-bit values (finaliser of splitmix64)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def word_hashes(data: np.ndarray, offsets: np.ndarray, letters: bool = False) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Words of texts laid end to end, split at ASCII white space.

    Returns a 64-bit hash per word, the index of each text's first word (one more entry than
    texts), and where the words start and end. A-Z count as a-z. With ``letters`` every ASCII sign parts words, too.
    """
    n = len(data)
    if not n:
        none = np.zeros(0, np.int64)
        return none.astype(np.uint64), np.zeros(len(offsets), np.int64), none, none
    inside = ~(_MARKS if letters else _IS_SPACE)[data]
    edges = offsets[(offsets > 0) & (offsets < n)]
    first = inside.copy()
    first[1:] &= ~inside[:-1]
    first[edges] = inside[edges]
    starts = np.flatnonzero(first)
    if not len(starts):
        none = np.zeros(0, np.int64)
        return none.astype(np.uint64), np.zeros(len(offsets), np.int64), none, none
    last = inside.copy()
    last[:-1] &= ~inside[1:]
    last[edges - 1] = inside[edges - 1]
    ends = np.flatnonzero(last) + 1
    hashes = mix(_sums(data, starts, ends - starts, _BYTE_LETTERS if letters else _BYTE_LOWER))
    return hashes, np.searchsorted(starts, offsets), starts, ends


def _sums(data: np.ndarray, starts: np.ndarray, sizes: np.ndarray, table: np.ndarray) -> np.ndarray:
    """For each word the sum over its bytes k of table[byte] * _BASE**k: the first bytes of all words, then the second ones; long words by themselves."""
    short = 16
    order = np.argsort(np.minimum(sizes, short + 1).astype(np.uint8), kind="stable")[::-1]  # the longest first
    starts, sizes = starts[order], sizes[order]
    powers = np.full(short, _BASE)
    powers[0] = 1
    powers = np.cumprod(powers, dtype=np.uint64)
    longer = len(sizes) - np.cumsum(np.bincount(np.minimum(sizes, short + 1), minlength=short + 2))
    sums = table[data[starts]]
    for k in range(1, short):
        some = longer[k]
        sums[:some] += table[data[starts[:some] + k]] * powers[k]
    some = longer[short]
    if some:
        sizes = sizes[:some]
        heads = np.cumsum(sizes) - sizes
        place = np.arange(sizes.sum()) - np.repeat(heads, sizes)
        powers = np.full(int(sizes.max()), _BASE)
        powers[0] = 1
        values = table[data[np.repeat(starts[:some], sizes) + place]] * np.cumprod(powers, dtype=np.uint64)[place]
        sums[:some] = np.add.reduceat(values, heads)
    out = np.empty_like(sums)
    out[order] = sums
    return out


def windows(hashes: np.ndarray, size: int) -> np.ndarray:
    """A hash for each run of ``size`` consecutive words."""
    n = max(0, len(hashes) - size + 1)
    out = np.zeros(n, np.uint64)
    for k in range(size):
        out = mix(out * _BASE + hashes[k : k + n])
    return out


def labelled_sample(docs: DataFrame, labels: DataFrame, label: str, folds: int, held: int, bound: int) -> DataFrame:
    """At most ``bound`` rows with a label outside the held-out fold; ``docs`` needs doc_id and text.

    Labels are bounded by a hash of the id, so the list of (id, label) has at most ``bound`` rows and may be
    broadcast. A document with several labels counts with the largest; of several rows with one id, the one whose text has the smallest hash.
    """
    known = labels.filter(F.col(label).isNotNull() & F.col("doc_id").isNotNull() & (fold_of("doc_id", folds) != held))
    known = known.groupBy("doc_id").agg(F.max(label).cast("int").alias("_label"))
    chosen = known.orderBy(F.xxhash64("doc_id"), "doc_id").limit(bound)
    rows = docs.join(F.broadcast(chosen), "doc_id")
    inner = F.struct(*[F.col(f"`{c}`") for c in rows.columns])
    return rows.groupBy(F.col("doc_id").alias("_one")).agg(F.min_by(inner, F.xxhash64("text")).alias("_row")).select("_row.*")


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -40, 40)))
