"""Packing token sequences by minimum bin slack.

Documents are cut every ``window`` ids; what is left of each is a rest shorter than the window.
Only the number of rests of each length matters for a plan, so the plan is made from a table with
at most ``window`` rows: for each new window the longest length still left is fixed, and a
subset-sum program over a bit set (bit s: the sum s can be reached) finds the multiset of
the other lengths that comes closest to the capacity; backtracking through the stages of the
program tells how many of each length it takes. The pattern is used as often as the counts allow.

Rests find their place without any list of them in one task: each task numbers the rests of a
length as it writes them, the counts by (task, length) give each task its first number, and a
piece's number within its length tells pattern, repetition and offset. That table grows with the tasks, so it is
merged with the pieces by a shuffle, not broadcast.

Texts are encoded by tiktoken, which is faster; where its pattern search gives up (runs of some hundred thousand
blanks), the text is encoded by tokenizers itself.

Null or empty texts have just the end id. Repeated rows are packed as often as they occur. An empty table
gives an empty result. Null ids stay null. Other input columns are ignored.
"""

from __future__ import annotations

import base64
import zlib
from functools import lru_cache

import numpy as np
import pyarrow as pa
import tiktoken
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from .common import sparing, stored

PIECES = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, part int, place long"
PACKED = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"


@lru_cache(4)
def encoder(ranks: str, pattern: str, special: tuple[tuple[str, int], ...]) -> tiktoken.Encoding:
    """Byte-pair encoder from a rank file. It gives the ids of the tokenizers file with the same vocabulary."""
    with open(ranks, "rb") as lines:
        table = {base64.b64decode(a): int(b) for a, b in (line.split() for line in lines if line.strip())}
    return tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=table, special_tokens=dict(special))


@lru_cache(4)
def library(path: str) -> Tokenizer:
    return Tokenizer.from_file(path)


def ids_of(text: str, enc: tiktoken.Encoding, vocabulary: str) -> np.ndarray:
    """Ids of a text, special strings included."""
    try:
        return enc.encode_to_numpy(text, allowed_special="all")
    except ValueError:  # the pattern search ran out of stack
        return np.array(library(vocabulary).encode(text, add_special_tokens=False).ids, np.uint32)


def cut_into_pieces(docs: DataFrame, vocabulary: str, ranks: str, pattern: str, special: dict[str, int], window: int, end_id: int) -> DataFrame:
    """Pieces of at most ``window`` ids with the task that made them and their number among its pieces of that length."""
    names = tuple(special.items())

    def cut(batches):
        enc, part = encoder(ranks, pattern, names), TaskContext.get().partitionId()
        seen = np.zeros(window + 1, np.int64)
        for batch in batches:
            rows = []
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                ids = np.append(ids_of(text or "", enc, vocabulary), np.uint32(end_id)).astype("<u4")
                for start in range(0, len(ids), window):
                    piece = ids[start : start + window]
                    rows.append((doc_id, start, len(piece), zlib.crc32(piece.tobytes()), len(ids), part, seen[len(piece)]))
                    seen[len(piece)] += 1
            if rows:
                types = (pa.int64(),) * 5 + (pa.int32(), pa.int64())
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)], names=[c.split()[0] for c in PIECES.split(", ")])

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(sparing(cut), PIECES)


def fill(counts: dict[int, int], capacity: int) -> dict[int, int]:
    """The multiset of lengths, each at most as often as ``counts`` says, with the largest sum up to ``capacity``."""
    reach, stages = 1, []
    mask = (1 << capacity + 1) - 1
    for length in sorted((x for x in counts if x <= capacity), reverse=True):
        left, copies = min(counts[length], capacity // length), 1
        while left:
            take = min(copies, left)
            stages.append((reach, length, take))
            reach |= reach << length * take & mask
            left, copies = left - take, copies * 2
        if reach >> capacity:
            break
    total, out = reach.bit_length() - 1, {}
    for before, length, take in reversed(stages):
        if not before >> total & 1:
            out[length] = out.get(length, 0) + take
            total -= length * take
    return out


def plan(counts: dict[int, int], window: int) -> list[tuple[dict[int, int], int]]:
    """Patterns (how many of each length) with their repetitions that use up all counts."""
    left, out = {k: v for k, v in counts.items() if v}, []
    while left:
        longest = max(left)
        others = {k: v - (k == longest) for k, v in left.items() if v > (k == longest)}
        pattern = fill(others, window - longest)
        pattern[longest] = pattern.get(longest, 0) + 1
        times = min(left[k] // n for k, n in pattern.items())
        out.append((pattern, times))
        left = {k: v - times * pattern.get(k, 0) for k, v in left.items() if v > times * pattern.get(k, 0)}
    return out


def slots(patterns: list[tuple[dict[int, int], int]]) -> dict[int, np.ndarray]:
    """For each length, rows (first number, copies in the pattern, first sequence, first offset), by first number."""
    out: dict[int, list] = {}
    taken: dict[int, int] = {}
    sequence = 0
    for pattern, times in patterns:
        offset = 0
        for length in sorted(pattern, reverse=True):
            n = pattern[length]
            out.setdefault(length, []).append((taken.get(length, 0), n, sequence, offset))
            taken[length] = taken.get(length, 0) + n * times
            offset += n * length
        sequence += times
    return {k: np.array(v, np.int64) for k, v in out.items()}


def pack(docs: DataFrame, vocabulary: str, ranks: str, pattern: str, special: dict[str, int], window: int = 2048, end_id: int = 1) -> DataFrame:
    """A row per piece: its document, span, checksum, sequence and offset there.

    ``vocabulary`` is the tokenizers file, ``ranks`` the same vocabulary as a rank file.
    """
    pieces = stored(cut_into_pieces(docs, vocabulary, ranks, pattern, special, window, end_id), "pieces")
    by_task = pieces.groupBy("part", "length").agg(F.count(F.lit(1)).alias("n"))
    by_task = stored(by_task, "piece-counts")
    counts = {r["length"]: r["n"] for r in by_task.groupBy("length").agg(F.sum("n").alias("n")).collect()}  # <= window rows
    places = slots(plan(counts, window))
    before = F.sum("n").over(Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1))
    firsts = by_task.select("part", "length", F.coalesce(before, F.lit(0)).alias("first"))

    def put(batches):
        for batch in batches:
            length, number = (batch.column(c).to_numpy() for c in ("length", "number"))
            sequence, offset = np.zeros(len(length), np.int64), np.zeros(len(length), np.int64)
            for k in np.unique(length):
                rows, table = np.flatnonzero(length == k), places[k]
                slot = table[np.searchsorted(table[:, 0], number[rows], "right") - 1]
                repeat, copy = np.divmod(number[rows] - slot[:, 0], slot[:, 1])
                sequence[rows], offset[rows] = slot[:, 2] + repeat, slot[:, 3] + copy * k
            yield pa.RecordBatch.from_arrays([*batch.columns[:5], pa.array(sequence), pa.array(offset)], names=[c.split()[0] for c in PACKED.split(", ")])

    numbered = pieces.join(firsts.hint("merge"), ["part", "length"]).select("doc_id", "start", "length", "ids_crc32", "doc_tokens", (F.col("first") + F.col("place")).alias("number"))
    return numbered.mapInArrow(sparing(put), PACKED)
