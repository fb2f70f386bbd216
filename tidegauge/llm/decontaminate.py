"""Benchmark decontamination by latent semantic retrieval.

Search: the benchmark's passages (32 words, every 8 words) become TF-IDF vectors, with document frequencies counted over
all documents, but no more for a word than it has different neighbours on both sides: a passage that stands in a third of all documents
then weighs as if it stood in one. No word weighs less than ``rare``. A randomised SVD of that matrix, summed over tasks, gives a latent basis; its
rank doubles until every passage keeps the share ``held`` of its length in it.
Every document is cut into blocks of 16 words; two neighbouring blocks are a window, projected on the basis; its cosine with
each passage is a sum over its words, and a bound on that sum rules most windows out. A passage shorter than a window can
fill only part of it, so its threshold is lower.

Check: around the windows found for an item, the longest common subsequence of words with the item is computed
bit-parallel. The item is in the document if the subsequence covers ``sure`` of its words, or ``likely`` of them (a paraphrase)
and the answer is there as well: the words after the last ``?`` or ``answer:``, else the last eight, with the same ``sure``.

The benchmark is read in slices of about ``slice_words`` words, each searched in a pass of its own, so what tasks are given
has a bound whatever its size. Words are runs of letters and digits; case doesn't count.

Null or empty texts contain nothing. Items with fewer than ``least`` words, null ones included, can't be told from chance and are never found.
Repeated rows: one result row per input row (search) or both go or stay (filter); repeated items with one item_id count
once per document. Empty tables give an empty result. A null doc_id or item_id stays null. Other columns are ignored (search) or kept (filter).
"""

from __future__ import annotations

import re
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import mix, sparing, text_parts, word_hashes

REGISTERS = 256
#: Bytes of text and windows that a task works on at a time; what it holds beside the index grows with these.
SLICE, AT_ONCE = 1 << 18, 128
BLOCK, STEP = 16, 8
WINDOW = 2 * BLOCK
ANSWER = re.compile(rb".*(?:\?|\banswer\s*:)", re.I | re.S)
HITS = "doc_id long, item_id long, lcs long, item_words long, start_word long"


@dataclass
class Item:
    item_id: int | None
    words: np.ndarray
    answer: np.ndarray


def words_of(text: str | bytes) -> np.ndarray:
    raw = text.encode() if isinstance(text, str) else text
    return word_hashes(np.frombuffer(raw, np.uint8), np.array([0, len(raw)]), letters=True)[0]


def item_of(item_id: int | None, text: str) -> Item:
    raw = pc.utf8_lower(pa.scalar(text)).as_py().encode()
    words, mark = words_of(raw), ANSWER.match(raw)
    answer = words_of(raw[mark.end() :]) if mark else words[:0]
    return Item(item_id, words, answer if len(answer) else words[-8:])


def common_length(item: np.ndarray, words: np.ndarray) -> int:
    """Length of the longest common subsequence: bit i of ``row`` is 0 once the prefix up to word i has one more match."""
    places: dict[int, int] = {}
    for i, w in enumerate(item.tolist()):
        places[w] = places.get(w, 0) | 1 << i
    full = (1 << len(item)) - 1
    row = full
    for w in words.tolist():
        hit = row & places.get(w, 0)
        row = ((row + hit) | (row - hit)) & full
    return len(item) - row.bit_count()


class Vocabulary:
    """The words of a slice of the benchmark, found by hash."""

    def __init__(self, words: np.ndarray):
        self.words = np.unique(words)
        self.bits = max(10, int(len(self.words)).bit_length() + 6)
        self.table = np.full(1 << self.bits, -1, np.int32)
        slot = (self.words & np.uint64((1 << self.bits) - 1)).astype(np.int64)
        self.table[slot] = np.arange(len(self.words))
        self.crowded = len(np.unique(slot)) < len(slot)

    def find(self, hashes: np.ndarray) -> np.ndarray:
        """The number of each word, -1 for other words."""
        if not len(self.words):
            return np.full(len(hashes), -1, np.int32)
        if self.crowded:  # two words in one slot: search the sorted list instead
            at = np.minimum(np.searchsorted(self.words, hashes), len(self.words) - 1)
        else:
            at = self.table[(hashes & np.uint64((1 << self.bits) - 1)).astype(np.int64)]
        return np.where(self.words[at] == hashes, at, -1)


def passages_of(item: Item) -> list[np.ndarray]:
    last = max(0, len(item.words) - WINDOW)
    return [item.words[k : k + WINDOW] for k in sorted({*range(0, last, STEP), last})]


def neighbourhoods(hashes: np.ndarray, first: np.ndarray) -> np.ndarray:
    """A hash of each word with the words before and after it in its text."""
    before, after = np.append(np.uint64(0), hashes[:-1]), np.append(hashes[1:], np.uint64(0))
    begin, end = first[:-1][np.diff(first) > 0], first[1:][np.diff(first) > 0] - 1
    before[begin], after[end] = 0, 0
    return mix(mix(before * np.uint64(3) + hashes) * np.uint64(5) + after)


def distinct(registers: np.ndarray) -> np.ndarray:
    """Number of different hashes by HyperLogLog registers (a row for each word)."""
    m = registers.shape[1]
    raw = 0.7213 / (1 + 1.079 / m) * m * m / np.ldexp(1.0, -registers.astype(np.int64)).sum(axis=1)
    none = (registers == 0).sum(axis=1)
    return np.where((raw <= 2.5 * m) & (none > 0), m * np.log(m / np.maximum(none, 1)), raw)


def document_frequencies(docs: DataFrame, vocabulary: Vocabulary) -> tuple[int, np.ndarray]:
    """Number of documents, and of those with each word, over all of them; for a word no more than its different neighbourhoods.

    These are counted with a standard error of 6.5 per cent, the same in whatever parts the documents come.
    """
    size = len(vocabulary.words)

    def run(batches):
        counts, total = np.zeros(size, np.int64), 0
        registers = np.zeros((size, REGISTERS), np.uint8)
        for _, data, offsets in text_parts(batches, "text", SLICE, lower=True):
            hashes, first, _, _ = word_hashes(data, offsets, letters=True)
            at = vocabulary.find(hashes)
            row = np.repeat(np.arange(len(offsets) - 1), np.diff(first))[at >= 0]
            key = np.unique(row * len(vocabulary.words) + at[at >= 0])
            counts += np.bincount(key % max(1, len(vocabulary.words)), minlength=len(counts))
            total += len(offsets) - 1
            around = neighbourhoods(hashes, first)[at >= 0]
            zeros = 53 - np.frexp((around >> np.uint64(12)).astype(np.float64))[1]  # 52 bits: leading zeros and one more
            np.maximum.at(registers.reshape(-1), at[at >= 0].astype(np.int64) * REGISTERS + (around & np.uint64(REGISTERS - 1)).astype(np.int64), zeros.astype(np.uint8))
        seen = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays([pa.array(np.append(seen, -1)), pa.array(np.append(counts[seen], total)), pa.array([r.tobytes() for r in registers[seen]] + [bytes(REGISTERS)], pa.binary())], names=["word", "n", "registers"])

    def merge(table: pa.Table) -> pa.Table:
        found = np.frombuffer(b"".join(table["registers"].to_pylist()), np.uint8).reshape(-1, REGISTERS).max(axis=0)
        return pa.table([table["word"][:1], pa.array([pc.sum(table["n"]).as_py()], pa.int64()), pa.array([distinct(found[None, :])[0]], pa.float64())], names=["word", "n", "around"])

    rows = docs.select("text").mapInArrow(sparing(run), "word long, n long, registers binary").groupBy("word").applyInArrow(merge, "word long, n long, around double").toArrow()  # a row per word of the slice
    out, around = np.zeros(size + 1, np.int64), np.zeros(size + 1)
    out[rows["word"].to_numpy()], around[rows["word"].to_numpy()] = rows["n"].to_numpy(), rows["around"].to_numpy()
    return int(out[-1]), np.minimum(out[:-1], np.ceil(around[:-1]))


def latent_basis(passages: DataFrame, idf: np.ndarray, rank: int, rounds: int = 2) -> np.ndarray:
    """An orthonormal basis (words x rank) of the passages' TF-IDF matrix A, by iterating Q <- orth(A'(A Q)) from random Q.

    ``passages`` has a column ``at``: word numbers. Tasks add up their rows; sums meet by word.
    """
    size = len(idf)
    rank = min(rank, size)
    basis = np.linalg.qr(np.random.default_rng(5).normal(size=(size, rank)))[0]
    for _ in range(rounds):
        def run(batches, q=basis):
            total = np.zeros_like(q)
            seen = np.zeros(size, bool)
            for batch in batches:
                for at in batch.column("at").to_pylist():
                    words, count = np.unique(np.array(at, np.int64), return_counts=True)
                    x = count * idf[words]
                    total[words] += np.outer(x, x @ q[words])
                    seen[words] = True
            words = np.flatnonzero(seen)
            yield pa.RecordBatch.from_arrays([pa.array(words), pa.array(list(total[words]), pa.list_(pa.float64()))], names=["word", "row"])

        sums = passages.mapInArrow(sparing(run), "word long, row array<double>").withColumn("row", array_to_vector("row")).groupBy("word").agg(Summarizer.sum(F.col("row")).alias("row"))
        rows = sums.select("word", vector_to_array("row").alias("row")).toArrow()  # a row per word of the slice
        z = np.zeros((size, rank))
        if rows.num_rows:
            z[rows["word"].to_numpy()] = np.array(rows["row"].to_pylist())
        basis = np.linalg.qr(z)[0]
    return basis


class Index:
    """What a task needs to search texts for a slice of the benchmark."""

    def __init__(self, items: list[Item], vocabulary: Vocabulary, idf: np.ndarray, basis: np.ndarray, cosine: float, sure: float, likely: float):
        self.items, self.vocabulary, self.sure, self.likely = items, vocabulary, sure, likely
        self.square = np.append(idf**2, np.mean(idf[idf > 0] ** 2) if idf.any() else 1.0)  # the last is for all other words
        parts = [(k, vocabulary.find(p)) for k, item in enumerate(items) for p in passages_of(item)]
        self.owner = np.array([k for k, _ in parts], np.int64)
        # words and answer of each item as numbers, and how often it has each word; the last place is for all other words
        self.numbered = [(w := vocabulary.find(i.words), vocabulary.find(i.answer), np.bincount(w, minlength=len(idf) + 1).astype(np.int32)) for i in items]
        latent = basis * idf[:, None]
        vectors = np.array([latent[p].sum(axis=0) for _, p in parts]).reshape(len(parts), basis.shape[1])
        norm = np.array([max(np.sqrt(self.square[p].sum()), 1e-9) for _, p in parts])
        reach = np.array([np.sqrt(min(1, len(p) / WINDOW)) for _, p in parts])
        # What a word adds to the product with each passage in the latent space, scaled so that a window
        # reaches the threshold * reach of a passage if its sum is no less than its own length.
        self.gain = (latent @ (vectors / (norm * reach * cosine)[:, None]).T).astype(np.float32)
        self.most = np.append(np.maximum(self.gain.max(axis=1), 0), 0.0) if len(parts) and len(idf) else np.zeros(len(idf) + 1)

    def near(self, at: np.ndarray, first: np.ndarray):
        """(text, first word, passage) of all windows that reach the threshold of a passage, in slices.

        The sum of the most that each word can add is a bound; only windows whose bound is large enough are multiplied out.
        """
        words = np.diff(first)
        blocks = -(-words // BLOCK)
        bounds = np.concatenate([[0], np.cumsum(blocks)])
        owner = np.repeat(np.arange(len(words)), blocks)
        n = len(owner)
        starts = np.append(first[:-1][owner] + (np.arange(n) - bounds[:-1][owner]) * BLOCK, first[-1])
        square, bound = (np.add.reduceat(x[at], starts[:-1]) for x in (self.square, self.most))
        head = np.flatnonzero(np.append(owner[1:] == owner[:-1], False) | (blocks[owner] == 1))  # a window begins at each
        tail = np.where(blocks[owner[head]] == 1, head, head + 1)
        both = head != tail
        length = np.sqrt(square[head] + both * square[tail])
        open_ = np.flatnonzero((bound[head] + both * bound[tail] >= length * 0.999) & (length > 0))
        for low in range(0, len(open_), AT_ONCE):
            w = open_[low : low + AT_ONCE]
            needed, place = np.unique(np.concatenate([head[w], tail[w]]), return_inverse=True)
            sizes = starts[needed + 1] - starts[needed]
            row = np.repeat(np.arange(len(needed)), sizes)
            word = at[np.arange(len(row)) - np.repeat(np.cumsum(sizes) - sizes, sizes) + np.repeat(starts[needed], sizes)]
            useful = np.flatnonzero(self.most[word] > 0)
            sums = np.zeros((len(needed), self.gain.shape[1]), np.float32)
            if len(useful):
                mine = row[useful]
                heads = np.flatnonzero(np.concatenate([[True], mine[1:] != mine[:-1]]))
                sums[mine[heads]] = np.add.reduceat(self.gain[word[useful]], heads, axis=0)
            total = sums[place[: len(w)]] + sums[place[len(w) :]] * both[w, None]
            hit, passage = np.nonzero(total >= length[w, None])
            yield owner[head[w[hit]]], starts[head[w[hit]]], passage

    def search(self, data: np.ndarray, offsets: np.ndarray) -> list[tuple[int, int, int, int]]:
        """(text, item, length of the subsequence, first word) of all items found."""
        hashes, first, _, _ = word_hashes(data, offsets, letters=True)
        if not len(hashes) or not len(self.owner):
            return []
        at = self.vocabulary.find(hashes)
        spots: dict[tuple[int, int], list[int]] = {}
        for owners, starts, passages in self.near(at, first):
            for text, start, p in zip(owners.tolist(), starts.tolist(), passages.tolist()):
                spots.setdefault((text, int(self.owner[p])), []).append(start)
        out = []
        for (text, k), places in sorted(spots.items()):
            (item, answer, count), low, high = self.numbered[k], int(first[text]), int(first[text + 1])
            around, best = len(item), (0, 0)
            groups: list[list[int]] = []
            for p in sorted(set(places)):  # windows that overlap or touch are one place
                if groups and p - groups[-1][1] <= WINDOW:
                    groups[-1][1] = p
                else:
                    groups.append([p, p])
            for a, z in groups:
                start, stop = max(low, a - around), min(high, z + WINDOW + around)
                step = 2 * around + WINDOW  # a stretch not much longer than the item
                for s in range(start, max(start + 1, stop - step + 1), max(1, around // 2)):
                    part = at[s : min(s + step, stop)]
                    part = part[count[part] > 0]  # no other word can be in a common subsequence
                    if len(part) < self.likely * around or count[np.unique(part)].sum() < self.likely * around:
                        continue
                    n = common_length(item, part)
                    if n >= self.sure * around or n >= self.likely * around and common_length(answer, part) >= self.sure * len(answer):
                        best = max(best, (n, low - s), key=lambda x: x[0])
            if best[0]:
                out.append((text, k, best[0], -best[1]))
        return out


def _kept_share(basis: np.ndarray, idf: np.ndarray, at: np.ndarray) -> float:
    """Length of a passage's vector after projection, as a share of its length."""
    words, count = np.unique(at, return_counts=True)
    x = count * idf[words]
    length = np.linalg.norm(x)
    return float(np.linalg.norm(x @ basis[words]) / length) if length else 1.0


def indexes(docs: DataFrame, benchmark: DataFrame, held: float, rare: float, cosine: float, sure: float, likely: float, least: int, slice_words: int):
    """An index for each slice of the benchmark."""
    rows = benchmark.filter(F.col("text").isNotNull()).select(F.col("item_id").cast("long").alias("item_id"), "text")
    total = rows.agg(F.sum(F.size(F.split("text", r"\s+")))).first()[0] or 0
    slices = max(1, -(-total // slice_words))
    for s in range(slices):
        part = rows.filter(F.pmod(F.xxhash64("item_id", "text"), F.lit(slices)) == s)
        items = [item_of(*r) for r in part.distinct().collect()]  # about slice_words words
        items = sorted((i for i in items if len(i.words) >= least), key=lambda i: (i.item_id is None, i.item_id or 0, i.words.tobytes()))
        if not items:
            continue
        vocabulary = Vocabulary(np.concatenate([i.words for i in items]))
        n, df = document_frequencies(docs, vocabulary)
        idf = np.maximum(np.log((n + 1) / (df + 0.5)), rare)
        at = [vocabulary.find(p) for i in items for p in passages_of(i)]
        passages = docs.sparkSession.createDataFrame([(p.tolist(),) for p in at], "at array<int>")
        rank = max(1, len(at) // 2)
        while True:
            basis = latent_basis(passages, idf, rank)
            if rank >= min(len(at), len(idf)) or min(_kept_share(basis, idf, p) for p in at) >= held:
                break
            rank *= 2
        yield Index(items, vocabulary, idf, basis, cosine, sure, likely)


#: Parameters of the queries: length kept in the latent space, smallest weight of a word, cosine of a candidate, shares of an
#: item's words, shortest item, words in a slice of the benchmark.
SETTINGS = {"held": 0.9, "rare": 1.0, "cosine": 0.4, "sure": 0.8, "likely": 0.55, "least": 6, "slice_words": 10_000}


def find(docs: DataFrame, benchmark: DataFrame, **settings) -> DataFrame:
    """A row for each document and item in it: length of the common subsequence, words of the item, first word of the stretch."""
    spark = docs.sparkSession
    out = None
    for index in indexes(docs, benchmark, **SETTINGS | settings):
        shared = spark.sparkContext.broadcast(index)

        def run(batches, shared=shared):
            index = shared.value
            for part, data, offsets in text_parts(batches, "text", SLICE, lower=True):
                ids, best = part.column("doc_id").to_pylist(), {}
                for text, k, n, start in index.search(data, offsets):
                    key = (text, index.items[k].item_id)
                    best[key] = max(best.get(key, (0, 0, 0)), (n, len(index.items[k].words), start))
                rows = [(ids[t], item, *v) for (t, item), v in best.items()]
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in (zip(*rows) if rows else [[]] * 5)], names=[c.split()[0] for c in HITS.split(", ")])

        found = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(sparing(run), HITS)
        out = found if out is None else out.union(found)
    return out if out is not None else spark.createDataFrame([], HITS)


def keep_clean(docs: DataFrame, benchmark: DataFrame, **settings) -> DataFrame:
    """The documents without any item, with all their columns."""
    spark, place = docs.sparkSession, docs.columns.index("text")
    for index in list(indexes(docs, benchmark, **SETTINGS | settings)):
        shared = spark.sparkContext.broadcast(index)

        def run(batches, shared=shared):
            for batch in batches:
                texts = pa.RecordBatch.from_arrays([batch.column(place), pa.array(np.arange(batch.num_rows))], names=["text", "row"])
                clean = np.ones(batch.num_rows, bool)
                for part, data, offsets in text_parts([texts], "text", SLICE, lower=True):
                    rows = part.column("row").to_numpy()
                    clean[[rows[hit[0]] for hit in shared.value.search(data, offsets)]] = False
                yield batch.filter(pa.array(clean))

        docs = docs.mapInArrow(sparing(run), docs.schema)
    return docs
