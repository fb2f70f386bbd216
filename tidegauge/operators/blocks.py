"""Lists of words in compressed blocks, a block per bucket, for jobs that bring equal lines or pairs together.

A shuffle of one row per line or pair writes many times the text that they were made of. Here a task makes
its lines or pairs distinct, deals them to buckets and hands on one compressed block per bucket; the task that
gets a bucket meets all that is equal in it. Nothing but the words decides the bucket.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Words that a task looks at together.
CHUNK = 1_000_000
#: Pairs that are made distinct together.
PAIRS = 8_000_000
#: Buckets of a task, one in memory at a time.
BUCKETS = 8
#: Rows that leave a task at a time.
ROWS = 50_000
_FACTORS = np.random.default_rng(20261202).integers(1, 1 << 63, 64, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
BLOCK = "bucket int, words binary, sizes binary, counts binary"


def _squeeze(data: bytes | memoryview | np.ndarray) -> bytes:
    data = bytes(data)
    return len(data).to_bytes(8, "little") + pa.compress(data, codec="zstd", asbytes=True)


def _loose(data: bytes) -> bytes:
    return pa.decompress(data[8:], int.from_bytes(data[:8], "little"), codec="zstd", asbytes=True)


def chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.Array, np.ndarray]]:
    """The words of about ``CHUNK`` words of lines, and where each line starts (one more entry than lines).

    Lines come as lists of words, or as text with one blank between words. A longer line is not parted.
    """
    held: list[pa.Array] = []
    n = 0
    for batch in batches:
        lists = batch.column(0).drop_null()
        lists = lists if pa.types.is_list(lists.type) else pc.split_pattern(lists, " ")
        starts, first = lists.offsets.to_numpy().astype(np.int64), 0
        while first < len(lists):
            last = max(first + 1, int(np.searchsorted(starts, starts[first] + CHUNK - n, "right")) - 1)
            held.append(lists.slice(first, last - first))
            n += int(starts[last] - starts[first])
            first = last
            if n >= CHUNK:
                yield _flat(held)
                held, n = [], 0
    if n:
        yield _flat(held)


def _flat(lists: list[pa.Array]) -> tuple[pa.Array, np.ndarray]:
    one = pa.concat_arrays(lists)
    starts = one.offsets.to_numpy().astype(np.int64)
    return one.flatten(), starts - starts[0]


def _unique(numbers: np.ndarray) -> np.ndarray:
    """Sorted distinct numbers; sorting beats the hashes of np.unique on long lists."""
    numbers = np.sort(numbers)
    return numbers[np.diff(numbers, prepend=-1) != 0]


def _encoded(words: pa.Array) -> tuple[np.ndarray, pa.Array]:
    coded = words.dictionary_encode()
    return coded.indices.to_numpy(), coded.dictionary


def _hashes(words: pa.Array) -> np.ndarray:
    """A 64-bit number per word: the sum of its bytes times a factor for their place, scrambled."""
    words = words.cast(pa.large_string())
    at = np.frombuffer(words.buffers()[1], np.int64)[words.offset : words.offset + len(words) + 1]
    data = np.frombuffer(words.buffers()[2] or b"", np.uint8)[at[0] : at[-1]]
    at = at - at[0]
    place = np.arange(len(data)) - np.repeat(at[:-1], np.diff(at))
    sums = np.append(np.uint64(0), np.cumsum((data + np.uint64(1)) * _FACTORS[place % len(_FACTORS)]))
    x = sums[at[1:]] - sums[at[:-1]]
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _ranked(words: pa.Array) -> tuple[np.ndarray, pa.Array, np.ndarray]:
    """A number per word that is larger for longer words, in one order in all tasks; the words by number, and their hashes.

    Long words are rare, so the longest one of a line or pair is a key with few rows. Words of one length go by their hash, then by themselves.
    """
    codes, known = _encoded(words)
    hashes = _hashes(known)
    key = np.minimum(pc.binary_length(known).to_numpy(), 255).astype(np.uint64) << np.uint64(56) | hashes >> np.uint64(8)
    order = np.argsort(key)
    if (key[order][1:] == key[order][:-1]).any():
        order = pc.sort_indices(pa.table({"key": key, "word": known}), sort_keys=[("key", "ascending"), ("word", "ascending")]).to_numpy()
    rank = np.empty(len(known), np.int64)
    rank[order] = np.arange(len(known))
    return rank[codes], known.take(pa.array(order)), hashes[order]


def _joined(values: pa.Array, starts: np.ndarray) -> pa.Array:
    return pc.binary_join(pa.ListArray.from_arrays(pa.array(starts, pa.int32()), values.cast(pa.large_string())), pa.scalar(" ", pa.large_string()))


def _ranges(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The numbers from each start on, ``sizes`` of them."""
    return np.repeat(starts - (np.cumsum(sizes) - sizes), sizes) + np.arange(int(sizes.sum()))


def _blocks(bucket: np.ndarray, texts: pa.Array, starts: np.ndarray, sizes: np.ndarray, counts: np.ndarray) -> pa.RecordBatch:
    """Blocks of lists sorted by ``bucket``; ``texts``: pieces that lie in list i from ``starts[i]`` on."""
    at = np.append(np.flatnonzero(np.diff(bucket, prepend=-1)), len(bucket))
    joined = _joined(texts, starts[at])
    rows = [(int(bucket[a]), _squeeze(joined[i].as_buffer()), _squeeze(sizes[a:b].astype(np.int32)), _squeeze(counts[a:b].astype(np.int64))) for i, (a, b) in enumerate(zip(at[:-1], at[1:], strict=True))]
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), (pa.int32(), pa.binary(), pa.binary(), pa.binary()), strict=True)], ["bucket", "words", "sizes", "counts"])


def _met(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.Array, np.ndarray, np.ndarray]]:
    """Words, list sizes and counts of one bucket after the other; blocks come sorted by bucket."""
    bucket, held = None, []

    def whole() -> tuple[pa.Array, np.ndarray, np.ndarray]:
        text = b" ".join(_loose(w) for w, _, _ in held).decode()
        words = pc.split_pattern(pa.array([text], pa.large_string()), " ").flatten()
        return words, *(np.concatenate([np.frombuffer(_loose(x[k]), t) for x in held]).astype(np.int64) for k, t in ((1, np.int32), (2, np.int64)))

    for batch in batches:
        for b, *row in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            if b != bucket and held:
                yield whole()
                held = []
            bucket = b
            held.append(row)
    if held:
        yield whole()


def _out(*columns: tuple[str, pa.Array]) -> Iterator[pa.RecordBatch]:
    batch = pa.RecordBatch.from_arrays([c for _, c in columns], [n for n, _ in columns])
    for first in range(0, len(batch), ROWS):
        yield batch.slice(first, ROWS)


def _meet(df: DataFrame, split: Callable, meet: Callable, schema: str) -> DataFrame:
    """``split`` makes blocks of the rows, ``meet`` gets all blocks of a bucket together."""
    tasks = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = df.mapInArrow(split(tasks * BUCKETS), BLOCK).repartitionById(tasks, (F.col("bucket") % F.lit(tasks)).cast("int"))
    return dealt.sortWithinPartitions("bucket").mapInArrow(meet, schema)


# ---- lines -----------------------------------------------------------------------------


def _runs(size: int) -> Callable:
    """Splits texts into runs of consecutive lines of ``size`` words that have the same longest word.

    Lines of a run overlap, so a run of r lines is r + ``size`` - 1 words in place of r * ``size``. Equal lines have
    the same longest word, and so the same bucket, whatever run they are in. Equal runs of a chunk are one.
    """

    def split(buckets: int) -> Callable:
        def run(batches):
            for words, starts in chunks(batches):
                n = len(words) - size + 1
                if n < 1:
                    continue
                rank, _, hashes = _ranked(words)
                longest = rank[:n].copy()
                for k in range(1, size):
                    np.maximum(longest, rank[k : n + k], out=longest)
                over = np.bincount(np.maximum(starts[:-1], starts[1:] - size + 1), minlength=len(words) + 1) - np.bincount(starts[1:], minlength=len(words) + 1)
                at = np.flatnonzero(np.cumsum(over)[:n] == 0)  # a line from here on does not reach over the text's end
                if not len(at):
                    continue
                first = np.flatnonzero((np.diff(at, prepend=-2) != 1) | (np.diff(longest[at], prepend=-1) != 0))
                sizes = np.diff(np.append(first, len(at))) + size - 1
                texts = _joined(words.take(pa.array(_ranges(at[first], sizes))), np.append(0, np.cumsum(sizes)))
                codes, texts = _encoded(texts)
                key, n_words = np.empty((2, len(texts)), np.int64)
                key[codes], n_words[codes] = longest[at[first]], sizes
                bucket = (hashes % np.uint64(buckets)).astype(np.int64)[key]
                order = np.argsort(bucket, kind="stable")
                yield _blocks(bucket[order], texts.take(pa.array(order)), np.arange(len(texts) + 1), n_words[order], np.bincount(codes)[order])

        return run

    return split


def _lines(size: int) -> Callable:
    """The distinct lines of the runs in a bucket, with their numbers of occurrences."""

    def run(batches):
        for words, sizes, counts in _met(batches):
            lines = sizes - size + 1
            at = _ranges(np.cumsum(sizes) - sizes, lines)
            texts = _joined(words.take(pa.array((at[:, None] + np.arange(size)).ravel())), np.arange(len(at) + 1) * size)
            codes, texts = _encoded(texts)
            n = np.zeros(len(texts), np.int64)
            np.add.at(n, codes, np.repeat(counts, lines))
            yield from _out(("ngram", texts.cast(pa.string())), ("n", pa.array(n)))

    return run


def counted_lines(texts: DataFrame, size: int) -> DataFrame:
    """Distinct lines of ``size`` consecutive words with their number of occurrences: (ngram, n). ``texts`` has one column, a list of words without blanks."""
    return _meet(texts, _runs(size), _lines(size), "ngram string, n long")


# ---- pairs -----------------------------------------------------------------------------


def _pairs_of(buckets: int) -> Callable:
    """Splits lines into pairs of different words, once per chunk, as lists: the longer word, then its shorter ones."""

    def run(batches):
        for words, starts in chunks(batches):
            rank, known, hashes = _ranked(words)
            sizes = np.diff(starts)
            left = np.repeat(starts[1:], sizes) - np.arange(len(words))  # words to the end of the line
            found, n = [], 0
            for k in range(1, int(sizes.max(initial=0))):
                at = np.flatnonzero(left > k)
                a, b = rank[at], rank[at + k]
                found.append((np.maximum(a, b) << 32 | np.minimum(a, b))[a != b])
                n += len(found[-1])
                if n > PAIRS:
                    found = [_unique(np.concatenate(found))]
                    n = 0
            pairs = _unique(np.concatenate(found)) if found else np.zeros(0, np.int64)
            if not len(pairs):
                continue
            bucket = (hashes % np.uint64(buckets)).astype(np.int64)[pairs >> 32]
            order = np.argsort(bucket, kind="stable")
            pairs, bucket = pairs[order], bucket[order]
            first = np.flatnonzero(np.diff(pairs >> 32, prepend=-1))
            sizes = np.diff(np.append(first, len(pairs))) + 1
            starts = np.append(0, np.cumsum(sizes))
            out = np.empty(starts[-1], np.int64)
            out[starts[:-1]] = pairs[first] >> 32
            others = np.ones(len(out), bool)
            others[starts[:-1]] = False
            out[others] = pairs & 0xFFFFFFFF
            yield _blocks(bucket[first], known.take(pa.array(out)), starts, sizes, np.ones(0))

    return run


def _distinct(batches):
    """The distinct pairs in a bucket."""
    for words, sizes, _ in _met(batches):
        codes, known = _encoded(words)
        codes = codes.astype(np.int64)
        heads = np.cumsum(sizes) - sizes
        others = np.ones(len(codes), bool)
        others[heads] = False
        pairs = _unique(np.repeat(codes[heads], sizes - 1) << 32 | codes[others])
        yield from _out(*((c, known.take(pa.array(x)).cast(pa.string())) for c, x in (("a", pairs >> 32), ("b", pairs & 0xFFFFFFFF))))


def distinct_pairs(lines: DataFrame) -> DataFrame:
    """Distinct unordered pairs of different words that share a line: (a, b). ``lines`` has one column, text with a blank between words."""
    return _meet(lines, _pairs_of, _distinct, "a string, b string")
