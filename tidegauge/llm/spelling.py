"""Spelling variants: words of a vocabulary that differ by one inserted, deleted or replaced code point.

The near words of a word are found by a scan of a sorted list. For the word, one row of the edit matrix belongs to each
prefix in the list, and only its three cells around the diagonal can be at most one. A prefix that several list
entries share has its row computed once (adjacent entries share as many rows as their longest common prefix), and when all three
cells of a row exceed one, the whole range of entries with that prefix is skipped. The scan goes by depth, for all words of a batch at once.

So that lists stay small, they are not the whole vocabulary. If the shorter word of a pair has m code points and the first
difference is at place p, both words share the p code points before and the m - 1 - p last ones. Places are cut into windows:
for each window [lo, hi) words of length m and m + 1 meet that share the first lo and the last m - hi code points, and the list
holds what is between. Windows start as two halves; a window whose list is too long is halved again, down to one
place, where a list has at most some thousand entries. A pair counts in the window of its place only, so each is met once. At most
2 * m rows stand for a word, and each list hands back, per word, only the number of near words and the best one.

Words are runs of letters (A to Z in either case and U+00C0 to U+00FF; A-Z become a-z) after the removal of one code point where the
crc32 of id and run says so. Counts are added per task before the shuffle. Null and empty texts have no words; a null id counts as
the empty text in the crc32; repeated rows count each time; an empty table gives no rows. Equal counts: the first word in
code-point order. Following forms ends, as each has at least twice the count of the one before. Other input columns are ignored.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import stored

FAR = 2
#: Words that a task counts before it hands them on.
COUNTED = 400_000
#: Code points in one list, after which its window is halved; in one batch of lists; rows of edit matrices at a time.
LIST, BATCH, ROWS = 200_000, 2_000_000, 1_000_000
FOUND = "word string, n_near long, best string, best_n long"


def runs(text: str, length: int) -> list[str]:
    """Lower-cased runs of at least ``length`` letters."""
    return re.findall(rf"[a-zÀ-ÿ]{{{length},}}", text.encode("utf-8").lower().decode("utf-8"))


def spelled(doc_id: int | None, run: str, one_in: int) -> str:
    """The run, without one code point if the hash of id and run is divisible."""
    h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
    at = h % len(run)
    return run if h % one_in else run[:at] + run[at + 1 :]


def vocabulary(docs: DataFrame, doc_id: str, text: str, length: int, least: int, one_in: int) -> DataFrame:
    """(word, n) of words with at least ``length`` code points and ``least`` occurrences."""

    def count(batches):
        counts: Counter[str] = Counter()
        for batch in batches:
            for i, t in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                for run, n in Counter(runs(t, length)).items():
                    counts[spelled(i, run, one_in)] += n
                if len(counts) > COUNTED:
                    yield table(counts)
                    counts = Counter()
        yield table(counts)

    def table(counts):
        return pa.RecordBatch.from_arrays([pa.array(list(counts), pa.string()), pa.array(list(counts.values()), pa.int64())], names=["word", "n"])

    parts = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("text")).mapInArrow(count, "word string, n long")
    return parts.filter(F.length("word") >= length).groupBy("word").agg(F.sum("n").alias("n")).filter(F.col("n") >= least)


def windowed(words: DataFrame, length: int) -> DataFrame:
    """Each word as the shorter and as the longer of a pair, in both halves of the places."""
    m = F.explode(F.filter(F.array(F.length("word"), F.length("word") - 1), lambda x: x >= length)).alias("m")
    halves = F.explode(F.array(F.struct(F.lit(0).alias("lo"), F.expr("m div 2").alias("hi")), F.struct(F.expr("m div 2").alias("lo"), F.col("m").alias("hi")))).alias("w")
    return words.select("word", "n", m).select("word", "n", "m", halves).select("word", "n", "m", F.expr("int(w.lo)").alias("lo"), F.expr("int(w.hi)").alias("hi"))


def keyed(rows: DataFrame) -> DataFrame:
    """With a hash of what the words of a window share; lists are told apart by their content later."""
    shared = [F.expr("left(word, lo)"), F.expr("right(word, m - hi)")]
    return rows.withColumn("key", F.xxhash64("m", "lo", "hi", *shared))


def lists(words: DataFrame, length: int, limit: int) -> DataFrame:
    """Rows (word, n, m, lo, hi, key) whose keys hold at most ``limit`` code points, or words for one place."""
    open_rows, closed = keyed(windowed(words, length)), []
    while True:
        size = F.sum(F.col("hi") - F.col("lo") + 1)
        large = open_rows.groupBy("key").agg(size.alias("size"), F.count(F.lit(1)).alias("rows"), F.max(F.col("hi") - F.col("lo")).alias("width"))
        large = stored(large.filter((F.col("size") > limit) & (F.col("rows") > 1) & (F.col("width") > 1)).select("key", F.lit(True).alias("large")), "large-lists")
        if large.isEmpty():
            break
        marked = open_rows.join(large, "key", "left")
        closed.append(marked.filter(F.col("large").isNull() | (F.col("hi") - F.col("lo") == 1)).select(open_rows.columns))
        middle = F.expr("(lo + hi) div 2").cast("int")
        halves = F.explode(F.array(F.struct("lo", middle.alias("hi")), F.struct(middle.alias("lo"), "hi"))).alias("w")
        wide = marked.filter(F.col("large") & (F.col("hi") - F.col("lo") > 1)).select("word", "n", "m", halves)
        open_rows = stored(keyed(wide.select("word", "n", "m", "w.lo", "w.hi")), "halved-lists")
    for c in closed:
        open_rows = open_rows.unionByName(c)
    return open_rows


class SortedLists:
    """Sorted lists laid end to end: entries, the prefixes they share by depth, and the scan."""

    def __init__(self, groups: np.ndarray, texts: list[str]):
        width = max(map(len, texts))
        self.text = np.array(texts, f"U{width}").view(np.uint32).reshape(len(texts), width)
        self.length = np.array([len(t) for t in texts])
        self.groups, self.width = groups, width
        same = np.zeros(len(texts), np.int64)  # longest common prefix with the entry before
        equal = np.cumprod(self.text[1:] == self.text[:-1], axis=1, dtype=np.uint8).sum(axis=1)
        same[1:] = np.where(groups[1:] == groups[:-1], np.minimum(equal, np.minimum(self.length[1:], self.length[:-1])), -1)
        same[0] = -1
        self.same = same

    def prefixes(self, depth: int) -> tuple[np.ndarray, np.ndarray]:
        """First entry of each prefix of that depth, and the number of each entry's prefix (-1: the entry is shorter)."""
        long = self.length >= depth
        first = long & (self.same < depth)
        return np.flatnonzero(first), np.where(long, np.cumsum(first) - 1, -1)

    def near(self) -> tuple[np.ndarray, np.ndarray]:
        """Pairs (entry, other entry of its list) that are one edit apart, in both directions."""
        levels = [self.prefixes(d) for d in range(self.width + 1)]
        entries = np.arange(len(self.groups))
        cells = np.full((len(entries), 3), FAR, np.uint8)
        cells[:, 1], cells[:, 2] = 0, 1
        work, found = [(0, entries, levels[0][1], cells)], []
        children = [self.children(levels, d) for d in range(self.width)]
        while work:
            depth, query, prefix, cells = work.pop()
            if depth == self.width or not len(query):
                continue
            first, number = children[depth]
            many = number[prefix]
            if many.sum() > ROWS and len(query) > 1:
                half = len(query) // 2
                work += [(depth, query[:half], prefix[:half], cells[:half]), (depth, query[half:], prefix[half:], cells[half:])]
                continue
            query, cells = np.repeat(query, many), np.repeat(cells, many, axis=0)
            below = np.repeat(first[prefix] - np.concatenate([[0], np.cumsum(many)[:-1]]), many) + np.arange(len(query))
            entry = levels[depth + 1][0][below]
            cells = self.next_row(depth, query, self.text[entry, depth], cells)
            alive = np.flatnonzero(cells.min(axis=1) < FAR)  # all entries below any other prefix are skipped
            query, below, entry, cells = query[alive], below[alive], entry[alive], cells[alive]
            place = self.length[query] - depth
            ends = np.flatnonzero((self.length[entry] == depth + 1) & (place >= 0) & (place <= 2))
            ends = ends[cells[ends, place[ends]] == 1]
            found.append((query[ends], entry[ends]))
            work.append((depth + 1, query, below, cells))
        return tuple(np.concatenate(x) for x in zip(*found)) if found else (entries[:0], entries[:0])

    @staticmethod
    def children(levels, depth: int) -> tuple[np.ndarray, np.ndarray]:
        """For each prefix the first longer prefix by one, and how many there are."""
        parent = levels[depth][1][levels[depth + 1][0]]
        number = np.bincount(parent, minlength=len(levels[depth][0]))
        return np.concatenate([[0], np.cumsum(number)[:-1]]).astype(np.int64), number

    def next_row(self, depth: int, query: np.ndarray, letter: np.ndarray, old: np.ndarray) -> np.ndarray:
        """Cells at places depth, depth + 1, depth + 2 of the word, from those at depth - 1, depth, depth + 1."""
        new = np.full(old.shape, FAR, np.uint8)
        for k in range(3):
            place = depth + k
            here = self.text[query, place - 1] if 0 < place <= self.width else np.zeros(len(query), np.uint32)
            cost = old[:, k] + (here != letter)
            if k < 2:
                cost = np.minimum(cost, old[:, k + 1] + 1)
            if k:
                cost = np.minimum(cost, new[:, k - 1] + 1)
            new[:, k] = np.where(place <= self.length[query], np.minimum(cost, FAR), FAR)
        return new


def near_in(rows: list[tuple[str, int, int, int, int]]) -> list[tuple[str, int, str, int]]:
    """(word, near words, best near word, its count) for rows (word, n, m, lo, hi) of whole lists."""
    between = [(m, lo, hi, w[:lo], w[len(w) - (m - hi) :], w[lo : len(w) - (m - hi)], w, n) for w, n, m, lo, hi in rows]
    by_list = Counter(b[:5] for b in between)
    between = sorted(b for b in between if by_list[b[:5]] > 1)
    out = []
    for width in sorted({(b[2] - b[1]).bit_length() for b in between}):  # lists of like width together
        chosen = [b for b in between if (b[2] - b[1]).bit_length() == width]
        numbers: dict[tuple, int] = {}
        groups = np.array([numbers.setdefault(b[:5], len(numbers)) for b in chosen])
        scan = SortedLists(groups, [b[5] for b in chosen])
        word, other = scan.near()
        k = np.array([b[2] - b[1] for b in chosen])
        # Not two of the longer length; and an addition behind the window belongs to the next one.
        keep = (scan.length[word] == k[word]) | (scan.length[other] == k[other])
        last = np.array([b[2] == b[0] for b in chosen])
        uneven = np.flatnonzero((scan.length[word] != scan.length[other]) & ~last[word])
        short = np.where(scan.length[word[uneven]] < scan.length[other[uneven]], word[uneven], other[uneven])
        equal = (scan.text[word[uneven]] == scan.text[other[uneven]]) | (np.arange(scan.width) >= scan.length[short][:, None])
        keep[uneven[equal.all(axis=1)]] = False
        word, other = word[keep], other[keep]
        n = np.array([b[7] for b in chosen], np.int64)
        rank = np.empty(len(chosen), np.int64)
        rank[sorted(range(len(chosen)), key=lambda i: chosen[i][6])] = np.arange(len(chosen))
        order = np.lexsort((rank[other], -n[other], word))
        word, other = word[order], other[order]
        first = np.flatnonzero(np.r_[True, word[1:] != word[:-1]]) if len(word) else word
        out += [(chosen[word[i]][6], int(c), chosen[other[i]][6], int(n[other[i]])) for i, c in zip(first, np.diff(np.r_[first, len(word)]))]
    return out


def near_words(words: DataFrame, length: int, limit: int) -> DataFrame:
    """(word, n_near, best, best_n) of words with a near word; the best has the largest count, then is first."""

    def scan(batches):
        waiting, size = [], 0
        for batch in batches:
            for key, *row in zip(*(c.to_pylist() for c in batch.columns)):
                if waiting and size > BATCH and key != waiting[-1][0]:
                    yield table(near_in([w[1] for w in waiting]))
                    waiting, size = [], 0
                waiting.append((key, row))
                size += row[4] - row[3] + 1
        yield table(near_in([w[1] for w in waiting]))

    def table(found):
        columns = list(zip(*found)) or [(), (), (), ()]
        kinds = [pa.string(), pa.int64(), pa.string(), pa.int64()]
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names=[c.split()[0] for c in FOUND.split(", ")])

    rows = lists(words, length, limit).select("key", "word", "n", "m", "lo", "hi")
    found = rows.repartition("key").sortWithinPartitions("key").mapInArrow(scan, FOUND)
    best = F.min(F.struct((-F.col("best_n")).alias("n"), F.col("best").alias("best")))
    found = found.groupBy("word").agg(F.sum("n_near").alias("n_near"), best.alias("b"))
    return found.select("word", "n_near", "b.best", (-F.col("b.n")).alias("best_n"))


def roots(forms: DataFrame) -> DataFrame:
    """(word, root) for words with a form: the last of its forms, found by doubling steps."""
    steps = stored(forms.filter(F.col("form").isNotNull()).select("word", F.col("form").alias("root")), "forms")
    while True:
        ahead = steps.select(F.col("word").alias("w"), F.col("root").alias("further"))
        joined = stored(steps.join(ahead, F.col("root") == F.col("w"), "left"), "forms")
        steps = joined.select("word", F.coalesce("further", "root").alias("root"))
        if joined.filter(F.col("further").isNotNull()).isEmpty():
            return steps


def variants(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", length: int = 5, least: int = 3, one_in: int = 97, ratio: int = 2, limit: int = LIST) -> DataFrame:
    """word, form, root, n, n_near, form_n: the more frequent spelling that each word is a variant of."""
    words = stored(vocabulary(docs, doc_id, text, length, least, one_in), "words")
    near = near_words(words, length, limit)
    is_form = F.col("best_n") >= ratio * F.col("n")
    forms = words.join(near, "word", "left").select(
        "word", F.when(is_form, F.col("best")).alias("form"), "n", F.coalesce("n_near", F.lit(0)).alias("n_near"), F.when(is_form, F.col("best_n")).alias("form_n"))
    forms = stored(forms, "variants")
    out = forms.join(roots(forms), "word", "left")
    return out.select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
