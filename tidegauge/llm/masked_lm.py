"""Masked pseudo-likelihood: each word is predicted from the words on both sides of it.

Words fall into classes. The most frequent words of the whole corpus are classes of their own; every other word belongs to
the class of its last two bytes. p(word | context) = p(class | context) * p(word | class). The network predicts the class of the
middle from the classes of ``SIDE`` words on the left and on the right: one table of vectors per position, their sum, tanh,
softmax. p(word | class) is 1 for a frequent word and (n + ``MORE``) / (tokens of the class + ``MORE`` * (its words + 1)) for a word that occurs n
times in the corpus; a word never seen has n = 0. The sum of the log probabilities of all words is the score of a document.

The table of all words grows with the corpus and stays in Spark: rare words of the documents go to buckets by hash, packed, meet the
counts of the bucket there, and their sums go back to the part of the documents they came from.

Counts come from all documents. Training is one pass over all documents in ``ROUNDS`` parts: in each, every task takes the network
of the round before, trains it on its words of that part with numpy (Adagrad), and the networks are averaged, weighted by their words, in
two steps. Nothing but the class list and the network (some 60,000 numbers) reaches the driver; the word table does not.

Words are split at ASCII white space, A-Z count as a-z. Null or empty texts have 0 words, log_prob 0 and null mean and perplexity.
Repeated rows give repeated rows, an empty table an empty result, a null id stays null. Other columns are ignored.
Equal counts: the smaller hash is the more frequent word.

Most of the time goes into the softmax over all classes. Its exponentials are powers of two by a polynomial (``powers``), whose error is that of the
products in single precision; biases are factors of the sums, so the products have no column of ones.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import cached_property

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import _LOWER, stored, text_parts, word_hashes

HEAD, ENDINGS, SIDE, HIDDEN = 384, 128, 2, 24
CLASSES = HEAD + ENDINGS
ROUNDS, BATCH, PART, RATE = 2, 2048, 512, 0.08
PLACES = 2 * SIDE
GROUPS = 64
MORE = 0.5  # added to the count of each word of a class, and of one never seen
LOOKUPS, SPLIT = 64, 1 << 21  # buckets of the word table: so many, and one more for so many words of text
STEPS = np.array([*range(-SIDE, 0), *range(1, SIDE + 1)])
LOG2E = np.float32(1.4426950408889634)
#: 2**x for x in [-0.5, 0.5] is SCALE * (((x + c0) * x + c1) * x + c2) * x + c3, with a relative error of at most 2.6e-6, as much above as below.
POWER = [np.float32(c) for c in (5.8429743858996614, 25.103959245914712, 72.42575067589274, 104.49201806330325)]
SCALE = np.float32(0.009570101908070106)
ROUND = np.float32(12582912)  # 1.5 * 2**23: added to a whole number, its low bits are that number
LIMIT = 40.0  # logits below this leave the exponents of single precision room


def endings(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Class of the last two bytes of each word, A-Z as a-z."""
    last = _LOWER[data[ends - 1]].astype(np.int64)
    before = np.where(ends - starts > 1, _LOWER[data[np.maximum(ends - 2, 0)]], 0)
    return (last * 31 + before) % ENDINGS


@dataclass
class Classes:
    """Hashes of the head words in order of their hash, their class numbers, words per class, share of each class, and its tokens."""

    hashes: np.ndarray
    numbers: np.ndarray
    sizes: np.ndarray
    shares: np.ndarray
    tokens: np.ndarray

    def whole(self) -> np.ndarray:
        """log of what (n + MORE) is divided by in p(word | class); 0 for the classes of one word."""
        return np.append(np.zeros(HEAD), np.log(self.tokens[HEAD:] + MORE * self.sizes[HEAD:]))

    def of(self, data: np.ndarray, hashes: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        found = HEAD + endings(data, starts, ends)
        slots, numbers, others = self.slots
        at = (hashes >> np.uint64(48)).astype(np.int64)
        found = np.where(slots[at] == hashes, numbers[at], found)
        for k in others:
            found[hashes == self.hashes[k]] = self.numbers[k]
        return found

    @cached_property
    def slots(self) -> tuple[np.ndarray, np.ndarray, list[int]]:
        """Hashes and numbers of the head words by the first 16 bits of the hash, and places of those whose slot is taken."""
        every = np.arange(1 << 16, dtype=np.uint64)
        first, numbers, others = ~(every << np.uint64(48)), np.zeros(1 << 16, np.int64), []  # an empty slot has a hash that belongs elsewhere
        for k, slot in enumerate((self.hashes >> np.uint64(48)).astype(np.int64).tolist()):
            if first[slot] >> np.uint64(48) == slot:
                others.append(k)
            else:
                first[slot], numbers[slot] = self.hashes[k], self.numbers[k]
        return first, numbers, others


def distinct(hashes: np.ndarray, ending: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct hashes in ascending order, their endings and counts.

    Values sort much faster than their order is found: the hashes are sorted once, and once with the ending in place of the last bits.
    """
    low = np.uint64(ENDINGS - 1)
    words = np.sort(hashes)
    heads = np.flatnonzero(np.append(True, words[1:] != words[:-1])) if len(words) else np.zeros(0, np.int64)
    n = np.diff(np.append(heads, len(words)))
    marked = np.sort((hashes & ~low) | ending.astype(np.uint64))
    if len(heads) and ((words[heads[1:]] ^ words[heads[:-1]]) <= low).any():  # words that differ in the last bits only
        words, first, n = np.unique(hashes, return_index=True, return_counts=True)
        return words, ending[first], n
    return words[heads], (marked[heads] & low).astype(np.int64), n


def count_words(docs: DataFrame) -> DataFrame:
    """(hash, ending, n) of each distinct word of all texts; each task adds up its own first."""

    def run(batches):
        for part, data, offsets in text_parts(batches, "text", 8 << 20):
            hashes, _, starts, ends = word_hashes(data, offsets)
            words, ending, n = distinct(hashes, endings(data, starts, ends))
            yield pa.RecordBatch.from_arrays([pa.array(words.view(np.int64)), pa.array(ending.astype(np.int32)), pa.array(n)], names=["hash", "ending", "n"])

    return docs.select("text").mapInArrow(run, "hash long, ending int, n long").groupBy("hash", "ending").agg(F.sum("n").alias("n"))


def learn_classes(docs: DataFrame, counts: DataFrame | None = None) -> Classes:
    """``counts`` is the stored table of ``count_words``; without it the words of ``docs`` are counted."""
    counts = stored(count_words(docs), "words") if counts is None else counts
    head = counts.orderBy(F.desc("n"), "hash").limit(HEAD).collect()  # <= HEAD rows
    by_class = {r["ending"]: r for r in counts.groupBy("ending").agg(F.count(F.lit(1)).alias("words"), F.sum("n").alias("n")).collect()}  # <= ENDINGS rows
    sizes, total = np.ones(CLASSES), np.ones(CLASSES)
    for e, r in by_class.items():
        sizes[HEAD + e] += r["words"]
        total[HEAD + e] += r["n"]
    for k, r in enumerate(head):
        total[k] += r["n"]
        sizes[HEAD + r["ending"]] -= 1
        total[HEAD + r["ending"]] -= r["n"]
    hashes = np.array([r["hash"] for r in head], np.int64).view(np.uint64)
    order = np.argsort(hashes)
    return Classes(hashes[order], order, np.maximum(sizes, 1), total / total.sum(), total - 1)


def powers(x: np.ndarray, spare: np.ndarray) -> None:
    """Turns x into 2**x / SCALE; ``spare`` is room for two more of its kind."""
    whole, value = spare
    np.rint(x, out=whole)
    x -= whole
    whole += ROUND
    np.add(x, POWER[0], out=value)
    for c in POWER[1:]:
        value *= x
        value += c
    exponent = whole.view(np.int32)
    exponent <<= 23
    np.add(value.view(np.int32), exponent, out=x.view(np.int32))


def room(kind: type = np.float32) -> np.ndarray:
    """What ``train`` and ``forward`` work in; used again and again."""
    return np.empty((3, PART, CLASSES), kind)


@dataclass
class Network:
    """Vectors by (position, class) with a last class for places outside the text; output weights, their last row the biases."""

    vectors: np.ndarray
    output: np.ndarray

    @staticmethod
    def start(classes: Classes) -> Network:
        rng = np.random.default_rng(3)
        output = np.concatenate([rng.normal(0, 0.1, (HIDDEN, CLASSES)), np.log(classes.shares)[None, :]])
        return Network(rng.normal(0, 0.1, (PLACES, CLASSES + 1, HIDDEN)).astype(np.float32), output.astype(np.float32))

    def flat(self) -> np.ndarray:
        return np.concatenate([self.vectors.ravel(), self.output.ravel()])

    @staticmethod
    def of(flat: np.ndarray) -> Network:
        flat, cut = flat.astype(np.float32), PLACES * (CLASSES + 1) * HIDDEN
        return Network(flat[:cut].reshape(PLACES, CLASSES + 1, HIDDEN).copy(), flat[cut:].reshape(HIDDEN + 1, CLASSES).copy())

    def ready(self) -> tuple[np.ndarray, np.ndarray, bool]:
        """Weights and factors by class: the exponentials are the factors times what ``forward`` leaves in ``out``. True: by ``powers``."""
        weights, biases = self.output[:HIDDEN], self.output[HIDDEN]
        if weights.dtype == np.float32 and (np.abs(weights).sum(axis=0) + np.abs(biases)).max() < LIMIT:  # no logit is larger, as tanh is at most 1
            return weights * LOG2E, np.exp(biases) * SCALE, True
        return weights, np.ones(CLASSES, weights.dtype), False

    def spread(self, context: np.ndarray, out: np.ndarray, spare: np.ndarray | None, ready: tuple) -> tuple[np.ndarray, np.ndarray, np.ndarray | float]:
        """Hidden layer, sums of the exponentials, and what was taken off the logits.

        ``out`` (rows x classes) gets the exponentials of all classes, each to be multiplied by the factor of its class.
        """
        weights, factors, quick = ready
        vectors, less = self.vectors.reshape(-1, HIDDEN), 0.0
        hidden = vectors.take(context[:, 0], axis=0)
        for p in range(1, PLACES):
            hidden += vectors.take(context[:, p] + p * (CLASSES + 1), axis=0)
        np.tanh(hidden, out=hidden)
        np.matmul(hidden, weights, out=out)
        if quick:
            powers(out, np.empty((2, *out.shape), out.dtype) if spare is None else spare)
        else:
            out += self.output[HIDDEN]
            less = out.max(axis=1)
            out -= less[:, None]
            np.exp(out, out=out)
        return hidden, out @ factors, less

    def forward(self, context: np.ndarray, target: np.ndarray, out: np.ndarray, spare: np.ndarray | None = None, ready: tuple | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Hidden layer, sums of the exponentials, and log probabilities of the targets; ``out`` as in ``spread``."""
        hidden, sums, less = self.spread(context, out, spare, ready or self.ready())
        chosen = np.einsum("ij,ji->i", hidden, self.output[:HIDDEN].take(target, axis=1)) + self.output[HIDDEN].take(target)
        return hidden, sums, (chosen - less).astype(np.float64) - np.log(sums.astype(np.float64))


def add_rows(places: np.ndarray, rows: np.ndarray, n: int) -> np.ndarray:
    """Sums of rows by place: row i counts in each of ``places[i]``."""
    flat = places.astype(np.uint16).ravel()
    order = np.argsort(flat, kind="stable")
    flat = flat[order]
    heads = np.flatnonzero(np.append(True, flat[1:] != flat[:-1]))
    sums = np.zeros((n, rows.shape[1]), rows.dtype)
    pairs = np.result_type(rows, np.complex64)  # two numbers are added at a time
    sums.view(pairs)[flat[heads]] = np.add.reduceat(rows.take(order // places.shape[1], axis=0).view(pairs), heads, axis=0)
    return sums


def train(network: Network, state: list[np.ndarray], context: np.ndarray, target: np.ndarray, work: np.ndarray | None = None) -> None:
    """One step of Adagrad on the mean log loss, its rows taken in parts."""
    n = len(target)
    work = room(network.output.dtype) if work is None else work
    ready = network.ready()
    factors = ready[1]
    back = np.empty((n, HIDDEN), network.vectors.dtype)
    output = np.zeros_like(network.output)
    weighted = (network.output[:HIDDEN] * factors).T
    for low in range(0, n, PART):
        high = min(low + PART, n)
        error, spare = work[0, : high - low], work[1:, : high - low]
        hidden, sums, _ = network.spread(context[low:high], error, spare, ready)
        part = (1 / (sums * n))[:, None]
        error[np.arange(high - low), target[low:high]] -= sums / factors[target[low:high]]  # now the error of the softmax is error * factors * part * n
        output[:HIDDEN] += (hidden * part).T @ error
        output[HIDDEN] += part[:, 0] @ error
        back[low:high] = (error @ weighted) * part * (1 - hidden * hidden)
    output *= factors
    vectors = add_rows(context + np.arange(PLACES) * (CLASSES + 1), back, PLACES * (CLASSES + 1)).reshape(network.vectors.shape)
    for value, gradient, seen in zip((network.vectors, network.output), (vectors, output), state):
        step = np.square(gradient)
        seen += step
        np.sqrt(seen, out=step)
        step += 1e-6
        np.divide(gradient, step, out=step)
        step *= RATE
        value -= step


def lines(classes: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """All texts in one line with ``SIDE`` places of class ``CLASSES`` around each, and where its words are."""
    at = np.arange(len(classes)) + SIDE * np.repeat(np.arange(1, len(first)), np.diff(first))
    line = np.full(len(classes) + SIDE * len(first), CLASSES)
    line[at] = classes
    return line, at


def contexts(line: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Classes around the places ``at``."""
    return line[at[:, None] + STEPS]


def learn_network(docs: DataFrame, classes: Classes) -> Network:
    network = Network.start(classes)
    spark = docs.sparkSession
    known = spark.sparkContext.broadcast(classes)
    for r in range(ROUNDS):
        given = spark.sparkContext.broadcast(network.flat())

        def run(batches, given=given):
            own, classes, total = Network.of(given.value), known.value, 0
            state, work = [np.full_like(x, 1e-4) for x in (own.vectors, own.output)], room()
            for _, data, offsets in text_parts(batches, "text", 1 << 20):
                hashes, first, starts, ends = word_hashes(data, offsets)
                number = classes.of(data, hashes, starts, ends)
                line, at = lines(number, first)
                total += len(number)
                for low in range(0, len(number), BATCH):
                    train(own, state, contexts(line, at[low : low + BATCH]), number[low : low + BATCH], work)
            if total:
                group = TaskContext.get().partitionId() % GROUPS
                yield pa.RecordBatch.from_arrays([pa.array([group], pa.int32()), pa.array([float(total)]), pa.array([(own.flat().astype(np.float64) * total)], pa.list_(pa.float64()))], names=["grp", "n", "flat"])

        part = docs.filter(F.pmod(F.xxhash64("doc_id"), F.lit(ROUNDS)) == r).select("text")
        sums = part.mapInArrow(run, "grp int, n double, flat array<double>").withColumn("flat", array_to_vector("flat"))
        sums = sums.groupBy("grp").agg(F.sum("n").alias("n"), Summarizer.sum(F.col("flat")).alias("flat")).withColumn("grp", F.lit(0))
        row = sums.groupBy("grp").agg(F.sum("n").alias("n"), Summarizer.sum(F.col("flat")).alias("flat")).select("n", vector_to_array("flat").alias("flat")).first()  # one network
        if row and row["n"]:
            network = Network.of(np.array(row["flat"]) / row["n"])
    return network


def _from_counts(rare: DataFrame, counts: DataFrame, buckets: int) -> DataFrame:
    """(part, at, log): for each part and bucket the texts with rare words in it, and their sums of log(n + MORE)."""

    def look(left: pa.Table, right: pa.Table) -> pa.Table:
        known, n = right["hash"].to_numpy(), right["n"].to_numpy()
        order = np.argsort(known)
        known, value = known[order], np.append(np.log(n[order] + MORE), np.log(MORE))
        out = []
        for part, at, hashes in zip(left["part"].to_pylist(), left["at"].to_pylist(), left["hash"].to_pylist()):
            at, hashes = np.frombuffer(at, "<u4"), np.frombuffer(hashes, "<i8")
            place = np.searchsorted(known, hashes)
            if len(known):
                place = np.where(known[np.minimum(place, len(known) - 1)] == hashes, place, len(known))
            heads = np.flatnonzero(np.append(True, at[1:] != at[:-1]))
            out.append((part, at[heads].tobytes(), np.add.reduceat(value[place], heads).astype("<f8").tobytes()))
        columns = list(zip(*out)) if out else [[], [], []]
        return pa.table([pa.array(columns[0], pa.int64()), pa.array(columns[1], pa.binary()), pa.array(columns[2], pa.binary())], names=["part", "at", "log"])

    words = counts.select(F.pmod("hash", F.lit(buckets)).cast("int").alias("bucket"), "hash", "n")
    return rare.groupBy("bucket").cogroup(words.groupBy("bucket")).applyInArrow(look, "part long, at binary, log binary")


def score(docs: DataFrame, classes: Classes, network: Network, counts: DataFrame | None = None) -> DataFrame:
    """doc_id, n_words, log_prob (the sum over all words), mean_log_prob and perplexity.

    ``counts`` is the stored table of ``count_words`` over the corpus; without it the words of ``docs`` are counted.
    """
    sc = docs.sparkSession.sparkContext
    given = sc.broadcast((classes, network))
    counts = stored(count_words(docs), "words") if counts is None else counts
    buckets = LOOKUPS + (counts.agg(F.sum("n")).first()[0] or 0) // SPLIT
    names = ["part", "bucket", "at", "hash", "doc_id", "n_words", "log"]
    kinds = [pa.int64(), pa.int32(), pa.binary(), pa.binary(), pa.list_(pa.int64()), pa.list_(pa.int64()), pa.list_(pa.float64())]

    def run(batches):
        classes, network = given.value
        whole = classes.whole()
        work, ready = room(), network.ready()
        number_of_part = TaskContext.get().partitionId() << 32
        for part, data, offsets in text_parts(batches, "text", 4 << 20):
            hashes, first, starts, ends = word_hashes(data, offsets)
            number = classes.of(data, hashes, starts, ends)
            logs = np.empty(len(number))
            line, at = lines(number, first)
            for low in range(0, len(number), PART):
                high = min(low + PART, len(number))
                logs[low:high] = network.forward(contexts(line, at[low:high]), number[low:high], work[0, : high - low], work[1:, : high - low], ready)[2]
            total = np.concatenate([[0.0], np.cumsum(logs - whole[number])])
            rows = [(number_of_part, -1, None, None, part.column("doc_id").to_pylist(), np.diff(first), total[first[1:]] - total[first[:-1]])]
            rare = np.flatnonzero(number >= HEAD)
            text = np.repeat(np.arange(len(first) - 1, dtype="<u4"), np.diff(first))[rare]
            words = hashes[rare].view(np.int64)
            bucket = np.mod(words, buckets)
            order = np.argsort(bucket.astype(np.uint16) if buckets < 1 << 16 else bucket, kind="stable")  # texts stay in order
            text, words = text[order], words[order].astype("<i8")
            seen, heads = np.unique(bucket[order], return_index=True)
            for b, low, high in zip(seen.tolist(), heads, np.append(heads[1:], len(words))):
                rows.append((number_of_part, b, text[low:high].tobytes(), words[low:high].tobytes(), None, None, None))
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names=names)
            number_of_part += 1

    def add(left: pa.Table, right: pa.Table) -> pa.Table:
        """The texts of a part with what the buckets found for them."""
        ids, n, log = (left[c].combine_chunks().values for c in ("doc_id", "n_words", "log"))
        log = log.to_numpy().copy()
        for at, value in zip(right["at"].to_pylist(), right["log"].to_pylist()):
            log[np.frombuffer(at, "<u4")] += np.frombuffer(value, "<f8")
        return pa.table([ids, n, pa.array(log)], names=["doc_id", "n_words", "log_prob"])

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    rows = stored(rows.mapInArrow(run, "part long, bucket int, at binary, hash binary, doc_id array<long>, n_words array<long>, log array<double>"), "scored")
    found = _from_counts(rows.filter("bucket >= 0").select("part", "bucket", "at", "hash"), counts, buckets)
    texts = rows.filter("bucket < 0").select("part", "doc_id", "n_words", "log")
    rows = texts.groupBy("part").cogroup(found.groupBy("part")).applyInArrow(add, "doc_id long, n_words long, log_prob double")
    mean = F.when(F.col("n_words") > 0, F.col("log_prob") / F.col("n_words"))
    return rows.select("doc_id", "n_words", "log_prob", mean.alias("mean_log_prob"), F.exp(-mean).alias("perplexity"))


def score_corpus(docs: DataFrame) -> DataFrame:
    """Learn from all documents, score all of them."""
    counts = stored(count_words(docs), "words")
    classes = learn_classes(docs, counts)
    return score(docs, classes, learn_network(docs, classes), counts)
