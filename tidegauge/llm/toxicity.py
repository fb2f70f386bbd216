"""Toxicity from a weighted lexicon matched by Aho-Corasick.

Texts are folded first: compatibility forms and accents to base letters, look-alike letters of other scripts to
Latin ones, digits and signs that stand for letters to those letters, invisible characters away, everything else to
spaces. Syllables of Hangul stay whole, and vowel signs and other marks of scripts that need them stay inside their words. As 1 may stand for i or l, these two fold to the same letter, in texts and lexicon alike.

The lexicon is learned from a bounded sample of labelled documents: words (and their weights, the log odds)
that a fair share of the toxic ones have and others hardly. Exception phrases are two-word phrases around a lexicon word
that are not more frequent in toxic documents than in others; a match inside one does not count. The sum of weights is
divided by the length in words, and a logistic curve fitted on the same sample turns it into a probability.

Null or empty texts have no match and get the curve's value at 0, as do texts without letters. Without any labels
all scores are 0.25. Repeated rows give repeated rows, an empty table an empty result, a null id stays null and counts as the
empty text for the folds. Other input columns are ignored.
"""

from __future__ import annotations

import math
import unicodedata
from collections import Counter
from dataclasses import dataclass, field
from functools import lru_cache

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import fold_of, labelled_sample, sigmoid, stored, text_parts

# Letters of other scripts that look like Latin ones.
LOOK_ALIKE = dict(zip("аеорсухіјѕһԁԛԝкмтвнгαεικνορτυχβγηωϲ", "aeopcyxijshdqwkmtbnraeikvoptuxbynwc"))
# Digits and signs that stand for letters.
STAND_IN = {"0": "o", "1": "i", "3": "e", "4": "a", "5": "s", "7": "t", "8": "b", "9": "g", "l": "i"}
SIGNS = {"$": "s", "@": "a", "!": "i", "|": "i", "€": "e", "¡": "i"}
ACCENTS = range(0x300, 0x370)
INVISIBLE = [0xAD, *range(0x180B, 0x180E), *range(0x200B, 0x2010), *range(0x2060, 0x2065), *range(0x20D0, 0x2100), *range(0xFE00, 0xFE10), 0xFEFF, *range(0xE0100, 0xE01F0), *ACCENTS]
BLANK = 32


def base_letter(x: str) -> str:
    """A letter or digit without accents and compatibility form; itself if that takes several code points (Hangul)."""
    plain = "".join(c for c in unicodedata.normalize("NFKD", x) if ord(c) not in ACCENTS)
    return (plain if len(plain) == 1 else x).lower()[0]


@lru_cache(1)
def folding() -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Folded code point of each code point (0: leave out), the same for signs that stand before a letter, and which are written as several."""
    table = np.full(0x110000, BLANK, np.uint32)
    several = np.zeros(0x110000, bool)
    for c in range(0x110000):
        x = chr(c)
        if x.isalnum():
            low = base_letter(x)
            low = LOOK_ALIKE.get(low, low)
            table[c] = ord(STAND_IN.get(low, low))
            several[c] = len(unicodedata.normalize("NFKC", x)) > 1  # such as ligatures
        elif unicodedata.category(x) in ("Mn", "Mc"):
            table[c] = c
    table[INVISIBLE] = 0
    signs = np.zeros(0x110000, np.uint32)
    for x, y in SIGNS.items():
        signs[ord(x)] = ord(STAND_IN.get(y, y))
    return table, signs, several


def _codes(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)


def fold(text: str) -> str:
    """The folded text with a space at either end."""
    table, signs, several = folding()
    if not unicodedata.is_normalized("NFC", text):  # one spelling for letters with marks and for Hangul
        text = unicodedata.normalize("NFC", text)
    codes = _codes(text)
    if several[codes].any():
        codes = _codes("".join(unicodedata.normalize("NFKC", x) if several[ord(x)] else x for x in text))
    out = table[codes]
    sign = signs[codes]
    marks = np.flatnonzero(sign)
    marks = marks[marks < len(codes) - 1]
    if len(marks):  # a sign counts as a letter only before one
        marks = marks[out[marks + 1] > BLANK]
        out[marks] = sign[marks]
    return " " + out[out > 0].tobytes().decode("utf-32-le", "replace") + " "


@dataclass
class Lexicon:
    words: dict[str, float] = field(default_factory=dict)
    exceptions: list[str] = field(default_factory=list)
    intercept: float = -math.log(3)
    slope: float = 0.0

    def automaton(self) -> ahocorasick.Automaton | None:
        if not self.words:
            return None
        found = ahocorasick.Automaton()
        for w, weight in self.words.items():
            found.add_word(f" {w} ", (len(w), weight))
        for p in self.exceptions:
            found.add_word(f" {p} ", (len(p), None))
        found.make_automaton()
        return found


def rate(folded: str, automaton: ahocorasick.Automaton | None) -> tuple[float, int]:
    """Weight of the matches per hundred words, and their number; those inside an exception phrase don't count."""
    if automaton is None:
        return 0.0, 0
    hits = [(end - n, end, w) for end, (n, w) in automaton.iter(folded)]
    if not hits:
        return 0.0, 0
    spared = [(a, z) for a, z, w in hits if w is None]
    weights = [w for a, z, w in hits if w is not None and not any(x <= a and z <= y for x, y in spared)]
    return 100 * sum(weights) / max(1, len(folded.split())), len(weights)


def curve_input(rates: np.ndarray) -> np.ndarray:
    return np.log1p(rates)


def _texts(batches, size: int = 1 << 20):
    for part, _, _ in text_parts(batches, "text", size):
        yield part, [fold(t or "") for t in part.column("text").to_pylist()]


def _count(found) -> DataFrame:
    """A task's counters of texts by label, as rows."""

    def run(batches):
        counts = (Counter(), Counter())
        for part, texts in _texts(batches):
            for text, label in zip(texts, part.column("_label").to_pylist()):
                counts[label > 0].update(found(text))
        keys = list(counts[0].keys() | counts[1].keys())
        yield pa.RecordBatch.from_arrays([pa.array(keys, pa.string()), *[pa.array([c[k] for k in keys], pa.int64()) for c in counts]], names=["key", "clean", "toxic"])

    return run


def _by_label(sample: DataFrame, found) -> DataFrame:
    rows = sample.mapInArrow(_count(found), "key string, clean long, toxic long")
    return rows.groupBy("key").agg(F.sum("clean").alias("clean"), F.sum("toxic").alias("toxic"))


def fit_curve(x: np.ndarray, y: np.ndarray, ridge: float = 1e-2) -> tuple[float, float]:
    """Logistic regression on one input by Newton's method."""
    data = np.stack([np.ones_like(x), x], axis=1)
    beta = np.zeros(2)
    for _ in range(50):
        p = sigmoid(data @ beta)
        gradient = data.T @ (p - y) + ridge * beta
        step = np.linalg.solve((data * (p * (1 - p))[:, None]).T @ data + ridge * np.eye(2), gradient)
        beta -= np.clip(step, -5, 5)
        if np.abs(step).max() < 1e-8:
            break
    return float(beta[0]), float(beta[1])


def learn(docs: DataFrame, labels: DataFrame, folds: int = 5, held: int = 0, bound: int = 20_000, size: int = 500, support: float = 0.01, least: int = 5, odds: float = 3.5) -> Lexicon:
    """Lexicon, exceptions and curve from at most ``bound`` labelled documents.

    A lexicon word is in ``support`` of the toxic documents and in ``least`` of them, and its log odds are at least
    ``odds``; the support keeps words of a few copied texts out.
    """
    sample = stored(labelled_sample(docs.select("doc_id", "text"), labels, "toxic", folds, held, bound).select("text", "_label"), "labelled")
    totals = {r["_label"] > 0: r["count"] for r in sample.groupBy("_label").count().collect()}  # a row per label
    toxic, clean = totals.get(True, 0), totals.get(False, 0)
    if not toxic or not clean:
        return Lexicon(intercept=math.log((toxic + 0.5) / (clean + 1.5)))
    weight = F.log((F.col("toxic") + 0.5) / (toxic + 1)) - F.log((F.col("clean") + 0.5) / (clean + 1))
    rows = _by_label(sample, lambda t: set(t.split())).filter(F.col("toxic") >= max(least, support * toxic)).withColumn("w", weight).filter(F.col("w") >= odds)
    words = {r["key"]: r["w"] for r in rows.orderBy(F.desc("w"), "key").limit(size).collect()}  # <= size

    def around(text: str) -> set[str]:
        t = text.split()
        return {" ".join(t[k : k + 2]) for i, w in enumerate(t) if w in words for k in (i - 1, i) if 0 <= k < len(t) - 1}

    found = Lexicon(words)
    if words:
        rows = _by_label(sample, around).filter((F.col("clean") >= least) & (weight <= 0))
        found.exceptions = [r["key"] for r in rows.orderBy(F.desc("clean"), "key").limit(size).collect()]  # <= size

    def rates(batches):
        automaton = found.automaton()
        for part, texts in _texts(batches):
            yield pa.RecordBatch.from_arrays([pa.array([rate(t, automaton)[0] for t in texts], pa.float64()), part.column("_label")], names=["rate", "_label"])

    seen = sample.mapInArrow(rates, "rate double, _label int").toPandas()  # <= bound rows of two numbers
    found.intercept, found.slope = fit_curve(curve_input(seen["rate"].to_numpy()), (seen["_label"].to_numpy() > 0).astype(float))
    return found


def score(docs: DataFrame, lexicon: Lexicon) -> DataFrame:
    """doc_id, probability, number of matches for each whole text."""

    def run(batches):
        automaton = lexicon.automaton()
        for part, texts in _texts(batches):
            seen = [rate(t, automaton) for t in texts]
            x = curve_input(np.array([r for r, _ in seen], float))
            yield pa.RecordBatch.from_arrays([part.column("doc_id"), pa.array(sigmoid(lexicon.intercept + lexicon.slope * x)), pa.array([n for _, n in seen], pa.int64())], names=["doc_id", "score", "n_matches"])

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(run, "doc_id long, score double, n_matches long")


def score_held_out(docs: DataFrame, labels: DataFrame, folds: int = 5, held: int = 0) -> DataFrame:
    """Learn outside the held-out fold, score all documents."""
    scored = score(docs, learn(docs, labels, folds, held))
    return scored.select("doc_id", (fold_of("doc_id", folds) == held).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"), "n_matches")
