"""Language identification with hyperdimensional profiles.

Each letter has a random vector of +1 and -1 in ``dims`` dimensions, drawn from its code point. A run
of three letters is bound into one vector: the vectors of the letters, rotated by two, one and no
places, are multiplied element by element. A document is the bundle (sum) of the vectors of all its runs; words are
padded with a space, whose vector counts as a letter's. A language is the bundle of its documents, each
scaled to length 1 so that long ones don't rule, less the mean of all languages. A document gets the language
of the largest cosine.

The bundle of a document is counts times vectors: run counts of a slice of documents form a
matrix, so the sums are one matrix product. Prototypes are summed in two steps, by (language, group of
tasks) and by language.

Null texts, and texts without a letter, get ``und`` and score 0, as do all texts if there is nothing to learn from.
Equal cosines: the first language in alphabetical order. Repeated rows give repeated rows; an empty table gives an
empty result; a null id stays null and counts as the empty text for the folds. Other input columns are ignored.
"""

from __future__ import annotations

from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import fold_of, text_parts

UNKNOWN = "und"
SPACE_LETTER = 32
TOP = 0x110000
GROUPS = 64
#: Texts and different runs in a matrix of counts: 32 MB.
TEXTS, WIDTH = 1024, 4096


@lru_cache(1)
def letters() -> np.ndarray:
    """For each code point its lower-case letter, or the space for anything else."""
    table = np.full(TOP, SPACE_LETTER, np.int32)
    for c in range(TOP):
        x = chr(c)
        if x.isalpha():
            low = x.lower()
            table[c] = ord(low) if len(low) == 1 else c
    return table


@lru_cache(100_000)
def letter_vector(code: int, dims: int) -> np.ndarray:
    return np.random.default_rng([7, code]).integers(0, 2, dims, dtype=np.int8) * np.int8(2) - np.int8(1)


def run_vectors(runs: bytes, dims: int) -> np.ndarray:
    """Bound vectors of runs given as rows of three code points."""
    codes = np.frombuffer(runs, np.int32).reshape(-1, 3)
    known, at = np.unique(codes, return_inverse=True)
    table = np.stack([letter_vector(int(c), dims) for c in known])
    at = at.reshape(codes.shape)
    return (np.roll(table, 2, axis=1)[at[:, 0]] * np.roll(table, 1, axis=1)[at[:, 1]] * table[at[:, 2]]).astype(np.float32)


def runs_of(text: str) -> np.ndarray:
    """Code points of the letters of a text, one space for each gap and at both ends; empty without letters."""
    codes = letters()[np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.int32)]
    inside = codes != SPACE_LETTER
    if not inside.any():
        return codes[:0]
    keep = inside.copy()
    keep[1:] |= inside[:-1]
    gap = np.int32([SPACE_LETTER])
    out = np.concatenate([gap, codes[keep]])
    return out if out[-1] == SPACE_LETTER else np.concatenate([out, gap])


def bundles(texts: list[str], dims: int) -> np.ndarray:
    """A row per text: the sum of the vectors of its runs of three letters."""
    parts = [runs_of(t) for t in texts]
    out = np.zeros((len(texts), dims), np.float32)
    if not sum(map(len, parts)):
        return out
    codes = np.concatenate(parts)
    seen = np.zeros(TOP, bool)
    seen[codes] = True
    alphabet = np.flatnonzero(seen).astype(np.int32)
    index = np.zeros(TOP, np.int64)
    index[alphabet] = np.arange(len(alphabet))
    at, size = index[codes], len(alphabet)
    run = (at[:-2] * size + at[1:-1]) * size + at[2:]
    row = np.repeat(np.arange(len(texts)), [len(p) for p in parts])
    run, row = run[row[:-2] == row[2:]], row[:-2][row[:-2] == row[2:]]
    if size**3 <= 1 << 18:
        found = np.flatnonzero(np.bincount(run, minlength=size**3))
        dense = np.zeros(size**3, np.int64)
        dense[found] = np.arange(len(found))
        column = dense[run]
    else:
        found, column = np.unique(run, return_inverse=True)
    for low in range(0, len(found), WIDTH):  # bounds the count matrix when there are very many different runs
        ids = found[low : low + WIDTH]
        here = (column >= low) & (column < low + len(ids))
        counts = np.bincount(row[here] * len(ids) + column[here] - low, minlength=len(texts) * len(ids)).reshape(len(texts), -1)
        codes3 = np.stack([alphabet[ids // size**2], alphabet[ids // size % size], alphabet[ids % size]], axis=1)
        out += counts.astype(np.float32) @ run_vectors(codes3.tobytes(), dims)
    return out


def small_parts(batches, text: str, size: int):
    """Lists of at most ``TEXTS`` texts of about ``size`` bytes with their rows of the batch; null texts are empty."""
    for part, _, _ in text_parts(batches, text, size):
        for first in range(0, len(part), TEXTS):
            rows = part.slice(first, TEXTS)
            yield rows, [t or "" for t in rows.column(text).to_pylist()]


def unit(rows: np.ndarray) -> np.ndarray:
    length = np.linalg.norm(rows, axis=1, keepdims=True)
    return np.divide(rows, length, out=np.zeros_like(rows), where=length > 0)


def learn_prototypes(labelled: DataFrame, dims: int = 1024) -> dict[str, np.ndarray]:
    """A prototype for each value of ``lang``, from all rows with text and lang."""

    def bundle(batches):
        sums: dict[str, np.ndarray] = {}
        for part, texts in small_parts(batches, "text", 1 << 20):
            rows, langs = unit(bundles(texts, dims)), np.array(part.column("lang").to_pylist(), object)
            for lang in set(langs):
                sums[lang] = sums.get(lang, 0) + rows[langs == lang].sum(axis=0, dtype=np.float64)
        group = TaskContext.get().partitionId() % GROUPS
        if sums:
            yield pa.RecordBatch.from_pandas(pd.DataFrame({"lang": list(sums), "grp": group, "bundle": [s.tolist() for s in sums.values()]}), preserve_index=False)

    parts = labelled.filter(F.col("text").isNotNull() & F.col("lang").isNotNull()).select("text", "lang").mapInArrow(bundle, "lang string, grp long, bundle array<double>")
    parts = parts.withColumn("bundle", array_to_vector("bundle"))
    for keys in (["lang", "grp"], ["lang"]):
        parts = parts.groupBy(*keys).agg(Summarizer.sum(F.col("bundle")).alias("bundle"))
    rows = parts.select("lang", vector_to_array("bundle").alias("bundle")).orderBy("lang").collect()  # a row per language
    return {r["lang"]: np.array(r["bundle"]) for r in rows}


def identify(docs: DataFrame, prototypes: dict[str, np.ndarray], dims: int = 1024) -> DataFrame:
    """doc_id, the language with the largest cosine and that cosine (0 at least) for each row."""
    names = sorted(prototypes)
    table = unit(np.array([prototypes[x] for x in names]).reshape(len(names), dims)) if names else np.zeros((0, dims))
    if len(names) > 1:  # what all languages share says nothing
        table = unit(table - table.mean(axis=0))
    table = table.astype(np.float32)

    def run(batches):
        for part, texts in small_parts(batches, "text", 1 << 20):
            rows = unit(bundles(texts, dims))
            cosine = rows @ table.T if names else np.zeros((len(texts), 1), np.float32)
            best = cosine.argmax(axis=1)
            known = rows.any(axis=1) & bool(names)
            score = np.where(known, np.clip(cosine[np.arange(len(texts)), best], 0, 1), 0).astype(np.float64)
            found = [names[b] if k else UNKNOWN for b, k in zip(best, known)]
            yield pa.RecordBatch.from_arrays([part.column("doc_id"), pa.array(found, pa.string()), pa.array(score)], names=["doc_id", "lang_pred", "score"])

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(run, "doc_id long, lang_pred string, score double")


def identify_held_out(docs: DataFrame, dims: int = 1024, folds: int = 4, held: int = 2) -> DataFrame:
    """Learn from the documents outside the held-out fold, identify all."""
    known = learn_prototypes(docs.filter(fold_of("doc_id", folds) != held), dims)
    found = identify(docs, known, dims)
    return found.select("doc_id", (fold_of("doc_id", folds) == held).alias("held_out"), "lang_pred", "score")
