"""Token counts of whole texts, with huge texts encoded in overlapping chunks.

A text longer than ``chunk`` characters is encoded piece by piece. Each chunk starts inside the
one before. The two encodings are spliced at a common stable boundary: an ASCII white space
character in the overlap which no token of either encoding covers, with the same tokens around
it on both sides. The tokeniser never joins characters across such a place, so the tokens
left of it come from the earlier chunk and those right of it from the later one. If the overlap
has no such place it is doubled, and at last the chunk itself grows until it reaches the end of the text.

Shorter texts are counted by their pieces between ASCII white space, which are encoded by the same
library; counts of pieces seen before are kept, up to a bound, and pieces of any length are whole.

Null or empty texts have no tokens. Repeated rows give repeated rows, an empty table an empty
result; null ids stay null. Other input columns are ignored.
"""

from __future__ import annotations

import os
import re
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

COUNTED = "doc_id long, n_bytes long, n_tokens long, over_limit boolean"
INNER_SPACE = re.compile(r"\S[ \t\n\r](?=\S)")
KEPT, LONGEST_KEPT = 1_000_000, 48


@lru_cache(4)
def tokenizer(path: str):
    os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
    from tokenizers import Tokenizer

    found = Tokenizer.from_file(path)
    found.no_truncation()
    found.no_padding()
    return found


class Chunk:
    """The encoding of text[start:end], asked by positions in the whole text."""

    def __init__(self, path: str, text: str, start: int, end: int):
        self.start, self.end = start, min(end, len(text))
        self.encoding = tokenizer(path).encode(text[start : self.end], add_special_tokens=False)
        self.size = len(self.encoding)

    def first_after(self, place: int, around: int) -> tuple[int, tuple] | None:
        """Number of the token that begins right after the character at ``place``, and the ids and spans around it.

        None if some token covers that character or no token begins or ends beside it.
        """
        k = self.encoding.char_to_token(place + 1 - self.start)
        if k is None or k < around or k + around > self.size or self.encoding.char_to_token(place - self.start) is not None:
            return None
        spans = [tuple(x + self.start for x in self.encoding.token_to_chars(j)) for j in range(k - around, k + around)]
        if spans[around][0] != place + 1 or spans[around - 1][1] != place:
            return None
        return k, tuple(zip(spans, (self.encoding.ids[k - around : k + around])))


def common_boundary(text: str, left: Chunk, right: Chunk, low: int, around: int = 2) -> tuple[int, int, int] | None:
    """A stable boundary in [low, left.end) with the number of the token after it in either chunk; those amid the overlap first."""
    middle = (low + left.end) // 2
    for place in sorted((m.start() + 1 for m in INNER_SPACE.finditer(text, low, left.end)), key=lambda p: abs(p - middle)):
        a, b = left.first_after(place, around), right.first_after(place, around)
        if a and b and a[1] == b[1]:
            return place, a[0], b[0]
    return None


def count_spliced(text: str, path: str, chunk: int, overlap: int) -> int:
    """Number of tokens of a text of any length, from overlapping chunks."""
    total, skip, cut = 0, 0, 0  # skip: tokens of the chunk that lie before the last cut
    held = Chunk(path, text, 0, chunk)
    while held.end < len(text):
        width, found = overlap, None
        while found is None and width < held.end - held.start:
            right = Chunk(path, text, held.end - width, held.end - width + max(chunk, 2 * width))
            found = common_boundary(text, held, right, max(held.end - width, cut))
            width *= 2
        if found is None:  # no such place in the whole chunk: take a longer one, in the end all the rest
            held = Chunk(path, text, held.start, held.start + 2 * (held.end - held.start))
            continue
        cut = found[0]
        total += found[1] - skip
        held, skip = right, found[2]
    return total + held.size - skip


class PieceCounts:
    """Tokens per piece between ASCII white space."""

    def __init__(self, path: str):
        self.path, self.known = path, {}

    def count(self, texts: list[bytes]) -> list[int]:
        split = [t.split() for t in texts]
        new = list(set().union(*split) - self.known.keys())
        if len(self.known) + len(new) > KEPT:
            self.known = {}
            new = list(set().union(*split))
        got = tokenizer(self.path).encode_batch_fast([w.decode() for w in new], add_special_tokens=False)
        self.known.update(zip(new, map(len, got)))
        out = [sum(map(self.known.__getitem__, words)) for words in split]
        for w in new:
            if len(w) > LONGEST_KEPT:
                del self.known[w]
        return out


def count_tokens(docs: DataFrame, path: str, limit: int = 2048, chunk: int = 65_536, overlap: int = 512) -> DataFrame:
    """Bytes and tokens of each whole text, and whether it has more than ``limit`` tokens."""

    def run(batches):
        pieces = PieceCounts(path)
        for batch in batches:
            texts = [t or "" for t in batch.column(1).to_pylist()]
            raw = [t.encode() for t in texts]
            counts = [0] * len(texts)
            short, weight = [], 0
            for i, t in enumerate(texts):
                if len(t) > chunk:
                    counts[i] = count_spliced(t, path, chunk, overlap)
                    continue
                short.append(i)
                weight += len(raw[i])
                if weight > 4 << 20 or i == len(texts) - 1:
                    for j, n in zip(short, pieces.count([raw[j] for j in short])):
                        counts[j] = n
                    short, weight = [], 0
            for j, n in zip(short, pieces.count([raw[j] for j in short]) if short else []):
                counts[j] = n
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array([len(r) for r in raw], pa.int64()), pa.array(counts, pa.int64()), pa.array([n > limit for n in counts], pa.bool_())],
                names=["doc_id", "n_bytes", "n_tokens", "over_limit"])

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(run, COUNTED)
