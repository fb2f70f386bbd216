"""Near duplicates by MinHash.

1. Each document becomes a set of word shingles, held as 64-bit hashes. Documents with the same set form a class
   (128-bit key); everything after works on classes, so copies cost nothing.
2. ``bands * rows`` universal hash minima per set; each band of ``rows`` minima is a bucket. Two sets of similarity s
   share a bucket with probability 1 - (1 - s^rows)^bands: 0.999997 at s = 0.8 for 32 bands of 5.
3. In a bucket nobody meets everybody: members meet a few pivots (the smallest in as many orders). Pairs with
   too different sizes go; the share of equal minima must be within four standard deviations of the threshold;
   what is left is confirmed on the full sets, rebuilt from the texts. One pair per class goes first, and the others
   only if their ends are not in one component by then.
4. A link need not touch a pivot. Wherever a bucket of three or more still has members of several components, each
   member outside the first pivot's component is compared with the members of other components, in blocks of
   bounded size, by signature and then on the full sets. Of the buckets that two members share (all 64 bits of them), only the first compares them, and a block
   returns no more links than it takes to join its components. So no link inside a bucket is lost and no list of pairs is made.
5. Components by alternating large-star and small-star; the smallest doc_id of a component names it.

Texts without words have no shingles and are alone. Repeated rows are members of the same class. A null doc_id can link others but
never names a component unless all its members have none. An empty table gives an empty result. Other columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, StructField, StructType

from .common import fresh, mix, sparing, stored, text_parts, windows, word_hashes
from .components import components

BANDS, ROWS = 32, 5
_rng = np.random.default_rng(97)
FACTORS = _rng.integers(1, 1 << 63, BANDS * ROWS, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
SHIFTS = _rng.integers(1, 1 << 63, BANDS * ROWS, dtype=np.uint64)
PIVOTS = 3
MAP_BITS = 26
SLICE = 1 << 18  # bytes of text worked on at a time
BLOCK, CHUNK = 200_000, 2_000_000  # shingles on either side of a block


def shingle_sets(data: np.ndarray, offsets: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingle hashes of texts laid end to end, sorted within each text, and where each text's begin.

    A text with fewer words than ``size`` has its whole sequence as its only shingle.
    """
    hashes, first, _, _ = word_hashes(data, offsets)
    rows = len(offsets) - 1
    words = np.diff(first)
    row = np.repeat(np.arange(rows), words)
    runs = windows(hashes, size)
    keep = row[: len(runs)] == row[size - 1 :][: len(runs)] if len(runs) else np.zeros(0, bool)
    runs, owner = runs[keep], row[: len(keep)][keep]
    short = np.flatnonzero((words > 0) & (words < size))
    if len(short):
        whole = np.array([windows(hashes[first[i] : first[i + 1]], int(words[i]))[0] for i in short], np.uint64)
        runs, owner = np.concatenate([runs, whole]), np.concatenate([owner, short])
    order = np.lexsort((runs, owner))
    runs, owner = runs[order], owner[order]
    new = np.ones(len(runs), bool)
    new[1:] = (runs[1:] != runs[:-1]) | (owner[1:] != owner[:-1])
    return runs[new], np.searchsorted(owner[new], np.arange(rows + 1))


def set_keys(runs: np.ndarray, bounds: np.ndarray) -> list[bytes | None]:
    """128 bits that name each set; none for the empty set."""
    parts = []
    for salt in (np.uint64(0x5851F42D4C957F2D), np.uint64(0x14057B7EF767814F)):
        total = np.concatenate([np.zeros(1, np.uint64), np.cumsum(mix(runs ^ salt), dtype=np.uint64)])
        parts.append(total[bounds[1:]] - total[bounds[:-1]])
    joined = np.stack(parts, axis=1).astype("<u8")
    return [joined[i].tobytes() if n else None for i, n in enumerate(np.diff(bounds))]


def minima(runs: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """A row of hash minima for each set; sets must not be empty."""
    out = np.empty((len(bounds) - 1, len(FACTORS)), np.uint64)
    buffer = np.empty_like(runs)
    for k, (factor, shift) in enumerate(zip(FACTORS, SHIFTS)):
        np.multiply(runs, factor, out=buffer)
        buffer += shift
        out[:, k] = np.minimum.reduceat(buffer, bounds[:-1])
    return out


def signatures(low: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """16 bits of each minimum, and a hash for each band."""
    band = np.zeros((len(low), BANDS), np.uint64)
    for r in range(ROWS):
        band = mix(band * np.uint64(0x9E3779B97F4A7C15) + low[:, r::ROWS])
    return (low >> np.uint64(48)).astype("<u2"), mix(band + np.arange(BANDS, dtype=np.uint64)).view(np.int64)


def digest(docs: DataFrame, size: int) -> DataFrame:
    """doc_id, n_shingles, key of the set, signature, band hashes; the last three null for empty sets."""

    def run(batches):
        for part, data, offsets in text_parts(batches, "text", SLICE):
            runs, bounds = shingle_sets(data, offsets, size)
            sizes = np.diff(bounds)
            full = np.flatnonzero(sizes)
            sig: list = [None] * len(sizes)
            bands: list = [None] * len(sizes)
            if len(full):
                short, band = signatures(minima(runs, np.append(bounds[full], len(runs))))
                for k, i in enumerate(full):
                    sig[i], bands[i] = short[k].tobytes(), band[k]
            yield pa.RecordBatch.from_arrays(
                [part.column("doc_id"), pa.array(sizes.astype(np.int64)), pa.array(set_keys(runs, bounds), pa.binary()), pa.array(sig, pa.binary()), pa.array(bands, pa.list_(pa.int64()))],
                names=["doc_id", "n_shingles", "key", "sig", "bands"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(sparing(run), "doc_id long, n_shingles long, key binary, sig binary, bands array<long>")


def _similar_sizes(a: str, b: str, percent: int):
    return 100 * F.least(a, b) >= percent * F.greatest(a, b)


def _least_equal(percent: int) -> int:
    """Equal minima that a pair at the threshold has, less four standard deviations."""
    s, n = percent / 100, len(FACTORS)
    return int(np.floor(n * s - 4 * np.sqrt(n * s * (1 - s))))


def _by_signature(pairs: DataFrame, classes: DataFrame, percent: int) -> DataFrame:
    """Pairs (a, b) whose signatures agree well enough."""
    least = _least_equal(percent)
    sig = classes.select(F.col("cid"), F.col("sig"))
    rows = pairs.select("a", "b").join(sig.withColumnsRenamed({"cid": "b", "sig": "sig_b"}), "b").join(sig.withColumnsRenamed({"cid": "a", "sig": "sig_a"}), "a")

    def run(batches):
        for batch in batches:
            if batch.num_rows:
                x, y = (np.frombuffer(b"".join(batch.column(c).to_pylist()), "<u2").reshape(batch.num_rows, -1) for c in ("sig_a", "sig_b"))
                yield batch.select(["a", "b"]).filter(pa.array((x == y).sum(axis=1) >= least))

    return rows.select("a", "b", "sig_a", "sig_b").mapInArrow(sparing(run), "a long, b long")


def _bitmap(ids: DataFrame) -> np.ndarray:
    """A map of 2^26 bits of the hashes of doc_id: at most 2^20 numbers, whatever the number of ids."""
    place = F.pmod(F.xxhash64("doc_id"), F.lit(1 << MAP_BITS))
    words = ids.select(F.shiftright(place, 6).alias("w"), F.expr(f"shiftleft(1L, cast(pmod(xxhash64(doc_id), {1 << MAP_BITS}) & 63 as int))").alias("bit"))
    rows = words.groupBy("w").agg(F.bit_or("bit").alias("bits")).toArrow()
    out = np.zeros(1 << (MAP_BITS - 6), np.int64)
    out[rows["w"].to_numpy()] = rows["bits"].to_numpy()
    return out


def _texts_of(docs: DataFrame, wanted: DataFrame, size: int) -> DataFrame:
    """(cid, text) of the wanted classes. A bounded bit map keeps most other texts out of the shuffle; the join decides."""
    bits = _bitmap(wanted)

    def run(batches):
        for batch in batches:
            place = batch.column("place").to_numpy()
            batch = batch.filter(pa.array((bits[place >> 6] >> (place & 63)) & 1 == 1))
            for part, data, offsets in text_parts([batch.select(["doc_id", "text"])], "text", SLICE):
                keys = set_keys(*shingle_sets(data, offsets, size))
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), pa.array(keys, pa.binary()), part.column("text")], names=["doc_id", "key", "text"])

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", F.pmod(F.xxhash64(F.col("doc_id").cast("long")), F.lit(1 << MAP_BITS)).alias("place"))
    rows = rows.mapInArrow(sparing(run), "doc_id long, key binary, text string").withColumnRenamed("doc_id", "d")
    found = rows.join(wanted, ["key"]).filter(F.col("d").eqNullSafe(F.col("doc_id")))
    return found.groupBy("key").agg(F.first("cid").alias("cid"), F.first("text").alias("text")).select("cid", "text")


def _confirm(pairs: DataFrame, texts: DataFrame, size: int, percent: int) -> DataFrame:
    """The pairs (a, b) whose full sets are similar enough. ``b`` gets its text first, so a hot ``a`` is never copied into a shuffle."""
    rows = pairs.join(texts.withColumnsRenamed({"cid": "b", "text": "text_b"}), "b").join(texts.withColumnsRenamed({"cid": "a", "text": "text_a"}), "a")

    def run(batches):
        for batch in batches:
            for low in range(0, batch.num_rows, 256):
                part = batch.slice(low, 256)
                good = []
                for x, y in zip(_text_sets(part.column("text_a"), size), _text_sets(part.column("text_b"), size)):
                    both = len(np.intersect1d(x, y, assume_unique=True))
                    good.append(100 * both >= percent * (len(x) + len(y) - both))
                yield part.select(["a", "b"]).filter(pa.array(good, pa.bool_()))

    return rows.select("a", "b", "text_a", "text_b").mapInArrow(sparing(run), "a long, b long")


def _rooted(df: DataFrame, roots: DataFrame, node: str, root: str) -> DataFrame:
    """Add the root of ``node``: itself if it has no link."""
    return df.join(roots.select(F.col("node").alias(node), F.col("root").alias("_found")), node, "left").withColumn(root, F.coalesce("_found", node)).drop("_found")


def _text_sets(texts: pa.Array, size: int) -> list[np.ndarray]:
    out = []
    for _, data, offsets in text_parts([pa.RecordBatch.from_arrays([texts], names=["text"])], "text", SLICE):
        runs, bounds = shingle_sets(data, offsets, size)
        out += [runs[bounds[i] : bounds[i + 1]] for i in range(len(bounds) - 1)]
    return out


def _across(members: DataFrame, classes: DataFrame, texts: DataFrame, roots: DataFrame, size: int, percent: int) -> DataFrame:
    """Links (a, b) within buckets between members of different components; enough to join what is linked."""
    least = _least_equal(percent)
    rows = stored(_rooted(members, roots, "cid", "root"), "rooted")
    groups = rows.groupBy("bucket").agg(F.count(F.lit(1)).alias("n"), F.sum("n_shingles").alias("weight"), F.min("root").alias("lo"), F.max("root").alias("hi"), F.min_by("root", "cid").alias("first"))
    groups = groups.filter((F.col("n") >= 3) & (F.col("lo") != F.col("hi"))).select("bucket", "weight", "first")
    rows = stored(rows.join(stored(groups, "groups"), "bucket"), "mixed")
    is_minor = F.col("root") != F.col("first")
    counts = stored(rows.filter(is_minor).groupBy("bucket").agg(F.sum("n_shingles").alias("minor_weight")), "minor")
    rows = rows.join(counts, "bucket").join(classes.select("cid", "sig", "bands"), "cid").join(texts, "cid")
    blocks, chunks = F.ceil(F.col("minor_weight") / BLOCK).cast("int"), F.ceil(F.col("weight") / CHUNK).cast("int")
    spread = F.xxhash64("cid", F.lit(1))
    rest = ["band", "cid", "root", "n_shingles", "sig", "bands", "text"]
    as_minor = rows.filter(is_minor).select("bucket", F.pmod(spread, blocks).cast("int").alias("block"), F.explode(F.sequence(F.lit(0), chunks - 1)).alias("chunk"), F.lit(True).alias("minor"), *rest)
    as_other = rows.select("bucket", F.explode(F.sequence(F.lit(0), blocks - 1)).alias("block"), F.pmod(spread, chunks).cast("int").alias("chunk"), F.lit(False).alias("minor"), *rest)

    def compare(df: pd.DataFrame) -> pd.DataFrame:
        minor = df["minor"].to_numpy()
        ids, root, n, band = (df[c].to_numpy() for c in ("cid", "root", "n_shingles", "band"))
        sig = np.frombuffer(b"".join(df["sig"]), "<u2").reshape(len(df), -1)
        bands = np.stack(df["bands"].to_list())
        sets = _text_sets(pa.array(df["text"], pa.large_string()), size)
        joined = {r: r for r in root.tolist()}

        def top(r: int) -> int:
            while joined[r] != r:
                joined[r] = r = joined[joined[r]]
            return r

        others = np.flatnonzero(~minor)
        found = []
        for i in np.flatnonzero(minor):
            near = others[(root[others] != root[i]) & (100 * np.minimum(n[others], n[i]) >= percent * np.maximum(n[others], n[i]))]
            near = near[(sig[near] == sig[i]).sum(axis=1) >= least]
            near = near[(bands[near] == bands[i]).argmax(axis=1) == band[i]]  # else another bucket compares them
            for j in near:
                a, b = top(int(root[i])), top(int(root[j]))
                if a != b:
                    both = len(np.intersect1d(sets[i], sets[j], assume_unique=True))
                    if 100 * both >= percent * (len(sets[i]) + len(sets[j]) - both):
                        joined[max(a, b)] = min(a, b)
                        found.append((ids[i], ids[j]))
        return pd.DataFrame(found, columns=["a", "b"], dtype="int64")

    return as_minor.union(as_other).groupBy("bucket", "block", "chunk").applyInPandas(compare, "a long, b long")


def _open(pairs: DataFrame, roots: DataFrame) -> DataFrame:
    """The pairs whose ends are not in one component yet."""
    return _rooted(_rooted(pairs, roots, "a", "ra"), roots, "b", "rb").filter(F.col("ra") != F.col("rb")).select("a", "b")


def _groups(docs: DataFrame, size: int, percent: int) -> tuple[DataFrame, DataFrame]:
    """The digest, and the root of each class with its key and smallest doc_id."""
    marks = stored(digest(docs, size), "digest")
    classes = marks.filter(F.col("key").isNotNull()).groupBy("key").agg(
        F.min("doc_id").alias("doc_id"), F.first("n_shingles").alias("n_shingles"), F.first("sig").alias("sig"), F.first("bands").alias("bands"))
    classes = stored(classes.withColumn("cid", F.monotonically_increasing_id()), "classes")

    every = classes.select("cid", "n_shingles", F.posexplode("bands").alias("band", "bucket"))
    orders = [F.col("cid"), *[F.xxhash64("cid", F.lit(k)) for k in range(1, PIVOTS)]]
    pivots = every.groupBy("bucket").agg(F.count(F.lit(1)).alias("n"), *[F.min_by(c, o).alias(f"{c}{k}") for k, o in enumerate(orders) for c in ("cid", "n_shingles")])
    pivots = pivots.filter(F.col("n") > 1).select("bucket", F.array(*[F.struct(F.col(f"cid{k}").alias("cid"), F.col(f"n_shingles{k}").alias("n_shingles")) for k in range(PIVOTS)]).alias("pivots"))
    members = stored(every.join(stored(pivots, "pivots"), "bucket"), "members")
    pairs = members.select("cid", "n_shingles", F.explode(F.array_distinct("pivots")).alias("p")).filter((F.col("p.cid") != F.col("cid")) & _similar_sizes("p.n_shingles", "n_shingles", percent))
    pairs = pairs.select(F.least("cid", "p.cid").alias("a"), F.greatest("cid", "p.cid").alias("b")).distinct()
    pairs = stored(_by_signature(pairs, classes, percent), "pairs")

    wanted = classes.join(members.select("cid").distinct(), "cid").select("cid", "key", "doc_id")
    texts = stored(_texts_of(docs, stored(wanted, "wanted"), size), "texts")
    once = stored(pairs.groupBy("b").agg(F.min("a").alias("a")).select("a", "b"), "first-pairs")
    links = stored(_confirm(once, texts, size, percent), "links")
    roots = components(links)
    rest = _open(pairs.join(once, ["a", "b"], "left_anti"), roots)
    links = links.union(stored(_confirm(rest, texts, size, percent), "links"))
    roots = components(links)
    late = stored(_across(members.select("bucket", "band", "cid", "n_shingles"), classes, texts, roots, size, percent), "late-links")
    if late.first() is not None:
        roots = components(links.union(late))

    return marks, stored(_rooted(classes.select("cid", "key", "doc_id"), roots, "cid", "root"), "named")


def near_duplicates(docs: DataFrame, size: int = 5, percent: int = 80) -> DataFrame:
    """doc_id, n_shingles, component_id, kept for each row; similarity is ``percent`` per cent at least."""
    marks, named = _groups(docs, size, percent)
    lowest = stored(named.groupBy("root").agg(F.min("doc_id").alias("component_id")), "lowest")
    names = stored(named.join(lowest, "root").select("key", "component_id"), "names")
    out = marks.select("doc_id", "n_shingles", "key").join(names, "key", "left")
    component = F.when(F.col("key").isNull(), F.col("doc_id")).otherwise(F.col("component_id"))
    return out.select("doc_id", "n_shingles", component.alias("component_id"), F.col("doc_id").eqNullSafe(component).alias("kept"))


def _with_key(docs: DataFrame, key: str, size: int) -> DataFrame:
    """``docs`` with the key of each text's set in the column ``key``."""
    place = docs.columns.index("text")

    def run(batches):
        for batch in batches:
            texts = pa.RecordBatch.from_arrays([batch.column(place)], names=["text"])
            keys = [k for _, data, offsets in text_parts([texts], "text", SLICE) for k in set_keys(*shingle_sets(data, offsets, size))]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(keys, pa.binary())], names=[*batch.schema.names, key])

    return docs.mapInArrow(sparing(run), StructType([*docs.schema.fields, StructField(key, BinaryType())]))


def keep_one(docs: DataFrame, size: int = 5, percent: int = 80) -> DataFrame:
    """One document of each group, with all its columns: one with the smallest id, of several the one with the smallest set key.

    A group may have no id at all; one of it stays, too. Texts without words are alone: each id of theirs stays once, and each row without an id.
    """
    marks, named = _groups(docs, size, percent)
    chosen = named.groupBy("root").agg(F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "key")).alias("c")).select("c.doc_id", "c.key")
    chosen = stored(chosen.union(marks.filter(F.col("key").isNull()).select("doc_id", "key").distinct()), "kept")
    number, own, key, chosen_id, chosen_key = (fresh(docs, c) for c in ("_number", "_id", "_key", "_chosen_id", "_chosen_key"))
    rows = _with_key(docs, key, size).withColumn(own, F.col("doc_id").cast("long"))
    chosen = chosen.select(F.col("doc_id").alias(chosen_id), F.col("key").alias(chosen_key))
    rows = rows.join(chosen, F.col(own).eqNullSafe(F.col(chosen_id)) & F.col(key).eqNullSafe(F.col(chosen_key)), "left_semi")
    alone = F.when(F.col(own).isNull() & F.col(key).isNull(), F.monotonically_increasing_id())
    rows = rows.withColumn(number, alone)  # null but for rows that nothing tells apart
    first = F.row_number().over(Window.partitionBy(own, key, number).orderBy(own))
    return rows.withColumn(number, first).filter(F.col(number) == 1).select(*[F.col(f"`{c}`") for c in docs.columns])
