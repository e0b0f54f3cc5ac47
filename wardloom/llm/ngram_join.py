"""N-gram Jaccard join: near-duplicate documents by MinHash banding and exact verification.

Documents with equal n-gram sets become one class and are compared once. The number of bands and
rows follows from the similarity and the recall asked for. Band hashes meet in Spark; a bucket
names only its smallest class, so a bucket of n classes gives n edges and not n squared pairs.
Classes joined by such edges form candidate groups, and within a group the full n-gram sets are
compared in blocks of bounded size: a group of any size is dealt to as many tasks as it has pairs
of blocks, each of which returns one row per class with the links it found.

Defined results: the n-grams of a text of fewer words than n are its whole word sequence; NULL and
wordless texts have none, are linked to nothing and are their own class; rows without an id are
left out of the comparison and keep a NULL class; repeated rows count as copies; other columns of
the input are not looked at.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wardloom.llm.common import connected_components, table
from wardloom.session import broadcast_if_small, materialize

NGRAM = 5
SIMILARITY = 0.8
RECALL = 0.99999  # of pairs exactly at the similarity; pairs above it are found more surely
MAX_HASHES = 128
CACHED_WORDS = 1_000_000
CHUNK_SHINGLES = 1 << 14  # n-grams hashed together, so that they stay in a core's cache
BLOCK_SHINGLES = 300_000  # n-grams and
BLOCK_CLASSES = 1_500  # classes expected at most in one block of a candidate group

_GOLD = np.uint64(0x9E3779B97F4A7C15)


def bands_and_rows(similarity: float, recall: float, max_hashes: int = MAX_HASHES) -> tuple[int, int]:
    """The most selective (bands, rows) that reach ``recall`` at ``similarity`` within ``max_hashes``."""
    for rows in range(16, 0, -1):
        missed = 1 - similarity**rows
        bands = 1 if missed <= 1 - recall else math.ceil(math.log(1 - recall) / math.log(missed))
        if bands * rows <= max_hashes:
            return bands, rows
    return max_hashes, 1


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class _Hashes(dict):
    def __missing__(self, word: bytes) -> int:
        out = self[word] = xxhash.xxh64_intdigest(word)
        return out


class Shingler:
    """Sorted distinct 64-bit n-gram hashes of texts."""

    def __init__(self, n: int):
        self.n, self._hashes = n, _Hashes()

    def shingles(self, text: bytes | None) -> np.ndarray:
        found = text.split() if text else []
        if not found:
            return np.zeros(0, np.uint64)
        if len(self._hashes) > CACHED_WORDS:
            self._hashes = _Hashes()
        h = np.fromiter(map(self._hashes.__getitem__, found), np.uint64, len(found))
        width = min(self.n, len(h))
        out = np.full(len(h) - width + 1, np.uint64(width))
        for k in range(width):
            out = _mix((out ^ h[k : len(h) - width + 1 + k]) * _GOLD)
        return np.unique(out)


def _signatures(bands: int, rows: int) -> np.ndarray:
    rng = np.random.default_rng(7)
    return rng.integers(1, 2**63, size=bands * rows, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def _band_hashes(sets: list[np.ndarray], factors: np.ndarray, rows: int) -> np.ndarray:
    """The band hashes of each of some non-empty sets, a row a set; sets are taken together, CHUNK_SHINGLES at a time."""
    out = np.zeros((len(sets), len(factors) // rows), np.uint64)
    ends = np.cumsum([len(s) for s in sets])
    begin = 0
    while begin < len(sets):
        before = int(ends[begin - 1]) if begin else 0
        end = max(begin + 1, int(np.searchsorted(ends, before + CHUNK_SHINGLES, "right")))
        x = np.concatenate(sets[begin:end])
        starts = np.append(0, ends[begin : end - 1] - before)
        lows = np.empty((len(factors), end - begin), np.uint64)
        mixed, high = np.empty_like(x), np.empty_like(x)
        for k, factor in enumerate(factors):
            np.multiply(x, factor, out=mixed)
            np.right_shift(mixed, np.uint64(32), out=high)
            np.bitwise_xor(mixed, high, out=mixed)
            np.minimum.reduceat(mixed, starts, out=lows[k])
        bands = np.zeros((len(factors) // rows, end - begin), np.uint64)
        for k in range(rows):
            bands = _mix((bands ^ lows[k::rows]) * _GOLD)
        out[begin:end] = bands.T
        begin = end
    return out


def _as_long(x: np.ndarray) -> np.ndarray:
    return x.astype("<u8").view(np.int64)


def signatures(docs: DataFrame, n: int, similarity: float, recall: float) -> DataFrame:
    """``(doc, set_hash, shingles, bands)`` of every row that has an id."""
    bands, rows = bands_and_rows(similarity, recall)
    factors = _signatures(bands, rows)

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingler = Shingler(n)
        for batch in batches:
            set_hash, count, found, held, hashed = [], [], [], 0, [np.zeros((0, bands), np.uint64)]
            for text in batch.column(1).to_pylist():
                s = shingler.shingles(text)
                set_hash.append(xxhash.xxh3_128_digest(s.tobytes()) if len(s) else None)
                count.append(len(s))
                if len(s):
                    found.append(s)
                    held += len(s)
                if held > 16 * CHUNK_SHINGLES:
                    hashed.append(_band_hashes(found, factors, rows))
                    found, held = [], 0
            hashed.append(_band_hashes(found, factors, rows))
            ends = np.cumsum([0, *(bands * (n > 0) for n in count)])
            lists = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(_as_long(np.concatenate(hashed).ravel())))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(set_hash, pa.binary()), pa.array(count, pa.int64()), lists], names=["doc", "set_hash", "shingles", "bands"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    source = docs.filter("doc_id is not null").select(F.col("doc_id").alias("doc"), F.col("text").cast("binary").alias("text"))
    return source.mapInArrow(sign, f"doc {kind}, set_hash binary, shingles long, bands array<long>")


def compare_block(block: pd.DataFrame, similarity: float) -> pd.DataFrame:
    """Links between the classes of one pair of blocks: ``(rep, links, root)``.

    ``links`` counts the documents of other classes at or above ``similarity``; ``root`` is the smallest
    class reached through links of this block. Pairs within one side count only where both sides
    are the same block, so that every pair of a group is counted once.
    """
    block = block.sort_values("rep", ignore_index=True)
    sets, side, copies = list(block["set"]), block["side"].to_numpy(), block["copies"].to_numpy()
    m = len(block)
    sizes = np.array([len(s) for s in sets])
    owner = np.repeat(np.arange(m), sizes)
    _, token, seen = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    token_seen = seen[token]
    owner, token = owner[token_seen > 1], token[token_seen > 1]
    shared = np.zeros((m, m), np.float32)
    # Tokens are taken in slices, so that the indicator matrix stays small.
    order = np.argsort(token, kind="stable")
    owner, token = owner[order], token[order]
    _, token = np.unique(token, return_inverse=True)
    width = max(1, 8_000_000 // max(1, m))
    for low in range(0, int(token[-1]) + 1 if len(token) else 0, width):
        a, b = np.searchsorted(token, [low, low + width])
        indicator = np.zeros((m, width), np.float32)
        indicator[owner[a:b], token[a:b] - low] = 1
        shared += indicator @ indicator.T
    union = sizes[:, None] + sizes[None, :] - shared
    linked = shared >= similarity * union - 1e-9 * union
    np.fill_diagonal(linked, False)
    if block["low"].iloc[0] != block["high"].iloc[0]:
        linked &= side[:, None] != side[None, :]
    links = linked @ copies.astype(np.float64)
    root = np.arange(m)
    while True:  # smallest reachable member, by repeated minimum over neighbours
        lower = np.minimum(root, np.where(linked, root[None, :], m).min(axis=1, initial=m))
        lower = lower[lower]
        if (lower == root).all():
            break
        root = lower
    reps = block["rep"].to_numpy()
    return pd.DataFrame({"rep": reps, "links": links.astype(np.int64), "root": reps[root]})


def near_duplicates(docs: DataFrame, n: int = NGRAM, similarity: float = SIMILARITY, recall: float = RECALL) -> DataFrame:
    """``(doc_id, class_id, copy_class, n_links)`` for every row of ``docs (doc_id, text)``.

    ``copy_class`` is the smallest id with the same n-grams, ``class_id`` the smallest id reachable through
    links, ``n_links`` the number of other documents at or above ``similarity``.
    """
    signed = materialize(signatures(docs, n, similarity, recall), "signatures")
    classes = materialize(
        signed.filter("set_hash is not null").groupBy("set_hash").agg(F.min("doc").alias("rep"), F.count(F.lit(1)).alias("copies"), F.first("shingles").alias("shingles"), F.first("bands").alias("bands")),
        "classes",
    )
    bucketed = classes.select("rep", F.posexplode("bands").alias("band", "hash"))
    leaders = bucketed.groupBy("band", "hash").agg(F.min("rep").alias("leader"), F.count(F.lit(1)).alias("n")).filter("n > 1").drop("n")
    edges = bucketed.join(leaders, ["band", "hash"]).filter("rep <> leader").select(F.col("rep").alias("a"), F.col("leader").alias("b")).distinct()
    groups = connected_components(edges)

    members = groups.withColumnRenamed("node", "rep").join(classes.select("rep", "set_hash", "copies", "shingles"), "rep")
    members = materialize(members, "members")
    blocks = members.groupBy("component").agg(F.ceil(F.greatest(F.sum("shingles") / BLOCK_SHINGLES, F.count(F.lit(1)) / BLOCK_CLASSES)).cast("int").alias("blocks"))
    members = members.join(blocks, "component").withColumn("block", F.pmod(F.xxhash64("rep"), F.col("blocks")).cast("int"))

    texts = docs.filter("doc_id is not null").select(F.col("doc_id").alias("rep"), F.col("text").cast("binary").alias("text"))
    texts = texts.join(broadcast_if_small(members), "rep")
    kind = docs.schema["doc_id"].dataType.simpleString()

    def to_sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingler = Shingler(n)
        for batch in batches:
            rows, values = [], []
            for i, (text, wanted) in enumerate(zip(batch.column("text").to_pylist(), batch.column("set_hash").to_pylist(), strict=True)):
                s = shingler.shingles(text)
                if xxhash.xxh3_128_digest(s.tobytes()) == wanted:  # another row may repeat the id with another text
                    rows.append(i)
                    values.append(_as_long(s))
            ends = np.cumsum([0, *map(len, values)])
            sets = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(np.concatenate([np.zeros(0, np.int64), *values])))
            part = batch.take(pa.array(rows, pa.int64()))
            yield pa.RecordBatch.from_arrays([part.column(c) for c in ("rep", "component", "copies", "blocks", "block")] + [sets], names=["rep", "component", "copies", "blocks", "block", "set"])

    sets = texts.select("text", "set_hash", "rep", "component", "copies", "blocks", "block").mapInArrow(
        to_sets, f"rep {kind}, component {kind}, copies long, blocks int, block int, set array<long>"
    )
    # Member of block b meets every block: as the left of (b, other) for other >= b, else as the right of (other, b).
    other = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))
    dealt = sets.select("*", other.alias("other")).select(
        "rep", "component", "copies", "set", F.least("block", "other").alias("low"), F.greatest("block", "other").alias("high"), (F.col("block") > F.col("other")).cast("int").alias("side")
    )

    def compare(block: pd.DataFrame) -> pd.DataFrame:
        return compare_block(block.drop_duplicates("rep"), similarity)

    found = materialize(dealt.groupBy("component", "low", "high").applyInPandas(compare, f"rep {kind}, links long, root {kind}"), "links")
    links = found.groupBy("rep").agg(F.sum("links").alias("links"))
    joined = connected_components(found.filter("rep <> root").select(F.col("rep").alias("a"), F.col("root").alias("b")))
    by_class = classes.select("rep", "set_hash", "copies").join(links, "rep", "left").join(joined.withColumnRenamed("node", "rep"), "rep", "left")
    by_class = by_class.select(
        "set_hash",
        F.coalesce("component", "rep").alias("class_id"),
        F.col("rep").alias("copy_class"),
        (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"),
    )
    alone = signed.filter("set_hash is null").select(F.col("doc").alias("doc_id"), F.col("doc").alias("class_id"), F.col("doc").alias("copy_class"), F.lit(0).cast("long").alias("n_links"))
    linked = signed.filter("set_hash is not null").select("doc", "set_hash").join(by_class, "set_hash").select(F.col("doc").alias("doc_id"), "class_id", "copy_class", "n_links")
    nameless = docs.filter("doc_id is null").select("doc_id", F.col("doc_id").alias("class_id"), F.col("doc_id").alias("copy_class"), F.lit(0).cast("long").alias("n_links"))
    return linked.unionByName(alone).unionByName(nameless)


def keep_one_of_each(docs: DataFrame, similarity: float = SIMILARITY) -> DataFrame:
    """``docs`` without near-duplicates: of each class the row with the smallest id stays.

    Rows repeated under that id become one; rows without an id all stay.
    """
    gone = near_duplicates(docs.select("doc_id", "text"), similarity=similarity).filter("doc_id <> class_id").select("doc_id").distinct()
    gone = materialize(gone, "near-duplicates")
    return docs.join(broadcast_if_small(gone), "doc_id", "left_anti").select(*[F.col(f"`{c}`") for c in docs.columns])


def ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Contract query: class and number of links of every document."""
    return near_duplicates(table(spark, sf_dir, "documents").select("doc_id", "text"))
