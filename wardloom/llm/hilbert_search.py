"""Nearest neighbours by inner product along shifted Hilbert curves.

Vectors get one more component that makes all candidates equally long, which turns the largest
inner product into the smallest distance. Each of several curves projects the vectors to a few
random directions, shifts them, and orders them by their place on a Hilbert curve. Spark range-partitions every curve, blocks of
consecutive candidates are cut from it, and a query meets the block it falls into and as many next
to it on either side as ``REACH``. The best of each block are merged over blocks and curves.

Equal vectors are one candidate with its smallest ids, as many as a result can hold, so a vector
that makes up a third of the table is searched once. Every vector is indexed; nothing is fitted but
the largest norm.

Defined results: vectors that are NULL, all zero, of another length than the first vector by id, or hold NULL or
non-finite components take no part, nor do rows without an id; repeated ids count once per
vector; fewer candidates than asked for are all returned; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from wardloom.llm.common import table
from wardloom.operators.numbering import running_offsets
from wardloom.session import materialize

NEAREST = 20
CURVES = 10
DIRECTIONS = 6
BITS = 10
BLOCK = 4096  # consecutive candidates of one curve
REACH = 1  # blocks searched on either side of a query's own
SEED = 3


def hilbert_keys(cells: np.ndarray, bits: int) -> np.ndarray:
    """Place on the Hilbert curve of each row of ``cells``, whose values have ``bits`` bits.

    Skilling's transform: Gray-code corrections from the highest bit down, then the bits of all
    axes are interleaved.
    """
    x = cells.astype(np.int64).T.copy()
    n = len(x)
    q = 1 << (bits - 1)
    while q > 1:
        p = q - 1
        for i in range(n):
            high = (x[i] & q) != 0
            swap = np.where(high, 0, (x[0] ^ x[i]) & p)
            x[0] = np.where(high, x[0] ^ p, x[0] ^ swap)
            if i:
                x[i] ^= swap
        q >>= 1
    for i in range(1, n):
        x[i] ^= x[i - 1]
    t = np.zeros_like(x[0])
    q = 1 << (bits - 1)
    while q > 1:
        t = np.where((x[n - 1] & q) != 0, t ^ (q - 1), t)
        q >>= 1
    x ^= t
    out = np.zeros_like(x[0])
    for bit in range(bits - 1, -1, -1):
        for i in range(n):
            out = (out << 1) | ((x[i] >> bit) & 1)
    return out


def curve_keys(vectors: np.ndarray, curve: int, directions: int = DIRECTIONS, bits: int = BITS) -> np.ndarray:
    """Keys of vectors of at most unit length on one shifted curve."""
    rng = np.random.default_rng([SEED, curve, vectors.shape[1]])
    basis, _ = np.linalg.qr(rng.standard_normal((vectors.shape[1], min(directions, vectors.shape[1]))))
    spread = 3.0 / np.sqrt(vectors.shape[1])  # three deviations of a coordinate of a random unit vector
    place = (vectors @ basis) / spread / 2 + 0.5 + rng.uniform(-0.15, 0.15, basis.shape[1])
    return hilbert_keys(np.clip(place * (1 << bits), 0, (1 << bits) - 1).astype(np.int64), bits)


def _matrix(column: pa.Array | pd.Series) -> np.ndarray:
    values = column.to_pylist() if isinstance(column, pa.Array | pa.ChunkedArray) else list(column)
    return np.array(values, np.float64).reshape(len(values), -1)


def valid(vector: Column, width: int) -> Column:
    """Whether a vector takes part."""
    finite = F.forall(vector, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf")))
    return F.coalesce((F.size(vector) == width) & finite & F.exists(vector, lambda v: v != 0), F.lit(False))


def distinct_vectors(rows: DataFrame, keep: int) -> DataFrame:
    """``(vec, rep, ids)``: each distinct vector with its smallest id and its ``keep`` smallest ids."""
    ids = rows.select("vec_id", "vec").distinct()
    nth = F.row_number().over(Window.partitionBy("vec").orderBy("vec_id"))
    few = ids.withColumn("nth", nth).filter(F.col("nth") <= keep)
    return few.groupBy("vec").agg(F.min("vec_id").alias("rep"), F.sort_array(F.collect_list("vec_id")).alias("ids"))


def best_of_block(queries: pd.DataFrame, block: pd.DataFrame, nearest: int) -> pd.DataFrame:
    """The candidates of one block nearest to each query, by exact inner product."""
    a, b = _matrix(queries["vec"]), _matrix(block["vec"])
    reps = block["rep"].to_numpy()
    out = []
    for low in range(0, len(a), 512):
        scores = a[low : low + 512] @ b.T
        k = min(nearest, scores.shape[1])
        # all that tie with the k-th are kept, so that ties can go to the smaller id
        least = -np.partition(-scores, k - 1, axis=1)[:, k - 1]
        q, c = np.nonzero(scores >= (least - 1e-9 * np.abs(least))[:, None])
        out.append(pd.DataFrame({"query": queries["rep"].to_numpy()[low + q], "rep": reps[c], "near": scores[q, c]}))
    return pd.concat(out, ignore_index=True)


def nearest_neighbours(vectors: DataFrame, is_query: Column, nearest: int = NEAREST, curves: int = CURVES, block: int = BLOCK, reach: int = REACH) -> DataFrame:
    """``(query_id, rank, vec_id, score)`` of ``vectors (vec_id, embedding)``; queries are the rows where ``is_query`` holds."""
    spark = vectors.sparkSession
    first = vectors.filter("embedding is not null and vec_id is not null and size(embedding) > 0").orderBy("vec_id").select(F.size("embedding")).first()
    width = first[0] if first else 1
    rows = vectors.filter("vec_id is not null").select("vec_id", F.col("embedding").cast("array<double>").alias("vec"), F.coalesce(is_query, F.lit(False)).alias("is_query"))
    rows = materialize(rows.filter(valid(F.col("vec"), width)), "vectors")
    distinct = distinct_vectors(rows, nearest + 1)
    asked = rows.filter("is_query").select("vec", F.col("vec_id").alias("query_id")).distinct()
    distinct = distinct.join(asked.select("vec").distinct().withColumn("asked", F.lit(True)), "vec", "left")
    norm = F.sqrt(F.aggregate("vec", F.lit(0.0), lambda s, v: s + v * v))
    distinct = materialize(distinct.select("rep", "ids", "vec", F.col("asked").isNotNull().alias("asked"), norm.alias("norm")), "distinct-vectors")
    largest = distinct.agg(F.max("norm")).first()[0] or 1.0

    def keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            vec, norms = _matrix(batch.column("vec")), batch.column("norm").to_numpy()
            filled = np.hstack([vec / largest, np.sqrt(np.maximum(0, 1 - (norms / largest) ** 2))[:, None]]) if len(vec) else np.zeros((0, width + 1))
            level = np.hstack([vec / norms[:, None], np.zeros((len(vec), 1))]) if len(vec) else np.zeros((0, width + 1))
            asked_ = batch.column("asked").to_numpy(zero_copy_only=False)
            for curve in range(curves):
                for points, mask, kind in ((filled, np.ones(len(vec), bool), 1), (level, asked_, 0)):
                    at = pa.array(np.flatnonzero(mask))
                    yield pa.RecordBatch.from_arrays(
                        [batch.column("rep").take(at), pa.array(np.full(len(at), curve, np.int32)), pa.array(curve_keys(points[mask], curve)), pa.array(np.full(len(at), kind, np.int64))],
                        names=["rep", "curve", "key", "candidate"],
                    )

    placed = distinct.select("rep", "vec", "norm", "asked").mapInArrow(keys, "rep long, curve int, key long, candidate long")
    # One order over all curves: a block is a run of candidates of one curve.
    ordered = running_offsets(placed, ["curve", "key", "rep", "candidate"], "candidate", "before")
    size = distinct.count()
    last = max(0, (size - 1) // block)
    number = F.least(F.floor((F.col("before") - F.col("curve") * size) / block), F.lit(last)).cast("int")
    ordered = ordered.select("rep", "curve", "candidate", number.alias("block"))
    # A query goes to the blocks around its own, a candidate to its own only.
    spread = F.when(F.col("candidate") == 1, F.array("block")).otherwise(F.sequence(F.greatest(F.col("block") - reach, F.lit(0)), F.least(F.col("block") + reach, F.lit(last))))
    dealt = ordered.select("rep", "curve", "candidate", F.explode(spread).alias("block")).join(distinct.select("rep", "vec"), "rep")

    def search(rows_: pd.DataFrame) -> pd.DataFrame:
        candidates, queries = rows_[rows_["candidate"] == 1], rows_[rows_["candidate"] == 0]
        if not len(queries) or not len(candidates):
            return pd.DataFrame({"query": pd.Series(dtype="int64"), "rep": pd.Series(dtype="int64"), "near": pd.Series(dtype="float64")})
        return best_of_block(queries, candidates, nearest + 1)

    found = dealt.groupBy("curve", "block").applyInPandas(search, "query long, rep long, near double")
    found = materialize(found.groupBy("query", "rep").agg(F.max("near").alias("near")), "found")

    # A result holds at most `nearest` rows besides the query itself, so that many vectors are enough.
    best = found.withColumn("place", F.rank().over(Window.partitionBy("query").orderBy(F.desc(F.round("near", 9))))).filter(F.col("place") <= nearest + 1)
    named = distinct.select("rep", "ids", "vec")
    pairs = best.join(named, "rep").join(named.select(F.col("rep").alias("query"), F.col("vec").alias("query_vec")), "query")

    @F.pandas_udf("double")
    def exact(a: pd.Series, b: pd.Series) -> pd.Series:
        return pd.Series(np.einsum("ij,ij->i", _matrix(a), _matrix(b)) if len(a) else [], dtype="float64")

    scored = pairs.select("query_vec", "ids", exact("query_vec", "vec").alias("score"))
    listed = scored.join(asked.withColumnRenamed("vec", "query_vec"), "query_vec").select("query_id", "score", F.explode("ids").alias("vec_id"))
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    ranked = listed.filter("vec_id <> query_id").withColumn("rank", rank).filter(F.col("rank") <= nearest)
    return ranked.select("query_id", "rank", "vec_id", "score")


def hilbert_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Contract query: the nearest of all vectors to every twentieth."""
    vectors = table(spark, sf_dir, "embeddings").select("vec_id", "embedding")
    return nearest_neighbours(vectors, F.col("vec_id") % 20 == 0)
