"""Mixing sources to target weights.

Each source's words, in order of document id, are cut into blocks of fixed length. Every output
shard draws how many of its slots each source fills: multinomial counts, drawn without replacement
from the slots that the targets leave each source, so that the shards together hit the targets.
The slots of a source, counted over all shards, run through a pseudorandom permutation of its
block numbers, a new one for each pass over the source; slots and blocks meet in a join on
(source, block), whose keys are unique, so no source is a hot key.

Defined results: NULL texts have size 0 and supply nothing; the NULL source is a source of its own
and comes last; a source without words gets no slot; repeated rows are texts of their own; an
empty table gives an empty mix.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from wardloom.llm.common import SPACE, table, words
from wardloom.operators.numbering import running_offsets
from wardloom.session import broadcast_if_small, materialize

AFTER_SPACE = r"(?<=[\x20\x09-\x0D])(?=[^\x20\x09-\x0D])"
BLOCK_WORDS = 256
SHARDS = 32
MAX_SOURCES = 100_000  # one row per source reaches the driver
SLOTS_PER_ROW = 20_000  # slots handled together by one task
WEIGHTS = (3.0, 1.0, 2.0)
VOLUME = 1.5
MAX_PASSES = 2.0
SEED = 20


def capped_targets(sizes: list[int], weights: list[float], volume: float = VOLUME, passes: float = MAX_PASSES) -> list[float]:
    """Shares of ``volume`` times all sizes by weight; what exceeds ``passes`` times a source's size is shared anew."""
    total, target = volume * sum(sizes), [0.0] * len(sizes)
    open_ = {i for i, s in enumerate(sizes) if s > 0}
    while open_:
        rest = total - sum(passes * sizes[i] for i in range(len(sizes)) if i not in open_)
        unit = rest / sum(weights[i] for i in open_)
        above = {i for i in open_ if unit * weights[i] > passes * sizes[i]}
        if not above:
            for i in open_:
                target[i] = unit * weights[i]
            break
        open_ -= above
    return [target[i] if i in open_ else passes * sizes[i] for i in range(len(sizes))]


@dataclass(frozen=True)
class Source:
    number: int
    name: str | None
    size: int
    target: float
    blocks: int
    slots: int


def plan_sources(sized: DataFrame, block_words: int, weights: tuple[float, ...], volume: float, passes: float) -> list[Source]:
    """Sources by code point, NULL last, with targets and the slots that come nearest to them."""
    rows = sized.groupBy("source").agg(F.sum("size").alias("size")).limit(MAX_SOURCES + 1).collect()
    if len(rows) > MAX_SOURCES:
        raise ValueError(f"more than {MAX_SOURCES} sources")
    rows.sort(key=lambda r: (r["source"] is None, (r["source"] or "").encode()))
    sizes = [r["size"] for r in rows]
    targets = capped_targets(sizes, [weights[i % len(weights)] for i in range(len(rows))], volume, passes)
    out = []
    for i, (r, target) in enumerate(zip(rows, targets, strict=True)):
        blocks = -(-r["size"] // block_words)
        mean = r["size"] / blocks if blocks else 1.0  # the last block may be short
        out.append(Source(i, r["source"], r["size"], target, blocks, min(round(target / mean), int(passes) * blocks)))
    return out


def draw_counts(sources: list[Source], shards: int, seed: int) -> list[tuple[int, int, int, int, int]]:
    """``(source number, shard, first slot of the source, slots, first slot in the shard)``."""
    rng = np.random.default_rng(seed)
    left = np.array([s.slots for s in sources], np.int64)
    drawn, out = np.zeros(len(sources), np.int64), []
    for shard in range(shards):
        total = int(left.sum())
        size = total // (shards - shard)
        if total >= 10**9:
            # numpy draws without replacement below this only; here both draws agree to a hair
            counts = np.minimum(rng.multinomial(size, left / total), left) if shard < shards - 1 else left.copy()
        else:
            counts = rng.multivariate_hypergeometric(left, size, method="marginals") if size else np.zeros_like(left)
        begin = 0
        for i in np.flatnonzero(counts):
            out.append((int(i), shard, int(drawn[i]), int(counts[i]), begin))
            begin += int(counts[i])
        drawn += counts
        left -= counts
    return out


def permuted(index: np.ndarray, n: np.ndarray, key: np.ndarray) -> np.ndarray:
    """Images of ``index`` under pseudorandom permutations of 0 .. n-1, one per ``key``.

    A four-round Feistel network on the next even number of bits; images outside the range are put
    through it again until they fall inside.
    """
    half = np.maximum(1, (np.ceil(np.log2(np.maximum(n, 2).astype(np.float64))).astype(np.int64) + 1) // 2).astype(np.uint64)
    mask = (np.uint64(1) << half) - np.uint64(1)
    out, todo = index.astype(np.uint64), np.arange(len(index))
    limit = n.astype(np.uint64)
    while len(todo):
        h, m = half[todo], mask[todo]
        left, right = out[todo] >> h, out[todo] & m
        for step in range(4):
            x = right + key[todo] + np.uint64((step * 0x9E3779B97F4A7C15) % 2**64)
            x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
            x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
            left, right = right, left ^ ((x ^ (x >> np.uint64(31))) & m)
        out[todo] = (left << h) | right
        todo = todo[out[todo] >= limit[todo]]
    return out.astype(np.int64)


def slots_of(spark: SparkSession, sources: list[Source], shards: int, seed: int) -> DataFrame:
    """``(source_no, block, shard, slot, pass)``: which block of its source fills each slot of each shard."""
    draws = draw_counts(sources, shards, seed)
    counts = spark.createDataFrame(
        [(i, shard, first, n, begin, sources[i].blocks) for i, shard, first, n, begin in draws],
        "source_no int, shard int, first long, n long, begin long, blocks long",
    )
    step = F.lit(SLOTS_PER_ROW).cast("long")
    pieces = counts.withColumn("at", F.explode(F.sequence(F.lit(0).cast("long"), F.col("n") - 1, step)))
    pieces = pieces.select("source_no", "shard", "blocks", (F.col("first") + F.col("at")).alias("first"), (F.col("begin") + F.col("at")).alias("begin"), F.least(F.col("n") - F.col("at"), step).alias("n"))
    width = int(spark.conf.get("spark.sql.shuffle.partitions"))
    pieces = pieces.repartition(width, "source_no", "shard", "first")

    def spread(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for r in batch.to_pylist():
                ordinal = np.arange(r["first"], r["first"] + r["n"])
                round_, index = np.divmod(ordinal, r["blocks"])
                with np.errstate(over="ignore"):
                    key = (round_.astype(np.uint64) + np.uint64(r["source_no"] * 1_000_003 + seed)) * np.uint64(0xD1B54A32D192ED03)
                block = permuted(index, np.full(r["n"], r["blocks"]), key)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(r["n"], r["source_no"], np.int32)), pa.array(block), pa.array(np.full(r["n"], r["shard"], np.int32)), pa.array(np.arange(r["begin"], r["begin"] + r["n"])), pa.array(round_.astype(np.int32))],
                    names=["source_no", "block", "shard", "slot", "pass"],
                )

    return pieces.mapInArrow(spread, "source_no int, block long, shard int, slot long, pass int")


@dataclass(frozen=True)
class Mix:
    """What was drawn.

    ``placed`` has every text with its size, the number of its source and, if it has words, ``start``: the
    words of its source before it. ``slots`` says which block of its source fills each slot of each shard.
    """

    docs: DataFrame
    placed: DataFrame
    slots: DataFrame
    sources: list[Source]
    block_words: int

    def spans(self) -> DataFrame:
        """``(row, source_no, start, block, begin, words)``: the words each text lends to each block of its source."""
        size, start, width = F.col("size"), F.col("start"), F.lit(self.block_words).cast("long")
        blocks = F.explode(F.sequence(F.floor(start / width), F.floor((start + size - 1) / width))).alias("block")
        cut = self.placed.filter("size > 0").select("row", "source_no", "size", "start", blocks)
        begin = F.greatest(F.col("block") * width - start, F.lit(0))
        return cut.select("row", "source_no", "start", "block", begin.alias("begin"), (F.least((F.col("block") + 1) * width - start, size) - begin).alias("words"))

    def taken(self) -> DataFrame:
        """``(source_no, start, taken)``: words the mix takes of each text, by the text's place in its source."""
        drawn = self.slots.groupBy("source_no", "block").agg(F.count(F.lit(1)).alias("times"))
        return self.spans().join(drawn, ["source_no", "block"]).groupBy("source_no", "start").agg(F.sum(F.col("words") * F.col("times")).alias("taken"))

    def shards(self) -> DataFrame:
        """``(shard, slot, source_no, pieces, text)``: the mixed blocks, each the joined words of its pieces."""
        lent = self.spans().groupBy("row").agg(F.collect_list(F.struct("source_no", "block", "start", "begin", "words")).alias("runs"))
        cut = _cut_once(F.col("text"), lambda tokens: F.transform("runs", lambda r: r.withField("piece", _words_from(tokens, r["begin"], r["words"]))))
        spans = lent.join(_texts(self.docs), "row").select("row", F.inline(cut))
        blocks = spans.groupBy("source_no", "block").agg(F.sort_array(F.collect_list(F.struct("start", "row", "begin", "words", "piece"))).alias("pieces"))
        filled = self.slots.join(blocks, ["source_no", "block"])
        return filled.select("shard", "slot", "source_no", F.transform("pieces", lambda p: p.dropFields("piece", "start")).alias("pieces"), F.array_join(F.transform("pieces", lambda p: p["piece"]), " ").alias("text"))

    def documents(self) -> DataFrame:
        """The mix as documents: for each text and pass over its source, what the mix takes of it in that pass.

        Whole texts stay as they are; of others the words taken are joined in their order. Columns
        are those of the input; ``n_chars``, where there is one, counts the new text.
        """
        names = self.docs.columns
        runs = self.spans().join(self.slots.select("source_no", "block", "pass"), ["source_no", "block"])
        runs = runs.groupBy("row", "source_no", "start", "pass").agg(F.sum("words").alias("words"), F.sort_array(F.collect_list(F.struct("begin", "words"))).alias("runs"))
        runs = runs.join(self.placed.filter("size > 0").select("source_no", "start", "size"), ["source_no", "start"])
        runs = runs.select("row", (F.col("words") == F.col("size")).alias("whole"), "runs")
        part = _cut_once(F.col("_mix_doc.text"), lambda tokens: F.array_join(F.transform("runs", lambda r: _words_from(tokens, r["begin"], r["words"])), ""))
        text = F.when(F.col("whole"), F.col("_mix_doc.text")).otherwise(part)
        joined = _texts(self.docs, whole=True).join(runs, "row").withColumn("_mix_text", text)
        made = {"text": F.col("_mix_text")} | ({"n_chars": F.length("_mix_text").cast("long")} if "n_chars" in names else {})
        return joined.select(*[made.get(c, F.col(f"_mix_doc.`{c}`")).alias(c) for c in names])


def _cut_once(text: Column, use: Callable[[Column], Column]) -> Column:
    """``use`` of the words of ``text``, each with the white space that follows it; however often they are used, the text is cut once."""
    tokens = F.split(F.regexp_replace(text, "^" + SPACE, ""), AFTER_SPACE)
    return F.transform(F.array(tokens), use)[0]


def _words_from(tokens: Column, begin: Column, n: Column) -> Column:
    """``n`` words from number ``begin`` on, with the white space that follows each."""
    return F.array_join(F.slice(tokens, (begin + 1).cast("int"), n.cast("int")), "")


def row_key(docs: DataFrame) -> Column:
    """What tells rows apart; rows equal in every column share it."""
    # The hash passes over NULLs, so each column says whether it is one.
    return F.xxhash64(*[part for c in docs.columns for part in (F.col(f"`{c}`").isNull(), F.col(f"`{c}`"))])


def _texts(docs: DataFrame, whole: bool = False) -> DataFrame:
    """One row for each key: equal rows have their text once, and places of their own in the mix."""
    kept = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_mix_doc") if whole else F.col("text")
    return docs.filter("text is not null").select(row_key(docs).alias("row"), kept).dropDuplicates(["row"])


def mix_sources(
    docs: DataFrame,
    block_words: int = BLOCK_WORDS,
    shards: int = SHARDS,
    weights: tuple[float, ...] = WEIGHTS,
    volume: float = VOLUME,
    passes: float = MAX_PASSES,
    seed: int = SEED,
) -> Mix:
    """Plan and draw the mix of ``docs``, which has ``doc_id``, ``text`` and ``source`` besides any other columns."""
    spark = docs.sparkSession
    sized = docs.select(F.col("source").alias("source"), F.col("doc_id").alias("doc_id"), row_key(docs).alias("row"), F.size(words(F.col("text"))).cast("long").alias("size"))
    sized = materialize(sized, "sizes")
    sources = plan_sources(sized, block_words, weights, volume, passes)
    ends = np.cumsum([0, *(s.size for s in sources)]).tolist()
    facts = spark.createDataFrame([(s.number, s.name, ends[s.number]) for s in sources], "source_no int, name string, base long")
    numbered = sized.join(broadcast_if_small(facts), sized["source"].eqNullSafe(facts["name"])).select("source_no", "doc_id", "row", "size", "base")
    placed = running_offsets(numbered, ["source_no", "doc_id", "row"], "size", "before")
    placed = placed.select("source_no", "doc_id", "row", "size", F.when(F.col("size") > 0, F.col("before") - F.col("base")).alias("start"))
    slots = materialize(slots_of(spark, sources, shards, seed), "slots")
    return Mix(docs, placed, slots, sources, block_words)


def source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Contract query: size, source size, target and words taken of every document."""
    mix = mix_sources(table(spark, sf_dir, "documents").select("doc_id", "text", "source"))
    facts = spark.createDataFrame([(s.number, s.size, s.target) for s in mix.sources], "source_no int, source_size long, target double")
    return (
        mix.placed.join(mix.taken(), ["source_no", "start"], "left")
        .join(broadcast_if_small(facts), "source_no")
        .select("doc_id", "size", "source_size", "target", F.coalesce("taken", F.lit(0)).cast("long").alias("taken"))
    )
