"""Filter interaction audit: what each filter removes, alone, in every order, and on average over all orders.

Whether a document falls to a set of filters depends only on which filters it fails, so the documents
are counted by the 32 patterns of failures. From these counts a removal game follows: the value of a coalition of
filters is the number of documents that fail at least one of them. Steps of an order are differences of
coalition values. Shapley values come from Hart and Mas-Colell's potential,
``P(S) = (v(S) + sum of P(S without i)) / |S|``, computed coalition by coalition: a filter's Shapley value is the
potential of all filters minus the potential without it. Potentials are kept times 120, which makes them
whole numbers, and 120 Shapley values are the sum over the 120 orders.
"""

from __future__ import annotations

import hashlib
import json
import re
from collections.abc import Iterator
from itertools import permutations
from math import factorial

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from wardloom.llm.common import table
from wardloom.session import broadcast_if_small

FILTERS = "ABCDE"  # a filter's bit is its place here
COALITIONS = 1 << len(FILTERS)
ORDERS = factorial(len(FILTERS))
MIN_WORDS = 200
SYMBOLS = re.compile(rb"[#$%&*|]")
NOT_CAPITALS = bytes(c for c in range(256) if not 65 <= c <= 90)
REPEATED = COALITIONS >> 1  # the bit of E, which depends on the other texts
COUNTS = ("n", "good", "toxic")


def _bits(coalition: int) -> list[int]:
    return [i for i in range(len(FILTERS)) if coalition >> i & 1]


def text_failures(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """``(doc_id, part, text)`` to ``(doc_id, part, digest, mask)``: the filters A to D that a text fails, and its SHA-256."""
    for batch in batches:
        digests, masks = [], []
        for text in batch.column(2):
            raw = text.as_buffer().to_pybytes()
            words = raw.split()  # at space and \t to \r
            code_points = len(raw.decode("utf-8", "replace"))
            capitals = len(raw.translate(None, NOT_CAPITALS))
            failed = (
                len(words) < MIN_WORDS,
                100 * len(set(words)) < 50 * len(words),
                100 * capitals > 3 * code_points,
                SYMBOLS.search(raw) is not None,
            )
            digests.append(hashlib.sha256(raw).digest())
            masks.append(sum(1 << i for i, f in enumerate(failed) if f))
        columns = [batch.column(0), batch.column(1), pa.array(digests, pa.binary()), pa.array(masks, pa.int32())]
        yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "part", "digest", "mask"])


def failure_patterns(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``(part, mask, n, good, toxic)``: documents ``(doc_id, part, text)`` by part and pattern of failures.

    Only ids, digests and masks are shuffled. Copies of a text are counted before they meet: what is grouped by digest
    has one row per part, label and task, however many copies a text has.
    """
    schema = f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, part string, digest binary, mask int"

    def counted(some: DataFrame) -> DataFrame:
        return some.select("doc_id", "part", "text").mapInArrow(text_failures, schema).groupBy("doc_id", "part", "digest", "mask").agg(F.count(F.lit(1)).alias("n"))

    flags = labels.filter("doc_id is not null").groupBy("doc_id").agg(
        F.coalesce(F.max(F.col("quality") == 1), F.lit(False)).alias("good"), F.coalesce(F.max(F.col("toxic") == 1), F.lit(False)).alias("toxic")
    )
    # Rows without an id have no label, and are kept out of the join, where they would meet in one task.
    labelled = (
        counted(docs.filter("doc_id is not null"))
        .join(broadcast_if_small(flags), "doc_id", "left")
        .unionByName(counted(docs.filter("doc_id is null")).withColumns({"good": F.lit(False), "toxic": F.lit(False)}))
    )
    same = labelled.groupBy("digest", "part", "mask", F.coalesce("good", F.lit(False)).alias("good"), F.coalesce("toxic", F.lit(False)).alias("toxic")).agg(
        F.sum("n").alias("n"), F.min(F.when(F.col("doc_id").isNotNull(), F.struct("doc_id", "n"))).alias("first"), F.sum(F.when(F.col("doc_id").isNull(), F.col("n")).otherwise(0)).alias("no_id")
    )
    smallest = F.min("first.doc_id").over(Window.partitionBy("digest"))
    # Rows of the smallest id do not fail E, nor do rows without id.
    once = same.withColumn("once", F.col("no_id") + F.when(F.col("first.doc_id") == smallest, F.col("first.n")).otherwise(0))
    patterns = once.select(
        "part", "good", "toxic",
        F.inline(F.array(
            F.struct("mask", F.col("once").alias("n")),
            F.struct(F.col("mask").bitwiseOR(F.lit(REPEATED)).alias("mask"), (F.col("n") - F.col("once")).alias("n")),
        )),
    )
    flagged = lambda c: F.sum(F.when(F.col(c), F.col("n")).otherwise(0)).alias(c)
    return patterns.groupBy("part", "mask").agg(F.sum("n").alias("n"), flagged("good"), flagged("toxic"))


def removal_game(patterns: DataFrame) -> DataFrame:
    """One row per part: for each count an array of 32 coalition values, the documents that fail each filter and only it,
    and the array of potentials (times 120)."""
    of = lambda name, holds: F.sum(F.when(holds, F.col(name)).otherwise(0))
    meets = lambda s: F.col("mask").bitwiseAND(F.lit(s)) != 0
    sums = [F.array(*[of(name, meets(s)) for s in range(COALITIONS)]).alias(name) for name in COUNTS]
    alone = F.array(*[of("n", F.col("mask") == 1 << i) for i in range(len(FILTERS))]).alias("alone")
    game = patterns.groupBy("part").agg(F.sum("n").alias("all"), *sums, alone)
    game = game.withColumn("p0", F.lit(0).cast("long"))
    for size in range(1, len(FILTERS) + 1):
        game = game.withColumns({f"p{s}": _potential(s) for s in range(COALITIONS) if len(_bits(s)) == size})
    return game.select("part", "all", *COUNTS, "alone", F.array(*[f"p{s}" for s in range(COALITIONS)]).alias("potential"))


def _potential(coalition: int) -> Column:
    members = _bits(coalition)
    total = ORDERS * F.col("n")[coalition]
    for i in members:
        total = total + F.col(f"p{coalition & ~(1 << i)}")
    return F.call_function("div", total, F.lit(len(members)).cast("long"))


def all_steps() -> Column:
    """Array of ``(filter_order, step, filter, own, before, after)``: the 600 steps of the 120 orders; the last three are coalitions."""
    steps = []
    for order in permutations(FILTERS):
        before = 0
        for step, letter in enumerate(order, 1):
            i = FILTERS.index(letter)
            steps.append({"filter_order": "".join(order), "step": step, "filter": i, "own": 1 << i, "before": before, "after": before | 1 << i})
            before |= 1 << i
    return F.from_json(F.lit(json.dumps(steps)), "array<struct<filter_order string, step int, filter int, own int, before int, after int>>")


def audit(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """One row per part, order of filters and step, for documents ``(doc_id, part, text)`` without null parts and texts."""
    game = removal_game(failure_patterns(docs, labels))
    every = game.select("*", F.inline(all_steps()))
    at = lambda name, place: F.get(name, F.col(place))
    lost = lambda name: at(name, "after") - at(name, "before")
    shapley = F.get("potential", F.lit(COALITIONS - 1)) - F.get("potential", F.lit(COALITIONS - 1) - F.col("own"))
    return every.select(
        "part", "filter_order", "step",
        (F.col("all") - at("n", "after")).alias("kept"),
        lost("n").alias("removed"),
        (at("n", "own") - lost("n")).alias("redundant"),
        at("alone", "filter").alias("unique_fails"),
        lost("good").alias("good_lost"),
        lost("toxic").alias("toxic_lost"),
        shapley.alias("shapley"),
    )


def filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Contract query: five filters on all ``documents``, by language.

    NULL text is an empty text, NULL lang an empty string; texts of any length are read whole. A row fails E if a
    smaller id has the same text: repeated rows of one id do not fail by each other, and rows without id neither
    fail E nor make others fail it. Of several labels of an id, one that says 1 counts; labels without id count for
    nothing. An empty table gives no rows. Other columns are not read.
    """
    docs = table(spark, sf_dir, "documents")
    docs = docs.select("doc_id", F.coalesce("lang", F.lit("")).alias("part"), F.coalesce("text", F.lit("")).alias("text"))
    return audit(docs, table(spark, sf_dir, "labels").select("doc_id", "quality", "toxic"))


ORACLE = r"""
WITH docs AS (SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS text FROM documents),
words AS (SELECT *, regexp_extract_all(text, '[^\x20\x09-\x0D]+') AS w FROM docs),
flags AS (SELECT doc_id, max(CASE WHEN quality = 1 THEN 1 ELSE 0 END) AS good, max(CASE WHEN toxic = 1 THEN 1 ELSE 0 END) AS toxic FROM labels GROUP BY doc_id),
failing AS (
  SELECT part, coalesce(good, 0) AS good, coalesce(f.toxic, 0) AS toxic, {
    'A': len(w) < 200,
    'B': 100 * len(list_distinct(w)) < 50 * len(w),
    'C': 100 * length(regexp_replace(text, '[^A-Z]', '', 'g')) > 3 * length(text),
    'D': regexp_matches(text, '[#$%&*|]'),
    'E': coalesce(d.doc_id > min(d.doc_id) OVER (PARTITION BY text), false)} AS f
  FROM words d LEFT JOIN flags f ON f.doc_id = d.doc_id),
patterns AS (
  SELECT part, f.A::INT AS a, f.B::INT AS b, f.C::INT AS c, f.D::INT AS d, f.E::INT AS e, count(*) AS n, sum(good) AS good, sum(toxic) AS toxic FROM failing GROUP BY ALL),
letters AS (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS x),
orders AS (
  SELECT p.x || q.x || r.x || s.x || t.x AS filter_order FROM letters p, letters q, letters r, letters s, letters t
  WHERE p.x NOT IN (q.x, r.x, s.x, t.x) AND q.x NOT IN (r.x, s.x, t.x) AND r.x NOT IN (s.x, t.x) AND s.x <> t.x),
steps AS (SELECT filter_order, unnest([1, 2, 3, 4, 5])::INT AS step FROM orders),
masks AS (
  SELECT part, n, good, toxic, filter_order, step, substr(filter_order, step, 1) AS letter,
    (CASE WHEN a = 1 THEN 'A' ELSE '' END || CASE WHEN b = 1 THEN 'B' ELSE '' END || CASE WHEN c = 1 THEN 'C' ELSE '' END
      || CASE WHEN d = 1 THEN 'D' ELSE '' END || CASE WHEN e = 1 THEN 'E' ELSE '' END) AS failed,
    substr(filter_order, 1, step - 1) AS earlier
  FROM patterns, steps),
marked AS (
  SELECT *, contains(failed, letter) AS fails, failed <> '' AND regexp_matches(failed, '[' || earlier || '_]') AS gone FROM masks),
counted AS (
  SELECT part, filter_order, step, letter,
    sum(CASE WHEN NOT gone AND NOT fails THEN n ELSE 0 END) AS kept,
    sum(CASE WHEN NOT gone AND fails THEN n ELSE 0 END) AS removed,
    sum(CASE WHEN gone AND fails THEN n ELSE 0 END) AS redundant,
    sum(CASE WHEN failed = letter THEN n ELSE 0 END) AS unique_fails,
    sum(CASE WHEN NOT gone AND fails THEN good ELSE 0 END) AS good_lost,
    sum(CASE WHEN NOT gone AND fails THEN toxic ELSE 0 END) AS toxic_lost
  FROM marked GROUP BY ALL)
SELECT part, filter_order, step, kept::BIGINT AS kept, removed::BIGINT AS removed, redundant::BIGINT AS redundant, unique_fails::BIGINT AS unique_fails,
  good_lost::BIGINT AS good_lost, toxic_lost::BIGINT AS toxic_lost, (sum(removed) OVER (PARTITION BY part, letter))::BIGINT AS shapley
FROM counted
"""
