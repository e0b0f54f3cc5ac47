"""Source divergence audit: how the sources of each language differ in the terms they use.

In-mapper stripes: every task folds whole documents into stripes, one per language and term, that hold
the documents and the occurrences by source. Stripes are sorted runs of integers in numpy; beyond
``SPILL_ROWS`` entries they are combined, and put out if that does not make them few. They meet by term in
one shuffle, and the merged stripes of the terms kept emit divergences directly, without a table of all
terms by all sources: each task sums its terms' differences for pairs of sources and passes on the
terms that could still be among the first ``top``.

Counts are exact integers throughout. A frequent term comes as one stripe a task, not as its occurrences,
so no key is hot; the groups that emit divergences are cut by the number of terms and sources.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from wardloom.llm.common import table
from wardloom.session import broadcast_if_small, materialize

MIN_DOCS = 30
TOP = 50
SMOOTHING = 5
SCALE_STEPS = (1000, 1000, 1000)  # 10^9 in steps, so that products stay below 2^63
SPILL_ROWS = 1_000_000
CHUNK_BYTES = 8 << 20  # text folded at once; a longer text is folded alone
GROUP_CELLS = 1 << 16  # terms times sources of a group that emits divergences
DENSE_CELLS = 1 << 20

# A-Z in lower case; every other ASCII character that is no letter separates terms.
LETTERS = bytes(c + 32 if 65 <= c <= 90 else c if c >= 128 or 97 <= c <= 122 else 32 for c in range(256))

STRIPES = "lang string, term string, sources array<string>, counts array<long>, docs array<long>"


# -- folding documents into stripes ----------------------------------------------------------


def _terms_of(texts: pa.LargeBinaryArray) -> pa.Array:
    """A list of terms for every text."""
    offsets = np.frombuffer(texts.buffers()[1], np.int64, len(texts) + 1, texts.offset * 8)
    data = b"" if texts.buffers()[2] is None else texts.buffers()[2][int(offsets[0]) : int(offsets[-1])].to_pybytes()
    spaced = pa.LargeStringArray.from_buffers(len(texts), pa.py_buffer(offsets - offsets[0]), pa.py_buffer(data.translate(LETTERS)))
    return pc.ascii_split_whitespace(spaced)


def _count(lang: pa.Array, source: pa.Array, texts: pa.LargeBinaryArray) -> pa.Table:
    """``(lang, source, term, n, docs)`` of some documents."""
    lists = _terms_of(texts)
    tokens = lists.flatten().dictionary_encode()
    terms, codes = tokens.dictionary, tokens.indices.to_numpy().astype(np.int64)
    doc = np.repeat(np.arange(len(texts)), pc.list_value_length(lists).to_numpy())
    blank = pc.index(terms, pa.scalar("", terms.type)).as_py()
    if blank >= 0:
        doc, codes = doc[codes != blank], codes[codes != blank]
    langs, sources = lang.dictionary_encode(), source.dictionary_encode()
    group = langs.indices.to_numpy().astype(np.int64) * max(1, len(sources.dictionary)) + sources.indices.to_numpy()
    # Sorted by group, term and document: runs are occurrences, changes of the document are documents.
    key = np.sort((group[doc] * max(1, len(terms)) + codes) * max(1, len(texts)) + doc)
    in_doc = np.flatnonzero(np.diff(key, prepend=-1))
    entry = key[in_doc] // max(1, len(texts))
    first = np.flatnonzero(np.diff(entry, prepend=-1))
    n = np.diff(np.append(in_doc[first], len(key)))
    docs = np.diff(np.append(first, len(entry)))
    group, term = np.divmod(entry[first], max(1, len(terms)))
    lang_code, source_code = np.divmod(group, max(1, len(sources.dictionary)))
    return pa.table({
        "lang": langs.dictionary.cast(pa.large_string()).take(pa.array(lang_code)),
        "source": sources.dictionary.cast(pa.large_string()).take(pa.array(source_code)),
        "term": terms.cast(pa.large_string()).take(pa.array(term)),
        "n": pa.array(n, pa.int64()),
        "docs": pa.array(docs, pa.int64()),
    })


def _combine(parts: list[pa.Table]) -> pa.Table:
    if len(parts) == 1:
        return parts[0]
    summed = pa.concat_tables(parts).group_by(["lang", "source", "term"], use_threads=False).aggregate([("n", "sum"), ("docs", "sum")])
    return summed.rename_columns({"n_sum": "n", "docs_sum": "docs"})


def _stripes(entries: pa.Table) -> Iterator[pa.RecordBatch]:
    """Entries put together by language and term."""
    entries = entries.combine_chunks()
    column = lambda name: entries[name].combine_chunks()
    if not len(entries):
        return
    langs, terms = column("lang").dictionary_encode(), column("term").dictionary_encode()
    key = langs.indices.to_numpy().astype(np.int64) * len(terms.dictionary) + terms.indices.to_numpy()
    order = np.argsort(key, kind="stable")
    starts = np.flatnonzero(np.diff(key[order], prepend=-1))
    offsets = pa.array(np.append(starts, len(order)).astype(np.int32))
    heads, order = pa.array(order[starts]), pa.array(order)
    lists = [pa.ListArray.from_arrays(offsets, column(name).cast(kind).take(order)) for name, kind in (("source", pa.string()), ("n", pa.int64()), ("docs", pa.int64()))]
    whole = pa.table([column("lang").cast(pa.string()).take(heads), column("term").cast(pa.string()).take(heads), *lists], names=["lang", "term", "sources", "counts", "docs"])
    yield from whole.to_batches(max_chunksize=20_000)


def fold_stripes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Partial stripes of batches of ``(lang, source, text)``."""
    held: list[pa.Table] = []
    for batch in batches:
        texts = batch.column(2).cast(pa.large_binary())
        ends = np.cumsum(pc.binary_length(texts).to_numpy())
        begin = 0
        while begin < len(texts):
            before = ends[begin - 1] if begin else 0
            end = max(begin + 1, int(np.searchsorted(ends, before + CHUNK_BYTES, side="right")))
            held.append(_count(batch.column(0)[begin:end], batch.column(1)[begin:end], texts[begin:end]))
            begin = end
            if sum(map(len, held)) > SPILL_ROWS:
                held = [_combine(held)]
                if len(held[0]) > SPILL_ROWS // 2:
                    yield from _stripes(held.pop())
    if held:
        yield from _stripes(_combine(held))


def kept_stripes(docs: DataFrame, min_docs: int = MIN_DOCS) -> DataFrame:
    """``(lang, term, stripe array<struct<source, n>>)`` of the terms in at least ``min_docs`` documents of the language.

    A document has one source, so the documents of a term are the sum over its sources.
    """
    partial = docs.select("lang", "source", "text").mapInArrow(fold_stripes, STRIPES)
    entries = partial.repartition("lang", "term").select("lang", "term", F.inline(F.arrays_zip("sources", "counts", "docs")))
    return (
        entries.groupBy("lang", "term", F.col("sources").alias("source"))
        .agg(F.sum("counts").alias("n"), F.sum("docs").alias("docs"))
        .groupBy("lang", "term")
        .agg(F.sum("docs").alias("docs"), F.collect_list(F.struct("source", "n")).alias("stripe"))
        .filter(F.col("docs") >= min_docs)
        .select("lang", "term", "stripe")
    )


# -- divergences from merged stripes ---------------------------------------------------------


def scaled(count: np.ndarray, total: np.ndarray, terms: int) -> np.ndarray:
    """``1 + floor(10^9 (count + 5) / (total + 5 terms))``, exact while totals are below 9 * 10^15."""
    rest, divisor = count + SMOOTHING, total + SMOOTHING * terms
    out = np.zeros_like(rest)
    for step in SCALE_STEPS:
        digit, rest = np.divmod(rest * step, divisor)
        out = out * step + digit
    return out + 1


def _emitter(top: int):
    def divergences(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Rows come by ``(lang, salt)``, the group's sources first, then its stripes."""
        schema = pa.schema([("lang", pa.string()), ("source", pa.string()), ("part", pa.string()), ("item", pa.string()), ("value", pa.int64())])
        at, sources, totals, vocabulary, of_lang = None, [], [], 0, 0
        terms: list[str] = []
        stripes: list[list[dict]] = []

        def flush() -> Iterator[pa.RecordBatch]:
            place = {s: i for i, s in enumerate(sources)}
            counts = np.zeros((len(terms), len(sources)), np.int64)
            for row, stripe in enumerate(stripes):
                for entry in stripe:
                    counts[row, place[entry["source"]]] = entry["n"]
            p = scaled(counts, np.array(totals, np.int64)[None, :], vocabulary) if len(terms) else counts
            for a in range(len(sources) - 1):
                value = np.abs(p[:, a + 1 :] - p[:, a : a + 1]).sum(axis=0)
                rest = len(value)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([at[0]] * rest), pa.array([sources[a]] * rest), pa.array(["pair"] * rest), pa.array(sources[a + 1 :]), pa.array(value)], schema=schema
                )
            if not terms:
                return
            excess = p - scaled(counts.sum(axis=1), np.int64(of_lang), vocabulary)[:, None]
            excess[counts == 0] = 0
            for s, source in enumerate(sources):
                rows = np.flatnonzero(excess[:, s] > 0)
                if len(rows) > top:  # all that tie with the last one stay in
                    rows = rows[excess[rows, s] >= np.partition(excess[rows, s], -top)[-top]]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([at[0]] * len(rows), pa.string()), pa.array([source] * len(rows), pa.string()), pa.array(["term"] * len(rows), pa.string()),
                     pa.array([terms[r] for r in rows], pa.string()), pa.array(excess[rows, s])], schema=schema
                )

        for batch in batches:
            for row in batch.to_pylist():
                if (row["lang"], row["salt"]) != at:
                    if at is not None:
                        yield from flush()
                    at, sources, totals, terms, stripes = (row["lang"], row["salt"]), [], [], [], []
                    vocabulary, of_lang = row["vocabulary"], row["of_lang"]
                if row["term"] is None:
                    sources.append(row["source"])
                    totals.append(row["total"])
                    continue
                terms.append(row["term"])
                stripes.append(row["stripe"])
                if len(terms) * len(sources) >= DENSE_CELLS:
                    yield from flush()
                    terms, stripes = [], []
        if at is not None:
            yield from flush()

    return divergences


def divergences(docs: DataFrame, min_docs: int = MIN_DOCS, top: int = TOP) -> DataFrame:
    """``(lang, source, part, item, value, rank)`` of documents ``(lang, source, text)`` without nulls.

    Part ``pair`` compares the group with every other source of its language over all kept terms; part
    ``term`` lists the ``top`` terms the group uses more than its language. Nothing is collected: the
    sources of a language (their product is the size of part ``pair``) travel to the groups of terms as
    rows, ahead of the stripes.
    """
    kept = materialize(kept_stripes(docs, min_docs), "stripes")
    used = kept.select("lang", F.inline("stripe")).groupBy("lang", "source").agg(F.sum("n").alias("total"))
    sizes = kept.groupBy("lang").agg(F.count(F.lit(1)).alias("vocabulary"))
    groups = docs.select("lang", "source").distinct().join(used, ["lang", "source"], "left").join(broadcast_if_small(sizes), "lang", "left")
    groups = materialize(groups.select("lang", "source", F.coalesce("total", F.lit(0)).alias("total"), F.coalesce("vocabulary", F.lit(0)).alias("vocabulary")), "groups")

    per_lang = groups.groupBy("lang").agg(F.count(F.lit(1)).alias("_sources"), F.sum("total").alias("of_lang"), F.first("vocabulary").alias("vocabulary"))
    # A group has enough terms that its pairs of sources are fewer than its cells.
    in_group = F.greatest(F.floor(F.lit(GROUP_CELLS) / F.col("_sources")), 4 * F.col("_sources"))
    per_lang = broadcast_if_small(per_lang.withColumn("salts", F.greatest(F.ceil(F.col("vocabulary") / in_group), F.lit(1))).drop("_sources"))

    no_stripe = F.lit(None).cast(kept.schema["stripe"].dataType)
    heads = groups.drop("vocabulary").join(per_lang, "lang").select(
        "lang", F.explode(F.sequence(F.lit(0).cast("long"), F.col("salts") - 1)).alias("salt"), F.lit(None).cast("string").alias("term"),
        no_stripe.alias("stripe"), "source", "total", "vocabulary", "of_lang",
    )
    bodies = kept.join(per_lang, "lang").select(
        "lang", F.pmod(F.xxhash64("term"), F.col("salts")).alias("salt"), "term", "stripe",
        F.lit(None).cast("string").alias("source"), F.lit(None).cast("long").alias("total"), "vocabulary", "of_lang",
    )
    rows = heads.unionByName(bodies).repartition("lang", "salt").sortWithinPartitions("lang", "salt", F.col("term").asc_nulls_first(), "source")
    found = rows.mapInArrow(_emitter(top), "lang string, source string, part string, item string, value long")

    summed = found.groupBy("lang", "source", "part", "item").agg(F.sum("value").alias("value"))
    mirrored = F.array(F.struct("source", "item"), F.struct(F.col("item").alias("source"), F.col("source").alias("item")))
    both = F.when(F.col("part") == "pair", mirrored).otherwise(F.slice(mirrored, 1, 1))
    listed = summed.select("lang", "part", "value", F.inline(both))
    best = Window.partitionBy("lang", "source", "part").orderBy(F.desc("value"), F.asc("item"))
    ranked = listed.withColumn("rank", F.row_number().over(best)).filter((F.col("part") == "pair") | (F.col("rank") <= top))
    return ranked.select("lang", "source", "part", "item", "value", "rank")


def source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Contract query: the divergences of all ``documents``.

    NULL text, lang and source count as empty strings. Texts of any length are folded whole; repeated rows
    are documents of their own. A group without terms is compared with probabilities of zero counts; without
    any kept term in the language, its pairs have value 0. Ties are ranked by item. An empty table gives
    no rows. Other columns are not read.
    """
    docs = table(spark, sf_dir, "documents")
    return divergences(docs.select(*[F.coalesce(F.col(c), F.lit("")).alias(c) for c in ("lang", "source", "text")]))


ORACLE = r"""
WITH docs AS (
  SELECT row_number() OVER () AS doc, coalesce(lang, '') AS lang, coalesce(source, '') AS source, coalesce(text, '') AS text FROM documents),
tokens AS (
  SELECT doc, lang, source, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')) AS term
  FROM docs),
kept AS (SELECT lang, term FROM tokens GROUP BY lang, term HAVING count(DISTINCT doc) >= 30),
vocabulary AS (SELECT lang, count(*) AS v FROM kept GROUP BY lang),
counted AS (SELECT lang, source, term, count(*) AS c FROM tokens JOIN kept USING (lang, term) GROUP BY lang, source, term),
groups AS (
  SELECT g.lang, g.source, coalesce(sum(c), 0) AS n
  FROM (SELECT DISTINCT lang, source FROM docs) g LEFT JOIN counted ON counted.lang = g.lang AND counted.source = g.source GROUP BY g.lang, g.source),
of_lang AS (SELECT lang, term, sum(c) AS c, sum(sum(c)) OVER (PARTITION BY lang) AS n FROM counted GROUP BY lang, term),
shares AS (
  SELECT g.lang, g.source, k.term, coalesce(t.c, 0) AS c,
    1 + (1000000000::HUGEINT * (coalesce(t.c, 0) + 5)) // (g.n + 5 * v) AS p,
    1 + (1000000000::HUGEINT * (o.c + 5)) // (o.n + 5 * v) AS q
  FROM groups g JOIN vocabulary USING (lang) JOIN kept k USING (lang) JOIN of_lang o ON o.lang = k.lang AND o.term = k.term
  LEFT JOIN counted t ON t.lang = g.lang AND t.source = g.source AND t.term = k.term),
pairs AS (
  SELECT a.lang, a.source, b.source AS item, coalesce(sum(abs(x.p - y.p)), 0)::BIGINT AS value
  FROM groups a JOIN groups b ON a.lang = b.lang AND a.source <> b.source
  LEFT JOIN shares x ON x.lang = a.lang AND x.source = a.source
  LEFT JOIN shares y ON y.lang = b.lang AND y.source = b.source AND y.term = x.term
  GROUP BY a.lang, a.source, b.source),
found AS (
  SELECT lang, source, 'pair' AS part, item, value FROM pairs
  UNION ALL
  SELECT lang, source, 'term', term, (p - q)::BIGINT FROM shares WHERE c > 0 AND p > q)
SELECT lang, source, part, item, value, rank::INT AS rank FROM (
  SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS rank FROM found)
WHERE part = 'pair' OR rank <= 50
"""
