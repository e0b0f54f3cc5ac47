"""Language identification by prediction with partial matching.

One variable-order context tree over bytes per language: a byte costs its share of what followed
the longest known context of up to three bytes; where it never followed it, an escape is paid and
the next shorter context is asked (method C, without exclusion, a uniform byte at the end). The
statistics are frozen after training, so the code length of a text is a sum over its bytes, and the
language with the shortest code wins. Scoring is exact over the whole text.

Training takes a bounded sample: about ``train_docs`` documents of each language, chosen by a hash of
the id; n-gram counts of the sample are summed by Spark.

Defined results: ``und`` with score 0 for NULL texts and texts without a letter, and for every text if
nothing was learned; equal code lengths go to the first language by name; rows without an id are
not trained on and not held out; repeated rows get equal rows; other columns are not looked at.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from wardloom.llm.common import part_of, table
from wardloom.session import broadcast_if_small

TRAIN_DOCS = 1_000  # expected per language; bounds the size of the model
MAX_LANGUAGES = 500
CHUNK_BYTES = 1 << 20
PAD = b"\n\n\n"  # what stands before the first byte of a text


def _grams(texts: list[bytes]) -> np.ndarray:
    """The four-byte strings that end at each byte, as numbers, over all texts."""
    out = []
    for text in texts:
        b = np.frombuffer(PAD + text, np.uint8).astype(np.int64)
        out.append((b[:-3] << 24) | (b[1:-2] << 16) | (b[2:-1] << 8) | b[3:])
    return np.concatenate(out) if out else np.zeros(0, np.int64)


def gram_counts(texts: DataFrame) -> DataFrame:
    """``(lang, gram, n)`` summed over ``texts (lang, text binary)``."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            by_lang: dict[str, list[bytes]] = {}
            for lang, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                by_lang.setdefault(lang, []).append(text)
            for lang, own in by_lang.items():
                grams, n = np.unique(_grams(own), return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array([lang] * len(grams), pa.string()), pa.array(grams), pa.array(n.astype(np.int64))], names=["lang", "gram", "n"])

    return texts.mapInArrow(count, "lang string, gram long, n long").groupBy("lang", "gram").agg(F.sum("n").alias("n"))


@dataclass
class Model:
    """Code lengths in bits, a column per language, for the n-grams known to any of them.

    ``letter`` maps bytes to a dense alphabet with 0 for bytes never seen. ``known3`` maps three letters to a
    row of ``cost3`` / ``escape3``, ``known4`` that row and a letter to one of ``cost4``; row 0 means unknown.
    """

    langs: list[str]
    letter: np.ndarray
    known3: np.ndarray
    known4: np.ndarray
    cost4: np.ndarray
    escape3: np.ndarray
    cost3: np.ndarray
    escape2: np.ndarray
    cost2: np.ndarray

    def bits(self, texts: list[bytes]) -> np.ndarray:
        """Code length of each text in each language."""
        lengths = np.array([len(t) for t in texts])
        out = np.zeros((len(texts), len(self.langs)))
        full = np.flatnonzero(lengths)
        if not len(full):
            return out
        a = self.letter[np.frombuffer(b"".join(PAD + texts[i] for i in full), np.uint8)].astype(np.int32)
        size = int(self.letter.max()) + 1
        pair = a[:-1] * size + a[1:]
        three = self.known3[pair[:-1] * size + a[2:]]  # row of the three letters that end at byte i+2
        starts = np.concatenate([[0], np.cumsum(lengths[full] + len(PAD))])
        at = np.ones(len(a), bool)
        for k in range(len(PAD)):
            at[starts[:-1] + k] = False
        at = np.flatnonzero(at)  # places of real bytes
        before = three[at - 3]
        row4 = self.known4[before, a[at]]
        cost = self.cost4[row4]
        new = np.flatnonzero(row4 == 0)
        if len(new):
            i = at[new]
            row3 = three[i - 2]
            shorter = self.cost3[row3]
            none = np.flatnonzero(row3 == 0)
            shorter[none] = self.escape2[pair[i[none] - 2]] + self.cost2[pair[i[none] - 1]]
            cost[new] = self.escape3[before[new]] + shorter
        out[full] = np.add.reduceat(cost, np.cumsum(lengths[full]) - lengths[full], axis=0, dtype=np.float64)
        return out


def build_model(counts: list[tuple[str, int, int]]) -> Model:
    """The model of ``(lang, gram, n)`` rows."""
    langs = sorted({lang for lang, _, _ in counts}, key=str.encode)
    column = {lang: i for i, lang in enumerate(langs)}
    gram = np.array([g for _, g, _ in counts], np.int64)
    lang = np.array([column[x] for x, _, _ in counts], np.int64)
    n = np.array([c for _, _, c in counts], np.float64)
    seen = np.unique(np.concatenate([(gram >> s) & 255 for s in (24, 16, 8, 0)])) if len(gram) else np.zeros(0, np.int64)
    letter = np.zeros(256, np.int64)
    letter[seen] = np.arange(1, len(seen) + 1)
    size, width = len(seen) + 1, len(langs)
    code = np.zeros(len(gram), np.int64)
    for s in (24, 16, 8, 0):
        code = code * size + letter[(gram >> s) & 255]

    def tally(codes: np.ndarray, cells: int | None = None) -> tuple[np.ndarray, np.ndarray]:
        """Distinct codes (or all below ``cells``) and their counts per language."""
        keys, row = np.unique(codes, return_inverse=True) if cells is None else (np.arange(cells), codes)
        total = np.zeros((len(keys), width))
        np.add.at(total, (row, lang), n)
        return keys, total

    def step(keys: np.ndarray, count: np.ndarray, contexts: np.ndarray, shorter: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Costs of ``keys`` given costs one order shorter, and the escape cost of each context (0 where unknown)."""
        context = np.searchsorted(contexts, keys // size)
        total, kinds = np.zeros((len(contexts), width)), np.zeros((len(contexts), width))
        np.add.at(total, context, count)
        np.add.at(kinds, context, count > 0)
        with np.errstate(divide="ignore", invalid="ignore"):
            escape = np.where(kinds > 0, np.log2((total + kinds) / kinds), 0.0)
            own = np.log2((total + kinds)[context] / count)
        return np.where(count > 0, own, escape[context] + shorter), escape

    keys1, count1 = tally(code % size, size)
    cost1, _ = step(keys1, count1, np.array([0]), np.full((size, width), 8.0))
    keys2, count2 = tally(code % size**2, size**2)
    cost2, _ = step(keys2, count2, np.arange(size), cost1[keys2 % size])
    keys3, count3 = tally(code % size**3)
    cost3, escape2 = step(keys3, count3, np.arange(size**2), cost2[keys3 % size**2])
    keys4, count4 = tally(code)
    contexts = np.unique(keys4 // size)  # these also occur as three letters of their own, or at the start of a text
    rows3 = np.union1d(keys3, contexts)
    known = np.isin(rows3, keys3)
    all3 = np.zeros((len(rows3), width))
    all3[known] = cost3
    rest = rows3[~known]
    all3[~known] = escape2[rest // size] + cost2[rest % size**2]
    known3 = np.zeros(size**3, np.int32)
    known3[rows3] = np.arange(1, len(rows3) + 1)
    cost4, escape3 = step(keys4, count4, rows3, all3[known3[keys4 % size**3] - 1])
    known4 = np.zeros((len(rows3) + 1, size), np.int32)
    known4[known3[keys4 // size], keys4 % size] = np.arange(1, len(keys4) + 1)
    padded = lambda x: np.vstack([np.zeros((1, width)), x]).astype(np.float32)
    return Model(langs, letter, known3, known4, padded(cost4), padded(escape3), padded(all3), escape2.astype(np.float32), cost2.astype(np.float32))


def train(docs: DataFrame, train_docs: int = TRAIN_DOCS) -> Model:
    """The model of a bounded sample of ``docs (doc_id, text, lang)``."""
    known = docs.filter("text is not null and lang is not null")
    sizes = known.groupBy("lang").agg(F.count(F.lit(1)).alias("n"))
    if sizes.limit(MAX_LANGUAGES + 1).count() > MAX_LANGUAGES:
        raise ValueError(f"more than {MAX_LANGUAGES} languages")
    share = sizes.select(F.col("lang").alias("_lang"), (F.lit(train_docs * 1_000_000.0) / F.col("n")).alias("_share"))
    chosen = known.join(broadcast_if_small(share), F.col("lang") == F.col("_lang")).filter(F.pmod(F.xxhash64("doc_id"), F.lit(1_000_000)) < F.col("_share"))
    counts = gram_counts(chosen.select("lang", folded(F.col("text")).alias("text")))
    return build_model([tuple(r) for r in counts.collect()])


def folded(text: Column) -> Column:
    return F.lower(text).cast("binary")


def identify(docs: DataFrame, model: Model, text: str = "text") -> DataFrame:
    """``docs`` with ``lang_pred`` and ``score``, the share of the winner if all languages were equally likely before."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    names = docs.columns
    source = docs.withColumns({"_li_text": F.when(F.col(text).rlike(r"\p{L}"), folded(F.col(text)))})

    def predict(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m: Model = shared.value
        for batch in batches:
            texts = batch.column(len(names)).to_pylist()
            found, score = ["und"] * len(texts), np.zeros(len(texts))
            begin = 0
            while begin < len(texts) and m.langs:
                end, size = begin, 0
                while end < len(texts) and (end == begin or size + len(texts[end] or b"") <= CHUNK_BYTES):
                    size += len(texts[end] or b"")
                    end += 1
                for i, bits in zip(range(begin, end), m.bits([t or b"" for t in texts[begin:end]]), strict=True):
                    if texts[i]:
                        best = int(bits.argmin())
                        found[i], score[i] = m.langs[best], 1 / np.exp2(np.maximum(bits[best] - bits, -1000)).sum()
                begin = end
            yield pa.RecordBatch.from_arrays([*batch.columns[: len(names)], pa.array(found, pa.string()), pa.array(score)], names=[*names, "lang_pred", "score"])

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema)
    return source.mapInArrow(predict, f"{schema}, lang_pred string, score double")


def language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Contract query: the language of every document, learned on three of four folds."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    fold = part_of(F.col("doc_id"), 4)
    model = train(docs.filter(fold != 2))
    out = identify(docs.select("doc_id", F.coalesce(fold == 2, F.lit(False)).alias("held_out"), "text"), model)
    return out.select("doc_id", "held_out", "lang_pred", "score")
