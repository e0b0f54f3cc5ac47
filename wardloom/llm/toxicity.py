"""Toxicity by compression distance.

Two Zstandard dictionaries are trained: one on words of toxic texts, one on words of ordinary texts.
Every word of a text is a window; it is compressed with either dictionary, and the lengths are
compared. A window is written twice behind a carrier that both dictionaries hold, so that the fixed
cost of a compressed block cancels and a word costs its literals or its match, no less. What toxic
texts merely share with all others must not enter their dictionary: its words are those that
Spark counts in significantly more toxic than ordinary documents. Ordinary words that the first
pair of dictionaries takes for toxic are added to the ordinary side. How many windows of a text
reach each threshold is turned into a score by a logistic curve that is fitted, and shifted to its best
F1, on labelled documents kept from the dictionaries.

Training uses a bounded sample: about ``train_docs`` labelled documents by a hash of the id.

Defined results: NULL, empty and wordless texts have no window and get the score of that; without
labels of both kinds every score is 0; rows without an id are not trained on; repeated rows get
equal rows; other columns are not looked at.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from wardloom.llm.common import part_of, table
from wardloom.session import broadcast_if_small

TRAIN_DOCS = 20_000  # labelled documents expected in training; bounds all that reaches the driver
TOXIC_WORDS = 400  # most significant words kept for the toxic dictionary
ORDINARY_WORDS = 40_000  # most frequent words kept for the ordinary dictionary and its hard cases
SIGNIFICANCE = 5.0  # standard deviations above the share expected of a word
MIN_DOCS = 3
DICTIONARY_BYTES = 32 << 10
SAMPLES = 60_000
LEVEL = 3
TOP = 16  # window advantages are counted up to here
CACHED_WORDS = 500_000
CARRIER = bytes(range(0x21, 0x41))
WORD = r"\p{L}+"


def _window(word: bytes) -> bytes:
    return (b" " + word) * 2


def _compressor(content: bytes) -> zstandard.ZstdCompressor:
    held = zstandard.ZstdCompressionDict(content + CARRIER, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
    held.precompute_compress(level=LEVEL)
    return zstandard.ZstdCompressor(level=LEVEL, dict_data=held, write_checksum=False, write_content_size=False, write_dict_id=False)


class Distance:
    """Bytes that the toxic dictionary saves on a word against the ordinary one."""

    def __init__(self, toxic: bytes, ordinary: bytes):
        self._toxic, self._ordinary = _compressor(toxic), _compressor(ordinary)
        self._known: dict[str, int] = {}

    def __call__(self, word: str) -> int:
        out = self._known.get(word)
        if out is None:
            if len(self._known) >= CACHED_WORDS:
                self._known.clear()
            window = CARRIER + _window(word.encode())
            out = self._known[word] = len(self._ordinary.compress(window)) - len(self._toxic.compress(window))
        return out


def features(counts: np.ndarray) -> np.ndarray:
    """From the number of windows by advantage (0 .. TOP, and all): logs of shares and counts at each threshold."""
    reach = counts[:, :TOP + 1][:, ::-1].cumsum(axis=1)[:, ::-1][:, 2:]
    n = np.maximum(counts[:, -1:], 1)
    return np.hstack([np.log1p(reach), np.log1p(100 * reach / n), (reach > 0).astype(float), np.log1p(n)])


@dataclass
class Model:
    toxic: bytes
    ordinary: bytes
    mean: np.ndarray
    scale: np.ndarray
    weight: np.ndarray
    bias: float

    def score(self, counts: np.ndarray) -> np.ndarray:
        x = (features(counts) - self.mean) / self.scale
        return 1 / (1 + np.exp(-np.clip(x @ self.weight + self.bias, -30, 30)))


def train_dictionaries(toxic: list[tuple[str, float]], ordinary: list[tuple[str, int]]) -> tuple[bytes, bytes]:
    """Contents of both dictionaries from ``(word, significance)`` and ``(word, documents)``, best last."""
    sure = b"".join(_window(w.encode()) for w, _ in sorted(toxic, key=lambda x: (x[1], x[0])))
    total = sum(n for _, n in ordinary) or 1
    samples = [_window(w.encode()) for w, n in ordinary for _ in range(max(1, round(SAMPLES * n / total)))]
    try:
        usual = zstandard.train_dictionary(DICTIONARY_BYTES, samples, k=32, d=6).as_bytes()
    except zstandard.ZstdError:  # too few samples to choose from: all of them then
        usual = b"".join(samples)[-DICTIONARY_BYTES:]
    distance = Distance(sure, usual)
    hard = [w for w, _ in ordinary if distance(w) >= 2]
    return sure, b"".join(_window(w.encode()) for w in reversed(hard)) + usual


def fit(counts: np.ndarray, toxic: np.ndarray, dictionaries: tuple[bytes, bytes], steps: int = 60, ridge: float = 3.0) -> Model:
    """Ridge logistic regression by Newton's method, its 0.5 moved to the best F1."""
    x = features(counts)
    mean, scale = x.mean(axis=0), x.std(axis=0) + 1e-3
    z = np.hstack([(x - mean) / scale, np.ones((len(x), 1))])
    w, penalty = np.zeros(z.shape[1]), np.r_[np.full(z.shape[1] - 1, ridge), 1e-6]
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(z @ w, -30, 30)))
        step = np.linalg.solve(z.T @ (z * (p * (1 - p) + 1e-6)[:, None]) + np.diag(penalty), z.T @ (p - toxic) + penalty * w)
        w -= step
        if np.abs(step).max() < 1e-6:
            break
    value = z @ w
    order = np.argsort(-value)
    hits = np.cumsum(toxic[order])
    f1 = 2 * hits / (np.arange(1, len(order) + 1) + toxic.sum())
    best = int(f1.argmax())
    cut = (value[order[best]] + value[order[min(best + 1, len(order) - 1)]]) / 2
    return Model(*dictionaries, mean, scale, w[:-1], float(w[-1] - cut))


def window_counts(docs: DataFrame, dictionaries: tuple[bytes, bytes], text: str = "text") -> DataFrame:
    """``docs`` with ``_tx_counts``: windows by advantage 0 .. TOP (less counts as 0), and all windows."""
    names = docs.columns
    shared = docs.sparkSession.sparkContext.broadcast(dictionaries)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import regex

        find, distance = regex.compile(WORD).findall, Distance(*shared.value)
        for batch in batches:
            rows = np.zeros((len(batch), TOP + 2), np.int64)
            for row, body in zip(rows, batch.column(len(names)).to_pylist(), strict=True):
                saved = np.fromiter(map(distance, find(body)), np.int64) if body else np.zeros(0, np.int64)
                row[:-1] = np.bincount(np.clip(saved, 0, TOP), minlength=TOP + 1)
                row[-1] = len(saved)
            lists = pa.ListArray.from_arrays(pa.array(np.arange(len(rows) + 1, dtype=np.int32) * (TOP + 2)), pa.array(rows.ravel()))
            yield pa.RecordBatch.from_arrays([*batch.columns[: len(names)], lists], names=[*names, "_tx_counts"])

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema)
    return docs.withColumn("_tx_text", F.lower(F.col(text))).mapInArrow(count, f"{schema}, _tx_counts array<long>")


def train(docs: DataFrame, labels: DataFrame, train_docs: int = TRAIN_DOCS) -> Model | None:
    """The model of a bounded sample of ``docs (doc_id, text)`` labelled 0 or 1 in ``labels (doc_id, toxic)``."""
    known = labels.filter("toxic in (0, 1) and doc_id is not null").groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    share = train_docs * 1_000_000 / max(1, known.count())
    draw = F.xxhash64("doc_id", F.lit("toxicity"))
    known = known.filter(F.pmod(draw, F.lit(1_000_000)) < share)
    rows = docs.select("doc_id", "text").join(broadcast_if_small(known), "doc_id")
    for_words = F.pmod(F.shiftright(draw, 24), F.lit(10)) < 6

    found = F.array_distinct(F.regexp_extract_all(F.lower("text"), F.lit(WORD), 0))
    first = rows.filter(for_words)
    sizes = {r["toxic"]: r["n"] for r in first.groupBy("toxic").agg(F.count(F.lit(1)).alias("n")).collect()}
    if not sizes.get(0) or not sizes.get(1):
        return None
    share = sizes[1] / (sizes[0] + sizes[1])
    words = first.select("toxic", F.explode(found).alias("w")).groupBy("w").agg(F.sum("toxic").alias("t"), F.sum(1 - F.col("toxic")).alias("o"))
    both = F.col("t") + F.col("o")
    above = (F.col("t") - both * share) / F.sqrt(both * share * (1 - share))
    toxic = words.filter((F.col("t") >= MIN_DOCS) & (above >= SIGNIFICANCE)).orderBy(above.desc(), "w").limit(TOXIC_WORDS).select("w", above.alias("s"))
    ordinary = words.filter((F.col("o") > 0) & (above < 1)).orderBy(F.desc("o"), "w").limit(ORDINARY_WORDS).select("w", "o")
    dictionaries = train_dictionaries([tuple(r) for r in toxic.collect()], [tuple(r) for r in ordinary.collect()])

    rest = [(r["toxic"], r["_tx_counts"]) for r in window_counts(rows.filter(~for_words).select("toxic", "text"), dictionaries).select("toxic", "_tx_counts").collect()]
    y, counts = np.array([t for t, _ in rest], float), np.array([c for _, c in rest], float).reshape(-1, TOP + 2)
    return fit(counts, y, dictionaries) if 0 < y.sum() < len(y) else None


def score_texts(docs: DataFrame, model: Model | None, text: str = "text") -> DataFrame:
    """``docs`` with ``score`` in 0 .. 1."""
    if model is None:
        return docs.withColumn("score", F.lit(0.0))
    shared = docs.sparkSession.sparkContext.broadcast(model)

    @F.pandas_udf("double")
    def score(counts):
        import pandas as pd

        return pd.Series(shared.value.score(np.stack(counts.to_numpy()).astype(float)) if len(counts) else [], dtype="float64")

    return window_counts(docs, (model.toxic, model.ordinary), text).withColumn("score", score("_tx_counts")).drop("_tx_counts")


def predicted(score: Column) -> Column:
    return (score >= 0.5).cast("int")


def toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Contract query: toxicity score of every document, learned on four of five folds."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    fold = part_of(F.col("doc_id"), 5)
    model = train(docs.filter(fold != 0), table(spark, sf_dir, "labels").filter(fold != 0))
    out = score_texts(docs.select("doc_id", F.coalesce(fold == 0, F.lit(False)).alias("held_out"), "text"), model)
    return out.select("doc_id", "held_out", "score", predicted(F.col("score")).alias("predicted"))
