"""Best-fit packing of tokenized documents into sequences of bounded length (best-two-fit).

Tokens are counted where the texts are; only narrow piece rows move. Packing works on the
histogram of piece lengths, which has at most as many rows as a sequence has tokens whatever the
size of the corpus: a bin is filled greedily with the longest lengths that fit, its shortest
document gives way to two unpacked ones that fill the widened gap more tightly, and the finished
bin is repeated as often as the histogram allows. Pieces, numbered in order of length, then look
their bin up by number.

Defined results: NULL and empty texts are one end token; repeated rows are pieces of their own;
an empty table gives no rows; columns other than the id and the text are not looked at.
"""

from __future__ import annotations

import gc
import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wardloom.llm.common import table
from wardloom.operators.numbering import running_offsets
from wardloom.session import materialize

MAX_TOKENS = 4096
END_TOKEN = 1
CACHED_WORDS = 400_000  # words whose ids a worker remembers, also between tasks; beyond that it starts anew
CHUNK_BYTES = 4 << 20  # text handled at a time within a worker

# Words of these letters only are in normal form and lower-cased alike everywhere; of these, the
# library's model is asked piece by piece. Anything else goes through its whole pipeline.
PLAIN_WORD = re.compile(r"[!-;=-~\u00c0-\u012f\u0131-\u017e]+")
# How this vocabulary cuts words into pieces, and the stand-ins of byte-level models.
PIECE = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
PRINTABLE_BYTES = (*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100))


def vocabulary(name: str = "word_bpe_49k.json") -> str:
    import public_tokenizers

    return str(public_tokenizers.path(name))


def _byte_stand_ins() -> list[str]:
    """The character that stands for each byte: itself if printable, else one from 256 on, in order."""
    rest = iter(range(256, 512))
    return [chr(b if b in PRINTABLE_BYTES else next(rest)) for b in range(256)]


class _Lists:
    """Lists of ids, one after another."""

    def __init__(self) -> None:
        self.ids = np.zeros(0, np.uint32)
        self.start = np.zeros(0, np.int64)
        self.length = np.zeros(0, np.int64)

    def add(self, ids: np.ndarray, lengths: np.ndarray) -> None:
        starts = len(self.ids) + np.cumsum(lengths) - lengths
        self.ids = np.concatenate([self.ids, ids])
        self.start, self.length = np.concatenate([self.start, starts]), np.concatenate([self.length, lengths])

    def add_lists(self, lists: list[list[int]]) -> None:
        lengths = np.fromiter(map(len, lists), np.int64, len(lists))
        self.add(np.fromiter(chain.from_iterable(lists), np.uint32, int(lengths.sum())), lengths)

    def take(self, which: np.ndarray) -> np.ndarray:
        """The ids of the given lists, in that order."""
        lengths = self.length[which]
        ends = np.cumsum(lengths)
        return self.ids[np.repeat(self.start[which] - (ends - lengths), lengths) + np.arange(int(ends[-1]) if len(ends) else 0)]


class WordTokenizer:
    """Ids of texts, word by word: this vocabulary drops white space, so no token spans two words."""

    def __init__(self, path: str):
        import regex
        from tokenizers import Tokenizer

        self._tokenizer = Tokenizer.from_file(path)
        self._model = self._tokenizer.model
        self._cut = regex.compile(PIECE + "| ").findall
        self._stand_in = _byte_stand_ins()
        self._reset()

    def _reset(self) -> None:
        self._known: dict[bytes, int] = {}
        self._words = _Lists()
        self._piece: dict[str, int] = {" ": 0}
        self._pieces = _Lists()
        self._pieces.add(np.zeros(0, np.uint32), np.zeros(1, np.int64))  # a space has no ids

    def _spelled(self, piece: str) -> str:
        return piece if piece.isascii() else "".join(map(self._stand_in.__getitem__, piece.encode()))

    def _learn(self, new: list[bytes]) -> None:
        """Add the ids of words. Plain words are cut into pieces together, each behind a space."""
        words = [w.decode() for w in new]
        plain = [PLAIN_WORD.fullmatch(w) is not None for w in words]
        cut = self._cut("".join([" " + w for w, p in zip(words, plain, strict=True) if p]).lower())
        unmet = list(set(cut).difference(self._piece))
        tokenize = self._model.tokenize
        ids = [[t.id for t in tokenize(self._spelled(piece))] for piece in unmet]
        self._piece.update(zip(unmet, range(len(self._piece), len(self._piece) + len(unmet)), strict=True))
        self._pieces.add_lists(ids)
        codes = np.fromiter(map(self._piece.__getitem__, cut), np.int64, len(cut))
        n = sum(plain)
        lengths = np.bincount(np.cumsum(codes == 0) - 1, self._pieces.length[codes], n).astype(np.int64) if n else np.zeros(0, np.int64)
        self._words.add(self._pieces.take(codes), lengths)
        other = [w for w, p in zip(words, plain, strict=True) if not p]
        self._words.add_lists([self._tokenizer.encode(w, add_special_tokens=False).ids for w in other])
        ordered = [w for w, p in zip(new, plain, strict=True) if p] + [w for w, p in zip(new, plain, strict=True) if not p]
        self._known.update(zip(ordered, range(len(self._known), len(self._known) + len(new)), strict=True))

    def encode(self, texts: pa.LargeBinaryArray) -> tuple[np.ndarray, np.ndarray]:
        """All ids one after another, and how many each text has."""
        if len(self._known) > CACHED_WORDS:
            self._reset()
        # Cut and told apart in Arrow; Python sees each word of a chunk once.
        lists = pc.ascii_split_whitespace(texts.cast(pa.large_string(), safe=False))
        flat = lists.flatten().dictionary_encode()
        found = flat.dictionary.cast(pa.large_binary()).to_pylist()
        new = [w for w in found if w not in self._known]
        if new:
            collects = gc.isenabled()
            gc.disable()  # much that is small is made here, and no cycles
            try:
                self._learn(new)
            finally:
                if collects:
                    gc.enable()
        at = np.fromiter(map(self._known.__getitem__, found), np.int64, len(found))[flat.indices.to_numpy()]
        ids, ends = self._words.take(at), np.cumsum(self._words.length[at])
        per_text = pc.list_value_length(lists).to_numpy()
        borders = np.concatenate([[0], ends])[np.concatenate([[0], np.cumsum(per_text)]).astype(np.int64)]
        return ids, np.diff(borders)


_tokenizers: dict[str, WordTokenizer] = {}


def word_tokenizer(path: str) -> WordTokenizer:
    """This process's tokenizer, with the words it has met so far."""
    if path not in _tokenizers:
        _tokenizers[path] = WordTokenizer(path)
    return _tokenizers[path]


def tokenized_pieces(docs: DataFrame, key: str = "doc_id", text: str = "text", max_tokens: int = MAX_TOKENS, path: str | None = None, with_ids: bool = False) -> DataFrame:
    """``(key, piece, start, length, ids_crc32 [, ids])``: each document's ids and the end token, cut at ``max_tokens``."""
    path = path or vocabulary()
    source = docs.select(F.col(key).alias(key), F.coalesce(F.col(text), F.lit("")).cast("binary").alias("_text"))
    out = f"`{key}` {source.schema[key].dataType.simpleString()}, piece int, start long, length long, ids_crc32 long" + ", ids array<long>" * with_ids

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokenizer = word_tokenizer(path)
        for batch in batches:
            texts = batch.column(1).cast(pa.large_binary())
            chunk = np.cumsum(pc.binary_length(texts).to_numpy()) // CHUNK_BYTES
            for rows in np.split(np.arange(len(batch)), np.flatnonzero(np.diff(chunk)) + 1):
                if not len(rows):
                    continue
                part = batch.slice(int(rows[0]), len(rows))
                ids, counts = tokenizer.encode(texts.slice(int(rows[0]), len(rows)))
                row, piece, start, length, crc, kept = [], [], [], [], [], []
                begin = 0
                for i, n in enumerate(counts.tolist()):
                    own = np.append(ids[begin : begin + n], np.uint32(END_TOKEN)).astype("<u4")
                    begin += n
                    for k, at in enumerate(range(0, n + 1, max_tokens)):
                        body = own[at : at + max_tokens]
                        row.append(i), piece.append(k), start.append(at), length.append(len(body)), crc.append(zlib.crc32(body.tobytes()))
                        if with_ids:
                            kept.append(body.tolist())
                columns = [part.column(0).take(pa.array(row, pa.int64())), pa.array(piece, pa.int32()), *(pa.array(x, pa.int64()) for x in (start, length, crc))]
                if with_ids:
                    columns.append(pa.array(kept, pa.list_(pa.int64())))
                yield pa.RecordBatch.from_arrays(columns, names=[key, "piece", "start", "length", "ids_crc32", *["ids"] * with_ids])

    return source.mapInArrow(cut, out)


@dataclass(frozen=True)
class Bins:
    """Where the pieces of one length, numbered from 0 over all lengths in ascending order, go.

    Segment k starts at piece number ``first[k]`` and puts ``per_bin[k]`` pieces of ``length[k]`` into
    each sequence from ``sequence[k]`` on, the first at ``offset[k]``.
    """

    first: np.ndarray
    sequence: np.ndarray
    per_bin: np.ndarray
    offset: np.ndarray
    length: np.ndarray
    count: int


def _largest_up_to(left: np.ndarray) -> np.ndarray:
    """For each x the longest length with pieces left that is at most x, or 0."""
    return np.maximum.accumulate(np.where(left > 0, np.arange(len(left)), 0))


def _tightest_pair(left: np.ndarray, gap: int, more_than: int) -> tuple[int, int] | None:
    """Two unpacked lengths with the largest sum that is at most ``gap`` and above ``more_than``."""
    a = np.flatnonzero(left[: gap + 1])
    if not len(a):
        return None
    best = _largest_up_to(left[: gap + 1])
    b = best[gap - a]
    alone = (b == a) & (left[a] < 2)  # a piece does not pair with itself
    if alone.any():
        b[alone] = best[a[alone] - 1]
    total = np.where(b > 0, a + b, 0)
    k = int(total.argmax())
    return (int(a[k]), int(b[k])) if total[k] > more_than else None


def fill_bins(histogram: dict[int, int], size: int = MAX_TOKENS) -> Bins:
    """Best-two-fit over a histogram {length: pieces}."""
    left = np.zeros(size + 1, np.int64)
    for length, n in histogram.items():
        left[length] = n
    next_piece = np.cumsum(left) - left
    segments: list[tuple[int, int, int, int, int]] = []
    bins = 0
    while left.any():
        free, used, gap = left.copy(), {}, size

        def take(length: int, n: int = 1) -> None:
            free[length] -= n  # noqa: B023
            used[length] = used.get(length, 0) + n  # noqa: B023

        while gap and (length := int(_largest_up_to(free[: gap + 1])[gap])):
            n = min(int(free[length]), gap // length) if used else 1
            take(length, n)
            gap -= n * length
        while gap and sum(used.values()) > 1:
            smallest = min(used)
            pair = _tightest_pair(free, gap + smallest, smallest)
            if pair is None:
                break
            used[smallest] -= 1
            free[smallest] += 1
            if not used[smallest]:
                del used[smallest]
            for length in pair:
                take(length)
            gap += smallest - sum(pair)
        times = min(int(left[length]) // n for length, n in used.items())
        offset = 0
        for length, n in sorted(used.items(), reverse=True):
            segments.append((int(next_piece[length]), bins, n, offset, length))
            next_piece[length] += n * times
            left[length] -= n * times
            offset += n * length
        bins += times
    columns = np.array(sorted(segments), np.int64).reshape(-1, 5).T
    return Bins(*columns, count=bins)


def pack(pieces: DataFrame, order_by: list[str], max_tokens: int = MAX_TOKENS) -> DataFrame:
    """``pieces`` with ``sequence_id`` and ``offset``; ``length`` is in 1 .. ``max_tokens``.

    ``pieces`` should be a written table: it is read more than once.
    """
    histogram = {r["length"]: r["n"] for r in pieces.groupBy("length").agg(F.count(F.lit(1)).alias("n")).collect()}  # at most max_tokens rows
    bins = fill_bins(histogram, max_tokens)
    numbered = running_offsets(pieces.withColumn("_one", F.lit(1).cast("long")), ["length", *order_by], "_one", "_number")
    names = [*pieces.columns, "sequence_id", "offset"]

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            number = batch.column(batch.schema.get_field_index("_number")).to_numpy(zero_copy_only=False)
            k = np.searchsorted(bins.first, number, "right") - 1
            bin_of, slot = np.divmod(number - bins.first[k], bins.per_bin[k])
            columns = [batch.column(batch.schema.get_field_index(c)) for c in names[:-2]]
            columns += [pa.array(bins.sequence[k] + bin_of), pa.array(bins.offset[k] + slot * bins.length[k])]
            yield pa.RecordBatch.from_arrays(columns, names=names)

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in pieces.schema) + ", sequence_id long, offset long"
    return numbered.mapInArrow(place, schema)


def pack_documents(docs: DataFrame, max_tokens: int = MAX_TOKENS) -> DataFrame:
    pieces = materialize(tokenized_pieces(docs, max_tokens=max_tokens), "pieces")
    return pack(pieces, ["doc_id", "piece", "ids_crc32"], max_tokens)


def best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Contract query: every document's pieces and their place in a sequence."""
    return pack_documents(table(spark, sf_dir, "documents"))
