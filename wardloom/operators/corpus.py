"""Corpora: records cut from texts, numbered 0, 1, 2 ... in the order of their texts."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from wardloom.functions.text import NEWLINE, cut_records
from wardloom.operators.numbering import running_offsets
from wardloom.operators.prefilter import in_place, with_partner
from wardloom.session import broadcast_if_small, materialize
from wardloom.sources.text import SUFFIX, read_text_files, read_text_lines, read_text_records

LOOKUP_WIDTH = 4096  # record numbers that are looked up together


@dataclass(frozen=True)
class Corpus:
    """Records numbered ``0 .. size - 1``; ``records`` is ``(idx bigint, text string)``."""

    records: DataFrame
    size: int

    def require_records(self) -> "Corpus":
        if not self.size:
            raise ValueError("the corpus holds no record to draw from")
        return self

    def drawn(self, wanted: DataFrame) -> DataFrame:
        """The records ``(idx, text)`` of ``wanted (idx)``, which holds each number once."""
        return with_partner(self.records, materialize(wanted.select("idx"), "wanted"), "idx")

    def likely_drawn(self, wanted: DataFrame) -> tuple[DataFrame, bool]:
        """``drawn``, and whether it is just that: without it, there are records that nobody wants, for a join that the
        caller makes on numbers of its own. No text is shuffled for the numbers of the corpus."""
        return in_place(self.records, materialize(wanted.select("idx"), "wanted"), "idx")


@dataclass(frozen=True)
class CutCorpus(Corpus):
    """A corpus of whole texts that are cut when they are read: ``texts`` is ``(key, _text)``, ``placed`` is
    ``(key, offset, n)``: the number of a text's first record, and of its records."""

    texts: DataFrame
    placed: DataFrame
    key: str
    delimiter: str

    def likely_drawn(self, wanted: DataFrame) -> tuple[DataFrame, bool]:
        return self.drawn(wanted), True

    def drawn(self, wanted: DataFrame) -> DataFrame:
        """Each drawn text is cut once; texts nobody drew from are neither cut nor moved."""
        located = locate(wanted, self.placed, self.key)
        of_text = materialize(located.groupBy(self.key).agg(F.collect_list(F.struct("idx", "pos")).alias("_wanted")), "wanted")
        pieces = cut_records(F.col("_text"), self.delimiter)
        cut = with_partner(self.texts, of_text, self.key).select("_wanted", pieces.alias("_pieces"))
        picked = F.transform("_wanted", lambda w: F.struct(w["idx"].alias("idx"), F.get("_pieces", w["pos"].cast("int")).alias("text")))
        return cut.select(F.inline(picked))


def locate(wanted: DataFrame, placed: DataFrame, key: str) -> DataFrame:
    """``(idx, key, pos)``: the text that holds each wanted record, and the record's place in it.

    A range lookup by equal-width buckets of record numbers: every text leaves its first number in each bucket it
    reaches, and a wanted number takes the last text that begins before it. A bucket has at most
    ``LOOKUP_WIDTH`` numbers of either kind, and no texts are compared with all numbers.
    """
    width = LOOKUP_WIDTH
    reached = F.sequence(F.expr(f"offset div {width}"), F.expr(f"(offset + n - 1) div {width}"))
    begins = (
        placed.filter("n > 0")
        .select(F.struct(F.col(key).alias("key"), "offset").alias("_text"), "offset", F.explode(reached).alias("_bucket"))
        .select("_bucket", F.greatest("offset", F.col("_bucket") * width).alias("_at"), "_text", F.lit(None).cast("long").alias("idx"))
    )
    asked = wanted.select(F.expr(f"idx div {width}").alias("_bucket"), F.col("idx").alias("_at"), F.lit(None).cast(begins.schema["_text"].dataType).alias("_text"), "idx")
    before = Window.partitionBy("_bucket").orderBy("_at", F.col("idx").asc_nulls_first()).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    found = begins.unionByName(asked).withColumn("_text", F.last("_text", ignorenulls=True).over(before)).filter("idx is not null")
    return found.select("idx", F.col("_text.key").alias(key), (F.col("idx") - F.col("_text.offset")).alias("pos"))


def records_of(texts: DataFrame, key: str, text: str, delimiter: str) -> DataFrame:
    """``(key, pos, text)``: the non-empty records of every text, numbered from 0 within it."""
    return texts.select(key, F.posexplode(cut_records(F.col(text), delimiter)).alias("pos", "text"))


def corpus_of_texts(texts: DataFrame, key: str, text: str, delimiter: str) -> Corpus:
    """Corpus of all records of ``texts``, in order of ``key`` (unique, not NULL) and then of position.

    Only ``(key, number of records)`` is ordered and numbered. All records together are read by
    joining the texts to their offset before they are cut, so at most one row per text moves; ``drawn`` moves less.
    """
    counts = texts.groupBy(key).agg(
        F.sum(F.array_size(cut_records(F.col(text), delimiter)).cast("long")).alias("n"), F.count(F.lit(1)).alias("_texts")
    )
    placed = running_offsets(counts.withColumn("n", F.coalesce("n", F.lit(0))), [key])
    size = _size(placed, key)
    whole = texts.select(key, F.col(text).alias("_text"))
    cut = whole.join(broadcast_if_small(placed.select(key, "offset")), key)
    records = cut.select("offset", F.posexplode(cut_records(F.col("_text"), delimiter)).alias("pos", "text"))
    return CutCorpus(records.select((F.col("offset") + F.col("pos")).alias("idx"), "text"), size, whole, placed, key, delimiter)


def corpus_of_folder(spark: SparkSession, folder: str | list[str], delimiter: str, suffix: str = SUFFIX) -> Corpus:
    """Corpus of a folder of text files (or of listed files) of any size, in order of path and then of position.

    Files are read in splits. Only a delimiter that holds a newline needs the whole file in one row. The records
    are written once: read again, the files could be split, and so numbered, in another way.
    """
    if NEWLINE in delimiter and delimiter != NEWLINE:
        return corpus_of_texts(read_text_files(spark, folder, suffix), "file", "text", delimiter).require_records()
    numbered = number_records(spark, folder, delimiter, suffix)
    return Corpus(numbered.records.select("idx", "text"), numbered.size).require_records()


def number_records(spark: SparkSession, folder: str | list[str], delimiter: str, suffix: str = SUFFIX) -> Corpus:
    """A corpus whose records carry their ``file`` as well; ``delimiter`` is a newline or holds none."""
    if delimiter == NEWLINE:
        records = materialize(read_text_lines(spark, folder, suffix).withColumnRenamed("line_no", "seq"), "lines", compression="zstd")
    else:
        records = read_text_records(spark, folder, delimiter, suffix)
    blocks = ["file", "block"]  # numbers within a block rise by one
    placed = running_offsets(records.groupBy(*blocks).agg(F.count(F.lit(1)).alias("n"), F.min("seq").alias("_first")), blocks)
    joined = records.join(broadcast_if_small(placed.select(*blocks, "offset", "_first")), blocks)
    numbered = joined.select((F.col("offset") + F.col("seq") - F.col("_first")).alias("idx"), "text", "file")
    return Corpus(numbered, placed.agg(F.sum("n")).first()[0] or 0)


def _size(placed: DataFrame, key: str) -> int:
    size, texts, no_key = placed.agg(F.sum("n"), F.max("_texts"), F.count(F.when(F.col(key).isNull(), 1))).first()
    if texts and texts > 1 or no_key:
        raise ValueError("texts of a corpus need unique keys")
    return size or 0
