"""Folders of text files, read by the executors."""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from wardloom.session import materialize

SUFFIX = ".txt"  # fixed value: only files with this ending (case counts) hold records


def _path() -> Column:
    """The file's path as it is listed; the metadata column has it URL-encoded, in another order."""
    return F.url_decode(F.replace(F.col("_metadata.file_path"), F.lit("+"), F.lit("%2B")))


def with_suffix(df: DataFrame, column: str, suffix: str = SUFFIX) -> DataFrame:
    """Keep rows whose object name ends with ``suffix``."""
    return df.filter(F.col(column).endswith(suffix))


def list_text_files(spark: SparkSession, folder: str, suffix: str = SUFFIX) -> DataFrame:
    """``(file)``: the matching files at any depth; none of them is opened."""
    return (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", "true")
        .option("pathGlobFilter", f"*{suffix}")
        .load(folder)
        .select(_path().alias("file"))
    )


def as_written(file: str) -> str:
    """A path that stands for this one file where a pattern is expected."""
    return re.sub(r"([\\{}\[\]*?])", r"\\\1", file)


def read_text_files(spark: SparkSession, folder: str | list[str], suffix: str = SUFFIX) -> DataFrame:
    """``(file, text)``: one row per matching file at any depth, with its whole content as UTF-8."""
    return (
        spark.read.option("recursiveFileLookup", "true")
        .option("pathGlobFilter", f"*{suffix}")
        .text(folder, wholetext=True)
        .select(_path().alias("file"), F.col("value").alias("text"))
    )


def read_text_lines(spark: SparkSession, folder: str | list[str], suffix: str = SUFFIX) -> DataFrame:
    """``(file, block, line_no, text)``: the non-empty lines of matching files, for files of any size.

    Large files are read in several splits; ``block`` is the split's start and ``line_no`` rises
    within it, so ``(file, block, line_no)`` is the order in the folder. Only ``\\n`` ends a line. Where the
    splits fall is decided each time the rows are read: numbers of two reads do not fit together.
    """
    return (
        spark.read.option("recursiveFileLookup", "true")
        .option("pathGlobFilter", f"*{suffix}")
        .text(folder, lineSep="\n")
        .filter(F.col("value") != "")
        .select(
            _path().alias("file"),
            F.col("_metadata.file_block_start").alias("block"),
            F.monotonically_increasing_id().alias("line_no"),
            F.col("value").alias("text"),
        )
    )


CUT_SCHEMA = "file string, block long, seq long, text string, opens boolean, closes boolean, bytes long, size long"
BATCH_BYTES = 4 << 20


def _cutter(delimiter: bytes):
    """Cut the lines of every split at ``delimiter``, and say which pieces begin or end beyond the split."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        here, size, parts, opens, seq, read = None, 0, [], False, 0, 0
        out: list[tuple] = []
        held = 0

        def piece(opens: bool, closes: bool) -> None:
            nonlocal seq, held
            text = b"\n".join(parts)
            if text or not (opens and closes):
                out.append((*here, seq if opens else None, text.decode("utf-8", "replace"), opens, closes, 0 if closes else read, size))
                held += len(text)
                seq += opens

        def batch_of() -> pa.RecordBatch:
            kinds = [pa.string(), pa.int64(), pa.int64(), pa.string(), pa.bool_(), pa.bool_(), pa.int64(), pa.int64()]
            names = ["file", "block", "seq", "text", "opens", "closes", "bytes", "size"]
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out, strict=True), kinds, strict=True)], names=names)

        for batch in batches:
            for file, block, file_size, line in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if (file, block) != here:
                    if here is not None:
                        piece(opens, False)
                    here, size, parts, opens, seq, read = (file, block), file_size, [], block == 0, 0, 0
                read += len(line) + 1
                pieces = line.split(delimiter)
                for text in pieces[:-1]:
                    parts.append(text)
                    piece(opens, True)
                    parts, opens = [], True
                parts.append(pieces[-1])
                if held > BATCH_BYTES:
                    yield batch_of()
                    out, held = [], 0
        if here is not None:
            piece(opens, False)
        if out:
            yield batch_of()

    return cut


def read_text_records(spark: SparkSession, folder: str | list[str], delimiter: str, suffix: str = SUFFIX) -> DataFrame:
    """``(file, block, seq, text)``: the non-empty records between literal delimiters, for files of any size.

    ``delimiter`` holds no newline, so an occurrence lies within a line, and a line is read whole even if it
    crosses the end of a split: each line's runs of delimiter characters are cut as a cut of the whole file would
    cut them. Every split reports its records, and its first and last piece, which may go on in other
    splits; only those pieces are carried over and joined. ``block`` is the split where a record begins; ``seq`` counts
    within it from 0. A record has to fit in a row; a byte order mark is dropped. The result reads what has been written
    once: the cut texts, and apart from them the few that had to be joined.
    """
    if "\n" in delimiter or not delimiter:
        raise ValueError("the delimiter must not be empty or hold a newline")
    lines = (
        spark.read.option("recursiveFileLookup", "true")
        .option("pathGlobFilter", f"*{suffix}")
        .text(folder, lineSep="\n")
        .select(
            _path().alias("file"),
            F.col("_metadata.file_block_start").alias("block"),
            F.col("_metadata.file_size").alias("size"),
            F.col("value").cast("binary").alias("line"),
        )
    )
    cut = materialize(lines.mapInArrow(_cutter(delimiter.encode()), CUT_SCHEMA), "records", compression="zstd")
    whole = cut.filter("opens and closes").select("file", "block", "seq", "text")

    # A few pieces per split are left. Lines end in a newline each, but for the last line of some files: the
    # sizes tell. In a split, the piece that closes an earlier record comes before the one that stays open.
    order = Window.partitionBy("file").orderBy("block", F.desc("closes"))
    ends = F.col("size") - F.sum("bytes").over(Window.partitionBy("file"))
    last = F.lead("block").over(order).isNull()
    pieces = cut.filter("not (opens and closes)").select(
        "file", "block", "seq", "opens", "closes",
        F.sum(F.col("opens").cast("long")).over(order).alias("record"),
        F.when(last & ends.isin(0, 3), F.concat("text", F.lit("\n"))).otherwise(F.col("text")).alias("text"),
    )
    parts = F.sort_array(F.collect_list(F.struct("block", (~F.col("closes")).alias("after"), "text")))
    joined = pieces.groupBy("file", "record").agg(F.min("block").alias("block"), F.max("seq").alias("seq"), F.array_join(F.transform(parts, lambda p: p["text"]), "\n").alias("text"))
    return whole.unionByName(materialize(joined.filter("text <> ''").select(*whole.columns), "joined-records", compression="zstd"))
