"""The documents through five stages: quality rules, line dedup, near-duplicate documents, source mix, packing.

Every stage works on all rows its predecessor kept and returns the columns of ``documents``; the last
returns the pieces of packed sequences. ``run`` writes each stage to the shared folder and rereads it.

Documents with a NULL text, lang, source or id, with empty or very long texts, ties and repeated rows go through all
stages by the rules of the operators (their modules state them): NULL and empty texts fail the first one; equal
texts are near duplicates of each other, of which one stays; an empty table gives no pieces. Columns beside those of
``documents`` are carried along.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

from pyspark.sql import DataFrame, SparkSession

from wardloom.llm.best_fit_packing import pack_documents
from wardloom.llm.common import table
from wardloom.llm.line_dedup import without_repeated_lines
from wardloom.llm.ngram_join import keep_one_of_each
from wardloom.llm.quality_rules import keep_good
from wardloom.llm.source_mix import mix_sources
from wardloom.session import Intermediates, materialize

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


#: By application: what the stage that ran last has written for its result, which is read only once it is returned.
_unread: dict[str, Intermediates] = {}


def _stage(work: Stage) -> Stage:
    """A stage whose intermediate files are deleted: those its result does not read at once, the others when the next stage
    starts on something else than them, since by then the result has been written."""

    @wraps(work)
    def stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        application = spark.sparkContext.applicationId
        if application in _unread:
            _unread.pop(application).release(docs)
        with Intermediates(spark) as owned:
            result = work(spark, docs, sf_dir)
            owned.keep(result)
        _unread[application] = owned
        return result

    return stage


@_stage
def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return keep_good(docs, table(spark, sf_dir, "labels"))


@_stage
def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return without_repeated_lines(docs)


@_stage
def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return keep_one_of_each(docs)


@_stage
def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mix_sources(docs).documents()


@_stage
def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return pack_documents(docs)


STAGES = [
    ("quality rules", quality),
    ("line dedup", lines),
    ("n-gram Jaccard join", near_duplicates),
    ("source mix", mix),
    ("best-fit packing", packing),
]

#: None: SQL cannot learn rules, draw the mix or run the tokenizer.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, before = table(spark, sf_dir, "documents"), None
    for name, stage in STAGES[:-1]:
        with Intermediates(spark) as owned:
            docs = materialize(stage(spark, docs, sf_dir), name.replace(" ", "-"))
            owned.keep(docs)
        if before:
            before.release(docs)
        before = owned
    return STAGES[-1][1](spark, docs, sf_dir)
