"""What the plans must and must not hold."""

import contextlib
import io

import pytest
from pyspark.sql import functions as F

from wardloom.plans import notes
from wardloom.plans import queries as q
from wardloom.session import broadcast_if_small, shared_dir
from wardloom.sources.incremental import Bookmark

SF_DIR = "/root/testdata/sf0.001"


def plan(df):
    out = io.StringIO()
    with contextlib.redirect_stdout(out):
        df.explain("formatted")
    return out.getvalue()


@pytest.mark.parametrize("name", ["notes_union", "sentiment_score", "corpus_index", "random_text_assign"])
def test_no_python_and_no_cross_join(spark, name):
    text = plan(q.QUERIES[name](spark, SF_DIR))
    for node in ("CartesianProduct", "BroadcastNestedLoopJoin", "EvalPython", "MapInPandas", "SinglePartition"):
        assert node not in text


def test_columns_are_pruned(spark):
    assert "ReadSchema: struct<p_name:string,p_brand:string>" in plan(q.distinct_devices(spark, SF_DIR))


def test_key_range_reaches_the_scan(spark, tmp_path):
    events = spark.read.parquet(f"{SF_DIR}/events.parquet")
    mark = Bookmark(spark, str(tmp_path), "events")
    mark.read_new(events.filter("event_id < 100"), "event_id").commit()
    assert "GreaterThan(event_id,99)" in plan(mark.read_new(events, "event_id").rows)


def test_one_label_reads_one_corpus(spark):
    kept = plan(q.filter_notes_type_query(spark, SF_DIR))
    assert kept.count("Union") < plan(q.notes_union(spark, SF_DIR)).count("Union")


def test_texts_are_partitioned_once_for_scores_and_notes(spark, monkeypatch):
    default = sorted(map(tuple, q.notes_union(spark, SF_DIR).collect()))
    monkeypatch.setattr(notes, "FEW_RECORDS", 0)
    union = q.notes_union(spark, SF_DIR)
    text = plan(union)
    assert "hashpartitioning(note" in text
    for shuffled in ("hashpartitioning(_id", "hashpartitioning(w"):
        assert shuffled not in text
    assert sorted(map(tuple, union.collect())) == default


def test_broadcast_only_below_the_bound(spark):
    small = spark.range(10).withColumn("s", F.lit("x"))
    assert "broadcast" in broadcast_if_small(small)._jdf.queryExecution().logical().toString().lower()
    assert "broadcast" not in broadcast_if_small(small, max_bytes=100)._jdf.queryExecution().logical().toString().lower()


class FakeSession:
    """A session with the given settings, on a given master."""

    def __init__(self, master, **conf):
        self.conf, self.sparkContext, self.master, self.applicationId = conf, self, master, "app"

    def getConf(self):
        return {}

    def getCheckpointDir(self):
        return None


def test_shared_dir_follows_the_setting():
    assert shared_dir(FakeSession("yarn", **{"spark.checkpoint.dir": "hdfs:///shared/"})) == "hdfs:///shared"
    with pytest.raises(ValueError, match="shared by all executors"):
        shared_dir(FakeSession("yarn"))
