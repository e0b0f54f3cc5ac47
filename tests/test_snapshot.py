import os
from collections import Counter

import pytest
from pyspark.sql import functions as F

from wardloom.plans.tables import TableLoad
from wardloom.session import Intermediates, is_small, materialize, shared_dir
from wardloom.sinks.snapshot import SnapshotTable
from wardloom.sources.versions import CommitConflict

SCHEMA = "k int, d string, v string"


def frame(spark, rows):
    return spark.createDataFrame(rows, SCHEMA)


def bag(df):
    return Counter(tuple(r) for r in df.collect())


def model(target, staged, key):
    """Replace by key; a key with a NULL part matches nothing."""
    keys = {key(r) for r in staged if None not in key(r)}
    return Counter([r for r in target if key(r) not in keys] + staged)


TARGET = [(1, "a", "x"), (1, "a", "y"), (2, "b", "x"), (3, None, "x"), (None, "a", "n"), (4, "c/1 %", "q")]
STAGED = [(1, "a", "new"), (1, "b", "new"), (1, "b", "twin"), (None, "a", "n2"), (4, "c/1 %", "new"), (9, "z", "z")]


@pytest.mark.parametrize("keys", [["k"], ["k", "d"]])
@pytest.mark.parametrize("partition_by,bucket_by", [([], []), (["d"], []), ([], ["k"]), (["d"], ["k"]), ([], ["v", "d"])])
def test_upsert(spark, tmp_path, keys, partition_by, bucket_by):
    table = SnapshotTable(spark, str(tmp_path / "t")).create_if_absent(frame(spark, TARGET), partition_by, bucket_by, 3 if bucket_by else 0)
    table.append(frame(spark, TARGET))
    counts = table.upsert(frame(spark, STAGED), keys)
    wanted = model(TARGET, STAGED, lambda r: tuple(r[("k", "d", "v").index(k)] for k in keys))
    assert bag(table.read()) == wanted
    assert counts.rows_in == len(STAGED) and counts.rows_out == sum(wanted.values()) == table.rows()
    assert counts.rows_out == len(TARGET) - counts.rows_deleted + len(STAGED)
    again = [r for r in STAGED if None not in r]
    table.upsert(frame(spark, again), keys)
    once = bag(table.read())
    table.upsert(frame(spark, again), keys)
    assert bag(table.read()) == once


def test_only_touched_folders_are_rewritten(spark, tmp_path):
    table = SnapshotTable(spark, str(tmp_path / "t")).create_if_absent(frame(spark, []), ["d"])
    table.append(frame(spark, [(i, d, "x") for d in "abc" for i in range(5)]))
    before = set(table._state()[1]["dirs"])
    table.upsert(frame(spark, [(1, "b", "new"), (77, "c", "new")]), ["k", "d"])
    after = set(table._state()[1]["dirs"])
    assert {d.split("/")[1] for d in before - after} == {"part_of_d=.b"}
    assert table.rows() == table.read().count() == 16


def test_versions_and_expiry(spark, tmp_path):
    table = SnapshotTable(spark, str(tmp_path / "t")).create_if_absent(frame(spark, []))
    table.create_if_absent(frame(spark, []))
    assert table.version() == 1 and table.read().count() == 0
    table.append(frame(spark, [(1, "a", "x")]))
    table.upsert(frame(spark, [(1, "a", "y")]), ["k"])
    table.upsert(frame(spark, [(1, "a", "z")]), ["k"])
    assert bag(table.read(2)) == Counter([(1, "a", "x")])
    assert table.expire(keep=2) == 1
    assert bag(table.read()) == Counter([(1, "a", "z")]) and bag(table.read(3)) == Counter([(1, "a", "y")])


def test_failed_load_leaves_no_trace(spark, tmp_path):
    table = SnapshotTable(spark, str(tmp_path / "t")).create_if_absent(frame(spark, []))
    table.append(frame(spark, [(1, "a", "x")]))
    broken = frame(spark, [(1, "a", "y")]).withColumn("v", F.raise_error(F.lit("boom")).cast("string"))
    with pytest.raises(Exception, match="boom"):
        table.upsert(broken, ["k"])
    assert bag(table.read()) == Counter([(1, "a", "x")]) and table.version() == 2


def test_two_writers(spark, tmp_path):
    table = SnapshotTable(spark, str(tmp_path / "t")).create_if_absent(frame(spark, []))
    with pytest.raises(CommitConflict):
        table._log.commit(1, {})
    assert not [n for n in os.listdir(tmp_path / "t" / "versions") if not n.endswith((".json", ".crc"))]


def test_columns_go_by_name(spark, tmp_path):
    table = SnapshotTable(spark, str(tmp_path / "t")).create_if_absent(frame(spark, []))
    table.append(frame(spark, [(1, "a", "x")]).select("v", "k", "d"))
    assert bag(table.read()) == Counter([(1, "a", "x")])
    with pytest.raises(ValueError, match="columns differ"):
        table.append(frame(spark, []).withColumn("k", F.col("k").cast("long")))


def test_duplicate_policies(spark, tmp_path):
    table = SnapshotTable(spark, str(tmp_path / "t")).create_if_absent(frame(spark, []))
    staged = frame(spark, [(1, "a", "x"), (1, "b", "y"), (None, "c", "n"), (None, "d", "n")])
    with pytest.raises(ValueError, match="share a key"):
        table.upsert(staged, ["k"], on_duplicate="error")
    table.upsert(staged, ["k"], on_duplicate="last", order_by="d")
    assert bag(table.read()) == Counter([(1, "b", "y"), (None, "c", "n"), (None, "d", "n")])
    table.upsert(staged, ["k"])
    assert table.read().filter("k = 1").count() == 2


def test_one_key_rewrites_one_bucket(spark, tmp_path, monkeypatch):
    table = SnapshotTable(spark, str(tmp_path / "t")).create_if_absent(frame(spark, []), bucket_by=["k"], buckets=8)
    table.append(frame(spark, [(i, "a", "x") for i in range(200)]))
    before = set(table._state()[1]["dirs"])
    assert len(before) == 8
    scanned = []
    scan = table._scan
    monkeypatch.setattr(table, "_scan", lambda dirs, schema: scanned.append(set(dirs)) or scan(dirs, schema))
    counts = table.upsert(frame(spark, [(77, "a", "new")]), ["k"])
    after = set(table._state()[1]["dirs"])
    gone = before - after
    assert len(gone) == 1 and (counts.rows_in, counts.rows_deleted, counts.rows_out) == (1, 1, 200)
    assert set().union(*scanned) & before == gone  # and no other bucket was read
    assert bag(table.read()) == Counter([(i, "a", "new" if i == 77 else "x") for i in range(200)])


def test_buckets_follow_the_key_not_the_load(spark, tmp_path):
    """A bucket by part of the key still tells folders apart; one by other columns does not."""
    for bucket_by, rewritten in ((["k"], 1), (["v"], 2)):
        table = SnapshotTable(spark, str(tmp_path / bucket_by[0])).create_if_absent(frame(spark, []), bucket_by=bucket_by, buckets=64)
        table.append(frame(spark, [(5, "a", "x"), (5, "a", "y"), (6, "b", "z")]))
        before = set(table._state()[1]["dirs"])
        table.upsert(frame(spark, [(5, "a", "new")]), ["k", "d"])
        assert len(before - set(table._state()[1]["dirs"])) == rewritten
        assert bag(table.read()) == Counter([(5, "a", "new"), (6, "b", "z")])


def test_newest_stands_whatever_comes_last(spark, tmp_path):
    drops = [[(1, "b", "x"), (1, "b", "y"), (2, "a", "x"), (None, "a", "n")], [(1, "a", "old"), (2, "b", "new"), (3, None, "p"), (4, "c", "q")], [(3, "a", "r"), (4, None, "s"), (1, "b", "z")]]
    wanted = {0: [(1, "b", "z")], 1: [(1, "b", "x"), (1, "b", "y")]}
    for name, order in (("forth", drops), ("back", drops[::-1])):
        table = SnapshotTable(spark, str(tmp_path / name)).create_if_absent(frame(spark, []), bucket_by=["k"], buckets=4)
        for rows in order:
            table.upsert(frame(spark, rows), ["k"], on_duplicate="newest", order_by="d")
        last = wanted[0 if name == "forth" else 1]
        assert bag(table.read()) == Counter([*last, (2, "b", "new"), (3, "a", "r"), (4, "c", "q"), (None, "a", "n")])
        assert table.rows() == table.read().count()


def test_counts_come_from_the_write(spark, tmp_path, monkeypatch):
    """An append reads nothing back, also when it is empty."""
    table = SnapshotTable(spark, str(tmp_path / "t")).create_if_absent(frame(spark, []), ["d"])
    monkeypatch.setattr(table, "_scan", lambda *args: pytest.fail("read back"))
    assert table.append(frame(spark, [(i, "ab"[i % 2], "x") for i in range(1000)])).rows_in == 1000
    assert table.append(frame(spark, []).filter("k > 3")).rows_in == 0 and table.rows() == 1000


def test_loads_leave_nothing_in_the_shared_folder(spark, tmp_path):
    def working_files():
        return {d for d in os.listdir(shared_dir(spark)) if not d.startswith("warehouse")}

    before = working_files()
    spec = TableLoad("t", ("k",), buckets=4, on_duplicate="newest", order_by="d")
    for rows in ([(1, "a", "x"), (2, "a", "y")], [(1, "b", "z")]):
        spec.run(spark, str(tmp_path), frame(spark, rows))
    assert working_files() == before


def test_owner_keeps_what_is_still_read(spark):
    with Intermediates(spark) as outer:
        with Intermediates(spark) as inner:
            used, unused = materialize(spark.range(5), "used"), materialize(spark.range(5), "unused")
            result = used.filter("id > 2")
            inner.keep(result)
        assert result.count() == 2 and not os.path.exists(unused.inputFiles()[0].removeprefix("file://"))
        outer.release(result)
        assert result.count() == 2
    assert not os.path.exists(used.inputFiles()[0].removeprefix("file://"))


def test_width_counts_what_nested_values_hold(spark):
    df = spark.range(100).select(F.array_repeat(F.lit(1), 1000).alias("a"), F.create_map(F.lit("k"), F.struct(F.array(F.lit("x" * 500)).alias("s"))).alias("m"), F.lit(None).cast("array<string>").alias("n"))
    assert is_small(df, 3_000_000) and not is_small(df.select("a"), 1_500_000) and not is_small(df.select("m"), 50_000) and is_small(df.select("n"), 5_000)


def test_newest_into_an_empty_table_writes_no_staged_copy(spark, tmp_path, monkeypatch):
    rows = spark.createDataFrame([(1, 1, "old"), (1, 2, "new"), (None, 1, "none")], "k int, load_no int, v string")
    table = SnapshotTable(spark, str(tmp_path / "t")).create_if_absent(rows, bucket_by=["k"], buckets=2)
    written = []
    monkeypatch.setattr("wardloom.sinks.snapshot.materialize", lambda df, label: written.append(label) or materialize(df, label))
    assert table.upsert(rows, ["k"], "newest", "load_no").rows_in == 2
    assert not written
    table.upsert(rows.filter("v = 'old'"), ["k"], "newest", "load_no")
    assert "staged" in written
    assert {(r.k, r.v) for r in table.read().collect()} == {(1, "new"), (None, "none")}


def test_equal_texts_side_by_side_are_kept_once(spark, tmp_path):
    """A load whose rows carry a few long texts many times takes little more than the texts."""
    texts = spark.range(60).selectExpr("id", "concat_ws(' ', transform(sequence(1, 200), i -> md5(concat(id, '-', i)))) text")
    rows = texts.selectExpr("id", "text", "explode(sequence(1, 50)) copy").repartition(1).sortWithinPartitions("id", "copy")
    rows.write.parquet(str(tmp_path / "plain"), compression="snappy")
    table = SnapshotTable(spark, str(tmp_path / "t")).create_if_absent(rows)
    table.append(rows)
    size = lambda folder: sum(f.stat().st_size for f in folder.rglob("*.parquet"))
    assert size(tmp_path / "t") < 60 * 200 * 33 < size(tmp_path / "plain") and table.read().count() == 3000
