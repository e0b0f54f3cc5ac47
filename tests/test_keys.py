import re

from pyspark.sql import functions as F

from wardloom.functions.keys import hash_pick, provider_pick, random_id, surrogate_id
from wardloom.operators.numbering import EXPAND_CHUNK, number_equal_rows, running_offsets
from wardloom.operators.picks import assign_key


def test_surrogate_ids_tell_rows_apart(spark):
    rows = [("a", None), (None, "a"), ("a|b", "c"), ("a", "b|c"), ("", None), (None, ""), ("-", None)]
    df = spark.createDataFrame(rows, "x string, y string").select(surrogate_id([F.col("x"), F.col("y")]).alias("id"))
    ids = [r.id for r in df.collect()]
    assert len(set(ids)) == len(rows)
    assert all(re.fullmatch("[0-9a-f]{32}", i) for i in ids)
    assert ids == [r.id for r in df.collect()]


def test_random_ids(spark):
    ids = {r.id for r in spark.range(500).select(random_id().alias("id")).collect()}
    assert len(ids) == 500 and all(re.fullmatch("[0-9a-f]{32}", i) for i in ids)


def test_picks_are_uniform_and_repeatable(spark):
    df = spark.range(20_000).select("id", hash_pick([F.col("id")], "salt", 10).alias("pick"))
    counts = {r.pick: r["count"] for r in df.groupBy("pick").count().collect()}
    assert set(counts) == set(range(10)) and all(1700 < n < 2300 for n in counts.values())
    other = spark.range(20_000).select(hash_pick([F.col("id")], "other", 10).alias("pick"))
    assert other.collect() != df.select("pick").collect()


def test_providers_are_numbers_in_range(spark):
    df = spark.range(30_000).select(provider_pick([F.col("id")], "p").alias("p"))
    low, high, n = df.agg(F.min("p"), F.max("p"), F.count_distinct("p")).first()
    assert (low, high, n) == (1, 2000, 2000)
    assert df.schema["p"].dataType.simpleString() == "bigint"


def test_keys_from_a_table(spark):
    keys = spark.createDataFrame([(7,), (9,), (9,), (None,)], "id long")
    drawn = assign_key(spark.range(200), ["id"], "s", keys, "id", "provider_id")
    assert {r.provider_id for r in drawn.collect()} == {7, 9} and drawn.count() == 200


def test_number_equal_rows_with_a_hot_row(spark):
    hot = EXPAND_CHUNK * 2 + 3
    df = spark.range(hot).select(F.lit("hot").alias("k"), F.lit(None).cast("int").alias("v")).union(
        spark.createDataFrame([("a", 1), ("a", 1), ("b", 2)], "k string, v int")
    )
    numbered = number_equal_rows(df)
    assert numbered.count() == hot + 3
    stats = {r.k: (r.n, r.lo, r.hi) for r in numbered.groupBy("k").agg(
        F.count_distinct("occurrence").alias("n"), F.min("occurrence").alias("lo"), F.max("occurrence").alias("hi")
    ).collect()}
    assert stats == {"hot": (hot, 0, hot - 1), "a": (2, 0, 1), "b": (1, 0, 0)}


def test_running_offsets(spark):
    df = spark.range(1000).select(F.format_string("%04d", (F.col("id") * 7) % 1000).alias("k"), (F.col("id") % 5).alias("n"))
    rows = sorted((r.k, r.n, r.offset) for r in running_offsets(df, ["k"]).collect())
    total = 0
    for _, n, offset in rows:
        assert offset == total
        total += n
    assert len(rows) == 1000


def test_running_offsets_of_nothing(spark):
    assert running_offsets(spark.createDataFrame([], "k string, n long"), ["k"]).count() == 0
