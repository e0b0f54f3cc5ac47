import datetime

import duckdb
import pytest
from pyspark.sql import functions as F

from wardloom.plans import tables
from wardloom.plans.incremental import Source, load_new_files, warehouse_sources
from wardloom.sinks.jdbc import JdbcTable, drop_older_statement, upsert_statements
from wardloom.sinks.report import LoadReport
from wardloom.sinks.snapshot import SnapshotTable
from wardloom.sources.incremental import Bookmark
from wardloom.streaming.upsert import stream_upsert

NUMBERS = {"bmi", "blood_sugar", "cholesterol", "premium_cost", "deductible"}


def customers(spark):
    columns = [*tables.USER_COLUMNS, "year", "plan_type", "cancellation_reason", "premium_cost"]

    def row(**given):
        blank = {c: 1.5 if c in NUMBERS else 30 if c in ("age", "year") else "same" for c in columns}
        return tuple({**blank, "cancellation_reason": None, **given}[c] for c in columns)

    rows = [row(id=1, year=2020), row(id=1, year=2021), row(id=2, year=2020), row(id=2, year=2021, age=31), row(id=2, year=2021, age=31)]
    types = {c: "double" if c in NUMBERS else "int" if c in ("age", "year") else "bigint" if c == "id" else "string" for c in columns}
    return spark.createDataFrame(rows, ", ".join(f"{c} {t}" for c, t in types.items()))


def wearables(spark, steps=0):
    day = datetime.date(2024, 1, 1)
    rows = [(1, "m1", "b1", day, steps), (1, "m1", "b2", day, steps), (2, "m2", "b1", day, steps), (2, "m2", "b1", None, steps)]
    df = spark.createDataFrame(rows, "user_id bigint, device_id string, brand string, date date, steps int")
    return df.withColumns({c: F.lit(1) for c in tables.WATCH_FACT_COLUMNS[4:]})


def test_warehouse(spark, tmp_path):
    provider = spark.createDataFrame([(1, "p")], "id bigint, name string")
    base = str(tmp_path)

    def load():
        report = tables.load_warehouse(spark, base, customers(spark), wearables(spark), provider)
        return {r.table: (r.rows_in, r.rows_deleted, r.rows_out) for r in report.to_df().collect()}

    first = {"devices": (3, 0, 3), "watch_facts": (4, 0, 4), "users": (3, 0, 3), "renewal_history": (5, 0, 5), "provider": (1, 0, 1)}
    assert load() == first
    # The same rows again replace themselves; the fact with a NULL date matches nothing and is added.
    again = {name: (n, n, n) for name, (n, _, _) in first.items()} | {"watch_facts": (4, 3, 5)}
    assert load() == again
    facts = SnapshotTable(spark, f"{base}/watch_facts").read()
    assert facts.columns == list(tables.WATCH_FACT_COLUMNS)
    history = SnapshotTable(spark, f"{base}/renewal_history").read()
    assert history.columns == [*tables.RENEWAL_COLUMNS, "id"] and history.select("id").distinct().count() == 5


def test_random_renewal_ids_add_rows(spark, tmp_path):
    for _ in range(2):
        tables.RENEWAL_HISTORY.run(spark, str(tmp_path), tables.renewal_history(customers(spark), id_mode="random"))
    assert SnapshotTable(spark, f"{tmp_path}/renewal_history").rows() == 10


def test_report_notes_a_failure(spark):
    report = LoadReport(spark)
    with pytest.raises(RuntimeError):
        report.run("t", lambda: (_ for _ in ()).throw(RuntimeError("lost")))
    row = report.to_df().first()
    assert row.table == "t" and row.error == "lost" and row.rows_in is None


def test_bookmark(spark, tmp_path):
    keys = lambda *ids: spark.createDataFrame([(i,) for i in ids], "id bigint")
    assert Bookmark(spark, str(tmp_path), "empty").read_new(keys(), "id").upper is None
    ids = lambda df: [r.id for r in df.collect()]
    mark = Bookmark(spark, str(tmp_path), "orders")
    with pytest.raises(ValueError, match="without a id"):
        mark.read_new(keys(3, 1, None), "id")
    first = mark.read_new(keys(3, 1, None), "id", null_keys="always")
    assert sorted(map(str, ids(first.rows))) == ["1", "3", "None"] and mark.mark() is None
    assert len(ids(mark.read_new(keys(3, 1), "id").rows)) == 2  # not committed: read again
    first.commit()
    second = mark.read_new(keys(1, 5, 3, 4), "id", ordered=True)
    assert mark.mark() == "3" and ids(second.rows) == [4, 5]
    second.commit()
    for gone_back in (keys(1, 5), keys(1, 2)):  # the mark does not follow a source whose maximum has sunk
        nothing = mark.read_new(gone_back, "id")
        assert ids(nothing.rows) == []
        nothing.commit()
        assert mark.mark() == "5"
    assert ids(mark.read_new(keys(None, 6), "id", null_keys="always").rows) == [None, 6]
    assert Bookmark(spark, str(tmp_path), "other").mark() is None


def test_stream(spark, tmp_path):
    schema = "k bigint, v string"
    inbox, checkpoint = str(tmp_path / "in"), str(tmp_path / "cp")
    table = SnapshotTable(spark, str(tmp_path / "t")).create_if_absent(spark.createDataFrame([], schema))

    def drop_and_run(rows):
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(inbox)
        run()

    def run(where=checkpoint):
        stream_upsert(spark.readStream.schema(schema).parquet(inbox), table, ["k"], where, "s").awaitTermination()

    drop_and_run([(1, "a"), (2, "a")])
    drop_and_run([(2, "b"), (3, "b")])
    assert sorted(map(tuple, table.read().collect())) == [(1, "a"), (2, "b"), (3, "b")]
    version = table.version()
    run()
    assert table.version() == version  # nothing new
    assert list(table._state()[1]["applied"]["s"].values()) == [1]
    # A fresh checkpoint begins at batch 0 again; its new rows must get in all the same.
    checkpoint = str(tmp_path / "fresh")
    spark.createDataFrame([(3, "c"), (4, "c")], schema).coalesce(1).write.parquet(f"{inbox}2")
    stream_upsert(spark.readStream.schema(schema).parquet(f"{inbox}2"), table, ["k"], checkpoint, "s").awaitTermination()
    assert sorted(map(tuple, table.read().collect())) == [(1, "a"), (2, "b"), (3, "c"), (4, "c")]


def test_replayed_batch_is_skipped(spark, tmp_path):
    table = SnapshotTable(spark, str(tmp_path / "t")).create_if_absent(spark.createDataFrame([], "k bigint"))
    table.upsert(spark.range(1).select(F.col("id").alias("k")), ["k"], applied=("s", "one", 3))
    table.upsert(spark.range(1).select(F.col("id").alias("k")), ["k"], applied=("s", "two", 0))
    assert (table.applied("s", "one"), table.applied("s", "two"), table.applied("s", "three"), table.applied("other", "one")) == (3, 0, -1, -1)


def test_empty_string_in_a_partition_column(spark, tmp_path):
    df = spark.createDataFrame([(1, ""), (2, None), (3, "a/b c"), (4, "x")], "k bigint, p string")
    table = SnapshotTable(spark, str(tmp_path / "t")).create_if_absent(df, partition_by=["p"])
    table.append(df)
    assert sorted(map(tuple, table.read().collect())) == [(1, ""), (2, None), (3, "a/b c"), (4, "x")]
    counts = table.upsert(spark.createDataFrame([(1, ""), (2, None)], df.schema), ["k", "p"])
    assert (counts.rows_in, counts.rows_deleted, counts.rows_out) == (2, 1, 5)
    assert sorted(map(str, (tuple(r) for r in table.read().collect()))) == sorted(map(str, [(1, ""), (2, None), (2, None), (3, "a/b c"), (4, "x")]))


def test_load_incremental(spark, tmp_path):
    frame = lambda *rows: spark.createDataFrame(list(rows), "id bigint, v string")
    mark, report = Bookmark(spark, str(tmp_path / "marks"), "s"), LoadReport(spark)
    load = tables.TableLoad("t", ("id",))
    for rows in ([(1, "a"), (5, "a")], [(1, "b"), (2, "b")], [(5, "c"), (6, "c")]):
        table = tables.load_incremental(spark, str(tmp_path), load, mark, frame(*rows), "id", report=report)
    assert sorted(map(tuple, table.read().collect())) == [(1, "a"), (5, "a"), (6, "c")] and mark.mark() == "6"
    assert [r.rows_in for r in report.to_df().collect()] == [2, 0, 1]


def test_report_passed_in_keeps_a_failure(spark, tmp_path):
    report = LoadReport(spark)
    provider = spark.createDataFrame([(1, "p")], "id bigint, name string")
    with pytest.raises(Exception):  # noqa: B017
        tables.load_warehouse(spark, str(tmp_path), customers(spark), wearables(spark).drop("steps"), provider, report=report)
    assert [r.error is None for r in report.to_df().collect()] == [True]


class FakeConnection:
    """Stands in for a JDBC connection: writes down what is asked of it, and has an answer to every question."""

    def __init__(self, fail=(), known=(), no_ledger=False):
        self.calls, self.fail, self.known, self.no_ledger = [], fail, known, no_ledger

    def __getattr__(self, name):
        return lambda *args: self.calls.append(name)

    def createStatement(self):
        return self

    def executeUpdate(self, sql):
        self.calls.append(" ".join(sql.split()[:3]) if sql.startswith("INSERT") else sql.split()[0])
        if any(sql.startswith(f) for f in self.fail):
            raise RuntimeError("refused")
        return 2

    def executeQuery(self, sql):
        if "COUNT" in sql:
            return Answer(7)
        if self.no_ledger:
            raise RuntimeError("no such table")
        return Answer(any(f"'{name}'" in sql for name in self.known))


class Answer:
    def __init__(self, value):
        self.value = value

    def next(self):
        return self.value

    def getLong(self, _):
        return self.value


def jdbc_table(spark, monkeypatch, connection):
    table = JdbcTable(spark, "jdbc:x:", "public.users", connect=lambda: connection)
    monkeypatch.setattr(table, "_write", lambda df, name, mode: connection.calls.append(f"write {name[:20]} {mode} {df.columns}"))
    return table


STAGED = "write public.users_staging overwrite ['id', 'load_partition', 'load_attempt']"
INTO = "INSERT INTO public.users"
NOTED = "INSERT INTO wardloom_loads"


def test_jdbc_upsert_is_one_transaction(spark, monkeypatch):
    connection = FakeConnection()
    counts = jdbc_table(spark, monkeypatch, connection).upsert(spark.range(1), ["id"])
    assert (counts.rows_in, counts.rows_deleted, counts.rows_out) == (2, 2, 7)
    assert connection.calls == ["setAutoCommit", STAGED, "DELETE", INTO, NOTED, "commit", "DROP", "commit", "close"]


def test_jdbc_append_is_one_transaction(spark, monkeypatch):
    connection = FakeConnection(no_ledger=True)
    counts = jdbc_table(spark, monkeypatch, connection).append(spark.range(1))
    assert (counts.rows_in, counts.rows_deleted, counts.rows_out) == (2, 0, 7)
    assert connection.calls == ["setAutoCommit", "rollback", "CREATE", "commit", STAGED, INTO, NOTED, "commit", "DROP", "commit", "close"]


@pytest.mark.parametrize("refused", [INTO, NOTED, "DELETE"])
def test_jdbc_failure_rolls_back_and_drops_staging(spark, monkeypatch, refused):
    """Of two runs of one load, the second is refused its row in the ledger, and takes its rows back."""
    connection = FakeConnection(fail=[refused])
    with pytest.raises(RuntimeError, match="refused"):
        jdbc_table(spark, monkeypatch, connection).upsert(spark.range(1), ["id"], load_id="l")
    assert connection.calls[-4:] == ["rollback", "DROP", "commit", "close"] and "commit" not in connection.calls[:-4]


def test_jdbc_load_is_done_once(spark, monkeypatch):
    connection = FakeConnection(known=["monday"])
    table = jdbc_table(spark, monkeypatch, connection)
    assert table.append(spark.range(1), load_id="monday").rows_in == 0
    assert connection.calls == ["setAutoCommit", "close"]
    assert table.append(spark.range(1), load_id="tuesday").rows_in == 2


def test_jdbc_staging_tables_of_two_runs_differ(spark, monkeypatch):
    names = []
    table = JdbcTable(spark, "jdbc:x:", "t", connect=FakeConnection)
    monkeypatch.setattr(table, "_write", lambda df, name, mode: names.append(name))
    table.append(spark.range(1))
    table.append(spark.range(1))
    assert len(set(names)) == 2


def test_jdbc_statements():
    delete, insert = upsert_statements("t", "t_staging", ["user_id", "date"], ["user_id", "date", 'o"x'])
    assert delete == 'DELETE FROM t WHERE EXISTS (SELECT 1 FROM t_staging s WHERE s."user_id" = t."user_id" AND s."date" = t."date")'
    assert insert == (
        'INSERT INTO t ("user_id", "date", "o""x") SELECT "user_id", "date", "o""x" FROM t_staging s WHERE s."load_attempt" = '
        '(SELECT MIN(f."load_attempt") FROM t_staging f WHERE f."load_partition" = s."load_partition")'
    )


def test_jdbc_statements_take_one_attempt_and_newer_rows(spark):
    """The statements themselves, run by the engine that runs the SQL of the queries."""
    db = duckdb.connect()
    db.execute("CREATE TABLE t AS SELECT * FROM (VALUES (1, 10, 'held'), (2, 10, 'held'), (3, NULL, 'held'), (NULL, 1, 'held')) v(k, n, s)")
    db.execute("""CREATE TABLE st AS SELECT * FROM (VALUES (1, 9, 'old', 0, 5), (2, 10, 'same', 0, 5), (3, 1, 'new', 1, 8), (3, 1, 'new', 1, 6),
      (4, NULL, 'none', 2, 7), (NULL, 5, 'no key', 2, 7), (4, NULL, 'none', 2, 9), (NULL, 5, 'no key', 2, 9)) v(k, n, s, load_partition, load_attempt)""")
    for sql in (drop_older_statement("t", "st", ["k"], "n"), *upsert_statements("t", "st", ["k"], ["k", "n", "s"])):
        db.execute(sql)
    rows = sorted(map(str, db.execute("SELECT * FROM t").fetchall()))
    assert rows == sorted(map(str, [(1, 10, "held"), (2, 10, "same"), (3, 1, "new"), (4, None, "none"), (None, 1, "held"), (None, 5, "no key")]))


def test_attempts_are_told_apart(spark, monkeypatch):
    written = []
    table = JdbcTable(spark, "jdbc:x:", "t", connect=FakeConnection)
    monkeypatch.setattr(table, "_write", lambda df, name, mode: written.extend(df.collect()))
    for _ in range(2):
        table.append(spark.range(0, 100, 1, 4).toDF("id"))
    attempts = [{r.load_attempt for r in written[i : i + 100]} for i in (0, 100)]
    assert all(attempts) and not attempts[0] & attempts[1]
    by_partition = {(i // 100, r.load_partition, r.load_attempt) for i, r in enumerate(written)}
    assert len(by_partition) == len({(run, part) for run, part, _ in by_partition})


def test_warehouse_in_a_database(spark, monkeypatch):
    """All five tables through the same interface, each in a target opened by name."""
    opened = []

    def database(name):
        opened.append(name)
        table = JdbcTable(spark, "jdbc:x:", f"public.{name}", connect=FakeConnection)
        monkeypatch.setattr(table, "_write", lambda df, name, mode: None)
        return table

    provider = spark.createDataFrame([(1, "p")], "id bigint, name string")
    report = tables.load_warehouse(spark, database, customers(spark), wearables(spark), provider)
    assert opened == ["devices", "watch_facts", "users", "renewal_history", "provider"]
    assert [(r.rows_in, r.rows_deleted, r.rows_out) for r in report.to_df().collect()] == [(2, 2, 7)] * 5


# -- the incremental job ---------------------------------------------------------------------


def test_incremental_warehouse(spark, tmp_path):
    """The job's own sources: a new day of a known user, an old file that comes late, a replay through fresh checkpoints."""
    inbox, base = str(tmp_path / "in"), str(tmp_path / "dw")
    provider = spark.createDataFrame([(1, "p")], "id bigint, name string")

    def day(number, steps):
        return wearables(spark, steps).withColumn("date", F.date_add(F.lit(datetime.date(2024, 1, 1)), number))

    with_number = lambda df, n: df.withColumn("load_no", F.lit(n))
    schemas = [with_number(df, 0).schema for df in (customers(spark), wearables(spark), provider)]

    def drop(number, **frames):
        for name, df in frames.items():
            df.write.parquet(f"{inbox}/{name}/load_no={number}")

    def run(checkpoints):
        sources = warehouse_sources(inbox, *schemas, order_by="load_no")
        report = load_new_files(spark, base, sources, str(tmp_path / checkpoints))
        return [(r.table, r.rows_in) for r in report.to_df().collect()]

    def state():
        facts = SnapshotTable(spark, f"{base}/watch_facts").read().select("user_id", F.col("date").cast("string"), "steps", "load_no")
        users = SnapshotTable(spark, f"{base}/users").read().select("id", "age", "load_no")
        ids = SnapshotTable(spark, f"{base}/renewal_history").read().select("id", "load_no")
        return [sorted(map(tuple, df.collect())) for df in (facts, users, ids)]

    drop(2, customers=customers(spark), wearables=day(0, 5), provider=provider)
    assert run("one")
    drop(3, customers=customers(spark).filter("id = 2"), wearables=day(1, 6), provider=provider.limit(0))
    run("one")
    facts = state()[0]
    assert len(facts) == 8 and {f[1:] for f in facts} == {("2024-01-01", 5, 2), ("2024-01-02", 6, 3)}
    drop(1, customers=customers(spark).withColumn("age", F.lit(99)), wearables=day(0, 4), provider=provider)
    run("one")
    assert state()[0] == facts and 99 not in {age for _, age, _ in state()[1]}
    before = state()
    assert run("one") == []
    run("fresh")
    assert state() == before


def test_batch_is_skipped_by_the_tables_that_have_it(spark, tmp_path, monkeypatch):
    """A run that fails between two tables of a source loads the second one when it is repeated, and only that."""
    frame = spark.createDataFrame([(1, "a", 1)], "k long, v string, load_no int")
    frame.write.parquet(str(tmp_path / "in"))
    fail = [True]

    def second(df):
        if fail[0]:
            raise RuntimeError("lost")
        return df

    loads = ((tables.TableLoad("first", ("k",)), lambda df: df), (tables.TableLoad("second", ("k",)), second))
    source = Source("s", str(tmp_path / "in"), frame.schema, loads)
    with pytest.raises(Exception, match="lost"):
        load_new_files(spark, str(tmp_path / "dw"), [source], str(tmp_path / "cp"))
    fail[0] = False
    report = load_new_files(spark, str(tmp_path / "dw"), [source], str(tmp_path / "cp"))
    assert [(r.table, r.rows_in, r.rows_out) for r in report.to_df().collect()] == [("second", 1, 1)]
    assert [SnapshotTable(spark, str(tmp_path / "dw" / name)).rows() for name in ("first", "second")] == [1, 1]
