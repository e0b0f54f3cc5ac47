"""Warehouse tables over JDBC: create-if-absent, append, and staged upsert, each in one transaction.

A load goes through a staging table of its own: the executors fill it, then the database moves its rows into
the target in one transaction, together with a row in a ledger of loads. So a target shows all of a load or
nothing; a load that is repeated under its id is skipped; and a task that Spark runs twice, because its executor was lost
after the commit, adds its rows once: rows carry their partition and the attempt that wrote them, and one
attempt of every partition is taken.
"""

from __future__ import annotations

import logging
import uuid
from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass, field

import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wardloom.session import Intermediates, materialize
from wardloom.sinks.snapshot import LoadCounts, resolve_duplicates

log = logging.getLogger(__name__)

PARTITION, ATTEMPT = "load_partition", "load_attempt"  # columns of a staging table beside the target's


def quoted(name: str, mark: str = '"') -> str:
    """A possibly qualified name with each part quoted, as Spark creates its columns."""
    return ".".join(mark + part.replace(mark, mark * 2) + mark for part in name.split("."))


def text(value: str) -> str:
    return "'" + value.replace("'", "''") + "'"


def insert_statement(target: str, staging: str, columns: Sequence[str], mark: str = '"') -> str:
    """Insert the staged rows, by column name, of the first attempt that wrote each partition."""
    names = ", ".join(quoted(c, mark) for c in columns)
    part, attempt = quoted(PARTITION, mark), quoted(ATTEMPT, mark)
    first = f"SELECT MIN(f.{attempt}) FROM {staging} f WHERE f.{part} = s.{part}"
    return f"INSERT INTO {target} ({names}) SELECT {names} FROM {staging} s WHERE s.{attempt} = ({first})"


def upsert_statements(target: str, staging: str, keys: Sequence[str], columns: Sequence[str], mark: str = '"') -> list[str]:
    """Delete the target rows whose key is staged, then insert every staged row.

    Equality never holds for NULL, so NULL keys delete nothing.
    """
    same = " AND ".join(f"s.{quoted(k, mark)} = {target}.{quoted(k, mark)}" for k in keys)
    return [
        f"DELETE FROM {target} WHERE EXISTS (SELECT 1 FROM {staging} s WHERE {same})",
        insert_statement(target, staging, columns, mark),
    ]


def drop_older_statement(target: str, staging: str, keys: Sequence[str], order_by: str, mark: str = '"') -> str:
    """Delete staged rows whose key the target holds with a higher ``order_by``; NULL is lowest."""
    same = " AND ".join(f"t.{quoted(k, mark)} = {staging}.{quoted(k, mark)}" for k in keys)
    mine, held = f"{staging}.{quoted(order_by, mark)}", f"t.{quoted(order_by, mark)}"
    return f"DELETE FROM {staging} WHERE EXISTS (SELECT 1 FROM {target} t WHERE {same} AND ({held} > {mine} OR {mine} IS NULL AND {held} IS NOT NULL))"


@F.pandas_udf(T.LongType())
def _attempt(rows: Iterator[pd.Series]) -> Iterator[pd.Series]:
    """The number of the running task attempt; no two attempts of an application share one."""
    number = TaskContext.get().taskAttemptId()
    for part in rows:
        yield pd.Series(number, index=part.index)


@dataclass
class JdbcTable:
    """One table of a JDBC database; user, password and driver come in ``options``."""

    spark: SparkSession
    url: str
    table: str
    options: dict[str, str] = field(default_factory=dict)
    quote: str = '"'
    connect: Callable[[], object] | None = None  # opens a java.sql.Connection; default: DriverManager
    ledger: str = "wardloom_loads"

    def create_if_absent(self, like: DataFrame, *layout: object) -> "JdbcTable":
        """Append zero rows: Spark creates the table with the columns of ``like`` if it is absent.

        The database keeps its own layout; partitions and buckets are not used.
        """
        self._write(like.limit(0), self.table, "append")
        return self

    def append(self, df: DataFrame, load_id: str | None = None) -> LoadCounts:
        """Add the rows of ``df``, once per ``load_id``."""
        return self._load(df, load_id, lambda staging: [insert_statement(self.table, staging, df.columns, self.quote)])

    def upsert(
        self,
        df: DataFrame,
        keys: Sequence[str],
        on_duplicate: str = "keep_all",
        order_by: str | None = None,
        load_id: str | None = None,
    ) -> LoadCounts:
        """Replace rows by key; the policies for rows that share a key are those of ``SnapshotTable.upsert``."""
        staged = resolve_duplicates(df, keys, on_duplicate, order_by)

        def statements(staging: str) -> list[str]:
            older = [drop_older_statement(self.table, staging, keys, order_by, self.quote)] if on_duplicate == "newest" else []
            return older + upsert_statements(self.table, staging, keys, df.columns, self.quote)

        return self._load(staged, load_id, statements)

    def _load(self, df: DataFrame, load_id: str | None, statements: Callable[[str], list[str]]) -> LoadCounts:
        """Stage ``df`` under a name of this run, then run ``statements`` and note the load in one transaction."""
        load_id = load_id or uuid.uuid4().hex
        staging = f"{self.table}_staging_{uuid.uuid4().hex[:12]}"
        connection = (self.connect or self._open)()
        try:
            connection.setAutoCommit(False)
            statement = connection.createStatement()
            if self._noted(connection, statement, load_id):
                log.info("load %s into %s was done before", load_id, self.table)
                return LoadCounts(0, 0, self._count(statement))
            try:
                with Intermediates(self.spark):
                    # Written out first: a task that runs again reads the same rows again.
                    rows = materialize(df, "staged").select("*", F.spark_partition_id().alias(PARTITION), _attempt(F.lit(0)).alias(ATTEMPT))
                    self._write(rows, staging, "overwrite")
                counts = [statement.executeUpdate(sql) for sql in statements(staging)]
                statement.executeUpdate(f"INSERT INTO {self.ledger} (load_id, target, loaded) VALUES ({text(load_id)}, {text(self.table)}, {counts[-1]})")
                held = self._count(statement)
                connection.commit()
            except Exception:
                connection.rollback()
                log.exception("load into %s failed", self.table)
                raise
            finally:
                try:
                    statement.executeUpdate(f"DROP TABLE {staging}")
                    connection.commit()
                except Exception:  # noqa: BLE001 - it may never have been created; the load's own error counts
                    log.warning("staging table %s was not dropped", staging)
        finally:
            connection.close()
        log.info("loaded %s rows into %s", counts[-1], self.table)
        return LoadCounts(counts[-1], counts[-2] if len(counts) > 1 else 0, held)

    def _noted(self, connection, statement, load_id: str) -> bool:
        """Whether the ledger has the load; creates the ledger, whose key lets one of two runs of a load win."""
        try:
            found = statement.executeQuery(f"SELECT load_id FROM {self.ledger} WHERE load_id = {text(load_id)}")
        except Exception:  # noqa: BLE001 - there is no ledger yet
            connection.rollback()
            statement.executeUpdate(f"CREATE TABLE {self.ledger} (load_id VARCHAR(64) PRIMARY KEY, target VARCHAR(256), loaded BIGINT)")
            connection.commit()
            return False
        return bool(found.next())

    def _count(self, statement) -> int:
        rows = statement.executeQuery(f"SELECT COUNT(*) FROM {self.table}")
        rows.next()
        return int(rows.getLong(1))

    def _write(self, df: DataFrame, table: str, mode: str) -> None:
        df.write.format("jdbc").options(url=self.url, dbtable=table, **self.options).mode(mode).save()

    def _open(self):
        jvm = self.spark._jvm
        if driver := self.options.get("driver"):
            jvm.org.apache.spark.sql.execution.datasources.jdbc.DriverRegistry.register(driver)
        properties = jvm.java.util.Properties()
        for key in ("user", "password"):
            if key in self.options:
                properties.setProperty(key, self.options[key])
        return jvm.java.sql.DriverManager.getConnection(self.url, properties)
