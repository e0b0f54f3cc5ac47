"""Versioned Parquet tables: create-if-absent, append, and staged upsert by key.

A table is a folder of load folders ``data/load=<id>[/<partition>=<value>...]`` and a version log
that lists which of them are live. Writers only ever add folders, then commit the next version,
so readers see the table before or after a load and never half of it, and a failed load leaves
nothing visible behind.

    append   adds one load folder.
    upsert   adds the staged rows as a load folder, finds the live folders that hold one of their
             keys (a scan of the key columns only), and rewrites just those without the matched
             rows.

Rows lie in folders by partition column and, in a bucketed table, by a hash of the key. Only folders
of the partitions and buckets that have staged rows can hold a staged key, so only they are scanned:
a load of a few keys reads and rewrites a few buckets, however large the table is.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence
from dataclasses import dataclass
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, Observation, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wardloom.session import Intermediates, delete_folder, materialize, shuffles_freed
from wardloom.sources.versions import VersionLog

LOAD = "load"
BUCKET = "bucket_of_key"
CODEC = "zstd"  # finds a text again further back than others do, and so keeps equal texts that lie side by side once
PART = "part_of_"  # folders of a text partition column are named by a copy of it, since "" and NULL share a folder name


@dataclass(frozen=True)
class LoadCounts:
    rows_in: int
    rows_deleted: int
    rows_out: int


class SnapshotTable:
    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.root = root.rstrip("/")
        self._log = VersionLog(spark, f"{self.root}/versions")

    # -- reading ---------------------------------------------------------------------------

    def _state(self) -> tuple[int, dict]:
        number, state = self._log.latest()
        if state is None:
            raise ValueError(f"no table at {self.root}")
        return number, state

    def exists(self) -> bool:
        return self._log.latest()[1] is not None

    def version(self) -> int:
        return self._log.latest()[0]

    def rows(self) -> int:
        return self._state()[1]["rows"]

    def applied(self, name: str, stream: str) -> int:
        """Number of the last batch of the named stream that was committed from the checkpoint ``stream``, or -1."""
        return self._state()[1]["applied"].get(name, {}).get(stream, -1)

    def read(self, version: int | None = None) -> DataFrame:
        state = self._state()[1] if version is None else self._log.at(version)
        schema = T.StructType.fromJson(state["schema"])
        return self._scan(state["dirs"], schema).select(*schema.names)

    def _scan(self, dirs: Sequence[str], schema: T.StructType) -> DataFrame:
        if not dirs:
            return self.spark.createDataFrame([], schema)
        return (
            self.spark.read.schema(T.StructType([*schema.fields, T.StructField(LOAD, T.StringType())]))
            .option("basePath", f"{self.root}/data")
            .parquet(*[f"{self.root}/data/{d}" for d in dirs])
        )

    # -- writing ---------------------------------------------------------------------------

    def create_if_absent(
        self, like: DataFrame, partition_by: Sequence[str] = (), bucket_by: Sequence[str] = (), buckets: int = 0
    ) -> "SnapshotTable":
        """Create the table with the columns of ``like`` and no rows, unless it is there already.

        With ``buckets``, rows are also laid out by a hash of ``bucket_by``; choose so many that one bucket is
        cheap to rewrite.
        """
        if not self.exists():
            layout = {"partition_by": list(partition_by), "bucket_by": list(bucket_by) if buckets else [], "buckets": buckets}
            self._log.commit(1, {"schema": _nullable(like.schema).jsonValue(), **layout, "dirs": [], "rows": 0, "applied": {}})
        return self

    def append(self, df: DataFrame, applied: tuple[str, str, int] | None = None) -> LoadCounts:
        number, state = self._state()
        dirs, rows = self._write(self._aligned(df, state), state, uuid.uuid4().hex)
        return self._commit(number, state, state["dirs"] + dirs, rows, 0, applied)

    def upsert(
        self,
        df: DataFrame,
        keys: Sequence[str],
        on_duplicate: str = "keep_all",
        order_by: str | None = None,
        applied: tuple[str, str, int] | None = None,
    ) -> LoadCounts:
        """Replace the rows whose key occurs in ``df`` by the rows of ``df``.

        NULL keys match nothing: such rows stay, and staged ones are added. ``on_duplicate`` says
        what happens to staged rows that share a key: ``keep_all``, ``last`` (highest
        ``order_by``), ``error``, or ``newest``: all rows of the key's highest ``order_by``, unless the table has
        one with a higher value. With ``newest``, loads give the same table in whatever order they come.
        """
        number, state = self._state()
        staged = resolve_duplicates(self._aligned(df, state), keys, on_duplicate, order_by)
        with Intermediates(self.spark):
            if on_duplicate == "newest" and state["dirs"]:
                staged = self._not_older(staged, state, keys, order_by)
            load = uuid.uuid4().hex
            staged_dirs, rows_in = self._write(staged, state, load)
            candidates = self._candidates(state, [self._place(state, d) for d in staged_dirs], keys)
            if not candidates:
                return self._commit(number, state, state["dirs"] + staged_dirs, rows_in, 0, applied)

            schema = T.StructType.fromJson(state["schema"])
            # Read from the staged files, whose size decides about a broadcast. Large keys are combined before
            # they are shuffled, once for either join, which needs no shuffle of its own on top.
            staged_keys = self._scan(staged_dirs, schema).select(*keys).dropna().distinct()
            touched = self._touched(candidates, schema, staged_keys, keys)
            kept_dirs: list[str] = []
            if touched:
                kept = self._scan(list(touched), schema).join(staged_keys, list(keys), "left_anti").select(*schema.names)
                kept_dirs, _ = self._write(kept, state, f"{load}-kept")
        dirs = [d for d in state["dirs"] if d not in touched] + kept_dirs + staged_dirs
        return self._commit(number, state, dirs, rows_in, sum(touched.values()), applied)

    def expire(self, keep: int = 2) -> int:
        """Delete load folders that none of the last ``keep`` versions lists; returns how many.

        Not to be run while a load is writing.
        """
        newest, state = self._state()
        live = {d for v in range(max(1, newest - keep + 1), newest + 1) for d in self._log.at(v)["dirs"]}
        stale = [d for d in self._list_dirs("", 1 + len(self._layout(state))) if d not in live]
        for name in stale:
            delete_folder(self.spark, f"{self.root}/data/{name}")
        return len(stale)

    # -- helpers ---------------------------------------------------------------------------

    def _aligned(self, df: DataFrame, state: dict) -> DataFrame:
        """``df`` with the table's column order; other names or types are an error."""
        schema = T.StructType.fromJson(state["schema"])
        wanted = {f.name: f.dataType for f in schema}
        given = {f.name: f.dataType for f in _nullable(df.schema)}
        if wanted != given:
            raise ValueError(f"columns differ from table {self.root}: expected {wanted}, got {given}")
        return df.select(*schema.names)

    @staticmethod
    def _layout(state: dict) -> list[tuple[str, Column, set[str]]]:
        """Folder levels below a load: name, value and the columns the value comes from."""
        types = {f["name"]: f["type"] for f in state["schema"]["fields"]}
        levels = [
            (f"{PART}{c}", F.concat(F.lit("."), F.col(c)), {c}) if types[c] == "string" else (c, F.col(c), {c})
            for c in state["partition_by"]
        ]
        if state.get("buckets"):
            levels.append((BUCKET, F.pmod(F.xxhash64(*state["bucket_by"]), F.lit(state["buckets"])), set(state["bucket_by"])))
        return levels

    def _write(self, df: DataFrame, state: dict, load: str) -> tuple[list[str], int]:
        """Write a load folder; returns its folders and how many rows the write itself counted."""
        path, levels = f"{self.root}/data/{LOAD}={load}", self._layout(state)
        names = [name for name, _, _ in levels]
        counted = Observation()
        if levels:
            # Gathers each folder's rows into few files; adaptive execution splits the hot ones.
            df = df.withColumns({name: value for name, value, _ in levels}).hint("rebalance", *names)
        with shuffles_freed(df.sparkSession):
            writer = df.observe(counted, F.count(F.lit(1)).alias("rows")).write
            (writer.partitionBy(*names) if levels else writer).parquet(path, compression=CODEC)
        rows = counted.get["rows"]
        if not rows:
            delete_folder(self.spark, path)
            return [], 0
        return self._list_dirs(f"{LOAD}={load}", len(levels)), rows

    def _list_dirs(self, load_dir: str, depth: int) -> list[str]:
        """Folders ``depth`` levels below ``data/load_dir``, as paths relative to ``data``."""
        path = self.spark._jvm.org.apache.hadoop.fs.Path
        fs = path(self.root).getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration())
        found = [load_dir]
        for _ in range(depth):
            found = [
                f"{d}/{s.getPath().getName()}".lstrip("/")
                for d in found
                if fs.exists(path(f"{self.root}/data/{d}"))
                for s in fs.listStatus(path(f"{self.root}/data/{d}"))
                if s.isDirectory() and "=" in s.getPath().getName()
            ]
        return found

    def _place(self, state: dict, folder: str) -> tuple[str, ...]:
        """Where a folder lies below its load, level by level."""
        return tuple(folder.split("/")[1:])

    def _candidates(self, state: dict, staged: Sequence[tuple[str, ...]], keys: Sequence[str]) -> list[str]:
        """Live folders that could hold a key of rows staged at the given places.

        A level tells folders apart if its value comes from the key alone.
        """
        telling = [i for i, (_, _, columns) in enumerate(self._layout(state)) if columns <= set(keys)]
        places = {tuple(place[i] for i in telling) for place in staged}
        return [d for d in state["dirs"] if tuple(self._place(state, d)[i] for i in telling) in places]

    def _not_older(self, staged: DataFrame, state: dict, keys: Sequence[str], order_by: str) -> DataFrame:
        """``staged`` without the rows whose key the table holds with a higher ``order_by``; NULL is lowest."""
        staged = materialize(staged, "staged")
        schema = T.StructType.fromJson(state["schema"])
        held = self._scan(state["dirs"], schema).select(*keys, F.col(order_by).alias("_held")).dropna(subset=list(keys))
        wanted = staged.select(*keys).dropna().distinct()
        newest = held.join(wanted, list(keys), "left_semi").groupBy(*keys).agg(F.max("_held").alias("_held"))
        older = F.col("_held").isNotNull() & (F.col(order_by).isNull() | (F.col(order_by) < F.col("_held")))
        return staged.join(newest, list(keys), "left").filter(~older).select(*schema.names)

    def _touched(self, dirs: Sequence[str], schema: T.StructType, staged_keys: DataFrame, keys: Sequence[str]) -> dict[str, int]:
        """Live folders with matched rows, and how many; one row per folder comes to the driver."""
        matched = (
            self._scan(dirs, schema)
            .select(*keys, F.regexp_extract("_metadata.file_path", f"/data/({LOAD}=.*)/[^/]+$", 1).alias("_dir"))
            .join(staged_keys, list(keys), "left_semi")
            .groupBy("_dir")
            .count()
        )
        return {unquote(row["_dir"]): row["count"] for row in matched.collect()}

    def _commit(
        self, number: int, state: dict, dirs: list[str], rows_in: int, deleted: int, applied: tuple[str, str, int] | None
    ) -> LoadCounts:
        rows, batches = state["rows"] + rows_in - deleted, state["applied"]
        if applied:
            name, stream, batch = applied
            batches = {**batches, name: {**batches.get(name, {}), stream: batch}}
        self._log.commit(number + 1, {**state, "dirs": dirs, "rows": rows, "applied": batches})
        return LoadCounts(rows_in, deleted, rows)


def resolve_duplicates(df: DataFrame, keys: Sequence[str], on_duplicate: str, order_by: str | None) -> DataFrame:
    """Apply the duplicate policy to staged rows; NULL keys never count as duplicates."""
    if on_duplicate == "keep_all":
        return df
    if on_duplicate == "error":
        twice = df.select(*keys).dropna().groupBy(*keys).count().filter("count > 1").limit(1).collect()
        if twice:
            raise ValueError(f"staged rows share a key, for example {twice[0].asDict()}")
        return df
    if on_duplicate not in ("last", "newest") or order_by is None:
        raise ValueError("on_duplicate is keep_all, error, or last or newest with order_by")
    # The rank limit of one is applied before the shuffle too, so a hot key sends few rows per task.
    by_key = Window.partitionBy(*keys)
    if on_duplicate == "last":
        rank = F.row_number().over(by_key.orderBy(F.col(order_by).desc_nulls_last(), F.xxhash64(*df.columns)))
    else:
        rank = F.rank().over(by_key.orderBy(F.col(order_by).desc_nulls_last()))
    no_key = " or ".join(f"`{k}` is null" for k in keys)
    ranked = df.filter(f"not ({no_key})").withColumn("_rank", rank)
    return ranked.filter("_rank = 1").drop("_rank").unionByName(df.filter(no_key))


def _nullable(schema: T.StructType) -> T.StructType:
    return T.StructType([T.StructField(f.name, f.dataType, True) for f in schema])
