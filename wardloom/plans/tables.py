"""The five warehouse tables: how each is shaped from its source, and how it is loaded."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wardloom.functions.keys import random_id, surrogate_id
from wardloom.operators.numbering import number_equal_rows
from wardloom.session import Intermediates
from wardloom.sinks.jdbc import JdbcTable
from wardloom.sinks.report import LoadReport
from wardloom.sinks.snapshot import LoadCounts, SnapshotTable
from wardloom.sources.incremental import Bookmark

# The columns of the target tables.
DEVICE_COLUMNS = ("device_model", "brand")
WATCH_FACT_COLUMNS = tuple(
    "user_id device_model date steps heart_rate calories_burned sleep_hours active_minutes "
    "diastolic_bp body_temp oxygen_saturation respiratory_rate".split()
)
USER_COLUMNS = tuple(
    "id age gender bmi smoking alcohol family_history pre_existing_conditions medications "
    "hospitalization blood_sugar cholesterol blood_pressure vitamin_deficiencies mental_health "
    "occupation work_environment travel_history geographic_location environmental_exposure "
    "exercise_frequency dietary_habits marital_status education_level income_level "
    "employment_status dental_health allergies_sensitivities health_plan_type deductible".split()
)
RENEWAL_COLUMNS = tuple(
    "user_id year plan_type cancellation_reason premium_cost health_plan_type deductible".split()
)


def rename_columns(df: DataFrame, names: Mapping[str, str]) -> DataFrame:
    return df.withColumnsRenamed(dict(names))


def devices(wearables: DataFrame, columns: Sequence[str] = DEVICE_COLUMNS) -> DataFrame:
    """Distinct pairs of device model and brand."""
    return rename_columns(wearables, {"device_id": "device_model"}).select(*columns).distinct()


def watch_facts(wearables: DataFrame, columns: Sequence[str] = WATCH_FACT_COLUMNS) -> DataFrame:
    """Measures per user and date; the brand stays with the devices."""
    return rename_columns(wearables, {"device_id": "device_model"}).select(*columns)


def users(customers: DataFrame, columns: Sequence[str] = USER_COLUMNS) -> DataFrame:
    """Distinct profiles; a user whose profile changed over the years has several."""
    return customers.select(*columns).distinct()


def renewal_history(
    customers: DataFrame, columns: Sequence[str] = RENEWAL_COLUMNS, id_mode: str = "derived", also: Sequence[str] = ()
) -> DataFrame:
    """Renewal facts with a surrogate id.

    The derived id covers ``columns`` and the number of the row among equal ones: unique, and the
    same on a rerun, so that a rerun replaces its rows. ``id_mode="random"`` gives fresh ids, with
    which every load adds its rows. Columns in ``also`` are carried along but are no part of the id.
    """
    facts = rename_columns(customers, {"id": "user_id"}).select(*columns, *also)
    if id_mode == "random":
        return facts.withColumn("id", random_id())
    numbered = number_equal_rows(facts)
    return numbered.withColumn("id", surrogate_id([F.col(c) for c in (*columns, "occurrence")])).drop("occurrence")


def with_device(wearables: DataFrame, distinct_devices: DataFrame, keys: Sequence[str] = DEVICE_COLUMNS) -> DataFrame:
    """Wearables with the columns of their device."""
    return wearables.join(distinct_devices, list(keys), "left")


@dataclass(frozen=True)
class TableLoad:
    """A target table, the key it is replaced by, and how it is laid out: by partitions, by buckets of the key, or both."""

    name: str
    keys: tuple[str, ...]
    partition_by: tuple[str, ...] = ()
    buckets: int = 0
    on_duplicate: str = "keep_all"
    order_by: str | None = None

    def run(self, spark: SparkSession, base: str, df: DataFrame, report: LoadReport | None = None) -> SnapshotTable:
        """Create the table below ``base`` if it is absent, then upsert ``df``."""
        table = SnapshotTable(spark, f"{base.rstrip('/')}/{self.name}")
        self.run_into(table, df, report or LoadReport(spark))
        return table

    def run_into(self, table: SnapshotTable | JdbcTable, df: DataFrame, report: LoadReport) -> None:
        """The same into any target, such as a table of a database; what is written on the way is deleted at the end."""

        def load() -> LoadCounts:
            with Intermediates(df.sparkSession):
                table.create_if_absent(df.limit(0), self.partition_by, self.keys, self.buckets)
                return table.upsert(df, self.keys, self.on_duplicate, self.order_by)

        report.run(self.name, load)


# Buckets of a new table; more suit a larger one (``dataclasses.replace(USERS, buckets=4096)``).
BUCKETS = 16

# Names and load keys. Facts are partitioned by the date in their key, so that a
# day's load reads and rewrites that day only; the other tables are bucketed by theirs.
DEVICES = TableLoad("devices", ("device_model",), buckets=BUCKETS)
WATCH_FACTS = TableLoad("watch_facts", ("user_id", "date"), partition_by=("date",))
USERS = TableLoad("users", ("id",), buckets=BUCKETS)
RENEWAL_HISTORY = TableLoad("renewal_history", ("id",), buckets=BUCKETS)
PROVIDER = TableLoad("provider", ("id",), buckets=BUCKETS)


def load_incremental(
    spark: SparkSession,
    base: str,
    load: TableLoad,
    bookmark: Bookmark,
    source: DataFrame,
    key: str,
    shape: Callable[[DataFrame], DataFrame] = lambda rows: rows,
    report: LoadReport | None = None,
) -> SnapshotTable:
    """Read what is new since the last run, load it, and only then move the mark.

    For sources whose ``key`` only rises. New files of known keys, such as another day of a user,
    are for ``stream_upsert``. If the run fails after the load, the next one loads the same rows again,
    which the upsert by key turns into the same table.
    """
    pending = bookmark.read_new(source, key)
    table = load.run(spark, base, shape(pending.rows), report)
    pending.commit()
    return table


def load_warehouse(
    spark: SparkSession,
    base: str | Callable[[str], SnapshotTable | JdbcTable],
    customers: DataFrame,
    wearables: DataFrame,
    provider: DataFrame,
    id_mode: str = "derived",
    report: LoadReport | None = None,
) -> LoadReport:
    """Shape and load all five tables; returns the report. Pass ``report`` in to have its rows also when a load fails.

    ``base`` is the folder of the tables, or a function that opens a table by name, for instance
    ``lambda name: JdbcTable(spark, url, f"public.{name}", options)``.
    """
    report = report or LoadReport(spark)
    opened = base if callable(base) else lambda name: SnapshotTable(spark, f"{base.rstrip('/')}/{name}")
    frames = (
        (DEVICES, lambda: devices(wearables)),
        (WATCH_FACTS, lambda: watch_facts(wearables)),
        (USERS, lambda: users(customers)),
        (RENEWAL_HISTORY, lambda: renewal_history(customers, id_mode=id_mode)),
        (PROVIDER, lambda: provider),
    )
    for spec, shaped in frames:
        spec.run_into(opened(spec.name), shaped(), report)
    return report
