"""Every operator as a query over the sample tables.

The sample tables stand in for the job's own: ``orders`` for customers by year, ``lineitem`` and
``events`` for wearables, ``part`` for devices, ``supplier`` for providers, ``documents`` for note
files. Sink queries write to a fresh folder below the shared folder and return what is read back.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wardloom.functions.keys import provider_pick, surrogate_id
from wardloom.functions.text import strip_newlines
from wardloom.operators.corpus import Corpus, corpus_of_folder, corpus_of_texts, records_of
from wardloom.operators.growing import GrowingCorpus
from wardloom.operators.picks import assign_text
from wardloom.operators.sentiment import note_score, score_texts
from wardloom.plans import sample, tables
from wardloom.plans.incremental import Source, load_new_files, newest
from wardloom.plans.notes import ADMISSION, DISCHARGE, FOLLOW_UP, KINDS, NoteKind, doctor_notes, filter_notes_type, load_notes, make_notes, note_corpora
from wardloom.plans.tables import TableLoad, rename_columns
from wardloom.session import delete_folder, fresh_dir, shuffles_freed
from wardloom.sinks.report import LoadReport
from wardloom.sinks.snapshot import SnapshotTable
from wardloom.sources.incremental import Bookmark
from wardloom.sources.tables import read_table
from wardloom.sources.text import with_suffix
from wardloom.streaming.upsert import stream_upsert

Query = Callable[[SparkSession, str], DataFrame]

# The sample documents hold no long dash runs, so each kind is cut at a delimiter they do hold.
SAMPLE_DELIMITERS = {ADMISSION: "\n", FOLLOW_UP: ". ", DISCHARGE: ", "}


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return read_table(spark, f"{sf_dir}/{name}.parquet")


def _documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The documents, spread over the cores if their files give fewer partitions than that."""
    docs = _table(spark, sf_dir, "documents")
    cores = spark.sparkContext.defaultParallelism
    return docs if docs.rdd.getNumPartitions() >= cores else docs.repartition(cores, "doc_id")


def _snapshot(spark: SparkSession, label: str) -> SnapshotTable:
    return SnapshotTable(spark, fresh_dir(spark, label))


def _scan(name: str) -> Query:
    return lambda spark, sf_dir: _table(spark, sf_dir, name)


# -- sources ---------------------------------------------------------------------------------


def incremental_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two runs: the first finds the lower half of the keys, the second the whole table."""
    events = _table(spark, sf_dir, "events")
    bookmark = Bookmark(spark, fresh_dir(spark, "bookmarks"), "events")
    low, high = events.agg(F.min("event_id"), F.max("event_id")).first()
    first = bookmark.read_new(events.filter(F.col("event_id") <= (low + high) // 2), "event_id")
    first.commit()
    second = bookmark.read_new(events, "event_id", ordered=True)
    return first.rows.withColumn("run", F.lit(1)).unionByName(second.rows.withColumn("run", F.lit(2)))


def corpus_suffix_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return with_suffix(_table(spark, sf_dir, "pages"), "url", "#top")


def _records(delimiter: str) -> Query:
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        return records_of(_documents(spark, sf_dir), "doc_id", "text", delimiter).withColumn("pos", F.col("pos").cast("long"))

    return query


def _corpus(spark: SparkSession, sf_dir: str, delimiter: str) -> Corpus:
    return corpus_of_texts(_documents(spark, sf_dir), "doc_id", "text", delimiter)


def corpus_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _corpus(spark, sf_dir, "\n").records


FILE_DOCS = 100  # documents per file of a note folder


def _drop_files(docs: DataFrame, folder: str, delimiter: str = "\n") -> None:
    """Write the documents to text files of FILE_DOCS ids each, in order of id, each with ``delimiter`` after it."""
    after = "" if delimiter == "\n" else "\n" + delimiter
    rows = docs.select(F.lpad(F.floor(F.col("doc_id") / FILE_DOCS).cast("string"), 12, "0").alias("part"), "doc_id", F.concat(F.coalesce("text", F.lit("")), F.lit(after)).alias("value"))
    with shuffles_freed(docs.sparkSession):
        rows.repartition("part").sortWithinPartitions("part", "doc_id").select("part", "value").write.partitionBy("part").mode("append").text(folder)


def corpus_folder(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Files of many documents, read in splits and cut at a delimiter that lies in the texts."""
    folder = fresh_dir(spark, "corpus")
    _drop_files(_table(spark, sf_dir, "documents"), folder)
    return corpus_of_folder(spark, folder, ". ").records


def corpus_growth(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two drops of files; what the first left keeps its numbers. Draws from the first ``size`` records are those
    that were possible before the second drop; they have negative numbers here."""
    docs, folder = _table(spark, sf_dir, "documents"), fresh_dir(spark, "corpus")
    growing = GrowingCorpus(spark, fresh_dir(spark, "growing"))
    later = F.pmod(F.floor(F.col("doc_id") / FILE_DOCS), F.lit(2)) == 1
    _drop_files(docs.filter(~later), folder)
    first = growing.take_in(folder, "\n")
    _drop_files(docs.filter(later), folder)
    growing.take_in(folder, "\n")
    drawn = assign_text(_table(spark, sf_dir, "customer").select("c_custkey"), ["c_custkey"], "text", growing.corpus(first))
    return growing.corpus().records.unionByName(drawn.select((-F.col("c_custkey") - 1).alias("idx"), F.col("notes").alias("text")))


# -- sinks -----------------------------------------------------------------------------------


def create_empty_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _snapshot(spark, "orders").create_if_absent(_table(spark, sf_dir, "orders")).read()


def append_insert(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = _table(spark, sf_dir, "orders")
    target = _snapshot(spark, "orders").create_if_absent(orders)
    target.append(orders.filter("o_orderstatus <> 'F'"))
    target.append(orders.filter("o_orderstatus = 'F'"))
    return target.read()


def _customer_target(customer: DataFrame) -> DataFrame:
    return customer.filter("c_mktsegment <> 'MACHINERY'")


def _customer_staged(customer: DataFrame) -> DataFrame:
    changed = customer.filter("c_mktsegment in ('MACHINERY', 'BUILDING')")
    return changed.withColumn("c_acctbal", F.col("c_acctbal") + 1)


def upsert_single_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    customer = _table(spark, sf_dir, "customer")
    target = _snapshot(spark, "customer").create_if_absent(customer, bucket_by=["c_custkey"], buckets=tables.BUCKETS)
    target.append(_customer_target(customer))
    target.upsert(_customer_staged(customer), ["c_custkey"])
    return target.read()


def upsert_composite_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two keys, one of them the table's partition column."""
    lineitem = _table(spark, sf_dir, "lineitem")
    target = _snapshot(spark, "lineitem").create_if_absent(lineitem, partition_by=["l_linenumber"])
    target.append(lineitem.filter("l_returnflag <> 'R'"))
    staged = lineitem.filter("l_returnflag <> 'A'").withColumn("l_quantity", F.col("l_quantity") + 1)
    target.upsert(staged, ["l_orderkey", "l_linenumber"])
    return target.read()


def _key_join(how: str) -> Query:
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        customer = _table(spark, sf_dir, "customer")
        keys = _customer_staged(customer).select("c_custkey")
        return _customer_target(customer).join(keys, "c_custkey", how)

    return query


# -- shaping ---------------------------------------------------------------------------------


def _wearables(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rename_columns(
        _table(spark, sf_dir, "lineitem"),
        {"l_orderkey": "user_id", "l_partkey": "device_id", "l_shipdate": "date", "l_quantity": "steps", "l_extendedprice": "calories_burned", "l_returnflag": "brand"},
    )


SAMPLE_FACT_COLUMNS = ("user_id", "device_model", "date", "steps", "calories_burned")
SAMPLE_USER_COLUMNS = ("id", "o_orderstatus", "o_orderpriority")
SAMPLE_RENEWAL_COLUMNS = ("user_id", "year", "plan_type", "premium_cost")


def _customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rename_columns(_table(spark, sf_dir, "orders"), {"o_custkey": "id"})


def _renewals_source(spark: SparkSession, sf_dir: str) -> DataFrame:
    source = rename_columns(_customers(spark, sf_dir), {"o_orderpriority": "plan_type", "o_totalprice": "premium_cost"})
    return source.withColumn("year", F.year("o_orderdate"))


def _devices_source(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rename_columns(_table(spark, sf_dir, "part"), {"p_name": "device_id", "p_brand": "brand"})


def rename_columns_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rename_columns(_table(spark, sf_dir, "part"), {"p_partkey": "device_id", "p_name": "device_model"})


def project_watch_facts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tables.watch_facts(_wearables(spark, sf_dir), SAMPLE_FACT_COLUMNS)


def project_renewal(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rename_columns(_renewals_source(spark, sf_dir), {"id": "user_id"}).select(*SAMPLE_RENEWAL_COLUMNS)


def distinct_devices(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tables.devices(_devices_source(spark, sf_dir))


def distinct_users(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tables.users(_customers(spark, sf_dir), SAMPLE_USER_COLUMNS)


def surrogate_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    fields = [F.col(c) for c in ("o_orderkey", "o_custkey", "o_orderstatus", "o_orderpriority")]
    return _table(spark, sf_dir, "orders").select("o_orderkey", surrogate_id(fields).alias("id"))


def provider_assign(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _table(spark, sf_dir, "customer").select("c_custkey", provider_pick([F.col("c_custkey")], "provider").alias("provider_id"))


def random_text_assign(spark: SparkSession, sf_dir: str) -> DataFrame:
    customers = _table(spark, sf_dir, "customer").select("c_custkey")
    return assign_text(customers, ["c_custkey"], "text", _corpus(spark, sf_dir, "\n"))


def label_constant(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _table(spark, sf_dir, "orders").select("o_orderkey", F.lit(ADMISSION.label).alias("notes_type"))


def strip_newlines_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _table(spark, sf_dir, "documents").select("doc_id", strip_newlines(F.col("text")).alias("text"))


def left_join_devices(spark: SparkSession, sf_dir: str) -> DataFrame:
    wearables = rename_columns(_devices_source(spark, sf_dir), {"device_id": "device_model"})
    known = tables.devices(_devices_source(spark, sf_dir).filter("p_type = 'ECONOMY'"))
    known = known.withColumn("device_id", surrogate_id([F.col("device_model"), F.col("brand")]))
    return tables.with_device(wearables, known).select("p_partkey", "device_model", "brand", "device_id")


# -- sentiment and notes ---------------------------------------------------------------------


def sentiment_components(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score_texts(_documents(spark, sf_dir), "doc_id", "text", sample.lexicon(spark), sample.RULES)


def sentiment_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sentiment_components(spark, sf_dir).select("doc_id", note_score().alias("score"))


def _note_users(spark: SparkSession, sf_dir: str) -> DataFrame:
    return distinct_users(spark, sf_dir)


def _notes(kind: NoteKind) -> Query:
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        corpus = _corpus(spark, sf_dir, SAMPLE_DELIMITERS[kind])
        return make_notes(_note_users(spark, sf_dir), corpus, kind, lexicon=sample.lexicon(spark), rules=sample.RULES)

    return query


def notes_union(spark: SparkSession, sf_dir: str) -> DataFrame:
    corpora = {kind: _corpus(spark, sf_dir, delimiter) for kind, delimiter in SAMPLE_DELIMITERS.items()}
    return doctor_notes(_note_users(spark, sf_dir), corpora, lexicon=sample.lexicon(spark), rules=sample.RULES)


def doctor_notes_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All notes, appended to the ``doctor_notes`` table and read back."""
    target = _snapshot(spark, "doctor_notes")
    corpora = lambda: {kind: _corpus(spark, sf_dir, delimiter) for kind, delimiter in SAMPLE_DELIMITERS.items()}
    load_notes(target, _note_users(spark, sf_dir), corpora, lexicon=sample.lexicon(spark), rules=sample.RULES)
    return target.read()


def notes_from_folders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The three note folders with their own delimiters, read and cut; all notes of all users, loaded and read back.

    The folders are this query's own. They are filled and read one after another, and each is deleted once its records
    stand in the working folder, so that the texts do not lie there three times over.
    """
    docs, base, target = _table(spark, sf_dir, "documents"), fresh_dir(spark, "landing"), _snapshot(spark, "doctor_notes")

    def corpora() -> dict[NoteKind, Corpus]:
        found = {}
        for kind in KINDS:
            _drop_files(docs, f"{base}/{kind.folder}", kind.delimiter)
            found |= note_corpora(spark, base, [kind])
            delete_folder(spark, f"{base}/{kind.folder}")
        return found

    load_notes(target, _note_users(spark, sf_dir), corpora, lexicon=sample.lexicon(spark), rules=sample.RULES)
    return target.read()


def notes_with_providers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Admission notes whose providers are drawn from the provider table."""
    providers = _table(spark, sf_dir, "supplier").select("s_suppkey")
    corpus = _corpus(spark, sf_dir, SAMPLE_DELIMITERS[ADMISSION])
    options = {"lexicon": sample.lexicon(spark), "rules": sample.RULES}
    return make_notes(_note_users(spark, sf_dir), corpus, ADMISSION, providers=providers, provider_key="s_suppkey", **options)


def filter_notes_type_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filter_notes_type(notes_union(spark, sf_dir), DISCHARGE.label)


def count_notes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return notes_union(spark, sf_dir).agg(F.count(F.lit(1)).alias("n"))


# -- table loads -----------------------------------------------------------------------------

# What an earlier and a later run of each load find in the sample tables.
Runs = Callable[[SparkSession, str], list[DataFrame]]


def _device_runs(spark: SparkSession, sf_dir: str) -> list[DataFrame]:
    source = _devices_source(spark, sf_dir)
    return [tables.devices(source), tables.devices(source.filter("p_size >= 49"))]


def _watch_fact_runs(spark: SparkSession, sf_dir: str) -> list[DataFrame]:
    wearables = _wearables(spark, sf_dir)
    later = wearables.filter("brand <> 'A'").withColumn("steps", F.col("steps") + 1)
    return [tables.watch_facts(w, SAMPLE_FACT_COLUMNS) for w in (wearables.filter("brand <> 'R'"), later)]


def _monthly_fact_runs(spark: SparkSession, sf_dir: str) -> list[DataFrame]:
    """The facts dated by month, since the table of the job's own spec has a partition per date."""
    return [df.withColumn("date", F.trunc("date", "month")) for df in _watch_fact_runs(spark, sf_dir)]


def _user_runs(spark: SparkSession, sf_dir: str) -> list[DataFrame]:
    customers = _customers(spark, sf_dir)
    early, late = customers.filter("year(o_orderdate) < 2001"), customers.filter("year(o_orderdate) >= 2001")
    return [tables.users(c, SAMPLE_USER_COLUMNS) for c in (early, late)]


def _renewal_runs(spark: SparkSession, sf_dir: str) -> list[DataFrame]:
    source = _renewals_source(spark, sf_dir)
    return [tables.renewal_history(s, SAMPLE_RENEWAL_COLUMNS) for s in (source.filter("year < 2000"), source.filter("year >= 1998"))]


def _provider_runs(spark: SparkSession, sf_dir: str) -> list[DataFrame]:
    supplier = rename_columns(_table(spark, sf_dir, "supplier"), {"s_suppkey": "id"})
    return [supplier.withColumn("s_acctbal", F.lit(0.0)), supplier.filter("s_acctbal >= 0")]


LOADS: dict[str, tuple[TableLoad, Runs]] = {
    "load_devices": (tables.DEVICES, _device_runs),
    "load_watch_facts": (TableLoad("watch_facts", ("user_id", "date"), buckets=tables.BUCKETS), _watch_fact_runs),
    "load_watch_facts_by_date": (replace(tables.WATCH_FACTS, name="watch_facts_by_date"), _monthly_fact_runs),
    "load_users": (tables.USERS, _user_runs),
    "load_renewal_history": (tables.RENEWAL_HISTORY, _renewal_runs),
    "load_provider": (tables.PROVIDER, _provider_runs),
}


def _load(name: str) -> Query:
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        spec, runs = LOADS[name]
        base = fresh_dir(spark, "warehouse")
        for df in runs(spark, sf_dir):
            table = spec.run(spark, base, df)
        return table.read()

    return query


def load_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Row counts of both runs of all five loads."""
    report, base = LoadReport(spark), fresh_dir(spark, "warehouse")
    for spec, runs in LOADS.values():
        for df in runs(spark, sf_dir):
            spec.run(spark, base, df, report)
    return report.to_df(["table", "rows_in", "rows_deleted", "rows_out"])


def stream_upsert_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two file drops with overlapping keys; the second carries corrected values."""
    return _drop_and_stream(spark, sf_dir, reverse=False)


def stream_late_drop(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same drops the other way round: the older values come last, and stand only where there is nothing newer."""
    return _drop_and_stream(spark, sf_dir, reverse=True)


def _drop_and_stream(spark: SparkSession, sf_dir: str, reverse: bool) -> DataFrame:
    events = _table(spark, sf_dir, "events")
    inbox, checkpoint = fresh_dir(spark, "inbox"), fresh_dir(spark, "stream")
    drops = [
        events.filter("ts < timestamp_ntz'2024-01-20'").withColumn("revision", F.lit(1)),
        events.filter("ts >= timestamp_ntz'2024-01-10'").withColumns({"value": F.col("value") + 1, "revision": F.lit(2)}),
    ]
    target = _snapshot(spark, "events").create_if_absent(drops[0], bucket_by=["event_id"], buckets=tables.BUCKETS)
    for drop in drops[::-1] if reverse else drops:
        drop.write.mode("append").parquet(inbox)
        source = spark.readStream.schema(drop.schema).parquet(inbox)
        policy = {"on_duplicate": "newest", "order_by": "revision"} if reverse else {}
        stream_upsert(source, target, ["event_id"], checkpoint, "events", **policy).awaitTermination()
    return target.read().drop("revision")


def _incremental_drops(spark: SparkSession, sf_dir: str) -> dict[str, list[DataFrame]]:
    """What three drops bring to each source: facts of known users on other days, corrections, another year."""
    wearables = _wearables(spark, sf_dir).select("user_id", "device_id", "brand", "date", "steps", "calories_burned")
    corrected = wearables.filter("brand = 'A'").withColumn("steps", F.col("steps") + 1)
    customers = _renewals_source(spark, sf_dir)
    supplier = rename_columns(_table(spark, sf_dir, "supplier"), {"s_suppkey": "id"})
    return {
        "wearables": [wearables.filter("brand <> 'R'"), wearables.filter("brand = 'R'"), corrected],
        "customers": [customers.filter("year < 2000"), customers.filter("year >= 1998 and year < 2002"), customers.filter("year >= 2002")],
        "provider": [supplier.withColumn("s_acctbal", F.lit(0.0)), supplier.filter("s_acctbal >= 0"), supplier.limit(0)],
    }


def incremental_job(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three runs over the three sources, the last through fresh checkpoints, so that it reads all drops again."""
    drops, inbox, base = _incremental_drops(spark, sf_dir), fresh_dir(spark, "inbox"), fresh_dir(spark, "warehouse")
    schemas = {name: T.StructType([*frames[0].schema.fields, T.StructField("load_no", T.IntegerType())]) for name, frames in drops.items()}
    user_columns, fact_columns = (*SAMPLE_USER_COLUMNS, "load_no"), (*SAMPLE_FACT_COLUMNS, "load_no")
    loads = {
        "wearables": (
            (tables.DEVICES, lambda df: tables.devices(df, (*tables.DEVICE_COLUMNS, "load_no"))),
            (TableLoad("watch_facts", ("user_id", "date"), buckets=tables.BUCKETS), lambda df: tables.watch_facts(df, fact_columns)),
        ),
        "customers": (
            (tables.USERS, lambda df: tables.users(rename_columns(df, {"plan_type": "o_orderpriority"}), user_columns)),
            (tables.RENEWAL_HISTORY, lambda df: tables.renewal_history(df, SAMPLE_RENEWAL_COLUMNS, also=("load_no",))),
        ),
        "provider": ((tables.PROVIDER, lambda df: df),),
    }
    sources = [
        Source(name, f"{inbox}/{name}", schemas[name], tuple((newest(load, "load_no"), shape) for load, shape in loads[name])) for name in drops
    ]
    first, fresh = fresh_dir(spark, "checkpoints"), fresh_dir(spark, "checkpoints")
    for number, checkpoints in enumerate((first, first, fresh)):
        for name, frames in drops.items():
            frames[number].write.parquet(f"{inbox}/{name}/load_no={number}")
        load_new_files(spark, base, sources, checkpoints)
    result = None
    for name in ("devices", "watch_facts", "users", "renewal_history", "provider"):
        part = SnapshotTable(spark, f"{base}/{name}").read().withColumn("table", F.lit(name))
        if name in ("devices", "watch_facts"):
            part = part.withColumn("device_model", F.col("device_model").cast("string"))
        part = rename_columns(part, {"id": "renewal_id"} if name == "renewal_history" else {})
        result = part if result is None else result.unionByName(part, allowMissingColumns=True)
    return result


QUERIES: dict[str, Query] = {
    "scan_customers": _scan("customer"),
    "scan_wearables": _scan("events"),
    "scan_provider": _scan("supplier"),
    "incremental_scan": incremental_scan,
    "corpus_suffix_filter": corpus_suffix_filter,
    "records_newline": _records("\n"),
    "records_literal_delim": _records(". "),
    "corpus_index": corpus_index,
    "corpus_folder": corpus_folder,
    "corpus_growth": corpus_growth,
    "create_empty_table": create_empty_table,
    "append_insert": append_insert,
    "upsert_single_key": upsert_single_key,
    "upsert_composite_key": upsert_composite_key,
    "semi_join_deleted": _key_join("left_semi"),
    "anti_join_survivors": _key_join("left_anti"),
    "rename_columns": rename_columns_query,
    "project_watch_facts": project_watch_facts,
    "project_renewal": project_renewal,
    "distinct_devices": distinct_devices,
    "distinct_users": distinct_users,
    "surrogate_key": surrogate_key,
    "provider_assign": provider_assign,
    "random_text_assign": random_text_assign,
    "label_constant": label_constant,
    "strip_newlines": strip_newlines_query,
    "left_join_devices": left_join_devices,
    "sentiment_score": sentiment_score,
    "sentiment_components": sentiment_components,
    "notes_admission": _notes(ADMISSION),
    "notes_follow_up": _notes(FOLLOW_UP),
    "notes_discharge": _notes(DISCHARGE),
    "notes_union": notes_union,
    "doctor_notes": doctor_notes_query,
    "notes_from_folders": notes_from_folders,
    "notes_with_providers": notes_with_providers,
    "filter_notes_type": filter_notes_type_query,
    "count_notes": count_notes,
    **{name: _load(name) for name in LOADS},
    "load_report": load_report,
    "stream_upsert": stream_upsert_query,
    "stream_late_drop": stream_late_drop,
    "incremental_job": incremental_job,
}
