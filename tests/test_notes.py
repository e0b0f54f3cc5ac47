import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tests.brute_sentiment import score
from wardloom.functions.rules import Rules
from wardloom.functions.text import DISCHARGE_DELIMITER, FOLLOW_UP_DELIMITER, score_with
from wardloom.operators.corpus import Corpus, corpus_of_texts
from wardloom.plans import queries
from wardloom.plans.notes import ADMISSION, DISCHARGE, FOLLOW_UP, KINDS, NOTE_COLUMNS, doctor_notes, make_notes, note_corpora

LEXICON = {"good": 1.9, "bad": -2.5, "fine": 0.8}


@pytest.fixture(scope="module")
def lexicon(spark):
    return spark.createDataFrame(list(LEXICON.items()), "token string, valence double")


@pytest.fixture(scope="module")
def corpus(spark):
    texts = [(i, f"note {i} is{' good' * (i % 3)}\nand bad{'!' * (i % 5)}") for i in range(40)]
    return corpus_of_texts(spark.createDataFrame(texts, "k int, t string"), "k", "t", "#")


def test_one_user_one_text(spark, lexicon):
    users = spark.createDataFrame([(1,)], T.StructType([T.StructField("id", T.IntegerType())]))
    one = Corpus(spark.createDataFrame([(0, "some followup text")], "idx long, text string"), 1)
    notes = make_notes(users, one, FOLLOW_UP, lexicon=lexicon)
    row = notes.first()
    assert tuple(notes.columns) == NOTE_COLUMNS
    assert (row.user_id, row.notes, row.notes_type) == (1, "some followup text", "follow_up_notes")
    assert len(row.id) == 32 and 1 <= row.provider_id <= 2000 and row.notes_pos_sentiment == 1.0
    assert notes.schema["user_id"].dataType == T.IntegerType()


def test_grain_ids_and_scores(spark, lexicon, corpus):
    users = spark.range(300).select((F.col("id") % 100).alias("id"))
    notes = make_notes(users, corpus, ADMISSION, lexicon=lexicon)
    rows = notes.collect()
    assert len(rows) == 300 and len({r.id for r in rows}) == 300
    assert {r.user_id for r in rows} == set(range(100))
    texts = {r.text for r in corpus.records.collect()}
    assert len({r.notes for r in rows}) > 30
    for r in rows:
        assert r.notes in texts
        neg, neu, pos, compound = score(r.notes, LEXICON, Rules())
        assert r.notes_pos_sentiment == pytest.approx(compound + neu) and -1 <= r.notes_pos_sentiment <= 2
    assert sorted(map(tuple, rows)) == sorted(map(tuple, notes.collect()))


def test_seed_and_random_ids(spark, lexicon, corpus):
    users = spark.range(50)
    base = {r.user_id: r for r in make_notes(users, corpus, ADMISSION, lexicon=lexicon).collect()}
    other = {r.user_id: r for r in make_notes(users, corpus, ADMISSION, lexicon=lexicon, seed="2").collect()}
    fresh = {r.user_id: r for r in make_notes(users, corpus, ADMISSION, lexicon=lexicon, id_mode="random").collect()}
    assert any(base[u].notes != other[u].notes for u in base) and all(base[u].id != other[u].id for u in base)
    assert all(base[u].notes == fresh[u].notes and base[u].id != fresh[u].id for u in base)


def test_discharge_notes_lose_newlines_after_scoring(spark, corpus):
    notes = make_notes(spark.range(60), corpus, DISCHARGE, scorer=score_with(lambda: lambda text: float(text.count("\n"))))
    rows = notes.collect()
    assert all("\n" not in r.notes and r.notes_pos_sentiment == 1.0 for r in rows)


def test_provider_keys(spark, lexicon, corpus):
    providers = spark.createDataFrame([(11,), (12,)], "id int")
    rows = make_notes(spark.range(60), corpus, ADMISSION, lexicon=lexicon, providers=providers).collect()
    assert len(rows) == 60 and {r.provider_id for r in rows} == {11, 12}


def test_empty_corpus_is_refused(spark, lexicon):
    nothing = Corpus(spark.createDataFrame([], "idx long, text string"), 0)
    with pytest.raises(ValueError, match="no record"):
        make_notes(spark.range(1), nothing, ADMISSION, lexicon=lexicon)
    with pytest.raises(ValueError, match="either"):
        make_notes(spark.range(1), nothing, ADMISSION)


def test_three_folders(spark, lexicon, tmp_path):
    for kind, text in (
        (ADMISSION, "adm one\nadm two\n"),
        (FOLLOW_UP, f"fol\none{FOLLOW_UP_DELIMITER}fol two"),
        (DISCHARGE, f"dis\none{DISCHARGE_DELIMITER}dis two"),
    ):
        (tmp_path / kind.folder).mkdir(parents=True)
        (tmp_path / kind.folder / "a.txt").write_text(text)
    notes = doctor_notes(spark.range(40), note_corpora(spark, str(tmp_path)), lexicon=lexicon)
    got = {(r.notes_type, r.notes) for r in notes.collect()}
    assert notes.count() == 120
    assert got == {
        ("admission_notes", "adm one"), ("admission_notes", "adm two"), ("follow_up_notes", "fol\none"),
        ("follow_up_notes", "fol two"), ("discharge_notes", "disone"), ("discharge_notes", "dis two"),
    }
    assert len(KINDS) == 3


def bulky_folders(folder):
    for number, kind in enumerate(KINDS):
        (folder / kind.folder).mkdir(parents=True)
        records = [f"{kind.label} {i} is {'good ' * (i % 3)}{'x' * 50}" for i in range(90)]
        (folder / kind.folder / "a.txt").write_text(kind.delimiter.join(records))


def test_texts_of_folders_are_shuffled_once(spark, lexicon, tmp_path, monkeypatch):
    """Where the drawn numbers are too many to be broadcast, the join that drops the other texts is by note as well."""
    bulky_folders(tmp_path)
    corpora, users = note_corpora(spark, str(tmp_path)), spark.range(70)
    default = sorted(map(tuple, doctor_notes(users, corpora, lexicon=lexicon).collect()))
    monkeypatch.setattr("wardloom.operators.prefilter.is_small", lambda df: False)
    monkeypatch.setattr("wardloom.plans.notes.FEW_RECORDS", 0)
    notes = doctor_notes(users, corpora, lexicon=lexicon)
    plan = notes._jdf.queryExecution().executedPlan().toString()
    assert "hashpartitioning(note" in plan and "hashpartitioning(idx" not in plan and "hashpartitioning(_id" not in plan
    assert len(default) == 210 and sorted(map(tuple, notes.collect())) == default


def test_corpora_of_some_kinds(spark, tmp_path):
    bulky_folders(tmp_path)
    assert list(note_corpora(spark, str(tmp_path))) == list(KINDS)
    assert {kind: corpus.size for kind, corpus in note_corpora(spark, str(tmp_path), [FOLLOW_UP]).items()} == {FOLLOW_UP: 90}


def test_note_folders_are_deleted_once_they_are_read(spark, tmp_path, monkeypatch):
    held = []
    docs = spark.range(250).selectExpr("id doc_id", "concat('text ', id, '\n', repeat('the cat ', 20)) text")
    docs.write.parquet(str(tmp_path / "documents.parquet"))
    orders = spark.range(40).selectExpr("id o_orderkey", "id o_custkey", "'F' o_orderstatus", "'5-LOW' o_orderpriority")
    orders.write.parquet(str(tmp_path / "orders.parquet"))
    drop = queries._drop_files

    def counted(rows, folder, delimiter):
        held.append(len(list((tmp_path / "landing").rglob("*.txt"))))
        drop(rows, folder, delimiter)

    monkeypatch.setattr(queries, "_drop_files", counted)
    monkeypatch.setattr(queries, "fresh_dir", lambda spark, label: str(tmp_path / label))
    notes = queries.notes_from_folders(spark, str(tmp_path))
    assert held == [0, 0, 0] and not list((tmp_path / "landing").rglob("*.txt"))
    assert notes.groupBy("notes_type").count().collect() and notes.count() == 120
