import random

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from wardloom.functions.text import DISCHARGE_DELIMITER, FOLLOW_UP_DELIMITER, cut_records, score_with, strip_newlines
from wardloom.operators import corpus as corpus_module
from wardloom.operators import prefilter
from wardloom.operators.corpus import Corpus, corpus_of_folder, corpus_of_texts
from wardloom.operators.growing import GrowingCorpus
from wardloom.operators.picks import assign_text
from wardloom.session import materialize
from wardloom.sources.text import _cutter, read_text_files, read_text_lines


@pytest.mark.parametrize("delimiter", ["\n", ". ", "a.b", "--", "\\E", "$", DISCHARGE_DELIMITER, FOLLOW_UP_DELIMITER])
def test_cut_equals_string_split(spark, delimiter):
    rng = random.Random(3)
    pieces = ["", " ", "x", "a", ".", "-", "é\r", "\n", delimiter, delimiter, delimiter[:1] * 3, "日本"]
    texts = ["".join(rng.choices(pieces, k=rng.randint(0, 12))) for _ in range(200)]
    df = spark.createDataFrame(list(enumerate(texts)), "i int, t string")
    got = {r.i: r.r for r in df.select("i", cut_records(F.col("t"), delimiter).alias("r")).collect()}
    for i, text in enumerate(texts):
        assert got[i] == [x for x in text.split(delimiter) if x != ""]


def write(path, text):
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_bytes(text.encode())


@pytest.fixture
def folder(tmp_path):
    write(tmp_path / "b.txt", "one\r\n\n \nzwei é\n")
    write(tmp_path / "a.txt", "first\nlast")
    write(tmp_path / "c" / "deep.txt", "deep\n\n")
    write(tmp_path / "skip.TXT", "no\n")
    write(tmp_path / "skip.md", "no\n")
    return str(tmp_path)


def records(corpus):
    rows = sorted((r.idx, r.text) for r in corpus.records.collect())
    assert [i for i, _ in rows] == list(range(corpus.size))
    return [t for _, t in rows]


EXPECTED = ["first", "last", "one\r", " ", "zwei é", "deep"]


def test_newline_folder(spark, folder):
    assert records(corpus_of_folder(spark, folder, "\n")) == EXPECTED
    assert read_text_files(spark, folder).count() == 3


def test_lines_and_whole_files_agree(spark, folder):
    assert records(corpus_of_texts(read_text_files(spark, folder), "file", "text", "\n")) == EXPECTED


def test_lines_of_a_file_in_many_splits(spark, tmp_path):
    lines = [f"line {i} " + "x" * (i % 50) for i in range(5000)]
    write(tmp_path / "big.txt", "\n".join(lines))
    spark.conf.set("spark.sql.files.maxPartitionBytes", "20000")
    try:
        assert read_text_lines(spark, str(tmp_path)).select("block").distinct().count() > 3
        assert records(corpus_of_folder(spark, str(tmp_path), "\n")) == lines
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")


def test_splits_may_change_between_build_and_read(spark, tmp_path):
    lines = [f"line {i} " + "x" * (i % 50) for i in range(5000)]
    write(tmp_path / "big.txt", "\n".join(lines))
    spark.conf.set("spark.sql.files.maxPartitionBytes", "20000")
    try:
        corpus = corpus_of_folder(spark, str(tmp_path), "\n")
        spark.conf.set("spark.sql.files.maxPartitionBytes", "70000")
        assert corpus.size == len(lines) and records(corpus) == lines
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")


def test_folder_order_is_that_of_the_names(spark, tmp_path):
    for name in ("a b.txt", "a!b.txt", "a+b.txt", "a%b.txt"):
        write(tmp_path / name, name)
    assert records(corpus_of_folder(spark, str(tmp_path), "\n")) == sorted(["a b.txt", "a!b.txt", "a+b.txt", "a%b.txt"])


def test_dash_folder(spark, tmp_path):
    text = f"a\nb{DISCHARGE_DELIMITER}{DISCHARGE_DELIMITER}c-{DISCHARGE_DELIMITER}---d{DISCHARGE_DELIMITER}"
    write(tmp_path / "x.txt", text)
    wanted = [x for x in text.split(DISCHARGE_DELIMITER) if x]
    assert records(corpus_of_folder(spark, str(tmp_path), DISCHARGE_DELIMITER)) == wanted


def test_folder_without_records(spark, tmp_path):
    write(tmp_path / "x.txt", "\n\n")
    with pytest.raises(ValueError, match="no record"):
        corpus_of_folder(spark, str(tmp_path), "\n")


def test_repeated_text_keys_are_refused(spark):
    df = spark.createDataFrame([(1, "a"), (1, "b")], "k int, t string")
    with pytest.raises(ValueError, match="unique"):
        corpus_of_texts(df, "k", "t", "\n")


def test_null_and_empty_texts_have_no_records(spark):
    df = spark.createDataFrame([(1, None), (2, ""), (3, "x\ny")], "k int, t string")
    assert records(corpus_of_texts(df, "k", "t", "\n")) == ["x", "y"]


def test_strip_newlines(spark):
    df = spark.createDataFrame([("a\nb\r\n\nc",), (None,)], "t string")
    assert [r[0] for r in df.select(strip_newlines(F.col("t"))).collect()] == ["ab\rc", None]


def test_score_with(spark):
    df = spark.createDataFrame([("abc",), (None,), ("",)], "t string")
    score = score_with(lambda: lambda text: float(len(text)))
    assert [r[0] for r in df.select(score(F.col("t"))).collect()] == [3.0, None, 0.0]


# -- delimiters in files that are read in splits -----------------------------------------------

CUTS = ("---", "-" * 10, "ab", "é.")


@pytest.mark.parametrize("split_bytes,delimiter", [(1500, "---"), (1501, "-" * 10), (4001, "ab"), (90_000, "é.")])
def test_cut_of_splits_equals_cut_of_the_whole(spark, tmp_path, split_bytes, delimiter):
    """Runs of delimiter characters of every length, over the ends of splits and lines."""
    rng = random.Random(split_bytes)
    contents = {"empty.txt": "", "newline.txt": "\n", "plain.txt": "a\nb", "one line.txt": "-" * 9000 + "text" + "-" * 4999}
    for i in range(3):
        pieces = ["-" * rng.randint(1, 25), "\n", "\r\n", "ab" * rng.randint(1, 3), "é.", "é", "text ", "日本"]
        contents[f"f{i}.txt"] = "".join(rng.choices(pieces, weights=[1, 1, 1, 1, 1, 3, 30, 3], k=3000))
    for name, text in contents.items():
        write(tmp_path / name, text)
    spark.conf.set("spark.sql.files.maxPartitionBytes", str(split_bytes))
    spark.conf.set("spark.sql.files.openCostInBytes", "1")
    try:
        wanted = [x for name in sorted(contents) for x in contents[name].split(delimiter) if x]
        assert records(corpus_of_folder(spark, str(tmp_path), delimiter)) == wanted
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
        spark.conf.unset("spark.sql.files.openCostInBytes")


@given(st.lists(st.text(st.sampled_from("-a\n\r"), max_size=30), min_size=1, max_size=5), st.integers(1, 4))
@settings(deadline=None)
def test_cutter_by_lines_and_blocks(lines_of_blocks, width):
    """The cut alone, without Spark: its pieces, joined as the plan joins them, are those of the whole text."""
    import pyarrow as pa

    blocks = [text.split("\n") for text in lines_of_blocks]
    rows = [("f", number, 0, line.encode()) for number, lines in enumerate(blocks) for line in lines]
    batch = pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*rows, strict=True)], names=["file", "block", "size", "line"])
    cuts = [row for out in _cutter(b"-" * width)(iter([batch.slice(0, 2), batch.slice(2)])) for row in out.to_pylist()]
    records = {}
    opener = None
    for row in sorted(cuts, key=lambda r: (r["block"], r["seq"] is not None, r["seq"] or 0)):
        if row["opens"]:
            opener = (row["block"], row["seq"])
            records[opener] = row["text"]
        else:
            records[opener] += "\n" + row["text"]
    assert [t for t in records.values() if t] == [x for x in "\n".join(lines_of_blocks).split("-" * width) if x]


def test_whole_records_are_written_once(spark, tmp_path, monkeypatch):
    """Only those that had to be joined from the pieces of several splits are written a second time."""
    write(tmp_path / "a.txt", "---".join(f"record {i}\nof {i % 7} lines" for i in range(500)))
    written = {}

    def counted(df, label, compression=None):
        frame = materialize(df, label, compression)
        written[label] = frame.count()
        return frame

    monkeypatch.setattr("wardloom.sources.text.materialize", counted)
    assert corpus_of_folder(spark, str(tmp_path), "---").size == 500
    assert written["records"] >= 500 and sum(written.values()) < 510


def test_delimiter_with_a_newline_reads_whole_files(spark, tmp_path):
    write(tmp_path / "a.txt", "one-\n-two\n\nthree-\n-")
    assert records(corpus_of_folder(spark, str(tmp_path), "-\n-")) == ["one", "two\n\nthree"]


# -- drawing from a corpus ---------------------------------------------------------------------


@pytest.mark.parametrize("bytes_of_a_broadcast", [64 << 20, 0])
def test_drawn_records(spark, monkeypatch, bytes_of_a_broadcast):
    monkeypatch.setattr(corpus_module, "LOOKUP_WIDTH", 7)
    monkeypatch.setattr(prefilter, "is_small", lambda df: bytes_of_a_broadcast > 0)
    rng = random.Random(1)
    texts = [(i, "#".join(f"r{i}.{j}" for j in range(rng.choice([0, 1, 2, 30])))) for i in range(60)] + [(99, None)]
    corpus = corpus_of_texts(spark.createDataFrame(texts, "k int, t string"), "k", "t", "#")
    every = dict(map(tuple, corpus.records.collect()))
    assert sorted(every) == list(range(corpus.size))
    for wanted in (range(corpus.size), rng.sample(range(corpus.size), 15), [0, corpus.size - 1], []):
        frame = spark.createDataFrame([(i,) for i in wanted], "idx long")
        assert dict(map(tuple, corpus.drawn(frame).collect())) == {i: every[i] for i in wanted}
        assert dict(map(tuple, Corpus(corpus.records, corpus.size).drawn(frame).collect())) == {i: every[i] for i in wanted}


def test_only_drawn_texts_move(spark, tmp_path):
    """Few draws: the texts are joined where they are. Many: a vector drops the others before the shuffle."""
    spark.range(5000).selectExpr("id", "concat('text ', id) as t").write.parquet(str(tmp_path / "t"))
    corpus = corpus_of_texts(spark.read.parquet(str(tmp_path / "t")), "id", "t", "#")
    drawn = corpus.drawn(spark.range(40).select((F.col("id") * 100).alias("idx")))
    plan = drawn._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "Exchange hashpartitioning" not in plan and drawn.count() == 40
    keys = spark.range(0, 5000, 100)
    passed = prefilter.likely_partners(corpus.texts, keys, "id")
    assert 50 <= passed.count() < 60 and passed.join(keys, "id").count() == 50


# -- a corpus that grows -------------------------------------------------------------------------


def test_growing_corpus(spark, tmp_path):
    folder = tmp_path / "in"
    growing = GrowingCorpus(spark, str(tmp_path / "index"))
    write(folder / "b.txt", "b1\nb2\n")
    write(folder / "z [1] {a,b}*.txt", "z1\n")
    assert growing.take_in(str(folder), "\n") == 3
    first = dict(map(tuple, growing.corpus().records.collect()))
    assert first == {0: "b1", 1: "b2", 2: "z1"}
    write(folder / "a.txt", "a1\na2")
    write(folder / "deep" / "c.txt", "c1")
    write(folder / "empty.txt", "\n")
    assert growing.take_in(str(folder), "\n") == 6 == growing.take_in(str(folder), "\n")
    now = dict(map(tuple, growing.corpus().records.collect()))
    assert {i: t for i, t in now.items() if i < 3} == first and [now[i] for i in (3, 4, 5)] == ["a1", "a2", "c1"]
    users = spark.range(50)
    draw = lambda corpus: sorted(map(tuple, assign_text(users, ["id"], "s", corpus).collect()))
    assert draw(growing.corpus(3)) == draw(Corpus(spark.createDataFrame(list(first.items()), "idx long, text string"), 3))
    with pytest.raises(ValueError, match="6 records"):
        growing.corpus(7)
