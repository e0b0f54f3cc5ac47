"""Line dedup: results against all pairs, and how many pairs it verifies."""

from __future__ import annotations

import random

import pytest

from wardloom.llm import line_dedup

SPACES = [" ", "  ", "\t", "\x0b", " \x0c", "\r "]


def texts() -> list[str]:
    rng = random.Random(5)
    vocabulary = [f"w{i}" for i in range(1500)]
    out = []
    for _ in range(60):  # unlike lines with a word in common; most are larger than a narrow bitmap, some just so
        size = rng.choice([30, 44, 48, 52, 60, 150, 200])
        out.append(rng.sample(vocabulary, size) + ["common", "also"])
    for words in list(out):  # near copies on both sides of the threshold
        for share in (0.04, 0.1, 0.13):
            copy = [w for w in words if rng.random() > share] + [f"n{rng.randrange(9)}" for _ in range(int(share * len(words) / 2))]
            rng.shuffle(copy)
            out.append(copy)
    rng.shuffle(out)
    return ["".join(w + rng.choice(SPACES) for w in words) for words in out]


@pytest.fixture(scope="module")
def docs(spark):
    lines = texts()
    return [(i, "\n".join(lines[i * 4 : i * 4 + 4])) for i in range(len(lines) // 4)]


def test_lines_against_all_pairs(spark, docs):
    frame = spark.createDataFrame(docs, "doc_id long, text string")
    out = {r["doc_id"]: r["text"] for r in line_dedup.dedup_lines(frame).collect()}
    seen: list[frozenset] = []
    lost = 0
    for i, text in docs:
        stay = []
        for line in text.split("\n"):
            words = frozenset(line.split())
            if any(5 * len(words & s) >= 4 * len(words | s) for s in seen):
                lost += 1
            else:
                stay.append(line)
            seen.append(words)
        assert out[i] == "\n".join(stay), i
    assert 60 < lost < len(docs) * 4 - 60


def test_unlike_long_lines_are_not_verified(spark, monkeypatch):
    """A bitmap of 64 bits tells sets of 150 words hardly apart; each pair with a rare word in common was verified."""
    rng = random.Random(6)
    rows = [(i, " ".join([f"v{k}" for k in rng.sample(range(3000), 150)])) for i in range(300)]
    verified = []

    def counted(df, label, compression=None, write=line_dedup.materialize):
        out = write(df, label, compression)
        if label == "line-pairs":
            verified.append(out.count())
        return out

    monkeypatch.setattr(line_dedup, "materialize", counted)
    out = line_dedup.dedup_lines(spark.createDataFrame(rows, "doc_id long, text string"))
    assert out.filter("lines_removed > 0").isEmpty()
    assert sum(verified) <= 30


def test_prefixes_are_shuffled_once_and_ranks_stay_short(spark, docs, monkeypatch):
    """Each part of the prefixes was shuffled for either side; the ranks were a text of 1.8 MB in a plan the driver copies."""
    plans, texts = [], []

    def watched(df, label, compression=None, write=line_dedup.materialize):
        if label == "part-pairs":
            df.collect()
            plans.append(df._jdf.queryExecution().executedPlan().toString())
        return write(df, label, compression)

    def parsed(text, expr=line_dedup.F.expr):
        texts.append(len(text))
        return expr(text)

    monkeypatch.setattr(line_dedup, "materialize", watched)
    monkeypatch.setattr(line_dedup.F, "expr", parsed)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        line_dedup.dedup_lines(spark.createDataFrame(docs, "doc_id long, text string")).collect()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert plans and all("ReusedExchange" in plan for plan in plans)
    assert max(texts) < 500_000


def test_bitmaps_visit_each_word_once(spark):
    """Wide bitmaps went through all words once for each quarter; they are the same by slices, and pass every similar pair."""
    rng = random.Random(8)
    rows = [(i, " ".join(f"v{rng.randrange(400)}" for _ in range(n))) for i, n in enumerate([1, 2, 47, 48, 49, 50, 70, 120, 300] * 3)]
    sets = spark.createDataFrame(rows, "line long, text string").select("line", line_dedup.word_set(line_dedup.F.col("text")).alias("words"))
    out = line_dedup.with_bitmap(sets.withColumn("n", line_dedup.F.size("words"))).collect()
    signed = lambda x: x - (1 << 64) if x >> 63 else x
    for r in out:
        quarters = [0] * line_dedup.WIDE
        for w in r["words"]:
            quarters[(w + (1 << 63)) >> 62 if r["n"] > line_dedup.NARROW else 0] ^= 1 << (w & 63)
        whole = 0
        for bits in quarters:
            whole ^= bits
        assert [r[c] for c in line_dedup.BITMAP] == [signed(bits) for bits in (whole, *quarters[1:])], r["line"]
    assert sum(r["n"] > line_dedup.NARROW for r in out) > 6


def test_only_large_groups_look_for_leaders(spark, monkeypatch):
    """Every last word of every prefix was shuffled with its line, twice; small groups of copies now go to the join of prefixes alone."""
    rng = random.Random(9)
    counts: dict[str, list[int]] = {}

    def counted(df, label, compression=None, write=line_dedup.materialize):
        out = write(df, label, compression)
        counts.setdefault(label, []).append(out.count())
        return out

    def copies(groups, size):
        out = []
        for g in range(groups):
            words = [f"g{size}x{g}w{k}" for k in range(40)]
            out += [" ".join([*words[:i % 40], f"n{g}x{i}", *words[i % 40 + 1 :]]) for i in range(size)]
        return out

    monkeypatch.setattr(line_dedup, "materialize", counted)
    for groups, size in ((30, 8), (1, 200)):
        lines = copies(groups, size)
        rng.shuffle(lines)
        counts.clear()
        out = line_dedup.dedup_lines(spark.createDataFrame(list(enumerate(lines)), "doc_id long, text string"))
        seen, lost = [], 0
        for line in lines:
            words = frozenset(line.split())
            lost += any(5 * len(words & s) >= 4 * len(words | s) for s in seen)
            seen.append(words)
        assert out.agg({"lines_removed": "sum"}).first()[0] == lost > 150
        assert (counts["heads-of-many"] == [0]) == (size <= line_dedup.FEW)
        assert sum(counts["line-pairs"]) <= len(lines) * line_dedup.FEW
