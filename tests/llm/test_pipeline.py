"""The pipeline stage by stage against brute force, each on what the stage before it kept."""

from __future__ import annotations

import os
import random
from collections import Counter, defaultdict

import pytest

import corpus_pipeline
from tests.llm.test_operators import VOCABULARY, write
from wardloom.session import shared_dir

SIMILARITY = 0.8
PIPELINE_DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def documents() -> list[tuple]:
    rng = random.Random(11)
    line = lambda: " ".join(rng.choices(VOCABULARY, k=rng.randint(8, 14)))
    shared = [line() for _ in range(4)]
    rows = []
    for i in range(60):
        lines = [line() for _ in range(8)]
        if i % 4 == 0:
            lines[rng.randrange(8)] = rng.choice(shared)
        rows.append((i, "\n".join(lines), "en", rng.choice(["a", "b", "c", None])))
    for i in range(60, 75):  # near copies: a word in a line of many is another
        words = rows[i - 60][1].split(" ")
        words[rng.randrange(len(words))] = "changed"
        rows.append((i, " ".join(words), "en", "copies"))
    rows += [(80, None, "en", "a"), (81, "", None, "a"), (82, "too short", "en", "a"), (None, " ".join(rng.choices(VOCABULARY, k=90)), "en", None)]
    rows += [(90, rows[5][1], "en", "a"), (91, rows[5][1], "en", "a"), (91, rows[5][1], "en", "a"), (92, "\n".join(line() for _ in range(900)), "de", "long")]
    return [(*r, len(r[1] or "")) for r in rows]


@pytest.fixture(scope="module")
def stages(spark, tmp_path_factory):
    """Documents before the first stage and after each, every stage written and read again."""
    folder = write(spark, tmp_path_factory.mktemp("pipeline"), {"labels": [(i, int(i % 7 > 0), 0) for i in range(0, 60, 2)]})
    path = f"{folder}/pipeline-documents.parquet"
    spark.createDataFrame(documents(), PIPELINE_DOCS).write.parquet(path)
    docs = spark.read.parquet(path)
    out = [[r.asDict() for r in docs.collect()]]
    for number, (_, stage) in enumerate(corpus_pipeline.STAGES):
        stage(spark, docs, folder).write.parquet(f"{folder}/stage-{number}.parquet")
        docs = spark.read.parquet(f"{folder}/stage-{number}.parquet")
        out.append([r.asDict() for r in docs.collect()])
    return out


def test_columns_stay(stages):
    assert all(set(row) == {"doc_id", "text", "lang", "source", "n_chars"} for rows in stages[:-1] for row in rows)


def test_quality_keeps_documents_as_they_are(stages):
    given = Counter(map(str, stages[0]))
    kept = Counter(map(str, stages[1]))
    assert not kept - given and len(stages[1]) >= 60
    assert not {80, 81, 82} & {r["doc_id"] for r in stages[1]}


def alike(a: frozenset, b: frozenset) -> bool:
    return len(a & b) >= SIMILARITY * len(a | b) - 1e-9


def test_lines_that_repeat_go(stages):
    order = sorted(stages[1], key=lambda r: (r["doc_id"] is not None, r["doc_id"] or 0))
    seen: list[frozenset] = []
    wanted = Counter()
    equal: dict[str, str] = {}
    for row in order:
        kept = equal.get(str(row))
        if kept is None:
            kept = []
            for text in row["text"].split("\n"):
                words = frozenset(text.split())
                if not words or not any(alike(words, s) for s in seen):
                    kept.append(text)
                seen += [words] if words else []
            kept = equal[str(row)] = "\n".join(kept)
        if kept.split() or kept == row["text"]:
            wanted[row["doc_id"], kept] += 1
    assert Counter((r["doc_id"], r["text"]) for r in stages[2]) == wanted
    assert all(r["n_chars"] == len(r["text"]) for r in stages[2])


def shingles(text: str) -> frozenset:
    words = text.split()
    return frozenset(tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))) if words else frozenset()


def test_one_of_each_class_stays(stages):
    rows = [(r["doc_id"], shingles(r["text"])) for r in stages[2] if r["doc_id"] is not None]
    root = {i: i for i, _ in rows}
    find = lambda i: i if root[i] == i else find(root[i])
    for x, (i, a) in enumerate(rows):
        for j, b in rows[x + 1 :]:
            if a and b and alike(a, b) and find(i) != find(j):
                low, high = sorted((find(i), find(j)))
                root[high] = low
    wanted = {i for i, _ in rows if find(i) == i} | {r["doc_id"] for r in stages[2] if r["doc_id"] is None}
    assert {r["doc_id"] for r in stages[3]} == wanted


def test_mix_takes_from_every_source(stages):
    given = {(r["doc_id"], r["source"]): r["text"].split() for r in stages[3]}
    size, taken = defaultdict(int), defaultdict(int)
    for (_, source), words in given.items():
        size[source] += len(words)
    copies = Counter()
    for row in stages[4]:
        words = given[row["doc_id"], row["source"]]
        part = row["text"].split()
        assert part and not Counter(part) - Counter(words)
        copies[row["doc_id"], row["source"]] += len(part)
        taken[row["source"]] += len(part)
        assert row["n_chars"] == len(row["text"])
    assert all(n <= 2 * len(given[key]) for key, n in copies.items())
    assert taken.keys() == {s for s, n in size.items() if n} and sum(taken.values()) == pytest.approx(1.5 * sum(size.values()), rel=0.1)


def test_packing_places_every_piece(stages):
    pieces = stages[5]
    assert Counter(p["doc_id"] for p in pieces if p["piece"] == 0) == Counter(r["doc_id"] for r in stages[4])
    by_sequence = defaultdict(list)
    for p in pieces:
        by_sequence[p["sequence_id"]].append((p["offset"], p["length"]))
    for spans in by_sequence.values():
        end = 0
        for offset, length in sorted(spans):
            assert offset == end
            end += length
        assert end <= 4096
    total = sum(p["length"] for p in pieces)
    assert len(by_sequence) <= 1 + 1.1 * total / 4096


def test_run_leaves_only_what_is_read(spark, tmp_path):
    folder = write(spark, tmp_path, {"documents": [(*r, "x", 1, "y") for r in documents()], "labels": [(i, i % 2, 0) for i in range(30)]})
    before = set(os.listdir(shared_dir(spark)))
    out = corpus_pipeline.run(spark, folder)
    left = set(os.listdir(shared_dir(spark))) - before
    assert out.count() and len(left) <= 4, left

