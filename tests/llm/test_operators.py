"""The dealt operators against brute force, and on nulls, empty and long texts, repeated rows, empty tables and clashing names."""

from __future__ import annotations

import random
import zlib

import numpy as np
import pytest

import corpus_pipeline
from wardloom.llm import best_fit_packing, license_scan, ngram_join, source_mix
from wardloom.llm.queries import ORACLE, QUERIES

DOCS = "doc_id long, text string, lang string, source string, n_chars long, line string, row int, size string"
SCHEMAS = {
    "documents": DOCS,
    "labels": "doc_id long, quality int, toxic int",
    "pages": "page_id long, url string, html string",
    "embeddings": "vec_id long, embedding array<float>, label int",
    "conversations": "conv_id long, turn long, role string, text string",
}
#: op13 adds a conversation of its own.
ROWS_OF_NOTHING = {"op13_chat_windows": 1}
VOCABULARY = [f"word{i}" for i in range(400)]


def prose(seed: int, n: int = 80) -> list[str]:
    return random.Random(seed).choices(VOCABULARY, k=n)


def texts() -> list[str | None]:
    base = prose(1)
    near = [*base[:-1], "changed"]
    plain = [" ".join(prose(i)) for i in range(10, 40)]
    shared = "this very line stands word for word in two of the texts"
    return [
        " ".join(base), " ".join(base), " ".join(near), None, "", " \n\t ", "a", " ".join(prose(2, 9000)),
        "first\n" + shared, "other beginning\n" + shared, "Licensed under CC BY 4.0.", *plain,
    ]


def write(spark, folder, tables: dict[str, list]) -> str:
    for name, schema in SCHEMAS.items():
        spark.createDataFrame(tables.get(name, []), schema).write.parquet(f"{folder}/{name}.parquet")
    return str(folder)


@pytest.fixture(scope="module")
def edge(spark, tmp_path_factory):
    docs = [(i, t, (None, "en", "de")[i % 3], (None, "web", "web", "books")[i % 4], len(t or ""), "x", 1, "y") for i, t in enumerate(texts())]
    docs.append((None, "no id here", None, None, None, None, None, None))
    rng = np.random.default_rng(3)
    vectors = [(i, rng.normal(size=8).astype("float32").tolist(), 0) for i in range(60)]
    vectors += [(60, vectors[0][1], 0), (61, None, 0), (62, [0.0] * 8, 0), (80, [float("nan")] * 8, 0), (100, [None] * 8, 0)]
    return write(spark, tmp_path_factory.mktemp("edge"), {
        "documents": docs,
        "labels": [(i, int(i % 2), int(i % 5 == 1)) for i in range(len(docs) - 1)],
        "pages": [(1, "u", "<a>"), (2, "v", "<a>"), (3, None, None), (4, "w", ""), (5, "x", "é" * 5000)],
        "embeddings": vectors,
    })


@pytest.fixture(scope="module")
def empty(spark, tmp_path_factory):
    return write(spark, tmp_path_factory.mktemp("empty"), {})


def rows_of(spark, name, folder):
    return [r.asDict() for r in QUERIES[name](spark, folder).collect()]


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_empty_tables(spark, empty, name):
    assert len(rows_of(spark, name, empty)) == ROWS_OF_NOTHING.get(name, 0)


def test_only_sql_is_given():
    assert ORACLE.keys() <= QUERIES.keys() and all(isinstance(sql, str) for sql in ORACLE.values())


def test_quality_rules_counts_words(spark, edge):
    out = {r["doc_id"]: r for r in rows_of(spark, "op1_quality_rules", edge)}
    for i, text in enumerate(texts()):
        words = (text or "").split()
        assert (out[i]["n_words"], out[i]["word_chars"]) == (len(words), sum(map(len, words)))
        assert not (out[i]["base_failed"] and out[i]["kept"])
        assert out[i]["base_failed"] or len(words) >= 50


def test_source_mix_meets_its_targets(spark, edge):
    out = rows_of(spark, "op2_source_mix", edge)
    assert len(out) == len(texts()) + 1
    assert all(0 <= r["taken"] <= 2 * r["size"] for r in out)
    again = rows_of(spark, "op2_source_mix", edge)
    key = lambda r: (r["doc_id"] is None, r["doc_id"] or 0)
    assert sorted(out, key=key) == sorted(again, key=key)


def test_capped_targets_share_the_excess():
    assert source_mix.capped_targets([100, 100, 100], [3, 1, 2]) == pytest.approx([200, 250 / 3, 500 / 3])


@pytest.mark.parametrize("n", [1, 2, 3, 7, 100, 1000])
def test_permutation_hits_every_index_once(n):
    assert sorted(source_mix.permuted(np.arange(n), np.full(n, n), np.full(n, np.uint64(9))).tolist()) == list(range(n))


def test_hilbert_search_finds_the_nearest(spark, edge):
    out = rows_of(spark, "op3_hilbert_search", edge)
    rng = np.random.default_rng(3)
    vectors = {i: rng.normal(size=8).astype("float32").astype(float) for i in range(60)}
    vectors[60] = vectors[0]
    assert {r["query_id"] for r in out} == {0, 20, 40, 60}
    hits = 0
    for q in (0, 20, 40, 60):
        mine = sorted((r for r in out if r["query_id"] == q), key=lambda r: r["rank"])
        assert [r["rank"] for r in mine] == list(range(1, 21))
        assert all(r["score"] == pytest.approx(float(vectors[q] @ vectors[r["vec_id"]]), abs=1e-12) for r in mine)
        best = sorted((v for v in vectors if v != q), key=lambda v: (-float(vectors[q] @ vectors[v]), v))[:20]
        hits += len(set(best) & {r["vec_id"] for r in mine})
    assert hits >= 0.9 * 80


def test_language_id(spark, edge):
    out = {r["doc_id"]: r for r in rows_of(spark, "op4_language_id", edge)}
    assert len(out) == len(texts()) + 1
    for i, text in enumerate(texts()):
        assert out[i]["held_out"] == (zlib.crc32(str(i).encode()) % 4 == 2)
        assert (out[i]["lang_pred"] == "und") == (not any(c.isalpha() for c in text or ""))
        assert 0 <= out[i]["score"] <= 1


def test_license_scan(spark, edge):
    found = rows_of(spark, "op5_license_scan", edge)
    assert any(r["doc_id"] == 10 and r["license"] == "cc-by-4.0" and r["confirmed"] for r in found)
    assert not license_scan.Scanner(license_scan.TEMPLATES).confirm("mit", "all about gardens and trees")[0]


def shingles(text: str | None) -> frozenset:
    words = (text or "").split()
    return frozenset(tuple(words[i : i + 5]) for i in range(len(words) - 4)) or frozenset([tuple(words)] if words else [])


def test_ngram_join_against_all_pairs(spark, edge):
    out = {r["doc_id"]: r for r in rows_of(spark, "op6_ngram_jaccard_join", edge)}
    sets = [shingles(t) for t in texts()]
    for i, a in enumerate(sets):
        linked = [j for j, b in enumerate(sets) if j != i and a and b and len(a & b) >= 0.8 * len(a | b)]
        assert out[i]["n_links"] == len(linked), i
        assert out[i]["class_id"] == min([i, *linked])
    bands, rows = ngram_join.bands_and_rows(0.8, ngram_join.RECALL)
    assert 1 - (1 - 0.8**rows) ** bands >= ngram_join.RECALL


def test_toxicity(spark, edge):
    out = {r["doc_id"]: r for r in rows_of(spark, "op7_toxicity", edge)}
    assert len(out) == len(texts()) + 1
    for i in range(len(texts())):
        assert out[i]["held_out"] == (zlib.crc32(str(i).encode()) % 5 == 0)
        assert 0 <= out[i]["score"] <= 1 and out[i]["predicted"] == int(out[i]["score"] >= 0.5)


def test_warc_round_trip(spark, edge):
    out = {r["page_id"]: r for r in rows_of(spark, "op8_warc_bundles", edge)}
    assert [(out[i]["record_type"], out[i]["refers_to"]) for i in (1, 2, 3, 4, 5)] == [
        ("response", None), ("revisit", 1), ("response", None), ("revisit", 3), ("response", None)]
    assert out[5]["payload_bytes"] == 10000


def test_packing_is_whole_and_gapless(spark, edge):
    from tokenizers import Tokenizer

    encode = Tokenizer.from_file(best_fit_packing.vocabulary()).encode
    out = rows_of(spark, "op9_best_fit_packing", edge)
    for i, text in enumerate(texts()):
        ids = np.array([*encode(text or "", add_special_tokens=False).ids, 1], "<u4")
        pieces = sorted((r for r in out if r["doc_id"] == i), key=lambda r: r["piece"])
        assert sum(r["length"] for r in pieces) == len(ids)
        for r in pieces:
            assert r["ids_crc32"] == zlib.crc32(ids[r["start"] : r["start"] + r["length"]].tobytes())
    bins: dict = {}
    for r in sorted(out, key=lambda r: r["offset"]):
        assert bins.setdefault(r["sequence_id"], 0) == r["offset"]
        bins[r["sequence_id"]] += r["length"]
    assert max(bins.values()) <= 4096


def test_line_dedup_against_all_pairs(spark, edge):
    out = {r["doc_id"]: r for r in rows_of(spark, "op10_line_dedup", edge) if r["doc_id"] is not None}
    seen: list[frozenset] = []
    for i, text in enumerate(texts()):
        stay = []
        for line in (text.split("\n") if text is not None else []):
            words = frozenset(line.split())
            if not words or not any(5 * len(words & s) >= 4 * len(words | s) for s in seen):
                stay.append(line)
            if words:
                seen.append(words)
        assert out[i]["text"] == (None if text is None else "\n".join(stay)), i


def test_pipeline_keeps_columns_and_packs(spark, edge):
    docs = spark.read.parquet(f"{edge}/documents.parquet")
    for _, stage in corpus_pipeline.STAGES[:-1]:
        assert stage(spark, docs, edge).columns == docs.columns
    assert {"doc_id", "sequence_id", "offset"} <= set(corpus_pipeline.run(spark, edge).columns)
