"""The two audits against SQL and brute force, and chat windows by round trip, on edge cases and odd sizes."""

from __future__ import annotations

import hashlib
import random
from collections import Counter, defaultdict
from itertools import permutations

import pyarrow as pa
import pytest
from hypothesis import given
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tests.compare import compare, connect
from wardloom.llm import chat_windows as chat
from wardloom.llm import filter_audit, source_divergence
from wardloom.llm.queries import ORACLE, QUERIES

DOCS = "doc_id long, text string, lang string, source string, n_chars long, part string, term string, mask int, n long, value long, stripe string"
LABELS = "doc_id long, quality int, toxic int, part string"


def documents(seed: int = 5, n: int = 240) -> list[tuple]:
    rng = random.Random(seed)
    words = ["Alpha", "beta", "GAMMA", "naïve", "été", "x1y", "don't", "ÀB", "#tag", "A|B", " sep", "nul\x00nul", "plain", "word", "of", "the"]
    rows = []
    for i in range(n):
        text = rng.choice([" ", "\n", "\t "]).join(rng.choices(words, k=rng.choice([0, 1, 5, 60, 300])))
        rows.append((i, text, rng.choice(["en", "en", "en", "de", None, ""]), rng.choice(["web", "web", "books", None, "é"]), len(text)))
    rows += [(1000 + i, rows[3][1], "en", "web", 0) for i in range(40)]  # copies
    rows += [(1000, rows[3][1], "en", "web", 0)] * 3 + [(None, rows[3][1], "en", "web", 0)] * 2 + [(None, None, None, None, None), (2000, None, "de", "web", 0)]
    rows += [(3000, " ".join(rng.choices(words, k=60_000)), "fr", "long", 0), (3001, "Only " * 300, "it", "one", 0)]
    rows += [(-5, rows[3][1], "de", "other", 0), (1000, "another text of this id", "fr", "web", 0)]
    return [(*r, "p", "t", 1, 2, 3, "s") for r in rows]


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    out = tmp_path_factory.mktemp("audits")
    spark.createDataFrame(documents(), DOCS).write.parquet(f"{out}/documents.parquet")
    labels = [(i, (i // 2) % 2, i % 2, "z") for i in range(0, 240, 3)] + [(6, 1, 0, "z"), (6, 0, 1, "z"), (None, 1, 1, "z"), (9, None, None, "z"), (1000, 1, 1, None)]
    spark.createDataFrame(labels, LABELS).write.parquet(f"{out}/labels.parquet")
    return str(out)


@pytest.mark.parametrize("name", ["op11_source_divergence", "op12_filter_audit"])
def test_against_sql(spark, folder, name):
    assert compare(spark, connect(folder), QUERIES[name], ORACLE[name], folder) is None


def brute_divergences(rows, min_docs, top):
    split = lambda text: "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c if c >= "\x80" or "a" <= c <= "z" else " " for c in text).split(" ")
    docs, counts, groups = defaultdict(Counter), defaultdict(Counter), defaultdict(set)
    for row in rows:
        text, lang, source = (v or "" for v in row[1:4])
        terms = [t for t in split(text) if t]
        groups[lang].add(source)
        docs[lang].update(set(terms))
        counts[lang, source].update(terms)
    out = set()
    for lang, sources in groups.items():
        kept = [t for t, d in docs[lang].items() if d >= min_docs]
        share = {}
        for s in sources:
            n = sum(counts[lang, s][t] for t in kept)
            share[s] = {t: 1 + 10**9 * (counts[lang, s][t] + 5) // (n + 5 * len(kept)) for t in kept}
        whole = {t: sum(counts[lang, s][t] for s in sources) for t in kept}
        whole = {t: 1 + 10**9 * (c + 5) // (sum(whole.values()) + 5 * len(kept)) for t, c in whole.items()}
        for s in sources:
            pairs = [(sum(abs(share[s][t] - share[o][t]) for t in kept), o) for o in sources if o != s]
            terms = [(share[s][t] - whole[t], t) for t in kept if counts[lang, s][t] and share[s][t] > whole[t]]
            for part, found in (("pair", pairs), ("term", terms)):
                found.sort(key=lambda x: (-x[0], x[1].encode()))
                out |= {(lang, s, part, item, value, r) for r, (value, item) in enumerate(found, 1) if part == "pair" or r <= top}
    return out


@pytest.mark.parametrize("spill,cells,dense", [(1_000_000, 1 << 16, 1 << 20), (20, 40, 3)])
def test_divergences_whatever_is_spilled_or_cut(spark, monkeypatch, spill, cells, dense):
    """The fold is run here, where the sizes can be made small; the stages after it run in Spark."""
    monkeypatch.setattr(source_divergence, "SPILL_ROWS", spill)
    monkeypatch.setattr(source_divergence, "CHUNK_BYTES", 400)
    monkeypatch.setattr(source_divergence, "DENSE_CELLS", dense)
    monkeypatch.setattr(source_divergence, "GROUP_CELLS", cells)
    rows = documents(8, 120)
    batch = pa.RecordBatch.from_arrays([pa.array([r[i] or "" for r in rows]) for i in (2, 3, 1)], names=["lang", "source", "text"])
    stripes = [b.to_pylist() for b in source_divergence.fold_stripes(iter([batch, batch.slice(0, 0)]))]
    found, seen = Counter(), Counter()
    for row in (r for part in stripes for r in part):
        for source, n, docs in zip(row["sources"], row["counts"], row["docs"], strict=True):
            found[row["lang"], row["term"], source] += n
            seen[row["lang"], row["term"]] += docs
    assert (len(stripes) > 1) == (spill == 20)
    docs = spark.createDataFrame(rows, DOCS).select(*[F.coalesce(c, F.lit("")).alias(c) for c in ("lang", "source", "text")])
    out = source_divergence.divergences(docs, min_docs=20, top=4).collect()
    wanted = brute_divergences(rows, 20, 4)
    assert len(out) == len(wanted) and {(r.lang, r.source, r.part, r.item, r.value, r.rank) for r in out} == wanted
    merged = {(r.lang, r.term): {s.source: s.n for s in r.stripe} for r in source_divergence.kept_stripes(docs, 20).collect()}
    assert merged == {k: {s: n for (lang, term, s), n in found.items() if (lang, term) == k} for k, d in seen.items() if d >= 20}


def test_scaled_is_exact_for_large_counts():
    import numpy as np

    counts, total, terms = [0, 7, 10**13, 3 * 10**14 + 1], 7 * 10**14 + 13, 10**7 + 19
    wanted = [1 + 10**9 * (c + 5) // (total + 5 * terms) for c in counts]
    assert source_divergence.scaled(np.array(counts), np.int64(total), terms).tolist() == wanted


def test_shapley_is_the_mean_over_orders(spark):
    rng = random.Random(4)
    patterns = [("p", m, rng.randrange(50), rng.randrange(9), rng.randrange(9)) for m in range(32)]
    game = filter_audit.removal_game(spark.createDataFrame(patterns, "part string, mask int, n long, good long, toxic long")).first()
    value = lambda s: sum(n for _, m, n, _, _ in patterns if m & s)
    assert list(game["n"]) == [value(s) for s in range(32)]
    for i in range(5):
        total = 0
        for order in permutations(range(5)):
            before = sum(1 << j for j in order[: order.index(i)])
            total += value(before | 1 << i) - value(before)
        assert game["potential"][31] - game["potential"][31 & ~(1 << i)] == total


# -- chat windows ----------------------------------------------------------------------------

TALK = "conv_id long, turn long, role string, text string, block string, kind int, at string, tokens string, n_turns int"
PIECES = ["hello there ", "<turn user>\n", "</turn>\n", "<\\turn", "<\\\\/turn", "\\", "<", "été 😀 ", "\r\n", "### Assistant: ", "<|endoftext|>", "a" * 50]


def talks(seed: int = 2) -> list[tuple]:
    rng = random.Random(seed)
    say = lambda k: "".join(rng.choices(PIECES, k=k))
    rows = []
    for conv in range(30):
        for turn in range(rng.choice([1, 2, 5, 9])):
            rows.append((conv, turn, "system" if turn == 0 and conv % 3 == 0 else rng.choice(["user", "assistant"]), rng.choice([None, "", say(3), say(40)])))
    rows += [(50, t, "assistant" if t % 2 else "user", say(rng.choice([1, 10, 30]))) for t in range(600)]
    rows += [(51, t, "system" if t == 0 else "assistant", say(20_000 if t in (0, 7) else 5)) for t in range(40)]
    rows += [(None, t % 3, "assistant", say(3)) for t in range(9)] + [(52, None, "user", "first"), (52, 1, None, "no role"), (52, 1, "a>b\n", "odd role")]
    rows += [(53, 4, "assistant", "same")] * 3 + [(54, 0, "assistant", "z" * 30_000)]
    rng.shuffle(rows)
    return [(*r, "b", 1, "c", "d", 2) for r in rows]


def expected(rows):
    by = defaultdict(list)
    for conv, turn, role, text, *_ in rows:
        by[conv].append(((turn is not None, turn or 0), role or "", text or ""))
    out = {}
    for conv, turns in by.items():
        turns.sort(key=lambda t: (t[0], t[1].encode(), t[2].encode()))
        said = "".join(t for _, role, t in turns if role == "assistant")
        whole = "".join(f"{role}\n{text}\n" for _, role, text in turns)
        out[conv] = (len(turns), hashlib.sha256(whole.encode()).hexdigest(), len(said), hashlib.sha256(said.encode()).hexdigest())
    return out


def digests(rows):
    return {r["conv_id"]: (r["n_turns"], r["turns_sha256"], r["loss_chars"], r["loss_sha256"]) for r in rows}


def test_chat_query_reads_back_every_conversation(spark, tmp_path):
    rows = talks()
    spark.createDataFrame(rows, TALK).write.parquet(f"{tmp_path}/conversations.parquet")
    out = QUERIES["op13_chat_windows"](spark, str(tmp_path)).collect()
    probe = [(-7, 0, "user", chat.PROBE), (-7, 1, "assistant", chat.PROBE)]
    wanted = expected([*rows, *probe])
    assert len(out) == len(wanted) and digests(out) == wanted


@pytest.mark.parametrize("window,history,block_windows", [(400, 100, 2), (64, 0, 1), (2048, 512, 16)])
def test_windows_hold_their_budget(spark, window, history, block_windows):
    rows = talks(7)
    given = spark.createDataFrame(rows, TALK).select("conv_id", "turn", F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"))
    short, long = chat.windows(given, window, history, block_windows)
    assert digests(chat.read_back(short, in_order=True).unionByName(chat.read_back(long)).collect()) == expected(rows)
    found = defaultdict(list)
    for row in short.unionByName(long).collect():
        found[row.conv_id].append(row)
    cut = 0
    for rows_of in found.values():
        rows_of.sort(key=lambda r: (r.block, r.window))
        cut += rows_of[-1].block > 0
        before = []  # every turn up to here
        for row in rows_of:
            turns = list(chat.parse(row.text))
            lead, new = turns[: row.repeated], turns[row.repeated :]
            assert new and (row.tokens <= window or len(new) == 1)
            if row.tokens > window:
                assert not lead or lead == before[:1] and before[0][0] == "system"
            if lead and lead[0] == before[0] and lead[0][0] == "system" and lead != before[-len(lead) :]:
                lead = lead[1:]
            assert lead == before[len(before) - len(lead) :]
            before += new
    assert cut or block_windows == 16


def test_one_way_of_cutting_whatever_the_path(spark):
    """A long conversation through blocks has the windows that one pass over it gives."""
    rows = [r for r in talks(3) if r[0] == 50]
    given = spark.createDataFrame(rows, TALK).select("conv_id", "turn", "role", F.coalesce("text", F.lit("")).alias("text"))
    _, long = chat.windows(given, 300, 80, 400)  # it may have more tokens than a block, but has not
    one, _ = chat.windows(given, 300, 80, 1_000_000)
    key = lambda r: (r.block, r.window)
    through_blocks, at_once = (sorted(df.collect(), key=key) for df in (long, one))
    assert len(at_once) > 100 and through_blocks == at_once


@given(st.text(st.sampled_from("<\\/turn >\n é"), max_size=40), st.text(max_size=8))
def test_escape_round_trip(text, role):
    head, body = chat.render(role, text)
    assert chat.unescape(body) == text and chat.OPEN not in body and "</turn" not in body
    assert list(chat.parse((head + body + chat.CLOSE) * 2)) == [(role, text)] * 2
