import contextlib
import io
import random
import re

import pytest

from tests.brute_sentiment import score
from wardloom.functions.rules import Rules
from wardloom.operators.sentiment import read_lexicon, score_texts

LEXICON = {"good": 1.9, "bad": -2.5, "happy": 2.7, "great": 3.1, "sad": -2.1, "death": -2.9, "kind": 2.4, "no": -1.2, ":)": 2.0, "very": 0.5, "bomb": -2.2}

FIXED = [
    (None),
    "",
    "  \n ",
    "a b c",
    "nothing known here",
    "This is a good movie",
    "This is a very good movie!!",
    "This is not a good movie.",
    "It was never so good, I isn't sad",
    "The VERY GOOD day and the bad night",
    "good but bad",
    "GREAT, but the end was sad?? really???",
    "it is the least good of all; at least good, very least good",
    "least good",
    "this kind of good thing was the bomb indeed good",
    "x kiss of death and hand to mouth good",
    "my friends sort of happy people kind of sad folks",
    'good good "good" good! !good ?!?good good?! (good)',
    "don't be sad, without doubt happy",
    "so very extremely happy great　day\x1cgood",
    "straße GUT good ÉTÉ été bad",
    "no good :) at all",
]


@pytest.fixture(scope="module")
def lexicon(spark):
    return spark.createDataFrame(list(LEXICON.items()), "token string, valence double")


def check(spark, lexicon, texts, rules=Rules()):
    df = spark.createDataFrame(list(enumerate(texts)), "id int, text string")
    got = {r.id: (r.neg, r.neu, r.pos, r.compound) for r in score_texts(df, "id", "text", lexicon, rules).collect()}
    assert len(got) == len(texts)
    for i, text in enumerate(texts):
        assert got[i] == pytest.approx(score(text, LEXICON, rules), abs=1e-12), text


def test_chosen_texts(spark, lexicon):
    check(spark, lexicon, FIXED)


def test_generated_texts(spark, lexicon):
    rng = random.Random(11)
    rules = Rules()
    vocabulary = [
        *LEXICON, *LEXICON, "but", "never", "so", "this", "least", "at", "of", "the", "kind", "sort", "just", "enough", "don't",
        "extremely", "slightly", "not", "word", "movie", "bomb", "hand", "to", "mouth", "yeah", "right", "x",
    ]
    shapes = [str, str, str, str.upper, str.title, lambda w: w + ",", lambda w: w + "!!", lambda w: "?" + w, lambda w: f"({w})"]
    texts = [
        " ".join(rng.choice(shapes)(rng.choice(vocabulary)) for _ in range(rng.choice([1, 2, 3, 4, 6, 12, 40, 63, 64, 65, 66, 130, 200])))
        for _ in range(400)
    ]
    check(spark, lexicon, texts, rules)


def test_long_text(spark, lexicon):
    check(spark, lexicon, ["word not good " * 20_000, "bad " + "word " * 30_000 + "very happy"])


def test_lexicon_beyond_the_broadcast_bound_gives_the_same(spark, lexicon, monkeypatch):
    import wardloom.operators.sentiment as module

    monkeypatch.setattr(module, "broadcast_if_small", lambda df, **_: df.hint("merge"))
    check(spark, lexicon, FIXED)


def test_repeated_tokens_are_refused(spark, lexicon):
    df = spark.createDataFrame([(1, "good")], "id int, text string")
    with pytest.raises(ValueError, match="repeats"):
        score_texts(df, "id", "text", lexicon.union(lexicon))


def test_read_lexicon(spark, tmp_path):
    (tmp_path / "lexicon.txt").write_text("good\t1.9\t0.9\t[2, 1]\n:)\t2.0\t1.1\t[1]\ngood\t1.8\t0.9\t[2]\n\n")
    assert {r.token: r.valence for r in read_lexicon(spark, str(tmp_path / "lexicon.txt")).collect()} == {"good": 1.8, ":)": 2.0}


@pytest.mark.parametrize("ids", [(1, 1), (None, 2), (None, None)])
def test_repeated_and_null_ids_are_refused(spark, lexicon, ids):
    df = spark.createDataFrame(list(zip(ids, ("good", "bad"), strict=True)), "id int, text string")
    with pytest.raises(Exception, match="repeated or NULL id"):
        score_texts(df, "id", "text", lexicon).collect()
    empty = spark.createDataFrame(list(zip(ids, (None, ""), strict=True)), "id int, text string")
    with pytest.raises(Exception, match="repeated or NULL id"):
        score_texts(empty, "id", "text", lexicon).collect()


def test_no_token_row_carries_an_array(spark, lexicon):
    df = spark.createDataFrame([(1, "good day")], "id int, text string")
    plan = score_texts(df, "id", "text", lexicon)._jdf.queryExecution().executedPlan().toString()
    tokens = [line for line in plan.splitlines() if "Generate inline" in line]
    carried = [line.split("), [")[-1].split("]")[0] for line in tokens]
    assert tokens and all("_id#" in c and "_words" not in c and " w#" not in c for c in carried)


def test_hits_are_combined_without_sorting_them(spark, lexicon):
    df = spark.createDataFrame([(1, "good day")], "id int, text string")
    plan = score_texts(df, "id", "text", lexicon)._jdf.queryExecution().executedPlan().toString()
    assert "HashAggregate" in plan and "SortAggregate" not in plan


def test_generated_methods_are_small_enough_to_be_compiled(spark, lexicon):
    """The JVM leaves methods of more than 8,000 bytes to its interpreter."""
    df = spark.createDataFrame([(1, "good day")], "id int, text string").repartition("id")
    out = io.StringIO()
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        with contextlib.redirect_stdout(out):
            score_texts(df, "id", "text", lexicon).explain("codegen")
    finally:
        spark.conf.unset("spark.sql.adaptive.enabled")
    sizes = [int(size) for size in re.findall(r"maxMethodCodeSize:(\d+)", out.getvalue())]
    assert sizes and max(sizes) <= 8000
