"""Rule-based sentiment as a Spark job: tokens, a lexicon join, and sums per text.

The shape of the plan: cut every text into tokens; join them to the lexicon where they are (a
broadcast of measured size); drop what is not in it; look up the neighbours of each hit and compute
its valence from them with built-in expressions; then combine per text. No window and no shuffle
of tokens: only hits, already combined per word and task, are shuffled.

Valences are summed as integers (units of 1e-9), so that the sums do not depend on their order.
"""

from __future__ import annotations

import string

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from wardloom.functions import rules as fixed
from wardloom.functions.rules import Rules
from wardloom.session import broadcast_if_small

# The characters that separate words, and ASCII punctuation.
SPACES = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f\x20\x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005"
    "\u2006\u2007\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000"
)
PUNCTUATION = string.punctuation

SCALE = 1e9
CHUNK = 64  # tokens per row while looking for hits; bounds a row however long its text is
BEFORE, AFTER = 3, 2  # neighbours a rule may look at


def read_lexicon(spark: SparkSession, path: str) -> DataFrame:
    """``(token, valence)`` from the published tab-separated form: token, mean, and more columns.

    Of several lines for one token the last counts, as in a dictionary.
    """
    fields = F.split("value", "\t")
    return (
        spark.read.text(path)
        .filter(F.col("value").contains("\t"))
        .select(fields[0].alias("token"), fields[1].cast("double").alias("valence"), F.monotonically_increasing_id().alias("line"))
        .groupBy("token")
        .agg(F.max_by("valence", "line").alias("valence"))
    )


def _spaced(text: Column) -> Column:
    return F.translate(text, SPACES, " " * len(SPACES))


def _tokens(spaced: Column) -> Column:
    """Array of the tokens of a text: whitespace-separated, of two characters or more.

    A plain word with one mark of the edge list before or after it loses the mark. The text is
    split twice at the same spaces, once without its punctuation, so that the two arrays line up.
    """
    bare = F.regexp_replace(spaced, r"[!-/:-@\[-`{-~]+", "")
    marks = list(fixed.EDGE_PUNCTUATION)

    def strip(token: Column, word: Column) -> Column:
        after = token.startswith(word) & F.substring(token, F.length(word) + 1, F.length(token)).isin(marks)
        before = token.endswith(word) & F.left(token, F.length(token) - F.length(word)).isin(marks)
        edged = (token != word) & (F.length(word) > 1)
        return F.when(edged & (after | before), word).when(F.length(token) > 1, token)

    return F.filter(F.zip_with(F.split(spaced, " "), F.split(bare, " "), strip), lambda t: t.isNotNull())


def _is_caps(word: Column) -> Column:
    return (word == F.upper(word)) & (word != F.lower(word))


def _count_char(text: Column, char: str) -> Column:
    return F.length(text) - F.length(F.replace(text, F.lit(char), F.lit("")))


TEXT_FACTS = ("_n", "_exclamations", "_questions")


def _chunked(texts: DataFrame, id_col: str, text_col: str, rules: Rules) -> DataFrame:
    """Rows of up to CHUNK tokens plus their neighbours, with the facts of their text.

    A text without tokens, or NULL, keeps one row.
    """
    words = F.col("_words")
    # Most texts do not hold the contrast word at all; only then are their tokens looked through for it.
    contrasted = F.contains(F.lower("_spaced"), F.lit(rules.contrast)) if rules.contrast.isascii() else F.lit(True)
    # One projection per step: each value is computed once per text, before its tokens fan out.
    facts = (
        texts.select(
            F.col(id_col).alias("_id"),
            _spaced(F.col(text_col)).alias("_spaced"),
            _count_char(F.col(text_col), "!").alias("_exclamations"),
            _count_char(F.col(text_col), "?").alias("_questions"),
        )
        .select("_id", _tokens(F.col("_spaced")).alias("_words"), "_exclamations", "_questions", contrasted.alias("_contrasted"))
        .select(
            "_id", "_words", "_exclamations", "_questions",
            F.array_size(words).alias("_n"),
            (F.exists(words, _is_caps) & F.exists(words, lambda w: ~_is_caps(w))).alias("_mixed_caps"),
            F.when(F.col("_contrasted"), F.array_position(F.transform(words, F.lower), rules.contrast)).otherwise(0).alias("_contrast"),
        )
    )
    starts = F.when(F.col("_n") > 0, F.sequence(F.lit(0), F.col("_n") - 1, F.lit(CHUNK)))
    first = F.greatest(F.col("_start") - BEFORE, F.lit(0))
    return (
        facts.select("*", F.explode_outer(starts).alias("_start"))
        .withColumn("_first", first)
        .withColumn("_words", F.slice(words, F.col("_first") + 1, F.lit(BEFORE + CHUNK + AFTER)))
    )


def _hits(texts: DataFrame, id_col: str, text_col: str, lexicon: DataFrame, rules: Rules) -> DataFrame:
    """One row per token that is in the lexicon (and for the first token of every text).

    A token is exploded with its neighbours, ``b1 b2 b3`` before and ``a1 a2`` after the token ``w``,
    so that no row of the join carries an array of words.
    """
    # The words shifted by each distance, side by side; where a neighbour is missing, there is none.
    length = F.least(F.lit(CHUNK), F.col("_n") - F.col("_start"))
    at = F.sequence(F.col("_start"), F.col("_start") + length - 1)
    missing = F.lit(BEFORE) - (F.col("_start") - F.col("_first"))
    padded = _chunked(texts, id_col, text_col, rules).select(
        "_id", *TEXT_FACTS, "_mixed_caps", "_contrast", at.alias("_at"), length.alias("_length"),
        F.concat(F.array_repeat(F.lit(None).cast("string"), missing), "_words").alias("_words"),
    )

    def shifted(by: int) -> Column:
        return F.slice("_words", BEFORE + 1 + by, F.col("_length"))

    sides = [(f"b{i}", -i) for i in range(1, BEFORE + 1)] + [(f"a{i}", i) for i in range(1, AFTER + 1)]
    near = [shifted(by).alias(name) for name, by in sides]
    lists = padded.select("_id", *TEXT_FACTS, "_mixed_caps", "_contrast", F.col("_at").alias("at"), shifted(0).alias("w"), *near)
    names = ["at", "w", *(name for name, _ in sides)]
    tokens = lists.select("_id", *TEXT_FACTS, "_mixed_caps", "_contrast", F.inline_outer(F.arrays_zip(*names)))
    found = tokens.join(lexicon, F.lower("w") == F.col("token"), "left")
    return found.filter(F.col("valence").isNotNull() | F.coalesce(F.col("at") == 0, F.lit(True))).drop("token")


def _one_of(expression: str, choices) -> Column:
    """``expression IN (choices)`` as one parsed expression; false for NULL."""
    if not choices:
        return F.lit(False)
    quoted = ", ".join("'" + c.replace("\\", "\\\\").replace("'", "\\'") + "'" for c in choices)
    return F.expr(f"coalesce({expression} in ({quoted}), false)")


def _away_from_zero(valence: Column) -> Column:
    return F.when(valence > 0, F.lit(fixed.BOOST_CAPS)).otherwise(F.lit(-fixed.BOOST_CAPS))


def _idioms(rules: Rules) -> Column:
    return F.create_map(*[F.lit(part) for words, value in rules.idioms for part in (words, float(value))])


def _apart(rows: DataFrame) -> DataFrame:
    """``rows`` as they are; the steps after this become a method of their own in the generated code.

    The JVM never compiles a method of more than 8,000 bytes, however often it runs, and steps that follow one another
    for each token or hit are generated as one.
    """
    return rows.select("*", F.explode(F.array(F.lit(0)))).select(*rows.columns)


def _valued(hits: DataFrame, lexicon: DataFrame, rules: Rules) -> DataFrame:
    """Append ``_s``, the valence of each hit after all rules about its neighbours."""
    hits = _apart(hits)
    for i in range(1, BEFORE + 1):
        known = lexicon.select(F.col("token").alias("_token"))  # the same three times: broadcast once
        hits = hits.join(known, F.lower(f"b{i}") == F.col("_token"), "left").withColumnRenamed("_token", f"_known{i}")

    def judged_as(i: int) -> dict[str, Column]:
        """What a preceding word does; one that is in the lexicon itself does nothing."""
        word, lower = F.col(f"b{i}"), F.lower(f"b{i}")
        acts = word.isNotNull() & F.col(f"_known{i}").isNull()
        step = F.when(lower.isin(list(rules.intensifiers)), F.lit(fixed.BOOST_UP)).when(
            lower.isin(list(rules.dampeners)), F.lit(fixed.BOOST_DOWN)
        )
        negates = lower.isin(list(rules.negations)) | lower.contains(rules.negation_part)
        return {
            f"_acts{i}": acts,
            f"_boost{i}": F.when(acts, step),
            f"_loud{i}": _is_caps(word) & F.col("_mixed_caps"),
            f"_negates{i}": F.coalesce(negates, F.lit(False)),
        }

    judged = _apart(hits.withColumns({name: value for i in range(1, BEFORE + 1) for name, value in judged_as(i).items()}))

    def near(i: int, field: str) -> Column:
        return F.col(f"_{field}{i}")

    def negation(i: int) -> Column:
        return F.when(near(i, "negates"), F.lit(fixed.NEGATION_SCALE)).otherwise(1.0)

    def follower(i: int) -> Column:
        return _one_of(f"b{i}", rules.never_followers)

    scales = (
        negation(1),
        F.when((F.col("b2") == rules.never) & follower(1), F.lit(fixed.NEVER_SCALE_NEAR)).otherwise(negation(2)),
        F.when(((F.col("b3") == rules.never) & follower(2)) | follower(1), F.lit(fixed.NEVER_SCALE_FAR)).otherwise(negation(3)),
    )
    steps = {f"_scale{i}": F.when(near(i, "acts"), scale).otherwise(1.0) for i, scale in enumerate(scales, start=1)}

    # The last phrase that looks on wins, then the first one that looks back.
    phrases = ("w a1 a2", "w a1", "b1 w", "b2 b1 w", "b2 b1", "b3 b2 b1", "b3 b2")
    found = [F.try_element_at(_idioms(rules), F.expr("concat(" + ", ' ', ".join(p.split()) + ")")) for p in phrases]
    idiom = F.when(near(3, "acts"), F.coalesce(*found)) if rules.idioms else F.lit(None).cast("double")
    pair = _one_of("concat(b3, ' ', b2)", rules.dampening_pairs) | _one_of("concat(b2, ' ', b1)", rules.dampening_pairs)
    least = near(1, "acts") & (F.lower("b1") == rules.least) & ~_one_of("lower(b2)", rules.least_exceptions)

    valence, loud = F.col("valence"), _is_caps(F.col("w")) & F.col("_mixed_caps")
    kind_of = (F.lower("w") == rules.kind_of[0]) & F.coalesce(F.lower("a1") == rules.kind_of[1], F.lit(False))
    modifier = _one_of("lower(w)", (*rules.intensifiers, *rules.dampeners)) | kind_of
    kept = ("_id", *TEXT_FACTS, "w", "at", "_half", "_row")
    ruled = judged.select(
        *kept,
        # NULL for a word that is not in the lexicon, or that only modifies others.
        F.when(~modifier, valence + F.when(loud, _away_from_zero(valence)).otherwise(0.0)).alias("_v"),
        *[near(i, field) for i in range(1, BEFORE + 1) for field in ("boost", "loud")],
        *[scale.alias(name) for name, scale in steps.items()],
        idiom.alias("_idiom"),
        F.when(near(3, "acts") & pair, F.lit(fixed.BOOST_DOWN)).otherwise(0.0).alias("_pair"),
        F.when(least, F.lit(fixed.NEGATION_SCALE)).otherwise(1.0).alias("_least"),
    )

    # A booster pushes the valence away from zero or towards it, then a negation scales it; nearest word first.
    stepped = _apart(ruled)
    for i, damping in enumerate(fixed.DISTANCE_DAMPING, start=1):
        v, boost = F.col("_v"), near(i, "boost")
        signed = F.when(v < 0, -boost).otherwise(boost) + F.when(near(i, "loud"), _away_from_zero(v)).otherwise(0.0)
        stepped = stepped.withColumn("_v", (v + F.coalesce(signed * damping, F.lit(0.0))) * F.col(f"_scale{i}"))

    final = (F.coalesce("_idiom", "_v") + F.col("_pair")) * F.col("_least")
    value = F.when(F.col("_v").isNull(), F.lit(0.0)).otherwise(final)
    return stepped.select(*kept, F.floor(value * SCALE + 0.5).cast("long").alias("_s"))


def score_texts(texts: DataFrame, id_col: str, text_col: str, lexicon: DataFrame, rules: Rules = Rules()) -> DataFrame:
    """``(id_col, neg, neu, pos, compound)`` for every row of ``texts``.

    ``id_col`` must be unique and not NULL: a repeated or missing id fails the job, since its texts
    could not be told apart. A text without tokens scores 0 throughout; a NULL text scores NULL. ``lexicon`` is
    ``(token, valence)`` with lower-case, unique tokens.
    """
    lexicon = broadcast_if_small(lexicon.select("token", "valence"), unique="token")
    hits = _hits(texts, id_col, text_col, lexicon, rules)

    # Weight of each occurrence in halves: 1 before the contrast word, 3 after it, 2 otherwise.
    here = F.col("at") + 1
    halves = (
        F.when((F.col("_contrast") > 0) & (here < F.col("_contrast")), int(2 * fixed.BEFORE_CONTRAST))
        .when((F.col("_contrast") > 0) & (here > F.col("_contrast")), int(2 * fixed.AFTER_CONTRAST))
        .otherwise(2)
    )
    # Every text has one row for its first token, or one without a token: more are another text.
    row = F.when(F.coalesce(F.col("at") == 0, F.lit(True)), 1).otherwise(0)
    valued = _valued(hits.withColumns({"_half": halves, "_row": row}), lexicon, rules)
    # A word that occurs again counts with the valence of its first occurrence. Hits are valued before that one is
    # looked for, since numbers are combined in a hash map, and neighbours only by sorting all hits.
    per_word = valued.groupBy("_id", "w").agg(
        F.coalesce(F.min_by("_s", "at"), F.lit(0)).alias("_s"),
        F.count(F.lit(1)).alias("_times"),
        F.sum("_half").alias("_halves"),
        F.sum("_row").alias("_rows"),
        *[F.max(c).alias(c) for c in TEXT_FACTS],
    )
    unit = 2 * int(SCALE)  # everything below is in halves of the scaled unit
    one, weighted = F.col("_times") * unit, F.col("_s") * F.col("_halves")
    per_text = per_word.groupBy("_id").agg(
        F.sum(weighted).alias("_sum"),
        F.sum(F.when(F.col("_s") > 0, weighted + one).otherwise(0)).alias("_pos"),
        F.sum(F.when(F.col("_s") < 0, weighted - one).otherwise(0)).alias("_neg"),
        F.sum(F.when(F.col("_s") != 0, F.col("_times")).otherwise(0)).alias("_moved"),
        F.sum("_rows").alias("_rows"),
        *[F.max(c).alias(c) for c in TEXT_FACTS],
    )
    unclear = F.col("_id").isNull() | (F.col("_rows") > 1)
    told_apart = F.when(unclear, F.raise_error(F.concat(F.lit("repeated or NULL id of a text: "), F.coalesce(F.col("_id").cast("string"), F.lit("NULL"))))).otherwise(F.col("_n"))
    return _components(per_text.withColumn("_n", told_apart.cast(per_text.schema["_n"].dataType)), unit).withColumnRenamed("_id", id_col)


def _rounded(value: Column, digits: int) -> Column:
    return F.rint(value * 10**digits) / 10**digits


def _components(sums: DataFrame, unit: int) -> DataFrame:
    questions = F.col("_questions")
    emphasis = F.least(F.col("_exclamations"), F.lit(fixed.EXCLAMATION_MAX)) * fixed.EXCLAMATION_STEP + (
        F.when(questions <= 1, F.lit(0.0)).when(questions <= 3, questions * fixed.QUESTION_STEP).otherwise(fixed.QUESTION_MAX)
    )
    base = sums.select(
        "_id",
        "_n",
        emphasis.alias("_emphasis"),
        (F.col("_sum") / F.lit(float(unit))).alias("_sum"),
        (F.col("_pos") / F.lit(float(unit))).alias("_pos"),
        (-F.col("_neg") / F.lit(float(unit))).alias("_neg"),
        (F.col("_n") - F.col("_moved")).cast("double").alias("_neutral"),
    )
    emphasised = base.select(
        "_id",
        "_n",
        "_neutral",
        (F.col("_sum") + F.signum("_sum") * F.col("_emphasis")).alias("_sum"),
        (F.col("_pos") + F.when(F.col("_pos") > F.col("_neg"), F.col("_emphasis")).otherwise(0.0)).alias("_pos"),
        (F.col("_neg") + F.when(F.col("_pos") < F.col("_neg"), F.col("_emphasis")).otherwise(0.0)).alias("_neg"),
    )
    total = F.col("_pos") + F.col("_neg") + F.col("_neutral")

    def share(part: str) -> Column:
        return F.when(F.col("_n") == 0, F.lit(0.0)).when(F.col("_n") > 0, _rounded(F.col(part) / total, 3))

    total_sum = F.col("_sum")
    compound = _rounded(total_sum / F.sqrt(total_sum * total_sum + fixed.NORMALIZATION), 4)
    return emphasised.select(
        "_id",
        share("_neg").alias("neg"),
        share("_neutral").alias("neu"),
        share("_pos").alias("pos"),
        F.when(F.col("_n") == 0, F.lit(0.0)).when(F.col("_n") > 0, compound).alias("compound"),
    )


def note_score() -> Column:
    """The score stored with a note: compound plus the neutral share."""
    return F.col("compound") + F.col("neu")
