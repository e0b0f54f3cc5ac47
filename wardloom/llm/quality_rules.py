"""Quality rules: a decision list learned by sequential covering and applied as one conditional expression.

Features are computed per text with built-in functions. Labelled documents are summed into
histograms (feature, bin, label) by Spark; from these a rule grows one threshold condition at a
time, is pruned on held-back documents, and the documents it covers leave before the next rule
grows. The list is a ``CASE WHEN`` that any plan can carry.

Defined results: NULL and empty texts have no words and fail the base rules; labels that are NULL
do not count; without labels of both kinds the list is empty and the base rules alone decide;
repeated documents get equal rows; other columns of the input pass through untouched.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from wardloom.llm.common import SPACE, table, words
from wardloom.session import broadcast_if_small, materialize

STATS = "_quality_stats"
MIN_WORDS = 50
FEW_REPEATS = 16  # up to this many distinct repeated windows are looked up one by one; more are sorted


@dataclass(frozen=True)
class Condition:
    feature: str
    above: bool
    threshold: float

    def column(self) -> Column:
        value = F.col(f"{STATS}.{self.feature}")
        return value > self.threshold if self.above else value <= self.threshold

    def __str__(self) -> str:
        return f"{self.feature} {'>' if self.above else '<='} {self.threshold:g}"


@dataclass(frozen=True)
class Rule:
    """Reject where all conditions hold."""

    conditions: tuple[Condition, ...]

    def column(self) -> Column:
        out = F.lit(True)
        for condition in self.conditions:
            out = out & condition.column()
        return out


def _share(part: Column, whole: Column) -> Column:
    return F.when(whole > 0, part / whole).otherwise(F.lit(0.0))


def _chars_left(text: Column, pattern: str) -> Column:
    return F.length(F.regexp_replace(text, pattern, "")).cast("long")


def _places_looked_up(windows: str, repeated: str) -> Column:
    """Positions of windows that are among the repeated ones, for few of these."""
    places = F.transform(windows, lambda h, i: F.when(F.array_contains(repeated, h), i))
    return F.filter(places, lambda i: i.isNotNull())


def _places_sorted(placed: str) -> Column:
    """The same for many: windows sorted with their positions, so a long repetitive text stays n log n."""
    twice = F.filter(
        F.transform(
            placed,
            lambda x, k: F.struct(
                x["i"].alias("i"),
                (F.coalesce(F.get(placed, k - 1)["h"] == x["h"], F.lit(False)) | F.coalesce(F.get(placed, k + 1)["h"] == x["h"], F.lit(False))).alias("twice"),
            ),
        ),
        lambda x: x["twice"],
    )
    return F.sort_array(F.transform(twice, lambda x: x["i"]))


def with_stats(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` with the struct column of per-text statistics that rules refer to."""
    whole = F.coalesce(F.col(text), F.lit(""))
    keep = [F.col(f"`{c}`") for c in docs.columns]
    step = docs.select(*keep, words(whole).alias("_q_words"), F.split(whole, "\n", -1).alias("_q_lines"), whole.alias("_q_text"))
    step = step.select(
        *keep,
        "_q_text",
        F.transform("_q_words", lambda w: F.xxhash64(w)).alias("_q_hashes"),
        F.filter("_q_lines", lambda line: F.length(F.regexp_replace(line, SPACE, "")) > 0).alias("_q_lines"),
    )
    step = step.select(
        *keep,
        "_q_text",
        "_q_lines",
        F.size("_q_hashes").alias("_q_n"),
        F.transform(
            F.slice("_q_hashes", F.lit(1), F.greatest(F.size("_q_hashes") - 2, F.lit(0))),
            lambda h, i: F.xxhash64(h, F.get("_q_hashes", i + 1), F.get("_q_hashes", i + 2)),
        ).alias("_q_windows"),
    )
    step = step.select("*", F.sort_array("_q_windows").alias("_q_sorted"))
    step = step.select(
        "*", F.array_distinct(F.filter("_q_sorted", lambda h, k: F.coalesce(F.get("_q_sorted", k - 1) == h, F.lit(False)))).alias("_q_repeated")
    )
    many = F.size("_q_repeated") > FEW_REPEATS
    # A column of its own, since a lambda would compute it anew for every element.
    step = step.select(
        "*", F.when(many, F.sort_array(F.transform("_q_windows", lambda h, i: F.struct(h.alias("h"), i.alias("i"))))).alias("_q_placed")
    )
    at = F.when(F.size("_q_repeated") == 0, F.array().cast("array<int>")).when(many, _places_sorted("_q_placed")).otherwise(_places_looked_up("_q_windows", "_q_repeated"))
    step = step.select(*keep, "_q_text", "_q_lines", "_q_n", at.alias("_q_at"))
    covered = F.aggregate(
        F.transform("_q_at", lambda p, k: F.least(F.lit(3), F.coalesce(F.get("_q_at", k + 1) - p, F.lit(3)))), F.lit(0), lambda a, b: a + b
    )
    step = step.select(
        *keep,
        F.col("_q_n").cast("long").alias("_q_n"),
        F.size("_q_lines").cast("long").alias("_q_n_lines"),
        F.length("_q_text").cast("long").alias("_q_chars"),
        _chars_left(F.col("_q_text"), SPACE).alias("_q_word_chars"),
        _chars_left(F.col("_q_text"), r"[#*$%&|<>]+").alias("_q_no_symbols"),
        (F.size("_q_lines") - F.size(F.array_distinct("_q_lines"))).cast("long").alias("_q_dup_lines"),
        covered.cast("long").alias("_q_repeat_words"),
        _chars_left(F.col("_q_text"), r"\p{Lu}+").alias("_q_no_upper"),
        _chars_left(F.col("_q_text"), r"\p{Ll}+").alias("_q_no_lower"),
        _chars_left(F.col("_q_text"), r"[0-9]+").alias("_q_no_digits"),
        _chars_left(F.col("_q_text"), r"[!?]+").alias("_q_no_marks"),
    )
    n, chars, solid = F.col("_q_n"), F.col("_q_chars"), F.col("_q_word_chars")
    stats = {
        # Reads as not deterministic, so no filter on the statistics is pushed below them and
        # spelled out again inside every lambda.
        "n_words": F.when(F.spark_partition_id() >= 0, n),
        "word_chars": solid,
        "n_symbols": chars - F.col("_q_no_symbols"),
        "n_dup_lines": F.col("_q_dup_lines"),
        "n_repeat_words": F.col("_q_repeat_words"),
        "mean_word_chars": _share(solid, n),
        "symbol_share": _share(chars - F.col("_q_no_symbols"), solid),
        "dup_line_share": _share(F.col("_q_dup_lines"), F.col("_q_n_lines")),
        "repeat_share": _share(F.col("_q_repeat_words"), n),
        "upper_share": _share(chars - F.col("_q_no_upper"), solid),
        "lower_share": _share(chars - F.col("_q_no_lower"), solid),
        "digit_share": _share(chars - F.col("_q_no_digits"), solid),
        "mark_share": _share(chars - F.col("_q_no_marks"), solid),
        "line_words": _share(n, F.col("_q_n_lines")),
    }
    return step.select(*keep, F.struct(*[v.alias(k) for k, v in stats.items()]).alias(STATS))


#: What rules may test. Plain sizes stay out, so that a text is not judged by its length alone.
FEATURES = ("mean_word_chars", "symbol_share", "dup_line_share", "repeat_share", "upper_share", "lower_share", "digit_share", "mark_share", "line_words")


def base_failed() -> Column:
    n = F.col(f"{STATS}.n_words")
    return (n < MIN_WORDS) | (100 * F.col(f"{STATS}.n_repeat_words") > 50 * n)


def _cuts_below(value: Column, cuts: Sequence[float]) -> Column:
    return F.size(F.filter(F.array(*map(F.lit, cuts)), lambda cut: value > cut))


@dataclass(frozen=True)
class Learner:
    """Sequential covering. Every labelled document counts; only sums reach the driver."""

    features: Sequence[str] = FEATURES
    n_bins: int = 32
    max_rules: int = 8
    max_conditions: int = 3
    min_cover: int = 5
    min_precision: float = 0.9
    prune_part: int = 3  # one document in this many is held back for pruning

    def learn(self, labelled: DataFrame, reject: Column) -> list[Rule]:
        """Rules from ``labelled`` (with stats); ``reject`` is true where the label asks for rejection."""
        value = {f: F.col(f"{STATS}.{f}").cast("double") for f in self.features}
        train = materialize(
            labelled.filter(reject.isNotNull()).select(
                reject.cast("int").alias("bad"),
                (F.pmod(F.xxhash64(*value.values()), F.lit(self.prune_part)) == 0).alias("held"),
                F.struct(*[value[f].alias(f) for f in self.features]).alias(STATS),
            ),
            "quality-train",
        )
        grow_bad, grow_all, held_bad = train.agg(F.sum(F.when(~F.col("held"), F.col("bad"))), F.sum((~F.col("held")).cast("int")), F.sum(F.when(F.col("held"), F.col("bad")))).first()
        if not grow_bad or not held_bad or grow_bad == grow_all:
            return []
        steps = [i / self.n_bins for i in range(1, self.n_bins)]
        # Quantiles of the rejected documents are wanted too: they are few, and their values lie apart.
        cuts_of = lambda only: train.agg(*[F.percentile_approx(F.when(only, F.col(f"{STATS}.{f}")), steps, 10_000).alias(f) for f in self.features]).first()
        every, bad = cuts_of(F.lit(True)), cuts_of(F.col("bad") == 1)
        cuts = {f: sorted({float(x) for x in every[f]} | {float(x) for x in bad[f]}) for f in self.features}
        binned = materialize(
            train.select(
                "*",
                F.array(*[_cuts_below(F.col(f"{STATS}.{f}"), cuts[f]) for f in self.features]).alias("bins"),
            ),
            "quality-bins",
        )
        rules: list[Rule] = []
        left = binned
        for _ in range(self.max_rules):
            rule = self._prune(left, self._grow(left, cuts))
            if rule is None:
                break
            rules.append(rule)
            left = left.filter(~rule.column())
        return rules

    def _grow(self, rows: DataFrame, cuts: dict[str, list[float]]) -> list[Condition]:
        rows, chosen = rows.filter(~F.col("held")), []
        while len(chosen) < self.max_conditions:
            histogram: dict[int, dict[int, tuple[int, int]]] = {}
            sums = rows.select("bad", F.posexplode("bins").alias("f", "bin")).groupBy("f", "bin").agg(F.sum("bad").alias("bad"), F.count("bad").alias("n"))
            for r in sums.collect():  # at most features x bins rows
                histogram.setdefault(r["f"], {})[r["bin"]] = (r["bad"], r["n"] - r["bad"])
            best = self._best(histogram, cuts)
            if best is None:
                return chosen
            chosen.append(best[0])
            rows = rows.filter(best[0].column())
            if best[1] == 0:
                return chosen
        return chosen

    def _best(self, histogram: dict, cuts: dict[str, list[float]]) -> tuple[Condition, int] | None:
        """The condition of largest information gain, with the good documents it still covers."""
        best, best_gain = None, 1e-9
        for f, bins in sorted(histogram.items()):
            bad, good = (sum(x[i] for x in bins.values()) for i in (0, 1))
            if not bad or not good:
                return None
            base, below_bad, below_good = math.log2(bad / (bad + good)), 0, 0
            name = self.features[f]
            for k, cut in enumerate(cuts[name]):  # bin k holds values above cut k-1 and not above cut k
                b, g = bins.get(k, (0, 0))
                below_bad, below_good = below_bad + b, below_good + g
                for above, p, n in ((False, below_bad, below_good), (True, bad - below_bad, good - below_good)):
                    if p >= self.min_cover and (gain := p * (math.log2(p / (p + n)) - base)) > best_gain:
                        best, best_gain = (Condition(name, above, cut), n), gain
        return best

    def _prune(self, rows: DataFrame, grown: list[Condition]) -> Rule | None:
        """The prefix of the grown conditions that does best on held-back documents, if it is sure enough."""
        if not grown:
            return None
        sums, reached = [], F.lit(True)
        for i, condition in enumerate(grown):
            reached = reached & condition.column()
            sums += [F.sum((reached & (F.col("bad") == y)).cast("int")).alias(f"{name}{i}") for y, name in ((1, "p"), (0, "n"))]
        row = rows.filter("held").agg(*sums).first()
        counts = [(row[f"p{i}"] or 0, row[f"n{i}"] or 0) for i in range(len(grown))]
        value = lambda i: (counts[i][0] - counts[i][1]) / max(1, sum(counts[i]))
        best = max(range(len(grown)), key=lambda i: (value(i), -i))
        p, n = counts[best]
        return Rule(tuple(grown[: best + 1])) if p >= 1 and p >= self.min_precision * (p + n) else None


def verdict(rules: Sequence[Rule]) -> Column:
    """True where no rule rejects: the ordered list as one conditional expression."""
    out = None
    for rule in rules:
        out = F.when(rule.column(), F.lit(False)) if out is None else out.when(rule.column(), F.lit(False))
    return F.lit(True) if out is None else out.otherwise(F.lit(True))


def kept(rules: Sequence[Rule]) -> Column:
    return ~base_failed() & verdict(rules)


def learn_from_labels(docs: DataFrame, labels: DataFrame, learner: Learner = Learner()) -> list[Rule]:
    """Rules from ``labels (doc_id, quality)``: quality 0 asks for rejection. Base failures teach nothing new and stay out."""
    known = labels.filter("quality is not null and doc_id is not null").select(F.col("doc_id").alias("_q_id"), (F.col("quality") == 0).alias("_q_reject"))
    texts = docs.select(F.col("doc_id").alias("_q_id"), F.col("text").alias("text"))
    joined = with_stats(texts.join(broadcast_if_small(known), "_q_id"))
    return learner.learn(joined.filter(~base_failed()), F.col("_q_reject"))


def quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Contract query: statistics and verdict of every document."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    rules = learn_from_labels(docs, table(spark, sf_dir, "labels"))
    stats = [F.col(f"{STATS}.{c}") for c in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")]
    return with_stats(docs).select("doc_id", *stats, base_failed().alias("base_failed"), kept(rules).alias("kept"))


def keep_good(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The documents that neither the base rules nor the learned rules reject, columns unchanged."""
    rules = learn_from_labels(docs, labels)
    return with_stats(docs).filter(kept(rules)).select(*[F.col(f"`{c}`") for c in docs.columns])
