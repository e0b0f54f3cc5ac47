"""Line dedup: an exact set-similarity join over the lines of a corpus, with built-in functions only.

A line is the set of its words, held as 64-bit hashes, which are written once: counts, prefixes and verification
read them and never the texts again. Lines with equal sets collapse first. For the others, a word's key is its hash
whose first bits, the word's bucket, are replaced by the rank of that bucket among all 2^16 by the lines that hold
its words: keys are as distinct as hashes, and in their order rare words come first. Only a
prefix of the rarest words is joined, one part of all words after another; length, position and a parity
bitmap of the set, wider for larger sets, rule out nearly all pairs inside the join, and the rest are verified
on their full word sets.

A line goes if an earlier line, in order of ``(doc_id, row, line number)``, has Jaccard similarity at
or above the threshold; ``row`` is a hash of the document's columns. It is enough to find one such
line, so a line that shares one of the last words of its prefix with many lines of its size is first
tried against the earliest of these. Pairs of which this leaves neither line open are not made at all: a
large group of near copies does not become all its pairs.

Defined results: NULL texts stay NULL, blank lines always stay, rows equal in every column are one
document and keep the same lines; a text that loses all its lines becomes empty. A NULL id comes before all others; two
texts under one id are two documents, in the order of their ``row``.
"""

from __future__ import annotations

from fractions import Fraction
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from wardloom.llm.common import SPACE, table
from wardloom.session import broadcast_if_small, materialize

SIMILARITY = Fraction(4, 5)
BUCKET_BITS = 16  # their ranks are written into a plan, of which the driver holds many copies as text
HASH_BITS = 64 - BUCKET_BITS
NARROW = 48  # sets up to this size have a bitmap of 64 bits,
WIDE = 4  # larger ones one of so many times 64
WORD_PARTS = 3  # the words of prefixes are joined in so many parts, one after another
HEAD_WORDS = 4  # last words of a prefix by which a line looks for the leader of its near copies,
LENGTH_STEP = 1.25  # among lines of about its size
FEW = 32  # so many lines with a word are left to the join of prefixes, which makes few pairs of them

ID = ("doc_id", "row", "line_no")
BITMAP = ("bits", *[f"bits{i}" for i in range(1, WIDE)])  # the whole one folded to 64 bits, and its later quarters


def row_key(docs: DataFrame) -> Column:
    # The hash passes over NULLs, so each column says whether it is one.
    return F.xxhash64(*[part for c in docs.columns for part in (F.col(f"`{c}`").isNull(), F.col(f"`{c}`"))])


def lines_of(docs: DataFrame, text: str = "text") -> DataFrame:
    """``(doc_id, row, line_no, line)`` of every line, blank ones too."""
    return docs.select(F.col("doc_id").alias("doc_id"), row_key(docs).alias("row"), F.posexplode(F.split(F.col(text), "\n", -1)).alias("line_no", "line"))


def is_blank(line: Column) -> Column:
    """Whether a line has no word. Blanks are cut at its start only, which ends at the first word; at its end it would look at every character."""
    return F.ltrim(line, F.lit(" \t\n\x0b\x0c\r")) == ""


def split_words(text: Column) -> Column:
    """The words of a line and perhaps empty strings; cut at a plain blank, which needs no regular expression."""
    others = "\t\x0b\x0c\r"
    odd = reduce(Column.__or__, [F.contains(text, F.lit(c)) for c in others])
    return F.split(F.when(odd, F.translate(text, others, " " * len(others))).otherwise(text), " ")


def _bucket(h: Column) -> Column:
    return F.shiftrightunsigned(h, HASH_BITS)


def word_set(line: Column) -> Column:
    """The distinct words of a line as sorted hashes."""
    hashes = F.transform(split_words(line), lambda w: F.xxhash64(w))
    return F.sort_array(F.array_remove(F.array_distinct(hashes), F.xxhash64(F.lit(""))))


def bucket_masks(sets: DataFrame, words: str = "words") -> Column:
    """Array literal: for each word bucket what turns it, by an exclusive or, into its rank by the sets that hold its words.

    Ranks are a permutation of the buckets, with the top bit flipped since keys are signed. The size is fixed.
    """
    size, top = 1 << BUCKET_BITS, 1 << (BUCKET_BITS - 1)
    seen = sets.select(F.explode(words).alias("w")).groupBy(_bucket(F.col("w")).alias("bucket")).agg(F.count(F.lit(1)).alias("n"))
    every = seen.unionByName(sets.sparkSession.range(size).select(F.col("id").alias("bucket"), F.lit(0).cast("long").alias("n")))
    # One row per bucket, however large the corpus: the list has 2^16 numbers.
    listed = every.groupBy("bucket").agg(F.sum("n").alias("n")).agg(F.sort_array(F.collect_list(F.struct("n", "bucket"))).alias("by_rank"))
    masks = F.sort_array(F.transform("by_rank", lambda b, rank: F.struct(b["bucket"], rank.bitwiseXOR(F.lit(top)).bitwiseXOR(b["bucket"]).alias("mask"))))
    listed = listed.select(F.array_join(F.transform(masks, lambda b: b["mask"].cast("string")), ",")).first()[0]
    return F.expr(f"cast(split('{listed}', ',') as array<int>)")


def ranked(hashes: Column, masks: Column) -> Column:
    """Hashes of words as sorted keys, rarest first."""
    # Every bucket has a mask; with the zero the type says so too, and keys without NULLs are sorted as plain numbers.
    return F.sort_array(F.transform(hashes, lambda h: h.bitwiseXOR(F.shiftleft(F.coalesce(F.get(masks, _bucket(h).cast("int")), F.lit(0)).cast("long"), HASH_BITS))))


def with_bitmap(sets: DataFrame) -> DataFrame:
    """``sets (n, words)`` with a bitmap in which every word flips one bit, so that it differs in no more bits than the sets in words.

    A large set's words lie in ranges of hashes, each with its own 64 bits; those of a small one count as one range.
    ``words`` are sorted, so a range is a slice of them, and each word is visited once whatever the width.
    """
    limits = [(1 << 64) // WIDE * i - (1 << 63) for i in range(1, WIDE)]
    sets = sets.withColumn("_marks", F.when(F.col("n") > NARROW, F.sort_array(F.concat("words", F.array(*[F.lit(x).cast("long") for x in limits])))))
    ends = [F.coalesce(F.array_position("_marks", F.lit(x).cast("long")).cast("int") - (i + 1), F.col("n")).alias(f"_end{i}") for i, x in enumerate(limits)]
    ends = [F.lit(0).alias("_start"), *ends, F.col("n").alias(f"_end{WIDE - 1}")]
    sets = sets.select("*", *ends).drop("_marks")
    at = ["_start", *[f"_end{i}" for i in range(WIDE)]]
    bits = [F.expr(f"aggregate(slice(words, {a} + 1, {b} - {a}), 0L, (a, k) -> a ^ shiftleft(1L, cast(k & 63 as int)))").alias(f"bits{i}") for i, (a, b) in enumerate(zip(at, at[1:]))]
    sets = sets.select("*", *bits).drop(*at)
    return sets.withColumn("bits", reduce(Column.bitwiseXOR, [F.col(f"bits{i}") for i in range(WIDE)])).drop("bits0")


def _possible(similarity: Fraction, positions: bool) -> Column:
    """Filters on a pair of lines ``l`` and ``e``: bitmap, length and, at the first shared word, position."""
    p, q = similarity.numerator, similarity.denominator
    # Bitmaps differ in an even number of bits if the sizes do in words, so the most of them follows without rounding.
    few = f"* {p + q} <= (l.n + e.n) * {q - p}"
    differ = [f"(l.{c} ^ e.{c})" for c in BITMAP]
    place = f" and least(l.n - shiftright(l.place, 1), e.n - shiftright(e.place, 1)) * {p + q} >= (l.n + e.n) * {p}" if positions else ""
    every = " + ".join(f"bit_count({d})" for d in (" ^ ".join(differ), *differ[1:]))
    wide = f" and (least(l.n, e.n) <= {NARROW} or ({every}) {few})"
    return F.expr(f"bit_count({differ[0]}) {few} and least(l.n, e.n) * {q} >= greatest(l.n, e.n) * {p}{place}{wide}")


def _gone(pairs: DataFrame, sets: DataFrame, similarity: Fraction) -> DataFrame:
    """``(line)`` numbers of the later lines of those of ``pairs (a, b)`` that are as similar as asked for."""
    pairs = materialize(pairs.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(), "line-pairs")
    wanted = materialize(pairs.select(F.col("a").alias("line")).union(pairs.select("b")).distinct(), "line-ids")
    known = sets.select("line", F.struct(*ID).alias("id"), "words").join(broadcast_if_small(wanted), "line", "left_semi")
    known = materialize(known, "known-lines")
    a, b = (known.select(*[F.col(c).alias(f"{side}_{c}") for c in known.columns]) for side in "ab")
    both = pairs.join(a, F.col("a") == F.col("a_line")).join(b, F.col("b") == F.col("b_line"))
    shared, p, q = F.size(F.array_intersect("a_words", "b_words")), similarity.numerator, similarity.denominator
    alike = both.filter(shared * (p + q) >= (F.size("a_words") + F.size("b_words")) * p)
    return materialize(alike.select(F.when(F.col("a_id") > F.col("b_id"), F.col("a")).otherwise(F.col("b")).alias("line")).distinct(), "gone-lines")


def first_lines(docs: DataFrame, text: str = "text", similarity: Fraction = SIMILARITY) -> DataFrame:
    """``(doc_id, row, line_no)`` of the lines that stay: those without a similar earlier line."""
    p, q = similarity.numerator, similarity.denominator
    lines = lines_of(docs, text).filter(~is_blank(F.col("line")))
    sets = lines.select(F.monotonically_increasing_id().alias("line"), *ID, word_set(F.col("line")).alias("words"))
    sets = sets.select("*", F.xxhash64("words").alias("one"), F.xxhash64(F.lit(1), "words").alias("two"), F.size("words").alias("n"))
    sets = materialize(sets, "line-sets", compression="zstd")

    # Lines with equal sets: the earliest stands for all of them.
    firsts = sets.groupBy("one", "two", "n").agg(F.min(F.struct(*ID, "line")).alias("first"))
    firsts = materialize(firsts.select("first.line"), "first-of-equals")
    kept = sets.join(broadcast_if_small(firsts), "line", "left_semi").select("line", *ID, "n", "words")
    rarest = F.expr(f"n - (n * {p} + {q - 1}) div {q} + 1").cast("int")
    prefix = F.slice(ranked(F.col("words"), bucket_masks(sets)), 1, rarest).alias("prefix")
    distinct = materialize(with_bitmap(kept).select("line", *ID, "n", *BITMAP, prefix), "lines", compression="zstd")

    # Near copies nearly always share one of the last words of their prefixes, and many their size. Only the lines of
    # large groups are put in order and tried, since those of small ones make few pairs.
    heads = distinct.select("line", F.struct(*ID).alias("id"), "n", *BITMAP, F.explode(F.slice("prefix", -F.least(F.size("prefix"), F.lit(HEAD_WORDS)), HEAD_WORDS)).alias("word"))
    heads = heads.withColumn("about", F.round(F.log(LENGTH_STEP, F.col("n"))).cast("int"))
    many = materialize(heads.groupBy("word", "about").agg(F.count(F.lit(1)).alias("lines")).filter(F.col("lines") > FEW).select("word", "about"), "many-lines")
    heads = materialize(heads.join(broadcast_if_small(many), ["word", "about"], "left_semi"), "heads-of-many", compression="zstd")
    leaders = heads.groupBy("word", "about").agg(F.min(F.struct("id", "line", "n", *BITMAP)).alias("e"))
    leaders = leaders.select("word", "about", "e.line", "e.n", *[f"e.{c}" for c in BITMAP])
    tried = heads.select("line", "n", "about", *BITMAP, "word").alias("l").join(leaders.alias("e"), F.expr("l.word = e.word and l.about = e.about and l.line <> e.line")).filter(_possible(similarity, positions=False))
    gone = _gone(tried.select(F.col("l.line").alias("a"), F.col("e.line").alias("b")), sets, similarity)

    flagged = broadcast_if_small(gone.withColumn("gone", F.lit(True)))
    asked = distinct.join(flagged, "line", "left").select("line", "doc_id", "n", *BITMAP, "prefix", F.col("gone").isNull().cast("int").alias("open"))
    prefixes = asked.select("line", "doc_id", "n", *BITMAP, "open", F.posexplode("prefix").alias("at", "word"))
    prefixes = prefixes.select("line", "doc_id", "n", *BITMAP, "word", (F.col("at") * 2 + F.col("open")).alias("place"))
    # A pair is of use if its later line is still open, which the last bit of its place says. Asked of both lines at once,
    # this is no filter of one side: both sides stay the same rows, which are shuffled and written once.
    later = F.expr("(l.place & (e.place | 1) & 1) = 1") & (F.col("l.line") != F.col("e.line")) & F.coalesce(F.col("l.doc_id") >= F.col("e.doc_id"), F.lit(True))
    found = []
    for part in range(WORD_PARTS):
        own = prefixes.filter(F.pmod(F.col("word"), F.lit(WORD_PARTS)) == part)
        pairs = own.alias("l").join(own.alias("e"), F.col("l.word") == F.col("e.word")).filter(later & _possible(similarity, positions=True))
        found.append(materialize(pairs.select(F.col("l.line").alias("a"), F.col("e.line").alias("b")), "part-pairs"))
    also = _gone(reduce(DataFrame.union, found), sets, similarity)
    gone = gone.union(also).distinct()
    return distinct.select("line", *ID).join(broadcast_if_small(gone), "line", "left_anti").select(*ID)


def dedup_lines(docs: DataFrame, text: str = "text", similarity: Fraction = SIMILARITY) -> DataFrame:
    """``docs`` with the text cut down to its first lines, and ``lines_removed``."""
    names = docs.columns
    stay = first_lines(docs, text, similarity).groupBy("doc_id", "row").agg(F.sort_array(F.collect_list("line_no")).alias("_ld_stay"))
    stay = materialize(stay.select(F.col("row").alias("_ld_row"), F.col("doc_id").alias("_ld_id"), "_ld_stay"), "first-lines")
    cut = docs.select("*", row_key(docs).alias("_ld_key"), F.split(F.col(text), "\n", -1).alias("_ld_lines"))
    # A hash may be that of another document; with the id as well it stands for one.
    joined = cut.join(broadcast_if_small(stay), (F.col("_ld_key") == F.col("_ld_row")) & F.col("doc_id").eqNullSafe(F.col("_ld_id")), "left")
    blank = F.filter(F.transform("_ld_lines", lambda s, i: F.when(is_blank(s), i)), lambda i: i.isNotNull())
    joined = joined.select(*[F.col(f"`{c}`") for c in names], "_ld_lines", F.sort_array(F.concat(F.coalesce("_ld_stay", F.array().cast("array<int>")), blank)).alias("_ld_stay"))
    kept = F.when(F.col(text).isNotNull(), F.array_join(F.transform("_ld_stay", lambda i: F.get("_ld_lines", i)), "\n"))
    removed = F.coalesce(F.size("_ld_lines") - F.size("_ld_stay"), F.lit(0))
    return joined.select(*[kept.alias(c) if c == text else F.col(f"`{c}`") for c in names], F.when(F.col(text).isNull(), 0).otherwise(removed).cast("long").alias("lines_removed"))


def without_repeated_lines(docs: DataFrame) -> DataFrame:
    """``docs`` with repeated lines removed; documents of which nothing is left go. Columns stay, ``n_chars`` is counted anew."""
    out = dedup_lines(docs)
    out = out.filter((F.col("lines_removed") == 0) | (F.length(F.regexp_replace("text", SPACE, "")) > 0))
    made = {"n_chars": F.when(F.col("lines_removed") > 0, F.length("text").cast("long")).otherwise(F.col("n_chars"))} if "n_chars" in docs.columns else {}
    return out.select(*[made.get(c, F.col(f"`{c}`")).alias(c) for c in docs.columns])


def line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Query: every document with the lines it keeps and how many it lost."""
    return dedup_lines(table(spark, sf_dir, "documents").select("doc_id", "text")).select("doc_id", "text", "lines_removed")
