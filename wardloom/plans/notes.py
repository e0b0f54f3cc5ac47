"""Doctor's notes: one drawn, scored and labelled note per user row and kind."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from wardloom.functions.keys import provider_pick, random_id, surrogate_id
from wardloom.functions.rules import Rules
from wardloom.functions.text import DISCHARGE_DELIMITER, FOLLOW_UP_DELIMITER, NEWLINE, strip_newlines
from wardloom.operators.corpus import Corpus, corpus_of_folder
from wardloom.operators.numbering import number_equal_rows
from wardloom.operators.picks import assign_key, with_pick
from wardloom.operators.sentiment import note_score, score_texts
from wardloom.session import Intermediates, materialize
from wardloom.sinks.jdbc import JdbcTable
from wardloom.sinks.report import LoadReport
from wardloom.sinks.snapshot import LoadCounts, SnapshotTable


@dataclass(frozen=True)
class NoteKind:
    label: str
    folder: str
    delimiter: str
    one_line: bool = False  # newlines are taken out of the stored text, after scoring


# Labels, folders and delimiters of the three kinds.
ADMISSION = NoteKind("admission_notes", "notes/admission_notes/", NEWLINE)
FOLLOW_UP = NoteKind("follow_up_notes", "notes/admission_follow_up/", FOLLOW_UP_DELIMITER)
DISCHARGE = NoteKind("discharge_notes", "notes/discharge_notes/", DISCHARGE_DELIMITER, one_line=True)
KINDS = (ADMISSION, FOLLOW_UP, DISCHARGE)

FEW_RECORDS = 1 << 16  # a corpus with fewer may have hot records

NOTE_COLUMNS = ("user_id", "notes", "provider_id", "notes_pos_sentiment", "id", "notes_type")


def doctor_notes(
    users: DataFrame,
    corpora: Mapping[NoteKind, Corpus],
    lexicon: DataFrame | None = None,
    rules: Rules = Rules(),
    scorer: Callable[[Column], Column] | None = None,
    user_key: str = "id",
    providers: DataFrame | None = None,
    provider_key: str = "id",
    id_mode: str = "derived",
    seed: str = "",
) -> DataFrame:
    """One note of every kind in ``corpora`` per row of ``users``, as one table.

    A user that comes in several rows gets as many notes of a kind. Draws and ids are derived from the user, the
    number of the row among the user's rows, the kind and ``seed``, so recomputed tasks and reruns repeat
    them; another ``seed`` gives other draws, and ``id_mode="random"`` fresh ids. Only records that
    somebody drew are cut, moved and scored, each once, with ``lexicon`` and ``rules`` or by ``scorer``, and always
    on the text that is stored (before its newlines are taken out). ``providers`` draws from real provider keys
    instead of the fixed number range.

    Users are numbered once for all kinds, and the records of all kinds are scored and joined together: the
    corpora lie end to end in one range of numbers.
    """
    if (lexicon is None) == (scorer is None):
        raise ValueError("give either a lexicon or a scorer")
    who = ["user_id", "occurrence"]
    who_columns = [F.col(c) for c in who]
    numbered = materialize(number_equal_rows(users.select(F.col(user_key).alias("user_id"))), "users")

    draws, records, wanted, kinds, begin, exact = [], [], [], [], 0, True
    for kind, corpus in corpora.items():
        salt = kind.label + seed
        picked = with_pick(numbered, who, salt, corpus)
        note = (F.col("idx") + begin).alias("note")
        found, just_drawn = corpus.likely_drawn(picked.select("idx").distinct())
        records.append(found.select(note, "text"))
        wanted.append(picked.select(note))
        exact &= just_drawn
        # Draws are shuffled while they are narrow: providers from the number range are drawn after it.
        noted = picked.select(*who, note, F.lit(kind.label).alias("notes_type"))
        draws.append(noted if providers is None else assign_key(noted, who, "provider|" + salt, providers, provider_key, "provider_id"))
        begin += corpus.size
        kinds.append((begin, kind, provider_pick(who_columns, "provider|" + salt)))

    # Partitioned by note once: a text is scored where it lies, so that its hits are not shuffled, and is joined there.
    # Where a join has to drop records that nobody drew, the texts are shuffled for it and not again. It is no semi
    # join, which would be made before the filter that keeps most of those records from the shuffle.
    if exact:
        used = _union(records).repartition("note")
    else:
        used = _union(records).join(_union(wanted).distinct().hint("shuffle_hash"), "note")
    if scorer is not None:
        scored = used.withColumn("notes_pos_sentiment", scorer(F.col("text")))
    else:
        scores = score_texts(used, "note", "text", lexicon, rules)
        scored = used.join(scores.select("note", note_score().alias("notes_pos_sentiment")), "note")
    text = F.col("text")
    stored = _of_kind([(end, strip_newlines(text) if kind.one_line else text) for end, kind, _ in kinds])
    scored = scored.select("note", stored.alias("notes"), "notes_pos_sentiment")
    if min(corpus.size for corpus in corpora.values()) < FEW_RECORDS:
        # Many users draw the same few records: written, these are broadcast, or their draws split by adaptive execution.
        scored = materialize(scored, "scored-notes", compression="zstd")

    notes = _union(draws).join(scored, "note")
    if providers is None:
        notes = notes.withColumn("provider_id", _of_kind([(end, provider) for end, _, provider in kinds]))
    identity = random_id() if id_mode == "random" else surrogate_id([*who_columns, F.concat("notes_type", F.lit(seed))])
    return notes.select("user_id", "notes", "provider_id", "notes_pos_sentiment", identity.alias("id"), "notes_type")


def _of_kind(values: list[tuple[int, Column]]) -> Column:
    """The value for the kind of a note, given where the numbers of each kind end."""
    chosen = values[-1][1]
    for end, value in values[-2::-1]:
        chosen = F.when(F.col("note") < end, value).otherwise(chosen)
    return chosen


def make_notes(users: DataFrame, corpus: Corpus, kind: NoteKind, **options) -> DataFrame:
    """The notes of one kind."""
    return doctor_notes(users, {kind: corpus}, **options)


def load_notes(
    target: SnapshotTable | JdbcTable,
    users: DataFrame,
    corpora: Callable[[], Mapping[NoteKind, Corpus]],
    report: LoadReport | None = None,
    **options,
) -> LoadCounts:
    """Create ``target`` if it is absent, and append the notes of ``users``.

    ``corpora`` is called inside the load, so that whatever is written on the way is deleted at its end.
    """
    spark = users.sparkSession

    def load() -> LoadCounts:
        with Intermediates(spark):
            notes = doctor_notes(users, corpora(), **options)
            target.create_if_absent(notes.limit(0))
            return target.append(notes)

    return (report or LoadReport(spark)).run("doctor_notes", load)


def _union(parts: list[DataFrame]) -> DataFrame:
    result = parts[0]
    for part in parts[1:]:
        result = result.unionByName(part)
    return result


def note_corpora(spark: SparkSession, base: str, kinds: Sequence[NoteKind] = KINDS) -> dict[NoteKind, Corpus]:
    """The three corpora below ``base`` (or those of ``kinds``), read from their folders. Their records have been written
    then, and the folders are not read again."""
    return {kind: corpus_of_folder(spark, f"{base.rstrip('/')}/{kind.folder}", kind.delimiter) for kind in kinds}


def filter_notes_type(notes: DataFrame, label: str) -> DataFrame:
    return notes.filter(F.col("notes_type") == label)
