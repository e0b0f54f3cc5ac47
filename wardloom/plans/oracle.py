"""The same queries in SQL for DuckDB, written apart from the Spark plans.

Where the plans avoid a window (numbering, neighbours of a token) or a regular expression, the SQL
uses one, so that the two do not share their mistakes.
"""

from __future__ import annotations

from collections.abc import Callable

from wardloom.functions import rules as fixed
from wardloom.functions.rules import Rules
from wardloom.plans import sample
from wardloom.plans.notes import ADMISSION, DISCHARGE, FOLLOW_UP, NoteKind
from wardloom.plans.queries import FILE_DOCS, SAMPLE_DELIMITERS


def _text(value: str) -> str:
    return "'" + value.replace("'", "''") + "'"


def _delimiter(value: str) -> str:
    return "chr(10)" if value == "\n" else _text(value)


def _in(expression: str, choices) -> str:
    return f"coalesce({expression} IN ({', '.join(_text(c) for c in choices)}), false)" if choices else "false"


def _encoded(*fields: str) -> str:
    parts = [f"coalesce(length({f}::VARCHAR) || ':' || {f}::VARCHAR, '-')" for f in fields]
    return " || '|' || ".join(parts)


def _pick(fields: tuple[str, ...], salt: str, choices: str) -> str:
    return f"('0x' || substr(md5({_encoded(*fields)} || {_text('|' + salt)}), 1, 15))::BIGINT % {choices}"


def records_sql(delimiter: str) -> str:
    return f"""
SELECT doc_id, pos, text FROM (
  SELECT doc_id, generate_subscripts(pieces, 1) - 1 AS pos, unnest(pieces) AS text FROM (
    SELECT doc_id, list_filter(string_split(text, {_delimiter(delimiter)}), lambda x: x <> '') AS pieces FROM documents))"""


def corpus_sql(delimiter: str) -> str:
    return f"SELECT row_number() OVER (ORDER BY doc_id, pos) - 1 AS idx, text FROM ({records_sql(delimiter)})"


def upsert_sql(target: str, staged: str, keys: tuple[str, ...]) -> str:
    same = " AND ".join(f"s.{k} = t.{k}" for k in keys)
    return f"""
WITH target AS ({target}), staged AS ({staged})
SELECT * FROM target t WHERE NOT EXISTS (SELECT 1 FROM staged s WHERE {same})
UNION ALL BY NAME SELECT * FROM staged"""


# -- sentiment -------------------------------------------------------------------------------

_SPACE = r"\t-\r\x1c-\x20\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}"
_PUNCTUATION = r"!-/:-@\[-`{-~"


def sentiment_ctes(texts: str, rules: Rules = sample.RULES, lexicon: dict[str, float] = sample.LEXICON) -> str:
    """CTEs that end in ``scores(id, neg, neu, pos, compound)`` for ``texts(id, text)``."""
    marks = "|".join("".join("\\" + c for c in m) for m in fixed.EDGE_PUNCTUATION)
    word = f"([^{_PUNCTUATION}]{{2,}})"
    strip = _text(f"^(?:(?:{marks}){word}|{word}(?:{marks}))$")
    caps = lambda w: f"(regexp_matches({w}, '\\p{{Lu}}') AND NOT regexp_matches({w}, '[\\p{{Ll}}\\p{{Lt}}]'))"
    lexicon_rows = ", ".join(f"({_text(t)}, {v}::DOUBLE)" for t, v in lexicon.items())
    idioms = " ".join(f"WHEN {_text(p)} THEN {v}::DOUBLE" for p, v in rules.idioms)
    idiom = lambda *parts: f"CASE {' || chr(32) || '.join(parts)} {idioms} END" if idioms else "NULL"
    negates = lambda i: f"({_in(f'lower(b{i})', rules.negations)} OR coalesce(contains(lower(b{i}), {_text(rules.negation_part)}), false))"
    follows = lambda i: _in(f"b{i}", rules.never_followers)
    never = lambda i: f"b{i} = {_text(rules.never)}"
    plain = lambda i: f"(place >= {i} AND NOT known{i})"
    away = lambda v: f"(CASE WHEN {v} > 0 THEN {fixed.BOOST_CAPS}::DOUBLE ELSE -{fixed.BOOST_CAPS}::DOUBLE END)"
    negation = lambda i: f"CASE WHEN {negates(i)} THEN {fixed.NEGATION_SCALE}::DOUBLE ELSE 1.0::DOUBLE END"
    scale = {
        1: negation(1),
        2: f"CASE WHEN {never(2)} AND {follows(1)} THEN {fixed.NEVER_SCALE_NEAR}::DOUBLE ELSE {negation(2)} END",
        3: f"CASE WHEN ({never(3)} AND {follows(2)}) OR {follows(1)} THEN {fixed.NEVER_SCALE_FAR}::DOUBLE ELSE {negation(3)} END",
    }

    def step(i: int, source: str, name: str) -> str:
        before = f"v{i - 1}"
        up, down = _in(f"lower(b{i})", rules.intensifiers), _in(f"lower(b{i})", rules.dampeners)
        boost = f"CASE WHEN {up} THEN {fixed.BOOST_UP}::DOUBLE WHEN {down} THEN {fixed.BOOST_DOWN}::DOUBLE END"
        signed = f"(CASE WHEN {before} < 0 THEN -({boost}) ELSE {boost} END)"
        loud = f"(CASE WHEN {caps(f'b{i}')} AND mixed THEN {away(before)} ELSE 0.0::DOUBLE END)"
        added = f"coalesce(({signed} + {loud}) * {fixed.DISTANCE_DAMPING[i - 1]}::DOUBLE, 0.0::DOUBLE)"
        return f"""{name} AS (SELECT *, CASE WHEN {plain(i)} THEN ({before} + {added}) * ({scale[i]}) ELSE {before} END AS v{i} FROM {source})"""

    looks = [idiom("w", "a1", "a2"), idiom("w", "a1"), idiom("b1", "w"), idiom("b2", "b1", "w"), idiom("b2", "b1"), idiom("b3", "b2", "b1"), idiom("b3", "b2")]
    pair = f"({_in('b3 || chr(32) || b2', rules.dampening_pairs)} OR {_in('b2 || chr(32) || b1', rules.dampening_pairs)})"
    modifier = f"""({_in('lower(w)', (*rules.intensifiers, *rules.dampeners))}
        OR (lower(w) = {_text(rules.kind_of[0])} AND coalesce(lower(a1) = {_text(rules.kind_of[1])}, false)))"""
    unit = "2000000000"
    return f"""
lexicon(token, valence) AS (VALUES {lexicon_rows}),
cut AS (
  SELECT id, length(text) - length(replace(text, '!', '')) AS exclamations, length(text) - length(replace(text, '?', '')) AS questions,
    list_transform(regexp_extract_all(text, '[^{_SPACE}]{{2,}}'), lambda t: regexp_replace(t, {strip}, '\\1\\2')) AS words
  FROM ({texts})),
facts AS (
  SELECT id, exclamations, questions, words, len(words) AS n,
    len(list_filter(words, lambda w: {caps('w')})) BETWEEN 1 AND len(words) - 1 AS mixed,
    coalesce(list_position(list_transform(words, lambda w: lower(w)), {_text(rules.contrast)}), 0) AS contrast
  FROM cut),
tokens AS (
  SELECT id, n, mixed, contrast, generate_subscripts(words, 1) - 1 AS place, unnest(words) AS w FROM facts),
placed AS (
  SELECT *, lag(w, 1) OVER o AS b1, lag(w, 2) OVER o AS b2, lag(w, 3) OVER o AS b3, lead(w, 1) OVER o AS a1, lead(w, 2) OVER o AS a2
  FROM tokens WINDOW o AS (PARTITION BY id ORDER BY place)),
hits AS (
  SELECT p.*, l.valence,
    coalesce(lower(b1) IN (SELECT token FROM lexicon), false) AS known1,
    coalesce(lower(b2) IN (SELECT token FROM lexicon), false) AS known2,
    coalesce(lower(b3) IN (SELECT token FROM lexicon), false) AS known3
  FROM placed p JOIN lexicon l ON lower(p.w) = l.token),
start AS (SELECT *, valence + CASE WHEN {caps('w')} AND mixed THEN {away('valence')} ELSE 0.0::DOUBLE END AS v0 FROM hits),
{step(1, 'start', 'step1')},
{step(2, 'step1', 'step2')},
{step(3, 'step2', 'step3')},
phrased AS (
  SELECT *, (CASE WHEN {plain(3)} THEN coalesce({', '.join(looks)}, v3) ELSE v3 END)
    + (CASE WHEN {plain(3)} AND {pair} THEN {fixed.BOOST_DOWN}::DOUBLE ELSE 0.0::DOUBLE END) AS v4
  FROM step3),
valued AS (
  SELECT id, place, w, contrast, CASE WHEN {modifier} THEN 0 ELSE floor(
    v4 * (CASE WHEN {plain(1)} AND lower(b1) = {_text(rules.least)} AND NOT {_in('lower(b2)', rules.least_exceptions)}
      THEN {fixed.NEGATION_SCALE}::DOUBLE ELSE 1.0::DOUBLE END) * 1e9::DOUBLE + 0.5::DOUBLE)::BIGINT END AS own
  FROM phrased),
firsts AS (
  SELECT id, first_value(own) OVER (PARTITION BY id, w ORDER BY place) AS s,
    CASE WHEN contrast > 0 AND place + 1 < contrast THEN 1 WHEN contrast > 0 AND place + 1 > contrast THEN 3 ELSE 2 END AS halves
  FROM valued),
sums AS (
  SELECT id, sum(s * halves) AS total,
    sum(CASE WHEN s > 0 THEN s * halves + {unit} ELSE 0 END) AS plus,
    sum(CASE WHEN s < 0 THEN {unit} - s * halves ELSE 0 END) AS minus,
    sum(CASE WHEN s <> 0 THEN 1 ELSE 0 END) AS moved
  FROM firsts GROUP BY id),
parts AS (
  SELECT f.id, n, coalesce(total, 0)::DOUBLE / {unit}::DOUBLE AS total, coalesce(plus, 0)::DOUBLE / {unit}::DOUBLE AS plus,
    coalesce(minus, 0)::DOUBLE / {unit}::DOUBLE AS minus, (n - coalesce(moved, 0))::DOUBLE AS neutral,
    least(exclamations, {fixed.EXCLAMATION_MAX}) * {fixed.EXCLAMATION_STEP}::DOUBLE
      + CASE WHEN questions <= 1 THEN 0.0::DOUBLE WHEN questions <= 3 THEN questions * {fixed.QUESTION_STEP}::DOUBLE ELSE {fixed.QUESTION_MAX}::DOUBLE END AS emphasis
  FROM facts f LEFT JOIN sums USING (id)),
emphasised AS (
  SELECT id, n, neutral, total + sign(total) * emphasis AS total,
    plus + CASE WHEN plus > minus THEN emphasis ELSE 0 END AS plus, minus + CASE WHEN plus < minus THEN emphasis ELSE 0 END AS minus
  FROM parts),
scores AS (
  SELECT id,
    CASE WHEN n = 0 THEN 0.0::DOUBLE ELSE round_even(minus / (plus + minus + neutral) * 1000::DOUBLE, 0) / 1000::DOUBLE END AS neg,
    CASE WHEN n = 0 THEN 0.0::DOUBLE ELSE round_even(neutral / (plus + minus + neutral) * 1000::DOUBLE, 0) / 1000::DOUBLE END AS neu,
    CASE WHEN n = 0 THEN 0.0::DOUBLE ELSE round_even(plus / (plus + minus + neutral) * 1000::DOUBLE, 0) / 1000::DOUBLE END AS pos,
    CASE WHEN n = 0 THEN 0.0::DOUBLE ELSE round_even(total / sqrt(total * total + {fixed.NORMALIZATION}) * 10000::DOUBLE, 0) / 10000::DOUBLE END AS compound
  FROM emphasised)"""


# -- notes -----------------------------------------------------------------------------------

_USERS = "SELECT DISTINCT o_custkey AS id, o_orderstatus, o_orderpriority FROM orders"


def folder_sql(delimiter: str, after: str = "") -> str:
    """The records of files of FILE_DOCS documents each, every document followed by ``after`` and a newline."""
    return f"""
SELECT part, pos, text FROM (
  SELECT part, generate_subscripts(pieces, 1) - 1 AS pos, unnest(pieces) AS text FROM (
    SELECT part, list_filter(string_split(content, {_delimiter(delimiter)}), lambda x: x <> '') AS pieces FROM (
      SELECT doc_id // {FILE_DOCS} AS part, string_agg(coalesce(text, '') || {after or "''"} || chr(10), '' ORDER BY doc_id) AS content
      FROM documents GROUP BY doc_id // {FILE_DOCS})))"""


def note_folder_sql(kind: NoteKind) -> str:
    after = "''" if kind.delimiter == "\n" else f"chr(10) || {_text(kind.delimiter)}"
    return f"SELECT row_number() OVER (ORDER BY part, pos) - 1 AS idx, text FROM ({folder_sql(kind.delimiter, after)})"


def notes_sql(kind: NoteKind, corpus: str | None = None, provider: str | None = None) -> str:
    who, salt = ("user_id", "occurrence"), kind.label
    provider = provider or f"1 + {_pick(who, 'provider|' + salt, '2000')}"
    stored = "replace(c.text, chr(10), '')" if kind.one_line else "c.text"
    return f"""
WITH corpus AS MATERIALIZED ({corpus or corpus_sql(SAMPLE_DELIMITERS[kind])}),
numbered AS (SELECT id AS user_id, row_number() OVER (PARTITION BY id) - 1 AS occurrence FROM ({_USERS})),
drawn AS MATERIALIZED (SELECT *, {_pick(who, salt, '(SELECT count(*) FROM corpus)')} AS idx FROM numbered),
{sentiment_ctes("SELECT idx AS id, text FROM corpus WHERE idx IN (SELECT idx FROM drawn)")}
SELECT d.user_id, {stored} AS notes, {provider} AS provider_id,
  s.compound + s.neu AS notes_pos_sentiment, md5({_encoded(*who, _text(salt))}) AS id, {_text(kind.label)} AS notes_type
FROM drawn d JOIN corpus c ON c.idx = d.idx JOIN scores s ON s.id = d.idx"""


def _union_sql(corpus: Callable[[NoteKind], str | None] = lambda kind: None) -> str:
    return " UNION ALL ".join(f"SELECT * FROM ({notes_sql(kind, corpus(kind))})" for kind in (ADMISSION, FOLLOW_UP, DISCHARGE))


def _drawn_provider(salt: str) -> str:
    return f"""(SELECT s_suppkey FROM (SELECT s_suppkey, row_number() OVER (ORDER BY s_suppkey) - 1 AS place FROM (SELECT DISTINCT s_suppkey FROM supplier))
  WHERE place = {_pick(('user_id', 'occurrence'), 'provider|' + salt, '(SELECT count(DISTINCT s_suppkey) FROM supplier)')})"""


# -- table loads: what the earlier run left, and what the later one staged ---------------------

_DEVICES = "SELECT DISTINCT p_name AS device_model, p_brand AS brand FROM part"
_FACTS = "SELECT l_orderkey AS user_id, l_partkey AS device_model, l_shipdate AS date, l_quantity{} AS steps, l_extendedprice AS calories_burned FROM lineitem WHERE l_returnflag <> '{}'"
_PROFILES = "SELECT DISTINCT o_custkey AS id, o_orderstatus, o_orderpriority FROM orders WHERE year(o_orderdate) {} 2001"
_RENEWALS = f"""
SELECT user_id, year, plan_type, premium_cost, md5({_encoded('user_id', 'year', 'plan_type', 'premium_cost', 'occurrence')}) AS id FROM (
  SELECT *, row_number() OVER (PARTITION BY user_id, year, plan_type, premium_cost) - 1 AS occurrence FROM (
    SELECT o_custkey AS user_id, year(o_orderdate)::INTEGER AS year, o_orderpriority AS plan_type, o_totalprice AS premium_cost
    FROM orders WHERE year(o_orderdate) {{}}))"""
_PROVIDERS = "SELECT s_suppkey AS id, s_name, s_nationkey, {} AS s_acctbal FROM supplier WHERE {}"

LOAD_SQL: dict[str, tuple[str, str, tuple[str, ...]]] = {
    "devices": (_DEVICES, _DEVICES + " WHERE p_size >= 49", ("device_model",)),
    "watch_facts": (_FACTS.format("", "R"), _FACTS.format(" + 1", "A"), ("user_id", "date")),
    "watch_facts_by_date": tuple(f"SELECT * REPLACE (date_trunc('month', date)::DATE AS date) FROM ({_FACTS.format(*run)})" for run in (("", "R"), (" + 1", "A"))) + (("user_id", "date"),),
    "users": (_PROFILES.format("<"), _PROFILES.format(">="), ("id",)),
    "renewal_history": (_RENEWALS.format("< 2000"), _RENEWALS.format(">= 1998"), ("id",)),
    "provider": (_PROVIDERS.format("0.0::DOUBLE", "true"), _PROVIDERS.format("s_acctbal", "s_acctbal >= 0"), ("id",)),
}


def _report_sql() -> str:
    parts = []
    for name, (target, staged, keys) in LOAD_SQL.items():
        same = " AND ".join(f"s.{k} = t.{k}" for k in keys)
        parts.append(f"""
SELECT '{name}' AS "table", count(*) AS rows_in, 0::BIGINT AS rows_deleted, count(*) AS rows_out FROM ({target})
UNION ALL SELECT '{name}', staged, deleted, loaded + staged - deleted FROM (
  SELECT (SELECT count(*) FROM ({staged})) AS staged, (SELECT count(*) FROM ({target})) AS loaded,
    (SELECT count(*) FROM ({target}) t WHERE EXISTS (SELECT 1 FROM ({staged}) s WHERE {same})) AS deleted)""")
    return " UNION ALL ".join(parts)


def _newest_sql(name: str, rows: str, key: str) -> str:
    return f"""SELECT *, '{name}' AS "table" FROM ({rows}) QUALIFY load_no = max(load_no) OVER (PARTITION BY {key})"""


def _incremental_sql() -> str:
    facts = "SELECT l_orderkey AS user_id, l_partkey::VARCHAR AS device_model, l_returnflag AS brand, l_shipdate AS date, l_quantity{} AS steps, l_extendedprice AS calories_burned, {} AS load_no FROM lineitem WHERE l_returnflag {}"
    wearables = " UNION ALL ".join(facts.format(*drop) for drop in (("", 0, "<> 'R'"), ("", 1, "= 'R'"), (" + 1", 2, "= 'A'")))
    years = ((0, "< 2000"), (1, "BETWEEN 1998 AND 2001"), (2, ">= 2002"))
    customers = " UNION ALL ".join(f"SELECT *, {n} AS load_no FROM orders WHERE year(o_orderdate) {years}" for n, years in years)
    renewals = " UNION ALL ".join(f"SELECT *, {n} AS load_no FROM ({_RENEWALS.format(years)})" for n, years in years)
    providers = f"SELECT *, 0 AS load_no FROM ({_PROVIDERS.format('0.0::DOUBLE', 'true')}) UNION ALL SELECT *, 1 FROM ({_PROVIDERS.format('s_acctbal', 's_acctbal >= 0')})"
    parts = (
        _newest_sql("devices", f"SELECT DISTINCT device_model, brand, load_no FROM ({wearables})", "device_model"),
        _newest_sql("watch_facts", f"SELECT * EXCLUDE (brand) FROM ({wearables})", "user_id, date"),
        _newest_sql("users", f"SELECT DISTINCT o_custkey AS id, o_orderstatus, o_orderpriority, load_no FROM ({customers})", "id"),
        _newest_sql("renewal_history", f"SELECT * RENAME (id AS renewal_id) FROM ({renewals})", "renewal_id"),
        _newest_sql("provider", providers, "id"),
    )
    return " UNION ALL BY NAME ".join(f"SELECT * FROM ({part})" for part in parts)


_STREAMED = "SELECT * REPLACE (CASE WHEN ts >= TIMESTAMP '2024-01-10' THEN value + 1 ELSE value END AS value) FROM events"
_TARGET = "SELECT * FROM customer WHERE c_mktsegment <> 'MACHINERY'"
_STAGED = "SELECT * REPLACE (c_acctbal + 1 AS c_acctbal) FROM customer WHERE c_mktsegment IN ('MACHINERY', 'BUILDING')"

ORACLE: dict[str, str] = {
    "scan_customers": "SELECT * FROM customer",
    "scan_wearables": "SELECT * FROM events",
    "scan_provider": "SELECT * FROM supplier",
    "incremental_scan": """
SELECT *, (CASE WHEN event_id <= (SELECT (min(event_id) + max(event_id)) // 2 FROM events) THEN 1 ELSE 2 END)::INTEGER AS run FROM events""",
    "corpus_suffix_filter": "SELECT * FROM pages WHERE ends_with(url, '#top')",
    "records_newline": records_sql("\n"),
    "records_literal_delim": records_sql(". "),
    "corpus_index": corpus_sql("\n"),
    "corpus_folder": f"SELECT row_number() OVER (ORDER BY part, pos) - 1 AS idx, text FROM ({folder_sql('. ')})",
    "corpus_growth": f"""
WITH numbered AS MATERIALIZED (SELECT row_number() OVER (ORDER BY part % 2, part, pos) - 1 AS idx, part, text FROM ({folder_sql(chr(10))}))
SELECT idx, text FROM numbered UNION ALL
SELECT -c_custkey - 1, text FROM (SELECT c_custkey, {_pick(('c_custkey',), 'text', '(SELECT count(*) FROM numbered WHERE part % 2 = 0)')} AS idx FROM customer) JOIN numbered USING (idx)""",
    "create_empty_table": "SELECT * FROM orders WHERE false",
    "append_insert": "SELECT * FROM orders WHERE o_orderstatus <> 'F' UNION ALL SELECT * FROM orders WHERE o_orderstatus = 'F'",
    "upsert_single_key": upsert_sql(_TARGET, _STAGED, ("c_custkey",)),
    "upsert_composite_key": upsert_sql(
        "SELECT * FROM lineitem WHERE l_returnflag <> 'R'",
        "SELECT * REPLACE (l_quantity + 1 AS l_quantity) FROM lineitem WHERE l_returnflag <> 'A'",
        ("l_orderkey", "l_linenumber"),
    ),
    "semi_join_deleted": f"SELECT * FROM ({_TARGET}) t WHERE EXISTS (SELECT 1 FROM ({_STAGED}) s WHERE s.c_custkey = t.c_custkey)",
    "anti_join_survivors": f"SELECT * FROM ({_TARGET}) t WHERE NOT EXISTS (SELECT 1 FROM ({_STAGED}) s WHERE s.c_custkey = t.c_custkey)",
    "rename_columns": "SELECT p_partkey AS device_id, p_name AS device_model, p_brand, p_type, p_size, p_retailprice FROM part",
    "project_watch_facts": _FACTS.format("", "none"),
    "project_renewal": "SELECT o_custkey AS user_id, year(o_orderdate)::INTEGER AS year, o_orderpriority AS plan_type, o_totalprice AS premium_cost FROM orders",
    "distinct_devices": _DEVICES,
    "distinct_users": _USERS,
    "surrogate_key": f"SELECT o_orderkey, md5({_encoded('o_orderkey', 'o_custkey', 'o_orderstatus', 'o_orderpriority')}) AS id FROM orders",
    "provider_assign": f"SELECT c_custkey, 1 + {_pick(('c_custkey',), 'provider', '2000')} AS provider_id FROM customer",
    "random_text_assign": f"""
WITH corpus AS MATERIALIZED ({corpus_sql(chr(10))}),
drawn AS (SELECT c_custkey, {_pick(('c_custkey',), 'text', '(SELECT count(*) FROM corpus)')} AS idx FROM customer)
SELECT c_custkey, text AS notes FROM drawn JOIN corpus USING (idx)""",
    "label_constant": "SELECT o_orderkey, 'admission_notes' AS notes_type FROM orders",
    "strip_newlines": "SELECT doc_id, replace(text, chr(10), '') AS text FROM documents",
    "left_join_devices": f"""
SELECT p_partkey, p_name AS device_model, p_brand AS brand, d.device_id FROM part LEFT JOIN (
  SELECT DISTINCT p_name AS name, p_brand AS made_by, md5({_encoded('p_name', 'p_brand')}) AS device_id FROM part WHERE p_type = 'ECONOMY') d
ON p_name = d.name AND p_brand = d.made_by""",
    "sentiment_score": f"WITH {sentiment_ctes('SELECT doc_id AS id, text FROM documents')} SELECT id AS doc_id, compound + neu AS score FROM scores",
    "sentiment_components": f"WITH {sentiment_ctes('SELECT doc_id AS id, text FROM documents')} SELECT id AS doc_id, neg, neu, pos, compound FROM scores",
    "notes_admission": notes_sql(ADMISSION),
    "notes_follow_up": notes_sql(FOLLOW_UP),
    "notes_discharge": notes_sql(DISCHARGE),
    "notes_union": _union_sql(),
    "doctor_notes": _union_sql(),
    "notes_from_folders": _union_sql(note_folder_sql),
    "notes_with_providers": notes_sql(ADMISSION, provider=_drawn_provider(ADMISSION.label)),
    "filter_notes_type": notes_sql(DISCHARGE),
    "count_notes": f"SELECT 3 * count(*) AS n FROM ({_USERS})",
    **{f"load_{name}": upsert_sql(*spec) for name, spec in LOAD_SQL.items()},
    "load_report": _report_sql(),
    "stream_upsert": _STREAMED,
    "stream_late_drop": _STREAMED,
    "incremental_job": _incremental_sql(),
}
