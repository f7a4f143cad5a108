"""Building blocks of the check SQL (DuckDB dialect), written relationally on purpose.

Scores are computed here by unnesting words and by windows over positions, not by the
array expressions of the library, so that the two sides can disagree.
"""

from __future__ import annotations

import re

from tidepost import rules
from tidepost.functions import lexicon as lx
from tidepost.functions import text as tx
from tidepost.sources import tables


def quoted(value: str) -> str:
    return "'" + value.replace("'", "''") + "'"


def listed(values) -> str:
    return ", ".join(quoted(v) for v in values)


def array(values) -> str:
    return f"[{listed(values)}]"


def clean(x: str) -> str:
    x = f"coalesce({x}, '')"
    for pattern, replacement in (
        (r"http\S+|www\.\S+", ""),
        (r"@[\p{L}\p{N}_]+", ""),
        ("#", ""),
        (r"[^A-Za-z0-9\s!?.,']", ""),
        (r"\s+", " "),
    ):
        x = f"regexp_replace({x}, {quoted(pattern)}, {quoted(replacement)}, 'g')"
    return f"lower(trim({x}))"


def topic(x: str, whole_word: bool = False) -> str:
    def regex(p: str) -> str:
        return quoted(rf"(?i)\b({p})\b" if whole_word else f"(?i){p}")

    arms = " ".join(f"WHEN regexp_matches({x}, {regex(p)}) THEN {quoted(n)}" for n, p in rules.TOPIC_RULES)
    return f"CASE {arms} ELSE {quoted(rules.DEFAULT_TOPIC)} END"


def label(score: str, inclusive: bool = False) -> str:
    up, down = (">=", "<=") if inclusive else (">", "<")
    return (
        f"CASE WHEN {score} {up} {rules.POSITIVE_ABOVE} THEN 'Positive' "
        f"WHEN {score} {down} {rules.NEGATIVE_BELOW} THEN 'Negative' ELSE 'Neutral' END"
    )


TARGET_LABEL = "CASE target WHEN 0 THEN 'Negative' WHEN 4 THEN 'Positive' ELSE 'Neutral' END"
TARGET_SCORE = "CASE target WHEN 0 THEN -0.6 WHEN 4 THEN 0.6 ELSE 0.0 END::DOUBLE"


def words(x: str) -> str:
    """Keyword occurrences of a text column, stop words still in."""
    return f"unnest(regexp_extract_all(lower({x}), {quoted(tx.KEYWORD_PATTERN)}))"


def valence(name: str, source: str, key: str, text: str, raw: bool = False, lexicon: str = "lexicon") -> dict[str, str]:
    """CTEs ending in ``name(id, compound, positive, neutral, negative)``."""
    read = text if raw else f"lower({text})"
    shouted = "upper(raw) = raw AND lower(raw) <> raw"
    caps = f"CASE WHEN shouted AND some_quiet THEN {rules.CAPITALS_STEP} ELSE 0 END" if raw else "0"
    d1, d2, d3 = rules.DEGREE_DECAY
    return {
        f"{name}_text": f"SELECT {key} AS id, coalesce({read}, '') AS t FROM {source}",
        f"{name}_list": f"SELECT id, regexp_extract_all(t, {quoted(lx.WORD_PATTERN)}) AS ws FROM {name}_text",
        f"{name}_tok": f"SELECT id, unnest(ws) AS raw, unnest(range(len(ws))) AS i FROM {name}_list",
        f"{name}_ctx": f"""
            SELECT id, i, lower(raw) AS w, {shouted} AS shouted,
              lag(lower(raw), 1) OVER p AS w1, lag(lower(raw), 2) OVER p AS w2, lag(lower(raw), 3) OVER p AS w3,
              min(CASE WHEN lower(raw) = {quoted(rules.CONTRAST_WORD)} THEN i END) OVER (PARTITION BY id) AS contrast,
              bool_or(NOT ({shouted})) OVER (PARTITION BY id) AS some_quiet
            FROM {name}_tok WINDOW p AS (PARTITION BY id ORDER BY i)""",
        f"{name}_hit": f"""
            SELECT id, i,
              (l.valence + sign(l.valence) * (coalesce(s1.shift, 0) * {d1} + coalesce(s2.shift, 0) * {d2}
                 + coalesce(s3.shift, 0) * {d3} + {caps}))
              * CASE WHEN w1 IN ({listed(rules.NEGATORS)}) OR w2 IN ({listed(rules.NEGATORS)})
                       OR w3 IN ({listed(rules.NEGATORS)}) THEN {rules.NEGATION_FACTOR} ELSE 1.0 END
              * CASE WHEN contrast IS NULL THEN 1.0 WHEN i < contrast THEN {rules.BEFORE_CONTRAST}
                     ELSE {rules.AFTER_CONTRAST} END AS c
            FROM {name}_ctx c JOIN {lexicon} l ON c.w = l.w
              LEFT JOIN shifts s1 ON c.w1 = s1.w LEFT JOIN shifts s2 ON c.w2 = s2.w
              LEFT JOIN shifts s3 ON c.w3 = s3.w""",
        f"{name}_sum": f"""
            SELECT t.id, coalesce(max(h.s), 0.0) AS s, coalesce(max(h.up), 0.0) AS up,
              coalesce(max(h.down), 0.0) AS down, len(max(l.ws)) - coalesce(max(h.n), 0) AS flat,
              least(len(max(t.t)) - len(replace(max(t.t), '!', '')), {rules.EXCLAMATION_MAX})
                * {rules.EXCLAMATION_STEP} AS emphasis
            FROM {name}_text t JOIN {name}_list l USING (id)
            LEFT JOIN (SELECT id, sum(c) AS s, sum(CASE WHEN c > 0 THEN c + 1 ELSE 0 END) AS up,
                         sum(CASE WHEN c < 0 THEN 1 - c ELSE 0 END) AS down, count(*) FILTER (WHERE c <> 0) AS n
                       FROM {name}_hit GROUP BY id) h USING (id)
            GROUP BY t.id""",
        name: f"""
            SELECT id,
              round((s + sign(s) * emphasis) / sqrt((s + sign(s) * emphasis) * (s + sign(s) * emphasis)
                + {rules.COMPOUND_ALPHA}), 4) AS compound,
              CASE WHEN up + down + flat > 0 THEN round(up / (up + down + flat), 3) ELSE 0.0 END AS positive,
              CASE WHEN up + down + flat > 0 THEN round(flat / (up + down + flat), 3) ELSE 0.0 END AS neutral,
              CASE WHEN up + down + flat > 0 THEN round(down / (up + down + flat), 3) ELSE 0.0 END AS negative
            FROM {name}_sum""",
    }


def polarity(name: str, source: str, key: str, text: str, lexicon: str = "lexicon") -> dict[str, str]:
    """CTEs ending in ``name(id, polarity, subjectivity)``."""
    return {
        f"{name}_tok": f"""
            SELECT id, unnest(ws) AS w, unnest(range(len(ws))) AS i FROM
              (SELECT {key} AS id, regexp_extract_all(lower(coalesce({text}, '')), {quoted(lx.WORD_PATTERN)}) AS ws
               FROM {source})""",
        f"{name}_ctx": f"""
            SELECT id, w, lag(w, 1) OVER p AS w1, lag(w, 2) OVER p AS w2
            FROM {name}_tok WINDOW p AS (PARTITION BY id ORDER BY i)""",
        f"{name}_hit": f"""
            SELECT id, least(greatest(l.polarity * coalesce(f.factor, 1.0), -1.0), 1.0)
                * CASE WHEN w1 IN ({listed(rules.NEGATORS)}) OR w2 IN ({listed(rules.NEGATORS)})
                       THEN {rules.POLARITY_NEGATION} ELSE 1.0 END AS p, l.subjectivity AS s
            FROM {name}_ctx c JOIN {lexicon} l ON c.w = l.w LEFT JOIN factors f ON c.w1 = f.w""",
        name: f"""
            SELECT x.{key} AS id, coalesce(round(h.p, 4), 0.0) AS polarity, coalesce(round(h.s, 4), 0.0) AS subjectivity
            FROM {source} x LEFT JOIN (SELECT id, sum(p) / count(*) AS p, sum(s) / count(*) AS s
                                       FROM {name}_hit GROUP BY id) h ON h.id = x.{key}""",
    }


def _values(rows) -> str:
    return ", ".join("(" + ", ".join(quoted(v) if isinstance(v, str) else f"{v}::DOUBLE" for v in r) + ")" for r in rows)


def _posts() -> str:
    moods = " ".join(
        f"WHEN {quoted(e)} THEN {array(tables.SENTENCES[m])}[event_id % {len(tables.SENTENCES[m])} + 1]"
        for e, m in tables.MOOD_OF_EVENT.items()
    )
    flat = tables.SENTENCES["flat"]
    targets = " ".join(f"WHEN {quoted(e)} THEN {c}" for e, c in tables.TARGET_OF_EVENT.items())
    seed = f"{array(rules.DEMO_TOPICS)}[event_id % {len(rules.DEMO_TOPICS)} + 1]"
    return f"""
        SELECT event_id AS post_id, ts AS "timestamp", 'u' || user_id AS "user",
          {array(rules.PLATFORMS)}[user_id % {len(rules.PLATFORMS)} + 1] AS platform,
          {seed} AS topic_seed,
          replace(CASE event_type {moods} ELSE {array(flat)}[event_id % {len(flat)} + 1] END, '{{topic}}', {seed}) AS text,
          CASE event_type {targets} ELSE 2 END AS target,
          event_id * 37 % 5000 AS likes, event_id * 17 % 2000 AS shares,
          50 + user_id * 7919 % 499950 AS user_followers, value
        FROM events"""


STOPS = listed(rules.STOP_WORDS)

# The cleaning patterns, topics and thresholds used here are the fixed values of ``rules`` and
# ``functions.text`` once more, in the other dialect.
CTES: dict[str, str] = {
    "lexicon": "SELECT * FROM (VALUES "
    + _values([(w, *v) for w, v in rules.LEXICON.items()])
    + ") v(w, valence, polarity, subjectivity)",
    "shifts": f"SELECT * FROM (VALUES {_values(rules.DEGREE_SHIFT.items())}) v(w, shift)",
    "factors": f"SELECT * FROM (VALUES {_values(rules.DEGREE_FACTOR.items())}) v(w, factor)",
    "posts": _posts(),
    "cleaned": f"SELECT *, {clean('text')} AS clean_text FROM posts",
    "prepared": f"""
        SELECT post_id, "timestamp", platform, {topic('clean_text')} AS topic, text, clean_text,
          list_filter(string_split_regex(clean_text, '\\s+'), lambda t: len(t) >= 2) AS tokens,
          {TARGET_LABEL} AS sentiment_label, {TARGET_SCORE} AS sentiment_score,
          likes, shares, user_followers, "user", value FROM cleaned""",
    **valence("val", "prepared", "post_id", "clean_text"),
    **valence("raw", "posts", "post_id", "text", raw=True),
    **polarity("pol", "prepared", "post_id", "clean_text"),
    "scored": f"""
        SELECT p.* EXCLUDE (sentiment_label, sentiment_score), v.compound AS sentiment_score,
          {label('v.compound')} AS sentiment_label
        FROM prepared p JOIN val v ON v.id = p.post_id""",
    "live": f"""
        SELECT p.*, r.compound AS sentiment_score, {label('r.compound', True)} AS sentiment_label
        FROM posts p JOIN raw r ON r.id = p.post_id""",
    "compared": f"""
        SELECT p.*, r.compound AS sentiment_score, {label('r.compound')} AS sentiment_label
        FROM posts p JOIN raw r ON r.id = p.post_id""",
    "docs": f"SELECT doc_id, source, text, {clean('text')} AS clean_text FROM documents",
    **valence("dval", "docs", "doc_id", "clean_text"),
    # A lexicon made from the words of all documents.
    "doc_lexicon": f"""
        SELECT w, ((n * 37 + len(w) * 11) % 81 - 40) / 10.0::DOUBLE AS valence, ((n * 53 + len(w) * 7) % 195 - 97) / 97.0::DOUBLE AS polarity,
          (n * 29 + len(w)) % 89 / 89.0::DOUBLE AS subjectivity
        FROM (SELECT w, count(*) AS n FROM (SELECT DISTINCT doc_id, unnest(regexp_extract_all(lower(text), {quoted(lx.WORD_PATTERN)})) AS w
              FROM documents) GROUP BY w) WHERE n >= 2 AND len(w) >= 2 AND (n + len(w)) % 2 = 0""",
    "turns": "SELECT conv_id || '-' || turn AS turn_id, conv_id, turn, role, text FROM conversations",
    **valence("tval", "documents", "doc_id", "text", lexicon="doc_lexicon"),
    **polarity("tpol", "turns", "turn_id", "text", lexicon="doc_lexicon"),
    **valence("cval", "turns", "turn_id", "text", lexicon="doc_lexicon"),
    "doc_words": f"""
        SELECT doc_id, w AS word FROM (SELECT doc_id, {words('text')} AS w FROM documents) WHERE w NOT IN ({STOPS})""",
    "doc_sets": "SELECT DISTINCT doc_id, word FROM doc_words",
    "pairs": "SELECT p.post_id, p.sentiment_label AS actual, s.sentiment_label AS predicted "
    "FROM prepared p JOIN scored s USING (post_id)",
    "counts": "SELECT actual, predicted, count(*) AS n FROM pairs GROUP BY ALL",
}

def query(body: str) -> str:
    """``body`` below the CTEs it needs, in order."""
    needed: dict[str, None] = {}

    def visit(sql: str) -> None:
        for name in re.findall(r"(?:FROM|JOIN)\s+(\w+)", sql):
            if name in CTES and name not in needed:
                visit(CTES[name])
                needed[name] = None

    visit(body)
    head = ",\n".join(f"{n} AS MATERIALIZED ({CTES[n]})" for n in needed)
    return f"WITH {head}\n{body}" if needed else body
