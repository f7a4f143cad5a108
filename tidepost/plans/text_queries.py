"""Scans, text, dates, filters and scoring."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidepost import rules
from tidepost.functions import labels, lexicon, text as tx, times
from tidepost.operators import classify, prepare, search, summaries, words
from tidepost.plans import sql as q
from tidepost.plans.registry import SECOND_SQL, Given, query, second
from tidepost.sources import files, listing, workdir

# ----- sources and sinks -------------------------------------------------------------------

TWEET_DATE = "EEE MMM dd HH:mm:ss 'UTC' yyyy"


@query(
    "scan_csv_posts",
    f"""SELECT target, post_id AS ids, "user", text, {SECOND_SQL} FROM posts""",
)
def scan_csv_posts(g: Given):
    path = workdir.fresh_path(g.spark, "csv-posts")
    files.write_csv_posts(
        g.posts.select(
            "target",
            F.col("post_id").alias("ids"),
            F.date_format("timestamp", TWEET_DATE).alias("date"),
            F.lit("NO_QUERY").alias("flag"),
            "user",
            "text",
        ),
        path,
        encoding="UTF-8",
    )
    scanned = files.read_csv_posts(g.spark, path, encoding="UTF-8", escaped=True)
    return scanned.select(
        "target", "ids", "user", "text", second_of(times.post_timestamp(F.col("date")))
    )


def second_of(ts):
    return F.date_format(ts, "yyyy-MM-dd HH:mm:ss").alias("timestamp")


@query("scan_limit", 'SELECT post_id, text FROM posts ORDER BY post_id LIMIT 1000')
def scan_limit(g: Given):
    return files.first_rows(g.posts.select("post_id", "text"), 1000, "post_id")


INGEST_SQL = rf"""
  SELECT doc_id::VARCHAR AS id, regexp_replace(concat_ws(' ', lang, text), '^\s+|\s+$', '', 'g') AS text, source AS author,
    (1700000000 + doc_id)::DOUBLE AS created_utc,
    strftime(to_timestamp(1700000000 + doc_id) AT TIME ZONE 'UTC', '%Y-%m-%d %H:%M:%S') AS "timestamp",
    '{listing.SITE}/r/' || lang || '/' || doc_id AS url, lang AS subreddit
  FROM documents WHERE regexp_matches(concat_ws(' ', lang, text), '\S')"""


def listings_of(g: Given):
    """Documents as listings with a second child of white space alone."""
    child = F.struct(
        F.col("doc_id").cast("string").alias("id"),
        F.col("lang").alias("title"),
        F.col("text").alias("selftext"),
        F.col("source").alias("author"),
        (F.lit(1_700_000_000) + F.col("doc_id")).cast("double").alias("created_utc"),
        F.concat(F.lit("/r/"), F.col("lang"), F.lit("/"), F.col("doc_id")).alias("permalink"),
        F.col("lang").alias("subreddit"),
    )
    empty = child.withField("title", F.lit("\n")).withField("selftext", F.lit(" \t"))
    children = F.array(F.struct(child.alias("data")), F.struct(empty.alias("data")))
    return g.documents.select(F.struct(children.alias("children")).alias("data"))


@query("ingest_listing", INGEST_SQL)
def ingest_listing(g: Given):
    """Written and read back as JSON."""
    path = workdir.fresh_path(g.spark, "listing")
    listings_of(g).write.json(path)
    flat = listing.flatten_listing(listing.read_listing(g.spark, path))
    return flat.withColumn("timestamp", F.date_format("timestamp", "yyyy-MM-dd HH:mm:ss"))


@query("json_props", "SELECT event_id, json_extract_string(props, '$.k')::BIGINT AS k FROM events")
def json_props(g: Given):
    return g.events.select("event_id", F.get_json_object("props", "$.k").cast("bigint").alias("k"))


@query(
    "search_posts",
    f"""SELECT post_id, text, {SECOND_SQL} FROM posts WHERE contains(lower(text), 'metaverse')
        ORDER BY posts."timestamp" DESC, post_id LIMIT 30""",
)
def search_posts(g: Given):
    found = listing.search_newest(g.posts, "metaverse", 30, key="post_id")
    return found.select("post_id", "text", second())


EXPORT_SQL = f"SELECT {SECOND_SQL}, platform, topic, text, sentiment_label, sentiment_score, likes, shares FROM prepared"


@query("export_csv", EXPORT_SQL)
def export_csv(g: Given):
    """Written as CSV and read back."""
    path = workdir.fresh_path(g.spark, "export")
    shown = g.prepared.withColumn("timestamp", F.date_format("timestamp", "yyyy-MM-dd HH:mm:ss"))
    files.export_csv(shown, path)
    return files.read_export(g.spark, path, files.existing_columns(shown).schema)


@query(
    "preview_rows",
    f"""SELECT {SECOND_SQL}, platform, topic, text, sentiment_label, sentiment_score, likes, shares
        FROM prepared ORDER BY prepared."timestamp", post_id LIMIT 200""",
)
def preview_rows(g: Given):
    posts = prepare.drop_blank_text(g.posts)
    return files.preview(posts, 200, prepare=prepare.prepare_posts).withColumn(
        "timestamp", F.date_format("timestamp", "yyyy-MM-dd HH:mm:ss")
    )


# ----- text --------------------------------------------------------------------------------


@query(
    "clean_text",
    f"""SELECT 'document' AS kind, doc_id AS id, {q.clean('text')} AS clean_text FROM documents
        UNION ALL SELECT 'page', page_id, {q.clean('html')} FROM pages
        UNION ALL SELECT 'turn', conv_id * 1000 + turn, {q.clean('text')} FROM conversations""",
)
def clean_text(g: Given):
    def part(kind, df, key, column):
        return df.select(F.lit(kind).alias("kind"), key.alias("id"), tx.clean_text(F.col(column)).alias("clean_text"))

    turns = F.col("conv_id") * 1000 + F.col("turn")
    return (
        part("document", g.documents, F.col("doc_id"), "text")
        .unionByName(part("page", g.table("pages"), F.col("page_id"), "html"))
        .unionByName(part("turn", g.table("conversations"), turns, "text"))
    )


@query(
    "tokens",
    r"""SELECT doc_id, array_to_string(tokens, ' ') AS tokens, len(tokens)::INT AS word_count FROM
        (SELECT doc_id, list_filter(string_split_regex(clean_text, '\s+'), lambda t: len(t) >= 2) AS tokens FROM docs)""",
)
def tokens(g: Given):
    split = g.docs.select("doc_id", tx.tokens(F.col("clean_text")).alias("t"))
    return split.select("doc_id", F.array_join("t", " ").alias("tokens"), F.size("t").alias("word_count"))


@query(
    "prepare_text",
    r"""SELECT doc_id, clean_text, array_to_string(list_filter(string_split_regex(clean_text, '\s+'),
          lambda t: len(t) >= 2), ' ') AS tokens FROM docs WHERE text IS NOT NULL""",
)
def prepare_text(g: Given):
    out = prepare.prepare_text(g.documents)
    return out.select("doc_id", "clean_text", F.array_join("tokens", " ").alias("tokens"))


@query("keywords_exploded", "SELECT doc_id, word FROM doc_words")
def keywords_exploded(g: Given):
    return words.keywords_exploded(g.documents, "doc_id")


@query(
    "stopword_filter",
    f"""SELECT word, count(*) AS n FROM (SELECT {q.words('text')} AS word FROM conversations)
        WHERE word NOT IN ({q.STOPS}) GROUP BY word""",
)
def stopword_filter(g: Given):
    """Stop words as a table: an anti join."""
    stops = g.spark.createDataFrame([(w,) for w in rules.STOP_WORDS], "word string")
    found = words.keywords_exploded(g.table("conversations"), stop_words=stops)
    return summaries.count_by(found, "word")


@query("topic_rules", f"SELECT doc_id, {q.topic('clean_text')} AS topic FROM docs")
def topic_rules(g: Given):
    return g.docs.select("doc_id", tx.topic_of(F.col("clean_text")).alias("topic"))


@query("topic_rules_whole_word", f"SELECT post_id, {q.topic('clean_text', True)} AS topic FROM cleaned")
def topic_rules_whole_word(g: Given):
    clean = tx.clean_text(F.col("text"))
    return g.posts.select("post_id", tx.topic_of(clean, whole_word=True).alias("topic"))


@query(
    "short_number",
    """SELECT event_id, CASE WHEN n >= 1000000 THEN printf('%.1fM', n / 1e6)
         WHEN n >= 1000 THEN printf('%.1fK', n / 1e3) ELSE n::VARCHAR END AS short
       FROM (SELECT event_id, event_id * event_id % 3000017 AS n FROM events)""",
)
def short_number(g: Given):
    n = F.col("event_id") * F.col("event_id") % 3000017
    return g.events.select("event_id", tx.short_number(n).alias("short"))


@query(
    "parse_post_date",
    f"""SELECT event_id, CASE WHEN event_id % 7 = 0 THEN '{rules.FALLBACK_TIMESTAMP}'
         ELSE strftime(ts, '%Y-%m-%d %H:%M:%S') END AS "timestamp", event_id % 7 = 0 AS unreadable FROM events""",
)
def parse_post_date(g: Given):
    """Times rendered as post dates (two zone names, every seventh unreadable), then parsed."""
    k = F.col("event_id") % 7
    date = (
        F.when(k == 0, F.lit("no date"))
        .when(k == 1, F.date_format("ts", "EEE MMM dd HH:mm:ss 'PDT' yyyy"))
        .otherwise(F.date_format("ts", TWEET_DATE))
    )
    dated = g.events.select("event_id", date.alias("date"))
    return dated.select(
        "event_id",
        second_of(times.post_timestamp(F.col("date"))),
        times.parse_post_date(F.col("date")).isNull().alias("unreadable"),
    )


@query(
    "epoch_roundtrip",
    """SELECT event_id, epoch(date_trunc('second', ts))::BIGINT AS seconds,
         strftime(ts, '%Y-%m-%d %H:%M:%S') AS "timestamp" FROM events""",
)
def epoch_roundtrip(g: Given):
    seconds = F.unix_timestamp(F.col("ts").cast("timestamp"))
    return g.events.select(
        "event_id", seconds.alias("seconds"), second_of(times.from_epoch(seconds))
    )


# ----- filters and projections -------------------------------------------------------------


@query("drop_blank_text", "SELECT doc_id, text FROM documents WHERE text IS NOT NULL AND trim(text) <> ''")
def drop_blank_text(g: Given):
    return prepare.drop_blank_text(g.documents).select("doc_id", "text")


@query(
    "train_rows",
    "SELECT post_id, clean_text, sentiment_label FROM prepared WHERE trim(clean_text) <> '' AND sentiment_label IS NOT NULL",
)
def train_rows(g: Given):
    return classify.train_rows(g.prepared).select("post_id", "clean_text", "sentiment_label")


@query("map_label", f"SELECT post_id, {q.TARGET_LABEL} AS sentiment_label FROM posts")
def map_label(g: Given):
    return g.posts.select("post_id", labels.target_label(F.col("target")).alias("sentiment_label"))


@query("map_score", f"SELECT post_id, {q.TARGET_SCORE} AS sentiment_score FROM posts")
def map_score(g: Given):
    return g.posts.select("post_id", labels.target_score(F.col("target")).alias("sentiment_score"))


@query(
    "filter_sentiment",
    "SELECT post_id, sentiment_label FROM scored WHERE lower(sentiment_label) IN ('positive', 'neutral')",
)
def filter_sentiment(g: Given):
    kept = prepare.keep_where(g.scored, search.has_sentiment(["POSITIVE", "neutral"]))
    return kept.select("post_id", "sentiment_label")


@query("search_keyword", "SELECT post_id, text FROM posts WHERE regexp_matches(text, '(?i)wast.|excite')")
def search_keyword(g: Given):
    return search.filter_keyword(g.posts, "wast.|excite").select("post_id", "text")


@query("filter_topic", "SELECT post_id, topic FROM prepared WHERE topic IN ('Technology', 'Health')")
def filter_topic(g: Given):
    return search.filter_topics(g.prepared, ["Technology", "Health"]).select("post_id", "topic")


@query("distinct_topics", "SELECT DISTINCT topic FROM prepared ORDER BY topic")
def distinct_topics(g: Given):
    return search.distinct_topics(g.prepared)


PREPARED_SQL = f"""SELECT post_id, {SECOND_SQL}, platform, topic, text, clean_text,
  array_to_string(tokens, ' ') AS tokens, len(tokens)::INT AS word_count, sentiment_label, sentiment_score,
  likes, shares, user_followers, "user" FROM """


def _prepared_columns(df):
    return df.select("post_id", *prepare.PREPARED_COLUMNS).withColumns(
        {
            "timestamp": F.date_format("timestamp", "yyyy-MM-dd HH:mm:ss"),
            "tokens": F.array_join("tokens", " "),
        }
    )


@query("prepare_posts", PREPARED_SQL + "prepared")
def prepare_posts(g: Given):
    return _prepared_columns(g.prepared)


@query("pipeline_dataset", PREPARED_SQL + "prepared")
def pipeline_dataset(g: Given):
    return _prepared_columns(prepare.run_pipeline(g.posts, "dataset"))


@query("pipeline_valence", PREPARED_SQL + "scored")
def pipeline_valence(g: Given):
    return _prepared_columns(prepare.run_pipeline(g.posts, "valence"))


@query("derive_engagement", "SELECT post_id, likes, shares, user_followers FROM posts")
def derive_engagement(g: Given):
    return g.posts.select("post_id", "likes", "shares", "user_followers")


@query(
    "engagement_points",
    "SELECT likes, shares, user_followers, sentiment_label, platform, topic FROM prepared",
)
def engagement_points(g: Given):
    return summaries.engagement_points(g.prepared)


@query(
    "engagement_bins",
    """SELECT (likes // 250)::INT AS likes_bin, (shares // 100)::INT AS shares_bin, sentiment_label,
         count(*) AS n, max(user_followers) AS max_followers FROM prepared GROUP BY ALL""",
)
def engagement_bins(g: Given):
    return summaries.engagement_bins(g.prepared)


# ----- scoring -----------------------------------------------------------------------------


@query("score_valence", "SELECT id AS doc_id, compound AS score FROM dval")
def score_valence(g: Given):
    return g.docs.select("doc_id", lexicon.valence_score(F.col("clean_text")).alias("score"))


@query("score_polarity", "SELECT id AS post_id, polarity FROM pol")
def score_polarity(g: Given):
    return g.prepared.select("post_id", lexicon.polarity_score(F.col("clean_text")).alias("polarity"))


@query("score_subjectivity", "SELECT id AS post_id, subjectivity FROM pol")
def score_subjectivity(g: Given):
    parts = lexicon.polarity_parts(F.col("clean_text"))
    return g.prepared.select("post_id", parts["subjectivity"].alias("subjectivity"))


@query("valence_shares", "SELECT id AS post_id, compound, positive, neutral, negative FROM val")
def valence_shares(g: Given):
    parts = g.prepared.select("post_id", lexicon.valence_shares(F.col("clean_text")).alias("v"))
    return parts.select("post_id", "v.*")


@query("analyse_valence", "SELECT post_id, sentiment_score, sentiment_label FROM scored")
def analyse_valence(g: Given):
    return g.scored.select("post_id", "sentiment_score", "sentiment_label")


@query(
    "analyse_polarity",
    f"SELECT id AS post_id, polarity AS sentiment_score, {q.label('polarity')} AS sentiment_label FROM pol",
)
def analyse_polarity(g: Given):
    out = prepare.score_sentiment(g.prepared, engine="polarity")
    return out.select("post_id", "sentiment_score", "sentiment_label")


# values around both thresholds
AROUND = "(event_id % 41 - 20) / 200.0"


@query("classify_strict", f"SELECT event_id, {q.label(AROUND)} AS label FROM events")
def classify_strict(g: Given):
    s = (F.col("event_id") % 41 - 20) / 200.0
    return g.events.select("event_id", labels.classify(s).alias("label"))


@query("classify_inclusive", f"SELECT event_id, {q.label(AROUND, True)} AS label FROM events")
def classify_inclusive(g: Given):
    s = (F.col("event_id") % 41 - 20) / 200.0
    return g.events.select("event_id", labels.classify(s, inclusive=True).alias("label"))


ENGINES_SQL = f"""SELECT id AS post_id, 'valence' AS engine, compound AS score, {q.label('compound')} AS label FROM val
  UNION ALL SELECT id, 'polarity', polarity, {q.label('polarity')} FROM pol"""


@query("multi_engine_scores", ENGINES_SQL)
def multi_engine_scores(g: Given):
    return prepare.engines_long(g.prepared).drop("details")


@query(
    "consensus",
    f"""SELECT post_id, engine_count, consensus_score, {q.label('consensus_score')} AS consensus_label FROM
        (SELECT v.id AS post_id, 2 AS engine_count, round((v.compound + p.polarity) / 2, 4) AS consensus_score
         FROM val v JOIN pol p USING (id))""",
)
def consensus(g: Given):
    out = prepare.with_consensus(prepare.with_engines(g.prepared))
    return out.select("post_id", "engine_count", "consensus_score", "consensus_label")


def exclamation_rate(texts):
    """Stands for a third-party scorer: exclamation marks per character."""
    return texts.str.count("!") / texts.str.len()


@query(
    "custom_scorer",
    "SELECT post_id, round((len(text) - len(replace(text, '!', ''))) / len(text), 9) AS sentiment_score FROM posts",
)
def custom_scorer(g: Given):
    out = prepare.score_with(g.posts.select("post_id", "text"), exclamation_rate)
    return out.select("post_id", F.round("sentiment_score", 9).alias("sentiment_score"))


@query(
    "lexicon_hits",
    f"""SELECT doc_id, token, count(*) AS n, round(sum(valence), 4) AS valence_sum FROM
          (SELECT doc_id, unnest(regexp_extract_all(lower(text), {q.quoted(lexicon.WORD_PATTERN)})) AS token FROM documents)
        JOIN lexicon ON token = w GROUP BY ALL""",
)
def lexicon_hits(g: Given):
    return words.lexicon_hits(g.documents, words.lexicon_frame(g.spark), key="doc_id")
