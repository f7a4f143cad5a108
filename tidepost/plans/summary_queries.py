"""Dashboard, search, keyword, graph, rolling and comparison queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidepost import rules
from tidepost.functions import text as tx
from tidepost.operators import entities, evaluation, prepare, rolling, search, summaries, words
from tidepost.plans import sql as q
from tidepost.plans.registry import SECOND_SQL, Given, query, second
from tidepost.streaming.live import score_live

LABEL_COUNTS = ", ".join(
    f"count(*) FILTER (WHERE sentiment_label = '{x}') AS {x.lower()}" for x in rules.LABELS
)

# ----- dashboard ---------------------------------------------------------------------------


@query(
    "sentiment_distribution",
    """SELECT sentiment_label, count(*) AS n, round(count(*) / sum(count(*)) OVER (), 6) AS share
       FROM scored GROUP BY sentiment_label""",
)
def sentiment_distribution(g: Given):
    return summaries.sentiment_distribution(g.scored)


@query(
    "daily_trend",
    """SELECT strftime("timestamp", '%Y-%m-%d') AS day, sentiment_label, count(*) AS n FROM scored GROUP BY ALL""",
)
def daily_trend(g: Given):
    return summaries.daily_trend(g.scored).withColumn("day", F.date_format("day", "yyyy-MM-dd"))


@query("platform_breakdown", "SELECT platform, sentiment_label, count(*) AS n FROM scored GROUP BY ALL")
def platform_breakdown(g: Given):
    return summaries.count_by(g.scored, "platform", "sentiment_label")


def _bins(bins: int) -> str:
    width = 2.0 / bins
    return (
        f"greatest(least(floor((sentiment_score + 1.0::DOUBLE) / {width}::DOUBLE)::INT, {bins - 1}), 0) AS bin"
    )


@query(
    "score_histogram",
    f"""SELECT bin, count(*) AS n, round(-1.0 + bin * 0.05::DOUBLE, 6) AS bin_start
        FROM (SELECT {_bins(40)} FROM scored) GROUP BY bin""",
)
def score_histogram(g: Given):
    return summaries.histogram(g.scored, "sentiment_score")


@query("topic_sentiment_pivot", f"SELECT topic, {LABEL_COUNTS} FROM scored GROUP BY topic")
def topic_sentiment_pivot(g: Given):
    return summaries.label_pivot(g.scored)


@query(
    "topic_stats",
    "SELECT topic, count(*) AS n, round(avg(sentiment_score), 6) AS avg_score FROM scored GROUP BY topic",
)
def topic_stats(g: Given):
    return summaries.topic_stats(g.scored)


@query(
    "topic_breakdown",
    """SELECT topic AS "Topic", count(*) AS "Posts", round(avg(sentiment_score), 6) AS "Avg Score",
         sum(likes)::BIGINT AS "Total Likes" FROM scored GROUP BY topic""",
)
def topic_breakdown(g: Given):
    return summaries.topic_breakdown(g.scored)


HEAT_SQL = """SELECT d AS day_index, {days}[d + 1] AS day, h AS hour, count(p.post_id) AS n
  FROM (SELECT (i // 24)::INT AS d, (i % 24)::INT AS h FROM range(168) r(i))
  LEFT JOIN posts p ON isodow(p."timestamp") - 1 = d AND hour(p."timestamp") = h GROUP BY ALL""".replace(
    "{days}", q.array(rules.WEEKDAYS)
)


@query("hour_heatmap", HEAT_SQL)
def hour_heatmap(g: Given):
    return summaries.hour_heatmap(g.posts)


@query(
    "hour_heatmap_wide",
    "SELECT day_index, day, "
    + ", ".join(f"max(CASE WHEN hour = {h} THEN n END) AS h{h:02d}" for h in range(24))
    + f" FROM ({HEAT_SQL}) GROUP BY day_index, day",
)
def hour_heatmap_wide(g: Given):
    return summaries.hour_heatmap_wide(g.posts)


@query(
    "dashboard_kpis",
    f"""SELECT *, 100 * positive // greatest(total, 1) AS positive_pct, 100 * negative // greatest(total, 1) AS negative_pct,
          100 * neutral // greatest(total, 1) AS neutral_pct, round(positive / greatest(negative, 1), 6) AS pos_neg_ratio
        FROM (SELECT count(*) AS total, {LABEL_COUNTS}, round(coalesce(avg(sentiment_score), 0), 6) AS avg_score,
          count(DISTINCT platform) AS platforms, count(DISTINCT topic) AS topics FROM scored)""",
)
def dashboard_kpis(g: Given):
    return summaries.dashboard_kpis(g.scored)


@query("label_counts", "SELECT sentiment_label, count(*) AS n FROM prepared GROUP BY ALL")
def label_counts(g: Given):
    return summaries.count_by(g.prepared, "sentiment_label")


@query(
    "dataset_profile",
    """SELECT count(*) AS rows, count(DISTINCT topic) AS topics,
         strftime(min("timestamp"), '%Y-%m-%d %H:%M:%S') AS first_post,
         strftime(max("timestamp"), '%Y-%m-%d %H:%M:%S') AS last_post FROM prepared""",
)
def dataset_profile(g: Given):
    out = summaries.dataset_profile(g.prepared)
    return out.withColumns({c: F.date_format(c, "yyyy-MM-dd HH:mm:ss") for c in ("first_post", "last_post")})


def _profile_sql() -> str:
    columns = [("doc_id", "bigint"), ("text", "string"), ("lang", "string"), ("source", "string"), ("n_chars", "bigint")]
    return " UNION ALL ".join(
        f"SELECT '{c}' AS \"column\", '{t}' AS type, count({c}) AS non_null, min(substr({c}::VARCHAR, 1, 80)) AS sample FROM documents"
        for c, t in columns
    )


@query("column_profile", _profile_sql())
def column_profile(g: Given):
    return summaries.column_profile(g.documents)


@query(
    "live_kpis",
    f"""SELECT platform, count(*) AS posts, round(avg(sentiment_score), 6) AS avg_score, {LABEL_COUNTS}
        FROM live GROUP BY platform""",
)
def live_kpis(g: Given):
    return summaries.live_kpis(score_live(g.posts), "platform")


@query(
    "metrics_long",
    """SELECT topic, 'n' AS "Metric", n AS "Score" FROM (SELECT topic, count(*)::DOUBLE AS n FROM scored GROUP BY topic)
       UNION ALL SELECT topic, 'avg_score', round(avg(sentiment_score), 6) FROM scored GROUP BY topic""",
)
def metrics_long(g: Given):
    wide = summaries.topic_stats(g.scored).withColumn("n", F.col("n").cast("double"))
    return summaries.long_form(wide, ["topic"], ["n", "avg_score"])


# ----- search and sorting ------------------------------------------------------------------


@query(
    "search_summary",
    f"""SELECT count(*) AS results, {LABEL_COUNTS} FROM scored
        WHERE regexp_matches(text, '(?i)report') AND topic IN ('Technology', 'Education', 'General')""",
)
def search_summary(g: Given):
    found = search.search(g.scored, "report", ["Technology", "Education", "General"])
    return summaries.result_summary(found)


SORT_COLUMNS = "post_id, sentiment_score, likes, shares"


def _sort_query(key: str, choice: str, order: str):
    @query(
        key,
        f"""SELECT {SECOND_SQL}, {SORT_COLUMNS} FROM scored ORDER BY {order} NULLS LAST, post_id LIMIT 20""",
    )
    def run(g: Given):
        if search.sort_column(choice) in g.posts.columns:  # stored: only the rows shown are scored
            top = search.sorted_posts(prepare.drop_blank_text(g.posts), choice)
            top = prepare.score_sentiment(prepare.prepare_posts(top))
        else:
            top = search.sorted_posts(g.scored, choice)
        return top.select(second(), *SORT_COLUMNS.split(", "))

    return run


sort_recent = _sort_query("sort_recent", "Most Recent", 'scored."timestamp" DESC')
sort_highest = _sort_query("sort_highest", "Highest Score", "sentiment_score DESC")
sort_lowest = _sort_query("sort_lowest", "Lowest Score", "sentiment_score")
sort_liked = _sort_query("sort_liked", "Most Liked", "likes DESC")
sort_shared = _sort_query("sort_shared", "Most Shared", "shares DESC")


@query(
    "live_feed",
    f"""SELECT post_id, "user", text, sentiment_label, sentiment_score, strftime("timestamp", '%H:%M:%S') AS clock
        FROM live ORDER BY "timestamp" DESC, post_id LIMIT 10""",
)
def live_feed(g: Given):
    feed = score_live(search.live_feed(g.posts))
    return feed.select("post_id", "user", "text", "sentiment_label", "sentiment_score", "clock")


# ----- words -------------------------------------------------------------------------------


@query("top_keywords", "SELECT word, count(*) AS n FROM doc_words GROUP BY word ORDER BY n DESC, word LIMIT 20")
def top_keywords(g: Given):
    return words.top_keywords(g.documents, 20)


@query(
    "keywords_by_sentiment",
    f"""SELECT * FROM (SELECT sentiment_label, word, n,
          row_number() OVER (PARTITION BY sentiment_label ORDER BY n DESC, word)::INT AS rank
        FROM (SELECT sentiment_label, word, count(*) AS n
              FROM (SELECT sentiment_label, {q.words('text')} AS word FROM scored WHERE sentiment_label <> 'Neutral')
              WHERE word NOT IN ({q.STOPS}) GROUP BY ALL)) WHERE rank <= 12""",
)
def keywords_by_sentiment(g: Given):
    return words.keywords_by_sentiment(g.scored, 12)


def _cloud_sql(source: str) -> str:
    return f"""SELECT word, n, round(n / max(n) OVER (), 6) AS weight FROM
      (SELECT word, count(*) AS n FROM ({source}) WHERE word NOT IN ({q.STOPS})
       GROUP BY word ORDER BY n DESC, word LIMIT 120)"""


@query("cloud_frequencies", _cloud_sql(f"SELECT {q.words('text')} AS word FROM documents"))
def cloud_frequencies(g: Given):
    return words.cloud_frequencies(g.documents, 120)


@query(
    "cloud_frequencies_positive",
    _cloud_sql(f"SELECT {q.words('text')} AS word FROM scored WHERE sentiment_label = 'Positive'"),
)
def cloud_frequencies_positive(g: Given):
    return words.cloud_frequencies(g.scored, 120, "positive")


@query(
    "cloud_frequencies_negative",
    _cloud_sql(f"SELECT {q.words('text')} AS word FROM scored WHERE sentiment_label = 'Negative'"),
)
def cloud_frequencies_negative(g: Given):
    return words.cloud_frequencies(g.scored, 120, "negative")


@query("doc_frequency", "SELECT word, count(*) AS size FROM doc_sets GROUP BY word")
def doc_frequency(g: Given):
    return words.document_frequency(g.documents)


PHRASE_BREAK = r"\||\n|\b(?:" + "|".join(rules.STOP_WORDS) + r")\b"


@query(
    "trending_phrases",
    f"""SELECT phrase, n, '#' || replace(phrase, ' ', '') AS tag FROM
        (SELECT phrase, count(*) AS n FROM
          (SELECT trim(regexp_replace(part, '\\s+', ' ', 'g')) AS phrase FROM
            (SELECT unnest(string_split_regex(regexp_replace(lower(text), '[^a-z\\s]+', '|', 'g'), {q.quoted(PHRASE_BREAK)})) AS part FROM documents))
         WHERE len(phrase) >= {tx.MIN_PHRASE_LENGTH} GROUP BY phrase ORDER BY n DESC, phrase LIMIT 6)""",
)
def trending_phrases(g: Given):
    return words.trending_phrases(g.documents)


NODES_SQL = "SELECT word, count(*) AS size FROM doc_sets GROUP BY word ORDER BY size DESC, word LIMIT 40"


@query("cooc_nodes", f"SELECT word, size, least(greatest(size * 2, 10), 50) AS display_size FROM ({NODES_SQL})")
def cooc_nodes(g: Given):
    return words.cooccurrence_nodes(g.documents, 40)


@query(
    "cooc_edges",
    f"""SELECT a.word AS w1, b.word AS w2, count(*) AS weight
        FROM (SELECT * FROM doc_sets WHERE word IN (SELECT word FROM ({NODES_SQL}))) a
        JOIN (SELECT * FROM doc_sets WHERE word IN (SELECT word FROM ({NODES_SQL}))) b
          ON a.doc_id = b.doc_id AND a.word < b.word
        GROUP BY ALL HAVING count(*) > 1""",
)
def cooc_edges(g: Given):
    return words.cooccurrence_edges(g.documents, 40)


# ----- rolling bands -----------------------------------------------------------------------

ROLLING_SQL = """
  SELECT post_id, platform, value, round(m, 6) AS rolling_mean, round(s, 6) AS rolling_std,
    round(m + 2 * s, 6) AS upper_band, round(m - 2 * s, 6) AS lower_band,
    total > 2 AND (value > m + 2 * s OR value < m - 2 * s) AS is_anomaly
  FROM (SELECT post_id, platform, value, count(*) OVER (PARTITION BY platform) AS total,
          avg(value) OVER w AS m, coalesce(stddev_samp(value) OVER w, 0) AS s FROM posts
        WINDOW w AS (PARTITION BY platform ORDER BY "timestamp", post_id ROWS BETWEEN 9 PRECEDING AND CURRENT ROW))"""


def _series(g: Given):
    return g.posts.select("post_id", "timestamp", "platform", "value")


@query("rolling_stats", ROLLING_SQL)
def rolling_stats(g: Given):
    return rolling.rolling_stats(_series(g), value="value", digits=6).drop("timestamp")


EXCLUDING_SQL = """SELECT post_id, platform, value, round(coalesce(m, value), 6) AS rolling_mean, round(coalesce(s, 0), 6) AS rolling_std,
         coalesce(s, 0) > 0 AND (value > m + 2 * s OR value < m - 2 * s) AS is_anomaly
       FROM (SELECT post_id, platform, value, avg(value) OVER w AS m, stddev_samp(value) OVER w AS s FROM posts
         WINDOW w AS (PARTITION BY platform ORDER BY "timestamp", post_id ROWS BETWEEN 10 PRECEDING AND 1 PRECEDING))"""


@query("rolling_stats_excluding_current", EXCLUDING_SQL)
def rolling_stats_excluding_current(g: Given):
    out = rolling.rolling_stats(_series(g), value="value", digits=6, exclude_current=True)
    return out.drop("timestamp", "upper_band", "lower_band")


@query("anomalies", f"SELECT * FROM ({ROLLING_SQL}) WHERE is_anomaly")
def anomalies(g: Given):
    return rolling.anomalies(_series(g), value="value", digits=6).drop("timestamp")


# ----- comparison --------------------------------------------------------------------------

PAIR = ("AI technology", "cryptocurrency")


def _tagged_sql(entity: str) -> str:
    return f"""SELECT s.*, '{entity}' AS entity FROM compared s WHERE contains(lower(text), '{entity.lower()}')"""


def _named(g: Given, names):
    """Tagged, then scored on raw text with strict thresholds."""
    return score_live(entities.tag_entities(g.posts, names), inclusive=False)


BOTH_SQL = " UNION ALL ".join(_tagged_sql(e) for e in PAIR)


@query(
    "entity_union",
    f"""SELECT post_id, entity, sentiment_score, sentiment_label FROM (
          (SELECT * FROM ({_tagged_sql('technology')}) ORDER BY "timestamp" DESC, post_id LIMIT 50) UNION ALL
          (SELECT * FROM ({_tagged_sql('report')}) ORDER BY "timestamp" DESC, post_id LIMIT 50))""",
)
def entity_union(g: Given):
    """The newest fifty posts of either side; a post that names both is there twice."""
    tagged = entities.tag_entities(g.posts, ["technology", "report"])
    newest = score_live(entities.latest_per_entity(tagged), inclusive=False)
    return newest.select("post_id", "entity", "sentiment_score", "sentiment_label")


COMPARE_SQL = f"""SELECT e.entity, count(post_id) AS volume, round(coalesce(avg(sentiment_score), 0), 6) AS avg_score,
    count(*) FILTER (WHERE sentiment_label = 'Positive') AS positive,
    round(coalesce(100.0 * count(*) FILTER (WHERE sentiment_label = 'Positive') / nullif(count(post_id), 0), 0), 4) AS positive_pct
  FROM (SELECT unnest({q.array((*PAIR, 'no such name'))}) AS entity) e LEFT JOIN ({BOTH_SQL}) p USING (entity) GROUP BY ALL"""


@query("entity_compare", COMPARE_SQL)
def entity_compare(g: Given):
    named = [*PAIR, "no such name"]
    return entities.entity_compare(_named(g, named), named)


@query(
    "entity_winner",
    f"""SELECT *, CASE WHEN score_a > score_b + {rules.WIN_MARGIN} THEN '{PAIR[0]}'
          WHEN score_b > score_a + {rules.WIN_MARGIN} THEN '{PAIR[1]}' ELSE {q.quoted(entities.TIE)} END AS winner
        FROM (SELECT max(CASE WHEN entity = '{PAIR[0]}' THEN avg_score END) AS score_a,
                max(CASE WHEN entity = '{PAIR[1]}' THEN avg_score END) AS score_b, sum(volume)::BIGINT AS posts
              FROM ({COMPARE_SQL}))""",
)
def entity_winner(g: Given):
    compared = entities.entity_compare(_named(g, PAIR), PAIR)
    return entities.entity_winner(compared, *PAIR)


@query(
    "entity_histogram",
    f"""SELECT entity, bin, count(*) AS n, round(-1.0 + bin * 0.1::DOUBLE, 6) AS bin_start
        FROM (SELECT entity, {_bins(20)} FROM ({BOTH_SQL})) GROUP BY ALL""",
)
def entity_histogram(g: Given):
    return entities.entity_histogram(_named(g, PAIR))


# ----- agreement of the valence engine with the dataset labels -------------------------------


def _pairs(g: Given):
    """Dataset label and valence label of each post, from one row: no join."""
    from tidepost.functions import labels, lexicon

    predicted = labels.classify(lexicon.valence_score(F.col("clean_text")))
    return g.prepared.select("post_id", F.col("sentiment_label").alias("actual"), predicted.alias("predicted"))


@query(
    "confusion_percent",
    """SELECT actual, predicted, n, round(100.0 * n / sum(n) OVER (PARTITION BY actual), 1) AS pct FROM counts""",
)
def confusion_percent(g: Given):
    return evaluation.confusion_percent(evaluation.confusion_counts(_pairs(g)))


@query(
    "confusion_matrix",
    'SELECT actual AS "Actual", '
    + ", ".join(f"count(*) FILTER (WHERE predicted = '{x}') AS \"Pred_{x}\"" for x in rules.LABELS)
    + " FROM pairs GROUP BY actual",
)
def confusion_matrix(g: Given):
    return evaluation.confusion_matrix(evaluation.confusion_counts(_pairs(g)), rules.LABELS)


CLASS_SQL = """
  SELECT label, tp / greatest(tp + fp, 1) AS p, tp / greatest(tp + fn, 1) AS r, tp + fn AS support, tp FROM (
    SELECT label, count(*) FILTER (WHERE actual = label AND predicted = label) AS tp,
      count(*) FILTER (WHERE actual <> label AND predicted = label) AS fp,
      count(*) FILTER (WHERE actual = label AND predicted <> label) AS fn
    FROM pairs, (SELECT unnest(['Positive', 'Negative', 'Neutral']) AS label) GROUP BY label)"""


@query(
    "class_metrics",
    f"""SELECT label, round_even(p, 4) AS precision, round_even(r, 4) AS recall,
          round_even(2 * p * r / greatest(p + r, 1e-9), 4) AS f1, support FROM ({CLASS_SQL})""",
)
def class_metrics(g: Given):
    return evaluation.class_metrics(evaluation.confusion_counts(_pairs(g)), rules.LABELS)


@query(
    "overall_metrics",
    f"""SELECT round_even(sum(tp) / sum(support), 4) AS accuracy,
          round_even(sum(p * support) / sum(support), 4) AS weighted_precision,
          round_even(sum(r * support) / sum(support), 4) AS weighted_recall,
          round_even(sum(CASE WHEN p + r > 0 THEN 2 * p * r / (p + r) ELSE 0 END * support) / sum(support), 4) AS weighted_f1,
          sum(support)::BIGINT AS test_count FROM ({CLASS_SQL})""",
)
def overall_metrics(g: Given):
    return evaluation.overall_metrics(evaluation.confusion_counts(_pairs(g)))
