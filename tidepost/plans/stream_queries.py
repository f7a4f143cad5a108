"""Streams over the given tables, drained to the end so that they can be compared with SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidepost import rules
from tidepost.plans import sql as q
from tidepost.plans.registry import Given, query
from tidepost.functions import text as tx
from tidepost.operators import entities
from tidepost.plans.summary_queries import EXCLUDING_SQL, PAIR, PHRASE_BREAK, ROLLING_SQL
from tidepost.plans.text_queries import INGEST_SQL, listings_of
from tidepost.sources import listing
from tidepost.sources.workdir import fresh_path
from tidepost.streaming import live, rings, sinks, trending

SLICES = 3
#: Bytes of text to a file of listings, so that a task has no more however many there are.
LISTING_BYTES = 32 << 20


def _slices(df, ts):
    """Time slices of about equal size, oldest first; rows without a time come with the first."""
    micros = F.unix_micros(ts)
    shares = [i / SLICES for i in range(1, SLICES)]
    cuts = df.agg(F.percentile_approx(micros, shares, F.lit(100))).first()[0] or []
    for low, high in zip([None, *cuts], [*cuts, None], strict=True):
        part = df if low is None else df.filter(micros >= low)
        first = F.lit(low is None) & micros.isNull()
        yield part if high is None else part.filter((micros < high) | first)


def _arriving(g: Given, replayed: bool = False, slices=_slices):
    """A folder of event files, and steps that let one time slice after the other arrive in it; with
    ``replayed`` each brings the one before along once more."""
    landing = fresh_path(g.spark, "landing")
    first, *later = slices(g.events, F.col("ts").cast("timestamp"))
    first.write.parquet(landing)

    def steps():
        yield
        for before, part in zip([first, *later], later):
            arriving = part.unionByName(before) if replayed else part
            arriving.write.mode("append").parquet(landing)
            yield

    return landing, steps()


@query("stream_scored", "SELECT post_id, sentiment_score, sentiment_label FROM live")
def stream_scored(g: Given):
    landing, steps = _arriving(g)
    scored = live.score_live(live.stream_posts(g.spark, landing))
    return sinks.drain(scored.select("post_id", "sentiment_score", "sentiment_label"), "scored", steps=steps)


@query(
    "stream_alerts",
    f"""SELECT post_id, sentiment_score, CASE WHEN sentiment_score > 0 THEN 'High Positive' ELSE 'High Negative' END AS alert,
          CASE WHEN len(text) > 50 THEN substr(text, 1, 50) || '...' ELSE text END AS excerpt
        FROM live WHERE abs(sentiment_score) >= {rules.ALERT_LEVEL}""",
)
def stream_alerts(g: Given):
    landing, steps = _arriving(g)
    found = live.alerts(live.score_live(live.stream_posts(g.spark, landing)))
    return sinks.drain(found.select("post_id", "sentiment_score", "alert", "excerpt"), "alerts", steps=steps)


@query(
    "stream_hourly",
    """SELECT strftime(date_trunc('hour', "timestamp"), '%Y-%m-%d %H:%M:%S') AS window_start, count(*) AS posts,
         round(avg(sentiment_score), 6) AS avg_score,
         count(*) FILTER (WHERE sentiment_label = 'Positive') AS positive,
         count(*) FILTER (WHERE sentiment_label = 'Negative') AS negative,
         count(*) FILTER (WHERE sentiment_label = 'Neutral') AS neutral
       FROM live GROUP BY 1""",
)
def stream_hourly(g: Given):
    landing, steps = _arriving(g)
    scored = live.score_live(live.stream_posts(g.spark, landing))
    totals = sinks.drain_update(live.windowed_totals(scored), "hourly", ["window_start"], steps=steps)
    return totals.select(
        F.date_format("window_start", "yyyy-MM-dd HH:mm:ss").alias("window_start"),
        "posts",
        F.round(F.col("score_sum") / F.col("posts"), 6).alias("avg_score"),
        "positive",
        "negative",
        "neutral",
    )


@query("stream_anomalies", f"SELECT * FROM ({ROLLING_SQL}) WHERE is_anomaly")
def stream_anomalies(g: Given):
    """Posts arrive in time slices; the stream is stopped after each and goes on from its checkpoint,
    with the last rows of each series as its state."""
    landing, steps = _arriving(g)
    bands = rings.rolling_bands(live.stream_posts(g.spark, landing), "platform", "value")
    rows = rings.newest_versions(sinks.drain(bands, "bands", steps=steps), "platform", "post_id")
    shown = {c: F.round(c, 6) for c in ("rolling_mean", "rolling_std", "upper_band", "lower_band")}
    return rows.filter("is_anomaly").withColumns(shown).drop("timestamp")


def _streamed_bands(g: Given, **options):
    posts = g.posts.select("post_id", "timestamp", "platform", "value")
    landing = fresh_path(g.spark, "landing")
    bands = sinks.RollingBands(
        fresh_path(g.spark, "bands"), "platform", "value", "timestamp", "post_id", digits=6, **options
    )
    for part in _slices(posts, F.col("timestamp")):
        part.write.mode("append").parquet(landing)
        bands.run_available(live.stream_table(g.spark, landing))
    return bands.result(g.spark)


@query("stream_anomalies_excluding_current", f"SELECT * FROM ({EXCLUDING_SQL}) WHERE is_anomaly")
def stream_anomalies_excluding_current(g: Given):
    found = _streamed_bands(g, exclude_current=True).filter("is_anomaly")
    return found.drop("timestamp", "upper_band", "lower_band")


@query(
    "stream_bands_twenty",
    """SELECT post_id, platform, value, round(m, 6) AS rolling_mean, round(s, 6) AS rolling_std,
         total > 2 AND (value > m + 2 * s OR value < m - 2 * s) AS is_anomaly
       FROM (SELECT post_id, platform, value, count(*) OVER (PARTITION BY platform) AS total,
               avg(value) OVER w AS m, coalesce(stddev_samp(value) OVER w, 0) AS s FROM posts
             WINDOW w AS (PARTITION BY platform ORDER BY "timestamp", post_id ROWS BETWEEN 19 PRECEDING AND CURRENT ROW))""",
)
def stream_bands_twenty(g: Given):
    return _streamed_bands(g, window=20).drop("timestamp", "upper_band", "lower_band")


@query(
    "stream_entities",
    f"""SELECT entity, count(*) AS volume, round(avg(sentiment_score), 6) AS avg_score,
          count(*) FILTER (WHERE sentiment_label = 'Positive') AS positive
        FROM (SELECT *, '{PAIR[0]}' AS entity FROM compared WHERE contains(lower(text), {q.quoted(PAIR[0].lower())})
              UNION ALL SELECT *, '{PAIR[1]}' FROM compared WHERE contains(lower(text), {q.quoted(PAIR[1].lower())}))
        GROUP BY entity""",
)
def stream_entities(g: Given):
    landing, steps = _arriving(g)
    scored = live.score_live(live.stream_posts(g.spark, landing), inclusive=False)
    totals = sinks.drain_complete(live.entity_totals(scored, PAIR), "entities", steps=steps)
    return totals.select(
        "entity", "volume", F.round(F.col("score_sum") / F.col("volume"), 6).alias("avg_score"), "positive"
    )


@query("stream_dedup", "SELECT post_id, platform, text FROM posts")
def stream_dedup(g: Given):
    """Every post delivered by two sources and, but for the last slice, once more in the next; kept once."""
    landing, steps = _arriving(g, replayed=True)
    twice = live.stream_posts(g.spark, landing).unionByName(live.stream_posts(g.spark, landing))
    kept = live.deduplicated(twice)
    return sinks.drain(kept.select("post_id", "platform", "text"), "dedup", steps=steps)


def _thirds(df, ts):
    """Slices of equal time span, oldest first; rows without a time come with the first."""
    micros = F.unix_micros(ts)
    low, high = df.agg(F.min(micros), F.max(micros)).first()
    cuts = [low + (high - low) * k // SLICES for k in range(1, SLICES)]
    for a, b in zip([None, *cuts], [*cuts, None], strict=True):
        part = df if a is None else df.filter(micros >= a)
        yield part if b is None else part.filter((micros < b) | (F.lit(a is None) & micros.isNull()))


NEWEST_SQL = " UNION ALL ".join(
    f"""SELECT {k + 1} AS slice, '{e}' AS entity, * FROM (SELECT count(*) AS volume, round(avg(sentiment_score), 6) AS avg_score,
          count(*) FILTER (WHERE sentiment_label = 'Positive') AS positive FROM
          (SELECT * FROM compared, (SELECT min(epoch_us("timestamp")) AS a, max(epoch_us("timestamp")) AS b FROM posts)
           WHERE contains(lower(text), {q.quoted(e.lower())}) AND ({k} = {SLICES - 1} OR epoch_us("timestamp") < a + (b - a) * {k + 1} // {SLICES})
           QUALIFY row_number() OVER (ORDER BY "timestamp" DESC, post_id) <= {entities.LATEST}))"""
    for k in range(SLICES)
    for e in PAIR
)


@query("stream_entities_newest", NEWEST_SQL)
def stream_entities_newest(g: Given):
    """The newest fifty posts of either entity, compared at the end of each slice."""
    landing, steps = _arriving(g, slices=_thirds)
    tagged = entities.tag_entities(live.stream_posts(g.spark, landing), PAIR)
    rows = rings.newest_per_entity(tagged, entities.LATEST, ["text"])
    out = fresh_path(g.spark, "newest")
    for k, _ in enumerate(steps):
        sinks.append_to(rows, f"{out}/rows", f"{out}/checkpoint").awaitTermination()
        last = rings.newest_lists(g.spark.read.schema(rows.schema).parquet(f"{out}/rows"), entities.LATEST)
        compared = entities.entity_compare(live.score_live(last, inclusive=False), PAIR)
        compared.withColumn("slice", F.lit(k + 1)).write.parquet(f"{out}/compared/{k}")
    return g.spark.read.parquet(*(f"{out}/compared/{k}" for k in range(SLICES))).select("slice", "entity", "volume", "avg_score", "positive")


@query(
    "stream_trending",
    f"""SELECT day, rank, phrase, '#' || replace(phrase, ' ', '') AS tag, n FROM
        (SELECT day, phrase, count(*) AS n, row_number() OVER (PARTITION BY day ORDER BY count(*) DESC, phrase)::INT AS rank FROM
          (SELECT day, trim(regexp_replace(part, '\\s+', ' ', 'g')) AS phrase FROM
            (SELECT strftime("timestamp", '%Y-%m-%d') AS day,
               unnest(string_split_regex(regexp_replace(lower(text), '[^a-z\\s]+', '|', 'g'), {q.quoted(PHRASE_BREAK)})) AS part FROM posts))
         WHERE len(phrase) >= {tx.MIN_PHRASE_LENGTH} GROUP BY day, phrase) WHERE rank <= 6""",
)
def stream_trending(g: Given):
    """Leading phrases of each day from the sketches of three slices, counted again in the posts."""
    landing, steps = _arriving(g)
    posts = live.stream_posts(g.spark, landing)
    sketches = trending.TrendingPhrases(fresh_path(g.spark, "trending"), size=200)
    for _ in steps:
        sketches.run_available(posts)
    chosen = trending.candidates(sketches.bounds(g.spark), 6)
    top = trending.leaders(g.posts, chosen, 6)
    return top.select(F.date_format("window_start", "yyyy-MM-dd").alias("day"), "rank", "phrase", "tag", "n")


@query("stream_listing", INGEST_SQL)
def stream_listing(g: Given):
    """The listings of ``ingest_listing`` as a stream over several files."""
    path = fresh_path(g.spark, "listing")
    size = g.documents.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    parts = max(SLICES, -(-size // LISTING_BYTES))
    listings_of(g).repartition(parts, "data").write.json(path)
    flat = sinks.drain(listing.flatten_listing(listing.stream_listing(g.spark, path, max_files=-(-parts // SLICES))), "listing")
    return flat.withColumn("timestamp", F.date_format("timestamp", "yyyy-MM-dd HH:mm:ss"))
