"""Queries over what the library stores itself: roll-ups, indexed texts, exports."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidepost.operators import rollups
from tidepost.plans.registry import Given, query
from tidepost.plans.summary_queries import LABEL_COUNTS
from tidepost.plans.text_queries import EXPORT_SQL
from tidepost.sources import files, text_index, workdir

SLICES = 3
KPI_SQL = f"""SELECT *, 100 * positive // greatest(total, 1) AS positive_pct, 100 * negative // greatest(total, 1) AS negative_pct,
      100 * neutral // greatest(total, 1) AS neutral_pct, round(positive / greatest(negative, 1), 6) AS pos_neg_ratio
    FROM (SELECT count(*) AS total, {LABEL_COUNTS}, round(coalesce(avg(sentiment_score), 0), 6) AS avg_score,
      count(DISTINCT platform) AS platforms, count(DISTINCT topic) AS topics FROM scored)"""


def _rolled_up(g: Given):
    """Three slices by id, so that each brings rows of all days, two of them compacted in between."""
    rollup = rollups.Rollup(g.spark, workdir.fresh_path(g.spark, "rollup"))
    for k in range(SLICES):
        rollup.add(g.scored.where(F.col("post_id") % SLICES == k), k)
        if k == 1:
            rollup = rollup.compacted(workdir.fresh_path(g.spark, "rollup"))
    return rollup.rows()


@query("rollup_kpis", KPI_SQL)
def rollup_kpis(g: Given):
    return rollups.dashboard_kpis(_rolled_up(g))


@query("rollup_daily_trend", """SELECT strftime("timestamp", '%Y-%m-%d') AS day, sentiment_label, count(*) AS n FROM scored GROUP BY ALL""")
def rollup_daily_trend(g: Given):
    return rollups.daily_trend(_rolled_up(g)).withColumn("day", F.date_format("day", "yyyy-MM-dd"))


@query(
    "rollup_profile",
    """SELECT count(*) AS rows, count(DISTINCT topic) AS topics, strftime(min("timestamp"), '%Y-%m-%d %H:%M:%S') AS first_post,
         strftime(max("timestamp"), '%Y-%m-%d %H:%M:%S') AS last_post FROM scored""",
)
def rollup_profile(g: Given):
    out = rollups.profile(_rolled_up(g))
    return out.withColumns({c: F.date_format(c, "yyyy-MM-dd HH:mm:ss") for c in ("first_post", "last_post")})


#: Words that several, few or no documents have, and an expression whose literal parts are not looked for.
PATTERNS = ("license", "tok.n = ", "no such words at all", "mail[0-9]+")


@query(
    "search_indexed",
    " UNION ALL ".join(f"SELECT '{p}' AS pattern, doc_id, source FROM documents WHERE regexp_matches(text, '(?i){p}')" for p in PATTERNS),
)
def search_indexed(g: Given):
    path = workdir.fresh_path(g.spark, "indexed")
    text_index.write_indexed(g.documents.repartitionByRange("source", "doc_id"), path)
    out = None
    for pattern in PATTERNS:
        found = text_index.search(g.spark, path, pattern).select(F.lit(pattern).alias("pattern"), "doc_id", "source")
        out = found if out is None else out.unionByName(found)
    return out


@query("export_parquet", EXPORT_SQL)
def export_parquet(g: Given):
    """Written as Parquet by day and read back."""
    path = workdir.fresh_path(g.spark, "export")
    files.export_parquet(g.prepared, path)
    rows = g.spark.read.parquet(path)
    shown = rows.withColumn("timestamp", F.date_format("timestamp", "yyyy-MM-dd HH:mm:ss"))
    return files.existing_columns(shown)
