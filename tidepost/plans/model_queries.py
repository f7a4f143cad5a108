"""Classifier queries."""

from __future__ import annotations

from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tidepost import rules
from tidepost.functions.text import letter_words
from tidepost.operators import classify, evaluation, words
from tidepost.plans.registry import Given, query

#: Where a post stands in the split by the hash of its id (see ``classify.id_split``).
PLACE_SQL = f"(('0x' || substr(md5(post_id::VARCHAR), 1, 8))::BIGINT % {classify.SPLIT_PARTS})"


def _test_sql(ratio: float) -> str:
    return f"{PLACE_SQL} >= {round(classify.SPLIT_PARTS * (1.0 - ratio))}"


RATIOS = (0.05, 0.2, 0.25, 0.35)


@query(
    "split_counts",
    " UNION ALL ".join(
        f"""SELECT {r}::DOUBLE AS ratio, CASE WHEN {_test_sql(r)} THEN 'test' ELSE 'train' END AS part, sentiment_label,
              count(*) AS n FROM prepared WHERE trim(clean_text) <> '' GROUP BY ALL"""
        for r in RATIOS
    ),
)
def split_counts(g: Given):
    out = None
    for ratio in RATIOS:
        train, test = classify.id_split(classify.train_rows(g.prepared), ratio)
        parts = train.withColumn("part", F.lit("train")).unionByName(test.withColumn("part", F.lit("test")))
        counts = parts.groupBy(F.lit(ratio).alias("ratio"), "part", "sentiment_label").agg(F.count("*").alias("n"))
        out = counts if out is None else out.unionByName(counts)
    return out


@query(
    "idf_weights",
    """SELECT word, count(*) AS size, CASE WHEN count(*) >= 3 THEN round(ln(((SELECT count(text) FROM documents) + 1)
         / (count(*) + 1)), 6) ELSE 0.0 END AS idf FROM doc_sets GROUP BY word""",
)
def idf_weights(g: Given):
    return words.idf_weights(g.documents)


@query(
    "label_index",
    """SELECT sentiment_label, count(*) AS n, (row_number() OVER (ORDER BY count(*) DESC, sentiment_label) - 1)::INT AS "index"
       FROM scored GROUP BY sentiment_label""",
)
def label_index(g: Given):
    return classify.label_index(g.scored)


@query(
    "idf_fitted",
    """SELECT word, CASE WHEN count(*) >= 3 THEN round(ln(((SELECT count(*) FROM documents) + 1) / (count(*) + 1)), 6) ELSE 0.0 END AS idf
       FROM doc_sets GROUP BY word""",
)
def idf_fitted(g: Given):
    """Weights that the fitted stage gives the words of all documents."""
    found = F.coalesce(letter_words(F.col("text")), F.array().cast("array<string>"))
    stops = F.array(*(F.lit(w) for w in rules.STOP_WORDS))
    tokens = g.documents.select(F.filter(found, lambda w: ~F.array_contains(stops, w)).alias("tokens"))
    return classify.fitted_idf(tokens, "tokens").withColumn("idf", F.round("idf", 6))


@query(
    "label_index_fitted",
    """SELECT sentiment_label, (row_number() OVER (ORDER BY count(*) DESC, sentiment_label) - 1)::INT AS "index"
       FROM scored GROUP BY sentiment_label""",
)
def label_index_fitted(g: Given):
    return classify.fitted_labels(g.scored)


FOLDS = 4


@query(
    "fold_counts",
    f"""SELECT (('0x' || substr(md5(doc_id::VARCHAR), 1, 8))::BIGINT % {FOLDS})::INT AS fold, quality, count(*) AS n
        FROM docs JOIN labels USING (doc_id) WHERE trim(clean_text) <> '' GROUP BY ALL""",
)
def fold_counts(g: Given):
    rows = classify.train_rows(_quality(g), label="quality_label")
    return rows.groupBy(classify.fold_of(FOLDS, "doc_id").alias("fold"), "quality").agg(F.count("*").alias("n"))


@query("cross_validation")
def cross_validation(g: Given):
    """Quality of documents: the regularisation by hashed folds, the worse half dropped after each."""
    return classify.cross_validate(_quality(g), FOLDS, key="doc_id", label="quality_label")


def _quality(g: Given):
    named = F.when(F.col("quality") == 1, "good").otherwise("poor")
    return g.docs.join(g.table("labels"), "doc_id").withColumn("quality_label", named)


def _split(g: Given):
    return classify.id_split(classify.train_rows(g.prepared))


# A sentence never occurs under two labels, so a working classifier gets every post right; the
# SQL of the next queries says just that.


@query("predict_batch", "SELECT post_id, sentiment_label, sentiment_label AS predicted_label FROM prepared")
def predict_batch(g: Given):
    """Fitted on the training part, saved, loaded again and applied to every post."""
    from tidepost.sources.workdir import fresh_path

    train, _ = _split(g)
    model, labels = classify.fit(train)
    path = classify.save_model(model, fresh_path(g.spark, "model"))
    out = classify.predict(classify.load_model(path), labels, g.prepared)
    return out.select("post_id", "sentiment_label", "predicted_label")


@query(
    "model_score",
    """SELECT post_id, 'classifier' AS engine, sentiment_label AS label,
         CASE sentiment_label WHEN 'Positive' THEN 1 WHEN 'Negative' THEN -1 ELSE 0 END AS direction, true AS within_bounds
       FROM prepared""",
)
def model_score(g: Given):
    """The classifier as a third engine beside the lexicons, in the long layout."""
    train, _ = _split(g)
    model, labels = classify.fit(train)
    rows = classify.engine_rows(classify.predict(model, labels, g.prepared), labels=labels)
    strong = F.when(F.col("label") == "Neutral", F.lit(0)).otherwise(F.signum("score").cast("int"))
    return rows.select("post_id", "engine", "label", strong.alias("direction"), (F.abs("score") <= 1).alias("within_bounds"))


@query(
    "train_eval",
    f"""SELECT sentiment_label AS label, 1.0::DOUBLE AS precision, 1.0::DOUBLE AS recall, 1.0::DOUBLE AS f1,
         count(*) AS support FROM prepared WHERE {_test_sql(classify.TEST_RATIO)} GROUP BY sentiment_label""",
)
def train_eval(g: Given):
    done = classify.train_and_evaluate(g.prepared, split_key="post_id")
    return done.class_metrics


@query("train_eval_documents")
def train_eval_documents(g: Given):
    """A real label: document quality. Both tables have one row per document."""
    return classify.train_and_evaluate(_quality(g), label="quality_label", split_key="doc_id").confusion


@query(
    "train_support_documents",
    f"""SELECT CASE WHEN quality = 1 THEN 'good' ELSE 'poor' END AS label, count(*) AS support
        FROM docs JOIN labels USING (doc_id) WHERE trim(clean_text) <> '' AND {_test_sql(classify.TEST_RATIO).replace("post_id", "doc_id")}
        GROUP BY 1""",
)
def train_support_documents(g: Given):
    """How many held-out documents of each quality the evaluation of ``train_eval_documents`` saw."""
    confusion = train_eval_documents(g)
    seen = sum(F.col(c) for c in confusion.columns if c != "Actual")
    return confusion.select(F.col("Actual").alias("label"), seen.cast("bigint").alias("support"))


def _feature_weights(g: Given):
    train, _ = _split(g)
    model, _ = classify.fit(train, named=True)
    return classify.feature_weights(model, g.spark)


@query("feature_weights")
def feature_weights(g: Given):
    return _feature_weights(g)


@query(
    "feature_weight_order",
    f"SELECT unnest(range(1, {classify.TOP_FEATURES} + 1))::INT AS rank, true AS falling, true AS known_word",
)
def feature_weight_order(g: Given):
    """Ranks of the top features, whether weights fall along them, and whether each is a word."""
    order = W.orderBy(F.desc("weight"), "feature_idx")  # twenty rows
    rows = _feature_weights(g).select(
        F.row_number().over(order).alias("rank"), "word", "weight", F.lag("weight").over(order).alias("before")
    )
    falling = F.coalesce(F.col("weight") <= F.col("before"), F.col("weight") > 0)
    return rows.select("rank", falling.alias("falling"), F.col("word").isNotNull().alias("known_word"))


@query(
    "tune_grid",
    """SELECT f::INT AS num_features, r::DOUBLE AS reg_param, 20 AS max_iter, true AS f1_in_range
       FROM (VALUES (500), (2000)) a(f), (VALUES (0.01), (0.1)) b(r)""",
)
def tune_grid(g: Given):
    rows = tune_model(g)
    return rows.select("num_features", "reg_param", "max_iter", F.col("f1").between(0, 1).alias("f1_in_range"))


@query("tune_model")
def tune_model(g: Given):
    return classify.tune(g.prepared, features=(500, 2000), reg_params=(0.01, 0.1))


@query(
    "model_metrics",
    f"""SELECT 1.0::DOUBLE AS accuracy, 1.0::DOUBLE AS weighted_precision, 1.0::DOUBLE AS weighted_recall,
         1.0::DOUBLE AS weighted_f1, count(*) AS test_count FROM prepared WHERE {_test_sql(classify.TEST_RATIO)}""",
)
def model_metrics(g: Given):
    train, test = _split(g)
    model, labels = classify.fit(train)
    predicted = classify.predict(model, labels, test)
    return evaluation.overall_metrics(
        evaluation.confusion_counts(predicted, "sentiment_label", "predicted_label")
    )
