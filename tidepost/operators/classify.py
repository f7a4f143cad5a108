"""Text classification with MLlib: features, training, prediction, persistence, tuning."""

from __future__ import annotations

import time
from dataclasses import dataclass

from pyspark import StorageLevel
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.evaluation import MulticlassClassificationEvaluator
from pyspark.ml.feature import (
    IDF,
    CountVectorizer,
    HashingTF,
    StopWordsRemover,
    StringIndexer,
    Tokenizer,
)
from pyspark.ml.functions import vector_to_array
from pyspark.ml.tuning import ParamGridBuilder, TrainValidationSplit
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tidepost.operators.prepare import keep_where
from tidepost.functions.labels import model_score
from tidepost.functions.text import is_blank
from tidepost.operators import evaluation

# Defaults of the classifier.
NUM_FEATURES = 10_000
REG_PARAM = 0.01
MAX_ITER = 100
ELASTIC_NET = 0.0
TEST_RATIO = 0.2
SEED = 42
MIN_DOC_FREQ = 3
TOP_FEATURES = 20
SPLIT_PARTS = 1_000_000


@dataclass
class Trained:
    """A fitted scoring model (no label stage) with its evaluation as small DataFrames."""

    model: PipelineModel
    labels: list[str]
    metrics: DataFrame
    class_metrics: DataFrame
    confusion: DataFrame
    feature_weights: DataFrame
    predictions: DataFrame
    train_seconds: float
    train_count: int
    settings: dict


def train_rows(df: DataFrame, text: str = "clean_text", label: str = "sentiment_label") -> DataFrame:
    """Rows that can be trained on: text and label there, text not blank.

    Texts are mostly cleaned in the same plan, so they are tested where they stand.
    """
    return keep_where(df, ~is_blank(F.col(text)) & F.col(label).isNotNull())


def with_training_text(df: DataFrame) -> DataFrame:
    """Lower-cased text stands in where no cleaned text exists."""
    return df if "clean_text" in df.columns else df.withColumn("clean_text", F.lower("text"))


def random_split(df: DataFrame, test_ratio: float = TEST_RATIO, seed: int = SEED) -> list[DataFrame]:
    return df.randomSplit([1.0 - test_ratio, test_ratio], seed=seed)


def _place(key: str) -> Column:
    return F.conv(F.substring(F.md5(F.coalesce(F.col(key).cast("string"), F.lit(""))), 1, 8), 16, 10).cast("bigint")


def id_split(df: DataFrame, test_ratio: float = TEST_RATIO, key: str = "post_id") -> tuple[DataFrame, DataFrame]:
    """Split by a hash of the id: any ratio holds, and the same rows whatever the partitioning."""
    cut = round(SPLIT_PARTS * (1.0 - test_ratio))
    in_train = _place(key) % SPLIT_PARTS < cut
    return df.filter(in_train), df.filter(~in_train)


def fold_of(k: int, key: str = "post_id") -> Column:
    """Number of the fold of a row, from a hash of its id: the same whatever the partitioning."""
    return (_place(key) % k).cast("int")


def label_index(df: DataFrame, label: str = "sentiment_label") -> DataFrame:
    """Label -> index, most frequent first, ties by name (one row per label)."""
    counts = df.groupBy(label).agg(F.count("*").alias("n"))
    w = W.partitionBy().orderBy(F.desc("n"), label)
    return counts.withColumn("index", F.row_number().over(w) - 1)


def text_stages(num_features: int = NUM_FEATURES, named: bool = False) -> list:
    """Tokens, stop words out, term frequencies, IDF. ``named`` keeps a vocabulary, bounded by
    ``num_features``, so that weights can be read as words."""
    counted = (
        CountVectorizer(inputCol="kept_tokens", outputCol="counts", vocabSize=num_features)
        if named
        else HashingTF(inputCol="kept_tokens", outputCol="counts", numFeatures=num_features)
    )
    return [
        Tokenizer(inputCol="clean_text", outputCol="all_tokens"),
        StopWordsRemover(inputCol="all_tokens", outputCol="kept_tokens"),
        counted,
        IDF(inputCol="counts", outputCol="features", minDocFreq=MIN_DOC_FREQ),
    ]


def label_stage(label: str = "sentiment_label", extra_class: bool = False) -> StringIndexer:
    return StringIndexer(
        inputCol=label,
        outputCol="label",
        stringOrderType="frequencyDesc",
        handleInvalid="keep" if extra_class else "error",
    )


def logistic(reg_param=REG_PARAM, max_iter=MAX_ITER, elastic_net=ELASTIC_NET) -> LogisticRegression:
    return LogisticRegression(
        featuresCol="features",
        labelCol="label",
        regParam=reg_param,
        maxIter=max_iter,
        elasticNetParam=elastic_net,
        family="multinomial",
    )


def predict(model: PipelineModel, labels: list[str], df: DataFrame) -> DataFrame:
    """Predicted label, its probability and the score derived from it, for any DataFrame with
    ``clean_text``; an index beyond the known labels reads as Neutral."""
    at = F.col("prediction").cast("int")
    named = F.coalesce(F.get(F.array(*[F.lit(x) for x in labels]), at), F.lit("Neutral"))
    sure = F.coalesce(F.get(vector_to_array("probability"), at), F.lit(0.5))
    return (
        model.transform(df)
        .withColumn("predicted_label", named)
        .withColumn("probability_of_label", sure)
        .withColumn("model_score", model_score(F.col("probability_of_label"), F.col("predicted_label")))
    )


def engine_rows(predicted: DataFrame, key: str = "post_id", labels: list[str] | None = None) -> DataFrame:
    """Predictions in the long engine layout, next to the lexicon engines."""
    details: list[Column] = [F.lit("confidence"), F.round("probability_of_label", 4).cast("string")]
    for i, x in enumerate(labels or []):
        details += [F.lit(f"p_{x}"), F.round(F.get(vector_to_array("probability"), F.lit(i)), 4).cast("string")]
    return predicted.select(
        key,
        F.lit("classifier").alias("engine"),
        F.col("model_score").alias("score"),
        F.col("predicted_label").alias("label"),
        F.create_map(*details).alias("details"),
    )


def feature_weights(model: PipelineModel, spark: SparkSession, n: int = TOP_FEATURES) -> DataFrame:
    """Features with the largest sum of absolute coefficients over the classes.

    The matrix is classes x ``num_features``: its size is set by the caller, not by the data.
    """
    sums = abs(model.stages[-1].coefficientMatrix.toArray()).sum(axis=0)
    named = next((s.vocabulary for s in model.stages if hasattr(s, "vocabulary")), None)
    order = sorted(range(len(sums)), key=lambda i: (-sums[i], i))[:n]
    rows = [(i, named[i] if named else None, round(float(sums[i]), 4)) for i in order]
    return spark.createDataFrame(rows, "feature_idx int, word string, weight double")


def fit(
    train: DataFrame, num_features=NUM_FEATURES, reg_param=REG_PARAM, max_iter=MAX_ITER,
    elastic_net=ELASTIC_NET, label="sentiment_label", extra_class=False, named=False,
) -> tuple[PipelineModel, list[str]]:
    """Fit; the model returned scores new posts and needs no label column.

    Document frequencies, label counts and the optimiser each read the rows, so text and
    label are kept (memory, then disk) while fitting.
    """
    stages = [*text_stages(num_features, named), label_stage(label, extra_class), logistic(reg_param, max_iter, elastic_net)]
    kept = train.select("clean_text", label).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        model = Pipeline(stages=stages).fit(kept)
    finally:
        kept.unpersist()
    indexer = model.stages[-2]
    return PipelineModel(model.stages[:-2] + model.stages[-1:]), list(indexer.labels)


def train_and_evaluate(
    df: DataFrame, test_ratio=TEST_RATIO, seed=SEED, split_key: str | None = None,
    label="sentiment_label", **options,
) -> Trained:
    """Filter, split, fit, predict the held-out rows and measure them in one pass."""
    rows = train_rows(with_training_text(df), label=label)
    train, test = id_split(rows, test_ratio, split_key) if split_key else random_split(rows, test_ratio, seed)
    began = time.monotonic()
    model, labels = fit(train, label=label, **options)
    seconds = time.monotonic() - began
    train_count = train.count()
    predicted = predict(model, labels, test)
    counts = evaluation.confusion_counts(predicted, label, "predicted_label")
    return Trained(
        model=model,
        labels=labels,
        metrics=evaluation.overall_metrics(counts),
        class_metrics=evaluation.class_metrics(counts, labels),
        confusion=evaluation.confusion_matrix(counts, labels),
        feature_weights=feature_weights(model, df.sparkSession),
        predictions=predicted,
        train_seconds=seconds,
        train_count=train_count,
        settings={
            "num_features": NUM_FEATURES, "reg_param": REG_PARAM, "max_iter": MAX_ITER, "elastic_net": ELASTIC_NET,
            "test_ratio": test_ratio, "seed": seed, **options,
        },
    )


def save_model(model: PipelineModel, path: str) -> str:
    model.write().overwrite().save(path)
    return path


def load_model(path: str) -> PipelineModel:
    return PipelineModel.load(path)


def tune(
    df: DataFrame, features=(1000,), reg_params=(0.01, 0.1), max_iters=(20,), train_ratio=0.8,
    seed=SEED, label="sentiment_label", parallelism: int = 2,
) -> DataFrame:
    """Weighted F of every parameter choice on a held-out part, best first."""
    lr = logistic()
    grid = ParamGridBuilder().addGrid(lr.regParam, list(reg_params)).addGrid(lr.maxIter, list(max_iters)).build()
    rows = train_rows(df, label=label).select("clean_text", label)
    listed = []
    for count in features:
        # Tokens, frequencies and labels depend on the number of features alone: once per number.
        prepared = Pipeline(stages=[*text_stages(count), label_stage(label)]).fit(rows).transform(rows)
        vectors = prepared.select("features", "label").persist(StorageLevel.MEMORY_AND_DISK)
        validated = TrainValidationSplit(
            estimator=lr,
            estimatorParamMaps=grid,
            evaluator=MulticlassClassificationEvaluator(metricName="f1"),
            trainRatio=train_ratio,
            seed=seed,
            parallelism=parallelism,
        )
        try:
            metrics = validated.fit(vectors).validationMetrics
        finally:
            vectors.unpersist()
        listed += [
            (int(count), float(g[lr.regParam]), int(g[lr.maxIter]), round(float(m), 4)) for g, m in zip(grid, metrics)
        ]
    return df.sparkSession.createDataFrame(
        listed, "num_features int, reg_param double, max_iter int, f1 double"
    ).orderBy(F.desc("f1"), "num_features", "reg_param", "max_iter")


def fitted_idf(df: DataFrame, tokens: str, vocabulary: int = 1 << 18, min_docs: int = MIN_DOC_FREQ) -> DataFrame:
    """``word, idf`` as the fitted stages have them; at most ``vocabulary`` words."""
    counts = CountVectorizer(inputCol=tokens, outputCol="_counts", vocabSize=vocabulary, minDF=1.0)
    model = Pipeline(stages=[counts, IDF(inputCol="_counts", outputCol="_idf", minDocFreq=min_docs)]).fit(df)
    words, weights = model.stages[0].vocabulary, model.stages[1].idf.toArray().tolist()
    return df.sparkSession.createDataFrame(list(zip(words, weights, strict=True)), "word string, idf double")


def fitted_labels(df: DataFrame, label: str = "sentiment_label") -> DataFrame:
    """``label, index`` as the fitted label stage has them."""
    found = label_stage(label).fit(df).labels
    return df.sparkSession.createDataFrame([(x, i) for i, x in enumerate(found)], f"`{label}` string, `index` int")


def cross_validate(
    df: DataFrame, k: int = 4, reg_params=(0.001, 0.01, 0.1, 1.0), max_iters=(20,), num_features: int = 1000,
    key: str = "post_id", label: str = "sentiment_label", halving: bool = True,
) -> DataFrame:
    """Parameter choices by their mean weighted F over folds: ``reg_param, max_iter, folds, f1``, best first.

    Texts are read once: their term counts are kept, from which document frequencies, labels and vectors
    come. Each fold is held out in turn; with ``halving`` the worse half of
    the choices (by their mean so far, ties to the earlier one) goes after every fold, so that a choice
    is judged on as many folds as it deserves. The best choice is the first row.
    """
    rows = train_rows(df, label=label).select("clean_text", label, fold_of(k, key).alias("fold"))
    *counting, idf = text_stages(num_features)
    counts = PipelineModel(counting).transform(rows).select("counts", label, "fold").persist(StorageLevel.MEMORY_AND_DISK)
    judge = MulticlassClassificationEvaluator(metricName="f1")
    scores: dict[tuple[float, int], list[float]] = {(r, m): [] for r in reg_params for m in max_iters}
    alive = list(scores)
    try:
        vectors = Pipeline(stages=[idf, label_stage(label)]).fit(counts).transform(counts).select("features", "label", "fold")
        for fold in range(k):
            train, held_out = vectors.where(F.col("fold") != fold), vectors.where(F.col("fold") == fold)
            for choice in alive:
                model = logistic(reg_param=choice[0], max_iter=choice[1]).fit(train)
                scores[choice].append(judge.evaluate(model.transform(held_out)))
            if halving and len(alive) > 1:
                by_mean = sorted(alive, key=lambda c: -sum(scores[c]) / len(scores[c]))
                alive = by_mean[: -(-len(alive) // 2)]
    finally:
        counts.unpersist()
    listed = [(float(r), int(m), len(s), round(sum(s) / len(s), 4)) for (r, m), s in scores.items() if s]
    listed.sort(key=lambda row: (-row[2], -row[3]))
    return df.sparkSession.createDataFrame(listed, "reg_param double, max_iter int, folds int, f1 double")
