import pytest
from pyspark.sql import functions as F

from tidepost.operators import classify
from tidepost.sources import demo


@pytest.fixture(scope="module")
def labelled(spark):
    posts = demo.demo_posts(spark, 1200).withColumn("post_id", F.monotonically_increasing_id())
    return posts.withColumn("clean_text", F.lower("text")).cache()


@pytest.fixture(scope="module")
def trained(labelled):
    return classify.train_and_evaluate(labelled, num_features=500, max_iter=10)


def test_training_rows(spark):
    df = spark.createDataFrame([("a", "x"), (" ", "x"), (None, "x"), ("b", None)], "clean_text string, sentiment_label string")
    assert classify.train_rows(df).count() == 1


def test_better_than_the_majority_class(trained, labelled):
    metrics = trained.metrics.first()
    assert metrics["accuracy"] > 0.9
    assert trained.labels[0] == "positive" and set(trained.labels) == {"positive", "negative", "neutral"}
    assert all(r["recall"] > 0.8 for r in trained.class_metrics.collect())
    assert trained.confusion.columns == ["Actual", *[f"Pred_{x}" for x in trained.labels]]
    total = sum(r[f"Pred_{x}"] for r in trained.confusion.collect() for x in trained.labels)
    assert total == metrics["test_count"] == trained.predictions.count()
    assert trained.feature_weights.count() == 20


def test_saved_model_predicts_the_same(spark, trained, labelled, tmp_path):
    path = classify.save_model(trained.model, str(tmp_path / "model"))
    classify.save_model(trained.model, path)
    again = classify.load_model(path)
    new = labelled.select("post_id", "clean_text").limit(50).cache()
    one = classify.predict(trained.model, trained.labels, new).select("post_id", "predicted_label", "model_score")
    two = classify.predict(again, trained.labels, new).select("post_id", "predicted_label", "model_score")
    assert sorted(map(tuple, one.collect())) == sorted(map(tuple, two.collect()))


def test_engine_rows(spark, trained):
    df = spark.createDataFrame([(1, "i love this wonderful success")], "post_id int, clean_text string")
    row = classify.engine_rows(classify.predict(trained.model, trained.labels, df), labels=trained.labels).first()
    assert row["engine"] == "classifier" and abs(row["score"]) <= 0.8 and "p_positive" in row["details"]


def test_named_features_extra_class_and_unknown_index(labelled):
    model, labels = classify.fit(labelled, num_features=200, max_iter=2, named=True, extra_class=True)
    assert len(labels) == 3 and model.stages[-1].numClasses == 4
    words = classify.feature_weights(model, labelled.sparkSession, 5)
    assert all(r["word"] for r in words.collect())
    out = classify.predict(model, labels[:1], labelled.limit(200))
    assert {r[0] for r in out.select("predicted_label").distinct().collect()} <= {labels[0], "Neutral"}


def test_splits(labelled):
    ids = labelled.sparkSession.range(4000).withColumnRenamed("id", "post_id")
    for ratio in (0.05, 0.25, 0.35):
        train, test = classify.id_split(ids, ratio)
        assert train.count() + test.count() == 4000 and abs(test.count() / 4000 - ratio) < 0.03
    parts = classify.random_split(labelled, 0.2, seed=1)
    assert sum(p.count() for p in parts) == 1200


def test_label_index(spark):
    df = spark.createDataFrame([("b",), ("a",), ("c",), ("c",)], "sentiment_label string")
    assert {r[0]: r["index"] for r in classify.label_index(df).collect()} == {"c": 0, "a": 1, "b": 2}


def test_tuning_lists_every_choice(labelled):
    rows = classify.tune(labelled, features=(50, 100), reg_params=(0.01,), max_iters=(2,)).collect()
    assert len(rows) == 2 and rows[0]["f1"] >= rows[1]["f1"]


def quality(spark, count=240):
    """Texts whose label follows some words, but not always."""
    rows = [(i, ("solid useful work " if i % 3 else "broken empty noise ") + f"item{i % 7} part{i % 5}", "good" if i % 3 or i % 9 == 0 else "poor") for i in range(count)]
    return spark.createDataFrame(rows, "post_id int, clean_text string, sentiment_label string")


def test_halving_finds_the_choice_of_the_full_grid(spark):
    df = quality(spark)
    options = {"k": 4, "reg_params": (0.01, 0.1, 1.0, 50.0), "num_features": 64}
    whole = classify.cross_validate(df, halving=False, **options).collect()
    halved = classify.cross_validate(df, **options).collect()
    assert [r["folds"] for r in whole] == [4] * 4 and sorted(r["folds"] for r in halved) == [1, 1, 2, 4]
    best = {r["reg_param"] for r in whole if r["f1"] == whole[0]["f1"]}
    assert halved[0]["reg_param"] in best and min(whole, key=lambda r: r["f1"])["reg_param"] == 50.0


def test_metrics_are_a_recount_of_predictions_that_can_be_wrong(spark):
    done = classify.train_and_evaluate(quality(spark), split_key="post_id", num_features=64, max_iter=10)
    rows = [(r["sentiment_label"], r["predicted_label"]) for r in done.predictions.collect()]
    assert 0 < sum(a != b for a, b in rows) < len(rows) / 2
    confusion = {r["Actual"]: r.asDict() for r in done.confusion.collect()}
    for r in done.class_metrics.collect():
        x = r["label"]
        hit = rows.count((x, x))
        predicted, actual = sum(b == x for _, b in rows), sum(a == x for a, _ in rows)
        assert r["support"] == actual and confusion[x][f"Pred_{x}"] == hit
        assert r["precision"] == pytest.approx(hit / max(predicted, 1), abs=1e-4) and r["recall"] == pytest.approx(hit / max(actual, 1), abs=1e-4)


def test_cross_validation_reads_every_text_once(spark):
    read = spark.sparkContext.accumulator(0)

    def seen(text):
        read.add(1)
        return text

    docs = quality(spark, 120).repartition(2).localCheckpoint()
    noted = docs.withColumn("clean_text", F.udf(seen, "string").asNondeterministic()("clean_text"))
    plain = classify.cross_validate(docs, 2, (0.01, 0.1), num_features=50).collect()
    got = classify.cross_validate(noted, 2, (0.01, 0.1), num_features=50).collect()
    assert got == plain and read.value == docs.count()
