from pyspark.ml.linalg import Vectors

from weftline.operators import learn as L
from weftline.session import scratch_path

TRAINING = [(i, f"the {word} order {n} arrived {word}", float(word == "late")) for i, (word, n) in enumerate(
    [("late", 3), ("early", 4), ("late", 5), ("early", 6), ("late", 7), ("early", 8)])]
UNSEEN = [(10, "order 3 late again"), (11, "early and nice"), (12, "late late early"), (13, "nothing known here")]


def test_text_classifier_and_its_saved_copy(spark):
    training = spark.createDataFrame(TRAINING, "id bigint, text string, label double")
    unseen = spark.createDataFrame(UNSEEN, "id bigint, text string")
    model = L.text_classifier().fit(training)
    copy = L.save_and_reload(model, scratch_path(spark, "model"))
    got = L.positive_share(model.transform(unseen)).orderBy("id").collect()
    again = L.positive_share(copy.transform(unseen)).orderBy("id").collect()
    assert [r.prediction for r in got[:3]] == [1.0, 0.0, 1.0]
    assert all((r.p1 > 0.5) == (r.prediction == 1.0) for r in got)
    assert got[1].p1 < got[3].p1 < got[0].p1
    assert [r.p1 for r in got] == [r.p1 for r in again]


def test_unfitted_classifier_can_be_saved(spark):
    path = scratch_path(spark, "unfit")
    L.text_classifier().write().overwrite().save(path)
    loaded = type(L.text_classifier()).load(path)
    assert len(loaded.getStages()) == 3


def test_overrides_win_for_one_fit(spark):
    points = [(float(x + y > 3), Vectors.dense(float(x), float(y))) for x in range(4) for y in range(4)]
    training = spark.createDataFrame(points, ["label", "features"])
    unseen = spark.createDataFrame([(1.0, Vectors.dense(3.0, 3.0)), (0.0, Vectors.dense(0.0, 0.5)), (0.0, Vectors.dense(1.5, 1.5))], ["label", "features"])
    settings = L.merged({"maxIter": 20}, {"maxIter": 30}, {"regParam": 0.1, "threshold": 0.55}, {"probabilityCol": "mine"})
    model = L.fit_logistic(training, overrides=settings)
    assert (model.getMaxIter(), model.getRegParam(), model.getThreshold()) == (30, 0.1, 0.55)
    got = L.positive_share(model.transform(unseen), "mine").collect()
    assert [r.prediction for r in got] == [float(r.p1 > 0.55) for r in got]
    assert got[0].p1 > 0.55 > got[1].p1 and got[0].p1 > got[2].p1 > got[1].p1
    assert L.fit_logistic(training).getMaxIter() == 10


def test_tokens_and_hashed_terms(spark):
    row = L.hashed_terms(spark.createDataFrame([("The  the CAT",)], "text string")).first()
    assert row.words == ["the", "", "the", "cat"] and row.features.size == 1000 and sum(row.features.values) == 4
