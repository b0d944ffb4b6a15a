import json
import random

import pytest
from pyspark.sql import functions as F

from tickbars.models.grouped import GroupedLinearModel
from tickbars.models.linear import LinearBarModel
from tickbars.plans.jobs import train_job


def bars(spark, count=60):
    rng = random.Random(5)
    rows = []
    for i in range(count):
        o, h, low, v = rng.uniform(1, 9), rng.uniform(9, 20), rng.uniform(0, 1), rng.randrange(99)
        rows.append((("A", "B")[i % 2], o, h, low, 2 * o - h + 3 * low + 0.5 * v + 7, v))
    return spark.createDataFrame(
        rows,
        "ticker string, open_price double, high_price double, low_price double, "
        "close_price double, volume bigint",
    )


def as_messages(spark, frame):
    values = [(json.dumps(r.asDict()),) for r in frame.collect()]
    return spark.createDataFrame(values, "value string")


def test_fit_finds_the_plane(spark):
    model = LinearBarModel()
    assert not model.fitted and model.topic == "OHLC_5M" and model.tickers == []
    with pytest.raises(ValueError):
        model.predict(bars(spark))
    fitted = model.fit(bars(spark)).stages[1]
    assert model.fitted
    assert list(fitted.coefficients) == pytest.approx([2, -1, 3, 0.5], abs=1e-6)
    assert fitted.intercept == pytest.approx(7, abs=1e-6)
    for row in model.predict(bars(spark)).collect():
        assert row.prediction == pytest.approx(row.close_price, abs=1e-6)


def test_rows_with_a_missing_feature_have_no_prediction(spark):
    extra = spark.createDataFrame(
        [("A", None, 1.0, 1.0, 1.0, 1), ("A", 1.0, 1.0, 1.0, None, 1)], bars(spark).schema
    )
    model = LinearBarModel()
    model.fit(bars(spark).union(extra))
    predicted = model.predict(bars(spark).union(extra))
    assert predicted.count() == 61
    assert predicted.filter("close_price IS NULL").count() == 1


def test_job_goes_on_after_failures(spark, tmp_path):
    schema = {"ticker": "string", "open_price": "double", "high_price": "double",
              "low_price": "double", "close_price": "double", "volume": "long"}
    for topic in ("GOOD", "UNREADABLE", "EMPTY"):
        (tmp_path / f"{topic}.json").write_text(json.dumps(schema))
    sent = as_messages(spark, bars(spark))
    reads = []

    def read(topic):
        reads.append(topic)
        if topic == "UNREADABLE":
            raise OSError("no broker")
        return sent.limit(0) if topic == "EMPTY" else sent

    class Failing(LinearBarModel):
        def fit(self, df):
            raise RuntimeError("no fit")

    models = [
        LinearBarModel(topic="UNREADABLE"),
        LinearBarModel(topic="EMPTY"),
        LinearBarModel(topic="NO_SCHEMA"),
        Failing(topic="GOOD"),
        LinearBarModel(["NOBODY"], topic="GOOD"),
        LinearBarModel(["A"], topic="GOOD"),
        LinearBarModel(topic="GOOD"),
    ]
    outcomes = train_job(read, models, schemas_dir=tmp_path)
    assert [o.model for o in outcomes] == models
    assert [o.trained for o in outcomes] == [False] * 5 + [True] * 2
    assert [o.predictions.count() for o in outcomes if o.trained] == [30, 60]
    for outcome, part in zip(outcomes, ("no broker", "no rows", "no schema", "no fit", "NOBODY")):
        assert part in outcome.reason
    assert reads == ["UNREADABLE", "EMPTY", "GOOD"]
    assert train_job(read, models, topics=["OTHER"], schemas_dir=tmp_path) == []
    assert sum(o.trained for o in train_job(read, models, topics=["GOOD"], schemas_dir=tmp_path)) == 2


def test_predictions_are_for_the_rows_of_the_fit(spark, tmp_path):
    """The topic goes on while the job runs, and nothing stays cached."""
    (tmp_path / "T.json").write_text('{"ticker": "string", "open_price": "double", '
                                     '"high_price": "double", "low_price": "double", '
                                     '"close_price": "double", "volume": "long"}')
    path = str(tmp_path / "topic")
    as_messages(spark, bars(spark)).write.parquet(path)
    read = lambda topic: spark.read.schema("value string").parquet(path)
    [outcome] = train_job(read, [LinearBarModel(topic="T")], schemas_dir=tmp_path)
    as_messages(spark, bars(spark, 10)).write.mode("append").parquet(path)
    assert outcome.predictions.count() == 60
    assert spark.sparkContext._jsc.getPersistentRDDs().isEmpty()


# --- One regression per ticker -----------------------------------------------------------


def test_grouped_fit_finds_every_plane(spark):
    """Tickers of different planes, one of a single row, one with a constant feature."""
    rng = random.Random(6)
    rows = []
    for k, ticker in enumerate("ABC"):
        for _ in range(40):
            o, h, low, v = (rng.uniform(1, 9) for _ in range(4))
            rows.append((ticker, o, h, low, k * o - h + 3 * low + 0.5 * v + k, v))
    rows += [("ONE", 1.0, 2.0, 3.0, 4.0, 5.0), (None, 1.0, 2.0, 3.0, 4.0, 5.0),
             ("A", None, 1.0, 1.0, 1.0, 1.0), ("A", float("nan"), 1.0, 1.0, 1.0, 1.0),
             ("A", 1.0, 1.0, 1.0, None, 1.0), ("NEW", 1.0, 1.0, 1.0, None, 1.0)]
    rows += [("FLAT", 2.0, float(x), 2.0 * x, 3.0 * x + 1, 7.0) for x in range(9)]
    frame = spark.createDataFrame(
        rows, "ticker string, open_price double, high_price double, low_price double, "
        "close_price double, volume double",
    )
    model = GroupedLinearModel()
    assert not model.fitted
    with pytest.raises(ValueError):
        model.predict(frame)
    model.fit(frame)
    found = {r.ticker: r for r in model.coefficients.collect()}
    assert set(found) == {"A", "B", "C", "ONE", "FLAT"}
    for k, ticker in enumerate("ABC"):
        weights = [found[ticker][f"weight_{n}"] for n in model.features]
        assert weights == pytest.approx([k, -1, 3, 0.5], abs=1e-8)
        assert found[ticker].intercept == pytest.approx(k, abs=1e-8)
        assert found[ticker].rows == 40
    predicted = model.predict(frame.withColumn("_model", F.lit("mine"))).collect()
    assert len(predicted) == 120 + 1 + 1 + 9
    assert {r._model for r in predicted} == {"mine"}
    for row in predicted:
        if row.close_price is not None:
            assert row.prediction == pytest.approx(row.close_price, abs=1e-6)


def test_grouped_fit_is_one_aggregate_without_python(spark, monkeypatch):
    plans = []
    monkeypatch.setattr(
        "tickbars.models.grouped.store", lambda df, purpose: plans.append(df) or df
    )
    GroupedLinearModel().fit(bars(spark))
    plan = plans[0]._jdf.queryExecution().executedPlan().toString()
    assert plan.count("HashAggregate") == 2 and plan.count("Exchange") == 1
    assert "SortAggregate" not in plan and "Python" not in plan and "Join" not in plan


def test_the_job_trains_all_tickers_at_once(spark, tmp_path):
    (tmp_path / "T.json").write_text('{"ticker": "string", "open_price": "double", '
                                     '"high_price": "double", "low_price": "double", '
                                     '"close_price": "double", "volume": "long"}')
    sent = as_messages(spark, bars(spark))
    models = [GroupedLinearModel(topic="T"), GroupedLinearModel(["B"], topic="T")]
    both, one = train_job(lambda topic: sent, models, schemas_dir=tmp_path)
    assert both.trained and both.predictions.count() == 60
    assert {r.ticker for r in one.predictions.collect()} == {"B"}
    empty = GroupedLinearModel()
    empty.fit(bars(spark).limit(0))
    assert empty.predict(bars(spark)).count() == 0
