import os

import pytest
from pyspark.sql import functions as F

from tests.conftest import rows
from tillroll import contracts
from tillroll.errors import (
    CorruptModelError,
    DatasetNotFoundError,
    IncompatibleTransformError,
    ModelNotFoundError,
    NotTrainedError,
)
from tillroll.functions.dates import parse_invoice_date
from tillroll.operators.lookups import keyed_lookup
from tillroll.plans import arima, autoregression, predictor
from tillroll.plans.recommender import train_recommender
from tillroll.schema import FEATURES
from tillroll.sources import datasets, versions
from tillroll.sources.invoices import scan_invoices

CSV = """Invoice,StockCode,Description,Quantity,InvoiceDate,Price,Customer ID,Country
489434,85048,"LIGHTS, 15CM",12,2009-12-01 07:45:00,6.95,13085.0,United Kingdom
C489435,79323P,,-2,2009-12-01 07:46:00,6.75,,United Kingdom
"""


def test_csv_scan_by_header(spark, tmp_path):
    path = tmp_path / "other.csv"
    path.write_text(
        'StockCode,Note,Quantity,Price,Invoice,CustomerID,InvoiceDate,Description\n'
        '85048,x,"1",2.5,489434,13085.0,2009-12-01 07:45:00,"LARGE 12"" BOX, RED"\n22,y,-3,0.1,C1,,2009-12-01 07:46:00,"two\nlines"\n'
    )
    found = scan_invoices(spark, str(path), multi_line=True).orderBy("stock_code").collect()
    assert [(r.invoice, r.stock_code, r.description, r.quantity, r.price, r.customer_id, r.country) for r in found] == [
        ("C1", "22", "two\nlines", -3, 0.1, None, None), ("489434", "85048", 'LARGE 12" BOX, RED', 1, 2.5, 13085, None),
    ]


@pytest.mark.parametrize("bad", ["twelve", "1.5"])
def test_csv_scan_refuses_what_it_cannot_read(spark, tmp_path, bad):
    path = tmp_path / "bad.csv"
    path.write_text(CSV.replace(",12,", f",{bad},"))
    with pytest.raises(Exception, match="Quantity: cannot read"):
        scan_invoices(spark, str(path)).collect()
    path = tmp_path / "short.csv"
    path.write_text(CSV.replace("StockCode", "Code"))
    with pytest.raises(KeyError, match="StockCode"):
        scan_invoices(spark, str(path))


def test_csv_scan(spark, tmp_path):
    path = tmp_path / "lines.csv"
    path.write_text(CSV)
    lines = scan_invoices(spark, str(path))
    first = lines.orderBy("invoice").first()
    assert (first.customer_id, first.quantity, first.description) == (13085, 12, "LIGHTS, 15CM")
    moment = lines.select(parse_invoice_date(F.col("invoice_date")).alias("t")).orderBy("t").first().t
    assert str(moment) == "2009-12-01 07:45:00"
    assert rows(lines.where("customer_id IS NULL"), "invoice", "description") == [("C489435", None)]
    with pytest.raises(DatasetNotFoundError):
        scan_invoices(spark, str(tmp_path / "absent.csv"))


def test_datasets(spark, tmp_path):
    base = str(tmp_path)
    with pytest.raises(DatasetNotFoundError):
        datasets.read_dataset(spark, base, "sales")
    datasets.write_dataset(spark.range(3), base, "sales")
    datasets.write_dataset(spark.range(5), base, "sales")
    assert datasets.read_dataset(spark, base, "sales").count() == 3
    datasets.write_dataset(spark.range(5), base, "sales", overwrite_if_exists=True)
    assert datasets.read_dataset(spark, base, "sales").count() == 5
    with pytest.raises(ValueError):
        datasets.write_dataset(spark.range(3), base, "bad name")


def test_publishing_survives_a_killed_run(spark, tmp_path):
    base, folder = str(tmp_path), str(tmp_path / "sales")

    def killed(path):
        spark.range(9).write.parquet(f"{path}/part")
        raise KeyboardInterrupt

    with pytest.raises(KeyboardInterrupt):
        versions.publish(spark, folder, killed)
    with pytest.raises(DatasetNotFoundError):
        datasets.read_dataset(spark, base, "sales")
    datasets.write_dataset(spark.range(3), base, "sales")
    with pytest.raises(KeyboardInterrupt):
        versions.publish(spark, folder, killed)
    failing = spark.range(5).selectExpr("IF(id = 4, raise_error('lost'), id) AS id")
    with pytest.raises(Exception, match="lost"):
        datasets.write_dataset(failing, base, "sales", overwrite_if_exists=True)
    kept = datasets.read_dataset(spark, base, "sales")
    assert kept.count() == 3
    datasets.write_dataset(spark.range(5), base, "sales", overwrite_if_exists=True)
    assert kept.count() == 3 and datasets.read_dataset(spark, base, "sales").count() == 5  # a reader may end
    datasets.write_dataset(kept.union(kept), base, "sales", overwrite_if_exists=True)  # from its own older version
    assert datasets.read_dataset(spark, base, "sales").count() == 6
    names = [p.name for p in (tmp_path / "sales").iterdir()]
    assert len([n for n in names if versions.exists(spark, f"{folder}/{n}/{versions.MARKER}")]) == versions.KEPT + 1


def test_recommender_store(spark, tmp_path):
    base = str(tmp_path)
    pairs = spark.createDataFrame([(c, str(i)) for c in range(30) for i in range(c % 25 + 1)], "customer_id long, stock_code string")
    trained = train_recommender(pairs, 3, held_out=2, splits=(1,), base=base, name="items")
    items, customers = datasets.read_recommender(spark, base, "items")
    assert items.columns == ["item", "top_1", "top_2", "top_3"] and customers.count() > 0
    assert 0 <= trained.rates.first().hit_rate <= 1
    with pytest.raises(ModelNotFoundError):
        datasets.read_recommender(spark, base, "absent")
    os.makedirs(tmp_path / "half" / "item_neighborhood")
    with pytest.raises(CorruptModelError):
        datasets.read_recommender(spark, base, "half")
    for n in (0, 26):
        with pytest.raises(ValueError):
            train_recommender(pairs, n)


def test_a_strict_lookup_reads_its_table_once(spark):
    read = spark.sparkContext.accumulator(0)

    def counted(batches):
        for batch in batches:
            read.add(len(batch))
            yield batch

    table = spark.range(40).withColumn("v", F.col("id") * 2).mapInPandas(counted, "id long, v long")
    found = keyed_lookup(table, "id", [3, 5, 5], ["v"])
    assert rows(found) == [(3, 6), (5, 10)] and rows(found) == [(3, 6), (5, 10)] and read.value == 40
    with pytest.raises(KeyError):
        keyed_lookup(table, "id", [3, 99], ["v"])
    with pytest.raises(KeyError):
        keyed_lookup(table, "id", spark.createDataFrame([(None,)], "id long"), ["v"])
    assert rows(keyed_lookup(table, "id", [99], ["v"], ignore_missing=True)) == [(99, None)]
    assert keyed_lookup(table, "id", table.limit(0), ["v"]).count() == 0


@pytest.fixture(scope="module")
def features(spark):
    numbers = spark.range(400).select(
        F.col("id").alias("customer_id"),
        *[(F.rand(seed) * 100).cast("int").alias(name) for seed, name in enumerate(FEATURES)],
    )
    label = F.when(F.col("frequency") + F.rand(9) * 20 > 55, 1.0).otherwise(0.0)
    train = numbers.withColumn("y_label", label).withColumn("target", F.lit("train"))
    table = train.unionByName(numbers.withColumn("target", F.lit("predict")), allowMissingColumns=True)
    return table.cache()


SETTINGS = [{"CLF_NAME": "LogisticRegression", "HYPERPARAMS": [{"penalty": ["l2"], "C": [1], "class_weight": ["balanced"]}]},
            {"CLF_NAME": "RandomForestClassifier", "HYPERPARAMS": {"n_estimators": [5], "max_depth": [3]}}]


def test_predictor(spark, features, tmp_path):
    first = predictor.train_purchase_predictor(features, SETTINGS, seed=1)
    again = predictor.train_purchase_predictor(features, SETTINGS, seed=1)
    assert rows(first.cv_scores) == rows(again.cv_scores)
    assert first.cv_scores.count() == 10
    scores = first.cv_scores.collect()
    assert all(0 <= r.fbeta <= 1 and r.fbeta >= r.fbeta_at_half - 1e-12 for r in scores)
    folds = [r.threshold for r in scores if r.candidate == first.candidate.name]
    assert first.threshold == pytest.approx(sum(folds) / 5)
    evaluation = {r.split: r for r in first.evaluation.collect()}
    assert evaluation["holdout"].fbeta > 0.7
    assert sum(evaluation["holdout"][c] for c in ("tn", "fp", "fn", "tp")) in (80, 81)
    found = predictor.predict_purchases(features, first.model, first.threshold)
    assert found.where("probability < 0 OR probability > 1").count() == 0
    buying, quiet = predictor.customers_buying(found).count(), predictor.customers_not_buying(found).count()
    assert buying > 0 and quiet > 0 and buying + quiet == 400
    assert rows(predictor.lookup_prediction(found, [999], ignore_missing=True)) == [(999, None)]
    with pytest.raises(KeyError):
        predictor.lookup_prediction(found, 999)

    base = str(tmp_path)
    datasets.save_model(first.model, base, "buyers", transformed=True, threshold=first.threshold)
    model, threshold = datasets.load_model(spark, base, "buyers", transformed=True)
    assert rows(predictor.predict_purchases(features, model, threshold)) == rows(found)
    with pytest.raises(IncompatibleTransformError):
        datasets.load_model(spark, base, "buyers", transformed=False)
    with pytest.raises(ModelNotFoundError):
        datasets.load_model(spark, base, "absent", transformed=True)
    with pytest.raises(NotTrainedError):
        predictor.predict_purchases(features, None, 0.5)
    table = datasets.evaluation_metrics(first.evaluation, "buyers", base)
    datasets.evaluation_metrics(first.evaluation, "buyers", base)  # a retry adds nothing
    assert table.count() == 12 and datasets.read_evaluations(spark, base).count() == 12
    datasets.evaluation_metrics(first.evaluation, "buyers", base, run="second")
    assert datasets.read_evaluations(spark, base).where("run = 'latest'").count() == 12
    assert datasets.read_evaluations(spark, base).count() == 24


@pytest.mark.parametrize("name", ["DecisionTreeClassifier", "GradientBoostingClassifier", "GaussianNB", "MLPClassifier"])
def test_every_classifier_fits(features, name):
    options = {"GradientBoostingClassifier": (("n_estimators", 2),), "MLPClassifier": (("hidden_layer_sizes", (3,)), ("max_iter", 5))}
    candidate = predictor.Candidate(name, options.get(name, ()))
    train = features.where("target = 'train'")
    scored = predictor.score(predictor.fit_candidate(candidate, train), train)
    assert scored.where("probability BETWEEN 0 AND 1").count() == 400


def test_standardized_features_have_population_deviation_one(features):
    train = features.where("target = 'train'")
    model = predictor.fit_candidate(predictor.Candidate("GaussianNB"), train)
    column = model.stages[2].transform(model.stages[1].transform(model.stages[0].transform(train)))
    from pyspark.ml.functions import vector_to_array

    first = vector_to_array("features")[0]
    row = column.select(F.avg(first).alias("m"), F.stddev_pop(first).alias("s")).first()
    assert row.m == pytest.approx(0, abs=1e-9) and row.s == pytest.approx(1)


@pytest.mark.parametrize(
    "settings, error",
    [
        ("LogisticRegression", TypeError),
        ([], ValueError),
        ([{}], KeyError),
        ([{"CLF_NAME": "SVC"}], NameError),
        ([{"CLF_NAME": "GaussianNB", "EXTRA": 1}], NameError),
        ([{"CLF_NAME": "LogisticRegression", "HYPERPARAMS": {"C": []}}], ValueError),
        ([{"CLF_NAME": "LogisticRegression", "HYPERPARAMS": {"C": 1}}], TypeError),
        ([{"CLF_NAME": "LogisticRegression", "HYPERPARAMS": {"depth": [1]}}], NameError),
    ],
)
def test_bad_settings(settings, error):
    with pytest.raises(error):
        predictor.candidate_grid(settings)


def test_grid_size():
    grid = [{"CLF_NAME": "LogisticRegression", "HYPERPARAMS": [
        {"penalty": ["l2"], "C": [1, 0.5, 0.1], "class_weight": ["balanced", None]}, {"penalty": ["none"]}]}]
    found = predictor.candidate_grid(grid)
    assert len(found) == 7 and len({c.name for c in found}) == 7


WHOLE = {"p": [1], "d": [1], "q": [1], "P": [0], "D": [0], "Q": [0], "m": [0]}


@pytest.mark.parametrize(
    "grid, error",
    [
        ([], TypeError),
        ({}, ValueError),
        ({"p": [1]}, KeyError),
        (WHOLE | {"x": [1]}, NameError),
        (WHOLE | {"p": 1}, TypeError),
        (WHOLE | {"p": []}, ValueError),
        (WHOLE | {"p": [1.5]}, TypeError),
    ],
)
def test_bad_arima_grids(grid, error):
    with pytest.raises(error):
        arima.check_arima_grid(grid)


@pytest.mark.parametrize("settings, error", [({}, ValueError), ({"LSTM": {}}, NameError), ({"GBTRegressor": {"maxIter": []}}, ValueError)])
def test_bad_regressors(settings, error):
    with pytest.raises(error):
        autoregression.regressor_grid(settings)


def test_arguments():
    contracts.check_model_name("model_1")
    for name, error in (("a b", ValueError), ("", ValueError), (3, TypeError)):
        with pytest.raises(error):
            contracts.check_model_name(name)
    for n, error in ((0, ValueError), (53, ValueError), ("4", TypeError), (True, TypeError)):
        with pytest.raises(error):
            contracts.check_n_periods(n)
    for size in (0, -1, 10, 11):
        with pytest.raises(ValueError):
            contracts.check_test_size(size, 10)
