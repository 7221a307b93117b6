from __future__ import annotations

import numpy as np
import pytest
from pyspark.ml import Pipeline
from pyspark.ml.classification import GBTClassifier, RandomForestClassifier
from pyspark.ml.feature import OneHotEncoder, SQLTransformer, StringIndexer, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from txguard.operators import trees


def _rows(spark, n=3000):
    """Few values per column, so that MLlib's thresholds and ours are the same."""
    h = lambda k: F.pmod(F.xxhash64("id", F.lit(k)), F.lit(1000))
    d = spark.range(n).select("id", (h(1) % 20).cast("double").alias("a__num"), (h(2) % 7 / 3).alias("b__num"),
                              F.concat(F.lit("m"), h(3) % 40).alias("m__cat"), F.concat(F.lit("g"), h(4) % 3).alias("g__cat"), h(5).alias("noise"))
    risk = F.col("a__num") * 20 + F.when(F.col("m__cat").isin("m3", "m17"), 400).otherwise(0) + F.col("noise") / 4
    return d.withColumn("is_fraud", (risk > 500).cast("int")).withColumn("w", F.when(F.col("is_fraud") == 1, 3.5).otherwise(0.75)).repartition(3).cache()


def _prefix():
    cats = ["m", "g"]
    return Pipeline(stages=[
        SQLTransformer(statement="SELECT * FROM __THIS__"),
        *[StringIndexer(inputCol=f"{c}__cat", outputCol=f"{c}__idx", stringOrderType="alphabetAsc", handleInvalid="keep") for c in cats],
        OneHotEncoder(inputCols=[f"{c}__idx" for c in cats], outputCols=[f"{c}__ohe" for c in cats], dropLast=True, handleInvalid="error"),
        VectorAssembler(inputCols=["a__num", "b__num", "m__ohe", "g__ohe"], outputCol="features")])


def _scores(model, d):
    return np.array([r[1] for r in model.transform(d).select("id", vector_to_array("probability")[1]).orderBy("id").collect()])


def _both(classifier, spark):
    d = _rows(spark)
    mllib = Pipeline(stages=[*_prefix().getStages(), classifier]).fit(d)
    return d, mllib, trees.fit_trees(classifier, _prefix(), d)


@pytest.mark.parametrize("direct", [True, False])
def test_a_tree_without_chance_is_that_of_mllib(spark, monkeypatch, direct):
    if not direct:      # features of a node looked up by hash, several rounds of trees, more chunks than partitions
        monkeypatch.setattr(trees, "TABLE", 1)
        monkeypatch.setattr(trees, "STATE_BYTES", 1)
        monkeypatch.setattr(trees, "CHUNK_ROWS", 400)
    rf = RandomForestClassifier(featuresCol="features", labelCol="is_fraud", weightCol="w", numTrees=1 if direct else 9, maxDepth=7, minInstancesPerNode=10,
                                bootstrap=False, featureSubsetStrategy="all", seed=1)
    d, mllib, ours = _both(rf, spark)
    assert np.abs(_scores(mllib, d) - _scores(ours, d)).max() < 1e-9
    assert [t.numNodes for t in mllib.stages[-1].trees] == [t.numNodes for t in ours.stages[-1].trees]


@pytest.mark.parametrize("collected", [trees.COLLECTED, 0])
def test_boosting_without_chance_is_that_of_mllib(spark, monkeypatch, collected):
    monkeypatch.setattr(trees, "COLLECTED", collected)      # 0: sums meet by range of places
    monkeypatch.setattr(trees, "CHECKPOINT_ROUNDS", 2)
    gbt = GBTClassifier(featuresCol="features", labelCol="is_fraud", weightCol="w", maxIter=6, maxDepth=4, stepSize=0.3, seed=1)
    d, mllib, ours = _both(gbt, spark)
    assert np.abs(_scores(mllib, d) - _scores(ours, d)).max() < 1e-6
    assert ours.stages[-1].treeWeights == mllib.stages[-1].treeWeights


def test_drawn_trees_learn_and_can_be_saved(spark, scratch):
    from pyspark.ml import PipelineModel
    d = _rows(spark)
    rf = RandomForestClassifier(featuresCol="features", labelCol="is_fraud", weightCol="w", numTrees=12, maxDepth=8, minInstancesPerNode=10, seed=4)
    gbt = GBTClassifier(featuresCol="features", labelCol="is_fraud", weightCol="w", maxIter=12, maxDepth=3, stepSize=0.2, subsamplingRate=0.8, featureSubsetStrategy="0.8", seed=4)
    y = np.array([r[0] for r in d.select("is_fraud", "id").orderBy("id").collect()])
    for i, c in enumerate((rf, gbt)):
        model = trees.fit_trees(c, _prefix(), d)
        model.write().save(f"{scratch}/{i}")
        score = _scores(PipelineModel.load(f"{scratch}/{i}"), d)
        order = np.argsort(score, kind="stable")
        rank = np.empty(len(y))
        rank[order] = np.arange(len(y))
        auc = (rank[y == 1].mean() - (y.sum() - 1) / 2) / (y == 0).sum()
        assert auc > 0.9 and len(model.stages[-1].trees) == 12
        assert len({str(t.toDebugString) for t in model.stages[-1].trees}) == 12


@pytest.mark.parametrize("name, settings", [("m8_random_forest", {"RF_TREES": 4, "RF_DEPTH": 6}), ("m9_boosted_trees", {"GBT_ROUNDS": 4})])
def test_frames_of_many_rows_are_fitted_on_compact_rows(spark, monkeypatch, name, settings):
    import __spark_entry__ as E
    from tests.conftest import SF_SMALL
    from txguard.operators import models
    for k, v in {"FIT_ROWS": 500, **settings}.items():
        monkeypatch.setattr(models, k, v)
    fitted = []
    monkeypatch.setattr(models, "fit_trees", lambda *a: fitted.append(trees.fit_trees(*a)) or fitted[-1])
    out = E.queries()[name](spark, SF_SMALL).collect()
    assert len(fitted) == 1 and len(out) == 300 and all(0 <= r["fraud_probability"] <= 1 for r in out)
    hit = [r["fraud_probability"] for r in out if r["label"] == 1]
    miss = [r["fraud_probability"] for r in out if r["label"] == 0]
    assert sum(hit) / len(hit) > sum(miss) / len(miss) + 0.1
