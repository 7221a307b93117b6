"""Model candidates, training and evaluation (M6–M9, M11, M12) on MLlib."""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field

from pyspark import inheritable_thread_target
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import GBTClassifier, LogisticRegression, RandomForestClassifier
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from txguard.operators.features import prepare_features_and_target
from txguard.operators.metrics import Evaluation, build_thresholds, class_counts
from txguard.operators.preprocess import FEATURES_VECTOR, build_preprocessor
from txguard.operators.trees import fit_trees
from txguard.schemas import DEFAULT_ALERT_THRESHOLD

# --- Fixed values: split share, seed and candidate hyper-parameters equal the reference's. ---
TEST_SHARE = 0.20
RANDOM_STATE = 42
LR_MAX_ITER = 3000
LR_C = 1.0
RF_TREES, RF_DEPTH, RF_MIN_LEAF = 150, 18, 10
GBT_ROUNDS, GBT_DEPTH, GBT_RATE, GBT_SUBSAMPLE, GBT_COLSAMPLE = 300, 5, 0.05, 0.8, 0.8
# --- end of fixed values ---

FIT_ROWS = 13_000   # a frame of fewer rows stays as it was read and its trees are MLlib's: their draws follow from its partitions
_PREFIX = 5     # hexadecimal digits: about a million bins of the hash


def _hash(key: str) -> Column:
    return F.md5(F.col(key).cast("string"))


def with_test_flag(df: DataFrame, key: str = "trans_num", label: str = "is_fraud",
                   share: float = TEST_SHARE, name: str = "is_test") -> DataFrame:
    """M6: per class, the rows with the smallest key hashes are the test part:
    round(share * n) of a class with n rows.  It does not depend on
    partitioning or row order and is the same in any engine with ``md5``.

    The hash that ends the test part of a class is found from a histogram of
    hash prefixes (partial aggregation) and the rows of one bin per class, so
    no class is sorted in one task.  Rows with the same key stay together."""
    cls = F.col(label).alias("_class")
    bins = df.groupBy(cls, F.substring(_hash(key), 1, _PREFIX).alias("_bin")).agg(F.count(F.lit(1)).alias("_n"))
    order = Window.partitionBy("_class").orderBy("_bin")
    total = Window.partitionBy("_class")
    cut = (bins.withColumns({"_upto": F.sum("_n").over(order), "_want": F.round(F.sum("_n").over(total) * F.lit(share))})
           .where("_want > 0 AND _upto >= _want AND _upto - _n < _want")
           .select("_class", "_bin", (F.col("_want") - F.col("_upto") + F.col("_n")).cast("long").alias("_inside")))
    place = Window.partitionBy("_class").orderBy("_h")
    inside = (df.select(cls, _hash(key).alias("_h")).withColumn("_bin", F.substring("_h", 1, _PREFIX))
              .join(F.broadcast(cut), ["_class", "_bin"])          # one row per class
              .withColumn("_rank", F.row_number().over(place)).where("_rank = _inside")
              .groupBy("_class").agg(F.max("_h").alias("_last")))
    last = {r["_class"]: r["_last"] for r in inside.collect()}     # one row per class
    flag = F.lit(False)
    for c, h in sorted(last.items(), key=lambda x: str(x[0])):
        flag = F.when(F.col(label) == c, _hash(key) <= F.lit(h)).otherwise(flag)
    return df.withColumn(name, flag)


def split_train_test(df: DataFrame, key: str = "trans_num") -> tuple[DataFrame, DataFrame]:
    flagged = with_test_flag(df, key, name="_is_test")
    return (flagged.where(~F.col("_is_test")).drop("_is_test"),
            flagged.where(F.col("_is_test")).drop("_is_test"))


def with_class_weights(train: DataFrame, label: str = "is_fraud") -> tuple[DataFrame, float]:
    """Balanced weights ``n / (2 · n_class)`` in ``w`` and, for boosted trees,
    ``neg/pos`` on positives in ``w_pos`` (A4)."""
    row = class_counts(train, label).first()
    neg, pos = int(row["negatives"]), int(row["positives"])
    if pos == 0:
        raise ValueError("no positive class found in target")
    n = neg + pos
    ratio = neg / pos
    y = F.col(label)
    out = train.withColumns({
        "w": F.when(y == 1, F.lit(n / (2.0 * pos))).otherwise(F.lit(n / (2.0 * max(neg, 1)))),
        "w_pos": F.when(y == 1, F.lit(ratio)).otherwise(F.lit(1.0)),
    })
    return out, ratio


@dataclass
class Candidate:
    name: str
    classifier: object
    ordinal: int


def build_candidates(n_weighted: float, include_boosted: bool = True) -> list[Candidate]:
    """M7–M9 in the reference's order (ties in selection go to the first)."""
    lr = LogisticRegression(featuresCol=FEATURES_VECTOR, labelCol="is_fraud", weightCol="w",
                            maxIter=LR_MAX_ITER, regParam=1.0 / (LR_C * max(n_weighted, 1.0)),
                            elasticNetParam=0.0, standardization=False)
    rf = RandomForestClassifier(featuresCol=FEATURES_VECTOR, labelCol="is_fraud", weightCol="w",
                                numTrees=RF_TREES, maxDepth=RF_DEPTH, minInstancesPerNode=RF_MIN_LEAF,
                                seed=RANDOM_STATE)
    out = [Candidate("logistic_regression_balanced", lr, 0),
           Candidate("random_forest_balanced", rf, 1)]
    if include_boosted:
        gbt = GBTClassifier(featuresCol=FEATURES_VECTOR, labelCol="is_fraud", weightCol="w_pos",
                            maxIter=GBT_ROUNDS, maxDepth=GBT_DEPTH, stepSize=GBT_RATE,
                            subsamplingRate=GBT_SUBSAMPLE, featureSubsetStrategy=str(GBT_COLSAMPLE),
                            seed=RANDOM_STATE)
        out.append(Candidate("xgboost_weighted", gbt, 2))
    return out


@dataclass
class CandidateResult:
    name: str
    ordinal: int
    model: PipelineModel
    scored: DataFrame            # (trans_num, label, score) on the test split
    metrics: DataFrame           # (model, metric, value)
    extras: dict = field(default_factory=dict)


def class1_probability() -> Column:
    return vector_to_array(F.col("probability"))[1]


def fit_candidate(candidate: Candidate, train: DataFrame, test: DataFrame,
                  production_threshold: float = DEFAULT_ALERT_THRESHOLD,
                  preprocessor: Pipeline | None = None) -> CandidateResult:
    """Fit, score the test split, compute the logged metric rows."""
    pre = preprocessor or build_preprocessor(train)
    model = Pipeline(stages=[*pre.getStages(), candidate.classifier]).fit(train)
    scored = model.transform(test).select(
        F.lit(candidate.name).alias("model"), "trans_num",
        F.col("is_fraud").alias("label"), class1_probability().alias("score"))
    ev = Evaluation(scored)
    metrics = ev.metric_rows(production_threshold, build_thresholds(production_threshold))
    return CandidateResult(candidate.name, candidate.ordinal, model, scored, metrics,
                           {"evaluation": ev})


def training_frame(df: DataFrame) -> DataFrame:
    """M2 + weights, persisted once for all candidate fits."""
    return prepare_features_and_target(df, keep=("trans_num",))


@dataclass
class Fits:
    """The fitted candidates, and the frames their fits and scores share."""

    candidates: list[Candidate]
    models: dict[str, PipelineModel]
    held: list[DataFrame]

    def release(self) -> None:
        for df in self.held:
            df.unpersist()


def spread(df: DataFrame) -> DataFrame:
    """``df`` persisted, and dealt over as many partitions as the cluster has
    cores where one partition holds much more than its share.  Otherwise the row
    groups of the input files decide how many tasks every pass of a fit has: one
    group of 100,000 rows is one task, a thousand passes on one core."""
    df = df.persist()
    sizes = df.groupBy(F.spark_partition_id()).count().agg(F.sum("count").alias("n"), F.max("count").alias("most")).first()
    n, cores = sizes["n"] or 0, df.sparkSession.sparkContext.defaultParallelism
    want = min(cores, -(-n // FIT_ROWS))
    if not n or sizes["most"] * want <= 1.5 * n:
        return df
    even = df.repartition(max(want, df.rdd.getNumPartitions())).persist()
    even.count()
    df.unpersist()
    return even


def fit_candidates(df: DataFrame, include_boosted: bool = True, only: list[str] | None = None) -> tuple[Fits, DataFrame]:
    """Every candidate fitted on one persisted training frame, side by
    side, each in a scheduler pool of its own (a session with
    ``spark.scheduler.mode=FAIR`` shares the cluster among them).  Also the rows
    (model, trans_num, label, score) of the test part, scored by each."""
    train, test = split_train_test(training_frame(df))
    train, test = spread(with_class_weights(train)[0]), spread(test)
    spark, pre = df.sparkSession, build_preprocessor(train)
    n, odd = train.agg(F.count(F.lit(1)), F.count_if(~F.coalesce(F.col("is_fraud").isin(0, 1), F.lit(False)))).first()
    candidates = [c for c in build_candidates(float(n), include_boosted) if not only or c.name in only]

    def fit(candidate: Candidate) -> PipelineModel:
        spark.sparkContext.setLocalProperty("spark.scheduler.pool", candidate.name)
        if n > FIT_ROWS and not odd and not isinstance(candidate.classifier, LogisticRegression):
            return fit_trees(candidate.classifier, pre, train)
        return Pipeline(stages=[*pre.getStages(), candidate.classifier]).fit(train)

    with ThreadPoolExecutor(max_workers=len(candidates)) as pool:
        models = dict(zip([c.name for c in candidates], pool.map(inheritable_thread_target(spark)(fit), candidates), strict=True))
    scored = None
    for c in candidates:
        rows = models[c.name].transform(test).select(
            F.lit(c.name).alias("model"), F.col("trans_num").cast("string").alias("trans_num"),
            F.col("is_fraud").cast("int").alias("label"), class1_probability().alias("score"))
        scored = rows if scored is None else scored.unionByName(rows)
    return Fits(candidates, models, [train, test]), scored
