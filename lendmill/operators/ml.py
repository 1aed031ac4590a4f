"""Credit-default model: features, split, training, evaluation, scoring."""

from __future__ import annotations

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from lendmill.fixed_values import FEATURES, LABEL


def features(c360: DataFrame, key: str = "customer_id", fill: float = 0.0) -> DataFrame:
    """Key, the seven numeric features as doubles without gaps, and the label."""
    filled = [F.coalesce(F.col(c).cast("double"), F.lit(fill)).alias(c) for c in FEATURES]
    return c360.select(key, *filled, F.coalesce(F.col(LABEL), F.lit(0)).cast("double").alias(LABEL))


def in_test(key: Column, test_share: float = 0.2) -> Column:
    """Whether a key belongs to the test set: a hash of the key, so the split is
    the same whatever the partitioning and however often it is computed."""
    first = F.conv(F.substring(F.md5(key.cast("string").cast("binary")), 1, 7), 16, 10)
    return first.cast("long") % 10_000 < round(test_share * 10_000)


def split(df: DataFrame, key: str, test_share: float = 0.2) -> tuple[DataFrame, DataFrame]:
    """(train, test)"""
    is_test = in_test(F.col(key), test_share)
    return df.filter(~is_test), df.filter(is_test)


def train(df: DataFrame, rounds: int = 20, depth: int = 4, seed: int = 42) -> PipelineModel:
    """Boosted trees over the assembled features."""
    trees = GBTClassifier(
        labelCol=LABEL, featuresCol="features", maxIter=rounds, maxDepth=depth, seed=seed
    )
    return Pipeline(
        stages=[VectorAssembler(inputCols=list(FEATURES), outputCol="features"), trees]
    ).fit(df)


def predict(model: PipelineModel, df: DataFrame) -> DataFrame:
    return model.transform(df)


def roc_auc(scored: DataFrame, label: str = LABEL, score: str = "score") -> DataFrame:
    """One row: ``n_positive``, ``n_negative`` and ``roc_auc``, the share of pairs of a positive and a
    negative row in which the positive one scores higher, ties counting half.

    Rows are summed per score first, so a score that many rows share is one row. Scores are
    dealt in ranges; each range counts its own pairs in order, and what it adds to those of
    earlier ranges follows from their totals: a row per range, which is all that one task
    puts in order. Pairs are counted in whole numbers and divided once. Rows without a score
    or with another label than 0 and 1 do not count; without either label the area is missing.
    """
    per_score = (
        scored.filter(F.col(score).isNotNull() & F.col(label).isin(0, 1))
        .groupBy(F.col(score).alias("_score"))
        .agg(F.count_if(F.col(label) == 1).alias("_pos"), F.count_if(F.col(label) == 0).alias("_neg"))
    )
    ranged = per_score.repartitionByRange("_score").withColumn("_range", F.spark_partition_id())
    earlier = W.rowsBetween(W.unboundedPreceding, -1)

    def before(c: str, window) -> Column:
        return F.coalesce(F.sum(c).over(window), F.lit(0)).cast("decimal(38,0)")

    below = before("_neg", earlier.partitionBy("_range").orderBy("_score"))
    doubled = (F.col("_pos") * (2 * below + F.col("_neg"))).cast("decimal(38,0)")
    per_range = (
        ranged.withColumn("_doubled", doubled)
        .groupBy("_range")
        .agg(F.sum("_doubled").alias("_doubled"), F.sum("_pos").alias("_pos"), F.sum("_neg").alias("_neg"))
    )
    # a row per range: as many as there are partitions
    below = before("_neg", earlier.orderBy("_range"))
    whole = (F.col("_doubled") + F.col("_pos") * 2 * below).cast("decimal(38,0)")
    summed = per_range.select("_pos", "_neg", whole.alias("_whole")).agg(
        F.coalesce(F.sum("_pos"), F.lit(0)).alias("n_positive"),
        F.coalesce(F.sum("_neg"), F.lit(0)).alias("n_negative"),
        F.sum("_whole").alias("_whole"),
    )
    pairs = F.col("n_positive").cast("double") * F.col("n_negative")
    area = F.try_divide(F.col("_whole").cast("double"), 2 * pairs)
    return summed.select("n_positive", "n_negative", area.alias("roc_auc"))


def evaluate(pred: DataFrame) -> dict[str, float]:
    """Accuracy and area under the ROC curve; the rows are scored once."""
    margin = vector_to_array("rawPrediction")[1].alias("score")
    scored = pred.select(LABEL, "prediction", margin).persist()
    try:
        right = (F.col(LABEL) == F.col("prediction")).cast("double")
        accuracy = scored.agg(F.avg(right)).first()[0]
        area = roc_auc(scored).first()["roc_auc"]
    finally:
        scored.unpersist()
    return {"accuracy": accuracy, "roc_auc": area}


def confusion(pred: DataFrame) -> DataFrame:
    """Actual label by predicted label."""
    return (
        pred.groupBy(F.col(LABEL).cast("int").alias("actual"))
        .pivot("prediction", [0.0, 1.0])
        .count()
        .select(
            "actual",
            F.coalesce(F.col("`0.0`"), F.lit(0)).alias("predicted_0"),
            F.coalesce(F.col("`1.0`"), F.lit(0)).alias("predicted_1"),
        )
    )


def score(model: PipelineModel, rows: DataFrame, key: str = "customer_id") -> DataFrame:
    """Key and predicted probability of default, for every row."""
    probability = vector_to_array("probability")[1].alias("predicted_default_probability")
    return model.transform(rows).select(key, probability)


def importance(model: PipelineModel, n: int = 5) -> list[tuple[str, float]]:
    """The n features the trees gained most from."""
    weights = model.stages[-1].featureImportances.toArray()
    ranked = sorted(zip(FEATURES, (float(w) for w in weights)), key=lambda f: (-f[1], f[0]))
    return ranked[:n]


def target_balance(df: DataFrame, label: str = LABEL) -> DataFrame:
    return df.groupBy(label).agg(F.count(F.lit(1)).alias("n_rows"))


def summarize(df: DataFrame, columns: list[str]) -> DataFrame:
    """Count, minimum, maximum, mean and deviation per column, from one scan."""
    stats = {
        "n_values": F.count,
        "min_value": F.min,
        "max_value": F.max,
        "mean_value": F.avg,
        "stddev_value": F.stddev_samp,
    }
    wide = df.agg(
        *[fn(F.col(c).cast("double")).alias(f"{c}__{s}") for c in columns for s, fn in stats.items()]
    )
    rows = [
        F.struct(F.lit(c).alias("column_name"), *[F.col(f"{c}__{s}").alias(s) for s in stats])
        for c in columns
    ]
    return wide.select(F.inline(F.array(*rows)))


def _correlation(a: str, b: str) -> Column:
    """Pearson correlation; NULL where a column is constant."""
    return F.try_divide(F.covar_pop(a, b), F.stddev_pop(a) * F.stddev_pop(b))


def leakage(df: DataFrame) -> DataFrame:
    """Per feature: correlation with the label, and the share of label 1 among
    rows where the feature is zero (0 or 1 there gives the label away)."""
    label = F.col(LABEL)
    wide = df.agg(
        *[_correlation(c, LABEL).alias(f"{c}__corr") for c in FEATURES],
        *[F.count_if(F.col(c) == 0).alias(f"{c}__zeros") for c in FEATURES],
        *[F.avg(F.when(F.col(c) == 0, label)).alias(f"{c}__rate") for c in FEATURES],
    )
    rows = [
        F.struct(
            F.lit(c).alias("feature"),
            F.col(f"{c}__corr").alias("label_corr"),
            F.col(f"{c}__zeros").alias("n_zero"),
            F.col(f"{c}__rate").alias("label_rate_at_zero"),
        )
        for c in FEATURES
    ]
    return wide.select(F.inline(F.array(*rows)))


def save(
    spark: SparkSession, model: PipelineModel, path: str, version: str, metrics: dict[str, float]
) -> None:
    """Store a model version together with its metrics; a version is written once."""
    model.write().save(f"{path}/{version}/model")
    rows = [(version, name, float(value)) for name, value in sorted(metrics.items())]
    frame = spark.createDataFrame(rows, "version string, metric string, value double")
    frame.write.parquet(f"{path}/{version}/metrics")


def load(path: str, version: str) -> PipelineModel:
    return PipelineModel.load(f"{path}/{version}/model")
