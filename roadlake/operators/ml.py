"""Training and scoring of the accident severity model."""

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.evaluation import BinaryClassificationEvaluator, MulticlassClassificationEvaluator
from pyspark.ml.feature import Imputer, VectorAssembler
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from roadlake import rules, schemas
from roadlake.session import materialize


def training_rows(features: DataFrame, severe=rules.SEVERE_LEVELS) -> DataFrame:
    """Inputs as floats (an absent one is 0) and ``label``, 1 for a severe accident.

    Without any severity column the label is heavy rain.
    """
    rows = schemas.ensure_columns(features, rules.MODEL_FEATURES)
    level = next((c for c in ("accident_severity", "severity") if c in features.columns), None)
    positive = F.col(level).isin(*severe) if level else F.col("rainfall_mm") > rules.HEAVY_RAIN
    return rows.withColumn("label", F.when(positive, 1.0).otherwise(0.0))


def split(rows: DataFrame, key: str, train_share: float = rules.TRAIN_SHARE, seed: int = 42) -> tuple[DataFrame, DataFrame]:
    """Split by the MD5 of the key: the same rows on any cluster, in any partitioning and in any engine."""
    digest = F.md5(F.concat(F.lit(f"{seed}:"), F.col(key).cast("string")).cast("binary"))
    place = F.conv(F.left(digest, F.lit(8)), 16, 10).cast("long") % 1000
    is_train = F.coalesce(place < int(train_share * 1000), F.lit(True))
    return rows.filter(is_train), rows.filter(~is_train)


def imputer() -> Imputer:
    """Missing inputs become the median. Fit it on the one row of ``medians``, of which each median is itself."""
    names = list(rules.MODEL_FEATURES)
    return Imputer(inputCols=names, outputCols=names, strategy="median")


def medians(rows: DataFrame, names=rules.MODEL_FEATURES) -> DataFrame:
    """One row: the exact median of each input, the lower one of two; NULL and NaN do not count.

    Equal values are counted before the shuffle. The counts are cut into ranges as in ``ids``, and only the range in which a
    median lies is looked through, so no task holds the values of a column.
    """
    spark = rows.sparkSession
    measures = F.array(*[F.struct(F.lit(c).alias("name"), F.col(c).cast("double").alias("value")) for c in names])
    counts = rows.select(F.inline(measures)).filter("value IS NOT NULL AND NOT isnan(value)")
    counts = counts.groupBy("name", "value").agg(F.count("*").alias("n"))
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    ranges = counts.repartitionByRange(parts, "name", "value").withColumn("_part", F.spark_partition_id())
    ranges = materialize(ranges, "value-counts")
    sizes = ranges.groupBy("name", "_part").agg(F.sum("n").alias("_size"))  # a row for each partition and name at most
    up_to = Window.partitionBy("name").orderBy("_part")
    sizes = sizes.withColumns({
        "_before": F.sum("_size").over(up_to) - F.col("_size"),
        "_rank": F.expr("(sum(_size) OVER (PARTITION BY name) + 1) DIV 2"),
    })
    hit = sizes.filter((F.col("_before") < F.col("_rank")) & (F.col("_rank") <= F.col("_before") + F.col("_size")))
    inside = Window.partitionBy("name").orderBy("value")
    reached = ranges.join(F.broadcast(hit), ["name", "_part"]).withColumn("_reached", F.col("_before") + F.sum("n").over(inside))
    median = reached.filter("_reached >= _rank").groupBy("name").agg(F.min("value").alias("value"))
    return median.agg(*[F.max(F.when(F.col("name") == c, F.col("value"))).alias(c) for c in names])


def train(rows: DataFrame, forest=rules.FOREST) -> PipelineModel:
    """Exact median imputation, vector assembly and a random forest. Fails on too few rows."""
    fewest = rules.MIN_TRAINING_ROWS
    if len(rows.select(F.lit(1)).take(fewest)) < fewest:
        raise ValueError(f"training needs at least {fewest} rows")
    names = list(rules.MODEL_FEATURES)
    stages = [
        imputer().fit(medians(rows, names)),
        VectorAssembler(inputCols=names, outputCol="features", handleInvalid="keep"),
        RandomForestClassifier(labelCol="label", featuresCol="features", **forest),
    ]
    return Pipeline(stages=stages).fit(rows)


def evaluate(predictions: DataFrame) -> DataFrame:
    """One row: AUC-ROC, F1 and accuracy."""
    multi = MulticlassClassificationEvaluator(labelCol="label", predictionCol="prediction")
    row = (
        BinaryClassificationEvaluator(labelCol="label", metricName="areaUnderROC").evaluate(predictions),
        multi.evaluate(predictions, {multi.metricName: "f1"}),
        multi.evaluate(predictions, {multi.metricName: "accuracy"}),
    )
    return predictions.sparkSession.createDataFrame([row], "auc_roc double, f1 double, accuracy double")


def confusion(predictions: DataFrame) -> DataFrame:
    """Rows by label and prediction."""
    return predictions.groupBy("label", "prediction").agg(F.count("*").alias("rows"))


def f1_of(table: DataFrame) -> DataFrame:
    """Weighted F1 and accuracy from a confusion table, in SQL."""
    label = table.groupBy(F.col("label").alias("class")).agg(F.sum("rows").alias("own"))
    guess = table.groupBy(F.col("prediction").alias("class")).agg(F.sum("rows").alias("told"))
    right = table.filter("label = prediction").select(F.col("label").alias("class"), F.col("rows").alias("hit"))
    each = label.join(guess, "class", "left").join(right, "class", "left").fillna(0, ["told", "hit"])
    return each.agg((F.sum(F.col("own") * 2 * F.col("hit") / (F.col("own") + F.col("told"))) / F.sum("own")).alias("f1"), (F.sum("hit") / F.sum("own")).alias("accuracy"))


def auc_of(predictions: DataFrame, score: str = "score") -> DataFrame:
    """Area under the ROC curve from rank sums; equal scores share their mean rank. Rows are first counted by score, so ranks
    are running sums over the different scores, cut into ranges as in ``ids``."""
    counts = predictions.groupBy(score).agg(F.count("*").alias("n"), F.count_if(F.col("label") == 1).alias("positive"))
    n = int(predictions.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    parts = materialize(counts.repartitionByRange(n, score).withColumn("_part", F.spark_partition_id()), "score-counts")
    offsets = parts.groupBy("_part").agg(F.sum("n").alias("size"))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)  # a row for each partition
    offsets = offsets.select("_part", F.coalesce(F.sum("size").over(before), F.lit(0)).alias("_before"))
    inside = Window.partitionBy("_part").orderBy(score)
    ranked = parts.join(F.broadcast(offsets), "_part").withColumn("rank", F.col("_before") + F.sum("n").over(inside) - (F.col("n") - 1) / 2)
    total = ranked.agg(F.sum(F.col("rank") * F.col("positive")).alias("ranks"), F.sum("positive").alias("p"), (F.sum("n") - F.sum("positive")).alias("q"))
    return total.select(((F.col("ranks") - F.col("p") * (F.col("p") + 1) / 2) / F.nullif(F.col("p") * F.col("q"), F.lit(0))).alias("auc"))


def save(model: PipelineModel, path: str) -> None:
    model.write().overwrite().save(path)


def score(rows: DataFrame, path: str) -> DataFrame:
    """Predictions of a saved model."""
    return PipelineModel.load(path).transform(rows)
