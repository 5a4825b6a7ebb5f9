"""Rule classifier, its training step, and scoring with a saved model."""

from __future__ import annotations

import math
import warnings

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import DecisionTreeClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tracewarden.config import DEFAULTS, DetectionConfig
from tracewarden.schema import MODEL_COLUMNS
from tracewarden.session import written_table


def model_input(features: DataFrame, order: str = "packet_no") -> DataFrame:
    return features.select(order, *[F.col(c).cast("double").alias(c) for c in MODEL_COLUMNS])


def is_attack(inputs: list[str], cfg: DetectionConfig = DEFAULTS) -> Column:
    """1 or 0 from up to five input columns, in the order of ``MODEL_COLUMNS``.

    Missing trailing inputs count as 0. A value that is null or no number makes the result 0.
    NaN fails every test.
    """
    number = [F.expr(f"try_cast(`{c}` AS DOUBLE)") for c in inputs[:5]]
    bad = F.lit(False)
    for n in number:
        bad = bad | n.isNull()
    number += [F.lit(0.0)] * (5 - len(number))
    size, count, _, ports, _ = number
    above = lambda c, limit: (c > limit) & ~F.isnan(c)
    attack = above(ports, cfg.classifier_ports) | above(count, cfg.classifier_packets) | (
        (size < cfg.classifier_small_size) & above(count, cfg.classifier_small_packets))
    return F.when(bad, 0).when(attack, 1).otherwise(0)


def classify(features: DataFrame, inputs: list[str] | None = None) -> DataFrame:
    return features.withColumn("prediction", is_attack(list(inputs or MODEL_COLUMNS)))


def classify_proba(features: DataFrame, inputs: list[str] | None = None) -> DataFrame:
    """0.9 for the predicted class and 0.1 for the other."""
    p = is_attack(list(inputs or MODEL_COLUMNS))
    return features.withColumns({
        "p_normal": F.when(p == 1, 0.1).otherwise(0.9),
        "p_attack": F.when(p == 1, 0.9).otherwise(0.1),
    })


def anomalies(features: DataFrame) -> DataFrame:
    return classify(features).filter(F.col("prediction") == 1)


_BUCKETS = 4096


def exact_percentile(df: DataFrame, column: str, q: float) -> float | None:
    """Percentile with linear interpolation, exact at any size. Nulls and NaN don't count; infinite values are
    the smallest and largest, and between different values of which one is infinite the other is not interpolated to.

    Each round counts the values in ``_BUCKETS`` equal ranges (one small row per range) and keeps the
    range that holds the wanted rank, until few distinct values are left. Only those counts reach the
    driver, never the values of the data.
    """
    values = df.select(F.col(column).cast("double").alias("v")).filter(
        F.col("v").isNotNull() & ~F.isnan("v"))
    finite = F.abs("v") != math.inf
    low, high, under, inside, n = values.agg(
        F.min(F.when(finite, F.col("v"))), F.max(F.when(finite, F.col("v"))),
        F.count_if(F.col("v") == -math.inf), F.count_if(finite), F.count("v")).first()
    if not n:
        return None
    at = q * (n - 1)
    rank = math.floor(at)
    if rank < under:
        first = -math.inf
    elif rank >= under + inside:
        first = math.inf
    else:
        first = _value_at(values.filter(finite), low, high, rank - under)
    if rank == at:
        return first
    up_to, above = values.agg(
        F.count_if(F.col("v") <= first), F.min(F.when(F.col("v") > first, F.col("v")))).first()
    second = first if up_to > rank + 1 else above
    if first == second or math.isinf(first):
        return first
    return first + (second - first) * (at - rank)


def _value_at(values: DataFrame, low: float, high: float, rank: int) -> float:
    while low < high:
        width = (high - low) / _BUCKETS
        inside = values.filter(F.col("v").between(low, high))
        bucket = F.least(F.floor((F.col("v") - low) / F.lit(width)), F.lit(_BUCKETS - 1))
        counts = (
            inside.groupBy(bucket.alias("b"))
            .agg(F.count("v").alias("n"), F.min("v").alias("low"), F.max("v").alias("high"))
            .orderBy("low").collect()
        )
        for row in counts:
            if rank < row["n"]:
                break
            rank -= row["n"]
        low, high = row["low"], row["high"]
    return low


def fit_thresholds(labelled: DataFrame, inputs: list[str] | None = None, label: str = "label",
                   cfg: DetectionConfig = DEFAULTS) -> DataFrame:
    """Thresholds from the rows labelled 0; the classifier itself does not read them."""
    names = list(inputs or MODEL_COLUMNS)
    # Stored once: the percentiles take several passes, and features are costly to derive.
    normal = written_table(
        labelled.filter(F.col(label) == 0).select(*names[:3]), "normal-rows")
    row = (
        exact_percentile(normal, names[0], cfg.fit_high_quantile),
        exact_percentile(normal, names[1], cfg.fit_high_quantile),
        exact_percentile(normal, names[2], cfg.fit_low_quantile),
    )
    return labelled.sparkSession.createDataFrame(
        [row], "connection_rate double, unique_ports double, avg_size double")


#: Thresholds that a tree tries for each input; below so many distinct values it tries all.
TREE_BINS = 1024


def fit_tree(labelled: DataFrame, inputs: list[str] | None = None, label: str = "label", depth: int = 5) -> PipelineModel:
    """A decision tree over numeric inputs, as a pipeline that can be saved. Rows with a null or NaN input aren't learned from, and
    when scored they take the tree's way for NaN."""
    names = list(inputs or MODEL_COLUMNS)
    rows = labelled.select(*[F.col(c).cast("double").alias(c) for c in names], F.col(label).cast("double").alias(label))
    assembler = VectorAssembler(inputCols=names, outputCol="model_inputs", handleInvalid="keep")
    tree = DecisionTreeClassifier(featuresCol="model_inputs", labelCol=label, maxDepth=depth, maxBins=TREE_BINS, seed=7)
    return Pipeline(stages=[assembler, tree]).fit(rows.dropna())


def tree_sql(model: PipelineModel) -> str:
    """The splits of a fitted tree as a SQL expression over its inputs, which is scored inside generated code."""
    assembler, tree = model.stages
    names = assembler.getInputCols()

    def of(node) -> str:
        if node.getClass().getSimpleName() == "LeafNode":
            return f"{float(node.prediction())!r}D"
        split = node.split()
        test = f"CAST(`{names[split.featureIndex()]}` AS DOUBLE) <= {float(split.threshold())!r}D"
        return f"CASE WHEN {test} THEN {of(node.leftChild())} ELSE {of(node.rightChild())} END"

    return of(tree._java_obj.rootNode())


def load_model(spark: SparkSession, path: str) -> PipelineModel | None:
    """A saved Spark ML pipeline, or None where there is none."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    if not folder.getFileSystem(spark._jsc.hadoopConfiguration()).exists(folder):
        warnings.warn(f"model not found: {path}")
        return None
    return PipelineModel.load(path)


def model_metadata(model: PipelineModel | None) -> dict:
    if model is None:
        return {}
    counts = [getattr(stage, "numFeatures", None) for stage in model.stages]
    counts = [c for c in counts if c is not None and c >= 0]
    return {
        "model_name": type(model.stages[-1]).__name__,
        "feature_count": counts[-1] if counts else None,
    }


def model_score(features: DataFrame, model: PipelineModel | None, inputs: list[str] | None = None) -> DataFrame:
    """``prediction`` of the model; 0 for every row without a model."""
    if model is None:
        return features.withColumn("prediction", F.lit(0.0))
    expected = model_metadata(model)["feature_count"]
    names = list(inputs or MODEL_COLUMNS)
    if expected is not None and expected != len(names):
        warnings.warn(f"the model has {expected} features, the input {len(names)}")
    scored = model.transform(features)
    return scored.select(*features.columns, F.col("prediction").cast("double").alias("prediction"))
