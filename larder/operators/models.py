"""Menu-class models: preparation, training, comparison, saving and verification."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import DecisionTreeClassifier, LogisticRegression, RandomForestClassifier
from pyspark.ml.feature import Imputer, OneHotEncoder, StringIndexer, VectorAssembler
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from larder.config import DEFAULTS
from larder.functions.relational import with_scalars

# fixed values
NUMERIC = (
    "cost",
    "order_frequency",
    "distinct_customers",
    "line_count",
    "avg_rating",
    "rating_count",
    "total_consumption",
    "total_wasted",
    "total_wastage_cost",
    "discount_total",
    "max_price",
    "min_price",
    "qty_promoted",
    "repeat_customers",
    "early_rating",
    "recent_rating",
    "wastage_pct",
    "promotion_dependency",
)
CATEGORICAL = "category_name"
TARGET = "menu_class"


def hash_split(df: DataFrame, key: str, shares: tuple[float, float, float] = (0.7, 0.15, 0.15), seed: int = DEFAULTS.seed) -> DataFrame:
    """Repeatable train/validation/test split from a hash of the key, whatever the partitioning."""
    digest = F.md5(F.concat_ws(":", F.lit(str(seed)), F.col(key).cast("string")))
    place = F.conv(F.substring(digest, 1, 6), 16, 10).cast("double") / 16777216
    split = F.when(place < shares[0], "train").when(place < shares[0] + shares[1], "validation").otherwise("test")
    return df.withColumn("split", split)


def known_features(data: DataFrame) -> list[str]:
    """Numeric features with at least one value; the others cannot be imputed."""
    counts = data.agg(*[F.count(c).alias(c) for c in NUMERIC]).first()
    return [c for c in NUMERIC if counts[c] > 0]


def menu_class_stages(algo: str, numeric: Sequence[str] = NUMERIC, seed: int = DEFAULTS.seed) -> Pipeline:
    """Index label and category, impute, assemble, then classify."""
    numeric = list(numeric)
    imputed = [f"{c}_imputed" for c in numeric]
    classifiers = {
        "logistic_regression": LogisticRegression(featuresCol="features", labelCol="label", maxIter=100),
        "decision_tree": DecisionTreeClassifier(featuresCol="features", labelCol="label", maxDepth=5, seed=seed),
        "random_forest": RandomForestClassifier(featuresCol="features", labelCol="label", numTrees=50, maxDepth=6, seed=seed),
    }
    return Pipeline(
        stages=[
            StringIndexer(inputCol=TARGET, outputCol="label", handleInvalid="keep"),
            StringIndexer(inputCol=CATEGORICAL, outputCol="category_index", handleInvalid="keep"),
            OneHotEncoder(inputCol="category_index", outputCol="category_vector"),
            Imputer(inputCols=numeric, outputCols=imputed),
            VectorAssembler(inputCols=[*imputed, "category_vector"], outputCol="features", handleInvalid="keep"),
            classifiers[algo],
        ]
    )


ALGORITHMS = ("logistic_regression", "decision_tree", "random_forest")


def training_data(items: DataFrame, classes: DataFrame) -> DataFrame:
    """Item features with their class and split."""
    typed = items.withColumns({c: F.col(c).cast("double") for c in NUMERIC})
    return hash_split(typed.join(classes.select("menu_item_id", TARGET), "menu_item_id"), "menu_item_id")


def multiclass_metrics(scored: DataFrame) -> DataFrame:
    """Accuracy and class-weighted precision, recall and F1 from the confusion counts."""
    cells = scored.groupBy("label", "prediction").agg(F.count("*").alias("n"))
    hit = F.sum(F.when(F.col("label") == F.col("prediction"), F.col("n")).otherwise(0))
    actual = cells.groupBy("label").agg(F.sum("n").alias("actual"), hit.alias("hit"))
    predicted = cells.groupBy(F.col("prediction").alias("label")).agg(F.sum("n").alias("predicted"))
    per_class = actual.join(predicted, "label", "left")
    precision = F.coalesce(F.col("hit") / F.nullif(F.col("predicted"), F.lit(0)), F.lit(0.0))
    f1 = 2 * F.col("hit") / (F.col("actual") + F.coalesce("predicted", F.lit(0)))
    total = F.sum("actual")
    return per_class.agg(
        total.alias("rows"),
        F.round(F.sum("hit") / total, 4).alias("accuracy"),
        F.round(F.sum(f1 * F.col("actual")) / total, 4).alias("f1"),
        F.round(F.sum(precision * F.col("actual")) / total, 4).alias("precision"),
        F.round(F.sum("hit") / total, 4).alias("recall"),
    )


def fit_models(data: DataFrame, algorithms: tuple[str, ...] = ALGORITHMS) -> dict[str, PipelineModel]:
    train = data.where("split = 'train'")
    numeric = known_features(train)
    return {a: menu_class_stages(a, numeric).fit(train) for a in algorithms}


def compare_models(models: Mapping[str, PipelineModel], data: DataFrame) -> DataFrame:
    """Validation and test metrics per model, best test F1 first."""
    rows = [
        multiclass_metrics(m.transform(data.where(F.col("split") == s))).withColumns({"model": F.lit(a), "split": F.lit(s)})
        for a, m in models.items()
        for s in ("validation", "test")
    ]
    return reduce(DataFrame.unionByName, rows).orderBy(F.desc("split"), F.desc("f1"), "model")


def verify_model(path: str, df: DataFrame) -> DataFrame:
    """Load a saved model, score the data and check that every row got a prediction."""
    scored = PipelineModel.load(path).transform(df)
    counts = scored.agg(F.count("prediction").alias("prediction_rows"))
    checked = with_scalars(counts, df.agg(F.count("*").alias("dataset_rows")))
    return checked.withColumn(
        "status", F.when(F.col("prediction_rows") == F.col("dataset_rows"), "VERIFIED").otherwise("FAILED")
    )


def handoff_summary(parts: Mapping[str, tuple[DataFrame, str, str, str]]) -> DataFrame:
    """Rows of several metric frames as component, model, two named metrics and status.

    ``parts`` maps a component to (frame, model column, first metric, second metric).
    """
    frames = [
        df.select(
            F.lit(component).alias("component"),
            F.col(model).cast("string").alias("model"),
            F.lit(m1).alias("metric_1_name"),
            F.col(m1).cast("double").alias("metric_1"),
            F.lit(m2).alias("metric_2_name"),
            F.col(m2).cast("double").alias("metric_2"),
            F.when(F.col(m1).isNull(), "Incomplete").otherwise("Completed").alias("status"),
        )
        for component, (df, model, m1, m2) in parts.items()
    ]
    return reduce(DataFrame.unionByName, frames)
