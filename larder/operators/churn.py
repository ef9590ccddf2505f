"""Churn cohorts, class weights, models, scores and metrics."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import GBTClassifier, LogisticRegression, RandomForestClassificationModel, RandomForestClassifier
from pyspark.ml.feature import StandardScaler, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from larder.config import DEFAULTS
from larder.functions.relational import existence_flag, running_total, with_scalars
from larder.functions.scalar import dbl, elapsed_days, ratio, rnd
from larder.operators import forest
from larder.operators.customers import customer_behaviour, rfm_scores

# fixed values: columns of the churn models
FEATURES = (
    "recency",
    "frequency",
    "monetary",
    "aov",
    "distinct_items",
    "r_score",
    "f_score",
    "m_score",
    "promo_sensitivity",
    "peak_ratio",
    "weekend_ratio",
    "freq_recent_90d",
    "freq_trend",
    "avg_days_between_orders",
    "distinct_categories",
)


def churn_cohorts(
    tables: Mapping[str, DataFrame],
    spec: Mapping[str, tuple[str, str, str]],
    inclusive_end: bool = True,
    stage: Callable[[DataFrame, str], DataFrame] = lambda df, name: df,
) -> DataFrame:
    """Features and label of every cohort ``{name: (feature_end, label_start, label_end)}``.

    Each order is tagged with the cohorts whose feature window holds it, so all cohorts come
    from one pass over orders and lines, which are reduced to cohort, customer and item for all that follows. Features use completed orders before ``feature_end``.
    ``stage`` may write the item and customer totals, which are read several times.
    """
    done = tables["Orders"].where((F.col("order_status") == "completed") & F.col("customer_id").isNotNull())
    cohorts = F.array(
        *[
            F.struct(
                F.lit(name).alias("cohort"),
                F.lit(end).cast("date").alias("feature_end"),
                F.lit(first).cast("date").alias("label_start"),
                F.lit(last).cast("date").alias("label_end"),
            )
            for name, (end, first, last) in spec.items()
        ]
    )
    tagged = done.select("*", F.explode(cohorts).alias("_k")).select("*", "_k.*").drop("_k")
    window = tagged.where(F.col("order_timestamp") < F.col("feature_end").cast("timestamp"))
    by = ["cohort", "customer_id"]

    visits = window.groupBy(*by, "feature_end").agg(
        F.max("order_timestamp").alias("last_order"), F.countDistinct("order_id").alias("frequency")
    )
    per_item = (
        tables["Order_Items"]
        .select("order_id", "menu_item_id", "line_total")
        .join(window.select("order_id", *by), "order_id")
        .groupBy(*by, "menu_item_id")
        .agg(F.sum("line_total").alias("spent"), F.count("*").alias("n_lines"))
    )
    per_item = stage(per_item, "churn_items")
    spend = per_item.groupBy(*by).agg(F.sum("spent").alias("monetary"), F.count("menu_item_id").alias("distinct_items"))
    base = (
        visits.join(spend, by, "left")
        .withColumn("monetary", F.coalesce(dbl("monetary"), F.lit(0.0)))
        .withColumn("distinct_items", F.coalesce("distinct_items", F.lit(0)))
        .withColumn("recency", elapsed_days("last_order", "feature_end"))
        .withColumn("aov", rnd(ratio("monetary", "frequency"), 2))
    )
    base = stage(base, "churn_base")
    behaviour = customer_behaviour(
        window, tables["Order_Items"], tables["Menu_Items"], tables["Menu_Categories"], F.col("feature_end"), by=by, bought=per_item
    )
    joined = rfm_scores(base, by=["cohort"]).join(behaviour, by, "left").fillna(0, FEATURES)
    moment = F.to_date("order_timestamp") if inclusive_end else F.col("order_timestamp")
    last = F.col("label_end") if inclusive_end else F.col("label_end").cast("timestamp")
    active = tagged.where(
        (F.col("order_timestamp") >= F.col("label_start").cast("timestamp")) & (moment <= last)
    )
    labelled = existence_flag(joined, active, by, "_active")
    return labelled.where(F.col("frequency") > 0).select(
        "cohort",
        "customer_id",
        *[F.col(c) for c in FEATURES],
        F.col("_active").cast("int").alias("bought_later"),
        (1 - F.col("_active").cast("int")).alias("churn"),
    )


def class_weights(df: DataFrame, label: str, name: str = "class_weight") -> DataFrame:
    """Add n / (classes * class size) as weight column.

    The weights, one per class, travel as a map in a scalar subquery: joining on the label
    would send all rows to as many tasks as there are classes.
    """
    counts = df.groupBy(label).agg(F.count("*").alias("_c"))
    totals = counts.agg(F.sum("_c").alias("_n"), F.count("*").alias("_k"))
    weights = with_scalars(counts, totals).select(label, (F.col("_n") / (F.col("_k") * F.col("_c"))).alias("_w"))
    packed = weights.agg(F.map_from_entries(F.collect_list(F.struct(label, "_w"))).alias("m"))
    return df.withColumn(name, packed.scalar()[F.col(label)])


def train_classifier(
    df: DataFrame, algo: str, label: str = "churn", features: Sequence[str] | None = None, seed: int = DEFAULTS.seed, **params: float
) -> PipelineModel:
    """Fit ``logistic`` (on scaled features), ``random_forest`` or ``gradient_boosting``; classes are balanced."""
    features = features or FEATURES
    data = class_weights(df, label).withColumns({c: dbl(c) for c in [*features, label]})
    assembler = VectorAssembler(inputCols=list(features), outputCol="raw_features")
    common = {"labelCol": label, "weightCol": "class_weight"}
    if algo == "logistic":
        scaler = StandardScaler(inputCol="raw_features", outputCol="features", withMean=True, withStd=True)
        stages = [assembler, scaler, LogisticRegression(featuresCol="features", **common, **{"maxIter": 100, **params})]
    elif algo == "random_forest":
        # where the forest is left to Spark, the ids of the rows' nodes are kept, so a pass doesn't walk every tree from its root
        settings = {"numTrees": 300, "maxDepth": 12, "minInstancesPerNode": 5, "cacheNodeIds": True, **params}
        classifier = RandomForestClassifier(featuresCol="raw_features", seed=seed, **common, **settings)
        grown = forest.fit(classifier, data, features)
        if grown is not None:
            return PipelineModel([assembler, grown])
        stages = [assembler, classifier]
    elif algo == "gradient_boosting":
        boost = {"maxIter": 200, "maxDepth": 5, "stepSize": 0.05, **params}
        stages = [assembler, GBTClassifier(featuresCol="raw_features", seed=seed, **common, **boost)]
    else:
        raise ValueError(f"unknown algorithm {algo}")
    model = Pipeline(stages=stages).fit(data)
    if getattr(model.stages[-1], "hasSummary", False):
        # the summary holds the session, which no task can be sent once a frame has been observed in it
        model.stages[-1]._java_obj.setSummary(df.sparkSession._jvm.scala.Option.apply(None))
    return model


def score(model: PipelineModel, df: DataFrame, features: Sequence[str] | None = None) -> DataFrame:
    """Predicted class and probability of the positive class."""
    features = features or FEATURES
    prepared = df.withColumns({f: dbl(f) for f in features})
    *before, last = model.stages
    if isinstance(last, RandomForestClassificationModel) and last.numClasses == 2 and not last.isSet("thresholds"):
        ready = PipelineModel(before).transform(prepared).withColumn("_values", vector_to_array(last.getFeaturesCol()))
        return forest.score(last, ready, df.columns, "_values")
    out = model.transform(prepared)
    return out.select(
        *df.columns,
        F.col("prediction").cast("int").alias("prediction"),
        vector_to_array("probability")[1].alias("probability"),
    )


def feature_importance(model: PipelineModel, like: DataFrame, features: Sequence[str] | None = None) -> DataFrame:
    """Importance per feature of a tree model, greatest first."""
    values = model.stages[-1].featureImportances.toArray()
    rows = [(f, round(float(v), 4)) for f, v in zip(features or FEATURES, values, strict=True)]
    return like.sparkSession.createDataFrame(rows, "feature string, importance double").orderBy(F.desc("importance"), "feature")


def fixed_test_cases(df: DataFrame, n: int = 100, seed: int = DEFAULTS.seed, key: str = "customer_id") -> DataFrame:
    """A repeatable sample of n rows with ids TC_001, TC_002, ..."""
    draw = F.md5(F.concat_ws(":", F.lit(str(seed)), F.col(key).cast("string")))
    picked = df.withColumn("_draw", draw).orderBy("_draw", key).limit(n)
    place = F.row_number().over(Window.partitionBy(F.lit(0)).orderBy("_draw", key))  # n rows
    return picked.select(F.format_string("TC_%03d", place).alias("record_id"), *df.columns)


def sample_predictions(scored: DataFrame, label: str = "churn", n: int = 100, key: str = "customer_id") -> DataFrame:
    return scored.orderBy(key).limit(n).select(
        key,
        F.col(label).alias("actual"),
        F.col("prediction").alias("predicted"),
        F.round("probability", 4).alias("probability"),
    )


def confusion_matrix(df: DataFrame, label: str, prediction: str) -> DataFrame:
    return df.groupBy(F.col(label).alias("actual"), F.col(prediction).alias("predicted")).agg(F.count("*").alias("n"))


def _f1(tp: Column, fp: Column, fn: Column) -> Column:
    return F.coalesce(2 * tp / F.nullif(2 * tp + fp + fn, F.lit(0)), F.lit(0.0))


def binary_metrics(df: DataFrame, label: str = "churn", prediction: str = "prediction", probability: str = "probability") -> DataFrame:
    """Confusion counts, accuracy, precision, recall, F1, macro F1 and area under the ROC curve.

    The curve area comes from the counts per distinct probability and their running sum.
    """
    y, p = F.col(label) == 1, F.col(prediction) == 1
    cells = df.agg(
        F.count("*").alias("n"),
        F.count_if(y & p).alias("tp"),
        F.count_if(~y & p).alias("fp"),
        F.count_if(y & ~p).alias("fn"),
        F.count_if(~y & ~p).alias("tn"),
    )
    hist = df.groupBy(F.col(probability).alias("x")).agg(
        F.count_if(y).alias("pos"), F.count_if(~y).alias("neg")
    )
    run = running_total(hist, [], ["x"], "neg", "neg_upto", "neg_all")
    area = run.agg(
        F.sum(F.col("pos") * (F.col("neg_upto") - F.col("neg") / 2)).alias("u"),
        F.sum("pos").alias("pos_all"),
        F.max("neg_all").alias("neg_all"),
    ).select((F.col("u") / F.nullif(F.col("pos_all") * F.col("neg_all"), F.lit(0))).alias("auc"))
    tp, fp, fn, tn = (F.col(c) for c in ("tp", "fp", "fn", "tn"))
    zero = F.lit(0.0)
    return with_scalars(cells, area).select(
        "n",
        "tp",
        "fp",
        "fn",
        "tn",
        F.round((tp + tn) / F.col("n"), 4).alias("accuracy"),
        F.round(F.coalesce(tp / F.nullif(tp + fp, F.lit(0)), zero), 4).alias("precision"),
        F.round(F.coalesce(tp / F.nullif(tp + fn, F.lit(0)), zero), 4).alias("recall"),
        F.round(_f1(tp, fp, fn), 4).alias("f1"),
        F.round((_f1(tp, fp, fn) + _f1(tn, fn, fp)) / 2, 4).alias("macro_f1"),
        F.round("auc", 4).alias("auc"),
    )
