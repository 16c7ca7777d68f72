"""Propensity-to-buy: features, label, imputation, model, scores."""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from touchpath.functions import columns as c
from touchpath.functions.scans import (
    CHUNK,
    KEY,
    is_last,
    is_last_of_day,
    last_before,
    running_sum,
    sum_ahead,
    sum_within,
    with_scans,
)
from touchpath.operators import medians, trees
from touchpath.operators.cleaning import accepted, filtered, with_advisor_flag, with_defaults, with_normal_fund
from touchpath.operators.dedup import TOTAL_ORDER, keep_one
from touchpath.operators.skew import Heavy, arrange, use_checkpoints
from touchpath.settings import ACTIVITY_TYPES, DEMOGRAPHICS, ModelSettings, Settings
from touchpath.sources.scratch import written

# rows of the training table in one task
TRAINING_ROWS = 500_000
DAY_END = "is_last_of_day"


@dataclass(frozen=True)
class FeatureSet:
    """Which columns a model version uses."""

    counted_types: tuple[str, ...]
    advisor_type: bool
    drop_repeats: bool

    @property
    def counters(self) -> dict[str, str]:
        return {kind: kind.replace(".", "_").lower() + "_90" for kind in self.counted_types}

    @property
    def columns(self) -> list[str]:
        extra = ["advisor_type"] if self.advisor_type else []
        return [
            *DEMOGRAPHICS, *extra, "unique_funds_sale", "unique_funds", "rt365", "rt180", "rt90", "tickets90",
            *self.counters.values(), "days_till_last_sale",
        ]


FIRST_FEATURES = FeatureSet(
    counted_types=tuple(t for t in ACTIVITY_TYPES if t not in ("Sale", "Selling.Agreement")),
    advisor_type=False,
    drop_repeats=False,
)
SECOND_FEATURES = FeatureSet(
    counted_types=tuple(t for t in ACTIVITY_TYPES if t != "Sale"),
    advisor_type=True,
    drop_repeats=True,
)


def propensity_rows(
    activity: DataFrame, fund_map: DataFrame, features: FeatureSet, settings: Settings, heavy: Heavy | None
) -> DataFrame:
    """Wanted activities plus one present-day row per contact and set of demographics."""
    logged = filtered(accepted(activity), settings)
    person = ["contact_id", "contact_name", *DEMOGRAPHICS, "advisor_type"]
    content = ["activity_type", "activity_date", "seq", "sales_amount", "fund_code", "additional_detail"]
    real = with_normal_fund(logged.select(*person, *content), fund_map).withColumn("branch", F.lit(1))
    present = (
        logged.select(*person)
        .distinct()
        .withColumns(
            {
                "activity_type": F.lit(None).cast("string"),
                "activity_date": F.lit(settings.as_of),
                "seq": F.concat_ws("|", *[F.coalesce(F.col(name).cast("string"), F.lit("")) for name in person[1:]]),
                "sales_amount": F.lit(None).cast("decimal(18,2)"),
                "fund_code": F.lit(""),
                "additional_detail": F.lit(""),
                "branch": F.lit(2),
            }
        )
    )
    rows = with_defaults(with_advisor_flag(real.unionByName(present)), settings)
    repeats = ("contact_id", "activity_date", "activity_type", "fund_code", "additional_detail")
    return arrange(rows, heavy, repeats if features.drop_repeats else (), log_rows=settings.log_rows)


def with_fund_counts(rows: DataFrame) -> DataFrame:
    """Running number of distinct funds sold, and of distinct non-empty funds met."""
    sold = F.col("activity_type") == "Sale"
    if CHUNK not in rows.columns:
        order = Window.partitionBy(KEY, "fund_code").orderBy(*TOTAL_ORDER)
        sales_so_far = F.sum(sold.cast("int")).over(order.rowsBetween(Window.unboundedPreceding, 0))
        rows = rows.withColumns(
            {
                "_first_sale": sold & (sales_so_far == 1),
                "_first_met": (F.row_number().over(order) == 1) & (F.col("fund_code") != ""),
            }
        )
    else:
        rows = _flag_first(rows, "_first_sale", sold)
        rows = _flag_first(rows, "_first_met", F.col("fund_code") != "")
    scans = {
        "unique_funds_sale": running_sum(F.col("_first_sale").cast("int")),
        "unique_funds": running_sum(F.col("_first_met").cast("int")),
    }
    return with_scans(rows, scans).drop("_first_sale", "_first_met")


def _flag_first(rows: DataFrame, name: str, condition: Column) -> DataFrame:
    """Flag the first row per contact and fund that meets a condition, without gathering the group."""
    identity = [KEY, *TOTAL_ORDER]
    firsts = keep_one(rows.where(condition).select(*identity, "fund_code"), [KEY, "fund_code"])
    return rows.join(firsts.select(*identity, F.lit(True).alias(name)), identity, "left").withColumn(
        name, F.coalesce(name, F.lit(False))
    )


def feature_rows(
    activity: DataFrame,
    fund_map: DataFrame,
    features: FeatureSet,
    settings: Settings,
    *,
    heavy: Heavy | None = None,
) -> DataFrame:
    """Features and label on every row after the feature floor.

    The order of the steps is part of the result: funds are counted over the
    whole log, everything trailing only over rows after the floor.
    """
    rows = with_fund_counts(propensity_rows(activity, fund_map, features, settings, heavy))
    rows = rows.where(F.col("activity_date") > F.lit(settings.feature_floor))
    kind, amount = F.col("activity_type"), F.col("sales_amount")
    sale = (kind == "Sale").cast("int")
    scans = {
        "rt365": sum_within(amount, 365),
        "rt180": sum_within(amount, 180),
        "rt90": sum_within(amount, 90),
        "tickets90": sum_within(((kind == "Sale") & (amount > 0)).cast("int"), 90),
    }
    scans |= {name: sum_within((kind == counted).cast("int"), 90) for counted, name in features.counters.items()}
    scans |= {
        "_last_sale": last_before(F.when(kind == "Sale", F.col("activity_date"))),
        "_sales_ahead": sum_ahead(sale, settings.label_days),
        "is_last": is_last(),
    }
    return (
        with_scans(rows, scans)
        .withColumn("days_till_last_sale", c.days_or(F.date_diff(F.col("activity_date"), F.col("_last_sale"))))
        # a sale later on, not counting the row itself
        .withColumn("sale_in_35", F.when(F.col("_sales_ahead") - sale > 0, 1).otherwise(0))
        .drop("_last_sale", "_sales_ahead")
    )


def _mature(settings: Settings) -> Column:
    return (F.col("activity_date") > F.lit(settings.training_floor)) & (
        F.col("activity_date") < F.date_sub(F.lit(settings.as_of), settings.label_days)
    )


def training_rows(rows: DataFrame, settings: Settings) -> DataFrame:
    """Last row per contact and day among those old enough for the label to be known."""
    return keep_one(rows.where(_mature(settings)), ["contact_id", "activity_date"], keep_last=True)


def with_day_ends(rows: DataFrame) -> DataFrame:
    """Flag the last row per contact and day of ``feature_rows``, on their sort, so that no one has to look for it."""
    return with_scans(rows, {DAY_END: is_last_of_day()})


def scoring_rows(rows: DataFrame) -> DataFrame:
    """Last row of each contact."""
    return rows.where("is_last")


def exact_medians(rows: DataFrame, names: Sequence[str]) -> DataFrame:
    """One row with the exact median of each column, missing values ignored."""
    found = medians.exact_medians(rows, names)
    schema = ", ".join(f"`{name}` double" for name in names)
    return rows.sparkSession.createDataFrame([tuple(found[name] for name in names)], schema)


def impute_medians(rows: DataFrame, population: DataFrame, names: Sequence[str] = DEMOGRAPHICS) -> DataFrame:
    """Replace missing and non-positive values by the median of all values in ``population``, a written table."""
    found = medians.exact_medians(population, names)
    return rows.withColumns(
        {
            name: F.when((F.col(name) > 0) & ~F.isnan(name), F.col(name).cast("double")).otherwise(
                F.lit(found[name]).cast("double")
            )
            for name in names
        }
    )


def fit(training: DataFrame, features: FeatureSet, model: ModelSettings) -> PipelineModel:
    """Boosted trees with logistic loss."""
    # training reads its input many times: written once, it is not derived again
    return _fit(_dealt(written(_numeric(training, features), "training"), features), features, model)


def _fit(training: DataFrame, features: FeatureSet, model: ModelSettings) -> PipelineModel:
    use_checkpoints(training.sparkSession)  # the trees cut their lineage there every ten rounds
    boosted = GBTClassifier(
        featuresCol="features",
        labelCol="sale_in_35",
        maxIter=model.rounds,
        stepSize=model.step_size,
        maxDepth=model.max_depth,
        subsamplingRate=model.subsample,
        seed=model.seed,
    )
    assembler = VectorAssembler(inputCols=features.columns, outputCol="features")
    return Pipeline(stages=[assembler, boosted]).fit(training)


def _parts(training: DataFrame, rows_per_task: int) -> int | None:
    """Parts to deal a training table over; None where it has no more rows than the cores can take as it is."""
    parts = math.ceil(training.count() / rows_per_task)
    return parts if parts > training.sparkSession.sparkContext.defaultParallelism else None


def _dealt(training: DataFrame, features: FeatureSet, rows_per_task: int = TRAINING_ROWS) -> DataFrame:
    """A training table in as many parts as its rows need. A scan makes hardly more parts than there are
    cores, and each part is kept and read whole in every round. The order in a part decides what a round samples."""
    parts = _parts(training, rows_per_task)
    if parts is None:
        return training
    return training.repartition(parts, KEY).sortWithinPartitions(KEY, *features.columns, "sale_in_35")


def scoring_input(rows: DataFrame) -> DataFrame:
    """Each contact's last row, imputed by the medians of all rows of ``rows``, a written table."""
    return impute_medians(scoring_rows(rows), rows)


def fit_on_mature(
    rows: DataFrame, features: FeatureSet, settings: Settings, model: ModelSettings, rows_per_task: int = TRAINING_ROWS
) -> PipelineModel:
    """Train on the mature rows of ``rows``, a written table, with or without day ends.

    Rows that must be dealt, because they are many, are taken by their day ends and go to training without being gathered
    per day and written on the way. The rows and their order are those of the other way.
    """
    if DAY_END in rows.columns:
        mature = rows.where(_mature(settings) & F.col(DAY_END))
        if _parts(mature, rows_per_task):
            training = _numeric(impute_medians(mature, mature), features)
            return _fit(_dealt(training, features, rows_per_task), features, model)
    mature = written(training_rows(rows.drop(DAY_END), settings), "mature")
    return fit(impute_medians(mature, mature), features, model)


def fit_and_score(rows: DataFrame, features: FeatureSet, settings: Settings, model: ModelSettings) -> DataFrame:
    """Train on the mature rows and score each contact's last row, from one written copy of the features."""
    rows = written(rows, "features")
    return score(fit_on_mature(rows, features, settings, model), scoring_input(rows), features)


def fit_and_score_by_nodes(
    rows: DataFrame, features: FeatureSet, settings: Settings, model: ModelSettings
) -> DataFrame:
    """As ``fit_and_score``, but the scores come from the exported nodes of the trees."""
    rows = written(rows, "features")
    nodes = trees.export_nodes(rows.sparkSession, fit_on_mature(rows, features, settings, model), features.columns)
    return trees.score_by_nodes(scoring_input(rows), nodes, features.columns, ["contact_id", "contact_name"])


def score(model: PipelineModel, rows: DataFrame, features: FeatureSet) -> DataFrame:
    """Probability of a sale for each row's contact."""
    scored = model.transform(_numeric(rows, features))
    return scored.select(
        "contact_id", "contact_name", vector_to_array("probability")[1].alias("prediction")
    )


def area_under_curve(model: PipelineModel, rows: DataFrame, features: FeatureSet) -> float:
    evaluator = BinaryClassificationEvaluator(labelCol="sale_in_35", metricName="areaUnderROC")
    return evaluator.evaluate(model.transform(_numeric(rows, features)))


def _numeric(rows: DataFrame, features: FeatureSet) -> DataFrame:
    names = [*features.columns, "sale_in_35"]
    return rows.select("contact_id", "contact_name", *[F.col(name).cast("double").alias(name) for name in names])
