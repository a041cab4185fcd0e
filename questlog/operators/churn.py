"""A churn model on ``churn_features``: logistic regression, fitted where the users are."""

from __future__ import annotations

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.ml.feature import StandardScaler, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from questlog.functions import round_half_away
from questlog.operators.activity import LAST_CURVE_DAY

FEATURES = ["active_days", "sessions", "rounds_played", "purchases", "revenue_usd", "last_active_day"]
#: One user in so many is kept from the fit, by a hash of the id.
HOLD_OUT = 5
#: Strength of the ridge penalty on the coefficients of scaled features.
RIDGE = 1e-3


def held_out(userid: Column, one_in: int = HOLD_OUT) -> Column:
    return F.pmod(F.xxhash64(userid), F.lit(one_in)) == 0


def prepared(features: DataFrame) -> DataFrame:
    """Numbers for the model: a user without a session in the first week was last active on day -1."""
    values = {c: F.col(c).cast("double") for c in FEATURES}
    values["last_active_day"] = F.coalesce(values["last_active_day"], F.lit(-1.0))
    return features.withColumns(values).withColumn("label", F.col("churned").cast("double"))


def labelled(features: DataFrame, observed_until: Column) -> Column:
    """Whether the days that decide on churn had passed by the last day of the data."""
    return F.date_add("install_date", LAST_CURVE_DAY) <= observed_until


def fit(training: DataFrame, ridge: float = RIDGE, steps: int = 100) -> PipelineModel:
    """Scaling and regression from prepared rows; sums over users are taken in the tasks and merged as a tree."""
    assembled = VectorAssembler(inputCols=FEATURES, outputCol="raw")
    scaled = StandardScaler(inputCol="raw", outputCol="scaled", withMean=True)
    regression = LogisticRegression(
        featuresCol="scaled", labelCol="label", regParam=ridge, maxIter=steps, tol=1e-9, standardization=False
    )
    return Pipeline(stages=[assembled, scaled, regression]).fit(training)


def churn_scores(features: DataFrame, last_day: DataFrame, one_in: int = HOLD_OUT) -> DataFrame:
    """(userid, labelled, held_out, churned, churn_probability) for every user of ``churn_features``.

    The model learns from users whose second week lies within the data, whose
    last day is the one row of ``last_day``, but for the held-out share; all
    users get a score. ``churned`` is NULL where it is not known yet. Without
    any user to learn from scores are NULL; if all of them stayed or all left,
    the score is that share.
    """
    until = last_day.first()[0]
    known = labelled(features, F.lit(until)) if until else F.lit(False)
    rows = prepared(features).withColumns({"labelled": F.coalesce(known, F.lit(False)), "held_out": held_out(F.col("userid"), one_in)})
    training = rows.where("labelled AND NOT held_out").select(*FEATURES, "label")
    shares = training.agg(F.avg("label")).first()[0]
    if shares is None or shares in (0.0, 1.0):
        scored = rows.withColumn("churn_probability", F.lit(shares).cast("double"))
    else:
        probability = vector_to_array("probability")[1]
        scored = fit(training).transform(rows).withColumn("churn_probability", round_half_away(probability, 6))
    churned = F.when(F.col("labelled"), F.col("churned"))
    return scored.select("userid", "labelled", "held_out", churned.alias("churned"), "churn_probability")


def held_out_auc(scored: DataFrame) -> float:
    """Area under the ROC curve over the labelled users that were kept from the fit."""
    rows = scored.where("labelled AND held_out").select(F.col("churned").cast("double").alias("label"), "churn_probability")
    return BinaryClassificationEvaluator(rawPredictionCol="churn_probability").evaluate(rows)
