"""Model work on samples (ML6-ML10, AGG10): distributed fit, metrics, scoring,
promotion rule and a metrics registry table.

The reference trains a small neural net on one GPU; here the regression is
re-aimed at Spark ML (Huber-loss linear regression on the flattened window +
tabular features), so fitting and scoring run on the executors.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import StandardScaler
from pyspark.ml.functions import array_to_vector
from pyspark.ml.regression import LinearRegression
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def feature_vector(df: DataFrame, seq: str = "sequence", tab: str = "tabular") -> DataFrame:
    """Flatten the window block and append the tabular snapshot as one vector."""
    flat = F.concat(F.flatten(F.col(seq)), F.col(tab))
    return df.withColumn("features_raw", array_to_vector(flat))


def fit_regressor(train: DataFrame, max_iter: int = 50, reg: float = 0.0) -> PipelineModel:
    """ML6: scaler + Huber regression, fitted by distributed L-BFGS."""
    scaler = StandardScaler(inputCol="features_raw", outputCol="features", withMean=True, withStd=True)
    lr = LinearRegression(featuresCol="features", labelCol="target", predictionCol="prediction",
                          loss="huber", maxIter=max_iter, regParam=reg)
    return Pipeline(stages=[scaler, lr]).fit(feature_vector(train))


def score(model: PipelineModel, windows: DataFrame) -> DataFrame:
    """ML8: predictions for the latest windows, key echoed."""
    return model.transform(feature_vector(windows)).select(
        "ticker", "trading_date", F.col("prediction").alias("predicted_return"))


def rmse_mae(df: DataFrame, pred: str | Column = "prediction", target: str | Column = "target",
             by: str | None = None) -> DataFrame:
    """AGG10: RMSE and MAE (optionally per group, e.g. per split)."""
    p = F.col(pred) if isinstance(pred, str) else pred
    t = F.col(target) if isinstance(target, str) else target
    err = p.cast("double") - t.cast("double")
    aggs = [F.sqrt(F.avg(err * err)).alias("rmse"), F.avg(F.abs(err)).alias("mae"), F.count(err).alias("n")]
    return (df.groupBy(by) if by else df).agg(*aggs)


def promote(challenger: Mapping[str, float] | None, champion: Mapping[str, float] | None,
            threshold: float = 0.05) -> bool:
    """ML9: no champion -> promote; else require a relative RMSE gain >= threshold;
    a champion RMSE <= 0 falls back to a plain less-than."""
    if challenger is None:
        raise ValueError("challenger metrics are required")
    if champion is None:
        return True
    ch, cu = float(champion["rmse"]), float(challenger["rmse"])
    if ch <= 0:
        return cu < ch
    return (ch - cu) / ch >= threshold


def promote_col(challenger_rmse: Column, champion_rmse: Column, threshold: float = 0.05) -> Column:
    """ML9 as a column expression over a metrics table (NULL champion -> promote)."""
    return (
        F.when(champion_rmse.isNull(), F.lit(True))
        .when(champion_rmse <= 0, challenger_rmse < champion_rmse)
        .otherwise((champion_rmse - challenger_rmse) / champion_rmse >= threshold)
    )


def registry_row(spark, version: str, metrics: Mapping[str, float], status: str = "candidate") -> DataFrame:
    """ML10: one registry row; upsert into the registry table by ``version``."""
    return spark.createDataFrame(
        [(version, float(metrics["rmse"]), float(metrics["mae"]), status)],
        "version string, rmse double, mae double, status string",
    )


def active_champion(registry: DataFrame) -> DataFrame:
    """ML10: the active model's row (empty when there is none yet)."""
    return registry.where(F.col("status") == "active")


def register_candidate(spark, registry: DataFrame | None, version: str, metrics: Mapping[str, float],
                       threshold: float = 0.05) -> tuple[DataFrame, bool]:
    """ML10 + ML9: read the active champion (none -> promote), decide, and return
    the registry with the candidate 'active' (champion 'retired') or 'rejected'.
    Only the champion's metric row reaches the driver."""
    from tidemark.operators.upsert import upsert

    champ_row = None if registry is None else active_champion(registry).first()
    champion = None if champ_row is None else {"rmse": champ_row["rmse"], "mae": champ_row["mae"]}
    ok = promote(metrics, champion, threshold)
    rows = registry_row(spark, version, metrics, "active" if ok else "rejected")
    if registry is None:
        return rows, ok
    if ok and champ_row is not None:
        rows = rows.unionByName(registry.where(F.col("version") == champ_row["version"])
                                .withColumn("status", F.lit("retired")))
    return upsert(registry, rows, ["version"], keep_from_old=()), ok
