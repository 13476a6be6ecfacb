"""Anomaly-detection jobs on the daily traffic view (M-01..M-08, D-05, D-31).

These are rows-only in the driver's check (the forest is randomised); pytest
checks their invariants: anomaly share near the contamination, valid
severities, determinism for a seed and independence from partitioning.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from webstats.operators import anomaly as A
from webstats.operators.modelstore import ModelStore
from webstats.plans import views as V
from webstats.session import scratch_path

CONTAMINATION = 0.05
SEED = 42


def prepare_traffic_features(t) -> DataFrame:
    """M-01 on vw_daily_traffic: the present traffic features, NULL -> 0 (the reference's
    ``avg_bounce_rate`` is not a column of the view, so 3 features remain)."""
    d = V.vw_daily_traffic(t)
    feats = A.prepare_features(d, "traffic")
    return A.feature_frame(d, feats).withColumnRenamed("_key", "row_key")


def store_of(t) -> ModelStore:
    """The session's model store, in the shared folder: every job here loads its forest from it if it is there."""
    return ModelStore(t.spark, scratch_path(t.spark, "model-store"))


def _detect(t, df: DataFrame, metric_type: str = "traffic", **kw):
    return A.detect(df, metric_type, contamination=CONTAMINATION, seed=SEED, store=store_of(t), **kw)


def forest_nodes(t) -> DataFrame:
    """M-02: the node table of the traffic forest (100 trees, psi = min(256, days))."""
    return _detect(t, V.vw_daily_traffic(t))[1].nodes


def traffic_anomalies(t) -> DataFrame:
    """M-03/M-04: every day annotated with is_anomaly, anomaly_score and severity."""
    return _detect(t, V.vw_daily_traffic(t))[0]


def conversion_anomalies(t) -> DataFrame:
    """M-04 on vw_conversions rows (features present: goal_completions, revenue)."""
    return _detect(t, V.vw_conversions(t), "conversion", key=["session_date", "channel_grouping", "source", "medium"])[0]


def bounce_anomalies(t) -> DataFrame:
    """M-04, bounce feature set (only total_sessions is present on the view)."""
    return _detect(t, V.vw_daily_traffic(t), "bounce")[0]


def channel_anomalies(t) -> DataFrame:
    """M-04 with one forest per channel over per-channel daily traffic (grouped training)."""
    daily = (V.vw_traffic(t).where(F.col("channel_grouping").isNotNull())
             .groupBy("channel_grouping", "session_date")
             .agg(F.sum("total_sessions").alias("total_sessions"), F.sum("total_pageviews").alias("total_pageviews"),
                  F.avg("avg_session_duration").alias("avg_session_duration")))
    return _detect(t, daily, group_cols=["channel_grouping"])[0]


def anomaly_summary(t) -> DataFrame:
    """M-05."""
    return A.anomaly_summary(traffic_anomalies(t))


def run_detection(t) -> DataFrame:
    """M-06: load the forest of these days or train it, score vw_daily_traffic and save every annotated row."""
    out = traffic_anomalies(t)
    path = scratch_path(t.spark, f"anomalies/{uuid.uuid4().hex}")
    out.write.mode("overwrite").parquet(path)
    return t.spark.read.parquet(path)


def model_roundtrip(t) -> DataFrame:
    """M-07: save the forest, load it back and score with the loaded model."""
    d = V.vw_daily_traffic(t)
    path = A.save_model(_detect(t, d)[1], scratch_path(t.spark, f"models/{uuid.uuid4().hex}"))
    return A.detect(d, "traffic", model=A.load_model(t.spark, path))[0]


def evaluate(t) -> DataFrame:
    """M-08."""
    return A.evaluate_model(traffic_anomalies(t), CONTAMINATION)


def anomaly_overlay(t) -> DataFrame:
    """D-05: daily rows on anomaly dates (semi-join), for the chart markers."""
    an = traffic_anomalies(t).where(F.col("is_anomaly")).select("session_date")
    return V.vw_daily_traffic(t).join(an, "session_date", "left_semi") \
        .select("session_date", "total_sessions", "sessions_7day_avg")


def anomaly_severity_counts(t) -> DataFrame:
    """D-05: anomalies per severity (all three levels present, zero-filled, one aggregate pass)."""
    a = traffic_anomalies(t).where(F.col("is_anomaly"))
    one = a.agg(*[F.count(F.when(F.col("severity") == s, 1)).alias(s) for s in ("low", "medium", "high")])
    return one.select(F.explode(F.array(*[F.struct(F.lit(s).alias("severity"), F.col(s).alias("anomalies"))
                                          for s in ("low", "medium", "high")])).alias("r")).select("r.*")


def anomalies_by_score(t) -> DataFrame:
    """D-05: the anomaly days with their metrics, most anomalous first (sorted at the sink)."""
    return (traffic_anomalies(t).where(F.col("is_anomaly"))
            .select("session_date", "total_sessions", "total_pageviews", "avg_session_duration",
                    "anomaly_score", "severity")
            .orderBy(F.col("anomaly_score").desc(), F.col("session_date").asc()))


def latest_anomaly(t) -> DataFrame:
    """D-31: anomaly count, high/medium counts and the most recent anomaly with its severity."""
    a = traffic_anomalies(t).where(F.col("is_anomaly"))
    return a.agg(F.count(F.lit(1)).alias("anomalies"),
                 F.count(F.when(F.col("severity") == "high", 1)).alias("high"),
                 F.count(F.when(F.col("severity") == "medium", 1)).alias("medium"),
                 F.max("session_date").alias("most_recent"),
                 F.max_by("severity", "session_date").alias("most_recent_severity"))


DETECTION = {
    "prepare_features": prepare_traffic_features, "train_isolation_forest": forest_nodes,
    "score_isolation_forest": traffic_anomalies, "detect_conversion_anomalies": conversion_anomalies,
    "detect_bounce_anomalies": bounce_anomalies, "detect_channel_anomalies": channel_anomalies,
    "anomaly_summary": anomaly_summary, "run_detection": run_detection, "save_load_model": model_roundtrip,
    "evaluate_model": evaluate, "anomaly_overlay": anomaly_overlay, "latest_anomaly": latest_anomaly,
    "anomaly_severity_counts": anomaly_severity_counts, "anomalies_by_score": anomalies_by_score,
}
