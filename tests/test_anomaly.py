"""Isolation forest: invariants, determinism, partition independence, an injected spike."""

import datetime as dt

import numpy as np
import pytest
from pyspark.sql import functions as F

from webstats.operators import anomaly as A
from webstats.operators.modelstore import ModelStore
from webstats.plans import detection as D
from webstats.plans import views as V
from webstats.sources.files import Folder


def test_avg_path_length():
    c = A.avg_path_length([0, 1, 2, 3, 256])
    assert c[0] == 0 and c[1] == 0 and c[2] == 1.0
    assert abs(c[3] - (2 * (np.log(2) + A.EULER) - 4 / 3)) < 1e-12
    assert 10.2 < c[4] < 10.3


def test_traffic_detection_invariants(tables):
    rows = D.traffic_anomalies(tables).collect()
    n = len(rows)
    an = [r for r in rows if r["is_anomaly"]]
    assert n > 0 and len(an) / n <= 0.15
    assert abs(len(an) / n - 0.05) < 0.02
    assert {r["severity"] for r in rows} <= {"low", "medium", "high"}
    assert all(r["anomaly_score"] > 0 for r in an)          # decision < 0  <=>  score > 0
    assert all(r["anomaly_score"] <= 0 for r in rows if not r["is_anomaly"])


def test_deterministic_and_partition_independent(spark, tables):
    a = {r["session_date"]: r["anomaly_score"] for r in D.traffic_anomalies(tables).collect()}
    old = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "3")
    try:
        b = {r["session_date"]: r["anomaly_score"] for r in D.traffic_anomalies(tables).collect()}
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", old)
    assert a == b


def test_injected_spike_is_flagged(spark):
    rng = np.random.default_rng(0)
    base = dt.date(2024, 1, 1)
    rows = [(base + dt.timedelta(days=i), float(rng.normal(1000, 30)), float(rng.normal(3000, 90)),
             float(rng.normal(120, 5))) for i in range(120)]
    rows[77] = (rows[77][0], 9000.0, 30000.0, 15.0)
    df = spark.createDataFrame(rows, "session_date date, total_sessions double, total_pageviews double, "
                                     "avg_session_duration double")
    out, model = A.detect(df, "traffic", contamination=0.05, seed=7)
    flagged = {r["session_date"]: r for r in out.where("is_anomaly").collect()}
    assert rows[77][0] in flagged
    assert flagged[rows[77][0]]["severity"] in ("medium", "high")
    assert len(model.features) == 3


def test_scores_match_a_direct_numpy_evaluation(spark, tables):
    d = tables.ga4.groupBy("session_date").agg(F.sum("sessions").alias("total_sessions"))
    feats = A.feature_frame(d, ["total_sessions"])
    model = A.fit(feats, ["total_sessions"], 0.05, 3, n_trees=20)
    got = {r["_key"]: r["score_samples"] for r in A.score_samples(feats, model).collect()}
    forest, psi = model.arrays()
    pdf = feats.toPandas()
    want = -np.power(2.0, -A._path_lengths(pdf[["total_sessions"]].to_numpy(float), forest)
                     / A.avg_path_length([psi])[0])
    for k, w in zip(pdf["_key"], want):
        assert abs(got[k] - w) < 1e-12


def test_missing_features_and_missing_model(spark, tmp_path):
    df = spark.createDataFrame([(dt.date(2024, 1, 1), 1)], "session_date date, other int")
    out, model = A.detect(df, "traffic")
    r = out.first()
    assert (r["is_anomaly"], r["anomaly_score"], r["severity"]) == (False, 0.0, "none") and model is None
    with pytest.raises(FileNotFoundError):
        A.load_model(spark, str(tmp_path / "nothing-here"))


def test_summary_and_grouped_models(tables):
    s = D.anomaly_summary(tables).first()
    assert s["total_anomalies"] == s["low"] + s["medium"] + s["high"]
    assert s["anomaly_dates"] == sorted(s["anomaly_dates"])
    assert s["recommended_actions"][-1].startswith("Cross-reference")
    g = D.channel_anomalies(tables)
    per = {r["channel_grouping"]: r["n"] for r in g.where("is_anomaly").groupBy("channel_grouping")
           .agg(F.count(F.lit(1)).alias("n")).collect()}
    assert len(per) >= 5


def test_rows_in_equal_rows_out_and_empty_frame(spark):
    rows = [("a|b", "c", 1.0), ("a", "b|c", 2.0), ("a", "b|c", 2.0), (None, "x", 3.0)] * 5
    df = spark.createDataFrame(rows, "x string, y string, total_sessions double")
    out, _ = A.detect(df, "bounce", key=["x", "y"])
    assert out.count() == 20 and out.columns == [*df.columns, "is_anomaly", "anomaly_score", "severity"]
    none, _ = A.detect(df.where("false"), "bounce", key=["x", "y"])
    assert none.count() == 0


def test_one_training_serves_every_key(spark, tables, tmp_path, monkeypatch):
    """All jobs on one forest train it once; changed rows or settings train anew; a torn version is not found."""
    trained = []
    grow = A.train_isolation_forest
    monkeypatch.setattr(A, "train_isolation_forest", lambda *a, **k: trained.append(1) or grow(*a, **k))
    monkeypatch.setattr(D, "store_of", lambda t: ModelStore(spark, str(tmp_path / "store")))
    first = sorted(D.traffic_anomalies(tables).collect())
    for job in (D.run_detection, D.model_roundtrip, D.traffic_anomalies):
        assert sorted(job(tables).collect()) == first
    for job in (D.forest_nodes, D.anomaly_summary, D.evaluate, D.anomaly_overlay, D.latest_anomaly, D.anomalies_by_score):
        assert job(tables).count() > 0
    assert len(trained) == 1
    store = ModelStore(spark, str(tmp_path / "store"))
    assert [v["version"] for v in store.versions("traffic")] == [1]
    days = V.vw_daily_traffic(tables)
    A.detect(days, contamination=D.CONTAMINATION, seed=D.SEED, store=store)
    assert len(trained) == 1
    A.detect(days.where("total_sessions > 3"), contamination=D.CONTAMINATION, seed=D.SEED, store=store)
    A.detect(days, contamination=0.1, seed=D.SEED, store=store)
    assert len(trained) == 3 and [v["version"] for v in store.versions("traffic")] == [1, 2, 3]
    (tmp_path / "store" / "traffic" / "data-torn").mkdir()       # a training that died before it was published
    assert store.find("traffic", "no such stamp") is None and store.find("unknown") is None
    assert store.find("traffic").contamination == 0.1


def test_published_files_are_never_overwritten(spark, tmp_path):
    folder = Folder(spark, str(tmp_path / "f"))
    assert folder.names() == [] and folder.publish("v=1.json", "ä one") and not folder.publish("v=1.json", "two")
    assert folder.read("v=1.json") == "ä one" and folder.names() == ["v=1.json"]


@pytest.mark.parametrize("rows_per_part", [A.ROWS_PER_PART, 7])
def test_grouped_scores_equal_one_forest_at_a_time(spark, monkeypatch, rows_per_part):
    """Groups split to parts give the scores and decisions of a plain evaluation; NULL groups and unseen groups included."""
    monkeypatch.setattr(A, "ROWS_PER_PART", rows_per_part)
    rng = np.random.default_rng(2)
    rows = [(g, str(i), float(x), float(y)) for g, n in (("a", 60), (None, 40), ("c", 1)) for i, (x, y) in enumerate(rng.normal(0, 1, (n, 2)))]
    df = spark.createDataFrame(rows, "g string, k string, total_sessions double, avg_bounce_rate double")
    features = ["total_sessions", "avg_bounce_rate"]
    feats = A.feature_frame(df, features, key="k", group_cols=["g"])
    model = A.fit(feats, features, 0.1, 3, n_trees=15, group_cols=["g"])
    got = {(r["g"], r["_key"]): r for r in A.decide(feats, model).collect()}
    assert len(got) == len(rows)
    nodes = model.nodes.toPandas()
    for g in ("a", None, "c"):
        part = nodes[nodes["g"].isna()] if g is None else nodes[nodes["g"] == g]
        own = [r for r in rows if r[0] == g]
        want = A._scores(np.array([r[2:] for r in own]), *A._forest_arrays(part))
        cut = np.quantile(want, 0.1)
        for r, w in zip(own, want):
            assert got[r[:2]]["score_samples"] == pytest.approx(w, abs=1e-12)
            assert got[r[:2]]["anomaly_score"] == pytest.approx(cut - w, abs=1e-12)
    other = feats.withColumn("g", F.lit("unseen"))
    assert A.score_samples(other, model).where("score_samples IS NOT NULL").count() == 0
    with pytest.raises(ValueError):
        model.arrays()
