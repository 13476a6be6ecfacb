"""Isolation-forest anomaly detection (M-01..M-08) as Spark jobs.

Algorithm: Liu, Ting & Zhou, "Isolation Forest" (ICDM 2008), with the
conventions of the common open-source implementation: per tree a sample of
psi = min(256, n) rows, a random feature among the non-constant ones and a
threshold uniform in [min, max) at each node, depth limit ceil(log2 psi),
path length h(x) = depth + c(leaf size), score_samples = -2^(-E[h]/c(psi)),
offset = the ``contamination`` quantile of the training scores,
decision = score_samples - offset, anomaly <=> decision < 0,
anomaly_score = -decision.

Distribution:
* sampling -- each training row is assigned to tree t when
  ``xxhash64(key, t, seed)`` falls under psi/n (a Bernoulli sample, expected
  psi rows per tree), so rows are routed, never replicated to every tree;
* training -- ``groupBy(group..., tree_id).applyInPandas`` grows one tree per
  task from its ~psi rows with a RNG seeded by (seed, tree_id): the result is
  independent of partitioning and deterministic for a seed;
* scoring -- the forest has at most trees x (2 psi - 1) nodes (51,100 for the
  defaults), a proven bound, so it is broadcast and every partition is scored
  vectorised; the offset is an exact quantile by value ranges.

``group_cols`` trains one forest per group (e.g. per channel or page) in the
same jobs, which is what lets this operator use a cluster.  The forests of
groups never meet on the driver: rows and trees are cogrouped by group, a group
of more than ``ROWS_PER_PART`` rows in several parts.
"""

from __future__ import annotations

import json
import math
import sys
import os

import numpy as np
import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from webstats.functions.labels import severity
from webstats.operators.orderstats import quantiles, value_counts

# scoring and tree building run in Python workers: they travel by value, so executors need no copy of the package
cloudpickle.register_pickle_by_value(sys.modules[__name__])

# Candidate features per metric type (as the reference names them).
FEATURES = {
    "traffic": ["total_sessions", "total_pageviews", "avg_bounce_rate", "avg_session_duration"],
    "conversion": ["conversion_rate", "goal_completions", "revenue"],
    "bounce": ["avg_bounce_rate", "total_sessions"],
}
EULER = 0.5772156649
ROWS_PER_PART = 100_000      # rows scored by one task of a grouped forest


def avg_path_length(n):
    """c(n): average path length of an unsuccessful BST search among n points."""
    n = np.asarray(n, dtype=float)
    out = np.zeros_like(n)
    two = n == 2
    big = n > 2
    out[two] = 1.0
    out[big] = 2.0 * (np.log(n[big] - 1.0) + EULER) - 2.0 * (n[big] - 1.0) / n[big]
    return out


def prepare_features(df: DataFrame, metric_type: str = "traffic") -> list[str]:
    """M-01: the metric type's features that the frame has (missing ones are dropped)."""
    return [c for c in FEATURES.get(metric_type, FEATURES["traffic"]) if c in df.columns]


def row_key(key) -> "F.Column":
    """A string key per row: the value of one column, or several quoted, so that different values give different keys."""
    cols = [key] if isinstance(key, str) else list(key)
    if len(cols) == 1:
        return F.col(cols[0]).cast("string")
    return F.to_json(F.struct(*[F.col(c).cast("string").alias(f"c{i}") for i, c in enumerate(cols)]))


def feature_frame(df: DataFrame, features: list[str], key="session_date",
                  group_cols: list[str] | None = None) -> DataFrame:
    """M-01: key, group columns and the features as doubles with NULL -> 0."""
    return df.select(*(group_cols or []), row_key(key).alias("_key"),
                     *[F.coalesce(F.col(c).cast("double"), F.lit(0.0)).alias(c) for c in features])


def _same_group(group_cols: list[str]) -> list:
    """Join condition of a frame with one whose groups are named ``_of_…``; a NULL group meets itself."""
    return [F.col(g).eqNullSafe(F.col(f"_of_{g}")) for g in group_cols]


# ---- training ----------------------------------------------------------------------

NODE_SCHEMA = ("tree_id int, psi int, node_id int, feature int, threshold double, left int, right int, "
               "size long, depth int")


def _grow(X: np.ndarray, rng: np.random.Generator, max_depth: int) -> list[tuple]:
    """Grow one isolation tree; returns (node_id, feature, threshold, left, right, size, depth)."""
    nodes: list[list] = []
    stack = [(np.arange(len(X)), 0, -1, 0)]  # rows, depth, parent, side
    while stack:
        rows, depth, parent, side = stack.pop()
        nid = len(nodes)
        nodes.append([nid, -1, 0.0, -1, -1, len(rows), depth])
        if parent >= 0:
            nodes[parent][3 if side == 0 else 4] = nid
        if depth >= max_depth or len(rows) <= 1:
            continue
        sub = X[rows]
        lo, hi = sub.min(axis=0), sub.max(axis=0)
        usable = np.flatnonzero(hi > lo)
        if usable.size == 0:
            continue
        f = int(usable[rng.integers(usable.size)])
        thr = float(rng.uniform(lo[f], hi[f]))
        go_left = sub[:, f] <= thr
        nodes[nid][1], nodes[nid][2] = f, thr
        stack.append((rows[~go_left], depth + 1, nid, 1))
        stack.append((rows[go_left], depth + 1, nid, 0))
    return [tuple(n) for n in nodes]


def _tree_builder(features: list[str], max_samples: int, seed: int, group_cols: list[str]):
    def build(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("_key", kind="mergesort")          # canonical order -> deterministic
        tree_id = int(pdf["tree_id"].iloc[0])
        psi = int(min(max_samples, int(pdf["_n"].iloc[0])))
        rng = np.random.default_rng([seed, tree_id])
        X = pdf[features].to_numpy(dtype=float)
        if len(X) > psi:                                          # Bernoulli overshoot: trim to psi
            X = X[np.sort(rng.choice(len(X), psi, replace=False))]
        rows = _grow(X, rng, int(math.ceil(math.log2(max(psi, 2)))))
        out = pd.DataFrame(rows, columns=["node_id", "feature", "threshold", "left", "right", "size", "depth"])
        out.insert(0, "psi", psi)
        out.insert(0, "tree_id", tree_id)
        for g in reversed(group_cols):
            out.insert(0, g, pdf[g].iloc[0])
        return out
    return build


def _unit_hash(key, tree, seed: int):
    """Uniform in [0, 1) with 53 bits, so that the share of rows per tree stays exact at any row count."""
    return F.shiftrightunsigned(F.xxhash64(key, tree, F.lit(seed)), 11).cast("double") / float(1 << 53)


def train_isolation_forest(feats: DataFrame, features: list[str], n_trees: int = 100, max_samples: int = 256,
                           seed: int = 42, group_cols: list[str] | None = None) -> DataFrame:
    """M-02: grow ``n_trees`` trees (per group). Returns the node table.

    Each row goes to the trees whose hash of (key, tree, seed) falls under
    psi / n, so a tree receives about psi rows whatever the table size; the
    row count per group comes from one aggregate.
    """
    group_cols = group_cols or []
    if group_cols:
        counts = feats.groupBy(*[F.col(g).alias(f"_of_{g}") for g in group_cols]).agg(F.count(F.lit(1)).alias("_n"))
        f = feats.join(counts, _same_group(group_cols))
    else:
        f = feats.withColumn("_n", feats.agg(F.count(F.lit(1))).scalar())
    p = F.least(F.lit(1.0), F.lit(float(max_samples)) / F.col("_n"))
    trees = F.filter(F.sequence(F.lit(0), F.lit(n_trees - 1)), lambda t: _unit_hash(F.col("_key"), t, seed) < p)
    routed = f.select(*group_cols, "_key", "_n", *features, F.explode(trees).alias("tree_id"))
    types = dict(feats.dtypes)
    schema = ", ".join([f"{g} {types[g]}" for g in group_cols] + [NODE_SCHEMA])
    return (routed.groupBy(*group_cols, "tree_id")
            .applyInPandas(_tree_builder(features, max_samples, seed, group_cols), schema=schema))


# ---- scoring ------------------------------------------------------------------------

def _forest_arrays(nodes_pdf: pd.DataFrame) -> tuple[dict, int]:
    forest = {}
    for tid, g in nodes_pdf.groupby("tree_id"):
        g = g.sort_values("node_id")
        forest[int(tid)] = (g["feature"].to_numpy(), g["threshold"].to_numpy(), g["left"].to_numpy(),
                            g["right"].to_numpy(), g["size"].to_numpy(), g["depth"].to_numpy())
    return forest, int(nodes_pdf["psi"].max())


def _path_lengths(X: np.ndarray, forest: dict) -> np.ndarray:
    total = np.zeros(len(X))
    for feat, thr, left, right, size, depth in forest.values():
        node = np.zeros(len(X), dtype=int)
        for _ in range(int(depth.max()) + 1):
            f = feat[node]
            inner = f >= 0
            if not inner.any():
                break
            idx = np.flatnonzero(inner)
            go_left = X[idx, f[idx]] <= thr[node[idx]]
            node[idx] = np.where(go_left, left[node[idx]], right[node[idx]])
        total += depth[node] + avg_path_length(size[node])
    return total / max(len(forest), 1)


def _scores(X: np.ndarray, forest: dict, psi: int) -> np.ndarray:
    c = float(avg_path_length([psi])[0]) or 1.0
    return -np.power(2.0, -_path_lengths(X, forest) / c)


def score_samples(feats: DataFrame, model: "ForestModel") -> DataFrame:
    """Adds ``score_samples`` (higher = more normal; NULL for a group without a forest).

    One forest has at most trees x (2 psi - 1) nodes and is broadcast; forests of
    groups, whose number is not bounded, meet their rows by a cogroup.
    """
    return _score_groups(feats, model) if model.group_cols else _score_one(feats, model)


def _score_one(feats: DataFrame, model: "ForestModel") -> DataFrame:
    bc = feats.sparkSession.sparkContext.broadcast(model.arrays())
    features = model.features

    def score(batches):
        import pyarrow as pa

        for batch in batches:
            X = batch.select(features).to_pandas().to_numpy(dtype=float)
            s = _scores(X, *bc.value) if bc.value and len(X) else np.full(len(X), np.nan)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(s, from_pandas=True)],
                                             names=[*batch.schema.names, "score_samples"])
    return feats.mapInArrow(score, schema=_scored_schema(feats))


def _scored_schema(feats: DataFrame) -> T.StructType:
    return T.StructType(feats.schema.fields + [T.StructField("score_samples", T.DoubleType())])


def _score_groups(feats: DataFrame, model: "ForestModel") -> DataFrame:
    """Rows and trees cogrouped by group; a group of many rows is dealt to parts, each of which gets the group's trees."""
    group = F.to_json(F.struct(*[F.col(g).cast("string").alias(f"c{i}") for i, g in enumerate(model.group_cols)]))
    rows, columns, features = feats.withColumn("_g", group), feats.columns, model.features
    parts = rows.groupBy("_g").agg(F.ceil(F.count(F.lit(1)) / F.lit(ROWS_PER_PART)).cast("int").alias("_parts"))
    rows = rows.join(parts, "_g").withColumn("_part", F.pmod(F.xxhash64("_key", *features), F.col("_parts")).cast("int")).drop("_parts")
    trees = (model.nodes.withColumn("_g", group).drop(*model.group_cols).join(parts, "_g")
             .withColumn("_part", F.explode(F.sequence(F.lit(0), F.col("_parts") - 1))).drop("_parts"))

    def score(left, right):
        import pyarrow as pa

        s = np.full(left.num_rows, np.nan)
        if left.num_rows and right.num_rows:
            X = left.select(features).to_pandas().to_numpy(dtype=float)
            s = _scores(X, *_forest_arrays(right.to_pandas()))
        return left.select(columns).append_column("score_samples", pa.array(s, pa.float64(), from_pandas=True))
    return rows.groupBy("_g", "_part").cogroup(trees.groupBy("_g", "_part")).applyInArrow(score, schema=_scored_schema(feats))


class ForestModel:
    """A trained forest: node table (bounded), features, offset(s), contamination, seed."""

    def __init__(self, nodes: DataFrame, features: list[str], contamination: float, seed: int,
                 group_cols: list[str] | None = None, offset=None):
        self.nodes, self.features = nodes, features
        self.contamination, self.seed = contamination, seed
        self.group_cols = group_cols or []
        self.offset = offset       # float, or a DataFrame of per-group offsets
        self._arrays = None

    def arrays(self) -> tuple | None:
        """(tree arrays, psi) of an ungrouped forest, at most trees x (2 psi - 1) nodes; None without training rows."""
        if self.group_cols:
            raise ValueError("the forests of groups stay distributed")
        if self._arrays is None:
            pdf = self.nodes.toPandas()
            self._arrays = _forest_arrays(pdf) if len(pdf) else None
        return self._arrays


def fit(feats: DataFrame, features: list[str], contamination: float = 0.05, seed: int = 42, n_trees: int = 100,
        max_samples: int = 256, group_cols: list[str] | None = None) -> ForestModel:
    """M-02: train and fix the decision offset on the training rows."""
    # training passes over the features several times (row count, routing, offset): written to the shared checkpoint
    # folder once, as is the forest, which is small and costly to regrow
    feats = feats.select(*dict.fromkeys([*(group_cols or []), "_key", *features])).checkpoint(eager=True)
    nodes = train_isolation_forest(feats, features, n_trees, max_samples, seed, group_cols).checkpoint(eager=True)
    model = ForestModel(nodes, features, contamination, seed, group_cols)
    groups = group_cols or []
    cuts = quantiles(value_counts(score_samples(feats, model), groups, "score_samples"), groups, {"_offset": contamination})
    if groups:
        model.offset = cuts.checkpoint(eager=True)
    else:
        cut = cuts.first()
        model.offset = float(cut[0]) if cut is not None else 0.0      # no rows: nothing to decide
    return model


def decide(feats: DataFrame, model: ForestModel) -> DataFrame:
    """M-03: is_anomaly, anomaly_score (= -decision) and severity for every row."""
    s = score_samples(feats, model)
    if model.group_cols:
        cuts = model.offset.withColumnsRenamed({g: f"_of_{g}" for g in model.group_cols})
        s = s.join(cuts, _same_group(model.group_cols), "left").drop(*[f"_of_{g}" for g in model.group_cols])
        off = F.col("_offset")
    else:
        off = F.lit(model.offset)
    dec = F.col("score_samples") - off
    return s.select("*", (dec < 0).alias("is_anomaly"), (-dec).alias("anomaly_score")) \
        .withColumn("severity", severity(F.col("anomaly_score"))).drop("_offset")


def detect(df: DataFrame, metric_type: str = "traffic", model: ForestModel | None = None,
           key="session_date", group_cols: list[str] | None = None, contamination: float = 0.05,
           seed: int = 42, store=None) -> tuple[DataFrame, ForestModel | None]:
    """M-04: annotate ``df``; an empty feature set gives (False, 0.0, 'none') like the reference.

    ``model`` scores with a given forest; ``store`` (a ``ModelStore``) loads the forest of these rows and settings if it
    holds it, and trains and publishes it otherwise; with neither a forest is trained.
    """
    features = model.features if model is not None else prepare_features(df, metric_type)
    if not features:
        return df.select("*", F.lit(False).alias("is_anomaly"), F.lit(0.0).alias("anomaly_score"),
                         F.lit("none").alias("severity")), model
    # the row travels with its features: no join back on a key
    whole = F.struct(*[F.col(c) for c in df.columns]).alias("_row")
    feats = df.select(*(group_cols or []), row_key(key).alias("_key"), whole,
                      *[F.coalesce(F.col(c).cast("double"), F.lit(0.0)).alias(c) for c in features])
    if model is None and store is not None:
        model = store.obtain(metric_type + "".join(f"-by-{g}" for g in group_cols or []), feats, features, contamination, seed,
                             group_cols=group_cols)
    elif model is None:
        model = fit(feats, features, contamination, seed, group_cols=group_cols)
    return decide(feats, model).select("_row.*", "is_anomaly", "anomaly_score", "severity"), model


def anomaly_summary(annotated: DataFrame, date_col: str = "session_date") -> DataFrame:
    """M-05: one row: total, sorted anomaly dates, severity counts, recommended actions."""
    a = annotated.where(F.col("is_anomaly"))
    s = a.agg(F.count(F.lit(1)).alias("total_anomalies"),
              F.sort_array(F.collect_list(F.col(date_col).cast("string"))).alias("anomaly_dates"),
              F.count(F.when(F.col("severity") == "low", 1)).alias("low"),
              F.count(F.when(F.col("severity") == "medium", 1)).alias("medium"),
              F.count(F.when(F.col("severity") == "high", 1)).alias("high"))
    acts = F.when(F.col("total_anomalies") == 0,
                  F.array(F.lit("No anomalies detected — traffic looks healthy."))).otherwise(F.filter(F.array(
                      F.when(F.col("high") > 0, F.lit("Investigate high-severity anomaly dates immediately — possible "
                                                      "bot traffic or outage.")),
                      F.when(F.col("medium") > 0, F.lit("Review medium-severity dates for campaign spikes or "
                                                        "tracking issues.")),
                      F.when(F.col("low") > 0, F.lit("Monitor low-severity anomalies over the next 7 days.")),
                      F.lit("Cross-reference anomaly dates with marketing calendar and deployment logs.")),
                      lambda x: x.isNotNull()))
    return s.withColumn("recommended_actions", acts)


def evaluate_model(scored: DataFrame, contamination: float) -> DataFrame:
    """M-08: rows, anomalies, share, contamination, decision range."""
    dec = -F.col("anomaly_score")
    return scored.agg(F.count(F.lit(1)).alias("rows_evaluated"),
                      F.count(F.when(F.col("is_anomaly"), 1)).alias("anomalies"),
                      (F.count(F.when(F.col("is_anomaly"), 1)) / F.count(F.lit(1)) * 100).alias("anomaly_pct"),
                      F.lit(contamination).alias("contamination"),
                      F.min(dec).alias("min_decision"), F.max(dec).alias("max_decision"))


def save_model(model: ForestModel, path: str) -> str:
    """M-07: nodes as Parquet plus a JSON metadata file."""
    model.nodes.write.mode("overwrite").parquet(os.path.join(path, "nodes"))
    meta = {"features": model.features, "contamination": model.contamination,
            "seed": model.seed, "group_cols": model.group_cols}
    if model.group_cols:
        model.offset.write.mode("overwrite").parquet(os.path.join(path, "offsets"))
    else:
        meta["offset"] = model.offset
    spark = model.nodes.sparkSession
    spark.createDataFrame([(json.dumps(meta),)], "meta string").coalesce(1).write.mode("overwrite") \
        .text(os.path.join(path, "meta"))
    return path


def load_model(spark, path: str) -> ForestModel:
    """M-07: FileNotFoundError when nothing was saved at ``path``."""
    try:
        meta = json.loads(spark.read.text(os.path.join(path, "meta")).first()[0])
    except Exception as e:  # noqa: BLE001
        raise FileNotFoundError(f"No model found at {path}. Train one first.") from e
    nodes = spark.read.parquet(os.path.join(path, "nodes"))
    offset = spark.read.parquet(os.path.join(path, "offsets")) if meta["group_cols"] else meta["offset"]
    return ForestModel(nodes, meta["features"], meta["contamination"], meta["seed"], meta["group_cols"], offset)
