"""A store of trained forests: versions that appear whole, found again by what they were trained on (M-06, M-07).

``<root>/<name>/data-<id>/`` holds a forest's tables; ``<root>/<name>/v=<number>.json``
publishes it with its *stamp*: a digest of the training rows (their number and
the sum of their hashes, so their order and partitioning don't matter) and of
everything the training depends on.  A forest is trained only if no published
version has the stamp; a training that dies leaves no version behind.
"""

from __future__ import annotations

import hashlib
import json
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from webstats.operators import anomaly as A
from webstats.sources.files import Folder


def stamp_of(feats: DataFrame, features: list[str], **settings) -> str:
    """Digest of the rows (key, groups, features) and of the settings, from one aggregate."""
    row = F.xxhash64(*[F.col(c) for c in feats.columns if c != "_row"])
    n, total = feats.agg(F.count(F.lit(1)), F.sum(row.cast("decimal(38,0)"))).first()
    what = json.dumps([n, str(total), features, settings], sort_keys=True)
    return hashlib.sha256(what.encode()).hexdigest()[:32]


class ModelStore:
    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.folder = spark, Folder(spark, root)

    def versions(self, name: str) -> list[dict]:
        """Published versions of a model, oldest first."""
        return [json.loads(self.folder.read(f"{name}/{f}")) | {"version": int(f[2:-5])}
                for f in self.folder.names(name) if f.startswith("v=") and f.endswith(".json")]

    def find(self, name: str, stamp: str | None = None) -> A.ForestModel | None:
        """The newest version of a model, or the newest with this stamp."""
        for v in reversed(self.versions(name)):
            if stamp is None or v["stamp"] == stamp:
                return A.load_model(self.spark, f"{self.folder.root}/{name}/{v['data']}")
        return None

    def publish(self, name: str, model: A.ForestModel, stamp: str) -> int:
        data = f"data-{uuid.uuid4().hex}"
        A.save_model(model, f"{self.folder.root}/{name}/{data}")
        number = max((v["version"] for v in self.versions(name)), default=0) + 1
        while not self.folder.publish(f"{name}/v={number:08d}.json", json.dumps({"stamp": stamp, "data": data})):
            number += 1
        return number

    def obtain(self, name: str, feats: DataFrame, features: list[str], contamination: float = 0.05, seed: int = 42,
               n_trees: int = 100, max_samples: int = 256, group_cols: list[str] | None = None) -> A.ForestModel:
        """The forest of these rows and settings: loaded if it is published, else trained once and published."""
        stamp = stamp_of(feats, features, contamination=contamination, seed=seed, n_trees=n_trees, max_samples=max_samples,
                         group_cols=group_cols or [])
        found = self.find(name, stamp)
        if found is not None:
            return found
        self.publish(name, A.fit(feats, features, contamination, seed, n_trees, max_samples, group_cols), stamp)
        return self.find(name, stamp)
