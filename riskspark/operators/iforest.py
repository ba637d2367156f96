"""Isolation Forest (Liu, Ting, Zhou 2008) fit and scored on Spark (M3, M4, M5).

Fit: every tree draws its sub-sample of at most psi=256 training rows by the
order of a digest of (seed, tree, row).  Only ids and digests are ranked (the
limit on the rank lets Spark keep psi rows a task before the shuffle), the vectors
are joined to the drawn ids once, and ``groupBy(keys, tree_id).applyInPandas`` grows
one tree per group (each holds <= psi rows).  Splits are fractions of digests of
(seed, tree, node), so that any engine grows the same trees.  The forest is a small
table: trees x (2*psi - 1) nodes at most, a bound fixed by the parameters.

Score: an unkeyed forest is shipped to the tasks once and every Arrow batch of
feature vectors is traversed with NumPy in ``mapInPandas``; a keyed forest is
co-grouped with its key's vectors, which are dealt over as many groups as they
fill, so that a hot key is not one task;
score = -2^(-E[h(x)] / c(psi)) (lower = more anomalous).
Predict: flag scores strictly below the ``contamination`` quantile of the
training scores.
"""
from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import constants as C
from .chance import fraction, shuffled
from .util import same_keys

#: Vectors of a key that are scored in one group.
GROUP_ROWS = 20_000

FOREST_SCHEMA = ("tree_id int, node_id int, feature int, threshold double, left int, "
                 "right int, size int, depth int, psi int")
EULER = 0.5772156649


def c_factor(n: float) -> float:
    """Average path length of an unsuccessful BST search over n points."""
    if n > 2:
        return 2.0 * (math.log(n - 1.0) + EULER) - 2.0 * (n - 1.0) / n
    if n == 2:
        return 1.0
    return 0.0


def _grow(tree_id: int, X: np.ndarray, psi: int, seed: int) -> list[tuple]:
    limit = int(math.ceil(math.log2(max(psi, 2))))
    nodes: list[list] = []

    def build(idx: np.ndarray, depth: int, place: int) -> int:
        nid = len(nodes)
        nodes.append([tree_id, nid, -1, 0.0, -1, -1, int(len(idx)), depth, psi])
        if depth >= limit or len(idx) <= 1:
            return nid
        sub = X[idx]
        lo, hi = sub.min(axis=0), sub.max(axis=0)
        cand = np.flatnonzero(hi > lo)
        if len(cand) == 0:
            return nid
        f = int(cand[int(fraction(seed, tree_id, place, "feature") * len(cand))])
        t = float(lo[f] + fraction(seed, tree_id, place, "split") * (hi[f] - lo[f]))
        go_left = sub[:, f] < t
        nodes[nid][2], nodes[nid][3] = f, t
        left = build(idx[go_left], depth + 1, 2 * place)
        right = build(idx[~go_left], depth + 1, 2 * place + 1)
        nodes[nid][4], nodes[nid][5] = left, right
        return nid

    build(np.arange(len(X)), 0, 1)
    return [tuple(n) for n in nodes]


def fit(vectors: DataFrame, n_trees: int = C.IFOREST_TREES, sample: int = C.IFOREST_SAMPLE,
        seed: int = C.IFOREST_SEED, id_col: str = "bucket", keys: list[str] | None = None
        ) -> DataFrame:
    """M3: grow one forest per key from (keys, id, x array<double>) rows -> forest table.

    psi = min(sample, rows of the key).  Each (key, tree) group holds at most
    psi rows, so tree growing is bounded whatever the data volume.
    """
    keys = list(keys or [])
    from pyspark.sql import Window
    trees = F.explode(F.sequence(F.lit(0), F.lit(n_trees - 1))).alias("tree_id")
    order = shuffled(F.lit(seed), F.col("tree_id"), F.col(id_col))
    w = Window.partitionBy(*keys, "tree_id").orderBy("u", id_col)
    drawn = (vectors.select(*keys, id_col, trees).withColumn("u", order)
             .withColumn("r", F.row_number().over(w)).where(F.col("r") <= sample))
    size = F.count(F.lit(1)).over(Window.partitionBy(*keys, "tree_id"))
    sampled = same_keys(drawn.withColumn("psi", size.cast("int")).drop("u"),
                        vectors.select(*keys, id_col, "x"), [*keys, id_col])
    key_schema = "".join(f"`{f.name}` {f.dataType.simpleString()}, "
                         for f in vectors.schema.fields if f.name in keys)

    def grow(pdf: pd.DataFrame) -> pd.DataFrame:
        tid = int(pdf["tree_id"].iloc[0])
        p = int(pdf["psi"].iloc[0])
        X = np.array(pdf.sort_values("r")["x"].tolist(), dtype=float)
        rows = _grow(tid, X, p, seed)
        out = pd.DataFrame(rows, columns=["tree_id", "node_id", "feature", "threshold", "left",
                                          "right", "size", "depth", "psi"])
        for k in keys:
            out.insert(0, k, pdf[k].iloc[0])
        return out[[*keys, "tree_id", "node_id", "feature", "threshold", "left", "right", "size",
                    "depth", "psi"]]

    return (sampled.select(*keys, "tree_id", "r", "psi", "x").groupBy(*keys, "tree_id")
            .applyInPandas(grow, key_schema + FOREST_SCHEMA))


def _forest_arrays(forest_pdf: pd.DataFrame):
    trees = []
    for _, g in forest_pdf.sort_values(["tree_id", "node_id"]).groupby("tree_id"):
        trees.append((g["feature"].to_numpy(), g["threshold"].to_numpy(), g["left"].to_numpy(),
                      g["right"].to_numpy(), g["size"].to_numpy(), g["depth"].to_numpy()))
    psi = int(forest_pdf["psi"].iloc[0]) if len(forest_pdf) else 1
    return trees, psi


def _path_lengths(X: np.ndarray, tree) -> np.ndarray:
    feat, thr, left, right, size, depth = tree
    node = np.zeros(len(X), dtype=int)
    active = feat[node] >= 0
    while active.any():
        idx = np.flatnonzero(active)
        f = feat[node[idx]]
        go_left = X[idx, f] < thr[node[idx]]
        node[idx] = np.where(go_left, left[node[idx]], right[node[idx]])
        active = feat[node] >= 0
    sizes, at = np.unique(size[node], return_inverse=True)
    return depth[node] + np.array([c_factor(n) for n in sizes])[at]


def _score_arrays(X: np.ndarray, trees, psi: int) -> np.ndarray:
    cn = c_factor(psi) or 1.0
    h = np.zeros(len(X))
    for t in trees:
        h += _path_lengths(X, t)
    h /= max(len(trees), 1)
    return -np.power(2.0, -h / cn)


def score(vectors: DataFrame, forest: DataFrame, id_cols: list[str] | None = None,
          keys: list[str] | None = None) -> DataFrame:
    """M4: anomaly score of every row against its key's forest: -2^(-E[h] / c(psi)).

    Unkeyed: the single forest (bounded by its parameters: trees x (2 psi - 1)
    nodes) is broadcast and Arrow batches are scored in ``mapInPandas``.
    Keyed: the model grows with the number of keys, so it is not broadcast;
    each key's vectors are co-grouped with that key's forest instead
    (``cogroup.applyInPandas``), in groups of about GROUP_ROWS vectors.
    """
    keys = list(keys or [])
    id_cols = [*keys, *[c for c in (id_cols or ["bucket"]) if c not in keys]]
    out_schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}"
                           for f in vectors.schema.fields if f.name in id_cols)
    out_schema += ", anomaly_score double"
    if keys:
        def per_key(vp: pd.DataFrame, fp: pd.DataFrame) -> pd.DataFrame:
            if len(vp) == 0 or len(fp) == 0:
                return pd.DataFrame(columns=[*id_cols, "anomaly_score"])
            trees, psi = _forest_arrays(fp)
            out = vp[id_cols].copy()
            out["anomaly_score"] = _score_arrays(np.array(vp["x"].tolist(), dtype=float), trees, psi)
            return out
        per = vectors.groupBy(*keys).agg(F.ceil(F.count(F.lit(1)) / GROUP_ROWS).cast("int").alias("__parts"))
        salt = F.pmod(F.xxhash64(*id_cols), F.col("__parts")).cast("int")
        dealt = same_keys(vectors.select(*id_cols, "x"), per, keys).withColumn("__part", salt).drop("__parts")
        again = same_keys(forest, per, keys).withColumn("__part", F.explode(F.sequence(F.lit(0), F.col("__parts") - 1)))
        return (dealt.groupBy(*keys, "__part").cogroup(again.drop("__parts").groupBy(*keys, "__part"))
                .applyInPandas(per_key, out_schema))

    forest_pdf = forest.toPandas()
    model = vectors.sparkSession.sparkContext.broadcast(forest_pdf)

    def run(batches):
        trees, psi = _forest_arrays(model.value)
        for pdf in batches:
            if len(pdf) == 0:
                continue
            out = pdf[id_cols].copy()
            out["anomaly_score"] = _score_arrays(np.array(pdf["x"].tolist(), dtype=float),
                                                 trees, psi)
            yield out

    return vectors.select(*id_cols, "x").mapInPandas(run, out_schema)


def offset(train_scores: DataFrame, contamination: float = C.IFOREST_CONTAMINATION,
           keys: list[str] | None = None) -> DataFrame:
    """M5 threshold: the contamination quantile of training scores (per key)."""
    keys = list(keys or [])
    return train_scores.groupBy(*keys).agg(
        F.percentile("anomaly_score", contamination).alias("offset"))


def predict(scores: DataFrame, off: DataFrame, keys: list[str] | None = None) -> DataFrame:
    """M5: -1 (anomaly) when the score is strictly below the offset, else 1."""
    from .classify import join_per_key
    j = join_per_key(scores, off, list(keys or []))
    return j.withColumn("prediction", F.when(F.col("anomaly_score") < F.col("offset"), -1)
                        .otherwise(1))
