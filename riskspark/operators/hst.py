"""Half-Space Trees (Tan, Ting, Liu 2011) as a relation over windows.

A tree never changes: its splits are a function of the seed.  What it learns is
how many rows of the last complete window of ``window`` learned rows fell into
each node, so that no replay is needed: a row's leaf in every tree is an
expression, rows are numbered per key in the order of time, the leaves of a
window are one row (at most ``window`` arrays), and a row meets those of the
window before its own.  Windows are independent of each other and of their order.

Between cycles the state of a key is its last rows: those of the last complete
window and of the one begun after it.  They go before the new rows, and the
ranks go on from there (:func:`learn_and_score`).  The streaming form keeps
masses per tree in ``applyInPandasWithState``; :func:`replay` is its step.

Features are min-max scaled by the baseline and clipped to [0, 1] (the
algorithm's work space); a row with no usable feature scores 0 and is not
learned.  Output score is 1 - mass/max (high = anomalous), 0 before the
first window completes.
"""
from __future__ import annotations

import json

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import constants as C
from .chance import fraction
from .ranks import ranked
from .util import materialize, same_keys

PADDING = 0.15


def build_tree(tree_id: int, n_features: int, height: int, seed: int):
    """Complete binary tree in array form: split feature and threshold per inner node."""
    n_nodes = 2 ** (height + 1) - 1
    feat = np.full(n_nodes, -1)
    thr = np.zeros(n_nodes)
    lo = np.zeros((n_nodes, n_features))
    hi = np.ones((n_nodes, n_features))
    for node in range(2 ** height - 1 if n_features else 0):
        f = int(fraction(seed, tree_id, node, "feature") * n_features)
        a, b = lo[node, f], hi[node, f]
        low, high = a + PADDING * (b - a), b - PADDING * (b - a)
        t = low + fraction(seed, tree_id, node, "split") * (high - low)
        feat[node], thr[node] = f, t
        for child, (na, nb) in ((2 * node + 1, (a, t)), (2 * node + 2, (t, b))):
            lo[child], hi[child] = lo[node], hi[node]
            lo[child, f], hi[child, f] = na, nb
    depth = np.floor(np.log2(np.arange(n_nodes) + 1)).astype(int)
    return feat, thr, depth


def _path(x: np.ndarray, present: np.ndarray, feat, thr, height: int) -> list[int]:
    node, out = 0, [0]
    for _ in range(height):
        f = feat[node]
        # Missing feature (decision): follow the left branch.
        go_left = (not present[f]) or x[f] < thr[node]
        node = 2 * node + 1 if go_left else 2 * node + 2
        out.append(node)
    return out


def replay(tree_id: int, X: np.ndarray, present: np.ndarray, state: dict | None,
           height: int = C.HST_HEIGHT, window: int = C.HST_WINDOW, seed: int = 42):
    """Score-then-learn one tree over rows in time order; returns (masses, state)."""
    n_features = X.shape[1] if X.ndim == 2 else 0
    feat, thr, depth = build_tree(tree_id, n_features, height, seed)
    n_nodes = len(feat)
    st = state or {"l": np.zeros(n_nodes), "r": np.zeros(n_nodes), "count": 0,
                   "first": True, "learned": 0}
    l_mass, r_mass = np.asarray(st["l"], float), np.asarray(st["r"], float)
    count, first, learned = int(st["count"]), bool(st["first"]), int(st["learned"])
    size_limit = 0.1 * window
    masses, scored, warm = [], [], []
    for i in range(len(X)):
        if not present[i].any():
            masses.append(0.0)
            scored.append(False)
            warm.append(learned >= window)
            continue
        path = _path(X[i], present[i], feat, thr, height)
        m = 0.0
        if not first:
            for node in path:
                m += r_mass[node] * (2.0 ** depth[node])
                if r_mass[node] < size_limit:
                    break
        masses.append(m)
        scored.append(not first)
        for node in path:
            l_mass[node] += 1
        count += 1
        learned += 1
        if count == window:
            r_mass, l_mass = l_mass.copy(), np.zeros(n_nodes)
            count, first = 0, False
        warm.append(learned >= window)
    new_state = {"l": l_mass.tolist(), "r": r_mass.tolist(), "count": count, "first": first,
                 "learned": learned}
    return masses, scored, warm, new_state


def max_mass(n_trees: int = C.HST_TREES, height: int = C.HST_HEIGHT,
             window: int = C.HST_WINDOW) -> float:
    return float(n_trees * window * (2 ** (height + 1) - 1))


def scaled_inputs(features: DataFrame, base_minmax: DataFrame, keys: list[str] | None = None,
                  cols: list[str] = C.STREAMING_FEATURES) -> DataFrame:
    """(keys, bucket, x array<double>, present array<boolean>) scaled to [0, 1] by the baseline."""
    keys = list(keys or [])
    from .classify import join_per_key
    j = join_per_key(features, base_minmax, keys)
    xs, ps = [], []
    for c in cols:
        v = F.col(c).cast("double")
        lo, hi = F.col(f"min_{c}"), F.col(f"max_{c}")
        s = F.when(hi > lo, (v - lo) / (hi - lo)).otherwise(F.lit(0.0))
        xs.append(F.least(F.greatest(F.coalesce(s, F.lit(0.0)), F.lit(0.0)), F.lit(1.0)))
        ps.append(v.isNotNull() & ~F.isnan(v))
    return j.select(*keys, "bucket", F.array(*xs).alias("x"), F.array(*ps).alias("present"))


def baseline_minmax(features: DataFrame, keys: list[str] | None = None,
                    cols: list[str] = C.STREAMING_FEATURES) -> DataFrame:
    keys = list(keys or [])
    aggs = []
    for c in cols:
        aggs += [F.min(c).cast("double").alias(f"min_{c}"), F.max(c).cast("double").alias(f"max_{c}")]
    return features.groupBy(*keys).agg(*aggs)


def leaves(n_trees: int, n_features: int, height: int, seed: int) -> Column:
    """The leaf of the row (x, present) in every tree, numbered as in a heap.

    The trees are a constant of the plan: n_trees x 2^height splits.  A missing
    feature goes left.
    """
    trees = [build_tree(k, n_features, height, seed)[:2] for k in range(n_trees)]
    text = json.dumps([{"f": f[:2 ** height - 1].tolist(), "t": t[:2 ** height - 1].tolist()} for f, t in trees])
    forest = F.from_json(F.lit(text), "array<struct<f: array<int>, t: array<double>>>")

    def down(tree):
        def step(node, _):
            f = F.get(tree["f"], node)
            right = F.get("present", f) & (F.get("x", f) >= F.get(tree["t"], node))
            return 2 * node + F.when(right, 2).otherwise(1)
        return F.aggregate(F.sequence(F.lit(1), F.lit(height)), F.lit(0), step)

    return F.transform(forest, down)


def _mass(window_leaves: Column, height: int, limit: float) -> Column:
    """Summed over the trees: rows of the window before in each node of the row's path, times
    2^depth, down to the first node that has less than ``limit`` of them."""
    def tree(leaf, k):
        def held(depth):
            up = F.lit(height) - depth
            return F.size(F.filter(window_leaves, lambda other: _above(F.get(other, k), up) == _above(leaf, up)))

        def add(a, n):
            return F.struct((a["mass"] + F.when(a["open"], n * a["weight"]).otherwise(0.0)).alias("mass"),
                            (a["open"] & (n >= limit)).alias("open"), (a["weight"] * 2).alias("weight"))

        counts = F.transform(F.sequence(F.lit(0), F.lit(height)), held)
        zero = F.struct(F.lit(0.0).alias("mass"), F.lit(True).alias("open"), F.lit(1.0).alias("weight"))
        return F.aggregate(counts, zero, add, lambda a: a["mass"])

    return F.aggregate(F.transform("leaves", tree), F.lit(0.0), lambda a, m: a + m)


def _above(leaf: Column, levels: Column) -> Column:
    """The node so many levels above a node, both numbered from 1."""
    return F.call_function("shiftright", leaf + 1, levels)


def state_schema(rows: DataFrame, keys: list[str]) -> str:
    kinds = "".join(f"`{f.name}` {f.dataType.simpleString()}, " for f in rows.schema.fields if f.name in keys)
    return kinds + "rank bigint, bucket timestamp_ntz, leaves array<int>"


def learn_and_score(inputs: DataFrame, state: DataFrame | None = None, keys: list[str] | None = None,
                    n_trees: int = C.HST_TREES, height: int = C.HST_HEIGHT, window: int = C.HST_WINDOW,
                    seed: int = 42, threshold: float = C.HST_THRESHOLD) -> tuple[DataFrame, DataFrame]:
    """M10 + M11: (keys, bucket, hst_score, warm, hst_flag) of every new bucket, and the state after it.

    Every bucket is scored by what was learned before it, then learned.  ``state``
    (keys, rank, bucket, leaves) is what a call before has returned; without it the
    detector is cold.  Buckets that are not after the last learned one of their key
    were learned before: they have no row.  Null keys are a key.
    """
    keys = list(keys or [])
    if state is None:
        state = inputs.sparkSession.createDataFrame([], state_schema(inputs, keys))
    width = len(C.STREAMING_FEATURES)
    last = state.groupBy(*keys).agg(F.max("rank").alias("__rank"), F.max("bucket").alias("__last"))
    if keys:
        rows = same_keys(inputs, last, keys, "left")
    else:
        one = last.select(F.struct("__rank", "__last").alias("s")).scalar()
        rows = inputs.withColumn("__s", one).select(*inputs.columns, "__s.*")
    rows = rows.where(F.col("__last").isNull() | (F.col("bucket") > F.col("__last")))
    usable = F.exists("present", lambda p: p)
    # Learned rows take the next numbers; a row without a feature has the number of the one before it.
    rows = ranked(rows.where(usable), keys).withColumn("usable", F.lit(True)).unionByName(
        rows.where(~usable).withColumn("rank", F.lit(None).cast("long")).withColumn("usable", F.lit(False)))
    # Stored once: scores, windows and the state all read the leaves.
    rows = materialize(rows.withColumn("rank", F.col("rank") + F.coalesce("__rank", F.lit(0))).withColumn(
        "leaves", leaves(n_trees, width, height, seed)).drop("x", "present", "__last"))
    learned = state.select(*keys, "rank", "bucket", "leaves").unionByName(
        rows.where("usable").select(*keys, "rank", "bucket", "leaves"))
    windows = learned.groupBy(*keys, F.expr(f"(rank - 1) div {window} + 1").alias("__window")).agg(
        F.collect_list("leaves").alias("__seen"))
    scored = same_keys(rows.where("usable").withColumn("__window", F.expr(f"(rank - 1) div {window}")),
                       windows, [*keys, "__window"], "left")
    mass = _mass(F.col("__seen"), height, 0.1 * window)
    score = F.when(F.col("rank") > window, 1.0 - mass / max_mass(n_trees, height, window)).otherwise(F.lit(0.0))
    warm = F.col("rank") >= window
    scored = scored.select(*keys, "bucket", score.alias("hst_score"), warm.alias("warm"))
    # Rows without any feature: warm if enough was learned before them.
    full = learned.where(F.col("rank") == window).select(*keys, F.col("bucket").alias("__full"))
    idle = rows.where(~F.col("usable")).select(*keys, "bucket", "__rank")
    if keys:
        idle = same_keys(idle, full, keys, "left")
    else:
        idle = idle.withColumn("__full", full.select("__full").scalar())
    idle = idle.select(*keys, "bucket", F.lit(0.0).alias("hst_score"), F.coalesce(
        (F.col("__rank") >= window) | (F.col("bucket") > F.col("__full")), F.lit(False)).alias("warm"))
    out = scored.unionByName(idle).withColumn("hst_flag", F.col("hst_score") >= F.lit(threshold))
    # What the next rows need: the last complete window and what came after it.
    most = learned.groupBy(*keys).agg(F.max("rank").alias("__most"))
    kept = same_keys(learned, most, keys) if keys else learned.withColumn("__most", most.select("__most").scalar())
    kept = kept.where(F.col("rank") > F.expr(f"(__most div {window} - 1) * {window}")).drop("__most")
    return out, kept


def score_batch(inputs: DataFrame, keys: list[str] | None = None, n_trees: int = C.HST_TREES,
                height: int = C.HST_HEIGHT, window: int = C.HST_WINDOW, seed: int = 42,
                threshold: float = C.HST_THRESHOLD) -> DataFrame:
    """:func:`learn_and_score` of a whole series from the cold detector."""
    return learn_and_score(inputs, None, keys, n_trees, height, window, seed, threshold)[0]


def combine_trees(masses: DataFrame, keys: list[str], n_trees: int = C.HST_TREES,
                  height: int = C.HST_HEIGHT, window: int = C.HST_WINDOW,
                  threshold: float = C.HST_THRESHOLD) -> DataFrame:
    """Sum tree masses per bucket: score = 1 - mass / max (0 when not scored)."""
    mx = max_mass(n_trees, height, window)
    agg = masses.groupBy(*keys, "bucket").agg(
        F.sum("mass").alias("mass"), F.max(F.col("scored").cast("int")).alias("scored"),
        F.min(F.col("warm").cast("int")).alias("warm"))
    s = F.when(F.col("scored") == 1, F.lit(1.0) - F.col("mass") / F.lit(mx)).otherwise(F.lit(0.0))
    return agg.select(*keys, "bucket", s.alias("hst_score"),
                      (F.col("warm") == 1).alias("warm"),
                      (s >= F.lit(threshold)).alias("hst_flag"))
