"""Property tests for the learned detectors."""
import numpy as np
from pyspark.sql import functions as F

from conftest import SF_CHECK
from riskspark.operators import hst as HS
from riskspark.operators import iforest as IF
from riskspark.plans.detect import z_chain


def test_forest_scores_properties(spark):
    ch = z_chain(spark, SF_CHECK, "1 hour")
    from riskspark.operators.baseline import feature_vector
    vec = feature_vector(ch.features, ch.base)
    forest = IF.fit(vec)
    sc = IF.score(vec, forest)
    pdf = sc.toPandas()
    assert ((pdf["anomaly_score"] < 0) & (pdf["anomaly_score"] > -1)).all()
    pred = IF.predict(sc, IF.offset(sc)).toPandas()
    share = (pred["prediction"] == -1).mean()
    assert 0.03 <= share <= 0.07
    # The planted traffic flood (10 Jan 13-17 h) is among the most anomalous buckets.
    flood = pdf[(pdf["bucket"] >= "2024-01-10 13:00") & (pdf["bucket"] < "2024-01-10 17:00")]
    assert flood["anomaly_score"].min() <= pdf["anomaly_score"].quantile(0.02)
    # Same seed -> same forest regardless of partitioning.
    f2 = IF.fit(vec.repartition(3)).toPandas().sort_values(["tree_id", "node_id"]).reset_index(drop=True)
    f1 = forest.toPandas().sort_values(["tree_id", "node_id"]).reset_index(drop=True)
    assert f1.equals(f2)


def test_hst_properties_and_restart(spark):
    rng = np.random.default_rng(0)
    X = rng.random((40, 12))
    P = np.ones_like(X, dtype=bool)
    full, scored, warm, _ = HS.replay(3, X, P, None, window=8)
    assert not any(scored[:8]) and all(scored[8:]) and warm[7] and not warm[6]
    a, _, _, st = HS.replay(3, X[:17], P[:17], None, window=8)
    b, _, _, _ = HS.replay(3, X[17:], P[17:], st, window=8)
    assert np.allclose(full, a + b)        # restart from state == uninterrupted run
    ch = z_chain(spark, SF_CHECK, "1 hour")
    out = HS.score_batch(HS.scaled_inputs(ch.features, HS.baseline_minmax(ch.features))).toPandas()
    assert ((out["hst_score"] >= 0) & (out["hst_score"] <= 1)).all()
    assert not out.sort_values("bucket")["hst_flag"].head(8).any()


def test_keyed_forest(spark):
    """One forest per environment; every bucket of every key gets a score."""
    from riskspark.operators import baseline as BL
    from riskspark.operators.features import build_features
    from riskspark.plans.common import logs
    from conftest import SF_SMALL
    system, llm = logs(spark, SF_SMALL)
    feats = build_features(system, llm, "1 hour", keys=["sap_app_env"])
    base = BL.baseline(feats, ["sap_app_env"])
    vec = BL.feature_vector(feats, base, ["sap_app_env"])
    forest = IF.fit(vec, n_trees=20, keys=["sap_app_env"])
    assert forest.select("sap_app_env").distinct().count() == 3
    sc = IF.score(vec, forest, keys=["sap_app_env"])
    assert sc.count() == feats.count()
    pred = IF.predict(sc, IF.offset(sc, keys=["sap_app_env"]), ["sap_app_env"]).toPandas()
    assert pred.groupby("sap_app_env")["prediction"].apply(lambda s: (s == -1).mean()).between(0.0, 0.1).all()
