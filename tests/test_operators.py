"""Hand-made goldens for the null/default rules, ties and edge cases (FIXTURES.md §4)."""
import datetime as dt

from pyspark.sql import functions as F

from riskspark import constants as C
from riskspark.operators import classify as CL
from riskspark.operators import merge as MG
from riskspark.operators import prepare as PR
from riskspark.operators.features import build_features
from riskspark.operators.quantile import exact_quantile

RAW = ("_id string, `@timestamp` string, client_ip string, headers_http_host string, "
       "headers_http_request_method string, sap_function_log_type string, http_status_code string, "
       "_score string, llm_status string, llm_response_time_ms string, llm_cost_usd string, "
       "llm_model_id string, llm_finish_reason string")


def raw(spark, rows):
    return spark.createDataFrame(rows, RAW)


def test_flatten_defaults_and_status(spark):
    rows = [
        ("a", "2024-01-01T00:01:00Z", None, "", "", "INFO", "0", None, None, None, None, None, None),
        ("b", "2024-01-01T00:02:00+01:00", "1.1.1.1", "h", "GET", "ERROR", "404", "0.2", "", None, None, None, None),
        ("c", "bad-ts", "1.1.1.1", "", "POST", None, "n/a", "x", "success", "5", "0.1", "m", "stop"),
    ]
    flat = {r["_id"]: r for r in PR.flatten(raw(spark, rows)).collect()}
    assert flat["a"]["sourceip"] == "N/A" and flat["a"]["port_service"] == "N/A"
    assert flat["a"]["status"] == "INFO"           # numeric 0 falls through
    assert flat["b"]["status"] == "404" and flat["b"]["port_service"] == "GET h"
    assert flat["b"]["timestamp"] == dt.datetime(2023, 12, 31, 23, 2)   # +01:00 converted to UTC
    assert flat["c"]["timestamp"] is None and flat["c"]["_score"] is None
    assert flat["c"]["logtype"] == "UNKNOWN" and flat["c"]["status"] == "success"
    assert flat["c"]["http_status_code"] is None


def test_split_flag_and_features_edge_cases(spark):
    rows = [
        ("s1", "2024-01-01T00:01:00", "ip1", "h", "GET", "ERROR", "500", None, None, None, None, None, None),
        ("s2", "2024-01-01T00:02:00", "ip2", "h", "GET", "ERROR", None, "0.1", None, None, None, None, None),
        ("s3", "2024-01-01T00:03:00", "ip2", "h", "GET", "SECURITY", "200", "0.9", None, None, None, None, None),
        ("l1", "2024-01-01T00:11:00", None, "", "POST", "LLM_REQUEST", None, None, "success", None, "0.5", "m", "stop"),
        ("u1", "2024-01-01T00:12:00", None, "", "POST", "WHATEVER", None, None, None, None, None, None, None),
    ]
    system, llm = PR.prepared_logs(raw(spark, rows))
    flags = {r["_id"]: r["is_security_event"] for r in system.collect()}
    assert flags == {"s1": True, "s2": False, "s3": True}
    assert "llm_model_id" not in system.columns and "sourceip" not in llm.columns
    f = {r["bucket"].minute: r.asDict() for r in build_features(system, llm, "5 minutes").collect()}
    b0, b10 = f[0], f[10]
    assert b0["n_sys_requests"] == 3 and b0["n_unique_ips"] == 2
    assert abs(b0["top_ip_share"] - 2 / 3) < 1e-12
    assert b0["method_entropy"] == 0.0                  # one method only
    assert abs(b0["avg_score"] - (0.5 + 0.1 + 0.9) / 3) < 1e-12   # missing score -> 0.5
    assert b0["n_llm_requests"] == 0 and b0["avg_llm_score"] == 0.0
    assert b10["n_sys_requests"] == 0 and b10["avg_score"] == 0.0  # LLM-only bucket: 0, not 0.5
    assert b10["avg_llm_latency"] == 0.0 and b10["p95_llm_latency"] == 0.0   # all-null latency
    assert b10["llm_to_sys_ratio"] == 1.0 and b10["total_requests"] == 1.0


def test_exact_quantile_matches_linear_interpolation(spark):
    df = spark.createDataFrame([("a", float(v)) for v in (1, 2, 3, 10)] + [("b", 7.0)], "g string, v double")
    q = {r["g"]: r["p"] for r in exact_quantile(df, ["g"], "v", 0.95, "p").collect()}
    assert abs(q["a"] - 8.95) < 1e-12 and q["b"] == 7.0


def test_exact_quantile_hot_group_many_partitions(spark):
    import numpy as np
    vals = np.random.default_rng(1).random(20000)
    df = spark.createDataFrame([("hot", float(v)) for v in vals] + [("cold", 1.0)], "g string, v double")
    q = {r["g"]: r["p"] for r in exact_quantile(df, ["g"], "v", 0.95, "p", num_partitions=16).collect()}
    assert abs(q["hot"] - float(np.quantile(vals, 0.95))) < 1e-12


def test_runs_gap_and_length(spark):
    t0 = dt.datetime(2024, 1, 1)
    mins = [0, 5, 15, 100, 110, 200, 205, 210]     # gaps 5, 10 | 85 | 10 | 90 | 5, 5
    df = spark.createDataFrame([(t0 + dt.timedelta(minutes=m),) for m in mins], "bucket timestamp_ntz")
    r = {row["bucket"]: row["in_multi_run"] for row in CL.multi_bucket_runs(df).collect()}
    got = [r[t0 + dt.timedelta(minutes=m)] for m in mins]
    assert got == [True, True, True, False, False, True, True, True]


def test_severity_strict_thresholds(spark):
    df = spark.createDataFrame([(-0.3,), (-0.31,), (-0.15,), (-0.2,), (0.0,)], "s double")
    assert [r[0] for r in df.select(CL.severity(F.col("s"))).collect()] == [
        "MEDIUM", "HIGH", "LOW", "MEDIUM", "LOW"]


def test_category_ties_first_rule_wins(spark):
    # rate_limit_rate*4 = 4.0 (DDoS, rule 0) ties server_error_rate*4 = 4.0 (rule 3).
    top = spark.createDataFrame(
        [(dt.datetime(2024, 1, 1), [("rate_limit_rate", "l", 0.0, 0.0, 1.0, "(alto)"),
                                    ("server_error_rate", "l", 0.0, 0.0, 1.0, "(alto)")]),
         (dt.datetime(2024, 1, 2), [("n_unique_regions", "l", 0.0, 0.0, 3.0, "(alto)")])],
        "bucket timestamp_ntz, top_deviations array<struct<feature:string,label:string,value:double,"
        "baseline:double,z_score:double,direction:string>>")
    out = {r["bucket"].day: r["attack_category"]
           for r in CL.attack_category(top, CL.rules_frame(spark)).collect()}
    assert out[1] == "DDoS / Flooding de Trafico"
    assert out[2] == C.DEFAULT_CATEGORY                # negative weight only


def test_dedup_and_upsert_idempotent(spark):
    old = spark.createDataFrame([("a", 1.0), ("b", 2.0), ("", 0.0)], "_id string, v double")
    new = spark.createDataFrame([("b", 20.0), ("c", 3.0), ("", 9.0)], "_id string, v double")
    once = MG.upsert(old, new)
    twice = MG.upsert(once, new)
    expect = {"a": 1.0, "b": 20.0, "c": 3.0, "": 9.0}
    assert {r["_id"]: r["v"] for r in once.collect()} == expect
    assert {r["_id"]: r["v"] for r in twice.collect()} == expect
    assert MG.new_row_count(old, new).first()["new_rows"] == 1


def test_quantile_of_mostly_equal_values(spark):
    """Nine of ten values are one: it is a row a task, and the rows of all partitions are few and even."""
    from riskspark.operators.quantile import exact_quantile
    df = spark.range(100_000).select((F.col("id") % 3).alias("g"), F.when(F.col("id") % 10 > 0, 7.5)
                                     .otherwise(F.pmod(F.xxhash64("id"), F.lit(10**6)) / 10**4).alias("v"))
    df = df.unionByName(spark.range(3).select(F.col("id").alias("g"), F.lit(None).cast("double").alias("v")))
    for q in (0.0, 0.5, 0.95, 1.0):
        got = {r["g"]: r["q"] for r in exact_quantile(df, ["g"], "v", q, "q", 8).collect()}
        want = {r["g"]: r["q"] for r in df.groupBy("g").agg(F.percentile("v", q).alias("q")).collect()}
        assert got.keys() == want.keys() and all(abs(got[k] - want[k]) < 1e-9 for k in want)
    rows = df.where("v IS NOT NULL").groupBy("g", "v").count().repartitionByRange(8, "g", "v")
    sizes = [r["count"] for r in rows.groupBy(F.spark_partition_id()).count().collect()]
    assert len(sizes) == 8 and max(sizes) < 2 * min(sizes)


def test_runs_are_stitched_over_days(spark):
    import datetime as dt
    import random
    from riskspark.operators.classify import multi_bucket_runs
    rng = random.Random(1)
    steps = sorted(rng.sample(range(3000), 800))
    rows = [(k, dt.datetime(2024, 1, 1) + dt.timedelta(minutes=5 * x)) for k in ("a", None) for x in steps]
    flagged = spark.createDataFrame(rows, "env string, bucket timestamp_ntz")
    ids, run = [], 0
    for before, x in zip([None, *steps], steps, strict=False):
        run += before is None or (x - before) * 5 > 10
        ids.append(run)
    want = [(rows[i][1], run, ids.count(run)) for i, run in enumerate(ids)]
    for df, keys in ((flagged, ["env"]), (flagged.select("bucket").distinct(), [])):
        got = multi_bucket_runs(df, keys).collect()
        for k in {tuple(r[c] for c in keys) for r in got}:
            own = [(r["bucket"], r["run_id"], r["run_len"]) for r in got if tuple(r[c] for c in keys) == k]
            assert sorted(own) == want
