"""Registered queries, step 3: baseline, explanation, detection and classification."""
from __future__ import annotations

from pyspark.sql import functions as F

from .. import constants as C
from ..operators import alerts as AL
from ..operators import baseline as BL
from ..operators import classify as CL
from ..operators.logsets import top_value_per_bucket
from . import oracle as O
from .common import QUERY_BUCKET, cleaned, present
from .detect import run_gap_minutes, with_bucket_context, z_chain

QUERIES: dict = {}
ORACLES: dict = {}


def register(name, sql=None):
    def deco(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn
    return deco


B = QUERY_BUCKET
THRESHOLD = 5.0


def _q(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


META = "meta(feature, feature_ord, label) AS (VALUES " + ", ".join(
    f"({_q(f)}, {i}, {_q(C.FEATURE_LABELS.get(f, f))})" for i, f in enumerate(C.FEATURE_COLS)) + ")"
RULES = "rules(rule_ord, category, feature, weight) AS (VALUES " + ", ".join(
    f"({i}, {_q(c)}, {_q(f)}, {int(w)})" for i, c, f, w in C.rules_rows()) + ")"
CAT_EN = "cat_en(category, category_en) AS (VALUES " + ", ".join(
    f"({_q(k)}, {_q(v)})" for k, v in C.CATEGORY_EN.items()) + ")"
LABEL_EN = "label_en(label, label_en) AS (VALUES " + ", ".join(
    f"({_q(k)}, {_q(v)})" for k, v in C.LABEL_EN.items()) + ")"


def pyfloat_sql(x: str, d: int) -> str:
    t = f"regexp_replace(CAST(CAST({O.half_even(x, d)} AS DECIMAL(38,{d})) AS VARCHAR), '0+$', '')"
    return f"CASE WHEN {t} LIKE '%.' THEN {t} || '0' ELSE {t} END"


def thousands_sql(x: str) -> str:
    return f"format('{{:,}}', CAST({O.half_even(x, 0)} AS BIGINT))"


GAP = run_gap_minutes(B)
CHAIN = O.base_ctes(B) + f""",
{META},
{RULES},
long AS (SELECT bucket, feature, value FROM (UNPIVOT features ON {", ".join(C.FEATURE_COLS)}
         INTO NAME feature VALUE value)),
base AS (SELECT feature, avg(value) AS mean, stddev_samp(value) + 1e-6 AS std,
         count(*) AS n_buckets FROM long GROUP BY feature),
z AS (SELECT l.bucket, l.feature, m.feature_ord, m.label, {O.half_even('l.value', 4)} AS value,
        {O.half_even('b.mean', 4)} AS baseline, (l.value - b.mean) / b.std AS z_raw,
        {O.half_even('(l.value - b.mean) / b.std', 2)} AS z_score,
        CASE WHEN (l.value - b.mean) / b.std > 0 THEN '(alto)' ELSE '(bajo)' END AS direction
      FROM long l JOIN base b USING (feature) JOIN meta m USING (feature)),
td AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY bucket
         ORDER BY abs(z_score) DESC, feature_ord) AS rank FROM z WHERE z_score IS NOT NULL)
       WHERE rank <= 5),
det0 AS (SELECT bucket, coalesce(max(abs(round(z_raw, 6))), 0.0) AS m FROM z GROUP BY bucket),
det AS (SELECT bucket, m AS max_abs_z, -m / (m + {THRESHOLD}) AS anomaly_score,
        m > {THRESHOLD} AS is_anomaly FROM det0),
flagged AS (SELECT bucket, anomaly_score FROM det WHERE is_anomaly),
runs0 AS (SELECT bucket, CASE WHEN lag(bucket) OVER (ORDER BY bucket) IS NULL OR
          date_diff('second', lag(bucket) OVER (ORDER BY bucket), bucket) / 60.0 > {GAP}
          THEN 1 ELSE 0 END AS brk FROM flagged),
runs1 AS (SELECT bucket, sum(brk) OVER (ORDER BY bucket ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)
          AS run_id FROM runs0),
runs AS (SELECT bucket, run_id, count(*) OVER (PARTITION BY run_id) AS run_len,
         count(*) OVER (PARTITION BY run_id) >= 3 AS in_multi_run FROM runs1),
stats AS (SELECT mean AS n_requests_mean, std AS n_requests_std,
          mean + 2.5 * std AS spike_threshold FROM base WHERE feature = 'n_sys_requests'),
catsc AS (SELECT td.bucket, r.rule_ord, r.category,
          sum(CAST(td.z_score AS DECIMAL(12,2)) * r.weight) AS score
          FROM td JOIN rules r USING (feature) GROUP BY ALL),
catbest AS (SELECT bucket, arg_max(category, -rule_ord) AS cat, max(score) AS best FROM
            (SELECT *, max(score) OVER (PARTITION BY bucket) AS mx FROM catsc) WHERE score = mx GROUP BY bucket),
cat AS (SELECT b.bucket, CASE WHEN coalesce(c.best > 1.0, false) THEN c.cat ELSE {_q(C.DEFAULT_CATEGORY)} END
        AS attack_category, CASE WHEN coalesce(c.best > 1.0, false) THEN CAST(c.best AS DOUBLE) ELSE 1.0 END
        AS category_score FROM (SELECT DISTINCT bucket FROM td) b LEFT JOIN catbest c USING (bucket)),
top1 AS (SELECT * FROM td WHERE rank = 1),
anom AS (SELECT f.bucket, f.anomaly_score,
          CASE WHEN coalesce(r.in_multi_run, false) THEN 'MULTI_BUCKET'
               WHEN coalesce(x.n_sys_requests, 0.0) > s.spike_threshold THEN 'SPIKE'
               ELSE 'CATEGORIZATION' END AS anomaly_type,
          CASE WHEN f.anomaly_score < -0.3 THEN 'HIGH' WHEN f.anomaly_score < -0.15 THEN 'MEDIUM'
               ELSE 'LOW' END AS severity,
          coalesce(c.attack_category, {_q(C.DEFAULT_CATEGORY)}) AS attack_category,
          coalesce(x.n_sys_requests, 0.0) AS n_sys_requests, s.spike_threshold,
          t.label AS t_label, t.value AS t_value, t.baseline AS t_baseline, t.z_score AS t_z,
          t.direction AS t_direction, t.feature AS t_feature
        FROM flagged f LEFT JOIN runs r USING (bucket) LEFT JOIN features x USING (bucket)
        LEFT JOIN cat c USING (bucket) LEFT JOIN top1 t USING (bucket), stats s),
anom_r AS (SELECT *, CASE WHEN t_label IS NULL THEN {_q(C.REASON_NO_DEVIATION)}
    WHEN anomaly_type = 'SPIKE' THEN 'Pico de tráfico: ' || {thousands_sql('floor(n_sys_requests)')} ||
      ' requests en 5 min (umbral: ' || {thousands_sql('spike_threshold')} || '). Feature más desviada: ' ||
      t_label || ' = ' || {pyfloat_sql('t_value', 4)} || ' (z=' || {pyfloat_sql('t_z', 2)} || ').'
    WHEN anomaly_type = 'MULTI_BUCKET' THEN 'Patrón sostenido en múltiples ventanas. Feature dominante: ' ||
      t_label || ' = ' || {pyfloat_sql('t_value', 4)} || ' (z=' || {pyfloat_sql('t_z', 2)} || ', baseline=' ||
      {pyfloat_sql('t_baseline', 4)} || ').'
    ELSE 'Combinación inusual de patrones. Top feature: ' || t_label || ' = ' || {pyfloat_sql('t_value', 4)} ||
      ' (' || t_direction || ', z=' || {pyfloat_sql('t_z', 2)} || ', baseline=' || {pyfloat_sql('t_baseline', 4)} || ').'
    END AS reason FROM anom)
"""


def _chain(spark, sf_dir):
    return z_chain(spark, sf_dir, B, threshold=THRESHOLD)


@register("q_baseline", CHAIN + "SELECT feature, " + ", ".join([
    O.round6("mean", "mean"), O.round6("std", "std")]) +
    ", n_buckets, " + O.round6("CASE WHEN feature = 'n_sys_requests' THEN mean END",
                                "n_requests_mean") + " FROM base")
def q_baseline(spark, sf_dir):
    """Per-feature mean and sample std (+1e-6) over the baseline window."""
    ch = _chain(spark, sf_dir)
    st = ch.stats.select("n_requests_mean")
    b = ch.base.select("feature", "mean", "std", "n_buckets")
    out = b.withColumn("n_requests_mean", F.when(F.col("feature") == "n_sys_requests",
                                                  F.col("mean")))
    del st
    return present(out)


@register("q_scaled", CHAIN + """, pop AS (SELECT feature, avg(value) AS mean, stddev_pop(value) AS sd
  FROM long GROUP BY feature)
SELECT l.bucket, l.feature, """ + O.round6(
    "(l.value - p.mean) / CASE WHEN coalesce(p.sd, 0) = 0 THEN 1.0 ELSE p.sd END", "x") +
    " FROM long l JOIN pop p USING (feature)")
def q_scaled(spark, sf_dir):
    """M1: standardised features (population std, zero std -> 1)."""
    ch = _chain(spark, sf_dir)
    return present(BL.scaled(ch.features, ch.base))


@register("q_zscores", CHAIN + "SELECT bucket, feature, label, value, baseline, " +
          O.round6("z_score", "z_score") + ", direction FROM z")
def q_zscores(spark, sf_dir):
    """Every feature of every bucket against the baseline."""
    ch = _chain(spark, sf_dir)
    return present(ch.z.select("bucket", "feature", "label", "value", "baseline", "z_score",
                               "direction"))


@register("q_top_deviations", CHAIN + "SELECT bucket, rank, feature, label, value, baseline, "
          "z_score, direction FROM td")
def q_top_deviations(spark, sf_dir):
    """Top-5 deviations per bucket (rank order, feature order on ties)."""
    ch = _chain(spark, sf_dir)
    return present(ch.top.select("bucket", F.posexplode("top_deviations").alias("pos", "d"))
                   .select("bucket", (F.col("pos") + 1).alias("rank"), "d.*"))


@register("q_z_anomalies", CHAIN + "SELECT bucket, " + O.round6("max_abs_z", "max_abs_z") + ", " +
          O.round6("anomaly_score", "anomaly_score") + " FROM det WHERE is_anomaly")
def q_z_anomalies(spark, sf_dir):
    """Deterministic detector (max |z| > 5), F8 mask."""
    ch = _chain(spark, sf_dir)
    return present(ch.detector.where("is_anomaly").select("bucket", "max_abs_z", "anomaly_score"))


@register("q_runs", CHAIN + "SELECT bucket, run_len, in_multi_run FROM runs")
def q_runs(spark, sf_dir):
    """Gaps and islands over flagged buckets (gap = two buckets)."""
    ch = _chain(spark, sf_dir)
    r = CL.multi_bucket_runs(ch.flagged(), [], run_gap_minutes(B))
    return r.select("bucket", "run_len", "in_multi_run")


@register("q_anomaly_type", CHAIN + "SELECT bucket, anomaly_type, severity, " +
          O.round6("anomaly_score", "anomaly_score") + ", reason, attack_category FROM anom_r")
def q_anomaly_type(spark, sf_dir):
    """M7 (+M8, M9, P19): typed, graded, categorised anomalies with their reason."""
    ch = _chain(spark, sf_dir)
    return present(ch.anomalies().select("bucket", "anomaly_type", "severity", "anomaly_score",
                                         "reason", "attack_category"))


@register("q_severity", CHAIN + "SELECT bucket, " + O.round6("anomaly_score", "anomaly_score") +
          ", CASE WHEN anomaly_score < -0.3 THEN 'HIGH' WHEN anomaly_score < -0.15 THEN 'MEDIUM' "
          "ELSE 'LOW' END AS severity FROM det")
def q_severity(spark, sf_dir):
    """M8 on fixed (deterministic) scores for every bucket."""
    ch = _chain(spark, sf_dir)
    return present(ch.detector.select("bucket", "anomaly_score",
                                      CL.severity(F.col("anomaly_score")).alias("severity")))


@register("q_attack_category", CHAIN + "SELECT bucket, attack_category, " +
          O.round6("category_score", "category_score") + " FROM cat")
def q_attack_category(spark, sf_dir):
    """Threat category of every bucket from its top-5 deviations."""
    ch = _chain(spark, sf_dir)
    return present(CL.attack_category(ch.top, ch.rules))


@register("q_reason", CHAIN + "SELECT bucket, anomaly_type, reason FROM anom_r")
def q_reason(spark, sf_dir):
    """Reason texts with Python-style number formatting."""
    ch = _chain(spark, sf_dir)
    return ch.anomalies().select("bucket", "anomaly_type", "reason")


def _anoms_with_context(spark, sf_dir):
    ch = _chain(spark, sf_dir)
    a = with_bucket_context(ch.anomalies(), ch.features, [])
    sysc, _ = cleaned(spark, sf_dir, B)
    tip = top_value_per_bucket(sysc, "sourceip", [], a.select("bucket"))
    return a.join(tip.withColumnRenamed("value", "top_ip"), "bucket", "left")


def pyfixed(x: str, d: int) -> str:
    return f"printf('%.{d}f', {O.half_even(x, d)})"


TOPIP = """, ipc AS (SELECT bucket, sourceip, count(*) AS c FROM sysc
   WHERE bucket IN (SELECT bucket FROM flagged) GROUP BY ALL),
topip AS (SELECT bucket, min(sourceip) AS top_ip FROM
   (SELECT *, max(c) OVER (PARTITION BY bucket) AS mx FROM ipc) WHERE c = mx GROUP BY bucket)"""

MSG = CHAIN + TOPIP + f""",
{CAT_EN},
{LABEL_EN},
m0 AS (SELECT a.*, coalesce(x.error_rate, 0.0) AS err, coalesce(x.n_sys_requests, 0.0) AS n_req,
  coalesce(tp.top_ip, 'N/A') AS tip,
  'WHAT: ' || coalesce(ce.category_en, a.attack_category) || ' [' || a.anomaly_type || '] sev=' || a.severity || '.' AS what,
  ' WHEN: ' || strftime(a.bucket, '%Y-%m-%dT%H:%M:%S') || '+00:00.' AS whn,
  CASE WHEN a.t_label IS NULL THEN {_q(C.NO_DEVIATION_DETAIL)} ELSE
    coalesce(le.label_en, a.t_label) || '=' || {pyfixed('a.t_value', 3)} || ' (z=' ||
    printf('%+.2f', {O.half_even('a.t_z', 2)}) || ', baseline=' || {pyfixed('a.t_baseline', 3)} || ')' END AS detail
  FROM anom_r a LEFT JOIN features x USING (bucket) LEFT JOIN topip tp USING (bucket)
  LEFT JOIN cat_en ce ON ce.category = a.attack_category LEFT JOIN label_en le ON le.label = a.t_label),
m1 AS (SELECT *, ' WHY: ' || detail || ', ' || CAST(CAST(n_req AS BIGINT) AS VARCHAR) || ' reqs, err=' ||
  {pyfixed('err * 100.0', 1)} || '%, top_ip=' || tip || '.' AS why,
  {C.MAX_MESSAGE_CHARS} - length(what) - length(whn) - 1 AS budget FROM m0),
m2 AS (SELECT *, CASE WHEN length(what || whn || why) <= {C.MAX_MESSAGE_CHARS} THEN what || whn || why
  WHEN length(' WHY: ' || detail || '.') <= budget THEN what || whn || ' WHY: ' || detail || '.'
  ELSE what || whn || rtrim(' WHY: ' || substr(detail, 1, budget - 8) || '...') || '.' END AS msg0 FROM m1),
msgs AS (SELECT *, substr(msg0, 1, {C.MAX_MESSAGE_CHARS}) AS message,
  CASE WHEN severity <> 'LOW' AND attack_category IN ({", ".join(_q(c) for c in C.SECURITY_ALERT_CATEGORIES)})
  THEN 'QUEUED' ELSE 'SKIPPED' END AS status FROM m2)
"""


@register("q_alert_message", MSG + "SELECT bucket, tip AS top_ip, message FROM msgs")
def q_alert_message(spark, sf_dir):
    """English alert text (<= 300 chars) per anomaly."""
    a = AL.with_messages(_anoms_with_context(spark, sf_dir))
    return a.select("bucket", F.coalesce("top_ip", F.lit("N/A")).alias("top_ip"), "message")


@register("q_alert_filter", MSG + "SELECT bucket, anomaly_type, attack_category, severity, status, "
          "message FROM msgs WHERE status = 'QUEUED'")
def q_alert_filter(spark, sf_dir):
    """Outbox rows to deliver (not LOW, escalation category only)."""
    box = AL.outbox(_anoms_with_context(spark, sf_dir))
    return box.where(F.col("status") == "QUEUED").select(
        "bucket", "anomaly_type", "attack_category", "severity", "status", "message")


@register("q_alert_counters", MSG + "SELECT status, count(*) AS n_alerts FROM msgs GROUP BY status")
def q_alert_counters(spark, sf_dir):
    """Queued vs skipped alert counts."""
    return AL.alert_counters(AL.outbox(_anoms_with_context(spark, sf_dir)))
