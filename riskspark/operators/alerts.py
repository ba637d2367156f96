"""Alert messages, filtering and the outbox."""
from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import constants as C
from ..functions.columns import fixed_text, lookup, signed_fixed_text


def translate_category(c: Column) -> Column:
    return lookup(C.CATEGORY_EN, c)


def translate_label(c: Column) -> Column:
    return lookup(C.LABEL_EN, c)


def iso_instant(bucket: Column) -> Column:
    """The bucket instant as ISO text; UTC-aware instants carry '+00:00'."""
    return F.concat(F.date_format(bucket, "yyyy-MM-dd'T'HH:mm:ss"), F.lit("+00:00"))


def percent_text(x: Column, digits: int = 1) -> Column:
    """P27: '{:.1%}'."""
    return F.concat(fixed_text(x.cast("double") * F.lit(100.0), digits), F.lit("%"))


def message(a_type: Column, category: Column, sev: Column, bucket: Column, top: Column,
            n_requests: Column, error_rate: Column, top_ip: Column,
            max_chars: int = C.MAX_MESSAGE_CHARS) -> Column:
    """P20: WHAT / WHEN / WHY text of at most ``max_chars`` characters.

    Too long: drop the request tail of WHY; still too long: cut the detail
    to the remaining budget minus 8 and mark it with '...'.
    """
    what = F.concat(F.lit("WHAT: "), translate_category(category), F.lit(" ["), a_type,
                    F.lit("] sev="), sev, F.lit("."))
    when = F.concat(F.lit(" WHEN: "), iso_instant(bucket), F.lit("."))
    detail = F.when(top.isNull(), F.lit(C.NO_DEVIATION_DETAIL)).otherwise(F.concat(
        translate_label(top["label"]), F.lit("="), fixed_text(top["value"], 3),
        F.lit(" (z="), signed_fixed_text(top["z_score"], 2), F.lit(", baseline="),
        fixed_text(top["baseline"], 3), F.lit(")")))
    n = F.coalesce(n_requests, F.lit(0.0)).cast("double").cast("long").cast("string")
    why = F.concat(F.lit(" WHY: "), detail, F.lit(", "), n, F.lit(" reqs, err="),
                   percent_text(F.coalesce(error_rate, F.lit(0.0))), F.lit(", top_ip="),
                   F.coalesce(top_ip, F.lit("N/A")), F.lit("."))
    full = F.concat(what, when, why)
    budget = F.lit(max_chars) - F.length(what) - F.length(when) - F.lit(1)
    short = F.concat(F.lit(" WHY: "), detail, F.lit("."))
    cut = F.concat(F.rtrim(F.concat(F.lit(" WHY: "),
                                    F.substring(detail, F.lit(1), budget - F.lit(8)),
                                    F.lit("..."))), F.lit("."))
    shortened = F.concat(what, when, F.when(F.length(short) > budget, cut).otherwise(short))
    msg = F.when(F.length(full) > F.lit(max_chars), shortened).otherwise(full)
    return F.substring(msg, 1, max_chars)


def alert_decision(sev: Column, category: Column,
                   categories: list[str] = C.SECURITY_ALERT_CATEGORIES) -> Column:
    """QUEUED when not LOW and the category escalates; else SKIPPED."""
    send = (sev != F.lit("LOW")) & category.isin(*categories)
    return F.when(F.coalesce(send, F.lit(False)), F.lit("QUEUED")).otherwise(F.lit("SKIPPED"))


def with_messages(anomalies: DataFrame, top_ip: str | Column = "top_ip") -> DataFrame:
    """Add ``message`` to anomaly rows (n_requests, error_rate, top_ip columns)."""
    tip = F.col(top_ip) if isinstance(top_ip, str) else top_ip
    return anomalies.withColumn("message", message(
        F.col("anomaly_type"), F.col("attack_category"), F.col("severity"),
        F.col("bucket"), F.get(F.col("top_deviations"), 0), F.col("n_requests"),
        F.col("error_rate"), tip))


def outbox(anomalies: DataFrame) -> DataFrame:
    """K8: alert rows to deliver (QUEUED) and the skipped ones, with their text.

    Delivery itself is outside the engine: a consumer reads QUEUED rows.
    """
    return (with_messages(anomalies)
            .withColumn("status", alert_decision(F.col("severity"), F.col("attack_category"))))


def alert_counters(box: DataFrame) -> DataFrame:
    """Number of queued (to send) and skipped alerts."""
    return box.groupBy("status").agg(F.count(F.lit(1)).alias("n_alerts"))


def delivered(box: DataFrame, outcomes: DataFrame, keys: list[str] | None = None) -> DataFrame:
    """ALERT_LOG rows of queued alerts with what their delivery came to.

    ``outcomes`` (anomaly_id, sent_at, http_status, api_response): what a consumer
    of the outbox brings back, the latest of each alert counts.  A status code of
    200 to 299 is SENT, any other or none FAILED; an alert without outcome stays QUEUED.
    """
    last = outcomes.groupBy("anomaly_id").agg(F.max_by(F.struct("http_status", "api_response", F.col("sent_at")),
                                                       "sent_at").alias("o"))
    sent = F.coalesce(F.col("o.http_status").between(200, 299), F.lit(False))
    rows = box.where(F.col("status") == "QUEUED").join(last, "anomaly_id", "left")
    log = alert_log_rows(rows, F.col("o.sent_at"), keys, "anomaly_id", "o")
    status = F.when(F.col("o").isNull(), "QUEUED").when(sent, "SENT").otherwise("FAILED")
    return log.select(*[(status if c == "status" else F.col("o.http_status").cast("int") if c == "http_status"
                         else F.col("o.api_response") if c == "api_response" else F.col(c)).alias(c)
                        for c in log.columns if c not in ("anomaly_id", "o")])


def delivery_counters(log: DataFrame, box: DataFrame) -> DataFrame:
    """Alerts sent, failed, still queued, and skipped."""
    return (log.select("status").unionByName(box.where(F.col("status") == "SKIPPED").select("status"))
            .groupBy("status").agg(F.count(F.lit(1)).alias("n_alerts")))


def alert_log_rows(box: DataFrame, sent_at: Column | None = None, keys: list[str] | None = None,
                   *more: str) -> DataFrame:
    """K7: ALERT_LOG rows for queued alerts (text fields cut to their column sizes), and the columns ``more``.

    The id is made of ``keys``, bucket and message: a retried cycle meets its own rows.
    """
    sent = sent_at if sent_at is not None else F.current_timestamp()
    q = box.where(F.col("status") == "QUEUED")
    return q.select(
        F.sha2(F.concat_ws("|", *(keys or []), F.col("bucket").cast("string"), F.col("message")), 256)
        .alias("alert_id"),
        sent.alias("sent_at"),
        F.substring(F.col("bucket").cast("string"), 1, 30).alias("bucket_start"),
        F.substring("anomaly_type", 1, 30).alias("anomaly_type"),
        F.substring("attack_category", 1, 100).alias("attack_category"),
        F.substring("severity", 1, 10).alias("severity"),
        F.substring("status", 1, 10).alias("status"),
        F.lit(None).cast("int").alias("http_status"),
        F.substring("message", 1, 300).alias("message_sent"),
        F.lit(None).cast("string").alias("api_response"), *more)
