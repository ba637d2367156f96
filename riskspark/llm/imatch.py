"""I-Match fingerprints over randomised lexicon subsets, in DataFrame functions.

The lexicon holds the terms whose document frequency lies in a band (their
inverse document frequency is neither low nor high).  A text's distinct
lexicon terms are sorted and hashed, and so are those that fall into each of 25
random subsets of the lexicon: five draws each of one term in 4, 16, 64, 256
and 1,024, so that short and long texts both have subsets that an edit leaves
as they were.  The likeness of two fingerprints is
the share of equal hashes among the subsets that either text has terms of.

By Markov's inequality the lexicon has at most (mean distinct terms of a
text) / ``least_share`` terms, however many texts there are; it goes into the
plan as a set.  Document frequencies cover all texts.
"""
from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import id_and_text

LEAST_SHARE, MOST_SHARE = 0.002, 0.05
DRAWS, SCALES = 5, (2, 4, 6, 8, 10)  # a subset keeps one in 2 ** scale terms
#: Terms are runs of anything but ASCII characters that are no letters or digits.
BETWEEN = "[\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+"
NONE = "0"


def terms(text: str) -> str:
    """SQL for the distinct lower-case terms of the text column."""
    return f"array_remove(array_distinct(split(lower(`{text}`), r'{BETWEEN}')), '')"


def lexicon(texts: DataFrame, least_share: float = LEAST_SHARE, most_share: float = MOST_SHARE) -> list[str]:
    """Terms in at least ``least_share`` and at most ``most_share`` of the texts (column
    ``text``), and in two texts or more; in order."""
    n = texts.count()
    counts = texts.select(F.explode(F.expr(terms("text"))).alias("term")).groupBy("term").agg(
        F.count(F.lit(1)).alias("n"))
    lo, hi = max(2.0, least_share * n), most_share * n
    return sorted(r.term for r in counts.where((F.col("n") >= lo) & (F.col("n") <= hi)).select("term").collect())


def fingerprint(text: str, words: list[str]) -> Column:
    """Array of the subset hashes of a text column; a text without lexicon terms has a hash of the
    whole text instead, and an empty text none."""
    # The lexicon goes to the plan as one SQL text (terms have neither quotes nor backslashes):
    # a literal made for each word by itself kept the driver busy for half a minute.
    known = "t IN ({})".format(", ".join(f"'{w}'" for w in words)) if words else "false"
    found = F.array_sort(F.expr(f"filter({terms(text)}, t -> {known})"))

    def subset(marks: Column, scale: int) -> Column:
        return _hash(F.filter(marks, lambda h: h.bitwiseAND(F.lit((1 << scale) - 1)) == 0))

    def drawn(chosen: Column, draw: int) -> Column:
        return _let(F.transform(chosen, lambda t: F.xxhash64(F.lit(draw), t)),
                    lambda marks: F.array(*[subset(marks, s) for s in SCALES]))

    def hashed(chosen: Column) -> Column:
        parts = [F.array(_hash(F.transform(chosen, lambda t: F.xxhash64(t)))),
                 *[drawn(chosen, draw) for draw in range(DRAWS)]]
        plain = F.array(F.when(F.col(text) == "", F.lit(NONE)).otherwise(
            F.concat(F.lit("t"), F.lower(F.hex(F.xxhash64(F.col(text)))))),
            *[F.lit(NONE)] * (DRAWS * len(SCALES)))
        return F.when(F.size(chosen) > 0, F.concat(*parts)).otherwise(plain)

    return _let(found, hashed)


def _let(value: Column, body) -> Column:
    """``body`` of a value that is computed once."""
    return F.transform(F.array(value), body)[0]


def _hash(marks: Column) -> Column:
    return F.when(F.size(marks) == 0, F.lit(NONE)).otherwise(F.lower(F.hex(F.xxhash64(marks))))


def likeness(a: Column, b: Column) -> Column:
    """Share of equal hashes among subsets that are not empty in both (0 if all are)."""
    pairs = F.zip_with(a, b, lambda x, y: F.struct(x.alias("x"), y.alias("y")))
    used = F.filter(pairs, lambda p: (p["x"] != NONE) | (p["y"] != NONE))
    same = F.filter(used, lambda p: p["x"] == p["y"])
    return F.when(F.size(used) > 0, F.size(same) / F.size(used)).otherwise(F.lit(0.0))


def with_next(docs: DataFrame, words: list[str], id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id``, ``text``, ``fingerprint``, and ``next_text``, ``next_fingerprint`` of the next
    document by id (then digest); the first one follows the last.

    Documents are dealt into ranges of ids of about equal size; each range is
    ordered by one task, and also gets the first row of the range after it.  A
    text's fingerprint is made before and moves with it, so that there is one
    shuffle of texts and none of fingerprints.  Repeated rows follow each other.
    """
    rows = id_and_text(docs, id_col, text_col)
    ids = rows.select("doc_id")
    parts = 4 * int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    cuts = ids.agg(F.percentile_approx("doc_id", [i / parts for i in range(parts)], 100 * parts)).first()[0]
    cuts = sorted(set(cuts or []))
    range_of = F.expr(f"size(filter(array({', '.join(map(str, cuts))}), c -> c <= doc_id))")
    part = F.when(F.col("doc_id").isNull(), F.lit(0)).otherwise(range_of).alias("part")
    leaders = [r.least for r in ids.select(part, "doc_id").groupBy("part").agg(F.min("doc_id").alias("least")).collect()
               if r.least is not None]  # one id for each range

    def marked(found: DataFrame) -> DataFrame:
        return found.select(part, "doc_id", F.sha2("text", 256).alias("digest"), "text")

    leads = F.expr(f"doc_id IN ({', '.join(map(str, leaders))})") if leaders else F.lit(False)
    first = marked(rows.where(F.col("doc_id").isNull() | leads)).groupBy("part").agg(
        F.min(F.struct("doc_id", "digest", "text")).alias("r"))
    by_part = Window.orderBy("part")  # over one row for each range
    before = (first.withColumn("to", F.lag("part").over(by_part))
              .withColumn("end", F.max("part").over(Window.partitionBy()))
              .select(F.coalesce("to", "end").alias("part"), "r.*", F.lit(True).alias("guest")))
    every = marked(rows).withColumn("guest", F.lit(False)).unionByName(before).withColumn(
        "fingerprint", fingerprint("text", words))
    order = Window.partitionBy("part").orderBy("guest", F.col("doc_id").asc_nulls_first(), "digest")
    # Two plain columns: a struct of them would be made before the shuffle, and every text moved twice.
    return (every.select("*", F.lead("text").over(order).alias("next_text"),
                         F.lead("fingerprint").over(order).alias("next_fingerprint"))
            .where(~F.col("guest")).select("doc_id", "text", "fingerprint", "next_text", "next_fingerprint"))


def edited(text: Column, after: Column) -> Column:
    """The last quarter of a text (rounded down) replaced by as many first characters of the next."""
    cut = F.floor(F.length(text) / 4).cast("int")
    return F.concat(F.substring(text, F.lit(1), F.length(text) - cut), F.substring(after, F.lit(1), cut))


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                 least_share: float = LEAST_SHARE, most_share: float = MOST_SHARE) -> DataFrame:
    """One row per input row: ``doc_id``, ``n_chars``, ``edited_sha256``, ``fingerprint`` and
    ``edited_fingerprint`` (arrays), ``near_edited`` and ``near_next``.

    A null text is empty; empty texts have no hash and a likeness of 0 to
    anything.  Equal texts have equal fingerprints.  Null ids come first, repeated
    rows follow each other, the only document follows itself, an empty table
    gives an empty table, and other columns are ignored.
    """
    words = lexicon(id_and_text(docs, id_col, text_col).select("text"), least_share, most_share)
    made = with_next(docs, words, id_col, text_col).select(
        "doc_id", "text", "fingerprint", "next_fingerprint", edited(F.col("text"), F.col("next_text")).alias("changed"))
    return made.withColumn("edited_fingerprint", fingerprint("changed", words)).select(
        "doc_id", F.length("text").cast("long").alias("n_chars"), F.sha2("changed", 256).alias("edited_sha256"),
        "fingerprint", "edited_fingerprint",
        likeness(F.col("fingerprint"), F.col("edited_fingerprint")).alias("near_edited"),
        likeness(F.col("fingerprint"), F.col("next_fingerprint")).alias("near_next"))
