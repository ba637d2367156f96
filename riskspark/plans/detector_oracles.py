"""DuckDB SQL of the two detectors: half-space trees and the isolation forest.

Both grow their trees here again, from digests, level by level, and walk every
bucket down by joins; nothing of the engine's trees is read.
"""
from __future__ import annotations

from .. import constants as C
from ..operators.hst import PADDING
from ..operators.iforest import EULER
from . import oracle as O


def frac(*parts: str) -> str:
    """SQL twin of operators.chance.fraction; the parts are SQL expressions."""
    text = " || ':' || ".join(f"CAST({p} AS VARCHAR)" for p in parts)
    return f"(CAST('0x' || substr(md5({text}), 1, 8) AS BIGINT) / 4294967296.0)"


def hst_ctes(n_trees: int = C.HST_TREES, height: int = C.HST_HEIGHT, window: int = C.HST_WINDOW, seed: int = 42) -> str:
    """hst(bucket, hst_score, warm, hst_flag) over ``features``."""
    cols = C.STREAMING_FEATURES
    n = len(cols)
    mm = ", ".join(f"CAST(min({c}) AS DOUBLE) AS lo_{c}, CAST(max({c}) AS DOUBLE) AS hi_{c}" for c in cols)
    xs = ", ".join(f"CASE WHEN hi_{c} > lo_{c} THEN least(greatest(({c} - lo_{c}) / (hi_{c} - lo_{c}), 0.0), 1.0) ELSE 0.0 END"
                   for c in cols)
    pick = f"CAST(floor({frac(str(seed), 'tree', 'node', chr(39) + 'feature' + chr(39))} * {n}) AS INT) + 1"
    return f"""hn AS (
  SELECT tree, CAST(0 AS BIGINT) AS node, 0 AS depth, [0.0::DOUBLE for i in range({n})] AS lo, [1.0::DOUBLE for i in range({n})] AS hi
  FROM range({n_trees}) AS t(tree)
  UNION ALL
  SELECT tree, 2 * node + side, depth + 1, CASE WHEN side = 2 THEN [CASE WHEN i = f THEN t ELSE lo[i] END for i in range(1, {n + 1})] ELSE lo END,
    CASE WHEN side = 1 THEN [CASE WHEN i = f THEN t ELSE hi[i] END for i in range(1, {n + 1})] ELSE hi END
  FROM (SELECT *, a + {PADDING} * (b - a) + {frac(str(seed), 'tree', 'node', "'split'")} * (b - {PADDING} * (b - a) - (a + {PADDING} * (b - a))) AS t
        FROM (SELECT *, lo[f] AS a, hi[f] AS b FROM (SELECT *, {pick} AS f FROM hn WHERE depth < {height}))),
    (VALUES (1), (2)) AS s(side)),
hsplit AS (SELECT tree, node, f, a + {PADDING} * (b - a) + {frac(str(seed), 'tree', 'node', "'split'")} * (b - {PADDING} * (b - a) - (a + {PADDING} * (b - a))) AS t
  FROM (SELECT *, lo[f] AS a, hi[f] AS b FROM (SELECT *, {pick} AS f FROM hn WHERE depth < {height}))),
hmm AS (SELECT {mm} FROM features),
hx AS (SELECT bucket, row_number() OVER (ORDER BY bucket) AS rank, [{xs}] AS x FROM features, hmm),
hpath AS (
  SELECT bucket, rank, x, tree, CAST(0 AS BIGINT) AS node, 0 AS depth FROM hx, range({n_trees}) AS t(tree)
  UNION ALL
  SELECT p.bucket, rank, x, p.tree, 2 * p.node + CASE WHEN x[f] >= t THEN 2 ELSE 1 END, depth + 1
  FROM hpath p JOIN hsplit s ON p.tree = s.tree AND p.node = s.node),
hcount AS (SELECT tree, node, (rank - 1) // {window} AS w, count(*) AS n FROM hpath GROUP BY ALL),
hmass AS (SELECT bucket, sum(coalesce(n, 0) * pow(2.0, depth)) AS mass
  FROM hpath p LEFT JOIN hcount c ON p.tree = c.tree AND p.node = c.node AND (p.rank - 1) // {window} - 1 = c.w GROUP BY bucket),
hst AS (SELECT *, hst_score >= {C.HST_THRESHOLD} AS hst_flag FROM (
  SELECT bucket, CASE WHEN rank > {window} THEN 1.0 - mass / {float(n_trees * window * (2 ** (height + 1) - 1))} ELSE 0.0 END AS hst_score,
    rank >= {window} AS warm FROM hx JOIN hmass USING (bucket)))"""


def forest_ctes(n_trees: int = C.IFOREST_TREES, sample: int = C.IFOREST_SAMPLE, seed: int = C.IFOREST_SEED,
                contamination: float = C.IFOREST_CONTAMINATION) -> str:
    """ifs(bucket, anomaly_score), ifp(..., prediction) over ``features``: fitted on all buckets."""
    cols = C.FEATURE_COLS
    levels = max(sample - 1, 1).bit_length()
    sd = ", ".join(f"CAST(avg({c}) AS DOUBLE) AS m_{c}, CASE WHEN coalesce(stddev_pop({c}), 0.0) = 0 THEN 1.0 ELSE stddev_pop({c}) END AS s_{c}"
                   for c in cols)
    xs = ", ".join(f"(CAST({c} AS DOUBLE) - m_{c}) / s_{c}" for c in cols)
    out = [f"ifst AS (SELECT count(*) AS n, {sd} FROM features)",
           f"ifx AS (SELECT bucket, [{xs}] AS x FROM features, ifst)",
           f"ifpsi AS (SELECT least({sample}, count(*)) AS psi, greatest(ceil(log2(greatest(least({sample}, count(*)), 2))), 1) AS most FROM ifx)",
           f"""ifrow0 AS (SELECT tree, CAST(1 AS BIGINT) AS node, x FROM (SELECT tree, x, row_number() OVER (PARTITION BY tree
             ORDER BY md5('{seed}:' || CAST(tree AS VARCHAR) || ':' || CAST(bucket AS VARCHAR)), bucket) AS r
             FROM ifx, range({n_trees}) AS t(tree)) WHERE r <= {sample})""",
           f"ifat0 AS (SELECT bucket, x, tree, CAST(1 AS BIGINT) AS node FROM ifx, range({n_trees}) AS t(tree))"]
    for d in range(levels):
        out += [f"""ifsplit{d} AS MATERIALIZED (SELECT tree, node, c[k].f AS f, c[k].lo + u * (c[k].hi - c[k].lo) AS t FROM (
              SELECT tree, node, c, {frac(str(seed), 'tree', 'node', "'split'")} AS u,
                CAST(floor({frac(str(seed), 'tree', 'node', "'feature'")} * len(c)) AS INT) + 1 AS k
              FROM (SELECT tree, node, list({{'f': f, 'lo': lo, 'hi': hi}} ORDER BY f) AS c FROM (
                SELECT tree, node, f, min(v) AS lo, max(v) AS hi FROM (
                  SELECT tree, node, unnest(x) AS v, unnest(range(1, {len(cols) + 1})) AS f FROM ifrow{d}) GROUP BY ALL)
                WHERE hi > lo GROUP BY tree, node), ifpsi WHERE {d} < most))""",
                f"ifleaf{d} AS (SELECT tree, node, count(*) AS n FROM ifrow{d} ANTI JOIN ifsplit{d} USING (tree, node) GROUP BY ALL)",
                f"""ifrow{d + 1} AS MATERIALIZED (SELECT tree, 2 * node + CASE WHEN x[f] < t THEN 0 ELSE 1 END AS node, x
              FROM ifrow{d} JOIN ifsplit{d} USING (tree, node))""",
                f"""ifat{d + 1} AS MATERIALIZED (SELECT bucket, x, tree, 2 * node + CASE WHEN x[f] < t THEN 0 ELSE 1 END AS node
              FROM ifat{d} JOIN ifsplit{d} USING (tree, node))"""]
    out.append(f"ifleaf{levels} AS (SELECT tree, node, count(*) AS n FROM ifrow{levels} GROUP BY ALL)")

    def c(n: str) -> str:
        return f"CASE WHEN {n} > 2 THEN 2.0 * (ln({n} - 1.0) + {EULER}) - 2.0 * ({n} - 1.0) / {n} WHEN {n} = 2 THEN 1.0 ELSE 0.0 END"
    ends = " UNION ALL ".join(f"SELECT bucket, {d} + {c('n')} AS h FROM ifat{d} JOIN ifleaf{d} USING (tree, node)" for d in range(levels + 1))
    out += [f"ifs AS (SELECT bucket, -pow(2.0, -(sum(h) / {n_trees}) / nullif(any_value({c('psi')}), 0)) AS anomaly_score FROM ({ends}), ifpsi GROUP BY bucket)",
            f"ifp AS (SELECT *, CASE WHEN anomaly_score < (SELECT quantile_cont(anomaly_score, {contamination}) FROM ifs) THEN -1 ELSE 1 END AS prediction FROM ifs)"]
    return ",\n".join(out)


def with_detectors(bucket: str, *ctes: str) -> str:
    return ",\n".join([O.base_ctes(bucket).rstrip().replace("WITH ", "WITH RECURSIVE ", 1), *ctes]) + "\n"
