"""DuckDB SQL of ``scale_queries``: each result straight from the whole table."""

from __future__ import annotations

LATEST = """
WITH b AS (SELECT user_id, event_type, event_id, value, CAST(least((day(ts) - 1) // 5 + 1, 6) AS BIGINT) AS batch_id FROM events),
latest AS (SELECT user_id, event_type, event_id, value, batch_id FROM (
  SELECT *, row_number() OVER (PARTITION BY user_id, event_type ORDER BY batch_id DESC, event_id) AS rn FROM b) WHERE rn = 1)"""

HOT = """
WITH li AS (SELECT l_orderkey, l_linenumber, l_quantity, l_returnflag,
                   CASE WHEN l_orderkey % 3 = 0 THEN 1 ELSE l_partkey END AS part,
                   CASE WHEN l_orderkey % 3 = 0 THEN 1 ELSE l_suppkey END AS supp FROM lineitem)"""

TAGS = """
WITH tags AS (SELECT CASE WHEN l_orderkey % 3 = 0 THEN 'hot' || (l_suppkey % 7) WHEN l_orderkey % 31 = 0 THEN 'warm' || (l_suppkey % 40)
                          WHEN l_orderkey % 29 = 0 THEN NULL ELSE l_orderkey || '-' || l_linenumber END AS tag FROM lineitem)"""


def _profile(columns: list[str], numeric: list[str]) -> str:
    def one(c: str) -> str:
        stats = (f"round(avg({c}), 4) AS mean, round(stddev_samp({c}), 4) AS std, CAST(min({c}) AS DOUBLE) AS min, CAST(max({c}) AS DOUBLE) AS max"
                 if c in numeric else "CAST(NULL AS DOUBLE) AS mean, CAST(NULL AS DOUBLE) AS std, CAST(NULL AS DOUBLE) AS min, CAST(NULL AS DOUBLE) AS max")
        return (f"SELECT '{c}' AS \"column\", count(*) AS rows, count({c}) AS count, count(*) - count({c}) AS nulls, {stats}, "
                "TRUE AS ranks_ok, TRUE AS distinct_ok FROM lineitem")
    return "\nUNION ALL ".join(one(c) for c in columns)


FOOTERS = {"orders": ["o_orderkey", "o_custkey", "o_totalprice", "o_orderstatus", "o_orderpriority", "o_orderdate"],
           "customer": ["c_custkey", "c_nationkey", "c_acctbal", "c_name", "c_mktsegment"],
           "part": ["p_partkey", "p_size", "p_retailprice", "p_name", "p_brand", "p_type"]}
TEXTS = {"o_orderstatus", "o_orderpriority", "c_name", "c_mktsegment", "p_name", "p_brand", "p_type"}


def _footers() -> str:
    def one(table: str, c: str) -> str:
        none = "CAST(NULL AS DOUBLE) AS min_num, CAST(NULL AS DOUBLE) AS max_num"
        if c in TEXTS:
            stats = f"{none}, min({c}) AS min_text, max({c}) AS max_text"
        elif c == "o_orderdate":
            stats = f"{none}, strftime(min({c}), '%Y-%m-%d %H:%M:%S.%f') AS min_text, strftime(max({c}), '%Y-%m-%d %H:%M:%S.%f') AS max_text"
        else:
            stats = f"CAST(min({c}) AS DOUBLE) AS min_num, CAST(max({c}) AS DOUBLE) AS max_num, CAST(NULL AS VARCHAR) AS min_text, CAST(NULL AS VARCHAR) AS max_text"
        return f"SELECT '{table}' AS \"table\", '{c}' AS \"column\", count(*) AS rows, count(*) - count({c}) AS nulls, {stats} FROM {table}"
    return "\nUNION ALL ".join(one(t, c) for t, cols in FOOTERS.items() for c in cols)


SQL = {
    "footer_profile": _footers(),
    "store_latest": f"{LATEST}\nSELECT * FROM latest",
    "store_lookup": f"{LATEST}\nSELECT * FROM latest WHERE event_type = 'click' AND user_id IN (SELECT c_custkey FROM customer WHERE c_custkey % 10 = 3)",
    "publish_versions": """
WITH o AS (SELECT o_orderstatus, count(*) AS n FROM orders GROUP BY 1),
v AS (SELECT 1 AS version, 'F' AS s UNION ALL SELECT 2, 'F' UNION ALL SELECT 2, 'O' UNION ALL SELECT 3, 'P')
SELECT CAST(version AS BIGINT) AS version, CAST(sum(n) OVER (PARTITION BY version) AS BIGINT) AS listed, o_orderstatus, n
FROM v JOIN o ON o.o_orderstatus = v.s""",
    "load_keeps_old": """
SELECT step, step = 1 AS raised, count(*) AS n, CAST(sum(o_orderkey) AS BIGINT) AS keys
FROM orders, (SELECT 0 AS step, 'F' AS s UNION ALL SELECT 1, 'F' UNION ALL SELECT 2, 'P') WHERE o_orderstatus = s GROUP BY step""",
    "left_join_skewed": f"""{HOT}
SELECT l.l_orderkey, l.l_linenumber, l.l_quantity, l.part, l.supp,
       coalesce(r.n_returned, 0) AS n_returned, coalesce(r.qty_returned, 0.0) AS qty_returned
FROM li l LEFT JOIN (SELECT part, supp, count(*) AS n_returned, sum(l_quantity) AS qty_returned FROM li WHERE l_returnflag = 'R' GROUP BY part, supp) r
  ON l.part = r.part AND l.supp = r.supp""",
    "topk_heavy": f"{TAGS}\nSELECT tag, count(*) AS count FROM tags WHERE tag IS NOT NULL GROUP BY tag ORDER BY count DESC, tag LIMIT 12",
    "heavy_tags": f"{TAGS}\nSELECT tag, count(*) AS count FROM tags GROUP BY tag HAVING count(*) >= 5",
    "profile_incremental": _profile(["l_quantity", "l_extendedprice", "l_discount", "l_partkey", "l_returnflag"],
                                    ["l_quantity", "l_extendedprice", "l_discount", "l_partkey"]),
    "yearly_unique_states": """
SELECT year(o_orderdate) AS year, count(*) AS rows, count(DISTINCT o_custkey) AS n_customers, TRUE AS distinct_ok
FROM orders WHERE o_orderdate IS NOT NULL GROUP BY 1""",
    "density_binned": """
WITH data AS (SELECT CAST(c_acctbal AS DOUBLE) AS x FROM customer WHERE c_acctbal IS NOT NULL),
s AS (SELECT min(x) AS lo, max(x) AS hi, count(*) AS n, stddev_samp(x) AS sd FROM data),
b AS (SELECT lo, hi, n, sd * pow(n, -1.0 / 5.0) AS bw FROM s),
g AS (SELECT lo - 3.0 * bw AS start, ((hi + 3.0 * bw) - (lo - 3.0 * bw)) / 199 AS step, bw, n, bw / 64 AS cell FROM b),
spots AS (SELECT (x - start) / cell AS p FROM data, g),
edges AS (SELECT floor(p) AS e, 1.0 - (p - floor(p)) AS w FROM spots UNION ALL SELECT floor(p) + 1, p - floor(p) FROM spots),
grid AS (SELECT CAST(range AS BIGINT) AS point, start + range * step AS gx, bw, n, start, cell FROM g, range(0, 200))
SELECT point, round(gx, 4) AS x,
       round(sum(w * exp(-0.5 * pow((gx - (start + e * cell)) / bw, 2))) * (1.0 / (n * bw * sqrt(2.0 * pi()))), 12) AS density
FROM grid, edges GROUP BY point, gx, bw, n""",
    "running_by_key": """
SELECT l_orderkey, l_linenumber, l_quantity, sum(l_quantity) OVER o AS quantity_so_far, row_number() OVER o AS position
FROM lineitem WINDOW o AS (ORDER BY l_orderkey, l_linenumber, l_quantity ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)""",
}
