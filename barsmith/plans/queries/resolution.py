"""Instrument resolution."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from barsmith.operators.resolve import missing_symbols, resolve_indices, resolve_symbols
from barsmith.plans import driver_views as V
from barsmith.plans.queries.common import register


# Match rules for the part-based master (fixture values, same shape as the
# index rules of the collection job).
PART_INDEX_RULES = {
    "RED_WIDGET": (["RED WIDGET"], ["WIDGET"], ["ECONOMY", "Brand#1"], "NSE"),
    "HOT_ANY": (["hot"], [], ["ring", "rod"], "BSE"),
    "LARGE_BOLT": (["large bolt", "big bolt"], ["bolt"], ["PROMO"], "BSE"),
    "NEW_PARTS": (["NEW"], ["OLD"], ["Brand#2"], "NSE"),
}


def _sql_list_hit(words: list[str], text: str) -> str:
    if not words:
        return "FALSE"
    return "(" + " OR ".join(f"contains(upper({text}), upper('{w}'))" for w in words) + ")"


def _index_resolve_sql() -> str:
    branches = []
    for name, (pref, fb, exc, exch) in PART_INDEX_RULES.items():
        inc_p = "TRUE" if not pref else _sql_list_hit(pref, "text")
        inc_f = _sql_list_hit(fb, "text")
        no_x = f"NOT {_sql_list_hit(exc, 'text')}"
        base = (f"CASE WHEN {inc_p} AND {no_x} THEN 2 "
                + (f"WHEN {inc_f} AND {no_x} THEN 1 " if fb else "")
                + "END")
        branches.append(
            f"SELECT '{name}' AS name, row_seq, sid, text, "
            f"{base} + CASE WHEN exch = '{exch}' THEN 1 ELSE 0 END AS score FROM m")
    union = "\nUNION ALL\n".join(branches)
    return f"""
WITH m AS (
  SELECT p_partkey AS row_seq, CAST(p_partkey AS VARCHAR) AS sid,
         trim(CASE WHEN p_size = 1 THEN '' ELSE p_brand END || ' ' || p_name) AS text,
         CASE p_size % 3 WHEN 0 THEN 'NSE' WHEN 1 THEN 'NSE' ELSE 'BSE' END AS exch
  FROM part WHERE p_type IN ('PROMO', 'STANDARD', 'LARGE', 'SMALL')),
c AS (SELECT * FROM ({union}) WHERE score IS NOT NULL),
r AS (SELECT *, row_number() OVER (PARTITION BY name ORDER BY score DESC, row_seq) AS rn,
             count(*) OVER (PARTITION BY name) AS n_candidates FROM c)
SELECT name, sid AS security_id, score, row_seq, text, n_candidates FROM r WHERE rn = 1
"""


@register("index_resolve", _index_resolve_sql())
def index_resolve(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Best INDEX row of the part master
    for each match rule, by keyword score, exchange bonus and line order."""
    master = V.part_master(V.table(spark, sf_dir, "part"))
    return resolve_indices(master, PART_INDEX_RULES)


_EQUITY_CTE = """
WITH m AS (
  SELECT p_partkey AS row_seq, CAST(p_partkey AS VARCHAR) AS sid,
         p_type = 'ECONOMY' AS is_eq, p_name AS underlying_symbol,
         CASE WHEN p_size = 1 THEN '' ELSE p_brand END AS symbol_name
  FROM part WHERE p_size % 3 IN (0, 1) AND p_size <= 45),
p AS (
  SELECT underlying_symbol AS symbol, sid FROM (
    SELECT *, row_number() OVER (PARTITION BY underlying_symbol ORDER BY is_eq DESC,
           CASE WHEN is_eq THEN -row_seq ELSE row_seq END) AS rn FROM m
    WHERE underlying_symbol <> '') WHERE rn = 1),
f AS (
  SELECT symbol_name AS symbol, sid FROM (
    SELECT *, row_number() OVER (PARTITION BY symbol_name ORDER BY is_eq DESC,
           CASE WHEN is_eq THEN -row_seq ELSE row_seq END) AS rn FROM m
    WHERE symbol_name <> '') WHERE rn = 1),
req AS (
  SELECT p_name AS symbol FROM part UNION SELECT p_brand FROM part
  UNION SELECT upper(p_type) FROM part)"""


@register("symbol_resolve", _EQUITY_CTE + """
SELECT req.symbol, coalesce(p.sid, f.sid) AS security_id,
       CASE WHEN p.sid IS NOT NULL THEN 'UNDERLYING_SYMBOL'
            WHEN f.sid IS NOT NULL THEN 'SYMBOL_NAME' END AS matched_on
FROM req LEFT JOIN p ON p.symbol = req.symbol LEFT JOIN f ON f.symbol = req.symbol
""")
def symbol_resolve(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Requested symbols -> security id via the trading
    symbol lookup, else the symbol-name lookup, over NSE equity rows."""
    part = V.table(spark, sf_dir, "part")
    return resolve_symbols(V.part_master(part), V.requested_symbols(part))


@register("symbol_missing", _EQUITY_CTE + """
SELECT symbol FROM req
WHERE symbol NOT IN (SELECT symbol FROM p) AND symbol NOT IN (SELECT symbol FROM f)
""")
def symbol_missing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Requested symbols neither lookup can resolve (reported, skipped)."""
    part = V.table(spark, sf_dir, "part")
    return missing_symbols(V.part_master(part), V.requested_symbols(part))
