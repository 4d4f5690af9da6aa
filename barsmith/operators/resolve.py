"""Instrument master resolution.

The master is a table of text columns whose header names vary; every field is
read as the first non-empty of its alternative columns (an empty cell counts
as missing). ``row_seq`` is the master's line order; ties are decided by it.

Index resolution scores every INDEX row against every match rule. The rules
are configuration (a handful of entries), so they are inlined as a literal
array and applied per master row -- no nested-loop join -- and the best row
per rule is a ``max_by`` aggregate (partial on the map side).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from barsmith.functions.text import combined_text, first_non_empty, matches_keywords, strip_ws


def field(df: DataFrame, *names: str, default: str | None = "") -> Column:
    """First non-empty of the alternative columns that exist in ``df``."""
    present = [n for n in names if n in df.columns]
    if not present:
        return F.lit(default).cast("string")
    return first_non_empty(*present, default=default)


def rules_literal(rules: dict[str, tuple[list[str], list[str], list[str], str]]) -> Column:
    """Match rules -> ``array<struct<name, preferred, fallback, exclude, preferred_exch>>``."""
    def arr(words):
        return F.array(*[F.lit(w) for w in words]).cast("array<string>")
    return F.array(*[
        F.struct(F.lit(name).alias("name"), arr(p).alias("preferred"), arr(f).alias("fallback"),
                 arr(x).alias("exclude"), F.lit(exch).alias("preferred_exch"))
        for name, (p, f, x, exch) in rules.items()])


def index_candidates(master: DataFrame, rules: Column) -> DataFrame:
    """INDEX rows scored against each rule: preferred keywords 2, else
    fallback keywords 1 (only when a fallback list exists), +1 on the rule's
    exchange; rows matching neither are not candidates."""
    m = master.select(
        "row_seq",
        F.upper(field(master, "INSTRUMENT_TYPE", "InstrumentType")).alias("itype"),
        combined_text(field(master, "SYMBOL_NAME", "SymbolName"),
                      field(master, "DISPLAY_NAME", "DisplayName")).alias("text"),
        F.upper(field(master, "EXCH_ID", "ExchangeId")).alias("exch"),
        field(master, "SEM_SMST_SECURITY_ID", "SecurityID", "SECURITY_ID", default=None)
        .alias("security_id"),
    ).where((F.col("itype") == "INDEX") & (F.col("text") != ""))

    def score(r: Column) -> Column:
        pref = matches_keywords(F.col("text"), r["preferred"], r["exclude"])
        fb = (F.size(r["fallback"]) > 0) & matches_keywords(F.col("text"), r["fallback"],
                                                             r["exclude"])
        base = F.when(pref, F.lit(2)).when(fb, F.lit(1))
        return F.struct(r["name"].alias("name"),
                        (base + (F.col("exch") == r["preferred_exch"]).cast("int")).alias("score"))

    scored = m.select("*", F.explode(F.filter(F.transform(rules, score),
                                              lambda s: s["score"].isNotNull())).alias("hit"))
    return scored.select(F.col("hit.name").alias("name"), F.col("hit.score").alias("score"),
                         "row_seq", "security_id", "text", "exch")


def resolve_indices(master: DataFrame, rules: dict) -> DataFrame:
    """Best INDEX row per rule (highest score, then earliest row); fails when
    a rule has no candidate or the winner has no security id."""
    cands = index_candidates(master, rules_literal(rules))
    best = cands.groupBy("name").agg(
        F.max_by(F.struct("security_id", "row_seq", "text", "exch", "score"),
                 F.struct(F.col("score"), -F.col("row_seq"))).alias("b"),
        F.count(F.lit(1)).alias("n_candidates"))
    names = master.sparkSession.createDataFrame([(n,) for n in rules], "name string")
    j = F.broadcast(names).join(best, "name", "left")  # one row per configured rule
    sid = F.col("b.security_id")
    checked = (F.when(F.col("b").isNull(),
                      F.raise_error(F.concat(F.lit("Could not find index instrument for "),
                                             F.col("name"))))
               .when(sid.isNull(), F.raise_error(F.lit("Missing security ID in instrument row.")))
               .otherwise(sid))
    return j.select("name", checked.alias("security_id"), F.col("b.score").alias("score"),
                    F.col("b.row_seq").alias("row_seq"), F.col("b.text").alias("text"),
                    F.coalesce("n_candidates", F.lit(0)).alias("n_candidates"))


def equity_lookups(master: DataFrame) -> DataFrame:
    """Two lookups over NSE equity rows with a security id (F2, P9) in one pass
    over the master: ``symbol``, the id by trading symbol (``sid_primary``) and
    by symbol name (``sid_fallback``). Per key, the last EQ-series row wins,
    else the first row (A3)."""
    m = master.select(
        "row_seq",
        F.upper(field(master, "EXCH_ID")).alias("exch"),
        F.upper(field(master, "INSTRUMENT")).alias("instrument"),
        field(master, "SEM_SMST_SECURITY_ID", "SecurityID", "SECURITY_ID", default=None)
        .alias("security_id"),
        F.upper(field(master, "SERIES", "SEM_SERIES")).alias("series"),
        strip_ws(field(master, "UNDERLYING_SYMBOL")).alias("underlying_symbol"),
        strip_ws(field(master, "SYMBOL_NAME")).alias("symbol_name"),
    ).where((F.col("exch") == "NSE") & (F.col("instrument") == "EQUITY")
            & F.col("security_id").isNotNull())
    is_eq = F.col("series") == "EQ"
    rank = F.struct(is_eq, F.when(is_eq, F.col("row_seq")).otherwise(-F.col("row_seq")))

    keys = F.array(F.struct(F.lit(True).alias("primary"), F.col("underlying_symbol").alias("symbol")),
                   F.struct(F.lit(False).alias("primary"), F.col("symbol_name").alias("symbol")))
    both = m.select("security_id", rank.alias("rank"), F.inline(keys)).where(F.col("symbol") != "")

    def best(primary: bool) -> Column:
        return F.max_by("security_id", F.when(F.col("primary") == primary, F.col("rank")))
    return both.groupBy("symbol").agg(
        F.when(F.count_if("primary") > 0, best(True)).alias("sid_primary"),
        F.when(F.count_if(~F.col("primary")) > 0, best(False)).alias("sid_fallback"))


def resolve_symbols(master: DataFrame, requested: DataFrame) -> DataFrame:
    """Requested symbols (duplicates collapse, A7) -> security id by trading
    symbol, else by symbol name (J1, J2); unmatched symbols get null (J3)."""
    j = requested.select("symbol").distinct().join(equity_lookups(master), "symbol", "left")
    return j.select(
        "symbol", F.coalesce("sid_primary", "sid_fallback").alias("security_id"),
        F.when(F.col("sid_primary").isNotNull(), F.lit("UNDERLYING_SYMBOL"))
        .when(F.col("sid_fallback").isNotNull(), F.lit("SYMBOL_NAME")).alias("matched_on"))


def missing_symbols(master: DataFrame, requested: DataFrame) -> DataFrame:
    """Requested symbols found by neither lookup (J3). Taken from the same
    left-join chain as ``resolve_symbols`` (a key-side anti join would be
    pushed below the union of requested lists and repeat the lookups)."""
    return resolve_symbols(master, requested).where(F.col("security_id").isNull()) \
        .select("symbol")
