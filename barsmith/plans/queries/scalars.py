"""Scalar expressions."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql import types as T

from barsmith import functions as X
from barsmith.config import STRIKE_BUCKETS
from barsmith.operators.cast import cast_to_schema
from barsmith.plans import driver_views as V
from barsmith.plans.queries.common import IST_ISO, register


@register("epoch_to_iso", f"""
SELECT event_id, epoch_us(ts) // 1000000 AS ts,
       {IST_ISO.format(x='epoch_us(ts) // 1000000')} AS datetime,
       CAST(make_timestamp((epoch_us(ts) // 1000000) * 1000000) + INTERVAL 330 MINUTE AS DATE)
         AS ist_date
FROM events
""")
def epoch_to_iso(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Epoch seconds -> IST ISO text and IST day."""
    ev = V.table(spark, sf_dir, "events")
    sec = X.epoch_seconds("ts")
    return ev.select("event_id", sec.alias("ts"), X.epoch_to_ist_iso(sec).alias("datetime"),
                     X.epoch_to_ist_date(sec).alias("ist_date"))


_ATM_VARIANTS = {"raw": "o_totalprice", "half": "floor(o_totalprice / 25) * 25",
                 "small": "o_totalprice / 10000"}


def _atm_oracle() -> str:
    cols = []
    for v, expr in _ATM_VARIANTS.items():
        for s in (50, 100):
            atm = f"CAST(round_even(CAST({expr} AS DOUBLE) / {s}, 0) AS BIGINT) * {s}"
            cols.append(f"{atm} AS atm_{v}_{s}")
            cols.append(f"CASE WHEN {atm} = 0 THEN NULL ELSE CAST({atm} AS DOUBLE) END "
                        f"AS stored_{v}_{s}")
    return "SELECT o_orderkey, " + ",\n  ".join(cols) + "\nFROM orders"


@register("atm_strike", _atm_oracle())
def atm_strike_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Half-even ATM strike for steps 50 and 100 on order totals, on
    totals snapped to 25 (exact half steps) and on tiny totals (zero ATM)."""
    o = V.table(spark, sf_dir, "orders")
    cols = [F.col("o_orderkey")]
    for v, expr in _ATM_VARIANTS.items():
        spot = F.expr(expr).cast("double")
        for s in (50, 100):
            atm = X.atm_strike(spot, F.lit(s))
            cols += [atm.alias(f"atm_{v}_{s}"), X.stored_atm(atm).alias(f"stored_{v}_{s}")]
    return o.select(*cols)


MONEYNESS_SQL = """
WITH c AS (
  SELECT p_partkey,
         CASE WHEN p_size > 45 THEN NULL ELSE p_retailprice END AS spot,
         CAST(round_even(p_retailprice / 50, 0) AS BIGINT) * 50 AS atm0,
         p_brand, p_retailprice, o, option_type
  FROM part, unnest(range(-10, 12)) AS t(o), unnest(['CE', 'PE']) AS s(option_type)),
d AS (
  SELECT *,
    CASE WHEN spot IS NULL THEN NULL ELSE atm0 END AS atm_strike,
    CASE WHEN o = 11 THEN NULL ELSE CAST(o AS INTEGER) END AS strike_offset,
    CASE WHEN p_brand = 'Brand#1' THEN NULL
         WHEN o = 11 THEN p_retailprice
         ELSE CAST(atm0 + 50 * o AS DOUBLE) END AS strike
  FROM c)
SELECT p_partkey, option_type, strike_offset, strike, spot, atm_strike,
  CASE WHEN strike IS NOT NULL AND spot IS NOT NULL AND atm_strike IS NOT NULL THEN
    CASE WHEN abs(strike - atm_strike) < CAST(0.01 AS DOUBLE) THEN 'ATM'
         WHEN option_type = 'CE' THEN CASE WHEN strike < spot THEN 'ITM' ELSE 'OTM' END
         ELSE CASE WHEN strike > spot THEN 'ITM' ELSE 'OTM' END END
  ELSE '' END AS moneyness
FROM d
"""


@register("moneyness", MONEYNESS_SQL)
def moneyness_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    """An option chain per part (spot = retail price, step 50):
    offsets -10..10 and one strike equal to spot, both sides; spot missing
    for sizes above 45, strike missing for Brand#1."""
    p = V.table(spark, sf_dir, "part")
    atm0 = X.atm_strike(F.col("p_retailprice"), F.lit(50))
    chain = (p.select("p_partkey", "p_brand", "p_retailprice",
                      F.when(F.col("p_size") > 45, F.lit(None).cast("double"))
                      .otherwise(F.col("p_retailprice")).alias("spot"),
                      atm0.alias("atm0"),
                      F.explode(F.sequence(F.lit(-10), F.lit(11))).alias("o"))
             .select("*", F.explode(F.array(F.lit("CE"), F.lit("PE"))).alias("option_type")))
    d = chain.select(
        "p_partkey", "option_type", "spot",
        F.when(F.col("spot").isNull(), F.lit(None)).otherwise(F.col("atm0")).alias("atm_strike"),
        F.when(F.col("o") == 11, F.lit(None)).otherwise(F.col("o")).alias("strike_offset"),
        F.when(F.col("p_brand") == "Brand#1", F.lit(None).cast("double"))
        .when(F.col("o") == 11, F.col("p_retailprice"))
        .otherwise((F.col("atm0") + 50 * F.col("o")).cast("double")).alias("strike"))
    return d.select("p_partkey", "option_type", "strike_offset", "strike", "spot", "atm_strike",
                    X.guarded_moneyness("option_type", "strike", "spot", "atm_strike")
                    .alias("moneyness"))


@register("strike_offset", """
SELECT o_orderkey, CAST(o_orderkey % 21 AS INTEGER) AS bucket_idx,
  CASE WHEN o_orderkey % 21 = 0 THEN 'ATM'
       WHEN o_orderkey % 21 <= 10 THEN 'ATM+' || CAST(o_orderkey % 21 AS VARCHAR)
       ELSE 'ATM-' || CAST(o_orderkey % 21 - 10 AS VARCHAR) END AS bucket,
  CAST(CASE WHEN o_orderkey % 21 <= 10 THEN o_orderkey % 21 ELSE 10 - o_orderkey % 21 END
       AS TINYINT) AS strike_offset
FROM orders
""")
def strike_offset_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each order draws one of the 21 bucket labels (in request
    order) and the label is parsed back to a tinyint offset."""
    o = V.table(spark, sf_dir, "orders")
    labels = F.array(*[F.lit(b) for b in STRIKE_BUCKETS])
    idx = (F.col("o_orderkey") % len(STRIKE_BUCKETS)).cast("int")
    return (o.select("o_orderkey", idx.alias("bucket_idx"),
                     F.element_at(labels, idx + 1).alias("bucket"))
            .withColumn("strike_offset", X.strike_offset("bucket")))


@register("text_to_number", """
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey,
  CASE WHEN l_linenumber = 1 THEN NULL ELSE l_extendedprice END AS price,
  CASE WHEN l_linenumber = 1 THEN NULL ELSE CAST(trunc(l_extendedprice) AS BIGINT) END AS price_int,
  CAST(trunc(CASE WHEN l_returnflag = 'R' THEN -l_extendedprice ELSE l_extendedprice END)
       AS BIGINT) AS signed_int,
  CAST(trunc(l_quantity) AS BIGINT) AS qty,
  CAST(trunc(l_discount) AS BIGINT) AS disc_int,
  CASE WHEN l_returnflag = 'R' THEN -l_extendedprice ELSE l_extendedprice END AS signed_price
FROM lineitem
""")
def text_to_number(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Numbers sent as text (``''`` for first lines, negative
    for returns, integer text for quantities) parsed back; int truncates
    toward zero."""
    li = V.table(spark, sf_dir, "lineitem")
    price_txt = F.when(F.col("l_linenumber") == 1, F.lit("")) \
        .otherwise(F.col("l_extendedprice").cast("string"))
    signed = F.when(F.col("l_returnflag") == "R", -F.col("l_extendedprice")) \
        .otherwise(F.col("l_extendedprice")).cast("string")
    qty_txt = F.col("l_quantity").cast("bigint").cast("string")
    disc_txt = F.col("l_discount").cast("string")
    # Named texts, then named numbers: every cell is written and parsed once.
    keys = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"]
    texts = {"price": price_txt, "signed": signed, "qty": qty_txt, "disc": disc_txt}
    named = li.select(*keys, *[t.alias(f"{n}_txt") for n, t in texts.items()])
    parsed = named.select("*", *[F.col(f"{n}_txt").try_cast("double").alias(f"{n}_num") for n in texts])
    whole = {n: X.to_long(f"{n}_txt", parsed=F.col(f"{n}_num")) for n in texts}
    number = {n: F.nullif(F.col(f"{n}_num"), F.lit(float("nan"))) for n in texts}
    return parsed.select(
        *keys, number["price"].alias("price"), whole["price"].alias("price_int"),
        whole["signed"].alias("signed_int"), whole["qty"].alias("qty"),
        whole["disc"].alias("disc_int"), number["signed"].alias("signed_price"))


_CAST_TARGET = T.StructType([
    T.StructField("l_orderkey", T.LongType()), T.StructField("l_linenumber", T.IntegerType()),
    T.StructField("ts", T.LongType()), T.StructField("volume", T.LongType()),
    T.StructField("oi", T.LongType()), T.StructField("expiry_code", T.ByteType()),
    T.StructField("strike_offset", T.ByteType()), T.StructField("close", T.DoubleType()),
])


@register("cast_and_fill", """
SELECT l_orderkey, l_linenumber, epoch_us(l_shipdate) // 1000000 AS ts,
  CASE WHEN l_returnflag = 'N' THEN 0 ELSE CAST(l_quantity AS BIGINT) END AS volume,
  CASE WHEN l_linestatus = 'O' THEN 0 ELSE l_orderkey END AS oi,
  CAST(l_linenumber AS TINYINT) AS expiry_code,
  CAST(l_quantity - 25 AS TINYINT) AS strike_offset,
  l_extendedprice AS close
FROM lineitem
""")
def cast_and_fill(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Loosely typed columns (volume as double with nulls, oi with
    nulls, codes as int) cast to the stored types; volume and oi null -> 0."""
    li = V.table(spark, sf_dir, "lineitem")
    loose = li.select(
        "l_orderkey", "l_linenumber", X.epoch_seconds("l_shipdate").alias("ts"),
        F.when(F.col("l_returnflag") == "N", F.lit(None).cast("double"))
        .otherwise(F.col("l_quantity")).alias("volume"),
        F.when(F.col("l_linestatus") == "O", F.lit(None).cast("bigint"))
        .otherwise(F.col("l_orderkey")).alias("oi"),
        F.col("l_linenumber").alias("expiry_code"),
        (F.col("l_quantity") - 25).alias("strike_offset"),
        F.col("l_extendedprice").alias("close"))
    return cast_to_schema(loose, _CAST_TARGET, zero_fill=("volume", "oi"))


@register("trim_cells", """
SELECT c_custkey, c_name AS name, upper(c_mktsegment) AS segment,
       contains(upper(c_mktsegment), 'BUILD') AS is_building
FROM customer
""")
def trim_cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cells padded with spaces and tabs are stripped (Python strip
    semantics), upper-cased and tested by substring."""
    c = V.table(spark, sf_dir, "customer")
    k = F.col("c_custkey") % 4
    name = (F.when(k == 0, F.concat(F.lit(" "), "c_name", F.lit(" ")))
            .when(k == 1, F.concat(F.lit("\t"), "c_name"))
            .when(k == 2, F.concat("c_name", F.lit("\t \n")))
            .otherwise(F.col("c_name")))
    seg = F.when(k == 3, F.concat(F.lit(" \t"), F.lower("c_mktsegment"))) \
        .otherwise(F.col("c_mktsegment"))
    padded = c.select("c_custkey", name.alias("raw_name"), seg.alias("raw_seg"))
    seg_clean = F.upper(X.strip_ws("raw_seg"))
    return padded.select("c_custkey", X.strip_ws("raw_name").alias("name"),
                         seg_clean.alias("segment"),
                         F.contains(seg_clean, F.lit("BUILD")).alias("is_building"))


@register("alias_coalesce", """
WITH m AS (
  SELECT c_custkey,
    CASE WHEN c_acctbal < 2500 THEN '' ELSE 'S' || c_custkey END AS a,
    CASE WHEN c_mktsegment = 'HOUSEHOLD' THEN NULL ELSE 'A' || c_custkey END AS b,
    CASE WHEN c_nationkey < 10 THEN '' ELSE 'B' || c_custkey END AS c,
    CASE WHEN c_nationkey >= 20 THEN '' ELSE c_name END AS n1,
    CASE WHEN c_acctbal > 9000 THEN NULL ELSE c_mktsegment END AS n2
  FROM customer)
SELECT c_custkey, coalesce(nullif(a, ''), nullif(b, ''), nullif(c, '')) AS security_id,
       coalesce(nullif(n1, ''), nullif(n2, ''), '') AS symbol_name
FROM m
WHERE coalesce(nullif(a, ''), nullif(b, ''), nullif(c, '')) IS NOT NULL
""")
def alias_coalesce(spark: SparkSession, sf_dir: str) -> DataFrame:
    """First non-empty of alternative columns; rows without any
    security id are dropped (the stock lookup's rule)."""
    c = V.table(spark, sf_dir, "customer")
    key = F.col("c_custkey").cast("string")
    m = c.select(
        "c_custkey",
        F.when(F.col("c_acctbal") < 2500, F.lit("")).otherwise(F.concat(F.lit("S"), key))
        .alias("SEM_SMST_SECURITY_ID"),
        F.when(F.col("c_mktsegment") == "HOUSEHOLD", F.lit(None).cast("string"))
        .otherwise(F.concat(F.lit("A"), key)).alias("SecurityID"),
        F.when(F.col("c_nationkey") < 10, F.lit("")).otherwise(F.concat(F.lit("B"), key))
        .alias("SECURITY_ID"),
        F.when(F.col("c_nationkey") >= 20, F.lit("")).otherwise(F.col("c_name"))
        .alias("SYMBOL_NAME"),
        F.when(F.col("c_acctbal") > 9000, F.lit(None).cast("string"))
        .otherwise(F.col("c_mktsegment")).alias("SymbolName"))
    sid = X.first_non_empty("SEM_SMST_SECURITY_ID", "SecurityID", "SECURITY_ID", default=None)
    return (m.select("c_custkey", sid.alias("security_id"),
                     X.first_non_empty("SYMBOL_NAME", "SymbolName").alias("symbol_name"))
            .where(F.col("security_id").isNotNull()))
