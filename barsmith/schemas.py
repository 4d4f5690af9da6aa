"""Fixed schemas: candle outputs, landed responses, manifests, store columns."""

from __future__ import annotations

from pyspark.sql import types as T

S = T.StringType()
L = T.LongType()
D = T.DoubleType()
B = T.ByteType()
I = T.IntegerType()

# Consumer-visible candle table (spot indices and stocks). ``symbol`` is ours:
# one dataset holds all entities, keyed by column instead of by file.
CANDLE = T.StructType([
    T.StructField("symbol", S, False),
    T.StructField("ts", L, False),
    T.StructField("datetime", S, False),
    T.StructField("open", D, True),
    T.StructField("high", D, True),
    T.StructField("low", D, True),
    T.StructField("close", D, True),
    T.StructField("volume", L, False),
])
CANDLE_KEYS = ["symbol", "ts"]

OPTION_CANDLE = T.StructType([
    T.StructField("ts", L, False),
    T.StructField("datetime", S, False),
    T.StructField("underlying", S, False),
    T.StructField("option_type", S, False),
    T.StructField("expiry_type", S, False),
    T.StructField("expiry_code", B, False),
    T.StructField("atm_strike", D, True),
    T.StructField("strike_offset", B, False),
    T.StructField("moneyness", S, False),
    T.StructField("strike", D, True),
    T.StructField("spot", D, True),
    T.StructField("open", D, True),
    T.StructField("high", D, True),
    T.StructField("low", D, True),
    T.StructField("close", D, True),
    T.StructField("volume", L, False),
    T.StructField("oi", L, False),
    T.StructField("iv", D, True),
])
OPTION_KEYS = ["ts", "underlying", "option_type", "expiry_type", "expiry_code", "strike"]

# Physical columns kept in the store to rank versions of one key (newest wins):
# the run that landed the row, the request's place in the request order and
# the row's position inside its response.
ORDER_COLUMNS = [
    T.StructField("ingest_run", L, False),
    T.StructField("request_seq", L, False),
    T.StructField("pos", I, False),
]
PARTITION_COLUMN = "trade_month"

CELLS = T.ArrayType(S)

# Landed intraday response (one JSON line per request). Cells are text: one
# ``""`` in a numeric array would otherwise null the whole array.
INTRADAY_RESPONSE = T.StructType([
    T.StructField("request_id", S),
    T.StructField("status", I),
    T.StructField("errorCode", S),
    T.StructField("errorMessage", S),
    T.StructField("timestamp", CELLS),
    T.StructField("open", CELLS),
    T.StructField("high", CELLS),
    T.StructField("low", CELLS),
    T.StructField("close", CELLS),
    T.StructField("volume", CELLS),
    T.StructField("_corrupt_record", S),
])

OPTION_SIDE = T.StructType([
    T.StructField(name, CELLS) for name in
    ["timestamp", "open", "high", "low", "close", "volume", "oi", "iv", "strike", "spot"]
])

OPTION_RESPONSE = T.StructType([
    T.StructField("request_id", S),
    T.StructField("status", I),
    T.StructField("errorCode", S),
    T.StructField("errorMessage", S),
    T.StructField("data", T.StructType([
        T.StructField("ce", OPTION_SIDE),
        T.StructField("pe", OPTION_SIDE),
    ])),
    T.StructField("_corrupt_record", S),
])


def variant_cells(schema: T.StructType) -> T.StructType:
    """A landed response schema whose cells keep their JSON type."""
    def typed(dtype: T.DataType) -> T.DataType:
        if isinstance(dtype, T.StructType):
            return T.StructType([T.StructField(f.name, typed(f.dataType)) for f in dtype.fields])
        return T.ArrayType(T.VariantType()) if dtype == CELLS else dtype
    return typed(schema)


def response_schema(kind: str, cells: str = "text") -> T.StructType:
    """Schema of the landed answers of a kind, with text or variant cells."""
    if cells not in ("text", "variant"):
        raise ValueError(cells)
    schema = OPTION_RESPONSE if kind == "options" else INTRADAY_RESPONSE
    return variant_cells(schema) if cells == "variant" else schema
