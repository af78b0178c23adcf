"""Column names and explicit schemas for tick data (never inferred)."""

from pyspark.sql import types as T

KEY = "currency"
DT = "dt"
TIE = "event_id"
ORDER = (DT, TIE)
FEATURES = ("price", "volume", "market_cap")

# Tick table (long form), typed; the reference's CSV header names map onto it
# in sources.files.read_ticks_csv.
TICKS = T.StructType(
    [
        T.StructField(KEY, T.StringType()),
        T.StructField(DT, T.TimestampType()),
        T.StructField(TIE, T.LongType()),
        T.StructField("price", T.DoubleType()),
        T.StructField("volume", T.DoubleType()),
        T.StructField("market_cap", T.DoubleType()),
        T.StructField("price_btc", T.DoubleType()),
        T.StructField("extra", T.DoubleType()),
    ]
)

# Header names of the reference's tick CSV, in file order (fixed values).
TICK_CSV_HEADER = (
    "_c0",
    "Currency",
    "DateTime",
    "Price USD",
    "Trading Volume Last 24h",
    "Market Cap",
    "Price BTC",
    "DunnoWhatThisIs",
)

# Raw point-map JSON: {"data": {"points": {"<epoch>": {"v": [..5 numbers..]}}}}
POINT_DOC = T.StructType(
    [
        T.StructField(
            "data",
            T.StructType(
                [
                    T.StructField(
                        "points",
                        T.MapType(
                            T.StringType(),
                            T.StructType([T.StructField("v", T.ArrayType(T.DoubleType()))]),
                        ),
                    )
                ]
            ),
        )
    ]
)

DAILY_OHLC = T.StructType(
    [
        T.StructField("currency", T.StringType()),
        T.StructField("day", T.DateType()),
        T.StructField("open", T.DoubleType()),
        T.StructField("high", T.DoubleType()),
        T.StructField("low", T.DoubleType()),
        T.StructField("close", T.DoubleType()),
        T.StructField("value", T.DoubleType()),
        T.StructField("market_cap", T.DoubleType()),
    ]
)

# Text form of tick times: fractions of a second are written, and read if there.
TIME_TEXT = "yyyy-MM-dd HH:mm:ss[.SSSSSS]"
