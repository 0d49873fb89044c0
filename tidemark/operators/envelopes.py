"""Feed messages: JSON envelopes that carry an array of trades."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark import schemas

# The symbols a feed is subscribed to unless told otherwise.
FEED_SYMBOLS = ("AAPL", "AMZN", "BINANCE:BTCUSDT", "IC MARKETS:1")

_CORRUPT = "_corrupt_record"


def parse_envelopes(
    messages: DataFrame,
    value: str = "value",
    keep: Sequence[str] = (),
    with_position: bool = False,
) -> DataFrame:
    """One tick per array element of each message, without a shuffle.

    Messages that hold no trades (heartbeats, empty or null arrays, text that is not JSON,
    null values) give no rows; a field of the wrong type becomes null and keeps its row.
    ``keep`` carries message columns along, ``with_position`` adds the element's index.
    """
    trades = F.from_json(F.col(value).cast("string"), schemas.TICK_ENVELOPE)["data"]
    carried = [F.col(c) for c in keep]
    if with_position:
        elements = messages.select(*carried, F.posexplode(trades).alias("position", "trade"))
        carried.append(F.col("position"))
    else:
        elements = messages.select(*carried, F.explode(trades).alias("trade"))
    return elements.select(
        *carried,
        F.col("trade.s").alias("symbol"),
        F.col("trade.p").alias("price"),
        F.col("trade.v").alias("volume"),
        F.col("trade.t").alias("timestamp"),
    )


def bad_messages(messages: DataFrame, value: str = "value") -> DataFrame:
    """The messages that are not JSON, or hold a field of the wrong type."""
    with_mark = T.StructType([*schemas.ENVELOPE.fields, T.StructField(_CORRUPT, T.StringType())])
    parsed = F.from_json(
        F.col(value).cast("string"), with_mark, {"columnNameOfCorruptRecord": _CORRUPT}
    )
    return messages.where(parsed[_CORRUPT].isNotNull())


def tick_struct(symbol: Column, price: Column, volume: Column, millis: Column) -> Column:
    return F.struct(
        F.lit(None).cast("string").alias("c"),
        price.alias("p"),
        symbol.alias("s"),
        millis.alias("t"),
        volume.alias("v"),
    )


def encode_envelopes(
    df: DataFrame, ticks: Sequence[Column], keep: Sequence[str] = ()
) -> DataFrame:
    """One message per row, ready for a topic: ``ticks`` are the row's trades.

    Row-wise, so it needs no grouping however often a key repeats.
    """
    envelope = F.struct(F.array(*ticks).alias("data"), F.lit("trade").alias("type"))
    return df.select(*keep, F.to_json(envelope).alias("value"))


def allow_symbols(ticks: DataFrame, symbols: Iterable[str] = FEED_SYMBOLS) -> DataFrame:
    return ticks.where(F.col("symbol").isin(list(symbols)))
