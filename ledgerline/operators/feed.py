"""Feed messages of the source side: trades and symbol metadata."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerline.functions.exprs import notional, to_money

_TRADE = "data struct<s:string, p:string, q:string, t:bigint, m:boolean>"
_INFO = (
    "symbols array<struct<symbol:string, baseAsset:string, quoteAsset:string, status:string, "
    "filters:array<struct<filterType:string, tickSize:string, stepSize:string>>>>"
)


def parse_trades(messages: DataFrame) -> DataFrame:
    """Trade messages to rows with the quote amount, which the feed does not carry."""
    # Trade id ``t`` and event time ``T`` differ in case only, which a struct cannot tell apart.
    millis = F.get_json_object("message", "$.data.T").try_cast("bigint")
    d = F.from_json("message", _TRADE)["data"]
    return messages.select(d.alias("d"), millis.alias("millis")).select(
        F.col("d.s").alias("symbol"),
        F.col("d.t").alias("trade_id"),
        to_money("d.p").alias("price"),
        to_money("d.q").alias("quantity"),
        notional("d.p", "d.q").alias("quote_qty"),
        F.col("d.m").alias("is_buyer_maker"),
        F.timestamp_millis("millis").alias("trade_time"),
    )


def resolve_symbols(trades: DataFrame, symbols: DataFrame) -> DataFrame:
    """Replace the symbol's name by its id; trades of unknown symbols are dropped.

    No broadcast hint: Spark broadcasts the symbols while their measured size allows it, and
    otherwise splits the hot symbols of the shuffled join.
    """
    return trades.join(symbols.select("symbol", "symbol_id"), "symbol").drop("symbol")


def flatten_symbol_info(messages: DataFrame) -> DataFrame:
    """One row per symbol with its tick and step size; a missing rule gives NULL, the last wins."""
    s = F.col("s")

    def rule(kind: str, field: str):
        of_kind = F.filter(s["filters"], lambda f: f["filterType"] == kind)
        return F.try_element_at(of_kind, F.lit(-1))[field]

    return messages.select(F.explode(F.from_json("message", _INFO)["symbols"]).alias("s")).select(
        s["symbol"].alias("symbol"),
        s["baseAsset"].alias("base_asset"),
        s["quoteAsset"].alias("quote_asset"),
        s["status"].alias("status"),
        to_money(rule("PRICE_FILTER", "tickSize")).alias("tick_size"),
        to_money(rule("LOT_SIZE", "stepSize")).alias("step_size"),
    )
