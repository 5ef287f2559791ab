"""Column expressions shared by the operators. All of them stay inside generated JVM code."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import DecimalType, StringType, StructType, TimestampType

from ledgerline.functions.schemas import MONEY


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def to_money(text) -> Column:
    """Decimal text to the storage type; unreadable text gives NULL instead of failing the job."""
    return _col(text).try_cast(MONEY)


def to_instant(text) -> Column:
    """ISO-8601 text (fraction optional, any zone offset) to a timestamp; anything else is NULL.

    The cast alone would also take a bare year or date, hence the look at the separator.
    """
    c = _col(text)
    return F.when(F.substring(c, 11, 1) == "T", c.try_cast("timestamp"))


def date_key(ts) -> Column:
    """Calendar day as the integer YYYYMMDD."""
    c = _col(ts)
    return F.year(c) * 10000 + F.month(c) * 100 + F.dayofmonth(c)


def time_key(ts) -> Column:
    """Minutes since midnight."""
    c = _col(ts)
    return F.hour(c) * 60 + F.minute(c)


def taker_side(is_buyer_maker) -> Column:
    """The taker sold when the buyer was resting on the book; unknown counts as a buy."""
    return F.when(_col(is_buyer_maker), "sell").otherwise("buy")


def notional(price, quantity) -> Column:
    """price * quantity, exact to 18 places.

    The product of two decimal(38,s) operands would be rounded to six places. So each operand is
    split into whole and fraction, whose four products fit; a product or sum that does not fit the
    storage type gives NULL, as does unreadable text.
    """
    step = "decimal(37,18)"

    def parts(text):
        x = _col(text).try_cast(MONEY)
        fraction = (x % 1).cast("decimal(18,18)")
        return (x - fraction).try_cast("decimal(18,0)"), fraction

    (a, b), (c, d) = parts(price), parts(quantity)
    total = (a * c).try_cast(step)
    for product in (a * d, b * c, b * d):
        total = (total + product.try_cast(step)).try_cast(step)
    return total.cast(MONEY)


def truncate_like(unit: str, ts: str, schema: StructType) -> Column:
    """``date_trunc`` that returns the type of its input; on its own it widens to TIMESTAMP."""
    return F.date_trunc(unit, ts).cast(schema[ts].dataType)


def conform(image: Column, payload: str, target: str) -> list[Column]:
    """Cast every field of a parsed payload struct to its type in the target layout."""
    raw, wanted = StructType.fromDDL(payload), StructType.fromDDL(target)
    out = []
    for field in wanted:
        c = image[field.name]
        if raw[field.name].dataType == StringType():
            if isinstance(field.dataType, DecimalType):
                c = to_money(c)
            elif isinstance(field.dataType, TimestampType):
                c = to_instant(c)
        out.append(c.alias(field.name))
    return out
