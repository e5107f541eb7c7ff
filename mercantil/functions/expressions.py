"""Column expressions shared by loaders, rules and queries."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F

from mercantil.functions import constants as C

MONEY = "decimal(12,2)"


def money(col: Column | str) -> Column:
    """Money as decimal(12,2)."""
    return _col(col).cast(MONEY)


def cents_half_even(col: Column | str) -> Column:
    """Round to cents with ties to the even cent, as pricing does."""
    return F.bround(_col(col), 2).cast(MONEY)


def cents(col: Column | str) -> Column:
    """Round to cents with ties away from zero, as report queries do."""
    return F.round(_col(col), 2).cast(MONEY)


def tax(base: Column | str) -> Column:
    return _col(base) * F.lit(C.TAX_RATE).cast("decimal(3,2)")


def percent(part: Column, whole: Column, digits: int) -> Column:
    """``100 * part / whole`` in decimals; null when ``whole`` is 0."""
    whole = F.nullif(whole.cast("decimal(20,0)"), F.lit(0).cast("decimal(20,0)"))
    return F.round(part.cast("decimal(20,0)") * 100 / whole, digits)


def average(total: Column, count: Column) -> Column:
    """Mean of pre-aggregated sums; null for an empty group."""
    return total / F.nullif(count.cast("decimal(20,0)"), F.lit(0).cast("decimal(20,0)"))


def instant_of(text: Column | str) -> Column:
    """Instant written as an ISO string (a trailing ``Z`` is UTC); null if unreadable."""
    return F.try_to_timestamp(_col(text))


def day_of(moment: Column | str, timezone: str | None = None) -> Column:
    """Calendar day of an instant, in UTC or in a business timezone."""
    moment = _col(moment)
    return F.to_date(F.from_utc_timestamp(moment, timezone) if timezone else moment)


def date_key(day: Column | str, start: dt.date, end: dt.date) -> Column:
    """Serial day number counted from 1 at ``start``; null outside the calendar."""
    day = _col(day)
    return F.when(
        day.between(F.lit(start), F.lit(end)),
        (F.datediff(day, F.lit(start)) + 1).cast("bigint"),
    )


def surrogate_key(*parts: Column | str) -> Column:
    """Signed 64-bit key from the md5 of the natural key.

    md5 exists in every SQL engine, so a key can be recomputed outside Spark.
    It runs over dimension rows only; facts get the key by lookup.
    """
    text = F.concat_ws("|", *[_col(p).cast("string") for p in parts])
    return F.conv(F.substring(F.md5(text), 1, 16), 16, -10).cast("bigint")


def micros(moment: Column | str) -> Column:
    return F.unix_micros(_col(moment))


def lookup(mapping: dict, key: Column | str) -> Column:
    """Value for ``key`` in a small constant map; null when absent."""
    pairs = [F.lit(x) for item in mapping.items() for x in item]
    return F.create_map(*pairs)[_col(key)]


def fulfillment_of(state: Column | str) -> Column:
    """Fulfillment for an order state; null for an unmapped state."""
    return lookup(C.FULFILLMENT_BY_STATE, state)


def order_state_key(state: Column | str) -> Column:
    keys = {name: i for i, (name, _, _) in enumerate(C.ORDER_STATES, start=1)}
    return lookup(keys, state).cast("bigint")


def next_state(state: Column | str) -> Column:
    """Following state in the order flow; null at the end or off the flow."""
    return lookup(dict(zip(C.ORDER_FLOW, C.ORDER_FLOW[1:])), state)


def channel_key(channel: Column | str) -> Column:
    keys = {name: i for i, name in enumerate(C.CHANNELS, start=1)}
    return lookup(keys, channel).cast("bigint")


def payment_method_key(method: Column | str) -> Column:
    keys = {name: i for i, (name, _) in enumerate(C.PAYMENT_METHODS, start=1)}
    return lookup(keys, method).cast("bigint")


def delivery_days(sent: Column | str, delivered: Column | str, missing: int | None = None) -> Column:
    """Whole days between two instants, never below 0.

    ``missing`` is the value used when either instant is unknown.
    """
    days = F.datediff(_col(delivered), _col(sent))
    # Not greatest(), which would turn an unknown span into 0.
    days = F.when(days < 0, 0).otherwise(days)
    return days if missing is None else F.coalesce(days, F.lit(missing))


def _col(value: Column | str) -> Column:
    return F.col(value) if isinstance(value, str) else value
