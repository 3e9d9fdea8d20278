"""Column expressions for engagement seconds, engagement percent, score and formatting.

All of them are built-in Catalyst expressions (no Python UDF), so they stay inside
whole-stage codegen wherever they are used.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from eventide.schemas import BASE_SCORES, MONEY, PAYLOAD_KEYS, SCORE

ROUNDING_STREAM = "stream"  # HALF_EVEN, percent from the rounded seconds
ROUNDING_VIEW = "view"      # HALF_UP, percent from the unrounded seconds


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def engagement_seconds(duration_ms="duration_ms", rounding: str = ROUNDING_STREAM) -> Column:
    """Milliseconds to seconds at 2 decimals (NULL stays NULL)."""
    secs = _c(duration_ms).cast("decimal(20,3)") / F.lit(1000)
    rounded = F.bround(secs, 2) if rounding == ROUNDING_STREAM else F.round(secs, 2)
    return rounded.cast(MONEY)


def engagement_pct(duration_ms="duration_ms", length_seconds="length_seconds",
                   seconds="engagement_seconds", rounding: str = ROUNDING_STREAM) -> Column:
    """Percent of the content length, NULL unless the length is positive.

    ``stream`` divides the already rounded seconds and rounds HALF_EVEN; ``view`` rounds
    HALF_UP from the exact ratio (computed in hundredths so the tie is exact).
    """
    length = _c(length_seconds)
    if rounding == ROUNDING_STREAM:
        ratio = _c(seconds) / length * F.lit(100)
        value = F.bround(ratio, 2)
        guard = length > 0
    else:
        cents = F.round(_c(duration_ms).cast("decimal(20,0)") * F.lit(10)
                        / length.cast("decimal(10,0)"), 0)
        value = cents / F.lit(100)
        guard = (length > 0) & _c(duration_ms).isNotNull()
    return F.when(guard, value.cast(MONEY))


def base_score(event_type="event_type") -> Column:
    et = _c(event_type)
    expr = F.lit(0).cast("decimal(2,1)")
    for name, value in reversed(list(BASE_SCORES.items())):
        expr = F.when(et == name, F.lit(value).cast("decimal(2,1)")).otherwise(expr)
    return expr


def content_score(event_type="event_type", pct="engagement_pct") -> Column:
    """Base score x (1 + min(pct/100, 1)); NULL or zero percent gives no boost.

    Exact decimal arithmetic: totals do not depend on arrival order. ``least`` skips
    NULLs, so the percent is coalesced before the cap.
    """
    boost = F.lit(1) + F.least(F.coalesce(_c(pct), F.lit(0)) / F.lit(100), F.lit(1))
    return (base_score(event_type) * boost).cast(SCORE)


def iso_timestamp(ts) -> Column:
    """ISO-8601 like Python ``datetime.isoformat()``: microseconds only when non-zero."""
    t = _c(ts)
    whole = F.date_format(t, "yyyy-MM-dd'T'HH:mm:ss")
    return F.when(t.isNull(), F.lit(None).cast("string")).when(
        F.date_format(t, "SSSSSS") == "000000", whole).otherwise(
        F.concat(whole, F.lit("."), F.date_format(t, "SSSSSS")))


def nullif_zero(c) -> Column:
    """Falsy-zero projection: 0 becomes NULL (warehouse, payload and recent-event records)."""
    col = _c(c)
    return F.when(col != 0, col)


def payload_field(key: str, payload="raw_payload") -> Column:
    """One field of the JSON payload as a string."""
    return F.get_json_object(_c(payload), f"$.{key}")


def payload_fields(payload="raw_payload") -> list[Column]:
    return [payload_field(k, payload).alias(k) for k in PAYLOAD_KEYS]


def payload_variant(payload="raw_payload") -> Column:
    """The payload as VARIANT (malformed JSON becomes NULL), for typed field access."""
    return F.try_parse_json(_c(payload))


def payload_variant_field(key: str, type_: str = "string", payload="raw_payload") -> Column:
    """One typed field of the payload through VARIANT (NULL when absent or of another type)."""
    return F.try_variant_get(payload_variant(payload), f"$.{key}", type_)
