"""Event validation with reasons, quarantine split and referential checks.

Every rule is a Column predicate; the reasons of a row are collected into one array so a
single pass over the data yields both the accepted rows and the quarantined rows with
all their reasons. Nothing is dropped silently.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from eventide.schemas import CONTENT_TYPES, DURATION_REQUIRED, EVENT_TYPES, UUID_PATTERN

REASONS = "reasons"
# Fixed reason codes, in the order they are reported.
R_MISSING_ID = "missing_id"
R_BAD_ID = "invalid_id"
R_BAD_CONTENT_ID = "invalid_content_id"
R_BAD_USER_ID = "invalid_user_id"
R_BAD_EVENT_TYPE = "invalid_event_type"
R_BAD_TS = "invalid_event_ts"
R_BAD_DURATION = "invalid_duration_ms"
R_MISSING_DURATION = "missing_duration"
R_BAD_PAYLOAD = "invalid_raw_payload"
R_CONTENT_NOT_FOUND = "content_not_found"
R_MALFORMED = "malformed_json"


def canonical_uuid(c: Column) -> Column:
    """A UUID in its canonical form: lower case with hyphens (the 32-digit form gets them).
    Other values stay as they are, in lower case, for the rules to judge."""
    low = F.lower(c)
    return F.when(F.length(low) == 32, F.regexp_replace(
        low, "^([0-9a-f]{8})([0-9a-f]{4})([0-9a-f]{4})([0-9a-f]{4})([0-9a-f]{12})$",
        "$1-$2-$3-$4-$5")).otherwise(low)


def with_canonical_ids(events: DataFrame) -> DataFrame:
    return events.withColumns({c: canonical_uuid(F.col(c)) for c in ("content_id", "user_id")})


def _is_uuid(c: Column) -> Column:
    return c.isNotNull() & c.rlike(UUID_PATTERN)


def event_rules(strict: bool = True) -> list[tuple[str, Column]]:
    """(reason, violated) pairs for a typed event frame (schema ``EVENT``).

    ``strict=False`` keeps only the checks the backfill path applies (required fields),
    reproducing its more lenient behaviour.
    """
    rules = [
        (R_MISSING_ID, F.col("id").isNull()),
        (R_BAD_CONTENT_ID, ~_is_uuid(F.col("content_id"))),
        (R_BAD_USER_ID, ~_is_uuid(F.col("user_id"))),
        (R_BAD_EVENT_TYPE, F.col("event_type").isNull() | ~F.col("event_type").isin(*EVENT_TYPES)),
        (R_BAD_TS, F.col("event_ts").isNull()),
    ]
    if strict:
        rules.append((R_MISSING_DURATION,
                      F.col("event_type").isin(*DURATION_REQUIRED) & F.col("duration_ms").isNull()))
    else:
        rules = [r for r in rules if r[0] in (R_MISSING_ID, R_BAD_CONTENT_ID, R_BAD_USER_ID,
                                               R_BAD_TS)]
    return rules


def violated(rules: list[tuple[str, Column]]) -> Column:
    """True when any rule is violated (plain boolean logic, fully code-generated)."""
    out = F.lit(False)
    for _, cond in rules:
        out = out | F.coalesce(cond, F.lit(False))
    return out


def reasons_column(rules: list[tuple[str, Column]]) -> Column:
    """Array of the violated reason codes (empty when the row is valid).

    Rules are written null-safe; a rule that still evaluates to NULL is not a violation.
    The array is only built for rows that violate something: valid rows (the bulk) take
    the cheap boolean branch.
    """
    flags = [F.when(F.coalesce(cond, F.lit(False)), F.lit(code)) for code, cond in rules]
    return F.when(violated(rules), F.array_compact(F.array(*flags))).otherwise(
        F.array().cast("array<string>"))


def with_reasons(df: DataFrame, strict: bool = True) -> DataFrame:
    return df.withColumn(REASONS, reasons_column(event_rules(strict)))


def split_valid(df: DataFrame, strict: bool = True) -> tuple[DataFrame, DataFrame]:
    """V6: (valid rows, quarantined rows with ``reasons``) from one reasons column."""
    tagged = with_reasons(df, strict)
    good = tagged.where(F.size(REASONS) == 0).drop(REASONS)
    bad = tagged.where(F.size(REASONS) > 0)
    return good, bad


def parse_raw_events(raw: DataFrame, value_col: str = "value") -> DataFrame:
    """V1: JSON strings to typed events plus parse reasons.

    Fields are read as strings (``json_tuple``: one parse per document, and as a generator
    it is a plan barrier, so later filters cannot re-inline the parse per field) and
    converted with ``try_cast``: ``"12"`` is accepted as 12 while ``12.5`` or ``"x"``
    become a reason rather than a silent NULL. A field that is present but does not
    convert is reported; a missing field gives NULL, a document that is no JSON at all is
    reported as ``malformed_json``. A payload must be a JSON object. Ids become canonical
    UUIDs. The document itself stays in ``_raw`` for the quarantine.
    """
    from eventide.schemas import RAW_EVENT_JSON

    names = RAW_EVENT_JSON.fieldNames()
    raw_names = [f"_j_{n}" for n in names]
    parsed = raw.select(F.json_tuple(F.col(value_col), *names).alias(*raw_names),
                        F.col(value_col).alias("_raw"))
    e = lambda n: F.col(f"_j_{n}")
    id_ = F.expr("try_cast(_j_id AS BIGINT)")
    dur = F.expr("try_cast(_j_duration_ms AS INT)")
    ts = F.expr("try_to_timestamp(_j_event_ts)").cast("timestamp_ntz")
    payload_ok = e("raw_payload").isNull() | (
        F.ltrim(e("raw_payload")).startswith("{")
        & F.expr("try_parse_json(_j_raw_payload)").isNotNull())
    no_field = F.coalesce(*[e(n) for n in names]).isNull()
    parse_rules = [
        (R_MALFORMED, no_field & F.expr("try_parse_json(_raw)").isNull()),
        (R_BAD_ID, e("id").isNotNull() & id_.isNull()),
        (R_BAD_TS, e("event_ts").isNotNull() & ts.isNull()),
        (R_BAD_DURATION, e("duration_ms").isNotNull() & dur.isNull()),
        (R_BAD_PAYLOAD, ~payload_ok),
    ]
    return parsed.select(
        id_.alias("id"), canonical_uuid(e("content_id")).alias("content_id"),
        canonical_uuid(e("user_id")).alias("user_id"),
        e("event_type").alias("event_type"), ts.alias("event_ts"), dur.alias("duration_ms"),
        e("device").alias("device"), e("raw_payload").alias("raw_payload"),
        reasons_column(parse_rules).alias("_parse_reasons"), F.col("_raw"))


def validate_raw(raw: DataFrame, value_col: str = "value", strict: bool = True
                 ) -> tuple[DataFrame, DataFrame]:
    """V1+V2+V4+V5: JSON rows to (valid typed events, quarantine with reasons)."""
    typed = parse_raw_events(raw, value_col)
    rules = event_rules(strict)
    reasons = F.array_distinct(F.concat(F.col("_parse_reasons"), reasons_column(rules)))
    tagged = typed.withColumn(REASONS, reasons).drop("_parse_reasons")
    good = tagged.where(F.size(REASONS) == 0).drop(REASONS, "_raw")
    bad = tagged.where(F.size(REASONS) > 0)
    return good, bad


def content_rules() -> list[tuple[str, Column]]:
    """V3/V5 on the content dimension."""
    return [
        ("invalid_content_id", ~_is_uuid(F.col("content_id"))),
        ("missing_slug", F.col("slug").isNull()),
        ("missing_title", F.col("title").isNull()),
        ("invalid_content_type",
         F.col("content_type").isNull() | ~F.col("content_type").isin(*CONTENT_TYPES)),
    ]


def validate_content(content: DataFrame) -> tuple[DataFrame, DataFrame]:
    tagged = content.withColumn(REASONS, reasons_column(content_rules()))
    return (tagged.where(F.size(REASONS) == 0).drop(REASONS), tagged.where(F.size(REASONS) > 0))


def reasons_text(col: str = REASONS) -> Column:
    """Reasons as one comma-separated string (portable across engines)."""
    return F.array_join(F.col(col), ",")


def duplicate_keys(df: DataFrame, *keys: str) -> DataFrame:
    """V8: keys that occur more than once, with their count (partial aggregation)."""
    return (df.groupBy(*keys).agg(F.count(F.lit(1)).alias("occurrences"))
            .where(F.col("occurrences") > 1))


def anomaly_flags(enriched: DataFrame, as_of: Column | None = None) -> DataFrame:
    """Consistency flags on enriched events (flags, not rejections)."""
    flags = {
        "negative_duration": F.coalesce(F.col("duration_ms") < 0, F.lit(False)),
        "pct_over_100": F.coalesce(F.col("engagement_pct") > 100, F.lit(False)),
        "zero_duration": F.coalesce(F.col("duration_ms") == 0, F.lit(False)),
    }
    if as_of is not None:
        flags["future_event"] = F.coalesce(F.col("event_ts") > as_of, F.lit(False))
    if "publish_ts" in enriched.columns:
        flags["before_publish"] = F.coalesce(F.col("event_ts") < F.col("publish_ts"), F.lit(False))
    return enriched.select("*", *[v.alias(k) for k, v in flags.items()])
