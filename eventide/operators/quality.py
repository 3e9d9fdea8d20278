"""Data-quality report with a worst-of status rollup (V8, A15, re-aimed health checks).

Each check becomes one row ``(check_name, violations, total, status, overall_status)``. Reason
counts are one global aggregation (partial in each task); the duplicate check shuffles event
ids only; the catalogue checks are grouped counts over the small dimension. ``overall_status`` is the worst status
(unhealthy > degraded > healthy) over the handful of check rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from eventide.operators import validate as v

# Fixed status order of the health rollup.
STATUSES = ("healthy", "degraded", "unhealthy")
EVENT_REASONS = (v.R_MALFORMED, v.R_MISSING_ID, v.R_BAD_ID, v.R_BAD_CONTENT_ID, v.R_BAD_USER_ID,
                 v.R_BAD_EVENT_TYPE, v.R_BAD_TS, v.R_BAD_DURATION, v.R_MISSING_DURATION,
                 v.R_BAD_PAYLOAD, v.R_CONTENT_NOT_FOUND)
# Checks whose any violation makes the data unhealthy (broken keys).
CRITICAL = ("duplicate_event_id", "duplicate_content_id", "duplicate_content_slug")


def _status(check: str, violations, total, threshold: float):
    rate = F.try_divide(violations.cast("double"), total)
    crit = F.lit(check in CRITICAL)
    return (F.when(violations == 0, "healthy")
            .when(crit | (rate > threshold), "unhealthy")
            .otherwise("degraded"))


def quality_report(tagged: DataFrame, content: DataFrame, threshold: float = 0.01) -> DataFrame:
    """One row per check with ``overall_status``; ``tagged`` comes from ``enrich.tag``."""
    # the reasons fold into one row per task before the one-row shuffle; only the id itself
    # is shuffled for the duplicate check
    reasons = tagged.agg(
        F.count(F.lit(1)).alias("total"),
        *[F.coalesce(F.sum(F.when(F.array_contains("reasons", r), 1).otherwise(0)), F.lit(0))
          .cast("bigint").alias(r) for r in EVENT_REASONS])
    stack = ", ".join(f"'{r}', `{r}`" for r in EVENT_REASONS)
    event_rows = reasons.selectExpr(
        f"stack({len(EVENT_REASONS)}, {stack}) AS (check_name, violations)", "total")

    def dup_rows(df: DataFrame, key: str, name: str) -> DataFrame:
        per_key = df.groupBy(key).agg(F.count(F.lit(1)).alias("_n"))
        return per_key.agg(
            F.lit(name).alias("check_name"),
            F.sum(F.when(F.col(key).isNotNull() & (F.col("_n") > 1), F.col("_n") - 1)
                  .otherwise(0)).cast("bigint").alias("violations"),
            F.coalesce(F.sum("_n"), F.lit(0)).cast("bigint").alias("total"))

    rows = (event_rows.unionByName(dup_rows(tagged, "id", "duplicate_event_id"))
            .unionByName(dup_rows(content, "content_id", "duplicate_content_id"))
            .unionByName(dup_rows(content, "slug", "duplicate_content_slug")))
    status = F.lit("healthy")
    for name in list(EVENT_REASONS) + list(CRITICAL):
        status = F.when(F.col("check_name") == name,
                        _status(name, F.col("violations"), F.col("total"), threshold)).otherwise(status)
    rows = rows.withColumn("status", status)
    sev = F.when(F.col("status") == "unhealthy", 2).when(F.col("status") == "degraded", 1).otherwise(0)
    rows = rows.withColumn("_sev", sev)
    # worst-of rollup over the ~10 check rows (one tiny partition by design); a column
    # rather than a separate row, so the checks are computed once
    worst = F.max("_sev").over(Window.partitionBy(F.lit(1)))
    overall = F.when(worst == 2, "unhealthy").when(worst == 1, "degraded").otherwise("healthy")
    return rows.withColumn("overall_status", overall).drop("_sev")
