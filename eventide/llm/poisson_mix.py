"""Mixing sources to target weights by Poisson replication.

Every document is repeated a Poisson-distributed number of times whose mean is its source's
target repetition rate: target share of the mix, times the size of the mix, over the rows of
the source. The number is the inverse of the distribution function at a uniform variate
hashed from (seed, doc_id), so a rerun, a retry or another partitioning gives the same mix.
The copies are then shuffled globally by a second hash of (seed, doc_id, copy).

A rate above ``PIECE_RATE`` is split into equal pieces of at most that rate, each inverted at a
variate of its own: their sum is Poisson of the whole rate, so the table of a source has some
200 entries at any rate, and a document's work grows with the copies it yields.

Target shares: ``weights`` (source -> weight, normalised over the sources present; a source
without a weight gets 0 and leaves the mix) or, without weights, rows ** ``temperature``.

Defined cases: rows with a null source form a source of their own (weight key None). Rows
with a null doc_id hash as 'null'; repeated rows of one doc_id get the same count each. Text
is not looked at, null, empty or very long. An empty table gives an empty mix. All columns are
passed on, whatever their names; a column named copy or shuffle_key in the input is replaced.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Bounds of the rate tables that are broadcast: their sources, and bytes of names and doubles.
MAX_BROADCAST_SOURCES = 20_000
MAX_BROADCAST_BYTES = 32 << 20
#: Largest rate of one table; rates above it are sums of pieces.
PIECE_RATE = 64
#: Copies of each rate row where the join has to shuffle (more sources than the bound above):
#: the rows of one source spread over so many tasks.
SALTS = 64


def _hash52(*parts: Column) -> Column:
    """52 bits of MD5, as a long."""
    return F.conv(F.substring(F.md5(F.concat_ws(":", *parts)), 1, 13), 16, 10).cast("long")


def source_rates(docs: DataFrame, weights: dict | None = None, temperature: float = 0.5,
                 size: float = 1.0) -> DataFrame:
    """(source, n, rate, pieces, cdf): cdf[k] = P(count of a piece <= k), up to where it is 1 in a
    double; a count is the sum over the pieces."""
    counts = docs.groupBy("source").agg(F.count("*").alias("n"))
    if weights is None:
        raw = F.pow(F.col("n").cast("double"), F.lit(float(temperature)))
    else:
        raw = F.lit(0.0)
        for name, w in weights.items():
            same = F.col("source").isNull() if name is None else F.col("source") == F.lit(name)
            raw = F.when(same, F.lit(float(w))).otherwise(raw)
    counts = counts.withColumn("raw", raw)
    total = counts.agg(F.sum("n").alias("n"), F.sum("raw").alias("raw")).first()
    rows, mass = float(total["n"] or 0), float(total["raw"] or 0.0) or 1.0
    rate = F.col("raw") / F.lit(mass) * F.lit(rows * size) / F.col("n")
    pieces = F.greatest(F.ceil(F.col("rate") / PIECE_RATE), F.lit(1)).cast("int")
    rated = (counts.select("source", "n", rate.alias("rate")).withColumn("pieces", pieces)
             .withColumn("piece", F.col("rate") / F.col("pieces")))
    # log p(k) grows by ln(rate / k) from log p(0) = -rate
    top = F.ceil(F.col("piece") + 12 * F.sqrt("piece") + 40).cast("int")
    start = F.struct((-F.col("piece")).alias("lp"), F.exp(-F.col("piece")).alias("c"),
                     F.array(F.exp(-F.col("piece"))).alias("cdf"))

    def step(acc, k):
        lp = acc["lp"] + F.log(F.col("piece")) - F.log(k.cast("double"))
        c = acc["c"] + F.exp(lp)
        return F.struct(lp.alias("lp"), c.alias("c"),
                        F.concat(acc["cdf"], F.array(c)).alias("cdf"))

    cdf = F.aggregate(F.sequence(F.lit(1), top), start, step)["cdf"]
    return rated.select("source", "n", "rate", "pieces",
                        F.when(F.col("rate") > 0, cdf).otherwise(F.array(F.lit(1.0))).alias("cdf"))


def poisson_mix(docs: DataFrame, weights: dict | None = None, temperature: float = 0.5,
                size: float = 1.0, seed: str = "mix-1") -> DataFrame:
    """The mix: columns of ``docs``, then copy (from 1) and shuffle_key, in shuffled order."""
    docs = docs.drop("copy", "shuffle_key")
    rates = source_rates(docs, weights, temperature, size).select(
        F.col("source").alias("of"), "pieces", "cdf")
    # the input's row is one column, so its names cannot clash with the ones used here
    rows = docs.select(F.struct("*").alias("row")).select(
        "row", F.col("row.source").alias("source"),
        F.coalesce(F.col("row.doc_id").cast("string"), F.lit("null")).alias("ident"))
    bytes_ = F.coalesce(F.octet_length(F.col("of").cast("string")), F.lit(0)) + 8 * F.size("cdf")
    bound = rates.limit(MAX_BROADCAST_SOURCES + 1).agg(
        F.count("*").alias("n"), F.coalesce(F.sum(bytes_), F.lit(0)).alias("bytes")).first()
    if bound["n"] <= MAX_BROADCAST_SOURCES and bound["bytes"] <= MAX_BROADCAST_BYTES:
        rated = rows.join(F.broadcast(rates), F.col("source").eqNullSafe(F.col("of")))
    else:
        salted = rates.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
        spread = rows.withColumn("row_salt", F.pmod(F.hash("ident"), F.lit(SALTS)))
        rated = spread.join(salted, (F.col("row_salt") == F.col("salt"))
                            & F.col("source").eqNullSafe(F.col("of")))
    ident = F.col("ident")
    u = _hash52(F.lit(seed), ident) / F.lit(float(1 << 52))

    def piece(total, i):
        v = _hash52(F.lit(seed), F.lit("piece"), i.cast("string"), ident) / F.lit(float(1 << 52))
        return total + F.size(F.filter("cdf", lambda c: c <= v))

    n = F.size(F.filter("cdf", lambda c: c <= F.col("u")))
    n = F.when(F.col("pieces") == 1, n).otherwise(
        F.aggregate(F.sequence(F.lit(2), F.greatest("pieces", F.lit(2))), n, piece))
    copies = (rated.withColumn("u", u).withColumn("n", n).where("n > 0")
              .select("row", "ident", F.explode(F.sequence(F.lit(1), F.col("n"))).alias("copy")))
    key = _hash52(F.lit(seed), F.lit("order"), ident, F.col("copy").cast("string"))
    return (copies.select("row", "copy", key.alias("shuffle_key"))
            .orderBy("shuffle_key", "row.doc_id", "copy").select("row.*", "copy", "shuffle_key"))


ORACLE_SQL = """
WITH RECURSIVE c AS (SELECT source, count(*) AS n FROM documents GROUP BY source),
r AS (SELECT source, sqrt(n::DOUBLE) / (SELECT sum(sqrt(n::DOUBLE)) FROM c)
             * (SELECT sum(n) FROM c)::DOUBLE / n AS rate FROM c),
cdf AS (SELECT source, rate, 0 AS k, -rate AS lp, exp(-rate) AS c FROM r
        UNION ALL
        SELECT source, rate, k + 1, lp + ln(rate) - ln((k + 1)::DOUBLE),
               c + exp(lp + ln(rate) - ln((k + 1)::DOUBLE))
        FROM cdf WHERE k < ceil(rate + 12 * sqrt(rate) + 40)),
u AS (SELECT doc_id, source,
             ('0x' || substr(md5('mix-1:' || coalesce(doc_id::VARCHAR, 'null')), 1, 13))::BIGINT
             / 4503599627370496.0::DOUBLE AS u FROM documents),
n AS (SELECT u.doc_id, u.source, (SELECT count(*) FROM cdf
      WHERE cdf.source IS NOT DISTINCT FROM u.source AND cdf.c <= u.u) AS n FROM u),
x AS (SELECT doc_id, source, unnest(range(1, n + 1))::INTEGER AS copy FROM n)
SELECT doc_id, source, copy,
       ('0x' || substr(md5('mix-1:order:' || coalesce(doc_id::VARCHAR, 'null') || ':' || copy), 1, 13))::BIGINT
       AS shuffle_key FROM x
"""
