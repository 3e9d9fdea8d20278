"""What holds when one group has most of the rows: op7's rates, op8's join, op10's chains."""

from pyspark.sql import functions as F

from eventide.llm import exact_dedup, line_windows, poisson_mix


def test_large_rates_are_sums_of_bounded_pieces(spark):
    docs = spark.range(2000).select(F.col("id").alias("doc_id"), F.lit("t").alias("text"),
                                    F.when(F.col("id") > 0, "many").otherwise("one").alias("source"))
    mix = poisson_mix.poisson_mix(docs, weights={"one": 1.0, "many": 1.0}, size=200.0).drop(
        "text", "shuffle_key").cache()
    per = {r.source: r.n for r in mix.groupBy("source").agg(F.count("*").alias("n")).collect()}
    assert abs(per["one"] - 200_000) < 6 * 200_000 ** 0.5
    assert abs(per["many"] - 200_000) < 6 * 200_000 ** 0.5
    rates = {r.source: r for r in poisson_mix.source_rates(
        docs, weights={"one": 3.0, "many": 1.0}, size=2000.0).collect()}
    assert rates["one"].pieces == -(-3_000_000 // 64) and len(rates["one"].cdf) < 220
    # mean and variance of the sums are both the rate
    n = [r.n for r in mix.where("source = 'many'").groupBy("doc_id").agg(
        F.count("*").alias("n")).collect()]
    mean = sum(n) / 1999
    var = sum((x - mean) ** 2 for x in n) / 1998
    mix.unpersist()
    assert abs(mean - 200_000 / 1999) < 4 * (mean / 1999) ** 0.5
    assert 0.8 < var / mean < 1.2


def test_names_of_the_input_do_not_clash(spark):
    extra = ("row", "of", "ident", "u", "n", "cdf", "pieces", "salt", "row_salt", "a.b", "__u")
    docs = spark.createDataFrame([(i, "t", "s", *range(len(extra))) for i in range(50)],
                                 ["doc_id", "text", "source", *extra])
    plain = [tuple(r) for r in poisson_mix.poisson_mix(docs.select("doc_id", "text", "source")).collect()]
    mixed = poisson_mix.poisson_mix(docs)
    assert mixed.columns == [*docs.columns, "copy", "shuffle_key"]
    got = [tuple(r) for r in mixed.collect()]
    assert [(*r[:3], *r[-2:]) for r in got] == plain
    assert all(r[3:-2] == tuple(range(len(extra))) for r in got)


def test_join_of_a_common_window_is_split(spark):
    block = "license a\nlicense b\nlicense c"
    docs = spark.range(0, 60_000, 1, 8).select(F.col("id").alias("doc_id"), F.concat(
        F.lit(block + "\n"), F.col("id").cast("string"), F.lit("\nx\ny\nz")).alias("text"))
    small = {"spark.sql.autoBroadcastJoinThreshold": "-1",
             "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
             "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "64k",
             "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
             "spark.sql.adaptive.advisoryPartitionSizeInBytes": "64k",
             "spark.sql.adaptive.coalescePartitions.enabled": "false",
             "spark.sql.shuffle.partitions": "32"}
    old = {k: spark.conf.get(k, None) for k in small}
    try:
        for k, v in small.items():
            spark.conf.set(k, v)
        covered = line_windows.covered_lines(docs)
        rows = covered.collect()
        plan = covered._jdf.queryExecution().executedPlan().toString()
    finally:
        for k, v in old.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
    assert "skew=true" in plan
    assert len(rows) == 59_999 and all(r.covered == [0, 1, 2, 4, 5, 6] for r in rows)


def test_groups_come_from_the_buckets_of_the_directory(spark):
    docs = spark.range(3000).select(
        F.col("id").alias("doc_id"),
        F.when(F.col("id") % 3 == 0, "hot  text").otherwise(
            F.concat(F.lit("text "), (F.col("id") % 700).cast("string"))).alias("text"))
    keyed = exact_dedup._keyed(docs).select("doc_id", "key")
    index, cells, cell = exact_dedup.build_index(keyed, capacity=40)
    assert cells.select("bucket", "depth").distinct().count() > 8
    good = exact_dedup.chains(docs, index, cells, cell).collect()
    assert sum(r.group_size for r in good) == 3000
    assert {(r.link, r.overflow) for r in good} == {(1, 0)}
    assert max(r.group_size for r in good) == 1000
    # a directory that sends rows to other buckets finds none of their entries
    wrong = cells.withColumn("bucket", F.col("bucket") + 1)
    assert exact_dedup.chains(docs, index, wrong, cell).count() == 0
    half = cells.where("cell % 2 = 0")
    part = exact_dedup.chains(docs, index, half, cell).collect()
    assert 0 < len(part) < len(good)
    # an index that counts rows the texts do not have says so
    more = exact_dedup.chains(docs.where("doc_id > 2"), index, cells, cell).collect()
    assert sum(r.overflow for r in more) == 3


def test_colliding_texts_are_links_of_one_chain(spark, monkeypatch):
    real = exact_dedup._keyed
    monkeypatch.setattr(exact_dedup, "_keyed", lambda d: real(d).withColumn(
        "key", F.lit(7).cast("long")))
    docs = spark.range(400).select(F.col("id").alias("doc_id"), F.concat(
        F.lit("text "), (F.col("id") % 5).cast("string")).alias("text"))
    index, cells, cell = exact_dedup.build_index(exact_dedup._keyed(docs), capacity=2)
    chain = sorted((r.link, r.keep_id, r.group_size, r.overflow) for r in exact_dedup.chains(
        docs, index, cells, cell).collect())
    assert chain == [(i + 1, i, 80, 0) for i in range(5)]
