"""The change feed delivers every row once, in bounded batches, across restarts."""

import os
import time

import pytest
from pyspark.sql import functions as F

from eventide.sources import change_feed as cf
from eventide.sources import fixtures as fx

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def events(spark):
    return fx.load_events(spark, SF).orderBy("event_ts", "id")


def _append(df, path, files=3):
    (df.repartition(files).write.option("parquet.block.size", 16384)
     .option("parquet.page.size.row.check.min", 50).option("parquet.page.size.row.check.max", 50)
     .mode("append").parquet(path))


def _run(spark, path, ckpt, out, limit, fail_at=None):
    def keep(df, batch_id):
        if batch_id == fail_at:
            raise RuntimeError("planned failure")
        df.write.mode("overwrite").parquet(f"{out}/batch_id={batch_id}")

    q = (cf.change_feed(spark, path, checkpoint=ckpt, row_groups_per_trigger=limit,
                        settle_seconds=0.0)
         .writeStream.option("checkpointLocation", ckpt).foreachBatch(keep)
         .trigger(processingTime="0 seconds").start())
    try:
        q.processAllAvailable()
    finally:
        q.stop()


def test_every_row_once_over_restarts(spark, events, tmp_path):
    path, ckpt, out = (str(tmp_path / n) for n in ("table", "ckpt", "out"))
    parts = [events.where(F.pmod("id", F.lit(3)) == i) for i in range(3)]
    _append(parts[0], path)
    _run(spark, path, ckpt, out, 4)
    first = spark.read.parquet(out)
    assert first.count() == parts[0].count()
    _append(parts[1], path)
    planned = max(int(n) for n in os.listdir(f"{ckpt}/commits") if n.isdigit()) + 1
    with pytest.raises(Exception, match="planned failure"):
        _run(spark, path, ckpt, out, 4, fail_at=planned)   # planned, not finished
    _append(parts[2], path)
    _run(spark, path, ckpt, out, 4)
    _run(spark, path, ckpt, out, 4)                        # nothing new
    got = spark.read.parquet(out).drop("batch_id")
    assert got.schema.simpleString() == events.schema.simpleString()
    assert got.exceptAll(events).count() == 0 and events.exceptAll(got).count() == 0
    assert spark.read.parquet(out).select("batch_id").distinct().count() > 3


def _written(folder, name, rows, groups, at):
    import pyarrow as pa
    import pyarrow.parquet as pq
    pq.write_table(pa.table({"a": list(range(rows))}), f"{folder}/{name}",
                   row_group_size=max(rows // groups, 1))
    os.utime(f"{folder}/{name}", (at, at))


def test_offsets(spark, tmp_path):
    folder = str(tmp_path)
    schema = spark.createDataFrame([], "a long, added string").schema

    def reader(**kw):
        return cf.ChangeFeedReader({"path": folder, "rowGroupsPerTrigger": 2, "settleSeconds": 5,
                                    **kw}, schema)

    r = reader()
    assert r.latestOffset() == cf.START and r.partitions(cf.START, cf.START) == []
    _written(folder, "z.parquet", 30, 3, 1000)             # older, though its name is later
    _written(folder, "a.parquet", 20, 2, 2000)
    _written(folder, "_hidden.parquet", 20, 2, 1500)
    _written(folder, "new.parquet", 20, 2, time.time())    # not settled
    offsets, seen = [r.initialOffset()], []
    while True:
        end = r.latestOffset()
        if end == offsets[-1]:
            break
        seen.append([p.value for p in r.partitions(offsets[-1], end)])
        offsets.append(end)
        r.commit(end)
    assert seen == [[("z.parquet", 0), ("z.parquet", 1)], [("z.parquet", 2), ("a.parquet", 0)],
                    [("a.parquet", 1)]]
    # a batch is planned alike by another reader, and rows have the wanted columns
    again = reader()
    assert [p.value for p in again.partitions(offsets[1], offsets[2])] == seen[1]
    rows = [x for p in again.partitions(offsets[0], offsets[-1]) for b in again.read(p)
            for x in b.to_pylist()]
    assert sorted(x["a"] for x in rows) == sorted([*range(30), *range(20)])
    assert {x["added"] for x in rows} == {None}
    os.remove(f"{folder}/a.parquet")
    with pytest.raises(FileNotFoundError):
        reader().partitions(offsets[1], offsets[2])
    with pytest.raises(ValueError):
        reader(rowGroupsPerTrigger=0)
