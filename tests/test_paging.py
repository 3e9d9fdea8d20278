"""Global row numbers and seek paging against the definition."""

import random

import pytest
from pyspark.sql import functions as F

from eventide.operators.paging import number_rows, ordered_table


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def frame(spark):
    rng = random.Random(3)
    # a hot key holds a third of the rows, some keys are missing
    rows = [(i, 7 if i % 3 == 0 else (None if i % 50 == 1 else rng.randrange(200)), f"t{i % 11}")
            for i in range(3000)]
    return spark.createDataFrame(rows, "id long, k int, position string").repartition(5)


def test_positions_are_row_numbers(frame):
    got = number_rows(frame, ["k", "id"], name="pos", partitions=6).collect()
    want = sorted(frame.collect(), key=lambda r: (r.k is not None, r.k or 0, r.id))
    assert [(r.k, r.id, r.position) for r in sorted(got, key=lambda r: r.pos)] == [
        (r.k, r.id, r.position) for r in want]
    assert sorted(r.pos for r in got) == list(range(3000))


def test_descending_order_and_replaced_column(frame):
    got = number_rows(frame, [F.desc("k"), F.desc("id")]).collect()
    want = sorted(frame.collect(), key=lambda r: (r.k is not None, r.k or 0, r.id), reverse=True)
    assert [r.id for r in sorted(got, key=lambda r: r.position)] == [r.id for r in want]


def test_all_pages_together_are_the_table(spark, frame):
    table = ordered_table(frame.drop("position"), ["k", "id"], partitions=4)
    assert table.total == 3000 and len(table.parts) == 4
    pages = [sorted((r.position, r.id) for r in table.page(700, n).collect()) for n in range(6)]
    assert [len(p) for p in pages] == [700, 700, 700, 700, 200, 0]
    whole = sorted((r.position, r.id) for r in table.rows().collect())
    assert [x for p in pages for x in p] == whole
    expected = frame.orderBy("k", "id").offset(1400).limit(700).collect()
    assert [i for _, i in pages[2]] == [r.id for r in expected]
    assert table.slice(-5, 3).count() == 3 and table.slice(10, 10).count() == 0


def test_a_page_is_a_pushed_range_filter(spark, frame):
    table = ordered_table(frame.drop("position"), ["k", "id"], partitions=8)
    plan = _plan(table.page(100, 12))
    assert "Exchange" not in plan and "Sort" not in plan and "Limit" not in plan
    assert "GreaterThanOrEqual(__place" in plan and "LessThan(__place" in plan
    assert "SinglePartition" not in _plan(table.rows())


def test_empty_and_single(spark):
    empty = ordered_table(spark.createDataFrame([], "id long, k int"), ["k"])
    assert empty.total == 0 and empty.rows().count() == 0 and empty.page(10).count() == 0
    one = ordered_table(spark.createDataFrame([(1, None)], "id long, k int"), ["k", "id"])
    assert [tuple(r) for r in one.page(5).collect()] == [(1, None, 0)]
