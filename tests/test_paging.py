"""Pages by cursor and by position against a plain sort, with ties, null keys and a hot second."""

import random
from datetime import datetime, timedelta

import pytest

from cellpulse.plans import paging

NEWEST = ["t", "id"]
T0 = datetime(2024, 2, 28, 22)


@pytest.fixture(scope="module")
def listing(spark):
    """A third of all rows in one second, a tenth without a time, the rest over two months."""
    rng = random.Random(3)
    rows = []
    for i in range(1200):
        when = T0 if i % 3 == 0 else T0 + timedelta(seconds=rng.randrange(5_000_000) - 2_500_000)
        rows.append((i, None if i % 10 == 7 else when))
    rng.shuffle(rows)
    ids = sorted(rows, key=lambda r: (r[1] is not None, r[1] or T0, r[0]), reverse=True)
    return spark.createDataFrame(rows, "id long, t timestamp_ntz").repartition(5), [r[0] for r in ids]


@pytest.mark.parametrize("offset", [0, 100, 390, 700, 1070, 1150, 1195, 1200, 5000])
@pytest.mark.parametrize("top_rows", [20, 200])
def test_page_at_equals_a_sort(listing, offset, top_rows):
    df, ids = listing
    got = [r["id"] for r in paging.page_at(df, NEWEST, 40, offset, top_rows).collect()]
    assert got == ids[offset:offset + 40]


def test_cursors_walk_over_every_row_once(listing):
    df, ids = listing
    seen, mark = [], None
    while True:
        rows = paging.page_after(df, NEWEST, mark, 170).collect()
        if not rows:
            break
        seen += [r["id"] for r in rows]
        mark = paging.cursor(rows[-1], NEWEST)
    assert seen == ids


def test_null_key_behind_a_tie(spark):
    df = spark.createDataFrame([(1, None), (1, 5), (None, 2), (None, None)], "a int, b int")
    got = paging.page_after(df, ["a", "b"], {"a": 1, "b": 5}, 9).collect()
    assert [tuple(r) for r in got] == [(1, None), (None, 2), (None, None)]
    got = paging.page_after(df, ["a", "b"], {"a": None, "b": 2}, 9).collect()
    assert [tuple(r) for r in got] == [(None, None)]


def test_cursor_reaches_the_scan_and_deep_pages_take_no_large_top(spark, listing, tmp_path):
    df, _ = listing
    df.write.parquet(str(tmp_path / "rows"))
    stored = spark.read.parquet(str(tmp_path / "rows"))

    def plan(frame):
        return frame._jdf.queryExecution().toString()
    assert "LessThanOrEqual(t," in plan(paging.page_after(stored, NEWEST, {"t": T0, "id": 4}, 10))
    deep = plan(paging.page_at(stored, NEWEST, 10, 1000, top_rows=150))
    assert "limit=1010" not in deep and "GreaterThanOrEqual(t," in deep


def test_empty_table(spark):
    none = spark.createDataFrame([], "id long, t timestamp_ntz")
    assert paging.page_at(none, NEWEST, 10, 90, top_rows=5).count() == 0
    assert paging.page_after(none, NEWEST, {"t": T0, "id": 1}, 10).count() == 0
