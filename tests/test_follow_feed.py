"""A feed followed as a stream: growth, breaking off, and what it may not do."""

from __future__ import annotations

import pytest
from pyspark.errors import StreamingQueryException
from pyspark.sql import types as T

from gramledger.sources import pages

ROW = T.StructType([T.StructField("k", T.LongType()), T.StructField("flag", T.StringType())])


def rows_upto(n, fails_at=None):
    """``fetch`` of a feed of ``n`` rows; every third one carries the flag."""

    def fetch(offset, size, wanted):
        if fails_at is not None and size > 1 and offset <= fails_at < offset + size:
            raise ConnectionError("lost on the way")
        every = ((k, "Y" if k % 3 == 0 else "N") for k in range(n))
        kept = [r for r in every if wanted.get("flag") in (None, r[1])]
        return kept[offset : offset + size]

    return fetch


@pytest.fixture
def follow(spark, tmp_path):
    def run(n, fails_at=None, **options):
        spark.dataSource.register(pages.paged_feed("followed", ROW, rows_upto(n, fails_at)))
        options = {"batch_pages": 2, "size": 10, **options}
        return pages.follow_feed(spark, "followed", str(tmp_path / "out"), str(tmp_path / "state"), **options)

    def landed():
        return sorted(tuple(r) for r in spark.read.parquet(str(tmp_path / "out")).collect())

    return run, landed


def test_grows_and_goes_on_within_a_page(follow):
    run, landed = follow
    for n in (0, 7, 7, 12, 95):
        assert run(n) == n
    assert landed() == [(k // 10, k, "Y" if k % 3 == 0 else "N") for k in range(95)]


def test_breaks_off_and_goes_on_without_repeats(follow):
    run, landed = follow
    with pytest.raises(StreamingQueryException):
        run(95, fails_at=57)
    done = [k for _, k, _ in landed()]
    assert done == list(range(40))  # two batches were committed, the third left nothing
    assert run(95) == 95
    assert [k for _, k, _ in landed()] == list(range(95))


def test_server_side_filter(follow):
    run, landed = follow
    assert run(50, where={"flag": "Y"}) == 17
    assert [k for _, k, _ in landed()] == list(range(0, 50, 3))


@pytest.mark.parametrize("n", [0, 1, 9, 10, 11, 1023, 70_000])
def test_end_of_the_feed_in_few_calls(n):
    calls = []

    def fetch(offset, size, wanted):
        calls.append(offset)
        return [(k,) for k in range(offset, min(n, offset + size))]

    reader = pages.FollowedReader(fetch, 10, None, {})
    assert reader.latestOffset() == {"rows": n} and len(calls) <= 40
    assert reader.latestOffset() == {"rows": n}
    parts = reader.partitions({"rows": 3}, {"rows": n}) if n > 3 else []
    assert sum(p.value[1] - p.value[0] for p in parts) == max(0, n - 3)


def test_rows_that_went_missing_stop_the_run():
    reader = pages.FollowedReader(lambda offset, size, wanted: [(1,)], 10, None, {})
    with pytest.raises(ValueError, match="gave 1 of 10"):
        list(reader.read(pages.InputPartition((0, 10))))


def test_one_stream_takes_all_batches(spark, follow, tmp_path, monkeypatch):
    """The target is counted, and a stream started, as often for many batches as for one; a batch has its pages only."""
    run, landed = follow
    counted = []
    rows = pages._rows
    monkeypatch.setattr(pages, "_rows", lambda *args: counted.append(1) or rows(*args))
    assert run(215) == 215 and len(counted) == 3
    commits = sorted(int(p.name) for p in (tmp_path / "state" / "commits").iterdir() if p.name.isdigit())
    assert commits == list(range(11))
    assert [k for _, k, _ in landed()] == list(range(215))


def test_limit_moves_with_planned_batches_only():
    reader = pages.FollowedReader(lambda offset, size, wanted: [(k,) for k in range(offset, min(95, offset + size))], 10, 20, {}, 20)
    assert reader.latestOffset() == reader.latestOffset() == {"rows": 20}
    reader.partitions({"rows": 20}, {"rows": 40})  # a batch that was planned by a run before
    assert reader.latestOffset() == {"rows": 60}
    reader.partitions({"rows": 60}, {"rows": 80})
    assert reader.latestOffset() == {"rows": 95}


@pytest.mark.parametrize("tasks", [1, 3, 8, 200])
def test_pages_of_a_batch_are_dealt_over_few_tasks(tasks):
    """Each page is asked for by itself, as by a task per page; rows come once and in order within a task."""
    calls = []

    def fetch(offset, size, wanted):
        calls.append((offset, size))
        return [(k,) for k in range(offset, min(1995, offset + size))]

    reader = pages.FollowedReader(fetch, 10, 1000, {}, 1000, tasks)
    parts = reader.partitions({"rows": 995}, {"rows": 1995})
    assert len(parts) == min(100, -(-100 // -(-100 // tasks)))
    assert [row for p in parts for row in reader.read(p)] == [(k // 10, k) for k in range(995, 1995)]
    assert calls == [(k, 10) for k in range(995, 1995, 10)]


def test_a_batch_is_written_by_few_tasks(spark, follow, tmp_path):
    """A batch of 60 pages leaves no more files than there are cores."""
    run, landed = follow
    assert run(600, batch_pages=60) == 600
    files = [p for p in (tmp_path / "out").iterdir() if p.name.endswith(".parquet")]
    assert len(files) <= spark.sparkContext.defaultParallelism < 60
    assert [k for _, k, _ in landed()] == list(range(600))
