"""Paged feeds: landed page files, the stop rule, and a live feed as a data source."""

from __future__ import annotations

import json
from collections.abc import Callable, Iterable, Iterator, Mapping
from itertools import count

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.datasource import (
    DataSource,
    DataSourceReader,
    DataSourceStreamReader,
    EqualTo,
    Filter,
    InputPartition,
)

from gramledger.schemas import envelope
from gramledger.sources.bronze import LANDED_JSON

# Rows per page and page limit of the two feeds.
PAYMENT_PAGE_SIZE, PAYMENT_PAGES = 5000, 40
RECALL_PAGE_SIZE, RECALL_PAGES = 1000, 10

PAGE, FOLDER = "page", "pages"


def land_pages(
    df: DataFrame, offset: str, path: str, page_size: int = PAYMENT_PAGE_SIZE, folder_pages: int = 1
) -> None:
    """Write rows as page folders; ``offset`` is each row's position in the feed, from 0.

    Rows of a page are brought together first, or every task would add a file to every page. The files are compressed.
    With ``folder_pages``, so many small pages share a folder and their records name their page: to make, list and open a
    folder takes longer than to read a small page. ``read_pages`` is told the same number.
    """
    paged = df.withColumn(PAGE, F.floor(F.col(offset) / page_size).cast("long"))
    part = PAGE
    if folder_pages > 1:
        part = FOLDER
        paged = paged.withColumn(FOLDER, F.floor(F.col(PAGE) / folder_pages))
    paged.hint("rebalance", part).write.partitionBy(part).options(**LANDED_JSON).json(path)


def read_pages(
    spark: SparkSession, path: str, schema: T.StructType, max_pages: int | None = None, folder_pages: int = 1
) -> DataFrame:
    """Rows of the landed pages ahead of the first empty one.

    A page is filled if a record is parsed from it, whatever the size or the compression of its file.
    """
    paged = T.StructType([*schema.fields, T.StructField(PAGE, T.LongType())])
    if folder_pages == 1:
        return until_empty_page(spark.read.schema(paged).json(path), max_pages)
    df = spark.read.schema(paged.add(FOLDER, T.LongType())).json(path)
    if max_pages is not None:  # prunes folders, as the limit itself does where each page has its own
        df = df.where(F.col(FOLDER) * folder_pages < max_pages)
    return until_empty_page(df.drop(FOLDER), max_pages)


def until_empty_page(
    df: DataFrame, max_pages: int | None = None, filled: DataFrame | None = None
) -> DataFrame:
    """Stop rule of a paged feed: the first page without rows ends it, later pages do not count.

    ``filled`` lists the pages that hold rows; without it they are taken from ``df``, which is then read
    more than once, so write a live feed before. The limit becomes a scalar subquery, so page folders
    beyond it are pruned.
    """
    if max_pages is not None:
        df = df.where(F.col(PAGE) < max_pages)
    present = (df if filled is None else filled).select(PAGE).distinct()
    start = df.sparkSession.range(1).select(F.lit(0).cast("long").alias(PAGE))
    following = present.select((F.col(PAGE) + 1).alias(PAGE)).unionAll(start)
    stop = following.join(present, PAGE, "left_anti").agg(F.min(PAGE))
    return df.where(F.col(PAGE) < stop.scalar())


def read_envelopes(
    spark: SparkSession, path: str, row: T.StructType, lines: bool = True
) -> DataFrame:
    """Rows of pages that wrap them in an array under ``results``: a page per line, or per file."""
    pages = spark.read.schema(envelope(row)).option("multiLine", not lines).json(path)
    return pages.select(F.inline("results"))


class PagedFeed(DataSource):
    """Live feed. Make it concrete with :func:`paged_feed`.

    With the option ``pages``, so many pages are read, a task each; without it one task reads page after
    page up to the first empty one. As a stream it reads any number of pages in a bounded number of tasks: :func:`follow_feed`.
    """

    feed_name = "paged_feed"
    row_schema = T.StructType([])
    fetch: Callable[[int, int, Mapping[str, object]], Iterable[tuple]]

    @classmethod
    def name(cls) -> str:
        return cls.feed_name

    def schema(self) -> T.StructType:
        return T.StructType([T.StructField(PAGE, T.LongType()), *self.row_schema.fields])

    def reader(self, schema: T.StructType) -> DataSourceReader:
        pages = int(self.options["pages"]) if "pages" in self.options else None
        size = int(self.options.get("size", PAYMENT_PAGE_SIZE))
        return PagedReader(type(self).fetch, self.row_schema.fieldNames(), pages, size)

    def streamReader(self, schema: T.StructType) -> DataSourceStreamReader:
        size = int(self.options.get("size", PAYMENT_PAGE_SIZE))
        limit, step, tasks = (int(self.options[o]) if o in self.options else None for o in ("limit", "step", "tasks"))
        return FollowedReader(type(self).fetch, size, limit, json.loads(self.options.get("where", "{}")), step, tasks)


class PagedReader(DataSourceReader):
    def __init__(self, fetch: Callable, columns: list[str], pages: int | None, size: int) -> None:
        self.fetch, self.columns, self.pages, self.size = fetch, columns, pages, size
        self.wanted: dict[str, object] = {}

    def pushFilters(self, filters: list[Filter]) -> Iterator[Filter]:
        """Equality on a feed column is left to the server; Spark applies the rest."""
        for f in filters:
            if isinstance(f, EqualTo) and len(f.attribute) == 1 and f.attribute[0] in self.columns:
                self.wanted[f.attribute[0]] = f.value
            else:
                yield f

    def partitions(self) -> list[InputPartition]:
        return [InputPartition(page) for page in ([None] if self.pages is None else range(self.pages))]

    def read(self, partition: InputPartition) -> Iterator[tuple]:
        for page in count() if partition.value is None else [partition.value]:
            filled = False
            for row in self.fetch(page * self.size, self.size, self.wanted):
                filled = True
                yield (page, *row)
            if not filled:
                return


class FollowedReader(DataSourceStreamReader):
    """The feed as a stream: an offset is a number of rows, a batch the rows that came after the last one.

    A batch is dealt over ``tasks`` tasks at most, in runs of whole pages; without it a page is a task. A task asks for page
    after page. With ``limit`` the stream ends at that many rows for now; with ``step`` too, each batch that is planned moves the
    limit to so many rows behind it. ``where`` goes to the server with every call.
    """

    def __init__(
        self,
        fetch: Callable,
        size: int,
        limit: int | None,
        where: Mapping[str, object],
        step: int | None = None,
        tasks: int | None = None,
    ) -> None:
        self.fetch, self.size, self.limit, self.where = fetch, size, limit, where
        self.step, self.tasks = step, tasks
        self.known = 0

    def initialOffset(self) -> dict:
        return {"rows": 0}

    def latestOffset(self) -> dict:
        """How many rows the feed holds, found by asking for single ones: some 40 calls, however many there are."""
        low, step = self.known, self.size
        high = low + step if self.limit is None else self.limit
        while self._holds(high - 1):
            low = high
            if self.limit is not None:
                break
            step *= 2
            high = low + step
        while low < high and low + 1 <= high - 1:
            middle = (low + high) // 2
            if self._holds(middle - 1):
                low = middle
            else:
                high = middle
        self.known = low
        return {"rows": low}

    def _holds(self, row: int) -> bool:
        return row < 0 or next(iter(self.fetch(row, 1, self.where)), None) is not None

    def partitions(self, start: dict, end: dict) -> list[InputPartition]:
        if self.step is not None:
            self.known = max(self.known, end["rows"])
            self.limit = max(self.limit or 0, end["rows"] + self.step)
        pages = -((start["rows"] - end["rows"]) // self.size)  # pages of the batch, rounded up
        span = self.size * (1 if self.tasks is None else max(1, -(-pages // self.tasks)))
        edges = [*range(start["rows"], end["rows"], span), end["rows"]]
        return [InputPartition((a, b)) for a, b in zip(edges, edges[1:])]

    def read(self, partition: InputPartition) -> Iterator[tuple]:
        start, stop = partition.value
        for first in range(start, stop, self.size):
            end = min(first + self.size, stop)
            rows = list(self.fetch(first, end - first, self.where))
            if len(rows) != end - first:  # rows that were there are gone; going on would lose what moved up
                raise ValueError(f"the feed gave {len(rows)} of {end - first} rows from {first} on")
            for i, row in enumerate(rows):
                yield ((first + i) // self.size, *row)


def follow_feed(
    spark: SparkSession,
    name: str,
    target: str,
    state: str,
    batch_pages: int = PAYMENT_PAGES,
    size: int = PAYMENT_PAGE_SIZE,
    where: Mapping[str, object] | None = None,
) -> int:
    """Append to ``target`` what the feed registered as ``name`` holds beyond it; returns the rows there now.

    ``batch_pages`` pages at a time are read, by as many tasks as there are cores (to start a task, and to write its file,
    takes longer than to read a page), and committed together with the place they end at. A run
    that breaks off is called again and goes on after the last commit: nothing is missing and nothing comes twice.
    ``size`` and ``where`` stay the same for a target, whose rows count as the place reached. The feed keeps the order
    of its rows and grows at the end.
    """
    step = batch_pages * size
    tasks = spark.sparkContext.defaultParallelism
    options = {"size": size, "where": json.dumps(dict(where or {})), "step": step, "tasks": tasks}
    rows = _rows(spark, target)
    while True:
        feed = spark.readStream.format(name).options(**options, limit=rows + step).load()
        writer = feed.writeStream.format("parquet").option("path", target).option("checkpointLocation", state)
        query = writer.start()  # one stream for all batches: to start one, and to count the target, takes longer than a batch
        try:
            query.processAllAvailable()
        finally:
            query.stop()
        before, rows = rows, _rows(spark, target)
        if rows == before:
            return rows


def _rows(spark: SparkSession, target: str) -> int:
    """Rows committed to a target, counted in the footers of its files."""
    try:
        return spark.read.parquet(target).count()
    except AnalysisException:  # no target yet, or one without a file
        return 0


def paged_feed(
    name: str,
    schema: T.StructType,
    fetch: Callable[[int, int, Mapping[str, object]], Iterable[tuple]],
) -> type[PagedFeed]:
    """Data source class around ``fetch(offset, size, filters)``; register it with the session.

    Pages are asked for side by side, so apply :func:`until_empty_page` to what is read.
    """
    return type(
        "RegisteredFeed",
        (PagedFeed,),
        {"feed_name": name, "row_schema": schema, "fetch": staticmethod(fetch)},
    )
