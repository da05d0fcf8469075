"""Landed API pages as a stream whose offset is the page cursor.

``base`` holds one folder a page, ``page={n}``, with JSON lines
``{"page": n, "results": [...]}``. Every micro-batch is one poll of at most
``pages_per_poll`` pages, which ends before the first page that is absent or has
no results. The next poll goes on behind them; a poll that finds nothing sets the
cursor back to ``start_page``. The checkpoint keeps the cursor, so a restarted
query goes on where it was, and a batch that was planned but not finished is read
again with the same bounds. With ``availableNow`` a run is one poll; with
``processingTime`` the interval is the time between polls.
"""

from __future__ import annotations

import json
from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceStreamReader, InputPartition

SCHEMA = "page long, value string"


class PagePartition(InputPartition):
    def __init__(self, page: int):
        super().__init__(page)
        self.page = page


class PageReader(DataSourceStreamReader):
    """Offsets are ``{"poll", "page"}``: polls made, and the page where the next one begins."""

    def __init__(self, base: str, first: int, step: int):
        self.base, self.first, self.step = base.rstrip("/"), max(1, first), max(1, step)
        self.cursor: dict | None = None

    def initialOffset(self) -> dict:
        return {"poll": 0, "page": self.first}

    def latestOffset(self) -> dict:
        at = self.cursor or self.initialOffset()
        nothing = self._empty(at["page"])
        self.cursor = {"poll": at["poll"] + 1, "page": self.first if nothing else at["page"] + self.step}
        return self.cursor

    def partitions(self, start: dict, end: dict) -> list[PagePartition]:
        if self.cursor is None:  # a restart begins by naming the last offset of the checkpoint
            self.cursor = end
        pages: list[PagePartition] = []
        if end["page"] == start["page"] + self.step:  # else a poll without results, or no poll
            for page in range(start["page"], end["page"]):
                if self._empty(page):
                    break
                pages.append(PagePartition(page))
        return pages

    def read(self, partition: PagePartition) -> Iterator[tuple[int, str]]:
        return ((partition.page, line) for line in self._lines(partition.page))

    def _lines(self, page: int) -> Iterator[str]:
        from pyarrow import fs
        system, root = fs.FileSystem.from_uri(self.base)
        found = system.get_file_info(fs.FileSelector(f"{root}/page={page}", allow_not_found=True))
        for f in sorted(found, key=lambda f: f.path):
            if f.is_file and f.base_name[0] not in "_.":
                with system.open_input_stream(f.path) as stream:
                    yield from (x for x in stream.read().decode().split("\n") if x.strip())

    def _empty(self, page: int) -> bool:
        return not any(json.loads(x).get("results") for x in self._lines(page))


class PageCursor(DataSource):
    @classmethod
    def name(cls) -> str:
        return "page_cursor"

    def schema(self) -> str:
        return SCHEMA

    def streamReader(self, schema) -> PageReader:
        o = self.options
        return PageReader(o["path"], int(o.get("start_page", 1)), int(o.get("pages_per_poll", 1)))


def page_stream(spark: SparkSession, base: str, pages_per_poll: int = 1, start_page: int = 1) -> DataFrame:
    """(page, value): the JSON lines of the pages, a poll a micro-batch."""
    spark.dataSource.register(PageCursor)
    return spark.readStream.format("page_cursor").option("pages_per_poll", str(pages_per_poll)) \
        .option("start_page", str(start_page)).load(base)
