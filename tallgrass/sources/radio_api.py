"""A paged radio API as a data source: one partition a page, each fetched where it is processed."""

from __future__ import annotations

import json
from collections.abc import Iterator

from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition
from pyspark.sql.types import LongType, StringType, StructField, StructType

from tallgrass.sources.fetching import get_json


class Page(InputPartition):
    def __init__(self, number: int):
        self.number = number


class RadioReader(DataSourceReader):
    def __init__(self, options: dict):
        self.url, self.size = options["url"], int(options.get("page_size", 100))
        self.most = int(options["max_pages"]) if "max_pages" in options else None
        if self.size < 1 or (self.most is not None and self.most < 1):
            raise ValueError("page_size and max_pages must be positive")

    def page(self, number: int) -> dict:
        data = get_json(self.url.format(page=number, size=self.size))
        if not isinstance(data.get("episodes"), list):
            raise ValueError(f"page {number} has no list of episodes")
        return data

    def partitions(self) -> list[Page]:
        total = int(self.page(1).get("pagination", {}).get("totalpages", 1))
        return [Page(i) for i in range(1, min(total, self.most or total) + 1)]

    def read(self, partition: Page) -> Iterator[tuple]:
        for episode in self.page(partition.number)["episodes"]:
            yield partition.number, int(episode["id"]), json.dumps(episode, ensure_ascii=False)


class RadioApi(DataSource):
    """``spark.dataSource.register(RadioApi)``; options ``url`` (with ``{page}`` and ``{size}``), ``page_size``, ``max_pages``."""

    @classmethod
    def name(cls) -> str:
        return "radio_api"

    def schema(self) -> StructType:
        return StructType([StructField("page", LongType()), StructField("id", LongType()), StructField("json", StringType())])

    def reader(self, schema: StructType) -> RadioReader:
        return RadioReader(self.options)
