"""A paged source: pages that name the next page, read as one table. Offline the pages are JSON files of a folder; a service needs a
``fetch`` of the user's that returns such a page."""

from __future__ import annotations

import json
import os
from collections.abc import Callable, Iterator

from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

ITEM = "page int, kind string, id string, title string, published string, duration string, caption boolean"
FIELDS = ("kind", "id", "title", "published", "duration", "caption")


class Page(InputPartition):
    """One page, told by its token."""

    def __init__(self, number: int, token: str):
        super().__init__(number)
        self.token = token


def folder_fetch(root: str) -> Callable[[str], dict]:
    """Pages as ``<token>.json`` below a folder."""

    def fetch(token: str) -> dict:
        with open(os.path.join(root, f"{token}.json"), encoding="utf-8") as f:
            return json.load(f)

    return fetch


class PagedReader(DataSourceReader):
    def __init__(self, root: str, first: str, most: int):
        self.root, self.first, self.most = root, first, most

    def partitions(self) -> list[Page]:
        """Tokens are chained, so they are followed once on the driver; items are read by the tasks."""
        fetch, out, token = folder_fetch(self.root), [], self.first
        while token and len(out) < self.most:
            out.append(Page(len(out), token))
            token = fetch(token).get("nextPageToken")
        return out

    def read(self, partition: Page) -> Iterator[tuple]:
        for item in folder_fetch(self.root)(partition.token).get("items", ()):
            yield (partition.value, *(item.get(k) for k in FIELDS))


class PagedSource(DataSource):
    """``spark.read.format("paged").option("root", folder).load()``."""

    @classmethod
    def name(cls) -> str:
        return "paged"

    def schema(self) -> str:
        return ITEM

    def reader(self, schema) -> PagedReader:
        return PagedReader(self.options["root"], self.options.get("first", "first"), int(self.options.get("most", 1000)))
