"""Paged API responses as a data source, for batch and for streams.

Recorded pages are JSON files in a folder, each with a list of results. As a batch every
file is a partition; as a stream the offset is the page, a micro-batch takes at most
``pagesPerBatch`` pages (the call budget of a poller), and Spark's checkpoint is what
remembers how far it came. A client that calls an API would only replace ``_load``.
"""

from __future__ import annotations

import json
import os
from collections.abc import Iterator

from pyspark.sql.datasource import DataSource, DataSourceReader, DataSourceStreamReader, InputPartition

SCHEMA = "page int, place int, record string, end_of_records boolean"


class Page(InputPartition):
    def __init__(self, number: int, path: str) -> None:
        super().__init__(number)
        self.number, self.path = number, path


def _files(folder: str) -> list[str]:
    return sorted(os.path.join(folder, n) for n in os.listdir(folder) if n.endswith(".json"))


def _load(page: Page, field: str) -> Iterator[tuple]:
    with open(page.path, encoding="utf-8") as f:
        body = json.load(f)
    body = body.get("response", body)
    for i, record in enumerate(body.get(field) or []):
        yield page.number, i, json.dumps(record, sort_keys=True), bool(body.get("endOfRecords", False))


class _Batch(DataSourceReader):
    def __init__(self, options: dict) -> None:
        self.folder, self.field = options["path"], options.get("results", "results")

    def partitions(self) -> list[Page]:
        return [Page(i, p) for i, p in enumerate(_files(self.folder))]

    def read(self, partition: Page) -> Iterator[tuple]:
        return _load(partition, self.field)


class _Stream(DataSourceStreamReader):
    def __init__(self, options: dict) -> None:
        self.folder, self.field = options["path"], options.get("results", "results")
        self.step, self.at = int(options.get("pagesPerBatch", 100)), 0

    def initialOffset(self) -> dict:  # noqa: N802
        return {"page": 0}

    def latestOffset(self) -> dict:  # noqa: N802
        self.at = min(self.at + self.step, len(_files(self.folder)))
        return {"page": self.at}

    def partitions(self, start: dict, end: dict) -> list[Page]:
        self.at = max(self.at, end["page"])
        return [Page(i, p) for i, p in enumerate(_files(self.folder)) if start["page"] <= i < end["page"]]

    def read(self, partition: Page) -> Iterator[tuple]:
        return _load(partition, self.field)


class PagedJson(DataSource):
    """``spark.dataSource.register(PagedJson)``, then format ``paged_json`` with the options
    ``path``, ``results`` (the field that holds the records) and ``pagesPerBatch``."""

    @classmethod
    def name(cls) -> str:
        return "paged_json"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema) -> DataSourceReader:  # noqa: ANN001
        return _Batch(self.options)

    def streamReader(self, schema) -> DataSourceStreamReader:  # noqa: ANN001, N802
        return _Stream(self.options)
