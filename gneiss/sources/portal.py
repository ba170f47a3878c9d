"""A Spark data source over a folder of captured pages, and the connector registry.

The network client is not part of a query: pages are captured elsewhere and read here in parallel, one
partition a file.  ``spark.read.format("captured_pages").load(folder)``.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Iterator
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from gneiss.sources import regulations

SCHEMA = "url string, html string, group string, type_id string, year int, page int, retrieved_at string"


class _File(InputPartition):
    def __init__(self, path: str):
        self.path = path


class _Reader(DataSourceReader):
    def __init__(self, folder: str):
        self.folder = folder

    def partitions(self) -> list[InputPartition]:
        return [_File(str(p)) for p in sorted(Path(self.folder).rglob("*.jsonl"))]

    def read(self, partition: InputPartition) -> Iterator[tuple]:
        names = [x.split()[0] for x in SCHEMA.split(", ")]
        with open(partition.path, encoding="utf-8") as f:
            for line in f:
                if line.strip():
                    row = json.loads(line)
                    yield tuple(row.get(n) for n in names)


class CapturedPages(DataSource):
    """Pages captured as JSON lines on a file system that every executor mounts."""

    @classmethod
    def name(cls) -> str:
        return "captured_pages"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema) -> DataSourceReader:
        return _Reader(self.options["path"])


def register(spark: SparkSession) -> None:
    """Make the format known to a session."""
    spark.dataSource.register(CapturedPages)


#: Connectors by name: functions from captured pages to tables.
CONNECTORS: dict[str, dict[str, Callable[..., DataFrame]]] = {
    "regulations": {"catalog": regulations.catalog_types, "search": regulations.search_pages, "details": regulations.details},
}
