"""A Python data source for injected rows, streams of rows included, and secrets with fallbacks."""

from __future__ import annotations

from collections.abc import Callable, Iterable

from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition


def rows_data_source(name: str, schema: str, make: Callable[[int], Iterable[tuple]], parts: int = 1) -> type[DataSource]:
    """A DataSource class of that name whose part i yields make(i); register it by spark.dataSource.register."""

    class Reader(DataSourceReader):
        def partitions(self):
            return [InputPartition(i) for i in range(parts)]

        def read(self, partition):
            yield from make(partition.value)

    class Rows(DataSource):
        @classmethod
        def name(cls):
            return name

        def schema(self):
            return schema

        def reader(self, schema):
            return Reader()

    return Rows


def secret(readers: Iterable[Callable[[], str | None]], required: bool = True) -> str | None:
    """The first value that a reader gives; a reader that fails is passed over. Without any: LookupError, or None if not required."""
    for read in readers:
        try:
            value = read()
        except Exception:
            continue
        if value and value.strip():
            return value.strip()
    if required:
        raise LookupError("no source has the secret")
    return None
