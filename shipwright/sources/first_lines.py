"""First lines of files as a Spark data source: one partition a file, read no further than the block that ends its line."""

from __future__ import annotations

import json
import os
import re
from collections.abc import Iterator
from dataclasses import dataclass

from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from shipwright.session import ship_package

BLOCK = 4096              # bytes asked for at once
_LINE_END = re.compile(rb"\r\n|\r|\n")


@dataclass
class OneFile(InputPartition):
    table: str
    file: str


def files_of(path: str) -> list[str]:
    """Data files under a path; names that start with a dot or an underscore are not data."""
    path = path.rstrip("/")
    system, inner = fs.FileSystem.from_uri(path)
    prefix = path[:-len(inner)] if path.endswith(inner) else ""
    info = system.get_file_info(inner)
    if info.type == fs.FileType.NotFound:
        raise FileNotFoundError(path)
    found = [info] if info.is_file else system.get_file_info(fs.FileSelector(inner, recursive=True))
    return sorted(prefix + f.path for f in found if f.is_file and os.path.basename(f.path)[0] not in "._")


def first_line(file: str) -> tuple[str | None, int]:
    """(first line without its end, bytes read); no line in an empty file."""
    system, inner = fs.FileSystem.from_uri(file)
    got, end = b"", None
    with system.open_input_stream(inner) as stream:
        while end is None and (block := stream.read(BLOCK)):
            got += block
            end = _LINE_END.search(got)
    return (got[:end.start()] if end else got).decode("utf-8", "replace") if got else None, len(got)


class FirstLineReader(DataSourceReader):
    def __init__(self, paths: dict[str, str]):
        self.paths = paths

    def partitions(self) -> list[InputPartition]:
        return [OneFile(table, file) for table, path in self.paths.items() for file in files_of(path)]

    def read(self, partition: InputPartition) -> Iterator[tuple]:
        if isinstance(partition, OneFile):                   # without any file Spark asks for one empty partition
            yield partition.table, partition.file, *first_line(partition.file)


class FirstLines(DataSource):
    """Option ``paths``: a JSON object of table names and their files or folders."""

    @classmethod
    def name(cls) -> str:
        return "first_lines"

    def schema(self) -> str:
        return "table string, file string, line string, bytes_read long"

    def reader(self, schema) -> DataSourceReader:
        return FirstLineReader(json.loads(self.options["paths"]))


def first_lines(spark: SparkSession, paths: dict[str, str]) -> DataFrame:
    """(table, file, line, bytes_read) of every data file."""
    ship_package(spark)
    spark.dataSource.register(FirstLines)
    return spark.read.format("first_lines").option("paths", json.dumps(paths)).load()
