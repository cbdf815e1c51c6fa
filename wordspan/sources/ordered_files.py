"""A stream over the folders of a store in an order that a seed decides, which stops when its reader has enough.

Each trigger offers a few more folders. Once the marker `enough` is there, no more are offered: what isn't needed is
never opened, not even listed.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from hashlib import md5

import pyarrow as pa
import pyarrow.dataset as ds
import pyarrow.fs as fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceStreamReader, InputPartition
from pyspark.sql.types import StructType

from wordspan.sources.planned import opened

NAME = "wordspan_ordered_files"


def order(names: list[str], seed: int) -> list[str]:
    return sorted(names, key=lambda n: (md5(f"{seed}|{n}".encode()).hexdigest(), n))


@dataclass
class Folder(InputPartition):
    path: str


class Reader(DataSourceStreamReader):
    def __init__(self, path: str, marker: str, seed: int, per_trigger: int, start: int, schema: pa.Schema):
        self.path, self.marker, self.per_trigger, self.start, self.schema = path, marker, per_trigger, start, schema
        files, root = opened(path)
        folders = [i.base_name for i in files.get_file_info(fs.FileSelector(root)) if i.type == fs.FileType.Directory and not i.base_name.startswith(("_", "."))]
        self.names, self.given = order(folders, seed), start

    def initialOffset(self) -> dict:  # noqa: N802
        return {"folders": self.start}

    def latestOffset(self) -> dict:  # noqa: N802
        files, marker = opened(self.marker)
        if files.get_file_info(marker).type == fs.FileType.NotFound:
            self.given = min(len(self.names), self.given + self.per_trigger)
        return {"folders": self.given}

    def partitions(self, start: dict, end: dict) -> list[InputPartition]:
        self.given = max(self.given, end["folders"])
        return [Folder(f"{self.path}/{n}") for n in self.names[start["folders"] : end["folders"]]]

    def read(self, partition: Folder) -> Iterator[pa.RecordBatch]:
        files, root = opened(partition.path)
        parts = [i.path for i in files.get_file_info(fs.FileSelector(root, recursive=True)) if i.path.endswith(".parquet")]
        for batch in ds.dataset(parts, format="parquet", filesystem=files).to_batches(columns=self.schema.names) if parts else ():
            yield pa.RecordBatch.from_arrays([c.cast(f.type) for c, f in zip(batch.columns, self.schema, strict=True)], schema=self.schema)


class OrderedFiles(DataSource):
    """Options: path, marker, seed, per_trigger, start (folders that an earlier run has taken)."""

    @classmethod
    def name(cls) -> str:
        return NAME

    def streamReader(self, schema: StructType) -> Reader:  # noqa: N802
        from pyspark.sql.pandas.types import to_arrow_schema

        o = self.options
        return Reader(o["path"].rstrip("/"), o["marker"], int(o.get("seed", "0")), int(o.get("per_trigger", "1")), int(o.get("start", "0")), to_arrow_schema(schema))


def stream(spark: SparkSession, path: str, marker: str, seed: int, schema: str, per_trigger: int = 1, start: int = 0) -> DataFrame:
    spark.dataSource.register(OrderedFiles)
    return spark.readStream.format(NAME).schema(schema).options(path=path, marker=marker, seed=seed, per_trigger=per_trigger, start=start).load()
