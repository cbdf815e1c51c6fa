"""Chunked samples as a data source that plans its scan from the manifest: only chunks that may hold rows are opened.

A range is asked for by options, or by filters on split and idx, which are pushed down where
spark.sql.python.filterPushdown.enabled is on. A manifest has the range of each chunk and the folder of its files; where
the store has a log, only the manifests of committed batches count. Files are listed when they are read, in the tasks. Chunks
that share a folder have a column chunk_id in their files.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import pyarrow as pa
import pyarrow.dataset as ds
import pyarrow.fs as fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, EqualTo, Filter, GreaterThan, GreaterThanOrEqual, In, InputPartition, LessThan, LessThanOrEqual

from wordspan.sources.chunks import SCHEMA

NAME = "wordspan_chunks"
#: Rows of the chunks that one task reads, about.
TASK_ROWS = 100_000
STORED = f"split string, chunk_id long, {SCHEMA}"


def opened(path: str) -> tuple[fs.FileSystem, str]:
    """The file system and the path in it; "file:/a" is taken as "file:///a"."""
    if path.startswith("file:"):
        path = "/" + path[5:].lstrip("/")
    return (fs.LocalFileSystem(), path) if path.startswith("/") else fs.FileSystem.from_uri(path)


@dataclass
class Folders(InputPartition):
    """Folders of a task, and which chunks of each: (split, folder, chunk_ids)."""

    folders: list[tuple[str, str, list[int]]]


@dataclass
class Reader(DataSourceReader):
    path: str
    schema: pa.Schema
    splits: list[str] | None
    start: int | None
    end: int | None
    task_rows: int

    def manifest(self) -> ds.Dataset:
        files, path = opened(self.path)
        log = fs.FileSelector(f"{path}/log", allow_not_found=True)
        names = [i.base_name for i in files.get_file_info(log) if not i.base_name.startswith((".", "_"))]
        folders = [f"{path}/manifest/batch={n}" for n in names] or [f"{path}/_manifest"]
        found = [i.path for folder in folders for i in files.get_file_info(fs.FileSelector(folder, allow_not_found=True)) if i.path.endswith(".parquet")]
        if not found:
            raise FileNotFoundError(f"{self.path} has no committed chunks")
        return ds.dataset(found, format="parquet", filesystem=files)

    def partitions(self) -> list[InputPartition]:
        """Chunks of the splits whose range overlaps, those of unknown range too, put together by their rows."""
        fits = ds.field("n") > 0
        if self.splits is not None:
            fits &= ds.field("split").isin(self.splits)
        if self.start is not None:
            fits &= ds.field("hi").is_null() | (ds.field("hi") >= self.start)
        if self.end is not None:
            fits &= ds.field("lo").is_null() | (ds.field("lo") < self.end)
        rows = self.manifest().to_table(columns=["split", "chunk_id", "folder", "n"], filter=fits).group_by(["split", "chunk_id", "folder"]).aggregate([("n", "sum")]).sort_by([("folder", "ascending"), ("chunk_id", "ascending")])
        out, held = [], self.task_rows
        for split, chunk, folder, n in zip(*(rows.column(c).to_pylist() for c in ("split", "chunk_id", "folder", "n_sum")), strict=True):
            if held + n > self.task_rows:
                out.append(Folders([]))
                held = 0
            held_folders = out[-1].folders
            if not held_folders or held_folders[-1][:2] != (split, folder):
                held_folders.append((split, folder, []))
            held_folders[-1][2].append(chunk)
            held += n
        return out or [Folders([])]

    def read(self, partition: Folders) -> Iterator[pa.RecordBatch]:
        files, path = opened(self.path)
        inside = [ds.field("idx") >= self.start] if self.start is not None else []
        inside += [ds.field("idx") < self.end] if self.end is not None else []
        stored = pa.schema([f for f in self.schema if f.name not in ("split", "chunk_id")])
        for split, folder, chunks in partition.folders:
            parts = [i.path for i in files.get_file_info(fs.FileSelector(f"{path}/{folder}")) if i.path.endswith(".parquet")]
            found = ds.dataset(parts, format="parquet", filesystem=files)
            named = [n for n in stored.names if n in found.schema.names]
            if lacking := [n for n in ("text", "labels", "model", "idx") if n in stored.names and n not in named]:
                raise ValueError(f"chunk {folder} lacks {lacking}")
            fits = ds.field("status") == "generated" if "status" in found.schema.names else None
            shared = "chunk_id" in found.schema.names
            for f in [*inside, ds.field("chunk_id").isin(chunks)] if shared else inside:
                fits = f if fits is None else fits & f
            for batch in found.to_batches(columns=[*named, "chunk_id"] if shared else named, filter=fits):
                own = {"split": pa.array([split] * batch.num_rows, pa.string()), "chunk_id": batch.column("chunk_id") if shared else pa.array([chunks[0]] * batch.num_rows, pa.int64())}
                columns = [own[f.name] if f.name in own else batch.column(f.name).cast(f.type) if f.name in named else pa.nulls(batch.num_rows, f.type) for f in self.schema]
                if batch.num_rows:
                    yield pa.RecordBatch.from_arrays(columns, schema=self.schema)


class Pushing(Reader):
    """Takes over filters on split and idx; Spark wants such a reader only where its setting for them is on."""

    def least(self, value: int) -> None:
        self.start = value if self.start is None else max(self.start, value)

    def before(self, value: int) -> None:
        self.end = value if self.end is None else min(self.end, value)

    def pushFilters(self, filters: list[Filter]) -> Iterable[Filter]:  # noqa: N802
        for f in filters:
            match f:
                case EqualTo(("split",), str(v)):
                    self.splits = [v] if self.splits is None or v in self.splits else []
                case In(("split",), values):
                    self.splits = [v for v in values if isinstance(v, str) and (self.splits is None or v in self.splits)]
                case EqualTo(("idx",), int(v)):
                    self.least(v)
                    self.before(v + 1)
                case GreaterThanOrEqual(("idx",), int(v)):
                    self.least(v)
                case GreaterThan(("idx",), int(v)):
                    self.least(v + 1)
                case LessThan(("idx",), int(v)):
                    self.before(v)
                case LessThanOrEqual(("idx",), int(v)):
                    self.before(v + 1)
                case _:
                    yield f


class Chunks(DataSource):
    """Options: path; start, end (before which) and split narrow the scan as filters do; task_rows."""

    @classmethod
    def name(cls) -> str:
        return NAME

    def schema(self) -> str:
        return STORED

    def reader(self, schema) -> Reader:
        from pyspark.sql.pandas.types import to_arrow_schema

        asked = lambda key: int(self.options[key]) if key in self.options else None
        split = self.options.get("split")
        kind = Pushing if self.options.get("pushing") == "true" else Reader
        return kind(self.options["path"].rstrip("/"), to_arrow_schema(schema), None if split is None else [split], asked("start"), asked("end"), asked("task_rows") or TASK_ROWS)


def read(spark: SparkSession, path: str, **options: str | int) -> DataFrame:
    """All committed samples: split, chunk_id and the columns of chunks.SCHEMA."""
    spark.dataSource.register(Chunks)
    pushing = spark.conf.get("spark.sql.python.filterPushdown.enabled", "false")
    return spark.read.format(NAME).options(pushing=pushing, **options).load(path)


def read_range(spark: SparkSession, path: str, split: str, start: int, end: int) -> DataFrame:
    """A split's samples with start <= idx < end; no other chunk is opened.

    Bad bounds raise ValueError; so does, when it is read, a chunk that lacks a column. A store where nothing is
    committed raises FileNotFoundError when the scan is planned.
    """
    if start < 0 or end <= start:
        raise ValueError("need 0 <= start < end")
    return read(spark, path, split=split, start=start, end=end)
