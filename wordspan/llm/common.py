"""Helpers that several operators share: staging, Arrow passes, bounded memo tables."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: The white space that the contracts name: space and U+0009 to U+000D.
SPACES = " \t\n\x0b\x0c\r"
#: Bytes of an Arrow batch that are worked on at once.
BATCH_BYTES = 16 << 20
#: Rows of an Arrow batch between Spark and Python: whole texts are wide rows, and a batch is held on both sides.
BATCH_ROWS = 4000


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A given table; what is made of it goes through Python in narrow batches."""
    narrow_batches(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share. Where the session names none, a temporary one, in local mode only."""
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not named:
        if not spark.sparkContext.master.startswith("local[") and spark.sparkContext.master != "local":
            raise ValueError("spark.checkpoint.dir must name a folder that the driver and all executors share")
        named = tempfile.mkdtemp(prefix="wordspan-")
        spark.sparkContext.setCheckpointDir(named)
    return named.rstrip("/")


def stage(df: DataFrame, **options: str) -> DataFrame:
    """Writes the rows once to the shared folder and reads them back: lineage ends here, a lost executor costs nothing."""
    path = f"{shared_dir(df.sparkSession)}/stage-{uuid.uuid4().hex}"
    df.write.options(**options).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def narrow_batches(spark: SparkSession) -> None:
    """Lowers the rows of a batch to BATCH_ROWS for the session's queries; what is lower already stays."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(spark.conf.get(key, "10000")) <= BATCH_ROWS:
        spark.conf.set(key, str(BATCH_ROWS))


def shuffle_width(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def parts(batch: pa.RecordBatch, most_bytes: int = BATCH_BYTES) -> Iterator[pa.RecordBatch]:
    """The batch in parts of at most so many bytes, or of one row."""
    if batch.num_rows > 1 and batch.nbytes > most_bytes:
        half = batch.num_rows // 2
        yield from parts(batch.slice(0, half), most_bytes)
        yield from parts(batch.slice(half), most_bytes)
    elif batch.num_rows:
        yield batch


def arrow_pass(df: DataFrame, each: Callable[[], Callable[[pa.RecordBatch], pa.RecordBatch | None]], schema, most_bytes: int = BATCH_BYTES) -> DataFrame:
    """mapInArrow with a set-up that runs once a task; the function it returns turns one batch into one batch.

    Batches of long texts are worked on in parts, so a task's memory doesn't grow with the texts of 10,000 rows.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        turn = each()
        for batch in batches:
            for part in parts(batch, most_bytes):
                if (out := turn(part)) is not None:
                    yield out
        del turn  # workers are used again by other tasks: nothing of this one stays
        pa.default_memory_pool().release_unused()

    return df.mapInArrow(run, schema)


def where_arrow(df: DataFrame, each: Callable[[], Callable[[pa.RecordBatch], list[bool]]]) -> DataFrame:
    """The rows, with all columns, for which the function that `each` returns says True; no shuffle.

    Columns go through Python by number, as not every name a column can have may be given to it.
    """
    names = df.columns
    plain = df.toDF(*(f"c{k}" for k in range(len(names))))

    def masked():
        turn = each()
        return lambda batch: batch.filter(pa.array(turn(batch.rename_columns(names)), pa.bool_()))

    return arrow_pass(plain, masked, plain.schema).toDF(*names)


def texts(batch: pa.RecordBatch, column: str = "text") -> list[str]:
    """The column's strings; null becomes the empty string."""
    return [t or "" for t in batch.column(column).to_pylist()]


def commonest(counts: DataFrame, most: int):
    """The rows of the highest counts, as many as fit in `most` and occur at least twice, as pandas by code.

    Counts fall off fast, so the table of counts of counts is short; rows of the last count that don't fit all go.
    """
    capped = F.least("n", F.lit(65_535))
    sizes = sorted(((r["k"], r["m"]) for r in counts.groupBy(capped.alias("k")).agg(F.count("*").alias("m")).collect()), reverse=True)
    least, left = 65_536, most
    for k, m in sizes:
        if k < 2 or m > left:
            break
        least, left = k, left - m
    return counts.where(F.col("n") >= least).toPandas().sort_values("code", ignore_index=True)


def remainder(column: str, by: int):
    """crc32 of the id as decimal text, modulo `by`: the fold that marks held-out rows."""
    return F.crc32(F.col(column).cast("string").cast("binary")) % by
