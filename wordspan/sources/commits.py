"""Chunks committed as they fill, from a stream of resolved slots: each batch once, whole or not at all.

    rows/batch=B/whole=true/split=S/chunks=P    slots of the chunks that batch B completed
    rows/batch=B/whole=false/...                slots of chunks that still lack some; the next batch takes them over
    manifest/batch=B                            a row for each chunk that batch B completed
    log/B                                       written last: only batches that have it are there for readers

In a short run each chunk has a folder of its own. In a long one so many neighbours share a folder that a batch writes
few files, whatever the size of a chunk; the column chunk_id of the files tells them apart.
A batch that comes again after its entry in the log does nothing; one that broke off before is written over. So a run
that fails and starts again leaves what a run without failures leaves.
"""

from __future__ import annotations

import re
from collections.abc import Callable

from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from wordspan.functions.names import free
from wordspan.sources.chunks import chunk_of

#: The batch that writes what is left when a run has ended.
END = "end"
#: Folders of a split up to which each chunk has its own, and slots of a folder up to which its chunks grow in number.
FOLDERS, FOLDER_SLOTS = 16, 20_000


def chunks_a_folder(total: int, chunk_size: int) -> int:
    """How many neighbouring chunks of a split of `total` slots share a folder."""
    return max(1, min(-(-total // (chunk_size * FOLDERS)), FOLDER_SLOTS // chunk_size))


class Log:
    """The entries of a store's log, by the file system that Spark uses for the path."""

    def __init__(self, spark: SparkSession, path: str):
        self.jvm, self.root = spark.sparkContext._jvm, path.rstrip("/")
        self.files = self.path("log").getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())

    def path(self, name: str):
        return self.jvm.org.apache.hadoop.fs.Path(f"{self.root}/{name}")

    def batches(self) -> list[str]:
        """Names of committed batches in the order of their numbers, the end last."""
        if not self.files.exists(self.path("log")):
            return []
        names = [f.getPath().getName() for f in self.files.listStatus(self.path("log"))]
        return sorted((n for n in names if n == END or n.isdigit()), key=lambda n: (n == END, 0 if n == END else int(n)))

    def commit(self, name: str) -> None:
        """Fails if the entry is there: of two writers of one batch one wins."""
        self.files.create(self.path(f"log/{name}"), False).close()

    def drop(self, folder: str) -> None:
        self.files.delete(self.path(folder), True)


def slots_of(spark: SparkSession, path: str, batch: str, whole: str, schema) -> DataFrame | None:
    """A batch's slots; None if it wrote none of that kind."""
    try:
        return spark.read.schema(schema).option("basePath", f"{path}/rows").parquet(f"{path}/rows/batch={batch}/whole={whole}").select(*schema.names)
    except PySparkException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return None


def write_batch(batch: DataFrame, name: int | str, path: str, chunk_size: int, totals: dict[str, int], stop: Callable[[str], None] = lambda _: None) -> bool:
    """Adds a batch of slots (split, idx, status and a sample's columns); False if it was committed before.

    A chunk is whole when all slots of its range have come; `totals` has the number of slots of each split, counted from
    0. A slot that comes twice counts once, generated before others; slots of chunks that are committed are left out. `stop` is
    called after each step, for tests of failures.
    """
    if odd := [s for s in totals if not re.fullmatch(r"[\w.-]+", s, re.ASCII)]:
        raise ValueError(f"names of splits are names of folders: {odd}")
    spark, name, path = batch.sparkSession, str(name), path.rstrip("/")
    log = Log(spark, path)
    before = log.batches()
    if name in before:
        return False
    if END in before:
        raise ValueError("the run has ended; its last chunks are written")
    last = before[-1] if before else None
    left = slots_of(spark, path, last, "false", batch.schema) if last else None
    rows = batch if left is None else left.unionByName(batch)
    keyed = rows.where(F.col("idx").isNotNull() & F.col("split").isin(list(totals)) & F.col("status").isNotNull()).withColumn("chunk_id", chunk_of(F.col("idx"), chunk_size))
    if (known := manifest(spark, path)) is not None:
        keyed = keyed.join(known.where("whole").select("split", "chunk_id"), ["split", "chunk_id"], "left_anti")
    of_split = lambda values: F.element_at(F.create_map(*(F.lit(x) for item in values.items() for x in item)), F.col("split"))
    (place,) = free([*batch.columns, "whole", "chunk_id"], "chunks")
    # Both windows are within a folder's rows, so one shuffle deals them for the windows and for the files.
    dealt = keyed.withColumn(place, F.floor(F.col("chunk_id") / of_split({s: chunks_a_folder(n, chunk_size) for s, n in totals.items()}))).repartition("split", place)
    order = Window.partitionBy("split", place, "chunk_id", "idx").orderBy(F.col("status") != "generated", F.xxhash64(*sorted(batch.columns)))
    single = dealt.withColumn("__place", F.row_number().over(order)).where("__place = 1").drop("__place")
    size = F.least(F.lit(chunk_size).cast("long"), of_split(totals) - F.col("chunk_id") * chunk_size)
    came = F.count("*").over(Window.partitionBy("split", place, "chunk_id"))
    parted = single.withColumn("whole", F.lit(name == END) | (came >= size)).sortWithinPartitions("whole", "split", place, "idx")
    parted.write.mode("overwrite").partitionBy("whole", "split", place).parquet(f"{path}/rows/batch={name}")
    stop("rows")
    made = spark.read.schema(f"idx long, status string, chunk_id long, whole boolean, split string, {place} long").parquet(f"{path}/rows/batch={name}").where("whole")
    good = F.col("status") == "generated"
    folder = F.concat(F.lit(f"rows/batch={name}/whole=true/split="), F.col("split"), F.lit(f"/{place}="), F.col(place).cast("string"))
    counts = made.groupBy("split", "chunk_id", folder.alias("folder")).agg(F.min(F.when(good, F.col("idx"))).alias("lo"), F.max(F.when(good, F.col("idx"))).alias("hi"), F.count_if(good).alias("n"), F.count_if(~good).alias("dropped"))
    counts.withColumn("whole", F.lit(name != END)).write.mode("overwrite").parquet(f"{path}/manifest/batch={name}")
    stop("manifest")
    log.commit(name)
    for old in before[:-1]:  # nothing takes them over any more
        log.drop(f"rows/batch={old}/whole=false")
    return True


MANIFEST = "split string, chunk_id long, lo long, hi long, n long, dropped long, whole boolean, folder string"


def manifest(spark: SparkSession, path: str) -> DataFrame | None:
    """A row for each committed chunk, those without a sample (n = 0) too; None if nothing is committed."""
    path = path.rstrip("/")
    batches = Log(spark, path).batches()
    return spark.read.schema(MANIFEST).parquet(*(f"{path}/manifest/batch={b}" for b in batches)) if batches else None


def sink(path: str, chunk_size: int, totals: dict[str, int], stop: Callable[[str], None] = lambda _: None) -> Callable[[DataFrame, int], None]:
    """For foreachBatch."""
    if chunk_size < 1:
        raise ValueError("chunk_size must be at least 1")

    def write(batch: DataFrame, number: int) -> None:
        write_batch(batch, number, path, chunk_size, totals, stop)

    return write


def finish(spark: SparkSession, path: str, chunk_size: int, totals: dict[str, int], schema) -> bool:
    """Ends a run: what chunks that aren't whole have of samples is written and committed. False if that was done."""
    return write_batch(spark.createDataFrame([], schema), END, path, chunk_size, totals)
