"""Postings as they arrive: last writes, demand per time window, and a growing table by source."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from taxoloom.operators.tables import last_write


def read_folder(spark: SparkSession, folder: str, schema: str, per_trigger: int = 100) -> DataFrame:
    """A folder of Parquet files as a stream."""
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", per_trigger).option("pathGlobFilter", "*.parquet").parquet(folder)


def once_each(stream: DataFrame, keys: list[str], at: str, late: str = "1 day") -> DataFrame:
    """Rows repeated within the watermark left out."""
    return stream.withWatermark(at, late).dropDuplicatesWithinWatermark(keys)


def windowed_demand(stream: DataFrame, at: str, by: list[str], width: str = "1 day", slide: str | None = None, late: str = "1 day") -> DataFrame:
    """(start, by, n): events per window; a window comes out when the watermark has passed it."""
    w = F.window(at, width, slide) if slide else F.window(at, width)
    return stream.withWatermark(at, late).groupBy(w.alias("w"), *by).agg(F.count("*").alias("n")).select(F.col("w.start").alias("start"), *by, "n")


def keep_last(target: str, keys: list[str], at: str) -> Callable[[DataFrame, int], None]:
    """A sink that folds each batch into a keyed table; a batch that is run again changes nothing.

    The table is written beside the old one under the batch's number and named by a pointer file, so a broken batch
    leaves the old table in place.
    """

    def write(batch: DataFrame, number: int) -> None:
        spark = batch.sparkSession
        jvm = spark.sparkContext._jvm
        conf = spark.sparkContext._jsc.hadoopConfiguration()
        pointer = jvm.org.apache.hadoop.fs.Path(f"{target}/CURRENT")
        fs = pointer.getFileSystem(conf)
        old = None
        if fs.exists(pointer):
            name = spark.read.text(f"{target}/CURRENT").first()[0]
            old = spark.read.parquet(f"{target}/{name}")
        both = batch if old is None else old.unionByName(batch)
        last_write(both, keys, [F.col(at), *[F.coalesce(F.col(c).cast("string"), F.lit("")) for c in batch.columns]]).write.mode("overwrite").parquet(f"{target}/batch-{number}")
        out = fs.create(pointer, True)
        out.write(bytearray(f"batch-{number}\n".encode()))
        out.close()

    return write


def run_to_end(frame: DataFrame, name: str, mode: str = "append") -> StreamingQuery:
    """Runs a stream over what there is into a table in memory; for tests and small inputs."""
    query = frame.writeStream.format("memory").queryName(name).outputMode(mode).trigger(availableNow=True).start()
    query.awaitTermination()  # ends by itself once all that is there has been read
    return query
