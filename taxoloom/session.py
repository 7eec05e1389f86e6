"""Session helper, table loading and lineage cutting."""

from __future__ import annotations

import atexit
import pathlib
import shutil
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

_OWN_DIRS: dict[str, str] = {}
_WRITTEN: dict[str, list[str]] = {}


def session(name: str = "taxoloom", cores: str = "*", **conf: str) -> SparkSession:
    """A local session with the settings the library is tested with."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(name)
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "12g")
    )
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    return builder.getOrCreate()


_SHIPPED: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Sends this package to the executors, once a session; on a local master they read it where it is."""
    app = spark.sparkContext.applicationId
    if spark.sparkContext.master.startswith("local") or app in _SHIPPED:
        return
    home = pathlib.Path(__file__).resolve().parent
    folder = tempfile.mkdtemp(prefix=f"{home.name}-")  # the driver's own: executors fetch the package from it
    atexit.register(shutil.rmtree, folder, True)
    spark.sparkContext.addPyFile(shutil.make_archive(f"{folder}/{home.name}", "zip", home.parent, home.name))
    _SHIPPED.add(app)


def load(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One table of a data directory."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors share: ``spark.checkpoint.dir``, or a temporary one of our own where it is unset."""
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    app = spark.sparkContext.applicationId
    if app not in _OWN_DIRS:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        _OWN_DIRS[app] = tempfile.mkdtemp(prefix="taxoloom-")
        atexit.register(shutil.rmtree, _OWN_DIRS[app], True)
    return "file://" + _OWN_DIRS[app]


class Scratch:
    """Written tables that cut the lineage of iterative plans.

    ``cut`` writes a frame to the shared folder and reads it back, so a lost executor never loses state and the
    plan of the next round starts from a scan with known size. ``drop`` deletes a superseded table, ``sweep`` all that a
    session wrote, once its results have been read.
    """

    def __init__(self, spark: SparkSession, label: str):
        self.spark = spark
        self.base = f"{shared_dir(spark)}/taxoloom/{label}-{uuid.uuid4().hex}"
        self.paths: dict[int, str] = {}
        self.n = 0
        _WRITTEN.setdefault(spark.sparkContext.applicationId, []).append(self.base)

    def cut(self, df: DataFrame) -> DataFrame:
        path = f"{self.base}/{self.n}"
        self.n += 1
        df.write.parquet(path)
        back = self.spark.read.schema(df.schema).parquet(path)
        self.paths[id(back)] = path
        return back

    def drop(self, df: DataFrame | None) -> None:
        path = self.paths.pop(id(df), None)
        if path:
            _delete(self.spark, path)


def _delete(spark: SparkSession, path: str) -> None:
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(target, True)


def sweep(spark: SparkSession) -> int:
    """Deletes every table the session wrote to cut lineage and says how many folders that were; frames that read them end."""
    bases = _WRITTEN.pop(spark.sparkContext.applicationId, [])
    for base in bases:
        _delete(spark, base)
    return len(bases)


def spread(df: DataFrame) -> DataFrame:
    """A frame with work for every core: shuffled only if it is read in fewer pieces than there are cores."""
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if df.rdd.getNumPartitions() < cores else df


def bounded_broadcast(df: DataFrame, max_rows: int, count: int | None = None) -> DataFrame:
    """Hint a broadcast only if the frame is counted to be small; larger frames keep the planner's shuffle join."""
    rows = df.limit(max_rows + 1).count() if count is None else count
    return F.broadcast(df) if rows <= max_rows else df


def bare(column) -> F.Column:
    """A string without blanks of any kind at its ends; null becomes ''."""
    return F.coalesce(F.regexp_replace(F.col(column) if isinstance(column, str) else column, BLANK_ENDS, ""), F.lit(""))


BLANK = "[\\s\\u00a0\\u1680\\u2000-\\u200d\\u202f\\u205f\\u2060\\u3000\\ufeff]"
BLANK_ENDS = f"^{BLANK}+|{BLANK}+$"
