"""Reading text tables: everything as strings, a missing file as an empty table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType


def strings(fields: list[str]) -> StructType:
    return StructType([StructField(f, StringType()) for f in fields])


def exists(spark: SparkSession, path: str) -> bool:
    jvm = spark.sparkContext._jvm
    target = jvm.org.apache.hadoop.fs.Path(path)
    found = target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).globStatus(target)
    return found is not None and len(found) > 0


def read_table(spark: SparkSession, path: str, fields: list[str], sep: str = ",", encoding: str = "UTF-8", line_breaks: bool = True) -> DataFrame:
    """A delimited file by its header, as the listed columns; absent ones and blanks are ''.

    With ``line_breaks`` False no value may hold a line break; large files are then read in pieces, by many tasks.
    """
    if not exists(spark, path):
        return spark.createDataFrame([], strings(fields))
    western = encoding == "windows-1252"  # read as Latin-1, with the signs that differ put right afterwards
    rows = spark.read.csv(path, header=True, sep=sep, encoding="ISO-8859-1" if western else encoding, multiLine=line_breaks, escape='"', quote='"', maxCharsPerColumn=10_000_000, enforceSchema=False)
    rows = rows.toDF(*[c.lstrip("\ufeff").strip() for c in rows.columns])
    right = (lambda c: F.translate(c, *western_signs())) if western else (lambda c: c)
    return rows.select(*[F.coalesce(right(F.col(f"`{f}`")), F.lit("")).alias(f) if f in rows.columns else F.lit("").alias(f) for f in fields])


def western_signs() -> tuple[str, str]:
    """(from, to): what Windows-1252 means by the bytes that are control codes in Latin-1."""
    pairs = [(chr(b), bytes([b]).decode("cp1252", "ignore")) for b in range(0x80, 0xA0)]
    return "".join(a for a, c in pairs if c), "".join(c for _, c in pairs if c)


def opening(spark: SparkSession, path: str, size: int = 65536) -> bytes:
    """The first bytes of a file on any file system the session knows."""
    jvm = spark.sparkContext._jvm
    target = jvm.org.apache.hadoop.fs.Path(path)
    stream = target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).open(target)
    try:
        return bytes(b % 256 for b in stream.readNBytes(size))
    finally:
        stream.close()


def sniff(raw: bytes, size: int = 65536) -> tuple[str, str]:
    """(encoding, separator) of a file from its first ``size`` bytes: UTF-8 if they decode, else Windows-1252, else Latin-1."""
    head = raw.splitlines()[0] if raw else b""
    for encoding, name in (("utf-8-sig", "UTF-8"), ("cp1252", "windows-1252")):
        try:
            line = head.decode(encoding)
            (raw if len(raw) < size else raw[:-4]).decode(encoding)
            break
        except UnicodeDecodeError:
            continue
    else:
        line, name = head.decode("latin-1"), "ISO-8859-1"
    return name, ";" if line.count(";") > line.count(",") else ","


def read_smart(spark: SparkSession, path: str, fields: list[str], line_breaks: bool = True) -> DataFrame:
    """A delimited file of unknown encoding and separator; signs that were lost before (U+FFFD) become apostrophes."""
    if not exists(spark, path):
        return spark.createDataFrame([], strings(fields))
    encoding, sep = sniff(opening(spark, path))
    rows = read_table(spark, path, fields, sep, encoding, line_breaks)
    return rows.select(*[F.translate(f, "\ufffd", "'").alias(f) for f in fields])


def read_snapshots(spark: SparkSession, folder: str, fields: list[str], required: str) -> DataFrame:
    """All delimited files below a folder, rows without the required field left out."""
    listed = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", "*.csv")
    if not exists(spark, folder) or listed.load(folder).select("path").isEmpty():
        return spark.createDataFrame([], strings(fields))
    rows = spark.read.option("recursiveFileLookup", True).option("pathGlobFilter", "*.csv").csv(folder, header=True, multiLine=True, escape='"')
    rows = rows.select(*[F.coalesce(F.col(f), F.lit("")).alias(f) if f in rows.columns else F.lit("").alias(f) for f in fields])
    return rows.where(F.trim(required) != "")


def read_splits(spark: SparkSession, folder: str, splits: tuple[str, ...] = ("train", "dev", "test")) -> DataFrame:
    """Tagged corpora of JSON lines (tokens, tags), the splits that are there pooled, each row with its split."""
    paths = [p for s in splits if exists(spark, p := f"{folder}/{s}.json")]
    schema = "tokens array<string>, tags array<string>"
    if not paths:
        return spark.createDataFrame([], schema + ", split string")
    return spark.read.schema(schema).json(paths).withColumn("split", F.regexp_extract(F.input_file_name(), "([^/]+)\\.json$", 1))


def list_literal(column: str) -> F.Column:
    """A list written as text in a programming language's notation; null if it can't be read."""
    return F.from_json(F.col(column), "array<string>", {"allowSingleQuotes": "true"})


def dict_literal(column: str) -> F.Column:
    """A dictionary of lists written as text in a programming language's notation; null if it can't be read."""
    return F.from_json(F.col(column), "map<string, array<string>>", {"allowSingleQuotes": "true"})


def alias_index(rows: DataFrame, label: str, aliases: str, order: str) -> DataFrame:
    """(key, label): names and their comma-separated aliases, the first wins; rows named by a bare number with Q are left out."""
    from taxoloom.functions.text import normalize_label

    named = rows.where(~F.col(label).rlike("^Q[0-9]+$"))
    every = F.concat(F.array(F.col(label)), F.split(F.coalesce(F.col(aliases), F.lit("")), ","))
    long = named.select(F.col(label).alias("label"), F.col(order).alias("o"), F.posexplode(every).alias("p", "a")).withColumn("key", normalize_label("a")).where("key <> ''")
    return long.groupBy("key").agg(F.min_by("label", F.struct("o", "p", "label")).alias("label"))


def clusters(rows: DataFrame, cluster: str, terms: str) -> DataFrame:
    """(cluster, term) of synonym clusters told one term or one joined list a row."""
    parts = F.explode(F.split(F.coalesce(F.col(terms), F.lit("")), "[|;]"))
    return rows.select(F.col(cluster).alias("cluster"), F.trim(parts).alias("term")).where("term <> ''").distinct()
