"""Writing tables: whole, by source, as keyed snapshots, as reports."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from taxoloom.operators.tables import last_write, project


def write_table(rows: DataFrame, path: str, fields: list[str], form: str = "parquet") -> None:
    """The listed fields, in place of what was there."""
    out = project(rows, fields)
    (out.write.mode("overwrite").option("header", True) if form == "csv" else out.write.mode("overwrite")).format(form).save(path)


def write_by_source(rows: DataFrame, path: str) -> None:
    """Only the partitions of the sources at hand are replaced; all others stay untouched."""
    rows.dropDuplicates().write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("source").parquet(path)


def write_snapshot(old: DataFrame | None, new: DataFrame, keys: list[str], at: str, path: str) -> None:
    """A keyed snapshot in which the last write of a key counts, sorted by key."""
    both = new if old is None else old.unionByName(new, allowMissingColumns=True)
    last_write(both, keys, [F.col(at)]).orderBy(*keys).write.mode("overwrite").parquet(path)


def report(rows: DataFrame, title: str, most: int = 1000) -> str:
    """A small result as a Markdown table; one of more than ``most`` rows is refused, not cut."""
    got = rows.limit(most + 1).collect()
    if len(got) > most:
        raise ValueError(f"a report has at most {most} rows")
    head = "| " + " | ".join(rows.columns) + " |\n|" + "---|" * len(rows.columns)
    return f"# {title}\n\n{head}\n" + "\n".join("| " + " | ".join("" if v is None else str(v) for v in r) + " |" for r in got) + "\n"
