"""Text and parquet sinks."""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.errors import UnsupportedOperationException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def write_text(
    df: DataFrame,
    path: str,
    sep: str = ",",
    single_file: bool = False,
    null_text: str = "",
    mode: str = "errorifexists",
    order: Sequence[str | Column] = (),
) -> None:
    """Write the columns of each row joined by ``sep``, one row per line.

    Every partition writes its own file; with ``order`` the files taken by name are in that order.
    With ``single_file`` they are then joined to one: see ``join_files``.
    """
    fields = [F.coalesce(F.col(f"`{name}`").cast("string"), F.lit(null_text)) for name in df.columns]
    rows = df.orderBy(*order) if order else df
    lines = rows.select(F.concat_ws(sep, *fields).alias("value"))
    if not single_file:
        lines.write.mode(mode).text(path)
        return
    if mode not in ("errorifexists", "error", "overwrite", "ignore"):
        raise ValueError(f"one file cannot be written in mode {mode!r}")
    spark = df.sparkSession
    there = _file_system(spark, path)[1]
    if there and mode == "ignore":
        return
    if there and mode != "overwrite":
        raise FileExistsError(f"{path} already exists")
    parts = f"{path.rstrip('/')}.parts-{uuid.uuid4().hex}"
    lines.write.text(parts)
    join_files(spark, parts, path)


def _file_system(spark: SparkSession, path: str):
    """The file system of ``path``, and whether that exists."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    system = place.getFileSystem(spark._jsc.hadoopConfiguration())
    return system, system.exists(place)


def join_files(spark: SparkSession, source: str, target: str) -> None:
    """Join the part files of folder ``source``, by name, to one file in a new folder ``target``; what
    was at ``target`` and ``source`` itself are deleted.

    The rows have been written by many tasks by now, and no task sees all of them.  File systems that
    can (HDFS) link the blocks of the parts together, which moves no data.  On others the
    bytes of one part after another are copied, a small buffer at a time.
    """
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    path = jvm.org.apache.hadoop.fs.Path
    system, there = _file_system(spark, target)
    found = [s.getPath() for s in system.listStatus(path(source)) if s.getPath().getName().startswith("part-")]
    parts = sorted((p for p in found if system.getFileStatus(p).getLen()), key=lambda p: p.getName())
    joined = path(source, "joined")
    if not parts:
        system.create(joined).close()
    elif len(parts) == 1 or _linked(system, parts, spark):
        joined = parts[0]
    else:
        out = system.create(joined)
        try:
            for p in parts:
                part = system.open(p)
                try:
                    jvm.org.apache.hadoop.io.IOUtils.copyBytes(part, out, conf, False)
                finally:
                    part.close()
        finally:
            out.close()
    if there:
        system.delete(path(target), True)
    system.mkdirs(path(target))
    if not system.rename(joined, path(target, "part-00000.txt")):
        raise OSError(f"{joined} could not be moved to {target}")
    system.create(path(target, "_SUCCESS")).close()
    system.delete(path(source), True)


def _linked(system, parts: list, spark: SparkSession) -> bool:
    """Let the file system append all other parts to the first; False if it does not do that."""
    rest = spark.sparkContext._gateway.new_array(spark._jvm.org.apache.hadoop.fs.Path, len(parts) - 1)
    for i, p in enumerate(parts[1:]):
        rest[i] = p
    try:
        system.concat(parts[0], rest)
    except UnsupportedOperationException:
        return False
    return True


def write_csv(df: DataFrame, path: str, sep: str = ",", mode: str = "errorifexists") -> None:
    """Delimited text without header, the counterpart of ``read_csv``."""
    df.write.mode(mode).option("header", False).option("sep", sep).csv(path)


def write_parquet(df: DataFrame, path: str, mode: str = "errorifexists") -> None:
    """Parquet; by default an existing path is an error."""
    df.write.mode(mode).parquet(path)
