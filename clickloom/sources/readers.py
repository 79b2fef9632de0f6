"""File and in-memory scans.  Every reader is lazy and splits by Spark's own
``spark.sql.files.maxPartitionBytes``; none takes a partition count."""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from clickloom.sources.schemas import ABSENT_TEXT, USER_VISIT_ACTION

CORRUPT = "_corrupt_record"


def read_lines(spark: SparkSession, path: str) -> DataFrame:
    """One row per text line, column ``value``."""
    return spark.read.text(path)


def read_csv(
    spark: SparkSession,
    path: str,
    schema: T.StructType | str,
    sep: str = ",",
    null_text: str | None = None,
) -> DataFrame:
    """Delimited text without header, read with an explicit schema."""
    reader = spark.read.schema(schema).option("header", False).option("sep", sep)
    if null_text is not None:
        reader = reader.option("nullValue", null_text)
    return reader.csv(path)


def read_tsv(spark: SparkSession, path: str, schema: T.StructType | str) -> DataFrame:
    return read_csv(spark, path, schema, sep="\t")


def read_json(
    spark: SparkSession, path: str, schema: T.StructType | str | None = None
) -> DataFrame:
    """JSON lines.  Without a schema Spark infers one, which reads the input twice."""
    reader = spark.read if schema is None else spark.read.schema(schema)
    return reader.json(path)


def read_action_log(
    spark: SparkSession,
    path: str,
    sep: str = "_",
    mode: str = "FAILFAST",
    keep_corrupt: bool = False,
) -> DataFrame:
    """The 13-field action log, ``_``- or tab-delimited.

    The text ``null`` becomes NULL and quote signs are plain characters.  A line that
    does not fit the schema is an error.  With ``keep_corrupt`` such lines are kept
    whole in ``_corrupt_record`` instead; ``load_action_log`` parts them off.
    """
    schema = USER_VISIT_ACTION
    if keep_corrupt:
        mode = "PERMISSIVE"
        schema = T.StructType(schema.fields + [T.StructField(CORRUPT, T.StringType())])
    return (
        spark.read.schema(schema)
        .option("header", False)
        .option("sep", sep)
        .option("quote", "")
        .option("nullValue", ABSENT_TEXT)
        .option("mode", mode)
        .option("columnNameOfCorruptRecord", CORRUPT)
        .csv(path)
    )


class TooManyBadLines(ValueError):
    """A log had more lines that do not fit than are tolerated."""


@dataclass(frozen=True)
class Loaded:
    """The rows of a log, and its lines that do not fit as (line, file)."""

    good: DataFrame
    bad: DataFrame
    n_good: int
    n_bad: int


def load_action_log(
    spark: SparkSession,
    path: str,
    target: str,
    sep: str = "_",
    tolerated: int = 0,
    tolerated_share: float = 0.0,
) -> Loaded:
    """Read an action log once and part its lines: rows go to ``target``/bad=false as parquet,
    lines that do not fit to ``target``/bad=true, whole and with the file they stand in.

    Up to ``tolerated`` bad lines, or that share of all lines if it is more, are taken;
    beyond, ``TooManyBadLines`` is raised once all have been written, so that they can be
    looked at.  Counts are those of the written files.
    """
    line = F.col(CORRUPT)
    parted = read_action_log(spark, path, sep, keep_corrupt=True).select(
        *USER_VISIT_ACTION.names,
        line.alias("line"),
        F.when(line.isNotNull(), F.col("_metadata.file_path")).alias("file"),
        line.isNotNull().alias("bad"),
    )
    parted.write.partitionBy("bad").parquet(target)
    more = [T.StructField(c, T.StringType()) for c in ("line", "file")] + [T.StructField("bad", T.BooleanType())]
    rows = spark.read.schema(T.StructType(USER_VISIT_ACTION.fields + more)).parquet(target)
    good = rows.where(~F.col("bad")).select(*USER_VISIT_ACTION.names)
    bad = rows.where("bad").select("line", "file")
    loaded = Loaded(good, bad, good.count(), bad.count())
    most = max(tolerated, int(tolerated_share * (loaded.n_good + loaded.n_bad)))
    if loaded.n_bad > most:
        raise TooManyBadLines(f"{loaded.n_bad} of {loaded.n_good + loaded.n_bad} lines do not fit, {most} are tolerated; see {target}/bad=true")
    return loaded


def values(
    spark: SparkSession, rows: Iterable[Sequence], schema: T.StructType | str | list[str]
) -> DataFrame:
    """Literal rows, for lookup tables written down in code."""
    return spark.createDataFrame(list(rows), schema)
