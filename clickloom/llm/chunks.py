"""Passages that documents share, found by chunks that only their own lines bound.

A passage is a run of at least ``min_lines`` lines with text and ``min_chars`` characters,
or one line of more than ``long_line`` words.  Chunks are the least passages: from each
line with text on, the shortest run that is one; up to each, the shortest that is one;
and each long line.  They cover every passage wholly, and what stands around a passage
has no part in them: so a line goes if, and only if, a passage with it stands earlier.
Of equal chunks the one of the smallest (doc_id, text hash, line) stays; the lines of the
others go, after their bytes were compared with those of the first.  A chunk that
overlaps the first in the same text loses only the lines behind it.

Only hashes are grouped over the corpus.  Texts are shuffled twice: for the comparison
and for taking the lines out.  All of it is DataFrame functions.

Null and empty texts stay as they are.  A document all of whose lines are repeated is
left with an empty text and ``n_left`` 0.  A null ``doc_id`` sorts first.  Rows equal in
id and text are one document and keep or lose the same lines.  An empty table gives an
empty table.  Other columns are passed on, but for those of the added names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from clickloom.llm.common import released, written


def _least(filled: Column, min_lines: int, min_chars: int, back: bool) -> Column:
    """The shortest run of the lines of ``filled``, from the first on, that is a passage;
    ``back`` if they come from last to first."""

    def step(s, x):
        lead = s["lead"] if back else x["lead"]
        chars = s["chars"] + x["len"] + F.when(s["n"] > 0, lead).otherwise(0)
        return F.when(s["done"], s).otherwise(
            F.struct(
                (s["n"] + 1).alias("n"),
                chars.alias("chars"),
                x["lead"].alias("lead"),
                F.when(s["n"] > 0, s["first"]).otherwise(x["at"]).alias("first"),
                x["at"].alias("last"),
                ((s["n"] + 1 >= min_lines) & (chars >= min_chars)).alias("done"),
            )
        )

    zero = F.struct(*[F.lit(0).alias(k) for k in ("n", "chars", "lead", "first", "last")], F.lit(False).alias("done"))
    return F.aggregate(
        filled,
        zero,
        step,
        lambda s: F.when(s["done"], _bounds(F.least(s["first"], s["last"]), F.greatest(s["first"], s["last"]) + 1)),
    )


def _bounds(start: Column, end: Column) -> Column:
    """Both as one number: equal numbers are found by hash, equal structs only pair by pair."""
    return F.shiftleft(start.cast("long"), 32).bitwiseOR(end.cast("long"))


def chunk_rows(docs: DataFrame, min_lines: int = 2, min_chars: int = 80, long_line: int = 50) -> DataFrame:
    """(doc_id, place, start, end, h, n_chars) of the chunks."""
    # Each line has a character and an end, so no chunk has more lines with text.
    most = max(min_lines, min_chars // 2 + 1)
    df = docs.where("text is not null").select(
        "doc_id", F.xxhash64("text").alias("place"), F.split("text", "\n").alias("_lines")
    )
    df = df.withColumn("_hashes", F.transform("_lines", lambda x: F.xxhash64(x))).withColumn(
        "_at",
        F.filter(F.sequence(F.lit(0), F.size("_lines") - 1), lambda i: F.trim(F.get("_lines", i)) != ""),
    )
    # ``lead`` counts the characters between a line and the one with text before it.
    df = df.withColumn(
        "_filled",
        F.transform(
            "_at",
            lambda at, i: F.struct(
                at.alias("at"),
                F.length(F.get("_lines", at)).alias("len"),
                F.when(
                    i > 0,
                    F.aggregate(
                        F.slice("_lines", F.get("_at", i - 1) + 2, at - F.get("_at", i - 1) - 1),
                        F.lit(1),
                        lambda total, x: total + F.length(x) + 1,
                    ),
                )
                .otherwise(0)
                .alias("lead"),
            ),
        ),
    )
    long_lines = F.transform(
        F.filter(
            "_filled",
            lambda x: (x["len"] > 2 * long_line)
            & F.get("_lines", x["at"]).rlike(rf"^\s*+(?:\S++\s++){{{long_line}}}\S"),
        ),
        lambda x: _bounds(x["at"], x["at"] + 1),
    )

    def ahead(i, most):
        return _least(F.slice("_filled", i + 1, F.lit(most)), min_lines, min_chars, False)

    def behind(i, most):
        lines = F.slice("_filled", F.greatest(i - (most - 2), F.lit(1)), F.least(i + 1, F.lit(most)))
        return _least(F.reverse(lines), min_lines, min_chars, True)

    # Nearly always the fewest lines do, so these are tried alone first.
    runs_on = F.transform("_filled", lambda x, i: F.coalesce(ahead(i, min_lines), ahead(i, most)))
    runs_up = F.transform("_filled", lambda x, i: F.coalesce(behind(i, min_lines), behind(i, most)))
    df = df.withColumn(
        "_runs", F.array_distinct(F.filter(F.concat(runs_on, runs_up, long_lines), lambda c: c.isNotNull()))
    )

    def chunk(c):
        start, end = F.shiftright(c, 32).cast("int"), c.bitwiseAND(F.lit(2**32 - 1)).cast("int")
        lines = F.slice("_lines", start + 1, end - start)
        return F.struct(
            start.alias("start"),
            end.alias("end"),
            F.xxhash64(F.slice("_hashes", start + 1, end - start)).alias("h"),
            F.aggregate(lines, F.lit(-1), lambda total, x: total + F.length(x) + 1).alias("n_chars"),
        )

    return df.select("doc_id", "place", F.inline(F.transform("_runs", chunk)))


def repeated(docs: DataFrame, **cutting) -> DataFrame:
    """(doc_id, place, start, end) of the lines to remove: of chunks equal, byte by byte,
    to an earlier chunk."""
    at = F.struct("doc_id", "place", "start", "end")
    rows = written(chunk_rows(docs, **cutting), "chunks")
    groups = (
        rows.groupBy("h", "n_chars")
        .agg(F.count("*").alias("n"), F.min(at).alias("first"), F.max(at).alias("last"))
        .where("first <> last")
        .drop("n", "last")
    )
    found = written(rows.join(groups, ["h", "n_chars"]), "repeated")
    released(rows)
    wanted = found.groupBy("doc_id", "place").agg(
        F.collect_set(F.struct("h", "n_chars", "start", "end", "first")).alias("_chunks")
    )
    slices = (
        docs.select(F.col("doc_id").alias("_id"), "text", F.xxhash64("text").alias("place"))
        .join(wanted, "place")
        .where(F.col("_id").eqNullSafe(F.col("doc_id")))
        .withColumn("_lines", F.split("text", "\n"))
        .select("doc_id", "place", "_lines", F.inline("_chunks"))
        .select(
            "h",
            "n_chars",
            "first",
            at.alias("at"),
            F.array_join(F.slice("_lines", F.col("start") + 1, F.col("end") - F.col("start")), "\n").alias("bytes"),
        )
    )
    slices = written(slices.distinct(), "slices")
    origin = slices.where("at = first").select("h", "n_chars", F.col("bytes").alias("original")).distinct()
    out = (
        slices.where("at <> first")
        .join(origin, ["h", "n_chars"])
        .where("bytes = original")
        .select(
            "at.doc_id",
            "at.place",
            F.when(
                F.col("at.doc_id").eqNullSafe(F.col("first.doc_id")) & (F.col("at.place") == F.col("first.place")),
                F.greatest("at.start", "first.end"),
            )
            .otherwise(F.col("at.start"))
            .alias("start"),
            "at.end",
        )
        .distinct()
    )
    out = written(out, "doomed")
    released(found), released(slices)
    return out


def without_repeats(docs: DataFrame, **cutting) -> DataFrame:
    """``docs`` with ``text`` less its repeated chunks, and ``n_lines``, ``n_left`` (lines
    before and after) and ``removed``, the removed runs of lines as ``start-end``."""
    # Runs may overlap: merge them first, so that each line is looked at once.
    rows = Window.partitionBy("doc_id", "place").orderBy("start", "end")
    before = rows.rowsBetween(Window.unboundedPreceding, -1)
    doomed = (
        repeated(docs, **cutting)
        .withColumn("apart", F.coalesce(F.max("end").over(before) < F.col("start"), F.lit(True)).cast("int"))
        .withColumn("run", F.sum("apart").over(rows.rowsBetween(Window.unboundedPreceding, 0)))
        .groupBy("doc_id", "place", "run")
        .agg(F.min("start").alias("start"), F.max("end").alias("end"))
        .groupBy("doc_id", "place")
        .agg(F.sort_array(F.collect_list(F.struct("start", "end"))).alias("__cl_runs"))
    )
    doomed = doomed.withColumnsRenamed({"doc_id": "__cl_id", "place": "__cl_place"})
    joined = docs.withColumn("__cl_hash", F.xxhash64("text")).join(
        doomed, (F.col("__cl_hash") == F.col("__cl_place")) & F.col("doc_id").eqNullSafe(F.col("__cl_id")), "left"
    )
    lines = F.split("text", "\n")
    gaps = F.zip_with(
        F.concat(F.array(F.lit(0)), F.transform("__cl_runs", lambda r: r["end"])),
        F.concat(F.transform("__cl_runs", lambda r: r["start"]), F.array(F.size("__cl_lines"))),
        lambda a, b: F.slice("__cl_lines", a + 1, b - a),
    )
    kept = F.flatten(gaps)
    return (
        joined.withColumn("__cl_lines", F.when(F.col("__cl_runs").isNotNull(), lines))
        .withColumn("__cl_kept", F.when(F.col("__cl_runs").isNotNull(), kept))
        .withColumn("n_lines", F.coalesce(F.size(lines), F.lit(0)))
        .withColumn("n_left", F.when(F.col("__cl_runs").isNotNull(), F.size("__cl_kept")).otherwise(F.col("n_lines")))
        .withColumn("text", F.when(F.col("__cl_runs").isNotNull(), F.array_join("__cl_kept", "\n")).otherwise(F.col("text")))
        .withColumn(
            "removed",
            F.coalesce(
                F.array_join(
                    F.transform(
                        "__cl_runs", lambda r: F.concat_ws("-", r["start"].cast("string"), r["end"].cast("string"))
                    ),
                    ",",
                ),
                F.lit(""),
            ),
        )
        .select(*[c for c in docs.columns if c not in ("n_lines", "n_left", "removed")], "n_lines", "n_left", "removed")
    )
