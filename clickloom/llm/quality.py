"""Document rules, and lines that a host repeats over its documents.

A line is normalised (lower case, white space runs to one blank) and hashed.  For each
host the different texts with the line are counted; copies of one text count once.  A
line found in more than ``min_documents`` texts of a host is removed from all documents
of that host, however many it has.  A document left with less than ``least_left`` of its
words is depleted and rejected.

Hosts and lines may be as common as they like: counts are combined before they are
shuffled, and the repeated lines are joined under ``SALTS`` salts.

Null and empty texts have no words and fail the base rules.  A null host counts as the
empty one.  Repeated rows are judged alike and counted once.  An empty table gives an empty
table.  Other columns are not read.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clickloom.llm.common import by_batch, mixed, written

SALTS = 16
SYMBOLS = "#*$%&|<>"


def repeated_words(words: list[bytes], size: int = 8) -> int:
    """Words in runs of ``size`` words that the text has twice or more."""
    n = len(words) - size + 1
    if n < 2:
        return 0
    ids: dict[bytes, int] = {}
    w = mixed(np.fromiter((ids.setdefault(x, len(ids)) for x in words), np.uint64, len(words)) + np.uint64(1))
    h = np.zeros(n, np.uint64)
    for i in range(size):
        h = mixed(h * np.uint64(0xFF51AFD7ED558CCD) + w[i : i + n])
    _, where, count = np.unique(h, return_inverse=True, return_counts=True)
    twice = (count > 1)[where]
    if not twice.any():
        return 0
    edge = np.zeros(len(words) + 1, np.int64)
    at = np.flatnonzero(twice)
    np.add.at(edge, at, 1)
    np.add.at(edge, at + size, -1)
    return int((np.cumsum(edge)[:-1] > 0).sum())


def _lines(text: str) -> tuple[int, dict[str, int]]:
    """Lines with a word equal to an earlier line; words of each normalised line."""
    seen, again, words = set(), 0, {}
    for line in text.split("\n"):
        parts = line.encode().split()
        if parts:
            again += line in seen
            seen.add(line)
            key = b" ".join(parts).decode().lower()
            words[key] = words.get(key, 0) + len(parts)
    return again, words


def measure(docs: DataFrame) -> DataFrame:
    """The base measures of each row, and its lines as hash and number of words."""

    def run(batches):
        import xxhash

        for b in batches:
            out = {k: [] for k in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "lines")}
            for text in b["text"]:
                text = text or ""
                raw = text.encode()
                words = raw.split()
                again, lines = _lines(text)
                out["n_words"].append(len(words))
                joined = b"".join(words)
                out["word_chars"].append(len(joined.decode()))
                out["n_symbols"].append(len(raw) - len(raw.translate(None, SYMBOLS.encode())))
                out["n_dup_lines"].append(again)
                out["n_repeat_words"].append(repeated_words(words))
                out["lines"].append(
                    [
                        {"line": xxhash.xxh3_64_intdigest(k.encode()) - (1 << 63), "words": n}
                        for k, n in lines.items()
                    ]
                )
            yield {"doc_id": b["doc_id"], "host": b["host"], "text_hash": b["text_hash"], **out}

    return by_batch(
        docs.select(
            "doc_id", F.coalesce("source", F.lit("")).alias("host"), "text", F.xxhash64("text").alias("text_hash")
        ),
        "doc_id long, host string, text_hash long, n_words long, word_chars long, n_symbols long, "
        "n_dup_lines long, n_repeat_words long, lines array<struct<line:long, words:long>>",
        run,
    )


def judge(docs: DataFrame, min_documents: int = 10, least_left: float = 0.5) -> DataFrame:
    """The base measures, ``base_failed``, ``removed_words`` and ``kept`` of each row."""
    rows = written(measure(docs).withColumn("row", F.monotonically_increasing_id()), "measured")
    # One row for each line of each different text of a host.
    texts = rows.groupBy("host", "text_hash").agg(F.first("lines").alias("lines"))
    common = (
        texts.select("host", F.inline("lines"))
        .groupBy("host", "line")
        .agg(F.count("*").alias("n"))
        .where(F.col("n") > min_documents)
        .select("host", "line", F.explode(F.expr(f"sequence(0, {SALTS - 1})")).alias("salt"))
    )
    common = written(common, "common")
    lost = (
        rows.select("row", "host", F.pmod("row", F.lit(SALTS)).cast("int").alias("salt"), F.inline("lines"))
        .join(common, ["host", "line", "salt"])
        .groupBy("row")
        .agg(F.sum("words").alias("removed_words"))
    )
    n, left = F.col("n_words"), F.col("n_words") - F.col("removed_words")
    failed = (n < 20) | (100 * F.col("n_repeat_words") > 30 * n)
    return (
        rows.drop("lines")
        .join(lost, "row", "left")
        .withColumn("removed_words", F.coalesce("removed_words", F.lit(0)))
        .withColumn("base_failed", failed)
        .withColumn("kept", ~failed & (left >= F.lit(least_left) * n))
    )
