"""Benchmark passages in documents: SimHash of windows, a multi-index, an exact check.

Words are lower-cased (ASCII) and freed from ASCII punctuation.  For each item of n words
the windows of n words of all documents are looked at.  A window and an item match when
their five-word shingles, weighted by how often they occur, have a similarity (sum of
minima over sum of maxima) of at least ``threshold``.

A window can only match if enough of its shingles are shingles of items of its size.  Two
bitmaps of fixed size tell, without false negatives, which are; windows below the
threshold go no further.  The others and the items get a SimHash of 64 bits of their
shingles (of a shingle that occurs again, the repeats count as others).  Lists with a
similarity of 0.8 have a cosine of 0.889 at least, so each bit differs with probability
0.15 at most, and more than ``RADIUS`` bits with 4e-4.  A multi-index finds all fingerprints
within the radius: of the blocks of bits at least one differs in ``FLIPS`` bits or
fewer, so each item is entered under all such values of each block, and a window is looked
up under its own.  A pair within the radius is a row once, in its first such block.  Other
thresholds than 0.8 have other miss rates.  Equal windows are checked once, on their full
shingles.

Items of fewer than five words cannot be told from ordinary prose and are ignored, as are
null and empty texts and items.  A document shorter than an item is one window.  Repeated
rows and repeated items each give their matches once for each different (doc_id, text)
and item_id.  Empty tables give no matches.  Other columns are not read.
"""

from __future__ import annotations

from collections import Counter
from itertools import combinations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clickloom.llm.common import (
    WordHashes,
    bitmap_of_longs,
    bits_set,
    by_batch,
    mixed,
    shingle_hashes,
    written,
)

SHINGLE = 5
_SLOTS = 22
#: (first bit, bits) of the blocks; with three flips for each, all within 5 * 4 - 1 are found.
BLOCKS = ((0, 13), (13, 13), (26, 13), (39, 13), (52, 12))
FLIPS = 3
RADIUS = len(BLOCKS) * (FLIPS + 1) - 1
_ROWS = 4096
_PLAIN = bytes(
    b + 32 if 65 <= b <= 90 else b if b >= 128 or chr(b).isalnum() else 32 for b in range(256)
)


def words_of(text: str | None) -> list[bytes]:
    return text.encode().translate(_PLAIN).split() if text else []


def similarity(one: list, two: list) -> float:
    """Weighted similarity of the shingles of two lists of words."""
    a, b = (Counter(zip(*(w[i:] for i in range(SHINGLE)))) for w in (one, two))
    least = sum((a & b).values())
    return least / (sum(a.values()) + sum(b.values()) - least) if least else 0.0


def needed(size: int, threshold: float) -> int:
    """Shingles that a window must share with an item of ``size`` words at least."""
    return int(np.ceil(threshold * (size - SHINGLE + 1) - 1e-9))


def _sized(hashes: np.ndarray, size: int) -> np.ndarray:
    return mixed(hashes + np.uint64(size * 0x9E3779B97F4A7C15 & (1 << 64) - 1))


def fingerprint(shingles: np.ndarray) -> int:
    """The SimHash of a list of shingle hashes: each bit as most of them have it."""
    s = np.sort(shingles)
    again = (np.arange(len(s)) - np.searchsorted(s, s)).astype(np.uint64)
    each = mixed(s + again * np.uint64(0x9E3779B97F4A7C15))
    ones = np.zeros(64, np.int64)
    for at in range(0, len(each), 1 << 16):
        ones += np.unpackbits(each[at : at + (1 << 16)].view(np.uint8).reshape(-1, 8), axis=1).sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > len(each)).view(np.int64)[0])


def _blocks(value: Column) -> list[Column]:
    return [F.shiftrightunsigned(value, at).bitwiseAND(F.lit((1 << n) - 1)) for at, n in BLOCKS]


def flipped(bits: int) -> list[int]:
    """All masks of ``bits`` bits with ``FLIPS`` ones at most."""
    return [sum(1 << i for i in at) for k in range(FLIPS + 1) for at in combinations(range(bits), k)]


def item_table(items: DataFrame) -> DataFrame:
    """(item_id, size, words, shingles, sized) of the items that count."""

    def run(batches):
        hashes = WordHashes()
        for b in batches:
            out = {k: [] for k in ("item_id", "size", "words", "shingles", "sized")}
            for item_id, text in zip(b["item_id"], b["text"]):
                words = words_of(text)
                if len(words) < SHINGLE:
                    continue
                w = hashes.of(words)
                s = shingle_hashes(w, SHINGLE)
                out["item_id"].append(item_id)
                out["size"].append(len(words))
                out["words"].append(b" ".join(words).decode())
                out["shingles"].append(s.view(np.int64))
                out["sized"].append(_sized(s, len(words)).view(np.int64))
            yield out

    return by_batch(
        items.select(F.col("item_id").cast("long").alias("item_id"), "text"),
        "item_id long, size int, words string, shingles array<long>, sized array<long>",
        run,
    ).distinct()


def windows(docs: DataFrame, sizes: list[int], any_item: bytes, by_size: bytes, threshold: float) -> DataFrame:
    """(doc_id, place, size, start, end, words) of the windows that may match."""
    shared = docs.sparkSession.sparkContext.broadcast((sizes, any_item, by_size))

    def run(batches):
        sizes, any_item, by_size = shared.value
        hashes, slots = WordHashes(), np.uint64((1 << _SLOTS) - 1)
        fewest = min((needed(n, threshold) for n in sizes), default=0)
        for b in batches:
            out = {k: [] for k in ("doc_id", "place", "size", "start", "end", "words")}
            for doc_id, place, text in zip(b["doc_id"], b["place"], b["text"]):
                words = words_of(text)
                if len(words) < SHINGLE or not sizes:
                    continue
                w = hashes.of(words)
                s = shingle_hashes(w, SHINGLE)
                hits = np.flatnonzero(bits_set(any_item, s & slots))
                if len(hits) < fewest:
                    continue
                for size in sizes:
                    own = hits[bits_set(by_size, _sized(s[hits], size) & slots)]
                    least = needed(size, threshold)
                    if len(own) < least:
                        continue
                    if len(words) < size:
                        starts = np.array([0])
                    else:
                        # Each run of `least` hits within a window allows some starts.
                        first, last = own[: len(own) - least + 1], own[least - 1 :]
                        near = last - first <= size - SHINGLE
                        low = np.maximum(last[near] - (size - SHINGLE), 0)
                        high = np.minimum(first[near], len(words) - size)
                        edge = np.zeros(len(words) + 1, np.int32)
                        ok = low <= high
                        np.add.at(edge, low[ok], 1)
                        np.add.at(edge, high[ok] + 1, -1)
                        starts = np.flatnonzero(np.cumsum(edge) > 0)
                    if not len(starts):
                        continue
                    for start in starts.tolist():
                        end = min(start + size, len(words))
                        out["doc_id"].append(doc_id)
                        out["place"].append(place)
                        out["size"].append(size)
                        out["start"].append(start)
                        out["end"].append(end)
                        out["words"].append(b" ".join(words[start:end]).decode())
                        if len(out["words"]) == _ROWS:
                            yield out
                            out = {k: [] for k in out}
            yield out

    return by_batch(
        docs.select("doc_id", F.xxhash64("text").alias("place"), "text"),
        "doc_id long, place long, size int, start int, end int, words string",
        run,
    )


def _fingerprints(df: DataFrame, name: str) -> DataFrame:
    """(size, ``name``, fp): the fingerprint of the words of each row."""

    def run(batches):
        hashes = WordHashes()
        for b in batches:
            fps = [
                fingerprint(shingle_hashes(hashes.of(words.encode().split(b" ")), SHINGLE)) for words in b["words"]
            ]
            yield {"size": b["size"], name: b[name], "fp": fps}

    return by_batch(df.select("size", name, "words"), f"size int, {name} long, fp long", run)


def within_radius(windows: DataFrame, items: DataFrame) -> DataFrame:
    """(size, window_key, item_key) of all pairs of one size whose fingerprints differ in
    ``RADIUS`` bits or fewer, each once; ``windows`` are (size, window_key, fp) and
    ``items`` (size, item_key, fp)."""

    def entries(values):
        return F.array(*[F.struct(F.lit(k).alias("block"), v.cast("int").alias("value")) for k, v in enumerate(values)])

    own = windows.select("size", "window_key", "fp", F.inline(entries(_blocks(F.col("fp")))))
    masks = {n: F.lit(np.array(flipped(n), np.int32)) for _, n in BLOCKS}
    probes = items.withColumnRenamed("fp", "fp_item").select(
        "size", "item_key", "fp_item", F.inline(entries(_blocks(F.col("fp_item"))))
    )
    probes = probes.select(
        "size",
        "item_key",
        "fp_item",
        "block",
        F.explode(
            F.transform(
                F.when(F.col("block") < len(BLOCKS) - 1, masks[BLOCKS[0][1]]).otherwise(masks[BLOCKS[-1][1]]),
                lambda m: F.col("value").bitwiseXOR(m),
            )
        ).alias("value"),
    )
    apart = F.col("fp").bitwiseXOR(F.col("fp_item"))
    first = F.lit(True)
    for k, near in enumerate(_blocks(apart)[:-1]):
        first = first & ((F.col("block") <= k) | (F.bit_count(near) > FLIPS))
    return (
        own.join(probes, ["size", "block", "value"])
        .where((F.bit_count(apart) <= RADIUS) & first)
        .select("size", "window_key", "item_key")
    )


def matches(docs: DataFrame, items: DataFrame, threshold: float = 0.8) -> DataFrame:
    """(doc_id, place, item_id, start, end, similarity): the best window, in words, of
    each pair of a document and an item that match."""
    table = written(item_table(items).withColumn("item_key", F.xxhash64("words")), "items")
    any_item = bitmap_of_longs(table.select(F.explode("shingles").alias("s")), "s", _SLOTS)
    by_size = bitmap_of_longs(table.select(F.explode("sized").alias("s")), "s", _SLOTS)
    sizes = sorted(r.size for r in table.select("size").distinct().collect())
    found = written(windows(docs, sizes, any_item, by_size, threshold), "windows")
    different = found.select("size", "words").distinct().withColumn("window_key", F.xxhash64("words"))
    of_items = table.select("size", "item_key", "words").distinct()
    near = (
        within_radius(_fingerprints(different, "window_key"), _fingerprints(of_items, "item_key"))
        .join(different, ["size", "window_key"])
        .join(of_items.withColumnRenamed("words", "item"), ["size", "item_key"])
        .select("size", "words", "item")
    )

    def run(batches):
        for b in batches:
            out = {"size": [], "words": [], "item": [], "similarity": []}
            for size, words, item in zip(b["size"], b["words"], b["item"]):
                got = similarity(words.split(" "), item.split(" "))
                if got >= threshold:
                    for k, v in zip(out, (size, words, item, got)):
                        out[k].append(v)
            yield out

    sure = written(by_batch(near, "size int, words string, item string, similarity double", run), "verified")
    named = sure.join(table.select("size", F.col("words").alias("item"), "item_id").distinct(), ["size", "item"])
    return (
        found.join(named, ["size", "words"])
        .groupBy("doc_id", "place", "item_id")
        .agg(F.max(F.struct("similarity", (-F.col("start")).alias("back"), "end")).alias("best"))
        .select(
            "doc_id",
            "place",
            "item_id",
            (-F.col("best.back")).alias("start"),
            F.col("best.end").alias("end"),
            F.col("best.similarity").alias("similarity"),
        )
    )


def without_leaks(docs: DataFrame, items: DataFrame, threshold: float = 0.8) -> DataFrame:
    """``docs`` without the documents that match an item."""
    leaks = matches(docs, items, threshold).select(F.col("doc_id").alias("__cl_id"), F.col("place").alias("__cl_place")).distinct()
    return (
        docs.withColumn("__cl_at", F.xxhash64("text"))
        .join(leaks, (F.col("__cl_at") == F.col("__cl_place")) & F.col("doc_id").eqNullSafe(F.col("__cl_id")), "left_anti")
        .select(docs.columns)
    )
