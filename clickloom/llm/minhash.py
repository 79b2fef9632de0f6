"""Near duplicates by MinHash with tensored banding.

``collections`` small collections of ``rows`` minhashes each are computed; a table key
joins two of them.  So 18 collections of 4 give 153 tables of 8 minhashes from 72
minhashes instead of 1,224.  A pair of similarity 0.8 misses all tables with probability
1e-3, one of 0.85 with 4e-5.  Texts that share a passage only, of similarity 0.3, meet
in one pair of a hundred.

Texts with equal shingle sets form one class, and only classes are compared.  A
collection value that no other class has is dropped before keys are formed.  In a table
bucket, the first round compares the smallest class with the others; verified links are
joined into components, here and after every round, so a bucket of thousands of near copies
costs one comparison each.  Later rounds go by the collection values: a near copy has up to
18 of them, but up to 153 buckets, and two classes share a bucket if they share two values.
The shingles that only one of the classes left has are counted; with the parity of the sets
in 512 hash groups they bound what two sets can have in common, and most pairs of one family
fall away unread.  The classes of a value, if ``small`` or fewer, are then compared with each
other where their components differ; of more, some outside the largest component are
pivots and compared with all others in each round, until no value has two components with
an untested pair: every pair that shares a bucket is in one component, or cannot be similar enough by its
sets' sizes, parities and unshared shingles, or was compared on its full sets of words.  No group
meets in one task, and nothing is collected.

Texts without words, and null texts, are linked with nothing.  Rows with equal text are
in one component whatever their ids; a null ``doc_id`` is never a component's id unless
all are null.  Repeated rows are kept or dropped together.  An empty table gives an
empty table.  Other columns are not read.
"""

from __future__ import annotations

import hashlib

import numpy as np
from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf

from clickloom.llm.common import (
    WordHashes,
    bitmap_of_longs,
    bits_set,
    by_batch,
    mixed,
    released,
    shingle_hashes,
    written,
)

COLLECTIONS, ROWS, SHINGLE = 18, 4, 5
PARITY = 512


def _words(text: str | None) -> list[bytes]:
    # bytes.lower() and bytes.split() know ASCII only, as the definition asks.
    return text.encode().lower().split() if text else []


def shingles(text: str | None, size: int = SHINGLE) -> frozenset[tuple[bytes, ...]]:
    words = _words(text)
    if not words:
        return frozenset()
    if len(words) <= size:
        return frozenset([tuple(words)])
    return frozenset(zip(*(words[i:] for i in range(size))))


def signatures(docs: DataFrame, collections: int = COLLECTIONS, rows: int = ROWS, size: int = SHINGLE) -> DataFrame:
    """(doc_id, place, n_shingles, class, u, parity): the shingle set's size and fingerprint,
    the value of each collection, and a bit for each of ``PARITY`` hash groups that tells
    whether it has an odd number of shingles."""
    seeds = np.random.default_rng(collections * 1000 + rows)
    factor = seeds.integers(1, 2**63, collections * rows, np.uint64) * np.uint64(2) + np.uint64(1)
    shift = seeds.integers(0, 2**63, collections * rows, np.uint64)

    def run(batches):
        hashes = WordHashes()
        for b in batches:
            out = {"n_shingles": [], "class": [], "u": [], "parity": []}
            for text in b["text"]:
                h = np.unique(shingle_hashes(hashes.of(_words(text)), size))
                out["n_shingles"].append(len(h))
                odd = np.bincount((h % np.uint64(PARITY)).astype(np.int64), minlength=PARITY) & 1
                out["parity"].append(np.packbits(odd.astype(np.uint8)).view(np.int64))
                if len(h) == 0:
                    out["class"].append(None)
                    out["u"].append([])
                    continue
                out["class"].append(hashlib.blake2b(h.tobytes(), digest_size=16).digest())
                least = np.array([(h * f + s).min() for f, s in zip(factor, shift)])
                u = least.reshape(collections, rows)
                mix = np.arange(1, collections + 1, dtype=np.uint64)
                for k in range(rows):
                    mix = mixed(mix * np.uint64(0x2545F4914F6CDD1D) + u[:, k])
                out["u"].append(mix.view(np.int64))
            yield {"doc_id": b["doc_id"], "place": b["place"], **out}

    return by_batch(
        docs.select("doc_id", "text", F.xxhash64("text").alias("place")),
        "doc_id long, place long, n_shingles long, class binary, u array<long>, parity array<long>",
        run,
    )


def collisions(classes: DataFrame) -> DataFrame:
    """(class, n_shingles, u): the values of collections, as sorted hashes, that a second class
    has; of classes with two or more, without which there is no table key."""
    u = classes.select("class", "n_shingles", F.posexplode("u").alias("i", "value"))
    u = u.select("class", "n_shingles", F.xxhash64("i", "value").alias("value"))
    shared = u.groupBy("value").agg(F.count("*").alias("n")).where("n > 1").select("value")
    return (
        u.join(shared, "value")
        .groupBy("class", "n_shingles")
        .agg(F.sort_array(F.collect_list("value")).alias("u"))
        .where(F.size("u") > 1)
    )


def collision_rows(classes: DataFrame) -> DataFrame:
    """(value, class) of the collection values that two of ``classes`` (class, u) have.  Of
    values with the same classes one stays."""
    rows = classes.select("class", F.explode("u").alias("value"))
    held = (
        rows.groupBy("value")
        .agg(
            F.count("*").alias("n"),
            F.bit_xor(F.xxhash64("class")).alias("x"),
            F.bit_xor(F.xxhash64("class", F.lit(1))).alias("y"),
        )
        .where("n > 1")
        .groupBy("n", "x", "y")
        .agg(F.min("value").alias("value"))
        .select("value")
    )
    return rows.join(held, "value")


def buckets(classes: DataFrame) -> DataFrame:
    """(bucket, class, n_shingles, a, size_a) of the table buckets with two classes or more,
    from ``collisions``; ``a`` is the smallest class of the bucket.  Of buckets with the same
    classes, as near copies have in most tables, one stays."""
    pairs = F.flatten(
        F.transform(
            "u", lambda x, i: F.transform(F.slice("u", i + 2, F.size("u")), lambda y: F.xxhash64(x, y))
        )
    )
    keyed = written(classes.select("class", "n_shingles", F.explode(pairs).alias("bucket")), "keys")
    held = (
        keyed.groupBy("bucket")
        .agg(
            F.count("*").alias("n"),
            F.bit_xor(F.xxhash64("class")).alias("x"),
            F.bit_xor(F.xxhash64("class", F.lit(1))).alias("y"),
            F.min("class").alias("a"),
            F.min_by("n_shingles", "class").alias("size_a"),
        )
        .where("n > 1")
        .groupBy("n", "x", "y")
        .agg(F.min("bucket").alias("one"), F.min_by("a", "bucket").alias("a"), F.min_by("size_a", "bucket").alias("size_a"))
        .select(F.col("one").alias("bucket"), "a", "size_a")
    )
    out = written(keyed.join(held, "bucket"), "buckets")
    released(keyed)
    return out


def texts_of(docs: DataFrame, classes: DataFrame, size: int = SHINGLE) -> DataFrame:
    """(class, text) for ``classes`` (class, doc_id, place), found again in ``docs``.  A
    bitmap of fixed size leaves most other texts out before the join."""
    bits = 24
    marks = docs.sparkSession.sparkContext.broadcast(bitmap_of_longs(classes, "place", bits))

    @pandas_udf("boolean")
    def wanted(place):
        import pandas as pd

        return pd.Series(bits_set(marks.value, place.to_numpy() & ((1 << bits) - 1)))

    near = docs.select(F.col("doc_id").alias("_id"), "text", F.xxhash64("text").alias("place"))
    return (
        near.where("text is not null")
        .where(wanted("place"))
        .join(classes, "place")
        .where(F.col("_id").eqNullSafe(F.col("doc_id")))
        .groupBy("class")
        .agg(F.first("text").alias("text"))
    )


def linked(pairs: DataFrame, texts: DataFrame, percent: int, size: int = SHINGLE) -> DataFrame:
    """The ``pairs`` (a, b) of classes whose full sets of word runs are similar enough."""

    def run(batches):
        last, one = None, frozenset()
        for b in batches:
            out = {"a": [], "b": []}
            for a, c, text_a, text_b in zip(b["a"], b["b"], b["text_a"], b["text_b"]):
                if a != last:
                    last, one = a, shingles(text_a, size)
                two = shingles(text_b, size)
                both = len(one & two)
                if both and 100 * both >= percent * (len(one) + len(two) - both):
                    out["a"].append(a)
                    out["b"].append(c)
            yield out

    with_b = pairs.join(texts.withColumnsRenamed({"class": "b", "text": "text_b"}), "b")
    with_a = with_b.join(texts.withColumnsRenamed({"class": "a", "text": "text_a"}), "a")
    return by_batch(with_a.select("a", "b", "text_a", "text_b"), "a long, b long", run)


def components(edges: DataFrame) -> DataFrame:
    """(node, label) with the smallest node that can be reached; ``edges`` are (a, b).

    A label that an edge joins to a smaller one gives way to it at all of its nodes at once, so
    that a round joins whole groups; labels do not wander edge by edge.  When nothing changes,
    both ends of each edge have one label."""
    edges = written(edges.select("a", "b"), "edges")
    ends = edges.select(F.explode(F.array("a", "b")).alias("node"), F.least("a", "b").alias("label"))
    label = written(ends.groupBy("node").agg(F.min("label").alias("label")), "label")
    while True:
        x = label.select(F.col("node").alias("a"), F.col("label").alias("x"))
        y = label.select(F.col("node").alias("b"), F.col("label").alias("y"))
        low = (
            edges.join(x, "a")
            .join(y, "b")
            .where("x <> y")
            .groupBy(F.greatest("x", "y").alias("node"))
            .agg(F.min(F.least("x", "y")).alias("low"))
        )
        # Labels are nodes and have a label of their own.
        top = label.join(low, "node", "left").select(F.col("node").alias("label"), F.least("label", "low").alias("top"))
        seen = Observation()
        now = label.join(top, "label").observe(seen, F.count_if(F.col("label") != F.col("top")).alias("changed"))
        now = written(now.select("node", F.col("top").alias("label")), "label")
        released(label)
        label = now
        if not seen.get["changed"]:
            released(edges)
            return label


def shared_counts(classes: DataFrame, texts: DataFrame, size: int = SHINGLE) -> DataFrame:
    """(class, n_alone): how many of a class's shingles no other of ``classes`` has; classes
    without any are left out.  Equal hashes of different shingles can only lower it."""

    def run(batches):
        hashes = WordHashes()
        for b in batches:
            sets = [np.unique(shingle_hashes(hashes.of(_words(text)), size)).view(np.int64) for text in b["text"]]
            yield {"class": b["class"], "shingles": sets}

    sets = by_batch(
        texts.join(classes.select("class").distinct(), "class", "left_semi").select("class", "text"),
        "class long, shingles array<long>",
        run,
    )
    # Of a single row, the exclusive or is the row's own value.
    return (
        sets.select("class", F.explode("shingles").alias("shingle"))
        .groupBy("shingle")
        .agg(F.count("*").alias("n"), F.bit_xor("class").alias("class"))
        .where("n = 1")
        .groupBy("class")
        .agg(F.count("*").alias("n_alone"))
    )


def merged(labels: DataFrame, links: DataFrame) -> DataFrame:
    """``labels`` (class, label, …) with the labels that ``links`` (a, b) connect made one."""
    a = labels.select(F.col("class").alias("a"), F.col("label").alias("x"))
    b = labels.select(F.col("class").alias("b"), F.col("label").alias("y"))
    ends = links.join(a, "a").join(b, "b").where("x <> y")
    joined = components(ends.select(F.col("x").alias("a"), F.col("y").alias("b")))
    low = joined.select(F.col("node").alias("label"), F.col("label").alias("low"))
    return written(
        labels.join(low, "label", "left").withColumn("label", F.coalesce("low", "label")).select(labels.columns),
        "labels",
    )


def open_rows(active: DataFrame, labels: DataFrame) -> DataFrame:
    """``active`` (value, class) with ``labels``, the number ``n`` of classes of the value and
    the label ``major`` that most of them have, of values with classes of two labels or more."""
    marked = active.join(labels, "class")
    state = (
        marked.groupBy("value", "label")
        .agg(F.count("*").alias("n"))
        .groupBy("value")
        .agg(
            F.sum("n").alias("n"),
            F.count("*").alias("n_labels"),
            F.max_by("label", "n").alias("major"),
        )
        .where("n_labels > 1")
        .select("value", "n", "major")
    )
    return written(marked.join(state, "value"), "rest")


def class_labels(docs: DataFrame, classes: DataFrame, percent: int, size: int = SHINGLE, small: int = 256) -> DataFrame:
    """(class, label) of the classes that share a bucket with another."""
    collided = written(collisions(classes), "collisions")
    met = buckets(collided)
    # All that is known of a class that shares a bucket; dealt out by class once.
    members = written(
        classes.select("class", "n_shingles", "parity", "doc_id", "place")
        .join(collided.select("class", "u"), "class")
        .join(met.select("class").distinct(), "class", "left_semi"),
        "members",
    )
    released(collided)
    texts = written(texts_of(docs, members.select("class", "doc_id", "place"), size), "texts")
    # First every bucket compares its smallest class with the others.  Sets of sizes too far
    # apart cannot be similar enough.
    others = met.where("a <> class")
    alike = f"least(n_shingles, size_a) * 100 >= greatest(n_shingles, size_a) * {percent}"
    tested = written(others.where(alike).select("a", F.col("class").alias("b")).distinct(), "pairs")
    released(met)
    links = written(linked(tested, texts, percent, size), "links")
    # Each class is its own label so far, so that the links are between labels.
    first = components(links).select(F.col("node").alias("class"), "label")
    labels = members.select("class", "n_shingles").join(first, "class", "left")
    labels = written(labels.select("class", F.coalesce("label", "class").alias("label"), "n_shingles"), "labels")
    # From here on a class has a row for each of its collection values, not for each bucket:
    # two classes share a bucket if they share two values.
    active = written(collision_rows(members.select("class", "u")), "active")
    rest = open_rows(active, labels)
    # What is left has met in a bucket, but is seldom similar enough.  Two sets have no more in
    # common than either has of shingles that occur in a second class of the rest, and each
    # hash group of other parity holds a shingle that only one of them has.
    alone = shared_counts(rest, texts, size)
    labels = written(
        labels.join(alone, "class", "left")
        .select(
            "class", "label", "n_shingles", (F.col("n_shingles") - F.coalesce("n_alone", F.lit(0))).alias("n_shared")
        )
        .join(members.select("class", "parity", "u"), "class"),
        "labels",
    )
    hopeful = f"n_shared * 100 >= n_shingles * {percent}"
    active = rest.select("value", "class")
    most = "least(n_shared, shared_a)"
    apart = " + ".join(f"bit_count(get(parity, {i}) ^ get(parity_a, {i}))" for i in range(PARITY // 64))
    alike = (
        f"{most} * 100 >= (n_shingles + size_a - {most}) * {percent}"
        f" and (n_shingles + size_a - ({apart})) * 100 >= (n_shingles + size_a + ({apart})) * {percent}"
        " and size(array_intersect(u, u_a)) > 1"
    )
    named_a = {
        "class": "a",
        "label": "label_a",
        "n_shingles": "size_a",
        "n_shared": "shared_a",
        "parity": "parity_a",
        "u": "u_a",
    }
    step = 1
    while True:
        rest = open_rows(active, labels.where(hopeful))
        if rest.isEmpty():
            released(rest), released(texts), released(members)
            return labels.select("class", "label")
        few, many = rest.where(F.col("n") <= small), rest.where(F.col("n") > small)
        # Two classes of different labels are not both of the label that most have, so only
        # the others need be pivots.
        part = F.pmod(F.xxhash64("class"), F.lit(64 ** min(step, 3)))
        pivots = written(
            many.where("label <> major").groupBy("value", part.alias("part")).agg(F.min("class").alias("a")), "pivots"
        )
        first = pivots.join(labels.withColumnsRenamed(named_a), "a")
        from_pivots = (
            many.join(first, "value")
            .where("label <> label_a")
            .where(alike)
            .select(F.least("a", "class").alias("a"), F.greatest("a", "class").alias("b"))
        )
        other = few.withColumnsRenamed(named_a).select("value", *named_a.values())
        among = few.join(other, "value").where("a < class and label <> label_a").where(alike)
        among = among.select("a", F.col("class").alias("b"))
        pairs = from_pivots.union(among).distinct().join(tested, ["a", "b"], "left_anti")
        pairs = written(pairs, "pairs")
        links = written(linked(pairs, texts, percent, size), "links")
        tested = tested.union(pairs)
        if not links.isEmpty():
            labels = merged(labels, links)
        # What was a pivot has met all others of its value.
        active = written(
            many.join(pivots.withColumnRenamed("a", "class"), ["value", "class"], "left_anti").select("value", "class"),
            "active",
        )
        released(rest), released(pivots)
        step += 1


def near_duplicates(
    docs: DataFrame, percent: int = 80, collections: int = COLLECTIONS, rows: int = ROWS, size: int = SHINGLE
) -> DataFrame:
    """(doc_id, place, n_shingles, component_id, kept) of each row; ``place`` is the
    64-bit hash of the text."""
    signed = written(signatures(docs, collections, rows, size), "signed")
    # From here on a class goes by a number, fixed as it is written: half as wide as the
    # fingerprint, and its least is found by hashing, without a sort.
    classes = written(
        signed.where("n_shingles > 0")
        .groupBy("class")
        .agg(
            F.min(F.struct("doc_id", "place")).alias("first"),
            F.min("doc_id").alias("least"),
            F.first("u").alias("u"),
            F.first("parity").alias("parity"),
            F.first("n_shingles").alias("n_shingles"),
        )
        .select(F.col("class").alias("name"), F.monotonically_increasing_id().alias("class"), "n_shingles", "parity", F.col("first.doc_id").alias("doc_id"), F.col("first.place").alias("place"), "least", "u"),
        "classes",
    )
    labels = class_labels(docs, classes, percent, size)
    named = classes.select("name", "class", "least").join(labels, "class", "left")
    named = named.withColumn("label", F.coalesce("label", "class"))
    low = named.groupBy("label").agg(F.min("least").alias("component_id"))
    per_class = written(named.join(low, "label").select(F.col("name").alias("class"), "component_id"), "components")
    out = signed.join(per_class, "class", "left").select(
        "doc_id", "place", "n_shingles", F.coalesce("component_id", "doc_id").alias("component_id")
    )
    return out.withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id")))


def one_of_each(docs: DataFrame, percent: int = 80) -> DataFrame:
    """``docs`` with one document of each group of near duplicates."""
    gone = (
        near_duplicates(docs, percent)
        .where("not kept")
        .select(F.col("doc_id").alias("__cl_id"), F.col("place").alias("__cl_place"))
        .distinct()
    )
    return (
        docs.withColumn("__cl_at", F.xxhash64("text"))
        .join(gone, (F.col("__cl_at") == F.col("__cl_place")) & F.col("doc_id").eqNullSafe(F.col("__cl_id")), "left_anti")
        .select(docs.columns)
    )
