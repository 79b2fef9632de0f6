"""Language by the nearest of several centroids for each language.

A text is lower-cased, all but its letters become blanks, and its byte trigrams are
hashed to ``DIMENSIONS`` counts.  Counts are damped by a square root, weighted by inverse
document frequency over all training rows and brought to length 1.  In training, the vectors
of each language are clustered by cosine into up to ``clusters`` centroids, each of which
has ``least_share`` of the language's sample or more.  A text gets the language of
the centroid with the largest cosine, which is its score.  It is rejected when it is
farther from that centroid than texts of the language are: below ``slack`` times the
cosine that 99 % of the centroid's own training texts reach.

Centroids come from a sample of at most ``sample`` labelled rows, the same number for each
language, chosen by a hash of the text; prediction reads all rows and whole texts and
knows nothing but the text.

Null texts and texts without a letter are ``und`` with score 0, and rejected; so is
everything when no labelled row exists.  Of equal cosines the first language by name
wins.  Repeated rows get equal results.  An empty table gives an empty table.  Other
columns are not read.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from clickloom.llm.common import by_batch

DIMENSIONS = 4096
UNKNOWN = "und"
_LETTER = regex.compile(r"\p{L}")
_BLANKS = bytes(b if b >= 128 or chr(b).isalpha() else 32 for b in range(256))


def held_out() -> Column:
    """Whether a row is kept from training: a quarter of the ids, by their checksum."""
    return F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 4 == 2, F.lit(False))


def counts(text: str) -> np.ndarray:
    """Hashed trigram counts of a whole text."""
    raw = b" " + b" ".join(text.lower().encode().translate(_BLANKS).split()) + b" "
    b = np.frombuffer(raw, np.uint8).astype(np.uint32)
    if len(b) < 3:
        return np.zeros(DIMENSIONS, np.float32)
    grams = (b[:-2] << np.uint32(16)) | (b[1:-1] << np.uint32(8)) | b[2:]
    slots = (grams * np.uint32(2654435761)) >> np.uint32(20)
    return np.bincount(slots, minlength=DIMENSIONS).astype(np.float32)


@dataclass
class Centroids:
    idf: np.ndarray
    languages: list[str]  # of each centroid
    matrix: np.ndarray  # one row for each centroid
    least: np.ndarray  # cosine below which a text is rejected

    def vectors(self, rows: np.ndarray) -> np.ndarray:
        v = np.sqrt(rows)
        v *= self.idf
        norm = np.linalg.norm(v, axis=1, keepdims=True)
        v /= np.where(norm == 0, 1, norm)
        return v

    def predict(self, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Nearest centroid of each row of counts, and its cosine."""
        cosine = self.vectors(rows) @ self.matrix.T
        best = cosine.argmax(1)
        return best, np.clip(cosine[np.arange(len(best)), best], 0, 1)


def _clusters(v: np.ndarray, k: int, least: float, rounds: int = 12) -> np.ndarray:
    """Spherical k-means from rows drawn by their distance to those drawn before.  While a
    centroid has less than the share ``least`` of the rows, the smallest one is given up and
    its rows go to the others."""
    draw = np.random.default_rng(len(v))
    c = v[draw.integers(len(v))][None]
    while len(c) < min(k, len(v)):
        far = np.maximum(1 - (v @ c.T).max(1).astype(np.float64), 0)
        if far.sum() < 1e-6:
            break
        c = np.concatenate([c, v[draw.choice(len(v), p=far / far.sum())][None]])
    while True:
        for _ in range(rounds):
            own = (v @ c.T).argmax(1)
            sums = np.array([v[own == i].sum(0) if (own == i).any() else c[i] for i in range(len(c))])
            c = sums / np.maximum(np.linalg.norm(sums, axis=1, keepdims=True), 1e-12)
        sizes = np.bincount((v @ c.T).argmax(1), minlength=len(c))
        if len(c) == 1 or sizes.min() >= least * len(v):
            return c
        c = np.delete(c, sizes.argmin(), 0)


def inverse_frequencies(labelled: DataFrame) -> np.ndarray:
    """Inverse document frequency of each slot over all rows of ``labelled`` with a letter."""

    def run(batches):
        total = np.zeros(DIMENSIONS + 1, np.int64)  # the last one counts the rows
        for b in batches:
            for text in b["text"]:
                if _LETTER.search(text):
                    total[:-1] += counts(text) > 0
                    total[-1] += 1
        yield {"slot": list(range(DIMENSIONS + 1)), "n": total.tolist()}

    sums = by_batch(labelled.select("text"), "slot int, n long", run).groupBy("slot").agg(F.sum("n").alias("n"))
    n = np.zeros(DIMENSIONS + 1)
    for r in sums.collect():
        n[r.slot] = r.n
    return (np.log((1 + n[-1]) / (1 + n[:-1])) + 1).astype(np.float32)


def fit(
    docs: DataFrame, sample: int = 1600, clusters: int = 4, slack: float = 0.5, least_share: float = 0.05
) -> Centroids | None:
    """Centroids from a bounded sample of the labelled rows that are not held out, weights
    from all of those rows."""
    labelled = docs.where(F.col("doc_id").isNotNull() & F.col("text").isNotNull() & F.col("lang").isNotNull())
    labelled = labelled.where(~held_out()).select("doc_id", "text", "lang")
    sizes = {r.lang: r.n for r in labelled.groupBy("lang").agg(F.count("*").alias("n")).orderBy("lang").limit(sample).collect()}
    if not sizes:
        return None
    place = F.xxhash64("text", "doc_id")
    rank = F.row_number().over(W.partitionBy("lang").orderBy("place", "doc_id"))
    per_language = max(1, sample // len(sizes))
    # Only so many of the lowest hashes are ranked, however many tasks or rows there are.
    top = {k: (1 << 63) - 1 if n <= 2 * per_language + 200 else int(2.0**64 * (2 * per_language + 200) / n) - (1 << 63) for k, n in sizes.items()}
    below = F.create_map(*[F.lit(x) for k, v in top.items() for x in (k, v)])
    chosen = (
        labelled.select("lang", "doc_id", place.alias("place"))
        .where(F.col("place") <= F.try_element_at(below, F.col("lang")))
        .withColumn("rank", rank)
        .where(F.col("rank") <= per_language)
        .select("doc_id", "place", F.col("lang").alias("of"))
        .distinct()
    )
    texts = labelled.withColumn("place", place).join(F.broadcast(chosen), ["doc_id", "place"])

    def run(batches):
        for b in batches:
            out = {"lang": [], "n": []}
            for lang, text in zip(b["lang"], b["text"]):
                if _LETTER.search(text):
                    out["lang"].append(lang)
                    out["n"].append(counts(text).tobytes())
            yield out

    rows = by_batch(texts.select("lang", "text"), "lang string, n binary", run).collect()
    if not rows:
        return None
    # Sorted, so that the order in which tasks end changes nothing.
    rows = sorted((r.lang, bytes(r.n)) for r in rows)
    n = np.array([np.frombuffer(x, np.float32) for _, x in rows])
    langs = np.array([x for x, _ in rows])
    model = Centroids(inverse_frequencies(labelled), [], np.zeros((0, DIMENSIONS), np.float32), np.zeros(0))
    v = model.vectors(n)
    parts, least = [], []
    for name in sorted(set(langs)):
        own = v[langs == name]
        c = _clusters(own, clusters, least_share)
        cosine = own @ c.T
        nearest = cosine.argmax(1)
        for i in range(len(c)):
            mine = cosine[nearest == i, i]
            least.append(slack * (np.quantile(mine, 0.01) if len(mine) else cosine.max(1).min()))
            model.languages.append(str(name))
        parts.append(c)
    model.matrix = np.concatenate(parts).astype(np.float32)
    model.least = np.array(least)
    return model


def predict(docs: DataFrame, model: Centroids | None) -> DataFrame:
    """(doc_id, place, held_out, lang_pred, score, rejected) of each row."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        model = shared.value
        for b in batches:
            texts = b["text"]
            lang, score, rejected = [UNKNOWN] * len(texts), [0.0] * len(texts), [True] * len(texts)
            known = [i for i, t in enumerate(texts) if model and t and _LETTER.search(t)]
            for at in range(0, len(known), 256):
                some = known[at : at + 256]
                best, cosine = model.predict(np.array([counts(texts[i]) for i in some]))
                for i, c, s in zip(some, best.tolist(), cosine.tolist()):
                    lang[i], score[i], rejected[i] = model.languages[c], s, bool(s < model.least[c])
            yield {
                "doc_id": b["doc_id"],
                "place": b["place"],
                "held_out": b["held_out"],
                "lang_pred": lang,
                "score": score,
                "rejected": rejected,
            }

    return by_batch(
        docs.select("doc_id", "text", F.xxhash64("text").alias("place"), held_out().alias("held_out")),
        "doc_id long, place long, held_out boolean, lang_pred string, score double, rejected boolean",
        run,
    )


def recognised(docs: DataFrame, model: Centroids | None) -> DataFrame:
    """``docs`` without the rows that ``predict`` rejects; one pass, no shuffle."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    @F.pandas_udf("boolean")
    def stays(text):
        import pandas as pd

        model, out = shared.value, np.zeros(len(text), bool)
        texts = text.tolist()
        known = [i for i, t in enumerate(texts) if model and t and _LETTER.search(t)]
        for at in range(0, len(known), 256):
            some = known[at : at + 256]
            best, cosine = model.predict(np.array([counts(texts[i]) for i in some]))
            out[some] = cosine >= model.least[best]
        return pd.Series(out)

    return docs.where(stays("text"))
