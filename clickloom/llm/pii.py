"""Personal data by pattern, and words that give a person away by company.

Patterns find e-mail addresses, IPv4 addresses, payment cards and phone numbers.  Each
distinct value is a protected entity.  A word is whatever stands between blanks outside
the patterns, less punctuation and symbols at its ends: letters, digits and marks of any
script, of any length.  Of a word with punctuation inside, such as ``4471-A``, its parts
are looked at too, and the spans of both may overlap.  A word reveals an entity as far as knowing the
word narrows the entity down: the pointwise mutual information of the two, over the
information content of the entity,

    r = (log(N / n(c)) - log(n(t) / n(c, t))) / log(N / n(c)),

with N documents, n(c) different contexts of the entity, n(t) different texts with the
word and n(c, t) different contexts of the entity with the word among the ``window``
words on either side.  Exact copies and equal contexts count once, so a page copied a
thousand times says nothing.  Words of ``min_contexts`` and r of at least ``generalise``
are disclosing wherever they stand; from ``remove`` on they are deleted instead of
generalised.

The work is three passes over the texts: words by entities; the count of texts of those
words, added up within each task; and the places of the few words found disclosing.  The
second and third look up words in a bitmap of fixed size and what they find is joined exactly, so
nothing broadcast grows with the data.

Null and empty texts have no spans.  A null ``doc_id`` is kept.  Repeated rows get equal
results.  An empty table gives an empty table.  Other columns are not read.
"""

from __future__ import annotations

import re
import unicodedata
import zlib
from bisect import bisect_left, bisect_right
from collections import Counter
from string import punctuation

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clickloom.llm.common import bitmap, bitmap_of_longs, bits_set, by_batch, released, spans_text, written

SALTS = 16
KINDS = ("email", "ip", "card", "phone")
LABELS = {"email": "[EMAIL]", "ip": "[IP]", "card": "[CARD]", "phone": "[PHONE]", "term": "[TERM]"}

_TAIL = re.compile(r"@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)+")
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
# A match never starts inside a run of digits: the runs before it are taken whole.
_IP = re.compile(r"(?<![0-9])([0-9]++)\.([0-9]++)\.([0-9]++)\.([0-9]++)")
_CARD = re.compile(r"(?<![0-9])[0-9](?:[ -]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
_DIGIT = re.compile("[0-9]")
# Beyond the first plane only the block of pictures: a class of many ranges there is slow.
_OUTER = "\U0001f000-\U0001fbef" + "".join(
    re.escape(c) for c in map(chr, range(0x10000)) if unicodedata.category(c)[0] in "PSC" and not c.isspace()
)
_PART = re.compile(rf"[^\s{_OUTER}]++")
_JOINED = re.compile(rf"[^\s{_OUTER}]++(?:[{_OUTER}]++[^\s{_OUTER}]++)+")
_WORD = re.compile(rf"[^\s{_OUTER}]++(?:[{_OUTER}]++[^\s{_OUTER}]++)*")


def _emails(text: str) -> list[tuple[int, int]]:
    out, last = [], 0
    for m in _TAIL.finditer(text):
        start = m.start()
        while start > last and text[start - 1] in _LOCAL:
            start -= 1
        if start < m.start():
            out.append((start, m.end()))
            last = m.end()
    return out


def _luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c)
        if i % 2:
            d = d * 2 - 9 * (d > 4)
        total += d
    return total % 10 == 0


def base_spans(text: str | None) -> list[tuple[int, int, int]]:
    """(start, number of the kind, end) of the pattern matches, sorted."""
    if not text:
        return []
    out = [(s, 0, e) for s, e in _emails(text)] if "@" in text else []
    if _DIGIT.search(text):
        for m in _IP.finditer(text):
            if all(len(x.lstrip("0")) <= 3 and int(x.lstrip("0") or 0) <= 255 for x in m.groups()):
                out.append((m.start(), 1, m.end()))
        for m in _CARD.finditer(text):
            if m.end() - m.start() >= 14:
                digits = m[0].replace(" ", "").replace("-", "")
                if 14 <= len(digits) <= 19 and _luhn(digits):
                    out.append((m.start(), 2, m.end()))
        for m in _PHONE.finditer(text) if "+" in text else ():
            if 10 <= sum(c.isdigit() for c in m[0]) <= 15:
                out.append((m.start(), 3, m.end()))
    return sorted(out)


def _entity(kind: int, value: str) -> str:
    if kind == 2:
        value = value.replace(" ", "").replace("-", "")
    elif kind == 3:
        value = "".join(c for c in value if c.isdigit())
    return f"{KINDS[kind]}:{value.lower()}"


def contexts(docs: DataFrame, window: int = 8) -> DataFrame:
    """(entity, context, terms): the words around each pattern match."""

    def run(batches):
        for b in batches:
            out = {"entity": [], "context": [], "terms": []}
            for text in b["text"]:
                spans = base_spans(text)
                if not spans:
                    continue
                words = [(m.start(), m.end(), m[0].lower()) for m in _WORD.finditer(_blank(text, spans))]
                starts, ends = [w[0] for w in words], [w[1] for w in words]
                for start, kind, end in spans:
                    k = bisect_right(ends, start)
                    n = bisect_left(starts, end)
                    near = [w for *_, w in words[max(0, k - window) : k] + words[n : n + window]]
                    out["entity"].append(_entity(kind, text[start:end]))
                    out["context"].append(zlib.crc32(" ".join(near).encode()))
                    out["terms"].append(sorted({*near, *(x for w in near for x in _PART.findall(w))}))
            yield out

    return by_batch(docs.select("text"), "entity string, context long, terms array<string>", run)


def _blank(text: str, spans: list[tuple[int, int, int]]) -> str:
    """``text`` with its pattern matches blanked out."""
    out, at = [], 0
    for start, _, end in spans:
        if end > at:
            out += [text[at:start], " " * (end - max(at, start))]
            at = end
    return "".join(out) + text[at:]


def disclosure(
    docs: DataFrame, window: int = 8, min_contexts: int = 3
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(entity, term, n_ct, n_c) of pairs seen in ``min_contexts`` contexts; the words
    among them; the contexts they were counted in."""
    seen = written(contexts(docs, window), "contexts")
    n_c = seen.select("entity", "context").distinct().groupBy("entity").agg(F.count("*").alias("n_c"))
    pairs = (
        seen.select("entity", "context", F.explode("terms").alias("term"))
        .distinct()
        .groupBy("entity", "term")
        .agg(F.count("*").alias("n_ct"))
        .where(F.col("n_ct") >= min_contexts)
        .join(n_c, "entity")
    )
    pairs = written(pairs, "pairs")
    return pairs, pairs.select("term").distinct(), seen


def _plain(token: str) -> bool:
    """Whether a token is one word by itself: letters and digits, none among the pictures."""
    return token.isalnum() and (token.isascii() or max(token) < "\U0001f000")


class _Terms:
    """The words of texts that a bitmap has."""

    def __init__(self, marks: bytes):
        self.marks = marks

    def among(self, text: str) -> list[str]:
        """Of a text with its pattern matches blanked out.  No word has blanks inside, and most are
        a whole token, or one less the signs at its ends; the others are searched together."""
        words, rest = set(), []
        for token in set(text.split()):
            core = token if _plain(token) else token.strip(punctuation)
            if _plain(core):
                words.add(core.lower())
            elif core:
                rest.append(core)
        if rest:
            others = " ".join(rest)
            words.update(w.lower() for w in _PART.findall(others))
            words.update(w.lower() for w in _JOINED.findall(others))
        words = list(words)
        slots = np.fromiter((zlib.crc32(w.encode()) for w in words), np.int64, len(words))
        return [words[i] for i in np.flatnonzero(bits_set(self.marks, slots % (len(self.marks) * 8)))]


def term_counts(docs: DataFrame, terms: DataFrame, most: int = 500_000) -> DataFrame:
    """(term, n_t): in how many different texts each of ``terms`` (and some other words) stands.

    Texts that occur once are counted within their task.  Those whose hash a bitmap of repeated
    texts has are told apart by an exchange of their words, once for each task.
    """
    broadcast = docs.sparkSession.sparkContext.broadcast
    hashed = docs.select("text", F.xxhash64("text").alias("text_hash"))
    copies = hashed.groupBy("text_hash").agg(F.count("*").alias("n")).where("n > 1")
    repeated = broadcast(bitmap_of_longs(copies, "text_hash"))
    marks = broadcast(bitmap(terms, "term"))

    def run(batches):
        known, counts, seen = _Terms(marks.value), Counter(), set()
        bits = len(repeated.value) * 8

        def counted():
            out = {"text_hash": [None] * len(counts), "terms": [None] * len(counts)}
            return out | {"term": list(counts), "n": list(counts.values())}

        for b in batches:
            again = bits_set(repeated.value, np.array(b["text_hash"], np.int64) & (bits - 1))
            out = {"text_hash": [], "terms": [], "term": [], "n": []}
            for text, h, twice in zip(b["text"], b["text_hash"], again):
                if not text or twice and h in seen:
                    continue
                words = known.among(_blank(text, base_spans(text)))
                if not twice:
                    counts.update(words)
                elif words:
                    seen.add(h)
                    out["text_hash"].append(h)
                    out["terms"].append(words)
            out["term"] = out["n"] = [None] * len(out["terms"])
            yield out
            if len(counts) > most:
                yield counted()
                counts.clear()
            if len(seen) > most:
                seen.clear()
        if counts:
            yield counted()

    rows = written(by_batch(hashed, "text_hash long, terms array<string>, term string, n long", run), "counted")
    shared = rows.where("terms is not null").groupBy("text_hash").agg(F.first("terms").alias("terms"))
    each = shared.select(F.explode("terms").alias("term"), F.lit(1).cast("long").alias("n"))
    return rows.where("term is not null").select("term", "n").union(each).groupBy("term").agg(F.sum("n").alias("n_t"))


def find(
    docs: DataFrame,
    window: int = 8,
    min_contexts: int = 3,
    generalise: float = 0.9,
    remove: float = 1.0,
) -> DataFrame:
    """One row for each row of ``docs``: doc_id, n_email, n_ip, n_card, n_phone,
    base (text of the pattern spans), spans array<struct<start, rank, kind, end, action>>
    of all spans and n_term."""
    pairs, terms, seen = disclosure(docs, window, min_contexts)
    n_docs = docs.count()
    content = F.log(F.greatest(F.lit(n_docs), F.col("n_c") + 1) / F.col("n_c"))
    told = written(
        pairs.join(term_counts(docs, terms), "term")
        .withColumn(
            "r", (content - F.log(F.greatest(F.col("n_t") / F.col("n_ct"), F.lit(1.0)))) / content
        )
        .groupBy("term")
        .agg(F.max("r").alias("r"))
        .where(F.col("r") >= generalise),
        "told",
    )
    marks = docs.sparkSession.sparkContext.broadcast(bitmap(told, "term"))

    def run(batches):
        known = _Terms(marks.value)
        for b in batches:
            out = {k: [] for k in ("doc_id", "text_hash", "n", "spans", "suspects")}
            for doc_id, text, h in zip(b["doc_id"], b["text"], b["text_hash"]):
                spans = base_spans(text)
                n = [0, 0, 0, 0]
                for _, kind, _ in spans:
                    n[kind] += 1
                out["doc_id"].append(doc_id)
                out["text_hash"].append(h)
                out["n"].append(n)
                out["spans"].append(
                    [{"start": s, "rank": k, "kind": KINDS[k], "end": e, "action": "mask"} for s, k, e in spans]
                )
                out["suspects"].append(_suspects(text, spans, known))
            yield out

    span = "array<struct<start:int, rank:int, kind:string, end:int, action:string>>"
    found = by_batch(
        docs.select("doc_id", "text", F.xxhash64("text").alias("text_hash")),
        f"doc_id long, text_hash long, n array<long>, spans {span}, "
        "suspects array<struct<term:string, start:int, end:int>>",
        run,
    ).withColumn("row", F.monotonically_increasing_id())
    found = written(found, "found")
    hits = found.select("row", F.inline("suspects"))
    # A word may be as common as it likes: its rows are spread over some salts.
    told = told.withColumn("salt", F.explode(F.expr(f"sequence(0, {SALTS - 1})")))
    added = (
        hits.withColumn("salt", F.pmod("row", F.lit(SALTS)).cast("int"))
        .join(told, ["term", "salt"])
        .groupBy("row")
        .agg(
            F.collect_list(
                F.struct(
                    "start",
                    F.lit(len(KINDS)).alias("rank"),
                    F.lit("term").alias("kind"),
                    "end",
                    F.when(F.col("r") >= remove, "remove").otherwise("generalise").alias("action"),
                )
            ).alias("added")
        )
    )
    out = found.join(added, "row", "left").select(
        "doc_id",
        "text_hash",
        *[F.col("n")[i].alias(f"n_{k}") for i, k in enumerate(KINDS)],
        F.col("spans").alias("base"),
        F.concat("spans", F.coalesce("added", F.expr(f"cast(array() as {span})"))).alias("spans"),
        F.coalesce(F.size("added"), F.lit(0)).cast("long").alias("n_term"),
    )
    released(seen)
    return out


def _suspects(text: str | None, spans: list[tuple[int, int, int]], known: _Terms) -> list[dict]:
    """The places of the words that ``known`` has."""
    if not text:
        return []
    text = _blank(text, spans)
    wanted = set(known.among(text))
    return [
        {"term": m[0].lower(), "start": m.start(), "end": m.end()}
        for words in (_PART, _JOINED)
        for m in (words.finditer(text) if wanted else ())
        if m[0].lower() in wanted
    ]


def sanitised(docs: DataFrame, found: DataFrame) -> DataFrame:
    """``docs`` with the spans of ``find`` masked, generalised or removed in ``text``."""
    spans = found.select(
        F.col("doc_id").alias("__cl_id"), F.col("text_hash").alias("__cl_hash"), F.col("spans").alias("__cl_spans")
    ).dropDuplicates(["__cl_id", "__cl_hash"])
    joined = docs.join(
        spans, F.col("doc_id").eqNullSafe(F.col("__cl_id")) & (F.xxhash64("text") == F.col("__cl_hash")), "left"
    ).drop("__cl_id", "__cl_hash")

    @F.udf("string")
    def masked(text, spans):
        if text is None or not spans:
            return text
        out, at = [], 0
        for s in sorted(spans, key=lambda s: (s["start"], s["rank"])):
            if s["start"] < at:
                at = max(at, s["end"])
                continue
            out += [text[at : s["start"]], "" if s["action"] == "remove" else LABELS[s["kind"]]]
            at = s["end"]
        return "".join(out) + text[at:]

    return joined.withColumn("text", masked("text", "__cl_spans")).drop("__cl_spans")


def digest(found: DataFrame) -> DataFrame:
    base = found.withColumnRenamed("spans", "all").withColumnRenamed("base", "spans")
    return (
        base.withColumn("base_sha256", F.sha2(spans_text(), 256))
        .drop("spans")
        .withColumnRenamed("all", "spans")
        .select("doc_id", *[f"n_{k}" for k in KINDS], "base_sha256", spans_text().alias("spans"), "n_term")
    )
