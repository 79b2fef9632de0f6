"""Secrets by pattern, and strings too random to be anything else.

Patterns find assigned passwords and tokens, access key ids and long hexadecimal strings.
Other strings of ``SHORTEST`` letters, digits and ``+/_-`` or more are put through a
battery under the encoding their characters allow (hexadecimal, small letters, base32,
letters and digits, base64): a chi-squared test that the alphabet is used evenly, a runs test about
the alphabet's middle and a test of the serial correlation of neighbours.  Fisher's
method makes one p-value of the three: how irregular a truly random string would be as
often as this one.  Prose fails the battery by far, and fails it the more surely the
longer it is.

What passes is held against false discoveries by length: strings of letters in the case of
prose are known to be no secrets and serve as decoys; those of small letters alone only if
their pairs of letters are as likely in the words of the corpus as among letters drawn
evenly, or more so, for a random string of small letters is no prose.  The pairs are counted
over all texts, outside strings long enough to be secrets themselves.  For each encoding and
length class, each different string counted once over the whole corpus, the lowest threshold of p is taken at which
decoys passing are at most ``fdr`` of all that pass; where no threshold does, nothing of
that class is reported.

One pass reads the texts for the pairs, one for the strings; pairs and the histogram that
thresholds come from are of fixed size.

Null and empty texts have no spans.  A null ``doc_id`` is kept.  Repeated rows get equal
results, and repeated strings change no threshold.  An empty table gives an empty table.  Other
columns are not read.
"""

from __future__ import annotations

import math
import re

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clickloom.llm.common import by_batch, spans_text, written

KINDS = ("assign", "access", "hex")
SHORTEST, BINS = 20, 100
_ASSIGN = re.compile(
    r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
    re.IGNORECASE | re.ASCII,
)
_ACCESS = re.compile(r"AKIA[A-Z0-9]{16,}")
_HEX = re.compile(r"(?<![0-9a-f])[0-9a-f]{24,}")
_STRING = re.compile(rf"[A-Za-z0-9+/_-]{{{SHORTEST},}}")
_PROSE = re.compile(r"[A-Za-z]?[a-z]+(?:[-/_][A-Za-z]?[a-z]+)*|[A-Z]+(?:[-/_][A-Z]+)*")

_UPPER, _LOWER, _DIGITS = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz", "0123456789"
ALPHABETS = {
    "hex": (_DIGITS + "abcdef", _DIGITS + "ABCDEF"),
    "lower": (_LOWER,),
    "base32": (_UPPER + "234567",),
    "alnum": (_DIGITS + _UPPER + _LOWER,),
    "base64": (_UPPER + _LOWER + _DIGITS + "+/", _UPPER + _LOWER + _DIGITS + "-_"),
}


_NUMBER = np.array([_LOWER.find(chr(i).lower()) % 27 if i < 128 else 26 for i in range(256)])
_IN_STRING = np.array([i < 128 and (chr(i).isalnum() or chr(i) in "+/_-") for i in range(256)], np.int8)


def base_spans(text: str | None) -> list[tuple[int, int, int]]:
    """(start, number of the kind, end) of the pattern matches, sorted."""
    if not text:
        return []
    out = []
    if ":" in text or "=" in text:
        out += [(m.start(), 0, m.end()) for m in _ASSIGN.finditer(text) if len(m[2]) >= 6]
    if "AKIA" in text:
        out += [(m.start(), 1, m.end()) for m in _ACCESS.finditer(text)]
    out += [(m.start(), 2, m.end()) for m in _HEX.finditer(text)]
    return sorted(out)


def encoding_of(s: str) -> tuple[str, str] | None:
    """The narrowest encoding whose alphabet holds the string."""
    used = set(s)
    for name, alphabets in ALPHABETS.items():
        for a in alphabets:
            if used <= set(a):
                return name, a
    return None


def _two_sided(z: float) -> float:
    return math.erfc(abs(z) / math.sqrt(2))


def battery(s: str, alphabet: str) -> float:
    """Fisher's combined p-value of the three tests, if ``s`` were random."""
    n, size = len(s), len(alphabet)
    x = np.array([alphabet.index(c) for c in s], np.float64)
    counts = np.bincount(x.astype(int), minlength=size)
    chi = float((counts**2).sum() * size / n - n)
    # Wilson and Hilferty's cube root brings chi-squared close to a normal variable.
    k = size - 1
    z = ((chi / k) ** (1 / 3) - (1 - 2 / (9 * k))) / math.sqrt(2 / (9 * k))
    uniform = 0.5 * math.erfc(z / math.sqrt(2))
    high = x >= size / 2
    up, down = int(high.sum()), int(n - high.sum())
    if up and down:
        mean = 2 * up * down / n + 1
        spread = math.sqrt(max((mean - 1) * (mean - 2) / (n - 1), 1e-9))
        runs = _two_sided((1 + int((high[1:] != high[:-1]).sum()) - mean) / spread)
    else:
        runs = 2.0 ** (1 - n)
    c = x - x.mean()
    square = float((c * c).sum())
    serial = _two_sided((float((c[1:] * c[:-1]).sum()) / square + 1 / n) * math.sqrt(n)) if square else 0.0
    half = -sum(math.log(max(p, 1e-300)) for p in (uniform, runs, serial))
    return math.exp(-half) * (1 + half + half * half / 2)


def letter_pairs(text: str) -> np.ndarray:
    """How often each pair of letters, in either case, stands in the text outside long strings."""
    raw = np.frombuffer(text.encode(), np.uint8)
    letter = _NUMBER[raw]
    edges = np.flatnonzero(np.diff(_IN_STRING[raw], prepend=0, append=0))
    starts, ends = edges[::2], edges[1::2]
    for k in np.flatnonzero(ends - starts >= SHORTEST):
        letter[starts[k] : ends[k]] = 26
    both = (letter[:-1] < 26) & (letter[1:] < 26)
    return np.bincount(letter[:-1][both] * 26 + letter[1:][both], minlength=26 * 26)


def pair_scores(docs: DataFrame) -> np.ndarray:
    """For each pair of letters, how many bits more likely the second is after the first in the
    words of ``docs`` than among letters drawn evenly."""

    def run(batches):
        total = np.zeros(26 * 26, np.int64)
        for b in batches:
            for text in b["text"]:
                total += letter_pairs(text)
        yield {"pair": list(range(26 * 26)), "n": total.tolist()}

    texts = docs.select("text").where("text is not null")
    sums = by_batch(texts, "pair int, n long", run).groupBy("pair").agg(F.sum("n").alias("n"))
    n = np.zeros(26 * 26)
    for r in sums.collect():
        n[r.pair] = r.n
    n = n.reshape(26, 26)
    return np.log2((n + 1) / (n.sum(1, keepdims=True) + 26) * 26).ravel()


def wordlike(s: str, scores: np.ndarray) -> bool:
    letter = _NUMBER[np.frombuffer(s.encode(), np.uint8)]
    both = (letter[:-1] < 26) & (letter[1:] < 26)
    return float(scores[letter[:-1][both] * 26 + letter[1:][both]].sum()) >= 0


def candidates(text: str, spans: list[tuple[int, int, int]], scores: np.ndarray) -> list[dict]:
    """Strings for the battery outside the pattern matches, with their p-values."""
    import xxhash

    out, k, ends = [], 0, 0
    for m in _STRING.finditer(text):
        while k < len(spans) and spans[k][0] < m.end():
            ends = max(ends, spans[k][2])
            k += 1
        if m.start() < ends:
            continue
        s, before, after = m[0], text[m.start() - 1 : m.start()], text[m.end() : m.end() + 1]
        if before.isalnum() or after.isalnum():  # a piece of a word with other letters
            continue
        got = encoding_of(s)
        if got is None or s.isdigit():
            continue
        out.append(
            {
                "start": m.start(),
                "end": m.end(),
                "id": xxhash.xxh3_64_intdigest(s) - (1 << 63),
                "encoding": got[0],
                "size": len(s).bit_length() * 2 + (len(s) >> (len(s).bit_length() - 2) & 1),
                "decoy": bool(_PROSE.fullmatch(s)) and (not s.islower() or wordlike(s, scores)),
                "p": battery(s, got[1]),
            }
        )
    return out


def scanned(docs: DataFrame) -> DataFrame:
    shared = docs.sparkSession.sparkContext.broadcast(pair_scores(docs))

    def run(batches):
        for b in batches:
            out = {"n": [], "base": [], "strings": []}
            for text in b["text"]:
                spans = base_spans(text)
                out["n"].append([sum(k == i for _, k, _ in spans) for i in range(len(KINDS))])
                out["base"].append([{"start": s, "rank": k, "kind": KINDS[k], "end": e} for s, k, e in spans])
                out["strings"].append(candidates(text, spans, shared.value) if text else [])
            yield {"doc_id": b["doc_id"], "place": b["place"], **out}

    return by_batch(
        docs.select("doc_id", F.xxhash64("text").alias("place"), "text"),
        "doc_id long, place long, n array<long>, "
        "base array<struct<start:int, rank:int, kind:string, end:int>>, "
        "strings array<struct<start:int, end:int, id:long, encoding:string, size:int, decoy:boolean, p:double>>",
        run,
    )


def thresholds(histogram: list, fdr: float, alpha: float) -> dict[tuple[str, int], float]:
    """Lowest p to report for each (encoding, length class), from (encoding, size, decoy,
    bin, n) rows.  ``alpha`` is the share of true secrets given up in any case."""
    by: dict[tuple[str, int], np.ndarray] = {}
    for encoding, size, decoy, bin_, n in histogram:
        by.setdefault((encoding, size), np.zeros((2, BINS), np.int64))[int(decoy), bin_] += n
    out = {}
    for key, counts in by.items():
        above = counts[:, ::-1].cumsum(1)[:, ::-1]
        fine = np.flatnonzero((above[1] <= fdr * (above[0] + above[1])) & (above[0] > 0))
        fine = fine[fine >= math.ceil(alpha * BINS)]
        if len(fine):
            out[key] = float(fine[0]) / BINS
    return out


def find(docs: DataFrame, fdr: float = 0.05, alpha: float = 0.01) -> DataFrame:
    """One row for each row of ``docs``: doc_id, place, n_assign, n_access, n_hex, base and
    spans (array<struct<start, rank, kind, end>>) and n_random."""
    rows = written(scanned(docs), "scanned")
    counts = (
        rows.select(F.inline("strings"))
        .select(
            "id",
            "encoding",
            "size",
            "decoy",
            F.least(F.floor(F.col("p") * BINS), F.lit(BINS - 1)).cast("int").alias("bin"),
        )
        .distinct()
        .groupBy("encoding", "size", "decoy", "bin")
        .agg(F.count("*").alias("n"))
    )
    limits = thresholds([tuple(r) for r in counts.collect()], fdr, alpha)
    # One bounded expression: as many cases as there are encodings and length classes.
    table = F.create_map(
        *[F.lit(x) for (e, s), p in sorted(limits.items()) for x in (f"{e}:{s}", p)]
    ) if limits else None

    def passes(s):
        if table is None:
            return F.lit(False)
        key = F.concat_ws(":", s["encoding"], s["size"].cast("string"))
        return ~s["decoy"] & (s["p"] >= F.coalesce(F.element_at(table, key), F.lit(2.0)))

    added = F.transform(
        F.filter("strings", passes),
        lambda s: F.struct(
            s["start"].alias("start"), F.lit(len(KINDS)).alias("rank"), F.lit("random").alias("kind"), s["end"].alias("end")
        ),
    )
    return rows.select(
        "doc_id",
        "place",
        *[F.col("n")[i].alias(f"n_{k}") for i, k in enumerate(KINDS)],
        "base",
        F.concat("base", added).alias("spans"),
        F.size(added).cast("long").alias("n_random"),
    )


def digest(found: DataFrame) -> DataFrame:
    base = found.withColumnRenamed("spans", "all").withColumnRenamed("base", "spans")
    return (
        base.withColumn("base_sha256", F.sha2(spans_text(), 256))
        .drop("spans")
        .withColumnRenamed("all", "spans")
        .select("doc_id", *[f"n_{k}" for k in KINDS], "base_sha256", spans_text().alias("spans"), "n_random")
    )
