"""Byte-level BPE over a corpus: each different word is encoded once.

Texts are cut at single blanks into words, a blank going with the word after it, which
never cuts through a match of the pre-token pattern.  Blocks of documents list their
different words and keep each text as positions in that list.  The lists are shuffled by
a checksum of the word; the task that gets a word encodes each of its pattern matches by
merge ranks, once, and answers every block.  The answers and the positions are shuffled
by block, and the texts are put together again as ids.  A word occurs once in a block's
list however common it is, so no task sees more of it than there are blocks.

What is shuffled is packed: a list of words, of positions or of ids is one compressed
value.  Decoding looks ids up in the token-byte table, which is as large as the
vocabulary, whatever the data.

Null and empty texts have no ids.  Repeated rows and null ids are kept.  An empty table
gives an empty table.  Other columns are not read.
"""

from __future__ import annotations

import base64
import re
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clickloom.llm.common import by_batch

BLOCK_CHARS = 8_000_000
ROW_DOCUMENTS = 256
_ODD = re.compile(r"\s\s")
_CUT = re.compile(r"(?<!\s) (?!\s)")


def ranks_of(path: str) -> dict[bytes, int]:
    with open(path, "rb") as f:
        return {base64.b64decode(a): int(b) for a, b in (line.split() for line in f if line.strip())}


def words_of(text: str | None) -> list[str]:
    """The text cut at single blanks; joined, the words are the text."""
    if not text:
        return []
    first, *rest = _CUT.split(text) if _ODD.search(text) else text.split(" ")
    return ([first] if first else []) + [" " + w for w in rest]


class _Numbers(dict):
    """Numbers words as they come."""

    def __missing__(self, word):
        self[word] = n = len(self)
        return n


def _packed(*arrays: bytes) -> bytes:
    import zstandard

    sizes = np.array([len(a) for a in arrays], "<u8").tobytes()
    return zstandard.ZstdCompressor(level=1).compress(sizes + b"".join(arrays))


def _unpacked(blob: bytes, n: int) -> list[bytes]:
    import zstandard

    raw = zstandard.ZstdDecompressor().decompress(blob)
    sizes, at, out = np.frombuffer(raw[: 8 * n], "<u8").tolist(), 8 * n, []
    for s in sizes:
        out.append(raw[at : at + s])
        at += s
    return out


def _planes(x: np.ndarray) -> bytes:
    """32-bit numbers byte plane by byte plane: high bytes compress well together."""
    return x.astype("<u4").view(np.uint8).reshape(-1, 4).T.tobytes()


def _from_planes(raw: bytes) -> np.ndarray:
    return np.ascontiguousarray(np.frombuffer(raw, np.uint8).reshape(4, -1).T).view("<u4").reshape(-1)


def _blocks(batches, buckets: int):
    """For each block: its id, its documents with their words' numbers, its words and the
    bounds of their buckets.  Numbers go by bucket."""
    import xxhash

    numbers, held, chars = _Numbers(), [], 0

    def block():
        words = [w.encode() for w in numbers]
        bucket = np.fromiter(map(zlib.crc32, words), np.int64, len(words)) % buckets
        order = np.argsort(bucket, kind="stable")
        rank = np.empty(len(words), np.int64)
        rank[order] = np.arange(len(words))
        words = [words[i] for i in order.tolist()]
        bounds = np.searchsorted(bucket[order], np.arange(buckets + 1))
        digest = xxhash.xxh3_64(b"\x00".join(words))
        digest.update(np.array([len(w) for w in words], "<u4").tobytes())
        block_id = digest.intdigest() - (1 << 63)
        return block_id, [(d, rank[n]) for d, n in held], words, bounds

    for b in batches:
        for doc_id, text in zip(b["doc_id"], b["text"]):
            words = words_of(text)
            held.append((doc_id, np.array(list(map(numbers.__getitem__, words)), np.int64)))
            chars += len(text or "") + 64
            if chars >= BLOCK_CHARS:
                yield block()
                numbers, held, chars = _Numbers(), [], 0
    if held:
        yield block()


_SHARED = "block long, kind int, first int, doc_ids array<long>, sizes array<int>, blob binary"


def encoded(docs: DataFrame, ranks: str, pattern: str) -> DataFrame:
    """(doc_id, ids array<int>) of each row, by the rank file ``ranks``."""
    rows = docs.select("doc_id", "text")
    buckets = 4 * int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))

    def lists(batches):
        for block, _, words, bounds in _blocks(batches, buckets):
            out = {"block": [], "bucket": [], "first": [], "blob": []}
            for k in range(buckets):
                some = words[bounds[k] : bounds[k + 1]]
                if some:
                    out["block"].append(block)
                    out["bucket"].append(k)
                    out["first"].append(int(bounds[k]))
                    lengths = np.array([len(w) for w in some], np.uint32)
                    out["blob"].append(_packed(_planes(lengths), b"".join(some)))
            yield out

    def texts(batches):
        for block, documents, _, _ in _blocks(batches, buckets):
            for at in range(0, len(documents), ROW_DOCUMENTS):
                some = documents[at : at + ROW_DOCUMENTS]
                yield {
                    "block": [block],
                    "kind": [1],
                    "first": [at],
                    "doc_ids": [[d for d, _ in some]],
                    "sizes": [[len(n) for _, n in some]],
                    "blob": [_packed(_planes(np.concatenate([n for _, n in some])))],
                }

    def answers(batches):
        import regex
        import tiktoken

        split = regex.compile(pattern).findall
        core = tiktoken.Encoding(
            "own", pat_str=pattern, mergeable_ranks=ranks_of(ranks), special_tokens={}
        )._core_bpe
        known: dict[bytes, list[int]] = {}
        for b in batches:
            out = {"block": b["block"], "kind": [], "first": b["first"], "doc_ids": [], "sizes": [], "blob": []}
            for blob in b["blob"]:
                lengths, raw = _unpacked(blob, 2)
                at, ids = 0, []
                for n in _from_planes(lengths).tolist():
                    word = raw[at : at + n]
                    at += n
                    got = known.get(word)
                    if got is None:
                        got = []
                        for piece in split(word.decode()):
                            got += core.encode_single_piece(piece.encode())
                        known[word] = got
                    ids.append(got)
                sizes = np.array([len(x) for x in ids], np.uint32)
                flat = np.fromiter((i for x in ids for i in x), np.uint32, int(sizes.sum()))
                out["kind"].append(0)
                out["doc_ids"].append([])
                out["sizes"].append([])
                out["blob"].append(_packed(_planes(sizes), _planes(flat)))
            yield out

    asked = by_batch(rows, "block long, bucket int, first int, blob binary", lists)
    told = by_batch(asked.repartition("bucket"), _SHARED, answers)
    whole = told.union(by_batch(rows, _SHARED, texts))

    def together(batches):
        block, parts, table = None, [], None
        for b in batches:
            for of, kind, first, doc_ids, sizes, blob in zip(*(b[k] for k in ("block", "kind", "first", "doc_ids", "sizes", "blob"))):
                if of != block:
                    block, parts, table = of, [], None
                if kind == 0:
                    # A block with the same documents has the same list: once is enough.
                    if not parts or parts[-1][0] != first:
                        n, ids = _unpacked(blob, 2)
                        parts.append((first, _from_planes(n), _from_planes(ids)))
                    continue
                if table is None:
                    lengths = np.concatenate([np.zeros(0, np.int64), *(n.astype(np.int64) for _, n, _ in parts)])
                    flat = np.concatenate([np.zeros(0, np.uint32), *(ids for _, _, ids in parts)])
                    table = lengths, np.cumsum(lengths) - lengths, flat
                lengths, starts, flat = table
                numbers = _from_planes(_unpacked(blob, 1)[0]).astype(np.int64)
                if len(numbers) and int(numbers.max()) >= len(lengths):
                    raise RuntimeError("a block's words are missing")
                n = lengths[numbers]
                ends = np.cumsum(n)
                at = np.repeat(starts[numbers] - (ends - n), n) + np.arange(int(ends[-1]) if len(ends) else 0)
                words = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int64)
                offsets = np.concatenate([[0], ends])[words].astype(np.int32)
                yield {
                    "doc_id": doc_ids,
                    "ids": pa.ListArray.from_arrays(offsets, pa.array(flat[at].astype(np.int32))),
                }

    ordered = whole.repartition("block").sortWithinPartitions("block", "kind", "first")
    return by_batch(ordered, "doc_id long, ids array<int>", together)


def decoded(rows: DataFrame, ranks: str) -> DataFrame:
    """``rows`` (doc_id, ids) with ``decoded``, the bytes of the ids."""

    def run(batches):
        table = {i: b for b, i in ranks_of(ranks).items()}
        tokens = [table.get(i, b"") for i in range(max(table, default=-1) + 1)]
        for whole in batches:
            # A few rows at a time: as Python numbers, ids take ten times their room.
            for at in range(0, whole.num_rows, ROW_DOCUMENTS):
                b = whole.slice(at, ROW_DOCUMENTS)
                ids = b.column("ids")
                got = [
                    b"".join(map(tokens.__getitem__, x.values.to_numpy().tolist())) if x.is_valid else None for x in ids
                ]
                yield pa.RecordBatch.from_arrays(
                    [b.column("doc_id"), ids, pa.array(got, pa.binary())], names=["doc_id", "ids", "decoded"]
                )

    return rows.select("doc_id", "ids").mapInArrow(run, "doc_id long, ids array<int>, decoded binary")


def digest(rows: DataFrame) -> DataFrame:
    return rows.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), " ").cast("binary"), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )
