"""Token ids in files of canonical, length-limited Huffman codes.

Texts become ids by a vocabulary of the ``tokenizers`` library, each followed by an end
id.  Global counts of the ids, summed by Spark, give each id a code of at most
``longest`` bits; canonical codes follow from the lengths alone, so the codebook is one
small table of (id, bits).  Documents are range-partitioned by id, and each partition
writes blocks of about ``BLOCK_TOKENS`` ids.  A block can be decoded on its own: it holds
its documents' ids and sizes, the number of ids before it in its part, the bits, and the
bit offset of every ``STRIDE``-th id.  From those checkpoints a block is decoded
in parallel lanes, one table look-up for each id.

A file set is a folder with ``codebook``, ``blocks`` (Parquet, ascending ids within and
over the parts) and ``parts``, the number of ids before each part.  Only the vocabulary's
counts reach the driver.

Texts are encoded in runs of about ``RUN_CHARS`` characters.  The bounds of a run's pieces, as the
vocabulary splits text, are found for all its bytes at once, and Arrow tells the pieces apart.  Each
different piece goes to the library's model once and is kept; by position, the ids of the run follow.

Null and empty texts are the end id alone.  Null ids come first, in one range; repeated
ids lie next to each other in the order of their texts' hashes.  An empty table gives
empty files, read as no rows.  Strings that the vocabulary adds as tokens of their own
(``<|endoftext|>``) get those tokens' ids, as the library's plain call gives them.  Other columns
are not read.
"""

from __future__ import annotations

import os
import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from clickloom.llm.common import by_batch, released, written

STRIDE = 128
LONGEST = 16
BLOCK_TOKENS = 1 << 18
RANGE_TOKENS = 1 << 23
RUN_CHARS = 1 << 22
RUN_IDS = 1 << 20
CALL_CHARS = 1 << 14

# Words of these letters are split and lower-cased here as the vocabulary's own
# normaliser does it; all others go through the library whole.
_PLAIN = re.compile("[\x21-\x7eÀ-ÖØ-öø-įı-ſ]*")
_END = 0xFF  # ends a text; no byte of UTF-8
_SPACE, _LETTER, _DIGIT, _SIGN, _STOP, _ODD = range(6)


def _kinds() -> np.ndarray:
    """What each byte of UTF-8 is; letters from À to ſ begin with 0xC3 to 0xC5."""
    kinds = np.full(256, _ODD, np.uint8)
    kinds[0x21:0x7F] = _SIGN
    kinds[list(b" \t\n\r\v\f")] = _SPACE
    kinds[list(b"0123456789")] = _DIGIT
    kinds[[*range(0x41, 0x5B), *range(0x61, 0x7B), *range(0x80, 0xC0), 0xC3, 0xC4, 0xC5]] = _LETTER
    kinds[_END] = _STOP
    return kinds


_KINDS = _kinds()


def pieces(data: bytes, short: bool = True) -> pa.Array:
    """The pieces of texts, ``_END`` after each, white space dropped.  Letters from A to Z are small
    then, except in words that hold a character beyond ``_PLAIN``, which are one piece each; all are
    if not ``short``."""
    own = np.frombuffer(data, np.uint8).copy()
    kind = _KINDS[own]
    odd = kind == _ODD
    if short:
        # × and ÷ are no letters, İ has no small letter of its own.
        lead, next_ = own[:-1], own[1:]
        odd[:-1] |= (lead == 0xC3) & ((next_ == 0x97) | (next_ == 0xB7)) | (lead == 0xC4) & (next_ == 0xB0)
    else:
        odd = (kind != _SPACE) & (kind != _STOP)
    if odd.any():
        word = np.cumsum((kind == _SPACE) | (kind == _STOP), dtype=np.int32)
        beyond = np.zeros(word[-1] + 1, bool)
        beyond[word[odd]] = True
        kind[beyond[word] & (kind != _SPACE) & (kind != _STOP)] = _ODD
    own[(own >= 0x41) & (own <= 0x5A) & (kind == _LETTER)] |= 0x20
    new = (kind == _DIGIT) | (kind == _STOP)
    new[0] = True
    new[1:] |= kind[1:] != kind[:-1]
    # 's 't 'm 'd 're 've 'll where a run of signs would begin
    at = np.flatnonzero((own == ord("'")) & (kind == _SIGN) & new)
    one, two = own[at + 1], own.take(at + 2, mode="clip")
    single = np.isin(one, list(b"stmd"))
    double = ((one == ord("r")) | (one == ord("v"))) & (two == ord("e")) | (one == ord("l")) & (two == ord("l"))
    new[at[single | double] + 1] = False
    new[at[single] + 2] = True
    new[at[double] + 3] = True
    kept = kind != _SPACE
    own = own[kept]
    starts = np.append(np.flatnonzero(new[kept]), len(own)).astype(np.int64)
    buffers = [None, pa.py_buffer(starts), pa.py_buffer(own)]
    return pa.Array.from_buffers(pa.large_binary(), len(starts) - 1, buffers)


@lru_cache(maxsize=1)
def _byte_letters() -> list[str]:
    """The printable letter that byte-level vocabularies write for each byte."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    other = iter(range(256))
    return [chr(b) if b in plain else chr(256 + next(other)) for b in range(256)]


def runs(sizes: list[int], most: int) -> Iterator[slice]:
    """Neighbours whose sizes come to ``most`` or just above it; a larger one ends its run."""
    start, total = 0, 0
    for i, n in enumerate(sizes):
        total += n
        if total >= most:
            yield slice(start, i + 1)
            start, total = i + 1, 0
    if start < len(sizes):
        yield slice(start, len(sizes))


class WordEncoder:
    """Ids of whole texts, piece by piece: white space always parts ids in vocabularies
    that drop it, so each different piece of some texts is encoded once.  ``most`` bounds the
    bytes of the pieces kept, but for those of the texts at hand."""

    def __init__(self, path: str, most: int = 200 << 20):
        import json

        from tokenizers import Tokenizer
        from tokenizers.pre_tokenizers import WhitespaceSplit

        self.library = Tokenizer.from_file(path)
        # Texts that hold one of the vocabulary's own added strings go through the library whole.
        added = [t.content for t in self.library.get_added_tokens_decoder().values() if t.content]
        self.added = re.compile("|".join(map(re.escape, added)), re.IGNORECASE) if added else None
        letters = _byte_letters()
        self.letters = {b: x for b, x in enumerate(letters) if b != ord(" ")}
        self.known: dict[bytes, bytes] = {}
        self.most, self.held = most, 0
        # The short cut holds for this normaliser and this split alone, and if the last id of a
        # piece, and no other, is one of those that end a piece.
        with open(path) as f:
            parts = json.load(f)
        steps = [x["type"] for x in (parts.get("normalizer") or {}).get("normalizers", [])]
        split = (parts.get("pre_tokenizer") or {}).get("pretokenizers", [{}])
        pattern = split[0].get("pattern", {}).get("Regex")
        vocabulary, mark = self.library.get_vocab(), parts["model"].get("end_of_word_suffix")
        top = max(vocabulary.values(), default=0)
        self.short = (
            steps == ["NFC", "Replace", "Lowercase"]
            and pattern == r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
            and [x["type"] for x in split] == ["Split", "ByteLevel"]
            and parts["model"]["type"] == "BPE"
            and bool(mark)
            and all(x in vocabulary and x + mark in vocabulary for x in letters)
        )
        if self.short:
            self.model = Tokenizer(self.library.model)
            self.model.pre_tokenizer = WhitespaceSplit()
            self.last = np.zeros(top + 1, bool)
            self.last[[i for x, i in vocabulary.items() if x.endswith(mark)]] = True

    def _whole(self, texts: list[str]) -> list[bytes]:
        got = []
        for some in runs([len(x) for x in texts], CALL_CHARS):
            for x in self.library.encode_batch_fast(texts[some], add_special_tokens=False):
                got.append(np.array(x.ids, np.uint32).tobytes())
        return got

    def _plain(self, some: list[bytes]) -> list[bytes]:
        """As ``_whole`` for each piece of plain words, by the library's model alone."""
        out = []
        for part in runs([len(x) for x in some], CALL_CHARS):
            text = b" ".join(some[part]).decode().lower()
            if not text.isascii():
                text = text.encode().decode("latin-1").translate(self.letters)
            (got,) = self.model.encode_batch_fast([text], add_special_tokens=False)
            ids = np.array(got.ids, np.uint32)
            ends, data = (4 * (np.flatnonzero(self.last[ids]) + 1)).tolist(), ids.tobytes()
            out += [data[a:b] for a, b in zip([0, *ends], ends)]
        if len(out) != len(some):
            raise ValueError(f"{len(some)} pieces came back as {len(out)}")
        return out

    def _learn(self, some: list[bytes]) -> None:
        """Keep the ids of pieces that differ."""
        if self.held > self.most:
            self.known.clear()
            self.held = 0
        plain, others = [], []
        for x in some:
            if x not in self.known:
                (plain if self.short and _PLAIN.fullmatch(x.decode()) else others).append(x)
        for new, ids in ((plain, self._plain(plain)), (others, self._whole([x.decode() for x in others]))):
            self.known.update(zip(new, ids))
            self.held += sum(map(len, new)) + sum(map(len, ids)) + 160 * len(new)

    def encode_all(self, texts: list[str | None], end: bytes = b"") -> list[np.ndarray]:
        """The ids of each text, and ``end`` after them, as little-endian 32-bit integers."""
        if not texts:
            return []
        special = [i for i, x in enumerate(texts) if x and self.added and self.added.search(x)]
        apart, stop = set(special), bytes([_END])
        data = stop.join([b"" if x is None or i in apart else x.encode() for i, x in enumerate(texts)]) + stop
        found = pieces(data, self.short).dictionary_encode()
        different = found.dictionary.to_numpy(zero_copy_only=False).tolist()
        last = different.index(stop)
        self._learn(different[:last] + different[last + 1 :])
        # The end is one more piece of each text; a text that goes whole is a piece of its own.
        ids = [end if x == stop else self.known[x] for x in different]
        at = found.indices.to_numpy().copy()
        ends = np.flatnonzero(at == last)
        if special:
            at[ends[special]] = np.arange(len(ids), len(ids) + len(special))
            ids += [x + end for x in self._whole([texts[i] for i in special])]
        size = np.fromiter(map(len, ids), np.int64, len(ids)) // 4
        n = size[at]
        after = np.cumsum(n)
        where = np.repeat((np.cumsum(size) - size)[at] - (after - n), n)
        where += np.arange(len(where))
        return np.split(np.frombuffer(b"".join(ids), np.uint32)[where], after[ends[:-1]])

    def encode(self, text: str | None) -> bytes:
        return self.encode_all([text])[0].tobytes()


_ENCODERS: dict[str, WordEncoder] = {}


def _encoder(path: str) -> WordEncoder:
    """One for each Python worker: what it keeps depends on the words alone."""
    if path not in _ENCODERS:
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # a task has one core
        _ENCODERS[path] = WordEncoder(path)
    return _ENCODERS[path]


def packed(ids: np.ndarray) -> bytes:
    """Ids as planes of bytes, the lowest first, as many as the largest id needs: one to four.  They take
    half the room of whole integers and compress better."""
    planes = max(1, -(-int(ids.max()).bit_length() // 8)) if len(ids) else 1
    own = ids.astype("<u4").view(np.uint8).reshape(-1, 4)
    return bytes([planes]) + np.ascontiguousarray(own[:, :planes].T).tobytes()


def unpacked(data: bytes) -> np.ndarray:
    planes = np.frombuffer(data, np.uint8, offset=1).reshape(data[0], -1)
    ids = np.zeros(planes.shape[1], np.uint32)
    for i, plane in enumerate(planes):
        ids |= plane.astype(np.uint32) << np.uint32(8 * i)
    return ids


def encoded(docs: DataFrame, vocabulary: str, end_id: int) -> DataFrame:
    """(doc_id, place, n_tokens, ids): ids as ``packed``."""
    end = np.array([end_id], np.uint32).tobytes()

    def encode(batches):
        encoder = _encoder(vocabulary)
        for b in batches:
            for run in runs([len(t or "") for t in b["text"]], RUN_CHARS):
                ids = encoder.encode_all(b["text"][run], end)
                yield {
                    "doc_id": b["doc_id"][run],
                    "place": b["place"][run],
                    "n_tokens": [len(x) for x in ids],
                    "ids": [packed(x) for x in ids],
                }

    return by_batch(
        docs.select("doc_id", "text", F.xxhash64("text").alias("place")),
        "doc_id long, place long, n_tokens long, ids binary",
        encode,
    )


def code_lengths(counts: dict[int, int], longest: int = LONGEST) -> dict[int, int]:
    """Bits of each id: package-merge, so the best of all codes of at most ``longest``
    bits.  A single id takes one bit."""
    if len(counts) <= 1:
        return dict.fromkeys(counts, 1)
    if len(counts) > 1 << longest:
        raise ValueError(f"{len(counts)} ids do not fit into {longest} bits")
    ids = sorted(counts, key=lambda i: (counts[i], i))
    weight = np.array([counts[i] for i in ids], np.float64)
    # Each level pairs up the level below and merges the pairs with the single ids; of
    # each level only the order matters: which entries are single ids.
    levels, below = [], weight
    single = np.ones(len(ids), bool)
    for _ in range(longest - 1):
        levels.append(single)
        pairs = below[: len(below) // 2 * 2].reshape(-1, 2).sum(1)
        merged = np.concatenate([weight, pairs])
        order = np.argsort(merged, kind="stable")
        below, single = merged[order], order < len(ids)
    levels.append(single)
    lengths, take = np.zeros(len(ids), np.int64), 2 * len(ids) - 2
    for single in reversed(levels):
        alone = int(single[:take].sum())
        lengths[:alone] += 1
        take = 2 * (take - alone)
    return {i: int(n) for i, n in zip(ids, lengths)}


class Codebook:
    """Canonical codes from lengths: by (bits, id), counted up."""

    def __init__(self, lengths: dict[int, int], longest: int = LONGEST):
        self.longest = longest
        ids = np.fromiter(lengths, np.int64, len(lengths))
        n = np.fromiter(lengths.values(), np.int64, len(lengths))
        order = np.lexsort((ids, n))
        ids, n = ids[order], n[order]
        top = max(lengths, default=0) + 1
        self.bits = np.zeros(top, np.uint64)
        self.code = np.zeros(top, np.uint64)
        self.symbol = np.zeros(1 << longest, np.uint32)
        self.step = np.zeros(1 << longest, np.int64)
        # A code of n bits takes all look-ups that begin with it.
        room = np.int64(1) << (longest - n)
        low = np.cumsum(room) - room
        self.bits[ids], self.code[ids] = n, low >> (longest - n)
        self.symbol[: room.sum()] = np.repeat(ids, room)
        self.step[: room.sum()] = np.repeat(n, room)

    def encode(self, ids: np.ndarray) -> tuple[bytes, np.ndarray]:
        """The bits, highest first, and the bit offset of every ``STRIDE``-th id."""
        n = self.bits[ids].astype(np.int64)
        ends = np.cumsum(n)
        at = ends - n
        total = int(ends[-1]) if len(ids) else 0
        # Every code lies in one or two 32-bit words; codes of a word do not overlap.
        wide = self.code[ids] << (64 - n - (at & 31)).astype(np.uint64)
        words = np.zeros(total // 32 + 3, np.uint64)
        if len(ids):
            word = at >> 5
            first = np.flatnonzero(np.r_[True, word[1:] != word[:-1]])
            words[word[first]] += np.add.reduceat(wide >> np.uint64(32), first)
            words[word[first] + 1] += np.add.reduceat(wide & np.uint64(0xFFFFFFFF), first)
        return words.astype(">u4").tobytes(), at[::STRIDE]

    def decode(self, bits: bytes, offsets: np.ndarray, n: int) -> np.ndarray:
        """The ``n`` ids, one lane for each checkpoint."""
        words = np.frombuffer(bits, ">u4").astype(np.uint64)
        pair = (words[:-1] << np.uint64(32)) | words[1:]
        at = offsets.astype(np.int64).copy()
        lanes = len(at)
        out = np.zeros((STRIDE, lanes), np.uint32)
        last = n - (lanes - 1) * STRIDE
        drop, mask = np.uint64(64 - self.longest), np.uint64((1 << self.longest) - 1)
        for k in range(STRIDE):
            if k == last:  # the last lane is shorter
                at, lanes = at[:-1], lanes - 1
                if lanes == 0:
                    break
            window = (pair[at >> 5] >> (drop - (at & 31).astype(np.uint64))) & mask
            out[k, :lanes] = self.symbol[window]
            at = at + self.step[window]
        return out.T.reshape(-1)[:n]


def _id_counts(ids: DataFrame) -> dict[int, int]:
    def run(batches):
        total = np.zeros(0, np.int64)
        for b in batches:
            for some in runs([len(x) for x in b["ids"]], RUN_IDS):
                got = np.bincount(np.concatenate([unpacked(x) for x in b["ids"][some]]))
                if len(got) > len(total):
                    got[: len(total)] += total
                    total = got
                else:
                    total[: len(got)] += got
        some = np.flatnonzero(total)
        yield {"id": some.tolist(), "n": total[some].tolist()}

    rows = by_batch(ids.select("ids"), "id long, n long", run).groupBy("id").agg(F.sum("n").alias("n")).collect()
    return {r.id: r.n for r in rows}


def write(docs: DataFrame, path: str, vocabulary: str, end_id: int = 2) -> None:
    """Write the file set of ``docs`` to ``path``."""
    spark = docs.sparkSession
    ids = written(encoded(docs, vocabulary, end_id), "ids")
    counts = _id_counts(ids)
    # More ids than LONGEST bits tell apart need longer codes.
    longest = max(LONGEST, (len(counts) - 1).bit_length())
    lengths = code_lengths(counts, longest)
    spark.createDataFrame(sorted(lengths.items()), "id int, bits int").coalesce(1).write.parquet(f"{path}/codebook")

    total = ids.agg(F.sum("n_tokens")).first()[0] or 0
    parts = max(1, -(-total // RANGE_TOKENS))
    shared = spark.sparkContext.broadcast(lengths)

    def blocks(batches):
        from pyspark import TaskContext

        part, book = TaskContext.get().partitionId(), Codebook(shared.value, longest)
        held, size, at, number = [], 0, 0, 0

        def block():
            ids = np.concatenate([x for _, x in held])
            bits, offsets = book.encode(ids)
            return {
                "part": [part],
                "block": [number],
                "start": [at],
                "n_tokens": [size],
                "doc_ids": [[d for d, _ in held]],
                "sizes": [[len(x) for _, x in held]],
                "bits": [bits],
                "offsets": [offsets],
            }

        for b in batches:
            for doc_id, ids in zip(b["doc_id"], b["ids"]):
                if size >= BLOCK_TOKENS:
                    yield block()
                    at, number = at + size, number + 1
                    held, size = [], 0
                held.append((doc_id, unpacked(ids)))
                size += len(held[-1][1])
        if held:
            yield block()

    ordered = ids.select("doc_id", "place", "ids").repartitionByRange(parts, F.asc_nulls_first("doc_id"))
    by_batch(
        ordered.sortWithinPartitions(F.asc_nulls_first("doc_id"), "place").select("doc_id", "ids"),
        "part int, block int, start long, n_tokens long, doc_ids array<long>, sizes array<long>, "
        "bits binary, offsets array<long>",
        blocks,
    ).write.parquet(f"{path}/blocks")
    before = W.orderBy("part").rowsBetween(W.unboundedPreceding, -1)
    (
        spark.read.parquet(f"{path}/blocks")
        .groupBy("part")
        .agg(F.sum("n_tokens").alias("n_tokens"))
        .select("part", F.coalesce(F.sum("n_tokens").over(before), F.lit(0)).alias("base"))
        .write.parquet(f"{path}/parts")
    )
    released(ids)


def read(spark: SparkSession, path: str) -> DataFrame:
    """(doc_id, start, n_tokens, ids) of a file set; ids as little-endian 32-bit integers."""
    lengths = {r.id: r.bits for r in spark.read.parquet(f"{path}/codebook").collect()}
    shared = spark.sparkContext.broadcast(lengths)
    longest = max(LONGEST, *lengths.values()) if lengths else LONGEST

    def run(batches):
        book = Codebook(shared.value, longest)
        for b in batches:
            for start, doc_ids, sizes, bits, offsets in zip(
                b["start"], b["doc_ids"], b["sizes"], b["bits"], b["offsets"]
            ):
                ids = book.decode(bits, np.array(offsets), sum(sizes)).astype("<u4")
                ends = np.cumsum(sizes)
                yield {
                    "doc_id": doc_ids,
                    "start": (start + ends - sizes).tolist(),
                    "n_tokens": sizes,
                    "ids": [ids[e - n : e].tobytes() for e, n in zip(ends.tolist(), sizes)],
                }

    blocks = spark.read.parquet(f"{path}/blocks").join(spark.read.parquet(f"{path}/parts"), "part")
    blocks = blocks.withColumn("start", F.col("start") + F.col("base")).drop("base", "n_tokens")
    return by_batch(
        blocks, "doc_id long, start long, n_tokens long, ids binary", run
    )


def digest(rows: DataFrame) -> DataFrame:
    return rows.select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))
