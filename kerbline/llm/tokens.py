"""Byte-level BPE with content-defined chunks that documents share.

``load`` reads a public vocabulary file and encodes as the tokenizers library does. The fast
encoder works on the same vocabulary and merge order; runs of white space too long for its
pattern matcher go to the tokenizers library itself. ``tests/llm`` compares the two over every
code point.

``encode_documents`` reuses chunks: a rolling hash cuts a text where its content says so, so that
shared passages give equal chunks. Rows are dealt by their smallest chunk hash, which brings
copies and near copies to one task (a large group is split), and a task encodes each chunk once.
White space after another character always starts a new word, so a chunk's core, from its first
such place to its last, has the same ids in any text. Around a join the text is encoded anew from
the last safe place before it to the first one after it; where a chunk has no safe place, the
window grows into the next chunk until both ends agree. Every result is decoded and compared.
"""

from __future__ import annotations

import hashlib
import json
import re
from functools import lru_cache

import numpy as np
import public_tokenizers
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from kerbline.llm.wordhash import pieces, text_buffers

VOCABULARY = public_tokenizers.path("byte_bpe_50k.json")
LONG_BLANK = re.compile(r"\s{20000}")
_SPLIT = public_tokenizers.PATTERN
WINDOW = 32
MASK_BITS = 10
LEAST, MOST = 256, 8192
CACHE_BYTES = 64 << 20
_G = 0x9E3779B97F4A7C15 | 1
# Bytes from 0x80 on may end a Unicode blank, so only printable ASCII counts as "no blank".
_SAFE = re.compile(rb"(?<=[!-~])[ \n]")


class Codec:
    """Encoder and decoder of one vocabulary file."""

    def __init__(self, path: str):
        import tiktoken
        from tokenizers import Tokenizer

        self.plain = Tokenizer.from_file(path)
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        # The printable stand-ins of bytes: printable Latin-1 stays, others follow from 256 on.
        shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
        hidden = [b for b in range(256) if b not in shown]
        byte_of = {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(hidden)}
        ranks = {bytes(byte_of[c] for c in word): i for word, i in spec["model"]["vocab"].items() if word not in special}
        self.fast = tiktoken.Encoding("public", pat_str=_SPLIT, mergeable_ranks=ranks, special_tokens=special)
        self.special = re.compile("|".join(map(re.escape, special))) if special else None
        self.table = [b""] * (max([*ranks.values(), *special.values()]) + 1)
        for word, i in [*ranks.items(), *((k.encode(), i) for k, i in special.items())]:
            self.table[i] = word
        self.decimal = [str(i) for i in range(len(self.table))]

    def encode(self, text: str) -> list[int]:
        if len(text) >= 20000 and LONG_BLANK.search(text):
            return self.plain.encode(text, add_special_tokens=False).ids
        if self.special and self.special.search(text):
            return self.fast.encode(text, allowed_special="all")
        return self.fast.encode_ordinary(text)

    def digest(self, ids: list[int]) -> str:
        """SHA-256 of the decimal ids joined by commas."""
        return hashlib.sha256(",".join(map(self.decimal.__getitem__, ids)).encode()).hexdigest()

    def decode(self, ids: list[int]) -> bytes:
        return b"".join(map(self.table.__getitem__, ids))


@lru_cache(maxsize=2)
def load(path: str) -> Codec:
    return Codec(path)


@lru_cache(maxsize=1)
def _rolling():
    block = 1 << 20
    with np.errstate(over="ignore"):
        powers = np.full(block, _G, dtype=np.uint64)
        powers[0] = 1
        powers = np.cumprod(powers, dtype=np.uint64)
        inverse = np.full(block, pow(_G, -1, 1 << 64), dtype=np.uint64)
        inverse[0] = 1
        inverse = np.cumprod(inverse, dtype=np.uint64)
    return powers, inverse, np.random.default_rng(5).integers(1, 1 << 63, 256, dtype=np.uint64)


def cuts(data: np.ndarray) -> np.ndarray:
    """Ends of the content-defined chunks of a text's bytes, on character starts."""
    powers, inverse, table = _rolling()
    n, found, at = len(data), [], 0
    while at + WINDOW <= n:
        part = data[at : at + len(powers)]
        sums = np.zeros(len(part) + 1, dtype=np.uint64)
        with np.errstate(over="ignore"):
            np.cumsum(table[part] * inverse[: len(part)], out=sums[1:])
            rolled = (sums[WINDOW:] - sums[:-WINDOW]) * powers[: len(part) - WINDOW + 1]
        found.append(np.flatnonzero(rolled >> np.uint64(64 - MASK_BITS) == 0) + at + WINDOW)
        at += len(part) - WINDOW + 1
    ends, last = [], 0
    for p in np.concatenate(found).tolist() if found else []:
        while p - last > MOST:
            last = _char(data, last + MOST)
            ends.append(last)
        if p - last >= LEAST and p < n:
            last = _char(data, p)
            ends.append(last)
    while n - last > MOST:
        last = _char(data, last + MOST)
        ends.append(last)
    if not ends or ends[-1] < n:
        ends.append(n)
    return np.array(ends, dtype=np.int32)


def _char(data: np.ndarray, p: int) -> int:
    while p < len(data) and data[p] & 0xC0 == 0x80:
        p += 1
    return p


def _plan(batches):
    """Add the chunk ends and the smallest chunk hash."""
    for batch in batches:
        for part in pieces(batch, "text"):
            data, offsets = text_buffers(part.column("text"))
            ends, keys = [], []
            for i in range(part.num_rows):
                own = data[offsets[i] : offsets[i + 1]]
                ends.append(cuts(own) if len(own) else np.zeros(0, np.int32))
                raw, low = own.tobytes(), 0
                least = (1 << 63) - 1
                for e in ends[-1].tolist():
                    least = min(least, int.from_bytes(hashlib.blake2b(raw[low:e], digest_size=8).digest(), "little", signed=True))
                    low = e
                keys.append(least)
            lists = pa.ListArray.from_arrays(np.concatenate([[0], np.cumsum([len(e) for e in ends])]).astype(np.int32), np.concatenate(ends).astype(np.int32))
            yield pa.RecordBatch.from_arrays([part.column("doc_id"), part.column("text"), lists, pa.array(keys, pa.int64())], names=["doc_id", "text", "ends", "key"])


class ChunkEncoder:
    """Encodes chunks once and repairs their joins; the store of chunks is bounded in bytes."""

    def __init__(self, codec: Codec, most: int = CACHE_BYTES):
        self.codec, self.most = codec, most
        self.store: dict[bytes, tuple[int, int, list[int]]] = {}
        self.held = self.reused = 0

    def core(self, chunk: bytes) -> tuple[int, int, list[int]]:
        """(first safe place, last safe place, ids between); none: both are the chunk's size."""
        got = self.store.get(chunk)
        if got is not None:
            self.reused += 1
            return got
        first = _SAFE.search(chunk)
        if first is None:
            got = (len(chunk), len(chunk), [])
        else:
            low = first.start()
            high = low
            p = len(chunk)
            while (p := max(chunk.rfind(b" ", 0, p), chunk.rfind(b"\n", 0, p))) > low:
                if _SAFE.match(chunk, p):
                    high = p
                    break
            got = (low, high, self.codec.fast.encode_ordinary(chunk[low:high].decode()) if high > low else [])
        size = len(chunk) + 40 * len(got[2]) + 200
        if self.held + size > self.most:
            self.store.clear()
            self.held = 0
        self.store[chunk] = got
        self.held += size
        return got

    def encode(self, text: str, ends: list[int]) -> tuple[list[int], bytes]:
        """The ids and what they decode to."""
        if self.codec.special and self.codec.special.search(text) or len(text) >= 20000 and LONG_BLANK.search(text):
            ids = self.codec.encode(text)
            return ids, self.codec.decode(ids)
        raw, ids, open_at, low = text.encode(), [], 0, 0
        for e in ends:
            first, last, core = self.core(raw[low:e])
            if first < e - low:
                # The join from the last safe place before to the first one here.
                ids += self.codec.fast.encode_ordinary(raw[open_at : low + first].decode())
                ids += core
                open_at = low + last
            low = e
        ids += self.codec.fast.encode_ordinary(raw[open_at:].decode())
        if (decoded := self.codec.decode(ids)) != raw:
            raise ValueError("joined chunks do not decode to the text")
        return ids, decoded


def _encode(path: str, whole: bool):
    def run(batches):
        encoder = ChunkEncoder(load(path))
        for batch in batches:
            texts, ends = batch.column("text"), batch.column("ends")
            for low in range(0, batch.num_rows, 256):
                rows = range(low, min(low + 256, batch.num_rows))
                done = [encoder.encode(texts[i].as_py() or "", ends[i].as_py()) for i in rows]
                columns = {"doc_id": batch.column("doc_id").slice(low, len(rows))}
                if whole:
                    columns["ids"] = pa.array([ids for ids, _ in done], pa.list_(pa.int32()))
                    columns["decoded"] = pa.array([raw.decode("utf-8", "replace") for _, raw in done], pa.string())
                else:
                    columns["n_tokens"] = pa.array([len(ids) for ids, _ in done], pa.int64())
                    columns["ids_sha256"] = pa.array([encoder.codec.digest(ids) for ids, _ in done])
                    columns["decoded_sha256"] = pa.array([hashlib.sha256(raw.decode("utf-8", "replace").encode()).hexdigest() for _, raw in done])
                yield pa.RecordBatch.from_pydict(columns)

    return run


def _dealt(docs: DataFrame) -> DataFrame:
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    planned = rows.mapInArrow(_plan, "doc_id long, text string, ends array<int>, key long")
    return planned.hint("rebalance", F.col("key"))


def encode_documents(docs: DataFrame, path: str = VOCABULARY) -> DataFrame:
    """(doc_id, ids, decoded) of each row; null text has no ids."""
    return _dealt(docs).mapInArrow(_encode(path, True), "doc_id long, ids array<int>, decoded string")


def encode_digests(docs: DataFrame, path: str = VOCABULARY) -> DataFrame:
    """(doc_id, n_tokens, ids_sha256, decoded_sha256) of each row, without storing the ids."""
    return _dealt(docs).mapInArrow(_encode(path, False), "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")
