"""Alignment of two tokenizers' tokens by diagonal run skipping.

Both token sequences of a text are turned into arrays of byte ends. Places where both end cut
the tokens into groups. ``common_ends`` walks the two arrays at the current shift between their
indices: windows of doubling length are compared at once, which jumps stretches where one token
meets one token. At a difference the side that is behind moves on until the ends meet again,
which closes an irregular group and sets the new shift. Many places of a batch are walked side by
side, as lanes of one array.

Links are all pairs of tokens that share a group. A pair of ids counts in how many documents it
is linked: documents give their distinct pairs, tasks add them up before the shuffle. The most
frequent pairs (at most ``HOT``) go to every task as one array, which takes the hot keys out of
the join; all other pairs are joined by shuffle, so no table has to fit in memory.

Defined cases: texts that are null or empty, or that a tokenizer does not give back byte by byte,
have no tokens, zeros and an empty digest. Repeated rows are documents of their own, as are rows
without an id. Special tokens inside texts are plain text. Groups of any size are exact: a large
one adds its distinct ids and how often they occur, not its pairs one by one. Only the two named
columns are read, so other columns never clash. An empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
import re
from array import array
from functools import lru_cache

import numpy as np
import public_tokenizers
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from kerbline.llm.tokens import LONG_BLANK, VOCABULARY, load
from kerbline.llm.wordhash import pieces
from kerbline.scale import settle

PIECES = public_tokenizers.path("piece_bpe_32k.model")
# Pairs that are sent to every task; their number bounds what is sent (13 bytes each).
HOT = 1 << 17
# Tokens between two lanes of a batch, and the width of the first window.
LANE = 64
PROBE = 8
# Groups with more links than this are added up by distinct ids.
WIDE = 4096


class Encoder:
    """Ids of both tokenizers and the byte length of every id."""

    def __init__(self, path_a: str, path_b: str):
        from sentencepiece import SentencePieceProcessor
        from tokenizers import Tokenizer

        self.a = load(path_a)
        self.plain = Tokenizer.from_file(path_a)
        self.plain.encode_special_tokens = True
        self.b = SentencePieceProcessor(model_file=path_b)
        byte = re.compile("<0x([0-9A-F]{2})>")
        self.bytes_b = []
        for i in range(self.b.get_piece_size()):
            piece = self.b.id_to_piece(i)
            self.bytes_b.append(bytes([int(byte.fullmatch(piece)[1], 16)]) if self.b.is_byte(i) else piece.replace("▁", " ").encode())
        self.sizes_a = np.array([len(x) for x in self.a.table], dtype=np.int64)
        self.sizes_b = np.array([len(x) for x in self.bytes_b], dtype=np.int64)

    def encode_a(self, text: str) -> list[int]:
        if len(text) >= 20000 and LONG_BLANK.search(text):
            return self.plain.encode(text, add_special_tokens=False).ids
        return self.a.fast.encode_ordinary(text)

    def encode(self, texts: list[str | None]) -> list[tuple[bytes, bytes]]:
        """32-bit ids of blank + text by both; empty if a tokenizer does not give it back."""
        out = []
        for text, b in zip(texts, self.b.encode([t or "" for t in texts], num_threads=1), strict=True):
            a = self.encode_a(f" {text}") if text else []
            raw = f" {text}".encode()
            if text and self.a.decode(a) == raw and b"".join(map(self.bytes_b.__getitem__, b)) == raw:
                out.append((array("i", a).tobytes(), array("i", b).tobytes()))
            else:
                out.append((b"", b""))
        return out


@lru_cache(maxsize=2)
def encoder(path_a: str, path_b: str) -> Encoder:
    return Encoder(path_a, path_b)


def _leading(a: np.ndarray, b: np.ndarray, i: np.ndarray, j: np.ndarray, width: int) -> np.ndarray:
    """For each lane how many ends agree from (i, j) on, up to ``width``."""
    ahead = np.arange(width)
    same = a[np.minimum(i[:, None] + ahead, len(a) - 1)] == b[np.minimum(j[:, None] + ahead, len(b) - 1)]
    return np.where(same.all(axis=1), width, same.argmin(axis=1))


def common_ends(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each group the number of tokens of ``a`` and of ``b`` up to its end.

    Both arrays of ends rise strictly and end alike. Lanes start at ends that both have and walk
    side by side: each compares a window at its shift, with twice the width after a full match,
    and where nothing agrees the side that is behind moves on by one token.
    """
    n = len(a)
    if n == 0:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    # Unequal marks behind the last tokens.
    a, b = np.append(a, -1), np.append(b, -2)
    mark_a, mark_b = np.zeros(n, bool), np.zeros(len(b) - 1, bool)
    tries = np.arange(LANE, n, LANE)
    at = np.searchsorted(b[:-1], a[tries])
    start = b[at] == a[tries]
    i = np.concatenate([[0], tries[start] + 1])
    j = np.concatenate([[0], at[start] + 1])
    stop = np.append(i[1:], n)

    def forward(lanes, run):
        """Mark the ends that agree and move the lanes behind them."""
        place = np.arange(run.sum()) - np.repeat(np.cumsum(run) - run, run)
        mark_a[np.repeat(i[lanes], run) + place] = True
        mark_b[np.repeat(j[lanes], run) + place] = True
        i[lanes] += run
        j[lanes] += run

    live = np.arange(len(i))
    while len(live):
        run = _leading(a, b, i[live], j[live], PROBE)
        forward(live, run)
        full, width = live[run == PROBE], 2 * PROBE
        while len(full):
            full = full[i[full] < stop[full]]
            more = _leading(a, b, i[full], j[full], width)
            forward(full, more)
            full, width = full[more == width], 2 * width
        live = live[i[live] < stop[live]]
        x, y = a[i[live]], b[j[live]]
        i[live[x < y]] += 1
        j[live[x > y]] += 1
    return np.flatnonzero(mark_a) + 1, np.flatnonzero(mark_b) + 1


class Aligned:
    """Groups of a batch of documents that follow each other in one pair of arrays."""

    def __init__(self, enc: Encoder, texts: list[str | None]):
        encoded = enc.encode(texts)
        self.a = np.frombuffer(b"".join([x for x, _ in encoded]), np.int32)
        self.b = np.frombuffer(b"".join([y for _, y in encoded]), np.int32)
        self.n_a = np.array([len(x) // 4 for x, _ in encoded], dtype=np.int64)
        self.n_b = np.array([len(y) // 4 for _, y in encoded], dtype=np.int64)
        # A document ends both arrays, so the batch is walked as one text.
        self.end_a, self.end_b = common_ends(np.cumsum(enc.sizes_a[self.a]), np.cumsum(enc.sizes_b[self.b]))
        self.size_a = np.diff(self.end_a, prepend=0)
        self.size_b = np.diff(self.end_b, prepend=0)
        # Documents as runs of groups.
        self.last = np.searchsorted(self.end_a, np.cumsum(self.n_a), side="right")
        self.groups = np.diff(self.last, prepend=0)
        self.doc = np.repeat(np.arange(len(texts)), self.groups)

    def link_counts(self) -> np.ndarray:
        """Links of each document."""
        total = np.concatenate([[0], np.cumsum(self.size_a * self.size_b)])
        return total[self.last] - total[self.last - self.groups]

    def pairs(self, width: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(document, pair, occurrences), sorted: the distinct pairs of each document."""
        links = self.size_a * self.size_b
        small = links <= WIDE
        # Each token of A meets all tokens of B of its group.
        times = np.repeat(np.where(small, self.size_b, 0), self.size_a)
        left = np.repeat(np.arange(len(self.a)), times)
        start_b = np.repeat(np.repeat(self.end_b - self.size_b, self.size_a), times)
        within = np.arange(len(left)) - np.repeat(np.cumsum(times) - times, times)
        docs = np.repeat(np.repeat(self.doc, self.size_a), times)
        keys = docs << 31 | self.a[left].astype(np.int64) * width + self.b[start_b + within]
        weights = None
        wide = np.flatnonzero(~small)
        if len(wide):
            parts, extra = [keys], [np.ones(len(keys), np.int64)]
            for g in wide.tolist():
                x, nx = np.unique(self.a[self.end_a[g] - self.size_a[g] : self.end_a[g]], return_counts=True)
                y, ny = np.unique(self.b[self.end_b[g] - self.size_b[g] : self.end_b[g]], return_counts=True)
                parts.append((int(self.doc[g]) << 31 | x.astype(np.int64)[:, None] * width + y).ravel())
                extra.append((nx[:, None] * ny).ravel())
            keys, weights = np.concatenate(parts), np.concatenate(extra)
        if weights is None:
            found, counts = np.unique(keys, return_counts=True)
        else:
            found, back = np.unique(keys, return_inverse=True)
            counts = np.zeros(len(found), np.int64)
            np.add.at(counts, back, weights)
        return found >> 31, (found & (1 << 31) - 1).astype(np.int32), counts

    def written(self, digits: tuple[np.ndarray, np.ndarray]) -> list[bytes]:
        """``a1,a2|b1;a3|b2,b3`` of each document."""
        n = len(self.a) + len(self.b)
        if n == 0:
            return [b""] * len(self.n_a)
        shift_a = np.repeat(self.end_b - self.size_b, self.size_a)
        shift_b = np.repeat(self.end_a, self.size_b)
        mark_a, mark_b = np.zeros(len(self.a), np.int64), np.zeros(len(self.b), np.int64)
        mark_a[self.end_a - 1] = 1
        mark_b[self.end_b - 1] = 1
        out = np.empty(n, dtype=digits[0].dtype)
        out[np.arange(len(self.a)) + shift_a] = digits[0][self.a * 2 + mark_a]
        out[np.arange(len(self.b)) + shift_b] = digits[1][self.b * 2 + mark_b]
        chars = out.view(np.uint8).reshape(n, -1)
        real = chars != 0
        ends = np.cumsum(np.concatenate([[0], real.sum(axis=1)]))
        raw = chars[real].tobytes()
        cut = ends[np.cumsum(self.n_a + self.n_b)]
        lows = np.concatenate([[0], cut[:-1]])
        return [raw[x : y - 1] if y > x else b"" for x, y in zip(lows.tolist(), cut.tolist(), strict=True)]


def _digits(n: int, inner: str, last: str) -> np.ndarray:
    """Decimal ids with the mark that follows inside (even places) and at the end of a group (odd)."""
    return np.array([f"{i}{m}" for i in range(n) for m in (inner, last)], dtype="S")


@lru_cache(maxsize=2)
def _tables(path_a: str, path_b: str) -> tuple[np.ndarray, np.ndarray]:
    enc = encoder(path_a, path_b)
    a, b = _digits(len(enc.sizes_a), ",", "|"), _digits(len(enc.sizes_b), ",", ";")
    width = max(a.dtype.itemsize, b.dtype.itemsize)
    return a.astype(f"S{width}"), b.astype(f"S{width}")


def _pack(keys: np.ndarray, times: np.ndarray) -> bytes:
    """Rising 32-bit pairs and their occurrences, compressed."""
    raw = np.diff(keys, prepend=np.int32(0)).astype(np.int32).tobytes() + times.astype(np.int32).tobytes()
    return len(keys).to_bytes(4, "little") + pa.compress(raw, codec="zstd", asbytes=True)


def _unpack(blob: bytes) -> tuple[np.ndarray, np.ndarray]:
    n = int.from_bytes(blob[:4], "little")
    raw = np.frombuffer(pa.decompress(blob[4:], decompressed_size=8 * n, codec="zstd"), np.int32)
    return np.cumsum(raw[:n], dtype=np.int64).astype(np.int32), raw[n:]


_COUNTS = "doc_id long, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, links binary"


def _summaries(path_a: str, path_b: str):
    """One row a document: counts, digest and its distinct pairs."""

    def run(batches):
        enc, digits = encoder(path_a, path_b), _tables(path_a, path_b)
        width = len(enc.sizes_b)
        for batch in batches:
            for part in pieces(batch, "text", 1 << 20):
                found = Aligned(enc, part.column("text").to_pylist())
                docs, keys, times = found.pairs(width)
                at = np.searchsorted(docs, np.arange(part.num_rows + 1))
                blobs = [_pack(keys[x:y], times[x:y]) for x, y in zip(at[:-1].tolist(), at[1:].tolist(), strict=True)]
                digests = [hashlib.sha256(w).hexdigest() if w else "" for w in found.written(digits)]
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), *[pa.array(x, pa.int64()) for x in (found.n_a, found.n_b, found.groups, found.link_counts())], pa.array(digests, pa.string()), pa.array(blobs, pa.binary())],
                    names=["doc_id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256", "links"],
                )

    return run


def _whole(path_a: str, path_b: str):
    def run(batches):
        enc = encoder(path_a, path_b)
        lists = lambda flat, sizes: pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32)), pa.array(flat.astype(np.int32)))
        for batch in batches:
            for part in pieces(batch, "text", 1 << 20):
                f = Aligned(enc, part.column("text").to_pylist())
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), lists(f.a, f.n_a), lists(f.b, f.n_b), lists(f.size_a, f.groups), lists(f.size_b, f.groups)],
                    names=["doc_id", "a_ids", "b_ids", "a_sizes", "b_sizes"],
                )

    return run


def _rows(docs: DataFrame) -> DataFrame:
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))


def align(docs: DataFrame, path_a: str = VOCABULARY, path_b: str = PIECES) -> DataFrame:
    """(doc_id, a_ids, b_ids, a_sizes, b_sizes): both id lists, and how many of each every group takes."""
    schema = "doc_id long, a_ids array<int>, b_ids array<int>, a_sizes array<int>, b_sizes array<int>"
    return _rows(docs).mapInArrow(_whole(path_a, path_b), schema)


def pair_counts(aligned: DataFrame, width: int, most: int = 1 << 22) -> DataFrame:
    """(pair, df, best) over the documents' link columns; a pair is id of A times ``width`` plus id of B."""

    def count(batches):
        held, n = [], 0

        def total():
            keys, counts = np.unique(np.concatenate(held), return_counts=True)
            return pa.RecordBatch.from_arrays([pa.array(keys), pa.array(counts, pa.int64())], names=["pair", "n"])

        for batch in batches:
            for blob in batch.column("links"):
                held.append(_unpack(blob.as_py())[0])
                n += len(held[-1])
                if n >= most:
                    yield total()
                    held, n = [], 0
        if n:
            yield total()

    counts = settle(aligned.select("links").mapInArrow(count, "pair int, n long").groupBy("pair").agg(F.sum("n").alias("df")))
    a = F.floor(F.col("pair") / width)
    # Bounded: one row for each id of A.
    top = counts.groupBy(a.alias("a")).agg(F.max("df").alias("top"))
    return counts.withColumn("a", a).join(F.broadcast(top), "a").select("pair", "df", (F.col("df") == F.col("top")).alias("best"))


def align_counts(docs: DataFrame, path_a: str = VOCABULARY, path_b: str = PIECES, hot: int = HOT) -> DataFrame:
    """(doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256) of each row."""
    enc = encoder(path_a, path_b)
    width = len(enc.sizes_b)
    if width * len(enc.sizes_a) >= 1 << 31:
        raise ValueError("pairs of these vocabularies need more than 31 bits")
    aligned = _rows(docs).mapInArrow(_summaries(path_a, path_b), _COUNTS)
    # The row number is stored with the row, so it stays the same if a task runs again.
    aligned = settle(aligned.withColumn("row", F.monotonically_increasing_id()))
    table = settle(pair_counts(aligned, width))
    # Bounded: at most ``hot`` rows.
    first = table.orderBy(F.desc("df"), "pair").limit(hot).toPandas().sort_values("pair")
    pairs, dfs, bests = first["pair"].to_numpy(np.int32), first["df"].to_numpy(np.int64), first["best"].to_numpy(bool)

    def known(batches):
        for batch in batches:
            best, total, keys_left, times_left = [], [], [], []
            for blob in batch.column("links"):
                keys, times = _unpack(blob.as_py())
                at = np.minimum(np.searchsorted(pairs, keys), max(0, len(pairs) - 1))
                hit = pairs[at] == keys if len(pairs) else np.zeros(len(keys), bool)
                at, n = at[hit], times[hit].astype(np.int64)
                best.append(int(n[bests[at]].sum()))
                total.append(int((n * dfs[at]).sum()))
                keys_left.append(keys[~hit])
                times_left.append(times[~hit])
            offsets = pa.array(np.concatenate([[0], np.cumsum([len(k) for k in keys_left])]).astype(np.int32))
            flat = [pa.array(np.concatenate([np.zeros(0, np.int32), *x])) for x in (keys_left, times_left)]
            kept = [batch.column(c) for c in ("row", "doc_id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256")]
            yield pa.RecordBatch.from_arrays(
                [*kept, pa.array(best, pa.int64()), pa.array(total, pa.int64()), *[pa.ListArray.from_arrays(offsets, x) for x in flat]],
                names=["row", "doc_id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256", "best", "total", "pairs", "times"],
            )

    schema = "row long, doc_id long, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, best long, total long, pairs array<int>, times array<int>"
    part = settle(aligned.mapInArrow(known, schema))
    rare = part.filter(F.size("pairs") > 0).select("row", F.explode(F.arrays_zip("pairs", "times")).alias("e")).select("row", F.col("e.pairs").alias("pair"), F.col("e.times").cast("long").alias("n"))
    added = (
        rare.join(table, "pair")
        .groupBy("row")
        .agg(F.sum(F.when(F.col("best"), F.col("n")).otherwise(0)).alias("more_best"), F.sum(F.col("n") * F.col("df")).alias("more"))
    )
    full = part.join(added, "row", "left")
    return full.select(
        "doc_id", "n_a", "n_b", "n_groups", "n_links",
        (F.col("best") + F.coalesce("more_best", F.lit(0))).alias("n_best"),
        (F.col("total") + F.coalesce("more", F.lit(0))).alias("count_sum"),
        "groups_sha256",
    )
