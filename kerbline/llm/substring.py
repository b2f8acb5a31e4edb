"""Repeated passages, found by anchors at difference-cover positions.

Windows of ``WINDOW`` words that occur earlier are removed. Hashing each window of each text
is avoided: with period 13 and cover {0, 1, 3, 9}, two equal runs of 20 words share an anchor of
8 words that starts at a cover position of both texts, whatever their alignment.

1. Anchors: hash 8 words at cover positions only (4 of 13).
2. An anchor met twice makes the 13 windows around it candidates; all others are unique.
3. Candidate windows are hashed in full (96 bits); all but the earliest are repeats.
4. The words that repeats cover are removed.

Before each exchange a batch keeps one place for each hash: places that repeat one of their own
batch need no partner. So a passage in a third of all texts is a place for each batch, not for each
text. Places travel packed by hash bucket, texts compressed by document bucket.

Defined cases: null and short texts have no window; a document is (id, text), so rows repeated
with both equal are one document and get equal results; one id with several texts is ordered by
16 bits of a hash of the text; a null id comes last.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, functions as F, types as T

from kerbline.llm.wordhash import mix, pieces, window_hash, words_of

WINDOW = 20
PERIOD = 13
COVER = (0, 1, 3, 9)
ANCHOR = WINDOW - PERIOD + 1
LAST_ID = (1 << 63) - 1

DOCS_A_BUCKET = 4_096
_PLACES = "bucket int, doc binary, sign binary, pos binary"
_ANCHORS = "bucket int, h binary, doc binary, sign binary, pos binary"
_WINDOWS = "bucket int, h binary, h2 binary, doc binary, sign binary, pos binary"


def _thin(values: np.ndarray) -> bytes:
    """Unsigned integers in the fewest bytes that hold the largest one."""
    width = next(w for w in (1, 2, 4, 8) if w == 8 or int(values.max(initial=0)) < 1 << (8 * w))
    return bytes([width]) + values.astype(f"<u{width}").tobytes()


def _thick(blob: bytes) -> np.ndarray:
    return np.frombuffer(blob, f"<u{blob[0]}", offset=1).astype(np.int64)


def _thin_ids(ids: np.ndarray) -> bytes:
    """Ascending ids as the first one and the steps."""
    return int(ids[0]).to_bytes(8, "little", signed=True) + _thin(np.diff(ids).view(np.uint64))


def _thick_ids(blob: bytes) -> np.ndarray:
    steps = np.concatenate([[int.from_bytes(blob[:8], "little", signed=True)], _thick(blob[8:])])
    return np.cumsum(steps.astype(np.int64))


def _dealt(bucket: np.ndarray, doc: np.ndarray, pos: np.ndarray, more: dict[str, np.ndarray], names: list[str]) -> pa.RecordBatch:
    """One row for each bucket with its places, packed; ``more`` columns travel as they are."""
    order = np.lexsort((pos, doc, bucket))
    bucket, doc, pos = bucket[order], doc[order], pos[order]
    more = {n: c[order] for n, c in more.items()}
    starts = np.flatnonzero(np.diff(bucket, prepend=-1))
    ends = np.append(starts[1:], len(bucket))
    spans = list(zip(starts.tolist(), ends.tolist(), strict=True))
    columns = {
        "bucket": pa.array(bucket[starts].astype(np.int32)),
        "doc": pa.array([_thin_ids(doc[a:b]) for a, b in spans], pa.binary()),
        "pos": pa.array([_thin(pos[a:b]) for a, b in spans], pa.binary()),
        **{n: pa.array([c[a:b].tobytes() for a, b in spans], pa.binary()) for n, c in more.items()},
    }
    # Places that need no partner have no hashes.
    return pa.RecordBatch.from_arrays([columns.get(n, pa.nulls(len(spans), pa.binary())) for n in names], names=names)


def _undealt(batches, kinds: dict[str, str]):
    """Columns doc, pos, known and ``kinds`` of all rows of one shuffle partition."""
    got: dict[str, list[np.ndarray]] = {n: [] for n in ("doc", "pos", "known", *kinds)}
    for batch in batches:
        for i in range(batch.num_rows):
            row = {n: batch.column(n)[i].as_py() for n in ("doc", "pos", *kinds)}
            got["doc"].append(_thick_ids(row["doc"]))
            got["pos"].append(_thick(row["pos"]))
            n = len(got["pos"][-1])
            got["known"].append(np.full(n, row.get("h") is None))
            for k, kind in kinds.items():
                got[k].append(np.zeros(n, kind) if row[k] is None else np.frombuffer(row[k], kind))
    return {k: np.concatenate(v) for k, v in got.items()} if got["doc"] else None


def _keys(part) -> tuple[np.ndarray, np.ndarray]:
    ids = pc.fill_null(part.column("doc_id"), LAST_ID).to_numpy(zero_copy_only=False)
    return ids, part.column("sign").to_numpy(zero_copy_only=False).astype("<u2")


def _home(doc: np.ndarray, sign: np.ndarray, buckets: int) -> np.ndarray:
    """The bucket of a document; the sign spreads rows without an id."""
    return mix(doc.astype(np.int64).view(np.uint64) ^ (sign.astype(np.uint64) << np.uint64(40))) % np.uint64(buckets)


def _anchor_rows(buckets: int):
    cover = np.zeros(PERIOD, dtype=bool)
    cover[list(COVER)] = True
    names = ["bucket", "h", "doc", "sign", "pos"]

    def run(batches):
        for batch in batches:
            for part in pieces(batch, "text", 16 << 20):
                ids, signs = _keys(part)
                w = words_of(part.column("text"))
                h, doc, sign, pos = [], [], [], []
                for i in range(len(ids)):
                    n = w.count(i)
                    if n < WINDOW:
                        continue
                    at = np.arange(n - ANCHOR + 1)
                    at = at[cover[at % PERIOD]]
                    h.append(window_hash(w.row(i), ANCHOR, at))
                    doc.append(np.full(len(at), ids[i], dtype=np.int64))
                    sign.append(np.full(len(at), signs[i], dtype="<u2"))
                    pos.append(at)
                if not h:
                    continue
                h, doc, sign, pos = (np.concatenate(c) for c in (h, doc, sign, pos))
                _, first, count = np.unique(h, return_index=True, return_counts=True)
                # Anchors repeated within the part are known; one of them still tells other parts.
                yield _dealt((h[first] >> np.uint64(16)) % np.uint64(buckets), doc[first], pos[first], {"h": h[first], "sign": sign[first]}, names)
                known = np.ones(len(h), dtype=bool)
                known[first[count == 1]] = False
                if known.any():
                    doc, sign, pos = doc[known], sign[known], pos[known]
                    yield _dealt(_home(doc, sign, buckets), doc, pos, {"sign": sign}, names)

    return run


def _met_twice(buckets: int):
    """Places of anchors whose hash is met again, by home bucket. Holds one shuffle partition."""

    def run(batches):
        got = _undealt(batches, {"h": "<u8", "sign": "<u2"})
        if got is None:
            return
        keep = got["known"].copy()
        fresh = np.flatnonzero(~keep)
        _, inverse, count = np.unique(got["h"][fresh], return_inverse=True, return_counts=True)
        keep[fresh[count[inverse] > 1]] = True
        doc, sign, pos = (got[n][keep] for n in ("doc", "sign", "pos"))
        if len(doc):
            yield _dealt(_home(doc, sign, buckets), doc, pos, {"sign": sign}, ["bucket", "doc", "sign", "pos"])

    return run


def _pack_docs(buckets: int):
    """Rows by home bucket, as compressed Arrow batches."""

    def run(batches):
        for batch in batches:
            for part in pieces(batch, "text", 16 << 20):
                home = _home(*_keys(part), buckets)
                order = np.argsort(home, kind="stable")
                part, home = part.take(pa.array(order)), home[order]
                starts = np.flatnonzero(np.diff(home.astype(np.int64), prepend=-1))
                blobs = []
                for a, b in zip(starts.tolist(), [*starts.tolist()[1:], len(home)], strict=True):
                    sink = pa.BufferOutputStream()
                    with pa.ipc.new_stream(sink, part.schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as out:
                        out.write_batch(part.slice(a, b - a))
                    blobs.append(sink.getvalue().to_pybytes())
                yield pa.RecordBatch.from_arrays([pa.array(home[starts].astype(np.int32)), pa.array(blobs, pa.binary())], names=["bucket", "rows"])

    return run


def _unpacked(docs: pa.Table, places: pa.Table):
    """(rows, places by document) of one bucket, a packed batch at a time."""
    found: dict[tuple[int, int], np.ndarray] = {}
    got = _undealt(places.to_batches(), {"sign": "<u2"})
    if got is not None:
        order = np.lexsort((got["pos"], got["sign"], got["doc"]))
        doc, sign, pos = (got[n][order] for n in ("doc", "sign", "pos"))
        new = np.ones(len(doc), dtype=bool)
        new[1:] = (doc[1:] != doc[:-1]) | (sign[1:] != sign[:-1])
        starts = np.flatnonzero(new).tolist()
        for a, b in zip(starts, [*starts[1:], len(doc)], strict=True):
            found[int(doc[a]), int(sign[a])] = pos[a:b]
    for blob in docs.column("rows").to_pylist():
        with pa.ipc.open_stream(blob) as stream:
            for batch in stream:
                yield batch, found


def _window_rows(buckets: int):
    names = ["bucket", "h", "h2", "doc", "sign", "pos"]

    def run(docs: pa.Table, places: pa.Table) -> pa.Table:
        h, h2, doc, sign, pos = [], [], [], [], []
        for part, found in _unpacked(docs, places):
            ids, signs = _keys(part)
            mine = [i for i in range(len(ids)) if (int(ids[i]), int(signs[i])) in found]
            part, ids, signs = part.take(pa.array(mine, pa.int64())), ids[mine], signs[mine]
            w = words_of(part.column("text"))
            for i in range(len(ids)):
                n = w.count(i)
                if n < WINDOW:
                    continue
                anchors = found[int(ids[i]), int(signs[i])]
                mark = np.zeros(n + PERIOD + 1, dtype=np.int32)
                anchors = anchors[anchors <= n - ANCHOR]
                np.add.at(mark, np.maximum(anchors - PERIOD + 1, 0), 1)
                np.add.at(mark, anchors + 1, -1)
                at = np.flatnonzero(np.cumsum(mark)[: n - WINDOW + 1] > 0)
                row = w.row(i)
                h.append(window_hash(row, WINDOW, at))
                h2.append((window_hash(row, WINDOW, at, seed=0x2545F491) >> np.uint64(32)).astype("<u4"))
                doc.append(np.full(len(at), ids[i], dtype=np.int64))
                sign.append(np.full(len(at), signs[i], dtype="<u2"))
                pos.append(at)
        out = []
        if h:
            # Dealt once for the whole document bucket, so there is a row for each pair of buckets at most.
            h, h2, doc, sign, pos = (np.concatenate(c) for c in (h, h2, doc, sign, pos))
            late = _not_earliest(h, h2, doc, sign, pos)
            for some, more in ((~late, {"h": h, "h2": h2}), (late, {})):
                if some.any():
                    bucket = (h >> np.uint64(16)) % np.uint64(buckets) if more else _home(doc, sign, buckets)
                    out.append(_dealt(bucket[some], doc[some], pos[some], {n: c[some] for n, c in {**more, "sign": sign}.items()}, names))
        return pa.Table.from_batches(out, pa.schema([("bucket", pa.int32()), *[(n, pa.binary()) for n in names[1:]]]))

    return run


def _not_earliest(h, h2, doc, sign, pos) -> np.ndarray:
    """Which windows are equal to one of an earlier place."""
    order = np.lexsort((pos, sign, doc, h2, h))
    a, b = order[1:], order[:-1]
    same = (h[a] == h[b]) & (h2[a] == h2[b])
    late = np.zeros(len(h), dtype=bool)
    # A row whose place is that of the earliest is the same window of a repeated row.
    start = np.concatenate([[True], ~same]) if len(h) else np.zeros(0, bool)
    group = np.cumsum(start) - 1
    head = order[np.flatnonzero(start)][group] if len(h) else order
    late[order] = ~((doc[order] == doc[head]) & (sign[order] == sign[head]) & (pos[order] == pos[head]))
    return late


def _repeats(buckets: int):
    """Places of windows that start earlier elsewhere, by home bucket. Holds one shuffle partition."""

    def run(batches):
        got = _undealt(batches, {"h": "<u8", "h2": "<u4", "sign": "<u2"})
        if got is None:
            return
        late = got["known"].copy()
        fresh = np.flatnonzero(~late)
        late[fresh] = _not_earliest(*[got[n][fresh] for n in ("h", "h2", "doc", "sign", "pos")])
        doc, sign, pos = (got[n][late] for n in ("doc", "sign", "pos"))
        if len(doc):
            yield _dealt(_home(doc, sign, buckets), doc, pos, {"sign": sign}, ["bucket", "doc", "sign", "pos"])

    return run


def _strip(keep_text: bool):
    """Words without the covered ones: counts, hash and, if asked for, the text."""

    def run(docs: pa.Table, places: pa.Table) -> pa.Table:
        done = []
        for batch, found in _unpacked(docs, places):
            texts = batch.column("text")
            ids, signs = _keys(batch)
            total, removed, last = [], [], []
            for i in range(batch.num_rows):
                text = texts[i].as_py()
                raw = (text or "").encode()
                words = raw.split()
                starts = found.get((int(ids[i]), int(signs[i])), np.zeros(0, np.int64))
                gone = np.zeros(len(words) + 1, dtype=np.int32)
                starts = starts[starts <= len(words) - WINDOW]
                np.add.at(gone, starts, 1)
                np.add.at(gone, starts + WINDOW, -1)
                gone = np.cumsum(gone)[:-1] > 0
                n = int(gone.sum())
                total.append(len(words))
                removed.append(n)
                if keep_text:
                    last.append(text if n == 0 else _without(raw, gone))
                else:
                    kept = [w for w, g in zip(words, gone, strict=True) if not g] if n else words
                    last.append(hashlib.sha256(b" ".join(kept)).hexdigest())
            if keep_text:
                columns = {"row": batch.column("row"), "text": pa.array(last, pa.string())}
            else:
                columns = {"doc_id": batch.column("doc_id"), "n_words": pa.array(total, pa.int64()), "n_removed": pa.array(removed, pa.int64()), "kept_sha256": pa.array(last, pa.string())}
            done.append(pa.RecordBatch.from_pydict(columns))
        if done:
            return pa.Table.from_batches(done)
        names = ("row", "text") if keep_text else ("doc_id", "n_words", "n_removed", "kept_sha256")
        return pa.table({n: pa.nulls(0) for n in names})

    return run


def _without(raw: bytes, gone: np.ndarray) -> str:
    """The text without the words marked; what stays keeps its own separators."""
    w = words_of(pa.array([raw.decode()]))
    spans, at = [], 0
    for k in np.flatnonzero(gone):
        spans.append(raw[at : w.starts[k]])
        at = int(w.starts[k + 1]) if k + 1 < len(w.starts) else len(raw)
    spans.append(raw[at:])
    return b"".join(spans).decode()


def _stripped(docs: DataFrame, keep_text: bool, schema) -> DataFrame:
    """Find the repeats of (doc_id, text, ...) rows and cut them out."""
    signed = docs.withColumn("sign", F.pmod(F.xxhash64(F.coalesce("text", F.lit(""))), F.lit(1 << 16)).cast("int"))
    # Buckets hold about as much whatever the size of the table.
    least = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    buckets = max(least, -(-docs.count() // DOCS_A_BUCKET))
    narrow = signed.select("doc_id", "text", "sign")
    anchors = narrow.mapInArrow(_anchor_rows(buckets), _ANCHORS)
    met = anchors.repartition(buckets, "bucket").mapInArrow(_met_twice(buckets), _PLACES)
    packed = "bucket int, rows binary"
    near = narrow.mapInArrow(_pack_docs(buckets), packed).groupBy("bucket").cogroup(met.groupBy("bucket"))
    windows = near.applyInArrow(_window_rows(buckets), _WINDOWS)
    late = windows.repartition(buckets, "bucket").mapInArrow(_repeats(buckets), _PLACES)
    return signed.mapInArrow(_pack_docs(buckets), packed).groupBy("bucket").cogroup(late.groupBy("bucket")).applyInArrow(_strip(keep_text), schema)


def removed_words(docs: DataFrame) -> DataFrame:
    """(doc_id, n_words, n_removed, kept_sha256) of each row."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return _stripped(rows, False, "doc_id long, n_words long, n_removed long, kept_sha256 string")


def without_repeats(docs: DataFrame) -> DataFrame:
    """The rows with repeated passages cut out of ``text``; other columns stay as they are."""
    others = [c for c in docs.columns if c != "text"]
    kept = F.struct(*[F.col(f"`{c}`") for c in others]).alias("row")
    rows = docs.select(kept, F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    schema = T.StructType([T.StructField("row", rows.schema["row"].dataType), T.StructField("text", T.StringType())])
    return _stripped(rows, True, schema).select(*[F.col("text") if c == "text" else F.col(f"row.`{c}`") for c in docs.columns])
