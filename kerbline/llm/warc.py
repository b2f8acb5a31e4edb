"""WARC archives with a two-level capture index.

``write_archives`` writes gzip members, one a record: a response, or a revisit of the response
with the same payload and the smallest id. ``build_index`` sorts captures by reversed-host URL key
into compressed blocks; each index file ends with its sparse directory (first key, place and size
of each block). ``lookup`` finds the captures of URLs: a binary search over the first keys of the
files, one over a file's directory, then range reads of single blocks. ``read_records`` reads the
records of captures by range, neighbours together.

Files are written under fresh names by each attempt of a task and only named in the stored list
of the attempt that succeeded, so a lost executor leaves no wrong record. All paths are URIs that
every executor sees.

Defined cases: a null payload is empty; a null URL has the key "-"; a null id can be a response
only among rows without ids; rows that repeat an id and payload are responses each; an empty
table gives empty archives and an empty index.
"""

from __future__ import annotations

import base64
import bisect
import hashlib
import json
import re
import struct
import uuid
import zlib
from datetime import datetime, timezone
from urllib.parse import urlsplit

import pyarrow as pa
from pyarrow import fs as pafs
from pyspark.sql import DataFrame, functions as F

from kerbline.scale import scratch_path, settle

FILE_BYTES = 1 << 30
BLOCK_LINES = 1_000
GAP = 64 << 10
SPAN = 8 << 20
# Bytes of archive that one task reads.
TASK_BYTES = 256 << 20
_CAPTURE = "key string, stamp string, page_id long, file string, place long, size long"
_TAIL = "<QQ"


def open_path(uri: str) -> tuple[pafs.FileSystem, str]:
    """File system and path of a URI or local path."""
    if re.match(r"^[a-z][a-z0-9+.-]*:", uri):
        return pafs.FileSystem.from_uri(re.sub(r"^s3[an]:", "s3:", re.sub(r"^file:/*", "file:///", uri)))
    return pafs.LocalFileSystem(), uri


def url_key(url: str | None) -> str:
    """Host labels reversed, then port, path and query, lower case: com,example)/path?query."""
    if not url:
        return "-"
    try:
        parts = urlsplit(url.strip())
        host, port = (parts.hostname or ""), parts.port
    except ValueError:
        return url.strip().lower()
    host = re.sub(r"^www\d*\.", "", host)
    own = f":{port}" if port and port not in (80, 443) else ""
    rest = parts.path.rstrip("/") or "/"
    query = "?" + "&".join(sorted(parts.query.split("&"))) if parts.query else ""
    return f"{','.join(reversed(host.split('.')))}{own}){rest}{query}".lower()


def digest(payload: bytes) -> str:
    """Bare upper-case base32 SHA-1."""
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def _name(page_id: int | None) -> str:
    return f"<urn:kerbline:page:{'' if page_id is None else page_id}>"


def _record(page_id, url, payload: bytes, refers, revisit: bool, stamp: str) -> bytes:
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    body = http if revisit else http + payload
    lines = ["WARC/1.1", f"WARC-Type: {'revisit' if revisit else 'response'}", f"WARC-Record-ID: {_name(page_id)}", f"WARC-Date: {stamp}"]
    if url is not None:
        lines.append("WARC-Target-URI: " + re.sub(r"[\r\n]+", " ", url))
    lines += [f"WARC-Payload-Digest: sha1:{digest(payload)}", "Content-Type: application/http; msgtype=response"]
    if revisit:
        lines += ["WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest", f"WARC-Refers-To: {_name(refers)}"]
    lines.append(f"Content-Length: {len(body)}")
    return "\r\n".join(lines).encode() + b"\r\n\r\n" + body + b"\r\n\r\n"


def _member(data: bytes) -> bytes:
    packer = zlib.compressobj(6, zlib.DEFLATED, 31)
    return packer.compress(data) + packer.flush()


def _writer(folder: str, most: int):
    def run(batches):
        fs, top = open_path(folder)
        out = name = None
        place = 0
        stamp = datetime.now(timezone.utc).strftime("%Y-%m-%dT%H:%M:%SZ")
        try:
            for batch in batches:
                rows = []
                for page_id, url, html, refers, revisit in zip(*(batch.column(c).to_pylist() for c in ("page_id", "url", "html", "refers", "revisit")), strict=True):
                    if out is None or place >= most:
                        if out is not None:
                            out.close()
                        name, place = f"{uuid.uuid4().hex}.warc.gz", 0
                        out = fs.open_output_stream(f"{top}/{name}", compression=None)
                    data = _member(_record(page_id, url, (html or "").encode("utf-8", "surrogatepass"), refers, revisit, stamp))
                    out.write(data)
                    rows.append((url_key(url), stamp, page_id, name, place, len(data)))
                    place += len(data)
                if rows:
                    kinds = [pa.string(), pa.string(), pa.int64(), pa.string(), pa.int64(), pa.int64()]
                    yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)], names=["key", "stamp", "page_id", "file", "place", "size"])
        finally:
            if out is not None:
                out.close()

    return run


def write_archives(pages: DataFrame, folder: str, least: int = 0, file_bytes: int = FILE_BYTES) -> DataFrame:
    """Write a record for each (page_id, url, html); the stored captures, one for each record.

    Payloads under ``least`` bytes are never revisits.
    """
    fs, top = open_path(folder)
    fs.create_dir(top, recursive=True)
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), F.col("html").cast("string").alias("html"))
    body = F.coalesce(F.col("html"), F.lit("")).cast("binary")
    rows = rows.withColumns({"d": F.sha1(body), "n": F.octet_length(body)})
    # Only payloads met twice travel on; a frequent one is a row for each task.
    twice = rows.filter(F.col("n") >= least).groupBy("d").agg(F.min("page_id").alias("first"), F.count("*").alias("c")).filter("c > 1").select("d", "first")
    twice = settle(twice)
    joined = rows.join(twice, "d", "left")
    revisit = F.coalesce((F.col("n") >= least) & F.col("first").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("first")), F.lit(False))
    joined = joined.select("page_id", "url", "html", F.col("first").alias("refers"), revisit.alias("revisit"))
    return settle(joined.mapInArrow(_writer(folder, file_bytes), _CAPTURE))


def _index_writer(folder: str, lines: int):
    def run(batches):
        fs, top = open_path(folder)
        name, out, directory, block, place = f"{uuid.uuid4().hex}.idx", None, [], [], 0

        def flush():
            nonlocal place
            data = zlib.compress("\n".join(json.dumps(r, ensure_ascii=False) for r in block).encode())
            directory.append((block[0][0], place, len(data)))
            out.write(data)
            place += len(data)
            block.clear()

        for batch in batches:
            for row in zip(*(batch.column(c).to_pylist() for c in ("key", "stamp", "page_id", "file", "place", "size")), strict=True):
                if out is None:
                    out = fs.open_output_stream(f"{top}/{name}", compression=None)
                block.append(row)
                if len(block) >= lines:
                    flush()
        if out is None:
            return
        if block:
            flush()
        data = zlib.compress(json.dumps(directory, ensure_ascii=False).encode())
        out.write(data)
        out.write(struct.pack(_TAIL, place, len(data)))
        out.close()
        yield pa.RecordBatch.from_arrays([pa.array([directory[0][0]]), pa.array([name])], names=["first_key", "name"])

    return run


def build_index(captures: DataFrame, folder: str, lines: int = BLOCK_LINES) -> DataFrame:
    """Sort captures into block files; the stored list of files with their first keys.

    A file is one range of keys, so the list is as long as the sort has partitions.
    """
    fs, top = open_path(folder)
    fs.create_dir(top, recursive=True)
    order = ["key", "stamp", "page_id", "file", "place"]
    # A key with many captures is split by its further columns.
    sorted_rows = captures.repartitionByRange(*order).sortWithinPartitions(*order)
    return settle(sorted_rows.mapInArrow(_index_writer(folder, lines), "first_key string, name string"))


class _Files:
    """Open index files and their directories, a few at a time."""

    def __init__(self, folder: str):
        self.fs, self.top = open_path(folder)
        self.open: dict[str, tuple] = {}

    def directory(self, name: str):
        if name not in self.open:
            if len(self.open) >= 64:
                self.open.clear()
            f = self.fs.open_input_file(f"{self.top}/{name}")
            at, size = struct.unpack(_TAIL, f.read_at(16, f.size() - 16))
            entries = json.loads(zlib.decompress(f.read_at(size, at)))
            self.open[name] = (f, [e[0] for e in entries], entries)
        return self.open[name]


def _span(keys: list[str], key: str) -> range:
    """Which of the sorted runs with these first keys may hold a key."""
    return range(max(bisect.bisect_left(keys, key) - 1, 0), bisect.bisect_right(keys, key))


def _blocks(folder: str, files: list[tuple[str, str]]):
    firsts = [k for k, _ in files]

    def run(batches):
        index = _Files(folder)
        for batch in batches:
            rows = []
            for key in batch.column("key").to_pylist():
                for i in _span(firsts, key):
                    _, keys, entries = index.directory(files[i][1])
                    rows += [(files[i][1], entries[j][1], entries[j][2], key) for j in _span(keys, key)]
            kinds = [pa.string(), pa.int64(), pa.int64(), pa.string()]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(list(zip(*rows, strict=True)) or [[]] * 4, kinds, strict=True)], names=["name", "at", "bytes", "key"])

    return run


def _captures(folder: str):
    """Captures of the keys asked of each block; rows come sorted by block."""
    names = ["key", "stamp", "page_id", "file", "place", "size"]
    kinds = [pa.string(), pa.string(), pa.int64(), pa.string(), pa.int64(), pa.int64()]

    def run(batches):
        index = _Files(folder)
        held, lines = None, {}
        for batch in batches:
            rows = []
            for name, at, size, key in zip(*(batch.column(c).to_pylist() for c in ("name", "at", "bytes", "key")), strict=True):
                if held != (name, at):
                    lines = {}
                    for line in zlib.decompress(index.directory(name)[0].read_at(size, at)).decode().split("\n"):
                        row = json.loads(line)
                        lines.setdefault(row[0], []).append(row)
                    held = name, at
                rows += lines.get(key, [])
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(list(zip(*rows, strict=True)) or [[]] * 6, kinds, strict=True)], names=names)

    return run


def lookup(urls: DataFrame, files: DataFrame, folder: str) -> DataFrame:
    """Captures of the URLs in column ``url``; each capture once."""

    def keyed(batches):
        for batch in batches:
            yield pa.RecordBatch.from_arrays([pa.array([url_key(u) for u in batch.column("url").to_pylist()], pa.string())], names=["key"])

    wanted = urls.select(F.col("url").cast("string").alias("url")).mapInArrow(keyed, "key string").distinct()
    # One row for each range of the sort.
    listed = sorted((r["first_key"], r["name"]) for r in files.collect())
    if not listed:
        return urls.sparkSession.createDataFrame([], _CAPTURE)
    asked = wanted.mapInArrow(_blocks(folder, listed), "name string, at long, bytes long, key string")
    # A block is one read; small tasks are not merged by the size of their pointers.
    tasks = urls.sparkSession.sparkContext.defaultParallelism
    asked = asked.repartition(max(tasks, int(urls.sparkSession.conf.get("spark.sql.shuffle.partitions"))), "name", "at").sortWithinPartitions("name", "at")
    return asked.mapInArrow(_captures(folder), _CAPTURE)


def parse_record(data: bytes) -> tuple[dict[str, str], bytes]:
    """WARC headers (lower-case names) and block of one record."""
    head, _, rest = data.partition(b"\r\n\r\n")
    lines = head.decode().split("\r\n")
    headers = {k.strip().lower(): v.strip() for k, _, v in (x.partition(":") for x in lines[1:])}
    size = int(headers["content-length"])
    if not lines[0].startswith("WARC/") or rest[size:] != b"\r\n\r\n":
        raise ValueError("damaged WARC record")
    return headers, rest[:size]


def _ranges(rows: list[tuple[int, int]]):
    """Neighbouring (place, size) rows joined: (start, stop, rows)."""
    run: list[tuple[int, int]] = []
    for place, size in rows:
        if run and (place - (run[-1][0] + run[-1][1]) > GAP or place + size - run[0][0] > SPAN):
            yield run[0][0], run[-1][0] + run[-1][1], run
            run = []
        run.append((place, size))
    if run:
        yield run[0][0], run[-1][0] + run[-1][1], run


def _page(name: str | None) -> int | None:
    number = (name or "").removeprefix("<urn:kerbline:page:").removesuffix(">")
    return int(number) if number else None


def _reader(folder: str):
    kinds = [pa.int64(), pa.string(), pa.string(), pa.int64(), pa.int64(), pa.string(), pa.binary()]
    names = ["page_id", "url", "record_type", "refers_to", "payload_bytes", "payload_digest", "payload"]

    def run(batches):
        fs, top = open_path(folder)
        held, f = None, None
        for batch in batches:
            by_file: dict[str, list[tuple[int, int]]] = {}
            for name, place, size in zip(*(batch.column(c).to_pylist() for c in ("file", "place", "size")), strict=True):
                by_file.setdefault(name, []).append((place, size))
            for name, rows in by_file.items():
                if held != name:
                    held, f = name, fs.open_input_file(f"{top}/{name}")
                for start, stop, run_rows in _ranges(rows):
                    data = f.read_at(stop - start, start)
                    out = []
                    for place, size in run_rows:
                        headers, block = parse_record(zlib.decompress(data[place - start : place - start + size], 31))
                        http, _, payload = block.partition(b"\r\n\r\n")
                        whole = int(re.search(rb"Content-Length: (\d+)", http)[1])
                        own = headers["warc-payload-digest"].removeprefix("sha1:")
                        if headers["warc-type"] == "response" and (len(payload) != whole or digest(payload) != own):
                            raise ValueError(f"payload of {headers['warc-record-id']} does not match its digest")
                        refers = _page(headers.get("warc-refers-to"))
                        out.append((_page(headers["warc-record-id"]), headers.get("warc-target-uri"), headers["warc-type"], refers, whole, own, payload))
                    yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out, strict=True), kinds, strict=True)], names=names)

    return run


def read_records(captures: DataFrame, folder: str) -> DataFrame:
    """(page_id, url, record_type, refers_to, payload_bytes, payload_digest, payload) of captures.

    Stretches of ``SPAN`` bytes are dealt to tasks, so one archive is read by many. The
    number of tasks follows from the bytes to read, not from the size of the pointers.
    """
    placed = settle(captures.select("file", "place", "size", F.floor(F.col("place") / SPAN).alias("stretch")))
    total = placed.agg(F.sum("size")).first()[0] or 0
    tasks = max(placed.sparkSession.sparkContext.defaultParallelism, -(-total // TASK_BYTES))
    placed = placed.repartition(tasks, "file", "stretch").sortWithinPartitions("file", "place").drop("stretch")
    schema = "page_id long, url string, record_type string, refers_to long, payload_bytes long, payload_digest string, payload binary"
    return placed.mapInArrow(_reader(folder), schema)


def archive(pages: DataFrame, folder: str | None = None, least: int = 0) -> DataFrame:
    """Write and index all pages, then read every page's captures through the index."""
    folder = folder or scratch_path(pages.sparkSession, "warc")
    captures = write_archives(pages, f"{folder}/data", least)
    files = build_index(captures, f"{folder}/index")
    return read_records(lookup(pages, files, f"{folder}/index"), f"{folder}/data")
