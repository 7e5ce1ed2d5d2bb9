"""WARC archives with a two-level capture index.

Pages are written as gzip members into archives, one or more per task; a payload that an earlier
record has is a revisit without the payload. The index holds a line per record, sorted by
reversed-host URL key and page, in blocks of ``LINES`` lines, each a gzip member; a sparse
directory holds only every block's first key and place. A lookup finds the index part by its
bounds, the block by binary search in the part's directory, the line by binary search in the
block, and reads the record's range from its archive.
"""

from __future__ import annotations

import bisect
import gzip
import hashlib
import itertools
import json
import re
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgermill.llm import files
from ledgermill.llm.common import anchored, arrow
from ledgermill.workspace import new_path, stage

LINES, LEAST_PAYLOAD = 1000, 100
#: Bytes after which a task starts another archive, and of records that one reading task takes.
ARCHIVE, READ = 1 << 30, 8 << 20
#: Reading tasks at most; bytes of neighbouring records, gaps of so many included, in one request.
TASKS, REQUEST, GAP = 100_000, 4 << 20, 64 << 10
DATE = "2024-01-01T00:00:00Z"
NO_ID = -(1 << 63)
_URL = re.compile(r"(?:([a-z][a-z0-9+.-]*)://)?(?:[^/?#@]*@)?([^/?#:]*)(?::(\d*))?([^#]*)", re.I | re.S)
_PORT = {"http": "80", "https": "443"}


def surt(url: str | None) -> str:
    """Reversed-host key: ``http://Blog.Example.org:80/a?b#c`` is ``org,example,blog)/a?b``.

    Plain ASCII without blanks or controls, so keys sort alike everywhere. Null is the empty key.
    """
    if url is None:
        return ""
    scheme, host, port, path = _URL.match(url.strip()).groups()
    key = ",".join(reversed(host.lower().split(".")))
    if port and port != _PORT.get((scheme or "http").lower()):
        key += ":" + port
    key += ")" + (path or "/")
    return re.sub(rb"[^\x21-\x7e]", lambda m: b"%%%02X" % m[0][0],
                  key.encode("utf-8", "surrogatepass")).decode("ascii")


def _name(page_id: int | None) -> str:
    return f"<urn:x-page:{'' if page_id is None else page_id}>"


def _page(name: str) -> int | None:
    text = name.removeprefix("<urn:x-page:").removesuffix(">")
    return int(text) if text else None


def record(page_id: int | None, url: str | None, payload: bytes, digest: str, refers_to: int | None,
           revisit: bool) -> bytes:
    """One WARC record. A revisit keeps the HTTP header, hence the payload's length."""
    block = (b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n"
             % len(payload)) + (b"" if revisit else payload)
    target = re.sub(r"[\x00-\x20\x7f]", lambda m: f"%{ord(m[0]):02X}", url or "")
    lines = ["WARC/1.1", f"WARC-Type: {'revisit' if revisit else 'response'}",
             f"WARC-Record-ID: {_name(page_id)}", f"WARC-Date: {DATE}", f"WARC-Target-URI: {target}",
             f"WARC-Payload-Digest: sha256:{digest}", "Content-Type: application/http; msgtype=response"]
    if revisit:
        lines += ["WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest",
                  f"WARC-Refers-To: {_name(refers_to)}"]
    lines.append(f"Content-Length: {len(block)}")
    return "\r\n".join(lines).encode("utf-8", "surrogatepass") + b"\r\n\r\n" + block + b"\r\n\r\n"


def parse(data: bytes) -> dict:
    """What a record says of its page; a response's payload is hashed anew."""
    head, _, rest = data.partition(b"\r\n\r\n")
    fields = dict(line.split(": ", 1) for line in head.decode("utf-8", "surrogatepass").split("\r\n")[1:])
    block = rest[: int(fields["Content-Length"])]
    http, _, payload = block.partition(b"\r\n\r\n")
    size = int(re.search(rb"Content-Length: (\d+)", http)[1])
    digest, kind = fields["WARC-Payload-Digest"].removeprefix("sha256:"), fields["WARC-Type"]
    if kind == "response" and (len(payload) != size or hashlib.sha256(payload).hexdigest() != digest):
        raise ValueError(f"broken record {fields['WARC-Record-ID']}")
    refers = fields.get("WARC-Refers-To")
    return {"page_id": _page(fields["WARC-Record-ID"]), "payload_bytes": size, "payload_digest": digest,
            "record_type": kind, "refers_to": _page(refers) if refers else None,
            "url": fields["WARC-Target-URI"], "payload": payload}


def _member(data: bytes) -> bytes:
    return gzip.compress(data, 6, mtime=0)


def revisits(rows: DataFrame, anchor: list[str]) -> DataFrame:
    """Of rows (page_id, digest, payload_bytes, anchor), those that revisit, and whom."""
    known = rows.filter(F.col("payload_bytes") >= LEAST_PAYLOAD)
    key = F.struct(F.col("page_id").isNull().alias("none"), "page_id", *anchor)
    groups = stage(known.groupBy("digest").agg(F.count("*").alias("n"), F.min(key).alias("first"))
                   .filter("n > 1").select("digest", "first"), "payload-groups")
    return known.withColumn("own", key).join(groups, "digest").filter("own != first").select(
        *anchor, F.col("first.page_id").alias("refers_to"), F.lit(True).alias("revisit"))


def write(pages: DataFrame, folder: str) -> DataFrame:
    """Write all pages into archives in ``folder``; (key, id, file, offset, length), one per record.

    Pages meet the revisits by their place in the input: while these are few they are broadcast;
    beyond the session's limit all payloads are shuffled once.

    Every attempt of a task writes archives of its own name and only a finished attempt's rows
    come out, so what a lost executor left behind is never read.
    """
    pages, anchor = anchored(pages.select("page_id", "url", "html"))
    payload = F.coalesce(F.col("html").cast("string"), F.lit("")).cast("binary")
    rows = pages.select("page_id", *anchor, F.col("url").cast("string"), payload.alias("payload"))
    rows = rows.withColumn("digest", F.sha2("payload", 256))
    size = F.octet_length("payload").alias("payload_bytes")
    narrow = stage(rows.select("page_id", *anchor, "digest", size), "payloads")
    again = stage(revisits(narrow, anchor), "revisits")
    marked = rows.join(again, anchor, "left").select(
        F.col("page_id").cast("long").alias("page_id"), "url", "payload", "digest",
        F.col("refers_to").cast("long").alias("refers_to"),
        F.coalesce("revisit", F.lit(False)).alias("revisit"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out, name, at = None, "", 0
        for batch in batches:
            made = []
            for page in batch.to_pylist():
                if out is None or at >= ARCHIVE:
                    if out is not None:
                        out.close()
                    name, at = files.own_name("pages", ".warc.gz"), 0
                    out = files.open_new(f"{folder}/{name}")
                data = _member(record(**page))
                out.write(data)
                page_id = page["page_id"]
                made.append((surt(page["url"]), NO_ID if page_id is None else page_id, name, at, len(data)))
                at += len(data)
            out.flush()
            yield _captures(made)
        if out is not None:
            out.close()

    return stage(marked.transform(arrow, run, _CAPTURE_SQL), "captures")


_CAPTURE = pa.schema([("key", pa.string()), ("id", pa.int64()), ("file", pa.string()),
                      ("offset", pa.int64()), ("length", pa.int64())])
_CAPTURE_SQL = "key string, id long, file string, offset long, length long"


def _captures(rows: list[tuple]) -> pa.RecordBatch:
    columns = zip(*rows) if rows else [()] * len(_CAPTURE)
    return pa.RecordBatch.from_arrays(
        [pa.array(c, t) for c, t in zip(columns, _CAPTURE.types)], schema=_CAPTURE)


def build_index(captures: DataFrame, folder: str, lines: int = LINES) -> list[dict]:
    """Write sorted blocks and their directories; the bounds of each index part, in order.

    A part is one task's range of keys, so the list has at most as many entries as the session has
    shuffle partitions. A part's directory has one line per block.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        name = files.own_name("index", ".cdx.gz")
        out, at, block, directory, first = None, 0, [], [], None

        def flush() -> int:
            data = _member("\n".join(block).encode())
            key, page, *_ = block[0].split(" ")
            directory.append((key, int(page), at, len(data)))
            out.write(data)
            block.clear()
            return at + len(data)

        for batch in batches:
            for row in zip(*(c.to_pylist() for c in batch.columns)):
                if out is None:
                    out, first = files.open_new(f"{folder}/{name}"), row[:2]
                last = row[:2]
                block.append(" ".join(map(str, row)))
                if len(block) == lines:
                    at = flush()
        if block:
            at = flush()
        if out is not None:
            out.close()
            files.put(f"{folder}/{name}.dir", json.dumps(directory).encode())
            yield pa.RecordBatch.from_pylist([{
                "part": name, "low_key": first[0], "low_id": first[1], "high_key": last[0],
                "high_id": last[1], "blocks": len(directory)}])

    bounds = "low_key string, low_id long, high_key string, high_id long"
    made = stage(
        captures.repartitionByRange("key", "id").sortWithinPartitions("key", "id", "file", "offset")
        .transform(arrow, run, f"part string, {bounds}, blocks long"), "index-parts")
    return [r.asDict() for r in made.orderBy("low_key", "low_id").collect()]


class _Part:
    """One index part: its directory in memory, the block last read."""

    def __init__(self, folder: str, name: str):
        with files.open_random(f"{folder}/{name}.dir") as file:
            self.directory = json.loads(file.read())
        self.firsts = [(k, i) for k, i, *_ in self.directory]
        self.file = files.open_random(f"{folder}/{name}")
        self.at, self.block, self.keys = -1, [], []

    def load(self, n: int) -> None:
        if n != self.at:
            _, _, offset, length = self.directory[n]
            text = gzip.decompress(self.file.read_at(length, offset)).decode()
            self.block = [x.split(" ") for x in text.split("\n")]
            self.keys = [(x[0], int(x[1])) for x in self.block]
            self.at = n

    def find(self, want: tuple[str, int]) -> Iterator[tuple[str, int, int]]:
        """File, offset and length of every capture of a key and page, across blocks if need be."""
        for n in range(max(0, bisect.bisect_left(self.firsts, want) - 1), len(self.firsts)):
            if self.firsts[n] > want:
                return
            self.load(n)
            for k in range(bisect.bisect_left(self.keys, want), len(self.keys)):
                if self.keys[k] != want:
                    return
                yield self.block[k][2], int(self.block[k][3]), int(self.block[k][4])


def lookup(queries: DataFrame, folder: str, parts: list[dict]) -> DataFrame:
    """Captures (key, id, file, offset, length) of queries (key, id); repeated queries count once.

    Queries go to the index part whose bounds hold them and are answered in key order, so each
    block is read about once.
    """
    highs = [(p["high_key"], p["high_id"]) for p in parts]
    names = [p["part"] for p in parts]

    def route(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys, ids = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            found = [bisect.bisect_left(highs, x) for x in zip(keys, ids)]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(found, pa.int32())], names=["key", "id", "part"])

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, part = -1, None
        for batch in batches:
            made = []
            for key, page, n in zip(*(c.to_pylist() for c in batch.columns)):
                if n >= len(names):
                    continue
                if n != at:
                    at, part = n, _Part(folder, names[n])
                made += [(key, page, *x) for x in part.find((key, page))]
            yield _captures(made)

    asked = queries.select("key", "id").distinct().transform(arrow, route, "key string, id long, part int")
    return (asked.repartitionByRange("part", "key", "id").sortWithinPartitions("part", "key", "id")
            .transform(arrow, search, _CAPTURE_SQL))


_PAGE_SQL = "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long"


def requests(places: list[tuple[int, int]]) -> Iterator[tuple[int, int, int]]:
    """Of ascending (offset, length) in one file, the runs to read at once: (first, last, end).

    A run goes on while the gap is small and the whole stays below ``REQUEST``; a larger record is
    read alone.
    """
    first = 0
    for k in range(1, len(places) + 1):
        end = places[k - 1][0] + places[k - 1][1]
        if k == len(places) or places[k][0] - end > GAP or places[k][0] + places[k][1] - places[first][0] > REQUEST:
            yield first, k, end
            first = k


def read(captures: DataFrame, folder: str) -> DataFrame:
    """The records at (file, offset, length), archive by archive in file order.

    The number of tasks follows from the records' bytes, not from the few bytes of the places, and
    is stated, so adaptive execution doesn't merge them. Neighbours are read in one request.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        name, file = None, None
        for batch in batches:
            names = batch.column(0).to_pylist()
            places = list(zip(batch.column(1).to_pylist(), batch.column(2).to_pylist()))
            cuts = [0, *(k for k in range(1, len(names)) if names[k] != names[k - 1]), len(names)]
            for begin, stop in itertools.pairwise(cuts):
                if begin == stop:
                    continue
                if names[begin] != name:
                    name, file = names[begin], files.open_random(f"{folder}/{names[begin]}")
                for first, last, end in requests(own := places[begin:stop]):
                    start = own[first][0]
                    data = memoryview(file.read_at(end - start, start))
                    made = [parse(zlib.decompress(data[a - start:a - start + n], wbits=31)) for a, n in own[first:last]]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([m[f.name] for m in made], f.type) for f in _PAGE], schema=_PAGE)

    found = stage(captures.select("file", "offset", "length"), "to-read")
    size = found.agg(F.coalesce(F.sum("length"), F.lit(0))).first()[0]
    tasks = max(1, min(TASKS, -(-size // READ)))
    span = F.floor(F.col("offset") / REQUEST)
    return (found.repartition(tasks, "file", span).sortWithinPartitions("file", "offset")
            .transform(arrow, run, _PAGE_SQL))


_PAGE = pa.schema([("page_id", pa.int64()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string()),
                   ("record_type", pa.string()), ("refers_to", pa.int64())])


def keys(pages: DataFrame) -> DataFrame:
    """(key, id) of pages, as the index has them."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = [NO_ID if x is None else x for x in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [pa.array([surt(x) for x in batch.column(0).to_pylist()], pa.string()),
                 pa.array(ids, pa.int64())], names=["key", "id"])

    named = pages.select(F.col("url").cast("string"), F.col("page_id").cast("long"))
    return named.transform(arrow, run, "key string, id long")


def archive(pages: DataFrame, folder: str | None = None) -> DataFrame:
    """Write every page, look each up by URL and read it back: ``page_id``, ``payload_bytes``,
    ``payload_digest``, ``record_type`` and ``refers_to``, a row for every row of ``pages``.

    Of records with equal payloads of ``LEAST_PAYLOAD`` bytes or more the one with the smallest
    page_id, nulls last and then file order, is the response and the others revisit it. Null html
    is an empty payload, a null URL the empty key. Repeated rows give a record each. An empty
    table gives empty archives and no rows; other columns are not read.
    """
    folder = folder or new_path(pages.sparkSession, "warc")
    captures = write(pages, folder)
    parts = build_index(captures, folder)
    return read(lookup(keys(pages), folder, parts), folder)


def captures_of(folder: str, parts: list[dict], url: str) -> list[dict]:
    """All records of one URL, parsed: a single lookup from the driver."""
    want, out = surt(url), []
    for part in parts:
        if part["low_key"] <= want <= part["high_key"]:
            index = _Part(folder, part["part"])
            for n in range(max(0, bisect.bisect_left(index.firsts, (want, NO_ID)) - 1), len(index.firsts)):
                if index.firsts[n][0] > want:
                    break
                index.load(n)
                begin = bisect.bisect_left(index.keys, (want, NO_ID))
                for line in index.block[begin:]:
                    if line[0] != want:
                        break
                    with files.open_random(f"{folder}/{line[2]}") as file:
                        data = file.read_at(int(line[4]), int(line[3]))
                    out.append(parse(zlib.decompress(data, wbits=31)))
    return out
