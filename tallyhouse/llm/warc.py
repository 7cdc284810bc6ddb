"""WARC archives in the shared folder, and a two-level index of what they hold.

Each task writes one archive of gzip members, a record each, and reports where they lie. Index
entries are sorted by a key that turns the host around, packed into compressed blocks, and a
sparse directory keeps each block's first key. A lookup deals the wanted keys out to the index files,
searches each file's slice of the directory for the blocks, the blocks for the entries, and reads
only the ranges of the archives that it needs.

Files are written through the file system that the folder's address names, under a fresh name
for each attempt of a task. Only the names that finished tasks report are ever read.
"""

from __future__ import annotations

import base64
import hashlib
import json
import uuid
import zlib
from bisect import bisect_left, bisect_right
from collections.abc import Iterator
from datetime import UTC, datetime

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyhouse.llm.common import by_batch, keep, small_batches
from tallyhouse.operators.stored import shared_folder

ARCHIVE_BYTES = 512 << 20  # a task goes on in a new archive beyond this size
BLOCK_ENTRIES = 1024
GAP = 1 << 16  # ranges of one archive that lie no further apart are read together
READ_BYTES = 4 << 20  # and as long as they are no longer than this together
TASK_BYTES = 8 << 20  # compressed records that a task reads
LEVEL = 3
PLACE_TYPES = (pa.string(), pa.int64(), pa.string(), pa.int64(), pa.int64())
DATE = datetime(2000, 1, 1, tzinfo=UTC).strftime("%Y-%m-%dT%H:%M:%SZ")  # tables without a capture time


def file_system(folder: str) -> tuple[fs.FileSystem, str]:
    return fs.FileSystem.from_uri(folder if "://" in folder or folder.startswith("file:") else f"file://{folder}")


def base32_sha1(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def host_key(url: Column) -> Column:
    """Sort key of a URL: host labels from the last to the first, then the rest; the URL itself without a host."""
    host = F.lower(F.regexp_extract(url, r"^[^:/?#]+://([^/?#]*)", 1))
    rest = F.regexp_extract(url, r"^[^:/?#]+://[^/?#]*(.*)$", 1)
    return F.when(host == "", F.coalesce(url, F.lit(""))).otherwise(F.concat(F.array_join(F.reverse(F.split(host, r"\.")), ","), F.lit(")"), rest))


def record(kind: str, page: int | None, url: str | None, payload: bytes, digest: str, size: int, refers: int | None) -> bytes:
    """One record. A revisit has no payload; its headers say how long the payload was and who has it."""
    head = [
        "WARC/1.1", f"WARC-Type: {kind}", f"WARC-Record-ID: <urn:page:{'' if page is None else page}>", f"WARC-Date: {DATE}",
        "WARC-Target-URI: " + json.dumps(url)[1:-1] if url is not None else None,
        f"WARC-Payload-Digest: sha1:{digest}", f"X-Payload-Length: {size}",
    ]
    if kind == "revisit":
        head += ["WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest", f"WARC-Refers-To: <urn:page:{refers}>"]
    head += ["Content-Type: text/html; charset=utf-8", f"Content-Length: {len(payload)}"]
    return "\r\n".join(x for x in head if x is not None).encode() + b"\r\n\r\n" + payload + b"\r\n\r\n"


def parse(data: bytes) -> tuple[dict[str, str], bytes]:
    """Headers and payload of one record; raises if it is damaged."""
    head, _, rest = data.partition(b"\r\n\r\n")
    lines = head.decode().split("\r\n")
    if lines[0] != "WARC/1.1":
        raise ValueError("not a WARC record")
    headers = dict(line.split(": ", 1) for line in lines[1:])
    size = int(headers["Content-Length"])
    if rest[size:] != b"\r\n\r\n":
        raise ValueError("a record's length does not fit")
    return headers, rest[:size]


def decided(pages: DataFrame, id_col: str, text_col: str, least: int) -> DataFrame:
    """``pages`` as ``page_id``, ``url``, ``payload`` and ``refers_to``, null for responses.

    Of equal payloads of at least ``least`` bytes the largest id holds the response. Only digests
    are grouped, with a maximum that is taken before the shuffle; groups of one are dropped.
    """
    payload = F.encode(F.coalesce(F.col(text_col).cast("string"), F.lit("")), "UTF-8")
    rows = pages.select(F.col(id_col).alias("page_id"), F.col("url"), payload.alias("payload"))
    known = rows.filter(F.octet_length("payload") >= least).select("page_id", F.sha2("payload", 256).alias("same"))
    shared = keep(known.groupBy("same").agg(F.max("page_id").alias("holder"), F.count("*").alias("n")).filter("n > 1").drop("n"), "shared")
    found = rows.withColumn("same", F.sha2("payload", 256)).join(shared, "same", "left")
    first = F.col("holder").isNull() | F.col("page_id").eqNullSafe(F.col("holder")) | (F.octet_length("payload") < least)
    return found.select("page_id", "url", "payload", F.when(~first, F.col("holder")).alias("refers_to"))


def write_archives(pages: DataFrame, folder: str, id_col: str = "page_id", text_col: str = "html", least: int = 0) -> DataFrame:
    """Write a record per row of ``pages``; returns the index entries, stored.

    Entries: ``key``, ``page_id``, ``url``, ``archive`` (file name in ``folder``), ``start``,
    ``length``. Null payloads count as empty. Ids are whole
    numbers or null; a null id is never a holder. Rows with equal id and payload become a response each.
    """
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, base = file_system(folder)
        system.create_dir(base, recursive=True)
        out, name, at = None, "", 0
        for batch in batches:
            places = []
            for page, url, payload, refers in zip(*(c.to_pylist() for c in batch.columns[1:])):
                if out is None or at >= ARCHIVE_BYTES:
                    if out is not None:
                        out.close()
                    name, at = f"{uuid.uuid4().hex}.warc.gz", 0
                    out = system.open_output_stream(f"{base}/{name}", compression=None)
                kind = "response" if refers is None else "revisit"
                made = record(kind, page, url, payload if refers is None else b"", base32_sha1(payload), len(payload), refers)
                packer = zlib.compressobj(LEVEL, zlib.DEFLATED, 31)
                member = packer.compress(made) + packer.flush()
                out.write(member)
                places.append((name, at, len(member)))
                at += len(member)
            columns = [batch.column(0), batch.column(1), batch.column(2), *map(pa.array, zip(*places))]
            yield pa.RecordBatch.from_arrays(columns, ["key", "page_id", "url", "archive", "start", "length"])
        if out is not None:
            out.close()

    small_batches(pages.sparkSession)
    rows = decided(pages, id_col, text_col, least).select(F.coalesce(host_key(F.col("url")), F.lit("")).alias("key"), F.col("page_id").cast("long"), F.col("url").cast("string"), "payload", F.col("refers_to").cast("long"))
    return keep(rows.mapInArrow(work, "key string, page_id long, url string, archive string, start long, length long"), "entries")


def write_index(entries: DataFrame, folder: str, block_entries: int = BLOCK_ENTRIES) -> DataFrame:
    """Pack sorted entries into compressed blocks; returns the sparse directory, stored.

    Directory: ``first_key``, ``last_key``, ``file``, ``start``, ``length``, ``entries`` per
    block. Keys are dealt out by range, an archive's place breaking ties, so that one host, or one
    URL, may have any share of the rows.
    """
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, base = file_system(folder)
        system.create_dir(base, recursive=True)
        name, waiting, at = f"{uuid.uuid4().hex}.idx", [], 0
        out = None

        def block(rows: list[tuple]) -> tuple:
            nonlocal at, out
            out = out or system.open_output_stream(f"{base}/{name}", compression=None)
            data = zlib.compress("\n".join(json.dumps(row) for row in rows).encode(), LEVEL)
            out.write(data)
            at += len(data)
            return rows[0][0], rows[-1][0], name, at - len(data), len(data), len(rows)

        def told(rows: list[tuple]) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*rows)], ["first_key", "last_key", "file", "start", "length", "entries"])

        for batch in batches:
            waiting += zip(*(c.to_pylist() for c in batch.columns))
            full = len(waiting) - len(waiting) % block_entries
            if full:
                yield told([block(waiting[i : i + block_entries]) for i in range(0, full, block_entries)])
                waiting = waiting[full:]
        if waiting:
            yield told([block(waiting)])
        if out is not None:
            out.close()

    small_batches(entries.sparkSession)
    order = ["key", "archive", "start"]
    rows = entries.select("key", "page_id", "archive", "start", "length").repartitionByRange(*order).sortWithinPartitions(*order)
    return keep(rows.mapInArrow(work, "first_key string, last_key string, file string, start long, length long, entries long"), "directory")


def read_block(system: fs.FileSystem, base: str, file: str, start: int, length: int) -> list[list]:
    with system.open_input_file(f"{base}/{file}") as source:
        return [json.loads(line) for line in zlib.decompress(source.read_at(length, start)).split(b"\n")]


def find(keys: DataFrame, directory: DataFrame, folder: str) -> DataFrame:
    """Captures of the wanted ``keys`` (column ``key``): ``key``, ``page_id``, ``archive``, ``start``, ``length``.

    An index file holds one range of keys, so its first and last key say which wanted keys may be in
    it; these bounds, one row per file and so per task that wrote the index, are what the driver
    sees. Each file's keys then meet its slice of the directory in one task, which searches the slice
    for the blocks and a block for the entries. Only blocks with wanted keys are read; a key that
    fills many blocks or files is found in all of them. A key that is nowhere gives no row.
    """
    bounds = sorted(map(tuple, directory.groupBy("file").agg(F.min("first_key"), F.max("last_key")).select("min(first_key)", "max(last_key)", "file").collect()))
    firsts, lasts = [x[0] for x in bounds], [x[1] for x in bounds]

    def place(batch: pa.RecordBatch) -> pa.RecordBatch:
        met = [(bounds[i][2], key) for key in batch.column(0).to_pylist() for i in range(bisect_left(lasts, key), bisect_right(firsts, key))]
        return pa.RecordBatch.from_arrays([pa.array([x[i] for x in met], pa.string()) for i in (0, 1)], ["file", "key"])

    def search(slice_: pa.Table, wanted: pa.Table) -> pa.Table:
        system, base = file_system(folder)
        blocks = sorted(zip(*(slice_.column(c).to_pylist() for c in ("first_key", "last_key", "file", "start", "length"))))
        own_firsts, own_lasts = [x[0] for x in blocks], [x[1] for x in blocks]
        found, at, rows, keys = [], -1, [], []
        for key in sorted(set(wanted.column("key").to_pylist())):
            for i in range(bisect_left(own_lasts, key), bisect_right(own_firsts, key)):
                if i != at:  # keys ascend, so a block is read once and one at a time
                    at, rows = i, read_block(system, base, *blocks[i][2:])
                    keys = [r[0] for r in rows]
                found += rows[bisect_left(keys, key) : bisect_right(keys, key)]
        columns = list(zip(*found)) or [()] * 5
        return pa.table([pa.array(c, t) for c, t in zip(columns, PLACE_TYPES)], names=["key", "page_id", "archive", "start", "length"])

    asked = by_batch(keys.select(F.coalesce(F.col("key"), F.lit("")).alias("key")).distinct(), place, "file string, key string")
    return directory.groupBy("file").cogroup(asked.groupBy("file")).applyInArrow(search, "key string, page_id long, archive string, start long, length long")


def ranges(places: list[tuple[str, int, int]]) -> Iterator[tuple[str, int, int, list[tuple[int, int]]]]:
    """Neighbouring places of an archive as one range: archive, start, end, and the places in it."""
    run: list[tuple[int, int]] = []
    name, start, end = "", 0, 0
    for archive, at, length in places:
        if run and archive == name and 0 <= at - end <= GAP and at + length - start <= READ_BYTES:
            run.append((at, length))
        else:
            if run:
                yield name, start, end, run
            name, start, run = archive, at, [(at, length)]
        end = at + length
    if run:
        yield name, start, end, run


def read_records(places: DataFrame, folder: str) -> DataFrame:
    """Records at ``archive``, ``start``, ``length``, read back and checked against their digests.

    Columns: ``page_id``, ``url``, ``record_type``, ``refers_to``, ``payload_digest``,
    ``payload_bytes`` and ``payload`` (null for revisits). Raises if a payload does not have the
    digest its record names.
    """
    def number(text: str | None) -> int | None:
        digits = "" if text is None else text[len("<urn:page:") : -1]
        return int(digits) if digits else None

    def one(data: bytes) -> tuple:
        headers, payload = parse(zlib.decompress(data, 31))
        digest, revisit = headers["WARC-Payload-Digest"].removeprefix("sha1:"), headers["WARC-Type"] == "revisit"
        if not revisit and base32_sha1(payload) != digest:
            raise ValueError("a payload does not have its digest")
        url = headers.get("WARC-Target-URI")
        return (number(headers["WARC-Record-ID"]), None if url is None else json.loads(f'"{url}"'), headers["WARC-Type"], number(headers.get("WARC-Refers-To")), digest,
                int(headers["X-Payload-Length"]), None if revisit else payload)

    schema = pa.schema([("page_id", pa.int64()), ("url", pa.string()), ("record_type", pa.string()), ("refers_to", pa.int64()), ("payload_digest", pa.string()), ("payload_bytes", pa.int64()), ("payload", pa.binary())])

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, base = file_system(folder)
        for batch in batches:
            for archive, start, end, run in ranges(list(zip(*(c.to_pylist() for c in batch.columns)))):
                with system.open_input_file(f"{base}/{archive}") as source:
                    data = source.read_at(end - start, start)
                rows = [one(data[at - start : at - start + length]) for at, length in run]
                yield pa.RecordBatch.from_arrays([pa.array(c, t.type) for c, t in zip(zip(*rows), schema)], schema=schema)

    order = ["archive", "start"]
    # Places are small and what they point at is not: tasks are as many as the records' bytes need.
    tasks = max(1, -(-(places.agg(F.sum("length")).first()[0] or 0) // TASK_BYTES))
    rows = places.select("archive", "start", "length").repartitionByRange(tasks, *order).sortWithinPartitions(*order)
    return rows.mapInArrow(work, "page_id long, url string, record_type string, refers_to long, payload_digest string, payload_bytes long, payload binary")


def new_folder(df: DataFrame) -> str:
    return f"{shared_folder(df.sparkSession).rstrip('/')}/llm/{uuid.uuid4().hex}/archives"


def archive_and_read(pages: DataFrame, id_col: str = "page_id", text_col: str = "html", least: int = 0, folder: str | None = None) -> DataFrame:
    """Write archives and index of ``pages`` (id, ``url``, payload), then look up every page's key and read its records back.

    Returns what ``read_records`` returns, one row per row of ``pages``: null payloads are empty
    records and null urls stay null, equal rows give a record each, an empty table gives none.
    """
    folder = folder or new_folder(pages)
    entries = write_archives(pages, folder, id_col, text_col, least)
    wanted = pages.select(host_key(F.col("url").cast("string")).alias("key"))
    places = keep(find(wanted, write_index(entries, folder), folder), "places")
    return read_records(places, folder)
