"""WARC archives: written as whole-file gzip streams, normalised to one member per record.

Three steps, each a Spark job whose tasks write files of the shared folder and return rows
about them; a table of those rows fixes which attempt's files count, so a lost or repeated
task leaves at most unused files behind.

1. ``write_archives``: records grouped by payload digest (one response, the others revisit
   it) go into monolithic ``.warc.gz`` files: one gzip stream each.
2. ``normalise_archives``: a task inflates one whole-file stream once, chunk by chunk, writes
   every record as a gzip member of its own and lists its place in a sidecar index.
3. ``read_archives``: records are read back by the index, each by inflating its member only.

Files are opened through ``pyarrow.fs``, so the shared folder may be any store it knows.
Payload bytes are compared by SHA-256 and length. Copies of one payload are combined before
the shuffle that finds their response, and the join back can be split by the skew join.
"""

from __future__ import annotations

import hashlib
import json
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from opslake.llm.common import ROW, map_arrow, stored, with_row
from opslake.session import scratch_path

MIN_REVISIT_BYTES = 100
# Uncompressed bytes after which a task starts another archive.
ARCHIVE_BYTES = 64 << 20
CHUNK = 1 << 20
WARC_DATE = "1970-01-01T00:00:00Z"
END = b"\r\n\r\n"


def mark_revisits(
    pages: DataFrame,
    id_col: str = "page_id",
    url_col: str = "url",
    payload_col: str = "html",
    min_bytes: int = MIN_REVISIT_BYTES,
) -> DataFrame:
    """``__row``, ``id``, ``url``, ``payload`` (binary), ``digest``, ``record_type`` and, for
    revisits, ``refers_to`` and ``refers_row`` (the response's id and row).

    Of equal payloads of at least ``min_bytes`` bytes the smallest id is the response, null
    being larger than any id, and of rows with that id the first in storage order. Shorter
    payloads are all responses. A null payload is empty.
    """
    payload = F.coalesce(F.col(payload_col).cast("string"), F.lit("")).cast("binary")
    rows = with_row(pages).select(
        ROW,
        F.col(id_col).cast("long").alias("id"),
        F.coalesce(F.col(url_col).cast("string"), F.lit("")).alias("url"),
        payload.alias("payload"),
    )
    key = rows.select(
        ROW, "id", F.sha2("payload", 256).alias("digest"), F.octet_length("payload").alias("size")
    )
    key = stored(key, "payload-digests")
    large = key.where(F.col("size") >= min_bytes)
    first = F.min(F.struct(F.col("id").isNull().alias("no_id"), "id", ROW))
    firsts = large.groupBy("digest", "size").agg(first.alias("first"))
    marks = large.join(firsts, ["digest", "size"]).where(F.col(ROW) != F.col(f"first.{ROW}"))
    marks = marks.select(
        ROW, F.col("first.id").alias("refers_to"), F.col(f"first.{ROW}").alias("refers_row")
    )
    digests = key.select(ROW, "digest").join(marks, ROW, "left")
    return rows.join(digests, ROW).withColumn(
        "record_type", F.when(F.col("refers_row").isNull(), "response").otherwise("revisit")
    )


def _uuid(row: int) -> str:
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_OID, str(row))}>"


def record_bytes(row: dict) -> bytes:
    """One WARC record; a revisit has no block, its digest and length name the full payload."""
    revisit = row["record_type"] == "revisit"
    block = b"" if revisit else row["payload"]
    head = {
        "WARC-Type": row["record_type"],
        "WARC-Record-ID": _uuid(row[ROW]),
        "WARC-Date": WARC_DATE,
        "WARC-Target-URI": "".join(c for c in row["url"] if c not in "\r\n"),
        "WARC-Payload-Digest": f"sha256:{row['digest']}",
        "Page-ID": "" if row["id"] is None else str(row["id"]),
        "Payload-Length": str(len(row["payload"])),
        "Content-Type": "text/html; charset=utf-8",
    }
    if revisit:
        head["WARC-Profile"] = (
            "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
        )
        head["WARC-Refers-To"] = _uuid(row["refers_row"])
        head["Refers-To-Page-ID"] = "" if row["refers_to"] is None else str(row["refers_to"])
    head["Content-Length"] = str(len(block))
    lines = "".join(f"{name}: {value}\r\n" for name, value in head.items())
    return b"WARC/1.1\r\n" + lines.encode() + b"\r\n" + block + END


def parse_record(data: bytes) -> tuple[dict[str, str], bytes, int] | None:
    """Headers, block and length of the record that ``data`` starts with; None if cut off."""
    head_end = data.find(END)
    if head_end < 0:
        return None
    lines = data[:head_end].decode().split("\r\n")
    if not lines[0].startswith("WARC/"):
        raise ValueError(f"not a WARC record: {lines[0][:40]!r}")
    head = dict(line.split(": ", 1) if ": " in line else (line.rstrip(":"), "") for line in lines[1:])
    start = head_end + len(END)
    end = start + int(head["Content-Length"])
    if len(data) < end + len(END):
        return None
    return head, data[start:end], end + len(END)


def _open(uri: str) -> tuple[fs.FileSystem, str]:
    store, path = fs.FileSystem.from_uri(f"file://{uri}" if uri.startswith("/") else uri)
    return store, path.rstrip("/")


def _new_file(store: fs.FileSystem, folder: str, ending: str) -> tuple[str, pa.NativeFile]:
    """A file of a name no other attempt has."""
    store.create_dir(folder, recursive=True)
    path = f"{folder}/{uuid.uuid4().hex}{ending}"
    return path, store.open_output_stream(path, compression=None)


def write_archives(records: DataFrame, folder: str, archive_bytes: int = ARCHIVE_BYTES) -> DataFrame:
    """Write the rows of ``mark_revisits`` as monolithic archives under ``folder``; one row
    per archive: ``path`` and ``records``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, base = _open(folder)
        path, out, squeeze, size, count = "", None, None, 0, 0

        def close() -> pa.RecordBatch:
            out.write(squeeze.flush())
            out.close()
            return pa.RecordBatch.from_pydict({"path": [path], "records": [count]})

        for batch in batches:
            for i in range(batch.num_rows):
                if out is not None and size >= archive_bytes:
                    yield close()
                    out = None
                if out is None:
                    path, out = _new_file(store, base, ".warc.gz")
                    squeeze, size, count = zlib.compressobj(wbits=31), 0, 0
                record = record_bytes({n: batch.column(n)[i].as_py() for n in batch.schema.names})
                out.write(squeeze.compress(record))
                size, count = size + len(record), count + 1
        if out is not None:
            yield close()

    return stored(map_arrow(records, run, "path string, records long"), "archives")


def _inflate(source: pa.NativeFile) -> Iterator[bytes]:
    """The content of a gzip file, member after member, in chunks."""
    engine = zlib.decompressobj(wbits=31)
    while chunk := source.read(CHUNK):
        while chunk:
            yield engine.decompress(chunk)
            chunk = engine.unused_data
            if engine.eof:
                engine = zlib.decompressobj(wbits=31)


def _records(source: pa.NativeFile) -> Iterator[tuple[bytes, dict[str, str]]]:
    """Each record of a stream, with its headers; holds one record and one chunk."""
    pending = bytearray()
    need = 0
    for chunk in _inflate(source):
        pending += chunk
        if len(pending) < need:
            continue
        at, need = 0, 0
        view = bytes(pending)
        while at < len(view):
            rest = view[at:] if at else view
            parsed = parse_record(rest)
            if parsed is None:
                # A long record: wait until as much again has come, not for every chunk.
                need = 2 * len(rest) if len(rest) > CHUNK else 0
                break
            yield rest[: parsed[2]], parsed[0]
            at += parsed[2]
        pending = bytearray(view[at:])
    while pending:
        parsed = parse_record(bytes(pending))
        if parsed is None:
            raise ValueError("archive ends within a record")
        yield bytes(pending[: parsed[2]]), parsed[0]
        del pending[: parsed[2]]


def normalise_archives(archives: DataFrame, folder: str) -> DataFrame:
    """Rewrite every archive (column ``path``) with a gzip member per record, and beside it a
    sidecar index of JSON lines. One row per archive: ``path``, ``index`` and ``records``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for source in batch.column("path").to_pylist():
                store, base = _open(folder)
                path, out = _new_file(store, base, ".warc.gz")
                index = f"{path}.index.jsonl"
                offset, count = 0, 0
                with (
                    store.open_input_stream(source, compression=None) as stream,
                    out,
                    store.open_output_stream(index, compression=None) as side,
                ):
                    for record, head in _records(stream):
                        squeeze = zlib.compressobj(wbits=31)
                        member = squeeze.compress(record) + squeeze.flush()
                        entry = {
                            "offset": offset,
                            "length": len(member),
                            "id": head["WARC-Record-ID"],
                            "type": head["WARC-Type"],
                        }
                        side.write(json.dumps(entry).encode() + b"\n")
                        out.write(member)
                        offset, count = offset + len(member), count + 1
                yield pa.RecordBatch.from_pydict(
                    {"path": [path], "index": [index], "records": [count]}
                )

    # A row is a whole file, so each task should get few.
    count = archives.count() or 1
    spread = archives.repartition(min(count, 10_000), "path")
    out = map_arrow(spread, run, "path string, index string, records long")
    return stored(out, "normal-archives")


def read_archives(normal: DataFrame, folder: str) -> DataFrame:
    """The records of normalised archives: ``page_id``, ``url``, ``record_type``, ``refers_to``,
    ``payload`` (null for revisits), ``payload_bytes`` and ``payload_digest`` of the full
    payload. A digest that the payload does not have is an error."""
    kinds = pa.schema(
        [
            ("page_id", pa.int64()),
            ("url", pa.string()),
            ("record_type", pa.string()),
            ("refers_to", pa.int64()),
            ("payload", pa.binary()),
            ("payload_bytes", pa.int64()),
            ("payload_digest", pa.string()),
        ]
    )

    def number(text: str | None) -> int | None:
        return int(text) if text else None

    def row(member: bytes) -> dict:
        head, block, _ = parse_record(zlib.decompress(member, wbits=31))
        digest, size = head["WARC-Payload-Digest"].removeprefix("sha256:"), int(head["Payload-Length"])
        revisit = head["WARC-Type"] == "revisit"
        if not revisit:
            if hashlib.sha256(block).hexdigest() != digest:
                raise ValueError(f"payload differs from its digest: {head['WARC-Record-ID']}")
            size = len(block)
        return {
            "page_id": number(head["Page-ID"]),
            "url": head["WARC-Target-URI"],
            "record_type": head["WARC-Type"],
            "refers_to": number(head.get("Refers-To-Page-ID")),
            "payload": None if revisit else block,
            "payload_bytes": size,
            "payload_digest": digest,
        }

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, _ = _open(folder)
        for batch in batches:
            for path, index in zip(batch.column("path").to_pylist(), batch.column("index").to_pylist()):
                with (
                    store.open_input_file(path) as file,
                    store.open_input_stream(index, compression=None) as side,
                ):
                    rows, size = [], 0
                    for line in side.read().splitlines():
                        place = json.loads(line)
                        file.seek(place["offset"])
                        rows.append(row(file.read(place["length"])))
                        size += rows[-1]["payload_bytes"]
                        if size >= 8 << 20 or len(rows) >= 4096:
                            yield pa.RecordBatch.from_pylist(rows, schema=kinds)
                            rows, size = [], 0
                    if rows:
                        yield pa.RecordBatch.from_pylist(rows, schema=kinds)

    return map_arrow(
        normal,
        run,
        "page_id long, url string, record_type string, refers_to long, payload binary, "
        "payload_bytes long, payload_digest string",
    )


def warc_round_trip(pages: DataFrame, archive_bytes: int = ARCHIVE_BYTES, **columns) -> DataFrame:
    """Write ``pages`` as monolithic archives, normalise them and read every record back.

    Null ids and urls stay null or become empty; empty payloads are written as such; repeated
    rows give a record each; an empty table writes no archive and gives no rows. Other
    columns of ``pages`` are left out.
    """
    spark = pages.sparkSession
    raw, normal = scratch_path(spark, "warc-raw"), scratch_path(spark, "warc-normal")
    archives = write_archives(mark_revisits(pages, **columns), raw, archive_bytes)
    return read_archives(normalise_archives(archives, normal), normal)
