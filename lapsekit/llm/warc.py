"""WARC archives of pages, normalised to one gzip member per record.

Pages become ``response`` records, or ``revisit`` records where an equal payload is
kept elsewhere, and Spark's text writer writes them as gzip files: each file is one
monolithic stream, from which no record can be read alone. The normaliser inflates such a
stream once, in small chunks, cuts it at the records' stated lengths, writes every
record as a gzip member of its own and notes where each member lies in a sidecar index.
Reading back goes by that index: members are inflated one by one, parsed and checked.
"""

from __future__ import annotations

import base64
import hashlib
import io
import json
import os
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from lapsekit.session import materialize, shared_folder

CHUNK, LEVEL = 1 << 16, 3
ROWS_PER_FILE = 4000
NO_PAYLOAD = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
# Pages carry no capture time; all records state the same one, so equal inputs give equal archives.
DATE = "2000-01-01T00:00:00Z"


def base32_sha1(payload: bytes) -> str:
    """The bare digest: upper-case base32 of SHA-1."""
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def _one_line(text: str | None) -> str:
    return (text or "").replace("\r", "%0D").replace("\n", "%0A")


def header(kind: str, page: int | None, url: str | None, digest: str, size: int, length: int, refers_to: int | None, target: str | None) -> str:
    """The header block of a record, without its last empty line."""
    lines = [
        "WARC/1.1", f"WARC-Type: {kind}", f"WARC-Record-ID: <urn:page:{'' if page is None else page}>", f"WARC-Date: {DATE}",
        f"WARC-Target-URI: {_one_line(url)}", "Content-Type: text/html; charset=utf-8", f"WARC-Payload-Digest: sha1:{digest}",
        f"X-Payload-Bytes: {size}",
    ]
    if kind == "revisit":
        lines += [f"WARC-Refers-To: <urn:page:{refers_to}>", f"WARC-Refers-To-Target-URI: {_one_line(target)}", f"WARC-Profile: {NO_PAYLOAD}"]
    return "\r\n".join([*lines, f"Content-Length: {length}"]) + "\r\n"


def fields(head: bytes) -> dict[str, str]:
    """Names in lower case and values of a header block."""
    lines = head.decode().split("\r\n")
    return {name.lower(): value for name, _, value in (line.partition(": ") for line in lines[1:] if line)}


def records(stream: Iterator[bytes]) -> Iterator[tuple[bytes, bytes]]:
    """Header and block of each record of an inflated stream; holds one record at a time."""
    held, ended = bytearray(), False

    def fill(n: int) -> bool:
        nonlocal ended
        while len(held) < n and not ended:
            chunk = next(stream, None)
            if chunk is None:
                ended = True
            else:
                held.extend(chunk)
        return len(held) >= n

    while True:
        looked = 0
        while (end := held.find(b"\r\n\r\n", max(0, looked - 3))) < 0:
            looked = len(held)
            if not fill(looked + 1):
                if held.strip():
                    raise ValueError("the stream ends inside a record header")
                return
        head = bytes(held[:end])
        if not head.startswith(b"WARC/"):
            raise ValueError("no record begins here")
        length = int(fields(head)["content-length"])
        if not fill(end + 4 + length + 4) or held[end + 4 + length : end + 8 + length] != b"\r\n\r\n":
            raise ValueError("a record is cut short")
        yield head, bytes(held[end + 4 : end + 4 + length])
        del held[: end + 8 + length]


def inflate(stream: io.IOBase) -> Iterator[bytes]:
    """The bytes of a gzip file of one or more members, in chunks of bounded size."""
    engine = zlib.decompressobj(wbits=31)
    while chunk := stream.read(CHUNK):
        while chunk:
            out = engine.decompress(chunk, 16 * CHUNK)
            if out:
                yield out
            chunk = engine.unconsumed_tail
            if engine.eof:
                chunk = engine.unused_data
                engine = zlib.decompressobj(wbits=31)
    while out := engine.decompress(engine.unconsumed_tail, 16 * CHUNK):
        yield out


def member(head: bytes, block: bytes) -> bytes:
    """One record as a gzip member; the same record always gives the same bytes."""
    engine = zlib.compressobj(LEVEL, wbits=31)
    return engine.compress(b"".join((head, b"\r\n\r\n", block, b"\r\n\r\n"))) + engine.flush()


def _open(path: str):
    """A file system and a path inside it for any location Spark's settings may name."""
    from pyarrow import fs

    if "://" not in path:
        path = "file://" + path.removeprefix("file:")
    return fs.FileSystem.from_uri(path)


def _normalise(folder: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path in batch.column("path").to_pylist():
                system, place = _open(path)
                name = os.path.basename(place).removesuffix(".gz").removesuffix(".txt")
                target, base = _open(f"{folder}/{name}.warc.gz")
                trial = f"{base}.{uuid.uuid4().hex}"
                index, at = [], 0
                # Written aside and moved into place: a task that is run again replaces whole files only.
                with system.open_input_stream(place, compression=None) as source, target.open_output_stream(trial, compression=None) as sink:
                    for head, block in records(inflate(source)):
                        data = member(head, block)
                        index.append((at, len(data), fields(head)["warc-record-id"]))
                        sink.write(data)
                        at += len(data)
                lines = "".join(json.dumps({"offset": a, "length": n, "id": i}) + "\n" for a, n, i in index)
                with target.open_output_stream(trial + ".index", compression=None) as sink:
                    sink.write(lines.encode())
                target.move(trial, base)
                target.move(trial + ".index", base + ".index")
                yield pa.RecordBatch.from_arrays(
                    [pa.array([f"{folder}/{name}.warc.gz"]), pa.array([len(index)], pa.int64()), pa.array([at], pa.int64())],
                    names=["path", "n_records", "n_bytes"],
                )

    return run


def normalise(spark: SparkSession, monolithic: str, folder: str) -> DataFrame:
    """``path, n_records, n_bytes`` of the normalised archives; one task per file, which holds one record at a time."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.gz").load(monolithic).select("path")
    system, place = _open(folder)
    system.create_dir(place)
    return files.repartition(spark.sparkContext.defaultParallelism * 4).mapInArrow(_normalise(folder), "path string, n_records long, n_bytes long")


def _texts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        out = []
        for page, url, html, best in zip(*(batch.column(c).to_pylist() for c in ("page_id", "url", "html", "best"))):
            payload = (html or "").encode()
            digest, kept = base32_sha1(payload), best is None or page == best
            if kept:
                top = header("response", page, url, digest, len(payload), len(payload), None, None)
            else:
                top = header("revisit", page, url, digest, len(payload), 0, best, url)
            # The writer ends every row with a line break, the last one of the record.
            out.append(f"{top}\r\n{(html or '') if kept else ''}\r\n")
        yield pa.RecordBatch.from_arrays([pa.array(out, pa.string())], names=["value"])


def write_monolithic(pages: DataFrame, folder: str, least: int = 0) -> None:
    """Write ``pages(page_id, url, html)`` as monolithic gzip WARC files.

    Of pages with equal payloads of at least ``least`` bytes the one with the largest
    ``page_id`` is the response (each of them, if rows repeat it), the others revisit
    it; smaller ones are all responses. A null html is an empty payload. Pages without
    an id revisit one that has an id; among themselves they are all responses. The
    largest id of each payload comes from partial aggregates over digests, so a payload
    that a third of the pages share does not gather anywhere.
    """
    text = F.coalesce(F.col("html").cast("string"), F.lit(""))
    base = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), text.alias("html"))
    # Payloads are told apart by SHA-256: SHA-1, which the header states, can be made to collide.
    base = base.withColumn("content", F.sha2("html", 256))
    groups = base.where(F.octet_length("html") >= least).groupBy("content").agg(F.count("*").alias("n"), F.max("page_id").alias("best"))
    # Written first, so its size is known: a small table is broadcast and the pages are not shuffled, a large one is joined by shuffle.
    repeated = materialize(groups.where("n > 1").select("content", "best"), "repeated")
    marked = base.join(repeated, "content", "left")
    (
        marked.select("page_id", "url", "html", "best").mapInArrow(_texts, "value string").write
        .option("compression", "gzip").option("lineSep", "\r\n").option("maxRecordsPerFile", ROWS_PER_FILE).text(folder)
    )


def _read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Every record by its index entry; the digest and the lengths of what was inflated are checked."""
    for batch in batches:
        for path in batch.column("path").to_pylist():
            system, place = _open(path)
            with system.open_input_stream(place + ".index", compression=None) as source:
                entries = [json.loads(line) for line in source.read().decode().splitlines()]
            rows = []
            with system.open_input_file(place) as source:
                for entry in entries:
                    source.seek(entry["offset"])
                    (head, block), = records(iter([zlib.decompress(source.read(entry["length"]), wbits=31)]))
                    names = fields(head)
                    kind, digest, size = names["warc-type"], names["warc-payload-digest"].removeprefix("sha1:"), int(names["x-payload-bytes"])
                    if names["warc-record-id"] != entry["id"] or kind == "response" and (base32_sha1(block) != digest or len(block) != size):
                        raise ValueError(f"record {entry['id']} of {path} does not match its index or digest")
                    page, refers = _page(names["warc-record-id"]), _page(names["warc-refers-to"]) if kind == "revisit" else None
                    rows.append((page, size, digest, kind, refers, names["warc-target-uri"], block.decode() if kind == "response" else None))
                    if len(rows) == 500:
                        yield _rows(rows)
                        rows = []
            if rows:
                yield _rows(rows)


def _page(record_id: str) -> int | None:
    number = record_id.removeprefix("<urn:page:").removesuffix(">")
    return int(number) if number else None


_KINDS = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.string(), pa.string()]
SCHEMA = "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long, url string, payload string"


def _rows(rows: list[tuple]) -> pa.RecordBatch:
    names = [column.split()[0] for column in SCHEMA.split(", ")]
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), _KINDS)], names=names)


def read(archives: DataFrame) -> DataFrame:
    """The records of normalised ``archives(path)``; the payload of a revisit is null."""
    return archives.select("path").repartition(archives.sparkSession.sparkContext.defaultParallelism * 4).mapInArrow(_read, SCHEMA)


def archived(pages: DataFrame, least: int = 0) -> DataFrame:
    """Write ``pages`` as archives, normalise them in the shared folder and read all records back.

    One row per page: ``page_id, payload_bytes, payload_digest, record_type, refers_to,
    url, payload``. No pages give no rows; other columns are ignored.
    """
    spark = pages.sparkSession
    raw, folder = shared_folder(spark, "warc-raw"), shared_folder(spark, "warc")
    write_monolithic(pages, raw, least)
    # The list of archives is written, so that reading records never rewrites them.
    archives = shared_folder(spark, "warc-list")
    normalise(spark, raw, folder).write.parquet(archives)
    return read(spark.read.parquet(archives))
