"""WARC bundles in seekable Zstandard files, with an index from records to frames.

A bundle is a `.warc.zst` file of independent frames, each with some whole WARC records
(`frame_bytes` of them before compression), closed by a skippable frame that holds the
seek table (compressed and plain size per frame) and its footer. The index table gives
for every record its bundle, frame, and place inside the frame, so one record costs one
read of the footer and one of its frame.

Pages with equal payloads (SHA-256) are written once: the one with the largest page_id
is the `response`, the others are `revisit` records without a payload that name it.

Bundles are written by tasks under names of their own in the shared folder; the manifest
is written by Spark and lists those of successful attempts only, so a lost executor or a
second attempt leaves at most files that nothing refers to. Input rows stream through: a
task holds one frame.

Edge cases: a null html is an empty payload; empty payloads are alike, too; a null
page_id is never the largest, and if all ids of equal payloads are null all are
responses; repeated rows of the response are responses again; extra columns are ignored.
"""

from __future__ import annotations

import base64
import hashlib
import struct
import uuid
from collections.abc import Iterator

import pyarrow as pa
import zstandard
from pyarrow import fs
from pyspark.sql import DataFrame, functions as F

from plumbline.llm.arrow import chunks
from plumbline.llm.catalogue import query
from plumbline.session import scratch_folder, stage

# fixed values of the seekable format
SKIPPABLE, FOOTER = 0x184D2A5E, 0x8F92EAB1
NAMES = uuid.UUID("6ba7b811-9dad-11d1-80b4-00c04fd430c8")  # name space of URLs
INDEX = "record_id string, page_id {kind}, record_type string, refers_to {kind}, payload_bytes long, payload_digest string, bundle string, frame int, start long, size long"


def opened(path: str) -> tuple[fs.FileSystem, str]:
    """The file system of a path or URI, and the path in it."""
    return fs.FileSystem.from_uri(path) if "://" in path or path.startswith("file:") else (fs.LocalFileSystem(), path)


def digest(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def record_id(page_id, sha1: str) -> str:
    return f"<urn:uuid:{uuid.uuid5(NAMES, f'{page_id}:{sha1}')}>"


def record(page_id, url: str | None, payload: bytes, kind: str, refers_to, sha1: str) -> bytes:
    """One WARC/1.1 record; a revisit has no block."""
    head = {
        "WARC-Type": kind,
        "WARC-Record-ID": record_id(page_id, sha1),
        "WARC-Target-URI": "".join((url or "").split()),
        "WARC-Date": "1970-01-01T00:00:00Z",
        "WARC-Payload-Digest": f"sha1:{sha1}",
        "X-Page-ID": "" if page_id is None else str(page_id),
        "X-Payload-Bytes": str(len(payload)),
    }
    if kind == "revisit":
        head |= {
            "WARC-Profile": "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest",
            "WARC-Refers-To": record_id(refers_to, sha1),
            "X-Refers-To-Page": str(refers_to),
        }
    block = b"" if kind == "revisit" else payload
    head |= {"Content-Type": "text/html; charset=utf-8", "Content-Length": str(len(block))}
    lines = "".join(f"{k}: {v}\r\n" for k, v in head.items())
    return f"WARC/1.1\r\n{lines}\r\n".encode() + block + b"\r\n\r\n"


def parse(data: bytes) -> Iterator[tuple[dict[str, str], bytes, int, int]]:
    """(headers, block, start, size) of the records in one frame's plain bytes."""
    at = 0
    while at < len(data):
        end = data.index(b"\r\n\r\n", at)
        lines = data[at:end].decode().split("\r\n")
        if not lines[0].startswith("WARC/"):
            raise ValueError("not a WARC record")
        head = dict(line.split(": ", 1) if ": " in line else (line.rstrip(":"), "") for line in lines[1:])
        start = end + 4
        stop = start + int(head["Content-Length"])
        yield head, data[start:stop], at, stop + 4 - at
        at = stop + 4


class Bundle:
    """A file being written: full frames go out at once, the seek table at the end."""

    def __init__(self, folder: str, level: int):
        self.path = f"{folder}/{uuid.uuid4().hex}.warc.zst"
        system, inner = opened(self.path)
        system.create_dir(inner.rsplit("/", 1)[0], recursive=True)
        self.file, self.packer = system.open_output_stream(inner, compression=None), zstandard.ZstdCompressor(level=level)
        self.sizes: list[tuple[int, int]] = []
        self.plain = 0

    def frame(self, data: bytes) -> None:
        packed = self.packer.compress(data)
        self.file.write(packed)
        self.sizes.append((len(packed), len(data)))
        self.plain += len(data)

    def close(self) -> None:
        entries = b"".join(struct.pack("<II", *pair) for pair in self.sizes)
        body = entries + struct.pack("<IBI", len(self.sizes), 0, FOOTER)
        self.file.write(struct.pack("<II", SKIPPABLE, len(body)) + body)
        self.file.close()


class Reader:
    """Frames of one bundle by number, through its seek table."""

    def __init__(self, path: str):
        system, inner = opened(path)
        self.file = system.open_input_file(inner)
        size = self.file.size()
        self.file.seek(size - 9)
        frames, _, magic = struct.unpack("<IBI", self.file.read(9))
        if magic != FOOTER:
            raise ValueError(f"{path} has no seek table")
        self.file.seek(size - 9 - 8 * frames)
        table = list(struct.iter_unpack("<II", self.file.read(8 * frames)))
        self.sizes, self.starts, at = table, [], 0
        for packed, _ in table:
            self.starts.append(at)
            at += packed

    def __len__(self) -> int:
        return len(self.sizes)

    def frame(self, number: int) -> bytes:
        self.file.seek(self.starts[number])
        packed, plain = self.sizes[number]
        return zstandard.ZstdDecompressor().decompress(self.file.read(packed), max_output_size=plain)

    def close(self) -> None:
        self.file.close()


def write_bundles(pages: DataFrame, folder: str | None = None, *, frame_bytes: int = 1 << 18, bundle_bytes: int = 1 << 28, level: int = 3) -> DataFrame:
    """Writes `pages` (page_id, url, html) and returns the index, itself a written table."""
    spark = pages.sparkSession
    folder = folder or scratch_folder(spark, "bundles")
    payload = F.coalesce("html", F.lit(""))
    rows = pages.select("page_id", "url", payload.alias("html"), F.sha2(payload, 256).alias("k"))
    chosen = rows.groupBy("k").agg(F.max("page_id").alias("chosen")).withColumnRenamed("k", "c_k")
    joined = rows.join(chosen, F.col("k") == F.col("c_k")).select("page_id", "url", "html", "chosen")
    kind = dict(pages.dtypes)["page_id"]
    schema = INDEX.format(kind=kind)
    names = [x.strip().split(" ")[0] for x in schema.split(",")]

    def run(batches):
        bundle, buffer, waiting, held = None, [], [], 0
        done: list[list] = []

        def flush():
            nonlocal bundle, held
            if not buffer:
                return
            bundle = bundle or Bundle(folder, level)
            number = len(bundle.sizes)
            bundle.frame(b"".join(buffer))
            done.extend([*row[:6], bundle.path, number, *row[6:]] for row in waiting)
            buffer.clear()
            waiting.clear()
            held = 0
            if bundle.plain >= bundle_bytes:
                bundle.close()
                bundle = None

        def rows_out():
            arrays = [pa.array([r[i] for r in done], t) for i, t in enumerate(types)]
            done.clear()
            return pa.RecordBatch.from_arrays(arrays, names)

        for part in chunks(batches, "html", 4_000_000):
            own = part.schema.field("page_id").type
            types = [pa.string(), own, pa.string(), own, pa.int64(), pa.string(), pa.string(), pa.int32(), pa.int64(), pa.int64()]
            for page, url, html, best in zip(*(part.column(c).to_pylist() for c in ("page_id", "url", "html", "chosen"))):
                raw = html.encode()
                kept = best is None or page == best
                sha1 = digest(raw)
                data = record(page, url, raw, "response" if kept else "revisit", best, sha1)
                waiting.append([record_id(page, sha1), page, "response" if kept else "revisit", None if kept else best, len(raw), sha1, held, len(data)])
                buffer.append(data)
                held += len(data)
                if held >= frame_bytes:
                    flush()
            if len(done) > 5000:
                yield rows_out()
        flush()
        if bundle is not None:
            bundle.close()
        if done:
            yield rows_out()

    return stage(joined.mapInArrow(run, schema), "index")


def read_bundles(bundles: DataFrame, kind: str = "bigint") -> DataFrame:
    """All records of the files in `bundle` (distinct values), frame by frame.

    page_id, url, record_type, refers_to, payload (null for a revisit), digest (stated), stated_bytes.
    """
    schema = "page_id string, url string, record_type string, refers_to string, payload binary, payload_digest string, stated_bytes long"

    def run(batches):
        for batch in batches:
            for path in batch.column("bundle").to_pylist():
                reader = Reader(path)
                for number in range(len(reader)):
                    rows = [
                        (h["X-Page-ID"] or None, h["WARC-Target-URI"], h["WARC-Type"], h.get("X-Refers-To-Page"), None if h["WARC-Type"] == "revisit" else block, h["WARC-Payload-Digest"].removeprefix("sha1:"), int(h["X-Payload-Bytes"]))
                        for h, block, _, _ in parse(reader.frame(number))
                    ]
                    types = [pa.string(), pa.string(), pa.string(), pa.string(), pa.binary(), pa.string(), pa.int64()]
                    yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], t) for i, t in enumerate(types)], [c.split(" ")[0] for c in schema.split(", ")])
                reader.close()

    files = bundles.select("bundle").distinct().repartition("bundle")
    read = files.mapInArrow(run, schema)
    return read.withColumns({"page_id": F.col("page_id").cast(kind), "refers_to": F.col("refers_to").cast(kind)})


def fetch(index: DataFrame) -> DataFrame:
    """(record_id, payload) of the index rows given, reading only their frames; null for revisits."""

    def run(batches):
        reader, opened_path, frame_at, data = None, None, None, b""
        for batch in batches:
            out = []
            for path, number, start, size in zip(*(batch.column(c).to_pylist() for c in ("bundle", "frame", "start", "size"))):
                if path != opened_path:
                    if reader is not None:
                        reader.close()
                    reader, opened_path, frame_at = Reader(path), path, None
                if number != frame_at:
                    data, frame_at = reader.frame(number), number
                head, block, _, _ = next(parse(data[start : start + size]))
                out.append(None if head["WARC-Type"] == "revisit" else block)
            yield pa.RecordBatch.from_arrays([batch.column("record_id"), pa.array(out, pa.binary())], ["record_id", "payload"])
        if reader is not None:
            reader.close()

    sorted_rows = index.select("record_id", "bundle", "frame", "start", "size").repartition("bundle", "frame").sortWithinPartitions("bundle", "frame", "start")
    return sorted_rows.mapInArrow(run, "record_id string, payload binary")


@query("op3_warc_bundles")
def op3_warc_bundles(t) -> DataFrame:
    pages = t("pages")
    kind = dict(pages.dtypes)["page_id"]
    index = write_bundles(pages)

    def measured(batches):
        for part in batches:
            payloads = part.column("payload").to_pylist()
            sizes = pa.array([None if p is None else len(p) for p in payloads], pa.int64())
            sums = pa.array([None if p is None else digest(p) for p in payloads], pa.string())
            columns = [part.column(c) for c in ("page_id", "record_type", "refers_to", "payload_digest")]
            yield pa.RecordBatch.from_arrays([*columns, sizes, sums], ["page_id", "record_type", "refers_to", "stated", "bytes", "sha1"])

    read = stage(
        read_bundles(index, kind).mapInArrow(measured, f"page_id {kind}, record_type string, refers_to {kind}, stated string, bytes long, sha1 string"), "read"
    )
    # a revisit's payload is the one of the response that it names; distinct, as repeated rows repeat it
    targets = read.where(F.col("record_type") == "response").select(F.col("page_id").alias("t_page"), F.col("bytes").alias("t_bytes"), F.col("sha1").alias("t_sha1")).distinct()
    on = (F.col("refers_to") == F.col("t_page")) & (F.col("stated") == F.col("t_sha1"))
    return read.join(targets, on, "left").select(
        "page_id",
        F.coalesce("bytes", "t_bytes").alias("payload_bytes"),
        F.coalesce("sha1", "t_sha1").alias("payload_digest"),
        "record_type",
        "refers_to",
    )

