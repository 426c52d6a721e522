"""WARC archives in seekable Zstandard bundles.

Records are grouped into frames that decompress on their own; a skippable frame
at the end of each bundle holds the seek table (compressed and decompressed size
of every frame).  Writing returns an index from record ids to bundle, frame and
offset inside the frame, so one record costs one frame to read.

Equal payloads (by SHA-1 and length) are stored once: the record of the smallest
page_id is the response, others are revisits that refer to it and keep only
their HTTP headers, whose Content-Length tells the payload's size.

Tasks write below the shared folder through Arrow's file systems, each attempt
under a name of its own; the index, written as a table, names the files of the
attempts that succeeded, so a lost executor leaves no half-known bundle.

Cases: a null html is the empty payload; a null url has no target line; rows
that repeat a page_id and payload are records of one type; a null page_id is
never the response that others refer to unless all are null, and then all are
responses; an empty table writes no bundle; extra columns are ignored.
"""

from __future__ import annotations

import struct
import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarry.llm import common
from quarry.session import scratch_dir

FRAMES_A_TASK = 64  # read by one task: 16 MB of records
FRAME_BYTES, BUNDLE_BYTES = 256 << 10, 128 << 20  # decompressed frame, compressed bundle
SKIPPABLE, SEEKABLE = 0x184D2A5E, 0x8F92EAB1  # magic numbers of the seekable format
INDEX = "page_id long, bundle string, frame int, at long, size long, offset long, length long"
READ = "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long"


def _record(page: int | None, url: str | None, payload: bytes, digest: str, first: int | None) -> bytes:
    """One record; ``first`` is the page it refers to, None for a response."""
    http = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n" % len(payload)
    block = http + payload if first is None else http
    name = "" if page is None else page
    lines = ["WARC/1.1", f"WARC-Type: {'response' if first is None else 'revisit'}", f"WARC-Record-ID: <urn:page:{name}>", "WARC-Date: 1970-01-01T00:00:00Z"]
    if url is not None:
        lines.append("WARC-Target-URI: " + url.replace("\r", "%0D").replace("\n", "%0A"))
    lines.append(f"WARC-Payload-Digest: sha1:{digest}")
    if first is not None:
        lines.append("WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest")
        lines.append(f"WARC-Refers-To: <urn:page:{first}>")
    lines += ["Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}", "", ""]
    return "\r\n".join(lines).encode() + block + b"\r\n\r\n"


def _digest(payload: bytes) -> str:
    import base64
    import hashlib

    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def _parse(data: bytes, at: int) -> tuple[dict[str, str], bytes, int]:
    """Headers and block of the record at an offset, and the next offset."""
    end = data.index(b"\r\n\r\n", at)
    lines = data[at:end].decode().split("\r\n")
    head = dict(line.split(": ", 1) for line in lines[1:])
    size = int(head["Content-Length"])
    return head, data[end + 4 : end + 4 + size], end + 8 + size


def _row(head: dict[str, str], block: bytes) -> tuple[int | None, int, str, str, int | None]:
    number = lambda s: int(v) if (v := s.removeprefix("<urn:page:").removesuffix(">")) else None
    end = block.index(b"\r\n\r\n") + 4
    stated = int(dict(x.split(": ", 1) for x in block[: end - 4].decode().split("\r\n")[1:])["Content-Length"])
    digest, page = head["WARC-Payload-Digest"].removeprefix("sha1:"), number(head["WARC-Record-ID"])
    if head["WARC-Type"] == "revisit":
        return page, stated, digest, "revisit", number(head["WARC-Refers-To"])
    payload = block[end:]
    if len(payload) != stated or _digest(payload) != digest:
        raise ValueError(f"damaged record of page {page}")
    return page, stated, digest, "response", None


class _Bundle:
    """Writes frames and the seek table to one file."""

    def __init__(self, path: str):
        import zstandard as zs
        from pyarrow import fs

        files, name = fs.FileSystem.from_uri(path)
        files.create_dir(name.rsplit("/", 1)[0], recursive=True)
        self.path, self.out, self.at, self.sizes = path, files.open_output_stream(name, compression=None), 0, []
        self.pack = zs.ZstdCompressor(level=3).compress

    def frame(self, data: bytes) -> tuple[int, int, int]:
        packed = self.pack(data)
        self.out.write(packed)
        self.sizes.append((len(packed), len(data)))
        self.at += len(packed)
        return len(self.sizes) - 1, self.at - len(packed), len(packed)

    def close(self) -> None:
        table = b"".join(struct.pack("<II", *s) for s in self.sizes)
        footer = struct.pack("<IBI", len(self.sizes), 0, SEEKABLE)
        self.out.write(struct.pack("<II", SKIPPABLE, len(table) + len(footer)) + table + footer)
        self.out.close()


def seek_table(path: str) -> list[tuple[int, int]]:
    """(offset, compressed size) of each frame of a bundle, from its footer."""
    from pyarrow import fs

    files, name = fs.FileSystem.from_uri(path)
    with files.open_input_file(name) as f:
        size = f.size()
        n, flags, magic = struct.unpack("<IBI", f.read_at(9, size - 9))
        if magic != SEEKABLE:
            raise ValueError(f"{path} has no seek table")
        entry = 12 if flags & 0x80 else 8
        table, at, out = f.read_at(n * entry, size - 9 - n * entry), 0, []
    for i in range(n):
        packed = struct.unpack_from("<I", table, i * entry)[0]
        out.append((at, packed))
        at += packed
    return out


def write(pages: DataFrame, folder: str, least_bytes: int = 0) -> DataFrame:
    """Write all pages below ``folder``; returns the index of records."""
    rows = common.narrow(pages, page_id="long", url="string", html="string").withColumn("payload", F.coalesce("html", F.lit("")).cast("binary"))
    keyed = rows.select("page_id", F.sha1("payload").alias("sha"), F.length("payload").alias("size"))
    first = keyed.groupBy("sha", "size").agg(F.min("page_id").alias("first"))
    kind = keyed.distinct().join(first, ["sha", "size"]).select(
        F.col("page_id").alias("k"), F.col("sha").alias("s"),
        F.when((F.col("size") >= least_bytes) & ~F.coalesce(F.col("page_id") == F.col("first"), F.col("first").isNull()), F.col("first")).alias("refers_to"),
    )
    # the only shuffle of the payloads: to the bundles; the narrow side is hashed
    ready = (
        rows.select("page_id", "url", "payload", F.sha1("payload").alias("sha"))
        .join(kind.hint("shuffle_hash"), F.col("page_id").eqNullSafe(F.col("k")) & (F.col("sha") == F.col("s")))
        .select("page_id", "url", "payload", "refers_to")
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task = TaskContext.get()
        stem = f"{folder}/part-{task.partitionId():05d}-{task.taskAttemptId()}"
        bundle, made = None, 0
        held: list[tuple[int | None, bytes]] = []

        def flush() -> pa.RecordBatch:
            nonlocal bundle, made
            if bundle is None:
                bundle = _Bundle(f"{stem}-{made}.warc.zst")
                made += 1
            frame, at, size = bundle.frame(b"".join(r for _, r in held))
            lengths = [len(r) for _, r in held]
            offsets = [sum(lengths[:i]) for i in range(len(lengths))]
            n = len(held)
            out = pa.RecordBatch.from_arrays(
                [pa.array([p for p, _ in held], pa.int64()), pa.array([bundle.path] * n), pa.array([frame] * n, pa.int32()), pa.array([at] * n, pa.int64()),
                 pa.array([size] * n, pa.int64()), pa.array(offsets, pa.int64()), pa.array(lengths, pa.int64())],
                [c.split()[0] for c in INDEX.split(", ")],
            )
            held.clear()
            if bundle.at >= BUNDLE_BYTES:
                bundle.close()
                bundle = None
            return out

        size = 0
        for b in batches:
            for page, url, payload, refers in zip(*[b.column(c).to_pylist() for c in ("page_id", "url", "payload", "refers_to")], strict=True):
                held.append((page, _record(page, url, payload, _digest(payload), refers)))
                size += len(held[-1][1])
                if size >= FRAME_BYTES:
                    yield flush()
                    size = 0
        if held:
            yield flush()
        if bundle is not None:
            bundle.close()

    return common.stash(ready.mapInArrow(run, INDEX), "warc-index")


def _unpack(f, at: int, size: int) -> bytes:
    import zstandard as zs

    return zs.ZstdDecompressor().decompress(f.read_at(size, at))


def read(bundles: DataFrame) -> DataFrame:
    """Every record of the archives named in column ``bundle``, frame by frame."""

    def frames(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for path in b.column("bundle").to_pylist():
                spans = seek_table(path)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([path] * len(spans), pa.string()), pa.array([s[0] for s in spans], pa.int64()), pa.array([s[1] for s in spans], pa.int64())],
                    ["bundle", "at", "size"],
                )

    def records(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyarrow import fs

        for b in batches:
            for path, at, size in zip(*[b.column(c).to_pylist() for c in ("bundle", "at", "size")], strict=True):
                files, name = fs.FileSystem.from_uri(path)
                with files.open_input_file(name) as f:
                    data = _unpack(f, at, size)
                rows, at = [], 0
                while at < len(data):
                    head, block, at = _parse(data, at)
                    rows.append(_row(head, block))
                yield pa.RecordBatch.from_arrays(
                    [pa.array([r[i] for r in rows], t) for i, t in enumerate((pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64()))],
                    [c.split()[0] for c in READ.split(", ")],
                )

    spans = common.stash(bundles.select("bundle").distinct().mapInArrow(frames, "bundle string, at long, size long"), "frames")
    # the rows are tiny and the frames behind them are not: the number of tasks follows the frames
    tasks = max(1, -(-spans.count() // FRAMES_A_TASK))
    return spans.repartition(tasks, "bundle", "at").mapInArrow(records, READ)


def fetch(index: DataFrame) -> DataFrame:
    """The records of index rows, each read from its own frame by its offset."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyarrow import fs

        for b in batches:
            rows = []
            for path, at, size, offset in zip(*[b.column(c).to_pylist() for c in ("bundle", "at", "size", "offset")], strict=True):
                files, name = fs.FileSystem.from_uri(path)
                with files.open_input_file(name) as f:
                    head, block, _ = _parse(_unpack(f, at, size), offset)
                rows.append((*_row(head, block), block.split(b"\r\n\r\n", 1)[1]))
            kinds = (pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.binary())
            yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], t) for i, t in enumerate(kinds)], [*[c.split()[0] for c in READ.split(", ")], "payload"])

    return index.mapInArrow(run, READ + ", payload binary")


def roundtrip(pages: DataFrame, least_bytes: int = 0) -> DataFrame:
    """Write the archives, read them back whole."""
    folder = f"{scratch_dir(pages.sparkSession)}/llm-warc-{uuid.uuid4().hex}"
    return read(write(pages, folder if "://" in folder or folder.startswith("/") else folder.replace("file:", "file://", 1), least_bytes))


ORACLE_SQL = """
WITH p AS (SELECT page_id, coalesce(html, '') AS h FROM pages),
b AS (
  SELECT page_id, h, sha1(h) AS sha, min(page_id) OVER (PARTITION BY h) AS first FROM p),
c AS (
  SELECT *, array_to_string(list_transform(range(1, 41), lambda i:
    ['0000','0001','0010','0011','0100','0101','0110','0111','1000','1001','1010','1011','1100','1101','1110','1111']
    [instr('0123456789abcdef', substr(sha, i, 1))]), '') AS bits FROM b)
SELECT page_id, strlen(h) AS payload_bytes,
  array_to_string(list_transform(range(0, 32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', 1
    + 16 * substr(bits, 5 * i + 1, 1)::INT + 8 * substr(bits, 5 * i + 2, 1)::INT + 4 * substr(bits, 5 * i + 3, 1)::INT
    + 2 * substr(bits, 5 * i + 4, 1)::INT + substr(bits, 5 * i + 5, 1)::INT, 1)), '') AS payload_digest,
  CASE WHEN page_id = first THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN page_id <> first THEN first END AS refers_to
FROM c"""
