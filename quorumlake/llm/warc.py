"""WARC archives as a PySpark Python data source.

``spark.read.format("warc")`` plans one task a file, pushes predicates on the record headers down,
parses headers first and inflates a payload only if its record is wanted. ``df.write.format("warc")``
writes gzip members of one record each, with the standard's ``sl`` field (compressed and plain
length), so that a reader can step over a member without inflating it. Files roll at a size, so that
one file, the unit of a task, stays bounded. Tasks write under names of their own; the driver's commit
writes the list of those that count, so what failed or repeated attempts leave behind is never read.

Paths go through ``pyarrow.fs``: any folder that driver and executors share, local or remote.
"""

from __future__ import annotations

import json
import struct
import uuid
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyarrow import fs as pafs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, DataSourceReader, InputPartition, WriterCommitMessage

from quorumlake.plans.joins import BROADCAST_ROWS
from quorumlake.plans.staging import Stage

SCHEMA = (
    "warc_type string, record_id string, target_uri string, refers_to string, payload_digest string, "
    "payload_bytes bigint, content_length bigint, headers map<string,string>, payload binary"
)
ARROW = pa.schema(
    [(c, pa.string()) for c in ("warc_type", "record_id", "target_uri", "refers_to", "payload_digest")]
    + [("payload_bytes", pa.int64()), ("content_length", pa.int64()), ("headers", pa.map_(pa.string(), pa.string())), ("payload", pa.binary())]
)
MANIFEST = "_files.json"
#: Fixed values of the format.
VERSION = b"WARC/1.1"
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
NO_DATE = "1970-01-01T00:00:00Z"


def _open(path: str) -> tuple[pafs.FileSystem, str]:
    return pafs.FileSystem.from_uri(path)


def _line(text: str) -> str:
    """A header value on one line."""
    return "".join(c if c.isprintable() else "%" + "%".join(f"{b:02X}" for b in c.encode()) for c in text)


# ---------------------------------------------------------------- records


def record(row: dict) -> tuple[bytes, bytes]:
    """Header block and content block of a row of the writer's schema."""
    payload = row.get("payload") or b""
    revisit = row["warc_type"] == "revisit"
    size = row["payload_bytes"] if row.get("payload_bytes") is not None else len(payload)
    http = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n" % size
    block = http if revisit else http + payload
    names = [("WARC-Type", row["warc_type"]), ("WARC-Record-ID", f"<{_line(row['record_id'])}>"), ("WARC-Date", NO_DATE)]
    if row.get("target_uri") is not None:
        names.append(("WARC-Target-URI", _line(row["target_uri"])))
    if row.get("payload_digest") is not None:
        names.append(("WARC-Payload-Digest", f"sha256:{row['payload_digest']}"))
    if revisit:
        names += [("WARC-Refers-To", f"<{_line(row['refers_to'])}>"), ("WARC-Profile", REVISIT_PROFILE)]
    names += [("Content-Type", "application/http; msgtype=response"), ("Content-Length", str(len(block)))]
    head = VERSION + b"\r\n" + "".join(f"{k}: {v}\r\n" for k, v in names).encode() + b"\r\n"
    return head, block


def member(data: bytes, level: int = 6) -> bytes:
    """A gzip member of ``data`` with the ``sl`` extra field (left out beyond its 32 bits)."""
    packer = zlib.compressobj(level, zlib.DEFLATED, -15)
    body = packer.compress(data) + packer.flush()
    tail = struct.pack("<II", zlib.crc32(data), len(data) & 0xFFFFFFFF)
    total = 10 + 2 + 12 + len(body) + 8
    if total >= 1 << 32 or len(data) >= 1 << 32:
        return b"\x1f\x8b\x08\x00\0\0\0\0\x00\xff" + body + tail
    extra = b"sl" + struct.pack("<HII", 8, total, len(data))
    return b"\x1f\x8b\x08\x04\0\0\0\0\x00\xff" + struct.pack("<H", len(extra)) + extra + body + tail


class _Source:
    """A file read forward in blocks, with steps ahead that read nothing."""

    def __init__(self, file, block: int = 1 << 18):
        self.file, self.block, self.buf, self.at = file, block, b"", 0
        self.size = file.size()

    def need(self, n: int) -> bytes:
        """The next ``n`` bytes, or what is left, without moving on."""
        if len(self.buf) < n:
            self.file.seek(self.at + len(self.buf))
            self.buf += self.file.read(max(self.block, n - len(self.buf)))
        return self.buf[:n]

    def step(self, n: int) -> None:
        self.at += n
        self.buf = self.buf[n:]

    def done(self) -> bool:
        return self.at >= self.size


def _headers(block: bytes) -> dict[str, str]:
    lines = block.decode("utf-8", "replace").split("\r\n")
    out: dict[str, str] = {}
    for line in lines[1:]:
        k, colon, v = line.partition(":")
        if colon:
            out[k.strip()] = v.strip()
    return out


def _gzip_start(src: _Source) -> tuple[int, int | None]:
    """Length of the member's own header, and the member's whole length if ``sl`` tells it."""
    h = src.need(12)
    if h[:3] != b"\x1f\x8b\x08":
        raise ValueError(f"not a gzip member at byte {src.at}")
    flags, n, whole = h[3], 10, None
    if flags & 4:
        xlen = struct.unpack("<H", h[10:12])[0]
        extra = src.need(12 + xlen)[12:]
        at = 0
        while at + 4 <= len(extra):
            size = struct.unpack("<H", extra[at + 2 : at + 4])[0]
            if extra[at : at + 2] == b"sl":
                whole = struct.unpack("<I", extra[at + 4 : at + 8])[0]
            at += 4 + size
        n = 12 + xlen
    for bit in (8, 16):  # name and comment
        if flags & bit:
            end = n
            while (i := src.need(end + 256).find(b"\0", n)) < 0:
                end += 256
            n = i + 1
    return n + (2 if flags & 2 else 0), whole


def read_records(file, wanted, payloads: bool) -> Iterator[tuple[dict, bytes | None]]:
    """``(headers, block)`` of each record that ``wanted(headers)`` accepts; block None unless ``payloads``.

    Headers come first: the rest of an unwanted record is stepped over, and not inflated if its
    length is known.
    """
    src = _Source(file)
    while not src.done():
        if src.need(2) == b"\x1f\x8b":
            start, whole = _gzip_start(src)
            unzip, data, used = zlib.decompressobj(-15), b"", start
            src.step(start)
            while b"\r\n\r\n" not in data and not unzip.eof:
                piece = src.need(4096)[:4096]
                if not piece:
                    raise ValueError(f"a record is cut off at byte {src.at}")
                data += unzip.decompress(piece)
                n = len(piece) - len(unzip.unused_data)
                src.step(n)
                used += n
            head, _, rest = data.partition(b"\r\n\r\n")
            headers = _headers(head)
            take = wanted(headers)
            if take and payloads or whole is None:
                parts = [rest]
                while not unzip.eof:
                    piece = src.need(1 << 16)
                    if not piece:
                        raise ValueError(f"a record is cut off at byte {src.at}")
                    parts.append(unzip.decompress(piece))
                    src.step(len(piece) - len(unzip.unused_data))
                src.step(8)
                rest = b"".join(parts)
            else:
                src.step(whole - used)
            if take:
                yield headers, rest[: int(headers["Content-Length"])] if payloads else None
            continue
        size = 4096
        while (end := src.need(size).find(b"\r\n\r\n")) < 0:
            if len(src.need(size)) < size:
                if src.need(size).strip():
                    raise ValueError(f"a record is cut off at byte {src.at}")
                return
            size *= 2
        headers = _headers(src.need(end))
        src.step(end + 4)
        n = int(headers["Content-Length"])
        if wanted(headers):
            yield headers, bytes(src.need(n)) if payloads else None
        src.step(n + 4)


# ---------------------------------------------------------------- the data source


@dataclass
class WarcFile(InputPartition):
    path: str

    def __init__(self, path: str):
        self.path = path


@dataclass
class Written(WriterCommitMessage):
    files: list[str]


_HEADER_OF = {"warc_type": "WARC-Type", "record_id": "WARC-Record-ID", "target_uri": "WARC-Target-URI", "refers_to": "WARC-Refers-To", "content_length": "Content-Length"}


def _value(column: str, headers: dict):
    v = headers.get(_HEADER_OF[column])
    if v is None:
        return None
    return int(v) if column == "content_length" else v.strip("<>") if column in ("record_id", "refers_to") else v


_TESTS = {
    "EqualTo": lambda a, b: a == b,
    "In": lambda a, b: a in b,
    "GreaterThan": lambda a, b: a > b,
    "GreaterThanOrEqual": lambda a, b: a >= b,
    "LessThan": lambda a, b: a < b,
    "LessThanOrEqual": lambda a, b: a <= b,
    "StringStartsWith": lambda a, b: a.startswith(b),
    "StringEndsWith": lambda a, b: a.endswith(b),
    "StringContains": lambda a, b: b in a,
    "IsNotNull": lambda a, b: True,
}


class WarcReader(DataSourceReader):
    def __init__(self, options: dict):
        self.path = options["path"]
        self.payloads = options.get("payload", "true").lower() != "false"
        self.tests: list[tuple[str, str, object]] = []

    def pushFilters(self, filters):
        for f in filters:
            kind, column = type(f).__name__, getattr(f, "attribute", (None,))
            if kind in _TESTS and len(column) == 1 and column[0] in _HEADER_OF:
                self.tests.append((kind, column[0], getattr(f, "value", None)))
            else:
                yield f

    def partitions(self):
        fs, root = _open(self.path)
        info = fs.get_file_info(root)
        if info.type == pafs.FileType.File:
            return [WarcFile(self.path)]
        base = self.path.rstrip("/")
        if fs.get_file_info(f"{root}/{MANIFEST}").type == pafs.FileType.File:
            with fs.open_input_stream(f"{root}/{MANIFEST}") as f:
                return [WarcFile(f"{base}/{name}") for name in json.loads(f.read())]
        names = sorted(x.base_name for x in fs.get_file_info(pafs.FileSelector(root)) if x.base_name.endswith((".warc", ".warc.gz")))
        return [WarcFile(f"{base}/{name}") for name in names]

    def _wanted(self, headers: dict) -> bool:
        return all((v := _value(c, headers)) is not None and _TESTS[kind](v, x) for kind, c, x in self.tests)

    def read(self, partition):
        if partition is None or not getattr(partition, "path", None):
            return
        fs, name = _open(partition.path)
        rows: list[dict] = []
        held = 0
        with fs.open_input_file(name) as file:
            for headers, block in read_records(file, self._wanted, self.payloads):
                payload = size = None
                if block is not None:
                    http, _, payload = block.partition(b"\r\n\r\n") if headers.get("Content-Type", "").startswith("application/http") else (b"", b"", block)
                    size = next((int(x[15:]) for x in http.decode("latin-1").split("\r\n") if x.lower().startswith("content-length:")), len(payload))
                digest = headers.get("WARC-Payload-Digest")
                rows.append(
                    {c: _value(c, headers) for c in _HEADER_OF}
                    | {"payload_digest": digest and digest.split(":")[-1], "payload_bytes": size, "headers": list(headers.items()), "payload": payload}
                )
                held += len(payload or b"") + 500
                if held > 8 << 20:
                    yield pa.RecordBatch.from_pylist(rows, ARROW)
                    rows, held = [], 0
        if rows:
            yield pa.RecordBatch.from_pylist(rows, ARROW)


class WarcWriter(DataSourceArrowWriter):
    def __init__(self, options: dict):
        self.path = options["path"].rstrip("/")
        self.zip = options.get("compression", "gzip") == "gzip"
        self.roll = int(options.get("max_file_bytes", 32 << 20))

    def write(self, iterator):
        fs, root = _open(self.path)
        fs.create_dir(root, recursive=True)
        files, out, size = [], None, 0
        for batch in iterator:
            for row in batch.to_pylist():
                if out is None:
                    files.append(f"part-{uuid.uuid4().hex}.warc" + ".gz" * self.zip)
                    out, size = fs.open_output_stream(f"{root}/{files[-1]}", compression=None), 0
                head, block = record(row)
                data = head + block + b"\r\n\r\n"
                data = member(data) if self.zip else data
                out.write(data)
                size += len(data)
                if size >= self.roll:
                    out.close()
                    out = None
        if out is not None:
            out.close()
        return Written(files)

    def commit(self, messages):
        fs, root = _open(self.path)
        fs.create_dir(root, recursive=True)
        names = sorted(f for m in messages if m is not None for f in m.files)
        old = f"{root}/{MANIFEST}"
        if fs.get_file_info(old).type == pafs.FileType.File:
            with fs.open_input_stream(old) as f:
                names = sorted({*names, *json.loads(f.read())})
        with fs.open_output_stream(old, compression=None) as f:
            f.write(json.dumps(names).encode())

    def abort(self, messages):
        fs, root = _open(self.path)
        for name in (f for m in messages if m is not None for f in m.files):
            fs.delete_file(f"{root}/{name}")


class WarcDataSource(DataSource):
    """Options: ``path``; reading: ``payload`` (false leaves payloads undecoded and null, with
    ``payload_bytes``); writing: ``compression`` (gzip or none), ``max_file_bytes``."""

    @classmethod
    def name(cls):
        return "warc"

    def schema(self):
        return SCHEMA

    def reader(self, schema):
        return WarcReader(self.options)

    def writer(self, schema, overwrite):
        return WarcWriter(self.options)


def register(spark: SparkSession) -> None:
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    spark.dataSource.register(WarcDataSource)


# ---------------------------------------------------------------- pages to records


#: Bits of the bitmap that stands for a set of digests too large to send around: 16 MB.
SLOTS = 27


def _marked(p: DataFrame, repeated: DataFrame) -> DataFrame:
    """``p`` with ``_maybe``: false for rows whose digest is surely not among ``repeated``, by a bitmap of a fixed size."""
    slot = F.pmod(F.xxhash64("payload_digest"), F.lit(1 << SLOTS))
    bucket, bit = F.shiftright(slot, 15).cast("int"), slot.bitwiseAND(F.lit(32767)).cast("int")  # a bitmap of Spark's has 32768 bits
    marks = repeated.select(bucket.alias("_bucket"), bit.cast("long").alias("_bit")).groupBy("_bucket").agg(F.bitmap_construct_agg("_bit").alias("_bits"))
    byte = F.conv(F.hex(F.substring("_bits", F.floor(bit / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
    hit = F.pmod(F.floor(byte / F.pow(F.lit(2), F.pmod(bit, F.lit(8)))), F.lit(2)) == 1
    return p.withColumn("_bucket", bucket).join(F.broadcast(marks), "_bucket", "left").withColumn("_maybe", F.coalesce(hit, F.lit(False))).drop("_bucket", "_bits")


def deduplicated(
    pages: DataFrame, least: int = 100, id_col: str = "page_id", url_col: str = "url", html_col: str = "html", most_broadcast: int = BROADCAST_ROWS
) -> DataFrame:
    """Records of pages: of equal payloads of at least ``least`` bytes the one with the smallest id is
    a response, the others revisit it; smaller payloads are all responses.

    Only digests are shuffled to find the copies, and payloads stay where they are read. If over ``most_broadcast``
    digests are repeated, a bitmap of them is sent around instead, and the payloads that it marks, those of repeated
    digests and some 1 in 100 others at a million, go to a join that can split hot digests. Defined cases: null html is an empty
    payload, a null url has no target header, rows that repeat the smallest id are responses, a
    null id is never the smallest. Other columns are ignored.
    """
    p = pages.select(
        F.col(id_col).cast("long").alias("_id"),
        F.col(url_col).cast("string").alias("target_uri"),
        F.encode(F.coalesce(F.col(html_col), F.lit("")), "UTF-8").alias("payload"),
    )
    p = p.select("*", F.octet_length("payload").cast("long").alias("payload_bytes"), F.sha2("payload", 256).alias("payload_digest"))
    slim = p.where(F.col("payload_bytes") >= least)
    first = slim.groupBy("payload_digest").agg(F.min("_id").alias("_first"), F.count("*").alias("_n")).where("_n > 1 and _first is not null").drop("_n")
    if first.limit(most_broadcast + 1).count() <= most_broadcast:
        p = p.join(F.broadcast(first), "payload_digest", "left")
    else:
        first = Stage(pages.sparkSession, "warc").put(first, "first")
        marked = _marked(p, first)
        known = marked.where("_maybe").drop("_maybe").join(first.hint("merge"), "payload_digest", "left")
        p = marked.where("not _maybe").drop("_maybe").withColumn("_first", F.lit(None).cast("long")).unionByName(known)
    revisit = F.col("_first").isNotNull() & ~F.col("_id").eqNullSafe(F.col("_first"))
    urn = lambda c: F.concat(F.lit("urn:page:"), F.coalesce(c.cast("string"), F.lit("")))
    return p.select(
        F.when(revisit, "revisit").otherwise("response").alias("warc_type"),
        urn(F.col("_id")).alias("record_id"),
        "target_uri",
        F.when(revisit, urn(F.col("_first"))).alias("refers_to"),
        "payload_digest",
        "payload_bytes",
        F.lit(None).cast("bigint").alias("content_length"),
        F.lit(None).cast("map<string,string>").alias("headers"),
        F.when(revisit, F.lit(None)).otherwise(F.col("payload")).alias("payload"),
    )


def write(records: DataFrame, path: str, **options: str) -> None:
    register(records.sparkSession)
    records.write.format("warc").options(**options).mode("append").save(path)


def read(spark: SparkSession, path: str, payload: bool = True) -> DataFrame:
    register(spark)
    return spark.read.format("warc").option("payload", str(payload).lower()).load(path)
