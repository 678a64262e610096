"""WARC archives as a PySpark data source, `warc`.

Reading plans partitions of whole files, small ones together. Equality, IN and prefix predicates on the record
type and the header columns are pushed down: a record's headers are parsed first, and the payload of one that
isn't wanted by any scan of the table is neither inflated nor decoded (each gzip member written here tells its length in the extra field
`sl` of the WARC standard; members of other writers, which lack it, are inflated but not decoded, and may hold
any number of records). Headers or blocks that are cut off, and payloads that don't fit their member's checksum,
raise an error. The option
payload=false leaves out all payloads.

Writing makes one gzip member per record, in files of file_bytes each at most, under names that no other task
uses; the driver's commit lists them in _manifest.json, and only listed files are read. So what a lost or
repeated task leaves behind is never seen. Paths are URIs of any file system that pyarrow knows.

archive() writes one record per row. Of rows with equal payloads of at least least_bytes, the one with the
smallest id is a `response`; the others are `revisit` records that refer to it and carry no payload. Null
payloads are empty ones; a row with a null id is always a response unless `unnamed` is set, as the query does:
then it revisits an equal payload that has an id; repeated rows with the smallest id are all responses; null URLs
have no target header; line ends in URLs are percent-encoded. An empty table gives an archive without records.
Other columns, whatever their names, are ignored.
"""

from __future__ import annotations

import atexit
import base64
import json
import shutil
import struct
import tempfile
import zlib
from collections.abc import Iterator
from dataclasses import dataclass
from uuid import uuid4

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, DataSourceReader, EqualTo, Filter, In, InputPartition, StringStartsWith, WriterCommitMessage

from .common import cut, maybe_in, ship, split_join

SCHEMA = "record_id string, record_type string, target_uri string, refers_to string, payload_digest string, payload_bytes long, payload binary"
FILE_BYTES, PART_BYTES, HEAD_BYTES = 128_000_000, 64_000_000, 2048
DATE = "1970-01-01T00:00:00Z"
HEADERS = {"record_id": "warc-record-id", "record_type": "warc-type", "target_uri": "warc-target-uri", "refers_to": "warc-refers-to", "payload_digest": "warc-payload-digest", "payload_bytes": "x-payload-length"}
MANIFEST = "_manifest.json"


def base32(hex_digest: str) -> str:
    return base64.b32encode(bytes.fromhex(hex_digest)).decode()


def record(record_id: str, record_type: str, uri: str | None, refers_to: str | None, digest: str, size: int, payload: bytes | None) -> bytes:
    """One WARC record; size and digest are of the full payload also where it is not carried."""
    head = [("WARC-Type", record_type), ("WARC-Record-ID", f"<{record_id}>"), ("WARC-Date", DATE)]
    if uri is not None:
        head.append(("WARC-Target-URI", uri.replace("\r", "%0D").replace("\n", "%0A")))
    head += [("WARC-Payload-Digest", f"sha1:{digest}"), ("X-Payload-Length", str(size))]
    if refers_to is not None:
        head += [("WARC-Refers-To", f"<{refers_to}>"), ("WARC-Profile", "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest")]
    block = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n" + f"Content-Length: {size}\r\n\r\n".encode() + (payload or b"")
    head += [("Content-Type", "application/http; msgtype=response"), ("Content-Length", str(len(block)))]
    return b"WARC/1.1\r\n" + "".join(f"{k}: {v}\r\n" for k, v in head).encode() + b"\r\n" + block + b"\r\n\r\n"


def member(data: bytes, level: int = 1) -> bytes:
    """A gzip member whose extra field `sl` holds its own length and that of data."""
    packer = zlib.compressobj(level, zlib.DEFLATED, -15)
    body = packer.compress(data) + packer.flush()
    tail = struct.pack("<II", zlib.crc32(data), len(data) & 0xFFFFFFFF)
    size = 10 + 2 + 12 + len(body) + 8
    if size > 0xFFFFFFFF or len(data) > 0xFFFFFFFF:
        return b"\x1f\x8b\x08\x00" + bytes(4) + b"\x00\xff" + body + tail
    return b"\x1f\x8b\x08\x04" + bytes(4) + b"\x00\xff" + struct.pack("<H", 12) + b"sl" + struct.pack("<HII", 8, size, len(data)) + body + tail


@dataclass
class Files(InputPartition):
    paths: list[str]


@dataclass
class Written(WriterCommitMessage):
    names: list[str]


def filesystem(uri: str):
    from pyarrow import fs

    return fs.FileSystem.from_uri(uri) if "://" in uri or uri.startswith("file:") else (fs.LocalFileSystem(), uri)


def parse_head(data: bytes) -> tuple[dict[str, str], int] | None:
    """The headers by lower-case name and the place where the block starts; None if data ends before that."""
    end = data.find(b"\r\n\r\n")
    if end < 0:
        return None
    lines = data[:end].decode("utf-8", "replace").split("\r\n")
    return {k.strip().lower(): v.strip() for k, _, v in (x.partition(":") for x in lines[1:])}, end + 4


def columns_of(head: dict[str, str]) -> dict[str, str | None]:
    bare = lambda x: x[1:-1] if x and x[:1] == "<" and x[-1:] == ">" else x
    out = {k: bare(head.get(v)) for k, v in HEADERS.items()}
    out["record_type"] = out["record_type"] or ""  # every record has one, by the standard
    out["payload_digest"] = (out["payload_digest"] or "").partition(":")[2] or None
    return out


class Inflated:
    """The bytes of the gzip member at `at`, from the front; a length of 0 is unknown."""

    def __init__(self, file, at: int, size: int, length: int):
        self.file, self.left, self.size = file, length or size - at, size
        self.inflate, self.held = zlib.decompressobj(31), b""
        file.seek(at)

    def more(self, step: int) -> bool:
        """Adds what the next step bytes of the file hold; False at the end of the member."""
        if self.inflate.eof:
            return False
        chunk = self.file.read(min(step, self.left))
        if not chunk:
            raise ValueError("a gzip member is cut off")
        self.left -= len(chunk)
        self.held += self.inflate.decompress(chunk)
        return True

    def head(self) -> tuple[dict[str, str], int] | None:
        """The next record's headers, taken off, with the length of its block; None where nothing follows."""
        # line ends before the headers belong to the record before
        while (found := parse_head(self.held.lstrip(b"\r\n"))) is None:
            if not self.more(HEAD_BYTES):
                if self.held.strip():
                    raise ValueError("a WARC record's headers don't end")
                return None
        self.held = self.held.lstrip(b"\r\n")[found[1] :]
        return found[0], block_length(found[0])

    def block(self, n: int, take: bool) -> bytes:
        """Takes n bytes off and returns them, or nothing if they aren't wanted."""
        parts = []
        while True:
            part, self.held = self.held[:n], self.held[n:]
            n -= len(part)
            if take:
                parts.append(part)
            if not n:
                return b"".join(parts)
            if not self.more(min(1 << 20, max(HEAD_BYTES, n))):
                raise ValueError("a WARC record's block is cut off")

    def end(self) -> int:
        return self.size - self.left - len(self.inflate.unused_data)


def block_length(head: dict[str, str]) -> int:
    if not head.get("content-length", "").isdecimal():
        raise ValueError("a WARC record without a content length")
    return int(head["content-length"])


def records(file, size: int, wanted) -> Iterator[tuple[dict[str, str | None], bytes | None]]:
    """(columns, block) of the records of an open file that wanted(columns) accepts, in their order."""
    at = 0
    while at < size:
        file.seek(at)
        start = file.read(24)
        if start[:2] != b"\x1f\x8b":  # a plain record, with only its headers read so far
            head, length = start, HEAD_BYTES
            while (found := parse_head(head)) is None and len(head) < size - at:
                file.seek(at)
                head, length = file.read(min(length, size - at)), length * 2
            if found is None:
                if head.strip():
                    raise ValueError("a WARC record's headers don't end")
                return
            body = block_length(found[0])
            if at + found[1] + body > size:
                raise ValueError("a WARC record's block is cut off")
            columns = columns_of(found[0])
            if wanted(columns):
                file.seek(at + found[1])
                yield columns, file.read(body)
            at += found[1] + body + 4
            continue
        if len(start) < 18:
            raise ValueError("a gzip member is cut off")
        # with `sl` the member is one record, and what isn't wanted of it is skipped
        length = struct.unpack("<I", start[16:20])[0] if start[3] & 4 and start[12:14] == b"sl" and len(start) >= 20 else 0
        member_ = Inflated(file, at, size, length)
        while (found := member_.head()) is not None:
            columns = columns_of(found[0])
            take = wanted(columns)
            if length and not take:
                break
            block = member_.block(found[1], take)
            while length and member_.more(1 << 16):  # to the end, where the checksum of the member is compared
                pass
            if take:
                yield columns, block
            if length:
                break
        at = at + length if length else member_.end()


def fits(found: str | None, kind: str, value) -> bool:
    if found is None:
        return False
    return found == value if kind == "is" else found in value if kind == "in" else found.startswith(value)


class WarcReader(DataSourceReader):
    """pushed is a file on the driver with the predicates of all scans of this table so far.

    Spark keeps one plan of a Python source for each table, that of the scan planned last: of df.filter(a) and
    df.filter(b) in one query, both would read what b accepts. So a reader accepts what any scan of its table asked
    for, and hands all filters back to Spark, which applies each scan's own once more. Without the file nothing is
    left out."""

    def __init__(self, path: str, payload: bool, part_bytes: int, pushed: str | None = None):
        self.path, self.payload, self.part_bytes, self.pushed = path, payload, part_bytes, pushed
        self.wanted: list[list[tuple[str, str, object]]] | None = None

    def pushFilters(self, filters: list[Filter]):  # noqa: N802
        if self.pushed:
            kinds = {EqualTo: "is", In: "in", StringStartsWith: "starts"}
            mine = [(kinds[type(f)], f.attribute[0], list(f.value) if isinstance(f, In) else f.value) for f in filters if type(f) in kinds and len(f.attribute) == 1 and f.attribute[0] in HEADERS and f.attribute[0] != "payload_bytes"]
            with open(self.pushed, "a+") as file:
                file.write(json.dumps(mine) + "\n")
                file.flush()
                file.seek(0)
                self.wanted = [json.loads(x) for x in file]
        return filters

    def accepts(self, columns: dict[str, str | None]) -> bool:
        return self.wanted is None or any(all(fits(columns[name], kind, value) for kind, name, value in scan) for scan in self.wanted)

    def partitions(self):
        from pyarrow import fs

        files, base = filesystem(self.path)
        manifest = f"{base}/{MANIFEST}"
        listed = None
        if files.get_file_info(manifest).type == fs.FileType.File:
            with files.open_input_stream(manifest) as f:
                listed = set(json.loads(f.read()))
        found = [x for x in files.get_file_info(fs.FileSelector(base)) if x.type == fs.FileType.File and (x.base_name in listed if listed is not None else x.base_name.endswith((".warc", ".warc.gz")))]
        out, size = [], 0
        for x in sorted(found, key=lambda x: x.base_name):
            if not out or size + x.size > self.part_bytes:
                out.append(Files([]))
                size = 0
            out[-1].paths.append(x.base_name)
            size += x.size
        return out or [Files([])]

    def read(self, partition: Files):
        files, base = filesystem(self.path)
        for name in partition.paths:
            with files.open_input_file(f"{base}/{name}") as f:
                rows: list[tuple] = []
                held = 0
                for columns, block in records(f, f.size(), self.accepts):
                    start = block.find(b"\r\n\r\n") if block[:5] == b"HTTP/" else -4
                    payload = block[start + 4 :] if self.payload and columns["record_type"] != "revisit" else None
                    rows.append((columns["record_id"], columns["record_type"], columns["target_uri"], columns["refers_to"], columns["payload_digest"], int(columns["payload_bytes"]) if columns["payload_bytes"] else None, payload))
                    held += len(payload or b"") + 200
                    if held > 8_000_000:
                        yield batch_of(rows)
                        rows, held = [], 0
                if rows:
                    yield batch_of(rows)


def batch_of(rows: list[tuple]) -> pa.RecordBatch:
    kinds = [pa.string()] * 5 + [pa.int64(), pa.binary()]
    return pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], kind) for k, kind in enumerate(kinds)], [x.split()[0] for x in SCHEMA.split(", ")])


class WarcWriter(DataSourceArrowWriter):
    def __init__(self, path: str, overwrite: bool, file_bytes: int):
        self.path, self.overwrite, self.file_bytes = path, overwrite, file_bytes

    def write(self, iterator):
        from pyspark import TaskContext

        context = TaskContext.get()
        files, base = filesystem(self.path)
        files.create_dir(base, recursive=True)
        names, out, size = [], None, 0
        for batch in iterator:
            for row in batch.to_pylist():
                data = member(record(row["record_id"], row["record_type"], row["target_uri"], row["refers_to"], base32(row["payload_digest"]), row["payload_bytes"], row["payload"]))
                if out is None or size + len(data) > self.file_bytes:
                    if out:
                        out.close()
                    names.append(f"part-{context.partitionId() if context else 0:05d}-{uuid4().hex}.warc.gz")
                    out, size = files.open_output_stream(f"{base}/{names[-1]}", compression=None), 0
                out.write(data)
                size += len(data)
        if out:
            out.close()
        return Written(names)

    def commit(self, messages):
        files, base = filesystem(self.path)
        files.create_dir(base, recursive=True)
        from pyarrow import fs

        names = [x for m in messages if m for x in m.names]
        if not self.overwrite and files.get_file_info(f"{base}/{MANIFEST}").type == fs.FileType.File:
            with files.open_input_stream(f"{base}/{MANIFEST}") as f:
                names = json.loads(f.read()) + names
        temporary = f"{base}/.{uuid4().hex}"
        with files.open_output_stream(temporary) as f:
            f.write(json.dumps(sorted(names)).encode())
        files.move(temporary, f"{base}/{MANIFEST}")

    def abort(self, messages):
        files, base = filesystem(self.path)
        for m in messages:
            for name in m.names if m else []:
                files.delete_file(f"{base}/{name}")


class WarcSource(DataSource):
    @classmethod
    def name(cls):
        return "warc"

    def schema(self):
        return SCHEMA

    def reader(self, schema):
        return WarcReader(self.options["path"], self.options.get("payload", "true").lower() == "true", int(self.options.get("part_bytes", PART_BYTES)), self.options.get("pushed"))

    def writer(self, schema, overwrite):
        return WarcWriter(self.options["path"], overwrite, int(self.options.get("file_bytes", FILE_BYTES)))


def register(spark: SparkSession) -> None:
    ship(spark)
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    spark.dataSource.register(WarcSource)


_pushed: list[str] = []


def read(spark: SparkSession, path: str, payload: bool = True) -> DataFrame:
    """The records of the archives below path, with the columns of SCHEMA.

    Filters on the result are pushed down, see WarcReader; the one added here makes Spark plan every scan anew."""
    register(spark)
    if not _pushed:
        _pushed.append(tempfile.mkdtemp(prefix="lodestone-warc-"))
        atexit.register(shutil.rmtree, _pushed[0], ignore_errors=True)
    scans = f"{_pushed[0]}/{uuid4().hex}"
    return spark.read.format("warc").option("payload", str(payload).lower()).option("pushed", scans).load(path).filter(F.col("record_type").isNotNull())


def planned(rows: DataFrame, id_col: str, url_col: str, payload_col: str, id_prefix: str, least_bytes: int = 0, unnamed: bool = False) -> DataFrame:
    """What archive() writes, one line per row: SCHEMA, with the digest in hex, which the writer turns to base32, and revisits without payload."""
    full = rows.select(F.col(id_col).alias("id"), F.col(url_col).cast("string").alias("target_uri"), F.coalesce(F.col(payload_col), F.lit("")).cast("binary").alias("payload"))
    full = full.withColumn("sha1", F.sha1("payload")).withColumn("payload_bytes", F.octet_length("payload").cast("long"))
    met = (F.col("payload_bytes") >= least_bytes) & (F.lit(unnamed) | F.col("id").isNotNull())
    # narrow rows only, summed up before the shuffle
    groups = cut(full.filter(met).groupBy("sha1").agg(F.min("id").alias("first"), F.count("*").alias("n")))
    firsts = groups.filter("n > 1 AND first IS NOT NULL").select("sha1")
    maybe_copied = lambda x: maybe_in(x, F.col("sha1"), firsts, "copied")
    # payloads without a copy that the filter lets through lead, too: nothing else holds what they carry
    leading = cut(maybe_copied(groups).filter("copied").select("sha1", "first"))
    marked = maybe_in(maybe_copied(full), F.struct("sha1", "id"), leading.select(F.struct("sha1", F.col("first").alias("id")).alias("k")), "leads")
    # only rows that may have a copy are shuffled, and of these only the payloads that may be kept
    met = F.col("copied") & met
    copies = marked.filter(met).withColumn("payload", F.when(F.col("leads"), F.col("payload"))).drop("copied", "leads")
    copies = split_join(copies, leading, "sha1", how="left")
    alone = marked.filter(~met).drop("copied", "leads").withColumn("first", F.lit(None).cast(leading.schema["first"].dataType))
    name = lambda x: F.concat(F.lit(id_prefix), F.col(x).cast("string"))
    again = F.col("first").isNotNull() & ~F.col("id").eqNullSafe(F.col("first"))
    return alone.unionByName(copies).select(
        F.coalesce(name("id"), F.concat(F.lit(id_prefix), F.lit("null"))).alias("record_id"),
        F.when(again, "revisit").otherwise("response").alias("record_type"),
        "target_uri",
        F.when(again, name("first")).alias("refers_to"),
        F.col("sha1").alias("payload_digest"),
        "payload_bytes",
        F.when(~again, F.col("payload")).alias("payload"),
    )


def archive(rows: DataFrame, path: str, id_col: str, url_col: str, payload_col: str, id_prefix: str = "urn:x-row:", least_bytes: int = 0, unnamed: bool = False) -> None:
    """Writes the archives of rows below path."""
    register(rows.sparkSession)
    planned(rows, id_col, url_col, payload_col, id_prefix, least_bytes, unnamed).write.format("warc").mode("append").save(path)
