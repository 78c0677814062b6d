"""Web archives: legacy ARC files to WARC files, and reading them back.

Method.  An ARC file begins with a version block whose last line names the
fields of every later header line (version 1 has five, version 2 ten).  Each
record is a header line and as many bytes as it declares; the next header
follows.  The converter walks these, takes the payload out of an HTTP block,
and writes the equivalent WARC record: an identifier derived from the record
(so a rerun gives the same one), the timestamp in ISO form, the type, and
SHA-1 digests of block and payload.

Of records with equal payloads of at least ``min_payload`` bytes the one with
the largest page id (then date, file and place) is the ``response``; the others
become ``revisit`` records that refer to it and keep their HTTP header only.

Archives are written and read by Spark (``text`` writer with the record
separator as line separator, ``binaryFile`` reader), so they can live in any
store Spark knows; one row is one archive of about ``ARCHIVE_BYTES`` bytes, in
one gzip member.  Archives read must be below 2 GB each (the reader's limit).

Defined results: a null payload is empty; a null or empty URL is replaced by
one made of the page id; white space in a URL is percent-encoded; a page
without an id sorts below all ids; repeated rows become records of their own;
an archive that breaks its declared lengths raises an error that names file
and offset; an empty table gives no records; extra columns are ignored.
"""

from __future__ import annotations

import base64
import datetime
import gzip
import hashlib
import re
import sys
import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext, cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from twinline.llm.common import cut, shared_folder
from twinline.operators.skew import join_hot

cloudpickle.register_pickle_by_value(sys.modules[__name__])

ARCHIVE_BYTES = 8 << 20
MIN_PAYLOAD = 1000
# The field lines of the two ARC versions and the revisit profile of WARC 1.1.
ARC_FIELDS = {
    1: "URL IP-address Archive-date Content-type Archive-length",
    2: "URL IP-address Archive-date Content-type Result-code Checksum Location Offset Filename Archive-length",
}
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
PAGE_HEADER = "X-Page-Id"
EPOCH = datetime.datetime(2020, 1, 1)


# ------------------------------------------------------------------ ARC


def _clean_url(url: str | None, page_id: int | None) -> str:
    if not url:
        return f"urn:page:{page_id}"
    return re.sub(r"[\s\x00-\x1f\x7f]", lambda m: "".join(f"%{b:02X}" for b in m[0].encode()), url)


def arc_start(version: int, name: str) -> bytes:
    body = f"{version} 0 converter\n{ARC_FIELDS[version]}\n".encode()
    return arc_record(version, f"filedesc://{name}", "0.0.0.0", EPOCH.strftime("%Y%m%d%H%M%S"), "text/plain", body, name, 0)


def arc_record(version: int, url: str, ip: str, date: str, kind: str, block: bytes, name: str, offset: int) -> bytes:
    if version == 1:
        head = f"{url} {ip} {date} {kind} {len(block)}\n"
    else:
        head = f"{url} {ip} {date} {kind} 200 {hashlib.md5(block).hexdigest()} - {offset} {name} {len(block)}\n"
    return head.encode() + block


def write_arc(pages: DataFrame, path: str, id_col: str = "page_id", url_col: str = "url", body_col: str = "html") -> None:
    """Pages as ARC archives, versions 1 and 2 in turn."""
    src = pages.select(F.col(id_col).cast("long").alias("i"), F.col(url_col).cast("string").alias("u"),
                       F.coalesce(F.col(body_col).cast("string"), F.lit("")).cast("binary").alias("b"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, number, parts, size, version, name = TaskContext.get().partitionId(), 0, [], 0, 1, ""
        for b in batches:
            for i, u, body in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), b.column(2)):
                if not parts:
                    version, name = 1 + (part + number) % 2, f"part-{part:05d}-{number:05d}.arc"
                    parts = [arc_start(version, name)]
                    size = len(parts[0])
                body = body.as_py()
                ident = "" if i is None else f"{PAGE_HEADER}: {i}\r\n"
                block = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(body)}\r\n{ident}\r\n".encode() + body
                date = (EPOCH + datetime.timedelta(seconds=(i or 0) % 100_000_000)).strftime("%Y%m%d%H%M%S")
                parts.append(arc_record(version, _clean_url(u, i), "0.0.0.0", date, "text/html", block, name, size))
                size += len(parts[-1]) + 1
                if size >= ARCHIVE_BYTES:
                    yield pa.RecordBatch.from_arrays([pa.array([b"\n".join(parts)], pa.binary())], names=["a"])
                    parts, number = [], number + 1
        if parts:
            yield pa.RecordBatch.from_arrays([pa.array([b"\n".join(parts)], pa.binary())], names=["a"])

    _write_archives(src.mapInArrow(run, "a binary"), path, "\n")


def _write_archives(rows: DataFrame, path: str, end: str) -> None:
    """One row is one file; ``end`` closes its last record.  Archives are
    deflated at the fastest level: an eighth larger, at a fifth of the time."""
    (rows.select(F.col("a").cast("string").alias("value")).write.option("lineSep", end).option("compression", "gzip").option("zlib.compress.level", "BEST_SPEED")
     .option("maxRecordsPerFile", 1).text(path))


def _plain(content: bytes) -> bytes:
    return gzip.decompress(content) if content[:2] == b"\x1f\x8b" else content


def parse_arc(content: bytes, name: str) -> Iterator[tuple[dict[str, str], bytes]]:
    """(header fields, block) of every record after the version block."""
    data, at, fields, first = _plain(content), 0, None, True
    while True:
        while data[at:at + 1] in (b"\n", b"\r"):
            at += 1
        if at >= len(data):
            return
        end = data.find(b"\n", at)
        if end < 0:
            raise ValueError(f"{name}: header line without an end at byte {at}")
        cells = data[at:end].rstrip(b"\r").decode("utf-8", "replace").split(" ")
        if first and not data.startswith(b"filedesc://", at):
            raise ValueError(f"{name}: no version block")
        if not cells[-1].isdigit() or not first and len(cells) != len(fields):
            raise ValueError(f"{name}: {len(cells)} header fields at byte {at}, not as many as declared with a length at the end")
        length, start = int(cells[-1]), end + 1
        if start + length > len(data):
            raise ValueError(f"{name}: record at byte {at} declares {length} bytes, {len(data) - start} are left")
        if first:
            lines = data[start:start + length].decode("utf-8", "replace").splitlines()
            version = lines[0].split(" ")[0] if lines else ""
            if version not in ("1", "2") or len(lines) < 2:
                raise ValueError(f"{name}: unknown version block")
            fields, first = lines[1].split(" "), False
        else:
            yield dict(zip(fields, cells)), data[start:start + length]
        at = start + length


def split_http(block: bytes) -> tuple[bytes, bytes]:
    """(HTTP header with its blank line, payload); no header if it is no HTTP response."""
    if not block.startswith(b"HTTP/"):
        return b"", block
    ends = [(i, i + len(sep)) for sep in (b"\r\n\r\n", b"\n\n") if (i := block.find(sep)) >= 0]
    end = min(ends)[1] if ends else len(block)
    return block[:end], block[end:]


def http_field(head: bytes, name: str) -> str | None:
    for line in head.decode("utf-8", "replace").splitlines()[1:]:
        key, _, value = line.partition(":")
        if key.strip().lower() == name.lower():
            return value.strip()
    return None


def iso_date(arc_date: str) -> str:
    if not re.fullmatch(r"\d{12}(\d\d)?", arc_date):
        raise ValueError(f"not an archive date: {arc_date!r}")
    return datetime.datetime.strptime(arc_date.ljust(14, "0"), "%Y%m%d%H%M%S").strftime("%Y-%m-%dT%H:%M:%SZ")


def record_id(url: str, date: str, digest: str, name: str, ordinal: int) -> str:
    return f"urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'{url} {date} {digest} {name} {ordinal}')}"


# ------------------------------------------------------------------ ARC -> WARC


def _archives(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.format("binaryFile").load(path).select("path", "content")


_RECORD = "f string, o long, page_id long, url string, date string, ip string, digest string, n long, id string"


def _rows_of(content: bytes, file: str) -> Iterator[tuple[tuple, bytes]]:
    """(_RECORD values, block) of every record of an ARC archive."""
    base = file.rsplit("/", 1)[-1]
    for o, (h, block) in enumerate(parse_arc(content, file)):
        head, payload = split_http(block)
        digest, page = hashlib.sha1(payload).hexdigest(), http_field(head, PAGE_HEADER)
        date = iso_date(h["Archive-date"])
        yield (file, o, int(page) if page else None, h["URL"], date, h["IP-address"], digest, len(payload),
               record_id(h["URL"], date, digest, base, o)), block


def _records(spark: SparkSession, path: str) -> DataFrame:
    """What identifies the records of all ARC archives in ``path``; no blocks."""
    names = [c.split(" ")[0] for c in _RECORD.split(", ")]
    kinds = [pa.string(), pa.int64(), pa.int64(), *[pa.string()] * 4, pa.int64(), pa.string()]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for file, content in zip(b.column(0).to_pylist(), b.column(1)):
                rows = [r for r, _ in _rows_of(content.as_py(), file)]
                if rows:
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), kinds)], names=names)

    return _archives(spark, path).mapInArrow(run, _RECORD)


def _digest(data: bytes) -> str:
    return "sha1:" + base64.b32encode(hashlib.sha1(data).digest()).decode()


def warc_record(row: dict) -> bytes:
    """One record without the two line ends that close it."""
    block, revisit = row["block"], row["ref_id"] is not None
    head, payload = split_http(block)
    kind = "revisit" if revisit else "response" if head else "resource"
    fields = [("WARC-Type", kind), ("WARC-Record-ID", f"<{row['id']}>"), ("WARC-Target-URI", row["url"]), ("WARC-Date", row["date"]),
              ("WARC-IP-Address", row["ip"]), ("WARC-Payload-Digest", _digest(payload))]
    if revisit:
        block = head
        fields += [("WARC-Profile", REVISIT_PROFILE), ("WARC-Refers-To", f"<{row['ref_id']}>"),
                   ("WARC-Refers-To-Target-URI", row["ref_url"]), ("WARC-Refers-To-Date", row["ref_date"])]
    fields += [("WARC-Block-Digest", _digest(block)),
               ("Content-Type", "application/http;msgtype=response" if head else "application/octet-stream"), ("Content-Length", str(len(block)))]
    return ("WARC/1.1\r\n" + "".join(f"{k}: {v}\r\n" for k, v in fields) + "\r\n").encode() + block


def arc_to_warc(spark: SparkSession, arc_path: str, warc_path: str, min_payload: int = MIN_PAYLOAD) -> None:
    """Convert every ARC archive in ``arc_path``; WARC archives go to ``warc_path``.

    Which records are revisits is found on narrow rows.  The marks are gathered
    per archive (an archive's records are bounded by its size) and meet the
    compressed archive in the task that converts it: blocks never move."""
    meta = cut(_records(spark, arc_path))
    place = F.struct(F.col("page_id"), F.col("date"), F.col("f"), F.col("o"), F.col("id"), F.col("url"))
    large = meta.where(F.col("n") >= min_payload).select("f", "o", "digest", "n", "page_id", "date", "id", "url")
    winners = large.groupBy("digest", "n").agg(F.max(place).alias("w"), F.count(F.lit(1)).alias("c")).where("c > 1").select(
        "digest", "n", F.col("w.id").alias("ref_id"), F.col("w.url").alias("ref_url"), F.col("w.date").alias("ref_date"),
        F.col("w.f").alias("wf"), F.col("w.o").alias("wo"))
    refer = join_hot(large.select("digest", "n", "f", "o"), cut(winners), ["digest", "n"], least=256)
    refer = refer.where((F.col("f") != F.col("wf")) | (F.col("o") != F.col("wo")))
    marks = refer.groupBy("f").agg(F.collect_list(F.struct("o", "ref_id", "ref_url", "ref_date")).alias("marks"))
    rows = _archives(spark, arc_path).join(marks, F.col("path") == F.col("f"), "left").select("path", "content", "marks")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts, size = [], 0
        for b in batches:
            for file, content, mark in zip(b.column(0).to_pylist(), b.column(1), b.column(2)):
                known = {m["o"]: m for m in mark.as_py() or ()}
                for (_, o, _, url, date, ip, _, _, ident), block in _rows_of(content.as_py(), file):
                    m = known.get(o, {})
                    parts.append(warc_record({"id": ident, "url": url, "date": date, "ip": ip, "block": block, "ref_id": m.get("ref_id"),
                                              "ref_url": m.get("ref_url"), "ref_date": m.get("ref_date")}))
                    size += len(parts[-1])
                    if size >= ARCHIVE_BYTES:
                        yield pa.RecordBatch.from_arrays([pa.array([b"\r\n\r\n".join(parts)], pa.binary())], names=["a"])
                        parts, size = [], 0
        if parts:
            yield pa.RecordBatch.from_arrays([pa.array([b"\r\n\r\n".join(parts)], pa.binary())], names=["a"])

    _write_archives(rows.mapInArrow(run, "a binary"), warc_path, "\r\n\r\n")


# ------------------------------------------------------------------ reading WARC


def parse_warc(content: bytes, name: str) -> Iterator[tuple[dict[str, str], bytes]]:
    """(header fields in lower case, block) of every record."""
    data, at = _plain(content), 0
    while True:
        while data[at:at + 1] in (b"\r", b"\n"):
            at += 1
        if at >= len(data):
            return
        end = data.find(b"\r\n\r\n", at)
        if end < 0 or not data.startswith(b"WARC/", at):
            raise ValueError(f"{name}: no record at byte {at}")
        lines = data[at:end].decode("utf-8", "replace").split("\r\n")[1:]
        head = {k.strip().lower(): v.strip() for k, _, v in (x.partition(":") for x in lines)}
        start, length = end + 4, int(head.get("content-length", "-1"))
        if length < 0 or start + length > len(data):
            raise ValueError(f"{name}: record at byte {at} declares {length} bytes, {len(data) - start} are left")
        yield head, data[start:start + length]
        at = start + length


def read_warc(spark: SparkSession, path: str) -> DataFrame:
    """One row per record: ``record_id``, ``page_id``, ``url``, ``date``, ``record_type``, ``payload_bytes``,
    ``payload_digest`` (hex), ``refers_to_id`` and ``payload`` (null for revisits).
    A payload that does not have its declared digest is an error."""
    schema = ("record_id string, page_id long, url string, date string, record_type string, payload_bytes long, "
              "payload_digest string, refers_to_id string, payload binary")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = [c.split(" ")[0] for c in schema.split(", ")]
        kinds = [pa.string(), pa.int64(), *[pa.string()] * 3, pa.int64(), pa.string(), pa.string(), pa.binary()]
        for b in batches:
            for file, content in zip(b.column(0).to_pylist(), b.column(1)):
                rows, size = [], 0
                for head, block in parse_warc(content.as_py(), file):
                    http, payload = split_http(block)
                    declared = head["warc-payload-digest"].removeprefix("sha1:")
                    revisit = head["warc-type"] == "revisit"
                    if not revisit and _digest(payload) != f"sha1:{declared}":
                        raise ValueError(f"{file}: payload of {head['warc-record-id']} does not have its digest")
                    page = http_field(http, PAGE_HEADER)
                    n = int(http_field(http, "Content-Length") or 0) if revisit else len(payload)
                    rows.append((head["warc-record-id"].strip("<>"), int(page) if page else None, head.get("warc-target-uri"),
                                 head["warc-date"], head["warc-type"], n, base64.b32decode(declared).hex(),
                                 head.get("warc-refers-to", "").strip("<>") or None, None if revisit else payload))
                    size += len(block)
                    if size >= ARCHIVE_BYTES:
                        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), kinds)], names=names)
                        rows, size = [], 0
                if rows:
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), kinds)], names=names)

    return _archives(spark, path).mapInArrow(run, schema)


def pages_through_archives(pages: DataFrame) -> DataFrame:
    """Pages to ARC, ARC to WARC, WARC back to one row per page."""
    spark = pages.sparkSession
    arc, warc = shared_folder(spark, "arc"), shared_folder(spark, "warc")
    write_arc(pages, arc)
    arc_to_warc(spark, arc, warc)
    records = cut(read_warc(spark, warc).drop("payload"))  # narrow; read twice below
    targets = records.where("record_type = 'response'").select(F.col("record_id").alias("refers_to_id"), F.col("page_id").alias("refers_to"))
    revisits = join_hot(records.where("refers_to_id is not null"), targets, ["refers_to_id"], "left", least=256)
    cols = ["page_id", "payload_bytes", "payload_digest", "record_type"]
    return (records.where("refers_to_id is null").select(*cols, F.lit(None).cast("long").alias("refers_to"))
            .unionByName(revisits.select(*cols, "refers_to")))
