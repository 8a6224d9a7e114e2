"""WARC archives: pages written as records, and a reader that salvages what damaged archives still hold.

Writing goes through Spark's text sink, which commits a job's files and reaches whatever store Spark does.  It ends each
row with a separator, so the separator is chosen to be a record's own last bytes: the two line ends of a plain record, or
the zero byte that ends a gzip member (the high byte of its length; a longer record is followed by an empty member).
The files are ordinary archives with one member a record; only their names are Spark's.

Reading takes each file as bytes.  A record is checked: version line, header, length, end mark, digests, and the checksum
of its gzip member.  Where a check fails, the reader searches for the next gzip member or version line from which a record
passes, goes on there, and logs the bytes between as a quarantined gap.
"""

from __future__ import annotations

import base64
import hashlib
import re
import urllib.parse
import zlib
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from eventlink.llm.common import maybe_broadcast, saved

#: Uncompressed bytes that a file is aimed at; every file is read whole by one task.
FILE_BYTES = 32 << 20
#: Groups of equal payloads (some 50 bytes each) up to which they are broadcast; beyond, a salted join.
BROADCAST_GROUPS, SALTS = 200_000, 16
DATE = "1970-01-01T00:00:00Z"
END = b"\r\n\r\n"
# Names that the format gives.
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
MAGIC = b"\x1f\x8b\x08"
_VERSION = re.compile(rb"WARC/[01]\.[0-9]{1,2}\r?\n")
_START = re.compile(rb"\x1f\x8b\x08|WARC/[01]\.[0-9]{1,2}\r?\n")
_PADDING = re.compile(rb"[\r\n\x00]+")
_HASHES = {"sha1": hashlib.sha1, "sha256": hashlib.sha256, "md5": hashlib.md5}
#: A header longer than this is none.
MOST_HEADER = 1 << 20


# --- one record ---------------------------------------------------------------------------------------------


def digest(data: bytes) -> str:
    return base64.b32encode(hashlib.sha1(data).digest()).decode()


def record(kind: str, name: str, url: str | None, payload: bytes, refers_to: str | None = None, date: str = DATE) -> bytes:
    """A response with its payload, or a revisit of the record ``refers_to``, which has the HTTP header alone."""
    block = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    if kind == "response":
        block += payload
    uri = urllib.parse.quote(url, safe="!#$%&'()*+,/:;=?@[]~") if url else name
    fields = {
        "WARC-Type": kind,
        "WARC-Record-ID": f"<{name}>",
        "WARC-Date": date,
        "WARC-Target-URI": uri,
        "WARC-Payload-Digest": f"sha1:{digest(payload)}",
        "WARC-Block-Digest": f"sha1:{digest(block)}",
        "Content-Type": "application/http;msgtype=response",
        "Content-Length": str(len(block)),
    }
    if kind == "revisit":
        fields |= {"WARC-Profile": PROFILE, "WARC-Refers-To": f"<{refers_to}>"}
    head = "".join(f"{k}: {v}\r\n" for k, v in fields.items())
    return f"WARC/1.1\r\n{head}\r\n".encode() + block + END


def member(data: bytes) -> bytes:
    """A gzip member whose last byte is zero."""
    make = zlib.compressobj(6, zlib.DEFLATED, 31)
    out = make.compress(data) + make.flush()
    return out if out.endswith(b"\0") else out + member(b"")


@dataclass
class Found:
    """A record, or a gap with the reason for it.  ``offset`` is where it (or its gzip member) starts in the file and
    ``inside`` where it starts in the member's content; ``length`` counts bytes there."""

    offset: int
    inside: int
    length: int
    reason: str | None = None
    fields: dict[str, str] = field(default_factory=dict)
    http: bytes = b""
    payload: bytes = b""


class Damage(ValueError):
    pass


def _agrees(declared: str, data: bytes) -> bool:
    """Whether a digest, base32 or hex, is that of the data; one of an unknown kind says nothing."""
    name, _, value = declared.partition(":")
    make = _HASHES.get(name.strip().lower())
    if make is None:
        return True
    own = make(data).digest()
    value = value.strip().rstrip("=")
    return value.upper() == base64.b32encode(own).decode().rstrip("=") or value.lower() == own.hex()


def parse(data: bytes, at: int, strict: bool = False) -> tuple[Found, int]:
    """The record at ``at`` and where the next one starts.  ``strict`` asks for a digest that agrees."""
    version = _VERSION.match(data, at)
    if not version:
        raise Damage("no version line")
    ends = [(e, len(m)) for m in (b"\r\n\r\n", b"\n\n") if (e := data.find(m, version.end() - 2, at + MOST_HEADER)) >= 0]
    if not ends:
        raise Damage("no end of the header")
    stop, size = min(ends)
    lines = re.sub(rb"\r?\n[ \t]+", b" ", data[version.end() : stop]).splitlines()
    pairs = [line.decode("utf-8", "replace").partition(":") for line in lines if line]
    fields = {k.strip().lower(): v.strip() for k, colon, v in pairs if colon}
    if len(fields) != len(pairs) or not {"warc-type", "warc-record-id"} <= fields.keys():
        raise Damage("bad header")
    if not re.fullmatch(r"[0-9]{1,18}", fields.get("content-length", "")):
        raise Damage("no length")
    begin = stop + size
    end = begin + int(fields["content-length"])
    if end > len(data):
        raise Damage("longer than the file")
    block = data[begin:end]
    declared = fields.get("warc-block-digest")
    if declared and not _agrees(declared, block):
        raise Damage("block digest")
    http, payload = b"", block
    if fields.get("content-type", "").lower().startswith("application/http"):
        cut = block.find(END)
        http, payload = (block, b"") if cut < 0 else (block[:cut], block[cut + len(END) :])
    known = fields.get("warc-payload-digest")
    if known and fields["warc-type"] in ("response", "resource") and not _agrees(known, payload):
        raise Damage("payload digest")
    marked = next((m for m in (b"\r\n\r\n", b"\n\n") if data.startswith(m, end)), None)
    if (marked is None or strict) and not declared:
        raise Damage("no end mark" if marked is None else "no digest")
    return Found(at, 0, end - at, None, fields, http, payload), end + len(marked or b"")


def inflate(data: bytes, at: int) -> tuple[bytes, int | None, str | None]:
    """Content of the gzip member at ``at``, its end, and what is wrong with it (then the content is what came before)."""
    make, out, pos = zlib.decompressobj(31), [], at
    while not make.eof:
        chunk = data[pos : pos + (1 << 16)]
        if not chunk:
            return b"".join(out), None, "cut short"
        try:
            out.append(make.decompress(chunk))
        except zlib.error as e:
            return b"".join(out), None, str(e).split(":")[0]
        pos += len(chunk)
    return b"".join(out), pos - len(make.unused_data), None


def _sound(data: bytes, at: int) -> bool:
    """Whether a record that passes all checks starts here."""
    try:
        if data.startswith(MAGIC, at):
            content, end, wrong = inflate(data, at)
            return wrong is None and bool(_VERSION.match(content))
        parse(data, at)
        return True
    except Damage:
        return False


def salvage(data: bytes) -> Iterator[Found]:
    """Every record that passes its checks, in order, and a gap for each run of bytes that holds none."""
    at = 0
    while at < len(data):
        padding = _PADDING.match(data, at)
        if padding:
            at = padding.end()
            continue
        try:
            if data.startswith(MAGIC, at):
                content, end, wrong = inflate(data, at)
                if wrong is None:
                    for found in salvage(content):
                        yield Found(at, found.offset, found.length, found.reason, found.fields, found.http, found.payload)
                    at = end
                    continue
                reason, inner = f"gzip member: {wrong}", 0
                try:  # whole records before the damage; without the member's checksum a digest must vouch for them
                    while True:
                        found, after = parse(content, inner, strict=True)
                        yield Found(at, inner, found.length, None, found.fields, found.http, found.payload)
                        inner = after
                except Damage:
                    pass
            else:
                found, after = parse(data, at)
                yield found
                at = after
                continue
        except Damage as e:
            reason = str(e)
        later = (m.start() for m in _START.finditer(data, at + 1))
        after = next((p for p in later if _sound(data, p)), len(data))
        yield Found(at, 0, after - at, reason)
        at = after


# --- writing ------------------------------------------------------------------------------------------------


def _name(key) -> str:
    return f"urn:page:{'' if key is None else key}"


def with_first(pages: DataFrame, key: str, payload: Column, least: int) -> tuple[DataFrame, int]:
    """``pages`` with ``_first``, the smallest key of the rows with the same payload (null if there are no others or the
    payload has less than ``least`` bytes), and the bytes of all payloads."""
    own = pages.withColumns({"_payload": payload, "_sha": F.unhex(F.sha2(payload, 256))})
    narrow = saved(own.select("_sha", F.col(key).alias("k"), F.octet_length("_payload").alias("n")), "payloads")
    total = narrow.agg(F.sum(F.col("n").cast("long"))).head()[0] or 0
    groups = narrow.where(F.col("n") >= least).groupBy("_sha").agg(F.count("*").alias("rows"), F.min("k").alias("_first"))
    groups = saved(groups.where("rows > 1").select("_sha", "_first"), "groups")
    n = groups.count()
    if n <= BROADCAST_GROUPS:
        return own.join(maybe_broadcast(groups, n, BROADCAST_GROUPS), "_sha", "left").drop("_sha"), total
    salt = F.pmod(F.xxhash64(key), F.lit(SALTS)).cast("int")
    groups = groups.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    return own.withColumn("_salt", salt).join(groups, ["_sha", "_salt"], "left").drop("_sha", "_salt"), total


def write_warc(
    pages: DataFrame,
    path: str,
    key: str = "page_id",
    url: str = "url",
    payload: str = "html",
    least: int = 0,
    date: str = DATE,
    compress: bool = True,
) -> None:
    """One record a row, in a new folder of archives.

    Of rows with equal payloads of at least ``least`` bytes the one with the smallest key is a response and the others
    are revisits of it; smaller payloads are all responses.  Text payloads are written in UTF-8, a null one as empty.
    Repeated rows (the smallest key more than once) are all responses.  A null key is larger than all others.
    A null url is replaced by the record's name; in others what a URL cannot hold is percent-encoded.
    """
    own = pages.select(F.col(key).alias("key"), F.col(url).cast("string").alias("url"), F.col(payload).alias("payload"))
    body = F.coalesce(F.col("payload").cast("binary"), F.lit(b""))
    own, total = with_first(own, "key", body, least)
    again = F.col("_first").isNotNull() & ~F.col("key").eqNullSafe(F.col("_first"))
    own = own.select("key", "url", "_payload", F.when(again, F.col("_first")).alias("first"))
    last = 1 if compress else len(END)

    def run(batches):
        for batch in batches:
            rows = []
            for k, u, body, first in zip(*(c.to_pylist() for c in batch.columns)):
                kind = "response" if first is None else "revisit"
                data = record(kind, _name(k), u, body, None if first is None else _name(first), date)
                rows.append((member(data) if compress else data)[:-last])
            yield pa.RecordBatch.from_arrays([pa.array(rows, pa.binary())], names=["value"])

    rows = own.mapInArrow(run, "value binary").repartition(max(1, -(-total // FILE_BYTES)))
    end = "\0" if compress else END.decode()
    rows.select(F.col("value").cast("string")).write.option("lineSep", end).option("compression", "none").text(path)


# --- reading ------------------------------------------------------------------------------------------------

_COLUMNS = """kind string, file string, offset long, inside long, length long, reason string, type string, record_id string,
    refers_to string, uri string, date string, declared_digest string, payload_digest string, payload_bytes long,
    payload binary"""


def _bare(text: str | None) -> str | None:
    return text.removeprefix("<").removesuffix(">") if text is not None else None


def _row(file: str, f: Found, payload: bool) -> tuple:
    if f.reason is not None:
        return ("gap", file, f.offset, f.inside, f.length, f.reason, *[None] * 9)
    get = f.fields.get
    kind = get("warc-type")
    declared = get("warc-payload-digest")
    size, own = len(f.payload), digest(f.payload)
    if kind == "revisit":  # the payload is elsewhere: its length and digest are what the record tells
        told = re.search(rb"(?im)^content-length:[ \t]*([0-9]{1,18})[ \t]*\r?$", f.http)
        size, own = int(told[1]) if told else None, declared.partition(":")[2] if declared else None
    return ("record", file, f.offset, f.inside, f.length, None, kind, _bare(get("warc-record-id")),
            _bare(get("warc-refers-to")), get("warc-target-uri"), get("warc-date"), declared, own, size,
            f.payload if payload else None)


def read_warc(spark: SparkSession, path: str | list[str], payload: bool = True) -> DataFrame:
    """Records and gaps of all archives under a path, plain or gzipped.

    A row of kind ``record`` has its place, type, names, ``payload_bytes`` and ``payload_digest`` (bare base32 SHA-1, computed
    from the payload; as told by the record for revisits) and, unless switched off, ``payload``.  A row of kind ``gap``
    has its place and the ``reason``.  Empty files give no rows.  Bytes between records that are line ends or zeros are
    no gap.  A file is read whole by one task, so it must fit in its memory (and in 2 GB).
    """
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path).select("path", "content")
    fields = [c.split() for c in _COLUMNS.split(",")]
    names, kinds = [n for n, _ in fields], {"string": pa.string(), "long": pa.int64(), "binary": pa.binary()}
    schema = pa.schema([(n, kinds[k]) for n, k in fields])

    def run(batches):
        for batch in batches:
            for i in range(batch.num_rows):
                rows, held = [], 0
                for found in salvage(batch.column(1)[i].as_py()):
                    rows.append(_row(batch.column(0)[i].as_py(), found, payload))
                    held += 1 + len(found.payload)
                    if held > 4 << 20 or len(rows) >= 10_000:
                        yield _batch(rows)
                        rows, held = [], 0
                if rows:
                    yield _batch(rows)

    def _batch(rows):
        return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), schema)], names=names)

    return files.mapInArrow(run, _COLUMNS)


def gaps(rows: DataFrame) -> DataFrame:
    """The quarantine log: file, offset, inside, length and reason of the bytes that hold no sound record."""
    return rows.where("kind = 'gap'").select("file", "offset", "inside", "length", "reason")


def with_revisited(rows: DataFrame) -> DataFrame:
    """Records with the payload that a revisit refers to in its place (null if no response of that name and digest is there).

    Responses that are referred to go out once for each of some salts, so that one with very many revisits is spread.
    Of several responses of one name and digest any stands for all.
    """
    own = rows.where("kind = 'record'")
    again = own.where("type = 'revisit'").drop("payload").withColumn("_salt", (F.rand(7) * SALTS).cast("int"))
    wanted = again.select(F.col("refers_to").alias("_name"), F.col("payload_digest").alias("_digest")).distinct()
    held = own.where("type = 'response'").select(
        F.col("record_id").alias("_name"), F.col("payload_digest").alias("_digest"), "payload"
    )
    held = held.join(wanted, ["_name", "_digest"], "left_semi").dropDuplicates(["_name", "_digest"])
    held = held.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    same = (
        (again["refers_to"] == held["_name"]) & (again["payload_digest"] == held["_digest"]) & (again["_salt"] == held["_salt"])
    )
    filled = again.join(held, same, "left").select(*[c for c in own.columns if c != "payload"], "payload")
    return own.where("type is distinct from 'revisit'").unionByName(filled)


def page_report(rows: DataFrame) -> DataFrame:
    """page_id, payload_bytes, payload_digest, record_type and refers_to of the records that :func:`write_warc` made."""
    number = lambda c: F.expr(f"try_cast(substring_index({c}, ':', -1) as bigint)")
    return rows.where("kind = 'record'").select(
        number("record_id").alias("page_id"),
        "payload_bytes",
        "payload_digest",
        F.col("type").alias("record_type"),
        number("refers_to").alias("refers_to"),
    )


#: The same in SQL; base32 takes five bits of the hash for each letter.
ORACLE = """
select page_id, octet_length(encode(coalesce(html, ''))) payload_bytes,
    array_to_string(list_transform(range(32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
        ((('0x' || substr(sha1(coalesce(html, '')), 5 * (i // 4)::int + 1, 5))::bigint >> (15 - 5 * (i % 4))::int) & 31)::int + 1, 1)), '')
        payload_digest,
    case when page_id is distinct from first_id then 'revisit' else 'response' end record_type,
    case when page_id is distinct from first_id then first_id end refers_to
from (select *, min(page_id) over (partition by coalesce(html, '')) first_id from pages)"""
