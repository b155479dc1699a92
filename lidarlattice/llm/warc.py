"""WARC derivatives: responses -> linked metadata and plain-text conversion records.

Records are rows (see RECORD); blocks are bytes, so that digests and lengths fit whatever a
server sent. Every response gives one metadata and one conversion record. Both name the
response in WARC-Refers-To, keep its target, date and payload digest, and carry the
source's other WARC fields as they are; the metadata record also repeats the source's HTTP
headers and names the conversion in WARC-Concurrent-To. Identifiers are UUIDs made from the
source's identifier, so a task that runs twice makes the same records. The work is row by
row and never shuffles.

Files hold a warcinfo record and then one gzip member for each record. Spark's text writer
puts a line end after every row; as the last byte of a gzip member is the top byte of its
length, 0 for all but giant records, the members are written without it and the line end is
that byte (a giant record is followed by an empty member).
"""

from __future__ import annotations

import base64
import codecs
import gzip
import hashlib
import re
import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lidarlattice.llm._common import SLICE_BYTES, slices, table
from lidarlattice.llm.html_nodes import attributes, plain_text

#: One WARC record: its named header fields that are used here, other fields as lines, and the block.
RECORD = T.StructType(
    [T.StructField(n, T.StringType()) for n in ("warc_type", "record_id", "refers_to", "concurrent_to", "target_uri", "warc_date", "content_type", "block_digest", "payload_digest", "more_headers")]
    + [T.StructField("content_length", T.LongType()), T.StructField("block", T.BinaryType())]
)
NAMES = {"WARC-Type": "warc_type", "WARC-Record-ID": "record_id", "WARC-Refers-To": "refers_to", "WARC-Concurrent-To": "concurrent_to", "WARC-Target-URI": "target_uri", "WARC-Date": "warc_date", "Content-Type": "content_type", "WARC-Block-Digest": "block_digest", "WARC-Payload-Digest": "payload_digest"}
END = "\r\n"


def digest(data: bytes) -> str:
    return "sha1:" + base64.b32encode(hashlib.sha1(data).digest()).decode()


def derived_id(source_id: str | None, kind: str) -> str:
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'{source_id or ""} {kind}')}>"


def responses(df: DataFrame, key_col: str = "page_id", url_col: str = "url", html_col: str = "html", date: str = "2024-01-01T00:00:00Z") -> DataFrame:
    """Pages -> response records (RECORD after the key column), as a crawler would have stored them.

    A null page is an empty payload, a null url an empty target; a null key stays null. Long
    pages stay whole, repeated rows give records of one identifier, other columns are left
    out, an empty table stays empty. Built-in functions only.
    """
    body = F.coalesce(F.col(html_col), F.lit(""))
    data = F.encode(body, "UTF-8")
    head = F.concat(F.lit(f"HTTP/1.1 200 OK{END}Content-Type: text/html; charset=utf-8{END}Content-Length: "), F.length(data).cast("string"), F.lit(END + END))
    block = F.concat(F.encode(head, "UTF-8"), data)
    url = F.coalesce(F.col(url_col), F.lit(""))
    seed = F.md5(F.encode(F.concat_ws(" ", F.lit("response"), F.coalesce(F.col(key_col).cast("string"), F.lit("")), url, F.sha1(data)), "UTF-8"))
    uid = F.concat_ws("-", *[F.substring(seed, a, n) for a, n in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))])
    fields = {
        "warc_type": F.lit("response"), "record_id": F.concat(F.lit("<urn:uuid:"), uid, F.lit(">")), "refers_to": F.lit(None).cast("string"), "concurrent_to": F.lit(None).cast("string"), "target_uri": url, "warc_date": F.lit(date),
        "content_type": F.lit("application/http; msgtype=response"), "block_digest": F.concat(F.lit("sha1:"), base32(F.sha1(block))), "payload_digest": F.concat(F.lit("sha1:"), base32(F.sha1(data))), "more_headers": F.lit(""),
        "content_length": F.length(block).cast("long"), "block": block,
    }
    return df.select(F.col(key_col).alias("key"), *[fields[f.name].alias(f.name) for f in RECORD.fields])


def base32(hex_digest):
    """Base 32 of a SHA-1 in hex: four groups of ten hex digits make eight characters each."""
    groups = [F.lpad(F.conv(F.substring(hex_digest, 1 + 10 * i, 10), 16, 32), 8, "0") for i in range(4)]
    return F.translate(F.concat(*groups), "0123456789ABCDEFGHIJKLMNOPQRSTUV", "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567")


def _attribute(data: str, name: str) -> str:
    return next((v for k, v in attributes(data) if k == name), "")


_CHARSET = re.compile(rb"""charset\s*=\s*["']?\s*([\w.:-]+)""", re.I)


def readable(head: bytes, payload: bytes) -> tuple[str, str]:
    """(media type, text) of a payload: by the charset of its header, else of its first bytes, else UTF-8; what does not fit is replaced."""
    line = next((h for h in head.split(b"\r\n")[1:] if h.lower().startswith(b"content-type:")), b"")
    kind = line.partition(b":")[2].partition(b";")[0].strip().lower().decode(errors="replace")
    named = _CHARSET.search(line) or _CHARSET.search(payload[:1024])
    try:
        charset = codecs.lookup(named[1].decode()).name if named else "utf-8"
        return kind, payload.decode(charset, "replace")
    except (LookupError, UnicodeError):
        return kind, payload.decode(errors="replace")


def derive(record: dict) -> list[dict]:
    """The metadata and the conversion record of one response."""
    head, _, payload = (record["block"] or b"").partition(b"\r\n\r\n")
    kind, source = readable(head, payload)
    hyper = kind in ("", "text/html", "application/xhtml+xml")
    found = {"html": "", "meta": "", "a": 0}  # the language, the charset, the links

    def see(name, data):
        if name == "a":
            found["a"] += bool(_attribute(data, "href"))
        elif name == "html" or name == "meta":
            found[name] = found[name] or _attribute(data, "lang" if name == "html" else "charset")

    text = plain_text(source, see) if hyper else source if kind.startswith("text/") else ""
    language, charset, links = found.values()
    status, *headers = head.decode(errors="replace").split(END)
    metadata_id, conversion_id = derived_id(record["record_id"], "metadata"), derived_id(record["record_id"], "conversion")
    lines = [f"via-status: {status}", *(f"via-header: {h}" for h in headers), *([f"via-concurrent-to: {record['concurrent_to']}"] if record["concurrent_to"] else [])]
    lines += [f"source-block-digest: {record['block_digest'] or ''}", f"html-lang: {language}", f"html-charset: {charset}", f"outlinks: {links}", f"text-length: {len(text)}"]
    shared = {"refers_to": record["record_id"], "target_uri": record["target_uri"], "warc_date": record["warc_date"], "payload_digest": record["payload_digest"], "more_headers": record["more_headers"] or ""}
    out = []
    for what, own, other, content, block in (("metadata", metadata_id, conversion_id, "application/warc-fields", END.join(lines) + END), ("conversion", conversion_id, None, "text/plain; charset=utf-8", text)):
        data = block.encode(errors="replace")
        out.append(shared | {"warc_type": what, "record_id": own, "concurrent_to": other, "content_type": content, "block_digest": digest(data), "content_length": len(data), "block": data})
    return out


def derivatives(records: DataFrame) -> DataFrame:
    """Records (key, RECORD) -> the derived records of its responses, two each.

    Records of other types are passed over, as they have no derivatives. Null blocks count
    as empty, null identifiers as empty text; repeated responses give repeated records with
    the same identifiers. Payloads that are neither HTML nor text give an empty conversion;
    long ones are read whole. Columns beside key and RECORD are left out, whatever their
    names; an empty table stays empty.
    """
    from pyspark.sql.pandas.types import to_arrow_schema

    names = [f.name for f in RECORD.fields]
    chosen = records.where("warc_type = 'response'").select("key", *names)
    arrow = to_arrow_schema(chosen.schema)

    def run(batches):
        for batch in batches:
            for part in slices(batch, "block"):
                rows = part.to_pylist()
                made = [d | {"key": r["key"]} for r in rows for d in derive(r)]
                yield pa.RecordBatch.from_pylist(made, schema=arrow)

    return chosen.mapInArrow(run, chosen.schema)


_EMPTY = gzip.compress(b"", mtime=0)


def header(record: dict) -> bytes:
    """The header of a record, to the blank line that ends it."""
    lines = ["WARC/1.1", *(f"{n}: {record[c]}" for n, c in NAMES.items() if record[c] is not None), *([record["more_headers"]] if record["more_headers"] else []), f"Content-Length: {record['content_length']}"]
    return (END.join(lines) + END + END).encode(errors="replace")


def write_warc(records: DataFrame, path: str, software: str = "lidarlattice") -> None:
    """Write records (RECORD) as gzip WARC 1.1 files under `path`: one per partition, each record a gzip member, a warcinfo record first.

    Partitions without records give no records; Spark's own names end in .txt.
    """
    names = [f.name for f in RECORD.fields]

    def member(head: bytes, block: bytes) -> bytes:
        data = gzip.compress(head + block + b"\r\n\r\n", mtime=0)
        return (data if data.endswith(b"\0") else data + _EMPTY)[:-1]

    def run(batches):
        first = True
        for batch in batches:
            for part in slices(batch, "block"):
                rows = part.to_pylist()
                out = []
                if first and rows:
                    info = f"software: {software}{END}format: WARC File Format 1.1{END}".encode()
                    date = next((r["warc_date"] for r in rows if r["warc_date"]), "1970-01-01T00:00:00Z")
                    own = dict.fromkeys(names) | {"warc_type": "warcinfo", "record_id": derived_id(rows[0]["record_id"], "warcinfo"), "warc_date": date, "content_type": "application/warc-fields", "block_digest": digest(info), "content_length": len(info)}
                    out.append(member(header(own), info))
                    first = False
                out += [member(header(r), r["block"] or b"") for r in rows]
                yield pa.RecordBatch.from_arrays([pa.array(out, pa.binary())], names=["value"])

    members = records.select(*names).mapInArrow(run, "value binary")
    members.select(F.col("value").cast("string")).write.option("lineSep", "\0").option("compression", "none").text(path)


def read_records(handle) -> Iterator[dict]:
    """The records of an open uncompressed WARC stream, one at a time; a field that repeats keeps its first value in its column."""
    while line := handle.readline():
        if not line.startswith(b"WARC/"):
            if line.strip():
                raise ValueError(f"no record starts at {line[:40]!r}")
            continue
        record, more = dict.fromkeys(f.name for f in RECORD.fields), []
        while (line := handle.readline()).strip():
            name, _, value = line.decode(errors="replace").rstrip("\r\n").partition(":")
            value = value.strip()
            column = next((c for n, c in NAMES.items() if n.lower() == name.lower()), None)
            if name.lower() == "content-length":
                record["content_length"] = int(value)
            elif column and record[column] is None:
                record[column] = value
            else:
                more.append(f"{name}: {value}")
        if record["content_length"] is None:
            raise ValueError("a record without Content-Length")
        block = handle.read(record["content_length"])
        if len(block) < record["content_length"]:
            raise ValueError("a record is cut short")
        yield record | {"block": block, "more_headers": END.join(more)}


def read_warc(spark: SparkSession, path: str) -> DataFrame:
    """WARC files (gzip or plain) under `path` -> (key: the file's path, RECORD).

    A file is read by one task as a stream: its records leave in batches of bounded size,
    so archives may be of any size. Broken files raise. No files give no rows.
    """
    from pyspark.sql.pandas.types import to_arrow_schema

    schema = T.StructType([T.StructField("key", T.StringType()), *RECORD.fields])
    arrow = to_arrow_schema(schema)

    def run(batches):
        import io

        from pyarrow import fs

        for batch in batches:
            for name in batch.column("path").to_pylist():
                system, inner = fs.FileSystem.from_uri(re.sub(r"^file:/+", "file:///", name))
                with system.open_input_stream(inner, compression=None) as raw:
                    stream = io.BufferedReader(raw, 1 << 20)
                    handle = io.BufferedReader(gzip.GzipFile(fileobj=stream), 1 << 20) if stream.peek(2)[:2] == b"\x1f\x8b" else stream
                    rows, size = [], 0
                    for record in read_records(handle):
                        rows.append(record | {"key": name})
                        size += len(record["block"])
                        if size > SLICE_BYTES or len(rows) >= 4096:
                            yield pa.RecordBatch.from_pylist(rows, schema=arrow)
                            rows, size = [], 0
                    if rows:
                        yield pa.RecordBatch.from_pylist(rows, schema=arrow)

    files = spark.read.format("binaryFile").load(path).select("path")
    return files.repartition(spark.sparkContext.defaultParallelism, "path").mapInArrow(run, schema)


def op5_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The derived records of every page with their blocks: the texts of conversions, the fields of metadata."""
    return derivatives(responses(table(spark, sf_dir, "pages"))).withColumnRenamed("key", "page_id").withColumn("block", F.decode("block", "UTF-8"))


QUERIES = {"op5_warc": op5_warc}
ORACLE_SQL: dict[str, str] = {}
