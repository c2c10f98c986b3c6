"""WARC 1.1 archives: write pages, read them back sequentially.

Each record is one gzip member. The reader walks a file with an incremental zlib
decompressor, frames each record by its Content-Length and checks its digests, in
memory bounded by one record. Of records with equal payloads the one with the
largest id is a ``response``, others ``revisit`` it. Archives are written to a
folder that all executors share, through the file system its URI names; a file is
written under an attempt's own name and then renamed, so that a retried task
leaves no half file.

Defined results: a null html has an empty payload; a null url has no
WARC-Target-URI; a null id is written as ``null``, comes back as null, and can be
no target of a revisit; repeated rows give repeated records; rows that share the
target's id and payload are all responses; an empty table has no archives.
"""

from __future__ import annotations

import base64
import hashlib
import os
import uuid
import zlib
from collections.abc import Iterator
from urllib.parse import quote, unquote

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from relaylens.llm.common import scratch_path, small_batches

#: Bytes after which a task starts its next archive.
ARCHIVE_BYTES = 64 * 1024 * 1024
#: Bytes read from an archive at a time.
READ_BYTES = 1 << 20
_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
_HTTP = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n\r\n"


def sha1_base32(data: bytes) -> str:
    return base64.b32encode(hashlib.sha1(data).digest()).decode("ascii")


def record_bytes(page_id: str, url: str | None, payload: bytes, target: str | None, date: str) -> bytes:
    """One gzip member; ``target`` is the id that a revisit refers to."""
    block = _HTTP if target is not None else _HTTP + payload
    head = [
        "WARC/1.1",
        f"WARC-Type: {'response' if target is None else 'revisit'}",
        f"WARC-Record-ID: <urn:page:{page_id}>",
        f"WARC-Date: {date}",
        "Content-Type: application/http; msgtype=response",
        f"WARC-Payload-Digest: sha1:{sha1_base32(payload)}",
        f"WARC-Block-Digest: sha1:{sha1_base32(block)}",
        f"Content-Length: {len(block)}",
    ]
    if url is not None:
        head.append(f"WARC-Target-URI: {quote(url, safe=''':/?#[]@!$&'()*+,;=-._~''')}")
    if target is not None:
        head += [f"WARC-Refers-To: <urn:page:{target}>", f"WARC-Profile: {_PROFILE}"]
    body = "\r\n".join(head).encode("utf-8") + b"\r\n\r\n" + block + b"\r\n\r\n"
    pack = zlib.compressobj(6, zlib.DEFLATED, 31)
    return pack.compress(body) + pack.flush()


def members(stream) -> Iterator[bytes]:
    """The inflated content of each gzip member, one at a time."""
    inflate, parts, data = zlib.decompressobj(31), [], b""
    fresh = True
    while True:
        if not data:
            data = stream.read(READ_BYTES)
            if not data:
                if not fresh:
                    raise ValueError("the archive ends within a record")
                return
        parts.append(inflate.decompress(data))
        fresh = False
        data = inflate.unused_data
        if inflate.eof:
            yield b"".join(parts)
            inflate, parts, fresh = zlib.decompressobj(31), [], True


def parse_record(member: bytes) -> tuple[dict[str, str], bytes]:
    """Named fields (lower-case names) and block of one member, framed by Content-Length."""
    head, found, rest = member.partition(b"\r\n\r\n")
    lines = head.decode("utf-8").split("\r\n")
    if not found or not lines[0].startswith("WARC/"):
        raise ValueError("not a WARC record")
    fields = {k.strip().lower(): v.strip() for k, _, v in (x.partition(":") for x in lines[1:])}
    n = int(fields["content-length"])
    if len(rest) < n or rest[n:] != b"\r\n\r\n":
        raise ValueError(f"record {fields.get('warc-record-id')}: Content-Length {n} doesn't frame its block")
    return fields, rest[:n]


def _urn(value: str | None) -> str | None:
    found = (value or "").removeprefix("<urn:page:").removesuffix(">")
    return None if not found or found == "null" else found


def read_records(stream) -> Iterator[dict]:
    """Records of one open archive with their digests checked.

    ``payload`` is the HTTP body (empty in a revisit, whose digest is its target's).
    """
    for member in members(stream):
        fields, block = parse_record(member)
        if fields.get("warc-block-digest", "").removeprefix("sha1:") != sha1_base32(block):
            raise ValueError(f"block digest differs in {fields.get('warc-record-id')}")
        payload = block.partition(b"\r\n\r\n")[2]
        digest = fields["warc-payload-digest"].removeprefix("sha1:")
        kind = fields["warc-type"]
        if kind == "response" and digest != sha1_base32(payload):
            raise ValueError(f"payload digest differs in {fields.get('warc-record-id')}")
        url = fields.get("warc-target-uri")
        yield {"page_id": _urn(fields["warc-record-id"]), "url": None if url is None else unquote(url), "record_type": kind, "payload_digest": digest, "payload": payload, "refers_to": _urn(fields.get("warc-refers-to"))}


def _store(uri: str):
    from pyarrow import fs

    return fs.FileSystem.from_uri(uri if "://" in uri or uri.startswith("file:") else "file://" + os.path.abspath(uri))


def with_targets(pages: DataFrame, id_column: str = "page_id", html_column: str = "html") -> DataFrame:
    """Add _target: the largest id of the rows with an equal payload, null on that row itself.

    Payloads are compared by SHA-1 and length; the maximum is pre-aggregated per task,
    and only digests that occur more than once are joined back.
    """
    payload = F.encode(F.coalesce(F.col(html_column), F.lit("")), "UTF-8")
    digested = pages.withColumns({"_digest": F.sha1(payload), "_size": F.length(payload)})
    shared = digested.groupBy("_digest", "_size").agg(F.max(id_column).alias("_max"), F.count("*").alias("_n")).where("_n > 1").drop("_n")
    joined = digested.join(shared, ["_digest", "_size"], "left")
    return joined.withColumn("_target", F.when(F.col("_max").eqNullSafe(F.col(id_column)), F.lit(None)).otherwise(F.col("_max"))).drop("_digest", "_size", "_max")


def write_archives(pages: DataFrame, path: str, id_column: str = "page_id", url_column: str = "url", html_column: str = "html", date: str = "2024-01-01T00:00:00Z", archive_bytes: int = ARCHIVE_BYTES) -> DataFrame:
    """Write the pages as ``*.warc.gz`` below ``path`` (a URI all executors share); return (archive, n_records, bytes)."""
    spark = pages.sparkSession
    small_batches(spark)
    rows = with_targets(pages.select(F.col(id_column), F.col(url_column), F.col(html_column)), id_column, html_column)
    rows = rows.select(F.coalesce(F.col(id_column).cast("string"), F.lit("null")).alias("_id"), F.col(url_column).alias("_url"), F.coalesce(F.col(html_column), F.lit("")).alias("_html"), F.col("_target").cast("string").alias("_target"))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        store, root = _store(path)
        store.create_dir(root, recursive=True)
        made, out, count, size, name = [], None, 0, 0, ""

        def close() -> None:
            out.close()
            final = f"{root}/{name}.warc.gz"
            store.move(f"{root}/{name}.tmp", final)
            made.append((f"{path}/{name}.warc.gz", count, size))

        for batch in batches:
            for i, url, html, target in zip(batch["_id"], batch["_url"], batch["_html"], batch["_target"]):
                if out is None:
                    name = uuid.uuid4().hex
                    out, count, size = store.open_output_stream(f"{root}/{name}.tmp", compression=None), 0, 0
                data = record_bytes(i, url, html.encode("utf-8"), target, date)
                out.write(data)
                count, size = count + 1, size + len(data)
                if size >= archive_bytes:
                    close()
                    out = None
        if out is not None:
            close()
        yield pd.DataFrame(made, columns=["archive", "n_records", "bytes"])

    listed = rows.mapInPandas(run, "archive string, n_records bigint, bytes bigint")
    # the list of archives is what counts: files of failed attempts aren't on it
    index = scratch_path(spark, "warc-index")
    listed.write.parquet(index)
    return spark.read.parquet(index)


def read_archives(archives: DataFrame, with_payload: bool = True) -> DataFrame:
    """Records of the listed archives: page_id, url, record_type, payload_digest, refers_to (strings), payload_bytes, payload.

    One task walks one archive from start to end. A revisit's payload length and
    payload are its target's, which ``resolve`` joins; here they are null.
    """
    spark = archives.sparkSession
    small_batches(spark)
    schema = "page_id string, url string, record_type string, payload_digest string, payload_bytes bigint, refers_to string" + ", payload binary" * with_payload
    names = [x.split()[0] for x in schema.split(", ")]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for uri in batch["archive"]:
                store, root = _store(uri)
                rows, held = [], 0
                with store.open_input_stream(root, compression=None) as stream:
                    for r in read_records(stream):
                        response = r["record_type"] == "response"
                        r["payload_bytes"] = len(r["payload"]) if response else None
                        held += len(r["payload"])
                        r["payload"] = r["payload"] if response and with_payload else None
                        rows.append(r)
                        if len(rows) >= 1000 or held > 1 << 24:
                            yield _frame(rows, names)
                            rows, held = [], 0
                if rows:
                    yield _frame(rows, names)

    n = max(1, archives.count())
    return archives.select("archive").repartition(n, "archive").mapInPandas(run, schema)


def _frame(rows: list[dict], names: list[str]) -> pd.DataFrame:
    out = pd.DataFrame(rows, columns=names)
    out["payload_bytes"] = out["payload_bytes"].astype("Int64")
    return out


def resolve(records: DataFrame) -> DataFrame:
    """Give each revisit the payload length of the response it refers to (joined by id and digest)."""
    kept = [c for c in records.columns if c != "payload_bytes"]
    targets = records.where("record_type = 'response' AND page_id IS NOT NULL").groupBy(F.col("page_id").alias("refers_to"), F.col("payload_digest")).agg(F.max("payload_bytes").alias("_bytes"))
    return records.join(targets, ["refers_to", "payload_digest"], "left").select(*kept, F.coalesce("payload_bytes", "_bytes").alias("payload_bytes"))


def round_trip(pages: DataFrame, path: str | None = None, **columns) -> DataFrame:
    """Write the pages and read the archives back, revisits resolved, without payloads."""
    spark: SparkSession = pages.sparkSession
    archives = write_archives(pages, path or scratch_path(spark, "warc"), **columns)
    return resolve(read_archives(archives, with_payload=False))
