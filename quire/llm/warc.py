"""WARC archives: a writer with one gzip member per record, and a sequential
reader with incremental decompression, content-length framing and digest
verification.

Writing: each task writes archive files of bounded size into the shared
folder, under names of its own, and returns a manifest row for each finished
file. Only files of the manifest are read, so what a lost or repeated task
left behind does no harm. Files go through ``pyarrow.fs``, so the folder may
lie in any store that Arrow can open.

Among records with equal payloads of at least ``LEAST`` bytes, that with the
smallest id is a response and the others are revisits that name it. Digests
of many copies are counted with map-side combine; those with at least 1/1000
of the rows are joined by broadcast (at most 1000), and their rows do not
take part in the shuffle by digest.

Reading: one file is read front to back in small chunks; a record's block is
complete when its content-length is reached, and its digests must match, else
the read fails with the file and record.

Defined results: a NULL payload is empty; a NULL url is left out of the
record; a NULL id sorts after all others; repeated rows with the smallest id
are all responses; an empty table gives no archives and no rows; other
columns are not archived.
"""

from __future__ import annotations

import hashlib
import uuid
import zlib
from collections.abc import Iterator
from urllib.parse import quote

import pandas as pd
from pyarrow import fs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quire.llm.common import hot_limit, materialise, shared_dir, small_batches

LEAST = 100
ROLL_BYTES = 64 << 20
CHUNK = 1 << 16
DATE = "2024-01-01T00:00:00Z"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
MANIFEST = "path string, records long, bytes long"
RECORD = ("record_id long, url string, record_type string, payload binary, payload_bytes long, "
          "payload_digest string, refers_to long")


# ------------------------------------------------------------------ one record

def _urn(ident: int | None) -> str:
    return f"<urn:x-page:{'' if ident is None else ident}>"


def _ident(urn: str) -> int | None:
    number = urn.removeprefix("<urn:x-page:").removesuffix(">")
    return int(number) if number else None


def record_bytes(kind: str, ident: int | None, url: str | None, payload: bytes, digest: str, size: int,
                 refers_to: int | None) -> bytes:
    """One record as a gzip member. A revisit holds the HTTP head only."""
    head = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n" % size
    block = head + payload if kind == "response" else head
    fields = [("WARC-Type", kind), ("WARC-Record-ID", _urn(ident)), ("WARC-Date", DATE)]
    if url is not None:
        fields.append(("WARC-Target-URI", quote(url, safe="%/:=&?~#+!$,;'@()*[]")))
    fields += [("Content-Type", "application/http; msgtype=response"), ("WARC-Payload-Digest", f"sha256:{digest}"),
               ("WARC-Block-Digest", f"sha256:{hashlib.sha256(block).hexdigest()}")]
    if kind == "revisit":
        fields += [("WARC-Profile", PROFILE), ("WARC-Refers-To", _urn(refers_to))]
    fields.append(("Content-Length", str(len(block))))
    text = "WARC/1.1\r\n" + "".join(f"{k}: {v}\r\n" for k, v in fields) + "\r\n"
    packer = zlib.compressobj(6, zlib.DEFLATED, 31)
    return packer.compress(text.encode("utf-8")) + packer.compress(block) + packer.compress(b"\r\n\r\n") + packer.flush()


class BadArchive(ValueError):
    pass


class Inflate:
    """The decompressed bytes of a file of gzip members, read on demand; it
    knows where a member ends."""

    def __init__(self, stream):
        self.stream, self.member, self.raw, self.held = stream, zlib.decompressobj(31), b"", bytearray()

    def more(self) -> bool:
        """Decompress a further chunk; False at the end of the member."""
        if self.member.eof:
            return False
        data = self.raw or self.stream.read(CHUNK)
        if not data:
            raise BadArchive("the file ends inside a record")
        self.held += self.member.decompress(data, 16 * CHUNK)
        self.raw = self.member.unconsumed_tail or self.member.unused_data
        return True

    def next_member(self) -> bool:
        self.held.clear()
        self.raw = self.raw or self.stream.read(CHUNK)
        self.member = zlib.decompressobj(31)
        return bool(self.raw)

    def until(self, mark: bytes) -> bytes:
        at = 0
        while (end := self.held.find(mark, at)) < 0:
            at = max(0, len(self.held) - len(mark))
            if not self.more():
                raise BadArchive("a record without a head")
        out = bytes(self.held[:end])
        del self.held[:end + len(mark)]
        return out

    def exactly(self, n: int) -> bytes:
        while len(self.held) < n:
            if not self.more():
                raise BadArchive("a record shorter than its content-length")
        out = bytes(self.held[:n])
        del self.held[:n]
        return out

    def rest(self) -> bytes:
        while self.more():
            pass
        return bytes(self.held)


def read_records(stream, name: str = "") -> Iterator[tuple[dict[str, str], bytes]]:
    """Fields (lower-case names) and block of each record, digests checked."""
    source, at = Inflate(stream), 0
    while source.next_member():
        try:
            version, *lines = source.until(b"\r\n\r\n").decode("utf-8").split("\r\n")
            if not version.startswith("WARC/1."):
                raise BadArchive(f"not a WARC record: {version[:40]!r}")
            fields = {k.strip().lower(): v.strip() for k, _, v in (x.partition(":") for x in lines)}
            block = source.exactly(int(fields["content-length"]))
            if source.rest() != b"\r\n\r\n":
                raise BadArchive("a record longer than its content-length")
            if fields.get("warc-block-digest", "") != f"sha256:{hashlib.sha256(block).hexdigest()}":
                raise BadArchive("block digest differs")
        except (BadArchive, KeyError, ValueError, zlib.error) as e:
            raise BadArchive(f"{name}, record {at}: {e}") from e
        yield fields, block
        at += 1


def parsed(fields: dict[str, str], block: bytes, name: str = "") -> tuple:
    """One row of RECORD."""
    head, _, payload = block.partition(b"\r\n\r\n")
    sizes = [int(x.split(b":")[1]) for x in head.split(b"\r\n") if x.lower().startswith(b"content-length:")]
    digest, kind = fields["warc-payload-digest"].removeprefix("sha256:"), fields["warc-type"]
    if kind == "response" and (sizes != [len(payload)] or hashlib.sha256(payload).hexdigest() != digest):
        raise BadArchive(f"{name}: payload of {fields['warc-record-id']} differs from its length or digest")
    return (_ident(fields["warc-record-id"]), fields.get("warc-target-uri"), kind,
            payload if kind == "response" else None, sizes[0], digest,
            _ident(fields["warc-refers-to"]) if kind == "revisit" else None)


# ------------------------------------------------------------------ Spark side

def plan_records(df: DataFrame, id_col: str = "page_id", url_col: str = "url", payload_col: str = "html") -> DataFrame:
    """(id, url, payload, digest, size, first): ``first`` is the id of the
    response for a revisit, else NULL."""
    pages = df.select(F.col(id_col).cast("long").alias("id"), F.col(url_col).alias("url"),
                      F.coalesce(F.col(payload_col), F.lit("")).cast("binary").alias("payload")) \
        .withColumns({"digest": F.sha2("payload", 256), "size": F.octet_length("payload").cast("long")})
    copies = materialise(pages.where(F.col("size") >= LEAST).groupBy("digest")
                         .agg(F.min("id").alias("first"), F.count(F.lit(1)).alias("n")).where("n > 1"))
    limit = hot_limit(df.count())
    hot = copies.where(F.col("n") >= limit).select(F.col("digest").alias("hot_digest"), F.col("first").alias("hot_first"))
    rest = copies.where(F.col("n") < limit).select(F.col("digest").alias("key"), F.col("first").alias("rest_first"))
    return (pages.join(F.broadcast(hot), F.col("digest") == F.col("hot_digest"), "left")
            .withColumn("key", F.when(F.col("hot_digest").isNull(), F.col("digest"))
                        .otherwise(F.concat_ws(" ", F.lit("hot"), F.col("id").cast("string"))))
            .join(rest, "key", "left")
            .withColumn("first", F.coalesce("hot_first", "rest_first"))
            .withColumn("first", F.when(~F.col("first").eqNullSafe(F.col("id")), F.col("first")))
            .select("id", "url", "payload", "digest", "size", "first"))


def write_archives(records: DataFrame, folder: str) -> DataFrame:
    """Writes the planned records; returns the manifest."""
    small_batches(records.sparkSession)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        store, base = fs.FileSystem.from_uri(folder)
        out, path, count, size = None, "", 0, 0

        def finished() -> pd.DataFrame:
            out.close()
            return pd.DataFrame([(path, count, size)], columns=["path", "records", "bytes"])

        for pdf in batches:
            for ident, url, payload, digest, length, first in pdf.itertuples(index=False, name=None):
                if out is None:
                    store.create_dir(base, recursive=True)
                    path, count, size = f"{base}/{uuid.uuid4().hex}.warc.gz", 0, 0
                    out = store.open_output_stream(path, compression=None)
                revisit = not pd.isna(first)
                data = record_bytes("revisit" if revisit else "response", None if pd.isna(ident) else int(ident), url,
                                    b"" if revisit else bytes(payload), digest, int(length),
                                    int(first) if revisit else None)
                out.write(data)
                count, size = count + 1, size + len(data)
                if size >= ROLL_BYTES:
                    yield finished()
                    out = None
        if out is not None:
            yield finished()

    return materialise(records.select("id", "url", "payload", "digest", "size", "first").mapInPandas(run, MANIFEST))


def read_archives(manifest: DataFrame, folder: str) -> DataFrame:
    """The records (RECORD) of all archives of the manifest."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        store, _ = fs.FileSystem.from_uri(folder)
        columns = [c.split()[0] for c in RECORD.split(", ")]

        def frame(rows):
            return pd.DataFrame(rows, columns=columns).astype({"record_id": "Int64", "refers_to": "Int64"})

        for pdf in batches:
            for path in pdf["path"]:
                with store.open_input_stream(path, compression=None) as stream:
                    rows, held = [], 0
                    for fields, block in read_records(stream, path):
                        rows.append(parsed(fields, block, path))
                        held += len(block)
                        if len(rows) >= 256 or held >= 4 << 20:
                            yield frame(rows)
                            rows, held = [], 0
                    if rows:
                        yield frame(rows)

    files = manifest.select("path").repartition(max(1, manifest.count()))
    return files.mapInPandas(run, RECORD)


def round_trip(df: DataFrame, id_col: str = "page_id", url_col: str = "url", payload_col: str = "html") -> DataFrame:
    """Writes ``df`` as archives under the shared folder and reads them back."""
    base = shared_dir(df.sparkSession)
    folder = f"{base if '://' in base or not base.startswith('file:') else base.replace('file:', 'file://', 1)}/warc-{uuid.uuid4().hex}"
    return read_archives(write_archives(plan_records(df, id_col, url_col, payload_col), folder), folder)
