"""Deterministic sharded WARC writer, and a reader.

Records are dealt to shards by ranges of page_id and sorted within; each record
is a gzip member of its own, files roll when their compressed size reaches
``ROLL_BYTES``, headers and digests are written anew, and files commit by
rename with a manifest beside them. Equal pages give equal files, whatever
executors wrote them: dates are a parameter and record ids derive from the
page. Of records with equal payloads of at least ``REVISIT_BYTES`` the one with
the largest page_id is a response and the others revisit it.

Representatives are found by a grouped maximum over digests (pre-aggregated
before the shuffle), so a payload that a third of the pages share costs one row
a task. Payloads of revisits are dropped before the shuffle.

Defined results: NULL html is the empty payload; pages that repeat both id and
payload are all responses or all revisits; NULL page_id is the smallest; an
empty table gives no files and an empty result; NULL url is an empty target.
"""

from __future__ import annotations

import base64
import hashlib
import uuid
import zlib

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from batchlens.llm.common import broadcast_if_small, table, work_path
from batchlens.llm.shards import RenamedFile, file_system, ranges, shard_of

REVISIT_BYTES = 1000
MOST_TASKS = 20_000  #: that read the archives back
SHARD_BYTES = 32 << 20  #: payload bytes of a shard
ROLL_BYTES = 8 << 20  #: compressed bytes of a file
BROADCAST_ROWS = 500_000
DATE = "2000-01-01T00:00:00Z"
CHUNK = 1 << 20
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
MANIFEST = "shard int, file string, records long, bytes long, sha1 string"
RECORD = ("page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long, "
          "url string, file string")


def decisions(pages: DataFrame) -> DataFrame:
    """page_id, url, html (NULL for revisits), payload_bytes, payload_digest, refers_to."""
    payload = F.encode(F.coalesce("html", F.lit("")), "utf-8")
    keyed = pages.select("page_id", "url", "html", F.octet_length(F.coalesce("html", F.lit(""))).cast("long")
                         .alias("payload_bytes"), F.sha1(payload).alias("payload_digest"))
    same = (keyed.where(F.col("payload_bytes") >= REVISIT_BYTES).groupBy(F.col("payload_digest").alias("digest"))
            .agg(F.max("page_id").alias("largest"), F.count(F.lit(1)).alias("n")).where("n > 1").drop("n"))
    same = broadcast_if_small(same, same.count(), BROADCAST_ROWS)
    found = keyed.join(same, F.col("payload_digest") == F.col("digest"), "left")
    refers = F.when((F.col("payload_bytes") >= REVISIT_BYTES) & ~F.col("page_id").eqNullSafe(F.col("largest")),
                    F.col("largest"))
    return found.select("page_id", "url", F.when(refers.isNull(), F.col("html")).alias("html"), "payload_bytes",
                        "payload_digest", refers.alias("refers_to"))


def record_id(page: str, digest: str) -> str:
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_OID, f'{page} {digest}')}>"


def record(page_id: int | None, url: str | None, html: str | None, size: int, digest: str,
           refers_to: int | None) -> bytes:
    """One record, before compression."""
    page = "" if page_id is None else str(page_id)
    payload = b"" if refers_to is not None else (html or "").encode("utf-8", "replace")
    block = (f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {size}\r\n\r\n"
             .encode() + payload)
    coded = base64.b32encode(bytes.fromhex(digest)).decode()
    head = [("WARC-Type", "response" if refers_to is None else "revisit"), ("WARC-Date", DATE),
            ("WARC-Record-ID", record_id(page, digest)), ("WARC-Target-URI", " ".join((url or "").split())),
            ("WARC-Payload-Digest", f"sha1:{coded}"),
            ("WARC-Block-Digest", f"sha1:{base64.b32encode(hashlib.sha1(block).digest()).decode()}"),
            ("Content-Type", "application/http; msgtype=response"), ("X-Page-Id", page)]
    if refers_to is not None:
        head += [("WARC-Profile", PROFILE), ("WARC-Refers-To", record_id(str(refers_to), digest)),
                 ("X-Refers-To-Page-Id", str(refers_to))]
    head.append(("Content-Length", str(len(block))))
    return b"WARC/1.1\r\n" + "".join(f"{k}: {v}\r\n" for k, v in head).encode() + b"\r\n" + block + b"\r\n\r\n"


class _Roll:
    """The open file of a shard; finished files are listed for the manifest."""

    def __init__(self, folder: str, shard: int):
        self.folder, self.shard, self.part, self.done, self.file = folder, shard, 0, [], None

    def add(self, data: bytes) -> None:
        member = zlib.compressobj(6, zlib.DEFLATED, 31)
        data = member.compress(data) + member.flush()
        if self.file is None:
            self.name = f"part-{self.shard:06d}-{self.part:05d}.warc.gz"
            self.file, self.sha, self.records = RenamedFile(self.folder, self.name), hashlib.sha1(), 0
        self.file.write(data)
        self.sha.update(data)
        self.records += 1
        if self.file.bytes >= ROLL_BYTES:
            self.close()

    def close(self) -> None:
        if self.file is not None:
            self.file.commit()
            self.done.append((self.shard, self.name, self.records, self.file.bytes, self.sha.hexdigest()))
            self.part, self.file = self.part + 1, None


def write(pages: DataFrame, folder: str) -> DataFrame:
    """Write the archives; the manifest, as committed below ``folder``/manifest."""
    found = decisions(pages.select("page_id", "url", "html"))
    bounds = ranges(pages.select("page_id", "html"), "page_id", F.octet_length(F.coalesce("html", F.lit(""))),
                    SHARD_BYTES)
    dealt = (found.withColumn("shard", shard_of(F.col("page_id"), bounds))
             .repartitionById(len(bounds) + 1, F.col("shard"))
             # ids as text: pandas would turn long columns with NULLs into floats
             .withColumns({"page": F.col("page_id").cast("string"), "refers": F.col("refers_to").cast("string")})
             .sortWithinPartitions("shard", "page_id", "payload_digest", "url")
             .select("shard", "page", "url", "html", "payload_bytes", "payload_digest", "refers"))

    def save(batches):
        roll = None
        for pdf in batches:
            for r in pdf.itertuples(index=False):
                if roll is None or roll.shard != r.shard:
                    if roll is not None:
                        roll.close()
                        yield pd.DataFrame(roll.done, columns=["shard", "file", "records", "bytes", "sha1"])
                    roll = _Roll(folder, r.shard)
                text = [x if isinstance(x, str) else None for x in (r.page, r.url, r.html, r.refers)]
                roll.add(record(None if text[0] is None else int(text[0]), text[1], text[2], r.payload_bytes,
                                r.payload_digest, None if text[3] is None else int(text[3])))
        if roll is not None:
            roll.close()
            yield pd.DataFrame(roll.done, columns=["shard", "file", "records", "bytes", "sha1"])

    dealt.mapInPandas(save, MANIFEST).write.parquet(f"{folder}/manifest")
    return pages.sparkSession.read.schema(MANIFEST).parquet(f"{folder}/manifest")


def members(stream):
    """Uncompressed records of a stream of gzip members, one at a time."""
    rest = b""
    while True:
        member, out = zlib.decompressobj(31), []
        while not member.eof:
            rest = rest or stream.read(CHUNK)
            if not rest:
                if out:
                    raise ValueError("the archive ends within a record")
                return
            out.append(member.decompress(rest))
            rest = member.unused_data
        yield b"".join(out)


def parse(data: bytes) -> dict:
    """Headers of a record and, of a response, the checked size and digest of its payload."""
    head, _, body = data.partition(b"\r\n\r\n")
    h = dict(x.split(": ", 1) if ": " in x else (x.rstrip(":"), "") for x in head.decode().split("\r\n")[1:])
    block = body[:int(h["Content-Length"])]
    http, _, payload = block.partition(b"\r\n\r\n")
    digest = base64.b32decode(h["WARC-Payload-Digest"].removeprefix("sha1:")).hex()
    size = int(http.rpartition(b"Content-Length: ")[2])
    if h["WARC-Type"] == "response" and (hashlib.sha1(payload).hexdigest() != digest or len(payload) != size):
        raise ValueError(f"payload of {h['WARC-Record-ID']} does not match its digest")
    return {"page": h["X-Page-Id"] or None, "bytes": size, "digest": digest, "type": h["WARC-Type"],
            "refers": h.get("X-Refers-To-Page-Id"), "url": h["WARC-Target-URI"]}


def read(manifest: DataFrame, folder: str) -> DataFrame:
    """Records of all files that the manifest lists."""
    def load(batches):
        for pdf in batches:
            for name in pdf.file:
                fs, path = file_system(folder)
                rows = []
                with fs.open_input_stream(f"{path}/{name}", compression=None) as stream:
                    for data in members(stream):
                        rows.append(parse(data) | {"file": name})
                yield pd.DataFrame(rows)

    # with a number of its own: by their size the few rows of the list would be put in one task
    files = manifest.select("file").repartition(min(max(manifest.count(), 1), MOST_TASKS), "file")
    raw = files.mapInPandas(load, "page string, bytes long, digest string, type string, refers string, url string, "
                                  "file string")
    return raw.select(F.col("page").cast("long").alias("page_id"), F.col("bytes").alias("payload_bytes"),
                      F.col("digest").alias("payload_digest"), F.col("type").alias("record_type"),
                      F.col("refers").cast("long").alias("refers_to"), "url", "file")


def query(spark, sf_dir: str) -> DataFrame:
    folder = work_path(spark, "warc")
    return read(write(table(spark, sf_dir, "pages"), folder), folder).drop("url", "file")


ORACLE = f"""
WITH p AS (SELECT page_id, octet_length(encode(coalesce(html, ''))) AS b, sha1(coalesce(html, '')) AS d FROM pages),
m AS (SELECT *, CASE WHEN b >= {REVISIT_BYTES} THEN max(page_id) OVER (PARTITION BY d) END AS top FROM p)
SELECT page_id, CAST(b AS BIGINT) AS payload_bytes, d AS payload_digest,
  CASE WHEN top <> page_id THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN top <> page_id THEN top END AS refers_to
FROM m
"""
