"""WARC archives: writing with an index, and reading back by coalesced byte ranges.

Every task writes its pages as gzip members of one archive in the shared folder and returns one index
row per record: archive, offset, length, URL, digest and kind. The name of an archive holds
the attempt that wrote it, and only rows of attempts that succeeded reach the index, so an archive
that a lost executor left behind is never read. A reader selects index rows, sorts them by place, joins ranges
with small gaps and reads each joined range once.

Of records with equal payloads of at least `LEAST_SHARED` bytes the one with the largest page id is a response
with the payload and the others are revisits that name it. Rows that repeat that page id are responses
as well, a row without page id is a revisit if there is a page id to name. Null html counts as empty;
null urls become empty targets. Empty tables give an empty index. Only the named columns are read.
"""

from __future__ import annotations

import hashlib
import uuid
import zlib
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cargolens.llm.common import utf8
from cargolens.sources.workspace import fresh_path, stored

LEAST_SHARED = 1000  # bytes from which equal payloads are written once
STRIPE = 4 << 20  # bytes of an archive that one read task row covers
READ = 32 << 20  # bytes of records that one task reads
GAP = 64 << 10  # unselected bytes that are read over rather than skipped
DATE = "2026-01-01T00:00:00Z"

INDEX = ("archive string, offset bigint, length bigint, page_id bigint, url string, digest string, "
         "record_type string")
RECORD = ("page_id bigint, url string, payload_bytes bigint, payload_digest string, "
          "record_type string, refers_to bigint")


def arrow_schema(ddl: str) -> pa.Schema:
    kinds = {"string": pa.string(), "bigint": pa.int64()}
    return pa.schema([(n, kinds[k]) for n, k in (f.split() for f in ddl.split(", "))])


def file_system(path: str):
    """File system and path of a folder given as a URI or an absolute path."""
    from pyarrow.fs import FileSystem

    return FileSystem.from_uri(path)


# --- one record ---------------------------------------------------------


def record(page_id, url: str, payload: bytes, digest: str, refers_to=None) -> bytes:
    """A WARC/1.1 record as a gzip member; with `refers_to` a revisit without payload."""
    http = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n" + (
        f"Content-Length: {len(payload)}\r\n\r\n".encode())
    block = http if refers_to is not None else http + payload
    target = "".join(c if c > " " else f"%{ord(c):02X}" for c in url)
    name = uuid.uuid5(uuid.NAMESPACE_URL, f"{page_id} {target} {digest}")
    lines = ["WARC/1.1", f"WARC-Type: {'response' if refers_to is None else 'revisit'}",
             f"WARC-Record-ID: <urn:uuid:{name}>", f"WARC-Date: {DATE}",
             f"WARC-Target-URI: {target}", f"WARC-Payload-Digest: sha1:{digest}",
             "Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}",
             f"X-Payload-Length: {len(payload)}"]
    if page_id is not None:
        lines.append(f"X-Page-Id: {page_id}")
    if refers_to is not None:
        lines += ["WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest",
                  f"X-Refers-To-Page-Id: {refers_to}"]
    head = utf8("\r\n".join(lines) + "\r\n\r\n")
    packer = zlib.compressobj(1, zlib.DEFLATED, 31)
    return packer.compress(head + block + b"\r\n\r\n") + packer.flush()


def parsed(data: bytes) -> tuple[dict[str, str], bytes]:
    """Header fields and payload of one record; it raises if the record is damaged."""
    unpacker = zlib.decompressobj(31)
    raw = unpacker.decompress(data) + unpacker.flush()
    if not unpacker.eof or unpacker.unused_data:
        raise ValueError("the index does not point at one whole record")
    head, _, rest = raw.partition(b"\r\n\r\n")
    fields = dict(line.split(": ", 1) for line in
                  head.decode("utf-8", "surrogatepass").split("\r\n")[1:])
    block = rest[:int(fields["Content-Length"])]
    if rest[len(block):] != b"\r\n\r\n":
        raise ValueError("the record's length is wrong")
    return fields, block.partition(b"\r\n\r\n")[2]


def described(data: bytes) -> dict:
    """What a record says about its page; a response's figures are taken from its payload."""
    fields, payload = parsed(data)
    kind = fields["WARC-Type"]
    digest, size = fields["WARC-Payload-Digest"].removeprefix("sha1:"), fields["X-Payload-Length"]
    if kind == "response":
        if hashlib.sha1(payload).hexdigest() != digest:
            raise ValueError("the payload does not match its digest")
        size = len(payload)
    number = {k: None if k not in fields else int(fields[k])
              for k in ("X-Page-Id", "X-Refers-To-Page-Id")}
    return {"page_id": number["X-Page-Id"], "url": fields["WARC-Target-URI"],
            "payload_bytes": int(size), "payload_digest": digest, "record_type": kind,
            "refers_to": number["X-Refers-To-Page-Id"]}


# --- archives -----------------------------------------------------------


def classified(pages: DataFrame, key: str = "page_id", url: str = "url",
               page: str = "html") -> DataFrame:
    """Pages with digest and, for revisits, the page that holds their payload.

    Digests that hold more than a fair partition's rows are few; they are looked up by broadcast. The
    other shared digests are joined by shuffle, where rows that need no lookup get keys of
    their own and so spread.
    """
    spark = pages.sparkSession
    width = int(spark.conf.get("spark.sql.shuffle.partitions"))
    payload = F.coalesce(F.col(page), F.lit(""))
    rows = pages.select(F.col(key).cast("bigint").alias("page_id"),
                        F.coalesce(F.col(url), F.lit("")).alias("url"), payload.alias("html"),
                        F.sha1(payload.cast("binary")).alias("digest"))
    large = F.octet_length("html") >= LEAST_SHARED
    shared = stored(rows.where(large).groupBy("digest")
                    .agg(F.max("page_id").alias("keeper"), F.count("*").alias("copies"))
                    .where((F.col("copies") > 1) & F.col("keeper").isNotNull()), "shared_payloads")
    total = shared.agg(F.sum("copies")).first()[0] or 0
    hot = shared.where(F.col("copies") * width > total)  # fewer than `width` rows
    cold = shared.where(F.col("copies") * width <= total)
    rows = rows.join(F.broadcast(hot.select("digest", F.col("keeper").alias("hot"))),
                     "digest", "left")
    alone = F.col("hot").isNotNull() | ~large
    rows = rows.withColumn("lookup", F.when(alone, F.concat(F.lit("-"), F.monotonically_increasing_id()))
                           .otherwise(F.col("digest")))
    rows = rows.join(cold.select(F.col("digest").alias("lookup"), F.col("keeper").alias("cold")),
                     "lookup", "left")
    keeper = F.when(large, F.coalesce("hot", "cold"))
    return rows.select("page_id", "url", "html", "digest",
                       F.when(~keeper.eqNullSafe(F.col("page_id")), keeper).alias("refers_to"))


def write(pages: DataFrame, folder: str) -> DataFrame:
    """Write `classified` pages below `folder`; the index of all records."""
    spark = pages.sparkSession
    fs, root = file_system(folder)
    fs.create_dir(root, recursive=True)

    def archive(batches: Iterator[pa.RecordBatch]) -> Iterable[pa.RecordBatch]:
        task = TaskContext.get()
        name = f"pages-{task.partitionId():06d}-{task.taskAttemptId()}.warc.gz"
        system, where = file_system(folder)
        stream, offset = None, 0
        try:
            for batch in batches:
                index = []
                for row in batch.to_pylist():
                    data = record(row["page_id"], row["url"], utf8(row["html"]), row["digest"],
                                  row["refers_to"])
                    stream = stream or system.open_output_stream(f"{where}/{name}",
                                                                 compression=None)
                    stream.write(data)
                    kind = "response" if row["refers_to"] is None else "revisit"
                    index.append({"archive": name, "offset": offset, "length": len(data),
                                  "page_id": row["page_id"], "url": row["url"],
                                  "digest": row["digest"], "record_type": kind})
                    offset += len(data)
                yield pa.RecordBatch.from_pylist(index, arrow_schema(INDEX))
        finally:
            if stream is not None:
                stream.close()

    index = pages.mapInArrow(archive, INDEX)
    path = f"{folder.rstrip('/')}/index"
    index.write.parquet(path)
    return spark.read.schema(INDEX).parquet(path)


def ranges(spans: list[tuple[int, int]], gap: int = GAP) -> list[list[tuple[int, int]]]:
    """Sorted (offset, length) spans, grouped so that neighbours are at most `gap` bytes apart."""
    groups, end = [], None
    for offset, length in sorted(spans):
        if end is None or offset - end > gap:
            groups.append([])
            end = offset
        groups[-1].append((offset, length))
        end = max(end, offset + length)
    return groups


def read(selected: DataFrame, folder: str) -> DataFrame:
    """The records that index rows point at, each described by what stands in the archive.

    Index rows are small and what they stand for is not, so the stripes are dealt to as many tasks as the
    records need by their own bytes (`READ` each).
    """
    total = selected.agg(F.coalesce(F.sum("length"), F.lit(0))).first()[0]
    stripes = selected.withColumn("stripe", F.expr(f"offset div {STRIPE}"))
    places = (stripes.repartition(-(-total // READ) or 1, "archive", "stripe").groupBy("archive", "stripe")
              .agg(F.collect_list(F.struct("offset", "length")).alias("spans"))
              .select("archive", "spans"))

    def fetch(batches: Iterator[pa.RecordBatch]) -> Iterable[pa.RecordBatch]:
        system, where = file_system(folder)
        for batch in batches:
            for row in batch.to_pylist():
                with system.open_input_file(f"{where}/{row['archive']}") as file:
                    for group in ranges([(s["offset"], s["length"]) for s in row["spans"]]):
                        start = group[0][0]
                        size = max(o + n for o, n in group) - start
                        data = file.read_at(size, start)
                        found = [described(data[o - start:o - start + n]) for o, n in group]
                        yield pa.RecordBatch.from_pylist(found, arrow_schema(RECORD))

    return places.mapInArrow(fetch, RECORD)


def round_trip(pages: DataFrame, key: str = "page_id", url: str = "url",
               page: str = "html") -> DataFrame:
    """Write all pages into archives of the shared folder and read every record back."""
    folder = fresh_path(pages.sparkSession, "warc")
    return read(write(classified(pages, key, url, page), folder), folder)
