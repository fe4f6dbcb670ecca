"""WARC archives whose repeated payloads are revisit records.

An archive is the bytes of a WARC 1.1 file, one gzip member a record, held as one
row (archive, data) of about ``ARCHIVE`` bytes, so that Spark's own committer writes
it and a lost executor leaves nothing half done.

Revisit resolution: the records' headers (no payloads) are read from the archives
and shuffled by payload digest and length; each group's response is the record with
the largest id; payloads under ``LEAST`` bytes are responses always. Members that
become revisits are joined to their originals and every record gets fresh headers
in new archives. Groups are reduced within each task before the exchange. Archives
stay where they are: they are stored in buckets by name, and the lists of revisits, a few bytes a
record, are dealt to the same buckets. No payload is ever shuffled. A list of at most SMALL_LIST
is sent to every executor.

A response's block is an HTTP head and the payload; a revisit's is the head alone, with the
original's record id, target URI and date.

Edge cases: null html is an empty payload; a null or blank url is ``urn:page:<id>``, and what no URI may
hold is percent-encoded; an html of any length is one record; a record
that already is a revisit has no payload of its own and is resolved by its digest;
a record
with the id of its group's response stays a response, also if rows are repeated; a
null id is never a group's response and never revisits; an empty table gives no archives; other columns are ignored.
"""

from __future__ import annotations

import hashlib
import uuid
import zlib
from urllib.parse import quote

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm.base import batches, for_salts, hot_keys, named, salted, small_batches, table
from tessera.session import materialize, scratch_path

LEAST, ARCHIVE = 1000, 4_000_000
#: Revisits up to which their list is sent to every executor; beyond it, lists are dealt to the buckets of the archives.
SMALL_LIST = 200_000
DATE = "1970-01-01T00:00:00Z"
ARCHIVES = "archive string, data binary"
HEADERS = "archive string, page_id bigint, uri string, record_type string, digest string, length bigint, refers_to bigint"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


def record_id(page_id: int | None, kind: str, digest: str) -> str:
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'{page_id}:{kind}:{digest}')}>"


def record(page_id: int | None, uri: str, kind: str, digest: str, length: int, payload: bytes, refers_to: int | None = None, refers_uri: str | None = None) -> bytes:
    """One gzip member. ``length`` is the full payload's, also for a revisit, whose block is the HTTP head."""
    lines = [
        "WARC/1.1",
        f"WARC-Type: {kind}",
        f"WARC-Record-ID: {record_id(page_id, kind, digest)}",
        f"WARC-Date: {DATE}",
        f"WARC-Target-URI: {uri}",
        f"WARC-Payload-Digest: sha1:{digest}",
        f"X-Payload-Length: {length}",
        "Content-Type: application/http;msgtype=response",
    ]
    if page_id is not None:
        lines.append(f"X-Page-ID: {page_id}")
    if kind == "revisit":
        lines.append(f"WARC-Profile: {PROFILE}")
        if refers_to is not None:
            lines += [f"WARC-Refers-To: {record_id(refers_to, 'response', digest)}", f"WARC-Refers-To-Target-URI: {refers_uri}", f"WARC-Refers-To-Date: {DATE}", f"X-Refers-To-Page-ID: {refers_to}"]
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {length}\r\n\r\n".encode()
    head = "\r\n".join([*lines, f"Content-Length: {len(http) + len(payload)}", "", ""]).encode()
    packer = zlib.compressobj(1, zlib.DEFLATED, 31)
    return packer.compress(head + http) + packer.compress(payload) + packer.compress(b"\r\n\r\n") + packer.flush()


def records(data: bytes):
    """(headers, payload) of each record of an archive, the payload behind the HTTP head; raises ValueError where one is damaged."""
    data, at = memoryview(data), 0
    while at < len(data):
        opener, parts = zlib.decompressobj(31), []
        while not opener.eof:  # in small pieces: what is left of a piece is copied
            piece = data[at : at + 8192]
            if not len(piece):
                raise ValueError("cut record")
            parts.append(opener.decompress(piece))
            at += len(piece) - len(opener.unused_data)
        raw = b"".join(parts)
        head, _, rest = raw.partition(b"\r\n\r\n")
        lines = head.decode().split("\r\n")
        headers = dict(line.split(": ", 1) for line in lines[1:])
        size = int(headers["Content-Length"])
        if lines[0] != "WARC/1.1" or rest[size:] != b"\r\n\r\n":
            raise ValueError("damaged record")
        yield headers, rest[rest.index(b"\r\n\r\n") + 4 : size]


def _page(headers: dict) -> int | None:
    return int(headers["X-Page-ID"]) if "X-Page-ID" in headers else None


def _packed(members, name: str, most: int):
    """Members to archives of at least ``most`` bytes, but the last."""
    held, size, number = [], 0, 0
    for member in members:
        held.append(member)
        size += len(member)
        if size >= most:
            yield f"{name}-{number:05d}.warc.gz", b"".join(held)
            held, size, number = [], 0, number + 1
    if held:
        yield f"{name}-{number:05d}.warc.gz", b"".join(held)


def _schema():
    import pyarrow as pa

    return pa.schema([("archive", pa.string()), ("data", pa.binary())])


def _name(kind: str) -> str:
    from pyspark import TaskContext

    return f"{kind}-{TaskContext.get().partitionId():06d}"


def _uri(page_id, url: str | None) -> str:
    """The url with blanks, control and other signs that no URI may hold percent-encoded."""
    return quote(url, safe="%/:?#[]@!$&'()*+,;=-._~", errors="replace") if url and url.strip() else f"urn:page:{page_id}"


def write_archives(pages: DataFrame, id_column: str = "page_id", url_column: str = "url", html_column: str = "html", most: int = ARCHIVE) -> DataFrame:
    """A response record for each row, as archives (archive, data)."""
    def run(stream):
        def members():
            for batch in stream:
                for page_id, url, html in zip(*(batch.column(i) for i in range(3))):
                    payload = (html.as_py() or "").encode()
                    yield record(page_id.as_py(), _uri(page_id, url.as_py()), "response", hashlib.sha1(payload).hexdigest(), len(payload), payload)

        yield from batches(_packed(members(), _name("crawl"), most), _schema(), 1)

    return named(pages, page_id=id_column, url=url_column, html=html_column).mapInArrow(run, ARCHIVES)


def store_archives(archives: DataFrame, buckets: int | None = None) -> DataFrame:
    """Write archives to the shared folder in buckets by their name, and read them back a few at a time. Every task writes its own rows: no exchange."""
    spark = archives.sparkSession
    path, name = scratch_path(spark, "warc"), f"warc_{uuid.uuid4().hex}"
    n = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
    archives.write.bucketBy(n, "archive").option("path", path).option("compression", "uncompressed").saveAsTable(name)
    return small_batches(spark).table(name)


def read_headers(archives: DataFrame, check: bool = False) -> DataFrame:
    """The headers of every record. ``check`` hashes the payload read and raises if it is not the digest's."""
    def run(stream):
        import pyarrow as pa

        longs, text = pa.int64(), pa.string()
        schema = pa.schema([("archive", text), ("page_id", longs), ("uri", text), ("record_type", text), ("digest", text), ("length", longs), ("refers_to", longs)])

        def rows():
            for batch in stream:
                for name, data in zip(batch.column(0).to_pylist(), batch.column(1)):
                    for h, payload in records(data.as_py()):
                        digest, to, own = h["WARC-Payload-Digest"].split(":")[1], h.get("X-Refers-To-Page-ID"), h["WARC-Type"] == "response"
                        if check and own and (hashlib.sha1(payload).hexdigest() != digest or len(payload) != int(h["X-Payload-Length"])):
                            raise ValueError(f"payload of page {_page(h)} is damaged")
                        yield name, _page(h), h["WARC-Target-URI"], h["WARC-Type"], digest, int(h["X-Payload-Length"]), int(to) if to else None

        yield from batches(rows(), schema)

    return archives.select("archive", "data").mapInArrow(run, HEADERS)


def revisits(headers: DataFrame, least: int = LEAST) -> DataFrame:
    """(archive, page_id, digest, refers_to, refers_uri) of the records that are to be revisits."""
    big = headers.drop("refers_to").filter((F.col("length") >= least) | (F.col("record_type") == "revisit"))
    held = F.when((F.col("record_type") == "response") & F.col("page_id").isNotNull(), F.struct("page_id", "uri"))
    original = big.groupBy("digest", "length").agg(F.max(held).alias("o"), F.count(F.lit(1)).alias("n")).filter("o is not null and n > 1")
    original = materialize(original.select("digest", "length", F.col("o.page_id").alias("refers_to"), F.col("o.uri").alias("refers_uri"), "n"), "warc-originals")
    hot = hot_keys(original, ["digest", "length"])  # one payload may be that of many records
    met = salted(big, ["digest", "length"], hot, F.col("page_id")).join(for_salts(original, ["digest", "length"], hot), ["digest", "length", "salt"])
    return met.filter("page_id <> refers_to").select("archive", "page_id", "digest", "refers_to", "refers_uri")


def deduplicate(archives: DataFrame, least: int = LEAST, most: int = ARCHIVE) -> DataFrame:
    """Archives with fresh headers: copies become revisits. ``archives`` come from ``store_archives``.

    An archive meets its own list of revisits (at most one a record in it); other written tables are shuffled to
    their lists if these are long.
    """
    headers = materialize(read_headers(archives), "warc-headers")  # both sides of the join read it
    again = materialize(revisits(headers, least), "warc-again")
    lists = again.groupBy("archive").agg(F.collect_list(F.struct("page_id", "digest", "refers_to", "refers_uri")).alias("again"))
    # the lists are hashed, so that archives are not sorted either
    both = archives.join(F.broadcast(lists) if again.count() <= SMALL_LIST else lists.hint("shuffle_hash"), "archive", "left").select("archive", "data", "again")

    def run(stream):
        def members():
            for batch in stream:
                for i in range(batch.num_rows):
                    to = {(r["page_id"], r["digest"]): (r["refers_to"], r["refers_uri"]) for r in batch.column(2)[i].as_py() or []}
                    for h, payload in records(batch.column(1)[i].as_py()):
                        key = _page(h), h["WARC-Payload-Digest"].split(":")[1]
                        again = key in to or h["WARC-Type"] == "revisit"
                        yield record(key[0], h["WARC-Target-URI"], "revisit" if again else "response", key[1], int(h["X-Payload-Length"]), b"" if again else payload, *to.get(key, ()))

        yield from batches(_packed(members(), _name("dedup"), most), _schema(), 1)

    return both.mapInArrow(run, ARCHIVES)


def op9_warc_revisits(spark, sf_dir: str) -> DataFrame:
    """Archive all of ``pages``, resolve the revisits, read the new archives back."""
    crawl = store_archives(write_archives(table(spark, sf_dir, "pages")))
    final = materialize(deduplicate(crawl), "warc-final", compression="uncompressed")
    final = small_batches(spark).read.schema(ARCHIVES).parquet(final._scratch)
    return read_headers(final, check=True).select(
        "page_id", F.col("length").alias("payload_bytes"), F.col("digest").alias("payload_digest"), "record_type", "refers_to"
    )


QUERIES = {"op9_warc_revisits": op9_warc_revisits}
ORACLE = {
    "op9_warc_revisits": """
        WITH p AS (SELECT page_id, coalesce(html, '') AS h FROM pages),
        q AS (SELECT page_id, strlen(h) AS n, sha1(h) AS d, max(page_id) OVER (PARTITION BY h) AS last FROM p)
        SELECT page_id, n AS payload_bytes, d AS payload_digest,
               CASE WHEN n >= 1000 AND page_id < last THEN 'revisit' ELSE 'response' END AS record_type,
               CASE WHEN n >= 1000 AND page_id < last THEN last END AS refers_to
        FROM q""",
}
