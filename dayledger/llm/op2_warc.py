"""WARC archives and their capture index: an external index merge.

Writing: every capture becomes one WARC 1.1 record. Of captures with equal
payloads (of at least ``min_bytes`` bytes) the one of the largest id is the
``response``, the others are ``revisit`` records that refer to it. Archives are
gzip files in the shared folder; a record ends with the two line ends that the
format asks for, which Spark's text writer puts there as its line separator.

Reading: each archive is unpacked as a stream, its records are parsed by their
lengths, payload digests are verified, and its captures are sorted by (URL key,
timestamp, id): a locally sorted run, written to the shared folder. The merge
deals the runs out by ranges of that key; a task puts its pieces of the k runs
through a loser tree, so all tasks together give one globally ordered history.

Equal payloads are found by their SHA-256 on rows without the payload, with
partial aggregation first; a payload shared by a third of all captures is one
row a task there. No key is unbounded afterwards: the payloads are dealt by
(id, digest), the index by a range key that ends with the id.

Defined cases: a null payload is empty; a null URL sorts as an empty key and is
written without a target; line ends in a URL are percent-encoded; a row without
an id is a ``response`` of its own and never referred to; of repeated ids with
one payload every row of the largest id is a ``response``. Other columns are
ignored.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import io
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from dayledger.llm.common import new_path, table, written

#: Fixed values of the WARC format and of RFC 4648.
REVISIT = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
BASE32_HEX, BASE32 = "0123456789ABCDEFGHIJKLMNOPQRSTUV", "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"
EOL = "\r\n"
ENTRY = pa.schema([
    ("run", pa.string()), ("seq", pa.int64()), ("offset", pa.int64()), ("urlkey", pa.string()),
    ("captured", pa.string()), ("page_id", pa.int64()), ("record_type", pa.string()),
    ("refers_to", pa.int64()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string())])
ENTRY_DDL = ("run string, seq long, offset long, urlkey string, captured string, page_id long, "
             "record_type string, refers_to long, payload_bytes long, payload_digest string")


def base32_sha1(payload: Column) -> Column:
    """Bare upper-case base32 of the SHA-1: forty bits (ten hex digits) at a time."""
    digest = F.sha1(F.encode(payload, "UTF-8"))
    parts = [F.lpad(F.conv(F.substring(digest, at, 10), 16, 32), 8, "0") for at in (1, 11, 21, 31)]
    return F.translate(F.concat(*parts), BASE32_HEX, BASE32)


def captures(pages: DataFrame) -> DataFrame:
    """Capture rows of a page table: it has no capture times, so each page gets
    the second after a fixed day that its id counts."""
    return pages.select(
        F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"),
        F.coalesce(F.col("html").cast("string"), F.lit("")).alias("payload"),
        F.date_format(F.timestamp_seconds(F.lit(1704067200) + F.coalesce(F.pmod("page_id", F.lit(31536000)), F.lit(0))),
                      "yyyy-MM-dd'T'HH:mm:ss'Z'").alias("captured"))


def with_decisions(rows: DataFrame, min_bytes: int, parts: int) -> DataFrame:
    """``rows`` with digest, and refers_to where the record is a revisit, dealt
    to ``parts`` partitions by (id, payload): the payloads move once, the join
    finds them in place."""
    full = rows.withColumn("digest", base32_sha1(F.col("payload"))).withColumn(
        "same", F.unhex(F.sha2(F.encode(F.col("payload"), "UTF-8"), 256)))
    known = full.where((F.octet_length("payload") >= min_bytes) & F.col("page_id").isNotNull()).select("same", "page_id")
    first = known.groupBy("same").agg(F.max("page_id").alias("refers_to"))
    revisits = (known.distinct().join(first, "same").where(F.col("page_id") < F.col("refers_to"))
                .select("page_id", "same", "refers_to"))
    return full.repartition(parts, "page_id", "same").join(revisits, ["page_id", "same"], "left").drop("same")


def record() -> Column:
    """One whole WARC record but for its closing line ends."""
    line = lambda name, value: F.concat(F.lit(f"{name}: "), value, F.lit(EOL))
    urn = lambda c: F.concat(F.lit("<urn:capture:"), F.coalesce(c.cast("string"), F.lit("none")), F.lit(">"))
    revisit = F.col("refers_to").isNotNull()
    url = F.regexp_replace(F.regexp_replace(F.col("url"), "\r", "%0D"), "\n", "%0A")
    http = F.concat(F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: "),
                    F.octet_length("payload").cast("string"), F.lit(EOL * 2))
    block = F.when(revisit, http).otherwise(F.concat(http, F.col("payload")))
    return F.concat(
        F.lit("WARC/1.1" + EOL),
        line("WARC-Type", F.when(revisit, "revisit").otherwise("response")),
        line("WARC-Record-ID", urn(F.col("page_id"))),
        line("WARC-Date", F.col("captured")),
        F.coalesce(line("WARC-Target-URI", url), F.lit("")),
        line("WARC-Payload-Digest", F.concat(F.lit("sha1:"), F.col("digest"))),
        F.when(revisit, F.concat(line("WARC-Profile", F.lit(REVISIT)),
                                 line("WARC-Refers-To", urn(F.col("refers_to"))))).otherwise(""),
        line("Content-Type", F.lit("application/http; msgtype=response")),
        line("Content-Length", F.octet_length(block).cast("string")),
        F.lit(EOL), block)


def write_archives(rows: DataFrame, path: str, min_bytes: int = 0, archive_bytes: int = 64 << 20) -> None:
    """Write capture rows (page_id, url, payload, captured) as gzip WARC files of
    about ``archive_bytes`` unpacked bytes."""
    spark = rows.sparkSession
    total = rows.agg(F.sum(F.octet_length("payload") + 600)).first()[0] or 0
    files = max(spark.sparkContext.defaultParallelism, -(-total // archive_bytes))
    decided = with_decisions(rows, min_bytes, files)
    (decided.select(record().alias("record"))
     .write.option("compression", "gzip").option("lineSep", EOL * 2).text(path))


def url_key(url: str | None) -> str:
    """Sort-friendly key: host labels reversed, scheme, www., port and fragment gone."""
    if not url:
        return ""
    rest = url.split("://", 1)[-1].split("#", 1)[0]
    host, slash, path = rest.partition("/")
    host = host.rpartition("@")[2].lower().split(":", 1)[0].removeprefix("www.")
    return ",".join(reversed(host.split("."))) + ")/" + path


def records(archive: bytes) -> Iterator[tuple[int, dict[str, str], bytes]]:
    """Offset (in the unpacked archive), headers and block of each record."""
    with gzip.GzipFile(fileobj=io.BytesIO(archive)) as f:
        while True:
            at = f.tell()
            line = f.readline()
            if not line:
                return
            if line.strip() == b"":
                continue
            if not line.startswith(b"WARC/"):
                raise ValueError(f"no WARC record at offset {at}: {line[:40]!r}")
            headers = {}
            while (line := f.readline()).strip():
                name, _, value = line.decode("utf-8").partition(":")
                headers[name.strip().lower()] = value.strip()
            block = f.read(int(headers["content-length"]))
            if len(block) != int(headers["content-length"]):
                raise ValueError(f"record at offset {at} is cut short")
            yield at, headers, block


def _id(urn: str | None) -> int | None:
    value = (urn or "").removeprefix("<urn:capture:").removesuffix(">")
    return None if value in ("", "none") else int(value)


def _runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Archives to their captures, each archive's in the order of the index key."""
    for batch in batches:
        for path, content in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
            run, found = path.rsplit("/", 1)[-1], []
            for at, head, block in records(content.as_buffer().to_pybytes()):
                payload = block.partition(b"\r\n\r\n")[2]
                digest = head["warc-payload-digest"].removeprefix("sha1:")
                size = None
                if head["warc-type"] == "response":
                    size = len(payload)
                    if base64.b32encode(hashlib.sha1(payload).digest()).decode() != digest:
                        raise ValueError(f"{run}, offset {at}: the payload's digest is wrong")
                found.append((url_key(head.get("warc-target-uri")), head["warc-date"], _id(head["warc-record-id"]),
                              at, head["warc-type"], _id(head.get("warc-refers-to")), size, digest))
            found.sort(key=lambda x: (x[0], x[1], -1 if x[2] is None else x[2], x[3]))
            for lo in range(0, len(found), 20_000):
                key, when, page, at, kind, refers, size, digest = zip(*found[lo:lo + 20_000], strict=True)
                n = len(key)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(x, type=t.type) for x, t in
                     zip(([run] * n, range(lo, lo + n), at, key, when, page, kind, refers, size, digest), ENTRY, strict=True)],
                    schema=ENTRY)


def loser_tree(runs: list[list]) -> Iterator[tuple[int, int]]:
    """Merge sorted lists: (run, position) in ascending order of the keys. Each
    inner node keeps the loser of its match, so a step replays one path."""
    k = 1
    while k < max(1, len(runs)):
        k *= 2
    pos = [0] * k
    done = object()
    head = [r[0] if r else done for r in runs] + [done] * (k - len(runs))

    def beats(a: int, b: int) -> bool:
        if head[a] is done or head[b] is done:
            return head[b] is done and (head[a] is not done or a < b)
        return head[a] < head[b] or (head[a] == head[b] and a < b)

    loser = [0] * k
    winner = [0] * k + list(range(k))
    for node in range(k - 1, 0, -1):
        a, b = winner[2 * node], winner[2 * node + 1]
        winner[node], loser[node] = (a, b) if beats(a, b) else (b, a)
    best = winner[1] if k > 1 else 0
    while head[best] is not done:
        yield best, pos[best]
        pos[best] += 1
        head[best] = runs[best][pos[best]] if pos[best] < len(runs[best]) else done
        node = (best + k) // 2
        while node >= 1:
            if beats(loser[node], best):
                loser[node], best = best, loser[node]
            node //= 2


def _merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One key range: its rows come by run and position; out in key order."""
    held = pa.Table.from_batches(list(batches), schema=ENTRY)
    if not held.num_rows:
        return
    names = held.column("run").to_pylist()
    keys = list(zip(held.column("urlkey").to_pylist(), held.column("captured").to_pylist(),
                    [-1 if x is None else x for x in held.column("page_id").to_pylist()], strict=True))
    cuts = [i for i in range(len(names)) if i == 0 or names[i] != names[i - 1]] + [len(names)]
    order = [cuts[run] + at for run, at in loser_tree([keys[a:b] for a, b in zip(cuts, cuts[1:], strict=False)])]
    yield from held.take(pa.array(order)).combine_chunks().to_batches(max_chunksize=20_000)


def read_runs(spark: SparkSession, path: str) -> DataFrame:
    """The archives' captures as sorted runs, written to the shared folder."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.gz").load(path).select("path", "content")
    return written(files.mapInArrow(_runs, ENTRY_DDL), "capture-runs")


def merged_index(runs: DataFrame, rows_per_task: int = 200_000) -> DataFrame:
    """The runs as one globally ordered capture history (partition by partition)."""
    tasks = max(1, -(-runs.count() // rows_per_task))
    return (runs.repartitionByRange(tasks, "urlkey", "captured", F.coalesce("page_id", F.lit(-1)))
            .sortWithinPartitions("run", "seq").mapInArrow(_merge, ENTRY_DDL))


def resolved(index: DataFrame) -> DataFrame:
    """The index with each revisit's payload length, taken from the response
    record that it refers to."""
    index = written(index, "capture-index")
    sizes = (index.where("record_type = 'response' and page_id is not null")
             .groupBy(F.col("page_id").alias("refers_to"), "payload_digest").agg(F.max("payload_bytes").alias("full_bytes")))
    plain = index.where("refers_to is null")
    follow = (index.where("refers_to is not null").join(sizes, ["refers_to", "payload_digest"])
              .withColumn("payload_bytes", F.col("full_bytes")).select(*index.columns))
    return plain.unionByName(follow)


def op2_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Write an archive record per page, read the archives back, merge their index."""
    path = new_path(spark, "archives")
    write_archives(captures(table(spark, sf_dir, "pages", "page_id", "url", "html")), path)
    index = resolved(merged_index(read_runs(spark, path)))
    return index.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to",
                        "urlkey", "captured")


SQL = r"""
WITH p AS (SELECT page_id, url, coalesce(html, '') AS t FROM pages),
h AS (SELECT page_id, url, t, sha1(t) AS d, sha256(t) AS s FROM p),
m AS (SELECT *, max(page_id) OVER (PARTITION BY s) AS top FROM h),
u AS (SELECT *, split_part(regexp_replace(url, '^[^:]*://', ''), '#', 1) AS rest FROM m)
SELECT page_id, CAST(octet_length(encode(t)) AS BIGINT) AS payload_bytes,
  array_to_string(list_transform(range(0, 32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
    CAST(((CAST(('0x' || substr(d, CAST(i // 8 * 10 + 1 AS INTEGER), 10)) AS BIGINT) >> CAST(35 - 5 * (i % 8) AS INTEGER)) & 31) AS INTEGER) + 1, 1)), '')
    AS payload_digest,
  CASE WHEN page_id < top THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN page_id < top THEN top END AS refers_to,
  array_to_string(list_reverse(string_split(regexp_replace(split_part(lower(split_part(rest, '/', 1)), ':', 1), '^www\.', ''), '.')), ',')
    || ')/' || CASE WHEN contains(rest, '/') THEN substr(rest, strpos(rest, '/') + 1) ELSE '' END AS urlkey,
  strftime(TIMESTAMP '2024-01-01' + to_seconds(page_id % 31536000), '%Y-%m-%dT%H:%M:%SZ') AS captured
FROM u
"""
