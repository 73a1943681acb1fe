"""WARC archives of pages with a two-level capture index.

Writing: each task writes the records of the pages it reads to archives of its own, one compressed member per record, in
the shared folder. A task that is run again writes files of another name, and only the rows that Spark commits say which
count. Of pages with equal payloads one is a response and the others revisit it.

Index: one line per capture, sorted by the URL with its host reversed, so that a host's subdomains lie together. Lines
are packed into compressed blocks, and a sparse directory keeps each block's first key and place in its file. A lookup
searches the bounds of the index files, then a file's directory, by bisection; it reads the blocks that can have the key
and then the records' own ranges. Nothing is ever read whole but a file's directory.

Archives and index files are reached through Arrow's file systems, so the folder can be on any that Arrow knows.
"""

from __future__ import annotations

import base64
import hashlib
import json
import uuid
import zlib
from bisect import bisect_left, bisect_right
from collections.abc import Iterator
from functools import lru_cache
from urllib.parse import quote

import pandas as pd
from pyarrow import fs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyspark.operators.joins import per_key
from tallyspark.sources.staging import staged, staging_path

# Bytes after which a task begins another archive, and lines of an index block.
ARCHIVE = 256 << 20
BLOCK = 2000
# Index files of few captures at most, and captures of one file from which on there are more files; their bounds are what
# the driver and each task hold, about 200 bytes for each file.
INDEX_FILES = 512
FILE_CAPTURES = 1 << 21
MIN_PAYLOAD = 0
# Names and media types of the format.
VERSION = "WARC/1.1"
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
_DATE = "2024-01-01T00:00:00Z"
_SPACE = uuid.UUID("6ba7b811-9dad-11d1-80b4-00c04fd430c8")
CAPTURE = "key string, page_id long, file string, offset long, length long"
RECORD = "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long"
# Characters of a URI that stay as they are; all others are percent-encoded.
_URI = "!#$%&'()*+,/:;=?@[]~"


def digest(payload: bytes) -> str:
    """Bare upper-case base32 of the SHA-1."""
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def url_key(url: str | None) -> str:
    """The sort key of a URL: its host's labels in reverse, then what follows the host; a NULL or odd URL as it stands."""
    scheme, mark, rest = (url or "").partition("://")
    if not mark:
        return url or ""
    end = min((k for k in map(rest.find, "/?#") if k >= 0), default=len(rest))
    host, _, port = rest[:end].lower().partition(":")
    return ",".join(reversed(host.split("."))) + (f":{port}" if port else "") + ")" + rest[end:]


def _record_id(page_id: int | None, sha: str, place: str) -> str:
    """Of a response named by page and digest, so that revisits can name it; of any other by its place."""
    return uuid.uuid5(_SPACE, f"{page_id}/{sha}/{place}").urn


def record(url: str | None, page_id: int | None, payload: bytes, sha: str, refers_to: int | None, revisit: bool, place: str) -> bytes:
    """One record. The page's id and that of the page it revisits are headers of their own beside the standard ones."""
    headers = {
        "WARC-Type": "revisit" if revisit else "response",
        "WARC-Record-ID": f"<{_record_id(page_id, sha, place if revisit else '')}>",
        "WARC-Date": _DATE,
        "WARC-Target-URI": quote(url or "", safe=_URI),
        "WARC-Payload-Digest": f"sha1:{sha}",
        "WARC-Payload-Length": str(len(payload)),
    }
    if page_id is not None:
        headers["WARC-Page-ID"] = str(page_id)
    if revisit:
        headers["WARC-Profile"] = REVISIT_PROFILE
        headers["WARC-Refers-To"] = f"<{_record_id(refers_to, sha, '')}>"
        headers["WARC-Refers-To-Page-ID"] = str(refers_to)
    body = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n\r\n" + (b"" if revisit else payload)
    headers |= {"Content-Type": "application/http; msgtype=response", "Content-Length": str(len(body))}
    head = "\r\n".join([VERSION, *(f"{k}: {v}" for k, v in headers.items())])
    return head.encode() + b"\r\n\r\n" + body + b"\r\n\r\n"


def parse(member: bytes) -> tuple[dict[str, str], bytes]:
    """Headers and payload of one compressed record."""
    data = zlib.decompress(member, 31)
    head, _, rest = data.partition(b"\r\n\r\n")
    version, *lines = head.decode().split("\r\n")
    if version != VERSION:
        raise ValueError(f"not a record: {version[:40]}")
    headers = dict(line.split(": ", 1) for line in lines)
    return headers, rest[: int(headers["Content-Length"])].partition(b"\r\n\r\n")[2]


def _gzip(data: bytes) -> bytes:
    packer = zlib.compressobj(6, zlib.DEFLATED, 31)
    return packer.compress(data) + packer.flush()


def qualified(spark: SparkSession, folder: str) -> str:
    """The folder with the file system that Spark takes it on, which tasks then don't have to guess."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
    whole = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).makeQualified(path).toString()
    # Arrow wants an empty host to be written out.
    return whole if "://" in whole else whole.replace(":/", ":///", 1)


@lru_cache(8)
def _system(folder: str) -> tuple[fs.FileSystem, str]:
    return fs.FileSystem.from_uri(folder)


class _Writer:
    """Files of one task, each begun when the one before is full."""

    def __init__(self, folder: str, suffix: str, limit: int) -> None:
        self._files, self._root = _system(folder)
        self._files.create_dir(self._root, recursive=True)
        self._suffix, self._limit, self._out, self.name, self.at = suffix, limit, None, "", 0

    def put(self, data: bytes) -> tuple[str, int, int]:
        if self._out is None or self.at >= self._limit:
            self.close()
            self.name, self.at = uuid.uuid4().hex + self._suffix, 0
            self._out = self._files.open_output_stream(f"{self._root}/{self.name}", compression=None)
        at, self.at = self.at, self.at + len(data)
        self._out.write(data)
        return self.name, at, len(data)

    def close(self) -> None:
        if self._out is not None:
            self._out.close()
        self._out = None


def _ranges(folder: str, name: str, wanted: list[tuple[int, int]]) -> Iterator[bytes]:
    """The bytes of each ``(offset, length)`` of one file."""
    files, root = _system(folder)
    with files.open_input_file(f"{root}/{name}") as file:
        for offset, length in wanted:
            yield file.read_at(length, offset)


def write_archives(pages: DataFrame, folder: str, min_payload: int = MIN_PAYLOAD, archive: int = ARCHIVE) -> DataFrame:
    """Writes a record for each row of ``page_id, url, html`` to archives in ``folder``, a ``qualified`` one; returns the captures, stored.

    Of rows with equal payloads of at least ``min_payload`` bytes those with the smallest ``page_id`` are responses and
    the others revisit it; if all of them have a NULL id, all are responses. Shorter payloads are all responses.
    """
    payload = F.coalesce(F.col("html"), F.lit("")).cast("binary")
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), "url", payload.alias("payload"))
    rows = rows.withColumn("sha", F.unhex(F.sha1("payload")))
    # Shas that occur once need no partner, so the small side has repeated ones only.
    firsts = per_key(rows, ["sha"], F.min("page_id").alias("first_id"), F.count(F.lit(1)).alias("n")).filter("n > 1").drop("n")
    rows = rows.join(firsts, "sha", "left")
    revisit = (F.length("payload") >= min_payload) & F.col("first_id").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("first_id"))
    rows = rows.select(F.col("page_id").cast("string").alias("page_id"), "url", "payload", F.col("first_id").cast("string").alias("first_id"), revisit.alias("revisit"))

    def write(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        writer = _Writer(folder, ".warc.gz", archive)
        whole = lambda x: None if x is None else int(x)
        for batch in batches:
            out = []
            for row in batch.itertuples():
                page_id, first_id = whole(row.page_id), whole(row.first_id)
                sha, place = digest(row.payload), f"{writer.name}/{writer.at}"
                data = _gzip(record(row.url, page_id, row.payload, sha, first_id, row.revisit, place))
                out.append((url_key(row.url), page_id, *writer.put(data)))
            found = pd.DataFrame(out, columns=["key", "page_id", "file", "offset", "length"])
            yield found.assign(page_id=found["page_id"].astype("Int64"))
        writer.close()

    return staged(rows.mapInPandas(write, CAPTURE), "warc_captures")


def write_index(
    captures: DataFrame, folder: str, block: int = BLOCK, files: int = INDEX_FILES, file_captures: int = FILE_CAPTURES
) -> DataFrame:
    """Packs the captures, sorted by key, into index files with a directory each; returns the files' bounds, stored.

    Captures of one key may fill many blocks and several files: lines are spread by key, archive and offset. There are as
    many files as keep one to about ``file_captures``, and with fewer captures one for each task, up to ``files``.
    """
    partitions = int(captures.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    order = ["key", "file", "offset"]
    n = max(min(files, partitions), -(-captures.count() // file_captures))
    lines = captures.repartitionByRange(n, *order).sortWithinPartitions(*order)
    lines = lines.select("key", F.to_json(F.struct("key", "page_id", "file", "offset", "length")).alias("line"))

    def write(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        writer = _Writer(folder, ".cdx.gz", 1 << 62)
        directory, waiting, last = [], [], ""

        def close() -> None:
            name, offset, length = writer.put(_gzip("\n".join(line for _, line in waiting).encode()))
            directory.append([waiting[0][0], offset, length])
            waiting.clear()

        for batch in batches:
            for key, line in zip(batch["key"], batch["line"]):
                waiting.append((key, line))
                last = key
                if len(waiting) == block:
                    close()
        if waiting:
            close()
        if directory:
            name, offset, length = writer.put(_gzip(json.dumps(directory).encode()))
            yield pd.DataFrame([(name, directory[0][0], last, offset, length)], columns=["file", "first", "last", "offset", "length"])
        writer.close()

    return staged(lines.mapInPandas(write, "file string, first string, last string, offset long, length long"), "warc_index")


def lookup(keys: DataFrame, index: DataFrame, folder: str) -> DataFrame:
    """The captures of each key in the column ``key``, by bisection over files and blocks; unknown keys have none.

    The bounds of the index files, one for each of ``FILE_CAPTURES`` captures, go to every task. A key's blocks are dealt out one by one, so one
    with very many captures is read by many tasks.
    """
    # Code points sort like the bytes of UTF-8, so Python's order is Spark's.
    bounds = sorted((r["first"], r["last"], r["file"], r["offset"], r["length"]) for r in index.collect())
    firsts, lasts = [b[0] for b in bounds], [b[1] for b in bounds]

    def blocks(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        directories: dict[str, tuple[list[str], list]] = {}
        for batch in batches:
            out = []
            for key in batch["key"]:
                for k in range(bisect_left(lasts, key), bisect_right(firsts, key)):
                    _, _, name, offset, length = bounds[k]
                    if name not in directories:
                        entries = json.loads(zlib.decompress(next(_ranges(folder, name, [(offset, length)])), 31))
                        directories[name] = [e[0] for e in entries], entries
                    heads, entries = directories[name]
                    for _, at, n in entries[max(0, bisect_left(heads, key) - 1) : bisect_right(heads, key)]:
                        out.append((key, name, at, n))
            yield pd.DataFrame(out, columns=["key", "file", "offset", "length"])

    def scan(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for (name, at, n), group in batch.groupby(["file", "offset", "length"]):
                wanted = set(group["key"])
                lines = zlib.decompress(next(_ranges(folder, name, [(at, n)])), 31).decode().split("\n")
                found = [x for x in map(json.loads, lines) if x["key"] in wanted]
                rows = [(x["key"], x.get("page_id"), x["file"], x["offset"], x["length"]) for x in found]
                frame = pd.DataFrame(rows, columns=["key", "page_id", "file", "offset", "length"])
                yield frame.assign(page_id=frame["page_id"].astype("Int64"))

    distinct = keys.select("key").dropna().distinct().sortWithinPartitions("key")
    asked = distinct.mapInPandas(blocks, "key string, file string, offset long, length long")
    # Sorted, so that the keys of a block come in a row; a block cut by a batch is read once more.
    dealt = asked.repartition("file", "offset").sortWithinPartitions("file", "offset")
    return dealt.mapInPandas(scan, CAPTURE)


def read_records(captures: DataFrame, folder: str) -> DataFrame:
    """``RECORD`` of each capture from its range of its archive.

    Size and digest of a response are those of the payload that was read, and an error if the record names others; a
    revisit has no payload and gives what it names.
    """

    def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = []
            for name, group in batch.groupby("file"):
                group = group.sort_values("offset")
                wanted = list(zip(group["offset"].tolist(), group["length"].tolist()))
                for (offset, _), member in zip(wanted, _ranges(folder, name, wanted)):
                    headers, payload = parse(member)
                    named = int(headers["WARC-Payload-Length"]), headers["WARC-Payload-Digest"].removeprefix("sha1:")
                    kind = headers["WARC-Type"]
                    found = named if kind == "revisit" else (len(payload), digest(payload))
                    if found != named:
                        raise ValueError(f"damaged record at {offset} of {name}: {found} instead of {named}")
                    ids = [None if (x := headers.get(h)) is None else int(x) for h in ("WARC-Page-ID", "WARC-Refers-To-Page-ID")]
                    out.append((ids[0], *found, kind, ids[1]))
            frame = pd.DataFrame(out, columns=[c.split()[0] for c in RECORD.split(", ")])
            yield frame.assign(page_id=frame["page_id"].astype("Int64"), refers_to=frame["refers_to"].astype("Int64"))

    spread = captures.repartition(F.col("file"), F.floor(F.col("offset") / (1 << 20))).sortWithinPartitions("file", "offset")
    return spread.mapInPandas(read, RECORD)


def archive_folder(spark: SparkSession) -> str:
    """A new folder for archives in the shared folder."""
    return qualified(spark, staging_path(spark, "warc"))


def round_trip(pages: DataFrame, folder: str | None = None) -> DataFrame:
    """Writes all pages, indexes them, looks every URL up and reads what the index points at: ``RECORD`` per page.

    NULL pages have an empty payload; a NULL URL is found under the empty key. Repeated rows have a record each, and
    those with the smallest id are all responses. An empty table gives no row; other columns are not looked at.
    """
    folder = qualified(pages.sparkSession, folder) if folder else archive_folder(pages.sparkSession)
    captures = write_archives(pages, folder)
    index = write_index(captures, folder)
    return read_records(lookup(captures.select("key"), index, folder), folder)


def sort_key(url: Column) -> Column:
    """``url_key`` of a column, for lookups of URLs."""

    @F.pandas_udf("string")
    def keyed(urls: pd.Series) -> pd.Series:
        return urls.map(url_key)

    return keyed(url)
