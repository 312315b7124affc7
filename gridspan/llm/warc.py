"""Web archives: pages written as WARC records, read back, and indexed in global order.

Writing. One record per page, each a gzip member of its own, so that it can be read from its
place in the file alone. Tasks compress the records and Spark's text sink writes them as its
lines; the line separator is an empty gzip member, which leaves the file a whole archive. Of
pages with equal payloads of at least 1000 bytes the one with the largest id is archived as
response; the others are revisits, which keep the HTTP header only. So equal payloads are
found by digest, never by gathering pages.

Reading. Files are cut at the separators, by several tasks each; a record says at which byte
of its file it stands. Payloads are held against their digest. `fetch` reads the captures of
some index rows again, out of their files only.

Index. Each reading task leaves one run of captures sorted by URL key and timestamp, stored
in blocks. Blocks are cut at the borders of key ranges (a URL with many captures falls into
many ranges, as time, id and place in the archive belong to the key). A range's task gets the blocks of all runs in
order of their first keys and merges them with a loser tree: whatever comes before the next
block's first key can go out, so it holds no more than a block or two of each run. Ranges in
order give the capture history of all URLs; a capture's position in it is its place plus the
sizes of the earlier ranges.

A missing payload is an empty one and a missing url an empty one. Pages that repeat the
largest id of their group are all responses. A page without an id is a revisit of its
group's largest id, or a response if its group has none; its reference stays empty. Line
breaks in a url are escaped. Only page_id, url and html of the input are read.
"""

from __future__ import annotations

import hashlib
import re
import zlib
from bisect import bisect_left
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from gridspan.llm.frames import sized
from gridspan.session import materialize, scratch

LEAST_SHARED = 1000
#: Digests sent to all tasks, some 100 bytes each; more are joined by a shuffle.
BROADCAST_DIGESTS = 50_000
#: Captures of a block of a sorted run, and of a batch that goes out.
BLOCK, BATCH = 128, 10_000
#: Captures of a key range, which one task merges, and keys drawn for each range's border.
RANGE_ROWS, DRAWN = 100_000, 20
#: Bytes of compressed records that a task holds at a time.
HELD_BYTES = 1 << 24
#: Fixed value: an empty gzip member.
EMPTY = bytes([0x1F, 0x8B, 8, 0, 0, 0, 0, 0, 0, 3, 3, 0, 0, 0, 0, 0, 0, 0, 0, 0])
#: How the text sink and source are told of it.
_LINES = {"lineSep": EMPTY.decode("latin-1"), "encoding": "ISO-8859-1"}
_GZIP = 31

_MARK, _BREAK, _PLACE = "WARC/1.0\r\n", "\r\n\r\n", "WARC-File-Offset"
_URN = "urn:page:"


def url_key(url: str) -> str:
    """The host's labels reversed, then path and query; without scheme, www, port and fragment."""
    rest = re.sub(r"^[A-Za-z][A-Za-z0-9+.-]*://", "", url).split("#", 1)[0]
    host, path = re.match(r"([^/?]*)(.*)", rest, re.S).groups()
    host = re.sub(r"^www\.", "", re.sub(r":\d*$", "", host).lower())
    return ",".join(reversed(host.split("."))) + ")" + path


def _capture_time() -> Column:
    """A time of capture that follows from the page's id, as the table has none."""
    seconds = "cast(pmod(coalesce(page_id, 0), 100000000) as int)"
    at = F.expr(f"timestampadd(SECOND, {seconds}, timestamp_ntz'2024-01-01 00:00:00')")
    return F.date_format(at, "yyyy-MM-dd'T'HH:mm:ss'Z'")


def typed(pages: DataFrame) -> DataFrame:
    """Pages with payload, digest, record type and reference."""
    own = pages.select("page_id", F.coalesce("url", F.lit("")).alias("url"),
                       F.coalesce("html", F.lit("")).alias("payload"))
    own = own.withColumn("payload_bytes", F.octet_length("payload").cast("bigint"))
    own = own.withColumn("digest", F.sha1("payload"))
    shared = (
        own.filter(F.col("payload_bytes") >= LEAST_SHARED).groupBy("digest")
        .agg(F.count(F.lit(1)).alias("n"), F.max("page_id").alias("original"))
        .filter("n > 1").drop("n")
    )
    shared = materialize(shared, "shared-payloads")
    own = own.join(sized(shared, BROADCAST_DIGESTS), "digest", "left")
    revisit = F.col("original").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("original"))
    return own.withColumn("refers_to", F.when(revisit, F.col("original"))).withColumn(
        "record_type", F.when(revisit, "revisit").otherwise("response")
    )


def _record() -> Column:
    def line(name: str, *value: str | Column) -> Column:
        parts = [F.lit(v) if isinstance(v, str) else v for v in value]
        return F.concat(F.lit(name + ": "), *parts, F.lit("\r\n"))

    def urn(column: str) -> Column:
        return F.concat(F.lit(f"<{_URN}"), F.coalesce(F.col(column).cast("string"), F.lit("")), F.lit(">"))

    url = F.regexp_replace(F.regexp_replace("url", "\r", "%0D"), "\n", "%0A")
    http = F.concat(
        F.lit("HTTP/1.1 200 OK\r\n"), line("Content-Type", "text/html; charset=utf-8"),
        line("Content-Length", F.col("payload_bytes").cast("string")), F.lit("\r\n"),
    )
    revisit = F.col("record_type") == "revisit"
    block = F.concat(http, F.when(revisit, "").otherwise(F.col("payload")))
    return F.concat(
        F.lit(_MARK), line("WARC-Type", F.col("record_type")), line("WARC-Record-ID", urn("page_id")),
        line("WARC-Date", _capture_time()), line("WARC-Target-URI", url),
        line("WARC-Payload-Digest", "sha1:", F.col("digest")),
        F.when(revisit, line("WARC-Refers-To", urn("refers_to"))).otherwise(""),
        line("Content-Type", "application/http; msgtype=response"),
        line("Content-Length", F.octet_length(block).cast("string")), F.lit("\r\n"), block,
    )


def _members(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Each record with its place in the file that the task writes, compressed."""
    at = 0
    for batch in batches:
        held, size = [], 0
        for record in batch.column(0).cast(pa.binary()).to_pylist():
            place = f"{_MARK}{_PLACE}: {at}\r\n".encode()
            packer = zlib.compressobj(1, zlib.DEFLATED, _GZIP)
            held.append(packer.compress(place + record[len(_MARK) :]) + packer.flush())
            at += len(held[-1]) + len(EMPTY)
            size += len(held[-1])
            if size > HELD_BYTES:
                yield pa.RecordBatch.from_arrays([pa.array(held, pa.binary())], ["member"])
                held, size = [], 0
        yield pa.RecordBatch.from_arrays([pa.array(held, pa.binary())], ["member"])


def write(pages: DataFrame, path: str) -> str:
    """Writes the pages' archives into a new folder."""
    members = typed(pages).select(_record().alias("record")).mapInArrow(_members, "member binary")
    members.select(F.col("member").cast("string").alias("value")).write.options(**_LINES).text(path)
    return path


def _page(urn: str | None) -> int | None:
    number = (urn or "").strip("<>").removeprefix(_URN)
    return int(number) if number else None


def _headers(text: str) -> dict[str, str]:
    return dict(x.split(": ", 1) for x in text.split("\r\n") if ": " in x)


def _capture(head: bytes, block: bytes, compressed: int, file: str) -> tuple:
    """A record's row, payload last."""
    header = _headers(head.decode())
    http, _, payload = block.partition(_BREAK.encode())
    digest = header["WARC-Payload-Digest"].removeprefix("sha1:")
    kind = header["WARC-Type"]
    if kind == "response" and hashlib.sha1(payload).hexdigest() != digest:
        raise ValueError(f"payload of {header['WARC-Record-ID']} does not match its digest")
    return (
        _page(header["WARC-Record-ID"]), int(_headers(http.decode())["Content-Length"]), digest, kind,
        _page(header.get("WARC-Refers-To")), url_key(header["WARC-Target-URI"]),
        header["WARC-Date"], file, int(header[_PLACE]), compressed,
        payload if kind == "response" else None,
    )


def records(pieces: Iterator[tuple[bytes, str]]) -> Iterator[tuple[bytes, bytes, int, str]]:
    """(header, block, compressed size, file) of each record, out of compressed pieces."""
    held, of = b"", None
    for piece, file in pieces:
        # A separator inside a member, which is all but impossible, has cut it in two.
        held, of = (held + EMPTY + piece if held and of == file else piece), file
        unpacker = zlib.decompressobj(_GZIP)
        data = unpacker.decompress(held)
        if not unpacker.eof:
            continue
        head, _, block = data.partition(_BREAK.encode())
        size = int(re.search(rb"(?m)^Content-Length: (\d+)\r?$", head + b"\r")[1])
        if len(block) != size:
            raise ValueError("a record's block isn't as long as its header says")
        yield head, block, len(held), file
        held = b""
    if held:
        raise ValueError("an archive ends inside a record")


_COLUMNS = {
    "page_id": pa.int64(), "payload_bytes": pa.int64(), "payload_digest": pa.string(),
    "record_type": pa.string(), "refers_to": pa.int64(), "url_key": pa.string(),
    "captured": pa.string(), "file": pa.string(), "file_offset": pa.int64(),
    "compressed_bytes": pa.int64(), "payload": pa.binary(),
}
NAMES = list(_COLUMNS)[:-1]
_TYPES = {pa.int64(): "long", pa.string(): "string", pa.binary(): "binary"}


def _schema(names: list[str]) -> str:
    return ", ".join(f"{n} {_TYPES[_COLUMNS[n]]}" for n in names)


def _batch(rows: list[tuple], names: list[str]) -> pa.RecordBatch:
    columns = [pa.array([r[i] for r in rows], _COLUMNS[n]) for i, n in enumerate(names)]
    return pa.RecordBatch.from_arrays(columns, names)


def order(row: tuple) -> tuple:
    """URL key, time, id, and place, which tells repeated pages apart; a missing id comes first."""
    return row[5], row[6], row[0] is not None, row[0] or 0, row[7], row[8]


def _reader(names: list[str]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces = (
            piece for batch in batches
            for piece in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist())
        )
        held, size = [], 0
        for head, block, compressed, file in records(pieces):
            row = _capture(head, block, compressed, file)
            held.append(row[: len(names)])
            size += len(block) if "payload" in names else 0
            if len(held) >= BATCH or size > HELD_BYTES:
                yield _batch(held, names)
                held, size = [], 0
        yield _batch(held, names)

    return run


def _scanned(spark: SparkSession, paths: str | list[str], names: list[str]) -> DataFrame:
    pieces = spark.read.options(**_LINES).schema("value string").text(paths)
    pieces = pieces.select(F.col("value").cast("binary").alias("v"), F.col("_metadata.file_path").alias("f"))
    return pieces.mapInArrow(_reader(names), _schema(names))


def read(spark: SparkSession, path: str, payload: bool = False) -> DataFrame:
    """All captures of the archives below `path`, with payloads if wanted."""
    return _scanned(spark, path, [*NAMES, "payload"] if payload else NAMES)


def fetch(captures: DataFrame, most: int = 10_000) -> DataFrame:
    """`captures`, some rows of an index, with their payloads out of their files.

    A revisit has none; its payload is that of the capture it refers to. The names of at most
    `most` files reach the driver, more are an error.
    """
    files = [r[0] for r in captures.select("file").distinct().limit(most + 1).collect()]
    if len(files) > most:
        raise ValueError(f"captures of more than {most} files")
    place = ["file", "file_offset"]
    if not files:
        return captures.withColumn("payload", F.lit(None).cast("binary"))
    found = _scanned(captures.sparkSession, files, [*NAMES, "payload"]).select(*place, "payload")
    return captures.join(found, place, "left")


def loser_tree_merge(runs: list[list[tuple]]) -> Iterator[tuple]:
    """All rows of sorted runs in order; of equal rows those of the earlier run first."""
    k = len(runs)
    if not k:
        return
    sources = [iter(r) for r in runs]

    def head(i: int) -> tuple:
        row = next(sources[i], None)
        return (1, (), i, None) if row is None else (0, order(row), i, row)

    heads = [head(i) for i in range(k)]
    losers = [-1] * k

    def play(i: int) -> None:
        """Run i plays its way up; the loser of each match stays at its place."""
        at = (i + k) >> 1
        while at:
            other = losers[at]
            if other < 0:
                losers[at] = i
                return
            if heads[other][:3] < heads[i][:3]:
                losers[at], i = i, other
            at >>= 1
        losers[0] = i

    for i in range(k):
        play(i)
    while not heads[losers[0]][0]:
        i = losers[0]
        yield heads[i][3]
        heads[i] = head(i)
        play(i)


_ROWS = f"array<struct<{', '.join(f'{n}: {_TYPES[_COLUMNS[n]]}' for n in NAMES)}>>"
#: A block, under the key of its first capture.
_FIRST = ["url_key", "captured", "page_id", "file", "file_offset"]
_BLOCKS = f"run int, {', '.join(f'{n} {_TYPES[_COLUMNS[n]]}' for n in _FIRST)}, captures {_ROWS}"


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Cuts a task's sorted captures, its run, into blocks."""
    run = TaskContext.get().partitionId()
    for batch in batches:
        starts = list(range(0, len(batch), BLOCK))
        rows = pa.StructArray.from_arrays(batch.columns, NAMES)
        lists = pa.ListArray.from_arrays(pa.array([*starts, len(batch)], pa.int32()), rows)
        first = batch.take(pa.array(starts, pa.int64()))
        yield pa.RecordBatch.from_arrays(
            [pa.array([run] * len(starts), pa.int32()), *[first.column(NAMES.index(n)) for n in _FIRST], lists],
            ["run", *_FIRST, "captures"],
        )


def runs(captures: DataFrame) -> DataFrame:
    """Stored runs: every task's captures, sorted there, in blocks."""
    ordered = captures.select(NAMES).sortWithinPartitions(*_FIRST)
    return materialize(ordered.mapInArrow(_blocks, _BLOCKS), "runs")


def _tuples(rows: list[dict]) -> list[tuple]:
    return [tuple(r[n] for n in NAMES) for r in rows]


def _cutter(borders: list[tuple]):
    """Cuts blocks at the borders of ranges; a border is the first key of its range."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for number, rows in zip(batch.column(0).to_pylist(), batch.column(6).to_pylist()):
                rows = _tuples(rows)
                keys = [order(r) for r in rows]
                a = 0
                while a < len(rows):
                    part = _range_of(borders, keys[a])
                    b = bisect_left(keys, borders[part]) if part < len(borders) else len(rows)
                    first = rows[a]
                    key = [first[NAMES.index(n)] for n in _FIRST]
                    out.append((part, number, *key, [dict(zip(NAMES, r)) for r in rows[a:b]]))
                    a = b
            kinds = [pa.int32(), pa.int32(), *[_COLUMNS[n] for n in _FIRST], batch.schema.field(6).type]
            yield pa.RecordBatch.from_arrays(
                [pa.array([r[i] for r in out], k) for i, k in enumerate(kinds)],
                ["range", "run", *_FIRST, "captures"],
            )

    return run


def _range_of(borders: list[tuple], key: tuple) -> int:
    """How many borders aren't behind the key."""
    at = bisect_left(borders, key)
    return at + (at < len(borders) and borders[at] == key)


def merged(blocks: Iterator[list[tuple]]) -> Iterator[tuple]:
    """All captures in order, out of blocks in order of their first keys.

    What comes before the next block's first key is merged and goes out; the blocks that
    reach beyond it stay, one of each run.
    """
    active: list[list[tuple]] = []
    for block in blocks:
        border, parts, rest = order(block[0]), [], []
        for own in active:
            cut = bisect_left(own, border, key=order)
            parts.append(own[:cut])
            rest.append(own[cut:])
        yield from loser_tree_merge([p for p in parts if p])
        active = [r for r in rest if r] + [block]
    yield from loser_tree_merge(active)


def _merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Merges the blocks of a task's range."""
    part = TaskContext.get().partitionId()
    blocks = (
        _tuples(rows) for batch in batches
        for a in range(0, len(batch), 16) for rows in batch.column(0).slice(a, 16).to_pylist()
    )
    held, place = [], 0

    def out() -> pa.RecordBatch:
        places = pa.array(range(place, place + len(held)), pa.int64())
        batch = _batch(held, NAMES)
        return pa.RecordBatch.from_arrays(
            [*batch.columns, pa.array([part] * len(held), pa.int32()), places],
            [*NAMES, "range", "place"],
        )

    for row in merged(blocks):
        held.append(row)
        if len(held) >= BATCH:
            yield out()
            place += len(held)
            held = []
    yield out()


def _borders(blocks: DataFrame, ranges: int) -> list[tuple]:
    """First keys of all ranges but the first, out of about DRAWN first keys of blocks a range."""
    share = min(1.0, DRAWN * ranges / max(1, blocks.count()))
    drawn = blocks.filter(F.pmod(F.xxhash64(*_FIRST), F.lit(1 << 20)) < int(share * (1 << 20)))
    keys = sorted((r[0], r[1], r[2] is not None, r[2] or 0, r[3], r[4]) for r in drawn.select(_FIRST).collect())
    return sorted({keys[len(keys) * i // ranges] for i in range(1, ranges)}) if keys else []


def history(captures: DataFrame) -> DataFrame:
    """Stored captures in global order by URL key and time, each with its `position` from 1."""
    spark = captures.sparkSession
    blocks = runs(captures)
    total = blocks.agg(F.sum(F.size("captures"))).first()[0] or 0
    ranges = max(1, -(-total // RANGE_ROWS), int(spark.conf.get("spark.sql.shuffle.partitions")))
    borders = _borders(blocks, ranges)
    dealt = blocks.mapInArrow(_cutter(borders), f"range int, {_BLOCKS}")
    dealt = dealt.repartitionById(len(borders) + 1, "range")
    dealt = dealt.sortWithinPartitions(*_FIRST, "run").select("captures")
    ordered = materialize(dealt.mapInArrow(_merge, _schema(NAMES) + ", range int, place long"), "history")
    sizes = ordered.groupBy("range").count().orderBy("range").collect()
    before, rows = 0, []
    for r in sizes:
        rows.append((r["range"], before))
        before += r["count"]
    offsets = spark.createDataFrame(rows, "range int, before long")
    placed = ordered.join(F.broadcast(offsets), "range")
    return placed.select(*NAMES, (F.col("before") + F.col("place") + 1).alias("position"))


def archived(pages: DataFrame) -> DataFrame:
    """Writes the pages' archives, reads them back and orders their captures."""
    spark = pages.sparkSession
    return history(read(spark, write(pages, scratch(spark, "warc")))).drop(
        "file", "file_offset", "compressed_bytes"
    )


#: The same rows in SQL.
SQL = r"""
WITH own AS (
  SELECT page_id, coalesce(url, '') AS url, coalesce(html, '') AS payload FROM pages
), sized AS (
  SELECT page_id, strlen(payload) AS payload_bytes, sha1(payload) AS payload_digest,
         regexp_replace(regexp_replace(url, '^[A-Za-z][A-Za-z0-9+.-]*://', ''), '(?s)#.*$', '') AS rest
  FROM own
), split AS (
  SELECT *, regexp_replace(regexp_replace(lower(regexp_extract(rest, '^[^/?]*')), ':[0-9]*$', ''), '^www\.', '')
         AS host, regexp_replace(rest, '^[^/?]*', '') AS path
  FROM sized
), keyed AS (
  SELECT page_id, payload_bytes, payload_digest,
         array_to_string(list_reverse(string_split(host, '.')), ',') || ')' || path AS url_key,
         strftime(TIMESTAMP '2024-01-01' + to_seconds(page_id % 100000000), '%Y-%m-%dT%H:%M:%SZ') AS captured,
         max(page_id) OVER (PARTITION BY payload_digest) AS original
  FROM split
)
SELECT page_id, payload_bytes, payload_digest,
       CASE WHEN payload_bytes >= 1000 AND page_id <> original THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN payload_bytes >= 1000 AND page_id <> original THEN original END AS refers_to,
       url_key, captured, row_number() OVER (ORDER BY url_key, captured, page_id) AS position
FROM keyed
"""
