"""Document fingerprints out of Lempel-Ziv phrases.

A text's bytes are parsed as LZ78 does: each phrase is the longest one seen before and one
more byte. Texts that compress each other well share phrases, so the likeness of two texts
is the similarity of their phrase sets, estimated by 64 minimum hashes of 16 bits each.

To hold each document against the next one by id, rows are dealt out by ranges of id and
text hash, each with a copy of the following range's first row, and read in order by one
streaming task. An id that holds many rows is cut by the hashes of its texts, and a text that
holds many of an id's rows is dealt at random to several ranges, as its rows are alike. The
text crosses the network once; the driver sees some ids and hashes per range.

A missing text is an empty one; an empty text's fingerprint is empty, like another empty one
(likeness 1) and unlike all others (0). The next row is the next in order of id, then of the
text's hash, missing ids first; the first follows the last, and a single row follows itself.
Rows that repeat an id are next to each other. Only doc_id and text of the input are read.
"""

from __future__ import annotations

import hashlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gridspan.llm.frames import slices
from gridspan.llm.words import mixed, span_hashes

LANES = 64
#: Quantile sketch entries kept per range.
SKETCH = 20
#: Equal rows for each range that they are dealt to; so many leave none empty.
PIECE = 64
#: Stands for a missing id, before all others.
NO_ID = -(1 << 63)

_seeds = np.random.default_rng(1978)
_XOR = _seeds.integers(0, 1 << 32, LANES, dtype=np.uint32)
_FACTOR = _seeds.integers(0, 1 << 31, LANES, dtype=np.uint32) * np.uint32(2) + np.uint32(1)


class Parse:
    """An LZ78 parse that can go on, or fork and go on in two ways."""

    def __init__(self) -> None:
        self.children: dict[int, int] = {}
        self.node, self.at, self.ends = 0, 0, []

    def fork(self) -> Parse:
        other = Parse()
        other.children, other.ends = self.children.copy(), self.ends.copy()
        other.node, other.at = self.node, self.at
        return other

    def feed(self, data: bytes) -> Parse:
        children, node, found = self.children, self.node, self.ends.append
        get, fresh = children.get, (len(children) + 1) << 8
        for at, byte in enumerate(data, self.at + 1):
            step = node | byte
            node = get(step)
            if node is None:
                children[step] = fresh
                fresh += 256
                found(at)
                node = 0
        self.node, self.at = node, self.at + len(data)
        return self


def signatures(texts: list[bytes], parses: list[Parse]) -> np.ndarray:
    """16-bit minimum hashes (texts x LANES) of the phrases; zeros where there are none."""
    out = np.zeros((len(texts), LANES), np.uint16)
    number = np.array([len(p.ends) for p in parses])
    if not number.any():
        return out
    data = np.frombuffer(b"".join(texts), np.uint8)
    offsets = np.cumsum([len(t) for t in texts]) - [len(t) for t in texts]
    ends = np.concatenate([np.array(p.ends, np.int64) for p in parses]) + np.repeat(offsets, number)
    starts = np.concatenate([[0], ends[:-1]])
    place = (np.cumsum(number) - number)[number > 0]
    starts[place] = offsets[number > 0]
    x = (span_hashes(data, starts, ends) >> np.uint64(32)).astype(np.uint32)
    least = [np.minimum.reduceat((x ^ s) * f, place) for s, f in zip(_XOR, _FACTOR)]
    out[number > 0] = (mixed(np.stack(least, axis=1).astype(np.uint64)) >> np.uint64(48))
    return out


def likeness(x: np.ndarray, y: np.ndarray) -> float:
    """Share of agreeing minima, less what agrees by chance."""
    chance = 2.0**-16
    return max(0.0, (float((x == y).mean()) - chance) / (1 - chance))


def edited_text(text: str, following: str) -> tuple[str, str]:
    """What an edit keeps of a text, and what of the next one it puts in place of the rest."""
    half = len(text) // 2
    return text[: len(text) - half], following[:half]


def _compare(texts: list[str]) -> list[tuple]:
    """The columns after doc_id for each text but the last, which only follows."""
    encoded, parses, edited, edited_parses = [], [], [], []
    for text, following in zip(texts, texts[1:]):
        kept, put = (part.encode() for part in edited_text(text, following))
        own = Parse().feed(kept)
        edited_parses.append(own.fork().feed(put))
        edited.append(kept + put)
        encoded.append(data := text.encode())
        parses.append(own.feed(data[len(kept) :]))
    encoded.append(texts[-1].encode())
    parses.append(Parse().feed(encoded[-1]))
    marks = signatures(encoded + edited, parses + edited_parses)
    own, other = marks[: len(texts)], marks[len(texts) :]

    def shown(mark: np.ndarray, data: bytes) -> str:
        return mark.astype(">u2").tobytes().hex() if data else ""

    def near(x: np.ndarray, a: bytes, y: np.ndarray, b: bytes) -> float:
        return likeness(x, y) if a and b else float(a == b)

    return [
        (
            len(text), hashlib.sha256(edited[i]).hexdigest(), shown(own[i], encoded[i]),
            shown(other[i], edited[i]), near(own[i], encoded[i], other[i], edited[i]),
            near(own[i], encoded[i], own[i + 1], encoded[i + 1]),
        )
        for i, text in enumerate(texts[:-1])
    ]


def _walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    kinds = [pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.float64()]
    names = ["n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"]
    ids, texts, copies = [], [], []
    for batch in batches:
        for part, own in slices(batch, "text"):
            ids += part.column(0).to_pylist()
            texts += [t.decode() for t in own]
            copies += part.column(2).to_pylist()
            if len(texts) > 1:
                rows = _compare(texts)
                keep = [i for i, copy in enumerate(copies[:-1]) if not copy]
                columns = [
                    pa.array([rows[i][k] for i in keep], kind) for k, kind in enumerate(kinds)
                ]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([ids[i] for i in keep], part.column(0).type), *columns],
                    ["doc_id", *names],
                )
                ids, texts, copies = ids[-1:], texts[-1:], copies[-1:]


@dataclass(frozen=True)
class Ranges:
    """First keys (id, text hash) of all ranges but the first; a key that repeats has several."""

    ids: np.ndarray
    hashes: np.ndarray

    def places(self, ids: np.ndarray, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Of each key the first and the last range it may lie in."""
        last = np.searchsorted(self.ids, ids, side="right")
        first = last.copy()
        for own in np.unique(self.ids):
            at = np.flatnonzero(ids == own)
            if len(at):
                start, end = (np.searchsorted(self.ids, own, side=s) for s in ("left", "right"))
                firsts = self.hashes[start:end]
                last[at] = start + np.searchsorted(firsts, hashes[at], side="right")
                least = start + np.searchsorted(firsts, hashes[at], side="left")
                # A key that is a first key once begins its range; one that is so several
                # times is dealt to all of these.
                first[at] = np.where(least < last[at], least + 1, last[at])
        return first, last


def ranges_of(keys: DataFrame, number: int) -> Ranges:
    """About even ranges of `keys` (id, h), out of quantiles and of counts of frequent keys."""
    at = [i / number for i in range(1, number)]
    if not at:
        return Ranges(np.zeros(0, np.int64), np.zeros(0, np.int64))

    def quantiles(column: str) -> Column:
        return F.percentile_approx(column, at, SKETCH * number).alias("q")

    ids = Counter(keys.agg(quantiles("id")).first()["q"] or [])
    hot = [i for i, n in ids.items() if n > 1]
    firsts = Counter((i, NO_ID) for i in ids)
    for r in keys.filter(F.col("id").isin(hot)).groupBy("id").agg(quantiles("h")).collect():
        own = [r["q"][j * number // ids[r["id"]] - 1] for j in range(1, ids[r["id"]])]
        firsts.update((r["id"], h) for h in own)
    same = [k for k, n in firsts.items() if n > 1]
    if same:
        wanted = F.array(*[F.struct(F.lit(i).alias("id"), F.lit(h).alias("h")) for i, h in same])
        found = keys.filter(F.array_contains(wanted, F.struct("id", "h")))
        counts = {(r["id"], r["h"]): r["count"] for r in found.groupBy("id", "h").count().collect()}
        for k in same:
            firsts[k] = max(1, min(firsts[k], counts.get(k, 0) // PIECE))
    ordered = sorted(firsts.elements())
    return Ranges(*(np.array([k[j] for k in ordered], np.int64) for j in (0, 1)))


def fingerprints(docs: DataFrame) -> DataFrame:
    """Fingerprints of every row's text and of its edited text, and how like they are."""
    spark = docs.sparkSession
    number = max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))
    own_id = F.coalesce(F.col("doc_id").cast("bigint"), F.lit(NO_ID)).alias("id")
    own_hash = F.xxhash64(F.coalesce("text", F.lit(""))).alias("h")
    keys = docs.select(own_id, own_hash)
    ranges = ranges_of(keys, number)

    @F.pandas_udf("struct<first: int, last: int>")
    def place(ids: pd.Series, hashes: pd.Series) -> pd.DataFrame:
        first, last = ranges.places(ids.to_numpy(np.int64), hashes.to_numpy(np.int64))
        return pd.DataFrame({"first": first.astype(np.int32), "last": last.astype(np.int32)})

    spread = F.floor(F.rand() * (F.col("p.last") - F.col("p.first") + 1)).cast("int")
    placed = docs.select("doc_id", own_id, own_hash, "text").withColumn("p", place("id", "h"))
    placed = placed.withColumn("range", F.col("p.first") + spread).select("doc_id", "id", "h", "text", "range")
    heads = (
        keys.withColumn("p", place("id", "h"))
        .select("id", "h", F.explode(F.sequence("p.first", "p.last")).alias("range")).groupBy("range")
        .agg(F.min(F.struct("id", "h")).alias("head")).orderBy("range").collect()
    )
    copies = spark.createDataFrame(
        [(*r["head"], heads[i - 1]["range"]) for i, r in enumerate(heads)], "id long, h long, to int"
    )
    copied = docs.select("doc_id", own_id, own_hash, "text").join(F.broadcast(copies), ["id", "h"])
    copied = copied.groupBy("id", "h", "to").agg(F.first("doc_id").alias("doc_id"), F.first("text").alias("text"))
    rows = placed.withColumn("copy", F.lit(False)).unionByName(
        copied.select("doc_id", "id", "h", "text", F.col("to").alias("range"), F.lit(True).alias("copy"))
    )
    rows = rows.withColumn("text", F.coalesce("text", F.lit("")))
    dealt = rows.repartitionById(max(1, len(ranges.ids) + 1), "range")
    dealt = dealt.sortWithinPartitions("range", "copy", "id", "h", "text")
    id_type = docs.schema["doc_id"].dataType.simpleString()
    return dealt.select("doc_id", "text", "copy").mapInArrow(
        _walk,
        f"doc_id {id_type}, n_chars long, edited_sha256 string, fingerprint string, "
        "edited_fingerprint string, near_edited double, near_next double",
    )
