"""Near-duplicates by b-bit MinHash.

Texts with equal word sequences are one class from the start. A class has the set of its
distinct 5-word shingles. The minima of 96 hash functions form 24 band keys of four, and
classes that share one are candidates. One more hash function, whose range is cut into 512
bins, gives a minimum per bin; of each the low four bits are kept and packed in planes of
eight longs, one per bit, behind a plane that says which bins have a minimum. Bit counts of
two such signatures, corrected for chance agreement, say how similar the sets are; what is
far below the threshold goes no further. Links are confirmed on full sets.

A group of n near copies isn't expanded into n² pairs: first each class is held only
against the center of one of its buckets, the one most like it, then against the centers of
its other buckets that aren't connected with it by then. A bucket's center is the member
that shares buckets with most others, as a text does that the others are copies of. While buckets
have many members outside their largest component, these are held against one of its members,
a different one each turn. Last, members outside a bucket's largest component are compared with all its members of other components,
inside the join; members of the largest one are not tried with each other. So no link between
components is passed over, save by chance: a pair at 85 % similarity shares no band with
probability 2e-8 (at 80 %, 3e-6), and signatures are cut off 5.5 standard deviations below
the threshold.

A text without words is linked with nothing, as is a row without an id; both are kept.
Fewer than five words are one shingle. Rows that repeat an id share its component if their
texts do. `deduplicated` goes by rows, not ids: of each component one row stays, and a row
without an id is compared like any other. Only doc_id and text of the input are read.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gridspan.llm.frames import lists, sized, releasing, slices
from gridspan.llm.graph import components, composed, relabelled
from gridspan.llm.words import mixed, shingles, words
from gridspan.session import materialize

BANDS, ROWS = 24, 4
LANES = BANDS * ROWS
#: Bins of the signature, and low bits kept of each bin's minimum.
BINS, BITS = 512, 4
PLANE = BINS // 64
SIGNATURE = [f"s{i}" for i in range((1 + BITS) * PLANE)]
#: Share of unlike minima whose bits agree by chance.
CHANCE = 2.0**-BITS
DEVIATIONS = 5.5
#: Turns in which members outside a bucket's largest component are held against one of its
#: members, as long as trying all of them would take more than FEW pairs a member and a turn
#: leaves at most LESS of the pairs that the one before left.
TURNS, FEW, LESS = 10, 4, 0.7
#: Ids sent to all tasks, eight bytes each; more are joined by a shuffle.
BROADCAST_IDS = 500_000

_seeds = np.random.default_rng(20240229)
_XOR = _seeds.integers(0, 1 << 32, LANES, dtype=np.uint32)
_FACTOR = _seeds.integers(0, 1 << 31, LANES, dtype=np.uint32) * np.uint32(2) + np.uint32(1)


def minima(hashes: np.ndarray, number: np.ndarray) -> np.ndarray:
    """Minimum hashes (LANES x texts) of texts that all have shingles."""
    place = np.cumsum(number) - number
    x = (hashes >> np.uint64(32)).astype(np.uint32)
    return np.stack(
        [np.minimum.reduceat((x ^ s) * f, place) for s, f in zip(_XOR, _FACTOR)]
    )


def packed(sets: list[np.ndarray]) -> np.ndarray:
    """Signatures (longs x sets) of sorted sets of hashes."""
    planes = np.zeros((len(sets), 1 + BITS, BINS), np.uint8)
    bit = np.arange(BITS, dtype=np.uint64)[:, None]
    for own, row in zip(sets, planes):
        bins = own >> np.uint64(64 - BINS.bit_length() + 1)
        first = np.flatnonzero(np.diff(bins, prepend=np.uint64(BINS)))
        row[0, bins[first]] = 1
        row[1:, bins[first]] = (own[first] >> bit) & np.uint64(1)
    longs = np.packbits(planes, axis=2).view(np.int64)
    return np.ascontiguousarray(longs.reshape(len(sets), -1).T)


def band_keys(least: np.ndarray) -> np.ndarray:
    """A 64-bit key for each band (BANDS x texts)."""
    rows = least.astype(np.uint64).reshape(BANDS, ROWS, -1)
    key = np.arange(1, BANDS + 1, dtype=np.uint64)[:, None] * np.ones_like(rows[:, 0])
    for r in range(ROWS):
        key = mixed(key ^ (rows[:, r] + (key << np.uint64(32))))
    return key.astype(np.int64)


@releasing
def _signatures(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for part, texts in slices(batch, "text"):
            hashes, number = shingles(words(texts))
            some = number > 0
            sets = [np.unique(hashes[e - n : e]) for e, n in zip(np.cumsum(number), number)]
            sizes, longs = np.array(list(map(len, sets)), np.int64), packed(sets)
            keys = np.zeros(0, np.int64)
            if some.any():
                keys = band_keys(minima(hashes, number[some])).T.ravel()
            digest = [
                hashlib.md5(b" ".join(t.lower().split())).digest() if n else None
                for t, n in zip(texts, number)
            ]
            yield pa.RecordBatch.from_arrays(
                [
                    part.column(0), pa.array(digest, pa.binary()),
                    pa.array(sizes), *map(pa.array, longs),
                    lists(keys, np.where(some, BANDS, 0)),
                ],
                ["doc_id", "digest", "n_shingles", *SIGNATURE, "bands"],
            )


def signatures(docs: DataFrame) -> DataFrame:
    """Digest of the words, set size, packed signature and band keys of every row."""
    id_type = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(
        _signatures,
        f"doc_id {id_type}, digest binary, n_shingles long, "
        + "".join(f"{s} long, " for s in SIGNATURE) + "bands array<long>",
    )


def agreement(x: str, y: str) -> tuple[Column, Column, Column]:
    """Bins with a minimum in either signature, in both, and with equal bits in both."""
    either, both, same = F.lit(0), F.lit(0), F.lit(0)
    for i in range(PLANE):
        a, b = ([F.col(f"{f}.{s}") for s in SIGNATURE[i::PLANE]] for f in (x, y))
        differ = a[1].bitwiseXOR(b[1])
        for p in range(2, 1 + BITS):
            differ = differ.bitwiseOR(a[p].bitwiseXOR(b[p]))
        in_both = a[0].bitwiseAND(b[0])
        either = either + F.bit_count(a[0].bitwiseOR(b[0]))
        both = both + F.bit_count(in_both)
        same = same + F.bit_count(in_both.bitwiseAND(F.bitwise_not(differ)))
    return either, both, same


def estimate(either: Column, both: Column, same: Column) -> Column:
    """Similarity: bins whose minima are equal, less chance, among bins with any."""
    return (same - both * CHANCE) / (1 - CHANCE) / either


def plausible(x: str, y: str, percent: int) -> Column:
    """Whether sizes and signatures of rows `x` and `y` allow for a link.

    The estimate may be low by what chance agreement could have added, and by the draw: bins
    with a minimum are as many draws from the union without replacement.
    """
    t = percent / 100
    n, m = F.col(f"{x}.n_shingles"), F.col(f"{y}.n_shingles")
    either, both, same = agreement(x, y)
    union = F.greatest((n + m) / (1 + t), either)
    draw = F.sqrt(t * (1 - t) * (union - either) / (union * either))
    least = t - (1 - t) * CHANCE / (1 - CHANCE) - DEVIATIONS * draw
    sizes = F.least(n, m) * 100 >= F.greatest(n, m) * percent
    return sizes & (estimate(either, both, same) >= least)


def _first_common_band(x: str, y: str) -> Column:
    """The first of the band keys that two rows share; a pair is looked at in this one only."""
    keys = [(F.col(f"{x}.bands")[i], F.col(f"{y}.bands")[i]) for i in range(BANDS)]
    return F.coalesce(*[F.when(a == b, a) for a, b in keys])


def _confirmer(percent: int):
    @releasing
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, texts in slices(batch, "text_a"):
                others = part.column(3).cast(pa.binary()).to_pylist()
                hashes, number = shingles(words([*texts, *[t or b"" for t in others]]))
                ends = np.cumsum(number)
                sets = [np.unique(hashes[e - n : e]) for e, n in zip(ends, number)]
                linked = []
                for x, y in zip(sets[: len(texts)], sets[len(texts) :]):
                    common = len(np.intersect1d(x, y, assume_unique=True))
                    linked.append(100 * common >= percent * (len(x) + len(y) - common) > 0)
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), part.column(1), pa.array(linked)], ["a", "b", "linked"]
                )

    return run


def confirmed(docs: DataFrame, pairs: DataFrame, percent: int) -> DataFrame:
    """Those of the stored `pairs` (a, b) of ids whose texts' full shingle sets are similar."""
    id_type = docs.schema["doc_id"].dataType.simpleString()
    ids = materialize(
        pairs.select(F.explode(F.array("a", "b")).alias("doc_id")).distinct(), "pair-ids"
    )
    texts = materialize(
        docs.select("doc_id", "text").join(sized(ids, BROADCAST_IDS), "doc_id", "left_semi"),
        "pair-texts",
    )
    of_a = texts.select(F.col("doc_id").alias("a"), F.col("text").alias("text_a"))
    of_b = texts.select(F.col("doc_id").alias("b"), F.col("text").alias("text_b"))
    both = pairs.select("a", "b").join(of_a, "a").join(of_b, "b")
    checked = both.select("a", "b", "text_a", "text_b").mapInArrow(
        _confirmer(percent), f"a {id_type}, b {id_type}, linked boolean"
    )
    return checked.filter("linked").select("a", "b")


def _split(placed: DataFrame) -> DataFrame:
    """Stored (key, largest, total, rest) of buckets with several components.

    `rest` members are outside the largest component.
    """
    sizes = placed.groupBy("key", "root").agg(F.count(F.lit(1)).alias("n"))
    top = F.max(F.struct("n", "root"))
    buckets = sizes.groupBy("key").agg(
        top["root"].alias("largest"), F.sum("n").alias("total"),
        (F.sum("n") - top["n"]).alias("rest"),
    )
    return materialize(buckets.filter("rest > 0"), "split-buckets")


def near_duplicates(docs: DataFrame, percent: int = 85) -> DataFrame:
    """(doc_id, n_shingles, component_id, kept) of every row of `docs`.

    Documents are linked if 100 * |intersection| >= percent * |union| of their shingle sets.
    """
    rows = materialize(signatures(docs), "signatures")
    usable = rows.filter(F.col("digest").isNotNull() & F.col("doc_id").isNotNull())
    reps = materialize(
        usable.groupBy("digest").agg(F.min("doc_id").alias("rep")), "representatives"
    )
    classes = materialize(
        usable.join(reps.withColumnRenamed("rep", "doc_id"), ["digest", "doc_id"])
        .withColumnRenamed("doc_id", "rep").drop("digest"),
        "classes",
    )
    keyed = classes.select("rep", F.explode("bands").alias("key"))
    sizes = keyed.groupBy("key").agg(F.count(F.lit(1)).alias("size")).filter("size > 1")
    sized_keys = materialize(sizes, "bucket-sizes")
    crowded = materialize(keyed.join(sized_keys, "key"), "crowded")
    # A text that copies were made of is in more of their buckets than a copy is.
    crowd = crowded.groupBy("rep").agg(F.sum("size").alias("crowd"))
    first = F.bitwise_not("rep")  # the smallest id is the largest here
    center = F.max(F.struct("crowd", first.alias("first")))["first"]
    centers = crowded.join(crowd, "rep").groupBy("key").agg(F.bitwise_not(center).alias("center"))
    crowded = crowded.drop("size")
    features = classes.select("rep", "n_shingles", "bands", *SIGNATURE)
    features = features.join(crowded.select("rep").distinct(), "rep", "left_semi")
    features = materialize(features.dropDuplicates(["rep", *SIGNATURE]), "features")

    # Each class with the centers of its buckets: the one most like it, then others.
    stars = crowded.join(materialize(centers, "centers"), "key").filter("rep <> center")
    stars = stars.select("rep", "center").distinct()
    star = stars.alias("p").join(features.alias("x"), F.col("p.rep") == F.col("x.rep"))
    near = (F.col("p.center") == F.col("y.rep")) & plausible("x", "y", percent)
    star = star.join(features.alias("y"), near).select(
        F.col("p.rep").alias("a"), F.col("p.center").alias("b"),
        estimate(*agreement("x", "y")).alias("estimate"),
    )
    star = materialize(star, "stars")
    best = star.groupBy("a").agg(F.min_by("b", F.struct(-F.col("estimate"), "b")).alias("b"))
    best = materialize(best, "best-stars")
    roots = components(confirmed(docs, best, percent))
    more = star.select("a", "b").join(best, ["a", "b"], "left_anti")
    more = more.select("a", "b", F.col("a").alias("ra"), F.col("b").alias("rb"))
    more = relabelled(relabelled(more, "ra", roots), "rb", roots).filter("ra != rb")
    more = confirmed(docs, materialize(more.select("a", "b"), "more-stars"), percent)
    more = relabelled(relabelled(more, "a", roots), "b", roots)
    roots = composed(roots, components(more))

    # Members of a bucket that aren't connected yet: of two components, one isn't the largest.
    placed = crowded.select("key", "rep", F.col("rep").alias("root"))
    placed = materialize(relabelled(placed, "root", roots), "placed")
    before = float("inf")
    for turn in range(TURNS):
        split = _split(placed)
        work, members = split.agg(F.sum(F.col("rest") * F.col("total")), F.sum("total")).first()
        if (work or 0) <= FEW * (members or 0) or work > LESS * before:
            break
        before = work
        # Each against one member of its bucket's largest component, another one each turn.
        unlike = placed.join(split, "key")
        drawn = unlike.filter("root = largest").groupBy("key").agg(
            F.min_by("rep", F.xxhash64("rep", F.lit(turn))).alias("center")
        )
        star = unlike.filter("root <> largest").select("key", "rep").join(drawn, "key")
        star = star.select("rep", "center").distinct().alias("p")
        star = star.join(features.alias("x"), F.col("p.rep") == F.col("x.rep"))
        star = star.join(features.alias("y"), (F.col("p.center") == F.col("y.rep")) & plausible("x", "y", percent))
        star = star.select(F.col("p.rep").alias("a"), F.col("p.center").alias("b"))
        more = confirmed(docs, materialize(star, "later-stars"), percent)
        later = components(relabelled(relabelled(more, "a", roots), "b", roots))
        roots = composed(roots, later)
        placed = materialize(relabelled(placed, "root", later), "placed")
    split = _split(placed).select("key", "largest")
    unlike = materialize(placed.join(split, "key").join(features, "rep"), "unlike-members")
    x, y = unlike.filter("root <> largest").alias("x"), unlike.alias("y")
    pairs = x.join(
        y,
        (F.col("x.key") == F.col("y.key"))
        & ((F.col("x.root") < F.col("y.root"))
           | ((F.col("y.root") == F.col("y.largest")) & (F.col("x.root") > F.col("y.root"))))
        & plausible("x", "y", percent)
        & (F.col("x.key") == _first_common_band("x", "y")),
    ).select(F.col("x.rep").alias("a"), F.col("y.rep").alias("b"))
    more = confirmed(docs, materialize(pairs.distinct(), "pairs"), percent)
    later = components(relabelled(relabelled(more, "a", roots), "b", roots))

    of_class = reps.select("digest", F.col("rep").alias("component"))
    of_class = relabelled(relabelled(of_class, "component", roots), "component", later)
    of_class = materialize(of_class, "class-components")
    out = rows.select("doc_id", "n_shingles", "digest").join(of_class, "digest", "left")
    component = F.when(
        F.col("doc_id").isNotNull(), F.coalesce(F.col("component"), F.col("doc_id"))
    )
    return out.select(
        "doc_id", "n_shingles", component.alias("component_id"),
        F.col("doc_id").eqNullSafe(component).alias("kept"),
    )


def deduplicated(docs: DataFrame, percent: int = 80) -> DataFrame:
    """The rows of `docs` less all but one of each component.

    Rows are told apart by a number, as ids may repeat or be missing; the row with the
    smallest id stays, a missing one being the largest.
    """
    names = [f"_c{i}" for i in range(len(docs.columns))]
    at = {c: names[docs.columns.index(c)] for c in ("doc_id", "text")}
    rows = docs.toDF(*names).withColumn("_row", F.monotonically_increasing_id())
    rows = materialize(rows, "numbered-rows")
    own = rows.select(F.col("_row").alias("doc_id"), F.col(at["text"]).alias("text"))
    found = materialize(near_duplicates(own, percent).drop("n_shingles"), "row-components")
    several = materialize(
        found.filter(~F.col("kept")).select("component_id").distinct(), "several-rows"
    )
    members = found.join(sized(several, BROADCAST_IDS), "component_id", "left_semi")
    members = members.select(F.col("doc_id").alias("_row"), "component_id")
    members = materialize(
        members.join(rows.select("_row", F.col(at["doc_id"]).alias("id")), "_row"), "members"
    )
    place = F.struct(F.col("id").isNull().alias("no_id"), "id", "_row")
    staying = members.groupBy("component_id").agg(F.min(place)["_row"].alias("_row"))
    removed = members.select("_row").join(staying.select("_row"), "_row", "left_anti")
    removed = sized(materialize(removed, "removed"), BROADCAST_IDS)
    return rows.join(removed, "_row", "left_anti").select(*names).toDF(*docs.columns)


def sql(percent: int = 85) -> str:
    """The rows of `near_duplicates` over the table documents, in SQL, by all common shingles."""
    return rf"""
WITH RECURSIVE tokens AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
    'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents
), shingles AS (
  SELECT DISTINCT doc_id, unnest(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
    ELSE list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' ')) END) AS s
  FROM tokens
), sizes AS (
  SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id
), common AS (
  SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS c
  FROM shingles x JOIN shingles y ON x.s = y.s AND x.doc_id < y.doc_id GROUP BY 1, 2
), links AS (
  SELECT a, b FROM common JOIN sizes p ON p.doc_id = a JOIN sizes q ON q.doc_id = b
  WHERE 100 * c >= {percent} * (p.n + q.n - c)
), edges AS (
  SELECT a, b FROM links UNION ALL SELECT b, a FROM links
), reach AS (
  SELECT doc_id, doc_id AS least FROM documents
  UNION SELECT e.b, r.least FROM reach r JOIN edges e ON e.a = r.doc_id
)
SELECT r.doc_id, coalesce(any_value(n), 0) AS n_shingles, min(least) AS component_id,
       r.doc_id = min(least) AS kept
FROM reach r LEFT JOIN sizes USING (doc_id) GROUP BY r.doc_id
"""
