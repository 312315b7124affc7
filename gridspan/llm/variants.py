r"""Spelling variants: words one edit apart, and the frequent form that each belongs to.

Near words are found by permuterm rotations. A word with a terminator behind it is rotated at
every place: `house` gives `house$`, `ouse$h`, `use$ho` and so on. The edited character is
brought to the end of a rotation and skipped: words that differ in one replaced character
share such a shortened rotation, and a word with one character more shares it with the whole
rotation of the word without it. So rotations are sorted, and each run of equal ones is a
prefix range whose members are all near to each other. A run has one whole rotation at most
and as many shortened ones as there are characters, so it is bounded, whatever the corpus.
A scan over a run emits for each member how many neighbours it has there and which of them is
the most frequent; pairs are never listed. A pair that differs by a replacement shares one
run. One that differs by an insertion shares as many as the character has repeats beside it,
and counts in the run that skips the last of these.

A rotation of more than LONG code points stands in the sort by 124 bits of polynomial hashes,
as a word of a million letters has a million rotations of that length.

Words are the runs of letters of all texts; see `words`. A missing text has none, a missing id
is empty in the hash that picks the deletions. Repeated rows count as often as they occur. An
empty table gives an empty result. Only doc_id and text are read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gridspan.llm.graph import jumped
from gridspan.llm.merkle import SQL_CRC
from gridspan.session import materialize

#: Letters once A-Z are lower-cased, and the two alphabets of that.
LETTERS, UPPER, LOWER = r"[a-zÀ-ÿ]", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Shortest word, fewest occurrences, one in how many runs loses a letter, and how much more
#: frequent a form is.
LEAST_LENGTH, LEAST_COUNT, DELETED, TIMES = 7, 2, 31, 10
TERMINATOR = "$"
#: Code points of a rotation that is sorted as it is.
LONG = 64
#: The largest primes below 2^31, and a base for each.
PRIMES = [2147483647, 2147483629, 2147483587, 2147483579]
BASES = [911382323, 972663749, 1295351267, 1866180841]
#: Rotations that a task holds at a time.
ROWS = 100_000
#: What a shortened or whole rotation stands for.
WHOLE, SKIPS, SKIPS_LAST = 0, 1, 2


def words(docs: DataFrame) -> DataFrame:
    """(word) of every occurrence in all texts.

    Runs of letters, A-Z in lower case. If DELETED divides the crc32 `h` of `<doc_id>:<run>`,
    the run loses its code point h % length. Runs that are too short stay out from the start.
    """
    text = F.translate("text", UPPER, LOWER)
    runs = F.regexp_extract_all(text, F.lit(f"{LETTERS}{{{LEAST_LENGTH},}}"), 0)
    rows = docs.select(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).alias("id"), F.explode(runs).alias("run"))
    h = F.crc32(F.concat("id", F.lit(":"), "run").cast("binary"))
    rows = rows.select("run", h.alias("h"))
    at = (F.col("h") % F.length("run")).cast("int")
    less = F.concat(F.substr("run", F.lit(1), at), F.substr("run", at + 2))
    word = F.when(F.col("h") % DELETED == 0, less).otherwise(F.col("run"))
    return rows.select(word.alias("word")).filter(F.length("word") >= LEAST_LENGTH)


def vocabulary(docs: DataFrame) -> DataFrame:
    """(id, word, n) of the words that occur often enough, stored; ids ascend with the words."""
    counts = words(docs).groupBy("word").agg(F.count(F.lit(1)).alias("n"))
    often = materialize(counts.filter(F.col("n") >= LEAST_COUNT), "word-counts")
    return materialize(
        often.orderBy("word").select(F.monotonically_increasing_id().alias("id"), "word", "n"),
        "vocabulary",
    )


def _powers(base: int, number: int, prime: int) -> np.ndarray:
    out = np.ones(1, np.uint64)
    while len(out) < number:
        out = np.concatenate([out, out * np.uint64(pow(base, len(out), prime)) % np.uint64(prime)])
    return out[:number]


class Hashed:
    """Hashes of a long word's rotations, each from sums over prefixes of the word."""

    def __init__(self, word: str):
        self.codes = np.frombuffer(word.encode("utf-32-le"), np.uint32).astype(np.uint64)
        self.tables = []
        for base, prime in zip(BASES, PRIMES):
            up = _powers(base, len(word) + 2, prime)
            down = _powers(pow(base, -1, prime), len(word) + 1, prime)
            sums = np.zeros(len(word) + 1, np.uint64)
            np.cumsum(self.codes * up[: len(word)] % np.uint64(prime), out=sums[1:])
            self.tables.append((np.uint64(prime), up, down, sums % np.uint64(prime)))

    def keys(self, at: np.ndarray, skip: int) -> list[bytes]:
        """Of the rotations that start at each of `at`, less their last `skip` code points."""
        length, out = len(self.codes), np.empty((len(at), len(PRIMES)), np.uint32)
        for k, (prime, up, down, sums) in enumerate(self.tables):
            tail = (sums[length] + prime - sums[at]) % prime * down[at] % prime
            mark = np.uint64(ord(TERMINATOR)) * up[length - at] % prime
            head = sums[at - skip] * up[length - at + 1] % prime
            out[:, k] = (tail + mark + head) % prime
        return [b"\xff" + row.tobytes() for row in out]


def rotations(word: str) -> Iterator[tuple[list[bytes], list[int]]]:
    """Sort keys of all rotations of a word, whole and without their last code point.

    And what each stands for; in pieces of about ROWS. The terminator is never skipped.
    """
    length, ring = len(word), word + TERMINATOR + word
    hashed = Hashed(word) if length >= LONG else None

    def keys(places: range, skip: int) -> list[bytes]:
        size = length + 1 - skip
        if size > LONG:
            return hashed.keys(np.asarray(places), skip)
        return [ring[i : i + size].encode() for i in places]

    for start in range(0, length + 1, ROWS):
        places = range(start, min(start + ROWS, length + 1))
        yield keys(places, 0), [WHOLE] * len(places)
        places = range(max(start, 1), places.stop)
        last = [i == length or word[i] != word[i - 1] for i in places]
        yield keys(places, 1), [SKIPS_LAST if x else SKIPS for x in last]


def _rotated(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names, types = ["key", "id", "n", "kind"], [pa.binary(), pa.int64(), pa.int64(), pa.int32()]
    columns: list[list] = [[], [], [], []]
    for batch in batches:
        for i, word, n in zip(*(c.to_pylist() for c in batch.columns)):
            for keys, kinds in rotations(word):
                for column, more in zip(columns, (keys, [i] * len(keys), [n] * len(keys), kinds)):
                    column.extend(more)
                if len(columns[0]) >= ROWS:
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], names)
                    columns = [[], [], [], []]
    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], names)


def neighbours(vocabulary: DataFrame) -> DataFrame:
    """(id, n_near, near_n, near) of words with near words: how many, and the most frequent.

    Of equally frequent ones that with the smallest id.
    """
    # A word makes some twenty rows, so few files of words are dealt to many tasks first.
    tasks = int(vocabulary.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    rotated = vocabulary.select("id", "word", "n").repartition(tasks, "id").mapInArrow(
        _rotated, "key binary, id long, n long, kind int"
    )
    run = Window.partitionBy("key").orderBy(F.desc("n"), "id")
    run = run.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    kind, own = F.col("kind"), F.struct("n", "id")

    def number(which: Column) -> Column:
        return F.count(F.when(which, 1)).over(run)

    scanned = rotated.select(
        "id", "kind", F.first(own).over(run).alias("first"), F.nth_value(own, 2).over(run).alias("second"),
        number(kind == WHOLE).alias("whole"), number(kind != WHOLE).alias("skips"),
        number(kind == SKIPS_LAST).alias("last"),
    ).filter("second IS NOT NULL")
    beside = F.col("skips") - 1 + F.when(kind == SKIPS_LAST, F.col("whole")).otherwise(0)
    best = F.when(F.col("first.id") == F.col("id"), F.col("second")).otherwise(F.col("first"))
    emitted = scanned.select(
        "id", F.when(kind == WHOLE, F.col("last")).otherwise(beside).alias("beside"),
        F.struct(best["n"].alias("n"), (-best["id"]).alias("id")).alias("best"),
    )
    found = emitted.groupBy("id").agg(F.sum("beside").alias("n_near"), F.max("best").alias("best"))
    return found.select("id", "n_near", F.col("best.n").alias("near_n"), (-F.col("best.id")).alias("near"))


def grouped(docs: DataFrame) -> DataFrame:
    """(word, n, n_near, form, form_n, root) of every word.

    The form is the most frequent near word if it is TIMES as frequent; forms are followed to
    the last, the root. Each form is more frequent than its word, so there are no circles.
    """
    known = vocabulary(docs)
    near = materialize(neighbours(known), "neighbours")
    rows = known.join(near, "id", "left").withColumn(
        "near", F.when(F.col("near_n") >= F.col("n") * TIMES, F.col("near"))
    )
    rows = materialize(rows, "near-words")
    parents = rows.filter("near IS NOT NULL").select(F.col("id").alias("v"), F.col("near").alias("p"))
    roots = jumped(parents).select(F.col("v").alias("id"), F.col("root").alias("root_id"))
    form = known.select(F.col("id").alias("near"), F.col("word").alias("form"), F.col("n").alias("form_n"))
    root = known.select(F.col("id").alias("root_id"), F.col("word").alias("root"))
    rows = rows.join(form, "near", "left").join(roots, "id", "left").join(root, "root_id", "left")
    return rows.select(
        "word", "n", F.coalesce("n_near", F.lit(0)).cast("bigint").alias("n_near"),
        "form", "form_n", F.coalesce("root", "word").alias("root"),
    )


def sql() -> str:
    """The rows of `grouped` over the table documents, by words with one place left out."""
    step = "lambda c, b: xor(c >> 8, crc.t[(xor(c, b) & 255) + 1])"
    byte = "lambda i: ('0x' || substr(x, (2 * i - 1)::INT, 2))::BIGINT"
    codes = f"list_transform(range(1, 1 + length(x) // 2), {byte})"
    return rf"""
WITH RECURSIVE {SQL_CRC},
runs AS (
  SELECT coalesce(doc_id::VARCHAR, '') AS id,
    unnest(regexp_extract_all(translate(text, '{UPPER}', '{LOWER}'), '[a-z\x{{C0}}-\x{{FF}}]+')) AS run
  FROM documents
), hashed AS (
  SELECT run, xor(4294967295, list_reduce(list_prepend(4294967295::BIGINT, {codes}), {step})) AS h
  FROM (SELECT run, hex(id || ':' || run) AS x FROM runs), crc
), spelled AS (
  SELECT CASE WHEN h % {DELETED} = 0 THEN left(run, (h % length(run))::INT) || substr(run, (h % length(run) + 2)::INT)
    ELSE run END AS word FROM hashed
), words AS (
  SELECT word, count(*) AS n FROM spelled WHERE length(word) >= {LEAST_LENGTH} GROUP BY word
  HAVING count(*) >= {LEAST_COUNT}
), less AS (
  SELECT word, n, i, left(word, i - 1) || substr(word, i + 1) AS rest
  FROM (SELECT word, n, unnest(range(1, length(word) + 1))::INT AS i FROM words)
), near AS (
  SELECT DISTINCT a.word, b.word AS other, b.n AS other_n
  FROM less a JOIN less b ON a.rest = b.rest AND a.i = b.i AND a.word <> b.word
  UNION SELECT a.word, b.word, b.n FROM less a JOIN words b ON a.rest = b.word
  UNION SELECT b.word, a.word, a.n FROM less a JOIN words b ON a.rest = b.word
), best AS (
  SELECT word, count(*) AS n_near, first(other ORDER BY other_n DESC, other) AS other, max(other_n) AS other_n
  FROM near GROUP BY word
), forms AS (
  SELECT w.word, w.n, coalesce(n_near, 0) AS n_near,
    CASE WHEN other_n >= {TIMES} * w.n THEN other END AS form, CASE WHEN other_n >= {TIMES} * w.n THEN other_n END AS form_n
  FROM words w LEFT JOIN best b USING (word)
), chain AS (
  SELECT word, word AS root, form AS next FROM forms
  UNION ALL SELECT c.word, c.next, f.form FROM chain c JOIN forms f ON f.word = c.next
)
SELECT f.*, c.root FROM forms f JOIN chain c ON c.word = f.word AND c.next IS NULL
"""
