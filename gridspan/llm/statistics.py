"""Statistics of texts as built-in column functions.

A missing text has the statistics of an empty one, as has one without words: counts and shares
of 0, save its symbols. A text of any length is measured whole, inside its row. Rows are
measured one by one, repeated ones too; other columns may have any name.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Characters between words, and symbols.
WHITE, SYMBOLS = " \t\n\x0b\f\r", "#*$%&|<>"
_GAPS, _WORD = r"[\x20\x09-\x0D]+", r"[^\x20\x09-\x0D]"
#: Words of a window whose repetition counts.
WINDOW = 8

COUNTS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
#: What the learned rules see.
FEATURES = [
    "n_words", "mean_word", "symbol_share", "dup_line_share", "repeat_share", "distinct_share",
    "upper_share",
]


def _pairs(hashes: str, distance: int) -> Column:
    """A hash of each entry and the one `distance` further on."""
    further = F.slice(hashes, distance + 1, F.greatest(F.size(hashes), F.lit(1)))
    both = F.zip_with(hashes, further, lambda x, y: F.xxhash64(x, y))
    return F.slice(both, 1, F.greatest(F.size(hashes) - distance, F.lit(0)))


def _with_windows(df: DataFrame, hashes: str) -> DataFrame:
    """`hashes` of words replaced by those of all windows of WINDOW, a power of two, words."""
    distance = 1
    while distance < WINDOW:
        df = df.withColumn(hashes, _pairs(hashes, distance))
        distance *= 2
    return df


def _repeat_words(df: DataFrame, windows: str, out: str) -> DataFrame:
    """Adds how many words stand in windows that occur twice or more.

    Only a text with such a window sorts its windows, as longs that hold the upper bits of
    the hash and the place in the lower ones. Windows with equal upper bits are then near to
    each other, and their whole hashes are compared; their places in order say how many
    words each adds. More than two unlike windows with the same upper bits don't come about.
    """
    n = F.size(windows)
    repeats = F.size(F.array_distinct(windows)) < n
    bits = F.ceil(F.log2(n + 2)).cast("int")
    df = df.withColumn("_low", F.call_function("shiftleft", F.lit(1).cast("bigint"), bits) - 1)
    packed = F.transform(
        windows, lambda x, i: x.bitwiseAND(F.bitwise_not("_low")).bitwiseOR(i.cast("bigint"))
    )
    nothing = F.array().cast("array<bigint>")
    df = df.withColumn("_sorted", F.when(repeats, F.sort_array(packed)).otherwise(nothing))

    def place(e: Column, k: Column) -> Column:
        at = e.bitwiseAND(F.col("_low")).cast("int")

        def like(step: int) -> Column:
            other = F.get("_sorted", k + step)
            near = e.bitwiseXOR(other) <= F.col("_low")
            there = F.get(windows, other.bitwiseAND(F.col("_low")).cast("int"))
            return near & (e.bitwiseXOR(other) >= 0) & (there == F.get(windows, at))

        return F.when(F.coalesce(like(1), F.lit(False)) | F.coalesce(like(-1), F.lit(False))
                      | F.coalesce(like(2), F.lit(False)) | F.coalesce(like(-2), F.lit(False)), at)

    df = df.withColumn("_places", F.sort_array(F.array_compact(F.transform("_sorted", place))))
    gains = F.zip_with(
        "_places", F.slice("_places", 2, F.greatest(F.size("_places"), F.lit(1))),
        lambda a, b: F.least(F.coalesce(b - a, F.lit(WINDOW)), F.lit(WINDOW)),
    )
    total = F.aggregate(gains, F.lit(0).cast("bigint"), lambda s, x: s + x)
    total = F.when(F.size("_places") == 0, F.lit(0).cast("bigint")).otherwise(total)
    return df.withColumn(out, total).drop("_sorted", "_places", "_low")


def _matches(text: str, characters: str) -> Column:
    """How many characters of a class a text has."""
    return (F.length(text) - F.length(F.regexp_replace(text, f"[{characters}]+", ""))).cast("bigint")


def _dup_lines(lines: str) -> Column:
    """Lines with a word that are equal to an earlier one."""
    own = F.filter(lines, lambda x: F.rlike(x, F.lit(_WORD)))
    repeats = F.size(F.array_distinct(lines)) < F.size(lines)
    return F.when(repeats, F.size(own) - F.size(F.array_distinct(own))).otherwise(0).cast("bigint")


def counted(docs: DataFrame, keep: list[str], features: bool = False) -> DataFrame:
    """The columns `keep` with COUNTS of every whole text, and FEATURES if wanted.

    The columns kept are renamed on the way, so none of them can clash. Each step reads what
    the one before has worked out, several times over: so the steps stay apart in the plan
    and nothing is worked out twice.
    """
    names = [f"_keep{i}" for i in range(len(keep))]
    held = [F.col(c).alias(n) for c, n in zip(keep, names)]
    df = docs.select(*held, F.coalesce("text", F.lit("")).alias("_text"))
    core = F.btrim("_text", F.lit(WHITE))
    some = F.when(core == "", F.array().cast("array<string>")).otherwise(F.split(core, _GAPS))
    upper = [_matches("_text", "A-Z").alias("_upper")] if features else []
    df = df.select(
        *names, some.alias("_words"), F.split("_text", "\n").alias("_lines"),
        _matches("_text", SYMBOLS).alias("n_symbols"), *upper,
    )
    shape = [F.size("_lines").alias("_n_lines"),
             F.size(F.array_distinct("_words")).alias("_n_distinct"), "_upper"]
    df = df.select(
        *names, "n_symbols", *(shape if features else []),
        F.transform("_words", lambda x: F.xxhash64(x)).alias("_windows"),
        F.size("_words").cast("bigint").alias("n_words"),
        F.length(F.array_join("_words", "")).cast("bigint").alias("word_chars"),
        _dup_lines("_lines").alias("n_dup_lines"),
    )
    df = _repeat_words(_with_windows(df, "_windows"), "_windows", "n_repeat_words")
    own = [F.col(n).alias(c) for n, c in zip(names, keep)]
    if not features:
        return df.select(*own, *COUNTS)
    chars, words = F.greatest("word_chars", F.lit(1)), F.greatest("n_words", F.lit(1))
    shares = {
        "mean_word": F.col("word_chars") / words,
        "symbol_share": F.col("n_symbols") / chars,
        "dup_line_share": F.col("n_dup_lines") / F.greatest("_n_lines", F.lit(1)),
        "repeat_share": F.col("n_repeat_words") / words,
        "distinct_share": F.col("_n_distinct") / words,
        "upper_share": F.col("_upper") / chars,
    }
    return df.select(*own, *COUNTS, *[c.alias(n) for n, c in shares.items()])
