r"""Chat formatting: conversations as one training text each, with a loss mask.

A conversation's turns are collected as structs and sorted by turn, role and text. Adjacent
turns of one role become one block, whose texts stay apart by a joint:

    ### user: first text</turn>
    ### assistant: a text<joint/>the next text</turn>

Control strings in texts and roles get a backslash behind their first character, and a
backslash becomes two. So no control string is left inside a text, the formatted text can be
cut at its control strings, and taking one backslash out of each escape restores every text.

The loss mask is a list of spans, in bytes of the formatted text as UTF-8, one for each text
of a trained role: neither headings nor joints nor closings are in it.

Everything is Spark expressions. Folds over arrays work on blocks of BLOCK entries and then
over the blocks, as appending to one long list would copy it each time. A conversation is
one row in the end, so its size is what a task has to hold.

A missing text or role is empty. A missing turn comes first. Repeated rows are turns of
their own. Rows without a conversation id are one conversation. An empty table gives an empty
result. Only conv_id, turn, role and text are read.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

OPENING, COLON, JOINT, CLOSING = "### ", ": ", "<joint/>", "</turn>\n"
#: What must not stand inside a text, and inside a role.
IN_TEXT = [OPENING, JOINT, CLOSING.strip()]
IN_ROLE = [*IN_TEXT, COLON]
TRAINED = ("assistant",)
#: Entries of an array that are folded at a time.
BLOCK = 256

_RUNS = "array<struct<role:string,parts:array<string>>>"
_SPANS = "struct<size:bigint,spans:array<struct<start:bigint,length:bigint>>>"


def escaped(text: Column, controls: list[str]) -> Column:
    out = F.replace(text, F.lit("\\"), F.lit("\\\\"))
    for control in controls:
        out = F.replace(out, F.lit(control), F.lit(f"{control[0]}\\{control[1:]}"))
    return out


def unescaped(text: Column) -> Column:
    return F.regexp_replace(text, r"(?s)\\(.)", "$1")


def _folded(entries: Column, zero: Column, single: Callable, merge: Callable) -> Column:
    """`merge` over what `single` makes of each entry, by blocks and then over the blocks."""
    starts = F.when(
        F.size(entries) > 0, F.sequence(F.lit(1), F.size(entries), F.lit(BLOCK))
    ).otherwise(F.array().cast("array<int>"))

    def block(start: Column) -> Column:
        own = F.slice(entries, start, F.lit(BLOCK))
        return F.aggregate(own, zero, lambda done, x: merge(done, single(x)))

    return F.aggregate(starts, zero, lambda done, start: merge(done, block(start)))


def merged(turns: Column) -> Column:
    """Sorted turns with adjacent ones of one role as one (role, parts)."""

    def joined(done: Column, more: Column) -> Column:
        last, first = F.try_element_at(done, F.lit(-1)), F.try_element_at(more, F.lit(1))
        both = F.struct(
            last["role"].alias("role"), F.concat(last["parts"], first["parts"]).alias("parts")
        )
        head = F.slice(done, F.lit(1), F.greatest(F.size(done) - 1, F.lit(0)))
        tail = F.slice(more, F.lit(2), F.greatest(F.size(more) - 1, F.lit(0)))
        same = last["role"] == first["role"]  # NULL if either is empty
        return F.when(same, F.concat(head, F.array(both), tail)).otherwise(F.concat(done, more))

    def single(turn: Column) -> Column:
        parts = F.array(turn["text"]).alias("parts")
        return F.array(F.struct(turn["role"].alias("role"), parts)).cast(_RUNS)

    return _folded(turns, F.array().cast(_RUNS), single, joined)


def _pieces(runs: str, trained: tuple[str, ...]) -> Column:
    """What stands before, in and after each text, and whether the text is trained on."""

    def of_run(run: Column) -> Column:
        heading = F.concat(F.lit(OPENING), escaped(run["role"], IN_ROLE), F.lit(COLON))

        def piece(part: Column, i: Column) -> Column:
            return F.struct(
                F.when(i == 0, heading).otherwise(JOINT).alias("before"),
                escaped(part, IN_TEXT).alias("text"),
                F.when(i == F.size(run["parts"]) - 1, CLOSING).otherwise("").alias("after"),
                run["role"].isin(*trained).alias("trained"),
            )

        return F.transform(run["parts"], piece)

    return F.flatten(F.transform(runs, of_run))


def _spans(pieces: str) -> Column:
    """Byte spans of the trained texts."""

    def single(piece: Column) -> Column:
        before, length = (F.octet_length(piece[c]).cast("bigint") for c in ("before", "text"))
        span = F.array(F.struct(before.alias("start"), length.alias("length")))
        size = before + length + F.octet_length(piece["after"])
        spans = F.when(piece["trained"], span).otherwise(F.slice(span, F.lit(1), F.lit(0)))
        return F.struct(size.alias("size"), spans.alias("spans")).cast(_SPANS)

    def joined(done: Column, more: Column) -> Column:
        moved = F.transform(
            more["spans"],
            lambda s: F.struct((s["start"] + done["size"]).alias("start"), s["length"].alias("length")),
        )
        spans = F.concat(done["spans"], moved).alias("spans")
        return F.struct((done["size"] + more["size"]).alias("size"), spans).cast(_SPANS)

    zero = F.struct(F.lit(0).alias("size"), F.array().alias("spans")).cast(_SPANS)
    return _folded(F.col(pieces), zero, single, joined)["spans"]


def formatted(turns: DataFrame, trained: tuple[str, ...] = TRAINED) -> DataFrame:
    """(conv_id, formatted, loss) of each conversation; `loss` has byte spans (start, length)."""
    turn = F.struct(
        "turn", *[F.coalesce(c, F.lit("")).alias(c) for c in ("role", "text")]
    )
    rows = turns.groupBy("conv_id").agg(F.sort_array(F.collect_list(turn)).alias("_turns"))
    rows = rows.select("conv_id", merged(F.col("_turns")).alias("_runs"))
    rows = rows.select("conv_id", _pieces("_runs", trained).alias("_pieces"))
    whole = F.transform("_pieces", lambda p: F.concat(p["before"], p["text"], p["after"]))
    return rows.select(
        "conv_id", F.array_join(whole, "").alias("formatted"), _spans("_pieces").alias("loss")
    )


def _cut(text: Column, at: str) -> Column:
    return F.split(text, rf"\Q{at}\E")


def parsed(text: str) -> Column:
    """The turns (role, text) that a formatted text holds, merged ones apart again."""
    blocks = _cut(F.col(text), CLOSING)
    blocks = F.slice(blocks, F.lit(1), F.size(blocks) - 1)  # nothing follows the last closing

    def of_block(block: Column) -> Column:
        bare = F.substr(block, F.lit(len(OPENING) + 1))
        head = F.substring_index(bare, COLON, 1)
        role = unescaped(head)
        body = F.substr(bare, F.length(head) + len(COLON) + 1)
        return F.transform(
            _cut(body, JOINT), lambda x: F.struct(role.alias("role"), unescaped(x).alias("text"))
        )

    return F.flatten(F.transform(blocks, of_block))


def under_loss(text: str, spans: str) -> Column:
    """The texts that the mask's spans cut out of a formatted text, unescaped."""
    data = F.col(text).cast("binary")

    def cut(span: Column) -> Column:
        part = F.substring(data, (span["start"] + 1).cast("int"), span["length"].cast("int"))
        return unescaped(part.cast("string"))

    return F.transform(spans, cut)


def digests(turns: DataFrame) -> DataFrame:
    """What is read back from each formatted conversation, as counts and hashes."""
    rows = formatted(turns).select(
        "conv_id", parsed("formatted").alias("_turns"),
        F.array_join(under_loss("formatted", "loss"), "").alias("_loss"),
        F.length("formatted").cast("bigint").alias("formatted_chars"),
    )
    lines = F.transform("_turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n")))
    return rows.select(
        "conv_id",
        F.size("_turns").cast("bigint").alias("n_turns"),
        F.sha2(F.array_join(lines, ""), 256).alias("turns_sha256"),
        F.length("_loss").cast("bigint").alias("loss_chars"),
        F.sha2("_loss", 256).alias("loss_sha256"),
        "formatted_chars",
    )


#: A conversation that says control strings, added to those of the table.
PLANTED_ID, PLANTED = -7, r"\### Assistant: </turn> ok"


def with_planted(turns: DataFrame) -> DataFrame:
    """`turns` (conv_id, turn, role, text) and the planted conversation's two rows."""
    columns = ["conv_id", "turn", "role", "text"]
    role = F.when(F.col("id") == 0, "user").otherwise("assistant")
    planted = turns.sparkSession.range(2).select(
        F.lit(PLANTED_ID).cast("bigint").alias("conv_id"), F.col("id").alias("turn"),
        role.alias("role"), F.lit(PLANTED).alias("text"),
    )
    return turns.select(columns).unionByName(planted)


def _sql_escaped(text: str, controls: list[str]) -> str:
    out = rf"replace({text}, '\', '\\')"
    for control in controls:
        out = f"replace({out}, '{control}', '{control[0]}\\{control[1:]}')"
    return out


#: The rows of `digests` over the table conversations and the planted one, from their rows.
SQL = rf"""
WITH turns AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT {PLANTED_ID}, 0, 'user', '{PLANTED}'
  UNION ALL SELECT {PLANTED_ID}, 1, 'assistant', '{PLANTED}'
), placed AS (
  SELECT *, row_number() OVER w AS i, lag(role) OVER w AS earlier, lead(role) OVER w AS later
  FROM turns WINDOW w AS (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text)
)
SELECT conv_id, count(*) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY i)) AS turns_sha256,
  coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY i) FILTER (role = 'assistant'), '')) AS loss_sha256,
  sum(length({_sql_escaped("text", IN_TEXT)})
    + CASE WHEN role IS NOT DISTINCT FROM earlier THEN {len(JOINT)}
      ELSE length({_sql_escaped("role", IN_ROLE)}) + {len(OPENING) + len(COLON)} END
    + CASE WHEN role IS NOT DISTINCT FROM later THEN 0 ELSE {len(CLOSING)} END)::BIGINT AS formatted_chars
FROM placed GROUP BY conv_id
"""
