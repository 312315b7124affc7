"""Merkle manifest of a dataset: a hash tree per source, and one over the sources' roots.

Leaves of a group ascend by id; while a group has several nodes, every three consecutive
ones become their hash. Leaves get dense positions in their group: they are sorted across
tasks by ranges, and a row's place in its range plus the sizes of earlier ranges is its
position, so no group is ever one task's work. Positions are cut into blocks of 3^7 rows.
Inside a block a level is two windows over its rows: `lag` and `lead` at the level's fixed
offsets, masked by the node's slot among its siblings and by how many nodes the level has,
give the siblings, and the row of a first child hashes the parent. Blocks leave one row
each, which are the nodes of the next round, so rounds grow with the logarithm of the
largest group. Paths come back down by one join a round, on group and block.

A path has, for each level from the leaf to the root, the hashes of the siblings to the left
and to the right of the node; `folded` recomputes the root from a leaf and its path.

Values: a missing one is told from an empty one; a missing source is a group of its own,
which comes first; a row without an id comes first in its group and is never tampered with.
Rows that repeat an id are ordered by their leaves; equal rows are leaves of their own, in
any order. A text may have any length. An empty table gives an empty result. Only doc_id,
source, lang, n_chars and text are read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gridspan.llm.frames import placed, remainder
from gridspan.session import materialize

#: Children of a node, levels that one window's rows hold, and those rows.
ARITY, LEVELS = 3, 7
BLOCK = ARITY**LEVELS
FIELDS = ["doc_id", "source", "lang", "n_chars", "text"]


def _hash(*texts: Column) -> Column:
    return F.sha2(F.concat(*texts), 256)


def encoded(value: Column) -> Column:
    """A value with its length in bytes before it, so that fields can't run into each other."""
    text = value.cast("string")
    with_size = F.concat(F.octet_length(text).cast("string"), F.lit(":"), text)
    return F.coalesce(with_size, F.lit("-"))


def leaf(text: Column | None = None) -> Column:
    """The hash of a document's fields, with `text` in place of its own if given."""
    fields = [F.col(c) for c in FIELDS]
    if text is not None:
        fields[-1] = text
    return _hash(*map(encoded, fields))


def group_key(source: str = "source") -> Column:
    """A source's key, in the byte order of its name and never missing."""
    return F.coalesce(F.concat(F.lit("s"), F.col(source)), F.lit(""))


def climbed(nodes: DataFrame, paths: bool = False) -> DataFrame:
    """`nodes` (group, pos, n, node) with `node` led up as far as their block reaches.

    The result's `node` stands in the row of its first leaf only, in a block's first row at
    least. With `paths`, every row also has its siblings of all levels, as the array `path`.
    """
    rows = Window.partitionBy("group", "block").orderBy("pos")
    so_far = rows.rowsBetween(Window.unboundedPreceding, 0)
    df = nodes.withColumn("block", F.floor(F.col("pos") / BLOCK))
    steps = [ARITY**level for level in range(LEVELS)]
    for level, step in enumerate(steps):
        # Nodes of this level, the number of their run's slot, and whether there are several.
        holds, several = F.col("pos") % step == 0, F.col("n") > step
        slot = F.floor(F.col("pos") / step) % ARITY
        sides = [
            F.when(slot >= -d, F.lag("node", -d * step).over(rows)) if d < 0
            else F.when(slot + d < ARITY, F.lead("node", d * step).over(rows))
            for d in range(1 - ARITY, ARITY) if d
        ]
        sides = [F.coalesce(F.when(holds & several, s), F.lit("")) for s in sides]
        left, right = F.concat(*sides[: ARITY - 1]), F.concat(*sides[ARITY - 1 :])
        df = df.withColumn("_sides", F.when(holds & several, F.struct(left.alias("left"), right.alias("right"))))
        parent = F.when(holds & (slot == 0), _hash(F.col("node"), F.col("_sides.right")))
        df = df.withColumn("node", F.when(several, parent).otherwise(F.col("node")))
        if paths:
            # Of all rows below a node, the first has its siblings; no later one is before it.
            held = F.last("_sides", ignorenulls=True).over(so_far)
            df = df.withColumn(f"_path{level}", held)
        df = df.drop("_sides")
    if paths:
        own = [F.when(F.col("n") > s, F.col(f"_path{i}")) for i, s in enumerate(steps)]
        df = df.withColumn("path", F.array_compact(F.array(*own)))
        df = df.drop(*[f"_path{i}" for i in range(LEVELS)])
    return df


def _rounds(nodes: DataFrame) -> list[DataFrame]:
    """Tables (group, pos, n, node): `nodes`, then a row per block of each, down to one a group."""
    out = [nodes]
    while (out[-1].agg(F.max("n")).first()[0] or 0) > 1:
        tops = climbed(out[-1].select("group", "pos", "n", "node"))
        tops = tops.filter(F.col("pos") % BLOCK == 0).select(
            "group", F.col("block").alias("pos"), F.ceil(F.col("n") / BLOCK).alias("n"), "node"
        )
        out.append(materialize(tops, "nodes"))
    return out


def _descended(rounds: list[DataFrame], tops: DataFrame) -> DataFrame:
    """The first of `rounds` with each row's `path` and the other columns of `tops`.

    `tops` (group, path, ...) has one row a group.
    """
    above = tops.withColumn("block", F.lit(0).cast("bigint"))
    for i in reversed(range(len(rounds) - 1)):
        below = climbed(rounds[i], paths=True).drop("node", "n")
        above = below.join(above.withColumnRenamed("path", "_above"), ["group", "block"])
        above = above.withColumn("path", F.concat("path", "_above")).drop("_above", "block")
        if i:
            above = materialize(above.withColumnRenamed("pos", "block"), "paths")
    if len(rounds) == 1:
        return rounds[0].drop("node", "n").join(above.drop("block"), "group")
    return above


def manifest(leaves: DataFrame) -> DataFrame:
    """`leaves` (group, doc_id, leaf, more) with `path`, their group's `subroot` and the `root`."""
    own = materialize(placed(leaves, ["doc_id", "leaf"]).withColumn("node", F.col("leaf")), "placed")
    rounds = _rounds(own)
    subroots = rounds[-1].select(
        F.lit("").alias("group"), F.col("group").alias("member"), F.col("node").alias("subroot")
    )
    members = placed(subroots, ["member"]).withColumn("node", F.col("subroot"))
    upper = _rounds(materialize(members, "members"))
    nothing = F.array().cast("array<struct<left:string,right:string>>")
    top = upper[-1].select("group", nothing.alias("path"), F.col("node").alias("root"))
    tops = _descended(upper, top).select(F.col("member").alias("group"), "path", "subroot", "root")
    return _descended(rounds, materialize(tops, "subroots")).drop("pos", "group")


def folded(start: Column, path: str = "path") -> Column:
    """The root that a leaf and its path lead to."""
    return F.aggregate(path, start, lambda node, s: _hash(s["left"], node, s["right"]))


def proof(path: str = "path") -> Column:
    """The hash of all siblings, level by level."""
    sides = F.transform(path, lambda s: F.concat(s["left"], s["right"]))
    return F.sha2(F.array_join(sides, ""), 256)


def checked(docs: DataFrame) -> DataFrame:
    """The manifest's rows, each checked against a copy of its document.

    Where 2 divides the crc32 of the id, the copy's text has lost its line feeds.
    """
    tampered = (remainder(2) == 0) & F.contains("text", F.lit("\n"))
    changed = F.when(tampered, leaf(F.replace("text", F.lit("\n"), F.lit(""))))
    rows = docs.select(group_key().alias("group"), "doc_id", leaf().alias("leaf"), changed.alias("changed"))
    rows = manifest(rows).withColumn("folded_root", folded(F.coalesce("changed", "leaf")))
    return rows.select(
        "doc_id", "leaf", "subroot", "root", proof().alias("proof_sha256"), "folded_root",
        (F.col("folded_root") == F.col("root")).alias("verified"),
    )


def _sql_crc32(text: str) -> str:
    """The unsigned crc32 of ASCII text, out of the table `crc` (t) of 256 remainders."""
    codes = f"list_transform(range(1, length({text}) + 1), lambda i: ascii(substr({text}, i::INT, 1))::BIGINT)"
    step = "lambda c, b: xor(c >> 8, crc.t[(xor(c, b) & 255) + 1])"
    return f"xor(4294967295, list_reduce(list_prepend(4294967295::BIGINT, {codes}), {step}))"


#: The table `crc`: remainders of all bytes by the reflected polynomial.
SQL_CRC = """crc AS (
  SELECT list(list_reduce(list_prepend(i, range(8)),
    lambda x, k: CASE WHEN x & 1 = 1 THEN xor(x >> 1, 3988292384) ELSE x >> 1 END) ORDER BY i) AS t
  FROM range(256) bytes(i)
)"""


def _sql_leaf(text: str) -> str:
    fields = [f"{c}::VARCHAR" for c in FIELDS[:-1]] + [text]
    parts = [f"coalesce(strlen({f}) || ':' || {f}, '-')" for f in fields]
    return f"sha256({' || '.join(parts)})"


def _sql_tree(name: str, leaves: str) -> str:
    """All nodes of the trees over `leaves` (grp, pos, n, h), by level."""
    return f"""{name} AS (
  SELECT grp, 0 AS lvl, pos, n, h FROM {leaves}
  UNION ALL
  SELECT grp, lvl + 1, pos // {ARITY}, (n + {ARITY - 1}) // {ARITY}, sha256(string_agg(h, '' ORDER BY pos))
  FROM {name} WHERE n > 1 GROUP BY grp, lvl, pos // {ARITY}, n
)"""


def _sql_paths(name: str, nodes: str, leaves: str) -> str:
    """The siblings (lvl, l, r) of every position of `leaves` in the trees `nodes`, as a list."""
    own = f"(a.pos // ({ARITY} ** s.lvl)::BIGINT)"
    return f"""{name} AS (
  SELECT grp, pos, list({{'lvl': lvl, 'l': l, 'r': r, 'h': ''}} ORDER BY lvl) AS path FROM (
    SELECT a.grp, a.pos, s.lvl,
      coalesce(string_agg(s.h, '' ORDER BY s.pos) FILTER (s.pos < {own}), '') AS l,
      coalesce(string_agg(s.h, '' ORDER BY s.pos) FILTER (s.pos > {own}), '') AS r
    FROM {leaves} a JOIN {nodes} s ON s.grp = a.grp AND s.n > 1 AND s.pos // {ARITY} = {own} // {ARITY}
    GROUP BY a.grp, a.pos, s.lvl
  ) GROUP BY grp, pos
)"""


def _sql_folded(start: str, path: str) -> str:
    zero = f"{{'lvl': -1, 'l': '', 'r': '', 'h': {start}}}"
    step = "lambda a, x: {'lvl': x.lvl, 'l': '', 'r': '', 'h': sha256(x.l || a.h || x.r)}"
    return f"list_reduce(list_prepend({zero}, {path}), {step}).h"


def sql() -> str:
    """The rows of `checked` over the table documents, by recursion over levels."""
    return f"""
WITH RECURSIVE {SQL_CRC},
docs AS (
  SELECT doc_id, coalesce('s' || source, '') AS grp, {_sql_leaf("text")} AS leaf,
    {_sql_leaf("replace(text, chr(10), '')")} AS bare,
    {_sql_crc32("doc_id::VARCHAR")} AS c
  FROM documents, crc
), leaves AS (
  SELECT *, leaf AS h, count(*) OVER (PARTITION BY grp) AS n,
    row_number() OVER (PARTITION BY grp ORDER BY doc_id NULLS FIRST, leaf) - 1 AS pos
  FROM docs
), {_sql_tree("nodes", "leaves")},
subs AS (
  SELECT grp AS member, h, '' AS grp, count(*) OVER () AS n, row_number() OVER (ORDER BY grp) - 1 AS pos
  FROM nodes WHERE n = 1
), {_sql_tree("upper_nodes", "subs")},
{_sql_paths("paths", "nodes", "leaves")},
{_sql_paths("upper_paths", "upper_nodes", "subs")},
whole AS (
  SELECT d.doc_id, d.leaf, CASE WHEN d.doc_id IS NOT NULL AND d.c % 2 = 0 THEN d.bare ELSE d.leaf END AS used, s.h AS subroot,
    (SELECT h FROM upper_nodes WHERE n = 1) AS root,
    list_concat(coalesce(p.path, []), coalesce(u.path, [])) AS path
  FROM leaves d JOIN subs s ON s.member = d.grp
  LEFT JOIN paths p ON p.grp = d.grp AND p.pos = d.pos LEFT JOIN upper_paths u ON u.pos = s.pos
)
SELECT doc_id, leaf, subroot, root, folded_root, folded_root = root AS verified,
  sha256(list_reduce(list_prepend('', list_transform(path, lambda x: x.l || x.r)), lambda a, b: a || b)) AS proof_sha256
FROM (SELECT *, {_sql_folded("used", "path")} AS folded_root FROM whole)
"""
