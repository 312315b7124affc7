"""Mixing sources to target weights.

Sources are the leaves of a tree: domain, language, source. The token budget is passed down
by the children's weights. A child that has fewer tokens than its share, counting every
epoch it may be read, takes what it has; what is left over goes to its siblings by weight,
and only what a whole family can't take has already gone to the families beside it. Tokens
that rounding leaves go to children with tokens left, one each. Each leaf then reads as many
whole epochs as its budget allows and a prefix of one more, in an order that a hash of seed,
epoch and id gives. The prefix is one of tokens: it ends within the document that crosses
the budget, so budgets are used up to the token. `mixed` says how many tokens of a document
are read; `drawn` keeps the document that crosses the budget whole.

The order is never sorted as a whole: tokens are summed by leaf and the hash's first three
digits, and only the documents of the digits within which a leaf's prefix ends are put in
order. That yields one cut per leaf, and a document is in the prefix if its hash isn't above
the cut. So a leaf with a third of all rows costs no more than many small ones, and texts
are never shuffled. Rows that repeat an id have a number in the hash besides, which is their
place among them by leaf and text, so they are spread like any others. Everything is
built-in functions.

A missing language or source has the empty name, a missing text no tokens, a missing id is
the empty id. Documents without tokens go with whole epochs and where the prefix reaches
them. An empty table gives an empty result. Only doc_id, text, lang and source are read.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gridspan.llm.frames import placed, sized
from gridspan.llm.statistics import WHITE
from gridspan.session import materialize

LEVELS = ["domain", "lang", "source"]
#: Leaves sent to all tasks, some 100 bytes each; more are joined by a shuffle.
BROADCAST_LEAVES = 50_000
#: Repeated ids, and rows that have one, sent to all tasks.
BROADCAST_REPEATS = 200_000
#: Hexadecimal digits by which a leaf's hashes are summed.
DIGITS = 3


@dataclass(frozen=True)
class Mixture:
    """Target weights, whole numbers, and what is to be read in all."""

    domains: dict[str, int] = field(default_factory=lambda: {"web": 5, "books": 3, "forum": 2})
    languages: dict[str, int] = field(default_factory=lambda: {"en": 5, "de": 2, "fr": 2, "es": 1})
    default: int = 1
    percent: int = 60  # budget, as a percentage of all tokens
    epochs: int = 2
    seed: int = 17

    def weight(self, level: str) -> Column:
        known = {"domain": self.domains, "lang": self.languages}.get(level, {})
        out = F.lit(self.default)
        for name, weight in known.items():
            out = F.when(F.col(level) == name, weight).otherwise(out)
        return out


#: Domains by a source's number; the tables name none.
DOMAIN_NAMES = ["web", "books", "forum"]


def domain() -> Column:
    number = F.regexp_extract("source", "([0-9]{1,6})$", 1)
    of = F.element_at(F.array(*map(F.lit, DOMAIN_NAMES)), F.try_to_number(number, F.lit("999999")).cast("int") % 3 + 1)
    return F.when(number == "", "other").otherwise(of)


def n_tokens() -> Column:
    core = F.btrim("text", F.lit(WHITE))
    count = F.size(F.split(core, r"[\x20\x09-\x0D]+"))
    return F.when(F.coalesce(core, F.lit("")) == "", 0).otherwise(count).cast("bigint")


def _id() -> Column:
    return F.coalesce(F.col("doc_id").cast("string"), F.lit(""))


def with_copy(docs: DataFrame) -> DataFrame:
    """`docs` with `copy`: 0, or a row's place among those that repeat its id.

    Only where ids repeat is a numbered copy of the table stored, and its rows are put in
    order by ranges, however many share an id.
    """
    repeats = docs.groupBy(_id().alias("group")).agg(F.count(F.lit(1)).alias("c")).filter("c > 1")
    repeats = materialize(repeats.select("group"), "repeated-ids")
    if repeats.isEmpty():
        return docs.withColumn("copy", F.lit(0).cast("bigint"))
    rows = materialize(docs.withColumn("row", F.monotonically_increasing_id()), "numbered")
    own = rows.select(
        _id().alias("group"), *[F.coalesce(c, F.lit("")).alias(c) for c in ("lang", "source")],
        F.md5(F.coalesce("text", F.lit(""))).alias("text"), "row",
    )
    own = own.join(sized(repeats, BROADCAST_REPEATS), "group", "left_semi")
    copies = placed(own, ["lang", "source", "text", "row"])
    copies = materialize(copies.select("row", F.col("pos").alias("copy")), "copies")
    rows = rows.join(sized(copies, BROADCAST_REPEATS), "row", "left").drop("row")
    return rows.withColumn("copy", F.coalesce("copy", F.lit(0)).cast("bigint"))


def described(docs: DataFrame) -> DataFrame:
    """(doc_id, copy, domain, lang, source, n_tokens) of every row."""
    named = [F.coalesce(c, F.lit("")).alias(c) for c in ("lang", "source")]
    out = with_copy(docs.select("doc_id", "text", "lang", "source"))
    out = out.select("doc_id", "copy", *named, n_tokens().alias("n_tokens"))
    return out.select("doc_id", "copy", domain().alias("domain"), "lang", "source", "n_tokens")


def shared_out(children: DataFrame, parent: list[str]) -> DataFrame:
    """Adds `budget` to children with `capacity`, `weight` and their parent's `given`.

    Children in order of capacity by weight: as long as one has less than its share of what
    is left, it takes all it has. The share per weight then rises to its largest value. What
    is lost in rounding is less than a token for each child that has some left.
    """
    name = children.columns[0]
    family = Window.partitionBy(*(parent or [F.lit(0)]))
    order = family.orderBy(F.col("capacity") / F.col("weight"), name)
    before = order.rowsBetween(Window.unboundedPreceding, -1)

    def sum_before(column: str) -> Column:
        return F.coalesce(F.sum(column).over(before), F.lit(0))

    left = (F.col("given") - sum_before("capacity")).alias("left")
    weights = (F.sum("weight").over(family) - sum_before("weight")).alias("weights")
    children = children.withColumn("share", F.struct((left / weights).alias("share"), left, weights))
    children = children.withColumn("most", F.max("share").over(family))
    by_weight = F.expr("(weight * most.left) div most.weights")  # exact, unlike a quotient
    budget = F.greatest(F.least(F.col("capacity"), by_weight), F.lit(0))
    children = children.withColumn("budget", budget).drop("share", "most")
    able = F.least(F.col("given"), F.sum("capacity").over(family))
    lost = able - F.sum("budget").over(family)
    open_first = family.orderBy(F.col("capacity") <= F.col("budget"), name)
    children = children.withColumn("lost", lost).withColumn("turn", F.row_number().over(open_first))
    more = (F.col("turn") <= F.col("lost")) & (F.col("budget") < F.col("capacity"))
    return children.withColumn("budget", F.col("budget") + more.cast("int")).drop("lost", "turn")


def budgets(leaves: DataFrame, mixture: Mixture) -> DataFrame:
    """(domain, lang, source, tokens, budget) out of leaves with their tokens."""
    given = leaves.agg(
        F.floor(F.coalesce(F.sum("tokens"), F.lit(0)) * mixture.percent / 100).alias("given")
    )
    # One row, so the join with it multiplies nothing.
    level, parent = leaves.select(*LEVELS, "tokens").join(F.broadcast(given)), []
    for depth, name in enumerate(LEVELS):
        keys = LEVELS[: depth + 1]
        capacity = (F.sum("tokens") * mixture.epochs).alias("capacity")
        children = level.groupBy(name, *parent, "given").agg(capacity)
        children = children.withColumn("weight", mixture.weight(name))
        out = shared_out(children, parent).select(*keys, F.col("budget").alias("given"))
        level = level.drop("given").join(out, keys)
        parent = keys
    return level.withColumnRenamed("given", "budget")


def _hash(mixture: Mixture) -> Column:
    """The document's place in its leaf's last epoch."""
    epoch, copy = F.col("whole").cast("string"), F.col("copy").cast("string")
    return F.md5(F.concat_ws(":", F.lit(str(mixture.seed)), epoch, _id(), copy))


def cuts(docs: DataFrame, mixture: Mixture) -> DataFrame:
    """(domain, lang, source, budget, whole, cut, cut_tokens) of every leaf, a stored table.

    Of the epoch after `whole` ones documents with a hash below `cut` are read, and of the
    one with that hash `cut_tokens` tokens. Without a cut, none is.
    """
    leaves = docs.groupBy(*LEVELS).agg(F.sum("n_tokens").alias("tokens"))
    own = budgets(materialize(leaves, "leaves"), mixture)
    whole = F.when(F.col("tokens") > 0, F.floor(F.col("budget") / F.col("tokens"))).otherwise(0)
    own = own.withColumn("whole", whole.cast("int"))
    own = own.withColumn("rest", F.col("budget") - F.col("whole") * F.col("tokens"))
    own = materialize(own, "budgets")
    rows = docs.join(sized(own.drop("tokens"), BROADCAST_LEAVES), LEVELS).filter("rest > 0")
    rows = rows.withColumn("h", _hash(mixture)).withColumn("digits", F.substring("h", 1, DIGITS))
    sums = rows.groupBy(*LEVELS, "digits", "rest").agg(F.sum("n_tokens").alias("n"))
    total = F.sum("n").over(Window.partitionBy(*LEVELS).orderBy("digits"))
    # Less than all tokens are left to be read, so the sum reaches them in some digits.
    last = sums.withColumn("total", total).filter("total >= rest").groupBy(*LEVELS).agg(
        F.min_by(F.struct("digits", (F.col("total") - F.col("n")).alias("before")), "digits").alias("e")
    )
    last = materialize(last.select(*LEVELS, "e.digits", "e.before"), "edges")
    inside = rows.join(sized(last, BROADCAST_LEAVES), [*LEVELS, "digits"])
    order = Window.partitionBy(*LEVELS).orderBy("h").rangeBetween(Window.unboundedPreceding, 0)
    reached = F.col("before") + F.sum("n_tokens").over(order)
    inside = inside.withColumn("over", reached - F.col("rest")).filter("over >= 0")
    crossing = F.struct("h", (F.col("n_tokens") - F.col("over")).alias("cut_tokens"))
    crossing = inside.groupBy(*LEVELS).agg(F.min(crossing).alias("c"))
    crossing = crossing.select(*LEVELS, F.col("c.h").alias("cut"), "c.cut_tokens")
    out = own.join(crossing, LEVELS, "left")
    return materialize(out.select(*LEVELS, "budget", "whole", "cut", "cut_tokens"), "cuts")


def _times(mixture: Mixture) -> Column:
    """In how many epochs some of a document is read, beside the columns of `cuts`."""
    return F.col("whole") + F.coalesce(_hash(mixture) <= F.col("cut"), F.lit(False)).cast("int")


def mixed(docs: DataFrame, mixture: Mixture = Mixture()) -> DataFrame:
    """Every row's leaf, tokens, the leaf's budget, and what is read of the row.

    `epochs` counts those in which some of it is read, `tokens_read` the tokens in all.
    """
    own = materialize(described(docs), "described")
    rows = own.join(sized(cuts(own, mixture), BROADCAST_LEAVES), LEVELS)
    rows = rows.withColumn("h", _hash(mixture))
    part = F.when(F.col("h") < F.col("cut"), F.col("n_tokens"))
    part = part.when(F.col("h") == F.col("cut"), F.col("cut_tokens")).otherwise(0)
    return rows.select(
        "doc_id", *LEVELS, "n_tokens", "budget", _times(mixture).alias("epochs"),
        (F.col("whole") * F.col("n_tokens") + part).alias("tokens_read"),
    )


def drawn(docs: DataFrame, mixture: Mixture) -> DataFrame:
    """The rows of `docs` that are read, once for each epoch, with their own columns.

    A leaf's last document is kept whole where its budget ends.
    """
    names = [f"_c{i}" for i in range(len(docs.columns))]
    at = {c: names[docs.columns.index(c)] for c in ("doc_id", "lang", "source", "text")}
    plain = docs.toDF(*names).select(*names, *[F.col(n).alias(c) for c, n in at.items()])
    plain = with_copy(plain).withColumns({c: F.coalesce(c, F.lit("")) for c in ("lang", "source")})
    plain = plain.withColumn("domain", domain())
    own = plain.select("doc_id", "copy", *LEVELS, n_tokens().alias("n_tokens"))
    leaves = cuts(materialize(own, "described"), mixture)
    leaves = leaves.select(*[F.col(c).alias(f"_{c}") for c in LEVELS], "whole", "cut")
    same = [F.col(c) == F.col(f"_{c}") for c in LEVELS]
    rows = plain.join(sized(leaves, BROADCAST_LEAVES), same[0] & same[1] & same[2])
    rows = rows.withColumn("_times", _times(mixture)).filter("_times > 0")
    again = F.explode(F.sequence(F.lit(1), F.col("_times")))
    return rows.select(*names, again.alias("_again")).select(*names).toDF(*docs.columns)


def _case(column: str, weights: dict[str, int], default: int) -> str:
    whens = " ".join(f"WHEN {column} = '{k}' THEN {v}" for k, v in weights.items())
    return f"CASE {whens} ELSE {default} END" if weights else str(default)


#: Rounds in which the SQL closes children; a family has fewer children.
ROUNDS = 60


def _sql_level(depth: int, mixture: Mixture) -> str:
    """Budgets of one level by rounds: children that can't take their share close, until none does."""
    known = {"domain": mixture.domains, "lang": mixture.languages}
    name, keys = LEVELS[depth], ", ".join(LEVELS[: depth + 1])
    parent, weight = ", ".join(LEVELS[:depth]) or "1", _case(name, known.get(name, {}), mixture.default)
    closed = "coalesce(sum(capacity) FILTER (shut) OVER f, 0)"
    return f"""rounds{depth} AS (
  SELECT *, false AS shut, 0 AS l, 0 AS w, 0 AS round FROM (
    SELECT {keys}, given, sum(tokens)::BIGINT * {mixture.epochs} AS capacity, {weight} AS weight
    FROM level{depth} GROUP BY {keys}, given)
  UNION ALL
  SELECT {keys}, given, capacity, weight, shut OR capacity * w <= weight * l, l, w, round FROM (
    SELECT {keys}, given, capacity, weight, shut, (given - {closed})::BIGINT AS l,
      (sum(weight) FILTER (NOT shut) OVER f)::BIGINT AS w, round + 1 AS round
    FROM rounds{depth} WHERE round < {ROUNDS} WINDOW f AS (PARTITION BY {parent}))
), handed{depth} AS (
  SELECT *, greatest(0, CASE WHEN shut THEN capacity ELSE weight * l // w END) AS got
  FROM rounds{depth} WHERE round = {ROUNDS}
), budgets{depth} AS (
  SELECT {keys}, (got + (got < capacity AND row_number() OVER (PARTITION BY {parent} ORDER BY got >= capacity, {name})
    <= least(given, sum(capacity) OVER f) - sum(got) OVER f)::INT)::BIGINT AS given
  FROM handed{depth} WINDOW f AS (PARTITION BY {parent})
), level{depth + 1} AS (
  SELECT l.* EXCLUDE (given), b.given FROM level{depth} l JOIN budgets{depth} b USING ({keys})
)"""


def sql(mixture: Mixture = Mixture()) -> str:
    """The rows of `mixed` over the table documents, in SQL; for families of under ROUNDS children."""
    levels = ", ".join(_sql_level(depth, mixture) for depth in range(len(LEVELS)))
    return rf"""
WITH RECURSIVE described AS (
  SELECT doc_id, CASE WHEN regexp_extract(coalesce(source, ''), '([0-9]{{1,6}})$', 1) = '' THEN 'other' ELSE
         ['web', 'books', 'forum'][regexp_extract(source, '([0-9]{{1,6}})$', 1)::INT % 3 + 1] END AS domain,
         coalesce(lang, '') AS lang, coalesce(source, '') AS source,
         len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS n_tokens,
         row_number() OVER (PARTITION BY doc_id ORDER BY coalesce(lang, ''), coalesce(source, ''), md5(coalesce(text, ''))) - 1 AS copy
  FROM documents
), leaves AS (
  SELECT domain, lang, source, sum(n_tokens)::BIGINT AS tokens FROM described GROUP BY ALL
), level0 AS (
  SELECT *, (SELECT sum(tokens)::BIGINT * {mixture.percent} // 100 FROM leaves) AS given FROM leaves
), {levels}, epochs AS (
  SELECT d.*, given AS budget, tokens, e.epoch,
         md5('{mixture.seed}:' || e.epoch || ':' || coalesce(doc_id::VARCHAR, '') || ':' || copy) AS h
  FROM described d JOIN level3 USING (domain, lang, source), (SELECT unnest(range({mixture.epochs})) AS epoch) e
), streamed AS (
  SELECT *, sum(n_tokens) OVER (PARTITION BY domain, lang, source ORDER BY epoch, h) - n_tokens AS before FROM epochs
)
SELECT doc_id, domain, lang, source, n_tokens, budget,
       count(*) FILTER (before < budget OR epoch < budget // nullif(tokens, 0))::INT AS epochs,
       sum(greatest(0, least(n_tokens, budget - before)))::BIGINT AS tokens_read
FROM streamed GROUP BY doc_id, copy, domain, lang, source, n_tokens, budget
"""
