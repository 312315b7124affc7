"""License scan by diagonal voting.

Every rolling word 2-gram and 4-gram hash of every text is joined with the grams of the
templates; short notices, of which an edit may leave no 4-gram, have 2-grams too. A hit
votes for a diagonal: text position minus template position. Votes are counted per text,
template and diagonal before any shuffle; diagonals near to each other are merged into
spans, so a notice with a word put in or left out stays one span; and each span is held
against the words of its text: most words of the notice, all that tell it from other
licenses, and none that names another. Base phrases are templates that must match word by
word, and each of their places is a span of its own.

A missing text is an empty one; without words all counts are 0 and the labels empty. Rows
that repeat an id and text get equal results, rows that repeat an id with another text
their own. Only doc_id and text of the input are read.
"""

from __future__ import annotations

from collections.abc import Iterator
from difflib import SequenceMatcher

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from gridspan.llm.frames import lists, slices
from gridspan.llm.words import NON_WORD, gram_hashes, words
from gridspan.session import materialize

#: Base phrases and their labels.
BASE = {
    "gnu general public license": "gpl",
    "apache license": "apache",
    "cc by": "cc-by",
    "mit license": "mit",
}

_GPL_HEADER = (
    "this program is free software you can redistribute it and or modify it under the terms "
    "of the gnu general public license as published by the free software foundation"
)
_OR_LATER = "either version {} of the license or at your option any later version"

#: Words of published license names, notices and grants, and labels.
NOTICES = {
    "licensed under the apache license version 2 0": "apache-2.0",
    "licensed under the apache license version 2 0 the license you may not use this file "
    "except in compliance with the license": "apache-2.0",
    "licensed under the gnu general public license version 2": "gpl-2.0",
    "licensed under the gnu general public license version 3": "gpl-3.0",
    _GPL_HEADER: "gpl-notice",
    f"{_GPL_HEADER} {_OR_LATER.format(2)}": "gpl-2.0",
    f"{_GPL_HEADER} {_OR_LATER.format(3)}": "gpl-3.0",
    "gnu lesser general public license": "lgpl",
    "gnu lesser public license": "lgpl",
    "permission is hereby granted free of charge to any person obtaining a copy of this "
    "software and associated documentation files the software to deal in the software "
    "without restriction": "mit-notice",
    "including without limitation the rights to use copy modify merge publish distribute "
    "sublicense and or sell copies of the software and to permit persons to whom the software "
    "is furnished to do so subject to the following conditions the above copyright notice and "
    "this permission notice shall be included in all copies or substantial portions of the "
    "software": "mit-notice",
    "released under the mit license": "mit-notice",
    "redistribution and use in source and binary forms with or without modification are "
    "permitted provided that the following conditions are met": "bsd-notice",
    "neither the name of the copyright holder nor the names of its contributors may be used to "
    "endorse or promote products derived from this software without specific prior written "
    "permission": "bsd-3-clause",
    "bsd 3 clause license": "bsd-3-clause",
    "bsd 2 clause license": "bsd-2-clause",
    "permission to use copy modify and or distribute this software for any purpose with or "
    "without fee is hereby granted": "isc-notice",
    "this source code form is subject to the terms of the mozilla public license v 2 0": "mpl-2.0",
    "licensed under cc by nc 4 0": "cc-by-nc",
    "licensed under cc by sa 4 0": "cc-by-sa",
    "licensed under a creative commons attribution 4 0 international license": "cc-by-4.0",
    "this is free and unencumbered software released into the public domain": "unlicense",
    "to the extent possible under law the author has waived all copyright and related or "
    "neighboring rights": "cc0-1.0",
}

#: Identifiers of licenses as they stand in a tagged line, which are labels too.
IDENTIFIERS = [
    "mit", "isc", "apache-2.0", "bsd-2-clause", "bsd-3-clause", "gpl-2.0", "gpl-3.0", "lgpl-2.1",
    "lgpl-3.0", "agpl-3.0", "mpl-2.0", "epl-2.0", "cc-by-4.0", "cc-by-sa-4.0", "cc0-1.0", "unlicense",
    "zlib", "bsl-1.0",
]
NOTICES |= {
    "spdx license identifier " + i.replace("-", " ").replace(".", " "): i for i in IDENTIFIERS
}

#: Names and versions that stand in each other's place in license notices.
VARIANTS = [
    ["gnu general public license", "gnu lesser general public license", "gnu lesser public license",
     "gnu library general public license", "gnu affero general public license"],
    ["apache license", "educational community license"],
    ["mozilla public license", "common public license"],
    ["mit license", "bsd license", "isc license", "zlib license"],
    ["cc by nc 4", "cc by sa 4", "cc by nd 4", "cc by nc sa 4", "cc by nc nd 4", "cc by 4"],
    ["attribution 4", "attribution noncommercial 4", "attribution non commercial 4",
     "attribution sharealike 4", "attribution share alike 4", "attribution noderivatives 4",
     "attribution noderivs 4", "attribution no derivatives 4", "attribution no derivs 4"],
    ["version 2", "version 3", "version 1"],
    ["version 2 0", "version 1 1"],
    ["v 2 0", "v 1 1"],
    ["4 0 international", "3 0 international"],
    ["deal in the software", "deal with the software"],
    ["modify and or distribute this software for any purpose with or without fee",
     "modify and distribute this software for any purpose and without fee"],
]
#: A needed number stands at its place behind the words of its notice, or follows one of
#: these ("version 2 or 3"), so that the number of a section isn't taken for a version.
BEFORE_NUMBER = {"v", "version", "or", "and"}

GRAMS = (2, 4)
#: Diagonals this far apart may be merged, over a gap of as many words.
DRIFT = 3
#: Share of a notice's words that a span must hold, in order.
LEAST_SHARE = 0.8
#: A stretch of text held against a notice has so many times its words at most.
STRETCH = 4
#: Up to so many spans (under 10 MB) are sent to all tasks; more are joined by a shuffle.
BROADCAST_SPANS = 100_000
#: Templates are sent to all tasks up to so many grams.
BROADCAST_GRAMS = 200_000

_TO_SPACE = bytes(0x20 if b in NON_WORD else b for b in range(256))


def word_list(text: bytes) -> list[bytes]:
    return text.lower().translate(_TO_SPACE).split()


def templates() -> list[tuple[list[bytes], str, bool]]:
    """(words, label, whether it must match word by word)."""
    return [(word_list(p.encode()), label, True) for p, label in BASE.items()] + [
        (word_list(p.encode()), label, False) for p, label in NOTICES.items()
    ]


def rivals() -> list[tuple[str, str]]:
    """(words, label) of all notices, and of others that a variant in its place makes of them."""
    out = dict(NOTICES)
    for notice in NOTICES:
        for group in VARIANTS:
            for name in group:
                if f" {name} " in f" {notice} ":
                    for other in group:
                        # A name within a longer one ("cc by nc 4") stands for itself only.
                        out.setdefault(f" {notice} ".replace(f" {name} ", f" {other} ").strip(), "")
    return list(out.items())


def _differences(a: list[bytes], b: list[bytes]) -> tuple[list[bytes], list[bytes]]:
    """Words of each that have no like word in the other, in order."""
    ours, theirs = [], []
    for kind, i, j, k, m in SequenceMatcher(None, a, b, autojunk=False).get_opcodes():
        if kind != "equal":
            ours += a[i:j]
            theirs += b[k:m]
    return ours, theirs


def telling() -> tuple[dict[str, set[bytes]], dict[str, set[bytes]]]:
    """By label the words that a span of its notices must hold, and those that it must not.

    They are the differences from notices of other licenses that are so much alike that the
    share of common words alone couldn't tell them apart. A number is no word that must not
    stand in a span, as two versions may be named at once.
    """
    needed: dict[str, set[bytes]] = {}
    barred: dict[str, set[bytes]] = {}
    others = [(word_list(t.encode()), label) for t, label in rivals()]
    for notice, label in NOTICES.items():
        own = word_list(notice.encode())
        for rival, theirs in others:
            if theirs != label:
                mine, extra = _differences(own, rival)
                if max(len(mine) / len(own), len(extra) / len(rival)) <= 1 - LEAST_SHARE + 1e-9:
                    needed.setdefault(label, set()).update(set(mine) - set(rival))
                    more = {w for w in set(extra) - set(own) if not w.isdigit()}
                    barred.setdefault(label, set()).update(more)
    return needed, barred


def _sizes(n_words: int, exact: bool) -> list[int]:
    """The grams a template needs to leave one with as many words changed or missing as it may."""
    short, long = GRAMS
    if n_words < long:
        return [short]
    # Words that may differ, and whether those beside them can be without `long` in a row.
    edits = 0
    while not exact and (n_words - edits - 1) / n_words >= LEAST_SHARE:
        edits += 1
    broken = (long - 1) * (edits + 1) >= n_words - edits
    return [short, long] if edits and broken else [long]


def template_grams(spark: SparkSession) -> DataFrame:
    """Each template's grams."""
    rows = []
    for i, (own, _, exact) in enumerate(templates()):
        for k in _sizes(len(own), exact):
            hashes = gram_hashes(words([b" ".join(own)], NON_WORD).hashes(), k).astype(np.int64)
            rows += [(int(h), i, at, k, exact) for at, h in enumerate(hashes)]
    frame = spark.createDataFrame(
        rows, "gram long, template int, template_at int, k int, exact boolean"
    )
    return F.broadcast(frame) if len(rows) <= BROADCAST_GRAMS else frame


def _grams(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per text the hashes of all 2-grams, and behind them those of all 4-grams."""
    for batch in batches:
        for part, texts in slices(batch, "text"):
            table = words(texts, NON_WORD)
            hashes, first = table.hashes(), table.first.tolist()
            out, counts = [], []
            for a, b in zip(first, first[1:]):
                own = [gram_hashes(hashes[a:b], k) for k in GRAMS]
                out += own
                counts.append(sum(map(len, own)))
            grams = np.concatenate(out).astype(np.int64)
            yield pa.RecordBatch.from_arrays(
                [part.column(0), part.column(1), pa.array(table.counts.astype(np.int64)),
                 lists(grams, np.array(counts))],
                ["doc_id", "h", "n_words", "grams"],
            )


def _keyed(docs: DataFrame) -> DataFrame:
    return docs.select("doc_id", F.xxhash64("text").alias("h"), "text")


def spans(docs: DataFrame) -> DataFrame:
    """Voted spans (doc_id, h, template, first, last), not yet verified; h goes with the text."""
    key = ["doc_id", "h", "template"]
    id_type = docs.schema["doc_id"].dataType.simpleString()
    grams = _keyed(docs).mapInArrow(
        _grams, f"doc_id {id_type}, h long, n_words long, grams array<long>"
    )
    hits = grams.select(
        "doc_id", "h", "n_words", F.posexplode("grams").alias("at", "gram")
    ).join(template_grams(docs.sparkSession), "gram")
    two_grams = F.greatest(F.col("n_words") - (GRAMS[0] - 1), F.lit(0))
    at = F.col("at") - F.when(F.col("k") == GRAMS[1], two_grams).otherwise(0)
    votes = (
        hits.withColumn("at", at)
        .withColumn("diagonal", F.col("at") - F.col("template_at"))
        .groupBy(*key, "diagonal", "exact")
        .agg(F.min("at").alias("first"), F.max(F.col("at") + F.col("k") - 1).alias("last"))
    )
    # A document's votes for one template; there are at most as many as it has words.
    order = Window.partitionBy(*key).orderBy("first", "diagonal")
    reach = F.max("last").over(order.rowsBetween(Window.unboundedPreceding, -1))
    drift = F.abs(F.col("diagonal") - F.lag("diagonal").over(order))
    joined = ~F.col("exact") & (drift <= DRIFT) & (F.col("first") <= reach + DRIFT)
    parts = votes.withColumn("new", (~F.coalesce(joined, F.lit(False))).cast("int"))
    return (
        parts.withColumn("part", F.sum("new").over(order))
        .groupBy(*key, "part")
        .agg(F.min("first").alias("first"), F.max("last").alias("last"))
        .drop("part")
    )


NEEDED, BARRED = telling()
_BEFORE_NUMBER = frozenset(w.encode() for w in BEFORE_NUMBER)


def _share(own: list[bytes], template: list[bytes], label: str) -> float:
    """The share of the template's words that stand in `own`, in order.

    0 if a word is missing that the notice needs, or one within it names another license.
    """
    needed = NEEDED.get(label, set()).intersection(template)
    if not needed.issubset(own):
        return 0.0
    blocks = SequenceMatcher(None, own, template, autojunk=False).get_matching_blocks()
    held = [(b.a + i, b.b + i) for b in blocks for i in range(b.size)]
    found, last = set(), None
    for i, j in held:
        between = own[last[0] + 1 : i] if last else []
        put_in = last and i - last[0] > j - last[1] or any(map(bytes.isdigit, between))
        if not own[i].isdigit() or not put_in or own[i - 1] in _BEFORE_NUMBER:
            found.add(own[i])
        last = i, j
    if not needed.issubset(found):
        return 0.0
    barred = BARRED.get(label, set())
    if held and not barred.isdisjoint(own[held[0][0] : held[-1][0] + 1]):
        return 0.0
    return len(held) / len(template)


def _best_share(own: list[bytes], template: list[bytes], label: str) -> float:
    """The largest share in any stretch of `own`, or the first that is large enough.

    A span may hold some of the notice's words more than once, so that a stretch has to begin
    with the notice for its words to be found in order.
    """
    most, width = 0.0, STRETCH * len(template)
    starts = [i for i, word in enumerate(own) if word in template]
    for a in [0, *starts]:
        most = max(most, _share(own[a : a + width], template, label))
        if most >= LEAST_SHARE:
            break
    return most


def verdict(text: bytes, found: list[dict]) -> tuple:
    """What the verified spans of one text say: the columns after doc_id."""
    own = word_list(text)
    base, places, labels, score = set(), [], set(), 0.0
    known = templates()
    for span in found:
        template, label, exact = known[span["template"]]
        a, b = span["first"], span["last"] + 1
        if exact:
            if own[a : a + len(template)] == template:
                base.add(label)
                places.append(a)
                score = 1.0
            continue
        # A gram may miss the words at either end of a notice by its own length.
        near = own[max(0, a - GRAMS[1]) : b + GRAMS[1]]
        if (share := _best_share(near, template, label)) >= LEAST_SHARE:
            labels.add(label)
            score = max(score, share)
    return (
        len(own), len(places), min(places, default=None), max(places, default=None),
        ",".join(sorted(base)), ",".join(sorted(base | labels)), score,
    )


def _verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    kinds = [pa.int64()] * 4 + [pa.string()] * 2 + [pa.float64()]
    names = ["n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score"]
    for batch in batches:
        for part, texts in slices(batch, "text"):
            found = part.column(part.schema.get_field_index("spans")).to_pylist()
            rows = [verdict(t, f or []) for t, f in zip(texts, found)]
            columns = [pa.array(c, kind) for c, kind in zip(zip(*rows), kinds)]
            yield pa.RecordBatch.from_arrays([part.column(0), *columns], ["doc_id", *names])


def scan(docs: DataFrame) -> DataFrame:
    """Per row of `docs`: word count, places and labels of license phrases, labels of notices."""
    found = materialize(spans(docs), "license-spans")
    small = found.count() <= BROADCAST_SPANS
    by_text = found.groupBy("doc_id", "h").agg(
        F.collect_list(F.struct("template", "first", "last")).alias("spans")
    )
    by_text = by_text.select(F.col("doc_id").alias("span_id"), F.col("h").alias("span_h"), "spans")
    keyed = _keyed(docs)
    same = keyed["doc_id"].eqNullSafe(by_text["span_id"]) & (keyed["h"] == by_text["span_h"])
    both = keyed.join(F.broadcast(by_text) if small else by_text, same, "left")
    id_type = docs.schema["doc_id"].dataType.simpleString()
    return both.select("doc_id", "text", "spans").mapInArrow(
        _verify,
        f"doc_id {id_type}, n_words long, n_base long, first_word long, last_word long, "
        "base_labels string, labels string, score double",
    )
