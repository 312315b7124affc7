from __future__ import annotations

import itertools
import random
import re

import pytest

from gridspan.llm import licenses

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def base(text):
    lower = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    own = WORD.findall(lower)
    places, labels = [], set()
    for phrase, label in licenses.BASE.items():
        want = phrase.split()
        for i in range(len(own) - len(want) + 1):
            if own[i : i + len(want)] == want:
                places.append(i)
                labels.add(label)
    return (len(own), len(places), min(places, default=None), max(places, default=None),
            ",".join(sorted(labels)))


def corpus():
    rng = random.Random(5)
    some = ["Apache", "License,", "MIT", "license.", "GNU", "General-Public", "LICENSE", "cc", "by",
            "É", "ünder", "2.0", "\n", "apache license", "CC BY-NC 4.0", "xMIT"]
    out = [(i, " ".join(rng.choice(some) for _ in range(rng.randint(0, 60)))) for i in range(300)]
    return out + [(900, None), (901, ""), (901, ""), (None, "MIT license"), (903, "GNU General"),
                  (903, "the MIT license"), (904, "mit license " * 20000), (905, "cc by"),
                  (906, "!!! ...")]


def test_base_equals_brute_force(spark):
    rows = corpus()
    docs = spark.createDataFrame([(*r, 1) for r in rows], "doc_id long, text string, n_words int")
    got = licenses.scan(docs).select(
        "doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels"
    ).collect()
    assert sorted(map(str, map(tuple, got))) == sorted(str((i, *base(t))) for i, t in rows)


@pytest.mark.parametrize("limit", [0, 100_000])
def test_notices_survive_small_edits(spark, monkeypatch, limit):
    monkeypatch.setattr(licenses, "BROADCAST_SPANS", limit)
    notice = next(k for k, v in licenses.NOTICES.items() if v == "bsd-notice")
    own = notice.split()
    edited = " ".join(["lorem"] * 30 + own[:9] + ["surplus"] + own[9:12] + own[13:] + ["x"] * 9)
    half = " ".join(own[:8])
    docs = spark.createDataFrame([(1, edited), (2, half), (3, "x " + notice.upper())],
                                 "doc_id long, text string")
    got = {r.doc_id: (r.labels, r.score) for r in licenses.scan(docs).collect()}
    assert got[1][0] == "bsd-notice" and 0.8 <= got[1][1] < 1
    assert got[2] == ("", 0.0)
    assert got[3] == ("bsd-notice", 1.0)


#: Texts beside the notices, and all labels they should get.
NEIGHBOURS = {
    "Licensed under CC BY 4.0.": "cc-by",
    "Licensed under CC BY-NC 4.0.": "cc-by,cc-by-nc",
    "Licensed under CC BY-SA 4.0.": "cc-by,cc-by-sa",
    "Licensed under CC BY-SA 3.0.": "cc-by,cc-by-sa",
    "Licensed under CC BY-ND 4.0.": "cc-by",
    "Licensed under CC BY-NC-SA 4.0.": "cc-by",
    "Licensed under CC BY-NC-ND 4.0.": "cc-by",
    "Licensed under a Creative Commons Attribution 4.0 International License": "cc-by-4.0",
    "Licensed under a Creative Commons Attribution 3.0 International License": "",
    "Licensed under a Creative Commons Attribution-ShareAlike 4.0 International License": "",
    "Licensed under a Creative Commons Attribution-NonCommercial 4.0 International License": "",
    "Licensed under the GNU General Public License, version 3.": "gpl,gpl-3.0",
    "Licensed under the GNU General Public License, version 2.": "gpl,gpl-2.0",
    "Licensed under the GNU General Public License, version 1.": "gpl",
    "Licensed under the GNU General Public License, version 2, section 3": "gpl,gpl-2.0",
    "Licensed under the GNU General Public License, version 2 or 3": "gpl,gpl-2.0,gpl-3.0",
    "BSD 3-Clause License": "bsd-3-clause",
    "BSD 2-Clause License": "bsd-2-clause",
    "SPDX-License-Identifier: MIT": "mit",
    "SPDX-License-Identifier: Apache-2.0": "apache-2.0",
    "SPDX-License-Identifier: GPL-2.0-only": "gpl-2.0",
    "SPDX-License-Identifier: LGPL-2.1": "lgpl-2.1",
    "SPDX-License-Identifier: AGPL-3.0": "agpl-3.0",
    "SPDX-License-Identifier: BSD-3-Clause": "bsd-3-clause",
    "SPDX-License-Identifier: CC-BY-4.0": "cc-by,cc-by-4.0",
    "SPDX-License-Identifier: CC-BY-SA-4.0": "cc-by,cc-by-sa-4.0",
    "SPDX-License-Identifier: Python-2.0": "",
    "Licensed under the GNU Lesser General Public License, version 3.": "lgpl",
    "Licensed under the GNU Affero General Public License, version 3.": "",
    "Licensed under the Apache License, Version 2.0.": "apache,apache-2.0",
    "Licensed under the Apache License, Version 1.1.": "apache",
    "Licensed under the Educational Community License, Version 2.0 (the License); you may not "
    "use this file except in compliance with the License": "",
    "Released under the MIT License.": "mit,mit-notice",
    "Released under the BSD License.": "",
}


def neighbours():
    out = dict(NEIGHBOURS)
    words = {}
    for notice, label in licenses.NOTICES.items():
        words.setdefault(label, notice)
    gpl = words["gpl-notice"]
    out |= {gpl: "gpl,gpl-notice", gpl.replace("gnu", "gnu affero"): "",
            gpl.replace("gnu", "gnu lesser"): "lgpl", gpl.replace("general", "lesser"): "lgpl"}
    isc, mpl = words["isc-notice"], words["mpl-2.0"]
    out |= {isc: "isc-notice", isc.replace("and or", "and"): "isc-notice",
            isc.replace("with or without", "and without").replace("and or", "and"): "",
            mpl: "mpl-2.0", mpl.replace("v 2 0", "v 1 1"): "",
            mpl.replace(" v ", " version "): "mpl-2.0"}
    mit = next(n for n in licenses.NOTICES if n.startswith("permission is hereby"))
    for v in (2, 3):
        header = next(n for n in licenses.NOTICES if n.startswith(gpl) and f"either version {v} of" in n)
        out |= {header: f"gpl,gpl-{v}.0,gpl-notice", header.replace("gnu", "gnu lesser"): "lgpl"}
    return out | {mit: "mit-notice", mit.replace("deal in", "deal with"): ""}


def test_neighbours_are_told_apart(spark):
    rows = list(neighbours().items())
    # Alone, and between other words.
    texts = [(2 * i + k, f"{'lorem ipsum dolor sit amet ' * k}{t}{' lorem ipsum dolor sit' * k}")
             for i, (t, _) in enumerate(rows) for k in (0, 1)]
    docs = spark.createDataFrame(texts, "doc_id long, text string")
    got = {r.doc_id: r.labels for r in licenses.scan(docs).collect()}
    assert {t: (got[2 * i], got[2 * i + 1]) for i, (t, _) in enumerate(rows)} == {
        t: (want, want) for t, want in rows
    }


def edited():
    """Short notices with as many words changed or left out as the least share allows."""
    for notice, label in licenses.NOTICES.items():
        own = notice.split()
        needed = {w.decode() for w in licenses.NEEDED.get(label, set())}
        free = [i for i, w in enumerate(own) if w not in needed]
        edits = int(len(own) * (1 - licenses.LEAST_SHARE) + 1e-9)
        if len(own) > 11:
            continue
        for chosen in itertools.combinations(free, edits):
            yield " ".join("lorem" if i in chosen else w for i, w in enumerate(own)), label
            yield " ".join(w for i, w in enumerate(own) if i not in chosen), label


def test_short_notices_survive_an_edit_anywhere(spark):
    rows = list(edited())
    rows += [("released under MIT license", "mit-notice"),
             ("MIT license " * 50 + "ipsum released under MIT license" + " MIT license" * 50,
              "mit-notice"),
             ("MIT license released under MIT license", "mit-notice")]
    docs = spark.createDataFrame([(i, f"dolor {t} sit") for i, (t, _) in enumerate(rows)],
                                 "doc_id long, text string")
    got = {r.doc_id: r.labels.split(",") for r in licenses.scan(docs).collect()}
    assert [t for i, (t, label) in enumerate(rows) if label not in got[i]] == []


def test_empty_table(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert licenses.scan(docs).count() == 0


def test_every_notice_against_all_others(spark):
    """Each has its own label, and no label of a license whose notice isn't in its text."""
    rows = list(enumerate(licenses.NOTICES))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r.doc_id: set(r.labels.split(",")) for r in licenses.scan(docs).collect()}
    for i, notice in rows:
        inside = {label for other, label in licenses.NOTICES.items() if f" {other} " in f" {notice} "}
        inside |= {label for phrase, label in licenses.BASE.items() if f" {phrase} " in f" {notice} "}
        assert got[i] == inside, notice


def test_rivals_have_no_label_of_their_neighbours(spark):
    """What a variant in its place makes of a notice isn't taken for the notice."""
    made = [text for text, label in licenses.rivals() if not label]
    docs = spark.createDataFrame(list(enumerate(made)), "doc_id long, text string")
    got = {r.doc_id: set(r.labels.split(",")) - {""} for r in licenses.scan(docs).collect()}
    for i, text in enumerate(made):
        inside = {label for other, label in licenses.NOTICES.items() if f" {other} " in f" {text} "}
        inside |= {label for phrase, label in licenses.BASE.items() if f" {phrase} " in f" {text} "}
        assert got[i] - inside <= ({"lgpl"} if "lesser" in text else set()), text


def test_telling_words_follow_from_the_notices():
    assert {b"2"} <= licenses.NEEDED["gpl-2.0"] and {b"3"} <= licenses.NEEDED["gpl-3.0"]
    assert {b"lesser", b"affero", b"library"} <= licenses.BARRED["gpl-3.0"]
    assert b"nc" in licenses.NEEDED["cc-by-nc"] and b"sa" in licenses.BARRED["cc-by-nc"]
