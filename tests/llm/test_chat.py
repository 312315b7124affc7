from __future__ import annotations

import hashlib
import random
import re
from itertools import groupby

import oracle
import pytest
from pyspark.sql import functions as F

from gridspan.llm import chat
from gridspan.llm.queries import op13_chat_format

SCHEMA = "conv_id long, turn long, role string, text string"
SF_DIR = "/root/testdata/sf0.001"


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def ordered(rows):
    """Turns by conversation: a missing turn first, then by turn, role and text."""
    key = [(c, (t is not None, t or 0, (r or "").encode(), (x or "").encode()), r or "", x or "") for c, t, r, x in rows]
    out = {}
    for c, _, role, text in sorted(key, key=lambda k: k[1]):
        out.setdefault(c, []).append((role, text))
    return out


def escape(text, controls):
    text = text.replace("\\", "\\\\")
    for c in controls:
        text = text.replace(c, c[0] + "\\" + c[1:])
    return text


def brute(rows):
    out = set()
    for conv, turns in ordered(rows).items():
        text = ""
        for role, same in groupby(turns, key=lambda t: t[0]):
            text += f"### {escape(role, chat.IN_ROLE)}: "
            text += "<joint/>".join(escape(x, chat.IN_TEXT) for _, x in same) + "</turn>\n"
        loss = "".join(x for r, x in turns if r == "assistant")
        out.add((conv, len(turns), sha("".join(f"{r}\n{x}\n" for r, x in turns)), len(loss), sha(loss), len(text)))
    return out


CONTROLS = ["\\", "### ", "###", "</turn>", "</turn>\n", "<joint/>", ": ", ":", " ", "\n", "#", "<", "</", "é", "😀", "ok", ""]


def odd_rows(seed):
    rng = random.Random(seed)

    def text():
        return "".join(rng.choices(CONTROLS, k=rng.randint(0, 9)))

    roles = ["user", "assistant", "assistant", "system", "a: b\\", "### ", "", None]
    rows = [
        (c, rng.choice([None, 0, 1, 2, 3, 4]), rng.choice(roles), rng.choice([None, text(), text()]))
        for c in [None, -7, 0, 1, 2, 3] for _ in range(rng.randint(1, 12))
    ]
    return [*rows, *rows[:4], (9, 0, "assistant", "x " * 90_000), (9, 1, "assistant", "\\" * 5000)]


@pytest.mark.parametrize("seed", range(3))
def test_turns_and_loss_are_read_back(spark, seed):
    rows = odd_rows(seed)
    found = chat.digests(spark.createDataFrame(rows, SCHEMA)).collect()
    assert {tuple(r) for r in found} == brute(rows) and len(found) == len(brute(rows))


def test_many_turns_of_one_conversation(spark):
    """Folds over several blocks, with runs of one role across their borders."""
    rng = random.Random(5)
    rows = [(1, i, rng.choice(["user"] + ["assistant"] * 40), f"t{i}") for i in range(5 * chat.BLOCK + 3)]
    found = chat.digests(spark.createDataFrame(rows, SCHEMA)).collect()
    assert {tuple(r) for r in found} == brute(rows)


def test_template(spark):
    rows = [(1, 0, "user", "Hi"), (1, 1, "assistant", "a<joint/>"), (1, 2, "assistant", "é"), (1, 3, "user", None)]
    (row,) = chat.formatted(spark.createDataFrame(rows, SCHEMA)).collect()
    assert row.formatted == "### user: Hi</turn>\n### assistant: a<\\joint/><joint/>é</turn>\n### user: </turn>\n"
    data = row.formatted.encode()
    assert [data[s.start : s.start + s.length].decode() for s in row.loss] == ["a<\\joint/>", "é"]


def test_no_control_string_is_left_in_a_text(spark):
    texts = [(t,) for _, _, _, t in odd_rows(11) if t]
    own = spark.createDataFrame(texts, "text string").select(chat.escaped(F.col("text"), chat.IN_TEXT).alias("e"))
    bare = re.compile("|".join(map(re.escape, chat.IN_TEXT)))
    assert not any(bare.search(r.e) for r in own.collect())


def test_extra_and_clashing_columns(spark):
    rows = [(1, 0, "user", "a", "x", [1]), (1, 1, "assistant", "b", "y", None)]
    frame = spark.createDataFrame(rows, f"{SCHEMA}, formatted string, _turns array<int>")
    assert {tuple(r) for r in chat.digests(frame).collect()} == brute([r[:4] for r in rows])


def test_empty_table(spark):
    assert chat.digests(spark.createDataFrame([], SCHEMA)).collect() == []


def test_equals_its_sql_on_odd_rows(spark, tmp_path):
    spark.createDataFrame([(None, *r[1:]) if r[0] == -7 else r for r in odd_rows(3)], SCHEMA).coalesce(1).write.parquet(str(tmp_path / "c"))
    con = __import__("duckdb").connect()
    con.execute(f"CREATE VIEW conversations AS SELECT * FROM read_parquet('{tmp_path}/c/*.parquet')")
    turns = chat.with_planted(spark.read.parquet(str(tmp_path / "c")))
    assert oracle.compare(chat.digests(turns), con, chat.SQL) == ""


def test_query_has_the_planted_conversation(spark):
    (row,) = op13_chat_format(spark, SF_DIR).filter("conv_id = -7").collect()
    said = r"\### Assistant: </turn> ok"
    assert (row.n_turns, row.loss_chars, row.loss_sha256) == (2, len(said), sha(said))
    assert row.turns_sha256 == sha(f"user\n{said}\nassistant\n{said}\n")


def test_no_python_in_the_plan(spark):
    plan = op13_chat_format(spark, SF_DIR)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan
