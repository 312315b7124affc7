from __future__ import annotations

import base64
from collections import Counter

import naive
import public_tokenizers
import pytest
import tiktoken

import corpus_pipeline
from gridspan.llm import language, rules
from gridspan.llm.frames import table

SF_DIR = "/root/testdata/sf0.001"
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="module")
def encoding():
    with open(public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), "rb") as lines:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def brute(spark, rows, labels, encoding):
    """What each stage keeps, by its models and rules applied row by row; then the tokens."""
    frame = spark.createDataFrame(rows, SCHEMA)
    found = rules.learn(*rules.sample(frame, labels, rules.SAMPLE))
    stages = [[r for r in rows if naive.list_keeps(found, r[1])]]
    network = language.learned(spark.createDataFrame(stages[-1], SCHEMA))
    judged = [(r, *naive.language_of(network, r[1])) for r in stages[-1]]
    assert all(abs(p - language.LEAST_SCORE) > 1e-3 for _, _, p in judged)
    stages.append([r for r, lang, p in judged if lang != "und" and p >= language.LEAST_SCORE])
    stages.append([stages[-1][k] for k in naive.one_of_each(stages[-1], corpus_pipeline.SIMILAR)])
    stages.append([stages[-1][k] for k in naive.drawn([r[:4] for r in stages[-1]], corpus_pipeline.MIXTURE)])
    ids = [(r[0], r[2], r[3], encoding.encode_ordinary(r[1] or "")) for r in stages[-1]]
    return stages, sorted((i, lang, source, len(t), t, True) for i, lang, source, t in ids)


def test_run_equals_brute_force(spark, encoding, tmp_path):
    """All documents of the smallest tables, near copies and junk among them."""
    docs = table(spark, SF_DIR, "documents").select("doc_id", "text", "lang", "source", "n_chars")
    rows = sorted(map(tuple, docs.collect()))
    stages, tokens = brute(spark, rows, table(spark, SF_DIR, "labels"), encoding)
    own, frame = [], docs
    for _, stage in corpus_pipeline.STAGES[:-1]:
        frame = stage(spark, frame, SF_DIR)
        own.append(Counter(map(tuple, frame.select(docs.columns).collect())))
    assert own == [Counter(s) for s in stages]
    assert len(stages[0]) < len(rows) and len(stages[2]) < len(stages[1]) and len(stages[3]) < len(stages[2])
    got = sorted((r.doc_id, r.lang, r.source, r.n_tokens, r.ids, r.round_trip)
                 for r in corpus_pipeline.run(spark, SF_DIR).collect())
    assert got == tokens


def test_stages_keep_columns(spark):
    docs = table(spark, SF_DIR, "documents").limit(50)
    for name, stage in corpus_pipeline.STAGES[:-1]:
        assert stage(spark, docs, SF_DIR).columns == docs.columns, name


ODD = [
    (None, None, None, None, None), (None, None, None, None, None), (1, "", "en", "src0", 0), (1, "", "en", "src0", 0),
    (2, "word " * 9000, None, "x", 45000), (2, "word " * 9000, None, "x", 45000),
    (3, "other words of a text that is long enough to be kept by all " * 2, "en", "src1", 9),
]
#: Rows of ODD that a stage without anything to learn from keeps: the stages that compare rows
#: drop repeats of texts with words only, and the mixture rows of leaves without words.
KEPT = {"near_duplicates": [0, 1, 2, 3, 4, 6], "mixture": [4, 5, 6]}


@pytest.mark.parametrize(("name", "stage"), corpus_pipeline.STAGES)
def test_stages_take_odd_rows(spark, name, stage, tmp_path):
    for rows in ([], ODD):
        docs = spark.createDataFrame([(*r, "more") for r in rows], f"{SCHEMA}, n_tokens string")
        out = stage(spark, docs, SF_DIR).collect()
        if name == "tokens":
            assert sorted(str(r.doc_id) for r in out) == sorted(str(r[0]) for r in rows)
        elif name in KEPT and rows:
            kept = Counter(ODD[k] for k in KEPT[name])
            if name == "mixture":  # four fifths of the words are read
                assert not Counter(tuple(r)[:5] for r in out) - kept and len(out) >= 2
            else:
                assert Counter(tuple(r)[:5] for r in out) == kept
        else:
            assert not Counter(tuple(r)[:5] for r in out) - Counter(rows)


def test_run_has_the_last_stage_s_columns(spark):
    docs = table(spark, SF_DIR, "documents").limit(5)
    last = corpus_pipeline.STAGES[-1][1](spark, docs, SF_DIR)
    assert last.columns == ["doc_id", "lang", "source", "n_tokens", "ids", "round_trip"]
