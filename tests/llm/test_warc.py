from __future__ import annotations

import gzip
import hashlib
import random

import oracle
import pytest

from gridspan.llm import warc

SF_DIR = "/root/testdata/sf0.001"


def brute(rows):
    groups = {}
    for page, _, html in rows:
        data = (html or "").encode()
        if len(data) >= 1000:
            groups.setdefault(data, []).append(page)
    out = []
    for page, url, html in rows:
        data = (html or "").encode()
        ids = [p for p in groups.get(data, []) if p is not None]
        original = max(ids, default=None)
        revisit = original is not None and page != original
        out.append((page, len(data), hashlib.sha1(data).hexdigest(),
                    "revisit" if revisit else "response", original if revisit else None))
    return out


def corpus():
    rng = random.Random(4)
    trap = "\r\n\r\nWARC/1.0\r\nWARC-Type: response\r\nContent-Length: 3\r\n\r\nabc"
    bodies = ["", None, "é" * 600, "short", "x" * 999, "x" * 1000, trap * 40, "\r\n\r\n" * 400,
              "<p>" * 60000, "line\n" * 300, trap + "\r\n\r\nWARC/1.0\r\n"]
    urls = ["http://a.b/c", "https://www.A.b:80/c?q=1#x", "", None, "no scheme", "http://b.a/\r\nX: y"]
    rows = [(i, rng.choice(urls), rng.choice(bodies)) for i in rng.sample(range(10**6), 200)]
    return [*rows, rows[0], (None, "http://n/", "x" * 1000), (None, None, None), (2**60, "u", "y" * 2000)]


@pytest.mark.parametrize("rows", [corpus(), [], [(None, None, "z" * 1000)] * 2])
def test_equals_brute_force(spark, rows, monkeypatch):
    monkeypatch.setattr(warc, "BLOCK", 3)
    monkeypatch.setattr(warc, "BATCH", 11)
    pages = spark.createDataFrame([(*r, "t") for r in rows], "page_id long, url string, html string, payload string")
    got = sorted(warc.archived(pages).collect(), key=lambda r: r.position)
    assert sorted(str(tuple(r[:5])) for r in got) == sorted(map(str, brute(rows)))
    keys = [(r.url_key, r.captured, r.page_id is not None, r.page_id or 0) for r in got]
    assert keys == sorted(keys) and [r.position for r in got] == list(range(1, len(rows) + 1))


def test_shuffle_join_beyond_the_broadcast_bound(spark, monkeypatch):
    monkeypatch.setattr(warc, "BROADCAST_DIGESTS", 0)
    rows = corpus()
    got = warc.archived(spark.createDataFrame(rows, "page_id long, url string, html string"))
    assert sorted(str(tuple(r[:5])) for r in got.collect()) == sorted(map(str, brute(rows)))


def test_payloads_come_back(spark, tmp_path):
    rows = corpus()
    path = warc.write(spark.createDataFrame(rows, "page_id long, url string, html string"), str(tmp_path / "w"))
    got = warc.read(spark, path, payload=True).filter("record_type = 'response'").collect()
    texts = {(p, (h or "").encode()) for p, _, h in rows}
    assert {(r.page_id, bytes(r.payload)) for r in got} <= texts


def test_loser_tree_merges_any_runs():
    rng = random.Random(2)
    for k in range(9):
        runs = []
        for _ in range(k):
            rows = [(rng.randrange(9), 0, "", "", None, rng.choice("abc"), "t", "f", 0, 0) for _ in range(rng.randint(0, 9))]
            runs.append(sorted(rows, key=warc.order))
        want = sorted((r for run in runs for r in run), key=warc.order)
        assert list(warc.loser_tree_merge(runs)) == want


def sorted_runs(rng, k):
    runs = []
    for _ in range(k):
        rows = [(rng.choice([None, *range(9)]), 0, "", "", None, rng.choice("abc"), "t", "f", rng.randrange(10**9), 0) for _ in range(rng.randint(0, 30))]
        runs.append(sorted(rows, key=warc.order))
    return runs


@pytest.mark.parametrize("size", [1, 3, 50])
def test_blocks_are_merged_as_they_come(size):
    """In order of their first keys; no more than two blocks a run are held."""
    rng = random.Random(size)
    for k in range(7):
        runs = sorted_runs(rng, k)
        blocks = [run[a : a + size] for run in runs for a in range(0, len(run), size)]
        want = sorted((r for run in runs for r in run), key=warc.order)
        held, most = [0], [0]

        def come():
            for block in sorted(blocks, key=lambda b: warc.order(b[0])):
                held[0] += len(block)
                most[0] = max(most[0], held[0])
                yield block

        got = []
        for row in warc.merged(come()):
            held[0] -= 1
            got.append(row)
        assert [warc.order(r) for r in got] == [warc.order(r) for r in want]
        assert most[0] <= 2 * size * max(k, 1)


def test_blocks_are_cut_at_the_borders_of_ranges(spark, monkeypatch):
    """One url with a third of all captures falls into many ranges of about even size."""
    monkeypatch.setattr(warc, "BLOCK", 8)
    rows = [(i, "http://hot/" if i % 3 == 0 else f"http://h{i % 97}/{i}", "x") for i in range(6000)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").repartition(5)
    path = warc.write(pages, warc.scratch(spark, "warc-test"))
    got = warc.history(warc.read(spark, path))
    assert got.filter("url_key = 'hot)/'").count() == 2000
    keys = [(r.url_key, r.captured, r.page_id) for r in got.orderBy("position").collect()]
    assert keys == sorted(keys) and len(keys) == 6000
    blocks = warc.runs(warc.read(spark, path))
    borders = warc._borders(blocks, 8)
    sizes = [0] * (len(borders) + 1)
    for key in keys:
        sizes[warc._range_of(borders, (key[0], key[1], True, key[2], "", 0))] += 1
    assert len(sizes) == 8 and max(sizes) < 2 * 6000 / 8


def test_archives_are_gzip_files_and_captures_can_be_fetched(spark, tmp_path):
    rows = corpus()
    path = warc.write(spark.createDataFrame(rows, "page_id long, url string, html string").repartition(3), str(tmp_path / "w"))
    index = warc.history(warc.read(spark, path)).collect()
    for r in index:
        file = r.file.removeprefix("file:")
        with open(file, "rb") as f:
            f.seek(r.file_offset)
            record = gzip.decompress(f.read(r.compressed_bytes))
        assert record.startswith(b"WARC/1.0\r\n") and f"sha1:{r.payload_digest}".encode() in record
        assert record.endswith(b"\r\n\r\n") or r.record_type == "response"
    for file in {r.file.removeprefix("file:") for r in index}:
        with gzip.open(file) as f:
            assert f.read().count(b"WARC-File-Offset: ") == sum(r.file.endswith(file) for r in index)
    some = spark.createDataFrame([r for r in index if r.position % 7 == 0])
    texts = {(p, (h or "").encode()) for p, _, h in rows}
    got = warc.fetch(some).collect()
    assert len(got) == some.count()
    assert all((r.page_id, bytes(r.payload)) in texts if r.record_type == "response" else r.payload is None for r in got)


def test_many_tasks_read_one_file(spark, tmp_path):
    rows = [(i, "http://a/", f"text {i} " * 40) for i in range(3000)]
    path = warc.write(spark.createDataFrame(rows, "page_id long, url string, html string").coalesce(1), str(tmp_path / "w"))
    spark.conf.set("spark.sql.files.maxPartitionBytes", "10000")
    try:
        read = warc.read(spark, path)
        assert read.rdd.getNumPartitions() > 4
        assert sorted(r.page_id for r in read.collect()) == list(range(3000))
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")


def test_query_equals_its_sql(spark):
    pages = spark.read.parquet(f"{SF_DIR}/pages.parquet")
    assert oracle.compare(warc.archived(pages), oracle.connect(SF_DIR), warc.SQL) == ""


def test_a_page_that_repeats_is_spread_over_ranges(spark, monkeypatch):
    monkeypatch.setattr(warc, "BLOCK", 8)
    rows = [(7, "http://hot/", "x")] * 1500 + [(i, f"http://h{i}/", "x") for i in range(3000)]
    path = warc.write(spark.createDataFrame(rows, "page_id long, url string, html string").repartition(5), warc.scratch(spark, "warc-test"))
    captures = warc.read(spark, path)
    borders = warc._borders(warc.runs(captures), 8)
    sizes = [0] * (len(borders) + 1)
    for r in warc.history(captures).collect():
        sizes[warc._range_of(borders, warc.order(tuple(r)))] += 1
    assert max(sizes) < 2 * 4500 / 8
