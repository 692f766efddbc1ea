"""Limits per key, newest copies, numbering, the matrix in blocks, sums per batch, landed answers."""

from __future__ import annotations

import json
import random

import pytest
from pyspark.sql import functions as F

from newsdesk.operators import joins, ranking
from newsdesk.sources import landed
from newsdesk.sources import matrix as mx
from newsdesk.sources.accumulated import Accumulated
from newsdesk.sources.matrix import Matrix


@pytest.mark.parametrize("gathered", [10, 50_000])
def test_top_per_key(spark, gathered, monkeypatch):
    monkeypatch.setattr(ranking, "GATHERED_ROWS", gathered)
    rng = random.Random(1)
    rows = [(i, rng.choice(["hot"] * 6 + ["a", "b", "c", "none", "unlisted", None]), rng.choice([None, *range(40)])) for i in range(900)]
    limits = [("hot", 7), ("hot", 3), ("a", 1000), ("b", 0), ("c", 1), ("absent", 5), (None, 4)]
    frame = spark.createDataFrame(rows, "id bigint, user string, t bigint").repartition(4)
    got = ranking.top_per_key(frame, spark.createDataFrame(limits, "user string, n int"), "user", ["t", "id"])
    assert got.columns == ["id", "user", "t"]
    most = {"hot": 7, "a": 1000, "c": 1}
    expected = []
    for user, n in most.items():
        mine = sorted((r for r in rows if r[1] == user), key=lambda r: (r[2] is not None, r[2] or 0, r[0]), reverse=True)
        expected += mine[:n]
    assert sorted(map(tuple, got.collect())) == sorted(expected)


def test_numbered(spark):
    words = [f"w{i * 37 % 1000:04}" for i in range(1000)]
    frame = spark.createDataFrame([(w,) for w in words], "word string").repartition(6)
    got = {r.word: r.number for r in ranking.numbered(frame, ["word"]).collect()}
    assert got == {w: i for i, w in enumerate(sorted(words))}
    assert ranking.numbered(frame.limit(0), ["word"]).count() == 0


@pytest.mark.parametrize("scan", [True, False])
def test_newest_copies(spark, tmp_path, scan):
    rng = random.Random(2)
    rows = [(rng.choice("abcdefg"), rng.randint(0, 9), f"body {i}") for i in range(200)] + [(None, 99, "no key")]
    frame = spark.createDataFrame(rows, "url string, t int, html string").repartition(3)
    if scan:
        frame.write.parquet(str(tmp_path / "landed"))
        frame = spark.read.parquet(str(tmp_path / "landed"))
    got = joins.newest_copies(frame, "url", "t").collect()
    newest = {k: max(t for u, t, _ in rows if u == k) for k in "abcdefg"}
    assert {r.url: r.t for r in got} == newest and len(got) == 7
    assert all((r.url, r.t, r.html) in rows for r in got)
    wanted = spark.createDataFrame([("a",), ("zz",), (None,)], "url string")
    assert [r.url for r in joins.newest_copies(frame, "url", "t", wanted).collect()] == ["a"]
    landed_rows = joins.landed_rows(wanted, frame.withColumnRenamed("t", "landed_at"), "url").collect()
    assert [r.url for r in landed_rows] == ["a"]


@pytest.mark.parametrize("how", ["inner", "left", "left_semi", "left_anti"])
def test_wide_rows_of_hot_keys_are_not_broadcast(spark, how, monkeypatch):
    monkeypatch.setattr(joins, "NARROW_CHARS", 50)
    left = spark.createDataFrame([(i, "hot" if i % 3 else (None if i % 5 else f"k{i % 7}")) for i in range(300)], "id bigint, k string")
    right = spark.createDataFrame([("hot", "x" * 200), ("k0", "y" * 200)], "k string, v string")
    joined = joins.join_unique(left, right, "k", how, hot=1)
    assert sorted(map(str, joined.select(*sorted(joined.columns)).collect())) == sorted(map(str, left.join(right, "k", how).select(*sorted(joined.columns)).collect()))


def snapshots(seed, days, vocabulary):
    rng = random.Random(seed)
    return [(s, d, w, i + 1) for s in "xy" for d in days for i, w in enumerate(rng.sample(vocabulary, 5))]


def test_matrix(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(mx, "WIDTH", 4)
    words = [f"w{i}" for i in range(30)]
    first, second = snapshots(1, range(3), words[:15]), snapshots(2, range(2, 5), words)
    frame = lambda rows: spark.createDataFrame(rows, "source string, ts int, word string, rank int")
    table = Matrix(spark, str(tmp_path / "m"))
    assert table.add(frame(first), 0) and table.add(frame(second), 1) and not table.add(frame(first), 1)
    kept = {r[:3]: r[3] for r in second} | {r[:3]: r[3] for r in first if r[1] < 2}  # the snapshots of day 2 are replaced
    assert {tuple(r)[:3]: r.rank for r in table.cells().collect()} == kept
    places = [(r.block, r["at"]) for r in table.words().collect()]
    assert len(set(places)) == len(places) == len({r[2] for r in first + second}) and max(a for _, a in places) < 4
    stamps = {(s, d) for s in "xy" for d in range(5)}
    dense = {tuple(r)[:3]: r.rank for r in table.dense().collect()}
    assert set(dense) == {(s, d, w) for s, d in stamps for w in {k[2] for k in kept if k[0] == s}} and all(dense[k] == kept.get(k, 0) for k in dense)
    some = ["w3", "w17", "never", "w0"]
    wide = table.wide(some)
    assert wide.columns == ["source", "ts", *some]
    assert {(r.source, r.ts): [r[w] for w in some] for r in wide.collect()} == {(s, d): [kept.get((s, d, w), 0) for w in some] for s, d in stamps}
    plan = wide._jdf.queryExecution().toString()
    scans = [part[:120] for part in plan.split("PartitionFilters: ")[1:]]
    assert any("block" in scan.split("PushedFilters")[0] for scan in scans)


def test_sums_count_a_batch_once(spark, tmp_path):
    sums = Accumulated(spark, str(tmp_path / "s"), ["k"])
    assert sums.total() is None
    expected: dict = {}
    for batch in range(11):
        rows = [(f"k{i % 5}", i * batch if i % 4 else None) for i in range(20)]
        frame = spark.createDataFrame(rows, "k string, value bigint")
        assert sums.add(frame, batch) and not sums.add(frame, batch)
        for k, v in rows:
            expected[k] = expected.get(k, 0) + (v or 0)
    assert {r.k: r.value for r in sums.total().collect()} == expected
    assert len(sums.runs.parts("sums")) < 8


def test_answers(spark, tmp_path):
    def answer(newest, text, name):
        return {"data": [{"id": 5, "text": text, "author_id": 7, "created_at": "2022-05-01T15:30:10"}], "meta": {"newest_id": newest},
                "includes": {"users": [{"id": 7, "name": name, "username": "me"}], "tweets": [{"id": 4, "text": f"before {text}"}]}}

    lines = [json.dumps(answer(9, "new", "B")), json.dumps(answer(6, "old", "A")), '{"data": [{"id": 1', json.dumps({"data": None}), json.dumps({"includes": {"users": [{"id": None}]}})]
    (tmp_path / "a.json").write_text("\n".join(lines))
    found = landed.read_answers(spark, str(tmp_path))
    assert [(r.id, r.text) for r in found["posts"].collect()] == [(5, "new")]
    assert [(r.id, r.name) for r in found["users"].collect()] == [(7, "B")]
    assert [(r.id, r.text) for r in found["referenced"].collect()] == [(4, "before new")]
    assert [r.broken for r in found["refused"].collect()] == [lines[2]]
    assert found["posts"].select(F.col("created_at").cast("string")).first()[0] == "2022-05-01 15:30:10"
