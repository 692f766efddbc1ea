"""The indexed history: pruning, merging of parts, commits that break, and jobs that commit."""

from __future__ import annotations

import json
import random

import pytest
from pyspark.sql import functions as F

from newsdesk.plans import committed
from newsdesk.sources import history as hs
from newsdesk.sources import runs as rn
from newsdesk.sources.history import History

SCHEMA = "id bigint, a bigint, b string"


def polls(n, rows=12, seed=0):
    rnd = random.Random(seed)
    return [[(100 * p + i, rnd.randint(0, 40), rnd.choice("uvwxyz") + str(rnd.randint(0, 30))) for i in range(rows)] for p in range(n)]


def model(batches):
    """Ids of the new rows of every batch, and the rows kept."""
    seen, fresh = (set(), set()), []
    for rows in batches:
        fresh.append([r[0] for r in rows if r[1] not in seen[0] or r[2] not in seen[1]])
        seen[0].update(r[1] for r in rows)
        seen[1].update(r[2] for r in rows)
    kept = {}
    for rows in batches:
        for r in sorted(rows, reverse=True):  # of equal rows of a batch the smallest id stays
            kept[r[1:]] = r
    return fresh, sorted(kept.values())


def test_many_polls(spark, tmp_path, monkeypatch):
    """New rows and the table are right over merged parts, and the number of parts stays small."""
    monkeypatch.setattr(hs, "FANOUT", 3)
    monkeypatch.setattr(hs, "BUCKET_VALUES", 20)
    batches = polls(14)
    history = History(spark, str(tmp_path / "h"), "id")
    got, parts = [], []
    for n, rows in enumerate(batches):
        got.append(sorted(r.id for r in history.merge(spark.createDataFrame(rows, SCHEMA), n, lambda fresh: {"news": fresh.select("id")}).collect()))
        parts.append(max(len(p) for p in history.runs.manifest()["tables"].values()))
    fresh, table = model(batches)
    assert got == fresh
    assert sorted((r.id, r.a, r.b) for r in history.current().collect()) == table
    news = history.published("news")
    assert sorted((r.batch_id, r.id) for r in news.collect()) == sorted((n, i) for n, ids in enumerate(fresh) for i in ids)
    assert max(parts) <= 7 and any(p["level"] == 2 for p in history.runs.parts("seen"))
    first = {}
    for n, rows in enumerate(batches):
        for r in rows:
            first.setdefault(("a", f"v{r[1]}"), n)
            first.setdefault(("b", f"t{r[2]}"), n)
    assert {(r.col, r.val): r.batch_id for r in history.seen().collect()} == first
    assert history.runs.vacuum(1) and sorted((r.id, r.a, r.b) for r in history.current().collect()) == table
    assert history.runs.vacuum(1) == []


def test_a_poll_reads_its_buckets(spark, tmp_path, monkeypatch):
    """The scan of seen values has a filter on buckets, and later polls read no more than earlier ones."""
    monkeypatch.setattr(hs, "BUCKET_VALUES", 100)
    history = History(spark, str(tmp_path / "h"), "id")
    history.merge(spark.range(4000).select("id", F.col("id").alias("a")), 0)
    keys = spark.createDataFrame([("a", "v17")], "col string, val string")
    seen = history.seen(keys)
    plan = seen._jdf.queryExecution().toString()
    assert "PartitionFilters" in plan and "bucket" in plan.split("PartitionFilters")[1][:80]
    assert history.runs.parts("seen")[0]["buckets"] == 64
    read = lambda: history.seen(keys).count()
    early = read()
    assert 0 < early < 200 and history.seen(keys).filter("val = 'v17'").count() == 1
    for n in range(1, 13):  # overlapping polls: values that are known already add nothing
        history.merge(spark.range(100 * n, 100 * n + 50).select("id", F.col("id").alias("a")), n)
    assert read() == early and len(history.runs.parts("seen")) <= 2 * hs.FANOUT


def test_repeated_and_old_batches(spark, tmp_path):
    history = History(spark, str(tmp_path / "h"), "id")
    batches = polls(3)
    frames = [spark.createDataFrame(rows, SCHEMA) for rows in batches]
    for n, frame in enumerate(frames):
        history.merge(frame, 2 * n)
    version = history.runs.manifest()["version"]
    for n, frame in enumerate(frames):
        assert sorted(r.id for r in history.merge(frame, 2 * n).collect()) == model(batches)[0][n]
    assert history.runs.manifest()["version"] == version
    with pytest.raises(ValueError):
        history.merge(frames[0], 1)


def test_a_broken_run_changes_nothing(spark, tmp_path, monkeypatch):
    history = History(spark, str(tmp_path / "h"), "id")
    one, two = (spark.createDataFrame(rows, SCHEMA) for rows in polls(2))
    publish = lambda fresh: {"news": fresh.select("id")}
    history.merge(one, 0, publish)
    state = lambda: [sorted(map(str, f.collect())) for f in (history.current(), history.seen(), history.published("news"))]
    before = state()

    def failing(fresh):
        raise OSError("the publisher broke")

    with pytest.raises(OSError):
        history.merge(two, 1, failing)
    assert state() == before

    def switch(self, manifest):
        raise OSError("the commit broke")

    with monkeypatch.context() as broken:
        broken.setattr(rn.Runs, "_switch", switch)
        with pytest.raises(OSError):
            history.merge(two, 1, publish)
    assert state() == before
    expected = model(polls(2))[0][1]
    assert sorted(r.id for r in history.merge(two, 1, publish).collect()) == expected
    assert sorted(r.id for r in history.published("news").filter("batch_id = 1").collect()) == expected


def test_two_runs_at_once(spark, tmp_path):
    """Of two runs on the same state only the first is committed."""
    runs = rn.Runs(spark, str(tmp_path / "r"))
    first, second = runs.begin(), runs.begin()
    rows = spark.range(3)
    first.write("t", rows, (0, 0))
    second.write("t", rows, (0, 0))
    first.commit(0)
    with pytest.raises(rn.Conflict):
        second.commit(0)
    assert runs.read("t").count() == 3 and runs.read("other") is None
    assert len(runs.vacuum(1)) == 1
    assert not [p for p in (tmp_path / "r" / "manifests").iterdir() if not p.name.endswith((".json", ".crc"))]


def test_columns_that_come_and_go(spark, tmp_path):
    history = History(spark, str(tmp_path / "h"), "id")
    history.merge(spark.createDataFrame([(1, 5)], "id bigint, a bigint"), 0)
    assert history.merge(spark.createDataFrame([(2, 5, "x"), (3, 6, None)], "id bigint, a bigint, b string"), 1).count() == 2
    assert {(r.id, r.a, r.b) for r in history.current().collect()} == {(1, 5, None), (2, 5, "x"), (3, 6, None)}


def test_empty_batches(spark, tmp_path):
    history = History(spark, str(tmp_path / "h"), "id", partitions={"pages": ["database"]})
    empty = spark.createDataFrame([], SCHEMA)
    publish = lambda fresh: {"pages": fresh.select("id", F.lit("d").alias("database"))}
    assert history.merge(empty, 0, publish).count() == 0 and history.published("pages").count() == 0
    assert history.merge(spark.createDataFrame([(1, 2, "x")], SCHEMA), 1, publish).count() == 1
    assert [tuple(r) for r in history.published("pages").select("id", "database").collect()] == [(1, "d")]


def test_sequential_history(spark, tmp_path):
    """Rows are compared one after the other, per group, over several batches."""
    rnd = random.Random(2)
    rows = [(i, rnd.choice("st"), rnd.choice([None, "x", "y", "z"]), rnd.randint(0, 4)) for i in range(60)]
    history = History(spark, str(tmp_path / "h"), "seq", group=["site"], sequential=True)
    got = []
    for n in range(3):
        frame = spark.createDataFrame(rows[20 * n : 20 * n + 20], "seq bigint, site string, a string, b bigint")
        got += [r.seq for r in history.merge(frame, n).collect()]
    seen, expected = set(), []
    for i, site, a, b in rows:
        cells = {(site, "a", a), (site, "b", b)}
        if cells - seen:
            expected.append(i)
        seen |= cells
    assert sorted(got) == expected


def posts_frames(spark, ids):
    posts = spark.createDataFrame([(i, f"text {i % 7}", f"2024-01-{1 + i % 27:02} 10:00:00", i % 3, []) for i in ids],
                                  "id bigint, text string, t string, author_id bigint, urls array<struct<url:string,expanded_url:string>>")
    return posts.select("id", "text", F.col("t").cast("timestamp_ntz").alias("created_at"), "author_id", "urls"), spark.createDataFrame(
        [(i, f"n{i}", f"u{i}") for i in range(3)], "id bigint, name string, username string")


def test_posts_job_twice(spark, tmp_path):
    folder = str(tmp_path / "posts")
    for batch, ids in enumerate((range(0, 12), range(6, 20))):
        history = committed.posts_by_user(spark, folder, batch, *posts_frames(spark, ids), "https://p.example", 100)
    pages = {(r.batch_id, r.post_id) for r in history.published("pages").collect()}
    assert pages == {(0, i) for i in range(12)} | {(1, i) for i in range(12, 20)}
    again = committed.posts_by_user(spark, folder, 1, *posts_frames(spark, range(6, 20)), "https://p.example", 100)
    assert {(r.batch_id, r.post_id) for r in again.published("pages").collect()} == pages
    assert sorted(r.post_id for r in again.current().collect()) == list(range(20))


def test_snapshot_job_twice(spark, tmp_path):
    """Only snapshots that are not stored yet are published, with their cells."""
    ranked = spark.createDataFrame([("x", "2024-01-01", 1, "a"), ("x", "2024-01-01", 2, "b"), ("x", "2024-01-02", 1, "b"), ("y", "2024-01-02", 1, "c")],
                                   "country string, t string, rank int, word string").select("country", F.col("t").cast("timestamp_ntz").alias("ts"), "rank", "word")
    conf = spark.createDataFrame([("x", "https://news.example/s", 0), ("y", "https://other.example", 1)], "country string, search_url string, pos int")
    pages = spark.createDataFrame([("https://news.example/s", "a", '<h3><a href="/1">one</a></h3>')], "search_url string, word string, html string")
    memory = spark.createDataFrame([], "engine string, src string, dst string")
    folder = str(tmp_path / "t")
    committed.trend_country(spark, folder, 0, ranked.filter("country = 'x' AND ts < '2024-01-02'"), conf, pages, memory, "off")
    history = committed.trend_country(spark, folder, 1, ranked, conf, pages, memory, "off")
    found = {(r.name, str(r.ts)[:10], r.batch_id) for r in history.published("pages").collect()}
    assert found == {("trend  x", "2024-01-01", 0), ("trend  x", "2024-01-02", 1), ("trend  y", "2024-01-02", 1)}
    cells = {(r.source, r.word, r.batch_id) for r in history.published("matrix").filter("rank < 99").collect()}
    assert cells == {("x", "a", 0), ("x", "b", 0), ("x", "b", 1), ("y", "c", 1)}
    heading = history.published("blocks").filter("batch_id = 0 AND block_pos = 0").first().payload
    assert [c["paragraph"]["rich_text"][0]["plain_text"] for c in json.loads(heading)["heading_1"]["children"]] == ["one"]
