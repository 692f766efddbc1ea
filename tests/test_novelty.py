"""Novelty and merging against small pandas models, edge cases, and replays."""

from __future__ import annotations

import random

import pandas as pd
import pytest
from pyspark.sql import functions as F

from newsdesk.operators import joins, novelty
from newsdesk.sources.history import History
from newsdesk.streaming import ingest as ing

SCHEMA = "id bigint, a bigint, b string"


def frames(seed, rows=30, old=20):
    rnd = random.Random(seed)
    row = lambda i: (i, rnd.choice([None, 1, 2, 3, 4, 5, 6, 7]), rnd.choice([None, "x", "y", "z", "v", "w"]))
    return [row(i) for i in range(rows)], [row(i) for i in range(rnd.choice([0, 3, old]))]


def model_cells(batch, past):
    seen_a, seen_b = {r[1] for r in past}, {r[2] for r in past}
    return sorted(r[0] for r in batch if not (r[1] in seen_a and r[2] in seen_b))


def model_sequential(batch, past):
    past, out = list(past), []
    for r in batch:
        if model_cells([r], past):
            out.append(r[0])
        past.append(r)
    return out


@pytest.mark.parametrize("seed", range(5))
@pytest.mark.parametrize("hot, broadcast", [(1, 0), (256, 500_000)])
def test_novelty_models(spark, seed, hot, broadcast, monkeypatch):
    monkeypatch.setattr(novelty, "BROADCAST_KEYS", broadcast)
    batch, past = frames(seed)
    b, h = spark.createDataFrame(batch, SCHEMA), spark.createDataFrame(past, SCHEMA)
    got = [r.id for r in novelty.novelty_cells(b, h, "id", hot=hot).orderBy("id").collect()]
    assert got == model_cells(batch, past)
    seq = [r.id for r in novelty.novelty_sequential(b, h, "id").orderBy("id").collect()]
    assert seq == model_sequential(batch, past)
    rows = [r.id for r in novelty.novelty_rows(b, h, ["id"]).orderBy("id").collect()]
    known = {r[1:] for r in past}
    assert rows == [r[0] for r in batch if r[1:] not in known]


@pytest.mark.parametrize("seed", range(4))
def test_merge_model(spark, seed):
    batch, past = frames(seed)
    b, h = spark.createDataFrame(batch, SCHEMA), spark.createDataFrame(past, SCHEMA)
    both = pd.concat([pd.DataFrame(batch, columns=["id", "a", "b"]), pd.DataFrame(past, columns=["id", "a", "b"])])
    kept = both.drop_duplicates(subset=["a", "b"])
    got = novelty.merge_newest_first(b, h, "id").toPandas()
    assert sorted(got["id"]) == sorted(kept["id"]) and len(got) == len(kept)


def test_novelty_edge_cases(spark):
    past = spark.createDataFrame([(0, 1, "x"), (1, 2, "y")], SCHEMA)
    batch = spark.createDataFrame([(0, 1, "y"), (1, 3, "x"), (2, 1, None), (3, 3, "x")], SCHEMA)
    assert sorted(r.id for r in novelty.novelty_cells(batch, past, "id").collect()) == [1, 2, 3]
    assert sorted(r.id for r in novelty.novelty_sequential(batch, past, "id").collect()) == [1, 2]
    with_null = past.unionByName(spark.createDataFrame([(2, None, None)], SCHEMA))
    assert sorted(r.id for r in novelty.novelty_cells(batch, with_null, "id").collect()) == [1, 3]
    assert novelty.novelty_cells(batch, past.drop("b"), "id").count() == 4
    as_text = past.withColumn("a", F.col("a").cast("string"))
    assert novelty.novelty_cells(batch.filter("id = 0"), as_text, "id").count() == 1
    as_double = past.withColumn("a", F.col("a").cast("double"))
    assert novelty.novelty_cells(batch.filter("id = 0"), as_double, "id").count() == 0
    with_half = past.withColumn("a", F.col("a") + 0.5)
    assert novelty.novelty_cells(batch.filter("id = 0"), with_half, "id").count() == 1
    long_text = spark.createDataFrame([(0, 1, "x" * 500), (1, 1, "x" * 499 + "y")], SCHEMA)
    assert [r.id for r in novelty.novelty_cells(long_text, long_text.filter("id = 0"), "id").collect()] == [1]
    long_id = 1512345678901234567
    ids = spark.createDataFrame([(0, long_id, "x")], SCHEMA)
    near = spark.createDataFrame([(0, long_id + 1, "x")], SCHEMA)
    assert novelty.novelty_cells(near, ids, "id").count() == 1


def test_novelty_per_group(spark):
    schema = "id bigint, site string, a bigint"
    past = spark.createDataFrame([(0, "s", 1), (1, "t", 2)], schema)
    batch = spark.createDataFrame([(0, "s", 1), (1, "s", 2), (2, "t", 2), (3, "u", 1)], schema)
    got = novelty.novelty_cells(batch, past, "id", group=["site"])
    assert sorted(r.id for r in got.collect()) == [1, 3]


def test_same_matrix_row_on_two_dates(spark):
    schema = "day bigint, u1 bigint, u2 bigint"
    old = spark.createDataFrame([(20220501, 1, 2), (20220502, 2, 1)], schema)
    new = spark.createDataFrame([(20220503, 1, 2)], schema)
    merged = novelty.merge_newest_first(new, old, "day").collect()
    assert sorted(r.day for r in merged) == [20220502, 20220503]
    wider = old.withColumn("u3", F.lit(0).cast("bigint"))
    merged = novelty.merge_newest_first(new, wider, "day", fill=0).collect()
    assert sorted(r.day for r in merged) == [20220501, 20220502, 20220503] and all(r.u3 == 0 for r in merged)


@pytest.mark.parametrize("how", ["inner", "left", "left_semi", "left_anti"])
def test_join_unique_with_a_hot_key(spark, how):
    rows = [(i, None if i % 7 == 0 else ("hot" if i % 3 else f"k{i % 50}")) for i in range(600)]
    left = spark.createDataFrame(rows, "id bigint, k string")
    right = spark.createDataFrame([("hot", 1)] + [(f"k{i}", i) for i in range(0, 50, 2)], "k string, v bigint")
    plain = left.join(right, "k", how).collect()
    split = joins.join_unique(left, right, "k", how, hot=1).collect()
    narrow = joins.join_unique(left, right, "k", how, narrow=True).collect()
    shape = lambda rs: sorted(str(sorted(r.asDict().items())) for r in rs)
    assert shape(plain) == shape(split) == shape(narrow)


def test_wide_rows_are_not_narrow(spark, monkeypatch):
    right = spark.createDataFrame([("a", "x" * 100), ("b", None)], "k string, v string")
    left = spark.createDataFrame([("a",), ("b",), (None,)], "k string")
    assert joins.is_narrow(right) and joins.is_narrow(right.limit(0))
    near = sorted(map(str, joins.join_unique(left, right, "k", "left", narrow=True).collect()))
    monkeypatch.setattr(joins, "NARROW_CHARS", 100)
    assert not joins.is_narrow(right)
    assert near == sorted(map(str, joins.join_unique(left, right, "k", "left", narrow=True).collect()))


def test_join_detail_and_config(spark):
    topics = spark.createDataFrame([("u1", "t1", "old"), ("u2", "t2", "kept"), (None, "t3", "kept")], "url string, title string, date string")
    details = spark.createDataFrame([("u1", "new", "A")], "url string, date string, author string")
    got = {r.title: (r.date, r.author) for r in joins.join_detail(topics, details).collect()}
    assert got == {"t1": ("new", "A"), "t2": ("kept", None), "t3": ("kept", None)}
    conf = spark.createDataFrame([(0, "jp", "first"), (1, "jp", "last")], "pos int, country string, url string")
    rows = spark.createDataFrame([("jp",), ("us",)], "country string")
    assert [tuple(r) for r in joins.apply_config(rows, conf, "country", "url", "pos").collect()] == [("jp", "last")]


def test_history_replay_changes_nothing(spark, tmp_path):
    batch, past = frames(3)
    history = History(spark, str(tmp_path / "h"), "id")
    history.merge(spark.createDataFrame(past or [(0, 1, "x")], SCHEMA), 0)
    frame = spark.createDataFrame(batch, SCHEMA)
    first = sorted(r.id for r in history.merge(frame, 1).collect())
    table = sorted(map(tuple, history.current().select("id", "a", "b").collect()), key=str)
    again = sorted(r.id for r in history.merge(frame, 1).collect())
    assert again == first == model_cells(batch, past or [(0, 1, "x")])
    assert sorted(map(tuple, history.current().select("id", "a", "b").collect()), key=str) == table


def test_history_with_other_number_types(spark, tmp_path):
    history = History(spark, str(tmp_path / "h"), "id")
    history.merge(spark.createDataFrame([(0, 1), (1, 2)], "id bigint, a bigint"), 0)
    drifted = spark.createDataFrame([(2, 1.0), (3, 1.5)], "id bigint, a double")
    assert [r.id for r in history.merge(drifted, 1).collect()] == [3]
    exact = drifted.select("id", F.col("a").cast("decimal(10,2)").alias("a"))
    assert history.merge(exact, 2).count() == 0


def test_undated_records(spark):
    records = spark.createDataFrame([(0, "d1"), (1, "d1"), (2, None), (3, None)], "row_id bigint, date string")
    fresh = records.filter("row_id IN (1, 2)")
    assert sorted(r.row_id for r in joins.semi_join_new_dates(records, fresh, row_id="row_id").collect()) == [0, 1, 2]
    assert sorted(r.row_id for r in joins.semi_join_new_dates(records, fresh).collect()) == [0, 1]


def test_stream_equals_batches(spark, tmp_path):
    batches = [frames(s)[0] for s in (1, 2, 3)]
    batches = [[(100 * n + r[0], *r[1:]) for r in rows] for n, rows in enumerate(batches)]
    streamed = History(spark, str(tmp_path / "s"), "id")
    plain = History(spark, str(tmp_path / "p"), "id")
    expected = []
    for n, rows in enumerate(batches):
        frame = spark.createDataFrame(rows, SCHEMA)
        frame.coalesce(1).write.mode("append").parquet(str(tmp_path / "landing"))
        stream = ing.landing(spark, str(tmp_path / "landing"), frame.schema)
        ing.ingest(stream, streamed, str(tmp_path / "ckpt"), lambda fresh: {"news": fresh.select("id")}).awaitTermination()
        expected.extend(r.id for r in plain.merge(frame, n).collect())
    assert sorted(r.id for r in streamed.published("news").collect()) == sorted(expected)
    # A run without new files changes nothing.
    version = streamed.runs.manifest()["version"]
    ing.ingest(ing.landing(spark, str(tmp_path / "landing"), SCHEMA), streamed, str(tmp_path / "ckpt"), lambda fresh: {"news": fresh}).awaitTermination()
    assert streamed.runs.manifest()["version"] == version
    one, two = (sorted(map(str, h.current().select("id", "a", "b").collect())) for h in (streamed, plain))
    assert one == two
