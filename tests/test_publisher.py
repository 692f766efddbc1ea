"""The document writer and the stream with state."""

from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from newsdesk.sources import publisher
from newsdesk.sources.history import History
from newsdesk.streaming import ingest as ing
from newsdesk.streaming import stateful

SCHEMA = "page_key string, block_pos int, payload string"


def blocks(pages, tag=""):
    rows = [(f"p{p}", b, f"{tag}{p}-{b}") for p in pages for b in range(p % 5 + 1)]
    random.Random(1).shuffle(rows)
    return rows


def stored(spark, folder):
    found = publisher.read_documents(spark, str(folder))
    return [] if found is None else sorted((r.run, r.page_key, r.block_pos, r.payload) for r in found.collect())


def test_runs_of_documents(spark, tmp_path):
    frame = lambda rows: spark.createDataFrame(rows, SCHEMA).repartition(4)
    assert stored(spark, tmp_path / "d") == []
    listed = publisher.write_documents(frame(blocks(range(40))), str(tmp_path / "d"), 1)
    assert listed["pages"] == 40 and listed["rows"] == len(blocks(range(40)))
    publisher.write_documents(frame(blocks(range(40, 50))), str(tmp_path / "d"), 2)
    expected = sorted([("1", *r) for r in blocks(range(40))] + [("2", *r) for r in blocks(range(40, 50))])
    assert stored(spark, tmp_path / "d") == expected
    publisher.write_documents(frame(blocks(range(40))), str(tmp_path / "d"), 1)  # a repeat gives identical rows
    assert stored(spark, tmp_path / "d") == expected and publisher.orphans(str(tmp_path / "d")) == []
    publisher.write_documents(frame([]), str(tmp_path / "d"), 2)
    assert stored(spark, tmp_path / "d") == [r for r in expected if r[0] == "1"]


@pytest.mark.parametrize("bad", [("p7", 9, "gap"), ("p7", 1, "twice"), (None, 0, "no page")])
def test_a_failed_task_leaves_no_page(spark, tmp_path, bad):
    frame = lambda rows: spark.createDataFrame(rows, SCHEMA).repartition(4)
    folder = str(tmp_path / "d")
    publisher.write_documents(frame(blocks(range(30))), folder, 1)
    before = stored(spark, folder)
    for run in (1, 2):
        with pytest.raises(Exception, match="of page"):
            publisher.write_documents(frame([*blocks(range(30), "new"), bad]), folder, run)
        assert stored(spark, folder) == before and publisher.orphans(folder) == []


def test_rows_that_cannot_be_ordered(spark, tmp_path):
    with pytest.raises(Exception, match="page_key"):
        publisher.write_documents(spark.createDataFrame([(1,)], "page_key int").withColumnRenamed("page_key", "other").withColumn("block_pos", F.lit(0)), str(tmp_path / "d"), 1)


CELLS = "id bigint, site string, a bigint, b string"


def polls(n):
    rng = random.Random(6)
    return [[(100 * p + i, rng.choice("st"), rng.choice([None, *range(12)]), rng.choice("uvw") + str(rng.randint(0, 9))) for i in range(25)] for p in range(n)]


def test_stream_with_state_equals_batches(spark, tmp_path, monkeypatch):
    """Over restarts, with the values of a history as initial state, and with lists of ids cut short."""
    monkeypatch.setattr(stateful, "LISTED", 3)
    folder, rounds = str(tmp_path / "s"), polls(4)
    plain = History(spark, str(tmp_path / "p"), "id", group=["site"])
    frames = [spark.createDataFrame(rows, CELLS) for rows in rounds]
    plain.merge(frames[0], 0)
    known = plain.seen()
    expected = []
    for n, frame in enumerate(frames[1:], 1):
        expected += [r.id for r in plain.merge(frame, n).collect()]
        frame.repartition(2).write.mode("append").parquet(f"{folder}/landing")
        stream = ing.landing(spark, f"{folder}/landing", frame.schema)
        stateful.start(stateful.fresh_ids(stream, "id", group=["site"], seen=known), folder).awaitTermination()
    landed = spark.read.parquet(f"{folder}/landing")
    got = lambda: sorted(r.id for r in stateful.fresh_rows(landed, folder, "id").collect())
    assert got() == sorted(expected)
    stream = ing.landing(spark, f"{folder}/landing", CELLS)
    stateful.start(stateful.fresh_ids(stream, "id", group=["site"], seen=known), folder).awaitTermination()
    assert got() == sorted(expected)  # a run without new files changes nothing
