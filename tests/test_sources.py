from __future__ import annotations

import json

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from newsdesk.functions import payloads as pl
from newsdesk.functions import text as tx
from newsdesk.operators import corpus, joins
from newsdesk.plans import jobs
from newsdesk.sources import files, landed, sinks, tables


def test_tables(spark):
    frame = spark.createDataFrame([(1, "a", None), (None, None, None), (2, None, None)], "id int, name string, note string")
    spark.sql("DROP TABLE IF EXISTS conf_words")
    assert tables.ensure_table(spark, "conf_words", frame.schema) is False
    frame.write.insertInto("conf_words")
    assert tables.ensure_table(spark, "conf_words", frame.schema) is True
    read = tables.read_table_pruned(spark, "conf_words")
    assert read.columns == ["id", "name"] and read.count() == 2
    with pytest.raises(AnalysisException):
        tables.read_table_pruned(spark, "no_such_table")
    assert tables.first_value(frame, "id", "name").first()[0] == "a"
    assert tables.relabel(frame, ["x", "i", "n", "t"], {"p": F.lit(0)}).columns == ["x", "i", "n", "t"]


def test_ids_keep_all_digits(spark):
    ids = spark.createDataFrame([("1512345678901234567",), ("None",)], "post_id string")
    assert [r[0] for r in tables.ids_to_text(ids, ["post_id"]).collect()] == ["1512345678901234567", None]
    assert [r[0] for r in tables.ids_to_long(ids, ["post_id"]).collect()] == [1512345678901234567, None]


def test_text_lines(spark, tmp_path):
    (tmp_path / "t.txt").write_text("題名\n\n　本文です。　　\n［＃ここから］\n途中［＃注］です\n　\n終《おわり》\n", encoding="utf-8")
    got = [r.stream for r in files.text_lines(spark, str(tmp_path / "t.txt"), "［＃").collect()]
    assert got == ["題名", "　本文です。", "", "終《おわり》"]
    docs = spark.createDataFrame([("d", "題名\n\n　\n途中［＃注］です\n")], "doc string, text string")
    kept = corpus.content_lines(docs, "doc", "text", "［＃").collect()
    assert [(r.line_no, r.stream) for r in kept] == [(0, "題名"), (2, "")]


def test_stopwords(spark, tmp_path):
    (tmp_path / "s.txt").write_text(" あそこ　\n\n　\nこれ\n", encoding="utf-8")
    assert sorted(r.word for r in files.stopwords(spark, str(tmp_path / "s.txt")).collect()) == ["あそこ", "これ"]


def test_xml_docs(spark, tmp_path):
    (tmp_path / "x.xml").write_text(
        '<docs><doc id="1" title="山">たかい &amp; とおい</doc>\n<doc id="2" title="川">ながい</doc>\n<doc id="3" title="山">二つ目</doc></docs>',
        encoding="utf-8")
    docs = files.xml_docs(spark, str(tmp_path / "x.xml"))
    rows = docs.withColumn("pos", F.when(F.col("_VALUE") == "二つ目", 2).otherwise(1))
    wanted = spark.createDataFrame([("山",), ("海",)], "_title string")
    assert [r._VALUE for r in joins.title_lookup(rows, wanted, "_title", "pos").collect()] == ["たかい & とおい"]


def test_csv_merge_and_accumulate(spark, tmp_path):
    at = lambda n: str(tmp_path / f"v{n}")
    first = spark.createDataFrame([(1, "a", 1.5), (2, "b", 2.5)], "id bigint, name string, v double")
    second = spark.createDataFrame([(3, "a", 1.5), (4, "c", 2.5), (5, "b", None)], first.schema)
    assert files.csv_history_merge(first, at(0), at(1), "id").count() == 2
    assert sorted(r.id for r in files.csv_history_merge(second, at(1), at(2), "id").collect()) == [4, 5]
    stored = {(r.id, r.name, r.v) for r in files.read_history_csv(spark, at(2), first.schema).collect()}
    assert stored == {(3, "a", 1.5), (4, "c", 2.5), (5, "b", 0.0), (2, "b", 2.5)}
    one = spark.createDataFrame([("2022-05-01", 1, 2)], "day string, x bigint, y bigint")
    two = spark.createDataFrame([("2022-05-01", 5, 7), ("2022-05-02", 1, 1)], "day string, x bigint, z bigint")
    files.csv_accumulate(one, at(10), at(11), "day")
    total = {r.day: (r.x, r.y, r.z) for r in files.csv_accumulate(two, at(11), at(12), "day").collect()}
    assert total == {"2022-05-01": (6, 2, 7), "2022-05-02": (1, 0, 1)}
    half = spark.createDataFrame([("2022-05-01", 1.5)], "day string, y double")
    files.csv_accumulate(half, at(20), at(21), "day")
    kept = files.csv_accumulate(two, at(21), at(22), "day")  # a batch without y leaves its decimals
    assert {r.day: r.y for r in kept.collect()} == {"2022-05-01": 1.5, "2022-05-02": 0}
    twice = {r.day: r.x for r in files.csv_accumulate(two, at(12), at(13), "day").collect()}
    assert twice == {"2022-05-01": 11, "2022-05-02": 2}  # a rerun counts twice


def test_posts(spark, tmp_path):
    answer = {
        "data": [
            {"id": 1512345678901234567, "text": "@you hi", "created_at": "2022-05-01T15:30:10", "author_id": 7,
             "conversation_id": 1, "entities": {"urls": [{"url": "s1", "expanded_url": "https://p.example/me/1"},
                                                         {"url": "s2", "expanded_url": "https://other.example"}]},
             "referenced_tweets": [{"type": "replied_to", "id": 5}]},
            {"id": 2, "text": "RT x", "created_at": "2022-05-01T10:00:00", "author_id": 7},
            {"id": 3, "text": "old", "created_at": "2022-04-01T10:00:00", "author_id": 7},
        ],
        "includes": {"users": [{"id": 7, "name": "Me", "username": "me"}, {"id": 8, "name": "You", "username": "you"}]},
    }
    (tmp_path / "a.json").write_text(json.dumps(answer) + "\n" + json.dumps(answer) + "\n")
    posts, users = landed.read_posts(spark, str(tmp_path))
    assert users.count() == 2
    assert posts.select(landed.parent_of(F.col("referenced_tweets")).alias("p")).filter("p = 5").count() == 2
    posts = posts.dropDuplicates(["id"]).withColumn("urls", F.col("entities.urls"))
    history = spark.createDataFrame([], ", ".join(
        f"{c} {'bigint' if c.endswith('id') else 'string'}" for c in jobs.POST_LABELS))
    out = jobs.posts_by_user(posts, users, history, "https://p.example", 2)
    rows = {r.post_id: r for r in out["posts"].collect()}
    assert set(rows) == {1512345678901234567, 2}
    reply = rows[1512345678901234567]
    assert (reply.post_time, reply.user_name, reply.post_type) == ("2022-05-02_00:30:10", "Me", "Reply")
    assert (reply.ref_url, reply.ref_text) == ("s2", "[ LINK ]")
    assert (rows[2].post_type, rows[2].ref_url) == ("Retweet", "None")
    assert out["export"].columns == list(jobs.POST_LABELS.values())
    assert out["new"].count() == 2
    seen = out["posts"].filter("post_id = 2")
    assert [r.post_id for r in jobs.posts_by_user(posts, users, seen, "https://p.example", 2)["new"].collect()] == [1512345678901234567]


def test_publishing(spark, tmp_path):
    docs = spark.createDataFrame([("a", "x\n\ny", "db1"), ("b", "z", "db2")], "id string, text string, db string")
    key = pl.page_key(F.col("id"))
    pages = sinks.page_rows(docs, key, F.col("db"), pl.trend_page(F.array("id"), F.lit("off"), F.col("id"), F.lit(None).cast("string")), "id")
    sinks.publish_pages(pages, str(tmp_path / "pages"))
    stored = spark.read.schema(pages.schema).json(str(tmp_path / "pages"))
    assert {(r.database, json.loads(r.payload)["properties"]["Name"]["title"][0]["plain_text"]) for r in stored.collect()} == {("db1", "a"), ("db2", "b")}
    body = F.transform(tx.lines(F.col("text")), lambda t, i: F.struct(i.alias("pos"), F.lit("paragraph").alias("kind"), t.alias("value")))
    blocks = sinks.block_rows(docs, key, pl.body_blocks(key, body))
    for _ in range(2):  # a named run replaces itself
        sinks.publish_blocks(blocks, str(tmp_path / "blocks"), run=7)
    linked = joins.link_blocks(spark.read.parquet(str(tmp_path / "blocks")), pages.select("page_key", "id"))
    assert sorted((r.id, r.block_pos) for r in linked.collect()) == [("a", 0), ("a", 1), ("b", 0)]
    sinks.write_targets(tables.with_target(docs, "db", "id"), str(tmp_path / "targets"))
    assert sorted(p.name for p in (tmp_path / "targets").glob("target=*")) == ["target=db1_a", "target=db2_b"]
    many = spark.range(4000).repartition(8).select("id", F.concat(F.lit("t"), F.col("id") % 20).alias("target"))
    sinks.write_targets(many, str(tmp_path / "many"))
    assert len(list((tmp_path / "many").glob("target=*/*.parquet"))) == 20


def test_text_files_grow_in_number(spark, tmp_path):
    """Documents go to files of bounded size, named in the order of their ids."""
    from newsdesk.queries.jobs import text_files

    docs = spark.range(200).select(F.col("id").alias("doc_id"), F.lit("t").alias("title"), F.format_string("%0100d", "id").alias("text"))
    text_files(docs.orderBy(F.desc("doc_id")), str(tmp_path / "xml"), 1000)
    found = sorted((tmp_path / "xml").glob("part-*"))
    assert len(found) > 10 and max(f.stat().st_size for f in found) < 6000
    rows = files.xml_docs(spark, str(tmp_path / "xml")).withColumn("pos", F.struct("_metadata.file_path", F.monotonically_increasing_id()))
    assert [int(r._VALUE) for r in rows.orderBy("pos").collect()] == list(range(200))
