"""The jobs on a stored history: rows, history and published documents change by one commit or not at all.

Every job has a folder of its own and ascending batch ids; what it finds is compared with what the
folder holds, so a second run on overlapping input publishes only what is new. Each gives the `History`
of its folder, from which `published("pages")`, `published("blocks")` and `current()` are read.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from newsdesk.functions import payloads as pl
from newsdesk.plans import jobs
from newsdesk.session import store
from newsdesk.sources.history import History

PAGES_BY = {"pages": ["database"]}


def _snapshots(spark: SparkSession, folder: str, batch_id: int, ranked: DataFrame, name: str, documents) -> History:
    """Publish the snapshots (column `name` and ts of `ranked`) that are not stored yet.

    `documents` gives the tables of the snapshots it is handed, as (name, ts).
    """
    history = History(spark, folder, "row_id", group=["name"], partitions=PAGES_BY)
    found = ranked.select(F.col(name).alias("name"), "ts").distinct()
    found = found.withColumn("row_id", pl.page_key(F.col("name"), F.col("ts")))
    history.merge(found, batch_id, lambda fresh: documents(store(fresh.select("name", "ts"))))
    return history


def trend_country(spark: SparkSession, folder: str, batch_id: int, ranked: DataFrame, *inputs, **options) -> History:
    """`jobs.trend_country` for the snapshots of a country that are not stored yet, with their matrix cells."""
    def documents(fresh: DataFrame) -> dict[str, DataFrame]:
        wanted = ranked.join(fresh.withColumnRenamed("name", "country"), ["country", "ts"], "left_semi")
        return jobs.trend_country(wanted, *inputs, **options)

    return _snapshots(spark, folder, batch_id, ranked, "country", documents)


def trend_realtime(spark: SparkSession, folder: str, batch_id: int, ranking_pages: DataFrame, *inputs, **options) -> History:
    """`jobs.trend_realtime` for the ranking pages (name and time) that are not stored yet."""
    def documents(fresh: DataFrame) -> dict[str, DataFrame]:
        return jobs.trend_realtime(ranking_pages.join(fresh, ["name", "ts"], "left_semi"), *inputs, **options)

    return _snapshots(spark, folder, batch_id, ranking_pages, "name", documents)


def news_by_rules(spark: SparkSession, folder: str, batch_id: int, conf: DataFrame, pages: DataFrame, details: DataFrame,
                  site: str, marker: str) -> History:
    """New topics of configured list pages, compared one after the other per target, and the refused pages."""
    full, refused = jobs.news_topics(conf, pages, details, site, marker)
    history = History(spark, folder, "seq", group=["target"], sequential=True, partitions=PAGES_BY)

    def documents(fresh: DataFrame) -> dict[str, DataFrame]:
        news = store(full.join(fresh.select("target", "seq"), ["target", "seq"], "left_semi"))
        return {**jobs.news_documents(news), "refused": refused.select("url")}

    history.merge(full.drop("body"), batch_id, documents)
    return history


def news_cards(spark: SparkSession, folder: str, batch_id: int, pages: DataFrame, details: DataFrame, site: str, **options) -> History:
    """Cards that share their date with a new one."""
    full = jobs.card_rows(pages, details, site, **options)
    history = History(spark, folder, "row_id", partitions=PAGES_BY)
    history.merge(full.drop("body"), batch_id, lambda fresh: jobs.card_documents(full, fresh))
    return history


def tech_articles(spark: SparkSession, folder: str, batch_id: int, *inputs) -> History:
    """Articles that share word and date with a new one; every word has its own history."""
    rows = jobs.article_rows(*inputs)
    history = History(spark, folder, "row_id", group=["word"], partitions=PAGES_BY)
    history.merge(rows.drop("tags"), batch_id, lambda fresh: jobs.article_documents(rows, fresh))
    return history


def posts_by_user(spark: SparkSession, folder: str, batch_id: int, posts: DataFrame, users: DataFrame, site: str, per_user) -> History:
    """New posts among the newest of every user, in the user's own history."""
    rows = store(jobs.flat_posts(posts, users, site, per_user).withColumn("row_id", F.col("post_id")))
    history = History(spark, folder, "row_id", group=["user_name"], partitions=PAGES_BY)
    history.merge(rows, batch_id, jobs.post_documents)
    return history
