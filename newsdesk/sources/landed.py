"""Landed records: posts with side records, ranked lists."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from newsdesk.session import store

# Fixed value: the fields kept of a user's posts and of the users that come with them.
POSTS = (
    "data array<struct<id:bigint,text:string,created_at:timestamp_ntz,author_id:bigint,"
    "conversation_id:bigint,entities:struct<urls:array<struct<url:string,expanded_url:string>>>,"
    "referenced_tweets:array<struct<type:string,id:bigint>>>>, "
    "includes struct<users:array<struct<id:bigint,name:string,username:string,"
    "created_at:timestamp_ntz,description:string,url:string>>>"
)


def read_posts(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """Posts and users of landed API answers (JSON, one answer per line)."""
    answers = spark.read.schema(POSTS).json(path)
    posts = answers.select(F.inline("data"))
    users = answers.select(F.inline("includes.users"))
    one = users.groupBy("id").agg(F.max(F.struct(*[c for c in users.columns if c != "id"])).alias("u"))
    return posts, one.select("id", "u.*")


# Fixed value: a whole answer with its posts, the users and posts they refer to, and its newest post.
ANSWER = POSTS.replace("includes struct<", "meta struct<newest_id:bigint>, includes struct<tweets:array<struct<id:bigint,text:string,created_at:timestamp_ntz,author_id:bigint>>,")
BROKEN = "broken"


def read_answers(spark: SparkSession, path: str) -> dict[str, DataFrame]:
    """Landed API answers (JSON, one per line) as tables, one row per id.

    `posts`, `users` and `referenced` (posts that others point to): of records that landed more than once
    the one of the newest answer stays, of equally new ones the greatest. `refused`: the text of lines
    that cannot be read.
    """
    reader = spark.read.schema(f"{ANSWER}, {BROKEN} string").option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", BROKEN)
    lines = store(reader.json(path))
    answers = lines.filter(F.col(BROKEN).isNull()).withColumn("newest", F.coalesce("meta.newest_id", F.lit(-1).cast("bigint")))

    def newest(items: str) -> DataFrame:
        rows = answers.select("newest", F.explode(items).alias("r")).filter("r.id IS NOT NULL")
        best = rows.groupBy(F.col("r.id").alias("id")).agg(F.max(F.struct("newest", "r"))["r"].alias("r"))
        return best.select("r.*")

    return {
        "posts": newest("data"),
        "users": newest("includes.users"),
        "referenced": newest("includes.tweets"),
        "refused": lines.filter(F.col(BROKEN).isNotNull()).select(BROKEN),
    }


def parse_props(props: Column, schema: str) -> Column:
    """A JSON column read with a fixed schema; unreadable text gives NULL fields."""
    return F.from_json(props, schema)


def parent_of(referenced: Column) -> Column:
    """Id of the first referenced post."""
    return F.get(referenced, F.lit(0))["id"]
