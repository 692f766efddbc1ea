"""Ranked word snapshots, their date-by-word matrix, weights and tag statistics.

The working form is long: (source, ts, rank, word).  Wide matrices exist only at the edges.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from newsdesk.functions import arrays as ar
from newsdesk.functions import text as tx
from newsdesk.functions import times as tm
from newsdesk.operators.novelty import map_union
from newsdesk.operators.ranking import cap_per_group, last_wins, position_rank

# Ranks per snapshot and articles per word of the two sources.
TOP_RANKS = 20
ARTICLES_SEARCH = 11
ARTICLES_FEED = 7


def trend_snapshot(mentions: DataFrame, group: list[str], word: str, top: int = TOP_RANKS) -> DataFrame:
    """Rank words by number of mentions inside each group; ties go by word.

    Mentions are counted per (group, word) before anything moves, and each task passes on at most
    `top` words per group.
    """
    counts = mentions.groupBy(*group, word).agg(F.count("*").alias("n"))
    return cap_per_group(counts, group, [F.desc("n"), word], top, rank="rank")


def rank_weight(ranked: DataFrame, group: Iterable[str] = ()) -> DataFrame:
    """Weight of every word over all snapshots: `21 - rank`, nothing for absent or tag ranks."""
    gain = F.greatest(F.lit(TOP_RANKS + 1) - F.col("rank"), F.lit(0)).cast("long")
    weighed = ranked.filter("rank <> 0").groupBy(*group, "word").agg(F.sum(gain).alias("weight"))
    return weighed.filter("weight > 0")


def token_bags(ranked: DataFrame) -> DataFrame:
    """Every ranked cell with the token bag it stands for; the bag stays in its row."""
    return ranked.filter("rank <> 0").withColumn("bag", tx.token_repeat(F.col("word"), F.col("rank")))


def accumulate_sum(frames: list[DataFrame], key: str) -> DataFrame:
    """Sum every column per key over all frames; a missing value counts as 0.

    Not idempotent: the same frame added twice counts twice.
    """
    both = frames[0]
    for other in frames[1:]:
        both = both.unionByName(other, allowMissingColumns=True)
    values = [c for c in both.columns if c != key]
    return both.groupBy(key).agg(*[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in values])


def rank_map(ranked_list: Column, ts: Column) -> Column:
    """Map word -> rank of one snapshot with the date tags put in; of repeated words the last rank counts.

    `ranked_list` is array<struct<rank, word>> in rank order.
    """
    def add(done: Column, entry: Column) -> Column:
        return map_union(done, F.create_map(entry["word"], entry["rank"]))

    empty = F.create_map().cast("map<string,int>")
    return map_union(F.aggregate(ranked_list, empty, add), tm.date_tags(ts))


def matrix_cells(ranked: DataFrame, ts: str = "ts") -> DataFrame:
    """Long matrix rows (source, ts, word, rank): one rank per word, plus the date tags."""
    words = last_wins(ranked, ["source", ts, "word"], "rank", "rank")
    stamps = ranked.select("source", ts).distinct()
    tags = stamps.select("source", ts, F.explode(tm.date_tags(F.col(ts))).alias("word", "rank"))
    return words.unionByName(tags)


def pivot_matrix(ranked: DataFrame, words: list[str], ts: str = "ts") -> DataFrame:
    """One row per snapshot, one column per listed word, 0 where a word is absent.

    The caller names the words: the width of the result never depends on the data.
    """
    wide = ranked.groupBy(ts).pivot("word", words).agg(F.max("rank"))
    return wide.fillna(0, subset=words)


def unpivot_matrix(matrix: DataFrame, words: list[str], ts: str = "ts") -> DataFrame:
    """The ranks of a matrix as rows; absent words give none."""
    return matrix.unpivot([ts], words, "word", "rank").filter("rank <> 0")


def nest_snapshot(ranked: DataFrame, articles: DataFrame, keys: list[str], top: int | None = TOP_RANKS,
                  per_word: int = ARTICLES_SEARCH, label: str = "word", on: str = "word", shown: str = "rank") -> DataFrame:
    """Snapshots as nested documents: words in rank order, each with its first articles.

    `ranked` holds the keys, `rank`, `word` and the shown `label`; `articles` the keys, the column
    `on` (`word`, or `rank` where a word may appear twice), `pos`, `title`, `url`.  Both lists are cut to their fixed lengths before they are gathered; with
    `top` None all words of a snapshot stay, as many as its page listed.  `shown` names another
    column of `ranked` to carry along.
    """
    capped = cap_per_group(articles, [*keys, on], ["pos", "url"], per_word)
    per = capped.groupBy(*keys, on).agg(
        F.sort_array(F.collect_list(F.struct("pos", "title", "url"))).alias("found")
    )
    more = [] if shown == "rank" else [shown]
    words = ranked.select(*keys, "rank", "word", F.col(label).alias("label"), *more)
    if top is not None:
        words = cap_per_group(words, keys, ["rank", "word"], top)
    joined = words.join(per, [*keys, on], "left")
    none = F.array().cast("array<struct<title:string,url:string>>")
    listed = F.transform("found", lambda a: F.struct(a["title"].alias("title"), a["url"].alias("url")))
    entry = F.struct("rank", "word", "label", F.coalesce(listed, none).alias("articles"), *more)
    return joined.groupBy(*keys).agg(F.sort_array(F.collect_list(entry)).alias("rank_list"))


def snapshot_lists(ranked: DataFrame, keys: list[str], top: int = TOP_RANKS) -> DataFrame:
    """One row per snapshot with `ranked`, its words in rank order as array<struct<rank, word>>."""
    words = cap_per_group(ranked.select(*keys, "rank", "word"), keys, ["rank", "word"], top)
    return words.groupBy(*keys).agg(F.sort_array(F.collect_list(F.struct("rank", "word"))).alias("ranked"))


def snapshot_tags(ranked: DataFrame, keys: list[str], ts: str, top: int = TOP_RANKS) -> DataFrame:
    """One published record per snapshot with its ordered tag list: words, then date tags."""
    lists = snapshot_lists(ranked, keys, top)
    names = F.transform("ranked", lambda w: tx.without_commas(w["word"]))
    return lists.select(*keys, F.concat(names, tm.date_tag_names(F.col(ts))).alias("tags"))


def filter_tag(records: DataFrame, tag: str, tags: str = "tags", date: str | None = None,
               on_date: str | None = None) -> DataFrame:
    """Records that carry a tag, optionally of one date."""
    kept = records.filter(F.array_contains(tags, tag))
    return kept if on_date is None else kept.filter(F.col(date) == on_date)


def tag_options(records: DataFrame, tags: str = "tags") -> DataFrame:
    """The distinct tags in use."""
    return ar.item_rows(records, tags, item="tag").distinct()


def tag_rank_counts(records: DataFrame, keys: list[str], tags: str = "tags") -> DataFrame:
    """Rank sum of every tag per key: position + 1, or 99 for date tags.

    One pass over all records instead of one query per tag.
    """
    long = position_rank(records.select(*keys, tags), tags, "tag")
    rank = tx.tag_rank(F.col("tag"), F.col("rank") - 1).cast("long")
    return long.groupBy(*keys, "tag").agg(F.sum(rank).alias("rank"))


def region_interest(landed: DataFrame, keywords: list[str], time_frame: Column | None = None,
                    geo: Column | None = None) -> DataFrame:
    """Region x keyword matrix of summed interest; 0 where a region has none."""
    rows = landed
    for condition in (time_frame, geo):
        if condition is not None:
            rows = rows.filter(condition)
    wide = rows.groupBy("region").pivot("keyword", keywords).agg(F.sum("value"))
    return wide.fillna(0, subset=keywords)
