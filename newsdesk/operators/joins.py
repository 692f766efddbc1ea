"""Equi-joins against a side with one row per key, safe when one key holds much of the other side."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from newsdesk.functions import text as tx
from newsdesk.session import store

HOT_KEYS = 256
#: Copies of a frequent key's row that its many partners are dealt to, where the row is too wide to be broadcast.
SALTS = 64
#: What is broadcast as narrow: at most so many rows and so many characters of them as JSON.
NARROW_ROWS, NARROW_CHARS = 200_000, 64_000_000


def heavy_keys(df: DataFrame, keys: list[str], n: int = HOT_KEYS) -> DataFrame:
    """The `n` most frequent keys: never more than `n` rows, so always small enough to broadcast."""
    return (
        df.dropna("any", subset=keys)
        .groupBy(*keys)
        .agg(F.count("*").alias("_n"))
        .orderBy(F.desc("_n"), *keys)
        .limit(n)
        .select(*keys)
    )


def is_narrow(df: DataFrame) -> bool:
    """Whether rows and size of `df` are within the limits; each task sends one row of sums."""
    size = F.sum(F.length(F.to_json(F.struct("*"))).cast("bigint"))
    rows, chars = df.agg(F.count("*"), size).first()
    return rows <= NARROW_ROWS and (chars or 0) <= NARROW_CHARS


def join_unique(
    left: DataFrame, right: DataFrame, on: str | list[str], how: str = "inner", hot: int = HOT_KEYS,
    narrow: bool = False,
) -> DataFrame:
    """Join `left` with `right`, which holds at most one row per key.

    `narrow` says that the rows of `right` are short (keys and a few labels): it is then counted
    and measured, and broadcast if it is within `NARROW_ROWS` and `NARROW_CHARS`.  Otherwise:

    The rows of the `hot` most frequent keys stay where they are and meet a broadcast of at most
    `hot` rows, if these are measured to be within the limits; wider ones (bodies) are copied `SALTS`
    times and the partners of each dealt to the copies. Every other key holds less than 1/hot of the
    rows and takes the ordinary join.  Rows with a NULL key match nothing and skip the shuffle.
    `hot=0` leaves the choice to Spark.

    `left` is read three times: give it a scan, or cut the lineage of a costly frame before.
    """
    keys = [on] if isinstance(on, str) else list(on)
    if narrow and is_narrow(right):
        return left.join(F.broadcast(right), keys, how)
    if not hot:
        return left.join(right, keys, how)
    heavy = F.broadcast(heavy_keys(left, keys, hot))
    heavy_right = right.join(heavy, keys, "left_semi")
    small = is_narrow(heavy_right)
    known = left.dropna("any", subset=keys)
    spread = known.join(heavy, keys, "left_anti").join(right, keys, how)
    if how in ("left", "left_outer", "left_anti"):
        marked = left.join(heavy.withColumn("_hot", F.lit(True)), keys, "left")
        no_key = reduce(lambda a, b: a | b, [F.col(k).isNull() for k in keys])
        local = marked.filter(F.col("_hot").isNotNull() | no_key).drop("_hot")
    else:
        local = known.join(heavy, keys, "left_semi")
    if small:
        return local.join(F.broadcast(heavy_right), keys, how).unionByName(spread)
    dealt = local.withColumn("_salt", (F.rand(7) * SALTS).cast("int"))
    copies = heavy_right.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    return dealt.join(copies, [*keys, "_salt"], how).drop("_salt").unionByName(spread)


def _addressed(rows: DataFrame) -> DataFrame:
    """`rows` with `_at`, the place of each in its file; a frame that is no scan is stored first."""
    scanned = "_metadata" in rows._jdf.queryExecution().analyzed().metadataOutput().mkString(" ")
    return (rows if scanned else store(rows)).select("*", F.struct("_metadata.file_path", "_metadata.row_index").alias("_at"))


def newest_copies(landed: DataFrame, keys: str | list[str], time: str, wanted: DataFrame | None = None) -> DataFrame:
    """The newest row of every key of records that land again and again, or of the `wanted` keys only.

    Keys, times and row addresses are reduced before any body moves; bodies are then fetched by the
    addresses that won.  Of equally new copies one stays, the same in every run over the same files.
    Rows with a NULL key drop out.
    """
    keys = [keys] if isinstance(keys, str) else list(keys)
    rows = _addressed(landed)
    narrow = rows.select(*keys, time, "_at").dropna("any", subset=keys)
    if wanted is not None:
        narrow = join_unique(narrow, wanted.select(*keys).distinct(), keys, "left_semi", hot=0, narrow=True)
    winners = store(narrow.groupBy(*keys).agg(F.max(F.struct(time, "_at"))["_at"].alias("_at")).select("_at"))
    return join_unique(rows, winners, "_at", "left_semi", hot=0, narrow=True).select(*landed.columns)


def accepted_rows(rows: DataFrame, judged: DataFrame, keys: list[str], hot: int = HOT_KEYS) -> DataFrame:
    """Rows whose key is judged `ok`.

    `judged` holds every key of `rows` once, with its number of rows `n` and the verdict.  The
    verdict on the most frequent keys returns by a broadcast of at most `hot` rows, the rest by a
    join in which no key is frequent.
    """
    heavy = F.broadcast(judged.orderBy(F.desc("n"), *keys).limit(hot).select(*keys, "ok"))
    hot_part = rows.join(heavy.filter("ok"), keys, "left_semi")
    cold_part = rows.join(heavy, keys, "left_anti").join(judged.filter("ok"), keys, "left_semi")
    return hot_part.unionByName(cold_part)


def semi_join_new_dates(
    records: DataFrame, fresh: DataFrame, date: str | list[str] = "date", row_id: str | None = None
) -> DataFrame:
    """Every record that shares its date (and further key columns, if named) with a new record.

    A record without a date shares none; where `row_id` names the rows, it is kept if it is new itself.
    """
    keys = [date] if isinstance(date, str) else list(date)
    dated = join_unique(records, fresh.select(*keys).distinct(), keys, "left_semi", narrow=True)
    if row_id is None:
        return dated
    undated = reduce(lambda a, b: a | b, [F.col(k).isNull() for k in keys])
    return dated.unionByName(records.filter(undated).join(fresh.filter(undated).select(row_id), row_id, "left_semi"))


def join_author(posts: DataFrame, users: DataFrame, author: str = "author_id", user: str = "id") -> DataFrame:
    """Posts with the record of their author; user columns get the prefix `user_`."""
    named = users.select(
        F.col(user).alias(author),
        *[F.col(c).alias(f"user_{c}") for c in users.columns if c != user],
    )
    return join_unique(posts, named, author, narrow=True)


def join_detail(topics: DataFrame, details: DataFrame, on: str = "url", newest: str | None = None) -> DataFrame:
    """Topic rows with the detail record of their page; a detail value replaces a topic value.

    `newest` names the landing time of `details` where a page may have landed more than once.
    """
    if newest is not None:
        details = newest_copies(details, on, newest, topics).drop(newest)
    both = [c for c in details.columns if c in topics.columns and c != on]
    side = details.withColumnsRenamed({c: f"_d_{c}" for c in both}).withColumn("_hit", F.lit(True))
    joined = join_unique(topics, side, on, "left")
    merged = {c: F.when(F.col("_hit"), F.col(f"_d_{c}")).otherwise(F.col(c)) for c in both}
    return joined.withColumns(merged).drop("_hit", *[f"_d_{c}" for c in both])


def last_config(conf: DataFrame, key: str, value: str, pos: str) -> DataFrame:
    """Job parameters with one value per key; of repeated keys the last one counts."""
    return conf.groupBy(key).agg(F.max_by(value, pos).alias(value))


def apply_config(rows: DataFrame, conf: DataFrame, key: str, value: str, pos: str) -> DataFrame:
    """Run every configured key against its input rows."""
    return rows.join(last_config(conf, key, value, pos), key)


def title_lookup(docs: DataFrame, titles: DataFrame, title: str, pos: str) -> DataFrame:
    """First document (smallest `pos`, unique per title) of every wanted title that exists.

    Titles are matched on narrow columns; texts are fetched for the winners only.
    """
    wanted = join_unique(docs.select(title, pos), titles.select(title).distinct(), title, "left_semi", narrow=True)
    winners = wanted.groupBy(title).agg(F.min(pos).alias(pos))
    return docs.join(winners, [title, pos], "left_semi")


def link_blocks(blocks: DataFrame, pages: DataFrame, key: str = "page_key", newest: str | None = None) -> DataFrame:
    """Child blocks with the columns of the page they belong to, of its newest copy where `newest` names a time."""
    if newest is not None:
        pages = newest_copies(pages, key, newest).drop(newest)
    return join_unique(blocks, pages, key)


def landed_rows(wanted: DataFrame, landed: DataFrame, keys: str | list[str], time: str = "landed_at") -> DataFrame:
    """Every wanted key with its landed record: the newest copy where `landed` has a landing time,
    otherwise its one row."""
    if time in landed.columns:
        landed = newest_copies(landed, keys, time, wanted).drop(time)
    return join_unique(wanted, landed, keys, hot=0)


def translate_lookup(
    rows: DataFrame, memory: DataFrame, engine: str, text: str, out: str, page_title: str | None = None
) -> DataFrame:
    """Append the stored translation to a text.

    `memory` holds (engine, src, dst), one row per engine and source text.  The text stays as it is
    without an active engine, without a stored translation, or where the page title names `japan`.
    """
    known = memory.select(F.col("engine").alias("_engine"), F.col("src").alias(text), F.col("dst").alias("_dst"))
    active = tx.engine_name(F.col(engine))
    if page_title is not None:
        active = F.when(F.col(page_title).contains("japan"), F.lit("none")).otherwise(active)
    joined = join_unique(rows.withColumn("_engine", active), known, ["_engine", text], "left", narrow=True)
    suffix = F.when(F.col("_dst").isNull(), F.lit("")).otherwise(
        tx.translated_suffix(F.col("_engine"), F.col("_dst"))
    )
    return joined.withColumn(out, F.concat(F.col(text), suffix)).drop("_engine", "_dst")
