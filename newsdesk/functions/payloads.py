"""Nested page and block documents built from columns; `to_json` at the sink drops every NULL."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from newsdesk.functions import text as tx
from newsdesk.functions import times as tm

# Property names of the four page kinds.
NEWS = {"category": "カテゴリ", "headline": "ヘッドライン", "summary": "サマリ",
        "author": "記者", "site": "ニュースサイト", "date": "日時"}
ARTICLE = {"tag": "タグ", "title": "タイトル", "writer": "ライター", "summary": "サマリー",
           "site": "サイト", "date": "掲載日時", "pick_up": "注目"}
POST = {"type": "ツイートタイプ", "user_id": "ユーザーID", "post_id": "ツイートID", "text": "ツイート",
        "date": "ツイート日時", "user_name": "ユーザー名", "ref": "参照URL"}
TREND = {"tag": "Tag", "translate": "Translate", "name": "Name", "date": "Date"}
MARKS = ("bold", "code", "italic", "strikethrough", "underline")


def page_key(*parts: Column) -> Column:
    """Deterministic key of a page, so that pages and blocks can be written apart and rejoined."""
    return F.sha2(F.concat_ws("\u0001", *[F.coalesce(p.cast("string"), F.lit("")) for p in parts]), 256)


def text_run(content: Column, url: Column | None = None, color: str = "default") -> Column:
    """One piece of text with its marks; the link is left out where the url is NULL."""
    marks = F.struct(*[F.lit(False).alias(m) for m in MARKS], F.lit(color).alias("color"))
    body = [content.alias("content")]
    if url is not None:
        link = F.struct(F.lit("url").alias("type"), url.alias("url"))
        body.append(F.when(url.isNotNull(), link).alias("link"))
    return F.struct(
        marks.alias("annotations"),
        content.alias("plain_text"),
        F.struct(*body).alias("text"),
        F.lit("text").alias("type"),
    )


def text_objects(links: Column, color: str = "default") -> Column:
    """Map text -> url (or NULL) to an array of text runs."""
    return F.transform(F.map_entries(links), lambda e: text_run(e["key"], e["value"], color))


def title(content: Column, url: Column | None = None) -> Column:
    return F.struct(F.array(text_run(content, url)).alias("title"), F.lit("title").alias("type"))


def rich_text(content: Column, url: Column | None = None) -> Column:
    return F.struct(F.array(text_run(content, url)).alias("rich_text"), F.lit("rich_text").alias("type"))


def choice(name: Column) -> Column:
    return F.struct(F.struct(name.alias("name")).alias("select"), F.lit("select").alias("type"))


def choices(names: Column) -> Column:
    listed = F.transform(names, lambda t: F.struct(t.alias("name")))
    return F.struct(listed.alias("multi_select"), F.lit("multi_select").alias("type"))


def checkbox(flag: Column) -> Column:
    return F.struct(flag.alias("checkbox"), F.lit("checkbox").alias("type"))


def date(start: Column, zone: str | None = None) -> Column:
    """Date property; NULL (and so absent from the document) where the start is NULL."""
    fields = [start.alias("start")]
    if zone is not None:
        fields.append(F.lit(zone).alias("time_zone"))
    return F.when(
        start.isNotNull(), F.struct(F.struct(*fields).alias("date"), F.lit("date").alias("type"))
    )


def _page(names: dict[str, str], **values: Column) -> Column:
    return F.struct(F.struct(*[values[k].alias(names[k]) for k in names]).alias("properties"))


def news_page(category, headline, url, summary, author, site, date_text) -> Column:
    return _page(
        NEWS,
        category=choice(tx.or_blank(category)),
        headline=title(headline, url),
        summary=rich_text(tx.or_blank(summary)),
        author=rich_text(tx.or_blank(author)),
        site=rich_text(site),
        date=date(date_text),
    )


def article_page(tags, title_text, url, writer, summary, site, site_url, date_text, pick_up) -> Column:
    return _page(
        ARTICLE,
        tag=choices(tags),
        title=title(title_text, url),
        writer=rich_text(writer),
        summary=rich_text(summary),
        site=rich_text(site, site_url),
        date=date(date_text, tm.ZONE),
        pick_up=checkbox(pick_up),
    )


def post_page(post_type, user_id, post_id, text, url, time_text, user_name, ref_text, ref_url) -> Column:
    return _page(
        POST,
        type=choice(post_type),
        user_id=rich_text(user_id.cast("string")),
        post_id=rich_text(post_id.cast("string")),
        text=rich_text(text, url),
        date=date(tm.post_time_to_iso(time_text)),
        user_name=title(user_name),
        ref=rich_text(ref_text, ref_url),
    )


def trend_page(tags, engine, name, date_text) -> Column:
    return _page(TREND, tag=choices(tags), translate=choice(engine), name=title(name), date=date(date_text))


def trend_page_tags(words: Column, ts: Column) -> Column:
    """Words in rank order without commas, then the three date tags."""
    return F.concat(F.transform(words, tx.without_commas), tm.date_tag_names(ts))


def paragraph(runs: Column, color: str = "default") -> Column:
    return F.struct(runs.alias("rich_text"), F.lit(color).alias("color"))


def paragraph_block(page_id: Column, runs: Column) -> Column:
    return F.struct(
        F.lit("block").alias("object"),
        page_id.alias("id"),
        F.lit("paragraph").alias("type"),
        paragraph(runs).alias("paragraph"),
    )


def heading_block(page_id: Column, content: Column, children: Column, color: str = "blue") -> Column:
    """A first-level heading that carries its child blocks."""
    return F.struct(
        F.lit("block").alias("object"),
        page_id.alias("id"),
        (F.size(children) > 0).alias("has_children"),
        F.lit("heading_1").alias("type"),
        F.struct(
            F.array(text_run(content)).alias("rich_text"),
            F.lit(color).alias("color"),
            children.alias("children"),
        ).alias("heading_1"),
    )


def embed_block(page_id: Column, url: Column) -> Column:
    return F.struct(
        F.lit("block").alias("object"),
        page_id.alias("id"),
        F.lit("embed").alias("type"),
        F.struct(tx.or_blank(url).alias("url")).alias("embed"),
    )


def body_blocks(page_id: Column, body: Column) -> Column:
    """Body elements in order as blocks: paragraphs as text, figures as embeds, empty ones dropped.

    `body` is array<struct<pos, kind, value>>.
    """
    def block(e: Column) -> Column:
        is_text = e["kind"] == "paragraph"
        return F.struct(
            F.lit("block").alias("object"),
            page_id.alias("id"),
            F.when(is_text, F.lit("paragraph")).otherwise(F.lit("embed")).alias("type"),
            F.when(is_text, paragraph(F.array(text_run(e["value"])))).alias("paragraph"),
            F.when(~is_text, F.struct(e["value"].alias("url"))).alias("embed"),
        )

    return F.transform(F.filter(body, lambda e: e["value"].isNotNull() & (e["value"] != "")), block)


def trend_blocks(page_id: Column, rank_list: Column, shown: str = "rank") -> Column:
    """One blue heading per ranked word with one linked paragraph per article.

    `rank_list` is array<struct<rank, word, label, articles array<struct<title, url>>>>; the heading
    shows the field `shown` and the label.
    """
    def children(entry: Column) -> Column:
        return F.transform(
            entry["articles"],
            lambda a: paragraph_block(page_id, F.array(text_run(a["title"], a["url"]))),
        )

    return F.transform(
        rank_list,
        lambda e: heading_block(page_id, tx.heading(e[shown], e["label"]), children(e)),
    )
