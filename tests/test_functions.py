from __future__ import annotations

import datetime as dt
import json
from urllib.parse import urljoin

import pytest
from pyspark.sql import functions as F

from newsdesk.functions import arrays as ar
from newsdesk.functions import links as ln
from newsdesk.functions import payloads as pl
from newsdesk.functions import text as tx
from newsdesk.functions import times as tm
from newsdesk.operators import localise, novelty, trends


def one(spark, column):
    return spark.range(1).select(column.alias("v")).first()["v"]


BASES = ["http://a.example/b/c/d?q=1#f", "https://a.example", "https://a.example/", "http://a.example/b/c/"]
LINKS = ["", "x", "./x", "../x", "../../x", "../../../x", "/x", "/x/../y", "/x/./y/", "//h.example/p/../q", "?z=2",
         "#top", "https://other.example/a/../b", "x/y?p=1#g", "..", ".", "x//y", "mailto:a@b.example", "/x/..", "javascript:void(0)"]


def test_resolve_url_agrees_with_urljoin(spark):
    pairs = [(b, link) for b in BASES for link in LINKS]
    rows = spark.createDataFrame(pairs, "base string, link string").select(
        "base", "link", ln.resolve_url(F.col("base"), F.col("link")).alias("got")).collect()
    wrong = [(r.base, r.link, r.got, urljoin(r.base, r.link)) for r in rows if r.got != urljoin(r.base, r.link)]
    assert not wrong


@pytest.mark.parametrize("text, expected", [
    ("2022-05-01T15:30:00Z", "2022-05-02T00:30:00+09:00"),
    ("2022-05-01T15:30:00.250000Z", "2022-05-02T00:30:00.250000+09:00"),
    ("2022-05-01T10:30:00-05:00", "2022-05-02T00:30:00+09:00"),
    ("2022-05-01T15:30:00", "2022-05-02T00:30:00+09:00"),
    ("no date", None),
])
def test_iso_to_jst(spark, text, expected):
    assert one(spark, tm.iso_to_jst(F.lit(text))) == expected


def test_times(spark):
    ts = F.lit("2022-04-30 15:00:59.999").cast("timestamp_ntz")
    assert one(spark, tm.utc_to_jst_text(ts)) == "2022-05-01_00:00:59"
    assert one(spark, tm.post_time_to_iso(tm.utc_to_jst_text(ts))) == "2022-05-01T00:00:59.000+09:00"
    assert one(spark, tm.compact_to_iso(F.lit("202204301500"))) == "2022-04-30T15:00:00+09:00"
    assert one(spark, tm.date_tags(ts)) == {"@2022年": 99, "@04月": 99, "@04月30日": 99}
    now = one(spark, tm.snapshot_time())
    assert abs(now - (dt.datetime.now(dt.UTC).replace(tzinfo=None) + dt.timedelta(hours=9))) < dt.timedelta(minutes=5)


def test_text(spark):
    assert one(spark, tx.rstrip(F.lit("語　　 \t"))) == "語"
    assert one(spark, tx.lines(F.lit("a\r\nb\n\nc\n"))) == ["a", "b", "", "c"]
    assert one(spark, tx.headline_summary(F.lit("　Head　Sum12 x3"))).asDict() == {"headline": "Head", "summary": "Sum"}
    assert one(spark, tx.headline_summary(F.lit("Only9"))).asDict() == {"headline": "Only9", "summary": "Only"}
    assert one(spark, tx.headline_summary(F.lit("  "))).asDict() == {"headline": None, "summary": None}
    assert one(spark, tx.script_tokens(F.lit("東京タワーへ行くABC"))) == ["東京", "タワー", "へ", "行", "く", "abc"]
    assert one(spark, tx.trim_nonempty(F.array(F.lit(" a　"), F.lit("  "), F.lit("b")))) == ["a", "b"]
    marked = [one(spark, tx.is_content_line(F.lit(s), "［＃")) for s in ("本文［＃注］", "", "　", "本文《ほんぶん》")]
    assert marked == [False, False, True, True]
    assert [one(spark, tx.post_type(F.lit(s))) for s in ("RT x", "@a", "a RT")] == ["Retweet", "Reply", "Tweet"]
    assert one(spark, tx.or_zero_text(F.lit(None).cast("string"))) == "0"
    assert one(spark, tx.ngrams(F.split(F.lit("a b c"), " "), 2)) == ["a b", "b c"]
    assert one(spark, tx.ngrams(F.split(F.lit("a"), " "), 2)) == []
    assert [one(spark, F.size(tx.token_repeat(F.lit("w"), F.lit(r)))) for r in (1, 20, 21, 99)] == [20, 1, 0, 0]


def test_arrays(spark):
    items = F.array(*[F.lit(s) for s in "abcde"])
    assert [tuple(p) for p in one(spark, ar.pairs(items))] == [("a", "b"), ("c", "d")]
    assert one(spark, ar.pairs(F.array(F.lit("a")))) == []
    assert one(spark, ar.alternating(ar.pairs(items))) == list("abcd")
    block = F.lit("now\n1\nfirst\n2\nsecond\n3")
    assert [tuple(p) for p in one(spark, ar.rank_word_lines(block))] == [("1", "first"), ("2", "second")]
    for n, kept in ((0, 0), (5, 0), (6, 0), (7, 1), (10, 4)):
        body = F.transform(F.sequence(F.lit(1), F.lit(10)), lambda x: x)
        assert len(one(spark, ar.trim_ends(ar.first_n(body, n)))) == kept


def test_links(spark):
    urls = "array<struct<url:string,expanded_url:string>>"
    entry = F.from_json(F.lit('[{"url":"s1","expanded_url":"https://me.example/1"},{"url":"s2","expanded_url":"https://x.example"}]'), urls)
    own = F.lit("https://me.example")
    assert tuple(one(spark, ln.first_external_url(entry, own))) == ("s2", "[ LINK ]")
    for empty in ("[]", '[{"url":"s1","expanded_url":"https://me.example/1"}]'):
        assert tuple(one(spark, ln.first_external_url(F.from_json(F.lit(empty), urls), own))) == ("None", "None")
    assert tuple(one(spark, ln.first_external_url(F.lit(None).cast(urls), own))) == ("None", "None")
    assert one(spark, ln.regex_after(F.lit("<User id=12ab name=x>"), "User id=")) == "12ab"
    assert one(spark, ln.post_url("https://s.example", F.lit("me"), F.lit(1512345678901234567))) == "https://s.example/me/status/1512345678901234567"


def _plain(value):
    """Documents compare equal whether a key is absent or null."""
    if isinstance(value, dict):
        return {k: _plain(v) for k, v in value.items() if v is not None}
    return [_plain(v) for v in value] if isinstance(value, list) else value


def _run(content, url=None, color="default"):
    link = {"type": "url", "url": url} if url else None
    marks = {"bold": False, "code": False, "color": color, "italic": False, "strikethrough": False, "underline": False}
    return {"annotations": marks, "href": None, "plain_text": content, "text": {"content": content, "link": link}, "type": "text"}


def test_news_page(spark):
    none = F.lit(None).cast("string")
    made = json.loads(one(spark, F.to_json(pl.news_page(
        none, F.lit("見出し"), F.lit("u"), F.lit("要約"), none, F.lit("S"), none))))
    assert made == _plain({"properties": {
        "カテゴリ": {"type": "select", "select": {"name": " "}},
        "ヘッドライン": {"title": [_run("見出し", "u")], "type": "title"},
        "サマリ": {"rich_text": [_run("要約")], "type": "rich_text"},
        "記者": {"rich_text": [_run(" ")], "type": "rich_text"},
        "ニュースサイト": {"rich_text": [_run("S")], "type": "rich_text"},
    }})
    dated = json.loads(one(spark, F.to_json(pl.date(F.lit("2022-05-01"), "Asia/Tokyo"))))
    assert dated == {"date": {"start": "2022-05-01", "time_zone": "Asia/Tokyo"}, "type": "date"}


def test_body_blocks_keep_order_and_drop_empty(spark):
    body = F.from_json(F.lit('[{"pos":0,"kind":"paragraph","value":"p"},{"pos":1,"kind":"paragraph","value":""},'
                             '{"pos":2,"kind":"figure","value":"img.png"},{"pos":3,"kind":"figure"}]'),
                       "array<struct<pos:int,kind:string,value:string>>")
    made = json.loads(one(spark, F.to_json(pl.body_blocks(F.lit("k"), body))))
    assert made == [
        {"object": "block", "id": "k", "type": "paragraph", "paragraph": {"rich_text": [_plain(_run("p"))], "color": "default"}},
        {"object": "block", "id": "k", "type": "embed", "embed": {"url": "img.png"}},
    ]


def test_trend_blocks(spark):
    ranks = F.from_json(F.lit('[{"rank":1,"word":"w","label":"w x","articles":[{"title":"t","url":"u"}]},{"rank":2,"word":"v","label":"v","articles":[]}]'),
                        "array<struct<rank:int,word:string,label:string,articles:array<struct<title:string,url:string>>>>")
    first, second = json.loads(one(spark, F.to_json(pl.trend_blocks(F.lit("k"), ranks))))
    assert first["heading_1"]["rich_text"][0]["plain_text"] == "1 : w x"
    assert first["heading_1"]["color"] == "blue" and first["has_children"]
    assert first["heading_1"]["children"][0]["paragraph"]["rich_text"] == [_plain(_run("t", "u"))]
    assert second["heading_1"]["children"] == []


def test_maps(spark):
    left = F.create_map(F.lit("a"), F.lit(1), F.lit("b"), F.lit(2))
    right = F.create_map(F.lit("b"), F.lit(9))
    assert one(spark, novelty.map_union(left, right)) == {"a": 1, "b": 9}
    ranked = F.from_json(F.lit('[{"rank":1,"word":"x"},{"rank":2,"word":"y"},{"rank":3,"word":"x"}]'), "array<struct<rank:int,word:string>>")
    day = F.lit("2022-05-01").cast("timestamp_ntz")
    assert one(spark, trends.rank_map(ranked, day)) == {"x": 3, "y": 2, "@2022年": 99, "@05月": 99, "@05月01日": 99}


def test_engine_registry(spark):
    registry = localise.default_registry()
    assert registry.is_active("deepl") and not registry.is_active("none")
    assert one(spark, registry.create("google")(F.lit("w"), F.lit("訳"))) == "w\n [G翻訳] 訳"
    assert one(spark, registry.create("none")(F.lit("w"), F.lit("訳"))) == "w"
    with pytest.raises(TypeError):
        registry.register("broken", "text")
    with pytest.raises(TypeError):
        registry.register("broken", lambda a, b: "text")
    with pytest.raises(KeyError):
        registry.create("unknown")
