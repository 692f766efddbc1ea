"""Page extraction.

Flat patterns (links, meta fields, cards) are built-in regex expressions.  Rules that need the
element tree go through four Arrow-batched Python functions over one small tree builder; each
returns arrays in document order, so no grouping is needed to put a page together again.
"""

from __future__ import annotations

import json
import re
import weakref
from html.entities import name2codepoint
from html.parser import HTMLParser

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Elements without content, and elements whose content is no text.
VOID = frozenset("area base br col embed hr img input link meta source track wbr".split())
OPAQUE = frozenset(("script", "style"))
# What may stand between the name of a tag and an attribute, and after it: a quoted value is one unit.
BEFORE = r"""(?=[\s/>])(?:[^>"']|"[^"]*"|'[^']*')*?"""
AFTER = r"""(?:[^>"']++|"[^"]*+"|'[^']*+')*+>"""
REFERENCE = r"&(?:#[0-9]+|#[xX][0-9a-fA-F]+|[A-Za-z][A-Za-z0-9]*);"

# ---------------------------------------------------------------- built-in expressions


def visible(html: Column) -> Column:
    """Markup without comments, scripts and styles."""
    return F.regexp_replace(html, r"(?is)<script\b.*?</script>|<style\b.*?</style>|<!--.*?-->", "")


def _opening(tag: str, attribute: str) -> str:
    """Pattern of an opening tag up to an attribute; its value is group 1, 2 or 3 by its quoting.

    The name stands alone: `data-href` and `xlink:href` are other attributes than `href`.
    """
    return rf"""<{tag}{BEFORE}(?<=[\s"'/]){re.escape(attribute)}\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>"']+))"""


def _value(markup: Column, pattern: str) -> Column:
    """Decoded value of the attribute that `_opening` finds; empty where there is none."""
    return decode_references(F.concat(*[F.regexp_extract(markup, pattern, n) for n in (1, 2, 3)]))


def _character(code: Column) -> Column:
    """The character of a code point; U+FFFD for what is none."""
    valid = code.between(1, 0x10FFFF) & ~code.between(0xD800, 0xDFFF)
    return F.when(valid, F.decode(F.unhex(F.lpad(F.hex(code), 8, "0")), "UTF-32")).otherwise(F.lit("�"))


def decode_references(text: Column) -> Column:
    """Text with its named (HTML 4 and `&apos;`) and numeric character references decoded, each once."""
    names = F.create_map(*[F.lit(x) for name, code in {**name2codepoint, "apos": 39}.items() for x in (name, chr(code))])

    def decoded(ref: Column) -> Column:
        digits = F.regexp_extract(ref, "([0-9a-fA-F]+);", 1)
        return (F.when(ref.rlike("^&#[xX]"), _character(F.conv(digits, 16, 10).try_cast("bigint")))
                .when(ref.startswith("&#"), _character(digits.try_cast("bigint")))
                .otherwise(F.coalesce(F.try_element_at(names, F.regexp_extract(ref, "&(.*);", 1)), ref)))

    def whole(s: Column) -> Column:
        refs = F.transform(F.regexp_extract_all(s, F.lit(REFERENCE), F.lit(0)), decoded)
        between = F.split(s, REFERENCE, -1)
        return F.when(s.contains("&"), F.array_join(F.transform(F.arrays_zip(between.alias("t"), refs.alias("r")), lambda x: F.concat(x["t"], F.coalesce(x["r"], F.lit("")))), "")).otherwise(s)

    # One-element arrays: the text is computed once, also inside a lambda.
    return F.get(F.transform(F.array(text), whole), F.lit(0))


def inner_text(markup: Column) -> Column:
    """Text of a piece of markup: tags dropped, character references decoded."""
    return decode_references(F.regexp_replace(markup, "<[^>]*>", ""))


def extract_meta(html: Column, name: str) -> Column:
    """Content of a named meta element, NULL where it is missing or empty."""
    metas = F.regexp_extract_all(html, F.lit(rf"(?is)<meta(?=[\s/>]){AFTER}"), F.lit(0))
    named = F.filter(metas, lambda m: F.lower(_value(m, "(?is)" + _opening("meta", "name"))) == name.lower())
    contents = F.transform(named, lambda m: _value(m, "(?is)" + _opening("meta", "content")))
    return F.get(F.filter(contents, lambda c: c != ""), F.lit(0))


def extract_attribute(html: Column, tag: str, attribute: str) -> Column:
    """An attribute of the first element of a kind that has it, NULL where it is missing."""
    return F.nullif(_value(html, "(?is)" + _opening(tag, attribute)), F.lit(""))


ANCHOR = rf"(?is){_opening('a', 'href')}{AFTER}(.*?)</a>"


def extract_links(html: Column) -> Column:
    """All anchors with a link, in order, as array<struct<title, url>>."""
    anchors = F.regexp_extract_all(visible(html), F.lit(ANCHOR), F.lit(0))
    return F.transform(
        anchors,
        lambda m: F.struct(
            inner_text(F.regexp_extract(m, ANCHOR, 4)).alias("title"),
            _value(m, ANCHOR).alias("url"),
        ),
    )


def link_by_text(links: Column, wanted: str) -> Column:
    """Link of the first anchor with the given text."""
    return F.get(F.filter(links, lambda a: a["title"] == wanted), F.lit(0))["url"]


def element_markup(html: Column, tag: str) -> Column:
    """Markup inside every (not nested) element of a kind, in order."""
    return F.regexp_extract_all(visible(html), F.lit(rf"(?is)<{tag}\b[^>]*>(.*?)</{tag}>"), F.lit(1))


def element_links(html: Column, tag: str) -> Column:
    """First link of every element of a kind that has one, as array<struct<title, url>>.

    The part of an element before one nested in it is its own: no item of a nested list is lost.
    """
    own = rf"(?is)<{tag}(?=[\s/>]){AFTER}(.*?)(?=<{tag}[\s/>]|</{tag}[\s>])"
    links = F.transform(
        F.regexp_extract_all(visible(html), F.lit(own), F.lit(1)),
        lambda m: F.struct(
            inner_text(F.regexp_extract(m, ANCHOR, 4)).alias("title"),
            F.nullif(_value(m, ANCHOR), F.lit("")).alias("url"),
        ),
    )
    return F.filter(links, lambda a: a["url"].isNotNull())


def extract_cards(html: Column, card: str = "article", link_in: str = "h3") -> Column:
    """Text of every card element and the first link inside its headings, as array<struct<text, url>>."""
    def link(markup: Column) -> Column:
        headings = F.regexp_extract_all(markup, F.lit(rf"(?is)<{link_in}(?=[\s/>]){AFTER}(.*?)</{link_in}>"), F.lit(1))
        urls = F.transform(headings, lambda h: _value(h, "(?is)" + _opening("a", "href")))
        return F.get(F.filter(urls, lambda u: u != ""), F.lit(0))

    return F.transform(
        element_markup(html, card),
        lambda m: F.struct(inner_text(m).alias("text"), link(m).alias("url")),
    )


# ---------------------------------------------------------------- element tree


class _Node:
    """An element. It holds its children and only refers to its parent, so that a tree that was read is
    freed at once and trees do not pile up until the garbage collector runs."""

    __slots__ = ("tag", "attrs", "kids", "_up", "__weakref__")

    def __init__(self, tag, attrs, up):
        self.tag, self.attrs, self.kids, self._up = tag, attrs, [], None if up is None else weakref.ref(up)

    @property
    def up(self):
        return None if self._up is None else self._up()

    def walk(self):
        """Elements below this one, in document order."""
        stack = [k for k in reversed(self.kids) if isinstance(k, _Node)]
        while stack:
            node = stack.pop()
            yield node
            stack.extend(k for k in reversed(node.kids) if isinstance(k, _Node))

    def strings(self):
        stack = list(reversed(self.kids))
        while stack:
            kid = stack.pop()
            if isinstance(kid, str):
                yield kid
            elif kid.tag not in OPAQUE:
                stack.extend(reversed(kid.kids))

    def text(self):
        return "".join(self.strings())

    def classes(self):
        return (self.attrs.get("class") or "").split()


class _Builder(HTMLParser):
    """Builds the tree; an open paragraph ends where the next one starts."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.root = self.at = _Node("", {}, None)

    def handle_starttag(self, tag, attrs):
        if tag == "p":
            self._close("p")
        node = _Node(tag, dict(attrs), self.at)
        self.at.kids.append(node)
        if tag not in VOID:
            self.at = node

    def handle_startendtag(self, tag, attrs):
        self.at.kids.append(_Node(tag, dict(attrs), self.at))

    def handle_endtag(self, tag):
        self._close(tag)

    def handle_data(self, data):
        self.at.kids.append(data)

    def _close(self, tag):
        node = self.at
        while node is not None and node.tag != tag:
            node = node.up
        if node is not None:
            self.at = node.up


def _tree(html: str | None) -> _Node:
    builder = _Builder()
    builder.feed(html or "")
    builder.close()
    return builder.root


_parsed: dict[str, object] = {}


def _steps(selector: str):
    """`tag.class > tag` as a list of (direct child?, tag, classes)."""
    if selector in _parsed:
        return _parsed[selector]
    steps, direct = [], False
    for part in selector.split():
        if part == ">":
            direct = True
            continue
        tag, *classes = part.split(".")
        steps.append((direct, tag, frozenset(classes)))
        direct = False
    _parsed[selector] = tuple(steps)
    return _parsed[selector]


def _fits(node: _Node, step) -> bool:
    return (not step[1] or node.tag == step[1]) and step[2].issubset(node.classes())


def _select(top: _Node, selector: str):
    """Elements below `top` for a selector of descendant and child steps."""
    steps = _steps(selector)

    def holds(node, i):
        if not _fits(node, steps[i]):
            return False
        if i == 0:
            return True
        up = node.up
        while up is not None and up is not top:
            if holds(up, i - 1):
                return True
            if steps[i][0]:
                return False
            up = up.up
        return False

    return (n for n in top.walk() if holds(n, len(steps) - 1))


def _first(nodes):
    return next(iter(nodes), None)


def _text_of(node):
    return None if node is None else node.text()


def _rules(text: str) -> dict:
    if text not in _parsed:
        _parsed[text] = json.loads(text)
    return _parsed[text]


# ---------------------------------------------------------------- Arrow-batched extractors

# Result types as objects: worker processes import this module and have no session to parse text.
_TEXT, _INT = T.StringType(), T.IntegerType()
BLOCKS = T.ArrayType(
    T.StructType().add("pos", _INT).add("fields", T.MapType(_TEXT, _TEXT)).add("href", _TEXT)
)


@F.pandas_udf(BLOCKS)
def extract_blocks(html: pd.Series, rules: pd.Series) -> pd.Series:
    """List blocks by tag and class with named fields and the first link.

    Rules: {"tag", "class", "items": [[name, tag, class or "None"], …]}.
    """
    def one(page, rule_text):
        rule, out = _rules(rule_text), []
        for pos, block in enumerate(_select(_tree(page), f"{rule['tag']}.{rule['class']}".rstrip("."))):
            fields = {}
            for name, tag, cls in rule["items"]:
                fields[name] = _text_of(_first(_select(block, tag if cls == "None" else f"{tag}.{cls}")))
            link = _first(n for n in block.walk() if n.tag == "a")
            out.append({"pos": pos, "fields": fields, "href": link.attrs.get("href") if link else None})
        return out

    return pd.Series([one(h, r) for h, r in zip(html, rules)])


BODY = (
    T.StructType()
    .add("date", _TEXT)
    .add("body", T.ArrayType(T.StructType().add("pos", _INT).add("kind", _TEXT).add("value", _TEXT)))
)


@F.pandas_udf(BODY)
def extract_body(html: pd.Series, rules: pd.Series) -> pd.DataFrame:
    """Time of the page and its paragraphs and figures in document order.

    Rules: {"time_attr", "paragraph": [tag, class pattern], "figure": [tag, class pattern, attr]}.
    An empty class pattern takes every element of the kind.
    """
    def one(page, rule_text):
        rule, root = _rules(rule_text), _tree(page)
        stamp = _first(n for n in root.walk() if n.tag == "time")
        p_tag, p_class = rule["paragraph"]
        f_tag, f_class, f_attr = rule["figure"]
        patterns = [re.compile(p_class), re.compile(f_class)]
        body = []
        for node in root.walk():
            if node.tag not in (p_tag, f_tag):
                continue
            names = node.classes() or [""]
            if not any(p.search(c) for p in patterns for c in names):
                continue
            kind = "paragraph" if node.tag == p_tag else "figure"
            value = node.text() if kind == "paragraph" else node.attrs.get(f_attr)
            body.append({"pos": len(body), "kind": kind, "value": value})
        return {"date": stamp.attrs.get(rule["time_attr"]) if stamp else None, "body": body}

    return pd.DataFrame([one(h, r) for h, r in zip(html, rules)], columns=["date", "body"])


TAGGED = T.ArrayType(
    T.StructType()
    .add("region", _TEXT)
    .add("pos", _INT)
    .add("writer", _TEXT)
    .add("date", _TEXT)
    .add("title", _TEXT)
    .add("url", _TEXT)
    .add("tags", T.ArrayType(_TEXT))
)


@F.pandas_udf(TAGGED)
def extract_tagged_cards(html: pd.Series, rules: pd.Series) -> pd.Series:
    """Article cards of each named region with writer, time, title, link and tags.

    Rules: {"regions": {name: selector}, "card", "writer", "title", "tags", "tag_mark"}.
    """
    def card_of(region, pos, card, rule):
        heading = _first(_select(card, rule["title"]))
        stamp = _first(_select(card, "time"))
        link = _first(n for n in heading.walk() if n.tag == "a") if heading else None
        return {
            "region": region,
            "pos": pos,
            "writer": _text_of(_first(_select(card, rule["writer"]))),
            "date": stamp.attrs.get("datetime") if stamp else None,
            "title": _text_of(heading),
            "url": link.attrs.get("href") if link else None,
            "tags": [n.text() for n in _select(card, rule["tags"])
                     if rule["tag_mark"] in (n.attrs.get("href") or "")],
        }

    def one(page, rule_text):
        rule, root, out = _rules(rule_text), _tree(page), []
        for region, selector in rule["regions"].items():
            top = _first(_select(root, selector))
            cards = _select(top, rule["card"]) if top else ()
            out.extend(card_of(region, pos, card, rule) for pos, card in enumerate(cards))
        return out

    return pd.Series([one(h, r) for h, r in zip(html, rules)])


REGION = T.StructType().add("block", _TEXT).add("links", T.ArrayType(_TEXT))


@F.pandas_udf(REGION)
def extract_region_text(html: pd.Series, rules: pd.Series) -> pd.DataFrame:
    """Text of one block of a region, one line per text piece, and the region's links.

    Rules: {"region", "links", "block", "block_no"} with selectors and a zero-based block number.
    """
    def one(page, rule_text):
        rule = _rules(rule_text)
        top = _first(_select(_tree(page), rule["region"]))
        if top is None:
            return {"block": None, "links": []}
        blocks = list(_select(top, rule["block"]))
        block = blocks[rule["block_no"]] if rule["block_no"] < len(blocks) else None
        pieces = [s.strip() for s in block.strings()] if block else []
        return {
            "block": "\n".join(s for s in pieces if s) if block else None,
            "links": [n.attrs.get("href") for n in _select(top, rule["links"])],
        }

    return pd.DataFrame([one(h, r) for h, r in zip(html, rules)], columns=["block", "links"])
