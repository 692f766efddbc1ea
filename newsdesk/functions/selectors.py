"""Records of a page by selectors, read in one pass over the parser's events.

A selector is a line of steps: `tag`, `.class`, `[attr]`, `[attr=value]`, `[attr^=start]`, `[attr*=part]` and
any of them together; steps are divided by a blank (somewhere below) or `>` (directly below). `:nth(n)`
after a step takes the n-th element, from 0, that fits it below the same match of the step before.

Selectors are compiled once into steps. While a page is read, every open element knows which steps its
ancestors and itself have matched; an element that starts is tested against the steps that come next.
No tree is built: what is kept is the path to the element being read and the texts being gathered, and
any number of rules share the pass.

Rules are JSON: {name: {"item": selector, "limit": n, "fields": {field: {"at": selector below the item or "",
"take": "text", "lines" or "@attribute"}}}}; of several matches of a field the first counts. `lines` is
the text with one line per piece.
"""

from __future__ import annotations

import json
import re
from html.parser import HTMLParser

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from newsdesk.functions.pages import OPAQUE, VOID

STEP = re.compile(r"(?P<tag>[a-zA-Z][\w-]*|\*)?(?P<rest>(?:\.[\w-]+|\[[^\]]*\])*)(?::nth\((?P<nth>\d+)\))?")
TEST = re.compile(r"\.([\w-]+)|\[\s*([\w:-]+)\s*(?:([\^*]?=)\s*[\"']?([^\"'\]]*)[\"']?\s*)?\]")


class Step:
    __slots__ = ("direct", "tag", "classes", "tests", "nth")

    def __init__(self, text: str, direct: bool):
        found = STEP.fullmatch(text)
        if not found or not text:
            raise ValueError(f"no step of a selector: {text!r}")
        tests = [m.groups() for m in TEST.finditer(found["rest"] or "")]
        self.direct = direct
        self.tag = None if found["tag"] in (None, "*") else found["tag"].lower()
        self.classes = frozenset(c for c, _, _, _ in tests if c)
        self.tests = tuple((a.lower(), how, value) for _, a, how, value in tests if a)
        self.nth = None if found["nth"] is None else int(found["nth"])

    def fits(self, tag: str, attrs: dict, classes: frozenset) -> bool:
        if self.tag is not None and self.tag != tag or not self.classes <= classes:
            return False
        for name, how, value in self.tests:
            given = attrs.get(name)
            if name not in attrs or how is not None and given is None:
                return False
            if how == "=" and given != value or how == "^=" and not given.startswith(value) or how == "*=" and value not in given:
                return False
        return True


def compiled(selector: str) -> tuple[Step, ...]:
    steps, direct = [], False
    for part in re.findall(r">|(?:\[[^\]]*\]|[^\s>\[])+", selector):
        if part == ">":
            direct = True
        else:
            steps.append(Step(part, direct))
            direct = False
    return tuple(steps)


class Rules:
    """Compiled rules: per rule its item's steps, its limit, and the steps and kind of every field."""

    def __init__(self, text: str):
        self.rules = []
        for name, rule in json.loads(text).items():
            fields = [(f, compiled(r.get("at", "")), r.get("take", "text")) for f, r in rule.get("fields", {}).items()]
            steps = compiled(rule["item"])
            if not steps:
                raise ValueError(f"rule {name} has no item")
            self.rules.append((name, steps, rule.get("limit"), fields))


class _Match:
    """Elements of one selector matched up to a step; `counts` numbers the fitting elements below."""

    __slots__ = ("steps", "done", "then", "fitting")

    def __init__(self, steps, done, then):
        self.steps, self.done, self.then, self.fitting = steps, done, then, 0


class _Item:
    __slots__ = ("rule", "pos", "values")

    def __init__(self, rule, pos):
        self.rule, self.pos, self.values = rule, pos, {}


class _Gather:
    __slots__ = ("item", "field", "lines", "pieces")

    def __init__(self, item, field, lines):
        self.item, self.field, self.lines, self.pieces = item, field, lines, []


class _Frame:
    __slots__ = ("tag", "below", "direct", "gathers")

    def __init__(self, tag, below, direct, gathers):
        self.tag, self.below, self.direct, self.gathers = tag, below, direct, gathers


class _Machine(HTMLParser):
    """`below` of a frame: matches whose next step may be anywhere below it; `direct`: directly below."""

    def __init__(self, rules: Rules):
        super().__init__(convert_charrefs=True)
        self.items: list[_Item] = []
        self.open: list[_Gather] = []
        self.opaque = 0
        self.counts: dict[str, int] = {}
        starts = [_Match(rule[1], 0, ("item", rule)) for rule in rules.rules]
        self.stack = [_Frame("", [m for m in starts if not m.steps[0].direct], [m for m in starts if m.steps[0].direct], [])]

    def handle_starttag(self, tag, attrs):
        if tag == "p":
            self._close("p")
        self._enter(tag, attrs, tag in VOID)

    def handle_startendtag(self, tag, attrs):
        self._enter(tag, attrs, True)

    def _enter(self, tag, attrs, ends):
        attrs = dict(attrs)
        classes = frozenset((attrs.get("class") or "").split())
        up = self.stack[-1]
        frame = _Frame(tag, list(up.below), [], [])
        reached = set()
        for match in [*up.below, *up.direct]:
            step = match.steps[match.done]
            if not step.fits(tag, attrs, classes):
                continue
            place, match.fitting = match.fitting, match.fitting + 1
            if step.nth is not None and step.nth != place:
                continue
            key = (id(match.steps), match.done, id(match.then))
            if key in reached:  # by another ancestor too
                continue
            reached.add(key)
            self._advance(match.steps, match.done + 1, match.then, frame, attrs)
        if tag in OPAQUE and not ends:
            self.opaque += 1
        if ends:
            self._finish(frame)
        else:
            self.stack.append(frame)

    def _advance(self, steps, done, then, frame, attrs):
        if done < len(steps):
            (frame.direct if steps[done].direct else frame.below).append(_Match(steps, done, then))
        elif then[0] == "item":
            name, _, limit, fields = then[1]
            pos = self.counts.get(name, 0)
            if limit is not None and pos >= limit:
                return
            self.counts[name] = pos + 1
            item = _Item(name, pos)
            self.items.append(item)
            for field, below, take in fields:
                self._advance(below, 0, ("field", item, field, take), frame, attrs)
        else:
            _, item, field, take = then
            if field in item.values:
                return
            if take.startswith("@"):
                item.values[field] = attrs.get(take[1:].lower())
            else:
                item.values[field] = None  # the first element counts, also while its text is gathered
                gather = _Gather(item, field, take == "lines")
                self.open.append(gather)
                frame.gathers.append(gather)

    def handle_data(self, data):
        if not self.opaque:
            for gather in self.open:
                gather.pieces.append(data)

    def handle_endtag(self, tag):
        self._close(tag)

    def _close(self, tag):
        if any(frame.tag == tag for frame in self.stack[1:]):
            while True:
                frame = self.stack.pop()
                self._leave(frame)
                if frame.tag == tag:
                    return

    def _leave(self, frame):
        if frame.tag in OPAQUE:
            self.opaque -= 1
        self._finish(frame)

    def _finish(self, frame):
        for gather in frame.gathers:
            stripped = [p.strip() for p in gather.pieces]
            gather.item.values[gather.field] = "\n".join(p for p in stripped if p) if gather.lines else "".join(gather.pieces)
            self.open.remove(gather)

    def finish(self):
        self.close()
        while len(self.stack) > 1:
            self._leave(self.stack.pop())


_compiled: dict[str, Rules] = {}


def records_of(html: str | None, rules: str) -> list[dict]:
    """The records of one page in the order in which they start."""
    if rules not in _compiled:
        _compiled[rules] = Rules(rules)
    machine = _Machine(_compiled[rules])
    machine.feed(html or "")
    machine.finish()
    return [{"rule": i.rule, "pos": i.pos, "fields": i.values} for i in machine.items]


RECORDS = T.ArrayType(T.StructType().add("rule", T.StringType()).add("pos", T.IntegerType()).add("fields", T.MapType(T.StringType(), T.StringType())))


@F.pandas_udf(RECORDS)
def select_records(html: pd.Series, rules: pd.Series) -> pd.Series:
    """Records of all rules of a page, in the order in which they start; a NULL page has none."""
    return pd.Series([records_of(h, r) for h, r in zip(html, rules)])


def article_links(html: Column, item: str | dict, limit: int) -> Column:
    """Title and link of the first `limit` list items of a page, as array<struct<title, url>>.

    `item` is a rule with the fields title and url; items that lack either have no entry.
    """
    rule = dict(item, limit=None)
    found = F.filter(select_records(html, F.lit(json.dumps({"article": rule}))), lambda r: r["fields"]["title"].isNotNull() & r["fields"]["url"].isNotNull())
    return F.slice(F.transform(found, lambda r: F.struct(r["fields"]["title"].alias("title"), r["fields"]["url"].alias("url"))), 1, limit)
