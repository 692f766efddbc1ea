"""Benchmark decontamination by canonical templates.

Numbers (with a unit glued to them or not), names and units become typed placeholders, so that a
question with other parameters keeps its template. Windows of template tokens are joined by hash; a
match counts where each placeholder value of the benchmark stands for one value of the document along
the aligned passage. A document is contaminated by an item whose template it covers to COVERAGE or more.

A capitalised word that begins a sentence may be a name or not: windows with such words are hashed both
ways. Windows with too few plain words to be told by their template are compared literally, without case.
Items that no document can tell apart (one template with the same sentence openings, the same slots equal)
are one class; documents are joined with classes, and `item_classes` names the members.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from newsdesk.llm import textbatch as tb
from newsdesk.llm.common import map_batches, record_batch, row_key, shelter, text_of
from newsdesk.session import store

WINDOW = 8
COVERAGE = 0.5
#: A window with so many tokens that are no placeholder is told by its template, another literally.
#: Also the tokens of the shortest item that can be recognised.
PLAIN = 4
#: Up to so many distinct window hashes (8 bytes each) the benchmark is sent to the scan of the documents.
SENT_HASHES = 1_000_000
#: Unit words that become a placeholder after a number.
UNITS = ("mm cm m km in ft yd mi miles inches feet meters metres mg g kg lb lbs oz ton tons ml l litres liters gal "
         "ms s sec seconds min minutes h hr hours days weeks months years percent % $ € £ usd eur dollars euros cents "
         "kb mb gb tb hz khz mhz ghz w kw v a mph kph kmh °c °f k degrees").split()
#: Words that begin sentences and are no names.
OPENERS = ("a all an and are as at but by calculate can compute could did do does each every find for from given he how i if "
           "in is it its let no not of on one or she should so some suppose that the their then there these they this those "
           "to was we were what when where which while who whose why will with would you").split()

CORE = np.zeros(256, bool)
CORE[48:58] = CORE[65:91] = CORE[97:123] = CORE[128:] = True
for _b in b"$%":
    CORE[_b] = True
DIGIT = np.zeros(256, bool)
DIGIT[48:58] = True
ALPHA = np.zeros(256, bool)
ALPHA[65:91] = ALPHA[97:123] = ALPHA[128:] = True
STOP = np.zeros(256, bool)
for _b in b".!?:":
    STOP[_b] = True
PLAIN_WORD, NUMBER, NAME, UNIT = 0, 1, 2, 3
MARK = tb.mix(np.array([0, 101, 102, 103], np.uint64))


#: Tell the windows of the two other kinds from those of templates.
LITERAL, NAMED = np.uint64(1 << 32), np.uint64(1 << 33)


def _sorted_hashes(listed: list[str]) -> np.ndarray:
    data = np.frombuffer(" ".join(listed).encode(), np.uint8)
    return np.sort(tb.words_of(data, np.array([0, len(data)])).hashes)


UNIT_HASHES, OPENER_HASHES = _sorted_hashes(UNITS), _sorted_hashes(OPENERS)


def _among(table: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    return table[np.minimum(np.searchsorted(table, hashes), len(table) - 1)] == hashes


def canonical(words: tb.Words) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(document, template hash, kind, value hash, opening) of the tokens of a batch of words in raw case.

    A token is a word without outer punctuation. A word with one capital, its first letter, that does
    not begin a sentence or line is a name; consecutive names are one token. One that begins a sentence
    and is no usual opener is plain, but `opening`: it may be a name.
    """
    data, n = words.data, len(words.starts)
    if not n:
        empty = np.zeros(0, np.uint64)
        return np.zeros(0, np.int64), empty, np.zeros(0, np.int64), empty, np.zeros(0, bool)
    places = np.flatnonzero(CORE[data])
    left = np.searchsorted(places, words.starts)
    right = np.searchsorted(places, words.ends)
    some = right > left
    starts, ends = places[left[some]], places[right[some] - 1] + 1
    doc = words.doc[some]
    digits = np.concatenate([[0], np.cumsum(DIGIT[data])])
    alphas = np.concatenate([[0], np.cumsum(ALPHA[data])])
    breaks = np.concatenate([[0], np.cumsum(data == 10)])
    # Latin-1 capitals take two bytes: C3 80 … C3 9E without the multiplication sign C3 97.
    latin = np.zeros(len(data), bool)
    latin[1:] = (data[:-1] == 0xC3) & (data[1:] >= 0x80) & (data[1:] <= 0x9E) & (data[1:] != 0x97)
    capitals = np.concatenate([[0], np.cumsum(latin | ((data >= 65) & (data <= 90)))])
    value = tb.span_hashes(tb.prefix_sums(np.where(latin, data + 32, tb.LOWER[data]).astype(np.uint8)), starts, ends)
    has_digit = digits[ends] > digits[starts]
    has_alpha = alphas[ends] > alphas[starts]
    kind = np.zeros(len(starts), np.int64)
    number = has_digit & (~has_alpha | DIGIT[data[starts]])
    width = 1 + (data[starts] == 0xC3)  # of the first letter
    upper = (capitals[np.minimum(starts + width, ends)] > capitals[starts]) & (capitals[ends] - capitals[starts] == 1) & (ends - starts > width)
    sentence = np.ones(len(starts), bool)
    raw_end = words.ends[some]
    sentence[1:] = (doc[1:] != doc[:-1]) | STOP[data[raw_end[:-1] - 1]] | (breaks[starts[1:]] > breaks[ends[:-1]])
    kind[upper & ~sentence & ~has_digit] = NAME
    kind[number] = NUMBER
    unit = np.zeros(len(starts), bool)
    unit[1:] = _among(UNIT_HASHES, value)[1:] & number[:-1] & (doc[1:] == doc[:-1])
    kind[unit] = UNIT
    opening = upper & sentence & (kind == PLAIN_WORD) & ~_among(OPENER_HASHES, value)
    # A run of names becomes its first token; its value is the hash of the whole run.
    follows = np.zeros(len(starts), bool)
    follows[1:] = (kind[1:] == NAME) & (kind[:-1] == NAME) & (doc[1:] == doc[:-1])
    head = np.flatnonzero(~follows)
    width = np.diff(np.concatenate([head, [len(starts)]]))
    joined = np.add.reduceat(tb.mix(value + (np.arange(len(starts)) - np.repeat(head, width)).astype(np.uint64)), head)
    kind, doc = kind[head], doc[head]
    value = np.where((kind == NAME) & (width > 1), joined, value[head])
    return doc, np.where(kind == PLAIN_WORD, value, MARK[kind]), kind, value, opening[head]


def _chain(hashes: np.ndarray, at: np.ndarray, n: int) -> np.ndarray:
    """Hash of the n tokens from each place of `at` on."""
    out = np.full(len(at), n, np.uint64)
    for i in range(n):
        out = tb.mix(out + hashes[at + i])
    return out


class Tokens:
    """Canonical tokens of a slice of texts, their slot values (0: none) and their windows."""

    def __init__(self, words: tb.Words):
        self.doc, self.template, self.kind, self.value, self.opening = canonical(words)
        self.first = np.searchsorted(self.doc, np.arange(len(words.counts) + 1))
        self.sizes = np.diff(self.first)
        self.named = np.where(self.opening, MARK[NAME], self.template)
        plain = self.kind == PLAIN_WORD
        self.slots = np.where(plain, np.uint64(0), self.value)
        self.named_slots = np.where(plain & ~self.opening, np.uint64(0), self.value)

    def windows(self, lengths):
        """(length, named, literal, first tokens, hashes, slot values of the tokens) by length and kind."""
        plain = np.concatenate([[0], np.cumsum(self.kind == PLAIN_WORD)])
        opening = np.concatenate([[0], np.cumsum(self.opening)])
        for n in lengths:
            if len(self.doc) < n:
                continue
            inside = self.doc[: len(self.doc) - n + 1] == self.doc[n - 1 :]
            words, open_words = plain[n:] - plain[:-n], opening[n:] - opening[:-n]
            told = np.flatnonzero(inside & (words >= PLAIN))
            yield n, False, False, told, tb.mix(_chain(self.template, told, n)), self.slots
            few = np.flatnonzero(inside & (words < PLAIN))
            yield n, False, True, few, tb.mix(_chain(self.value, few, n) + LITERAL), self.slots
            both = np.flatnonzero(inside & (open_words > 0) & (words - open_words >= PLAIN))
            yield n, True, False, both, tb.mix(_chain(self.named, both, n) + NAMED), self.named_slots

    def classes(self, lengths) -> list[str]:
        """Per text what all its windows say but for the values of slots: only which slots are equal counts."""
        digests = [hashlib.blake2b(digest_size=16) for _ in self.sizes]
        for d, digest in enumerate(digests):
            part = slice(self.first[d], self.first[d + 1])
            for hashes, slots in ((self.template, self.slots), (self.named, self.named_slots)):
                _, first, number = np.unique(slots[part], return_index=True, return_inverse=True)
                digest.update(hashes[part].tobytes() + np.where(slots[part] == 0, -1, first[number]).astype(np.int64).tobytes() if len(number) else b"")
        for n, _, literal, at, hashes, _ in self.windows(lengths):
            if literal and len(at):
                owner = self.doc[at]
                for d in np.unique(owner):
                    if n == min(WINDOW, self.sizes[d]):
                        digests[d].update((at[owner == d] - self.first[d]).astype(np.int64).tobytes() + hashes[owner == d].tobytes())
        return [d.hexdigest() for d in digests]


COLUMNS = "n_tokens bigint, position bigint, length bigint, named boolean, hash bigint, slots array<bigint>"


def _rows(owner: pa.Array, row: int, tokens: Tokens, lengths, keep, **more):
    """Record batches of the windows that `keep(length, first tokens, hashes)` accepts."""
    for n, named, _, at, hashes, slots in tokens.windows(lengths):
        good = keep(n, at, hashes)
        at, hashes = at[good], hashes[good]
        if len(at):
            doc = tokens.doc[at]
            values = slots.view(np.int64)[at[:, None] + np.arange(n)]
            offsets = np.arange(0, values.size + 1, n, dtype=np.int32)
            yield record_batch(owner=owner.take(pa.array(row + doc)), **{c: pa.array(v).take(pa.array(doc)) for c, v in more.items()},
                               n_tokens=tokens.sizes[doc].astype(np.int64), position=(at - tokens.first[doc]).astype(np.int64), length=np.full(len(at), n, np.int64),
                               named=np.full(len(at), named), hash=hashes.view(np.int64), slots=pa.ListArray.from_arrays(offsets, values.reshape(-1)))


def _item_windows(benchmark: DataFrame) -> DataFrame:
    """Windows of the items with `class`: those of WINDOW tokens, or a shorter item as a whole."""
    items = benchmark.select(F.struct(benchmark["item_id"].alias("id"), F.xxhash64(text_of(benchmark)).alias("text_key")).alias("owner"), text_of(benchmark).alias("text")).filter("owner.id IS NOT NULL")
    lengths = range(PLAIN, WINDOW + 1)

    def step(batch: pa.RecordBatch):
        for row, words in tb.pieces(batch.column("text")):
            tokens = Tokens(words)
            own = np.minimum(tokens.sizes, WINDOW)
            yield from _rows(batch.column("owner"), row, tokens, lengths, lambda n, at, _, t=tokens, own=own: own[t.doc[at]] == n, **{"class": tokens.classes(lengths)})

    return map_batches(items, step, f"owner {items.schema['owner'].dataType.simpleString()}, class string, {COLUMNS}")


def _document_windows(docs: DataFrame, lengths: tuple[int, ...], wanted: np.ndarray | None) -> DataFrame:
    """Windows of the given lengths of (owner, text) rows; with `wanted` (sorted hashes) only those."""
    sent = docs.sparkSession.sparkContext.broadcast(wanted) if wanted is not None else None

    def step(batch: pa.RecordBatch):
        for row, words in tb.pieces(batch.column("text")):
            yield from _rows(batch.column("owner"), row, Tokens(words), lengths, lambda n, at, h: np.ones(len(h), bool) if sent is None else _among(sent.value, h))

    return map_batches(docs, step, f"owner bigint, {COLUMNS}")


def _classes(windows: DataFrame) -> DataFrame:
    """(class, first: its smallest member, n_items) of the items' windows."""
    return windows.select("owner", "class").distinct().groupBy("class").agg(F.min("owner").alias("first"), F.count_distinct("owner.id").alias("n_items"))


def item_classes(benchmark: DataFrame) -> DataFrame:
    """(item_id, class_item_id, n_items): the class of every item, named by its smallest id.

    Items that cannot be recognised (NULL ids or texts, under PLAIN tokens) have no row. An id that
    comes with several texts has a row for each of their classes.
    """
    windows = store(_item_windows(benchmark).select("owner", "class").distinct())
    return windows.join(_classes(windows), "class").select(F.col("owner.id").alias("item_id"), F.col("first.id").alias("class_item_id"), "n_items").distinct()


def matches(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """(key, item_id, n_items, n_item_tokens, n_covered, n_slots, coverage) of every document and class of items with a consistent match.

    `docs` has key and text. Items under PLAIN tokens cannot be recognised; items shorter than WINDOW
    tokens are one window of their own length. Ids of items may have any type; `item_id` is the
    smallest of the class.
    """
    windows = store(_item_windows(benchmark))
    # An id with several texts stands for each of their classes: the class is the key of an item.
    asked = store(windows.join(_classes(windows), "class").filter("owner = first").withColumn("item_id", F.col("first.id")).drop("owner", "first").distinct())
    lengths = tuple(sorted(r[0] for r in asked.select("length").distinct().collect()))  # WINDOW - PLAIN + 1 at most
    hashes = asked.select("hash").distinct()
    wanted = None
    if hashes.count() <= SENT_HASHES:
        wanted = np.sort(np.array([r[0] for r in hashes.collect()] or [0], np.int64).view(np.uint64))
    found = _document_windows(docs.select(F.col("key").alias("owner"), text_of(docs).alias("text")), lengths or (WINDOW,), wanted)
    item = ["class", "item_id", "n_items", "n_item_tokens"]
    asked = asked.select(*item[:3], F.col("n_tokens").alias("n_item_tokens"), F.col("position").alias("at"), "length", "hash", F.col("slots").alias("asked"))
    both = found.select(F.col("owner").alias("key"), "position", "length", "named", "hash", "slots").join(asked, ["hash", "length"])
    # Along one alignment a window occurs once per item position: the groups are bounded by the item.
    # Windows that take openings as names are judged with all others; those without also by themselves.
    ways = F.when(F.col("named"), F.array(F.lit(True))).otherwise(F.array(F.lit(False), F.lit(True)))
    line = both.withColumn("shift", F.col("position") - F.col("at")).withColumn("way", F.explode(ways))
    pairs = F.filter(F.arrays_zip("asked", "slots"), lambda p: p["asked"] != 0)
    passages = line.groupBy("key", *item, "shift", "way").agg(
        F.collect_set(F.struct("at", "length")).alias("spots"), F.array_distinct(F.flatten(F.collect_list(pairs))).alias("slots"))
    consistent = F.size("slots") == F.size(F.array_distinct(F.col("slots.asked")))
    good = passages.filter(consistent)
    tokens = F.array_distinct(F.flatten(F.transform(F.flatten(F.collect_set("spots")), lambda s: F.sequence(s["at"], s["at"] + s["length"] - 1))))
    total = good.groupBy("key", *item).agg(tokens.alias("covered"), F.max(F.size("slots")).cast("bigint").alias("n_slots"))
    return total.select("key", *item[1:], F.size("covered").cast("bigint").alias("n_covered"), "n_slots").withColumn("coverage", F.col("n_covered") / F.col("n_item_tokens"))


def leaks(docs: DataFrame, benchmark: DataFrame, coverage: float = COVERAGE) -> DataFrame:
    """(doc_id, item_id, n_items, n_item_tokens, n_covered, n_slots, coverage): contaminated documents, a row
    per class of items (`item_classes`).

    Texts without tokens (NULL, empty) match nothing; an empty benchmark leaks nowhere. Rows that
    repeat an id and text give one row, repeated items count once; a NULL doc_id is kept as such. Long
    texts are one slice of a batch. Other columns of either table are not read. There are no ties: each
    class that reaches `coverage` has its row.
    """
    keyed = docs.select("doc_id", row_key(docs).alias("key"), "text")
    found = store(matches(keyed, benchmark).filter(F.col("coverage") >= coverage))
    return keyed.select("doc_id", "key").distinct().join(found, "key").drop("key")


def clean(docs: DataFrame, benchmark: DataFrame, coverage: float = COVERAGE) -> DataFrame:
    """The rows of `docs` that no item contaminates, with all their columns, whatever their names.

    Rows with NULL or empty texts stay; repeated rows stay or go together.
    """
    inner, restore = shelter(docs, "doc_id", "text")
    inner = inner.withColumn("key", row_key(inner))
    found = store(matches(inner, benchmark).filter(F.col("coverage") >= coverage).select("key").distinct())
    rows = inner.join(found, "key", "left_anti")
    return rows.select(*restore(rows))
