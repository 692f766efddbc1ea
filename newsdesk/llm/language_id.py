"""Language identification by hyperdimensional profiles.

Every letter has a random vector of DIMENSIONS signs, drawn from its code point; a word boundary has one
too. A trigram binds the vectors of its letters, the first moved on by two places and the second by one,
by multiplication. A text is the bundle (sum) of its trigrams, a language the bundle of its texts; a
text is given the language whose prototype has the largest cosine with it. All bundles are sums of
integers, so they do not depend on the order of rows or tasks.

Defined results: a text that is NULL or has no letter is `und` with score 0, and so is every text where
nothing was learned. Rows with a NULL language or without a letter teach nothing. Of equal cosines the
smallest language name wins. Cosines below 0 count as 0. Texts of any length are read whole, in pieces of
PIECE letters that lose no trigram. Rows that repeat an id are rows each. More than MAX_LANGUAGES
language names are an error: there are about 8,000 languages, so the column holds something else.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from newsdesk.llm import textbatch as tb
from newsdesk.llm.common import map_batches, record_batch, remainder

FOLDS, TEST_FOLD = 4, 2
DIMENSIONS = 1024
MAX_LANGUAGES = 16_384
#: Characters of all texts of a slice, and of one piece of a long text.
PIECE = 1 << 18
#: Texts of a slice, and trigrams that are unfolded at once.
SLICE_TEXTS, SLICE_TRIGRAMS = 256, 4096
UNKNOWN = "und"
_CACHE: dict[str, np.ndarray] = {}


def is_letter() -> np.ndarray:
    """Per code point whether it is a letter."""
    if "letter" not in _CACHE:
        _CACHE["letter"] = np.fromiter((chr(c).isalpha() for c in range(sys.maxunicode + 1)), bool, sys.maxunicode + 1)
    return _CACHE["letter"]


def letter_vectors(codes: np.ndarray) -> np.ndarray:
    """One row of DIMENSIONS bits (1: minus) per code point; 0 stands for a word boundary."""
    words = np.arange(DIMENSIONS // 64, dtype=np.uint64)
    drawn = tb.mix(tb.mix(codes.astype(np.uint64)[:, None] + np.uint64(1)) + words * tb.BASE)
    return np.unpackbits(np.ascontiguousarray(drawn).view(np.uint8), axis=1)


def bound(first: np.ndarray, second: np.ndarray, third: np.ndarray, vectors: np.ndarray) -> np.ndarray:
    """Signs of trigrams of rows of `vectors`."""
    bits = np.roll(vectors, 2, 1)[first] ^ np.roll(vectors, 1, 1)[second] ^ vectors[third]
    return 1.0 - 2.0 * bits.astype(np.float32)


def cuts(text: str) -> Iterator[tuple[str, bool, bool]]:
    """Pieces of a text, and whether each begins and ends at a word boundary.

    A cut is made at the last character that is not a letter; in a piece without one it is made anywhere,
    and the next piece begins two letters earlier, so that every trigram is in exactly one piece.
    """
    start, begins = 0, True
    while len(text) - start > PIECE:
        end = start + PIECE
        at = end - 1
        while at > start + 2 and text[at].isalpha():
            at -= 1
        if at > start + 2:
            yield text[start:at], begins, True
            start, begins = at, True
        else:
            yield text[start:end], begins, False
            start, begins = end - 2, False
    yield text[start:], begins, True


def slices(texts: list[str | None]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(letters, row of each) over the texts; 0 is a boundary, and every word is framed by one."""
    chunks, rows, size = [], [], 0

    def drawn():
        codes = np.frombuffer("".join(chunks).encode("utf-32-le", "replace"), np.uint32)
        owner = np.repeat(rows, [len(c) for c in chunks])
        codes = np.where(is_letter()[codes], codes, np.where(codes == 1, 1, 0))
        keep = codes != 0
        keep[1:] |= (codes[:-1] != 0) | (owner[1:] != owner[:-1])
        keep[:1] = True
        return codes[keep], owner[keep]

    for row, text in enumerate(texts):
        for piece, begins, ends in cuts((text or "").lower()):
            # Letter 1 stands for a cut inside a word: no trigram reaches over it.
            chunks.append(("\0" if begins else "\1") + piece.replace("\1", "\0") + ("\0" if ends else "\1"))
            rows.append(row)
            size += len(chunks[-1])
            if size >= PIECE or len(chunks) >= SLICE_TEXTS:
                yield drawn()
                chunks, rows, size = [], [], 0
    if chunks:
        yield drawn()


def bundles(texts: list[str | None], group: np.ndarray | None = None) -> np.ndarray:
    """The bundle of every text, texts x DIMENSIONS; or of all texts of a group, groups x DIMENSIONS,
    where `group` names the row each text is added to."""
    group = np.arange(len(texts)) if group is None else group
    out = np.zeros((int(group.max(initial=-1)) + 1, DIMENSIONS))
    for codes, owner in slices(texts):
        middle = np.flatnonzero((codes[1:-1] > 1) & (codes[:-2] != 1) & (codes[2:] != 1)) + 1
        if not len(middle):
            continue
        alphabet, place = np.unique(codes, return_inverse=True)
        size = len(alphabet)
        keys, trigram = np.unique((place[middle - 1] * size + place[middle]) * size + place[middle + 1], return_inverse=True)
        rows, row = np.unique(group[owner[middle]], return_inverse=True)
        order = np.argsort(trigram, kind="stable")
        trigram, row = trigram[order], row[order]
        edges = np.searchsorted(trigram, np.arange(0, len(keys) + SLICE_TRIGRAMS, SLICE_TRIGRAMS))
        vectors = letter_vectors(alphabet)
        for k, (a, b) in enumerate(zip(edges, edges[1:])):
            some = keys[k * SLICE_TRIGRAMS : (k + 1) * SLICE_TRIGRAMS]
            counts = np.bincount(row[a:b] * len(some) + trigram[a:b] - k * SLICE_TRIGRAMS, minlength=len(rows) * len(some))
            out[rows] += counts.reshape(len(rows), -1).astype(np.float32) @ bound(some // size // size, some // size % size, some % size, vectors)
    return out


def learn(docs: DataFrame, folds: int = FOLDS, test_fold: int = TEST_FOLD) -> tuple[list[str], np.ndarray]:
    """Languages and their prototypes, from the texts whose id is not in the test fold.

    A task adds its texts to one bundle per language and sends these; Spark adds them up.
    """
    known = docs.filter((remainder(F.col("doc_id"), folds) != test_fold) & F.col("lang").isNotNull() & F.col("text").isNotNull())
    source = known.select(F.col("lang").cast("string").alias("lang"), F.col("text").cast("string").alias("text"))
    source.sparkSession.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "1000")

    def run(batches):
        held: dict[str, np.ndarray] = {}

        def sent():
            yield record_batch(lang=pa.array(list(held), pa.string()), bundle=pa.array([v.astype(np.int64).tolist() for v in held.values()], pa.list_(pa.int64())))

        for batch in batches:
            if not batch.num_rows:
                continue
            names, which = np.unique(np.array(batch.column("lang").to_pylist(), object), return_inverse=True)
            for name, bundle in zip(names, bundles(batch.column("text").to_pylist(), which)):
                held[name] = held.get(name, 0) + bundle
            if len(held) > 1000:  # sent early, added up by Spark all the same
                yield from sent()
                held = {}
        if held:
            yield from sent()

    parts = source.mapInArrow(run, "lang string, bundle array<bigint>").select("lang", F.posexplode("bundle").alias("at", "value"))
    summed = parts.groupBy("lang", "at").agg(F.sum("value").alias("value"))
    table = summed.groupBy("lang").agg(F.sort_array(F.collect_list(F.struct("at", "value")))["value"].alias("bundle"))
    rows = table.filter(F.exists("bundle", lambda v: v != 0)).limit(MAX_LANGUAGES + 1).collect()
    if len(rows) > MAX_LANGUAGES:
        raise ValueError(f"more than {MAX_LANGUAGES} language names")
    rows = sorted((r["lang"], r["bundle"]) for r in rows)
    return [lang for lang, _ in rows], np.array([b for _, b in rows], float).reshape(-1, DIMENSIONS)


def identify(docs: DataFrame, languages: list[str], prototypes: np.ndarray, keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """The columns `keep` of `docs`, then lang_pred and score, the cosine with that language."""
    lengths = np.linalg.norm(prototypes, axis=1, keepdims=True)
    sent = docs.sparkSession.sparkContext.broadcast((languages, prototypes / np.maximum(lengths, 1e-300)))
    kinds = {c: docs.schema[c].dataType.simpleString() for c in keep}
    names = {c: f"k__{i}" for i, c in enumerate(keep)}

    def step(batch: pa.RecordBatch):
        found, units = sent.value
        pred, score = [UNKNOWN] * batch.num_rows, np.zeros(batch.num_rows)
        if found:
            rows = bundles(batch.column("text__").to_pylist())
            size = np.linalg.norm(rows, axis=1)
            cosines = rows @ units.T / np.maximum(size, 1e-300)[:, None]
            best = cosines.argmax(axis=1)
            for i in np.flatnonzero(size > 0):
                pred[i], score[i] = found[best[i]], min(max(cosines[i, best[i]], 0.0), 1.0)
        yield record_batch(**{k: batch.column(k) for k in names.values()}, lang_pred=pa.array(pred, pa.string()), score=score)

    source = docs.select(*[F.col(c).alias(k) for c, k in names.items()], F.col("text").cast("string").alias("text__"))
    out = map_batches(source, step, ", ".join([*[f"{k} {kinds[c]}" for c, k in names.items()], "lang_pred string, score double"]))
    return out.select(*[F.col(k).alias(c) for c, k in names.items()], "lang_pred", "score")
