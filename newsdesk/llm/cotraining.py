"""Quality classifier by co-training two views of a document.

The content view sees the shapes and repetition of words; the metadata view sees source, language,
declared length and layout. Each view is a ridge logistic regression. In every round each view labels
the pool documents it is most sure of and hands them to the other. Both are then calibrated on
documents neither learned from, combined, and applied to every document.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from newsdesk.llm import quality_rules
from newsdesk.llm import textbatch as tb
from newsdesk.llm.common import map_batches, record_batch, remainder, text_of
from newsdesk.operators.joins import join_unique
from newsdesk.session import cut_lineage

FOLDS, TEST_FOLD = 3, 1
#: About so many labelled documents are learned from and calibrated on, and so many unlabelled ones
#: form the pool; every document is scored.
LEARN_ROWS, CALIBRATE_ROWS, POOL_ROWS = 6000, 2000, 6000
ROUNDS, HANDED = 5, 300
RIDGE = 1.0
SHAPES, SOURCES = 192, 128
THRESHOLD = 0.5
CONTENT = SHAPES + 8
LAYOUT = 24 + 16 + 24
METADATA = SOURCES + LAYOUT + 32

#: Classes of bytes in a word's shape: letters by case, digits, bytes beyond ASCII, and each ASCII sign.
SHAPE_OF = np.arange(256, dtype=np.uint8)
SHAPE_OF[65:91], SHAPE_OF[97:123], SHAPE_OF[48:58], SHAPE_OF[128:] = 65, 97, 48, 97
UPPER = np.zeros(256, bool)
UPPER[65:91] = True


def content_view(words: tb.Words) -> np.ndarray:
    """Rows of CONTENT numbers: square roots of the shares of word shapes, then ratios."""
    n = len(words.counts)
    shape = SHAPE_OF[words.data]
    run = np.ones(len(shape), bool)
    run[1:] = shape[1:] != shape[:-1]
    run[words.starts] = True
    kept = np.flatnonzero(run)
    hashes = tb.span_hashes(tb.prefix_sums(shape[kept]), np.searchsorted(kept, words.starts), np.searchsorted(kept, words.ends))
    bucket = (hashes % np.uint64(SHAPES)).astype(np.int64)
    doc = words.doc
    share = np.bincount(doc * SHAPES + bucket, minlength=n * SHAPES).reshape(n, SHAPES) / np.maximum(words.counts, 1)[:, None]
    m = quality_rules._measure(words)
    many = np.maximum(m["n_words"], 1)
    first = np.unique(tb.mix(words.hashes ^ tb.mix(doc.astype(np.uint64) + np.uint64(1))), return_index=True)[1]
    distinct = np.bincount(doc[first], minlength=n)
    upper = np.concatenate([[0], np.cumsum(UPPER[words.data], dtype=np.int64)])
    letters = np.diff(upper[words.offsets])
    ratios = np.stack([
        np.minimum(m["n_symbols"] / many, 3), m["n_repeat_words"] / many, m["n_dup_lines"] / np.maximum(m["n_lines"], 1), distinct / many,
        np.minimum(m["word_chars"] / many, 30) / 10, np.minimum(letters / np.maximum(m["word_chars"], 1), 1), m["n_letter_words"] / many, np.log1p(m["n_words"]) / 5], 1)
    return np.concatenate([np.sqrt(share), ratios], 1)


def metadata_view(source: list, lang: list, n_chars: np.ndarray, lines: np.ndarray) -> np.ndarray:
    """Rows of METADATA indicators of source, language, declared length, lines and length of a line; NULLs are values."""
    n = len(source)
    out = np.zeros((n, METADATA))

    def number(value) -> int:
        data = np.frombuffer(repr(value).encode(), np.uint8)
        return int(tb.span_hashes(tb.prefix_sums(data), np.array([0]), np.array([len(data)]))[0])

    known: dict = {}
    for names, base, width in ((source, 0, SOURCES), (lang, SOURCES, 32)):
        for i, value in enumerate(names):
            if (value, base) not in known:
                known[value, base] = number(value) % width
            out[i, base + known[value, base]] = 1
    log = lambda x, top: np.minimum(np.log2(np.maximum(x, 0) + 1).astype(np.int64), top - 1)
    rows, base = np.arange(n), SOURCES + 32
    out[rows, base + log(n_chars, 24)] = 1
    out[rows, base + 24 + log(lines, 16)] = 1
    out[rows, base + 40 + log(n_chars / np.maximum(lines, 1), 24)] = 1
    return out


def _sigmoid(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -40, 40)))


def logistic(x: np.ndarray, y: np.ndarray, ridge: float = RIDGE, rounds: int = 12) -> np.ndarray:
    """Coefficients of a ridge logistic regression (the last one is the bias), by Newton steps."""
    x = np.concatenate([x, np.ones((len(x), 1))], 1)
    w = np.zeros(x.shape[1])
    penalty = np.full(x.shape[1], ridge)
    penalty[-1] = 1e-6
    for _ in range(rounds):
        p = _sigmoid(x @ w)
        step = np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + np.diag(penalty + 1e-9), x.T @ (p - y) + penalty * w)
        w -= step
        if np.abs(step).max() < 1e-6:
            break
    return w


def margin(x: np.ndarray, w: np.ndarray) -> np.ndarray:
    return x @ w[:-1] + w[-1]


@dataclass(frozen=True)
class Model:
    content: np.ndarray
    metadata: np.ndarray
    #: Slope and offset that calibrate each view, and the weights of the two calibrated margins.
    calibration: np.ndarray
    combination: np.ndarray

    def scores(self, content: np.ndarray, metadata: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(combined, content, metadata) probabilities."""
        views = [self.calibration[i, 0] * margin(x, w) + self.calibration[i, 1] for i, (x, w) in enumerate(((content, self.content), (metadata, self.metadata)))]
        return _sigmoid(np.stack(views, 1) @ self.combination[:-1] + self.combination[-1]), _sigmoid(views[0]), _sigmoid(views[1])


def cotrain(learn: tuple, pool: tuple, calibrate: tuple) -> Model:
    """learn and calibrate are (content, metadata, label), pool is (content, metadata)."""
    views = [(learn[i], learn[2]) for i in range(2)]
    free = [np.ones(len(pool[0]), bool) for _ in range(2)]  # pool rows not yet handed to the view
    share = float(learn[2].mean())
    for _ in range(ROUNDS):
        fitted = [logistic(x, y) for x, y in views]
        for giver, taker in ((0, 1), (1, 0)):
            z = margin(pool[giver], fitted[giver]) if len(pool[0]) else np.zeros(0)
            open_rows = np.flatnonzero(free[taker])
            ranked = open_rows[np.argsort(z[open_rows], kind="stable")]
            # Most sure of either class, in the proportion of the labels, and on the right side of one half.
            low = [i for i in ranked[: int(HANDED * (1 - share))] if z[i] < 0]
            high = [i for i in ranked[::-1][: int(HANDED * share)] if z[i] > 0]
            taken = np.array(low + high, np.int64)
            free[taker][taken] = False
            x, y = views[taker]
            views[taker] = (np.concatenate([x, pool[taker][taken]]), np.concatenate([y, np.repeat([0.0, 1.0], [len(low), len(high)])]))
    fitted = [logistic(x, y) for x, y in views]
    calibration = np.stack([logistic(margin(calibrate[i], fitted[i])[:, None], calibrate[2], 1e-3) for i in range(2)])
    margins = np.stack([calibration[i, 0] * margin(calibrate[i], fitted[i]) + calibration[i, 1] for i in range(2)], 1)
    return Model(fitted[0], fitted[1], calibration, logistic(margins, calibrate[2], 1e-2))


def _views(texts: pa.Array, source: list, lang: list, n_chars: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    content, lines = [], []
    for _, words in tb.pieces(texts):
        content.append(content_view(words))
        breaks = np.concatenate([[0], np.cumsum(words.data == 10)])
        lines.append(np.diff(breaks[words.offsets]) + 1)
    return np.concatenate(content), metadata_view(source, lang, n_chars, np.concatenate(lines))


def _source(docs: DataFrame) -> list:
    return [text_of(docs).alias("text"), F.col("source").cast("string").alias("source"), F.col("lang").cast("string").alias("lang"), F.coalesce(F.col("n_chars").cast("double"), F.lit(-1.0)).alias("n_chars")]


def _batch_views(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
    return _views(batch.column("text"), batch.column("source").to_pylist(), batch.column("lang").to_pylist(), batch.column("n_chars").to_numpy())


def train(docs: DataFrame, labels: DataFrame, folds: int = FOLDS, test_fold: int = TEST_FOLD) -> Model | None:
    """A model from bounded samples, chosen by a hash of the id, outside the test fold.

    Documents without a label form the pool. Repeated labels of an id count as their mean, rounded;
    NULL ids and labels are no labels. None where there are no labels of both classes.
    """
    known = labels.filter("doc_id IS NOT NULL AND quality IS NOT NULL").groupBy("doc_id").agg(F.round(F.avg("quality")).cast("int").alias("label"))
    marked = docs.filter("doc_id IS NOT NULL").select("doc_id", *_source(docs)).filter(remainder(F.col("doc_id"), folds) != test_fold)
    place = F.pmod(F.xxhash64(F.lit("quality"), "doc_id"), F.lit(1 << 32)) / F.lit(float(1 << 32))
    ids = marked.select("doc_id").join(known, "doc_id", "left").withColumn("place", place)
    counts = ids.agg(F.count("label").alias("labelled"), F.count("*").alias("all")).first()
    labelled, others = max(counts["labelled"], 1), max(counts["all"] - counts["labelled"], 1)
    learn = min(LEARN_ROWS / labelled, 0.75)
    both = min((LEARN_ROWS + CALIBRATE_ROWS) / labelled, 1.0)
    role = F.when(F.col("label").isNull(), F.when(F.col("place") < POOL_ROWS / others, 2)).otherwise(F.when(F.col("place") < learn, 0).when(F.col("place") < both, 1))
    chosen = ids.select("doc_id", F.coalesce("label", F.lit(0)).alias("label"), role.alias("role")).filter("role IS NOT NULL")
    chosen = cut_lineage(chosen.dropDuplicates(["doc_id"]))
    texts = marked.filter(place < max(both, POOL_ROWS / others))
    # Chosen ids are few: texts stay where they are unless the ids are measured to be too many to send.
    sample = join_unique(texts, chosen, "doc_id", hot=0, narrow=True)

    def step(batch: pa.RecordBatch):
        content, metadata = _batch_views(batch)
        flat = np.concatenate([content, metadata], 1).astype(np.float32)
        offsets = np.arange(0, flat.size + 1, flat.shape[1], dtype=np.int32)
        yield record_batch(role=batch.column("role"), label=batch.column("label"), numbers=pa.ListArray.from_arrays(offsets, flat.reshape(-1)))

    rows = map_batches(sample.select("text", "source", "lang", "n_chars", "role", "label"), step, "role int, label int, numbers array<float>").toArrow()
    role, label = rows.column("role").to_numpy(), rows.column("label").to_numpy().astype(float)
    numbers = rows.column("numbers").combine_chunks().flatten().to_numpy().reshape(-1, CONTENT + METADATA)
    parts = [(numbers[role == r, :CONTENT].astype(float), numbers[role == r, CONTENT:].astype(float), label[role == r]) for r in range(3)]
    if any(len(set(parts[r][2])) < 2 for r in range(2)):
        return None
    return cotrain(parts[0], parts[2][:2], parts[1])


def score(docs: DataFrame, model: Model | None, keep: tuple[str, ...] = ("doc_id",), threshold: float = THRESHOLD) -> DataFrame:
    """The columns `keep` of `docs`, then score (probability of good quality), content_score,
    metadata_score and kept (score >= threshold).

    NULL and empty texts are scored from an empty content view; NULL source, language or n_chars are
    values of their own. Without a model every score is 0.5. Rows that repeat an id are scored each.
    """
    kinds = {f.name: f.dataType.simpleString() for f in docs.schema}
    kept = {c: f"k__{i}" for i, c in enumerate(keep)}
    sent = docs.sparkSession.sparkContext.broadcast(model)

    def step(batch: pa.RecordBatch):
        if sent.value is None:
            combined = content = metadata = np.full(batch.num_rows, 0.5)
        else:
            combined, content, metadata = sent.value.scores(*_batch_views(batch))
        yield record_batch(**{k: batch.column(k) for k in kept.values()}, score=combined, content_score=content, metadata_score=metadata)

    schema = ", ".join([*[f"{k} {kinds[c]}" for c, k in kept.items()], "score double, content_score double, metadata_score double"])
    scored = map_batches(docs.select(*[F.col(c).alias(k) for c, k in kept.items()], *_source(docs)), step, schema)
    return scored.withColumn("kept", F.col("score") >= threshold).withColumnsRenamed({k: c for c, k in kept.items()})
