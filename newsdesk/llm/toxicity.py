"""Toxicity by multiple-instance learning: a text is toxic where any of its sentences is.

A sentence's probability is logistic in the words it holds and their beginnings; the text's is the
noisy-or of its sentences. Weights are trained from labels of whole texts only, so the gradient decides
which sentences carry the label; the same weights then locate them.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from newsdesk.llm import textbatch as tb
from newsdesk.llm.common import map_batches, record_batch, remainder, text_of
from newsdesk.operators.joins import join_unique
from newsdesk.session import cut_lineage

FOLDS, TEST_FOLD = 3, 1
THRESHOLD = 0.7
DIMENSION = 1 << 20
PREFIXES = (4, 5, 6)
#: About so many bytes of labelled text of each class are fitted; every text is scored.
TRAIN_BYTES = {1: 5_000_000, 0: 9_000_000}
#: A feature is evidence if toxic documents hold it LIFT times as often as others, by EVIDENCE standard errors.
EVIDENCE, LIFT = 6.0, 2.0
#: Features the driver sorts at once.
BLOCK = 1 << 20
ROUNDS, RATE, RIDGE = 200, 0.1, 1e-4
CORE = np.zeros(256, bool)
CORE[48:58] = CORE[65:91] = CORE[97:123] = CORE[128:] = True
STOP = np.zeros(256, bool)
for _b in b".!?":
    STOP[_b] = True


def instances(words: tb.Words) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(document of each sentence, first word of each, features by word and kind, words with any).

    A sentence ends after a word that ends in . ! or ? and at a line break.
    """
    data, doc = words.data, words.doc
    n = len(words.starts)
    breaks = np.concatenate([[0], np.cumsum(data == 10)])
    begins = np.ones(n, bool)
    if n:
        begins[1:] = (doc[1:] != doc[:-1]) | STOP[data[words.ends[:-1] - 1]] | (breaks[words.starts[1:]] > breaks[words.ends[:-1]])
    places = np.flatnonzero(CORE[data])
    left, right = np.searchsorted(places, words.starts), np.searchsorted(places, words.ends)
    some = right > left
    starts, ends = places[left[some]], places[right[some] - 1] + 1
    sums = tb.prefix_sums(data)
    kinds = [tb.span_hashes(sums, starts, ends)]
    for k in PREFIXES:
        kinds.append(tb.mix(tb.span_hashes(sums, starts, np.minimum(starts + k, ends)) + np.uint64(k)))
    features = (np.stack(kinds, 1) >> np.uint64(44)).astype(np.int32) if n else np.zeros((0, 1 + len(PREFIXES)), np.int32)
    first = np.flatnonzero(begins)
    return doc[first], first, features, some


def sentence_logits(words: tb.Words, weights: np.ndarray, bias: float) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(document, first word, logit) of every sentence."""
    doc, first, features, some = instances(words)
    if not len(first):
        return doc, first, np.zeros(0)
    by_word = np.zeros(len(words.starts))
    by_word[some] = weights[features].sum(1)
    return doc, first, bias + np.add.reduceat(by_word, first)


def softplus(z: np.ndarray) -> np.ndarray:
    return np.logaddexp(0.0, z)


def sigmoid(z: np.ndarray) -> np.ndarray:
    return np.exp(-softplus(-z))


def evidence(features: np.ndarray, offsets: np.ndarray, labels: np.ndarray) -> np.ndarray:
    """Features that toxic documents hold more often than chance explains, by presence in documents.

    offsets: where each document's features begin, and their number. Documents are counted in blocks of
    about BLOCK features, so that the driver holds no sorted copy of all of them.
    """
    toxic, other = np.zeros(DIMENSION), np.zeros(DIMENSION)
    cuts = np.searchsorted(offsets, np.arange(0, offsets[-1], BLOCK))
    cuts = np.unique(np.append(cuts, [0, len(labels)]))
    for a, b in zip(cuts, cuts[1:]):
        owner = np.repeat(np.arange(a, b), np.diff(offsets[a : b + 1]))
        held = np.unique(owner * DIMENSION + features[offsets[a] : offsets[b]])
        feature, label = held % DIMENSION, labels[held // DIMENSION]
        toxic += np.bincount(feature, label, DIMENSION)
        other += np.bincount(feature, 1 - label, DIMENSION)
    many = np.array([max(labels.sum(), 1), max((1 - labels).sum(), 1)])
    both = (toxic + other) / many.sum()
    toxic, other = toxic / many[0], other / many[1]
    error = np.sqrt(np.maximum(both * (1 - both), 1e-12) * (1 / many).sum())
    return np.flatnonzero((toxic - other > EVIDENCE * error) & (toxic >= LIFT * other))


def fit(features: np.ndarray, sentence_starts: np.ndarray, doc_starts: np.ndarray, labels: np.ndarray) -> tuple[np.ndarray, float]:
    """Weights and bias that maximise the likelihood of the labels under noisy-or.

    features: all features, sentence by sentence; sentence_starts: where each sentence's begin;
    doc_starts: the first sentence of each document. Classes are weighted alike. Only evidence gets a
    weight, and none a negative one: no harmless word makes up for a toxic one.
    """
    lengths = np.diff(np.append(sentence_starts, len(features)))
    owner = np.repeat(np.arange(len(doc_starts)), np.diff(np.append(doc_starts, len(sentence_starts))))
    kept = evidence(features, np.append(sentence_starts[doc_starts], len(features)), labels)
    number, held = np.zeros(DIMENSION, np.int64), np.zeros(DIMENSION, bool)
    number[kept], held[kept] = np.arange(len(kept)), True
    at = np.flatnonzero(held[features])
    column, sentence = number[features[at]], np.searchsorted(sentence_starts, at, "right") - 1
    weights, bias = np.ones(len(kept)), -5.0
    first, second = np.zeros(len(kept) + 1), np.zeros(len(kept) + 1)
    balance = np.where(labels == 1, 0.5 / max(labels.sum(), 1), 0.5 / max((1 - labels).sum(), 1))
    for step in range(1, ROUNDS + 1):
        z = bias + np.bincount(sentence, weights[column], len(lengths))
        clean = np.add.reduceat(softplus(z), doc_starts)  # minus the log probability that no sentence is toxic
        pull = np.where(labels == 1, -1 / np.expm1(np.clip(clean, 1e-9, 500)), 1.0) * balance
        slope = sigmoid(z) * pull[owner]
        gradient = np.append(np.bincount(column, slope[sentence], len(kept)) + RIDGE * weights, slope.sum())
        first, second = 0.9 * first + 0.1 * gradient, 0.99 * second + 0.01 * gradient**2
        move = RATE * (first / (1 - 0.9**step)) / (np.sqrt(second / (1 - 0.99**step)) + 1e-8)
        weights, bias = np.maximum(weights - move[:-1], 0), bias - move[-1]
    out = np.zeros(DIMENSION, np.float32)
    out[kept] = weights
    return out, float(bias)


def train(docs: DataFrame, labels: DataFrame, folds: int = FOLDS, test_fold: int = TEST_FOLD) -> tuple[np.ndarray, float]:
    """Weights and bias from labelled documents outside the test fold.

    A bounded sample of them is fitted: by a hash of the id, about TRAIN_BYTES of each class. Labels
    that repeat an id count as toxic if any of them is; NULL ids and labels are no labels.
    """
    kind = docs.schema["doc_id"].dataType
    known = labels.filter("doc_id IS NOT NULL AND toxic IS NOT NULL").groupBy(F.col("doc_id").cast(kind).alias("doc_id")).agg(F.max("toxic").cast("int").alias("label"))
    known = known.filter(remainder(F.col("doc_id"), folds) != test_fold)
    sizes = docs.select("doc_id", F.octet_length(text_of(docs)).alias("size"))
    total = {r["label"]: r["size"] or 0 for r in sizes.join(known, "doc_id").groupBy("label").agg(F.sum("size").alias("size")).collect()}
    share = {label: TRAIN_BYTES[label] / max(total.get(label, 0), 1) for label in TRAIN_BYTES}
    place = F.pmod(F.xxhash64(F.lit("toxic"), "doc_id"), F.lit(1 << 32)) / F.lit(float(1 << 32))
    picked = cut_lineage(known.filter(place < F.when(F.col("label") == 1, share[1]).otherwise(share[0])))
    texts = docs.select("doc_id", text_of(docs).alias("text")).filter(place < max(share.values()))
    # Picked ids are few: texts stay where they are unless the ids are measured to be too many to send.
    chosen = join_unique(texts, picked, "doc_id", hot=0, narrow=True)

    def step(batch: pa.RecordBatch):
        out: dict[str, list] = {"label": [], "features": [], "sizes": []}
        for row, words in tb.pieces(batch.column("text"), lower=True):
            doc, first, features, some = instances(words)
            counted = np.concatenate([[0], np.cumsum(some)]) * features.shape[1]
            starts = counted[first]
            ends = np.append(starts[1:], counted[-1])
            flat = features.reshape(-1)
            edges = np.searchsorted(doc, np.arange(len(words.counts) + 1))
            for d, (a, b) in enumerate(zip(edges, edges[1:])):
                if b > a:
                    out["label"].append(batch.column("label")[row + d].as_py())
                    out["features"].append(flat[starts[a] : ends[b - 1]])
                    out["sizes"].append((ends[a:b] - starts[a:b]).astype(np.int32))
        yield record_batch(label=pa.array(out["label"], pa.int32()), features=pa.array(out["features"], pa.list_(pa.int32())), sizes=pa.array(out["sizes"], pa.list_(pa.int32())))

    rows = map_batches(chosen.select("text", "label"), step, "label int, features array<int>, sizes array<int>").toArrow()
    if not rows.num_rows:
        return np.zeros(DIMENSION, np.float32), -5.0
    label = rows.column("label").to_numpy()
    features = rows.column("features").combine_chunks().flatten().to_numpy()
    lists = rows.column("sizes").combine_chunks()
    sizes = lists.flatten().to_numpy().astype(np.int64)
    owner = np.repeat(np.arange(len(label)), lists.value_lengths().to_numpy())
    del rows, lists
    full = sizes > 0  # reduceat needs sentences with a feature
    starts = np.concatenate([[0], np.cumsum(sizes[full])[:-1]])
    docs_left, doc_starts = np.unique(owner[full], return_index=True)
    return fit(features, starts, doc_starts, label[docs_left].astype(float))


def score(docs: DataFrame, weights: np.ndarray, bias: float, keep: tuple[str, ...] = ("doc_id",), threshold: float = THRESHOLD) -> DataFrame:
    """The columns `keep` of `docs`, then score, predicted and offending: (sentence number, first
    word, words, probability) of the sentences with a probability of at least one half.

    A NULL text counts as empty; a text without words scores 0. Rows that repeat an id are scored each.
    """
    sent = docs.sparkSession.sparkContext.broadcast((weights, bias))
    kinds = {f.name: f.dataType.simpleString() for f in docs.schema}
    kept = {c: f"k__{i}" for i, c in enumerate(keep)}
    source = docs.select(*[F.col(c).alias(k) for c, k in kept.items()], text_of(docs).alias("text__"))
    place = pa.list_(pa.struct([("sentence", pa.int32()), ("first_word", pa.int32()), ("words", pa.int32()), ("probability", pa.float64())]))

    def step(batch: pa.RecordBatch):
        w, b = sent.value
        scores, found = [], []
        for _, words in tb.pieces(batch.column("text__"), lower=True):
            n = len(words.counts)
            doc, first, z = sentence_logits(words, w, b)
            scores.append(-np.expm1(-np.bincount(doc, softplus(z), n)))
            mine: list[list] = [[] for _ in range(n)]
            ends = np.append(first[1:], len(words.starts))
            number = np.searchsorted(doc, np.arange(n))
            for s in np.flatnonzero(z >= 0):
                d = doc[s]
                mine[d].append({"sentence": int(s - number[d]), "first_word": int(first[s] - words.first[d]), "words": int(ends[s] - first[s]), "probability": float(sigmoid(z[s]))})
            found += mine
        yield record_batch(**{k: batch.column(k) for k in kept.values()}, score=np.concatenate(scores), offending=pa.array(found, place))

    schema = ", ".join([*[f"{k} {kinds[c]}" for c, k in kept.items()], "score double", "offending array<struct<sentence:int,first_word:int,words:int,probability:double>>"])
    scored = map_batches(source, step, schema).withColumn("predicted", (F.col("score") >= threshold).cast("int"))
    return scored.select(*[F.col(k).alias(c) for c, k in kept.items()], "score", "predicted", "offending")
