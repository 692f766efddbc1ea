"""Near-duplicate documents by circulant MinHash, banding and exact Jaccard verification.

A shingle is placed in a circle of UNIVERSE positions by one permutation; a second permutation, fixed
as a table, is read at that position and at the next HASHES - 1 ones: coordinate k of a signature is
the least value of the table shifted by k. Bands of the signature name buckets. Documents with equal
shingle sets are one class from the start. The classes of a bucket are compared with its centre, and
with each other only where exact bounds from the centre and from the order of rare shingles leave a link
possible: copies never make all pairs, and no link between components is lost.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from newsdesk.llm import textbatch as tb
from newsdesk.llm.common import map_batches, record_batch, row_key, shelter, text_of
from newsdesk.llm.components import components
from newsdesk.session import store

#: 42 bands of 6: two sets of Jaccard similarity 0.8 share no bucket with probability 3e-6.
BANDS, ROWS = 42, 6
HASHES = BANDS * ROWS
UNIVERSE = 1 << 20


def _shifted_permutation() -> np.ndarray:
    """Row p holds the second permutation at positions p, p + 1, … p + HASHES - 1 of the circle."""
    table = np.random.default_rng(11).permutation(UNIVERSE).astype(np.uint32)
    return np.lib.stride_tricks.sliding_window_view(np.concatenate([table, table[: HASHES - 1]]), HASHES)


_CACHE: dict[str, np.ndarray] = {}


def shingle_sets(words: tb.Words, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingle hashes by document, sorted within each, and the offsets of the documents.

    A document with fewer than n words has its whole sequence as its one shingle.
    """
    counts, docs = words.counts, len(words.counts)
    grams, doc = tb.chained(words.hashes, n), words.doc
    inside = np.flatnonzero(doc[: len(grams)] == doc[n - 1 :]) if len(grams) else np.zeros(0, np.int64)
    hashes, owner = [grams[inside]], [doc[inside]]
    for d in np.flatnonzero((counts > 0) & (counts < n)):
        hashes.append(tb.chained(words.hashes[words.first[d] : words.first[d + 1]], int(counts[d])))
        owner.append(np.array([d]))
    h, o = np.concatenate(hashes), np.concatenate(owner)
    order = np.lexsort((h, o))
    h, o = h[order], o[order]
    new = np.ones(len(h), bool)
    new[1:] = (h[1:] != h[:-1]) | (o[1:] != o[:-1])
    h, o = h[new], o[new]
    return h, np.searchsorted(o, np.arange(docs + 1))


def signature(shingles: np.ndarray) -> np.ndarray:
    """HASHES coordinates of one non-empty set; a long set is read in slices."""
    if "shifted" not in _CACHE:
        _CACHE["shifted"] = _shifted_permutation()
    places = (shingles >> np.uint64(44)).astype(np.int64)
    least = np.full(HASHES, UNIVERSE, np.uint32)
    for i in range(0, len(places), 1024):
        np.minimum(least, _CACHE["shifted"][places[i : i + 1024]].min(axis=0), out=least)
    return least


def _signed(words: tb.Words, n: int) -> dict:
    h, offsets = shingle_sets(words, n)
    sizes = np.diff(offsets)
    some = np.flatnonzero(sizes)
    digests = [np.zeros(len(sizes), np.uint64) for _ in range(2)]
    if len(some):
        for digest, salt in zip(digests, (1, 2)):
            digest[some] = np.add.reduceat(tb.mix(h * np.uint64(2) + np.uint64(salt)), offsets[:-1][some])
    signed = np.array([signature(h[offsets[d] : offsets[d + 1]]) for d in some], np.uint64).reshape(-1, BANDS, ROWS)
    bands = np.repeat(tb.mix(np.arange(1, BANDS + 1, dtype=np.uint64))[None], len(some), 0)
    for row in range(ROWS):
        bands = tb.mix(bands + signed[:, :, row])
    return {"n": sizes, "d1": digests[0], "d2": digests[1], "bands": bands.reshape(-1), "some": sizes > 0}


def signatures(docs: DataFrame, shingle_words: int) -> DataFrame:
    """doc_id, key, n_shingles, the digest of the set (set_id, check) and its buckets, per row."""
    def step(batch: pa.RecordBatch):
        parts = [_signed(words, shingle_words) for _, words in tb.pieces(batch.column("text"), lower=True)]
        offsets = np.concatenate([[0], np.cumsum(np.concatenate([p["some"] for p in parts]) * BANDS)]).astype(np.int32)
        buckets = pa.ListArray.from_arrays(offsets, np.concatenate([p["bands"] for p in parts]).view(np.int64))
        whole = {k: np.concatenate([p[k] for p in parts]) for k in ("n", "d1", "d2")}
        yield record_batch(doc_id=batch.column("doc_id"), key=batch.column("key"), n_shingles=whole["n"].astype(np.int64),
                           set_id=whole["d1"].view(np.int64), check=whole["d2"].view(np.int64), buckets=buckets)

    source = docs.select("doc_id", row_key(docs).alias("key"), text_of(docs).alias("text"))
    kind = docs.schema["doc_id"].dataType.simpleString()
    return map_batches(source, step, f"doc_id {kind}, key bigint, n_shingles bigint, set_id bigint, check bigint, buckets array<bigint>")


def _compared(pairs: DataFrame, texts: DataFrame, shingle_words: int, beyond: bool = False) -> DataFrame:
    """The pairs (u, v) of set ids with the sizes of both full sets and `common`; with `beyond`, also the
    shingles of v that u lacks."""
    left = texts.select(F.col("set_id").alias("u"), F.col("text").alias("text_u"))
    right = texts.select(F.col("set_id").alias("v"), F.col("text").alias("text_v"))

    def sets_of(column: pa.Array) -> list[np.ndarray]:
        out: list[np.ndarray] = []
        for _, words in tb.pieces(column, lower=True):
            h, offsets = shingle_sets(words, shingle_words)
            out += [h[offsets[d] : offsets[d + 1]] for d in range(len(offsets) - 1)]
        return out

    def step(batch: pa.RecordBatch):
        out: dict[str, list] = {"n_u": [], "n_v": [], "common": [], **({"beyond": []} if beyond else {})}
        for a, b in zip(sets_of(batch.column("text_u")), sets_of(batch.column("text_v"))):
            more = np.setdiff1d(b, a, assume_unique=True)
            for name, value in zip(out, (len(a), len(b), len(b) - len(more), more.view(np.int64))):
                out[name].append(value)
        yield record_batch(u=batch.column("u"), v=batch.column("v"), **{n: pa.array(v, pa.list_(pa.int64()) if n == "beyond" else pa.int64()) for n, v in out.items()})

    both = pairs.join(left, "u").join(right, "v").select("u", "v", "text_u", "text_v")
    return map_batches(both, step, "u bigint, v bigint, n_u bigint, n_v bigint, common bigint" + ", beyond array<bigint>" * beyond)


def classes(docs: DataFrame, shingle_words: int = 5, percent: int = 80) -> DataFrame:
    """doc_id, key, n_shingles, component_id and kept for every row of `docs`.

    component_id is the smallest doc_id of the connected documents, itself included; kept marks that
    document. Texts without a word (NULL, empty, white space) have no shingles, are linked with
    nothing and kept. Rows that repeat an id and text get the same result; a NULL id is never the
    smallest unless all ids of the component are NULL.
    """
    signed = store(signatures(docs, shingle_words))
    groups = signed.filter("n_shingles > 0").groupBy("set_id", "check").agg(F.min("doc_id").alias("least"), F.min("key").alias("key"), F.first("buckets").alias("buckets"))
    groups = store(groups)
    spread = groups.select("set_id", F.explode("buckets").alias("bucket"))
    shared = store(spread.groupBy("bucket").agg(F.count("*").alias("size")).filter("size > 1"))
    members = store(spread.join(shared, "bucket"))
    wanted = members.select("set_id").distinct().join(groups.select("set_id", "key"), "set_id")
    texts = docs.select(row_key(docs).alias("key"), text_of(docs).alias("text")).join(wanted, "key").groupBy("set_id").agg(F.min("text").alias("text"))
    labels = components(_links(members, store(texts), shingle_words, percent))
    named = store(groups.select("set_id", "least").join(labels, F.col("set_id") == F.col("id"), "left").select("set_id", "least", F.coalesce("component", "set_id").alias("component")))
    smallest = store(named.groupBy("component").agg(F.min("least").alias("component_id")))
    best = named.join(smallest, "component").select("set_id", "component_id")
    best = store(best)
    result = signed.select("doc_id", "key", "n_shingles", F.when(F.col("n_shingles") > 0, F.col("set_id")).alias("set_id")).join(best, "set_id", "left")
    component = F.when(F.col("n_shingles") > 0, F.col("component_id")).otherwise(F.col("doc_id"))
    return result.select("doc_id", "key", "n_shingles", component.alias("component_id")).withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id")))


def _links(members: DataFrame, texts: DataFrame, shingle_words: int, percent: int) -> DataFrame:
    """Edges (u, v) that connect all classes of `members` (bucket, set_id, size) that are linked.

    Each bucket has a centre, the class that shares most buckets with others, and every other class
    is compared with it. Classes linked with the centre are connected. Any other link (f, m) of the
    bucket, f not linked with the centre, is searched among the pairs that `_candidates` leaves, and these
    are compared in full.
    """
    mates = members.groupBy("set_id").agg(F.sum("size").alias("mates"))
    ranked = members.select("bucket", "set_id").join(store(mates), "set_id")
    centres = store(ranked.groupBy("bucket").agg(F.max(F.struct("mates", "set_id"))["set_id"].alias("u")))
    first = members.select("bucket", F.col("set_id").alias("v")).join(centres, "bucket").filter("u <> v").select("u", "v").distinct()
    compared = store(_compared(first, texts, shingle_words, beyond=True))
    linked = f"100 * common >= {percent} * (n_u + n_v - common)"
    second = _candidates(compared.withColumn("linked", F.expr(linked)), percent)
    again = _compared(store(second), texts, shingle_words)
    return compared.filter(linked).select("u", "v").union(store(again).filter(linked).select("u", "v"))


def _candidates(compared: DataFrame, percent: int) -> DataFrame:
    """Pairs (u, v) of classes around one centre that may be linked, at least one of them not with the centre.

    Linked sets have need = percent / (100 + percent) * (both sizes) shingles in common: at most as many
    of the centre's as either has, and shared ones beyond it. A set needs `least` shared ones beyond the
    centre, whatever its partner. The shingles beyond it that nobody else has are left out and the rest put
    in order, those that few sets around the centre share first; two linked sets then share one among all
    but the last `least` - 1 of each, and their first shared one comes so early that enough are left
    behind it. So sets that only share what the whole crowd does, for instance where the centre itself was
    edited, do not meet.
    """
    rows = compared.withColumn("least", F.ceil(F.col("n_v") * percent / 100).cast("bigint") - F.col("common"))
    mixed = store(rows.filter("NOT linked").select("u").distinct())
    around = store(rows.join(mixed, "u").select("u", "v", F.col("n_v").alias("n"), F.col("common").alias("i"), "linked", "least", "beyond"))
    enough = lambda common: (100 + percent) * common >= percent * (F.col("n_f") + F.col("n_m"))
    once = (F.col("f") != F.col("m")) & (F.col("linked") | (F.col("f") < F.col("m")))
    apart = lambda df: df.filter("NOT linked").drop("linked").withColumnsRenamed({"v": "f", "n": "n_f", "i": "i_f", "rest": "rest_f"})
    other = lambda df: df.withColumnsRenamed({"v": "m", "n": "n_m", "i": "i_m", "rest": "rest_m"})
    pair = lambda df: df.select(F.least("f", "m").alias("u"), F.greatest("f", "m").alias("v"))

    # Sets that need nothing beyond the centre; linked ones differ in size by no more than a size class.
    inner = around.filter("least <= 0").select("u", "v", "n", "i", "linked")
    size_class = F.floor(F.log(F.col("n").cast("double")) / max(np.log(100 / percent), 1e-6)).cast("int")
    near = apart(inner.withColumn("c", F.explode(F.array(size_class - 1, size_class, size_class + 1))))
    near = near.join(other(inner.withColumn("c", size_class)), ["u", "c"]).filter(once & enough(F.least("i_f", "i_m")))

    entries = around.select("u", "v", "linked", F.explode("beyond").alias("e"))
    shared = entries.groupBy("u", "e").agg(F.count("*").alias("held"), F.count_if(~F.col("linked")).alias("held_apart")).filter("held > 1 AND held_apart > 0")
    kept = entries.join(shared, ["u", "e"]).groupBy("u", "v").agg(F.sort_array(F.collect_list(F.struct("held", "e")))["e"].alias("order"))
    prefixes = around.drop("beyond").join(kept, ["u", "v"]).select(
        "u", "v", "n", "i", "linked", "least", F.size("order").alias("many"), F.posexplode("order").alias("at", "e"))
    # `rest` shingles come behind this one: a set that needs `least` in all does not start later.
    prefixes = store(prefixes.withColumn("rest", F.col("many") - F.col("at") - 1).filter("rest >= least - 1").drop("many", "at", "least"))
    behind = F.least("i_f", "i_m") + 1 + F.least("rest_f", "rest_m")
    far = apart(prefixes).join(other(prefixes), ["u", "e"]).filter(once & enough(behind))
    return pair(near).union(pair(far)).distinct()


def keep_one(docs: DataFrame, shingle_words: int = 5, percent: int = 80) -> DataFrame:
    """The rows of `docs` that are the document with the smallest id of their component."""
    inner, restore = shelter(docs, "doc_id", "text")
    kept = classes(inner, shingle_words, percent).filter("kept").select("key").distinct()
    rows = inner.withColumn("key", row_key(inner)).join(kept, "key", "left_semi")
    return rows.select(*restore(rows))
