"""Merkle manifest of a table of documents, with a witness for every row.

The rows of a language are the leaves of its tree, in the order of their ids; the roots of the languages
are the leaves of one more tree. Every ARITY consecutive nodes, fewer at the end of a level, become the
hash of their digests as long as a level has several nodes.

Witnesses are built while leaves are appended. A finished run of siblings closes a subtree: what is to
the left and to the right of each sibling extends the witnesses of all leaves below it. Appends are
aligned to blocks of BLOCK leaves, so that blocks grow in parallel; their roots are appended to blocks
again until a tree has one, and what closes there extends the witnesses of whole blocks.

Defined results: rows that repeat an id are leaves each, in the order of their digests; a NULL id comes
first in its tree; a NULL language is a tree of its own before all others; an empty table has no rows.
Other columns of the table are neither hashed nor looked at. Texts are hashed whole inside the JVM.
"""

from __future__ import annotations

import hashlib
from functools import reduce

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from newsdesk.llm.common import map_batches, record_batch
from newsdesk.operators.joins import join_unique
from newsdesk.session import store

ARITY, LEVELS = 8, 2
BLOCK = ARITY**LEVELS
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_PATH = "befores array<binary>, afters array<binary>"


def hashed(*parts: bytes) -> bytes:
    """Digest of the concatenated parts, each digest in them as hex text."""
    return hashlib.sha256("".join(p.hex() for p in parts).encode()).digest()


def leaf_digest(docs: DataFrame, text: Column | None = None) -> Column:
    """Digest of a row: every field as its UTF-8 length, a colon and its value, `-` where it is NULL."""
    values = [(text if f == "text" and text is not None else docs[f]).cast("string") for f in FIELDS]
    said = [F.when(v.isNull(), F.lit("-")).otherwise(F.concat(F.octet_length(v).cast("string"), F.lit(":"), v)) for v in values]
    return F.unhex(F.sha2(F.concat(*said), 256))


class Subtrees:
    """Appends digests to one block. `extensions` are (first leaf, last leaf, digests before, after)."""

    def __init__(self):
        self.open: list[list[tuple[bytes, int, int]]] = [[]]
        self.extensions: list[tuple[int, int, bytes, bytes]] = []
        self.size = 0

    def append(self, digest: bytes) -> None:
        self.open[0].append((digest, self.size, self.size))
        self.size += 1
        level = 0
        while len(self.open[level]) == ARITY:
            self._close(level)
            level += 1

    def _close(self, level: int) -> None:
        run = self.open[level]
        digests = [d for d, _, _ in run]
        for i, (_, first, last) in enumerate(run):
            self.extensions.append((first, last, b"".join(digests[:i]), b"".join(digests[i + 1 :])))
        if len(self.open) == level + 1:
            self.open.append([])
        self.open[level + 1].append((hashed(*digests), run[0][1], run[-1][2]))
        self.open[level] = []

    def finish(self, levels: int) -> bytes:
        """Root of the block after `levels` levels; runs that are not full are closed as they are."""
        for level in range(levels):
            if self.open[level]:
                self._close(level)
        return self.open[levels][0][0]


def levels_of(total: int) -> int:
    """Levels that a block of a tree with `total` leaves grows by."""
    n = 0
    while total > 1 and n < LEVELS:
        total, n = -(-total // ARITY), n + 1
    return n


def placed(nodes: DataFrame, *order: str) -> DataFrame:
    """`nodes` with `pos`, the place of each among the rows of its `tree` in the given order, and `total`.

    Rows are dealt out by ranges, so no tree is sorted by one task; only the number of rows that every
    task holds of every tree is summed up.
    """
    ordered = nodes.repartitionByRange("tree", *order).sortWithinPartitions("tree", *order)
    ordered = store(ordered.withColumn("at", F.monotonically_increasing_id()).withColumn("part", F.shiftright("at", 33)))
    runs = ordered.groupBy("tree", "part").agg(F.min("at").alias("first"), F.count("*").alias("n"))
    tree = Window.partitionBy("tree")
    earlier = F.sum("n").over(tree.orderBy("part").rowsBetween(Window.unboundedPreceding, -1))
    runs = runs.select("tree", "part", (F.coalesce(earlier, F.lit(0)) - F.col("first")).alias("shift"), F.sum("n").over(tree).alias("total"))
    rows = join_unique(ordered, store(runs), ["tree", "part"], hot=0, narrow=True)
    return rows.withColumn("pos", F.col("at") + F.col("shift")).drop("at", "part", "shift")


def raised(nodes: DataFrame, *carried: str) -> DataFrame:
    """One row per block of `nodes` (tree, pos, total, digest and the columns `carried`): tree, block,
    total, its leaves in order, the digest of its root, and the extensions of its leaves' witnesses."""
    blocks = nodes.groupBy("tree", F.expr(f"pos div {BLOCK}").alias("block")).agg(
        F.first("total").alias("total"), F.sort_array(F.collect_list(F.struct("pos", "digest", *carried))).alias("leaves"))

    def step(batch: pa.RecordBatch):
        roots, spans, befores, afters = [], [], [], []
        for total, leaves in zip(batch.column("total").to_pylist(), batch.column("leaves")):
            grown = Subtrees()
            for digest in leaves.values.field("digest").to_pylist():
                grown.append(digest)
            roots.append(grown.finish(levels_of(total)))
            spans.append([x for e in grown.extensions for x in e[:2]])
            befores.append([e[2] for e in grown.extensions])
            afters.append([e[3] for e in grown.extensions])
        kind = pa.list_(pa.binary())
        yield record_batch(tree=batch.column("tree"), block=batch.column("block"), total=batch.column("total"), leaves=batch.column("leaves"),
                           digest=pa.array(roots, pa.binary()), spans=pa.array(spans, pa.list_(pa.int32())), befores=pa.array(befores, kind), afters=pa.array(afters, kind))

    leaves = blocks.schema["leaves"].dataType.simpleString()
    return map_batches(blocks, step, f"tree string, block bigint, total bigint, leaves {leaves}, digest binary, spans array<int>, {_PATH}")


def grown(nodes: DataFrame, *carried: str) -> list[DataFrame]:
    """Blocks of `nodes`, then blocks of their roots and so on, until every tree has one root."""
    layers = [store(raised(nodes, *carried))]
    while not (several := layers[-1].filter(F.col("total") > BLOCK)).isEmpty():
        roots = several.select("tree", F.col("block").alias("pos"), F.ceil(F.col("total") / BLOCK).alias("total"), "digest")
        layers.append(store(raised(roots)))
    return layers


def tops(layers: list[DataFrame]) -> DataFrame:
    """The root of every tree."""
    return reduce(DataFrame.unionByName, [x.filter(F.col("total") <= BLOCK).select("tree", "digest") for x in layers])


def witnesses(spans: list[int], befores: list[bytes], afters: list[bytes], n: int, above: list[tuple[bytes, bytes]]) -> list[list[tuple[bytes, bytes]]]:
    """Per leaf of a block what is before and after it, level by level, up to the root of all."""
    out: list[list[tuple[bytes, bytes]]] = [[] for _ in range(n)]
    for e, pair in enumerate(zip(befores, afters)):
        for leaf in range(spans[2 * e], spans[2 * e + 1] + 1):
            out[leaf].append(pair)
    for own in out:
        own += above
    return out


def _blocks_of(batch: pa.RecordBatch):
    """(row of the batch, leaves as a struct array, witnesses) of every block."""
    own = [batch.column(c).to_pylist() for c in ("spans", "befores", "afters", "up_befores", "up_afters")]
    for row, leaves in enumerate(batch.column("leaves")):
        spans, befores, afters, up_befores, up_afters = (c[row] for c in own)
        yield row, leaves.values, witnesses(spans, befores, afters, len(leaves.values), list(zip(up_befores, up_afters)))


def _joined(layers: list[DataFrame], top_paths: DataFrame) -> DataFrame:
    """The lowest blocks with the witness of their root up to the root of all: `up_befores`, `up_afters`,
    and the columns subroot and root of their tree.

    `top_paths`: tree, subroot, root, befores, afters; the witness of each tree's root.
    """
    up = top_paths.withColumnsRenamed({"befores": "up_befores", "afters": "up_afters"})
    paths = None
    for depth in range(len(layers) - 1, -1, -1):
        layer = layers[depth]
        done = join_unique(layer.filter(F.col("total") <= BLOCK), up, "tree", hot=0, narrow=True)
        if paths is not None:
            done = done.unionByName(join_unique(layer.filter(F.col("total") > BLOCK), paths, ["tree", "block"], hot=0, narrow=True))
        if depth:
            paths = store(_children(done))
    return done


def _children(blocks: DataFrame) -> DataFrame:
    """The witness of every leaf of inner blocks; the leaf is a block of the layer below."""
    def step(batch: pa.RecordBatch):
        out: dict[str, list] = {n: [] for n in ("tree", "block", "subroot", "root", "up_befores", "up_afters")}
        fixed = {n: batch.column(n).to_pylist() for n in ("tree", "subroot", "root")}
        for row, leaves, paths in _blocks_of(batch):
            for pos, path in zip(leaves.field("pos").to_pylist(), paths):
                values = (fixed["tree"][row], pos, fixed["subroot"][row], fixed["root"][row], [b for b, _ in path], [a for _, a in path])
                for name, value in zip(out, values):
                    out[name].append(value)
        kinds = {"tree": pa.string(), "block": pa.int64(), "subroot": pa.binary(), "root": pa.binary()}
        yield record_batch(**{n: pa.array(v, kinds.get(n, pa.list_(pa.binary()))) for n, v in out.items()})

    return map_batches(blocks, step, "tree string, block bigint, subroot binary, root binary, up_befores array<binary>, up_afters array<binary>")


def _language_paths(subroots: DataFrame) -> DataFrame:
    """tree, subroot, root, befores, afters: the witness of every language's root in the tree of them all."""
    nodes = placed(subroots.select(F.lit("").alias("tree"), F.col("tree").alias("name"), "digest"), "name")
    layers = grown(nodes, "name")
    empty = F.array().cast("array<binary>")
    start = tops(layers).select("tree", F.col("digest").alias("subroot"), F.col("digest").alias("root"), empty.alias("befores"), empty.alias("afters"))
    blocks = _joined(layers, start)

    def step(batch: pa.RecordBatch):
        out: dict[str, list] = {n: [] for n in ("tree", "subroot", "root", "befores", "afters")}
        roots = batch.column("root").to_pylist()
        for row, leaves, paths in _blocks_of(batch):
            for name, digest, path in zip(leaves.field("name").to_pylist(), leaves.field("digest").to_pylist(), paths):
                for column, value in zip(out.values(), (name, digest, roots[row], [b for b, _ in path], [a for _, a in path])):
                    column.append(value)
        kinds = {"tree": pa.string(), "subroot": pa.binary(), "root": pa.binary()}
        yield record_batch(**{n: pa.array(v, kinds.get(n, pa.list_(pa.binary()))) for n, v in out.items()})

    return store(map_batches(blocks, step, f"tree string, subroot binary, root binary, {_PATH}"))


def _leaf_blocks(docs: DataFrame) -> DataFrame:
    tree = F.when(F.col("lang").isNull(), F.lit("")).otherwise(F.concat(F.lit("="), F.col("lang").cast("string")))
    altered = F.col("altered__") if "altered__" in docs.columns else F.lit(None).cast("binary")
    leaves = docs.select(tree.alias("tree"), "doc_id", leaf_digest(docs).alias("digest"), altered.alias("altered"))
    layers = grown(placed(store(leaves), "doc_id", "digest", "altered"), "doc_id", "altered")
    return _joined(layers, _language_paths(tops(layers)))


def manifest(docs: DataFrame) -> DataFrame:
    """doc_id, leaf, subroot, root and the witness (befores, afters, level by level) of every row."""
    kind = docs.schema["doc_id"].dataType.simpleString()

    def step(batch: pa.RecordBatch):
        fixed = {n: batch.column(n).to_pylist() for n in ("subroot", "root")}
        for row, leaves, paths in _blocks_of(batch):
            yield record_batch(doc_id=leaves.field("doc_id"), leaf=leaves.field("digest"),
                               **{n: pa.array([v[row]] * len(leaves), pa.binary()) for n, v in fixed.items()},
                               befores=pa.array([[b for b, _ in p] for p in paths], pa.list_(pa.binary())), afters=pa.array([[a for _, a in p] for p in paths], pa.list_(pa.binary())))

    return map_batches(_leaf_blocks(docs), step, f"doc_id {kind}, leaf binary, subroot binary, root binary, {_PATH}")


def folded(leaf: bytes, path: list[tuple[bytes, bytes]]) -> bytes:
    """Root that a leaf and its witness lead to."""
    for before, after in path:
        leaf = hashed(before, leaf, after)
    return leaf


def verified(docs: DataFrame) -> DataFrame:
    """doc_id, leaf, subroot, root, proof_sha256 (digest of the witness), folded_root and verified of every
    row, digests as hex text.

    folded_root is recomputed from the row's witness and its leaf, or the digest in the binary column
    `altered__` of `docs` where that column is there and not NULL; verified says whether it is the root.
    """
    kind = docs.schema["doc_id"].dataType.simpleString()

    def step(batch: pa.RecordBatch):
        fixed = {n: [x.hex() for x in batch.column(n).to_pylist()] for n in ("subroot", "root")}
        for row, leaves, paths in _blocks_of(batch):
            digests, altered = (leaves.field(n).to_pylist() for n in ("digest", "altered"))
            yield record_batch(doc_id=leaves.field("doc_id"), leaf=[d.hex() for d in digests], **{n: [v[row]] * len(leaves) for n, v in fixed.items()},
                               proof_sha256=[hashed(*[x for pair in p for x in pair]).hex() for p in paths],
                               folded_root=[folded(d if a is None else a, p).hex() for d, a, p in zip(digests, altered, paths)])

    out = map_batches(_leaf_blocks(docs), step, f"doc_id {kind}, leaf string, subroot string, root string, proof_sha256 string, folded_root string")
    return out.withColumn("verified", F.col("folded_root") == F.col("root"))


def tampered(docs: DataFrame, modulus: int = 3) -> DataFrame:
    """`docs` with `altered__`: where `modulus` divides the crc32 of the id as text, the digest of the row
    with A-Z of its text in lower case. A NULL id is never altered."""
    lowered = leaf_digest(docs, F.translate(docs["text"].cast("string"), UPPER, LOWER))
    chosen = F.crc32(docs["doc_id"].cast("string").cast("binary")) % modulus == 0
    return docs.withColumn("altered__", F.when(chosen, lowered))
