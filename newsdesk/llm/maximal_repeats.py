"""Exact substring dedup by the interval tree of common prefixes over a sparse suffix array.

Every string of LENGTH bytes has one anchor: the seed of SEED bytes inside it with the smallest hash,
the first of equals. Equal strings have equal anchors at equal offsets, so suffixes that begin at
anchors are enough. They are dealt out by seed. Within a seed the suffix array of the distinct contexts
is built and its common-prefix intervals are found with a stack; inside an interval the occurrences
that also share a left context long enough form a maximal repeat group with all its occurrences.

Equal contexts are counted before any bytes move. A seed with more than GROUP distinct contexts is cut
by the place of the string relative to the seed, which adds to the shared bytes that name a group,
until the groups are small or the shared bytes are the whole string: nothing is capped.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from newsdesk.llm import textbatch as tb
from newsdesk.llm.common import map_batches, record_batch, shelter, text_of
from newsdesk.session import store

LENGTH = 200
SEED = 40
GROUP = 512
#: Ranges of string starts relative to the seed that one group covers, level by level.
CUTS = (40, 10, 3, 1)


def sliding_min(values: np.ndarray, width: int) -> np.ndarray:
    """Least of every `width` consecutive values, by doubling."""
    span = 1
    while 2 * span <= width:
        values = np.minimum(values[:-span], values[span:])
        span *= 2
    return np.minimum(values[: len(values) - (width - span)], values[width - span :]) if span < width else values


def anchors_of(data: np.ndarray, offsets: np.ndarray, length: int = LENGTH, seed: int = SEED) -> dict[str, np.ndarray]:
    """Anchors of all strings of `length` bytes inside the documents of a buffer, in order.

    row: document; position: of the seed in it; left: bytes from the first string to the seed; right:
    bytes from the seed to the end of the last string; seed and context hash.
    """
    width = length - seed + 1
    sizes = np.diff(offsets)
    if len(data) < length:
        return {k: np.zeros(0, np.int64) for k in ("row", "position", "left", "right", "seed", "context")}
    sums = tb.prefix_sums(data)
    n = len(data) - seed + 1
    hashes = tb.mix((sums[seed:] - sums[:-seed]) * tb.power("down", n)[:n])
    keys = ((hashes >> np.uint64(32)) << np.uint64(32)) | np.arange(n, dtype=np.uint64)
    at = (sliding_min(keys, width) & np.uint64(0xFFFFFFFF)).astype(np.int64)  # anchor of the string that starts at i
    inside = np.zeros(len(at) + 1, np.int64)
    long = sizes >= length
    np.add.at(inside, offsets[:-1][long], 1)
    np.add.at(inside, np.minimum(offsets[1:][long] - length + 1, len(at)), -1)
    starts = np.flatnonzero(np.cumsum(inside[:-1]) > 0)
    anchor = at[starts]
    new = np.ones(len(starts), bool)
    new[1:] = anchor[1:] != anchor[:-1]
    first = np.flatnonzero(new)
    last = np.concatenate([first[1:], [len(starts)]]) - 1
    spot, low, high = anchor[first], starts[first], starts[last] + length
    row = np.searchsorted(offsets, spot, "right") - 1
    context = tb.mix(tb.span_hashes(sums, low, high) + (spot - low).astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
    return {"row": row, "position": spot - offsets[row], "left": spot - low, "right": high - spot, "seed": hashes[spot], "context": context}


def _batches(texts: pa.Array):
    """(first row, bytes, offsets) in slices of about a piece."""
    data, offsets = tb.buffers(texts)
    row = 0
    while row < len(offsets) - 1:
        stop = max(row + 1, int(np.searchsorted(offsets, offsets[row] + tb.PIECE, "right")) - 1)
        yield row, data[offsets[row] : offsets[stop]], offsets[row : stop + 1] - offsets[row]
        row = stop


def anchors(docs: DataFrame) -> DataFrame:
    """(seed, context, key, position, left, right) of every anchor of (key, text) rows."""
    def step(batch: pa.RecordBatch):
        keys = batch.column("key")
        for row, data, offsets in _batches(batch.column("text")):
            a = anchors_of(data, offsets)
            if len(a["row"]):
                yield record_batch(seed=a["seed"].view(np.int64), context=a["context"].view(np.int64), key=keys.take(pa.array(a["row"] + row)),
                                   position=a["position"].astype(np.int32), left=a["left"].astype(np.int16), right=a["right"].astype(np.int16))

    return map_batches(docs, step, "seed bigint, context bigint, key bigint, position int, left smallint, right smallint")


def _contexts(docs: DataFrame) -> DataFrame:
    """(seed, context, left, body) for the anchors asked for in the column `wanted` of (key, text, wanted)."""
    def step(batch: pa.RecordBatch):
        out: dict[str, list] = {"seed": [], "context": [], "left": [], "body": []}
        for text, wanted in zip(batch.column("text"), batch.column("wanted")):
            if wanted.is_valid:
                raw = text.as_py().encode()
                for w in wanted.as_py():
                    p, left = w["position"], w["left"]
                    for name, value in (("seed", w["seed"]), ("context", w["context"]), ("left", left), ("body", raw[p - left : p + w["right"]])):
                        out[name].append(value)
        yield record_batch(seed=pa.array(out["seed"], pa.int64()), context=pa.array(out["context"], pa.int64()), left=pa.array(out["left"], pa.int16()), body=pa.array(out["body"], pa.binary()))

    return map_batches(docs, step, "seed bigint, context bigint, left smallint, body binary")


def common_prefix(a: bytes, b: bytes) -> int:
    n = min(len(a), len(b))
    different = int.from_bytes(a[:n], "big") ^ int.from_bytes(b[:n], "big")
    return n - (different.bit_length() + 7) // 8


def repeat_groups(bodies: list[bytes], lefts: list[int], length: int = LENGTH) -> tuple[list[list[tuple[int, int]]], list[tuple[int, int, list[int]]]]:
    """Repeats among distinct contexts that share the seed at offset `lefts[i]` of `bodies[i]`.

    Returns the spans, relative to the seed, that each context shares with any other and that are at
    least `length` long, and the maximal repeat groups (left, right, members).
    """
    n = len(bodies)
    right = [body[at:] for body, at in zip(bodies, lefts)]
    left = [body[:at][::-1] for body, at in zip(bodies, lefts)]
    array = sorted(range(n), key=right.__getitem__)
    prefix = [0] + [common_prefix(right[array[i - 1]], right[array[i]]) for i in range(1, n)]
    by_left = sorted(range(n), key=left.__getitem__)
    left_rank = [0] * n
    for rank, i in enumerate(by_left):
        left_rank[i] = rank
    spans: list[list[tuple[int, int]]] = [[] for _ in range(n)]
    groups: list[tuple[int, int, list[int]]] = []

    def close(common: int, low: int, high: int) -> None:
        """The interval array[low:high] shares `common` bytes to the right."""
        members = sorted(array[low:high], key=left_rank.__getitem__)
        shared = [common_prefix(left[a], left[b]) for a, b in zip(members, members[1:])]
        start = 0
        for k, member in enumerate(members):
            most = max(shared[k - 1] if k else -1, shared[k] if k < len(shared) else -1)
            if most + common >= length:
                spans[member].append((-most, common))
            if k == len(shared) or shared[k] + common < length:
                if k > start:
                    # Occurrences that all share the left context; the interval is right-diverse, and
                    # the least common left extension is left-diverse.
                    groups.append((min(shared[start:k]), common, members[start : k + 1]))
                start = k + 1

    stack: list[tuple[int, int]] = []
    for i in range(1, n + 1):
        now, low = (prefix[i] if i < n else -1), i - 1
        while stack and stack[-1][0] > now:
            common, low = stack.pop()
            close(common, low, i)
        if now >= 0 and (not stack or stack[-1][0] < now):
            stack.append((now, low))
    return spans, groups


def merged(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for a, b in sorted(spans):
        if out and a <= out[-1][1]:
            out[-1] = (out[-1][0], max(out[-1][1], b))
        else:
            out.append((a, b))
    return out


SPANS = "array<struct<a:int,b:int>>"


def _grouped_spans(rows: DataFrame) -> DataFrame:
    """(grp, part, spans) for (grp, part, left, body) rows of small groups, one row per distinct part."""
    gathered = rows.groupBy("grp").agg(F.collect_list(F.struct("part", "left", "body")).alias("parts"))

    def step(batch: pa.RecordBatch):
        out: dict[str, list] = {"grp": [], "part": [], "spans": []}
        for grp, parts in zip(batch.column("grp").to_pylist(), batch.column("parts")):
            parts = parts.as_py()
            spans, _ = repeat_groups([p["body"] for p in parts], [p["left"] for p in parts])
            for p, s in zip(parts, spans):
                if s:
                    out["grp"].append(grp)
                    out["part"].append(p["part"])
                    out["spans"].append([{"a": a, "b": b} for a, b in merged(s)])
        kind = pa.list_(pa.struct([("a", pa.int32()), ("b", pa.int32())]))
        yield record_batch(grp=pa.array(out["grp"], pa.int64()), part=pa.array(out["part"], pa.int64()), spans=pa.array(out["spans"], kind))

    return map_batches(gathered, step, f"grp bigint, part bigint, spans {SPANS}")


def _cut(rows: DataFrame, width: int) -> DataFrame:
    """Rows (seed, context, left, body) dealt to finer groups: for every range of `width` string
    starts that the context holds, the group named by the bytes all those strings share (`grp`) and
    the bytes they lie in (`part`, `p_left`, `p_body`)."""
    starts = LENGTH - SEED + 1

    def step(batch: pa.RecordBatch):
        out: dict[str, list] = {k: [] for k in ("seed", "context", "left", "body", "grp", "part", "p_left", "p_body")}
        for row in batch.to_pylist():
            left, body = row["left"], row["body"]
            right = len(body) - left
            for a in range(0, starts, width):
                b = min(a + width, starts) - 1  # strings begin a … b bytes before the seed
                low, high = max(a, LENGTH - right), min(b, left)
                if low > high:
                    continue
                core = body[left - a : left + LENGTH - b] if left >= a else b""
                part = body[left - high : left + LENGTH - low]
                out["grp"].append(_digest(core, row["seed"], a))
                out["part"].append(_digest(part, high, a))
                out["p_left"].append(high)
                out["p_body"].append(part)
                for name in ("seed", "context", "left", "body"):
                    out[name].append(row[name])
        kinds = {"seed": pa.int64(), "context": pa.int64(), "left": pa.int16(), "body": pa.binary(), "grp": pa.int64(), "part": pa.int64(), "p_left": pa.int16(), "p_body": pa.binary()}
        yield record_batch(**{k: pa.array(v, kinds[k]) for k, v in out.items()})

    return map_batches(rows, step, "seed bigint, context bigint, left smallint, body binary, grp bigint, part bigint, p_left smallint, p_body binary")


def _digest(body: bytes, *salt: int) -> int:
    return int.from_bytes(hashlib.blake2b(body, digest_size=8, key=repr(salt).encode()[:64]).digest(), "big", signed=True)


def _whole(part_left: Column, body: Column) -> Column:
    return F.array(F.struct((-part_left).cast("int").alias("a"), (F.length(body) - part_left).cast("int").alias("b")))


def repeated_spans(bodies: DataFrame) -> DataFrame:
    """(seed, context, spans) of the distinct contexts (seed, context, left, body) of each seed: the
    spans relative to the seed that another distinct context of the seed shares, LENGTH or longer."""
    sizes = bodies.groupBy("seed").agg(F.count("*").alias("size"))
    sized = store(bodies.join(store(sizes.filter("size > 1")), "seed"))
    small = sized.filter(F.col("size") <= GROUP).select(F.col("seed").alias("grp"), F.col("context").alias("part"), "left", "body")
    found = [store(_grouped_spans(small)).select(F.col("grp").alias("seed"), F.col("part").alias("context"), "spans")]
    left = sized.filter(F.col("size") > GROUP).select("seed", "context", "left", "body")
    for width in CUTS:
        left = store(left)
        if left.isEmpty():
            break
        cut = store(_cut(left, width))
        parts = cut.groupBy("grp", "part").agg(F.count("*").alias("owners"), F.first("p_left").alias("p_left"), F.first("p_body").alias("p_body"))
        parts = store(parts)
        counts = store(parts.groupBy("grp").agg(F.count("*").alias("size"), F.sum("owners").alias("owners")).filter("owners > 1").select("grp", "size"))
        shared = store(parts.join(counts, "grp"))
        # A part that several contexts hold is repeated as a whole; with one start per group all are.
        equal = shared.filter((F.col("owners") > 1) | (F.lit(width) == 1)).select("grp", "part", _whole(F.col("p_left"), F.col("p_body")).alias("spans"))
        spans = [equal]
        if width > 1:
            several = shared.filter((F.col("size") > 1) & (F.col("size") <= GROUP)).select("grp", "part", F.col("p_left").alias("left"), F.col("p_body").alias("body"))
            spans.append(_grouped_spans(several))
        together = store(spans[0].unionByName(spans[1]) if len(spans) > 1 else spans[0])
        found.append(store(cut.select("seed", "context", "grp", "part").join(together, ["grp", "part"]).select("seed", "context", "spans")))
        if width > 1:
            crowded = counts.filter(F.col("size") > GROUP).select("grp")
            left = cut.join(crowded, "grp", "left_semi").select("seed", "context", "left", "body").distinct()
    out = found[0]
    for more in found[1:]:
        out = out.unionByName(more)
    return out


def _stripped(rows: DataFrame, kind: str) -> DataFrame:
    """Rows (key, text, spans) without the bytes of their spans."""
    def step(batch: pa.RecordBatch):
        out: dict[str, list] = {"key": [], "n_removed": [], "n_spans": [], "kept": [], "removed": []}
        for key, text, spans in zip(batch.column("key").to_pylist(), batch.column("text"), batch.column("spans")):
            raw, cuts = text.as_py().encode(), merged([(s["a"], s["b"]) for s in spans.as_py()])
            kept, at = [], 0
            for a, b in cuts:
                kept.append(raw[at:a])
                at = b
            out["key"].append(key)
            out["n_removed"].append(sum(b - a for a, b in cuts))
            out["n_spans"].append(len(cuts))
            out["kept"].append(b"".join([*kept, raw[at:]]))
            out["removed"].append([{"a": a, "b": b} for a, b in cuts])
        spans_kind = pa.list_(pa.struct([("a", pa.int32()), ("b", pa.int32())]))
        yield record_batch(key=pa.array(out["key"], pa.int64()), n_removed=pa.array(out["n_removed"], pa.int64()), n_spans=pa.array(out["n_spans"], pa.int64()),
                           kept=pa.array(out["kept"], pa.binary()), removed=pa.array(out["removed"], spans_kind))

    return map_batches(rows, step, f"key bigint, n_removed bigint, n_spans bigint, kept binary, removed {SPANS}")


def strip_repeats(docs: DataFrame) -> DataFrame:
    """All columns of `docs`, then n_bytes, n_removed, n_spans, removed (byte spans) and kept_text.

    Removed is every byte inside a string of LENGTH bytes that also starts anywhere else in the table.
    `kept_text` is binary: a cut may fall inside a character. NULL texts are empty; texts under LENGTH
    bytes stay whole; rows that repeat an id and text are repeats of each other.
    """
    clash = {"n_bytes", "n_removed", "n_spans", "removed", "kept_text"}
    inner, restore = shelter(docs.drop(*clash), "doc_id", "text")
    inner = inner.withColumn("key", F.xxhash64("doc_id", "text"))
    found = _removals(inner.select("key", text_of(inner).alias("text")))
    both = inner.join(found, "key", "left")
    raw = text_of(both).cast("binary")
    return both.select(*restore(both), F.length(raw).cast("bigint").alias("n_bytes"), F.coalesce("n_removed", F.lit(0)).alias("n_removed"), F.coalesce("n_spans", F.lit(0)).alias("n_spans"),
                       F.coalesce("removed", F.array().cast(SPANS)).alias("removed"), F.coalesce("kept", raw).alias("kept_text"))


def removal_digests(docs: DataFrame) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans and the SHA-256 of the remaining bytes; texts stay where they are."""
    raw = text_of(docs).cast("binary")
    narrow = docs.select("doc_id", F.xxhash64("doc_id", "text").alias("key"), F.length(raw).cast("bigint").alias("n_bytes"), F.sha2(raw, 256).alias("whole"))
    found = _removals(docs.select(F.xxhash64("doc_id", "text").alias("key"), text_of(docs).alias("text")))
    found = store(found.select("key", "n_removed", "n_spans", F.sha2("kept", 256).alias("sha")))
    return narrow.join(found, "key", "left").select("doc_id", "n_bytes", F.coalesce("n_removed", F.lit(0)).alias("n_removed"), F.coalesce("n_spans", F.lit(0)).alias("n_spans"), F.coalesce("sha", "whole").alias("kept_sha256"))


def _removals(docs: DataFrame) -> DataFrame:
    """(key, n_removed, n_spans, kept, removed) of the documents (key, text) that lose bytes."""
    all_anchors = anchors(docs)
    repeated = store(all_anchors.groupBy("seed").agg(F.count("*").alias("times")).filter("times > 1").select("seed"))
    known = store(all_anchors.join(repeated, "seed"))
    distinct = store(known.groupBy("seed", "context").agg(F.count("*").alias("copies"), F.min(F.struct("key", "position", "left", "right")).alias("one")))
    several = store(distinct.groupBy("seed").agg(F.count("*").alias("contexts")).filter("contexts > 1").select("seed"))
    asked = distinct.join(several, "seed").select("seed", "context", "one.*")
    wanted = asked.groupBy("key").agg(F.collect_list(F.struct("seed", "context", "position", "left", "right")).alias("wanted"))
    keys = known.select("key").distinct()
    texts = store(docs.join(keys.join(wanted, "key", "left"), "key"))
    if not texts.groupBy("key").agg(F.count("*").alias("rows")).filter("rows > 1").isEmpty():
        texts = store(texts.dropDuplicates(["key"]))
    shared = repeated_spans(store(_contexts(texts.filter("wanted IS NOT NULL").select("text", "wanted"))))
    copied = distinct.filter("copies > 1").select("seed", "context", F.array(F.struct((-F.col("one.left")).cast("int").alias("a"), F.col("one.right").cast("int").alias("b"))).alias("spans"))
    spans = copied.unionByName(shared).groupBy("seed", "context").agg(F.flatten(F.collect_list("spans")).alias("spans"))
    placed = known.join(store(spans), ["seed", "context"])
    shifted = F.transform("spans", lambda s: F.struct((F.col("position") + s["a"]).cast("int").alias("a"), (F.col("position") + s["b"]).cast("int").alias("b")))
    removed = placed.select("key", shifted.alias("spans")).groupBy("key").agg(F.flatten(F.collect_set("spans")).alias("spans"))
    return _stripped(texts.select("key", "text").join(removed, "key"), SPANS)


def groups_of(bodies: DataFrame) -> DataFrame:
    """Maximal repeat groups of the distinct contexts (seed, context, left, body) of seeds with at most
    GROUP contexts: (seed, length, left, contexts), one row per group with all its occurrences."""
    gathered = bodies.groupBy("seed").agg(F.collect_list(F.struct("context", "left", "body")).alias("parts")).filter((F.size("parts") > 1) & (F.size("parts") <= GROUP))

    def step(batch: pa.RecordBatch):
        out: dict[str, list] = {"seed": [], "length": [], "left": [], "contexts": []}
        for seed, parts in zip(batch.column("seed").to_pylist(), batch.column("parts")):
            parts = parts.as_py()
            for left, right, members in repeat_groups([p["body"] for p in parts], [p["left"] for p in parts])[1]:
                for name, value in (("seed", seed), ("length", left + right), ("left", left), ("contexts", [parts[m]["context"] for m in members])):
                    out[name].append(value)
        yield record_batch(seed=pa.array(out["seed"], pa.int64()), length=pa.array(out["length"], pa.int64()), left=pa.array(out["left"], pa.int64()), contexts=pa.array(out["contexts"], pa.list_(pa.int64())))

    return map_batches(gathered, step, "seed bigint, length bigint, left bigint, contexts array<bigint>")
