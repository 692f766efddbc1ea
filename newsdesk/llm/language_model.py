"""Word n-gram model by deleted interpolation, trained on the corpus and applied to it.

P(word | previous) = a * c(previous, word) / c(previous) + b * c(word) / N + c / (V + 1). The weights
depend on the bucket of c(previous) (its power of two) and are learned by expectation-maximisation on
held-out counts: a share of the training text is left out of the counts it is predicted with.

Counts never pass through a table of tokens. Documents are dealt to blocks of bounded size; a block
sends its distinct n-gram keys, sorted and packed, to the shards of the key space, each with its count in
the training text and what of it lies in the held-out runs. A shard adds up the counts of all blocks and
answers each block in the order it was asked. A block then keeps the counts of its tokens, packed, and
the counts that its held-out tokens are predicted from; the weights are learned from the latter, and the
former are scored with them. There are at most as many rows from a block to the shards as it has keys.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from newsdesk.llm import textbatch as tb
from newsdesk.llm.common import map_batches, record_batch, remainder, text_of
from newsdesk.session import store

FOLDS, TEST_FOLD = 5, 1
#: Bytes of text in a block, and of text whose keys a shard holds.
BLOCK_BYTES, SHARD_BYTES = 5_000_000, 10_000_000
#: Bytes of text a task gathers by block before it packs them.
GATHERED_BYTES = 64_000_000
#: Share of the training text held out for the weights, at every size, and the tokens of a run drawn as one.
HELD, RUN = 0.2, 1000
BUCKETS, ROUNDS, TOLERANCE = 40, 100, 1e-4
END, START = (tb.mix(np.array([n], np.uint64))[0] for n in (0xE4D, 0x57A27))


def tokens_of(words: tb.Words) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(document, token key, bigram key) of all tokens: the words of each document, then its end."""
    counts = words.counts
    doc = np.repeat(np.arange(len(counts)), counts + 1)
    ends = np.cumsum(counts + 1) - 1
    key = np.empty(len(doc), np.uint64)
    is_word = np.ones(len(doc), bool)
    is_word[ends] = False
    key[is_word], key[ends] = words.hashes, END
    before = np.empty_like(key)
    before[1:] = key[:-1]
    before[np.concatenate([[0], ends[:-1] + 1]).astype(np.int64) if len(ends) else []] = START
    return doc, key, tb.mix(tb.mix(before) + key)


def _planes(numbers: np.ndarray) -> bytes:
    """64-bit numbers byte plane by byte plane, compressed: the planes of high bytes nearly vanish."""
    planes = numbers.view(np.uint8).reshape(-1, 8).T.tobytes()
    return len(numbers).to_bytes(8, "little") + pa.compress(planes, codec="zstd", asbytes=True)


def _numbers(packed: bytes) -> np.ndarray:
    n = int.from_bytes(packed[:8], "little")
    planes = np.frombuffer(pa.decompress(packed[8:], decompressed_size=8 * n, codec="zstd", asbytes=True) if n else b"", np.uint8)
    return np.ascontiguousarray(planes.reshape(8, -1).T).view(np.uint64).reshape(-1)


def pack(keys: np.ndarray) -> bytes:
    """Ascending keys as differences."""
    return _planes(np.diff(keys, prepend=np.uint64(0)))


def unpack(packed: bytes) -> np.ndarray:
    return np.cumsum(_numbers(packed))


def pack_counts(counts: np.ndarray) -> bytes:
    return _planes(counts.astype(np.uint64))


def unpack_counts(packed: bytes) -> np.ndarray:
    return _numbers(packed).view(np.int64)


def shard_of(keys: np.ndarray, shards: int) -> np.ndarray:
    """The shard of each key: equal ranges of the key space, so ascending keys have ascending shards."""
    return ((keys >> np.uint64(32)) * np.uint64(shards) >> np.uint64(32)).astype(np.int64)


class Block:
    """Tokens of a block's documents and their distinct keys (words, bigrams, the start), ascending.

    `token`, `bigram` and `before` are the places of every token, of its bigram and of what comes before it
    among the keys; `train` says whether its document is one to learn from, `held` whether it is held out.
    """

    def __init__(self, table: pa.Table):
        names = table.column("key").to_numpy().view(np.uint64)
        train = ~table.column("held_out").to_numpy(zero_copy_only=False)
        sizes, token, bigram, held = [], [], [], []
        for row, words in tb.pieces(table.column("text"), lower=True):
            _, t, b = tokens_of(words)
            sizes.append(words.counts + 1)
            token.append(t)
            bigram.append(b)
            held.append(held_out(names[row : row + len(words.counts)], words.counts))
        self.sizes = np.concatenate(sizes)
        self.train = np.repeat(train, self.sizes)
        self.held = np.concatenate(held) & self.train
        n, self.texts = len(self.train), int(train.sum())
        self.keys, places = np.unique(np.concatenate([[START], *token, *bigram]).astype(np.uint64), return_inverse=True)
        self.start, self.token, self.bigram = places[0], places[1 : n + 1], places[n + 1 :]
        self.before = np.concatenate([[self.start], self.token[:-1]])
        self.before[np.cumsum(self.sizes) - self.sizes] = self.start

    def counts(self) -> dict[str, np.ndarray]:
        """Of every key: its training tokens (`whole`), those in held-out runs (`held`), the held-out tokens
        that come after it (`led`); and whether it is a word (`word`)."""
        many = len(self.keys)
        count = lambda *chosen: sum(np.bincount(places, minlength=many) for places in chosen)
        whole = count(self.token[self.train], self.bigram[self.train])
        whole[self.start] += self.texts
        word = np.zeros(many, np.int64)
        word[self.token] = 1
        return {"whole": whole, "held": count(self.token[self.held], self.bigram[self.held]), "led": count(self.before[self.held]), "word": word}


def bucket_of(context: np.ndarray) -> np.ndarray:
    return np.minimum(np.log2(np.maximum(context, 1)).astype(np.int64), BUCKETS - 1)


def learn_weights(stored: DataFrame, total: int, vocabulary: int) -> np.ndarray:
    """Weights (bigram, unigram, uniform) per bucket, from the packed counts pair, context, single of held-out
    tokens and how many times each comes (`times`), a row per block.

    Expectation-maximisation from equal weights until no weight moves by more than TOLERANCE, ROUNDS
    rounds at most. A bucket without held-out tokens takes the weights of the next one below it that has
    some, or above it. A context that was never seen has no bigram estimate and gives its share to the
    others. A round is one pass over the stored counts whose tasks return three sums per bucket.
    """
    uniform = 1.0 / (vocabulary + 1)

    def sums(weights: np.ndarray) -> np.ndarray:
        """Shares of the three parts and tokens, a row per bucket."""

        def step(batches):
            out = np.zeros((4, BUCKETS))
            for batch in batches:
                for row in zip(*[batch.column(n).to_pylist() for n in ("pair", "context", "single", "times")]):
                    pair, context, single, times = (unpack_counts(x) for x in row)
                    at = bucket_of(context)
                    parts = (np.where(context > 0, pair / np.maximum(context, 1), 0.0), single / max(total, 1), uniform)
                    shares = [weights[at, i] * p for i, p in enumerate(parts)]
                    scale = times / (shares[0] + shares[1] + shares[2])
                    for i in range(3):
                        out[i] += np.bincount(at, shares[i] * scale, BUCKETS)
                    out[3] += np.bincount(at, times, BUCKETS)
            yield record_batch(**{f"s{i}": pa.array([out[i]], pa.list_(pa.float64())) for i in range(4)})

        found = stored.select("pair", "context", "single", "times").mapInArrow(step, ", ".join(f"s{i} array<double>" for i in range(4))).collect()
        return np.sum([np.array(list(r)).T for r in found], axis=0) if found else np.zeros((BUCKETS, 4))

    weights = np.full((BUCKETS, 3), 1 / 3)
    for _ in range(ROUNDS):
        found = sums(weights)
        some = np.flatnonzero(found[:, 3])
        if not len(some):
            return weights
        moved = found[some, :3] / found[some, 3:]
        far = np.abs(moved - weights[some]).max()
        weights[some] = moved
        if far < TOLERANCE:
            break
    for b in np.setdiff1d(np.arange(BUCKETS), some):
        below = some[some < b]
        weights[b] = weights[below[-1] if len(below) else some[0]]
    weights = np.maximum(weights, 1e-9)
    return weights / weights.sum(1, keepdims=True)


def log10_probabilities(pair, context, single, total, vocabulary, weights) -> np.ndarray:
    w = weights[bucket_of(context)]
    lost = np.where(context > 0, 1.0, 1.0 - w[:, 0])
    p = np.where(context > 0, w[:, 0] * pair / np.maximum(context, 1), 0.0) + w[:, 1] * single / max(total, 1) + w[:, 2] / (vocabulary + 1)
    return np.log10(p / lost)


def held_out(keys: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Whether each token is held out: HELD of the runs of RUN tokens, drawn by document key and run."""
    sizes = counts + 1
    place = np.arange(sizes.sum()) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    drawn = tb.mix(np.repeat(tb.mix(keys), sizes) + (place // RUN).astype(np.uint64))
    return (drawn >> np.uint64(32)) < np.uint64(int(HELD * (1 << 32)))


def score(docs: DataFrame, keep: tuple[str, ...] = ("doc_id",), folds: int = FOLDS, test_fold: int = TEST_FOLD) -> DataFrame:
    """The columns `keep` of `docs`, then held_out, n_tokens, n_known, train_tokens, base_score and score.

    Documents whose crc32(doc_id as text) mod `folds` is `test_fold` are never learned from. A NULL or
    empty text is one token, the end. Rows that repeat an id are counted and scored each. Without
    training documents every token is unknown and N and V are 0. Other columns are not read.
    """
    kept = {c: f"k__{i}" for i, c in enumerate(keep)}
    kinds = {f.name: f.dataType.simpleString() for f in docs.schema}
    texts = docs.select(*[F.col(c).alias(k) for c, k in kept.items()], text_of(docs).alias("text"), F.xxhash64("doc_id", "text").alias("key"),
                        (remainder(docs["doc_id"], folds) == test_fold).alias("held_out"))
    sizes = texts.agg(F.sum(F.octet_length("text")).alias("all")).first()
    blocks = max(1, math.ceil((sizes["all"] or 0) / BLOCK_BYTES))
    shards = max(1, math.ceil((sizes["all"] or 0) / SHARD_BYTES))
    dealt = _dealt(texts.withColumn("block", F.pmod(F.xxhash64(F.lit("block"), "key"), F.lit(blocks)).cast("int"))).repartition(blocks, "block")
    asked = dealt.groupBy("block").applyInArrow(lambda table: _ask(table, shards), f"block int, shard int, {_SENT}")
    answers = asked.groupBy("shard").applyInArrow(_answer, f"block int, shard int, {_SENT}").repartition(blocks, "block")
    own = ", ".join(f"{k} array<{kinds[c]}>" for c, k in kept.items())
    lists = {**{k: pa.list_(to_arrow_type(docs.schema[c].dataType)) for c, k in kept.items()}, "held_out": pa.list_(pa.bool_())}
    counted = dealt.groupBy("block").cogroup(answers.groupBy("block")).applyInArrow(
        lambda mine, found: _counted(mine, found, lists),
        f"{own}, held_out array<boolean>, sizes binary, tokens binary, pairs binary, start bigint, pair binary, context binary, single binary, times binary, total bigint, rest bigint, vocabulary bigint")
    counted = store(counted)

    row = counted.agg(*[F.sum(n).alias(n) for n in ("total", "rest", "vocabulary")]).first()
    total, rest, vocabulary = (row[n] or 0 for n in ("total", "rest", "vocabulary"))
    weights = learn_weights(counted.filter("sizes IS NOT NULL"), rest, vocabulary)

    def apply(batch: pa.RecordBatch):
        for row in range(batch.num_rows):
            sizes, single, pair = (unpack_counts(batch.column(n)[row].as_py()) for n in ("sizes", "tokens", "pairs"))
            doc = np.repeat(np.arange(len(sizes)), sizes)
            context = np.concatenate([[0], single[:-1]])
            context[np.cumsum(sizes) - sizes] = batch.column("start")[row].as_py()
            base = np.log10((single + 0.5) / (total + 0.5 * (vocabulary + 1)))
            logs = log10_probabilities(pair, context, single, total, vocabulary, weights)
            n = len(sizes)
            yield record_batch(**{k: batch.column(k)[row].values for k in [*kept.values(), "held_out"]}, n_tokens=sizes, n_known=np.bincount(doc, single > 0, n).astype(np.int64),
                               train_tokens=np.full(n, total, np.int64), base_score=np.bincount(doc, base, n), score=np.bincount(doc, logs, n))

    schema = ", ".join([*[f"{k} {kinds[c]}" for c, k in kept.items()], "held_out boolean, n_tokens bigint, n_known bigint, train_tokens bigint, base_score double, score double"])
    scored = counted.filter("sizes IS NOT NULL").select(*kept.values(), "held_out", "sizes", "tokens", "pairs", "start")
    return map_batches(scored, apply, schema).withColumnsRenamed({k: c for c, k in kept.items()})


_SENT = "keys binary, whole binary, held binary, led binary, word binary"


def _sent(rows: list[tuple]) -> pa.Table:
    columns = list(zip(*rows)) or [[]] * 7
    kinds = (pa.int32(), pa.int32(), *[pa.binary()] * 5)
    return pa.table({n: pa.array(c, k) for n, c, k in zip(("block", "shard", "keys", "whole", "held", "led", "word"), columns, kinds)})


def _dealt(texts: DataFrame) -> DataFrame:
    """(block, body): the rows of `texts` by block; a task packs what it has of a block."""
    texts.sparkSession.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "1000")

    def run(batches):
        held: dict[int, list[pa.RecordBatch]] = {}
        size = 0

        def packed():
            for block, parts in held.items():
                sink = pa.BufferOutputStream()
                with pa.ipc.new_stream(sink, parts[0].schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as out:
                    out.write_table(pa.Table.from_batches(parts).combine_chunks())
                yield record_batch(block=pa.array([block], pa.int32()), body=pa.array([sink.getvalue().to_pybytes()], pa.binary()))

        for batch in batches:
            order = np.argsort(batch.column("block").to_numpy(), kind="stable")
            batch = batch.take(pa.array(order))
            block = batch.column("block").to_numpy()
            edges = np.flatnonzero(np.append(True, block[1:] != block[:-1])) if len(block) else []
            for a, b in zip(edges, [*edges[1:], len(block)]):
                held.setdefault(int(block[a]), []).append(batch.slice(a, b - a))
            size += batch.nbytes
            if size >= GATHERED_BYTES:
                yield from packed()
                held, size = {}, 0
        yield from packed()

    return texts.mapInArrow(run, "block int, body binary")


def _opened(table: pa.Table) -> pa.Table:
    return pa.concat_tables([pa.ipc.open_stream(body.as_buffer()).read_all() for body in table.column("body")]).combine_chunks()


def _ask(table: pa.Table, shards: int) -> pa.Table:
    """The keys of a block with their counts, a row per shard that they fall into."""
    mine = Block(_opened(table))
    counts = mine.counts()
    edges = np.searchsorted(shard_of(mine.keys, shards), np.arange(shards + 1))
    block = table.column("block")[0].as_py()
    return _sent([(block, s, pack(mine.keys[a:b]), *[pack_counts(counts[n][a:b]) for n in ("whole", "held", "led", "word")]) for s, (a, b) in enumerate(zip(edges, edges[1:])) if b > a])


def _answer(table: pa.Table) -> pa.Table:
    """The counts of all blocks for the keys that each asked for; and, as the row of block -1, the shard's
    training tokens, those outside the held-out runs, and its distinct words (in `keys`, `whole`, `held`)."""
    keys = [unpack(k) for k in table.column("keys").to_pylist()]
    unique, back = np.unique(np.concatenate(keys), return_inverse=True)
    sums = {n: np.bincount(back, np.concatenate([unpack_counts(c) for c in table.column(n).to_pylist()]), len(unique)).astype(np.int64) for n in ("whole", "held", "led", "word")}
    shard, at, out = table.column("shard")[0].as_py(), 0, []
    nothing = pack_counts(np.zeros(0, np.int64))
    for block, k in zip(table.column("block").to_pylist(), keys):
        mine = back[at : at + len(k)]
        at += len(k)
        out.append((block, shard, nothing, *[pack_counts(sums[n][mine]) for n in ("whole", "held", "led")], nothing))
    word = sums["word"] > 0
    figures = (sums["whole"][word].sum(), (sums["whole"] - sums["held"])[word].sum(), int((sums["whole"][word] > 0).sum()))
    out.append((-1, shard, *[pack_counts(np.array([f])) for f in figures], nothing, nothing))
    return _sent(out)


def _counted(table: pa.Table, answers: pa.Table, lists: dict[str, pa.DataType]) -> pa.Table:
    """One row for a block: its documents' columns, their numbers of tokens, the counts of every token and
    bigram, and the counts its held-out tokens are predicted from; or the sums of the shards' figures."""
    names = ("sizes", "tokens", "pairs", "pair", "context", "single", "times")
    figures = ("total", "rest", "vocabulary")
    if table.num_rows:
        rows = _opened(table)
        mine = Block(rows)
        ordered = sorted(zip(answers.column("shard").to_pylist(), *[answers.column(n).to_pylist() for n in ("whole", "held", "led")]))
        whole, held, led = (np.concatenate([unpack_counts(r[i]) for r in ordered]) for i in (1, 2, 3))
        out = mine.held
        triple = ((whole - held)[mine.bigram[out]], (whole - led)[mine.before[out]], (whole - held)[mine.token[out]])
        code = np.zeros(int(out.sum()), np.uint64)
        for part in triple:
            code = tb.mix(code + part.astype(np.uint64))
        _, first, times = np.unique(code, return_index=True, return_counts=True)
        values = [pack_counts(x) for x in (mine.sizes, whole[mine.token], whole[mine.bigram], *[part[first] for part in triple], times)]
        start, sums = int(whole[mine.start]), [0, 0, 0]
        listed = {n: pa.ListArray.from_arrays([0, rows.num_rows], rows.column(n).combine_chunks()) for n in lists}
    else:
        values, start = [None] * len(names), 0
        sums = [int(sum(unpack_counts(x)[0] for x in answers.column(c).to_pylist())) for c in ("keys", "whole", "held")]
        listed = {n: pa.nulls(1, kind) for n, kind in lists.items()}
    own = {n: pa.array([v], pa.binary()) for n, v in zip(names, values)}
    return pa.table({**listed, **{n: own[n] for n in names[:3]}, "start": pa.array([start], pa.int64()), **{n: own[n] for n in names[3:]},
                     **{n: pa.array([v], pa.int64()) for n, v in zip(figures, sums)}})
