"""Plain versions of the operators for small tables: dictionaries and loops over whole texts."""

from __future__ import annotations

import hashlib
import math
import re
import zlib
from collections import Counter, defaultdict

from newsdesk.llm import decontaminate

SPLIT = re.compile(r"[^\x20\x09-\x0D]+")


def lower(text: str | None) -> str:
    return re.sub("[A-Z]", lambda m: m[0].lower(), text or "")


def words(text: str | None) -> list[str]:
    return SPLIT.findall(lower(text))


def fold(doc_id, modulus: int) -> int:
    return zlib.crc32(("" if doc_id is None else str(doc_id)).encode()) % modulus


def shingles(text: str | None, n: int) -> frozenset:
    w = words(text)
    if not w:
        return frozenset()
    return frozenset([tuple(w)] if len(w) < n else [tuple(w[i : i + n]) for i in range(len(w) - n + 1)])


def near_duplicates(docs: list[tuple], n: int, percent: int = 80) -> dict:
    """doc_id -> (set size, component id)."""
    sets = {d: shingles(t, n) for d, t in docs}
    component = {d: d for d in sets}

    def root(d):
        while component[d] != d:
            d = component[d]
        return d

    ids = sorted(sets)
    for i, a in enumerate(ids):
        for b in ids[i + 1 :]:
            if sets[a] and sets[b]:
                common = len(sets[a] & sets[b])
                if 100 * common >= percent * (len(sets[a]) + len(sets[b]) - common):
                    x, y = sorted((root(a), root(b)))
                    component[y] = x
    return {d: (len(sets[d]), root(d)) for d in ids}


def repeats(docs: list[tuple], length: int = 200) -> dict:
    """doc_id -> (bytes, removed, runs, sha256 of the rest)."""
    raw = [(d, (t or "").encode()) for d, t in docs]
    times = Counter(b[i : i + length] for _, b in raw for i in range(len(b) - length + 1))
    out = {}
    for d, b in raw:
        gone = bytearray(len(b))
        for i in range(len(b) - length + 1):
            if times[b[i : i + length]] > 1:
                gone[i : i + length] = b"\1" * length
        runs = sum(1 for i, g in enumerate(gone) if g and (i == 0 or not gone[i - 1]))
        out[d] = (len(b), sum(gone), runs, hashlib.sha256(bytes(x for x, g in zip(b, gone) if not g)).hexdigest())
    return out


def base_scores(docs: list[tuple]) -> dict:
    """doc_id -> (held out, tokens, known, N, base score)."""
    tokens = {d: [*words(t), None] for d, t in docs}
    counts = Counter(w for d, ws in tokens.items() if fold(d, 5) != 1 for w in ws)
    n, v = sum(counts.values()), len(counts)
    return {d: (fold(d, 5) == 1, len(ws), sum(counts[w] > 0 for w in ws), n, sum(math.log10((counts[w] + 0.5) / (n + 0.5 * (v + 1))) for w in ws)) for d, ws in tokens.items()}


def bigram_scores(docs: list[tuple], weights, bucket_of) -> dict:
    """doc_id -> log10 probability with the given weights per bucket of the context's count."""
    tokens = {d: [*words(t), None] for d, t in docs}
    single, pair, context = Counter(), Counter(), Counter()
    for d, ws in tokens.items():
        if fold(d, 5) != 1:
            single.update(ws)
            for a, b in zip(["<s>", *ws], ws):
                pair[a, b] += 1
                context[a] += 1
    n, v = sum(single.values()), len(single)
    out = {}
    for d, ws in tokens.items():
        total = 0.0
        for a, b in zip(["<s>", *ws], ws):
            w = weights[bucket_of(context[a])]
            p = w[1] * single[b] / n + w[2] / (v + 1)
            p = p + w[0] * pair[a, b] / context[a] if context[a] else p / (1 - w[0])
            total += math.log10(p)
        out[d] = total
    return out


def line_windows(docs: list[tuple]) -> dict:
    """doc_id -> text without later occurrences of three-line windows."""
    seen, gone = set(), defaultdict(set)
    for d, t in sorted(docs):
        lines = t.split("\n") if t is not None else []
        for i in range(len(lines) - 2):
            w = tuple(lines[i : i + 3])
            if SPLIT.search("".join(w)):
                if w in seen:
                    gone[d] |= {i, i + 1, i + 2}
                seen.add(w)
    return {d: "\n".join(x for i, x in enumerate(t.split("\n")) if i not in gone[d]) if t is not None else None for d, t in docs}


def digest(*parts: str) -> str:
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def manifest(docs: list[tuple], arity: int = 8) -> list[tuple]:
    """(doc_id, leaf, subroot, root, proof digest, folded root) of rows (doc_id, source, lang, n_chars, text)."""

    def leaf(row, text):
        said = lambda v: "-" if v is None else f"{len(str(v).encode())}:{v}"
        return digest(*[said(v) for v in (*row[:4], text)])

    def climb(nodes):
        """Root, and per node its siblings before and after, level by level."""
        paths, below = [[] for _ in nodes], [[i] for i in range(len(nodes))]
        while len(nodes) > 1:
            runs = [range(i, min(i + arity, len(nodes))) for i in range(0, len(nodes), arity)]
            for run in runs:
                for i in run:
                    pair = ([nodes[k] for k in run if k < i], [nodes[k] for k in run if k > i])
                    for n in below[i]:
                        paths[n].append(pair)
            below = [[n for i in run for n in below[i]] for run in runs]
            nodes = [digest(*[nodes[i] for i in run]) for run in runs]
        return nodes[0], paths

    trees = defaultdict(list)
    for row in docs:
        trees[row[2]].append((row, leaf(row, row[4])))
    order = sorted(trees, key=lambda lang: (lang is not None, (lang or "").encode()))
    grown = {}
    for lang, rows in trees.items():
        rows.sort(key=lambda x: (x[0][0] is not None, x[0][0] or 0, x[1]))
        grown[lang] = climb([h for _, h in rows])
    root, tops = climb([grown[lang][0] for lang in order]) if order else (None, [])
    out = []
    for lang, top in zip(order, tops):
        subroot, paths = grown[lang]
        for (row, h), path in zip(trees[lang], paths):
            whole = path + top
            changed = row[0] is not None and zlib.crc32(str(row[0]).encode()) % 3 == 0
            now = leaf(row, lower(row[4]) if row[4] is not None else None) if changed else h
            for before, after in whole:
                now = digest(*before, now, *after)
            out.append((row[0], h, subroot, root, digest(*[x for pair in whole for side in pair for x in side]), now))
    return out


def trigrams(text: str | None) -> Counter:
    """Trigrams of letters with a letter in the middle; "" is a word boundary."""
    out: Counter = Counter()
    for word in "".join(c if c.isalpha() else " " for c in (text or "").lower()).split():
        framed = ["", *word, ""]
        out.update(zip(framed, framed[1:], framed[2:]))
    return out


def language(docs: list[tuple], vector_of) -> dict:
    """doc_id -> (language, cosine) by prototypes of the texts of (doc_id, lang, text) outside the test fold."""
    bundle = lambda text: sum((n * vector_of(t) for t, n in trigrams(text).items()), 0)
    prototypes: dict = {}
    for d, lang, text in docs:
        if fold(d, 4) != 2 and lang is not None and trigrams(text):
            prototypes[lang] = prototypes.get(lang, 0) + bundle(text)
    length = lambda v: math.sqrt((v * v).sum())
    out = {}
    for d, _, text in docs:
        out[d] = ("und", 0.0)
        if trigrams(text) and prototypes:
            mine = bundle(text)
            out[d] = max(((lang, float((mine * p).sum() / length(mine) / length(p))) for lang, p in sorted(prototypes.items())), key=lambda x: x[1])
    return out


def template_tokens(text: str | None) -> list[tuple]:
    """(lower-case value, kind, opening) of the tokens of an ASCII text; a run of names is one value."""
    text, out = text or "", []
    before, line = None, 0
    for m in SPLIT.finditer(text):
        core = re.sub(r"^[^0-9A-Za-z$%]+|[^0-9A-Za-z$%]+$", "", m.group())
        if not core:
            continue
        sentence = before is None or before[-1] in ".!?:" or "\n" in text[line : m.start()]
        before, line = m.group(), m.start()
        digit = re.search(r"\d", core)
        capital = bool(re.fullmatch(r"[A-Z][^A-Z]+", core)) and not digit
        kind, opening = "", False
        if digit and (core[0].isdigit() or not re.search("[A-Za-z]", core)):
            kind = "number"
        elif out and out[-1][1] == "number" and core.lower() in decontaminate.UNITS:
            kind = "unit"
        elif capital and not sentence:
            kind = "name"
        else:
            opening = capital and core.lower() not in decontaminate.OPENERS
        if kind == "name" and out and out[-1][1] == "name":
            out[-1] = (out[-1][0] + " " + core.lower(), "name", False)
        else:
            out.append((core.lower(), kind, opening))
    return out


def template_windows(text: str | None, lengths) -> list[tuple]:
    """(first token, named, window, slots) of every window of the lengths."""
    tokens, out = template_tokens(text), []
    for n in lengths:
        for i in range(len(tokens) - n + 1):
            part = tokens[i : i + n]
            plain, opening = sum(not k for _, k, _ in part), sum(o for *_, o in part)
            if plain >= decontaminate.PLAIN:
                out.append((i, False, ("t", *[k and f"<{k}>" or v for v, k, _ in part]), [v if k else None for v, k, _ in part]))
            else:
                out.append((i, False, ("l", *[v for v, _, _ in part]), [v if k else None for v, k, _ in part]))
            if opening and plain - opening >= decontaminate.PLAIN:
                out.append((i, True, ("n", *["<name>" if o else k and f"<{k}>" or v for v, k, o in part]), [v if k or o else None for v, k, o in part]))
    return out


def template_leaks(docs: list[tuple], items: list[tuple], coverage: float = 0.5) -> dict:
    """(document, item) -> covered tokens, for every pair that reaches `coverage`."""
    out = {}
    for item, asked_text in items:
        size = len(template_tokens(asked_text))
        asked = template_windows(asked_text, [min(size, decontaminate.WINDOW)]) if size >= decontaminate.PLAIN and item is not None else []
        for d, text in docs:
            lines: dict = {}
            for i, named, window, slots in template_windows(text, [min(size, decontaminate.WINDOW)]) if asked else []:
                for at, _, other, values in asked:
                    if window == other:
                        for way in [True] if named else [False, True]:
                            lines.setdefault((i - at, way), []).append((at, list(zip(values, slots))))
            covered = set()
            for found in lines.values():
                pairs = {p for _, ps in found for p in ps if p[0] is not None}
                if len(pairs) == len({a for a, _ in pairs}):
                    covered |= {at + k for at, ps in found for k in range(len(ps))}
            if covered and len(covered) / size >= coverage:
                out[d, item] = len(covered)
    return out
