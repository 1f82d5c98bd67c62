"""Plain, slow versions of the operators, for small inputs."""

from __future__ import annotations

import hashlib
import math
import re
import zlib
from collections import Counter


def words(text, lower=False):  # noqa: ANN001, ANN201
    raw = (text or "").encode()
    return (raw.lower() if lower else raw).split()


def substring(docs, window):  # noqa: ANN001, ANN201
    """docs: (id, text). (n_words, n_removed, sha256) for each row, in order."""
    first: dict = {}
    for i, t in docs:
        w = words(t)
        if i is not None:
            for p in range(len(w) - window + 1):
                k = tuple(w[p : p + window])
                first[k] = min(first.get(k, i), i)
    out = []
    for i, t in docs:
        w, gone = words(t), set()
        for p in range(len(w) - window + 1):
            if i is not None and first[tuple(w[p : p + window])] < i:
                gone.update(range(p, p + window))
        out.append((i, len(w), len(gone), hashlib.sha256(b" ".join(x for j, x in enumerate(w) if j not in gone)).hexdigest()))
    return out


def shingles(text, k):  # noqa: ANN001, ANN201
    w = words(text, True)
    return frozenset(tuple(w[j : j + k]) for j in range(len(w) - k + 1)) if len(w) >= k else frozenset([tuple(w)] if w else [])


def near(docs, k, percent):  # noqa: ANN001, ANN201
    """(id, n_shingles, component) of each row with an id."""
    known = [(i, shingles(t, k)) for i, t in docs if i is not None]
    parent = {i: i for i, _ in known}

    def root(x):  # noqa: ANN001, ANN202
        while parent[x] != x:
            x = parent[x]
        return x

    for n, (i, a) in enumerate(known):
        for j, b in known[:n]:
            both = len(a & b)
            if a and b and 100 * both >= percent * (len(a) + len(b) - both):
                x, y = root(i), root(j)
                parent[max(x, y)] = min(x, y)
    return [(i, len(s), root(i)) for i, s in known]


def contained(docs, items, k, threshold):  # noqa: ANN001, ANN201
    def cut(t):  # noqa: ANN001, ANN202
        w = [x for x in re.split(r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t)) if x]
        return {tuple(w[j : j + k]) for j in range(len(w) - k + 1)}

    sets = {i: cut(t) for i, t in items if i is not None and t is not None}
    return {(d, i) for d, t in docs if d is not None and t is not None for own in [cut(t)] for i, s in sets.items() if s and len(s & own) >= threshold * len(s) - 1e-9}


def base_scores(docs, modulus=10):  # noqa: ANN001, ANN201
    tokens = [(i, [*words(t, True), None]) for i, t in docs]
    counts: Counter = Counter()
    for i, w in tokens:
        if zlib.crc32(str(i).encode()) % modulus:
            counts.update(w)
    total, floor = sum(counts.values()), 0.0
    floor = math.log10(total + 0.1 * (len(counts) + 1))
    return total, {i: (len(w), sum(counts[x] > 0 for x in w), sum(math.log10(counts[x] + 0.1) - floor for x in w)) for i, w in tokens}


EMAIL = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
IP = re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")


def base_pii(text):  # noqa: ANN001, ANN201
    text, out = text or "", []
    digits = lambda s: re.sub("[^0-9]", "", s)

    def luhn(d):  # noqa: ANN001, ANN202
        return sum(sum(divmod(2 * int(c), 10)) if i % 2 else int(c) for i, c in enumerate(reversed(d))) % 10 == 0

    for k, (name, pattern, ok) in enumerate((
        ("email", EMAIL, lambda s: True), ("ip", IP, lambda s: all(int(x) <= 255 for x in s.split("."))),
        ("card", CARD, lambda s: 14 <= len(digits(s)) <= 19 and luhn(digits(s))), ("phone", PHONE, lambda s: 10 <= len(digits(s)) <= 15),
    )):
        out += [(m.start(), k, f"{name}:{m.start()}:{m.end()}") for m in pattern.finditer(text) if ok(m.group())]
    return [x[2] for x in sorted(out)]


def mixed(model, symbols):  # noqa: ANN001, ANN201
    """log10 probability of a text's symbols, bit by bit, with one bit's arithmetic at a time."""
    from corvid.llm import mixing as m

    mask, limit, size = (1 << 32) - 1, m.LIMIT, m.BUCKETS
    tree, odds, shift = model.head.tree, model.odds[0], model.bits[0]
    weights = [[float(x) for x in w] for w in model.weights[0]]
    tables = [[float(x) for x in t] for t in model.tables[0]]

    def slot(context, node):  # noqa: ANN001, ANN202
        h = ((context ^ (node * 0x9E3779B1 & mask)) * 0x85EBCA6B) & mask
        h ^= h >> 15
        return (h * 0xC2B2AE35 & mask) >> (32 - shift)

    total = 0.0
    for low in range(0, len(symbols), m.BLOCK):
        slope, bend, moved = {}, {}, {}
        for t in range(low, min(low + m.BLOCK, len(symbols))):
            before = symbols[t - 1] + 1 if t > 0 else 0
            before2 = symbols[t - 2] + 1 if t > 1 else 0
            one = (before + 1) * 0x27D4EB2F & mask
            two = (((one ^ (before2 * 0x165667B1 & mask)) * 0x9E3779B1) & mask) ^ 0x5BD1E995
            begin = int(tree.begin[symbols[t]])
            for i in range(int(tree.length[symbols[t]])):
                node, bit, depth = int(tree.path[begin + i]), int(tree.bits[begin + i]), min(i, m.DEPTHS - 1)
                found = [odds[slot(one, node)], odds[slot(two, node) + (1 << shift)]]
                sure = [int(f.view("int32")) & 3 for f in found]
                x = [float(tree.odds[node]), *map(float, found)]
                gate = (depth * 4 + sure[0]) * 4 + sure[1]
                z = min(max(sum(w * v for w, v in zip(weights[gate], x, strict=True)), -limit), limit)
                p = 1 / (1 + math.exp(-z))
                at = (z + limit) * (size - 1) / (2 * limit)
                bucket = min(int(at), size - 2)
                share = at - bucket
                better = tables[depth][bucket] * (1 - share) + tables[depth][bucket + 1] * share
                q = min(max((p + better) / 2, 1e-6), 1 - 1e-6)
                total += math.log10(q if bit else 1 - q)
                for k in range(3):
                    slope[gate, k] = slope.get((gate, k), 0.0) + (bit - p) * x[k]
                    bend[gate, k] = bend.get((gate, k), 0.0) + x[k] ** 2
                n, ones = moved.get((depth, bucket + (share > 0.5)), (0, 0))
                moved[depth, bucket + (share > 0.5)] = (n + 1, ones + bit)
        for (g, k), v in slope.items():
            weights[g][k] += m.RATE * v / (bend[g, k] / 4 + m.INERTIA)
        for (d, b), (n, ones) in moved.items():
            tables[d][b] += m.TABLE_RATE * (ones - n * tables[d][b]) / (1 + m.TABLE_RATE * n)
    return total
