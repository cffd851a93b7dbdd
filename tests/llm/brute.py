"""Plain Python versions of the operators, for small inputs."""

import hashlib
import re
from collections import Counter
from fractions import Fraction

import numpy as np
import xxhash


def lower_ascii(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text or "")


def repeats(texts, length=200):
    """Per text: bytes removed, runs, bytes kept."""
    raw = [(t or "").encode() for t in texts]
    seen = Counter(b[i:i + length] for b in raw for i in range(len(b) - length + 1))
    out = []
    for b in raw:
        hit = np.zeros(len(b) + 1, int)
        for i in range(len(b) - length + 1):
            if seen[b[i:i + length]] > 1:
                hit[i] += 1
                hit[i + length] -= 1
        hit = np.cumsum(hit[:-1]) > 0
        kept = bytes(np.frombuffer(b, np.uint8)[~hit]) if b else b""
        runs = int((np.diff(np.concatenate([[0], hit.astype(int)])) == 1).sum()) if b else 0
        out.append((int(hit.sum()), runs, kept))
    return out


_WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def contamination(texts, items, n=13):
    """Per text: words, hit words, sorted ids of the items found."""
    windows = {}
    for item, text in items:
        w = _WORD.findall(lower_ascii(text))
        size = min(n, len(w))
        for i in range(len(w) - size + 1 if w else 0):
            windows.setdefault(tuple(w[i:i + size]), set()).add(str(item))
    out = []
    for text in texts:
        w = _WORD.findall(lower_ascii(text))
        hit, found = [0] * len(w), set()
        for size in {len(x) for x in windows}:
            for i in range(len(w) - size + 1):
                if ids := windows.get(tuple(w[i:i + size])):
                    found |= ids
                    hit[i:i + size] = [1] * size
        out.append((len(w), sum(hit), sorted(found)))
    return out


def sha(ids):
    return hashlib.sha256(",".join(ids).encode()).hexdigest()


def simhash(text):
    w = re.findall(r"[^\x20\x09-\x0D]+", lower_ascii(text))
    shingles = [" ".join(w[i:i + 3]) for i in range(len(w) - 2)] or ([" ".join(w)] if w else [])
    h = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if sum(x >> b & 1 for x in h) * 2 > len(h))


def components(values, radius=2):
    """Position of a representative of each value's component."""
    parent = list(range(len(values)))

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i, a in enumerate(values):
        for j in range(i):
            if (a ^ values[j]).bit_count() <= radius:
                parent[max(root(i), root(j))] = min(root(i), root(j))
    return [root(i) for i in range(len(values))]


def water(sizes, weights=(3, 1, 2), budget=Fraction(3, 2), epochs=2):
    """Targets of sources given in order, by repeated sharing of the excess."""
    target = [Fraction(0)] * len(sizes)
    left, todo = budget * sum(sizes), set(range(len(sizes)))
    weight = [weights[i % len(weights)] for i in range(len(sizes))]
    while todo:
        total = sum(weight[i] for i in todo)
        full = {i for i in todo if left * weight[i] / total >= epochs * sizes[i]}
        if not full:
            for i in todo:
                target[i] = left * weight[i] / total
            break
        for i in full:
            target[i] = Fraction(epochs * sizes[i])
            left -= target[i]
        todo -= full
    return target


def size(text):
    return len(re.findall(r"[^\x20\x09-\x0D]+", text or ""))
