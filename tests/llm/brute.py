"""Plain versions of the operators, for small inputs."""

from __future__ import annotations

import hashlib
import re

SPACES = re.compile(r"[^\x20\x09-\x0D]+")
PLAIN = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOWER = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})


def sha(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


def repeats(docs, window=50):
    words = [(d, SPACES.findall(t or "")) for d, t in docs]
    late = lambda d: (d is None, d or 0)
    first: dict[tuple, object] = {}
    for d, w in sorted(words, key=lambda x: late(x[0])):
        for j in range(len(w) - window + 1):
            first.setdefault(tuple(w[j : j + window]), d)
    out = []
    for d, w in words:
        gone = [False] * len(w)
        for j in range(len(w) - window + 1):
            if late(first[tuple(w[j : j + window])]) < late(d):
                gone[j : j + window] = [True] * window
        out.append((d, len(w), sum(gone), " ".join(x for x, g in zip(w, gone) if not g)))
    return out


def leaks(docs, items, width=10):
    words = lambda t: PLAIN.findall((t or "").translate(LOWER))
    windows: dict[tuple, set] = {}
    for i, t in items:
        w = words(t)
        n = min(width, len(w))
        for j in range(len(w) - n + 1 if n else 0):
            windows.setdefault(tuple(w[j : j + n]), set()).add("" if i is None else str(i))
    out = []
    for d, t in docs:
        w, found = words(t), set()
        hit = [False] * len(w)
        for n in {len(k) for k in windows}:
            for j in range(len(w) - n + 1):
                owners = windows.get(tuple(w[j : j + n]))
                if owners:
                    found |= owners
                    hit[j : j + n] = [True] * n
        out.append((d, len(w), sum(hit), sorted(found)))
    return out


def shingles(text, width=5):
    w = SPACES.findall((text or "").translate(LOWER))
    if not w:
        return frozenset()
    n = min(width, len(w))
    return frozenset(tuple(w[j : j + n]) for j in range(len(w) - n + 1))


def similar(docs, percent=80):
    sets = {d: shingles(t) for d, t in docs}
    parent = {d: d for d in sets}

    def top(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a in sets:
        for b in sets:
            both = len(sets[a] & sets[b])
            if a < b and sets[a] and 100 * both >= percent * len(sets[a] | sets[b]) and top(a) != top(b):
                parent[max(top(a), top(b))] = min(top(a), top(b))
    return {d: (len(sets[d]), top(d)) for d in sets}
