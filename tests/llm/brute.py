"""Plain versions of the operators, for small inputs."""

import collections
import hashlib
import re

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
WORD = re.compile("[^\x20\x09-\x0D]+")
ITEM_WORD = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")


def repeated(rows, size, split, join, within):
    """{id: (symbols, removed, spans, sha of the rest)} of (id, text) in order of id."""
    first, out = {}, {}
    for key, text in sorted(rows):
        symbols = split((text or "").encode())
        n = len(symbols)
        gone = bytearray(n)
        windows = [symbols[k : k + size] for k in range(n - size + 1)]
        for k, w in enumerate(windows):
            w = bytes(w) if isinstance(w, bytes) else tuple(w)
            if within:
                if first.setdefault(w, (key, k)) != (key, k):
                    gone[k : k + size] = b"\1" * size
            elif first.get(w, key) < key:
                gone[k : k + size] = b"\1" * size
        if not within:
            for w in windows:
                first.setdefault(bytes(w), key)
        rest = [s for s, g in zip(symbols, gone) if not g]
        spans = sum(1 for k in range(n) if gone[k] and (k == 0 or not gone[k - 1]))
        out[key] = (n, sum(gone), spans, hashlib.sha256(join(rest)).hexdigest())
    return out


def shingle_sets(rows, size=5):
    out = {}
    for key, text in rows:
        w = WORD.findall((text or "").translate(LOWER))
        out[key] = {tuple(w[k : k + size]) for k in range(max(1, len(w) - size + 1))} if w else set()
    return out


def components(nodes, links):
    up = {n: n for n in nodes}

    def find(x):
        while up[x] != x:
            x = up[x]
        return x

    for a, b in links:
        a, b = find(a), find(b)
        if a != b:
            up[max(a, b)] = min(a, b)
    return {n: find(n) for n in nodes}


def jaccard_components(rows):
    sets = shingle_sets(rows)
    held, links = collections.defaultdict(list), []
    for key, s in sets.items():
        common = collections.Counter(other for g in s for other in held[g])
        links += [(key, o) for o, n in common.items() if 100 * n >= 75 * (len(s) + len(sets[o]) - n)]
        for g in s:
            held[g].append(key)
    return {k: len(s) for k, s in sets.items()}, components(sets, links)


def contamination(rows, items, window=10):
    windows = collections.defaultdict(set)
    for item, text in items:
        w = ITEM_WORD.findall((text or "").translate(LOWER))
        n = min(window, len(w))
        for k in range(len(w) - n + 1 if w else 0):
            windows[tuple(w[k : k + n])].add(str(item))
    lengths = {len(w) for w in windows}
    out = {}
    for key, text in rows:
        w = ITEM_WORD.findall((text or "").translate(LOWER))
        hit, found = set(), set()
        for n in lengths:
            for k in range(len(w) - n + 1):
                if tuple(w[k : k + n]) in windows:
                    hit |= set(range(k, k + n))
                    found |= windows[tuple(w[k : k + n])]
        out[key] = (len(w), len(hit), sorted(found))
    return out
