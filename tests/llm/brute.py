"""Plain restatements that the operators are held against."""

from __future__ import annotations

import hashlib
import re
from collections import Counter, defaultdict

ALNUM = re.compile(rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def decontaminate(docs, items, size=13):
    windows = defaultdict(set)
    for name, text in items:
        w = ALNUM.findall((text or "").encode().lower())
        if w:
            k = min(size, len(w))
            for j in range(len(w) - k + 1):
                windows[tuple(w[j : j + k])].add(str(name))
    out = []
    for doc_id, text in docs:
        w = ALNUM.findall((text or "").encode().lower())
        hit, found = bytearray(len(w)), set()
        for k in {len(x) for x in windows}:
            for j in range(len(w) - k + 1):
                own = windows.get(tuple(w[j : j + k]))
                if own:
                    found |= own
                    hit[j : j + k] = b"\1" * k
        n = sum(hit)
        out.append((doc_id, len(w), n, len(found), hashlib.sha256(",".join(sorted(found)).encode()).hexdigest(), n > 0 and 20 * n >= len(w)))
    return out


def substrings(docs, size=50):
    first: dict = {}
    for doc_id, text in docs:
        w = (text or "").encode().split()
        if doc_id is not None:
            for j in range(len(w) - size + 1):
                k = tuple(w[j : j + size])
                first[k] = min(first.get(k, doc_id), doc_id)
    out = []
    for doc_id, text in docs:
        w = (text or "").encode().split()
        gone = bytearray(len(w))
        for j in range(len(w) - size + 1):
            if doc_id is not None and first[tuple(w[j : j + size])] < doc_id:
                gone[j : j + size] = b"\1" * size
        out.append((doc_id, len(w), sum(gone), hashlib.sha256(b" ".join(x for x, g in zip(w, gone, strict=True) if not g)).hexdigest()))
    return out


def byte_strings(docs, size=100):
    """docs in the order of doc_id, without repeated rows."""
    seen: set = set()
    out = []
    for doc_id, text in docs:
        data = (text or "").encode()
        gone = bytearray(len(data))
        for j in range(len(data) - size + 1):
            s = data[j : j + size]
            if doc_id is not None and s in seen:
                gone[j : j + size] = b"\1" * size
            elif doc_id is not None:
                seen.add(s)
        kept = bytes(x for x, g in zip(data, gone, strict=True) if not g)
        out.append((doc_id, len(data), sum(gone), len(re.findall(b"\1+", bytes(gone))), hashlib.sha256(kept).hexdigest()))
    return out


def _root(parent, i):
    while parent[i] != i:
        parent[i] = parent[parent[i]]
        i = parent[i]
    return i


def jaccard(docs, percent=90, size=3):
    sets = {}
    for doc_id, text in docs:
        w = (text or "").encode().lower().split()
        sets[doc_id] = frozenset(tuple(w[j : j + size]) for j in range(len(w) - size + 1)) if len(w) >= size else frozenset([tuple(w)] if w else [])
    ids = [i for i in sets if i is not None]
    parent = {i: i for i in ids}
    for n, a in enumerate(ids):
        for b in ids[:n]:
            x, y = sets[a], sets[b]
            if x and y and 100 * min(len(x), len(y)) >= percent * max(len(x), len(y)) and 100 * len(x & y) >= percent * len(x | y):
                p, q = _root(parent, a), _root(parent, b)
                parent[max(p, q)] = min(p, q)
    return {i: (len(sets[i]), None if i is None else _root(parent, i)) for i in sets}


def quality(text):
    text = text or ""
    w = text.encode().split()
    windows = [tuple(w[i : i + 8]) for i in range(len(w) - 7)]
    counts = Counter(windows)
    cover = bytearray(len(w))
    for i, x in enumerate(windows):
        if counts[x] > 1:
            cover[i : i + 8] = b"\1" * 8
    lines = [line for line in text.split("\n") if line.encode().split()]
    return len(w), sum(len(x.decode()) for x in w), sum(text.count(c) for c in "#*$%&|<>"), len(lines) - len(set(lines)), sum(cover)


def fuzzy_lines(docs, percent=80, size=5):
    """doc_id -> numbers of the lines to remove."""
    places = defaultdict(list)
    for doc_id, text in docs:
        for at, line in enumerate((text or "").split("\n") if doc_id is not None else []):
            if line.encode().split():
                places[line].append((doc_id, at))
    keys = list(places)
    sets = [frozenset(k[j : j + size] for j in range(len(k) - size + 1)) or frozenset([k]) for k in keys]
    parent = list(range(len(keys)))
    inverted = defaultdict(list)
    frequency = Counter(s for x in sets for s in x)
    for i in sorted(range(len(keys)), key=lambda i: len(sets[i])):
        order = sorted(sets[i], key=lambda s: (frequency[s], s))
        prefix = order[: len(order) + (-percent * len(order) // 100) + 1]
        for j in {j for s in prefix for j in inverted[s]}:
            both = len(sets[i] & sets[j])
            if 100 * both >= percent * (len(sets[i]) + len(sets[j]) - both):
                parent[_root(parent, i)] = _root(parent, j)
        for s in prefix:
            inverted[s].append(i)
    groups = defaultdict(list)
    for i, key in enumerate(keys):
        groups[_root(parent, i)] += places[key]
    gone = defaultdict(set)
    for members in groups.values():
        first = min(members)
        for doc_id, at in members:
            if (doc_id, at) != first:
                gone[doc_id].add(at)
    return gone


def edit_distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        new = [i]
        for j, y in enumerate(b, 1):
            new.append(min(row[j] + 1, new[-1] + 1, row[j - 1] + (x != y)))
        row = new
    return row[-1]
