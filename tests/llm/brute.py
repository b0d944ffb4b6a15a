"""Plain versions of the operators, over rows in memory."""

from __future__ import annotations

import hashlib
import math
import re
import zlib
from collections import Counter

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
WORD = re.compile(r"[^\x20\x09-\x0D]+")
ALNUM = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words(text, kind=WORD):
    return kind.findall((text or "").translate(LOWER))


def repeats(rows, size=100):
    """(doc_id, n_bytes, n_removed, n_spans, sha256) of rows (doc_id, text)."""
    seen, out = set(), []
    for doc_id, text in sorted(rows, key=lambda r: (r[0] is None, r[0] or 0)):
        data = (text or "").encode()
        gone = bytearray(len(data))
        for p in range(len(data) - size + 1):
            part = data[p : p + size]
            if part in seen:
                gone[p : p + size] = b"\1" * size
            seen.add(part)
        spans = sum(1 for k, g in enumerate(gone) if g and (not k or not gone[k - 1]))
        left = bytes(c for c, g in zip(data, gone) if not g)
        out.append((doc_id, len(data), sum(gone), spans, hashlib.sha256(left).hexdigest()))
    return out


def base_scores(rows):
    """doc_id: (held_out, n_tokens, n_known, train_tokens, base_score)."""
    held = {i: zlib.crc32(str(i).encode()) % 10 == 0 for i, _ in rows}
    seen = Counter()
    for i, text in rows:
        if not held[i]:
            seen.update([*words(text), None])
    total, distinct = sum(seen.values()), len(seen)
    out = {}
    for i, text in rows:
        tokens = [*words(text), None]
        base = sum(math.log10((seen[t] + 0.1) / (total + 0.1 * (distinct + 1))) for t in tokens)
        out[i] = (held[i], len(tokens), sum(seen[t] > 0 for t in tokens), total, base)
    return out


def shingles(text, size=2):
    w = words(text)
    if len(w) < size:
        return frozenset([tuple(w)] if w else [])
    return frozenset(tuple(w[i : i + size]) for i in range(len(w) - size + 1))


def groups(ids, links):
    """id: least id it reaches."""
    root = {i: i for i in ids}

    def find(x):
        while root[x] != x:
            root[x] = root[root[x]]
            x = root[x]
        return x

    for a, b in links:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    return {i: find(i) for i in ids}


def near(rows, percent=80, size=2):
    """doc_id: (n_shingles, component_id); ids must differ."""
    sets = {i: shingles(t, size) for i, t in rows}
    ids = sorted(sets)
    links = []
    for k, a in enumerate(ids):
        for b in ids[k + 1 :]:
            both = len(sets[a] & sets[b])
            if both and 100 * both >= percent * len(sets[a] | sets[b]):
                links.append((a, b))
    found = groups(ids, links)
    return {i: (len(sets[i]), found[i]) for i in ids}


def contaminated(rows, items, size=13):
    """doc_id: (n_words, n_hit, n_items, sha256, contaminated)."""
    windows = {}
    for item, text in items:
        w = words(text, ALNUM)
        n = min(size, len(w))
        for k in range(len(w) - n + 1 if n else 0):
            windows.setdefault(tuple(w[k : k + n]), set()).add(item)
    out = {}
    for doc_id, text in rows:
        w = words(text, ALNUM)
        hit, named = set(), set()
        for n in {len(k) for k in windows}:
            for k in range(len(w) - n + 1):
                if tuple(w[k : k + n]) in windows:
                    hit.update(range(k, k + n))
                    named |= windows[tuple(w[k : k + n])]
        named.discard(None)
        told = hashlib.sha256(",".join(sorted(map(str, named))).encode()).hexdigest()
        out[doc_id] = (len(w), len(hit), len(named), told, bool(hit) and 20 * len(hit) >= len(w))
    return out


def mix_targets(sizes, weights=(5, 2, 1), share=1.5, most=2.0):
    """source: target, of source: size; the excess of full sources is shared again."""
    names = sorted((n for n in sizes if n is not None)) + [None] * (None in sizes)
    weight = {n: weights[k % len(weights)] for k, n in enumerate(names)}
    target, left = {}, set(names)
    while left:
        rest = share * sum(sizes.values()) - sum(target.values())
        unit = rest / sum(weight[n] for n in left)
        full = {n for n in left if unit * weight[n] > most * sizes[n]}
        if not full:
            return target | {n: unit * weight[n] for n in left}
        target |= {n: most * sizes[n] for n in full}
        left -= full
    return target
