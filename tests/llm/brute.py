"""Plain versions of the contracts, one row after the other."""

import hashlib
import re
from collections import Counter

SPACE = re.compile(r"[\x20\x09-\x0D]+")
WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = {i: i + 32 for i in range(65, 91)}


def exact(rows):
    """rows: (doc_id, text, ...) -> {doc_id: (keep_id, size, kept, sha)}"""
    groups = {}
    for r in rows:
        groups.setdefault(SPACE.sub("", r[1] or ""), []).append(r)
    out = {}
    for form, members in groups.items():
        keep = min(members, key=lambda r: (-len(r[1] or ""), r[0]))[0]
        for r in members:
            out[r[0]] = (keep, len(members), r[0] == keep, hashlib.sha256(form.encode()).hexdigest())
    return out


def shingles(text, k):
    w = WORD.findall((text or "").translate(LOWER))
    return frozenset(tuple(w[i : i + k]) for i in range(max(1, len(w) - k + 1))) if w else frozenset()


def components(rows, k, per_cent):
    """Compares all pairs of different sets. {doc_id: (set size, smallest reachable id)}"""
    sets = {r[0]: shingles(r[1], k) for r in rows}
    parent = {d: d for d in sets}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    by_set = {}
    for d in sorted(sets):
        if sets[d]:
            first = by_set.setdefault(sets[d], d)
            parent[find(d)] = find(first)
    names = sorted(by_set.values())
    for i, a in enumerate(names):
        for b in names[:i]:
            x, y = sets[a], sets[b]
            if 100 * min(len(x), len(y)) < per_cent * max(len(x), len(y)):
                continue
            shared = len(x & y)
            if 100 * shared >= per_cent * (len(x) + len(y) - shared):
                u, v = sorted((find(a), find(b)))
                parent[v] = u
    return {d: (len(s), find(d)) for d, s in sets.items()}


def rules(text):
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed"""
    text = text or ""
    w = WORD.findall(text)
    windows = [tuple(w[i : i + 8]) for i in range(len(w) - 7)]
    count = Counter(windows)
    inside = {j for i, x in enumerate(windows) if count[x] > 1 for j in range(i, i + 8)}
    lines = [x for x in text.split("\n") if WORD.search(x)]
    return (
        len(w),
        sum(map(len, w)),
        sum(text.count(c) for c in "#*$%&|<>"),
        len(lines) - len(set(lines)),
        len(inside),
        len(w) < 20 or 100 * len(inside) > 30 * len(w),
    )
