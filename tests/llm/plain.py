"""Plain versions of the operators, to compare with."""

import re
from collections import Counter, defaultdict

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def words(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(LOWER))


def without_repeats(rows, size=20):
    """{doc_id: (n_words, n_removed, kept)} of rows with different ids; null first."""
    seen, out = set(), {}
    for doc_id, text in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0)):
        own = re.findall(r"[^\x20\x09-\x0D]+", text or "")
        gone = [False] * len(own)
        for p in range(len(own) - size + 1):
            window = tuple(own[p : p + size])
            if window in seen:
                gone[p : p + size] = [True] * size
            seen.add(window)
        out[doc_id] = (len(own), sum(gone), " ".join(w for w, g in zip(own, gone) if not g))
    return out


def bag(text, size=5):
    own = words(text)
    return Counter(tuple(own[i : i + size]) for i in range(len(own) - size + 1)) if len(own) >= size else Counter([tuple(own)] if own else [])


def probability_jaccard(x, y):
    keys = set(x) | set(y)
    return sum(1 / sum(max(x[e] / x[d], y[e] / y[d]) for e in keys) for d in x if d in y)


class Classes:
    def __init__(self, nodes):
        self.up = {n: n for n in nodes}

    def find(self, n):
        while self.up[n] != n:
            n = self.up[n]
        return n

    def join(self, a, b):
        a, b = sorted((self.find(a), self.find(b)))
        self.up[b] = a


def near_classes(rows, similarity=0.8):
    """{doc_id: least doc_id of its class}."""
    bags = {i: bag(t) for i, t in rows}
    texts = dict(rows)
    classes = Classes(bags)
    holders = defaultdict(list)
    for i, own in bags.items():
        for s in own:
            holders[s].append(i)
    pairs = {(a, b) for own in holders.values() for a in own for b in own if a < b}
    for a, b in pairs:
        if sum((bags[a] & bags[b]).values()) and probability_jaccard(bags[a], bags[b]) >= similarity - 1e-12:
            classes.join(a, b)
    first = {}
    for i in sorted(texts):
        classes.join(first.setdefault(texts[i] or "", i), i)
    return {i: classes.find(i) for i in bags}


def contamination(rows, items, size=10):
    """{doc_id: (n_words, n_hit, items)}."""
    windows = defaultdict(set)
    for item, text in items:
        own = words(text)
        k = min(size, len(own))
        for p in range(len(own) - k + 1 if k else 0):
            windows[tuple(own[p : p + k])].add(item)
    sizes = {len(w) for w in windows}
    out = {}
    for doc_id, text in rows:
        own = words(text)
        hit, found = set(), set()
        for k in sizes:
            for p in range(len(own) - k + 1):
                if (w := tuple(own[p : p + k])) in windows:
                    hit.update(range(p, p + k))
                    found |= windows[w]
        out[doc_id] = (len(own), len(hit), sorted(str(i) for i in found if i is not None))
    return out
