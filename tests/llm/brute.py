"""Plain single-process versions of the operators, for small tables."""
import hashlib
import re
from collections import Counter

WORD = re.compile(rb"[^\x20\x09-\x0D]+")


def words(text):
    return WORD.findall((text or "").encode())


class Union:
    def __init__(self, items):
        self.up = {i: i for i in items}

    def find(self, x):
        while self.up[x] != x:
            self.up[x] = self.up[self.up[x]]
            x = self.up[x]
        return x

    def join(self, a, b):
        a, b = self.find(a), self.find(b)
        if a != b:
            self.up[max(a, b)] = min(a, b)


def components(docs, pct=80, k=5):
    """[(doc_id, text)] -> {doc_id: (set size, component)}."""
    sets = {}
    for i, t in docs:
        w = [x.lower() for x in words(t)]
        sets[i] = {tuple(w[j:j + k]) for j in range(len(w) - k + 1)} if len(w) >= k else ({tuple(w)} if w else set())
    holders, common, u = {}, Counter(), Union(sets)
    for i, s in sets.items():
        for g in s:
            holders.setdefault(g, []).append(i)
    for h in holders.values():
        common.update((a, b) for x, a in enumerate(h) for b in h[x + 1:])
    for (a, b), c in common.items():
        if 100 * c >= pct * (len(sets[a]) + len(sets[b]) - c):
            u.join(a, b)
    return {i: (len(sets[i]), u.find(i)) for i in sets}


def repeats(docs, length=20):
    """[(doc_id, text)] -> {doc_id: (n_words, n_removed, sha256 of kept words)}."""
    seen, out = set(), {}
    for i, t in sorted(docs):
        w = words(t)
        gone = [False] * len(w)
        for j in range(len(w) - length + 1):
            key = tuple(w[j:j + length])
            if key in seen:
                gone[j:j + length] = [True] * length
            seen.add(key)
        kept = [x for x, g in zip(w, gone) if not g]
        out[i] = (len(w), sum(gone), hashlib.sha256(b" ".join(kept)).hexdigest())
    return out
