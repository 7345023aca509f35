"""Plain-Python versions of the operators, written from their contracts alone."""

import hashlib
import re

ALNUM = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
BLACK = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def decontaminated(docs, items, window=10):
    """docs, items: (id, text) pairs -> {(id, n_words, n_hit, n_items, sha)} as a sorted list."""
    by = {}
    for item, text in items:
        words = ALNUM.findall((text or "").translate(LOWER))
        n = min(window, len(words))
        for i in range(len(words) - n + 1) if n else ():
            by.setdefault(n, {}).setdefault(tuple(words[i : i + n]), set()).add(str(item))
    out = []
    for doc, text in docs:
        words, hit, found = ALNUM.findall((text or "").translate(LOWER)), set(), set()
        for n, windows in by.items():
            for i in range(len(words) - n + 1):
                if own := windows.get(tuple(words[i : i + n])):
                    hit |= set(range(i, i + n))
                    found |= own
        out.append((doc, len(words), len(hit), len(found), hashlib.sha256(",".join(sorted(found)).encode()).hexdigest(), bool(hit)))
    return sorted(out)


def shingles(text, k=5):
    words = BLACK.findall((text or "").translate(LOWER))
    return {tuple(words[i : i + k]) for i in range(len(words) - k + 1)} if len(words) >= k else {tuple(words)} - {()}


def components(nodes, edges):
    top = {x: x for x in nodes}

    def find(x):
        while top[x] != x:
            top[x] = top[top[x]]
            x = top[x]
        return x

    for a, b in edges:
        a, b = find(a), find(b)
        top[max(a, b)] = min(a, b)
    return {x: find(x) for x in nodes}


def neardup(docs):
    sets = {doc: shingles(text) for doc, text in docs}
    by = {}
    for doc, s in sets.items():
        for x in s:
            by.setdefault(x, []).append(doc)
    pairs = {(a, b) for group in by.values() for i, a in enumerate(group) for b in group[i + 1 :]}
    edges = [(a, b) for a, b in pairs if 100 * len(sets[a] & sets[b]) >= 75 * len(sets[a] | sets[b])]
    of = components(sets, edges)
    return sorted((doc, len(sets[doc]), of[doc]) for doc in sets)
