"""Plain versions of what the operators compute, for small inputs."""

from __future__ import annotations

import hashlib
import re
from collections import Counter

UPPER = {c: c + 32 for c in range(65, 91)}
BLANKS = re.compile(r"[^\x20\x09-\x0D]+")


def words(text):
    return BLANKS.findall(text or "")


def shingles(text, n):
    w = words((text or "").translate(UPPER))
    if not w:
        return set()
    return {tuple(w)} if len(w) < n else {tuple(w[i : i + n]) for i in range(len(w) - n + 1)}


def components(rows, n, percent):
    """[(id, size, component)] for (id, text) rows, by comparing every pair."""
    sets = [shingles(text, n) for _, text in rows]
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if sets[i] and sets[j] and 100 * both >= percent * len(sets[i] | sets[j]):
                root[find(i)] = find(j)
    lowest = {}
    for i, (key, _) in enumerate(rows):
        if key is not None:
            lowest[find(i)] = min(key, lowest.get(find(i), key))
    return [(key, len(sets[i]), lowest.get(find(i)) if sets[i] else key) for i, (key, _) in enumerate(rows)]


def base_metrics(text):
    text = text or ""
    w = words(text)
    windows = [tuple(w[i : i + 8]) for i in range(len(w) - 7)]
    count = Counter(windows)
    covered = set()
    for i, window in enumerate(windows):
        if count[window] > 1:
            covered.update(range(i, i + 8))
    lines = [line for line in text.split("\n") if words(line)]
    return (
        len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)), len(covered)
    )


def item_words(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(UPPER))


def contamination(text, items, span=10):
    """(n_words, n_hit, items' digest, number of items) of a text against (id, text) items."""
    w = item_words(text)
    hit, found = set(), set()
    places = {}
    for i in range(len(w)):
        places.setdefault(w[i], []).append(i)
    for key, item in items:
        v = item_words(item)
        size = min(span, len(v))
        for k in range(len(v) - size + 1 if v else 0):
            window = v[k : k + size]
            for at in places.get(window[0], []):
                if w[at : at + size] == window:
                    hit.update(range(at, at + size))
                    found.add(str(key))
    joined = ",".join(sorted(found))
    return len(w), len(hit), len(found), hashlib.sha256(joined.encode()).hexdigest()
