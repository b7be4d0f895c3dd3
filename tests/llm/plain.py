"""Plain versions of operators, for small inputs."""

import re

import numpy as np
from formspark.llm import decontaminate as D


def shingles(text, k=4):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    w = re.findall(r"[^\x20\x09-\x0D]+", low)
    return {tuple(w[i:i + k]) for i in range(len(w) - k + 1)} if len(w) >= k else {tuple(w)} if w else set()


def groups(rows, k=4, percent=85):
    """(key, set size, smallest key of the component) of every row, from all pairs."""
    sets = [shingles(t, k) for _, t in rows]
    comp = list(range(len(rows)))

    def find(i):
        while comp[i] != i:
            i = comp[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            a, b = sets[i], sets[j]
            if a and b and 100 * len(a & b) >= percent * len(a | b):
                comp[find(i)] = find(j)
    least = {}
    for i, (key, _) in enumerate(rows):
        r = find(i)
        if key is not None and (least.get(r) is None or key < least[r]):
            least[r] = key
    return sorted(((key, len(s), least.get(find(i))) for i, ((key, _), s) in enumerate(zip(rows, sets))), key=str)


def fold(text):
    raw = np.frombuffer((text or "").encode(), np.uint8)
    return D.folded(raw, np.array([0, len(raw)]))[0].tobytes()


def distance(item, text):
    """Edits of the best stretch of text for item."""
    row = np.zeros(len(text) + 1, dtype=np.int64)
    t, index = np.frombuffer(text, np.uint8), np.arange(len(text) + 1)
    for c in item:
        step = row + 1
        step[1:] = np.minimum(step[1:], row[:-1] + (t != c))
        row = np.minimum.accumulate(step - index) + index
    return int(row.min())


def leaks(rows, items):
    """{(key, item): edits} by aligning every item with every text."""
    out = {}
    for key, text in rows:
        for item_id, item in items:
            it = fold(item).strip(b" ")
            if item is not None and len(it) >= D.Q:
                d = distance(it, fold(text))
                if d <= D.budget(len(it)):
                    out[key, item_id] = min(d, out.get((key, item_id), 99))
    return out


def targets(sizes, weights=(5, 2, 1), share=1.5, cap=2):
    """{source: target} by resharing the excess until no source is above its cap."""
    order = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    w = {s: weights[i % len(weights)] for i, s in enumerate(order)}
    left, open_, out = share * sum(sizes.values()), set(order), {}
    while open_:
        level = left / sum(w[s] for s in open_)
        full = {s for s in open_ if level * w[s] > cap * sizes[s]}
        if not full:
            return out | {s: level * w[s] for s in open_}
        for s in full:
            out[s] = cap * sizes[s]
            left -= out[s]
        open_ -= full
    return out
