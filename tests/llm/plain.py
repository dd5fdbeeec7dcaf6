"""Rules of the corpus operators in plain Python, over a few rows."""

import hashlib
import math
import re

SPACE = " \t\n\x0b\x0c\r"
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def words(text):
    return re.findall(rf"[^{SPACE}]+", text or "")


def key(row_id, text):
    return (row_id is None, row_id or 0, hashlib.md5((text or "").encode()).hexdigest())


def exact_kept(rows):
    """Of equal texts the row with the largest id: ``(id, text)``, a null text as an empty one."""
    last = {}
    for i, t, *_ in rows:
        last[t or ""] = max(last.get(t or "", -1), -1 if i is None else i)
    return [(None if i < 0 else i, t) for t, i in last.items()]


def near_components(rows, n, threshold=80):
    """``(id, text, shingles, component)`` of each row, all pairs compared."""
    sets = []
    for i, t, *_ in rows:
        w = [x.translate(LOWER) for x in words(t)]
        sets.append((i, t, {tuple(w)} if 0 < len(w) < n else {tuple(w[k : k + n]) for k in range(len(w) - n + 1)}))
    root = list(range(len(sets)))

    def find(a):
        while root[a] != a:
            a = root[a]
        return a

    for a in range(len(sets)):
        for b in range(a):
            x, y = sets[a][2], sets[b][2]
            if x and y and 100 * len(x & y) >= threshold * len(x | y):
                root[find(a)] = find(b)
    return [(*s, find(k)) for k, s in enumerate(sets)]


def near_kept(rows, n):
    """``(id, text)`` of what stays: the first row of each component, and all rows without words."""
    first, empty = {}, []
    for i, t, shingles, component in near_components(rows, n):
        if not shingles:
            empty.append((i, t or ""))
        elif component not in first or key(i, t) < key(*first[component]):
            first[component] = (i, t)
    return empty + list(first.values())


def noisy_or(weights, text):
    """A document's score from its sentences' odds."""
    clean = 1.0
    for line in [s for s in re.split(r"[.!?\n]", (text or "").lower()) if re.search(r"\w", s)] or [""]:
        odds = weights[""]
        for word in re.findall(r"\w+", line):
            names = ["=" + word] * (len(word) <= 64) + [word[-4:] + "$"] * (len(word) > 4)
            names += ["^" + word[:n] for n in range(3, 7) if len(word) > n]
            odds += sum(weights.get(name, 0.0) for name in names)
        clean *= 1 / (1 + math.exp(min(odds, 700)))
    return 1 - clean


def targets(sizes, most=3):
    """Words by source: weights 1, 2, 3 in order of the name, null last, cut to what a source may give, the rest shared again."""
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: k % 3 + 1 for k, s in enumerate(order)}
    full, total = set(), sum(sizes.values())
    while True:
        rest = total - sum(most * sizes[s] for s in full)
        free = sum(weight[s] for s in order if s not in full)
        found = {s: most * sizes[s] if s in full else rest * weight[s] / free for s in order}
        above = {s for s in order if s not in full and found[s] > most * sizes[s]}
        if not above:
            return found
        full |= above
