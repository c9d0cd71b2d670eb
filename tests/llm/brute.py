"""Plain versions of the similarity operators, quadratic where need be."""

from __future__ import annotations

from collections import defaultdict

BLANKS = " \t\n\x0b\f\r"


def components(n, linked):
    """Smallest reachable index of each of ``range(n)``."""
    up = list(range(n))

    def find(i):
        while up[i] != i:
            i = up[i]
        return i

    for i in range(n):
        for j in range(i):
            if linked(i, j):
                a, b = find(i), find(j)
                up[max(a, b)] = min(a, b)
    return [find(i) for i in range(n)]


def word_set(text, lower=True):
    raw = (text or "").encode()
    words = (raw.lower() if lower else raw).split()
    n = min(5, len(words))
    return {tuple(words[i:i + n]) for i in range(len(words) - n + 1)} if words else set()


def jaccard_components(rows):
    """``{id: (set size, component)}`` for ``(id, text)`` rows with different ids."""
    rows = sorted(rows)
    sets = [word_set(t) for _, t in rows]

    def linked(i, j):
        both = len(sets[i] & sets[j])
        return bool(sets[i] and sets[j]) and 100 * both >= 80 * (len(sets[i]) + len(sets[j]) - both)

    return {rows[i][0]: (len(sets[i]), rows[c][0]) for i, c in enumerate(components(len(rows), linked))}


def dedup_lines(rows):
    """``{id: (text, lines, dropped)}`` for ``(id, text)`` rows with different ids."""
    first = {}
    for i, text in sorted(rows):
        for k, line in enumerate((text or "").split("\n")):
            if line.strip(BLANKS):
                first.setdefault(line.strip(BLANKS), (i, k))
    lines = sorted(first, key=first.get)
    sets = [{x[i:i + 12] for i in range(max(1, len(x) - 11))} for x in lines]
    by = dict(zip(lines, components(len(lines), lambda i, j: min(len(sets[i]), len(sets[j])) > 1 and len(sets[i] & sets[j]) >= 0.8 * len(sets[i] | sets[j])), strict=True))
    out = {}
    for i, text in rows:
        kept, n, gone = [], 0, 0
        for k, line in enumerate((text or "").split("\n")):
            s = line.strip(BLANKS)
            n += bool(s)
            if s and first[lines[by[s]]] != (i, k):
                gone += 1
            else:
                kept.append(line)
        out[i] = (None if text is None else "\n".join(kept), n, gone)
    return out


def contained(rows, items, threshold=0.8):
    """``{(id, item): (set size, shared)}``."""
    sets = {k: word_set(t.lower() if t else t) for k, t in items}
    out = {}
    for i, text in rows:
        mine = word_set(text.lower() if text else text)
        words = (text or "").lower().encode().split()
        for n in range(1, 5):  # items of fewer than five words are one run
            mine |= {tuple(words[i:i + n]) for i in range(len(words) - n + 1)}
        for k, s in sets.items():
            if s and len(mine & s) >= threshold * len(s) - 1e-9:
                out[i, k] = (len(s), len(mine & s))
    return out


def repeated_words(rows, min_words):
    """``{id: (words in repeats, words in removable repeats)}``, as sets of word numbers."""
    seen = defaultdict(list)
    for i, text in sorted(rows):
        words = (text or "").encode().split()
        for k in range(len(words) - min_words + 1):
            seen[tuple(words[k:k + min_words])].append((i, k))
    every, removable = defaultdict(set), defaultdict(set)
    for places in seen.values():
        if len(places) > 1:
            for i, k in places:
                every[i].update(range(k, k + min_words))
                if (i, k) != min(places):
                    removable[i].update(range(k, k + min_words))
    return every, removable
