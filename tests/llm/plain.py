"""Plain Python versions of the operators, for small tables."""

from __future__ import annotations

import collections
import math
import re

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
WORDS = re.compile(r"[^\x20\x09-\x0D]+")


class Union:
    def __init__(self, items):
        self.up = {i: i for i in items}

    def top(self, a):
        while self.up[a] != a:
            self.up[a] = self.up[self.up[a]]
            a = self.up[a]
        return a

    def join(self, a, b):
        a, b = sorted((self.top(a), self.top(b)))
        self.up[b] = a


def shingles(text, width):
    words = WORDS.findall((text or "").translate(LOWER))
    if len(words) < width:
        return frozenset([tuple(words)]) if words else frozenset()
    return frozenset(zip(*[words[k:] for k in range(width)]))


def linked(sets: dict, percent: int = 80) -> Union:
    """Components of sets by Jaccard similarity, by a prefix-filtered exact join."""
    out = Union(sets)
    freq = collections.Counter(g for s in sets.values() for g in s)
    where = collections.defaultdict(list)
    for r in sorted(sets, key=lambda r: len(sets[r])):
        s = sets[r]
        near = set()
        for g in sorted(s, key=lambda g: (freq[g], g))[: len(s) - math.ceil(percent * len(s) / 100) + 1]:
            near.update(where[g])
            where[g].append(r)
        for c in near:
            common = len(s & sets[c])
            if common and 100 * common >= percent * (len(s) + len(sets[c]) - common):
                out.join(r, c)
    return out


def near_duplicates(docs: list[tuple], width: int) -> dict:
    sets = {i: shingles(t, width) for i, t in docs}
    parts = linked(sets)
    return {i: (len(sets[i]), parts.top(i)) for i in sets}


def repeated_lines(docs: list[tuple], width: int = 5) -> set:
    """``doc_id, line_no, first_doc_id, first_line_no`` of lines that repeat earlier ones."""
    first, where = {}, {}
    for d, text in sorted((d, t or "") for d, t in docs):
        for i, line in enumerate(text.split("\n")):
            line = line.translate(LOWER)
            if line.strip(" \t\n\x0b\x0c\r"):
                first.setdefault(line, (d, i))
                where[d, i] = line
    names = {at: line for line, at in first.items()}
    sets = {
        at: frozenset(x[i : i + width] for i in range(len(x) - width + 1)) if len(x) >= width else frozenset([x])
        for at, x in names.items()
    }
    parts = linked(sets)
    top = {at: parts.top(at) for at in names}
    return {(*p, *top[first[x]]) for p, x in where.items() if top[first[x]] != p}


def quality_statistics(text) -> list[float]:
    """The sixteen statistics of a text, one definition at a time."""
    data = (text or "").encode()
    words = re.findall(rb"[^\x20\x09-\x0D]+", data)
    n, some = len(words), max(len(words), 1)
    sizes = [len(w) for w in words]
    mean = sum(sizes) / some
    spread = math.sqrt(max(sum(s * s for s in sizes) / some - mean * mean, 0))
    count = lambda members: sum(data.count(bytes([b])) for b in members)
    upper, lower, high = count(range(65, 91)), count(range(97, 123)), count(range(128, 256))
    letters, size = max(upper + lower + high, 1), max(sum(sizes), 1)
    runs = {tuple(words[i : i + 4]) for i in range(n - 3)} if n >= 4 else {tuple(words)} if words else set()
    possible = max(n - 3, 1)
    shares = [
        sum(s > 14 for s in sizes) / some, upper / letters, count(range(48, 58)) / size, high / size,
        count(b".?;:") / some, count(b",") / some, count(b"!") / some, count(b"|") / some,
        count(b"#$%&*+/<=>@[\\]^_`{}~") / some, count(b"\n") / some,
        sum(a == b for a, b in zip(words, words[1:])) / some,
    ]
    return [
        math.log1p(n), math.log1p(mean), math.log1p(spread), *map(math.sqrt, shares),
        math.log1p(len(set(words))) / math.log1p(some), math.sqrt(max(possible - len(runs), 0) / possible),
    ]


def discriminant(x, y, shrink: float, sphere: float, slope: float):
    """Scores of rows by two normal densities with shrunk covariances, by solving, not by factors."""
    import numpy as np

    x, classes = np.asarray(x), []
    groups = [x[np.asarray(y) == c] for c in (0, 1)]
    pooled = sum(np.cov(g.T, bias=True) * len(g) for g in groups) / sum(map(len, groups))
    for g in groups:
        cov = (1 - shrink) * np.cov(g.T, bias=True) + shrink * pooled
        cov = (1 - sphere) * cov + sphere * np.trace(pooled) / len(cov) * np.eye(len(cov))
        classes.append((g.mean(axis=0), cov))

    def score(row):
        density = []
        for mean, cov in classes:
            off = np.asarray(row) - mean
            density.append(-0.5 * (off @ np.linalg.solve(cov, off) + np.linalg.slogdet(cov)[1]))
        odds = slope * (density[1] - density[0]) + math.log(len(groups[1]) / len(groups[0]))
        return 1 / (1 + math.exp(-max(-500.0, min(500.0, odds))))

    return score
