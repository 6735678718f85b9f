"""Plain, slow versions of the operators."""

import heapq
import re
from collections import Counter, defaultdict
from math import log

WORDS = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def words(text):
    return WORDS.findall(text or "")


def repeats(rows, window):
    """{position in rows: (number of words, number removed, kept text)}; rows of (id, text), ids may be None."""
    rank = lambda i: float("inf") if i is None else i
    first = {}
    for i, text in rows:
        w = words(text)
        for k in range(len(w) - window + 1):
            g = tuple(w[k : k + window])
            first[g] = min(first.get(g, float("inf")), rank(i))
    out = {}
    for place, (i, text) in enumerate(rows):
        w = words(text)
        gone = set()
        for k in range(len(w) - window + 1):
            if first[tuple(w[k : k + window])] < rank(i):
                gone.update(range(k, k + window))
        out[place] = (len(w), len(gone), " ".join(x for k, x in enumerate(w) if k not in gone))
    return out


def shingles(text, size):
    w = words((text or "").translate(LOWER))
    if len(w) < size:
        return frozenset([tuple(w)] if w else [])
    return frozenset(tuple(w[k : k + size]) for k in range(len(w) - size + 1))


def linked_components(rows, size, num, den):
    """{id: smallest id reachable}; rows of (id, text) with ids."""
    sets = [(i, shingles(t, size)) for i, t in rows]
    parent = {i: i for i, _ in rows}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, (i, x) in enumerate(sets):
        for j, y in sets[:a]:
            if x and y and den * len(x & y) >= num * len(x | y):
                p, q = find(i), find(j)
                parent[max(p, q)] = min(p, q)
    return {i: find(i) for i in parent}


def sainte_lague(votes, seats):
    """Seats per party by repeatedly giving one to the highest quotient; ties go to the earlier party."""
    heap = [(-v, k, 0) for k, v in enumerate(votes) if v > 0]
    heapq.heapify(heap)
    got = [0] * len(votes)
    for _ in range(seats if heap else 0):
        _, k, s = heapq.heappop(heap)
        got[k] += 1
        heapq.heappush(heap, (-votes[k] / (2 * (s + 1) + 1), k, s + 1))
    return got


def tiling(item, text, shortest):
    """Words of ``item`` under tiles, by trying every pair of starts for each tile."""
    free_i, free_t = [True] * len(item), [True] * len(text)
    shortest, covered = min(shortest, len(item)), 0
    while True:
        best = (0, 0, 0)
        for p in range(len(item)):
            for t in range(len(text)):
                n = 0
                while p + n < len(item) and t + n < len(text) and item[p + n] == text[t + n] and free_i[p + n] and free_t[t + n]:
                    n += 1
                if n > best[0]:
                    best = (n, p, t)
        n, p, t = best
        if n < max(shortest, 1):
            return covered
        covered += n
        free_i[p : p + n] = [False] * n
        free_t[t : t + n] = [False] * n


def backoff(texts, order, alpha, least):
    counts = Counter()
    split = [words(t) for t in texts]
    total = sum(map(len, split))
    for w in split:
        for n in range(1, order + 1):
            counts.update(tuple(w[k : k + n]) for k in range(len(w) - n + 1))

    def score(gram):
        if len(gram) == 1:
            return log(counts[gram] / total)
        if counts[gram] >= least:
            return log(counts[gram] / counts[gram[:-1]])
        return log(alpha) + score(gram[1:])

    return [sum(score(tuple(w[max(0, k - order + 1) : k + 1])) for k in range(len(w))) for w in split]


def dice(a, b):
    def grams(text):
        w = re.findall(r"[^\W_]+", text.lower())
        return set(zip(w, w[1:]))

    x, y = grams(a), grams(b)
    return 2 * len(x & y) / (len(x) + len(y)) if x and y else 0.0


def maximal_chats(turns):
    """{id: tuple of (role, text)} of conversations that no longer one starts with, smallest id of equal ones."""
    by = defaultdict(set)
    for c, t, r, x in turns:
        by[c].add((-1 if t is None else t, "unknown" if r is None else r, x or ""))
    chats = {c: tuple((r, x) for _, r, x in sorted(v)) for c, v in by.items()}
    first = {}
    for c in sorted(chats, key=lambda c: (c is None, c or 0)):
        first.setdefault(chats[c], c)
    return {c: chat for chat, c in first.items() if not any(len(o) > len(chat) and o[: len(chat)] == chat for o in first)}
