"""Plain Python versions of what the operators return."""

import re
from collections import Counter, defaultdict

WORDS = re.compile("[^\x20\x09-\x0D]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def words(text):
    return WORDS.findall((text or "").translate(LOWER))


def shingles(text):
    w = words(text)
    return frozenset(tuple(w[k:k + 5]) for k in range(max(len(w) - 4, 1))) if w else frozenset()


def jaccard(a, b):
    a, b = shingles(a), shingles(b)
    return len(a & b) / len(a | b) if a | b else 1.0


def near_components(rows):
    """component of every row position; rows: (doc_id, text)."""
    sets = [shingles(t) for _, t in rows]
    where = defaultdict(list)
    for i, s in enumerate(sets):
        for x in s:
            where[x].append(i)
    shared = Counter((b, a) for held in where.values() for k, a in enumerate(held) for b in held[:k])
    root = list(range(len(rows)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for (a, b), n in shared.items():
        if 100 * n >= 75 * (len(sets[a]) + len(sets[b]) - n):
            root[find(a)] = find(b)
    members = defaultdict(list)
    for i in range(len(rows)):
        members[find(i)].append(i)
    out = [None] * len(rows)
    for held in members.values():
        ids = [rows[i][0] for i in held if rows[i][0] is not None]
        for i in held:
            out[i] = min(ids) if ids else None
    return out, [len(s) for s in sets]


def without_repeats(texts, length):
    """(n_bytes, n_removed, n_spans, kept) of byte texts."""
    seen = Counter(t[i:i + length] for t in texts for i in range(len(t) - length + 1))
    out = []
    for t in texts:
        gone = bytearray(len(t))
        for i in range(len(t) - length + 1):
            if seen[t[i:i + length]] > 1:
                gone[i:i + length] = b"\x01" * length
        spans = sum(1 for i, g in enumerate(gone) if g and (i == 0 or not gone[i - 1]))
        out.append((len(t), sum(gone), spans, bytes(b for b, g in zip(t, gone) if not g)))
    return out


def water_level(sizes, weights, share, most):
    """Targets by repeated resharing of what the capped leave."""
    budget = share * sum(sizes)
    target, capped = [0.0] * len(sizes), set()
    while len(capped) < len(sizes):
        free = [i for i in range(len(sizes)) if i not in capped]
        level = (budget - sum(most * sizes[i] for i in capped)) / sum(weights[i] for i in free)
        over = {i for i in free if level * weights[i] >= most * sizes[i]}
        for i in free:
            target[i] = level * weights[i]
        if not over:
            break
        capped |= over
    for i in capped:
        target[i] = most * sizes[i]
    return target
