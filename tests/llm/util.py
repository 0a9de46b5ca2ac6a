"""Small tables and brute-force versions shared by the operator tests."""

import collections
import random
import re

WORD = re.compile(r"[^\x20\x09-\x0D]+")
UP = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
LONG = "one two three four five six seven " * 3000          # a very long text


def words(text):
    return WORD.findall(text or "")


def docs_df(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, text string")


def by_row(rows):
    return sorted((tuple(r) for r in rows), key=lambda r: tuple((x is None, x if x is not None else 0) for x in r))


def families(seed, sizes=(2, 5, 9, 11, 12, 13, 20, 30, 45, 80, 150, 400), n=20):
    """Groups of near copies with random edits, in random order."""
    rng = random.Random(seed)
    voc = [f"v{i}" for i in range(400)]
    out = []
    for _ in range(n):
        base = rng.choices(voc, k=rng.choice(sizes))
        for _ in range(rng.randrange(1, 12)):
            w = list(base)
            for _ in range(rng.choice([0, 0, 1, 1, 2, 3, 6])):
                p = rng.randrange(len(w) + 1)
                w[p:p + rng.randrange(2)] = rng.choices(voc, k=rng.randrange(2))
            out.append(" ".join(w))
    rng.shuffle(out)
    return list(enumerate(out))


def shingle_set(text):
    w = words((text or "").translate(UP))
    return frozenset(tuple(w[k:k + 3]) for k in range(len(w) - 2)) if len(w) >= 3 else frozenset([tuple(w)] if w else [])


def join_brute(rows):
    """(doc_id, n_shingles, component_id) by comparing every pair that shares a shingle."""
    sets = [shingle_set(t) for _, t in rows]
    lists, parent = collections.defaultdict(list), list(range(len(rows)))

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for k, s in enumerate(sets):
        for e in s:
            lists[e].append(k)
    for k, s in enumerate(sets):
        for j, o in collections.Counter(j for e in s for j in lists[e] if j < k).items():
            if 100 * o >= 90 * (len(s) + len(sets[j]) - o):
                parent[root(k)] = root(j)
    groups = collections.defaultdict(list)
    for k in range(len(rows)):
        groups[root(k)].append(rows[k][0])
    return [(i, len(sets[k]), i if not sets[k] else min((x for x in groups[root(k)] if x is not None), default=None)) for k, (i, _) in enumerate(rows)]
