"""Jaccard join of word-shingle sets, size-aware: subsets for small sets, inverted lists for large ones.

A text's set holds the names of its distinct shingles. Two sets link when their similarity reaches
the least one, s: DEN * intersection >= NUM * union (a ``Rule`` holds shingle width and similarity; the default is
3 words and 90 / 100). So at most d = n - ceil(s n) elements of a set of n are
missing in a partner, and with all elements in one global order (rare ones first) two linked
sets share c elements of their first d + c. Small sets (n <= boundary / s) enumerate the subsets
of ``SUBSET`` = 2 elements of that prefix; large sets (n > boundary) stand in the inverted lists of their first
d + 1 elements, which are scanned. The boundary is the size with the least cost over
the whole table's size histogram: subsets made against lists scanned (``SCAN`` each).

The order comes from a fixed-size count sketch of all shingles (``CELLS`` counters); it affects cost alone.

Inside a list, pairs must fit in size and in a parity sketch: bits that each element flips (at 90 / 100 a quarter to half of the
elements, more for a lower similarity, 256 at least; halves of a longer sketch fold onto each other), whose distance is at most the
symmetric difference of the sets, so the test loses no link. Sets of the pairs left are sent
once per list (a pair is checked in one of its lists), compared exactly there, and a
list gives only links that join parts of it (a spanning forest): components are
exact, no group is expanded into all its pairs. Keys that the sketch shows to be in very many sets are
dealt as pairs of blocks of ``BLOCK`` sets, so no task gets the whole list.

Equal sets are one node; component ids come from connected components over the links.

Defined cases: null texts and texts without a word have the empty set and link with nothing; with fewer words than the
shingle the whole sequence is the one element; rows with equal ids are nodes of their own texts;
a null id stands after every id, and a component of null ids alone has a null id; an empty table gives an empty result.
"""

from __future__ import annotations

from itertools import combinations
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import arrays as A
from .common import parts_for, stage
from .components import components

WORDS, NUM, DEN = 3, 90, 100
SUBSET, SCAN = 2, 4
CELLS, SEGMENTS = 1 << 19, 32
LONG_LIST, BLOCK = 64, 4096
DOCS_PER_GROUP, LEAST_GROUPS = 2000, 12
DOC_BYTES = 8192        # bytes of a document that this counts on; longer ones take more groups
TILE, COLUMNS = 512, 4096       # sets and elements of one comparison
DOCS_PER_PART, LEAST_PARTS = 4000, 64
SIZE_BINS = 1 << 12                     # sizes from here on share a bin of the histogram: they are large anyway
LEAST_LEVEL = 2                         # sketches have 64 * 2**level bits
BUNDLE = "part long, kind int, data binary"
_PAIRS, _REQUESTS = 0, 1


class Rule(NamedTuple):
    """Shingle width and least similarity num / den, from 1/2 on and below 1: sizes of a pair differ by a factor of two at most."""

    words: int = WORDS
    num: int = NUM
    den: int = DEN

    def check(self) -> Rule:
        if self.words < 1 or not self.den <= 2 * self.num < 2 * self.den:
            raise ValueError(f"shingles of {self.words} words, similarity {self.num}/{self.den}: not 1 word or more, from 1/2 on and below 1")
        return self

    @property
    def least(self) -> int:
        """Smallest set that a different set can link with: n / (n + 1) reaches the similarity."""
        return -(-self.num // (self.den - self.num))

    @property
    def per_word(self) -> int:
        """Elements of a set for each 64-bit word of its sketch: 256 at 90 / 100, fewer where linked sets may differ more."""
        return max(1, 256 * (self.den + self.num) // (19 * (self.den - self.num)))


RULE = Rule()


def missing(n: np.ndarray, rule: Rule = RULE) -> np.ndarray:
    """Elements of a set of n that a partner may lack."""
    return n - -(-rule.num * n // rule.den)


def sets(buf: np.ndarray, off: np.ndarray, k: int = WORDS):
    """(elements sorted inside each text, set offsets)."""
    buf = A.LOWER[buf]
    starts, ends, wo = A.tokens(buf, off)
    names, size = A.word_names(buf, starts, ends), np.diff(wo)
    parts, owners = [], []
    if len(names) >= k:
        at = np.flatnonzero(A.starts_inside(wo, k)[:len(names) - k + 1])
        parts.append(A.window_names(names, k)[at])
        owners.append(A.owner(wo)[at])
    for short in range(1, k):           # fewer words: the whole sequence, under the name of its length
        d = np.flatnonzero(size == short)
        if len(d):
            parts.append(A.window_names(names, short)[wo[d]])
            owners.append(d)
    if not parts:
        return np.zeros(0, np.uint64), np.zeros(len(off), np.int64)
    x, who = np.concatenate(parts), np.concatenate(owners)
    order = np.lexsort((x, who))
    x, who = x[order], who[order]
    head = A.heads(x, who)
    return x[head], np.searchsorted(who[head], np.arange(len(off)))


def nodes(x: np.ndarray, so: np.ndarray) -> np.ndarray:
    """64-bit name of each set (0 for the empty one)."""
    c = np.concatenate([[A.U(0)], np.cumsum(A.mix(x), dtype=np.uint64)])
    n = np.diff(so)
    return np.where(n > 0, A.mix(c[so[1:]] - c[so[:-1]] + n.astype(np.uint64)) | A.U(1), A.U(0))


def cell(x: np.ndarray) -> np.ndarray:
    return (x >> A.U(64 - (CELLS.bit_length() - 1))).astype(np.int64)


# --- the order and the boundary ----------------------------------------------------------------

def survey(rows: DataFrame, rule: Rule = RULE) -> tuple[np.ndarray, np.ndarray]:
    """(count sketch of all shingles, histogram of set sizes), added up by Spark in segments of fixed size."""
    step = CELLS // SEGMENTS

    def count(batches):
        cells, sizes = np.zeros(CELLS, np.int64), np.zeros(SIZE_BINS, np.int64)
        for batch in batches:
            buf, off = A.text_bytes(batch.column(1))
            for i, j in A.slices(off):
                x, so = sets(*A.cut(buf, off, i, j), rule.words)
                cells += np.bincount(cell(x), minlength=CELLS)
                sizes += np.bincount(np.minimum(np.diff(so), SIZE_BINS - 1), minlength=SIZE_BINS)
        data = [A.pack(cells[s * step:(s + 1) * step]) for s in range(SEGMENTS)] + [A.pack(sizes)]
        yield pa.RecordBatch.from_arrays([pa.array(range(SEGMENTS + 1), pa.int64()), pa.array(data, pa.binary())], ["part", "data"])

    def add(group: pa.Table) -> pa.Table:
        total = sum(A.unpack(d.as_py()) for d in group.column("data"))
        return pa.table({"part": group.column("part").slice(0, 1), "data": pa.array([A.pack(total)], pa.binary())})

    got = {r[0]: A.unpack(bytes(r[1])) for r in rows.mapInArrow(count, "part long, data binary").groupBy("part").applyInArrow(add, "part long, data binary").collect()}
    if not got:
        return np.zeros(CELLS, np.int64), np.zeros(SIZE_BINS, np.int64)
    return np.concatenate([got[s] for s in range(SEGMENTS)]), got[SEGMENTS]


def boundary(sizes: np.ndarray, rule: Rule = RULE) -> int:
    """Largest small size: the cheapest split of the size histogram into subsets and lists."""
    n = np.arange(len(sizes))
    d = missing(n, rule)
    light, heavy = sizes * (d + SUBSET) * (d + SUBSET - 1) // 2, sizes * (d + 1) * SCAN
    upto = np.cumsum(light)[np.minimum(rule.den * n // rule.num, len(n) - 1)]
    return int(np.argmin(upto + heavy.sum() - np.cumsum(heavy)))


class Order:
    """Frequency classes from the sketch: above the noise of the cells, in powers of two."""

    def __init__(self, cells: np.ndarray, small: int, rule: Rule = RULE):
        noise = 2 * cells.mean() + 4
        self.rank = np.floor(np.log2(np.maximum(cells / noise, 1))).astype(np.uint8)
        self.blocks = np.maximum(1, np.ceil((cells - noise) / BLOCK)).astype(np.int32)
        self.small, self.rule = small, rule

    def keys(self, x: np.ndarray, so: np.ndarray, node: np.ndarray):
        """(key, set) of every prefix subset and inverted list; long lists as block pairs."""
        n = np.diff(so)
        who = np.repeat(np.arange(len(n)), n)
        c = cell(x)
        order = np.lexsort((x, self.rank[c], who))
        x, c = x[order], c[order]
        place = np.arange(len(x)) - np.repeat(so[:-1], n)
        d = missing(n, self.rule)
        out_k, out_s = [], []
        large = (n > self.small)[who] & (place <= d[who])
        out_k.append(A.mix(x[large] + A.U(1)))
        out_s.append(who[large])
        blocks = self.blocks[c[large]]
        # sets of one or more elements whose partners can only be equal need no key
        few = np.flatnonzero((n <= self.rule.den * self.small // self.rule.num) & (n >= self.rule.least))
        for depth in np.unique(d[few]):
            s = few[d[few] == depth]
            for i, j in combinations(range(depth + SUBSET), SUBSET):
                a, b = x[so[s] + i], x[so[s] + j]
                out_k.append(A.mix(np.minimum(a, b) * A.U(0x9E3779B97F4A7C15) + A.mix(np.maximum(a, b))))
                out_s.append(s)
                blocks = np.r_[blocks, np.minimum(self.blocks[cell(a)], self.blocks[cell(b)])]
        k, s = np.concatenate(out_k), np.concatenate(out_s)
        split = np.flatnonzero(blocks > 1)
        if len(split):
            more_k, more_s = [], []
            for at in split:
                nb = int(blocks[at])
                own = int(node[s[at]] % A.U(nb))
                pairs = np.array([min(own, o) * nb + max(own, o) for o in range(nb)], np.uint64)
                more_k.append(A.mix(k[at] ^ A.mix(pairs + A.U(1))))
                more_s.append(np.full(nb, s[at]))
            keep = blocks == 1
            k, s = np.concatenate([k[keep], *more_k]), np.concatenate([s[keep], *more_s])
        return k, s


def levels(n: np.ndarray, rule: Rule = RULE) -> np.ndarray:
    """Sketch level of sets of n elements: bits are the power of two from 64 n / ``per_word`` on (n / 4 at 90 / 100), 256 at least."""
    words = np.maximum(-(-n // rule.per_word), 1 << LEAST_LEVEL)
    return np.ceil(np.log2(words)).astype(np.int64)


def parity(x: np.ndarray, so: np.ndarray, rule: Rule = RULE) -> tuple[np.ndarray, np.ndarray]:
    """(64-bit words of all sketches one after the other, level of each set)."""
    n = np.diff(so)
    level = levels(n, rule)
    bits = 64 << level
    first = np.cumsum(bits) - bits
    at = np.repeat(first, n) + (A.mix(x + A.U(99)) & np.repeat(bits - 1, n).astype(np.uint64)).astype(np.int64)
    odd = (np.bincount(at, minlength=int(bits.sum())) & 1).astype(np.uint8)
    return np.packbits(odd).view(np.uint64), level


class Sketches:
    """Parity sketches of many sets, comparable at the lower level of a pair."""

    def __init__(self, words: np.ndarray, level: np.ndarray):
        first = np.cumsum(1 << level) - (1 << level)
        self.level, self.rows, self.place = level, {}, {}
        for k in np.unique(level):
            s = np.flatnonzero(level == k)
            self._add(int(k), s, words[first[s][:, None] + np.arange(1 << k)])
        for k in sorted(self.rows, reverse=True):
            # sizes of a pair differ by a factor of two at most (Rule), so their levels by one at most
            own = np.flatnonzero(level == k)
            if k > LEAST_LEVEL and len(own):
                m = self.rows[k][self.place[k][own]]
                self._add(k - 1, own, m[:, :1 << (k - 1)] ^ m[:, 1 << (k - 1):])

    def _add(self, k, sets_, rows):
        place = self.place.setdefault(k, np.full(len(self.level), -1))
        old = self.rows.get(k, np.zeros((0, 1 << k), np.uint64))
        place[sets_] = len(old) + np.arange(len(sets_))
        self.rows[k] = np.concatenate([old, rows])

    def apart(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        """Sketch distance of pairs of sets."""
        low = np.minimum(self.level[i], self.level[j])
        out = np.zeros(len(i), np.int64)
        for k in np.unique(low):
            m = np.flatnonzero(low == k)
            for a in range(0, len(m), max(1, (1 << 18) >> int(k))):
                b = m[a:a + max(1, (1 << 18) >> int(k))]
                rows, place = self.rows[k], self.place[k]
                out[b] = np.bitwise_count(rows[place[i[b]]] ^ rows[place[j[b]]]).sum(1, dtype=np.int64)
        return out


# --- jobs --------------------------------------------------------------------------------------

def _group_sets(group, rule: Rule):
    """Distinct non-empty sets of some rows: (elements, offsets, nodes, first row of each)."""
    buf, off = A.text_bytes(group.column("__t"))
    parts = [sets(*A.cut(buf, off, i, j), rule.words) for i, j in A.slices(off)]
    x = np.concatenate([p[0] for p in parts]) if parts else np.zeros(0, np.uint64)
    n = np.concatenate([np.diff(p[1]) for p in parts]) if parts else np.zeros(0, np.int64)
    so = np.r_[0, np.cumsum(n)]
    name = nodes(x, so)
    _, first = np.unique(name, return_index=True)
    first = first[name[first] > 0]
    keep = np.zeros(len(n), bool)
    keep[first] = True
    x, n = x[np.repeat(keep, n)], n[keep]
    return x, np.r_[0, np.cumsum(n)], name[keep], np.flatnonzero(keep)


def _bundle(rows: list[tuple[int, int, bytes]]) -> pa.Table:
    cols = list(zip(*rows, strict=True)) if rows else [()] * 3
    return pa.table({"part": pa.array(cols[0], pa.int64()), "kind": pa.array(cols[1], pa.int32()), "data": pa.array(cols[2], pa.binary())})


def _frame(*fields: bytes) -> bytes:
    return A.frame(list(fields))


def _frames(group: pa.Table):
    return [A.unframe(d) for d in group.column("data").to_pylist()]


def _cat(parts: list, kind) -> np.ndarray:
    return np.concatenate(parts) if parts else np.zeros(0, kind)


def _keys_of(order: Order, parts: int):
    """Bundles of the keys of every batch, dealt by key."""
    def rows(batches):
        for batch in batches:
            x, so, node, first = _group_sets(batch, order.rule)
            home = batch.column("grp").to_numpy()[first]
            k, s = order.keys(x, so, node)
            (words, level), size = parity(x, so, order.rule), np.diff(so)
            at = np.cumsum(1 << level) - (1 << level)
            rank = np.argsort(k, kind="stable")
            k, s = k[rank], s[rank]
            edges = np.searchsorted(A.span(k, parts), np.arange(parts + 1))
            out = []
            for p in np.flatnonzero(np.diff(edges)):
                a, b = edges[p], edges[p + 1]
                used, local = np.unique(s[a:b], return_inverse=True)
                out.append((int(p), 0, _frame(A.pack(home[used]), A.blob(k[a:b]), A.pack(local), A.blob(node[used]), A.pack(size[used]),
                                              b"".join(A.blob(words[at[u]:at[u] + (1 << level[u])]) for u in used))))
            yield from _bundle(out).to_batches()
    return rows


def _lists(parts: int, rule: Rule):
    """Pairs of short lists and members of long ones that pass the size and parity tests."""
    def run(group: pa.Table) -> pa.Table:
        key, which, node, size, sketch, home, base = [], [], [], [], [], [], 0
        for hm, k, local, nd, sz, sk in _frames(group):
            key.append(np.frombuffer(k, np.uint64))
            which.append(A.unpack(local) + base)
            node.append(np.frombuffer(nd, np.uint64))
            size.append(A.unpack(sz))
            sketch.append(np.frombuffer(sk, np.uint64))
            home.append(A.unpack(hm))
            base += len(node[-1])
        key, which, node, size, home = (np.concatenate(v) for v in (key, which, node, size, home))
        bits = Sketches(np.concatenate(sketch), levels(size, rule))
        order = np.lexsort((home[which], node[which], size[which], key))
        order = order[A.heads(key[order], node[which[order]])]              # an equal set of another batch is the same node
        key, which = key[order], which[order]
        length = np.repeat(A.runs(A.heads(key)), A.runs(A.heads(key)))
        active = np.zeros(len(key), bool)
        left, right = [], []
        i = np.arange(len(key) - 1)
        shift = 1
        while True:
            i = i[i + shift < len(key)]
            # sizes ascend inside a list: beyond the first misfit there is no fit
            i = i[(key[i] == key[i + shift]) & (rule.den * size[which[i]] >= rule.num * size[which[i + shift]])]
            if not len(i):
                break
            a, b = which[i], which[i + shift]
            # den (a + b - D) / 2 >= num (a + b + D) / 2 for the symmetric difference D
            fit = (rule.den + rule.num) * bits.apart(a, b) <= (rule.den - rule.num) * (size[a] + size[b])
            short = length[i] <= LONG_LIST
            left.append(i[fit & short])
            right.append(i[fit & short] + shift)
            active[i[fit & ~short]] = True
            active[i[fit & ~short] + shift] = True
            shift += 1
        a, b = _cat(left, np.int64), _cat(right, np.int64)
        k, a, b = key[a], which[a], which[b]
        low = node[a] < node[b]
        a, b = np.where(low, a, b), np.where(low, b, a)
        rows = [(p, _PAIRS, _frame(A.blob(node[a[r]]), A.blob(node[b[r]]), A.blob(k[r]), A.blob(home[a[r]]), A.blob(home[b[r]])))
                for p, r in A.split_by(A.part_of(A.mix(node[a] ^ A.mix(node[b])), parts), parts)]
        m = np.flatnonzero(active)
        for r in _by(home[which[m]]):
            rows.append((int(home[which[m[r[0]]]]), _REQUESTS, _frame(A.blob(node[which[m[r]]]), A.blob(key[m[r]]))))
        return _bundle(rows)
    return run


def _by(values: np.ndarray):
    order = np.argsort(values, kind="stable")
    return np.split(order, np.flatnonzero(np.diff(values[order])) + 1) if len(order) else []


def _one_list_per_pair(group: pa.Table) -> pa.Table:
    """Each pair is checked in one of its lists (the smallest key): requests to the groups of its sets."""
    got = list(zip(*_frames(group), strict=True))
    a, b, key = (np.concatenate([np.frombuffer(x, np.uint64) for x in f]) for f in got[:3])
    ha, hb = (np.concatenate([np.frombuffer(x, np.int64) for x in f]) for f in got[3:])
    order = np.lexsort((key, b, a))
    order = order[A.heads(a[order], b[order])]
    node, home, key = np.r_[a[order], b[order]], np.r_[ha[order], hb[order]], np.r_[key[order], key[order]]
    order = np.lexsort((key, node, home))
    order = order[A.heads(home[order], node[order], key[order])]
    node, home, key = node[order], home[order], key[order]
    return _bundle([(int(home[r[0]]), _REQUESTS, _frame(A.blob(node[r]), A.blob(key[r]))) for r in _by(home)])


def _ship(parts: int, rule: Rule):
    def run(key: tuple[pa.Scalar, ...], group: pa.Table, asked: pa.Table) -> pa.Table:
        if not asked.num_rows or not group.num_rows:
            return _bundle([])
        got = list(zip(*_frames(asked), strict=True))
        want, k = (np.concatenate([np.frombuffer(x, np.uint64) for x in f]) for f in got)
        order = np.lexsort((want, k))
        order = order[A.heads(k[order], want[order])]
        want, k = want[order], k[order]
        x, so, node, _ = _group_sets(group, rule)
        by_name = np.argsort(node)
        at = by_name[np.searchsorted(node[by_name], want)]
        edges = np.searchsorted(A.span(k, parts), np.arange(parts + 1))
        rows = []
        for p in np.flatnonzero(np.diff(edges)):
            a, b = edges[p], edges[p + 1]
            used, local = np.unique(at[a:b], return_inverse=True)
            rows.append((int(p), 0, _frame(A.blob(k[a:b]), A.pack(local), A.blob(node[used]), A.pack(np.diff(so)[used]),
                                           b"".join(A.blob(x[so[u]:so[u + 1]]) for u in used))))
        return _bundle(rows)
    return run


def _links(rule: Rule):
    """Exact comparison inside each list; a spanning forest of its links."""
    def run(group: pa.Table) -> pa.Table:
        key, node, arrays = [], [], []
        for k, local, nd, sz, data in _frames(group):
            at = A.unpack(local)
            key.append(np.frombuffer(k, np.uint64))
            node.append(np.frombuffer(nd, np.uint64)[at])
            own = np.split(np.frombuffer(data, np.uint64), np.cumsum(A.unpack(sz))[:-1])
            arrays += [own[i] for i in at]
        key, node = np.concatenate(key), np.concatenate(node)
        out_a, out_b = [], []
        for r in _by(key):
            _, first = np.unique(node[r], return_index=True)
            r = r[first]
            for i, j in forest([arrays[x] for x in r], rule):
                out_a.append(int(node[r[i]].view(np.int64)))
                out_b.append(int(node[r[j]].view(np.int64)))
        return pa.table({"a": pa.array(out_a, pa.int64()), "b": pa.array(out_b, pa.int64())})
    return run


def forest(members: list[np.ndarray], rule: Rule = RULE) -> list[tuple[int, int]]:
    """Spanning forest of the linked pairs among some sets (sorted arrays of distinct elements).

    Sets are compared in tiles of TILE x TILE; a tile whose sets are in one component already is skipped, so memory
    follows the tile and a family of copies costs one row of tiles.
    """
    m = len(members)
    size = np.array([len(s) for s in members])
    parent, out = list(range(m)), []

    def root(v):
        while parent[v] != v:
            parent[v] = parent[parent[v]]
            v = parent[v]
        return v

    def link(pairs):
        for i, j in pairs:
            a, b = root(i), root(j)
            if a != b:
                parent[b] = a
                out.append((i, j))

    if m <= 3:
        link((i, j) for i in range(m) for j in range(i + 1, m)
             if _fits(len(np.intersect1d(members[i], members[j], assume_unique=True)), size[i], size[j], rule))
        return out
    column, count = np.unique(np.concatenate(members), return_inverse=True, return_counts=True)[1:]
    shared = np.flatnonzero(count > 1)                          # an element of one set adds to no intersection
    place = np.full(len(count), -1)
    place[shared] = np.arange(len(shared))
    col, edge = place[column], np.r_[0, np.cumsum(size)]
    blocks = np.arange(0, len(shared) + COLUMNS, COLUMNS)
    tiles = []
    for a in range(0, m, TILE):
        b = min(a + TILE, m)
        c, r = col[edge[a]:edge[b]], np.repeat(np.arange(b - a), size[a:b])
        order = np.argsort(c, kind="stable")
        order = order[np.searchsorted(c[order], 0):]
        tiles.append((a, b, r[order], c[order], np.searchsorted(c[order], blocks)))

    def dense(tile, k):
        a, b, r, c, at = tile
        x = np.zeros((b - a, COLUMNS), np.float32)
        x[r[at[k]:at[k + 1]], c[at[k]:at[k + 1]] - k * COLUMNS] = 1
        return x

    for t, one in enumerate(tiles):
        for other in tiles[t:]:
            if len({root(v) for v in range(one[0], one[1])} | {root(v) for v in range(other[0], other[1])}) == 1:
                continue
            common = np.zeros((one[1] - one[0], other[1] - other[0]), np.float32)
            for k in range(len(blocks) - 1):
                x = dense(one, k)
                common += x @ (x if other is one else dense(other, k)).T
            i, j = np.nonzero(_fits(common.astype(np.int64), size[one[0]:one[1], None], size[None, other[0]:other[1]], rule))
            i, j = i + one[0], j + other[0]
            link(zip(i[i < j].tolist(), j[i < j].tolist(), strict=True))
    return out


def _fits(both, a, b, rule: Rule):
    return rule.den * both >= rule.num * (a + b - both)


def with_nodes(docs: DataFrame, text: str, rule: Rule = RULE) -> DataFrame:
    """``docs`` with __n (set size) and __node (set name, null for the empty set)."""
    at = docs.columns.index(text)

    def rows(batches):
        for batch in batches:
            buf, off = A.text_bytes(batch.column(at))
            got = [sets(*A.cut(buf, off, i, j), rule.words) for i, j in A.slices(off)]
            n = np.concatenate([np.diff(so) for _, so in got]) if got else np.zeros(0, np.int64)
            name = np.concatenate([nodes(x, so) for x, so in got]).view(np.int64) if got else np.zeros(0, np.int64)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(n), pa.array(name, mask=n == 0)], [*batch.schema.names, "__n", "__node"])

    return docs.mapInArrow(rows, T.StructType([*docs.schema.fields, T.StructField("__n", T.LongType()), T.StructField("__node", T.LongType())]))


def links(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", rule: Rule = RULE) -> DataFrame:
    """(a, b) set names: links between different sets that connect every component of the join."""
    spark, rule = docs.sparkSession, rule.check()
    rows = docs.select(F.col(doc_id).alias("__i"), F.col(text).alias("__t"))
    size, volume = rows.agg(F.count(F.lit(1)), F.coalesce(F.sum(F.octet_length("__t").cast("long")), F.lit(0))).first()
    # by rows, or by bytes where texts are long
    groups, parts = (max(parts_for(size, n, least), parts_for(volume, n * DOC_BYTES)) for n, least in ((DOCS_PER_GROUP, LEAST_GROUPS), (DOCS_PER_PART, LEAST_PARTS)))
    cells, sizes = survey(rows, rule)
    order = Order(cells, boundary(sizes, rule), rule)
    # homes are dealt by id and text: a text that a third of the rows share is spread, and is one set in each home
    dealt = rows.select("__t", F.pmod(F.xxhash64("__i", "__t"), F.lit(groups)).cast("long").alias("grp"))
    keyed = dealt.mapInArrow(_keys_of(order, parts), BUNDLE)
    listed = stage(spark, keyed.groupBy("part").applyInArrow(_lists(parts, rule), BUNDLE), "join-lists")
    asked = listed.where(F.col("kind") == _PAIRS).groupBy("part").applyInArrow(_one_list_per_pair, BUNDLE)
    asked = asked.unionByName(listed.where(F.col("kind") == _REQUESTS)).withColumnRenamed("part", "grp")
    sent = dealt.groupBy("grp").cogroup(asked.groupBy("grp")).applyInArrow(_ship(parts, rule), BUNDLE)
    return sent.groupBy("part").applyInArrow(_links(rule), "a long, b long")


def join(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", rule: Rule = RULE) -> DataFrame:
    """``docs`` with n_shingles, component_id and __comp (the component's set name, null for an empty set); input columns of those names are replaced."""
    spark = docs.sparkSession
    docs = docs.drop("n_shingles", "component_id", "__comp", "__n", "__node")
    text = next(c for c in docs.columns if c.lower() == text.lower())
    named = with_nodes(docs, text, rule)
    comp = components(links(docs, doc_id, text, rule))
    least = named.where("__node is not null").groupBy("__node").agg(F.min(F.col(doc_id)).alias("__id"))
    # one row per set; the component's id is the smallest of its sets' ids
    known = stage(spark, least.join(comp, F.col("__node") == F.col("node"), "left")
                  .select("__node", "__id", F.coalesce("comp", "__node").alias("__comp")), "join-sets")
    ids = known.groupBy("__comp").agg(F.min("__id").alias("component_id"))
    table = stage(spark, known.select("__node", "__comp").join(ids, "__comp"), "join-components")
    out = named.join(table, "__node", "left")
    return out.select(*[F.col(f"`{c}`") for c in docs.columns], F.col("__n").alias("n_shingles"),
                      F.when(F.col("__comp").isNull(), F.col(doc_id)).otherwise(F.col("component_id")).alias("component_id"), "__comp")


def one_of_each(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", rule: Rule = RULE) -> DataFrame:
    """The document with the smallest id of every component, and every document with an empty set; all columns stay as they are, whatever their names."""
    names = docs.columns
    own = docs.toDF(*[f"c{k}" for k in range(len(names))])               # so no column can clash with those of the join
    row_id, body = (f"c{[n.lower() for n in names].index(c.lower())}" for c in (doc_id, text))
    joined = stage(docs.sparkSession, join(own, row_id, body, rule), "join-rows")
    empty = joined.where("__comp is null")
    first = joined.where(F.col("__comp").isNotNull() & F.col(row_id).eqNullSafe(F.col("component_id"))).dropDuplicates(["__comp"])
    return empty.unionByName(first).select(*[F.col(f"c{k}").alias(n) for k, n in enumerate(names)])
