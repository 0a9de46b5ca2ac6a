"""Substring dedup by recompression: words covered by a window that starts in an earlier document are removed.

Two rounds compress the word sequence. A round names runs of one symbol (first
round) and pairs (left class, right class) of neighbours; the classes are a bit of each
symbol's name. Names are 64-bit fingerprints of what they stand for, so the naming is
global without a dictionary: equal substrings get equal interior symbols in every
task, whatever stands around them. Only the symbols at the rim of a substring depend on the context:
where a window of ``window`` words (11 or more) stands, the symbol borders at its
offsets 3 .. window - 5 follow from its own words, and at least one border is among the offsets 3 .. 6.

The jobs, on documents dealt into groups of about ``DOCS_PER_GROUP`` by a hash of the row:

1. each window names its anchor, the border in that range with the smallest name of the
   8 words around it; each group sends its distinct anchors, dealt by hash;
2. anchors seen with two document ids come back to the groups that sent them: the shared symbols reveal
   where long repeats can be;
3. groups send the names of the whole windows at these anchors with their smallest
   document id; equal names verify the repeat, and the smallest id of all comes back;
4. groups mark the words of windows that stand in a document with a smaller id.

A symbol or window that stands in very many documents is one entry per group in the exchanges.
The texts are dealt once (the three uses share the exchange).

Defined cases: a null text has no words; texts shorter than the window lose nothing; a null id stands
after every id, and rows with equal ids do not remove each other's words; the decision is made on the
input, not on what is left; an empty table gives an empty result.
"""

from __future__ import annotations

from itertools import compress

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import arrays as A
from .common import parts_for

WINDOW = 13
KEY, LEFT = 8, 3                        # words of an anchor's name, words of them before the border
DOCS_PER_GROUP, LEAST_GROUPS = 2000, 12
DOCS_PER_PART, LEAST_PARTS = 4000, 64
LAST_ID = (1 << 63) - 1
_NEVER = np.uint64(0xFFFFFFFFFFFFFFFF)
_PAIR, _LEFT_BIT = A.U(0xA0761D6478BD642F), (A.U(0xE7037ED1A0B428DB), A.U(0x8EBC6AF09C88C6E3))     # odd constants (fixed values)


def name_pairs(names: np.ndarray, free: np.ndarray, doc: np.ndarray, level: int):
    """One round of pair naming: (heads, names, free) of the new symbols.

    A free symbol of the left class and its free right neighbour of the right class become one symbol.
    """
    left = (A.mix(names ^ _LEFT_BIT[level]) & A.U(1)) == 0
    joined = np.zeros(len(names), bool)             # joined to the symbol before
    if len(names) > 1:
        joined[1:] = left[:-1] & ~left[1:] & free[:-1] & free[1:] & (doc[1:] == doc[:-1])
    head = np.flatnonzero(~joined)
    out = names[head].copy()
    two = np.flatnonzero(joined)
    at = np.searchsorted(head, two) - 1
    out[at] = A.mix(names[two - 1] * _PAIR + A.mix(names[two] + A.U(level)))
    return head, out, free[head]


def borders(names: np.ndarray, doc: np.ndarray) -> np.ndarray:
    """Boolean per word: a symbol of the second round starts here, or the word goes on a run."""
    n = len(names)
    same = np.zeros(n + 1, bool)
    if n > 1:
        same[1:n] = (names[1:] == names[:-1]) & (doc[1:] == doc[:-1])
    in_run = same[:n] | same[1:]
    # first round: runs are named with their length and stay apart; pairs of the other words
    begin = np.flatnonzero(~same[:n])
    size = np.diff(np.r_[begin, n])
    run = size > 1
    sym = names[begin].copy()
    sym[run] = A.mix(sym[run] * _PAIR + size[run].astype(np.uint64))
    at, free, d = begin, ~run, doc[begin]
    for level in (0, 1):
        head, sym, free = name_pairs(sym, free, d, level)
        at, d = at[head], d[head]
    out = in_run & same[:n]
    out[at] = True
    return out


def anchors(names: np.ndarray, word_off: np.ndarray, window: int) -> tuple[np.ndarray, np.ndarray]:
    """(positions of windows, anchor name of each)."""
    inside = np.flatnonzero(A.starts_inside(word_off, window)) if len(names) else np.zeros(0, np.int64)
    if not len(inside):
        return inside, np.zeros(0, np.uint64)
    border = borders(names, A.owner(word_off))
    value = np.full(len(names), _NEVER)
    key = A.window_names(names, KEY)
    p = np.flatnonzero(border[LEFT:LEFT + len(key)]) + LEFT
    value[p] = np.minimum(A.mix(key[p - LEFT] + A.U(1)), _NEVER - A.U(1))
    least = value[inside + LEFT]
    for offset in range(LEFT + 1, window - KEY + LEFT + 1):
        np.minimum(least, value[inside + offset], out=least)
    return inside, least


def _texts(group: pa.Table):
    ids = group.column("__id").combine_chunks()
    ids = ids.combine_chunks() if isinstance(ids, pa.ChunkedArray) else ids
    ids = ids.fill_null(LAST_ID).to_numpy(zero_copy_only=False)
    buf, off = A.text_bytes(group.column("__t"))
    return ids, buf, off


def _words(ids, buf, off, window):
    """Per slice of a group: first row, words, offsets."""
    for i, j in A.slices(off):
        b, o = A.cut(buf, off, i, j)
        starts, ends, wo = A.tokens(b, o)
        yield i, j, b, starts, ends, A.word_names(b, starts, ends), wo


def _least_id(keys: np.ndarray, ids: np.ndarray):
    """(distinct keys, smallest id, boolean: two ids or more)."""
    order = np.lexsort((ids, keys))
    k, d = keys[order], ids[order]
    head = A.heads(k)
    at = np.flatnonzero(head)
    last = np.r_[at[1:], len(k)] - 1
    return k[at], d[at], d[last] != d[at] if len(at) else np.zeros(0, bool)


def _out(rows: list[tuple], names=("key", "grp", "a", "b")) -> pa.Table:
    cols = list(zip(*rows, strict=True)) if rows else [()] * 4
    return pa.table({n: pa.array(c, t) for n, c, t in zip(names, cols, (pa.int64(), pa.int64(), pa.binary(), pa.binary()), strict=True)})


def _send(grp: int, keys, ids, parts, extra):
    """Bundles of sorted keys, dealt by key range of a hash."""
    edges = np.searchsorted(A.span(keys, parts), np.arange(parts + 1))
    return [(int(p), grp, A.blob(keys[a:b]), extra(a, b)) for p in np.flatnonzero(np.diff(edges)) for a, b in [(edges[p], edges[p + 1])]]


def _collect(parts: list[tuple[np.ndarray, np.ndarray]]):
    return [np.concatenate(c) for c in zip(*parts, strict=True)] if parts else [np.zeros(0, np.uint64), np.zeros(0, np.int64)]


def _anchors_of(window, parts):
    def run(key: tuple[pa.Scalar, ...], group: pa.Table) -> pa.Table:
        ids, buf, off = _texts(group)
        found = []
        for i, _, _, _, _, names, wo in _words(ids, buf, off, window):
            at, name = anchors(names, wo, window)
            d = ids[i + A.owner(wo)[at]]
            keep = A.heads(name, d)         # neighbours often share an anchor
            found.append((name[keep], d[keep]))
        k, _, many = _least_id(*_collect(found))
        return _out(_send(key[0].as_py(), k, None, parts, lambda a, b: A.blob(np.packbits(many[a:b]))))
    return run


def _bundles(group: pa.Table):
    return [(g, np.frombuffer(a, np.uint64), b) for g, a, b in zip(*(group.column(c).to_pylist() for c in ("grp", "a", "b")), strict=True)]


def _shared(group: pa.Table) -> pa.Table:
    """Anchors of two ids or more, back to the groups that sent them."""
    got = _bundles(group)
    keys = np.concatenate([k for _, k, _ in got])
    many = np.concatenate([np.unpackbits(np.frombuffer(b, np.uint8), count=len(k)) for _, k, b in got]).astype(bool)
    order = np.argsort(keys, kind="stable")
    head = A.heads(keys[order])
    run = np.cumsum(head) - 1
    shared = (np.bincount(run) > 1) | (np.bincount(run, many[order]) > 0)
    flag = np.zeros(len(keys), bool)
    flag[order] = shared[run]
    rows, at = [], 0
    for g, k, _ in got:
        own = flag[at:at + len(k)]
        at += len(k)
        if own.any():
            rows.append((0, g, A.blob(k[own]), b""))
    return _out(rows)


def _candidates_of(window, parts):
    def run(key: tuple[pa.Scalar, ...], group: pa.Table, back: pa.Table) -> pa.Table:
        shared = [np.frombuffer(b, np.uint64) for b in back.column("a").to_pylist()]
        if not shared or not group.num_rows:
            return _out([])
        shared = np.sort(np.concatenate(shared))
        ids, buf, off = _texts(group)
        found = []
        for i, _, _, _, _, names, wo in _words(ids, buf, off, window):
            at, name = anchors(names, wo, window)
            at = at[np.isin(name, shared)] if len(at) else at
            if len(at):
                found.append((A.window_names(names, window)[at], ids[i + A.owner(wo)[at]]))
        k, least, _ = _least_id(*_collect(found))

        def ids_of(a, b):
            known, at = np.unique(least[a:b], return_inverse=True)
            return A.frame([*A.gaps(known.view(np.uint64)), A.pack(at)])
        return _out(_send(key[0].as_py(), k, least, parts, ids_of))
    return run


def _ids_from(b: bytes) -> np.ndarray:
    low, high, at = A.unframe(b)
    return A.from_gaps(low, high).view(np.int64)[A.unpack(at)]


def _smallest(group: pa.Table) -> pa.Table:
    """The smallest id of each window, back to the groups whose own smallest id is larger."""
    got = _bundles(group)
    keys = np.concatenate([k for _, k, _ in got])
    ids = np.concatenate([_ids_from(b) for _, _, b in got])
    order = np.argsort(keys, kind="stable")
    head = A.heads(keys[order])
    least = np.empty(len(keys), np.int64)
    at = np.flatnonzero(head)
    least[order] = np.minimum.reduceat(ids[order], at)[np.cumsum(head) - 1]
    rows, i = [], 0
    for g, k, _ in got:
        lower = least[i:i + len(k)] < ids[i:i + len(k)]
        if lower.any():
            rows.append((0, g, A.blob(k[lower]), A.blob(least[i:i + len(k)][lower])))
        i += len(k)
    return _out(rows)


def _remove_from(window):
    def run(key: tuple[pa.Scalar, ...], group: pa.Table, back: pa.Table) -> pa.Table:
        ids, buf, off = _texts(group)
        got = [(np.frombuffer(a, np.uint64), np.frombuffer(b, np.int64)) for a, b in zip(*(back.column(c).to_pylist() for c in ("a", "b")), strict=True)]
        seen = list(got)
        parts = []
        for part in _words(ids, buf, off, window):
            i, names, wo = part[0], part[5], part[6]
            at = np.flatnonzero(A.starts_inside(wo, window)) if len(names) else np.zeros(0, np.int64)
            name = A.window_names(names, window)[at] if len(at) else np.zeros(0, np.uint64)
            d = ids[i + A.owner(wo)[at]] if len(at) else np.zeros(0, np.int64)
            parts.append((part, at, name, d))
            seen.append((name, d))
        # the smallest id of each window: of this group, or one that came back
        keys, least, _ = _least_id(*_collect(seen))
        n_words, n_removed, kept = np.zeros(len(ids), np.int64), np.zeros(len(ids), np.int64), []
        for (i, j, b, starts, ends, names, wo), at, name, d in parts:
            cover = np.zeros(len(names) + 1, np.int64)
            if len(at):
                hit = at[least[np.searchsorted(keys, name)] < d]
                cover[hit] += 1
                np.subtract.at(cover, hit + window, 1)
            gone = np.cumsum(cover[:-1]) > 0
            n_words[i:j] = np.diff(wo)
            n_removed[i:j] = np.bincount(A.owner(wo), gone, j - i)
            data = b.tobytes()
            o = off[i:j + 1] - off[i]
            for r in range(j - i):
                words = data[o[r]:o[r + 1]].split()
                if n_removed[i + r]:
                    words = compress(words, (~gone[wo[r]:wo[r + 1]]).tolist())
                kept.append(b" ".join(words))
        return pa.table({"__id": group.column("__id"), "n_words": pa.array(n_words), "n_removed": pa.array(n_removed),
                         "kept_text": pa.array(kept, pa.binary()).cast(pa.string())})
    return run


def remove_repeats(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", window: int = WINDOW) -> DataFrame:
    """One row per input row: doc_id, n_words, n_removed, kept_text (kept words joined by one space)."""
    if window < KEY + 3:
        raise ValueError(f"window must be {KEY + 3} words or more")
    rows = docs.select(F.col(doc_id).cast("long").alias("__id"), F.col(text).alias("__t"))
    size = rows.count()
    groups, parts = parts_for(size, DOCS_PER_GROUP, LEAST_GROUPS), parts_for(size, DOCS_PER_PART, LEAST_PARTS)
    dealt = rows.withColumn("grp", F.pmod(F.xxhash64("__id", "__t"), F.lit(groups)).cast("long"))
    bundle = "key long, grp long, a binary, b binary"
    sent = dealt.groupBy("grp").applyInArrow(_anchors_of(window, parts), bundle)
    shared = sent.groupBy("key").applyInArrow(_shared, bundle)
    windows = dealt.groupBy("grp").cogroup(shared.groupBy("grp")).applyInArrow(_candidates_of(window, parts), bundle)
    lower = windows.groupBy("key").applyInArrow(_smallest, bundle)
    out = dealt.groupBy("grp").cogroup(lower.groupBy("grp")).applyInArrow(
        _remove_from(window), "__id long, n_words long, n_removed long, kept_text string")
    return out.withColumnRenamed("__id", doc_id)
