"""Benchmark decontamination: CGK embedding, bit-sampling LSH, exact edit check.

Words (ASCII lower case, ASCII punctuation dropped wherever it stands) are the alphabet. The CGK walk
copies the word it stands on and then moves on or stays by a random bit of
(step, word), so two sequences at a small edit distance agree in most steps:
edit distance becomes Hamming distance. Each of ``REPS`` repetitions draws its own
bits and samples ``PICKS`` of the steps; the sampled words form the LSH key.

Documents are embedded at every ``STRIDE``-th word, benchmark items at every offset, so an
occurrence meets the item at several places in each repetition; that is what
lifts recall to ``TARGET_RECALL``. Item-sized windows around the meeting points
are then checked exactly: the smallest word edit distance between the item and
any part of the window must be at most ``MAX_EDITS`` of the item's words.

The index holds (item words) x ``REPS`` keys at most. Items are numbered and
taken in blocks of ``BLOCK_WORDS`` words, one pass over the documents for each, so what
is broadcast stays bounded however many items there are.

Defined cases: a null or empty text has no hit; items that are null or shorter
than ``MIN_WORDS`` words are no passages and match nothing; repeated items and
repeated documents each give their rows; an empty benchmark gives no rows.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import arrays as A
from .common import stage

MIN_WORDS = 5
MAX_EDITS = 0.2             # edits per item word: similarity 0.8
TARGET_RECALL = 0.9
BLOCK_WORDS = 200_000
# (items of at least so many words, steps of the walk, sampled steps, stride, repetitions)
CLASSES = ((12, 16, 6, 4, 8), (MIN_WORDS, 8, 4, 1, 6))
_NONE = A.U(0)

MARK = np.zeros(256, bool)
MARK[[b for b in range(33, 127) if not chr(b).isalnum()]] = True    # ASCII punctuation is no part of a word


def normal_words(buf, off):
    """Names of words in lower case without their punctuation; a word of punctuation alone stays, with an empty name."""
    starts, ends, wo = A.tokens(buf, off)
    keep = ~MARK[buf]
    at = np.concatenate([np.zeros(1, np.int64), np.cumsum(keep)])
    return A.word_names(A.LOWER[buf[keep]], at[starts], at[ends]), wo


def sampled_steps(rep: int, steps: int, picks: int) -> np.ndarray:
    rng = np.random.default_rng(1000 + rep)
    return np.sort(rng.choice(steps, picks, replace=False))


def walk(names: np.ndarray, bits: np.ndarray, at: np.ndarray, stop: np.ndarray, rep: int, steps: int, picks: int):
    """LSH keys of the walks that start at ``at`` and must stay before ``stop``; ``ok``: the sampled part stayed inside."""
    chosen = sampled_steps(rep, steps, picks)
    pos, key = at.copy(), np.full(len(at), rep + 1, np.uint64)
    ok = np.ones(len(at), bool)
    take = set(chosen.tolist())
    for step in range(int(chosen[-1]) + 1):
        here = np.minimum(pos, len(names) - 1)
        if step in take:
            ok &= pos < stop
            key = (key ^ names[here]) * A.U(0xD1342543DE82EF95)
            key ^= key >> A.U(29)
        pos += ((bits[here] >> A.U(step)) & A.U(1)).astype(np.int64)
    return A.mix(key), ok


def edit_distance_inside(item: np.ndarray, window: np.ndarray) -> tuple[int, int, int]:
    """(distance, start, end): the part of ``window`` nearest to ``item`` in word edits."""
    m = len(window)
    cols = np.arange(m + 1)
    row, begin = np.zeros(m + 1, np.int64), cols.copy()
    for i, w in enumerate(item, 1):
        sub = row[:-1] + (window != w)
        up = row + 1
        new, nb = up.copy(), begin.copy()
        better = sub < new[1:]
        new[1:][better], nb[1:][better] = sub[better], begin[:-1][better]
        # insertions run along the row: a running minimum of (value - column)
        base = new - cols
        low = np.minimum.accumulate(base)
        src = np.maximum.accumulate(np.where(base == low, cols, 0))
        row, begin = low + cols, nb[src]
    end = int(row.argmin())
    return int(row[end]), int(begin[end]), end


class Index:
    """Keys of one block of items; shipped with the tasks."""

    def __init__(self, ids: list, texts: list[str]):
        buf, off = A.text_bytes(pa.array(texts, pa.string()))
        names, wo = normal_words(buf, off)
        self.ids, self.names, self.wo = ids, names, wo
        size = np.diff(wo)
        self.tables, low = [], None
        for least, steps, picks, stride, reps in CLASSES:
            own = np.flatnonzero((size >= least) & (size < (low or 1 << 60)))
            low = least
            if not len(own):
                continue
            at = np.concatenate([np.arange(wo[i], wo[i + 1]) for i in own])
            item = np.repeat(own, size[own])
            for rep in range(reps):
                key, ok = walk(names, self.bits(names, rep), at, wo[item + 1], rep, steps, picks)
                key, it, o = key[ok], item[ok], (at - wo[item])[ok]
                order = np.argsort(key, kind="stable")
                self.tables.append((steps, picks, stride, rep, key[order], it[order], o[order], self.filter(key)))

    @staticmethod
    def bits(names, rep):
        return A.mix(names ^ A.U(0x5851F42D4C957F2D * (rep + 1) & 0xFFFFFFFFFFFFFFFF))

    @staticmethod
    def filter(keys):
        """A bit map on 20 bits of the key, to skip most lookups."""
        seen = np.zeros(1 << 20, bool)
        seen[(keys & A.U((1 << 20) - 1)).astype(np.int64)] = True
        return seen

    def search(self, buf, off):
        """(text, item, edits, first word, words) of every verified passage; one per text and item, the nearest, then the first."""
        names, wo = normal_words(buf, off)
        if not len(names):
            return []
        local = np.arange(len(names)) - np.repeat(wo[:-1], np.diff(wo))
        stop = np.repeat(wo[1:], np.diff(wo))
        who = A.owner(wo)
        found, grids, last = set(), {}, None
        for steps, picks, stride, rep, keys, items, offs, seen in self.tables:
            if last != rep:
                bits, last = self.bits(names, rep), rep
            if stride not in grids:
                grids[stride] = np.flatnonzero(local % stride == 0)
            at = grids[stride]
            key, ok = walk(names, bits, at, stop[at], rep, steps, picks)
            hit = np.flatnonzero(ok & seen[(key & A.U((1 << 20) - 1)).astype(np.int64)])
            if not len(hit):
                continue
            lo, hi = np.searchsorted(keys, key[hit]), np.searchsorted(keys, key[hit], "right")
            for h, a, b in zip(hit[hi > lo], lo[hi > lo], hi[hi > lo], strict=True):
                for e in range(a, b):
                    n = int(self.wo[items[e] + 1] - self.wo[items[e]])
                    # meetings of one occurrence differ by its edits: one window for all of them
                    found.add((int(who[at[h]]), int(items[e]), int(local[at[h]] - offs[e]) // max(1, n // 2)))
        best: dict = {}
        for d, it, block in sorted(found):
            item = self.names[self.wo[it]:self.wo[it + 1]]
            n, step = len(item), max(1, len(item) // 2)
            spare = int(MAX_EDITS * n)
            a = max(0, block * step - spare)
            window = names[wo[d] + a:min(wo[d + 1], wo[d] + (block + 1) * step + n + spare)]
            if len(set(item.tolist()).difference(window.tolist())) > MAX_EDITS * n:
                continue        # each of these words costs an edit
            dist, s, e = edit_distance_inside(item, window)
            if dist <= MAX_EDITS * n:
                best[d, it] = min(best.get((d, it), (1 << 30, 0, 0)), (dist, a + s, e - s))
        return [(d, it, *v) for (d, it), v in sorted(best.items())]


def item_blocks(benchmark: DataFrame, item_id: str, text: str):
    """Indexes over all items, in blocks of at most ``BLOCK_WORDS`` words (or one item)."""
    ids, texts, words = [], [], 0
    for r in benchmark.where(F.col(text).isNotNull()).select(item_id, text).orderBy(item_id, text).toLocalIterator():
        ids.append(r[0]), texts.append(r[1])
        words += len(r[1].split())
        if words >= BLOCK_WORDS:
            yield Index(ids, texts)
            ids, texts, words = [], [], 0
    if ids:
        yield Index(ids, texts)


def hits(docs: DataFrame, benchmark: DataFrame, doc_id: str = "doc_id", text: str = "text",
         item_id: str = "item_id", item_text: str = "text") -> DataFrame:
    """(doc_id, item_id, edits, first_word, n_words) of every benchmark passage found in a document."""
    rows = docs.select(F.col(doc_id).alias("__id"), F.col(text).alias("__t"))
    kind, item_kind = rows.schema["__id"].dataType, benchmark.schema[item_id].dataType
    schema = T.StructType([T.StructField(doc_id, kind), T.StructField(item_id, item_kind), T.StructField("edits", T.IntegerType()),
                           T.StructField("first_word", T.LongType()), T.StructField("n_words", T.IntegerType())])
    out = None
    for index in item_blocks(benchmark, item_id, item_text):
        def search(batches, index=index):
            for batch in batches:
                buf, off = A.text_bytes(batch.column(1))
                got = [(i + d, *r) for i, j in A.slices(off) for d, *r in index.search(*A.cut(buf, off, i, j))]
                cols = list(zip(*got, strict=True)) if got else [()] * 5
                ids = batch.column(0)
                yield pa.RecordBatch.from_arrays([
                    ids.take(pa.array(cols[0], pa.int64())), pa.array([index.ids[i] for i in cols[1]], pa_type(item_kind)),
                    pa.array(cols[2], pa.int32()), pa.array(cols[3], pa.int64()), pa.array(cols[4], pa.int32())], schema.names)
        part = rows.mapInArrow(search, schema)
        out = part if out is None else out.unionByName(part)
    return out if out is not None else docs.sparkSession.createDataFrame([], schema)


def pa_type(kind: T.DataType) -> pa.DataType:
    from pyspark.sql.pandas.types import to_arrow_type
    return to_arrow_type(kind)


def clean(docs: DataFrame, benchmark: DataFrame, text: str = "text", item_id: str = "item_id", item_text: str = "text") -> DataFrame:
    """``docs`` without the documents that hold a benchmark passage; rows and columns are otherwise kept as they are."""
    text = next(c for c in docs.columns if c.lower() == text.lower())
    at, first = docs.columns.index(text), True
    for index in item_blocks(benchmark, item_id, item_text):
        if not first:
            docs = stage(docs.sparkSession, docs, "clean")      # the tasks of a block hold that block's index alone
        first = False

        def keep(batches, index=index):
            for batch in batches:
                buf, off = A.text_bytes(batch.column(at))
                ok = np.ones(batch.num_rows, bool)
                for i, j in A.slices(off):
                    ok[[i + h[0] for h in index.search(*A.cut(buf, off, i, j))]] = False
                yield batch.filter(pa.array(ok))
        docs = docs.mapInArrow(keep, docs.schema)
    return docs
