"""Target-distribution importance resampling with hashed n-gram features.

Words are runs of ASCII letters and digits (A-Z lower-cased) and of all other characters beyond ASCII. Features are all
runs of one to three words, joined by a blank; a feature's bucket is the CRC-32 of its bytes modulo 10,000. Bucket
totals of all documents and of the target give each bucket a gain, a document's weight is the sum of its features'
gains, and a seeded Gumbel term turns the weights into a draw without replacement.

No feature is hashed byte by byte as long as its words are frequent. The head of the vocabulary is broadcast: the
CRC states of the most frequent words, and state and bucket of the most frequent pairs of them. The CRC of a
longer run follows from the states of its parts, as appending a word of L bytes is a linear map on the state that
depends on L alone. Features that hold a word of the tail are hashed directly. Both ways give the same numbers, so the
head only decides how fast a feature is hashed, never what its bucket is.
"""

from __future__ import annotations

import math
import zlib
from dataclasses import dataclass
from hashlib import sha256

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import arrays as A
from .common import stage
from .places import indexed

BUCKETS = 10_000
HEAD_WORDS = 32_768     # words whose states are broadcast
PAIR_WORDS = 512        # words whose pairs are counted
HEAD_PAIRS = 65_536     # pairs whose states and buckets are broadcast
LONGEST = 63            # bytes of a word of the head
MIN_WORDS = 20          # words of a document that can be drawn

BREAKS = np.ones(256, bool)
BREAKS[48:58] = BREAKS[97:123] = BREAKS[128:] = False


# --- CRC-32 on arrays -----------------------------------------------------------------------------
def _byte_steps() -> np.ndarray:
    """Effect of one byte on the CRC-32 register (reflected polynomial 0xEDB88320)."""
    c = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        c = np.where(c & 1, (c >> 1) ^ np.uint32(0xEDB88320), c >> 1)
    return c


STEP = _byte_steps()


def _shifts(longest: int) -> np.ndarray:
    """[length, byte of the state, value] -> part of the state after ``length`` zero bytes (a linear map)."""
    out = np.zeros((longest + 1, 4, 256), np.uint32)
    for k in range(4):
        out[0, k] = np.arange(256, dtype=np.uint32) << np.uint32(8 * k)
    for n in range(longest):
        out[n + 1] = STEP[out[n] & 255] ^ (out[n] >> np.uint32(8))
    return out


SHIFT = _shifts(LONGEST + 1)


def joined(state: np.ndarray, crc: np.ndarray, length: np.ndarray) -> np.ndarray:
    """CRC of x + y from the CRCs of x and y and the bytes of y (at most LONGEST + 1)."""
    out = crc.copy()
    for k in range(4):
        out ^= SHIFT[length, k, (state >> np.uint32(8 * k)) & np.uint32(255)]
    return out


def direct(buf: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """CRC of each span of bytes: all spans step by step together, long spans one by one."""
    out, size = np.empty(len(starts), np.uint32), ends - starts
    far = np.flatnonzero(size > 256)
    for i in far:
        out[i] = zlib.crc32(buf[starts[i]:ends[i]])
    near = np.flatnonzero(size <= 256)
    near = near[np.argsort(-size[near], kind="stable")]
    at, left, c = starts[near], size[near], np.full(len(near), 0xFFFFFFFF, np.uint32)
    live = np.searchsorted(-left, -np.arange(1, 258), "right")       # spans that have a k-th byte
    for k in range(int(left[0]) if len(near) else 0):
        n = live[k]
        c[:n] = STEP[(c[:n] ^ buf[at[:n] + k]) & np.uint32(255)] ^ (c[:n] >> np.uint32(8))
    out[near] = ~c
    return out


# --- texts ----------------------------------------------------------------------------------------
@dataclass
class Words:
    """Words of a slice of texts: one buffer in which a blank follows every word."""

    buf: np.ndarray
    starts: np.ndarray
    ends: np.ndarray
    offsets: np.ndarray         # words of text d: offsets[d]:offsets[d + 1]

    def strings(self) -> pa.Array:
        size = self.ends - self.starts
        off = np.r_[0, np.cumsum(size)].astype(np.int64)
        body = self.buf[np.repeat(self.starts - off[:-1], size) + np.arange(off[-1])]
        return pa.Array.from_buffers(pa.large_binary(), len(size), [None, pa.py_buffer(off), pa.py_buffer(body)])


def words_of(buf: np.ndarray, off: np.ndarray) -> Words:
    low = A.LOWER[buf]
    starts, ends, offsets = A.tokens(low, off, BREAKS)
    size = ends - starts + 1                                      # with the blank
    to = np.r_[0, np.cumsum(size)].astype(np.int64)
    flat = low[np.minimum(np.repeat(starts - to[:-1], size) + np.arange(to[-1]), max(len(low) - 1, 0))]
    flat[to[1:] - 1] = 32
    return Words(flat, to[:-1], to[1:] - 1, offsets)


def _slices(column):
    buf, off = A.text_bytes(column)
    for i, j in A.slices(off):
        yield i, words_of(*A.cut(buf, off, i, j))


# --- head -----------------------------------------------------------------------------------------
@dataclass
class Head:
    """Broadcast part of the vocabulary: at most HEAD_WORDS words and HEAD_PAIRS pairs, whatever the input."""

    words: pa.Array             # most frequent first
    crc: np.ndarray             # CRC of the word
    open: np.ndarray            # CRC of the word and a blank
    size: np.ndarray            # bytes of the word
    pair_crc: np.ndarray        # [first * PAIR_WORDS + second] CRC of the pair
    pair_bucket: np.ndarray     # its bucket, -1 where the pair is not of the head

    @classmethod
    def of(cls, words: list[bytes], pairs: list[tuple[int, int]]) -> Head:
        n = len(words)
        crc = np.fromiter((zlib.crc32(w) for w in words), np.uint32, n)
        blank = np.fromiter((zlib.crc32(w + b" ") for w in words), np.uint32, n)
        pair_crc, pair_bucket = np.zeros(PAIR_WORDS ** 2, np.uint32), np.full(PAIR_WORDS ** 2, -1, np.int32)
        for a, b in pairs:
            pair_crc[a * PAIR_WORDS + b] = c = zlib.crc32(words[a] + b" " + words[b])
            pair_bucket[a * PAIR_WORDS + b] = c % BUCKETS
        return cls(pa.array(words, pa.large_binary()), crc, blank, np.fromiter(map(len, words), np.int64, n), pair_crc, pair_bucket)

    def find(self, w: Words) -> np.ndarray:
        """Place of each word in the head, -1 for the tail (the words themselves are compared)."""
        if not len(self.words) or not len(w.starts):
            return np.full(len(w.starts), -1, np.int64)
        return pc.fill_null(pc.index_in(w.strings(), value_set=self.words), -1).to_numpy(zero_copy_only=False).astype(np.int64)


def buckets(w: Words, head: Head) -> list[tuple[np.ndarray, np.ndarray]]:
    """For runs of 1, 2 and 3 words: (first word, bucket) of every feature."""
    at, n, out = head.find(w), len(w.starts), []
    if not n:
        return out
    known = at >= 0
    safe = np.where(known, at, 0)
    if len(head.words):
        crc, size, blank = head.crc[safe], head.size[safe], head.open[safe]
    else:
        crc, size, blank = np.zeros(n, np.uint32), np.zeros(n, np.int64), np.zeros(n, np.uint32)
    single = crc.copy()
    tail = np.flatnonzero(~known)
    single[tail] = direct(w.buf, w.starts[tail], w.ends[tail])
    out.append((np.arange(n), (single % BUCKETS).astype(np.int64)))

    first = np.flatnonzero(A.starts_inside(w.offsets, 2))
    both = known[first] & known[first + 1]
    pair, slot = np.zeros(n, np.uint32), np.zeros(n, np.int64)
    h = first[both]
    frequent = (at[h] < PAIR_WORDS) & (at[h + 1] < PAIR_WORDS)
    code = np.where(frequent, at[h] * PAIR_WORDS + at[h + 1], 0)
    frequent &= head.pair_bucket[code] >= 0
    f, code = h[frequent], code[frequent]
    pair[f], slot[f] = head.pair_crc[code], head.pair_bucket[code]
    m = h[~frequent]
    pair[m] = joined(blank[m], crc[m + 1], size[m + 1])
    slot[m] = pair[m] % BUCKETS
    t = first[~both]
    slot[t] = direct(w.buf, w.starts[t], w.ends[t + 1]) % BUCKETS
    out.append((first, slot[first]))

    first = np.flatnonzero(A.starts_inside(w.offsets, 3))
    every = known[first] & known[first + 1] & known[first + 2]
    h, t, slot = first[every], first[~every], np.zeros(n, np.int64)
    space = np.full(len(h), zlib.crc32(b" "), np.uint32)
    state = joined(pair[h], space, np.ones(len(h), np.int64))                       # pair and a blank
    slot[h] = joined(state, crc[h + 2], size[h + 2]) % BUCKETS
    slot[t] = direct(w.buf, w.starts[t], w.ends[t + 2]) % BUCKETS
    out.append((first, slot[first]))
    return out


def _word_counts(batches):
    for batch in batches:
        for _, w in _slices(batch.column("text")):
            short = w.strings()
            short = short.filter(pc.less_equal(pc.binary_length(short), LONGEST))
            found = short.value_counts()
            yield pa.record_batch({"word": found.field("values").cast(pa.binary()), "n": found.field("counts")})


def _pair_counts(words: Head):
    def count(batches):
        total = np.zeros(PAIR_WORDS ** 2, np.int64)             # bounded, so one vector serves the whole task
        for batch in batches:
            for _, w in _slices(batch.column("text")):
                at, first = words.find(w), np.flatnonzero(A.starts_inside(w.offsets, 2))
                a, b = at[first], at[first + 1]
                ok = (a >= 0) & (b >= 0)
                total += np.bincount(a[ok] * PAIR_WORDS + b[ok], minlength=len(total))
        cell = np.flatnonzero(total)
        yield pa.record_batch({"cell": cell, "n": total[cell]})
    return count


def head_of(texts: DataFrame, n_words: int = HEAD_WORDS, n_pairs: int = HEAD_PAIRS) -> Head:
    """The head from counts over all texts (column ``text``): words, then pairs of the most frequent words."""
    counts = texts.mapInArrow(_word_counts, "word binary, n long").groupBy("word").agg(F.sum("n").alias("n"))
    words = [bytes(r.word) for r in _most(counts, "word", n_words)]
    first = Head.of(words[:PAIR_WORDS], [])
    cells = texts.mapInArrow(_pair_counts(first), "cell long, n long").groupBy("cell").agg(F.sum("n").alias("n"))
    return Head.of(words, [divmod(r.cell, PAIR_WORDS) for r in _most(cells, "cell", n_pairs)])


def _most(counts: DataFrame, key: str, limit: int) -> list:
    """Rows with the largest counts, at most ``limit``, in order: whole steps of the logarithm of the count.

    The cut comes from a table of a few hundred steps, so no partition sends its own first rows to the driver.
    """
    counts = stage(counts.sparkSession, counts.withColumn("step", F.floor(F.log2("n") * 16)), "resample-counts")
    cut, taken = None, 0
    for r in counts.groupBy("step").agg(F.count(F.lit(1)).alias("rows")).orderBy(F.desc("step")).collect():
        taken += r["rows"]
        if taken > limit:
            break
        cut = r.step
    rows = counts.where(F.col("step") >= cut).collect() if cut is not None else []
    return sorted(rows, key=lambda r: (-r.n, r[key]))


# --- totals and weights ---------------------------------------------------------------------------
def totals(texts: DataFrame, head: Head) -> np.ndarray:
    """Features in each bucket, over all texts (10,000 rows come to the driver)."""
    shared = texts.sparkSession.sparkContext.broadcast(head)

    def count(batches):
        total = np.zeros(BUCKETS, np.int64)
        for batch in batches:
            for _, w in _slices(batch.column("text")):
                for _, slot in buckets(w, shared.value):
                    total += np.bincount(slot, minlength=BUCKETS)
        at = np.flatnonzero(total)
        yield pa.record_batch({"bucket": at, "n": total[at]})
    out = np.zeros(BUCKETS, np.int64)
    for r in texts.mapInArrow(count, "bucket long, n long").groupBy("bucket").agg(F.sum("n").alias("n")).collect():
        out[r.bucket] = r.n
    return out


def gains(source: np.ndarray, target: np.ndarray) -> np.ndarray:
    """floor(1000 ln((t + 1)(S + buckets) / ((s + 1)(T + buckets)))) of each bucket, in doubles."""
    s_all, t_all = float(source.sum() + BUCKETS), float(target.sum() + BUCKETS)
    return np.array([math.floor(1000 * math.log(float(t + 1) * s_all / (float(s + 1) * t_all))) for s, t in zip(source, target, strict=True)], np.int64)


def luck(seed: str, row_id) -> int:
    """Gumbel term of a row: floor(-1000 ln(-ln u)), u from the first 8 hex digits of sha256(seed:id)."""
    h = int(sha256(f"{seed}:{'' if row_id is None else row_id}".encode()).hexdigest()[:8], 16)
    return math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))


@dataclass
class Model:
    head: Head
    gain: np.ndarray


def fit(docs: DataFrame, target: DataFrame, text_col: str = "text") -> Model:
    """Gains of ``target`` against ``docs``: both are read whole."""
    texts = docs.select(F.col(text_col).cast("string").alias("text"))
    head = head_of(texts)
    return Model(head, gains(totals(texts, head), totals(target.select(F.col(text_col).cast("string").alias("text")), head)))


def weigh(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text", seed: str = "42") -> DataFrame:
    """``docs`` with struct column ``__w`` (n_words, n_features, weight, score), all long.

    A null or empty text has no features and the weight 0. Other columns, whatever their names, pass through.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)
    keep = [c for c in docs.columns if c != "__w"]

    def run(batches):
        gain, head = shared.value.gain, shared.value.head
        for batch in batches:
            size = batch.num_rows
            out = {k: np.zeros(size, np.int64) for k in ("n_words", "n_features", "weight")}
            for i, w in _slices(batch.column(batch.num_columns - 1)):
                n = len(w.offsets) - 1
                of = A.owner(w.offsets)
                out["n_words"][i:i + n] = np.diff(w.offsets)
                for first, slot in buckets(w, head):
                    out["n_features"][i:i + n] += np.bincount(of[first], minlength=n)
                    running = np.r_[0, np.cumsum(gain[slot])]
                    edge = np.searchsorted(first, w.offsets)
                    out["weight"][i:i + n] += running[edge[1:]] - running[edge[:-1]]
            out["score"] = out["weight"] + np.fromiter((luck(seed, x) for x in batch.column(batch.num_columns - 2).to_pylist()), np.int64, size)
            made = pa.StructArray.from_arrays([pa.array(v) for v in out.values()], list(out))
            yield pa.RecordBatch.from_arrays([*batch.columns[:-2], made], names=[*batch.schema.names[:-2], "__w"])
    # ids and texts are appended once more, so that their columns may have any name and type
    given = docs.select(*[F.col(f"`{c}`") for c in keep], F.col(id_col).cast("string").alias("__id"), F.col(text_col).cast("string").alias("__text"))
    from pyspark.sql.types import LongType, StructField, StructType
    made = StructType([StructField(k, LongType()) for k in ("n_words", "n_features", "weight", "score")])
    return given.mapInArrow(run, StructType([*given.schema.fields[:-2], StructField("__w", made)]))


def _order(id_col: str) -> list[Column]:
    return [F.desc("__w.score"), F.col(id_col).asc_nulls_first()]


def ranked(docs: DataFrame, model: Model, share: tuple[int, int] = (5, 100), id_col: str = "doc_id", text_col: str = "text", seed: str = "42",
           min_words: int = MIN_WORDS) -> DataFrame:
    """(id, n_features, weight, score, rank) of every row; ``rank`` (from 1) is null where the row is not drawn.

    Rows with at least ``min_words`` words take part; the share (rounded down) with the highest scores is drawn, ties
    to the smaller id (null first; rows that repeat an id and a score in any order).
    """
    scored = weigh(docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")), model, "id", "text", seed).drop("text")
    placed = indexed(scored.withColumn("__g", F.col("__w.n_words") >= min_words), "__g", _order("id"))
    drawn = F.col("__g") & (F.col("__i") < F.expr(f"__n * {share[0]} div {share[1]}"))
    return placed.select(F.col("id").alias(id_col), "__w.n_features", "__w.weight", "__w.score", F.when(drawn, F.col("__i") + 1).alias("rank"))


def draw(docs: DataFrame, model: Model, share: tuple[int, int] = (5, 100), id_col: str = "doc_id", text_col: str = "text", seed: str = "42",
         min_words: int = MIN_WORDS, rank: str = "rank") -> DataFrame:
    """The rows of ``docs`` that are drawn, with all columns and their rank (an input column of that name is replaced).

    Texts are not shuffled but for the drawn ones: the narrow ranking gives the lowest score that is drawn.
    """
    spark, names = docs.sparkSession, docs.columns
    own = docs.toDF(*[f"c{k}" for k in range(len(names))])                   # so no name of ``docs`` can clash with ours
    row_id, text = (f"c{names.index(c)}" for c in (id_col, text_col))
    order = stage(spark, ranked(own, model, share, row_id, text, seed, min_words), "resample-ranks").where(F.col("rank").isNotNull())
    n, low = order.agg(F.count(F.lit(1)), F.min("score")).first()
    rows = weigh(own, model, row_id, text, seed).where((F.col("__w.n_words") >= min_words) & (F.col("__w.score") >= (low or 0)) & F.lit(n > 0))
    placed = indexed(rows.withColumn("__g", F.lit(True)), "__g", _order(row_id)).where(F.col("__i") < n)
    return placed.select(*[F.col(f"c{k}").alias(c) for k, c in enumerate(names) if c != rank], (F.col("__i") + 1).alias(rank))
