"""Quality classifier: nearest-neighbour voting over latent-semantic vectors.

A text becomes a term vector of hashed words and hashed character trigrams (lower case), shape trigrams (bytes
mapped to letter case, digit, space and punctuation classes) and three repetition terms, with
logarithmic counts and inverse document frequencies; a truncated singular
value decomposition of labelled documents gives the latent space. The
labelled vectors (at most ``MAX_LABELLED``, the documented bound of the fit) are
broadcast, and every document's cosine with each of them is computed exactly in
blocks; the nearest ``NEIGHBOURS`` vote with their label, weighted by similarity.

Defined cases: a null or empty text has the zero vector and gets the mean label of the
sample; without any labelled row every score is 0.5; equal
texts get equal scores; equal label rows count once, and an id with several texts gives one of them; other columns of the
input are ignored. Ids are numbers, or texts that are numbers.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import arrays as A

MAX_LABELLED = 3000     # labelled rows of the fit: the ones with the smallest hash of the id
TERMS, DIMS, NEIGHBOURS = 2048, 32, 15
ROWS = 512              # documents of one block

# byte classes: space, newline, upper case, lower case or non-ASCII, digit, then each punctuation mark
_CLASS = np.full(256, 3, np.int64)
_CLASS[A.IS_SPACE] = 0
_CLASS[10], _CLASS[65:91], _CLASS[48:58] = 1, 2, 4
_MARKS = [b for b in range(33, 127) if not chr(b).isalnum()]
_CLASS[_MARKS] = np.arange(5, 5 + len(_MARKS))
_N = 5 + len(_MARKS)
# terms: words, character trigrams, shape trigrams, and three of repetition
WORD_TERMS, CHAR_TERMS = 512, 512
_SHAPES = WORD_TERMS + CHAR_TERMS
_TERM = (_SHAPES + A.mix(np.arange(_N ** 3, dtype=np.uint64) + A.U(7)) % A.U(TERMS - 3 - _SHAPES)).astype(np.int32)


def counts(buf: np.ndarray, off: np.ndarray) -> np.ndarray:
    """(texts, TERMS) raw term counts."""
    n = len(off) - 1
    if not len(buf):
        return np.zeros((n, TERMS), np.float32)
    low = A.LOWER[buf]
    starts, ends, wo = A.tokens(buf, off)
    names, who = A.word_names(low, starts, ends), A.owner(wo)
    at = [who * TERMS + (names % A.U(WORD_TERMS)).astype(np.int64)]
    if len(buf) > 2:
        c, x = _CLASS[buf], low.astype(np.int64)
        doc = np.repeat(np.arange(n, dtype=np.int64), np.diff(off))
        inside = doc[:-2] == doc[2:]
        row = doc[:-2][inside] * TERMS
        at.append(row + _TERM[((c[:-2] * _N + c[1:-1]) * _N + c[2:])[inside]])
        tri = ((x[:-2] << 16) | (x[1:-1] << 8) | x[2:])[inside] * 0x9E3779B1        # a multiplicative hash
        at.append(row + WORD_TERMS + ((tri >> 13) % CHAR_TERMS))
    out = np.bincount(np.concatenate(at), minlength=n * TERMS).astype(np.float32).reshape(n, TERMS)
    if len(names):
        same = np.r_[False, (names[1:] == names[:-1]) & (who[1:] == who[:-1])]
        out[:, TERMS - 3] = np.bincount(who, same, n)
        # words of a text seen before in it, by sorting (text, word) pairs
        order = np.lexsort((names, who))
        again = np.r_[False, (names[order][1:] == names[order][:-1]) & (who[order][1:] == who[order][:-1])]
        repeated = np.bincount(who[order], again, n)
        size = np.diff(wo)
        out[:, TERMS - 2] = np.where(repeated * 2 > size, repeated, 0)
    lines, who_l, _ = line_names(buf, off)
    if len(lines):
        order = np.lexsort((lines, who_l))
        again = np.r_[False, (lines[order][1:] == lines[order][:-1]) & (who_l[order][1:] == who_l[order][:-1])]
        out[:, TERMS - 1] = np.bincount(who_l[order], again, n) * 20
    return out


def line_names(buf, off):
    """Names and texts of the lines that hold a word."""
    starts, ends, wo = A.tokens(buf, off, _LINE_BREAK)
    full = np.add.reduceat((~A.IS_SPACE[buf]).astype(np.int32), starts) > 0 if len(starts) else np.zeros(0, bool)
    return A.word_names(buf, starts, ends)[full], A.owner(wo)[full], (starts[full], ends[full])


_LINE_BREAK = np.zeros(256, bool)
_LINE_BREAK[10] = True


def _rows(texts: Iterator[pa.RecordBatch], column: str):
    for batch in texts:
        buf, off = A.text_bytes(batch.column(column))
        for i in range(0, len(off) - 1, ROWS):
            j = min(i + ROWS, len(off) - 1)
            for a, b in A.slices(off[i:j + 1]):
                yield batch, i + a, i + b, counts(*A.cut(buf, off, i + a, i + b))


class Model:
    """Latent space and labelled vectors; a few hundred KB, shipped with the task. The counts ``x`` are overwritten: the driver holds them once."""

    def __init__(self, x: np.ndarray, y: np.ndarray):
        self.prior = float(y.mean()) if len(y) else 0.5
        self.y = y.astype(np.float32)
        if not len(y):
            return
        blocks = [x[i:i + ROWS] for i in range(0, len(x), ROWS)]
        self.idf = np.log((1 + len(x)) / (1 + sum((b > 0).sum(0) for b in blocks))).astype(np.float32) + 0.1
        for b in blocks:
            np.log1p(b, out=b)
            b *= self.idf
            b[:] = self._unit(b)
        vec = np.linalg.eigh(x.T @ x)[1]
        self.space = np.ascontiguousarray(vec[:, ::-1][:, :min(DIMS, len(y))]).astype(np.float32)
        self.points = self._unit(x @ self.space)

    @staticmethod
    def _unit(m):
        return m / np.maximum(np.linalg.norm(m, axis=1, keepdims=True), 1e-9)

    def score(self, x: np.ndarray) -> np.ndarray:
        if not len(self.y):
            return np.full(len(x), 0.5)
        v = self._unit(self._unit(np.log1p(x) * self.idf) @ self.space)
        sim = v @ self.points.T
        k = min(NEIGHBOURS, len(self.y))
        near = np.argpartition(-sim, k - 1, axis=1)[:, :k]
        w = np.maximum(np.take_along_axis(sim, near, 1), 0).astype(np.float64) ** 4
        total = w.sum(1)
        vote = np.where(total > 0, (w * self.y[near]).sum(1) / np.maximum(total, 1e-12), self.prior)
        return np.clip(np.where(x.any(1), vote, self.prior), 0, 1)


def fit(docs: DataFrame, labels: DataFrame, label: str = "quality", doc_id: str = "doc_id", text: str = "text",
        max_labelled: int = MAX_LABELLED) -> Model:
    """Learn from at most ``max_labelled`` rows of ``labels`` (non-null id and label) and their documents."""
    spark = docs.sparkSession
    chosen = (labels.where(F.col(doc_id).isNotNull() & F.col(label).isNotNull())
              .select(F.col(doc_id).alias("__id"), F.col(label).cast("double").alias("__y"))
              .orderBy(F.xxhash64("__id"), "__id", "__y").limit(max_labelled).collect())
    ids = spark.createDataFrame(chosen, "__id long, __y double")
    # the right side is bounded by max_labelled rows
    text_rows = docs.select(F.col(doc_id).cast("long").alias("__id"), F.col(text).alias("__t")).join(F.broadcast(ids), "__id")

    def term_rows(batches):
        for batch, i, j, x in _rows(batches, "__t"):
            yield pa.record_batch([batch.column("__id").slice(i, j - i), batch.column("__y").slice(i, j - i),
                                   pa.array([A.pack(r.astype(np.int64)) for r in x], pa.binary())], ["__id", "__y", "__x"])

    # one text of a labelled row, whatever share of the rows has its id: at most max_labelled rows come to the driver
    got = text_rows.mapInArrow(term_rows, "__id long, __y double, __x binary").groupBy("__id", "__y").agg(F.min("__x").alias("__x")).collect()
    got.sort(key=lambda r: (r[0], r[1], bytes(r[2])))
    x = np.empty((len(got), TERMS), np.float32)
    y = np.array([r[1] for r in got])
    for i in range(len(got) - 1, -1, -1):
        x[i] = A.unpack(bytes(got.pop()[2]))
    return Model(x, y)


def score(docs: DataFrame, model: Model, out: str = "score", text: str = "text") -> DataFrame:
    """``docs`` with a double column ``out`` (an input column of that name is replaced)."""
    docs = docs.drop(out)
    text = next(c for c in docs.columns if c.lower() == text.lower())

    def scored(batches):
        for batch in batches:
            parts = [model.score(x) for _, _, _, x in _rows([batch], text)]
            s = np.concatenate(parts) if parts else np.zeros(0)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(s, pa.float64())], [*batch.schema.names, out])

    return docs.mapInArrow(scored, T.StructType([*docs.schema.fields, T.StructField(out, T.DoubleType())]))
