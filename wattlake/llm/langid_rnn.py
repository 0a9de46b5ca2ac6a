"""Language id: a bidirectional gated recurrent network over bytes, in numpy.

Each direction is a gated unit (update gate and candidate state, softsign activations) fed
with one learned column per byte. Both states at a position give that position's
language probabilities; a document's probabilities are the mean over all its
positions. Training is backpropagation through time with Adam on segments of
a bounded sample (``SAMPLE`` documents per language, one span each, spans at a hashed place
of the text). Whole texts are read in segments of ``STEPS`` bytes whose states
start at zero; padding keeps the state unchanged.

Defined cases: a null text or one without a letter is ``und`` with score 0;
without any training row every text is ``und``; equal texts get equal
answers; other columns of the input are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import arrays as A

SAMPLE, SPAN = 600, 384         # training documents per language; characters of each span
MAX_LANGS = 256                 # languages of one model: those with the most rows
HIDDEN, STEPS, LANES = 8, 96, 4096
ROUNDS, BATCH, RATE = 160, 384, 0.02
PAD = 256
UND = "und"


class Network:
    """Parameters are float32 arrays; a few tens of KB, shipped with the task."""

    def __init__(self, langs: list[str], seed: int = 7):
        rng = np.random.default_rng(seed)
        h, k = HIDDEN, len(langs)
        self.langs = langs
        self.p = {}
        for d in "fb":
            self.p["E" + d] = rng.normal(0, 0.3, (2 * h, 257)).astype(np.float32)
            self.p["U" + d] = rng.normal(0, 0.3 / np.sqrt(h), (2 * h, h)).astype(np.float32)
            self.p["W" + d] = rng.normal(0, 0.3, (k, h)).astype(np.float32)
            self._pad(d)
        self.p["c"] = np.zeros((k, 1), np.float32)

    def _pad(self, d):
        self.p["E" + d][:, PAD] = 0
        self.p["E" + d][:HIDDEN, PAD] = -1e7    # the gate stays shut: padding keeps the state

    def states(self, x: np.ndarray, d: str, keep: bool = False):
        """x: (STEPS, lanes) bytes -> (STEPS, hidden, lanes) states, and what training needs."""
        E, U = self.p["E" + d], self.p["U" + d]
        steps, n = x.shape
        h, out = np.zeros((HIDDEN, n), np.float32), np.empty((steps, HIDDEN, n), np.float32)
        zs, cs, pre = [], [], []
        order = range(steps) if d == "f" else range(steps - 1, -1, -1)
        g, r = np.empty((2 * HIDDEN, n), np.float32), np.empty((2 * HIDDEN, n), np.float32)
        for t in order:
            np.matmul(U, h, out=r)
            np.take(E, x[t], axis=1, out=g, mode="clip")
            g += r
            np.abs(g, out=r)
            r += np.float32(1)
            g /= r                              # softsign: as a tanh, at a tenth of the cost
            z, c = g[:HIDDEN] * np.float32(0.5), g[HIDDEN:]
            z += np.float32(0.5)
            if keep:
                zs.append(z), cs.append(c.copy()), pre.append(h)
            delta = c - h
            delta *= z
            h = np.add(h, delta, out=out[t])
        return (out, zs, cs, pre, list(order)) if keep else out

    def logits(self, hf, hb):
        """(languages, steps, lanes)."""
        f = np.einsum("kh,thn->ktn", self.p["Wf"], hf, optimize=True)
        return f + np.einsum("kh,thn->ktn", self.p["Wb"], hb, optimize=True) + self.p["c"][:, :, None]

    def probabilities(self, x: np.ndarray) -> np.ndarray:
        """(languages, steps, lanes) label probabilities of every position."""
        s = self.logits(self.states(x, "f"), self.states(x, "b"))
        s -= s.max(0)
        np.exp(s, out=s)
        s /= s.sum(0)
        return s

    def gradients(self, x: np.ndarray, y: np.ndarray) -> dict[str, np.ndarray]:
        """Backpropagation through time of the mean cross-entropy over real positions."""
        kept = {d: self.states(x, d, keep=True) for d in "fb"}
        s = self.logits(kept["f"][0], kept["b"][0])
        s -= s.max(0)
        e = np.exp(s)
        e /= e.sum(0)
        real = (x != PAD).astype(np.float32)
        e[y, :, np.arange(len(y))] -= 1
        e *= real / max(real.sum(), 1)
        g = {"c": e.sum((1, 2))[:, None]}
        for d in "fb":
            out, zs, cs, pre, order = kept[d]
            W, U = self.p["W" + d], self.p["U" + d]
            g["W" + d] = np.einsum("ktn,thn->kh", e, out, optimize=True)
            dout = np.einsum("kh,ktn->thn", W, e, optimize=True)
            dU, dE, dh = np.zeros_like(U), np.zeros_like(self.p["E" + d]), 0
            for i in range(len(order) - 1, -1, -1):
                t, z, c, h = order[i], zs[i], cs[i], pre[i]
                dh = dh + dout[t]
                # z = (1 + s(a)) / 2 and c = s(b) with ds/da = (1 - |s|)^2
                da = np.concatenate([dh * (c - h) * 0.5 * (1 - np.abs(2 * z - 1)) ** 2, dh * z * (1 - np.abs(c)) ** 2])
                dU += da @ h.T
                for row in range(2 * HIDDEN):
                    dE[row] += np.bincount(x[t], da[row], 257)
                dh = dh * (1 - z) + U.T @ da
            g["U" + d], g["E" + d] = dU, dE
        return g

    def train(self, x: np.ndarray, y: np.ndarray, seed: int = 11) -> None:
        """x: (segments, STEPS) bytes with padding, y: language index of each."""
        rng = np.random.default_rng(seed)
        m = {k: np.zeros_like(v) for k, v in self.p.items()}
        v = {k: np.zeros_like(w) for k, w in self.p.items()}
        by = [np.flatnonzero(y == k) for k in range(len(self.langs))]
        for step in range(1, ROUNDS + 1):
            pick = np.concatenate([rng.choice(b, max(1, BATCH // len(by))) for b in by])     # languages in equal parts
            lanes = np.ascontiguousarray(x[pick].T)
            # a third of the lanes are cut short, as short texts are
            size = np.where(rng.random(len(pick)) < 0.33, rng.integers(3, STEPS, len(pick)), STEPS)
            lanes[np.arange(STEPS)[:, None] >= size] = PAD
            g = self.gradients(lanes, y[pick])
            rate = RATE * min(1, 2 * (1 - step / (ROUNDS + 1)))
            for k, p in self.p.items():
                d = np.clip(g[k], -1, 1).astype(np.float32)
                m[k] = 0.9 * m[k] + 0.1 * d
                v[k] = 0.99 * v[k] + 0.01 * d * d
                p -= (rate * (m[k] / (1 - 0.9 ** step)) / (np.sqrt(v[k] / (1 - 0.99 ** step)) + 1e-8)).astype(np.float32)
            self._pad("f"), self._pad("b")

    def documents(self, buf: np.ndarray, off: np.ndarray) -> np.ndarray:
        """(texts, languages) mean position probabilities; zero rows for empty texts."""
        x, who, size = segments(buf, off)
        total = np.zeros((len(off) - 1, len(self.langs)))
        for i in range(0, len(who), LANES):
            part = slice(i, i + LANES)
            steps = int(size[part].max())
            block = np.ascontiguousarray(x[part, :steps].T)
            p = self.probabilities(block)
            p *= block != PAD
            lane = p.sum(1, dtype=np.float64)
            for k in range(len(self.langs)):
                total[:, k] += np.bincount(who[part], lane[k], len(off) - 1)
        return total / np.maximum(np.diff(off), 1)[:, None]


def segments(buf: np.ndarray, off: np.ndarray):
    """Every byte of every text in rows of STEPS: (rows, text of the row, bytes in the row)."""
    n = np.diff(off)
    rows = -(-n // STEPS)
    who = np.repeat(np.arange(len(n)), rows)
    first = np.arange(len(who)) - np.repeat(np.cumsum(rows) - rows, rows)
    begin = off[:-1][who] + first * STEPS
    size = np.minimum(off[1:][who] - begin, STEPS)
    at = begin[:, None] + np.arange(STEPS)
    x = np.full(at.shape, PAD, np.int16)
    inside = np.arange(STEPS) < size[:, None]
    x[inside] = buf[at[inside]]
    order = np.argsort(-size, kind="stable")        # full rows together, so that short ones need fewer steps
    return x[order], who[order], size[order]


def fit(train: DataFrame, text: str = "text", lang: str = "lang", key: str = "doc_id", sample: int = SAMPLE, max_langs: int = MAX_LANGS) -> Network:
    """Learn from at most ``sample`` documents of each language, those with the smallest hashes of ``key``.

    The ``max_langs`` languages with the most rows are learned (ties by name), the bound of the fit: stray values of a dirty column
    beyond them are no classes. The hash threshold follows each
    language's own count, and the collected spans are bounded by languages x 2 x sample.
    """
    rows = train.where(F.col(lang).isNotNull() & F.col(text).rlike(r"\p{L}"))
    counts = sorted((r[0], r[1]) for r in rows.groupBy(lang).count().orderBy(F.desc("count"), lang).limit(max_langs).collect())
    u = (F.pmod(F.xxhash64(F.col(key).cast("string")), F.lit(1 << 30)) / float(1 << 30))
    wanted = F.lit(False)
    for name, n in counts:
        wanted = wanted | ((F.col(lang) == name) & (u <= min(1.0, 1.3 * sample / n)))
    place = 1 + F.pmod(F.xxhash64(F.col(key).cast("string"), F.lit("place")), F.greatest(F.length(text) - SPAN + 1, F.lit(1)))
    got = (rows.where(wanted).select(lang, u.alias("u"), F.substring(F.col(text), place.cast("int"), F.lit(SPAN)).alias("span"))
           .orderBy("u", "span").limit(2 * sample * max(1, len(counts))).collect())
    net = Network([c[0] for c in counts])
    if not got:
        return net
    index = {c[0]: i for i, c in enumerate(counts)}
    buf, off = A.text_bytes(pa.array([r[2] for r in got], pa.string()))
    x, who, _ = segments(buf, off)
    net.train(x, np.array([index[r[0]] for r in got])[who])
    return net


def predict(docs: DataFrame, net: Network, text: str = "text", lang_out: str = "lang_pred", score_out: str = "score") -> DataFrame:
    """``docs`` with the predicted language and its pooled probability (input columns of those names are replaced)."""
    docs = docs.drop(lang_out, score_out)
    text = next(c for c in docs.columns if c.lower() == text.lower())
    # one letter anywhere decides; the regular expression stops at the first
    fields, mark = docs.schema.fields, "__letters"
    while mark in docs.columns:
        mark += "_"
    docs = docs.withColumn(mark, F.coalesce(F.col(f"`{text}`").rlike(r"\p{L}"), F.lit(False)))

    def labelled(batches):
        for batch in batches:
            buf, off = A.text_bytes(batch.column(batch.schema.get_field_index(text)))
            letters = np.asarray(batch.column(batch.schema.get_field_index(mark)).to_numpy(zero_copy_only=False), bool)
            name, score = np.full(len(letters), UND, object), np.zeros(len(letters))
            for i, j in A.slices(off):
                if not net.langs:
                    break
                p = net.documents(*A.cut(buf, off, i, j))
                best = p.argmax(1)
                known = letters[i:j]
                name[i:j][known] = np.array(net.langs, object)[best[known]]
                score[i:j][known] = np.clip(p.max(1)[known], 0, 1)
            cols = [batch.column(batch.schema.get_field_index(f.name)) for f in fields]
            yield pa.RecordBatch.from_arrays([*cols, pa.array(name, pa.string()), pa.array(score, pa.float64())],
                                             [*[f.name for f in fields], lang_out, score_out])

    return docs.mapInArrow(labelled, T.StructType([*fields, T.StructField(lang_out, T.StringType()), T.StructField(score_out, T.DoubleType())]))
