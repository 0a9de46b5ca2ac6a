"""Quality rules by line labelling: a linear-chain conditional random field.

Every line with a word is described by a few figures (length, symbols, case,
repetition). The field gives each line a state, content or boilerplate, by
Viterbi decoding over the document's line sequence; a document is retained when the
words of its content lines are at least ``MIN_CONTENT`` of all its words.

Weights are trained here by gradient ascent on the conditional likelihood
(forward-backward), on lines of a bounded sample of labelled documents: lines of good documents are
content, lines of bad documents boilerplate (weak labels: the field learns
which figures tell them apart). A text of more than ``RUN`` lines gives a run of ``RUN`` lines at a place that its id hashes to.
Texts that mix both are rare among the labelled ones, so the runs are also spliced, a good one between the halves of a bad
one or the other way round, and the field learns where a text changes its state. Base figures (characters, symbols, duplicate lines,
words in repeated windows) are exact counts over the whole text.

Defined cases: a null or empty text has zero counts and fails the base rule; a document
without labels to learn from is judged by the base rule alone; repeated rows
are judged alike; other columns of the input are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import arrays as A

SAMPLE = 800                # labelled documents of the fit: the smallest hashes of the id, as many good as bad
RUN = 100                   # lines in a row that a training document gives
WINDOW = 8                  # words of a repetition window
MIN_WORDS, MAX_REPEAT_PERCENT = 20, 30
MIN_CONTENT = 0.5
SYMBOLS = "#*$%&|<>"
ROUNDS, RATE, DECAY = 100, 0.1, 1e-3

_LINE_BREAK = np.zeros(256, bool)
_LINE_BREAK[10] = True


def _flag(chars) -> np.ndarray:
    out = np.zeros(256, np.int32)
    out[[c if isinstance(c, int) else ord(c) for c in chars]] = 1
    return out


_IS_SYMBOL, _IS_UPPER, _IS_DIGIT = _flag(SYMBOLS), _flag(range(65, 91)), _flag(range(48, 58))
_IS_MARK = _flag([b for b in range(33, 127) if not chr(b).isalnum()])
_IS_POINT = (1 - _flag(range(128, 192))) * ~A.IS_SPACE          # a code point of a word starts here
N_FIGURES = 9


def _sums(flags: np.ndarray, starts, ends):
    c = np.concatenate([[0], np.cumsum(flags, dtype=np.int64)])
    return c[ends] - c[starts]


class Lines:
    """Words and lines of a slice of texts, with the base figures of each text."""

    def __init__(self, buf: np.ndarray, off: np.ndarray):
        n = len(off) - 1
        ws, we, wo = A.tokens(buf, off)
        names, word_doc = A.word_names(buf, ws, we), A.owner(wo)
        self.n_words = np.diff(wo)
        self.word_chars = _sums(_IS_POINT[buf], off[:-1], off[1:])
        self.n_symbols = _sums(_IS_SYMBOL[buf], off[:-1], off[1:])
        self.n_repeat_words = self._repeats(names, wo, word_doc, n)
        ls, le, lo = A.tokens(buf, off, _LINE_BREAK)
        first, last = np.searchsorted(ws, ls), np.searchsorted(ws, le)
        full = last > first
        line_doc = A.owner(lo)[full]
        ls, le, first, last = ls[full], le[full], first[full], last[full]
        line_name = A.word_names(buf, ls, le)
        order = np.lexsort((line_name, line_doc))       # stable: the first of equal lines comes first
        again = np.zeros(len(order), bool)
        if len(order) > 1:
            again[order[1:]] = (line_name[order][1:] == line_name[order][:-1]) & (line_doc[order][1:] == line_doc[order][:-1])
        self.n_dup_lines = np.bincount(line_doc, again, n).astype(np.int64)
        self.line_doc, self.words = line_doc, last - first
        same = np.zeros(len(names), np.int32)
        same[1:] = (names[1:] == names[:-1]) & (word_doc[1:] == word_doc[:-1])
        w, size = self.words, np.maximum(le - ls, 1)
        share = lambda flags: _sums(flags[buf], ls, le) / size
        self.figures = np.column_stack([
            np.ones(len(w)), np.log1p(w) / 5, (w < 4).astype(float), np.minimum(_sums(_IS_SYMBOL[buf], ls, le) / w, 4),
            share(_IS_UPPER) * 4, share(_IS_DIGIT) * 4, np.minimum((_sums(_IS_MARK[buf], ls, le)) / w, 4),
            _sums(same, first, last) / w * 2, again.astype(float)]).reshape(-1, N_FIGURES)
        self.line_off = np.searchsorted(line_doc, np.arange(n + 1))

    @staticmethod
    def _repeats(names, wo, doc, n):
        """Words covered by windows that occur twice or more in their text."""
        if len(names) < WINDOW:
            return np.zeros(n, np.int64)
        win = A.window_names(names, WINDOW)
        at = np.flatnonzero(A.starts_inside(wo, WINDOW)[:len(win)])
        key = win[at] ^ A.mix(doc[at].astype(np.uint64) + A.U(1))      # a text of its own for equal windows
        order = np.argsort(key, kind="stable")
        same = key[order][1:] == key[order][:-1]
        twice = np.zeros(len(at), bool)
        twice[order[1:][same]] = True
        twice[order[:-1][same]] = True
        cover = np.zeros(len(names) + 1, np.int64)
        cover[at[twice]] += 1
        np.subtract.at(cover, at[twice] + WINDOW, 1)
        covered = np.cumsum(cover[:-1]) > 0
        return np.bincount(doc, covered, n).astype(np.int64)


def _pad(values: np.ndarray, line_off: np.ndarray, docs: np.ndarray):
    """(longest, docs, ...) array of line values in order, and the lengths."""
    size = np.diff(line_off)[docs]
    out = np.zeros((int(size.max(initial=0)), len(docs), *values.shape[1:]))
    for t in range(len(out)):
        live = size > t
        out[t, live] = values[line_off[docs[live]] + t]
    return out, size


class Field:
    """Unary weights of boilerplate against content, and transition scores."""

    def __init__(self):
        self.w, self.t = np.zeros(N_FIGURES), np.zeros((2, 2))
        self.trained = False

    def train(self, seqs: list[np.ndarray], labels: list[np.ndarray], rounds: int = ROUNDS) -> None:
        """Gradient ascent on the mean log-likelihood of the line states (Adam); ``labels``: a state per line."""
        if len(np.unique(np.concatenate(labels))) < 2 if labels else True:
            return
        line_off = np.concatenate([[0], np.cumsum([len(s) for s in seqs])])
        x, size = _pad(np.concatenate(seqs), line_off, np.arange(len(seqs)))
        y = _pad(np.concatenate(labels), line_off, np.arange(len(seqs)))[0].astype(np.int64)
        live = np.arange(len(x))[:, None] < size
        pair = live[1:]
        seen = np.eye(2)[y[:-1]][..., :, None] * np.eye(2)[y[1:]][..., None, :]     # 1 at (state, next state)
        total = live.sum()
        m, v = [np.zeros_like(self.w), np.zeros_like(self.t)], [np.zeros_like(self.w), np.zeros_like(self.t)]
        for step in range(1, rounds + 1):
            u = np.zeros((*x.shape[:2], 2))
            u[..., 1] = x @ self.w
            alpha, beta = self._forward(u, live), self._backward(u, live)
            post = alpha + beta
            post -= post.max(-1, keepdims=True)
            post = np.exp(post)
            post /= post.sum(-1, keepdims=True)
            gw = (((y == 1) - post[..., 1]) * live)[..., None] * x
            joint = alpha[:-1, :, :, None] + self.t + (u[1:] + beta[1:])[:, :, None, :]
            joint -= joint.max((-2, -1), keepdims=True)
            joint = np.exp(joint)
            joint /= joint.sum((-2, -1), keepdims=True)
            gt = ((seen - joint) * pair[:, :, None, None]).sum((0, 1))
            for i, (p, g) in enumerate(((self.w, gw.sum((0, 1))), (self.t, gt))):
                g = g / total - DECAY * p
                m[i], v[i] = 0.9 * m[i] + 0.1 * g, 0.99 * v[i] + 0.01 * g * g
                p += RATE * (m[i] / (1 - 0.9 ** step)) / (np.sqrt(v[i] / (1 - 0.99 ** step)) + 1e-9)
        self.trained = True

    def _forward(self, u, live):
        a = u.copy()
        for t in range(1, len(u)):
            step = np.logaddexp(a[t - 1, :, 0:1] + self.t[0], a[t - 1, :, 1:2] + self.t[1]) + u[t]
            a[t] = np.where(live[t][:, None], step, a[t - 1])
        return a

    def _backward(self, u, live):
        b = np.zeros_like(u)
        for t in range(len(u) - 2, -1, -1):
            nxt = u[t + 1] + b[t + 1]
            step = np.logaddexp(self.t[:, 0] + nxt[:, 0:1], self.t[:, 1] + nxt[:, 1:2])
            b[t] = np.where(live[t + 1][:, None], step, 0)
        return b

    def viterbi(self, figures: np.ndarray, line_off: np.ndarray) -> np.ndarray:
        """Best state of every line (1: boilerplate; ties: content), all texts side by side, longest first."""
        state = np.zeros(len(figures), np.int8)
        size = np.diff(line_off)
        order = np.argsort(-size, kind="stable")
        order = order[size[order] > 0]
        if not len(order):
            return state
        u = figures @ self.w
        live_at = np.searchsorted(-size[order], -np.arange(1, size[order[0]] + 1), "right")     # texts with a line t
        at = line_off[order]
        score = np.zeros((len(order), 2))
        score[:, 1] = u[at]
        came = [None]
        for t in range(1, len(live_at)):
            k = live_at[t]
            prev = score[:k]
            to = prev[:, :, None] + self.t
            best = to[:, 1, :] > to[:, 0, :]
            came.append(best.astype(np.int8))
            step = np.where(best, to[:, 1, :], to[:, 0, :])
            step[:, 1] += u[at[:k] + t]
            score[:k] = step
        now = (score[:, 1] > score[:, 0]).astype(np.int8)
        for t in range(len(live_at) - 1, -1, -1):
            k = live_at[t]
            state[at[:k] + t] = now[:k]
            if t:
                now[:k] = came[t][np.arange(k), now[:k]]
        return state


def fit(docs: DataFrame, labels: DataFrame, label: str = "quality", doc_id: str = "doc_id", text: str = "text", sample: int = SAMPLE) -> Field:
    """Learn from at most ``sample`` labelled documents, half of them of either label."""
    spark = docs.sparkSession
    known = labels.where(F.col(doc_id).isNotNull() & F.col(label).isin(0, 1)).select(F.col(doc_id).alias("__id"), F.col(label).alias("__y"))
    chosen = [r for y in (0, 1) for r in known.where(F.col("__y") == y).orderBy(F.xxhash64("__id"), "__id").limit(sample // 2).collect()]
    ids = spark.createDataFrame(chosen, "__id long, __y int").distinct()
    rows = docs.select(F.col(doc_id).cast("long").alias("__id"), F.col(text).alias("__t")).join(F.broadcast(ids), "__id")   # at most ``sample`` ids

    def figures(batches):
        for b in batches:
            buf, off = A.text_bytes(b.column(1))
            for i, j in A.slices(off):
                lines = Lines(*A.cut(buf, off, i, j))
                per = []
                for k in range(j - i):
                    first, last = int(lines.line_off[k]), int(lines.line_off[k + 1])
                    first += int(A.mix(np.array([b.column(0)[i + k].as_py()], np.int64).view(np.uint64))[0] % A.U(max(1, last - first - RUN + 1)))
                    per.append(lines.figures[first:min(last, first + RUN)].astype(np.float32).tobytes())
                yield pa.RecordBatch.from_arrays([b.column(0).slice(i, j - i), b.column(2).slice(i, j - i), pa.array(per, pa.binary())], ["id", "y", "x"])

    # one text of an id and label, so that an id that many rows share brings one row to the driver
    per_id = rows.mapInArrow(figures, "id long, y int, x binary").groupBy("id", "y").agg(F.min("x").alias("x"))
    got = sorted((r[0], r[1], bytes(r[2])) for r in per_id.collect())
    field = Field()
    seqs = [(np.frombuffer(x, np.float32).reshape(-1, N_FIGURES).astype(float), 1 - y) for _, y, x in got if x]
    seqs += splices(seqs)
    field.train([x for x, _ in seqs], [np.full(len(x), y) if np.ndim(y) == 0 else y for x, y in seqs])
    return field


def splices(seqs: list[tuple[np.ndarray, int]]) -> list[tuple[np.ndarray, np.ndarray]]:
    """Each good run with a bad one: the shorter stands between the halves of the longer."""
    out = []
    for (good, _), (bad, _) in zip([s for s in seqs if s[1] == 0], [s for s in seqs if s[1] == 1], strict=False):
        (outer, o), (inner, i) = ((good, 0), (bad, 1)) if len(good) >= len(bad) else ((bad, 1), (good, 0))
        half = len(outer) // 2
        out.append((np.concatenate([outer[:half], inner, outer[half:]]), np.repeat([o, i, o], [half, len(inner), len(outer) - half])))
    return out


OUT = [("n_words", "long"), ("word_chars", "long"), ("n_symbols", "long"), ("n_dup_lines", "long"), ("n_repeat_words", "long"),
       ("content_share", "double"), ("base_failed", "boolean"), ("kept", "boolean")]


def judge(docs: DataFrame, field: Field, text: str = "text") -> DataFrame:
    """``docs`` with the base figures, the share of words in content lines, ``base_failed`` and ``kept`` (input columns of those names are replaced)."""
    docs = docs.drop(*[n for n, _ in OUT])
    text = next(c for c in docs.columns if c.lower() == text.lower())
    kinds = {"long": T.LongType(), "double": T.DoubleType(), "boolean": T.BooleanType()}
    at = docs.columns.index(text)

    def rows(batches):
        for batch in batches:
            buf, off = A.text_bytes(batch.column(at))
            for i, j in A.slices(off):
                x = Lines(*A.cut(buf, off, i, j))
                bad = x.n_words < MIN_WORDS
                bad |= 100 * x.n_repeat_words > MAX_REPEAT_PERCENT * x.n_words
                content = np.ones(j - i)
                if field.trained:
                    good = np.bincount(x.line_doc, x.words * (field.viterbi(x.figures, x.line_off) == 0), j - i)
                    content = np.where(x.n_words > 0, good / np.maximum(x.n_words, 1), 0.0)
                values = [x.n_words, x.word_chars, x.n_symbols, x.n_dup_lines, x.n_repeat_words, content, bad, ~bad & (content >= MIN_CONTENT)]
                yield pa.RecordBatch.from_arrays([*batch.slice(i, j - i).columns, *[pa.array(v) for v in values]],
                                                 [*batch.schema.names, *[n for n, _ in OUT]])

    return docs.mapInArrow(rows, T.StructType([*docs.schema.fields, *[T.StructField(n, kinds[k]) for n, k in OUT]]))
