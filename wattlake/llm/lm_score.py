"""Language-model scores with stupid backoff, as joins of n-gram counts.

Texts are exploded into n-grams (context, word); counts are kept in tables partitioned
by the hash of the context, so the count of an n-gram and the count of its context meet
the exploded n-grams of the same context in one exchange:
S(w | context) = c(context, w) / c(context) where the n-gram was seen, else
``BACKOFF`` times the score with a context one word shorter; the last level is c(w) / N.
Sums per document leave each partition and are added up by document.

Rows of the exchange are bundles: the distinct n-grams of a slice of about 4 MB of texts in
one hash partition, with their counts per document, as sorted arrays. An n-gram or
a context that stands in very many texts is one entry per slice, not one per occurrence.

With the documents as their own corpus every n-gram has been seen, so one
exchange does; with another corpus the unseen n-grams go on to the next level.

Defined cases: a null or empty text has 0 words and score 0 (mean null); an unseen word at the
last level counts as ``UNSEEN`` of a word; rows with the same id are one
document (a null id is one document too); an empty corpus scores every word as unseen in 1 word.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import arrays as A
from .common import parts_for

ORDER, BACKOFF, UNSEEN = 3, 0.4, 0.5
DOCS_PER_PART, LEAST_PARTS = 2000, 64
NULL_ID = -(1 << 63)
BUNDLE = "part long, kind int, data binary"
_START = A.U(0x5D7A2B1C9E3F4A61)        # name of the padding before a text
_CORPUS, _DOCS = 0, 1


def contexts(names: np.ndarray, word_off: np.ndarray, order: int) -> list[np.ndarray]:
    """Context names of every word for orders ``order``, ..., 1 (the last is the word's own identity under the root)."""
    n = len(names)
    place = np.arange(n) - np.repeat(word_off[:-1], np.diff(word_off))
    out = []
    for k in range(order, 0, -1):
        c = np.full(n, k, np.uint64)
        for back in range(k - 1, 0, -1):
            before = np.empty(n, np.uint64)
            before[back:] = names[:max(n - back, 0)]
            c = A.mix(c * A.U(0x9E3779B97F4A7C15) + np.where(place >= back, before, _START)[:n] if n else c)
        out.append(c)
    return out


def bundles(ctx: np.ndarray, word: np.ndarray, doc: np.ndarray, ids: np.ndarray, lower: list[np.ndarray], parts: int, kind: int):
    """(part, data) of the n-grams of a slice: distinct (context, word), with counts per text for documents.

    ``word`` is a 64-bit name of which 32 bits stand beside the 64 bits of the context.
    """
    w = (word >> A.U(32)).astype(np.uint32)
    order = np.lexsort((w, ctx))
    ctx, w, doc = ctx[order], w[order], doc[order]
    gram = A.heads(ctx, w)
    entry = A.heads(ctx, w, doc) if kind == _DOCS else gram
    cnt = A.runs(entry)
    at_entry = np.flatnonzero(entry)
    at_gram = np.flatnonzero(gram[at_entry])            # gram heads among entries
    g_ctx, g_w = ctx[at_entry][at_gram], w[at_entry][at_gram]
    head = A.heads(g_ctx)
    at_ctx = np.flatnonzero(head)
    edges = np.searchsorted(A.span(g_ctx, parts), np.arange(parts + 1))
    e_edges = np.r_[at_gram, len(at_entry)]
    rest = [x[order][at_entry][at_gram] for x in lower]
    docs_of = doc[at_entry]
    for p in np.flatnonzero(np.diff(edges)):
        a, b = edges[p], edges[p + 1]
        ea, eb = e_edges[a], e_edges[b]
        ca, cb = np.searchsorted(at_ctx, [a, b])
        fields = [*A.gaps(g_ctx[at_ctx[ca:cb]]), A.pack(np.diff(np.r_[at_ctx[ca:cb], b])), A.blob(g_w[a:b])]
        if kind == _DOCS:
            used, local = np.unique(ids[docs_of[ea:eb]], return_inverse=True)
            fields += [A.pack(np.diff(e_edges[a:b + 1])), A.pack(cnt[ea:eb]), A.pack(local), *A.gaps(used.view(np.uint64)), *[A.blob(r[a:b]) for r in rest]]
        else:
            fields += [A.pack(cnt[ea:eb])]
        yield int(p), A.frame(fields)


def explode(texts: DataFrame, order: int, level: int, parts: int, kind: int) -> DataFrame:
    """Bundles of the n-grams of ``texts`` (__id, __t) at ``level``; documents carry their lower contexts unless they are the corpus (kind 2)."""
    own = kind == 2

    def rows(batches):
        for batch in batches:
            buf, off = A.text_bytes(batch.column(1))
            ids = batch.column(0).fill_null(NULL_ID).to_numpy(zero_copy_only=False)
            for i, j in A.slices(off):
                part_buf, part_off = A.cut(buf, off, i, j)
                starts, ends, wo = A.tokens(part_buf, part_off)
                names = A.word_names(part_buf, starts, ends)
                all_ctx = contexts(names, wo, order)
                ctx = root_split(all_ctx[order - level], names, wo, level, order)
                lower = [] if kind != _DOCS else [names] + all_ctx[order - level + 1:]
                got = list(bundles(ctx, names, A.owner(wo), ids[i:j], lower, parts, _CORPUS if kind == _CORPUS else _DOCS))
                if kind != _CORPUS:
                    # every document is heard of once, with or without words
                    got.append((int(ids[i]) % parts, A.frame([A.blob(ids[i:j]), A.blob(np.diff(wo).astype(np.int64))])))
                yield pa.RecordBatch.from_arrays([
                    pa.array([g[0] for g in got], pa.int64()),
                    pa.array([kind] * (len(got) - (kind != _CORPUS)) + [3] * (kind != _CORPUS), pa.int32()),
                    pa.array([g[1] for g in got], pa.binary())], ["part", "kind", "data"])

    return texts.mapInArrow(rows, BUNDLE)


def root_split(ctx, names, word_off, level, order):
    """Contexts that every text shares (the start of a text, the empty one) are dealt by the word as well.

    Their own count is known without a group: the number of texts with a word, or the number of words.
    The last bit tells these contexts from the others.
    """
    if not len(ctx):
        return ctx
    place = np.arange(len(ctx)) - np.repeat(word_off[:-1], np.diff(word_off))
    shared = (place == 0) | (level == 1)
    return np.where(shared, A.mix(ctx ^ names) | A.U(1), ctx & ~A.U(1))


class _Grams:
    """The n-grams of several bundles side by side."""

    def __init__(self, data: list[bytes], kind: int):
        ctx, w, cnt, self.entry_doc, self.entry_cnt, self.entry_gram, self.ids, lower = [], [], [], [], [], [], [], []
        base = grams = 0
        for f in map(A.unframe, data):
            ctx.append(np.repeat(A.from_gaps(f[0], f[1]), A.unpack(f[2])))
            w.append(np.frombuffer(f[3], np.uint32))
            if kind == _CORPUS:
                cnt.append(A.unpack(f[4]))
            else:
                n, c, ids = A.unpack(f[4]), A.unpack(f[5]), A.from_gaps(f[7], f[8]).view(np.int64)
                gram = np.repeat(np.arange(len(n)), n)
                cnt.append(np.bincount(gram, c, len(n)).astype(np.int64))
                self.entry_doc.append(A.unpack(f[6]) + base)
                self.entry_cnt.append(c)
                self.entry_gram.append(gram + grams)
                self.ids.append(ids)
                lower.append([np.frombuffer(x, np.uint64) for x in f[9:]])
                base += len(ids)
                grams += len(n)
        join = lambda x, t: np.concatenate(x) if x else np.zeros(0, t)
        self.ctx, self.w, self.cnt = join(ctx, np.uint64), join(w, np.uint32), join(cnt, np.int64)
        self.entry_doc, self.entry_cnt, self.entry_gram = (join(x, np.int64) for x in (self.entry_doc, self.entry_cnt, self.entry_gram))
        self.ids = join(self.ids, np.int64)
        self.lower = [np.concatenate(x) for x in zip(*lower, strict=True)] if lower and lower[0] else []


def count_tables(g: _Grams):
    """(n-gram order, group of each ordered row, counts per group, context group of each group, counts per context)."""
    order = np.lexsort((g.w, g.ctx))
    head = A.heads(g.ctx[order], g.w[order])
    group = np.cumsum(head) - 1
    c3 = np.bincount(group, g.cnt[order], int(head.sum()))
    at = np.flatnonzero(head)
    ctx = g.ctx[order][at]
    chead = A.heads(ctx)
    cgroup = np.cumsum(chead) - 1
    c2 = np.bincount(cgroup, c3, int(chead.sum()))
    return order, group, c3, ctx, g.w[order][at], c2[cgroup]


def score(docs: DataFrame, corpus: DataFrame | None = None, doc_id: str = "doc_id", text: str = "text", corpus_text: str = "text",
          order: int = ORDER) -> DataFrame:
    """One row per document id: doc_id, n_words, log_score (sum of natural logs), mean_log_score."""
    rows = docs.select(F.col(doc_id).cast("long").alias("__id"), F.col(text).alias("__t"))
    own = corpus is None
    source = rows if own else corpus.select(F.lit(0).cast("long").alias("__id"), F.col(corpus_text).alias("__t"))
    word = F.col("__t").rlike(r"[^\x20\x09-\x0D]")
    size = rows.agg(F.count(F.lit(1)).alias("n")).first()[0]
    texts = source.agg(F.count(F.when(word, 1))).first()[0]
    words = None if own and order > 1 else source.agg(F.sum(F.regexp_count("__t", F.lit(r"[^\x20\x09-\x0D]+")))).first()[0] or 0
    parts = parts_for(max(size, 0 if own else source.count()), DOCS_PER_PART, LEAST_PARTS)
    sums = None
    asked = explode(rows, order, order, parts, 2 if own else _DOCS)
    for level in range(order, 0, -1):
        total = words if level == 1 else texts
        both = asked if own else asked.unionByName(explode(source, order, level, parts, _CORPUS))
        done = both.groupBy("part").applyInArrow(_join(level, order, own, total, parts), "part long, kind int, data binary")
        if not own:
            from .common import stage
            done = stage(docs.sparkSession, done, f"lm-level-{level}")
            asked = done.where("kind = 1")
        found = done.where("kind = 4").select("part", "data")
        sums = found if sums is None else sums.unionByName(found)
        if own:
            break
    out = sums.groupBy("part").applyInArrow(_add_up, "__id long, n_words long, log_score double")
    return out.select(F.when(F.col("__id") != NULL_ID, F.col("__id")).alias(doc_id), "n_words", "log_score",
                      F.when(F.col("n_words") > 0, F.col("log_score") / F.col("n_words")).alias("mean_log_score"))


def _join(level: int, order: int, own: bool, shared_total: int, parts: int):
    """Joins the n-grams of a hash partition to the counts of that partition."""
    back = (order - level) * math.log(BACKOFF)

    def run(group: pa.Table) -> pa.Table:
        kinds, data = group.column("kind").to_pylist(), group.column("data")
        pick = lambda *k: [data[i].as_py() for i, x in enumerate(kinds) if x in k]
        asked = _Grams(pick(_DOCS, 2), _DOCS)
        out = []
        if own:
            rank, grp, c3, ctx, _, c2 = count_tables(asked)
            base = np.where(ctx & A.U(1) == 1, max(shared_total, 1), c2)
            logp = np.empty(len(rank))
            logp[rank] = (np.log(c3) - np.log(base))[grp] if len(rank) else 0
            seen = np.ones(len(logp), bool)
        else:
            _, _, c3, ctx, w, c2 = count_tables(_Grams(pick(_CORPUS), _CORPUS))
            logp, seen = _look_up(asked, ctx, w, c3, np.where(ctx & A.U(1) == 1, max(shared_total, 1), c2))
            if level == 1:
                logp = np.where(seen, logp, math.log(UNSEEN / max(shared_total, 1)))
                seen = np.ones(len(logp), bool)
        hit = seen[asked.entry_gram]
        sums = np.bincount(asked.entry_doc[hit], (logp + back)[asked.entry_gram[hit]] * asked.entry_cnt[hit], len(asked.ids))
        out += _sums(asked.ids, np.zeros(len(asked.ids), np.int64), sums, parts)
        for f in map(A.unframe, pick(3)):
            ids = np.frombuffer(f[0], np.int64)
            out += _sums(ids, np.frombuffer(f[1], np.int64), np.zeros(len(ids)), parts)
        if not own and not seen.all():
            miss = np.repeat(np.flatnonzero(~hit), asked.entry_cnt[~hit])
            gram = asked.entry_gram[miss]
            names, nxt = asked.lower[0][gram], asked.lower[1][gram]
            # a word at the start of a text keeps a shared context at every level
            first = asked.ctx[gram] & A.U(1) == 1
            nxt = np.where(first | (level == 2), A.mix(nxt ^ names) | A.U(1), nxt & ~A.U(1))
            keep = [names] + [x[gram] for x in asked.lower[2:]]
            out += [(p, _DOCS, d) for p, d in bundles(nxt, names, asked.entry_doc[miss], asked.ids, keep, parts, _DOCS)]
        cols = list(zip(*out, strict=True)) if out else [(), (), ()]
        return pa.table({"part": pa.array(cols[0], pa.int64()), "kind": pa.array(cols[1], pa.int32()), "data": pa.array(cols[2], pa.binary())})

    return run


def _look_up(g: _Grams, ctx, w, c3, base):
    """(log score, seen) of each asked n-gram in sorted (ctx, w) tables."""
    logp, seen = np.zeros(len(g.ctx)), np.zeros(len(g.ctx), bool)
    if len(ctx) and len(g.ctx):
        key = np.rec.fromarrays([ctx, w], names="c,w")
        ask = np.rec.fromarrays([g.ctx, g.w], names="c,w")
        at = np.minimum(np.searchsorted(key, ask), len(key) - 1)
        seen = (ctx[at] == g.ctx) & (w[at] == g.w)
        logp[seen] = (np.log(c3) - np.log(base))[at[seen]]
    return logp, seen


def _sums(ids, words, sums, parts):
    """Bundles (kind 4) of sums per document, dealt by document."""
    if not len(ids):
        return []
    ids, at = np.unique(ids, return_inverse=True)
    words, sums = np.bincount(at, words, len(ids)).astype(np.int64), np.bincount(at, sums, len(ids))
    return [(p, 4, A.frame([*A.gaps(ids[i].view(np.uint64)), A.pack(words[i]), A.blob(sums[i])]))
            for p, i in A.split_by(A.part_of(A.mix(ids.astype(np.uint64)), parts), parts)]


def _add_up(group: pa.Table) -> pa.Table:
    parts = [A.unframe(d.as_py()) for d in group.column("data")]
    ids, at = np.unique(np.concatenate([A.from_gaps(f[0], f[1]).view(np.int64) for f in parts]), return_inverse=True)
    words = np.bincount(at, np.concatenate([A.unpack(f[2]) for f in parts]), len(ids)).astype(np.int64)
    sums = np.bincount(at, np.concatenate([np.frombuffer(f[3]) for f in parts]), len(ids))
    return pa.table({"__id": pa.array(ids), "n_words": pa.array(words), "log_score": pa.array(sums)})
