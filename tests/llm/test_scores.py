"""Language model, quality rules, language id, classifier, decontamination against brute force or held-out rows."""

import collections
import math
import random
import tracemalloc

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from wattlake.llm import arrays as A
from wattlake.llm import crf_lines, decontaminate, langid_rnn, lm_score, quality_knn
from wattlake.llm.common import crc_mod, prepare, table

from ..conftest import SF_MID, SF_SMALL
from .util import LONG, by_row, docs_df, words


def lm_brute(docs, corpus, order):
    cnt, ctx, total = collections.Counter(), collections.Counter(), 0
    context = lambda w, i, k: tuple((["<s>"] * order + w[:i])[order + i - k + 1:]) if k > 1 else ()
    for t in corpus:
        w = words(t)
        total += len(w)
        for i in range(len(w)):
            for k in range(1, order + 1):
                cnt[context(w, i, k), w[i]] += 1
                ctx[context(w, i, k)] += 1
    out = {}
    for d, t in docs:
        w, s = words(t), 0.0
        for i in range(len(w)):
            for k in range(order, 0, -1):
                c = context(w, i, k)
                if cnt[c, w[i]]:
                    s += math.log(cnt[c, w[i]] / ctx[c]) + (order - k) * math.log(0.4)
                    break
            else:
                s += math.log(0.5 / max(total, 1)) + (order - 1) * math.log(0.4)
        n, old = out.get(d, (0, 0.0))
        out[d] = (n + len(w), old + s)
    return out


ODD = [(1, None), (2, ""), (None, "a b c"), (None, "a"), (3, "a b c a b"), (3, "x"), (4, "zz yy"), (5, LONG)]


@pytest.mark.parametrize("docs,corpus,order", [
    (ODD, None, 3), (ODD, None, 1), (ODD, ["a b c d", "a b", "", None, "c a"], 3), (ODD, [], 2), ([], None, 3)])
def test_lm_score(spark, docs, corpus, order):
    """Equal to counting in dictionaries; with another corpus the backoff levels are used."""
    prepare(spark)
    other = None if corpus is None else spark.createDataFrame([(t,) for t in corpus], "text string")
    got = {r[0]: (r[1], r[2]) for r in lm_score.score(docs_df(spark, docs), other, order=order).collect()}
    want = lm_brute(docs, [t for _, t in docs] if corpus is None else corpus, order)
    assert got.keys() == want.keys()
    for k in want:
        assert got[k][0] == want[k][0] and got[k][1] == pytest.approx(want[k][1], rel=1e-9, abs=1e-9)


def base_brute(t):
    w, lines = words(t), [x for x in (t or "").split("\n") if words(x)]
    win = collections.Counter(tuple(w[i:i + 8]) for i in range(len(w) - 7))
    cover = {p for i in range(len(w) - 7) if win[tuple(w[i:i + 8])] > 1 for p in range(i, i + 8)}
    return len(w), sum(map(len, w)), sum(c in crf_lines.SYMBOLS for c in t or ""), len(lines) - len(set(lines)), len(cover)


def test_quality_rules(spark):
    """Base figures by hand counts; the field keeps good documents and drops bad ones."""
    prepare(spark)
    docs, labels = table(spark, SF_MID, "documents"), table(spark, SF_MID, "labels")
    field = crf_lines.fit(docs, labels)
    rows = [(r.doc_id, r.text) for r in docs.collect()] + [(None, None), (-1, ""), (-2, LONG), (-3, "a\na\n\n a\nb\r\nb"), (-3, "ä # é|")]
    got = crf_lines.judge(docs_df(spark, rows).withColumn("kept", F.lit(1)), field).collect()
    assert by_row((r.doc_id, r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) for r in got) == by_row(
        (i, *base_brute(t)) for i, t in rows)
    for r in got:
        assert r.base_failed == (r.n_words < 20 or 100 * r.n_repeat_words > 30 * r.n_words)
        assert not (r.kept and r.base_failed)
    kept = {r.doc_id: r.kept for r in got if not r.base_failed}
    label = {r.doc_id: r.quality for r in labels.collect() if r.doc_id in kept}
    right = [kept[i] == bool(q) for i, q in label.items()]
    assert sum(right) >= 0.97 * len(right)
    assert crf_lines.judge(docs_df(spark, []), field).count() == 0
    plain = crf_lines.judge(docs_df(spark, [(1, "word " * 4)]), crf_lines.Field()).first()
    assert plain.base_failed and not plain.kept


def test_viterbi_is_the_best_path():
    rng = np.random.default_rng(3)
    f = crf_lines.Field()
    f.trained, f.w, f.t = True, rng.normal(size=crf_lines.N_FIGURES), rng.normal(size=(2, 2))
    lengths = [0, 1, 5, 3, 0, 7]
    off = np.r_[0, np.cumsum(lengths)]
    x = rng.normal(size=(off[-1], crf_lines.N_FIGURES))
    state = f.viterbi(x, off)
    for a, b in zip(off[:-1], off[1:], strict=True):
        def score(path):
            return sum(x[a + i] @ f.w for i, s in enumerate(path) if s) + sum(f.t[p, q] for p, q in zip(path, path[1:], strict=False))
        best = max((tuple((k >> i) & 1 for i in range(b - a)) for k in range(1 << (b - a))), key=score)
        assert tuple(state[a:b]) == best


def test_language_id(spark):
    """Held-out accuracy; texts without a letter are und."""
    prepare(spark)
    docs = table(spark, SF_MID, "documents")
    net = langid_rnn.fit(docs.where(crc_mod("doc_id", 4) != 2))
    r = langid_rnn.predict(docs.where(crc_mod("doc_id", 4) == 2), net).select("lang", "lang_pred", "score").collect()
    assert sum(x.lang == x.lang_pred for x in r) >= 0.97 * len(r)
    assert all(0 <= x.score <= 1 for x in r)
    odd = langid_rnn.predict(docs_df(spark, [(1, None), (2, ""), (3, "12 #"), (None, LONG)]).withColumn("score", F.lit("old")), net)
    got = {x.doc_id: (x.lang_pred, x.score) for x in odd.collect()}
    assert got[1] == got[2] == got[3] == ("und", 0.0) and got[None][0] in net.langs
    none = langid_rnn.fit(docs.where("false"))
    assert langid_rnn.predict(docs_df(spark, [(1, "some text")]), none).first().lang_pred == "und"


def test_backpropagation_against_differences():
    """Gradients of the network equal numeric differences."""
    net = langid_rnn.Network(["a", "b", "c"], seed=3)
    rng = np.random.default_rng(4)
    x, y = rng.integers(97, 103, (7, 4)).astype(np.int16), np.array([0, 1, 2, 1])
    x[5:, 1] = langid_rnn.PAD
    net.p = {k: v.astype(np.float64) for k, v in net.p.items()}
    g = net.gradients(x, y)

    def loss():
        p, real = net.probabilities(x), x != langid_rnn.PAD
        return -sum(np.log(p[y[i], t, i]) for i in range(4) for t in range(7) if real[t, i]) / real.sum()

    for k in ("Uf", "Wb", "Ef", "Ub", "c"):
        for _ in range(6):
            at = (rng.integers(net.p[k].shape[0]), rng.integers(97, 103) if k[0] == "E" else rng.integers(net.p[k].shape[1]))
            old, eps = net.p[k][at], 2e-3
            net.p[k][at] = old + eps
            up = loss()
            net.p[k][at] = old - eps
            down = loss()
            net.p[k][at] = old
            assert g[k][at] == pytest.approx((up - down) / (2 * eps), abs=2e-3)


def test_quality_classifier(spark):
    prepare(spark)
    docs, labels = table(spark, SF_MID, "documents"), table(spark, SF_MID, "labels")
    model = quality_knn.fit(docs, labels.where(crc_mod("doc_id", 5) != 0))
    r = (quality_knn.score(docs, model).join(labels.where(crc_mod("doc_id", 5) == 0), "doc_id").select("score", "quality").collect())
    assert sum((x.score >= 0.3) == bool(x.quality) for x in r) >= 0.95 * len(r)
    odd = quality_knn.score(docs_df(spark, [(1, None), (2, ""), (None, "a"), (3, LONG), (3, LONG)]).withColumn("Score", F.lit("x")), model).collect()
    got = {x.doc_id: x.score for x in odd}
    assert got[1] == got[2] == pytest.approx(model.prior) and all(0 <= s <= 1 for s in got.values()) and len(odd) == 5
    assert quality_knn.score(docs_df(spark, [(1, "x y")]), quality_knn.fit(docs, labels.where("false"))).first().score == 0.5


def test_nearest_votes_are_exact():
    """Blocked cosine products against a plain loop."""
    rng = np.random.default_rng(5)
    x = rng.poisson(0.02, (60, quality_knn.TERMS)).astype(np.float32)
    m = quality_knn.Model(x, (rng.random(60) < 0.7).astype(float))
    q = rng.poisson(0.02, (9, quality_knn.TERMS)).astype(np.float32)
    for row, got in zip(q, m.score(q), strict=True):
        v = m._unit(m._unit(np.log1p(row[None]) * m.idf) @ m.space)[0]
        sims = sorted(((float(v @ p), y) for p, y in zip(m.points, m.y, strict=True)), reverse=True)[:quality_knn.NEIGHBOURS]
        w = [max(s, 0) ** 4 for s, _ in sims]
        assert got == pytest.approx(sum(a * y for a, (_, y) in zip(w, sims, strict=True)) / sum(w), abs=1e-4)


def test_model_holds_the_counts_once():
    """The fit takes 3,000 labelled rows of 2,048 terms, and beside the counts no array of their size."""
    assert (quality_knn.MAX_LABELLED, quality_knn.TERMS) == (3000, 2048)
    x = np.random.default_rng(6).poisson(0.02, (quality_knn.MAX_LABELLED, quality_knn.TERMS)).astype(np.float32)
    tracemalloc.start()
    quality_knn.Model(x, np.arange(len(x)) % 2.0)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    # term-by-term matrices alone: the products, their vectors, a copy and two of the solver
    assert peak < 5.2 * 4 * quality_knn.TERMS ** 2


def edit_brute(a, w):
    row = [0] * (len(w) + 1)
    for i, x in enumerate(a, 1):
        new = [i]
        for j, y in enumerate(w, 1):
            new.append(min(row[j] + 1, new[j - 1] + 1, row[j - 1] + (x != y)))
        row = new
    return min(row)


def test_edit_distance_inside():
    rng = np.random.default_rng(6)
    for _ in range(200):
        a, w = rng.integers(0, 4, rng.integers(1, 9)), rng.integers(0, 4, rng.integers(0, 15))
        got = decontaminate.edit_distance_inside(a, w)
        assert got[0] == edit_brute(a, w) == edit_brute(a, w[got[1]:got[2]])


def test_decontamination_recall(spark):
    """Passages with up to 20 % edited words are found (target recall), clean texts are left alone."""
    prepare(spark)
    bench = table(spark, SF_SMALL, "benchmark")
    items = [(r.item_id, words(r.text)) for r in bench.collect()]
    rng = random.Random(7)
    voc = [w for r in table(spark, SF_SMALL, "documents").limit(30).collect() for w in words(r.text)]
    rows, want = [], set()
    for n in range(300):
        fill = lambda k: rng.choices(voc, k=rng.randrange(k))
        if n % 3 == 0:
            rows.append((n, " ".join(fill(400))))
            continue
        item, w = rng.choice(items)
        w = list(w)
        for _ in range(rng.randrange(int(0.2 * len(w)) + 1)):
            p = rng.randrange(len(w))
            w[p:p + rng.randrange(2)] = rng.choices(voc, k=rng.randrange(2))
        rows.append((n, " ".join(fill(200) + w + fill(200))))
        want.add((n, item))
    rows += [(1000, None), (1001, ""), (None, items[0][1][0]), (None, " ".join(items[0][1]).upper()), (1002, LONG)]
    found = decontaminate.hits(docs_df(spark, rows), bench).collect()
    got = {(r.doc_id, r.item_id) for r in found}
    assert len(want & got) >= decontaminate.TARGET_RECALL * len(want)
    assert got - want == {(None, items[0][0])}
    by = dict(items)
    for r in found:
        if r.doc_id is not None:
            assert r.edits <= 0.2 * len(by[r.item_id])
    clean = {r.doc_id for r in decontaminate.clean(docs_df(spark, rows).withColumn("edits", F.lit(1)), bench).collect()}
    # one of the two rows without an id is clean, the other is not
    assert clean == {i for i, _ in rows} - ({d for d, _ in got} - {None})
    assert decontaminate.hits(docs_df(spark, rows), bench.where("false")).count() == 0
    assert decontaminate.hits(docs_df(spark, []), bench).count() == 0


def test_short_items_recall():
    """Items of 5 to 11 words have their own walk; recall holds for them too."""
    rng = random.Random(2)
    voc = [f"v{i}" for i in range(800)]
    items = [(i, " ".join(rng.choices(voc, k=rng.randrange(5, 12)))) for i in range(60)]
    index = decontaminate.Index([i for i, _ in items], [t for _, t in items])
    texts, want = [], set()
    for k in range(400):
        i, t = rng.choice(items)
        w = t.split()
        for _ in range(rng.randrange(int(0.2 * len(w)) + 1)):
            p = rng.randrange(len(w))
            w[p:p + rng.randrange(2)] = rng.choices(voc, k=rng.randrange(2))
        texts.append(" ".join(rng.choices(voc, k=40) + w + rng.choices(voc, k=40)))
        want.add((k, i))
    got = {(h[0], index.ids[h[1]]) for h in index.search(*A.text_bytes(pa.array(texts)))}
    assert len(want & got) >= decontaminate.TARGET_RECALL * len(want) and not got - want


def test_item_blocks(spark, monkeypatch):
    """Items in several blocks give the same hits as in one."""
    prepare(spark)
    docs, bench = table(spark, SF_SMALL, "documents"), table(spark, SF_SMALL, "benchmark")
    one = by_row(decontaminate.hits(docs, bench).collect())
    monkeypatch.setattr(decontaminate, "BLOCK_WORDS", 600)
    assert one and by_row(decontaminate.hits(docs, bench).collect()) == one


def test_array_primitives():
    """Word borders equal the regular expression; names depend on content alone."""
    texts = ["", " a b\x0bc\x0c", "x\x1cy \r\n z", "ä ö", None, "a"]
    buf, off = A.text_bytes(pa.array(texts))
    s, e, wo = A.tokens(buf, off)
    got = [bytes(buf[a:b]).decode() for a, b in zip(s, e, strict=True)]
    assert got == [w for t in texts for w in words(t)] and list(np.diff(wo)) == [len(words(t)) for t in texts]
    names = A.word_names(buf, s, e)
    assert len(set(names.tolist())) == len(set(got))
    for a in (np.array([], np.int64), np.array([0, 255]), np.array([70000, 1]), np.array([1 << 40])):
        assert (A.unpack(A.pack(a)) == a).all()


def test_network_against_plain_loops(spark):
    """Probabilities of every position and their mean per text, with scalar loops over the segments of a text."""
    prepare(spark)
    net = langid_rnn.Network(["a", "b", "c"], seed=9)
    texts = ["", "x", "Hello é", "ab " * 70, "q" * 96, "q" * 97]
    soft = lambda v: v / (1 + abs(v))
    p, n, h = {k: v.astype(float) for k, v in net.p.items()}, langid_rnn.STEPS, langid_rnn.HIDDEN
    want = []
    for t in texts:
        data, total = t.encode(), np.zeros(3)
        for k in range(0, len(data), n):
            part, out = data[k:k + n], {}
            for d, seq in (("f", range(len(part))), ("b", range(len(part) - 1, -1, -1))):
                state = np.zeros(h)
                for i in seq:
                    g = p["E" + d][:, part[i]] + p["U" + d] @ state
                    z, c = (1 + soft(g[:h])) / 2, soft(g[h:])
                    state = state + z * (c - state)
                    out[d, i] = state
            for i in range(len(part)):
                v = p["Wf"] @ out["f", i] + p["Wb"] @ out["b", i] + p["c"].ravel()
                e = np.exp(v - v.max())
                total += e / e.sum()
        want.append(total / max(len(data), 1))
    got = net.documents(*A.text_bytes(pa.array(texts)))
    assert got == pytest.approx(np.array(want), abs=1e-4)
    rows = {r.doc_id: r for r in langid_rnn.predict(docs_df(spark, list(enumerate(texts))).withColumn("__letters", F.lit("mine")), net).collect()}
    for k, t in enumerate(texts):
        assert rows[k]["__letters"] == "mine" and rows[k].lang_pred == (net.langs[int(want[k].argmax())] if t else "und")
        assert rows[k].score == pytest.approx(want[k].max() if t else 0, abs=1e-4)


def test_dirty_languages(spark):
    """A column with many stray values trains on the languages with the most rows and ends no run."""
    prepare(spark)
    rows = [(i, "some text here", "en" if i % 2 else "de") for i in range(60)] + [(100 + i, "text", f"junk{i:03d}") for i in range(300)]
    net = langid_rnn.fit(spark.createDataFrame(rows, "doc_id long, text string, lang string"), max_langs=5)
    assert net.langs == ["de", "en", "junk000", "junk001", "junk002"]


def test_words_alone_tell_texts_apart(spark):
    """Texts of the same shapes and lengths but other words differ in the latent space."""
    prepare(spark)
    good, bad = ["river stone paper cloud green", "cloud green river paper stone"], ["virus spoil cheap fraud scams", "scams cheap virus fraud spoil"]
    rng = random.Random(4)
    rows = [(i, " ".join(rng.choice(good if i % 2 else bad).split() + ["table"] * (i % 3))) for i in range(60)]
    labels = spark.createDataFrame([(i, i % 2) for i in range(60)], "doc_id long, quality int")
    model = quality_knn.fit(docs_df(spark, rows), labels)
    got = {r.doc_id: r.score for r in quality_knn.score(docs_df(spark, [(1, "paper cloud river"), (2, "fraud scams cheap")]), model).collect()}
    assert got[1] > 0.9 and got[2] < 0.1


@pytest.mark.parametrize("module", [quality_knn, crf_lines])
def test_hot_labelled_id(spark, module, monkeypatch):
    """A labelled id that very many rows share brings one row to the driver."""
    prepare(spark)
    docs = docs_df(spark, [(1, f"text number {i}\nand # more") for i in range(3000)] + [(2, "fine words here\nand there")])
    labels = spark.createDataFrame([(1, 0), (2, 1), (2, 1)], "doc_id long, quality int")
    sizes, collect = [], type(docs).collect

    def counted(df):
        got = collect(df)
        sizes.append(len(got))
        return got
    monkeypatch.setattr(type(docs), "collect", counted)
    module.fit(docs, labels)
    assert sizes and max(sizes) <= 3


def test_mixed_text_is_decoded_in_both_states(spark):
    """A text of prose with a block of junk lines inside changes its state at the borders of the block."""
    prepare(spark)
    docs, labels = table(spark, SF_MID, "documents"), table(spark, SF_MID, "labels")
    field = crf_lines.fit(docs, labels)
    known = {r.doc_id: r.quality for r in labels.collect()}
    texts = collections.defaultdict(list)
    for r in docs.orderBy("doc_id").collect():
        lines = crf_lines.Lines(*A.text_bytes(pa.array([r.text or ""])))
        if known.get(r.doc_id) in (0, 1) and len(lines.figures) >= 6:
            state = field.viterbi(lines.figures, lines.line_off)
            if (state == 1 - known[r.doc_id]).all():
                texts[known[r.doc_id]].append((r.text, len(state)))
    assert texts[0] and texts[1]
    right = total = 0
    for (good, n), (bad, m) in zip(texts[1][:40], texts[0][:40], strict=False):
        x = crf_lines.Lines(*A.text_bytes(pa.array([f"{good}\n{bad}\n{good}"])))
        state = field.viterbi(x.figures, x.line_off)
        want = np.repeat([0, 1, 0], [n, len(state) - 2 * n, n])
        right, total = right + int((state[:n + m] == want[:n + m]).sum()), total + n + m
        assert 0 < state[:n + m].sum() < n + m
    assert right > 0.8 * total


def test_splices():
    a, b = np.zeros((4, 2)), np.ones((3, 2))
    (x, y), = crf_lines.splices([(a, 0), (b, 1)])
    assert y.tolist() == [0, 0, 1, 1, 1, 0, 0] and (x[:, 0] == y).all() and crf_lines.splices([(a, 0)]) == []
