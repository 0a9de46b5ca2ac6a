"""n-gram join and substring dedup against brute force."""

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from wattlake.llm import arrays as A
from wattlake.llm import ngram_join, repeats
from wattlake.llm.common import prepare

from .util import LONG, by_row, docs_df, families, join_brute, words

ODD = [(1, None), (2, ""), (None, "a b"), (3, "A b"), (4, "a"), (4, "a"), (None, "q r s t"), (9, " \n"), (7, LONG), (8, LONG)]


@pytest.mark.parametrize("long_list", [3, 64])
def test_join_families(spark, monkeypatch, long_list):
    """Short and long lists give the same exact components."""
    prepare(spark)
    monkeypatch.setattr(ngram_join, "LONG_LIST", long_list)
    rows = families(5)
    got = ngram_join.join(docs_df(spark, rows)).select("doc_id", "n_shingles", "component_id").collect()
    assert by_row(got) == by_row(join_brute(rows))


def test_join_odd_rows(spark):
    prepare(spark)
    df = docs_df(spark, ODD).selectExpr("*", "'x' as component_id", "1 as `odd name`")
    got = ngram_join.join(df)
    assert "odd name" in got.columns
    assert by_row(got.select("doc_id", "n_shingles", "component_id").collect()) == by_row(join_brute(ODD))


def test_join_empty(spark):
    prepare(spark)
    assert ngram_join.join(docs_df(spark, [])).count() == 0


def test_one_of_each(spark):
    prepare(spark)
    rows = families(6, n=8)
    want = {c for _, _, c in join_brute(rows)}
    assert {r.doc_id for r in ngram_join.one_of_each(docs_df(spark, rows)).collect()} == want
    assert sorted(r.doc_id for r in ngram_join.one_of_each(docs_df(spark, [(5, "a b c d"), (5, "a b c d"), (6, "A b c d"), (7, ""), (8, None)])).collect()) == [5, 7, 8]


def near_brute(rows, k, num, den):
    """doc_id -> smallest id of its component, by comparing every pair of k-word sets."""
    sets = [{tuple(w[i:i + k]) for i in range(len(w) - k + 1)} if len(w) >= k else {tuple(w)} - {()} for w in (words(t) for _, t in rows)]
    comp = list(range(len(rows)))
    for i, a in enumerate(sets):
        for j, b in enumerate(sets[:i]):
            if a and den * len(a & b) >= num * len(a | b) and comp[i] != comp[j]:
                comp = [min(comp[i], comp[j]) if c in (comp[i], comp[j]) else c for c in comp]
    return {r[0]: min(rows[j][0] for j in range(len(rows)) if comp[j] == comp[i]) for i, r in enumerate(rows)}


def spaced_copies():
    """Texts of distinct words beside copies with evenly spaced changes: similar at five words and 0.8, not at three words and 0.9."""
    rows = []
    for n, changes in ((100, 2), (300, 6), (500, 10)):
        base = [f"t{n}w{i}" for i in range(n)]
        copy = list(base)
        for c in range(changes):
            copy[(2 * c + 1) * n // (2 * changes)] = f"t{n}x{c}"
        rows += [" ".join(base), " ".join(copy)]
    return list(enumerate(rows))


def test_pipeline_near_duplicates(spark):
    """The stage joins 5-word shingles at 0.8: copies that the query's 3 words at 0.9 leave apart are one document."""
    import corpus_pipeline as P
    rows = spaced_copies()
    rows += [(100 + i, t) for i, t in families(11)]
    kept = {r.doc_id for r in P.near_duplicates(spark, docs_df(spark, rows), "").collect()}
    assert kept == set(near_brute(rows, 5, 80, 100).values())
    assert {0, 2, 4} <= kept and not {1, 3, 5} & kept
    assert {c for _, _, c in join_brute(rows)} >= set(range(6))


@pytest.mark.parametrize("rule", [ngram_join.Rule(5, 80, 100), ngram_join.Rule(2, 1, 2), ngram_join.Rule(3, 95, 100)])
@pytest.mark.parametrize("long_list", [3, 64])
def test_join_by_rule(spark, monkeypatch, rule, long_list):
    """Components under other shingle widths and similarities, small sets included."""
    prepare(spark)
    monkeypatch.setattr(ngram_join, "LONG_LIST", long_list)
    rows = families(12, sizes=(5, 6, 7, 8, 9, 10, 11, 12, 30, 150, 400))
    got = {r.doc_id: r.component_id for r in ngram_join.join(docs_df(spark, rows), rule=rule).collect()}
    assert got == near_brute(rows, *rule)


def test_rule_bounds():
    for bad in (ngram_join.Rule(0), ngram_join.Rule(5, 49, 100), ngram_join.Rule(5, 1, 1)):
        with pytest.raises(ValueError):
            bad.check()
    assert (ngram_join.RULE.least, ngram_join.Rule(5, 80, 100).least) == (9, 4)


def test_parity_sketch_is_a_lower_bound():
    """The sketch distance never exceeds the symmetric difference, at equal and at neighbouring levels."""
    rng = np.random.default_rng(4)
    pool = A.mix(np.arange(5000, dtype=np.uint64))
    for n in (9, 200, 300, 1000, 1023, 1100, 3000):
        base = rng.choice(pool, n, replace=False)
        other = np.unique(np.r_[base[int(0.06 * n):], rng.choice(pool, int(0.03 * n) + 1)])
        members = [np.sort(base), other]
        so = np.r_[0, np.cumsum([len(m) for m in members])]
        words, level = ngram_join.parity(np.concatenate(members), so)
        apart = ngram_join.Sketches(words, level).apart(np.array([0]), np.array([1]))[0]
        assert apart <= len(np.setxor1d(*members))


def test_block_pairs_meet():
    """A key dealt as block pairs still brings any two of its sets together in one list."""
    cells = np.zeros(ngram_join.CELLS, np.int64)
    x = np.sort(A.mix(np.arange(40, dtype=np.uint64)))
    cells[ngram_join.cell(x)] = 40 * ngram_join.BLOCK
    order = ngram_join.Order(cells, 10)
    keys = []
    for node in (11, 14):
        k, _ = order.keys(x, np.array([0, 40]), np.array([node], np.uint64))
        keys.append(set(k.tolist()))
    assert keys[0] & keys[1]


def test_boundary_has_least_cost():
    rng = np.random.default_rng(2)
    sizes = rng.integers(0, 50, 300)
    n = np.arange(300)
    d = ngram_join.missing(n)

    def cost(x):
        return sum(int(sizes[k] * (d[k] + 2) * (d[k] + 1) // 2) for k in n if k <= 100 * x // 90) + sum(int(sizes[k] * (d[k] + 1) * 4) for k in n if k > x)

    assert cost(ngram_join.boundary(sizes)) == min(cost(x) for x in range(300))


def repeats_brute(rows):
    first, out = {}, []
    for i, t in rows:
        w = words(t)
        for k in range(len(w) - 12 if i is not None else 0):
            g = tuple(w[k:k + 13])
            first[g] = min(first.get(g, i), i)
    for i, t in rows:
        w = words(t)
        gone = [False] * len(w)
        for k in range(len(w) - 12):
            f = first.get(tuple(w[k:k + 13]))
            if f is not None and (i is None or f < i):
                gone[k:k + 13] = [True] * 13
        out.append((i, len(w), sum(gone), " ".join(x for x, g in zip(w, gone, strict=True) if not g)))
    return out


def test_repeats(spark):
    prepare(spark)
    run = " ".join("ab ab c d e f g h i j k l m n o".split())
    rows = families(8, n=10) + [(1000, None), (1001, ""), (None, run), (None, "x " * 40), (1002, run), (1002, run), (1003, "q " + run + " z"),
                                (1004, "x " * 13), (1005, "x " * 40), (1006, LONG), (1007, LONG)]
    got = repeats.remove_repeats(docs_df(spark, rows)).collect()
    assert by_row(got) == by_row(repeats_brute(rows))
    assert repeats.remove_repeats(docs_df(spark, [])).count() == 0


def test_equal_windows_have_equal_anchors():
    """The anchor of a window follows from its words alone, runs and small alphabets included."""
    rng = np.random.default_rng(1)
    for _ in range(100):
        k = int(rng.choice([1, 2, 3, 5, 50]))
        texts = [" ".join(f"w{x}" for x in np.repeat(rng.integers(0, k, rng.integers(1, 80)), rng.integers(1, 4))) for _ in range(6)]
        base = " ".join(f"w{x}" for x in rng.integers(0, k, 30))
        texts = [t + " " + base + " " + t[:12] for t in texts]
        buf, off = A.text_bytes(pa.array(texts))
        s, e, wo = A.tokens(buf, off)
        names = A.word_names(buf, s, e)
        at, anchor = repeats.anchors(names, wo, 13)
        assert (anchor != repeats._NEVER).all()
        seen = {}
        for w, a in zip(A.window_names(names, 13)[at].tolist(), anchor.tolist(), strict=True):
            assert seen.setdefault(w, a) == a


def thue_morse(n, a="ab"):
    """Two words of n letters that any polynomial modulo a power of two names alike from 1,024 letters on."""
    bits = [bin(i).count("1") & 1 for i in range(n)]
    return "".join(a[b] for b in bits), "".join(a[1 - b] for b in bits)


@pytest.mark.parametrize("size", [9, 64, 1024, 2048, 4096])
def test_names_of_regular_words(size):
    x, y = thue_morse(size)
    buf, off = A.text_bytes(pa.array([x, y, x, x[:-1], x[1:]]))
    s, e, _ = A.tokens(buf, off)
    a, b, c, d, f = A.word_names(buf, s, e).tolist()
    assert a == c and len({a, b, d, f}) == 4


def test_regular_words_stay_apart(spark):
    """Windows, shingles, lines and passages that differ in one regular word are different."""
    from wattlake.llm import crf_lines, decontaminate
    prepare(spark)
    x, y = thue_morse(2048)
    rest = [f"w{i}" for i in range(12)]
    rows = [(1, " ".join([x, *rest])), (2, " ".join([y, *rest])), (3, " ".join([x, *rest]))]
    assert {r.doc_id: r.n_removed for r in repeats.remove_repeats(docs_df(spark, rows)).collect()} == {1: 0, 2: 0, 3: 13}
    lines = crf_lines.Lines(*A.text_bytes(pa.array([f"{x}\n{y}\n{x}", f"{x}\n{y}"])))
    assert lines.n_dup_lines.tolist() == [1, 0]
    joined = ngram_join.join(docs_df(spark, [(1, f"{x} a b"), (2, f"{y} a b"), (3, f"{x} a b")])).collect()
    assert {r.doc_id: r.component_id for r in joined} == {1: 1, 2: 2, 3: 1}
    buf, off = A.text_bytes(pa.array([f'"{x}" (cat) it\'s word,', f"{x} cat its word", f"{y} cat its word"]))
    names, _ = decontaminate.normal_words(buf, off)
    a, b, c = names.reshape(3, 4)
    assert (a == b).all() and (b != c).tolist() == [True, False, False, False]


@pytest.mark.parametrize("tile", [2, 5, 512])
def test_forest_tiles(monkeypatch, tile):
    """Tiles of any size connect the same sets as all pairs do."""
    monkeypatch.setattr(ngram_join, "TILE", tile)
    monkeypatch.setattr(ngram_join, "COLUMNS", 7)
    rng = np.random.default_rng(4)
    sets = [np.sort(rng.choice(40, 20, replace=False)).astype(np.uint64) for _ in range(12)]
    sets += [np.sort(np.r_[s[1:], np.uint64(100 + k)]) for k, s in enumerate(sets)]
    rule = ngram_join.RULE

    def groups(pairs):
        comp = list(range(len(sets)))
        for i, j in pairs:
            comp = [comp[i] if c == comp[j] else c for c in comp]
        return sorted(tuple(i for i in range(len(sets)) if comp[i] == c) for c in set(comp))
    near = [(i, j) for i in range(len(sets)) for j in range(i)
            if rule.den * (b := len(np.intersect1d(sets[i], sets[j]))) >= rule.num * (len(sets[i]) + len(sets[j]) - b)]
    found = ngram_join.forest(sets, rule)
    assert groups(found) == groups(near) and len(found) == len(sets) - len(groups(near))


def test_forest_of_many_near_copies():
    """8,192 near copies are joined within a fraction of an executor's memory."""
    import tracemalloc
    rng = np.random.default_rng(3)
    base = rng.choice(1 << 40, 200, replace=False).astype(np.uint64)
    sets = [np.sort(np.r_[np.delete(base, k % 200), np.uint64((1 << 41) + k)]) for k in range(8192)]
    tracemalloc.start()
    found = ngram_join.forest(sets)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert len(found) == 8191 and peak < 500e6


def test_one_of_each_with_clashing_columns(spark):
    """Columns named like those of the join come back as they were; ids may be texts."""
    prepare(spark)
    df = spark.createDataFrame([("b", "x y z w", "k1", 5, "c1"), ("a", "x y z w", "k2", 6, "c2"), ("c", None, "k3", 7, "c3")],
                               "doc_id string, text string, __comp string, n_shingles int, __n string").withColumns({"component_id": F.lit("own"), "__node": F.lit(1)})
    got = ngram_join.one_of_each(df)
    assert got.columns == df.columns
    assert sorted(map(tuple, got.collect())) == [("a", "x y z w", "k2", 6, "c2", "own", 1), ("c", None, "k3", 7, "c3", "own", 1)]
