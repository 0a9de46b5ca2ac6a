"""Packing, importance resampling and Merkle manifest against brute force, round trips and bounds."""

import collections
import math
import random
import zlib
from hashlib import sha256

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from wattlake.llm import arrays as A
from wattlake.llm import merkle, packing, places, resample
from wattlake.llm import queries as Q
from wattlake.llm.common import prepare, table

from ..conftest import SF_SMALL
from .util import LONG, UP, by_row

P = pytest.importorskip("public_tokenizers")
PATH = P.path("byte_bpe_50k.json")
ODD = ["", None, " ", "a", "don't 'x' they're '", "é è ü ×÷ naïve Straße", "\n\n \t x\r\ny", "<|endoftext|> a<|endoftext|>", "x" * 5000, "日本語 テキスト　abc", "a \n b \n c",
       "1234abc5678!?...--- ()[]{}", "  two  blanks   ", " lead", "trail ", "a'b c'd", LONG, "é,è.ñ;", "😀 emoji 😀😀", "a\x00b\x1c c\x7f"]


# --- places -----------------------------------------------------------------------------------------
def test_places(spark, monkeypatch):
    """Every row gets its place in its group's order, over several ranges, with ties, one value in a third of the rows and nulls."""
    monkeypatch.setattr(places, "ROWS", 50)
    rng = random.Random(3)
    rows = [(rng.choice("abc"), 7 if i % 3 == 0 else rng.choice([None, *range(20)])) for i in range(400)]
    got = places.indexed(spark.createDataFrame(rows, "g string, v int"), "g", [F.col("v").asc_nulls_first()]).collect()
    for g in "abc":
        mine = sorted((r["__i"], r.v) for r in got if r.g == g)
        want = sorted((v for x, v in rows if x == g), key=lambda v: (v is not None, v or 0))
        assert [i for i, _ in mine] == list(range(len(want))) and [v for _, v in mine] == want
        assert {r["__n"] for r in got if r.g == g} == {len(want)}
    assert places.indexed(spark.createDataFrame([], "g string, v int"), "g", [F.col("v")]).count() == 0


# --- packing ----------------------------------------------------------------------------------------
def test_chunks_equal_whole_texts():
    """Ids from chunks are those of whole texts: odd characters, random mixtures, many texts in a slice."""
    from tokenizers import Tokenizer
    tok = Tokenizer.from_file(PATH)
    tok.encode_special_tokens = True
    rng = random.Random(5)
    pieces = ["a", "Zz", "é", "×", "ß", "'", "'s", " ", "  ", "\n", " ", " ", "7", "42", ".", "!?", "日", "\t", "don't", "-", "\x00", "😀", "÷", "\r\n", "_", "ñ'll"]
    texts = ODD + ["".join(rng.choices(pieces, k=rng.randrange(1, 30))) for _ in range(3000)]
    seen = 0
    for i, ids, off in packing.Chunks(PATH).encode(pa.array(texts)):
        for k in range(len(off) - 1):
            assert ids[off[k]:off[k + 1]].tolist() == tok.encode(texts[i + k] or "", add_special_tokens=False).ids, repr(texts[i + k])
            seen += 1
    assert seen == len(texts)


def optimal(lengths, size):
    """Fewest sequences by trying every assignment (small inputs)."""
    lengths, best = sorted(lengths, reverse=True), [len(lengths)]

    def go(k, room):
        if len(room) >= best[0]:
            return
        if k == len(lengths):
            best[0] = len(room)
            return
        for i in {r: j for j, r in enumerate(room)}.values():
            if room[i] >= lengths[k]:
                go(k + 1, room[:i] + [room[i] - lengths[k]] + room[i + 1:])
        go(k + 1, [*room, size - lengths[k]])
    go(0, [])
    return best[0]


def test_bounds_and_best_fit():
    """The bound never passes the optimum, best fit never falls below it; both meet it in most cases; known families are exact."""
    rng = random.Random(8)
    met = 0
    for _ in range(150):
        size = rng.choice([10, 16, 30])
        x = np.array([rng.randrange(1, size + 1) for _ in range(rng.randrange(1, 10))])
        low, (where, offset, room), opt = packing.lower_bound(x, size), packing.best_fit(x, size), optimal(x.tolist(), size)
        assert low <= opt <= len(room)
        met += low == opt == len(room)
        for b in range(len(room)):
            mine = sorted(zip(offset[where == b].tolist(), x[where == b].tolist(), strict=True))
            assert [o for o, _ in mine] == [sum(n for _, n in mine[:k]) for k in range(len(mine))] and sum(n for _, n in mine) + room[b] == size
    assert met > 100
    assert packing.lower_bound(np.full(9, 513), 1024) == 9 and packing.lower_bound(np.full(9, 400), 1024) == 5 and packing.lower_bound(np.array([], np.int64), 8) == 0
    assert packing.lower_bound(np.array([342] * 6), 1024) == 3


def test_cuts():
    assert packing.cuts(10, 4) == [(0, 2), (2, 4), (6, 4)] and packing.cuts(8, 4) == [(0, 4), (4, 4)] and packing.cuts(3, 4) == [(0, 3)]


def check_packed(rows, size):
    seqs = collections.defaultdict(list)
    for r in rows:
        seqs[r.sequence_id].append((r.offset, r.length))
    for s in seqs.values():
        s.sort()
        assert [o for o, _ in s] == [sum(n for _, n in s[:k]) for k in range(len(s))] and sum(n for _, n in s) <= size
    return len(seqs)


def test_packing_rounds(spark, monkeypatch):
    """Partitions with a gap exchange pieces: several rounds, every piece once, never worse than one round, certified at the end."""
    prepare(spark)
    monkeypatch.setattr(packing, "PIECES", 40)
    rng = random.Random(2)
    rows = [(i, rng.choice([100, 60, 50, 41, 37, 30, 26, rng.randrange(1, 100)])) for i in range(500)]
    cut = spark.createDataFrame(rows, "doc_id int, length long").withColumn("offset", F.lit("old"))
    one, many = packing.Packing(cut, 100, 1), packing.Packing(cut, 100)
    n1, n = check_packed(one.sequences.collect(), 100), check_packed(many.sequences.collect(), 100)
    assert by_row(many.sequences.select("doc_id", "length").collect()) == by_row(rows)
    assert n <= n1 and len(many.report) > 1 and many.report[0]["partitions"] > many.report[-1]["partitions"]
    low = packing.lower_bound(np.array([x for _, x in rows]), 100)
    assert low <= n <= len(packing.best_fit(np.array([x for _, x in rows]), 100)[2]) + 3          # as good as one partition for all
    assert all(r["sequences"] >= r["bound"] and r["certified"] <= r["partitions"] for r in many.report)
    assert packing.pack(cut.where("false"), 100).count() == 0
    assert check_packed(packing.pack(cut.where("length = 100"), 100).collect(), 100) == sum(x == 100 for _, x in rows)


def test_pieces_round_trip(spark):
    """Pieces joined give the ids of the whole text; repeated ids and text ids stay apart; the digests are those of the ids."""
    from tokenizers import Tokenizer
    prepare(spark)
    tok = Tokenizer.from_file(PATH)
    tok.encode_special_tokens = True
    rows = [(f"d{i // 2}" if i else None, t, 1) for i, t in enumerate(ODD)]
    got = packing.pieces(spark.createDataFrame(rows, "name string, body string, piece int"), PATH, 64, "name", "body", keep_ids=True).collect()
    want = collections.Counter()
    for name, t, _ in rows:
        ids = tok.encode(t or "", add_special_tokens=False).ids + [2]
        for p, (s, n) in enumerate(packing.cuts(len(ids), 64)):
            data = np.array(ids[s:s + n], "<u4").tobytes()
            want[name, p, s, n, zlib.crc32(data), data] += 1
    assert collections.Counter((r.name, r.piece, r.start, r.length, r.ids_crc32, bytes(r.ids)) for r in got) == want
    empty = spark.createDataFrame([(1, ""), (2, None)], "doc_id long, text string")
    assert sorted((r.doc_id, r.length) for r in packing.pieces(empty, PATH, 8).collect()) == [(1, 1), (2, 1)]
    assert packing.pieces(empty, PATH, 8, end=None).count() == 0 and packing.pieces(empty.where("false"), PATH, 8).count() == 0


def test_op11(spark):
    """The whole table: gapless sequences, each document's ids covered, close to the bound of all pieces."""
    got = Q.QUERIES["op11_best_fit_packing"](spark, SF_SMALL).collect()
    n = check_packed(got, 1024)
    low = packing.lower_bound(np.array([r.length for r in got]), 1024)
    assert low <= n <= low * 1.03 + 1
    docs = {r.doc_id for r in table(spark, SF_SMALL, "documents").select("doc_id").collect()}
    assert {r.doc_id for r in got} == docs
    assert all(r.length == 1024 or r.piece == 0 for r in got)


# --- resampling -------------------------------------------------------------------------------------
def word_list(text):
    import re
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(UP))


def features(text):
    w = word_list(text)
    return [" ".join(w[i:i + k]) for k in (1, 2, 3) for i in range(len(w) - k + 1)]


def draw_brute(docs, target, share, min_words):
    b = lambda f: zlib.crc32(f.encode()) % 10000
    s, t = (collections.Counter(b(f) for x in texts for f in features(x)) for texts in ([x for _, x in docs], target))
    big_s, big_t = sum(s.values()), sum(t.values())
    gain = [math.floor(1000 * math.log((t[k] + 1) * (big_s + 10000) / ((s[k] + 1) * (big_t + 10000)))) for k in range(10000)]
    out, open_ = [], []
    for k, (i, x) in enumerate(docs):
        f = features(x)
        h = int(sha256(f"42:{'' if i is None else i}".encode()).hexdigest()[:8], 16)
        w = sum(gain[b(y)] for y in f)
        out.append([i, len(f), w, w + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296))), None])
        if len(word_list(x)) >= min_words:
            open_.append((-out[-1][3], i is not None, i or 0, k))
    for r, (_, _, _, k) in enumerate(sorted(open_)[:share[0] * len(open_) // share[1]], 1):
        out[k][4] = r
    return out


VOCAB = [f"w{i}" for i in range(60)] + ["é", "ß", "x" * 70, "日本", "y" * 300, "The", "THE"]


def corpus(seed, n=120):
    rng = random.Random(seed)
    out = [" ".join(rng.choices(VOCAB, weights=[1 / (k + 1) for k in range(len(VOCAB))], k=rng.randrange(0, 60))) for _ in range(n)]
    return out + ["", None, "a", "a b", "!!", LONG]


@pytest.mark.parametrize("words, pairs, most", [(0, 0, 8), (5, 3, 8), (40, 30, 16), (32768, 65536, 512)])
def test_buckets_by_any_head(monkeypatch, words, pairs, most):
    """Heads of any size give the same buckets: CRC states, pair buckets and direct hashing agree with zlib."""
    monkeypatch.setattr(resample, "PAIR_WORDS", most)
    texts = corpus(1)
    buf, off = A.text_bytes(pa.array(texts))
    w = resample.words_of(buf, off)
    assert [bytes(x).decode() for x in w.strings().to_pylist()] == [x for t in texts for x in word_list(t)]
    common = collections.Counter(x for t in texts for x in word_list(t) if len(x.encode()) <= resample.LONGEST)
    top = [x.encode() for x, _ in common.most_common(words)]
    two = [(a, b) for a in range(min(most, len(top))) for b in range(min(most, len(top))) if (a + b) % 3][:pairs]
    got = collections.Counter()
    for first, slot in resample.buckets(w, resample.Head.of(top, two)):
        got.update(zip(A.owner(w.offsets)[first].tolist(), slot.tolist(), strict=True))
    assert got == collections.Counter((k, zlib.crc32(f.encode()) % 10000) for k, t in enumerate(texts) for f in features(t))


def test_draw_against_brute_force(spark):
    """Weights, scores and ranks with repeated rows, null ids, ties and odd texts; an extra column may have any name."""
    prepare(spark)
    docs = [(None if i == 3 else i // 2 * 2 if i % 10 == 0 else i, t) for i, t in enumerate(corpus(1))]
    target = corpus(2, 30)
    df = spark.createDataFrame(docs, "doc_id long, text string")
    model = resample.fit(df, spark.createDataFrame([(t,) for t in target], "text string"))
    want = draw_brute(docs, target, (20, 100), 20)
    assert by_row(resample.ranked(df, model, (20, 100)).collect()) == by_row(want)
    odd = df.toDF("name", "__g").withColumns({"__w": F.lit(1), "__i": F.lit("x"), "rank": F.lit("old")}).withColumn("name", F.col("name").cast("string"))
    drawn = resample.draw(odd, model, (20, 100), "name", "__g")
    assert drawn.columns == ["name", "__g", "__w", "__i", "rank"]
    texts = dict(docs)
    got = sorted((r["rank"], r.name, r["__g"], r["__i"]) for r in drawn.collect())
    assert [(k, n) for k, n, _, _ in got] == sorted((w[4], None if w[0] is None else str(w[0])) for w in want if w[4])
    assert all(x == "x" for *_, x in got) and all(t == texts[int(n)] for _, n, t, _ in got if n)
    assert resample.ranked(df.where("false"), model).count() == 0 and resample.draw(df.where("false"), model).count() == 0
    assert resample.fit(df.where("false"), df.where("false")).gain.tolist() == [0] * 10000


# --- manifest ---------------------------------------------------------------------------------------
@pytest.mark.parametrize("n", [1, 2, 7, 8, 9, 63, 64, 65, 511, 512, 513, 600])
def test_positions_are_the_order_of_completion(n):
    """Closed-form places equal those of a log that appends each node when its last child is there."""
    log, open_ = [], [[]]
    widths = [merkle.width(n, k) for k in range(merkle.height(n) + 1)]
    count = [0] * len(widths)

    def add(level):
        log.append((level, count[level]))
        count[level] += 1
        if level + 1 < len(widths) and count[level] % merkle.FAN == 0:
            add(level + 1)
    for _ in range(n):
        add(0)
    for level in range(1, len(widths)):
        if count[level] < widths[level]:
            add(level)
    assert len(log) == merkle.nodes(n) and open_
    for place, (level, index) in enumerate(log):
        assert int(merkle.position(n, level, index)) == place


def h(s):
    return sha256(s.encode()).hexdigest()


def levels(row):
    out = [row]
    while len(row) > 1:
        row = [h("".join(row[i:i + 8])) for i in range(0, len(row), 8)]
        out.append(row)
    return out


def manifest_brute(rows, shown):
    """rows: (id, lang, leaf); shown: leaf digest by row number."""
    langs = sorted({r[1] for r in rows}, key=lambda x: (x is not None, (x or "").encode()))
    trees = {g: sorted((r[0] is not None, r[0] or 0, r[2], k) for k, r in enumerate(rows) if r[1] == g) for g in langs}
    lv = {g: levels([t[2] for t in trees[g]]) for g in langs}
    top = levels([lv[g][-1][0] for g in langs])
    out = []
    for gi, g in enumerate(langs):
        for i, (*_, k) in enumerate(trees[g]):
            cur, sib = shown[k], []
            for all_levels, at in ((lv[g], i), (top, gi)):
                for row in all_levels[:-1]:
                    run, p = row[at // 8 * 8:at // 8 * 8 + 8], at % 8
                    sib += run[:p] + run[p + 1:]
                    cur, at = h("".join(run[:p]) + cur + "".join(run[p + 1:])), at // 8
            out.append((rows[k][0], rows[k][2], lv[g][-1][0], h("".join(sib)), cur, top[-1][0], cur == top[-1][0]))
    return out


def enc(v):
    return "-" if v is None else f"{len(str(v).encode())}:{v}"


@pytest.mark.parametrize("sizes", [{"en": 1}, {"en": 8, None: 1}, {"en": 600, "de": 9, "": 64, "zz": 513, None: 3}, {f"l{i:02d}": i % 3 + 1 for i in range(70)}])
def test_manifest_against_brute_force(spark, monkeypatch, sizes):
    """Proofs and roots of trees over several rounds of builders, a null and an empty language, repeated rows and text ids."""
    prepare(spark)
    monkeypatch.setattr(places, "ROWS", 100)
    rows = [(f"id{k % 500}", lang, None if k % 7 == 0 else f"Text {k} É" if k % 5 else "") for lang, n in sizes.items() for k in range(n)]
    rows += rows[:1]
    df = spark.createDataFrame(rows, "name string, lang string, text string").withColumn("id", F.lit("clash"))
    fields = ("name", "lang", "text")
    low = F.translate("text", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    made = merkle.manifest(df, "name", "lang", fields, {"text": low})
    got = made.proofs().select("id", "leaf", "subroot", "proof_sha256", "folded_root", "root", "verified").collect()
    leaf = [h("".join(map(enc, r))) for r in rows]
    shown = [h("".join(map(enc, (r[0], r[1], r[2] if r[2] is None else r[2].translate(UP))))) for r in rows]
    want = manifest_brute([(r[0], r[1], x) for r, x in zip(rows, leaf, strict=True)], shown)
    # equal leaves of repeated rows may change places: their proofs are equal as a set
    assert by_row(got) == by_row(want)
    log = made.log.collect()
    for lang, n in sizes.items():
        tree = "-" if lang is None else "=" + lang
        n = sum(r[1] == lang for r in rows)
        assert sorted(r.position for r in log if r.tree == tree) == list(range(merkle.nodes(n)))


def test_manifest_of_nothing(spark):
    prepare(spark)
    made = merkle.manifest(table(spark, SF_SMALL, "documents").where("false"))
    assert made.root is None and made.proofs().count() == 0
