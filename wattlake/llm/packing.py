"""Best-fit packing of token sequences with certified bin counts.

Texts are tokenized whole, cut into pieces only where they are longer than a sequence, and the pieces are packed in
rounds. Each round deals the open pieces to partitions and packs every partition by best-fit decreasing. Dual-feasible
functions of the partition's piece lengths give a lower bound of its sequences:

* a partition that meets its bound is certified and its sequences are final, but for the one with most room, whose
  pieces may still fill gaps elsewhere;
* a partition with a gap puts the pieces of all its sequences that have room back, and these pieces are exchanged: they
  are dealt anew, with those of the other partitions, and packed again.

A round that does not lower the number of sequences is dropped and packing ends. The number of partitions follows the
number of open pieces, so no task holds more than a bounded number of them.
"""

from __future__ import annotations

import functools
import os
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import arrays as A
from .common import parts_for, stage

PIECES = 50_000         # open pieces of a partition
ROUNDS = 6              # exchanges at most
SLICE = 12 << 20        # bytes of texts whose chunks are collected together
CACHE, SHORT = 1 << 19, 32      # chunks that a worker remembers, and their bytes at most
END = 2                 # id behind each text


# --- tokens ---------------------------------------------------------------------------------------
SPACE, LETTER, DIGIT, MARK = 1, 2, 3, 4      # classes of bytes between which the tokenizer splits; 0: no split is made here


def _classes() -> np.ndarray:
    """Class of each ASCII byte; the apostrophe has none, as it may belong to the letters behind it."""
    out = np.zeros(256, np.int8)
    out[0x21:0x7F] = MARK
    out[0x30:0x3A] = DIGIT
    out[0x41:0x5B] = out[0x61:0x7B] = LETTER
    out[A.IS_SPACE] = SPACE
    out[0x27] = 0
    return out


CLASS = _classes()
BATCH = 16_384          # chunks of one text given to the tokenizer


class Chunks:
    """Token ids of texts from the ids of their distinct chunks.

    The tokenizer splits a text into runs of letters, of digits and of other characters, each with the blank before it, and
    merges bytes inside these alone. Where a run of one class of ASCII bytes (or Latin-1 letters) meets another, or white space begins,
    no split depends on text across the border. So a text's ids are those of its chunks between such borders. Each distinct chunk
    of a slice is asked for once, and a worker remembers up to CACHE short chunks from slice to slice.
    """

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"      # Spark's tasks are the threads
        from tokenizers import Tokenizer
        self.tok = Tokenizer.from_file(path)
        self.tok.encode_special_tokens = True       # their strings in a text are ordinary text
        self.line, = self.tok.encode("\n", add_special_tokens=False).ids
        self.known: dict[bytes, bytes] = {}         # plain chunk -> its ids, four bytes each

    def encode(self, column):
        """(i, ids, offsets) of slices of an Arrow text column; text i + k has ids[offsets[k]:offsets[k + 1]]."""
        buf, off = A.text_bytes(column)
        for i, j in A.slices(off, SLICE):
            yield i, *self._slice(*A.cut(buf, off, i, j))

    def _slice(self, buf: np.ndarray, off: np.ndarray):
        cut = np.zeros(len(buf) + 1, bool)
        cut[off] = True
        kind = CLASS[buf]
        if len(buf) > 1:
            lead = np.flatnonzero(buf[:-1] == 0xC3)             # U+00C0 to U+00FF: letters but for the two signs
            kind[lead] = kind[lead + 1] = np.where((buf[lead + 1] == 0x97) | (buf[lead + 1] == 0xB7), 0, LETTER)
            before, here = kind[:-1], kind[1:]
            cut[1:-1] |= (before > SPACE) & (here > 0) & (before != here)
        edge = np.flatnonzero(cut[:-1]) if len(buf) else np.zeros(0, np.int64)
        ends = np.r_[edge, len(buf)].astype(np.int64)
        words = pa.Array.from_buffers(pa.large_binary(), len(edge), [None, pa.py_buffer(ends), pa.py_buffer(np.ascontiguousarray(buf))])
        coded = words.dictionary_encode()
        which = coded.indices.to_numpy(zero_copy_only=False).astype(np.int64)
        plain = np.ones(len(coded.dictionary), bool)
        odd = ((kind == 0) & (buf != 0x27)) | (kind == SPACE)
        odd[edge] &= buf[edge] != 0x20                           # a blank in front, and no other white space
        plain[which[np.searchsorted(edge, np.flatnonzero(odd), "right") - 1]] = False
        data = self._ids(coded.dictionary.to_pylist(), plain.tolist())
        size = np.fromiter(map(len, data), np.int64, len(data)) // 4
        flat = np.frombuffer(b"".join(data), "<u4")
        at = np.r_[0, np.cumsum(size)]
        to = np.r_[0, np.cumsum(size[which])].astype(np.int64)
        out = flat[np.repeat(at[which] - to[:-1], size[which]) + np.arange(to[-1])]
        return out, to[np.searchsorted(edge, off)]

    def _ids(self, chunks: list[bytes], plain: list[bool]) -> list[bytes]:
        """Ids of each chunk."""
        found = list(map(self.known.get, chunks))
        new = [k for k, x in enumerate(found) if x is None]
        if len(self.known) + len(new) > CACHE:
            self.known.clear()
        many, few = [k for k in new if plain[k]], [k for k in new if not plain[k]]
        for k, x in zip(many, self._plain([chunks[k] for k in many]), strict=True):
            found[k] = x
            if len(chunks[k]) <= SHORT:
                self.known[chunks[k]] = x
        for k, e in zip(few, self.tok.encode_batch_fast([chunks[k].decode() for k in few], add_special_tokens=False), strict=True):
            found[k] = np.array(e.ids, "<u4").tobytes()
        return found

    def _plain(self, chunks: list[bytes]) -> list[bytes]:
        """Plain chunks hold no line end, so many of them are one text with a line end behind each, and the id of the line end parts their ids."""
        texts = [b"".join(c + b"\n" for c in chunks[k:k + BATCH]).decode() for k in range(0, len(chunks), BATCH)]
        ids = np.concatenate([np.zeros(0, "<u4"), *[np.array(e.ids, "<u4") for e in self.tok.encode_batch_fast(texts, add_special_tokens=False)]])
        stop, data = (4 * np.flatnonzero(ids == self.line)).tolist(), ids.tobytes()
        return [data[a:b] for a, b in zip([0, *[x + 4 for x in stop[:-1]]], stop, strict=True)] if stop else []


@functools.lru_cache(2)
def _chunks(path: str) -> Chunks:
    return Chunks(path)


def joined(batches):
    """Batches put together to about SLICE bytes of text."""
    held, size = [], 0
    for batch in batches:
        held.append(batch)
        size += batch.column("text").nbytes
        if size >= SLICE:
            yield from pa.Table.from_batches(held).combine_chunks().to_batches()
            held, size = [], 0
    if held:
        yield from pa.Table.from_batches(held).combine_chunks().to_batches()


def cuts(n: int, size: int) -> list[tuple[int, int]]:
    """(start, length) of the pieces of n ids: whole sequences behind a first piece that may be shorter."""
    first = n % size or min(n, size)
    return [(0, first)] + [(s, size) for s in range(first, n, size)]


PIECE = "piece int, start long, length long, ids_crc32 long"


def pieces(docs: DataFrame, tokenizer: str, size: int, id_col: str = "doc_id", text_col: str = "text", end: int | None = END, keep_ids: bool = False) -> DataFrame:
    """(id, piece, start, length, ids_crc32[, ids]) of every text; ``tokenizer`` is the path of a vocabulary file.

    A null text is an empty one; ``end`` is added to each text, without it an empty text has no piece. Rows that repeat an
    id keep their pieces apart. ``ids`` are little-endian unsigned 32-bit numbers. Other columns are not read.
    """
    # executors have the vocabulary file at the same place, as they have the tokenizer library
    def run(batches):
        chunks = _chunks(tokenizer)
        tail = np.array([] if end is None else [end], "<u4")
        for batch in joined(batches):
            for i, ids, off in chunks.encode(batch.column("text")):
                rows = {k: [] for k in ("at", "piece", "start", "length", "crc", "ids")}
                for k in range(len(off) - 1):
                    whole = np.concatenate([ids[off[k]:off[k + 1]].astype("<u4"), tail])
                    for p, (s, n) in enumerate(cuts(len(whole), size) if len(whole) else []):
                        data = whole[s:s + n].tobytes()
                        for name, v in zip(rows, (i + k, p, s, n, zlib.crc32(data), data if keep_ids else None), strict=True):
                            rows[name].append(v)
                out = [batch.column("id").take(pa.array(rows["at"], pa.int64())), pa.array(rows["piece"], pa.int32()),
                       *[pa.array(rows[c], pa.int64()) for c in ("start", "length", "crc")]]
                out += [pa.array(rows["ids"], pa.binary())] if keep_ids else []
                yield pa.RecordBatch.from_arrays(out, names=["id", "piece", "start", "length", "ids_crc32", *(["ids"] if keep_ids else [])])
    given = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    kind = given.schema["id"].dataType.simpleString()
    return given.mapInArrow(run, f"id {kind}, {PIECE}" + (", ids binary" if keep_ids else "")).withColumnRenamed("id", id_col)


# --- bounds ---------------------------------------------------------------------------------------
def lower_bound(lengths: np.ndarray, size: int, most: int = 256) -> int:
    """Sequences that the lengths need at least: the largest bound of three families of dual-feasible functions.

    For the rounding functions u(k), the threshold functions U(e) and the functions phi(e) of Fekete and Schepers,
    scaled to integers, the sum over the pieces divided by the value of a full sequence is a bound. Every choice of k and e
    is valid; at most ``most`` thresholds are tried, spread over the lengths that occur.
    """
    if not len(lengths):
        return 0
    x, c = np.unique(np.asarray(lengths, np.int64), return_counts=True)
    best = -(-int((x * c).sum()) // size)
    edges = np.unique(np.r_[x[x <= size // 2], (size - x[x > size // 2]) + 1])
    edges = edges[(edges > 0) & (edges <= size // 2)]
    if len(edges) > most:
        edges = edges[np.linspace(0, len(edges) - 1, most).astype(int)]
    for e in edges.tolist():
        high = np.where(x > size - e, size, np.where(x < e, 0, x))
        best = max(best, -(-int((high * c).sum()) // size))
        m = size // e
        phi = np.where(2 * x > size, m - (size - x) // e, np.where(x >= e, 1, 0))
        best = max(best, -(-int((phi * c).sum()) // m))
    for k in range(1, 65):
        whole = (k + 1) * x
        u = np.where(whole % size == 0, k * x, whole // size * size)
        best = max(best, -(-int((u * c).sum()) // (k * size)))
    return best


def best_fit(lengths: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(sequence, offset) of each piece and the room left in each sequence, by best-fit decreasing.

    Sequences are kept by their room; one integer has a bit for each room that some sequence has, so the tightest
    sequence that a piece fits is the lowest set bit from its length on.
    """
    order = np.argsort(-lengths, kind="stable")
    where, offset, room = np.zeros(len(lengths), np.int64), np.zeros(len(lengths), np.int64), []
    open_, bits = [[] for _ in range(size + 1)], 0
    for i in order.tolist():
        n = int(lengths[i])
        fit = bits >> n
        if fit:
            r = n + (fit & -fit).bit_length() - 1
            b = open_[r].pop()
            if not open_[r]:
                bits ^= 1 << r
        else:
            r, b = size, len(room)
            room.append(size)
        where[i], offset[i], left = b, size - r, r - n
        room[b] = left
        open_[left].append(b)
        bits |= 1 << left
    return where, offset, np.array(room, np.int64)


# --- rounds ---------------------------------------------------------------------------------------
def _packer(size: int, number: int):
    def pack(group: pa.Table) -> pa.Table:
        group = group.sort_by("__u")
        length = group["length"].to_numpy()
        where, offset, room = best_fit(length, size)
        bound = lower_bound(length, size)
        if len(room) > bound:
            again = room > 0
        else:
            again = np.zeros(len(room), bool)
            again[np.argmax(room)] = room.max() > 0
        base = (number << 56) | (group["__g"][0].as_py() << 28)
        out = group.drop_columns(["__g"])
        return (out.append_column("sequence_id", pa.array(base + where)).append_column("offset", pa.array(offset))
                .append_column("again", pa.array(again[where])).append_column("bound", pa.array(np.full(len(length), bound))))
    return pack


def pack(cut: DataFrame, size: int, rounds: int = ROUNDS) -> DataFrame:
    """Rows of ``cut`` (integer column ``length`` from 1 to ``size``) with sequence_id and offset, both long.

    Columns of these names, or ``__u`` and ``__g``, are replaced; other columns pass through. Pieces of one sequence have
    offsets without gaps from 0. An empty table gives an empty table.
    """
    return Packing(cut, size, rounds).sequences


class Packing:
    """Packed rows (``sequences``), and per round the partitions, sequences and bounds (``report``, a list of dicts)."""

    def __init__(self, cut: DataFrame, size: int, rounds: int = ROUNDS):
        spark = cut.sparkSession
        names = [c for c in cut.columns if c not in ("sequence_id", "offset", "__u", "__g", "again", "bound")]
        rows = stage(spark, cut.select(*names, F.monotonically_increasing_id().alias("__u")), "pack-pieces")
        # full pieces are sequences of their own
        done = [rows.where(F.col("length") == size).select(*names, F.col("__u").bitwiseOR(F.lit(1 << 62)).alias("sequence_id"), F.lit(0).cast("long").alias("offset"))]
        state, held, self.report = rows.where(F.col("length") < size), None, []
        for r in range(rounds):
            count = state.count()
            if not count:
                break
            parts = parts_for(count, PIECES)
            dealt = state.select(*names, "__u", F.pmod(F.xxhash64("__u", F.lit(r)), F.lit(parts)).alias("__g"))
            schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in dealt.drop("__g").schema) + ", sequence_id long, offset long, again boolean, bound long"
            packed = stage(spark, dealt.groupBy("__g").applyInArrow(_packer(size, r), schema), f"pack-{r}")
            told = self._told(packed, r, parts)
            if held is not None and told["sequences"] >= self.report[-1]["reopened"]:
                break                                                   # the exchange did not help: the sequences of before stand
            self.report.append(told)
            done.append(packed.where(~F.col("again")).select(*names, "sequence_id", "offset"))
            held = packed.where("again")
            state = held.select(*names, "__u")
            if parts == 1:
                break
        if held is not None:
            done.append(held.select(*names, "sequence_id", "offset"))
        out = done[0]
        for d in done[1:]:
            out = out.unionByName(d)
        self.sequences = out

    @staticmethod
    def _told(packed: DataFrame, r: int, parts: int) -> dict:
        """Sums over the partitions of a round."""
        bins = packed.groupBy("sequence_id").agg(F.first("again").alias("again"), F.first("bound").alias("bound"))
        by_part = bins.groupBy(F.shiftright("sequence_id", 28).alias("g")).agg(
            F.count(F.lit(1)).alias("n"), F.count(F.when(F.col("again"), 1)).alias("again"), F.first("bound").alias("bound"))
        n, again, bound, certified = by_part.agg(F.sum("n"), F.sum("again"), F.sum("bound"), F.count(F.when(F.col("n") == F.col("bound"), 1))).first()
        return {"round": r, "partitions": parts, "sequences": n, "bound": bound, "certified": certified, "reopened": again}
