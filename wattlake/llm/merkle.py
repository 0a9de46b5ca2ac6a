"""Merkle manifest of a table as a postorder append log.

Each tree (one per value of a column) has the rows as leaves, in order of their id; every run of eight nodes of a level,
the last run shorter, has one parent, until one node is left. The trees' top nodes are the leaves of one more tree.

The log holds every node at its postorder place, the place it gets when nodes are appended as soon as they are complete:

* a leaf i stands after the i leaves and the i // 8 + i // 64 + ... nodes completed before it;
* a node whose leaves are all there stands ``level`` places behind its last leaf;
* the nodes of the right edge that the last run leaves short stand at the end, lowest first.

So a place follows from the number of leaves, the level and the index alone, and a builder that holds an aligned range
of 512 leaves appends its nodes without asking another builder. The tops of the builders are the input of the next
round of builders. A proof reads the siblings' places from the log: each builder's rows meet its segment of the log
and the proof of its own top node, from the last round down.
"""

from __future__ import annotations

from hashlib import sha256

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import stage
from .places import indexed

FAN = 8                 # children of a node
LEVELS = 3              # levels that one builder adds
SPAN = FAN ** LEVELS    # nodes that one builder reads
FOREST = ""             # tree of the trees' tops; the trees themselves are '=' + value, and the null value is '-'


# --- closed forms ---------------------------------------------------------------------------------
def height(n: int) -> int:
    """Levels above the leaves of a tree of n leaves."""
    h = 0
    while FAN ** h < n:
        h += 1
    return h


def width(n: int, level: int) -> int:
    """Nodes of a level."""
    return -(-n // FAN ** level)


def position(n: int, level: int, index):
    """Postorder place of a node (``index``: number or array) in the log of a tree of n leaves."""
    index = np.asarray(index, np.int64)
    powers = [FAN ** k for k in range(1, height(n) + 1)]
    last = np.minimum((index + 1) * FAN ** level, n) - 1
    whole = last + sum(last // p for p in powers) + level
    first_short = next((k for k in range(1, height(n) + 1) if n % FAN ** k), 0)
    edge = n + sum(n // p for p in powers) + level - first_short
    return np.where((index + 1) * FAN ** level <= n, whole, edge)


def nodes(n: int) -> int:
    return sum(width(n, k) for k in range(height(n) + 1))


def siblings(n: int, level: int, index: int) -> tuple[int, int, int]:
    """(first index of the node's run, its length, the node's place in it)."""
    first = index // FAN * FAN
    return first, min(FAN, width(n, level) - first), index - first


# --- leaves ---------------------------------------------------------------------------------------
def digest(columns: list[Column]) -> Column:
    """Lowercase hex sha256 of the values: ``-`` for a null, else UTF-8 byte count, ``:`` and the value as text."""
    field = [F.coalesce(F.concat(F.octet_length(c.cast("string")).cast("string"), F.lit(":"), c.cast("string")), F.lit("-")) for c in columns]
    return F.sha2(F.concat(*field).cast("binary"), 256)


def tree_of(column: Column) -> Column:
    """Name of a row's tree; names sort like the values, null first."""
    return F.coalesce(F.concat(F.lit("="), column.cast("string")), F.lit("-"))


def node(children: list[str]) -> str:
    return sha256("".join(children).encode()).hexdigest()


# --- log ------------------------------------------------------------------------------------------
LOG = "tree string, level int, index long, position long, digest binary"


def _append(round_: int):
    """A builder: nodes of level LEVELS * round_ -> its part of the log, in order of completion."""
    low = LEVELS * round_

    def build(group: pa.Table) -> pa.Table:
        group = group.sort_by("index")
        tree, n, at = group["tree"][0].as_py(), group["n"][0].as_py(), group["index"][0].as_py()
        row = [x.hex() for x in group["digest"].to_pylist()]
        level, index, value = [], [], []

        def add(k, first, found):
            level.append(np.full(len(found), k, np.int32))
            index.append(np.arange(first, first + len(found)))
            value.extend(bytes.fromhex(x) for x in found)
        if not low:
            add(0, at, row)                                     # upper builders' inputs are in the log already
        for k in range(low + 1, min(low + LEVELS, height(n)) + 1):
            row, at = [node(row[i:i + FAN]) for i in range(0, len(row), FAN)], at // FAN
            add(k, at, row)
        place = [position(n, int(a[0]), b) for a, b in zip(level, index, strict=True)]
        order = np.argsort(np.concatenate(place))
        return pa.table({"tree": [tree] * len(order), "level": np.concatenate(level)[order], "index": np.concatenate(index)[order],
                         "position": np.concatenate(place)[order], "digest": pa.array([value[i] for i in order], pa.binary())})
    return build


def grow(leaves: DataFrame) -> DataFrame:
    """Log of all trees from (tree, index, n, digest binary); a round reads only the tops of the round before."""
    spark, parts, rows = leaves.sparkSession, [], leaves
    sizes = stage(spark, leaves.select("tree", "n").distinct(), "merkle-trees")
    most = sizes.agg(F.max("n")).first()[0] or 0
    for r in range(max(1, -(-height(most) // LEVELS))):
        made = rows.groupBy("tree", F.expr(f"index div {SPAN}").alias("builder")).applyInArrow(_append(r), LOG)
        parts.append(stage(spark, made, f"merkle-log-{r}"))
        rows = parts[-1].where(F.col("level") == LEVELS * (r + 1)).join(sizes.where(F.col("n") > SPAN ** (r + 1)), "tree")
    log = parts[0]
    for p in parts[1:]:
        log = log.unionByName(p)
    return log


def tops(log: DataFrame, sizes: DataFrame) -> DataFrame:
    """(tree, n, digest) of each tree's last node."""
    last = log.groupBy("tree").agg(F.max(F.struct("position", "digest")).alias("t"))
    return last.join(sizes, "tree").select("tree", "n", F.col("t.digest").alias("digest"))


# --- proofs ---------------------------------------------------------------------------------------
ABOVE = "tree string, builder long, path binary, subroot binary, forest_index long, forest_n long"


def _levels(n: int, low: int):
    return range(low, min(low + LEVELS, height(n)))


def _segment(log: pa.Table):
    """(places, digests) of a segment in order of place."""
    log = log.sort_by("position")
    return log["position"].to_numpy(), [x.hex() for x in log["digest"].to_pylist()]


def _run(places, digests, n, k, index):
    """Digests of a node's run, found by their closed-form places."""
    first, size, own = siblings(n, k, index)
    at = np.searchsorted(places, position(n, k, np.arange(first, first + size)))
    return [digests[i] for i in at], own


def _climb(places, digests, n, low, index, runs):
    """The runs of a node's ancestors inside a segment, each read from the log once."""
    for k in _levels(n, low):
        key = (k, index // FAN)
        if key not in runs:
            runs[key] = _run(places, digests, n, k, index // FAN * FAN)[0]
        yield runs[key], index % FAN
        index //= FAN


def _lower(round_: int):
    """Segment of a builder and the path of its top -> the path of each of its input nodes."""
    low = LEVELS * round_

    def extend(log: pa.Table, above: pa.Table) -> pa.Table:
        if not len(log) or not len(above):
            return pa.table({f: pa.array([], t) for f, t in (
                ("tree", pa.string()), ("builder", pa.int64()), ("path", pa.binary()), ("subroot", pa.binary()), ("forest_index", pa.int64()), ("forest_n", pa.int64()))})
        up = above.to_pylist()[0]
        n = log["n"][0].as_py()
        places, digests = _segment(log)
        own, runs, paths = sorted(log.filter(pa.compute.equal(log["level"], low))["index"].to_pylist()), {}, []
        for i in own:
            found = "".join("".join(run[:p] + run[p + 1:]) for run, p in _climb(places, digests, n, low, i, runs))
            paths.append(bytes.fromhex(found) + up["path"])
        return pa.table({"tree": [up["tree"]] * len(own), "builder": pa.array(own, pa.int64()), "path": pa.array(paths, pa.binary()),
                         "subroot": pa.array([up["subroot"]] * len(own), pa.binary()), "forest_index": pa.array([up["forest_index"]] * len(own), pa.int64()),
                         "forest_n": pa.array([up["forest_n"]] * len(own), pa.int64())})
    return extend


def _prove(id_type: pa.DataType):
    def prove(leaves: pa.Table, both: pa.Table) -> pa.Table:
        """Rows of a builder, its segment and the path of its top -> proof, and the root folded from the digest shown."""
        log = both.filter(pa.compute.is_valid(both["position"]))
        up = both.filter(pa.compute.is_null(both["position"])).to_pylist()[0]
        n = leaves["n"][0].as_py()
        places, digests = _segment(log)
        runs, rest, proofs, folded = {}, up["path"].hex(), [], []
        for i, shown in zip(leaves["index"].to_pylist(), leaves["shown"].to_pylist(), strict=True):
            cur, found = shown.hex(), []
            for run, p in _climb(places, digests, n, 0, i, runs):
                left, right = "".join(run[:p]), "".join(run[p + 1:])
                found += [left, right]
                cur = sha256((left + cur + right).encode()).hexdigest()
            at = 0
            for size, own in _above(n, i, up["forest_n"], up["forest_index"]):
                cut = at + 64 * own
                end = at + 64 * (size - 1)
                cur = sha256((rest[at:cut] + cur + rest[cut:end]).encode()).hexdigest()
                at = end
            proofs.append(sha256(("".join(found) + rest).encode()).hexdigest())
            folded.append(cur)
        return pa.table({"id": leaves["id"].cast(id_type), "leaf": [x.hex() for x in leaves["digest"].to_pylist()],
                         "subroot": [up["subroot"].hex()] * len(leaves), "proof_sha256": proofs, "folded_root": folded})
    return prove


def _above(n, index, forest_n, forest_index):
    """(length of the run, own place) at each level over a first builder: in the tree, then in the forest."""
    for size, first, at in ((n, LEVELS, index // SPAN), (forest_n, 0, forest_index)):
        for k in range(first, height(size)):
            _, length, own = siblings(size, k, at)
            yield length, own
            at //= FAN


def _paths(log: DataFrame, sizes: DataFrame, above: DataFrame, down_to: int):
    """Paths of all nodes that builders of round ``down_to`` have as tops, from the paths ``above`` of the trees' tops.

    ``above`` has a row per tree with ``round``, the round of its last builder.
    """
    spark = log.sparkSession
    last = above.agg(F.max("round")).first()[0] or 0
    names, found = [c.split()[0] for c in ABOVE.split(", ")], None
    for r in range(last, down_to - 1, -1):
        start = above.where(F.col("round") == r).select(*names)
        found = start if found is None else found.unionByName(start)
        if r == down_to:
            break
        seg = _segments(log, r).join(sizes, "tree")
        found = stage(spark, seg.groupBy("tree", "builder").cogroup(found.groupBy("tree", "builder")).applyInArrow(_lower(r), ABOVE), f"merkle-path-{r}")
    return found


def _segments(log: DataFrame, r: int) -> DataFrame:
    """Nodes of the levels that builders of round r read as siblings, with the builder's number."""
    low, out = LEVELS * r, None
    for k in range(LEVELS):
        part = log.where(F.col("level") == low + k).withColumn("builder", F.expr(f"index div {FAN ** (LEVELS - k)}"))
        out = part if out is None else out.unionByName(part)
    return out


class Manifest:
    """Log, sizes and root of a table; ``leaves`` has id, tree, index, n, digest and the digest shown (binary)."""

    def __init__(self, leaves: DataFrame):
        spark = leaves.sparkSession
        self.leaves = leaves
        core = leaves.select("tree", "index", "n", "digest")
        self.sizes = stage(spark, core.select("tree", "n").distinct(), "merkle-sizes")
        self.log = grow(core)
        trees = indexed(tops(self.log, self.sizes).select(F.lit(FOREST).alias("g"), "tree", F.col("n").alias("leaves"), "digest"), "g", [F.col("tree")], "index", "m")
        self.trees = stage(spark, trees.withColumnRenamed("digest", "subroot"), "merkle-roots")
        top = self.trees.select(F.lit(FOREST).alias("tree"), "index", F.col("m").alias("n"), F.col("subroot").alias("digest"))
        self.forest = grow(top)
        root = self.forest.orderBy(F.desc("position")).select("digest").first()
        self.root = root[0].hex() if root else None             # one digest

    def proofs(self) -> DataFrame:
        """(id, leaf, subroot, root, proof_sha256, folded_root, verified) of every row."""
        spark = self.leaves.sparkSession
        names = [c.split()[0] for c in ABOVE.split(", ")]
        # the forest's own path starts empty at its top
        forest = self.trees.select(F.lit(FOREST).alias("tree"), F.col("m").alias("n")).distinct()
        start = forest.select("tree", F.lit(0).cast("long").alias("builder"), F.lit(b"").alias("path"), F.lit(b"").alias("subroot"),
                              F.lit(0).cast("long").alias("forest_index"), F.lit(1).cast("long").alias("forest_n"), _last_round("n").alias("round"))
        above = _paths(self.forest, forest, start, 0)
        seg = _segments(self.forest, 0).join(forest, "tree")
        path = stage(spark, seg.groupBy("tree", "builder").cogroup(above.groupBy("tree", "builder")).applyInArrow(_lower(0), ABOVE), "merkle-forest")
        start = self.trees.join(path.select(F.col("builder").alias("index"), "path"), "index").select(
            "tree", F.lit(0).cast("long").alias("builder"), "path", "subroot", F.col("index").alias("forest_index"), F.col("m").alias("forest_n"),
            _last_round("leaves").alias("round"))
        up = _paths(self.log, self.sizes, stage(spark, start, "merkle-above"), 0)
        seg = _segments(self.log, 0).select("tree", "builder", "position", "digest", *[F.lit(None).cast(t).alias(c) for c, t in (
            ("path", "binary"), ("subroot", "binary"), ("forest_index", "long"), ("forest_n", "long"))])
        up = up.select("tree", "builder", F.lit(None).cast("long").alias("position"), F.lit(None).cast("binary").alias("digest"), *names[2:])
        left = self.leaves.withColumn("builder", F.expr(f"index div {SPAN}"))
        id_type = left.schema["id"].dataType
        from pyspark.sql.pandas.types import to_arrow_type
        out = left.groupBy("tree", "builder").cogroup(seg.unionByName(up).groupBy("tree", "builder")).applyInArrow(
            _prove(to_arrow_type(id_type)), f"id {id_type.simpleString()}, leaf string, subroot string, proof_sha256 string, folded_root string")
        root = F.lit(self.root)
        return out.withColumns({"root": root, "verified": F.col("folded_root") == root})


def _last_round(n: str) -> Column:
    """Round of a tree's last builder."""
    steps = F.lit(0)
    for r in range(1, 20 // LEVELS):
        steps = F.when(F.col(n) > FAN ** (LEVELS * r), F.lit(r)).otherwise(steps)
    return steps


def manifest(docs: DataFrame, id_col: str = "doc_id", tree_col: str = "lang", fields=("doc_id", "source", "lang", "n_chars", "text"),
             shown: dict[str, Column] | None = None) -> Manifest:
    """Build the log of ``docs``: a leaf per row, a tree per value of ``tree_col`` (null: a tree of its own, the first).

    ``shown`` maps a field to the value that a verifier sees; proofs fold from it. Leaves ascend by id (null first);
    rows with one id are ordered by their digest, equal rows stay apart as equal leaves. Empty texts are values, not nulls.
    Columns that are not in ``fields`` are not read and names cannot clash, as only ids and digests are carried.
    An empty table has no root and no rows. Fields are read as text, so integers are decimal.
    """
    shown = shown or {}
    own = digest([F.col(f) for f in fields])
    seen = digest([shown.get(f, F.col(f)) for f in fields]) if shown else own
    rows = docs.select(F.col(id_col).alias("id"), tree_of(F.col(tree_col)).alias("tree"), F.unhex(own).alias("digest"), F.unhex(seen).alias("shown"))
    placed = indexed(rows, "tree", [F.col("id").asc_nulls_first(), F.col("digest")], "index", "n")
    return Manifest(stage(docs.sparkSession, placed, "merkle-leaves"))
