"""Mixing sources to target weights by hierarchical budgeting.

A token budget goes down the tree domain -> language -> source. At each node the
children share the node's budget by weight; a child never gets more than its
capacity (tokens of its documents times ``max_epochs``), and what it cannot
use is shared by its siblings first: only when a whole subtree is full does the
rest reach the ancestors' other children. Budgets are exact integers (floors;
the remainder, less than one token per child, is not given out).

A leaf spends its budget in seeded epochs: each epoch is an order of the
leaf's documents by md5(seed, epoch, doc id). Whole epochs are taken first,
then the longest prefix of the next epoch whose tokens fit the rest.

The prefix is found without sorting a leaf in one task: tokens are summed per
(leaf, 12-bit bucket of the order key), a window over those sums names the
boundary bucket, the same inside that bucket names a 4,096th of it, and only the documents of that part are ordered.
The decision is one cut-off key per leaf, joined back to the documents.

Defined cases: null language or source is the group ``?``; documents without
tokens go with their neighbours in the order, a leaf without any token gives nothing;
repeated rows share an order key and are taken together or not at all;
empty tables give empty results; input columns named ``epoch`` or ``__domain`` are replaced.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import stage

LEAF = ["__domain", "__lang", "__source"]
BUCKET_HEX = 3      # 4,096 buckets of the order key per leaf


def weight_of(level: Column, weights: dict[str, int], other: int = 1) -> Column:
    """Integer weight of a node by its name; names not listed get ``other``."""
    out = F.lit(other)
    for name, w in weights.items():
        out = F.when(level == name, F.lit(int(w))).otherwise(out)
    return out.cast("decimal(18,0)")


def n_tokens(text: Column) -> Column:
    return F.regexp_count(F.coalesce(text, F.lit("")), F.lit(r"[^\x20\x09-\x0D]+")).cast("long")


def share_out(children: DataFrame, parent: list[str], name: str) -> DataFrame:
    """Water-filling inside each parent: (.., budget, w, cap) -> alloc.

    Children stand by capacity per weight; the ones before the level are
    full, the others share the rest by weight.
    """
    order = Window.partitionBy(*parent) if parent else Window.partitionBy(F.lit(0))
    order = order.orderBy("__ratio", name)
    upto, after = order.rowsBetween(Window.unboundedPreceding, -1), order.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    zero = F.lit(0).cast("decimal(38,0)")
    d = children.withColumn("__ratio", F.col("cap").cast("double") / F.col("w").cast("double"))
    d = d.withColumns({"__before": F.coalesce(F.sum("cap").over(upto), zero), "__w": F.sum("w").over(after)})
    d = d.withColumn("__left", F.greatest(F.col("budget") - F.col("__before"), zero))
    full = F.col("cap") * F.col("__w") <= F.col("__left") * F.col("w")
    d = d.withColumn("__full", F.min(full.cast("int")).over(order.rowsBetween(Window.unboundedPreceding, 0)) == 1)
    whole = Window.partitionBy(*parent) if parent else Window.partitionBy(F.lit(0))
    d = d.withColumns({"__used": F.coalesce(F.sum(F.when(F.col("__full"), F.col("cap"))).over(whole), zero),
                       "__open": F.sum(F.when(~F.col("__full"), F.col("w"))).over(whole)})
    part = F.expr("CAST((budget - __used) * w AS DECIMAL(38,0)) DIV __open")
    alloc = F.when(F.col("__full"), F.col("cap")).otherwise(F.least(part.cast("decimal(38,0)"), F.col("cap")))
    return d.withColumn("alloc", alloc.cast("decimal(38,0)")).drop("__ratio", "__before", "__w", "__left", "__full", "__used", "__open")


def budgets(leaves: DataFrame, weights: dict[str, dict[str, int]], share_num: int, share_den: int, max_epochs: int) -> DataFrame:
    """(leaf, supply) -> (leaf, supply, alloc). The budget is share_num / share_den of all tokens."""
    dec = "decimal(38,0)"
    leaves = leaves.withColumn("supply", F.col("supply").cast("decimal(20,0)"))
    leaves = leaves.withColumn("cap", (F.col("supply") * max_epochs).cast("decimal(20,0)"))
    total = leaves.agg(F.expr(f"CAST(coalesce(sum(supply), 0) * {share_num} AS DECIMAL(38,0)) DIV {share_den}").cast(dec).alias("budget"))
    level, parent = None, []
    for i, name in enumerate(LEAF):
        keys = LEAF[:i + 1]
        kids = leaves.groupBy(*keys).agg(F.sum("cap").cast("decimal(20,0)").alias("cap"))
        kids = kids.withColumn("w", weight_of(F.col(name), weights.get(name[2:], {})))
        # the total is one row; a parent table has one row per node
        kids = (kids.withColumn("__one", F.lit(1)).join(F.broadcast(total.withColumn("__one", F.lit(1))), "__one").drop("__one") if level is None
                else kids.join(level, parent))
        level = share_out(kids.withColumn("budget", F.col("budget").cast("decimal(20,0)")), parent, name).select(*keys, F.col("alloc").alias("budget"))
        parent = keys
    return leaves.join(level.withColumnRenamed("budget", "alloc"), LEAF)


def order_key(seed: str, epoch: Column, doc_id: Column) -> Column:
    return F.md5(F.concat_ws(":", F.lit(seed), epoch.cast("string"), F.coalesce(doc_id.cast("string"), F.lit(""))).cast("binary"))


def plan(docs: DataFrame, domain: Column, weights: dict, seed: str, share=(1, 1), max_epochs: int = 2,
         doc_id: str = "doc_id", text: str = "text", lang: str = "lang", source: str = "source") -> DataFrame:
    """One row per leaf: supply, alloc, whole epochs and the cut-off key of the next one (null: none of it)."""
    spark = docs.sparkSession
    slim = stage(spark, docs.select(F.col(doc_id).alias("__id"), *leaf_columns(domain, lang, source), n_tokens(F.col(text)).alias("__n")), "mix-docs")
    leaves = slim.groupBy(*LEAF).agg(F.sum("__n").alias("supply"))
    quota = budgets(leaves, weights, *share, max_epochs)
    quota = stage(spark, quota.where("supply > 0").select(
        *LEAF, F.col("supply").cast("long").alias("supply"), F.col("alloc").cast("long").alias("alloc"),
        F.expr("CAST(alloc DIV supply AS INT)").alias("whole"), F.expr("CAST(alloc % supply AS BIGINT)").alias("rest")), "mix-quota")
    inside = (slim.join(quota.where("rest > 0").select(*LEAF, "whole", "rest"), LEAF)
              .withColumns({"__u": order_key(seed, F.col("whole"), F.col("__id")), "__start": F.lit(0).cast("long")}))
    for digits in (BUCKET_HEX, 2 * BUCKET_HEX):             # the bucket of the cut, then its part of it: 1 / 16,777,216 of a leaf is put in order
        inside = inside.withColumn("__b", F.substring("__u", 1, digits))
        sums = inside.groupBy(*LEAF, "rest", "__start", "__b").agg(F.sum("__n").alias("__n"))
        run = sums.withColumn("__end", F.col("__start") + F.sum("__n").over(Window.partitionBy(*LEAF).orderBy("__b")))
        # the first bucket that goes beyond the rest; the buckets before it are taken whole
        edge = (run.where("__end > rest").groupBy(*LEAF).agg(F.min(F.struct("__b", (F.col("__end") - F.col("__n")).alias("__start"))).alias("e"))
                .select(*LEAF, F.col("e.__b").alias("__b"), F.col("e.__start").alias("__start")))
        edge = stage(spark, edge, "mix-edge")               # a row per leaf
        inside = inside.drop("__start").join(edge, [*LEAF, "__b"])
    byu = inside.groupBy(*LEAF, "rest", "__b", "__start", "__u").agg(F.sum("__n").alias("__n"))
    cum = byu.withColumn("__c", F.col("__start") + F.sum("__n").over(Window.partitionBy(*LEAF).orderBy("__u")))
    last = cum.where("__c <= rest").groupBy(*LEAF).agg(F.max("__u").alias("__u"))
    # without a fitting document in the edge bucket the cut stands just before that bucket
    cut = edge.join(last, LEAF, "left").select(*LEAF, F.coalesce("__u", "__b").alias("cut"))
    return quota.join(cut, LEAF, "left")


def leaf_columns(domain: Column, lang: str, source: str) -> list[Column]:
    name = lambda c: F.coalesce(c.cast("string"), F.lit("?"))
    return [name(domain).alias(LEAF[0]), name(F.col(lang)).alias(LEAF[1]), name(F.col(source)).alias(LEAF[2])]


def select_mix(docs: DataFrame, domain: Column, weights: dict, seed: str, share=(1, 1), max_epochs: int = 2,
               doc_id: str = "doc_id", text: str = "text", lang: str = "lang", source: str = "source") -> DataFrame:
    """The selected documents, once per epoch that takes them, with ``epoch`` (0-based) and ``__domain`` (input columns of these
    two names are replaced; all others stay, whatever their names)."""
    names = docs.columns
    at = {n.lower(): f"c{k}" for k, n in enumerate(names)}
    own = docs.select(*[F.col(f"`{n}`") for n in names], domain.cast("string"))
    own = own.toDF(*[f"c{k}" for k in range(len(names))], "given")          # so no column can clash with those of the plan
    row_id, body, lang, source = (at[c.lower()] for c in (doc_id, text, lang, source))
    leaves = stage(docs.sparkSession, plan(own, F.col("given"), weights, seed, share, max_epochs, row_id, body, lang, source), "mix-plan")
    base = own.withColumns(dict(zip(LEAF, leaf_columns(F.col("given"), lang, source), strict=True)))
    d = base.join(leaves.select(*LEAF, *[F.col(c).alias(f"__{c}") for c in ("whole", "rest", "cut")]), LEAF)
    u = order_key(seed, F.col("__whole"), F.col(row_id))
    more = (F.col("__rest") > 0) & (F.col("__cut").isNull() | (u <= F.col("__cut")))
    d = d.withColumn("__copies", F.col("__whole") + more.cast("int")).where("__copies > 0")
    d = d.withColumn("epoch", F.explode(F.sequence(F.lit(0), F.col("__copies") - 1)))
    return d.select(*[F.col(f"c{k}").alias(n) for k, n in enumerate(names) if n.lower() not in ("epoch", LEAF[0])], F.col(LEAF[0]), "epoch")
