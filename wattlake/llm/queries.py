"""Registered ``opN_*`` queries: each operator on its whole table with production parameters."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import crf_lines, decontaminate, langid_rnn, lm_score, merkle, mixing, ngram_join, packing, quality_knn, repeats, resample, sharding, url_rules
from .common import crc_mod, prepare, table

QUERIES: dict = {}


def query(fn):
    def run_query(spark: SparkSession, sf_dir: str) -> DataFrame:
        prepare(spark)
        return fn(spark, sf_dir)
    run_query.__name__, run_query.__doc__ = fn.__name__, fn.__doc__
    QUERIES[fn.__name__] = run_query
    return run_query


# --- production parameters -----------------------------------------------------------------------
SITE_RULES = [("com/", "allow"), ("example.com/en/", "block"), ("www.example.com/en/", "allow"), ("net/es/", "block"), ("net/fr/", "block")]
PATTERN_RULES = [(p, "block") for p in (
    "ads-track", "casino-*", "*-casino", "free-bets", "poker", "cheap-pills", "viagra", "porn", "xxx", "torrent", "warez")]
URL_RULES = [url_rules.Rule(t, a) for t, a in SITE_RULES] + [url_rules.Rule(t, a, site=False) for t, a in PATTERN_RULES]

SHARDS = [f"shard-{i:02d}" for i in range(32)]

MIX_WEIGHTS = {"domain": {"web": 5, "books": 3, "code": 2}, "lang": {"en": 4, "de": 3, "fr": 2, "es": 1}}
MIX_SEED = "mix-1"
MIX_EPOCHS = 2

QUALITY_CUT = 0.3


def domain_of(source="source"):
    """Domain of a source: three groups by the first hex digit of its md5."""
    digit = F.substring(F.md5(F.coalesce(F.col(source), F.lit("")).cast("binary")), 1, 1)
    return F.when(digit < "6", "web").when(digit < "b", "books").otherwise("code")
# ---------------------------------------------------------------------------------------------------


@query
def op1_language_id(spark, sf_dir):
    """Bidirectional recurrent network over bytes: language of every whole text."""
    docs = table(spark, sf_dir, "documents")
    net = langid_rnn.fit(docs.where(crc_mod("doc_id", 4) != 2).select("doc_id", "text", "lang"))
    return langid_rnn.predict(docs.select("doc_id", (crc_mod("doc_id", 4) == 2).alias("held_out"), "text"), net).drop("text")


@query
def op2_url_rules(spark, sf_dir):
    """Site and pattern rules by their rarest token: verdict of every page url."""
    return url_rules.judge(table(spark, sf_dir, "pages"), URL_RULES)


@query
def op3_ngram_join(spark, sf_dir):
    """Jaccard join of 3-word shingle sets: set size and component of every document."""
    joined = ngram_join.join(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return joined.select("doc_id", "n_shingles", "component_id")


@query
def op4_sharding(spark, sf_dir):
    """Shard of every document from the permutation-filled lookup table."""
    return sharding.assign(table(spark, sf_dir, "documents").select("doc_id", "source"), "doc_id", SHARDS)


@query
def op5_quality_classifier(spark, sf_dir):
    """Nearest-neighbour vote in the latent space: quality score of every whole text."""
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    model = quality_knn.fit(docs, labels.where(crc_mod("doc_id", 5) != 0))
    scored = quality_knn.score(docs.select("doc_id", (crc_mod("doc_id", 5) == 0).alias("held_out"), "text"), model)
    return scored.select("doc_id", "held_out", "score", (F.col("score") >= QUALITY_CUT).cast("int").alias("predicted"))


@query
def op6_quality_rules(spark, sf_dir):
    """Base figures of every whole text, and the verdict of the line labelling."""
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    field = crf_lines.fit(docs, labels)
    return crf_lines.judge(docs.select("doc_id", "text"), field).drop("text")


@query
def op7_mixing(spark, sf_dir):
    """Documents selected under hierarchical token budgets, once per epoch that takes them."""
    docs = table(spark, sf_dir, "documents")
    mixed = mixing.select_mix(docs.select("doc_id", "text", "lang", "source"), domain_of(), MIX_WEIGHTS, MIX_SEED, (1, 1), MIX_EPOCHS)
    return mixed.select("doc_id", F.col("__domain").alias("domain"), "lang", "source", "epoch")


@query
def op8_substring_dedup(spark, sf_dir):
    """Every whole text without the words of windows that stand in an earlier document."""
    kept = repeats.remove_repeats(table(spark, sf_dir, "documents"))
    return kept.select("doc_id", "n_words", "n_removed", F.sha2(F.col("kept_text").cast("binary"), 256).alias("kept_sha256"))


@query
def op9_decontaminate(spark, sf_dir):
    """Every benchmark passage within the edit threshold, found in any whole text."""
    docs = table(spark, sf_dir, "documents")
    return decontaminate.hits(docs.select("doc_id", "text"), table(spark, sf_dir, "benchmark"))


@query
def op10_lm_score(spark, sf_dir):
    """Stupid-backoff trigram scores of every whole text, counts over all documents."""
    return lm_score.score(table(spark, sf_dir, "documents"))


@query
def op13_merkle_manifest(spark, sf_dir):
    """Merkle log by language: root, proof and verification of every row; every third id shows a text in lower case."""
    tampered = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 0
    low = F.translate("text", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    made = merkle.manifest(table(spark, sf_dir, "documents"), shown={"text": F.when(tampered, low).otherwise(F.col("text"))})
    return made.proofs().withColumnRenamed("id", "doc_id")


DRAW_SHARE = (5, 100)


@query
def op12_importance_resampling(spark, sf_dir):
    """Weights of all documents towards the benchmark's n-gram distribution, and the seeded draw of 5 of 100."""
    docs = table(spark, sf_dir, "documents")
    return resample.ranked(docs, resample.fit(docs, table(spark, sf_dir, "benchmark")), DRAW_SHARE)


SEQUENCE = 1024
TOKENIZER = "byte_bpe_50k.json"


@query
def op11_best_fit_packing(spark, sf_dir):
    """Pieces of all texts as token ids, packed into sequences of 1024."""
    import public_tokenizers
    cut = packing.pieces(table(spark, sf_dir, "documents"), public_tokenizers.path(TOKENIZER), SEQUENCE)
    return packing.pack(cut, SEQUENCE)
