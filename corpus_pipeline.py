"""A training-data pipeline over ``documents``: language, toxicity, near duplicates, packing.

Each stage takes the rows its predecessor kept, in the columns of ``documents``, and is written
before the next one reads it. Learned stages learn from their own input.

Defined cases: rows with a null id are kept by the near-duplicate stage, as no one can tell them
apart; rows that repeat an id with the same text are one group of duplicates, different texts that
share an id are linked as one document and stay or go together; an empty input stays empty. Columns beyond id, text and language pass through unread.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from layerloom.llm import language_ranks, packing, shingle_join, toxicity
from layerloom.llm.common import bit_map, in_bit_map, read, ship, stage
from layerloom.llm.registry import BYTE_BPE, LANGUAGE_FOLDS, TOXICITY_FOLDS

# Texts whose score is lower resemble no language that was learned.
MIN_LANGUAGE_SCORE = 0.35
# Near duplicates share 80 of 100 shingles of five words. op6's own contract (four, 85) binds only op6.
NEAR_WORDS, NEAR_PERCENT = 5, 80
_KEY = ("doc_id", "_text_hash")
# The map of rejected keys: 2^18 longs, 2 MB. A fuller one lets more rows through to the join.
MAP_BITS = 18


def _keyed(docs):
    """Rows by id and text: rows that share an id are told apart."""
    return docs.withColumn("_text_hash", F.xxhash64("text"))


def _without(docs, rejected):
    """``docs`` less the rejected ones, which are written first: Spark then knows how many. Only rows
    whose key hits the map of rejected keys meet them in the join, so the other texts never move."""
    gone = stage(rejected.select(*_KEY).distinct()).toDF("_gone_id", "_gone_hash")
    keys = bit_map(gone.select(F.xxhash64("_gone_id", "_gone_hash")), MAP_BITS)
    hit = in_bit_map(keys, F.xxhash64(*_KEY), MAP_BITS)
    same = F.col("doc_id").eqNullSafe(F.col("_gone_id")) & (F.col("_text_hash") == F.col("_gone_hash"))
    met = _keyed(docs).where(hit).join(gone, same, "left_anti")
    return _keyed(docs).where(~hit).unionAll(met).drop("_text_hash")


def language(spark, docs, sf_dir):
    """Drop texts without a letter and texts that resemble no language learned here."""
    ship(spark)
    profiles = language_ranks.learn(docs.where(~language_ranks.held_out(*LANGUAGE_FOLDS)))
    found = language_ranks.predict(_keyed(docs), profiles, keep=_KEY)
    unknown = F.col("lang_pred") == language_ranks.UNKNOWN
    return _without(docs, found.where(unknown | (F.col("score") < MIN_LANGUAGE_SCORE)))


def toxic(spark, docs, sf_dir):
    """Drop documents that score as toxic."""
    labels = read(spark, sf_dir, "labels")
    scored = toxicity.detect(_keyed(docs), labels, ~toxicity.held_out(*TOXICITY_FOLDS), keep=_KEY)
    return _without(docs, scored.where(F.col("score") >= toxicity.THRESHOLD))


def near_duplicates(spark, docs, sf_dir):
    """Keep the document with the smallest id of each group of linked documents: those whose sets of
    five-word shingles have a similarity of 0.8 or more."""
    ship(spark)
    joined = shingle_join.join(docs, words=NEAR_WORDS, percent=NEAR_PERCENT).where("doc_id is not null")
    ids = joined.groupBy("doc_id").agg(F.max(F.expr("doc_id = component_id")).alias("_first"), F.count("*").alias("_rows"))
    # Ids that go and ids of several rows: only texts that hit a map of them are moved.
    met = stage(ids.where("not _first or _rows > 1").select("doc_id", "_first"))
    hashed = F.xxhash64(F.col("doc_id").cast("long"))
    hit = in_bit_map(bit_map(met.select(hashed), MAP_BITS), hashed, MAP_BITS) & F.col("doc_id").isNotNull()
    gone = met.where("not _first").select("doc_id")
    kept = _keyed(docs.where(hit).join(gone, "doc_id", "left_anti")).dropDuplicates([*_KEY]).drop("_text_hash")
    return docs.where(~hit).unionByName(kept.select(*docs.columns))


def best_fit_packing(spark, docs, sf_dir):
    """Pack the documents into sequences. Workers that served other stages have less room left."""
    ship(spark)
    return packing.pack(docs, BYTE_BPE, keep=50_000, arrow_rows=1000)


STAGES = [
    ("language_ranks", language),
    ("toxicity", toxic),
    ("shingle_join", near_duplicates),
    ("best_fit_packing", best_fit_packing),
]

# Learned models and encoding have no SQL form.
ORACLE_SQL = None


def run(spark, sf_dir):
    docs = read(spark, sf_dir, "documents")
    for _, step in STAGES[:-1]:
        docs = stage(step(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
