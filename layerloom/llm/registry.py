"""Queries of the operators in this folder, one per operator, over whole tables."""

from __future__ import annotations

import public_tokenizers

from pyspark.sql import functions as F

from layerloom.llm import (
    collocations,
    exact_topk,
    host_paths,
    host_rules,
    language_ranks,
    packing,
    piece_bpe,
    ranked_search,
    sequence_files,
    shingle_join,
    token_counts,
    toxicity,
    winnowing,
)
from layerloom.llm.common import read

BYTE_BPE = public_tokenizers.path("byte_bpe_50k.json")
PIECE_BPE = public_tokenizers.path("piece_bpe_32k.model")
# Documents whose id's crc32 modulo the first number is the second are kept from learning.
LANGUAGE_FOLDS = (5, 0)
TOXICITY_FOLDS = (4, 2)


def op1_host_paths(spark, sf_dir):
    return host_paths.extract_pages(read(spark, sf_dir, "pages"))


def op2_host_rules(spark, sf_dir):
    return host_rules.judge(read(spark, sf_dir, "documents")).drop("host")


def op3_token_counts(spark, sf_dir):
    return token_counts.count_lines(read(spark, sf_dir, "documents"), BYTE_BPE)


def op4_language_ranks(spark, sf_dir):
    docs = read(spark, sf_dir, "documents")
    held_out = language_ranks.held_out(*LANGUAGE_FOLDS)
    profiles = language_ranks.learn(docs.where(~held_out))
    found = language_ranks.predict(docs, profiles)
    return found.select("doc_id", F.coalesce(held_out, F.lit(False)).alias("held_out"), "lang_pred", "score")


def op5_best_fit_packing(spark, sf_dir):
    return packing.pack(read(spark, sf_dir, "documents"), BYTE_BPE)


def op6_shingle_join(spark, sf_dir):
    return shingle_join.join(read(spark, sf_dir, "documents"))


def op7_piece_bpe(spark, sf_dir):
    return piece_bpe.digests(read(spark, sf_dir, "documents"), PIECE_BPE)


def op8_sequence_files(spark, sf_dir):
    folder = sequence_files.new_folder(spark)
    written = sequence_files.write(read(spark, sf_dir, "documents"), folder, BYTE_BPE)
    return sequence_files.read(written)


def op9_toxicity(spark, sf_dir):
    held_out = toxicity.held_out(*TOXICITY_FOLDS)
    scored = toxicity.detect(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"), ~held_out)
    predicted = (F.col("score") >= toxicity.THRESHOLD).cast("int").alias("predicted")
    return scored.select("doc_id", held_out.alias("held_out"), "score", predicted)


def op10_exact_topk(spark, sf_dir):
    return exact_topk.search(read(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0)


def op11_ranked_search(spark, sf_dir):
    return ranked_search.search(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"))


def op12_winnowing(spark, sf_dir):
    return winnowing.digests(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"))


def op13_collocations(spark, sf_dir):
    return collocations.collocations(read(spark, sf_dir, "documents"))


def queries():
    return {
        "op1_host_paths": op1_host_paths,
        "op2_host_rules": op2_host_rules,
        "op3_token_counts": op3_token_counts,
        "op4_language_ranks": op4_language_ranks,
        "op5_best_fit_packing": op5_best_fit_packing,
        "op6_shingle_join": op6_shingle_join,
        "op7_piece_bpe": op7_piece_bpe,
        "op8_sequence_files": op8_sequence_files,
        "op9_toxicity": op9_toxicity,
        "op10_exact_topk": op10_exact_topk,
        "op11_ranked_search": op11_ranked_search,
        "op12_winnowing": op12_winnowing,
        "op13_collocations": op13_collocations,
    }


def oracle_sql():
    return {
        "op2_host_rules": host_rules.ORACLE_SQL,
        "op11_ranked_search": ranked_search.ORACLE_SQL,
        "op12_winnowing": winnowing.ORACLE_SQL,
        "op13_collocations": collocations.ORACLE_SQL,
    }
