"""The registered queries of the operators, each over its whole table."""

from __future__ import annotations

import public_tokenizers

from tickwell.llm import (
    alignment,
    compression,
    fertility,
    leaks,
    licenses,
    mixing,
    neardup,
    packing,
    prefixcounts,
    repeats,
    tokenfile,
    toxicity,
    vectorcodes,
)

BYTE_BPE = public_tokenizers.path("byte_bpe_50k.json")
PIECE_BPE = public_tokenizers.path("piece_bpe_32k.model")
END_ID = 2


def documents(spark, sf):
    return spark.read.parquet(f"{sf}/documents.parquet")


def labels(spark, sf):
    return spark.read.parquet(f"{sf}/labels.parquet")


def op1_token_file(spark, sf):
    """Packed token ids of all documents, written and read back."""
    rows = tokenfile.token_file(documents(spark, sf), BYTE_BPE, END_ID)
    return rows.select("doc_id", "start", "n_tokens", "ids_crc32")


def op2_temperature_mix(spark, sf):
    """All documents, mixed to as many tokens with at most two uses of each."""
    rows = mixing.mix(documents(spark, sf), most_repeats=2.0)
    return rows.select("doc_id", "source", "mix_epoch", "mix_block", "mix_tokens", "mix_place")


def op3_license_templates(spark, sf):
    """Licence phrases and templates in all documents."""
    return licenses.scan(documents(spark, sf))


def op4_prefix_counts(spark, sf):
    """Tokens of all documents and how much of each fits 512 tokens."""
    return prefixcounts.token_budgets(documents(spark, sf), BYTE_BPE, limit=512)


def op5_minhash_components(spark, sf):
    """Components of near copies of all documents."""
    return neardup.near_duplicates(documents(spark, sf))


def op6_compression_quality(spark, sf):
    """Quality scores of all documents."""
    docs = documents(spark, sf)
    return compression.score_quality(docs, compression.fit(docs, labels(spark, sf)))


def op7_suffix_repeats(spark, sf):
    """What repeats of 100 bytes leave of all documents."""
    return repeats.remove_repeats(documents(spark, sf))


def op8_fertility_rules(spark, sf):
    """Counts, vocabulary figures and verdicts of all documents."""
    return fertility.quality_rules(documents(spark, sf), PIECE_BPE)


def op9_benchmark_leaks(spark, sf):
    """Test items found in all documents."""
    return leaks.find_leaks(documents(spark, sf), spark.read.parquet(f"{sf}/benchmark.parquet"))


def op10_nearest_toxicity(spark, sf):
    """Toxicity scores of all documents, with the nearest examples."""
    docs = documents(spark, sf)
    return toxicity.score_toxicity(docs, toxicity.fit(docs, labels(spark, sf)))


def op11_config_packing(spark, sf):
    """All documents in sequences of 2048 tokens, each document ended by id 0."""
    return packing.pack(documents(spark, sf), BYTE_BPE, 0)


def op12_trie_codes(spark, sf):
    """Codes of all vectors, with codebooks moved twice."""
    return vectorcodes.vector_codes(spark.read.parquet(f"{sf}/embeddings.parquet"))


def op13_window_alignment(spark, sf):
    """All documents in the tokens of both vocabularies, aligned."""
    return alignment.align(documents(spark, sf), BYTE_BPE, PIECE_BPE)


QUERIES = {
    "op1_token_file": op1_token_file,
    "op2_temperature_mix": op2_temperature_mix,
    "op3_license_templates": op3_license_templates,
    "op4_prefix_counts": op4_prefix_counts,
    "op5_minhash_components": op5_minhash_components,
    "op6_compression_quality": op6_compression_quality,
    "op7_suffix_repeats": op7_suffix_repeats,
    "op8_fertility_rules": op8_fertility_rules,
    "op9_benchmark_leaks": op9_benchmark_leaks,
    "op10_nearest_toxicity": op10_nearest_toxicity,
    "op11_config_packing": op11_config_packing,
    "op12_trie_codes": op12_trie_codes,
    "op13_window_alignment": op13_window_alignment,
}
