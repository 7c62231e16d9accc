"""The queries of this subpackage over the given tables: (spark, folder) -> DataFrame."""

from __future__ import annotations

from pyspark.sql import functions as F

from newslens.llm import ann, bpe, fingerprints, language, licenses, ngram_join, packing, quality, spelling, sql, suffix_dedup, token_counts, toxicity, whitening
from newslens.llm.common import fold, table

#: The vocabulary file that the token queries use; it stays where it is installed.
VOCABULARY = "word_bpe_49k.json"
#: Documents whose id falls into this one of so many parts are held out.
TOXIC_FOLDS, TOXIC_HELD_OUT = 4, 2
FOLDS, HELD_OUT = 5, 0


def vocabulary() -> str:
    import public_tokenizers

    return public_tokenizers.path(VOCABULARY)


def op1_imatch(spark, folder):
    """Fingerprints of every document and of its edited text."""
    return fingerprints.fingerprints(table(spark, folder, "documents").select("doc_id", "text"))


def op2_ngram_join(spark, folder):
    """Near-duplicate class and number of links of every document."""
    return ngram_join.near_duplicates(table(spark, folder, "documents").select("doc_id", "text"))


def op3_ann(spark, folder):
    """The 20 nearest vectors found of each vector whose id 20 divides."""
    return ann.search(table(spark, folder, "embeddings").select("vec_id", "embedding"), "embedding")


def op4_suffix_dedup(spark, folder):
    """Spans of every document that repeat a passage of another place, and the first of them."""
    return suffix_dedup.repeated_passages(table(spark, folder, "documents").select("doc_id", "text"))


def op5_packing(spark, folder):
    """All documents as pieces of sequences of at most 2,048 tokens."""
    return packing.pack(table(spark, folder, "documents").select("doc_id", "text"), vocabulary())


def op6_toxicity(spark, folder):
    """Toxicity of every document, learned from the rows outside one of four parts."""
    documents = table(spark, folder, "documents").select("doc_id", "text")
    held_out = fold(F.col("doc_id"), TOXIC_FOLDS) == TOXIC_HELD_OUT
    model = toxicity.fit(documents, table(spark, folder, "labels"), ~held_out)
    return toxicity.score(documents, model).select(
        "doc_id", held_out.alias("held_out"), "score", "predicted", F.size("passages").alias("n_passages")
    )


def op7_language(spark, folder):
    """Language of every document, learned from four of five parts."""
    documents = table(spark, folder, "documents").select("doc_id", "text", "lang")
    held_out = fold(F.col("doc_id"), FOLDS) == HELD_OUT
    model = language.fit(documents, ~held_out)
    return language.predict(documents, model).select(
        "doc_id", held_out.alias("held_out"), "lang_pred", "score"
    )


def op8_token_counts(spark, folder):
    """Tokens of every document, counted between the separators of flat streams of ids."""
    blocks = token_counts.token_blocks(table(spark, folder, "documents").select("doc_id", "text"), vocabulary())
    counted = token_counts.separator_scan(blocks, carry=["doc_ids"])
    return counted.select(
        F.col("doc_ids")[F.col("place")].alias("doc_id"), "file", "doc_index", "first_token", "n_tokens"
    )


def op9_bpe(spark, folder):
    """Ids of every document and what they decode to, as digests."""
    return bpe.digests(table(spark, folder, "documents").select("doc_id", "text"), vocabulary())


def op10_quality(spark, folder):
    """Quality of every document, learned from four of five parts."""
    documents = table(spark, folder, "documents").select("doc_id", "text")
    held_out = fold(F.col("doc_id"), FOLDS) == HELD_OUT
    model = quality.fit(documents, table(spark, folder, "labels"), ~held_out)
    return quality.score(documents, model).select(
        "doc_id", held_out.alias("held_out"), "score", "predicted"
    )


def op11_whitening(spark, folder):
    """The first 16 whitened components of every vector."""
    embeddings = table(spark, folder, "embeddings").select("vec_id", "embedding")
    model = whitening.fit(embeddings)
    rows = whitening.components(whitening.transform(embeddings, model), model)
    return rows.withColumn("deviation", F.col("deviation").cast("bigint"))


def op12_spelling(spark, folder):
    """Form, root and near words of every word of the documents."""
    return spelling.spelling_variants(table(spark, folder, "documents").select("doc_id", "text"))


def op13_licenses(spark, folder):
    """What the base phrases and all signature rules find in every document."""
    return licenses.summary(licenses.scan(table(spark, folder, "documents").select("doc_id", "text")))


def pipeline(spark, folder):
    """All stages of the corpus pipeline over the documents."""
    import corpus_pipeline

    return corpus_pipeline.run(spark, folder)


QUERIES = {
    "op1_imatch": op1_imatch,
    "op2_ngram_join": op2_ngram_join,
    "op3_ann": op3_ann,
    "op4_suffix_dedup": op4_suffix_dedup,
    "op5_packing": op5_packing,
    "op6_toxicity": op6_toxicity,
    "op7_language": op7_language,
    "op8_token_counts": op8_token_counts,
    "op9_bpe": op9_bpe,
    "op10_quality": op10_quality,
    "op11_whitening": op11_whitening,
    "op12_spelling": op12_spelling,
    "op13_licenses": op13_licenses,
    "pipeline": pipeline,
}

SQL = dict(sql.SQL)
