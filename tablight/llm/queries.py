"""The queries of the operators of this subpackage, over whole driver tables."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .bpe import encode_documents
from .bpe_prefix import prefix_encode
from .chat import format_chat, loss_text, read_turns, text_part
from .collocations import collocations
from .common import id_crc, table
from .fim import fill_in_middle
from .hmm import hmm_scores
from .jaccard import near_duplicates
from .langid import fit_language_filter, predict_language
from .licenses import scan_licenses
from .llr_rules import quality_rules
from .packing import pack
from .quality_pu import fit_quality, score_quality
from .topk import top_k

WORD_VOCAB = public_tokenizers.path("word_bpe_49k.json")
BYTE_VOCAB = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
PREFIX_VOCAB = public_tokenizers.path("byte_bpe_50k.json")
#: The conversation that the contract adds.
ADDED_TEXT = "\\### Assistant: </turn> ok"


def op1_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(table(spark, sf_dir, "documents"), WORD_VOCAB)


def op2_pivot_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return top_k(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0)


def op3_pu_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    held = id_crc("doc_id") % 4 == 2
    model = fit_quality(docs, table(spark, sf_dir, "labels").select("doc_id", "quality"), ~held)
    return score_quality(docs, model, ["doc_id", held.alias("held_out")])


def op4_hmm_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    out = hmm_scores(docs, id_crc("doc_id") % 5 != 1)
    return out.select("doc_id", (~F.col("trained")).alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score")


def op5_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return encode_documents(table(spark, sf_dir, "documents"), BYTE_VOCAB, public_tokenizers.PATTERN, digests_only=True)


def op6_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    added = spark.range(2).select(
        F.lit(-7).cast("long").alias("conv_id"),
        F.col("id").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"),
        F.lit(ADDED_TEXT).alias("text"),
    )
    turns = turns.unionByName(added).select("conv_id", "turn", "role", text_part(F.col("text")).alias("parts"))
    out = format_chat(turns)
    back = F.transform(read_turns(F.col("formatted")), lambda x: F.concat(x["role"], F.lit("\n"), x["text"], F.lit("\n")))
    loss = loss_text(F.col("formatted"), F.col("loss_spans"))
    return out.select(
        "conv_id",
        "n_turns",
        F.sha2(F.concat_ws("", back), 256).alias("turns_sha256"),
        F.length(loss).cast("long").alias("loss_chars"),
        F.sha2(loss, 256).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"),
    )


def op7_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = scan_licenses(table(spark, sf_dir, "documents"))
    return out.select("doc_id", F.array_join("licenses", ",").alias("licenses"), F.array_join("sentence_ids", ",").alias("sentence_ids"), "n_sentences")


def op8_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    held = id_crc("doc_id") % 4 == 2
    return predict_language(docs, fit_language_filter(docs.where(~held)), ["doc_id", held.alias("held_out")])


def op9_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents")).select("doc_id", "n_shingles", "component_id")


def trusted_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents with a mark on those labelled good. Labels grow with documents: a merge
    join at every size, so that texts are shuffled once whatever the labels weigh."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    good = table(spark, sf_dir, "labels").where("quality = 1").select("doc_id").distinct().withColumn("_good", F.lit(True))
    return docs.join(good.hint("merge"), "doc_id", "left")


def op10_llr_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules(trusted_documents(spark, sf_dir), F.col("_good")).drop("llr")


def op11_fim_boundaries(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fill_in_middle(table(spark, sf_dir, "documents"), digests_only=True)


def op12_bpe_prefix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_encode(table(spark, sf_dir, "documents"), PREFIX_VOCAB, digests_only=True)


def op13_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations(table(spark, sf_dir, "documents"))


OPERATORS = (
    op1_packing,
    op2_pivot_topk,
    op3_pu_quality,
    op4_hmm_lm,
    op5_byte_bpe,
    op6_chat_format,
    op7_license_scan,
    op8_language_id,
    op9_jaccard_join,
    op10_llr_rules,
    op11_fim_boundaries,
    op12_bpe_prefix,
    op13_collocations,
)
QUERIES = {f.__name__: f for f in OPERATORS}
