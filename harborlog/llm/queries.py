"""The registered queries of this subpackage, over whole tables. Each takes (spark, directory of the tables)."""

from __future__ import annotations

import json
from collections.abc import Callable
from string import ascii_lowercase, ascii_uppercase

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from harborlog.llm import bpe, collocations, contamination, jaccard, language, licenses, lines, merkle, packing, repeats, secrets, shards, topk
from harborlog.plans import Scratch, new_folder, ship, stored

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def registered(build: Query) -> Query:
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        ship(spark)
        return build(spark, sf_dir)

    QUERIES[build.__name__] = query
    return query


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def public_vocabulary(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def byte_bpe() -> tuple[str, str]:
    """Ranks and word pattern of byte_bpe_50k.json; by ranks the same ids come several times as fast."""
    import public_tokenizers

    return public_vocabulary("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN


def added_tokens() -> dict[str, int]:
    """Tokens that byte_bpe_50k.json adds to its vocabulary: its tokenizer finds them in any text."""
    with open(public_vocabulary("byte_bpe_50k.json"), encoding="utf-8") as file:
        return {token["content"]: token["id"] for token in json.load(file)["added_tokens"]}


def held_out(doc_id: Column) -> Column:
    """Documents that language models don't learn from."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % 3 == 1, F.lit(False))


@registered
def op1_feistel_shards(spark, sf_dir):
    text = F.coalesce("text", F.lit(""))
    sizes = table(spark, sf_dir, "documents").select(
        "doc_id", (F.octet_length(text) + 1).cast("bigint").alias("size"), F.crc32(text.cast("binary")).alias("text_crc32")
    )
    return shards.shard(sizes, ["doc_id", "size", "text_crc32"], 16).select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard")
    )


@registered
def op2_benchmark_leaks(spark, sf_dir):
    return contamination.find_items(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@registered
def op4_packed_sequences(spark, sf_dir):
    return packing.pack(table(spark, sf_dir, "documents"), *byte_bpe(), special=added_tokens())


@registered
def op5_line_dedup(spark, sf_dir):
    kept = lines.drop_frequent_lines(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return kept.select("doc_id", "n_lines", "n_dropped", F.sha2(F.col("kept_text").cast("binary"), 256).alias("kept_sha256"))


@registered
def op6_ngram_jaccard(spark, sf_dir):
    with Scratch(spark, "jaccard"):
        return stored(jaccard.jaccard_components(table(spark, sf_dir, "documents")), new_folder(spark, "components"))


@registered
def op8_pivot_topk(spark, sf_dir):
    vectors = table(spark, sf_dir, "embeddings")
    return topk.top_k(vectors, vectors.where("vec_id % 20 = 0"), 20)


@registered
def op10_language(spark, sf_dir):
    documents = table(spark, sf_dir, "documents")
    model = language.train(documents.where(~held_out(F.col("doc_id"))), public_vocabulary("byte_bpe_50k.tiktoken"))
    found = language.predict(documents.select("doc_id", "text"), model)
    return found.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score")


@registered
def pipeline(spark, sf_dir):
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf_dir)


@registered
def op3_secret_scan(spark, sf_dir):
    return secrets.find_secrets(table(spark, sf_dir, "documents"), public_vocabulary("byte_bpe_50k.tiktoken"), path="source")


@registered
def op9_license_scan(spark, sf_dir):
    return licenses.scan(table(spark, sf_dir, "documents"))


@registered
def op7_repeated_passages(spark, sf_dir):
    return repeats.remove_repeats(table(spark, sf_dir, "documents")).drop("kept")


@registered
def op13_merkle_manifest(spark, sf_dir):
    fields = ["doc_id", "source", "lang", "n_chars", "text"]
    lowered = F.translate("text", ascii_uppercase, ascii_lowercase)
    changed = F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 3 == 0, F.lit(False))
    documents = table(spark, sf_dir, "documents")
    tampered = merkle.leaf_of(*(F.col(c) for c in fields[:-1]), F.when(changed, lowered).otherwise(F.col("text")))
    rows = merkle.manifest(documents.withColumn("tampered", tampered), fields, keep=["doc_id", "tampered"])
    rows = rows.withColumn("folded_root", merkle.folded(F.col("tampered"), F.col("proof")))
    proof = F.sha2(merkle.proof_text(F.col("proof")).cast("binary"), 256).alias("proof_sha256")
    return rows.select("doc_id", "leaf", "subroot", "root", proof, "folded_root", (F.col("folded_root") == F.col("root")).alias("verified"))


@registered
def op11_prefix_bpe(spark, sf_dir):
    vocabulary = byte_bpe()
    ids = bpe.encode(table(spark, sf_dir, "documents"), *vocabulary, keep=["doc_id"])
    rows = bpe.decode(ids, *vocabulary)
    decimal = F.array_join(F.col("ids").cast("array<string>"), " ")
    return rows.select(
        "doc_id", F.size("ids").cast("bigint").alias("n_tokens"), F.sha2(decimal.cast("binary"), 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256")
    )


@registered
def op12_collocations(spark, sf_dir):
    return collocations.collocations(table(spark, sf_dir, "documents").select("text", "lang"))
