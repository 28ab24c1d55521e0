"""A corpus in five stages: language, shared lines, near duplicates, benchmark leaks, packed sequences.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame, which is written and read again as the next one's docs. All but
the last return the columns of documents, whatever these are called. Rows without a doc_id are no duplicates and no leaks of
anything. A repeated row is another document until near duplicates go. An empty table stays empty in every stage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from harborlog.llm import contamination, jaccard, language, lines, packing
from harborlog.llm.queries import added_tokens, byte_bpe, held_out, public_vocabulary, table
from harborlog.plans import Scratch, give_back_heap, new_folder, ship, stored

#: A language's least share of a text's probability.
LEAST_SCORE = 0.5


def aside(docs: DataFrame, *names: str) -> tuple[DataFrame, dict[str, str]]:
    """Columns that an operator would add under the same name get another one meanwhile; and how to name them again."""
    taken = {name: f"__{name}" for name in names if name in docs.columns}
    return docs.withColumnsRenamed(taken), {other: name for name, other in taken.items()}


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts that have letters and a language that clearly fits best stay; null and empty ones go. The model learns as op10 does,
    from docs; where there is nothing to learn from, no text has a language."""
    ship(spark)
    give_back_heap(spark)
    model = language.train(docs.where(~held_out(F.col("doc_id"))), public_vocabulary("byte_bpe_50k.tiktoken"))
    given, names = aside(docs, "lang_pred", "score")
    found = language.predict(given, model).where((F.col("lang_pred") != "und") & (F.col("score") >= LEAST_SCORE))
    return found.select(given.columns).withColumnsRenamed(names)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines of ten documents or more go from every text; n_chars follows. A null text stays null."""
    ship(spark)
    given, names = aside(docs, "n_lines", "n_dropped", "kept_text")
    kept = lines.drop_frequent_lines(given)
    changed = kept.withColumn("text", F.when(F.col("n_dropped") > 0, F.col("kept_text")).otherwise(F.col("text")))
    changed = changed.withColumn("n_chars", F.when(F.col("n_dropped") > 0, F.char_length("text").cast(docs.schema["n_chars"].dataType)).otherwise(F.col("n_chars")))
    return changed.select(given.columns).withColumnsRenamed(names)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near duplicates the document with the least id stays. Rows of that id with different texts all stay."""
    ship(spark)
    give_back_heap(spark)
    with Scratch(spark, "near"):
        components = jaccard.jaccard_components(docs.select("doc_id", "text"))
        first = stored(components.where("component_id = doc_id").select("doc_id").distinct(), new_folder(spark, "first"))
    kept = docs.join(first, "doc_id", "left_semi").dropDuplicates(["doc_id", "text"])
    return kept.select(*docs.columns).unionByName(docs.where("doc_id is null"))


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that contain a benchmark item go, by their ids; texts of null stay."""
    ship(spark)
    leaks = contamination.find_items(docs, table(spark, sf_dir, "benchmark")).select("doc_id").distinct()
    return docs.join(leaks, "doc_id", "left_anti").select(*docs.columns)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The rest as sequences of 1024 tokens; a null text is its end alone."""
    ship(spark)
    return packing.pack(docs, *byte_bpe(), special=added_tokens())


STAGES = [
    ("language_id", language_id),
    ("line_dedup", line_dedup),
    ("near_duplicates", near_duplicates),
    ("decontaminate", decontaminate),
    ("packing", packed),
]

#: SQL expresses neither the language model nor the tokenizer; tests/llm compares with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        path = new_folder(spark, name)
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
