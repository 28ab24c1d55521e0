"""Secrets in texts, with a random forest that removes false positives.

Candidates are all long runs of key characters of a word that have a digit or four capitals in a row, and values of any length
that are assigned to the name of a secret. Their features are length, transitions between kinds of characters, coverage by
dictionary words, the path, and what stands next to them. The forest learns from labelled findings; ``labelled`` labels findings by issuers' formats and explicit assignments where no one has.
"""

from __future__ import annotations

from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from harborlog.plans import stored

RUN = r"[A-Za-z0-9+/_-]{16,}"
#: Findings that the forest learns from, about so many.
SAMPLE = 20_000
TREES, DEPTH, SEED = 20, 6, 7

#: Formats of well-known issuers.
FORMATS = r"^(AKIA[A-Z0-9]{16}|gh[pousr]_[A-Za-z0-9]{36}|xox[abprs]-[A-Za-z0-9-]{10,}|sk_live_[A-Za-z0-9]{16,}|AIza[A-Za-z0-9_-]{35})$"
NAMES = "password|passwd|pwd|secret|token|api_?key|access_?key|credential|auth"
ASSIGNED = rf"(?i)({NAMES})\W*$"
#: The name of a secret and an assignment, up to the value, which may be quoted.
ASSIGNS = rf"(?i:{NAMES})[\s\"'`\]\\]{{0,4}}[:=]{{1,2}}>?[\s\"'`\\]{{0,4}}"
#: What may stand before a value whose name is in the words before; the line feed marks such a word.
LEAD = r"[\"'`\]\\:=>]{0,8}"
#: An assigned value ends at a quote, bracket or separator, before full stops and colons at the word's end, and before a run.
VALUE = r"(?![:=>])(?:(?![A-Za-z0-9+/_-]{16}|[.:]+$)[^\s\"'`\\,;&<>(){}\[\]])++"
PART = rf"{RUN}|(?:(?<={ASSIGNS})|(?<=^\n{LEAD})){VALUE}"
PLACEHOLDER = r"(?i)(example|sample|dummy|placeholder|changeme|xxxx|0000|1234567)"
KIND_CHANGES = {
    "lower_digit": "[a-z](?=[0-9])", "digit_lower": "[0-9](?=[a-z])", "upper_digit": "[A-Z](?=[0-9])", "digit_upper": "[0-9](?=[A-Z])",
    "lower_upper": "[a-z](?=[A-Z])", "upper_lower": "[A-Z](?=[a-z])", "vowel_consonant": "(?i)[aeiou](?=[b-df-hj-np-tv-z])", "consonants": "(?i)[b-df-hj-np-tv-z](?=[b-df-hj-np-tv-z])",
}
FEATURES = ["length", *KIND_CHANGES, "digits", "coverage", "path_test", "path_depth", "before_key", "before_assigns", "before_hash", "placeholder", "quoted"]


def dictionary(spark: SparkSession, path: str) -> DataFrame:
    """Pieces of three ASCII letters or more of a public vocabulary (base64 piece and rank in each line), lower-cased."""
    piece = F.trim(F.lower(F.unbase64(F.split("value", " ")[0]).cast("string")))
    return spark.read.text(path).select(piece.alias("piece")).where(F.col("piece").rlike("^[a-z]{3,}$")).distinct()


def candidates(df: DataFrame, text: str, identity: str, path: str | None) -> DataFrame:
    """One row per candidate: its line and word from 0, its value, what stands before and around it, and the path.

    The first candidate of a word has two words before it, every other one the candidate of the same word before it.
    """
    may = F.col(text).rlike(f"{RUN}|{ASSIGNS}")
    lines = df.where(may).select(
        F.col(identity).alias("__id"), (F.col(path).cast("string") if path else F.lit("")).alias("__path"), F.posexplode(F.split(F.col(text), "\n", -1)).alias("__line", "__s")
    )
    cut = lines.where(F.col("__s").rlike(f"{RUN}|{ASSIGNS}")).withColumn("__w", F.split("__s", "[ \\t\\x0b\\f\\r]+", -1))
    spread = cut.select("__id", "__path", "__line", "__w", F.posexplode("__w").alias("__at", "__word"))

    def word(i: int) -> Column:
        return F.coalesce(F.get("__w", F.col("__at") + i), F.lit(""))

    ahead = spread.select("__id", "__path", "__line", "__at", "__word", F.concat_ws(" ", word(-2), word(-1)).alias("__ahead"))
    led = F.concat_ws(" ", "__ahead", F.regexp_extract("__word", f"^{LEAD}", 0)).rlike(f"{ASSIGNS}$")
    marked = ahead.withColumn("__word", F.when(led, F.concat(F.lit("\n"), F.col("__word"))).otherwise(F.col("__word"))).where(F.col("__word").rlike(PART))
    parts = marked.select(
        "__id", "__path", "__line", "__at", "__ahead", F.regexp_extract_all("__word", F.lit(PART), F.lit(0)).alias("__parts"),
        F.split("__word", PART, -1).alias("__gaps"),
    )

    def part(value: Column, i: Column) -> Column:
        gap = F.ltrim(F.get("__gaps", i), F.lit("\n"))
        before = F.when(i == 0, F.concat_ws(" ", "__ahead", gap)).otherwise(F.concat(F.get("__parts", i - 1), gap))
        return F.struct(value.alias("__value"), before.alias("__before"), F.concat(gap, F.get("__gaps", i + 1)).alias("__around"))

    found = parts.select("__id", "__path", "__line", "__at", F.inline(F.transform("__parts", part)))
    return found.where(F.col("__value").rlike("[0-9]") | F.col("__value").rlike("[A-Z]{4}") | F.col("__before").rlike(f"{ASSIGNS}$"))


def featured(found: DataFrame, pieces: DataFrame) -> DataFrame:
    """Add the features. The dictionary joins by shuffle or broadcast as its stored size allows."""
    size = F.char_length("__value")
    runs = found.select("__value").distinct().select("__value", F.explode(F.expr("regexp_extract_all(lower(__value), '[a-z]{3,}', 0)")).alias("piece"))
    covered = runs.join(pieces, "piece").groupBy("__value").agg(F.sum(F.char_length("piece")).alias("__covered"))
    out = found.join(covered, "__value", "left")
    flags = {
        "path_test": F.col("__path").rlike("(?i)test|example|sample|fixture|mock|doc"), "before_key": F.col("__before").rlike("(?i)key|token|secret|pass|auth|credential"),
        "before_assigns": F.col("__before").rlike("[=:]\\W*$"), "before_hash": F.col("__before").rlike("(?i)sha|md5|commit|hash|uuid|digest"),
        "placeholder": F.col("__value").rlike(PLACEHOLDER), "quoted": F.col("__around").rlike("[\"'`]"),
    }
    columns = {"length": size, "coverage": F.coalesce("__covered", F.lit(0)) / size, "digits": F.regexp_count("__value", F.lit("[0-9]")) / size}
    columns |= {name: F.regexp_count("__value", F.lit(pattern)) / size for name, pattern in KIND_CHANGES.items()}
    columns |= {"path_depth": F.coalesce(F.regexp_count("__path", F.lit("/")), F.lit(0)), **{k: F.coalesce(v, F.lit(False)) for k, v in flags.items()}}
    return out.withColumns({k: v.cast("double") for k, v in columns.items()})


def labelled(found: DataFrame) -> DataFrame:
    """Label findings: an issuer's format, or an explicit assignment of a value with digits, and no placeholder."""
    real = F.col("__value").rlike(FORMATS) | (F.col("__before").rlike(ASSIGNED) & F.col("__value").rlike("[0-9].*[0-9]"))
    return found.withColumn("label", (real & ~F.col("__value").rlike(PLACEHOLDER)).cast("double"))


def find_secrets(
    df: DataFrame, dictionary_path: str, text: str = "text", identity: str = "doc_id", path: str | None = None, findings: DataFrame | None = None, threshold: float = 0.5
) -> DataFrame:
    """Findings that the forest keeps: identity, line, word, kind_length, value_sha256, probability.

    findings: labelled findings with the columns of ``FEATURES`` and label; by default those of ``labelled``. Null and empty texts
    have no findings; repeated rows repeat theirs. Without labelled findings there are none; if all have one label, it decides.
    """
    spark = df.sparkSession
    pieces = stored(dictionary(spark, dictionary_path))
    found = stored(labelled(featured(candidates(df, text, identity, path), pieces)))
    known = findings if findings is not None else found
    n = known.count()
    part = int(min(1.0, SAMPLE / max(n, 1)) * (1 << 20))
    mark = F.xxhash64(*FEATURES)
    # Equal findings are chosen together, so they count once.
    chosen = stored(known.where(F.pmod(mark, F.lit(1 << 20)) < part).select(*FEATURES, "label").distinct())
    kinds = {r["label"] for r in chosen.select("label").distinct().collect()}
    columns = [F.col("__id").alias(identity), F.col("__line").cast("bigint").alias("line"), F.col("__at").cast("bigint").alias("word"), F.char_length("__value").cast("bigint").alias("length"), F.sha2("__value", 256).alias("value_sha256")]
    if len(kinds) < 2:
        only = F.lit(float(*kinds) if kinds else 0.0)
        return found.select(*columns, only.alias("probability")).where(F.col("probability") >= threshold)
    vectors = VectorAssembler(inputCols=FEATURES, outputCol="__features")
    forest = RandomForestClassifier(featuresCol="__features", labelCol="label", numTrees=TREES, maxDepth=DEPTH, seed=SEED, cacheNodeIds=False)
    model = forest.fit(vectors.transform(chosen))
    scored = model.transform(vectors.transform(found)).withColumn("__p", vector_to_array("probability")[1])
    return scored.select(*columns, F.col("__p").alias("probability")).where(F.col("probability") >= threshold)
