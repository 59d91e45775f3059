"""The registered queries of the operators: production parameters, whole tables, full results."""

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from aeromart.llm import contamination, labelled, licences, maxent, neardup, negatives, packing, pages, pieces, quality, resampling, rules, substrings, toxicity

#: The folder of public tokenizer files is a parameter of the operators; these are the queries' choices.
TOKENIZER = "piece_bpe_32k.model"
WORD_TOKENIZER = "word_bpe_49k.json"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def tokenizer_path(name: str = TOKENIZER) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licences.licence_units(table(spark, sf_dir, "documents"))


def op2_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = quality.fit_quality(docs, table(spark, sf_dir, "labels"), keep=labelled.remainder(4) != 2)
    scored = quality.score_quality(docs, model)
    return scored.select("doc_id", labelled.held_out(4, 2).alias("held_out"), "score", "predicted")


def op3_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    scored = maxent.score_texts(table(spark, sf_dir, "documents"), labelled.remainder(5) != 1)
    return scored.withColumn("held_out", labelled.held_out(5, 1))


def op4_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pages.extract_text(table(spark, sf_dir, "pages"))


def op5_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pieces.token_digests(table(spark, sf_dir, "documents"), tokenizer_path())


def op6_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contamination.leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op7_minhash_neardup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neardup.near_duplicates(table(spark, sf_dir, "documents"), neardup.Rule(shingle=3, percent=85))


def op8_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substrings.repeat_digests(table(spark, sf_dir, "documents"))


def op9_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    lexicon = toxicity.fit_toxicity(docs, table(spark, sf_dir, "labels"), keep=labelled.remainder(5) != 0)
    scored = toxicity.score_toxicity(docs, lexicon)
    return scored.select("doc_id", labelled.held_out(5, 0).alias("held_out"), "score", "predicted", "passages")


def op10_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return rules.quality_rules(docs, rules.fit_rules(docs, table(spark, sf_dir, "labels")))


def op11_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"), tokenizer_path(WORD_TOKENIZER))


def op12_importance_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return resampling.resample(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op13_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    vec_id, label = F.col("vec_id"), F.col("label")
    rows = table(spark, sf_dir, "embeddings").withColumn("label", F.when(vec_id % 7 == 0, (label + 1) % 10).otherwise(label))
    return negatives.hard_negatives(rows, vec_id % 100 == 0)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_license_scan": op1_license_scan,
    "op2_quality_classifier": op2_quality_classifier,
    "op3_lm_scoring": op3_lm_scoring,
    "op4_html_extraction": op4_html_extraction,
    "op5_sentencepiece": op5_sentencepiece,
    "op6_decontamination": op6_decontamination,
    "op7_minhash_neardup": op7_minhash_neardup,
    "op8_substring_dedup": op8_substring_dedup,
    "op9_toxicity": op9_toxicity,
    "op10_quality_rules": op10_quality_rules,
    "op11_best_fit_packing": op11_best_fit_packing,
    "op12_importance_resampling": op12_importance_resampling,
    "op13_hard_negatives": op13_hard_negatives,
}

ORACLES: dict[str, str] = {
    "op1_license_scan": licences.licence_sql(),
    "op8_substring_dedup": substrings.repeats_sql(),
    "op12_importance_resampling": resampling.resampling_sql(),
    "op13_hard_negatives": negatives.negatives_sql(),
}
