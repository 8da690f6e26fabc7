"""The registered queries of this subpackage: each takes (spark, table folder) and returns a DataFrame."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from zonewatch.llm import alignment, collocations, decontaminate, icws, kneser_ney, licenses, passages, pca_tiles, piece_sampling, pii, ppm, warc, wavelet

Query = Callable[[SparkSession, str], DataFrame]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def public_tokenizer(name: str) -> Callable[[], str]:
    """Finds a tokenizer's file where it is called; the files are no part of this repository."""

    def path() -> str:
        import public_tokenizers

        return public_tokenizers.path(name)

    return path


def op1_wavelet_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    return wavelet.read(wavelet.write(table(spark, sf_dir, "documents"), public_tokenizer("word_bpe_49k.json")))


def op2_pii_tagger(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return pii.find(docs, pii.learn(docs)).drop("found")


def op3_pca_tiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pca_tiles.near_duplicates(table(spark, sf_dir, "embeddings"))


def op4_license_votes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan(table(spark, sf_dir, "documents")).drop("spans")


def op5_kneser_ney(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").withColumn("held_out", ppm.held_out(folds=7))
    return kneser_ney.score(docs, kneser_ney.learn(docs.where("NOT held_out")), keep=("doc_id", "held_out"))


def op6_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").withColumn("held_out", ppm.held_out())
    return ppm.predict(docs, ppm.learn(docs.where("NOT held_out"), least=1), keep=("doc_id", "held_out"))


def op7_warc_segments(spark: SparkSession, sf_dir: str) -> DataFrame:
    files = warc.write(table(spark, sf_dir, "pages"))
    return warc.read(files, payloads=False).drop("url", "payload")


def op8_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.scan(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")).drop("hit_words", "items")


def op9_weighted_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return icws.classes(table(spark, sf_dir, "documents"))


def op10_piece_sampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return piece_sampling.sample(table(spark, sf_dir, "documents"), public_tokenizer("piece_bpe_32k.model"))


def op11_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    a, b = public_tokenizer("byte_bpe_50k.json"), public_tokenizer("piece_bpe_32k.model")
    return alignment.align(table(spark, sf_dir, "documents"), a, b).drop("pairs", "times")


def op12_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.mine(table(spark, sf_dir, "documents"))


def op13_repeated_passages(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return passages.scan(docs, passages.learn(docs)).drop("spans")


def registry() -> dict[str, Query]:
    return {name: f for name, f in globals().items() if name.startswith("op") and callable(f)}
