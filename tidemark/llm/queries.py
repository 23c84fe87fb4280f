"""The queries of this subpackage: each applies one operator to its whole table."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import common, credentials, fingerprint, huffman, lexical, linecrf, mixing, nearest, neardup, ngrams, packing, toxicity, warc, whitening

QUERIES = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def add(function):
        QUERIES[name] = function
        if sql:
            ORACLES[name] = sql
        return function

    return add


@query("op1_best_fit_packing")
def best_fit_packing(spark: SparkSession, folder: str) -> DataFrame:
    documents = common.table(spark, folder, "documents")
    return packing.pack(documents, public_tokenizers.path("word_bpe_49k.json"), capacity=2048, end=0)


@query("op7_token_files")
def token_files(spark: SparkSession, folder: str) -> DataFrame:
    documents = common.table(spark, folder, "documents")
    target = common.scratch(spark, "token-files").path("dataset")
    symbols = 50_257
    huffman.write(documents, target, public_tokenizers.path("byte_bpe_50k.json"), end=2, symbols=symbols)
    return huffman.digest(spark, target, symbols)


@query("op8_secret_scan")
def secret_scan(spark: SparkSession, folder: str) -> DataFrame:
    documents = common.table(spark, folder, "documents")
    owner, repository = owners()
    return credentials.report(documents, owner, repository, MAX_OWNERS)


#: A secret that more independent sources than this have is an example that was widely copied.
MAX_OWNERS = 2


def owners():
    """A source is an owner, its part in one language a repository."""
    return F.col("source"), F.concat_ws("/", "source", "lang")


@query("op10_simhash")
def simhash(spark: SparkSession, folder: str) -> DataFrame:
    return fingerprint.edited_fingerprints(common.table(spark, folder, "documents"), radius=3, every=20)


@query("op3_minhash_forest")
def minhash_forest(spark: SparkSession, folder: str) -> DataFrame:
    return neardup.near_duplicates(common.table(spark, folder, "documents"))


@query("op9_backoff_automaton")
def backoff_automaton(spark: SparkSession, folder: str) -> DataFrame:
    documents = common.table(spark, folder, "documents")
    return ngrams.score(documents, common.fold("doc_id", 7) == 2, order=2)


@query("op2_toxicity")
def toxic_documents(spark: SparkSession, folder: str) -> DataFrame:
    documents = common.table(spark, folder, "documents")
    held_out = common.fold("doc_id", 5) == 0
    lexicon = toxicity.learn(documents, common.table(spark, folder, "labels"), ~held_out)
    return toxicity.report(documents, lexicon, held_out)


@query("op4_warc_derivatives")
def warc_derivatives(spark: SparkSession, folder: str) -> DataFrame:
    pages = common.table(spark, folder, "pages")
    headers = warc.headers(("Content-Type", F.lit("text/html")), ("Page", F.col("page_id").cast("string")))
    date = F.lit("2024-01-01 00:00:00").cast("timestamp")
    responses = warc.responses_of(pages, "page_id", "url", "html", date, headers)
    return warc.read_back(warc.derive(responses))


def quality():
    """Domains of the mixing queries are the labels of quality."""
    return F.when(F.col("quality") == 1, "high").when(F.col("quality") == 0, "low")


WEIGHTS = {"high": 0.95, "low": 0.05}


@query("op5_mixing")
def mixing_rates(spark: SparkSession, folder: str) -> DataFrame:
    documents = common.table(spark, folder, "documents")
    mixed = mixing.mix(documents, common.table(spark, folder, "labels"), quality(), WEIGHTS)
    domains = [F.coalesce(F.col("_domains")[d], F.lit(0.0)).alias(f"p_{d}") for d in WEIGHTS]
    return mixed.select("doc_id", F.col("_tokens").cast("long").alias("n_tokens"), *domains, F.col("_rate").alias("rate"))


@query("op6_projected_neighbours")
def projected_neighbours(spark: SparkSession, folder: str) -> DataFrame:
    vectors = common.table(spark, folder, "embeddings")
    return nearest.search(vectors, vectors.where(F.col("vec_id") % 20 == 0), k=20)


@query("op11_ranked_search", lexical.ORACLE)
def ranked_search(spark: SparkSession, folder: str) -> DataFrame:
    return lexical.search(common.table(spark, folder, "documents"), common.table(spark, folder, "benchmark"), k=20)


@query("op12_whitened_embeddings")
def whitened_embeddings(spark: SparkSession, folder: str) -> DataFrame:
    return whitening.whiten(common.table(spark, folder, "embeddings"), k=16)


@query("op13_line_rules")
def line_rules(spark: SparkSession, folder: str) -> DataFrame:
    documents = common.table(spark, folder, "documents")
    return linecrf.report(documents, linecrf.learn(documents, common.table(spark, folder, "labels")))
