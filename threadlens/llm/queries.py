"""The document operators as registered queries: (spark, sf_dir) -> DataFrame."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from threadlens.llm.collocations import collocations
from threadlens.llm.exact_dedup import exact_groups
from threadlens.llm.license_scan import scan_licenses
from threadlens.llm.line_dedup import line_report
from threadlens.llm.mixing import mix_decisions
from threadlens.llm.packing import pack_documents
from threadlens.llm.quality_classifier import fit_quality, score_quality
from threadlens.llm.quality_rules import quality_verdicts
from threadlens.llm.simhash_dedup import simhash_groups
from threadlens.llm.spelling_variants import frequent_words, letter_runs, spelling_variants
from threadlens.llm.suffix_dedup import remove_repeats
from threadlens.llm.token_counts import token_counts
from threadlens.llm.url_filter import judge_captures, url_host

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(fn: Query) -> Query:
    QUERIES[fn.__name__] = fn
    return fn


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


@query
def op1_simhash_near_dedup(spark, sf):
    """Fingerprint and near-duplicate component of every document."""
    return simhash_groups(table(spark, sf, "documents")).select(
        "doc_id", "fingerprint", "component_id"
    )


@query
def op2_suffix_array_dedup(spark, sf):
    """Bytes of every document that strings of 100 bytes cover which start earlier."""
    return remove_repeats(table(spark, sf, "documents")).drop("kept")


@query
def op3_exact_dedup(spark, sf):
    """The document that stays of each group of equal texts, for every document."""
    return exact_groups(table(spark, sf, "documents"))


@query
def op4_source_mixing(spark, sf):
    """Words that the mix takes of every document."""
    mixed = mix_decisions(table(spark, sf, "documents"))
    return mixed.select(
        "doc_id", "size", "source_size", "target", (F.col("copies") * F.col("size")).alias("taken")
    )


@query
def op5_quality_classifier(spark, sf):
    """Quality score of every document; the model has not seen those held out."""
    docs = table(spark, sf, "documents")
    scored = score_quality(docs, fit_quality(docs, table(spark, sf, "labels")))
    return scored.withColumn("predicted", F.when(F.col("score") >= 0.3, 1).otherwise(0))


@query
def op6_best_fit_packing(spark, sf):
    """Pieces of all documents and their place in sequences of 4096 tokens."""
    return pack_documents(table(spark, sf, "documents"))


@query
def op8_license_scan(spark, sf):
    """License notices found in documents: matched share and word span of each."""
    return scan_licenses(table(spark, sf, "documents"))


@query
def op7_quality_rules(spark, sf):
    """Statistics and verdict of base filter and learned decision list."""
    verdicts = quality_verdicts(table(spark, sf, "documents"), table(spark, sf, "labels"))
    return verdicts.select(
        "doc_id",
        "n_words",
        "word_chars",
        "n_symbols",
        "n_dup_lines",
        "n_repeat_words",
        "base_failed",
        "kept",
    )


@query
def op9_fuzzy_line_dedup(spark, sf):
    """Number and positions of the lines of every document that repeat earlier ones."""
    report = line_report(table(spark, sf, "documents"))
    return report.select(
        "doc_id",
        "n_lines",
        "n_removed",
        F.array_join(F.col("removed_lines").cast("array<string>"), ",").alias("removed_lines"),
    )


#: Start of the invented fetch and list times, and their range in seconds.
FIRST_SECOND, SECONDS = 1_577_836_800, 126_230_400


def page_captures(spark: SparkSession, sf: str) -> DataFrame:
    """``pages`` as captures; the table has no fetch time, so one follows from its columns."""
    second = FIRST_SECOND + (F.col("page_id") * 7919 + F.length("url") * 104_729) % SECONDS
    pages = table(spark, sf, "pages").select("page_id", "url")
    return pages.withColumn("fetched_at", F.timestamp_seconds(second))


def host_list_entries(captures: DataFrame) -> DataFrame:
    """Dated list entries that follow from the hosts of the captures."""
    hosts = captures.select(url_host(F.col("url")).alias("host")).filter("host <> ''").distinct()
    v = F.length("host") * 31 + F.ascii("host") * 17 + F.ascii(F.substring("host", 3, 1)) * 7
    hosts = hosts.withColumn("v", v)

    def entry(where: str, name: str, pattern: str, action: str, day: str) -> DataFrame:
        at = F.timestamp_seconds(FIRST_SECOND + F.expr(day) * 86_400)
        return hosts.filter(where).select(
            F.lit(name).alias("list"),
            F.expr(pattern).alias("pattern"),
            F.lit(action).alias("action"),
            at.alias("at"),
        )

    domain = "substring_index(host, '.', -2)"
    parts = [
        entry("v % 5 = 0", "spam", "host", "add", "v % 300"),
        entry("v % 5 = 0", "spam", "host", "remove", "v % 300 + 200 + v % 150"),
        entry("v % 5 = 0 AND v % 2 = 0", "spam", "host", "add", "v % 300 + 300 + v % 150"),
        entry("v % 4 = 1", "tracking", "concat(host, '/en')", "add", "v % 900"),
        entry("v % 7 = 0", "allow", "host", "add", "100"),
        entry("v % 7 = 0", "allow", "host", "remove", "400 + v % 500"),
        entry(f"ascii(right({domain}, 1)) % 2 = 0", "parked", domain, "add", "700"),
        entry(f"ascii(right({domain}, 1)) % 2 = 0", "parked", domain, "remove", "760"),
    ]
    return reduce(DataFrame.unionByName, parts)


@query
def op10_url_filter(spark, sf):
    """Lists that covered every page when it was fetched, and whether that blocks it."""
    captures = page_captures(spark, sf)
    judged = judge_captures(captures, host_list_entries(captures))
    return judged.select(
        "page_id",
        F.unix_seconds("fetched_at").alias("fetched_second"),
        F.array_join("lists", ",").alias("lists"),
        "blocked",
    )


@query
def op11_phrase_collocations(spark, sf):
    """The best-scoring phrases of every language with the counts behind their scores."""
    return collocations(table(spark, sf, "documents"))


#: One run in so many loses a character, which makes misspellings.
MISSPELT = 97


def misspelt_runs(docs: DataFrame) -> DataFrame:
    """(word) of all letter runs; of some, by a checksum of document and run, one character is left out."""
    runs = letter_runs(docs)
    own_id = F.coalesce(F.col("doc_id").cast("string"), F.lit(""))
    h = F.crc32(F.concat(own_id, F.lit(":"), F.col("run")).cast("binary"))
    at = (h % F.length("run")).cast("int")
    less = F.concat(F.substring("run", F.lit(1), at), F.substring("run", at + 2, F.length("run")))
    return runs.select(F.when(h % MISSPELT == 0, less).otherwise(F.col("run")).alias("word"))


@query
def op12_spelling_variants(spark, sf):
    """Near words, more frequent form and its root of every frequent word of the documents."""
    return spelling_variants(frequent_words(misspelt_runs(table(spark, sf, "documents"))))


@query
def op13_token_counts(spark, sf):
    """Bytes and tokens of every document, and whether it is over the limit."""
    return token_counts(table(spark, sf, "documents"))
