"""Registered queries of the subpackage: name -> (spark, source folder) -> DataFrame, and their SQL."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from clientele.llm.attention_lm import score_documents
from clientele.llm.bpe import encode_digests
from clientele.llm.conversation_trie import numbered_turns, prefix_trie, share_heads
from clientele.llm.decontamination import find_overlaps
from clientele.llm.histogram_sort import RESULTS as SHARD_COLUMNS
from clientele.llm.histogram_sort import shard_by_bytes
from clientele.llm.line_dedup import without_repeats
from clientele.llm.ngram_join import similar_documents
from clientele.llm.phrase_mining import collocations
from clientele.llm.pii_crf import BASE_KINDS, find_personal_data
from clientele.llm.quality_rules import BASE, quality_report
from clientele.llm.source_mix import RESULTS as MIX_COLUMNS
from clientele.llm.source_mix import mix
from clientele.llm.token_counts import count_tokens
from clientele.llm.url_rules import DomainRule, judge_urls
from clientele.sources.storage import store

TOKEN_LIMIT = 512
SHARDS = 8
MIX_WEIGHTS = [5, 2, 1]
DOMAIN_RULES = [
    DomainRule("block", "net", "/"), DomainRule("allow", "example.net", "/en/"),
    DomainRule("block", "example.com", "/de/"), DomainRule("allow", "org", "/fr/"),
]
URL_PATTERNS = [
    "||ads.*/", "/banners/*", "/popup^", "&sessionid=", "?utm_source=feed|", "*.exe|", "||tracker.^", "/de/*.html|",
    "@@||org/de/", "/print^", "&ref=x|",
]


def documents(spark: SparkSession, folder: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text")


def op1_quality_rules(spark: SparkSession, folder: str) -> DataFrame:
    """Which documents are good enough, by the base rule and the learned decision list?"""
    labels = spark.read.parquet(f"{folder}/labels.parquet").select("doc_id", "quality")
    report = quality_report(documents(spark, folder), labels)
    return report.select("doc_id", *BASE, "base_failed", "kept", "rejected_by")


def op2_pii_semi_markov(spark: SparkSession, folder: str) -> DataFrame:
    """Which personal data does each document hold, and where?"""
    found = find_personal_data(documents(spark, folder), keep=["doc_id"])
    return found.select("doc_id", *[f"n_{k}" for k in BASE_KINDS], F.sha2("base_spans", 256).alias("base_sha256"), "spans")


def op3_histogram_sort(spark: SparkSession, folder: str) -> DataFrame:
    """Which shard and slot does each document get, shards being equally large?"""
    return shard_by_bytes(documents(spark, folder), SHARDS).select("doc_id", *SHARD_COLUMNS)


def op4_token_counts(spark: SparkSession, folder: str) -> DataFrame:
    """How many tokens has each document, and is it over the limit?"""
    tokenizer = public_tokenizers.path("byte_bpe_50k.json")
    return count_tokens(documents(spark, folder), tokenizer, TOKEN_LIMIT, keep=["doc_id"])


def op5_line_dedup(spark: SparkSession, folder: str) -> DataFrame:
    """Which lines of each document are later copies of a repeated run, and what is left?"""
    left = without_repeats(documents(spark, folder), keep=["doc_id"])
    return left.select(
        "doc_id", "n_lines", F.size("deleted").alias("n_deleted"), F.concat_ws(",", F.col("deleted").cast("array<string>")).alias("deleted"),
        F.sha2("text", 256).alias("text_sha256"),
    )


def op6_benchmark_decontamination(spark: SparkSession, folder: str) -> DataFrame:
    """Which documents hold passages of which benchmark items?"""
    benchmark = spark.read.parquet(f"{folder}/benchmark.parquet").select("item_id", "text")
    return find_overlaps(documents(spark, folder), benchmark)


def op7_attention_lm(spark: SparkSession, folder: str) -> DataFrame:
    """How likely is each document by word counts, and by the attention model?"""
    return score_documents(documents(spark, folder), public_tokenizers.path("piece_bpe_32k.model"))


def op8_bpe_encode_decode(spark: SparkSession, folder: str) -> DataFrame:
    """Ids and decoded text of each document, as digests."""
    return encode_digests(documents(spark, folder), public_tokenizers.path("word_bpe_49k.json"), keep=["doc_id"])


def op9_url_rules(spark: SparkSession, folder: str) -> DataFrame:
    """Which pages are blocked by domain rules or patterns?"""
    pages = spark.read.parquet(f"{folder}/pages.parquet").select("page_id", "url")
    judged = judge_urls(pages, DOMAIN_RULES, URL_PATTERNS)
    return judged.select("page_id", "host", "path", "rule", "verdict", "pattern")


def op10_ngram_jaccard_join(spark: SparkSession, folder: str) -> DataFrame:
    """Which documents are connected by similar sets of shingles?"""
    return similar_documents(documents(spark, folder))


def op11_conversation_trie(spark: SparkSession, folder: str) -> DataFrame:
    """Which prefixes do the conversations share, rebuilt with the heads of their hundreds, and what would sharing save?"""
    turns = spark.read.parquet(f"{folder}/conversations.parquet").select("conv_id", "turn", "role", "text")
    return prefix_trie(share_heads(store(numbered_turns(turns), "trie_own_turns")))


def op12_source_mix(spark: SparkSession, folder: str) -> DataFrame:
    """How many words does a mix by source weights take of each document?"""
    docs = spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "source", "text")
    return mix(docs, MIX_WEIGHTS).select("doc_id", "source", *MIX_COLUMNS, "copies")


def op13_phrase_mining(spark: SparkSession, folder: str) -> DataFrame:
    """Which word sequences of each language stand together far more often than their parts let expect?"""
    return collocations(spark.read.parquet(f"{folder}/documents.parquet").select("lang", "text"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_quality_rules": op1_quality_rules,
    "op2_pii_semi_markov": op2_pii_semi_markov,
    "op3_histogram_sort": op3_histogram_sort,
    "op4_token_counts": op4_token_counts,
    "op5_line_dedup": op5_line_dedup,
    "op6_benchmark_decontamination": op6_benchmark_decontamination,
    "op7_attention_lm": op7_attention_lm,
    "op8_bpe_encode_decode": op8_bpe_encode_decode,
    "op9_url_rules": op9_url_rules,
    "op10_ngram_jaccard_join": op10_ngram_jaccard_join,
    "op11_conversation_trie": op11_conversation_trie,
    "op12_source_mix": op12_source_mix,
    "op13_phrase_mining": op13_phrase_mining,
}
ORACLES: dict[str, str] = {
    # patterns stand here as regular expressions of their own: those of URL_PATTERNS in order, exceptions last
    "op9_url_rules": r"""
        WITH parts AS (
            SELECT page_id, url, translate(url, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS low,
                   translate(regexp_extract(coalesce(url, ''), '://([^/?#]*)', 1),
                             'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
                   regexp_extract(coalesce(url, ''), '://[^/?#]*([^?#]*)', 1) AS path
            FROM pages),
        fits AS (
            SELECT *,
                CASE WHEN (host = 'example.com' OR ends_with(host, '.example.com')) AND starts_with(path, '/de/') THEN 'example.com/de/'
                     WHEN (host = 'example.net' OR ends_with(host, '.example.net')) AND starts_with(path, '/en/') THEN 'example.net/en/'
                     WHEN (host = 'org' OR ends_with(host, '.org')) AND starts_with(path, '/fr/') THEN 'org/fr/'
                     WHEN (host = 'net' OR ends_with(host, '.net')) AND starts_with(path, '/') THEN 'net/' END AS rule,
                list_filter([
                    {'p': '@@||org/de/', 'f': regexp_matches(low, '^[^/?#]*?://([^/?#]*\.)?org/de/')},
                    {'p': '&ref=x|', 'f': regexp_matches(low, '&ref=x$')},
                    {'p': '&sessionid=', 'f': contains(low, '&sessionid=')},
                    {'p': '*.exe|', 'f': regexp_matches(low, '\.exe$')},
                    {'p': '/banners/*', 'f': contains(low, '/banners/')},
                    {'p': '/de/*.html|', 'f': regexp_matches(low, '/de/.*\.html$', 's')},
                    {'p': '/popup^', 'f': regexp_matches(low, '/popup([^a-z0-9_.%-]|$)')},
                    {'p': '/print^', 'f': regexp_matches(low, '/print([^a-z0-9_.%-]|$)')},
                    {'p': '?utm_source=feed|', 'f': regexp_matches(low, '\?utm_source=feed$')},
                    {'p': '||ads.*/', 'f': regexp_matches(low, '^[^/?#]*?://([^/?#]*\.)?ads\..*/', 's')},
                    {'p': '||tracker.^', 'f': regexp_matches(low, '^[^/?#]*?://([^/?#]*\.)?tracker\.([^a-z0-9_.%-]|$)')}
                ], lambda x: x.f)[1].p AS pattern
            FROM parts)
        SELECT page_id, host, path, rule, pattern,
               CASE WHEN rule IN ('net/', 'example.com/de/') THEN 'block' WHEN rule IS NOT NULL THEN 'allow'
                    WHEN pattern IS NULL OR starts_with(pattern, '@@') THEN 'allow' ELSE 'block' END AS verdict
        FROM fits
    """,
    "op13_phrase_mining": r"""
        WITH pieces AS (
            SELECT coalesce(lang, 'und') AS lang, unnest(string_split_regex(
                translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece
            FROM documents),
        words AS (SELECT lang, list_filter(string_split_regex(piece, '[ \t]+'), lambda x: x <> '') AS ws FROM pieces),
        sizes AS (SELECT lang, sum(len(ws)) AS n FROM words GROUP BY lang),
        places AS (
            SELECT lang, ws, k, unnest(range(1, len(ws) - k + 2)) AS i
            FROM words, (SELECT unnest(range(1, 5)) AS k) WHERE len(ws) >= k),
        grams AS (
            SELECT lang, k, array_to_string(ws[i:i + k - 1], ' ') AS phrase, count(*) AS a
            FROM places GROUP BY ALL HAVING count(*) >= 30),
        cuts AS (
            SELECT lang, phrase, k, a, string_split(phrase, ' ') AS ws, unnest(range(1, k)) AS c FROM grams WHERE k > 1),
        scores AS (
            SELECT u.lang, u.phrase, u.k, u.a, u.c, x.a AS l, y.a AS r, (2000000::HUGEINT * u.a) // (x.a + y.a) AS score
            FROM cuts u
            JOIN grams x ON x.lang = u.lang AND x.phrase = array_to_string(u.ws[1:u.c], ' ')
            JOIN grams y ON y.lang = u.lang AND y.phrase = array_to_string(u.ws[u.c + 1:], ' ')),
        lowest AS (SELECT * FROM scores QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, c) = 1),
        inner_parts AS (
            SELECT lang, a AS whole, unnest(flatten(list_transform(range(2, k), lambda s:
                list_transform(range(1, k - s + 2), lambda i: array_to_string(string_split(phrase, ' ')[i:i + s - 1], ' '))))) AS phrase
            FROM grams WHERE k > 2),
        longest AS (SELECT lang, phrase, max(whole) AS whole FROM inner_parts GROUP BY ALL),
        kept AS (
            SELECT f.* FROM lowest f LEFT JOIN longest g ON g.lang = f.lang AND g.phrase = f.phrase
            WHERE g.whole IS NULL OR 100::HUGEINT * g.whole < 80::HUGEINT * f.a),
        ranked AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM kept)
        SELECT lang, rank, phrase, a, l, r, n::BIGINT AS n, score::BIGINT AS score FROM ranked JOIN sizes USING (lang) WHERE rank <= 2000
    """,
}
