"""One query for each operator, over its whole table, and SQL for those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from .alignment import align_tokenizers
from .batches import in_fold, table
from .embeddings import near_vectors
from .jaccard import jaccard_components
from .language import fit_languages, languages
from .licenses import license_scan, license_summary
from .neighbours import nearest_vectors
from .packing import pack
from .pieces import piece_digests
from .quality import fit_quality, quality_rules
from .runs import periodic_runs
from .toxicity import fit_toxicity, toxicity
from .urls import PATTERNS, judge_urls
from .wrappers import main_texts

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def query(fn):
    QUERIES[fn.__name__] = fn
    return fn


def with_sql(sql: str):
    def register(fn):
        ORACLE[fn.__name__] = sql
        return query(fn)

    return register


def vocabulary(name: str) -> str:
    """The path of a public vocabulary file on this machine."""
    import public_tokenizers

    return public_tokenizers.path(name)


@query
def op1_packing(spark, sf_dir):
    from public_tokenizers import PATTERN

    return pack(table(spark, sf_dir, "documents"), vocabulary("byte_bpe_50k.json"),
                vocabulary("byte_bpe_50k.tiktoken"), PATTERN)


@query
def op2_html(spark, sf_dir):
    return main_texts(table(spark, sf_dir, "pages")).withColumn(
        "n_chars", F.char_length("text").cast("bigint"))


@query
def op3_jaccard(spark, sf_dir):
    return jaccard_components(table(spark, sf_dir, "documents"), words=3, num=90)


@query
def op4_embeddings(spark, sf_dir):
    return near_vectors(table(spark, sf_dir, "embeddings"))


@with_sql(r"""
    WITH parts AS (
        SELECT page_id,
               translate(coalesce(regexp_extract(url, '(?s)^.*?://([^/?#]*)([^?#]*)', 1), ''),
                         'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
               coalesce(regexp_extract(url, '(?s)^.*?://([^/?#]*)([^?#]*)', 2), '') AS path
        FROM pages
    ), listed(rule_host, rule_path, rule_verdict) AS (
        VALUES ('org', '/', 'allow'), ('example.org', '/es/', 'block'),
               ('example.org', '/en/1', 'block'), ('com', '/fr/', 'allow'), ('com', '/de/', 'block')
    ), judged AS (
        SELECT *, CASE WHEN """ + " OR ".join(
    f"regexp_matches(host || path, '{rule.pattern}')" for rule in PATTERNS) + r"""
                  THEN 'block' ELSE 'allow' END AS method,
            (SELECT max_by({'rule': rule_host || rule_path, 'verdict': rule_verdict},
                           length(rule_host || rule_path))
             FROM listed
             WHERE (host = rule_host OR ends_with(host, '.' || rule_host))
               AND starts_with(path, rule_path)) AS best
        FROM parts
    )
    SELECT page_id, host, path, best.rule AS rule, coalesce(best.verdict, method) AS verdict
    FROM judged
""")
def op5_urls(spark, sf_dir):
    return judge_urls(table(spark, sf_dir, "pages")).drop("fits")


@query
def op6_licenses(spark, sf_dir):
    return license_summary(license_scan(table(spark, sf_dir, "documents")))


@query
def op7_toxicity(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    held_out = in_fold("doc_id", 5, 0)
    model = fit_toxicity(docs, table(spark, sf_dir, "labels"), learn=~held_out)
    return toxicity(docs, model).select("doc_id", held_out.alias("held_out"), "score", "predicted")


@query
def op8_languages(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    held_out = in_fold("doc_id", 4, 2)
    found = languages(docs, fit_languages(docs, learn=~held_out))
    return found.select("doc_id", held_out.alias("held_out"), "lang_pred", "score")


@query
def op9_pieces(spark, sf_dir):
    return piece_digests(table(spark, sf_dir, "documents"), vocabulary("piece_bpe_32k.model"))


@query
def op10_quality(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    return quality_rules(docs, fit_quality(docs, table(spark, sf_dir, "labels")))


@query
def op11_neighbours(spark, sf_dir):
    return nearest_vectors(table(spark, sf_dir, "embeddings"))


@query
def op12_alignment(spark, sf_dir):
    from public_tokenizers import PATTERN

    return align_tokenizers(
        table(spark, sf_dir, "documents"), vocabulary("byte_bpe_50k.json"),
        vocabulary("byte_bpe_50k.tiktoken"), PATTERN, vocabulary("piece_bpe_32k.model"))


def with_repeats(text: Column, doc_id: Column) -> Column:
    """The text, in every tenth document (by a hash of its id) with a period from some word on."""
    words = F.regexp_extract_all(text, F.lit(r"[^\x20\x09-\x0D]+"), F.lit(0))
    code, n = F.crc32(doc_id.cast("string")), F.size(words)
    part = F.floor(code / 10)
    start = (part % n).cast("int")
    period = (1 + F.floor((n - start) / (3 + part % 8))).cast("int")
    times = F.ceil((n - start) / period).cast("int")
    tail = F.flatten(F.array_repeat(F.slice(words, start + 1, period), times))
    repeated = F.slice(F.concat(F.slice(words, F.lit(1), start), tail), F.lit(1), n)
    return F.when((code % 10 == 0) & (n > 0), F.array_join(repeated, " ")).otherwise(text)


@query
def op13_runs(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = periodic_runs(docs.withColumn("text", with_repeats(F.col("text"), F.col("doc_id"))))
    lines = F.transform("runs", lambda r: F.concat_ws(",", r["start"], r["length"], r["period"]))
    best = F.col("best")
    return found.select(
        "doc_id", F.size("runs").cast("bigint").alias("n_runs"), best["start"].alias("start"),
        best["length"].alias("length"), best["period"].alias("period"),
        F.expr("1000 * best.length div best.period").alias("exponent_milli"),
        F.sha2(F.array_join(F.transform(lines, lambda x: F.concat(x, F.lit("\n"))), ""), 256)
        .alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"))
