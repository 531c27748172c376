"""The registered queries of this subpackage: production parameters over whole tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from cuegrid.llm.alignment import align_tokenizers
from cuegrid.llm.common import read_table
from cuegrid.llm.decontaminate import find_contamination
from cuegrid.llm.fingerprints import fingerprint_documents
from cuegrid.llm.jaccard_join import ngram_jaccard_join
from cuegrid.llm.lattice_lm import score_texts
from cuegrid.llm.licenses import oracle_sql as license_sql
from cuegrid.llm.licenses import scan_licenses
from cuegrid.llm.pii import find_personal_data
from cuegrid.llm.line_dedup import line_dedup_digests
from cuegrid.llm.line_dedup import oracle_sql as line_sql
from cuegrid.llm.pieces import encode_pieces
from cuegrid.llm.quality import quality_classifier
from cuegrid.llm.secrets import scan_secrets
from cuegrid.llm.source_audit import audit_sources
from cuegrid.llm.source_audit import oracle_sql as audit_sql
from cuegrid.llm.url_filter import filter_urls

#: Where the public vocabulary files lie; the model's file is a parameter of its operators.
PIECE_MODEL = "/opt/tokenizers/piece_bpe_32k.model"
BYTE_VOCABULARY = "/opt/tokenizers/byte_bpe_50k.json"


#: Hosts whose pages, and those of their subdomains, are blocked unless a rule says otherwise.
BLOCKED_HOSTS = [
    "spam-farm.example.org",
    "casino-win.example.net",
    "cheap-pills.example.com",
    "cheap-pills.example.net",
    "ads-track.example.com",
    "adult-x.example.com",
    "free-bets.example.net",
]
#: action, host, path
URL_RULES = [
    ("block", "net", "/"),
    ("allow", "example.net", "/en/"),
    ("block", "example.com", "/de/"),
    ("allow", "org", "/fr/"),
]


def op1_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    listed = spark.createDataFrame([(h,) for h in BLOCKED_HOSTS], "key string")
    return filter_urls(read_table(spark, sf_dir, "pages"), listed, URL_RULES)


def op2_secret_scans(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan_secrets(read_table(spark, sf_dir, "documents"))


def op3_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score_texts(read_table(spark, sf_dir, "documents"), PIECE_MODEL)


def op4_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_jaccard_join(read_table(spark, sf_dir, "documents"), n=3, percent=90, links=True)


def op5_license_scans(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan_licenses(read_table(spark, sf_dir, "documents"))


def op6_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return find_personal_data(read_table(spark, sf_dir, "documents"))


def op7_document_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprint_documents(read_table(spark, sf_dir, "documents"))


def op8_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    return encode_pieces(read_table(spark, sf_dir, "documents"), PIECE_MODEL)


def op9_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_classifier(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels"))


def op10_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return find_contamination(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark"))


def op11_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup_digests(read_table(spark, sf_dir, "documents"), min_chars=1, min_docs=10)


def op12_tokenizer_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return align_tokenizers(read_table(spark, sf_dir, "documents"), BYTE_VOCABULARY, PIECE_MODEL)[0]


def op13_source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audit_sources(read_table(spark, sf_dir, "documents"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {name: f for name, f in globals().items() if name.startswith("op") and name[2].isdigit()}


def _url_sql() -> str:
    lower = "translate(regexp_extract(coalesce(url, ''), '(?s)^.*?://([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
    cases = sorted(URL_RULES, key=lambda r: -len(r[1]) - len(r[2]))
    fits = lambda h, p: f"(host = '{h}' or host like '%.{h}') and starts_with(path, '{p}')"
    rule = " ".join(f"when {fits(h, p)} then '{h}{p}'" for _, h, p in cases)
    action = " ".join(f"when {fits(h, p)} then '{a}'" for a, h, p in cases)
    tails = "list_transform(range(1, len(string_split(host, '.')) + 1), lambda i: array_to_string(list_slice(string_split(host, '.'), i, len(string_split(host, '.'))), '.'))"
    return f"""
    with p as (select page_id, {lower} as host, regexp_extract(coalesce(url, ''), '(?s)^.*?://[^/?#]*([^?#]*)', 1) as path from pages),
    k as (select *, case when host <> '' then list_filter({tails}, lambda x: list_contains({BLOCKED_HOSTS}, x))[1] end as listed_key from p)
    select page_id, host, path, case {rule} end as rule,
      coalesce(case {action} end, case when listed_key is not null then 'block' else 'allow' end) as verdict, listed_key
    from k"""


def oracle_sql() -> dict[str, str]:
    """SQL where it can say all of a query; the other queries are tested against brute force."""
    return {"op1_url_filters": _url_sql(), "op5_license_scans": license_sql(), "op11_line_dedup": line_sql(), "op13_source_divergence": audit_sql()}
