"""The registered queries of the operators in this package, and SQL for those that SQL can express."""

from __future__ import annotations

import zlib
from functools import wraps

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fieldmill.llm import (
    bytes_index,
    conversations,
    decontaminate,
    embeddings,
    hard_negatives,
    langid,
    licenses,
    minhash,
    oracles,
    packing,
    pii,
    substrings,
    toxicity,
    urls,
)
from fieldmill.llm.shipping import ship
from fieldmill.llm.storage import step

QUERIES: dict = {}
ORACLES: dict[str, str] = {
    "op5_embedding_near_dedup": oracles.NEAR_VECTORS,
    "op7_decontaminate": oracles.DECONTAMINATE,
    "op9_substring_dedup": oracles.SUBSTRING_DEDUP,
    "op11_hard_negatives": oracles.HARD_NEGATIVES,
    "op12_conversation_repair": oracles.CONVERSATION_REPAIR,
    "op13_suffix_dedup": oracles.SUFFIX_DEDUP,
}


def _query(function):
    @wraps(function)
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        ship(spark)
        return function(spark, sf_dir)

    QUERIES[function.__name__] = run
    return run


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _sha256(parts) -> F.Column:
    return F.sha2(F.concat_ws(",", parts).cast("binary"), 256)


@_query
def op7_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per document: its words, how many lie in benchmark windows, which items, and the verdict."""
    docs, benchmark = _table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark")
    scanned = decontaminate.scan_benchmark(docs, benchmark, keep=["doc_id"])
    return decontaminate.judged(scanned).select(
        "doc.doc_id",
        "n_words",
        "n_hit",
        F.size("items").cast("long").alias("n_items"),
        _sha256(F.col("items")).alias("items_sha256"),
        "contaminated",
    )


@_query
def op9_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per document: its words, how many lie in windows that a smaller id also has, and a digest of the rest."""
    docs = _table(spark, sf_dir, "documents")
    spans, texts, copied = substrings.repeated_spans(docs)
    digest = F.sha2(F.col("kept").cast("binary"), 256)
    cut = substrings.kept_texts(spans, texts).select("uid", "n_removed", digest.alias("cut_sha256"))
    whole = substrings.whole_texts(docs).select("doc", "uid", "n_words", digest.alias("whole_sha256"))
    copied = copied.select("uid", F.lit(True).alias("copied"))
    gone = F.col("copied") & (F.col("n_words") >= substrings.WINDOW)
    return (
        whole.join(cut, "uid", "left")
        .join(copied, "uid", "left")
        .select(
            F.col("doc").alias("doc_id"),
            "n_words",
            F.when(gone, F.col("n_words")).otherwise(F.coalesce("n_removed", F.lit(0))).cast("long").alias("n_removed"),
            F.when(gone, F.sha2(F.lit("").cast("binary"), 256))
            .otherwise(F.coalesce("cut_sha256", "whole_sha256"))
            .alias("kept_sha256"),
        )
    )


@_query
def op3_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per document: its class of near-duplicate texts and whether it is the one that stays."""
    classes = minhash.near_duplicates(_table(spark, sf_dir, "documents"))
    return classes.select(
        F.col("doc").alias("doc_id"), "class_id", F.col("doc").eqNullSafe(F.col("class_id")).alias("kept")
    )


def _remainder(column: str, divisor: int) -> F.Column:
    return F.crc32(F.col(column).cast("string").cast("binary")) % divisor


@_query
def op1_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per document: its toxicity score by a lexicon learned from the labels that aren't held out."""
    docs = _table(spark, sf_dir, "documents")
    labels = _table(spark, sf_dir, "labels").filter(_remainder("doc_id", 5) != 0)
    model = toxicity.learn(docs, labels)
    return toxicity.measure(docs, model, ["doc_id"]).select(
        "doc.doc_id",
        F.coalesce(_remainder("doc.doc_id", 5) == 0, F.lit(False)).alias("held_out"),
        "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"),
        "n_matches",
    )


@_query
def op2_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per document: counts and a digest of its base spans, and all accepted spans."""
    found = pii.find_spans(_table(spark, sf_dir, "documents"), ["doc_id"])
    base = F.filter("spans", lambda s: s["kind"].isin(*pii.BASE_KINDS))
    count = lambda kind: F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")
    counts = [count(kind) for kind in pii.BASE_KINDS]
    return found.select(
        "doc.doc_id",
        *counts,
        F.sha2(pii.listed(base).cast("binary"), 256).alias("base_sha256"),
        pii.listed(F.col("spans")).alias("spans"),
    )


def tokenizer_path(name: str = "word_bpe_49k.json") -> str:
    """Where a public tokenizer's file is on this machine; the workers are told the same path."""
    import public_tokenizers

    return str(public_tokenizers.path(name))


def _with_crc(batches):
    for batch in batches:
        ids = batch.column(5)
        starts, values = ids.offsets.to_numpy(), ids.values.to_numpy()
        crc = [zlib.crc32(values[a:b].astype("<u4").tobytes()) for a, b in zip(starts[:-1], starts[1:])]
        yield pa.RecordBatch.from_arrays(
            [*batch.columns[:5], pa.array(crc, pa.int64()), batch.column(6)],
            ["doc_id", "start", "length", "sequence_id", "offset", "ids_crc32", "doc_tokens"],
        )


@_query
def op6_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per piece: where it lies in its document and in its sequence, and a checksum of its ids."""
    docs = _table(spark, sf_dir, "documents")
    pieces = packing.pack(docs, tokenizer_path(), ["doc_id"])
    kind = docs.schema["doc_id"].dataType.simpleString()
    return pieces.select(
        "doc.doc_id", "piece_start", "piece_length", "sequence_id", "sequence_offset", "ids", "doc_tokens"
    ).mapInArrow(
        _with_crc,
        f"doc_id {kind}, start long, length long, sequence_id long, offset long, ids_crc32 long, doc_tokens long",
    )


@_query
def op10_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per document: its language by a network trained on the rows that aren't held out."""
    docs = _table(spark, sf_dir, "documents")
    net = langid.learn(docs.filter(_remainder("doc_id", 4) != 2).select("text", "lang"))
    return langid.identify(docs, net, ["doc_id"]).select(
        "doc.doc_id",
        F.coalesce(_remainder("doc.doc_id", 4) == 2, F.lit(False)).alias("held_out"),
        "lang_pred",
        "score",
    )


@_query
def op5_embedding_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per vector: how many others it links with, its component and whether it is the one that stays."""
    found = embeddings.near_vectors(_table(spark, sf_dir, "embeddings"))
    return found.select(
        F.col("id").alias("vec_id"), "n_links", "component_id", F.col("id").eqNullSafe(F.col("component_id")).alias("kept")
    )


@_query
def op4_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per page: host and path of its url, the rule that decided, and the verdict."""
    judged = urls.judge_urls(_table(spark, sf_dir, "pages"), ["page_id"])
    return judged.select("doc.page_id", "host", "path", "rule", "verdict")


def _url_sql() -> str:
    """The same verdicts in SQL, every pattern tried on every url."""
    rest = "CASE WHEN strpos(coalesce(url, ''), '://') > 0 THEN substr(url, strpos(url, '://') + 3) ELSE '' END"
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    rules = sorted(urls.HOST_RULES, key=lambda r: -len(r.name))
    fits = [
        f"(host = '{r.host}' OR ends_with(host, '.{r.host}')) AND starts_with(path, '{r.path}')" for r in rules
    ]
    named = " ".join(f"WHEN {fit} THEN '{r.name}'" for fit, r in zip(fits, rules))
    decided = " ".join(f"WHEN {fit} THEN '{r.verdict}'" for fit, r in zip(fits, rules))
    tried = " OR ".join(f"regexp_matches(url, '{r.pattern}')" for r in urls.PATTERN_RULES)
    return f"""
        WITH a AS (SELECT page_id, coalesce(url, '') AS url, {rest} AS rest FROM pages),
        b AS (
            SELECT page_id, url, translate(regexp_extract(rest, '^([^/?#]*)', 1), '{upper}', '{upper.lower()}') AS host,
                regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path
            FROM a
        )
        SELECT page_id, host, path, CASE {named} END AS rule,
            CASE {decided} WHEN {tried} THEN 'block' ELSE 'allow' END AS verdict
        FROM b"""


ORACLES["op4_url_filter"] = _url_sql()


@_query
def op8_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per document: the license notices found in it, with covered share and word spans."""
    found = licenses.scan_licenses(_table(spark, sf_dir, "documents"), ["doc_id"])
    names = F.array_sort(F.array_distinct(F.transform("matches", lambda m: m["license"])))
    spans = F.transform("matches", lambda m: F.concat_ws(":", m["license"], m["start"].cast("string"), m["end"].cast("string")))
    return found.select(
        "doc.doc_id",
        "n_words",
        F.size("matches").cast("long").alias("n_matches"),
        F.array_join(names, ",").alias("licenses"),
        F.round(F.array_max(F.transform("matches", lambda m: m["coverage"])), 6).alias("best_coverage"),
        F.array_join(spans, ",").alias("spans"),
    )


@_query
def op13_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per document: its bytes, how many lie in strings that also start elsewhere, their runs, and a digest of the rest."""
    docs = _table(spark, sf_dir, "documents")
    texts = step(bytes_index.different_texts(docs), "texts")
    cut = bytes_index.without_spans(texts, bytes_index.repeated_spans(texts)).select(
        "key", "n_removed", "n_spans", F.sha2("kept", 256).alias("cut_sha256")
    )
    content = F.coalesce(F.col("text"), F.lit("")).cast("binary")
    rows = docs.select(
        "doc_id",
        bytes_index.text_key("text").alias("key"),
        F.octet_length(content).cast("long").alias("n_bytes"),
        F.sha2(content, 256).alias("whole_sha256"),
    )
    return rows.join(step(cut, "cut"), "key", "left").select(
        "doc_id",
        "n_bytes",
        F.coalesce("n_removed", F.lit(0)).cast("long").alias("n_removed"),
        F.coalesce("n_spans", F.lit(0)).cast("long").alias("n_spans"),
        F.coalesce("cut_sha256", "whole_sha256").alias("kept_sha256"),
    )


@_query
def op12_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per conversation, after damage: its faults, the cheapest edits and a digest of the repaired rows."""
    rows = _table(spark, sf_dir, "conversations")
    found = step(conversations.report(conversations.damaged(rows), conv="conv_id"), "report")
    named = rows.select("conv_id").distinct()
    counts = [
        F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")
    ]
    return named.join(found, named["conv_id"].eqNullSafe(found["conv"]), "left").select(
        "conv_id",
        *counts,
        F.coalesce("audit", F.lit("")).alias("audit"),
        F.coalesce("repaired_sha256", F.sha2(F.lit("").cast("binary"), 256)).alias("repaired_sha256"),
    )


@_query
def op11_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per anchor and positive: the best rows of other labels that score 0.8 to 1 times the positive."""
    rows = hard_negatives.prepared(_table(spark, sf_dir, "embeddings"))
    moved = F.when(F.col("id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives.mined(rows.withColumn("label", moved), F.col("id") % 100 == 0)
