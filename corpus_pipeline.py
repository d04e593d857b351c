"""The corpus pipeline: from raw documents to packed training sequences.

Five stages, each a function ``(spark, docs, sf_dir) -> DataFrame``. A runner writes what a stage returns as Parquet and
gives it, read back, to the next. All but the last keep the columns of ``documents``:

1. toxicity: documents that the learned lexicon model scores 0.5 or more go;
2. MinHash near-dedup: of each class of near-duplicate texts the row with the smallest id stays;
3. benchmark decontamination: contaminated documents (a hit, and one word in twenty or more hit) go;
4. PII: every span of personal data is replaced by its kind in brackets, ``n_chars`` follows the new text;
5. packing: the texts become pieces of sequences of at most 2048 tokens.

Null and empty texts pass the first four stages unchanged (of equal empty texts one stays) and are the end id alone in the
last. Tables may be empty, rows may repeat (exact repeats leave one row) and may have more columns.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fieldmill.llm import decontaminate, minhash, packing, pii, toxicity
from fieldmill.llm.queries import tokenizer_path
from fieldmill.llm.shipping import ship
from fieldmill.llm.storage import step

#: SQL can't express the samples, the learned models and the tokenizer; tests compare with a plain version.
ORACLE_SQL = None


def remove_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows that the model learned from ``labels`` doesn't reject, unchanged."""
    ship(spark)
    model = toxicity.learn(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return toxicity.without_toxic(docs, model)


def remove_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each class of near-duplicate texts, unchanged."""
    ship(spark)
    return minhash.one_of_each(docs, minhash.near_duplicates(docs))


def remove_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows whose text isn't contaminated by ``benchmark``, unchanged."""
    ship(spark)
    benchmark = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    return decontaminate.remove_documents(decontaminate.scan_benchmark(docs, benchmark))


def redact_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every row, its personal data replaced by the kind of data."""
    redacted = pii.redacted(docs)
    if "n_chars" in docs.columns:
        redacted = redacted.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))
    return redacted


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """A row per piece: its document, its place there and in its sequence, and its token ids."""
    ship(spark)
    return packing.pack(docs, tokenizer_path(), ["doc_id"]).select(
        "doc.doc_id", "piece_start", "piece_length", "doc_tokens", "sequence_id", "sequence_offset", "ids"
    )


STAGES = [
    ("toxicity", remove_toxic),
    ("MinHash near-dedup", remove_near_duplicates),
    ("benchmark decontamination", remove_contaminated),
    ("PII", redact_personal_data),
    ("packing", pack_sequences),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written to the shared folder before the next."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = step(stage(spark, docs, sf_dir), name.split()[-1].lower())
    return STAGES[-1][1](spark, docs, sf_dir)
