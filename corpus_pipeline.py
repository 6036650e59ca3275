"""From raw documents to packed training sequences, in stages.

Every stage takes all that the stage before it kept, as a table with the columns of
``documents`` (more are carried along), and all but the last return such a table. Null
texts are empty for every stage; rows are never dropped for a null id. An empty table
goes through all stages.

1. Quality rules: documents that a rule rejects go.
2. SimHash near-duplicates: of each group the row with the smallest id stays.
3. Repeated passages of 200 bytes are cut out wherever they stand; a character that a
   cut leaves in part goes with it.
4. Secrets are replaced by a mark.
5. Documents are packed into sequences of 4,096 tokens.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from emberwall.llm.common import free_name, replace_text
from emberwall.llm.pattern_packing import pack
from emberwall.llm.prefix_free import remove_repeats
from emberwall.llm.rule_cascade import judge
from emberwall.llm.secret_scan import find_secrets, redact
from emberwall.llm.simhash_index import near_duplicates
from emberwall.session import new_path, remove, scratch

PASSAGE_BYTES = 200
SEQUENCE_TOKENS = 4096


def _quoted(docs: DataFrame) -> list:
    return [F.col(f"`{c}`") for c in docs.columns]


def _counted(docs: DataFrame) -> DataFrame:
    """``n_chars`` made to agree with ``text``, if there is such a column."""
    if "n_chars" not in docs.columns:
        return docs
    length = F.length("text").cast(docs.schema["n_chars"].dataType)
    return docs.withColumn("n_chars", F.coalesce(length, F.col("n_chars")))


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    verdict = free_name(docs, "verdict")
    judged = judge(docs, out=verdict)
    return judged.filter(F.col(f"`{verdict}`.kept")).select(*_quoted(docs))


def near_duplicate_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    found = free_name(docs, "simhash")
    grouped = near_duplicates(docs, out=found, shingle=3, most=2)
    return grouped.filter(F.col(f"`{found}`.keeps")).select(*_quoted(docs))


def repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    found = free_name(docs, "repeats")
    cut = remove_repeats(docs, out=found, length=PASSAGE_BYTES)
    return _counted(replace_text(cut, "text", found, "kept", "n_spans").select(*_quoted(docs)))


def secret_marks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    found = free_name(docs, "secrets")
    marked = redact(find_secrets(docs, out=found), "text", found)
    return _counted(marked.select(*_quoted(docs)))


def packed_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return pack(
        docs,
        public_tokenizers.path("word_bpe_49k.json"),
        keep=["doc_id"],
        limit=SEQUENCE_TOKENS,
        end_id=1,
    )


STAGES = [
    ("quality rules", quality_rules),
    ("SimHash near-dedup", near_duplicate_documents),
    ("suffix-array dedup", repeated_passages),
    ("secret scans", secret_marks),
    ("best-fit packing", packed_sequences),
]

#: SQL has neither the hashes of the fingerprints nor the tokenizer.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The pieces of all sequences. Each stage is written as Parquet and read again; then
    what it stored on the way is removed, and what the stage before it has written. Only
    the last stage's folder stays, which the result reads."""
    docs, before = spark.read.parquet(f"{sf_dir}/documents.parquet"), None
    for name, stage in STAGES:
        path = new_path(spark, name.replace(" ", "_"))
        with scratch(spark):
            stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
        if before is not None:
            remove(spark, before.rsplit("/", 1)[0])
        before = path
    return docs
