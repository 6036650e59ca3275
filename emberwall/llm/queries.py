"""One registered query per operator, each over the whole of its table."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from emberwall.llm.byte_bpe import encode
from emberwall.llm.chat_format import format_chats, learnt, parse
from emberwall.llm.hard_negatives import mine
from emberwall.llm.heap_bpe import count_tokens
from emberwall.llm.kmeans_tree import search
from emberwall.llm.neighbour_vote import score_quality
from emberwall.llm.ngram_trie import score_texts
from emberwall.llm.pattern_packing import pack
from emberwall.llm.prefix_free import remove_repeats
from emberwall.llm.rule_cascade import judge
from emberwall.llm.run_detection import find_runs
from emberwall.llm.secret_scan import KINDS, find_secrets
from emberwall.llm.simhash_index import near_duplicates

Query = Callable[[SparkSession, str], DataFrame]
_QUERIES: dict[str, Query] = {}


def query(run: Query) -> Query:
    _QUERIES[run.__name__] = run
    return run


def queries() -> dict[str, Query]:
    return dict(_QUERIES)


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")


def remainder(divisor: int, id_column: str = "doc_id"):
    """What is left of the CRC-32 of the id as text; 0 for a null id."""
    crc = F.crc32(F.col(id_column).cast("string").cast("binary"))
    return F.coalesce(F.pmod(crc, F.lit(divisor)), F.lit(0))


@query
def op1_lm_scoring(spark, sf_dir):
    held_out = remainder(7) == 2
    scored = score_texts(documents(spark, sf_dir), ~held_out, out="lm", keep=["doc_id"])
    return scored.select("doc_id", held_out.alias("held_out"), "lm.*")


@query
def op2_quality_classifier(spark, sf_dir):
    held_out = remainder(3) == 1
    scored = score_quality(
        documents(spark, sf_dir),
        spark.read.parquet(f"{sf_dir}/labels.parquet").select("doc_id", "quality"),
        ~held_out,
        out="vote",
        keep=["doc_id"],
    )
    score = F.col("vote.score")
    return scored.select(
        "doc_id",
        held_out.alias("held_out"),
        score.alias("score"),
        (score >= 0.5).cast("int").alias("predicted"),
    )


@query
def op3_suffix_array_dedup(spark, sf_dir):
    cleaned = remove_repeats(
        documents(spark, sf_dir), out="repeats", keep=["doc_id"], length=200, digests=True
    )
    return cleaned.select("doc_id", "repeats.*")


@query
def op4_quality_rules(spark, sf_dir):
    judged = judge(documents(spark, sf_dir), out="quality", keep=["doc_id"])
    return judged.select("doc_id", "quality.*").drop("rejected_by")


@query
def op5_token_counts(spark, sf_dir):
    counted = count_tokens(
        documents(spark, sf_dir),
        public_tokenizers.path("byte_bpe_50k.json"),
        public_tokenizers.PATTERN,
        out="tokens",
        keep=["doc_id"],
    )
    return counted.select("doc_id", "tokens.*")


@query
def op6_nearest_neighbours(spark, sf_dir):
    vectors = spark.read.parquet(f"{sf_dir}/embeddings.parquet").select("vec_id", "embedding")
    return search(vectors, F.pmod(F.col("vec_id"), F.lit(20)) == 0, k=20)


@query
def op7_byte_bpe(spark, sf_dir):
    encoded = encode(
        documents(spark, sf_dir),
        public_tokenizers.path("byte_bpe_multi_50k.tiktoken"),
        public_tokenizers.PATTERN,
        out="bpe",
        keep=["doc_id"],
        digests=True,
    )
    return encoded.select("doc_id", "bpe.*")


@query
def op8_best_fit_packing(spark, sf_dir):
    return pack(
        documents(spark, sf_dir),
        public_tokenizers.path("word_bpe_49k.json"),
        keep=["doc_id"],
        limit=4096,
        end_id=1,
        with_ids=False,
    )


def _joined(spans):
    return F.array_join(
        F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ","
    )


@query
def op9_secret_scans(spark, sf_dir):
    spans = F.col("secrets")
    base = F.filter(spans, lambda s: s["kind"] != "random")

    def count_of(kind: str):
        return F.size(F.filter(spans, lambda s: s["kind"] == kind)).cast("long")

    counts = [count_of(kind).alias(f"n_{kind}") for kind in KINDS[:3]]
    found = find_secrets(documents(spark, sf_dir), out="secrets", keep=["doc_id"])
    return found.select(
        "doc_id",
        *counts,
        F.sha2(_joined(base).cast("binary"), 256).alias("base_sha256"),
        _joined(spans).alias("spans"),
    )


@query
def op10_simhash_near_dedup(spark, sf_dir):
    found = near_duplicates(
        documents(spark, sf_dir), out="simhash", keep=["doc_id"], shingle=3, most=2
    )
    return found.select(
        "doc_id",
        F.lpad(F.lower(F.hex("simhash.fingerprint")), 16, "0").alias("fingerprint"),
        F.col("simhash.component_id").alias("component_id"),
    )


@query
def op11_hard_negatives(spark, sf_dir):
    vec_id, label = F.col("vec_id"), F.col("label")
    return mine(
        spark.read.parquet(f"{sf_dir}/embeddings.parquet").select("vec_id", "embedding", "label"),
        vec_id % 50 == 0,
        label=F.when(vec_id % 7 == 0, (label + 1) % 10).otherwise(label),
        scale=256,
        positives=5,
        negatives=3,
        low=50,
        high=95,
    )


def _sha256(text):
    return F.sha2(text.cast("binary"), 256)


@query
def op12_chat_formatting(spark, sf_dir):
    table = spark.read.parquet(f"{sf_dir}/conversations.parquet")
    number = F.col("id")
    planted = spark.range(2).select(
        F.lit(-7).cast("long").alias("conv_id"),
        number.alias("turn"),
        F.when(number == 0, "user").otherwise("assistant").alias("role"),
        F.lit(r"\### Assistant: </turn> ok").alias("text"),
    )
    rows = table.select("conv_id", "turn", "role", "text").unionByName(planted)
    read_back = format_chats(rows).select(
        "conv_id",
        F.length("formatted").cast("long").alias("formatted_chars"),
        parse(F.col("formatted")).alias("turns"),
        F.array_join(learnt(F.col("formatted"), F.col("loss")), "").alias("said"),
    )
    lines = F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n")))
    return read_back.select(
        "conv_id",
        F.size("turns").cast("long").alias("n_turns"),
        _sha256(F.array_join(lines, "")).alias("turns_sha256"),
        F.length("said").cast("long").alias("loss_chars"),
        _sha256(F.col("said")).alias("loss_sha256"),
        "formatted_chars",
    )


def planted_periods(docs: DataFrame) -> DataFrame:
    """``docs`` with the words of some texts, told by the id, made periodic."""
    h = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    words = F.regexp_extract_all("text", F.lit(r"[^\x20\x09-\x0D]+"), F.lit(0))
    chosen = docs.withColumn("g", F.floor(h / 10)).withColumn(
        "words", F.when((h % 10 == 0) & F.col("text").isNotNull(), words)
    )
    n = F.size("words")
    a, g = F.col("a"), F.col("g")
    chosen = chosen.withColumn("a", F.when(n > 0, g % n)).withColumn(
        "p", F.when(n > 0, 1 + F.floor((n - a) / (3 + g % 8)))
    )

    def moved(word, i):
        return F.when(i < a, word).otherwise(
            F.get("words", (a + (i - a) % F.col("p")).cast("int"))
        )

    planted = F.array_join(F.transform("words", moved), " ")
    return chosen.select("doc_id", F.when(n > 0, planted).otherwise(F.col("text")).alias("text"))


@query
def op13_periodic_runs(spark, sf_dir):
    found = find_runs(
        planted_periods(documents(spark, sf_dir)), out="found", keep=["doc_id"], least=6, times=4
    )
    runs = F.col("found.runs")

    def better(x, y):
        """Whether run ``x`` has the greater exact exponent; on a tie the first one stays."""
        return x["length"] * y["period"] > y["length"] * x["period"]

    rest = F.slice(runs, 2, F.greatest(F.size(runs) - 1, F.lit(0)))
    best = F.aggregate(rest, F.get(runs, F.lit(0)), lambda x, y: F.when(better(y, x), y).otherwise(x))
    lines = F.transform(
        runs, lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n"))
    )
    return found.withColumn("best", best).select(
        "doc_id",
        F.size(runs).cast("long").alias("n_runs"),
        F.col("best.start").alias("start"),
        F.col("best.length").alias("length"),
        F.col("best.period").alias("period"),
        F.expr("best.length * 1000 div best.period").alias("exponent_milli"),
        _sha256(F.array_join(lines, "")).alias("runs_sha256"),
        _sha256(F.col("found.collapsed")).alias("collapsed_sha256"),
    )
