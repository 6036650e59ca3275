"""The registered queries over whole small tables, and the pipeline."""

import public_tokenizers
import pytest
from pyspark.sql import functions as F

import __spark_entry__
import corpus_pipeline
from checks.compare import connect, difference
from emberwall.llm.oracle import oracle_sql
from emberwall.llm.queries import queries

SMALL = "/root/testdata/sf0.001"
COLUMNS = {
    "op1_lm_scoring": "doc_id held_out n_tokens n_known train_tokens base_score score",
    "op2_quality_classifier": "doc_id held_out score predicted",
    "op3_suffix_array_dedup": "doc_id n_bytes n_removed n_spans kept_sha256",
    "op4_quality_rules": (
        "doc_id n_words word_chars n_symbols n_dup_lines n_repeat_words base_failed kept"
    ),
    "op5_token_counts": "doc_id n_bytes n_tokens over_limit",
    "op6_nearest_neighbours": "query_id rank vec_id score",
    "op7_byte_bpe": "doc_id n_tokens ids_sha256 decoded_sha256",
    "op8_best_fit_packing": "doc_id piece start length ids_crc32 sequence_id offset",
    "op9_secret_scans": "doc_id n_assign n_access n_hex base_sha256 spans",
    "op10_simhash_near_dedup": "doc_id fingerprint component_id",
    "op11_hard_negatives": (
        "anchor_id positive_id rank negative_id positive_score negative_score"
    ),
    "op12_chat_formatting": (
        "conv_id n_turns turns_sha256 loss_chars loss_sha256 formatted_chars"
    ),
    "op13_periodic_runs": (
        "doc_id n_runs start length period exponent_milli runs_sha256 collapsed_sha256"
    ),
}


def test_all_are_registered():
    known = __spark_entry__.queries()
    assert set(COLUMNS) == set(queries()) and set(queries()) | {"pipeline"} <= set(known)
    assert set(oracle_sql()) <= set(__spark_entry__.oracle_sql())


@pytest.mark.parametrize("name", COLUMNS)
def test_columns_and_rows(spark, name):
    df = queries()[name](spark, SMALL)
    assert df.columns == COLUMNS[name].split()
    ids = [r[0] for r in df.select(df.columns[0]).distinct().collect()]
    if name in ("op6_nearest_neighbours", "op11_hard_negatives"):
        vectors = spark.read.parquet(f"{SMALL}/embeddings.parquet")
        every = 20 if name == "op6_nearest_neighbours" else 50
        assert len(ids) == vectors.filter(f"vec_id % {every} = 0").count()
    elif name == "op12_chat_formatting":
        chats = spark.read.parquet(f"{SMALL}/conversations.parquet")
        assert len(ids) == chats.select("conv_id").distinct().count() + 1 and -7 in ids
    else:
        assert len(ids) == spark.read.parquet(f"{SMALL}/documents.parquet").count()


@pytest.mark.parametrize("name", sorted(oracle_sql()))
def test_same_as_sql(spark, name):
    assert difference(queries()[name](spark, SMALL), connect(SMALL), oracle_sql()[name]) is None


def test_pipeline_stages_on_a_small_table(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    count = docs.count()
    for name, stage in corpus_pipeline.STAGES[:-1]:
        after = stage(spark, docs, SMALL)
        assert after.columns == docs.columns, name
        assert after.filter("n_chars <> length(text)").count() == 0
        assert 0 < after.count() <= count
        docs, count = after, after.count()
    packed = corpus_pipeline.STAGES[-1][1](spark, docs, SMALL)
    assert packed.select("doc_id").distinct().count() == count
    assert packed.groupBy("sequence_id").agg(F.sum("length").alias("n")).filter("n > 4096").count() == 0


def test_pipeline_takes_odd_rows(spark, docs, no_docs, texts):
    for table in (docs, no_docs):
        for _, stage in corpus_pipeline.STAGES[:-1]:
            table = stage(spark, table, SMALL)
            assert table.columns == docs.columns
        last = corpus_pipeline.STAGES[-1][1](spark, table, SMALL)
        assert last.select("doc_id").distinct().count() == table.select("doc_id").distinct().count()


def test_each_stage_takes_effect(spark, docs, texts):
    by_id = dict(texts)
    rules, near, repeats, secrets, _ = [stage for _, stage in corpus_pipeline.STAGES]
    kept = {r.doc_id for r in rules(spark, docs, "").collect()}
    assert set(range(30)) <= kept and not kept & {37, 38, 39, 42, 48}
    one = [r.doc_id for r in near(spark, docs, "").collect()]
    assert {0, 1} <= set(one) and not {30, 31} & set(one)
    cut = {r.doc_id: r.text for r in repeats(spark, docs, "").collect()}
    assert cut[48] is None and cut[5] == by_id[5]
    assert all(len(cut[i]) < len(by_id[i]) - 200 for i in (34, 35, 36))
    clean = {r.doc_id: r.text for r in secrets(spark, docs, "").collect()}
    assert clean[5] == by_id[5] and "[SECRET]" in clean[40]


def test_packing_stage_counts_the_end(spark, docs):
    from tokenizers import Tokenizer

    library = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    pieces = corpus_pipeline.packed_sequences(spark, docs, "")
    total = pieces.agg(F.sum("length")).first()[0]
    texts = [r.text or "" for r in docs.collect()]
    assert total == sum(len(library.encode(t, add_special_tokens=False).ids) + 1 for t in texts)
