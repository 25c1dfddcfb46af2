"""Registered queries against SQL, toxicity on held-out labels, and the pipeline against brute force."""

import hashlib

import public_tokenizers
import pytest
import sentencepiece
from compare import compare, duck
from helpers import WORD, documents
from pyspark.sql import functions as F
from test_near_duplicates import classes
from test_passages_and_substrings import passages
from test_text_operators import windows

import __spark_entry__ as driver
import corpus_pipeline
from rulecast.llm.registry import ORACLES, QUERIES
from rulecast.llm.toxicity import fit_toxicity, keep_ordinary, score_toxicity, windows_of

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_matches_sql(spark, name):
    assert compare(spark, duck(SF), name, QUERIES[name], ORACLES[name], SF)[1:] == (True, "")


def test_all_operators_and_the_pipeline_are_registered():
    assert {int(n[2:].split("_")[0]) for n in QUERIES} == set(range(1, 14))
    assert set(QUERIES) | {"pipeline"} <= set(driver.queries())


def test_chat_formatting_is_native(spark):
    plan = QUERIES["op4_chat_formatting"](spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert not any(word in plan for word in ("Python", "Arrow", "Pandas", "ScalaUDF", "Join"))


def test_toxicity_on_held_out_documents(spark):
    sf = "/root/testdata/sf0.1"
    labels = spark.read.parquet(f"{sf}/labels.parquet").select("doc_id", "toxic")
    found = QUERIES["op1_toxicity"](spark, sf).filter("held_out").join(labels, "doc_id")
    counts = {(r.toxic, r.predicted): r.n for r in found.groupBy("toxic", "predicted").agg(F.count("*").alias("n")).collect()}
    recall = counts.get((1, 1), 0) / (counts.get((1, 1), 0) + counts.get((1, 0), 0))
    alarm = counts.get((0, 1), 0) / (counts.get((0, 1), 0) + counts.get((0, 0), 0))
    assert recall > 0.8 and alarm < 0.02  # a few of the labels stand for nothing in the text


def test_training_windows_come_from_whole_texts():
    said = [" ".join(f"t{i}w{k}" for k in range(n)) for i, n in enumerate((500, 0, 7, 100))]
    assert windows_of(said, 1, 10_000) == [f" {w} ".encode() for text in said for w in text.split()]
    few = windows_of(said, 1, 100)
    assert 80 <= len(few) <= 100 and few == windows_of(said, 1, 10_000)[::7]
    assert windows_of(["A, b c! d"], 3, 5) == [b" a b c ", b" d "] and windows_of([], 1, 5) == []


def test_toxicity_of_odd_rows(spark):
    labels = spark.createDataFrame([(i, int(i % 3 == 0)) for i in range(90)] + [(None, 1), (5, None), (7, 0), (7, 1)], "doc_id bigint, toxic int")
    said = [(i, f"some plain words here number{i} " * 8 + ("nastyword vileword " if i % 3 == 0 else "")) for i in range(90)]
    model = fit_toxicity(documents(spark, said), labels)
    odd = documents(spark, [(1, None), (2, ""), (3, "plain words"), (3, "plain words"), (None, "so nastyword and vileword"), (4, "x" * 100_000)])
    got = sorted(((r.doc_id, r.predicted) for r in score_toxicity(odd, model).collect()), key=repr)
    assert got == sorted([(1, 0), (2, 0), (3, 0), (3, 0), (None, 1), (4, 0)], key=repr)
    assert all(0 <= r.score <= 1 for r in score_toxicity(odd, model).collect())
    kept = keep_ordinary(odd, model)
    assert kept.columns == odd.columns and kept.count() == 5 and kept.filter("text is null").count() == 1
    assert score_toxicity(odd.limit(0), model).collect() == []
    untrained = fit_toxicity(odd, labels.limit(0))
    assert all(r.score < 1e-6 for r in score_toxicity(odd, untrained).collect())


def test_pipeline_equals_brute_force(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    assert [name for name, _ in corpus_pipeline.STAGES] == ["toxicity", "near_duplicates", "substring_dedup", "decontamination", "sentencepiece"]
    first = corpus_pipeline.without_toxic(spark, docs, SF)
    assert first.columns == docs.columns
    rows = [(r.doc_id, r.text) for r in first.collect()]
    kept = {i for i, _, _, own in classes(rows, 5, 80) if own}
    rows = [r for r in rows if r[0] in kept]
    removed = {i: digest for i, _, _, digest in passages(rows, 13)}
    items = [windows(r.text)[1] for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    library = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
    third = corpus_pipeline.without_repeated_passages(spark, documents(spark, rows).withColumn("n_chars", F.length("text").cast("bigint")), SF)
    want = {}
    for r in third.collect():
        assert hashlib.sha256(" ".join(WORD.findall(r.text)).encode()).hexdigest() == removed[r.doc_id] and r.n_chars == len(r.text)
        words, _ = windows(r.text)
        hit = {k + j for item in items for w in item for k in range(len(words) - len(w) + 1) if tuple(words[k : k + len(w)]) == w for j in range(len(w))}
        if not (hit and 20 * len(hit) >= len(words)):
            ids = library.encode(r.text)
            want[r.doc_id] = (len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256(library.decode(ids).encode()).hexdigest())
    got = {r.doc_id: tuple(r)[1:] for r in corpus_pipeline.run(spark, SF).collect()}
    assert got == want


ODD = [(1, "some plain words here " * 9, 5), (1, "other words than those " * 9, 5), (1, "some plain words here " * 9, 4), (2, "some plain words here " * 9, 3), (None, "some plain words here " * 9, 2), (3, None, 1), (4, "", 1), (None, None, 0), (5, "w" * 50_000, 0)]


@pytest.mark.parametrize("columns", [("doc_id", "text"), ("doc_id", "text", "n_chars"), ("row", "doc_id", "text", "kept", "times", "place", "key", "_record", "a.b")])
def test_stages_of_odd_rows(spark, columns):
    said = [(i, t, n) for i, t, n in ODD]
    docs = spark.createDataFrame(said, "doc_id bigint, text string, n_chars bigint")
    docs = docs.select(*(F.col(c) if c in docs.columns else F.col("n_chars").alias(c) for c in columns))
    assert corpus_pipeline.without_toxic(spark, docs, SF).count() == len(ODD)
    once = corpus_pipeline.without_near_duplicates(spark, docs, SF)
    assert once.columns == list(columns)
    left = sorted(((r.doc_id, r.text) for r in once.collect()), key=repr)
    assert left == sorted([(i, t) for k, (i, t, _) in enumerate(ODD) if k not in (2, 3)], key=repr)
    if "row" in columns:
        assert [r.row for r in once.collect() if (r.doc_id, r.text) == (1, ODD[0][1])] == [4]
    parts = corpus_pipeline.without_repeated_passages(spark, docs, SF)
    assert parts.columns == list(columns) and parts.count() == len(ODD) and parts.where("text is null").count() == 0
    assert {r.doc_id: r.text for r in parts.where("doc_id in (2, 5)").collect()} == {2: "", 5: "w" * 50_000}
    clean = corpus_pipeline.without_benchmark(spark, docs, SF)
    assert clean.columns == list(columns) and clean.count() == len(ODD)
    assert corpus_pipeline.encoded(spark, docs, SF).count() == len(ODD)
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, docs.limit(0), SF).collect() == []


def test_benchmark_stage_judges_rows_by_their_own_texts(spark):
    item = next(r.text for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect() if len(windows(r.text)[0]) > 13)
    docs = spark.createDataFrame([(1, item), (1, "clean words only"), (None, item), (None, "clean too")], "doc_id bigint, text string")
    assert sorted(r.text for r in corpus_pipeline.without_benchmark(spark, docs, SF).collect()) == ["clean too", "clean words only"]
