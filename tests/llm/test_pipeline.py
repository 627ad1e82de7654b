import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from holdfast.llm import packing, quality_conv
from holdfast.llm.queries import queries, tokenizer_file
from tests.llm import brute

SF = "/root/testdata/sf0.001"


def test_stages_take_effect_one_after_the_other(spark, monkeypatch):
    seen = []
    watched = []
    for name, stage in corpus_pipeline.STAGES:

        def run(s, d, f, stage=stage, name=name):
            seen.append((name, d))
            return stage(s, d, f)

        watched.append((name, run))
    monkeypatch.setattr(corpus_pipeline, "STAGES", watched)
    pieces = corpus_pipeline.run(spark, SF)
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    assert [n for n, _ in seen] == ["quality", "exact_copies", "near_copies", "mix", "pack"]
    tables = {n: d for n, d in seen}
    assert all(d.columns == docs.columns for d in tables.values())
    rows = {n: [(r["doc_id"], r["text"], r["source"]) for r in d.collect()] for n, d in tables.items()}

    net = quality_conv.train(docs, spark.read.parquet(f"{SF}/labels.parquet"))
    scored = quality_conv.score(docs, net).where("predicted = 1").select("doc_id").collect()
    assert {r[0] for r in rows["exact_copies"]} == {r["doc_id"] for r in scored}
    assert {r[0] for r in rows["near_copies"]} == {d for d, x in brute.exact(rows["exact_copies"]).items() if x[2]}
    near = brute.components(rows["near_copies"], 5, 80)
    assert {r[0] for r in rows["mix"]} == {d for d, (n, c) in near.items() if not n or c == d}
    words = lambda name: sum(len(brute.WORD.findall(t or "")) for _, t, _ in rows[name])
    assert words("pack") == pytest.approx(1.5 * words("mix"), abs=40)
    texts = spark.createDataFrame(rows["pack"], "doc_id bigint, text string, source string")
    alone = packing.pack(texts, tokenizer_file("word_bpe_49k.json"))
    total = lambda df: tuple(df.agg(F.sum("length"), F.countDistinct("doc_id")).first())
    assert total(pieces) == total(alone)


def test_every_operator_has_one_query():
    names = sorted(queries(), key=lambda n: int(n[2:].split("_")[0]))
    assert [int(n[2:].split("_")[0]) for n in names] == list(range(1, 14))
