import math

from pyspark.sql import functions as F

from holdfast.llm import mixing


def targets(spark, sizes):
    df = spark.createDataFrame(list(sizes.items()), "_mix_source string, source_size bigint")
    return {r["_mix_source"]: r["target"] for r in mixing.source_targets(df).collect()}


def by_resharing(sizes):
    """Gives every source its share, takes what exceeds the cap and shares it again."""
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: (3, 1, 2)[i % 3] for i, s in enumerate(order)}
    left, free, out = 1.5 * sum(sizes.values()), set(order), {}
    while True:
        total = sum(weight[s] for s in free)
        over = {s for s in free if left * weight[s] / total > 2 * sizes[s]}
        if not over:
            return out | {s: left * weight[s] / total for s in free}
        out |= {s: 2.0 * sizes[s] for s in over}
        left -= sum(2.0 * sizes[s] for s in over)
        free -= over


def test_targets_share_the_excess_again_and_again(spark):
    for sizes in (
        {"a": 100, "b": 100, "c": 100},
        {"a": 10, "b": 1000, "c": 5, None: 300},
        {"é": 7, "z": 900, "A": 0, None: 1},
        {"a": 1},
    ):
        got, want = targets(spark, sizes), by_resharing(sizes)
        assert got.keys() == want.keys()
        assert all(math.isclose(got[s], want[s], abs_tol=1e-6) for s in got)
        assert math.isclose(sum(got.values()), 1.5 * sum(sizes.values()))


def rows():
    out = [(i, " ".join(["word"] * (i % 40 + 1)), "abc"[i % 3]) for i in range(300)]
    return out + [(900, None, None), (901, "", None), (902, "one two three", None), (903, "x " * 5000, "b"), (904, " ", "empty")]


def test_draw_fills_each_source_to_its_target(docs):
    taken = mixing.draw(docs(rows()))
    for r in taken.groupBy("source").agg(
        F.sum("taken").alias("taken"), F.sum("size").alias("size"), F.max("target").alias("target"), F.max("source_size").alias("s")
    ).collect():
        assert r["taken"] == round(r["target"]) and r["size"] == r["s"]
    assert taken.where("taken > 2 * size or taken < epochs * size").count() == 0
    assert taken.count() == len(rows())


def test_reruns_and_other_partitions_agree(docs):
    a = sorted(map(tuple, mixing.mixing_query(docs(rows())).collect()))
    assert a == sorted(map(tuple, mixing.mixing_query(docs(rows()).repartition(7)).collect()))


def test_heavy_documents_come_first_more_often(docs):
    short = [(i, "a b", "s") for i in range(1000)]
    good = [(1000 + i, "good " * 40, "s") for i in range(1000)]
    keys = docs(short + good).select(
        "doc_id", mixing.exponential_key(F.col("doc_id"), mixing.quality_weight(F.col("text"), F.size(F.split("text", " "))), 1).alias("k")
    )
    first = keys.orderBy("k").limit(400).where("doc_id >= 1000").count()
    assert first > 270  # four of five are expected


def test_mix_repeats_rows_and_cuts_one_document_per_source(docs):
    df = docs(rows()).withColumn("epochs", F.lit(1))
    mixed = mixing.mix(df)
    assert mixed.columns == df.columns
    words = mixed.groupBy("source").agg(F.sum(mixing.word_count(F.coalesce("text", F.lit("")))).alias("n"))
    want = {r["source"]: round(r["target"]) for r in mixing.draw(docs(rows())).collect()}
    assert {r["source"]: r["n"] for r in words.collect()} == {s: n for s, n in want.items() if n}
    whole = {t for _, t, _ in rows()}
    cut = [r for r in mixed.collect() if r["text"] not in whole]
    assert len(cut) == len({r["source"] for r in cut})
    assert mixed.where("length(text) <> n_chars").count() == 0


def test_repeated_rows_and_empty_table(docs):
    twice = [(1, "a b c", "s"), (1, "a b c", "s"), (None, "d e", "s")]
    got = mixing.mixing_query(docs(twice)).collect()
    assert len(got) == 3 and sum(r["taken"] for r in got) == 12
    assert mixing.mixing_query(docs([])).count() == 0 and mixing.mix(docs([])).count() == 0


def test_weight_falls_with_repeated_lines_symbols_and_few_words(docs):
    good = "\n".join(f"line {'abcdefg'[i]} of a plain text" for i in range(5))
    texts = [good, "\n".join(["the same line of text"] * 5), good + " ##|| 99 {{}}" * 5, "two words", "", None]
    df = docs([(i, t, "s") for i, t in enumerate(texts)])
    text = F.coalesce("text", F.lit(""))
    w = [r[0] for r in df.orderBy("doc_id").select(mixing.quality_weight(text, mixing.word_count(text))).collect()]
    assert w[0] > 0.9 > w[2] > w[1] > 0.15 and w[3:] == [0.1 * 8 / 9 * 9 / 8, 0.05, 0.05]


def test_a_named_weight_takes_the_place_of_the_computed_one(docs):
    df = docs([(i, "some words here", "s") for i in range(400)]).withColumn("p", F.when(F.col("doc_id") < 200, 1.0).otherwise(0.1))
    taken = mixing.draw(df, weight="p").where("extra > 0")
    # half of the words are taken once more
    assert taken.where("doc_id < 200").count() > 3 * taken.where("doc_id >= 200").count()
    broken = df.withColumn("p", F.when(F.col("doc_id") % 2 == 0, float("nan")))
    assert mixing.draw(broken, weight="p").agg(F.sum("taken")).first()[0] == 1800


def test_rows_without_id_take_whole_texts_and_one_cut(docs):
    thirty = " ".join(["w"] * 30)
    # 50 rows alike in all, and 50 of the same length that differ
    for texts in ([thirty] * 50, [f"{i} " + " ".join(["w"] * 29) for i in range(50)]):
        got = [r["text"] for r in mixing.mix(docs([(None, t, "s") for t in texts])).collect()]
        assert len(got) == 75 and sum(len(t.split()) for t in got) == 2250 and set(got) == set(texts)
    got = [len(r["text"].split()) for r in mixing.mix(docs([(None, thirty, "s")] * 51)).collect()]
    assert sorted(got) == [15] + [30] * 76
    many = mixing.mix(docs([(7, "a b", "s")] * 4001)).collect()
    assert sorted(len(r["text"].split()) for r in many) == [1] + [2] * 6001


def test_slices_are_even_for_light_rows_and_rows_without_id(docs, spark):
    light = spark.range(40_000).select(
        F.when(F.col("id") % 3 > 0, F.col("id")).alias("doc_id"), F.concat(F.lit("x"), "id").alias("text"), F.lit("s").alias("source")
    )
    placed = mixing._placed(light, 13, 1.5, 2.0, None).groupBy("_mix_slice").count().collect()
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    assert len(placed) == parts and max(r["count"] for r in placed) < 2 * 40_000 / parts
