import math
import zlib

import pytest

from holdfast.llm import quality_conv, toxicity
from holdfast.llm.queries import op1_quality_conv, op4_toxicity

SF = "/root/testdata/sf0.01"


def auc(rows):
    order = sorted(rows)
    ranks, i = {}, 0
    while i < len(order):
        j = i
        while j < len(order) and order[j][0] == order[i][0]:
            j += 1
        ranks[order[i][0]] = (i + j + 1) / 2
        i = j
    ones = [ranks[s] for s, y in rows if y]
    return (sum(ones) - len(ones) * (len(ones) + 1) / 2) / (len(ones) * (len(rows) - len(ones)))


@pytest.mark.parametrize("query,label,least", [(op1_quality_conv, "quality", 0.93), (op4_toxicity, "toxic", 0.75)])
def test_held_out_ranking(spark, query, label, least):
    labels = spark.read.parquet(f"{SF}/labels.parquet").select("doc_id", label)
    scored = query(spark, SF)
    assert scored.count() == spark.read.parquet(f"{SF}/documents.parquet").count()
    rows = scored.join(labels, "doc_id").collect()
    assert all(0 <= r["score"] <= 1 and r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2) for r in rows)
    assert auc([(r["score"], r[label]) for r in rows if r["held_out"]]) >= least


GOOD = [f"the quiet river number {i} ran past the old mill and on to the sea" for i in range(40)]
BAD = [f"BUY!! NOW!! {i}!! CHEAP!! ### $$$ %%% CLICK!! HERE!!" for i in range(40)]


def test_quality_edges(docs):
    net = quality_conv.fit([(t, 1) for t in GOOD] + [(t, 0) for t in BAD])
    rows = [(1, GOOD[0], "s"), (2, BAD[0], "s"), (3, None, None), (4, "", "s"), (5, GOOD[1] * 3000, "s"), (1, GOOD[0], "s"), (None, "é" * 600, "s")]
    df = docs(rows).withColumnRenamed("lang", "score")
    got = quality_conv.score(df, net)
    assert got.columns == ["doc_id", "text", "source", "n_chars", "score", "predicted"]
    out = got.collect()
    assert len(out) == len(rows) and all(0 <= r["score"] <= 1 for r in out)
    by = {r["doc_id"]: r["predicted"] for r in out}
    assert by[1] == 1 and by[2] == 0 and by[5] == 1
    assert out[2]["score"] == out[3]["score"] and out[0]["score"] == out[5]["score"]
    assert quality_conv.score(docs([]), net).count() == 0


def test_quality_without_labels_answers_a_constant(docs):
    net = quality_conv.fit([])
    assert {r["score"] for r in quality_conv.score(docs([(1, "a", "s"), (2, "bb", "s")]), net).collect()} == {0.5}


def test_chunks_cover_every_byte():
    import numpy as np

    for size in (0, 1, 511, 512, 513, 960, 961, 5000):
        start, length, text = quality_conv.chunks(np.array([0, 3, 3 + size]))
        own = [(s, n) for s, n, t in zip(start, length, text, strict=True) if t == 1]
        covered = set().union(*(range(s, s + n) for s, n in own))
        assert covered == set(range(3, 3 + size))
        assert all(b[0] < a[0] + a[1] for a, b in zip(own, own[1:], strict=False))


def plain_probability(net, text):
    """The network on one text, number by number."""
    data = text.encode()
    pooled = []
    for start in range(0, max(1, len(data) - quality_conv.OVERLAP), quality_conv.CHUNK - quality_conv.OVERLAP):
        chunk = list(data[start : start + quality_conv.CHUNK])
        chunk += [256] * (quality_conv.CHUNK - len(chunk))
        row = []
        for f in range(quality_conv.FILTERS):
            taps = net.filters[:, f].reshape(quality_conv.WIDTH, quality_conv.DEPTH)
            answer = {b: [float(net.embedding[b] @ tap) for tap in taps] for b in set(chunk)}
            row.append(
                max(
                    0.0,
                    max(
                        sum(answer[chunk[at + k]][k] for k in range(quality_conv.WIDTH)) + float(net.bias[f])
                        for at in range(quality_conv.CHUNK - quality_conv.WIDTH + 1)
                    ),
                )
            )
        pooled.append(row)
    high = [max(c) for c in zip(*pooled, strict=True)]
    mean = [sum(c) / len(pooled) for c in zip(*pooled, strict=True)]
    size = [min(math.log1p(len(data)) / 6, 1.0), min(len(data) / quality_conv.CHUNK, 1.0)]
    inputs = [*high, *mean, *size]
    units = [
        max(0.0, sum(x * float(w) for x, w in zip(inputs, net.hidden[:, u], strict=True)) + float(net.shift[u]))
        for u in range(quality_conv.HIDDEN)
    ]
    return 1 / (1 + math.exp(-(sum(u * w for u, w in zip(units, net.weights, strict=True)) + net.offset)))


def test_quality_equals_plain_loops_at_every_alignment(docs):
    net = quality_conv.fit([(t, 1) for t in GOOD] + [(t, 0) for t in BAD])
    texts = ["", "a", GOOD[3], "x" + GOOD[3], "xyz" + BAD[5], "é" * 300, (GOOD[7] + " " + BAD[2]) * 9, "q" * 512, "q" * 513, "q" * 961]
    rows = [(i, t, "s") for i, t in enumerate(texts)] + [(90, None, "s"), (91, texts[6], "s")]
    got = {r["doc_id"]: r["score"] for r in quality_conv.score(docs(rows), net).collect()}
    for i, t in enumerate(texts):
        assert got[i] == pytest.approx(plain_probability(net, t), abs=1e-4)
    assert got[90] == pytest.approx(got[0], abs=1e-6) and got[91] == pytest.approx(got[6], abs=1e-6)


def test_quality_threshold_on_held_out_texts(spark):
    labels = spark.read.parquet(f"{SF}/labels.parquet").select("doc_id", "quality")
    rows = op1_quality_conv(spark, SF).where("held_out").join(labels, "doc_id").collect()
    ones = [r for r in rows if r["quality"] == 1]
    chosen = [r for r in rows if r["predicted"] == 1]
    assert sum(r["predicted"] for r in ones) >= 0.95 * len(ones)
    assert sum(r["quality"] for r in chosen) >= 0.95 * len(chosen)


def grammar():
    g = toxicity.Grammar()
    g.words["idiot"] = ("insult", 1.0)
    g.stems["scum"] = ("insult", 1.0)
    return g


def test_grammar_scores_clauses_not_words():
    read = lambda t: dict(zip(toxicity.CHANNELS, toxicity.read_clauses(grammar(), t), strict=True))
    assert read("what an idiot")["plain"] > 0
    assert read("you idiot")["targeted"] > 0 and read("you. idiot")["targeted"] == 0
    assert read("he is not an idiot")["negated"] > 0 and read("he is not an idiot")["targeted"] == 0
    assert read("not now. an idiot")["negated"] == 0
    assert read("she said idiot")["reported"] > 0 and read('the word "idiot" here')["reported"] > 0
    assert read("i will kill you")["threat"] > 0 and read("kill the process")["threat"] == 0
    assert read("scumbags everywhere")["plain"] > 0 and read("idiotic")["plain"] == 0


def test_toxicity_edges(docs):
    g = grammar()
    rows = [(1, "you idiot", "s"), (2, "a fine day", "s"), (3, None, None), (4, "", "s"), (5, "fine day " * 50_000 + "you idiot", "s"), (1, "you idiot", "s")]
    df = docs(rows).withColumnRenamed("lang", "predicted")
    out = toxicity.score(df, g).collect()
    by = {r["doc_id"]: r["predicted"] for r in out}
    assert len(out) == 6 and by == {1: 1, 2: 0, 3: 0, 4: 0, 5: 1}
    assert toxicity.score(docs([]), g).count() == 0
    assert toxicity.fit([]).words == {}


def test_lexicon_learns_words_and_stems_but_not_copies():
    toxic = [(f"plain words number {i} klodda{'abcdefgh'[i % 8]}x and then {i * 7} oafish here {i * 3}", 1) for i in range(60)]
    toxic += [("a copied text that holds zebrafish in one place only", 1)] * 30
    clean = [(f"plain words number {i} and then {i * 7} calmly here {i * 3}", 0) for i in range(120)]
    g = toxicity.learn_lexicon(toxic + clean)
    assert g.entry("oafish") and g.entry("kloddazzz") and not g.entry("zebrafish") and not g.entry("plain")


def test_queries_on_empty_tables(spark, docs):
    labels = spark.createDataFrame([], "doc_id bigint, quality int, toxic int")
    assert quality_conv.quality_query(docs([]), labels).count() == 0
    assert toxicity.toxicity_query(docs([]), labels).count() == 0
    one = docs([(1, None, None)])
    assert {r["score"] for r in quality_conv.quality_query(one, labels).collect()} == {0.5}
    unknown = spark.createDataFrame([(1, None, None), (None, 1, 1)], "doc_id bigint, quality int, toxic int")
    assert toxicity.toxicity_query(one, unknown).count() == 1


def test_states_hold_over_sentences_and_look_both_ways():
    g = grammar()
    g.words["oaf"] = ("vague", 0.4)
    read = lambda t: {k: v for k, v in zip(toxicity.CHANNELS, toxicity.read_clauses(g, t), strict=True) if v}
    for text in ('"You idiot. You idiot," he wrote', "idiot, he said", "he wrote: you idiot. You idiot", '"an oaf. an oaf"'):
        assert set(read(text)) == {"reported"}, text
    for text in ("an idiot he is not", "he is not an oaf"):
        assert set(read(text)) == {"negated"}, text
    assert 0 < read("you oaf")["targeted"] < read("you idiot")["targeted"]
    assert set(read('he said: "hm."\n\nyou idiot')) == {"targeted"}
    assert set(read('a 5" oaf')) == {"plain"}
    assert not any(k.startswith("vague") for k in toxicity.CHANNELS)


def test_rare_insults_clitics_and_inflected_threats():
    read = lambda t: {k: v for k, v in zip(toxicity.CHANNELS, toxicity.read_clauses(grammar(), t), strict=True) if v}
    assert set(read("an idiot's work")) == {"plain"}
    assert set(read("you're an idiot")) == set(read("you’re an idiot")) == {"targeted"}
    assert set(read("don't be an idiot")) == set(read("I don’t see an idiot")) == {"negated"}
    for text in ("he kills you", "shooting you", "killing them all", "je te tuerai, toi", "te mataré a ti"):
        assert set(read(text)) == {"threat"}, text
    reader = toxicity.Reader(grammar())
    assert reader.score(["an idiot's work"])[0] > reader.idle
    # 4 of 500 toxic texts hold the rare one, 4 of 500 and 40 of 5,000 the usual one
    toxic = [(f"plain words {i} {'gork' if i < 4 else 'calm'} {'pebble' if 4 <= i < 8 else 'calm'} here {i}", 1) for i in range(500)]
    toxic = [(t.replace("gork", f"x{i} gork").replace("pebble", f"y{i} pebble"), y) for i, (t, y) in enumerate(toxic)]
    clean = [(f"plain words {i} {'pebble' if i < 40 else 'calm'} here {i}", 0) for i in range(5000)]
    g = toxicity.learn_lexicon(toxic + clean)
    assert g.entry("gork") and not g.entry("pebble") and not g.entry("calm")
