import random

from pyspark.sql import functions as F

from holdfast.llm import line_rules
from tests.llm import brute


def texts():
    rng = random.Random(4)
    sentence = lambda n: " ".join(rng.choice("abcdefgh") * rng.randint(1, 4) for _ in range(n))
    out = [None, "", " \n ", "a" * 9, sentence(19), sentence(20), "x " * 30, "one two\none two\n\n one two\r\none two"]
    for _ in range(60):
        lines = [sentence(rng.randint(0, 14)) for _ in range(rng.randint(1, 8))]
        out.append("\n".join(lines + rng.choices(lines, k=rng.randint(0, 4))))
    out.append(" ".join(str(i % 500) for i in range(20_000)))
    out.append("# a | b < c > $5 & 100% *\n" * 3)
    return out


def test_base_counts_match_brute_force(docs):
    rows = [(i, t, "s") for i, t in enumerate(texts())]
    names = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed"]
    for r in line_rules.base_rules(docs(rows)).collect():
        assert tuple(r[n] for n in names) == brute.rules(r["text"]), r["text"][:80]


def boiler(host, n, start):
    menu = "home about contact privacy terms imprint login"
    own = lambda i: " ".join(f"{host}{i}x{k}" for k in range(30))
    rows = [(start + i, f"{menu}\n{own(i)}", host) for i in range(n)]
    rows.append((start + n, f"{menu}\n{menu.upper()}\n {menu}  \n" * 3 + " ".join(f"q{k}" for k in range(3)), host))
    return rows


def test_lines_of_many_documents_of_one_host_are_removed(docs):
    rows = boiler("h", 30, 0) + [(100 + i, r[1], "other") for i, r in enumerate(boiler("o", 3, 0))]
    df = docs(rows).withColumn("line_words", F.lit("mine")).drop("line_words")
    got = {r["doc_id"]: r for r in line_rules.judge(df, least_documents=10, share=0.1, depleted=0.6).collect()}
    assert got[0]["removed_words"] == 7 and got[0]["kept"]
    assert got[30]["removed_words"] == 7 and not got[30]["kept"]
    assert got[100]["removed_words"] == 0  # too few documents of that host
    cleaned = {r["doc_id"]: r["text"] for r in line_rules.clean(df, 10, 0.1, 0.6).collect()}
    assert 30 not in cleaned and cleaned[0] == rows[0][1].split("\n")[1] and cleaned[100] == rows[31][1]


def test_copies_of_a_text_count_once(docs):
    text = "\n".join(" ".join(f"w{j}_{k}" for k in range(10)) for j in range(4))
    rows = [(i, text, None) for i in range(80)] + [(200, None, None)]
    got = line_rules.judge(docs(rows), least_documents=10, share=0.0).collect()
    assert len(got) == 81 and all(r["kept"] == (r["doc_id"] != 200) for r in got)


def test_empty_table_and_no_python(docs):
    assert line_rules.rules_query(docs([])).count() == 0
    plan = line_rules.rules_query(docs([(1, "a", "s")]))._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan
