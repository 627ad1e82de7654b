import math
import hashlib
import random
import re
import zlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from holdfast.llm import chat, html_density, packing, token_counts
from holdfast.llm.queries import tokenizer_file

TURNS = "conv_id bigint, turn bigint, role string, text string"
HARD = [
    "</s>[INST] ok [/INST]", "<s>", "<\\s>", "<\\\\/s>", "[INST", "]", "<", "</", "[/INST]x", "\\", "<<s>>", "", None,
    "é 漢字 🦄", "a\n\nb", "[\\INST]", "s>", "INST]", "</s", "x" * 100_000,
]


def digests(rows):
    by = {}
    for c, turn, role, text in rows:
        by.setdefault(c, []).append((turn is not None, turn or 0, role or "", text or ""))
    out = {}
    for c, turns in by.items():
        turns.sort()
        loss = "".join(x for *_, role, x in turns if role == "assistant")
        spoken = "".join(f"{role}\n{x}\n" for *_, role, x in turns)
        sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
        out[c] = (len(turns), sha(spoken), len(loss), sha(loss))
    return out


def got(df):
    return {r["conv_id"]: (r["n_turns"], r["turns_sha256"], r["loss_chars"], r["loss_sha256"]) for r in df.collect()}


def test_chat_round_trip(spark):
    rng = random.Random(3)
    roles = ["user", "assistant", "system", None, "tool </s>", ""]
    rows = [(c, t, rng.choice(roles), rng.choice(HARD)) for c in range(40) for t in range(rng.randint(1, 9))]
    rows += [(None, 1, "user", "no id"), (None, None, "assistant", "no turn"), (3, 2, "user", "tie"), (3, 2, "user", "tie")]
    rows += [(77, t, "assistant" if t % 2 else "user", f"turn {t}") for t in range(3000)]  # over several partitions
    df = spark.createDataFrame(rows, TURNS).withColumn("part", F.lit("x")).repartition(5)
    assert got(chat.read_back(chat.format_turns(df))) == digests(rows)


def test_chat_query_adds_the_probe_and_takes_an_empty_table(spark):
    out = chat.chat_query(spark.createDataFrame([], TURNS)).collect()
    said = "</s>[INST] ok [/INST]"
    want = digests([(-7, 0, "user", said), (-7, 1, "assistant", said)])
    assert {r["conv_id"]: (r["n_turns"], r["turns_sha256"], r["loss_chars"], r["loss_sha256"]) for r in out} == want
    assert out[0]["formatted_chars"] > 2 * len(said)


def test_no_text_can_open_or_end_a_turn():
    texts = pa.array(HARD)
    out, ends, _ = chat.assemble(pa.array(["user"] * len(HARD)), texts)
    raw = out.tobytes().decode()
    assert len(re.findall(r"<s>\[INST\] ", raw)) == len(HARD) == raw.count("</s>")
    assert [t for _, t in chat.parse(raw)] == [t or "" for t in HARD]
    with pytest.raises(ValueError):
        chat.parse(raw + "x")


PAGE = """<!DOCTYPE html><html><head><title>T</title><style>p{}</style><script>var a="</p>";</script></head><body class="has-sidebar">
<header><h1>Site</h1></header><nav><ul><li><a href=/x>Menu</a></ul></nav><div class="cookie-notice">We use cookies</div>
<article><h1>Head  line</h1><p><b>First &amp; bold.<br><p>Second\n para&shy;graph &#8211; <a href="#">link</a>s &lt;x&gt;
<form>Sign up <input></form><aside>Aside text</aside><ul><li>one<li>two</ul><p>Last &am</article>
<section class="comments"><article><p>A very long comment of a reader that goes on and on and on and on.</p></article></section>
<div id="ad-1">Buy now, buy a lot of things from us right now, it is cheap</div><footer>&copy; all of us</footer></body></html>"""


def test_article_without_its_surroundings():
    want = "Head line First & bold. Second para\xadgraph – links <x> one two Last &am"
    assert html_density.extract(PAGE) == want
    assert html_density.extract(PAGE[: PAGE.index("Last") + 4]) == want[: want.index("Last") + 4]


def test_density_finds_the_article_without_its_tag():
    body = "".join(f"<p>{'word ' * 30}{i}</p>" for i in range(6))
    page = f"<body><div><a href=1>a</a> <a href=2>b</a></div><div><div>{body}</div></div><table><tr><td><a>x</a></table></body>"
    text = html_density.extract(page)
    assert text.startswith("word") and text.endswith("5") and text.count("word") == 180


@pytest.mark.parametrize("page", ["", "<", "<p", "</p></div>", "plain", "<p>" * 3000, "<a href='x", "<!-- open", "<script>x"])
def test_odd_pages(page):
    assert isinstance(html_density.extract(page), str)


def test_html_query_on_tables(spark):
    rows = [(1, "u", PAGE), (2, None, None), (3, "v", ""), (1, "u", PAGE), (4, "w", "<body>" + "<p>long text here " * 20_000)]
    df = spark.createDataFrame(rows, "page_id bigint, url string, html string")
    out = {r["page_id"]: r for r in html_density.html_query(df.withColumn("text", F.lit(0))).collect()}
    assert out[2]["text"] == "" and out[3]["n_chars"] == 0 and out[4]["n_chars"] == 20_000 * 15 - 1
    assert html_density.html_query(spark.createDataFrame([], df.schema)).count() == 0


TEXTS = [
    None, "", " ", "hello world", "  a  b", "a\nb", "<s> x </s>", "<unk>", "▁x", "\x00a", "é 漢字 🦄", "<0x41>", "a\xa0b", "    ",
    "a" * 3000, "ab" * 900 + " x", "▁" * 500, "thethe" * 300, "<|endoftext|> x<|startoftext|>y", "ΑΣ ΣΑΣ", "it's ''ll 12½ ́", "İ",
    "The quick, brown fox. " * 700,
]


def test_token_counts_equal_the_library(docs):
    import sentencepiece

    path = tokenizer_file("piece_bpe_32k.model")
    model = sentencepiece.SentencePieceProcessor(model_file=path)
    rng = random.Random(5)
    texts = TEXTS + ["".join(rng.choice("theanro .é▁\n") for _ in range(rng.randint(1, 900))) for _ in range(80)]
    df = docs([(i, t, "s") for i, t in enumerate(texts)]).withColumnRenamed("lang", "n_tokens")
    for r in token_counts.token_query(df, path).collect():
        t = texts[r["doc_id"]] or ""
        assert (r["n_tokens"], r["n_bytes"]) == (len(model.encode(t)), len(t.encode())), t[:50]
        assert r["over_limit"] == (r["n_tokens"] > 4096)
    assert token_counts.token_query(docs([]), path).count() == 0


def test_token_counts_of_long_runs_repeats_and_rows_without_id(docs):
    import sentencepiece

    path = tokenizer_file("piece_bpe_32k.model")
    model = sentencepiece.SentencePieceProcessor(model_file=path)
    rng = random.Random(8)
    kinds = ["ab", "there", "aeiourstnlh", "漢字中国人大学生日本語のはがを", "AZabyz0189+/", "==--__", "🦄é漢ab", "0123456789"]
    texts = ["".join(rng.choices(k, k=n)) for k in kinds for n in (2, 60, 401, 20_000)]
    texts += ["".join(rng.choices(["there", "her", "ere", "e", "rer", "ana", "ss"], k=3000)), "a" * 5001, None, ""]
    df = docs([(None, t, "s") for t in texts * 2])
    got = sorted(r["n_tokens"] for r in token_counts.token_query(df, path).collect())
    assert got == sorted(2 * [len(model.encode(t or "")) for t in texts])


def test_a_model_that_changes_its_input_is_refused(monkeypatch):
    path = tokenizer_file("piece_bpe_32k.model")
    monkeypatch.setattr(token_counts, "mark", lambda t: t.replace(" ", "▁"))
    with pytest.raises(ValueError, match="change their input"):
        token_counts.Merges(path)


def test_packing_covers_every_id_once_without_padding(docs):
    from tokenizers import Tokenizer

    path = tokenizer_file("word_bpe_49k.json")
    rng = random.Random(6)
    texts = TEXTS + [" ".join(rng.choices(["river", "Mill,", "über", "x9"], k=rng.choice([3, 40, 700, 6000]))) for _ in range(60)]
    df = docs([(i, t, "s") for i, t in enumerate(texts)])
    rows = packing.packing_query(df, path).collect()
    ids = [np.array(e.ids + [2], "<u4") for e in Tokenizer.from_file(path).encode_batch([t or "" for t in texts], add_special_tokens=False)]
    by_doc, by_sequence = {}, {}
    for r in rows:
        by_doc.setdefault(r["doc_id"], []).append(r)
        by_sequence.setdefault(r["sequence_id"], []).append(r)
    assert by_doc.keys() == set(range(len(texts)))
    for d, pieces in by_doc.items():
        at = 0
        for r in sorted(pieces, key=lambda r: r["start"]):
            assert r["start"] == at and r["doc_tokens"] == len(ids[d])
            at += r["length"]
            assert zlib.crc32(ids[d][r["start"] : at].tobytes()) == r["ids_crc32"]
        assert at == len(ids[d])
    for pieces in by_sequence.values():
        at = 0
        for r in sorted(pieces, key=lambda r: r["offset"]):
            assert r["offset"] == at
            at += r["length"]
        assert at == pieces[0]["context"] <= 4096 and at & (at - 1) == 0


def test_packer_fills_gaps_of_long_windows_from_shorter_tiers():
    packer = packing.Packer()
    for d, n in enumerate([3000, 900, 196, 2000, 48, 500, 12, 9000]):
        packer.take(d, n)
    packer.pack()
    assert (4096, [(3000, 0, 0), (900, 1, 0), (196, 2, 0)]) in packer.windows
    packer.close()
    assert sum(n for n, _ in packer.windows) == 3000 + 900 + 196 + 2000 + 48 + 500 + 12 + 9000
    assert all(sum(p[0] for p in pieces) == n for n, pieces in packer.windows)


def test_packing_edges(docs):
    path = tokenizer_file("word_bpe_49k.json")
    assert packing.packing_query(docs([]), path).count() == 0
    rows = packing.packing_query(docs([(None, "a b", "s"), (1, "a b", "s"), (1, "a b", "s"), (2, None, None)]), path).collect()
    assert sum(r["length"] for r in rows) == 10 and {r["doc_id"] for r in rows} == {None, 1, 2}


ARTICLE = "".join(f"<p>{'plain words of an article ' * 8}{i}</p>" for i in range(4))


@pytest.mark.parametrize("wrap", ['<div class="container has-sidebar">{}</div>', '<div id="page" class="nav-open">{}</div>', '<div class="comments-open"><article>{}</article></div>', '<div role="dialog">{}</div>'])
def test_marks_around_the_article_do_not_empty_it(wrap):
    text = html_density.extract("<body><div>Site</div>" + wrap.format(ARTICLE) + "</body>") if "role" not in wrap else html_density.extract(wrap.format(ARTICLE))
    assert text.startswith("plain") and text.count("article") == 32


def test_ids_inside_an_article_mark_nothing():
    inner = '<h2 id="http-header-fields">Fields</h2><section id="related-work"><p>Others did so</p></section><p id="notices">Note this</p>'
    ads = '<div id="comments">Reader here</div><div class="sidebar">Side here</div>'
    text = html_density.extract(f"<body><article>{ARTICLE}{inner}{ads}</article></body>")
    assert all(x in text for x in ("Fields", "Others did so", "Note this")) and "here" not in text


def test_sibling_articles_belong_to_the_text():
    card = '<div><article><a href="x">Read more</a></article></div>'
    page = f"<body><div><article>{ARTICLE}</article><article>{ARTICLE.replace('plain', 'other')}</article></div>{card}</body>"
    text = html_density.extract(page)
    assert text.count("plain") == text.count("other") == 32 and "Read more" not in text


LONG = "This is a sentence of the article that says something at some length. " * 12


def test_pages_without_an_article_are_empty():
    for page in (
        "<nav><a>Home</a> About</nav><footer>Copyright 2020 Foo</footer>",
        "<body><div class=comments><article class=comment>first!</article><p>nice</p></div></body>",
        "<body><div class='cookie-banner'>We use cookies. Accept them please, all of them.</div></body>",
        "<body><div id=newsletter-popup>Subscribe to our letter</div><aside>More</aside></body>",
        "<form><label>Your name</label><input name=n><label>Your mail</label><input><button>Send</button></form>",
    ):
        assert html_density.extract(page) == "", page


def test_a_form_around_the_page_is_no_form():
    page = f"<body><form action=/x><input type=hidden><div class=text><p>{LONG}</p></div><aside>Look here</aside><footer>Foot</footer></form></body>"
    assert html_density.extract(page) == LONG.strip()
    beside = f"<body><div class=text><p>{LONG}</p></div><form><label>Search here</label><input></form></body>"
    assert html_density.extract(beside) == LONG.strip()


def test_headings_before_the_text_belong_to_it():
    page = f"<body><nav>Home</nav><h1>Title</h1><h2>Subtitle</h2><div class=text><p>{LONG}</p><p>{LONG}</p></div></body>"
    assert html_density.extract(page) == f"Title Subtitle {LONG}{LONG}".strip()
    wrapped = f"<body><div><h1>Title</h1><div><div class=text><p>{LONG}</p><p>{LONG}</p></div></div></div><div><h2>Elsewhere</h2><ul><li>x</li></ul></div></body>"
    assert html_density.extract(wrapped) == f"Title {LONG}{LONG}".strip()


def test_densities_equal_plain_recursion():
    """Composite density and sums of every node, computed for each subtree on its own."""
    page = f"<body><h1>T</h1><div><a href=x>link <b>text</b></a> and words</div><div><p>{LONG}</p><ul><li><a>one</a><li>two</ul></div></body>"
    tree = html_density.Tree(page)
    children = {i: [j for j in range(len(tree.tag)) if tree.parent[j] == i] for i in range(len(tree.tag))}

    def linked(i):
        return i > 0 and (tree.tag[i] == "a" or linked(tree.parent[i]))

    def count(i):
        own = sum(len("".join(p.split())) for n, p in tree.pieces if n == i and p is not html_density.BREAK)
        c, lc, t, lt = own, own if linked(i) else 0, 1, int(linked(i))
        for j in children[i]:
            c, lc, t, lt = (x + y for x, y in zip((c, lc, t, lt), count(j), strict=True))
        return c, lc, t, lt

    whole = count(0)
    density, total = html_density.densities(tree)

    def plain(i):
        c, lc, t, lt = count(i)
        if not c:
            return 0.0
        base = math.log(c / max(c - lc, 1) * lc + whole[1] / max(whole[0], 1) * c + math.e)
        ratio = max(c / max(lc, 1) * t / max(lt, 1), 1.0)
        return c / t * math.log(ratio) / math.log(max(base, 1 + 1e-9))

    for i in range(len(tree.tag)):
        assert density[i] == pytest.approx(plain(i))
        assert total[i] == pytest.approx(sum(plain(j) for j in children[i]))
