import hashlib
import random

import numpy as np
import pytest

from holdfast.llm import winnowing as w

FIELDS = ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"]


def kept(text):
    return [(i, c.lower() if "A" <= c <= "Z" else c) for i, c in enumerate(text) if c not in " \t\n\x0b\x0c\r"]


def plain(text, gram=w.GRAM, window=w.WINDOW):
    """Runs chosen by looking at each window, with one hash per run: (position, run) pairs."""
    chars = kept(text)
    if not chars:
        return []
    gram = min(gram, len(chars))
    runs = ["".join(c for _, c in chars[i : i + gram]) for i in range(len(chars) - gram + 1)]
    value = [int(w.rolling(np.array([ord(c) for c in r], np.uint32), gram)[0]) for r in runs]
    window = min(window, len(runs))
    chosen = set()
    for i in range(len(runs) - window + 1):
        least = min(value[i : i + window])
        chosen.add(max(j for j in range(i, i + window) if value[j] == least))
    return [(chars[j][0], j, value[j]) for j in sorted(chosen)]


def jaccard(a, b):
    a, b = {h for *_, h in a}, {h for *_, h in b}
    return len(a & b) / len(a | b) if a | b else 1.0


def brute(rows):
    """rows: (doc_id, text) in any order, ids unique or null"""
    rows = sorted(rows, key=lambda r: (r[0] is None, r[0] or 0))
    out = []
    for i, (d, t) in enumerate(rows):
        t, after = t or "", rows[(i + 1) % len(rows)][1] or ""
        m = len(t) // 4
        new = t[: len(t) - m] + after[:m]
        own, changed = plain(t), plain(new)
        sha = hashlib.sha256(new.encode()).hexdigest()
        out.append((d, len(t), sha, own, changed, jaccard(own, changed), jaccard(own, plain(after))))
    return out


TEXTS = [
    "", None, "   \n", "a", "Ab c", "the quick brown fox jumps over the lazy dog " * 3, "aaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaa",
    "Ünïcödé 漢字 and 🙂 emoji, several words of it to make windows and runs of them", "x" * 4000 + " tail " + "yz" * 900,
]


@pytest.mark.parametrize("text", TEXTS)
def test_winnow_equals_looking_at_each_window(text):
    places, positions, hashes = w.winnow(text or "")
    expected = plain(text or "")
    assert list(zip(positions.tolist(), places.tolist(), hashes.tolist(), strict=True)) == expected
    back = w.decoded(w.encoded(places, hashes))
    assert (back[0] == places).all() and (back[1] == hashes).all()


def test_every_long_enough_shared_run_is_found():
    rng = random.Random(4)
    need = w.GRAM + w.WINDOW - 1
    for _ in range(60):
        shared = "".join(rng.choices("abcdefgh", k=need))
        left, right = ("".join(rng.choices("ijklmnop", k=rng.randint(0, 90))) for _ in range(2))
        a, b = left + shared.upper() + right, right + " ".join(shared) + left
        found = set(w.winnow(a)[2].tolist()) & set(w.winnow(b)[2].tolist())
        inside = [p for _, p, h in zip(*w.winnow(a), strict=True) if h in found and len(left) <= p < len(left) + need]
        assert inside


def test_short_shared_runs_do_not_count():
    a, b = "abcdefghijk" + "1" * 40, "2" * 40 + "abcdefghijk"
    assert w.likeness(w.winnow(a)[2], w.winnow(b)[2]) == 0.0


def table(spark, rows, parts=3):
    df = spark.createDataFrame([(d, t, 1, "x") for d, t in rows], "doc_id bigint, text string, part int, guest string")
    return df.repartition(parts)


def shown(rows):
    return sorted(((r[0] is None, r[0] or 0, *r[1:]) for r in rows), key=lambda r: r[:2])


def test_query_equals_brute_force(spark):
    rng = random.Random(7)
    words = [*"alpha beta gamma delta epsilon zeta eta theta iota kappa".split(), "É", "漢"]
    rows = [(i * 3 - 40, " ".join(rng.choices(words, k=rng.randint(0, 60)))) for i in range(80)]
    rows += [(1000 + i, t) for i, t in enumerate(TEXTS)] + [(None, "without id, some words that are here")]
    got = [tuple(r[f] for f in FIELDS) for r in w.fingerprint_query(table(spark, rows)).collect()]
    want = [
        (*r[:3], w.encoded(*(np.array([x[i] for x in r[3]], np.uint64) for i in (1, 2))),
         w.encoded(*(np.array([x[i] for x in r[4]], np.uint64) for i in (1, 2))), *r[5:])
        for r in brute(rows)
    ]
    assert shown(got) == shown(want)


def test_single_row_follows_itself_and_empty_table_is_empty(spark):
    text = "one row alone with a text that is long enough for windows"
    (row,) = w.fingerprint_query(table(spark, [(5, text)])).collect()
    assert row["near_next"] == 1.0 and row["n_chars"] == len(text)
    m = len(text) // 4
    assert row["edited_sha256"] == hashlib.sha256((text[: len(text) - m] + text[:m]).encode()).hexdigest()
    assert w.fingerprint_query(table(spark, [(5, text)]).limit(0)).collect() == []


def test_repeated_rows_and_ids(spark):
    rows = [(1, "first text of some length, repeated as it is")] * 40 + [(1, "another text of the same id")] * 3 + [(None, None)] * 30
    got = w.fingerprint_query(table(spark, rows, 5)).collect()
    assert len(got) == len(rows)
    by_text = {}
    for r in got:
        by_text.setdefault((r["doc_id"], r["n_chars"]), set()).add(r["fingerprint"])
    assert all(len(f) == 1 for f in by_text.values())
    # all but the last copy are followed by a copy
    assert sum(r["near_next"] == 1.0 for r in got) >= 39 + 2 + 29


def test_lists_hold_positions_in_the_text(spark):
    text = "Some  words\n apart, and MORE of them so that several windows fit"
    (row,) = w.fingerprints(table(spark, [(1, text)])).collect()
    assert [(p, h) for p, _, h in plain(text)] == list(zip(row["positions"], row["hashes"], strict=True))
