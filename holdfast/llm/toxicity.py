"""Toxicity by a weighted finite-state pattern grammar.

Five transducers, each a table of states, are composed into one: harm (insults and threats),
targets, negations, words that report speech, and quotation marks. Insults are learned from
labelled texts, as whole words or as stems that many different words share; the other
classes are short fixed lists. Each transducer but the first has a part that reads from the
left and one that reads from the right, so what stands behind an insult counts like what
stands before it. An insult or threat emits its weight into the channel that the two states
around it select (plain, at a target, negated, reported). A text sums its channels, and
weights fitted to the labels (with fixed weights as prior, for channels the labels do not
show) turn the sums into one probability. Words alone never score: weakly marked (vague)
words go through the same channels with their smaller weight.

A target counts within its clause, a negation over three words of it (backwards not past a
comma), a word of report within its sentence, on both sides; after a colon it holds to the
end of the paragraph. A quotation holds over sentence ends up to its closing mark; a mark that
its paragraph never answers opens nothing. Paragraphs end at an empty line.

Null texts count as empty; a text without a matched clause gets the lowest score. Whole
texts are read. Rows with equal texts get equal scores, no other column is an input, and
other columns pass through (``score`` and ``predicted`` are replaced). One narrow pass.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field
from functools import cache
from itertools import product

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from holdfast.llm.common import fitted, held_out, labelled_sample, map_arrow, text_of

#: labelled texts of each class that the grammar is fitted to at the most
PER_CLASS = 2500
STEM_LENGTHS = range(4, 8)
#: toxic examples, and different words before it, that a word or stem needs to be tested at all
LEAST = 3
#: share of false discoveries among the words and stems that are taken for insults
FALSE_SHARE = 0.05
#: words whose class a task remembers; then it starts anew
REMEMBERED = 500_000
#: tokens that a negation reaches
REACH = 3

#: of lower-case text, for learning and reading alike: words without their clitics, the
#: negation of isn't or isn’t, paragraph ends, and single marks
TOKENS = re.compile(r"\w+|(?<=n)['’‘ʼ`´＇]t\b|\n[^\S\n]*\n\s*|[.!?;:,\n]|[\"“”«»„]")
QUOTES = frozenset('"“”«»„')

#: infinitives, present and future forms and participles of the present; forms of the past
#: tell what has happened and threaten nobody
THREATS = frozenset(
    "kill kills killing hurt hurts hurting destroy destroys destroying murder murders murdering shoot shoots shooting "
    "stab stabs stabbing strangle strangles strangling "
    "töten töte tötest tötet tötend umbringen umbringe umbringst umbringt umzubringen verletzen verletze verletzt "
    "verletzend vernichten vernichte vernichtest vernichtet vernichtend "
    "tuer tue tues tuons tuez tuent tuant tuerai tueras tuera tuerons tuerez tueront blesser blesse blesses blessons "
    "blessez blessent blessant blesserai blesseras blessera blesserons blesserez blesseront détruire détruis détruit "
    "détruisons détruisez détruisent détruisant détruirai détruiras détruira détruirons détruirez détruiront "
    "matar mato matas mata matamos matáis matan matando mataré matarás matará mataremos mataréis matarán herir hiero "
    "hieres hiere herimos herís hieren hiriendo heriré herirás herirá heriremos heriréis herirán destruir destruyo "
    "destruyes destruye destruimos destruís destruyen destruyendo destruiré destruirás destruirá destruiremos "
    "destruiréis destruirán".split()
)
TARGETS = frozenset(
    "you your u ya yourself them they he she him her people everyone du dich dir euch ihr sie tu te toi vous "
    "ils eux usted ustedes ti ellos".split()
)
NEGATIONS = frozenset("not never no cannot 't ’t ‘t ʼt `t ´t ＇t nicht kein keine nie pas jamais nunca tampoco".split())
REPORTS = frozenset(
    "said says called calls wrote writes quoted quotes reported claimed alleged sagte schrieb nannte dit écrit "
    "appelé dijo escribió llamó".split()
)

#: channels of the grammar, and the prior weight of each
CHANNELS = {"plain": 3.0, "targeted": 3.5, "negated": 1.0, "reported": 1.5, "threat": 4.0}
PRIOR_OFFSET = -3.0


#: symbols that the transducers read
INSULT, THREAT, TARGET, NEGATION, REPORT, WORD, QUOTE, COMMA, SEMICOLON, COLON, END, PARAGRAPH = range(12)
SYMBOLS = range(12)
HARM = (INSULT, THREAT)
WORDLIKE = frozenset({INSULT, THREAT, TARGET, NEGATION, REPORT, WORD})
MARKS = {",": COMMA, ";": SEMICOLON, ":": COLON, **dict.fromkeys(".!?\n", END), **dict.fromkeys(QUOTES, QUOTE)}

#: next state by state and symbol
Table = list[list[int]]


def transducer(states: int, step: Callable[[int, int], int]) -> Table:
    return [[step(state, symbol) for symbol in SYMBOLS] for state in range(states)]


def _flag(on: int, off: frozenset[int]) -> Table:
    """Set by one symbol, cleared by some."""
    return transducer(2, lambda s, x: 1 if x == on else 0 if x in off else s)


def _reach(off: frozenset[int]) -> Table:
    """Words that a negation still reaches."""

    def step(state: int, symbol: int) -> int:
        if symbol == NEGATION:
            return REACH
        return 0 if symbol in off else max(0, state - (symbol in WORDLIKE))

    return transducer(REACH + 1, step)


def _report(state: int, symbol: int) -> int:
    """0 nothing, 1 a report in this sentence, 2 what a colon after it introduces."""
    if symbol == PARAGRAPH:
        return 0
    if state == 2:
        return 2
    if symbol == REPORT:
        return 1
    return {COLON: 2, END: 0}.get(symbol, 1) if state else 0


CLAUSE = frozenset({SEMICOLON, COLON, END, PARAGRAPH})
#: target, negation, report, quotation: read from the left, and from the right
FROM_LEFT = (
    _flag(TARGET, CLAUSE),
    _reach(CLAUSE),
    transducer(3, _report),
    transducer(2, lambda s, x: 1 - s if x == QUOTE else 0 if x == PARAGRAPH else s),
)
FROM_RIGHT = (
    _flag(TARGET, CLAUSE),
    _reach(CLAUSE | {COMMA}),
    _flag(REPORT, CLAUSE),
    _flag(QUOTE, frozenset({PARAGRAPH})),
)


def compose(tables: tuple[Table, ...]) -> tuple[Table, list[tuple[int, ...]]]:
    """Product of transducers that read the same symbols: its table, and the states that each
    of its states stands for; state 0 is the start."""
    states = list(product(*(range(len(t)) for t in tables)))
    number = {s: i for i, s in enumerate(states)}
    return [[number[tuple(t[k][x] for t, k in zip(tables, s, strict=True))] for x in SYMBOLS] for s in states], states


def harm(symbol: int, left: tuple[int, ...], right: tuple[int, ...]) -> int:
    """Channel of an insult or threat between two states, -1 for none."""
    targeted, negated, reported = (bool(left[k] or right[k]) for k in range(3))
    quoted = left[3] and right[3]
    if negated:
        name = "negated"
    elif reported or quoted:
        name = "reported"
    elif symbol == THREAT:
        # a threat needs somebody it is aimed at
        name = "threat" if targeted else ""
    else:
        name = "targeted" if targeted else "plain"
    return list(CHANNELS).index(name) if name else -1


@cache
def composed() -> tuple[Table, Table, list[list[list[int]]]]:
    """Tables from the left and from the right, and the channel by left state, right state and symbol."""
    left, before = compose(FROM_LEFT)
    right, after = compose(FROM_RIGHT)
    return left, right, [[[harm(x, b, a) for x in HARM] for a in after] for b in before]


@dataclass
class Grammar:
    """Insult words and stems with weights: small for vague ones."""

    words: dict[str, tuple[str, float]] = field(default_factory=dict)
    stems: dict[str, tuple[str, float]] = field(default_factory=dict)
    weights: np.ndarray = field(default_factory=lambda: np.array(list(CHANNELS.values())))
    offset: float = PRIOR_OFFSET

    def entry(self, word: str) -> tuple[str, float] | None:
        """Class and weight of a lower-case word."""
        found = self.words.get(word)
        if found:
            return found
        for n in STEM_LENGTHS:
            if len(word) <= n:
                break
            found = self.stems.get(word[:n])
            if found:
                return found
        return ("threat", 1.0) if word in THREATS else None


def words_of(text: str) -> list[str]:
    """The words that the reader sees."""
    return [t for t in TOKENS.findall(text.lower()) if t[0].isalnum() or t[0] == "_"]


def _forms(word: str) -> list[str]:
    """A word and its stems (marked with a star); the fixed words are no insults."""
    if len(word) < 3 or word.isdigit() or word in NEGATIONS or word in REPORTS or word in TARGETS:
        return []
    return [word, *(word[:n] + "*" for n in STEM_LENGTHS if len(word) > n)]


def chance(a: int, b: int, share: float) -> float:
    """Bound (Chernoff) of the chance that at least ``a`` of ``a + b`` examples are toxic when
    ``share`` of all are."""
    n = a + b
    if a <= share * n:
        return 1.0
    more = a * math.log(a / (n * share))
    return math.exp(-(more + (b * math.log(b / (n * (1 - share))) if b else 0.0)))


def significant(chances: dict[str, float], false_share: float = FALSE_SHARE) -> set[str]:
    """Forms that stand out at the given share of false discoveries (Benjamini-Hochberg)."""
    order = sorted(chances, key=lambda f: (chances[f], f))
    last = max((i for i, f in enumerate(order, 1) if chances[f] <= false_share * i / len(order)), default=0)
    return set(order[:last])


def learn_lexicon(sample: list[tuple[str, int]]) -> Grammar:
    """Words and stems that toxic examples hold significantly and far more often than others."""
    grammar = Grammar()
    counts = Counter(y for _, y in sample)
    if not counts[0] or not counts[1]:
        return grammar
    held = Counter()
    for text, y in sample:
        if y:
            held.update({f for w in set(words_of(text)) for f in _forms(w)})
    held = {f: n for f, n in held.items() if n >= LEAST}
    # an insult stands in ever new surroundings; in copies of a text every word keeps its own
    places: dict[str, set[str]] = {f: set() for f in held}
    shown: dict[str, Counter] = {f: Counter() for f in held}
    clean = Counter()
    for text, y in sample:
        words = words_of(text)
        if y:
            for before, w in zip(["", *words], words, strict=False):
                for f in _forms(w):
                    if f in held:
                        places[f].add(before)
                        shown[f][w] += 1
        else:
            clean.update({f for w in set(words) for f in _forms(w) if f in held})
    toxic = {f: min(held[f], len(p)) for f, p in places.items() if len(p) >= LEAST}
    share_of_toxic = counts[1] / (counts[0] + counts[1])
    sure = significant({f: chance(a, clean[f], share_of_toxic) for f, a in toxic.items()})
    taken: list[str] = []
    for form in sorted(sure, key=lambda f: (not f.endswith("*"), len(f), f)):
        a, b = toxic[form], clean[form]
        share, usual = a / counts[1], (b + 0.5) / (counts[0] + 1)
        ratio = share / usual
        strong = ratio >= 12
        expected = usual * counts[1]
        if not strong and (ratio < 2 or (a - expected) / math.sqrt(expected) < 6):
            continue
        bare = form.rstrip("*")
        if any(bare.startswith(t) for t in taken):
            continue
        if form.endswith("*"):
            endings = shown[form]
            if len(endings) < 5 or 2 * max(endings.values()) > endings.total():
                continue  # mostly one word: learn that word
            taken.append(bare)
            into, key = grammar.stems, bare
        else:
            if not strong:
                continue
            into, key = grammar.words, form
        into[key] = ("insult" if strong else "vague", min(1.0, math.log(ratio) / 4))
    return grammar


def symbol(grammar: Grammar, token: str) -> tuple[int, float]:
    """Symbol of a lower-case token, and the weight of an insult or threat."""
    if token in MARKS:
        return MARKS[token], 0.0
    if token[0] == "\n":
        return PARAGRAPH, 0.0
    for kind, words in ((NEGATION, NEGATIONS), (REPORT, REPORTS), (TARGET, TARGETS)):
        if token in words:
            return kind, 0.0
    entry = grammar.entry(token)
    if entry is None:
        return WORD, 0.0
    return (THREAT if entry[0] == "threat" else INSULT), entry[1]


def read_symbols(read: list[tuple[int, float]]) -> np.ndarray:
    """Channel sums of a text given as symbols."""
    left, right, channel = composed()
    sums = [0.0] * len(CHANNELS)
    n = len(read)
    start = 0
    while start < n:
        # all states are back at the start where a paragraph ends
        end, hits = start, []
        while end < n and read[end][0] != PARAGRAPH:
            if read[end][0] <= THREAT:
                hits.append(end)
            end += 1
        if hits:
            behind, state = {}, 0
            for i in range(end - 1, hits[0] - 1, -1):
                x = read[i][0]
                if x <= THREAT:
                    behind[i] = state
                state = right[state][x]
            state = 0
            for i in range(start, hits[-1] + 1):
                x, weight = read[i]
                if x <= THREAT:
                    k = channel[state][behind[i]][x]
                    if k >= 0:
                        sums[k] += weight
                state = left[state][x]
        start = end + 1
    return np.log1p(4 * np.array(sums))


def read_clauses(grammar: Grammar, text: str) -> np.ndarray:
    """Channel sums of one text."""
    known: dict[str, tuple[int, float]] = {}
    tokens = TOKENS.findall(text.lower())
    for token in set(tokens):
        known[token] = symbol(grammar, token)
    return read_symbols([known[t] for t in tokens])


def fit(sample: list[tuple[str, int]], strength: float = 0.0005, rounds: int = 200) -> Grammar:
    """Learn the lexicon on one half of the sample and the channel weights on the other, so
    that the weights see words the way unseen texts show them; then learn the lexicon anew
    on everything. Without examples of both classes the prior stands."""
    halves = sample[0::2], sample[1::2]
    grammar = learn_lexicon(sample)
    rows, ys = [], []
    for learned, seen in (halves, halves[::-1]):
        part = learn_lexicon(learned)
        rows += [read_clauses(part, t) for t, _ in seen]
        ys += [y for _, y in seen]
    if len(set(ys)) < 2:
        return grammar
    x, y = np.array(rows), np.array(ys, float)
    x = np.hstack([x, np.ones((len(x), 1))])
    prior = np.array([*CHANNELS.values(), PRIOR_OFFSET])
    w = prior.copy()
    for _ in range(rounds):  # Newton steps on the penalised log loss, none longer than 1
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        gradient = x.T @ (p - y) / len(y) + strength * (w - prior)
        hessian = (x * (p * (1 - p))[:, None]).T @ x / len(y) + strength * np.eye(len(w))
        step = np.linalg.solve(hessian, gradient)
        step /= max(1.0, np.abs(step).max())
        w -= step
        if np.abs(step).max() < 1e-8:
            break
    grammar.weights, grammar.offset = w[:-1], float(w[-1])
    return grammar


def probability(grammar: Grammar, sums: np.ndarray) -> float:
    z = float(sums @ grammar.weights) + grammar.offset
    return 1 / (1 + math.exp(-max(-30.0, min(30.0, z))))


class Reader:
    """Scores texts; remembers the symbols of words."""

    def __init__(self, grammar: Grammar):
        self.grammar = grammar
        self.known: dict[str, tuple[int, float]] = {}
        self.idle = probability(grammar, np.zeros(len(CHANNELS)))

    def score(self, texts: list[str]) -> np.ndarray:
        if len(self.known) > REMEMBERED:
            self.known.clear()
        known = self.known
        out = np.full(len(texts), self.idle)
        for i, text in enumerate(texts):
            tokens = TOKENS.findall(text.lower())
            own = set(tokens)
            for token in own:
                if token not in known:
                    known[token] = symbol(self.grammar, token)
            if any(known[t][0] <= THREAT for t in own):
                out[i] = probability(self.grammar, read_symbols([known[t] for t in tokens]))
        return out


def train(docs: DataFrame, labels: DataFrame, label: str = "toxic", per_class: int = PER_CLASS) -> Grammar:
    """Fit on at most ``per_class`` labelled texts of each class that are not held out."""
    return fitted(labelled_sample(docs, labels, label, per_class), fit)


def score(docs: DataFrame, grammar: Grammar, threshold: float = 0.3) -> DataFrame:
    """All columns of ``docs`` plus ``score`` and ``predicted``."""
    docs = docs.drop("score", "predicted")
    schema = T.StructType(
        [*docs.schema.fields, T.StructField("score", T.DoubleType()), T.StructField("predicted", T.IntegerType())]
    )
    shared = docs.sparkSession.sparkContext.broadcast(grammar)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reader = Reader(shared.value)
        for batch in batches:
            p = reader.score([t or "" for t in batch.column("text").to_pylist()])
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(p), pa.array((p >= threshold).astype(np.int32))],
                names=[*batch.schema.names, "score", "predicted"],
            )

    return map_arrow(docs, run, schema)


def toxicity_query(docs: DataFrame, labels: DataFrame) -> DataFrame:
    grammar = train(docs, labels)
    slim = docs.select("doc_id", held_out().alias("held_out"), text_of("text").alias("text"))
    return score(slim, grammar).select("doc_id", "held_out", "score", "predicted")
