"""Token counts by rank-synchronous merging of arrays.

Texts are cut into pre-tokens at the places no piece of the vocabulary can span: before
space marks, and between two characters that stand side by side in no piece. All pre-tokens
that a batch brings for the first time are held as one ragged numpy array of symbols; every
round merges, in all of them at once, the pair of the lowest rank of each sequence, at all
its places that do not overlap, from the left. A place whose merge makes a pair of a rank
as low ends the round of its sequence, so the order is that of merging one by one. What
survives is counted: a piece is one token, a character outside the vocabulary as many as it
has bytes.

Null texts count as empty, an empty text has no tokens, an empty table gives an empty
result. Special strings inside a text are plain text. Whole texts are counted, runs without
spaces of any length included: such a run takes as many rounds as it has different ranks.
Equal ranks merge from the left. Repeated rows, and rows without id, are counted each on
their own. Other columns pass through, but for the three that are added.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from holdfast.llm.common import map_arrow, text_of, utf8

#: pre-tokens whose counts a task remembers; then it starts anew
REMEMBERED = 400_000
NONE = np.iinfo(np.int64).max

#: a pre-token: one or more space marks and what follows; no piece has a mark after another character
PRETOKEN = re.compile("[ ▁]+[^ ▁]*|[^ ▁]+")
#: texts that a model without normalisation leaves as they are
PROBES = ("a", " a", "a  b ", "\ta\n\nb\r", "\ufb01 \uff21 \u2460 \u3000x", "e\u0301 \u00e9", "\u200b\ufeffA\u00ad")


class Merges:
    """The merge table of a byte-fallback piece model."""

    def __init__(self, model_file: str):
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=model_file)
        special = (model.is_control, model.is_unknown, model.is_byte, model.is_unused)
        scores = {
            model.id_to_piece(i): model.get_score(i)
            for i in range(model.get_piece_size())
            if not any(f(i) for f in special)
        }
        if any("▁" in p.lstrip("▁") for p in scores):
            raise ValueError("pieces that span a space are not supported")
        if any(c not in scores for p in scores for c in p):
            raise ValueError("pieces with characters that are no pieces themselves are not supported")
        for probe in PROBES:
            if _surface(model, probe) != mark(probe).encode():
                raise ValueError(f"models that change their input are not supported: {probe!r}")
        self.ids = {p: i for i, p in enumerate(scores)}
        self.size = len(self.ids)
        order = {s: r for r, s in enumerate(sorted(set(scores.values()), reverse=True))}
        table = sorted(
            (self.ids[p[:k]] * self.size + self.ids[p[k:]], self.ids[p], order[score])
            for p, score in scores.items()
            for k in range(1, len(p))
            if p[:k] in self.ids and p[k:] in self.ids
        )
        self.keys, self.merged, self.ranks = (np.array(x, np.int64) for x in zip(*table, strict=True))
        beside = {self.ids[x] * self.size + self.ids[y] for p in scores for x, y in zip(p, p[1:])}
        self.beside = np.array(sorted(beside), np.int64)

    def joined(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Whether some piece has both characters side by side."""
        key = left * self.size + right
        at = np.minimum(np.searchsorted(self.beside, key), len(self.beside) - 1)
        return (self.beside[at] == key) & (left < self.size) & (right < self.size)

    def look_up(self, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Rank (``NONE`` if no merge) and merged symbol of each pair."""
        key = left * self.size + right
        at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        hit = (self.keys[at] == key) & (left < self.size) & (right < self.size)
        return np.where(hit, self.ranks[at], NONE), self.merged[at]


def mark(text: str) -> str:
    """A text as the model sees it: spaces as marks, one of them in front."""
    return "▁" + text.replace(" ", "▁")


def _surface(model, text: str) -> bytes:
    """What the tokens of a text spell, bytes of the fallback included."""
    out = b""
    for i in model.encode(text):
        piece = model.id_to_piece(i)
        out += bytes([int(piece[3:-1], 16)]) if model.is_byte(i) else piece.encode()
    return out


@lru_cache(maxsize=4)
def merges(model_file: str) -> Merges:
    return Merges(model_file)


def _apart(hits: np.ndarray) -> np.ndarray:
    """Every other place of each run of consecutive places, from the left: pairs that do not overlap."""
    first = np.flatnonzero(np.diff(hits, prepend=-2) != 1)
    start = np.repeat(hits[first], np.diff(np.append(first, len(hits))))
    return hits[(hits - start) % 2 == 0]


def _until_lower(
    table: Merges, symbol: np.ndarray, owner: np.ndarray, hits: np.ndarray, rank: np.ndarray, merged: np.ndarray
) -> np.ndarray:
    """The places of each sequence up to the first whose merge makes a pair of a rank as low."""
    new, last = merged[hits], len(symbol) - 1
    # the neighbour on the left is merged by then, the one on the right is not
    left = symbol[np.maximum(hits - 1, 0)]
    chained = np.flatnonzero(np.diff(hits) == 2) + 1
    left[chained] = new[chained - 1]
    right = symbol[np.minimum(hits + 2, last)]
    has_left = (hits > 0) & (owner[np.maximum(hits - 1, 0)] == owner[hits])
    has_right = (hits + 2 <= last) & (owner[np.minimum(hits + 2, last)] == owner[hits])
    lower = (has_left & (table.look_up(left, new)[0] <= rank[hits])) | (
        has_right & (table.look_up(new, right)[0] <= rank[hits])
    )
    before = np.cumsum(lower) - lower
    first = np.flatnonzero(np.diff(owner[hits], prepend=-1))
    return hits[before == np.repeat(before[first], np.diff(np.append(first, len(hits))))]


def count_pretokens(table: Merges, tokens: list[str]) -> np.ndarray:
    """Tokens of each pre-token (spaces already written as marks)."""
    out = np.zeros(len(tokens), np.int64)
    chars = "".join(tokens)
    if not chars:
        return out
    # a character outside the vocabulary gets a symbol of its own, past the table
    code = {c: table.ids.get(c, table.size + len(c.encode())) for c in set(chars)}
    symbol = np.fromiter((code[c] for c in chars), np.int64, len(chars))
    token = np.repeat(np.arange(len(tokens)), [len(t) for t in tokens])
    starts = np.ones(len(symbol), bool)
    starts[1:] = (token[1:] != token[:-1]) | ~table.joined(symbol[:-1], symbol[1:])
    of = token[starts]  # the pre-token of each sequence
    owner = np.cumsum(starts) - 1
    rank, merged = np.full(len(symbol), NONE), np.zeros(len(symbol), np.int64)
    changed = np.flatnonzero(owner[:-1] == owner[1:])
    while len(symbol):
        rank[changed], merged[changed] = table.look_up(symbol[changed], symbol[changed + 1])
        first = np.flatnonzero(np.diff(owner, prepend=-1))
        length = np.diff(np.append(first, len(owner)))
        lowest = np.minimum.reduceat(rank, first)
        over = lowest == NONE
        if over.any():
            done = np.repeat(over, length)
            # a character outside the vocabulary falls back to its bytes
            worth = np.maximum(symbol - table.size, 1)
            np.add.at(out, of[owner[first[over]]], np.add.reduceat(worth, first)[over])
            symbol, owner, rank, merged = (x[~done] for x in (symbol, owner, rank, merged))
            lowest, length = lowest[~over], length[~over]
            if not len(symbol):
                break
        hits = _apart(np.flatnonzero(rank == np.repeat(lowest, length)))
        hits = _until_lower(table, symbol, owner, hits, rank, merged)
        symbol[hits] = merged[hits]
        keep = np.ones(len(symbol), bool)
        keep[hits + 1] = False
        rank[hits] = NONE
        symbol, owner, rank, merged = (x[keep] for x in (symbol, owner, rank, merged))
        at = hits - np.arange(len(hits))  # where the merged symbols stand now
        before = at[(at > 0)] - 1
        before = before[owner[before] == owner[before + 1]]
        behind = at[at + 1 < len(symbol)]
        behind = behind[owner[behind] == owner[behind + 1]]
        changed = np.concatenate([before, behind])
    return out


def count_texts(table: Merges, texts: list[str], seen: dict[str, int]) -> np.ndarray:
    """Tokens of each text; ``seen`` holds the counts of pre-tokens met before."""
    out = np.zeros(len(texts), np.int64)
    if len(seen) > REMEMBERED:
        seen.clear()
    parts = [PRETOKEN.findall(mark(t)) if t else [] for t in texts]
    new = [p for p in set().union(*parts) if p not in seen]
    if new:
        seen.update(zip(new, count_pretokens(table, new).tolist(), strict=True))
    for i, p in enumerate(parts):
        out[i] = sum(map(seen.__getitem__, p))
    return out


def token_counts(docs: DataFrame, model_file: str, limit: int = 4096) -> DataFrame:
    """``docs`` plus ``n_bytes``, ``n_tokens`` and ``over_limit``; one narrow pass, no shuffle."""
    docs = docs.drop("n_bytes", "n_tokens", "over_limit")
    schema = T.StructType(
        [
            *docs.schema.fields,
            T.StructField("n_bytes", T.LongType()),
            T.StructField("n_tokens", T.LongType()),
            T.StructField("over_limit", T.BooleanType()),
        ]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table, seen = merges(model_file), {}
        for batch in batches:
            text = batch.column("text")
            size = np.diff(utf8(text)[0])
            n = count_texts(table, [t or "" for t in text.to_pylist()], seen)
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(size), pa.array(n), pa.array(n > limit)],
                names=[*batch.schema.names, "n_bytes", "n_tokens", "over_limit"],
            )

    return map_arrow(docs, run, schema)


def token_query(docs: DataFrame, model_file: str) -> DataFrame:
    slim = docs.select("doc_id", text_of("text").alias("text"))
    return token_counts(slim, model_file).select("doc_id", "n_bytes", "n_tokens", "over_limit")
