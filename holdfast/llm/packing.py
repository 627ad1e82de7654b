"""Hierarchical multi-length packing of token sequences.

Each document (its token ids and one end id) is routed to the shortest context size that
holds it; what exceeds the longest size is cut into full windows first. Every size is packed
best-fit-decreasing, from the longest down. Gaps of a window are filled with whole documents
of shorter sizes, the rest of the gap with a piece cut from one. Windows leave only when
they are exactly full, so none needs padding; what remains at the end of a task goes into
windows of descending powers of two. Windows of one size form step groups of equal tokens.

The work is one narrow pass: a task packs its own rows in blocks of bounded size, so memory
does not depend on the input, and a lost task packs the same rows again to the same result.

Null texts count as empty; an empty text is one end id. Repeated rows are packed each.
Null ids stay null. Columns other than ``doc_id`` and ``text`` are ignored.
"""

from __future__ import annotations

import os
import re
from bisect import bisect_left, bisect_right, insort
from collections.abc import Iterator
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from holdfast.llm.common import map_arrow, spans, text_of

TIERS = (512, 1024, 2048, 4096)
#: tokens that a task gathers before it packs them
BLOCK_TOKENS = 1 << 19
#: tokens of a full step group
GROUP_TOKENS = 8 * 4096
#: words whose ids a task remembers; then it starts anew
REMEMBERED = 500_000
CHUNK = re.compile(r"[^ \t\n\r]+")
#: Latin text without special strings, where lower case, normal form and the classes of
#: letters, numbers and white space are plain; its pre-tokens can be told here
NOT_PLAIN = re.compile("[^\t\n\r\x20-\x7e\xa1-\u012f\u0131-\u017f]")
_LETTERS = "a-z\xaa\xb5\xba\xc0-\xd6\xd8-\xf6\xf8-\u017f"
_NUMBERS = "0-9\xb2\xb3\xb9\xbc-\xbe"
PRETOKEN = re.compile(f"'(?:s|t|re|ve|m|ll|d)|[{_LETTERS}]+|[{_NUMBERS}]|[^ \t\n\r{_LETTERS}{_NUMBERS}]+")
#: a part that is surely one pre-token and no special string
SINGLE = re.compile("[a-z\xe0-\xf6\xf8-\xff]+|[0-9]|[!-&(-/:-@\\[-`{-~]+")


def parts_of(text: str) -> list[str]:
    """Parts of a text that can be encoded one by one: pre-tokens of plain text, else words."""
    if "<|" in text or NOT_PLAIN.search(text):
        return CHUNK.findall(text)
    return PRETOKEN.findall(text.lower())


SCHEMA = (
    "doc_id bigint, start bigint, length bigint, ids binary, doc_tokens bigint, "
    "sequence_id bigint, offset bigint, context int, step_group bigint"
)


@lru_cache(maxsize=2)
def _tokenizer(path: str):
    os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
    from tokenizers import Tokenizer

    return Tokenizer.from_file(path)


class WordIds:
    """Token ids of texts for a tokenizer that drops white space: each part is encoded once."""

    def __init__(self, path: str):
        self.tokenizer = _tokenizer(path)
        vocabulary = self.tokenizer.get_vocab()
        self.last = np.zeros(max(vocabulary.values()) + 1, bool)
        self.last[[i for t, i in vocabulary.items() if t.endswith("</w>")]] = True
        self._forget()

    def _forget(self) -> None:
        self.index: dict[str, int] = {}
        self.flat, self.starts, self.lengths = np.zeros(0, np.uint32), np.zeros(0, np.int64), np.zeros(0, np.int64)

    def _encode_new(self, parts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all parts and how many each has. Parts of one pre-token are encoded many at
        a time: the ids that end a word show where each of them ends."""
        single = [SINGLE.fullmatch(p) is not None for p in parts]
        alone = [p for p, one in zip(parts, single, strict=True) if one]
        joined = [" ".join(alone[at : at + 500]) for at in range(0, len(alone), 500)]
        other = [p for p, one in zip(parts, single, strict=True) if not one]
        ids = [e.ids for e in self.tokenizer.encode_batch_fast(joined + other, add_special_tokens=False)]
        first = np.fromiter(chain.from_iterable(ids[: len(joined)]), np.uint32)
        ends = np.flatnonzero(self.last[first]) + 1
        sizes = np.zeros(len(parts), np.int64)
        flags = np.array(single)
        sizes[flags] = np.diff(ends, prepend=0)
        sizes[~flags] = [len(x) for x in ids[len(joined) :]]
        rest = np.fromiter(chain.from_iterable(ids[len(joined) :]), np.uint32)
        both = np.concatenate([first, rest])
        begin = np.zeros(len(parts), np.int64)
        begin[flags] = ends - sizes[flags]
        begin[~flags] = len(first) + np.cumsum(sizes[~flags]) - sizes[~flags]
        return both[spans(begin, sizes)], sizes

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts one behind the other, and how many each has."""
        words = [parts_of(t) for t in texts]
        if len(self.index) > REMEMBERED:
            self._forget()
        index = self.index
        new = sorted(w for w in set().union(*words) if w not in index)
        if new:
            flat, size = self._encode_new(new)
            self.starts = np.concatenate([self.starts, len(self.flat) + np.cumsum(size) - size])
            self.lengths = np.concatenate([self.lengths, size])
            self.flat = np.concatenate([self.flat, flat])
            at = len(self.index)
            self.index.update((w, at + i) for i, w in enumerate(new))
        count = np.array([len(w) for w in words], np.int64)
        which = np.fromiter(map(self.index.__getitem__, chain.from_iterable(words)), np.int64, int(count.sum()))
        lengths = self.lengths[which]
        ends = np.append(0, np.cumsum(lengths))[np.append(0, np.cumsum(count))]
        return self.flat[spans(self.starts[which], lengths)], np.diff(ends)


Piece = tuple[int, int, int]  # length, document, start


class Packer:
    """Packs pieces into full windows; ``take`` gathers, ``close`` empties everything."""

    def __init__(self, tiers: tuple[int, ...] = TIERS):
        self.tiers = tuple(sorted(tiers))
        self.longest = self.tiers[-1]
        self.pool: dict[int, list[Piece]] = {t: [] for t in self.tiers}  # each in ascending order
        self.held = 0
        self.windows: list[tuple[int, list[Piece]]] = []

    def _route(self, piece: Piece) -> None:
        insort(self.pool[self.tiers[bisect_left(self.tiers, piece[0])]], piece)

    def take(self, document: int, tokens: int) -> None:
        start = 0
        while tokens - start > self.longest:
            self.windows.append((self.longest, [(self.longest, document, start)]))
            start += self.longest
        self._route((tokens - start, document, start))
        self.held += tokens - start

    def pack(self) -> None:
        """Emit every window that can be filled from what is held."""
        for k in range(len(self.tiers) - 1, -1, -1):
            self._pack_tier(k)
        left = sum(p[0] for pool in self.pool.values() for p in pool)
        if left > BLOCK_TOKENS // 2:  # nothing short enough to fill their gaps: cut them
            rest = self._stream(self._drain(), only_full=True)
            for p in rest:
                self._route(p)
            left = sum(p[0] for p in rest)
        self.held = left

    def _pack_tier(self, k: int) -> None:
        size, shorter = self.tiers[k], self.tiers[:k][::-1]
        items, self.pool[size] = self.pool[size], []
        bins: list[list[Piece]] = []
        gaps: list[tuple[int, int]] = []
        for piece in reversed(items):
            at = bisect_left(gaps, (piece[0], -1))
            gap, b = gaps.pop(at) if at < len(gaps) else (size, len(bins))
            if b == len(bins):
                bins.append([])
            bins[b].append(piece)
            if gap > piece[0]:
                insort(gaps, (gap - piece[0], b))
        open_bins = {b for _, b in gaps}
        self.windows += [(size, pieces) for b, pieces in enumerate(bins) if b not in open_bins]
        stuck: list[Piece] = []
        for gap, b in gaps:  # the smallest gaps first
            gap = self._fill(bins[b], gap, shorter)
            if gap:
                stuck += bins[b]
            else:
                self.windows.append((size, bins[b]))
        if k == 0:
            stuck = self._stream(sorted(stuck), only_full=True, size=size)
        for piece in stuck:
            self._route(piece)

    def _fill(self, pieces: list[Piece], gap: int, shorter: tuple[int, ...]) -> int:
        for tier in shorter:
            pool = self.pool[tier]
            while gap and pool:
                at = bisect_right(pool, (gap, 1 << 62, 0)) - 1
                if at < 0:
                    break
                piece = pool.pop(at)
                pieces.append(piece)
                gap -= piece[0]
        for tier in shorter:
            pool = self.pool[tier]
            if gap and pool and pool[-1][0] > gap:
                length, document, start = pool.pop()
                pieces.append((gap, document, start))
                self._route((length - gap, document, start + gap))
                gap = 0
        return gap

    def _drain(self) -> list[Piece]:
        pieces = [p for pool in self.pool.values() for p in pool]
        self.pool = {t: [] for t in self.tiers}
        return sorted(pieces, key=lambda p: p[1:])

    def _stream(self, pieces: list[Piece], only_full: bool, size: int | None = None) -> list[Piece]:
        """Cut a row of pieces into windows; returns what does not fill one, or nothing."""
        total = sum(p[0] for p in pieces)
        queue = pieces[::-1]
        size = size or self.longest
        while total >= size or not only_full and total:
            room = size if total >= size else 1 << (total.bit_length() - 1)
            window, gap = [], room
            while gap:
                length, document, start = queue.pop()
                part = min(length, gap)
                window.append((part, document, start))
                gap -= part
                if part < length:
                    queue.append((length - part, document, start + part))
            self.windows.append((room, window))
            total -= room
        return queue[::-1]

    def close(self) -> None:
        self.pack()
        self._stream(self._drain(), only_full=False)
        self.held = 0


def pack(docs: DataFrame, tokenizer: str, end_id: int = 2, tiers: tuple[int, ...] = TIERS) -> DataFrame:
    """One row per piece: the document's ``start`` and ``length``, its ``ids`` as little-endian
    unsigned 32-bit numbers, the sequence and the offset there, and the sequence's size
    (``context``) and step group."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        context = TaskContext.get()
        base = (context.partitionId() if context else 0) << 33
        words, packer = WordIds(tokenizer), Packer(tiers)
        ids: dict[int, np.ndarray] = {}
        names: dict[int, int | None] = {}
        documents, sequences = 0, 0
        filled: dict[int, int] = {}

        def emit() -> Iterator[pa.RecordBatch]:
            nonlocal sequences
            windows, packer.windows = packer.windows, []
            rows = []
            for size, pieces in windows:
                n = filled[size] = filled.get(size, -1) + 1
                per = max(1, GROUP_TOKENS // size)
                group = base + (size.bit_length() << 27) + n // per
                offset = 0
                for length, document, start in pieces:
                    own = ids[document]
                    part = own[start : start + length].astype("<u4").tobytes()
                    rows.append((names[document], start, length, part, len(own), base + sequences, offset, size, group))
                    offset += length
                sequences += 1
            held = {p[1] for pool in packer.pool.values() for p in pool}
            for document in [d for d in ids if d not in held]:
                del ids[document], names[document]
            for at in range(0, len(rows), 4000):
                columns = list(zip(*rows[at : at + 4000], strict=True))
                kinds = [pa.int64(), pa.int64(), pa.int64(), pa.binary(), pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int64()]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)],
                    names=[f.split()[0] for f in SCHEMA.split(", ")],
                )

        for batch in batches:
            texts, keys = batch.column("text"), batch.column("doc_id").to_pylist()
            for at in range(0, batch.num_rows, 256):
                part = [t or "" for t in texts.slice(at, 256).to_pylist()]
                flat, count = words.encode(part)
                for i, own in enumerate(np.split(flat, np.cumsum(count)[:-1])):
                    ids[documents] = np.append(own, np.uint32(end_id))
                    names[documents] = keys[at + i]
                    packer.take(documents, len(ids[documents]))
                    documents += 1
                if packer.held >= BLOCK_TOKENS or len(packer.windows) > 200:
                    if packer.held >= BLOCK_TOKENS:
                        packer.pack()
                    yield from emit()
        packer.close()
        yield from emit()

    return map_arrow(docs.select("doc_id", text_of("text").alias("text")), run, SCHEMA)


def packing_query(docs: DataFrame, tokenizer: str) -> DataFrame:
    return pack(docs, tokenizer).select(
        "doc_id",
        "start",
        "length",
        F.crc32("ids").alias("ids_crc32"),
        "doc_tokens",
        "sequence_id",
        "offset",
        "context",
        "step_group",
    )
