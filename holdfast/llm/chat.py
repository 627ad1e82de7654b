"""Chat formatting by columnar byte assembly, and reading it back.

Every turn becomes ``<s>[INST] role [/INST]text</s>``. Control strings inside roles and
texts get a backslash behind their first character, one that already has backslashes
there gets one more, so the escape is reversible and no text can end or open a turn. The
bytes of a batch are laid out in numpy: segment lengths, their cumulative offsets, and
scatter indices that copy all headers, roles and texts into one preallocated buffer, which
becomes the Arrow column.

Turns are dealt by ranges of (conversation, turn), so a conversation with a third of all
rows lies in many partitions. A conversation is one row if it lies inside one batch, else
one row for each part, in the order of (``part``, ``seq``). Digests of whole rows are taken
in place; only the parts of the others meet by conversation, as large pieces that are
hashed as they stream by.

Null texts and roles count as empty. Turns are ordered by turn (null first), then role and
text, so ties and repeated rows have a defined place; repeated rows stay. Rows without a
conversation id form one conversation. An empty table gives an empty result; columns other
than the four are ignored.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from holdfast.llm.common import map_arrow, spans, stored, text_of, utf8

OPEN, MIDDLE, CLOSE = b"<s>[INST] ", b" [/INST]", b"</s>"
CONTROL = r"([<\[])(\\*)(/?s>|/?INST\])"
ESCAPED = re.compile(r"([<\[])\\(\\*)(/?s>|/?INST\])")
TURN = re.compile(r"<s>\[INST\] (.*?) \[/INST\](.*?)</s>", re.DOTALL)

FORMATTED = (
    "conv_id bigint, part int, seq int, whole boolean, n_turns bigint, formatted binary, "
    "loss array<struct<start:int,length:int>>"
)
PIECES = (
    "conv_id bigint, part int, seq int, whole boolean, n_turns bigint, loss_chars bigint, "
    "formatted_chars bigint, turns binary, loss binary"
)


def assemble(roles: pa.Array, texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The formatted bytes of all turns, the end of each turn there, and where its text lies."""
    escaped = [pc.replace_substring_regex(pc.fill_null(c, ""), CONTROL, r"\1\\\2\3") for c in (roles, texts)]
    (role_ends, role_bytes), (text_ends, text_bytes) = map(utf8, escaped)
    n = len(roles)
    fixed = [np.frombuffer(x, np.uint8) for x in (OPEN, MIDDLE, CLOSE)]
    lengths = np.empty((n, 5), np.int64)
    lengths[:, 0], lengths[:, 2], lengths[:, 4] = (len(x) for x in fixed)
    lengths[:, 1], lengths[:, 3] = np.diff(role_ends), np.diff(text_ends)
    at = (np.cumsum(lengths) - lengths.ravel()).reshape(n, 5)
    out = np.empty(int(lengths.sum()), np.uint8)
    for column, segment in zip((0, 2, 4), fixed, strict=True):
        out[at[:, column, None] + np.arange(len(segment))] = segment
    out[spans(at[:, 1], lengths[:, 1])] = role_bytes
    out[spans(at[:, 3], lengths[:, 3])] = text_bytes
    return out, at[:, 4] + len(CLOSE), np.stack([at[:, 3], lengths[:, 3]])


def format_turns(turns: DataFrame) -> DataFrame:
    """Formatted conversations, with the byte spans of the assistant texts as loss mask."""
    count = int(turns.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    keys = [F.col("conv_id").asc_nulls_first(), F.col("turn").asc_nulls_first()]
    dealt = (
        turns.select("conv_id", "turn", text_of("role").alias("role"), text_of("text").alias("text"))
        .repartitionByRange(count, *keys)
        .sortWithinPartitions(*keys, "role", "text")
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        context = TaskContext.get()
        part, seq = context.partitionId() if context else 0, 0
        for batch in batches:
            if not batch.num_rows:
                continue
            out, ends, text = assemble(batch.column("role"), batch.column("text"))
            ids = batch.column("conv_id")
            key, null = ids.fill_null(0).to_numpy(), ids.is_null().to_numpy(zero_copy_only=False)
            first = np.flatnonzero(np.append(True, (key[1:] != key[:-1]) | (null[1:] != null[:-1])))
            after = np.append(first[1:], len(key))
            bounds = np.append(0, ends)[np.append(first, len(key))]
            column = pa.Array.from_buffers(
                pa.binary(), len(first), [None, pa.py_buffer(bounds.astype(np.int32)), pa.py_buffer(out)]
            )
            assistant = np.flatnonzero(pc.equal(batch.column("role"), "assistant").to_numpy(zero_copy_only=False))
            owner = np.searchsorted(after, assistant, side="right")
            loss = pa.ListArray.from_arrays(
                pa.array(np.searchsorted(owner, np.arange(len(first) + 1)).astype(np.int32)),
                pa.StructArray.from_arrays(
                    [
                        pa.array((text[0, assistant] - bounds[owner]).astype(np.int32)),
                        pa.array(text[1, assistant].astype(np.int32)),
                    ],
                    names=["start", "length"],
                ),
            )
            whole = np.ones(len(first), bool)
            whole[[0, -1]] = False  # may go on in the batch or partition before or behind
            yield pa.RecordBatch.from_arrays(
                [
                    ids.take(pa.array(first)),
                    pa.array(np.full(len(first), part, np.int32)),
                    pa.array(np.arange(seq, seq + len(first), dtype=np.int32)),
                    pa.array(whole),
                    pa.array((after - first).astype(np.int64)),
                    column,
                    loss,
                ],
                names=["conv_id", "part", "seq", "whole", "n_turns", "formatted", "loss"],
            )
            seq += len(first)

    return map_arrow(dealt, run, FORMATTED)


def unescape(text: str) -> str:
    return ESCAPED.sub(r"\1\2\3", text)


def parse(formatted: str) -> list[tuple[str, str]]:
    """Roles and texts of a formatted conversation; raises if anything lies between turns."""
    turns, at = [], 0
    for m in TURN.finditer(formatted):
        if m.start() != at:
            break
        turns.append((unescape(m[1]), unescape(m[2])))
        at = m.end()
    if at != len(formatted):
        raise ValueError(f"no turn at character {at}")
    return turns


def read_back(formatted: DataFrame) -> DataFrame:
    """Turn counts and turn and loss digests of each conversation, read from the formatted bytes alone.

    Pieces of a conversation are whole turns, so their counts add up.
    """
    conf = formatted.sparkSession.conf
    count = int(conf.get("spark.sql.shuffle.partitions"))

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for r in batch.to_pylist():
                raw = r["formatted"]
                text = raw.decode()
                parsed = parse(text)
                turns = "".join(f"{role}\n{said}\n" for role, said in parsed).encode()
                loss = "".join(
                    unescape(raw[s["start"] : s["start"] + s["length"]].decode()) for s in r["loss"]
                )
                own, learned = turns, loss.encode()
                if r["whole"]:
                    own, learned = hashlib.sha256(own).digest(), hashlib.sha256(learned).digest()
                rows.append(
                    (r["conv_id"], r["part"], r["seq"], r["whole"], len(parsed), len(loss), len(text), own, learned)
                )
            yield _batch(rows)

    def finish(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now: list | None = None
        for batch in batches:
            rows = []
            for r in batch.to_pylist():
                if now is None or now[0] != r["conv_id"]:
                    if now is not None:
                        rows.append(_closed(now))
                    now = [r["conv_id"], 0, 0, 0, hashlib.sha256(), hashlib.sha256()]
                for k, name in enumerate(("n_turns", "loss_chars", "formatted_chars")):
                    now[1 + k] += r[name]
                now[4].update(r["turns"])
                now[5].update(r["loss"])
            if rows:
                yield _batch(rows)
        if now is not None:
            yield _batch([_closed(now)])

    # both branches read the digests and the few open pieces, not the texts again
    scanned = stored(map_arrow(formatted, scan, PIECES), "chat-pieces")
    open_parts = (
        scanned.where(~F.col("whole"))
        .repartition(count, "conv_id")
        .sortWithinPartitions("conv_id", "part", "seq")
    )
    closed = scanned.where("whole").unionByName(map_arrow(open_parts, finish, PIECES))
    return closed.select(
        "conv_id",
        "n_turns",
        F.lower(F.hex("turns")).alias("turns_sha256"),
        "loss_chars",
        F.lower(F.hex("loss")).alias("loss_sha256"),
        "formatted_chars",
    )


def _closed(now: list) -> tuple:
    return (now[0], 0, 0, True, *now[1:4], now[4].digest(), now[5].digest())


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    kinds = [pa.int64(), pa.int32(), pa.int32(), pa.bool_(), pa.int64(), pa.int64(), pa.int64(), pa.binary(), pa.binary()]
    columns = zip(*rows, strict=True) if rows else [[] for _ in kinds]
    return pa.RecordBatch.from_arrays(
        [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)],
        names=["conv_id", "part", "seq", "whole", "n_turns", "loss_chars", "formatted_chars", "turns", "loss"],
    )


def chat_query(conversations: DataFrame) -> DataFrame:
    said = "</s>[INST] ok [/INST]"
    probe = conversations.sparkSession.createDataFrame(
        [(-7, 0, "user", said), (-7, 1, "assistant", said)], "conv_id bigint, turn bigint, role string, text string"
    )
    turns = conversations.select("conv_id", "turn", "role", "text").unionByName(probe)
    return read_back(format_turns(turns))
