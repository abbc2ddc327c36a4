"""Chat formatting by columnar byte assembly.

A turn becomes  <|turn:ROLE|>TEXT</s>  and a conversation is its turns, one after the other, without anything between them. Control strings
(CONTROLS: the marks of this template and those of common others) are escaped inside texts and roles by a backslash after
their first character, and backslashes are doubled, so that no control string is left in them and the text can be read
back exactly. The loss mask covers the escaped text of each assistant turn, and nothing else.

A batch is assembled as columns: segment lengths (mark, role, mark, text, mark) form an array, their cumulative sums are the
offsets of the output, and scatter indices in numpy carry headers and contents into one preallocated buffer, which becomes the data
buffer of an Arrow column. Its offsets are those of turns, or of whole conversations: turns that lie together in order need no
further copy. There is no loop over turns. Indices are made for STRIDE bytes at a time, and a text without control strings
is not copied to be escaped, so besides the batch itself there are two copies of its bytes at most.

Scale. Turns are dealt by conversation and sorted by turn inside tasks (one shuffle). Conversations are written as rows of a Parquet table, their
bytes and the spans of the loss mask; what is read back comes from those bytes. A batch of turns is in memory at a time: a conversation that
reaches over batches is written in numbered parts, so it has no bound. Conversations of one row are read back without a shuffle; the parts
of the others are brought together in order and stream through two running digests. The sort spills. A conversation with a third of
all turns is one task's stream, as its two digests are sequential; formatting alone (format_turns) needs no shuffle and no order.

Defined results. Null text or role: empty. Turns are ordered by turn (null first), then role and text; repeated rows are turns of
their own. A null conv_id is a conversation. A conversation without an assistant has loss_chars 0 and the digest of the empty string. An
empty table gives no row. Input columns of format_turns named as an added column are replaced, all others are kept.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pairloom.llm.common import lists, stash, with_columns

CONTROLS = ("<|", "|>", "</s>", "<s>", "[INST]", "[/INST]", "<<SYS>>", "<</SYS>>")
OPEN, CLOSE, END = b"<|turn:", b"|>", b"</s>"
LEARNED = "assistant"
#: Bytes that are scattered at a time: what the indices take is eight times that.
STRIDE = 1 << 20
#: First bytes of UTF-8 characters.
_FIRST = bytes(c for c in range(256) if not 0x80 <= c < 0xC0)
#: The conversation that is added to all others by the query: a user and an assistant turn of the same text.
EXTRA = (-7, "</s>[INST] ok [/INST]")
ADDED = T.StructType([T.StructField("formatted", T.BinaryType()), T.StructField("loss_start", T.LongType()), T.StructField("loss_bytes", T.LongType())])


def escape(texts: pa.Array) -> pa.Array:
    """Texts without any control string; null becomes empty. A column without any is returned as it is."""
    found = pc.fill_null(texts.cast(pa.large_string()), "")
    for old, new in (("\\", "\\\\"), *((control, control[0] + "\\" + control[1:]) for control in CONTROLS)):
        if pc.any(pc.match_substring(found, old)).as_py():
            found = pc.replace_substring(found, old, new)
    return found


def unescape(text: str) -> str:
    """The text that escape() had: a doubled backslash is one, a single one goes."""
    if "\\" not in text:
        return text
    return "\\".join(part.replace("\\", "") for part in text.split("\\\\"))


def _bytes_of(column: pa.LargeStringArray) -> tuple[np.ndarray, np.ndarray]:
    """Data and ascending offsets of a string column."""
    _, offsets, data = column.buffers()
    ends = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1] if len(column) else np.zeros(1, np.int64)
    return (np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)), ends


def scatter(out: np.ndarray, data: np.ndarray, ends: np.ndarray, begins: np.ndarray) -> None:
    """Copy segment i of `data` (from ends[i] to ends[i + 1]) to place begins[i] of `out`."""
    shift = begins - ends[:-1]
    for a in range(int(ends[0]), int(ends[-1]), STRIDE):
        b = min(a + STRIDE, int(ends[-1]))
        i, j = np.searchsorted(ends, [a, b - 1], side="right") - 1
        if i == j:
            out[a + shift[i] : b + shift[i]] = data[a:b]
        else:
            cuts = np.clip(ends[i : j + 2], a, b)
            out[np.arange(a, b) + np.repeat(shift[i : j + 1], np.diff(cuts))] = data[a:b]


def assemble(roles: pa.Array, texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """The formatted turns in one buffer, their offsets, where the text of each begins in its turn, and how many bytes it has."""
    n = len(texts)
    (role_bytes, role_at), (text_bytes, text_at) = _bytes_of(escape(roles)), _bytes_of(escape(texts))
    # Segments of each turn: mark, role, mark, text, mark.
    lengths = np.empty((n, 5), np.int64)
    lengths[:, 0], lengths[:, 2], lengths[:, 4] = len(OPEN), len(CLOSE), len(END)
    lengths[:, 1], lengths[:, 3] = np.diff(role_at), np.diff(text_at)
    ends = np.cumsum(lengths.ravel())
    begins = (ends - lengths.ravel()).reshape(n, 5)
    offsets = np.concatenate(([0], ends[4::5]))
    out = np.empty(int(offsets[-1]), np.uint8)
    for k, mark in ((0, OPEN), (2, CLOSE), (4, END)):
        out[begins[:, k, None] + np.arange(len(mark))] = np.frombuffer(mark, np.uint8)
    scatter(out, role_bytes, role_at, begins[:, 1])
    scatter(out, text_bytes, text_at, begins[:, 3])
    return out, offsets, begins[:, 3] - begins[:, 0], lengths[:, 3]


def binary_column(data: np.ndarray, offsets: np.ndarray) -> pa.Array:
    """Consecutive runs of a buffer as a binary column, without a copy. Arrow's offsets have 32 bits here."""
    if len(offsets) and offsets[-1] - offsets[0] >= 1 << 31:
        raise ValueError("formatted turns of a batch take 2 GiB or more: bound spark.sql.execution.arrow.maxBytesPerBatch")
    return pa.Array.from_buffers(pa.binary(), len(offsets) - 1, [None, pa.py_buffer((offsets - offsets[0]).astype(np.int32)), pa.py_buffer(data[offsets[0] : offsets[-1]])])


def learned(roles: pa.Array) -> np.ndarray:
    """Which turns the loss mask covers."""
    return np.asarray(pc.fill_null(pc.equal(roles, LEARNED), False).to_numpy(zero_copy_only=False), bool)


def format_turns(turns: DataFrame) -> DataFrame:
    """`turns` (role, text and any others) with `formatted` and the loss mask of each (start and length in bytes; null: none).

    Row by row, in whatever order and partitions the turns are.
    """
    names = [f.name for f in ADDED]
    schema = T.StructType([f for f in turns.schema if f.name not in names] + list(ADDED))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                at = batch.schema.names.index
                roles = batch.column(at("role"))
                data, offsets, starts, sizes = assemble(roles, batch.column(at("text")))
                unmasked = ~learned(roles)
                yield with_columns(batch, names, [binary_column(data, offsets), pa.array(starts, pa.int64(), mask=unmasked), pa.array(sizes, pa.int64(), mask=unmasked)])

    return turns.mapInArrow(run, schema)


def format_conversations(turns: DataFrame) -> DataFrame:
    """(conv_id, part, whole, content, loss): the bytes of each conversation, in one row or in numbered parts, and the spans of its loss mask in them.

    whole: the row is all of the conversation. loss: start and length in bytes of each span, one after the other. Other columns of `turns` are left out.
    """
    ordered = turns.select("conv_id", "turn", F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"))
    ordered = ordered.repartition("conv_id").sortWithinPartitions("conv_id", "turn", "role", "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # The last conversation of a batch waits until it is known whether it goes on: (conv_id, part, content, loss)
        waiting: tuple | None = None

        def rows(keys: list, parts: list[int], whole: list[bool], content: pa.Array, loss: pa.Array) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(keys, pa.int64()), pa.array(parts, pa.int32()), pa.array(whole, pa.bool_()), content, loss], names=_CONVERSATION)

        def one(whole: bool) -> pa.RecordBatch:
            key, part, content, loss = waiting
            return rows([key], [part], [whole], content, loss)

        for batch in batches:
            n = batch.num_rows
            if not n:
                continue
            keys, roles = batch.column(0), batch.column(2)
            data, offsets, starts, sizes = assemble(roles, batch.column(3))
            known, values = np.asarray(keys.is_valid()), keys.fill_null(0).to_numpy()
            first = np.flatnonzero(np.concatenate(([True], (values[1:] != values[:-1]) | (known[1:] != known[:-1]))))
            bounds = offsets[np.concatenate((first, [n]))]
            content = binary_column(data, bounds)
            masked = np.flatnonzero(learned(roles))
            owner = np.searchsorted(first, masked, side="right") - 1
            spans = np.stack([offsets[masked] + starts[masked] - bounds[owner], sizes[masked]], axis=1).ravel()
            loss = lists(spans, 2 * np.bincount(owner, minlength=len(first)))
            own = keys.take(pa.array(first)).to_pylist()
            parts = [0] * len(own)
            if waiting is not None:
                goes_on = waiting[0] == own[0]
                yield one(not goes_on and waiting[1] == 0)
                if goes_on:
                    parts[0] = waiting[1] + 1
            last = len(own) - 1
            if last:
                yield rows(own[:last], parts[:last], [p == 0 for p in parts[:last]], content.slice(0, last), loss.slice(0, last))
            # a copy, so that the batch's buffer can go
            waiting = (own[last], parts[last], pa.array([content[last].as_py()], pa.binary()), pa.array([loss[last].as_py()], pa.list_(pa.int64())))
        if waiting is not None:
            yield one(waiting[1] == 0)

    return ordered.mapInArrow(run, f"conv_id {turns.schema['conv_id'].dataType.simpleString()}, part int, whole boolean, content binary, loss array<long>")


_CONVERSATION = ["conv_id", "part", "whole", "content", "loss"]


def turns_of(content: bytes) -> Iterator[tuple[str, str]]:
    """Role and text of each turn in the bytes of a conversation, in order."""
    at = 0
    while at < len(content):
        close, end = content.find(CLOSE, at + len(OPEN)), content.find(END, at)
        if not content.startswith(OPEN, at) or not 0 <= close < end:
            raise ValueError("not a formatted turn")
        yield unescape(content[at + len(OPEN) : close].decode()), unescape(content[close + len(CLOSE) : end].decode())
        at = end + len(END)


def read_back(written: DataFrame) -> DataFrame:
    """One row for each conversation of `written` (the rows of format_conversations), all from their bytes and spans."""
    schema = "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long"
    names = [p.split()[0] for p in schema.split(", ")]
    kinds = [pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64()]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, state = None, None

        def row() -> list:
            return [current, state[0], state[1].hexdigest(), state[2], state[3].hexdigest(), state[4]]

        def emit(rows: list[list]) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names=names)

        for batch in batches:
            done = []
            for conv, part, data, loss in zip(*(batch.column(k) for k in range(4))):
                if state is None or part.as_py() == 0:
                    if state is not None:
                        done.append(row())
                    current, state = conv.as_py(), [0, hashlib.sha256(), 0, hashlib.sha256(), 0]
                content, spans = data.as_py(), loss.as_py()
                for role, text in turns_of(content):
                    state[0] += 1
                    state[1].update(f"{role}\n{text}\n".encode())
                state[4] += len(content) - len(content.translate(None, _FIRST))
                for start, size in zip(spans[::2], spans[1::2]):
                    masked = unescape(content[start : start + size].decode())
                    state[2] += len(masked)
                    state[3].update(masked.encode())
            if done:
                yield emit(done)
        if state is not None:
            yield emit([row()])

    columns = ["conv_id", "part", "content", "loss"]
    single = written.filter("whole").select(*columns)
    parts = written.filter("NOT whole").select(*columns).repartition("conv_id").sortWithinPartitions("conv_id", "part")
    return single.mapInArrow(run, schema).unionByName(parts.mapInArrow(run, schema))


def query(spark, sf_dir: str) -> DataFrame:
    """op5: all conversations and EXTRA, formatted and read back."""
    turns = spark.read.parquet(f"{sf_dir}/conversations.parquet").select(F.col("conv_id").cast("long"), F.col("turn").cast("long"), "role", "text")
    key, text = EXTRA
    extra = spark.createDataFrame([(key, 0, "user", text), (key, 1, "assistant", text)], "conv_id long, turn long, role string, text string")
    return read_back(stash(format_conversations(turns.unionByName(extra)), "conversations"))


def _escaped(column: str) -> str:
    sql = f"replace({column}, '\\', '\\\\')"
    for control in CONTROLS:
        sql = f"replace({sql}, '{control}', '{control[0]}\\{control[1:]}')"
    return f"length({sql})"


ORACLE = f"""
WITH t AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT * FROM (VALUES ({EXTRA[0]}, 0, 'user', '{EXTRA[1]}'), ({EXTRA[0]}, 1, '{LEARNED}', '{EXTRA[1]}')))
SELECT conv_id, count(*) AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text)) AS turns_sha256,
       CAST(coalesce(sum(length(text)) FILTER (role = '{LEARNED}'), 0) AS BIGINT) AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, role, text) FILTER (role = '{LEARNED}'), '')) AS loss_sha256,
       CAST(sum({len(OPEN) + len(CLOSE) + len(END)} + {_escaped("role")} + {_escaped("text")}) AS BIGINT) AS formatted_chars
FROM t GROUP BY conv_id
"""
