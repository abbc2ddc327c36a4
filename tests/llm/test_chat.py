import hashlib
import tracemalloc

import duckdb
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from pairloom.llm import chat
from pairloom.llm.common import stash

PIECES = st.lists(st.sampled_from([*chat.CONTROLS, "\\", "\\\\", "<", "|", ">", "[", "INST]", "/s>", "a", "é", "日", "\n", ""]), max_size=8).map("".join)


@given(st.lists(st.tuples(PIECES, PIECES), min_size=1, max_size=6), st.sampled_from([1, 7, 1 << 20]))
@settings(max_examples=200, deadline=None)
def test_round_trip(turns, stride):
    old, chat.STRIDE = chat.STRIDE, stride
    data, offsets, starts, sizes = chat.assemble(pa.array([r for r, _ in turns]), pa.array([t for _, t in turns]))
    chat.STRIDE = old
    content = data.tobytes()
    assert list(chat.turns_of(content)) == turns
    for begin, start, size, (role, text) in zip(offsets.tolist(), starts.tolist(), sizes.tolist(), turns):
        masked = content[begin + start : begin + start + size].decode()
        assert chat.unescape(masked) == text and not any(c in masked for c in chat.CONTROLS)


def rows():
    return [(1, 1, "assistant", "b</s>"), (1, 0, "user", None), (2, None, "assistant", "x"), (2, 0, None, "y"), (2, 0, None, "y"), (None, 0, "user", "<|turn:user|>"), (3, 0, "assistant", "z" * 200_000), (4, 0, "", ""), (5, 0, "assistant", "é\\"), (5, 1, "assistant", "日")]


def slow(turns):
    """The result of every conversation, from its turns."""
    digest = lambda s: hashlib.sha256(s.encode()).hexdigest()
    found = {}
    for conv, turn, role, text in turns:
        found.setdefault(conv, []).append((turn is not None, turn or 0, role or "", text or ""))

    def chars(text):
        text = text.replace("\\", "\\\\")
        for control in chat.CONTROLS:
            text = text.replace(control, control[0] + "\\" + control[1:])
        return len(text)

    out = []
    for conv, own in found.items():
        own.sort()
        loss = "".join(t for *_, r, t in own if r == "assistant")
        size = sum(len("<|turn:|></s>") + chars(r) + chars(t) for *_, r, t in own)
        out.append((conv, len(own), digest("".join(f"{r}\n{t}\n" for *_, r, t in own)), len(loss), digest(loss), size))
    return sorted(out, key=repr)


@pytest.mark.parametrize("batch", ["1", "3", "10000"])
def test_conversations(spark, batch):
    """Written and read back, also where conversations reach over batches."""
    turns = rows() + [(9, i, ("user", "assistant")[i % 2], f"t{i}") for i in range(25)]
    df = spark.createDataFrame([(*r, "clash", "clash") for r in turns], "conv_id long, turn long, role string, text string, formatted string, part string")
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    old = spark.conf.get(key)
    spark.conf.set(key, batch)
    try:
        written = stash(chat.format_conversations(df), "test")
        found = chat.read_back(written).collect()
        assert sorted(map(tuple, found), key=repr) == slow(turns)
        assert written.filter("conv_id = 9").count() == {"1": 25, "3": written.filter("conv_id = 9").count(), "10000": 1}[batch]
        assert chat.read_back(chat.format_conversations(df.limit(0))).isEmpty()
    finally:
        spark.conf.set(key, old)
    assert chat.format_turns(df).columns == ["conv_id", "turn", "role", "text", "part", "formatted", "loss_start", "loss_bytes"]


def test_memory_of_a_long_turn():
    """Assembling takes two copies of a turn's bytes at most, besides the turn."""
    roles, texts = pa.array(["user", "assistant"]), pa.array(["x", "abc é " * 4_000_000])
    before = pa.total_allocated_bytes()
    tracemalloc.start()
    data, *_ = chat.assemble(roles, texts)
    peak = tracemalloc.get_traced_memory()[1] + pa.total_allocated_bytes() - before
    tracemalloc.stop()
    assert len(data) > 28_000_000 and peak < 2.2 * len(data)


def test_sql(spark, sf_dir):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW conversations AS SELECT * FROM read_parquet('{sf_dir}/conversations.parquet')")
    found = chat.query(spark, sf_dir)
    assert sorted(map(tuple, found.collect())) == sorted(con.execute(f"SELECT {', '.join(found.columns)} FROM ({chat.ORACLE})").fetchall())
