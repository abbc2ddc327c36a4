import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from pairloom.llm import token_counts, tokens
from pairloom.llm.encoding import Encoder

PATH = tokens.tokenizer_path()


@pytest.fixture(scope="module")
def reference():
    return Tokenizer.from_file(PATH)


def test_encoder_equals_the_library(reference):
    rng = random.Random(1)
    pieces = ["a", "Bcd", " ", "  ", "\n", "\n\n", "\t", "don't", "'s", " 12", "é", "\x1c", "\x85", " ", "!!", "<|endoftext|>", "½", "日本", "…", "​", "'", "l"]
    texts = ["".join(rng.choices(pieces, k=rng.randint(0, 12))) for _ in range(4000)]
    for special in (True, False):
        encode = Encoder(PATH, special)
        reference.encode_special_tokens = not special
        for text in texts:
            assert np.frombuffer(encode(text.encode()), encode.dtype).tolist() == reference.encode(text, add_special_tokens=False).ids
    reference.encode_special_tokens = False


def test_elias_fano():
    rng = np.random.default_rng(2)
    for n in (0, 1, 2, 255, 256, 257, 3000):
        values = np.sort(rng.integers(0, rng.integers(1, 1 << 40), n)).astype(np.uint64)
        read, _ = tokens.EliasFano.from_bytes(tokens.EliasFano.encode(values).to_bytes())
        assert read.decode().tolist() == values.tolist() == [read.select(i) for i in range(n)]
        if n == 3000:
            assert len(read.to_bytes()) < 0.8 * 8 * n


def test_files(docs, none, plain, reference, monkeypatch):
    monkeypatch.setattr(tokens, "BLOCK_IDS", 500)
    rows = sorted(plain, key=lambda r: (r[0] is not None, r[0] or 0, r[1] is not None, (r[1] or "").encode()))
    ids = [reference.encode(t or "", add_special_tokens=False).ids + [2] for _, t, _, _ in rows]
    starts = np.concatenate(([0], np.cumsum([len(x) for x in ids])[:-1]))
    expected = [(-1 if r[0] is None else r[0], int(s), len(x), zlib.crc32(np.array(x, "<u4").tobytes())) for r, s, x in zip(rows, starts, ids)]
    found = tokens.write_and_read(docs, PATH).collect()
    assert sorted((-1 if r.doc_id is None else r.doc_id, r.start, r.n_tokens, r.ids_crc32) for r in found) == sorted(expected)
    assert tokens.write_and_read(none, PATH).isEmpty()


def test_random_access(docs):
    blocks = tokens.encode_documents(docs, PATH).collect()
    for row in blocks:
        block = tokens.Block(bytes(row.content))
        assert sum(len(block.document(i)) for i in range(block.n_docs)) == row.n_ids
        assert all(block.document(i)[-1] == tokens.END_ID for i in range(block.n_docs))


@pytest.mark.parametrize("block_ids", [7, 1 << 20])
def test_counts(docs, plain, reference, block_ids):
    reference.encode_special_tokens = True
    small = docs.filter("doc_id IS NULL OR doc_id NOT IN (140, 141)")
    expected = sorted((-1 if r[0] is None else r[0], len(reference.encode(r[1] or "", add_special_tokens=False).ids)) for r in plain if r[0] not in (140, 141))
    reference.encode_special_tokens = False
    blocks, names = token_counts.write_flat(small, PATH, block_ids=block_ids)
    assert blocks.columns == ["shard", "block", "content"]
    files = lambda df: {r[0] for r in df.select(F.input_file_name()).collect()}
    assert all("kind=tokens" in f for f in files(blocks)) and all("kind=names" in f for f in files(names))
    found = token_counts.scan_counts(blocks).join(names, ["shard", "number"]).collect()
    assert sorted((-1 if r.doc_id is None else r.doc_id, r.n_tokens) for r in found) == expected


def test_unterminated_and_empty(spark, none):
    flat = lambda ids: bytearray(np.array(ids, "<u2").tobytes())
    blocks = spark.createDataFrame([(0, 0, flat([1, 1])), (0, 1, flat([50256, 1])), (0, 2, flat([1, 1])), (1, 0, flat([5]))], "shard int, block int, content binary")
    found = sorted((r.shard, r.start, r.n_tokens, r.terminated) for r in token_counts.scan_counts(blocks).collect())
    assert found == [(0, 0, 2, True), (0, 3, 3, False), (1, 0, 1, False)]
    assert token_counts.count_tokens(none, PATH).isEmpty()


def test_wide_ids(spark):
    flat = lambda ids: bytearray(np.array(ids, "<u4").tobytes())
    blocks = spark.createDataFrame([(0, 0, flat([70_000, 9])), (0, 1, flat([9, 70_000, 3]))], "shard int, block int, content binary")
    found = sorted((r.number if r.terminated else 9, r.start, r.n_tokens) for r in token_counts.scan_counts(blocks, 9, 4).collect())
    assert found == [(0, 0, 1), (1, 2, 0), (9, 3, 2)]


def test_cache_is_bounded_in_bytes(monkeypatch, reference):
    from pairloom.llm import encoding

    monkeypatch.setattr(encoding, "MOST_BYTES", 20_000)
    encode, rng = Encoder(PATH), random.Random(3)
    for k in range(300):
        text = " ".join("".join(rng.choices("abcdefgh", k=rng.randint(1, 9))) for _ in range(20)) + " " + "日本" * 500 + str(k)
        assert np.frombuffer(encode(text.encode()), encode.dtype).tolist() == reference.encode(text, add_special_tokens=False).ids
    assert encode.size < 20_000 + encoding.LONGEST * 4 + 200
    assert max(map(len, encode.units)) <= encoding.LONGEST


def test_the_query_reads_by_select(docs, monkeypatch):
    """No bound is decoded as a table on the way of the result."""
    row = max(tokens.encode_documents(docs, PATH).collect(), key=lambda r: r.n_docs)
    block = tokens.Block(bytes(row.content))
    ends = block.bounds.decode().tolist()
    assert [block.span(i) for i in range(block.n_docs)] == list(zip([0, *ends[:-1]], ends))
    import inspect

    assert "bounds.decode" not in inspect.getsource(tokens.read_documents) and "block.span" in inspect.getsource(tokens.read_documents)


def test_long_texts_without_blanks(spark, reference):
    """Units and documents of hundreds of thousands of characters, written and read back."""
    rng = random.Random(9)
    texts = ["日本語" * 60_000, "".join(rng.choices("abcdef0123456789", k=200_000)), "ab " * 150_000 + "é" * 50_000]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    ids = [[*reference.encode(t, add_special_tokens=False).ids, 2] for t in texts]
    found = tokens.write_and_read(df, PATH).orderBy("doc_id").collect()
    assert [(r.n_tokens, r.ids_crc32) for r in found] == [(len(x), zlib.crc32(np.array(x, "<u4").tobytes())) for x in ids]
    counted = token_counts.count_tokens(df, PATH).orderBy("doc_id").collect()
    assert [r.n_tokens for r in counted] == [len(x) - 1 for x in ids]
