"""Token counts, encoding and token files against the tokenizers library."""
import hashlib
import random
import zlib

import numpy as np
import pytest
from tokenizers import Tokenizer

from docrank.llm import bpe, token_counts, token_files
from docrank.llm.queries import op3_token_counts, op4_bpe, op8_token_files
from docrank.session import scratch_path

from .conftest import HARD, documents, save

SF = "/root/testdata/sf0.001"


def key(r):
    return tuple("" if x is None else str(x) for x in r)


def random_texts(n, seed=1):
    r = random.Random(seed)
    chars = "abcdefghiéèñßü \n\t'sdll0123.,;:-<|>endoftext東京́\x1c\x85　ΣİAAaaaa🙂ªº×÷ſĸ½٣"
    return ["".join(r.choice(chars) for _ in range(r.randint(0, 150))) for _ in range(n)]


def test_counts(spark, word_bpe, tmp_path):
    rows = HARD + [(100 + i, t) for i, t in enumerate(random_texts(300))]
    lib = Tokenizer.from_file(word_bpe)
    got = op3_token_counts(spark, save(documents(spark, rows), tmp_path, "documents")).collect()
    want = [(d, len((t or "").encode()), n, n > 2048) for d, t in ((r[0], r[1]) for r in rows)
            for n in [len(lib.encode(t or "", add_special_tokens=False).ids)]]
    assert sorted(map(tuple, got), key=key) == sorted(want, key=key)


def test_counts_do_not_depend_on_the_table(spark, word_bpe):
    docs = documents(spark, HARD).select("doc_id", "text")
    a = token_counts.count_tokens(docs, word_bpe, entries=1).collect()
    b = token_counts.count_tokens(docs, word_bpe).collect()
    assert sorted(map(tuple, a), key=key) == sorted(map(tuple, b), key=key)


def test_counts_of_other_files(spark, byte_bpe):
    import sentencepiece

    from docrank.llm.queries import tokenizer_path
    path = tokenizer_path("piece_bpe_32k.model")
    lib = sentencepiece.SentencePieceProcessor(model_file=path)
    rows = token_counts.count_tokens(documents(spark, HARD[:8]).select("doc_id", "text"), path).collect()
    assert all(r.n_tokens == len(lib.encode(r.text or "")) for r in rows)


def test_merge_rounds_equal_the_library(word_bpe):
    texts = random_texts(3000, 2) + ["aaaaaaa", "x<|endoftext|>y <|startoftext|>", "<|endoftext|>" * 3, "", "the" * 200]
    lib, own = Tokenizer.from_file(word_bpe), bpe.BpeModel(word_bpe)
    want = [x.ids for x in lib.encode_batch(texts, add_special_tokens=False)]
    got = own.encode([t.encode() for t in texts])
    assert [np.frombuffer(g, "<u4").tolist() for g in got] == want
    assert [own.decode(g) for g in got] == [lib.decode(w, skip_special_tokens=False) for w in want]


def test_cache_may_overflow(word_bpe, monkeypatch):
    monkeypatch.setattr(bpe, "CACHE_ENTRIES", 3)
    monkeypatch.setattr(bpe, "STEP_BYTES", 10)
    texts = [t.encode() for t in random_texts(200, 3)]
    assert bpe.BpeModel(word_bpe).encode(texts) == bpe.BpeModel(word_bpe).encode(texts)


def test_encode_query(spark, word_bpe, tmp_path):
    lib = Tokenizer.from_file(word_bpe)
    got = op4_bpe(spark, save(documents(spark, HARD), tmp_path, "documents")).collect()
    want = []
    for d, t in ((r[0], r[1]) for r in HARD):
        ids = lib.encode(t or "", add_special_tokens=False).ids
        want.append((d, len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(),
                     hashlib.sha256(lib.decode(ids, skip_special_tokens=False).encode()).hexdigest()))
    assert sorted(map(tuple, got), key=key) == sorted(want, key=key)


def test_encode_then_decode_columns(spark, word_bpe):
    docs = documents(spark, HARD).select("doc_id", "text")
    two = bpe.decode(bpe.encode(docs, word_bpe), word_bpe).drop("text").collect()
    one = bpe.round_trip(docs, word_bpe).collect()
    assert sorted(map(tuple, two), key=key) == sorted(map(tuple, one), key=key)


def test_file_query(spark, byte_bpe, tmp_path):
    lib = Tokenizer.from_file(byte_bpe)
    rows = HARD + [(100 + i, t) for i, t in enumerate(random_texts(300, 5))]
    got = [tuple(r) for r in op8_token_files(spark, save(documents(spark, rows), tmp_path, "documents")).collect()]
    want, at = [], 0
    for d, t in sorted(((r[0], r[1] or "") for r in rows), key=lambda x: (x[0] is not None, x[0] or 0, x[1].encode())):
        ids = lib.encode(t, add_special_tokens=False).ids + [0]
        want.append((d, at, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        at += len(ids)
    assert sorted(got, key=lambda r: r[1]) == want


def test_files_hold_independent_checked_frames(spark, byte_bpe):
    import zstandard
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    folder = scratch_path(spark, "frames")
    manifest = token_files.write_token_files(docs, byte_bpe, folder, frame_bytes=4096)
    assert sum(r.n_docs for r in manifest) == docs.count()
    lib = Tokenizer.from_file(byte_bpe)
    text = {r.doc_id: r.text for r in docs.collect()}
    m = manifest[0]
    with token_files.open_path(m.path, "r") as f:
        rd = token_files.Reader(f)
        assert len(rd.frames) > 2
        some = int(rd.docs[len(rd.docs) // 2, 0])
        (row,) = rd.find(some)
        ids = np.frombuffer(rd.ids(row), "<u4").tolist()
        assert ids == lib.encode(text[some], add_special_tokens=False).ids + [0]
        assert rd.find(-5) == []
        whole = f.seek(0) or f.read()
    # plain zstandard reads the data frames and skips the tables
    raw = zstandard.ZstdDecompressor().stream_reader(whole, read_across_frames=True).read()
    assert len(raw) == 4 * m.n_ids
    # a damaged frame is noticed
    class Memory:
        def __init__(self, b):
            import io
            self.b = io.BytesIO(b)

        def __getattr__(self, n):
            return getattr(self.b, n)
    bad = bytearray(whole)
    bad[rd.offsets[1] - 3] ^= 255
    with pytest.raises((ValueError, zstandard.ZstdError)):
        token_files.Reader(Memory(bytes(bad))).frame(0)


@pytest.mark.parametrize("query", [op3_token_counts, op4_bpe, op8_token_files])
def test_empty_table(spark, tmp_path, query):
    assert query(spark, save(documents(spark, [(1, "x")]).limit(0), tmp_path, "documents")).collect() == []
