"""What a worker holds at a time."""
import pytest

from docrank.llm import ctw, token_files


def test_grams_come_in_small_steps():
    texts = [b"abc " * 100_000] * 8
    steps = [(i, j) for i, j, _, _ in ctw.grams(texts)]
    assert steps[0][0] == 0 and steps[-1][1] == 8 and all(j - i <= 3 for i, j in steps)


def test_known_pieces_are_not_asked_for_again(monkeypatch):
    public_tokenizers = pytest.importorskip("public_tokenizers")
    e = token_files.ByteLevelEncoder(public_tokenizers.path("byte_bpe_50k.json"))
    texts = [b"one two, one 3", b"", "café 東京 one".encode(), b"x" * 300 + b" two"]
    want = [e.lib.encode(t.decode(), add_special_tokens=False).ids for t in texts]

    def ids(got):
        return [[int.from_bytes(g[i:i + 4], "little") for i in range(0, len(g), 4)] for g in got]

    assert ids(e.encode(texts)) == want
    asked = []
    missing = e.cache.missing
    monkeypatch.setattr(e.cache, "missing", lambda keys: asked.append(set(keys)) or missing(keys))
    assert ids(e.encode(texts)) == want
    assert asked[0] == {"x" * 300}            # long pieces are not kept
    e.cache.limit = 1                          # the next step begins a new generation
    assert ids(e.encode(texts)) == want and ids(e.encode(texts)) == want


def test_new_words_are_encoded_many_to_a_text():
    public_tokenizers = pytest.importorskip("public_tokenizers")
    e = token_files.ByteLevelEncoder(public_tokenizers.path("byte_bpe_50k.json"))
    words = [f" {w}{i}" if i % 3 else f" {w}" for i, w in enumerate(["the", "Zähne", "ſſ", "x" * 300, "don", "ÿ", "endoftext"] * 20)]
    pieces = list(dict.fromkeys([*words, *(f" {i}" for i in range(1500)), "'s", " ", "\n\n", "a", " ,.", " <|endoftext|>", " a b"]))
    alone = [p for p in pieces if token_files._ALONE.fullmatch(p)]
    calls = []

    class Counted:
        def __getattr__(self, name, lib=e.lib):
            return lambda texts, **kw: (calls.append(len(texts)), getattr(lib, name)(texts, **kw))[1]

    want = dict(zip(pieces, e._ids(pieces)))
    e.lib = Counted()
    assert e._learn(pieces) == want
    assert len(alone) > 1500 and sum(calls) <= len(pieces) - len(alone) + 4
