import pytest

from docrank.llm.queries import tokenizer_path


@pytest.fixture(scope="session")
def word_bpe():
    return tokenizer_path("word_bpe_49k.json")


@pytest.fixture(scope="session")
def byte_bpe():
    return tokenizer_path("byte_bpe_50k.json")


DOC_SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def documents(spark, rows):
    """documents table of ``(doc_id, text[, lang, source])`` rows."""
    full = [(*r[:2], *(*r[2:], *("en", "s0")[len(r) - 2:]), None if r[1] is None else len(r[1])) for r in rows]
    return spark.createDataFrame(full, DOC_SCHEMA)


def save(df, tmp_path, name):
    df.write.parquet(f"{tmp_path}/{name}.parquet")
    return str(tmp_path)


# null id and text, empty and blank text, repeated rows, one id with two texts,
# a very long text, other scripts
HARD = [
    (1, "The quick brown fox jumps over the lazy dog. The quick brown fox."), (2, None), (3, ""), (4, " \t\n "),
    (5, "a@b.co and 10.0.0.1, +1 (234) 555-0199"), (5, "a@b.co and 10.0.0.1, +1 (234) 555-0199"), (6, "first"), (6, "second text here"),
    (None, "no id"), (None, None), (7, "Größe Straße ñandú 東京 🙂 <|endoftext|> it's 3rd\x1c!"),
    (8, "word " * 30_000), (9, "x" * 50_000), (10, "The quick brown fox jumps over the lazy dog. The quick brown fox."),
]
