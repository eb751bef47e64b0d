"""Tokenizer cases (FIXTURES 3)."""
import pytest

from docrank.functions.tokenize import ALPHA, NONWORD_SPLIT, WORD_LOWER, query_tokens, tokens

CASES = [
    # text, word_lower, nonword_split, alpha
    ("a b", ["a", "b"], ["a", "b"], ["a", "b"]),
    ("a--b", ["a", "b"], ["a", "", "b"], ["a", "b"]),
    ("-a b-", ["a", "b"], ["", "a", "b"], ["a", "b"]),
    ("", [], [""], []),
    ("--", [], [], []),
    ("Café naïve", ["caf", "na", "ve"], ["Caf", "", "na", "ve"], ["Caf", "na", "ve"]),
    ("A1_b", ["a1_b"], ["A1_b"], ["A", "b"]),
    ("The the THE", ["the", "the", "the"], ["The", "the", "THE"], ["The", "the", "THE"]),
    ("line\nbreak.\n", ["line", "break"], ["line", "break"], ["line", "break"]),
]


@pytest.mark.parametrize("text,lower,split,alpha", CASES)
def test_tokenizers(spark, text, lower, split, alpha):
    df = spark.createDataFrame([(text,)], "t string")
    row = df.select(tokens("t", WORD_LOWER).alias("a"), tokens("t", NONWORD_SPLIT).alias("b"),
                    tokens("t", ALPHA).alias("c")).first()
    assert list(row["a"]) == lower
    assert list(row["b"]) == split
    assert list(row["c"]) == alpha


def test_null_text_is_empty(spark):
    df = spark.createDataFrame([(None,)], "t string")
    row = df.select(tokens("t", NONWORD_SPLIT).alias("b"), tokens("t", WORD_LOWER).alias("a")).first()
    assert list(row["b"]) == [""]
    assert list(row["a"]) == []


def test_word_lower_equals_regex_tokenizer(spark):
    from pyspark.ml.feature import RegexTokenizer
    texts = [("Hello, how's it - are you",), ("He said \"hi, there\" now",), ("Café naïve A1_b",), ("",)]
    df = spark.createDataFrame(texts, "t string")
    ml = RegexTokenizer(inputCol="t", outputCol="w", pattern=r"\w+", gaps=False).transform(df)
    for r in ml.select("w", tokens("t", WORD_LOWER).alias("x")).collect():
        assert list(r["w"]) == list(r["x"])


@pytest.mark.parametrize("q,mode,expected", [
    ("the with", WORD_LOWER, ["the", "with"]),
    ("The  With", WORD_LOWER, ["the", "with"]),   # double space: empty term dropped
    ("the the", WORD_LOWER, ["the", "the"]),
    ("The", NONWORD_SPLIT, ["The"]),
    ("a--b", NONWORD_SPLIT, ["a", "b"]),
    ("", WORD_LOWER, []),
])
def test_query_tokens(spark, q, mode, expected):
    row = spark.createDataFrame([(q,)], "q string").select(query_tokens("q", mode).alias("t")).first()
    assert list(row["t"]) == expected
