"""The tokenizers and the two IDF formulas as functions of SQL text.

``register(spark)`` defines them in the session as SQL functions; the optimizer puts their
bodies into the query, so a plan holds built-in functions only:

* ``tokens_word_lower(text)``, ``tokens_nonword_split(text)``, ``tokens_alpha(text)``:
  ``array<string>``, as ``docrank.functions.tokenize.tokens``
* ``query_terms(query)``: terms of a typed query for the ``word_lower`` tokenizer
* ``idf(n, df)``, ``idf_raw(n, df)``: smooth and raw inverse document frequency
* ``idf_of(df)``: the smooth one for a fixed corpus size, where ``register`` gets ``n``
"""

from __future__ import annotations

from pyspark.sql import SparkSession

from docrank.functions.tokenize import ALL_NONWORD_PATTERN, ALPHA_PATTERN, NONWORD_PATTERN, TRAILING_NONWORD_PATTERN, WORD_PATTERN

TEXT = "coalesce(text, '')"
FUNCTIONS = {
    "tokens_word_lower(text STRING)": ("ARRAY<STRING>", f"regexp_extract_all(lower({TEXT}), r'{WORD_PATTERN}', 0)"),
    "tokens_alpha(text STRING)": ("ARRAY<STRING>", f"regexp_extract_all({TEXT}, r'{ALPHA_PATTERN}', 0)"),
    "tokens_nonword_split(text STRING)": ("ARRAY<STRING>", f"""CASE WHEN {TEXT} = '' THEN array('')
        WHEN rlike({TEXT}, r'{ALL_NONWORD_PATTERN}') THEN CAST(array() AS ARRAY<STRING>)
        ELSE split(regexp_replace({TEXT}, r'{TRAILING_NONWORD_PATTERN}', ''), r'{NONWORD_PATTERN}') END"""),
    "query_terms(query STRING)": ("ARRAY<STRING>", f"""filter(flatten(transform(split(coalesce(query, ''), ' '),
        p -> regexp_extract_all(lower(p), r'{WORD_PATTERN}', 0))), w -> w <> '')"""),
    "idf(n DOUBLE, df BIGINT)": ("DOUBLE", "ln((n + 1.0D) / (CAST(df AS DOUBLE) + 1.0D))"),
    "idf_raw(n DOUBLE, df BIGINT)": ("DOUBLE", "ln(n / CAST(df AS DOUBLE))"),
}


def register(spark: SparkSession, n: float | None = None) -> list[str]:
    """Define the functions in the session (again, if they are there); returns their
    names."""
    functions = dict(FUNCTIONS)
    if n is not None:
        functions["idf_of(df BIGINT)"] = ("DOUBLE", f"ln(({float(n)!r}D + 1.0D) / (CAST(df AS DOUBLE) + 1.0D))")
    for head, (kind, body) in functions.items():
        spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {head} RETURNS {kind} RETURN {body}")
    return [head.split("(")[0] for head in functions]
