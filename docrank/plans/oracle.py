"""DuckDB SQL equivalents of the registered queries (the correctness oracle).

The SQL is written independently of the Spark plans: tokens are unnested and
grouped, lengths are sums of counts, N is ``count(*)`` over the table.
Conventions shared with the Spark side: values built with ``ln`` are rounded
to 10 places, score sums to 8 places (summation order differs between
engines); ranks break ties by ``doc_id`` then ``word``.
"""

from __future__ import annotations

# Query texts used by the registered search queries.
QUERY = "the with"
BAG_QUERY = "the with the"
FOLLOWUP_QUERY = "and of"
ROWS_QUERY = "The With"

TOKENS_SQL = {
    "word_lower": r"regexp_extract_all(lower({t}), '\w+')",
    "alpha": r"regexp_extract_all({t}, '[a-zA-Z]+')",
    "nonword_split": (r"CASE WHEN {t} = '' THEN ['']::VARCHAR[] "
                      r"WHEN regexp_full_match({t}, '\W+') THEN []::VARCHAR[] "
                      r"ELSE string_split_regex(regexp_replace({t}, '\W+\z', ''), '\W') END"),
}

IDF_SQL = {
    "smooth": "ln((n.n + 1.0e0) / (d.doc_frequency + 1.0e0))",
    "raw": "ln(n.n / d.doc_frequency)",
}


def base_ctes(tokenizer: str = "word_lower", idf_kind: str = "smooth",
              tf_decimals: int | None = None, table: str = "documents",
              id_col: str = "doc_id", multi_row: bool = False) -> str:
    """CTEs ``terms``, ``lens``, ``tf``, ``n``, ``dfq``, ``idf``, ``w`` over
    ``table``."""
    tok = TOKENS_SQL[tokenizer].format(t="coalesce(text, '')")
    tf_expr = "t.frequency / l.total_words"
    if tf_decimals is not None:
        tf_expr = f"round({tf_expr}, {tf_decimals})"
    n_expr = f"count(DISTINCT {id_col})" if multi_row else "count(*)"
    return f"""
toks AS (SELECT {id_col} AS doc_id, unnest({tok}) AS word FROM {table}),
terms AS (SELECT doc_id, word, count(*) AS frequency FROM toks GROUP BY doc_id, word),
lens AS (SELECT doc_id, CAST(sum(frequency) AS BIGINT) AS total_words FROM terms GROUP BY doc_id),
tf AS (SELECT t.doc_id, t.word, t.frequency, l.total_words, {tf_expr} AS term_frequency
       FROM terms t JOIN lens l ON t.doc_id = l.doc_id),
n AS (SELECT CAST({n_expr} AS DOUBLE) AS n FROM {table}),
dfq AS (SELECT word, count(*) AS doc_frequency FROM terms GROUP BY word),
idf AS (SELECT d.word, d.doc_frequency, {IDF_SQL[idf_kind]} AS idf FROM dfq d CROSS JOIN n),
w AS (SELECT tf.doc_id, tf.word, tf.frequency, tf.total_words, tf.term_frequency,
             idf.doc_frequency, idf.idf, tf.term_frequency * idf.idf AS tf_idf
      FROM tf JOIN idf ON tf.word = idf.word)"""


def with_(ctes: str, body: str) -> str:
    return f"WITH {ctes.strip()}\n{body}"


def literal_terms(query: str, weighting: str = "set") -> str:
    """Terms CTE body for a literal query whose terms are already plain
    lower-case words (the tokenizer is the identity on them)."""
    parts = [p for p in query.split(" ") if p != ""]
    rows = ", ".join(f"('{p.lower()}')" for p in parts)
    if weighting == "bag":
        return f"SELECT word, count(*) AS qtf FROM (VALUES {rows}) v(word) GROUP BY word"
    return f"SELECT DISTINCT word, 1 AS qtf FROM (VALUES {rows}) v(word)"


# Physical lines of the documents written as ten-field records, and their fields:
# pieces between quotes are numbered from the right, commas separate in the pieces
# 0, 2, 4, ..; trailing empty fields do not count.
LINES_SQL = r"""
recs AS (SELECT concat_ws(',', coalesce(CAST(doc_id AS VARCHAR), ''), coalesce(lang, ''), coalesce(source, ''),
                          coalesce(CAST(n_chars AS VARCHAR), ''), 'x0', 'x1', 'x2', 'x3', 'x4',
                          '"' || replace(coalesce(text, ''), '"', '""') || '"') AS rec FROM documents),
lns AS (SELECT unnest(string_split(replace(replace(rec, chr(13) || chr(10), chr(10)), chr(13), chr(10)), chr(10))) AS ln
        FROM recs),
cut AS (SELECT ln, list_reverse(string_split(replace(ln, chr(1), chr(1) || 'e'), '"')) AS p FROM lns),
marked AS (SELECT ln, string_split(list_aggregate(list_reverse(list_transform(p, lambda x, i:
             CASE WHEN i % 2 = 1 THEN replace(x, ',', chr(1) || 's') ELSE x END)), 'string_agg', '"'),
             chr(1) || 's') AS f FROM cut),
allf AS (SELECT ln, list_transform(f, lambda x: replace(x, chr(1) || 'e', chr(1))) AS f FROM marked),
flds AS (SELECT ln, f, CASE WHEN len(f) = 1 THEN 1
           ELSE coalesce(list_max(list_transform(f, lambda x, i: CASE WHEN x <> '' THEN i END)), 0) END AS n_fields
         FROM allf)"""


def lines_word_count(text: str, where: str) -> str:
    """Word counts by (first field, word) over the physical lines."""
    tok = TOKENS_SQL["word_lower"].format(t=text)
    return f"""WITH {LINES_SQL.strip()},
toks AS (SELECT coalesce(f[1], '') AS doc_id, unnest({tok}) AS word FROM flds WHERE {where})
SELECT doc_id, word, count(*) AS frequency FROM toks GROUP BY doc_id, word"""


def oracle_sql() -> dict[str, str]:
    sql_flavor = base_ctes("word_lower", "smooth")
    rdd_flavor = base_ctes("nonword_split", "smooth")
    mr_flavor = base_ctes("nonword_split", "raw", tf_decimals=6)
    q: dict[str, str] = {}

    q["corpus_size"] = "SELECT count(*) AS n_docs FROM documents"
    q["csv_corpus_roundtrip"] = "SELECT doc_id, coalesce(text, '') AS text FROM documents"
    q["csv_corpus_split_multiline"] = q["csv_corpus_roundtrip"]
    q["csv_corpus_splittable"] = "SELECT doc_id, regexp_replace(coalesce(text, ''), '[\\r\\n]', ' ', 'g') AS text FROM documents"
    q["csv_arity_filter"] = ("SELECT doc_id, coalesce(text, '') AS text FROM documents "
                             "WHERE lang NOT IN ('fr', 'es')")
    for name, tok in [("word_count_lower", "word_lower"), ("word_count_split", "nonword_split"),
                      ("word_count_alpha", "alpha")]:
        q[name] = with_(base_ctes(tok), "SELECT doc_id, word, frequency FROM terms")
    q["doc_length"] = with_(sql_flavor, "SELECT doc_id, total_words FROM lens")
    q["term_frequency"] = with_(sql_flavor, "SELECT doc_id, word, frequency, total_words, term_frequency FROM tf")
    q["term_frequency_6dp"] = with_(
        base_ctes("word_lower", "smooth", tf_decimals=6),
        "SELECT doc_id, word, frequency, total_words, term_frequency FROM tf")
    q["term_frequency_6dp_text"] = with_(
        base_ctes("word_lower", "smooth", tf_decimals=6),
        "SELECT doc_id, word, CAST(CAST(term_frequency AS DECIMAL(18, 6)) AS VARCHAR) AS tf FROM tf")
    q["document_frequency"] = with_(sql_flavor, "SELECT word, doc_frequency FROM dfq")
    q["idf_smooth"] = with_(sql_flavor, "SELECT word, doc_frequency, round(idf, 10) AS idf FROM idf")
    q["idf_raw"] = with_(base_ctes("word_lower", "raw"),
                         "SELECT word, doc_frequency, round(idf, 10) AS idf FROM idf")
    for name, ctes in [("tfidf_sql", sql_flavor), ("tfidf_rdd", rdd_flavor), ("tfidf_mapreduce", mr_flavor)]:
        q[name] = with_(ctes, "SELECT doc_id, word, round(tf_idf, 10) AS tf_idf FROM w")
    q["tfidf_alpha_raw"] = with_(base_ctes("alpha", "raw", tf_decimals=6),
                                 "SELECT doc_id, word, round(tf_idf, 10) AS tf_idf FROM w")
    q["posting_list"] = with_(sql_flavor, """
SELECT word, doc_id // 1024 AS block,
       string_agg(CAST(doc_id AS VARCHAR), ',' ORDER BY doc_id) AS doc_ids,
       string_agg(CAST(frequency AS VARCHAR), ',' ORDER BY doc_id) AS frequencies,
       count(*) AS n_postings
FROM tf GROUP BY word, doc_id // 1024""")
    q["posting_list_string_ids"] = with_(sql_flavor + """,
nb AS (SELECT word, CAST(ceil(count(*) / 64.0) AS BIGINT) AS blocks FROM tf GROUP BY word),
placed AS (SELECT tf.word, 'd' || CAST(tf.doc_id AS VARCHAR) AS id, tf.frequency,
             CAST('0x' || substr(md5('d' || CAST(tf.doc_id AS VARCHAR)), 1, 8) AS BIGINT) % nb.blocks AS block
           FROM tf JOIN nb ON tf.word = nb.word)""", """
SELECT word, block, string_agg(id, ',' ORDER BY id) AS doc_ids,
       string_agg(CAST(frequency AS VARCHAR), ',' ORDER BY id) AS frequencies, count(*) AS n_postings
FROM placed GROUP BY word, block""")
    q["search_sum_top5"] = with_(sql_flavor + ",\nqt AS (" + literal_terms(QUERY) + ")", """
SELECT row_number() OVER (ORDER BY score DESC, doc_id) AS rank, doc_id, round(score, 8) AS score FROM (
  SELECT doc_id, list_sum(list_sort(list(w.tf_idf * qt.qtf))) AS score
  FROM w JOIN qt ON w.word = qt.word GROUP BY doc_id)
ORDER BY score DESC, doc_id LIMIT 5""")
    q["search_sum_set"] = with_(rdd_flavor + ",\nqt AS (" + literal_terms(QUERY) + ")", """
SELECT doc_id, round(sum(w.tf_idf * qt.qtf), 8) AS score
FROM w JOIN qt ON w.word = qt.word GROUP BY doc_id""")
    q["search_sum_bag"] = with_(mr_flavor + ",\nqt AS (" + literal_terms(BAG_QUERY, "bag") + ")", """
SELECT doc_id, round(sum(w.tf_idf * qt.qtf), 8) AS score
FROM w JOIN qt ON w.word = qt.word GROUP BY doc_id""")
    rows_body = """
SELECT r.rank, r.doc_id, r.word, round(r.tf_idf, 10) AS tf_idf, coalesce(d.text, '') AS text FROM (
  SELECT row_number() OVER (ORDER BY w.tf_idf DESC, doc_id, word) AS rank, doc_id, word, w.tf_idf FROM w
  WHERE word IN (SELECT word FROM qt)
  ORDER BY w.tf_idf DESC, doc_id, word LIMIT {k}) r
JOIN documents d ON r.doc_id = d.doc_id"""
    for k in (2, 5):
        q[f"search_rows_top{k}"] = with_(sql_flavor + ",\nqt AS (" + literal_terms(ROWS_QUERY) + ")",
                                         rows_body.format(k=k))
    q["store_search_rows_top5"] = q["search_rows_top5"]
    q["followup_search"] = with_(
        sql_flavor + ",\nqt AS (" + literal_terms(ROWS_QUERY) + "),\nqf AS (" + literal_terms(FOLLOWUP_QUERY) + ")",
        """
SELECT row_number() OVER (ORDER BY w.tf_idf DESC, doc_id, word) AS rank, doc_id, word, round(w.tf_idf, 10) AS tf_idf FROM w
WHERE word IN (SELECT word FROM qf)
  AND doc_id IN (SELECT doc_id FROM (
        SELECT doc_id FROM w WHERE word IN (SELECT word FROM qt)
        ORDER BY w.tf_idf DESC, doc_id, word LIMIT 5))
ORDER BY rank LIMIT 2""")
    q["vocabulary_desc_top20"] = with_(sql_flavor, """
SELECT doc_id, word, round(tf_idf, 10) AS tf_idf FROM w ORDER BY word DESC, doc_id LIMIT 20""")
    q["index_vocabulary_desc_top20"] = q["vocabulary_desc_top20"]
    q["index_prefix_words"] = with_(sql_flavor, "SELECT word, doc_frequency, round(idf, 10) AS idf FROM idf WHERE starts_with(word, 'in')")
    q["sql_text_tfidf"] = q["tfidf_sql"]
    n_tokens = {m: "len(" + TOKENS_SQL[m].format(t="coalesce(text, '')") + ")" for m in TOKENS_SQL}
    q["sql_text_tokenizers"] = (f"SELECT doc_id, {n_tokens['word_lower']} AS n_lower, {n_tokens['alpha']} AS n_alpha, "
                                f"{n_tokens['nonword_split']} AS n_split FROM documents")
    batch = """,
bt AS (SELECT DISTINCT item_id AS query_id, unnest(regexp_extract_all(lower(coalesce(text, '')), '\\w+')) AS word
       FROM benchmark),
sc AS (SELECT bt.query_id, w.doc_id, list_sum(list_sort(list(w.tf_idf))) AS score
       FROM w JOIN bt ON w.word = bt.word GROUP BY bt.query_id, w.doc_id)"""
    q["search_batch_top5"] = with_(sql_flavor + batch, """
SELECT query_id, rank, doc_id, round(score, 8) AS score FROM (
  SELECT query_id, doc_id, score,
         row_number() OVER (PARTITION BY query_id ORDER BY score DESC, doc_id) AS rank FROM sc)
WHERE rank <= 5""")
    bag_batch = """,
bt AS (SELECT query_id, word, count(*) AS qtf FROM (
         SELECT item_id AS query_id, unnest(regexp_extract_all(lower(coalesce(text, '')), '\\w+')) AS word
         FROM benchmark) GROUP BY query_id, word),
sc AS (SELECT bt.query_id, w.doc_id, list_sum(list_sort(list(w.tf_idf * bt.qtf))) AS score
       FROM w JOIN bt ON w.word = bt.word GROUP BY bt.query_id, w.doc_id)"""
    q["search_batch_bag_top5"] = with_(sql_flavor + bag_batch, """
SELECT query_id, rank, doc_id, round(score, 8) AS score FROM (
  SELECT query_id, doc_id, score,
         row_number() OVER (PARTITION BY query_id ORDER BY score DESC, doc_id) AS rank FROM sc)
WHERE rank <= 5""")
    q["index_search_sum"] = with_(sql_flavor + ",\nqt AS (" + literal_terms(QUERY) + ")", """
SELECT doc_id, round(sum(w.tf_idf * qt.qtf), 8) AS score
FROM w JOIN qt ON w.word = qt.word GROUP BY doc_id""")
    q["overwrite_index_search"] = q["save_results_roundtrip"] = q["index_search_sum"]
    old, new = (with_(f + ",\nqt AS (" + literal_terms(QUERY) + ")", f"""
SELECT '{name}' AS version, doc_id, round(sum(w.tf_idf * qt.qtf), 8) AS score
FROM w JOIN qt ON w.word = qt.word GROUP BY doc_id""") for name, f in (("before", mr_flavor), ("after", sql_flavor)))
    q["index_versions_search"] = f"({old}) UNION ALL ({new})"
    q["index_search_batch_top5"] = q["index_packed_batch_top5"] = q["search_batch_top5"]
    q["index_packed_search_sum"] = q["index_search_sum"]
    q["index_packed_tfidf"] = q["tfidf_sql"]
    q["tsv_export_import"] = with_(sql_flavor, "SELECT doc_id, word, round(tf_idf, 10) AS tf_idf FROM w")
    q["tsv_stage1_roundtrip"] = with_(rdd_flavor, """
SELECT 'a-b:' || CAST(doc_id AS VARCHAR) || ' ' AS doc_id, word, frequency, n.n AS n_docs FROM terms CROSS JOIN n""")
    q["tsv_stage2_roundtrip"] = with_(mr_flavor, "SELECT doc_id, word, term_frequency FROM tf")
    q["counts_index_search"] = with_(sql_flavor + ",\nqt AS (" + literal_terms(QUERY) + ")", """
SELECT doc_id, round(sum(w.tf_idf * qt.qtf), 8) AS score
FROM w JOIN qt ON w.word = qt.word GROUP BY doc_id""")
    q["per_doc_output_split"] = with_(rdd_flavor, "SELECT doc_id, word, frequency FROM terms")
    q["per_doc_output"] = with_(sql_flavor, "SELECT doc_id, word, frequency FROM terms")
    q["read_captured"] = q["per_doc_container"] = q["per_doc_output"]
    q["container_corpus"] = q["csv_corpus_roundtrip"]
    q["lines_corpus_word_count"] = lines_word_count("coalesce(f[10], '')", "n_fields = 10")
    q["lines_last_field_word_count"] = lines_word_count("coalesce(f[n_fields], '')", "TRUE")
    q["lines_fragment_arity"] = with_(LINES_SQL, "SELECT n_fields, count(*) AS n_lines FROM flds GROUP BY n_fields")
    q["files_corpus_tfidf"] = q["tfidf_sql"]
    emptied = "CASE WHEN lang = 'fr' THEN '' ELSE coalesce(text, '') END"
    q["files_corpus_size"] = f"SELECT count(*) AS n_files, count(*) FILTER ({emptied} = '') AS n_empty FROM documents"
    q["files_corpus_lengths"] = f"SELECT doc_id, len({TOKENS_SQL['word_lower'].format(t=emptied)}) AS total_words FROM documents"
    q["stream_index_search_sum"] = q["index_search_sum"]
    conv = base_ctes("word_lower", "smooth", table="conversations", id_col="conv_id", multi_row=True)
    q["conversation_word_count"] = with_(conv, "SELECT doc_id, word, frequency FROM terms")
    q["conversation_tfidf"] = with_(conv, "SELECT doc_id, word, round(tf_idf, 10) AS tf_idf FROM w")
    return q
