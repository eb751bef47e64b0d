"""CSV corpus edge cases (FIXTURES 2)."""
import pytest

from docrank import TfIdf
from docrank.sources import corpus as src

COLS = ["c0", "id", "c2", "c3", "c4", "c5", "c6", "c7", "c8", "content"]
HEADER = ",".join(COLS)


def row(id_, content, extra=""):
    return f"x,{id_},a,b,c,d,e,f,g,{content}{extra}"


CSV = "\n".join([
    HEADER,
    row("r1", '"Hello, how\'s it - are you"'),
    row("r2", '"He said ""hi, there"" now"'),
    row("r3", '"first line\nsecond line"'),
    row("r4", ""),
    "",
    row("r5", "The the THE"),
    "x,r6,a,b",                                  # too few fields
    row("r7", "long", ",extra"),                 # too many fields
    row("a-b:c", "id with dash and colon"),
]) + "\n"


@pytest.fixture
def csv_dir(spark, tmp_out):
    path = tmp_out("csvfix")
    spark.createDataFrame([(CSV,)], "value string").coalesce(1).write.text(path)
    return path


def texts(df):
    return {r["doc_id"]: r["text"] for r in df.collect()}


def test_quoting_and_multiline(spark, csv_dir):
    t = texts(src.read_csv_corpus(spark, csv_dir, COLS))
    assert t["r1"] == "Hello, how's it - are you"
    assert t["r2"] == 'He said "hi, there" now'
    assert t["r3"] == "first line\nsecond line"
    assert t["r4"] == ""                    # null -> ''
    assert t["a-b:c"] == "id with dash and colon"
    assert "r6" in t and "r7" in t          # kept without the arity filter
    assert len(t) == 8                      # blank line skipped


def test_strict_arity(spark, csv_dir):
    t = texts(src.read_csv_corpus(spark, csv_dir, COLS, strict_arity=True))
    assert "r6" not in t and "r7" not in t
    assert {"r1", "r2", "r3", "r4", "r5", "a-b:c"} <= set(t)


def test_empty_text_counts_in_n(spark, csv_dir):
    c = src.read_csv_corpus(spark, csv_dir, COLS, strict_arity=True)
    m = TfIdf(c, tokenizer="nonword_split")
    assert m.corpus_size().first()["n_docs"] == 6
    wc = {(r["doc_id"], r["word"]): r["frequency"] for r in m.word_count().collect()}
    assert wc[("r4", "")] == 1               # one empty word under nonword_split
    assert wc[("r5", "The")] == 1 and wc[("r5", "THE")] == 1
    lower = {(r["doc_id"], r["word"]): r["frequency"] for r in TfIdf(c).word_count().collect()}
    assert lower[("r5", "the")] == 3
    assert not any(d == "r4" for d, _ in lower)


def test_duplicate_and_null_ids(spark):
    c = spark.createDataFrame([("a", "x"), ("a", "y"), (None, "z"), ("b", "w")], "doc_id string, text string")
    bad = {r["doc_id"] for r in src.duplicate_ids(c).collect()}
    assert bad == {"a", None}
    with pytest.raises(ValueError):
        src.check_unique_ids(c)


def test_lines_corpus(spark, tmp_out):
    path = tmp_out("lines")
    lines = [row("l1", '"a, b"'), "x,l2,short", row("l3", "plain text")]
    spark.createDataFrame([(x,) for x in lines], "value string").coalesce(1).write.text(path)
    t = texts(src.read_lines_corpus(spark, path, n_fields=10, id_index=1, text_index=9))
    assert t == {"l1": "a, b", "l3": "plain text"}


def test_files_corpus_and_count(spark, tmp_path):
    for name, body in [("2118_9.txt-m-00001", "A b A"), ("2469_10.txt-m-00555", "Hamlet\n")]:
        (tmp_path / name).write_text(body)
    c = src.read_files_corpus(spark, str(tmp_path))
    assert texts(c) == {"2118_9": "A b A", "2469_10": "Hamlet\n"}
    raw = spark.read.text(str(tmp_path), wholetext=True)
    assert src.count_input_files(raw).first()["n_files"] == 2


def test_parse_csv_lines_in_a_column(spark):
    lines = spark.createDataFrame([('1,"a, ""b""",c',), ("2,x",)], "line string")
    rows = src.parse_csv_lines(lines, "line", ["id", "body", "tail"]).orderBy("id").collect()
    assert (rows[0]["id"], rows[0]["body"], rows[0]["tail"], rows[0]["n_fields"]) == ("1", 'a, "b"', "c", 3)
    assert rows[1]["n_fields"] == 2 and rows[1]["tail"] is None


def test_lines_corpus_last_field(spark, tmp_out):
    path = tmp_out("lines-last")
    lines = ['a1,x,"last, one"', "a2,only", 'a3,p,q,r,"fourth ""f"""']
    spark.createDataFrame([(x,) for x in lines], "value string").coalesce(1).write.text(path)
    t = texts(src.read_lines_corpus(spark, path, id_index=0, text_index=-1, strict_arity=False))
    assert t == {"a1": "last, one", "a2": "only", "a3": 'fourth "f"'}


def test_original_variants_from_lines(spark, tmp_out):
    import math

    from docrank.operators import search as S
    path = tmp_out("variants")
    lines = ["id,a,b,c,d,e,f,g,h,content", "r1,a,b,c,d,e,f,g,h,the cat",
             "r2,a,b,c,d,e,f,g,h,the dog the", "frag,ment"]
    spark.createDataFrame([(x,) for x in lines], "value string").coalesce(1).write.text(path)
    # RDD program: every physical line is a document, text = last field
    rdd_corpus = src.read_lines_corpus(spark, path, text_index=-1, strict_arity=False)
    m = TfIdf.flavor(rdd_corpus, "rdd")
    assert m.corpus_size().first()["n_docs"] == 4
    scores = {r["doc_id"]: r["score"] for r in S.search_sum(m, spark, "the", "nonword_split").collect()}
    assert set(scores) == {"r1", "r2"}
    # MapReduce jobs: ten-field records only, fixed N, bag weighting
    mr_corpus = src.read_lines_corpus(spark, path, n_fields=10, id_index=0, text_index=9)
    mr = TfIdf.flavor(mr_corpus, "mapreduce", n=53291)
    got = {r["doc_id"]: r["score"] for r in S.search_sum(mr, spark, "the the", "nonword_split", "bag").collect()}
    want_r1 = 2 * round(1 / 2, 6) * math.log(53291 / 2)
    assert abs(got["r1"] - round(want_r1, 8)) < 1e-8


def test_line_fields_of_wide_and_broken_lines(spark):
    wide = ",".join(f"f{i}" for i in range(71)) + ",final words"
    lines = [wide, 'r3,x,"open quote, tail words', "a,b,,", ""]
    df = spark.createDataFrame([(x,) for x in lines], "value string")
    got = [r.f for r in df.select(src.line_fields(df.value).alias("f")).collect()]
    assert len(got[0]) == 72 and got[0][-1] == "final words"
    # an odd number of quotes: only commas that an even number follows separate
    assert got[1] == ['r3,x,"open quote', " tail words"]
    assert got[2] == ["a", "b"] and got[3] == [""]


def test_csv_single_line_mode_splits_a_large_file(spark, tmp_out):
    path = tmp_out("big-csv")
    spark.range(60_000).selectExpr("id", "repeat('word ', 10) as content").coalesce(1).write.option("header", "true").csv(path)
    size = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "256k")
    try:
        whole = src.read_csv_corpus(spark, path, ["id", "content"])
        cut = src.read_csv_corpus(spark, path, ["id", "content"], multi_line=False)
        assert whole.rdd.getNumPartitions() == 1 and cut.rdd.getNumPartitions() > 4
        assert cut.count() == whole.count() == 60_000
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", size)


def test_empty_files_are_documents(spark, tmp_path):
    for name, body in [("a 1.txt", "x y"), ("b.txt", ""), ("c%20d.txt", ""), ("_hidden.txt", "no")]:
        (tmp_path / name).write_text(body)
    raw = spark.read.text(str(tmp_path), wholetext=True)
    assert src.count_input_files(raw).first()["n_files"] == 3
    assert texts(src.read_files_corpus(spark, str(tmp_path))) == {"a%201": "x y", "b": "", "c%2520d": ""}
    m = TfIdf(src.read_files_corpus(spark, str(tmp_path)), n=src.n_input_files(raw))
    assert m.weights.count() == 2 and m.corpus_size().first()["n_docs"] == 3
