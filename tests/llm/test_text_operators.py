"""Personal data, language identification, source mix and language model."""
import hashlib
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from docrank.llm import ctw, lang_id, mixing, pii
from docrank.llm.queries import op5_ctw, op6_pivotal_mix, op9_pii, op10_language_id

from .conftest import HARD, documents, save

SF = "/root/testdata/sf0.001"
BASE = {  # the plain forms
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]"}


def luhn(d):
    return sum(int(c) if i % 2 == 0 else (int(c) * 2 - 9 * (int(c) > 4)) for i, c in enumerate(reversed(d))) % 10 == 0


def base_spans(text):
    out = []
    for order, (kind, pattern) in enumerate(BASE.items()):
        for m in re.finditer(pattern, text):
            s, d = m.group(), re.sub("[^0-9]", "", m.group())
            if {"email": True, "ip": kind == "ip" and all(int(p) <= 255 for p in s.split(".")),
                    "card": 14 <= len(d) <= 19 and luhn(d), "phone": 10 <= len(d) <= 15}[kind]:
                out.append((m.start(), order, kind, m.end()))
    return ",".join(f"{k}:{a}:{b}" for a, _, k, b in sorted(out))


def pii_texts():
    r = random.Random(4)
    parts = ["a.b@c.de", "x@y", "1.2.3.4", "300.1.1.1", "1.2.3.4.5.6.7.8", "4111 1111 1111 1111", "4111-1111-1111-1112", "+1 (234) 555-0199",
             "+12", "é", " ", ".", "-", "@", "%", "9", "00", "a", "+", "\n", "(", "0012.000255.1.0", "378282246310005", "🙂"]
    texts = ["".join(r.choices(parts, k=r.randint(0, 25))) for _ in range(600)]
    return texts + ["a" * 5_000, "9" * 20_000, "1 " * 20_000, "+1" + " " * 50_000, "a@b." * 2_000, "", "mail me: x@y.org"]


def test_base_spans(spark, tmp_path):
    rows = HARD + [(100 + i, t) for i, t in enumerate(pii_texts())]
    got = Counter((r.doc_id, r.base_sha256, r.n_email + r.n_ip + r.n_card + r.n_phone)
                  for r in op9_pii(spark, save(documents(spark, rows), tmp_path, "documents")).collect())
    want = Counter()
    for d, t in rows:
        s = base_spans(t or "")
        want[d, hashlib.sha256(s.encode()).hexdigest(), s.count(":") // 2] += 1
    assert got == want


def test_method_adds_spans_and_scores(spark):
    docs = documents(spark, [(1, "IBAN DE89 3704 0044 0532 0130 00 here"), (2, "IBAN DE89 3704 0044 0532 0130 01 here"),
                             (3, "my SSN is 123-45-6789 ok"), (4, "part 123-45-6789 ok"), (5, "call +1 (234) 555-0199"), (6, "x +1 (234) 555-0199")])
    got = {r.doc_id: r.pii for r in pii.find_pii(docs).collect()}
    assert [s.kind for s in got[1]] == ["iban"] and not [s for s in got[2] if s.kind == "iban"]
    assert [s.kind for s in got[3]] == ["ssn"] and got[4] == []
    assert got[5][0].score > got[6][0].score
    red = {r.doc_id: r.text for r in pii.redact(pii.find_pii(docs)).collect()}
    assert red[3] == "my SSN is <ssn> ok" and red[4] == "part 123-45-6789 ok" and red[5] == "call <phone>"


def test_redaction_covers_overlaps_and_nulls(spark):
    rows = HARD + [(20, "x +30569309025904 y")]
    out = {r.doc_id: r.text for r in pii.redact(pii.find_pii(documents(spark, rows))).collect()}
    assert out[20] == "x <phone> y"        # phone and card, the phone begins first
    assert out[2] is None and out[3] == "" and out[8] == "word " * 30_000
    assert out[5] == "<email> and <ip>, <phone>"


def test_language(spark, tmp_path):
    got = op10_language_id(spark, SF).collect()
    lang = {r.doc_id: r.lang for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    held = [r for r in got if r.held_out]
    assert len(got) == len(lang) and all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1) for r in got)
    assert np.mean([r.lang_pred == lang[r.doc_id] for r in held]) > 0.97
    assert all(0 <= r.score <= 1 for r in got)
    rows = HARD + [(50, "1234 !?")]
    hard = op10_language_id(spark, save(documents(spark, rows), tmp_path, "documents")).collect()
    und = {r.doc_id for r in hard if r.lang_pred == "und"}
    assert len(hard) == len(rows) and {2, 3, 4, 50} <= und and not und & {1, 7, 8, 9}


def test_language_backoff(spark):
    rows = [(i, t, lang) for i, (t, lang) in enumerate([("the house is big", "en"), ("das haus ist gross", "de")] * 5)]
    m = lang_id.fit(documents(spark, rows))
    assert "haus" in m["rows"][0] and "hausen" not in m["rows"][0]
    best = {w: m["langs"][int(np.argmax(lang_id.word_score(m, w)))] for w in ("hausen", "housing", "the")}
    assert best == {"hausen": "de", "housing": "en", "the": "en"}
    assert lang_id.fit(documents(spark, [(1, None, "en"), (2, "x", None)]))["langs"] == []


def test_mix_targets():
    assert mixing.targets([], []) == []
    assert mixing.targets([10, 10, 10], [1, 2, 3]) == [5, 10, 15]
    got = mixing.targets([100, 1, 100], [1, 2, 3])          # the second stops at 3
    assert got[1] == 3 and math.isclose(sum(got), 201) and math.isclose(got[2], 3 * got[0])
    assert mixing.targets([0, 0], [1, 2]) == [0, 0]


def test_pivotal_rounding_keeps_sum_and_expectation():
    size, mass = [50, 40, 20, 10, 5, 3], [20, 30, 5, 4, 2.5, 1]
    r, total = random.Random(3), np.zeros(6)
    for _ in range(20_000):
        out = mixing.pivot(size, mass, [r.random() for _ in size])
        assert math.isclose(sum(out), sum(mass), abs_tol=1e-6)
        assert sum(0 < x < s for x, s in zip(out, size)) <= 1
        total += out
    assert np.allclose(total / 20_000, mass, rtol=0.05, atol=0.05)


@pytest.mark.parametrize("group_rows", [4, 4096])
def test_mix(spark, group_rows):
    r = random.Random(8)
    rows = [(i, "w " * (r.randint(0, 30) if r.random() < 0.9 else 300), "en", r.choice(["a", "a", "a", "b", "Z", None])) for i in range(800)]
    rows += rows[:5] + [(None, None, "en", "a"), (900, "", "en", "empty")]
    docs = documents(spark, rows)
    out = mixing.mix(docs, group_rows=group_rows).collect()
    again = mixing.mix(docs.repartition(7), group_rows=group_rows).collect()
    assert sorted(map(str, out)) == sorted(map(str, again)) and len(out) == len(rows)
    by = {}
    for x in out:
        v = by.setdefault(x.source, [0, 0, x.mix.target, 0])
        v[0] += x.mix["size"]
        v[1] += x.mix["size"] * x.mix.copies
        v[3] = max(v[3], x.mix["size"])
        assert x.mix["size"] == len((x.text or "").split()) and 0 <= x.mix.copies <= 3 and x.mix.source_size is not None
    names = sorted(by, key=lambda s: (s is None, s or ""))
    assert [round(by[s][2], 6) for s in names] == [round(t, 6) for t in mixing.targets([by[s][0] for s in names], [1, 2, 3, 1, 2][:len(names)])]
    assert all(abs(v[1] - v[2]) <= v[3] for v in by.values())


def test_mix_of_many_repeated_rows(spark):
    """Rows of one id and text are dealt in groups too, and reruns agree."""
    rows = [(7, "a b c", "en", "x")] * 900 + [(None, None, "en", "x")] * 50 + [(i, "w " * (i % 9), "en", "yz"[i % 2]) for i in range(300)]
    docs = documents(spark, rows)
    sized = mixing.store(mixing._sized(docs.repartition(5).select("doc_id", "text"), "doc_id", "text"), "sizes").select(
        F.col("__rid").alias("rid"), F.col("__key").alias("key"))
    split = mixing.split_repeats(sized, 64).groupBy("key").count().collect()
    assert max(r["count"] for r in split) <= 64 and sum(r["count"] for r in split) == len(rows)
    assert sorted(r["count"] for r in split)[-15:] == [50] + [64] * 14
    out = sorted(str((r.doc_id, r.mix)) for r in mixing.mix(docs, group_rows=32).collect())
    assert out == sorted(str((r.doc_id, r.mix)) for r in mixing.mix(docs.repartition(3), group_rows=32).collect())


def test_mix_columns_against_plain_sums(spark):
    """Size, source size and target of the query by hand; what is taken comes near the target."""
    rows = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text", "source").collect()
    size = {r.doc_id: len((r.text or "").encode().split()) for r in rows}
    total = Counter()
    for r in rows:
        total[r.source] += size[r.doc_id]
    names = sorted(total, key=lambda s: (s is None, s or ""))
    weight = {s: 1 + i % 3 for i, s in enumerate(names)}
    goal, open_names, left = {}, list(names), float(sum(total.values()))
    while open_names:          # stop those above three times their size, share the rest again
        share = {s: left * weight[s] / sum(weight[t] for t in open_names) for s in open_names}
        over = [s for s in open_names if share[s] > 3 * total[s]]
        if not over:
            goal.update(share)
            break
        for s in over:
            goal[s] = 3.0 * total[s]
            left -= goal[s]
            open_names.remove(s)
    got = op6_pivotal_mix(spark, SF).collect()
    source = {r.doc_id: r.source for r in rows}
    taken = Counter()
    for r in got:
        s = source[r.doc_id]
        assert (r["size"], r.source_size) == (size[r.doc_id], total[s]) and math.isclose(r.target, goal[s], rel_tol=1e-12)
        # whole copies, one of the two numbers around the share of the source
        assert r.taken in {math.floor(goal[s] / total[s]) * r["size"], math.ceil(goal[s] / total[s]) * r["size"]}
        taken[s] += r.taken
    assert all(abs(taken[s] - goal[s]) <= max(size[d] for d in size if source[d] == s) for s in names)


def test_mix_query(spark, tmp_path):
    rows = op6_pivotal_mix(spark, SF).collect()
    assert len(rows) == spark.read.parquet(f"{SF}/documents.parquet").count()
    assert all(r.taken <= 3 * r["size"] for r in rows)
    empty = op6_pivotal_mix(spark, save(documents(spark, HARD).limit(0), tmp_path, "documents"))
    assert empty.collect() == [] and empty.columns == ["doc_id", "size", "source_size", "target", "taken"]


def test_language_scores_against_a_plain_scorer(spark):
    """Every word of every document scored from plain counts."""
    rows = [(r.doc_id, r.text, r.lang) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    train = [(t, lang) for d, t, lang in rows if zlib.crc32(str(d).encode()) % 3 != 1 and t and lang]
    langs = sorted({lang for _, lang in train})
    counts = {(lang, n): Counter() for lang in langs for n in range(6)}
    for t, lang in train:
        for w in re.findall(r"[^\W\d_]+", t.lower()):
            counts[lang, 0][w] += 1
            for n in range(1, 6):
                s = f" {w} " if n > 1 else w
                counts[lang, n].update(s[i:i + n] for i in range(len(s) - n + 1))
    kept = {}
    for (lang, n), c in counts.items():
        most, ranks = (30_000 if n == 0 else 10_000), sorted(c.values(), reverse=True)
        least = ranks[-1] if len(ranks) <= most else ranks[most] + 1      # all of one count stay or go
        kept[lang, n] = {k: v for k, v in c.items() if v >= least}

    def level(n, key):
        if not any(key in kept[lang, n] for lang in langs):
            return None
        return np.array([math.log(kept[lang, n].get(key, 0.5)) - math.log(sum(counts[lang, n].values()) + 1) for lang in langs])

    def word(w):
        known = level(0, w)
        for n in range(5, 0, -1):
            if known is None:
                s = f" {w} " if n > 1 else w
                found = [x for x in (level(n, s[i:i + n]) for i in range(len(s) - n + 1)) if x is not None]
                known = np.mean(found, axis=0) - 0.5 * (6 - n) if found else None
        return known if known is not None else np.zeros(len(langs))

    memo, want = {}, {}
    for d, t, _ in rows:
        words = re.findall(r"[^\W\d_]+", (t or "").lower())
        total = sum((memo.setdefault(w, word(w)) if w not in memo else memo[w] for w in words), np.zeros(len(langs)))
        p = np.exp((total - total.max()) / max(1, len(words)))
        want[d] = (langs[int(total.argmax())], p.max() / p.sum()) if words else ("und", 0.0)
    for r in op10_language_id(spark, SF).collect():
        assert r.lang_pred == want[r.doc_id][0] and math.isclose(r.score, want[r.doc_id][1], rel_tol=1e-9)


def test_lookup_by_hash():
    r = np.random.default_rng(4)
    keys = np.unique(r.integers(0, 2**48, 5_000))
    table = ctw.Lookup(keys, keys * 0.5)
    asked = np.r_[keys, keys + 1, [0, 2**48]]
    value, known = table(asked)
    held = set(keys.tolist())
    assert known.tolist() == [k in held for k in asked.tolist()] and (value == np.where(known, asked * 0.5, 0)).all()
    value, known = ctw.Lookup(np.empty(0, np.int64), np.empty(0))(asked)
    assert not known.any() and not value.any()


@pytest.mark.parametrize("hot", [5, 200_000])
def test_language_model(spark, tmp_path, hot, monkeypatch):
    monkeypatch.setattr(ctw, "HOT_WORDS", hot)
    rows = HARD + [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").collect() if r.doc_id > 20]
    docs = documents(spark, rows).select("doc_id", "text", ctw.held_out().alias("held_out"))
    got = ctw.score(docs, ctw.fit(docs.where("not held_out"), hot_words=hot)).collect()
    toks = [[w.lower() for w in re.findall(rb"[^\x20\x09-\x0D]+", (t or "").encode())] + [b"\n"] for _, t in rows]
    held = [zlib.crc32(("" if d is None else str(d)).encode()) % 7 == 2 for d, _ in rows]
    c = Counter(w for t, h in zip(toks, held) if not h for w in t)
    n, v = sum(c.values()), len(c)
    want = sorted((str(d), h, len(t), sum(c[w] > 0 for w in t), n, round(sum(math.log10((c[w] + 1) / (n + v + 1)) for w in t), 6))
                  for (d, _), t, h in zip(rows, toks, held))
    assert sorted((str(r.doc_id), r.held_out, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 6)) for r in got) == want
    assert all(r.score < 0 and r.bits_per_byte > 0 for r in got)
    prose = [r for r in got if r.held_out and r.n_tokens > 100]
    assert np.mean([r.bits_per_byte for r in prose]) < 3.5     # eight without a model


def test_context_levels_of_real_bytes_against_plain_weighting(spark, monkeypatch):
    r = random.Random(8)
    texts = [" ".join(r.choices(["дом", "дым", "том", "17", "71", "a-b", "a+b", "東京", "the"], k=30)) for _ in range(30)]
    rows = list(enumerate(texts)) + [(100, texts[0] + " вот 99"), (101, ""), (102, None)]
    docs = documents(spark, rows).select("doc_id", "text")
    train = [t.lower().encode() for t in texts]
    grams = np.concatenate([g for _, _, g, _ in ctw.grams(train)])
    plain = Counter()
    paths = {}

    def path(gram):
        cell, out = int(ctw.cells_of(np.array([gram]))[0]) >> 8, []
        for depth in range(17):
            out.append((depth, cell >> (16 - depth)))
        return out + [(14 + size, gram >> 8 * (ctw.LAST + 1 - size)) for size in range(3, ctw.LAST + 1)]

    for g in grams.tolist():
        p = paths.setdefault(g, path(g))
        for bit in range(8):
            for c in p:
                plain[c, (1 << bit) | ((g & 255) >> (8 - bit)), ((g & 255) >> (7 - bit)) & 1] += 1
    kids = {}
    for p in paths.values():
        for a, b in zip(p, p[1:]):
            kids.setdefault(a, set()).add(b)
    memo = {}

    def block(c, node):
        a, b = plain[c, node, 0], plain[c, node, 1]
        return math.lgamma(a + .5) + math.lgamma(b + .5) - 2 * math.lgamma(.5) - math.lgamma(a + b + 1)

    def weighted(c, node):
        if (c, node) not in memo:
            e = block(c, node)
            if c[0] < 14 + ctw.LAST and plain[c, node, 0] + plain[c, node, 1]:
                e = np.logaddexp(e, sum(weighted(k, node) for k in kids.get(c, ()))) - math.log(2)
            memo[c, node] = e
        return memo[c, node]

    def log_p(gram):
        total = 0.0
        for bit in range(8):
            node, one, done, rest = (1 << bit) | ((gram & 255) >> (8 - bit)), ((gram & 255) >> (7 - bit)) & 1, 0.0, 1.0
            for c in path(gram):
                a, b = plain[c, node, 0], plain[c, node, 1]
                share = 1.0 if c[0] == 14 + ctw.LAST else math.exp(block(c, node) - math.log(2) - weighted(c, node))
                done, rest = done + rest * share * (b + .5) / (a + b + 1), rest * (1 - share)
            total += math.log10(done if one else 1 - done)
        return total

    known = {}
    want = {}
    for d, t in rows:
        g = np.concatenate([g for _, _, g, _ in ctw.grams([(t or "").lower().encode()])]).tolist()
        want[d] = sum(known.setdefault(x, log_p(x)) if x not in known else known[x] for x in g)
    for hot in (1_000_000, 50, 0):
        monkeypatch.setattr(ctw, "HOT_GRAMS", hot)
        got = {r.doc_id: r.score for r in ctw.score(docs, ctw.fit(docs.where("doc_id < 100"))).collect()}
        assert all(math.isclose(got[d], want[d], rel_tol=1e-4, abs_tol=1e-4) for d in want)


def test_contexts_grow_with_the_corpus(spark):
    # these differ in what the classes fold: digits, punctuation, letters of other scripts
    docs = documents(spark, [(i, f"{i % 7}{i % 5}{i % 3}+-дж{i}") for i in range(400)]).select("doc_id", "text")
    model = ctw.fit(docs)
    grams = model["grams"].count()
    assert grams > 400 and ctw.fit(docs.where("doc_id < 40"))["grams"].count() < grams / 2
    twins = documents(spark, [(1, "12" * 200), (2, "31" * 200)]).select("doc_id", "text")
    got = {r.doc_id: r.score for r in ctw.score(twins, ctw.fit(twins.where("doc_id = 1"))).collect()}
    assert got[1] > got[2] / 4


def test_language_model_without_training(spark):
    docs = documents(spark, [(1, "ab"), (2, "")]).select("doc_id", "text")
    got = {r.doc_id: r for r in ctw.score(docs, ctw.fit(docs.limit(0))).collect()}
    assert math.isclose(got[1].bits_per_byte, 8, abs_tol=1e-4) and got[1].base_score == 0 and got[1].n_known == 0
    assert math.isclose(got[2].score, -8 * math.log10(2), abs_tol=1e-4)


@pytest.mark.parametrize("query", [op5_ctw, op9_pii, op10_language_id])
def test_empty_table(spark, tmp_path, query):
    assert query(spark, save(documents(spark, [(1, "x")]).limit(0), tmp_path, "documents")).collect() == []
