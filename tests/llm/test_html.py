"""Main text of pages: the network against plain formulas, labelled and hand-made pages,
and a plain reader of the table's own layout."""
import html
import re

import numpy as np
import pytest

from docrank.llm import html_blocks as H
from docrank.llm.queries import op11_block_labeller

SF = "/root/testdata/sf0.001"
PAGES = "page_id long, url string, html string"


@pytest.fixture(scope="module")
def net():
    return H.trained()


def plain_article(page):
    """Blocks of the article element of the table's pages, by patterns."""
    art = re.search(r"<article>(.*?)</article>", page, re.S)[1]
    blocks = (" ".join(html.unescape(re.sub("<[^>]*>", " ", x)).split()) for x in re.split(r"</?(?:p|h1)>", art))
    return "\n\n".join(b for b in blocks if b)


def test_pages_of_the_table(spark):
    want = {r.page_id: plain_article(r.html) for r in spark.read.parquet(f"{SF}/pages.parquet").collect()}
    got = op11_block_labeller(spark, SF)
    assert got.columns == ["page_id", "url", "text", "n_chars"]
    rows = got.collect()
    assert {r.page_id: r.text for r in rows} == want and all(r.n_chars == len(r.text) for r in rows)


def test_held_out_pages(net):
    rng = np.random.default_rng(77)
    data = [x for x in (H.labelled(H.training_page(rng)) for _ in range(300)) if x[0]]
    y = np.concatenate([y for _, y in data]) > 0
    assert ((net.probabilities([b for b, _ in data]) > 0.5) == y).mean() > 0.985
    assert 0.2 < y.mean() < 0.8


def test_training_is_repeatable():
    a, b = H.train(40, 2), H.train(40, 2)
    assert all((a.weights[k] == b.weights[k]).all() for k in a.weights)


def test_states_against_plain_recurrence():
    net, rng = H.Labeller(7, hidden=3), np.random.default_rng(1)
    lengths = np.array([2, 5, 1, 5])
    x = rng.normal(size=(lengths.sum(), 7)).astype(np.float32)
    got, at = net.states(net.project(x), lengths), 0
    sig = lambda v: 1 / (1 + np.exp(-v))
    for n in lengths:
        z = net.project(x[at:at + n])
        for d, order in ((0, range(n)), (1, range(n - 1, -1, -1))):
            h = c = np.zeros(3)
            for t in order:
                i, f, o, g = np.split(z[t, 12 * d:12 * d + 12] + h @ net.weights[f"u{d}"], 4)
                c = sig(f) * c + sig(i) * np.tanh(g)
                h = sig(o) * np.tanh(c)
                assert np.allclose(got[at + t, 3 * d:3 * d + 3], h, atol=1e-5)
        at += n


def test_gradients_against_differences():
    net, rng = H.Labeller(4, hidden=2), np.random.default_rng(2)
    net.weights = {k: v.astype(np.float64) for k, v in net.weights.items()}
    lengths, x = np.array([3, 1, 4]), rng.normal(size=(8, 4))
    y = np.array([1, 0, 1, 0, 1, 1, 0, 0.0])

    def loss():
        p = H._sigmoid(net.states(net.project(x), lengths) @ net.weights["v"] + net.weights["a"])
        return -(y * np.log(p) + (1 - y) * np.log(1 - p)).mean()
    grad = net.gradients(x, y, lengths)
    for k, w in net.weights.items():
        for at in [tuple(rng.integers(s) for s in w.shape) for _ in range(6)]:
            old = w[at]
            w[at] = old + 1e-4
            up = loss()
            w[at] = old - 1e-4
            down = loss()
            w[at] = old
            assert abs((up - down) / 2e-4 - grad[k][at]) < 1e-5, k


STORY = ["The story begins here.", "A second paragraph, with a link inside it & a quote \"as said\".", "It ends with a third one, somewhat longer than the others were."]
BODY = (f"<h1>{STORY[0]}</h1><p>A second   paragraph, with a <a href='/x'>link</a> inside it &amp; a\n quote &quot;as said&quot;.</p>"
        f"<p>{STORY[2]}</p>")
CHROME = ("<div class='cookie-notice'><p>We use cookies to improve your experience.</p><button>Accept all</button></div>"
          "<nav class=menu><ul><li><a href=/>Home</a><li><a href=/n>News</a></ul></nav>")
AFTER = ("<div id='comments'><h3>2 comments</h3><div class='comment'><p>Great post, thanks for writing it!</p></div></div>"
         "<aside class='sidebar'><h4>Related articles</h4><ul><li><a href=/1>Something else entirely</a></li></ul></aside>"
         "<form class='newsletter'><label>Subscribe to our newsletter</label><input><button>Submit</button></form>"
         "<div class='ad'>Advertisement Buy now</div><footer>&copy; 2024 All rights reserved</footer>")


@pytest.mark.parametrize("page", [
    f"<html><head><title>T</title></head><body>{CHROME}<article>{BODY}</article>{AFTER}</body></html>",
    f"<html><body><header class='site-header'>Welcome</header>{CHROME}<main><div class='post-content'>{BODY}</div></main>{AFTER}",
    f"<body><div class='wrapper'>{CHROME}<div class='entry-content'>{BODY}<script>var x = '<p>no</p>';</script></div>{AFTER}</div></body>",
    f"{CHROME}<!-- <p>not shown</p> --><ARTICLE>{BODY}<div class='ad'>Sponsored Shop now</div></ARTICLE>{AFTER}",
])
def test_hand_made_pages(net, page):
    assert H.extract([page], net) == ["\n\n".join(STORY)]


def test_blocks_of_odd_markup():
    text = lambda page: [b.text for b in H.leaf_blocks(page)]
    assert text("") == [] and text("plain &amp; simple") == ["plain & simple"]
    assert text("<p>one<p>two<li>three</p>four") == ["one", "two", "three", "four"]
    assert text("<p>a<br>b <b>c</b>d</p></div></p>e") == ["a b cd", "e"]
    assert text("a<!-- x <p> y") == ["a"] and text("a<script>if (1 < 2) '</p>'") == ["a"]
    assert text("<p title='a > b'>x</p><style>p{}</style>y < z <3") == ["x", "y < z <3"]
    assert text("<p>&nbsp; &#x41;&unknown;  </p><p> </p>") == ["A&unknown;"]
    assert text("<textarea>no</textarea><svg><text>no</text></svg>yes") == ["yes"]
    deep = "<div>" * 3_000 + "deep" + "</div>" * 3_000
    assert text(deep) == ["deep"]


def test_hard_rows(spark, tmp_path):
    long_page = "<article>" + "<p>A paragraph of the long story, as it goes on.</p>" * 20_000 + "</article>"
    rows = [(1, "u", None), (2, None, ""), (None, "v", f"<article>{BODY}</article>"), (3, "w", "<nav><a href=/>Home</a></nav>"),
            (4, "x", f"{CHROME}<article>{BODY}</article>"), (4, "x", f"{CHROME}<article>{BODY}</article>"), (5, "y", long_page), (6, "z", "<<<>>>< / ><a"), (7, "q", "\x00퟿")]
    from pyspark.sql import functions as F
    pages = spark.createDataFrame(rows, PAGES).withColumns({c: F.lit("z") for c in ("text", "n_chars", "run")})
    got = sorted(((r.page_id or 0, r.text, r.n_chars) for r in H.text_report(pages).collect()))
    by = {i: t for i, t, _ in got}
    assert [i for i, _, _ in got] == [0, 1, 2, 3, 4, 4, 5, 6, 7] and all(n == len(t) for _, t, n in got)
    assert by[0] == by[4] == "\n\n".join(STORY) and by[1] == by[2] == by[3] == ""
    assert by[5].count("\n\n") == 19_999
    assert H.text_report(pages.limit(0)).collect() == []
