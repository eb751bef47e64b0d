"""Main text of web pages by a recurrent block labeller.

A page is read as the sequence of its leaf blocks: the pieces of visible text between
block-level tags.  Each block is a hashed vector of its tag path (names, classes, ids and
roles of all open elements), a hashed vector of its words, and a few shares (links,
length, sentence ends).  A bidirectional LSTM reads the whole sequence, so that a block is
judged by what stands anywhere before and after it, and gives each block the
probability that it belongs to the article.

The model is trained here, in numpy, on ``TRAIN_PAGES`` pages of ``training_page``: random
layouts whose parts are known to be article or not (menus, headers, footers, sidebars,
notices, adverts, forms, share bars, comments), in semantic and in plain markup, with
random words, so that it learns from structure and from cue words and not from a
vocabulary.  It depends on no table, is the same at every size, and is broadcast (less
than a megabyte).  Pages are independent: the work is map side only.

Defined results: character references are decoded; white space within a block becomes
one space; blocks without text are left out; blocks are joined in page order by an empty
line.  A page that is null, empty or without article text has an empty text and 0
characters; script, style, head, comments and other invisible markup never count as
text; unclosed and misnested markup is read as it stands.  Pages of any length are read
whole, in linear time; rows are independent, so repeated rows and null ids pass through;
an empty table gives an empty result; columns other than the named ones are ignored.
"""

from __future__ import annotations

import html
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

TRAIN_PAGES = 1_800
EPOCHS = 10
HIDDEN = 20                # of each direction
PATH_DIM = 320
WORD_DIM = 64
SHARES = 5
SLICE_ROWS = 64            # pages that a task labels together
PART_BLOCKS = 4_096        # blocks whose vectors are dense at a time
CACHE_ENTRIES = 200_000

# Elements of HTML
BLOCKS = frozenset("""address article aside blockquote body button caption center dd details dialog dir div dl dt
fieldset figcaption figure footer form frameset h1 h2 h3 h4 h5 h6 head header hgroup hr html label legend li main menu
nav ol optgroup option p pre search section select summary table tbody td tfoot th thead tr ul""".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
# the content of these is no visible text
HIDDEN_CONTENT = frozenset("script style title textarea noscript template iframe object svg canvas audio video math".split())
# an element of the second kind that opens ends an open one of the first
ENDS = {"p": BLOCKS - {"button", "label", "body"}, "li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "option": {"option", "optgroup"},
        "tr": {"tr", "tbody", "thead", "tfoot"}, "td": {"td", "th", "tr", "tbody", "tfoot"}, "th": {"td", "th", "tr", "tbody", "tfoot"},
        "thead": {"tbody", "tfoot"}, "tbody": {"tbody", "tfoot"}, "head": {"body"}}

_TAG = re.compile(r"""<!--(?:.*?-->|.*\Z)|<[!?][^>]*>?|<(/?)([a-zA-Z][^\s/>]*)((?:[^>"']|"[^"]*"|'[^']*')*+)>""", re.S)
_NAMED = re.compile(r"""\b(?:class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.I)
_PART = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")
_ENDS: dict = {}

_ENDINGS = frozenset(".!?…\"'”")
# bytes that belong to words: all but space, line break and punctuation
_IN_WORD = np.ones(256, bool)
_IN_WORD[list(b"\n .,:;!?()[]\"'")] = False
_POWERS = np.array([pow(0x100000001B3, i, 2**64) for i in range(64)], np.uint64)

_paths: dict = {}
_models: dict = {}
_vocabularies: dict = {}


def bucket(token: str, dim: int) -> int:
    return zlib.crc32(token.encode("utf-8", "replace")) % dim


# ---- blocks --------------------------------------------------------------------
class Block:
    __slots__ = ("text", "path", "linked")

    def __init__(self, text: str, path: np.ndarray, linked: float):
        self.text, self.path, self.linked = text, path, linked


def path_tokens(name: str, attributes: str) -> list[int]:
    """Places in the path vector of an element's name, classes, id and role."""
    key = (name, attributes if len(attributes) < 200 else attributes[:0])
    got = _paths.get(key) if key[1] == attributes else None
    if got is None:
        said = [p.lower() for m in _NAMED.finditer(attributes) for v in m.groups() if v for p in _PART.findall(v)]
        # two places each, so that hardly two tokens share both
        got = sorted({bucket(f"{k}{t}", PATH_DIM) for t in ("<" + name, *("." + p for p in said)) for k in (0, 1)})
        if len(_paths) < CACHE_ENTRIES and key[1] == attributes:
            _paths[key] = got
    return got


def leaf_blocks(page: str) -> list[Block]:
    """The blocks of a page in order."""
    out: list[Block] = []
    path = np.zeros(PATH_DIM, np.int16)
    stack: list[tuple[str, list[int]]] = []
    held: list[str] = []                 # text of the block so far
    opened: Counter = Counter()          # names on the stack
    size = linked = links = pos = 0

    def flush():
        nonlocal size, linked, links
        if held:
            text = " ".join(html.unescape("".join(held)).split())
            if text:
                out.append(Block(text, np.minimum(path, 3).astype(np.int8), linked / max(size, 1)))
            held.clear()
        size = linked = links = 0

    def pop():
        name, at = stack.pop()
        opened[name] -= 1
        path[at] -= 1

    def text_until(end: int):
        nonlocal size, linked
        if end > pos:
            held.append(page[pos:end])
            size += end - pos
            linked += (end - pos) * (links > 0)

    while m := _TAG.search(page, pos):
        text_until(m.start())
        pos = m.end()
        if not m[2]:
            continue
        name, closing = m[2].lower(), bool(m[1])
        if name in HIDDEN_CONTENT:
            if not closing and not m[3].endswith("/"):
                if name not in _ENDS:
                    _ENDS[name] = re.compile(rf"</{name}\b[^>]*>", re.I)
                end = _ENDS[name].search(page, pos)
                pos = end.end() if end else len(page)
            continue
        if name == "a":
            links = 0 if closing else 1
        elif name == "br":
            held.append(" ")
        if name not in BLOCKS:
            continue
        flush()
        if closing:
            if opened[name]:
                while stack[-1][0] != name:
                    pop()
                pop()
        else:
            while stack and name in ENDS.get(stack[-1][0], ()):
                pop()
            if name not in VOID:
                at = path_tokens(name, m[3])
                stack.append((name, at))
                opened[name] += 1
                path[at] += 1
    text_until(len(page))
    flush()
    return out


def word_counts(texts: list[str]) -> np.ndarray:
    """Words of each text by hash: ``WORD_DIM`` counts.  All words of all texts are hashed
    at once: a polynomial of each word's bytes, summed between word starts."""
    a = np.frombuffer("\n".join(t.lower() for t in texts).encode("utf-8", "replace"), np.uint8)
    letter = _IN_WORD[a]
    starts = np.flatnonzero(letter & np.r_[True, ~letter[:-1]])
    if not len(starts):
        return np.zeros((len(texts), WORD_DIM), np.float32)
    at = np.arange(len(a))
    word_at = np.zeros(len(a), np.int64)
    word_at[starts] = starts
    place = np.minimum(at - np.maximum.accumulate(word_at), len(_POWERS) - 1)
    hashes = np.add.reduceat(np.where(letter, a, 0).astype(np.uint64) * _POWERS[place], starts)
    found = ((hashes * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(40)).astype(np.int64) % WORD_DIM
    text_of = np.cumsum(a == 10)[starts]
    return np.bincount(text_of * WORD_DIM + found, minlength=len(texts) * WORD_DIM).reshape(-1, WORD_DIM).astype(np.float32)


def vectors(blocks: list[Block]) -> np.ndarray:
    """One row per block: path, words, shares."""
    x = np.zeros((len(blocks), PATH_DIM + WORD_DIM + SHARES), np.float32)
    n = word_counts([b.text for b in blocks])
    many = np.maximum(n.sum(axis=1), 1)
    x[:, :PATH_DIM] = [b.path for b in blocks]
    x[:, PATH_DIM:PATH_DIM + WORD_DIM] = n / np.sqrt(np.maximum((n * n).sum(axis=1), 1))[:, None]
    x[:, -SHARES] = np.log1p(many) / 4
    x[:, 1 - SHARES:] = [(b.linked, b.text[-1] in _ENDINGS, "©" in b.text, b.text.count(",")) for b in blocks]
    x[:, -1] /= many
    return x


# ---- the network -----------------------------------------------------------------
def _sigmoid(z: np.ndarray) -> np.ndarray:
    return 0.5 * (1 + np.tanh(0.5 * z))


def _steps(starts: np.ndarray, lengths: np.ndarray, backward: bool) -> list[np.ndarray]:
    """Rows of each step: the t-th (or t-th last) block of every sequence that has one.
    Sequences are sorted by length, longest first."""
    longer = np.searchsorted(-lengths, -np.arange(lengths[0]), "left") if len(lengths) else []
    return [starts[:k] + (lengths[:k] - 1 - t if backward else t) for t, k in enumerate(longer)]


def _run(z: np.ndarray, u: np.ndarray, steps: list[np.ndarray], keep: list | None = None) -> np.ndarray:
    """Hidden states of one direction; ``z`` holds the inputs' part of the gates."""
    n = u.shape[0]
    out = np.zeros((len(z), n), z.dtype)
    h = c = np.zeros((len(steps[0]) if steps else 0, n), z.dtype)
    for rows in steps:
        k = len(rows)
        h, c = h[:k], c[:k]
        a = z[rows] + h @ u
        gates, g = _sigmoid(a[:, :3 * n]), np.tanh(a[:, 3 * n:])
        i, f, o = gates[:, :n], gates[:, n:2 * n], gates[:, 2 * n:]
        now = f * c + i * g
        squashed = np.tanh(now)
        if keep is not None:
            keep.append((rows, h, c, i, f, o, g, squashed))
        h, c = o * squashed, now
        out[rows] = h
    return out


def _back(dout: np.ndarray, u: np.ndarray, kept: list) -> tuple[np.ndarray, np.ndarray]:
    """Gradients of the gates' input part and of ``u``."""
    n = u.shape[0]
    dz, du = np.zeros((len(dout), 4 * n), dout.dtype), np.zeros_like(u)
    dh = dc = np.zeros((0, n), dout.dtype)
    for rows, h, c, i, f, o, g, squashed in reversed(kept):
        more = len(rows) - len(dh)
        dh = np.concatenate([dh, np.zeros((more, n), dout.dtype)]) + dout[rows]
        dc = np.concatenate([dc, np.zeros((more, n), dout.dtype)]) + dh * o * (1 - squashed**2)
        da = np.concatenate([dc * g * i * (1 - i), dc * c * f * (1 - f), dh * squashed * o * (1 - o), dc * i * (1 - g**2)], axis=1)
        dz[rows] = da
        du += h.T @ da
        dh, dc = da @ u.T, dc * f
    return dz, du


class Labeller:
    """Weights: ``w``, ``b`` (inputs to the gates of both directions), ``u`` (one per
    direction), ``v``, ``a`` (states to the probability)."""

    def __init__(self, inputs: int, hidden: int = HIDDEN, seed: int = 11):
        rng = np.random.default_rng(seed)
        self.weights = {"w": rng.normal(0, 0.1, (inputs, 8 * hidden)), "b": np.zeros(8 * hidden), "u0": rng.normal(0, 0.2, (hidden, 4 * hidden)),
                        "u1": rng.normal(0, 0.2, (hidden, 4 * hidden)), "v": rng.normal(0, 0.2, 2 * hidden), "a": np.zeros(1)}
        for k in (0, 1):      # gates begin by remembering
            self.weights["b"][(4 * k + 1) * hidden:(4 * k + 2) * hidden] = 1.0
        self.weights = {k: x.astype(np.float32) for k, x in self.weights.items()}

    def project(self, x: np.ndarray) -> np.ndarray:
        return x @ self.weights["w"] + self.weights["b"]

    def states(self, z: np.ndarray, lengths: np.ndarray, kept: tuple | None = None) -> np.ndarray:
        starts, half = np.r_[0, np.cumsum(lengths)[:-1]], z.shape[1] // 2
        order = np.argsort(-lengths, kind="stable")
        return np.concatenate([_run(z[:, d * half:(d + 1) * half], self.weights[f"u{d}"], _steps(starts[order], lengths[order], bool(d)),
                                    kept[d] if kept else None) for d in (0, 1)], axis=1)

    def probabilities(self, pages: list[list[Block]]) -> np.ndarray:
        """Of each block of all (non-empty) pages, one after the other."""
        blocks = [b for p in pages for b in p]
        if not blocks:
            return np.zeros(0)
        z = np.concatenate([self.project(vectors(blocks[i:i + PART_BLOCKS])) for i in range(0, len(blocks), PART_BLOCKS)])
        return _sigmoid(self.states(z, np.array([len(p) for p in pages if p])) @ self.weights["v"] + self.weights["a"])

    def gradients(self, x: np.ndarray, y: np.ndarray, lengths: np.ndarray) -> dict:
        kept: tuple = ([], [])
        s = self.states(self.project(x), lengths, kept)
        p = _sigmoid(s @ self.weights["v"] + self.weights["a"])
        dp = ((p - y) / len(y)).astype(np.float32)
        ds = np.outer(dp, self.weights["v"])
        half = ds.shape[1] // 2
        (z0, u0), (z1, u1) = (_back(ds[:, d * half:(d + 1) * half], self.weights[f"u{d}"], kept[d]) for d in (0, 1))
        dz = np.concatenate([z0, z1], axis=1)
        return {"w": x.T @ dz, "b": dz.sum(axis=0), "u0": u0, "u1": u1, "v": s.T @ dp, "a": dp.sum(keepdims=True)}


def train(pages: int = TRAIN_PAGES, epochs: int = EPOCHS, seed: int = 11, batch: int = 32, rate: float = 0.01) -> Labeller:
    """A labeller fitted to ``pages`` labelled pages by Adam; the same for the same
    arguments."""
    rng = np.random.default_rng(seed)
    data = [labelled(training_page(rng)) for _ in range(pages)]
    data = [(vectors(b), y) for b, y in data if b]
    net = Labeller(data[0][0].shape[1], seed=seed)
    first = {k: np.zeros_like(x) for k, x in net.weights.items()}
    second = {k: np.zeros_like(x) for k, x in net.weights.items()}
    step, total = 0, epochs * -(-len(data) // batch)
    for _ in range(epochs):
        order = rng.permutation(len(data))
        for i in range(0, len(data), batch):
            some = [data[j] for j in order[i:i + batch]]
            grad = net.gradients(np.concatenate([x for x, _ in some]), np.concatenate([y for _, y in some]), np.array([len(y) for _, y in some]))
            step += 1
            now = rate * 0.5 * (1 + np.cos(np.pi * step / total))
            for k, g in grad.items():
                first[k] = 0.9 * first[k] + 0.1 * g
                second[k] = 0.99 * second[k] + 0.01 * g * g
                net.weights[k] -= (now * (first[k] / (1 - 0.9**step)) / (np.sqrt(second[k] / (1 - 0.99**step)) + 1e-8)).astype(np.float32)
    return net


def trained() -> Labeller:
    """The labeller of the default settings; trained once per process."""
    if "net" not in _models:
        _models["net"] = train()
    return _models["net"]


# ---- labelled pages ----------------------------------------------------------------
MARK = ""            # stands before the text of a block that belongs to the article

# Names that sites give to the parts of a page, and what such parts say.
NAMES = {
    "menu": "nav menu navbar navigation topnav breadcrumb breadcrumbs toolbar tabs pagination pager links categories",
    "header": "header masthead banner top topbar logo branding brand title-bar",
    "footer": "footer bottom copyright colophon legal foot imprint",
    "sidebar": "sidebar side aside widget widgets related recommended trending popular rail recent tags archive more secondary",
    "notice": "cookie cookies consent gdpr alert notice popup modal overlay paywall toast message warning privacy",
    "advert": "ad ad ad ads ads advert adverts advertisement advertising sponsored sponsor promo promotion adslot adsbygoogle",
    "form": "form search newsletter signup subscribe login contact register poll",
    "share": "share social sharing follow buttons actions",
    "comments": "comments comment replies reply discussion respond responses disqus feedback reviews",
}
ELEMENT = {"menu": "nav", "header": "header", "footer": "footer", "sidebar": "aside", "form": "form"}
CONTENT = "article content post entry story main body text post-content entry-content article-body blog prose page-content"
WRAPPERS = "container wrapper page row col inner site layout app root outer grid box block section"
SAYS = {
    "menu": "Home|About us|Contact|News|Sports|Products|Services|Blog|Login|Sign in|Next|Previous|Accueil|Startseite|Inicio|Kontakt",
    "header": "Welcome|The daily|Your source for news|Search|Menu|Skip to content|Subscribe",
    "footer": "© 2024 All rights reserved|Privacy policy|Terms of use|Imprint|Copyright|Powered by|Tous droits réservés|Alle Rechte vorbehalten",
    "sidebar": "Related articles|Most read|Popular posts|Recent posts|Tags|Archives|You may also like|Trending now|Read more",
    "notice": "We use cookies to improve your experience|Accept all|This site uses cookies|Manage preferences|Wir verwenden Cookies|Warning",
    "advert": "Advertisement|Sponsored|Buy now|Limited offer|50% off today|Shop now|Anzeige|Publicité|Order today",
    "form": "Subscribe to our newsletter|Your email address|Submit|Search|Send|Enter your name|Sign up|Password|Register",
    "share": "Share|Tweet|Facebook|Email this|Print|Follow us|Like|Copy link|Pin it",
    "comments": "Leave a reply|Comments|3 comments|Reply|Posted by|says|Great post, thanks!|Report comment|Log in to comment",
}
SYLLABLES = ("the an er on in re ti es or te of ed is it al ar st to nt ng se ha as ou io le ve co me de hi ri ro ic ne ea ra ce".split(),
             "sch ein ich ung der gen und die ver be ät ö ü ß keit heit zu lich tz".split(), "eau ou ai que é è ç ent ion oi eux les la".split(),
             "ción os as de la que ñ el ado ado ista ó í".split(), "ко ст но на ра то ли пе ре ни".split(), "东 京 新 闻 中 文 章 人 大".split())


def _pick(rng, words: str, sep: str | None = None) -> str:
    options = words.split(sep)
    return options[int(rng.random() * len(options))]


def _prose(rng, low: int, high: int) -> str:
    """Random words with sentence ends, some with odd signs, references or inline markup."""
    kind = int(rng.choice(len(SYLLABLES), p=[0.5, 0.14, 0.14, 0.12, 0.06, 0.04]))
    if kind not in _vocabularies:
        own = np.random.default_rng(kind)
        _vocabularies[kind] = ["".join(SYLLABLES[kind][j] for j in own.integers(len(SYLLABLES[kind]), size=own.integers(1, 5))) for _ in range(3_000)]
    words, odd = _vocabularies[kind], rng.random() < 0.15
    n = int(np.exp(rng.uniform(np.log(low), np.log(high + 1))))
    out = [words[j] for j in rng.integers(len(words), size=n)]
    for i, (r, again) in enumerate(rng.random((n, 2)).tolist()):
        if r < 0.03:
            out[i] = f'<a href="/{i}">{out[i]}</a>'
        elif r < 0.06:
            out[i] = f"<{(t := _pick(rng, 'b i em strong span code'))}>{out[i]}</{t}>"
        elif r < 0.08:
            out[i] += _pick(rng, "&amp; &quot; &nbsp; &eacute; &#39; 42 2019 a@b.org")
        elif r < 0.2:
            out[i] += ",.;:"[int(again * 4)]
        elif r < 0.35:
            out[i] = out[i].capitalize()
        if odd and again < 0.5:
            out[i] += _pick(rng, "### *** $$$ %%% &amp;&amp;&amp;")
    return " ".join(out).capitalize() + ("." if rng.random() < 0.8 else "")


def _open(rng, name: str, classes: str | None, chance: float = 0.8) -> str:
    said = ""
    if classes and rng.random() < chance:
        own = _pick(rng, classes) + ("-" + _pick(rng, "wrap box area list item inner main site primary x1") if rng.random() < 0.3 else "")
        quote = _pick(rng, "\" \" ' ") if rng.random() < 0.9 else '"'
        said = f" {'id' if rng.random() < 0.25 else 'class'}={quote}{own}{quote}"
    return f"<{name.upper() if rng.random() < 0.03 else name}{said}>"


def _paragraphs(rng, n: int) -> str:
    """Article blocks of all kinds, some of them not closed."""
    out = []
    for _ in range(n):
        r = rng.random()
        if r < 0.68:
            inner = "<b>" if rng.random() < 0.08 else ""
            out.append(f"<p>{inner}{MARK}{_prose(rng, 2, 120)}{'<br>' if rng.random() < 0.1 else ''}{'</p>' if rng.random() < 0.85 else ''}")
        elif r < 0.78:
            name = _pick(rng, "h2 h3 h4")
            out.append(f"<{name}>{MARK}{_prose(rng, 1, 8)}</{name}>")
        elif r < 0.88:
            name = _pick(rng, "ul ol")
            items = "".join(f"<li>{MARK}{_prose(rng, 1, 25)}{'</li>' if rng.random() < 0.8 else ''}" for _ in range(rng.integers(1, 7)))
            out.append(f"<{name}>{items}</{name}>")
        elif r < 0.93:
            out.append(f"<blockquote>{MARK}{_prose(rng, 3, 40)}</blockquote>")
        elif r < 0.96:
            cells = "".join("<tr>" + "".join(f"<td>{MARK}{_prose(rng, 1, 4)}</td>" for _ in range(2)) + "</tr>" for _ in range(rng.integers(1, 4)))
            out.append(f"<table>{cells}</table>")
        elif r < 0.98:
            out.append(f"<figure><img src=x><figcaption>{MARK}{_prose(rng, 2, 12)}</figcaption></figure>")
        else:
            out.append(f"<div>{MARK}{_prose(rng, 3, 60)}</div>")
    return "".join(out)


def _boilerplate(rng, kind: str) -> str:
    """A part that does not belong to the article."""
    if kind in ELEMENT and rng.random() < 0.65:
        start = _open(rng, ELEMENT[kind], NAMES[kind], 0.4)
    else:
        start = _open(rng, _pick(rng, "div div div section ul") if kind != "advert" else "div", NAMES[kind], 1.0)
    name = re.match(r"<(\w+)", start)[1]
    says = lambda: _pick(rng, SAYS[kind], "|") if rng.random() < 0.6 else _prose(rng, 1, 12)
    listed, out = kind in ("menu", "footer", "sidebar", "share") and rng.random() < 0.7, []
    if kind == "comments":
        out.append(f"<h3>{says()}</h3>")
    for _ in range(rng.integers(1, 9 if kind in ("menu", "sidebar", "comments") else 4)):
        text = _prose(rng, 3, 60) if kind == "comments" or (kind in ("advert", "notice") and rng.random() < 0.5) else says()
        if kind in ("menu", "share") or (kind in ("sidebar", "footer") and rng.random() < 0.6):
            text = f'<a href="#">{text}</a>'
        if kind == "form" and rng.random() < 0.6:
            text = f"<label>{text}</label><input><button>{says()}</button>"
        wrap = "li" if listed or name.lower() == "ul" else "" if rng.random() < 0.4 else _pick(rng, "p div span p h4")
        out.append(f"<{wrap}>{text}</{wrap}>" if wrap else text + " ")
    inner = "".join(out)
    if listed and name.lower() != "ul":
        inner = f"<ul>{inner}</ul>"
    return f"{start}{inner}</{name}>"


def training_page(rng: np.random.Generator) -> str:
    """A random page; the text of article blocks begins with ``MARK``."""
    heading = f"<h1>{MARK}{_prose(rng, 1, 12)}</h1>" if rng.random() < 0.85 else ""
    body = _paragraphs(rng, int(rng.integers(1, 22)))
    while rng.random() < 0.4:   # something foreign inside the article
        body += _boilerplate(rng, _pick(rng, "advert share form sidebar notice advert")) + _paragraphs(rng, int(rng.integers(0, 6)))
    if heading and rng.random() < 0.15:
        heading = f"<header>{heading}</header>"
    r = rng.random()
    if r < 0.5:
        main = f"{(s := _open(rng, 'article', CONTENT, 0.4))}{heading}{body}</article>"
    elif r < 0.65:
        main = f"{_open(rng, 'main', CONTENT, 0.4)}{heading}{body}</main>"
    elif r < 0.95:
        main = f"{_open(rng, _pick(rng, 'div section'), CONTENT, 0.9)}{heading}{body}</div>"
    else:
        main = heading + body
    if rng.random() < 0.2:
        main = f"<main>{main}</main>"

    def some(kinds: str, chance: float) -> str:
        return "".join(_boilerplate(rng, k) for k in kinds.split() if rng.random() < chance)
    before, after = some("notice header menu advert form sidebar", 0.4), some("share advert sidebar comments form menu notice footer", 0.4)
    if rng.random() < 0.1:
        before = after = ""
    if rng.random() < 0.5:
        before = f"<script>var t='</p>';</script><!-- {_prose(rng, 1, 5)} -->" + before
    page = before + main + after
    for _ in range(rng.integers(0, 3)):
        page = f"{_open(rng, 'div', WRAPPERS, 0.7)}{page}</div>"
    head = f"<head><title>{_prose(rng, 1, 8)}</title><style>p{{}}</style></head>" if rng.random() < 0.8 else ""
    return f"<!DOCTYPE html><html>{head}<body>{page}" + ("</body></html>" if rng.random() < 0.8 else "")


def labelled(page: str) -> tuple[list[Block], np.ndarray]:
    """Blocks of a training page without their marks, and whether they had one."""
    blocks, y = leaf_blocks(page), []
    for b in blocks:
        y.append(MARK in b.text)
        b.text = b.text.replace(MARK, "") or "."
    return blocks, np.array(y, np.float32)


# ---- extraction ------------------------------------------------------------------
def extract(pages: list[str | None], net: Labeller) -> list[str]:
    """Main text of each page."""
    blocks = [leaf_blocks(p) if p else [] for p in pages]
    kept = iter((net.probabilities(blocks) > 0.5).tolist())
    return ["\n\n".join(b.text for b in p if next(kept)) for p in blocks]


def extract_pages(pages: DataFrame, html_col: str = "html", out_col: str = "text") -> DataFrame:
    """``pages`` plus ``out_col``: the main text."""
    net = pages.sparkSession.sparkContext.broadcast(trained())

    @F.arrow_udf("string")
    def run(page: pa.Array) -> pa.Array:
        out: list[str] = []
        for i in range(0, len(page), SLICE_ROWS):
            out += extract(page.slice(i, SLICE_ROWS).to_pylist(), net.value)
        return pa.array(out, pa.string())
    return pages.withColumn(out_col, run(F.col(html_col).cast("string")))


def text_report(pages: DataFrame) -> DataFrame:
    """``page_id, url, text, n_chars`` of every page."""
    found = extract_pages(pages.select("page_id", "url", "html"))
    return found.select("page_id", "url", "text", F.length("text").cast("long").alias("n_chars"))
