"""Main text of web pages: gradient-boosted trees over DOM nodes, decoded down the tree.

Every element gets features of its subtree, attributes, depth and siblings. Boosted trees
give the log-odds that it holds main text; the decoding then picks the most likely
labelling in which no element that is left out has a descendant that is taken, so choices
never contradict each other. Text of the chosen elements comes out block by block.

The trees are trained here, on a bounded sample of the pages themselves: semantic elements
tell main text from the rest, and copies of the sampled pages in other markup (plain
divisions with telling class names, added notices, forms and reader comments) teach the
trees to do without those elements.
"""

from __future__ import annotations

import random
import re
import zlib
from dataclasses import dataclass, field
from html import unescape

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import common

#: fixed values: element kinds of HTML, in alphabetical order
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
BLOCK = frozenset("""address article aside blockquote body center dd details dialog dir div dl dt fieldset figcaption
    figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol p pre section summary table
    tbody td tfoot th thead tr ul""".split())
UNSHOWN = frozenset("head iframe noscript script style svg template title".split())
BOILERPLATE = frozenset("aside button dialog fieldset footer form header iframe input label menu nav noscript select textarea".split())
MAIN = frozenset("article main".split())
INLINE = frozenset("a abbr b cite code em i q s small span strong sub sup time u".split())
#: an open element of the key's kind ends where one of these begins
ENDS = {"p": BLOCK, "li": frozenset(["li"]), "dt": frozenset(["dd", "dt"]), "dd": frozenset(["dd", "dt"]), "tr": frozenset(["tr"]),
        "td": frozenset(["td", "th", "tr"]), "th": frozenset(["td", "th", "tr"]), "option": frozenset(["option"])}
#: attribute words that speak against and for main text
AGAINST = frozenset("""ad ads advert advertisement banner breadcrumb comment comments consent cookie copyright disqus footer form
    header login masthead menu modal nav navbar navigation newsletter notice pagination popup promo related respond share
    sidebar signup skip social sponsor sponsored subscribe toolbar widget""".split())
IN_FAVOUR = frozenset("article articlebody body content entry main post story text".split())


TAGS = re.compile(r"""<!--.*?(?:-->|$) | <[!?][^>]*(?:>|$) | <(/?)([a-zA-Z][^\s/>]*)((?:"[^"]*"|'[^']*'|[^'">])*)(?:>|$)""", re.S | re.X)
NAMES = re.compile(r"""(?:^|\s)(?:class|id|role|itemprop)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.I)
CAMEL = re.compile("([a-z])([A-Z])")
RAW = {t: re.compile(f"</{t}(?=[\\s/>])|$(?![\\s\\S])", re.I) for t in ("script", "style", "textarea", "title")}


class Node:
    """An element: its kind, its parent's number, its depth, and what its attributes say: known words
    against and for main text, and the hash buckets of all words."""

    __slots__ = ("tag", "parent", "depth", "against", "favour", "tokens", "children")

    def __init__(self, tag: str, parent: int, depth: int, against: int = 0, favour: int = 0, tokens: tuple[int, ...] = ()):
        self.tag, self.parent, self.depth, self.against, self.favour, self.tokens = tag, parent, depth, against, favour, tokens
        self.children: list[int] = []


class Page:
    """Elements of a page in document order; element 0 holds the page.

    Tags that never end, comments and raw text of scripts and styles are left out; optional
    end tags are implied. ``events``: (element, text, whether a block begins or ends here).
    """

    def __init__(self, html: str):
        self.nodes = [Node("#page", -1, 0)]
        self.open = [0]
        self.events: list[tuple[int, str, bool]] = []
        at, size = 0, len(html)
        for m in iter(lambda: TAGS.search(html, at), None):
            if m.start() > at:
                self._text(html[at:m.start()])
            at = m.end()
            tag = m[2]
            if tag is None or html[at - 1] != ">":
                continue
            tag = tag.lower()
            if m[1]:
                self._end(tag)
                continue
            self._start(tag, m[3])
            if tag in RAW and self.open[-1] == len(self.nodes) - 1:
                stop = RAW[tag].search(html, at).start()
                if tag == "textarea":
                    self._text(html[at:stop])
                at = stop
        if at < size:
            self._text(html[at:])

    def _text(self, text: str):
        self.events.append((self.open[-1], unescape(text) if "&" in text else text, False))

    def _start(self, tag: str, attrs: str):
        nodes = self.nodes
        if tag in CLOSERS:
            while len(self.open) > 1 and tag in ENDS.get(near := self._near(), ()):
                self._shut(near)
        against = favour = 0
        tokens: tuple[int, ...] = ()
        if "=" in attrs:
            words = {w for g in NAMES.findall(attrs) for w in re.split(r"[^a-z]+", CAMEL.sub(r"\1-\2", g[0] or g[1] or g[2]).lower())}
            against, favour = len(words & AGAINST), len(words & IN_FAVOUR)
            tokens = tuple(sorted(zlib.crc32(w.encode()) % TOKEN_BUCKETS for w in words if w))
        up = self.open[-1]
        me = len(nodes)
        nodes.append(Node(tag, up, nodes[up].depth + 1, against, favour, tokens))
        nodes[up].children.append(me)
        if tag in BLOCK:
            self.events.append((me, "", True))
        elif tag == "br":
            self.events.append((up, " ", False))
        if tag not in VOID and not attrs.endswith("/"):
            self.open.append(me)

    def _near(self) -> str:
        """The innermost open element that is no inline one; those inside it close with it."""
        for i in reversed(self.open[1:]):
            t = self.nodes[i].tag
            if t not in INLINE:
                return t
        return ""

    def _shut(self, tag: str):
        while len(self.open) > 1:
            x = self.nodes[self.open.pop()]
            if x.tag in BLOCK:
                self.events.append((x.parent, "", True))
            if x.tag == tag:
                return

    def _end(self, tag: str):
        if any(self.nodes[i].tag == tag for i in self.open[1:]):
            self._shut(tag)

    def shown(self) -> list[bool]:
        """Elements that are no head, script or style, nor inside one."""
        out: list[bool] = []
        for n in self.nodes:
            out.append(n.tag not in UNSHOWN and (n.parent < 0 or out[n.parent]))
        return out


CLOSERS = frozenset().union(*ENDS.values())
PROSE = frozenset("blockquote p pre".split())
ITEMS = frozenset("li option td".split())
LOGGED = [5, 6, 8]      # columns that hold counts
TOKEN_BUCKETS = 1024


def raw_features(page: Page, learnt: list[float]) -> list[tuple]:
    """One tuple per element; features() turns them into the trees' columns. ``learnt``: what each
    attribute token's bucket says for main text."""
    nodes = page.nodes
    n = len(nodes)
    shown = page.shown()
    own, punct, words, blocks_ = [0] * n, [0] * n, [0] * n, [0] * n
    first = [-1] * n
    at = 0
    for i, text, _ in page.events:
        if text and shown[i]:
            size = len(text.strip())
            if first[i] < 0:
                first[i] = at
            if size:
                own[i] += size
                at += size
                punct[i] += text.count(".") + text.count(",") + text.count("!") + text.count("?")
                words[i] += text.count(" ") + 1
                blocks_[i] += 1
    against, favour, bad, good, in_link, place = [0] * n, [0] * n, [0] * n, [0] * n, [False] * n, [0] * n
    prose, items = [0] * n, [0] * n
    said, least, most = [0.0] * n, [0.0] * n, [0.0] * n     # by the element's tokens, and by those around it
    for i, x in enumerate(nodes):
        tag, p = x.tag, x.parent
        against[i], favour[i], bad[i], good[i] = x.against, x.favour, tag in BOILERPLATE, tag in MAIN
        in_link[i], prose[i], items[i] = tag == "a", tag in PROSE, tag in ITEMS
        if x.tokens:
            said[i] = sum(learnt[t] for t in x.tokens)
        least[i], most[i] = min(said[i], least[p] if p >= 0 else 0.0), max(said[i], most[p] if p >= 0 else 0.0)
        if p >= 0:
            against[i] += against[p]
            favour[i] += favour[p]
            bad[i] += bad[p]
            good[i] += good[p]
            in_link[i] = in_link[i] or in_link[p]
        for k, c in enumerate(x.children):
            place[c] = k
    link = [o if a else 0 for o, a in zip(own, in_link)]
    total, size = list(own), [1] * n
    for i in range(n - 1, 0, -1):       # children come after their parents
        p = nodes[i].parent
        total[p] += total[i]
        link[p] += link[i]
        punct[p] += punct[i]
        words[p] += words[i]
        blocks_[p] += blocks_[i]
        size[p] += size[i]
        prose[p] += prose[i]
        items[p] += items[i]
        if first[i] >= 0 and (first[p] < 0 or first[i] < first[p]):
            first[p] = first[i]
    whole = max(total[0], 1)
    out = []
    for i, x in enumerate(nodes):
        p, tag = max(x.parent, 0), x.tag
        sib, t, z = len(nodes[p].children), total[i], size[i]
        out.append((x.depth, len(x.children), place[i], sib, place[i] / (sib - 1 or 1), t, own[i], link[i] / (t or 1), z, t / z,
                    t / whole, punct[i] / (t or 1), words[i] / (blocks_[i] or 1), t / (total[p] or 1), total[p] / size[p],
                    max(first[i], 0) / whole, prose[i] / z, items[i] / z, x.against, x.favour, against[i], favour[i], bad[i], good[i],
                    2 if tag in BLOCK else tag in INLINE, not shown[i], said[i], least[i], most[i]))
    return out


NO_TOKENS = [0.0] * TOKEN_BUCKETS


def features(pages: list[Page], learnt: list[float] = NO_TOKENS) -> np.ndarray:
    """One row per element of the pages, one after the other."""
    x = np.array([row for p in pages for row in raw_features(p, learnt)], np.float64)
    x[:, LOGGED] = np.log1p(x[:, LOGGED])
    return x


def truth(page: Page) -> np.ndarray | None:
    """1 where an element holds main text by the semantic elements; None if the page has none of them."""
    nodes, n = page.nodes, len(page.nodes)
    main = [x.tag in MAIN for x in nodes]
    if not any(main):
        return None
    inside, shown = [False] * n, page.shown()
    for i, x in enumerate(nodes):
        inside[i] = (main[i] or (x.parent >= 0 and inside[x.parent])) and shown[i] \
            and x.tag not in BOILERPLATE and not (x.against and x.tag not in MAIN)
        if x.parent >= 0 and any(nodes[a].tag in BOILERPLATE for a in (x.parent,)):
            inside[i] = inside[i] and inside[x.parent]
    hold = np.array(inside, float)
    for i in range(n - 1, 0, -1):
        hold[nodes[i].parent] = max(hold[nodes[i].parent], hold[i])
    return hold


def token_evidence(pages: list[tuple[Page, np.ndarray]]) -> list[float]:
    """Of each bucket of attribute tokens, the log-odds that an element with it holds main text against
    elements in general; 0 for buckets that were not met. A page counts a bucket once a side."""
    yes, no = np.zeros(TOKEN_BUCKETS), np.zeros(TOKEN_BUCKETS)
    for page, label in pages:
        for side, want in ((yes, True), (no, False)):
            met = {t for x, y in zip(page.nodes, label) if bool(y) == want for t in x.tokens}
            side[list(met)] += 1
    out = np.log((yes + 0.5) / (no + 0.5))
    out[yes + no == 0] = 0.0
    return np.clip(out, -3, 3).tolist()


@dataclass
class Trees:
    """Boosted regression trees of fixed depth: feature, threshold and leaf arrays; and what was learnt
    of the attribute tokens."""

    base: float
    feature: np.ndarray         # trees x inner nodes
    threshold: np.ndarray
    leaf: np.ndarray            # trees x leaves
    depth: int
    tokens: list[float] = field(default_factory=lambda: NO_TOKENS)

    def log_odds(self, x: np.ndarray) -> np.ndarray:
        out = np.full(len(x), self.base)
        row = np.arange(len(x))
        for f, t, leaf in zip(self.feature, self.threshold, self.leaf):
            at = np.zeros(len(x), np.int64)
            for _ in range(self.depth):
                at = 2 * at + 1 + (x[row, f[at]] > t[at])
            out += leaf[at - (2 ** self.depth - 1)]
        return out


def train(x: np.ndarray, y: np.ndarray, weight: np.ndarray, trees: int = 24, depth: int = 4, rate: float = 0.3,
          bins: int = 32, l2: float = 1.0) -> Trees:
    """Logistic boosting with second-order splits over quantile bins."""
    edges = [np.unique(np.quantile(x[:, j], np.linspace(0, 1, bins + 1)[1:-1])) for j in range(x.shape[1])]
    code = np.stack([np.searchsorted(e, x[:, j], side="left") for j, e in enumerate(edges)], axis=1)
    share = np.clip(np.average(y, weights=weight), 1e-3, 1 - 1e-3)
    base = float(np.log(share / (1 - share)))
    score = np.full(len(x), base)
    inner, leaves = 2 ** depth - 1, 2 ** depth
    feats, cuts, outs = (np.zeros((trees, inner), np.int64), np.full((trees, inner), np.inf), np.zeros((trees, leaves)))
    for t in range(trees):
        p = 1 / (1 + np.exp(-score))
        g, h = weight * (p - y), weight * p * (1 - p)
        at = np.zeros(len(x), np.int64)
        for level in range(depth):
            for node in range(2 ** level - 1, 2 ** (level + 1) - 1):
                rows = np.flatnonzero(at == node)
                best = (1e-6, None, None)
                if len(rows) >= 20:
                    gs, hs = g[rows].sum(), h[rows].sum()
                    for j, e in enumerate(edges):
                        if not len(e):
                            continue
                        gl = np.cumsum(np.bincount(code[rows, j], g[rows], len(e) + 1))[:-1]
                        hl = np.cumsum(np.bincount(code[rows, j], h[rows], len(e) + 1))[:-1]
                        gain = gl ** 2 / (hl + l2) + (gs - gl) ** 2 / (hs - hl + l2) - gs ** 2 / (hs + l2)
                        k = int(gain.argmax())
                        if gain[k] > best[0]:
                            best = (gain[k], j, e[k])
                if best[1] is not None:
                    feats[t, node], cuts[t, node] = best[1], best[2]
                at[rows] = 2 * node + 1 + (x[rows, feats[t, node]] > cuts[t, node])
        leaf = at - inner
        outs[t] = -rate * np.bincount(leaf, g, leaves) / (np.bincount(leaf, h, leaves) + l2)
        score += outs[t][leaf]
    return Trees(base, feats, cuts, outs, depth)


def decode(page: Page, odds: np.ndarray) -> list[bool]:
    """The most likely labelling in which whatever is left out is left out with all it holds."""
    nodes, n = page.nodes, len(page.nodes)
    yes, no = (-np.logaddexp(0, -odds)).tolist(), (-np.logaddexp(0, odds)).tolist()
    inside, without = list(yes), list(no)       # of the subtree: with the element taken, with all of it left out
    take = [False] * n
    shown = page.shown()
    for i in range(n - 1, -1, -1):
        take[i] = shown[i] and inside[i] > without[i]
        p = nodes[i].parent
        if p >= 0:
            inside[p] += inside[i] if take[i] else without[i]
            without[p] += without[i]
    chosen = [False] * n
    for i, x in enumerate(nodes):
        chosen[i] = take[i] and (x.parent < 0 or chosen[x.parent])
    return chosen


def blocks(page: Page, chosen: list[bool]) -> list[str]:
    """Text blocks of the chosen elements, white space as single blanks."""
    out, now = [], []
    for i, text, edge in page.events:
        if edge:
            out.append(" ".join("".join(now).split()))
            now = []
        elif chosen[i]:
            now.append(text)
    out.append(" ".join("".join(now).split()))
    return [b for b in out if b]


@dataclass(frozen=True)
class Training:
    """Bounds and shape of the training: about ``pages`` sampled by hash, of at most ``chars`` code points."""

    pages: int = 200
    chars: int = 60_000
    trees: int = 24
    depth: int = 4


def _elsewhere(html: str, rng: random.Random) -> tuple[str, str] | None:
    """A sampled page's article in other markup: (html, its semantic twin for the labels)."""
    page = Page(html)
    label = truth(page)
    if label is None:
        return None
    main = [bool(v) for v in label]
    texts = blocks(page, main)
    rest = blocks(page, [s and not m for s, m in zip(page.shown(), main)]) or ["Menu"]
    if not texts:
        return None

    def words(k: int) -> str:
        pool = " ".join(rng.choice(rest + texts[-1:]) for _ in range(3)).split()
        return " ".join(rng.choice(pool) for _ in range(k))

    def esc(s: str) -> str:
        return s.replace("&", "&amp;").replace("<", "&lt;")

    def menu() -> str:
        return "<ul>" + "".join(f'<li><a href="/x">{esc(words(rng.randint(1, 3)))}</a></li>' for _ in range(rng.randint(3, 9))) + "</ul>"

    def prose(k: int) -> str:
        return "".join(f"<p>{esc(words(rng.randint(4, 30)))}.</p>" for _ in range(k))

    # (semantic element, class names a plain division has instead, content)
    around = [("nav", ["menu", "navbar", "top-navigation"], menu()),
              ("header", ["header", "masthead", "site-header"], f"<h2>{esc(words(2))}</h2>" + menu()),
              ("aside", ["sidebar", "related", "widget"], f"<h3>{esc(words(2))}</h3>" + prose(rng.randint(1, 3)) + menu()),
              ("aside", ["notice", "cookie-notice", "consent", "popup"], prose(1) + "<button>OK</button>"),
              ("aside", ["ad", "advert", "sponsored", "banner"], esc(words(rng.randint(4, 25)))),
              ("form", ["newsletter-form", "subscribe", "login"], f"<label>{esc(words(3))}</label><input name=q><button>Go</button>"),
              ("aside", ["comments", "comment-list", "respond"],
               "".join(f'<div class="comment"><p>{esc(words(rng.randint(4, 40)))}.</p></div>' for _ in range(rng.randint(1, 5)))),
              ("footer", ["footer", "site-footer", "copyright"], f"&copy; {esc(words(rng.randint(3, 20)))}")]
    before, after = around[:2], around[2:]
    rng.shuffle(after)
    picked = [x for x in before if rng.random() < 0.7], [x for x in after if rng.random() < 0.6]
    mid = rng.randrange(len(texts)) if rng.random() < 0.4 and len(texts) > 1 else None
    inner = rng.choice(after)
    title, body = texts[0], texts[1:] or texts

    def build(semantic: bool) -> str:
        def part(x):
            tag, names, content = x
            name = names[len(content) % len(names)]
            return f"<{tag}>{content}</{tag}>" if semantic or plain[names[0]] else f'<div class="{name}">{content}</div>'
        wrap = '<div class="%s">' % wrapper
        art = "<article>" if semantic else wrap
        end = "</article>" if semantic else "</div>"
        paras = [f"<p>{esc(b)}</p>" for b in body]
        if mid is not None:
            paras.insert(mid, part(inner))
        return ("<html><head><title>x</title></head><body>" + "".join(map(part, picked[0])) + art + f"<h1>{esc(title)}</h1>"
                + "".join(paras) + end + "".join(map(part, picked[1])) + "</body></html>")

    plain = {x[1][0]: rng.random() < 0.4 for x in around}
    wrapper = rng.choice(["content", "post", "entry", "story", "main text", "page", "wrap", "x1"])
    return build(False), build(True)


def fit(pages: list[str], how: Training = Training(), seed: int = 7) -> Trees:
    """Trees from sampled pages and their copies in other markup. Without any usable page: from made-up ones."""
    rng = random.Random(seed)
    known: list[tuple[Page, np.ndarray]] = []
    if not any(truth(Page(p)) is not None for p in pages):
        pages = [*pages, "<nav><a>Home</a></nav><article><h1>Title of it</h1><p>Some words of main text, at length.</p>"
                 "<p>More words of main text, at some length too.</p></article><footer>Imprint</footer>"]
    for html in pages:
        page = Page(html)
        label = truth(page)
        if label is not None:
            known.append((page, label))
        for _ in range(2):
            pair = _elsewhere(html, rng)
            if pair:
                twin = Page(pair[1])
                other = Page(pair[0])
                if len(twin.nodes) == len(other.nodes):
                    known.append((other, truth(twin)))
    # the tokens' evidence on a page comes from other pages, as it will when the trees are used
    folds = [token_evidence([k for i, k in enumerate(known) if i % FOLDS != f]) for f in range(FOLDS)]
    xs = [features([page], folds[i % FOLDS]) for i, (page, _) in enumerate(known)]
    x, y = np.concatenate(xs), np.concatenate([label for _, label in known])
    weight = np.concatenate([np.full(len(a), 30.0 / len(a)) for a in xs])   # a long page counts no more than a short one
    made = train(x, y, weight, how.trees, how.depth)
    made.tokens = token_evidence(known)
    return made


FOLDS = 4
OUT = T.StructType([T.StructField("text", T.StringType()), T.StructField("n_chars", T.LongType())])


def extract(pages: DataFrame, html_col: str = "html", how: Training = Training()) -> DataFrame:
    """``pages`` with text and n_chars (code points) of the main text instead of columns of these names.

    Null and empty pages give an empty text. Blocks are joined by a line feed in page order;
    white space in a block is one blank; nothing is capped. Repeated pages give equal texts;
    an empty table gives no rows.
    """
    html = F.coalesce(F.col(html_col).cast("string"), F.lit(""))
    n = pages.count()
    chance = F.pmod(F.xxhash64("html", F.monotonically_increasing_id()), F.lit(1 << 30))
    short = pages.select(html.alias("html")).where((F.length("html") <= how.chars) & (F.col("html") != ""))
    # about how.pages rows of the whole table, whatever its size: a hash decides for each row
    sample = [r.html for r in (short.where(chance < int((1 << 30) * how.pages / n)) if n > how.pages else short).collect()]
    sent = pages.sparkSession.sparkContext.broadcast(fit(sample, how))      # trees x 2^depth numbers

    def run(column: pa.Array) -> list:
        out: list[str] = []
        raw = common.text_bytes(column)
        for lo, hi in common.slices(raw, 8 << 20):
            parsed = [Page(t.decode("utf-8", "replace")) for t in raw[lo:hi]]
            odds = sent.value.log_odds(features(parsed, sent.value.tokens))
            ends = np.cumsum([len(p.nodes) for p in parsed])
            out += ["\n".join(blocks(p, decode(p, odds[e - len(p.nodes):e]))) for p, e in zip(parsed, ends)]
        return [out, [len(t) for t in out]]

    if html_col not in OUT.names:
        return common.append_columns(pages.drop(*OUT.names), [html], run, OUT)
    rest = pages.withColumn("_hx_html", html).drop(*OUT.names)      # the html stands in a column that is replaced
    return common.append_columns(rest, [F.col("_hx_html")], run, OUT).drop("_hx_html")
