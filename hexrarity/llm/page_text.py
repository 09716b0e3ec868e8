"""Main text of web pages by a linear-chain conditional random field over leaf blocks.

A page becomes its leaf blocks in order: runs of text between tags that break blocks,
with their open ancestors. A block's features are its ancestors' tags, class and id
words, and its text (length, links, marks, words of short blocks). The field is trained
on labelled pages and decoded by Viterbi; the text of the content blocks, in order, is
the page's main text. Scripts, styles, heads and comments never are text.

Labelled pages: a bounded sample of the table's own pages, where the page itself says
what is its article, and the same texts laid out once more in other common ways (named
containers, side columns, notices, forms, reader comments), whose roles are then known.
"""

from __future__ import annotations

import pickle
import re
import sys
import zlib
from dataclasses import dataclass
from html.parser import HTMLParser

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hexrarity.llm.chain import best_path, fitted
from hexrarity.llm.common import digest, texts, worker_cache

cloudpickle.register_pickle_by_value(sys.modules[__name__])

TRAINING_PAGES = 400
HASHED = 1 << 15
EPOCHS = 60
RIDGE = 0.1

# Tags of HTML by their role.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
INLINE = frozenset(
    "a abbr acronym b bdi bdo big br cite code data del dfn em font i img ins kbd label mark q "
    "s samp small span strike strong sub sup time tt u var wbr".split())
UNSEEN = frozenset("script style head title noscript template iframe object svg math canvas "
                   "audio video".split())
#: An opening tag ends these open elements, up to the nearest barrier.
ENDS = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"},
        "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}, "body": {"head"}}
BARRIERS = frozenset("ul ol dl table select div section article main aside nav body".split())

NAMES = re.compile(r"[A-Za-z]+")
#: Words of short blocks that tell a role in many pages. (Other words would only repeat
#: what the training pages happened to say.)
CUES = frozenset("accept advertisement comment comments cookie cookies copyright email home login "
                 "menu newsletter popular privacy related reply search share sponsored subscribe "
                 "terms".split())


class Block:
    __slots__ = ("text", "path", "names", "linked")

    def __init__(self, text, path, names, linked):
        self.text, self.path, self.names, self.linked = text, path, names, linked


class Leaves(HTMLParser):
    """Leaf blocks of a page. Markup that a page leaves open is closed by what follows."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.blocks: list[Block] = []
        self.open: list[tuple[str, tuple[str, ...]]] = []
        self.run: list[str] = []
        self.in_link = 0

    def end_block(self):
        text = " ".join("".join(self.run).split())
        self.run = []
        if text:
            path = tuple(t for t, _ in self.open if t not in INLINE)
            names = tuple(n for _, own in self.open for n in own)
            self.blocks.append(Block(text, path, names, min(1.0, self.in_link / len(text))))
        self.in_link = 0

    def close(self):
        super().close()
        self.end_block()

    def drop(self, tags, barriers):
        for k in range(len(self.open) - 1, -1, -1):
            if self.open[k][0] in tags:
                del self.open[k:]
                return
            if self.open[k][0] in barriers:
                return

    def handle_starttag(self, tag, attrs):
        if tag not in INLINE:
            self.end_block()
            if tag in ENDS:
                self.drop(ENDS[tag], BARRIERS - {tag})
            self.drop({"p"}, BARRIERS)
        elif tag == "br":
            self.run.append(" ")
        if tag not in VOID:
            names = tuple(
                w.lower() for key, value in attrs if key in ("class", "id", "role") and value
                for w in NAMES.findall(value))
            self.open.append((tag, names))

    def handle_startendtag(self, tag, attrs):
        self.handle_starttag(tag, attrs)
        if tag not in VOID:
            self.handle_endtag(tag)

    def handle_endtag(self, tag):
        if tag not in INLINE:
            self.end_block()
        if tag not in VOID:
            self.drop({tag}, BARRIERS - {tag} if tag in INLINE or tag == "p" else frozenset())

    def handle_data(self, data):
        if not any(t in UNSEEN for t, _ in self.open):
            self.run.append(data)
            if any(t == "a" for t, _ in self.open):
                self.in_link += len(data.strip())


#: A tag that the end of the page cuts off is markup, not text.
CUT_TAG = re.compile(r"<(?:[A-Za-z/!?][^<>]*)?$")


def blocks(html: str | None) -> list[Block]:
    parser = Leaves()
    parser.feed(CUT_TAG.sub("", html or ""))
    parser.close()
    return parser.blocks


def features(block: Block) -> list[int]:
    text = block.text
    words = text.split()
    n = len(words)
    letters = sum(map(str.isalpha, text))
    found = {f"in {t}" for t in block.path} | {f"named {w}" for w in block.names}
    found |= {
        f"leaf {block.path[-1] if block.path else ''}",
        f"leaf {'/'.join(block.path[-2:])}",
        f"words {min(8, n.bit_length())}",
        f"links {round(4 * block.linked)}",
        f"ends {text[-1] if not text[-1].isalnum() else 'a'}",
        f"signs {min(4, int(10 * (1 - letters / len(text)) / 2))}",
    }
    if n <= 12:
        found |= {f"word {w}" for w in CUES.intersection(NAMES.findall(text.lower()))}
        found |= {"sign ©"} if "©" in text else set()
    return [zlib.crc32(f.encode()) % HASHED for f in sorted(found)]


# Names under which pages commonly hold their parts, and words that notices, forms and
# menus use: the values of the training layouts.
CONTENT_NAMES = ("content", "main-content", "post", "post-body", "entry-content", "story",
                 "article-body", "text", "body-text", "page-content")
ASIDE_PARTS = (
    '<aside class="sidebar"><h3>Related</h3><ul><li><a href="#">{a}</a></li><li><a href="#">{b}</a></li></ul></aside>',
    '<div class="sidebar"><h3>Popular</h3><p>{a}</p><p><a href="#">{b}</a></p></div>',
    '<div class="ad">{a}</div>', '<div class="advert banner"><p>{a}</p></div>',
    '<div class="ads sponsored promo"><a href="#">{a}</a></div>',
    '<div class="cookie-notice"><p>We use cookies. {a}</p><button>Accept</button></div>',
    '<div id="notice" class="cookie consent banner popup">{a}</div>',
    '<div class="newsletter subscribe"><form action="/s"><label>Email</label><input name="e"><button>Subscribe</button><p>{a}</p></form></div>',
    '<form class="search"><label>Search</label><input name="q"><select><option>{a}</option></select></form>',
    '<div class="share social"><a href="#">Share</a> <a href="#">{a}</a></div>',
    '<div class="breadcrumb breadcrumbs"><a href="/">Home</a> <a href="#">{a}</a></div>',
    '<div class="menu navigation navbar"><ul><li><a href="#">{a}</a></li><li><a href="#">{b}</a></li></ul></div>',
    '<div class="related recommended widget"><p><a href="#">{a}</a></p></div>',
    '<section id="comments" class="comments"><h2>Comments</h2><div class="comment"><p class="author">{a}</p><p>{b} {long}</p></div><div class="comment reply"><p>{long}</p></div></section>',
    '<div class="comments comment-list"><ol><li class="comment"><p>{long}</p></li><li><p>{b}</p></li></ol></div>',
)
HEADS = ('<header class="site-header"><a href="/">{a}</a></header><nav><ul><li><a href="#">{b}</a></li></ul></nav>',
         '<div id="header" class="header top"><h2>{a}</h2></div>', '<nav><a href="#">{a}</a> | <a href="#">{b}</a></nav>', "")
FEET = ('<footer><p>{a}</p><p>&copy; 2024 {b}</p></footer>', '<div id="footer" class="footer copyright bottom">{a} &middot; {b}</div>',
        '<div class="footer legal"><a href="#">Privacy</a> <a href="#">Terms</a> {a}</div>', "")


def own_labels(page: list[Block]) -> np.ndarray:
    """1 for blocks that stand in the page's article or main part and in none of the
    parts that are not."""
    beside = {"nav", "aside", "footer", "form", "button", "select", "figcaption"}
    return np.array([
        bool({"article", "main"} & set(b.path)) and not beside & set(b.path)
        and not {"ad", "ads", "advert", "comment", "comments", "share", "notice"} & set(b.names)
        for b in page], np.int8)


def laid_out(paragraphs: list[str], title: str, short: list[str], rng) -> tuple[str, list[str]]:
    """A page with known roles: its HTML, and its content blocks' texts."""
    import html

    def pick(parts):
        a, b = (html.escape(short[rng.integers(len(short))]) for _ in range(2))
        text = html.escape(paragraphs[rng.integers(len(paragraphs))])
        return parts[rng.integers(len(parts))].format(a=a, b=b, long=text)

    body = [f"<h1>{html.escape(title)}</h1>"]
    tag = ("p", "p", "p", "div", "li", "blockquote", "h2")
    for text in paragraphs:
        kind = tag[rng.integers(len(tag))] if rng.random() < 0.3 else "p"
        body.append(f"<{kind}>{html.escape(text)}</{kind}>")
        if rng.random() < 0.15:
            body.append(pick(ASIDE_PARTS))
    name = CONTENT_NAMES[rng.integers(len(CONTENT_NAMES))]
    opening, closing = (
        ("<article>", "</article>"), ("<main>", "</main>"),
        (f'<div class="{name}">', "</div>"), (f'<section id="{name}">', "</section>"),
        ("<main><article>", "</article></main>"), (f'<div id="wrap"><div class="{name}">', "</div></div>"),
    )[rng.integers(6)]
    extra = [pick(ASIDE_PARTS) for _ in range(rng.integers(4))]
    before = [x for x in extra if rng.random() < 0.4]
    after = [x for x in extra if x not in before]
    page = "".join([pick(HEADS), *before, opening, *body, closing, *after, pick(FEET)])
    return f"<html><body>{page}</body></html>", [title, *paragraphs]


@dataclass
class Model:
    weights: np.ndarray
    bias: float
    start: float
    potential: np.ndarray

    def content(self, page: list[Block], lead) -> np.ndarray:
        if not page:
            return np.empty(0, np.int8)
        return best_path(np.array([lead(b) for b in page]), self.start, self.potential)


def train(pages: list[str]) -> Model:
    """The field from some pages; pages whose article cannot be told teach nothing. Without
    any, from layouts of placeholder words."""
    rng = np.random.default_rng(3)
    chains: list[tuple[list[Block], np.ndarray]] = []
    for html in pages:
        page = blocks(html)
        labels = own_labels(page)
        if labels.any() and not labels.all():
            chains.append((page, labels))
    for page, labels in list(chains) or [(blocks("<p>Lorem ipsum dolor.</p><p>Sit amet, and so on.</p>"), np.ones(2, np.int8))] * 20:
        inside = [b.text for b, k in zip(page, labels, strict=True) if k]
        outside = [b.text for b, k in zip(page, labels, strict=True) if not k] or ["Home", "About us"]
        for _ in range(3):
            html, wanted = laid_out(inside[1:] or inside, inside[0], outside, rng)
            made = blocks(html)
            known = set(wanted)
            beside = {"aside", "nav", "footer", "form", "header"}
            names = {"ad", "advert", "ads", "comments", "comment", "sidebar", "notice", "related", "share",
                     "menu", "header", "footer", "newsletter", "breadcrumb"}
            chains.append((made, np.array([
                b.text in known and not beside & set(b.path) and not names & set(b.names) for b in made], np.int8)))
    chains = [c for c in chains if c[0]]
    lists = [features(b) for page, _ in chains for b in page]
    lengths = np.array([len(page) for page, _ in chains])
    starts = np.concatenate([[0], np.cumsum(lengths)[:-1]])
    first = np.concatenate([[0], np.cumsum([len(x) for x in lists])[:-1]])
    theta, bias, start, steps = fitted(
        np.concatenate([np.array(x) for x in lists]), first, np.arange(len(lists)), starts, lengths,
        np.concatenate([m for _, m in chains]).astype(float), HASHED, EPOCHS, RIDGE)
    return Model(theta, bias, start, np.exp(steps))


def fit(pages: DataFrame, training_pages: int = TRAINING_PAGES, id_column: str = "page_id",
        html_column: str = "html") -> Model:
    """The model from ``training_pages`` pages by the hash of their id."""
    rows = pages.where(F.col(html_column).isNotNull()).select(
        F.xxhash64(id_column).alias("_spread"), F.col(id_column).alias("_id"), F.col(html_column).alias("_html"))
    few = rows.orderBy("_spread", "_id").limit(training_pages).collect()
    return train([r["_html"] for r in sorted(few, key=lambda r: (r["_spread"], r["_html"]))])


def extracted(pages: DataFrame, model: Model, id_column: str = "page_id", url_column: str = "url",
              html_column: str = "html") -> DataFrame:
    """(id, url, ``text``, ``n_chars``) of every page: its content blocks, joined by one
    space, white space in a block one space.

    NULL or empty html, and pages without content, have an empty text. Cut-off tags are
    markup. Pages are read whole; repeated rows give repeated results. Other columns are
    not returned.
    """
    code = pickle.dumps((model.weights, model.bias, model.start, model.potential))
    held = pages.sparkSession.sparkContext.broadcast(code)
    key = ("page text", digest(code))

    def load():
        own = Model(*pickle.loads(held.value))
        return own, own.weights.tolist()

    def run(batches):
        own, weights = worker_cache(key, load)

        def lead(block):
            return own.bias + sum([weights[f] for f in features(block)])

        for batch in batches:
            for first in range(0, batch.num_rows, 500):
                part = batch.slice(first, 500)
                found = []
                for html in texts(part.column(2)):
                    page = blocks(html)
                    found.append(" ".join(b.text for b, k in zip(page, own.content(page, lead), strict=True) if k))
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), part.column(1), pa.array(found, pa.string()),
                     pa.array([len(t) for t in found], pa.int64())],
                    names=["_id", "_url", "text", "n_chars"])

    kinds = [pages.schema[c].dataType.simpleString() for c in (id_column, url_column)]
    return pages.select(
        F.col(id_column).alias("_id"), F.col(url_column).alias("_url"), F.col(html_column).alias("_html")
    ).mapInArrow(run, f"_id {kinds[0]}, _url {kinds[1]}, text string, n_chars long").select(
        F.col("_id").alias(id_column), F.col("_url").alias(url_column), "text", "n_chars")
