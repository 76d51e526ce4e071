"""Main text of web pages by a linear-chain conditional random field over DOM leaf blocks.

A leaf block is the text between two block-level boundaries. Its features are the tags and
class or id words of its ancestors, and measures of its text (length, links, punctuation,
digits, place in the page). The field is trained on labelled pages and decoded by Viterbi; the
blocks it calls good are the page's text.

Labelled pages: a bounded sample of the pages themselves (``SAMPLE_PAGES`` with the smallest id
hashes among those of up to ``SAMPLE_CHARS`` characters; both parameters), where the ``article``
or ``main`` element says what is main text, and each article once more in ``LAYOUTS`` other
layouts, with menus, notices, adverts, forms, comments and the like around and inside, so that
pages without such an element are learnt as well. Extraction reads every page whole.

Character references are decoded, white space within a block becomes one space, blocks are
joined by one newline in page order. Scripts, styles and form controls are no blocks. A null page
counts as empty; broken markup is read as far as it goes. Repeated rows give repeated results.
"""

from __future__ import annotations

import random
import re
from collections.abc import Iterator
from functools import lru_cache
from html import escape, unescape

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cellar.llm.crf import marginals, viterbi

SAMPLE_PAGES = 200
SAMPLE_CHARS = 100_000
LAYOUTS = 5
DIMENSIONS = 1 << 13
STEPS, RATE, RIDGE = 120, 0.2, 1e-4

#: Tag names by their role (fixed values of HTML).
BLOCK_TAGS = frozenset("""address article aside blockquote body caption center dd details dialog div dl dt fieldset
    figcaption figure footer form h1 h2 h3 h4 h5 h6 header hr html legend li main menu nav ol p pre section summary
    table tbody td tfoot th thead tr ul""".split())
HIDDEN_TAGS = frozenset("script style noscript template head title textarea select option button svg iframe object "
                        "canvas audio video datalist".split())
VOID_TAGS = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: A start tag ends these open elements (beside those within them).
ENDED_BY = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"},
            "th": {"td", "th"}, "option": {"option"}}
_CONTAINERS = frozenset("ul ol dl table article section div body nav aside main form".split())
_MAIN = frozenset(("article", "main"))
_NOT_MAIN = frozenset("nav aside footer form header".split())
#: Marks the main blocks of labelled layouts.
MARK = "*main-text*"
_WORD = re.compile(r"[a-z]+")


class Element:
    """An open element with its ancestors: shared by all that is in it, never copied."""

    __slots__ = ("tag", "known", "aside", "held", "spoilt", "marked", "linked", "leaf", "upper", "_features")

    def __init__(self, tag: str, words: str, parent: Element | None):
        self.tag = tag
        # the mark of labelled layouts is no feature
        found = _WORD.findall(words.lower().replace(MARK, "")) if words else ()
        names = {_number(f"in {tag}"), *(_number(f"word {w}") for w in found)}
        above = parent.known if parent else frozenset()
        self.known = above if names <= above else above | names
        beside = not _ASIDE_WORDS.isdisjoint(found)
        #: aside: something beside the text (by tag, by words); held: within a main element;
        #: spoilt: beside the text within the main element
        tag_aside, word_aside = parent.aside if parent else (False, False)
        self.aside = (tag_aside or tag in _NOT_MAIN, word_aside or beside)
        self.held = tag in _MAIN or bool(parent and parent.held)
        self.spoilt = bool(parent and parent.spoilt) or (self.held and tag in _NOT_MAIN)
        self.marked = words == MARK or bool(parent and parent.marked)
        self.linked = tag == "a" or bool(parent and parent.linked)
        self.leaf, self.upper = (parent.leaf, parent.upper) if parent else ("", "")
        if tag in BLOCK_TAGS:
            self.leaf, self.upper = tag, self.leaf
        self._features: np.ndarray | None = None

    def features(self) -> np.ndarray:
        if self._features is None:
            own = {_number(f"held {self.held} aside {any(self.aside)}"), _number(f"leaf {self.leaf}"),
                   _number(f"leaf {self.upper} {self.leaf}" if self.upper else f"leaf {self.leaf}")}
            self._features = np.array(sorted(self.known | own), np.int32)
        return self._features


class Blocks:
    """Leaf blocks of a page: (text, innermost element, characters in links).

    One pass over the page. Open elements are found by the places of their tag, so that neither
    unclosed tags nor deep nesting are searched again and again.
    """

    def __init__(self):
        self.open: list[Element] = [Element("", "", None)]
        self.places: dict[str, list[int]] = {}
        self.last_block: list[int] = []
        self.last_container: list[int] = []
        self.hidden = 0
        self.blocks: list[tuple[str, Element, int]] = []
        self._text: list[str] = []
        self._at: Element = self.open[0]
        self._linked = 0

    def flush(self) -> None:
        if self._text:
            text = " ".join("".join(self._text).split())
            if text:
                self.blocks.append((text, self._at, self._linked))
            self._text, self._linked = [], 0

    def _pop(self, index: int) -> None:
        while len(self.open) > index:
            tag = self.open.pop().tag
            self.places[tag].pop()
            self.hidden -= tag in HIDDEN_TAGS
            if tag in BLOCK_TAGS:
                self.last_block.pop()
            if tag in _CONTAINERS:
                self.last_container.pop()

    def _last(self, tag: str) -> int:
        places = self.places.get(tag)
        return places[-1] if places else 0

    def start(self, tag: str, words: str) -> None:
        if tag in BLOCK_TAGS:
            self.flush()
            ended = max(self._last(t) for t in ("p", *ENDED_BY.get(tag, ())))
            if ended > (self.last_container[-1] if self.last_container else 0):
                self._pop(ended)
        elif tag == "br" and self._text:
            self._text.append(" ")
        if tag in VOID_TAGS:
            return
        place = len(self.open)
        self.places.setdefault(tag, []).append(place)
        if tag in BLOCK_TAGS:
            self.last_block.append(place)
        if tag in _CONTAINERS:
            self.last_container.append(place)
        self.open.append(Element(tag, words, self.open[-1]))
        self.hidden += tag in HIDDEN_TAGS

    def end(self, tag: str) -> None:
        block = tag in BLOCK_TAGS
        if block:
            self.flush()
        place = self._last(tag)
        # the end of an inline element does not reach beyond the innermost block
        if place and (block or self.hidden or place > (self.last_block[-1] if self.last_block else 0)):
            self._pop(place)

    def data(self, data: str) -> None:
        if self.hidden:
            return
        if not self._text:
            if not data.strip():
                return
            self._at = self.open[-1]
        self._text.append(data)
        if self.open[-1].linked:
            self._linked += len(data)

    def feed(self, html: str) -> None:
        """Take a page apart in one pass. What a tag or comment leaves open at the end of the page is no text."""
        at, size = 0, len(html)
        while at < size:
            found = html.find("<", at)
            if found < 0:
                found = size
            if found > at:
                self.data(unescape(html[at:found]))
            if found == size:
                return
            at = self._markup(html, found)

    def _markup(self, html: str, at: int) -> int:
        """What begins with ``<`` at ``at``; the place behind it."""
        size = len(html)
        if html.startswith("<!--", at):
            if html.startswith((">", "->"), at + 4):
                return html.index(">", at) + 1
            end = _COMMENT_END.search(html, at + 4)
            return end.end() if end else size
        if html.startswith(("<!", "<?"), at):
            end = html.find(">", at)
            return end + 1 if end >= 0 else size
        name = _TAG.match(html, at)
        if not name:
            if html.startswith("</", at) and at + 2 < size:
                end = html.find(">", at)  # a bogus comment
                return end + 1 if end >= 0 else size
            self.data("<")
            return at + 1
        closing, tag = name.group(1), name.group(2).lower()
        at, words, closed = self._attributes(html, name.end())
        if at < 0:
            return size
        if closing:
            self.end(tag)
            return at
        self.start(tag, words)
        if closed:
            if tag not in VOID_TAGS:
                self.end(tag)
        elif tag in _RAW_TAGS:
            end = _RAW_TAGS[tag].search(html, at)
            return end.start() if end else size
        return at

    @staticmethod
    def _attributes(html: str, at: int) -> tuple[int, str, bool]:
        """(place behind the tag or -1, words of the telling attributes, whether it closes itself)."""
        words, size = [], len(html)
        while True:
            space = _BETWEEN.match(html, at)
            at = space.end()
            if at >= size:
                return -1, "", False
            if html[at] == ">":
                return at + 1, " ".join(words), space.group().endswith("/")
            name = _NAME.match(html, at)
            at = name.end()
            value, equals = "", _EQUALS.match(html, at)
            if equals:
                at = equals.end()
                quote = html[at:at + 1]
                if quote in ('"', "'") and quote:
                    end = html.find(quote, at + 1)
                    if end < 0:
                        return -1, "", False
                    value, at = html[at + 1:end], end + 1
                else:
                    bare = _BARE.match(html, at)
                    value, at = bare.group(), bare.end()
            if value and name.group().lower() in _TELLING:
                words.append(unescape(value))


_TELLING = frozenset(("class", "id", "role", "data-mark"))
_COMMENT_END = re.compile(r"--!?>")
_TAG = re.compile(r"<(/?)([a-zA-Z][^\s/>]*)")
_BETWEEN = re.compile(r"[\s/]*")
_NAME = re.compile(r"=?[^\s/>=]*")
_EQUALS = re.compile(r"\s*=\s*")
_BARE = re.compile(r"[^\s>]*")
#: Elements whose content is text up to their end tag.
_RAW_TAGS = {t: re.compile(rf"</{t}(?=[\s/>])", re.I) for t in ("script", "style", "textarea", "title", "iframe")}


def leaf_blocks(html: str | None) -> list[tuple[str, Element, int]]:
    page = Blocks()
    page.feed(html or "")
    page.flush()
    return page.blocks


@lru_cache(maxsize=1 << 16)
def _number(name: str) -> int:
    return xxhash.xxh64_intdigest(name, 0) % DIMENSIONS


def _level(x: float, edges: tuple) -> int:
    return sum(x >= e for e in edges)


def _hashed(names: list[str]) -> np.ndarray:
    return np.array([_number(n) for n in names], np.int32)


def features(blocks: list[tuple[str, Element, int]]) -> list[np.ndarray]:
    """Feature numbers of every block of a page."""
    out = []
    for i, (text, element, linked) in enumerate(blocks):
        known = element.features()
        n = len(text)
        words = text.count(" ") + 1
        stops = text.count(".") + text.count(",") + text.count(";")
        key = (_level(words, (2, 4, 8, 15, 30, 80)), _level(linked / n, (0.01, 0.3, 0.6, 0.95)),
               _level(stops / words, (0.01, 0.05, 0.15, 0.3)), text[-1] in ".!?…:\"'»", "©" in text or "|" in text,
               _level(i, (1, 3, 8)), _level(len(blocks) - i, (2, 4, 9)))
        said = _TEXTS.get(key)
        if said is None:
            said = _TEXTS[key] = _hashed([f"{k} {v}" for k, v in zip(_TEXT_NAMES, key, strict=True)]
                                         + [f"words and links {key[0]} {key[1]}"])
        out.append(np.concatenate([known, said]))
    return out


_TEXTS: dict[tuple, np.ndarray] = {}
_TEXT_NAMES = ("words", "links", "stops", "ends", "sign", "from top", "from end")


# ---------------------------------------------------------------- labelled pages


def _labels(blocks: list) -> list[bool] | None:
    """Main text by the page's own elements; ``None`` where it has none."""
    if not any(e.held for _, e, _ in blocks):
        return None
    return [e.held and not e.spoilt and not e.aside[1] for _, e, _ in blocks]


#: Class and id words by what they usually hold.
WORDS = {
    "menu": "menu navbar navigation nav breadcrumb breadcrumbs topnav tabs pagination",
    "header": "header logo branding masthead tagline banner site",
    "side": "sidebar widget related recommended popular trending aside teaser",
    "advert": "ad ads advert advertisement sponsored sponsor promo promotion commercial",
    "notice": "notice cookie cookies consent gdpr alert popup modal disclaimer warning",
    "form": "form newsletter subscribe signup login search contact",
    "comments": "comments comment replies reply responses discussion disqus respond",
    "share": "share social follow tags",
    "footer": "footer copyright legal imprint bottom colophon",
}
_ASIDE_WORDS = frozenset(w for k, v in WORDS.items() if k != "header" for w in v.split())
_BODY_WORDS = "content post entry story article text body main page".split()


def layout(article: list[str], others: list[str], rng: random.Random) -> str:
    """An article in a layout of chance; its blocks are marked."""
    def pick(kind):
        name = rng.choice(WORDS[kind].split())
        if rng.random() < 0.4:
            name += rng.choice(["-box", "-wrapper", "-list", "_inner", " block"])
        return rng.choice(['class="%s"', 'id="%s"']) % name

    def phrase(low=1, high=6):
        words = rng.choice(others).split() or ["x"]
        at = rng.randrange(len(words))
        return escape(" ".join(words[at:at + rng.randint(low, high)]))

    def prose():
        return escape(rng.choice(others)[:rng.randint(40, 400)])

    def links(n):
        return "".join(f'<li><a href="/{i}">{phrase(1, 3)}</a></li>' for i in range(n))

    def wrap(kind, tag, inner):
        return f"<{tag}>{inner}</{tag}>" if rng.random() < 0.4 else f"<div {pick(kind)}>{inner}</div>"

    def comments():
        tag = rng.choice(["div", "article", "li", "section"])
        one = "".join(f'<{tag} class="comment"><p class="{rng.choice(["author", "meta", "user"])}">{phrase(1, 3)}</p>'
                      f"<p>{prose()}</p></{tag}>" for _ in range(rng.randint(1, 5)))
        return f"<{rng.choice(['div', 'section'])} {pick('comments')}><h3>{phrase(1, 2)}</h3>{one}</div></section>"

    def piece(kind):
        if kind == "menu":
            return wrap(kind, "nav", f"<ul>{links(rng.randint(2, 9))}</ul>")
        if kind == "header":
            return wrap(kind, "header", f"<h2>{phrase()}</h2><p>{phrase(3, 12)}</p>")
        if kind == "side":
            return wrap(kind, "aside", f"<h3>{phrase()}</h3><ul>{links(3)}</ul><p>{prose()}</p>")
        if kind == "advert":
            return f"<div {pick(kind)}>{rng.choice([phrase(2, 12), '<p>' + prose() + '</p>'])}</div>"
        if kind == "notice":
            return f"<div {pick(kind)}><p>{prose()}</p></div>"
        if kind == "form":
            return wrap(kind, "form", f"<p>{prose()}</p><label>{phrase()}</label><input name=a><button>{phrase()}</button>")
        if kind == "comments":
            return comments()
        if kind == "share":
            return f"<div {pick(kind)}><a href=#>{phrase(1, 2)}</a> <a href=#>{phrase(1, 2)}</a></div>"
        return wrap("footer", "footer", f"<p>&copy; {phrase(2, 8)}</p>" if rng.random() < 0.5 else f"&copy; {phrase(2, 8)}")

    def some(kinds):
        return "".join(piece(k) for k in kinds if rng.random() < 0.55)

    body = []
    for i, text in enumerate(article):
        tag = "p"
        if not i and rng.random() < 0.7:
            tag = rng.choice(["h1", "h2"])
        elif rng.random() < 0.12:
            tag = rng.choice(["blockquote", "h2", "h3", "pre", "td", "div"])
        if rng.random() < 0.4:
            text = text[:rng.randint(12, 160)]
        if rng.random() < 0.08:
            items = "".join(f"<li>{escape(rng.choice(others)[:rng.randint(8, 120)])}</li>" for _ in range(rng.randint(1, 5)))
            body.append(f'<{rng.choice(["ul", "ol"])} data-mark="{MARK}">{items}</ul></ol>')
        body.append(f'<{tag} data-mark="{MARK}">{escape(text)}</{tag}>')
        if rng.random() < 0.05:
            body.append(piece(rng.choice(["advert", "side", "share", "form", "notice"])))
    inner = "".join(body) + some(["share", "side", "comments"]) * (rng.random() < 0.5)
    name = rng.choice(_BODY_WORDS) + rng.choice(["", "", "-body", "-content", "-text"])
    held = rng.choice(["<article>%s</article>", "<main>%s</main>", f'<div class="{name}">%s</div>',
                       f'<div id="{name}"><div>%s</div></div>', f'<section class="{name}">%s</section>', "<div>%s</div>"])
    return ("<html><body>" + some(["header", "menu", "notice", "advert", "form"]) + held % inner
            + some(["side", "advert", "comments", "menu", "form", "notice"]) + piece("footer") + "</body>")


def _training(pages: list[str]) -> Iterator[tuple[list[np.ndarray], list[bool]]]:
    parsed = [leaf_blocks(p) for p in pages]
    labels = [_labels(b) for b in parsed]
    articles = []
    for blocks, marks in zip(parsed, labels, strict=True):
        if marks is not None and blocks:
            yield features(blocks), marks
        text = [b[0] for i, b in enumerate(blocks) if (marks[i] if marks is not None else b[0].count(" ") >= 9)]
        if text:
            articles.append(text)
    others = [t for a in articles for t in a]
    rng = random.Random(20240229)
    for article in articles:
        for _ in range(LAYOUTS):
            blocks = leaf_blocks(layout(article[:40], others, rng))
            yield features(blocks), [e.marked for _, e, _ in blocks]


def _node(rows: list[np.ndarray], weights: np.ndarray) -> np.ndarray:
    size = np.array([len(r) for r in rows])
    return np.add.reduceat(weights[np.concatenate(rows)], np.cumsum(size) - size)


def fit(pages: list[str]) -> np.ndarray | None:
    """Weights by gradient ascent (Adam): features, bias and four transitions."""
    chains = list(_training(pages))
    rows = [r for c, _ in chains for r in c]
    if not rows:
        return None
    size = np.array([len(r) for r in rows])
    at, block = np.concatenate(rows), np.repeat(np.arange(len(rows)), size)
    first = np.concatenate([[0], np.cumsum([len(c) for c, _ in chains])])
    good = np.concatenate([np.array(m, bool) for _, m in chains])
    inner = np.ones(len(good), bool)
    inner[first[:-1]] = False
    later = np.flatnonzero(inner)
    seen = np.bincount(2 * good[later - 1].astype(int) + good[later], minlength=4)
    weights = np.zeros(DIMENSIONS + 5)
    m, v = np.zeros_like(weights), np.zeros_like(weights)
    for k in range(1, STEPS + 1):
        node = np.bincount(block, weights[at], len(rows)) + weights[-5]
        p, counts, _ = marginals(node, first, weights[-4:], pairs=True)
        gap = good - p
        grad = np.concatenate([np.bincount(at, gap[block], DIMENSIONS), [gap.sum()], seen - counts.reshape(-1)])
        grad = grad / len(rows) - RIDGE * weights
        m, v = 0.9 * m + 0.1 * grad, 0.99 * v + 0.01 * grad * grad
        weights += RATE * (m / (1 - 0.9 ** k)) / (np.sqrt(v / (1 - 0.99 ** k)) + 1e-8)
    return weights


def train(pages: DataFrame, page_id: str = "page_id", html: str = "html") -> np.ndarray | None:
    rows = pages.select(F.col(page_id).alias("i"), F.col(html).alias("h")).where(F.length("h").between(1, SAMPLE_CHARS))
    # ids first: of the pages only the chosen ones leave their task
    chosen = rows.select("i").orderBy(F.xxhash64("i"), "i").limit(SAMPLE_PAGES).distinct().withColumnRenamed("i", "c")
    sample = (rows.join(F.broadcast(chosen), F.col("i").eqNullSafe(F.col("c")))
              .orderBy(F.xxhash64("i"), "i", F.xxhash64("h")).limit(SAMPLE_PAGES))
    return fit([r["h"] for r in sample.collect()])


def main_text(html: str | None, weights: np.ndarray | None) -> str:
    return main_texts([html], weights)[0]


def main_texts(pages: list[str | None], weights: np.ndarray | None) -> list[str]:
    parsed = [leaf_blocks(p) for p in pages]
    out = [""] * len(pages)
    rows = [features(b) for b in parsed]
    filled = [i for i, r in enumerate(rows) if r]
    if not filled or weights is None:
        return out
    node = _node([r for i in filled for r in rows[i]], weights[:DIMENSIONS]) + weights[-5]
    first = np.concatenate([[0], np.cumsum([len(rows[i]) for i in filled])])
    good = viterbi(node, first, weights[-4:])
    for i, a in zip(filled, first[:-1].tolist(), strict=True):
        out[i] = "\n".join([b[0] for b, g in zip(parsed[i], good[a:a + len(parsed[i])].tolist(), strict=True) if g])
    return out


def extract(pages: DataFrame, weights: np.ndarray | None, keep: list[str], html: str = "html") -> DataFrame:
    """Columns ``keep``, ``text`` and ``n_chars`` of every row. One map, no shuffle."""
    keep = [c for c in keep if c not in ("text", "n_chars")]
    schema = pages.select(*keep).schema.add("text", "string").add("n_chars", "long")

    def run(batches):
        for batch in batches:
            column = batch.column(batch.num_columns - 1)
            texts: list[str] = []
            for k in range(0, len(column), 64):
                texts += main_texts(column.slice(k, 64).to_pylist(), weights)
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(texts, pa.string()),
                                              pa.array([len(t) for t in texts], pa.int64())],
                                             [*batch.schema.names[:-1], "text", "n_chars"])

    # by its place: another column may have any name
    return pages.select(*keep, F.col(html).cast("string")).mapInArrow(run, schema)


def digest(pages: DataFrame) -> DataFrame:
    return extract(pages, train(pages), ["page_id", "url"])
