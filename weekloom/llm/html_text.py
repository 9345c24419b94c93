"""Main text of web pages by a linear-chain conditional random field over DOM leaf blocks.

A page becomes its leaf blocks in page order: stretches of text between block-level tags. Each block
has features from the tags, classes and roles above it and from its text (length, share of linked
text, stops, words typical of notices). The field has two states, text and other; feature weights
and transition weights are trained on labelled pages by gradient ascent on the conditional
likelihood, and the best state sequence of a page is found by Viterbi's algorithm.

``labelled_pages`` has the pages for training: templates of usual layouts, written here with a label for each
block and filled with generated words, so that layout and not vocabulary is learned.

A page is handled by itself, in one scan without a shuffle. Scripts, styles, comments and the head
hold no blocks. Blocks chosen as text are joined by an empty line; references are decoded, white
space within a block is one space.

Defined results: null or empty html, or a page without text blocks, gives an empty text; broken markup
is read as it stands (an unclosed tag ends with its parent; a head before what can't be in one; an unclosed
script, style, textarea or title with the page; other skipped elements at once); repeated rows are rows of their own; an
empty table gives an empty one; other columns are ignored.
"""

from __future__ import annotations

import html
import random
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from weekloom.llm.storage import small_batches

#: Tags within a line of text; all others begin and end blocks.
INLINE = frozenset(
    "a abbr b bdi bdo big br cite code data del dfn em font i img ins kbd label mark q rp rt ruby s samp small span strike "
    "strong sub sup time tt u var wbr".split()
)
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: Elements whose content is not page text.
SKIPPED = frozenset("script style noscript template svg head title iframe object canvas textarea select".split())
#: A start tag on the left ends an open element on the right that it can't be inside of.
ENDS = {"li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr", "td", "th"), "td": ("td", "th"), "th": ("td", "th"), "option": ("option",)}
ENDS_P = frozenset(
    "address article aside blockquote details div dl fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hr main "
    "menu nav ol p pre section table ul".split()
)
_TAG = re.compile(
    r"<!--.*?(?:-->|\Z)|<![^>]*>|<\?[^>]*>"
    r"|<(/?)([a-zA-Z][^\s/>]*)((?>[^>\"'=]+|=\s*\"[^\"]*\"|=\s*'[^']*'|[=\"'])*+)>",
    re.S,
)
#: Elements whose content is read up to their end tag, or else to the end of the page.
RAW = frozenset("script style textarea title".split())
#: What can stand in a head; any other tag ends it.
IN_HEAD = frozenset("base basefont bgsound head html link meta noframes noscript script style template title".split())
_RAW_END = {name: re.compile(rf"</{name}(?=[\s/>])[^>]*>", re.I) for name in RAW}
_ATTRIBUTE = re.compile(r"([a-zA-Z-]+)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))")
_SPACE = re.compile(r"\s+")
_NAME_PART = re.compile(r"[a-z]+")
NOTICE_WORDS = frozenset(
    "cookie cookies subscribe newsletter login sign advertisement sponsored comment comments reply share copyright rights reserved "
    "privacy policy terms menu search related".split()
)


class Block:
    __slots__ = ("text", "path", "marks", "linked")

    def __init__(self, text: str, path: tuple[str, ...], marks: frozenset[str], linked: int) -> None:
        self.text, self.path, self.marks, self.linked = text, path, marks, linked


def _marks_of(attributes: str) -> frozenset[str]:
    """Words of the class, id and role of an element."""
    if "=" not in attributes:
        return frozenset()
    values = [
        (double or single or bare).lower()
        for name, double, single, bare in _ATTRIBUTE.findall(attributes)
        if name.lower() in ("class", "id", "role")
    ]
    return frozenset(_NAME_PART.findall(" ".join(values)))


def _pairs(page: str, name: str) -> dict[int, int]:
    """Where the content of each closed element of that name begins, and where its end tag ends."""
    tag = re.compile(
        r"<!--.*?(?:-->|\Z)|<(script|style|textarea|title)(?=[\s/>]).*?(?:</\1(?=[\s/>])|\Z)"
        rf"|<(/?){re.escape(name)}(?=[\s/>])((?>[^>\"'=]+|=\s*\"[^\"]*\"|=\s*'[^']*'|[=\"'])*+)>",
        re.S | re.I,
    )
    out, opened = {}, []
    for found in tag.finditer(page):
        if found.group(2) == "/":
            if opened:
                out[opened.pop()] = found.end()
        elif found.group(2) is not None and not found.group(3).endswith("/"):
            opened.append(found.end())
    return out


def blocks_of(page: str) -> list[Block]:
    """Leaf blocks in page order. A block ends at each block-level tag."""
    blocks: list[Block] = []
    stack: list[tuple[str, frozenset[str]]] = []
    parts: list[str] = []
    linked, links, at, end = 0, 0, 0, len(page)
    headed, pairs = False, {}

    def after(name: str, at: int) -> int:
        """Where a skipped element ends whose content begins at ``at``. One without an end tag has no content."""
        if name in RAW:
            stop = _RAW_END[name].search(page, at)
            return stop.end() if stop else end
        if name not in pairs:
            pairs[name] = _pairs(page, name)
        return pairs[name].get(at, at)

    def after_head(at: int) -> int:
        """Where the head ends whose content begins at ``at``: without an end tag, before what can't be in it."""
        text = None
        while tag := _TAG.search(page, at):
            if text is None and page[at : tag.start()].strip():
                text = at
            at = tag.end()
            if not tag.group(2):
                continue
            name, closing = tag.group(2).lower(), tag.group(1) == "/"
            if closing and name == "head":
                return at
            if name in ("body", "html", "br") if closing else name not in IN_HEAD:
                return tag.start() if text is None else text
            if not closing and name in SKIPPED and name != "head" and not tag.group(3).endswith("/"):
                at = after(name, at)
        return at if text is None else text

    def close() -> None:
        nonlocal linked
        text = _SPACE.sub(" ", html.unescape("".join(parts))).strip()
        if text:
            marks = frozenset().union(*[m for _, m in stack])
            blocks.append(Block(text, tuple(t for t, _ in stack if t not in INLINE), marks, linked))
        parts.clear()
        linked = 0

    while at < end:
        tag = _TAG.search(page, at)
        piece = page[at : tag.start() if tag else end]
        if piece:
            parts.append(piece)
            if links:
                linked += len(piece)
        if not tag:
            break
        at = tag.end()
        if not tag.group(2):
            continue
        name, closing = tag.group(2).lower(), tag.group(1) == "/"
        if name in SKIPPED and not closing:
            if name == "head":
                # A page has one head.
                at, headed = at if headed else after_head(at), True
            elif not tag.group(3).endswith("/"):
                at = after(name, at)
            continue
        if name not in INLINE:
            close()
        elif name == "br":
            parts.append(" ")
        if closing:
            depth = next((d for d in range(len(stack) - 1, -1, -1) if stack[d][0] == name), None)
            if depth is not None:
                # An inline end tag doesn't end a block element that is open inside it.
                if name in INLINE and any(t not in INLINE for t, _ in stack[depth + 1 :]):
                    stack.pop(depth)
                else:
                    del stack[depth:]
        elif name not in VOID and not tag.group(3).endswith("/"):
            ended = ENDS.get(name, ()) + (("p",) if name in ENDS_P else ())
            if ended:
                for depth in range(len(stack) - 1, -1, -1):
                    if stack[depth][0] in ended:
                        del stack[depth:]
                        break
                    if stack[depth][0] in ("ul", "ol", "table", "dl", "select", "article", "section", "div", "td", "body"):
                        break
            if name not in INLINE:
                # Open inline elements end with the block they began in.
                while stack and stack[-1][0] in INLINE:
                    stack.pop()
            stack.append((name, _marks_of(tag.group(3))))
        links = sum(t == "a" for t, _ in stack)
    close()
    return blocks


def features_of(blocks: list[Block]) -> list[list[str]]:
    """Names of each block's features. Headings and first blocks also see what follows."""
    out = []
    for k, block in enumerate(blocks):
        words = block.text.split()
        n = len(words)
        names = ["bias", "size:" + ("0" if n < 3 else "1" if n < 8 else "2" if n < 20 else "3" if n < 60 else "4")]
        names += [f"in:{tag}" for tag in set(block.path)]
        names.append(f"leaf:{block.path[-1] if block.path else ''}")
        names += [f"mark:{mark}" for mark in block.marks]
        share = block.linked / max(1, len(block.text))
        names.append("links:" + ("0" if share < 0.1 else "1" if share < 0.5 else "2"))
        names.append("stop:" + str(int(block.text[-1] in ".!?:;\"'")))
        if any(w.strip(".,:;!?").lower() in NOTICE_WORDS for w in words[:12]):
            names.append("notice")
        if block.text[0] in "©" or "©" in block.text[:20]:
            names.append("copyright")
        names.append("place:" + ("first" if k == 0 else "last" if k == len(blocks) - 1 else "inner"))
        out.append(names)
    return out


class Field:
    """Linear-chain conditional random field with two states; state 1 is text."""

    def __init__(self, index: dict[str, int], weights: np.ndarray, moves: np.ndarray, begin: np.ndarray) -> None:
        self.index, self.weights, self.moves, self.begin = index, weights, moves, begin

    def scores(self, features: list[list[str]]) -> np.ndarray:
        out = np.zeros((len(features), 2))
        for k, names in enumerate(features):
            at = [self.index[n] for n in names if n in self.index]
            out[k] = self.weights[at].sum(0)
        return out

    def decode(self, features: list[list[str]]) -> list[int]:
        """The most likely states (Viterbi); ties go to other."""
        if not features:
            return []
        scores = self.scores(features).tolist()
        (m00, m01), (m10, m11) = self.moves.tolist()
        a, b = scores[0][0] + float(self.begin[0]), scores[0][1] + float(self.begin[1])
        back = []
        for s0, s1 in scores[1:]:
            from0, from1 = int(b + m10 > a + m00), int(b + m11 > a + m01)
            back.append((from0, from1))
            a, b = (b + m10 if from0 else a + m00) + s0, (b + m11 if from1 else a + m01) + s1
        states = [int(b > a)]
        for step in reversed(back):
            states.append(step[states[-1]])
        return states[::-1]

    def gradient(self, features: list[list[int]], states: list[int]):
        """Log-likelihood of ``states`` and its gradients, by the forward-backward algorithm."""
        n = len(states)
        scores = np.array([self.weights[at].sum(0) for at in features])
        forward, backward = np.zeros((n, 2)), np.zeros((n, 2))
        forward[0] = scores[0] + self.begin
        for k in range(1, n):
            forward[k] = scores[k] + np.logaddexp(forward[k - 1, 0] + self.moves[0], forward[k - 1, 1] + self.moves[1])
        for k in range(n - 2, -1, -1):
            after = scores[k + 1] + backward[k + 1]
            backward[k] = np.logaddexp(self.moves[:, 0] + after[0], self.moves[:, 1] + after[1])
        total = np.logaddexp(*forward[-1])
        single = np.exp(forward + backward - total)
        moved = np.zeros((2, 2))
        for k in range(1, n):
            moved -= np.exp(forward[k - 1][:, None] + self.moves + (scores[k] + backward[k])[None, :] - total)
        value = self.begin[states[0]] + scores[np.arange(n), states].sum() - total
        for a, b in zip(states, states[1:]):
            moved[a, b] += 1
            value += self.moves[a, b]
        target = np.zeros((n, 2))
        target[np.arange(n), states] = 1
        return value, target - single, moved, target[0] - single[0]


def train(pages: list[tuple[str, list[int]]], rounds: int = 30, rate: float = 0.5, penalty: float = 1e-3) -> Field:
    """A field from pages and a state for each of their leaf blocks. ``pages`` is small: it is trained on the driver."""
    named = [(features_of(blocks_of(page)), states) for page, states in pages]
    for names, states in named:
        if len(names) != len(states):
            raise ValueError("a page needs one label for each leaf block")
    index = {n: i for i, n in enumerate(sorted({n for names, _ in named for block in names for n in block}))}
    numbered = [([[index[n] for n in block] for block in names], states) for names, states in named if states]
    field = Field(index, np.zeros((len(index), 2)), np.zeros((2, 2)), np.zeros(2))
    sums = [np.full_like(field.weights, 1e-3), np.full((2, 2), 1e-3), np.full(2, 1e-3)]
    for _ in range(rounds):
        gradient = [-penalty * field.weights * len(numbered), np.zeros((2, 2)), np.zeros(2)]
        for features, states in numbered:
            _, of_blocks, moved, begun = field.gradient(features, states)
            for at, g in zip(features, of_blocks):
                gradient[0][at] += g
            gradient[1] += moved
            gradient[2] += begun
        for values, g, held in zip((field.weights, field.moves, field.begin), gradient, sums):
            held += g * g
            values += rate * g / np.sqrt(held)
    return field


# ---------------------------------------------------------------------------------------------------
# Labelled pages. In the layouts, `{1:12}` is 12 words of main text, `{0:3}` are 3 words of anything
# else; each must be a leaf block of its own or continue one of its kind.

_HEADS = (
    '<nav><ul>@<li><a href="/x">{0:1}</a></li>@</ul></nav>',
    '<header><a href="/">{0:2}</a><p>{0:5}</p></header><nav class="menu">@<a href="#">{0:2}</a><div></div>@</nav>',
    '<div id="header"><h2>{0:2}</h2></div><ul class="navigation">@<li>{0:1}</li>@</ul>',
    '<div class="topbar"><span>{0:4}</span></div><div role="navigation">@<div><a href="/y">{0:2}</a></div>@</div>',
    "",
)
_NOTICES = (
    '<div class="ad">{0:10}.</div>',
    '<div class="cookie-notice"><p>We use cookies {0:12}.</p><button>{0:1}</button></div>',
    '<aside class="banner">{0:8}.</aside>',
    '<div class="advert sponsored"><p>{0:25}.</p></div>',
    '<section class="newsletter"><h3>Subscribe {0:2}</h3><form><label>{0:2}</label><input><button>{0:1}</button></form></section>',
    '<div class="consent" role="dialog"><h2>Privacy {0:2}</h2><p>{0:20}.</p><ul><li>{0:3}</li><li>{0:4}</li></ul><button>{0:1}</button></div>',
    '<section class="promo sponsored"><h2>{0:5}</h2><p>{0:30}.</p><ol><li>{0:4}</li></ol></section>',
    '<aside><h4>{0:3}</h4><p>{0:14}.</p></aside>',
    "",
    "",
    "",
)
_BODIES = (
    "<article><h1>{1:9}</h1>#</article>",
    "<main><h1>{1:7}</h1>#</main>",
    '<div class="content"><h1>{1:6}</h1>#</div>',
    '<article class="post"><header><h1>{1:8}</h1></header>#</article>',
    '<div id="main"><div class="entry"><h2>{1:6}</h2>#</div></div>',
    "<main><article>#</article></main>",
    "<article><header><h1>{1:7}</h1><p>{1:15}.</p></header><section>#</section></article>",
    '<div class="story"><h1>{1:6}</h1><div class="text">#</div></div>',
    "<main><section><h2>{1:5}</h2>#</section></main>",
)
_PARAGRAPHS = (
    "<p>{1:40}.</p>",
    "<p>{1:14}.</p>",
    "<p>{1:90}.</p>",
    "<p>{1:2}.</p>",
    "<p><b>{1:8}.<br><p>{1:30}.</p>",
    "<p>{1:10} <a href='/z'>{1:2}</a> {1:12}.</p>",
    "<h2>{1:4}</h2><p>{1:30}.</p>",
    "<ul><li>{1:6}</li><li>{1:9}.</li></ul>",
    "<blockquote>{1:20}.</blockquote>",
    "<table><tr><td>{1:3}</td><td>{1:2}</td></tr></table>",
    "<pre>{1:12}</pre>",
    "<h3>{1:4}</h3><p>{1:35}.</p>",
    "<h3>{1:3}</h3><h4>{1:4}</h4><p>{1:20}.</p><h5>{1:2}</h5><p>{1:15}.</p><h6>{1:3}</h6><p>{1:9}.</p>",
    "<section><h3>{1:4}</h3><p>{1:30}.</p><ol><li>{1:8}.</li><li>{1:3}</li></ol></section>",
    "<section><h2>{1:3}</h2><p>{1:40}.</p></section>",
    "<ol><li>{1:12}.</li><li>{1:4}</li><li><p>{1:9}.</p></li></ol>",
    "<dl><dt>{1:2}</dt><dd>{1:10}.</dd><dt>{1:1}</dt><dd>{1:4}</dd></dl>",
    "<figure><img src='i'><figcaption>{1:9}.</figcaption></figure>",
    "<div>{1:35}.</div>",
    "<div><div>{1:12}.</div><div>{1:50}.</div></div>",
    "<p>{1:25}.</p><aside class='related'><a href='/r'>{0:5}</a></aside><p>{1:20}.</p>",
    "<div class='ad'>{0:9}.</div><p>{1:30}.</p>",
)
_TAILS = (
    "<footer>&copy; {0:9}.</footer>",
    '<aside class="sidebar"><h3>{0:2}</h3><ul>@<li><a href="/s">{0:6}</a></li>@</ul></aside><footer><p>&copy; {0:4}</p></footer>',
    '<section class="comments"><h3>{0:2}</h3>@<div class="comment"><p>{0:25}.</p></div>@</section><footer>{0:5}</footer>',
    '<div id="comments"><ol>@<li class="comment">{0:18}.</li>@</ol><form><textarea></textarea><label>{0:3}</label></form></div><div class="footer">{0:6}</div>',
    '<section class="related"><h2>{0:3}</h2>@<article><h3><a href="/m">{0:6}</a></h3><p><a href="/m">{0:12}</a></p></article>@</section><footer><p>{0:12}.</p></footer>',
    '<section id="comments"><h2>{0:2}</h2>@<article class="comment"><h4>{0:2}</h4><p>{0:30}.</p></article>@</section><footer><h5>{0:2}</h5><ul>@<li><a href="/t">{0:2}</a></li>@</ul></footer>',
    '<form class="search"><label>{0:2}</label><input><button>{0:1}</button></form><div id="footer"><p>&copy; {0:7}</p></div>',
    "",
)
#: Private characters that carry a slot's state until the page is cut into blocks.
_STATE_MARKS = (chr(0xE000), chr(0xE001))
_SLOT = re.compile(r"\{([01]):(\d+)\}")


#: Parts of a page, top to bottom; the third holds paragraphs of the fourth.
LAYOUTS = (_HEADS, _NOTICES, _BODIES, _PARAGRAPHS, _TAILS)


def labelled_pages(n: int = 240, seed: int = 7, layouts=LAYOUTS) -> list[tuple[str, list[int]]]:
    """``n`` pages with the states of their leaf blocks."""
    heads, notices, bodies, paragraph_forms, tails = layouts
    rng = random.Random(seed)
    vocabulary = ["".join(rng.choice("aeioubcdfglmnprst") for _ in range(rng.randint(2, 9))) for _ in range(600)]

    def repeated(layout: str) -> str:
        parts = layout.split("@")
        return "".join(p * rng.randint(2, 6) if k % 2 else p for k, p in enumerate(parts))

    pages = []
    for _ in range(n):
        paragraphs = "".join(rng.choice(paragraph_forms) for _ in range(rng.randint(1, 9)))
        body = rng.choice(bodies).replace("#", paragraphs)
        layout = repeated(rng.choice(heads)) + rng.choice(notices) + body + repeated(rng.choice(tails))

        def fill(slot: re.Match) -> str:
            count = max(1, round(int(slot[2]) * rng.uniform(0.6, 1.5)))
            words = [rng.choice(vocabulary) for _ in range(count)]
            return _STATE_MARKS[int(slot[1])] + " ".join(words).capitalize()

        marked = _SLOT.sub(fill, layout)
        states = [int(_STATE_MARKS[1] in block.text) for block in blocks_of(f"<html><head></head><body>{marked}</body></html>")]
        page = marked.replace(_STATE_MARKS[0], "").replace(_STATE_MARKS[1], "")
        pages.append((f"<html><head></head><body>{page}</body></html>", states))
    return pages


def main_text(page: str | None, field: Field) -> str:
    blocks = blocks_of(page or "")
    return "\n\n".join(b.text for b, state in zip(blocks, field.decode(features_of(blocks))) if state)


def _extract(field: Field):
    def run(batches):
        for batch in batches:
            texts = [main_text(page, field) for page in batch.column("html").to_pylist()]
            sizes = pa.array([len(t) for t in texts], pa.int64())
            arrays = [batch.column("page_id"), batch.column("url"), pa.array(texts, pa.string()), sizes]
            yield pa.RecordBatch.from_arrays(arrays, ["page_id", "url", "text", "n_chars"])

    return run


def extract_text(
    pages: DataFrame, field: Field | None = None, id_col: str = "page_id", url_col: str = "url", html_col: str = "html"
) -> DataFrame:
    """``page_id``, ``url``, ``text`` and ``n_chars`` of every page; ``field`` defaults to one trained on ``labelled_pages``."""
    small_batches(pages)
    field = field or train(labelled_pages())
    rows = pages.select(
        F.col(f"`{id_col}`").alias("page_id"), F.col(f"`{url_col}`").alias("url"), F.col(f"`{html_col}`").cast("string").alias("html")
    )
    kinds = {f.name: f.dataType.simpleString() for f in rows.schema}
    return rows.mapInArrow(_extract(field), f"page_id {kinds['page_id']}, url {kinds['url']}, text string, n_chars long")
