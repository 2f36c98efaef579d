"""Main text of web pages: a linear-chain conditional random field over the leaf blocks of the page.

A leaf block is the text between two block-level tags. Its features are the tags and the telling class and id words
of its ancestors, and the look of its text. Weights are learned from labelled pages, which are put together from the
text of a bounded sample of the table's own pages and layouts of many kinds; Viterbi finds each page's best labelling.
"""

import functools
import html as entities
import re
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyward.llm.tables import text_or_empty

SAMPLE_PAGES, SAMPLE_CHARS = 200, 20_000  # whose text the labelled pages are made of
LABELLED_PAGES = 400
_TAG = re.compile(r"""<!--.*?(?:-->|\Z)|<[!?][^>]*>|<(/?)([a-zA-Z][a-zA-Z0-9:-]*)((?:[^<>"']|"[^"<]*"|'[^'<]*')*+[^>]*)>""", re.S)
_NAMES = re.compile(r"""\b(?:class|id|role)\s*=\s*("[^"]*"|'[^']*'|[^\s>]+)""", re.I)
_RAW = {t: re.compile(rf"</{t}\b[^>]*>", re.I) for t in ("script", "style", "template", "noscript", "svg", "textarea", "iframe")}
_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
_BLOCK = frozenset(
    "address article aside blockquote body button center dd details dialog div dl dt fieldset figcaption figure footer form "
    "h1 h2 h3 h4 h5 h6 head header hr html label legend li main menu nav ol option p pre section select summary table tbody "
    "td tfoot th thead title tr ul".split())
_HIDDEN = frozenset(["head", "title"])
_IN_HEAD = frozenset("html head title base basefont bgsound link meta script style template noscript".split())
_CLOSES = {"p": {"p"}, "li": {"li", "p"}, "dt": {"dt", "dd", "p"}, "dd": {"dt", "dd", "p"}, "tr": {"tr", "td", "th", "p"},
           "td": {"td", "th", "p"}, "th": {"td", "th", "p"}, "option": {"option"}}
_LISTS = frozenset("ul ol dl table tbody thead div article section aside nav main header footer form td select".split())
#: Words in class, id and role that pages use by custom.
CUES = frozenset(
    "ad ads advert advertisement sponsor sponsored promo promotion cookie cookies consent notice banner alert popup modal nav "
    "navigation navbar menu breadcrumb breadcrumbs sidebar widget related recommended footer header masthead comment comments "
    "reply replies respond discussion share social newsletter subscribe signup login search form tags meta author byline "
    "pagination content article post entry story body main text page".split())
MARK = "\x02"  # begins a text that belongs to the article, in labelled pages only


@dataclass
class Block:
    text: str
    tags: frozenset[str]
    last: str
    cues: frozenset[str]
    linked: float


class _Stack:
    """The open tags. What a block needs of all its ancestors is kept with each of them, shared where nothing new came, and
    where each name is open is kept as well: no step looks through the whole stack."""

    def __init__(self):
        self.open: list[tuple[str, frozenset, str, frozenset]] = []  # tag; tags, last block-level tag and cues up to it
        self.places: dict[str, list[int]] = {}

    def top(self) -> tuple[str, frozenset, str, frozenset]:
        return self.open[-1] if self.open else ("", frozenset(), "", frozenset())

    def push(self, tag: str, cues: frozenset) -> None:
        _, tags, last, known = self.top()
        self.places.setdefault(tag, []).append(len(self.open))
        self.open.append((tag, tags if tag in tags else tags | {tag}, tag if tag in _BLOCK else last, known if cues <= known else known | cues))

    def last(self, names) -> int:
        """The place of the innermost open tag of these names, or -1."""
        return max((self.places[t][-1] for t in names if self.places.get(t)), default=-1)

    def pop(self, to: int) -> None:
        while len(self.open) > to:
            self.places[self.open.pop()[0]].pop()

    def count(self, names) -> int:
        return sum(len(self.places.get(t, ())) for t in names)


def blocks(page: str) -> list[Block]:
    """The leaf blocks that hold text, in page order; character references decoded, white space as single spaces.

    Takes time in proportion to the page, whatever its tags.
    """
    stack = _Stack()
    out: list[Block] = []
    parts: list[str] = []
    links = 0

    def close() -> None:
        nonlocal links
        if parts:
            text = " ".join(entities.unescape("".join(parts)).split())
            if text:
                _, tags, last, cues = stack.top()
                out.append(Block(text, tags, last, cues, min(1.0, links / len(text))))
            parts.clear()
        links = 0

    def end_head() -> None:
        if stack.places.get("head"):
            stack.pop(stack.places["head"][0])

    at, end = 0, page.rfind(">") + 1  # behind it no tag can end
    while True:
        found = _TAG.search(page, at, end) if at < end else None
        text = page[at: found.start() if found else len(page)]
        if not found and "<!--" in text:
            text = text[: text.index("<!--")]
        hidden = stack.count(_HIDDEN)
        if hidden and stack.top()[0] == "head" and text.strip():
            end_head()
            hidden = stack.count(_HIDDEN)
        if text and not hidden:
            parts.append(text)
            links += len(text) if stack.places.get("a") else 0
        if not found:
            break
        at = found.end()
        if not found[2]:
            if found[0].startswith("<!--") and not found[0].endswith("-->"):
                break  # a comment without an end
            continue
        tag = found[2].lower()
        if found[1]:
            if tag in _BLOCK:
                close()
            place = stack.last((tag,))
            if place >= 0:
                stack.pop(place)
            continue
        if hidden and tag not in _IN_HEAD and (tag == "body" or stack.top()[0] != "title"):  # a title's tags are text
            end_head()
        if tag in _RAW and not (tag == "svg" and found[3].endswith("/")):
            closing = _RAW[tag].search(page, at, end)
            if not closing:
                break  # the rest belongs to it
            at = closing.end()
            continue
        if tag == "br":
            if not stack.count(_HIDDEN):
                parts.append(" ")
            continue
        if tag in _BLOCK:
            close()
            shut = stack.last(_CLOSES.get(tag) or ({"p"} if tag != "body" else ()))
            if shut >= 0 and shut >= stack.last(_LISTS):  # td is in both
                stack.pop(shut)
        if tag not in _VOID and not found[3].endswith("/"):
            words = " ".join(v.strip("\"'") for v in _NAMES.findall(found[3])).lower() if found[3] else ""
            stack.push(tag, CUES.intersection(re.split(r"[^a-z]+", words)) if words else frozenset())
    close()
    return out


def features(page: list[Block]) -> list[list[str]]:
    """Names of the features of each block."""
    out = []
    for i, b in enumerate(page):
        n = len(b.text)
        last = b.last
        f = ["any", "at " + last, f"size {min(7, n.bit_length() // 2)}", f"links {round(2 * b.linked)}"]
        f += ["in " + t for t in b.tags]
        f += ["cue " + c for c in b.cues]
        if b.text[-1] in ".!?…\"'»”":
            f.append("stop")
        if "©" in b.text or "(c)" in b.text.lower():
            f.append("copyright")
        if n < 25:
            f.append("short " + last)
        if i == 0 or i == len(page) - 1:
            f.append("first" if i == 0 else "last")
        out.append(f)
    return out


@dataclass
class Field:
    """Feature weights for either label (0: not article, 1: article), and weights of label pairs."""

    weight: dict[str, tuple[float, float]]
    step: np.ndarray

    def labels(self, page: list[Block]) -> list[int]:
        """The most likely labelling of a page's blocks (Viterbi; ties go to label 0)."""
        if not page:
            return []
        get, none = self.weight.get, (0.0, 0.0)
        (s00, s01), (s10, s11) = self.step.tolist()
        back, a, b = [], 0.0, 0.0
        for i, f in enumerate(features(page)):
            w = [get(x, none) for x in f]
            e0, e1 = sum(x[0] for x in w), sum(x[1] for x in w)
            if i == 0:
                a, b = e0, e1
                continue
            from0, from1 = b + s10 > a + s00, b + s11 > a + s01
            a, b = max(a + s00, b + s10) + e0, max(a + s01, b + s11) + e1
            back.append((int(from0), int(from1)))
        out = [int(b > a)]
        for step in reversed(back):
            out.append(step[out[-1]])
        return out[::-1]

    def text(self, page: str) -> str:
        found = blocks(page)
        return " ".join(b.text for b, y in zip(found, self.labels(found), strict=True) if y)


def labelled_page(rng: np.random.Generator, texts: list[str]) -> str:
    """A page of one of many layouts; texts of the article begin with ``MARK``."""

    def pick(*options):
        return options[int(rng.integers(len(options)))]

    def some(lo: int, hi: int) -> range:
        return range(int(rng.integers(lo, hi + 1)))

    def say(words: int) -> str:
        t = texts[int(rng.integers(len(texts)))].split()
        while len(t) < words:
            t = t + texts[int(rng.integers(len(texts)))].split()
        at = int(rng.integers(max(1, len(t) - words + 1)))
        return entities.escape(" ".join(t[at: at + words]))

    def any_size() -> int:
        return int(pick(1, 2, 4, 8, 15, 30, 60, 120, 400))

    def box(tag: str, cues: tuple[str, ...], inner: str) -> str:
        how = rng.random()
        if how < 0.45 and tag != "div":
            return f"<{tag}>{inner}</{tag}>"
        name = pick(*cues)
        attr = pick(f'class="{name}"', f'id="{name}"', f'class="{name} x{int(rng.integers(99))}"')
        return f"<{tag if how < 0.6 else 'div'} {attr}>{inner}</{tag if how < 0.6 else 'div'}>"

    def links(n: int) -> str:
        items = [f'<a href="/{i}">{say(pick(1, 1, 2, 3))}</a>' for i in range(n)]
        return "<ul>" + "".join(f"<li>{x}</li>" for x in items) + "</ul>" if rng.random() < 0.7 else " ".join(items)

    def para(mark: str) -> str:
        t = mark + say(any_size())
        return pick(f"<p>{t}</p>", f"<p>{t}</p>", f"<p>{t}</p>", f"<p>{t}", f"<p><b>{t}</b></p>", f"<p><b>{t}<br>", f"<div>{t}</div>")

    def advert() -> str:
        return box("div", ("ad", "ads", "advert", "sponsored", "promo", "advertisement"), pick(say(any_size()), para(""), links(2)))

    def notice() -> str:
        return box("div", ("cookie-notice", "consent", "notice", "banner", "alert", "popup"), say(any_size()) + pick("", "<button>" + say(1) + "</button>"))

    def form() -> str:
        inner = f"<label>{say(2)}</label><input><button>{say(1)}</button>" + pick("", f"<p>{say(any_size())}</p>")
        return pick(f"<form>{inner}</form>", f'<form class="{pick("search", "login", "newsletter", "subscribe")}">{inner}</form>')

    def aside() -> str:
        return box("aside", ("sidebar", "widget", "related", "recommended"), pick(links(4), f"<h3>{say(3)}</h3>" + links(3), para("")))

    def comments() -> str:
        inner = "".join(pick(f'<div class="comment">{para("")}</div>', f"<li>{para('')}</li>", para("")) for _ in some(1, 4))
        return box("section", ("comments", "discussion", "replies", "respond", "comment-list"), pick("", f"<h3>{say(2)}</h3>") + inner)

    inner = [pick("", f"<h1>{MARK}{say(8)}</h1>")]
    for _ in some(1, 8):
        inner.append(para(MARK))
        odd = rng.random()
        if odd < 0.08:
            inner.append(f"<h2>{MARK}{say(4)}</h2>")
        elif odd < 0.14:
            inner.append("<ul>" + "".join(f"<li>{MARK}{say(any_size())}</li>" for _ in some(2, 4)) + "</ul>")
        elif odd < 0.18:
            inner.append(f"<blockquote>{MARK}{say(any_size())}</blockquote>")
        elif odd < 0.22:
            inner.append(f"<table><tr><td>{MARK}{say(3)}</td><td>{MARK}{say(2)}</td></tr></table>")
        elif odd < 0.30:
            inner.append(pick(advert, aside, form)())
    body = "".join(inner)
    if rng.random() < 0.15:
        body += comments()
    body = pick(
        f"<article>{body}</article>", f"<article>{body}</article>", f"<main>{body}</main>", f"<main><article>{body}</article></main>",
        f'<div class="{pick("content", "post", "entry", "article-body", "story", "main-text")}">{body}</div>', f'<div id="{pick("main", "content", "article")}">{body}</div>',
        f"<section>{body}</section>", f"<div>{body}</div>")
    before = [x() for x in (
        lambda: box("header", ("header", "masthead", "banner"), pick(f"<h1>{say(2)}</h1>", say(3), f"<p>{say(any_size())}</p>")),
        lambda: box("nav", ("nav", "menu", "navbar", "navigation", "breadcrumbs"), links(int(rng.integers(2, 9)))), notice, advert, form) if rng.random() < 0.55]
    after = [x() for x in (aside, advert, comments, form,
             lambda: box("div", ("share", "social", "tags"), links(3)),
             lambda: box("footer", ("footer", "footer"), pick("&copy; ", "") + say(any_size()) + pick("", links(3)))) if rng.random() < 0.5]
    if rng.random() < 0.2:  # nothing but the article
        before = after = []
    return f"<html><head><title>{say(6)}</title><style>p{{}}</style></head><body>{''.join(before)}{body}{''.join(after)}</body></html>"


def train(texts: list[str], pages: int = LABELLED_PAGES, steps: int = 150) -> Field:
    """Weights by maximum likelihood on labelled pages of the given texts, lightly held back."""
    rng = np.random.default_rng(11)
    texts = [t for t in texts if t.split()] or ["one two three four five six seven eight nine ten."]
    names: dict[str, int] = {}
    rows, y, begin = [], [], []
    for _ in range(pages):
        found = blocks(labelled_page(rng, texts))
        label = [int(MARK in b.text) for b in found]
        for b in found:
            b.text = b.text.replace(MARK, "").strip() or "-"
        begin.append(len(rows))
        for f in features(found):
            rows.append([names.setdefault(x, len(names)) for x in f])
        y += label
    x = np.zeros((len(rows), len(names)), np.float64)
    for i, f in enumerate(rows):
        x[i, f] = 1
    y, begin = np.array(y), np.array(begin)
    size = np.diff(np.append(begin, len(rows)))
    long = size.max()
    place = begin[:, None] + np.arange(long)[None, :]
    mask = np.arange(long)[None, :] < size[:, None]
    place = np.where(mask, place, 0)
    target = np.eye(2)[y]
    pairs = mask[:, 1:]
    w, step = np.zeros((len(names), 2)), np.zeros((2, 2))
    seen = np.zeros((2, 2))
    np.add.at(seen, (y[place[:, :-1]][pairs], y[place[:, 1:]][pairs]), 1)
    moments = [(np.zeros_like(v), np.zeros_like(v)) for v in (w, step)]
    for k in range(1, steps + 1):
        e = (x @ w)[place]
        left, right = np.zeros_like(e), np.zeros_like(e)
        left[:, 0] = e[:, 0]
        for t in range(1, long):
            left[:, t] = np.where(mask[:, t, None], np.logaddexp.reduce(left[:, t - 1, :, None] + step[None], axis=1) + e[:, t], left[:, t - 1])
        total = np.logaddexp.reduce(left[:, -1], axis=1)
        for t in range(long - 2, -1, -1):
            right[:, t] = np.where(mask[:, t + 1, None], np.logaddexp.reduce(step[None] + (e[:, t + 1] + right[:, t + 1])[:, None, :], axis=2), 0)
        p = np.exp(left + right - total[:, None, None])[mask]
        both = np.exp(left[:, :-1, :, None] + step[None, None] + (e[:, 1:] + right[:, 1:])[:, :, None, :] - total[:, None, None, None])[pairs].sum(0)
        g = [x.T @ (p - target) / len(begin) + 0.001 * w, (both - seen) / len(begin) + 0.001 * step]
        for v, d, (m1, m2) in zip((w, step), g, moments, strict=True):
            m1 += 0.1 * (d - m1)
            m2 += 0.01 * (d * d - m2)
            v -= 0.1 * (m1 / (1 - 0.9**k)) / (np.sqrt(m2 / (1 - 0.99**k)) + 1e-8)
    return Field({name: (float(w[i, 0]), float(w[i, 1])) for name, i in names.items()}, step)


def fit(pages: DataFrame, rows: int = SAMPLE_PAGES, chars: int = SAMPLE_CHARS) -> Field:
    """Trains on labelled pages made of the text of at most ``rows`` pages of at most ``chars`` characters."""
    sample = (
        pages.select("page_id", F.col("html").cast("string").alias("html")).filter(F.char_length("html") <= chars)
        .orderBy(F.xxhash64("page_id"), F.xxhash64("html")).limit(rows).select("html").toArrow().column("html").to_pylist()
    )
    return train([b.text for page in sample for b in blocks(page)])


def extract(pages: DataFrame, field: Field) -> DataFrame:
    """``page_id, url, text, n_chars`` of every page, from the whole html; a null or empty page has an empty text.

    Blocks of the article, in page order, are joined by one space. Repeated pages give equal texts; other columns are
    ignored. No shuffle.
    """
    run = functools.partial(_extract, field)
    texts = pages.select("page_id", "url", text_or_empty("html").alias("html")).mapInArrow(run, "page_id long, url string, text string")
    return texts.withColumn("n_chars", F.char_length("text").cast("long"))


def _extract(field: Field, batches):
    for batch in batches:
        out = [field.text(x.as_py()) for x in batch.column("html")]
        yield pa.RecordBatch.from_arrays(
            [batch.column("page_id").cast(pa.int64()), batch.column("url").cast(pa.string()), pa.array(out, pa.string())], names=["page_id", "url", "text"])
