"""Main-text extraction by the maximum-scoring subsequence.

A page is a sequence of tokens: its words, scored positive, and its tags,
scored negative. The contiguous region with the largest sum, found by one
linear scan, is the main content. Weights come from labelled pages: those that
mark their content themselves with ``<article>`` or ``<main>``. A word weighs
the log-odds of words inside against outside, a tag the log-odds of that tag
(with its role: a tag whose class or id names a menu, advert, notice, comment
list ... is a kind of its own), held at or under a small negative number.

Elements that are never article text (scripts, styles, forms, menus, footers,
sidebars, adverts, notices, reader comments ...) count as tags only: their
words neither score nor appear. Where the region meets marked elements, it is
widened to the whole of them; nothing is cut from it.

Names alone may mislead: a story can lie in an element whose class holds one of
those words, or a form can span the page. Where the words outside such elements
are none, or a scrap beside those inside, the page is scanned again, its forms and
names then being no more than tags (elements that are hidden or that are menus,
headers, footers or sidebars by their tag stay out).

Semantics: null html is empty. Character references are decoded; white space
(any Unicode white space) becomes one space, blocks are joined by one space,
inline tags join their neighbours without a space; an unclosed tag ends at the
end of its region; of equal regions the first and shortest wins; a page
without a word gives the empty string.
"""

from __future__ import annotations

import html
import math
import re
from collections import Counter

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from aurum.llm.common import ship_by_value, text_or_empty

ship_by_value(__name__)

TAG = re.compile(r"""<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*>|<(/?)([A-Za-z][A-Za-z0-9:-]*)((?:[^>"']++|"[^"]*+"|'[^']*+'|["'])*+)>""", re.S)
NAME = re.compile(r"""(?:^|\s)(?:class|id|role|aria-label)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.I)
HIDDEN = re.compile(r"""(?:^|\s)(?:hidden(?:\s|$|=)|aria-hidden\s*=\s*["']?true)|display\s*:\s*none""", re.I)

#: content is raw text up to the closing tag
RAW = frozenset("script style textarea title xmp iframe noembed noframes".split())
#: elements that are never article text
NEVER = frozenset("script style textarea title xmp iframe noembed noframes head noscript template nav footer aside form button select "
                  "option datalist dialog menu svg canvas object audio video map".split())
#: inline elements: their tags join the text on both sides
INLINE = frozenset("a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q rp rt ruby s samp small span "
                   "strike strong sub sup time tt u var wbr nobr".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
CONTENT = frozenset(("article", "main"))
#: words of class, id and role names that tell what is not the article
ROLE = re.compile(
    r"(?:^|[^a-z])(?:ads?|advert\w*|adsense|adbox|banner|sponsor\w*|promo\w*|nav\w*|menus?|breadcrumbs?|side-?bar|widgets?|foot(?:er)?|"
    r"masthead|cookies?|consent|gdpr|notices?|alerts?|popup|modal|overlay|newsletter|subscribe|subscription|paywall|login|signup|"
    r"comments?|comment-?list|disqus|replies|respond|discussion|share|sharing|social|related|recommended|recirc|pagination|pager|toolbar|skip-?link|"
    r"copyright|disclaimer|search(?:box|form)?|contentinfo|complementary|navigation)(?:[^a-z]|$)", re.I)
#: what a layout has or lacks says nothing about the element itself
MODIFIER = re.compile(r"(?<![a-z])(?:no|has|have|with|without|hide|show|is)-[a-z-]+")
#: names of article elements that are not the article
SUBORDINATE = frozenset("comment comments user-comment reader-comment reply related teaser promo ad advert sponsored".split())
CAMEL = re.compile(r"(?<=[a-z0-9])(?=[A-Z])")


def boilerplate(name: str, attrs: str, in_content: bool, by_name: bool = True) -> bool:
    """Whether an element is one whose text is never article text; without ``by_name``, forms and class names do not tell."""
    if name in NEVER:
        return by_name or name != "form"
    if name == "header":
        return not in_content  # the article's own header holds its headline
    if not attrs or name in ("html", "body", "main") or name in VOID:
        return False
    names = CAMEL.sub("-", " ".join(filter(None, (x for m in NAME.findall(attrs) for x in m)))).replace("_", "-").lower()
    if name == "article":
        return not SUBORDINATE.isdisjoint(names.split())
    return bool(HIDDEN.search(attrs)) or by_name and bool(names) and bool(ROLE.search(MODIFIER.sub(" ", names)))


def tokenise(page: str, by_name: bool = True) -> list[tuple[str, str, int]]:
    """Tokens in page order: (kind, text, number of the content element they are in, or 0).

    kind: ``w`` raw text outside boilerplate, or the tag's kind: its name,
    with ``!`` before it for a boilerplate element, ``/`` for a closing tag.
    Where a page has articles, they are its content elements; else ``<main>`` is.
    """
    found = _tokens(page, by_name)
    if any(articles for _, _, articles, _ in found):
        return [(kind, text, article) for kind, text, article, _ in found]
    return [(kind, text, int(main)) for kind, text, _, main in found]


def _tokens(page: str, by_name: bool) -> list[tuple[str, str, int, bool]]:
    out: list[tuple[str, str, int, bool]] = []
    article = main = number = 0  # depths, and the number of the outermost article
    skip: list[str] = []  # open elements since (and with) the boilerplate element that began the skipping

    def put(kind: str, text: str = "") -> None:
        out.append((kind, text, number if article else 0, main > 0))

    at, end = 0, len(page)
    last = page.rfind(">") + 1  # no tag ends behind it
    while at < end:
        m = TAG.search(page, at, last)
        stop = m.start() if m else end
        if stop > at and not skip:
            put("w", page[at:stop])
        if not m:
            break
        at, name, attrs = m.end(), (m[2] or "").lower(), m[3] or ""
        if not name:
            if m[0].startswith("<!--") and not m[0].endswith("-->"):
                break  # an unclosed comment takes the rest of the page
            continue
        closing, empty = bool(m[1]), name in VOID or attrs.endswith("/")
        if skip:
            # skipping ends with its element; an unclosed one ends where the content element closes or the body ends
            if closing and name == skip[0]:
                skip.pop()
                if not skip:
                    put("/!" + name)
                continue
            if not closing and name == skip[0] and not empty:
                skip.append(name)
                at = _after_raw(page, at, name)
                continue
            content = article or main
            if not (closing and name in CONTENT and content or not closing and name in CONTENT and not content or name == "body"):
                if not closing and name in RAW:
                    at = _after_raw(page, at, name)
                continue
            skip.clear()
        if closing:
            put("/" + name)
            article -= name == "article" and article > 0
            main -= name == "main" and main > 0
        elif not empty and boilerplate(name, attrs, bool(article or main), by_name):
            put("!" + name)
            skip = [name]
            at = _after_raw(page, at, name)
        else:
            if name == "article" and not empty:
                number += not article
                article += 1
            main += name == "main" and not empty
            put(name)
    return out


def _after_raw(page: str, at: int, name: str) -> int:
    """Place of a raw element's closing tag (the end of the page if it has none)."""
    if name not in RAW:
        return at
    m = re.compile(rf"</{name}(?=[\s/>])", re.I).search(page, at)
    return m.start() if m else len(page)


def feature(kind: str) -> str:
    """Tag kinds the model knows: closing tags count with their opening ones; unknown names are one kind."""
    name = kind.replace("/", "")
    return name if name.lstrip("!") in KNOWN else "?"


KNOWN = NEVER | INLINE | VOID | CONTENT | frozenset(
    "html body header section div p h1 h2 h3 h4 h5 h6 ul ol li dl dt dd table thead tbody tfoot tr td th caption blockquote pre figure "
    "figcaption address details summary center".split())


def _label_counts(batches):
    """Tokens inside and outside the marked content of labelled pages: (feature, inside, outside)."""
    inside: Counter = Counter()
    outside: Counter = Counter()
    for b in batches:
        for page in b.column("html").to_pylist():
            tokens = tokenise(page)
            if any(k in CONTENT for k, _, _ in tokens):
                for kind, text, within in tokens:
                    # the element's own tags are the border and belong to neither side
                    if kind == "w":
                        (inside if within else outside)["w"] += len(text.split())
                    elif kind.lstrip("/") not in CONTENT:
                        (inside if within else outside)[feature(kind)] += 1
    names = sorted({*inside, *outside})
    yield pa.RecordBatch.from_arrays([pa.array(names, pa.string()), pa.array([inside[x] for x in names], pa.int64()), pa.array([outside[x] for x in names], pa.int64())],
                                     names=["feature", "inside", "outside"])


#: a word weighs at least this, a tag at most this; unseen tags weigh the second
WORD_LEAST, TAG_MOST = 0.5, -0.05
UNSEEN = -1.0


def fit(pages: DataFrame, html_col: str = "html", fit_rows: int = 4000, smoothing: float = 0.5) -> dict[str, float]:
    """Weights by feature from pages that mark their content; ``fit_rows`` bounds the (hash-chosen) sample of pages."""
    source = pages.select(text_or_empty(html_col).alias("html")).where(F.lower("html").rlike("<(article|main)[ >]"))
    share = min(1.0, fit_rows / max(1, source.count()))
    sample = source.where(F.pmod(F.xxhash64("html"), F.lit(1 << 20)) < share * (1 << 20))
    rows = sample.mapInArrow(_label_counts, "feature string, inside long, outside long").groupBy("feature") \
        .agg(F.sum("inside").alias("inside"), F.sum("outside").alias("outside")).collect()  # a fixed set of features
    total_in, total_out = sum(r["inside"] for r in rows) or 1, sum(r["outside"] for r in rows) or 1
    weights = {"w": WORD_LEAST}
    for r in rows:
        odds = math.log((r["inside"] + smoothing) / total_in) - math.log((r["outside"] + smoothing) / total_out)
        weights[r["feature"]] = max(WORD_LEAST, odds) if r["feature"] == "w" else min(TAG_MOST, odds)
    return weights


def best_region(scores: list[float]) -> tuple[int, int]:
    """Maximum-scoring contiguous run [i, j) by one scan; empty if nothing is positive."""
    best, at = 0.0, (0, 0)
    run, start = 0.0, 0
    for k, s in enumerate(scores):
        if run <= 0.0:
            run, start = 0.0, k
        run += s
        if run > best:
            best, at = run, (start, k + 1)
    return at


#: a region of fewer words than the first, beside one of ``times`` as many among elements dropped by name, is a scrap
SCRAP, TIMES = 20, 8


def extract(page: str, weights: dict[str, float]) -> str:
    """Main text of one page."""
    tokens = tokenise(page)
    text = _region(tokens, weights)
    n = len(text.split())
    if n and (n >= SCRAP or any(within for _, _, within in tokens)):
        return text
    wider = _region(tokenise(page, by_name=False), weights)
    return wider if len(wider.split()) >= TIMES * n else text


def _region(tokens: list[tuple[str, str, int]], weights: dict[str, float]) -> str:
    """Text of the best region of a page's tokens, widened to the content elements it meets."""
    word = weights.get("w", 1.0)
    scores = [word * len(text.split()) if kind == "w" else 0.0 if kind.lstrip("/") in CONTENT else weights.get(feature(kind), UNSEEN)
              for kind, text, _ in tokens]
    i, j = best_region(scores)
    marked = {within for _, _, within in tokens[i:j]} - {0}
    # content elements that the region meets are taken whole
    chosen = [t for k, t in enumerate(tokens) if i <= k < j or t[2] in marked]
    parts = []
    for kind, text, _ in chosen:
        if kind == "w":
            parts.append(text)
        elif kind.lstrip("/") not in INLINE:
            parts.append(" ")
    return " ".join(html.unescape("".join(parts)).split())


def extract_pages(pages: DataFrame, weights: dict[str, float], html_col: str = "html") -> DataFrame:
    """``pages`` without its html, with ``text`` and ``n_chars`` (a narrow map). Input columns of these names are replaced."""
    rest = pages.withColumn("_html", text_or_empty(html_col)).drop(html_col, "text", "n_chars")

    def run(batches):
        for b in batches:
            texts = [extract(p, weights) if p else "" for p in b.column("_html").to_pylist()]
            names = [n for n in b.schema.names if n != "_html"]
            yield pa.RecordBatch.from_arrays([*[b.column(n) for n in names], pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())],
                                             names=[*names, "text", "n_chars"])

    out = rest.withColumns({"text": F.lit(""), "n_chars": F.lit(0).cast("long")}).drop("_html").schema
    return rest.mapInArrow(run, out)
