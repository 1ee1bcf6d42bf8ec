"""Main text of web pages by the maximum-scoring subsequence of their tokens.

A page is a sequence of words and tags.  A word scores positive, a tag negative; the weights are log odds
of lying inside the content, counted over labelled pages.  Pages label themselves where they mark their
content (``article``, ``main``); pages without such an element are only scored.  One linear scan finds the
contiguous region with the largest sum, and the blocks that lie in it are the text.

Elements that never are content (menus, forms, scripts, ...) are left out before the scan, by name or by
their class, id or role; an unclosed one ends where content or an outer element begins or ends.  A name
counts only where it says what the element is: ``sidebar``, ``left-sidebar`` or ``ad-slot``, but not
``with-sidebar``, ``no-comments``, ``entry-header`` or ``notice-of-motion``.  Everything else about classes
is learned: each word of a tag's class has its own weight, and the strongest known one counts.

Defined results: a null or empty page has the empty text; markup that ends in the middle is read as far
as it goes; a text without any tag is one block; equal regions: the first; repeated rows are extracted
alike; an empty table gives an empty result; other columns are ignored, whatever their names.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from html import unescape
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from plinth.llm.text import chunks, field

#: Tag keys that weights are kept for; rarer ones take the weight of their tag's name.
MOST_KEYS = 5000
#: Bounds of a word's and a tag's weight, and the weight of a tag that no labelled page has.
WORD_LEAST, WORD_MOST, TAG_LEAST, TAG_MOST, TAG_UNKNOWN = 0.5, 2.0, -8.0, -0.02, -0.5

#: Stands where an element was left out: it ends a block, and costs next to nothing.
LEFT_OUT = "/"

# Element and attribute names.
CONTENT = frozenset("article main".split())
NEVER = frozenset("nav footer aside form script style noscript template title iframe object svg canvas button select "
                  "textarea dialog menu audio video map".split())
NEVER_WORDS = frozenset("ad ads advert adverts advertisement banner breadcrumb breadcrumbs comment comments cookie cookies "
                        "consent disclaimer disqus footer header menu modal nav navbar navigation newsletter notice "
                        "notices popup promo promoted related reply replies respond share sharing sidebar social sponsor "
                        "sponsored subscribe toolbar widget contentinfo complementary search dialog alert".split())
BLOCKS = frozenset("address article blockquote body br caption center dd details div dl dt fieldset figcaption figure h1 h2 h3 "
                   "h4 h5 h6 head header hr html li main ol p pre section summary table tbody td tfoot th thead tr ul".split())
VOID = frozenset("area base br col embed hr img input link meta source track wbr param".split())
RAW = "script|style|noscript|template|title|textarea|iframe"
# elements that never are content and end a block
LEFT_BLOCKS = BLOCKS | frozenset("nav footer aside form dialog menu".split())
# first words of names that tell of a layout; heads that belong to the content; what follows a word that names a part
STATES = frozenset("no not without with has have is show hide".split())
HEADED = frozenset("entry post article story content section chapter news title".split())
HOLDERS = frozenset("area bar block body box button buttons column container content field form group icons inner item items "
                    "left link links list menu module outer panel posts right row section slot stories strip text this unit "
                    "widget widgets wrap wrapper".split())

_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)"
    rf"|<(?P<raw>{RAW})(?=[\s/>])(?:[^>\"']|\"[^\"]*\"|'[^']*')*>.*?(?:</(?P=raw)\s*>|\Z)"
    r"|<(?P<end>/?)(?P<name>[a-zA-Z][^\s/>]*)(?P<attrs>(?:[^>\"']|\"[^\"]*\"|'[^']*')*)(?:>|\Z)"
    r"|<[!?][^>]*(?:>|\Z)",
    re.S | re.I,
)
_ATTR = re.compile(r"\b(class|id|role)\s*=\s*(\"[^\"]*\"|'[^']*'|[^\s>]+)", re.I)
_NAME = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")


def names_a_part(token: str, in_content: bool) -> bool:
    """Whether a class, id or role names a part that never is content; a header belongs to the content it lies in."""
    words = [w.lower() for w in _NAME.findall(token)]
    if not words or words[0] in STATES:
        return False
    if words[-1] in NEVER_WORDS:
        return words[-1] != "header" or not (in_content or words[0] in HEADED)
    return len(words) > 1 and words[0] in NEVER_WORDS and words[1] in HOLDERS


class Token:
    """A tag (``key`` set) or a run of text, with the number of its words."""

    __slots__ = ("key", "block", "text", "words", "inside")

    def __init__(self, key: str, block: bool, text: str, inside: bool):
        self.key, self.block, self.text, self.inside = key, block, text, inside
        self.words = len(text.split())


def read_page(html: str) -> tuple[list[Token], bool]:
    """The tokens outside elements that never are content; whether the page marks its content."""
    out: list[Token] = []
    # open elements: name, whether it is left out, whether it marks content
    path: list[tuple[str, bool, bool]] = []
    dropped = marked = 0
    labelled = False

    def close(to: int) -> None:
        nonlocal dropped, marked
        while len(path) > to:
            _, drop, mark = path.pop()
            dropped -= drop
            marked -= mark

    def text(s: str) -> None:
        if s and not dropped:
            out.append(Token("", False, s, marked > 0))

    at = 0
    for m in _TOKEN.finditer(html):
        text(html[at : m.start()])
        at = m.end()
        name = (m["name"] or "").lower()
        if not name:
            continue
        if m["end"]:
            for i in range(len(path) - 1, -1, -1):
                if path[i][0] == name:
                    hidden = dropped
                    close(i)
                    if not hidden:
                        out.append(Token("/" + name, name in BLOCKS, "", marked > 0))
                    elif not dropped:
                        out.append(Token(LEFT_OUT, name in LEFT_BLOCKS, "", marked > 0))
                    break
            continue
        if name in CONTENT and dropped:  # an unclosed element that was left out ends here
            close(next(i for i, x in enumerate(path) if x[1]))
        if name in ("p", "li") and path and path[-1][0] == name:
            close(len(path) - 1)
        names = {x for _, value in _ATTR.findall(m["attrs"]) for x in value.strip("\"'").split()} if m["attrs"] else ()
        drop = name in NEVER or (name == "header" and not marked) or (
            name not in CONTENT and name not in ("html", "body") and any(names_a_part(x, marked > 0) for x in names))
        if not dropped and not drop:
            words = sorted({w.lower() for x in names for w in _NAME.findall(x)})
            out.append(Token(".".join([name, *words]), name in BLOCKS, "", marked > 0))
        elif not dropped:
            out.append(Token(LEFT_OUT, name in LEFT_BLOCKS, "", marked > 0))
        if name not in VOID and not m["attrs"].endswith("/"):
            mark = name in CONTENT and not dropped
            labelled |= mark
            path.append((name, drop, mark))
            dropped += drop
            marked += mark
    text(html[at:])
    return out, labelled


def features(key: str) -> list[str]:
    """The keys that weights are kept for: ``name.word`` for each word of a tag's class, id and role, else its name."""
    name, *words = key.split(".")
    return [f"{name}.{w}" for w in words] or [name] * bool(name)


def weight_of(key: str, weights: dict[str, float]) -> float:
    """The strongest known weight of a tag's features, else that of its name."""
    known = [weights[x] for x in features(key) if x in weights]
    return max(known, key=abs) if known else weights.get(key.split(".")[0], TAG_UNKNOWN)


def count_tokens(pages: DataFrame) -> DataFrame:
    """(key, inside, outside): tags and words (key ``#word``) of the pages that mark their content."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: Counter = Counter()
        for batch in chunks(batches, "html"):
            for html in field(batch, "html").to_pylist():
                tokens, labelled = read_page(html or "")
                for t in tokens if labelled else ():
                    if t.key == LEFT_OUT:
                        continue
                    for key in features(t.key) or ["#word"]:
                        total[key, t.inside] += 1 if t.key else t.words
        keys = sorted({k for k, _ in total})
        yield pa.RecordBatch.from_arrays([pa.array(keys, pa.string())] + [pa.array([total[k, x] for k in keys], pa.int64()) for x in (True, False)],
                                         ["key", "inside", "outside"])

    parts = pages.select("html").mapInArrow(count, "key string, inside long, outside long")
    return parts.groupBy("key").agg(F.sum("inside").alias("inside"), F.sum("outside").alias("outside"))


def fit(pages: DataFrame) -> dict[str, float]:
    """The weight of each tag key and of ``#word``."""
    rows = count_tokens(pages).orderBy((F.col("inside") + F.col("outside")).desc(), "key").limit(MOST_KEYS).collect()
    out = {LEFT_OUT: TAG_MOST}
    for r in rows:
        odds = math.log((r["inside"] + 1) / (r["outside"] + 1))
        low, high = (WORD_LEAST, WORD_MOST) if r["key"] == "#word" else (TAG_LEAST, TAG_MOST)
        out[r["key"]] = min(max(odds, low), high)
    return out


def best_region(weights: list[float]) -> tuple[int, int]:
    """The bounds of the contiguous region with the largest sum; (0, 0) if no sum is positive."""
    best, bounds, run, start = 0.0, (0, 0), 0.0, 0
    for i, w in enumerate(weights):
        if run <= 0:
            run, start = 0.0, i
        run += w
        if run > best:
            best, bounds = run, (start, i + 1)
    return bounds


def extract(html: str | None, weights: dict[str, float]) -> str:
    """The main text of one page: its region's blocks, joined by line breaks."""
    tokens, _ = read_page(html or "")
    word = weights.get("#word", 1.0)
    scores = [word * t.words if not t.key else weights[t.key] if t.key in weights else weight_of(t.key, weights) for t in tokens]
    a, b = best_region(scores)
    blocks, held = [], []
    for t in tokens[a:b]:
        if t.block:
            blocks.append("".join(held))
            held = []
        elif t.text:
            held.append(t.text)
    blocks.append("".join(held))
    return "\n".join(filter(None, (" ".join(unescape(x).split()) for x in blocks)))


def main_text(pages: DataFrame, weights: dict[str, float]) -> DataFrame:
    """(page_id, url, text, n_chars) of every row of ``pages``."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in chunks(batches, "html"):
            text = [extract(x, weights) for x in field(batch, "html").to_pylist()]
            yield pa.RecordBatch.from_arrays([field(batch, "page_id"), field(batch, "url"), pa.array(text, pa.string()),
                                              pa.array(list(map(len, text)), pa.int64())], ["page_id", "url", "text", "n_chars"])

    return (pages.select(F.col("page_id").cast("long").alias("page_id"), "url", "html")
            .mapInArrow(rows, "page_id long, url string, text string, n_chars long"))


def op1_html_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet")
    return main_text(pages, fit(pages))
