"""Main text of web pages by tag-path ratios.

A page is read once into text blocks, each with its path of open tags from the
root to the leaf.  Per distinct path the code points and the punctuation marks
of all its blocks are summed and divided by the number of its blocks, giving
two ratios.  Both are smoothed along the page order of the paths with a Gaussian
window, multiplied, and paths above a share of the page's mean are content.
The element that holds most of the content text is the article: its other blocks
(headings, short or list paragraphs) belong to it too.  Elements that hold
no article text by their tag (menus, scripts, forms, footers and the like) and
hidden ones never take part; nor do those that a word in role, class or id marks
(adverts, comments, sidebars), unless they hold most of the page's content text
and the page has no single ``main`` or ``article`` apart from them.

A null or empty page, and a page without blocks, gives an empty text.  Long
pages are read whole; every page stays in one task.  Markup may be broken:
unclosed and crossing tags, missing quotes and unfinished comments are accepted.
A self-closed or unclosed element of ``RAW`` or ``NESTED`` is empty: what follows
is read (but for unclosed scripts and styles, where code follows).
"""

from __future__ import annotations

import html
import math
import re
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.frames import map_batches, with_field

#: Elements by their meaning in HTML.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
CODE = frozenset("script style".split())
RAW = frozenset("iframe textarea title noframes xmp".split()) | CODE  # read up to their end tag
NESTED = frozenset("noscript template object svg math".split())  # hold elements
ASIDE = frozenset("head nav header footer aside button select option dialog menu canvas audio video map".split()) | RAW | NESTED
WEIGHED = frozenset(["form"])  # may wrap a whole page, so dropped as labelled elements are
IN_HEAD = frozenset("html head base link meta title noscript noframes style script template".split())
INLINE = frozenset("a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark nobr q rp rt ruby s samp small span strike strong sub sup time tt u var wbr br img".split())
BLOCKS_IN_P = frozenset("address article aside blockquote details div dl fieldset figure footer form h1 h2 h3 h4 h5 h6 header hr main menu nav ol p pre section table ul".split())
CLOSED_BY_SELF = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}}
#: Words in class, id or role that mark an element as no part of the article.
ASIDE_WORDS = frozenset(
    "ad ads advert adverts advertisement advertising sponsor sponsored promo promotion banner popup modal overlay cookie cookies consent gdpr notice notices alert menu nav navbar navigation breadcrumb breadcrumbs "
    "sidebar side aside footer header masthead topbar toolbar comment comments reply replies disqus discussion share sharing social related recommended recommendations newsletter subscribe subscription signup login "
    "search widget pagination pager skip hidden copyright legal disclaimer complementary contentinfo".split()
)
PUNCTUATION = re.compile("[.,;:!?…。、，！？；：]")
SPACE = re.compile(r"\s+")
WORDS = re.compile(r"[a-z]+")
VALUE = r"""(?:\s*+=\s*+(?:"([^"]*+)"|'([^']*+)'|([^\s"'>][^\s>]*+))?+)?+"""
ATTRIBUTE = re.compile(r"([^\s/>][^\s/>=]*+)" + VALUE)
NO_DISPLAY = re.compile(r"display\s*:\s*none", re.I)
TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)"
    rf"|<(?P<end>/?)(?P<name>[a-zA-Z][^\s/>]*+)(?P<more>(?:\s++|/(?!>)|[^\s/>][^\s/>=]*+{re.sub(r"[(](?![?])", "(?:", VALUE)})*+)(?P<empty>/?)>"
    r"|<[!?/][^>]*(?:>|\Z)"
    r"|<[a-zA-Z][^<>]*>",
    re.S,
)
END = {name: re.compile(rf"</{name}(?:\s[^>]*)?>", re.I) for name in RAW}


def attributes(more: str) -> dict[str, str]:
    """Lower-cased names and their own values; of a repeated name the first counts."""
    out: dict[str, str] = {}
    for name, *value in ATTRIBUTE.findall(more):
        out.setdefault(name.lower(), "".join(value))
    return out


def is_aside(name: str, has: dict[str, str]) -> bool:
    """Whether the element holds no article text by its tag, or is hidden."""
    if name in ASIDE:
        return True
    if name in ("body", "html", "main", "article"):
        return False
    return "hidden" in has or has.get("aria-hidden", "").strip().lower() == "true" or bool(NO_DISPLAY.search(has.get("style", "")))


def is_labelled(name: str, has: dict[str, str]) -> bool:
    """Whether the tag, or a word in class, id or role, says that the element holds no article text."""
    if name in WEIGHED:
        return True
    if name in ("body", "html", "main", "article"):
        return False
    for kind in ("class", "id", "role"):
        for label in has.get(kind, "").lower().split():
            words = WORDS.findall(label)
            if ASIDE_WORDS.intersection(words) and words[0] not in ("no", "has", "with", "without"):
                return True
    return False


def tokens(page: str) -> list[tuple[int, int, re.Match[str]]]:
    """Start, end and match of every tag and comment; a closed element of ``RAW`` or ``NESTED`` is one token with all it holds."""
    out: list[tuple[int, int, re.Match[str]]] = []
    open_tags: list[tuple[str, int]] = []
    ends: dict[int, int] = {}  # token of a nested element -> token of its end tag
    never: set[str] = set()
    n_open: Counter[str] = Counter()
    at = 0
    while m := TOKEN.search(page, at):
        at = m.end()
        name = (m["name"] or "").lower()
        if name in RAW and not m["end"] and not m["empty"] and name not in never:
            if end := END[name].search(page, at):
                at = end.end()
            elif name in CODE:
                at = len(page)
            else:
                never.add(name)
        elif m["end"] and n_open[name]:
            last = ""
            while last != name:
                last, opened = open_tags.pop()
                n_open[last] -= 1
            if name in NESTED:
                ends[opened] = len(out)
        elif name and not m["end"] and not m["empty"] and name not in VOID and name not in RAW:
            open_tags.append((name, len(out)))
            n_open[name] += 1
        out.append((m.start(), at, m))
    if not ends:
        return out
    joined, i = [], 0
    while i < len(out):
        last = ends.get(i, i)
        joined.append((out[i][0], out[last][1], out[i][2]))
        i = last + 1
    return joined


class Paths:
    """Root-to-leaf tag paths as numbers: a path is its parent's number and one more tag, so a deep one costs no more than a short one.

    Number 0 is the empty path, and a parent's number is smaller than its children's.
    """

    def __init__(self) -> None:
        self.parent, self.tag, self.depth = [0], [""], [0]
        self.known: dict[tuple[int, str], int] = {}

    def child(self, path: int, tag: str) -> int:
        got = self.known.setdefault((path, tag), len(self.tag))
        if got == len(self.tag):
            self.parent.append(path)
            self.tag.append(tag)
            self.depth.append(self.depth[path] + 1)
        return got


def blocks(page: str, share: float = 0.2, width: float = 1.0) -> tuple[list[tuple[int, str]], Paths]:
    """Path and text of every block outside asides, in page order, and what the paths' numbers mean."""
    out: list[tuple[int, str, tuple[int, ...], int]] = []
    paths = Paths()
    open_tags: list[str] = []
    n_open: Counter[str] = Counter()
    at_path: list[int] = [0]  # path of each open tag, after that of the page; inline tags share their parent's
    open_blocks: list[int] = []  # places of the open tags that are not inline
    aside_at = 0  # depth of the outermost aside; 0 is none
    labelled: list[tuple[int, int]] = []  # depth and number of the open elements with a label
    n_labelled = 0
    named_at, n_named = 0, 0  # depth of the outermost main or article; 0 is none
    held: list[str] = []
    filled = False  # whether ``held`` has more than white space
    path = 0

    def flush() -> None:
        nonlocal filled
        if not held:
            return
        text = SPACE.sub(" ", html.unescape("".join(held))).strip()
        held.clear()
        filled = False
        if text:
            out.append((path, text, tuple(n for _, n in labelled), n_named if named_at else 0))

    def close(to: int) -> None:
        nonlocal aside_at, named_at
        if (open_blocks and open_blocks[-1] >= to) or (labelled and labelled[-1][0] > to):
            flush()
        n_open.subtract(open_tags[to:])
        del open_tags[to:]
        del at_path[to + 1 :]
        while open_blocks and open_blocks[-1] >= to:
            open_blocks.pop()
        while labelled and labelled[-1][0] > to:
            labelled.pop()
        if aside_at > to:
            aside_at = 0
        if named_at > to:
            named_at = 0

    def take(text: str) -> None:
        nonlocal path, filled
        if text and not aside_at:
            if not filled:
                path = at_path[-1]
                filled = not text.isspace()
            held.append(text)

    def innermost(name: str) -> int:
        i = len(open_tags) - 1
        while open_tags[i] != name:
            i -= 1
        return i

    at = 0
    for start, end, m in tokens(page):
        take(page[at:start])
        at = end
        if not (name := m["name"]):
            continue
        name = name.lower()
        if m["end"]:
            if n_open[name]:
                close(innermost(name))
            elif name == "p":
                flush()
            continue
        if name in RAW or name in NESTED:
            continue
        if name == "br":
            take(" ")
        if name not in IN_HEAD and n_open["head"]:
            close(open_tags.index("head"))
        if name in BLOCKS_IN_P and open_blocks and open_tags[open_blocks[-1]] == "p":
            close(open_blocks[-1])
        if name in CLOSED_BY_SELF and any(n_open[t] for t in CLOSED_BY_SELF[name]):
            for i in range(len(open_tags) - 1, -1, -1):
                if open_tags[i] in CLOSED_BY_SELF[name]:
                    close(i)
                    break
                if open_tags[i] in ("ul", "ol", "dl", "table", "select"):
                    break
        if name not in INLINE:
            flush()
        if name in VOID or m["empty"]:
            continue
        if name not in INLINE:
            open_blocks.append(len(open_tags))
        at_path.append(at_path[-1] if name in INLINE else paths.child(at_path[-1], name))
        open_tags.append(name)
        n_open[name] += 1
        if aside_at:
            continue
        if name in ("main", "article") and not named_at:
            named_at, n_named = len(open_tags), n_named + 1
        has = attributes(m["more"]) if m["more"] else {}
        if is_aside(name, has):
            flush()
            aside_at = len(open_tags)
        elif (has or name in WEIGHED) and is_labelled(name, has):
            flush()
            n_labelled += 1
            labelled.append((len(open_tags), n_labelled))
    take(page[at:])
    flush()
    return (without_labelled(out, share, width) if n_labelled else [(path, text) for path, text, *_ in out]), paths


def without_labelled(found: list[tuple[int, str, tuple[int, ...], int]], share: float, width: float) -> list[tuple[int, str]]:
    """Path and text of the blocks, less those in labelled elements that hold half of the content's text or less, or none of the only main or article."""
    every = [(path, text) for path, text, *_ in found]
    if not any(inside for *_, inside, _ in found):
        return every
    content = content_paths(every, share, width)
    total, weight = 0, {}
    for path, text, inside, _ in found:
        if path in content:
            total += len(text)
            for n in inside:
                weight[n] = weight.get(n, 0) + len(text)
    heavy = {n for n, w in weight.items() if 2 * w > total}
    if len({named for *_, inside, named in found if named and heavy.issuperset(inside)}) == 1:
        heavy &= {n for *_, inside, named in found if named for n in inside}
    return [(path, text) for path, text, inside, _ in found if heavy.issuperset(inside)] or every


def content_paths(found: list[tuple[int, str]], share: float, width: float) -> set[int]:
    """Paths whose smoothed, fused ratios exceed ``share`` of the mean over paths, weighted by their text."""
    place: dict[int, int] = {}
    sums: list[list[float]] = []
    for path, text in found:
        i = place.setdefault(path, len(sums))
        if i == len(sums):
            sums.append([0, 0, 0])
        sums[i][0] += len(text)
        sums[i][1] += len(PUNCTUATION.findall(text))
        sums[i][2] += 1
    length, marks, n = np.array(sums, float).T
    reach = math.ceil(3 * width)
    kernel = np.exp(-0.5 * (np.arange(-reach, reach + 1) / width) ** 2)

    def smooth(x: np.ndarray) -> np.ndarray:
        top, bottom = np.convolve(x, kernel), np.convolve(np.ones(len(x)), kernel)
        return (top / bottom)[reach : reach + len(x)]

    fused = smooth(length / n) * (smooth(marks / n) + 0.1)
    level = share * np.average(fused, weights=length)
    return {p for p, i in place.items() if fused[i] >= level}


def article(found: list[tuple[int, str]], content: set[int], paths: Paths) -> int:
    """The longest path that still holds most of the content's text, itself included only as a leaf's parent."""
    weight = [0] * len(paths.tag)
    total = 0
    for path, text in found:
        if path in content:
            total += len(text)
            weight[paths.parent[path]] += len(text) if path else 0
    for path in range(len(weight) - 1, 0, -1):
        weight[paths.parent[path]] += weight[path]
    return max((p for p, w in enumerate(weight) if w and w >= 0.6 * total), key=lambda p: paths.depth[p], default=0)


def main_text(page: str, share: float = 0.2, width: float = 1.0) -> str:
    found, paths = blocks(page, share, width)
    if not found:
        return ""
    content = content_paths(found, share, width)
    root = article(found, content, paths)
    # a bare page body is no article element: there only content paths and headings count
    own = [False] * len(paths.tag)
    if root and paths.tag[root] not in ("html", "body"):
        own[root] = True
        for p in range(root + 1, len(own)):
            own[p] = own[paths.parent[p]]
    kept = [text for path, text in found if path in content or own[path] or paths.tag[path] in ("h1", "h2", "h3")]
    return "\n\n".join(kept)


def extract(df: DataFrame, html_col: str = "html", out: str = "text") -> DataFrame:
    """The rows of ``df`` with ``out``: the main text.  An input column of that name gives way (but not the page itself)."""
    base = df.drop(out) if out != html_col else df
    names = base.columns
    at = names.index(html_col)

    def batch(b: pa.RecordBatch) -> pa.RecordBatch:
        texts = pa.array([main_text(p or "") for p in b.column(at).to_pylist()], pa.string())
        return pa.RecordBatch.from_arrays([*b.columns, texts], [*names, "_main_text"])

    done = map_batches(base.withColumn(html_col, F.col(html_col).cast("string")), batch, with_field(base.withColumn(html_col, F.col(html_col).cast("string")).schema, "_main_text", "string"))
    return done.drop(html_col).withColumnRenamed("_main_text", out) if out == html_col else done.withColumnRenamed("_main_text", out)
