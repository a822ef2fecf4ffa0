"""Main text of web pages: flat blocks, their neighbours, and a small decision tree."""

from __future__ import annotations

import html as references
import re
from typing import NamedTuple

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: A comment, an element whose content is no text, a declaration, or a tag; each
#: runs to the end of the page where it isn't closed.
_MARKUP = re.compile(
    r"<!--.*?(?:-->|\Z)"
    r"|<(script|style|noscript|template|textarea|iframe|title)\b"
    r"(?:[^>\"']++|\"[^\"]*+\"|'[^']*+'|[\"'])*?>.*?(?:</\1\s*+>|\Z)"
    r"|<[!?][^>]*+(?:>|\Z)"
    r"|<(/?)([a-zA-Z][a-zA-Z0-9:-]*+)((?:[^>\"']++|=\s*+\"[^\"]*+\"|=\s*+'[^']*+'|[\"'])*+)(?:>|\Z)",
    re.DOTALL | re.IGNORECASE,
)
_NAMES = re.compile(r"(?:class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))", re.IGNORECASE)

#: Tags that set their text apart from what stands around them.
_BLOCKS = frozenset(
    "address article aside blockquote body button caption center dd details dialog dir div dl dt "
    "fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hr html legend li main menu "
    "nav ol option p pre section select summary svg table tbody td tfoot th thead tr ul".split()
)
#: Those that can hold others; a closing tag closes what was left open in it.
_HOLDERS = frozenset(
    "article aside blockquote body details dialog div dl fieldset figure footer form header main "
    "menu nav ol section select svg table ul".split()
)
_AROUND = frozenset("nav footer aside menu dialog select svg".split())
#: Words in the class, id or role of what surrounds an article.
_WORDS = (
    r"(?:ads?|adverts?|advertisements?|advertising|banner|breadcrumbs?|comments?|"
    r"complementary|consent|contentinfo|cookies?|copyright|dialog|disqus|footer|gdpr|header|"
    r"login|masthead|menu|modal|navbar|navigation|nav|newsletter|notices?|paging|pagination|"
    r"popup|promo|promoted|recommended|related|replies|reply|respond|search|share|sharing|"
    r"sidebar|signup|skip|social|sponsor|sponsored|subscribe|toolbar|widget|alert)"
)
_AROUND_WORDS = re.compile(rf"(?:^|[\s_-]){_WORDS}(?:$|[\s_-])", re.IGNORECASE)
#: A whole name, or a part that says that articles inside are others than the page's.
_AROUND_NAMES = re.compile(
    rf"(?<!\S){_WORDS}(?!\S)|(?:^|[\s_-])(?:comments?|disqus|promoted|recommended|related|replies|"
    r"reply|respond|sponsored)(?:$|[\s_-])",
    re.IGNORECASE,
)
#: Names that hold such a word and say nothing: has-sidebar, article-header.
_NO_HINT = re.compile(
    r"(?<!\S)(?:(?:has|no|with|without)[_-]\S+|(?:article|content|entry|main|post|story)[_-]header)(?!\S)",
    re.IGNORECASE,
)

FEATURES = (
    "around", "in_article", "heading", "words", "link_density", "words_before",
    "link_density_before", "words_after", "link_density_after",
)


class Block(NamedTuple):
    text: str
    linked: int  # words inside links
    around: bool
    in_article: bool
    heading: bool


def blocks(page: str | None) -> list[Block]:
    """The page's text in flat blocks, in page order; white space folded, none empty.

    A hint in a part of a name, or a form, doesn't count where an article or main lies
    inside; main is never around.
    """
    found: list[tuple[Block, list | None]] = []
    parts: list[str] = []
    linked: list[str] = []
    # The holders that are open: (tag, around, in_article, the innermost weak hint). A
    # weak hint is [the next one out, whether it counts]; one that doesn't has none
    # outside that does.
    held: list[tuple[str, bool, bool, list | None]] = [("", False, False, None)]
    in_link = heading = False
    page = page or ""
    at = 0

    def close():
        text = " ".join("".join(parts).split())
        if text:
            _, around, in_article, weak = held[-1]
            words = len("".join(linked).split())
            found.append((Block(text, words, around, in_article, heading), weak))
        parts.clear()
        linked.clear()

    def say(raw: str):
        if raw:
            text = references.unescape(raw)
            parts.append(text)
            if in_link:
                linked.append(text)

    for m in _MARKUP.finditer(page):
        say(page[at : m.start()])
        at = m.end()
        if m[3] is None:
            continue
        tag, closing = m[3].lower(), bool(m[2])
        if tag == "a":
            in_link = not closing
        elif tag in ("br", "wbr", "img"):
            say(" " if tag != "wbr" else "")
        elif tag in _BLOCKS:
            close()
            in_link = False
            heading = not closing and len(tag) == 2 and tag[0] == "h" and tag[1].isdigit()
            if tag not in _HOLDERS:
                continue
            if closing:
                for depth in range(len(held) - 1, 0, -1):
                    if held[depth][0] == tag:
                        del held[depth:]
                        break
            else:
                _, around, in_article, weak = held[-1]
                if tag in ("article", "main"):
                    inner = weak
                    while inner and inner[1]:
                        inner[1] = False
                        inner = inner[0]
                    around, in_article = around and tag != "main", True
                else:
                    names = " ".join("".join(n) for n in _NAMES.findall(m[4] or "")) if tag != "body" else ""
                    names = _NO_HINT.sub(" ", names)
                    if in_article:
                        names = " ".join(n for n in names.split() if "header" not in n.lower())
                    around |= tag in _AROUND or tag == "header" and not in_article
                    around |= bool(_AROUND_NAMES.search(names))
                    if tag == "form" or _AROUND_WORDS.search(names):
                        weak = [weak, True]
                held.append((tag, around, in_article, weak))
    say(page[at:])
    close()
    return [b._replace(around=b.around or bool(weak and weak[1])) for b, weak in found]


def features(found: list[Block]) -> np.ndarray:
    """One row of FEATURES a block; outside the page there are no words."""
    words = np.array([len(b.text.split()) for b in found], float)
    linked = np.array([b.linked for b in found], float)
    density = linked / np.maximum(words, 1)
    before = lambda x: np.concatenate([[0.0], x[:-1]])
    after = lambda x: np.concatenate([x[1:], [0.0]])
    flags = [np.array([getattr(b, k) for b in found], float) for k in FEATURES[:3]]
    sides = [before(words), before(density), after(words), after(density)]
    return np.column_stack([*flags, words, density, *sides])


class Split(NamedTuple):
    feature: int
    below: float
    yes: Split | bool
    no: Split | bool


def grown_tree(rows: np.ndarray, labels: np.ndarray, depth: int = 6) -> Split | bool:
    """A decision tree by Gini impurity; of equal splits the first feature's lowest."""
    if depth == 0 or labels.all() or not labels.any():
        return bool(labels.mean() >= 0.5)
    best = None
    for f in range(rows.shape[1]):
        values = np.unique(rows[:, f])
        for cut in (values[1:] + values[:-1]) / 2:
            left = rows[:, f] < cut
            cost = sum(
                s.sum() * labels[s].mean() * (1 - labels[s].mean()) for s in (left, ~left)
            )
            if best is None or cost < best[0] - 1e-9:
                best = (cost, f, cut)
    if best is None:
        return bool(labels.mean() >= 0.5)
    _, f, cut = best
    left = rows[:, f] < cut
    return Split(
        f, cut, grown_tree(rows[left], labels[left], depth - 1), grown_tree(rows[~left], labels[~left], depth - 1)
    )


def chosen(tree: Split | bool, rows: np.ndarray) -> np.ndarray:
    if isinstance(tree, bool):
        return np.full(len(rows), tree)
    left = rows[:, tree.feature] < tree.below
    out = np.empty(len(rows), bool)
    out[left], out[~left] = chosen(tree.yes, rows[left]), chosen(tree.no, rows[~left])
    return out


# The labelled table: small pages, a plus before the blocks of the main text. A run
# of n words stands for a text of that length, a bracketed one for a link.
_TABLE = (
    "nav[ -[2] -[1] -[1] ] article[ +h6 +45 +8 +2 +60 +1 +30 ] footer[ -9 ]",
    "nav[ -[1] -[1] ] div.ad[ -7 ] article[ +h9 +20 +3 +2 ] footer[ -6 ]",
    "header[ -h3 -4 ] main[ +h5 +70 +12 +4 +25 ] aside[ -h2 -20 -[5] ] footer[ -12 ]",
    "article[ +h4 +3 +90 div.share[ -2 -[1] ] +2 div.related[ -h2 -[6] -[7] ] ]",
    "article[ +h4 +50 +25 section.comments[ -h1 -30 -12 -45 ] ] footer[ -25 ]",
    "div.cookie[ -30 -[2] ] article[ +h7 +33 +h2 +18 +1 +5 ] form[ -3 -12 ]",
    "div[ -[2] -[1] -[3] ] div[ +h5 +55 +40 +18 +62 ] div[ -4 -[2] -[2] ]",
    "div[ -3 -[1] ] div[ +h4 +80 +35 +28 ] div.sidebar[ -h2 -28 -40 ] div[ -5 ]",
    "div[ +h6 +48 +9 +52 +38 ] div[ -[3] -[4] -[2] ] div[ -6 -[1] ]",
    "div.menu[ -2 -[2] ] div[ +30 +45 +6 +33 ] div.footer[ -22 -[2] ] div[ -4 ]",
    "div[ -[1] -[1] -[1] -2 ] div[ +h3 +65 +22 +7 +41 ] div.newsletter[ -24 -5 ]",
    "nav[ -[2] -[2] ] main[ +h4 +2 +1 +3 ] footer[ -30 -40 ]",
    "article[ +12 -[9] -[8] -[11] +40 ] aside[ -50 -60 ]",
    "header[ -h4 -[2] ] article[ +h5 +6 +6 +4 ] section.comments[ -h2 -70 -55 ]",
    "article[ +h4 +20 +5 ]",
    "nav[ -[2] ] article[ +h4 +12 +1 ]",
    "main[ +h3 +2 +40 +3 ]",
    "div[ +h5 +44 +61 ]",
    "section[ +50 +30 +12 ]",
    "div[ -[2] -[1] ] article[ +1 ]",
    "article[ +[6] +30 +[9] ]",
    "article[ +3 +[2] +20 +[12] +3 ] footer[ -8 -[3] ]",
    "main.no-sidebar[ +h5 +40 +6 +25 ] div.site-footer[ -9 -[2] ]",
    "div.search-page[ nav[ -[2] ] article.share-enabled[ div.article-header[ +h4 ] +30 +5 ] ]",
    "div.notice[ -26 ] div[ -[2] -[2] ] div[ +h4 +44 +58 ] form[ -2 -40 ] footer[ -11 ]",
)


def labelled(table: tuple[str, ...] = _TABLE) -> tuple[np.ndarray, np.ndarray]:
    """The labelled table's features and labels, by the parser that reads the pages."""
    rows, labels = [], []
    for line in table:
        out, open_tags = [], []
        for token in line.split():
            if token == "]":
                out.append(f"</{open_tags.pop()}>")
            elif token[0] not in "+-":
                tag, _, name = token[:-1].partition(".")
                open_tags.append(tag)
                out.append(f"<{tag} class='{name}'>" if name else f"<{tag}>")
            else:
                labels.append(token[0] == "+")
                text = " ".join(["w"] * int(token.strip("+-h[]")))
                text = f"<a href='#'>{text}</a>" if "[" in token else text
                out.append(f"<h2>{text}</h2>" if "h" in token else f"<p>{text}</p>")
        rows.append(features(blocks("".join(out))))
    return np.concatenate(rows), np.array(labels)


def main_text(page: str | None, tree: Split | bool) -> str:
    found = blocks(page)
    if not found:
        return ""
    keep = chosen(tree, features(found))
    return "\n".join(b.text for b, k in zip(found, keep, strict=True) if k)


def extracted(pages: DataFrame, html: str = "html") -> DataFrame:
    """Adds text and n_chars: the main text of each page and its code points.

    A null or empty page, or one without main text, gives an empty text. The other
    columns stay; columns of those two names are replaced.
    """
    tree = grown_tree(*labelled())

    @F.pandas_udf("string")
    def text(column: pd.Series) -> pd.Series:
        return column.map(lambda page: main_text(page, tree))

    return pages.withColumn("text", text(html)).withColumn(
        "n_chars", F.char_length("text").cast("long")
    )


def op9_html(spark, sf_dir: str) -> DataFrame:
    """The main text of every page."""
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet").select("page_id", "url", "html")
    return extracted(pages).select("page_id", "url", "text", "n_chars")
