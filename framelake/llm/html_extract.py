"""Main text of web pages by line-block distribution.

Markup is stripped into lines, one for each block element. Elements that can't hold the article (scripts, menus,
headers, footers, sidebars, notices, adverts, forms, reader comments) become runs of empty lines. The lengths of
the lines' unlinked text are summed over sliding windows; where the sums rise from zero a segment surges, where
they fall back to zero it dives. So ``WINDOW`` or more lines of links alone, marked or not, end a segment and are
left out, fewer stay inside it; links in an article's paragraphs are its text. A segment is kept if enough of its text is unlinked. On a page with an article only
the lines inside it have lengths: outside an article, class and id words of any kind name furniture; inside, only
elements made for it and a few exact names do, as words like "related" or "discussion" may name its own sections.

Null or empty pages, and pages without unlinked text, give an empty string. Every other column is left alone.
"""

from __future__ import annotations

import html as html_lib
import re
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from framelake.llm.common import table
from framelake.session import share_code

WINDOW = 3
#: Least share of a segment's characters that are unlinked, on pages without an article element and inside one.
LEAST_UNLINKED, LEAST_INSIDE = 0.5, 0.25

TAG = re.compile(r"""<!--.*?(?:-->|\Z)|<(/?)([a-zA-Z][^\s/>]*+)((?:[^>"'<]|"[^"<]*+"|'[^'<]*+')*+)>|<(/?)([a-zA-Z][^\s/>]*+)([^>]*+)>|<[!?][^>]*+>""", re.S)
ATTRIBUTE = re.compile(r"""([a-zA-Z-]+)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))|(\bhidden\b)""")
RAW = frozenset({"script", "style", "textarea", "title", "noscript", "iframe", "xmp", "noframes", "template"})
DROPPED = RAW | frozenset({"nav", "footer", "aside", "form", "button", "select", "svg", "canvas", "object", "audio", "video", "map", "dialog", "menu"})
MAIN = frozenset({"article", "main"})
BLOCKS = frozenset("address article aside blockquote body caption center dd details dialog div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol optgroup option p pre section summary table tbody td tfoot th thead tr ul".split())
#: Their text counts as unlinked, of the latter inside an article.
HEADINGS = frozenset({"h1", "h2", "h3", "h4", "h5", "h6"})
PROSE = frozenset({"p", "blockquote", "figcaption", "dd", "pre"})
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: Words of class and id that name page furniture, and the roles that do.
FURNITURE = frozenset(
    "ad ads advert adverts advertisement advertising adsense sponsor sponsored promo promotion banner sidebar nav navbar navigation menu breadcrumb breadcrumbs "
    "footer masthead cookie cookies consent gdpr notice notices popup modal newsletter subscribe subscription signup comment comments disqus discussion respond reply replies "
    "share sharing social related recommended recommendations widget toolbar pagination pager login search copyright disclaimer".split()
)
TALK = frozenset("comment comments disqus discussion respond reply replies".split())
#: Whole class names and ids that name furniture inside an article too.
EXACT = frozenset(
    "ad ads advert adverts advertisement adsbygoogle sponsored promo sidebar breadcrumb breadcrumbs cookie-notice cookie-banner newsletter newsletter-signup popup modal "
    "share share-buttons social-share comments comment-list comment-form disqus_thread pagination".split()
)
ROLES = frozenset("navigation banner contentinfo complementary search form dialog alert alertdialog menu menubar toolbar".split())
KEPT = frozenset({"html", "body", "main", "head"})


def _words(value: str) -> set[str]:
    return set(re.findall(r"[a-z]+", re.sub(r"([a-z])([A-Z])", r"\1 \2", value).lower()))


def _furniture(tag: str, attributes: str, inside: bool) -> bool:
    if tag in DROPPED or tag == "header" and not inside:
        return True
    if tag in KEPT or not attributes.strip():
        return False
    found = {m[1].lower(): m[2] or m[3] or m[4] or "" for m in ATTRIBUTE.finditer(attributes) if m[1]}
    if found.get("role", "").lower() in ROLES or re.search(r"display\s*:\s*none", found.get("style", "")) or re.search(r"(?:^|\s)hidden(?:\s|$)", attributes):
        return True
    for name in ("class", "id"):
        for part in found.get(name, "").split():
            words = _words(part)
            if inside and tag != "article":
                if part.lower() in EXACT:
                    return True
                continue
            if not words & {"has", "with", "no", "without"} and words & (TALK if tag == "article" else FURNITURE | {"header"}):
                return True
    return False


def lines(page: str) -> tuple[list[tuple[str, int, bool, bool]], bool]:
    """The page's lines as (text, unlinked characters, after furniture, inside an article), and whether it has an article."""
    spans: list[tuple[int, int, str, str, bool]] = []
    opened: dict[str, list[int]] = {}
    close: dict[int, int] = {}
    raw_until = 0
    low = page.lower() if re.search("<(?:" + "|".join(RAW) + ")", page, re.I) else page
    for m in TAG.finditer(page):
        if m.start() < raw_until:
            continue
        name = m[2] or m[5]
        if not name:
            spans.append((m.start(), m.end(), "", "", False))
            continue
        name, attributes, closing = name.lower(), m[3] or m[6] or "", bool(m[1] or m[4])
        k = len(spans)
        spans.append((m.start(), m.end(), name, attributes, closing))
        if closing:
            if opened.get(name):
                close[opened[name].pop()] = k
        elif name in RAW and not attributes.rstrip().endswith("/"):
            at = low.find(f"</{name}", m.end())
            if at >= 0:
                raw_until = at
                opened.setdefault(name, []).append(k)
        elif name not in VOID:
            opened.setdefault(name, []).append(k)
    out: list[tuple[str, int, bool, bool]] = []
    buffer: list[str] = []
    unlinked = 0
    link_until = heading_until = main_until = -1
    gap = has_main = prose = False
    at = k = 0

    def flush(inside: bool) -> None:
        nonlocal unlinked, gap
        text = " ".join(html_lib.unescape("".join(buffer)).split())
        if text:
            out.append((text, unlinked, gap, inside))
            gap = False
        buffer.clear()
        unlinked = 0

    def take(piece: str, linked: bool) -> None:
        nonlocal unlinked
        if piece:
            buffer.append(piece)
            if not linked:
                unlinked += len(piece.strip())

    while k < len(spans):
        start, end, name, attributes, closing = spans[k]
        take(page[at:start], not prose and heading_until < k <= link_until)
        at = end
        if name:
            if not closing and name not in VOID and _furniture(name, attributes, k < main_until) and (k in close or name in RAW):
                flush(k <= main_until)
                gap = True
                if k in close:
                    k = close[k]
                    at = spans[k][1]
            elif name in BLOCKS:
                flush(k <= main_until)
                prose = not closing and name in PROSE and k <= main_until
                if not closing and name in HEADINGS:
                    heading_until = close.get(k, k)
                if not closing and k >= main_until and (name in MAIN or re.search(r"""role\s*=\s*["']?main|articleBody""", attributes)):
                    main_until, has_main, gap = close.get(k, len(spans)), True, True
            elif name == "br":
                buffer.append(" ")
            elif name == "a" and not closing:
                link_until = close.get(k, k)
        k += 1
    take(page[at:], False)
    flush(False)
    return out, has_main


def main_text(page: str | None, window: int = WINDOW, least_unlinked: float = LEAST_UNLINKED, least_inside: float = LEAST_INSIDE) -> str:
    """The page's main text, blocks joined by an empty line."""
    if not page:
        return ""
    found, has_main = lines(page)
    # the distribution: furniture becomes so many empty lines that no window reaches over it
    lengths, back = [], []
    for i, (text, unlinked, gap, inside) in enumerate(found):
        if gap:
            lengths += [0] * window
            back += [-1] * window
        lengths.append(unlinked if inside or not has_main else 0)
        back.append(i)
    sums = [sum(lengths[max(0, i - window + 1) : i + 1]) for i in range(len(lengths) + window)]
    segments, surge = [], None
    for i, total in enumerate(sums):
        if total and surge is None:
            surge = i
        elif not total and surge is not None:
            segments.append((surge, i - window))
            surge = None
    if surge is not None:
        segments.append((surge, len(lengths) - 1))
    kept, least = [], least_inside if has_main else least_unlinked
    for surge, dive in segments:
        own = [found[back[i]] for i in range(surge, dive + 1) if back[i] >= 0]
        if sum(x[1] for x in own) >= least * sum(len(x[0]) for x in own):
            kept += [x[0] for x in own if not has_main or x[3]]
    return "\n\n".join(kept)


def extract(pages: DataFrame, html: str = "html", into: str = "text", **limits: float) -> DataFrame:
    """``pages`` with the main text of column ``html`` in a new column; a column named ``into`` is replaced."""
    share_code(pages.sparkSession)

    @F.pandas_udf("string")
    def text(column: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for part in column:
            yield pd.Series([main_text(x, **limits) for x in part], index=part.index, dtype="object")

    return pages.withColumn(into, text(F.col(html)))


def op1_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Main text of every page: page_id, url, text, n_chars."""
    pages = table(spark, sf_dir, "pages").select("page_id", "url", "html")
    return extract(pages).select("page_id", "url", "text", F.length("text").cast("long").alias("n_chars"))
