"""HTML-facing columns: paragraph markup, entity escaping, description clip, URL joins,
link resolution, page main-text extraction.
"""

from __future__ import annotations

import html
import re
from bisect import bisect_right
from collections import Counter

from pyspark.sql import Column
from pyspark.sql import functions as F

from feedlake import config as C
from feedlake.functions.text import col_, full_trim


def html_escape(c) -> Column:
    """& first, then < > " ' (quote=True form: &quot; and &#x27;)."""
    s = F.replace(col_(c), F.lit("&"), F.lit("&amp;"))
    for a, b in (("<", "&lt;"), (">", "&gt;"), ('"', "&quot;"), ("'", "&#x27;")):
        s = F.replace(s, F.lit(a), F.lit(b))
    return s


def paragraphs_html(c) -> Column:
    """Split on blank-line pairs, trim, drop empty pieces, escape, inner newlines -> <br/>,
    wrap each in <p>..</p>, join with a blank line. NULL/'' -> ''."""
    text = col_(c)
    paras = F.filter(F.transform(F.split(F.coalesce(text, F.lit("")), "\n\n"), full_trim), lambda p: p != "")
    wrapped = F.transform(
        paras, lambda p: F.concat(F.lit("<p>"), F.replace(html_escape(p), F.lit("\n"), F.lit("<br/>")), F.lit("</p>")))
    return F.array_join(wrapped, "\n\n")


def clip_description(c, max_len: int = C.DESCRIPTION_MAX, cut_len: int = C.DESCRIPTION_CUT) -> Column:
    """Trimmed, newline -> space, double quote -> single quote; when longer than max_len keep the
    first cut_len chars back to the last space (all of them if there is none) plus '...'."""
    d = F.replace(F.replace(full_trim(F.coalesce(col_(c), F.lit(""))), F.lit("\n"), F.lit(" ")), F.lit('"'), F.lit("'"))
    clipped = F.concat(F.regexp_replace(F.substring(d, 1, cut_len), " [^ ]*$", ""), F.lit("..."))
    return F.when(F.length(d) > max_len, clipped).otherwise(d)


def join_url(base: str, path) -> Column:
    """base (trailing slashes dropped) + '/' + relative path (leading slashes dropped)."""
    return F.concat(F.lit(base.rstrip("/") + "/"), F.regexp_replace(col_(path), "^/+", ""))


def resolve_link(raw, base_path: str = "") -> Column:
    """Browser link rule: '' -> '#'; http* kept; already under base kept; '/x' -> base+'/x';
    'x' -> base+'/x'."""
    r = col_(raw)
    return (F.when(r.isNull() | (r == ""), F.lit("#"))
            .when(r.startswith("http"), r)
            .when(r.startswith(base_path), r)
            .when(r.startswith("/"), F.concat(F.lit(base_path), r))
            .otherwise(F.concat(F.lit(base_path + "/"), r)))


def unescape_entities(c) -> Column:
    """Decode all character references, named and numeric, by the HTML rules, once. Spark has no function
    for the standard's table of names, so this one runs the standard library's over Arrow batches."""
    import pandas as pd

    def decoded(texts):
        return texts.map(lambda t: t if t is None or "&" not in t else html.unescape(t))

    decoded.__annotations__ = {"texts": pd.Series, "return": pd.Series}
    return F.pandas_udf(decoded, "string")(col_(c))


#: Elements that hold others. The end of any other element (a paragraph, a link, bold text) ends none of these.
CONTAINERS = frozenset("""address article aside blockquote body button caption center dd details dialog dir div dl dt fieldset
figcaption figure footer form header hgroup html li main menu nav ol pre section summary table tbody td tfoot th thead tr ul""".split())
#: Elements left out of the main text with all they hold; a div is left out if its class is `ad`.
LEFT_OUT = ("nav", "aside")
#: Elements whose content is no markup.
RAW = {name: re.compile(rf"</{name}\s*>", re.I) for name in ("script", "style")}
_OPENED = re.compile(r"<(?:!--|(/?)([A-Za-z][^\s/>]*)([^>]*)>)")
_AD = re.compile(r"""(?:^|\s)class\s*=\s*(?:"ad"|'ad'|ad(?=[\s/]|$))""", re.I)
_TAGS = re.compile("<[^>]*>(?:<[^>]*>)*")


def _structure(page: str):
    """(start, end, name, kind) of what shapes the page, in order; kind is 'open', 'close', 'drop' (the open tag of an
    element left out) or 'cut' (a comment, or a script or style element as a whole, if it ends)."""
    past, unended = 0, set()
    for m in _OPENED.finditer(page, 0, page.rfind(">") + 1):  # every < there has a > after it: linear time
        start, end = m.span()
        name = (m[2] or "!--").lower()
        if start < past:
            continue
        if name == "!--" or name in RAW:
            if not m[1] and name not in unended:
                at = page.find("-->", end) + 3 if name == "!--" else stop.end() if (stop := RAW[name].search(page, end)) else 2
                if at > 2:
                    past = at
                    yield start, past, name, "cut"
                else:
                    unended.add(name)
        elif name not in CONTAINERS:
            continue
        elif m[1]:
            yield start, end, name, "close"
        else:
            yield start, end, name, "drop" if name in LEFT_OUT or name == "div" and _AD.search(m[3]) else "open"


def _left_out(tags: list) -> list:
    """(start, end) of what is left out, outermost ones only, in order. A close tag ends the innermost open element of its
    name and all that stand open inside it; close tags without one mean nothing. An element that nothing ends stays in."""
    spans, stack, count = [], [], Counter()
    for start, end, name, kind in tags:
        if kind == "cut":
            spans.append((start, end))
        elif kind != "close":
            stack.append((name, start if kind == "drop" else -1))
            count[name] += 1
        elif count[name]:
            top = None
            while top != name:
                top, since = stack.pop()
                count[top] -= 1
                if since >= 0:
                    spans.append((since, end if top == name else start))
    outer = []
    for start, end in sorted(spans):
        if not outer or start >= outer[-1][1]:
            outer.append((start, end))
    return outer


def main_text(page: str | None) -> str:
    """Main text of a raw page: comments, scripts, styles, nav, aside and ad elements go with all they hold, however
    deeply they nest; what is inside <article> stays (from the first to the last close tag; else <body>, else the page);
    every run of tags is one newline; character references are decoded once. Not trimmed. NULL/empty -> ''."""
    if not page:
        return ""
    tags = list(_structure(page))
    spans = _left_out(tags)
    starts = [a for a, _ in spans]
    kept = [t for t in tags if not (i := bisect_right(starts, t[0])) or t[0] >= spans[i - 1][1]]

    def between(first: int, last: int) -> str:
        edges = [first, *(x for a, b in spans if first <= a and b <= last for x in (a, b)), last]
        return "".join(page[a:b] for a, b in zip(edges[::2], edges[1::2]))

    main = ""
    for name in ("article", "body"):
        first = next((end for _, end, n, kind in kept if n == name and kind == "open"), None)
        last = next((start for start, _, n, kind in reversed(kept) if n == name and kind == "close"), None)
        if not main and first is not None and last is not None and first < last:
            main = between(first, last)
    main = main or between(0, len(page))
    whole = main.rfind(">") + 1
    return html.unescape(_TAGS.sub("\n", main[:whole]) + main[whole:])


def page_main_text(page) -> Column:
    """main_text of a column of raw pages, trimmed. The scan keeps a stack of open elements for each page, which no
    expression of columns can; it runs over Arrow batches, once, and decodes character references as it goes."""
    import pandas as pd

    def texts(pages):
        return pages.map(main_text)

    texts.__annotations__ = {"pages": pd.Series, "return": pd.Series}
    return full_trim(F.pandas_udf(texts, "string")(col_(page)))
