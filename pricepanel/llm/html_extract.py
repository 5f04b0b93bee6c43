"""Main text of web pages: markup structure, then a suffix array for each host.

``page_blocks`` reads a page once, tag by tag, and keeps the text blocks of the
article: containers that announce other things (menus, headers, footers,
sidebars, notices, adverts, forms, comments: by element, role, class, id)
are left out, and where the page marks its article (or names it) and most of the
text is there, only that part counts; a mark on less than half of it is not the article's.

What markup does not tell, repetition does. Pages of a host are brought
together in parts of about PART_PAGES pages or PART_WORDS words (a larger host
is dealt over parts by a hash, so no task holds a large host). The word streams of a part are
concatenated and a suffix array, sorted to a depth of MIN_RUN words, puts equal
runs side by side; runs on enough distinct pages cover their words, and a block
whose words are covered is boilerplate. Enough is a share of the host's pages:
small for pages without a marked article, large inside a marked article, where
a repeated passage is usually the author's own. A page that would lose every
block keeps them all. Blocks that stay are joined in page order.

Pages of a host of several parts are counted over the whole host, exactly: a run
on a share of the host's pages is on that share of the pages of some part, so the
parts' suffix arrays name all candidates (``_named``); every part counts its pages
with them (``_counted``), the counts are summed by (host, run), and the runs that
reach the least share go back to the parts (``_cleaned``). They are few: at most
1 / share runs a word of an average page. The parts are shuffled once.

Null and empty pages give an empty text; a null or odd url is a host of its own
(the empty one). Repeated pages count as distinct pages for what repeats.
Whole pages are read, however long. Only page_id, url and html are read.
"""

from __future__ import annotations

import html
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pricepanel.llm import arrowtext as T
from pricepanel.llm.tables import stored
from pricepanel.operators.joins import maybe_broadcast
from pricepanel.session import ship_package

PART_PAGES = 256
PART_WORDS = 1_000_000
WORD_CHARS = 6
MIN_RUN = 8
COVERED = 0.9
#: (least pages, least share of the host's pages) for a run to be boilerplate, without and with a marked article.
PLAIN, MARKED = (3, 0.1), (10, 0.8)

TAG = re.compile(r"""<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*>"""
                 r"""|<(/?)([a-zA-Z][^\s/>]*)((?:[^>"']++|"[^"]*+"|'[^']*+')*+)>"""
                 r"""|<(/?)([a-zA-Z][^\s/>]*)([^>]*)>""", re.S)
ATTRIBUTE = re.compile(r"""([a-zA-Z_:][-\w:.]*)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+)))?""")

RAW = {"script", "style", "noscript", "template", "iframe", "svg", "math", "object", "canvas", "audio", "video", "title", "textarea", "select"}
VOID = {"br", "hr", "img", "input", "meta", "link", "area", "base", "col", "embed", "source", "track", "wbr"}
INLINE = {"a", "abbr", "acronym", "b", "bdi", "bdo", "big", "cite", "code", "del", "dfn", "em", "font", "i", "ins", "kbd", "mark", "q", "s",
          "samp", "small", "span", "strike", "strong", "sub", "sup", "time", "tt", "u", "var", "wbr", "img", "ruby", "rt", "rp", "data"}
ASIDE = {"nav", "header", "footer", "aside", "form", "menu", "button", "dialog", "fieldset"}
#: Asides that may be wrapped around a whole page.
FORMS = {"form", "fieldset"}
#: Containers that stay asides however much text they hold: reader comments.
NEVER_MAIN = {"comment", "comments", "reply", "replies", "respond", "discussion", "disqus"}
ROLES = {"navigation", "banner", "contentinfo", "complementary", "search", "dialog", "alert", "alertdialog", "menu", "menubar", "form", "toolbar", "tablist"}
NAMES = set("""ad ads advert adverts advertisement advertisements adsense sponsor sponsored promo promos promotion banner cookie cookies
consent gdpr notice notices notification notifications alert alerts popup modal overlay newsletter subscribe subscription signup login
sidebar sidebars nav navbar navigation menu menus breadcrumb breadcrumbs pagination pager footer header masthead topbar toolbar comment
comments reply replies respond discussion disqus related recommended recommendations share sharing social widget widgets search
skip sr form disclaimer""".split())
MAIN_ROLES = {"main", "article"}
MAIN_NAMES = {"article", "articlebody", "post", "entry", "story", "content", "maincontent"}
#: Words at the end of a class or id that tell its form or place, not what it holds.
SHAPES = set("""container wrapper wrap inner outer box bar block area section list item items row col column columns panel pane group unit slot
zone region links link buttons button icons left right top bottom main primary secondary small large wide body holder head""".split())
#: Words that make a class a statement about the page: has-sidebar, no-comments.
ABOUT = {"has", "have", "with", "without", "no", "not", "is", "hide", "show", "hides", "shows", "toggle", "before", "after", "under", "above"}
#: Lists of other pages: related-posts, popular-stories.
OTHER_PAGES = ({"related", "recommended", "popular", "trending", "more", "latest", "similar"},
               {"post", "posts", "article", "articles", "story", "stories", "news", "reading", "pages", "content"})
#: What may stand in a head; any other start tag, or text, ends it.
HEAD = {"html", "head", "title", "base", "basefont", "bgsound", "link", "meta", "style", "script", "noscript", "noframes", "template"}
HEADINGS = {"h1", "h2", "h3", "h4", "h5", "h6"}
OPEN = ("html", "body")


def _attributes(text: str) -> dict[str, str]:
    return {m[1].lower(): html.unescape(m[2] or m[3] or m[4] or "") for m in ATTRIBUTE.finditer(text)}


def _names(attributes: dict[str, str]) -> set[str]:
    """What the classes and the id call an element: the word in head position of each."""
    found = set()
    for token in (attributes.get("class", "") + " " + attributes.get("id", "")).split():
        words = [w.lower() for w in re.split(r"[^A-Za-z]+", re.sub(r"(?<=[a-z])(?=[A-Z])", " ", token)) if w]
        if not words or ABOUT & set(words):
            continue
        if len(words) > 1 and words[0] in OTHER_PAGES[0] and words[-1] in OTHER_PAGES[1]:
            found.add("related")
            continue
        while len(words) > 1 and words[-1] in SHAPES:
            words.pop()
        found.add(words[-1])
    return found


HIDDEN = -2


def _kind(tag: str, attributes: dict[str, str], inside: int) -> int:
    """-2: not shown; -1: something else than the article; 3, 2, 1: the article by element, main part, a telling name; 0: neither.

    ``inside`` is the kind of the part around: the header of an article belongs to it.
    """
    if tag == "head" or "hidden" in attributes or attributes.get("aria-hidden") == "true":
        return HIDDEN
    if re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", attributes.get("style", "")):
        return HIDDEN
    role = attributes.get("role", "").lower()
    names = _names(attributes) if tag not in OPEN and tag not in HEADINGS else set()
    if tag in ASIDE and not (tag == "header" and inside == 3) or role in ROLES or names & NAMES:
        return -1
    if tag == "article" or attributes.get("itemprop", "").lower() == "articlebody":
        return 3
    if tag == "main" or role in MAIN_ROLES:
        return 2
    return 1 if names & MAIN_NAMES else 0


class _Aside:
    """A container that is left out, unless it turns out to hold the page's main text."""

    def __init__(self, tag: str, comments: bool):
        self.form, self.comments, self.text, self.marked = tag in FORMS, comments, 0, 0


def page_blocks(page: str) -> tuple[list[str], bool]:
    """The article's text blocks in page order, and whether the page marks its article.

    A container that its tag, role or name calls an aside is left out with all
    in it, unless it is layout: it holds most of the marked article, or it is a
    form that holds most of the text of a page without one.
    """
    stack: list[tuple[str, int]] = []
    outside, level = 0, [0]
    asides: list[_Aside] = []  # those around the current place
    found: list[tuple[int, str, tuple[_Aside, ...]]] = []
    pieces: list[str] = []

    def flush() -> None:
        block = " ".join("".join(pieces).split())
        if block:
            found.append((level[-1], block, tuple(asides)))
            for a in asides:
                a.text += len(block)
                a.marked += len(block) if level[-1] >= 2 else 0
        pieces.clear()

    def leave(kind: int) -> None:
        nonlocal outside
        outside -= kind == HIDDEN
        if kind == -1:
            asides.pop()
        level.pop()

    def end_head() -> None:
        nonlocal outside
        while stack and stack[-1][0] == "head":
            leave(stack.pop()[1])

    at = 0
    while m := TAG.search(page, at):
        if stack and stack[-1][0] == "head" and page[at:m.start()].strip():
            end_head()
        if not outside and m.start() > at:
            pieces.append(html.unescape(page[at:m.start()]))
        at = m.end()
        name = m[2] or m[5]
        if name is None:
            continue
        tag, closing, rest = name.lower(), m[1] or m[4], (m[3] if m[2] else m[6]) or ""
        if not closing and tag not in HEAD:
            end_head()
        if tag in INLINE and not outside and not rest.strip("/ "):
            continue
        if tag == "br":
            pieces.append(" ")
            continue
        if closing:
            place = next((i for i in range(len(stack) - 1, -1, -1) if stack[i][0] == tag), None)
            if tag not in INLINE:
                flush()
            if place is not None:
                while len(stack) > place:
                    leave(stack.pop()[1])
            continue
        if tag in RAW:
            if not rest.endswith("/"):
                end = re.compile(rf"</{re.escape(tag)}\b[^>]*>", re.I).search(page, at)
                at = end.end() if end else len(page)
            flush()
            continue
        if tag in VOID:
            if tag not in INLINE:
                flush()
            continue
        if tag not in INLINE:
            flush()
        attributes = _attributes(rest) if rest.strip("/ ") else {}
        kind = _kind(tag, attributes, level[-1])
        if tag in ("p", "li", "dt", "dd", "tr", "td", "th", "option") and stack and stack[-1][0] == tag:
            leave(stack.pop()[1])  # its end tag may be left out
        if rest.endswith("/") or tag in INLINE and kind >= 0:
            continue
        if kind < 0:
            flush()
        stack.append((tag, kind))
        outside += kind == HIDDEN
        if kind == -1:
            asides.append(_Aside(tag, bool(_names(attributes) & NEVER_MAIN)))
        level.append(max(level[-1], kind))
    if page[at:].strip():
        end_head()
    if not outside:
        pieces.append(html.unescape(page[at:]))
    flush()
    size = sum(len(b) for _, b, _ in found)
    marked = sum(len(b) for n, b, _ in found if n >= 2)

    def layout(a: _Aside) -> bool:
        return not a.comments and (2 * a.marked > marked if marked else a.form and 2 * a.text > size)

    found = [(n, b) for n, b, around in found if all(map(layout, around))]
    # The main part with all in it: by element or role, else by name, where it holds at least half of the text.
    size = sum(len(b) for _, b in found)
    top = next((k for k in (2, 1) if size and 2 * sum(len(b) for n, b in found if n >= k) >= size), 0)
    return [b for n, b in found if n >= top], top >= 2


def _needed(pages: int, marked: list[bool]) -> np.ndarray:
    """Per page, the pages of its host of ``pages`` that a run must be on."""
    return np.array([max(k, int(np.ceil(share * pages))) for k, share in (MARKED if m else PLAIN for m in marked)], np.int64)


def _words(blocks: list[list[str]]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(hash of each word, its page, index of each page's first word and the end)."""
    raw, offsets = T.utf8(pa.array([" ".join(b) for b in blocks], pa.large_string()))
    starts, ends, rows = T.word_spans(raw, offsets, T.NOT_SPACE)
    return T.word_hashes(raw, starts, ends), np.repeat(np.arange(len(blocks)), np.diff(rows)), rows


def _repeated(hashes: np.ndarray, page: np.ndarray, rows: np.ndarray, min_run: int) -> tuple[np.ndarray, np.ndarray]:
    """(position of every run of ``min_run`` words, number of distinct pages with that run), equal runs side by side."""
    n = len(hashes)
    if n < min_run:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    # Depth-limited suffix array by doubling: rank[i] orders the first `depth` words from word i on.
    rank = np.unique(hashes, return_inverse=True)[1].astype(np.int64) + 1
    depth = 1
    while depth < min_run:
        step = min(depth, min_run - depth)
        following = np.zeros(n, np.int64)
        following[:n - step] = rank[step:]
        rank = np.unique(rank * (n + 2) + following, return_inverse=True)[1].astype(np.int64) + 1
        depth += step
    whole = np.arange(n) + min_run <= rows[page + 1]  # runs stay inside their page
    order = np.lexsort((page, rank))
    order = order[whole[order]]
    if not len(order):
        return order, order
    fresh = np.ones(len(order), bool)
    fresh[1:] = rank[order[1:]] != rank[order[:-1]]
    other = fresh.copy()
    other[1:] |= page[order[1:]] != page[order[:-1]]
    group = np.cumsum(fresh) - 1
    return order, np.bincount(group, weights=other).astype(np.int64)[group]


def _runs(hashes: np.ndarray, page: np.ndarray, rows: np.ndarray, min_run: int) -> tuple[np.ndarray, np.ndarray]:
    """(position, hash) of every run of ``min_run`` words, in page order."""
    if len(hashes) < min_run:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    at = np.arange(len(hashes) - min_run + 1)
    at = at[at + min_run <= rows[page[at] + 1]]
    return at, T.shingle_hashes(hashes, min_run)[at].view(np.int64)


def _covered(blocks: list[list[str]], often: np.ndarray, n: int, min_run: int) -> list[list[bool]]:
    """Per page and block: do the runs at ``often`` cover it? A page that would lose all loses none."""
    edge = np.zeros(n + 1, np.int64)
    np.add.at(edge, often, 1)
    np.add.at(edge, often + min_run, -1)
    covered = np.concatenate(([0], np.cumsum(np.cumsum(edge[:n]) > 0)))
    out, at = [], 0
    for own in blocks:
        gone = []
        for b in own:
            size = len(b.split())
            gone.append(covered[at + size] - covered[at] >= COVERED * size)
            at += size
        out.append([False] * len(own) if all(gone) else gone)
    return out


def boilerplate(blocks: list[list[str]], marked: list[bool], min_run: int = MIN_RUN) -> list[list[bool]]:
    """Per page and block of a whole host: is it covered by runs that enough of its pages share?"""
    hashes, page, rows = _words(blocks)
    order, support = _repeated(hashes, page, rows, min_run)
    often = order[support >= _needed(len(blocks), marked)[page[order]]]
    return _covered(blocks, often, len(hashes), min_run)


def named_runs(blocks: list[list[str]], min_run: int = MIN_RUN) -> np.ndarray:
    """Hashes of the runs that are on the least share of this part's pages."""
    hashes, page, rows = _words(blocks)
    order, support = _repeated(hashes, page, rows, min_run)
    often = np.sort(order[support >= min(PLAIN[1], MARKED[1]) * len(blocks) * (1 - 1e-9)])
    at, runs = _runs(hashes, page, rows, min_run)
    return np.unique(runs[np.searchsorted(at, often)])


def run_pages(blocks: list[list[str]], wanted: np.ndarray, min_run: int = MIN_RUN) -> tuple[np.ndarray, np.ndarray]:
    """(run, number of this part's pages with it) for the wanted hashes (sorted, distinct) that occur."""
    hashes, page, rows = _words(blocks)
    at, runs = _runs(hashes, page, rows, min_run)
    near = np.searchsorted(wanted, runs)
    hit = np.flatnonzero(np.append(wanted, 0)[near] == runs) if len(wanted) else near[:0]
    hit = hit[near[hit] < len(wanted)]
    pairs = np.unique(near[hit] * np.int64(len(blocks) + 1) + page[at[hit]])
    found, n = np.unique(pairs // (len(blocks) + 1), return_counts=True)
    return wanted[found], n


def boilerplate_of_part(blocks: list[list[str]], marked: list[bool], host_pages: int, runs: np.ndarray, support: np.ndarray,
                        min_run: int = MIN_RUN) -> list[list[bool]]:
    """As ``boilerplate`` for a part of a host, given the host's runs (sorted, distinct) and their pages."""
    if not len(runs):
        return [[False] * len(b) for b in blocks]
    hashes, page, rows = _words(blocks)
    at, own = _runs(hashes, page, rows, min_run)
    near = np.minimum(np.searchsorted(runs, own), len(runs) - 1)
    often = at[(runs[near] == own) & (support[near] >= _needed(host_pages, marked)[page[at]])]
    return _covered(blocks, often, len(hashes), min_run)


_PART = "host string, part bigint, parts bigint, n bigint"
_BLOCKS = f"page_id bigint, url string, {_PART}, blocks array<string>, marked boolean"
_RUN = pa.schema([("host", pa.string()), ("parts", pa.int64()), ("n", pa.int64()), ("run", pa.int64()), ("support", pa.int64())])
_TEXTS = pa.schema([("page_id", pa.int64()), ("url", pa.string()), ("text", pa.string())])


def _parsed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    own = ["page_id", "url", "host", "part", "parts", "n"]
    for batch in batches:
        for part in T.slices(batch, "html"):
            both = [page_blocks(x or "") for x in part.column("html").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [*[part.column(n) for n in own], pa.array([b for b, _ in both], pa.list_(pa.string())),
                 pa.array([m for _, m in both], pa.bool_())], [*own, "blocks", "marked"])


def _run_rows(host: str, parts: int, n: int, runs: np.ndarray, support: np.ndarray) -> pa.Table:
    size = len(runs)
    return pa.table([pa.array([host] * size, pa.string()), pa.array([parts] * size, pa.int64()), pa.array([n] * size, pa.int64()),
                     pa.array(runs, pa.int64()), pa.array(support, pa.int64())], schema=_RUN)


def _named(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Candidate runs of each part of a host of several; rows come sorted by (host, part)."""
    held: list[list[str]] = []
    key = None

    def name() -> Iterator[pa.RecordBatch]:
        runs = named_runs(held)
        yield from _run_rows(key[0], key[2], key[3], runs, np.zeros(len(runs), np.int64)).to_batches()

    for batch in batches:
        columns = [batch.column(n).to_pylist() for n in ("host", "part", "parts", "n")]
        for i, new in enumerate(zip(*columns)):
            if new[2] < 2:
                continue
            if held and new != key:
                yield from name()
                held = []
            key = new
            held.append(batch.column("blocks")[i].as_py())
    if held:
        yield from name()


def _counted(part: pa.Table, runs: pa.Table) -> pa.Table:
    """Pages of one part with each candidate run."""
    if not part.num_rows or not runs.num_rows:
        return _RUN.empty_table()
    found, n = run_pages(part.column("blocks").to_pylist(), np.sort(runs.column("run").to_numpy()))
    return _run_rows(*[part.column(c)[0].as_py() for c in ("host", "parts", "n")], found, n)


def _cleaned(part: pa.Table, runs: pa.Table) -> pa.Table:
    """The texts of one part; a host of one part counts for itself."""
    if not part.num_rows:
        return _TEXTS.empty_table()
    blocks, marked = part.column("blocks").to_pylist(), part.column("marked").to_pylist()
    if part.column("parts")[0].as_py() > 1:
        run, support = (runs.column(n).to_numpy() for n in ("run", "support"))
        order = np.argsort(run)
        gone = boilerplate_of_part(blocks, marked, part.column("n")[0].as_py(), run[order], support[order])
    else:
        gone = boilerplate(blocks, marked)
    texts = [" ".join(b for b, g in zip(own, flags) if not g) for own, flags in zip(blocks, gone)]
    return pa.table([part.column("page_id"), part.column("url"), pa.array(texts, pa.string())], schema=_TEXTS)


def _to_parts(runs: DataFrame) -> DataFrame:
    """Rows of a host's runs, once for each of its parts."""
    return runs.withColumn("part", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("parts") - 1)))


def main_text(pages: DataFrame, part_pages: int = PART_PAGES) -> DataFrame:
    """(page_id, url, text, n_chars) of every page; one shuffle of the blocks by (host, part), read three times."""
    ship_package(pages.sparkSession)
    host = F.lower(F.regexp_extract(F.coalesce("url", F.lit("")), r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]+)", 1))
    sites = pages.select(F.col("page_id").cast("bigint").alias("page_id"), F.col("url").cast("string").alias("url"),
                         F.col("html").cast("string").alias("html")).withColumn("host", host)
    counts = sites.groupBy("host").agg(F.count(F.lit(1)).alias("n"), F.sum(F.octet_length("html").cast("bigint")).alias("size"))
    parts = F.greatest(F.ceil(F.col("n") / part_pages), F.ceil(F.col("size") / (PART_WORDS * WORD_CHARS))).cast("bigint")
    counts = counts.withColumn("parts", parts).where(F.col("parts") > 1)
    large = stored(counts.select(F.col("host").alias("large_host"), "parts", "n"), "large-hosts")
    dealt = sites.join(maybe_broadcast(large), F.col("host") == F.col("large_host"), "left")
    dealt = dealt.withColumns({"parts": F.coalesce("parts", F.lit(1).cast("bigint")), "n": F.coalesce("n", F.lit(0).cast("bigint"))})
    dealt = dealt.withColumn("part", F.pmod(F.xxhash64("page_id", "url"), "parts"))
    blocks = dealt.select("page_id", "url", "host", "part", "parts", "n", "html").mapInArrow(_parsed, _BLOCKS)
    # The same exchange in all three steps: Spark runs it once and reuses its files.
    together = blocks.repartition("host", "part")
    by_part, columns = together.groupBy("host", "part"), f"{_PART.replace('part bigint, ', '')}, run bigint, support bigint"
    named = together.sortWithinPartitions("host", "part").mapInArrow(_named, columns)
    named = named.groupBy("host", "run").agg(F.max("parts").alias("parts"))
    counted = by_part.cogroup(_to_parts(named).groupBy("host", "part")).applyInArrow(_counted, columns)
    summed = counted.groupBy("host", "run").agg(F.sum("support").alias("support"), F.max("parts").alias("parts"), F.max("n").alias("n"))
    least = min(PLAIN[1], MARKED[1]) * (1 - 1e-9)
    common = summed.where(F.col("support") >= F.col("n") * least).select("host", "run", "support", "parts")
    cleaned = by_part.cogroup(_to_parts(common).groupBy("host", "part")).applyInArrow(_cleaned, "page_id bigint, url string, text string")
    return cleaned.withColumn("n_chars", F.char_length("text").cast("bigint"))
