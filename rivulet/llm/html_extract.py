"""Operator 3, HTML extraction: site template removal.

Every element's subtree is hashed bottom-up (its tag, class and id, text and children).
Spark counts with how many different contents of a host each hash occurs (pages with the
same main text are one content), and blocks that recur with many contents are deleted,
whatever they are called: menus, notices, adverts. Inline elements, headings, cells and
short paragraphs belong to the text around them and go only together with their block.
The bar is a count that grows with the logarithm of the host's contents only, so that a
notice on thousands of pages goes however large the host, as do adverts that rotate. Inside
the article it is higher, since sites repeat passages; a page whose recurring blocks are most of its text, as in a group of near copies,
keeps all that hold more than links. Tags, roles and class names that announce boilerplate
are deleted as well, so that pages of small hosts lose theirs too.

The counting key is (host, hash, content), made distinct per slice and map-side, so a host
with a third of all pages is spread over its hashes and contents. What a host's pages share
is a bounded list for each content: with E elements on average, C contents have ``C * E``
hashes, of which at most ``C * E / MIN_PAGES`` reach the bar.
"""

from __future__ import annotations

import html as _html
import re
from collections import Counter
from collections.abc import Iterator
from hashlib import blake2b

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rivulet.llm.common import stored, text_slices
from rivulet.llm.url_filter import host_of

#: A subtree is template if at least so many contents of its host have it, on a host of up
#: to FROM contents; each doubling of the host's contents adds as many again.
MIN_PAGES, FROM = 5, 50
#: The same for a subtree inside the article.
MIN_PAGES_INSIDE, FROM_INSIDE = 20, 100
#: A paragraph shorter than this ("Yes.", "* * *") is running text, however often it recurs.
LEAST_CHARS = 15
#: Recurring text of a page that is longer than this and than the rest is its content.
MOST_CHARS = 300

_TAG = re.compile(r"<!--.*?(?:-->|\Z)|<[!?][^>]*(?:>|\Z)|<(/?)([a-zA-Z][^\s/>]*)([^>]*)(?:>|\Z)", re.S)
#: The rest of a tag, in which quoted values may hold anything; without its last group where
#: the tag does not end before the next one begins.
_REST = re.compile(r"(?:[^<>=]++|=\s*+(?:\"[^\"]*+\"|'[^']*+')?+)*+(>)?")
_ATTR = re.compile(r"([^\s\"'<>/=]+)(?:\s*=\s*(\"[^\"]*\"|'[^']*'|[^\s\"'>]+))?")
_SPACE = re.compile(r"\s+")
_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
_RAW = frozenset("script style title textarea noscript template iframe svg annotation annotation-xml object".split())
_BLOCK = frozenset(
    "address article aside blockquote body center dd details div dl dt fieldset figcaption figure footer form h1 h2 h3 "
    "h4 h5 h6 header hgroup hr html legend li main menu nav ol p pre section summary table tbody td tfoot th thead tr ul".split())
_HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
#: Blocks that recurrence may delete: not those that are part of a text, list or table.
_RECURS = _BLOCK - _HEADINGS - frozenset(
    "html body article main dd dt figcaption hgroup hr legend li summary tbody td tfoot th thead tr".split())
#: Opening one of these closes an open one of the named tags in the same container.
_CLOSES = {"li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr", "td", "th"), "td": ("td", "th"),
           "th": ("td", "th"), "option": ("option",), "tbody": ("tbody", "thead", "tr", "td", "th"),
           "tfoot": ("tbody", "thead", "tr", "td", "th")}
_SCOPE = frozenset("html body table td th article main section div aside nav header footer form ul ol dl blockquote".split())
_DROP_TAG = frozenset("nav aside footer button select dialog head menu label datalist".split())
_DROP_WORD = frozenset(
    "ad ads advert adverts advertisement advertising sponsor sponsored promo promotion banner breadcrumb breadcrumbs "
    "comment comments respond disqus cookie cookies consent gdpr notice popup modal overlay footer masthead menu nav "
    "navbar navigation newsletter pagination pager related recommended share sharing sidebar social subscribe "
    "signup login search toolbar widget widgets copyright skip".split())
_DROP_ROLE = frozenset("navigation banner contentinfo complementary search dialog alert alertdialog menu menubar".split())
_WORD = re.compile(r"[a-z]+")
#: A class name or id announces boilerplate also inside the article, where single words may
#: as well tell what the text is about, if all its words name a kind of boilerplate or a part
#: of a layout: ``comments-area``, ``cookie-banner-wrap``, but not ``cookie-recipe``. These
#: kinds do so alone, the others only next to a part or another kind.
_KIND_ALONE = frozenset(
    "ad ads advert adverts advertisement advertisements sponsored breadcrumb breadcrumbs comment comments commentlist "
    "respond disqus newsletter pagination pager navbar sidebar popup modal masthead promo".split())
_KIND = _KIND_ALONE | frozenset(
    "cookie cookies consent gdpr nav navigation recommended related share sharing signup skip social subscribe".split())
_PART = frozenset(
    "area articles banner bar block bottom box button buttons container content footer form header icons inner item items "
    "left link links list news notice outer panel post posts reader readers right section slot stories thread tools top unit "
    "user users wrap wrapper".split())
#: Words that may stand next to a kind but make none of it.
_BESIDE = _PART | frozenset(["media"])
#: Kinds that, alone, also mark parts of a running text (comments in source code).
_NOT_TEXT = frozenset("comment promo".split())
#: Those of them that an id generated from a heading may be.
_SLUGS = frozenset("ad ads advert adverts advertisement sponsored newsletter pagination pager sidebar popup modal masthead".split())


def _announces(name: str, running: bool) -> bool:
    """Whether a name is made of kinds of boilerplate and parts of a layout."""
    if running and name in _NOT_TEXT:
        return False
    words = set(name.split("-")) - {""}
    kinds = words & _KIND
    if not kinds or words - _KIND - _BESIDE:
        return False
    return bool(kinds & _KIND_ALONE or words & _PART) or len(kinds) > 1


def _named(tag: str, attrs: dict[str, str], inside: bool) -> tuple[bool, bool]:
    """Whether class and id make an element boilerplate, and whether they hint at it."""
    classes, key = attrs.get("class", "").lower(), attrs.get("id", "").lower()
    if tag in ("html", "body", "article", "main") and "comment" not in classes:
        return False, False
    names = set(classes.replace("_", "-").split())
    text = tag == "p" or tag in _HEADINGS
    if not text:  # ids of headings and sections are often made from their words
        names |= {key.replace("_", "-").strip()} - (_SLUGS if tag == "section" else frozenset())
    if any(_announces(name, text or tag not in _BLOCK or tag == "pre") for name in names):
        return True, True
    words = _WORD.findall(classes + ("" if text or tag == "section" else " " + key))
    hint = any(w in _DROP_WORD for w in words) or "header" in words and not inside
    return hint and not (inside or text) or tag in ("article", "main") and hint, hint


def _boilerplate(tag: str, attrs: dict[str, str], inside: bool) -> bool:
    if tag in _DROP_TAG or tag == "header" and not inside or "hidden" in attrs:
        return True
    if attrs.get("role", "") in _DROP_ROLE or attrs.get("aria-hidden") == "true":
        return True
    return "display:none" in attrs.get("style", "").replace(" ", "")


class _Open:
    """An open element. Of the text kept in it, ``size`` counts the characters outside links,
    ``linked`` those in links and ``heads`` those of recurring headings; ``cut`` tells that
    a recurring block in it was deleted, ``form`` is the number of a form (0: none), and
    ``hint`` tells that its names hint at boilerplate."""

    __slots__ = ("tag", "names", "parts", "at", "drop", "main", "size", "linked", "heads", "cut", "form", "hint")

    def __init__(self, tag, names, at, drop, main, form=0, hint=False):
        self.tag, self.names, self.parts, self.at, self.drop, self.main = tag, names, [], at, drop, main
        self.size = self.linked = self.heads = 0
        self.cut, self.form, self.hint = False, form, hint


def parse(source: str, templates: frozenset[int] = frozenset(), inner: frozenset[int] = frozenset(),
          found: Counter | None = None) -> str:
    """Main text of a page without boilerplate and without the blocks hashed in
    ``templates`` (``inner`` inside the article): that of its main elements if they hold at
    least half of the text outside links, else all of it. ``found`` receives the hash of each
    distinct subtree that recurrence may delete, as ``(hash, inside)``.

    Broken pages are read as browsers do: missing end tags are implied by what follows,
    stray end tags are ignored, and what is open at the end is closed."""
    text, hashes, lost, kept, (size, form) = _read(source, templates, inner, False, 0)
    if size <= kept:
        form = 0
    else:  # the page is in this form
        text, hashes, lost, kept, _ = _read(source, templates, inner, False, form)
    if lost > MOST_CHARS and lost > kept:
        text = _read(source, templates, inner, True, form)[0]
    if found is not None:
        found.update(hashes)
    return text


def _read(source: str, templates: frozenset[int], inner: frozenset[int],
          spare: bool, page_form: int) -> tuple[str, set[tuple[int, bool]], int, int, tuple[int, int]]:
    """Text, hashes, the characters outside links that recurrence deleted and that are left,
    and size and number of the largest deleted form. Forms are deleted unless they hold a
    main element or are number ``page_form``. With ``spare`` recurrence deletes only blocks
    without text outside links."""
    out: list[str | None] = []  # text, and None between blocks
    best: list[str | None] = []
    stack = [_Open("", "", 0, False, False)]
    mains = lost = best_size = forms = 0
    largest = (0, 0)
    opened: Counter = Counter()  # how many of each tag are open: spares searching a deep stack
    hashes: set[tuple[int, bool]] = set()

    def close() -> None:
        nonlocal mains, lost, best_size, largest
        e = stack.pop()
        opened[e.tag] -= 1
        if e.tag in _BLOCK:
            out.append(None)
        mark = b""
        if e.parts:
            mark = blake2b(f"{e.tag}\x00{e.names}\x00".encode() + b"\x00".join(e.parts), digest_size=8).digest()
            stack[-1].parts.append(mark)
        inside = mains > 0 and not e.hint  # a name that hints at boilerplate lowers the bar
        if e.main:
            mains -= 1
        number = int.from_bytes(mark, "little", signed=True) if mark else 0
        length, known = e.size + e.linked, inner if inside else templates
        if not mark or e.main:
            pass
        elif e.tag in _HEADINGS:
            hashes.add((number, inside))
            if number in known:
                e.heads = length
        elif e.tag in _RECURS and (e.tag != "p" or len(b" ".join(e.parts)) >= LEAST_CHARS) or (
                e.tag == "li" and not inside and not e.size):
            hashes.add((number, inside))
            # also what is left of a block when only its recurring headings are
            if not e.drop and (number in known and not (spare and e.size) or e.cut and length == e.heads):
                e.drop = stack[-1].cut = True
                lost += e.size
        if e.form:
            if not e.drop and not any(x.drop for x in stack):
                largest = max(largest, (e.size, e.form))
            e.drop = True
        if e.drop:
            del out[e.at:]
            out.append(None)
        else:
            up = stack[-1]
            up.size += e.size
            up.linked += e.linked
            up.heads += e.heads
            up.cut = up.cut or e.cut
        if e.drop:
            pass
        elif e.main and mains == 0 and not any(x.drop for x in stack):
            best.extend(out[e.at:])
            best_size += e.size

    def text(piece: str) -> None:
        if piece:
            piece = _html.unescape(piece) if "&" in piece else piece
            out.append(piece)
            squeezed = " ".join(piece.split())
            if squeezed:
                stack[-1].parts.append(squeezed.encode("utf-8", "surrogatepass"))
                if opened["a"]:
                    stack[-1].linked += len(squeezed)
                else:
                    stack[-1].size += len(squeezed)

    pos, size, broken = 0, len(source), 0
    while pos < size:
        m = _TAG.search(source, pos)
        if m is None:
            text(source[pos:])
            break
        text(source[pos:m.start()])
        pos = m.end()
        if m[2] is None:  # comment, doctype or instruction
            continue
        tag, rest = m[2].lower(), m[3]
        if m.start(3) >= broken and not m[1] and ('"' in rest or "'" in rest):  # a > may be inside a value
            whole = _REST.match(source, m.start(3))
            if whole[1]:
                rest, pos = source[m.start(3):whole.start(1)], whole.end()
            else:  # read up to the first >, as are all tags begun before this place
                broken = whole.end()
        if m[1]:
            if tag == "br":
                out.append(" ")
            elif opened[tag]:
                while stack[-1].tag != tag:
                    close()
                close()
            continue
        if tag in _RAW and not rest.endswith("/"):
            end = re.compile(f"</{re.escape(tag)}(?=[\\s/>])[^>]*>", re.I).search(source, pos)
            pos = end.end() if end else size
            continue
        closes = (("p",) if tag in _BLOCK else ()) + _CLOSES.get(tag, ())
        if closes:
            depth = len(stack) - 1 if any(opened[c] for c in closes) else 0
            cut = 0
            while depth > 0:
                if stack[depth].tag in closes:
                    cut = depth
                elif stack[depth].tag in _SCOPE:
                    break
                depth -= 1
            while cut and len(stack) > cut:
                close()
        if tag in _BLOCK:
            out.append(None)
        if tag in _VOID:
            out.append(None if tag == "hr" else " " if tag == "br" else "")
            continue
        attrs = {}
        if rest and not rest.isspace():
            attrs = {k.lower(): (v or "").strip("\"'") for k, v in _ATTR.findall(rest)}
        main = tag in ("article", "main") or attrs.get("role") == "main"
        named, hint = _named(tag, attrs, mains > 0)
        drop = named or _boilerplate(tag, attrs, mains > 0)
        main = main and not drop
        mains += main
        form = 0
        if main:
            for x in stack:
                x.form = 0
        elif tag == "form" or attrs.get("role") == "form":
            forms += 1
            form = forms if forms != page_form else 0
        opened[tag] += 1
        stack.append(_Open(tag, attrs.get("class", "") + "\x00" + attrs.get("id", ""), len(out), drop, main, form, hint))
    while len(stack) > 1:
        close()
    blocks, line = [], []
    # text outside links decides: an empty main or a teaser is not the page's text
    chosen = best if 2 * best_size >= stack[0].size and any(x and not x.isspace() for x in best) else out
    for piece in chosen + [None]:
        if piece is not None:
            line.append(piece)
        elif line:
            block = _SPACE.sub(" ", "".join(line)).strip()
            line = []
            if block:
                blocks.append(block)
    return "\n\n".join(blocks), hashes, lost, stack[0].size, largest


def _bar(contents: Column, inside: Column) -> Column:
    def grown(least: int, start: int) -> Column:
        return least * (1 + F.log2(F.greatest(contents / start, F.lit(1.0))))

    return F.when(inside, grown(MIN_PAGES_INSIDE, FROM_INSIDE)).otherwise(grown(MIN_PAGES, FROM))


def site_templates(pages: DataFrame) -> DataFrame:
    """``host, templates, inner``: the subtree hashes to delete on each host. ``pages`` has
    ``_host`` and ``_text``; pages without a host share nothing."""
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in text_slices(batch, "_text"):
                seen: set[tuple] = set()
                for host, page in zip(part.column("_host").to_pylist(), part.column("_text").to_pylist()):
                    found: Counter = Counter()
                    main = parse(page, found=found)
                    content = int.from_bytes(blake2b(main.encode("utf-8", "surrogatepass"), digest_size=8).digest(), "little", signed=True)
                    seen.add((host, None, None, content))
                    seen.update((host, mark, inside, content) for mark, inside in found)
                yield pa.record_batch([pa.array(list(x), t) for x, t in zip(
                    zip(*seen) if seen else ([],) * 4, (pa.string(), pa.int64(), pa.bool_(), pa.int64()))],
                    names=["host", "mark", "inside", "content"])

    known = pages.where("_host <> ''")
    marks = known.select("_host", "_text").mapInArrow(count, "host string, mark long, inside boolean, content long")
    # a host's row without a mark counts its contents
    marks = marks.distinct().groupBy("host", "mark", "inside").agg(F.count(F.lit(1)).alias("n"))
    marks = stored(marks.where(F.col("mark").isNull() | (
        F.col("n") >= F.when(F.col("inside"), MIN_PAGES_INSIDE).otherwise(MIN_PAGES))), "html-marks")
    hosts = marks.where("mark is null").select("host", F.col("n").alias("contents"))
    often = marks.where("mark is not null").join(hosts, "host").where(
        F.col("n") >= _bar(F.col("contents"), F.col("inside")))
    return often.groupBy("host").agg(
        F.collect_list(F.when(~F.col("inside"), F.col("mark"))).alias("templates"),
        F.collect_list(F.when(F.col("inside"), F.col("mark"))).alias("inner"))


def extract(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """One row per page: ``id_col, url, text, n_chars``.

    Null and empty pages give an empty text. A page whose url is null or has no host
    shares templates with no other page. Repeated rows each get a row, and count once for
    their host; other columns are ignored; an empty table gives an empty result."""
    slim = pages.select(F.col(id_col).alias("_id"), F.col(url_col).cast("string").alias("_url"),
                        host_of(F.col(url_col)).alias("_host"),
                        F.coalesce(F.col(html_col).cast("string"), F.lit("")).alias("_text"))
    # written first, so that the planner knows the size and broadcasts it only if small
    templates = stored(site_templates(slim), "html-templates")
    wide = slim.join(templates, slim["_host"] == templates["host"], "left").select("_id", "_url", "_text", "templates", "inner")

    def strip(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in text_slices(batch, "_text"):
                known: dict[bytes, frozenset] = {}

                def hashes(value) -> frozenset:
                    marks = value.values
                    if marks is None:
                        return frozenset()
                    raw = np.asarray(marks.to_numpy(zero_copy_only=False), np.int64).tobytes()
                    if raw not in known:
                        known[raw] = frozenset(marks.to_pylist())
                    return known[raw]

                texts = [parse(page.as_py(), hashes(a), hashes(b)) for page, a, b in zip(
                    part.column("_text"), part.column("templates"), part.column("inner"))]
                yield pa.record_batch({"_id": part.column("_id"), "_url": part.column("_url"),
                                       "text": pa.array(texts, pa.string()),
                                       "n_chars": pa.array([len(t) for t in texts], pa.int64())})

    schema = wide.select("_id", "_url", F.lit("").alias("text"), F.lit(0).cast("long").alias("n_chars")).schema
    return wide.mapInArrow(strip, schema).select(F.col("_id").alias(id_col), F.col("_url").alias("url"), "text", "n_chars")
