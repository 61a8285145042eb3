"""Main text of web pages by wrapper inference per host.

A page is a stream of structural tags and texts. The streams of a host are aligned one after the other into a union-free regular
expression: below every element each label occurs once; a label that some page lacks becomes optional, a label that
follows itself a repeated one, labels that come in different orders a repeated group of optional members, and texts that
differ a slot. Merging is associative, so every task folds its pages and the few expressions per host are merged.

Extraction walks a page along its host's wrapper. Boilerplate elements are no content, whatever the page, but a class or id alone
does not drop an article; if the wrapper has an article, only that is content; without one, texts that are the same on all pages of
the host, at least DISTINCT of them with different content, are the template's and go.
"""

from __future__ import annotations

import json
import re
from collections import Counter
from collections.abc import Iterable, Iterator
from hashlib import blake2b
from html import unescape
from zlib import crc32

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabeval.llm.frames import arrow_map, picked, written
from tabeval.llm.urlfilter import host_of

# fixed values: element and attribute names of HTML
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
INLINE = frozenset("a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark nobr q rp rt ruby s samp small span strike strong sub sup time tt u var br wbr img".split())
RAW = frozenset("script style noscript iframe template svg math textarea title xmp noframes object canvas audio video".split())
CLOSES_P = frozenset("address article aside blockquote center details dialog dir div dl dt dd fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hr li main menu nav ol p pre section table tbody td th tr ul".split())
SIBLINGS = {"li": ("li", ("ul", "ol", "menu")), "dt": ("dt dd", ("dl",)), "dd": ("dt dd", ("dl",)), "tr": ("tr td th", ("table",)), "td": ("td th", ("tr", "table")), "th": ("td th", ("tr", "table")), "option": ("option", ("select",))}
BOILERPLATE_TAGS = frozenset("head nav footer aside form button select fieldset dialog menu input".split()) | RAW
BOILERPLATE_NAMES = frozenset(
    """ad ads adv advert adverts advertisement advertising adsense adslot adbox banner banners breadcrumb breadcrumbs comment comments
    commentlist consent cookie cookies disclaimer disqus footer gdpr header hidden masthead menu menus modal nav navbar navigation
    newsletter notice notices overlay pager pagination paywall popup promo promotion recommended related replies reply responses share
    sharing sidebar sidebars signup skip social sponsor sponsored subscribe subscription toolbar topbar widget widgets""".split()
)
OTHERS_NAMES = frozenset("comment comments commentlist disqus recommended related replies reply responses".split())  # they hold articles that are not the page's
BOILERPLATE_ROLES = frozenset("navigation banner contentinfo complementary search dialog alert alertdialog menu menubar toolbar".split())
MAIN = ("article", "main")
DEPTH = 80  # deeper elements have no place of their own in a wrapper: their parts belong to the element at this depth
DISTINCT = 3  # pages of different content that must have a text before it is the template's

TOKEN = re.compile(r"""<!--|<[!?][^>]*+>?|</([a-zA-Z][^\s/>]*+)[^>]*+>?|<([a-zA-Z][^\s/>]*+)((?:[^>"']++|"[^"]*+"|'[^']*+')*+)(>|(?=["'])[^>]*+>?|$)""")
ATTRIBUTE = re.compile(r"""([^\s=/"'>]+)(?:\s*=\s*("[^"]*"|'[^']*'|[^\s>]+))?""")


def attributes(text: str) -> dict[str, str]:
    return {name.lower(): unescape(value.strip("\"'")) for name, value in ATTRIBUTE.findall(text)} if text else {}


def is_boilerplate(tag: str, attrs: dict[str, str], inside_main: bool) -> bool:
    """Whether an element is boilerplate by its tag, role or style, whatever it holds."""
    if tag in BOILERPLATE_TAGS or tag == "header" and not inside_main:
        return True
    if not attrs or tag in ("html", "body"):
        return False
    if "hidden" in attrs or attrs.get("aria-hidden") == "true" or attrs.get("role", "").lower() in BOILERPLATE_ROLES:
        return True
    return bool(re.search(r"display\s*:\s*none", attrs.get("style", "").lower()))


def boilerplate_names(tag: str, attrs: dict[str, str], inside_main: bool) -> set[str]:
    """The whole class tokens and the id that name boilerplate; parts of them (has-sidebar, widget-text) name nothing."""
    if not attrs or tag in ("html", "body"):
        return set()
    names = BOILERPLATE_NAMES.intersection(f"{attrs.get('class', '')} {attrs.get('id', '')}".lower().split())
    return names & OTHERS_NAMES if tag in MAIN else names - {"header"} if inside_main else names


class Element:
    """A structural element: label, whether it is boilerplate, and its texts and elements in page order.

    ``named`` tells that it is boilerplate by its names only, ``others`` that these stand for other people's articles, ``holds``
    that it is or has an article or main, ``deep`` that its parts are read as its parent's.
    """

    __slots__ = ("tag", "label", "skip", "inline", "parts", "named", "others", "holds", "deep")

    def __init__(self, tag: str, label: str, skip: bool, inline: bool = False, names: Iterable[str] = (), deep: bool = False):
        self.tag, self.label, self.skip, self.inline, self.parts, self.deep = tag, label, skip or bool(names), inline, [], deep
        self.named, self.others, self.holds = bool(names) and not skip, not OTHERS_NAMES.isdisjoint(names), False


def parse(html: str) -> Element:
    """The tree of structural elements; inline elements dissolve into the text around them."""
    root = Element("", "", False)
    stack, at, mains, inlines = [root], 0, 0, 0
    open_tags: Counter[str] = Counter()
    skipped: list[Element] = []  # the open ones
    named: list[Element] = []  # all of them
    own = False  # whether there is an article or main of the page itself

    def push(element: Element) -> None:
        nonlocal mains, inlines, own
        stack.append(element)
        open_tags[element.tag] += 1
        inlines += element.inline
        if element.skip:
            skipped.append(element)
            if element.named:
                named.append(element)
        if element.tag in MAIN:
            mains += 1
            if all(e.named for e in skipped):
                own = own or not any(e.others for e in skipped)
                for e in skipped:
                    e.holds = True

    def close(count: int) -> None:
        nonlocal mains, inlines
        for element in stack[: len(stack) - count - 1 : -1]:
            open_tags[element.tag] -= 1
            mains -= element.tag in MAIN
            inlines -= element.inline
            if element.skip:
                skipped.pop()
        del stack[len(stack) - count :]

    def close_up_to(tags: Iterable[str], stop: Iterable[str]) -> None:
        if not any(open_tags[t] for t in tags):
            return
        for back in range(1, len(stack)):
            if stack[-back].tag in tags:
                close(back)
                return
            if stack[-back].tag in stop:
                return

    while (found := TOKEN.search(html, at)) is not None:
        if found.start() > at:
            stack[-1].parts.append(html[at : found.start()])
        at = found.end()
        end, tag = found.group(1), found.group(2)
        if end:
            end = end.lower()
            if end == "br":
                stack[-1].parts.append(" ")
            elif open_tags[end] and (end == "p" or end not in INLINE or inlines):
                for back in range(1, len(stack)):
                    if stack[-back].tag == end:
                        close(back)
                        break
        elif tag:
            tag = tag.lower()
            attrs = attributes(found.group(3)) if found.group(3).strip() else {}
            if tag in RAW:
                stop = re.compile(f"</{re.escape(tag)}\\s*>", re.I).search(html, at)
                at = stop.end() if stop else len(html)
                if tag not in ("script", "style", "title"):
                    stack[-1].parts.append(" ")
                continue
            skip, names = is_boilerplate(tag, attrs, mains > 0), boilerplate_names(tag, attrs, mains > 0)
            if tag in INLINE:
                if tag == "br":
                    stack[-1].parts.append(" ")
                elif (skip or names) and tag not in VOID:
                    hidden = Element(tag, f"{tag}!", skip, True, names, len(stack) >= DEPTH)
                    stack[-1].parts.append(hidden)
                    push(hidden)
                continue
            if tag in CLOSES_P:
                close_up_to(("p",), ("article", "section", "div", "td", "li", "body", "main", "aside", "nav", "footer", "header", "table", "form"))
            if tag in SIBLINGS:
                before, stop_at = SIBLINGS[tag]
                close_up_to(before.split(), stop_at)
            name = re.sub(r"\d+", "0", attrs.get("class", "").strip().split(" ")[0])
            # the outermost article has a place of its own at any depth
            element = Element(tag, f"{tag}.{name}" if name else tag, skip, False, names, len(stack) >= DEPTH and (mains > 0 or tag not in MAIN))
            stack[-1].parts.append(element)
            if tag not in VOID and found.group(3).rstrip()[-1:] != "/" or tag in MAIN:
                push(element)
        elif found.group(0) == "<!--":
            stop = html.find("-->", at)
            at = stop + 3 if stop >= 0 else len(html)
    if at < len(html):
        stack[-1].parts.append(html[at:])
    for element in named:  # names alone do not drop an article, unless they stand for others' articles beside the page's own
        if element.holds and not (element.others and own):
            element.skip = element.inline = False
    return root


def squeeze(text: str) -> str:
    return " ".join(unescape(text).split())


def blocks(element: Element) -> Iterator[str | Element]:
    """The texts of an element between its block children, and these children, in page order; deep children dissolve."""
    text, todo = "", [iter(element.parts)]
    while todo:
        for part in todo[-1]:
            if isinstance(part, str):
                text += part
            elif not part.inline:
                if text := squeeze(text):
                    yield text
                text = ""
                if part.deep and not part.skip:
                    todo.append(iter(part.parts))
                    break
                yield part
        else:
            todo.pop()
            if text := squeeze(text):  # the end of a deep child ends a text too
                yield text
            text = ""


# ---- wrappers: {"pages": digests of up to DISTINCT different contents, "opt", "rep", "text": None | digest | "*", "kids": {label: wrapper}, "order": [[label, ...], ...]} ----


def digest(texts: list[str]) -> str | None:
    return blake2b("\n".join(texts).encode("utf-8", "surrogatepass"), digest_size=8).hexdigest() if texts else None


def wrapper_of(page: Element) -> dict:
    """The expression of one page."""
    pages: list[str] = []  # shared by all parts of the expression, known when the page has been read
    content: list[str] = []

    def expression(element: Element) -> dict:
        kids: dict[str, dict] = {}
        sequence, texts = [], []
        for part in blocks(element):
            if isinstance(part, str):
                texts.append(part)
                content.append(part)
                continue
            if part.skip:
                own = {"pages": pages, "opt": False, "rep": False, "skip": True, "text": None, "kids": {}, "order": []}
            else:
                content.append(f"<{part.label}>")
                own = expression(part)
                content.append("</>")
            if part.label in kids:
                kids[part.label] = merge(kids[part.label], own) | {"rep": True}
            else:
                kids[part.label] = own
            if not sequence or sequence[-1] != part.label:
                sequence.append(part.label)
        return {"pages": pages, "opt": False, "rep": False, "skip": element.skip, "text": digest(texts), "kids": kids, "order": ordered([[[label] for label in sequence]])}

    whole = expression(page)
    pages.append(digest(content) or "")
    return whole


def ordered(streams: list[list[list[str]]]) -> list[list[str]]:
    """One sequence of groups for several: labels whose order differs share a group (a strongly connected part), groups are in order."""
    after: dict[str, set] = {}
    seen: list[str] = []
    for stream in streams:
        for i, group in enumerate(stream):
            for label in group:
                if label not in after:
                    after[label] = set()
                    seen.append(label)
                after[label].update(x for x in group if x != label)  # a group is a cycle
            if i:
                after[stream[i - 1][0]].add(group[0])
    reach: dict[str, set] = {}
    for label in seen:
        found, todo = set(), [label]
        while todo:
            for other in after[todo.pop()]:
                if other not in found:
                    found.add(other)
                    todo.append(other)
        reach[label] = found
    groups: list[list[str]] = []
    for label in seen:
        for group in groups:
            if label in reach[group[0]] and group[0] in reach[label]:
                group.append(label)
                break
        else:
            groups.append([label])
    out: list[list[str]] = []
    while groups:  # first the group that no other open group leads to
        pick = next(g for g in groups if not any(g[0] in reach[o[0]] for o in groups if o is not g))
        groups.remove(pick)
        out.append(sorted(pick) if len(pick) > 1 else pick)
    return out


def merge(a: dict, b: dict) -> dict:
    """The alignment of two expressions of one element."""
    kids = {}
    for label in [*a["kids"], *[k for k in b["kids"] if k not in a["kids"]]]:
        x, y = a["kids"].get(label), b["kids"].get(label)
        kids[label] = merge(x, y) if x and y else (x or y) | {"opt": True}
    same = a["text"] == b["text"] and a["text"] != "*"
    return {
        "pages": a["pages"] if a["pages"] == b["pages"] else sorted({*a["pages"], *b["pages"]})[:DISTINCT], "opt": a["opt"] or b["opt"], "rep": a["rep"] or b["rep"], "skip": a["skip"] and b["skip"],
        "text": a["text"] if same else "*", "kids": kids, "order": ordered([a["order"], b["order"]]) if a["order"] != b["order"] else a["order"],
    }


def pattern(wrapper: dict, label: str = "") -> str:
    """The expression in writing: # is a text slot, ? an optional and + a repeated part."""
    inner = "#" if wrapper["text"] == "*" else "text" if wrapper["text"] else ""
    for group in wrapper["order"]:
        members = [pattern(wrapper["kids"][k], k) for k in group]
        inner += members[0] if len(group) == 1 else "(" + "".join(m if m.endswith("?") else f"({m})?" for m in members) + ")+"
    out = f"<{label}>{inner}</{label.partition('.')[0]}>" if label else inner
    if wrapper["rep"]:
        out = f"({out})+"
    return f"({out})?" if wrapper["opt"] else out


def main_labels(wrapper: dict) -> bool:
    """Whether the wrapper has an article or main element that is no boilerplate."""
    return any(not kid["skip"] and (label.partition(".")[0] in MAIN or main_labels(kid)) for label, kid in wrapper["kids"].items())


def main_text(page: Element, wrapper: dict) -> str:
    """The content slots of a page along its host's wrapper."""
    out: list[str] = []
    marked = main_labels(wrapper)

    def has_main(element: Element) -> bool:
        todo = [element]
        while todo:
            for part in todo.pop().parts:
                if not isinstance(part, str) and not part.skip:
                    if part.tag in MAIN:
                        return True
                    todo.append(part)
        return False

    marked = marked and has_main(page)  # a page without the optional article falls back to its body

    def walk(element: Element, slot: dict | None, inside: bool) -> None:
        fixed = not marked and slot is not None and slot["text"] not in (None, "*") and len(slot["pages"]) == DISTINCT
        for part in blocks(element):
            if isinstance(part, str):
                if inside and not fixed:
                    out.append(part)
            elif not part.skip:
                walk(part, slot["kids"].get(part.label) if slot else None, inside or part.tag in MAIN)

    walk(page, wrapper, not marked)
    return " ".join(out)


def fold(wrappers: Iterable[dict]) -> dict | None:
    whole = None
    for own in wrappers:
        whole = own if whole is None else merge(whole, own)
    return whole


def infer_wrappers(pages: DataFrame) -> DataFrame:
    """(host, wrapper as JSON) from (host, html): folded per batch, then per host and salt, then per host."""

    def partial(batch: pa.RecordBatch) -> Iterator[dict]:
        folded: dict[str, dict] = {}
        for host, html in zip(batch.column("host").to_pylist(), batch.column("html").to_pylist()):
            own = wrapper_of(parse(html or ""))
            folded[host] = merge(folded[host], own) if host in folded else own
        yield {"host": list(folded), "salt": [crc32(json.dumps(w, sort_keys=True).encode()) % 16 for w in folded.values()], "wrapper": [json.dumps(w) for w in folded.values()]}

    def together(rows: pd.DataFrame) -> pd.DataFrame:
        whole = fold(json.loads(w) for w in sorted(rows["wrapper"]))
        return pd.DataFrame({"host": [rows["host"].iloc[0]], "wrapper": [json.dumps(whole)]})

    parts = arrow_map(pages, partial, "host string, salt int, wrapper string")
    once = parts.groupBy("host", "salt").applyInPandas(together, "host string, wrapper string")
    return once.groupBy("host").applyInPandas(together, "host string, wrapper string")


def extract_text(pages: DataFrame, key: str = "page_id", url: str = "url", html: str = "html") -> DataFrame:
    """One row per page: key, url, text (blocks of the main content joined by one space) and n_chars (code points).

    Defined cases: null or empty html gives an empty text; pages without a host form one group; a host with a single page
    has that page as its wrapper; copies of a page count once, whatever their number; unclosed elements, comments and quotes end with the page; null keys and repeated rows
    are extracted like any other; an empty table gives no rows.
    """
    source = picked(pages, page_id=key, _url=url, html=html).withColumn("host", host_of(F.col("_url")))
    wrappers = written(infer_wrappers(source.select("host", "html")), "wrappers")

    def step(batch: pa.RecordBatch) -> Iterator[dict]:
        known: dict[str, dict] = {}
        texts = []
        for raw, html in zip(batch.column("wrapper").to_pylist(), batch.column("html").to_pylist()):
            if raw not in known:
                known.clear() if len(known) > 1000 else None
                known[raw] = json.loads(raw)
            texts.append(main_text(parse(html or ""), known[raw]))
        yield {"page_id": batch.column("page_id"), "_url": batch.column("_url"), "text": texts}

    kinds = dict(source.dtypes)
    out = arrow_map(source.join(wrappers, "host").select("page_id", "_url", "html", "wrapper"), step, f"page_id {kinds['page_id']}, _url string, text string")
    return out.select(F.col("page_id").alias(key), F.col("_url").alias(url), "text", F.length("text").cast("bigint").alias("n_chars"))
