"""Text of whole elements, by a walk with a stack of open elements.

Where an element ends depends on all tags before, which no pattern and no fold
over an immutable array tells in linear time.  So this one function runs in
Python, in Arrow batches, and only pages that mention the attribute are handed
over.  A page is read once: an end tag closes the innermost open element of its
name and all that was opened since; an end tag without one means nothing; what
is never closed ends with the page.
"""

from __future__ import annotations

import bisect
import html as html_lib
import re

import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import WS_CHARS

_ATTRS = r"""(?:[^>=]++|=[\s]*+(?:"[^"]*+"|'[^']*+')?+)*+"""
_RAW = rf"(?P<raw>script|style)(?=[\s/>]){_ATTRS}>.*?(?:</(?P=raw)(?=[\s/>])[^>]*+>|(?P<raw_open>\Z))"
_TOKEN = re.compile(
    rf"(?isa)<(?:!--.*?(?:-->|(?P<comment_open>\Z))|{_RAW}|(?P<end>/?)(?P<name>[a-z][^\s/>]*+){_ATTRS}>|[!?][^>]*+>)")
# Elements without content.
VOID = ("area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "source", "track", "wbr")
_STRUCT = pa.list_(pa.struct([("tag", pa.string()), ("text", pa.string())]))


def walk_elements(page: str, name: str, limit: int) -> list[tuple[str, str]]:
    """(start tag, text) of the elements whose tag mentions an attribute, in page order.

    The text is that of all stripped text nodes inside, joined, up to ``limit`` characters;
    text of a template is not visible.
    """
    nodes: list[str] = []
    upto = [0]                        # characters of the nodes before each
    found: list[list] = []            # tag, first node, node after the last
    stack: list[tuple[str, int]] = []
    open_: dict[str, int] = {}
    name, at = name.lower(), 0

    def add(raw: str) -> None:
        if open_.get("template"):
            return
        node = (html_lib.unescape(raw) if "&" in raw else raw).strip(WS_CHARS)
        if node:
            nodes.append(node)
            upto.append(upto[-1] + len(node))

    stop = page.rfind(">") + 1        # no tag starts after the last '>'
    for m in _TOKEN.finditer(page, 0, stop):
        if m.start() > at:
            add(page[at:m.start()])
        at = m.end()
        if m["comment_open"] is not None or m["raw_open"] is not None:
            at = len(page)
        tag = m["name"]
        if tag is None:
            continue
        tag = tag.lower()
        if m["end"]:
            if open_.get(tag):
                while True:
                    closed, own = stack.pop()
                    open_[closed] -= 1
                    if own >= 0:
                        found[own][2] = len(nodes)
                    if closed == tag:
                        break
            continue
        own = -1
        if name in m.group().lower():
            own = len(found)
            found.append([m.group(), len(nodes), len(nodes)])
        if tag not in VOID and not m.group().endswith("/>"):
            stack.append((tag, own))
            open_[tag] = open_.get(tag, 0) + 1
    if at < len(page):
        rest = page.find("<!--", max(at, stop))
        add(page[at:rest if rest >= 0 else None])
    for _, own in stack:
        if own >= 0:
            found[own][2] = len(nodes)
    out = []
    for tag, first, after in found:
        last = min(after, bisect.bisect_left(upto, upto[first] + limit, first))
        out.append((tag, "".join(nodes[first:last])[:limit]))
    return out


def elements_with_attr(html: Column, name: str, limit: int = 200) -> Column:
    """array<struct(tag, text)> of the elements whose start tag mentions the attribute ``name``.

    ``html`` must be a column of the table, not a lambda variable.
    """
    @F.arrow_udf("array<struct<tag: string, text: string>>")
    def of(pages: pa.Array) -> pa.Array:
        rows = [None if p is None else [{"tag": t, "text": x} for t, x in walk_elements(p, name, limit)]
                for p in pages.to_pylist()]
        return pa.array(rows, _STRUCT)

    mentions = F.contains(F.lower(html), F.lit(name.lower()))
    return F.coalesce(of(F.when(mentions, html)), F.array().cast("array<struct<tag:string,text:string>>"))
