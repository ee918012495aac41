"""Wikitext as flat node, link and cell rows. Pure Python."""

from __future__ import annotations

import html
import math
import re
import sys

from lorespark.functions import html_dom
from lorespark.functions.html_dom import Grid

_OPAQUE = re.compile(r"<!--.*?(?:-->|\Z)|<(nowiki|pre|source|syntaxhighlight)\b[^>]*>.*?</\1\s*>", re.S | re.I)
_HEADING = re.compile(r"(={1,6})\s*(.+?)\s*\1\s*\Z")
_LIST = re.compile(r"([*#:;]+)\s*(.*)", re.S)
_ATTR = re.compile(r"""([\w-]+)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'|]+))""")
_LINK = re.compile(r"\[\[((?:[^\[\]]|\[(?!\[)|\](?!\]))*)\]\]")
_FILE = re.compile(r"(?:file|image|文件|图像)$", re.I)
_CATEGORY = re.compile(r"(?:category|分类)$", re.I)
#: Containers may lie in one another as deep as a page has them.
sys.setrecursionlimit(max(sys.getrecursionlimit(), 20_000))
_NUMBER = r"\s*([+-]?(?:\d+\.?\d*|\.\d+))[^|]*"
# Fixed value: the line that stands for a map: file, title, width, height, and left,top pairs.
_MAP = re.compile(rf"\A\s*@@WIKIMAP\|([^|]*)\|([^|]*)\|{_NUMBER}\|{_NUMBER}\|([^|]*)(?:\|.*)?@@\s*\Z")
_CONTAINER = re.compile(r"<(div|center|section|blockquote|ul|ol|table)\b[^>]*>", re.I)
_VARIANT = re.compile(r"-\{([^{}]*)\}-")


def split_top(s: str, sep: str = "|") -> list[str]:
    """Parts at separators outside of links, calls and parameters."""
    out, depth, last, i = [], 0, 0, 0
    while i < len(s):
        two = s[i : i + 2]
        if two in ("[[", "{{"):
            depth, i = depth + 1, i + 2
            continue
        if two in ("]]", "}}"):
            depth, i = max(0, depth - 1), i + 2
            continue
        if s[i] == sep and not depth:
            out.append(s[last:i])
            last = i + 1
        i += 1
    return [*out, s[last:]]


def variants(s: str, wanted: tuple[str, ...] = ("zh-cn", "zh-hans")) -> str:
    """Language variant marks resolved: the first wanted one given, else the first."""

    def pick(m: re.Match) -> str:
        pairs = [p.partition(":") for p in m[1].split(";") if p.strip()]
        named = {k.strip().lower(): v.strip() for k, c, v in pairs if c}
        return next((named[w] for w in wanted if w in named), next(iter(named.values()), m[1].strip()))

    return _VARIANT.sub(pick, s)


def plain(s: str) -> str:
    """Inline text: link labels, no emphasis, tags or files; entities decoded."""
    s = _LINK.sub(lambda m: "" if link_row(m[1])["kind"] in ("file", "category", "interwiki") else link_row(m[1])["label"], s)
    s = re.sub(r"\[(?:https?:)?//\S+\s+([^\]]*)\]", r"\1", s)
    s = re.sub(r"'{2,5}|</?[A-Za-z][^<>]*>|\x00", "", s)
    return " ".join(html.unescape(s).split())


def link_row(inner: str) -> dict:
    """kind (file, category, property, interwiki, internal), target, fragment, label and file options of what stands in double brackets."""
    parts = split_top(inner)
    head, rest = parts[0].strip(), [p.strip() for p in parts[1:]]
    row = {"kind": "internal", "target": head, "fragment": "", "label": rest[-1] if rest and rest[-1] else head, "width": None, "height": None, "align": "", "link": ""}
    if "::" in head:
        prop, _, value = head.partition("::")
        return row | {"kind": "property", "target": value.strip(), "fragment": prop.strip(), "label": rest[0] if rest else value.strip()}
    ns, colon, name = head.partition(":")
    if colon and ns.strip() and _FILE.match(ns.strip()):
        row |= {"kind": "file", "target": name.strip(), "label": ""}
        for p in rest:
            if m := re.fullmatch(r"(\d*)(?:x(\d+))?px", p):
                row |= {"width": int(m[1]) if m[1] else None, "height": int(m[2]) if m[2] else None}
            elif p in ("left", "right", "center", "none"):
                row["align"] = p
            elif p.startswith("link="):
                row["link"] = p[5:]
            elif p not in ("thumb", "frame", "frameless", "border", "upright", "缩略图"):
                row["label"] = p
        return row
    if colon and _CATEGORY.match(ns.strip()):
        return row | {"kind": "category", "target": name.strip(), "label": ""}
    if colon and re.fullmatch(r"[a-z]{2}", ns.strip()):
        return row | {"kind": "interwiki", "label": ""}
    target, _, fragment = head.lstrip(":").partition("#")
    return row | {"target": target.strip(), "fragment": fragment.strip(), "label": rest[-1] if rest and rest[-1] else head.lstrip(":")}


def links(text: str) -> list[dict]:
    """All links outside of comments, nowiki and code, in order."""
    return [link_row(m[1]) for m in _LINK.finditer(_OPAQUE.sub("\x00", text))]


def attributes(s: str) -> dict[str, str]:
    return {m[1].lower(): m[2] or m[3] or m[4] or "" for m in _ATTR.finditer(s)}


def _cell(raw: str, header: bool) -> dict:
    parts = split_top(raw)
    attrs = attributes(parts[0]) if len(parts) > 1 and "[[" not in parts[0] else {}
    body = "|".join(parts[1:]) if attrs else raw
    number = lambda k: int(attrs[k]) if attrs.get(k, "").isdigit() and int(attrs[k]) > 0 else 1
    style = attrs.get("style", "")
    find = lambda rx, alt: (m[1] if (m := re.search(rx, style)) else attrs.get(alt, ""))
    width = re.match(r"([\d.]+)\s*%", find(r"(?:^|;|\s)width:\s*([^;]+)", "width"))
    sort = attrs.get("data-sort-value") or next(iter(re.findall(r'data-sort-value="([^"]*)"', body)), "")
    return {"colspan": number("colspan"), "rowspan": number("rowspan"), "is_header": header, "text": plain(body), "sort_value": sort, "align": find(r"text-align:\s*(\w+)", "align"), "bgcolor": find(r"background(?:-color)?:\s*([^;]+)", "bgcolor"), "width_pct": float(width[1]) if width else None}


def table_cells(text: str) -> list[dict]:
    """Cells of all tables, nested ones as tables of their own; columns spanned from above stay free."""
    out: list[dict] = []
    open_tables: list[dict] = []
    count = 0

    def close_cell(t: dict) -> None:
        if t["raw"] is not None:
            c = _cell("\n".join(t["raw"]), t["header"])
            if t["fresh"]:
                t["grid"].next_row()
                t["fresh"] = False
            out.append({"table_no": t["no"], "row_ix": t["grid"].row, "col_ix": t["grid"].place(c["colspan"], c["rowspan"]), **c})
            t["raw"] = None

    for line in _OPAQUE.sub("\x00", text).split("\n"):
        s = line.strip()
        t = open_tables[-1] if open_tables else None
        if s.startswith("{|"):
            open_tables.append({"no": count, "grid": Grid(), "raw": None, "header": False, "fresh": True})
            count += 1
        elif t is None:
            continue
        elif s.startswith("|}"):
            close_cell(t)
            open_tables.pop()
        elif s.startswith("|-"):
            close_cell(t)
            t["fresh"] = True
        elif s.startswith("|+"):
            close_cell(t)
        elif s.startswith(("|", "!")):
            header = s[0] == "!"
            for piece in re.split(r"\|\||!!" if header else r"\|\|", s[1:]):
                close_cell(t)
                t["raw"], t["header"] = [piece], header
        elif t["raw"] is not None:
            t["raw"].append(line)
    for t in reversed(open_tables):
        close_cell(t)
    return sorted(out, key=lambda c: (c["table_no"], c["row_ix"], c["col_ix"]))


def map_rows(line: str) -> dict | None:
    """Image, title, size and markers of a map line; None without an image, a height or a marker."""
    m = _MAP.match(line)
    if not m or not m[1].strip() or float(m[4]) <= 0:
        return None
    markers = [{"left": _float(a), "top": _float(b)} for a, b in (p.split(",") for p in m[5].split(";") if p.count(",") == 1)]
    return {"image": m[1].strip(), "title": m[2].strip(), "width": float(m[3]), "height": float(m[4]), "markers": markers} if markers else None


def _float(s: str) -> float:
    m = re.match(r"\s*([+-]?(?:\d+\.?\d*|\.\d+)(?:[eE][+-]?\d+)?)", s)
    return float(m[1]) if m else math.nan


def _html_rows(kind: str, raw: str) -> list[tuple[str, int, str]]:
    """(kind, level, text) of an HTML list or table within wikitext."""
    if kind == "table":
        return [("header_cell" if c["is_header"] else "cell", c["row_ix"], plain(c["text"])) for c in html_dom.table_cells(raw) if c["table_no"] == 0]
    return [("item", b["level"], plain(b["text"])) for b in html_dom.blocks(raw) if b["kind"] in ("bullet", "ordered")]


def nodes(text: str) -> list[dict]:
    """Block rows in pre-order: node_id, parent_id, depth, kind, level, text.

    Lists nest by their marks; lines of a paragraph join with a space; an item whose links or
    calls are still open goes on in the next line. HTML containers hold the nodes of their inner
    text, HTML lists and tables their items and cells; what follows the end tag goes on as text.
    """
    out: list[dict] = []
    newest: dict[int, int] = {}  # last child of a node

    def add(kind: str, parent: int = -1, level: int = 0, body: str = "") -> int:
        depth = 0 if parent < 0 else out[parent]["depth"] + 1
        out.append({"node_id": len(out), "parent_id": parent, "depth": depth, "kind": kind, "level": level, "text": body})
        newest[parent] = len(out) - 1
        return len(out) - 1

    held: list[str] = []
    text = _OPAQUE.sub(lambda m: (held.append(m[0]), f"\x00{len(held) - 1}\x00")[1], variants(text))
    lines = text.replace("\r\n", "\n").split("\n")
    lists: list[tuple[str, int]] = []  # open marks and their nodes
    para: list[str] = []

    def flush() -> None:
        if body := plain(re.sub(r"\x00\d+\x00", "", " ".join(para))):
            add("paragraph", body=body)
        for n in re.findall(r"\x00(\d+)\x00", " ".join(para)):
            raw = held[int(n)]
            if raw.lower().startswith(("<pre", "<source", "<syntax")):
                add("pre", body=re.sub(r"\A<[^>]*>|</\w+\s*>\Z", "", raw))
        para.clear()

    i = 0
    while i < len(lines):
        line = lines[i]
        i += 1
        if not line.startswith(("*", "#", ":", ";")):
            lists.clear()
        if not line.strip():
            flush()
            continue
        if m := _HEADING.match(line):
            flush()
            add("heading", level=len(m[1]), body=plain(m[2]))
        elif re.match(r"-{4,}\s*\Z", line):
            flush()
            add("rule")
        elif line.startswith("{|"):
            flush()
            depth, body = 1, [line]
            while i < len(lines) and depth:
                depth += lines[i].lstrip().startswith("{|") - lines[i].lstrip().startswith("|}")
                body.append(lines[i])
                i += 1
            table = add("table")
            for c in table_cells("\n".join(body)):
                if c["table_no"] == 0:
                    add("header_cell" if c["is_header"] else "cell", table, c["row_ix"], c["text"])
        elif re.match(r"<gallery\b", line, re.I):
            flush()
            gallery = add("gallery")
            while i < len(lines) and not re.match(r"\s*</gallery", lines[i], re.I):
                if lines[i].strip():
                    name, _, caption = lines[i].partition("|")
                    add("image", gallery, 0, name.strip().partition(":")[2].strip() or name.strip())
                i += 1
            i += 1
        elif m := _CONTAINER.match(line):
            flush()
            tag, depth, raw = m[1].lower(), 0, "\n".join([line, *lines[i:]])
            end = len(raw)
            for t in re.finditer(rf"<(/?){tag}\b[^>]*>", raw, re.I):
                depth += -1 if t[1] else 1
                if depth == 0:
                    end = t.end()
                    break
            block = re.sub(r"\x00(\d+)\x00", lambda h: held[int(h[1])], raw[:end])
            lines, i = raw[end:].split("\n"), 0
            if tag in ("ul", "ol", "table"):
                top = add({"ul": "bullet_list", "ol": "ordered_list"}.get(tag, "table"))
                for kind, level, body in _html_rows(tag, block):
                    add(kind, top, level, body)
            else:
                top = add("container")
                inner = re.sub(rf"\A<{tag}\b[^>]*>|</{tag}\s*>\Z", "", block, flags=re.I)
                base = len(out)
                for n in nodes(inner):
                    add(n["kind"], top if n["parent_id"] < 0 else base + n["parent_id"], n["level"], n["text"])
        elif map_rows(line):
            flush()
            add("map", body=map_rows(line)["title"])
        elif m := _LIST.match(line):
            flush()
            marks, body = m[1], m[2]
            while body.count("[[") > body.count("]]") or body.count("{{") > body.count("}}"):
                if i >= len(lines):
                    break
                body += " " + lines[i]
                i += 1
            while lists and not (marks.startswith(lists[-1][0])):
                lists.pop()
            for k in range(len(lists), len(marks)):
                parent = -1
                if lists:
                    parent = newest.get(lists[-1][1], lists[-1][1])
                kind = {"*": "bullet_list", "#": "ordered_list"}.get(marks[k], "definition_list")
                lists.append((marks[: k + 1], add(kind, parent, k + 1)))
            if marks[-1] == ";" and ":" in body:
                term, _, definition = body.partition(":")
                add("term", lists[-1][1], len(marks), plain(term))
                add("item", lists[-1][1], len(marks), plain(definition))
            else:
                add("term" if marks[-1] == ";" else "item", lists[-1][1], len(marks), plain(body))
        elif line.startswith(" ") and not para:
            flush()
            add("pre", body=line[1:])
        else:
            para.append(line)
    flush()
    return out


def footnotes(text: str) -> list[dict]:
    """Every <ref> in order: pos, name (null without), body."""
    found = re.finditer(r"<ref\b([^>/]*)(?:/>|>(.*?)</ref\s*>)", text, re.S | re.I)
    return [{"pos": i, "name": attributes(m[1]).get("name"), "body": plain(m[2] or "")} for i, m in enumerate(found)]
