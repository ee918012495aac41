"""Mixed markup as a tree of nodes. Pure Python.

Headings open sections that hold what follows, sections nest by level, items lie in lists and inner
lists in items, tables have rows and cells, HTML containers hold what stands between their tags,
formulas lie in the block that shows them, and whatever looks like markup inside comments, nowiki
and code blocks lies under those. Which nodes are content is not decided here but by the model
over the tree.
"""

from __future__ import annotations

import html
import re

from lorespark.functions.markup import OPAQUE

KINDS = ["root", "para", "heading", "list", "item", "code", "formula", "comment", "nowiki", "template", "meta", "table", "gallery", "file", "section", "row", "cell", "box", "script"]
ROOT, PARA, HEADING, LIST, ITEM, CODE, FORMULA, COMMENT, NOWIKI, TEMPLATE, META, TABLE, GALLERY, FILE, SECTION, ROW, CELL, BOX, SCRIPT = range(len(KINDS))

_MATH = re.compile(
    r"<math\b[^>]*>(.*?)</math\s*>"
    r"|\$\$(.+?)\$\$"
    r"|\\\[(.+?)\\\]"
    r"|\\\((.+?)\\\)"
    r"|\\begin\{((?:equation|align|gather|multline|eqnarray|displaymath|math)\*?)\}(.+?)\\end\{\5\}"
    r"|(?<![\\$\w])\$(?![\s$])([^$\n]*?[^\s\\$])\$(?![\d$])",
    re.S | re.I,
)
_BLANK = re.compile(r"\n[^\S\n]*\n\s*")
_WIKI_HEADING = re.compile(r"(={1,6})(.+?)\1\s*\Z")
_ATX = re.compile(r" {0,3}(#{2,6})[ \t]+(.*?)(?:[ \t]#+)?\s*\Z")
_UNDERLINE = re.compile(r"(?:={2,}|-{2,})\s*\Z")
_WIKI_ITEM = re.compile(r"[:;]*[*#][*#:;]*[ \t]*(?=\S)")
_STARTS_EMPHASIS = re.compile(r"(\*{1,3})[^\s*][^*\n]*\1")
_MD_ITEM = re.compile(r"[ \t]*(?:[-+*]|\d{1,9}[.)])[ \t]+(?=\S)")
_HTML_PART = re.compile(r"<h([1-6])\b[^>]*>(.*?)</h\1\s*>|<li\b[^>]*>(.*?)(?=<li\b|</li\s*>|</?[uo]l\b|\Z)|<(/?)([uo])l\b[^>]*>", re.S | re.I)
_TEX_PART = re.compile(r"\\(?P<rank>(?:sub)*section|chapter|part|(?:sub)?paragraph)\*?[ \t]*(?:\[[^\]]*\])?\{((?:[^{}]|\{(?:[^{}]|\{[^{}]*\})*\})*)\}|\\item\b[ \t]*(?:\[[^\]]*\])?(.*?)(?=\\item\b|\\end\{|\\begin\{|\Z)|\\(?P<edge>begin|end)\{(?P<list>itemize|enumerate|description)\}(?:\[[^\]]*\])?", re.S)
_TEX_RANKS = {"part": 1, "chapter": 1, "section": 2, "subsection": 3, "subsubsection": 4, "paragraph": 5, "subparagraph": 6}
_CONTAINER = re.compile(r"<(/?)(div|nav|aside|footer|header|form|section|article|main|center|blockquote|table|caption|thead|tbody|tfoot|tr|td|th|script|style)\b([^<>]*)>", re.I)
_ENDS = {"tr": {"td", "th", "tr"}, "td": {"td", "th"}, "th": {"td", "th"}}
_META = re.compile(r"\[\[\s*(?:category|分类|[a-z]{2})\s*:", re.I)
_FILE = re.compile(r"\[\[\s*(?:file|image|文件)\s*:", re.I)
_CODE_HEAD = re.compile(r"\A(?:<[^>]*>\s*(?:<code\b[^>]*>)?|[ \t]*(?:```|~~~)[^\n]*\n|\\begin\{\w+\*?\}(?:\[[^\]]*\])?)", re.I)
_CODE_TAIL = re.compile(r"(?:(?:</code\s*>\s*)?</\w+\s*>|[ \t]*(?:```|~~~)[`~]*\s*|\\end\{\w+\*?\})\Z", re.I)

_MARKED = re.compile(r"[\[\]{}<>&\\*_'`\x00\x01]")
_WIKI_LINK = re.compile(r"\[\[([^\[\]|]*)(?:\|([^\[\]]*))?\]\]")
_MD_LINK = re.compile(r"!?\[([^\[\]]*)\]\(([^()\s]*)[^()]*\)")
_WEB_LINK = re.compile(r"\[(?:https?:)?//(\S+?)(?:\s+([^\]]*))?\]")
_TEX_LINK = re.compile(r"\\href\{((?:\\.|[^{}\\])*)\}\{((?:[^{}]|\{[^{}]*\})*)\}")
_TEX_STYLE = re.compile(r"\\(?:text\w\w|emph|underline|textsc|texttt|mathrm)\{((?:[^{}]|\{[^{}]*\})*)\}")
_STAR = re.compile(r"(\*{1,3})(?=\S)([^*\n]*?\S)\1")
_SCORE = re.compile(r"(?<!\w)(_{1,3})(?=\S)([^\n]*?\S)\1(?!\w)")
_TICK = re.compile(r"`+([^`\n]+)`+")
_BREAK = re.compile(r"<br\b[^>]*>", re.I)
_TAG = re.compile(r"</?[A-Za-z][^<>]*>")
_TEX_ESCAPE = re.compile(r"\\([&%#$_{}])")
_HELD = re.compile(r"\x01(\d+)\x01")
_CALL = re.compile(r"\{\{(?:[^{}]|\{\{(?:[^{}]|\{\{\{?[^{}]*\}?\}\})*\}\}|\{\{\{[^{}]*\}\}\})*\}\}")
_TEX_FRAME = re.compile(r"\\(?:begin|end)\{\w+\*?\}(?:\[[^\]]*\])?")
_CELL_MARK = re.compile(r"^\s*(?:\|\+|[|!])[ \t]*(?:[\w-]+\s*=\s*\S+[^|\[\n]*\|(?!\|))?", re.M)


def one_line(s: str) -> str:
    return " ".join(s.split())


def clean(s: str, held: list[str], drop_calls: bool = False) -> str:
    """Text without markup: links as their label, else their target; entities and escapes decoded."""
    if not _MARKED.search(s):
        return one_line(s)
    s = s.replace("\x00", " ")
    if "[" in s:
        s = _WIKI_LINK.sub(lambda m: m[2] if m[2] and m[2].strip() else m[1], s)
        s = _MD_LINK.sub(lambda m: m[1] if m[1].strip() else m[2], s)
        s = _WEB_LINK.sub(lambda m: m[2] or m[1], s)
    if "\\" in s:
        s = _TEX_LINK.sub(lambda m: m[2] if m[2].strip() else m[1], s)
        before = None
        while before != s:
            before, s = s, _TEX_STYLE.sub(r"\1", s)
    if drop_calls:
        s = _TEX_FRAME.sub(" ", _CALL.sub(" ", s))
    if "<" in s:
        s = _TAG.sub("", _BREAK.sub(" ", s))
    if "''" in s:
        s = re.sub("'{2,5}", "", s)
    if "*" in s:
        s = _STAR.sub(r"\2", s)
    if "_" in s:
        s = _SCORE.sub(r"\2", s)
    if "`" in s:
        s = _TICK.sub(r"\1", s)
    if "\\" in s:
        s = _TEX_ESCAPE.sub(r"\1", s)
    if "&" in s:
        s = html.unescape(s)
    if "\x01" in s:
        s = _HELD.sub(lambda m: held[int(m[1])], s)
    return one_line(s)


def wiki_cells(raw: str) -> list[list[str]]:
    """The cells of a wiki table, row by row, as they stand."""
    body = re.sub(r"^\s*\{\|[^\n]*|^\s*\|\}", "", raw, flags=re.M)
    return [[c for c in re.split(r"\|\||!!|\n", _CELL_MARK.sub("", row)) if c.strip()] for row in re.split(r"^\s*\|-[^\n]*$", body, flags=re.M)]


class Tree:
    """Kind, parent (index into the page's nodes), raw text, place (for reading order) and level of each node.

    The level is that of a heading, or the depth of a list item, negative in numbered lists.
    """

    __slots__ = ("kinds", "parents", "raw", "held", "place", "now", "level", "formulas", "sections", "opaque", "lists")

    def __init__(self) -> None:
        self.kinds: list[int] = [ROOT]
        self.parents: list[int] = [0]
        self.raw: list[str] = [""]
        self.held: list[str] = []
        self.formulas: list[int] = []  # their nodes, in the order of `held`
        self.place: list[float] = [-1.0]
        self.level: list[int] = [0]
        self.now = 0.0
        self.sections: dict[int, list[tuple[int, int]]] = {}  # open ones of each container: (level, node)
        self.opaque: list[int] = []  # nodes of the placeholders that are still to come
        self.lists: list[tuple[bool, int, int]] = []  # open HTML and LaTeX lists: (numbered, node, last item)

    def add(self, kind: int, parent: int, raw: str, level: int = 0) -> int:
        self.kinds.append(kind)
        self.parents.append(parent)
        self.raw.append(raw)
        self.place.append(self.now)
        self.level.append(level)
        node = len(self.kinds) - 1
        if "\x01" in raw:
            for m in _HELD.finditer(raw):
                self.parents[self.formulas[int(m[1])]] = node
        return node

    def home(self, container: int) -> int:
        """Where a block of a container belongs: its innermost open section, or itself."""
        open_ = self.sections.get(container)
        return open_[-1][1] if open_ else container

    def heading(self, container: int, level: int, raw: str) -> None:
        open_ = self.sections.setdefault(container, [])
        while open_ and open_[-1][0] >= level:
            open_.pop()
        open_.append((level, self.add(SECTION, self.home(container), "")))
        self.add(HEADING, open_[-1][1], raw, level)

    def label(self, i: int) -> str:
        """The label of a heading, item, code block or formula."""
        kind, raw = self.kinds[i], self.raw[i]
        if kind == FORMULA:
            return one_line(raw)
        if kind == CODE:
            return next((one_line(x) for x in code_body(raw).split("\n") if x.strip()), "")
        return clean(raw, self.held)


def code_body(raw: str) -> str:
    body = _CODE_TAIL.sub("", _CODE_HEAD.sub("", raw, count=1), count=1)
    return html.unescape(body) if raw[:4].lower() == "<pre" else body


def _tagged_item(tree: Tree, container: int, raw: str) -> None:
    """An item of the innermost open HTML or LaTeX list, or of a new one."""
    if not tree.lists:
        tree.lists.append((False, tree.add(LIST, tree.home(container), ""), 0))
    numbered, node, _ = tree.lists[-1]
    item = tree.add(ITEM, node, raw, -len(tree.lists) if numbered else len(tree.lists))
    tree.lists[-1] = (numbered, node, item)


def _tagged_list(tree: Tree, container: int, numbered: bool) -> None:
    outer = tree.lists[-1][2] or tree.lists[-1][1] if tree.lists else tree.home(container)
    tree.lists.append((numbered, tree.add(LIST, outer, ""), 0))


def _blocks(tree: Tree, container: int, text: str) -> None:
    """Adds the nodes of `text`, in which formulas and opaque regions are placeholders."""
    for chunk in _BLANK.split(text):
        if not chunk.strip():
            continue
        tree.now += 1
        here = chunk.count("\x00")
        if here and tree.opaque:
            for node in tree.opaque[:here]:
                tree.place[node] = tree.now - 0.5 if chunk.lstrip()[0] == "\x00" else tree.now + 0.5
                tree.parents[node] = tree.home(container)
            del tree.opaque[:here]
        lines = chunk.split("\n")
        rest: list[str] = []
        grown: list[tuple[tuple[bool, int], int, int]] = []  # open lists of this chunk: (kind and depth, node, last item)
        under = len(lines) > 1 and ("\n==" in chunk or "\n--" in chunk)
        skip = False

        def item(mark: bool, depth: int, numbered: bool, raw: str) -> None:
            while grown and (grown[-1][0][0] != mark or grown[-1][0][1] > depth):
                grown.pop()
            if not grown or grown[-1][0][1] < depth:
                grown.append(((mark, depth), tree.add(LIST, grown[-1][2] if grown else tree.home(container), ""), 0))
            key, node, _ = grown[-1]
            grown[-1] = (key, node, tree.add(ITEM, node, raw, -len(grown) if numbered else len(grown)))

        for k, line in enumerate(lines):
            if skip:
                skip = False
                continue
            c = line[:1]
            if under and k + 1 < len(lines) and line.strip() and _UNDERLINE.match(lines[k + 1]) and not line.startswith(("=", "|", "{|")):
                tree.heading(container, 1 if lines[k + 1][0] == "=" else 2, line)
                grown, skip = [], True
                continue
            if c == "=":
                m = _WIKI_HEADING.match(line)
                if m and m[2].strip(" =\t\r"):
                    tree.heading(container, len(m[1]), m[2])
                    grown = []
                    continue
            elif c == "#" and (m := _ATX.match(line)) and m[2].strip():
                tree.heading(container, len(m[1]), m[2])
                grown = []
                continue
            elif c in "*#:;" and c:
                m = _WIKI_ITEM.match(line)
                if m and (m[0][-1] in " \t" or not _STARTS_EMPHASIS.match(line)):
                    marks = m[0].rstrip(" \t")
                    item(True, len(marks), marks[-1] == "#", line[m.end() :])
                    continue
            if c in " \t-+0123456789*" and c and (m := _MD_ITEM.match(line)):
                item(False, len(line) - len(line.lstrip(" \t")), line.lstrip(" \t")[0].isdigit(), line[m.end() :])
                continue
            if c == " " and (m := _ATX.match(line)) and m[2].strip():
                tree.heading(container, len(m[1]), m[2])
                continue
            rest.append(line)
        if not rest:
            continue
        left = "\n".join(rest)
        if "<" in left:
            at, kept = 0, []
            for m in _HTML_PART.finditer(left):
                kept.append(left[at : m.start()])
                at = m.end()
                if m[1]:
                    tree.heading(container, int(m[1]), m[2])
                    tree.lists.clear()
                elif m[5]:
                    if not m[4]:
                        _tagged_list(tree, container, m[5] in "oO")
                    elif tree.lists:
                        tree.lists.pop()
                elif m[3].strip():
                    _tagged_item(tree, container, m[3])
            left = "".join(kept) + left[at:]
        if "\\" in left:
            at, kept = 0, []
            for m in _TEX_PART.finditer(left):
                kept.append(left[at : m.start()])
                at = m.end()
                if m["rank"]:
                    tree.heading(container, _TEX_RANKS.get(m["rank"], 6), m[2])
                    tree.lists.clear()
                elif m["edge"]:
                    if m["edge"] == "begin":
                        _tagged_list(tree, container, m["list"] == "enumerate")
                    elif tree.lists:
                        tree.lists.pop()
                elif m[3].strip():
                    _tagged_item(tree, container, m[3])
            left = "".join(kept) + left[at:]
        plain = left.strip()
        if plain and plain.strip("\x00"):
            kind = PARA
            if plain[0] == "{":
                kind = TEMPLATE if plain.startswith("{{") else TABLE if plain.startswith("{|") else PARA
            elif plain[0] == "[":
                kind = META if _META.match(plain) else FILE if _FILE.match(plain) else PARA
            elif plain[:8].lower() == "<gallery":
                kind = GALLERY
            node = tree.add(kind, tree.home(container), left)
            if kind == TABLE:
                for cells in wiki_cells(left):
                    if cells:
                        row = tree.add(ROW, node, "")
                        for cell in cells:
                            tree.add(CELL, row, cell)


def _containers(tree: Tree, parent: int, text: str) -> None:
    """Adds the nodes of `text` below `parent`, what stands between the tags of a container below its node."""
    open_: list[tuple[str, int, int]] = [("", parent, 0)]
    at = 0

    def close(end: int) -> None:
        tag, node, start = open_.pop()
        if tree.kinds[node] == CELL:
            tree.raw[node] = text[start:end]

    for m in _CONTAINER.finditer(text):
        if m.start() < at:
            continue  # within a script
        tag = m[2].lower()
        if m.start() > at:
            _blocks(tree, open_[-1][1], text[at : m.start()])
        at = m.end()
        if m[1]:
            if any(tag == t for t, _, _ in open_):
                while open_[-1][0] != tag:
                    close(m.start())
                close(m.start())
            continue
        while len(open_) > 1 and open_[-1][0] in _ENDS.get(tag, ()):
            close(m.start())
        tree.now += 1
        home = tree.home(open_[-1][1])
        if tag in ("script", "style"):
            end = re.compile(rf"</{tag}\s*>", re.I).search(text, at)
            tree.add(SCRIPT, home, text[at : end.start() if end else len(text)])
            at = end.end() if end else len(text)
        elif not m[3].endswith("/"):
            kind = {"table": TABLE, "tr": ROW, "td": CELL, "th": CELL}.get(tag, BOX)
            open_.append((tag, tree.add(kind, home, f"{tag}{m[3]}"), at))
    if at < len(text):
        _blocks(tree, open_[-1][1], text[at:])
    while len(open_) > 1:
        close(len(text))


def _hold_formulas(tree: Tree, parent: int, text: str) -> str:
    if "$" not in text and "\\" not in text and "<" not in text:
        return text

    def hold(m: re.Match) -> str:
        body = next(g for i, g in enumerate(m.groups(), 1) if g is not None and i != 5)
        if not body.strip():
            return m[0]
        tree.formulas.append(tree.add(FORMULA, parent, body))
        tree.held.append(one_line(body))
        return f"\x01{len(tree.held) - 1}\x01"

    return _MATH.sub(hold, text)


def parse(text: str) -> Tree:
    """The node tree of a page."""
    tree = Tree()
    if "\r" in text:
        text = text.replace("\r\n", "\n")
    if "\x00" in text or "\x01" in text:
        text = text.replace("\x00", " ").replace("\x01", " ")
    opaque: list[str] = []
    if "<" in text or "`" in text or "~" in text or "\\" in text or "%" in text:

        def hide(m: re.Match) -> str:
            opaque.append(m[0])
            return "\x00"

        text = OPAQUE.sub(hide, text)
    nodes: list[int] = []
    for raw in opaque:
        if raw.startswith("<!--"):
            at, inside = tree.add(COMMENT, 0, raw), raw[4:].removesuffix("-->")
        elif raw.lstrip(" \t").startswith("%"):
            at, inside = tree.add(COMMENT, 0, raw), raw.lstrip(" \t%")
        elif raw[:7].lower() == "<nowiki":
            at, inside = tree.add(NOWIKI, 0, raw), raw[raw.index(">") + 1 : raw.rindex("<")]
        else:
            at = tree.add(CODE, 0, raw)
            inside = code_body(raw)
        nodes.append(at)
        _blocks(tree, at, _hold_formulas(tree, at, inside))
        tree.lists.clear()
    tree.now = 0.0
    tree.opaque = nodes
    _containers(tree, 0, _hold_formulas(tree, 0, text))
    return tree
