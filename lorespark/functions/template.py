"""Expansion of template calls, parameters, parser functions and magic words. Pure Python.

An `Expander` is given the template sources and, where wanted, the set of titles, module handlers
and a query handler; it then turns page text into expanded text and collects the properties set
on the way. Limits: calls nest at most 10 deep and never into themselves, parameter defaults 8.
"""

from __future__ import annotations

import re
from collections.abc import Callable
from dataclasses import dataclass, field
from urllib.parse import quote

from lorespark.functions import exprs
from lorespark.functions.namespaces import NAMESPACES

MAX_DEPTH, MAX_DEFAULTS = 10, 8
_PROTECTED = re.compile(r"<!--.*?-->|<(nowiki|pre|gallery|source|syntaxhighlight|imagemap|poem)\b[^>]*(?:/>|>.*?</\1\s*>)", re.S | re.I)
_ANNOTATION = re.compile(r"\[\[([^\[\]|{}:]+)::([^\[\]|]*)(?:\|([^\[\]]*))?\]\]")
# Words of the language without a result here, and constants.
SILENT = {"related", "categorytree", "dpl", "language", "seo", "widget", "time"}
SETTERS = {"subobject", "set_internal", "declare"}
EMPTY_WORDS = {"CURRENTYEAR", "CURRENTMONTH", "CURRENTDAY", "CURRENTTIME", "CURRENTTIMESTAMP", "SERVER", "SERVERNAME", "NUMBEROFPAGES", "NUMBEROFARTICLES", "NUMBEROFFILES"}
NAMES = {"!": "|", "=": "=", "-": ""}


def _braces(s: str, i: int) -> int:
    """Opening braces at a place, counted to seven: three are a parameter, five a call whose name is one."""
    return len(s[i : i + 7]) - len(s[i : i + 7].lstrip("{"))


def close_of(s: str, start: int, opening: str, closing: str) -> int:
    """Index after the mark that closes the one at `start`, or -1."""
    depth, i, n = 0, start, len(opening)
    while i < len(s):
        if s.startswith(opening, i):
            depth, i = depth + 1, i + n
        elif s.startswith(closing, i):
            depth, i = depth - 1, i + n
            if not depth:
                return i
        else:
            i += 1
    return -1


def call_end(s: str, start: int) -> int:
    """Index after a `{{` call at `start`; triple braces inside count as parameters."""
    i, stack = start + 2, [2]
    while i < len(s):
        if s.startswith("{{{", i) and not s.startswith("{{{{", i):
            stack.append(3)
            i += 3
        elif s.startswith("{{", i):
            stack.append(2)
            i += 2
        elif s.startswith("}}", i):
            width = stack[-1] if s.startswith("}" * stack[-1], i) else 2
            stack.pop()
            i += width
            if not stack:
                return i
        else:
            i += 1
    return -1


def split_args(s: str, sep: str = "|") -> list[str]:
    """Parts at separators outside of calls, parameters, links and protected blocks."""
    out, depth, link, last, i = [], 0, 0, 0, 0
    while i < len(s):
        if s.startswith("{{", i):
            depth, i = depth + 1, i + 2
        elif s.startswith("}}", i):
            depth, i = max(0, depth - 1), i + 2
        elif s.startswith("[[", i):
            link, i = link + 1, i + 2
        elif s.startswith("]]", i):
            link, i = max(0, link - 1), i + 2
        elif s[i] == "<" and (m := _PROTECTED.match(s, i)):
            i = m.end()
        else:
            if s[i] == sep and not depth and not link:
                out.append(s[last:i])
                last = i + 1
            i += 1
    return [*out, s[last:]]


def source_of(text: str) -> str:
    """What a page gives when transcluded: only its `onlyinclude` parts if there are any, nothing of `noinclude`."""
    text = re.sub(r"<!--.*?(?:-->|\Z)", "", text, flags=re.S)
    only = re.findall(r"<onlyinclude>(.*?)</onlyinclude>", text, re.S | re.I)
    if only:
        text = "".join(only)
    text = re.sub(r"<noinclude>.*?(?:</noinclude>|\Z)", "", text, flags=re.S | re.I)
    return re.sub(r"</?(?:includeonly|onlyinclude)\s*/?>", "", text, flags=re.I)


def labelled_section(text: str, name: str) -> str:
    """All parts between begin and end marks of a name, one a line; an unclosed one reaches the end."""
    q = re.escape(name)
    return "\n".join(re.findall(rf"""<section\s+begin\s*=\s*["']?{q}["']?\s*/>(.*?)(?:<section\s+end\s*=\s*["']?{q}["']?\s*/>|\Z)""", text, re.S | re.I))


def heading_section(text: str, name: str) -> str:
    """From below a heading to the next of the same or a higher level."""
    m = re.search(rf"^(=+)\s*{re.escape(name)}\s*\1\s*$", text, re.M)
    if not m:
        return ""
    rest = text[m.end() :]
    after = next((h.start() for h in re.finditer(r"^(=+)[^=\n].*?\1\s*$", rest, re.M) if len(h[1]) <= len(m[1])), len(rest))
    return rest[:after].strip("\n")


@dataclass
class Expander:
    templates: dict[str, str]
    titles: set[str] = field(default_factory=set)
    pages: Callable[[str], str | None] = lambda _t: None
    modules: dict[str, Callable[[str, list[str], dict[str, str]], str]] = field(default_factory=dict)
    ask: Callable[[list[str]], str] | None = None
    show: Callable[[list[str]], str] | None = None

    def expand(self, text: str, title: str = "") -> tuple[str, list[tuple[str, str]]]:
        """(expanded text, properties in order)."""
        run = _Run(self, title)
        return run.text(text, {}, ()), run.props

    def find(self, name: str) -> str | None:
        name = " ".join(name.replace("_", " ").split())
        first = name[:1]
        for n in (name, first.upper() + name[1:], first.lower() + name[1:]):
            if n in self.templates:
                return self.templates[n]
        return None

    def exists(self, title: str) -> bool:
        t = title.strip().replace("_", " ")
        return any(x in self.titles for x in (t, t[:1].upper() + t[1:], t[:1].lower() + t[1:]))


class _Run:
    def __init__(self, env: Expander, title: str):
        self.env, self.title = env, title
        self.arrays: dict[str, list[str]] = {}
        self.props: list[tuple[str, str]] = []

    def text(self, s: str, params: dict[str, str], stack: tuple[str, ...]) -> str:
        out, i = [], 0
        while i < len(s):
            if s.startswith("{{{", i) and _braces(s, i) in (3, 6, 7):
                end = close_of(s, i, "{{{", "}}}")
                if end > 0:
                    out.append(self.parameter(s[i + 3 : end - 3], params, stack, 0))
                    i = end
                    continue
            if s.startswith("{{", i):
                end = call_end(s, i)
                if end > 0:
                    out.append(self.call(s[i + 2 : end - 2], s[i:end], params, stack))
                    i = end
                    continue
                out.append("{{")
                i += 2
                continue
            if s.startswith("[[", i):
                end = close_of(s, i, "[[", "]]")
                if end > 0:
                    inner = self.text(s[i + 2 : end - 2], params, stack)
                    m = _ANNOTATION.fullmatch(f"[[{inner}]]")
                    if m:
                        self.capture(m[1], m[2])
                        inner = f"{m[2]}|{m[3]}" if m[3] is not None else m[2]
                    out.append(f"[[{inner}]]")
                    i = end
                    continue
            if s[i] == "<" and (m := _PROTECTED.match(s, i)):
                if not m[0].startswith("<!--"):
                    out.append(m[0])
                i = m.end()
                continue
            step = re.compile(r"\{\{|\[\[|<").search(s, i + 1)
            stop = step.start() if step else len(s)
            out.append(s[i:stop])
            i = stop
        return "".join(out)

    def capture(self, prop: str, value: str) -> None:
        prop, value = prop.strip(), value.strip()
        if prop and value:
            self.props.append((prop[:1].upper() + prop[1:], value))

    def parameter(self, inner: str, params: dict[str, str], stack: tuple[str, ...], depth: int) -> str:
        parts = split_args(inner)
        name = self.text(parts[0], params, stack).strip()
        if name in params:
            return params[name]
        if len(parts) < 2 or depth >= MAX_DEFAULTS:
            return ""
        return self.text("|".join(parts[1:]), params, stack)

    def call(self, inner: str, raw: str, params: dict[str, str], stack: tuple[str, ...]) -> str:
        parts = split_args(inner)
        head = self.text(parts[0], params, stack).strip()
        if head in NAMES:
            return NAMES[head]
        if not head:
            return ""
        name, colon, first = head.partition(":")
        if name.startswith("#"):
            _, c, unexpanded = parts[0].partition(":")
            return self.function(name[1:].strip().lower(), [unexpanded if c else "", *parts[1:]], raw, params, stack)
        word = self.word(name.strip(), first if colon else None, bool(colon))
        if word is not None:
            return word
        if name.lower() == "special" and first.lower().startswith("prefixindex/"):
            strip = any(p.replace(" ", "") == "stripprefix=1" for p in parts[1:])
            prefix = first[len("prefixindex/") :]
            hits = [t for t in sorted(self.env.titles) if t.startswith(prefix)]
            return "\n".join(f"* [[{t}|{t[len(prefix) :] if strip else t}]]" for t in hits)
        if colon and not name.strip():
            page = self.env.pages(first.strip())
            return self.template(first.strip(), source_of(page), parts[1:], params, stack) if page is not None else f"[[{first.strip()}]]"
        name = re.sub(r"(?is)^(?:template|模板)\s*:\s*", "", head)
        body = self.env.find(name)
        return raw if body is None else self.template(name, source_of(body), parts[1:], params, stack)

    def template(self, name: str, body: str, args: list[str], params: dict[str, str], stack: tuple[str, ...]) -> str:
        if name in stack or len(stack) >= MAX_DEPTH:
            return ""
        bound, place = {}, 0
        for a in args:
            key, eq, value = self._named(a)
            if eq:
                bound[self.text(key, params, stack).strip()] = self.text(value, params, stack).strip()
            else:
                place += 1
                bound[str(place)] = self.text(a, params, stack).strip()
        return self.text(body, bound, (*stack, name))

    @staticmethod
    def _named(arg: str) -> tuple[str, str, str]:
        parts = split_args(arg, "=")
        return (parts[0], "=", "=".join(parts[1:])) if len(parts) > 1 else (arg, "", "")

    def word(self, name: str, arg: str | None, colon: bool) -> str | None:
        upper = name.upper()
        base = upper[:-1] if upper.endswith("E") and upper[:-1] in ("PAGENAME", "FULLPAGENAME", "NAMESPACE", "BASEPAGENAME", "ROOTPAGENAME", "SUBPAGENAME") else upper
        title = arg if colon and arg else self.title
        ns, c, rest = title.partition(":")
        page = rest if c else title
        segments = page.split("/")
        if name == upper:
            words = {
                "PAGENAME": segments[-1], "FULLPAGENAME": title, "NAMESPACE": ns if c else "", "ROOTPAGENAME": segments[0],
                "BASEPAGENAME": "/".join(segments[:-1]) or page, "SUBPAGENAME": "/".join(segments[1:]) or page, "SITENAME": "Wiki",
            }
            if base in words:
                return words[base]
            if upper in EMPTY_WORDS or upper in ("DEFAULTSORT", "DISPLAYTITLE"):
                return ""
        if not colon:
            return None
        low = name.lower()
        arg = arg or ""
        if low in ("lc", "uc", "lcfirst", "ucfirst"):
            return {"lc": arg.lower(), "uc": arg.upper(), "lcfirst": arg[:1].lower() + arg[1:], "ucfirst": arg[:1].upper() + arg[1:]}[low]
        if low in ("urlencode", "anchorencode"):
            return quote(arg, safe="-_.~")
        if low == "ns":
            return NAMESPACES.get(arg.strip().lower(), arg.strip())
        if low in ("fullurl", "localurl", "canonicalurl", "filepath"):
            return "#"
        return None

    def function(self, name: str, args: list[str], raw: str, params: dict[str, str], stack: tuple[str, ...]) -> str:
        ex = lambda i, default="": self.text(args[i], params, stack).strip() if i < len(args) else default
        number = lambda s, default=0: int(float(s)) if re.fullmatch(r"\s*[+-]?\d+(?:\.\d*)?\s*", s) else default
        if name == "if":
            return ex(1) if ex(0) else ex(2)
        if name == "ifeq":
            return ex(2) if ex(0) == ex(1) else ex(3)
        if name == "ifexist":
            return ex(1) if self.env.exists(ex(0)) else ex(2)
        if name == "iferror":
            tested = ex(0)
            return ex(1) if 'class="error"' in tested or "{{#" in tested else ex(2)
        if name == "ifexpr":
            return ex(1) if exprs.evaluate(exprs.parse(ex(0))) not in (0.0,) else ex(2)
        if name == "expr":
            return exprs.expr(ex(0))
        if name == "switch":
            return self.switch(args, params, stack)
        if name == "titleparts":
            title, count, first = args[0].strip(), number(ex(1), -1), number(ex(2), 1)
            parts = self.text(title, params, stack).split("/")
            parts = [] if count == 0 else parts[:count] if count > 0 else parts
            return "/".join(parts[max(0, first - 1) :])
        if name == "pos":
            at = ex(0).find(ex(1), min(max(0, number(ex(2))), len(ex(0))))
            return str(at) if at >= 0 else ""
        if name == "sub":
            s, start, size = ex(0), ex(1), ex(2)
            if not re.fullmatch(r"[+-]?\d+", start):
                return s
            a = max(0, len(s) + int(start)) if int(start) < 0 else int(start)
            if not re.fullmatch(r"[+-]?\d+", size):
                return s[a:]
            b = a + int(size) if int(size) >= 0 else len(s) + int(size)
            return s[a:b] if b > a else ""
        if name == "replace":
            return ex(0).replace(ex(1), ex(2)) if ex(1) else ex(0)
        if name == "explode":
            if not ex(1):
                return ex(0)
            parts, n = ex(0).split(ex(1)), number(ex(2))
            return parts[n] if -len(parts) <= n < len(parts) else ""
        if name == "len":
            return str(len(ex(0)))
        if name == "arraydefine":
            self.arrays[ex(0)] = ex(1).split(ex(2) or ",")
            return ""
        if name == "arrayindex":
            a = self.arrays.get(ex(0))
            if a is None:
                return ex(2)
            i = number(ex(1), 1)
            i = i - 1 if i > 0 else i
            return a[i] if -len(a) <= i < len(a) and ex(1) != "0" else ""
        if name == "tag":
            tag, content = ex(0).lower(), ex(1)
            if tag in ("templatestyles", "style", "seo", "highlight", "syntaxhighlight", "source", "pre"):
                return ""
            return content if tag == "nowiki" else f"<{tag}>{content}</{tag}>"
        if name == "set":
            for a in args:
                key, eq, value = self._named(a)
                if eq:
                    self.capture(key, self.text(value, params, stack))
            return ""
        if name in SETTERS or name in SILENT:
            return ""
        if name == "invoke":
            handler = self.env.modules.get(ex(0).lower())
            given = {k: v for k, v in params.items()} if len(args) < 3 else {}
            place = 0
            for a in args[2:]:
                key, eq, value = self._named(a)
                if eq:
                    given[key.strip()] = self.text(value, params, stack).strip()
                else:
                    place += 1
                    given[str(place)] = self.text(a, params, stack).strip()
            return handler(ex(1).lower(), [given[k] for k in sorted((k for k in given if k.isdigit()), key=int)], given) if handler else ""
        if name in ("ask", "show"):
            run = self.env.ask if name == "ask" else self.env.show
            return run([self.text(a, params, stack) for a in args]) if run else ""
        if name in ("lst", "lsth"):
            page = self.env.pages(ex(0))
            if page is None:
                return ""
            part = labelled_section(page, ex(1)) if name == "lst" else heading_section(page, ex(1))
            return self.template(f"{ex(0)}#{ex(1)}", part, [], params, stack)
        return raw

    def switch(self, args: list[str], params: dict[str, str], stack: tuple[str, ...]) -> str:
        value = self.text(args[0], params, stack).strip()
        default, falling = "", False
        for i, a in enumerate(args[1:], 1):
            key, eq, result = self._named(a)
            name = self.text(key, params, stack).strip()
            if not eq:
                if i == len(args) - 1 and name != value:
                    return self.text(a, params, stack).strip()
                falling = falling or name == value
                if i == len(args) - 1:
                    return name
                continue
            if falling or name == value:
                return self.text(result, params, stack).strip()
            if name == "#default":
                default = result
        return self.text(default, params, stack).strip()
