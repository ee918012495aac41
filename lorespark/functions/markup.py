"""Scanners over mixed wiki, HTML, Markdown and LaTeX text. Pure Python, no Spark."""

from __future__ import annotations

import html
import re
from urllib.parse import unquote

#: Regions whose content is no markup: comments (also whole LaTeX comment lines), nowiki and code blocks.
OPAQUE = re.compile(
    r"<!--.*?(?:-->|\Z)"
    r"|^[ \t]*%[^\n]*"
    r"|<nowiki>.*?</nowiki\s*>"
    r"|<(pre|source|syntaxhighlight)\b[^>]*>.*?</\1\s*>"
    r"|^[ \t]*(```|~~~)[^\n]*\n.*?^[ \t]*\2[`~]*[ \t]*\r?$"
    r"|\\begin\{(verbatim|lstlisting)\*?\}.*?\\end\{\3\*?\}",
    re.S | re.I | re.M,
)
_LINK = re.compile(r"\[\[([^\[\]|{}\n]+)(?:\||\]\])")
_CALL = re.compile(r"(?<!\{)\{\{\s*([^{}|\[\]<>]+?)\s*(?:\||\}\})")
_INVOKE = re.compile(r"#invoke\s*:\s*(.*)", re.I | re.S)
_GALLERY = re.compile(r"<gallery\b[^>]*>(.*?)</gallery\s*>", re.S | re.I)
_FILE_PREFIX = re.compile(r"\s*(?:file|image|文件)\s*:", re.I)
_WIKI_PATH = re.compile(r"""href\s*=\s*(?:"/wiki/([^"]*)"|'/wiki/([^']*)'|/wiki/([^\s>"']+))|\]\(/wiki/([^()\s]*)\)|\\href\{/wiki/((?:\\.|[^{}\\])*)\}""", re.I)
_TITLE_NOISE = re.compile("[\u061c\u200e\u200f\u202a-\u202e\u2066-\u2069]|#.*", re.S)
_LANGUAGE = re.compile(r"\s*:?\s*[a-z]{2}\s*:")
_MAGIC = re.compile(r"[A-Z]+(?::|\Z)")
_LATEX_ESCAPE = re.compile(r"\\([_%&#$~^{}])")
_MODULE = re.compile(r"""\b(?:require|loadData)\s*\(?\s*(?:"([^"\n]+)"|'([^'\n]+)')""")


_LUA_COMMENT = re.compile(r"--\[(=*)\[.*?\]\1\]|--[^\n]*", re.S)


def without_opaque(text: str) -> str:
    if "<" in text or "`" in text or "~" in text or "\\" in text or "%" in text:
        return OPAQUE.sub("\n", text)
    return text


def module_references(text: str) -> list[str]:
    """Modules that module code loads, comments left out."""
    return [a or b for a, b in _MODULE.findall(_LUA_COMMENT.sub("", text) if "--" in text else text)]


def references(text: str, title: str | None) -> list[str]:
    """Raw targets of a page, each once: links, files, categories, calls, /wiki/ paths.

    A link that begins with `/` is a sub-page of `title`; without a title it is none.
    """
    text = without_opaque(text)
    parent = _TITLE_NOISE.sub("", title or "").strip(" _\t\r\n")
    found: dict[str, None] = {}
    if "[[" in text:
        for target in _LINK.findall(text):
            if _LANGUAGE.match(target):
                continue
            bare = target.strip()
            if bare.startswith("/"):
                sub = bare.split("#", 1)[0].strip().strip("/")
                if parent and sub:
                    found[f"{parent}/{sub}"] = None
            else:
                found[target] = None
    if "{{" in text:
        for head in _CALL.findall(text):
            if head[0] == "#":
                if m := _INVOKE.match(head):
                    found["Module:" + re.sub(r"(?is)^\s*(?:module|模块)\s*:", "", m[1])] = None
            elif not _MAGIC.match(head):
                if head[0] == ":":
                    found[head] = None
                else:
                    found["Template:" + re.sub(r"(?is)^\s*(?:template|模板)\s*:", "", head)] = None
    if "/wiki/" in text:
        for a, b, c, md, tex in _WIKI_PATH.findall(text):
            path = html.unescape(a or b or c) or md or _LATEX_ESCAPE.sub(r"\1", tex)
            path = unquote(path.split("#", 1)[0])
            if path and "{" not in path and "}" not in path:
                found[path] = None
    if "gallery" in text.lower():
        for body in _GALLERY.findall(text):
            for line in body.splitlines():
                name = line.split("|", 1)[0].strip()
                if name and "{" not in name and "}" not in name:
                    found[name if _FILE_PREFIX.match(name) else "File:" + name] = None
    return list(found)
