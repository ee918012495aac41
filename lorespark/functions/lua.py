"""Lua table literals and enum pages. Pure Python."""

from __future__ import annotations

import re

_TOKEN = re.compile(
    r"""\s+|--\[\[.*?\]\]|--[^\n]*"""
    r"""|(?P<long>\[(?P<eq>=*)\[\n?(?P<body>.*?)\](?P=eq)\])"""
    r"""|(?P<str>"(?:\\.|[^"\\])*"|'(?:\\.|[^'\\])*')"""
    r"""|(?P<num>-?(?:0[xX][0-9a-fA-F]+|\d+\.?\d*(?:[eE][+-]?\d+)?|\.\d+))"""
    r"""|(?P<name>[A-Za-z_]\w*)|(?P<op>[{}\[\]=,;])""",
    re.S,
)
# Escapes of the language.
_ESCAPES = {"n": "\n", "t": "\t", "r": "\r", "a": "\a", "b": "\b", "f": "\f", "v": "\v"}


def _unescape(s: str) -> str:
    def one(m: re.Match) -> str:
        if m[1]:
            return chr(int(m[1]))
        if m[2]:
            return chr(int(m[2], 16))
        if m[3]:
            return chr(int(m[3], 16))
        return _ESCAPES.get(m[4], m[4])

    return re.sub(r"\\(?:(\d{1,3})|x([0-9a-fA-F]{2})|u\{([0-9a-fA-F]+)\}|(.))", one, s, flags=re.S)


def read_table(source: str):
    """The value of `return {...}` or of a bare literal. A table with positional values only is a list.

    Anything after the literal, or anything that is no literal, is a ValueError.
    """
    tokens, at = [], 0
    source = re.sub(r"\A\s*(?:--[^\n]*\n\s*)*return\b", "", source)
    while at < len(source):
        m = _TOKEN.match(source, at)
        if not m:
            raise ValueError(f"no literal at {at}: {source[at : at + 20]!r}")
        at = m.end()
        if m.lastgroup:
            kind = "long" if m["long"] is not None else next(k for k in ("str", "num", "name", "op") if m[k] is not None)
            tokens.append((kind, m["body"] if kind == "long" else m[kind]))
    tokens.append(("end", ""))
    place = 0

    def peek(k: int = 0) -> tuple[str, str]:
        return tokens[min(place + k, len(tokens) - 1)]

    def take(op: str) -> bool:
        nonlocal place
        if peek() == ("op", op):
            place += 1
            return True
        return False

    def value():
        nonlocal place
        kind, text = peek()
        if take("{"):
            listed, named = [], {}
            while not take("}"):
                if take("["):
                    key = value()
                    if not take("]") or not take("="):
                        raise ValueError("a key in brackets needs ] =")
                    named[key] = value()
                elif peek()[0] == "name" and peek(1) == ("op", "="):
                    key = peek()[1]
                    place += 2
                    named[key] = value()
                else:
                    listed.append(value())
                if not (take(",") or take(";")) and peek() != ("op", "}"):
                    raise ValueError(f"unexpected {peek()[1]!r}")
            if not named:
                return listed
            return {**{str(i + 1): v for i, v in enumerate(listed)}, **{str(k): v for k, v in named.items()}}
        place += 1
        if kind == "str":
            return _unescape(text[1:-1])
        if kind == "long":
            return text
        if kind == "num":
            return int(text, 16) if "x" in text.lower() else float(text) if re.search(r"[.eE]", text) else int(text)
        if kind == "name" and text in ("true", "false", "nil"):
            return {"true": True, "false": False, "nil": None}[text]
        raise ValueError(f"unexpected {text!r}")

    result = value()
    if peek()[0] != "end":
        raise ValueError(f"content after the literal: {peek()[1]!r}")
    return result


def enum_rows(source: str) -> list[dict]:
    """(table, key, label) of blocks `p.T = { "a", [n] = "b" }`; bare items count from 1 on their own."""
    out = []
    for block in re.finditer(r"\b\w+\.(\w+)\s*=\s*\{(.*?)\}", source, re.S):
        bare = 0
        for m in re.finditer(r"""\[\s*(-?\d+)\s*\]\s*=\s*(?:"((?:\\.|[^"\\])*)"|'((?:\\.|[^'\\])*)')|"((?:\\.|[^"\\])*)"|'((?:\\.|[^'\\])*)'""", block[2]):
            if m[1] is not None:
                out.append({"table": block[1], "key": int(m[1]), "label": _unescape(m[2] or m[3] or "")})
            else:
                bare += 1
                out.append({"table": block[1], "key": bare, "label": _unescape(m[4] or m[5] or "")})
    return out


# What is harvested from module code.
HARVEST = {
    "require": r"""require\s*\(?\s*["']([^"']+)["']""",
    "load_data": r"""loadData\s*\(?\s*["']([^"']+)["']""",
    "json_page": r"""["'](JSON:[^"']+)["']""",
    "sql_table": r"""(?i)\bfrom\s+([A-Za-z_]\w*)""",
}
