"""Arithmetic expressions of the template language.

Grammar, loosest first: comparison, infix `round`, `+ -`, `* / % mod div`, sign, primary. Division
and remainder by zero give 0; text that is no number gives 0. Numbers are doubles. The same tree
is evaluated in Python or compiled to a column.
"""

from __future__ import annotations

import math
import re
from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

_TOKEN = re.compile(r"\s*(?:(\d+\.?\d*(?:[eE][+-]?\d+)?|\.\d+(?:[eE][+-]?\d+)?)|(<=|>=|==|!=|<>|[-+*/%()<>=])|([A-Za-z_]\w*)|(\S))")
_COMPARE = {"<", ">", "<=", ">=", "=", "==", "<>", "!="}
_FUNCTIONS = {"floor", "ceil", "trunc", "abs", "round"}


def parse(text: str) -> tuple:
    """Nested tuples: ("num", x), ("var", name), (operator, left, right), ("neg", x), (function, x)."""
    tokens: list[tuple[str, str]] = []
    for num, op, word, _junk in (m.groups() for m in _TOKEN.finditer(text)):
        if num:
            tokens.append(("num", num))
        elif op:
            tokens.append(("op", op))
        elif word:
            tokens.append(("word", word))
        else:
            break  # what cannot be read ends the expression
    at = 0

    def peek() -> tuple[str, str]:
        return tokens[at] if at < len(tokens) else ("end", "")

    def take(*wanted: str) -> str:
        nonlocal at
        if peek()[0] in ("op", "word") and peek()[1].lower() in wanted:
            at += 1
            return tokens[at - 1][1].lower()
        return ""

    def chain(lower: Callable[[], tuple], *ops: str) -> tuple:
        left = lower()
        while op := take(*ops):
            left = (op, left, lower())
        return left

    def primary() -> tuple:
        nonlocal at
        kind, value = peek()
        if take("("):
            inner = compare()
            take(")")
            return inner
        if kind == "num":
            at += 1
            return ("num", float(value))
        if kind == "word":
            at += 1
            if value.lower() in _FUNCTIONS and take("("):
                inner = compare()
                take(")")
                return (value.lower(), inner)
            return ("var", value)
        return ("num", 0.0)

    def sign() -> tuple:
        if take("-"):
            return ("neg", sign())
        return sign() if take("+") else primary()

    def product() -> tuple:
        return chain(sign, "*", "/", "%", "mod", "div")

    def total() -> tuple:
        return chain(product, "+", "-")

    def rounded() -> tuple:
        return chain(total, "round")

    def compare() -> tuple:
        return chain(rounded, *_COMPARE)

    return compare()


def _round_away(x: float, n: float) -> float:
    scale = 10.0 ** int(n)
    return math.copysign(math.floor(abs(x) * scale + 0.5) / scale, x)


def evaluate(tree: tuple, variables: dict[str, float] | None = None) -> float:
    op = tree[0]
    if op == "num":
        return tree[1]
    if op == "var":
        return float((variables or {}).get(tree[1], 0.0))
    a = evaluate(tree[1], variables)
    if len(tree) == 2:
        return {"neg": lambda: -a, "floor": lambda: float(math.floor(a)), "ceil": lambda: float(math.ceil(a)), "trunc": lambda: float(math.trunc(a)), "abs": lambda: abs(a), "round": lambda: _round_away(a, 0)}[op]()
    b = evaluate(tree[2], variables)
    if op in ("/", "div"):
        return 0.0 if b == 0 else float(math.trunc(a / b)) if op == "div" else a / b
    if op in ("%", "mod"):
        return 0.0 if b == 0 else math.fmod(a, b)
    if op in _COMPARE:
        return float({"<": a < b, ">": a > b, "<=": a <= b, ">=": a >= b, "=": a == b, "==": a == b, "<>": a != b, "!=": a != b}[op])
    return {"+": lambda: a + b, "-": lambda: a - b, "*": lambda: a * b, "round": lambda: _round_away(a, b)}[op]()


def to_column(tree: tuple, variables: dict[str, Column] | None = None) -> Column:
    """The tree as a double column over columns for its variables; unknown names are 0."""
    op = tree[0]
    if op == "num":
        return F.lit(tree[1])
    if op == "var":
        return F.coalesce((variables or {})[tree[1]].cast("double"), F.lit(0.0)) if tree[1] in (variables or {}) else F.lit(0.0)
    a = to_column(tree[1], variables)
    trunc = lambda x: F.when(x < 0, F.ceil(x)).otherwise(F.floor(x)).cast("double")
    if len(tree) == 2:
        return {"neg": lambda: -a, "floor": lambda: F.floor(a).cast("double"), "ceil": lambda: F.ceil(a).cast("double"), "trunc": lambda: trunc(a), "abs": lambda: F.abs(a), "round": lambda: F.round(a)}[op]()
    b = to_column(tree[2], variables)
    safe = F.when(b != 0, b)
    if op in ("/", "div"):
        q = a / safe
        return F.coalesce(trunc(q) if op == "div" else q, F.lit(0.0))
    if op in ("%", "mod"):
        return F.coalesce(a % safe, F.lit(0.0))
    if op in _COMPARE:
        test = {"<": a < b, ">": a > b, "<=": a <= b, ">=": a >= b, "=": a == b, "==": a == b, "<>": a != b, "!=": a != b}[op]
        return test.cast("double")
    if op == "round":
        if tree[2][0] not in ("num", "neg"):
            scale = F.pow(F.lit(10.0), trunc(b))
            return F.signum(a) * F.floor(F.abs(a) * scale + 0.5) / scale
        return F.round(a, int(evaluate(tree[2])))
    return {"+": a + b, "-": a - b, "*": a * b}[op]


def number_text(x: float) -> str:
    """Rounded to 1e-9 and written in the shortest form; '' for no number."""
    if math.isnan(x):
        return ""
    if math.isinf(x):
        return "Infinity" if x > 0 else "-Infinity"
    r = round(x * 1e9) / 1e9 if abs(x) < 1e15 else x
    return str(int(r)) if r == int(r) and abs(r) < 1e21 else repr(r)


def expr(text: str) -> str:
    return number_text(evaluate(parse(text)))
