"""Cutting oversized texts at natural boundaries (problem 3).

Recursive separator hierarchy: section, paragraph, line, sentence, word, character. A unit that
fits stays whole, a larger one is divided at the next finer separator; units are then packed
greedily up to the limit. Each piece begins with the last `overlap` characters of the one before.
The coarsest separators that sufficed for all units name the cut: `paragraph` (sections and
paragraphs), `line`, or `hard`.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lorespark.session import ship

LIMIT = 6000
OVERLAP = 200
CUTS = ["paragraph", "line", "hard"]
#: Bytes of texts in a result batch.
_BATCH = 4 << 20

#: A paragraph that begins so opens a section.
_HEADING = re.compile(r"=+[^=\n].*=+[ \t]*\r?$|#{2,6} |<[hH][1-6]\b|\\(?:sub)*section\b", re.M)
#: Separators within a line, from coarse to fine.
_FINE = [re.compile(r"(?<=[.!?])\s+|(?<=[。！？])"), re.compile(r"\s+")]
_LINE_END = re.compile(r"\r?\n")


def _lines(text: str, start: int, end: int) -> Iterator[tuple[int, int, int]]:
    """(start, end, length) of the lines of text[start:end]; the end, but not the length, has the \\n or \\r\\n."""
    for m in _LINE_END.finditer(text, start, end):
        yield start, m.end(), m.start() - start
        start = m.end()
    if start < end:
        yield start, end, end - start


def _paragraphs(text: str) -> Iterator[tuple[int, int, int]]:
    """(start, end, length) of the runs of non-blank lines; the end, but not the length, has the blank lines after it.

    The length counts one character between two lines. Blank lines at the start belong to the first run.
    """
    begin, length, blank = 0, -1, True
    for start, end, n in _lines(text, 0, len(text)):
        if n and not text[start : start + n].isspace():
            if blank and length >= 0:
                yield begin, start, length
                begin, length = start, -1
            length, blank = length + 1 + n, False
        else:
            blank = True
    if begin < len(text):
        yield begin, len(text), max(length, 0)


def _sections(text: str) -> list[list[tuple[int, int, int]]]:
    """Paragraphs by section: one that begins with a heading opens a section."""
    out: list[list[tuple[int, int, int]]] = []
    for p in _paragraphs(text):
        if not out or _HEADING.match(text, p[0]):
            out.append([])
        out[-1].append(p)
    return out


def _fine(text: str, start: int, end: int, room: int, level: int = 0) -> Iterator[tuple[int, int]]:
    """Spans of at most `room` characters that cover text[start:end], divided by sentence, word, character."""
    if end - start <= room:
        if end > start:
            yield start, end
    elif level == len(_FINE):
        for at in range(start, end, room):
            yield at, min(at + room, end)
    else:
        last = start
        for m in _FINE[level].finditer(text, start, end):
            if last < m.end() < end:
                yield from _fine(text, last, m.end(), room, level + 1)
                last = m.end()
        yield from _fine(text, last, end, room, level + 1)


def units(text: str, limit: int, room: int) -> tuple[list[tuple[int, int]], int]:
    """Consecutive spans that cover the text, and the cut (place in CUTS) that the finest of them needed."""
    out, cut = [], 0
    for section in _sections(text):
        if section[-1][1] - section[0][0] <= limit:
            out.append((section[0][0], section[-1][1]))
            continue
        for start, end, length in section:
            if length <= limit:
                out.append((start, end))
                continue
            cut = max(cut, 1)
            for a, b, n in _lines(text, start, end):
                if n <= limit:
                    out.append((a, b))
                else:
                    cut = 2
                    out.extend(_fine(text, a, b, room))
    return out, cut


def split_spans(text: str, limit: int = LIMIT, overlap: int = OVERLAP) -> tuple[list[tuple[int, int]], int, int]:
    """(start, end) of the pieces, the cut (place in CUTS), and how many units the overlap alone divided.

    Each piece is at most `limit` long and, but for the first, begins `overlap` characters before
    the end of its predecessor; together they cover the text. A unit that fits the limit but not
    beside the overlap is divided by line, sentence, word, character; that is not counted as its cut.
    """
    if not 0 <= overlap < limit:
        raise ValueError("overlap must be at least 0 and below the limit")
    if len(text) <= limit:
        return ([(0, len(text))] if text else []), 0, 0
    room = limit - overlap
    spans, cut = units(text, limit, room)
    out: list[tuple[int, int]] = []
    start = end = squeezed = 0
    for a, b in spans:
        parts = [(a, b)]
        if b - start > limit and (b - max(0, end - overlap) > limit or not end):
            squeezed += b - a > room
            parts = [x for la, lb, _ in _lines(text, a, b) for x in _fine(text, la, lb, room)]
        for _, stop in parts:
            if stop - start > limit:
                out.append((start, end))
                start = max(0, end - overlap)
            end = stop
    out.append((start, end))
    return out, cut, squeezed


_PIECE = pa.struct([("piece_no", pa.int32()), ("piece_start", pa.int32()), ("piece", pa.string())])


def _cut(limit: int, overlap: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys, kinds, squeezes, found, size = [], [], [], [], 0

            def out() -> pa.RecordBatch:
                columns = [batch.column(0).take(pa.array(keys)), pa.array(kinds, pa.string()), pa.array(squeezes, pa.int32()), pa.array(found, pa.list_(_PIECE))]
                return pa.record_batch(columns, names=["item_key", "cut", "squeezed", "pieces"])

            for i, text in enumerate(batch.column(1)):
                s = text.as_py()
                spans, cut, squeezed = split_spans(s, limit, overlap)
                keys.append(i)
                kinds.append(CUTS[cut])
                squeezes.append(squeezed)
                found.append([{"piece_no": no, "piece_start": a, "piece": s[a:b]} for no, (a, b) in enumerate(spans)])
                size += len(s)
                if size > _BATCH:
                    yield out()
                    keys, kinds, squeezes, found, size = [], [], [], [], 0
            if keys:
                yield out()

    return run


def split_oversized(df: DataFrame, id_col: str, text_col: str, limit: int = LIMIT, overlap: int = OVERLAP) -> DataFrame:
    """(item_key, cut, squeezed, pieces) of each row whose text has more than `limit` code points.

    The length is that of the text itself, whatever a size column says. Null texts and texts
    within the limit give no row; repeated rows give repeated results; null ids stay null.
    """
    ship(df.sparkSession)
    kind = df.schema[id_col].dataType.simpleString()
    over = df.select(F.col(id_col).alias("item_key"), F.col(text_col).alias("t")).where(F.length("t") > limit)
    return over.mapInArrow(_cut(limit, overlap), f"item_key {kind}, cut string, squeezed int, pieces array<struct<piece_no:int,piece_start:int,piece:string>>")


def pieces(cuts: DataFrame) -> DataFrame:
    """One row per piece."""
    return cuts.select("item_key", "cut", F.inline("pieces"))
