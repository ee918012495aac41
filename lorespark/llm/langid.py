"""Languages of documents and of the segments of mixed documents (problem 9).

Language-bitmask n-gram filters: one Bloom filter whose cells hold a bit for every language, so
that a look-up of an n-gram returns the mask of all languages that contain it. Per-language
popcounts over the n-grams of a sentence, corrected for the filter's false positives, decide.

The filters are filled from at most TRAIN_ROWS labelled rows, those of the least hashed ids, and
at most TRAIN_CHARS characters of each; texts are then decided whole. As
labels may be wrong and texts mixed, an n-gram enters a language only if it is there nearly as
frequent as in the language that uses it most; sentences are then labelled by this first model
and the filters filled again from them.
"""

from __future__ import annotations

import re
from collections import Counter, defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lorespark.session import ship

# The languages and the spellings of their labels.
LABELS = {
    "de": ["de", "deu", "ger", "german"],
    "en": ["en", "eng", "english"],
    "es": ["es", "spa", "spanish"],
    "fr": ["fr", "fra", "fre", "french"],
    "ja": ["ja", "jpn", "japanese"],
    "ko": ["ko", "kor", "korean"],
    "pt": ["pt", "por", "portuguese"],
    "ru": ["ru", "rus", "russian"],
    "zh": ["zh", "zho", "chi", "cmn", "chinese"],
}
LANGS = list(LABELS)
_CODE_OF = {spelling: code for code, spellings in LABELS.items() for spelling in spellings}

TRAIN_ROWS, TRAIN_CHARS = 4000, 20_000
FILTER_BITS, PROBES = 18, 4
#: An n-gram belongs to a language if its rate there is at least this part of its greatest rate.
SHARE_OF_BEST = 0.25
#: A sentence needs this many n-grams, and this estimate for a language, to be in it.
MIN_GRAMS, MIN_ESTIMATE, MIN_MARGIN = 5, 0.35, 0.05
#: A smaller margin will do where it is this many standard deviations of the n-grams that tell both languages apart.
MIN_DEVIATIONS = 3
_LANE = 24
_LANE_MAX = (1 << _LANE) - 1

_NOT_PROSE = re.compile(r"\{\{(?:[^{}]|\{\{[^{}]*\}\})*\}\}|\[\[[^\[\]]*\]\]|[(（]\s*[^\s()（）]+\s*[)）]")
_SENTENCE = re.compile(r"[^\n.!?。！？]*(?:[.!?](?!\s|\Z)[^\n.!?。！？]*)*(?:[.!?。！？]+|\n|\Z)")
_ENDED = re.compile(r"[.!?。！？]\s*\Z")
#: Words of alphabets and syllabaries with spaces, and runs of scripts without.
_TOKEN = re.compile(r"[぀-ヿ㐀-䶿一-鿿々ー]+|[^\W\d_぀-ヿ㐀-䶿一-鿿々ー]+")
_UNSPACED = re.compile(r"[぀-ヿ㐀-䶿一-鿿々ー]")


def label_code(label: str | None) -> str | None:
    """The two-letter code that a label names, in whatever spelling; None if it names none of ours."""
    words = re.findall(r"[a-z]+", (label or "").lower())
    return next((_CODE_OF[w] for w in words[:1] if w in _CODE_OF), None) or next((_CODE_OF[w] for w in words if len(w) > 3 and w in _CODE_OF), None)


def sentences(text: str) -> list[tuple[int, int, str]]:
    """(start, end, prose) of what ends at a full stop or a line end and holds letters.

    Calls, links and single words in brackets are blanked out. A line that lacks the stop is
    a sentence only if it has four words or eight letters without spaces.
    """
    blanked = _NOT_PROSE.sub(lambda m: " " * len(m[0]), text)
    out = []
    for m in _SENTENCE.finditer(blanked):
        s = m[0]
        if not s.strip():
            continue
        tokens = _TOKEN.findall(s)
        if not tokens:
            continue
        if not _ENDED.search(s) and len(tokens) < 4 and sum(len(t) for t in tokens if _UNSPACED.match(t)) < 8:
            continue
        out.append((m.start(), m.end(), s))
    return out


def grams(token: str) -> list[str]:
    """Pairs of characters in scripts without spaces, else runs of four of the word with its ends marked."""
    if _UNSPACED.match(token):
        return [token[i : i + 2] for i in range(len(token) - 1)] or [token]
    padded = f"^{token}$"
    return [padded[i : i + 4] for i in range(len(padded) - 3)] or [padded]


class Filters:
    """The bit-sliced filter and the probability of a false positive per language."""

    def __init__(self, cells: np.ndarray):
        self.cells = cells
        self.false_rates = [min(0.99, float(((cells >> l) & 1).mean()) ** PROBES) for l in range(len(LANGS))]
        self.known: dict[str, tuple[int, int]] = {}

    @classmethod
    def fill(cls, members: dict[str, int]) -> Filters:
        cells = np.zeros(1 << FILTER_BITS, np.uint16)
        for gram, mask in members.items():
            for at in cls.places(gram):
                cells[at] |= mask
        return cls(cells)

    @staticmethod
    def places(gram: str) -> list[int]:
        h = xxhash.xxh3_64_intdigest(gram)
        a, b = h & 0xFFFFFFFF, (h >> 32) | 1
        return [(a + i * b) & ((1 << FILTER_BITS) - 1) for i in range(PROBES)]

    def mask(self, gram: str) -> int:
        m = -1
        for at in self.places(gram):
            m &= int(self.cells[at])
        return m & ((1 << len(LANGS)) - 1)

    def counted(self, token: str) -> tuple[int, int]:
        """n-grams of a token, and the popcounts of all languages in lanes of one integer."""
        got = self.known.get(token)
        if got is None:
            gs = grams(token)
            lanes = 0
            for g in gs:
                m = self.mask(g)
                while m:
                    low = m & -m
                    lanes += 1 << (_LANE * (low.bit_length() - 1))
                    m ^= low
            if len(self.known) > 200_000:
                self.known.clear()
            got = self.known[token] = (len(gs), lanes)
        return got

    def decide(self, prose: str) -> tuple[str, float, float]:
        """(language or `und`, confidence, margin over the second) of a sentence."""
        n = lanes = 0
        for token in _TOKEN.findall(prose.lower()):
            a, b = self.counted(token)
            n += a
            lanes += b
        if n < MIN_GRAMS:
            return "und", 0.0, 0.0
        best = next_best = 0.0
        first = 0
        for l, false in enumerate(self.false_rates):
            estimate = (((lanes >> (_LANE * l)) & _LANE_MAX) - n * false) / (n * (1 - false))
            if estimate > best:
                first, best, next_best = l, estimate, best
            elif estimate > next_best:
                next_best = estimate
        best = min(best, 1.0)
        if best < MIN_ESTIMATE:
            return "und", best, 0.0
        return LANGS[first], best * best / (best + next_best), best - next_best

    def clear(self, prose: str, lang: str) -> bool:
        """Whether the n-grams that only one of two languages has speak for `lang` against each other one."""
        masks = Counter(self.mask(g) for token in _TOKEN.findall(prose.lower()) for g in grams(token))
        me = LANGS.index(lang)
        for other in range(len(LANGS)):
            if other != me:
                mine = sum(n for m, n in masks.items() if m >> me & 1 and not m >> other & 1)
                its = sum(n for m, n in masks.items() if m >> other & 1 and not m >> me & 1)
                if mine <= its or (mine - its) ** 2 < MIN_DEVIATIONS**2 * (mine + its):
                    return False
        return True


def _members(labelled: list[tuple[str, int]]) -> dict[str, int]:
    """Masks of the n-grams of labelled sentences."""
    rows = Counter(l for _, l in labelled)
    seen: dict[str, Counter] = defaultdict(Counter)
    for prose, l in labelled:
        for g in {g for token in _TOKEN.findall(prose.lower()) for g in grams(token)}:
            seen[g][l] += 1
    out = {}
    for g, by in seen.items():
        rates = {l: c / rows[l] for l, c in by.items()}
        best = max(rates.values())
        out[g] = sum(1 << l for l, r in rates.items() if r >= SHARE_OF_BEST * best)
    return out


def train(rows: list[tuple[str, str]]) -> Filters:
    """Filters from (text, label) rows; without any known label all is `und`."""
    labelled = [(s, LANGS.index(code)) for text, label in rows if text and (code := label_code(label)) for _, _, s in sentences(text)]
    filters = Filters.fill(_members(labelled))
    again = [(s, LANGS.index(lang)) for s, _ in labelled for lang, _, margin in [filters.decide(s)] if lang != "und" and margin >= MIN_MARGIN]
    return Filters.fill(_members(again)) if again else filters


def segments(filters: Filters, text: str) -> list[dict]:
    """Runs of sentences in one language; a sentence without a clear decision joins its predecessor."""
    out: list[dict] = []
    for start, end, prose in sentences(text):
        lang, confidence, margin = filters.decide(prose)
        size = end - start
        unsure = lang == "und" or margin < MIN_MARGIN and not filters.clear(prose, lang)
        if out and (out[-1]["lang"] == lang or unsure):
            last = out[-1]
            last["confidence"] = (last["confidence"] * last["size"] + confidence * size) / (last["size"] + size)
            last["seg_end"], last["size"] = end, last["size"] + size
            last["unsure"] = last["unsure"] and unsure
        elif out and out[-1]["unsure"]:
            last = out[-1]
            last.update(seg_end=end, lang=lang, confidence=confidence, size=last["size"] + size, unsure=unsure)
        else:
            out.append({"seg_start": start, "seg_end": end, "lang": lang, "confidence": confidence, "size": size, "unsure": unsure})
    return out


_SEGMENT = pa.struct([("seg_start", pa.int32()), ("seg_end", pa.int32()), ("lang", pa.string()), ("confidence", pa.float64())])
_LANGUAGE = pa.struct([("lang", pa.string()), ("share", pa.float64()), ("confidence", pa.float64())])


def _detect(cells: np.ndarray):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        filters = Filters(cells)
        for batch in batches:
            segs, langs, cases = [], [], []
            for text, label in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist()):
                found = segments(filters, text or "")
                by: dict[str, list[float]] = {}
                for s in found:
                    e = by.setdefault(s["lang"], [0.0, 0.0])
                    e[0] += s["size"]
                    e[1] += s["size"] * s["confidence"]
                total = sum(e[0] for e in by.values())
                spoken = [{"lang": k, "share": e[0] / total, "confidence": e[1] / e[0]} for k, e in sorted(by.items(), key=lambda x: (-x[1][0], x[0]))]
                segs.append([{k: s[k] for k in ("seg_start", "seg_end", "lang", "confidence")} for s in found])
                langs.append(spoken)
                known = [x["lang"] for x in spoken if x["lang"] != "und"]
                cases.append(bool(known) and known != [label_code(label)])
            yield pa.record_batch([batch.column(0), pa.array(langs, pa.list_(_LANGUAGE)), pa.array(segs, pa.list_(_SEGMENT)), pa.array(cases)], names=["item_key", "languages", "segments", "relabel"])

    return run


def training_rows(df: DataFrame, id_col: str, text_col: str, label_col: str, rows: int = TRAIN_ROWS, chars: int = TRAIN_CHARS) -> list[tuple[str, str]]:
    """At most `rows` labelled rows, those of the least hashed ids, of each the first `chars` characters.

    A threshold on the hash, set from the number of labelled rows, leaves little more than `rows` of
    them before anything is gathered, however many partitions there are. The same at every run.
    """
    known = F.regexp_extract(F.lower(F.coalesce(F.col(label_col), F.lit(""))), "([a-z]+)", 1).isin(list(_CODE_OF))
    labelled = df.where(known & F.col(text_col).isNotNull())
    share = min(1.0, (rows + 6 * rows**0.5) / max(1, labelled.count()))
    h = F.xxhash64(id_col)
    least = labelled.where(F.shiftrightunsigned(h, 32) <= int(share * (1 << 32))).select(h.alias("h"), F.substring(text_col, 1, chars).alias("t"), F.col(label_col).alias("l"))
    return [(r["t"], r["l"]) for r in least.orderBy(F.shiftrightunsigned("h", 32), "h", "t").limit(rows).collect()]


def detect(df: DataFrame, id_col: str, text_col: str, label_col: str, filters: Filters | None = None) -> DataFrame:
    """(item_key, languages, segments, relabel) of each row.

    `languages` are those with a whole sentence, by falling share of the prose; `relabel` tells
    that the label does not name exactly the one language of the text. Texts that are null,
    blank or without a sentence have no language and need no label.
    """
    ship(df.sparkSession)
    filters = filters or train(training_rows(df, id_col, text_col, label_col))
    kind = df.schema[id_col].dataType.simpleString()
    schema = f"item_key {kind}, languages array<struct<lang:string,share:double,confidence:double>>, segments array<struct<seg_start:int,seg_end:int,lang:string,confidence:double>>, relabel boolean"
    return df.select(F.col(id_col), F.col(text_col), F.col(label_col)).mapInArrow(_detect(filters.cells), schema)
