"""String, array and page functions of the template language as native columns.

Lengths and offsets count code points. Every function takes and returns columns; a null argument
gives null unless said otherwise.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from lorespark.functions.namespaces import NAMESPACES

from lorespark.functions.titles import lc_first, uc_first  # noqa: F401


def _c(x: Column | str | int) -> Column:
    return x if isinstance(x, Column) else F.lit(x)


# --- branches -----------------------------------------------------------------------------------


def if_text(test: Column, yes: Column, no: Column) -> Column:
    """`yes` where the trimmed text is not empty; null counts as empty."""
    return F.when(F.length(F.trim(F.coalesce(test, F.lit("")))) > 0, yes).otherwise(no)


def if_equal(a: Column, b: Column, yes: Column, no: Column) -> Column:
    """Trimmed equality of strings: `1` is not `1.0`."""
    return F.when(F.trim(a.cast("string")) == F.trim(b.cast("string")), yes).otherwise(no)


def if_error(test: Column, yes: Column, no: Column) -> Column:
    """`yes` where the text holds an error mark or an unexpanded call, else `no`."""
    return F.when(test.contains('class="error"') | test.contains("{{#"), yes).otherwise(no)


def switch(value: Column, branches: list[str]) -> Column:
    """First branch whose key equals the trimmed value. A key without a result falls through to
    the next one that has one; `#default=` or a last bare text is the default; results are trimmed."""
    cases: list[tuple[list[str], str]] = []
    waiting: list[str] = []
    default: str | None = None
    for i, b in enumerate(branches):
        key, eq, result = b.partition("=")
        if not eq:
            if i == len(branches) - 1:
                default = b.strip()
            else:
                waiting.append(b.strip())
            continue
        keys = [*waiting, key.strip()]
        waiting = []
        if "#default" in keys:
            default = result.strip()
        cases.append(([k for k in keys if k != "#default"], result.strip()))
    out = F.lit(default or "")
    v = F.trim(value)
    for keys, result in reversed(cases):
        if keys:
            out = F.when(v.isin(keys), F.lit(result)).otherwise(out)
    return out


# --- strings ------------------------------------------------------------------------------------


def length_of(s: Column) -> Column:
    return F.length(s)


def position(s: Column, needle: Column | str, offset: int = 0) -> Column:
    """0-based place of the needle at or after the offset, a negative one counting as 0; '' if there is none. An empty needle is at the offset."""
    offset = max(0, offset)
    if isinstance(needle, str) and not needle:
        return F.least(F.lit(offset), F.length(s)).cast("string")
    at = F.locate(needle, s, offset + 1) if isinstance(needle, str) else F.when(F.instr(F.substr(s, F.lit(offset + 1)), needle) > 0, F.instr(F.substr(s, F.lit(offset + 1)), needle) + offset).otherwise(0)
    return F.when(at > 0, (at - 1).cast("string")).otherwise("")


def sub(s: Column, start: int, length: int | None = None) -> Column:
    """From a 0-based start, a negative one counting from the end; a negative length stops that far
    before the end, and gives '' if that is before the start."""
    n = F.length(s)
    first = F.least(F.lit(start), n) if start >= 0 else F.greatest(n + start, F.lit(0))
    if length is None:
        return F.substr(s, first + 1)
    last = first + length if length >= 0 else n + length
    return F.substr(s, first + 1, F.greatest(last - first, F.lit(0)))


def replace_all(s: Column, needle: str, by: str) -> Column:
    """Literal replacement of every occurrence; an empty needle changes nothing."""
    return F.replace(s, F.lit(needle), F.lit(by)) if needle else s


def explode_part(s: Column, delimiter: str, n: int) -> Column:
    """The n-th part, 0-based or from the end; '' out of range; the whole text for an empty delimiter."""
    if not delimiter:
        return s
    parts = F.split(s, "\\Q" + delimiter + "\\E", -1)
    return F.when(s.isNotNull(), F.coalesce(F.try_element_at(parts, F.lit(n + 1 if n >= 0 else n)), F.lit("")))


def title_parts(title: Column, count: int = 0, first: int = 1) -> Column:
    """Takes `count` segments of a path (0 or a negative count is no limit here: 0 gives ''),
    then drops those before the 1-based `first`."""
    parts = F.split(title, "/", -1)
    if count == 0:
        parts = F.array().cast("array<string>")
    elif count > 0:
        parts = F.slice(parts, 1, count)
    if first > 1:
        parts = F.slice(parts, first, F.greatest(F.size(parts), F.lit(1)))
    return F.array_join(parts, "/")


def lookup_key(s: Column) -> Column:
    """Lower case, `_` as a space."""
    return F.lower(F.translate(s, "_", " "))


def grouped_thousands(x: Column) -> Column:
    """The truncated number with commas."""
    return F.format_number(F.when(x < 0, F.ceil(x)).otherwise(F.floor(x)), 0)


def url_encode(s: Column) -> Column:
    """Percent-encoding of UTF-8, unreserved letters, digits, `-_.~` kept."""
    return F.replace(F.replace(F.replace(F.url_encode(s), F.lit("+"), F.lit("%20")), F.lit("*"), F.lit("%2A")), F.lit("%7E"), F.lit("~"))


# --- arrays -------------------------------------------------------------------------------------


def array_define(s: Column, delimiter: str = ",") -> Column:
    """Parts as they are, not trimmed."""
    return F.split(s, "\\Q" + delimiter + "\\E", -1)


def array_index(a: Column, i: int | None, default: str = "") -> Column:
    """1-based, negative from the end; no number counts as 1; '' out of range; the default only where the array is null."""
    i = 1 if i is None else i
    if i == 0:
        return F.when(a.isNull(), F.lit(default)).otherwise("")
    return F.when(a.isNull(), F.lit(default)).otherwise(F.coalesce(F.try_element_at(a, F.lit(i)), F.lit("")))


def list_to_text(a: Column, mode: str = "pretty") -> Column:
    """`pretty` joins with 、 and 和 before the last, `final` with commas and `and`, `newline`, `bullets`, `plain`."""
    if mode == "newline":
        return F.array_join(a, "\n")
    if mode == "bullets":
        return F.array_join(F.transform(a, lambda x: F.concat(F.lit("* "), x)), "\n")
    if mode == "plain":
        return F.array_join(a, "")
    between, last = ("、", "和") if mode == "pretty" else (", ", " and ")
    n = F.size(a)
    return F.when(n <= 1, F.array_join(a, "")).otherwise(F.concat(F.array_join(F.slice(a, 1, F.greatest(n - 1, F.lit(1))), between), F.lit(last), F.element_at(a, -1)))


def split_trimmed(s: Column, delimiter: str) -> Column:
    return F.transform(array_define(s, delimiter), lambda x: F.trim(x))


# --- page words ---------------------------------------------------------------------------------



def namespace_of(title: Column) -> Column:
    """What precedes the first colon, '' without one."""
    return F.when(F.instr(title, ":") > 0, F.substring_index(title, ":", 1)).otherwise("")


def without_namespace(title: Column) -> Column:
    return F.when(F.instr(title, ":") > 0, F.substr(title, F.instr(title, ":") + 1)).otherwise(title)


def page_words(title: Column) -> dict[str, Column]:
    """FULLPAGENAME, NAMESPACE, PAGENAME (the last segment), BASEPAGENAME, ROOTPAGENAME, SUBPAGENAME (all after the root)."""
    name = without_namespace(title)
    segments = F.split(name, "/", -1)
    n = F.size(segments)
    return {
        "fullpagename": title,
        "namespace": namespace_of(title),
        "pagename": F.element_at(segments, -1),
        "basepagename": F.when(n > 1, F.array_join(F.slice(segments, 1, F.greatest(n - 1, F.lit(1))), "/")).otherwise(name),
        "rootpagename": F.element_at(segments, 1),
        "subpagename": F.when(n > 1, F.array_join(F.slice(segments, 2, F.greatest(n - 1, F.lit(1))), "/")).otherwise(name),
    }


def canonical_namespace(ns: Column) -> Column:
    """The canonical name of a namespace number or name; unknown ones come back as they are."""
    known = F.create_map(*[F.lit(x) for kv in NAMESPACES.items() for x in kv])
    return F.coalesce(F.try_element_at(known, F.lower(F.trim(ns))), ns)


def join_path(*parts: Column) -> Column:
    """Path with single slashes."""
    return F.regexp_replace(F.concat_ws("/", *parts), "/+", "/")


# --- numbers ------------------------------------------------------------------------------------


def round_half_up(x: Column, n: int = 0) -> Column:
    """Rounds halves towards positive infinity."""
    scale = F.lit(10.0**n)
    return F.floor(x * scale + 0.5) / scale


def bit(flags: Column, i: int) -> Column:
    return F.shiftright(flags, i).bitwiseAND(F.lit(1))


def percent_of_span(pos: Column, lower: Column, upper: Column, digits: int = 1) -> Column:
    """Place within [lower, upper] in percent; null where the span is empty."""
    return F.when(upper != lower, F.round((pos - lower) / (upper - lower) * 100, digits))


def marker_percent(pct: Column, slack: float = 5.0) -> Column:
    """Clamped to [0, 100]; null where it lies more than `slack` outside."""
    return F.when(pct.between(-slack, 100 + slack), F.greatest(F.lit(0.0), F.least(F.lit(100.0), pct)))


def _recoloured(colour: Column, applies, light_of, saturation_of) -> Column:
    """A hex colour (3, 4, 6 or 8 digits) with another lightness and saturation and the same hue.

    A channel is the darkest one plus its share of the span between darkest and lightest; the shares
    are the hue and stay. Alpha stays. Other texts come back as they are.
    """
    digits = F.substr(colour, F.lit(2))
    short = F.regexp_replace(digits, "(.)", "$1$1")
    full = F.when(F.length(digits) <= 4, short).otherwise(digits)
    part = [F.conv(F.substring(full, i, 2), 16, 10).cast("double") / 255 for i in (1, 3, 5)]
    most, least = F.greatest(*part), F.least(*part)
    light, span = (most + least) / 2, most - least
    saturation = F.when(span == 0, F.lit(0.0)).otherwise(span / (1 - F.abs(2 * light - 1)))
    to = light_of(light)
    to_span = (1 - F.abs(2 * to - 1)) * saturation_of(saturation)
    share = [F.when(span == 0, F.lit(0.0)).otherwise((x - least) / span) for x in part]
    new = [F.lpad(F.lower(F.hex(F.greatest(F.lit(0.0), F.least(F.lit(255.0), F.floor((to - to_span / 2 + to_span * x) * 255 + 0.5))).cast("bigint"))), 2, "0") for x in share]
    is_hex = colour.rlike("^#([0-9a-fA-F]{3,4}|[0-9a-fA-F]{6}|[0-9a-fA-F]{8})$")
    return F.when(is_hex & applies(light), F.concat(F.lit("#"), *new, F.substr(full, F.lit(7)))).otherwise(colour)


def dark_text_colour(colour: Column) -> Column:
    """A text colour for dark grounds: dark ones are made lighter and no more than 0.8 saturated."""
    return _recoloured(colour, lambda l: l < 0.5, lambda l: 0.53 + (0.5 - l) * 0.28, lambda s: F.least(s, F.lit(0.8)))


def dark_ground_colour(colour: Column) -> Column:
    """A background for dark pages: light ones are made dark and less saturated."""
    return _recoloured(colour, lambda l: l >= 0.5, lambda l: 0.2 + (l - 0.5) * 0.18, lambda s: s * 0.55)
