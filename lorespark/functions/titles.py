"""Title normalisation and look-up forms as native column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Invisible direction marks, and the namespace names that stand for one another.
DIRECTION_MARKS = "؜‎‏‪-‮⁦-⁩"
NAMESPACE_ALIASES = {
    "category": "Category",
    "分类": "Category",
    "file": "File",
    "image": "File",
    "文件": "File",
    "template": "Template",
    "模板": "Template",
    "module": "Module",
    "模块": "Module",
}
_PREFIX = "(?is)^(" + "|".join(NAMESPACE_ALIASES) + ") ?: ?(.*)$"


def uc_first(c: Column) -> Column:
    return F.concat(F.upper(F.substring(c, 1, 1)), F.substr(c, F.lit(2)))


def lc_first(c: Column) -> Column:
    return F.concat(F.lower(F.substring(c, 1, 1)), F.substr(c, F.lit(2)))


def clean_title(c: Column) -> Column:
    """Direction marks dropped, underscores and white space collapsed to one space, trimmed."""
    return F.trim(F.regexp_replace(F.regexp_replace(c, f"[{DIRECTION_MARKS}]", ""), r"(?U)[_\s]+", " "))


def canonical_title(c: Column) -> Column:
    """The form in which titles are compared; '' if nothing is left, null for null.

    The fragment is dropped, a namespace prefix gets its English spelling without a space after
    it, and the name begins with an upper-case letter.
    """
    t = F.regexp_replace(clean_title(F.substring_index(c, "#", 1)), "^:+ ?", "")
    prefix, name = F.lower(F.regexp_extract(t, _PREFIX, 1)), F.regexp_extract(t, _PREFIX, 2)
    english = F.lit("")
    for alias, canon in NAMESPACE_ALIASES.items():
        english = F.when(prefix == alias, canon + ":").otherwise(english)
    return F.when(prefix == "", uc_first(t)).otherwise(F.when(name == "", F.lit("")).otherwise(F.concat(english, uc_first(name))))
