"""Catalogue look-ups: search, prefixes, link resolution, redirects, file names."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lorespark.functions.ranking import number_rows
from lorespark.functions.strings import namespace_of, without_namespace
from lorespark.functions.titles import clean_title, lc_first, uc_first
from lorespark.session import materialise


def entries(manifest: DataFrame) -> DataFrame:
    """(title, path, ord): the catalogue without rows that lack a title or path. A repeated title
    keeps its first place and takes its last path."""
    rows = manifest.where("title <> '' AND path <> ''")
    return rows.groupBy("title").agg(F.max_by("path", "ord").alias("path"), F.min("ord").alias("ord"))


def title_from_path(path: Column) -> Column:
    """The title that a file path stands for: first directory as namespace (`Main` is none), the rest the name."""
    bare = F.regexp_replace(F.regexp_replace(path, r"^\.?/+", ""), r"\.(wiki|html)$", "")
    folder, rest = F.substring_index(bare, "/", 1), F.substr(bare, F.instr(bare, "/") + 1)
    return F.when(F.instr(bare, "/") == 0, bare).when(folder == "Main", rest).otherwise(F.concat(folder, F.lit(":"), rest))


def search(titles: DataFrame, query: str, limit: int = 50, excluded: tuple[str, ...] = ()) -> DataFrame:
    """(title, tier): exact matches, then main-namespace names that begin so, then others that begin so,
    then any that contain it; shorter first, then by title. Case is ignored; a blank query finds nothing."""
    q = query.strip().lower()
    t = F.lower("title")
    name = F.lower(without_namespace(F.col("title")))
    ns = namespace_of(F.col("title"))
    tier = F.when((t == q) | (name == q), 1).when(name.startswith(q) & (ns == ""), 2).when(name.startswith(q), 3).when(t.contains(q), 4)
    found = titles.select("title", tier.alias("tier"), F.length("title").alias("n")).where(F.col("tier").isNotNull() & F.lit(q != "") & ~ns.isin(list(excluded)))
    return found.distinct().orderBy("tier", "n", "title").limit(limit).select("title", "tier")


def by_prefix(titles: DataFrame, prefix: str, strip: bool = False) -> DataFrame:
    """(title, shown, ord) of titles that begin with the prefix, in catalogue order."""
    shown = F.substr("title", F.lit(len(prefix) + 1)) if strip else F.col("title")
    return titles.where(F.col("title").startswith(prefix)).select("title", shown.alias("shown"), "ord").orderBy("ord")


def case_variants(title: Column) -> Column:
    """The title and its first-letter variants, also after the first colon, best first."""
    ns, name = namespace_of(title), without_namespace(title)
    whole = [title, uc_first(title), lc_first(title)]
    inner = [F.when(ns != "", F.concat(ns, F.lit(":"), f(name))).otherwise(title) for f in (uc_first, lc_first)]
    return F.array_distinct(F.array(*whole, *inner))


def link_candidates(target: Column, page: Column, aliases: dict[str, str]) -> Column:
    """Titles that a raw target may mean on a page, best first: relative, as it is, with the canonical
    namespace, in the page's namespace, and the case variants of each."""
    t = clean_title(F.substring_index(target, "#", 1))
    inner = F.regexp_replace(t, "^/+|/+$", "")
    relative = F.when(t.startswith("/"), F.concat(page, F.lit("/"), inner)).when(t.startswith("../"), F.concat(F.regexp_replace(page, "/[^/]*$", ""), F.substr(t, F.lit(3))))
    ns = F.lower(namespace_of(t))
    canon = F.lit(None).cast("string")
    for alias, name in aliases.items():
        canon = F.when(ns == alias.lower(), F.concat(F.lit(f"{name}:"), F.trim(without_namespace(t)))).otherwise(canon)
    same = F.when((namespace_of(page) != "") & (namespace_of(t) == ""), F.concat(namespace_of(page), F.lit(":"), t))
    base = F.filter(F.array(relative, t, canon, same), lambda x: x.isNotNull() & (x != ""))
    return F.array_distinct(F.flatten(F.transform(base, case_variants)))


def resolve_links(links: DataFrame, titles: DataFrame, aliases: dict[str, str]) -> DataFrame:
    """`links` (page, target) with `resolved`: the first candidate in the catalogue, as it is spelled there, or null."""
    keyed = links.select("page", "target").distinct()
    tried = keyed.select("page", "target", F.posexplode(link_candidates(F.col("target"), F.col("page"), aliases)).alias("priority", "title"))
    hit = tried.join(titles.select("title").distinct(), "title").groupBy("page", "target").agg(F.min_by("title", "priority").alias("resolved"))
    return links.join(hit, ["page", "target"], "left")


def file_candidates(name: Column) -> Column:
    """Names under which a file may be stored: as it is, its base name, `:`, `/` and spaces as `_`,
    characters that file systems refuse as `_`, and the other case of the first letter."""
    base = F.element_at(F.split(name, "/", -1), -1)
    safe = F.regexp_replace(F.regexp_replace(name, r"[:\s/]+", "_"), r'[<>"|?*\\]', "_")
    first = F.substring(safe, 1, 1)
    swapped = F.concat(F.when(first == F.upper(first), F.lower(first)).otherwise(F.upper(first)), F.substr(safe, F.lit(2)))
    return F.array_distinct(F.filter(F.array(name, base, safe, swapped), lambda x: x.isNotNull() & (x != "")))


def probe_files(wanted: DataFrame, stored: DataFrame) -> DataFrame:
    """(name, stored_name, known): the first candidate that is stored; `known` is false where none is."""
    tried = wanted.select("name").distinct().select("name", F.posexplode(file_candidates(F.col("name"))).alias("rank_no", "stored_name"))
    hit = tried.join(stored.select("stored_name").distinct(), "stored_name").groupBy("name").agg(F.min_by("stored_name", "rank_no").alias("stored_name"))
    return wanted.join(hit, "name", "left").withColumn("known", F.col("stored_name").isNotNull())


def href_titles(links: DataFrame, titles: DataFrame, folder: str = "") -> DataFrame:
    """`links` (.., target) with `resolved`: the title in the catalogue that a path below `folder` stands for, or null.

    Percent-encoding is undone; underscores, spaces and direction marks do not count. Of titles
    alike in this form the least is taken.
    """
    bare = F.regexp_replace("target", f"^/*{folder}", "")
    name = clean_title(F.coalesce(F.try_url_decode(bare), bare))
    known = titles.select(clean_title(F.col("title")).alias("__name"), F.col("title").alias("resolved")).groupBy("__name").agg(F.min("resolved").alias("resolved"))
    return links.withColumn("__name", name).join(known, "__name", "left").drop("__name")


def exists_or_unknown(names: DataFrame, probed: DataFrame) -> DataFrame:
    """`names` (name) with `present`: true where a probe (name, stored_name) found the file or none was made yet, false where one found nothing."""
    state = probed.groupBy("name").agg(F.max(F.col("stored_name").isNotNull()).alias("found"))
    return names.join(state, "name", "left").withColumn("present", F.coalesce("found", F.lit(True))).drop("found")


def follow_redirects(redirects: DataFrame, hops: int = 5) -> DataFrame:
    """(source, target, hops): where each redirect ends after at most `hops` steps; loops end where the steps do.

    Every round is one equi-join of what is still moving with the redirect table.
    """
    one = redirects.where("source IS NOT NULL AND target IS NOT NULL").groupBy("source").agg(F.min("target").alias("target"))
    at = one.withColumn("hops", F.lit(1))
    step = one.select(F.col("source").alias("target"), F.col("target").alias("further"))
    for _ in range(hops - 1):
        at = at.join(step, "target", "left").select("source", F.coalesce("further", "target").alias("target"), (F.col("hops") + F.col("further").isNotNull().cast("int")).alias("hops"))
    return at


def redirect_targets(pages: DataFrame) -> DataFrame:
    """(source, target) from `#REDIRECT [[T]]`, whose case counts, without fragments."""
    target = F.regexp_extract("content", r"^#(?:REDIRECT|重定向)\s*\[\[([^\]|#]+)", 1)
    return pages.select(clean_title(F.col("title")).alias("source"), clean_title(target).alias("target")).where("target <> ''")


def sites_of(folders: DataFrame) -> DataFrame:
    """Candidate site folders (name, has_pages) without hidden ones and `cache`, those with pages only."""
    return folders.where("has_pages AND NOT name LIKE '.%' AND name <> 'cache'")


def unique_titles(pages: DataFrame, order_col: str = "ord") -> DataFrame:
    """`unique_title`: the second and later pages of a title get ` (pageid)`, in scan order."""
    numbered = number_rows(pages, ["title"], order_col, ["pageid"], "__n")
    suffix = F.concat("title", F.lit(" ("), F.coalesce(F.col("pageid").cast("string"), F.lit("?")), F.lit(")"))
    return numbered.withColumn("unique_title", F.when(F.col("__n") > 1, suffix).otherwise(F.col("title"))).drop("__n")


def assign_paths(pages: DataFrame, order_col: str = "ord") -> DataFrame:
    """`path` for each page: refused characters and trailing dots as `_`, reserved names marked, and `_dupN` on collisions."""
    flat = F.regexp_replace(F.regexp_replace("title", r'[<>:"\\|?*\x00-\x1f]', "_"), r"[. ]+$", "_")
    reserved = F.upper(F.element_at(F.split(flat, "/", -1), -1)).rlike(r"^(CON|PRN|AUX|NUL|COM[1-9]|LPT[1-9])$")
    named = pages.withColumn("__p", F.concat(flat, F.when(reserved, "_").otherwise(""))).withColumn("__k", F.lower("__p"))
    numbered = number_rows(named, ["__k"], order_col, ["title"], "__n")
    suffix = F.when(F.col("__n") > 1, F.concat(F.lit("_dup"), (F.col("__n") - 1).cast("string"))).otherwise("")
    return numbered.withColumn("path", F.concat("__p", suffix, F.lit(".wiki"))).drop("__p", "__k", "__n")


def subset(manifest: DataFrame, namespaces: list[int], titles: DataFrame) -> DataFrame:
    """Catalogue rows of whole namespaces and of single titles."""
    by_title = manifest.where(~F.coalesce(F.col("ns").isin(namespaces), F.lit(False))).join(titles.select("title").distinct(), "title", "left_semi")
    return manifest.where(F.col("ns").isin(namespaces)).unionByName(by_title)


def dependency_subset(start: DataFrame, edges: DataFrame, rounds: int | None = None) -> DataFrame:
    """Titles reachable from `start` (title) over `edges` (src, dst), or in at most `rounds` steps where that is asked for."""
    seen = materialise(start.select("title").distinct())
    front, done = seen, 0
    while rounds is None or done < rounds:
        done += 1
        new = materialise(front.join(edges, F.col("title") == F.col("src")).select(F.col("dst").alias("title")).distinct().join(seen, "title", "left_anti"))
        if new.isEmpty():
            break
        seen = materialise(seen.unionByName(new))
        front = new
    return seen
