"""Queries of problems 4 and 5."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from lorespark.operators import orphans
from lorespark.operators import smallfiles as sf
from lorespark.session import materialise, table
from lorespark.streaming.pending_orphans import PendingOrphans, by_period


def _files(spark: SparkSession, d: str) -> DataFrame:
    pages = sf.distinct_files(table(spark, d, "manifest"), "title", "manifest")
    images = sf.distinct_files(table(spark, d, "images_manifest"), "name", "images_manifest")
    return sf.small_files(pages.unionByName(images))


def p5_found(spark: SparkSession, d: str) -> DataFrame:
    """The files that the bundles of the plan hold; the plan is written first, as a consolidation would."""
    return materialise(sf.plan_bundles(_files(spark, d))).where("bundle <> ''").select("listing", "file_path")


def p5_plan(spark: SparkSession, d: str) -> DataFrame:
    return sf.plan_bundles(_files(spark, d), bundle_bytes=1 << 20)


def p5_ranges(spark: SparkSession, d: str) -> DataFrame:
    return sf.bundle_ranges(p5_plan(spark, d))


def _state(spark: SparkSession, d: str) -> tuple[PendingOrphans, int]:
    """The pending orphans after a batch for every month."""
    refs = orphans.page_references(table(spark, d, "sdv_full"))
    parents = orphans.page_listings(table(spark, d, "manifest"), table(spark, d, "core_pages"), table(spark, d, "images_manifest"))
    return by_period(refs, parents, orphans.deletion_log(table(spark, d, "page_log")))


def p4_found(spark: SparkSession, d: str) -> DataFrame:
    state, version = _state(spark, d)
    return state.orphans(version).select("rec_no", "ref_title", "status").distinct()


def p4_snapshot(spark: SparkSession, d: str) -> DataFrame:
    state, version = _state(spark, d)
    return state.snapshot(version)


_SQL_FILES = r"""
WITH entry AS (
  SELECT 'manifest' AS listing, title AS name, path, bytes, ord FROM manifest
  UNION ALL SELECT 'images_manifest', name, path, bytes, ord FROM images_manifest),
flat AS (
  SELECT listing, bytes, ord, array_to_string(list_filter(string_split(replace(regexp_replace(path, '^\s+|\s+$', '', 'g'), '\', '/'), '/'), lambda s: s <> '' AND s <> '.'), '/') AS file_path
  FROM entry WHERE name <> '' AND path IS NOT NULL),
file AS (
  SELECT listing, file_path, arg_max(bytes, ord) FILTER (WHERE bytes IS NOT NULL) AS file_bytes
  FROM flat WHERE file_path <> '' GROUP BY ALL)
"""

CANON_SQL = r"""CASE WHEN regexp_matches(t, '(?i)^(category|分类) ?:') THEN 'Category:' || upper(n[1]) || substr(n, 2) WHEN regexp_matches(t, '(?i)^(file|image|文件) ?:') THEN 'File:' || upper(n[1]) || substr(n, 2)
  WHEN regexp_matches(t, '(?i)^(template|模板) ?:') THEN 'Template:' || upper(n[1]) || substr(n, 2) WHEN regexp_matches(t, '(?i)^(module|模块) ?:') THEN 'Module:' || upper(n[1]) || substr(n, 2) ELSE upper(t[1]) || substr(t, 2) END"""
SQL_ORPHANS = (
    r"""
WITH bare AS (
  SELECT rec_no, ns, dumped_at, trim(regexp_replace(regexp_replace(split_part(title, '#', 1), '[\x{061c}\x{200e}\x{200f}\x{202a}-\x{202e}\x{2066}-\x{2069}]', '', 'g'), '[_\s]+', ' ', 'g')) AS title,
    regexp_replace(regexp_replace(content, '(?ism)<!--.*?(?:-->|\z)|^[ \t]*%[^\n]*|<nowiki>.*?</nowiki\s*>|<pre\b[^>]*>.*?</pre\s*>|<source\b[^>]*>.*?</source\s*>|<syntaxhighlight\b[^>]*>.*?</syntaxhighlight\s*>|^[ \t]*```[^\n]*\n.*?^[ \t]*```[ \t]*\r?$|^[ \t]*~~~[^\n]*\n.*?^[ \t]*~~~[ \t]*\r?$|\\begin\{verbatim\}.*?\\end\{verbatim\}|\\begin\{lstlisting\}.*?\\end\{lstlisting\}', chr(10), 'g'), '\{\{\{', chr(1), 'g') AS text, content
  FROM sdv_full),
raw AS (
  SELECT rec_no, dumped_at, title AS raw FROM bare
  UNION ALL SELECT rec_no, dumped_at, unnest(regexp_extract_all(content, '(?:require|loadData)\s*\(?\s*["'']([^"''\n]+)["'']', 1)) FROM bare WHERE ns = 828
  UNION ALL SELECT rec_no, dumped_at, CASE WHEN starts_with(trim(l), '/') THEN title || '/' || trim(split_part(trim(l), '#', 1), '/ ') ELSE l END
    FROM (SELECT *, unnest(regexp_extract_all(text, '\[\[([^\[\]|{}\n\x01]+)(?:\||\]\])', 1)) AS l FROM bare WHERE ns <> 828) WHERE NOT regexp_matches(l, '^\s*:?\s*[a-z]{2}\s*:')
  UNION ALL SELECT rec_no, dumped_at, CASE WHEN starts_with(h, '#') THEN 'Module:' || trim(regexp_extract(h, '(?is)^#invoke\s*:(.*)$', 1)) ELSE 'Template:' || h END
    FROM (SELECT rec_no, dumped_at, unnest(regexp_extract_all(text, '\{\{\s*([^{}|\[\]<>\x01]+?)\s*(?:\||\}\})', 1)) AS h FROM bare WHERE ns <> 828)
    WHERE (NOT starts_with(h, '#') AND NOT regexp_matches(h, '^[A-Z]+(:|$)')) OR regexp_matches(h, '(?i)^#invoke\s*:')
  UNION ALL SELECT rec_no, dumped_at, url_decode(split_part(unnest(regexp_extract_all(text, '(?i)href\s*=\s*"/wiki/([^"]*)"', 1)), '#', 1)) FROM bare WHERE ns <> 828
  UNION ALL SELECT rec_no, dumped_at, url_decode(split_part(unnest(regexp_extract_all(text, '(?i)href\s*=\s*''/wiki/([^'']*)''', 1)), '#', 1)) FROM bare WHERE ns <> 828
  UNION ALL SELECT rec_no, dumped_at, url_decode(split_part(unnest(regexp_extract_all(text, '\]\(/wiki/([^()\s]*)\)', 1)), '#', 1)) FROM bare WHERE ns <> 828
  UNION ALL SELECT rec_no, dumped_at, url_decode(split_part(regexp_replace(unnest(regexp_extract_all(text, '\\href\{/wiki/((?:\\.|[^{}\\])*)\}', 1)), '\\([_%&#$])', '\1', 'g'), '#', 1)) FROM bare WHERE ns <> 828
  UNION ALL SELECT rec_no, dumped_at, CASE WHEN regexp_matches(g, '(?i)^\s*(file|image|文件)\s*:') THEN g ELSE 'File:' || g END
    FROM (SELECT rec_no, dumped_at, trim(split_part(line, '|', 1), ' ' || chr(13)) AS g
          FROM (SELECT rec_no, dumped_at, unnest(string_split(body, chr(10))) AS line FROM (SELECT rec_no, dumped_at, unnest(regexp_extract_all(text, '(?is)<gallery\b[^>]*>(.*?)</gallery\s*>', 1)) AS body FROM bare WHERE ns <> 828))) WHERE g <> ''),
named AS (
  SELECT 'ref' AS what, rec_no, dumped_at AS moment, raw, NULL AS deleted, NULL AS log_id FROM raw
  UNION ALL SELECT 'parent', NULL, listed_at, title, NULL, NULL FROM manifest WHERE title <> '' AND path <> ''
  UNION ALL SELECT 'parent', NULL, listed_at, title, NULL, NULL FROM core_pages
  UNION ALL SELECT 'parent', NULL, listed_at, 'File:' || name, NULL, NULL FROM images_manifest WHERE name <> '' AND path <> ''
  UNION ALL SELECT 'log', NULL, logged_at, title, lower(trim(log_action)) = 'delete', log_id FROM page_log WHERE lower(trim(log_action)) IN ('delete', 'restore')),
form AS (SELECT * EXCLUDE (raw, t, n), """
    + CANON_SQL
    + r""" AS ref_title FROM (SELECT *, trim(substr(t, strpos(t, ':') + 1)) AS n FROM (
  SELECT *, trim(regexp_replace(regexp_replace(regexp_replace(split_part(raw, '#', 1), '[\x{061c}\x{200e}\x{200f}\x{202a}-\x{202e}\x{2066}-\x{2069}]', '', 'g'), '[_\s]+', ' ', 'g'), '^:+ ?', '')) AS t FROM named))),
refs AS (SELECT DISTINCT rec_no, moment AS dumped_at, ref_title FROM form WHERE what = 'ref' AND ref_title <> ''),
parents AS (SELECT ref_title, min(moment) AS first_listed FROM form WHERE what = 'parent' GROUP BY ref_title),
last AS (SELECT r.rec_no, r.ref_title, arg_max(l.deleted, (l.moment, l.log_id)) AS deleted FROM refs r JOIN form l ON l.what = 'log' AND l.ref_title = r.ref_title AND l.moment <= r.dumped_at GROUP BY ALL),
orphan AS (SELECT refs.rec_no, dumped_at, refs.ref_title, CASE WHEN p.ref_title IS NULL THEN 'missing' WHEN deleted THEN 'deleted' WHEN first_listed > dumped_at THEN 'late' END AS status
  FROM refs LEFT JOIN parents p ON p.ref_title = refs.ref_title LEFT JOIN last ON last.rec_no = refs.rec_no AND last.ref_title = refs.ref_title)
"""
)
# One key range holds all small files of the test tables, so bundles count from 0 in each listing.
_SQL_PLAN = (
    _SQL_FILES
    + """, plan AS (SELECT listing, file_path, file_bytes, listing || '-00000-' || lpad(CAST(CAST(coalesce(sum(file_bytes) OVER (PARTITION BY listing ORDER BY file_path ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) // 1048576 AS VARCHAR), 5, '0') AS bundle FROM file WHERE file_bytes < 1024)
"""
)

QUERIES = {"p4_found": p4_found, "p4_snapshot": p4_snapshot, "p5_found": p5_found, "p5_plan": p5_plan, "p5_ranges": p5_ranges}
SQL = {
    "p4_found": SQL_ORPHANS + "SELECT rec_no, ref_title, status FROM orphan WHERE status IS NOT NULL",
    "p4_snapshot": SQL_ORPHANS + "SELECT CASE WHEN starts_with(ref_title, 'File:') THEN 'images_manifest' ELSE 'manifest' END AS target_table, strftime(dumped_at, '%Y-%m') AS period, status, count(*) AS orphan_refs, count(DISTINCT ref_title) AS orphan_titles FROM orphan WHERE status IS NOT NULL GROUP BY ALL",
    "p5_found": _SQL_FILES + "SELECT listing, file_path FROM file WHERE file_bytes < 1024",
    "p5_plan": _SQL_PLAN + "SELECT * FROM plan",
    "p5_ranges": _SQL_PLAN + "SELECT listing, bundle, min(file_path) AS first_path, max(file_path) AS last_path, count(*) AS files, CAST(sum(file_bytes) AS BIGINT) AS total_bytes FROM plan GROUP BY ALL",
}
