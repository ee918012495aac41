"""Every query of the text operators with its SQL counterpart where SQL can express it."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from lorespark.llm import content_model, langid, mixing, neardup, packing, split, termfreq, tokens
from lorespark.llm.sql_structure import SQL_ELEMENTS
from lorespark.session import table


def main_records(spark: SparkSession, d: str) -> DataFrame:
    """Records of the main namespace that are no redirects."""
    start = F.lower(F.substring("content", 1, 9))
    return table(spark, d, "sdv_full").where("ns = 0").where(~start.startswith("#redirect") & ~start.startswith("#重定向"))


def p1_found(spark: SparkSession, d: str) -> DataFrame:
    found = content_model.structure(main_records(spark, d), "rec_no", "content", with_text=False)
    return found.select(F.col("item_key").alias("rec_no"), F.inline("elements")).select("rec_no", "elem_kind", "label")


def p1_clean_text(spark: SparkSession, d: str) -> DataFrame:
    return content_model.structure(main_records(spark, d), "rec_no", "content").select(F.col("item_key").alias("rec_no"), "clean_text", F.size("elements").alias("n_elements"))


def p1_kept(spark: SparkSession, d: str) -> DataFrame:
    """The elements of each record, and whether the clean text has their labels."""
    flat = lambda c: F.regexp_replace(F.regexp_replace(c, r"\$", ""), r"(?U)\s+", " ")
    rows = content_model.structure(main_records(spark, d), "rec_no", "content").select("item_key", flat(F.col("clean_text")).alias("t"), F.explode("elements").alias("e"))
    return rows.select(F.col("item_key").alias("rec_no"), F.col("e.elem_kind"), F.col("e.label"), F.contains("t", flat(F.col("e.label"))).alias("kept"))


def p1_residue(spark: SparkSession, d: str) -> DataFrame:
    """Whether the clean text of a record, code blocks and formulas aside, still has tags, links, calls, comments or categories."""
    text = F.regexp_replace(F.regexp_replace("clean_text", r"(?s)```\n.*?\n```", ""), r"\$[^$\n]+\$", "")
    left = text.rlike(r"(?i)\[\[|\]\]|\{\{|<!--|</?(?:p|div|span|li|ul|ol|h[1-6]|table|tr|td|a|b|i|em|strong|br)\b[^<>]*>|'{3}|\\(?:section|item|begin|href|text\w\w)\b|^Category:")
    rows = content_model.structure(main_records(spark, d), "rec_no", "content").where("clean_text IS NOT NULL")
    return rows.select(F.col("item_key").alias("rec_no"), left.alias("residue"))


def _near(spark: SparkSession, d: str) -> neardup.NearDuplicates:
    return neardup.NearDuplicates(main_records(spark, d), "rec_no", "content", width=3, threshold=0.6, min_words=40)


def p2_found(spark: SparkSession, d: str) -> DataFrame:
    return _near(spark, d).record_pairs().select(F.col("item_a").alias("rec_no_a"), F.col("item_b").alias("rec_no_b"))


def p2_class_pairs(spark: SparkSession, d: str) -> DataFrame:
    return _near(spark, d).pairs()


def p2_membership(spark: SparkSession, d: str) -> DataFrame:
    return _near(spark, d).membership()


def p3_found(spark: SparkSession, d: str) -> DataFrame:
    cuts = split.split_oversized(table(spark, d, "sdv_full"), "rec_no", "content")
    return cuts.select(F.col("item_key").alias("rec_no"), "cut")


def p3_pieces(spark: SparkSession, d: str) -> DataFrame:
    return split.pieces(split.split_oversized(table(spark, d, "sdv_full"), "rec_no", "content"))


def p3_rebuilt(spark: SparkSession, d: str) -> DataFrame:
    """What the pieces of each record add up to once each overlap is taken away, and whether all keep to the limit."""
    pieces = F.col("pieces")
    whole = F.aggregate(pieces, F.lit(""), lambda text, p: F.concat(text, F.when(p["piece_no"] == 0, p["piece"]).otherwise(F.substr(p["piece"], F.lit(split.OVERLAP + 1)))))
    again = F.forall(F.sequence(F.lit(1), F.greatest(F.lit(1), F.size(pieces) - 1)), lambda i: (F.size(pieces) == 1) | F.get(pieces, i)["piece"].startswith(F.right(F.get(pieces, i - 1)["piece"], F.lit(split.OVERLAP))))
    cuts = split.split_oversized(table(spark, d, "sdv_full"), "rec_no", "content")
    return cuts.select(F.col("item_key").alias("rec_no"), F.md5(whole).alias("digest"), F.forall(pieces, lambda p: F.length(p["piece"]) <= split.LIMIT).alias("within"), again.alias("repeats"))


def p6_terms(spark: SparkSession, d: str) -> DataFrame:
    return termfreq.marked_terms(table(spark, d, "sdv_full"), "content")


def p6_found(spark: SparkSession, d: str) -> DataFrame:
    return p6_terms(spark, d).where("mark <> 'useful'").select("term", "mark")


def _languages(spark: SparkSession, d: str) -> DataFrame:
    return langid.detect(table(spark, d, "documents"), "doc_id", "text", "lang")


def p9_found(spark: SparkSession, d: str) -> DataFrame:
    cases = _languages(spark, d).where("relabel").select(F.col("item_key").alias("doc_id"), F.explode("languages").alias("l"))
    return cases.where("l.lang <> 'und'").select("doc_id", F.col("l.lang").alias("lang"))


def p9_segments(spark: SparkSession, d: str) -> DataFrame:
    return _languages(spark, d).select(F.col("item_key").alias("doc_id"), F.inline("segments"))


def _profiles(spark: SparkSession, d: str) -> dict[str, tuple[int, int]]:
    return {r["profile"]: (r["capacity_tokens"], r["separator_tokens"]) for r in table(spark, d, "pack_profiles").collect()}


def p7_assignments(spark: SparkSession, d: str) -> DataFrame:
    sizes = tokens.token_sizes(table(spark, d, "documents"), ["doc_id"], "text")
    return packing.pack(sizes, "doc_id", "n_tokens", _profiles(spark, d)).withColumnRenamed("item", "doc_id")


def p7_placed(spark: SparkSession, d: str) -> DataFrame:
    """For each profile and document, whether all its tokens lie in containers once, whole unless they exceed the capacity,
    and whether none of its containers is overfull."""
    profiles = _profiles(spark, d)
    packed = p7_assignments(spark, d)
    used = packed.groupBy("profile", "container").agg((F.sum("n_tokens") + (F.count("*") - 1) * _of(profiles, 1)).alias("used"))
    parts = packed.join(used, ["profile", "container"]).groupBy("profile", "doc_id").agg(F.sum("n_tokens").alias("t"), F.max(F.col("token_start") + F.col("n_tokens")).alias("end"), F.count("*").alias("parts"), F.max("used").alias("used"))
    once = (F.col("t") == F.col("end")) & (F.col("parts") == F.ceil(F.col("t") / _of(profiles, 0)))
    return parts.select("profile", "doc_id", once.alias("once"), (F.col("used") <= _of(profiles, 0)).alias("fits"))


def p7_full(spark: SparkSession, d: str) -> DataFrame:
    """For each profile, whether containers are at least 0.9 full on the whole and at most one in a hundred is half empty."""
    fill = packing.fill_report(p7_assignments(spark, d), _profiles(spark, d))
    return fill.select("profile", (F.col("fill") >= 0.9).alias("full"), (F.col("up_to_half") <= F.greatest(F.lit(1.0), F.col("containers") / 100)).alias("few_half_empty"))


def _of(profiles: dict[str, tuple[int, int]], at: int) -> Column:
    out = F.lit(None).cast("bigint")
    for name, values in profiles.items():
        out = F.when(F.col("profile") == name, F.lit(values[at])).otherwise(out)
    return out


def p7_fill(spark: SparkSession, d: str) -> DataFrame:
    return packing.fill_report(p7_assignments(spark, d), _profiles(spark, d))


def _mixture(spark: SparkSession, d: str) -> mixing.Mixture:
    sizes = tokens.token_sizes(table(spark, d, "documents"), ["doc_id", "source"], "text")
    return mixing.Mixture(sizes.withColumnRenamed("doc_id", "item"), table(spark, d, "mix_targets"))


def p8_schedule(spark: SparkSession, d: str) -> DataFrame:
    return _mixture(spark, d).schedule().withColumnRenamed("item", "doc_id")


def p8_bounds(spark: SparkSession, d: str) -> DataFrame:
    """For each mix and source, whether its share is within 0.01 of its target (scaled to the sources that have
    documents, and beside the one block by which a short mix may miss it) and its documents are not repeated too often."""
    shares = _mixture(spark, d).shares()
    total = Window.partitionBy("mix")
    stocked = F.col("tokens") > 0
    want = F.when(stocked, F.col("target_share")).otherwise(0) / F.sum(F.when(stocked, F.col("target_share"))).over(total)
    near = F.abs(F.col("actual_share") - F.coalesce(want, F.lit(0.0))) <= 0.01 + 2.0 * mixing.BLOCK_TOKENS / F.greatest(F.sum("tokens").over(total), F.lit(1))
    return shares.select("mix", "source", near.alias("near"), (F.col("repeats") <= F.coalesce("max_repeats", F.lit(0))).alias("within"))


def p8_shares(spark: SparkSession, d: str) -> DataFrame:
    return _mixture(spark, d).shares()


QUERIES = {"p7_assignments": p7_assignments, "p7_fill": p7_fill, "p7_placed": p7_placed, "p7_full": p7_full, "p8_bounds": p8_bounds, "p8_schedule": p8_schedule, "p8_shares": p8_shares, "p9_found": p9_found, "p9_segments": p9_segments, "p1_found": p1_found, "p1_clean_text": p1_clean_text, "p1_kept": p1_kept, "p1_residue": p1_residue, "p2_found": p2_found, "p2_class_pairs": p2_class_pairs, "p2_membership": p2_membership, "p3_found": p3_found, "p3_pieces": p3_pieces, "p3_rebuilt": p3_rebuilt, "p6_found": p6_found, "p6_terms": p6_terms}

# NFC and half-width letters are all that NFKC changes in the test tables.
_SQL_TERMS = r"""
WITH t AS (SELECT row, unnest(regexp_extract_all(replace(replace(lower(translate(nfc_normalize(content), 'ａｂｃｄｅｆｇｈｉｊｋｌｍｎｏｐｑｒｓｔｕｖｗｘｙｚＡＢＣＤＥＦＧＨＩＪＫＬＭＮＯＰＱＲＳＴＵＶＷＸＹＺ', 'abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ')), chr(173), ''), chr(8203), ''), '\p{L}+')) AS term FROM (SELECT row_number() OVER () AS row, content FROM sdv_full)),
c AS (SELECT term, count(*) AS occurrences, count(DISTINCT row) AS records FROM t GROUP BY term),
m AS (SELECT *, CASE WHEN records < 3 THEN 'rare' WHEN records >= 0.2 * (SELECT count(*) FROM sdv_full) THEN 'common' ELSE 'useful' END AS mark FROM c)
"""

SQL = {
    "p1_found": SQL_ELEMENTS,
    "p1_kept": f"SELECT *, true AS kept FROM ({SQL_ELEMENTS})",
    "p1_residue": "SELECT rec_no, false AS residue FROM sdv_full WHERE ns = 0 AND content IS NOT NULL AND NOT starts_with(lower(content), '#redirect') AND NOT starts_with(content, '#重定向')",
    "p6_found": _SQL_TERMS + "SELECT term, mark FROM m WHERE mark <> 'useful'",
    "p6_terms": _SQL_TERMS + "SELECT * FROM m",
    # All records that share a triple meet here, which only small tables allow.
    "p2_found": r"""
WITH w AS (SELECT rec_no, regexp_extract_all(lower(content), '[\p{L}\p{Nd}]+') AS w FROM sdv_full WHERE ns = 0 AND NOT starts_with(lower(content), '#redirect') AND NOT starts_with(content, '#重定向')),
s AS (SELECT DISTINCT rec_no, hash(w[i], w[i + 1], w[i + 2]) AS h FROM (SELECT rec_no, w, unnest(range(1, len(w) - 1)) AS i FROM w WHERE len(w) >= 40)),
n AS (SELECT rec_no, count(*) AS n FROM s GROUP BY rec_no),
i AS (SELECT a.rec_no AS rec_no_a, b.rec_no AS rec_no_b, count(*) AS c FROM s a JOIN s b ON a.h = b.h AND a.rec_no < b.rec_no GROUP BY ALL)
SELECT rec_no_a, rec_no_b FROM i JOIN n x ON x.rec_no = rec_no_a JOIN n y ON y.rec_no = rec_no_b WHERE c >= 0.6 * (x.n + y.n - c)
""",
    "p7_placed": "SELECT profile, doc_id, true AS once, true AS fits FROM pack_profiles, documents WHERE text <> ''",
    "p7_full": "SELECT profile, true AS full, true AS few_half_empty FROM pack_profiles",
    "p8_bounds": "SELECT mix, replace(lower(trim(source)), '-', '_') AS source, true AS near, true AS within FROM mix_targets",
    "p3_rebuilt": "SELECT rec_no, md5(content) AS digest, true AS within, true AS repeats FROM sdv_full WHERE length(content) > 6000",
    "p3_found": r"""
WITH big AS (SELECT rec_no, string_split(replace(content, chr(13) || chr(10), chr(10)), chr(10)) AS line FROM sdv_full WHERE length(content) > 6000),
par AS (
  SELECT rec_no, no, n, blank, sum(blank) OVER (PARTITION BY rec_no ORDER BY no) AS run
  FROM (SELECT rec_no, no, length(line[no]) AS n, CASE WHEN regexp_matches(line[no], '\S') THEN 0 ELSE 1 END AS blank
        FROM (SELECT rec_no, line, unnest(range(1, len(line) + 1)) AS no FROM big)))
SELECT rec_no, CASE WHEN max(longest) > 6000 THEN 'hard' WHEN max(joined) > 6000 THEN 'line' ELSE 'paragraph' END AS cut
FROM (SELECT rec_no, run, max(n) AS longest, coalesce(sum(n + 1) FILTER (WHERE blank = 0) - 1, 0) AS joined FROM par GROUP BY rec_no, run)
GROUP BY rec_no
""",
}
