from __future__ import annotations

import datetime as dt
import random

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from lorespark.operators import orphans, smallfiles
from lorespark.sources import sinks, site
from lorespark.streaming.pending_orphans import EVENTS, MissingVersion, PendingOrphans, as_events, by_period

DAY = dt.datetime(2024, 5, 1)


def at(n):
    return DAY + dt.timedelta(hours=n)


def brute(refs, parents, log):
    out = set()
    for rec, t, title in refs:
        first = [l for p, l in parents if p == title]
        if not first:
            out.add((rec, title, "missing"))
            continue
        first = min((x for x in first if x is not None), default=None)
        past = sorted((a, i, d) for p, a, i, d in log if p == title and t is not None and a <= t)
        if past and past[-1][2]:
            out.add((rec, title, "deleted"))
        elif t is not None and first is not None and first > t:
            out.add((rec, title, "late"))
    return out


def history(seed):
    rng = random.Random(seed)
    names = [f"T{i}" for i in range(8)]
    refs = [(i, at(rng.randint(0, 30)) if rng.random() > 0.05 else None, "Hot" if rng.random() < 0.4 else rng.choice(names)) for i in range(300)]
    parents = [(n, at(rng.randint(0, 30))) for n in names[:6] + ["Hot"]]
    log = list({(rng.choice(names + ["Hot"]), at(rng.randint(0, 30)), i, rng.random() < 0.6) for i in range(60)})
    return refs, parents, log


def frames(spark, refs, parents, log):
    return (
        spark.createDataFrame(refs, "rec_no bigint, dumped_at timestamp_ntz, ref_title string"),
        spark.createDataFrame(parents, "ref_title string, first_listed timestamp_ntz"),
        spark.createDataFrame(log, "ref_title string, logged_at timestamp_ntz, log_id bigint, deleted boolean"),
    )


@pytest.mark.parametrize("share", [1 / 256, 0.05])
def test_orphans_against_brute_force(spark, share):
    refs, parents, log = history(1)
    got = orphans.resolve(*frames(spark, refs, parents, log), hot_share=share)
    assert {(r["rec_no"], r["ref_title"], r["status"]) for r in got.collect()} == brute(refs, parents, log)


def test_orphans_of_empty_tables(spark):
    assert orphans.resolve(*frames(spark, [], [], [])).count() == 0
    r = frames(spark, [(1, None, "A")], [], [])
    assert orphans.resolve(*r).first()["status"] == "missing"


def found(df):
    return {(r["rec_no"], r["ref_title"], r["status"]) for r in df.collect()}


def test_pending_orphans_in_any_order(spark, tmp_path):
    refs, parents, log = history(2)
    whole = brute(refs, parents, log)
    state = PendingOrphans(spark, str(tmp_path / "state"))
    batches = [(refs[:100], parents[3:], log[30:]), (refs[100:], [], []), ([], parents[:3], log[:30])]
    for v, (a, b, c) in enumerate(batches, 1):
        state.apply(v, *frames(spark, a, b, c))
        assert found(state.orphans(v)) == brute(*(sum((list(x[i]) for x in batches[:v]), []) for i in range(3)))
    state.apply(3, *frames(spark, *batches[2]))  # a repeated batch changes nothing
    assert found(state.orphans(3)) == whole
    assert state.snapshot(3).agg(F.sum("orphan_refs")).first()[0] == len(whole)
    state.compact(3)
    assert found(state.orphans(3)) == whole and len(list((tmp_path / "state" / "refs").iterdir())) == 1
    state.apply(4, *frames(spark, [(999, at(1), "T7"), (999, at(1), "New")], [("T7", at(0)), ("New", at(40))], []))
    assert found(state.orphans(4)) == brute(refs + [(999, at(1), "T7"), (999, at(1), "New")], parents + [("T7", at(0)), ("New", at(40))], log)


def test_a_gap_in_the_state_is_an_error(spark, tmp_path):
    state = PendingOrphans(spark, str(tmp_path / "state"))
    state.apply(1, *frames(spark, [(1, at(0), "A")], [], []))
    with pytest.raises(MissingVersion):
        state.apply(3, *frames(spark, [], [], []))
    with pytest.raises(MissingVersion):
        state.orphans(2)


def test_pending_orphans_by_period(spark):
    refs, parents, log = history(5)
    r, p, l = frames(spark, refs, parents, log)
    state, version = by_period(r, p, l, "yyyy-MM-dd")
    assert version == 3 and found(state.orphans(version)) == brute(refs, parents, log) == found(orphans.resolve(r, p, l))
    state, version = by_period(*frames(spark, [], [], []))
    assert version == 0 and found(state.orphans(0)) == set()


def test_pending_orphans_stream(spark, tmp_path):
    """References, listings and log entries arrive as a stream, listings and deletions last."""
    refs, parents, log = history(3)
    src = str(tmp_path / "in")
    for part in ((refs, [], []), ([], parents, []), ([], [], log)):
        as_events(*frames(spark, *part)).coalesce(1).write.mode("append").parquet(src)
    state = PendingOrphans(spark, str(tmp_path / "state"))
    q = state.run(spark.readStream.schema(EVENTS).option("maxFilesPerTrigger", 1).parquet(src))
    q.awaitTermination(120)
    assert found(state.orphans(3)) == brute(refs, parents, log)


def test_page_references(spark):
    dump = spark.createDataFrame([(1, "A_b", 0, "[[x]] [[X]] {{t}}", at(1), "extra"), (2, None, 0, "[[/s]]", at(1), ""), (3, "Module:M", 828, "require('Module:N') [[no]]", None, None), (4, "E", None, None, at(2), None)], "rec_no bigint, title string, ns int, content string, dumped_at timestamp_ntz, raw string")
    got = {(r["rec_no"], r["ref_title"]) for r in orphans.page_references(dump).collect()}
    assert got == {(1, "A b"), (1, "X"), (1, "Template:T"), (3, "Module:M"), (3, "Module:N"), (4, "E")}


def test_small_files(spark):
    rows = [("a", " ./x//b.txt", 10, 1), ("a", "x/b.txt", None, 9), ("a", "x\\b.txt", 20, 5), ("", "y", 1, 2), ("n", None, 1, 3), ("n", "./", 1, 3), ("u", "u", None, 4), ("big", "big", 5000, 6), (None, "z", 1, 7)]
    files = smallfiles.distinct_files(spark.createDataFrame(rows, "title string, path string, bytes bigint, ord bigint"), "title", "manifest")
    assert {(r["file_path"], r["file_bytes"]) for r in files.collect()} == {("x/b.txt", 20), ("u", None), ("big", 5000)}
    assert [r["file_path"] for r in smallfiles.small_files(files).collect()] == ["x/b.txt"]
    many = spark.range(1000).select(F.lit("manifest").alias("listing"), F.format_string("f%05d", "id").alias("file_path"), (F.col("id") % 100).alias("file_bytes"))
    plan = smallfiles.plan_bundles(many, bundle_bytes=2000, bundles_per_range=4)
    assert plan.count() == 1000 and plan.select("file_path").distinct().count() == 1000
    ranges = smallfiles.bundle_ranges(plan).orderBy("first_path").collect()
    assert all(a["last_path"] < b["first_path"] for a, b in zip(ranges, ranges[1:])) and all(r["total_bytes"] < 2100 for r in ranges) and len(ranges) < 40
    assert smallfiles.plan_bundles(many.limit(0)).count() == 0


def test_merge_runs(spark, tmp_path):
    """A third of the rows share one key; nulls, empty runs and a clashing column name."""
    k = F.when(F.col("id") % 3 == 0, F.lit("hot")).when(F.col("id") % 50 == 1, F.lit(None)).otherwise(F.format_string("k%04d", F.col("id") * 7 % 900))
    src = spark.range(3000).select(k.alias("k"), F.col("id").alias("run"), F.repeat(F.lit("x"), (F.col("id") % 40).cast("int")).alias("data"))
    src.repartition(40).sortWithinPartitions(F.col("k").asc_nulls_first()).write.parquet(str(tmp_path / "runs"))
    src.limit(0).coalesce(1).write.mode("append").parquet(str(tmp_path / "runs"))
    meta = smallfiles.merge_runs(spark, str(tmp_path / "runs"), ["k"], str(tmp_path / "out"), file_bytes=8000, range_bytes=12_000, held_bytes=2000).collect()
    out = spark.read.parquet(str(tmp_path / "out")).select(*src.columns)
    assert out.count() == 3000 and out.exceptAll(src).count() == 0 and src.exceptAll(out).count() == 0
    assert sum(r["rows"] for r in meta) == 3000 and all(r["bytes"] <= 8000 + 100 for r in meta) and 6 < len(meta) < 40
    at = lambda key: (key["k"] is not None, key["k"] or "")
    ordered = sorted(meta, key=lambda r: r["out_file"])
    assert all(at(a["greatest"]) <= at(b["least"]) for a, b in zip(ordered, ordered[1:]))
    assert len({r["out_file"][:6] for r in ordered if r["least"]["k"] == "hot" == r["greatest"]["k"]}) >= 2  # the hot key fills more than one range
    for r in ordered:  # every file is sorted, and is one file
        files = list((tmp_path / "out" / f"out_file={r['out_file']}").glob("*.parquet"))
        keys = [x["k"] for x in pq.read_table(files[0], columns=["k"]).to_pylist()]
        assert len(files) == 1 and keys == sorted(keys, key=lambda v: (v is not None, v or ""))


def test_merge_runs_refuses_what_is_not_sorted(spark, tmp_path):
    spark.createDataFrame([(2,), (1,)], "k int").coalesce(1).write.parquet(str(tmp_path / "runs"))
    with pytest.raises(Exception, match="not sorted"):
        smallfiles.merge_runs(spark, str(tmp_path / "runs"), ["k"], str(tmp_path / "out"))


def test_site_round_trip(spark, tmp_path):
    pages = spark.createDataFrame([("A:b?", 0, 1, 0, "one"), ("a:b*", 0, 2, 1, "two"), ("T/x", 10, 3, 2, None), ("CON", 0, 4, 3, "c")], "title string, ns int, pageid bigint, ord bigint, content string")
    root = str(tmp_path / "s1")
    listed = sinks.export_pages(pages, root, "s1")
    assert {r["path"] for r in listed.collect()} == {"A_b_.wiki", "a_b__dup1.wiki", "T/x.wiki", "CON_.wiki"}
    assert {(r["path"], r["body"]) for r in site.texts(spark, f"{root}/pages").collect()} == {("A_b_.wiki", "one"), ("a_b__dup1.wiki", "two"), ("CON_.wiki", "c")} | {("T/x.wiki", b) for b in ("", None) if (("T/x.wiki", b) in {(r["path"], r["body"]) for r in site.texts(spark, f"{root}/pages").collect()})}
    (tmp_path / "s1" / "manifest.json").write_text('[{"title":"A","ns":0,"path":"A_b_.wiki"},{"title":"","path":"x"},{"title":"M","path":"gone.wiki"}]')
    assert [(r["title"], r["body"], r["ord"]) for r in site.pages(spark, root).orderBy("ord").collect()] == [("A", "one", 0), ("M", None, 2)]
    (tmp_path / ".hidden" / "pages").mkdir(parents=True)
    (tmp_path / "s2").mkdir()
    found = site.sites(spark, str(tmp_path)).collect()
    assert [(r["name"], r["home_title"]) for r in found] == [("s1", site.DEFAULT_HOME)]
    packed = sinks.pack_pages(spark.createDataFrame([("a.wiki", "x"), ("d/b.wiki", None)], "path string, content string"), str(tmp_path / "zips"))
    assert packed.agg(F.sum("entries")).first()[0] == 2
    entries = site.zip_entries(spark, str(tmp_path / "zips"))
    assert {(r["name"], bytes(r["content"])) for r in entries.collect()} == {("a.wiki", b"x"), ("d/b.wiki", b"")}
    sinks.extract_archive(entries, str(tmp_path / "un"))
    assert (tmp_path / "un" / "a.wiki").read_text() == "x" and not list((tmp_path / "un").rglob("*.part"))
    bad = spark.createDataFrame([("../out.wiki", b"x")], "name string, content binary")
    with pytest.raises(Exception, match="outside"):
        sinks.extract_archive(bad, str(tmp_path / "un"))
    sinks.extract_archive(entries, (tmp_path / "uri").as_uri())
    assert (tmp_path / "uri" / "a.wiki").read_text() == "x"


def test_data_pages(spark, tmp_path):
    (tmp_path / "d.jsonl").write_text('{"title":"a","ns":0,"content":"x"}\nnot json\n{"title":"a","ns":1,"content":"y"}\n')
    assert site.dump(spark, str(tmp_path / "d.jsonl")).count() == 2
    df = spark.createDataFrame([("m", '{"k":"v","l":"w"}'), ("bad", "{"), ("n", None)], "title string, body string")
    assert {(r["name"], r["key"], r["value"]) for r in site.string_maps(df).collect()} == {("m", "k", "v"), ("m", "l", "w")}
    code = spark.createDataFrame([(1, "return {a=1}"), (2, "x"), (3, None)], "id int, code string")
    assert {r["id"]: r["json"] for r in site.lua_tables(code, "id", "code").collect()} == {1: '{"a": 1}', 2: None, 3: None}
    assert site.lua_enums(spark.createDataFrame([(1, 'p.T = {"a"}')], "id int, code string"), "id", "code").first()["label"] == "a"


def test_zim(spark, tmp_path):
    import struct

    import zstandard

    from lorespark.sources import zim

    def cluster(items, kind):
        at = [4 * (len(items) + 1)]
        for x in items:
            at.append(at[-1] + len(x))
        data = struct.pack(f"<{len(at)}I", *at) + b"".join(items)
        return bytes([kind]) + (zstandard.ZstdCompressor().compress(data) if kind == 5 else data)

    mimes = b"text/html\0image/png\0\0"
    import lzma

    packed = cluster([b"PNG"], 1)
    clusters = [cluster([b"<p>a</p>", b"<p>b</p>"], 5), bytes([4]) + lzma.compress(packed[1:])]
    dirents = [struct.pack("<HBcIII", m, 0, b"C", 0, c, b) + u + b"\0\0" for m, c, b, u in ((0, 0, 0, b"a"), (0, 0, 1, b"b"), (1, 1, 0, b"i.png"))] + [struct.pack("<HBcII", 0xFFFF, 0, b"C", 0, 0) + b"r\0\0"]
    mime_at = zim.HEADER.size
    at = mime_at + len(mimes)
    dirent_at = []
    for d in dirents:
        dirent_at.append(at)
        at += len(d)
    url_at, at = at, at + 8 * len(dirents)
    cluster_ptr, at = at, at + 16
    cluster_at = [at, at + len(clusters[0])]
    end = at + sum(map(len, clusters))
    head = zim.HEADER.pack(zim.MAGIC, 5, 0, b"\0" * 16, len(dirents), 2, url_at, 0, cluster_ptr, mime_at, 0, 0, end)
    path = tmp_path / "x.zim"
    path.write_bytes(head + mimes + b"".join(dirents) + struct.pack(f"<{len(dirents)}Q", *dirent_at) + struct.pack("<2Q", *cluster_at) + b"".join(clusters) + b"sum")
    assert {(r["url"], bytes(r["content"])) for r in zim.files(spark, str(path)).collect()} == {("a", b"<p>a</p>"), ("b", b"<p>b</p>"), ("i.png", b"PNG")}
    assert zim.files(spark, str(path), "image/").count() == 1 and zim.entries(spark, str(path)).where("redirect = 0").count() == 1
    (tmp_path / "bad").write_bytes(b"x" * 100)
    with pytest.raises(ValueError):
        zim.header(str(tmp_path / "bad"))


def test_split_pages_and_numbers(spark):
    from lorespark.functions.ranking import number_rows, running_sum
    from lorespark.operators.tables import split_pages

    rows = [("big", i, t) for i, t in enumerate(["intro", "== A ==", "* 1", "* 2", "* 3", "== A ==", "x"])] + [("small", 0, "== A =="), ("small", 1, None)]
    got = {(r["d"], r["part"]): (r["label"], r["lines"]) for r in split_pages(spark.createDataFrame(rows, "d string, n int, t string"), "d", "n", "t", limit=20, items=2).collect()}
    assert got[("small", 0)] == ("A", ["== A ==", ""]) and got[("big", 0)] == ("", ["intro"]) and got[("big", 1)] == ("A", ["== A ==", "* 1", "* 2"]) and got[("big", 2)] == ("", ["* 3"]) or got[("big", 2)][1] == ["* 3"]
    assert got[("big", 3)] == ("A (2)", ["== A ==", "x"])
    sums = running_sum(spark.createDataFrame([("h", i, i % 3) for i in range(50)] + [("h", 49, 5), (None, 1, 4), (None, None, 2), ("n", 1, None)], "k string, o bigint, v int"), ["k"], "o", F.col("v"), "s", width=7).collect()
    want = lambda o: sum(i % 3 for i in range(o + 1)) + 5 * (o == 49)
    assert all(r["s"] == (want(r["o"]) if r["k"] == "h" else {(None, 1): 6, (None, None): 2, ("n", 1): 0}[(r["k"], r["o"])]) for r in sums) and len(sums) == 54
    nums = number_rows(spark.createDataFrame([("h", i) for i in range(50)] + [(None, 3), (None, None)], "k string, o bigint"), ["k"], "o", width=7)
    assert {(r["k"], r["o"]): r["n"] for r in nums.collect()} == {("h", i): i + 1 for i in range(50)} | {(None, None): 1, (None, 3): 2}
