"""Golden dumps: every derivation rule, retention, idempotence, text upgrade, run log."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from palimpsest.ingest import ingest, merge_pages
from palimpsest.operators.curate import ordinal_in_group, retained, thin_nested, thin_texts
from palimpsest.operators.derive import contributor_counts, ingest_statistics, pages_per_namespace, pages_table, revisions_table
from palimpsest.runs import AlreadyLoaded, RunLog
from palimpsest.sources.dump import file_heads, file_status, pages_after, read_dump, read_namespaces, read_range
from palimpsest.sources.store import Store

HEAD = """<mediawiki><siteinfo><namespaces>
<namespace key="-1" case="first-letter">Special</namespace>
<namespace key="0" case="first-letter" />
<namespace key="4" case="first-letter">Project &amp; more</namespace>
</namespaces></siteinfo>
"""


def rev(i, body="<text>t</text>", who="<contributor><username>Ann</username><id>7</id></contributor>", extra="", parent=None):
    up = f"<parentid>{parent}</parentid>" if parent else ""
    return f"<revision><id>{i}</id>{up}<timestamp>2020-01-02T03:04:05Z</timestamp>{who}{extra}{body}</revision>"


def page(i, *revisions, title="T", ns=0, redirect=""):
    return f"<page>\n<title>{title}</title><ns>{ns}</ns><id>{i}</id>{redirect}{''.join(revisions)}\n</page>\n"


def dump(tmp_path, *pages, name="d.xml"):
    path = tmp_path / name
    path.write_text(HEAD + "".join(pages) + "</mediawiki>")
    return str(path)


def by_id(spark, path, **kw):
    return {r.page_revision_id: r for r in revisions_table(read_dump(spark, path), **kw).collect()}


def test_namespaces(spark, tmp_path):
    rows = {tuple(r) for r in read_namespaces(spark, dump(tmp_path, page(1, rev(1)))).collect()}
    assert rows == {(-1, "Special"), (0, ""), (4, "Project & more")}


def test_contributors(spark, tmp_path):
    who = {
        1: "<contributor><username>Ann</username><id>7</id></contributor>",
        2: "<contributor><ip>10.0.0.1</ip></contributor>",
        3: '<contributor deleted="deleted" />',
        4: "<contributor><username>Zero</username><id>0</id></contributor>",
        5: "<contributor><id>9</id></contributor>",
    }
    r = by_id(spark, dump(tmp_path, page(1, *[rev(i, who=w) for i, w in who.items()])))
    got = {i: (x.contributor_id, x.ip_address, x.user_deleted, x.user_name) for i, x in r.items()}
    assert got == {
        1: (7, None, False, "Ann"), 2: (None, "10.0.0.1", False, None), 3: (None, None, True, None), 4: (0, None, False, "Zero"),
        5: (None, None, True, None),
    }


def test_texts(spark, tmp_path):
    bodies = {1: "<text/>", 2: "<text></text>", 3: "<text>  \n </text>", 4: "<text>a &lt;text/&gt; b 😀</text>", 5: "", 6: '<text bytes="3" />'}
    r = by_id(spark, dump(tmp_path, *[page(i, rev(i, body=b)) for i, b in bodies.items()]))
    got = {i: (x.article_text, x.text_deleted, x.text_available, x.article_text_length) for i, x in r.items()}
    assert got == {
        1: (None, True, False, 0), 2: ("", False, True, 0), 3: ("  \n ", False, True, 4), 4: ("a <text/> b 😀", False, True, 13),
        5: (None, True, False, 0), 6: (None, True, False, 0),
    }


def test_comments(spark, tmp_path):
    extra = {1: "<comment/>", 2: "<comment></comment>", 3: "", 4: f"<comment>{'x' * 800}</comment>", 5: f"<comment>y{'x' * 1000}</comment>"}
    r = by_id(spark, dump(tmp_path, page(1, *[rev(i, extra=e) for i, e in extra.items()])))
    assert [r[i].comment for i in (1, 2, 3)] == [None, "", None]
    assert r[4].comment == "x" * 800 and r[5].comment == "y" + "x" * 799


def test_parent_minor_and_time(spark, tmp_path):
    r = by_id(spark, dump(tmp_path, page(1, rev(5, parent=4)), page(2, rev(6, extra="<minor />"))))
    assert (r[5].parent_page_revision_id, r[6].parent_page_revision_id) == (4, 0)
    assert (r[5].is_minor, r[6].is_minor) == (False, True)
    assert r[5].revision_when == dt.datetime(2020, 1, 2, 3, 4, 5)


def test_pages(spark, tmp_path):
    long = "R" * 600
    path = dump(tmp_path, page(1, rev(1), redirect=f'<redirect title="{long}" />'), page(2, title="Ä &amp; 😀", ns=4))
    got = {r.page_id: r for r in pages_table(read_dump(spark, path)).collect()}
    assert got[1].redirect_title == "R" * 510 and got[2].redirect_title is None
    assert (got[2].page_name, got[2].namespace_id) == ("Ä & 😀", 4)
    assert not [r for r in revisions_table(read_dump(spark, path)).collect() if r.page_id == 2]


@pytest.mark.parametrize("n", [1, 2, 100, 101, 102, 250])
def test_retention(spark, tmp_path, n):
    ids = list(range(1, n + 1))
    random.Random(n).shuffle(ids)
    path = dump(tmp_path, page(1, *[rev(i) for i in ids]))
    r = by_id(spark, path)
    kept = {i for i, x in r.items() if x.article_text is not None}
    assert kept == {i for i in range(1, n + 1) if (i - 1) % 100 == 0 or i == n}
    assert all(x.article_text_length == 1 and not x.text_deleted for x in r.values())
    flat = spark.createDataFrame([(1, i, "t", 1) for i in ids], "p long, r long, t string, n int")
    thin = thin_texts(flat, page="p", revision="r", text="t", length="n", compat=True).collect()
    assert {x.r for x in thin if x.t is not None} == kept
    assert all(x.n == (x.r in kept) for x in thin)
    nested = flat.groupBy("p").agg(F.collect_list(F.struct(F.col("r").alias("id"), F.col("t").alias("text"))).alias("a"))
    assert {x["id"] for x in nested.select(thin_nested(F.col("a")).alias("a")).first().a if x["text"]} == kept


def test_retention_follows_the_incremental_rule():
    for n in range(1, 500):
        texts = []
        for i in range(n):
            texts.append(True)
            k = len(texts) - 2
            if k > 0 and k % 100:
                texts[k] = False
        assert [i % 100 == 0 or i == n - 1 for i in range(n)] == texts


def test_compat_length(spark, tmp_path):
    r = by_id(spark, dump(tmp_path, page(1, *[rev(i) for i in (1, 2, 3)])), compat=True)
    assert [r[i].article_text_length for i in (1, 2, 3)] == [1, 0, 1]


def test_ordinals_with_nulls_and_far_orders(spark):
    rows = [(k, o) for k in (1, 2, None) for o in (5, 100_001, -3, 7_000_000)]
    df = spark.createDataFrame(rows + [(1, None)], "g long, o long")
    got = {(r.g, r.o): (r.ordinal, r.group_size) for r in ordinal_in_group(df, "g", "o").collect()}
    assert got[1, None] == (0, 5) and got[1, 7_000_000] == (4, 5)
    assert got[None, -3] == (0, 4) and got[2, 100_001] == (2, 4)
    assert ordinal_in_group(df.limit(0), "g", "o").count() == 0
    assert [r[0] for r in spark.range(3).select(retained(F.col("id"), F.lit(3))).collect()] == [True, False, True]


def test_corrupt_pages_stop_the_load(spark, tmp_path):
    for bad in (page(1, rev(1), rev(1)), page(1, rev(1, who="<contributor></contributor>"))):
        store = Store(spark, str(tmp_path / "s"))
        with pytest.raises(ValueError, match="corrupt"):
            merge_pages(store, read_dump(spark, dump(tmp_path, bad)))
        assert not store.exists()


def test_load_twice_and_superset(spark, tmp_path):
    store = Store(spark, str(tmp_path / "s"))
    first = dump(tmp_path, page(1, rev(1), rev(2)), page(2, rev(3, who="<contributor><username>Bo</username><id>8</id></contributor>")))
    assert vars(merge_pages(store, read_dump(spark, first))) == {"pages": 2, "users": 2, "revisions": 3, "texts": 3}
    assert vars(merge_pages(store, read_dump(spark, first))) == {"pages": 0, "users": 0, "revisions": 0, "texts": 0}
    more = dump(tmp_path, page(1, rev(1), rev(2), rev(4)), page(2, rev(3), redirect='<redirect title="T"/>'), page(9, rev(9)), name="m.xml")
    assert vars(merge_pages(store, read_dump(spark, more))) == {"pages": 1, "users": 0, "revisions": 2, "texts": 2}
    assert {r.page_id: r.redirect_title for r in store.read("page").collect()} == {1: None, 2: "T", 9: None}
    merge_pages(store, read_dump(spark, first))
    assert {r.page_id: r.redirect_title for r in store.read("page").collect()} == {1: None, 2: None, 9: None}
    assert store.read("page_revision").count() == 5 == store.read("page_revision_text").count()


def test_stub_then_full(spark, tmp_path):
    store = Store(spark, str(tmp_path / "s"))
    merge_pages(store, read_dump(spark, dump(tmp_path, page(1, rev(1, body='<text bytes="4"/>')))))
    assert [tuple(r) for r in store.read("page_revision").select("text_available", "text_deleted", "article_text_length").collect()] == [(False, True, 0)]
    got = merge_pages(store, read_dump(spark, dump(tmp_path, page(1, rev(1, body="<text>full</text>")), name="f.xml")))
    assert (got.revisions, got.texts) == (0, 1)
    assert [tuple(r) for r in store.read("page_revision").select("text_available", "text_deleted", "article_text_length").collect()] == [(True, False, 4)]


def test_run_log(spark, tmp_path):
    root = str(tmp_path / "s")
    path = dump(tmp_path, page(1, rev(1)))
    assert ingest(spark, path, root).revisions == 1
    with pytest.raises(AlreadyLoaded):
        ingest(spark, path, root)
    with pytest.raises(AlreadyLoaded):  # the refused run in between does not open the door
        ingest(spark, path, root)
    log = RunLog(Store(spark, root))
    results = [r.result for r in log.runs().collect()]
    assert results == ["d.xml", "d.xml", "Success"]
    steps = {"Read Page", "Insert Page", "Check existing PageRevisions", "Merge Users", "Merge Text", "Insert Namespaces", "Merge PageRevisions"}
    assert {r.activity for r in log.store.read("activity").collect()} == steps
    assert log.store.read("namespace").count() == 3


def test_files_of_one_name_in_two_folders_both_load(spark, tmp_path):
    root = str(tmp_path / "s")
    for n in (1, 2):
        (tmp_path / f"f{n}").mkdir()
        path = dump(tmp_path / f"f{n}", page(n, rev(n)))
        assert ingest(spark, f"file:{path}", root).pages == 1
    assert Store(spark, root).read("page").count() == 2
    with pytest.raises(FileNotFoundError):
        ingest(spark, str(tmp_path / "none.xml"), root)


def test_ranges_share_no_page_and_miss_none(spark, tmp_path):
    path = dump(tmp_path, *[page(i, rev(i, body=f"<text>{'w ' * (i % 9)}{i} é</text>"), title=f"T{i}") for i in range(1, 41)])
    size = len(open(path, "rb").read())
    for step, split in ((size, 97), (100, 64 << 20), (size // 3 + 1, 211)):
        got = []
        for low in range(0, size, step):
            if step < 101 and low > 900:  # a few of the smallest ranges
                break
            got += [r.id for r in read_range(spark, "file:" + path, low, min(low + step, size), split).select("id").collect()]
        assert len(got) == len(set(got)) and (step < 101 or sorted(got) == list(range(1, 41)))


def test_killed_load_resumes_at_the_reported_position(spark, tmp_path, monkeypatch):
    import palimpsest.ingest as module

    path, root, seen = dump(tmp_path, *[page(i, rev(i)) for i in range(1, 13)]), str(tmp_path / "s"), []
    size = len(open(path, "rb").read())
    plain, ranges = module.merge_pages, []

    def die_at_third(*a, **kw):
        if len(seen) == 2:
            raise RuntimeError("lost")
        return plain(*a, **kw)

    with monkeypatch.context() as m:
        m.setattr(module, "merge_pages", die_at_third)
        with pytest.raises(RuntimeError):
            ingest(spark, path, root, chunk_bytes=size // 3, progress=seen.append)
    assert len(seen) == 2 and seen == sorted(seen) and 0 < seen[0] < seen[1] < 100
    monkeypatch.setattr(module, "read_range", lambda s, p, low, high, plain=module.read_range: (ranges.append(low), plain(s, p, low, high))[1])
    loaded = ingest(spark, path, root, chunk_bytes=size // 3, progress=seen.append)
    assert min(ranges) >= 2 * (size // 3) and seen[-1] == 100.0
    assert sorted(r.page_id for r in Store(spark, root).read("page").collect()) == list(range(1, 13))
    assert loaded.report.where("revisions_added = 1").count() == loaded.pages and loaded.idle_pages == 0


def test_only_the_head_is_read_for_namespaces(spark, tmp_path):
    path = dump(tmp_path, *[page(i, rev(i)) for i in range(1, 4)])
    assert [len(h) for h in file_heads(spark, path, 40)] == [40]
    assert list(file_status(spark, str(tmp_path / "*.xml"))) == ["file:" + path]


def test_resume_position(spark, tmp_path):
    log = RunLog(Store(spark, str(tmp_path / "s")))
    when = dt.datetime(2020, 1, 1)
    a = log.start("f", 10, when)
    assert log.resume_position(a, "f", 10, when) == 0
    for position in (5, 9, 7):
        log.report(a, position, 1)
    log.complete(a, "x" * 2000)
    b = log.start("f", 10, when)
    other = log.start("g", 10, when)
    assert log.resume_position(b, "f", 10, when) == 9
    assert log.resume_position(other, "g", 10, when) == 0
    assert log.resume_position(b, "f", 11, when) == 0
    log.complete(b, None)
    runs = {r.run_id: r for r in log.runs().collect()}
    assert len(runs[a].result) == 1024 and runs[b].result is None and runs[b].end_time is not None
    assert [r.file_position for r in log.store.read("run_progress").collect()] == [9]


def test_statistics(spark, tmp_path):
    ip = "<contributor><ip>1.1.1.1</ip></contributor>"
    path = dump(tmp_path, page(1, rev(1, extra="<minor/><comment>ab</comment>"), rev(2, who=ip, extra="<comment>xy</comment>")), page(2, ns=4))
    pages = read_dump(spark, path)
    s = ingest_statistics(pages).first()
    assert (s.pages, s.revisions, s.minor_revisions, s.anonymous_revisions, s.contributors) == (2, 2, 1, 1, 1)
    assert (s.longest_comment_length, s.longest_comment, s.longest_text) == (2, "ab", 1)
    assert [tuple(r) for r in contributor_counts(pages).collect()] == [("Ann", 1)]
    assert {tuple(r) for r in pages_per_namespace(pages).collect()} == {(0, 1), (4, 1)}
    assert pages_after(pages, spark.createDataFrame([(1,)], "page_id long")).select("id").collect() == [(2,)]


def test_store_maintenance(spark, tmp_path):
    store = Store(spark, str(tmp_path / "s"))
    one = spark.createDataFrame([(1, "a"), (1, "b"), (2, "c")], "user_id long, user_name string")
    store.append_missing("user", one, ["user_id"])
    store.append_missing("user", one.unionByName(spark.createDataFrame([(3, "d")], one.schema)), ["user_id"])
    assert sorted(r.user_id for r in store.read("user").collect()) == [1, 2, 3]
    store.compact("user", 1)
    assert store.file_report("user").count() == 1
    store.truncate("user")
    assert store.read("user").count() == 0
    store.drop()
    assert not store.exists()


def test_many_splits(spark, tmp_path):
    path = dump(tmp_path, *[page(i, rev(i, body=f"<text>{'w ' * 50}{i}</text>")) for i in range(1, 101)])
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "2000")
    try:
        pages = read_dump(spark, path)
        assert pages.rdd.getNumPartitions() > 3
        assert sorted(r.id for r in pages.select("id").collect()) == list(range(1, 101))
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)


def test_streamed_directory(spark, tmp_path):
    from palimpsest.streaming.dumps import load_directory

    inbox = tmp_path / "in"
    inbox.mkdir()
    root, mark = str(tmp_path / "s"), str(tmp_path / "c")
    dump(inbox, page(1, rev(1)), name="a.xml")
    load_directory(spark, str(inbox), root, mark).awaitTermination()
    dump(inbox, page(1, rev(1), rev(2)), page(3, rev(3)), name="b.xml")
    load_directory(spark, str(inbox), root, mark).awaitTermination()
    store = Store(spark, root)
    assert sorted(r.page_revision_id for r in store.read("page_revision").collect()) == [1, 2, 3]
    assert store.read("namespace").count() == 3 and {r.result for r in store.read("run").collect()} == {"Success"}


def test_session_windows_keep_a_step_of_the_gap(spark):
    from palimpsest.streaming.dumps import stream_sessions

    t0 = dt.datetime(2020, 1, 1)
    rows = [("a", t0), ("a", t0 + dt.timedelta(minutes=60)), ("a", t0 + dt.timedelta(minutes=121))]
    got = stream_sessions(spark.createDataFrame(rows, "who string, t timestamp"), actor="who", when="t").orderBy("start").collect()
    assert [(r.events, (r.end - r.start).total_seconds()) for r in got] == [(2, 3600), (1, 0)]
