"""The general operators against brute force, on nulls, ties, repeated rows, hot keys, empty tables and clashing columns."""

import datetime as dt
import ipaddress
import random
from collections import Counter, defaultdict

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from palimpsest.functions import tsql
from palimpsest.functions.address import canonical_ip
from palimpsest.operators.changes import MerkleState, changed_rows, merkle_tree, pages_to_load
from palimpsest.operators import common
from palimpsest.operators.common import first_delivery, salted_lookup, spread
from palimpsest.operators.curate import distinct_users, flag_where_staged, merge_counts, missing_rows, needed_revisions, upsert
from palimpsest.operators.hierarchy import ancestor_pairs, follow_links, hierarchy
from palimpsest.operators.orphans import Reference, orphan_references, orphan_report
from palimpsest.operators.sessions import SPAN_SCHEMA, SessionStore, actor_of, event_spans
from palimpsest.operators.weighted import compress, heavy_keys, weighted_percentile, weighted_totals
from palimpsest.scratch import Scratch, scratch_root

T0 = dt.datetime(2020, 1, 1)


def at(minutes):
    return None if minutes is None else T0 + dt.timedelta(minutes=minutes)


# --- common --------------------------------------------------------------------------------------------------------------------
def test_first_delivery(spark):
    rows = [(1, at(5), "b"), (1, at(3), "a"), (1, None, "z"), (2, at(1), "x"), (2, at(1), "x"), (None, at(0), "n")]
    got = first_delivery(spark.createDataFrame(rows, "k long, loaded_at timestamp_ntz, v string"), "k").collect()
    assert sorted((r.k, r.v) for r in got) == [(1, "a"), (2, "x")]


def test_salted_lookup_and_spread(spark, monkeypatch):
    df = spark.createDataFrame([(1, i) for i in range(100)] + [(None, 7), (9, 8)], "k long, v long")
    out = salted_lookup(df, spark.createDataFrame([(1, "one"), (2, "two")], "k long, name string"), "k")
    assert Counter(r.name for r in out.collect()) == {"one": 100, None: 2}
    monkeypatch.setattr(common, "BROADCAST_ROWS", 0)
    for how, want in (("left", {"one": 100, None: 2}), ("inner", {"one": 100})):
        out = salted_lookup(df, spark.createDataFrame([(1, "one"), (2, "two")], "k long, name string"), "k", how)
        assert Counter(r.name for r in out.collect()) == want
        assert "BroadcastHashJoin" not in out._jdf.queryExecution().toString()
    assert spread(df.coalesce(1)).rdd.getNumPartitions() > 1


def test_scratch_uses_the_shared_folder(spark):
    assert scratch_root(spark) == spark.conf.get("spark.checkpoint.dir")
    df = Scratch(spark, "t").write(spark.range(3))
    assert df.count() == 3 and df._scratch_path.startswith(scratch_root(spark))


# --- orphans -------------------------------------------------------------------------------------------------------------------
CHILD = "id long, loaded_at timestamp_ntz, parent long, ref_key string, month string"
PARENT = "key long, loaded_at timestamp_ntz, deleted_at timestamp_ntz, __n string"


def brute_orphans(children, parents):
    first = {}
    for c in sorted((c for c in children if c[0] is not None), key=lambda c: (c[1] is None, c[1] or T0)):
        first.setdefault(c[0], c)
    known = {}
    for p in sorted((p for p in parents if p[0] is not None), key=lambda p: (p[1] is None, p[1] or T0)):
        known.setdefault(p[0], p)
    out = set()
    for i, when, key, *_ in first.values():
        if key is None:
            continue
        if key not in known:
            out.add((i, "missing"))
            continue
        _, loaded, deleted, *_ = known[key]
        if loaded and when and loaded > when:
            out.add((i, "late"))
        if deleted and when and deleted <= when:
            out.add((i, "deleted"))
    return out


@pytest.mark.parametrize("seed", range(3))
def test_orphans(spark, seed):
    r = random.Random(seed)
    parents = [(r.choice([None, *range(40)]), at(r.choice([None, *range(60)])), at(r.choice([None, None, *range(120)])), "x") for _ in range(50)]
    hot = [(1000 + i, at(r.randrange(100)), 7, "k", "m") for i in range(300)]
    children = [(r.choice([None, *range(90)]), at(r.choice([None, *range(100)])), r.choice([None, *range(60)]), "k", "m") for _ in range(200)] + hot
    parents = list({(p[0], p[1]): p for p in parents}.values())
    children = list({(c[0], c[1]): c for c in children}.values())
    child, parent = spark.createDataFrame(children, CHILD), spark.createDataFrame(parents, PARENT)
    found = orphan_references(
        child, [Reference("P", "parent", parent, "key", "loaded_at", "deleted_at")], child_id="id", keep=["loaded_at"], heavy_share=0.1, bloom_max_bits=64
    ).collect()
    assert {(x.id, x.ref_status) for x in found} == brute_orphans(children, parents)
    assert len(found) == len({(x.id, x.ref_status) for x in found})


def test_orphans_of_empty_tables(spark):
    child = spark.createDataFrame([(1, at(0), 5, "k", "m")], CHILD)
    parent = spark.createDataFrame([], PARENT)
    ref = lambda p: [Reference("P", "parent", p, "key", "loaded_at", "deleted_at")]
    assert [(x.id, x.ref_status) for x in orphan_references(child, ref(parent), child_id="id").collect()] == [(1, "missing")]
    assert orphan_references(child.limit(0), ref(parent), child_id="id").count() == 0
    report = orphan_report(orphan_references(child, ref(parent), child_id="id", keep=["loaded_at"]), "loaded_at").first()
    assert tuple(report) == ("P", "missing", "2020-01", 1)
    with pytest.raises(ValueError, match="missing column"):
        orphan_references(child, [Reference("P", "nope", parent, "key")], child_id="id")


# --- hierarchy -----------------------------------------------------------------------------------------------------------------
def brute_tree(pairs):
    parent = {}
    for n, p in pairs:
        if n is not None:
            parent.setdefault(n, p or 0)
    out = {}
    for n in parent:
        path, seen, x = [], {}, n
        while True:
            if x in seen:
                out[n] = (None, None, None, min(path[seen[x] :]))
                break
            seen[x] = len(path)
            path.append(x)
            up = parent[x]
            if up == 0 or up not in parent:
                out[n] = (x, len(path) - 1, path[::-1], None)
                break
            x = up
    return out


@pytest.mark.parametrize("seed", range(4))
@pytest.mark.parametrize("rows", [5, 1000])
def test_hierarchy(spark, seed, rows):
    r = random.Random(seed)
    ids = list(range(1, 60))
    pairs = [(i, r.choice([None, 0, 999, *r.sample(ids, 3), *([i - 1] * 4)]) if i > 1 else 0) for i in ids]
    df = spark.createDataFrame([(n, p, n % 3, "c") for n, p in pairs] + [(None, 3, 0, "c"), (5, pairs[4][1], 1, "c")], "id long, up long, place long, root string")
    got = hierarchy(df, node="id", parent="up", locality=["place"], rows_per_partition=rows).collect()
    want = brute_tree(pairs)
    assert {x.node: (x.root, x.depth, x.path, x.cycle_id) for x in got} == want and len(got) == len(want)
    short = hierarchy(df, node="id", parent="up", rows_per_partition=rows, with_paths=False).collect()
    assert {x.node: (x.root, x.depth, x.cycle_id) for x in short} == {n: (a, b, c) for n, (a, b, _, c) in want.items()}
    pairs_got = {(x.ancestor, x.descendant, x.distance) for x in ancestor_pairs(hierarchy(df, node="id", parent="up", rows_per_partition=rows)).collect()}
    assert pairs_got == {(a, n, len(p) - 1 - i) for n, (_, _, p, _) in want.items() if p for i, a in enumerate(p[:-1])}


def test_long_chain_and_long_cycle_over_many_partitions(spark):
    chain = [(i, i - 1) for i in range(1, 301)]
    cycle = [(1000 + i, 1000 + (i + 1) % 200) for i in range(200)] + [(5000, 1003), (5001, 5000)]
    df = spark.createDataFrame(chain + cycle, "id long, up long").repartition(4)
    got = {x.node: x for x in hierarchy(df, node="id", parent="up", rows_per_partition=40).collect()}
    assert got[300].depth == 299 and got[300].path == list(range(1, 301)) and got[300].root == 1
    assert {got[n].cycle_id for n, _ in cycle} == {1000} and got[5001].path is None


def test_hierarchy_of_nothing(spark):
    assert hierarchy(spark.createDataFrame([], "id long, up long"), node="id", parent="up").count() == 0


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(0, 12), min_size=1, max_size=12))
def test_follow_links(parents):
    import numpy as np

    node = np.arange(1, len(parents) + 1)
    _, top, hops, _, cycle = follow_links(node, np.array(parents))
    for i, (root, depth, _, c) in enumerate(brute_tree(list(zip(node.tolist(), parents))).values()):
        assert cycle[i] == (-1 if c is None else c)
        if c is None:
            assert (node[top[i]], hops[i]) == (root, depth)


# --- weighted ------------------------------------------------------------------------------------------------------------------
def test_weighted(spark):
    r = random.Random(1)
    rows = [(r.choice([None, 1, 1, 1, 1, 2, 3]), r.choice([None, *range(-5, 2000, 7)]), "w") for _ in range(3000)] + [(4, None, "w")]
    weights = compress(spark.createDataFrame(rows, "k long, v int, weight string"), "k", "v")
    groups = defaultdict(list)
    for k, v, _ in rows:
        if k is not None:
            groups[k].append(v)
    totals = {x.key: x for x in weighted_totals(weights).collect()}
    assert set(totals) == set(groups)
    for k, vs in groups.items():
        t, have = totals[k], sorted(v for v in vs if v is not None)
        assert t.rows == len(vs) and t.distinct_values == len(set(have))
        if have:
            counts = Counter(have)
            best = max(counts.values())
            assert (t.value_min, t.value_max, t.value_sum) == (have[0], have[-1], sum(have))
            assert t.value_mode == min(v for v, c in counts.items() if c == best)
            assert abs(t.value_mean - sum(have) / len(have)) < 1e-9
        else:
            assert (t.value_min, t.value_mean, t.value_mode) == (None, None, None)
    for q in (0.0, 0.5, 0.9, 1.0):
        import math

        got = {x.key: x.p for x in weighted_percentile(weights, q, "p", cell=16).collect()}
        for k, vs in groups.items():
            have = sorted(v for v in vs if v is not None)
            assert got.get(k) == (have[max(1, math.ceil(q * len(have))) - 1] if have else None)
    assert {x.key for x in heavy_keys(weights, len(rows), 0.5).collect()} == {1}
    empty = compress(spark.createDataFrame([], "k long, v int"), "k", "v")
    assert weighted_totals(empty).count() == 0 == weighted_percentile(empty, 0.5, "p").count()


# --- changes -------------------------------------------------------------------------------------------------------------------
def test_changed_rows(spark):
    r = random.Random(3)
    saved = {k: r.randrange(3) for k in r.sample(range(-500, 50_000), 400)}
    now = {**{k: v if r.random() < 0.9 else v + 1 for k, v in saved.items() if r.random() < 0.95}, 60_001: None, 3: 9}
    frame = lambda m: spark.createDataFrame([*m.items()], "k long, v long")
    want = {(k, v) for k, v in now.items() if k not in saved or saved[k] != v}
    assert {tuple(x) for x in changed_rows(frame(now), frame(saved), "k", ["v"], 64).collect()} == want
    assert changed_rows(frame(now), frame(now), "k", ["v"]).count() == 0
    assert changed_rows(frame(now), frame(saved).limit(0), "k", ["v"]).count() == len(now)
    assert changed_rows(frame(saved).limit(0), frame(saved), "k", ["v"]).count() == 0


def test_tree_ignores_order_and_counts_repeats(spark):
    df = spark.createDataFrame([(1, 1), (2, 5), (70, 1)], "k long, v long")
    as_set = lambda d: {tuple(x) for x in merkle_tree(d, "k", ["v"], 64).collect()}
    assert as_set(df) == as_set(df.orderBy(F.desc("k")).repartition(3)) != as_set(df.unionByName(df.limit(1)))


def test_merkle_state_survives_a_failed_run(spark, tmp_path, monkeypatch):
    state = MerkleState(spark, str(tmp_path / "m"), "k", ["v"], 8)
    frame = lambda m: spark.createDataFrame([*m.items()], "k long, v long")
    assert {tuple(x) for x in state.run(frame({1: 1, 2: 1})).collect()} == {(1, 1), (2, 1)}
    from palimpsest import commits

    def die(*_):
        raise RuntimeError("lost")

    with monkeypatch.context() as m:
        m.setattr(commits, "publish", die)
        with pytest.raises(RuntimeError):
            state.run(frame({1: 1, 2: 2, 3: 1}))
    assert {tuple(x) for x in state.run(frame({1: 1, 2: 2, 3: 1})).collect()} == {(2, 2), (3, 1)}
    assert state.run(frame({1: 1, 2: 2, 3: 1})).count() == 0


def test_a_row_that_arrives_during_a_run_is_output_by_the_next(spark, tmp_path, monkeypatch):
    source, frame = str(tmp_path / "source"), lambda *ks: spark.createDataFrame([(k, 1) for k in ks], "k long, v long")
    frame(1, 2).write.parquet(source)
    state = MerkleState(spark, str(tmp_path / "m"), "k", ["v"], 8)
    import palimpsest.operators.changes as changes

    plain = changes.merkle_tree

    def and_a_row_arrives(*a, **kw):
        frame(3).write.mode("append").parquet(source)
        return plain(*a, **kw)

    with monkeypatch.context() as m:
        m.setattr(changes, "merkle_tree", and_a_row_arrives)
        first = {x.k for x in state.run(spark.read.parquet(source)).collect()}
    second = {x.k for x in state.run(spark.read.parquet(source).distinct()).collect()}
    assert first == {1, 2} and second == {3}
    assert {x.k for x in state.read("rows").collect()} == {1, 2, 3}


def test_two_writers_lose_no_commit(spark, tmp_path):
    from palimpsest import commits

    root = str(tmp_path / "m")
    one, two = (MerkleState(spark, root, "k", ["v"], 8) for _ in range(2))
    frame = lambda *ks: spark.createDataFrame([(k, 1) for k in ks], "k long, v long")
    one.run(frame(1))
    base, state = commits.latest(spark, root)
    two.run(frame(1, 2))
    with pytest.raises(commits.Conflict):
        commits.publish(spark, root, base, state)
    assert {x.k for x in one.run(frame(1, 2, 3)).collect()} == {3}


def test_only_changed_parts_are_rewritten_and_old_versions_go(spark, tmp_path):
    from palimpsest import commits

    root = str(tmp_path / "m")
    state = MerkleState(spark, root, "k", ["v"], leaf_width=4, part_width=2)
    frame = lambda m: spark.createDataFrame([*m.items()], "k long, v long")
    rows = {k: 1 for k in range(-16, 40)}
    state.run(frame(rows))
    before = commits.latest(spark, root)[1]["parts"]
    rows[5] = 2
    del rows[39]
    assert {tuple(x) for x in state.run(frame(rows)).collect()} == {(5, 2)}
    after = commits.latest(spark, root)[1]["parts"]
    assert {n for n in after if after[n] != before[n]} == {"0", "4"}
    assert {x.k: x.v for x in state.read("rows").collect()} == rows
    assert state.expire(1) and {x.k: x.v for x in state.read("rows").collect()} == rows


def test_pages_to_load_cases(spark):
    entries = [("f", at(0), 0, 1, 10), ("f", at(0), 50, 2, 20), ("f", at(0), 90, 3, 30), ("g", at(0), 0, 1, 15), ("h", at(0), 0, 4, 1), ("h", at(0), 0, 4, 1)]
    runs = [(1, "f", at(0), None), (2, "g", at(0), "Success"), (3, "h", at(1), "Success"), (4, "h", at(0), "success")]
    reports = [(1, 40, None), (1, None, 2), (9, 999, 3), (4, None, 77)]
    e = spark.createDataFrame(entries, "source_file_name string, source_file_timestamp timestamp_ntz, file_position long, page_id long, latest_revision_id long")
    r = spark.createDataFrame(runs, "run_id long, source_file_name string, source_file_timestamp timestamp_ntz, result string")
    p = spark.createDataFrame(reports, "run_id long, file_position long, page_id long")
    assert {tuple(x) for x in pages_to_load(e, r, p).collect()} == {(3, 30), (4, 1)}
    assert {x.page_id for x in pages_to_load(e, r.limit(0), p).collect()} == {1, 2, 3, 4}
    assert pages_to_load(e.limit(0), r, p).count() == 0


# --- sessions ------------------------------------------------------------------------------------------------------------------
def brute_sessions(events, gap=60):
    by = defaultdict(list)
    for i, a, m in events:
        if a is not None and m is not None:
            by[a].append((m, i))
    out = set()
    for a, xs in by.items():
        run = []
        for m, i in sorted(xs):
            if run and m - run[-1][0] > gap:
                out.add((a, run[0][0], run[-1][0], len(run), min(x[1] for x in run), max(x[1] for x in run)))
                run = []
            run.append((m, i))
        out.add((a, run[0][0], run[-1][0], len(run), min(x[1] for x in run), max(x[1] for x in run)))
    return out


@pytest.mark.parametrize("seed", range(3))
def test_sessions_in_any_batches(spark, tmp_path, seed):
    r = random.Random(seed)
    events = [(i, r.choice([None, "a", "a", "a", "b", "c"]), r.choice([None, *range(0, 20_000, 15)])) for i in range(700)]
    events += [(1000 + i, "hot", 30 * i) for i in range(400)]  # one session of days, built up out of order
    r.shuffle(events)
    store = SessionStore(spark, str(tmp_path / "s"), 3600, 86_400)
    for part in (events[:300], events[300:600], [], events[600:]):
        df = spark.createDataFrame([(i, a, at(m), "x") for i, a, m in part], "id long, who string, t timestamp_ntz, start string")
        store.apply(event_spans(df, actor=F.col("who"), when="t", event_id="id"))
    base = int((T0 - dt.datetime(1970, 1, 1)).total_seconds()) // 60
    got = {(s.actor, s.start // 60_000_000 - base, s.end // 60_000_000 - base, s.events, s.first_id, s.last_id) for s in store.sessions().collect()}
    assert got == brute_sessions(events)


def test_failed_batch_changes_nothing(spark, tmp_path, monkeypatch):
    from palimpsest import commits

    store = SessionStore(spark, str(tmp_path / "s"))
    assert store.sessions().count() == 0
    spans = lambda *ms: spark.createDataFrame([("a", m * 60_000_000, m * 60_000_000, 1, m, m) for m in ms], SPAN_SCHEMA)
    store.apply(spans(0, 200))
    with monkeypatch.context() as m:
        m.setattr(commits, "publish", lambda *_: (_ for _ in ()).throw(RuntimeError("lost")))
        with pytest.raises(RuntimeError):
            store.apply(spans(50, 100, 150))
    assert {(s.start, s.events) for s in store.sessions().collect()} == {(0, 1), (12_000_000_000, 1)}
    store.apply(spans(50, 100, 150))
    assert [(s.start, s.end, s.events, s.first_id, s.last_id) for s in store.sessions().collect()] == [(0, 12_000_000_000, 5, 0, 200)]


def test_a_batch_reads_only_periods_it_can_meet(spark, tmp_path, monkeypatch):
    store = SessionStore(spark, str(tmp_path / "s"))
    month = 31 * 86_400_000_000
    spans = lambda *ms: spark.createDataFrame([("a", t := m * month + d * 86_400_000_000, t, 1, m, m) for m in ms for d in (3, 9)], SPAN_SCHEMA)
    read = []
    monkeypatch.setattr(store, "_read", lambda ps, plain=store._read: (read.append(len(ps)), plain(ps))[1])
    for m in range(4):
        store.apply(spans(m))
    assert max(read, default=0) <= 1
    assert store.sessions().count() == 8


def test_period_whose_sessions_all_move_is_left(spark, tmp_path):
    store = SessionStore(spark, str(tmp_path / "s"))
    first = int(dt.datetime(2020, 2, 1, tzinfo=dt.timezone.utc).timestamp()) * 1_000_000
    spans = lambda *ms: spark.createDataFrame([("a", t := first + m * 60_000_000, t, 1, m, m) for m in ms], SPAN_SCHEMA)
    store.apply(spans(10))
    store.apply(spans(-10))
    assert [(s.events, s.first_id, s.last_id) for s in store.sessions().collect()] == [(2, -10, 10)]


def test_revisions_of_unknown_arrival_are_in_sessions(spark, tmp_path):
    from palimpsest.plans.quality import p7_found

    rows = [(i, None if i % 5 == 0 else at(i), i % 3, None, at(100 * i)) for i in range(1, 41)]
    schema = "page_revision_id long, loaded_at timestamp_ntz, contributor_id long, ip_address string, revision_when timestamp_ntz"
    spark.createDataFrame(rows, schema).write.parquet(str(tmp_path / "page_revision.parquet"))
    assert sorted(map(tuple, p7_found(spark, str(tmp_path)).collect())) == [(i, i) for i in range(1, 41)]


def test_addresses(spark):
    forms = [
        "2001:DB8:1:2:0:0:A:B", "2001:0db8:0001:0002:0000:0000:000a:000b", "2001:db8:1:2::a:b", " 10.1.2.3 ", "010.001.02.3", "::ffff:10.1.2.3", "::",
        "0:0:0:0:0:0:0:0", "fe80::1%eth0", "", "  ", None, "unknown host", "::1", "1::",
    ]
    got = [x.c for x in spark.createDataFrame([(f,) for f in forms], "a string").select(canonical_ip(F.col("a")).alias("c")).collect()]
    assert len(set(got[:3])) == 1 and got[3] == got[4] == got[5] == "10.1.2.3" and got[6] == got[7]
    assert got[9:12] == [None, None, None] and got[12] == "unknownhost"
    for f, g in zip(forms, got):
        if f and ":" in f and "%" not in f and "." not in f:
            assert ipaddress.ip_address(f.strip()) == ipaddress.ip_address(g)
    one = spark.createDataFrame([(1, "x"), (None, "10.0.0.1"), (None, None)], "c long, a string")
    assert [r[0] for r in one.select(actor_of("c", "a")).collect()] == ["id:1", "ip:10.0.0.1", None]


# --- curation and dialect ------------------------------------------------------------------------------------------------------
def test_curation(spark):
    known = spark.createDataFrame([(1, 1, True), (1, 2, False), (1, 3, False)], "page_id long, page_revision_id long, text_available boolean")
    new = spark.createDataFrame([(1, 1, True), (1, 2, True), (1, 3, False), (1, 4, False)], known.schema)
    assert {(r.page_revision_id, r.is_new) for r in needed_revisions(new, known).collect()} == {(2, False), (4, True)}
    assert missing_rows(new, known, ["page_revision_id"]).count() == 1
    assert tuple(merge_counts(new, known, ["page_revision_id"]).first()) == (1, 3)
    assert tuple(merge_counts(new.limit(0), known, ["page_revision_id"]).first()) == (0, 0)
    assert {r.page_revision_id: r.text_available for r in flag_where_staged(known, new.where("page_revision_id = 3")).collect()} == {1: True, 2: False, 3: True}
    users = spark.createDataFrame([(1, "new", 9), (1, "old", 3), (None, "x", 1), (2, None, 1)], "contributor_id long, user_name string, page_revision_id long")
    assert [tuple(r) for r in distinct_users(users).collect()] == [(1, "old")]
    old = spark.createDataFrame([(1, "a", "r"), (2, "b", None)], "k long, n string, t string")
    got = upsert(old, spark.createDataFrame([(1, "a", None), (3, "c", "t")], old.schema), ["k"], ["n", "t"])
    assert {tuple(r) for r in got.collect()} == {(1, "a", None), (2, "b", None), (3, "c", "t")}


def test_dialect(spark):
    one = spark.createDataFrame([("a  ", "x/y z", dt.datetime(2020, 1, 1, 13, 0, 59), dt.datetime(2020, 1, 1, 13, 1, 1), "😀")], "s string, p string, a timestamp_ntz, b timestamp_ntz, e string")
    r = one.select(
        tsql.tsql_len(F.col("s")), tsql.after_first(F.col("p"), "/"), tsql.after_first(F.col("s"), "/"), tsql.datediff_boundaries("MINUTE", F.col("a"), F.col("b")),
        tsql.datediff_boundaries("MILLISECOND", F.col("a"), F.col("b")), tsql.iso_seconds(F.col("a")), tsql.iso_seconds(F.col("a"), True),
        tsql.avg_int(F.lit(3), F.lit(2)), tsql.avg_int(F.lit(3), F.lit(0)), tsql.utf16_len(F.col("e")), tsql.ci_like(F.lit("An AfD page"), "%afd%"),
        tsql.ci_in(F.lit("ABC "), ["abc"]), tsql.gzip_length(F.col("s")) > 10,
    ).first()
    assert tuple(r) == (1, "y z", "a  ", 1, 2000, "2020-01-01T13:00:59", "2020-01-01T01:00:59", 1, None, 2, True, True, True)


def test_not_in_is_three_valued(spark):
    spark.createDataFrame([(1,), (2,), (None,)], "k long").createOrReplaceTempView("l")
    assert [r.k for r in spark.sql("SELECT k FROM l WHERE k NOT IN (SELECT 1)").collect()] == [2]
    assert spark.sql("SELECT k FROM l WHERE k NOT IN (SELECT * FROM VALUES (1), (NULL))").count() == 0


def test_core_does_not_need_the_text_operators():
    import pathlib

    root = pathlib.Path(__file__).resolve().parent.parent / "palimpsest"
    for p in root.rglob("*.py"):
        if "llm" not in p.relative_to(root).parts:
            assert "palimpsest.llm" not in p.read_text(), p
            assert "localCheckpoint" not in p.read_text()
