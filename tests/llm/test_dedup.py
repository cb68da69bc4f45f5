"""Operators 1, 2, 5 and 8 against brute force, with awkward rows and empty tables."""

import hashlib
import random
import zlib
from collections import Counter
from decimal import Decimal

import numpy as np
import pytest

from regiflow.llm import graph, neardup, ngram_join, substring, suffix_dedup
from regiflow.llm.graph import components
from tests.llm.data import LOWER, Sets, frame, words


def shingles(text, k):
    w = words((text or "").translate(LOWER))
    return {tuple(w[i:i + k]) for i in range(len(w) - k + 1)} if len(w) >= k else {tuple(w)} if w else set()


@pytest.mark.parametrize("k, percent", [(3, 90), (5, 80)])
def test_jaccard_groups(spark, k, percent):
    df = frame(spark)
    rows = df.collect()
    sets = [shingles(r.text, k) for r in rows]
    groups = Sets(range(len(rows)))
    for a in range(len(rows)):
        for b in range(a):
            if sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b]):
                groups.join(a, b)
    least = {}
    for i, r in enumerate(rows):
        if r.doc_id is not None:
            least[groups.root(i)] = min(r.doc_id, least.get(groups.root(i), r.doc_id))
    expected = Counter((r.doc_id, len(sets[i]), least.get(groups.root(i))) for i, r in enumerate(rows))
    found = ngram_join.near_groups(df, k, percent)
    assert Counter(map(tuple, found.collect())) == expected
    kept = Counter(r.doc_id for r in ngram_join.one_of_each(df, found).collect())
    assert kept == Counter([d for d, _, c in expected if d is not None and d == c] + [None, None])


def test_trie_join_finds_every_pair():
    r = np.random.default_rng(1)
    base = np.unique(r.integers(0, 1 << 60, 60).astype(np.uint64))
    sets = [np.unique(np.concatenate((r.choice(base, r.integers(1, 60), replace=False),
                                      r.integers(0, 1 << 60, r.integers(0, 9)).astype(np.uint64)))) for _ in range(120)]
    for percent in (40, 80, 100):
        got = set(ngram_join.trie_join(sets, list(range(len(sets))), percent))
        assert got == {(a, b) for a in range(len(sets)) for b in range(len(sets)) if a != b
                       and 100 * len(np.intersect1d(sets[a], sets[b])) >= percent * len(np.union1d(sets[a], sets[b]))}


def test_large_groups_of_near_copies(spark, monkeypatch):
    """Members that only some others link to: all are found, with fewer links than rows compared."""
    r = np.random.default_rng(3)
    base, rows = [f"w{i}" for i in range(200)], []
    for i in range(150):
        w = list(base)
        for j in r.choice(200, 1 + i % 5, replace=False):
            w[j] = f"own{i}x{j}"
        rows.append((i, " ".join(w)))
    sets = [shingles(t, 5) for _, t in rows]
    groups = Sets(range(len(rows)))
    linked = [(a, b) for a in groups.up for b in range(a) if 10 * len(sets[a] & sets[b]) >= 8 * len(sets[a] | sets[b])]
    for a, b in linked:
        groups.join(a, b)
    made, full = [], ngram_join._full_links

    def counted(*args):
        made.append((full(*args).count(), args[0].count()))
        return full(*args)

    monkeypatch.setattr(ngram_join, "_full_links", counted)
    monkeypatch.setattr(ngram_join, "UNIT_SETS", 16)
    monkeypatch.setattr(ngram_join, "HUBS", 2)
    found = ngram_join.near_groups(spark.createDataFrame(rows, "doc_id long, text string"), 5, 80)
    assert {x.doc_id: x.component_id for x in found.collect()} == {i: groups.root(i) for i in groups.up}
    (links, compared), = made
    assert len({groups.root(i) for i in groups.up}) > 1 and len(linked) > 3000
    assert links < compared


def test_full_join_of_near_copies_makes_fewer_links_than_members(spark):
    rows = []
    for i in range(60):                                      # every two of them link
        w = [f"w{k}" for k in range(200)]
        w[3 * i] = w[3 * i + 1] = f"own{i}"
        rows.append((7, Decimal(i), 196, zlib.compress(" ".join(w).encode())))
    df = spark.createDataFrame(rows, f"g long, sig {ngram_join.SIG}, n long, body binary")
    none = spark.createDataFrame([], f"sig {ngram_join.SIG}, comp {ngram_join.SIG}")
    members = ngram_join._several(df.select("g", "sig", "n"), none)
    links = ngram_join._full_links(members, df.select("sig", "body"), 5, 80).collect()
    few = ngram_join._hub_links(members.withColumn("is_hub", members["sig"] == 5), df.select("sig", "body"), 5, 80).collect()
    for found, n in ((links, 58 + 59), (few, 59)):           # the full join has two units: the rest, and the rest with one that is "main"
        one = Sets(range(60))
        for x in found:
            one.join(int(x.a), int(x.b))
        assert len(found) == n and {one.root(i) for i in range(60)} == {0}


def test_connecting_links_are_a_forest():
    r = np.random.default_rng(4)
    comp = r.integers(0, 40, 90)
    comp[r.integers(0, 90)] = 39
    pairs = [(int(a), int(b)) for a, b in r.integers(0, 90, (400, 2)) if comp[a] != comp[b]]
    few, every, some = ngram_join.connecting(pairs, comp), Sets(range(40)), Sets(range(40))
    for a, b in pairs:
        every.join(int(comp[a]), int(comp[b]))
    for a, b in few:
        some.join(int(comp[a]), int(comp[b]))
    assert [every.root(c) for c in range(40)] == [some.root(c) for c in range(40)]
    assert len(few) == 40 - len({every.root(c) for c in range(40)}) and ngram_join.connecting([], comp[:0]) == []


def test_components(spark):
    r = np.random.default_rng(2)
    pairs = [(int(a), int(b)) for a, b in r.integers(0, 300, (200, 2))] + [(i, i + 1) for i in range(1000, 1060)] + [(5000, i) for i in range(4000, 4100)]
    groups = Sets({x for p in pairs for x in p})
    for a, b in pairs:
        groups.join(a, b)
    got = dict(map(tuple, components(spark.createDataFrame([*pairs, (None, 4)], "a long, b long")).collect()))
    loops = {a for a, b in pairs if a == b}
    assert all(got.get(i, i if i in loops else None) == groups.root(i) for i in groups.up)
    assert components(spark.createDataFrame([], "a long, b long")).collect() == []


def test_few_links_take_few_tasks_and_many_the_same_result(spark, monkeypatch):
    rng, sc = random.Random(5), spark.sparkContext
    links = spark.createDataFrame([(i, i + rng.choice([1, 7, 40])) for i in range(0, 400, 3)] + [(5, None), (9, 9)], "a long, b long")
    got, tasks = [], []
    before = spark.conf.get("spark.sql.shuffle.partitions"), spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    spark.conf.set("spark.sql.shuffle.partitions", "16")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        for few in (graph.FEW, 0):
            monkeypatch.setattr(graph, "FEW", few)
            sc.setJobGroup(f"components-{few}", "components")
            got.append(sorted(map(tuple, components(links).collect())))
            tracker = sc.statusTracker()
            stages = [tracker.getStageInfo(s) for j in tracker.getJobIdsForGroup(f"components-{few}") for s in tracker.getJobInfo(j).stageIds]
            tasks.append(sum(s.numCompletedTasks for s in stages if s))
    finally:
        sc.setLocalProperty("spark.jobGroup.id", None)
        spark.conf.set("spark.sql.shuffle.partitions", before[0])
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", before[1])
    assert got[0] == got[1] and len(got[0]) > 100
    assert 0 < 3 * tasks[0] < tasks[1]


def test_substring_windows(spark):
    width, df = 35, frame(spark)
    rows = [(r, words(r.text)) for r in df.collect()]
    count = Counter(tuple(w[i:i + width]) for _, w in rows for i in range(len(w) - width + 1))
    expected = Counter()
    for r, w in rows:
        gone = {i + k for i in range(len(w) - width + 1) if count[tuple(w[i:i + width])] > 1 for k in range(width)}
        kept = " ".join(x for i, x in enumerate(w) if i not in gone)
        expected[r.doc_id, len(w), len(gone), hashlib.sha256(kept.encode()).hexdigest()] += 1
    found = substring.dedup_substrings(df, width=width)
    assert Counter(map(tuple, substring.digest(found).collect())) == expected
    assert set(found.columns) == {*df.columns, "kept_text", "removed", "n_removed"} - {"text"}
    assert sum(x[2] for x in expected) > 0


@pytest.mark.parametrize("length, gram", [(400, 32), (50, 8)])
def test_byte_strings(spark, length, gram):
    df = frame(spark)
    rows = [(r, (r.text or "").encode()) for r in df.collect()]
    count = Counter(b[i:i + length] for _, b in rows for i in range(len(b) - length + 1))
    expected = Counter()
    for r, b in rows:
        step = np.zeros(len(b) + 1, int)
        for i in range(len(b) - length + 1):
            if count[b[i:i + length]] > 1:
                step[i] += 1
                step[i + length] -= 1
        gone = np.cumsum(step)[:-1] > 0
        kept = bytes(np.frombuffer(b, np.uint8)[~gone])
        spans = int((np.diff(np.concatenate(([0], gone.astype(int)))) == 1).sum())
        expected[r.doc_id, len(b), int(gone.sum()), spans, hashlib.sha256(kept).hexdigest(), kept.decode(errors="ignore")] += 1
    found = suffix_dedup.dedup_bytes(df, length=length, gram=gram)
    assert Counter(map(tuple, suffix_dedup.digest(found).collect())) == expected
    rest = suffix_dedup.rest_as_text(found, df)
    assert rest.columns == df.columns and rest.count() < len(rows)


@pytest.mark.parametrize("length, gram", [(400, 32), (60, 8)])
def test_hot_anchors_are_split_by_content(spark, length, gram):
    """Anchors with many different stretches go by their windows' hashes, with the same result."""
    r = np.random.default_rng(7)
    some = lambda n: "".join(r.choice(list("abcdefgh "), n))
    line, passage = some(40), some(450)
    rows = [(i, some(300) + (line if i % 3 else passage) + some(300)) for i in range(90)] + [(i, passage * 2) for i in range(90, 94)] + [(94, None), (95, "")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    plain, split = (Counter(map(tuple, suffix_dedup.digest(suffix_dedup.dedup_bytes(df, length=length, gram=gram, hot=h)).collect())) for h in (1 << 15, 3))
    where = Counter(t[i:i + length] for _, t in rows for i in range(len(t or "") - length + 1))
    expected = {}
    for i, t in rows:
        drop = np.zeros(len(t or ""), bool)
        for k in range(len(drop) - length + 1):
            drop[k:k + length] |= where[t[k:k + length]] > 1
        expected[i] = int(drop.sum())
    assert split == plain and {x[0]: x[2] for x in split} == expected and sum(expected.values()) > 90 * 30


def test_levels_agree_with_one_batch():
    """Merging many small batches finds what sorting all at once finds."""
    import pyarrow as pa
    r = np.random.default_rng(3)
    length, gram = 20, 4
    rows = []
    for k in range(40):
        n = int(r.integers(1, 12))
        hi = r.integers(0, length - gram + 1, n)
        lo = np.array([r.integers(0, h + 1) for h in hi])
        data = b"".join(bytes(r.choice([97, 98], int(h + length - x), p=[0.97, 0.03]).astype(np.uint8)) for h, x in zip(hi, lo))
        rows.append((r.integers(0, 3, n).astype(np.uint64).tobytes(), lo.astype(np.int16).tobytes(), hi.astype(np.int16).tobytes(), data, n))
    table = pa.table([pa.array(c) for c in zip(*[x[:4] for x in rows])], names=["keys", "lo", "hi", "bytes"])

    def flags(step):
        e = suffix_dedup.Entries(sum(x[4] for x in rows), length, gram)
        f = suffix_dedup.LevelFamily(e)
        for i in range(0, len(rows), step):
            f.add(e.add(table.slice(i, step)))
        return f.finish()
    whole = flags(len(rows))
    assert whole.any() and (flags(1) == whole).all() and (flags(7) == whole).all()


def test_vectors(spark):
    r = np.random.default_rng(4)
    x = r.standard_normal((400, 16))
    x[100:200] = x[0] + 0.08 * r.standard_normal((100, 16))
    x[200:220] = x[5]
    rows = [(i, [float(v) for v in y], 1) for i, y in enumerate(x)]
    rows += [(900, None, 1), (901, [], 1), (902, [0.0] * 16, 1), (903, [float("nan")] * 16, 1), (904, [None] * 16, 1),
             (905, [float("inf")] + [1.0] * 15, 1), (906, [1.0, 2.0], 1), (907, [2.0, 4.0], 1), (None, rows[5][1], 1), (5, rows[5][1], 1)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")
    good = [(i, np.array(v)) for i, v, _ in rows if v and all(c is not None and np.isfinite(c) for c in v) and any(v)]
    groups, links = Sets(range(len(good))), Counter()
    for a in range(len(good)):
        for b in range(a):
            u, v = good[a][1], good[b][1]
            if len(u) == len(v) and u @ v / np.sqrt((u @ u) * (v @ v)) >= 0.95:
                groups.join(a, b)
                links[a] += 1
                links[b] += 1
    least = {}
    for k, (i, _) in enumerate(good):
        if i is not None:
            least[groups.root(k)] = min(i, least.get(groups.root(k), i))
    expected = Counter((i, links[k], least[groups.root(k)], i is not None and least[groups.root(k)] == i) for k, (i, _) in enumerate(good))
    expected.update((i, 0, i, True) for i in range(900, 906))
    got = Counter(map(tuple, neardup.near_vectors(df, recall=0.999999).collect()))
    assert got == expected


def test_empty_tables(spark):
    none = frame(spark, [])
    assert ngram_join.near_groups(none).collect() == []
    assert substring.dedup_substrings(none).collect() == []
    assert suffix_dedup.dedup_bytes(none).collect() == []
    assert neardup.near_vectors(spark.createDataFrame([], "vec_id long, embedding array<float>, label int")).collect() == []


def test_anchors_spread_over_key_ranges(spark):
    """Anchors are least hashes; dealt by equal cuts of the key space they must still be even."""
    import numpy as np
    from regiflow.llm import blocks as B
    from regiflow.llm.suffix_dedup import GRAM, LENGTH, Anchors
    rng = np.random.default_rng(3)
    import pyarrow as pa
    column = pa.chunked_array([pa.array([" ".join(map(str, rng.integers(0, 10 ** 6, 3000))) for _ in range(40)])])
    keys = np.unique(Anchors(column, LENGTH, GRAM).key)
    share = np.diff(B.cuts(keys, 16)) / len(keys)
    assert len(keys) > 2000 and share.max() < 3 / 16


def test_short_keys_come_back():
    import numpy as np
    from regiflow.llm import blocks as B
    rng = np.random.default_rng(1)
    for n in (0, 1, 2, 1000):
        keys = np.unique(B.short(rng.integers(0, 2 ** 64, n, np.uint64)))
        for part in (keys, keys[n // 3:], keys[:1]):
            assert (B.unpack_short(B.pack_short(part)) == part).all()


def test_vectors_of_many_lengths_and_sizes(spark):
    """No limit on the number of lengths; vectors whose squares overflow or vanish still link."""
    rows = [(2 * d + k, [float(i + 1) for i in range(d)]) for d in range(1, 91) for k in range(2)]
    rows += [(1000, [1e200, 2e200]), (1001, [2e200, 4e200]), (1002, [1e-200, 2e-200]), (1003, [3e-200, -1e-200]), (1004, [1e-320, 2e-320])]
    got = {r.vec_id: r for r in neardup.near_vectors(spark.createDataFrame(rows, "vec_id long, embedding array<double>")).collect()}
    assert all(got[2 * d + 1].component_id == got[2 * d].component_id for d in range(1, 91))
    assert got[1000].component_id == got[1001].component_id == got[1002].component_id == got[4].component_id
    assert got[1003].component_id != got[1000].component_id and got[1000].n_links >= 4


def test_recall_of_the_registered_setting(spark):
    import numpy as np
    rng = np.random.default_rng(11)
    base = rng.standard_normal((1500, 64))
    base /= np.linalg.norm(base, axis=1, keepdims=True)
    side = rng.standard_normal((1500, 64))
    side -= (side * base).sum(1, keepdims=True) * base
    side /= np.linalg.norm(side, axis=1, keepdims=True)
    c = 0.951
    rows = [(i, base[i].tolist()) for i in range(1500)] + [(5000 + i, (c * base[i] + np.sqrt(1 - c * c) * side[i]).tolist()) for i in range(1500)]
    got = {r.vec_id: r.component_id for r in neardup.near_vectors(spark.createDataFrame(rows, "vec_id long, embedding array<double>")).collect()}
    found = sum(got[5000 + i] == got[i] for i in range(1500)) / 1500
    assert found >= 0.98, found
