"""Operators 11 to 13 against plain versions."""

import math
import re
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from regiflow.llm import lexical, mixing, whitening
from tests.llm.data import LOWER, frame, texts, words

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


# ---------------------------------------------------------------- 11

VECTORS = "vec_id long, embedding array<float>, label int, n long, component int"


def vectors(spark, rows):
    return spark.createDataFrame([(i, v, 0, 1, 2) for i, v in rows], VECTORS).repartition(3)


def plain_whitening(rows):
    rows = [(i, v) for i, v in rows if v and all(c is not None and math.isfinite(c) for c in v)]
    x = np.array([[math.floor(64 * float(np.float32(c))) + 1000000 for c in v] for _, v in rows], object)
    n, s = len(rows), x.sum(0)
    dev = ((n * x - s) ** 2).sum(1)
    c = (n * x - s).astype(float) / n
    e, u = np.linalg.eigh(c.T @ c / n)
    return rows, n, dev, c, e[::-1], u[:, ::-1]


@pytest.mark.parametrize("dim,count,fold", [(6, 200, 1), (40, 300, 64)])
def test_whitening(spark, dim, count, fold):
    r = np.random.default_rng(3)
    made = (r.standard_normal((count, dim)) @ r.standard_normal((dim, dim)) * 2).astype(np.float32)
    rows = [(i, [float(c) for c in v]) for i, v in enumerate(made)]
    rows += [(5, rows[5][1])] * 3 + [(None, rows[7][1])]                  # repeated rows, a null id
    bad = [(901, None), (902, []), (903, [None] * dim), (904, [math.nan] * dim), (905, [math.inf] + [0.0] * (dim - 1)), (906, [1.0, 2.0])]
    got = whitening.whiten(vectors(spark, rows + bad), fold=fold).collect()
    kept, n, dev, c, e, u = plain_whitening(rows)
    top = min(32, dim)
    assert len(got) == n * top and {r.n for r in got} == {n}
    assert Counter((r.vec_id, r.deviation) for r in got if r.component == 1) == Counter((i, int(d)) for (i, _), d in zip(kept, dev))
    first = {i: k for k, (i, _) in enumerate(kept)}
    by = defaultdict(dict)
    for row in got:
        by[row.component][row.vec_id] = row
    for k in range(top):
        assert math.isclose(by[k + 1][0].explained, e[k] / e.sum(), rel_tol=1e-9)
        y = c @ u[:, k] / math.sqrt(e[k])
        sign = np.sign(y[first[0]] * by[k + 1][0].whitened)
        assert all(math.isclose(row.whitened, sign * y[first[i]], abs_tol=1e-6) for i, row in by[k + 1].items())
    assert {r.identity_error for r in got} == {got[0].identity_error} and 0 <= got[0].identity_error < 1e-8


def test_whitening_of_flat_and_missing_tables(spark):
    assert whitening.whiten(vectors(spark, [])).count() == 0
    assert whitening.whiten(vectors(spark, [(1, None), (2, [math.nan])])).count() == 0
    one = whitening.whiten(vectors(spark, [(1, [1.0, 2.0])])).collect()
    assert [(r.component, r.n, r.deviation, r.whitened, r.explained, r.identity_error) for r in one] == [(1, 1, 0, None, None, None), (2, 1, 0, None, None, None)]
    flat = whitening.whiten(vectors(spark, [(i, [float(i), 5.0, 2.0 * i]) for i in range(9)])).collect()     # one direction only
    assert all((r.whitened is None) == (r.component > 1) for r in flat) and max(r.identity_error for r in flat) < 1e-9
    large = whitening.whiten(vectors(spark, [(i, [1e9 * i]) for i in range(5)])).collect()
    assert {r.vec_id for r in large} == set(range(5)) and any(r.deviation is None for r in large)


def test_rank_one_updates_and_merge():
    r = np.random.default_rng(4)
    for dim, n in ((12, 50), (30, 10), (4, 100)):
        x = np.floor(r.standard_normal((n, dim)) * 9)
        if dim == 4:
            x[:, 1] = x[:, 0]                                             # a zero eigenvalue: deflated
        parts = [whitening.Spectrum(dim) for _ in range(3)]
        for k, s in enumerate(parts):
            s.add(x[k::3], fold=1)
        total = whitening.Spectrum.of(parts[0].row())
        for s in parts[1:]:
            total.merge(s)
        c = x - x.mean(0)
        m = c.T @ c
        assert total.n == n and list(total.sums) == [int(v) for v in x.sum(0)]
        assert np.abs((total.q * total.d) @ total.q.T - m).max() < 1e-10 * np.abs(m).max()
        assert np.abs(total.q.T @ total.q - np.eye(dim)).max() < 1e-12


def test_secular_roots_close_to_poles():
    d = np.array([0.0, 1.0, 1.0 + 1e-9, 5.0])
    z = np.array([1e-7, 0.5, 0.5, 1e-3])
    origin, t = whitening._roots(d, z * z)
    assert np.allclose(np.sort(origin + t), np.linalg.eigvalsh(np.diag(d) + np.outer(z, z)), atol=1e-14)
    assert all(d <= origin + t)


# ---------------------------------------------------------------- 12

def plain_targets(sizes):
    """Targets by resharing the excess, one capped source after the other."""
    names = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: k % 3 + 1 for k, s in enumerate(names)}
    capped = {}
    while True:
        rest = sum(sizes.values()) - sum(capped.values())
        free = [s for s in names if s not in capped]
        share = {s: rest * weight[s] / sum(weight[f] for f in free) for s in free}
        above = [s for s in free if share[s] > 3 * sizes[s]]
        if not above:
            return share | capped
        capped |= {s: 3 * sizes[s] for s in above}


MIXED = "doc_id long, text string, source string, size string, place int, copies int"


def mixed(spark):
    rows = [(i, "w " * (1 + i * 7 % 90), f"s{i % 4}") for i in range(400)] + [(1000 + i, "a b c", None) for i in range(20)]
    rows += [(2000, "x " * 9000, "s1"), (2001, None, "s2"), (2002, "", "s2"), (2003, None, "empty"), (None, "p q", "É"), (None, "p q", "É")]
    rows += [(3000, "same text here", "tiny")] * 5
    return spark.createDataFrame([(*r, "s", 1, 2) for r in rows], MIXED).repartition(3), rows


@pytest.mark.parametrize("block", [7, 1024])
def test_mix(spark, block):
    docs, rows = mixed(spark)
    m = mixing.mix(docs, block=block)
    got = mixing.taken(m).collect()
    sizes = defaultdict(int)
    for _, t, s in rows:
        sizes[s] += len(words(t))
    target = plain_targets(sizes)
    assert Counter((r.doc_id, r.size, r.source, r.source_size) for r in got) == Counter((i, len(words(t)), s, sizes[s]) for i, t, s in rows)
    took = defaultdict(int)
    for r in got:
        assert math.isclose(r.target, target[r.source], rel_tol=1e-12) and 0 <= r.taken <= 3 * r.size
        took[r.source] += r.taken
    assert all(abs(took[s] - target[s]) <= 0.5 for s in sizes)
    assert sorted(map(str, got)) == sorted(map(str, mixing.taken(mixing.mix(docs.repartition(5), block=block)).collect()))


def test_schedule_is_low_discrepancy(spark):
    docs, _ = mixed(spark)
    slots = [r for r in mixing.mix(docs, block=16).schedule.orderBy("place").collect()]
    assert len({r.place for r in slots}) == len(slots)
    share = Counter(r.source_no for r in slots)
    seen, order = Counter(), defaultdict(list)
    for k, r in enumerate(slots, 1):
        seen[r.source_no] += 1
        order[r.source_no].append((r.epoch, r.block))
        assert all(abs(seen[s] - share[s] * k / len(slots)) <= 2 * math.log2(len(slots)) for s in share)
    assert all(o == sorted(o) and len(set(o)) == len(o) for o in order.values())     # ranks follow the time


def test_bits_and_ranks(spark):
    i = spark.range(64).select(F.col("id"), F.lit(5).cast("long").alias("lo"), F.lit(49).cast("long").alias("hi"))
    got = i.where("id >= lo and id < hi").select("id", mixing.reversed_bits(F.col("id"), 6).alias("t"), mixing.rank(F.col("id"), F.col("lo"), F.col("hi"), 6).alias("r")).collect()
    rev = {k: int(f"{k:06b}"[::-1], 2) for k in range(64)}
    assert all(r.t == rev[r.id] and r.r == sum(rev[k] < rev[r.id] for k in range(5, 49)) for r in got)


def test_mix_of_nothing(spark):
    assert mixing.taken(mixing.mix(spark.createDataFrame([], MIXED))).count() == 0
    only = spark.createDataFrame([(1, None, "a", "s", 1, 2), (2, " ", None, "s", 1, 2)], MIXED)
    assert [(r.taken, r.target) for r in mixing.taken(mixing.mix(only)).collect()] == [(0, 0.0), (0, 0.0)]


# ---------------------------------------------------------------- 13

def plain_search(docs, items, k=10):
    terms = [(i, Counter(TERM.findall((t or "").translate(LOWER)))) for i, t in docs]
    terms = [(i, c) for i, c in terms if c]
    n_all, total = len(terms), sum(sum(c.values()) for _, c in terms)
    df = Counter(t for _, c in terms for t in c)
    out = []
    for q, text in items:
        hits = []
        for i, c in terms:
            m = 10 + 90 * sum(c.values()) * n_all // total
            score = sum(lexical.weight(n_all, df[t]) * (1000000000 * c[t] // (1000 * c[t] + 8 * m)) for t in set(TERM.findall((text or "").translate(LOWER))) if t in c)
            if score > 0:
                hits.append((-score, i is None, i))
        out += [(q, rank, i, -s) for rank, (s, _, i) in enumerate(sorted(hits, key=lambda h: (h[0], h[1], h[2] or 0))[:k], 1)]
    return sorted(out, key=str)


ITEMS = [(1, "One two"), (2, None), (3, ""), (4, "nobody-has this, LINE one; here one"), (5, texts()[7]), (6, texts()[35]), (7, "x" * 5000), (8, "a b c"),
         (8, "line"), (None, "ß one " * 50), (9, texts()[10])]


@pytest.mark.parametrize("shard,terms", [(1 << 22, 1 << 16), (3000, 100)])
def test_search(spark, monkeypatch, shard, terms):
    monkeypatch.setattr(lexical, "SHARD", shard)
    monkeypatch.setattr(lexical, "QUERY_TERMS", terms)
    docs = frame(spark)
    items = spark.createDataFrame([(i, t, 1, "x", 2) for i, t in ITEMS], "item_id int, text string, rank int, doc_id string, score int")
    index = lexical.build_index(docs)
    assert shard > 3000 or index.shards.count() > 5
    got = lexical.search(index, items)
    assert got.columns == ["item_id", "rank", "doc_id", "score"]
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    assert sorted([tuple(r) for r in got.collect()], key=str) == plain_search(rows, ITEMS)


def test_search_visits_few_strata(spark):
    """With a best score that others cannot reach, strata below its bound are left out."""
    seen, names = [], lexical.np
    rows = [(i, "common " * (i % 40 + 1) + f"w{i}") for i in range(400)] + [(900, "needle common")]
    index = lexical.build_index(spark.createDataFrame(rows, "doc_id long, text string"))
    import pyarrow as pa
    table = index.shards.toArrow().combine_chunks().to_batches()[0]
    shard = lexical.Shard({c: table.column(c)[0] for c in table.schema.names})
    entries = shard.entries(pa.array([b"needle", b"common", b"absent"]))
    scores = [shard.impacts(e) * w for e, w in zip(entries, (6000, 3, 1))]
    real = names.add.at
    class Count:                                                             # counts the strata that are added up
        def __getattr__(self, a):
            return getattr(names, a)
        class add:
            @staticmethod
            def at(*x):
                seen.append(1)
                return real(*x)
    lexical.np = Count()
    try:
        hits = shard.best(entries, scores, 1, 1)
    finally:
        lexical.np = names
    assert [shard.ids[d].as_py() for _, d in hits] == [900] and len(seen) == 1 < len(shard.strata)


def test_long_text_is_cut_between_terms(monkeypatch):
    text = ("Añb-cd " * 500 + "z" * 90).encode()
    whole = [(b, int(c)) for b, c in zip(lexical.counted([text])[0].to_pylist(), lexical.counted([text])[3])]
    monkeypatch.setattr(lexical, "SLICE", 64)
    names, doc, term, tf = lexical.counted([text, None, b"cd"])
    assert names.to_pylist() == [b for b, _ in whole] and [(int(d), names[int(t)].as_py(), int(f)) for d, t, f in zip(doc, term, tf)] == [
        (0, b, c) for b, c in whole] + [(2, b"cd", 1)]


def test_search_of_nothing(spark):
    none = spark.createDataFrame([], "doc_id long, text string")
    items = spark.createDataFrame([(1, "one")], "item_id long, text string")
    assert lexical.search(lexical.build_index(none), items).count() == 0
    assert lexical.search(lexical.build_index(frame(spark)), items.limit(0)).count() == 0
