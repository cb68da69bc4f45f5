"""Operator 1: near-duplicate documents by Jaccard similarity of their n-gram sets.

The global order of n-grams is their document frequency over the whole corpus
(rarest first, ties by hash), counted exactly with ``blocks``.  Two sets can only
be similar enough if they share an n-gram in their rare prefixes, so only prefix
n-grams that a second document has are dealt out; most documents have none.

The sets that meet at a prefix n-gram are joined with a prefix tree: sets in hash
order are stored in a path-compressed trie, a query set walks it from the root,
carries the overlap found so far along the shared path, and leaves a subtree when
the overlap still possible there is too small for the lengths in it, or when the
subtree holds only sets that are connected with the query already.

Copies (equal sets) are one class from the start.  Groups of classes are first
joined as stars around their smallest member.  Groups too large for one trie that
are still in several components then ask with a few more members at a time, as
long as that connects them; what has asked every other member leaves its group.
Only what is left after that is joined in full, in units of bounded size.  A unit
returns the links that connect its components, fewer than it has members, so a
large group of near copies costs its size, not its square.

Defined cases: null and empty texts have no n-grams and link with nothing;
documents with fewer words than ``words`` have one n-gram, their whole sequence;
a null id takes part in links but is never a component's id (null if no member
has an id).
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from regiflow.llm import blocks as B
from regiflow.llm.graph import components, saved, saved_table

UNIT_SETS, UNIT_GRAMS = 256, 100_000     # members of one trie
HUBS = 16                                # members of a large group that ask all others in one turn, about
GAIN = 0.8                               # another turn if the last one left at most this share of the comparisons
SIG = "decimal(38,0)"


# ---------------------------------------------------------------- n-gram sets

def shingles(column, words: int) -> tuple[np.ndarray, np.ndarray]:
    """(n-gram hashes, where each text's sorted distinct set begins)."""
    data, at = B.text_bytes(column)
    h, first = B.word_hashes(data, at, lower=True)
    grams, where = B.window_hashes(h, first, words)
    doc = np.searchsorted(first, where, side="right") - 1
    n = np.diff(first)
    few = np.flatnonzero((n > 0) & (n < words))
    if len(few):
        whole = np.array([B.Rolling(h[first[i]:first[i + 1]], B.WORD_BASE).spans(
            np.zeros(1, np.int64), n[i:i + 1])[0] for i in few], np.uint64)
        grams = np.concatenate((grams, B.mix(whole + n[few].astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))))
        doc = np.concatenate((doc, few))
    order = np.lexsort((grams, doc))
    grams, doc = grams[order], doc[order]
    new = np.ones(len(grams), bool)
    new[1:] = (grams[1:] != grams[:-1]) | (doc[1:] != doc[:-1])
    grams, doc = grams[new], doc[new]
    return grams, np.searchsorted(doc, np.arange(len(at)))


def signatures(grams: np.ndarray, at: np.ndarray) -> pa.Array:
    """120 bits of each set, equal for equal sets; null for an empty set."""
    n = np.diff(at)
    full = np.flatnonzero(n)
    words = np.zeros((len(n), 2), np.uint64)
    if len(full):
        words[full, 0] = np.add.reduceat(B.mix(grams ^ np.uint64(0x5851F42D4C957F2D)), at[full])
        words[full, 1] = B.mix(np.bitwise_xor.reduceat(B.mix(grams + np.uint64(0x14057B7EF767814F)), at[full])) >> np.uint64(8)
    has = np.packbits(n > 0, bitorder="little").tobytes()
    return pa.Array.from_buffers(pa.decimal128(38, 0), len(n), [pa.py_buffer(has), pa.py_buffer(words.tobytes())])


def least_overlap(a, b, percent: int):
    """Smallest intersection of sets of sizes a and b whose similarity is at least percent / 100."""
    return -((-percent * (a + b)) // (100 + percent))


# ---------------------------------------------------------------- prefix tree

class Node:
    __slots__ = ("part", "ends", "below", "short", "long", "label")

    def __init__(self, part, short, long, label):
        self.part, self.short, self.long, self.label = part, short, long, label
        self.ends, self.below = [], []


def build_trie(sets: list[np.ndarray], labels: list) -> Node:
    """Path-compressed trie of sorted sets; a node's label is its sets' only label, or None."""
    keys = [s.astype(">u4").tobytes() for s in sets]
    order = sorted(range(len(sets)), key=keys.__getitem__)
    root, work = None, [(0, len(order), 0, None)]
    while work:
        lo, hi, depth, parent = work.pop()
        one, other = sets[order[lo]], sets[order[hi - 1]]
        n = min(len(one), len(other))
        differ = np.flatnonzero(one[depth:n] != other[depth:n])
        end = depth + int(differ[0]) if len(differ) else n
        sizes = [len(sets[i]) for i in order[lo:hi]]
        own = {labels[i] for i in order[lo:hi]}
        node = Node(one[depth:end], min(sizes), max(sizes), own.pop() if len(own) == 1 else None)
        if parent is None:
            root = node
        else:
            parent.below.append(node)
        i = lo
        while i < hi and len(sets[order[i]]) == end:
            node.ends.append(order[i])
            i += 1
        while i < hi:
            step, j = sets[order[i]][end], i + 1
            while j < hi and sets[order[j]][end] == step:
                j += 1
            work.append((i, j, end, node))
            i = j
    return root


def trie_join(sets: list[np.ndarray], queries: list[int], percent: int, labels: np.ndarray | None = None) -> list[tuple[int, int]]:
    """(query, set) of every two similar sets, outside the query's own label.

    All queries walk the trie together: a node adds its part's overlap to the partial
    overlap that each query brings along, and only the queries that can still reach
    the overlap needed below go on.
    """
    labels = np.arange(len(sets)) if labels is None else labels
    grams, ids = np.unique(np.concatenate(sets), return_inverse=True)
    size = np.array([len(x) for x in sets], np.int64)
    begin = np.concatenate(([0], np.cumsum(size)))
    own = [ids[a:b] for a, b in zip(begin, begin[1:])]
    has = np.zeros((len(queries), len(grams)), bool)          # at most UNIT_SETS x UNIT_GRAMS
    for r, q in enumerate(queries):
        has[r, own[q]] = True
    qs = np.array(queries, np.int64)
    n, label = size[qs], labels[qs]
    keys = np.concatenate([own[q] + r * len(grams) for r, q in enumerate(queries)])
    key_begin = np.concatenate(([0], np.cumsum(n)))[:-1]
    found, every = [], np.arange(len(queries))
    work = [(build_trie(own, labels.tolist()), every, np.zeros(len(queries), np.int64), np.zeros(len(queries), np.int64), 0)]
    while work:
        node, live, at, overlap, depth = work.pop()
        if node.label is not None:
            other = label[live] != node.label
            live, at, overlap = live[other], at[other], overlap[other]
        if len(node.part) and len(live):
            overlap = overlap + has[live[:, None], node.part[None, :]].sum(axis=1)
            at = np.searchsorted(keys, live * len(grams) + node.part[-1], side="right") - key_begin[live]
        depth += len(node.part)
        # what can still be shared below, against what the shortest set below needs
        able = overlap + np.minimum(n[live] - at, node.long - depth) >= least_overlap(n[live], max(node.short, depth), percent)
        live, at, overlap = live[able], at[able], overlap[able]
        if not len(live):
            continue
        if node.ends:
            for r in live[overlap >= least_overlap(n[live], depth, percent)].tolist():
                found += [(queries[r], e) for e in node.ends if labels[e] != label[r]]
        work += [(x, live, at, overlap, depth) for x in node.below]
    return found


# ---------------------------------------------------------------- the join

LINKS = f"a {SIG}, b {SIG}"


def _sets(table: pa.Table, words: int) -> list[np.ndarray]:
    texts = pa.array([zlib.decompress(b) for b in table["body"].to_pylist()], pa.binary())
    grams, at = shingles(pa.chunked_array([texts]), words)
    return [grams[a:b] for a, b in zip(at, at[1:])]


def _linked(sig: pa.ChunkedArray, pairs: list[tuple[int, int]]) -> pa.Table:
    a, b = [p[0] for p in pairs], [p[1] for p in pairs]
    return pa.table({"a": sig.take(pa.array(a, pa.int64())), "b": sig.take(pa.array(b, pa.int64()))})


def _with_bodies(rows: DataFrame, bodies: DataFrame) -> DataFrame:
    one = bodies.join(rows.select("sig").distinct(), "sig", "left_semi").groupBy("sig").agg(F.first("body").alias("body"))
    return rows.join(one, "sig")


def _star_links(pairs: DataFrame, bodies: DataFrame, words: int, percent: int) -> DataFrame:
    """Which ``pairs(hub, sig, n)`` are links: a trie of the members, walked by the hub."""
    parts = pairs.groupBy("hub").agg(F.greatest(F.ceil(F.count("*") / UNIT_SETS), F.ceil(F.sum("n") / UNIT_GRAMS)).alias("parts"))
    members = pairs.join(parts, "hub").select("sig", "hub", F.pmod(F.xxhash64("sig"), F.col("parts")).alias("unit"),
                                              F.lit(False).alias("is_hub"))
    hubs = members.select(F.col("hub").alias("sig"), "hub", "unit", F.lit(True).alias("is_hub")).distinct()

    def join(key, table):
        hub = table["is_hub"].to_pylist().index(True)
        return _linked(table["sig"], trie_join(_sets(table, words), [hub], percent))

    return _with_bodies(members.union(hubs), bodies).groupBy("hub", "unit").applyInArrow(join, LINKS)


def connecting(pairs: list[tuple[int, int]], comp: np.ndarray) -> list[tuple[int, int]]:
    """Those of the links that connect components not connected by the ones before them."""
    up = list(range(int(comp.max()) + 1)) if len(comp) else []

    def root(c):
        while up[c] != c:
            up[c] = c = up[up[c]]
        return c

    out = []
    for a, b in pairs:
        one, other = root(int(comp[a])), root(int(comp[b]))
        if one != other:
            up[one] = other
            out.append((a, b))
    return out


def _several(members: DataFrame, joined: DataFrame) -> DataFrame:
    """``members(g, sig, n)`` of the groups in several components: with ``comp``, the group's size ``c``,
    its largest component ``main``, and into how many parts that and the rest are cut."""
    labelled = members.join(joined, "sig", "left").select("g", "sig", "n", F.coalesce("comp", "sig").alias("comp"))
    by_comp = labelled.groupBy("g", "comp").agg(F.count("*").alias("c"), F.sum("n").alias("s"))
    need = lambda c, s: F.greatest(F.ceil(c / UNIT_SETS), F.ceil(s / UNIT_GRAMS))
    group = by_comp.groupBy("g").agg(F.max_by("comp", F.struct("c", "comp")).alias("main"), F.max(F.struct("c", "comp", "s")).alias("m"),
                                     F.sum("c").alias("c"), F.sum("s").alias("s"), F.count("*").alias("comps")).where("comps > 1").select(
        "g", "main", "c", need(F.col("c"), F.col("s")).alias("parts"),
        need(F.col("c") - F.col("m.c"), F.col("s") - F.col("m.s")).alias("rest_parts"),
        need(F.col("m.c"), F.col("m.s")).alias("main_parts"))
    return labelled.join(group, "g")


def _hub_links(members: DataFrame, bodies: DataFrame, words: int, percent: int) -> DataFrame:
    """Links of the members marked ``is_hub`` with all others of their group: each unit has all hubs."""
    x = members.select("g", "sig", "comp", "is_hub", F.explode(F.when(F.col("is_hub"), F.expr("sequence(0L, parts - 1)")).otherwise(
        F.array(F.pmod(F.xxhash64("sig"), F.col("parts"))))).alias("unit"))

    def join(key, table):
        _, comp = np.unique(np.array(table["comp"].to_pylist(), object), return_inverse=True)
        asking = np.flatnonzero(table["is_hub"].to_numpy()).tolist()
        if not asking or comp.max() == 0:
            return _linked(table["sig"], [])
        return _linked(table["sig"], connecting(trie_join(_sets(table, words), asking, percent, comp), comp))

    return (_with_bodies(x, bodies).select("sig", "comp", "is_hub", "body", "g", "unit")
            .groupBy("g", "unit").applyInArrow(join, LINKS))


def _full_links(members: DataFrame, bodies: DataFrame, words: int, percent: int) -> DataFrame:
    """Links that connect different components inside each group of ``_several``.

    The members of a group's largest component need not be compared with each other:
    they are cut into parts, and only the others meet every part.
    """
    x = members.withColumn("is_main", F.col("comp") == F.col("main"))
    own = F.pmod(F.xxhash64("sig"), F.when(F.col("is_main"), F.col("main_parts")).otherwise(F.col("rest_parts")))
    x = x.withColumn("own", own).select("g", "sig", "comp", F.explode(F.when(
        F.col("is_main"), F.expr("transform(sequence(0L, rest_parts - 1), i -> struct(i as u, rest_parts + own as v))")).otherwise(
        F.expr("concat(transform(sequence(0L, rest_parts - 1), i -> struct(least(i, own) as u, greatest(i, own) as v)),"
               " transform(sequence(0L, main_parts - 1), i -> struct(own as u, rest_parts + i as v)))"))).alias("unit"))

    def join(key, table):
        _, comp = np.unique(np.array(table["comp"].to_pylist(), object), return_inverse=True)
        if comp.max() == 0:
            return _linked(table["sig"], [])
        main = np.bincount(comp).argmax()      # two members of it need no comparison, so the others ask
        asking = np.flatnonzero(comp != main).tolist()
        return _linked(table["sig"], connecting(trie_join(_sets(table, words), asking, percent, comp), comp))

    return (_with_bodies(x, bodies).select("sig", "comp", "body", "g", "unit.u", "unit.v")
            .groupBy("g", "u", "v").applyInArrow(join, LINKS))


def _joined(links: DataFrame) -> DataFrame:
    return saved(components(links).withColumnRenamed("node", "sig").withColumnRenamed("component", "comp"))


def _connected(members: DataFrame, bodies: DataFrame, words: int, percent: int) -> DataFrame:
    """(sig, comp) of every class with a link; ``members(g, hub, sig, n)``: the groups that may link."""
    joined = _joined(_star_links(members.where("sig <> hub").select("hub", "sig", "n").distinct(), bodies, words, percent))
    members, before, turn = members.where("sig <> hub").select("g", "sig", "n"), None, 0
    while True:
        members = saved(_several(members, joined))
        large = (F.col("rest_parts") > 1) & (F.col("c") > UNIT_SETS)
        units = members.where(large).select("g", "rest_parts", "main_parts").distinct().agg(
            F.sum((F.col("rest_parts") * (F.col("rest_parts") + F.col("main_parts"))).cast("double"))).first()[0]
        if not units or before is not None and units > GAIN * before:
            break
        before, turn = units, turn + 1
        asked = members.withColumn("is_hub", large & (F.pmod(F.xxhash64(F.lit(turn), "sig"), F.col("c")) < HUBS))
        more = saved(_hub_links(asked.where(large), bodies, words, percent))
        if not more.isEmpty():
            joined = _joined(joined.select(F.col("sig").alias("a"), F.col("comp").alias("b")).union(more))
        members = asked.where("not is_hub").select("g", "sig", "n")
    more = saved(_full_links(members, bodies, words, percent))
    return joined if more.isEmpty() else _joined(joined.select(F.col("sig").alias("a"), F.col("comp").alias("b")).union(more))


def near_groups(docs: DataFrame, words: int = 5, percent: int = 80, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, n_shingles, component_id) for every row; documents link at Jaccard similarity >= percent / 100."""
    docs = docs.select(F.col(f"`{doc_id}`").alias("doc_id"), F.col(f"`{text}`").alias("text"))
    n_blocks, n_ranges = B.sizes(docs)
    blocked = B.blocks(docs, n_blocks)

    def emit(key, table):
        grams, _ = shingles(table[B.TEXT], words)
        # 40 bits of a hash: two n-grams taken for one have their frequencies added, which changes the order, not the links
        keys, count = np.unique(B.short(grams), return_counts=True)
        return B.sent_rows(B.key_of(key), keys, n_ranges, np.minimum(count, 255).astype(np.uint8), B.pack_short)

    def frequency(table):
        _, keys, at = B.received(table, B.unpack_short)
        count = B.counts_of(table, np.uint8).astype(np.int64)
        _, inverse = np.unique(keys, return_inverse=True)
        total = np.minimum(np.bincount(inverse, count), 255).astype(np.uint8)[inverse]
        return B.reply_rows(table, [total[a:b].tobytes() for a, b in zip(at, at[1:])])

    def prefixes(key, left, right):
        grams, at = shingles(left[B.TEXT], words)
        keys, inverse = np.unique(B.short(grams), return_inverse=True)
        place, df = B.cuts(keys, n_ranges), np.zeros(len(keys), np.uint8)
        for r, x in zip(right["range"].to_pylist(), right["reply"].to_pylist()):
            df[place[r]:place[r + 1]] = np.frombuffer(x, np.uint8)
        df, n, sig = df[inverse], np.diff(at), signatures(grams, at)
        n_prefix = n - -(-percent * n // 100) + 1
        tokens, seen, names = [], set(), sig.to_pylist()
        for i, name in enumerate(names):
            mine = None
            if name is not None and name not in seen:
                seen.add(name)
                g, f = grams[at[i]:at[i + 1]], df[at[i]:at[i + 1]]
                if np.count_nonzero(f < 2) < n_prefix[i]:
                    order = np.lexsort((g, f))[:n_prefix[i]]
                    order = order[f[order] > 1]
                    mine = g[order].view(np.int64) if len(order) else None
            tokens.append(mine)
        # texts that may have to be compared travel compressed
        body = pa.array([zlib.compress(x.encode(), 1) if t is not None else None for x, t in zip(left[B.TEXT].to_pylist(), tokens)], pa.binary())
        return pa.table({B.ROW: B.nullable(left[B.ROW]), "sig": sig, "n": pa.array(n, pa.int64()),
                         "tokens": pa.array(tokens, pa.list_(pa.int64())), "body": body})

    row = blocked.schema[B.ROW].dataType.simpleString()
    found = saved_table(B.with_answers(blocked, B.per_range(B.per_block(blocked, emit), frequency), prefixes,
                                       f"{B.ROW} {row}, sig {SIG}, n long, tokens array<long>, body binary"))
    bodies = found.where("body is not null").select("sig", "body")

    # groups of classes that meet at an n-gram; the same group met at several n-grams counts once
    at = found.where("tokens is not null").select("sig", "n", F.explode("tokens").alias("token")).distinct()
    group = at.groupBy("token").agg(F.count("*").alias("c"), F.min("sig").alias("hub"), F.bit_xor(F.xxhash64("sig")).alias("x"),
                                    F.bit_xor(F.xxhash64(F.lit(7), "sig")).alias("y")).where("c > 1")
    group = group.groupBy("c", "hub", "x", "y").agg(F.min("token").alias("token"))
    members = saved(at.join(group.select("token", "hub"), "token").select(F.col("token").alias("g"), "hub", "sig", "n"))

    joined = _connected(members, bodies, words, percent)
    classes = found.where("sig is not null").groupBy("sig").agg(F.min(F.col(B.ROW)["doc_id"]).alias("least_id"))
    classes = classes.join(joined, "sig", "left").select("sig", "least_id", F.coalesce("comp", "sig").alias("comp"))
    least = classes.groupBy("comp").agg(F.min("least_id").alias("component_id"))
    classes = classes.join(least, "comp").select("sig", "component_id")
    own = found.select(F.col(B.ROW)["doc_id"].alias("doc_id"), "sig", F.col("n").alias("n_shingles"))
    return own.where("sig is not null").join(classes, "sig").select("doc_id", "n_shingles", "component_id").union(
        own.where("sig is null").select("doc_id", "n_shingles", F.col("doc_id").alias("component_id")))


def one_of_each(docs: DataFrame, groups: DataFrame) -> DataFrame:
    """The rows of ``docs`` that represent their group: those whose id is the component's id.

    Rows that share an id stay if one of them represents its group, those of equal text once;
    rows without an id cannot be told apart and stay.
    """
    least = groups.where("doc_id = component_id").groupBy("doc_id").agg(F.count("*").alias("_rows"))
    kept = docs.where("doc_id is not null").join(least, "doc_id")
    return (kept.where("_rows = 1").select(docs.columns)
            .union(kept.where("_rows > 1").select(docs.columns).dropDuplicates(["doc_id", "text"]))
            .union(docs.where("doc_id is null")))
