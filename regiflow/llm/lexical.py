"""Operator 13: ranked lexical search over a length-stratified index.

Documents of one normaliser m form a stratum.  The index is a table of shards, each
some strata, or a part of a large one, of about ``SHARD`` bytes of text: a document's
shard follows from the bytes of the strata below and, inside its own, from a hash, so a
length that a third of all documents share is spread and no shard grows hot.

A shard holds its documents by id, its sorted terms with their document counts, and for
each term the postings by stratum and, within it, by falling tf: one entry per (term,
stratum, tf) with the documents behind it.  An impact is thus computed once per entry,
not per posting.

A search adds up the shards' document counts of the queries' terms, then visits the
shards.  Inside a shard a stratum's bound for a query is the sum of the largest impacts
of its terms; strata are visited by falling bound until the bound is below the k-th
score found so far, which a task carries from shard to shard.  A stratum whose bound
equals that score is still visited, for a smaller id may win.  Queries go to the tasks
in blocks of at most ``QUERY_TERMS`` terms, one job a block; every task returns at most
k rows per query.

Scores are whole numbers: a term weighs floor(1000 ln((2N+2)/(2df+1))).  Defined cases:
null texts and texts without terms are neither counted nor found; a query without terms,
or whose terms nobody has, finds nothing; terms count once a query; repeated rows and
ids are separate documents; ties go by ascending id, null last; a null or repeated query
id is an item of its own, and its rows are returned for each; empty tables: no rows.
A text of any length is cut into terms ``SLICE`` bytes at a time.
"""

from __future__ import annotations

import math
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from regiflow.llm import blocks as B
from regiflow.llm.graph import saved_table
from regiflow.llm.mixing import running

SHARD = 4 << 20             # bytes of text in a shard, about
SLICE = 4 << 20             # bytes of text cut into terms at a time
STRATA = 1 << 20            # rows of the table of strata that are broadcast, at most; beyond, Spark joins as it sees fit
QUERY_TERMS = 1 << 16       # terms of the queries that one job looks for, at most (but one query is never cut)
TABLE = bytes((c + 32 if 65 <= c <= 90 else c) if c >= 128 or chr(c).isalnum() else 32 for c in range(256))
IS_TERM = np.array([c >= 128 or chr(c).isalnum() for c in range(256)])
ONE = 1_000_000_000


class Index(NamedTuple):
    shards: DataFrame        # shard, ids, terms, counts and the arrays of ``_shard``
    docs: int                # N: documents with a term
    terms: int               # L: their terms, with repeats


def _slices(text: bytes):
    """The text as lower-cased terms between spaces, in slices that end between terms."""
    text, at = text.translate(TABLE), 0
    while len(text) - at > SLICE:
        end = text.rfind(b" ", at, at + SLICE)
        end = end if end > at else text.find(b" ", at + SLICE)
        if end < 0:
            break
        yield text[at:end]
        at = end
    yield text[at:]


def counted(texts: list[bytes | None]) -> tuple[np.ndarray, np.ndarray, pa.Array]:
    """(document, term number, of every distinct pair; tf) and the sorted terms: terms, doc, term, tf."""
    words, lens, owner = [], [], []
    tables, n = [], 0

    def close():
        if words:
            d = pa.array(words, pa.binary()).dictionary_encode()
            doc = np.repeat(np.array(owner, np.int64), lens)
            width = len(d.dictionary)
            pair, tf = np.unique(doc * width + d.indices.to_numpy(), return_counts=True)
            tables.append((pair // width, pa.DictionaryArray.from_arrays(pa.array(pair % width, pa.int32()), d.dictionary), tf))
        words.clear(), lens.clear(), owner.clear()

    for i, text in enumerate(texts):
        for part in _slices(text or b""):
            w = part.split()
            words.extend(w), lens.append(len(w)), owner.append(i)
            n += len(part)
            if n >= SLICE:
                close()
                n = 0
    close()
    if not tables:
        return pa.array([], pa.binary()), np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int64)
    chunked = pa.chunked_array([t[1] for t in tables]).unify_dictionaries()
    names = chunked.chunk(0).dictionary
    order = pc.sort_indices(names).to_numpy()
    place = np.empty(len(order), np.int64)
    place[order] = np.arange(len(order))
    term = place[np.concatenate([c.indices.to_numpy() for c in chunked.chunks])]
    doc, tf = (np.concatenate([t[k] for t in tables]) for k in (0, 2))
    pair, at = np.unique(doc * len(names) + term, return_inverse=True)    # slices of one text meet here
    return names.take(pa.array(order)), pair // len(names), pair % len(names), np.bincount(at, tf).astype(np.int64)


ARRAYS = {"term_entry": np.int32, "entry_stratum": np.int32, "entry_tf": np.int32, "entry_post": np.int32, "post_doc": np.int32, "strata": np.int64}
INDEX = ", ".join(f"{a} binary" for a in ARRAYS)


def _shard(table: pa.Table) -> pa.Table:
    """One row: the documents of a shard, inverted."""
    table = table.take(pc.sort_indices(table, sort_keys=[("id", "ascending")], null_placement="at_end"))   # ties go by the document's number
    strata, stratum = np.unique(table["m"].to_numpy(), return_inverse=True)
    names, doc, term, tf = counted(table["text"].cast(pa.binary()).to_pylist())
    order = np.lexsort((doc, -tf, stratum[doc], term))
    doc, term, tf = doc[order], term[order], tf[order]
    s = stratum[doc]
    new = np.ones(len(doc) + 1, bool)
    new[1:-1] = (term[1:] != term[:-1]) | (s[1:] != s[:-1]) | (tf[1:] != tf[:-1])
    entry = np.flatnonzero(new)
    arrays = {"term_entry": np.searchsorted(term[entry[:-1]], np.arange(len(names) + 1)), "entry_stratum": s[entry[:-1]],
              "entry_tf": tf[entry[:-1]], "entry_post": entry, "post_doc": doc, "strata": strata}
    counts = np.bincount(term, minlength=len(names)).astype(np.int64)
    as_list = lambda a: pa.ListArray.from_arrays(pa.array([0, len(a)], pa.int32()), a)
    return pa.table({"shard": pa.array([table["shard"][0].as_py()], pa.int64()), "ids": as_list(B.nullable(table["id"]).combine_chunks()),
                     "terms": as_list(names), "counts": as_list(pa.array(counts)),
                     **{k: pa.array([np.asarray(a, ARRAYS[k]).tobytes()], pa.binary()) for k, a in arrays.items()}})


def term_counts(column) -> np.ndarray:
    """Number of terms, with repeats, of each text."""
    data, at = B.text_bytes(column)
    out = []
    for i, j in B.groups_of(at, B.CHUNK):
        part, ends = data[at[i]:at[j]], at[i:j + 1] - at[i]
        inside = IS_TERM[part]
        begins = inside.copy()
        begins[1:] &= ~inside[:-1]
        first = ends[:-1][ends[:-1] < ends[1:]]                # a text's first byte begins a term, whatever ends the one before
        begins[first] = inside[first]
        total = np.concatenate(([0], np.cumsum(begins)))
        out.append(total[ends[1:]] - total[ends[:-1]])
    return np.concatenate(out) if out else np.zeros(0, np.int64)


def _with_counts(keep: list[str]):
    def run(batches):
        for batch in batches:
            n = pa.array(term_counts(pa.chunked_array([batch.column("text")])), pa.int64())
            yield pa.RecordBatch.from_arrays([*[batch.column(c) for c in keep], n], [*keep, "n"])
    return run


def build_index(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> Index:
    """The index of all documents with a term, written below the shared checkpoint folder."""
    rows = docs.select(F.col(f"`{doc_id}`").alias("id"), F.col(f"`{text}`").alias("text"))
    kind = rows.schema["id"].dataType.simpleString()
    sizes = rows.select("text", (F.octet_length("text").cast("long") + 64).alias("bytes")).mapInArrow(_with_counts(["bytes"]), "bytes long, n long")
    lengths = saved_table(sizes.where("n > 0").groupBy("n").agg(F.count("*").alias("docs"), F.sum("bytes").alias("bytes")))
    n_docs, n_terms = lengths.agg(F.sum("docs"), F.sum(F.col("n") * F.col("docs"))).first()
    schema = f"shard long, ids array<{kind}>, terms array<binary>, counts array<long>, {INDEX}"
    if not n_docs:
        return Index(docs.sparkSession.createDataFrame([], schema), 0, 0)
    # one row per distinct length, so the window over strata is small however many documents there are
    m = F.lit(10) + F.expr(f"cast(90 as decimal(20,0)) * n * {n_docs}L div {n_terms}L").cast("long")
    strata = lengths.groupBy(m.alias("m")).agg(F.sum("bytes").alias("bytes"))
    below = F.coalesce(F.sum("bytes").over(Window.orderBy("m").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    strata = strata.select("m", "bytes", below.alias("below"))
    place = F.col("below") + F.pmod(F.xxhash64("id", "text"), F.col("bytes"))
    strata = F.broadcast(strata) if lengths.count() <= STRATA else strata
    rows = rows.mapInArrow(_with_counts(["id", "text"]), f"id {kind}, text string, n long").where("n > 0")
    dealt = rows.withColumn("m", m).join(strata, "m").select("id", "text", "m", (F.floor(place / SHARD)).alias("shard"))
    return Index(saved_table(dealt.groupBy("shard").applyInArrow(_shard, schema)), n_docs, n_terms)


# ---------------------------------------------------------------- search

def weight(n_docs: int, df: int) -> int:
    return math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df + 1)))


class Shard:
    """A row of the index, read."""

    def __init__(self, row: dict):
        for name, kind in ARRAYS.items():
            setattr(self, name, np.frombuffer(row[name].as_py(), kind))
        self.ids, self.terms = row["ids"].values, row["terms"].values

    def entries(self, wanted: pa.Array) -> list[np.ndarray]:
        """The numbers of the entries of each wanted term."""
        at = pc.index_in(wanted, self.terms).to_numpy(zero_copy_only=False)
        return [np.arange(0) if math.isnan(t) else np.arange(self.term_entry[int(t)], self.term_entry[int(t) + 1]) for t in at.astype(float)]

    def impacts(self, entries: np.ndarray) -> np.ndarray:
        """The impact of an entry, per unit of the term's weight."""
        tf = self.entry_tf[entries].astype(np.int64)
        return ONE * tf // (1000 * tf + 8 * self.strata[self.entry_stratum[entries]])

    def best(self, entries: list[np.ndarray], scores: list[np.ndarray], k: int, least: int) -> list[tuple[int, int]]:
        """(score, document) of the k best documents of a query whose score is at least ``least``."""
        if not sum(map(len, entries)):
            return []
        top = np.zeros(len(self.strata), np.int64)
        for e, x in zip(entries, scores):
            s = self.entry_stratum[e]
            first = np.ones(len(s), bool)                  # entries of a stratum fall by tf: the first is the largest
            first[1:] = s[1:] != s[:-1]
            top[s[first]] += x[first]
        e, x = np.concatenate(entries), np.concatenate(scores)
        order = np.argsort(self.entry_stratum[e], kind="stable")
        e, x = e[order], x[order]
        ends = np.searchsorted(self.entry_stratum[e], np.arange(len(self.strata) + 1))
        found: list[tuple[int, int]] = []
        total = np.zeros(len(self.ids), np.int64)
        for s in np.argsort(-top, kind="stable"):
            if top[s] < max(least, 1):
                break
            mine = slice(ends[s], ends[s + 1])
            a, b = self.entry_post[e[mine]], self.entry_post[e[mine] + 1]
            size = b - a
            at = np.repeat(a - np.concatenate(([0], np.cumsum(size)[:-1])), size) + np.arange(size.sum())
            docs = self.post_doc[at]
            np.add.at(total, docs, np.repeat(x[mine], size))     # a document is in one stratum only
            docs = np.unique(docs[total[docs] >= max(least, 1)])
            keep = docs[np.argsort(-total[docs], kind="stable")[:k]]
            found = sorted(found + [(-int(total[i]), int(i)) for i in keep])[:k]
            if len(found) == k:
                least = max(least, -found[-1][0])
        return [(-x, d) for x, d in found]


def _rank(hit: tuple):
    return -hit[0], hit[1] is None, 0 if hit[1] is None else hit[1]


def _searcher(queries: list[tuple[int, list[int]]], terms: list[bytes], weights: list[int], k: int, id_type: pa.DataType):
    """Shards -> the k best documents of each query in a task's shards."""
    def run(batches):
        wanted, best = pa.array(terms, pa.binary()), [[] for _ in queries]
        for batch in batches:
            for i in range(batch.num_rows):
                shard = Shard({c: batch.column(c)[i] for c in batch.schema.names})
                entries = shard.entries(wanted)
                scores = [shard.impacts(e) * w for e, w in zip(entries, weights)]
                for q, (_, mine) in enumerate(queries):
                    least = best[q][-1][0] if len(best[q]) == k else 1
                    hits = shard.best([entries[t] for t in mine], [scores[t] for t in mine], k, least)
                    if hits:
                        ids = shard.ids.take(pa.array([d for _, d in hits])).to_pylist()
                        best[q] = sorted(best[q] + [(x, d) for (x, _), d in zip(hits, ids)], key=_rank)[:k]
        rows = [(no, x, d) for (no, _), hits in zip(queries, best) for x, d in hits]
        yield pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows], pa.int64()), pa.array([r[1] for r in rows], pa.int64()),
                                          pa.array([r[2] for r in rows], id_type)], ["_no", "score", "doc_id"])
    return run


def _query_terms(batches):
    """Queries -> (item_id, their distinct terms)."""
    for batch in batches:
        terms = [sorted({w for part in _slices(t or b"") for w in part.split()}) for t in batch.column("text").cast(pa.binary()).to_pylist()]
        yield pa.RecordBatch.from_arrays([batch.column("item_id"), pa.array(terms, pa.list_(pa.binary()))], ["item_id", "terms"])


def search(index: Index, items: DataFrame, k: int = 10, item_id: str = "item_id", text: str = "text") -> DataFrame:
    """(item_id, rank, doc_id, score): the k best documents of every item."""
    spark = items.sparkSession
    items = items.select(F.col(f"`{item_id}`").alias("item_id"), F.col(f"`{text}`").alias("text"))
    kind, id_kind = items.schema["item_id"].dataType.simpleString(), index.shards.schema["ids"].dataType.elementType
    out = f"item_id {kind}, rank int, doc_id {id_kind.simpleString()}, score long"
    asked = items.mapInArrow(_query_terms, f"item_id {kind}, terms array<binary>").where("size(terms) > 0")
    # numbered, and dealt to blocks by the terms before: the numbers are those of the saved rows
    asked = saved_table(asked.repartitionByRange(F.col("item_id").asc_nulls_last()).withColumn("_part", F.spark_partition_id())
                        .withColumn("_no", F.monotonically_increasing_id()).withColumn("_size", F.size("terms").cast("long")))
    asked = running(asked, [], "_part", ["_no"], "_size", "_words").withColumn("_block", F.expr(f"_words div {QUERY_TERMS}L"))
    asked = saved_table(asked.drop("_part", "_size", "_words"))
    last = asked.agg(F.max("_block")).first()[0]
    found = None
    for block in range(0 if last is None or not index.docs else last + 1):
        mine = asked.where(F.col("_block") == block)
        dfs = index.shards.select(F.explode(F.arrays_zip("terms", "counts")).alias("t")).select("t.terms", "t.counts").join(
            mine.select(F.explode("terms").alias("terms")).distinct(), "terms").groupBy("terms").agg(F.sum("counts").alias("df"))
        known = {bytes(r[0]): r[1] for r in dfs.collect()}       # at most QUERY_TERMS and the terms of one query
        names = sorted(known)
        number = {t: i for i, t in enumerate(names)}
        queries = [(r[0], [number[t] for t in map(bytes, r[1]) if t in number]) for r in mine.select("_no", "terms").orderBy("_no").collect()]
        arrow = pa.Table.from_pylist([], index.shards.select(F.explode("ids").alias("id")).limit(0).toArrow().schema).schema.field("id").type
        hits = index.shards.select("ids", "terms", *ARRAYS).mapInArrow(
            _searcher(queries, names, [weight(index.docs, known[t]) for t in names], k, arrow), f"_no long, score long, doc_id {id_kind.simpleString()}")
        hits = hits.join(mine.select("_no", "item_id"), "_no")
        found = hits if found is None else found.unionByName(hits)
    if found is None:
        return spark.createDataFrame([], out)
    order = Window.partitionBy("_no").orderBy(F.desc("score"), F.col("doc_id").asc_nulls_last())
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("item_id", "rank", "doc_id", "score")


ORACLE = r"""
with t as (select doc_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
           '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) as term from documents),
tf as materialized (select doc_id, term, count(*) as tf from t group by doc_id, term),
n as materialized (select doc_id, sum(tf)::bigint as n from tf group by doc_id),
a as (select count(*)::bigint as big_n, sum(n)::bigint as big_l from n),
m as (select doc_id, 10 + (90 * n * big_n) // big_l as m from n, a),
w as (select term, floor(1000 * ln((2 * big_n + 2)::double / (2 * count(*) + 1)::double))::bigint as w from tf, a group by term, big_n),
q as (select distinct item_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
      '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) as term from benchmark),
s as (select item_id, doc_id, sum(w * ((1000000000 * tf) // (1000 * tf + 8 * m)))::bigint as score
      from q join tf using (term) join w using (term) join m using (doc_id) group by item_id, doc_id),
r as (select *, row_number() over (partition by item_id order by score desc, doc_id)::int as rank from s where score > 0)
select item_id, rank, doc_id, score from r where rank <= 10"""
