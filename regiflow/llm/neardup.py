"""Operator 5: embedding near-duplicates by random-hyperplane sign hashing.

Every vector gets the signs of ``bits`` random projections in each of ``tables``
tables.  Vectors that agree in all signs of a table meet in its bucket; there the
cosine is computed exactly, in double precision, for every pair.  The number of
bits follows the number of vectors (buckets of about ``FILL`` unrelated vectors),
and the number of tables follows from the bits and the recall wanted at the
threshold, where two vectors agree in a sign with probability
1 - arccos(threshold) / pi.

Equal vectors are one class from the start.  Buckets are cut into parts of bounded
size and every two parts of a bucket meet in a unit of their own, so a bucket of
any size is exact and spread.  A pair that meets in several tables is counted in
the first of them only, which both vectors' signs tell, so no pair is ever sent:
a unit returns the number of links of each of its vectors and a spanning forest.

Defined cases: vectors that are null, empty, zero or hold null or non-finite
components link with nothing (n_links 0, own component); vectors of different
length do not link; repeated ids are separate vectors; a null id is never a
component's id; labels are not looked at.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from regiflow.llm.graph import components, saved, saved_table

THRESHOLD, RECALL = 0.95, 0.995
FILL = 64              # unrelated vectors in a bucket, about
PART = 1024            # vectors of a bucket part
SIG = "decimal(38,0)"


def layout(n: int, threshold: float = THRESHOLD, recall: float = RECALL) -> tuple[int, int]:
    """(bits, tables) for n vectors."""
    bits = min(40, max(4, math.ceil(math.log2(max(n, 1) / FILL + 1))))
    meet = (1 - math.acos(threshold) / math.pi) ** bits
    return bits, max(1, math.ceil(math.log(1 - recall) / math.log(1 - meet)))


def planes(dim: int, bits: int, tables: int, seed: int = 7) -> np.ndarray:
    return np.random.default_rng(seed).standard_normal((dim, bits * tables))


def _matrix(column) -> np.ndarray:
    """Rows of equal length as doubles."""
    a = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    a = pa.concat_arrays(a.chunks) if isinstance(a, pa.ChunkedArray) else a
    return a.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(a), -1)


def _scaled(x: np.ndarray) -> np.ndarray:
    """Rows over their largest absolute component: squares of very large or small ones stay finite and above zero."""
    return x / np.abs(x).max(axis=1, keepdims=True)


def _signs(x: np.ndarray, plane: np.ndarray, tables: int) -> np.ndarray:
    """The bucket number of each vector in each table."""
    bits = plane.shape[1] // tables
    up = (x @ plane > 0).reshape(len(x), tables, bits)
    return (up * (np.int64(1) << np.arange(bits))).sum(axis=2)


def near_vectors(vectors: DataFrame, threshold: float = THRESHOLD, recall: float = RECALL,
                 vec_id: str = "vec_id", embedding: str = "embedding") -> DataFrame:
    """(vec_id, n_links, component_id, kept) for every vector."""
    rows = vectors.select(F.col(f"`{vec_id}`").cast("long").alias("vec_id"), F.col(f"`{embedding}`").cast("array<double>").alias("v"))
    finite = F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    usable = F.coalesce(finite & F.exists("v", lambda x: x != 0), F.lit(False))
    bytes_ = F.concat_ws(",", F.transform("v", lambda x: F.hex((x + F.lit(0.0)).cast("string").cast("binary"))))
    rows = rows.withColumn("sig", F.when(usable, F.conv(F.substring(F.md5(bytes_), 1, 15), 16, 10).cast(SIG) * F.lit(10 ** 18).cast("decimal(19,0)")
                                         + F.conv(F.substring(F.md5(bytes_), 16, 14), 16, 10).cast("decimal(18,0)")).cast(SIG))
    rows = saved_table(rows)
    classes = rows.where("sig is not null").groupBy("sig", F.size("v").alias("dim")).agg(
        F.count("*").alias("copies"), F.min("vec_id").alias("least_id"), F.first("v").alias("v"))
    classes = saved_table(classes)
    bits, tables = layout(classes.count(), threshold, recall)

    def hashed(batches):
        plane: dict[int, np.ndarray] = {}
        for b in batches:
            dim = b.column("dim").to_numpy()
            for d in np.unique(dim):
                own = b.filter(pa.array(dim == d))
                if int(d) not in plane:                          # follow from (length, seed), so any task makes the same
                    plane.clear() if len(plane) >= 64 else None
                    plane[int(d)] = planes(int(d), bits, tables)
                h = _signs(_scaled(_matrix(own.column("v"))), plane[int(d)], tables)
                yield pa.RecordBatch.from_arrays([own.column("sig"), own.column("dim"), own.column("copies"), own.column("v"),
                                                  pa.array(list(h), pa.list_(pa.int64()))], ["sig", "dim", "copies", "v", "h"])

    coded = saved_table(classes.select("sig", "dim", "copies", "v").mapInArrow(hashed, f"sig {SIG}, dim int, copies long, v array<double>, h array<long>"))
    at = coded.select("sig", "dim", F.posexplode("h").alias("t", "b"))
    bucket = at.groupBy("dim", "t", "b").agg(F.count("*").alias("n")).where("n > 1").withColumn("parts", F.ceil(F.col("n") / PART))
    unit = (at.join(bucket, ["dim", "t", "b"]).withColumn("own", F.pmod(F.xxhash64("sig"), "parts"))
            .select("sig", "dim", "t", "b", "own", F.explode(F.expr(
                "transform(sequence(0L, parts - 1), i -> struct(least(i, own) as p, greatest(i, own) as q))")).alias("u")))
    unit = unit.join(coded.select("sig", "copies", "v", "h"), "sig")

    def compare(key, table):
        dim, t, b, p, q = (k.as_py() for k in key)
        own, h, copies = table["own"].to_numpy(), _matrix(table["h"]).astype(np.int64), table["copies"].to_numpy()
        x = _scaled(_matrix(table["v"]))
        norm = np.sqrt(np.einsum("ij,ij->i", x, x))
        links, parent = np.zeros(len(x), np.int64), np.arange(len(x))
        for i in range(0, len(x), 512):
            cos = (x[i:i + 512] @ x.T) / (norm[i:i + 512, None] * norm[None, :])
            a, c = np.nonzero(cos >= threshold)
            a += i
            ok = (a < c) & ((own[a] != own[c]) | (p == q))
            a, c = a[ok], c[ok]
            first = (h[a] == h[c]).argmax(axis=1) == t           # the first table in which they meet
            a, c = a[first], c[first]
            np.add.at(links, a, copies[c])
            np.add.at(links, c, copies[a])
            while len(a):                                        # hook each root to the least it is linked with
                ra, rc = parent[a], parent[c]
                lo, hi = np.minimum(ra, rc), np.maximum(ra, rc)
                more = lo < hi
                a, c = a[more], c[more]
                if not len(a):
                    break
                np.minimum.at(parent, hi[more], lo[more])
                while (parent != parent[parent]).any():
                    parent = parent[parent]
        some = np.flatnonzero(links)
        sig = table["sig"].take(pa.array(some, pa.int64()))
        return pa.table({"sig": sig, "links": pa.array(links[some], pa.int64()), "root": table["sig"].take(pa.array(parent[some], pa.int64()))})

    found = saved(unit.select("dim", "t", "b", "u.p", "u.q", "sig", "own", "copies", "v", "h").groupBy("dim", "t", "b", "p", "q")
                  .applyInArrow(compare, f"sig {SIG}, links long, root {SIG}"))
    links = found.groupBy("sig").agg(F.sum("links").alias("others"))
    joined = components(found.select(F.col("sig").alias("a"), F.col("root").alias("b"))).select(F.col("node").alias("sig"), F.col("component").alias("comp"))
    # every vector's class, and every class's component by its least id
    known = classes.select("sig", "copies", "least_id").join(links, "sig", "left").join(joined, "sig", "left").select(
        "sig", "least_id", (F.col("copies") - 1 + F.coalesce("others", F.lit(0))).alias("n_links"), F.coalesce("comp", "sig").alias("comp"))
    least = known.groupBy("comp").agg(F.min("least_id").alias("component_id"))
    known = known.join(least, "comp").select("sig", "n_links", "component_id")
    out = rows.where("sig is not null").select("vec_id", "sig").join(known, "sig").select("vec_id", "n_links", "component_id").union(
        rows.where("sig is null").select("vec_id", F.lit(0).cast("long"), F.col("vec_id").alias("component_id")))
    return out.withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(False)))
