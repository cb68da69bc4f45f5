"""Operator 2: removal of word passages that occur more than once in the corpus.

Rabin-Karp hashes of every window of ``width`` words are counted over all
documents (``blocks``): a block sends its distinct window hashes, each key range
tells which hashes several blocks have, and each block merges its repeated
windows into maximal removal intervals.  A window is repeated if its word
sequence starts at any second place, in the same document or in another.
Hashes have 64 bits: at 10**9 windows the chance of one wrong match is 3 %.

Defined cases: a null or empty text has no words; copies lose all words that a
repeated window covers (every copy, none is spared); extra columns are kept, and
input columns named like a result column are replaced by it.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from regiflow.llm import blocks as B

WIDTH = 35


def _windows(column, width: int):
    data, at = B.text_bytes(column)
    words, first = B.word_hashes(data, at)
    h, where = B.window_hashes(words, first, width)
    keys, inverse, count = np.unique(h, return_inverse=True, return_counts=True)
    return data, at, first, where, keys, inverse, count


def covered(starts: np.ndarray, width: int, n: int) -> np.ndarray:
    """True for each of n words inside a window that begins at one of ``starts``."""
    step = np.zeros(n + 1, np.int64)
    np.add.at(step, starts, 1)
    np.add.at(step, starts + width, -1)
    return np.cumsum(step[:-1]) > 0


def runs(flags: np.ndarray) -> list[tuple[int, int]]:
    """Maximal runs of True as (start, end)."""
    edge = np.flatnonzero(np.diff(np.concatenate(([False], flags, [False])).astype(np.int8)))
    return list(zip(edge[::2].tolist(), edge[1::2].tolist()))


def dedup_substrings(docs: DataFrame, text: str = "text", width: int = WIDTH) -> DataFrame:
    """Every document with ``kept_text`` (remaining words joined by one space),
    ``removed`` (word intervals, end exclusive), ``n_words`` and ``n_removed``."""
    n_blocks, n_ranges = B.sizes(docs, text)
    blocked = B.blocks(docs, n_blocks, text)

    def emit(key, table):
        *_, keys, _, _ = _windows(table[B.TEXT], width)
        return B.sent_rows(B.key_of(key), keys, n_ranges)

    def apply(key, left, right):
        data, at, first, where, keys, inverse, count = _windows(left[B.TEXT], width)
        again = B.repeated_bits(keys, right, n_ranges) | (count > 1)
        drop = covered(where[again[inverse]], width, int(first[-1]))
        kept, cut, n_cut = [], [], []
        for i in range(len(left)):
            words = data[at[i]:at[i + 1]].tobytes().split()
            flags = drop[first[i]:first[i + 1]]
            gone = runs(flags)
            if gone:
                words = [w for w, f in zip(words, flags.tolist()) if not f]
            kept.append(b" ".join(words).decode("utf-8"))
            cut.append([{"start": a, "end": b} for a, b in gone])
            n_cut.append(int(flags.sum()))
        return pa.table({
            B.ROW: B.nullable(left[B.ROW]), "kept_text": pa.array(kept, pa.string()),
            "removed": pa.array(cut, pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))),
            "n_words": pa.array(np.diff(first), pa.int64()), "n_removed": pa.array(n_cut, pa.int64())})

    replies = B.per_range(B.per_block(blocked, emit), B.repeated_across)
    row = blocked.schema[B.ROW].dataType.simpleString()
    out = B.with_answers(blocked, replies, apply, f"{B.ROW} {row}, kept_text string, removed array<struct<start:int,end:int>>, "
                         "n_words long, n_removed long")
    return B.unpacked(out, docs, text)


def digest(found: DataFrame) -> DataFrame:
    return found.select("doc_id", "n_words", "n_removed", F.sha2(F.col("kept_text").cast("binary"), 256).alias("kept_sha256"))


# The same digest in DuckDB SQL, window by window.
ORACLE = r"""
with w as (select row_number() over () as r, doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') as w from documents),
win as (select r, unnest(range(1, len(w) - 33)) as i,
        unnest(list_transform(range(1, len(w) - 33), lambda i: md5(array_to_string(w[i:i + 34], ' ')))) as g from w where len(w) >= 35),
rep as (select r, i from (select r, i, count(*) over (partition by g) as c from win) where c > 1),
gone as (select distinct r, i + d as p from rep, range(35) x(d)),
one as (select r, unnest(range(1, len(w) + 1)) as p, unnest(w) as word from w),
kept as (select r, count(*) as n, string_agg(word, ' ' order by p) as k from one anti join gone using (r, p) group by r)
select doc_id, len(w)::bigint as n_words, (len(w) - coalesce(n, 0))::bigint as n_removed, sha256(coalesce(k, '')) as kept_sha256
from w left join kept using (r)"""
