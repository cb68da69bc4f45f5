"""Operator 8: removal of byte strings that occur more than once, by a logarithmic family of suffix arrays.

Indexing every byte of the corpus would cost hundreds of times the input in
shuffle, so the suffix arrays are sparse and content-defined: every window of
``length`` bytes owns one anchor, the least hashed k-gram inside it (the last one
of equals).  Equal windows own equal anchors at equal places, so two windows only
have to be compared if their anchors are equal.

1. ``blocks`` counts the anchors of all documents; those met once are dropped.
2. For each anchor met again, the bytes around it that its windows cover go to
   the anchor's key range, equal stretches of a block once.
3. There each arriving batch is sorted into a suffix array (the bytes right of the
   anchors) with its longest common prefixes, and a second order over the bytes
   to the left.  Batches become levels; levels of equal size are merged
   geometrically, and while two levels are merged the merged array is scanned for
   matches between them.  A window is repeated if another entry agrees with it on
   both sides far enough.
4. An anchor with more than ``HOT`` stretches would make one group too large.  Of such
   anchors the blocks send the distinct hashes of their windows instead, which
   spread over all key ranges, and learn which occur more than once.
5. Each block turns its repeated windows into maximal removed spans.

Windows are judged on the input; every copy is removed, none is spared.

Defined cases: null and empty texts count as no bytes; windows never cross
documents; extra columns are kept, input columns named like a result column are
replaced; runs of one byte and NUL bytes need no special handling.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from regiflow.llm import blocks as B

LENGTH = 400
GRAM = 32              # bytes hashed to choose anchors
BATCH = 1024           # entries of a level-0 suffix array
HOT = 1 << 15          # stretches of an anchor up to which they are compared in one key range (about 1.2 KB each)
_U = np.uint64


# ---------------------------------------------------------------- anchors

def _sliding_min(x: np.ndarray, width: int) -> np.ndarray:
    """Minimum of every ``width`` consecutive values."""
    n = len(x) - width + 1
    y = np.full(-(-len(x) // width) * width, np.iinfo(_U).max, _U)
    y[:len(x)] = x
    y = y.reshape(-1, width)
    left = np.minimum.accumulate(y, axis=1).ravel()
    right = np.ascontiguousarray(np.minimum.accumulate(y[:, ::-1], axis=1)[:, ::-1]).ravel()
    return np.minimum(right[:n], left[width - 1:width - 1 + n])


class Anchors:
    """For the texts of a block: each run of windows that own one anchor.

    ``key``: the anchor's hash; ``first``..``last``: starts of its windows (places in
    the block's bytes); ``place``: the anchor; ``digest``: hash of all that its
    windows cover and of where the anchor stands in it.
    """

    def __init__(self, column, length: int, gram: int):
        self.data, self.at = B.text_bytes(column)
        parts = [self._part(i, j, length, gram) for i, j in B.groups_of(self.at, B.CHUNK)]
        parts = [p for p in parts if p is not None]
        empty = np.zeros(0, np.int64)
        self.key, self.first, self.last, self.place, self.digest = (
            [np.concatenate(x) for x in zip(*parts)] if parts else
            [empty.astype(_U), empty, empty, empty, empty.astype(_U)])

    def _part(self, i, j, length, gram):
        base = self.at[i]
        data, at = self.data[base:self.at[j]], self.at[i:j + 1] - base
        if len(data) < length:
            return None
        roll = B.Rolling(data.astype(_U) + _U(1), B.BYTE_BASE)
        h = B.mix(roll.windows(gram))
        bits = int(len(h)).bit_length()
        low = _U((1 << bits) - 1)
        ranked = (h & ~low) | (low - np.arange(len(h), dtype=_U))        # the last of equal k-grams is least
        own = (low - (_sliding_min(ranked, length - gram + 1) & low)).astype(np.int64)
        starts = np.arange(len(own))
        doc_end = np.repeat(at[1:], np.diff(at))[:len(own)]
        ok = starts + length <= doc_end
        if not ok.any():
            return None
        starts, own, doc_end = starts[ok], own[ok], doc_end[ok]
        new = np.ones(len(starts), bool)
        new[1:] = (own[1:] != own[:-1]) | (doc_end[1:] != doc_end[:-1])
        head = np.flatnonzero(new)
        first, last, place = starts[head], starts[np.append(head[1:], len(starts)) - 1], own[head]
        whole = roll.spans(first, last + length)
        digest = B.mix(whole + B.mix(((place - first) * 1024 + (last - first)).astype(_U) + _U(1)))
        # the least hashes of many are small numbers: mixed again, they spread over the key ranges
        return B.mix(h[place]), first + base, last + base, place + base, digest


    def starts(self, run: np.ndarray) -> np.ndarray:
        """The windows of the given runs, by their starts."""
        n = self.last[run] - self.first[run] + 1
        return np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n) + np.repeat(self.first[run], n)

    def windows(self, starts: np.ndarray, length: int) -> np.ndarray:
        """Hashes of the windows that begin at the starts."""
        out = np.zeros(len(self.data), _U)
        for i, j in B.groups_of(self.at, B.CHUNK):
            part = self.data[self.at[i]:self.at[j]]
            h = B.mix(B.Rolling(part.astype(_U) + _U(1), B.BYTE_BASE).windows(length))
            out[self.at[i]:self.at[i] + len(h)] = h
        return out[starts]


def _distinct(a: Anchors):
    """(one entry of each distinct stretch, its number of occurrences, entry -> stretch)."""
    _, at, inverse, count = np.unique(a.digest, return_index=True, return_inverse=True, return_counts=True)
    return at, count, inverse


# ---------------------------------------------------------------- suffix arrays

class Entries:
    """Anchored stretches of one key range: the bytes right and left of each anchor, padded with zeros."""

    def __init__(self, n: int, length: int, gram: int):
        self.length, self.most, self.n = length, length - gram, 0
        self.key, self.lo, self.hi = np.empty(n, _U), np.empty(n, np.int64), np.empty(n, np.int64)
        self.right, self.left = np.empty((n, length), np.uint8), np.empty((n, self.most), np.uint8)
        self.flags = np.zeros((n, self.most + 1), bool)     # window that begins x bytes before the anchor

    def add(self, table: pa.Table) -> np.ndarray:
        """The rows' entries; returns their numbers."""
        get = lambda c, t: np.frombuffer(b"".join(table[c].to_pylist()), t)
        lo, hi = get("lo", np.int16).astype(np.int64), get("hi", np.int16).astype(np.int64)
        data = np.concatenate((np.zeros(self.most, np.uint8), get("bytes", np.uint8), np.zeros(self.length, np.uint8)))
        size = hi + self.length - lo                        # from the first window's start to the last one's end
        end = np.cumsum(size) + self.most
        place = end - size + hi
        ids = np.arange(self.n, self.n + len(lo))
        self.n += len(lo)
        self.key[ids], self.lo[ids], self.hi[ids] = get("keys", _U), lo, hi
        for i in range(0, len(ids), 4096):
            s = slice(i, i + 4096)
            right = np.lib.stride_tricks.sliding_window_view(data, self.length)[place[s]]
            right[np.arange(self.length)[None, :] >= (end - place)[s, None]] = 0
            left = np.lib.stride_tricks.sliding_window_view(data, self.most)[place[s] - self.most][:, ::-1].copy()
            left[np.arange(self.most)[None, :] >= hi[s, None]] = 0
            self.right[ids[s]], self.left[ids[s]] = right, left
        return ids

    @staticmethod
    def order(number: np.ndarray, kind: str, text: np.ndarray) -> np.ndarray:
        """Stable order by a number, then by text (runs already in order are merged)."""
        width = np.dtype(kind).itemsize
        wide = np.concatenate((number.astype(kind).view(np.uint8).reshape(-1, width), text), axis=1)
        return np.argsort(wide.view(f"S{wide.shape[1]}").ravel(), kind="stable")


def _common(text: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Length of the common prefix of rows a and b, pair by pair."""
    out = np.empty(len(a), np.int64)
    for i in range(0, len(a), 4096):
        differ = text[a[i:i + 4096]] != text[b[i:i + 4096]]
        n = differ.argmax(axis=1)
        out[i:i + 4096] = np.where(differ[np.arange(len(n)), n], n, text.shape[1])
    return out


class LevelFamily:
    """Sparse suffix arrays of geometrically growing size: each level holds entry numbers in the
    order of (anchor, bytes to the right)."""

    def __init__(self, entries: Entries):
        self.entries, self.levels = entries, []

    def add(self, ids: np.ndarray) -> None:
        """A new batch: sorted, scanned in itself, then merge-scanned with levels up to its size."""
        level = ids[Entries.order(self.entries.key[ids], ">u8", self.entries.right[ids])]
        self._scan(level, None)
        while self.levels and len(self.levels[-1]) <= 2 * len(level):
            level = self._merge(self.levels.pop(), level)
        self.levels.append(level)

    def finish(self) -> np.ndarray:
        """Merge-scan what levels are left; the entries' flags."""
        while len(self.levels) > 1:
            b, a = self.levels.pop(), self.levels.pop()
            self.levels.append(self._merge(a, b))
        return self.entries.flags

    def _merge(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        both = np.concatenate((a, b))
        order = Entries.order(self.entries.key[both], ">u8", self.entries.right[both])
        self._scan(both[order], (order >= len(a)).astype(np.int8))
        return both[order]

    def _scan(self, ids: np.ndarray, side: np.ndarray | None) -> None:
        """Mark windows that two entries of the level share (of different sides, where sides are given)."""
        e = self.entries
        if len(ids) < 2:
            return
        key = e.key[ids]
        group = np.concatenate(([0], np.cumsum(key[1:] != key[:-1])))
        size = np.bincount(group)
        wanted = size > 1
        if side is not None:       # only groups that both sides have
            wanted &= (np.bincount(group, side) > 0) & (np.bincount(group, 1 - side) > 0)
        two = np.flatnonzero(wanted & (size == 2))
        if len(two):
            i = (np.cumsum(size) - size)[two]
            a, b = ids[i], ids[i + 1]
            lo = np.maximum(np.maximum(e.lo[a], e.lo[b]), e.length - _common(e.right, a, b))
            hi = np.minimum(np.minimum(e.hi[a], e.hi[b]), _common(e.left, a, b))
            count = np.maximum(0, hi - lo + 1)
            x = np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count) + np.repeat(lo, count)
            e.flags[np.repeat(a, count), x] = True
            e.flags[np.repeat(b, count), x] = True
        pick = np.flatnonzero((wanted & (size > 2))[group])
        if len(pick):
            self._scan_groups(ids[pick], group[pick])

    def _scan_groups(self, ids: np.ndarray, group: np.ndarray) -> None:
        e, n = self.entries, len(ids)
        lo, hi = e.lo[ids], e.hi[ids]
        r, l = np.full(n, -1), np.full(n, -1)
        r[1:] = np.where(group[1:] == group[:-1], _common(e.right, ids[1:], ids[:-1]), -1)
        by_left = Entries.order(group, ">u4", e.left[ids])
        lg, li = group[by_left], ids[by_left]
        l[1:] = np.where(lg[1:] == lg[:-1], _common(e.left, li[1:], li[:-1]), -1)
        left_run = np.empty(n, np.int64)
        for x in range(int(lo.min()), int(hi.max()) + 1):
            live = np.flatnonzero((lo <= x) & (hi >= x))
            if len(live) < 2:
                continue
            # entries that agree on the length - x bytes to the right, and on the x bytes to the left
            left_run[by_left] = np.cumsum(l < x)
            key = np.cumsum(r < e.length - x)[live] * (n + 1) + left_run[live]
            order = np.argsort(key)
            s = key[order]
            again = np.zeros(len(s), bool)
            again[1:] = s[1:] == s[:-1]
            again[:-1] |= again[1:]
            e.flags[ids[live[order[again]]], x] = True


# ---------------------------------------------------------------- the job

STRETCH = "range int, block long, keys binary, digests binary, lo binary, hi binary, bytes binary"


def _met(table: pa.Table, hot: int) -> pa.Table:
    """Answer: for each block, a bit for each of its anchors that other blocks have too, and one
    for each that has more than ``hot`` stretches."""
    _, keys, at = B.received(table)
    _, inverse, blocks = np.unique(keys, return_inverse=True, return_counts=True)
    n = np.bincount(inverse, B.counts_of(table), len(blocks))
    both = np.stack((blocks > 1, n > hot))[:, inverse]
    parts = [both[:, a:b] for a, b in zip(at, at[1:])]
    return B.reply_rows(table, [np.packbits(p).tobytes() if p.any() else None for p in parts])


def _met_bits(keys: np.ndarray, answers: pa.Table, n: int) -> np.ndarray:
    """The two bits of ``_met`` alongside a block's distinct sorted anchors."""
    at, out = B.cuts(keys, n), np.zeros((2, len(keys)), bool)
    for r, bits in zip(answers["range"].to_pylist(), answers["reply"].to_pylist()):
        a, b = at[r], at[r + 1]
        out[:, a:b] = np.unpackbits(np.frombuffer(bits, np.uint8), count=2 * (b - a)).reshape(2, -1)
    return out


def _shared_windows(table: pa.Table) -> pa.Table:
    """Answer: for each block, the hashes of its windows that occur more than once in all blocks."""
    keys = [np.frombuffer(x, _U) for x in table["keys"].to_pylist()]
    _, inverse = np.unique(np.concatenate(keys), return_inverse=True)
    again = (np.bincount(inverse, np.frombuffer(b"".join(table["bytes"].to_pylist()), np.uint8)) > 1)[inverse]
    at = np.concatenate(([0], np.cumsum([len(k) for k in keys])))
    return B.reply_rows(table, [k[again[a:b]].tobytes() if again[a:b].any() else None for k, a, b in zip(keys, at, at[1:])])


def dedup_bytes(docs: DataFrame, text: str = "text", length: int = LENGTH, gram: int = GRAM, hot: int = HOT) -> DataFrame:
    """Every document with ``kept`` (remaining bytes), ``removed`` (byte spans, end exclusive),
    ``n_bytes``, ``n_removed`` and ``n_spans``."""
    n_blocks, n_ranges = B.sizes(docs, text)
    blocked = B.blocks(docs, n_blocks, text)

    def emit(key, table):
        a = Anchors(table[B.TEXT], length, gram)
        keys, inverse = np.unique(a.key, return_inverse=True)
        n = np.bincount(inverse[_distinct(a)[0]], minlength=len(keys))
        return B.sent_rows(B.key_of(key), keys, n_ranges, n.astype(np.int32))

    def stretches(key, left, right):
        a = Anchors(left[B.TEXT], length, gram)
        keys, inverse, count = np.unique(a.key, return_inverse=True, return_counts=True)
        met, many = _met_bits(keys, right, n_ranges)
        again, many = (met | (count > 1))[inverse], many[inverse]
        at, _, _ = _distinct(a)
        at = at[again[at] & ~many[at]]
        at = at[np.argsort(a.key[at], kind="stable")]
        edge = B.cuts(a.key[at], 2 * n_ranges)
        rows = []
        for r in np.flatnonzero(np.diff(edge)):
            i = at[edge[r]:edge[r + 1]]
            data = b"".join(a.data[s:e].tobytes() for s, e in zip(a.first[i], a.last[i] + length))
            rows.append((int(r), B.key_of(key), a.key[i].tobytes(), a.digest[i].tobytes(),
                         (a.place - a.last)[i].astype(np.int16).tobytes(), (a.place - a.first)[i].astype(np.int16).tobytes(), data))
        if many.any():
            w, n = np.unique(a.windows(a.starts(np.flatnonzero(many)), length), return_counts=True)
            edge = B.cuts(w, 2 * n_ranges)
            for r in np.flatnonzero(np.diff(edge)):
                i = slice(edge[r], edge[r + 1])
                rows.append((int(r) + 2 * n_ranges, B.key_of(key), w[i].tobytes(), b"", b"", b"", np.minimum(n[i], 2).astype(np.uint8).tobytes()))
        return pa.table([pa.array(c, t) for c, t in zip(zip(*rows) if rows else [[]] * 7, [pa.int32(), pa.int64()] + [pa.binary()] * 5)],
                        names=["range", "block", "keys", "digests", "lo", "hi", "bytes"])

    def index(table):
        if table["range"][0].as_py() >= 2 * n_ranges:
            return _shared_windows(table)
        counts = [len(x) // 8 for x in table["digests"].to_pylist()]
        entries = Entries(sum(counts), length, gram)
        family, i = LevelFamily(entries), 0
        while i < len(counts):            # rows of several blocks make one batch
            j, n = i, 0
            while j < len(counts) and n < BATCH:
                n, j = n + counts[j], j + 1
            family.add(entries.add(table.slice(i, j - i)))
            i = j
        flags, at, replies = family.finish(), np.concatenate(([0], np.cumsum(counts))), []
        for k, digests in enumerate(table["digests"].to_pylist()):
            mine = flags[at[k]:at[k + 1]]
            some = mine.any(axis=1)
            if not some.any():
                replies.append(None)
                continue
            d = np.frombuffer(digests, _U)[some]
            replies.append(len(d).to_bytes(4, "little") + d.tobytes() + np.packbits(mine[some], axis=1).tobytes())
        return B.reply_rows(table, replies)

    def apply(key, left, right):
        a = Anchors(left[B.TEXT], length, gram)
        at, count, inverse = _distinct(a)
        width = length - gram + 1
        flags = np.zeros((len(at), width), bool)
        shared = [np.zeros(0, _U)]
        for r, x in zip(right["range"].to_pylist(), right["reply"].to_pylist()):
            if r >= 2 * n_ranges:
                shared.append(np.frombuffer(x, _U))
                continue
            n = int.from_bytes(x[:4], "little")
            bits = np.unpackbits(np.frombuffer(x, np.uint8, offset=4 + 8 * n).reshape(n, -1), axis=1, count=width).astype(bool)
            flags[np.searchsorted(a.digest[at], np.frombuffer(x, _U, n, 4))] |= bits
        flags[count > 1] = True
        entry, x = np.nonzero(flags[inverse]) if len(at) else (np.zeros(0, np.int64),) * 2
        start = a.place[entry] - x
        start = start[(start >= a.first[entry]) & (start <= a.last[entry])]
        if len(shared) > 1:
            every = a.starts(np.arange(len(a.first)))
            start = np.union1d(start, every[np.isin(a.windows(every, length), np.concatenate(shared))])
        step = np.zeros(len(a.data) + 1, np.int32)
        np.add.at(step, start, 1)
        np.add.at(step, start + length, -1)
        drop = np.cumsum(step[:-1]) > 0
        kept, cut, n_cut = [], [], []
        for s, e in zip(a.at, a.at[1:]):
            f = drop[s:e]
            gone = _runs(f)
            kept.append(a.data[s:e][~f].tobytes() if gone else a.data[s:e].tobytes())
            cut.append([{"start": p, "end": q} for p, q in gone])
            n_cut.append(sum(q - p for p, q in gone))
        return pa.table({B.ROW: B.nullable(left[B.ROW]), "kept": pa.array(kept, pa.binary()),
                         "removed": pa.array(cut, pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))),
                         "n_bytes": pa.array(np.diff(a.at), pa.int64()), "n_removed": pa.array(n_cut, pa.int64())})

    row = blocked.schema[B.ROW].dataType.simpleString()
    met = B.per_range(B.per_block(blocked, emit), lambda table: _met(table, hot))
    found = B.per_range(B.with_answers(blocked, met, stretches, STRETCH), index)
    out = B.with_answers(blocked, found, apply, f"{B.ROW} {row}, kept binary, removed array<struct<start:int,end:int>>, "
                         "n_bytes long, n_removed long").withColumn("n_spans", F.size("removed").cast("long"))
    return B.unpacked(out, docs, text)


def _rest() -> Column:
    rest = F.col("kept").cast("string")
    return F.when(F.is_valid_utf8(rest), rest).otherwise(F.regexp_replace(F.make_valid_utf8(rest), "\ufffd", ""))


def rest_as_text(found: DataFrame, docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` with the remaining bytes as text (a character cut in two is dropped); documents of
    which no word remains are dropped, unless they had none."""
    left = found.withColumn(text, _rest()).where((F.col("n_removed") == 0) | F.col(text).rlike(r"[^\x20\x09-\x0D]"))
    return left.select(docs.columns)


def _runs(flags: np.ndarray) -> list[tuple[int, int]]:
    if not flags.any():
        return []
    edge = np.flatnonzero(np.diff(np.concatenate(([0], flags.view(np.int8), [0]))))
    return list(zip(edge[::2].tolist(), edge[1::2].tolist()))


def digest(found: DataFrame) -> DataFrame:
    """The result's figures; ``text``: what remains, without characters that were cut in two."""
    return found.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"), _rest().alias("text"))
