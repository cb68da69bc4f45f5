"""Operator 10: best-fit packing of tokenised documents into sequences of fixed capacity.

Packing needs only how many pieces there are of each length, which is a table of
at most ``capacity`` rows whatever the corpus; that table alone comes to the
driver.  There the large pieces (above a third of the capacity, at most two in a
sequence) are matched greedily: each, from the longest down, takes the longest
partner that still fits.  The smaller ones, from the longest down, then go to the
sequence with the least sufficient gap, and open a new one where none has room.
Equal sequences are handled as ranges, so the plan's size depends on the capacity
and not on the number of documents.

Every piece finds its place in the plan by its rank among the pieces of its
length.  Ranks are counted per (length, salt), so one very common length is cut
into ``SALTS`` parts.

Defined cases: a null or empty text is the end token alone; equal rows are packed
each; nothing is dropped; result columns replace input columns of their names.
"""

from __future__ import annotations

import bisect
import zlib
from collections import defaultdict
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from regiflow.llm.blocks import nullable, tidy
from regiflow.llm.bpe import REMEMBERED, Encoder, Memory, parts_of
from regiflow.llm.graph import saved_table

CAPACITY, END = 4096, 1
SALTS = 256
AT_ONCE = 20_000      # pieces that the library encodes in one call


class LibraryEncoder(Encoder):
    """Distinct pieces go through the tokenizers library itself."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer
        self.library, self.known = Tokenizer.from_file(path), Memory(REMEMBERED)
        self.library.no_truncation()
        self.library.no_padding()
        vocabulary, end = self.library.get_vocab(with_added_tokens=True), getattr(self.library.model, "end_of_word_suffix", None) or ""
        self.letters = np.zeros(max(vocabulary.values()) + 1, np.int64)       # of each token, without the mark of a word's end
        for token, i in vocabulary.items():
            self.letters[i] = len(token.removesuffix(end))
        same = self.library.normalizer.normalize_str if self.library.normalizer else str
        self.even = all(len(same(chr(c)).encode()) == len(chr(c).encode()) for c in chain(range(0x21, 0x7F), range(0xA1, 0x100)))

    def encode_pieces(self, pieces: list[str]) -> list[bytes]:
        """At most ``AT_ONCE`` pieces at a time: the library's results take many times the ids' room."""
        return list(chain.from_iterable(self._encode_some(pieces[k:k + AT_ONCE]) for k in range(0, len(pieces), AT_ONCE)))

    def _encode_some(self, pieces: list[str]) -> list[bytes]:
        """Pieces without white space inside go 50 to a text."""
        out: list = [None] * len(pieces)
        plain = [i for i, p in enumerate(pieces) if len(p.split()) == 1]
        latin = [i for i in plain if pieces[i].isascii() or max(pieces[i]) < "\u0100"] if self.even else []
        rest = set(latin)
        left = self._by_letters(pieces, latin, out) + [i for i in plain if i not in rest]
        self._by_offsets(pieces, left, out)
        for i, x in enumerate(out):
            if x is None:
                out[i] = np.array(self.library.encode(pieces[i], add_special_tokens=False).ids, "<u4").tobytes()
        return out

    @staticmethod
    def _texts(pieces: list[str], which: list[int]) -> list[str]:
        return [" ".join([pieces[i] for i in which[k:k + 50]]) for k in range(0, len(which), 50)]

    def _by_letters(self, pieces: list[str], which: list[int], out: list) -> list[int]:
        """Pieces told apart by the letters of their tokens, one for each byte; those of texts where
        the letters are not as many as the bytes, or no token ends with a piece, are given back."""
        if not which:
            return []
        ids = [x.ids for x in self.library.encode_batch_fast(self._texts(pieces, which), add_special_tokens=False)]
        flat = np.fromiter(chain.from_iterable(ids), np.int64, sum(map(len, ids)))
        spelt = np.append(0, np.cumsum(self.letters[flat]))
        size = np.fromiter((len(pieces[i].encode()) for i in which), np.int64, len(which))
        text = np.arange(len(which)) // 50
        first_token = np.append(0, np.cumsum(np.fromiter(map(len, ids), np.int64, len(ids))))
        begin = np.cumsum(size) - size
        end = begin + size - begin[text * 50] + spelt[first_token[text]]             # in letters of all texts
        cuts = np.searchsorted(spelt, end)
        met = spelt[np.minimum(cuts, len(flat))] == end
        wrong = np.bincount(text, ~met) > 0
        wrong |= spelt[first_token[1:]] != end[np.minimum(np.arange(1, len(ids) + 1) * 50, len(which)) - 1]
        starts = np.where(np.arange(len(which)) % 50 == 0, first_token[text], np.append(0, cuts[:-1]))
        data, wrong = flat.astype("<u4").tobytes(), wrong[text]
        for i, a, b, bad in zip(which, starts.tolist(), cuts.tolist(), wrong.tolist()):
            if not bad:
                out[i] = data[4 * a:4 * b]
        return [i for i, bad in zip(which, wrong.tolist()) if bad]

    def _by_offsets(self, pieces: list[str], which: list[int], out: list) -> None:
        """Pieces told apart by the places of their tokens in the text."""
        texts, base, starts, ids = self._texts(pieces, which), 0, [], []
        for text, x in zip(texts, self.library.encode_batch(texts, add_special_tokens=False)):
            starts += [base + o[0] for o in x.offsets]
            ids += x.ids
            base += len(text) + 1
        data = np.array(ids, "<u4").tobytes()
        ends = np.cumsum([len(pieces[i]) + 1 for i in which])
        cuts = np.searchsorted(np.array(starts, np.int64), ends).tolist()
        for i, a, b in zip(which, [0, *cuts], cuts):
            out[i] = data[4 * a:4 * b]


_ENCODERS: dict[str, LibraryEncoder] = {}


def tokenise(docs: DataFrame, path: str, capacity: int = CAPACITY, end: int = END, text: str = "text",
             ids: bool = False) -> DataFrame:
    """One row per piece of at most ``capacity`` tokens: the document's other columns, ``piece``,
    ``start``, ``length``, ``ids_crc32`` and, if asked for, ``ids``."""
    new = ["piece", "start", "length", "ids_crc32"] + ["ids"] * ids
    keep = [c for c in docs.columns if c.lower() not in {*new, "sequence_id", "offset", text.lower()}]
    row = F.struct(*[F.col(f"`{c}`") for c in keep]) if keep else F.struct(F.lit(0).alias("_none"))
    source = docs.select(row.alias("_row"), F.col(f"`{text}`").alias("_text"))

    def run(batches):
        import os
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        if path not in _ENCODERS:
            _ENCODERS[path] = LibraryEncoder(path)
        for batch in batches:
            for part in parts_of(batch, "_text"):
                flat, at = _ENCODERS[path].encode(part.column("_text").to_pylist())
                whole = np.insert(flat.astype("<u4"), at[1:], end) if len(at) > 1 else flat.astype("<u4")
                at = at + np.arange(len(at))                       # each document has its end token now
                n = np.diff(at)
                pieces = -(-n // capacity)
                which = np.repeat(np.arange(len(n)), pieces)
                number = np.arange(pieces.sum()) - np.repeat(np.cumsum(pieces) - pieces, pieces)
                start = number * capacity
                length = np.minimum(capacity, n[which] - start)
                begin, raw = at[which] + start, memoryview(whole.tobytes())
                crc = [zlib.crc32(raw[4 * a:4 * b]) for a, b in zip(begin.tolist(), (begin + length).tolist())]
                arrays = [nullable(part.column("_row")).take(pa.array(which, pa.int64())), pa.array(number, pa.int32()),
                          pa.array(start, pa.int64()), pa.array(length, pa.int64()), pa.array(crc, pa.int64())]
                if ids:
                    arrays.append(pa.ListArray.from_arrays(pa.array(np.append(begin, len(whole)), pa.int32()), pa.array(whole.view(np.int32))))
                yield pa.RecordBatch.from_arrays(arrays, ["_row", *new])

    out = source.mapInArrow(tidy(run), f"_row {source.schema['_row'].dataType.simpleString()}, piece int, start long, length long, ids_crc32 long"
                            + ", ids array<int>" * ids)
    return out.select(*[F.col("_row")[c].alias(c) for c in keep], *new)


class Plan:
    """Where the pieces go, as segments: the pieces of ``length`` with ranks from ``rank`` on fill
    the sequences from ``first`` on, ``each`` to a sequence, the first at ``offset``."""

    def __init__(self, counts: dict[int, int], capacity: int):
        self.capacity, self.left = capacity, {k: int(v) for k, v in counts.items() if v}
        self.total, self.used, self.segments = 0, defaultdict(int), []
        self.gaps: list[int] = []                              # sorted, with sequences in `open`
        self.open: dict[int, list[tuple[int, int]]] = {}       # gap -> ranges (first, number)
        self._large()
        self._small()
        s = np.array(sorted(self.segments), np.int64).reshape(-1, 5)
        self.length, self.rank, self.first, self.each, self.offset = s.T.copy()

    def _put(self, length: int, n: int, first: int, each: int, offset: int) -> None:
        self.segments.append((length, self.used[length], first, each, offset))
        self.used[length] += n
        self.left[length] -= n

    def _leave(self, gap: int, first: int, n: int) -> None:
        if gap and n:
            if gap not in self.open:
                bisect.insort(self.gaps, gap)
                self.open[gap] = []
            self.open[gap].append((first, n))

    def _large(self) -> None:
        large = sorted(k for k in self.left if 3 * k > self.capacity)
        for length in reversed(large):
            while self.left[length]:
                fits = bisect.bisect_right(large, min(length, self.capacity - length))
                partner = next((m for m in reversed(large[:fits]) if self.left[m] > (m == length)), None)
                first = self.total
                if partner is None:
                    n = self.left[length]
                    self._put(length, n, first, 1, 0)
                elif partner == length:
                    n = self.left[length] // 2
                    self._put(length, 2 * n, first, 2, 0)
                else:
                    n = min(self.left[length], self.left[partner])
                    self._put(length, n, first, 1, 0)
                    self._put(partner, n, first, 1, length)
                self.total += n
                self._leave(self.capacity - length - (partner or 0), first, n)

    def _small(self) -> None:
        for length in sorted((k for k in self.left if 3 * k <= self.capacity), reverse=True):
            while n := self.left[length]:
                i = bisect.bisect_left(self.gaps, length)
                if i < len(self.gaps):
                    gap = self.gaps[i]
                    first, free = self.open[gap].pop()
                    if not self.open[gap]:
                        del self.open[gap], self.gaps[i]
                else:
                    gap, first = self.capacity, self.total
                    free = -(-n // (gap // length))
                    self.total += free
                each = gap // length
                full = min(free, n // each)
                if full:
                    self._put(length, full * each, first, each, self.capacity - gap)
                    self._leave(gap - each * length, first, full)
                first, free, rest = first + full, free - full, self.left[length]
                if free and 0 < rest < each:
                    self._put(length, rest, first, rest, self.capacity - gap)
                    self._leave(gap - rest * length, first, 1)
                    first, free = first + 1, free - 1
                self._leave(gap, first, free)

    def place(self, length: np.ndarray, rank: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(sequence, offset) of the pieces of these lengths and ranks."""
        key = np.int64(1) << np.int64(40)        # ranks of a length stay below 2**40
        at = np.searchsorted(self.length * key + self.rank, length * key + rank, side="right") - 1
        n = rank - self.rank[at]
        return self.first[at] + n // self.each[at], self.offset[at] + n % self.each[at] * length


def pack(docs: DataFrame, path: str, capacity: int = CAPACITY, end: int = END, text: str = "text") -> DataFrame:
    """The rows of ``tokenise`` with ``sequence_id`` and ``offset`` (gapless from 0 in each sequence)."""
    spark = docs.sparkSession
    pieces = saved_table(tokenise(docs, path, capacity, end, text))
    rest = pieces.columns
    order = [c for c, t in pieces.dtypes if t in ("bigint", "string")]        # any total order of different pieces
    salted = pieces.select(F.struct(*rest).alias("_row"), "length", F.struct("start", "ids_crc32", *order).alias("_order")).withColumn(
        "_salt", F.pmod(F.xxhash64("_order"), F.lit(SALTS)))
    counts = salted.groupBy("length", "_salt").agg(F.count("*").alias("n"))
    lengths = {r["length"]: r["n"] for r in counts.groupBy("length").agg(F.sum("n").alias("n")).collect()}   # at most `capacity` rows
    plan = spark.sparkContext.broadcast(Plan(lengths, capacity))
    before = F.sum("n").over(Window.partitionBy("length").orderBy("_salt")) - F.col("n")
    base = counts.select(F.col("length"), F.col("_salt"), before.alias("_base"))
    own = F.row_number().over(Window.partitionBy("length", "_salt").orderBy("_order"))
    ranked = salted.withColumn("_own", own).join(base, ["length", "_salt"]).select(
        "_row", "length", (F.col("_base") + F.col("_own") - 1).cast("long").alias("_rank"))

    def locate(batches):
        p = plan.value
        for b in batches:
            seq, offset = p.place(b.column("length").to_numpy().astype(np.int64), b.column("_rank").to_numpy().astype(np.int64))
            yield pa.RecordBatch.from_arrays([nullable(b.column("_row")), pa.array(seq, pa.int64()), pa.array(offset, pa.int64())],
                                             ["_row", "sequence_id", "offset"])

    out = ranked.mapInArrow(tidy(locate), f"_row {ranked.schema['_row'].dataType.simpleString()}, sequence_id long, offset long")
    return out.select(*[F.col("_row")[c].alias(c) for c in rest], "sequence_id", "offset")


def sequences(pieces: DataFrame, placed: DataFrame, keys: list[str]) -> DataFrame:
    """(sequence_id, ids): the sequences themselves, from pieces with ``ids``; at most ``capacity`` tokens each."""
    both = pieces.join(placed.select(*keys, "piece", "sequence_id", "offset"), [*keys, "piece"])
    return both.groupBy("sequence_id").agg(F.array_sort(F.collect_list(F.struct("offset", "ids"))).alias("x")).select(
        "sequence_id", F.flatten(F.col("x.ids")).alias("ids"))
