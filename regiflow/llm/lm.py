"""Operator 3: n-gram language-model scores from Elias-Fano tries.

The model is an interpolated Witten-Bell n-gram model of all training tokens,
cut into key ranges by context.  In each range the n-grams of an order are one
trie level in a memory-mapped file; that of single words has the sorted words and
the running sum of their counts, both Elias-Fano coded, the others:

* contexts, sorted, as an Elias-Fano sequence, and Elias-Fano pointers to where
  each one's successors begin;
* successor words, ascending inside a context; adding the context's rank times
  2**WORD_BITS makes them one monotone sequence, again Elias-Fano coded;
* the discounted probability of each successor and the weight of the lower order
  of each context, quantised to two bytes on a logarithmic scale.

A query finds its context, takes the pointers' range and searches the successor
of its word relative to that context.  Blocks of documents send their distinct
n-grams with their training counts once (``blocks``), each context once with its
successors; the same exchange carries what is learnt and what is asked.

An n-gram is known by 64 bits: of two words 36 of its context and 28 of its word, of
more words, which have more contexts and fewer successors, 40 and 24 (of 10**9
contexts about 0.1 % share their bits with another).  Quantised
values differ from the exact ones by at most 0.03 %; the scale reaches down to
2**-48, below the share of one n-gram in any context met fewer than 10**14 times.

Defined cases: null and empty texts are the end token alone; a null id is a
training document; without training tokens the scores are those of the base.
"""

from __future__ import annotations

import tempfile

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from regiflow.llm import blocks as B

ORDER = 3
WORD_BITS, LONG_WORD_BITS = 28, 24      # of n-grams of two words, of more words
_U = np.uint64
BEGIN, END = _U(0x243F6A8885A308D3), _U(0x13198A2E03707344)
STEPS, OCTAVES = 65534, 48.0          # quantisation: 65534 steps over 48 octaves


# ---------------------------------------------------------------- compact levels

class EliasFano:
    """A monotone sequence: low bits packed, high bits in unary."""

    def __init__(self, n: int, low_bits: int, low: np.ndarray, high: np.ndarray):
        self.n, self.low_bits, self.low, self.high = n, low_bits, low, high
        self._values = None

    @classmethod
    def encode(cls, values: np.ndarray) -> "EliasFano":
        n = len(values)
        top = int(values[-1]) + 1 if n else 1
        bits = min(63, max(0, (top // max(n, 1)).bit_length() - 1))
        low = (values[:, None] >> np.arange(bits, dtype=_U)) & _U(1)
        ones = (values >> _U(bits)).astype(np.int64) + np.arange(n)
        high = np.zeros(int(ones[-1]) + 1 if n else 0, np.uint8)
        high[ones] = 1
        return cls(n, bits, np.packbits(low.astype(np.uint8).ravel()), np.packbits(high))

    def values(self) -> np.ndarray:
        if self._values is None:
            high = np.flatnonzero(np.unpackbits(self.high))[:self.n] - np.arange(self.n)
            out = high.astype(_U) << _U(self.low_bits)
            if self.low_bits:
                low = np.unpackbits(self.low, count=self.n * self.low_bits).reshape(self.n, self.low_bits)
                out |= (low.astype(_U) << np.arange(self.low_bits, dtype=_U)).sum(axis=1, dtype=_U)
            self._values = out
        return self._values

    def successor(self, x: np.ndarray) -> np.ndarray:
        """Index of the first value >= x (n if there is none)."""
        return np.searchsorted(self.values(), x)


class Levels:
    """Arrays in one file, read back memory-mapped."""

    def __init__(self):
        self.file, self.parts, self.at = tempfile.TemporaryFile(), [], 0

    def put(self, a: np.ndarray) -> int:
        self.file.write(np.ascontiguousarray(a).tobytes())
        self.parts.append((self.at, len(a), a.dtype))
        self.at += a.nbytes
        return len(self.parts) - 1

    def get(self, i: int) -> np.ndarray:
        at, n, kind = self.parts[i]
        self.file.flush()
        return np.memmap(self.file, kind, "r", at, (n,)) if n else np.zeros(0, kind)


def quantise(x: np.ndarray) -> np.ndarray:
    """Probabilities as 16-bit codes: 0 for 0, else 1..65535 on a logarithmic scale from 2**-OCTAVES up."""
    with np.errstate(divide="ignore"):
        step = np.rint((np.log2(x) + OCTAVES) * STEPS / OCTAVES)
    return np.where(x > 0, 1 + np.clip(step, 0, STEPS), 0).astype(np.uint16)


VALUE = np.concatenate(([0.0], np.exp2(np.arange(STEPS + 1) * OCTAVES / STEPS - OCTAVES)))


class _Level:
    """Elias-Fano sequences by name in one file."""

    def __init__(self, **sequences: np.ndarray):
        self.file, self.coded = Levels(), {}
        for name, x in sequences.items():
            e = EliasFano.encode(x)
            self.coded[name] = (e.n, e.low_bits, self.file.put(e.low), self.file.put(e.high))

    def _sequence(self, name: str) -> EliasFano:
        n, bits, low, high = self.coded[name]
        return EliasFano(n, bits, self.file.get(low), self.file.get(high))


class WordLevel(_Level):
    """The single words of one key range with their exact counts."""

    def __init__(self, keys: np.ndarray, counts: np.ndarray):
        """``keys``: sorted words with training counts > 0."""
        super().__init__(word=keys, below=np.append(0, np.cumsum(counts)).astype(_U))

    def query(self, keys: np.ndarray) -> np.ndarray:
        """Counts of the words."""
        word, below = self._sequence("word"), self._sequence("below").values().astype(np.int64)
        if not word.n:
            return np.zeros(len(keys), np.int64)
        place = np.minimum(word.successor(keys), word.n - 1)
        return np.where(word.values()[place] == keys, below[place + 1] - below[place], 0)


class TrieLevel(_Level):
    """One order of the model above single words in one key range."""

    def __init__(self, keys: np.ndarray, counts: np.ndarray, word_bits: int = WORD_BITS):
        """``keys``: sorted (context, word) keys with training counts > 0."""
        self.word_bits = word_bits
        context, first = np.unique(keys >> _U(word_bits), return_index=True)
        distinct = np.diff(np.append(first, len(keys)))
        total = np.add.reduceat(counts, first) if len(first) else np.zeros(0, np.int64)
        rank = np.repeat(np.arange(len(context)), distinct)
        word = (keys & _U((1 << word_bits) - 1)) | (rank.astype(_U) << _U(word_bits))
        super().__init__(context=context, pointer=np.append(first, len(keys)).astype(_U), word=word)
        self.alpha = self.file.put(quantise(counts / (total + distinct)[rank]))
        self.gamma = self.file.put(quantise(distinct / (total + distinct)))

    def query(self, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Codes of (discounted probability, weight of the lower order) of the n-grams."""
        context, pointer, word = (self._sequence(x) for x in ("context", "pointer", "word"))
        alpha, gamma = np.zeros(len(keys), np.uint16), np.full(len(keys), 1 + STEPS, np.uint16)     # unseen context: 0 and 1
        if not context.n:
            return alpha, gamma
        asked = keys >> _U(self.word_bits)
        rank = np.minimum(context.successor(asked), context.n - 1)
        seen = np.flatnonzero(context.values()[rank] == asked)
        rank = rank[seen]
        gamma[seen] = self.file.get(self.gamma)[rank]
        own = (keys[seen] & _U((1 << self.word_bits) - 1)) | (rank.astype(_U) << _U(self.word_bits))
        place = word.successor(own)
        ends = pointer.values().astype(np.int64)
        inside = (place >= ends[rank]) & (place < ends[rank + 1])
        hit = np.flatnonzero(inside)
        hit = hit[word.values()[place[hit]] == own[hit]]
        alpha[seen[hit]] = self.file.get(self.alpha)[place[hit]]
        return alpha, gamma


# ---------------------------------------------------------------- documents

def tokens(column) -> tuple[np.ndarray, np.ndarray]:
    """(token hashes with an end after each text, where each text's tokens begin)."""
    data, at = B.text_bytes(column)
    words, first = B.word_hashes(data, at, lower=True)
    begin = first + np.arange(len(first))
    out = np.empty(begin[-1], _U)
    ends = begin[1:] - 1
    place = np.ones(len(out), bool)
    place[ends] = False
    out[place], out[ends] = words, END
    return out, begin


def word_bits(order: int) -> int:
    return WORD_BITS if order == 2 else LONG_WORD_BITS


def ngram_keys(token: np.ndarray, begin: np.ndarray, order: int) -> np.ndarray:
    """The key of the n-gram that ends at each token (of the token itself for order 1)."""
    if order == 1:
        return B.mix(token)
    context = np.zeros(len(token), _U)
    for back in range(1, order):
        before = np.empty(len(token), _U)
        before[back:], before[:back] = token[:-back or None], BEGIN
        for b in range(back):                 # the first tokens of a text see its beginning
            at = begin[:-1] + b
            before[at[at < begin[1:]]] = BEGIN
        context = B.mix(context * B.WORD_BASE + before)
    bits = word_bits(order)
    return (context & ~_U((1 << bits) - 1)) | (B.mix(token) >> _U(64 - bits))


HELD = 1 << 19        # distinct words that a task of ``totals`` gathers before it sends them


def _unigrams(table: pa.Table, train: str, text: str) -> tuple[np.ndarray, np.ndarray]:
    """(distinct words of the training rows, sorted, their counts)."""
    token, begin = tokens(table[text])
    keep = np.repeat(table[train].to_numpy(zero_copy_only=False).astype(bool), np.diff(begin))
    return np.unique(ngram_keys(token, begin, 1)[keep], return_counts=True)


def _added(keys: np.ndarray, count: np.ndarray, more: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    both, inverse = np.unique(np.concatenate((keys, more)), return_inverse=True)
    out = np.zeros(len(both), np.int64)
    np.add.at(out, inverse, np.concatenate((count, n)))
    return both, out


def _opens(keys: np.ndarray, bits: int) -> np.ndarray:
    """True at the first of each context's sorted n-grams."""
    context = keys >> _U(bits)
    return np.append(np.ones(min(1, len(keys)), bool), context[1:] != context[:-1])


def pack_ngrams(keys: np.ndarray, bits: int) -> bytes:
    """Sorted n-grams, all bits kept: each context once, how many successors it has, and these."""
    first = np.flatnonzero(_opens(keys, bits))
    return B.joined(B.pack_steps(keys[first] >> _U(bits)), B.pack_values(np.diff(np.append(first, len(keys))) - 1),
                    B.pack_listed(keys & _U((1 << bits) - 1)))


def unpack_ngrams(data: bytes, bits: int) -> np.ndarray:
    context, more, word = B.parted(data)
    return np.repeat(B.unpack_steps(context), B.unpack_values(more).astype(np.int64) + 1) << _U(bits) | B.unpack_listed(word)


def pack_codes(keys: np.ndarray, bits: int, alpha: np.ndarray, gamma: np.ndarray) -> bytes:
    """The reply to ``keys``: the codes of the n-grams, and those of their contexts once each."""
    return B.joined(B.pack_listed(alpha), B.pack_listed(gamma[_opens(keys, bits)]))


def unpack_codes(data: bytes, keys: np.ndarray, bits: int) -> np.ndarray:
    alpha, gamma = map(B.unpack_listed, B.parted(data))
    return np.stack((alpha, gamma[np.cumsum(_opens(keys, bits)) - 1])).astype(np.uint16)


def totals(docs: DataFrame, n_ranges: int) -> tuple[int, int]:
    """(N, V): training tokens and distinct ones, of all rows with ``_train``."""
    def emit(batches):
        keys, n = np.zeros(0, _U), np.zeros(0, np.int64)
        for b in batches:
            keys, n = _added(keys, n, *_unigrams(pa.Table.from_batches([b]), "_train", "_text"))
            if len(keys) > HELD:
                yield from B.sent_rows(0, keys, n_ranges, n, B.pack_steps).to_batches()
                keys, n = keys[:0], n[:0]
        if len(keys):
            yield from B.sent_rows(0, keys, n_ranges, n, B.pack_steps).to_batches()

    def count(table):
        _, keys, _ = B.received(table, B.unpack_steps)
        n = B.counts_of(table, np.int64)
        return pa.table({"n": pa.array([int(n.sum())], pa.int64()), "v": pa.array([len(np.unique(keys))], pa.int64())})

    got = B.per_range(docs.select("_text", "_train").mapInArrow(emit, B.SENT), count, "n long, v long").agg(F.sum("n"), F.sum("v")).first()
    return got[0] or 0, got[1] or 0


def score(docs: DataFrame, held_out, order: int = ORDER, text: str = "text") -> DataFrame:
    """Every document with ``held_out``, ``n_tokens``, ``n_known``, ``train_tokens``,
    ``base_score`` and ``score``; the model learns from rows whose ``held_out`` is not true."""
    marked = docs.withColumn("_held", F.coalesce(held_out, F.lit(False)))
    n_blocks, n_ranges = B.sizes(docs, text)
    n_blocks = max(B.MIN_PARTS, n_blocks // 2)        # what a larger block repeats is sent once
    n_ranges = max(B.MIN_PARTS, n_ranges // 8)        # what a block sends to a larger range packs better
    n, v = totals(docs.select(F.col(f"`{text}`").alias("_text"), (~F.coalesce(held_out, F.lit(False))).alias("_train")), n_ranges)
    blocked = B.packed_blocks(marked, n_blocks, text)

    def trained(table):
        return ~pa.concat_arrays(table[B.ROW].chunks).field("_held").to_numpy(zero_copy_only=False).astype(bool)

    def emit(key, table):
        token, begin = tokens(table[B.TEXT])
        learn = np.repeat(trained(table), np.diff(begin))
        out = []
        for k in range(1, order + 1):
            keys, inverse = np.unique(ngram_keys(token, begin, k), return_inverse=True)
            count = np.bincount(inverse[learn], minlength=len(keys)).astype(np.int32)
            rows = B.sent_rows(B.key_of(key), keys, n_ranges, count, B.pack_steps if k == 1 else lambda x: pack_ngrams(x, word_bits(k)))
            out.append(rows.set_column(0, "range", pa.array(rows["range"].to_numpy() + (k - 1) * n_ranges, pa.int32())))
        return pa.concat_tables(out)

    def answer(table):
        k = 1 + table["range"][0].as_py() // n_ranges
        _, keys, at = B.received(table, B.unpack_steps if k == 1 else lambda x: unpack_ngrams(x, word_bits(k)))
        count = B.counts_of(table)
        distinct, inverse = np.unique(keys, return_inverse=True)
        total = np.bincount(inverse, count, len(distinct)).astype(np.int64)
        seen = total > 0
        if k == 1:
            mine = WordLevel(distinct[seen], total[seen]).query(keys)
            return B.reply_rows(table, [B.squeeze(B.pack(mine[a:b])) for a, b in zip(at, at[1:])])
        level = TrieLevel(distinct[seen], total[seen], word_bits(k))
        alpha, gamma = level.query(keys)
        return B.reply_rows(table, [pack_codes(keys[a:b], word_bits(k), alpha[a:b], gamma[a:b]) for a, b in zip(at, at[1:])])

    def apply(key, left, right):
        token, begin = tokens(left[B.TEXT])
        replies = dict(zip(right["range"].to_pylist(), right["reply"].to_pylist()))
        count = p = None
        for k in range(1, order + 1):
            keys, inverse = np.unique(ngram_keys(token, begin, k), return_inverse=True)
            edge = B.cuts(keys, n_ranges)
            got = [(edge[i], edge[i + 1], x) for i, x in ((r - (k - 1) * n_ranges, x) for r, x in replies.items()) if 0 <= i < n_ranges]
            if k == 1:
                c = np.zeros(len(keys), np.int64)
                for a, b, x in got:
                    c[a:b] = B.unpack(B.loosen(x)).astype(np.int64)
                count = c[inverse]
                p = (count + 1) / (n + 1 * (v + 1))
                base = np.log10(p)
            else:
                codes = np.zeros((2, len(keys)), np.uint16)
                for a, b, x in got:
                    codes[:, a:b] = unpack_codes(x, keys[a:b], word_bits(k))
                alpha, gamma = VALUE[codes][:, inverse]
                p = alpha + gamma * p
        sums = lambda x: pa.array(np.add.reduceat(x, begin[:-1]))
        return pa.table({B.ROW: B.nullable(left[B.ROW]), "n_tokens": pa.array(np.diff(begin), pa.int64()), "n_known": sums((count > 0).astype(np.int64)),
                         "base_score": sums(base), "score": sums(np.log10(p))})

    replies = B.per_range(B.per_block(blocked, emit), answer)
    row = blocked.schema[B.ROW].dataType.simpleString()
    out = B.with_answers(blocked, replies, apply, f"{B.ROW} {row}, n_tokens long, n_known long, base_score double, score double")
    out = out.withColumn("held_out", F.col(B.ROW)["_held"]).withColumn("train_tokens", F.lit(n).cast("long"))
    return B.unpacked(out, docs, text)


def held_out(doc_id: str = "doc_id"):
    return F.crc32(F.col(doc_id).cast("string").cast("binary")) % 7 == 2


def scores(found: DataFrame) -> DataFrame:
    return found.select("doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score")
