"""Whole-corpus counting over blocks of documents.

Several operators need, for every window (shingle, n-gram, anchor) of every
document, what the whole corpus knows about it.  One row per window would cost
several times the input in shuffle, so documents are dealt by hash into blocks
of a few MB and three steps run as Spark group operations:

1. ``emit``   block   -> its distinct window keys, packed, one row per key range;
2. ``answer`` range   -> what the ranges of all blocks say together, one row per block;
3. ``apply``  block + answers -> the documents' rows.

Steps 1 and 3 read the same exchange of the texts.  A key that occurs in a third
of all rows is sent once per block (pre-aggregated), so no range grows hot.
Nothing depends on row order inside a block, so a lost task may be re-run.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

BLOCK_BYTES = 4 << 20    # text per block: bounds a task's memory
RANGE_BYTES = 2 << 20    # text per key range
MIN_PARTS = 64
TEXT_LEVEL = 6           # of the texts' compression; above it the room hardly shrinks

ROW, TEXT, BLOCK = "_row", "_text", "_block"
SENT = "range int, block long, keys binary, extra binary"
REPLY = "block long, range int, reply binary"

_U = np.uint64
BYTE_BASE, WORD_BASE = _U(0x9E3779B97F4A7C15 | 5), _U(0xD1342543DE82EF95)


# ---------------------------------------------------------------- memory

def give_back(result=None):
    """``result``, after what Arrow and the allocator keep of freed memory has gone back to the system.
    A worker stays for a minute after its task and would hold it while the next stage's heap grows."""
    pa.default_memory_pool().release_unused()
    pa.system_memory_pool().release_unused()
    return result


def tidy(run: Callable) -> Callable:
    """``run`` over the batches of a task, freed memory given back at its end."""
    def tidied(batches):
        yield from run(batches)
        give_back()
    return tidied


# ---------------------------------------------------------------- documents

def sizes(docs: DataFrame, text: str = "text") -> tuple[int, int]:
    """(blocks, key ranges) for the documents, from one sum over the text lengths."""
    n = docs.agg(F.sum(F.octet_length(F.col(text)).cast("long"))).first()[0] or 0
    return max(MIN_PARTS, n // BLOCK_BYTES), max(MIN_PARTS, n // RANGE_BYTES)


def blocks(docs: DataFrame, n: int, text: str = "text") -> DataFrame:
    """``_row`` (all columns but the text), ``_text`` and ``_block`` (hash of the whole row)."""
    rest = [F.col(f"`{c}`") for c in docs.columns if c != text]
    row = F.struct(*rest) if rest else F.struct(F.lit(0).alias("_none"))
    hashed = [F.col(f"`{c}`") for c, kind in docs.dtypes if "map<" not in kind]    # maps have no hash
    return docs.select(row.alias(ROW), F.col(f"`{text}`").alias(TEXT), F.pmod(F.xxhash64(*hashed), F.lit(n)).alias(BLOCK))


def squeeze(data: bytes, level: int = 1) -> bytes:
    """Bytes compressed, their number before them."""
    return len(data).to_bytes(8, "little") + pa.Codec("zstd", compression_level=level).compress(data, asbytes=True)


def loosen(data: bytes) -> bytes:
    return pa.decompress(data[8:], int.from_bytes(data[:8], "little"), codec="zstd", asbytes=True)


def packed_blocks(docs: DataFrame, n: int, text: str = "text") -> DataFrame:
    """``blocks`` with each text compressed, so that its exchange takes two thirds of the room;
    ``per_block`` and ``with_answers`` hand the texts on as they were."""
    blocked = blocks(docs, n, text)

    def run(batches):
        for b in batches:
            texts = [None if t is None else squeeze(t.encode(), TEXT_LEVEL) for t in b.column(TEXT).to_pylist()]
            yield pa.RecordBatch.from_arrays([nullable(b.column(ROW)), pa.array(texts, pa.binary()), b.column(BLOCK)], [ROW, TEXT, BLOCK])

    return blocked.mapInArrow(tidy(run), f"{ROW} {blocked.schema[ROW].dataType.simpleString()}, {TEXT} binary, {BLOCK} long")


def _plain(table: pa.Table) -> pa.Table:
    if not pa.types.is_binary(table.schema.field(TEXT).type) and not pa.types.is_large_binary(table.schema.field(TEXT).type):
        return table
    texts = [None if x is None else loosen(x).decode() for x in table[TEXT].to_pylist()]
    return table.set_column(table.column_names.index(TEXT), TEXT, pa.chunked_array([pa.array(texts, pa.string())]))


def nullable(column):
    """An Arrow column with all fields nullable, as result schemas have them."""
    def of(t):
        if pa.types.is_struct(t):
            return pa.struct([pa.field(f.name, of(f.type)) for f in t])
        if pa.types.is_list(t):
            return pa.list_(pa.field(t.value_field.name, of(t.value_type)))
        if pa.types.is_map(t):
            return pa.map_(t.key_type, of(t.item_type))
        return t
    return column.cast(of(column.type))


def unpacked(out: DataFrame, docs: DataFrame, text: str = "text") -> DataFrame:
    """``_row`` back as columns; a new column replaces an input column of its name."""
    new = {c.lower() for c in out.columns if c != ROW}
    kept = [F.col(ROW)[c].alias(c) for c in docs.columns if c != text and c.lower() not in new]
    return out.select(*kept, *[c for c in out.columns if c != ROW])


def per_block(blocked: DataFrame, emit: Callable, schema: str = SENT) -> DataFrame:
    return blocked.groupBy(BLOCK).applyInArrow(lambda key, table: give_back(emit(key, _plain(table))), schema)


def per_range(sent: DataFrame, answer: Callable, schema: str = REPLY) -> DataFrame:
    return sent.groupBy("range").applyInArrow(lambda table: give_back(answer(table)), schema)


def with_answers(blocked: DataFrame, replies: DataFrame, apply: Callable, schema) -> DataFrame:
    return blocked.groupBy(BLOCK).cogroup(replies.groupBy("block")).applyInArrow(
        lambda key, left, right: give_back(apply(key, _plain(left), right)), schema)


# ---------------------------------------------------------------- packed keys

def pack(keys: np.ndarray) -> bytes:
    """Sorted 64-bit keys by byte plane: the high planes are runs, which compress."""
    return np.ascontiguousarray(keys.astype("<u8").view(np.uint8).reshape(-1, 8).T).tobytes()


def unpack(data: bytes) -> np.ndarray:
    return np.ascontiguousarray(np.frombuffer(data, np.uint8).reshape(8, -1).T).view("<u8").ravel()


def pack_steps(keys: np.ndarray) -> bytes:
    """Sorted 64-bit keys as differences by byte plane, in as few planes as the largest one needs, the
    highest plane compressed."""
    x = keys.astype("<u8")
    step = np.diff(x, prepend=x[:1])
    wide = max(1, (int(step.max(initial=0)).bit_length() + 7) // 8)
    planes = np.ascontiguousarray(step.view(np.uint8).reshape(-1, 8)[:, :wide].T)
    low = planes[:-1].tobytes()
    return bytes([wide]) + len(keys).to_bytes(8, "little") + (x[:1].tobytes() if len(x) else bytes(8)) + low + squeeze(planes[-1].tobytes())


def unpack_steps(data: bytes) -> np.ndarray:
    wide, n, first = data[0], int.from_bytes(data[1:9], "little"), np.frombuffer(data, "<u8", 1, 9)
    step = np.zeros((n, 8), np.uint8)
    low = (wide - 1) * n
    step[:, :wide - 1] = np.frombuffer(data, np.uint8, low, 17).reshape(wide - 1, n).T
    step[:, wide - 1] = np.frombuffer(loosen(data[17 + low:]), np.uint8)
    return (np.cumsum(step.view("<u8").ravel(), dtype=_U) + first).astype(_U)


def pack_values(x: np.ndarray) -> bytes:
    """Whole numbers by byte plane, in as few planes as the largest one needs, compressed."""
    x = x.astype("<u8")
    wide = max(1, (int(x.max(initial=0)).bit_length() + 7) // 8)
    return bytes([wide]) + squeeze(np.ascontiguousarray(x.view(np.uint8).reshape(-1, 8)[:, :wide].T).tobytes())


def unpack_values(data: bytes) -> np.ndarray:
    planes = np.frombuffer(loosen(data[1:]), np.uint8).reshape(data[0], -1)
    out = np.zeros((planes.shape[1], 8), np.uint8)
    out[:, :data[0]] = planes.T
    return out.view("<u8").ravel()


def joined(*parts: bytes) -> bytes:
    """Byte strings in one, each with its length before it."""
    return b"".join(x for p in parts for x in (len(p).to_bytes(8, "little"), p))


def parted(data: bytes) -> list[bytes]:
    out, at = [], 0
    while at < len(data):
        n = int.from_bytes(data[at:at + 8], "little")
        out.append(data[at + 8:at + 8 + n])
        at += 8 + n
    return out


def pack_listed(x: np.ndarray) -> bytes:
    """Numbers of which many are equal: the distinct ones, and the place of each among them; as plain
    values where that is shorter."""
    distinct, place = np.unique(x, return_inverse=True)
    return min(joined(pack_values(x)), joined(pack_steps(distinct), pack_values(place)), key=len)


def unpack_listed(data: bytes) -> np.ndarray:
    parts = parted(data)
    return unpack_values(parts[0]) if len(parts) == 1 else unpack_steps(parts[0])[unpack_values(parts[1]).astype(np.int64)]


def counts_of(table: pa.Table, kind=np.int32) -> np.ndarray:
    """The compressed counts of all rows sent."""
    return np.frombuffer(b"".join(map(loosen, table["extra"].to_pylist())), kind)


SHORT = _U(24)      # low bits that short keys do without


def short(keys: np.ndarray) -> np.ndarray:
    """Keys without their low bits, for uses where two keys may be taken for one."""
    return keys >> SHORT << SHORT


def pack_short(keys: np.ndarray) -> bytes:
    """Sorted short keys as differences by byte plane, in as few planes as the largest one needs."""
    x = (keys >> SHORT).astype("<u8")
    step = np.diff(x, prepend=x[:1])
    wide = max(1, (int(step.max(initial=0)).bit_length() + 7) // 8)
    planes = np.ascontiguousarray(step.view(np.uint8).reshape(-1, 8)[:, :wide].T).tobytes()
    return bytes([wide]) + (x[:1].tobytes() if len(x) else bytes(8)) + planes


def unpack_short(data: bytes) -> np.ndarray:
    wide, first = data[0], np.frombuffer(data, "<u8", 1, 1)
    planes = np.frombuffer(data, np.uint8, offset=9).reshape(wide, -1)
    step = np.zeros((planes.shape[1], 8), np.uint8)
    step[:, :wide] = planes.T
    return (np.cumsum(step.view("<u8").ravel(), dtype=_U) + first).astype(_U) << SHORT


def cuts(keys: np.ndarray, n: int) -> np.ndarray:
    """Where each of n equal key ranges begins in the sorted keys (n + 1 places)."""
    edges = (np.arange(1, n, dtype=object) * (1 << 64)) // n
    return np.concatenate(([0], np.searchsorted(keys, edges.astype(np.uint64)), [len(keys)]))


def sent_rows(block: int, keys: np.ndarray, n: int, extra: np.ndarray | None = None, pack: Callable = pack) -> pa.Table:
    """One row per key range that has keys; ``extra``: an array alongside the keys."""
    at = cuts(keys, n)
    full = np.flatnonzero(np.diff(at))
    return pa.table({
        "range": pa.array(full, pa.int32()), "block": pa.array(np.full(len(full), block), pa.int64()),
        "keys": pa.array([pack(keys[at[i]:at[i + 1]]) for i in full], pa.binary()),
        "extra": pa.array([squeeze(extra[at[i]:at[i + 1]].tobytes()) if extra is not None else b"" for i in full],
                          pa.binary())})


def received(table: pa.Table, unpack: Callable = unpack) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(blocks, keys of all rows, where each row's keys begin)."""
    keys = [unpack(x) for x in table["keys"].to_pylist()]
    return (table["block"].to_numpy(), np.concatenate(keys),
            np.concatenate(([0], np.cumsum([len(k) for k in keys]))))


def reply_rows(table: pa.Table, replies: list[bytes | None]) -> pa.Table:
    """Replies in the rows' order; None: no row."""
    ok = pa.array([i for i, r in enumerate(replies) if r is not None], pa.int64())
    return pa.table({"block": table["block"].take(ok).cast(pa.int64()), "range": table["range"].take(ok).cast(pa.int32()),
                     "reply": pa.array([r for r in replies if r is not None], pa.binary())})


def repeated_across(table: pa.Table) -> pa.Table:
    """Answer: for each block, a bit for each of its keys that other blocks have too."""
    blocks_, keys, at = received(table)
    order = np.argsort(keys, kind="stable")
    s = keys[order]
    same = s[1:] == s[:-1]
    twice = np.zeros(len(s), bool)
    twice[1:] |= same
    twice[:-1] |= same
    hit = np.empty(len(s), bool)
    hit[order] = twice
    parts = [hit[a:b] for a, b in zip(at, at[1:])]
    return reply_rows(table, [np.packbits(p).tobytes() if p.any() else None for p in parts])


def repeated_bits(keys: np.ndarray, answers: pa.Table, n: int) -> np.ndarray:
    """The bits of ``repeated_across`` put back alongside a block's distinct sorted keys."""
    at, out = cuts(keys, n), np.zeros(len(keys), bool)
    for r, bits in zip(answers["range"].to_pylist(), answers["reply"].to_pylist()):
        a, b = at[r], at[r + 1]
        out[a:b] = np.unpackbits(np.frombuffer(bits, np.uint8), count=b - a).astype(bool)
    return out


# ---------------------------------------------------------------- hashing

def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser, so that key ranges are even."""
    x = x ^ (x >> _U(30))
    x = x * _U(0xBF58476D1CE4E5B9)
    x ^= x >> _U(27)
    x *= _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


_POWERS: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def powers(base: np.uint64, n: int) -> tuple[np.ndarray, np.ndarray]:
    """base**i and its inverse modulo 2**64, for i < n."""
    have = _POWERS.get(int(base))
    if have is None or len(have[0]) < n:
        size = n if n > 1 << 22 else max(CHUNK, 1 << (n - 1).bit_length())
        up, down = np.full(size, base, _U), np.full(size, _U(pow(int(base), -1, 1 << 64)), _U)
        up[0] = down[0] = _U(1)
        have = np.cumprod(up, dtype=_U), np.cumprod(down, dtype=_U)
        if size <= 1 << 22:    # longer ones are rare and not kept
            _POWERS[int(base)] = have
    return have[0][:n], have[1][:n]


class Rolling:
    """Rabin-Karp sums of a sequence modulo 2**64: the hash of any span in constant time."""

    def __init__(self, values: np.ndarray, base: np.uint64):
        up, self.down = powers(base, max(1, len(values)))
        self.sums = np.zeros(len(values) + 1, _U)
        np.cumsum(values * up[:len(values)], dtype=_U, out=self.sums[1:])

    def spans(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return (self.sums[end] - self.sums[start]) * self.down[np.minimum(start, len(self.down) - 1)]

    def windows(self, width: int) -> np.ndarray:
        """Hash of every ``width`` consecutive values."""
        n = len(self.sums) - width
        return (self.sums[width:] - self.sums[:n]) * self.down[:n] if n > 0 else np.zeros(0, _U)


_IS_WORD = np.ones(256, bool)
_IS_WORD[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = False
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


def text_bytes(column) -> tuple[np.ndarray, np.ndarray]:
    """(UTF-8 bytes of all texts, where each begins); null counts as empty."""
    a = pa.concat_arrays(column.chunks) if column.num_chunks else pa.array([], pa.string())
    a = pc.fill_null(a.cast(pa.large_binary()), b"")
    off = np.frombuffer(a.buffers()[1], np.int64)[a.offset:a.offset + len(a) + 1] if len(a) else np.zeros(1, np.int64)
    data = np.frombuffer(a.buffers()[2], np.uint8)[off[0]:off[-1]] if len(a) and a.buffers()[2] else np.zeros(0, np.uint8)
    return data, off - off[0]


def groups_of(at: np.ndarray, size: int) -> list[tuple[int, int]]:
    """Runs of documents of about ``size`` bytes each (a longer document stands alone)."""
    out, i = [], 0
    while i < len(at) - 1:
        j = max(i + 1, int(np.searchsorted(at, at[i] + size, side="right")) - 1)
        out.append((i, j))
        i = j
    return out


def word_spans(data: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(starts, ends, first word of each document and the end) of words ``[^\\x20\\x09-\\x0D]+``."""
    if not len(data):
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(len(at), np.int64)
    word = _IS_WORD[data]
    edge = np.zeros(len(data) + 1, bool)
    edge[at] = True
    start, end = word.copy(), word.copy()
    start[1:] &= ~word[:-1] | edge[1:-1]
    end[:-1] &= ~word[1:] | edge[1:-1]
    starts = np.flatnonzero(start)
    return starts, np.flatnonzero(end) + 1, np.searchsorted(starts, at)


CHUNK = 1 << 18    # of the bytes hashed at once: a worker's tables of powers are as long


def word_hashes(data: np.ndarray, at: np.ndarray, lower: bool = False) -> tuple[np.ndarray, np.ndarray]:
    """(64-bit hash of each word, first word of each document and the end)."""
    hashes, first, n = [], [np.zeros(1, np.int64)], 0
    for i, j in groups_of(at, CHUNK):
        part, base = data[at[i]:at[j]], at[i:j + 1] - at[i]
        if lower:
            part = _LOWER[part]
        s, e, f = word_spans(part, base)
        roll = Rolling(part.astype(_U) + _U(1), BYTE_BASE)
        hashes.append(mix(roll.spans(s, e) + (e - s).astype(_U)))
        first.append(f[1:] + n)
        n += len(s)
    return np.concatenate(hashes) if hashes else np.zeros(0, _U), np.concatenate(first)


def window_hashes(words: np.ndarray, first: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """(hash of each window of ``width`` words inside one document, its first word)."""
    out, where = [], []
    for i, j in groups_of(first, CHUNK // 8):
        a, b = first[i], first[j]
        h = Rolling(words[a:b], WORD_BASE).windows(width)
        if len(h):
            ok = np.ones(len(h), bool)
            for k in range(1, width):                       # starts too near to a document's end
                ends = first[i + 1:j + 1] - a - k
                ok[ends[(ends >= 0) & (ends < len(h))]] = False
            at = np.flatnonzero(ok)
            out.append(mix(h[at]))
            where.append(at + a)
    return (np.concatenate(out) if out else np.zeros(0, _U),
            np.concatenate(where) if where else np.zeros(0, np.int64))


def key_of(key) -> int:
    return key[0].as_py()
