"""Operator 9: BPE encoding and decoding with a pair occurrence index.

Texts are cut at white space; a partition's distinct pieces are encoded together.
All pieces stand in one array of token ids with links to the next and previous
token.  The index maps each pair that has a merge rank to all its positions.
Active ranks are applied in ascending order (a heap): every position of the pair
is merged from left to right, and the positions of the pairs that appear to its
left and right are added to their lists.  Merge files number products after their
parts, so a rank can never activate a smaller one; ``Vocabulary`` checks that.

The tokenizer file is a parameter; its normaliser, splitting rule and special
strings are read from it and applied by the tokenizers library, which does no
merging here.  Encoded pieces are remembered per worker up to a fixed number.

Defined cases: null and empty texts have no tokens; strings of special tokens in
a text are those tokens, as the library has it; decoding joins the tokens'
strings with one space, as the library does for files without a decoder.
"""

from __future__ import annotations

import heapq
import json
import re
from collections.abc import Callable
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from regiflow.llm.blocks import nullable, tidy

REMEMBERED = 500_000       # encoded pieces, and merged words, of a generation kept in a worker
NONE, GONE = 65_535, 65_536    # no token; taken up by a merge
_OTHER_SPACE = "\x1c\x1d\x1e\x1f"     # split() cuts at these, the splitting rule does not


def byte_letters() -> list[str]:
    """The letter that stands for each byte in byte-level vocabularies: printable ones are
    themselves, the others follow from code point 256 on."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    shifted = [b for b in range(256) if b not in set(plain)]
    letters = {b: chr(b) for b in plain} | {b: chr(256 + i) for i, b in enumerate(shifted)}
    return [letters[b] for b in range(256)]


class Vocabulary:
    """A BPE file: ids, merge ranks, special strings, and the library's text rules."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model = spec["model"]
        self.ids: dict[str, int] = model["vocab"]
        self.end = model.get("end_of_word_suffix") or ""
        rules = Tokenizer.from_file(path)
        self.normalise = rules.normalizer.normalize_str if rules.normalizer else str
        self.split = rules.pre_tokenizer.pre_tokenize_str
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.strings = {i: s for s, i in self.ids.items()} | {i: s for s, i in self.special.items()}
        self.rank: dict[int, int] = {}          # pair (left id * 2**16 + right id) -> rank
        self.made: list[int] = []               # rank -> product
        by: dict[int, int] = {}
        for r, pair in enumerate(model["merges"]):
            a, b = pair if isinstance(pair, list) else pair.split(" ")
            a, b, c = self.ids[a], self.ids[b], self.ids[a + b]
            if max(by.get(a, -1), by.get(b, -1)) >= r or c in by:
                raise ValueError("merge ranks must follow the ranks that make their parts")
            self.rank[a << 16 | b], by[c] = r, r
            self.made.append(c)
        if max(self.strings) >= NONE:
            raise ValueError("ids must stay below 65535")
        self.pairs = np.array(sorted(self.rank), np.int64)
        self.pair_ranks = np.array([self.rank[k] for k in self.pairs.tolist()], np.int64)
        self.cut = re.compile("(" + "|".join(map(re.escape, sorted(self.special, key=len, reverse=True))) + ")") if self.special else None

    def words(self, pieces: list[str]) -> list[list]:
        """For each piece its units in order: special ids, or words of the splitting rule."""
        out: list[list] = [[] for _ in pieces]
        odd = [i for i, p in enumerate(pieces) if any(s in p for s in self.special) or len(p.split()) != 1 or any(c in p for c in _OTHER_SPACE)]
        rest = set(odd)
        plain = [i for i in range(len(pieces)) if i not in rest]
        text = self.normalise(" ".join([pieces[i] for i in plain]))
        parts = text.split(" ")
        if len(parts) != len(plain):             # a rule that makes or drops spaces
            odd, plain, text, parts = range(len(pieces)), [], "", []
        ends = np.cumsum([len(p) + 1 for p in parts])
        found = self.split(text) if text else []
        for at, (word, _) in zip(np.searchsorted(ends, [o[0] for _, o in found], side="right").tolist(), found):
            out[plain[at]].append(word)
        for i in odd:
            for part in self.cut.split(pieces[i]) if self.cut else [pieces[i]]:
                if part in self.special:
                    out[i].append(self.special[part])
                elif part:
                    out[i] += [word for word, _ in self.split(self.normalise(part))]
        return out

    def symbols(self, word: str) -> list[int]:
        return [self.ids[c] for c in word[:-1]] + [self.ids[word[-1] + self.end]]


class PairIndex:
    """Merges all words of a batch at once."""

    def __init__(self, vocabulary: Vocabulary, words: list[list[int]]):
        self.v, flat = vocabulary, []
        for w in words:
            flat += w
            flat.append(NONE)                   # no pair crosses a word's end
        self.token = flat
        self.next, self.prev = list(range(1, len(flat) + 1)), list(range(-1, len(flat) - 1))
        token = np.array(flat, np.int64)
        pair = token[:-1] << 16 | token[1:]
        at = np.minimum(np.searchsorted(vocabulary.pairs, pair), len(vocabulary.pairs) - 1)
        place = np.flatnonzero(vocabulary.pairs[at] == pair)
        rank = vocabulary.pair_ranks[at[place]]
        order = np.argsort(rank, kind="stable")
        active, begin = np.unique(rank[order], return_index=True)
        every, cuts = place[order].tolist(), [*begin.tolist(), len(place)]
        self.active: list[int] = active.tolist()          # ascending, so a heap
        self.where = {r: every[a:b] for r, a, b in zip(self.active, cuts, cuts[1:])}     # rank -> positions of its pair

    def run(self) -> list[int]:
        """Token ids of all words, with NONE after each."""
        token, nxt, prev, where, active = self.token, self.next, self.prev, self.where, self.active
        rank_of, products, end = self.v.rank.get, self.v.made, len(self.token)
        pair_of = {r: k for k, r in zip(self.v.pairs.tolist(), self.v.pair_ranks.tolist())} if active else {}
        while active:
            rank = heapq.heappop(active)
            left, right, made = pair_of[rank] >> 16, pair_of[rank] & 0xFFFF, products[rank]
            for i in sorted(where.pop(rank)):
                j = nxt[i]
                if token[i] != left or j >= end or token[j] != right:
                    continue                # an earlier merge has taken one of them
                token[i], token[j] = made, GONE
                k = nxt[i] = nxt[j]
                if k < end:
                    prev[k] = i
                h = prev[i]
                for at, new in ((i, made << 16 | token[k] if k < end else -1), (h, token[h] << 16 | made if h >= 0 else -1)):
                    r = rank_of(new)
                    if r is not None:
                        if r in where:
                            where[r].append(at)
                        else:
                            where[r] = [at]
                            heapq.heappush(active, r)
        return [t for t in token if t != GONE]


class Memory(dict):
    """What was made lately: two generations of at most ``size`` entries each; what is used
    again moves to the younger one, and the older one is forgotten when that is full."""

    def __init__(self, size: int):
        super().__init__()
        self.size, self.old = size, {}

    def missing(self, keys) -> list:
        """The keys not known; the known ones become young."""
        out = []
        for k in keys:
            if k not in self:
                if k in self.old:
                    self[k] = self.old.pop(k)
                else:
                    out.append(k)
        return out

    def values_of(self, keys: list, make: Callable[[list], list]) -> list:
        """The value of each distinct key; ``make`` gives those of the keys not known."""
        out = list(map(self.get, keys))
        lacking = [i for i, x in enumerate(out) if x is None]
        for i in lacking:
            if keys[i] in self.old:
                out[i] = self[keys[i]] = self.old.pop(keys[i])
        lacking = [i for i in lacking if out[i] is None]
        for i, x in zip(lacking, make([keys[i] for i in lacking])):
            out[i] = self[keys[i]] = x
        return out

    def age(self) -> None:
        if len(self) > self.size:
            self.old = dict(self)
            self.clear()


def _cut(texts: list[str | None]) -> tuple[pa.Array, np.ndarray]:
    """(the white-space pieces of all texts, where each text's begin).  Arrow cuts at what ``str.split``
    cuts at; a text with characters of ``_OTHER_SPACE`` is one piece."""
    if any(c in t for t in texts if t for c in _OTHER_SPACE):
        cut = [[] if not t else t.split() if not any(c in t for c in _OTHER_SPACE) else [t] for t in texts]
        return pa.array(list(chain.from_iterable(cut)), pa.large_string()), np.concatenate(([0], np.cumsum([len(x) for x in cut], dtype=np.int64)))
    cut = pc.utf8_split_whitespace(pa.array([t or "" for t in texts], pa.large_string()))
    words, at = cut.flatten(), np.append(0, np.cumsum(pc.list_value_length(cut).to_numpy(), dtype=np.int64))
    full = pc.greater(pc.binary_length(words), 0)            # white space at a text's ends leaves an empty piece
    kept = np.append(0, np.cumsum(full.to_numpy(zero_copy_only=False), dtype=np.int64))
    return words.filter(full), kept[at]


class Encoder:
    """Texts to ids through the distinct white-space pieces of a batch."""

    def __init__(self, path: str):
        self.v, self.known, self.merged = Vocabulary(path), Memory(REMEMBERED), Memory(REMEMBERED)

    def encode_pieces(self, pieces: list[str]) -> list[bytes]:
        """The ids of each piece as little-endian 32-bit integers."""
        units = self.v.words(pieces)
        self.merged.age()
        new = self.merged.missing({w for u in units for w in u if isinstance(w, str)})
        flat = np.array(PairIndex(self.v, [self.v.symbols(w) for w in new]).run(), "<u4")
        ends, data = np.flatnonzero(flat == NONE).tolist(), flat.tobytes()
        for word, a, b in zip(new, [0, *[e + 1 for e in ends]], ends):
            self.merged[word] = data[4 * a:4 * b]
        return [b"".join([w.to_bytes(4, "little") if isinstance(w, int) else self.merged[w] for w in u]) for u in units]

    def encode(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all texts, where each text's begin)."""
        self.known.age()
        words, per_text = _cut(texts)
        coded = words.dictionary_encode()
        index, seq = coded.dictionary.to_numpy(zero_copy_only=False).tolist(), coded.indices.to_numpy().astype(np.int64)
        table = self.known.values_of(index, self.encode_pieces)
        size = np.fromiter(map(len, table), np.int64, len(table)) // 4
        flat = np.frombuffer(b"".join(table), "<u4")
        begin = np.cumsum(size) - size
        n = size[seq] if len(seq) else seq
        ends = np.cumsum(n)
        total = int(ends[-1]) if len(ends) else 0
        ids = flat[np.arange(total) - np.repeat(ends - n - begin[seq], n)] if total else np.zeros(0, np.uint32)
        return ids, np.concatenate(([0], ends))[per_text]

    def decode(self, ids: np.ndarray) -> str:
        strings = self.v.strings
        return " ".join([strings[i] for i in ids.tolist() if i in strings])


_ENCODERS: dict[str, Encoder] = {}


def encoder(path: str) -> Encoder:
    """The worker's encoder for a file (read once)."""
    if path not in _ENCODERS:
        _ENCODERS[path] = Encoder(path)
    return _ENCODERS[path]


def parts_of(batch: pa.RecordBatch, column: str, size: int = 3 << 20):
    """Slices of a batch of about ``size`` bytes of text."""
    lengths = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False).astype(np.int64)
    at, i = np.concatenate(([0], np.cumsum(lengths))), 0
    while i < len(lengths):
        j = max(i + 1, int(np.searchsorted(at, at[i] + size, side="right")) - 1)
        yield batch.slice(i, j - i)
        i = j


def encode(docs: DataFrame, path: str, text: str = "text", decoded: bool = False) -> DataFrame:
    """Every document with ``ids`` (array<int>) and, if asked for, ``decoded`` (string).

    One pass without a shuffle; a batch is worked off in slices of bounded size.
    Result columns replace input columns of their names.
    """
    new = ["ids"] + ["decoded"] * decoded
    keep = [c for c in docs.columns if c.lower() not in new]
    source = docs.select(F.struct(*[F.col(f"`{c}`") for c in keep]).alias("_row"), F.col(f"`{text}`").alias("_text"))

    def run(batches):
        e = encoder(path)
        for batch in batches:
            for part in parts_of(batch, "_text"):
                ids, at = e.encode(part.column("_text").to_pylist())
                cols = [nullable(part.column("_row")), pa.ListArray.from_arrays(pa.array(at, pa.int32()), pa.array(ids.view(np.int32)))]
                if decoded:
                    cols.append(pa.array([e.decode(ids[a:b]) for a, b in zip(at, at[1:])], pa.string()))
                yield pa.RecordBatch.from_arrays(cols, ["_row", *new])

    row = source.schema["_row"].dataType.simpleString()
    out = source.mapInArrow(tidy(run), f"_row {row}, ids array<int>" + ", decoded string" * decoded)
    return out.select(*[F.col("_row")[c].alias(c) for c in keep], *new)


def decode(coded: DataFrame, path: str, ids: str = "ids") -> DataFrame:
    """``coded`` with ``decoded``: the strings of its ids joined by one space."""
    keep = [c for c in coded.columns if c.lower() != "decoded"]
    source = coded.select(F.struct(*[F.col(f"`{c}`") for c in keep]).alias("_row"), F.col(f"`{ids}`").alias("_ids"))

    def run(batches):
        e = encoder(path)
        for batch in batches:
            text = [e.decode(np.array(x or [], np.int64)) for x in batch.column("_ids").to_pylist()]
            yield pa.RecordBatch.from_arrays([nullable(batch.column("_row")), pa.array(text, pa.string())], ["_row", "decoded"])

    out = source.mapInArrow(tidy(run), f"_row {source.schema['_row'].dataType.simpleString()}, decoded string")
    return out.select(*[F.col("_row")[c].alias(c) for c in keep], "decoded")


def digests(docs: DataFrame, path: str) -> DataFrame:
    """(doc_id, n_tokens, ids_sha256, decoded_sha256): the digests are taken beside the encoder,
    so that ids and decoded text need not leave the task."""
    import hashlib

    def run(batches):
        e = encoder(path)
        for batch in batches:
            for part in parts_of(batch, "text"):
                ids, at = e.encode(part.column("text").to_pylist())
                spans = [ids[a:b] for a, b in zip(at, at[1:])]
                yield pa.RecordBatch.from_arrays([
                    part.column("doc_id").cast(pa.int64()), pa.array(np.diff(at), pa.int64()),
                    pa.array([hashlib.sha256(x.astype("<u4").tobytes()).hexdigest() for x in spans]),
                    pa.array([hashlib.sha256(e.decode(x).encode()).hexdigest() for x in spans])],
                    ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])

    return docs.select("doc_id", "text").mapInArrow(tidy(run), "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")
