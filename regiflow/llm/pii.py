"""Operator 7: personal data, and the terms that give it away.

Base spans are email addresses, IP addresses, card and telephone numbers found by
fixed patterns.  Their values are the protected entities.  A term that shares a
document with an entity may reveal it; how strongly is measured over the whole
corpus:

    disclosure(t, e) = log2(P(e | t) / P(e)) / log2(1 / P(e))

with P from document counts: 1 if the term occurs only with the entity, 0 if it
says nothing.  A term of at least ``SUPPORT`` common documents is *removed* from
``REMOVE`` on and *generalised* from ``GENERALISE`` on, wherever it occurs in any
document: also far from the entity and where the entity is not named.

Blocks of documents (``blocks``) send their terms and entities with document counts
to key ranges and learn the totals.  With these each block counts its (term, entity)
pairs, except those whose totals alone keep them below ``GENERALISE``; the ranges add
the pairs up and tell every block which of its terms disclose.

Defined cases: null and empty texts have no spans; matches that fail their check
(range of parts, number of digits, Luhn) are dropped without a retry; copies
count as documents; extra columns are kept, result columns replace their names.
"""

from __future__ import annotations

import re
from bisect import bisect_left, bisect_right

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from regiflow.llm import blocks as B

KINDS = ("email", "ip", "card", "phone", "term")
SUPPORT = 2
GENERALISE, REMOVE = 0.8, 0.95

# The patterns of the base kinds.
LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
IP = re.compile(r"(?<![0-9])[0-9]+(?:\.[0-9]+){3}")        # a match never begins inside a run of digits
CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
WORD = re.compile(r"[^\x20\x09-\x0D]+")
DIGIT = re.compile(r"[0-9]")


def _emails(t: str):
    """Leftmost matches of local part, @ and dotted domain, in linear time: each starts where the
    run of local characters before an @ begins."""
    end, at = 0, t.find("@")
    while at >= 0:
        start = at
        while start > end and t[start - 1] in LOCAL:
            start -= 1
        m = DOMAIN.match(t, at + 1) if start < at else None
        if m:
            yield start, m.end()
            end = m.end()
        at = t.find("@", max(at + 1, end))


def _luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c) * (1 + i % 2)
        total += d - 9 * (d > 9)
    return total % 10 == 0


def base_spans(t: str) -> list[tuple[int, int, int]]:
    """(start, kind number, end) in order of start, then kind."""
    out = [(s, 0, e) for s, e in _emails(t)] if "@" in t else []
    if DIGIT.search(t):
        for m in IP.finditer(t):
            if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or "0") <= 255 for p in m[0].split(".")):
                out.append((m.start(), 1, m.end()))
        for m in CARD.finditer(t):
            digits = m[0].replace(" ", "").replace("-", "")
            if 14 <= len(digits) <= 19 and _luhn(digits):
                out.append((m.start(), 2, m.end()))
        if "+" in t:
            for m in PHONE.finditer(t):
                if 10 <= sum(c in "0123456789" for c in m[0]) <= 15:
                    out.append((m.start(), 3, m.end()))
    return sorted(out)


def _key(text: str) -> np.uint64:
    data = np.frombuffer(text.encode(), np.uint8).astype(np.uint64) + np.uint64(1)
    return B.mix(B.Rolling(data, B.BYTE_BASE).spans(np.zeros(1, np.int64), np.array([len(data)])))[0]


def _words(t: str, spans) -> tuple[list[tuple[int, int]], np.ndarray]:
    """(words of a text, which of them are terms: those that touch no base span)."""
    words = [m.span() for m in WORD.finditer(t)]
    starts, ends = [w[0] for w in words], [w[1] for w in words]
    term = np.ones(len(words), bool)
    for s, _, e in spans:
        term[bisect_right(ends, s):bisect_left(starts, e)] = False
    return words, term


class _Block:
    """The texts of a block with their words' hashes, base spans and entities.

    ``keys``: the distinct words and entities, sorted; ``count``: their documents.
    """

    def __init__(self, column):
        self.hashes, self.first = B.word_hashes(*B.text_bytes(column), lower=True)
        self.texts = [t or "" for t in column.to_pylist()]
        self.spans = [base_spans(t) for t in self.texts]
        self.entities = [np.unique(np.array([_key(f"\n{k}:{t[s:e].lower()}") for s, k, e in spans], np.uint64))
                         for t, spans in zip(self.texts, self.spans)]
        n = np.arange(len(self.texts))
        key = np.concatenate((self.hashes, *self.entities))
        doc = np.concatenate((np.repeat(n, np.diff(self.first)), np.repeat(n, [len(e) for e in self.entities])))
        order = np.lexsort((doc, key))
        key, doc = key[order], doc[order]
        once = np.ones(len(key), bool)
        once[1:] = (key[1:] != key[:-1]) | (doc[1:] != doc[:-1])
        self.keys, self.count = np.unique(key[once], return_counts=True)

    def words_of(self, i: int) -> np.ndarray:
        return self.hashes[self.first[i]:self.first[i + 1]]

    def answered(self, answers: pa.Table, n_ranges: int, kind) -> np.ndarray:
        """The ranges' values alongside ``keys`` (0 where a range did not answer)."""
        at, out = B.cuts(self.keys, n_ranges), np.zeros(len(self.keys), kind)
        for r, x in zip(answers["range"].to_pylist(), answers["reply"].to_pylist()):
            out[at[r]:at[r + 1]] = np.frombuffer(x, kind)
        return out


_PAIR = np.dtype([("t", "<u8"), ("e", "<u8"), ("n_te", "<i8"), ("n_t", "<i8"), ("n_e", "<i8")])
_SPAN = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32()), ("action", pa.string())]))
ACTIONS = (None, "generalise", "remove")


def disclosure(n_te, n_t, n_e, n: int) -> np.ndarray:
    """How strongly a term reveals an entity, from document counts; 0 for an entity of all documents."""
    bits = np.log2(n / n_e)
    return np.where(n_e < n, np.log2(n_te / n_t * (n / n_e)) / np.where(bits > 0, bits, 1), 0)


def _totals(table: pa.Table) -> pa.Table:
    """Answer: for each block, the documents of each of its keys in all blocks."""
    _, keys, at = B.received(table, B.unpack_steps)
    distinct, inverse = np.unique(keys, return_inverse=True)
    count = B.counts_of(table)
    total = np.bincount(inverse, count, len(distinct)).astype(np.int64)[inverse]
    return B.reply_rows(table, [total[a:b].tobytes() for a, b in zip(at, at[1:])])


def _pairs(block: _Block, total: np.ndarray, n: int, support: int, generalise: float) -> np.ndarray:
    """The (term, entity) pairs of a block with their documents in it, in order of term, without
    those that the totals keep below ``support`` or ``generalise`` (n_te is at most n_t and n_e)."""
    parts = []
    of = lambda keys: total[np.searchsorted(block.keys, keys)]
    for i, entities in enumerate(block.entities):
        entities = entities[of(entities) >= support]
        if not len(entities):
            continue
        _, term = _words(block.texts[i], block.spans[i])
        terms = np.unique(block.words_of(i)[term])
        n_t = of(terms)
        terms, n_t = terms[n_t >= support], n_t[n_t >= support]
        for e, n_e in zip(entities, of(entities)):
            may = disclosure(np.minimum(n_t, n_e), n_t, n_e, n) >= generalise - 1e-9
            part = np.empty(int(may.sum()), _PAIR)
            part["t"], part["e"], part["n_te"], part["n_t"], part["n_e"] = terms[may], e, 1, n_t[may], n_e
            parts.append(part)
    return _summed(parts)


def _summed(parts: list[np.ndarray]) -> np.ndarray:
    """Equal pairs as one, with the sum of their documents, in order of term."""
    p = np.concatenate(parts) if parts else np.empty(0, _PAIR)
    p = p[np.lexsort((p["e"], p["t"]))]
    new = np.ones(len(p), bool)
    new[1:] = (p["t"][1:] != p["t"][:-1]) | (p["e"][1:] != p["e"][:-1])
    out = p[new]
    if len(p):
        out["n_te"] = np.add.reduceat(p["n_te"], np.flatnonzero(new))
    return out


def _actions(p: np.ndarray, n: int, support: int, generalise: float, remove: float) -> tuple[np.ndarray, np.ndarray]:
    """(terms that reveal an entity, sorted, number of their action): each by its strongest entity."""
    p = p[p["n_te"] >= support]
    d = disclosure(p["n_te"], p["n_t"], p["n_e"], n)
    p, d = p[d >= generalise], d[d >= generalise]
    terms, inverse = np.unique(p["t"], return_inverse=True)
    action = np.ones(len(terms), np.uint8)
    action[inverse[d >= remove]] = 2
    return terms, action


def find(docs: DataFrame, text: str = "text", support: int = SUPPORT, generalise: float = GENERALISE,
         remove: float = REMOVE, with_text: bool = False, replaced: bool = False) -> DataFrame:
    """Every document's other columns with ``spans`` (array of kind, start, end, action; code
    points, end exclusive), in order of start, then kind; the text only if asked for, with the
    spans ``replaced`` if that is asked for too, in the same task, which then needs one worker."""
    n_blocks, n_ranges = B.sizes(docs, text)
    n = docs.count()
    blocked = B.packed_blocks(docs, n_blocks, text)

    def emit(key, table):
        block = _Block(table[B.TEXT])
        return B.sent_rows(B.key_of(key), block.keys, n_ranges, block.count.astype(np.int32), B.pack_steps)

    def pair(key, left, right):
        block = _Block(left[B.TEXT])
        p = _pairs(block, block.answered(right, n_ranges, np.int64), n, support, generalise)
        at = B.cuts(p["t"], n_ranges)
        full = np.flatnonzero(np.diff(at))
        return pa.table({"range": pa.array(full, pa.int32()), "pairs": pa.array([p[at[r]:at[r + 1]].tobytes() for r in full], pa.binary())})

    def tell(key, left, right):
        terms, action = _actions(_summed([np.frombuffer(x, _PAIR) for x in right["pairs"].to_pylist()]), n, support, generalise, remove)
        if not len(terms):
            return B.reply_rows(left, [None] * len(left))
        replies = []
        for keys in map(B.unpack_steps, left["keys"].to_pylist()):
            place = np.minimum(np.searchsorted(terms, keys), len(terms) - 1)
            mine = np.where(terms[place] == keys, action[place], 0).astype(np.uint8)
            replies.append(mine.tobytes() if mine.any() else None)
        return B.reply_rows(left, replies)

    def apply(key, left, right):
        block = _Block(left[B.TEXT])
        action = block.answered(right, n_ranges, np.uint8)
        spans = []
        for i, (t, base) in enumerate(zip(block.texts, block.spans)):
            found = [(s, k, e, KINDS[k]) for s, k, e in base]
            mine = action[np.searchsorted(block.keys, block.words_of(i))]
            if mine.any():
                words, term = _words(t, base)
                found += [(words[j][0], len(KINDS) - 1, words[j][1], ACTIONS[mine[j]]) for j in np.flatnonzero(term & (mine > 0))]
            spans.append([{"kind": KINDS[k], "start": s, "end": e, "action": a} for s, k, e, a in sorted(found)])
        cols = {B.ROW: B.nullable(left[B.ROW]), "spans": pa.array(spans, _SPAN)}
        if replaced:
            cols[B.TEXT] = pa.array([_clean(t, s) for t, s in zip(left[B.TEXT].to_pylist(), spans)], pa.string())
        elif with_text:
            cols[B.TEXT] = left[B.TEXT]
        return pa.table(cols)

    sent = B.per_block(blocked, emit)
    pairs = B.with_answers(blocked, B.per_range(sent, _totals), pair, "range int, pairs binary")
    told = sent.groupBy("range").cogroup(pairs.groupBy("range")).applyInArrow(lambda key, left, right: B.give_back(tell(key, left, right)), B.REPLY)
    out = B.with_answers(blocked, told, apply, f"{B.ROW} {blocked.schema[B.ROW].dataType.simpleString()}, "
                         "spans array<struct<kind:string,start:int,end:int,action:string>>" + f", {B.TEXT} string" * with_text)
    names = [c for c in docs.columns if c != text and c.lower() != "spans"]
    return out.select(*[F.col(B.ROW)[c].alias(c) for c in names], *([F.col(B.TEXT).alias(text)] * with_text), "spans")


def _clean(t: str | None, spans) -> str | None:
    out, at = [], 0
    for s in spans if t else []:
        if s["start"] >= at:
            out += [t[at:s["start"]], "" if s["action"] == "remove" else f"[{s['kind'].upper()}]"]
        at = max(at, s["end"])
    return "".join([*out, t[at:]]) if t and out else t


def sanitise(docs: DataFrame, text: str = "text", **options) -> DataFrame:
    """``docs`` with personal data replaced: base spans and generalised terms by their kind in
    brackets, removed terms by nothing; overlapping spans are replaced as one, by the first's kind."""
    found = find(docs.drop("spans"), text, with_text=True, replaced=True, **options)
    return found.select(*[F.col(f"`{c}`") for c in docs.columns if c == text or c.lower() != "spans"])


def digest(found: DataFrame) -> DataFrame:
    said = lambda spans: F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")
    base = F.filter("spans", lambda s: s["kind"] != "term")
    count = lambda k: F.size(F.filter("spans", lambda s: s["kind"] == k)).cast("long").alias(f"n_{k}")
    return found.select("doc_id", *[count(k) for k in KINDS[:4]], F.sha2(said(base).cast("binary"), 256).alias("base_sha256"),
                        said(F.col("spans")).alias("spans"))
