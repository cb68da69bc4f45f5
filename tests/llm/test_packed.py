"""What the blocks exchange: compressed texts, keys and counts."""

import numpy as np
import pyarrow as pa
import pytest

from regiflow.llm import blocks as B
from regiflow.llm import lm, packing, pii
from regiflow.llm.queries import tokenizer_path


@pytest.mark.parametrize("n", [1, 2, 300])
@pytest.mark.parametrize("bits", [0, 1, 9, 50, 64])
def test_keys_come_back_from_their_steps(n, bits):
    keys = np.unique(np.random.default_rng(n).integers(0, 1 << bits, n, np.uint64, endpoint=bits < 64) if bits < 64
                     else np.random.default_rng(n).integers(0, (1 << 64) - 1, n, np.uint64))
    assert B.unpack_steps(B.pack_steps(keys)).tolist() == keys.tolist()


def test_what_is_sent_takes_less_room():
    rng = np.random.default_rng(1)
    keys = np.unique(rng.integers(0, (1 << 64) - 1, 500_000, np.uint64))
    count = (rng.random(len(keys)) > 0.15).astype(np.int32)
    size = lambda t: len(pa.compress(b"".join(t["keys"].to_pylist() + t["extra"].to_pylist()), "lz4", asbytes=True))
    table = B.sent_rows(3, keys, 256, count, B.pack_steps)
    _, back, at = B.received(table, B.unpack_steps)
    assert (back == keys).all() and (B.counts_of(table) == count).all() and len(at) == 257
    assert size(table) < 6.5 * len(keys)                       # 7.4 bytes a key as they were sent before


def test_texts_of_packed_blocks_come_back(spark):
    texts = [None, "", "a", "é\U0001f600 \x00 b" * 50] + [f"text {i} " * 40 for i in range(40)]
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string")
    packed = B.packed_blocks(docs, 5)
    assert dict(packed.dtypes)[B.TEXT] == "binary"
    out = B.per_block(packed, lambda key, t: pa.table({"doc_id": pa.concat_arrays(t[B.ROW].chunks).field("doc_id").cast(pa.int64()),
                                                       "text": t[B.TEXT]}), "doc_id long, text string")
    assert {r.doc_id: r.text for r in out.collect()} == dict(enumerate(texts))
    assert packed.select(B.BLOCK).groupBy(B.BLOCK).count().collect().sort() == B.blocks(docs, 5).groupBy(B.BLOCK).count().collect().sort()


def test_words_of_many_batches_are_gathered(spark):
    docs = spark.createDataFrame([("a b a", True), ("b c", False), (None, True)] * 3, "_text string, _train boolean").coalesce(1)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "2")
    try:
        assert lm.totals(docs, 64) == (15, 3)        # three words and an end, three ends; a, b and the end
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")


@pytest.mark.parametrize("n", [1, 2, 5000])
@pytest.mark.parametrize("bits", [lm.WORD_BITS, lm.LONG_WORD_BITS])
def test_ngrams_and_codes_come_back(n, bits):
    rng = np.random.default_rng(n)
    edge = np.array([0, (1 << 64) - 1], np.uint64)[:n]
    context, word = rng.integers(0, 1 << (64 - bits), n // 2 + 1, np.uint64), rng.integers(0, 1 << bits, n // 3 + 1, np.uint64)
    keys = np.unique(np.append(edge, rng.choice(context, n) << np.uint64(bits) | rng.choice(word, n)))
    assert lm.unpack_ngrams(lm.pack_ngrams(keys, bits), bits).tolist() == keys.tolist()
    alpha, by_context = rng.integers(0, 65536, len(keys)).astype(np.uint16), rng.integers(0, 65536, len(keys)).astype(np.uint16)
    gamma = by_context[np.unique(keys >> np.uint64(bits), return_inverse=True)[1]]
    back = lm.unpack_codes(lm.pack_codes(keys, bits, alpha, gamma), keys, bits)
    assert back[0].tolist() == alpha.tolist() and back[1].tolist() == gamma.tolist()


def test_ngrams_take_less_room():
    rng = np.random.default_rng(7)
    words = rng.integers(0, (1 << 64) - 1, 20_000, np.uint64)[np.minimum(rng.zipf(1.3, 300_000), 20_000) - 1]
    for order, room in ((2, 4.5), (3, 5.3)):                  # 6 and 5.7 bytes a key as steps
        keys = np.unique(lm.ngram_keys(words, np.array([0, len(words)]), order))
        keys = keys[keys < np.uint64(1 << 62)]
        size = len(lm.pack_ngrams(keys, lm.word_bits(order)))
        assert size < room * len(keys) and size < 0.93 * len(B.pack_steps(keys))


def test_freed_memory_goes_back_after_a_task(monkeypatch):
    given = []
    monkeypatch.setattr(B, "give_back", lambda result=None: given.append(1) or result)
    run = B.tidy(lambda batches: (b for b in batches))
    batches = run(iter([1, 2]))
    assert next(batches) == 1 and not given
    assert list(batches) == [2] and given == [1]


def test_replacing_personal_data_takes_no_second_worker(spark, capsys):
    docs = spark.createDataFrame([(i, f"write to a{i}@b.org, or not") for i in range(9)] + [(9, None)], "doc_id long, text string")
    nodes = []
    for df in (pii.find(docs, with_text=True), pii.sanitise(docs)):
        df.explain()
        nodes.append(capsys.readouterr().out.count("InArrow"))
    assert nodes[0] == nodes[1] > 0
    assert {r.doc_id: r.text for r in pii.sanitise(docs).collect()} == {**{i: "write to [EMAIL], or not" for i in range(9)}, 9: None}


def test_pieces_told_apart_by_letters_are_those_of_the_library(monkeypatch):
    """Few pieces need offsets; those whose letters change in number, or that hold marks of the file, are as the library has them."""
    r, some = np.random.default_rng(5), list("abcXYZ.,'-019é ÿß<|>/w")
    plain = sorted({"".join(r.choice(some, r.integers(1, 9))).replace(" ", "") or "a" for _ in range(3000)} - {"</w>", "a</w>"})
    odd = ["</w>", "a</w>", "<|endoftext|>", "x<|endoftext|>y", "\u0130\u1e9e", "\u1e9e\u0130", "\U0001f600", "\u5b57", "a\u0301", "a\x1cb", " a"]
    e, by_offsets, asked = packing.LibraryEncoder(tokenizer_path()), packing.LibraryEncoder._by_offsets, []
    monkeypatch.setattr(packing.LibraryEncoder, "_by_offsets", lambda self, pieces, which, out: (asked.extend(which), by_offsets(self, pieces, which, out)))
    both = [x for k in range(0, len(plain), 300) for x in (*plain[k:k + 300], *odd)]
    expected = [np.array(e.library.encode(p, add_special_tokens=False).ids, "<u4").tobytes() for p in both]
    assert e.encode_pieces(both) == expected
    assert len(asked) < 0.3 * len(both) and e.encode_pieces([]) == []
    e.letters[:] = 0                                           # a file whose tokens do not spell the text
    assert e.encode_pieces(both) == expected


def test_values_remembered_are_made_once():
    known, made = packing.Memory(3), []
    make = lambda keys: [made.append(k) or k.encode() for k in keys]
    for keys in (["a", "b", "c", "d"], ["a", "e"], [], ["e", "b"]):
        known.age()
        assert known.values_of(keys, make) == [k.encode() for k in keys]
    assert made == ["a", "b", "c", "d", "e"] and "a" in known and "c" in known.old


def test_tables_of_powers_stay_small_and_hashes_the_same(monkeypatch):
    data = np.random.default_rng(3).integers(97, 123, 900_000).astype(np.uint8)
    data[::6] = 32
    at = np.arange(0, len(data) + 1, 9_000)

    def hashed(chunk):
        monkeypatch.setattr(B, "CHUNK", chunk)
        monkeypatch.setattr(B, "_POWERS", {})
        words, first = B.word_hashes(data, at)
        out = words, first, *B.window_hashes(words, first, 5)
        return out, sum(x.nbytes for pair in B._POWERS.values() for x in pair)

    (now, room), (before, _) = hashed(B.CHUNK), hashed(1 << 20)
    assert all(np.array_equal(a, b) for a, b in zip(now, before))
    assert room <= 10 << 20
