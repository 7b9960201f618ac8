import struct

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from scenequarry.llm import best_fit as B

PATH = public_tokenizers.path("word_bpe_49k.json")


def test_pieces_equal_the_tokenizer(spark):
    texts = [None, "", "Hello, it's ONE world!", "ein  Straße été", "a\x1cb\x85c d e", "x" * 5000, "word and " * 3000, "<|endoftext|> in text", "é ñ 12345", "​ zero"]
    tk = Tokenizer.from_file(PATH)
    df = spark.createDataFrame([(i, t, "k") for i, t in enumerate(texts)], "asset_id long, notes string, piece string")
    got = {}
    for r in B.token_pieces(df, PATH, capacity=256).collect():
        got.setdefault(r.asset_id, {})[r.piece] = (r.start, list(struct.unpack(f"<{r.length}I", r.ids)))
    for i, t in enumerate(texts):
        ids = tk.encode(t or "", add_special_tokens=False).ids + [0]
        assert got[i] == {k // 256: (k, ids[k : k + 256]) for k in range(0, len(ids), 256)}


def test_words_of_whole_documents(spark):
    tk, own = Tokenizer.from_file(PATH), B.WordIds(PATH)
    assert own.simple
    texts = [r.text for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()]
    texts += [chr(c) + "ab" + chr(c) for c in range(33, 0x250)] + ["it's", "ab'll.", "x_y", "a.b", "ab...", "ÀÉ!", "ab\u0301c", "İx", "don't!!", "#tag", "ab<|endoftext|>"]
    assert own.encode(texts) == [np.array(e.ids, "<u4").tobytes() for e in tk.encode_batch(texts, add_special_tokens=False)]


def slow_best_fit(lengths, capacity):
    gaps = []
    for x in sorted(lengths, reverse=True):
        fit = [g for g in gaps if g >= x]
        if fit:
            gaps.remove(min(fit))
            gaps.append(min(fit) - x)
        else:
            gaps.append(capacity - x)
    return len(gaps)


def test_sweeps_are_as_good_as_one_by_one(rng):
    for _ in range(30):
        capacity = int(rng.integers(5, 60))
        lengths = rng.integers(1, capacity + 1, int(rng.integers(1, 120))).tolist()
        found = B.sweeps({x: lengths.count(x) for x in lengths}, capacity)
        used = {}
        for length, _, n, first, offset in found:
            for k in range(n):
                used.setdefault(first + k, []).append((offset, length))
        assert sum(map(len, used.values())) == len(lengths)
        for parts in used.values():
            end = 0
            for offset, length in sorted(parts):
                assert offset == end
                end += length
            assert end <= capacity
        assert len(used) <= slow_best_fit(lengths, capacity) + 1


def test_pack(spark):
    rng = np.random.default_rng(3)
    rows = [(i % 50 if i % 7 else None, int(x), "c", 5) for i, x in enumerate(rng.integers(1, 65, 700))] + [(1, 64, "c", 5)] * 300
    df = spark.createDataFrame(rows, "asset_id long, length long, extra string, offset long")
    got = B.pack_pieces(df, ["asset_id"], 64).collect()
    seq = {}
    for r in got:
        seq.setdefault(r.sequence_id, []).append((r.offset, r.length))
    assert len(got) == 1000 and sorted((r.asset_id is None, r.asset_id or 0, r.length) for r in got) == sorted((a is None, a or 0, n) for a, n, _, _ in rows)
    for parts in seq.values():
        assert [o for o, _ in sorted(parts)] == [sum(n for _, n in sorted(parts)[:k]) for k in range(len(parts))] and sum(n for _, n in parts) <= 64
    assert len(seq) <= slow_best_fit([r.length for r in got], 64) + 1
    assert B.pack_pieces(df.limit(0), ["asset_id"], 64).collect() == []
    with pytest.raises(ValueError):
        B.pack_pieces(spark.createDataFrame([(1, 65)], "asset_id long, length long"), ["asset_id"], 64)
