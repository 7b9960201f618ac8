import io

import public_tokenizers
import sentencepiece

from scenequarry.llm import pieces as P

PATH = public_tokenizers.path("piece_bpe_32k.model")
TEXTS = ["", " ", "  two  spaces ", "Hello world", "tab\tand\nline", "日本語 🙂 ẞ", "▁ mark ▁▁ x", "\x00\x1f", "ﬁ é é", "<s> </s> <0x41>", "long " * 30_000, "a" * 3000]


def test_parity(spark):
    sp = sentencepiece.SentencePieceProcessor(model_file=PATH)
    df = spark.createDataFrame([("en", str(i), t) for i, t in enumerate(TEXTS)] + [("en", "n", None)], "lang string, key string, value string")
    got = {r.key: r for r in P.decode_strings(P.encode_strings(df, PATH), PATH).collect()}
    for i, t in enumerate(TEXTS):
        want = sp.encode(t)
        assert got[str(i)].ids == want, t[:20]
        assert got[str(i)].decoded == sp.decode(want)
    assert got["n"].ids == [] and got["n"].decoded == ""
    assert P.encode_strings(df.limit(0), PATH).collect() == []


def test_whole_documents(spark):
    sp = sentencepiece.SentencePieceProcessor(model_file=PATH)
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").selectExpr("doc_id AS key", "text AS value", "0 AS ids")
    for r in P.decode_strings(P.encode_strings(docs, PATH), PATH).collect():
        assert r.ids == sp.encode(r.value or "") and r.decoded == (r.value or "")


def _varint(n):
    out = b""
    while n > 127:
        out, n = out + bytes([n & 127 | 128]), n >> 7
    return out + bytes([n])


def _field(k, v):
    return _varint(k << 3 | 2) + _varint(len(v)) + v if isinstance(v, bytes) else _varint(k << 3) + _varint(v)


def test_unigram_models(tmp_path):
    import struct

    pieces = [("<unk>", 0.0, 2), ("▁", -2.0, 1), ("▁the", -3.0, 1), ("▁th", -4.0, 1), ("e", -3.5, 1), ("r", -3.6, 1), ("er", -4.2, 1), ("▁a", -3.1, 1), ("t", -4.0, 1), ("h", -4.1, 1), ("at", -5.0, 1), ("a", -4.0, 1)]
    pieces += [(f"<0x{b:02X}>", -20.0, 6) for b in range(256)]
    data = b"".join(_field(1, _field(1, p.encode()) + b"\x15" + struct.pack("<f", s) + _field(3, t)) for p, s, t in pieces)
    data += _field(2, _field(3, 1) + _field(35, 1)) + _field(3, _field(3, 1) + _field(4, 1) + _field(5, 1))
    path = tmp_path / "uni.model"
    path.write_bytes(data)
    sp = sentencepiece.SentencePieceProcessor(model_proto=io.BytesIO(data).getvalue())
    c = P.PieceCoder(str(path))
    for t in ["", "the", "  the   rat at ", "other é", "aaa", "hat 日"]:
        assert c.encode([t])[0] == sp.encode(t), t
        assert c.decode([sp.encode(t)])[0] == sp.decode(sp.encode(t)), t


def _model(path, pieces, kind, fallback, table=b""):
    import struct

    pieces = pieces + [(f"<0x{b:02X}>", -20.0, 6) for b in range(256)] * fallback
    data = b"".join(_field(1, _field(1, p.encode()) + b"\x15" + struct.pack("<f", s) + _field(3, t)) for p, s, t in pieces)
    data += _field(2, _field(3, kind) + _field(35, fallback)) + _field(3, _field(3, 1) + _field(4, 1) + _field(5, 1))
    path.write_bytes(data)
    return P.PieceCoder(str(path)), sentencepiece.SentencePieceProcessor(model_proto=data)


TYPED = ["", "a<s>the", "<unk>the</s>", "the<0x41>", "x the x", "<sep>the<sep><sep>at", "the<sep", "hat é日", "ater th the", "é<sep>é", "  a  <sep>  a", "thethe at"]


def test_pieces_of_all_types(tmp_path):
    """Control, unknown, byte, unused and user-defined pieces act as in the library, in unigram and merging models."""
    special = [("<unk>", 0.0, 2), ("<s>", 0.0, 3), ("</s>", 0.0, 3), ("<sep>", 0.0, 4)]
    letters = [(c, -5.0 - k / 8, 1) for k, c in enumerate("▁theasupkr<>/0x41n")]
    words = [("▁the", -3.0, 1), ("▁t", -2.5, 1), ("he", -2.0, 5), ("▁th", -4.0, 5), ("at", -3.4, 1), ("er", -4.2, 5), ("ate", -4.4, 1)]
    for kind in (1, 2):
        for fallback in (0, 1):
            c, sp = _model(tmp_path / f"{kind}{fallback}.model", special + letters + words, kind, fallback)
            for t in TYPED:
                assert c.encode([t])[0] == sp.encode(t), (kind, fallback, t)
            n = len(c.model.pieces)
            for ids in [[0, 5, 6], [1, 22, 2], [1, 0, 3], [4, 22], *([[n - 1, n - 2, 5], [n - 256 + 0xE6, n - 256 + 0x97, n - 256 + 0xA5, n - 1, 6], [n - 256 + 32, 5]] if fallback else [])]:
                assert c.decode([ids])[0] == sp.decode(ids), (kind, fallback, ids)
