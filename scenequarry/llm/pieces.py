"""SentencePiece encoding and decoding of locale strings with the tokenizers library."""

from __future__ import annotations

import codecs
import os
import re
import struct
from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import cached_property

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from scenequarry.llm.shipping import ship

MARK = "▁"
# Fixed values of the model file: piece types and model types.
NORMAL, UNKNOWN, CONTROL, USER, UNUSED, BYTE = 1, 2, 3, 4, 5, 6
UNIGRAM, BPE = 1, 2
#: Rows that are worked on at once, and threads of a task.
ROWS, THREADS = 250, 2


def _fields(data: bytes) -> Iterator[tuple[int, int | bytes]]:
    """(number, value) of each field of a protobuf message."""

    def varint() -> int:
        nonlocal at
        out = shift = 0
        while True:
            b = data[at]
            at += 1
            out |= (b & 127) << shift
            shift += 7
            if b < 128:
                return out

    at = 0
    while at < len(data):
        tag = varint()
        kind = tag & 7
        if kind == 0:
            yield tag >> 3, varint()
        else:
            n = varint() if kind == 2 else {1: 8, 5: 4}[kind]
            yield tag >> 3, data[at : at + n]
            at += n


@dataclass
class PieceModel:
    """What a model file holds of pieces, kind and normaliser."""

    pieces: list[tuple[str, float, int]] = field(default_factory=list)
    kind: int = UNIGRAM
    unknown: int = 0
    byte_fallback: bool = False
    charsmap: bytes = b""
    dummy_prefix: bool = True
    squeeze: bool = True
    escape: bool = True

    @classmethod
    def parse(cls, data: bytes) -> PieceModel:
        m = cls()
        for number, value in _fields(data):
            if number == 1:
                piece = dict(_fields(value))
                m.pieces.append((piece.get(1, b"").decode(), struct.unpack("<f", piece[2])[0] if 2 in piece else 0.0, piece.get(3, NORMAL)))
            elif number == 2:
                spec = dict(_fields(value))
                m.kind, m.byte_fallback = spec.get(3, UNIGRAM), bool(spec.get(35, 0))
            elif number == 3:
                spec = dict(_fields(value))
                m.charsmap, m.dummy_prefix, m.squeeze, m.escape = spec.get(2, b""), bool(spec.get(3, 1)), bool(spec.get(4, 1)), bool(spec.get(5, 1))
        m.unknown = next((i for i, p in enumerate(m.pieces) if p[2] == UNKNOWN), 0)
        return m

    @property
    def user(self) -> list[str]:
        """User-defined pieces, longest first."""
        return sorted((p for p, _, t in self.pieces if t == USER), key=lambda p: (-len(p), p))

    def names(self) -> list[str]:
        """Pieces by id; those that no text may reach (unknown, control, and of unigram models unused and bytes) get names out of its reach."""
        hidden = (UNKNOWN, CONTROL, UNUSED, BYTE) if self.kind == UNIGRAM else (UNKNOWN, CONTROL)
        return [f"\ufffe\uffff{i}\uffff\ufffe" if t in hidden else p for i, (p, _, t) in enumerate(self.pieces)]

    def merges(self) -> list[tuple[str, str]]:
        """Pairs that a merging model joins, first ones first. Unused pieces are steps on the way, see ``halves``."""
        at = {p: i for i, (p, _, t) in enumerate(self.pieces) if t in (NORMAL, UNUSED)}
        pairs = [(-self.pieces[i][1], i, at[p[:k]], at[p[k:]], (p[:k], p[k:])) for p, i in at.items() for k in range(1, len(p)) if p[:k] in at and p[k:] in at]
        return [x[-1] for x in sorted(pairs)]

    def halves(self) -> dict[int, list[int]]:
        """What unused pieces of a merging model are put out as: the pieces that they were joined from, taken apart as far as need be."""
        at = {p: i for i, (p, _, _) in enumerate(self.pieces)}
        unused = [(p, i) for i, (p, _, t) in enumerate(self.pieces) if t == UNUSED and len(p) > 1]
        rank = {pair: k for k, pair in enumerate(self.merges())} if unused else {}
        out = {}
        for p, i in sorted(unused, key=lambda x: len(x[0])):
            parts = list(p)
            while len(parts) > 2:
                best = min((rank.get(pair, len(rank)), k) for k, pair in enumerate(zip(parts, parts[1:], strict=False)))
                if best[0] == len(rank):
                    break
                parts[best[1] : best[1] + 2] = ["".join(parts[best[1] : best[1] + 2])]
            if len(parts) == 2 and all(x in at for x in parts):
                out[i] = [y for x in parts for y in out.get(at[x], [at[x]])]
        return out

    def tokenizer(self):
        """The tokenizers library's form for normal text: scores or merges, and user-defined pieces."""
        from tokenizers import AddedToken, Tokenizer, models

        names = self.names()
        if self.kind == UNIGRAM:
            normal = [s for _, s, t in self.pieces if t == NORMAL]
            # a user-defined piece scores as the best piece for each of its bytes
            score = lambda p, s, t: s if t == NORMAL else len(p.encode()) * max(normal, default=0.0) - 0.1 if t == USER else max(normal, default=0.0)
            return Tokenizer(models.Unigram([(n, score(*x)) for n, x in zip(names, self.pieces, strict=True)], self.unknown, False))
        if self.kind != BPE:
            raise ValueError(f"model type {self.kind} is not supported")
        out = Tokenizer(models.BPE({n: i for i, n in enumerate(names)}, self.merges(), unk_token=names[self.unknown], fuse_unk=True, byte_fallback=self.byte_fallback))
        out.add_tokens([AddedToken(p, normalized=False) for p in self.user])
        return out

    def normalizer(self):
        """Normaliser and metaspace marker of the model file, after the character table."""
        from tokenizers import Regex, normalizers

        steps = []
        if self.squeeze:
            steps += [normalizers.Strip(), normalizers.Replace(Regex(" {2,}"), " ")]
        if self.dummy_prefix:
            steps.append(normalizers.Prepend(MARK if self.escape else " "))
        if self.escape:
            steps.append(normalizers.Replace(" ", MARK))
        return normalizers.Sequence(steps)


def _one_byte(error: UnicodeError) -> tuple[str, int]:
    return "\ufffd", error.start + 1


codecs.register_error("scenequarry.one_byte", _one_byte)


class PieceCoder:
    """Batch encoding and decoding with one model file: whole texts go to the library in multithreaded batches."""

    def __init__(self, path: str) -> None:
        with open(path, "rb") as f:
            self.model = PieceModel.parse(f.read())

    @cached_property
    def bare(self):
        """The pieces for texts in normal form."""
        return self.model.tokenizer()

    @cached_property
    def rules(self):
        return self.model.normalizer()

    @cached_property
    def chars(self):
        """The character table as a normaliser, and what it must leave alone: the user-defined pieces."""
        from tokenizers import normalizers

        user = self.model.user
        return normalizers.Precompiled(self.model.charsmap), re.compile(f"({'|'.join(map(re.escape, user))})" if user else "((?!))")

    @cached_property
    def halves(self) -> dict[int, list[int]]:
        return self.model.halves() if self.model.kind == BPE else {}

    @cached_property
    def bytes_at(self) -> list[int]:
        """Ids of the 256 byte pieces where unknown characters of a unigram model become those, else none."""
        m = self.model
        at = {p: i for i, (p, _, t) in enumerate(m.pieces) if t == BYTE}
        return [at[f"<0x{b:02X}>"] for b in range(256)] if m.kind == UNIGRAM and m.byte_fallback and len(at) == 256 else []

    @cached_property
    def spelt(self) -> list[bytes]:
        """UTF-8 text of each piece; control pieces have none, the unknown piece has the library's sign."""
        signs = {CONTROL: b"", UNKNOWN: " ⁇ ".encode()}
        return [signs[t] if t in signs else bytes([int(p[3:5], 16)]) if t == BYTE else p.replace(MARK, " ").encode() for p, _, t in self.model.pieces]

    def normal(self, text: str) -> str:
        """What the normaliser makes of a text; without a character table and squeezing that is the marker for each space."""
        m = self.model
        if m.charsmap:
            table, user = self.chars
            text = "".join(x if k % 2 else table.normalize_str(x) for k, x in enumerate(user.split(text)))
        if m.charsmap or m.squeeze:
            return self.rules.normalize_str(text)
        space = MARK if m.escape else " "
        return (space if m.dummy_prefix and text else "") + text.replace(" ", space)

    def encode(self, texts: list[str]) -> list[list[int]]:
        """Ids of each text."""
        texts = [self.normal(t) for t in texts]
        out = [e.ids for e in self.bare.encode_batch_fast(texts, add_special_tokens=False)]
        if self.bytes_at:
            for k, ids in enumerate(out):
                if self.model.unknown in ids:
                    e = self.bare.encode(texts[k], add_special_tokens=False)
                    out[k] = [y for x, (i, j) in zip(e.ids, e.offsets, strict=True) for y in ([self.bytes_at[c] for c in texts[k][i:j].encode()] if x == self.model.unknown else (x,))]
        if self.halves:
            out = [[y for x in ids for y in self.halves.get(x, (x,))] for ids in out]
        return out

    def decode(self, ids: list[list[int]]) -> list[str]:
        """Texts of ids; each byte that is part of no whole character becomes U+FFFD."""
        out = []
        for some in ids:
            text = b"".join(map(self.spelt.__getitem__, some)).decode("utf-8", "scenequarry.one_byte")
            out.append(text[self.marks(some) if text.startswith(" ") else 0 :])
        return out

    def marks(self, ids: list[int]) -> int:
        """Markers at the start that stand for no space: the first one, with squeezing all that come alone."""
        m, n = self.model, 0
        for i in ids if m.dummy_prefix or m.squeeze else ():
            piece, _, kind = m.pieces[i]
            if kind == CONTROL:
                continue
            if kind == BYTE or not piece.startswith(MARK):
                break
            n += 1
            if not m.squeeze or len(piece) > 1:
                break
        return n


_coders: dict[str, PieceCoder] = {}


def coder(path: str) -> PieceCoder:
    """The worker's coder for a model file; the file must lie at that place on each worker.

    Batches use ``THREADS`` threads, as tasks share their machine, unless the worker's environment says otherwise.
    """
    os.environ.setdefault("RAYON_NUM_THREADS", str(THREADS))
    if path not in _coders:
        _coders[path] = PieceCoder(path)
    return _coders[path]


def encode_strings(strings: DataFrame, model: str, value: str = "value", ids: str = "ids") -> DataFrame:
    """``strings`` (locale strings: ``lang, key, value``) with the piece ids of the whole value in ``ids`` (array<int>).

    Null and empty values have no ids. Ids equal those of the sentencepiece library for the same model file. Other columns
    stay; an existing column ``ids`` is replaced.
    """
    ship(strings.sparkSession)
    kept = strings.drop(ids)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c = coder(model)
        for b in batches:
            for k in range(0, b.num_rows, ROWS):
                part = b.slice(k, ROWS)
                codes = c.encode([t or "" for t in part.column(value).to_pylist()])
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(codes, pa.list_(pa.int32()))], [*part.schema.names, ids])

    return kept.mapInArrow(run, T.StructType([*kept.schema.fields, T.StructField(ids, T.ArrayType(T.IntegerType()))]))


def decode_strings(coded: DataFrame, model: str, ids: str = "ids", decoded: str = "decoded") -> DataFrame:
    """``coded`` with the text of ``ids`` in ``decoded``; null ids give null, none give an empty text.

    The marker at the start is taken away, byte pieces are put together; bytes that are no UTF-8 become U+FFFD.
    """
    ship(coded.sparkSession)
    kept = coded.drop(decoded)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c = coder(model)
        for b in batches:
            for k in range(0, b.num_rows, ROWS):
                part = b.slice(k, ROWS)
                codes = part.column(ids)
                flat, ends, known = codes.values.to_numpy(zero_copy_only=False), codes.offsets.to_numpy(), codes.is_valid().to_pylist()
                rows = [flat[i:j].tolist() if ok else None for i, j, ok in zip(ends[:-1], ends[1:], known, strict=True)]
                texts = c.decode([r or [] for r in rows])
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array([None if r is None else t for r, t in zip(rows, texts, strict=True)], pa.string())], [*part.schema.names, decoded])

    return kept.mapInArrow(run, T.StructType([*kept.schema.fields, T.StructField(decoded, T.StringType())]))
