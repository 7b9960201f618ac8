"""Packing of asset notes into token sequences: bulk-synchronous best fit over length classes."""

from __future__ import annotations

import json
import re
import struct
from bisect import bisect_left, insort
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from scenequarry.llm.components import ranked
from scenequarry.llm.shipping import ship
from scenequarry.session import cut

#: Separators that str.split() knows and the tokenizer's own pattern doesn't.
ODD_GAP = re.compile("[\x1c-\x1f]")
GAP = re.compile("[\t-\r \x85\xa0  -     　]+")
#: Words kept with their ids in a worker, and characters of text that are split at once.
CACHE, SLICE = 300_000, 1_000_000
# Fixed value: how the vocabulary's own file splits words. With it, letters and the signs after them are two pieces.
WORD_PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
SIMPLE = re.compile("([a-zß-öø-ÿ]+)([!-&(-/:-@\\[-`{-~]*)")


def _byte_letters() -> dict[int, str]:
    """Letters that stand for the UTF-8 bytes of the first 256 characters in byte-level vocabularies."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in shown]
    stands = {b: chr(b) for b in shown} | {b: chr(256 + i) for i, b in enumerate(hidden)}
    return {c: "".join(stands[b] for b in chr(c).encode()) for c in range(256)}


class WordIds:
    """Token ids of words, each worked out once and kept; the vocabulary is a tokenizers file."""

    def __init__(self, vocabulary: str) -> None:
        from tokenizers import Tokenizer

        self.model = Tokenizer.from_file(vocabulary)
        spec = json.loads(self.model.to_str())
        steps = [x.get("type") for x in (spec.get("normalizer") or {}).get("normalizers", [])]
        cuts = (spec.get("pre_tokenizer") or {}).get("pretokenizers", [])
        self.simple = steps == ["NFC", "Replace", "Lowercase"] and [x.get("type") for x in cuts] == ["Split", "ByteLevel"] and cuts[0]["pattern"] == {"Regex": WORD_PATTERN} and not cuts[1]["add_prefix_space"]
        self.letters = _byte_letters()
        self.forget()

    def forget(self) -> None:
        self.known: dict[str, bytes] = {}
        self.parts: dict[str, bytes] = {"": b""}

    def part(self, text: str) -> bytes:
        """Ids of a run of letters or signs, straight from the merges: nothing in it needs to be normalised or split."""
        if (out := self.parts.get(text)) is None:
            if len(self.parts) >= CACHE:
                self.parts = {"": b""}
            self.parts[text] = out = struct.pack(f"<{len(t)}I", *(x.id for x in t)) if (t := self.model.model.tokenize(text.translate(self.letters))) else b""
        return out

    def learn(self, words: set[str]) -> None:
        rest = []
        for w in words:
            if self.simple and (m := SIMPLE.fullmatch(w.lower())):
                self.known[w] = self.part(m[1]) + self.part(m[2])
            else:
                rest.append(w)
        for k in range(0, len(rest), 20_000):
            some = rest[k : k + 20_000]
            self.known.update(zip(some, (np.array(e.ids, "<u4").tobytes() for e in self.model.encode_batch_fast(some, add_special_tokens=False)), strict=True))

    def encode(self, texts: list[str]) -> list[bytes]:
        """Ids of each text as little-endian 32-bit numbers.

        The vocabulary drops white space and no token crosses it, so a text's ids are those of its words in order.
        """
        out: list[bytes] = []
        at = 0
        while at < len(texts):
            parts, n = [], 0
            while at < len(texts) and (not parts or n + len(texts[at]) <= SLICE):
                t = texts[at]
                n += len(t)
                parts.append([w for w in GAP.split(t) if w] if ODD_GAP.search(t) else t.split())
                at += 1
            new = set().union(*parts).difference(self.known)
            if len(self.known) + len(new) > CACHE:
                self.known.clear()
                new = set().union(*parts)
            self.learn(new)
            out += [b"".join(map(self.known.__getitem__, p)) for p in parts]
        return out


_loaded: dict[str, WordIds] = {}


def word_ids(vocabulary: str) -> WordIds:
    """The worker's table for a vocabulary file."""
    if vocabulary not in _loaded:
        _loaded[vocabulary] = WordIds(vocabulary)
    return _loaded[vocabulary]


def token_pieces(assets: DataFrame, vocabulary: str, asset_id: str = "asset_id", notes: str = "notes", capacity: int = 2048, end_id: int = 0) -> DataFrame:
    """Token pieces of whole notes: ``asset_id, piece int, start long, length long, ids binary``.

    ``ids`` holds little-endian 32-bit numbers: the note's token ids followed by ``end_id``, which a null or empty note has
    alone. Only longer notes are cut, into pieces of ``capacity`` tokens; the last may be shorter. ``vocabulary`` is a
    tokenizers file that each worker can read, whose tokens don't cross white space. Repeated rows give repeated pieces.
    """
    ship(assets.sparkSession)
    end = np.array([end_id], "<u4").tobytes()
    width = 4 * capacity

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            owner, texts = b.column(0), [t or "" for t in b.column(1).to_pylist()]
            for k in range(0, len(texts), 500):
                row, piece, start, length, ids = [], [], [], [], []
                for i, e in enumerate(word_ids(vocabulary).encode(texts[k : k + 500]), k):
                    e += end
                    for j in range(0, len(e), width):
                        part = e[j : j + width]
                        row.append(i)
                        piece.append(j // width)
                        start.append(j // 4)
                        length.append(len(part) // 4)
                        ids.append(part)
                yield pa.RecordBatch.from_arrays([owner.take(pa.array(row, pa.int64())), pa.array(piece, pa.int32()), pa.array(start, pa.int64()), pa.array(length, pa.int64()), pa.array(ids, pa.binary())], [asset_id, "piece", "start", "length", "ids"])
        word_ids(vocabulary).forget()  # the worker lives on, and other stages need its memory

    kind = assets.schema[asset_id].dataType.simpleString()
    return assets.select(F.col(asset_id), F.col(notes)).mapInArrow(run, f"`{asset_id}` {kind}, piece int, start long, length long, ids binary")


def sweeps(counts: dict[int, int], capacity: int) -> list[tuple[int, int, int, int, int]]:
    """Matches (length, first rank, number, first sequence, offset) of best fit by descending length.

    Lengths and gaps are whole numbers up to ``capacity``, so the sorted documents and the sorted gaps are kept as runs of
    equal size; that table is bounded by ``capacity``, not by the number of documents. One superstep handles all documents
    of one length at once: they sweep over the gaps from their successor upwards, the r-th of them takes the r-th gap, and
    the gaps that were taken shrink before the next sweep. Documents that find no gap open sequences.
    """
    gaps: dict[int, list[tuple[int, int]]] = {}
    sizes: list[int] = []
    out: list[tuple[int, int, int, int, int]] = []
    opened = 0

    def leave(gap: int, first: int, n: int) -> None:
        if gap and n:
            if gap not in gaps:
                gaps[gap] = []
                insort(sizes, gap)
            gaps[gap].append((first, n))

    for length in sorted(counts, reverse=True):
        rank, left = 0, counts[length]
        while left and (k := bisect_left(sizes, length)) < len(sizes):
            gap = sizes[k]
            first, n = gaps[gap].pop()
            if not gaps[gap]:
                del gaps[gap], sizes[k]
            took = min(n, left)
            out.append((length, rank, took, first, capacity - gap))
            leave(gap, first + took, n - took)
            leave(gap - length, first, took)
            rank, left = rank + took, left - took
        each = capacity // length
        for n, layers in ((left // each, each), (1, left % each)):
            if n and layers:
                for j in range(layers):
                    out.append((length, rank + j * n, n, opened, j * length))
                leave(capacity - layers * length, opened, n)
                rank, opened = rank + layers * n, opened + n
    return out


def pack_pieces(pieces: DataFrame, order: list[str], capacity: int = 2048) -> DataFrame:
    """``pieces`` (column ``length`` from 1 to ``capacity``) as a table with ``sequence_id`` and ``offset``.

    Pieces share sequences of at most ``capacity`` tokens; offsets are gapless from 0. Documents are range-sorted by
    (length, ``order``) and ranked within their length, the counts by length go through ``sweeps``, and each piece finds
    its match by its rank. A length that a third of all pieces share is spread over as many ranges as it needs. Only the
    table of matches, bounded by ``capacity``, is sent to the workers. All other columns ride along; a column that is
    already named ``sequence_id`` or ``offset`` is replaced. A length beyond ``capacity`` or below 1, or null, is an error.
    """
    spark = pieces.sparkSession
    ship(spark)
    laid = ranked(cut(pieces.drop("sequence_id", "offset")), "length", order, "_rank")
    counts = {r[0]: r[1] for r in laid.groupBy("length").count().collect()}
    if any(n is None or not 0 < n <= capacity for n in counts):
        raise ValueError(f"lengths must lie between 1 and {capacity}")
    found = np.array(sweeps(counts, capacity), np.int64).reshape(-1, 5)
    found = found[np.lexsort((found[:, 1], found[:, 0]))]
    shared = spark.sparkContext.broadcast(found)
    names = [c for c in laid.columns if c != "_rank"]

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = shared.value
        key = (table[:, 0] << 44) + table[:, 1]
        for b in batches:
            if not b.num_rows:
                continue
            length, rank = (b.column(c).to_numpy(zero_copy_only=False) for c in ("length", "_rank"))
            at = np.searchsorted(key, (length << 44) + rank, side="right") - 1
            yield pa.RecordBatch.from_arrays([*[b.column(c) for c in names], pa.array(table[at, 3] + rank - table[at, 1]), pa.array(table[at, 4])], [*names, "sequence_id", "offset"])

    return laid.mapInArrow(place, ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in laid.schema if f.name in names) + ", sequence_id long, offset long")
