"""Toxic asset notes: words restored through a noisy channel, then scored."""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import cached_property

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from scenequarry.llm.shipping import ship
from scenequarry.session import cut

# Signs and the letters that they stand for.
SIGNS = {
    "0": "o", "1": "il", "2": "z", "3": "e", "4": "a", "5": "s", "6": "bg", "7": "t", "8": "b", "9": "g", "@": "a", "$": "s", "!": "i", "|": "il", "+": "t",
    "(": "c", "<": "c", "¡": "i", "€": "e", "£": "l", "¥": "y", "а": "a", "е": "e", "о": "o", "р": "p", "с": "c", "х": "x", "у": "y", "і": "i", "к": "k", "м": "m", "т": "t",
}
#: Signs that stand for any letter.
ANY = "*#?"
ALPHABET = "\0abcdefghijklmnopqrstuvwxyzäöüßéèêëçàâîïôûùñíóáúœ"
SIZE = len(ALPHABET) + 1
CODE = {c: i for i, c in enumerate(ALPHABET)}
OTHER = SIZE - 1
LETTER = r"[^\W\d_]"
_SIGN = re.escape("".join(SIGNS) + ANY)
#: Three or more equal signs at an end are decoration, and so is punctuation around a word.
DECORATION = re.compile(r"^([^\w])\1{2,}|([^\w])\2{2,}$")
AROUND = ".,;:!?\"'()[]{}-_<>&%#*|"
SPACED = re.compile(r"[^\W_](?:[.\-_*~/][^\W_]){2,}")
SUSPECT = re.compile(rf"{LETTER}[{_SIGN}]|[{_SIGN}]{LETTER}|({LETTER})\1", re.IGNORECASE)
#: Three signs or more without a letter, of which one at least stands for certain letters.
SIGNED = re.compile(rf"(?=.*[^{re.escape(ANY)}])[{_SIGN}]{{3,}}", re.IGNORECASE)
INVISIBLE = re.compile("[\u00ad\u200b-\u200f\u2060\ufeff]")
WORD = re.compile(rf"{LETTER}+")
#: Punctuation around a token of signs, as far as it doesn't stand for letters itself.
EDGE = "".join(c for c in AROUND if c not in SIGNS and c not in ANY)
DOUBLED, SIGN = re.compile(r"(.)\1"), re.compile(f"[{_SIGN}]")
#: Tokens and features that a task keeps readings of, features that it counts before it hands them on, and rows that it scores
#: and counts at once.
KNOWN, TALLIED, ROWS, COUNTED = 60_000, 50_000, 500, 128


def letter_counts(assets: DataFrame, notes: str = "notes") -> DataFrame:
    """(gram, n): counts of all runs of four letters over all whole notes, word by word, as one table.

    A word starts and ends with three boundary signs; a gram is a number to the base of the alphabet. Each task counts
    its own rows in one array of fixed size, and the counts are added up by gram. Null notes count for nothing.
    """
    ship(assets.sparkSession)
    table = np.full(0x250, OTHER, np.int32)
    for i in range(0x250):
        c = chr(i).lower()
        table[i] = CODE.get(c, OTHER) if re.match(LETTER, chr(i)) else 0

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(SIZE**4, np.uint32)
        for b in batches:
            for k in range(0, b.num_rows, COUNTED):
                texts = [t for t in b.column(0).slice(k, COUNTED).to_pylist() if t]
                chars = np.frombuffer("\n".join(["", *texts, ""]).encode("utf-32-le", "surrogatepass"), np.uint32)
                c = table[np.minimum(chars, len(table) - 1)]
                c[chars >= len(table)] = OTHER
                c = c[np.concatenate([[True], (c[1:] != 0) | (c[:-1] != 0)])]
                c = np.repeat(c, np.where(c == 0, 3, 1))
                np.add.at(total, ((c[:-3] * SIZE + c[1:-2]) * SIZE + c[2:-1]) * SIZE + c[3:], np.uint32(1))
        seen = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(seen.astype(np.int32)), pa.array(total[seen].astype(np.int64))], ["gram", "n"])

    return assets.select(notes).mapInArrow(run, "gram int, n long").groupBy("gram").agg(F.sum("n").alias("n"))


class LetterModel:
    """Log probability of a letter after three others, backed off to shorter contexts.

    Counts travel as they are, a few bytes for each gram that occurs; ``table``, of a size that the alphabet fixes, is worked
    out once by whoever needs it.
    """

    def __init__(self, grams: np.ndarray, counts: np.ndarray, strength: float = 5.0) -> None:
        self.grams, self.counts, self.strength = grams, counts, strength

    @cached_property
    def table(self) -> np.ndarray:
        n = np.zeros(SIZE**4, np.float32)
        n[self.grams] = self.counts
        n = n.reshape((SIZE,) * 4)
        three = n.sum(0, dtype=np.float64)
        p = (three.sum((0, 1)) + 1) / (three.sum() + SIZE)
        for own in (three.sum(0), three):
            p = (own + self.strength * p) / (own.sum(-1, keepdims=True) + self.strength)
        seen = n.sum(-1, keepdims=True) + np.float32(self.strength)
        n += np.float32(self.strength) * p.astype(np.float32)
        n /= seen
        return np.log(n, out=n)

    def __getstate__(self) -> dict:
        return {k: v for k, v in self.__dict__.items() if k != "table"}


def letter_model(counts: DataFrame) -> LetterModel:
    """The model of ``letter_counts``."""
    t = counts.toArrow()
    return LetterModel(t.column("gram").to_numpy(), t.column("n").to_numpy())


#: Readings of a sign that stands for any letter or none.
MASK = [(x, 2.0) for x in ALPHABET[1:27]] + [("", 3.0)]


def lattice(token: str) -> list[list[tuple[str, float]]]:
    """Readings of each place of a token with their costs; a place is a sign, a letter or a run of equal letters."""
    out: list[list[tuple[str, float]]] = []
    chars = token.lower()
    i = 0
    while i < len(chars):
        j = i
        while j < len(chars) and chars[j] == chars[i]:
            j += 1
        c, n = chars[i], j - i
        if c in SIGNS:
            reads = [(x, 0.5) for x in SIGNS[c]] + [(x + x, 0.5) for x in SIGNS[c] if n > 1]
            if c.isalnum():
                reads.append((c, 1.0))
        elif c in ANY:
            out += [MASK] * n
            reads = [("", 0.0)]
        elif n == 1:
            reads = [(c, 0.0)]
        else:
            reads = [(c, 0.7 if n > 2 else 3.0), (c + c, 0.7 if n > 2 else 0.0)]
        out.append(reads)
        i = j
    return out


States = dict[tuple[int, int, int], tuple[float, str]]


def masked(states: States, places: int, model: np.ndarray) -> States:
    """``states`` after so many places of ``MASK``, on arrays over the letters that can occur, as each place multiplies the states."""
    used = sorted({*range(1, 27), *(x for k in states for x in k)})
    at = {c: i for i, c in enumerate(used)}
    own, size = model[np.ix_(used, used, used, used)], len(used)
    best, texts = np.full((size,) * 3, -np.inf), np.full((size,) * 3, "", object)
    for k, (s, t) in states.items():
        best[tuple(at[x] for x in k)], texts[tuple(at[x] for x in k)] = s, t
    letters, free = np.array([ALPHABET[c] if 0 < c < 27 else "" for c in used], object), np.array([0.0 if 0 < c < 27 else -np.inf for c in used])
    y, z, d = np.ix_(range(size), range(size), range(size))
    for k in range(places):
        after = best[..., None] + own
        first = after.argmax(0)
        after = np.take_along_axis(after, first[None], 0)[0] + free - MASK[0][1]
        stay = best - MASK[-1][1]
        if not (after > stay).any():  # nor will a later place add a letter
            best = best - (places - k) * MASK[-1][1]
            break
        texts = np.where(after > stay, texts[first, y, z] + letters[d], texts)
        best = np.maximum(after, stay)
    return {(used[i], used[j], used[k]): (float(best[i, j, k]), texts[i, j, k]) for i, j, k in zip(*np.nonzero(np.isfinite(best)), strict=True)}


def decode(token: str, model: np.ndarray) -> str:
    """Best reading of a token by Viterbi over its lattice; a state is the last three letters."""
    return best_path(lattice(token), model)[1]


def best_path(places: list[list[tuple[str, float]]], model: np.ndarray) -> tuple[float, str]:
    """(score, text) of the best path through the readings of ``places``."""
    states: States = {(0, 0, 0): (0.0, "")}
    i = 0
    while i < len(places):
        reads, j = places[i], i + 1
        while reads is MASK and j < len(places) and places[j] is MASK:
            j += 1
        if j - i > 1:
            states, i = masked(states, j - i, model), j
            continue
        i = j
        after: States = {}
        for (a, b, c), (score, text) in states.items():
            for letters, cost in reads:
                s, x, y, z = score - cost, a, b, c
                for ch in letters:
                    d = CODE.get(ch, OTHER)
                    s += float(model[x, y, z, d])
                    x, y, z = y, z, d
                old = after.get((x, y, z))
                if old is None or (s, text + letters) > old:
                    after[(x, y, z)] = (s, text + letters)
        states = after
    return max((s + float(model[x, y, z, 0]), t) for (x, y, z), (s, t) in states.items())


def signed(token: str, model: np.ndarray) -> list[tuple[float, str]]:
    """(score, text) of a token of signs only: the best reading, and the best one with a letter for each sign."""
    each = [MASK[:-1] if c in ANY else [(x, 0.5) for x in SIGNS[c]] for c in token.lower()]
    return [best_path(places, model) for places in (lattice(token), each)]


def signs_only(token: str) -> str:
    """A token of signs only without the punctuation around it that doesn't stand for letters; empty for any other token."""
    if token.isascii() and token.isalpha():
        return ""
    core = token.strip(EDGE)
    return core if SIGNED.fullmatch(core) else ""


def reading(token: str, model: np.ndarray) -> list[str]:
    """Lower-case words that a token without white space stands for; a plain token stands for its own letters.

    A token of signs only stands for a word if that is likelier than as many letters at random; else it is a number.
    """
    if core := signs_only(token):
        score, text = max(signed(core, model))
        return WORD.findall(text) if score > -(len(text) + 1) * math.log(SIZE) else []
    core = token.strip(AROUND)
    if not core.isalpha():
        core = DECORATION.sub("", INVISIBLE.sub("", token)).strip(AROUND)
        if len(core) > 2 and SPACED.fullmatch(core):
            return [decode(core[::2], model)]
    if SUSPECT.search(core):
        return WORD.findall(decode(core, model))
    return [core.lower()] if core.isalpha() else WORD.findall(core.lower())


def readings(token: str, model: np.ndarray) -> set[str]:
    """The words of ``reading`` and the token's own letters."""
    words = reading(token, model)
    if core := signs_only(token):
        words = [w for _, t in signed(core, model) for w in WORD.findall(t)]
    return {*words} if token.isalpha() and len(words) == 1 and len(words[0]) == len(token) else {*words, *WORD.findall(token.lower())}


def heads(parts: dict[str, float]) -> set[str]:
    """First three letters of all features."""
    return {f[1:4] if f[0] == "=" else f[:3] for f in parts}


def may_tell(token: str, known: set[str]) -> bool:
    """Whether some reading of a token can begin as a feature does (``heads``).

    A word without signs can only be read with each of its doubled letters once or twice, so a look at those spellings
    spares the decoder where none of them tells anything. Any other token may.
    """
    word = token.strip(AROUND).lower()
    if not word.isalpha() or not word.isascii() and SIGN.search(word):
        return True
    if word[:3] in known:
        return True
    spellings, at = {""}, 0
    for m in DOUBLED.finditer(word):
        if m.start() < at:  # inside a longer run
            continue
        spellings = {s + word[at : m.start()] + c for s in spellings for c in (m[1], m[0])}
        at = m.end()
        while at < len(word) and word[at] == m[1]:
            at += 1
        spellings = {s[:3] for s in spellings}
        if all(len(s) == 3 for s in spellings):
            break
    return bool(at) and any((s + word[at:])[:3] in known for s in spellings)


def runs(tokens: list[str]) -> list[tuple[int, int]]:
    """(first, end) of at least three single characters in a row."""
    ones = [i for i, w in enumerate(tokens) if len(w) == 1]
    out, k = [], 0
    while k < len(ones):
        j = k
        while j + 1 < len(ones) and ones[j + 1] == ones[j] + 1:
            j += 1
        if j - k >= 2:
            out.append((ones[k], ones[j] + 1))
        k = j + 1
    return out


def spaced(tokens: list[str], model: np.ndarray) -> list[str]:
    """Readings of letters that stand alone in a row; a letter at either end may be a word of its own."""
    whole = decode("".join(tokens), model)
    return [whole, whole[1:], whole[:-1], whole[1:-1]]


def restore(text: str, model: np.ndarray) -> str:
    """Whole text in lower case with each token's readings in its place, one space between words."""
    tokens = text.split()
    out, at = [], 0
    for first, end in [*runs(tokens), (len(tokens), len(tokens))]:
        out += [w for t in tokens[at:first] for w in reading(t, model)]
        if first < end:
            out.append(decode("".join(tokens[first:end]), model))
        at = end
    return " ".join(out)


class Words(dict):
    """What ``read`` makes of a token, worked out once per token and task as long as tokens and results stay below ``KNOWN``."""

    def __init__(self, read) -> None:
        super().__init__()
        self.read, self.held = read, 0

    def __missing__(self, token: str) -> tuple[str, ...]:
        if self.held >= KNOWN:
            self.clear()
            self.held = 0
        self[token] = out = tuple(self.read(token))
        self.held += 1 + len(out)
        return out

    def of(self, text: str, model: np.ndarray, read) -> set[str]:
        tokens = text.split()
        found = set().union(*map(self.__getitem__, set(tokens)))
        for first, end in runs(tokens):
            for w in spaced(tokens[first:end], model):
                found.update(read(w))
        return found


def features(word: str) -> list[str]:
    """A word of three letters or more and its beginnings of four to six letters."""
    return ["=" + word, *[word[:k] for k in (4, 5, 6) if len(word) > k]] if len(word) > 2 else []


def all_features(letters: np.ndarray) -> Words:
    return Words(lambda t: [f for w in readings(t, letters) for f in features(w)])


@dataclass
class ToxicityModel:
    """Each feature alone makes a note toxic with its own probability; ``base`` is that of a note without any."""

    letters: LetterModel
    base: float = 0.01
    parts: dict[str, float] = field(default_factory=dict)

    def told(self) -> Words:
        known = heads(self.parts)
        return Words(lambda t: [f for w in readings(t, self.letters.table) for f in features(w) if f in self.parts] if may_tell(t, known) else ())

    def hits(self, text: str | None, words: Words) -> set[str]:
        return words.of(text, self.letters.table, lambda w: [f for f in features(w) if f in self.parts]) if text else set()

    def score(self, text: str | None, words: Words) -> float:
        clean = 1 - self.base
        for f in sorted(self.hits(text, words)):
            clean *= 1 - self.parts[f]
        return 1 - clean


def fit_toxicity(labelled: DataFrame, letters: LetterModel, notes: str = "notes", toxic: str = "toxic", candidates: int = 4000, rules: int = 256) -> ToxicityModel:
    """Learn from labelled notes (``toxic`` 0 or 1; null: left out). The caller bounds their number.

    Words and word beginnings of restored notes are counted by label. Those that toxic notes hold more often than chance
    allows (binomial tail, corrected for the number of features; at most the ``candidates`` surest) go to a greedy cover
    of the toxic notes, so that copies of one note don't bring in all their words; at most ``rules`` are taken. A feature's
    part is the smoothed share of toxic notes among those that hold it, and parts combine as independent causes (noisy
    or). Without toxic labels each note gets the smoothed base rate.
    """
    ship(labelled.sparkSession)
    shared = labelled.sparkSession.sparkContext.broadcast(letters)
    rows = cut(labelled.filter(F.col(toxic).isin(0, 1)).select(F.col(notes).alias("t"), (F.col(toxic) == 1).alias("y")))

    def handed(bad: Counter, good: Counter) -> pa.RecordBatch:
        names = [*bad, *(f for f in good if f not in bad)]
        return pa.RecordBatch.from_arrays([pa.array(names), pa.array([bad[f] for f in names], pa.int64()), pa.array([good[f] for f in names], pa.int64())], ["f", "b", "g"])

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bad, good, words = Counter(), Counter(), all_features(shared.value.table)
        for b in (whole.slice(k, COUNTED) for whole in batches for k in range(0, whole.num_rows, COUNTED)):
            for t, y in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                (bad if y else good).update(words.of(t or "", shared.value.table, features))
                if len(bad) + len(good) >= TALLIED:
                    yield handed(bad, good)
                    bad, good = Counter(), Counter()
        if bad or good:
            yield handed(bad, good)

    n = rows.agg(F.count("*"), F.coalesce(F.sum(F.col("y").cast("long")), F.lit(0))).first()
    total, bad = n[0], n[1]
    model = ToxicityModel(letters, (bad + 0.1) / (total + 10))
    if not bad or bad == total:
        return model
    base = bad / total
    tally = cut(rows.mapInArrow(counted, "f string, b long, g long").groupBy("f").agg(F.sum("b").alias("b"), F.sum("g").alias("g")))
    share = F.col("b") / (F.col("b") + F.col("g"))
    tail = -(F.col("b") * F.log(share / base) + F.when(F.col("g") > 0, F.col("g") * F.log((1 - share) / (1 - base))).otherwise(0.0))
    sure = tally.filter("b > 1").withColumn("share", share).withColumn("tail", tail).filter(F.col("share") > base)
    best = sure.filter(F.col("tail") < math.log(0.05 / max(tally.count(), 1))).orderBy("tail", "f").limit(candidates).select("f").collect()
    probe = labelled.sparkSession.sparkContext.broadcast(ToxicityModel(letters, 0.0, {r[0]: 1.0 for r in best}))

    def found(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = probe.value.told()
        for b in (whole.slice(k, ROWS) for whole in batches for k in range(0, whole.num_rows, ROWS)):
            hits = [sorted(probe.value.hits(t, words)) for t in b.column(0).to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column(1), pa.array(hits, pa.list_(pa.string()))], ["y", "hits"])

    seen = [(r.y, r.hits) for r in rows.mapInArrow(found, "y boolean, hits array<string>").collect()]
    holds: dict[str, set[int]] = {}
    wrong: Counter = Counter()
    for i, (y, hits) in enumerate(seen):
        for f in hits:
            if y:
                holds.setdefault(f, set()).add(i)
            else:
                wrong[f] += 1
    left, chosen = {i for i, (y, _) in enumerate(seen) if y}, []
    usable = {f for f in holds if len(holds[f]) >= 4 * wrong[f]}
    while left and usable and len(chosen) < rules:
        f = max(usable, key=lambda f: (len(holds[f] & left) - wrong[f], len(holds[f]), f))
        if len(holds[f] & left) < max(2, 0.001 * bad):
            break
        chosen.append(f)
        left -= holds[f]
        usable.discard(f)
    # words that are as telling by themselves, though every note with them is covered already
    chosen += sorted((f for f in usable if f[0] == "=" and len(holds[f]) >= 0.02 * bad), key=lambda f: -len(holds[f]))[: rules - len(chosen)]
    model.parts = {f: (len(holds[f]) + 0.5) / (len(holds[f]) + wrong[f] + 1) for f in chosen}
    rest = [y for y, hits in seen if model.parts.keys().isdisjoint(hits)]
    model.base = (sum(rest) + 0.1) / (len(rest) + 10)
    return model


def score_notes(assets: DataFrame, model: ToxicityModel, notes: str = "notes", score: str = "toxicity", restored: str | None = None) -> DataFrame:
    """``assets`` with ``score`` (0 to 1, from the whole restored note) and, if named, the restored text itself.

    A null or empty note gets the score of a note without any feature. Other columns stay; columns of these names are replaced.
    """
    ship(assets.sparkSession)
    shared = assets.sparkSession.sparkContext.broadcast(model)
    new = [score] + ([restored] if restored else [])
    kept = assets.drop(*new)
    schema = T.StructType([*kept.schema.fields, T.StructField(score, T.DoubleType()), *([T.StructField(restored, T.StringType())] if restored else [])])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = shared.value.told()
        for b in (whole.slice(k, ROWS) for whole in batches for k in range(0, whole.num_rows, ROWS)):
            texts = b.column(notes).to_pylist()
            more = [pa.array([shared.value.score(t, words) for t in texts], pa.float64())]
            if restored:
                more.append(pa.array([restore(t or "", shared.value.letters.table) for t in texts], pa.string()))
            yield pa.RecordBatch.from_arrays([*b.columns, *more], [*b.schema.names, *new])

    return kept.mapInArrow(run, schema)
