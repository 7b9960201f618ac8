"""Quality rules for frame captions: ordered threshold conjunctions learnt by sequential covering."""

from __future__ import annotations

import math
from collections.abc import Callable, Mapping
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from scenequarry.session import cut

WORD_GAP = r"[\x20\x09-\x0D]+"


def bound(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with ``value`` worked out once."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def _repeat_words(words: Column) -> Column:
    """Words inside three-word windows that occur at least twice."""
    third = F.size(words) - 2
    keys = F.transform(F.sequence(F.lit(0), third - 1), lambda i: F.xxhash64(F.get(words, i), F.get(words, i + 1), F.get(words, i + 2)))

    def places(keys: Column) -> Column:
        order = F.array_sort(F.transform(keys, lambda k, i: F.struct(k.alias("k"), i.alias("i"))))

        def again(s: Column) -> Column:
            same = lambda i, j: F.get(s, i)["k"] == F.get(s, j)["k"]
            at = F.filter(F.sequence(F.lit(0), F.size(s) - 1), lambda i: F.coalesce(same(i, i - 1), F.lit(False)) | F.coalesce(same(i, i + 1), F.lit(False)))
            return F.array_sort(F.transform(at, lambda i: F.get(s, i)["i"]))

        def covered(p: Column) -> Column:
            gaps = F.transform(p, lambda x, i: F.least(F.lit(3), F.coalesce(F.get(p, i + 1) - x, F.lit(3))))
            return F.aggregate(gaps, F.lit(0).cast("long"), lambda a, x: a + x)

        return F.when(F.size(F.array_distinct(keys)) == F.size(keys), F.lit(0).cast("long")).otherwise(bound(bound(order, again), covered))

    return F.when(third < 2, F.lit(0).cast("long")).otherwise(bound(keys, places))


def caption_metrics(frames: DataFrame, caption: str = "caption") -> DataFrame:
    """``frames`` with counts over the whole caption, all bigint; existing columns of these names are replaced.

    ``n_words`` (words are runs without ASCII white space), ``word_chars`` (code points in words), ``n_symbols`` (``#*$%&|<>``),
    ``n_dup_lines`` (lines with a word that equal an earlier line), ``n_repeat_words`` (words inside three-word windows that
    occur twice or more, the first occurrence included), ``n_upper`` (upper-case letters), ``n_shouts`` (``!`` and ``?``).
    A null or empty caption has 0 everywhere. Windows are told apart by 64-bit hashes. Everything is worked out inside the
    row: nothing is shuffled.
    """
    names = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_upper", "n_shouts")
    text = F.coalesce(F.col(caption), F.lit(""))
    words = F.array_remove(F.split(text, WORD_GAP), "")
    lines = F.filter(F.split(text, "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))

    def counts(w: Column) -> Column:
        return F.struct(F.size(w).cast("long").alias("n_words"), F.length(F.array_join(w, "")).cast("long").alias("word_chars"), _repeat_words(w).alias("n_repeat_words"))

    out = frames.drop(*names).withColumn("_counts", bound(words, counts)).withColumn("_dups", bound(lines, lambda x: F.size(x) - F.size(F.array_distinct(x))))
    many = lambda p: F.regexp_count(text, F.lit(p)).cast("long")
    return out.withColumns(
        {
            "n_words": F.col("_counts.n_words"),
            "word_chars": F.col("_counts.word_chars"),
            "n_symbols": many(r"[#*$%&|<>]"),
            "n_dup_lines": F.col("_dups").cast("long"),
            "n_repeat_words": F.col("_counts.n_repeat_words"),
            "n_upper": many(r"\p{Lu}"),
            "n_shouts": many(r"[!?]"),
        }
    ).drop("_counts", "_dups")


def caption_ratios() -> dict[str, Column]:
    """The measures that the rules are learnt on, from the columns of ``caption_metrics``."""
    words, chars = F.greatest(F.col("n_words"), F.lit(1)), F.greatest(F.col("word_chars"), F.lit(1))
    return {
        "word_length": F.col("word_chars") / words,
        "symbol_share": F.col("n_symbols") / words,
        "repeat_share": F.col("n_repeat_words") / words,
        "dup_lines": F.col("n_dup_lines").cast("double"),
        "upper_share": F.col("n_upper") / chars,
        "shout_share": F.col("n_shouts") / words,
    }


@dataclass(frozen=True)
class Threshold:
    measure: str
    at_least: bool
    value: float

    def column(self, measures: Mapping[str, Column]) -> Column:
        m = measures[self.measure]
        return F.coalesce(m >= self.value if self.at_least else m < self.value, F.lit(False))


@dataclass(frozen=True)
class DecisionList:
    """Ordered rejecting rules; the last entry keeps. ``text()`` prints them, ``verdict`` is the Spark expression."""

    rules: tuple[tuple[Threshold, ...], ...]

    def rule_number(self, measures: Mapping[str, Column]) -> Column:
        """Number of the first rule that fires, from 1; null if none does."""
        out = None
        for k, rule in enumerate(self.rules, 1):
            fires = rule[0].column(measures)
            for t in rule[1:]:
                fires = fires & t.column(measures)
            out = F.when(fires, k) if out is None else out.when(fires, k)
        return F.lit(None).cast("int") if out is None else out.cast("int")

    def verdict(self, measures: Mapping[str, Column]) -> Column:
        """True to keep the frame."""
        return self.rule_number(measures).isNull()

    def text(self) -> str:
        say = lambda t: f"{t.measure} {'>=' if t.at_least else '<'} {t.value:g}"
        return "".join(f"reject if {' and '.join(map(say, r))}\n" for r in self.rules) + "else keep"


def fit_decision_list(
    frames: DataFrame, measures: Mapping[str, Column], accepted: str = "accepted", bins: int = 48, max_literals: int = 3, max_rules: int = 12, precision: float = 0.95, least: int = 3
) -> DecisionList:
    """Learn rejecting rules from all labelled frames (``accepted`` 0 or 1; null: left out).

    Sequential covering: a rule grows by the threshold of highest information gain on two thirds of the frames, is pruned
    back to the prefix that does best on the other third, and its frames are set aside before the next rule. Thresholds
    are at most ``bins`` + 2 quantiles per measure, half of them among rejected and half among accepted frames. A rule is taken if it rejects at least ``least`` frames, at most a share
    of 1 - ``precision`` of them wrongly (also among the frames held out for pruning); else
    its first threshold's measure and direction are passed over until the next rule is found. Frames are reduced to counts by
    (bins of all measures, label) once; each step is an aggregate over those that returns ``measures x bins`` rows.
    Without labels, or with one kind of label, the list is empty and keeps everything. Null measures meet no threshold.
    """
    names = list(measures)
    rows = frames.filter(F.col(accepted).isNotNull()).select((F.col(accepted) == 0).alias("bad"), *[measures[m].alias(m) for m in names])
    rows = cut(rows.withColumn("hold", F.pmod(F.xxhash64(*names), F.lit(3)) == 0))
    share = F.array(*[F.lit(2 * k / bins) for k in range(1, bins // 2)], F.lit(1 - 1 / bins), F.lit(1 - 0.25 / bins))
    first = rows.agg(
        *[F.percentile_approx(F.when(F.col("bad") == bad, F.col(m)), share, 20_000).alias(f"{m}_{bad}") for m in names for bad in (True, False)], *[F.min(m).alias(f"{m}_low") for m in names]
    ).first()
    edges = {m: sorted({float(x) for bad in (True, False) for x in first[f"{m}_{bad}"] or []} - {first[f"{m}_low"]}) for m in names}

    def place(m: str) -> Column:
        return F.size(F.filter(F.array(*[F.lit(x) for x in edges[m]]), lambda e: F.col(m) >= e)) if edges[m] else F.lit(0)

    table = cut(rows.select("bad", "hold", *[F.when(F.col(m).isNotNull(), place(m)).alias(m) for m in names]).groupBy("bad", "hold", *names).agg(F.count("*").alias("n")))

    def fires(literals: list[tuple[str, bool, int]]) -> Column:
        out = F.lit(True)
        for m, up, k in literals:
            out = out & F.coalesce(F.col(m) > k if up else F.col(m) <= k, F.lit(False))
        return out

    def tally(where: Column) -> dict[str, dict[int | None, tuple[int, int]]]:
        """Rejected and accepted frames of the growing part, by measure and bin."""
        long = table.filter(where & ~F.col("hold")).select("bad", "n", F.explode(F.array(*[F.struct(F.lit(m).alias("m"), F.col(m).alias("k")) for m in names])).alias("x"))
        got: dict = {m: {} for m in names}
        for r in long.groupBy("x.m", "x.k").agg(F.sum(F.when(F.col("bad"), F.col("n")).otherwise(0)).alias("b"), F.sum(F.when(F.col("bad"), 0).otherwise(F.col("n"))).alias("g")).collect():
            got[r.m][r.k] = (r.b, r.g)
        return got

    def worth(where: Column, literals: list[tuple[str, bool, int]]) -> list[tuple[int, int, int, int]]:
        """(rejected, accepted, rejected held out, accepted held out) of each beginning of a rule."""
        parts = [F.coalesce(F.sum(F.when(fires(literals[:k]) & (F.col("bad") == bad) & (F.lit(every) | F.col("hold")), F.col("n"))), F.lit(0)) for k in range(1, len(literals) + 1) for every in (True, False) for bad in (True, False)]
        r = table.filter(where).agg(*[c.alias(f"c{i}") for i, c in enumerate(parts)]).first()
        return [tuple(r[i : i + 4]) for i in range(0, len(parts), 4)]

    rules: list[tuple[Threshold, ...]] = []
    left = F.lit(True)
    passed: set[tuple[str, bool]] = set()
    whole = None
    while len(rules) < max_rules and len(passed) < 2 * len(names):
        literals: list[tuple[str, bool, int]] = []
        whole = whole or tally(left)
        seen = whole
        b0, g0 = (sum(x[i] for x in seen[names[0]].values()) for i in (0, 1))
        while b0 and g0:
            best = None
            for m in names:
                for k in range(len(edges[m])):
                    for up in (True, False):
                        b = sum(x[0] for j, x in seen[m].items() if j is not None and (j > k) == up)
                        g = sum(x[1] for j, x in seen[m].items() if j is not None and (j > k) == up)
                        if b and (literals or (m, up) not in passed):
                            gain = b * (math.log2((b + 0.1) / (b + g + 1)) - math.log2((b0 + 0.1) / (b0 + g0 + 1)))
                            if best is None or gain > best[0]:
                                best = (gain, (m, up, k), b, g)
            if best is None or best[0] <= 1e-9:
                break
            literals.append(best[1])
            b0, g0 = best[2], best[3]
            if len(literals) == max_literals or not g0:
                break
            seen = tally(left & fires(literals))
        if not literals:
            break
        counts = worth(left, literals)
        keep = max(range(len(counts)), key=lambda i: ((counts[i][2] - counts[i][3]) / max(counts[i][2] + counts[i][3], 1), counts[i][2], -i))
        b, g, hb, hg = counts[keep]
        literals = literals[: keep + 1]
        if b < least or b < precision * (b + g) or hb < precision * (hb + hg):
            passed.add(literals[0][:2])
            continue
        passed, whole = set(), None
        rules.append(tuple(Threshold(m, up, edges[m][k]) for m, up, k in literals))
        left = left & ~fires(literals)
    return DecisionList(tuple(rules))
