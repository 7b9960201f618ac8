"""Licence scans of asset notes: sentences are mapped to known licence sentences, sequences of those to licences."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Parts of the forms below.
_UNDER = r"(?:this (?:work|software|project|code|file|program|document|dataset) is )?(?:released|licensed|distributed|available|provided) under (?:the |a )?(?:terms of the )?"
_GNU = r"(?:this (?:program|library) is free software )?you can redistribute it and/?or modify it under the terms of the gnu "
_LATER = r"(?: or (?:\(at your option\) )?(?:any )?later(?: version)?)?"
_CC, _CC_VERSION = r"(?:cc|creative commons) ", r"(?: [234](?:\.[05])?)?(?: international| unported| generic)?(?: public)?(?: licen[sc]e)?"

# A sentence's number, its text in normal form (lower case, letters, digits and dots between digits, one
# space) as a regular expression that the whole sentence must match.
SENTENCES: tuple[tuple[int, str], ...] = (
    (1, _UNDER + r"mit licen[sc]e"),
    (2, r"(?:the )?mit licen[sc]e(?: mit)?"),
    (3, r"permission is hereby granted free of charge to any person obtaining a copy of this software .*"),
    (4, r"the above copyright notice and this permission notice shall be included in all copies or substantial portions of the software"),
    (5, r"the software is provided as is without warranty of any kind .*"),
    (10, _UNDER + r"apache licen[sc]e(?: version)? 2(?:\.0)?(?: \(? ?the licen[sc]e ?\)?)?"),
    (11, r"apache licen[sc]e(?: version)? 2(?:\.0)?(?: january 2004)?(?: .*licenses.*)?"),
    (12, r"you may not use this file except in compliance with the licen[sc]e"),
    (13, r"you may obtain a copy of the licen[sc]e at .*apache org.*|you may obtain a copy of the licen[sc]e at"),
    (14, r"unless required by applicable law or agreed to in writing software distributed under the licen[sc]e is distributed on an as is basis .*"),
    (20, _UNDER + r"gnu general public licen[sc]e(?: version)? (?:v)?3(?:\.0)?" + _LATER),
    (23, _UNDER + r"gnu general public licen[sc]e(?: version)? (?:v)?2(?:\.0)?" + _LATER),
    (24, _UNDER + r"gnu general public licen[sc]e(?: version)? (?:v)?1(?:\.0)?" + _LATER),
    (21, r"gnu general public licen[sc]e(?: version)? (?:v)?3(?:\.0)?(?: .*)?"),
    (25, r"gnu general public licen[sc]e(?: version)? (?:v)?2(?:\.0)?(?: .*)?"),
    (26, r"gnu general public licen[sc]e(?: version)? (?:v)?1(?:\.0)?(?: .*)?"),
    (27, _GNU + r"general public licen[sc]e .* version 3(?:\.0)? of the licen[sc]e.*"),
    (28, _GNU + r"general public licen[sc]e .* version 2(?:\.0)? of the licen[sc]e.*"),
    (29, _GNU + r"general public licen[sc]e .* version 1(?:\.0)? of the licen[sc]e.*"),
    (22, _GNU + r"general public licen[sc]e .*"),
    (60, _UNDER + r"gnu (?:lesser|library) general public licen[sc]e(?: version)? (?:v)?3(?:\.0)?" + _LATER),
    (61, _UNDER + r"gnu (?:lesser|library) general public licen[sc]e(?: version)? (?:v)?2\.1" + _LATER),
    (62, _UNDER + r"gnu (?:lesser|library) general public licen[sc]e(?: version)? (?:v)?2(?:\.0)?" + _LATER),
    (63, _GNU + r"(?:lesser|library) general public licen[sc]e .* version 3(?:\.0)? of the licen[sc]e.*"),
    (64, _GNU + r"(?:lesser|library) general public licen[sc]e .* version 2\.1 of the licen[sc]e.*"),
    (65, _GNU + r"(?:lesser|library) general public licen[sc]e .* version 2(?:\.0)? of the licen[sc]e.*"),
    (66, _UNDER + r"gnu affero general public licen[sc]e(?: version)? (?:v)?3(?:\.0)?" + _LATER),
    (67, _GNU + r"affero general public licen[sc]e .* version 3(?:\.0)? of the licen[sc]e.*"),
    (30, _UNDER + _CC + r"(?:by nc|attribution non ?commercial)" + _CC_VERSION),
    (31, _UNDER + _CC + r"(?:by|attribution)" + _CC_VERSION),
    (32, _UNDER + _CC + r"(?:by sa|attribution share ?alike)" + _CC_VERSION),
    (34, _UNDER + _CC + r"(?:by nc sa|attribution non ?commercial share ?alike)" + _CC_VERSION),
    (35, _UNDER + _CC + r"(?:by nd|attribution no ?deriv(?:ative)?s)" + _CC_VERSION),
    (36, _UNDER + _CC + r"(?:by nc nd|attribution non ?commercial no ?deriv(?:ative)?s)" + _CC_VERSION),
    (33, r"(?:this (?:work|software|project|code|file|program|document|dataset) is )?(?:released|dedicated|available) (?:under|to) (?:the )?(?:cc0|public domain)(?: 1\.0)?.*"),
    (40, _UNDER + r"(?:new |modified |simplified )?bsd (?:[23] clause )?licen[sc]e"),
    (41, r"redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met"),
    (42, r"neither the name of .* nor the names of its contributors may be used to endorse or promote products derived from this software .*"),
    (43, r"this software is provided by the copyright holders and contributors as is .*"),
    (50, r"(?:all rights reserved|copyright .* all rights reserved)"),
    (51, r"spdx mit"),
    (52, r"spdx apache 2\.0"),
    (53, r"spdx gpl 3\.0(?: only)?"),
    (54, r"spdx gpl 2\.0(?: only)?"),
    (55, r"spdx gpl 1\.0(?: only)?"),
    (56, r"spdx lgpl 3\.0(?: only)?"),
    (57, r"spdx lgpl 2\.1(?: only)?"),
    (58, r"spdx lgpl 2\.0(?: only)?"),
    (59, r"spdx agpl 3\.0(?: only)?"),
    (70, r"this source code form is subject to the terms of the mozilla public licen[sc]e(?: version| v)?(?: 2(?:\.0)?)?"),
    (71, _UNDER + r"mozilla public licen[sc]e(?: version)? (?:v ?)?2(?:\.0)?"),
    (72, r"permission to use copy modify and/?or distribute this software for any purpose with or without fee is hereby granted provided that the above copyright notice and this permission notice appear in all copies"),
    (73, r"the software is provided as is and the author disclaims all warranties .*"),
    (74, _UNDER + r"isc licen[sc]e"),
    (75, r"(?:the )?isc licen[sc]e(?: isc)?"),
    (80, r"spdx mpl 2\.0"),
    (81, r"spdx isc"),
    (82, r"spdx bsd 3 clause"),
    (83, r"spdx bsd 2 clause"),
    (84, r"spdx cc by [234]\.[05]"),
    (85, r"spdx cc by sa [234]\.[05]"),
    (86, r"spdx cc by nc [234]\.[05]"),
    (87, r"spdx cc by nc sa [234]\.[05]"),
    (88, r"spdx cc by nd [234]\.[05]"),
    (89, r"spdx cc by nc nd [234]\.[05]"),
    (90, r"spdx cc0 1\.0"),
)
#: Every known sentence holds one of these words, so that other sentences need no matching. Single words, as line ends may part others.
HINTS = r"licen[sc]e|permission|copyright|redistribut|warranty|contributors|reserved|public|creative|\bcc|spdx|disclaims"


@dataclass(frozen=True)
class LicenceRule:
    """``sentences`` must occur in this order, other known sentences between them allowed; earlier rules take their sentences."""

    licence: str
    sentences: tuple[int, ...]


# The most telling sequences come first.
_TELLING: tuple[LicenceRule, ...] = (
    LicenceRule("MIT", (2, 3, 4, 5)), LicenceRule("MIT", (3, 4, 5)), LicenceRule("Apache-2.0", (10, 12, 13, 14)), LicenceRule("Apache-2.0", (12, 13, 14)),
    LicenceRule("BSD-3-Clause", (41, 42, 43)), LicenceRule("BSD-2-Clause", (41, 43)), LicenceRule("ISC", (75, 72, 73)), LicenceRule("ISC", (72, 73)),
    LicenceRule("MIT", (1,)), LicenceRule("MIT", (51,)), LicenceRule("MIT", (2,)), LicenceRule("Apache-2.0", (10,)), LicenceRule("Apache-2.0", (52,)), LicenceRule("Apache-2.0", (11,)),
    *(LicenceRule(f"GPL-{v}.0", (n,)) for v, own in ((3, (20, 53, 27, 21)), (2, (23, 54, 28, 25)), (1, (24, 55, 29, 26))) for n in own), LicenceRule("GPL", (22,)),
    *(LicenceRule(f"LGPL-{v}", (n,)) for v, own in (("3.0", (60, 63, 56)), ("2.1", (61, 64, 57)), ("2.0", (62, 65, 58))) for n in own),
    *(LicenceRule("AGPL-3.0", (n,)) for n in (66, 67, 59)), *(LicenceRule("MPL-2.0", (n,)) for n in (70, 71, 80)), *(LicenceRule("ISC", (n,)) for n in (74, 81, 75)), LicenceRule("BSD-3-Clause", (82,)), LicenceRule("BSD-2-Clause", (83,)),
    *(LicenceRule(f"CC-{kind}", (n,)) for kind, own in (("BY-NC-SA", (34, 87)), ("BY-NC-ND", (36, 89)), ("BY-ND", (35, 88)), ("BY-NC", (30, 86)), ("BY-SA", (32, 85)), ("BY", (31, 84))) for n in own),
    LicenceRule("public-domain", (33,)), LicenceRule("public-domain", (90,)), LicenceRule("BSD", (40,)),
)
#: "All rights reserved" at the head of a licence text belongs to it; only what no licence follows is a licence of its own.
RESERVED = 50
RULES: tuple[LicenceRule, ...] = (*(x for r in _TELLING for x in (LicenceRule(r.licence, (RESERVED, *r.sentences)), r)), LicenceRule("proprietary", (RESERVED,)))


def sentences(text: Column) -> Column:
    """Sentences of a whole text: cut at line ends and after ``.``, ``!``, ``?`` or ``;`` before white space."""
    return F.split(text, r"\R+|(?<=[.!?;])\s+")


#: Comment marks that stay in the normal form of a line: slashes that stand alone or before the first word.
SLASHES = (r"(^| )(/+ )*/+( |$)", r"^/+")
#: A line that names licences by their short identifiers, and what parts them.
SPDX, SPDX_PARTS = r"^spdx (?:licen[sc]e identifier )?", r" (?:or|and) "


def normalised(sentence: Column) -> Column:
    """Lower case; everything but letters, digits and dots between digits becomes one space. Comment marks go."""
    out = F.regexp_replace(F.regexp_replace(F.lower(sentence), r"(?<![0-9])\.|\.(?![0-9])", " "), r"[^\p{L}\p{N}./()]+", " ")
    return F.trim(F.regexp_replace(F.regexp_replace(F.trim(out), SLASHES[0], " "), SLASHES[1], ""))


def expressions(line: Column) -> Column:
    """A line in normal form as an array: one entry, or one for each part of an expression of short identifiers."""
    parts = F.split(F.regexp_replace(F.regexp_replace(line, SPDX, ""), r"[()]", ""), SPDX_PARTS)
    return F.when(line.rlike(SPDX), F.transform(parts, lambda x: F.concat(F.lit("spdx "), F.trim(x)))).otherwise(F.array(line))


def sentence_id(sentence: Column, known: Sequence[tuple[int, str]] = SENTENCES) -> Column:
    """Number of the known licence sentence that a normalised sentence is; null for any other."""
    out = F.lit(None).cast("int")
    for number, form in reversed(known):
        out = F.when(sentence.rlike(f"^(?:{form})$"), F.lit(number)).otherwise(out)
    return F.when(sentence.rlike(HINTS), out)


def units(text: Column) -> Column:
    """Sentences that may run over line ends: cut at lines without letters or digits and at sentence ends."""
    return F.split(text, r"\R(?:[^\p{L}\p{N}\r\n]*\R)+|(?<=[.!?;])\s+")


def unit_ids(unit: Column, known: Sequence[tuple[int, str]] = SENTENCES) -> Column:
    """Numbers of the known sentences of a unit, in text order.

    A line that is a known sentence by itself keeps its number. Then the lines between those are matched with a line end
    wherever a form has a space, from the start of a line to the end of one; ``.*`` takes as few lines as it can.
    """
    lines = F.flatten(F.transform(F.split(unit, r"\R+"), lambda s: expressions(normalised(s))))
    marked = F.concat_ws("\n", F.transform(lines, lambda s: F.coalesce(F.concat(F.lit("\x01"), sentence_id(s, known).cast("string"), F.lit("\x02")), s)))
    joined = marked
    for number, form in known:
        wrapped = form.replace(".*", r"[^\x01\x02]*?").replace(" ", r"[ \n]")
        joined = F.regexp_replace(joined, f"(?m)^(?:{wrapped})$", f"\x01{number}\x02")
    joined = F.when(F.size(lines) > 1, joined).otherwise(marked)
    return F.transform(F.regexp_extract_all(joined, F.lit(r"\x01(\d+)\x02"), 1), lambda x: x.cast("int"))


def _one_pass(ids: Column, rules: Sequence[LicenceRule]) -> Column:
    """Licences of the rules that fire, in the order of the rules; a rule takes the sentences that it needs."""
    state = F.struct(ids.alias("left"), F.array().cast("array<string>").alias("found"))
    steps = F.array(*[F.struct(F.lit(r.licence).alias("licence"), F.array(*[F.lit(x) for x in r.sentences]).alias("need")) for r in rules])

    def step(acc: Column, rule: Column) -> Column:
        # the longest beginning of the needed sentences that the remaining ids hold in order
        got = F.aggregate(acc["left"], F.lit(0), lambda n, x: F.when(F.get(rule["need"], n) == x, n + 1).otherwise(n))
        fires = got == F.size(rule["need"])
        return F.struct(
            F.when(fires, F.filter(acc["left"], lambda x: ~F.array_contains(rule["need"], x))).otherwise(acc["left"]).alias("left"),
            F.when(fires, F.array_append(acc["found"], rule["licence"])).otherwise(acc["found"]).alias("found"),
        )

    return F.array_distinct(F.aggregate(steps, state, step, lambda acc: acc["found"]))


def scan_notes(assets: DataFrame, notes: str = "notes", known: Sequence[tuple[int, str]] = SENTENCES, rules: Sequence[LicenceRule] = RULES) -> DataFrame:
    """``assets`` with ``n_sentences``, ``sentence_ids`` (in text order) and ``licences`` (in rule order, each once).

    A licence is found when all sentences of one of its rules occur in order; a sentence that a rule took is not used by
    later ones. Short identifiers joined by OR or AND count one by one. ``n_sentences`` counts line ends as sentence ends;
    known sentences may run over them and stand behind comment marks. Notes without a known sentence, empty ones and null have
    empty lists. Whole notes are read, inside the row: nothing is shuffled. Existing columns of these names are replaced.
    """
    # only units that hold a hint are put in normal form
    parts = F.filter(sentences(F.coalesce(F.col(notes), F.lit(""))), lambda s: F.trim(s) != "")
    hinted = F.filter(units(F.coalesce(F.col(notes), F.lit(""))), lambda s: s.rlike(f"(?i){HINTS}"))
    ids = F.flatten(F.transform(hinted, lambda s: unit_ids(s, known)))
    counted = assets.drop("n_sentences", "sentence_ids", "licences").withColumn("n_sentences", F.size(parts).cast("long")).withColumn("sentence_ids", ids)
    none = F.array().cast("array<string>")
    return counted.withColumn("licences", F.when(F.size("sentence_ids") > 0, _one_pass(F.col("sentence_ids"), rules)).otherwise(none))
