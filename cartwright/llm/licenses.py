"""Licence scan by sentence recognition.

A text is cut into sentences at line ends and at stops that are followed by
white space. A normalised sentence (small letters, other characters as single
spaces, so comment marks go; list marks of a line go too) is looked up in a table
of known licence sentences, which gives its identifier. A sentence may also run
over several lines of a paragraph, from the start of one to the end of another:
hard-wrapped texts have theirs like that. What is left of a text is the short sequence of identifiers, in
order. A rule is an ordered list of identifiers; it matches where they follow
each other in the sequence, with at most ``GAP`` other known sentences between
neighbours. Of two rules, the longer one claims its sentences first.

One pass of column expressions per document: nothing is shuffled, and both
tables are constants of the plan.

Defined results: a null or empty text has no sentence and no licence; repeated
rows are scanned alike; an empty table gives an empty result; other columns pass
through :func:`scan`, whatever their names. A licence sentence counts wherever
it stands as a sentence of its own, also when it ends the text without a stop.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .words import bind, packed

GAP = 2

# Sentences of public licences and licence notices, by identifier.
SENTENCES: dict[str, tuple[str, ...]] = {
    "mit-short": (
        "Released under the MIT License", "Licensed under the MIT License", "This project is licensed under the MIT License",
        "This software is released under the MIT License", "The MIT License (MIT)", "MIT License",
    ),
    "mit-grant": (
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
        "documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation "
        "the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to "
        "permit persons to whom the Software is furnished to do so, subject to the following conditions:",
    ),
    "mit-notice": (
        "The above copyright notice and this permission notice shall be included in all copies or substantial portions of "
        "the Software",
    ),
    "isc-grant": (
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby "
        "granted, provided that the above copyright notice and this permission notice appear in all copies",
    ),
    "apache-short": (
        "Licensed under the Apache License, Version 2.0", "Released under the Apache License, Version 2.0",
        "Licensed under the Apache License, Version 2.0 (the \"License\")", "Apache License, Version 2.0",
    ),
    "apache-use": (
        "you may not use this file except in compliance with the License",
        "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance "
        "with the License",
    ),
    "apache-obtain": ("You may obtain a copy of the License at",),
    "bsd-grant": (
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the "
        "following conditions are met:",
    ),
    "bsd-source": (
        "Redistributions of source code must retain the above copyright notice, this list of conditions and the following "
        "disclaimer",
    ),
    "bsd-binary": (
        "Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following "
        "disclaimer in the documentation and/or other materials provided with the distribution",
    ),
    "bsd-name": (
        "Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote "
        "products derived from this software without specific prior written permission",
    ),
    "gpl3-short": (
        "This work is licensed under the GNU General Public License, version 3",
        "This program is licensed under the GNU General Public License, version 3",
        "Licensed under the GNU General Public License, version 3",
    ),
    "gpl-free": (
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public "
        "License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any "
        "later version",
    ),
    "gpl-hope": (
        "This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied "
        "warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE",
    ),
    "mpl-short": (
        "This Source Code Form is subject to the terms of the Mozilla Public License, v",
        "Licensed under the Mozilla Public License, version 2.0",
    ),
    "ccby-short": (
        "Licensed under CC BY 4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License",
    ),
    "ccbysa-short": (
        "Licensed under CC BY-SA 4.0",
        "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License",
    ),
    "ccbync-short": (
        "Licensed under CC BY-NC 4.0",
        "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License",
    ),
    "cc0-short": ("This work is released under CC0 1.0", "To the extent possible under law, the author has waived all "
                  "copyright and related or neighboring rights to this work"),
    "gpl2-short": (
        "This program is licensed under the GNU General Public License, version 2",
        "Licensed under the GNU General Public License, version 2",
    ),
    "gpl2-free": (
        "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public "
        "License as published by the Free Software Foundation; either version 2 of the License, or (at your option) any "
        "later version",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public "
        "License version 2 as published by the Free Software Foundation",
    ),
    "lgpl3-short": ("Licensed under the GNU Lesser General Public License, version 3",),
    "lgpl3-free": (
        "This library is free software: you can redistribute it and/or modify it under the terms of the GNU Lesser General "
        "Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) "
        "any later version",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU Lesser General "
        "Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) "
        "any later version",
    ),
    "lgpl21-free": (
        "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General "
        "Public License as published by the Free Software Foundation; either version 2.1 of the License, or (at your option) "
        "any later version",
    ),
    "agpl3-short": ("Licensed under the GNU Affero General Public License, version 3",),
    "agpl3-free": (
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU Affero General "
        "Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) "
        "any later version",
    ),
    "unlicense-free": ("This is free and unencumbered software released into the public domain",),
}


@dataclass(frozen=True)
class Rule:
    """A licence and the sentences that state it, in order."""

    licence: str
    sentences: tuple[str, ...]


RULES = (
    Rule("MIT", ("mit-grant", "mit-notice")),
    Rule("MIT", ("mit-short",)),
    Rule("ISC", ("isc-grant",)),
    Rule("Apache-2.0", ("apache-short", "apache-use", "apache-obtain")),
    Rule("Apache-2.0", ("apache-use", "apache-obtain")),
    Rule("Apache-2.0", ("apache-short",)),
    Rule("BSD-3-Clause", ("bsd-grant", "bsd-source", "bsd-binary", "bsd-name")),
    Rule("BSD-2-Clause", ("bsd-grant", "bsd-source", "bsd-binary")),
    Rule("GPL-3.0", ("gpl-free", "gpl-hope")),
    Rule("GPL-3.0", ("gpl-free",)),
    Rule("GPL-3.0", ("gpl3-short",)),
    Rule("GPL-2.0", ("gpl2-free",)),
    Rule("GPL-2.0", ("gpl2-short",)),
    Rule("LGPL-3.0", ("lgpl3-free",)),
    Rule("LGPL-3.0", ("lgpl3-short",)),
    Rule("LGPL-2.1", ("lgpl21-free",)),
    Rule("AGPL-3.0", ("agpl3-free",)),
    Rule("AGPL-3.0", ("agpl3-short",)),
    Rule("Unlicense", ("unlicense-free",)),
    Rule("MPL-2.0", ("mpl-short",)),
    Rule("CC-BY-4.0", ("ccby-short",)),
    Rule("CC-BY-SA-4.0", ("ccbysa-short",)),
    Rule("CC-BY-NC-4.0", ("ccbync-short",)),
    Rule("CC0-1.0", ("cc0-short",)),
)

STOP = r"[.!?]+[\x20\x09-\x0D]+"
BREAK = r"\n+|[.!?]+[\x20\x09-\x0D]+"


def normal(sentence: str) -> str:
    """What :func:`normalised` makes of a sentence of the table."""
    kept = "".join(c if c.isascii() and c.isalnum() else " " for c in sentence.lower())
    return " ".join(kept.split())


def normalised(sentence: Column) -> Column:
    return F.btrim(F.regexp_replace(F.lower(sentence), "[^a-z0-9]+", " "))


# Normalised sentence -> identifier.
KNOWN = {normal(s): name for name, variants in SENTENCES.items() for s in variants}
LONGEST = max(map(len, KNOWN))
# A known sentence has at least this word in it; other sentences are not normalised.
CUES = r"(?i)licens|permi|redistribut|contributors|copyright|warrant|CC0|CC BY|public domain"
# Line ends of a normalised paragraph; an empty line leaves two of them.
EDGE = "|"
MARK = r"(?m)^[^\S\n]*(?:(?i:dnl|rem)\b)?[^A-Za-z0-9\n]*(?:(?:[0-9]{1,2}|[A-Za-z]|[ivx]{1,4})\)[^\S\n])?"


def wrapped(sentence: str) -> str:
    """A pattern for a normalised sentence, on one line or over several."""
    return sentence.replace(" ", f"[ {EDGE}]")


def known_lines() -> str:
    """A pattern for a known sentence that fills whole lines, the longest one that starts there.

    A line that is a sentence of its own, followed by the rest of the longer one as another, stays one.
    """
    ends = rf"(?=[{EDGE}]|$)"
    halves = [
        rf"{wrapped(s)}(?=[{EDGE}]{wrapped(k[len(s) + 1:])}(?:[{EDGE}]|$))"
        for k in KNOWN for s in KNOWN if k.startswith(s + " ") and k[len(s) + 1:] in KNOWN]
    longest = [wrapped(k) + ends for k in sorted(KNOWN, key=len, reverse=True)]
    return rf"(?:^|(?<=[{EDGE}]))(?:{'|'.join(halves + longest)})"


LINES = known_lines()


def identifiers(text: Column) -> Column:
    """The known sentences of a text, as identifiers in order."""
    sentences = F.filter(F.split(text, STOP, -1), lambda s: F.rlike(s, F.lit(CUES)))
    names = F.create_map(*[F.lit(x) for pair in KNOWN.items() for x in pair])

    def lines(sentence: Column) -> Column:
        marked = F.regexp_replace(F.regexp_replace(F.lower(sentence), MARK, ""), "[^a-z0-9\n]+", " ")
        return F.regexp_replace(F.btrim(marked, F.lit(" \n")), " ?\n ?", EDGE)

    known = F.flatten(F.transform(sentences, lambda s: F.regexp_extract_all(lines(s), F.lit(LINES), F.lit(0))))
    found = F.transform(known, lambda s: F.element_at(names, F.translate(s, EDGE, " ")))
    return F.when(F.rlike(text, F.lit(CUES)), found).otherwise(F.array().cast("array<string>"))


def pattern(rule: Rule) -> str:
    """A rule over the sequence written as ``<id><id>``; what lies between two of its sentences is a group."""
    return ("((?:<[a-z0-9-]+>){0,%d}?)" % GAP).join(f"<{s}>" for s in rule.sentences)


def remainder(rule: Rule) -> str:
    """What stays of a match: the groups."""
    return "".join(f"${i}" for i in range(1, len(rule.sentences)))


# Longer rules first; the order of RULES decides between equals.
ORDER = sorted(RULES, key=lambda r: -len(r.sentences))


def licences(ids: Column) -> Column:
    """Licences of the rules that match, each once, longer rules first.

    The sentences of a match are struck out of the sequence, so a shorter rule
    only sees what the longer ones before it left.
    """

    def strike(state: Column, rule: Rule) -> Column:
        return bind(state, lambda s: F.when(
            F.rlike(s.left, F.lit(pattern(rule))),
            F.struct(F.regexp_replace(s.left, pattern(rule), remainder(rule)).alias("left"),
                     F.array_append(s.found, F.lit(rule.licence)).alias("found")),
        ).otherwise(s))

    left = F.array_join(F.transform(ids, lambda i: F.concat(F.lit("<"), i, F.lit(">"))), "")
    state = F.struct(left.alias("left"), F.array().cast("array<string>").alias("found"))
    for rule in ORDER:
        state = strike(state, rule)
    return F.array_distinct(state.found)


def scan(docs: DataFrame) -> DataFrame:
    """``row`` (the document's columns), ``sentences`` (identifiers) and ``licences``."""
    texts = packed(docs).select("row", identifiers(F.coalesce(F.col("row.text").cast("string"), F.lit(""))).alias("sentences"))
    none = F.array().cast("array<string>")
    return texts.select("*", F.when(F.size("sentences") > 0, licences(F.col("sentences"))).otherwise(none).alias("licences"))


def report(docs: DataFrame) -> DataFrame:
    """Per document: known licence sentences, in order, and the licences they state."""
    return scan(docs).select(
        F.col("row.doc_id").alias("doc_id"),
        F.size("sentences").cast("bigint").alias("n_sentences"),
        F.array_join("sentences", ",").alias("sentences"),
        F.array_join("licences", ",").alias("licences"),
    )
