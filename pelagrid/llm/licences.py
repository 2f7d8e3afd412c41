"""Licence scans by sentence rules, in SQL functions only.

Texts are normalised to lower-case words of letters and digits; line ends and the ends of
sentences stay as bounds. A known sentence, in a fixed table, is found where its words stand
between two bounds, whatever bounds lie inside: so a notice may be a line without a full stop, hold
full stops, colons or semicolons, be wrapped over lines, and be indented or marked as a comment.
An SPDX tag is a sentence form of its own, whose expression may name several licences. The
identifiers found, in text order, are then matched against ordered rules: a rule is a sequence
of identifiers that must all appear in that order. The rule with the smallest rank among those that match
gives the licence and its kind; further matching rules are listed too.

The table is fixed and small (one pattern and a map literal), so no join is needed and texts are
not shuffled. Texts without any of the marks that every known sentence has are not normalised.

Defined results: null and empty texts have no licence (null), no identifiers; repeated
rows give repeated rows; of rules with equal rank the first in the table wins; of sentences that
begin at one place the longest counts, and none begins inside another. Extra columns are ignored.
"""

from __future__ import annotations

import operator
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Sentences of well-known licences and notices, by identifier.
SENTENCES: dict[str, tuple[str, ...]] = {
    "mit-name": ("Released under the MIT License", "Licensed under the MIT License", "The MIT License (MIT)", "MIT License"),
    "mit-grant": (
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
        "documentation files (the \"Software\"), to deal in the Software without restriction, including without "
        "limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the "
        "Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions",
    ),
    "mit-notice": (
        "The above copyright notice and this permission notice shall be included in all copies or substantial portions "
        "of the Software",
    ),
    "as-is": (
        "The software is provided \"as is\", without warranty of any kind, express or implied, including but not limited "
        "to the warranties of merchantability, fitness for a particular purpose and noninfringement",
    ),
    "apache-name": (
        "Licensed under the Apache License, Version 2.0",
        "Licensed under the Apache License, Version 2.0 (the \"License\")",
        "Apache License, Version 2.0",
    ),
    "apache-comply": ("you may not use this file except in compliance with the License",),
    "apache-copy": ("You may obtain a copy of the License at",),
    "apache-as-is": (
        "Unless required by applicable law or agreed to in writing, software distributed under the License is distributed "
        "on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied",
    ),
    "gpl3-name": (
        "This work is licensed under the GNU General Public License, version 3",
        "Licensed under the GNU General Public License, version 3",
        "GNU General Public License version 3",
    ),
    "gpl-free": (
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General "
        "Public License as published by the Free Software Foundation, either version 3 of the License, or (at your "
        "option) any later version",
    ),
    "gpl2-free": (
        "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General "
        "Public License as published by the Free Software Foundation; either version 2 of the License, or (at your "
        "option) any later version",
    ),
    "lgpl-free": (
        "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser "
        "General Public License as published by the Free Software Foundation; either version 2.1 of the License, or (at "
        "your option) any later version",
    ),
    "agpl-free": (
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU Affero "
        "General Public License as published by the Free Software Foundation, either version 3 of the License, or (at "
        "your option) any later version",
    ),
    "gpl-hope": (
        "This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the "
        "implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE",
        "This library is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the "
        "implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE",
    ),
    "isc-grant": (
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby "
        "granted, provided that the above copyright notice and this permission notice appear in all copies",
    ),
    "unlicense": ("This is free and unencumbered software released into the public domain",),
    "bsd-grant": (
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that "
        "the following conditions are met",
    ),
    "bsd-source": (
        "Redistributions of source code must retain the above copyright notice, this list of conditions and the "
        "following disclaimer",
    ),
    "bsd-binary": (
        "Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the "
        "following disclaimer in the documentation and/or other materials provided with the distribution",
    ),
    "bsd-names": (
        "Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote "
        "products derived from this software without specific prior written permission",
    ),
    "mpl-name": (
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0",
    ),
    "cc-by": ("Licensed under CC BY 4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License"),
    "cc-by-sa": (
        "Licensed under CC BY-SA 4.0",
        "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License",
    ),
    "cc-by-nc": (
        "Licensed under CC BY-NC 4.0",
        "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License",
    ),
    "cc0": ("CC0 1.0 Universal", "Licensed under CC0 1.0"),
    "reserved": ("All rights reserved",),
}

# Licence names of SPDX expressions, by identifier.
SPDX: dict[str, tuple[str, ...]] = {
    "spdx-mit": ("MIT",),
    "spdx-apache": ("Apache-2.0",),
    "spdx-bsd3": ("BSD-3-Clause",),
    "spdx-bsd2": ("BSD-2-Clause",),
    "spdx-isc": ("ISC",),
    "spdx-gpl3": ("GPL-3.0", "GPL-3.0-only", "GPL-3.0-or-later"),
    "spdx-gpl2": ("GPL-2.0", "GPL-2.0-only", "GPL-2.0-or-later"),
    "spdx-lgpl3": ("LGPL-3.0", "LGPL-3.0-only", "LGPL-3.0-or-later"),
    "spdx-lgpl21": ("LGPL-2.1", "LGPL-2.1-only", "LGPL-2.1-or-later"),
    "spdx-agpl3": ("AGPL-3.0", "AGPL-3.0-only", "AGPL-3.0-or-later"),
    "spdx-mpl2": ("MPL-2.0",),
    "spdx-cc0": ("CC0-1.0",),
    "spdx-unlicense": ("Unlicense",),
}

# Ordered rules (licence, kind, identifiers in order). The rank is the place.
RULES: tuple[tuple[str, str, tuple[str, ...]], ...] = (
    ("MIT", "permissive", ("mit-grant", "mit-notice", "as-is")),
    ("Apache-2.0", "permissive", ("apache-name", "apache-comply", "apache-copy", "apache-as-is")),
    ("BSD-3-Clause", "permissive", ("bsd-grant", "bsd-source", "bsd-binary", "bsd-names")),
    ("BSD-2-Clause", "permissive", ("bsd-grant", "bsd-source", "bsd-binary")),
    ("ISC", "permissive", ("isc-grant",)),
    ("GPL-3.0-or-later", "copyleft", ("gpl-free", "gpl-hope")),
    ("GPL-2.0-or-later", "copyleft", ("gpl2-free", "gpl-hope")),
    ("LGPL-2.1-or-later", "copyleft", ("lgpl-free", "gpl-hope")),
    ("AGPL-3.0-or-later", "copyleft", ("agpl-free", "gpl-hope")),
    ("MIT", "permissive", ("spdx-mit",)),
    ("Apache-2.0", "permissive", ("spdx-apache",)),
    ("GPL-3.0", "copyleft", ("spdx-gpl3",)),
    ("GPL-2.0", "copyleft", ("spdx-gpl2",)),
    ("BSD-3-Clause", "permissive", ("spdx-bsd3",)),
    ("BSD-2-Clause", "permissive", ("spdx-bsd2",)),
    ("ISC", "permissive", ("spdx-isc",)),
    ("LGPL-3.0", "copyleft", ("spdx-lgpl3",)),
    ("LGPL-2.1", "copyleft", ("spdx-lgpl21",)),
    ("AGPL-3.0", "copyleft", ("spdx-agpl3",)),
    ("MPL-2.0", "copyleft", ("spdx-mpl2",)),
    ("CC0-1.0", "permissive", ("spdx-cc0",)),
    ("Unlicense", "permissive", ("spdx-unlicense",)),
    ("GPL-3.0", "copyleft", ("gpl3-name",)),
    ("MPL-2.0", "copyleft", ("mpl-name",)),
    ("CC-BY-NC-4.0", "noncommercial", ("cc-by-nc",)),
    ("CC-BY-SA-4.0", "copyleft", ("cc-by-sa",)),
    ("CC-BY-4.0", "permissive", ("cc-by",)),
    ("CC0-1.0", "permissive", ("cc0",)),
    ("Unlicense", "permissive", ("unlicense",)),
    ("Apache-2.0", "permissive", ("apache-name",)),
    ("MIT", "permissive", ("mit-name",)),
    ("Proprietary", "reserved", ("reserved",)),
)


def normal_words(sentence: str) -> str:
    """The normal form of a known sentence."""
    words = "".join(c if c.isascii() and c.isalnum() else " " for c in sentence.lower()).split()
    return " ".join(words)


def known() -> dict[str, str]:
    """Identifier of every known sentence in normal form."""
    return {normal_words(s): name for name, forms in SENTENCES.items() for s in forms}


def tagged() -> dict[str, str]:
    """Identifier of every licence name of an SPDX expression in normal form."""
    return {normal_words(s): name for name, forms in SPDX.items() for s in forms}


# A word that every known sentence has one of: texts without any hold no known sentence.
MARKS = ("licen", "permi", "copyright", "warrant", "redistribut", "reserved", "cc0", "unencumbered")
TAG = "spdx license identifier"

BOUND = "\x01"
_GAP = f"[ {BOUND}]"


def bounded(text: Column) -> Column:
    """Words with one space, or one bound where a line or sentence ends, between them; bounds at both ends."""
    cut = F.regexp_replace(F.lower(text), r"""\n|[.;:!?]["')\]]*(?=[ \t\n\f\r]|$)""", BOUND)
    words = F.regexp_replace(cut, f"[^a-z0-9{BOUND}]+", " ")
    ends = F.concat(F.lit(BOUND), words, F.lit(BOUND))
    return F.regexp_replace(ends, f" ?{BOUND}{_GAP}*", BOUND)


def _pattern() -> str:
    forms = sorted(known(), key=lambda x: (-len(x.split()), x))
    wrapped = [x.replace(" ", _GAP) for x in [*forms, f"{TAG} "]]
    return f"{BOUND}({'|'.join(wrapped)}[a-z0-9 ]+)(?={BOUND})"


def _lookup(table: dict[str, str], words: Column) -> Column:
    return F.try_element_at(F.create_map(*[F.lit(x) for pair in table.items() for x in pair]), words)


def sentence_ids(text: Column) -> Column:
    """Identifiers of the known sentences of a text, in order; of an SPDX expression those of all its names."""
    found = F.regexp_extract_all(bounded(text), F.lit(_pattern()), F.lit(1))

    def identified(sentence):
        words = F.translate(sentence, BOUND, " ")
        names = F.split(F.substring(words, len(TAG) + 2, 1 << 30), " (?:and|or(?! later)|with) ")
        return F.when(words.startswith(TAG + " "), F.transform(names, lambda x: _lookup(tagged(), F.trim(x)))).otherwise(
            F.array(_lookup(known(), words))
        )

    ids = F.filter(F.flatten(F.transform(found, identified)), lambda x: x.isNotNull())
    marked = reduce(operator.or_, [F.lower(text).contains(mark) for mark in MARKS])
    return F.when(marked, ids).otherwise(F.array().cast("array<string>"))


def _in_order(ids: Column, rule: tuple[str, ...]) -> Column:
    """Whether all identifiers of the rule appear in this order."""
    line = F.concat(F.lit(" "), F.array_join(ids, "  "), F.lit(" "))
    return line.rlike(".*".join(f" {x} " for x in rule))


def scan(documents: DataFrame) -> DataFrame:
    """doc_id, sentence_ids, licence, kind and all matching licences for every row."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    found = documents.select("doc_id", sentence_ids(text).alias("sentence_ids"))
    hits = F.filter(
        F.array(
            *[
                F.when(_in_order(F.col("sentence_ids"), ids), F.struct(F.lit(name).alias("licence"), F.lit(kind).alias("kind")))
                for name, kind, ids in RULES
            ]
        ),
        lambda x: x.isNotNull(),
    )
    # Most texts have no identifier and try no rule.
    listed = found.withColumn("hits", F.when(F.size("sentence_ids") > 0, hits))
    first = F.get("hits", F.lit(0))
    names = F.array_distinct(F.transform("hits", lambda x: x["licence"]))
    return listed.select(
        "doc_id",
        F.array_join("sentence_ids", ",").alias("sentence_ids"),
        first["licence"].alias("licence"),
        first["kind"].alias("kind"),
        F.coalesce(F.array_join(names, ","), F.lit("")).alias("licences"),
    )
