"""Licence recognition by sentences, with built-in expressions only.

A text is cut into pieces, the pieces are normalised, and runs of whole pieces that make up a known
licence sentence are looked up: notices are wrapped and have stops inside their sentences. The
identifiers found, in order, are then matched against ordered rules: a rule is a sequence of
identifiers that follow each other; what a rule has matched, no later rule matches again. The version
is the first number of the first sentence that a rule matches.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .components import unused_name

# Normalised sentences of licence notices and their identifiers. 0 is any number.
SENTENCES = {
    "licensed under cc by 0 0": "CcBy",
    "licensed under cc by sa 0 0": "CcBySa",
    "licensed under cc by nc 0 0": "CcByNc",
    "this work is licensed under the gnu general public license version 0": "Gpl",
    "this program is free software you can redistribute it and or modify it under the terms of the"
    " gnu general public license as published by the free software foundation either version 0 of"
    " the license or at your option any later version": "GplLater",
    "this program is distributed in the hope that it will be useful but without any warranty without"
    " even the implied warranty of merchantability or fitness for a particular purpose": "GplWarranty",
    "see the gnu general public license for more details": "GplSee",
    "licensed under the apache license version 0 0": "Apache",
    "licensed under the apache license version 0 0 the license": "ApacheNamed",
    "you may not use this file except in compliance with the license": "ApacheUse",
    "you may obtain a copy of the license at": "ApacheCopy",
    "see the license for the specific language governing permissions and limitations under the"
    " license": "ApacheSee",
    "released under the mit license": "Mit",
    "licensed under the mit license": "Mit",
    "permission is hereby granted free of charge to any person obtaining a copy of this software and"
    " associated documentation files the software to deal in the software without restriction"
    " including without limitation the rights to use copy modify merge publish distribute sublicense"
    " and or sell copies of the software and to permit persons to whom the software is furnished to"
    " do so subject to the following conditions": "MitGrant",
    "the above copyright notice and this permission notice shall be included in all copies or"
    " substantial portions of the software": "MitNotice",
    "redistribution and use in source and binary forms with or without modification are permitted"
    " provided that the following conditions are met": "BsdGrant",
    "redistributions of source code must retain the above copyright notice this list of conditions"
    " and the following disclaimer": "BsdSource",
    "redistributions in binary form must reproduce the above copyright notice this list of"
    " conditions and the following disclaimer in the documentation and or other materials provided"
    " with the distribution": "BsdBinary",
    "all rights reserved": "AllRights",
    "this source code form is subject to the terms of the mozilla public license v 0 0": "Mpl",
    "this program and the accompanying materials are made available under the terms of the eclipse"
    " public license 0 0 which is available at https www eclipse org legal epl 0 0": "Epl",
    "this program and the accompanying materials are made available under the terms of the eclipse"
    " public license v0 0 which accompanies this distribution and is available at http www eclipse org"
    " legal epl v0 html": "Epl",
    "to the extent possible under law the author s have dedicated all copyright and related and"
    " neighboring rights to this software to the public domain worldwide": "Cc0",
    "cc0 0 0 universal": "Cc0",
    "this is free and unencumbered software released into the public domain": "Unlicense",
}
_ENDORSE = (
    " may be used to endorse or promote products derived from this software without specific prior"
    " written permission"
)
SENTENCES |= {
    f"{start}nor the names of its contributors{_ENDORSE}": "BsdName"
    for start in ("", *(f"neither the name of the {holder} " for holder in ("copyright holder", "copyright holders", "university")))
}
SENTENCES |= {
    f"permission to use copy modify and {alternative}distribute this software for any purpose with or without fee is"
    " hereby granted provided that the above copyright notice and this permission notice appear in all"
    " copies": "IscGrant"
    for alternative in ("", "or ")
}
for _kind, _name in (("Lgpl", "lesser"), ("Agpl", "affero")):
    SENTENCES |= {
        f"this {work} is free software you can redistribute it and or modify it under the terms of the"
        f" gnu {_name} general public license as published by the free software foundation either"
        f" version {version} of the license or at your option any later version": f"{_kind}Later"
        for work in ("program", "library")
        for version in ("0", "0 0")
    }
    SENTENCES[f"see the gnu {_name} general public license for more details"] = f"{_kind}See"
SENTENCES[
    "this library is distributed in the hope that it will be useful but without any warranty without"
    " even the implied warranty of merchantability or fitness for a particular purpose"
] = "GplWarranty"
SENTENCES |= {
    f"{start} creative commons {kind} 0 0 international license": identifier
    for start in ("this work is licensed under a", "this work is licensed under the", "licensed under a", "licensed under the")
    for kind, identifier in (
        ("attribution", "CcBy"),
        ("attribution sharealike", "CcBySa"),
        ("attribution noncommercial", "CcByNc"),
    )
}
# Licence tags of one line, without the words before them.
TAGS = {
    "mit": "Mit",
    "apache 0 0": "Apache",
    "bsd 2 clause": "Bsd2",
    "bsd 3 clause": "Bsd3",
    "isc": "IscGrant",
    "mpl 0 0": "Mpl",
    "epl 0 0": "Epl",
    "cc0 0 0": "Cc0",
    "cc by 0 0": "CcBy",
    "cc by sa 0 0": "CcBySa",
    "cc by nc 0 0": "CcByNc",
    "unlicense": "Unlicense",
}
TAGS |= {
    f"{name.lower()} 0 0{form}": name + identifier
    for name in ("Gpl", "Lgpl", "Agpl")
    for form, identifier in (("", ""), (" only", "Only"), (" or later", "Later"))
}
SENTENCES |= {f"spdx license identifier {tag}": identifier for tag, identifier in TAGS.items()}

# Rules in the order they are tried, longer sequences first.
RULES = (
    ("BSD-3-Clause", ("BsdGrant", "BsdSource", "BsdBinary", "BsdName")),
    ("LGPL-or-later", ("LgplLater", "GplWarranty", "LgplSee")),
    ("AGPL-or-later", ("AgplLater", "GplWarranty", "AgplSee")),
    ("BSD-2-Clause", ("BsdGrant", "BsdSource", "BsdBinary")),
    ("GPL-or-later", ("GplLater", "GplWarranty", "GplSee")),
    ("Apache", ("ApacheNamed", "ApacheUse", "ApacheCopy", "ApacheSee")),
    ("MIT", ("MitGrant", "MitNotice")),
    ("Apache", ("ApacheNamed", "ApacheUse")),
    ("GPL-or-later", ("GplLater",)),
    ("LGPL-or-later", ("LgplLater",)),
    ("AGPL-or-later", ("AgplLater",)),
    ("MIT", ("MitGrant",)),
    ("ISC", ("IscGrant",)),
    ("MPL", ("Mpl",)),
    ("EPL", ("Epl",)),
    ("CC0", ("Cc0",)),
    ("Unlicense", ("Unlicense",)),
    ("MIT", ("Mit",)),
    ("Apache", ("Apache",)),
    ("Apache", ("ApacheNamed",)),
    ("GPL", ("Gpl",)),
    ("CC-BY-NC", ("CcByNc",)),
    ("CC-BY-SA", ("CcBySa",)),
    ("CC-BY", ("CcBy",)),
    ("LGPL", ("Lgpl",)),
    ("AGPL", ("Agpl",)),
    ("GPL-only", ("GplOnly",)),
    ("LGPL-only", ("LgplOnly",)),
    ("AGPL-only", ("AgplOnly",)),
    ("BSD-2-Clause", ("Bsd2",)),
    ("BSD-3-Clause", ("Bsd3",)),
)
# Licences whose names hold a number already; others take the version after the family's name.
UNVERSIONED = ("BSD-2-Clause", "BSD-3-Clause", "MIT", "ISC", "Unlicense")

# Two replacements put END where a sentence ends: at . ! ? : ; before white space, and at a line
# break unless the next line goes on with a small letter, as wrapped notices do.
END = "\x1f"
ENDS = ("[.!?:;]+([ \\t\\r\\n])", "\\n([^a-zA-Z\\n]*[A-Z\\n])")
# The line of a tag ends a sentence too, whatever follows.
TAG_LINE = "(SPDX-License-Identifier:[^\\n]*)\\n"
# The first number of a sentence, or first two in a row.
VERSION = "(?:^|[ |]|\\bv)([0-9]+(?:[ |]+[0-9]+)?)"


def rule_pattern(identifiers: tuple[str, ...]) -> str:
    """A rule over ``<identifier:version>`` marks; the group is the first one's version."""
    return "".join(
        f"<{name}:{'([0-9.]*)' if place == 0 else '[0-9.]*'}>" for place, name in enumerate(identifiers)
    )


def name_parts(licence: str) -> tuple[str, str] | None:
    """What stands before and after the version in a licence's name, None for one without versions."""
    if licence in UNVERSIONED:
        return None
    for ending in ("-or-later", "-only"):
        if licence.endswith(ending):
            return licence.removesuffix(ending) + "-", ending
    return licence + "-", ""


def _marked(cut: Column) -> Column:
    """Pieces in lower case, other characters than a-z and 0-9 as single blanks; a ``|``
    before and after each piece. Pieces without letters and digits leave nothing."""
    small = F.translate(cut, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    blanks = F.regexp_replace(small, f"[^a-z0-9{END}]+", " ")
    return F.regexp_replace(F.concat(F.lit(END), blanks, F.lit(END)), f" ?{END}[ {END}]*", "|")


def any_sentence(sentences: dict[str, str], between: str) -> str:
    """A pattern of the known sentences, longest first; ``between`` is what parts words."""
    longest = sorted(sentences, key=lambda sentence: (-len(sentence), sentence))
    return "|".join(sentence.replace("0", "[0-9]+").replace(" ", between) for sentence in longest)


def _runs(sentences: dict[str, str]) -> str:
    """The known sentences as runs of one or more whole pieces."""
    return r"(?<=\|)(?:" + any_sentence(sentences, "[ |]") + r")(?=\|)"


def _keywords(sentences: dict[str, str]) -> list[str]:
    """The longest word of each sentence: a text without any of them has no known sentence."""
    return sorted({max(sentence.split(), key=len) for sentence in sentences})


def _known(sentences: dict[str, str], sentence: Column) -> Column:
    table = F.create_map(*[F.lit(x) for pair in sentences.items() for x in pair])
    return F.coalesce(
        F.element_at(table, sentence), F.element_at(table, F.regexp_replace(sentence, "[0-9]+", "0"))
    )


def _naming(licence: str):
    """The name of a licence in a given version."""
    parts = name_parts(licence)

    def name(version: Column) -> Column:
        if parts is None:
            return F.lit(licence)
        with_version = F.concat(F.lit(parts[0]), version, F.lit(parts[1]))
        return F.when(version == "", F.lit(licence)).otherwise(with_version)

    return name


def licence_scan(
    docs: DataFrame,
    text: str = "text",
    sentences: dict[str, str] | None = None,
    rules: tuple[tuple[str, tuple[str, ...]], ...] = RULES,
) -> DataFrame:
    """Add to each row ``sentence_ids`` (known sentences in order), ``licenses`` (sorted, distinct),
    ``versioned`` (the same with the version in the name where one is given) and ``unmatched``
    (known sentences no rule has matched).

    Sentences begin and end at ``ENDS``, or at the ends of the text, and may hold more of them. Null and empty texts have empty lists and 0. Rows are scanned by themselves, so repeated rows stay; columns named as
    the results are replaced. No rows move between tasks, and the work of a text grows with its
    length only.

    A text is cut only if a first, cheap test finds a word in it that some known sentence has.
    """
    sentences = SENTENCES if sentences is None else sentences
    value = F.coalesce(F.col(text), F.lit(""))
    cut = F.concat(value, F.lit("\n\n"))
    cut = F.regexp_replace(cut, TAG_LINE, f"$1{END}\n")
    for pattern in ENDS:
        cut = F.regexp_replace(cut, pattern, END + "$1")
    found = F.transform(
        F.regexp_extract_all(_marked(cut), F.lit(_runs(sentences)), F.lit(0)),
        lambda run: F.struct(
            _known(sentences, F.translate(run, "|", " ")).alias("id"),
            F.translate(F.regexp_extract(run, VERSION, 1), " |", "..").alias("version"),
        ),
    )
    # Every known sentence has one of these words; most texts have none.
    keyword = value.rlike("(?i)" + "|".join(_keywords(sentences)))
    none = F.array().cast("array<struct<id:string,version:string>>")
    added = ("sentence_ids", "licenses", "versioned", "unmatched")
    others = [F.col(f"`{name}`") for name in docs.columns if name not in added]
    kept = unused_name(docs.columns, "_found")
    scanned = docs.select(*others, F.when(keyword, found).otherwise(none).alias(kept))

    marks = F.transform(kept, lambda s: F.concat(F.lit("<"), s["id"], F.lit(":"), s["version"], F.lit(">")))
    left: Column = F.concat_ws("", marks)
    matches, versioned = [], []
    for licence, identifiers in rules:
        pattern = rule_pattern(identifiers)
        versions = F.regexp_extract_all(left, F.lit(pattern), F.lit(1))
        matches.append(F.when(F.size(versions) > 0, F.lit(licence)))
        versioned.append(F.transform(versions, _naming(licence)))
        # A mark stays, so that sentences on both sides of a match do not become neighbours.
        left = F.regexp_replace(left, pattern, "|")
    licences = F.array_sort(F.array_distinct(F.array_compact(F.array(*matches))))
    return scanned.select(
        *others,
        F.transform(kept, lambda s: s["id"]).alias("sentence_ids"),
        licences.alias("licenses"),
        F.array_sort(F.array_distinct(F.flatten(F.array(*versioned)))).alias("versioned"),
        F.regexp_count(left, F.lit("<")).cast("int").alias("unmatched"),
    )
