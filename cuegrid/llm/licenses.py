"""License scans by sentence rules (operator 5), in DataFrame functions only.

Comment marks at the beginnings of lines go, blank lines (also those of comments) end paragraphs, and paragraphs are cut into sentences.
A sentence is normalised (lower case, everything but a-z and 0-9 to one space, ``licence`` to ``license``) and read for known
license sentences, as a whole or as words within it, longest first.  The identifiers
found, in order, are matched against ordered rules, longest first: a license is found where a rule's identifiers
follow each other, and what a rule has matched is not matched again by a shorter one.  Known sentences and rules are parameters.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Known sentences by identifier, as normalised.
SENTENCES = {
    "mit-release": "released under the mit license",
    "mit-under": "licensed under the mit license",
    "mit-grant": (
        "permission is hereby granted free of charge to any person obtaining a copy of this software and associated "
        "documentation files the software to deal in the software without restriction including without limitation the "
        "rights to use copy modify merge publish distribute sublicense and or sell copies of the software and to permit "
        "persons to whom the software is furnished to do so subject to the following conditions"
    ),
    "mit-notice": "the above copyright notice and this permission notice shall be included in all copies or substantial portions of the software",
    "apache-under": "licensed under the apache license version 2 0",
    "apache-under-defined": "licensed under the apache license version 2 0 the license",
    "apache-comply": "you may not use this file except in compliance with the license",
    "gpl3-work": "this work is licensed under the gnu general public license version 3",
    "gpl3-under": "licensed under the gnu general public license version 3",
    "gpl-free": (
        "this program is free software you can redistribute it and or modify it under the terms of the gnu general public "
        "license as published by the free software foundation either version 3 of the license or at your option any later version"
    ),
    "gpl-hope": (
        "this program is distributed in the hope that it will be useful but without any warranty without even the implied "
        "warranty of merchantability or fitness for a particular purpose"
    ),
    "cc-by-nc-4": "licensed under cc by nc 4 0",
    "cc-by-4": "licensed under cc by 4 0",
    "cc-by-sa-4": "licensed under cc by sa 4 0",
    "cc0": "released under cc0 1 0",
    "bsd-redistribute": (
        "redistribution and use in source and binary forms with or without modification are permitted provided that the "
        "following conditions are met"
    ),
    "spdx-mit": "spdx license identifier mit",
    "spdx-apache": "spdx license identifier apache 2 0",
    "spdx-gpl3": "spdx license identifier gpl 3 0 or later",
}

#: Ordered rules: license, and the identifiers that follow each other.
RULES = [
    ("MIT", ["mit-release"]),
    ("MIT", ["mit-under"]),
    ("MIT", ["spdx-mit"]),
    ("MIT", ["mit-grant", "mit-notice"]),
    ("Apache-2.0", ["apache-under"]),
    ("Apache-2.0", ["apache-under-defined", "apache-comply"]),
    ("Apache-2.0", ["spdx-apache"]),
    ("GPL-3.0", ["gpl3-work"]),
    ("GPL-3.0", ["gpl3-under"]),
    ("GPL-3.0", ["gpl-free", "gpl-hope"]),
    ("GPL-3.0", ["spdx-gpl3"]),
    ("CC-BY-NC-4.0", ["cc-by-nc-4"]),
    ("CC-BY-4.0", ["cc-by-4"]),
    ("CC-BY-SA-4.0", ["cc-by-sa-4"]),
    ("CC0-1.0", ["cc0"]),
    ("BSD", ["bsd-redistribute"]),
    ("BSD-2-Clause", ["bsd-redistribute", "bsd-source", "bsd-binary"]),
    ("BSD-3-Clause", ["bsd-redistribute", "bsd-source", "bsd-binary", "bsd-names"]),
]

#: Licenses by SPDX identifier (of the public SPDX license list) and the names that notices give them, as normalised.
NAMES = {
    "MIT": ["mit license"],
    "Apache-2.0": ["apache license version 2 0", "apache license 2 0", "apache 2 0 license"],
    "GPL-2.0": ["gnu general public license version 2", "gnu gpl version 2", "gpl version 2", "gplv2"],
    "GPL-3.0": ["gnu general public license version 3", "gnu gpl version 3", "gpl version 3", "gplv3"],
    "LGPL-2.1": ["gnu lesser general public license version 2 1", "gnu lgpl version 2 1", "lgpl version 2 1"],
    "LGPL-3.0": ["gnu lesser general public license version 3", "gnu lgpl version 3", "lgpl version 3"],
    "AGPL-3.0": ["gnu affero general public license version 3", "gnu agpl version 3", "agpl version 3"],
    "MPL-2.0": ["mozilla public license version 2 0", "mozilla public license 2 0", "mpl 2 0"],
    "EPL-2.0": ["eclipse public license version 2 0", "eclipse public license 2 0", "epl 2 0"],
    "BSD-2-Clause": ["bsd 2 clause license", "2 clause bsd license", "simplified bsd license"],
    "BSD-3-Clause": ["bsd 3 clause license", "3 clause bsd license", "new bsd license"],
    "ISC": ["isc license"],
    "Zlib": ["zlib license"],
    "BSL-1.0": ["boost software license version 1 0", "boost software license"],
    "Unlicense": ["unlicense"],
    "CC0-1.0": ["cc0 1 0", "cc0 1 0 universal"],
    "CC-BY-4.0": ["cc by 4 0", "creative commons attribution 4 0 international license"],
    "CC-BY-SA-4.0": ["cc by sa 4 0", "creative commons attribution sharealike 4 0 international license"],
    "CC-BY-NC-4.0": ["cc by nc 4 0", "creative commons attribution noncommercial 4 0 international license"],
}
#: How a notice leads up to a name, with and without an article.
LEADS = ["licensed under", "released under", "distributed under", "available under", *(f"this {x} is licensed under" for x in ("work", "project", "software", "file", "program"))]


def _named() -> tuple[dict[str, str], list[tuple[str, list[str]]]]:
    """Sentences of all leads and names and of SPDX tags, an identifier a license, and their rules."""
    texts = {}
    for license_, names in NAMES.items():
        for name in names:
            for lead in LEADS:
                texts |= {f"{lead} {name}": license_, f"{lead} the {name}": license_}
        bare = license_.lower().replace("-", " ").replace(".", " ")
        for tail in ("", " only", " or later"):
            texts[f"spdx license identifier {bare}{tail}"] = license_
    known = set(SENTENCES.values())
    made = {f"named-{license_.lower()}-{n}": text for n, (text, license_) in enumerate(texts.items()) if text not in known}
    return made, [(texts[text], [name]) for name, text in made.items()]


NAMED, NAMED_RULES = _named()

#: Sentences that other known ones are parts of, and of whole license texts, as published.
JOINED = {
    "bsd-source": "redistributions of source code must retain the above copyright notice this list of conditions and the following disclaimer",
    "bsd-binary": (
        "redistributions in binary form must reproduce the above copyright notice this list of conditions and the following "
        "disclaimer in the documentation and or other materials provided with the distribution"
    ),
    "bsd-names": "may be used to endorse or promote products derived from this software without specific prior written permission",
    "gpl2-only": (
        "under the terms of the gnu general public license version 2 as published by the free software foundation"
    ),
    "gpl3-only": (
        "under the terms of the gnu general public license version 3 as published by the free software foundation"
    ),
    "0bsd-grant": "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted",
    "apache-notice": (
        "licensed under the apache license version 2 0 the license you may not use this file except in compliance with the license"
    ),
    "gpl2-free": (
        "this program is free software you can redistribute it and or modify it under the terms of the gnu general public "
        "license as published by the free software foundation either version 2 of the license or at your option any later version"
    ),
    "lgpl3-free": (
        "this library is free software you can redistribute it and or modify it under the terms of the gnu lesser general public "
        "license as published by the free software foundation either version 3 of the license or at your option any later version"
    ),
    "lgpl21-free": (
        "this library is free software you can redistribute it and or modify it under the terms of the gnu lesser general public "
        "license as published by the free software foundation either version 2 1 of the license or at your option any later version"
    ),
    "agpl3-free": (
        "this program is free software you can redistribute it and or modify it under the terms of the gnu affero general public "
        "license as published by the free software foundation either version 3 of the license or at your option any later version"
    ),
    "mpl2-subject": "this source code form is subject to the terms of the mozilla public license v",  # its full stop ends a sentence
    "isc-grant": (
        "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted "
        "provided that the above copyright notice and this permission notice appear in all copies"
    ),
    "zlib-warranty": "this software is provided as is without any express or implied warranty",
    "zlib-grant": (
        "permission is granted to anyone to use this software for any purpose including commercial applications and to alter it "
        "and redistribute it freely subject to the following restrictions"
    ),
    "unlicense-domain": "this is free and unencumbered software released into the public domain",
}
JOINED_RULES = [
    ("Apache-2.0", ["apache-notice"]),
    ("GPL-2.0", ["gpl2-free"]),
    ("GPL-2.0", ["gpl2-only"]),
    ("GPL-3.0", ["gpl3-only"]),
    ("0BSD", ["0bsd-grant"]),
    ("LGPL-3.0", ["lgpl3-free"]),
    ("LGPL-2.1", ["lgpl21-free"]),
    ("AGPL-3.0", ["agpl3-free"]),
    ("MPL-2.0", ["mpl2-subject"]),
    ("ISC", ["isc-grant"]),
    ("Zlib", ["zlib-warranty", "zlib-grant"]),
    ("Unlicense", ["unlicense-domain"]),
]

#: Every known sentence holds one of these (a cheap test before normalising).
CUE = "(?i)licen[cs]e|permission|copyright|redistribut|cc0|released under|distributed under|available under|warranty|public domain"
_END = r"[.!?]+(\s|$)"
_BLANK = r"\n[ \t\r]*\n"
#: Marks in front of a comment's lines.
_MARK = r"(^|\n)[ \t]*(//+!?|#+|/\*+|\*+/?|--+|;+|%+|<!--+|'''|dnl|REM)[ \t]?"
#: A tag whose colon or hyphens don't matter.
_TAG = "(?i)(spdx-licen[cs]e-identifier):"


def normalised(sentence: Column) -> Column:
    plain = F.trim(F.regexp_replace(F.lower(sentence), "[^a-z0-9]+", " "))
    return F.replace(plain, F.lit("licence"), F.lit("license"))


def _pattern(known: dict[str, str]) -> str:
    """Any known sentence as whole words, longer ones first."""
    return rf"\b(?:{'|'.join(sorted(known.values(), key=lambda t: (-len(t), t)))})\b"


def sentence_identifiers(text: Column, known: dict[str, str]) -> Column:
    """The identifiers of the known sentences of a text, in order."""
    plain = F.regexp_replace(F.regexp_replace(text, _TAG, "$1"), _MARK, "$1")
    paragraphs = F.regexp_replace(F.regexp_replace(plain, _BLANK, "\u0001"), "\n", " ")
    cued = F.filter(F.split(F.regexp_replace(paragraphs, _END, "\u0001"), "\u0001"), lambda s: s.rlike(CUE))
    hits = F.flatten(F.transform(cued, lambda s: F.regexp_extract_all(normalised(s), F.lit(_pattern(known)), F.lit(0))))
    table = F.create_map(*[F.lit(x) for name, text_ in known.items() for x in (text_, name)])
    return F.transform(hits, lambda h: F.element_at(table, h))


def _longest_first(rules: list[tuple[str, list[str]]]) -> list[tuple[str, list[str]]]:
    return sorted((r for r in rules if len(r[1]) > 1), key=lambda r: -len(r[1]))


def _chain(ids: list[str]) -> str:
    return "".join(f"<{i}>" for i in ids)


def scan_licenses(
    docs: DataFrame, known: dict[str, str] = SENTENCES | NAMED | JOINED, rules: list[tuple[str, list[str]]] = RULES + NAMED_RULES + JOINED_RULES
) -> DataFrame:
    """doc_id, n_sentences, sentence_ids and licenses of every row of ``docs(doc_id, text)``.

    sentence_ids are the identifiers of known sentences, comma-joined in order; n_sentences
    is their number; licenses are the names of the rules that match them, sorted,
    each once, comma-joined.  Null, empty and blank texts and texts without known sentences have 0
    and empty strings.  Repeated rows are answered each; a null doc_id stays null; an empty table
    gives an empty result; other columns are ignored.
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    none = F.array().cast("array<string>")
    rows = docs.select("doc_id", F.when(text.rlike(CUE), sentence_identifiers(text, known)).otherwise(none).alias("ids"))
    chain = F.when(F.size("ids") > 0, F.concat(F.lit("<"), F.array_join("ids", "><"), F.lit(">"))).otherwise("")
    found = []
    for name, ids in _longest_first(rules):
        found.append(F.when(F.contains(chain, F.lit(_chain(ids))), name))
        chain = F.replace(chain, F.lit(_chain(ids)), F.lit("|"))
    alone = {ids[0]: name for name, ids in rules if len(ids) == 1}
    table = F.create_map(*[F.lit(x) for pair in alone.items() for x in pair]) if alone else F.lit(None).cast("map<string,string>")
    rest = F.regexp_extract_all(chain, F.lit("<([^>]+)>"), F.lit(1))
    all_ = F.concat(F.array(*found).cast("array<string>"), F.transform(rest, lambda i: F.try_element_at(table, i)))
    licenses = F.array_sort(F.array_distinct(F.filter(all_, lambda x: x.isNotNull())))
    return rows.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_sentences"),
        F.array_join("ids", ",").alias("sentence_ids"),
        F.when(F.size("ids") > 0, F.array_join(licenses, ",")).otherwise("").alias("licenses"),
    )


def oracle_sql(known: dict[str, str] = SENTENCES | NAMED | JOINED, rules: list[tuple[str, list[str]]] = RULES + NAMED_RULES + JOINED_RULES) -> str:
    """The same in DuckDB SQL."""
    quoted = lambda x: "'" + x.replace("'", "''") + "'"
    table = f"MAP {{{', '.join(f"'{text}': '{name}'" for name, text in known.items())}}}"
    single = f"MAP {{{', '.join(f"'{i[0]}': '{name}'" for name, i in rules if len(i) == 1)}}}"
    norm = "replace(trim(regexp_replace(lower(s), '[^a-z0-9]+', ' ', 'g')), 'licence', 'license')"
    flat = f"replace(regexp_replace(t, '{_BLANK}', chr(1), 'g'), chr(10), ' ')"
    cued = f"list_filter(string_split(regexp_replace({flat}, '{_END}', chr(1), 'g'), chr(1)), lambda s: regexp_matches(s, '{CUE}'))"
    hits = f"flatten(list_transform({cued}, lambda s: regexp_extract_all({norm}, '{_pattern(known)}')))"
    chain, found = "c", []
    for name, ids in _longest_first(rules):
        found.append(f"case when contains({chain}, '{_chain(ids)}') then '{name}' end")
        chain = f"replace({chain}, '{_chain(ids)}', '|')"
    return f"""
    with d as (select doc_id, regexp_replace(regexp_replace(coalesce(text, ''), '{_TAG}', '\\1', 'g'), {quoted(_MARK)}, '\\1', 'g') as t, {table} as known, {single} as singles from documents),
    e as (select doc_id, singles, list_transform({hits}, lambda h: known[h]) as ids from d),
    f as (select *, array_to_string(list_transform(ids, lambda i: '<' || i || '>'), '') as c from e),
    g as (select *, list_concat([{', '.join(found)}], list_transform(regexp_extract_all({chain}, '<([^>]+)>', 1), lambda i: singles[i])) as names from f)
    select doc_id, cast(len(ids) as bigint) as n_sentences, array_to_string(ids, ',') as sentence_ids,
           array_to_string(list_sort(list_distinct(list_filter(names, lambda x: x is not null))), ',') as licenses
    from g"""
