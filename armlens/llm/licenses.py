"""Licence recognition by sentences, with DataFrame functions only.

A text is cut into units at line ends and after sentence marks; units are normalised (lower case, runs of anything but
letters and digits become one blank). A known licence sentence is found where its words are those of consecutive units,
however many: it begins where a unit does and ends where one does. Known sentences of MANY_WORDS words or more that have
no mark at their end are beginnings of longer ones, so what follows them may be in the same unit. A known sentence may
have a hole (HOLE), which stands for a holder's name of up to HOLE_WORDS words. Labels of list items at a unit's
beginning ("(a)", "2)", "*") aren't part of it. The identifiers found, in order, are matched against rules: a rule
applies at a place where its identifiers follow one another among those found. Where it lies within a place of a longer
rule (the clauses of one licence are the first of another's), the shorter rule doesn't count there.

Licences named by a tag (SPDX-License-Identifier, also with AND, OR and WITH) are reported as the tag names them; a tag
is no sentence.

Texts without any of the words that every known sentence has one of are not cut at all; that is no filter on results.

Defined results: null and empty texts have no sentence; known sentences that no rule covers are reported in
``sentences`` only; rows that occur twice are handled twice; extra columns are ignored.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Known licence sentences and the rules over them.
SENTENCES = {
    "mit-notice": "Released under the MIT License.",
    "mit-notice-2": "Licensed under the MIT License.",
    "mit-title": "The MIT License (MIT)",
    "mit-title-2": "MIT License",
    "mit-grant": "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal in the Software without restriction",
    "mit-condition": "The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.",
    "mit-as-is": "THE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT.",
    "mit-grant-2": "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal with the Software without restriction",
    "isc-grant": "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies.",
    "isc-grant-2": "Permission to use, copy, modify, and distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies.",
    "isc-as-is": "THE SOFTWARE IS PROVIDED \"AS IS\" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS.",
    "zlib-as-is": "This software is provided 'as-is', without any express or implied warranty.",
    "zlib-grant": "Permission is granted to anyone to use this software for any purpose, including commercial applications, and to alter it and redistribute it freely, subject to the following restrictions",
    "unlicense-free": "This is free and unencumbered software released into the public domain.",
    "unlicense-anyone": "Anyone is free to copy, modify, publish, use, compile, sell, or distribute this software, either in source code form or as a compiled binary, for any purpose, commercial or non-commercial, and by any means.",
    "boost-title": "Boost Software License - Version 1.0 - August 17th, 2003",
    "boost-grant": "Permission is hereby granted, free of charge, to any person or organization obtaining a copy of the software and accompanying documentation covered by this license (the \"Software\") to use, reproduce, display, distribute, execute, and transmit the Software",
    "apache-title": "Apache License Version 2.0, January 2004",
    "apache-notice": "Licensed under the Apache License, Version 2.0.",
    "apache-notice-2": "Licensed under the Apache License, Version 2.0 (the \"License\")",
    "apache-use": "you may not use this file except in compliance with the License.",
    "apache-copy": "You may obtain a copy of the License at",
    "apache-basis": "Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied.",
    "gpl3-notice": "This work is licensed under the GNU General Public License, version 3.",
    "gpl-redistribute": "you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.",
    "gpl2-redistribute": "you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation; either version 2 of the License, or (at your option) any later version.",
    "gpl2-only": "you can redistribute it and/or modify it under the terms of the GNU General Public License version 2 as published by the Free Software Foundation.",
    "gpl3-only": "you can redistribute it and/or modify it under the terms of the GNU General Public License version 3 as published by the Free Software Foundation.",
    "lgpl2-redistribute": "you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation; either version 2.1 of the License, or (at your option) any later version.",
    "lgpl3-redistribute": "you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.",
    "agpl3-redistribute": "you can redistribute it and/or modify it under the terms of the GNU Affero General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.",
    "gpl2-title": "GNU GENERAL PUBLIC LICENSE Version 2, June 1991",
    "gpl3-title": "GNU GENERAL PUBLIC LICENSE Version 3, 29 June 2007",
    "lgpl2-title": "GNU LESSER GENERAL PUBLIC LICENSE Version 2.1, February 1999",
    "lgpl3-title": "GNU LESSER GENERAL PUBLIC LICENSE Version 3, 29 June 2007",
    "agpl3-title": "GNU AFFERO GENERAL PUBLIC LICENSE Version 3, 19 November 2007",
    "mpl2-title": "Mozilla Public License Version 2.0",
    "lgpl-warranty": "This library is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY",
    "gpl-warranty": "This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY",
    "ccbync-notice": "Licensed under CC BY-NC 4.0.",
    "ccby-notice": "Licensed under CC BY 4.0.",
    "ccby-long": "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    "ccbysa-long": "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.",
    "ccbynd-long": "This work is licensed under a Creative Commons Attribution-NoDerivatives 4.0 International License.",
    "ccbync-long": "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License.",
    "ccbyncsa-long": "This work is licensed under a Creative Commons Attribution-NonCommercial-ShareAlike 4.0 International License.",
    "ccbyncnd-long": "This work is licensed under a Creative Commons Attribution-NonCommercial-NoDerivatives 4.0 International License.",
    "cc0-notice": "This work is licensed under CC0 1.0 Universal.",
    "bsd-redistribute": "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met",
    "bsd-source": "Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer.",
    "bsd-binary": "Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution.",
    "bsd-endorse": "Neither the name of <holder> nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission.",
    "bsd-endorse-name": "The name of <holder> may not be used to endorse or promote products derived from this software without specific prior written permission.",
    "bsd-endorse-names": "The names of <holder> may not be used to endorse or promote products derived from this software without specific prior written permission.",
    "bsd-advertise": "All advertising materials mentioning features or use of this software must display the following acknowledgement:",
    "bsd-as-is": "THIS SOFTWARE IS PROVIDED BY <holder> \"AS IS\" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED.",
    "mpl2-form": "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
    "epl2-title": "Eclipse Public License - v 2.0",
    "epl1-title": "Eclipse Public License - v 1.0",
    "epl2-notice": "This program and the accompanying materials are made available under the terms of the Eclipse Public License 2.0",
    "epl2-notice-2": "This program and the accompanying materials are made available under the terms of the Eclipse Public License v. 2.0",
    "epl1-notice": "All rights reserved. This program and the accompanying materials are made available under the terms of the Eclipse Public License v1.0",
    "artistic2-title": "The Artistic License 2.0",
    "ofl-notice": "This Font Software is licensed under the SIL Open Font License, Version 1.1.",
    "ofl-title": "SIL OPEN FONT LICENSE Version 1.1 - 26 February 2007",
    "postgresql-grant": "Permission to use, copy, modify, and distribute this software and its documentation for any purpose, without fee, and without a written agreement is hereby granted, provided that the above copyright notice and this paragraph and the following two paragraphs appear in all copies.",
    "eupl12-title": "EUROPEAN UNION PUBLIC LICENCE v. 1.2",
    "eupl12-notice": "Licensed under the EUPL, Version 1.2",
    "wtfpl-title": "DO WHAT THE FUCK YOU WANT TO PUBLIC LICENSE Version 2, December 2004",
    "cddl-title": "COMMON DEVELOPMENT AND DISTRIBUTION LICENSE (CDDL) Version 1.0",
    "cddl-title-2": "COMMON DEVELOPMENT AND DISTRIBUTION LICENSE Version 1.0",
    "ncsa-title": "University of Illinois/NCSA Open Source License",
    "upl-title": "The Universal Permissive License (UPL), Version 1.0",
    "mspl-title": "Microsoft Public License (Ms-PL)",
    "rights": "All rights reserved under copyright.",
}
RULES = [
    ("MIT", ["mit-notice"]), ("MIT", ["mit-notice-2"]), ("MIT", ["mit-grant", "mit-condition"]), ("MIT", ["mit-title", "mit-grant"]), ("MIT", ["mit-title-2", "mit-grant"]), ("MIT", ["mit-condition", "mit-as-is"]),
    ("MIT", ["mit-grant-2", "mit-condition"]), ("ISC", ["isc-grant"]), ("ISC", ["isc-grant-2"]), ("Zlib", ["zlib-as-is", "zlib-grant"]), ("Unlicense", ["unlicense-free"]), ("Unlicense", ["unlicense-anyone"]),
    ("BSL-1.0", ["boost-title"]), ("BSL-1.0", ["boost-grant"]),
    ("Apache-2.0", ["apache-notice"]), ("Apache-2.0", ["apache-title"]), ("Apache-2.0", ["apache-notice-2", "apache-use"]), ("Apache-2.0", ["apache-use", "apache-copy", "apache-basis"]),
    ("GPL-3.0-only", ["gpl3-notice"]), ("GPL-3.0-only", ["gpl3-only"]), ("GPL-2.0-only", ["gpl2-only"]), ("GPL-3.0-or-later", ["gpl-redistribute"]), ("GPL-2.0-or-later", ["gpl2-redistribute"]),
    ("LGPL-2.1-or-later", ["lgpl2-redistribute"]), ("LGPL-3.0-or-later", ["lgpl3-redistribute"]), ("AGPL-3.0-or-later", ["agpl3-redistribute"]),
    ("GPL-2.0", ["gpl2-title"]), ("GPL-3.0", ["gpl3-title"]), ("LGPL-2.1", ["lgpl2-title"]), ("LGPL-3.0", ["lgpl3-title"]), ("AGPL-3.0", ["agpl3-title"]),
    ("CC-BY-NC-4.0", ["ccbync-notice"]), ("CC-BY-NC-4.0", ["ccbync-long"]), ("CC-BY-4.0", ["ccby-notice"]), ("CC-BY-4.0", ["ccby-long"]), ("CC-BY-SA-4.0", ["ccbysa-long"]), ("CC-BY-ND-4.0", ["ccbynd-long"]),
    ("CC-BY-NC-SA-4.0", ["ccbyncsa-long"]), ("CC-BY-NC-ND-4.0", ["ccbyncnd-long"]), ("CC0-1.0", ["cc0-notice"]),
    ("BSD-2-Clause", ["bsd-redistribute", "bsd-source", "bsd-binary"]), ("BSD-3-Clause", ["bsd-redistribute", "bsd-source", "bsd-binary", "bsd-endorse"]),
    ("BSD-3-Clause", ["bsd-redistribute", "bsd-source", "bsd-binary", "bsd-endorse-name"]), ("BSD-3-Clause", ["bsd-redistribute", "bsd-source", "bsd-binary", "bsd-endorse-names"]),
    *[("BSD-4-Clause", ["bsd-redistribute", "bsd-source", "bsd-binary", "bsd-advertise", e]) for e in ("bsd-endorse", "bsd-endorse-name", "bsd-endorse-names")],
    ("EPL-2.0", ["epl2-title"]), ("EPL-2.0", ["epl2-notice"]), ("EPL-2.0", ["epl2-notice-2"]), ("EPL-1.0", ["epl1-title"]), ("EPL-1.0", ["epl1-notice"]), ("Artistic-2.0", ["artistic2-title"]),
    ("OFL-1.1", ["ofl-notice"]), ("OFL-1.1", ["ofl-title"]), ("PostgreSQL", ["postgresql-grant"]), ("EUPL-1.2", ["eupl12-title"]), ("EUPL-1.2", ["eupl12-notice"]), ("WTFPL", ["wtfpl-title"]),
    ("CDDL-1.0", ["cddl-title"]), ("CDDL-1.0", ["cddl-title-2"]), ("NCSA", ["ncsa-title"]), ("UPL-1.0", ["upl-title"]), ("MS-PL", ["mspl-title"]), ("MPL-2.0", ["mpl2-form"]), ("MPL-2.0", ["mpl2-title"]),
]
#: Every known sentence has one of these.
HINTS = ["licen", "copyright", "permission", "warrant", "distribut", "public domain", "acknowledg"]

#: Where units end: line ends, and blanks after sentence marks.
UNIT_END = r"\s*\n\s*|(?<=[.!?;:])\s+"
#: A list item's label, which is taken off the unit.
LABEL = r"^\s*(?:\(?[0-9A-Za-z]{1,3}[.)]|[*•-])\s+"
WORDLESS = r"[^\p{L}\p{N}]+"
MANY_WORDS = 8
HOLE, HOLE_WORDS = "<holder>", 20
#: A tag's expression, and the names in it.
TAG = r"SPDX-License-Identifier:[ \t]*([A-Za-z0-9.+()-]+(?:[ \t]+(?:AND|OR|WITH)[ \t]+[A-Za-z0-9.+()-]+)*)"
TAG_EXCEPTION = r"[ \t]+WITH[ \t]+[A-Za-z0-9.+-]+"
TAG_NAME = r"[A-Za-z0-9](?:[A-Za-z0-9.+-]*[A-Za-z0-9+])?"


def normal(sentence: str) -> str:
    return re.sub(r"[\W_]+", " ", sentence.lower()).strip()


def _pieces(sentence: str) -> str:
    """A known sentence as the units' normal forms joined, as a text's own units would be."""
    return " ".join(filter(None, (normal(u) for u in re.split(r"\s*\n\s*|(?<=[.!?;:])\s+", sentence))))


def _pattern(sentence: str) -> str:
    """A sentence with a hole as a pattern over units that are joined by line ends; it ends where a unit does."""
    before, after = (_pieces(part).replace(" ", r"[ \n]") for part in sentence.split(HOLE))
    return rf"^{before}(?:[ \n][^ \n]+){{1,{HOLE_WORDS}}}?[ \n]{after}(?:\n|\z)"


KNOWN = {_pieces(text): name for name, text in SENTENCES.items() if HOLE not in text}
HOLED = {_pattern(text): name for name, text in SENTENCES.items() if HOLE in text}
assert len(KNOWN) + len(HOLED) == len(SENTENCES) and all(any(h in s for h in HINTS) for s in [*KNOWN, *HOLED])
#: Known sentences that may go on in their last unit.
OPEN = [s for s, name in KNOWN.items() if SENTENCES[name][-1] not in ".!?;:" and len(s.split()) >= MANY_WORDS]
_STARTS = [*KNOWN, *(_pieces(SENTENCES[name].split(HOLE)[0]) for name in HOLED.values())]
#: The first two words of the known sentences, and the first of them, which may be a unit by itself.
BEGINNINGS = sorted({" ".join(s.split()[:n]) for s in _STARTS for n in (1, 2)})
#: A unit has a word at least, so no sentence is in more units than this.
MOST_UNITS = max(len(_pieces(text.replace(HOLE, "x " * HOLE_WORDS)).split()) for text in SENTENCES.values())
#: In this order sentences that begin at the same place are reported.
PLAIN_ORDER, HOLED_ORDER = sorted(KNOWN, key=lambda s: (len(s), s)), sorted(HOLED, key=HOLED.get)


def sentence_ids(text: Column) -> Column:
    """The identifiers of the known sentences of a text, in order."""
    known = F.array(*[F.struct(F.lit(s).alias("s"), F.lit(KNOWN[s]).alias("id"), F.lit(s in OPEN).alias("open")) for s in PLAIN_ORDER])
    unit = lambda u: F.trim(F.regexp_replace(F.lower(F.regexp_replace(u, LABEL, "")), WORDLESS, " "))
    units = F.filter(F.transform(F.split(text, UNIT_END), unit), lambda u: u != "")
    may_begin = lambda u: F.substring_index(u, " ", 2).isin(BEGINNINGS)

    def of(lines: Column) -> Column:
        """The known sentences that begin units joined by line ends, the shortest first, then those with holes."""
        after = lambda k: F.substr(lines, F.length(k["s"]) + 1, F.lit(1))
        met = lambda k: F.startswith(F.translate(lines, "\n", " "), k["s"]) & (after(k).isin("", "\n") | (k["open"] & (after(k) == " ")))
        holed = F.array_compact(F.array(*[F.when(lines.rlike(p), F.lit(HOLED[p])) for p in HOLED_ORDER]))
        return F.concat(F.transform(F.filter(known, met), lambda k: k["id"]), holed)

    def at(units: Column) -> Column:
        places = F.filter(F.sequence(F.lit(1), F.size(units)), lambda i: may_begin(F.element_at(units, i)))
        return F.flatten(F.transform(places, lambda i: of(F.array_join(F.slice(units, i, F.lit(MOST_UNITS)), "\n"))))

    # A one-element array binds the units, so that they are cut once.
    found = F.flatten(F.transform(F.array(units), lambda u: F.when(F.size(u) > 0, at(u)).otherwise(F.array().cast("array<string>"))))
    hinted = F.coalesce(text.rlike("(?i)" + "|".join(HINTS)), F.lit(False))
    return F.when(hinted, found).otherwise(F.array().cast("array<string>"))


def tagged(text: Column) -> Column:
    """The licences that tags name, in order."""
    expressions = F.regexp_extract_all(text, F.lit(TAG), F.lit(1))
    names = F.flatten(F.transform(expressions, lambda e: F.regexp_extract_all(F.regexp_replace(e, TAG_EXCEPTION, ""), F.lit(TAG_NAME), F.lit(0))))
    return F.coalesce(F.filter(names, lambda n: ~n.isin("AND", "OR", "WITH")), F.array().cast("array<string>"))


def containing(ids: list[str]) -> list[tuple[int, list[str]]]:
    """The longer rules that these identifiers are part of, and at which of their places."""
    return [(k, r) for _, r in RULES if len(r) > len(ids) for k in range(len(r)) if r[k : k + len(ids)] == ids]


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_sentences, sentences (identifiers in order) and licenses (distinct, sorted): a row for each row."""
    found = docs.select(F.col(id_col).alias("doc_id"), sentence_ids(F.col(text_col)).alias("sentences"), tagged(F.col(text_col)).alias("tags"))

    def is_at(ids: list[str], i: Column) -> Column:
        return (i >= 1) & (F.slice("sentences", F.greatest(i, F.lit(1)), F.lit(len(ids))) == F.array(*map(F.lit, ids)))

    def hit(ids: list[str]) -> Column:
        """Whether a rule applies at any place that isn't within one of a longer rule."""

        def alone(i: Column) -> Column:
            here = is_at(ids, i)
            for k, longer in containing(ids):
                here = here & ~is_at(longer, i - k)
            return here

        return F.exists(F.sequence(F.lit(1), F.size("sentences")), alone)

    hits = F.array(*[F.when(hit(ids), F.lit(name)) for name, ids in RULES])
    none = F.array().cast("array<string>")
    by_rule = F.when(F.size("sentences") > 0, F.array_compact(hits)).otherwise(none)
    return found.select("doc_id", F.size("sentences").cast("long").alias("n_sentences"), "sentences", F.array_sort(F.array_distinct(F.concat(by_rule, "tags"))).alias("licenses"))


def oracle_sql() -> str:
    """DuckDB SQL of the digest: doc_id, n_sentences, sentences, licenses (joined by commas).

    Rules are matched by joins of numbered sentences with numbered rule members, and hits within longer hits go."""
    quote = lambda s: "'" + s.replace("'", "''") + "'"
    known = ", ".join(f"({n}, {quote(k)}, {quote(KNOWN[k])}, {k in OPEN})" for n, k in enumerate(PLAIN_ORDER))
    holed = ", ".join(f"({len(KNOWN) + n}, {quote(p)}, {quote(HOLED[p])})" for n, p in enumerate(HOLED_ORDER))
    members = ", ".join(f"({n}, {quote(name)}, {len(ids)}, {k}, {quote(i)})" for n, (name, ids) in enumerate(RULES) for k, i in enumerate(ids))
    return f"""
    WITH known(place, s, id, open) AS (VALUES {known}), holed(place, pattern, id) AS (VALUES {holed}),
    members(rule, license, size, k, id) AS (VALUES {members}),
    numbered AS (SELECT row_number() OVER () AS row, doc_id, text FROM documents),
    listed AS (SELECT row, string_split(regexp_replace(regexp_replace(text, '\\s*\\n\\s*', chr(1), 'g'), '([.!?;:])\\s+', '\\1' || chr(1), 'g'), chr(1)) AS l FROM numbered),
    cut AS (SELECT row, unnest(l) AS unit, generate_subscripts(l, 1) AS k FROM listed),
    placed AS (SELECT row, k, trim(regexp_replace(lower(regexp_replace(unit, {quote(LABEL)}, '')), '[^\\p{{L}}\\p{{N}}]+', ' ', 'g')) AS u FROM cut),
    units AS (SELECT row, k, u, coalesce(sum(length(u) + 1) OVER (PARTITION BY row ORDER BY k ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before FROM placed WHERE u <> ''),
    lines AS (SELECT row, string_agg(u, chr(10) ORDER BY k) AS line FROM units GROUP BY row),
    begun AS (SELECT u.row, u.k, place, s, id, open, substr(line, (before + 1)::BIGINT, length(s) + 1) AS here FROM units u JOIN known ON split_part(u, ' ', 1) = split_part(s, ' ', 1) JOIN lines USING (row)),
    met AS (
      SELECT row, k, place, id FROM begun WHERE replace(substr(here, 1, length(s)), chr(10), ' ') = s AND (substr(here, length(s) + 1) IN ('', chr(10)) OR open AND substr(here, length(s) + 1) = ' ')
      UNION ALL SELECT u.row, u.k, place, id FROM units u JOIN holed ON split_part(u, ' ', 1) = regexp_extract(pattern, '[a-z]+') JOIN lines USING (row) WHERE regexp_matches(substr(line, (before + 1)::BIGINT), pattern)
    ),
    ordered AS (SELECT row, id, row_number() OVER (PARTITION BY row ORDER BY k, place) AS o FROM met),
    seqs AS (SELECT row, count(*) AS n, string_agg(id, ',' ORDER BY o) AS ids FROM ordered GROUP BY row),
    hits AS (SELECT row, rule, license, size, o - m.k AS start FROM ordered JOIN members m USING (id) GROUP BY row, rule, license, size, o - m.k HAVING count(*) = size),
    alone AS (SELECT * FROM hits h WHERE NOT EXISTS (SELECT 1 FROM hits l WHERE l.row = h.row AND l.size > h.size AND l.start <= h.start AND h.start + h.size <= l.start + l.size)),
    tags AS (SELECT row, unnest(regexp_extract_all(text, {quote(TAG)}, 1)) AS e FROM numbered),
    names AS (SELECT row, unnest(regexp_extract_all(regexp_replace(e, {quote(TAG_EXCEPTION)}, '', 'g'), {quote(TAG_NAME)})) AS license FROM tags),
    each_license AS (SELECT row, license FROM alone UNION ALL SELECT row, license FROM names WHERE license NOT IN ('AND', 'OR', 'WITH')),
    found AS (SELECT row, string_agg(DISTINCT license, ',' ORDER BY license) AS licenses FROM each_license GROUP BY row)
    SELECT doc_id, coalesce(n, 0)::BIGINT AS n_sentences, coalesce(ids, '') AS sentences, coalesce(licenses, '') AS licenses
    FROM numbered LEFT JOIN seqs USING (row) LEFT JOIN found USING (row)
    """
