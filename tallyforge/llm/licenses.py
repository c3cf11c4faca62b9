"""Licence scans by sentence rules, with DataFrame functions only.

A text is cut into sentences; each, normalised, is looked up among known licence sentences; the
sequence of identifiers found is matched against ordered rules, each an ordered list of identifiers.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import columns, documents

#: Known licence sentences by identifier.
SENTENCES = {
    1: "Licensed under the Apache License, Version 2.0.",
    2: "You may not use this file except in compliance with the License.",
    3: "Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied.",
    4: "Released under the MIT License.",
    5: "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files, to deal in the Software without restriction.",
    6: "The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.",
    7: "This work is licensed under the GNU General Public License, version 3.",
    8: "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or any later version.",
    9: "You should have received a copy of the GNU General Public License along with this program.",
    10: "Licensed under CC BY-NC 4.0.",
    11: "Licensed under CC BY 4.0.",
    12: "Licensed under CC BY-SA 4.0.",
    13: "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    14: "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met.",
    15: "Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission.",
    16: "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
    17: "This is free and unencumbered software released into the public domain.",
    18: "All rights reserved.",
    19: "Released into the public domain.",
    20: "Licensed under the BSD 3-Clause License.",
}
#: Ordered rules, the more specific first: a licence, and the identifiers that must stand in this order.
RULES = (
    ("Apache-2.0", (1, 2, 3)),
    ("Apache-2.0", (1,)),
    ("Apache-2.0", (2, 3)),
    ("MIT", (5, 6)),
    ("MIT", (4,)),
    ("GPL-3.0-or-later", (8, 9)),
    ("GPL-3.0-or-later", (8,)),
    ("GPL-3.0-only", (7,)),
    ("CC-BY-NC-4.0", (10,)),
    ("CC-BY-SA-4.0", (12,)),
    ("CC-BY-4.0", (11,)),
    ("CC-BY-4.0", (13,)),
    ("BSD-3-Clause", (14, 15)),
    ("BSD-2-Clause", (14,)),
    ("BSD-3-Clause", (20,)),
    ("MPL-2.0", (16,)),
    ("Unlicense", (17,)),
    ("Public-Domain", (19,)),
    ("All-Rights-Reserved", (18,)),
)

_FREE = "is free software{m} you can redistribute it and/or modify it under the terms of the GNU {n}General Public License as published by the Free Software Foundation{m} "
_LATER = "either version {v} of the License, or (at your option) any later version."
_ISC = "Permission to use, copy, modify, {and_} distribute this software for any purpose with or without fee is hereby granted{rest}"
_NOTICE = ", provided that the above copyright notice and this permission notice appear in all copies."
_GRANT = "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so"
#: Sentences of the licences' own texts and headers, as they are published.  The SQL holds those above only.
MORE_SENTENCES = {
    21: f"{_GRANT}, subject to the following conditions:",
    22: f"{_GRANT}.",
    23: "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License.",
    24: "See the License for the specific language governing permissions and limitations under the License.",
    25: "Apache License Version 2.0, January 2004",
    26: "Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer.",
    27: "Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution.",
    28: "All advertising materials mentioning features or use of this software must display the following acknowledgement:",
    29: "The name of the author may not be used to endorse or promote products derived from this software without specific prior written permission.",
    30: "This program " + _FREE.format(m=":", n="").replace("Foundation:", "Foundation,") + _LATER.format(v="3"),
    31: "This program " + _FREE.format(m=";", n="") + _LATER.format(v="2"),
    32: "This program " + _FREE.format(m=";", n="") + "version 2 of the License.",
    33: "This library " + _FREE.format(m=";", n="Lesser ") + _LATER.format(v="2.1"),
    34: "This program " + _FREE.format(m=":", n="Lesser ") + _LATER.format(v="3"),
    35: "This library " + _FREE.format(m=":", n="Lesser ") + _LATER.format(v="3"),
    36: "This program " + _FREE.format(m=":", n="Affero ") + _LATER.format(v="3"),
    37: "GNU GENERAL PUBLIC LICENSE Version 3, 29 June 2007",
    38: "GNU GENERAL PUBLIC LICENSE Version 2, June 1991",
    39: "GNU LESSER GENERAL PUBLIC LICENSE Version 3, 29 June 2007",
    40: "GNU LESSER GENERAL PUBLIC LICENSE Version 2.1, February 1999",
    41: "GNU AFFERO GENERAL PUBLIC LICENSE Version 3, 19 November 2007",
    42: _ISC.format(and_="and/or", rest=_NOTICE),
    43: _ISC.format(and_="and", rest=_NOTICE),
    44: _ISC.format(and_="and/or", rest="."),
    45: "Mozilla Public License Version 2.0",
    46: "CC0 1.0 Universal",
    47: "The laws of most jurisdictions throughout the world automatically confer exclusive Copyright and Related Rights (as defined below) upon the creator and subsequent owner(s) (each and all, an \"owner\") of an original work of authorship and/or a database (each, a \"Work\").",
    48: "Distributed under the Boost Software License, Version 1.0.",
    49: "Boost Software License - Version 1.0 - August 17th, 2003",
    50: "Permission is granted to anyone to use this software for any purpose, including commercial applications, and to alter it and redistribute it freely, subject to the following restrictions:",
    51: "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.",
    52: "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License.",
    53: "This work is licensed under a Creative Commons Attribution-NonCommercial-ShareAlike 4.0 International License.",
    54: "This work is licensed under a Creative Commons Attribution-NoDerivatives 4.0 International License.",
    55: "This work is licensed under a Creative Commons Attribution-NonCommercial-NoDerivatives 4.0 International License.",
    56: "The contents of this file are subject to the Mozilla Public License Version 1.1 (the \"License\"); you may not use this file except in compliance with the License.",
}
#: Rules of these sentences, before the others; each needs one of them.
MORE_RULES = (
    ("Apache-2.0", (23,)),
    ("Apache-2.0", (25,)),
    ("MIT", (21, 6)),
    ("MIT-0", (22,)),
    ("AGPL-3.0-or-later", (36,)),
    ("LGPL-3.0-or-later", (34,)),
    ("LGPL-3.0-or-later", (35,)),
    ("LGPL-2.1-or-later", (33,)),
    ("GPL-3.0-or-later", (30,)),
    ("GPL-2.0-or-later", (31,)),
    ("GPL-2.0-only", (32,)),
    ("AGPL-3.0-only", (41,)),
    ("LGPL-3.0-only", (39,)),
    ("LGPL-2.1-only", (40,)),
    ("GPL-3.0-only", (37,)),
    ("GPL-2.0-only", (38,)),
    ("BSD-4-Clause", (14, 28)),
    ("BSD-3-Clause", (14, 29)),
    ("ISC", (42,)),
    ("ISC", (43,)),
    ("0BSD", (44,)),
    ("MPL-1.1", (56,)),
    ("MPL-2.0", (45,)),
    ("CC0-1.0", (46,)),
    ("CC0-1.0", (47,)),
    ("BSL-1.0", (48,)),
    ("BSL-1.0", (49,)),
    ("Zlib", (50,)),
    ("CC-BY-SA-4.0", (51,)),
    ("CC-BY-NC-4.0", (52,)),
    ("CC-BY-NC-SA-4.0", (53,)),
    ("CC-BY-ND-4.0", (54,)),
    ("CC-BY-NC-ND-4.0", (55,)),
)

#: A sentence ends with a mark and white space, or with its line.  A version number's dots don't end one.
BREAK = r"[.!?][ \t\r]+|\n"
#: A sentence wrapped over lines ends with a mark and white space, or before a line without letters and digits.
STOP = r"[.!?][ \t\r\n]+|\n[^a-z0-9\n]*(?=\n)"
#: The mark of an abbreviated "version" before its number ends no sentence.
VERSION = r"\bv\.[ \t\r\n]+(?=[0-9])"


_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def normal(sentence: str) -> str:
    """What the sentences are compared by: a-z, 0-9 runs joined by one space."""
    import re

    return re.sub(r"[^a-z0-9]+", " ", sentence.lower()).strip(" ")


def _pieces(sentences: dict[int, str] = SENTENCES) -> dict[str, int]:
    """Normalised forms; a known sentence with a break inside is known by its longest piece."""
    import re

    out = {}
    for k, s in sentences.items():
        parts = [x for x in re.split(BREAK, re.sub(VERSION, "v ", s)) if normal(x)]
        out.setdefault(max(map(normal, parts), key=len), k)
    return out


def sentence_ids(text: Column) -> Column:
    """The identifiers of the text's known sentences, in order.

    A sentence begins with its line or after another, and may go on over the lines that follow; where several known ones begin
    on one line, the longest counts.  One that is the end of another, on lines of its own, counts too.
    """
    known = _pieces(SENTENCES | MORE_SENTENCES)
    names = F.create_map(*[F.lit(x) for pair in known.items() for x in pair])
    most = max(len(x.split()) for x in known)  # a line kept has a word, so no sentence goes over more lines
    seconds: dict[str, set[str]] = {}
    for x in known:
        seconds.setdefault(x.split()[0], set()).add(x.split()[1])
    # each known sentence's first two words, as a cheap filter before lines are joined
    pairs = "|".join(f"{a}[^a-z0-9]+(?:{'|'.join(sorted(b))})(?![a-z0-9])" for a, b in sorted(seconds.items()))
    plain = F.regexp_replace(F.translate(text, _UPPER, _UPPER.lower()), VERSION, "v ")
    units = F.filter(F.split(plain, STOP), lambda u: u.rlike(f"(?:^|\\n)[^a-z0-9\\n]*(?:{pairs})"))

    def found(lines: Column) -> Column:
        starts = F.filter(F.sequence(F.lit(1), F.size(lines)), lambda i: F.substring_index(F.element_at(lines, i), " ", 1).isin(*seconds))

        def longest(i: Column) -> Column:
            runs = F.transform(F.sequence(F.lit(1), F.least(F.lit(most), F.size(lines) - i + 1)), lambda n: F.element_at(names, F.array_join(F.slice(lines, i, n), " ")))
            return F.get(F.reverse(F.filter(runs, lambda k: k.isNotNull())), F.lit(0))

        return F.filter(F.transform(starts, longest), lambda k: k.isNotNull())

    lines = F.transform(units, lambda u: F.filter(F.transform(F.split(u, "\n"), lambda x: F.trim(F.regexp_replace(x, "[^a-z0-9]+", " "))), lambda x: x != ""))
    return F.flatten(F.transform(lines, found))


def in_order(ids: Column, rule: tuple[int, ...]) -> Column:
    """Whether the rule's identifiers stand in this order, other sentences between them or not."""
    if len(rule) == 1:
        return F.array_contains(ids, rule[0])
    want = F.array(*[F.lit(k) for k in rule])
    step = F.aggregate(ids, F.lit(0), lambda n, k: F.when((n < len(rule)) & (F.element_at(want, F.least(n + 1, F.lit(len(rule)))) == k), n + 1).otherwise(n))
    return step == len(rule)


def scan(docs: DataFrame) -> DataFrame:
    """(doc_id, sentences, n_sentences, licence, licences) of each row.

    `sentences` are the identifiers found, comma-joined in text order; `licence` the first rule's that
    matches, `licences` all that do, comma-joined in the rules' order, each once; both are empty strings where none
    does.  Null, empty and wordless texts have none.  Rows are judged each by its text.
    The SQL gives the same where no known sentence is wrapped over lines and none is of MORE_SENTENCES.
    """
    found = columns(docs, "doc_id", "text").select("doc_id", sentence_ids(F.coalesce("text", F.lit(""))).alias("ids"))
    # most texts have none: rules are tried on the others only
    names = F.array_distinct(F.filter(F.array(*[F.when(in_order(F.col("ids"), rule), F.lit(name)) for name, rule in MORE_RULES + RULES]), lambda x: x.isNotNull()))
    found = found.withColumn("names", F.when(F.size("ids") > 0, names).otherwise(F.array().cast("array<string>")))
    return found.select(
        "doc_id", F.array_join(F.transform("ids", lambda k: k.cast("string")), ",").alias("sentences"), F.size("ids").cast("long").alias("n_sentences"), F.coalesce(F.get("names", F.lit(0)), F.lit("")).alias("licence"), F.array_join("names", ",").alias("licences")
    )


def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan(documents(spark, sf_dir))


def _sql() -> str:
    known = ", ".join(f"('{x}', {k})" for x, k in _pieces().items())

    def ordered(rule: tuple[int, ...]) -> str:
        return "regexp_matches(ids, '" + "(.*,)?".join(f",{k}," if i == 0 else f"{k}," for i, k in enumerate(rule)) + "')"

    rules = ", ".join(f"CASE WHEN {ordered(rule)} THEN '{name}' END" for name, rule in RULES)
    return rf"""
WITH known(form, id) AS (VALUES {known}),
pieces AS (
  SELECT doc_id, generate_subscripts(p, 1) AS k, unnest(p) AS s
  FROM (SELECT doc_id, regexp_split_to_array(regexp_replace(translate(coalesce(text, ''), '{_UPPER}', '{_UPPER.lower()}'), '\bv\.[ \t\r]+([0-9])', 'v \1', 'g'), '[.!?][ \t\r]+|\n') AS p FROM documents)),
found AS (SELECT doc_id, k, id FROM (SELECT doc_id, k, trim(regexp_replace(s, '[^a-z0-9]+', ' ', 'g')) AS form FROM pieces) JOIN known USING (form)),
joined AS (SELECT doc_id, string_agg(CAST(id AS VARCHAR), ',' ORDER BY k) AS sentences, count(*) AS n FROM found GROUP BY doc_id),
named AS (
  SELECT doc_id, coalesce(sentences, '') AS sentences, coalesce(n, 0) AS n_sentences, ',' || coalesce(sentences, '') || ',' AS ids
  FROM (SELECT doc_id FROM documents) LEFT JOIN joined USING (doc_id)),
listed AS (SELECT *, list_filter([{rules}], lambda x: x IS NOT NULL) AS l FROM named),
firsts AS (SELECT *, list_filter(l, lambda x, i: list_position(l, x) = i) AS names FROM listed)
SELECT doc_id, sentences, n_sentences, coalesce(names[1], '') AS licence, coalesce(array_to_string(names, ','), '') AS licences FROM firsts
"""


SQL = _sql()
