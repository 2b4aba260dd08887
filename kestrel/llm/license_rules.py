"""Licence scan: known sentences become identifiers, sequences of identifiers are matched against ordered rules."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

# fixed values: sentences of public licence texts and notices, normalised as ``sentences`` does
SENTENCES = {
    "MITgrant": "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files the software to deal in the software without restriction including without limitation the rights to use copy modify merge publish distribute sublicense and or sell copies of the software and to permit persons to whom the software is furnished to do so subject to the following conditions",
    "MITnotice": "the above copyright notice and this permission notice shall be included in all copies or substantial portions of the software",
    "MITwarranty": "the software is provided as is without warranty of any kind express or implied including but not limited to the warranties of merchantability fitness for a particular purpose and noninfringement",
    "MITliability": "in no event shall the authors or copyright holders be liable for any claim damages or other liability whether in an action of contract tort or otherwise arising from out of or in connection with the software or the use or other dealings in the software",
    "MITref": "released under the mit license",
    "MITref2": "licensed under the mit license",
    "MITname": "the mit license",
    "BSDgrant": "redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met",
    "BSDsource": "redistributions of source code must retain the above copyright notice this list of conditions and the following disclaimer",
    "BSDbinary": "redistributions in binary form must reproduce the above copyright notice this list of conditions and the following disclaimer in the documentation and or other materials provided with the distribution",
    "BSDendorse": "neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission",
    "BSDwarranty": "this software is provided by the copyright holders and contributors as is and any express or implied warranties including but not limited to the implied warranties of merchantability and fitness for a particular purpose are disclaimed",
    "BSDref": "licensed under the bsd license",
    "ISCgrant": "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted provided that the above copyright notice and this permission notice appear in all copies",
    "APACHEref": "licensed under the apache license version 2 0",
    "APACHElong": "licensed under the apache license version 2 0 the license",
    "APACHEuse": "you may not use this file except in compliance with the license",
    "APACHEcopy": "you may obtain a copy of the license at http www apache org licenses license 2 0",
    "APACHEbasis": "unless required by applicable law or agreed to in writing software distributed under the license is distributed on an as is basis without warranties or conditions of any kind either express or implied",
    "APACHEsee": "see the license for the specific language governing permissions and limitations under the license",
    "GPL3ref": "this work is licensed under the gnu general public license version 3",
    "GPL2ref": "this work is licensed under the gnu general public license version 2",
    "GPLfree2": "this program is free software you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation either version 2 of the license or at your option any later version",
    "GPLfree3": "this program is free software you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation either version 3 of the license or at your option any later version",
    "GPLhope": "this program is distributed in the hope that it will be useful but without any warranty without even the implied warranty of merchantability or fitness for a particular purpose",
    "GPLsee": "see the gnu general public license for more details",
    "LGPLref": "this work is licensed under the gnu lesser general public license version 3",
    "MPLform": "this source code form is subject to the terms of the mozilla public license v 2 0",
    "MPLcopy": "if a copy of the mpl was not distributed with this file you can obtain one at https mozilla org mpl 2 0",
    "CCBY": "licensed under cc by 4 0",
    "CCBYSA": "licensed under cc by sa 4 0",
    "CCBYNC": "licensed under cc by nc 4 0",
    "CCBYND": "licensed under cc by nd 4 0",
    "CC0": "to the extent possible under law the author has waived all copyright and related or neighboring rights to this work",
    "UNLICENSE": "this is free and unencumbered software released into the public domain",
    "SPDXmit": "spdx license identifier mit",
    "SPDXapache": "spdx license identifier apache 2 0",
    "SPDXgpl2": "spdx license identifier gpl 2 0 only",
    "SPDXgpl3": "spdx license identifier gpl 3 0 only",
    "SPDXbsd3": "spdx license identifier bsd 3 clause",
    "RESERVED": "all rights reserved",
}

# fixed values: ordered rules (licence, identifiers in sequence); an earlier rule takes its sentences first
RULES = (
    ("MIT", ("MITgrant", "MITnotice", "MITwarranty", "MITliability")),
    ("MIT", ("MITgrant", "MITnotice", "MITwarranty")),
    ("BSD-3-Clause", ("BSDgrant", "BSDsource", "BSDbinary", "BSDendorse", "BSDwarranty")),
    ("BSD-3-Clause", ("BSDgrant", "BSDsource", "BSDbinary", "BSDendorse")),
    ("BSD-2-Clause", ("BSDgrant", "BSDsource", "BSDbinary", "BSDwarranty")),
    ("BSD-2-Clause", ("BSDgrant", "BSDsource", "BSDbinary")),
    ("Apache-2.0", ("APACHElong", "APACHEuse", "APACHEcopy", "APACHEbasis", "APACHEsee")),
    ("Apache-2.0", ("APACHElong", "APACHEuse")),
    ("GPL-2.0-or-later", ("GPLfree2", "GPLhope", "GPLsee")),
    ("GPL-3.0-or-later", ("GPLfree3", "GPLhope", "GPLsee")),
    ("GPL-2.0-or-later", ("GPLfree2",)),
    ("GPL-3.0-or-later", ("GPLfree3",)),
    ("MPL-2.0", ("MPLform", "MPLcopy")),
    ("MPL-2.0", ("MPLform",)),
    ("ISC", ("ISCgrant",)),
    ("CC0-1.0", ("CC0",)),
    ("Unlicense", ("UNLICENSE",)),
    ("MIT", ("SPDXmit",)),
    ("Apache-2.0", ("SPDXapache",)),
    ("GPL-2.0-only", ("SPDXgpl2",)),
    ("GPL-3.0-only", ("SPDXgpl3",)),
    ("BSD-3-Clause", ("SPDXbsd3",)),
    ("MIT", ("MITref",)),
    ("MIT", ("MITref2",)),
    ("MIT-partial", ("MITname",)),
    ("MIT-partial", ("MITgrant",)),
    ("Apache-2.0", ("APACHEref",)),
    ("Apache-2.0", ("APACHElong",)),
    ("GPL-3.0-only", ("GPL3ref",)),
    ("GPL-2.0-only", ("GPL2ref",)),
    ("LGPL-3.0-only", ("LGPLref",)),
    ("BSD-unspecified", ("BSDref",)),
    ("CC-BY-4.0", ("CCBY",)),
    ("CC-BY-SA-4.0", ("CCBYSA",)),
    ("CC-BY-NC-4.0", ("CCBYNC",)),
    ("CC-BY-ND-4.0", ("CCBYND",)),
    ("All-rights-reserved", ("RESERVED",)),
)

# every known sentence holds one of these; texts without any are not cut into sentences
CUES = "licen|copyright|permission|permitted|redistribut|warrant|reserved|unencumbered|mpl"

# a sentence ends at its mark if white space or the end follows, and at the end of a line
_LINES = r"[.!?;]+(\s|$)|\n"
# ... or only at its mark, for sentences that are wrapped over lines
_WRAPPED = r"[.!?;]+(\s|$)|\n\s*\n"
# comment signs at the start of a line
_MARGIN = r"\n[ \t]*([#*/;%>]|--)+"

# number or letter of a clause, at the start of a line or after a sentence; "v. 2.0" is none
_MARKER = r"(\n|[.:;!?]\s)[ \t]*\(?(?!v\.\s*[0-9])([0-9]{1,3}|[a-z])[.)]\s+"
# an address in a paragraph of its own belongs to the sentence that leads to it
_ADDRESS = r"\bat:?\s+(https?:)"
# ends of clauses in wrapped notices, with and without the semicolon
_STOP = r"(?!(?<=\bv)\.\s+[0-9])[%s]+(\s|$)|:\s*\n|\n\s*\n"
_CLAUSES, _NOTICE = _STOP % ".!?;", _STOP % ".!?"


def without_margin(text: Column) -> Column:
    return F.regexp_replace(F.concat(F.lit("\n"), F.translate(text, UPPER, LOWER)), _MARGIN, "\n")


def without_markers(plain: Column) -> Column:
    """Each numbered or lettered clause begins a paragraph, without its number."""
    return F.regexp_replace(F.regexp_replace(plain, _MARKER, "$1\n\n"), _ADDRESS, "at $1")


def sentence_ids(plain: Column, ends: str) -> Column:
    """Identifiers of the sentences of a lower-cased (A-Z) text in order, ``?`` for unknown ones.

    In a sentence everything but a-z, 0-9 is one blank, and it is trimmed; empty ones are left out.
    """
    normal = lambda s: F.trim(F.regexp_replace(s, "[^a-z0-9]+", " "))
    found = F.filter(F.transform(F.split(plain, ends), normal), lambda s: s != "")
    known = F.create_map(*[F.lit(x) for name, s in SENTENCES.items() for x in (s, name)])
    return F.transform(found, lambda s: F.coalesce(F.element_at(known, s), F.lit("?")))


def match_rules(ids: Column) -> Column:
    """Licences of the rules that match a sequence of identifiers, in rule order.

    A rule matches where its identifiers stand next to each other; the
    identifiers it matched, everywhere in the text, are taken from later rules.
    """
    rest = F.concat(F.lit("|"), F.array_join(F.transform(ids, lambda x: F.concat(x, F.lit("|"))), "|"))
    taken = []
    state = F.struct(rest.alias("rest"), F.array().cast("array<string>").alias("found"))
    for name, sequence in RULES:
        taken.append(F.struct(F.lit("|" + "||".join(sequence) + "|").alias("p"), F.lit(name).alias("name")))

    def step(s, rule):
        hit = F.contains(s["rest"], rule["p"])
        return F.struct(
            F.replace(s["rest"], rule["p"], F.lit("|-|")).alias("rest"),
            F.when(hit, F.array_append(s["found"], rule["name"])).otherwise(s["found"]).alias("found"),
        )

    return F.aggregate(F.array(*taken), state, step)["found"]


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, n_known, sentences, licenses`` for every row of ``docs``.

    A text is cut into sentences at line ends and across wrapped lines, and twice more with the markers of
    numbered clauses dropped, where a semicolon does or does not end a sentence; each cut's known sentences are
    matched to the ordered ``RULES``. ``sentences`` lists the distinct identifiers found, ``licenses`` the distinct licences, both in
    alphabetical order and joined by a comma; ``n_known`` counts the distinct identifiers.

    Null and empty texts have none; repeated rows give repeated rows; an empty table gives an empty
    result; other columns are ignored. Everything is a built-in expression of one scan, without a shuffle.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    none = F.array().cast("array<string>")
    cue = F.rlike(F.translate(text, UPPER, LOWER), F.lit(CUES))
    rows = docs.select(F.col(id_col).alias("doc_id"), F.when(cue, without_margin(text)).alias("t"))
    rows = rows.select("doc_id", "t", without_markers(F.col("t")).alias("u"))
    cuts = {"a": ("t", _LINES), "b": ("t", _WRAPPED), "c": ("u", _CLAUSES), "d": ("u", _NOTICE)}
    rows = rows.select(
        "doc_id",
        *[F.when(F.col(t).isNotNull(), sentence_ids(F.col(t), ends)).otherwise(none).alias(c) for c, (t, ends) in cuts.items()],
    )
    known = F.array_sort(F.array_distinct(F.filter(F.concat(*cuts), lambda x: x != "?")))
    rows = rows.withColumn("known", known)
    found = F.when(F.size("known") > 0, F.array_sort(F.array_distinct(F.concat(*[match_rules(F.col(c)) for c in cuts])))).otherwise(none)
    return rows.select(
        "doc_id",
        F.size("known").cast("long").alias("n_known"),
        F.array_join("known", ",").alias("sentences"),
        F.array_join(found, ",").alias("licenses"),
    )


def oracle_sql() -> str:
    """The scan in DuckDB, rule by rule, by the first two cuts alone."""
    names = ", ".join(f"'{n}'" for n in SENTENCES)
    values = ", ".join(f"'{s}'" for s in SENTENCES.values())

    def ids(ends: str) -> str:
        plain = f"regexp_replace(chr(10) || translate(t, '{UPPER}', '{LOWER}'), '{_MARGIN}', chr(10), 'g')"
        return f"""list_transform(list_filter(list_transform(string_split_regex({plain}, '{ends}'),
            lambda s: trim(regexp_replace(s, '[^a-z0-9]+', ' ', 'g'))), lambda s: s <> ''),
            lambda s: coalesce(list_extract([{names}], list_position([{values}], s)), '?'))"""

    steps, last = [], "seq"
    for i, (name, sequence) in enumerate(RULES):
        p = "|" + "||".join(sequence) + "|"
        steps.append(
            f"""r{i} AS (SELECT r, doc_id, known, replace(rest, '{p}', '|-|') AS rest,
                CASE WHEN contains(rest, '{p}') THEN list_append(found, '{name}') ELSE found END AS found FROM {last})"""
        )
        last = f"r{i}"
    return f"""
    WITH docs AS (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS t FROM documents),
    cut AS (SELECT r, doc_id, {ids(_LINES)} AS a, {ids(_WRAPPED)} AS b FROM docs),
    both_cuts AS (SELECT r, doc_id, list_sort(list_distinct(list_filter(a || b, lambda x: x <> '?'))) AS known, unnest([a, b]) AS ids FROM cut),
    seq AS (SELECT r, doc_id, known, '|' || array_to_string(list_transform(ids, lambda x: x || '|'), '|') AS rest, []::VARCHAR[] AS found FROM both_cuts),
    {", ".join(steps)}
    SELECT doc_id, len(any_value(known))::BIGINT AS n_known, array_to_string(any_value(known), ',') AS sentences,
           coalesce(array_to_string(list_sort(list_distinct(flatten(list(found)))), ','), '') AS licenses
    FROM {last} GROUP BY r, doc_id
    """
