"""Licence scan by sentence rules.

A text is cut into sentences, each is normalised and looked up among known licence sentences, and the
sequence of identifiers is matched against ordered rules; what a rule has matched later rules don't see.
All of it is SQL expressions. Texts without any of the words that every known sentence has one of are
passed by after a plain search.
"""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tellerlake.llm.tables import table

#: Each known sentence and whatever a pattern matches contains one of these, which have no
#: spaces, as texts may break the line or put other signs there.
KEYWORDS = (
    "licen", "copyright", "reserved", "warrant", "redistribut", "permission", "software", "liab", "bsd", "commons", "cc",
)

#: Known sentences as they read after normalisation, from the public licence texts.
SENTENCES = {
    "all rights reserved": "AllRights",
    "permission is hereby granted free of charge to any person obtaining a copy of this software and associated"
    " documentation files the software to deal in the software without restriction including without limitation the"
    " rights to use copy modify merge publish distribute sublicense and or sell copies of the software and to permit"
    " persons to whom the software is furnished to do so subject to the following conditions": "MitGrant",
    "the above copyright notice and this permission notice shall be included in all copies or substantial portions of"
    " the software": "MitNotice",
    "the software is provided as is without warranty of any kind express or implied including but not limited to the"
    " warranties of merchantability fitness for a particular purpose and noninfringement": "MitAsIs",
    "in no event shall the authors or copyright holders be liable for any claim damages or other liability whether in"
    " an action of contract tort or otherwise arising from out of or in connection with the software or the use or"
    " other dealings in the software": "MitLiability",
    "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby"
    " granted provided that the above copyright notice and this permission notice appear in all copies": "IscGrant",
    "the software is provided as is and the author disclaims all warranties with regard to this software including"
    " all implied warranties of merchantability and fitness": "IscAsIs",
    "redistribution and use in source and binary forms with or without modification are permitted provided that the"
    " following conditions are met": "BsdGrant",
    "redistributions of source code must retain the above copyright notice this list of conditions and the following"
    " disclaimer": "BsdSource",
    "redistributions in binary form must reproduce the above copyright notice this list of conditions and the"
    " following disclaimer in the documentation and or other materials provided with the distribution": "BsdBinary",
    "you may not use this file except in compliance with the license": "ApacheComply",
    "unless required by applicable law or agreed to in writing software distributed under the license is distributed"
    " on an as is basis without warranties or conditions of any kind either express or implied": "ApacheAsIs",
    "see the license for the specific language governing permissions and limitations under the license": "ApacheSee",
    "this program is free software": "GplFree",
    "this program is distributed in the hope that it will be useful but without any warranty without even the implied"
    " warranty of merchantability or fitness for a particular purpose": "GplHope",
    "see the gnu general public license for more details": "GplSee",
    "this is free and unencumbered software released into the public domain": "Unlicense",
}

_GIVEN = r"^((this|the) [a-z]+ )?(is )?(dual )?(licensed|released|distributed|available|provided|published|made available)"
_NAMED = _GIVEN + r"( to you)? under (the )?((terms|conditions) of )?(the )?"

#: Patterns of sentences with variable parts, first match wins.
PATTERNS = (
    (r"^(portions )?copyright (c )?[0-9]{4}( |$)", "Copyright"),
    (_NAMED + r"mit( x11)? licen[cs]e$", "NamedMit"),
    (_NAMED + r"(new|modified|3 clause|revised) bsd licen[cs]e$|" + _NAMED + r"bsd 3 clause( licen[cs]e)?$", "NamedBsd3"),
    (_NAMED + r"(simplified|2 clause|freebsd) bsd licen[cs]e$|" + _NAMED + r"bsd 2 clause( licen[cs]e)?$", "NamedBsd2"),
    (_NAMED + r"apache (software )?licen[cs]e( version)? 2( 0)?( the license)?$", "NamedApache2"),
    (_NAMED + r"mozilla public licen[cs]e( version)?( v)? ?2( 0)?$", "NamedMpl2"),
    (_NAMED + r"gnu affero general public licen[cs]e( version)?( v)? ?3( 0)?$", "NamedAgpl3"),
    (_NAMED + r"gnu lesser general public licen[cs]e( version)?( v)? ?3( 0)?$", "NamedLgpl3"),
    (_NAMED + r"gnu general public licen[cs]e( version)?( v)? ?3( 0)?( or (any )?later( version)?)$", "NamedGpl3Later"),
    (_NAMED + r"gnu general public licen[cs]e( version)?( v)? ?3( 0)?$", "NamedGpl3"),
    (_NAMED + r"gnu general public licen[cs]e( version)?( v)? ?2( 0)?$", "NamedGpl2"),
    (r"you can redistribute it and or modify it under the terms of the gnu general public licen[cs]e .*version 3 .*later version$", "Gpl3Later"),
    (r"you can redistribute it and or modify it under the terms of the gnu general public licen[cs]e .*version 2 .*later version$", "Gpl2Later"),
    (_NAMED + r"(cc|creative commons) ?by nc sa 4 0( .*)?$", "NamedCcByNcSa4"),
    (_NAMED + r"(cc|creative commons) ?by nc nd 4 0( .*)?$", "NamedCcByNcNd4"),
    (_NAMED + r"(cc|creative commons) ?by nc 4 0( .*)?$", "NamedCcByNc4"),
    (_NAMED + r"(cc|creative commons) ?by sa 4 0( .*)?$", "NamedCcBySa4"),
    (_NAMED + r"(cc|creative commons) ?by nd 4 0( .*)?$", "NamedCcByNd4"),
    (_NAMED + r"(cc|creative commons) ?by 4 0( .*)?$", "NamedCcBy4"),
    (r"^spdx license identifier mit$", "NamedMit"),
    (r"^spdx license identifier apache 2 0$", "NamedApache2"),
    (r"^spdx license identifier bsd 3 clause$", "NamedBsd3"),
    (r"^spdx license identifier bsd 2 clause$", "NamedBsd2"),
    (r"^spdx license identifier gpl 3 0( only)?$", "NamedGpl3"),
    (r"^spdx license identifier gpl 3 0 or later$", "NamedGpl3Later"),
    (r"^neither the name of .* nor the names of (its|the) (copyright holders? nor )?contributors may be used to endorse or promote products derived from this software without specific prior written permission$", "BsdEndorse"),
    (r"^this software is provided by .* as is and any express or implied warranties including .* are disclaimed$", "BsdAsIs"),
    (r"^in no event shall .* be liable for any direct indirect incidental special exemplary or consequential damages .*$", "BsdLiability"),
    (r"^you may obtain a copy of the license at( .*)?$", "ApacheObtain"),
    (r"^you should have received a copy of the gnu general public license along with this program( .*)?$", "GplCopy"),
)

#: Rules in order: a licence and the sentences that make it, one after the other.
RULES = (
    ("MIT", ("MitGrant", "MitNotice", "MitAsIs", "MitLiability")),
    ("MIT", ("MitGrant", "MitNotice")),
    ("ISC", ("IscGrant", "IscAsIs")),
    ("ISC", ("IscGrant",)),
    ("BSD-3-Clause", ("BsdGrant", "BsdSource", "BsdBinary", "BsdEndorse")),
    ("BSD-2-Clause", ("BsdGrant", "BsdSource", "BsdBinary")),
    ("Apache-2.0", ("NamedApache2", "ApacheComply", "ApacheObtain", "ApacheAsIs", "ApacheSee")),
    ("Apache-2.0", ("NamedApache2",)),
    ("GPL-3.0-or-later", ("GplFree", "Gpl3Later", "GplHope", "GplSee", "GplCopy")),
    ("GPL-3.0-or-later", ("GplFree", "Gpl3Later")),
    ("GPL-3.0-or-later", ("Gpl3Later",)),
    ("GPL-2.0-or-later", ("GplFree", "Gpl2Later")),
    ("GPL-2.0-or-later", ("Gpl2Later",)),
    ("GPL-3.0-or-later", ("NamedGpl3Later",)),
    ("GPL-3.0", ("NamedGpl3",)),
    ("GPL-2.0", ("NamedGpl2",)),
    ("AGPL-3.0", ("NamedAgpl3",)),
    ("LGPL-3.0", ("NamedLgpl3",)),
    ("MPL-2.0", ("NamedMpl2",)),
    ("MIT", ("NamedMit",)),
    ("BSD-3-Clause", ("NamedBsd3",)),
    ("BSD-2-Clause", ("NamedBsd2",)),
    ("CC-BY-NC-SA-4.0", ("NamedCcByNcSa4",)),
    ("CC-BY-NC-ND-4.0", ("NamedCcByNcNd4",)),
    ("CC-BY-NC-4.0", ("NamedCcByNc4",)),
    ("CC-BY-SA-4.0", ("NamedCcBySa4",)),
    ("CC-BY-ND-4.0", ("NamedCcByNd4",)),
    ("CC-BY-4.0", ("NamedCcBy4",)),
    ("Unlicense", ("Unlicense",)),
    ("all-rights-reserved", ("Copyright", "AllRights")),
    ("all-rights-reserved", ("AllRights",)),
)


def _quoted(text: str) -> str:
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def _marks(sentences) -> str:
    return "".join(f"<{s}>" for s in sentences)


def _identifier(text: str) -> str:
    """SQL: the identifier of the known sentence that the lower-case ``text`` is, or null."""
    known = "MAP(" + ", ".join(f"{_quoted(k)}, {_quoted(v)}" for k, v in SENTENCES.items()) + ")"
    cases = " ".join(f"WHEN s RLIKE {_quoted(p)} THEN {_quoted(i)}" for p, i in PATTERNS)
    plain = f"ARRAY(TRIM(REGEXP_REPLACE({text}, '[^a-z0-9]+', ' ')))"
    return f"ELEMENT_AT(TRANSFORM({plain}, s -> COALESCE(ELEMENT_AT({known}, s), CASE {cases} END)), 1)"


def _holds(text: str) -> str:
    return "(" + " OR ".join(f"CONTAINS({text}, {_quoted(k)})" for k in KEYWORDS) + ")"


def scan(docs: DataFrame) -> DataFrame:
    """(doc_id, sentences, licences) of every row: identifiers and licences in order, joined by commas.

    A piece ends with a full stop, question or exclamation mark or colon before white space, or at an
    empty line. It is one sentence that may run over lines; if that is not known, or if two or more of its
    lines are known sentences of their own, its lines are read one by one. Each rule names its licence
    once a text. Null or empty texts, and texts with nothing known, give two empty strings; texts of any
    length are read to their end; repeated rows stay; an empty table gives no rows; other columns are ignored.
    """
    lower = docs.select("doc_id", F.lower(F.col("text").cast("string")).alias("low"))
    none = "CAST(ARRAY() AS ARRAY<STRING>)"
    ends = "REGEXP_REPLACE(REGEXP_REPLACE(low, '\\n[ \\t\\r]*\\n', '\\u0001'), '([.!?:])\\\\s+', '$1\\u0001')"
    pieces = f"FILTER(SPLIT({ends}, '\\u0001'), p -> {_holds('p')})"
    lines = f"TRANSFORM(FILTER(SPLIT(p, '\\n'), l -> {_holds('l')}), l -> {_identifier('l')})"
    readings = (
        f"TRANSFORM({pieces}, p -> STRUCT({_identifier('p')} AS whole, CASE WHEN CONTAINS(p, '\\n')"
        f" THEN FILTER({lines}, i -> i IS NOT NULL) ELSE {none} END AS lines))"
    )
    found = (
        lower.selectExpr("doc_id", f"CASE WHEN {_holds('low')} THEN {readings} END AS f")
        .selectExpr(
            "doc_id", "FLATTEN(TRANSFORM(f, r -> CASE WHEN SIZE(r.lines) > 1 OR r.whole IS NULL THEN r.lines ELSE ARRAY(r.whole) END)) AS ids"
        )
        .selectExpr("doc_id", f"COALESCE(ids, {none}) AS ids")
    )
    rules = ", ".join(f"STRUCT({_quoted(name)} AS name, {_quoted(_marks(ids))} AS marks)" for name, ids in RULES)
    matched = (
        f"AGGREGATE(ARRAY({rules}), STRUCT(CONCAT('<', ARRAY_JOIN(ids, '><'), '>') AS left, {none} AS names),"
        " (a, r) -> IF(CONTAINS(a.left, r.marks), STRUCT(REPLACE(a.left, r.marks, '|') AS left,"
        " ARRAY_APPEND(a.names, r.name) AS names), a), a -> a.names)"
    )
    return found.selectExpr(
        "doc_id",
        "ARRAY_JOIN(ids, ',') AS sentences",
        f"CASE WHEN SIZE(ids) = 0 THEN '' ELSE ARRAY_JOIN(ARRAY_DISTINCT({matched}), ',') END AS licences",
    )


def _duck(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def oracle() -> str:
    """The scan of ``documents`` in DuckDB's SQL."""
    cases = " ".join(f"WHEN regexp_matches(s, {_duck(p)}) THEN {_duck(i)}" for p, i in PATTERNS)
    names = "CASE " + " ".join(f"WHEN s = {_duck(k)} THEN {_duck(v)}" for k, v in SENTENCES.items()) + f" {cases} END"
    holds = " OR ".join(f"contains(t, {_duck(k)})" for k in KEYWORDS)
    ends = "regexp_replace(regexp_replace(low, '\\n[ \\t\\r]*\\n', chr(1), 'g'), '([.!?:])\\s+', '\\1' || chr(1), 'g')"
    steps = []
    for k, (name, ids) in enumerate(RULES):
        marks = _duck(_marks(ids))
        steps.append(
            f"r{k} AS (SELECT doc_id, sentences, replace(marks, {marks}, '|') AS marks,"
            f" CASE WHEN contains(marks, {marks}) AND NOT list_contains(names, {_duck(name)})"
            f" THEN list_append(names, {_duck(name)}) ELSE names END AS names FROM {f'r{k - 1}' if k else 'seq'})"
        )
    return f"""
WITH low AS (SELECT doc_id, lower(text) AS low FROM documents),
likely AS (SELECT doc_id, low FROM low WHERE {holds.replace('contains(t,', 'contains(low,')}),
cuts AS (SELECT doc_id, string_split({ends}, chr(1)) AS parts FROM likely),
pieces AS (SELECT doc_id, unnest(parts) AS t, generate_subscripts(parts, 1) AS spot FROM cuts),
parted AS (SELECT doc_id, spot, t, string_split(t, chr(10)) AS parts FROM pieces WHERE {holds}),
read AS (SELECT doc_id, spot, 0 AS line, t FROM parted
  UNION ALL SELECT doc_id, spot, generate_subscripts(parts, 1) AS line, unnest(parts) AS t FROM parted WHERE len(parts) > 1),
plain AS (SELECT doc_id, spot, line, trim(regexp_replace(t, '[^a-z0-9]+', ' ', 'g')) AS s FROM read WHERE {holds}),
named AS (SELECT doc_id, spot, line, {names} AS id FROM plain),
picked AS (SELECT doc_id, spot, line, id, count(*) FILTER (line > 0) OVER (PARTITION BY doc_id, spot) AS n_lines,
  count(*) FILTER (line = 0) OVER (PARTITION BY doc_id, spot) AS n_whole FROM named WHERE id IS NOT NULL),
seq AS (SELECT doc_id, string_agg(id, ',' ORDER BY spot, line) AS sentences,
  string_agg('<' || id || '>', '' ORDER BY spot, line) AS marks, CAST([] AS VARCHAR[]) AS names
  FROM picked WHERE (line > 0) = (n_lines > 1 OR n_whole = 0) GROUP BY doc_id),
{', '.join(steps)}
SELECT d.doc_id, coalesce(r.sentences, '') AS sentences, coalesce(array_to_string(r.names, ','), '') AS licences
FROM documents d LEFT JOIN r{len(RULES) - 1} r ON d.doc_id = r.doc_id
"""


def op1_licences(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan(table(spark, sf_dir, "documents"))
