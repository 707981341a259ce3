"""Licence recognition: sentences to identifiers, identifier sequences to licences."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Normalised licence sentences and their identifiers. A sentence is found wherever its words
# follow each other, so it begins behind what differs from one header to the next.
SENTENCES = {
    "licensed under the apache license version 2.0": "APACHE2_LINE",
    "released under the apache license version 2.0": "APACHE2_LINE",
    "licensed under apache 2.0": "APACHE2_LINE",
    "you may not use this file except in compliance with the license": "APACHE_COMPLY",
    "you may obtain a copy of the license at": "APACHE_COPY",
    "unless required by applicable law or agreed to in writing software distributed under the"
    " license is distributed on an as is basis without warranties or conditions of any kind"
    " either express or implied": "APACHE_ASIS",
    "see the license for the specific language governing permissions and limitations under the"
    " license": "APACHE_SEE",
    "released under the mit license": "MIT_LINE",
    "licensed under the mit license": "MIT_LINE",
    "available under the mit license": "MIT_LINE",
    "distributed under the mit license": "MIT_LINE",
    "permission is hereby granted free of charge to any person obtaining a copy of this software"
    " and associated documentation files the software to deal in the software without restriction"
    " including without limitation the rights to use copy modify merge publish distribute"
    " sublicense and or sell copies of the software and to permit persons to whom the software is"
    " furnished to do so subject to the following conditions": "MIT_GRANT",
    "the above copyright notice and this permission notice shall be included in all copies or"
    " substantial portions of the software": "MIT_NOTICE",
    "permission to use copy modify and or distribute this software for any purpose with or without"
    " fee is hereby granted provided that the above copyright notice and this permission notice"
    " appear in all copies": "ISC_GRANT",
    "permission to use copy modify and distribute this software for any purpose with or without"
    " fee is hereby granted provided that the above copyright notice and this permission notice"
    " appear in all copies": "ISC_GRANT",
    "licensed under the isc license": "ISC_LINE",
    "released under the isc license": "ISC_LINE",
    "redistribution and use in source and binary forms with or without modification are permitted"
    " provided that the following conditions are met": "BSD_GRANT",
    "redistributions of source code must retain the above copyright notice this list of conditions"
    " and the following disclaimer": "BSD_SOURCE",
    "redistributions in binary form must reproduce the above copyright notice this list of"
    " conditions and the following disclaimer in the documentation and or other materials provided"
    " with the distribution": "BSD_BINARY",
    "neither the name of the copyright holder nor the names of its contributors may be used to"
    " endorse or promote products derived from this software without specific prior written"
    " permission": "BSD_ENDORSE",
    "licensed under the gnu general public license version 2": "GPL2_LINE",
    "licensed under the gnu general public license version 3": "GPL3_LINE",
    "licensed under the gnu lesser general public license version 2.1": "LGPL21_LINE",
    "licensed under the gnu lesser general public license version 3": "LGPL3_LINE",
    "licensed under the gnu affero general public license version 3": "AGPL3_LINE",
    "is free software you can redistribute it and or modify it under the terms of the gnu general"
    " public license version 2 as published by the free software foundation": "GPL2_GRANT",
    "is free software you can redistribute it and or modify it under the terms of the gnu general"
    " public license as published by the free software foundation either version 2 of the license"
    " or at your option any later version": "GPL2PLUS_GRANT",
    "is free software you can redistribute it and or modify it under the terms of the gnu general"
    " public license as published by the free software foundation either version 3 of the license"
    " or at your option any later version": "GPL3PLUS_GRANT",
    "is free software you can redistribute it and or modify it under the terms of the gnu lesser"
    " general public license as published by the free software foundation either version 2.1 of"
    " the license or at your option any later version": "LGPL21PLUS_GRANT",
    "is free software you can redistribute it and or modify it under the terms of the gnu lesser"
    " general public license as published by the free software foundation either version 3 of the"
    " license or at your option any later version": "LGPL3PLUS_GRANT",
    "is free software you can redistribute it and or modify it under the terms of the gnu affero"
    " general public license as published by the free software foundation either version 3 of the"
    " license or at your option any later version": "AGPL3PLUS_GRANT",
    "is distributed in the hope that it will be useful but without any warranty"
    " without even the implied warranty of merchantability or fitness for a particular"
    " purpose": "GNU_WARRANTY",
    "see the gnu general public license for more details": "GPL_SEE",
    "see the gnu lesser general public license for more details": "LGPL_SEE",
    "see the gnu affero general public license for more details": "AGPL_SEE",
    "you should have received a copy of the gnu general public license along with": "GPL_RECEIVED",
    "you should have received a copy of the gnu lesser general public license along with": "LGPL_RECEIVED",
    "you should have received a copy of the gnu affero general public license along with": "AGPL_RECEIVED",
    "this source code form is subject to the terms of the mozilla public license v": "MPL_LINE",
    "this source code form is subject to the terms of the mozilla public license v 2.0": "MPL2_LINE",
    "are made available under the terms of the eclipse public license 2.0": "EPL2_LINE",
    "are made available under the terms of the eclipse public license v 2.0": "EPL2_LINE",
    "are made available under the terms of the eclipse public license v2.0": "EPL2_LINE",
    "distributed under the boost software license version 1.0": "BSL1_LINE",
    "this is free and unencumbered software released into the public domain": "UNLICENSE_GRANT",
    "to the extent possible under law": "CC0_EXTENT",
    "has waived all copyright and related or neighboring rights to": "CC0_WAIVED",
    "licensed under cc by-nc 4.0": "CCBYNC4_LINE",
    "licensed under cc by 4.0": "CCBY4_LINE",
    "licensed under cc by-sa 4.0": "CCBYSA4_LINE",
    "licensed under a creative commons attribution-noncommercial 4.0 international license": "CCBYNC4_LINE",
    "licensed under a creative commons attribution 4.0 international license": "CCBY4_LINE",
    "licensed under a creative commons attribution-sharealike 4.0 international license": "CCBYSA4_LINE",
    "licensed under cc0 1.0": "CC0_LINE",
}
# Licences by the sequences of identifiers that grant them, the more specific first.
RULES = (
    ("Apache-2.0", ("APACHE2_LINE", "APACHE_COMPLY", "APACHE_COPY", "APACHE_ASIS", "APACHE_SEE")),
    ("Apache-2.0", ("APACHE2_LINE", "APACHE_COMPLY")),
    ("BSD-3-Clause", ("BSD_GRANT", "BSD_SOURCE", "BSD_BINARY", "BSD_ENDORSE")),
    ("BSD-2-Clause", ("BSD_GRANT", "BSD_SOURCE", "BSD_BINARY")),
    ("GPL-3.0-or-later", ("GPL3PLUS_GRANT", "GNU_WARRANTY", "GPL_SEE", "GPL_RECEIVED")),
    ("GPL-3.0-or-later", ("GPL3PLUS_GRANT",)),
    ("GPL-2.0-or-later", ("GPL2PLUS_GRANT", "GNU_WARRANTY", "GPL_SEE", "GPL_RECEIVED")),
    ("GPL-2.0-or-later", ("GPL2PLUS_GRANT",)),
    ("GPL-2.0-only", ("GPL2_GRANT", "GNU_WARRANTY", "GPL_SEE", "GPL_RECEIVED")),
    ("GPL-2.0-only", ("GPL2_GRANT", "GNU_WARRANTY", "GPL_SEE")),
    ("GPL-2.0-only", ("GPL2_GRANT",)),
    ("LGPL-2.1-or-later", ("LGPL21PLUS_GRANT", "GNU_WARRANTY", "LGPL_SEE", "LGPL_RECEIVED")),
    ("LGPL-2.1-or-later", ("LGPL21PLUS_GRANT",)),
    ("LGPL-3.0-or-later", ("LGPL3PLUS_GRANT", "GNU_WARRANTY", "LGPL_SEE", "LGPL_RECEIVED")),
    ("LGPL-3.0-or-later", ("LGPL3PLUS_GRANT",)),
    ("AGPL-3.0-or-later", ("AGPL3PLUS_GRANT", "GNU_WARRANTY", "AGPL_SEE", "AGPL_RECEIVED")),
    ("AGPL-3.0-or-later", ("AGPL3PLUS_GRANT",)),
    ("MIT", ("MIT_GRANT", "MIT_NOTICE")),
    ("MIT", ("MIT_LINE",)),
    ("ISC", ("ISC_GRANT",)),
    ("ISC", ("ISC_LINE",)),
    ("Apache-2.0", ("APACHE2_LINE",)),
    ("GPL-2.0-only", ("GPL2_LINE",)),
    ("GPL-3.0-only", ("GPL3_LINE",)),
    ("LGPL-2.1-only", ("LGPL21_LINE",)),
    ("LGPL-3.0-only", ("LGPL3_LINE",)),
    ("AGPL-3.0-only", ("AGPL3_LINE",)),
    ("CC-BY-NC-4.0", ("CCBYNC4_LINE",)),
    ("CC-BY-SA-4.0", ("CCBYSA4_LINE",)),
    ("CC-BY-4.0", ("CCBY4_LINE",)),
    ("CC0-1.0", ("CC0_EXTENT", "CC0_WAIVED")),
    ("CC0-1.0", ("CC0_LINE",)),
    ("MPL-2.0", ("MPL2_LINE",)),
    ("EPL-2.0", ("EPL2_LINE",)),
    ("BSL-1.0", ("BSL1_LINE",)),
    ("Unlicense", ("UNLICENSE_GRANT",)),
)
# A tag that names a licence by its short name says what the licence's one-sentence rule says.
TAG = "spdx-license-identifier"
_ALONE = {name: sequence[0] for name, sequence in RULES if len(sequence) == 1}
_TAGS = {name: _ALONE.get(name, f"TAG_{number}") for number, (name, _) in enumerate(RULES)}
SENTENCES |= {f"{TAG} {name.lower()}": identifier for name, identifier in _TAGS.items()}
RULES += tuple((name, (identifier,)) for name, identifier in _TAGS.items() if name not in _ALONE)
# Every known sentence has one of these words; a text without them is not searched.
HINT = "licen[sc]|permission|redistribut|copyright|warrant|public domain|possible under law"
# What stands between words; points, plus signs and hyphens stay only within a word, as in "2.0" and "by-nc".
NOISE = "[^a-z0-9.+-]+"
EDGES = "[.+-]+ | [.+-]+"


def sentence_trie() -> str:
    """All known sentences as one expression: a trie of words, over words two blanks apart.

    From a given word it matches the longest known sentence that begins there: branches differ in
    a whole word, and going on is tried before stopping. The blank on either side is part of the
    match, the other one of the pair is left to the neighbour.
    """
    root: dict = {}
    for sentence in SENTENCES:
        node = root
        for word in sentence.split():
            node = node.setdefault(word, {})
        node[""] = {}

    def expression(node: dict) -> str:
        ways = [
            re.escape(word).replace("\\-", "-") + follow(child)
            for word, child in sorted(node.items())
            if word
        ]
        return f"(?:{'|'.join(ways)})"

    def follow(node: dict) -> str:
        if set(node) == {""}:
            return ""
        return f"(?:  {expression(node)})?" if "" in node else f"  {expression(node)}"

    return f" {expression(root)} "


def _identifiers(text: Column) -> Column:
    """Identifiers of the known sentences in text order, wherever they stand.

    Lines, comment marks, quotes and sentence ends do not matter: only words are compared.
    """
    known = F.create_map(*[F.lit(x) for pair in SENTENCES.items() for x in pair])
    words = F.replace(F.regexp_replace(F.lower(text), NOISE, "  "), F.lit("licenc"), F.lit("licens"))
    words = F.regexp_replace(F.concat(F.lit(" "), words, F.lit(" ")), EDGES, " ")
    words = F.regexp_replace(words, " +", "  ")
    found = F.regexp_extract_all(words, F.lit(sentence_trie()), F.lit(0))
    return F.transform(found, lambda m: F.element_at(known, F.trim(F.replace(m, F.lit("  "), F.lit(" ")))))


def licence_scan(
    documents: DataFrame, id_column: str = "doc_id", text_column: str = "text"
) -> DataFrame:
    """(id, licences, n_known, n_unmatched): licences granted by the sentences of each text.

    Sentences are compared word by word, at any word of the text; the longest known one counts and
    the search goes on behind it. Rules are tried in order on the sequence of identifiers; what
    a rule matches is used up, so a general rule does not fire inside a specific one.
    ``licences`` are the names, once each, in code point order and comma-joined; ``n_known``
    counts known sentences and ``n_unmatched`` those that no rule used. Row by row with
    built-in functions; nothing is shuffled.

    Null and empty texts grant nothing. Rows with null or repeated ids are rows like any
    other; an empty table gives an empty result. Columns other than the two named are
    not carried.
    """
    text = F.coalesce(F.col(text_column), F.lit(""))
    none = F.expr("CAST(array() AS ARRAY<STRING>)")
    found = F.when(F.lower(text).rlike(HINT), _identifiers(text)).otherwise(none)
    rows = documents.select(F.col(id_column), found.alias("__known"))
    rows = rows.select(
        id_column,
        F.size("__known").alias("n_known"),
        F.concat(F.lit(";"), F.concat_ws(";;", "__known"), F.lit(";")).alias("__left"),
    )
    # A sequence of identifiers is a piece of the joined ones, each between its own semicolons.
    rows = rows.select(id_column, "n_known", "__left", none.alias("__names"))
    for name, sequence in RULES:
        piece = F.lit(";" + ";;".join(sequence) + ";")
        rows = rows.select(
            id_column,
            "n_known",
            F.replace("__left", piece, F.lit("|")).alias("__left"),
            F.when(F.contains("__left", piece), F.array_append("__names", F.lit(name)))
            .otherwise(F.col("__names"))
            .alias("__names"),
        )
    unmatched = F.regexp_count("__left", F.lit("[A-Z0-9_]+"))
    return rows.select(
        id_column,
        F.array_join(F.array_sort(F.array_distinct("__names")), ",").alias("licences"),
        "n_known",
        unmatched.alias("n_unmatched"),
    )
