"""Licence recognition by sentences.

A text is split into sentences, each is normalised and looked up in a table of known
licence sentences, and the sequence of their identifiers is matched against ordered
licence rules: a rule is the identifiers of neighbouring sentences, and what an earlier
rule has matched is not open to a later one.

Sentences end at full stops, question or exclamation marks before a blank or the end,
and at line ends, unless the next line begins with a small letter, a bracket or a quote
(wrapped lines). They are normalised to small letters and digits with single blanks.

Defined cases: null and empty texts and texts without licence sentences give no rows. A
sentence that speaks of a licence but is not known gives licence `unknown`. Repeated
rows are scanned each for itself, so they give repeated results. Extra columns do not
matter: nothing but the two named is read.
"""

from __future__ import annotations

import string

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Sentences of public licences and of the usual notices, by identifier (as they are cut: one ends
# in an abbreviation).
SENTENCES = {
    "mit-notice": "Released under the MIT License",
    "mit-notice-2": "Licensed under the MIT License",
    "mit-notice-3": "This project is licensed under the MIT License",
    "mit-grant": "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions: The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software",
    "as-is": "THE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT",
    "no-liability": "IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE",
    "apache-2-notice": "Licensed under the Apache License, Version 2.0",
    "apache-2-header": "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License",
    "apache-copy": "You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied",
    "see-license": "See the License for the specific language governing permissions and limitations under the License",
    "gpl-3-notice": "This work is licensed under the GNU General Public License, version 3",
    "gpl-3-grant": "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version",
    "gpl-2-grant": "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation; either version 2 of the License, or (at your option) any later version",
    "gnu-hope": "This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE",
    "gpl-details": "See the GNU General Public License for more details",
    "gpl-received": "You should have received a copy of the GNU General Public License along with this program",
    "mpl-2-notice": "This Source Code Form is subject to the terms of the Mozilla Public License, v",
    "cc-by-nc-4-notice": "Licensed under CC BY-NC 4.0",
    "cc-by-4-notice": "Licensed under CC BY 4.0",
    "cc-by-sa-4-notice": "Licensed under CC BY-SA 4.0",
    "cc0-notice": "Released under CC0 1.0",
    "all-rights": "All rights reserved",
    "gpl-2-notice": "This work is licensed under the GNU General Public License, version 2",
    "agpl-3-grant": "This program is free software: you can redistribute it and/or modify it under the terms of the GNU Affero General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version",
    "agpl-details": "See the GNU Affero General Public License for more details",
    "agpl-received": "You should have received a copy of the GNU Affero General Public License along with this program",
    "lgpl-2.1-grant": "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation; either version 2.1 of the License, or (at your option) any later version",
    "lgpl-3-grant": "This library is free software: you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version",
    "gnu-library-hope": "This library is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE",
    "lgpl-details": "See the GNU Lesser General Public License for more details",
    "lgpl-received": "You should have received a copy of the GNU Lesser General Public License along with this library",
    "mpl-2-version": "2.0",
    "mpl-2-copy": "If a copy of the MPL was not distributed with this file, You can obtain one at http://mozilla.org/MPL/2.0/",
    "mpl-2-copy-2": "If a copy of the MPL was not distributed with this file, You can obtain one at https://mozilla.org/MPL/2.0/",
    "bsd-grant": "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:",
    "bsd-source": "Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer",
    "bsd-binary": "Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution",
    "bsd-endorse": "Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission",
    "bsd-as-is": "THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS \"AS IS\" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED",
    "bsd-no-liability": "IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE",
    "bsd-2-notice": "Licensed under the BSD 2-Clause License",
    "bsd-3-notice": "Licensed under the BSD 3-Clause License",
    "isc-grant": "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies",
    "isc-as-is": "THE SOFTWARE IS PROVIDED \"AS IS\" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS",
    "isc-no-liability": "IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE",
    "isc-notice": "Licensed under the ISC License",
    "unlicense-public": "This is free and unencumbered software released into the public domain",
    "unlicense-grant": "Anyone is free to copy, modify, publish, use, compile, sell, or distribute this software, either in source code form or as a compiled binary, for any purpose, commercial or non-commercial, and by any means",
    "zlib-as-is": "This software is provided 'as-is', without any express or implied warranty",
    "zlib-no-liability": "In no event will the authors be held liable for any damages arising from the use of this software",
    "zlib-grant": "Permission is granted to anyone to use this software for any purpose, including commercial applications, and to alter it and redistribute it freely, subject to the following restrictions:",
    "boost-notice": "Distributed under the Boost Software License, Version 1.0",
    "cc-by-nd-4-notice": "Licensed under CC BY-ND 4.0",
    "cc-by-nc-sa-4-notice": "Licensed under CC BY-NC-SA 4.0",
    "cc-by-nc-nd-4-notice": "Licensed under CC BY-NC-ND 4.0",
    "cc-by-4-work": "This work is licensed under a Creative Commons Attribution 4.0 International License",
    "cc-by-sa-4-work": "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License",
    "cc-by-nc-4-work": "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License",
    "cc-by-nd-4-work": "This work is licensed under a Creative Commons Attribution-NoDerivatives 4.0 International License",
    "cc-by-nc-sa-4-work": "This work is licensed under a Creative Commons Attribution-NonCommercial-ShareAlike 4.0 International License",
    "cc-by-nc-nd-4-work": "This work is licensed under a Creative Commons Attribution-NonCommercial-NoDerivatives 4.0 International License",
}

#: (licence, rule): identifiers of neighbouring sentences. Earlier rules win.
RULES = [
    ("MIT", ("mit-grant", "as-is", "no-liability")),
    ("Apache-2.0", ("apache-2-header", "apache-copy", "see-license")),
    ("GPL-3.0-or-later", ("gpl-3-grant", "gnu-hope", "gpl-details", "gpl-received")),
    ("GPL-2.0-or-later", ("gpl-2-grant", "gnu-hope", "gpl-details", "gpl-received")),
    ("GPL-3.0-or-later", ("gpl-3-grant", "gnu-hope", "gpl-details")),
    ("GPL-2.0-or-later", ("gpl-2-grant", "gnu-hope", "gpl-details")),
    ("AGPL-3.0-or-later", ("agpl-3-grant", "gnu-hope", "agpl-details", "agpl-received")),
    ("LGPL-2.1-or-later", ("lgpl-2.1-grant", "gnu-library-hope", "lgpl-details", "lgpl-received")),
    ("LGPL-3.0-or-later", ("lgpl-3-grant", "gnu-library-hope", "lgpl-details", "lgpl-received")),
    ("AGPL-3.0-or-later", ("agpl-3-grant", "gnu-hope", "agpl-details")),
    ("LGPL-2.1-or-later", ("lgpl-2.1-grant", "gnu-library-hope", "lgpl-details")),
    ("LGPL-3.0-or-later", ("lgpl-3-grant", "gnu-library-hope", "lgpl-details")),
    ("BSD-3-Clause", ("bsd-grant", "bsd-source", "bsd-binary", "bsd-endorse", "bsd-as-is", "bsd-no-liability")),
    ("BSD-2-Clause", ("bsd-grant", "bsd-source", "bsd-binary", "bsd-as-is", "bsd-no-liability")),
    ("BSD-3-Clause", ("bsd-grant", "bsd-source", "bsd-binary", "bsd-endorse")),
    ("BSD-2-Clause", ("bsd-grant", "bsd-source", "bsd-binary")),
    ("ISC", ("isc-grant", "isc-as-is", "isc-no-liability")),
    ("MPL-2.0", ("mpl-2-notice", "mpl-2-version", "mpl-2-copy")),
    ("MPL-2.0", ("mpl-2-notice", "mpl-2-version", "mpl-2-copy-2")),
    ("Zlib", ("zlib-as-is", "zlib-no-liability", "zlib-grant")),
    ("Unlicense", ("unlicense-public", "unlicense-grant")),
    ("MIT", ("mit-grant",)),
    ("GPL-3.0-or-later", ("gpl-3-grant",)),
    ("GPL-2.0-or-later", ("gpl-2-grant",)),
    ("Apache-2.0", ("apache-2-header",)),
    ("Apache-2.0", ("apache-2-notice",)),
    ("GPL-3.0", ("gpl-3-notice",)),
    ("MIT", ("mit-notice",)),
    ("MIT", ("mit-notice-2",)),
    ("MIT", ("mit-notice-3",)),
    ("MPL-2.0", ("mpl-2-notice",)),
    ("CC-BY-NC-4.0", ("cc-by-nc-4-notice",)),
    ("CC-BY-SA-4.0", ("cc-by-sa-4-notice",)),
    ("CC-BY-4.0", ("cc-by-4-notice",)),
    ("CC0-1.0", ("cc0-notice",)),
    ("all-rights-reserved", ("all-rights",)),
    ("GPL-2.0", ("gpl-2-notice",)),
    ("AGPL-3.0-or-later", ("agpl-3-grant",)),
    ("LGPL-2.1-or-later", ("lgpl-2.1-grant",)),
    ("LGPL-3.0-or-later", ("lgpl-3-grant",)),
    ("MPL-2.0", ("mpl-2-copy",)),
    ("MPL-2.0", ("mpl-2-copy-2",)),
    ("BSD-2-Clause", ("bsd-2-notice",)),
    ("BSD-3-Clause", ("bsd-3-notice",)),
    ("ISC", ("isc-grant",)),
    ("ISC", ("isc-notice",)),
    ("Unlicense", ("unlicense-public",)),
    ("BSL-1.0", ("boost-notice",)),
    ("CC-BY-ND-4.0", ("cc-by-nd-4-notice",)),
    ("CC-BY-NC-SA-4.0", ("cc-by-nc-sa-4-notice",)),
    ("CC-BY-NC-ND-4.0", ("cc-by-nc-nd-4-notice",)),
    ("CC-BY-4.0", ("cc-by-4-work",)),
    ("CC-BY-SA-4.0", ("cc-by-sa-4-work",)),
    ("CC-BY-NC-4.0", ("cc-by-nc-4-work",)),
    ("CC-BY-ND-4.0", ("cc-by-nd-4-work",)),
    ("CC-BY-NC-SA-4.0", ("cc-by-nc-sa-4-work",)),
    ("CC-BY-NC-ND-4.0", ("cc-by-nc-nd-4-work",)),
]

WRAPPED = "\\n[ \\t]*([a-z(\"])"
SENTENCE_END = "[.!?]+([ \\t\\n\\r\\f]+|\\z)|\\n+"
NOT_PLAIN = "[^a-z0-9]+"
SPEAKS_OF = "(^| )(licen[sc]ed?|copyright)( |$)"
UNKNOWN, GAP = "unknown", "<.>"


def plain(sentence: str) -> str:
    """The normal form of a known sentence, as `normalised` makes it of a column."""
    kept = [c if c in string.ascii_lowercase + string.digits else " " for c in
            sentence.translate(str.maketrans(string.ascii_uppercase, string.ascii_lowercase))]
    return " ".join("".join(kept).split())


def normalised(sentence: Column) -> Column:
    lower = F.translate(sentence, string.ascii_uppercase, string.ascii_lowercase)
    return F.trim(F.regexp_replace(lower, NOT_PLAIN, " "))


def known_sentences(docs: DataFrame, id_col: str, text_col: str, sentences: dict[str, str]) -> DataFrame:
    """(row, doc_id, pos, id): each licence sentence of each text with its place."""
    spark = docs.sparkSession
    known = spark.createDataFrame([(plain(s), i) for i, s in sentences.items()], "sentence string, id string")
    unwrapped = F.regexp_replace(F.col(text_col), WRAPPED, " $1")
    parts = F.transform(F.split(unwrapped, SENTENCE_END), normalised)
    # The row is numbered before its sentences become rows.
    rows = docs.select(
        F.monotonically_increasing_id().alias("row"),
        F.col(id_col).alias("doc_id"),
        F.filter(parts, lambda s: s != "").alias("sentences"),
    )
    found = rows.select("row", "doc_id", F.posexplode("sentences").alias("pos", "sentence"))
    # The table of known sentences is a parameter of a few dozen rows.
    return (
        found.join(F.broadcast(known), "sentence", "left")
        .filter(F.col("id").isNotNull() | F.col("sentence").rlike(SPEAKS_OF))
        .select("row", "doc_id", "pos", F.coalesce("id", F.lit(UNKNOWN)).alias("id"))
    )


def scan(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    sentences: dict[str, str] = SENTENCES,
    rules: list[tuple[str, tuple[str, ...]]] = RULES,
) -> DataFrame:
    """(doc_id, licence, rule, matches): the licence rules that each text matches, and how
    often. See the module for how special cases are treated."""
    hits = known_sentences(docs, id_col, text_col, sentences)
    per_text = hits.groupBy("row", "doc_id").agg(
        F.sort_array(F.collect_list(F.struct("pos", "id"))).alias("hits")
    )
    hit = F.col("hits")

    def marked(x, i):
        follows = (i > 0) & (x["pos"] == F.get(hit, i - 1)["pos"] + 1)
        return F.concat(F.when(follows, "").otherwise(GAP), F.lit("<"), x["id"], F.lit(">"))

    left = F.array_join(F.transform(hit, marked), "")
    # Each rule counts its sequence in what earlier rules have left, then takes it out. The rules are an array of
    # constants that is folded, so the plan stays as small with any number of them.
    every = F.array(
        *(
            F.struct(
                F.lit(licence).alias("licence"),
                F.lit("+".join(ids)).alias("rule"),
                F.lit("".join(f"<{i}>" for i in ids)).alias("wanted"),
            )
            for licence, ids in [*rules, (UNKNOWN, (UNKNOWN,))]
        )
    )
    nothing = F.struct(left.alias("left"), F.lit([]).cast("array<struct<licence: string, rule: string, matches: int>>").alias("found"))

    def applied(state, rule):
        rest = F.replace(state["left"], rule["wanted"], F.lit(GAP))
        each = F.length(rule["wanted"]) - len(GAP)
        matches = ((F.length(state["left"]) - F.length(rest)) / each).cast("int").alias("matches")
        one = F.array(F.struct(rule["licence"].alias("licence"), rule["rule"].alias("rule"), matches))
        found = F.when(F.contains(state["left"], rule["wanted"]), F.concat(state["found"], one)).otherwise(state["found"])
        return F.struct(rest.alias("left"), found.alias("found"))

    matched = F.aggregate(every, nothing, applied)["found"]
    return per_text.select("doc_id", F.explode(matched).alias("m")).select("doc_id", "m.licence", "m.rule", "m.matches")
