"""Licence scan by sentences, in DataFrame functions only.

A text is cut into sentences, each is normalised (lower case, letters and digits only) and looked
up among known licence sentences, which gives an identifier. The identifiers of a text, in order,
are matched against rules: a rule is a licence and the sequence of sentences that grants it. A
known sentence with inner stops has an identifier for each part, and a rule asks for all of them.
Longer rules go first and use up what they match, so a notice that is part of a longer one does
not count twice; identifiers that no rule uses are reported as left over. Sentences of a sequence
stand at most ``max_gap`` sentences apart.

Lines are read in two ways: a line that begins with a small letter goes on with the sentence of the
line before, or also one that begins otherwise after a line without a stop. A row
counts in the way that recognises more sentences (the first one if none does). ``notice`` turns the
plain text of a licence notice into sentences and a rule of its own.

Only recognised sentences shuffle, and the known sentences are a fixed list, which is broadcast.

Null or empty text, or one without a known sentence: no licences, empty lists. A sentence that
occurs several times counts each time. Rows with equal ids are one document: their sentences are
taken together, each row's in order, rows by the hash of their text, equal rows one after the
other. A null id is a document too.
Extra columns are not read.
"""

from __future__ import annotations

import itertools
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gaugeworks.session import materialise

MAX_GAP = 3

# Known licence sentences in plain text, by identifier.
SENTENCES = (
    ("reserved", "All rights reserved."),
    ("mit-title", "The MIT License (MIT)"),
    ("mit-title", "MIT License"),
    ("mit-ref", "Released under the MIT License."),
    ("mit-ref", "Licensed under the MIT License."),
    ("mit-grant", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions"),
    ("mit-notice", "The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software."),
    ("as-is", "THE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT."),
    ("apache2-ref", "Licensed under the Apache License, Version 2.0."),
    ("apache2-head", "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License."),
    ("apache2-copy", "You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0"),
    ("bsd-grant", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met"),
    ("bsd-source", "Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer."),
    ("bsd-binary", "Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution."),
    ("gpl3-ref", "This work is licensed under the GNU General Public License, version 3."),
    ("bsd-advert", "All advertising materials mentioning features or use of this software must display the following acknowledgement:"),
    ("bsd-advert", "All advertising materials mentioning features or use of this software must display the following acknowledgment:"),
    ("bsd-names", "Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission."),
    ("bsd-names", "Neither the name of the owner nor the names of his contributors may be used to endorse or promote products derived from this software without specific prior written permission."),
    ("bsd-names", "Neither the name of the owner nor the names of their contributors may be used to endorse or promote products derived from this software without specific prior written permission."),
    ("bsd-names", "Neither the name of the owner nor the names of contributors may be used to endorse or promote products derived from this software without specific prior written permission."),
    ("bsd-names", "Neither the name of the owner nor the names of any contributors may be used to endorse or promote products derived from this software without specific prior written permission."),
    ("bsd-names", "The name of the author may not be used to endorse or promote products derived from this software without specific prior written permission."),
    ("gpl2-free", "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation; either version 2 of the License, or (at your option) any later version."),
    ("gpl2-free", "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 2 of the License, or (at your option) any later version."),
    ("gpl-free", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version."),
    ("gpl-free", "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation; either version 3 of the License, or (at your option) any later version."),
    ("agpl3-free", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU Affero General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version."),
    ("agpl3-free", "This program is free software; you can redistribute it and/or modify it under the terms of the GNU Affero General Public License as published by the Free Software Foundation; either version 3 of the License, or (at your option) any later version."),
    ("gpl-hope", "This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE."),
    ("cc-by-nc4-ref", "Licensed under CC BY-NC 4.0."),
    ("cc-by4-ref", "Licensed under CC BY 4.0."),
    ("cc-by-sa4-ref", "Licensed under CC BY-SA 4.0."),
    ("cc-by4-words", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    ("cc-by4-words", "This work is licensed under the Creative Commons Attribution 4.0 International License."),
    ("cc-by-sa4-words", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License."),
    ("cc-by-sa4-words", "This work is licensed under the Creative Commons Attribution-ShareAlike 4.0 International License."),
    ("cc-by-nc4-words", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License."),
    ("cc-by-nc4-words", "This work is licensed under the Creative Commons Attribution-NonCommercial 4.0 International License."),
    ("lgpl21-free", "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation; either version 2.1 of the License, or (at your option) any later version."),
    ("lgpl3-free", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version."),
    ("lgpl3-free", "This library is free software: you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version."),
    ("lgpl3-free", "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation; either version 3 of the License, or (at your option) any later version."),
    ("mpl2-head", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
    ("isc-grant", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies."),
    ("isc-grant", "Permission to use, copy, modify, and distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies."),
    ("0bsd-grant", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted."),
    ("unlicense-head", "This is free and unencumbered software released into the public domain."),
    ("zlib-head", "This software is provided 'as-is', without any express or implied warranty."),
    ("zlib-grant", "Permission is granted to anyone to use this software for any purpose, including commercial applications, and to alter it and redistribute it freely, subject to the following restrictions:"),
    ("boost-ref", "Distributed under the Boost Software License, Version 1.0."),
    ("boost-grant", "Permission is hereby granted, free of charge, to any person or organization obtaining a copy of the software and accompanying documentation covered by this license (the \"Software\") to use, reproduce, display, distribute, execute, and transmit the Software, and to prepare derivative works of the Software, and to permit third-parties to whom the Software is furnished to do so, all subject to the following:"),
    ("epl2-ref", "This program and the accompanying materials are made available under the terms of the Eclipse Public License 2.0 which is available at https://www.eclipse.org/legal/epl-2.0/"),
    ("epl2-ref", "This program and the accompanying materials are made available under the terms of the Eclipse Public License 2.0 which is available at http://www.eclipse.org/legal/epl-2.0/"),
    ("epl2-ref", "This program and the accompanying materials are made available under the terms of the Eclipse Public License 2.0 which accompanies this distribution, and is available at https://www.eclipse.org/legal/epl-2.0/"),
    ("epl2-ref", "This program and the accompanying materials are made available under the terms of the Eclipse Public License 2.0 which accompanies this distribution, and is available at https://www.eclipse.org/org/documents/epl-2.0/EPL-2.0.txt"),
    ("cc0-ref", "To the extent possible under law, the author has waived all copyright and related or neighboring rights to this work."),
)

# Identifiers of the SPDX list that a tag line may name.
SPDX = (
    "0BSD", "AGPL-3.0-only", "AGPL-3.0-or-later", "Apache-2.0", "BSD-2-Clause", "BSD-3-Clause", "BSL-1.0", "CC-BY-4.0",
    "CC-BY-SA-4.0", "CC0-1.0", "EPL-2.0", "GPL-2.0-only", "GPL-2.0-or-later", "GPL-3.0-only", "GPL-3.0-or-later", "ISC",
    "LGPL-2.1-only", "LGPL-2.1-or-later", "LGPL-3.0-only", "LGPL-3.0-or-later", "MIT", "MPL-2.0", "Unlicense", "Zlib",
)
SENTENCES += tuple((f"spdx-{name.lower()}", f"SPDX-License-Identifier: {name}") for name in SPDX)

# Fixed values: (licence, identifiers in order).
RULES = (
    ("MIT", ("mit-title", "reserved", "mit-grant", "mit-notice", "as-is")),
    ("MIT", ("mit-title", "mit-grant", "mit-notice", "as-is")),
    ("MIT", ("mit-grant", "mit-notice", "as-is")),
    ("MIT", ("mit-grant", "mit-notice")),
    ("MIT", ("mit-ref",)),
    ("BSD-4-Clause", ("bsd-grant", "bsd-source", "bsd-binary", "bsd-advert", "bsd-names")),
    ("BSD-3-Clause", ("bsd-grant", "bsd-source", "bsd-binary", "bsd-names")),
    ("BSD-2-Clause", ("bsd-grant", "bsd-source", "bsd-binary")),
    ("Apache-2.0", ("apache2-head", "apache2-copy")),
    ("Apache-2.0", ("apache2-head",)),
    ("Apache-2.0", ("apache2-ref",)),
    ("AGPL-3.0-or-later", ("agpl3-free", "gpl-hope")),
    ("AGPL-3.0-or-later", ("agpl3-free",)),
    ("GPL-2.0-or-later", ("gpl2-free", "gpl-hope")),
    ("GPL-2.0-or-later", ("gpl2-free",)),
    ("GPL-3.0-or-later", ("gpl-free", "gpl-hope")),
    ("GPL-3.0-or-later", ("gpl-free",)),
    ("GPL-3.0", ("gpl3-ref",)),
    ("CC-BY-NC-4.0", ("cc-by-nc4-ref",)),
    ("CC-BY-4.0", ("cc-by4-ref",)),
    ("CC-BY-SA-4.0", ("cc-by-sa4-ref",)),
    ("CC0-1.0", ("cc0-ref",)),
    ("CC-BY-NC-4.0", ("cc-by-nc4-words",)),
    ("CC-BY-4.0", ("cc-by4-words",)),
    ("CC-BY-SA-4.0", ("cc-by-sa4-words",)),
    ("LGPL-2.1-or-later", ("lgpl21-free",)),
    ("LGPL-3.0-or-later", ("lgpl3-free", "gpl-hope")),
    ("LGPL-3.0-or-later", ("lgpl3-free",)),
    ("MPL-2.0", ("mpl2-head",)),
    ("ISC", ("isc-grant",)),
    ("0BSD", ("0bsd-grant",)),
    ("Unlicense", ("unlicense-head",)),
    ("Zlib", ("zlib-head", "zlib-grant")),
    ("Zlib", ("zlib-grant",)),
    ("BSL-1.0", ("boost-ref",)),
    ("BSL-1.0", ("boost-grant",)),
    ("EPL-2.0", ("epl2-ref",)),
    *((name, (f"spdx-{name.lower()}",)) for name in SPDX),
    ("Proprietary", ("reserved",)),
)

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
# A line break before a lower-case letter or bracket, past comment marks, goes on with a sentence.
WRAPPED = r"\r?\n[ \t]*(?:#+|//+|\*+|;+|--)?[ \t]*([a-z(])"
# A tag line ends with its identifier.
TAG = r"(SPDX-License-Identifier:[ \t]*[A-Za-z0-9.+-]+)"
# So does, in the second way, one before a capital, a digit or a quote, unless a stop comes first.
JOINED = r"([A-Za-z0-9,)\"])[ \t]*\r?\n[ \t]*(?:#+|//+|\*+|;+|--)?[ \t]*([A-Z0-9\"'])"
# The start of the BSD clause on names holds a name: it is cut off together with what stands before.
NAMED = r"(?i:neither[ \t]+the[ \t]+names?[ \t]+of[ \t](?:[^\n]|\n){0,200}?[ \t]nor[ \t]+the[ \t]+names[ \t]+of[ \t])"
STOP = r"([.!?:;])[\"')]*[ \t]+(?:" + NAMED + r")?|" + NAMED


def normal(text: Column) -> Column:
    """Letters and digits, other runs as one blank."""
    return F.trim(F.regexp_replace(F.translate(text, UPPER, LOWER), "[^a-z0-9]+", " "))


def _plain(sentence: str) -> list[str]:
    """A known sentence as the parts that the text is cut into, normalised."""
    import re

    parts = re.sub(STOP, "\\1\n", sentence).split("\n")
    parts = [re.sub("[^a-z0-9]+", " ", p.lower()).strip() for p in parts]
    return [p for p in parts if p]


def _identifiers(sentences: Sequence[tuple[str, str]]) -> dict[str, str]:
    """Identifier of every part: the name of the sentence, with a number if it has several parts.

    A part that several sentences have goes by the first of them.
    """
    known, taken = {}, {}
    for name, sentence in sentences:
        parts = _plain(sentence)
        for part in parts:
            if part not in known:
                taken[name] = taken.get(name, 0) + (len(parts) > 1)
                known[part] = f"{name}-{taken[name]}" if len(parts) > 1 else name
    return known


def notice(licence: str, text: str) -> tuple[list[tuple[str, str]], tuple[str, tuple[str, ...]]]:
    """(sentences, rule) of a plain notice: each of its sentences, and all of them in order.

    Lines are joined within a paragraph; comment marks at their beginnings do not matter.
    """
    import re

    lines = [re.sub(r"^[ \t]*(?:#+|//+|/?\*+|;+|--)?[ \t]*", "", x) for x in text.splitlines()]
    paragraphs = re.split(r"\n\s*\n", "\n".join(lines))
    parts = [p for x in paragraphs for p in _plain(" ".join(x.split()))]
    sentences = [(f"{licence}-{n}", p) for n, p in enumerate(parts, 1)]
    return sentences, (licence, tuple(name for name, _ in sentences))


def known_sentences(sentences: Sequence[tuple[str, str]]) -> list[tuple[str, str]]:
    """(normalised part, identifier): a sentence with inner stops has one row per part."""
    return sorted(_identifiers(sentences).items())


def part_rules(
    sentences: Sequence[tuple[str, str]], rules: Sequence[tuple[str, Sequence[str]]]
) -> list[tuple[str, tuple[str, ...]]]:
    """``rules`` by the identifiers of all parts in order, for every wording, longest first."""
    known, wordings = _identifiers(sentences), {}
    for name, sentence in sentences:
        steps = tuple(known[p] for p in _plain(sentence))
        if steps not in wordings.setdefault(name, []):
            wordings[name].append(steps)
    out = []
    for licence, sequence in rules:
        for way in itertools.product(*(wordings.get(name, [(name,)]) for name in sequence)):
            out.append((licence, tuple(itertools.chain(*way))))
    return sorted(dict.fromkeys(out), key=lambda r: -len(r[1]))


def scan(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    *,
    sentences: Sequence[tuple[str, str]] = SENTENCES,
    rules: Sequence[tuple[str, Sequence[str]]] = RULES,
    max_gap: int = MAX_GAP,
) -> DataFrame:
    """(doc_id, n_sentences, sentence_ids, licences, left_over), one row per document."""
    known = docs.sparkSession.createDataFrame(
        known_sentences(sentences), "sentence string, name string"
    )
    text = F.regexp_replace(F.col(text_col).cast("string"), TAG, "$1.")
    ways = [F.regexp_replace(t, WRAPPED, " $1") for t in (text, F.regexp_replace(text, JOINED, "$1 $2"))]
    plain, joined = F.col("plain"), F.col("joined")
    parts = F.split(F.regexp_replace("text", STOP, "$1\n"), "\n")
    sentences_found = (
        docs.select(
            F.col(id_col).alias("doc_id"),
            F.md5(F.col(text_col).cast("string").cast("binary")).alias("row"),
            F.monotonically_increasing_id().alias("copy"),  # tells equal rows apart
            ways[0].alias("plain"),
            ways[1].alias("joined"),
        )
        .withColumn("texts", F.when(plain == joined, F.array(plain)).otherwise(F.array(plain, joined)))
        .select("doc_id", "row", "copy", F.posexplode("texts").alias("way", "text"))
        .select("doc_id", "row", "copy", "way", F.posexplode(F.transform(parts, normal)).alias("at", "sentence"))
        .join(F.broadcast(known), "sentence")
    )
    by_way = sentences_found.groupBy("doc_id", "row", "copy", "way").agg(
        F.sort_array(F.collect_list(F.struct("copy", "at", "name"))).alias("found")
    )
    best = F.max_by("found", F.struct(F.size("found"), -F.col("way")))
    by_row = by_way.groupBy("doc_id", "row", "copy").agg(best.alias("found"))
    rows = F.sort_array(F.collect_list(F.struct("row", "copy", "found")))
    found = by_row.groupBy("doc_id").agg(F.flatten(F.transform(rows, lambda x: x["found"])).alias("found"))
    # <name> for each sentence in order, | where the next one is too far off.
    far = lambda i: (
        (F.get("found", i)["copy"] != F.get("found", i - 1)["copy"])
        | (F.get("found", i)["at"] - F.get("found", i - 1)["at"] > max_gap)
    )
    steps = F.transform(
        "found",
        lambda x, i: F.concat(F.when((i > 0) & far(i), "|").otherwise(""), F.lit("<"), x["name"], F.lit(">")),
    )
    names = F.transform("found", lambda x: x["name"])
    state = materialise(
        found.select("doc_id", names.alias("names"), F.array_join(steps, "").alias("left")),
        "licence-sentences",
    )
    # Each rule takes what it matches out of the text of identifiers, longest rules first.
    listed = F.array(
        *(
            F.struct(F.lit(licence).alias("licence"), F.lit("".join(f"<{n}>" for n in sequence)).alias("pattern"))
            for licence, sequence in part_rules(sentences, rules)
        )
    )
    matched = F.aggregate(
        listed,
        F.struct(F.col("left"), F.array().cast("array<string>").alias("hits")),
        lambda acc, rule: F.struct(
            F.replace(acc["left"], rule["pattern"], F.lit("|")).alias("left"),
            F.when(F.contains(acc["left"], rule["pattern"]), F.array_append(acc["hits"], rule["licence"]))
            .otherwise(acc["hits"])
            .alias("hits"),
        ),
    )
    matched = state.select("doc_id", "names", matched.alias("m")).select(
        "doc_id",
        "names",
        F.array_sort(F.array_distinct("m.hits")).alias("licences"),
        F.regexp_extract_all("m.left", F.lit("<([^>]*)>"), F.lit(1)).alias("rest"),
    )
    nothing = F.array().cast("array<string>")
    ids = docs.select(F.col(id_col).alias("doc_id")).distinct()
    return (
        ids.withColumnRenamed("doc_id", "__id")
        .join(matched, F.col("__id").eqNullSafe(F.col("doc_id")), "left")
        .select(
            F.col("__id").alias("doc_id"),
            F.coalesce(F.size("names"), F.lit(0)).cast("bigint").alias("n_sentences"),
            F.coalesce("names", nothing).alias("sentence_ids"),
            F.coalesce("licences", nothing).alias("licences"),
            F.coalesce("rest", nothing).alias("left_over"),
        )
    )


def oracle_sql() -> str:
    """The scan of ``documents`` with the lists joined by commas, for another SQL engine."""
    lower = f"translate({{}}, '{UPPER}', '{LOWER}')"
    known = ", ".join(f"('{s}', '{n}')" for s, n in known_sentences(SENTENCES))
    quoted_stop, quoted_joined = STOP.replace("'", "''"), JOINED.replace("'", "''")
    listed = ", ".join(
        f"{{'p': '{''.join(f'<{n}>' for n in sequence)}', 'l': '{licence}'}}"
        for licence, sequence in part_rules(SENTENCES, RULES)
    )
    norm = f"trim(regexp_replace({lower.format('s')}, '[^a-z0-9]+', ' ', 'g'))"
    return f"""
WITH known(sentence, name) AS (VALUES {known}), way AS (
  SELECT doc_id, md5(text) AS r, row_number() OVER () AS copy,
    regexp_replace(tagged, '{WRAPPED}', ' \\1', 'g') AS plain,
    regexp_replace(regexp_replace(tagged, '{quoted_joined}', '\\1 \\2', 'g'), '{WRAPPED}', ' \\1', 'g') AS joined
  FROM (SELECT doc_id, text, regexp_replace(text, '{TAG}', '\\1.', 'g') AS tagged FROM documents)
), part AS (
  SELECT doc_id, r, copy, way, unnest(p) AS s, generate_subscripts(p, 1) AS pos FROM (
    SELECT doc_id, r, copy, way, string_split(regexp_replace(t, '{quoted_stop}', '\\1' || chr(10), 'g'), chr(10)) AS p
    FROM (SELECT doc_id, r, copy, 0 AS way, plain AS t FROM way
          UNION ALL SELECT doc_id, r, copy, 1, joined FROM way WHERE joined <> plain))
), either AS (
  SELECT doc_id, r, copy, way, pos, name,
    count(*) OVER (PARTITION BY doc_id, copy, way) AS n
  FROM (SELECT doc_id, r, copy, way, pos, {norm} AS sentence FROM part) p
  JOIN known USING (sentence)
), found AS (
  SELECT doc_id, r, copy, pos, name FROM either b
  WHERE way = (SELECT o.way FROM either o WHERE o.copy = b.copy ORDER BY o.n DESC, o.way LIMIT 1)
), steps AS (
  SELECT doc_id, count(*) AS n, string_agg(name, ',' ORDER BY r, copy, pos) AS names,
    string_agg(CASE WHEN pos - before > {MAX_GAP} OR copy <> copy_before THEN '|' ELSE '' END
      || '<' || name || '>', '' ORDER BY r, copy, pos) AS l
  FROM (SELECT *, lag(pos) OVER w AS before, lag(copy) OVER w AS copy_before FROM found
        WINDOW w AS (PARTITION BY doc_id ORDER BY r, copy, pos))
  GROUP BY doc_id
), matched AS (
  SELECT doc_id, n, names, array_to_string(list_sort(list_distinct(string_split(ltrim(m.l, ','), ','))), ',') AS licences,
    array_to_string(regexp_extract_all(m.p, '<([^>]*)>', 1), ',') AS left_over
  FROM (SELECT doc_id, n, names, list_reduce([{listed}], lambda acc, x: {{
      'p': replace(acc.p, x.p, '|'),
      'l': CASE WHEN contains(acc.p, x.p) THEN acc.l || ',' || x.l ELSE acc.l END
    }}, {{'p': l, 'l': ''}}) AS m FROM steps)
)
SELECT d.doc_id, coalesce(m.n, 0) AS n_sentences, coalesce(m.names, '') AS sentence_ids,
  coalesce(m.licences, '') AS licences, coalesce(m.left_over, '') AS left_over
FROM (SELECT DISTINCT doc_id FROM documents) d LEFT JOIN matched m USING (doc_id)
"""
