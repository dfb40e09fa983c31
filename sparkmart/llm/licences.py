"""Licence recognition by sentences, in DataFrame operations only.

A text is cut into sentences, each sentence is reduced to its lower-case letters and digits, and sentences that a table
of known licence sentences lists become identifiers. A line's end before a capital letter may end a sentence (after a
title) or stand inside one (a wrapped line); so a sentence is any run of such lines, and a known run inside a longer known
run does not count. The identifiers of a document, in order of place, with a bar where other text lies between, form a
sequence. Rules are sequences of identifiers with a licence each; they are tried in their order, and what a rule has
matched is taken out before the next one is tried, so put the more specific ones first. A licence of ``LAST_RESORT`` is
named only where no other is found. Known sentences that no rule explains are counted as ``n_unmatched``.

Texts without one of the anchor words that every known sentence has are not cut at all. Only the few known sentences
are shuffled, never the texts. A null text or one without a known sentence has no licences (an empty string) and zero
counts. Repeated rows (id and text) each get the result of their text; null ids too. An empty table gives an empty table.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sparkmart.llm.frames import col

#: Known sentences (identifier, sentence). Wording of the notices that licences ask for.
SENTENCES = (
    ("apache-2.0", "Licensed under the Apache License, Version 2.0"),
    ("apache-2.0-you", 'Licensed under the Apache License, Version 2.0 (the "License")'),
    ("apache-2.0-use", "you may not use this file except in compliance with the License"),
    ("apache-2.0-copy", "You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0"),
    ("mit", "Released under the MIT License"),
    ("mit-licensed", "Licensed under the MIT License"),
    ("mit-permission", 'Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the "Software"), to deal in the Software without restriction'),
    ("gpl-3.0", "This work is licensed under the GNU General Public License, version 3"),
    ("gpl-redistribute", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version"),
    ("gpl-warranty", "This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY"),
    ("gpl-implied", "without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE"),
    ("cc-by-nc-4.0", "Licensed under CC BY-NC 4.0"),
    ("cc-by-4.0", "Licensed under CC BY 4.0"),
    ("cc-by-sa-4.0", "Licensed under CC BY-SA 4.0"),
    ("cc-by-nc-4.0-work", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License"),
    ("cc-by-4.0-work", "This work is licensed under a Creative Commons Attribution 4.0 International License"),
    ("reserved", "All rights reserved"),
    # whole notices, cut where a sentence or an empty line ends
    ("apache-2.0-obtain", "You may obtain a copy of the License at"),
    ("apache-2.0-url", "http://www.apache.org/licenses/LICENSE-2.0"),
    ("mit-title", "MIT License"),
    ("mit-title", "The MIT License"),
    ("mit-title", "The MIT License (MIT)"),
    ("mit-whole", 'Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the "Software"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions:'),
    ("gpl-2-terms", "you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation"),
    ("either-2", "either version 2 of the License, or (at your option) any later version"),
    ("lgpl-terms-line", "you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation"),
    ("either-2.1", "either version 2.1 of the License, or (at your option) any later version"),
    ("lgpl-3", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version"),
    ("agpl-3", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU Affero General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version"),
    ("bsd-2-title", "BSD 2-Clause License"),
    ("bsd-3-title", "BSD 3-Clause License"),
    ("bsd-forms", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:"),
    ("bsd-source", "Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer"),
    ("bsd-binary", "Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution"),
    ("bsd-endorse", "Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission"),
    ("isc-title", "ISC License"),
    ("isc", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies"),
    ("isc", "Permission to use, copy, modify, and distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies"),
    ("mpl-2.0-line", "This Source Code Form is subject to the terms of the Mozilla Public License, v"),
    ("unlicense", "This is free and unencumbered software released into the public domain"),
    ("cc0-1.0", "CC0 1.0 Universal"),
)
#: Rules in order (licence, sequence of identifiers).
RULES = (
    ("Apache-2.0", ("apache-2.0-you", "apache-2.0-use", "apache-2.0-copy")),
    ("Apache-2.0", ("apache-2.0-you", "apache-2.0-use", "apache-2.0-obtain", "apache-2.0-url")),
    ("Apache-2.0", ("apache-2.0-you", "apache-2.0-use")),
    ("Apache-2.0", ("apache-2.0-you",)),
    ("Apache-2.0", ("apache-2.0",)),
    ("GPL-3.0-or-later", ("gpl-redistribute", "gpl-warranty", "gpl-implied")),
    ("GPL-3.0-or-later", ("gpl-redistribute",)),
    ("AGPL-3.0-or-later", ("agpl-3", "gpl-warranty", "gpl-implied")),
    ("AGPL-3.0-or-later", ("agpl-3",)),
    ("LGPL-3.0-or-later", ("lgpl-3", "gpl-warranty", "gpl-implied")),
    ("LGPL-3.0-or-later", ("lgpl-3",)),
    ("GPL-2.0-or-later", ("gpl-2-terms", "either-2", "gpl-warranty", "gpl-implied")),
    ("GPL-2.0-or-later", ("gpl-2-terms", "either-2")),
    ("LGPL-2.1-or-later", ("lgpl-terms-line", "either-2.1")),
    ("GPL-3.0-only", ("gpl-3.0",)),
    ("MIT", ("mit", "mit-permission")),
    ("MIT", ("mit-licensed", "mit-permission")),
    ("MIT", ("mit-title", "mit-permission")),
    ("MIT", ("mit-permission",)),
    ("MIT", ("mit-title", "mit-whole")),
    ("MIT", ("mit", "mit-whole")),
    ("MIT", ("mit-licensed", "mit-whole")),
    ("MIT", ("mit-whole",)),
    ("MIT", ("mit-title",)),
    ("MIT", ("mit",)),
    ("MIT", ("mit-licensed",)),
    ("CC-BY-NC-4.0", ("cc-by-nc-4.0",)),
    ("CC-BY-NC-4.0", ("cc-by-nc-4.0-work",)),
    ("CC-BY-SA-4.0", ("cc-by-sa-4.0",)),
    ("CC-BY-4.0", ("cc-by-4.0",)),
    ("CC-BY-4.0", ("cc-by-4.0-work",)),
    ("BSD-3-Clause", ("bsd-forms", "bsd-source", "bsd-binary", "bsd-endorse")),
    ("BSD-3-Clause", ("bsd-3-title",)),
    ("BSD-3-Clause", ("bsd-endorse",)),
    ("BSD-2-Clause", ("bsd-forms", "bsd-source", "bsd-binary")),
    ("BSD-2-Clause", ("bsd-2-title",)),
    ("ISC", ("isc-title", "isc")),
    ("ISC", ("isc",)),
    ("ISC", ("isc-title",)),
    ("MPL-2.0", ("mpl-2.0-line",)),
    ("Unlicense", ("unlicense",)),
    ("CC0-1.0", ("cc0-1.0",)),
    ("Proprietary", ("reserved",)),
)
#: Licences that stand only where no other is found: most notices begin with "All rights reserved".
LAST_RESORT = ("Proprietary",)
_SPDX = [licence for licence in dict(RULES) if licence not in LAST_RESORT]
SENTENCES += tuple((f"spdx-{licence}", f"SPDX-License-Identifier: {licence}") for licence in _SPDX)
RULES = tuple((licence, (f"spdx-{licence}",)) for licence in _SPDX) + RULES
#: Every known sentence has one of these words.
ANCHORS = ("licen[sc]e", "rights", "permission", "compliance", "warranty", "redistribut", "merchantability", "mozilla", "unencumbered", "cc0")
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def reduced(sentence: str) -> str:
    """A known sentence as texts' sentences are compared with it."""
    return " ".join(re.findall("[a-z0-9]+", sentence.translate(str.maketrans(_UPPER, _LOWER))))


#: Replaced in this order (pattern, replacement): character 1 ends a sentence, character 2 may end one.
CUTS = (
    (r"(^|\n)[ \t\r#*/;%>|-]+", "$1"),  # comment marks, bullets and indents
    ("(SPDX-License-Identifier:[ \\t]*[A-Za-z0-9.+-]*[A-Za-z0-9+])", "\u0001$1\u0001"),
    (r"([.:;,\n])[ \t\r]*\n(\(?[0-9][0-9]?[.)]|\(?[a-z]\))[ \t]+", "$1\u0001"),  # numbers of list items
    (r"([.!?;])[ \t\r\n]+", "$1\u0001"),
    (r"\n[ \t\r]*\n", "\u0001"),
    (r"\n([A-Z])", "\u0002$1"),
)


def segments(text: Column) -> Column:
    """A text's parts between certain ends of sentences, reduced, with the possible ends inside them marked."""
    for pattern, by in CUTS:
        text = F.regexp_replace(text, pattern, by)
    plain = F.regexp_replace(F.translate(text, _UPPER, _LOWER), "[^a-z0-9\u0001\u0002]+", " ")
    return F.split(plain, "\u0001")


def longest_run(known=SENTENCES) -> int:
    """Most lines of one known sentence: one for each capital letter that may begin a line, or lines of thirty characters."""
    return max(max(len(re.findall(r"(?<![A-Za-z0-9])[A-Z]", s)), len(s) // 30) + 1 for _, s in known)


def _runs(segment: Column, most: int) -> tuple[Column, Column]:
    """The lines of a segment (``lines``), and of these every run of at most ``most``: first line, line after it, text."""
    lines = F.filter(F.transform(F.split(segment, "\u0002"), lambda x: F.trim(x)), lambda x: x != "")

    def from_line(i: Column) -> Column:
        return F.transform(
            F.sequence(i + 1, F.least(i + most, F.size("lines"))),
            lambda end: F.struct(i.alias("first"), end.alias("end"), F.array_join(F.slice("lines", i + 1, end - i), " ").alias("sentence")),
        )

    return lines, F.flatten(F.transform("lines", lambda _, i: from_line(i)))


def recognised(docs: DataFrame, id_column: str = "doc_id", text: str = "text", known=SENTENCES, rules=RULES, anchors=ANCHORS) -> DataFrame:
    """(id, licences, n_known, n_unmatched) per row of ``docs``; licences are joined by commas in the order of the rules."""
    pattern = "(?i)" + "|".join(anchors)
    table = [(reduced(s), name) for name, s in known]
    if any(not re.search(pattern, s) for s, _ in table):
        raise ValueError("a known sentence has no anchor word")
    spark = docs.sparkSession
    listed = spark.createDataFrame(table, "sentence string, name string")
    rows = docs.select(col(id_column).alias("id"), col(text).alias("text"))
    most = longest_run(known)
    lines, runs = _runs(F.col("segment"), most)
    cut = (
        rows.where(F.col("text").rlike(pattern))
        .select("id", F.xxhash64("text").alias("mark"), F.posexplode(segments(F.col("text"))).alias("place", "segment"))
        .select("id", "mark", "place", lines.alias("lines"))
        .select("id", "mark", "place", F.size("lines").alias("n"), F.explode(runs).alias("run"))
        .select("id", "mark", "place", "n", "run.*")
        .join(F.broadcast(listed), "sentence")  # the rule table, of fixed size
        .select("id", "mark", "place", "n", "first", "end", "name")
        .distinct()
        .repartition("id", "mark")
    )
    before = Window.partitionBy("id", "mark", "place").orderBy("first", F.desc("end")).rowsBetween(Window.unboundedPreceding, -1)
    whole = cut.withColumn("covered", F.max("end").over(before)).where("covered is null or covered < end")
    found = whole.groupBy("id", "mark").agg(F.sort_array(F.collect_list(F.struct("place", "first", "end", "n", "name"))).alias("seen"))

    def apart(x: Column, last: Column) -> Column:
        """Whether other text lies between two known sentences."""
        same = (x["place"] == last["place"]) & (x["first"] <= last["end"])
        following = (x["place"] == last["place"] + 1) & (x["first"] == 0) & (last["end"] == last["n"])
        return ~(same | following)

    step = F.transform(
        "seen",
        lambda x, i: F.concat(
            F.when((i > 0) & apart(x, F.element_at("seen", F.greatest(i, F.lit(1)))), "|").otherwise(""), F.lit("<"), x["name"], F.lit(">")
        ),
    )
    start = F.struct(F.array_join(step, "").alias("rest"), F.array().cast("array<string>").alias("hits"))
    ordered = F.array(*[F.struct(F.lit("".join(f"<{n}>" for n in names)).alias("want"), F.lit(licence).alias("licence"), F.lit(licence in LAST_RESORT).alias("last")) for licence, names in rules])

    def apply(now: Column, rule: Column) -> Column:
        hits = F.when(F.contains(now["rest"], rule["want"]) & ~(rule["last"] & (F.size(now["hits"]) > 0)), F.concat(now["hits"], F.array(rule["licence"]))).otherwise(now["hits"])
        return F.struct(F.replace(now["rest"], rule["want"], F.lit("|")).alias("rest"), hits.cast("array<string>").alias("hits"))

    result = found.select("id", "mark", F.size("seen").cast("long").alias("n_known"), F.aggregate(ordered, start, apply).alias("end")).select(
        "id", "mark", F.array_join(F.array_distinct("end.hits"), ",").alias("licences"), "n_known",
        (F.length("end.rest") - F.length(F.replace(F.col("end.rest"), F.lit("<"), F.lit("")))).cast("long").alias("n_unmatched"),
    )
    result = result.select(F.struct("*").alias("r"))
    keyed = rows.select("id", F.xxhash64("text").alias("mark"))
    return keyed.join(result, keyed.id.eqNullSafe(F.col("r.id")) & (keyed.mark == F.col("r.mark")), "left").select(
        "id", F.coalesce("r.licences", F.lit("")).alias("licences"),
        F.coalesce("r.n_known", F.lit(0).cast("long")).alias("n_known"), F.coalesce("r.n_unmatched", F.lit(0).cast("long")).alias("n_unmatched"),
    )
