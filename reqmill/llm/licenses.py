"""License scans by recognising sentences.

A text is cut into sentences, each is normalised (lower case, runs of anything but
letters, digits and dots as one space), and a known licence sentence becomes its
identifier; any run of other sentences becomes one "?". The sequence of identifiers is
then matched against the licence rules in their order: a rule is a sequence of
identifiers, and what it matches is taken out before the next rule looks, so the
longer rules come first and a notice is not reported again as one of its parts.

Sentences end at . ! ? ; : before white space, and at a line's end. A notice may also
be broken into lines anywhere, so a second sequence is made with line breaks as spaces,
a third with blank lines as ends and other line breaks as spaces, and rules may match in
any. Numbers of a list are no sentences. "All rights reserved" beside a BSD text belongs
to that text; beside any other licence it is reported with it. A text without any of the HINTS, one of which is in
every known sentence, has no known sentence and isn't cut.

Null and empty texts have no sentences and no licence. Rows that repeat an id are
scanned each for itself. All of it is column expressions on the document's own row.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Sentences of public licences and notices, normalised.
SENTENCES = {
    "Apache2Notice": ["licensed under the apache license version 2.0", "licensed under the apache license version 2.0 the license"],
    "ApacheComply": ["you may not use this file except in compliance with the license"],
    "ApacheCopy": ["you may obtain a copy of the license at http www.apache.org licenses license 2.0"],
    "ApacheNoWarranty": ["unless required by applicable law or agreed to in writing software distributed under the license is "
                         "distributed on an as is basis without warranties or conditions of any kind either express or implied"],
    "ApacheLimits": ["see the license for the specific language governing permissions and limitations under the license"],
    "MITNotice": ["released under the mit license", "licensed under the mit license"],
    "MITPermission": ["permission is hereby granted free of charge to any person obtaining a copy of this software and associated "
                      "documentation files the software to deal in the software without restriction including without limitation "
                      "the rights to use copy modify merge publish distribute sublicense and or sell copies of the software and to "
                      "permit persons to whom the software is furnished to do so subject to the following conditions"],
    "MITCondition": ["the above copyright notice and this permission notice shall be included in all copies or substantial "
                     "portions of the software"],
    "BSDConditions": ["redistribution and use in source and binary forms with or without modification are permitted provided that "
                      "the following conditions are met"],
    "BSDSource": ["redistributions of source code must retain the above copyright notice this list of conditions and the following disclaimer"],
    "BSDBinary": ["redistributions in binary form must reproduce the above copyright notice this list of conditions and the "
                  "following disclaimer in the documentation and or other materials provided with the distribution"],
    "BSDEndorse": ["neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote "
                   "products derived from this software without specific prior written permission"],
    "MITTitle": ["mit license", "the mit license", "the mit license mit"],
    "ISCPermission": ["permission to use copy modify and or distribute this software for any purpose with or without fee is hereby "
                      "granted provided that the above copyright notice and this permission notice appear in all copies"],
    "GPL3Notice": ["this work is licensed under the gnu general public license version 3"],
    "GPL2Notice": ["this work is licensed under the gnu general public license version 2"],
    "GPLMayRedistribute": ["this program is free software you can redistribute it and or modify it under the terms of the gnu "
                           "general public license as published by the free software foundation either version 3 of the license or "
                           "at your option any later version"],
    "GPLTerms": ["you can redistribute it and or modify it under the terms of the gnu general public license as published by the "
                 "free software foundation"],
    "GPL3Terms": ["you can redistribute it and or modify it under the terms of the gnu general public license as published by the "
                  "free software foundation either version 3 of the license or at your option any later version"],
    "LGPLTerms": ["you can redistribute it and or modify it under the terms of the gnu lesser general public license as published by "
                  "the free software foundation"],
    "LGPL3Terms": ["you can redistribute it and or modify it under the terms of the gnu lesser general public license as published by "
                   "the free software foundation either version 3 of the license or at your option any later version"],
    "Version2OrLater": ["either version 2 of the license or at your option any later version"],
    "Version21OrLater": ["either version 2.1 of the license or at your option any later version"],
    "Version3OrLater": ["either version 3 of the license or at your option any later version"],
    "MPL2Notice": ["this source code form is subject to the terms of the mozilla public license v 2.0"],
    "CCBYNC4Notice": ["licensed under cc by nc 4.0"],
    "CCBY4Notice": ["licensed under cc by 4.0"],
    "CCBYSA4Notice": ["licensed under cc by sa 4.0"],
    "UnlicenseNotice": ["this is free and unencumbered software released into the public domain"],
    "AllRights": ["all rights reserved"],
}
# Licences that an SPDX line may name; the line is the sentence "spdx license identifier" and the name.
SPDX = ["Apache-2.0", "MIT", "BSD-2-Clause", "BSD-3-Clause", "ISC", "GPL-2.0-only", "GPL-2.0-or-later", "GPL-3.0-only",
        "GPL-3.0-or-later", "LGPL-2.1-or-later", "LGPL-3.0-or-later", "MPL-2.0", "CC-BY-NC-4.0", "CC-BY-SA-4.0", "CC-BY-4.0", "Unlicense"]
SENTENCES |= {f"SPDX-{x}": ["spdx license identifier " + x.lower().replace("-", " ")] for x in SPDX}
HINTS = ("licen", "permission", "redistribut", "copyright", "domain", "rights")
# Licence and sequence of each rule, in the order in which they are tried.
RULES = [
    ("Apache-2.0", ["Apache2Notice", "ApacheComply", "ApacheCopy", "ApacheNoWarranty", "ApacheLimits"]),
    ("Apache-2.0", ["Apache2Notice", "ApacheComply"]),
    ("MIT", ["MITPermission", "MITCondition"]),
    ("BSD-3-Clause", ["BSDConditions", "BSDSource", "BSDBinary", "BSDEndorse"]),
    ("BSD-2-Clause", ["BSDConditions", "BSDSource", "BSDBinary"]),
    ("Apache-2.0", ["Apache2Notice"]),
    ("MIT", ["MITNotice"]),
    ("MIT", ["MITPermission"]),
    ("MIT", ["MITCondition"]),
    ("MIT", ["MITTitle"]),
    ("ISC", ["ISCPermission"]),
    ("GPL-2.0-or-later", ["GPLTerms", "Version2OrLater"]),
    ("GPL-3.0-or-later", ["GPLTerms", "Version3OrLater"]),
    ("GPL-3.0-or-later", ["GPL3Terms"]),
    ("LGPL-2.1-or-later", ["LGPLTerms", "Version21OrLater"]),
    ("LGPL-3.0-or-later", ["LGPLTerms", "Version3OrLater"]),
    ("LGPL-3.0-or-later", ["LGPL3Terms"]),
    *[(x, [f"SPDX-{x}"]) for x in SPDX],
    ("GPL-3.0-or-later", ["GPLMayRedistribute"]),
    ("GPL-3.0", ["GPL3Notice"]),
    ("GPL-2.0", ["GPL2Notice"]),
    ("MPL-2.0", ["MPL2Notice"]),
    ("CC-BY-NC-4.0", ["CCBYNC4Notice"]),
    ("CC-BY-SA-4.0", ["CCBYSA4Notice"]),
    ("CC-BY-4.0", ["CCBY4Notice"]),
    ("Unlicense", ["UnlicenseNotice"]),
    ("Proprietary", ["AllRights"]),
]
# Licences whose own text has a line "All rights reserved".
RESERVING = ("BSD-2-Clause", "BSD-3-Clause")
LIST_NUMBER = "^[0-9]{1,2}$"
SPLIT = r"[.!?;:]+[ \t\r\n]+|[\r\n]+"


def pattern(sequence: list[str]) -> str:
    return "".join(f"<{name}>" for name in sequence)


def normalised(sentence: Column) -> Column:
    return F.btrim(F.regexp_replace(F.lower(sentence), "[^a-z0-9.]+", " "), F.lit(" ."))


def _sequence(text: Column) -> Column:
    """<id><?><id>... of a text's sentences; a sentence of white
    space or marks or the number of a list is none."""
    known = F.create_map(*[F.lit(x) for name, texts in SENTENCES.items() for t in texts for x in (t, name)])
    sentences = F.filter(F.transform(F.split(text, SPLIT), normalised), lambda s: (s != "") & ~s.rlike(LIST_NUMBER))
    marks = F.transform(sentences, lambda s: F.concat(F.lit("<"), F.coalesce(F.try_element_at(known, s), F.lit("?")), F.lit(">")))
    return F.regexp_replace(F.array_join(marks, ""), r"(<\?>)+", "<?>")


def _matched(sequence: Column) -> Column:
    """Licences of the rules that match, in the order of the rules."""
    rules = F.array(*[F.struct(F.lit(licence).alias("licence"), F.lit(pattern(ids)).alias("pattern")) for licence, ids in RULES])
    start = F.struct(sequence.alias("left"), F.array().cast("array<string>").alias("found"))

    def step(sofar: Column, rule: Column) -> Column:
        hit = F.contains(sofar["left"], rule["pattern"])
        return F.struct(F.when(hit, F.replace(sofar["left"], rule["pattern"], F.lit("<->"))).otherwise(sofar["left"]).alias("left"),
                        F.when(hit, F.array_append(sofar["found"], rule["licence"])).otherwise(sofar["found"]).alias("found"))

    return F.aggregate(rules, start, step, lambda sofar: F.array_distinct(sofar["found"]))


def scan(docs: DataFrame) -> DataFrame:
    """(doc_id, sequence, identifiers, licences): the sequence with line breaks as ends,
    the known identifiers in it, and all licences found, without repeats."""
    text = F.coalesce(F.col("text"), F.lit(""))
    lower = F.lower(text)
    hinted = F.contains(lower, F.lit(HINTS[0]))
    for hint in HINTS[1:]:
        hinted = hinted | F.contains(lower, F.lit(hint))
    # The name on an SPDX line and the holder within the third BSD condition may hold ends of sentences.
    candidate = F.when(hinted, F.regexp_replace(text, r"(?i)spdx-license-identifier:[ \t]*", "spdx license identifier "))
    candidate = F.regexp_replace(candidate, r"(?is)neither\s+the\s+names?\s+of\s.{1,200}?\snor\s+the\s+names\s+of\s+(its|their|any)\s+contributors",
                                 "neither the name of the copyright holder nor the names of its contributors")
    paragraphs = F.regexp_replace(F.regexp_replace(candidate, r"\r\n?", "\n"), r"\n([ \t]*\n)+", "\r")
    paragraphs = F.regexp_replace(paragraphs, r"\n", " ")
    flat = F.regexp_replace(candidate, r"[\r\n]+", " ")
    nothing = F.array().cast("array<string>")
    ways = F.struct(_sequence(candidate).alias("a"), _sequence(flat).alias("b"), _sequence(paragraphs).alias("c"))

    def found(s: Column) -> Column:
        licences = F.array_distinct(F.concat(_matched(s["a"]), _matched(s["b"]), _matched(s["c"])))
        return F.transform(F.array(licences), lambda x: F.when(
            F.arrays_overlap(x, F.array(*map(F.lit, RESERVING))), F.array_remove(x, "Proprietary")).otherwise(x))[0]

    both = docs.select("doc_id", F.transform(F.array(ways), lambda s: F.struct(
        s["a"].alias("sequence"), found(s).alias("licences")))[0].alias("_s"))
    ids = F.filter(F.split(F.regexp_replace("_s.sequence", "[<>?]+", " "), " "), lambda x: x != "")
    return both.select("doc_id", F.coalesce("_s.sequence", F.lit("")).alias("sequence"), F.coalesce(ids, nothing).alias("identifiers"),
                       F.coalesce("_s.licences", nothing).alias("licences"))
