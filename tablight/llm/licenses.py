"""Licence scans by sentence rules.

A text is cut into sentences (at line ends and after . ! ?; and again with
wrapped lines joined), sentences are normalised and looked up among known
licence sentences, and the sequence of sentence identifiers found is matched
against ordered rules: a rule is a run of identifiers; the first that matches
takes its identifiers out, so a longer licence is not also reported as the
shorter one it contains.

Known sentences are a fixed table built from ``FRAMES`` and ``TEXTS``; its
broadcast is bounded by that. Only matched sentences are shuffled, by document.

Defined results. Null or empty text and texts without a known sentence: no
licences, zero sentences. Repeated rows are returned each (equal rows share one
scan). Null ids are kept. Other columns are ignored.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import ship

# fixed values: names of licences in grant sentences, by identifier
NAMES = {
    "MIT": ["mit license", "mit licence", "expat license"],
    "Apache-2.0": ["apache license version 2.0", "apache license 2.0", "apache 2.0 license", "apache software license version 2.0"],
    "GPL-3.0": ["gnu general public license version 3", "gnu general public license v3", "gnu gpl version 3", "gplv3", "gpl 3.0"],
    "GPL-2.0": ["gnu general public license version 2", "gnu general public license v2", "gnu gpl version 2", "gplv2", "gpl 2.0"],
    "LGPL-2.1": ["gnu lesser general public license version 2.1", "lgplv2.1"],
    "LGPL-3.0": ["gnu lesser general public license version 3", "lgplv3"],
    "AGPL-3.0": ["gnu affero general public license version 3", "agplv3"],
    "MPL-2.0": ["mozilla public license version 2.0", "mozilla public license 2.0", "mpl 2.0"],
    "BSD-2-Clause": ["bsd 2 clause license", "simplified bsd license"],
    "BSD-3-Clause": ["bsd 3 clause license", "new bsd license", "modified bsd license"],
    "ISC": ["isc license"],
    "CC0-1.0": ["cc0 1.0", "creative commons zero 1.0"],
    "CC-BY-4.0": ["cc by 4.0", "creative commons attribution 4.0", "creative commons attribution 4.0 international license"],
    "CC-BY-SA-4.0": ["cc by sa 4.0", "creative commons attribution sharealike 4.0", "creative commons attribution sharealike 4.0 international license"],
    "CC-BY-NC-4.0": ["cc by nc 4.0", "creative commons attribution noncommercial 4.0", "creative commons attribution noncommercial 4.0 international license"],
    "CC-BY-NC-SA-4.0": ["cc by nc sa 4.0"],
    "CC-BY-ND-4.0": ["cc by nd 4.0"],
}
# fixed values: frames of grant sentences
VERBS = ["licensed", "released", "distributed", "published", "available"]
THINGS = ["work", "software", "program", "code", "document", "project", "file", "text", "content"]
FRAMES = [
    "{verb} under {the}{name}",
    "{verb} under the terms of {the}{name}",
    "this {thing} is {verb} under {the}{name}",
    "this {thing} is {verb} under the terms of {the}{name}",
]
# fixed values: sentences of licence texts and notices, normalised
TEXTS = {
    "mit-grant": "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files the software to deal in the software without restriction including without limitation the rights to use copy modify merge publish distribute sublicense and or sell copies of the software and to permit persons to whom the software is furnished to do so subject to the following conditions",
    "mit-notice": "the above copyright notice and this permission notice shall be included in all copies or substantial portions of the software",
    "mit-as-is": "the software is provided as is without warranty of any kind express or implied including but not limited to the warranties of merchantability fitness for a particular purpose and noninfringement",
    "mit-liability": "in no event shall the authors or copyright holders be liable for any claim damages or other liability whether in an action of contract tort or otherwise arising from out of or in connection with the software or the use or other dealings in the software",
    "apache-compliance": "you may not use this file except in compliance with the license",
    "apache-copy": "you may obtain a copy of the license at http www.apache.org licenses license 2.0",
    "apache-as-is": "unless required by applicable law or agreed to in writing software distributed under the license is distributed on an as is basis without warranties or conditions of any kind either express or implied",
    "apache-see": "see the license for the specific language governing permissions and limitations under the license",
    "bsd-permit": "redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met",
    "bsd-source": "redistributions of source code must retain the above copyright notice this list of conditions and the following disclaimer",
    "bsd-binary": "redistributions in binary form must reproduce the above copyright notice this list of conditions and the following disclaimer in the documentation and or other materials provided with the distribution",
    "bsd-name": "neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission",
    "isc-grant": "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted provided that the above copyright notice and this permission notice appear in all copies",
    "gpl3-later": "this program is free software you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation either version 3 of the license or at your option any later version",
    "gpl2-later": "this program is free software you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation either version 2 of the license or at your option any later version",
    "unlicense": "this is free and unencumbered software released into the public domain",
    "mpl-notice": "this source code form is subject to the terms of the mozilla public license v. 2.0",
    "all-rights": "all rights reserved",
}
# fixed values: ordered rules, runs of sentence identifiers
RULES = [
    ("BSD-3-Clause", ["bsd-permit", "bsd-source", "bsd-binary", "bsd-name"]),
    ("BSD-2-Clause", ["bsd-permit", "bsd-source", "bsd-binary"]),
    ("MIT", ["grant:MIT", "mit-grant", "mit-notice", "mit-as-is", "mit-liability"]),
    ("MIT", ["mit-grant", "mit-notice", "mit-as-is", "mit-liability"]),
    ("MIT", ["mit-grant", "mit-notice", "mit-as-is"]),
    ("Apache-2.0", ["grant:Apache-2.0", "apache-compliance", "apache-copy", "apache-as-is", "apache-see"]),
    ("Apache-2.0", ["grant:Apache-2.0", "apache-compliance"]),
    ("ISC", ["isc-grant"]),
    ("GPL-3.0-or-later", ["gpl3-later"]),
    ("GPL-2.0-or-later", ["gpl2-later"]),
    ("Unlicense", ["unlicense"]),
    ("MPL-2.0", ["mpl-notice"]),
    *[(name, [f"grant:{name}"]) for name in NAMES],
    ("NOASSERTION", ["all-rights"]),
]
ANCHOR = r"(?i)licen[sc]e|under|granted|copyright|redistribut|warrant|liable|endorse|software|reserved|mozilla"


def known_sentences() -> dict[str, str]:
    """Normalised sentence -> identifier."""
    out = {text: name for name, text in TEXTS.items()}
    for spdx, names in NAMES.items():
        for name in names:
            for frame in FRAMES:
                for verb in VERBS:
                    for thing in THINGS if "{thing}" in frame else [""]:
                        for the in ("the ", ""):
                            out[plain(frame.format(verb=verb, thing=thing, the=the, name=name))] = f"grant:{spdx}"
        out[plain(f"spdx license identifier {spdx}")] = f"grant:{spdx}"
    return out


def plain(s: str) -> str:
    """The normal form of a sentence, as ``normalise`` gives it."""
    s = re.sub(r"[^a-z0-9.]+", " ", s.lower().replace("licence", "license"))
    return re.sub(r"\.(?![0-9a-z])", "", s).strip()


def normalise(c: Column) -> Column:
    s = F.regexp_replace(F.replace(F.lower(c), F.lit("licence"), F.lit("license")), r"[^a-z0-9.]+", " ")
    return F.trim(F.regexp_replace(s, r"\.(?![0-9a-z])", ""))


def match_rules(ids: Column) -> tuple[Column, Column]:
    """(licences, rest): rules applied in order to an array of identifiers."""
    line = F.concat(F.lit("|"), F.array_join(ids, "||"), F.lit("|"))
    found = []
    for name, run in RULES:
        key = "".join(f"|{x}|" for x in run)
        found.append(F.when(F.contains(line, F.lit(key)), F.lit(name)))
        line = F.replace(line, F.lit(key), F.lit("#"))
    return F.array_sort(F.array_distinct(F.array_compact(F.array(*found)))), line


def scan_licenses(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, licenses array, sentence_ids array, n_sentences) of every row."""
    spark = docs.sparkSession
    ship(spark)
    known = spark.createDataFrame(sorted(known_sentences().items()), "_sentence string, _id string")
    rows = docs.select(F.col(key), F.col(text).alias("_text")).withColumn("_h", F.xxhash64("_text", F.length("_text")))
    likely = rows.where(F.col("_text").rlike(ANCHOR))
    lines = F.split("_text", r"\n|(?<=[.!?])\s+")
    joined = F.split(F.regexp_replace("_text", r"(?<!\n)\n(?!\n)", " "), r"\n+|(?<=[.!?])\s+")
    cut = likely.select(key, "_h", F.explode(F.array(F.struct(F.lit(0).alias("way"), lines.alias("s")), F.struct(F.lit(1).alias("way"), joined.alias("s")))).alias("_c"))
    cut = cut.select(key, "_h", F.col("_c.way").alias("_way"), F.posexplode("_c.s").alias("_at", "_s")).where(F.col("_s").rlike(ANCHOR))
    hit = cut.withColumn("_sentence", normalise(F.col("_s"))).join(F.broadcast(known), "_sentence")
    hit = hit.select(key, "_h", "_way", "_at", "_id").distinct()
    seq = hit.groupBy(key, "_h", "_way").agg(F.transform(F.array_sort(F.collect_list(F.struct("_at", "_id"))), lambda x: x["_id"]).alias("_ids"))
    seq = seq.withColumn("_lic", match_rules(F.col("_ids"))[0])
    both = seq.groupBy(key, "_h").agg(
        F.array_sort(F.array_distinct(F.flatten(F.collect_list("_lic")))).alias("_l"),
        F.max_by("_ids", F.struct(F.size("_ids"), -F.col("_way"))).alias("_i"),
    ).select(F.col(key).alias("_k"), F.col("_h").alias("_g"), "_l", "_i")
    out = rows.drop("_text").join(both, F.col(key).eqNullSafe(F.col("_k")) & (F.col("_h") == F.col("_g")), "left")
    none = F.array().cast("array<string>")
    ids = F.coalesce("_i", none)
    return out.select(key, F.coalesce("_l", none).alias("licenses"), ids.alias("sentence_ids"), F.size(ids).cast("long").alias("n_sentences"))
