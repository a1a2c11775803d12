"""Licences recognised by sequences of known sentences."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from starmart.llm.shared import let, row_of, running_sums

MATCHES = "array<struct<licence:string,start:int,end:int>>"

# Sentences of licence texts and notices, in normalised form.
SENTENCES = {
    "mit_release": "released under the mit license",
    "mit_notice": "this project is licensed under the mit license",
    "mit_grant": (
        "permission is hereby granted free of charge to any person obtaining a copy of this software and "
        "associated documentation files the software to deal in the software without restriction including "
        "without limitation the rights to use copy modify merge publish distribute sublicense and or sell copies "
        "of the software and to permit persons to whom the software is furnished to do so subject to the "
        "following conditions"
    ),
    "mit_condition": (
        "the above copyright notice and this permission notice shall be included in all copies or substantial "
        "portions of the software"
    ),
    "apache_notice": "licensed under the apache license version 2 0",
    "apache_terms": (
        "licensed under the apache license version 2 0 the license you may not use this file except in "
        "compliance with the license"
    ),
    "apache_copy": "you may obtain a copy of the license at http www apache org licenses license 2 0",
    "gpl2_notice": "this work is licensed under the gnu general public license version 2",
    "gpl3_notice": "this work is licensed under the gnu general public license version 3",
    "gpl_free": (
        "this program is free software you can redistribute it and or modify it under the terms of the gnu "
        "general public license as published by the free software foundation either version 3 of the license "
        "or at your option any later version"
    ),
    "gpl_hope": (
        "this program is distributed in the hope that it will be useful but without any warranty without even "
        "the implied warranty of merchantability or fitness for a particular purpose"
    ),
    "bsd_grant": (
        "redistribution and use in source and binary forms with or without modification are permitted provided "
        "that the following conditions are met"
    ),
    "bsd_name": (
        "neither the name of the copyright holder nor the names of its contributors may be used to endorse or "
        "promote products derived from this software without specific prior written permission"
    ),
    "isc_grant": (
        "permission to use copy modify and or distribute this software for any purpose with or without fee is "
        "hereby granted provided that the above copyright notice and this permission notice appear in all copies"
    ),
    "mpl_notice": "this source code form is subject to the terms of the mozilla public license v 2 0",
    "cc0_notice": "this work is dedicated to the public domain under cc0 1 0",
    "cc_by_notice": "licensed under cc by 4 0",
    "cc_by_sa_notice": "licensed under cc by sa 4 0",
    "cc_by_nc_notice": "licensed under cc by nc 4 0",
    "spdx_mit": "spdx license identifier mit",
    "spdx_apache": "spdx license identifier apache 2 0",
    "spdx_gpl3": "spdx license identifier gpl 3 0 only",
    "spdx_gpl3_later": "spdx license identifier gpl 3 0 or later",
    "spdx_bsd3": "spdx license identifier bsd 3 clause",
    "reserved": "all rights reserved",
    "apache_url": "you may obtain a copy of the license at https www apache org licenses license 2 0",
    "zlib_grant": (
        "permission is granted to anyone to use this software for any purpose including commercial applications and "
        "to alter it and redistribute it freely subject to the following restrictions"
    ),
    "unlicense": "this is free and unencumbered software released into the public domain",
    "boost_notice": "distributed under the boost software license version 1 0",
    "epl2_notice": (
        "this program and the accompanying materials are made available under the terms of the eclipse public license "
        "2 0 which is available at https www eclipse org legal epl 2 0"
    ),
    "epl2_http": (
        "this program and the accompanying materials are made available under the terms of the eclipse public license "
        "2 0 which is available at http www eclipse org legal epl 2 0"
    ),
    "epl1_notice": (
        "all rights reserved this program and the accompanying materials are made available under the terms of the "
        "eclipse public license v1 0 which accompanies this distribution and is available at http www eclipse org "
        "legal epl v10 html"
    ),
    "epl1_terms": (
        "this program and the accompanying materials are made available under the terms of the eclipse public license "
        "v1 0 which accompanies this distribution and is available at http www eclipse org legal epl v10 html"
    ),
}

# Notices of the GNU licences. {what} is the program or a library, {gnu} the licence's name.
GNU_LATER = (
    "{what} is free software you can redistribute it and or modify it under the terms of the gnu {gnu} as published by "
    "the free software foundation either version {version} of the license or at your option any later version"
)
GNU_ONLY = (
    "{what} is free software you can redistribute it and or modify it under the terms of the gnu {gnu} version {version} "
    "as published by the free software foundation"
)
GNU_HOPE = (
    "{what} is distributed in the hope that it will be useful but without any warranty without even the implied "
    "warranty of merchantability or fitness for a particular purpose"
)
WHATS = ["this program", "this library", "this file", "this software"]
GNU = [
    ("GPL-2.0", "general public license", "2"),
    ("GPL-3.0", "general public license", "3"),
    ("LGPL-2.0", "library general public license", "2"),
    ("LGPL-2.1", "lesser general public license", "2 1"),
    ("LGPL-3.0", "lesser general public license", "3"),
    ("AGPL-3.0", "affero general public license", "3"),
]

# Licences that are known by their SPDX identifier.
SPDX = [
    "MIT", "MIT-0", "Apache-2.0", "BSD-2-Clause", "BSD-3-Clause", "ISC", "Zlib", "Unlicense", "BSL-1.0", "MPL-2.0", "EPL-1.0", "EPL-2.0",
    "CC0-1.0", "CC-BY-4.0", "CC-BY-SA-4.0", "CC-BY-NC-4.0", "CC-BY-ND-4.0", "CC-BY-NC-SA-4.0", "CC-BY-NC-ND-4.0",
    *[f"{name}-{kind}" for name, _, _ in GNU for kind in ("only", "or-later")],
]

# Licences and the sentences that make them, in order. The first rule
# that matches at a sentence takes it, so longer ones come first.
RULES = [
    ("MIT", ["mit_grant", "mit_condition"]),
    ("MIT", ["mit_grant"]),
    ("MIT", ["mit_release"]),
    ("MIT", ["mit_notice"]),
    ("MIT", ["spdx_mit"]),
    ("Apache-2.0", ["apache_terms", "apache_copy"]),
    ("Apache-2.0", ["apache_terms", "apache_url"]),
    ("Apache-2.0", ["apache_terms"]),
    ("Apache-2.0", ["apache_notice"]),
    ("Apache-2.0", ["spdx_apache"]),
    ("GPL-3.0-or-later", ["gpl_free", "gpl_hope"]),
    ("GPL-3.0-or-later", ["gpl_free"]),
    ("GPL-3.0-or-later", ["spdx_gpl3_later"]),
    ("GPL-3.0-only", ["gpl3_notice"]),
    ("GPL-3.0-only", ["spdx_gpl3"]),
    ("GPL-2.0-only", ["gpl2_notice"]),
    ("BSD-3-Clause", ["bsd_grant", "bsd_name"]),
    ("BSD-3-Clause", ["spdx_bsd3"]),
    ("BSD-2-Clause", ["bsd_grant"]),
    ("ISC", ["isc_grant"]),
    ("MPL-2.0", ["mpl_notice"]),
    ("CC0-1.0", ["cc0_notice"]),
    ("CC-BY-4.0", ["cc_by_notice"]),
    ("CC-BY-SA-4.0", ["cc_by_sa_notice"]),
    ("CC-BY-NC-4.0", ["cc_by_nc_notice"]),
    ("EPL-1.0", ["epl1_notice"]),
    ("EPL-1.0", ["epl1_terms"]),
    ("EPL-2.0", ["epl2_notice"]),
    ("EPL-2.0", ["epl2_http"]),
    ("Zlib", ["zlib_grant"]),
    ("Unlicense", ["unlicense"]),
    ("BSL-1.0", ["boost_notice"]),
    ("LicenseRef-all-rights-reserved", ["reserved"]),
]


def _add(name: str, sentence: str) -> str:
    """The name of the sentence, which is added unless it is known."""
    for known, text in SENTENCES.items():
        if text == sentence:
            return known
    SENTENCES[name] = sentence
    return name


for _what in WHATS:
    _hope = _add(f"hope {_what}", GNU_HOPE.format(what=_what))
    for _name, _gnu, _version in GNU:
        for _kind, _form in (("or-later", GNU_LATER), ("only", GNU_ONLY)):
            _terms = _add(f"{_name}-{_kind} {_what}", _form.format(what=_what, gnu=_gnu, version=_version))
            RULES += [(f"{_name}-{_kind}", [_terms, _hope]), (f"{_name}-{_kind}", [_terms])]
for _name in SPDX:
    RULES.append((_name, [_add(f"spdx {_name}", "spdx license identifier " + _name.lower().replace("-", " ").replace(".", " "))]))


# What groups of sentences have in common; texts without it need no look at the group.
ANCHORS = ["spdx license identifier", "is free software you can redistribute it", "is distributed in the hope", "license", ""]


def normalised(sentence: Column) -> Column:
    """Lower case, one space for each run of what is neither letter nor digit, British spelling as American."""
    plain = F.trim(F.regexp_replace(F.lower(sentence), r"[^\p{L}\p{N}]+", " "))
    return F.regexp_replace(plain, r"\blicence", "license")


def _pieces(text: Column) -> Column:
    """(start, end, plain) of the lines of a text, cut at sentence ends too, without those that have neither letter nor digit."""
    # One character for one, so that offsets stay.
    parts = F.split(F.regexp_replace(text, r"([.!?])\s", "$1\n"), "\n", -1)

    def placed(ps: Column) -> Column:
        ends = running_sums(F.transform(ps, lambda p: F.length(p) + 1))
        span = lambda p, e: F.struct((e - 1 - F.length(p)).alias("start"), (e - 1).alias("end"), normalised(p).alias("plain"))
        return F.zip_with(ps, ends, span)

    return F.filter(let(parts, placed), lambda p: p["plain"] != "")


def _known(names: list[str]) -> tuple[Column, Column]:
    """The sentences that a text may have, as ``possible``; (sentence number, start, end) of those that its ``pieces`` make.

    One piece or several in a row make a sentence; at each the longest counts.
    """
    most = max(len(SENTENCES[n].split(" ")) for n in names)  # pieces of one sentence: each has a word
    groups: dict[str, list[Column]] = {}
    for k, n in enumerate(names):
        anchor = next(a for a in ANCHORS if a in SENTENCES[n])
        groups.setdefault(anchor, []).append(F.struct(F.lit(k + 1).alias("s"), F.lit(SENTENCES[n]).alias("text")))
    plain = F.transform("pieces", lambda p: p["plain"])
    whole, none = F.col("whole"), F.array().cast("array<struct<s:int,text:string>>")
    found_in = lambda texts: F.filter(F.array(*texts), lambda t: F.contains(whole, t["text"]))
    possible = F.concat(*[F.when(F.contains(whole, F.lit(a)), found_in(texts)).otherwise(none) for a, texts in groups.items()])

    def made(k: Column, t: Column) -> Column:
        """How many pieces from the k-th on make the sentence, or NULL."""
        sizes = F.sequence(F.lit(1), F.least(F.lit(most), F.size("pieces") - k))
        fits = F.get(F.filter(sizes, lambda m: F.concat_ws(" ", F.slice(plain, k + 1, m)) == t["text"]), F.lit(0))
        return F.when(F.startswith(t["text"], F.get("pieces", k)["plain"]), fits)

    def longest(k: Column) -> Column:
        all_ = F.transform("possible", lambda t: F.struct(F.length(t["text"]).alias("size"), t["s"].alias("s"), made(k, t).alias("n")))
        return F.array_max(F.filter(all_, lambda f: f["n"].isNotNull()))

    begin = F.struct(F.lit(0).alias("next"), F.array().cast("array<struct<s:int,start:int,end:int>>").alias("out"))

    def add(state: Column, k: Column) -> Column:
        def step(best: Column) -> Column:
            last = F.get("pieces", k + best["n"] - 1)
            found = F.struct(best["s"].alias("s"), F.get("pieces", k)["start"].alias("start"), last["end"].alias("end"))
            fits = (k >= state["next"]) & best.isNotNull()
            return F.struct(
                F.when(fits, k + best["n"]).otherwise(state["next"]).alias("next"),
                F.when(fits, F.concat(state["out"], F.array(found))).otherwise(state["out"]).alias("out"),
            )

        return let(longest(k), step)

    return possible, F.aggregate(F.sequence(F.lit(0), F.size("pieces") - 1), begin, add, lambda state: state["out"])


def licensed(docs: DataFrame) -> DataFrame:
    """Every row as the struct ``_doc``, with ``sentences`` and ``matches``.

    Pieces end at a line end or at ``.``, ``!`` or ``?`` before white space. Each is normalised, which
    drops comment marks, and one or several in a row are looked up among the known sentences, so that
    these may be wrapped; ``sentences`` lists those found as (s, start, end). A rule
    matches where its sentences stand in that list one after the other, and ``matches``
    lists (licence, start, end) of the rules found, from left to right, none
    sharing a sentence. Offsets count code points of the original text, ends are exclusive.

    The tables of sentences and rules are small and fixed, so they are part of the
    expression: a row is worked on where it lies and nothing is shuffled. A NULL or
    empty text has no licence; repeated rows stay; other columns stay in ``_doc``; an empty table gives no rows.
    """
    names = list(SENTENCES)
    rows = docs.select(row_of(docs))
    text = F.coalesce(F.col("_doc.text").cast("string"), F.lit(""))
    none = F.array().cast("array<struct<s:int,start:int,end:int>>")
    possible, known = _known(names)
    rows = rows.withColumn("pieces", _pieces(text)).withColumn("whole", F.array_join(F.transform("pieces", lambda p: p["plain"]), " "))
    rows = rows.withColumn("possible", possible)
    rows = rows.withColumn("sentences", F.when(F.size("possible") > 0, known).otherwise(none)).select("_doc", "sentences")
    rules = F.array(
        *[
            F.struct(F.lit(licence).alias("licence"), F.array(*[F.lit(names.index(n) + 1) for n in order]).alias("order"))
            for licence, order in RULES
        ]
    )

    rows = rows.withColumn("order", F.transform("sentences", lambda x: x["s"]))

    def at(k: Column) -> Column:
        here = lambda rule: F.slice("order", k + 1, F.size(rule["order"])) == rule["order"]
        return F.get(F.filter(rules, here), F.lit(0))

    begin = F.struct(F.lit(0).alias("next"), F.array().cast(MATCHES).alias("out"))

    def add(state: Column, k: Column) -> Column:
        def step(rule: Column) -> Column:
            last = k + F.size(rule["order"]) - 1
            found = F.struct(
                rule["licence"].alias("licence"), F.get("sentences", k)["start"].alias("start"), F.get("sentences", last)["end"].alias("end")
            )
            fits = (k >= state["next"]) & rule.isNotNull()
            return F.struct(
                F.when(fits, last + 1).otherwise(state["next"]).alias("next"),
                F.when(fits, F.concat(state["out"], F.array(found))).otherwise(state["out"]).alias("out"),
            )

        return let(at(k), step)

    found = F.aggregate(F.sequence(F.lit(0), F.size("sentences") - 1), begin, add, lambda state: state["out"])
    matches = F.when(F.size("sentences") > 0, found).otherwise(F.array().cast(MATCHES))
    return rows.select("_doc", "sentences", matches.alias("matches"))


def digest(found: DataFrame) -> DataFrame:
    """One row per row of ``licensed``: its different licences by name, and the spans as ``licence:start:end``."""
    span = lambda m: F.concat_ws(":", m["licence"], m["start"].cast("string"), m["end"].cast("string"))
    return found.select(
        F.col("_doc.doc_id").alias("doc_id"),
        F.array_join(F.array_sort(F.array_distinct(F.transform("matches", lambda m: m["licence"]))), ",").alias("licences"),
        F.size("matches").cast("long").alias("n_matches"),
        F.array_join(F.transform("matches", span), ",").alias("spans"),
    )
