"""Licences of files: TF-IDF cosine to templates, then inheritance by directory.

DataFrame functions only.  Tokens are runs of a-z and 0-9 of the lower-cased
text.  A token's weight in a text is its count times

    idf = ln((1 + files) / (1 + files with the token)) + 1,

counted over all files for the templates' tokens; any other token weighs as one
that no file has, so foreign words lower the cosine.

* A *header* is a line, anywhere in a file, that holds a cue word (``CUES``); its
  licence is the template of largest cosine, if that is ``threshold`` or more.
* A file whose text and lines reach no template is read in three more ways, the
  first that gives a licence decides: an SPDX-License-Identifier (its expression,
  without ``-only`` and ``-or-later``); the standard wordings (``FORMS``), held
  across line ends and comment marks, of which the text must hold the deciding
  phrase and ``threshold`` of the three-word shingles (the score); windows of two
  to four consecutive lines and whole blocks of lines (between lines without text,
  also in comments), joined and compared like a header.  A wording counts
  as the whole text if it makes up half of the text's shingles, else as a header.
* A *licence file* has a name that starts with LICENSE, LICENCE or COPYING, or a
  whole text that reaches the threshold; its licence holds for its directory and
  everything below.
* A file's own licence is its whole text's match or else its best header's.  A
  file without one inherits from the licence file of the nearest directory above
  it (its own directory included), found by joining directories' ancestors.

Equal cosines go to the alphabetically first licence, and two licence files of
one directory to the better match, then to the first name.  Null or empty texts
have no licence of their own; a null path inherits nothing.  Rows that repeat an
id count as one file in matching and give one row each.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .work import bounded, written

# Licence, one sentence of its header or text.
TEMPLATES = [
    ("AGPL-3.0", "This work is licensed under the GNU Affero General Public License, version 3."),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", "You may not use this file except in compliance with the Apache License, Version 2.0."),
    ("BSD-2-Clause", "Licensed under the BSD 2-Clause License."),
    ("BSD-3-Clause", "Licensed under the BSD 3-Clause License."),
    ("BSD-3-Clause", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met"),
    ("BSL-1.0", "Distributed under the Boost Software License, Version 1.0."),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-NC-SA-4.0", "Licensed under CC BY-NC-SA 4.0."),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
    ("CC0-1.0", "Released into the public domain under CC0 1.0."),
    ("EPL-2.0", "Licensed under the Eclipse Public License, version 2.0."),
    ("GPL-2.0", "This work is licensed under the GNU General Public License, version 2."),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("ISC", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted"),
    ("LGPL-3.0", "This work is licensed under the GNU Lesser General Public License, version 3."),
    ("MIT", "Released under the MIT License."),
    ("MIT", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files"),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
    ("Unlicense", "This is free and unencumbered software released into the public domain."),
]
CUES = "licen[cs]e|copyright|spdx|permission|redistribution|public domain|cc0"
_SPLIT = "[^a-z0-9]+"
_BETWEEN = "\n[ \t#*/;-]*\n"  # lines without text, also in comments, end a block
_GNU = [("AGPL-3.0", "affero general", "3"), ("GPL-2.0", "general", "2"), ("GPL-3.0", "general", "3"),
        ("LGPL-2.1", "lesser general", "2 1"), ("LGPL-3.0", "lesser general", "3")]
_BSD = ["Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met",
        "Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer",
        "Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer"
        " in the documentation and/or other materials provided with the distribution"]
# Licence, deciding phrase (a pattern over the text's tokens with single blanks), pieces of the wording.
FORMS = [
    ("Apache-2.0", "licensed under the apache license version 2 0", [
        "Licensed under the Apache License, Version 2.0 (the License); you may not use this file except in compliance with the License."
        " You may obtain a copy of the License at"]),
    ("Apache-2.0", "^apache license version 2 0( |$)", ["Apache License Version 2.0"]),
    ("BSD-2-Clause", "redistributions in binary form", _BSD),
    ("BSD-3-Clause", "neither the name ", [*_BSD, "Neither the name of", "may be used to endorse or promote products derived from this software without specific prior written permission"]),
    ("BSL-1.0", "^boost software license version 1 0( |$)", ["Boost Software License - Version 1.0"]),
    ("CC0-1.0", "^(creative commons legal code )?cc0 1 0 universal( |$)", ["CC0 1.0 Universal"]),
    ("EPL-2.0", "^eclipse public license v(ersion)? ?2 0( |$)", ["Eclipse Public License"]),
    ("ISC", "above copyright notice and this permission notice appear in all copies", [
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted,"
        " provided that the above copyright notice and this permission notice appear in all copies"]),
    ("MIT", "permission is hereby granted free of charge to any person obtaining a copy", [
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files"
        " (the Software), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge,"
        " publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so,"
        " subject to the following conditions",
        "The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software"]),
    ("MIT", "^(the )?mit license( mit)?( copyright|$)", ["MIT License"]),
    ("MPL-2.0", "mozilla public license v 2 0", [
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
        "If a copy of the MPL was not distributed with this file, You can obtain one at"]),
    ("MPL-2.0", "^mozilla public license version 2 0( |$)", ["Mozilla Public License Version 2.0"]),
    ("Unlicense", "this is free and unencumbered software released into the public domain", [
        "This is free and unencumbered software released into the public domain.",
        "Anyone is free to copy, modify, publish, use, compile, sell, or distribute this software"]),
    *[(lic, f"gnu {name} public license (as published by the free software foundation )?(either )?version {v} (of|as) ", [
        "redistribute it and/or modify it under the terms of the GNU", f"GNU {name} public license", "published by the Free Software Foundation"]) for lic, name, v in _GNU],
    *[(lic, f"^gnu {name} public license version {v} (19|29 june|february)", [f"GNU {name} public license version"]) for lic, name, v in _GNU],
]
_ID = "[A-Za-z0-9](?:[A-Za-z0-9.+-]*[A-Za-z0-9+])?"
_SPDX = rf"(?i)spdx-license-identifier:[ \t]*(\(?{_ID}\)?(?:[ \t]+(?:and|or|with)[ \t]+\(?{_ID}\)?)*)"
VOCABULARY = sorted({t for _, s in TEMPLATES for t in re.split(_SPLIT, s.lower()) if t})


def _tokens(text: Column) -> Column:
    return F.filter(F.split(F.lower(text), _SPLIT), lambda t: t != "")


def _norm(weights: DataFrame, *keys: str) -> DataFrame:
    return weights.groupBy(*keys).agg(F.sqrt(F.sum(F.col("w") * F.col("w"))).alias("norm"))


def _runs(parts: Column, n: int) -> Column:
    """All runs of n consecutive strings, each joined by blanks: shifted copies
    zipped, so that ``parts`` is computed a fixed number of times."""
    number = F.size(parts) - (n - 1)
    joined = F.slice(parts, F.lit(1), number)
    for k in range(2, n + 1):
        joined = F.zip_with(joined, F.slice(parts, F.lit(k), number), lambda a, b: F.concat(a, F.lit(" "), b))
    return F.when(F.size(parts) >= n, joined).otherwise(F.array().cast("array<string>"))


def match_licenses(files: DataFrame, threshold: float) -> DataFrame:
    """``id, whole, license, score``: the best template of each whole text and
    of each file's best header, where they reach the threshold, else what the
    file's standard wordings, windows of two to four lines or whole blocks of lines give (columns ``id`` and ``text``)."""
    vocabulary = F.array(*[F.lit(t) for t in VOCABULARY])
    total = files.count()
    held = files.select(F.explode(F.array_intersect(F.split(F.lower("text"), _SPLIT), vocabulary)).alias("t")).groupBy("t").count()
    idf = written(held.select("t", (F.log(F.lit(1.0 + total) / (F.col("count") + 1)) + 1).alias("idf")), "idf")  # at most the vocabulary
    foreign = F.log(F.lit(1.0 + total)) + 1

    def weigh(tokens: DataFrame, *keys: str) -> DataFrame:
        return tokens.groupBy(*keys, "t").agg(F.count(F.lit(1)).alias("tf")).join(F.broadcast(idf), "t", "left") \
            .select(*keys, "t", (F.col("tf") * F.coalesce("idf", foreign)).alias("w"))

    template = files.sparkSession.range(1).select(F.inline(F.array(*[
        F.struct(F.lit(i).alias("template"), F.lit(lic).alias("license"), F.lit(s).alias("text")) for i, (lic, s) in enumerate(TEMPLATES)])))
    tw = weigh(template.select("template", "license", F.explode(_tokens(F.col("text"))).alias("t")), "template", "license")
    tw = written(tw.join(_norm(tw, "template"), "template").select("license", "template", "t", (F.col("w") / F.col("norm")).alias("tw")), "templates")

    def score(units: DataFrame) -> DataFrame:
        """The best template of units ``id, unit, part``; unit 0 is the whole text."""
        units = written(units, "units")
        uw = written(weigh(units.select("id", "unit", F.explode(_tokens(F.col("part"))).alias("t")), "id", "unit"), "weights")
        dots = uw.join(F.broadcast(tw), "t").groupBy("id", "unit", "template", "license").agg(F.sum(F.col("w") * F.col("tw")).alias("dot"))
        scored = dots.join(_norm(uw, "id", "unit"), ["id", "unit"]).select(
            "id", (F.col("unit") == 0).alias("whole"), "license", F.round(F.col("dot") / F.col("norm"), 6).alias("score")).where(F.col("score") >= threshold)
        # largest score, then the first licence
        return scored.groupBy("id", "whole", "license").agg(F.max("score").alias("score")).groupBy("id", "whole") \
            .agg(F.min(F.struct((-F.col("score")).alias("s"), "license")).alias("best")) \
            .select("id", "whole", "best.license", (-F.col("best.s")).alias("score"))

    has_cue = lambda x: F.lower(x).rlike(CUES)
    cued = files.where(has_cue(F.col("text")))
    found = written(score(cued.select("id", F.posexplode(F.array_union(F.array(F.col("text")), F.filter(F.split("text", "\n"), has_cue))).alias("unit", "part"))), "scored")
    # the files that are left, by standard wordings and by windows of lines
    left = written(cued.join(found.select("id").distinct().hint("merge"), "id", "left_anti"), "left")
    worded = written(_wordings(left, threshold), "wordings")
    lines = F.split("text", "\n")
    blocks = F.split("text", _BETWEEN)
    windows = F.concat(*[_runs(lines, n) for n in (2, 3, 4)], F.when(F.size(blocks) > 1, blocks).otherwise(F.array().cast("array<string>")))
    rest = left.join(worded.select("id").hint("merge"), "id", "left_anti") \
        .select("id", F.posexplode(F.filter(windows, has_cue)).alias("unit", "part")).withColumn("unit", F.col("unit") + 1)
    return found.unionByName(worded).unionByName(score(rest))


def _wordings(files: DataFrame, threshold: float) -> DataFrame:
    """``id, whole, license, score`` of files that name or hold a licence in a
    standard form: SPDX identifiers first, then the form of most shingles."""
    def shingles(piece: str) -> list[str]:
        w = [t for t in re.split(_SPLIT, piece.lower()) if t]
        return [" ".join(w[i:i + 3]) for i in range(max(1, len(w) - 2))]

    forms = [(lic, phrase, sorted({x for piece in pieces for x in shingles(piece)})) for lic, phrase, pieces in FORMS]
    strings = lambda values: F.array(*[F.lit(v) for v in values])
    table = F.array(*[F.struct(F.lit(lic).alias("license"), F.lit(phrase).alias("phrase"), strings(own).alias("own")) for lic, phrase, own in forms])
    words = F.split("plain", " ")
    plain = files.withColumn("plain", F.trim(F.regexp_replace(F.lower("text"), _SPLIT, " ")))
    # forms may have pieces of two words
    held = plain.select("id", "plain", F.array_distinct(_runs(words, 3)).alias("runs"), F.array_distinct(_runs(words, 2)).alias("pairs"))
    every = strings(sorted({x for _, _, own in forms for x in own}))
    held = held.select("id", "plain", F.array_union(F.array_intersect("runs", every), F.array_intersect("pairs", every)).alias("hit"),
                       F.size("runs").alias("n"), F.size(F.array_intersect("runs", every)).alias("covered"))
    matched = held.where(F.size("hit") > 0).select("id", "plain", "hit", "n", "covered", F.inline(table)).where(F.expr("plain rlike phrase")) \
        .withColumn("common", F.size(F.array_intersect("hit", "own"))) \
        .select("id", "license", (2 * F.col("covered") >= F.col("n")).alias("whole"), "common", F.round(F.col("common") / F.size("own"), 6).alias("score")) \
        .where(F.col("score") >= threshold).select("id", F.struct(F.lit(1).alias("rank"), (-F.col("common")).alias("c"), "license", (~F.col("whole")).alias("part"), "score").alias("m"))
    named = F.regexp_replace(F.regexp_extract("text", _SPDX, 1), "(?i)-(only|or-later)", "")
    known = F.create_map(*[F.lit(x) for lic in sorted({x[0] for x in [*TEMPLATES, *FORMS]}) for x in (lic.lower(), lic)])
    spdx = files.select("id", named.alias("spdx")).where("spdx != ''").select("id", F.struct(
        F.lit(0).alias("rank"), F.lit(0).alias("c"), F.coalesce(F.try_element_at(known, F.lower("spdx")), "spdx").alias("license"),
        F.lit(True).alias("part"), F.lit(1.0).alias("score")).alias("m"))
    return matched.union(spdx).groupBy("id").agg(F.min("m").alias("m")).select("id", (~F.col("m.part")).alias("whole"), "m.license", "m.score")


def scan_licenses(files: DataFrame, id_col: str = "id", path_col: str = "path", text_col: str = "text", threshold: float = 0.9) -> DataFrame:
    """One row per file: ``id, path, license, how`` (file, header, inherited or
    none), ``score`` (cosine, 6 decimals) and ``origin`` (path of the licence
    file that an inherited licence comes from)."""
    rows = files.select(F.col(f"`{id_col}`").cast("long").alias("id"), F.col(f"`{path_col}`").alias("path"), F.col(f"`{text_col}`").alias("text"))
    found = written(match_licenses(rows.select("id", "text"), threshold), "matches")
    own = written(found.groupBy("id").agg(F.min(F.struct(F.when(F.col("whole"), 0).otherwise(1).alias("rank"), "license", "score")).alias("m"))
                  .select("id", "m.license", "m.score", F.when(F.col("m.rank") == 0, "file").otherwise("header").alias("how")), "own")
    placed = rows.select("id", "path", F.when(F.instr("path", "/") > 0, F.regexp_replace("path", "/[^/]*$", "")).when(F.col("path").isNotNull(), "").alias("dir"),
                         F.element_at(F.split("path", "/"), -1).alias("name"))
    named = placed.join(bounded(own), "id", "left")
    holders = named.where(F.col("license").isNotNull() & F.col("dir").isNotNull() & ((F.col("how") == "file") | F.upper("name").rlike("^(LICEN[CS]E|COPYING)")))
    at_dir = written(holders.groupBy("dir").agg(F.min(F.struct((-F.col("score")).alias("s"), "path", "license")).alias("m"))
                     .select(F.col("dir").alias("above"), "m.license", "m.path"), "holders")
    # each distinct directory once, with all directories above it
    dirs = written(placed.where("dir is not null").select("dir").distinct(), "dirs")
    parts = F.split("dir", "/")
    above = F.concat(F.array(F.lit("")), F.transform(F.sequence(F.lit(1), F.size(parts)), lambda i: F.array_join(F.slice(parts, F.lit(1), i), "/")))
    nearest = dirs.select("dir", F.posexplode(F.array_distinct(above)).alias("depth", "above")).join(bounded(at_dir), "above") \
        .groupBy("dir").agg(F.max(F.struct("depth", "license", "path")).alias("m")) \
        .select("dir", F.col("m.license").alias("given"), F.col("m.path").alias("giver"))
    nearest = written(nearest, "nearest")
    joined = named.join(bounded(nearest), "dir", "left")
    inherits = F.col("license").isNull() & F.col("given").isNotNull()
    return joined.select(
        "id", "path", F.coalesce("license", "given").alias("license"),
        F.when(F.col("license").isNotNull(), F.col("how")).when(inherits, "inherited").otherwise("none").alias("how"),
        F.coalesce("score", F.lit(0.0)).alias("score"), F.when(inherits, F.col("giver")).alias("origin"))
