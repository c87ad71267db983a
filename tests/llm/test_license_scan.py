import math
import re
import time
from collections import Counter

from fadeclust.llm.license_scan import CUES, TEMPLATES, VOCABULARY, scan_licenses


def brute(files, threshold):
    toks = lambda s: [t for t in re.split("[^a-z0-9]+", (s or "").lower()) if t]
    n = len(files)
    df = Counter(t for _, _, s in files for t in set(toks(s)) & set(VOCABULARY))
    idf = lambda t: math.log((1 + n) / (1 + df[t])) + 1

    def vec(s):
        v = {t: c * idf(t) for t, c in Counter(toks(s)).items()}
        k = math.sqrt(sum(x * x for x in v.values()))
        return {t: x / k for t, x in v.items()} if k else {}

    temps = [(lic, vec(s)) for lic, s in TEMPLATES]

    def best(s):
        v = vec(s)
        c = [(-round(sum(v.get(t, 0) * x for t, x in w.items()), 6), lic) for lic, w in temps]
        s, lic = min(c)
        return (lic, -s) if -s >= threshold else None

    own = {}
    for i, _, s in files:
        if s and re.search(CUES, s.lower()):
            if b := best(s):
                own[i] = ("file", *b)
            elif heads := [b for line in s.split("\n") if re.search(CUES, line.lower()) and (b := best(line))]:
                own[i] = ("header", *min(heads, key=lambda b: (-b[1], b[0])))
    dirs = {}
    for i, p, _ in files:
        if i in own and p is not None and (own[i][0] == "file" or re.match("LICEN[CS]E|COPYING", p.split("/")[-1].upper())):
            d = p.rpartition("/")[0]
            dirs.setdefault(d, []).append((-own[i][2], p, own[i][1]))
    out = {}
    for i, p, _ in files:
        if i in own:
            out[i] = (own[i][1], own[i][0], own[i][2], None)
            continue
        out[i] = (None, "none", 0.0, None)
        d = p.rpartition("/")[0] if p is not None else None
        while d is not None:
            if d in dirs:
                _, path, lic = min(dirs[d])
                out[i] = (lic, "inherited", 0.0, path)
                break
            d = d.rpartition("/")[0] if d else None
    return out


def test_matches_brute_force(spark):
    mit, apache, gpl, cc = "Released under the MIT License.", "Licensed under the Apache License, Version 2.0.", \
        "This work is licensed under the GNU General Public License, version 3.", "Licensed under CC BY-NC 4.0."
    files = [(0, "a/LICENSE", mit), (1, "a/x.py", "some code"), (2, "a/b/y.py", "more code\n# " + apache + "\nand of the rest"),
             (3, "a/b/c/z.py", "the of and"), (4, "a/b/LICENSE.txt", "See here\n" + gpl), (5, "a/b/c/d/e.py", None), (6, "b/readme", "licensed software " * 30),
             (7, "top.py", "x"), (8, None, "y"), (9, None, cc), (10, "c/q", "Copyright notice\n" + cc + "\n" + apache), (11, "d/COPYING", "nothing about it"),
             (12, "d/f", "x"), (13, "e/n1", apache), (14, "e/f/g", "x"), (15, "", "x"), (16, "a//b", "x"), (17, "Licence", ""), (18, "g/LICENSE", apache.upper()),
             (19, "g/COPYING", mit + " extra words"), (20, "g/x", "z"), (21, "h/x", "This is free and unencumbered software released into the public domain.")]
    df = spark.createDataFrame([(*f, "clash") for f in files], "id long, path string, text string, license string").repartition(3)
    got = {r.id: (r.license, r.how, round(r.score, 6), r.origin) for r in scan_licenses(df).collect()}
    want = brute(files, 0.9)
    assert len(got) == len(files)
    for i, w in want.items():
        assert got[i][:2] == w[:2] and abs(got[i][2] - w[2]) < 2e-6 and got[i][3] == w[3], (i, got[i], w)
    assert got[1] == ("MIT", "inherited", 0.0, "a/LICENSE") and got[3][0] == "GPL-3.0" and got[5][3] == "a/b/LICENSE.txt" and got[2][0] == "Apache-2.0"
    plan = scan_licenses(df)._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Arrow|Pandas", plan)


def test_repeated_ids_and_empty(spark):
    df = spark.createDataFrame([(1, "a/b", "Released under the MIT License.")] * 2, "id long, path string, text string")
    assert [(r.license, r.how) for r in scan_licenses(df).collect()] == [("MIT", "file")] * 2
    assert scan_licenses(df.limit(0)).count() == 0


MIT = """MIT License

Copyright (c) 2020 Jane Doe

Permission is hereby granted, free of charge, to any person obtaining a copy
of this software and associated documentation files (the "Software"), to deal
in the Software without restriction, including without limitation the rights
to use, copy, modify, merge, publish, distribute, sublicense, and/or sell
copies of the Software, and to permit persons to whom the Software is
furnished to do so, subject to the following conditions:

The above copyright notice and this permission notice shall be included in all
copies or substantial portions of the Software.
"""
APACHE = "                                 Apache License\n                           Version 2.0, January 2004\n" \
    "                        http://www.apache.org/licenses/\n\n   TERMS AND CONDITIONS FOR USE, REPRODUCTION, AND DISTRIBUTION\n"
BSD2 = """Copyright (c) 2019, Acme
All rights reserved.

Redistribution and use in source and binary forms, with or without
modification, are permitted provided that the following conditions are met:

1. Redistributions of source code must retain the above copyright notice, this
   list of conditions and the following disclaimer.

2. Redistributions in binary form must reproduce the above copyright notice,
   this list of conditions and the following disclaimer in the documentation
   and/or other materials provided with the distribution.
"""
BSD3 = BSD2 + """
3. Neither the name of Acme nor the names of its contributors may be used to
   endorse or promote products derived from this software without specific
   prior written permission.
"""
GPL = """# This program is free software: you can redistribute it and/or modify
# it under the terms of the GNU {}General Public License as published by
# the Free Software Foundation, either version {} of the License, or
# (at your option) any later version.
#
# This program is distributed in the hope that it will be useful,
# but WITHOUT ANY WARRANTY.  See the GNU {}General Public License for more details.
"""
MPL = """/* This Source Code Form is subject to the terms of the Mozilla Public
 * License, v. 2.0. If a copy of the MPL was not distributed with this
 * file, You can obtain one at https://mozilla.org/MPL/2.0/. */
"""


def test_real_texts(spark):
    code = "\n".join(f"def f{i}(x, y):\n    return x * {i} + y" for i in range(80))
    want = [("m/LICENSE", MIT, "MIT", "file"), ("m/src/a.py", code, "MIT", "inherited"), ("m/b.c", MIT + code, "MIT", "header"),
            ("a/LICENSE", APACHE, "Apache-2.0", None), ("a/x.py", code, "Apache-2.0", "inherited"),
            ("b2/COPYING", BSD2, "BSD-2-Clause", "file"), ("b3/LICENSE.txt", BSD3, "BSD-3-Clause", "file"), ("b3/q", code, "BSD-3-Clause", "inherited"),
            ("g/2.py", GPL.format("", 2, "") + code, "GPL-2.0", "header"), ("g/3.py", GPL.format("", 3, "") + code, "GPL-3.0", "header"),
            ("g/a.py", GPL.format("Affero ", 3, "Affero ") + code, "AGPL-3.0", "header"), ("g/l.py", GPL.format("Lesser ", 3, "Lesser ") + code, "LGPL-3.0", "header"),
            ("g/none.py", code, None, "none"), ("p/x.c", MPL + code, "MPL-2.0", "header"),
            ("t/COPYING", "                    GNU GENERAL PUBLIC LICENSE\n                       Version 3, 29 June 2007\n" + code, "GPL-3.0", None),
            ("i/LICENSE", "Permission to use, copy, modify, and/or distribute this software for any\npurpose with or without fee is hereby granted, provided that the above\n"
             "copyright notice and this permission notice appear in all copies.", "ISC", "file"),
            ("s/1.c", "// SPDX-License-Identifier: GPL-2.0-or-later\n" + code, "GPL-2.0", "header"),
            ("s/2.c", "/* SPDX-License-Identifier: (mit OR Apache-2.0) */\n" + code, "(mit OR Apache-2.0)", "header"),
            ("s/3.c", "/* spdx-license-identifier: mit */\n" + code, "MIT", "header"),
            ("w/1.py", "# Licensed under the Apache\n# License, Version 2.0.\n" + code, "Apache-2.0", "header"),
            ("n/1", "We discuss the MIT license, the copyright and the permission of others at length.\n" + code, None, "none")]
    df = spark.createDataFrame([(i, p, x) for i, (p, x, _, _) in enumerate(want)], "id long, path string, text string").repartition(3)
    out = scan_licenses(df)
    got = {r.path: (r.license, r.how) for r in out.collect()}
    for path, _, lic, how in want:
        assert got[path][0] == lic and how in (None, got[path][1]), (path, got[path])
    assert not re.search("Python|Arrow|Pandas", out._jdf.queryExecution().executedPlan().toString())


def test_long_cued_text_and_headers_over_many_lines(spark):
    words = "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.".split()
    wrapped = "#!/bin/sh\n#\n" + "\n".join(f"# {' '.join(words[i:i + 2])}" for i in range(0, len(words), 2)) + "\n#\n# other text of the file\nx = 1\n"
    long = "license " + " ".join(f"w{k % 5000}" for k in range(200_000))
    rows = [(1, "a/x.sh", wrapped), (2, "a/y.txt", long), (3, "a/z.txt", "license\n" * 20_000)]
    df = spark.createDataFrame(rows, "id long, path string, text string").repartition(3)
    scan_licenses(df.where("id = 1")).collect()
    start = time.perf_counter()
    got = {r.id: (r.license, r.how) for r in scan_licenses(df).collect()}
    assert time.perf_counter() - start < 60 and got[1] == ("MPL-2.0", "header") and got[2] == got[3] == (None, "none")
