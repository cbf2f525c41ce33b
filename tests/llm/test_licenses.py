import math
import re

from tilelake.llm import licenses


def test_families_and_clean_text(spark):
    rows, want = [], {}
    for f, texts in licenses.TEMPLATES.items():
        for t in texts:
            want[len(rows)] = f
            rows.append((len(rows), f"Some words about nothing at all.\n{t.upper()}\nMore of the same in the end."))
    n = len(rows)
    plain = ["The licence was revoked by the town after the fair.", "He asked for permission to use the hall, free of charge.", "", None, "one", "It is the end of the road and of the work.", "no line ends " * 400]
    rows += [(n + i, t) for i, t in enumerate(plain)]
    rows += [(900, "Licensed under the Apache License, Version 2.0\r\nx\nReleased under the MIT License"), (900, "again"), (None, "Released under the MIT License."), (901, "Released under the MIT License."), (901, "Released under the MIT License.")]
    df = spark.createDataFrame([(*r, "x", 1.0) for r in rows], "doc_id long, text string, families string, score double")
    got = licenses.scan(df, sample=50).collect()
    assert len(got) == len(rows)
    by = {}
    for r in got:
        by.setdefault(r.doc_id, []).append(r)
    wrong = {i: (f, by[i][0].families) for i, f in want.items() if by[i][0].families != f}
    assert not wrong
    assert all(by[n + i][0].families == "" and by[n + i][0].n_licences == 0 for i in range(len(plain)))
    assert sorted(r.families for r in by[900]) == ["", "Apache,MIT"] and by[None][0].families == "MIT"
    assert [(r.n_licences, r.families) for r in by[901]] == [(1, "MIT")] * 2
    assert all(0 <= r.score <= 1 for r in got)


def test_native_plan_and_empty(spark):
    df = spark.createDataFrame([], "doc_id long, text string")
    out = licenses.scan(df)
    assert out.count() == 0
    plan = out._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan


#: Wordings that no training notice has; the classifier and the templates must carry over to them.
UNSEEN = {
    "AGPL": ["This server is distributed under the terms of the GNU Affero General Public License v3.", "You may use this code under the AGPL, see COPYING."],
    "Apache": ["The code in this folder is made available under the Apache License 2.0, see LICENSE.", "Distributed under the terms of the Apache License, Version 2.0, a copy of which is included."],
    "BSD": ["This project is licensed under the BSD 3-Clause License - see the LICENSE file for details.", "/* Redistribution and use in source and binary forms,\n * with or without modification, are permitted\n * provided that these conditions hold: */"],
    "CC-BY": ["Text and figures are available under a Creative Commons Attribution 4.0 International License."],
    "CC-BY-NC": ["All photographs are shared under the Creative Commons Attribution-NonCommercial 4.0 International License."],
    "CC-BY-SA": ["Content on this site is available under the Creative Commons Attribution-ShareAlike 4.0 International License unless noted."],
    "CC0": ["The author waived all copyright and related or neighboring rights to this work to the extent possible under law."],
    "GPL": ["This plugin is distributed under the terms of the GNU General Public License, version 2.", "# you can redistribute it and/or modify it under the terms\n# of the GNU General Public License as published by\n# the Free Software Foundation; either version 2"],
    "ISC": ["Permission to use, copy, modify, and distribute this software\nfor any purpose with or without fee is hereby granted."],
    "LGPL": ["This module may be used under the GNU Lesser General Public License, version 2.1.", "// SPDX-License-Identifier: LGPL-2.1"],
    "MIT": ["This project is licensed under the MIT License - see the LICENSE.md file for details.", "// Permission is hereby granted, free of charge, to any person\n// obtaining a copy of this software and associated\n// documentation files, to deal in the Software"],
    "MPL": ["Subject to the terms of the Mozilla Public License, v. 2.0, you may share these files."],
    "Unlicense": ["Anyone is free to copy, modify, publish, use, compile, sell, or distribute this software for any purpose."],
}
CLEAN = [
    "The software company released its results under the terms that the court had set.", "The general public may use the hall free of charge.", "Permission to build was granted by the council without any conditions.",
    "You may obtain a copy of the map at the office; it is provided as is.", "This work is about the end of the war and its foundation myths.", "All rights to the land were sold, with or without the house.", "See the file for details of the project and the people in it.",
]


def test_held_out_wordings(spark):
    seen = {" ".join(licenses._plain(t)) for _, t in licenses.notices()}
    rows, want = [], []
    for f, texts in UNSEEN.items():
        for t in texts:
            assert " ".join(licenses._plain(t)) not in seen
            want.append(f)
            rows.append((len(rows), "It rained all day and the road was closed.\n\n" + t + "\n\nThe fair is in May."))
    rows += [(1000 + i, t) for i, t in enumerate(CLEAN)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    model = licenses.trained(spark.read.parquet("/root/testdata/sf0.01/documents.parquet"))
    got = {r.doc_id: r.families for r in licenses.scan(docs, model=model).collect()}
    right = sum(got[i] == f for i, f in enumerate(want))
    assert right >= 0.9 * len(want), [(f, got[i]) for i, f in enumerate(want) if got[i] != f]
    assert not any(got[1000 + i] for i in range(len(CLEAN)))
    # two licences on one line, and a text without line ends
    both = "Dual licensed under the MIT License or the Apache License, Version 2.0, at your option."
    long = "no line ends " * 300 + "Released under the MIT License. " + "more of it " * 300 + "Licensed under the Apache License, Version 2.0."
    two = {r.doc_id: r.families for r in licenses.scan(spark.createDataFrame([(1, both), (2, long)], "doc_id long, text string"), model=model).collect()}
    assert two == {1: "Apache,MIT", 2: "Apache,MIT"}


def test_scores_against_brute_force(spark):
    docs = spark.createDataFrame([(1, "a b\n\nLicensed under the MIT License, see the file.\n * " + "word " * 30 + "under the GNU General Public License as published\r\n\r\nx")], "doc_id long, text string")
    weights, families, biases, temperature = model = licenses.trained(docs)
    table = {r.gram: r.w for r in weights.collect()}
    tells = {r.gram for r in weights.where("tells").collect()}
    pairs = {}

    def key(a, b):
        if (a, b) not in pairs:
            pairs[a, b] = spark.range(1).selectExpr(f"xxhash64('{a}', '{b}') as h").first().h
        return pairs[a, b]

    want = {}
    for p, part in enumerate(re.split(r"\r?\n\s*\r?\n", docs.first().text)):
        w = licenses._plain(part)
        grams = [key(*g) for g in zip(w, w[1:])]
        for wide in licenses.WINDOWS:
            for lo in range(0, max(1, len(grams)), wide // 2):
                hits = {g for g in grams[lo : lo + wide - 1] if g in table}
                if len(hits) >= licenses.LEAST or hits & tells:
                    z = [(b + sum(table[g][k] for g in hits)) / temperature for k, b in enumerate(biases)]
                    e = [math.exp(v - max(z)) for v in z]
                    for f, x in zip(families, e):
                        if f != "unknown" and x / sum(e) >= licenses.CERTAIN:
                            want.setdefault((p, f), []).append(x / sum(e))
    got = {(r.paragraph, r.family): r for r in licenses.paragraphs(docs, model=model).collect()}
    assert got.keys() == want.keys() and {f for _, f in got} >= {"MIT", "GPL"}
    assert all(any(abs(r.score - s) < 1e-9 for s in want[k]) for k, r in got.items())


#: Everyday wordings, each not a notice of the operator's.
EVERYDAY = {
    "AGPL": ["Our server is AGPL-licensed.", "License: AGPL-3.0", "The back end is free software under the AGPLv3.", "Code: GNU AGPL v3 or later", "Use is governed by the Affero GPL, version 3.", "We ship this under AGPL 3.", "It is covered by the GNU Affero General Public Licence."],
    "Apache": ["Apache-2.0", "It is offered under Apache 2.", "This library is Apache 2.0 licensed.", "Licence: Apache-2.0", "All examples fall under the Apache Licence.", "Copyright the authors, ALv2 / Apache License v2.0", "Source code is Apache-licensed.", "available to all under the Apache Software License", "license = { text = \"Apache-2.0\" }"],
    "BSD": ["Our fork keeps the three-clause BSD licence.", "BSD-licensed", "It comes with a 2-clause BSD license.", "License: BSD", "Use it under BSD terms", "the new BSD license applies to all of it", "SPDX: BSD-3-Clause", "You can use it under the simplified BSD licence", "Provided under a BSD-style licence by its authors."],
    "CC-BY": ["Photos: CC BY 4.0", "Text is under CC BY.", "Slides (c) the speaker, CC-BY-4.0", "Except where noted, content is licensed under CC BY 3.0.", "figures under the Creative Commons Attribution licence", "License: CC-BY 4.0"],
    "CC-BY-NC": ["CC BY-NC", "Maps are CC BY-NC 4.0.", "shared under Creative Commons BY-NC", "Creative Commons Attribution-NonCommercial, no other use.", "License: CC-BY-NC-4.0", "The recordings are CC BY-NC licensed"],
    "CC-BY-SA": ["CC BY-SA", "Articles are CC BY-SA 3.0 like the encyclopedia.", "under a CC-BY-SA licence", "Creative Commons Attribution-ShareAlike 3.0 Unported", "Licence: CC BY-SA 4.0", "The wiki is CC-BY-SA"],
    "CC0": ["public domain (CC0)", "Data: CC0 1.0", "The data set is released under CC0.", "License: CC0", "We put it in the public domain (CC0).", "CC0-licensed icons", "dedicated by a CC0 waiver"],
    "GPL": ["free under GPLv3", "GPL v2 or later", "This module is GPL licensed.", "License: GPL-3.0", "It falls under the GNU GPL.", "GPLv2 only", "Same licence as the kernel: GPL 2", "Published under GPL, version 3", "the GPL licence covers the plugin", "licensed GPLv2+ like the rest"],
    "ISC": ["ISC licensed", "License: ISC", "made available under the ISC licence", "\"license\": \"ISC\"", "it has the ISC license of its parent", "under ISC, as upstream"],
    "LGPL": ["LGPLv3", "The library is LGPL licensed.", "License: LGPL-2.1", "may be linked under the LGPL", "GNU LGPL, version 2.1 or newer", "distributed under LGPL v3", "a copy of the GNU Library General Public Licence", "dual: Lesser GPL 3"],
    "MIT": ["subject to the MIT licence", "MIT-licensed; see LICENSE", "License: MIT", "\"license\": \"MIT\"", "Use it under MIT.", "It has an MIT license.", "offered under the MIT/X11 licence", "MIT License (c) the authors", "the MIT licence, in short: do what you like", "Licence - MIT"],
    "MPL": ["MPL2", "License: MPL-2.0", "Files are covered by the Mozilla Public License.", "under the MPL 2.0, file by file", "MPL-licensed", "available under the MPL", "MPL v2.0 applies"],
    "Unlicense": ["License: Unlicense", "released with the Unlicense", "under the Unlicense, so no rights are kept", "SPDX-License-Identifier: Unlicense", "Unlicense licensed", "It uses the Unlicense."],
}
MENTIONS = [
    "She studied at the MIT and then at the general hospital.", "Apache 2.4 and nginx were installed on the server.", "Please cc by mail to all of us.", "He lost his driving licence under the new rules.", "Version 2 of the plan was subject to the approval of the board.",
    "The Apache helicopter landed at 3.", "Das Buch kam mit der Post und mit einem Brief.", "The public domain of the crown is large.", "creative commons and village greens were closed", "Attribution of the painting is open.", "A licence for the pub was granted under the act.",
]


def test_everyday_wordings(spark):
    seen = {" ".join(licenses._plain(t)) for _, t in licenses.notices()}
    rows = [(f, t) for f, ts in EVERYDAY.items() for t in ts]
    new = [i for i, (_, t) in enumerate(rows) if " ".join(licenses._plain(t)) not in seen]
    docs = [(i, "It rained all day and the road was closed.\n\n" + t + "\n\nThe fair is in May.") for i, (_, t) in enumerate(rows)]
    docs += [(1000 + i, t) for i, t in enumerate(MENTIONS)]
    model = licenses.trained(spark.read.parquet("/root/testdata/sf0.01/documents.parquet"))
    got = {r.doc_id: r.families for r in licenses.scan(spark.createDataFrame(docs, "doc_id long, text string"), model=model).collect()}
    assert not {MENTIONS[i]: got[1000 + i] for i in range(len(MENTIONS)) if got[1000 + i]}
    for of in (range(len(rows)), new):
        wrong = [(*rows[i], got[i]) for i in of if got[i] != rows[i][0]]
        assert len(wrong) <= 0.1 * len(of), (len(wrong), len(of), wrong)
    two = spark.createDataFrame([(1, "Dual licensed under MIT or Apache-2.0.")], "doc_id long, text string")
    assert licenses.scan(two, model=model).first().families == "Apache,MIT"
