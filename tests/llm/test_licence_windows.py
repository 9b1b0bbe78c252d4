"""Full licence texts, wrapped headers, tags and notices inside longer lines."""

import textwrap

from opinionlens.llm.licences import HEADERS, full_texts, scan_licences

MIXED = "The harbour was quiet that morning and nobody spoke of boats or weather. "


def comment(text):
    return "".join(f" * {line}\n" for line in textwrap.wrap(text, 50))


def test_texts_headers_and_notices(spark):
    files = [(f"t{i}/LICENSE", "Copyright (c) 2020 Foo Bar\n\n" + text, name) for i, (name, text) in enumerate(full_texts())]
    files += [(f"w{i}/LICENSE", " ".join(text.split()), name) for i, (name, text) in enumerate(full_texts())]
    files += [(f"h{i}/a.c", "/*\n" + comment(MIXED + text + " " + MIXED) + " */\n" + "int x;\n" * 20, name) for i, (name, text) in enumerate(HEADERS)]
    files += [
        ("s/a.py", "# SPDX-License-Identifier: Apache-2.0\nimport os\n", "Apache-2.0"),
        ("s/b.py", "# SPDX-License-Identifier: GPL-3.0-or-later\nimport os\n", "GPL-3.0"),
        ("n/a.txt", "Copyright 2020 Foo Bar. Licensed under the MIT License. " + MIXED * 3, "MIT"),
        ("n/b.txt", MIXED * 3 + "All of it is licensed under CC BY-SA 4.0, as said above. " + MIXED, "CC-BY-SA-4.0"),
        ("n/c.txt", MIXED * 3 + "A driving license was released under the bridge with permission. ", None),
    ]
    files += [(f"p/{i}.txt", MIXED * 3 + f"The plan of the day {i} is free to all, under the sun.", None) for i in range(300)]
    rows = [(p, t) for p, t, _ in files]
    got = {r.path: r.own_licence for r in scan_licences(spark.createDataFrame(rows, "path string, text string").repartition(4)).collect()}
    wrong = {p: (got[p], name) for p, _, name in files if got[p] != name}
    assert not wrong, wrong
