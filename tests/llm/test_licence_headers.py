"""Licences from the text of their headers as authors paste it."""

import duckdb
import pytest

from tests.llm.helpers import documents
from tillroll.llm.licences import licence_scan
from tillroll.llm.oracle import ORACLE

MPL = (
    "This Source Code Form is subject to the terms of the Mozilla Public\nLicense, v. 2.0. If a copy of the MPL"
    " was not distributed with this\nfile, You can obtain one at https://mozilla.org/MPL/2.0/."
)
LINE = "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."
GPL = """This program is free software: you can redistribute it and/or modify
it under the terms of the GNU General Public License as published by
the Free Software Foundation, either version {} of the License, or
(at your option) any later version.
"""
APACHE = """Licensed under the Apache License, Version 2.0 (the "License");
you may not use this file except in compliance with the License.
You may obtain a copy of the License at

    http://www.apache.org/licenses/LICENSE-2.0

Unless required by applicable law or agreed to in writing, software
distributed under the License is distributed on an "AS IS" BASIS,
WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied.
See the License for the specific language governing permissions and
limitations under the License.
"""
MIT = """Permission is hereby granted, free of charge, to any person obtaining a copy
of this software and associated documentation files (the "Software"), to deal
in the Software without restriction, including without limitation the rights
to use, copy, modify, merge, publish, distribute, sublicense, and/or sell
copies of the Software, and to permit persons to whom the Software is
furnished to do so, subject to the following conditions:

The above copyright notice and this permission notice shall be included in all
copies or substantial portions of the Software.
"""
BSD = """Redistribution and use in source and binary forms, with or without
modification, are permitted provided that the following conditions are met:

1. Redistributions of source code must retain the above copyright notice, this
   list of conditions and the following disclaimer.

2. Redistributions in binary form must reproduce the above copyright notice,
   this list of conditions and the following disclaimer in the documentation
   and/or other materials provided with the distribution.
"""
ENDORSE = """
3. Neither the name of the copyright holder nor the names of its
   contributors may be used to endorse or promote products derived from
   this software without specific prior written permission.
"""
ISC = """Permission to use, copy, modify, and/or distribute this software for any
purpose with or without fee is hereby granted, provided that the above
copyright notice and this permission notice appear in all copies.
"""
GNU = """{0} is free software{1} you can redistribute it and/or
modify it under the terms of the GNU {2} General Public License as published
by the Free Software Foundation{3} either version {4} of the License, or (at
your option) any later version.

{0} is distributed in the hope that it will be useful,
but WITHOUT ANY WARRANTY; without even the implied warranty of
MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE.  See the GNU {2}
General Public License for more details.

You should have received a copy of the GNU {2} General Public License
along with this thing.
"""
LGPL = GNU.format("This library", ";", "Lesser", ";", "2.1")
AGPL = GNU.format("Foo", ":", "Affero", ",", "3")
CC0 = "To the extent possible under law, Some One has waived all copyright and related or neighboring rights to This."
CASES = [
    (APACHE, "Apache-2.0", 5, 0),
    (MIT, "MIT", 2, 0),
    (BSD, "BSD-2-Clause", 3, 0),
    (BSD + ENDORSE, "BSD-3-Clause", 4, 0),
    (MPL, "MPL-2.0", 1, 0),
    ("/* " + MPL.replace("\n", "\n * ") + " */", "MPL-2.0", 1, 0),
    (MPL.replace("v. 2.0", "v.\n2.0"), "MPL-2.0", 1, 0),
    (f"Copyright 2020 Someone\n{LINE}", "MPL-2.0", 1, 0),
    (f"{LINE}\n\nReleased under the MIT License.", "MIT,MPL-2.0", 2, 0),
    # Another version is no MPL-2.0; what was known before stays known.
    (MPL.replace("v. 2.0", "v. 1.1"), "", 1, 1),
    ("See v. 2 notes. Licensed under CC BY 4.0.", "CC-BY-4.0", 1, 0),
    ("Released under the MIT License.", "MIT", 1, 0),
    ("Licensed under the Apache License, Version 2.0.", "Apache-2.0", 1, 0),
    ("Licensed under CC BY-NC 4.0.", "CC-BY-NC-4.0", 1, 0),
    ("Licensed under CC BY-SA 4.0.", "CC-BY-SA-4.0", 1, 0),
    ("This work is licensed under the GNU General Public License, version 3.", "GPL-3.0-only", 1, 0),
    # However lines break, and whatever stands before.
    ("Copyright 2020 X\n" + MIT, "MIT", 2, 0),
    ("/*\n * " + MIT.replace("\n", "\n * ") + "/", "MIT", 2, 0),
    ("".join(f"-- {line}\n" for line in MIT.split("\n")), "MIT", 2, 0),
    ("".join(f"# {line}\n" for line in (BSD + ENDORSE).split("\n")), "BSD-3-Clause", 4, 0),
    (" ".join(APACHE.split()), "Apache-2.0", 5, 0),
    ("Released under the MIT licence.", "MIT", 1, 0),
    ("This library is licensed under the MIT license, see LICENSE.", "MIT", 1, 0),
    (ISC, "ISC", 1, 0),
    (LGPL, "LGPL-2.1-or-later", 4, 0),
    (AGPL, "AGPL-3.0-or-later", 4, 0),
    ("// SPDX-License-Identifier: BSD-3-Clause\nint x;", "BSD-3-Clause", 1, 0),
    ("# SPDX-License-Identifier: GPL-2.0-only", "GPL-2.0-only", 1, 0),
    ("This is free and unencumbered software released into the public domain.", "Unlicense", 1, 0),
    (CC0, "CC0-1.0", 2, 0),
    ("This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.", "CC-BY-SA-4.0", 1, 0),
    # Words that only look like it, and a sentence cut short.
    ("A licence to print money. Unlicensed under the MIT licenses.", "", 0, 0),
    ("Released under the MIT", "", 0, 0),
]


def test_headers(spark):
    rows = licence_scan(documents(spark, [(i, c[0]) for i, c in enumerate(CASES)])).orderBy("doc_id").collect()
    assert [tuple(r)[1:] for r in rows] == [c[1:] for c in CASES]


def test_headers_in_sql(spark):
    db = duckdb.connect()
    db.execute("CREATE TABLE documents (doc_id BIGINT, text VARCHAR)")
    odd = ["licence " + "a." * 20_000, "licence " + "- .+ " * 9_000 + MIT, "license\u0130\u212a " + MIT, None, ""]
    texts = [c[0] for c in CASES] + odd
    db.executemany("INSERT INTO documents VALUES (?, ?)", list(enumerate(texts)))
    answer = db.execute(f"SELECT * FROM ({ORACLE['op3_licences']}) ORDER BY doc_id").fetchall()
    rows = licence_scan(documents(spark, list(enumerate(texts)))).orderBy("doc_id").collect()
    assert answer == [tuple(r) for r in rows]


@pytest.mark.parametrize("version", [2, 3])
def test_gpl_or_later(spark, version):
    colon = GPL.format(version)
    texts = [colon, colon.replace("software:", "software;")]
    rows = licence_scan(documents(spark, list(enumerate(texts)))).collect()
    assert [r["licences"] for r in rows] == [f"GPL-{version}.0-or-later"] * 2
