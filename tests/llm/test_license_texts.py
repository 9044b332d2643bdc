"""Whole licence texts, short licences and notices in their usual places; odd rows."""

from __future__ import annotations

import pathlib

import pytest

from layerlake.llm import licenses

TEXTS = pathlib.Path("/usr/share/common-licenses")
WANT = {
    "Apache-2.0": "Apache-2.0", "Artistic": "Artistic-1.0-Perl", "BSD": "BSD-3-Clause", "CC0-1.0": "CC0-1.0", "GFDL-1.2": "GFDL-1.2", "GFDL-1.3": "GFDL-1.3",
    "GPL-1": "GPL-1.0", "GPL-2": "GPL-2.0", "GPL-3": "GPL-3.0", "LGPL-2": "LGPL-2.0", "LGPL-2.1": "LGPL-2.1", "LGPL-3": "LGPL-3.0", "MPL-1.1": "MPL-1.1",
    "MPL-2.0": "MPL-2.0",
}
BSD_2 = """Copyright (c) 2020, Somebody
All rights reserved.

Redistribution and use in source and binary forms, with or without
modification, are permitted provided that the following conditions are met:

1. Redistributions of source code must retain the above copyright notice, this
   list of conditions and the following disclaimer.

2. Redistributions in binary form must reproduce the above copyright notice,
   this list of conditions and the following disclaimer in the documentation
   and/or other materials provided with the distribution.

THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS"
AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE
IMPLIED WARRANTIES OF MERCHANTABILITY ARE DISCLAIMED.
"""
HEADER = """#!/usr/bin/env python
# Copyright (C) 2019 Somebody
#
# This program is free software; you can redistribute it and/or modify
# it under the terms of the GNU General Public License as published by
# the Free Software Foundation; either version {} of the License, or
# (at your option) any later version.

import os
"""


def licenses_of(spark, rows):
    df = spark.createDataFrame(rows, "file_id long, path string, text string, license string, key string")
    return {(r.file_id, r.path): (r.license, r.via) for r in licenses.scanned(df).collect()}


@pytest.mark.skipif(not TEXTS.is_dir(), reason="no licence texts here")
def test_whole_texts(spark):
    names = [n for n in WANT if (TEXTS / n).is_file()]
    rows = [(i, f"{n}/COPYING", (TEXTS / n).read_text(encoding="utf-8", errors="replace"), "x", "y") for i, n in enumerate(names)]
    rows += [(100 + i, f"{n}/src/a/b.c", "int main;", "x", "y") for i, n in enumerate(names)]
    got = licenses_of(spark, rows)
    assert {p.split("/")[0]: l for (i, p), (l, _) in got.items() if i < 100} == {n: WANT[n] for n in names}
    assert {p.split("/")[0]: (l, v) for (i, p), (l, v) in got.items() if i >= 100} == {n: (WANT[n], "inherited") for n in names}


def test_short_licences_and_headers(spark):
    mit = "The MIT License\n\nCopyright (c) 2001\n\n" + licenses._MIT + '\n\nTHE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND'
    rows = [
        (1, "a/LICENSE", BSD_2, "", ""), (2, "b/LICENSE", BSD_2.replace("distribution.\n", "distribution.\n\n3. Neither the name of the holder nor the names of its\n   contributors may be used\n", 1), "", ""),
        (3, "c/LICENSE.md", mit, "", ""), (4, "d/x.py", HEADER.format(2), "", ""), (5, "d/y.py", HEADER.format(3), "", ""),
        (6, "d/z.py", "code\n" * 500 + "# Licensed under the Apache License, Version 2.0 (the \"License\");\n# you may not use this file except in compliance\n", "", ""),
        (7, "d/w.py", HEADER.format(2).replace("GNU General", "GNU Lesser General").replace("version 2", "version 2.1"), "", ""),
        (8, "e/w.py", "the permission of the author was not needed for a copyright of words", "", ""), (9, None, mit, "", ""), (9, None, mit, "", ""),
        (10, "c/LICENSE.md", None, "", ""), (11, "c/deep/er/file", "", "", ""),
    ]
    got = {i: l for (i, _), l in licenses_of(spark, rows).items()}
    assert got == {
        1: ("BSD-2-Clause", "own"), 2: ("BSD-3-Clause", "own"), 3: ("MIT", "own"), 4: ("GPL-2.0", "own"), 5: ("GPL-3.0", "own"), 6: ("Apache-2.0", "own"),
        7: ("LGPL-2.1", "own"), 8: (None, "none"), 9: ("MIT", "own"), 10: ("MIT", "inherited"), 11: ("MIT", "inherited"),
    }


def test_repeated_rows_and_nothing(spark):
    rows = [(1, "a/LICENSE", "Released under the MIT License.", "", "")] * 3 + [(2, "a/b", "x", "", "")] * 2
    df = spark.createDataFrame(rows, "file_id long, path string, text string, own_license string, folder string")
    got = sorted((r.file_id, r.license, r.via) for r in licenses.scanned(df).collect())
    assert got == [(1, "MIT", "own")] * 3 + [(2, "MIT", "inherited")] * 2
    assert licenses.scanned(df.limit(0)).count() == 0
    plan = licenses.scanned(df)._jdf.queryExecution().executedPlan().toString()
    assert "MapIn" not in plan and "ArrowEval" not in plan and "BatchEvalPython" not in plan
