"""Licence scans on worked-out files."""

from pyspark.sql import functions as F

from corpusflow.llm import license

APACHE = "Licensed under the Apache License, Version 2.0."
GPL = "This work is licensed under the GNU General Public License, version 3."


def scan(spark, rows):
    files = spark.createDataFrame(rows, "file long, path string, text string")
    return {r.file: (r.license, r.origin, r.licence_dir) for r in license.scan(files).collect()}


def test_headers_and_nearest_directory(spark):
    got = scan(spark, [
        (1, "a/LICENSE", "MIT License\n\nCopyright (c) someone\nReleased under the MIT License.\nmany words of conditions follow here"),
        (2, "a/b/x.py", "no statement at all"),
        (3, "a/b/LICENSE.txt", GPL),
        (4, "a/b/c/y.py", "some code of its own\n" + APACHE + "\nand more of it"),
        (5, "a/b/c/z.py", None),
        (6, "q/w.py", ""),
        (7, None, "text"),
        (8, "top.py", "a license is mentioned in passing by these words here"),
        (9, "a/z.py", "x"),
        (10, "ab/z.py", "x"),
    ])
    assert got[1] == ("MIT", "header", None)
    assert got[2] == ("GPL-3.0-only", "inherited", "a/b")
    assert got[3] == ("GPL-3.0-only", "header", None)
    assert got[4] == ("Apache-2.0", "header", None)
    assert got[5] == ("GPL-3.0-only", "inherited", "a/b")
    assert got[6] == got[7] == got[8] == got[10] == (None, "none", None)
    assert got[9] == ("MIT", "inherited", "a")


def test_every_template_is_nearest_to_itself(spark):
    rows = [(i, f"d{i}/f", text + ".") for i, (_, text) in enumerate(license.TEMPLATES)]
    got = scan(spark, rows)
    for i, (name, text) in enumerate(license.TEMPLATES):
        assert got[i][0] in (name, None) and (got[i][0] == name or "licen" not in text.lower())


def test_ties_repeats_and_empty(spark):
    assert scan(spark, []) == {}
    files = spark.createDataFrame([(1, "d/a", APACHE)] * 3 + [(None, "d/b", APACHE)], "file long, path string, text string")
    rows = license.scan(files).collect()
    assert [r.license for r in rows if r.file == 1] == ["Apache-2.0"] * 3
    assert [(r.license, r.origin) for r in rows if r.file is None] == [("Apache-2.0", "inherited")]


MPL = """ * This Source Code Form is subject to the terms of the Mozilla Public
 * License, v. 2.0. If a copy of the MPL was not distributed with this
 * file, You can obtain one at http://mozilla.org/MPL/2.0/."""
GPL3 = """    This program is free software: you can redistribute it and/or modify
    it under the terms of the GNU General Public License as published by
    the Free Software Foundation, either version 3 of the License, or
    (at your option) any later version."""
BSD = """Copyright (c) 2001, Someone
All rights reserved.

Redistribution and use in source and binary forms, with or without
modification, are permitted provided that the following conditions are met:"""
MIT = """MIT License

Copyright (c) 2020 Someone

Permission is hereby granted, free of charge, to any person obtaining a copy
of this software and associated documentation files"""
APACHE_HEADER = """# Licensed under the Apache License, Version 2.0 (the "License");
# you may not use this file except in compliance with the License."""
COPYING = """                    GNU GENERAL PUBLIC LICENSE
                       Version 3, 29 June 2007

 Copyright (C) 2007 Free Software Foundation, Inc.
 Everyone is permitted to copy and distribute verbatim copies"""


def test_usual_headers_and_files(spark):
    code = "\nint main() { return 0; } // some code of its own, many more words than a header has " * 40
    filler = "word " * 20
    got = scan(spark, [
        (1, "m/a.c", MPL + code), (2, "g/a.c", GPL3 + code), (3, "b/LICENSE", BSD), (4, "i/LICENSE.txt", MIT), (5, "p/a.py", APACHE_HEADER + code),
        (6, "g/COPYING", COPYING), (7, "g/sub/plain.c", code), (8, "x/long.txt", filler + "Licensed under the MIT License " + filler),
        (9, "y/r.txt", code + "\nAll rights reserved.\n"), (10, "b/deep/er/plain.c", code), (11, "z/gone.c", "Licensed under the terms of the agreement between the parties" + code),
        (12, "z/o.c", "all of these are reserved for the public domain of granted wishes"),
    ])
    assert [got[i][:2] for i in range(1, 7)] == [
        ("MPL-2.0", "header"), ("GPL-3.0-or-later", "header"), ("BSD-3-Clause", "header"), ("MIT", "header"), ("Apache-2.0", "header"), ("GPL-3.0-only", "header")]
    assert got[7] == ("GPL-3.0-only", "inherited", "g") and got[10] == ("BSD-3-Clause", "inherited", "b")
    assert got[8][0] == "MIT" and got[9] == ("Proprietary", "header", None)
    assert got[11][1] == got[12][1] == "none"


def test_own_templates_with_apostrophes(spark):
    files = spark.createDataFrame([(1, "a/b", "shared under\nBob's own friendly charter of 1999, as it is"), (2, "q/c", APACHE)], "file long, path string, text string")
    got = {r.file: r.license for r in license.scan(files, templates=[("Bob", "under Bob's own friendly charter")]).collect()}
    assert got == {1: "Bob", 2: None}


def test_windows_by_hand(spark):
    words = "a b license c d e license".split()
    row = spark.range(1).select(license.windows(F.array(*map(F.lit, words)), [("x", "one two three license four")]).alias("w")).first()
    assert row.w == ["a b license c", "c d e license"]


def test_clashing_columns_and_a_very_long_text(spark):
    long = "plain words of no licence at all " * 30000 + APACHE
    files = spark.createDataFrame([(1, "a/b", long, "x", 1, 2), (2, "a/c", None, "y", 3, 4)], "file long, path string, text string, license string, n int, key int")
    assert {r.file: (r.license, r.origin) for r in license.scan(files).collect()} == {1: ("Apache-2.0", "header"), 2: (None, "none")}
