"""Notices that the given tables do not hold, and tables of any size."""

import inspect

import pytest

from clickflow.llm import licenses


def found(text):
    return licenses.Matcher().scan(text)[0]


@pytest.mark.parametrize("text, name", [
    ("Copyright 2024 Acme. Released under the MIT License.", "MIT"),
    ("This file is released under the MIT License", "MIT"),
    ("Licensed under the Apache License, Version 2.0, by Acme", "Apache-2.0"),
    ("# Permission is hereby granted, free\n# of charge, to any person obtaining a copy\n# of this software", "MIT")])
def test_words_around_a_notice_do_not_count(text, name):
    assert found(text) == name
    assert found("Some words of prose come first. " * 50 + text + " And others follow." * 50) == name


def test_no_weight_depends_on_the_table():
    assert list(inspect.signature(licenses.Matcher).parameters) == ["templates"]


def test_size_of_the_table(spark):
    text = "This file is released under the MIT License"
    for n in (1, 3000):
        files = spark.range(n).selectExpr("id AS key", "concat('d', id, '/f') AS path", f"if(id = 0, '{text}', 'file not here') AS text")
        got = {tuple(r) for r in licenses.own_licences(files).where("key = 0").select("licence", "cosine").collect()}
        assert got == {("MIT", 1.0)}


@pytest.mark.parametrize("text, name", [
    ("Licensed under the MIT License", "MIT"), ("MIT License", "MIT"), ("Distributed under the MIT License.", "MIT"),
    ("SPDX-License-Identifier: MIT", "MIT"), ("SPDX-License-Identifier: GPL-2.0-only", "GPL-2.0"), ("Licensed under the GPLv3", "GPL-3.0"),
    ("it under the terms of the GNU General Public License as published by", "GPL-1.0-or-later"),
    ("# it under the terms of the GNU General Public License as published by\n# the Free Software Foundation; either version 2 of the License, or", "GPL-2.0"),
    ("under the terms of the GNU Lesser General Public\nLicense as published by the Free Software Foundation; either\nversion 2.1 of the License", "LGPL-2.1"),
    ("The ASF licenses this file to You under the Apache License, Version 2.0", "Apache-2.0"),
    ("Licensed under the GNU General Public License, version 2", "GPL-2.0"), ("Licensed under the GNU Affero General Public License, version 3", "AGPL-3.0"),
    ("Licensed under CC BY-SA 4.0", "CC-BY-SA-4.0"), ("Licensed under CC BY-NC-ND 4.0.", "CC-BY-NC-ND-4.0"), ("Licensed under CC BY 3.0", "CC-BY-3.0"),
    ("This work is licensed under the Creative Commons Attribution-ShareAlike 4.0 International License", "CC-BY-SA-4.0"),
    ("This work is licensed under the Creative Commons Attribution-NoDerivs 3.0 Unported License", "CC-BY-ND-3.0"),
    ("Redistribution and use in source and binary forms, with or without\nmodification, are permitted", "BSD-2-Clause"),
    ("BSD 2-Clause License", "BSD-2-Clause"), ("Mozilla Public License Version 2.0", "MPL-2.0"),
    ("A permission slip is needed for a driving license.", None), ("It is unlike the MIT License in most respects.", None)])
def test_ordinary_notices(text, name):
    assert found(text) == name


def test_every_template_is_found_under_its_own_name():
    for name, texts in licenses.TEMPLATES.items():
        for text in texts:
            assert any(m in text.lower() for m in licenses.MARKS), text
            if text in licenses._EITHER:      # stands under both names
                assert name in licenses.Matcher().scan(text)[3], text
            elif text not in licenses.TEMPLATES.get("BSD-3-Clause", ()):
                assert found(text.removeprefix("= ")) == name, text


def test_full_licence_texts_declare_their_directory(spark):
    bodies = {f.stem: f.read_text("utf-8") for f in licenses.TEXTS.glob("*.txt")}
    m = licenses.Matcher()
    for name, body in bodies.items():
        got = m.scan(f"Copyright (c) 2024 Acme Corporation and others. All rights reserved.\n\n{body}")
        assert got[0] == name and got[2] >= licenses.WHOLE, (name, got)
    code = "def spread(values):\n    return max(values) - min(values)\n" * 200
    assert m.scan(bodies["MIT"] + code)[0] == "MIT" and m.scan(bodies["MIT"] + code)[2] < licenses.MOSTLY
    files = [(1, "a/1.txt", bodies["BSD-2-Clause"]), (2, "a/b/2.txt", "no notice"), (3, "c/3.txt", bodies["MIT"] + code), (4, "c/4.txt", "no notice")]
    got = {r.key: r for r in licenses.licences(spark.createDataFrame(files, "key long, path string, text string")).collect()}
    assert {k: (r.licence, r.origin) for k, r in got.items()} == {
        1: ("BSD-2-Clause", "own"), 2: ("BSD-2-Clause", "inherited"), 3: ("MIT", "own"), 4: (None, "none")}


BODIES = {f.stem: f.read_text("utf-8") for f in licenses.TEXTS.glob("*.txt")}


def test_the_body_names_the_file_not_a_notice_in_it():
    m = licenses.Matcher()
    assert m.scan("Parts were released under the MIT License before 2010.\n" + BODIES["GPL-3.0"])[0] == "GPL-3.0"
    nameless = BODIES["MPL-2.0"].replace("Mozilla", "").replace("MPL", "")
    assert m.scan(nameless)[0] == "MPL-2.0"
    assert m.scan("Parts were released under the MIT License before 2010.")[0] == "MIT"


@pytest.mark.parametrize("text", ["This code is not under the MIT License", "It was never released under the MIT License.", "everything except what is under the GPL version 3"])
def test_denied_notices_do_not_count(text):
    assert found(text) is None


@pytest.mark.parametrize("text, names", [
    ("License: MIT", ["MIT"]), ("some code\nLicense: Apache-2.0\nmore", ["Apache-2.0"]), ("This project uses the MIT license", ["MIT"]), ("Apache-2.0", ["Apache-2.0"]),
    ("GPL-3.0", ["GPL-3.0"]), ("BSD-3-Clause", ["BSD-3-Clause"]), ("SPDX-License-Identifier: MIT OR Apache-2.0", ["MIT", "Apache-2.0"]),
    ("// SPDX-License-Identifier: (GPL-2.0-only OR BSD-3-Clause)", ["GPL-2.0", "BSD-3-Clause"]),
    ("Licensed under either of Apache License, Version 2.0 or MIT license at your option", ["Apache-2.0", "MIT"]),
    ("either of Apache License, Version 2.0 or MIT", ["Apache-2.0", "MIT"]),
    ("Released under the MIT License.\n" + "code and more code\n" * 30 + "Vendored parts: licensed under the Apache License, Version 2.0", ["MIT", "Apache-2.0"])])
def test_short_and_several_declarations(text, names):
    got = licenses.Matcher().scan(text)
    assert sorted(got[3]) == sorted(names) and got[0] in names


def test_missing_and_repeated_files(spark):
    files = [(1, "a/1.txt", "Released under the MIT License"), (1, "a/1.txt", "Released under the MIT License"), (2, None, "Released under the MIT License"), (3, None, None),
             (4, "a/4.txt", ""), (5, "a/5.txt", "word " * 200_000 + "\nReleased under the MIT License"), (None, "a/b/c.txt", "x")]
    df = spark.createDataFrame(files, "key long, path string, text string")
    got = licenses.licences(df).collect()
    assert len(got) == 7
    by = {(r.key, r.path): r for r in got}
    assert by[(1, "a/1.txt")].licences == ["MIT"] and by[(2, None)].origin == "own" and by[(3, None)].origin == "none" and by[(5, "a/5.txt")].licence == "MIT"
    assert by[(4, "a/4.txt")].licence == "MIT" and by[(4, "a/4.txt")].origin == "inherited" and by[(None, "a/b/c.txt")].licences == ["MIT"]
    assert licenses.licences(df.limit(0)).count() == 0
