"""Licence scans.

Windows of words are compared with licence templates by TF-IDF cosine. The weights are
those of the terms among the templates and one fixed weight for all other words, so a text
has the same licence in a table of any size. Words before and after a notice do not count:
around each word that tells a template, the best window of about its length is taken,
across line breaks and comment signs. A window holds the template's licence names and
version numbers and no others, so siblings (CC BY-ND, GPL 2) are not taken for each other, and
no word that denies it stands in or shortly before it. SPDX expressions are read name by name.

A whole text with a cosine of at least ``WHOLE`` to a full licence text is that licence,
whatever notices stand in or around it. Else a file's own licence is its best window with a cosine
of at least ``LEAST``; ``licences`` lists all that it declares, in order of place.

A file that is a licence file (by name, because most of its words stand in licence lines, or
because the whole text has a cosine of at least ``WHOLE`` to a full licence text)
declares the licence of its directory. Files without a licence of their own inherit from
the nearest ancestor directory that declares one: directories are expanded to their
ancestors (bounded by path depth), joined with the declaring ones, and the deepest wins.

One scan streams through Arrow batches; one row per directory is joined, and files meet their directory's licence by a measured
broadcast or a shuffled join whose hot directories adaptive execution splits.

Defined results: a null or empty text has no licence of its own; equal cosines go to the
earlier place, there to the longer template, then the first name; of a directory's declarations a named
licence file counts before others, then the higher cosine, then the later name;
a null path has no directory and inherits nothing; repeated rows get equal results; an
empty table gives an empty result.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from pathlib import Path

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clickflow.llm.common import join_measured, saved

#: Notices and licence texts by SPDX name. "= " marks a heading, which fills its lines; the
#: others are found anywhere. Each also has its SPDX tag.
TEMPLATES = {
    "AGPL-3.0": ["GNU Affero General Public License version 3", "GNU Affero General Public License as published by the Free "
                 "Software Foundation, either version 3 of the License", "under the AGPL version 3"],
    "Apache-2.0": ["Licensed under the Apache License, Version 2.0", "under the Apache License, Version 2.0", "under the Apache 2.0 license",
                   "under Apache 2.0", "= Apache License Version 2.0, January 2004", "= Apache License 2.0", "= Apache License, Version 2.0"],
    "BSD-2-Clause": ["Redistribution and use in source and binary forms, with or without modification, are permitted",
                     "under the BSD 2-Clause License", "under the Simplified BSD License", "= BSD 2-Clause License",
                     "= BSD 2-Clause Simplified License"],
    "BSD-3-Clause": ["Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote "
                     "products derived from this software", "Licensed under the BSD 3-Clause License", "under the BSD 3-Clause License",
                     "under the New BSD License", "= BSD 3-Clause License", "= New BSD License"],
    "BSD-4-Clause": ["under the BSD 4-Clause License", "= BSD 4-Clause License"],
    "BSL-1.0": ["Distributed under the Boost Software License, Version 1.0", "under the Boost Software License, Version 1.0",
                "= Boost Software License Version 1.0 August 17th 2003"],
    "CC0-1.0": ["Creative Commons CC0 1.0 Universal license", "under CC0 1.0", "= Creative Commons Legal Code CC0 1.0 Universal"],
    "EPL-2.0": ["under the terms of the Eclipse Public License 2.0", "= Eclipse Public License v 2.0"],
    "GPL-1.0": ["GNU General Public License version 1"],
    "GPL-1.0-or-later": ["under the terms of the GNU General Public License as published by"],
    "GPL-2.0": ["GNU General Public License version 2", "GNU General Public License as published by the Free Software Foundation; "
                "either version 2 of the License", "under the GPL version 2", "under the GPL 2"],
    "GPL-3.0": ["This work is licensed under the GNU General Public License, version 3", "GNU General Public License version 3",
                "GNU General Public License as published by the Free Software Foundation, either version 3 of the License",
                "under the GPL version 3", "under the GPL 3"],
    "ISC": ["Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted",
            "under the ISC License", "= ISC License", "= The ISC License"],
    "LGPL-2.0": ["GNU Library General Public License version 2", "GNU Library General Public License as published by the Free Software "
                 "Foundation; either version 2 of the License"],
    "LGPL-2.1": ["GNU Lesser General Public License version 2.1", "GNU Lesser General Public License as published by the Free Software "
                 "Foundation; either version 2.1 of the License", "under the LGPL version 2.1"],
    "LGPL-3.0": ["GNU Lesser General Public License version 3", "GNU Lesser General Public License as published by the Free Software "
                 "Foundation, either version 3 of the License", "under the LGPL version 3"],
    "MIT": ["Released under the MIT License", "under the MIT License", "Permission is hereby granted, free of charge, to any person "
            "obtaining a copy of this software", "= MIT License", "= The MIT License", "= The MIT License (MIT)"],
    "MIT-0": ["= MIT No Attribution"],
    "MPL-1.1": ["subject to the Mozilla Public License Version 1.1", "= Mozilla Public License Version 1.1"],
    "MPL-2.0": ["This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0",
                "under the Mozilla Public License, Version 2.0", "= Mozilla Public License Version 2.0"],
    "Unlicense": ["This is free and unencumbered software released into the public domain, see unlicense", "= The Unlicense"],
    "Zlib": ["Permission is granted to anyone to use this software for any purpose, including commercial applications",
             "under the zlib License", "= zlib License"],
}
#: The Creative Commons licences differ by their conditions and versions only.
_CONDITIONS = {"BY": "Attribution", "BY-SA": "Attribution-ShareAlike", "BY-NC": "Attribution-NonCommercial", "BY-ND": "Attribution-NoDerivatives",
               "BY-NC-SA": "Attribution-NonCommercial-ShareAlike", "BY-NC-ND": "Attribution-NonCommercial-NoDerivatives"}
TEMPLATES |= {f"CC-{k}-{v}": [f"Licensed under CC {k} {v}", f"under CC {k} {v}", f"under the Creative Commons {name} {v} International License",
                              f"under a Creative Commons {name} {v} License"]
              for k, name in _CONDITIONS.items() for v in ("2.0", "2.5", "3.0", "4.0")}
#: Either of two, as many projects offer.
_EITHER = ["either of Apache License, Version 2.0 or MIT license", "under the MIT license or Apache License, Version 2.0"]
TEMPLATES = {k: [*texts, *(_EITHER if k in ("Apache-2.0", "MIT") else []), f"SPDX-License-Identifier: {k}", f"= License: {k}",
                 f"This project uses the {k} license", *([f"= {k}"] if "-" in k else [])] for k, texts in TEMPLATES.items()}
#: Licences whose notices hold those of a more general one, which then does not count.
WITHIN = {"BSD-3-Clause": ["BSD-2-Clause"], "BSD-4-Clause": ["BSD-2-Clause", "BSD-3-Clause"],
          "GPL-2.0": ["GPL-1.0-or-later"], "GPL-3.0": ["GPL-1.0-or-later"]}
LEAST = 0.75
#: Share of a file's words in licence lines from which it is a licence file.
MOSTLY = 0.5
#: Full licence texts, <SPDX name>.txt (read by the driver), and the least cosine of a whole
#: text to one of them from which it is a licence file.
TEXTS = Path(__file__).parent / "licence_texts"
WHOLE = 0.8
NAMES = r"(?i)(^|/)(licen[cs]e|copying|notice|unlicense)([.\-][^/]*)?$"
TERM = re.compile(r"[a-z0-9]+(?:\.[0-9]+)*")
#: Weight of a word outside the templates, as that of a term in a seventh of the licences.
OTHER = 3.0
#: Words that name a licence: a window holds those of its template and no others.
NAMING = set("mit apache bsd isc gnu gpl lgpl agpl affero lesser library mozilla mpl cc creative commons nc sa nd "
             "noncommercial sharealike noderivatives cc0 zero boost bsl unlicense zlib eclipse epl simplified".split())
#: Words that a window must hold if its template does.
TELLING = NAMING | set("under by attribution spdx permission granted redistribution neither endorse".split())
NUMBER = re.compile(r"[0-9](?:\.[0-9])?")
#: Words that deny a notice, in it or up to so many words before it.
DENYING, BEFORE = frozenset("not never unlike without nor except".split()), 3
#: A tag with names joined by AND, OR, WITH.
SPDX = re.compile(r"spdx-license-identifier:[ \t]*([^\n]*)", re.I)
#: One of these stands in every template.
MARKS = ("licens", "licenc", "permission", "redistribution", "neither", "gnu", "gpl", "apache", "creative", "cc0", "cc by", "cc-by", "no attribution",
         "bsd-", "bsl-", "epl-", "mpl-", "mit-0")
#: Spellings brought to one form.
FORMS = [(re.compile(a), b) for a, b in (
    (r"licenc", "licens"), (r"non[- ]commercial", "noncommercial"), (r"share[- ]alike", "sharealike"),
    (r"no[- ]?deriv(ative)?s\b", "noderivatives"), (r"\b([al]?gpl|mpl)(?=v?[0-9])", r"\1 "),
    (r"\bv(?:er(?:sion)?)?\.? ?(?=[0-9])", "version "), (r"\b([0-9])\.0\b(?!\.[0-9])", r"\1"))]


def normal(text: str) -> str:
    low = text.lower()
    for form, plain in FORMS:
        low = form.sub(plain, low)
    return low


def terms(text: str) -> list[str]:
    return TERM.findall(text)


class Template:
    """A notice, found by its rarest naming or telling term; a heading fills its lines."""

    def __init__(self, name: str, text: str, idf: dict[str, float]):
        self.name, self.heading = name, text.startswith("= ")
        words = self.words = terms(normal(text))
        v = {t: c * idf[t] for t, c in Counter(words).items()}
        norm = math.sqrt(sum(x * x for x in v.values()))
        self.vector = {t: x / norm for t, x in v.items()}
        self.holds = set(words)
        self.numbers = {w for w in words if NUMBER.fullmatch(w)}
        self.must = self.numbers | (set(words) & TELLING)
        self.anchor = max(sorted(self.must - self.numbers) or sorted(self.must), key=lambda t: (idf[t], t))
        self.at = sorted({i for i, w in enumerate(words) if w == self.anchor})
        self.slack = 0 if self.heading else min(3, len(words) // 3)

    def names(self, window: list[str]) -> bool:
        got = set(window)
        return self.must <= got and got & NAMING == self.must & NAMING and (
            not self.numbers or {w for w in got if NUMBER.fullmatch(w)} == self.numbers)


class Matcher:
    """Notices of a text. Weights come from the templates alone, so a text has the same
    licence in every table, whatever its size and its other rows."""

    def __init__(self, templates=None):
        templates = TEMPLATES if templates is None else templates
        holds = Counter(t for texts in templates.values() for t in {t for x in texts for t in terms(normal(x))})
        self.idf = {t: math.log((1 + len(templates)) / (1 + n)) + 1 for t, n in holds.items()}
        self.anchors: dict[str, list[Template]] = {}
        for name in sorted(templates):
            for text in templates[name]:
                t = Template(name, text, self.idf)
                self.anchors.setdefault(t.anchor, []).append(t)
        files = sorted(TEXTS.glob("*.txt"))
        bodies = [Counter(terms(normal(f.read_text("utf-8")))) for f in files]
        self.body_names = [f.stem for f in files]
        self.spdx = {name.lower(): name for name in templates}
        holds = Counter(t for b in bodies for t in b)
        self.body_idf = {t: math.log((1 + len(bodies)) / (1 + n)) + 1 for t, n in holds.items()}
        self.bodies = []
        for b in bodies:
            v = self.weighted(b)
            norm = math.sqrt(sum(x * x for x in v.values()))
            self.bodies.append({t: x / norm for t, x in v.items()})

    def weighted(self, counts: Counter) -> dict[str, float]:
        """Weights of a whole text: counts as logarithms, so common words do not decide."""
        return {t: (1 + math.log(c)) * self.body_idf.get(t, OTHER) for t, c in counts.items()}

    def whole(self, words: list[str]) -> tuple[float, str | None]:
        """Highest cosine of the whole text to a full licence text, and that one's name."""
        v = self.weighted(Counter(words))
        norm = math.sqrt(sum(x * x for x in v.values()))
        cosines = [sum(x * v[t] for t, x in b.items() if t in v) / norm for b in self.bodies]
        best = max(range(len(cosines)), key=cosines.__getitem__, default=None)
        return (0.0, None) if best is None else (cosines[best], self.body_names[best])

    def tagged(self, text: str) -> list[str]:
        """Names in the SPDX expressions of a text that are no plain names of their own."""
        out = []
        for found in SPDX.findall(text):
            names = re.split(r"[\s()]+", found.lower())
            if len(names) > 1:
                out += [self.spdx[k] for n in names for k in (n, re.sub("-only$|-or-later$|[+]$", "", n)) if k in self.spdx]
        return list(dict.fromkeys(out))

    def cosine(self, template: Template, window: list[str]) -> float:
        counts = Counter(window)
        dot = norm = 0.0
        for w, c in counts.items():
            x = c * self.idf.get(w, OTHER)
            norm += x * x
            dot += x * template.vector.get(w, 0.0)
        return dot / math.sqrt(norm) if norm else 0.0

    def window(self, t: Template, words: list[str], line: list[int], pos: int) -> tuple[float, int, int]:
        """(cosine, start, end) of the best window of ``words`` around the anchor at ``pos``."""
        best, size, k = (0.0, 0, 0), len(t.words), t.slack
        if not t.must.issubset(words[max(pos - size - 2 * k, 0):pos + size + 2 * k + 1]):
            return best
        for off in t.at:
            for start in range(max(pos - off - k, 0), min(pos, pos - off + k) + 1):
                for end in range(max(start + size - k, pos + 1), min(start + size + k, len(words)) + 1):
                    if t.heading and (start and line[start - 1] == line[start] or end < len(words) and line[end] == line[end - 1]):
                        continue
                    part = words[start:end]
                    if t.names(part) and (c := self.cosine(t, part)) > best[0] + 1e-12:
                        if not (DENYING - t.holds).isdisjoint(words[max(0, start - BEFORE):end]):
                            continue
                        best = (c, start, end)
        return best

    def scan(self, text: str) -> tuple[str | None, float, float, list[str]]:
        """(licence, cosine, share of the words in licence lines, all licences) of a whole text; the
        share of a full licence text is its cosine to that."""
        low = text.lower()
        if not any(m in low for m in MARKS):
            return None, 0.0, 0.0, []
        words, line = [], []
        for i, row in enumerate(normal(low).split("\n")):
            got = terms(row)
            words += got
            line += [i] * len(got)
        if not words:
            return None, 0.0, 0.0, []
        whole, body = self.whole(words)
        if whole >= WHOLE:
            return body, whole, whole, [body]
        found: dict[str, tuple] = {}
        places: dict[str, int] = {}
        lines: set[int] = set()
        for pos, w in enumerate(words):
            for t in self.anchors.get(w, ()):
                c, start, end = self.window(t, words, line, pos)
                if c >= LEAST:
                    lines.update(line[start:end])
                    # the higher cosine, the earlier place, the longer template, the first name
                    key = (-round(c, 9), start, -len(t.words), t.name)
                    found[t.name] = min(found.get(t.name, key), key)
                    places[t.name] = min(places.get(t.name, start), start)
        for name in set(found) & set(WITHIN):
            for general in WITHIN[name]:
                found.pop(general, None)
        tags = self.tagged(text)
        if not found and not tags:
            return None, 0.0, 0.0, []
        named = sorted(found, key=lambda n: (places[n], found[n]))
        every = list(dict.fromkeys([*named, *tags]))
        share = sum(1 for x in line if x in lines) / len(words)
        if not found:
            return tags[0], 1.0, share, every
        top = min(found.values())
        return top[3], -top[0], share, every


def own_licences(files: DataFrame) -> DataFrame:
    """(key, path, licence, cosine, share, licences) of every row of ``files`` (key, path, text)."""
    import pyarrow as pa

    shipped = files.sparkSession.sparkContext.broadcast(Matcher())

    def scanned(batches):
        m = shipped.value
        for b in batches:
            got = [m.scan(t) if t else (None, 0.0, 0.0, []) for t in b.column(2).to_pylist()]
            names, tops, shares, every = zip(*got, strict=True) if got else ((), (), (), ())
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(names, pa.string()),
                                              pa.array(tops, pa.float64()), pa.array(shares, pa.float64()), pa.array(every, pa.list_(pa.string()))],
                                             names=["key", "path", "licence", "cosine", "share", "licences"])

    kind = dict(files.dtypes)["key"]
    return files.select("key", "path", "text").mapInArrow(
        scanned, f"key {kind}, path string, licence string, cosine double, share double, licences array<string>")


def directory(path: Column) -> Column:
    """The directory of a path; '' at the top, null for a null path."""
    return F.regexp_replace(path, "/?[^/]*$", "")


def ancestors(d: Column) -> Column:
    """A directory, each directory above it, and the top ''."""
    parts = F.split(d, "/")
    return F.transform(F.sequence(F.lit(0), F.size(parts)), lambda n: F.array_join(F.slice(parts, 1, n), "/"))


def licences(files: DataFrame) -> DataFrame:
    """(key, path, licence, cosine, origin, licence_dir, licences) of every row of ``files`` (key, path,
    text); origin is own, inherited or none; licences lists all that the file declares (or the one it inherits)."""
    own = saved(own_licences(files), "licence-own").withColumn("dir", directory(F.col("path")))
    is_file = F.col("licence").isNotNull() & (F.col("path").rlike(NAMES) | (F.col("share") >= MOSTLY))
    named = F.coalesce(F.col("path").rlike(NAMES), F.lit(False))
    best = F.max_by(F.struct("licence", "cosine"), F.struct(named.alias("n"), "cosine", F.col("licence").alias("l")))
    declared = saved(own.where(is_file & F.col("dir").isNotNull()).groupBy("dir").agg(best.alias("d"))
                     .select(F.col("dir").alias("at"), F.col("d.licence").alias("name"), F.col("d.cosine").alias("c")), "licence-dirs")
    dirs = own.where("dir is not null").select("dir").distinct()
    above = dirs.select("dir", F.posexplode(ancestors(F.col("dir"))).alias("depth", "up"))
    found = join_measured(above, declared, {"at": F.col("up")}, "inner")
    nearest = found.groupBy("dir").agg(F.max_by(F.struct("up", "name", "c"), "depth").alias("near"))
    nearest = saved(nearest.select("dir", F.col("near.up").alias("licence_dir"), F.col("near.name").alias("up_name"),
                                   F.col("near.c").alias("up_c")), "licence-nearest")
    joined = join_measured(own, nearest, ["dir"])
    mine = F.col("licence").isNotNull()
    inherits = ~mine & F.col("up_name").isNotNull()
    return joined.select("key", "path", F.coalesce("licence", "up_name").alias("licence"),
                         F.when(mine, F.col("cosine")).otherwise(F.coalesce("up_c", F.lit(0.0))).alias("cosine"),
                         F.when(mine, "own").when(inherits, "inherited").otherwise("none").alias("origin"),
                         F.when(inherits, F.col("licence_dir")).alias("licence_dir"),
                         F.when(inherits, F.array("up_name")).otherwise(F.col("licences")).alias("licences"))
