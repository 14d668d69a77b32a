"""Licence scan by sparse TF-IDF cosine and directory inheritance, in DataFrame functions only.

The candidates of a file are its lines, its runs of lines up to a blank one, the
comment lines it begins with, and a licence file's text as a whole, which is
compared with whole licences too; comment marks are left out of all but single lines. A candidate's TF-IDF vector is compared with those of the templates by a join over terms.
Weights are integers (a thousandth of a nat), so that sums are exact. A
candidate matches the template of the highest cosine if that reaches
``THRESHOLD``.

With a template, a candidate's cosine is at most the norm share of the terms
they have in common. So a match must hold terms of enough norm, and above all
one of the template's leading terms: the rest together, common words first, are
chosen to stay under the threshold. Candidates that fail either bound are passed
over, which loses no match. Equal candidates are scored once, under their hash,
however many files hold them.

A file without a licence of its own takes that of the nearest directory above
it (its own included) that has a licence file: directories are joined with
their ancestors, never files with files.

Defined results: a null text has no licence; a null path lies in no directory.
Of several matches in a file the highest score counts, then the first name; so
it is for several licence files of a directory. Repeated rows come back as
often as they come in. An empty table gives an empty result. Other columns are
not carried along.
"""

from __future__ import annotations

import math
import re
from collections import Counter

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from citystream.llm.common import bounded, cut
from citystream.session import prepare

THRESHOLD = 0.7
WORD = r"[^a-z0-9.]+"
#: Words so common in running text that a match must not hang on them, where that can be had. Fixed values.
COMMON = frozenset("""a about all an and any are as at be been but by can do for from had has have he her his i if in into is it its
may me mit more my no not of on one only or other our out see she so some than that the their them then there these they this to
up use used was we were what when which who will with would you your""".split())
LICENSE_FILE = r"(?i)(^|/)(licen[sc]e|copying|notice|unlicense)[^/]*$"

#: Statements and headers by SPDX name. Fixed values.
TEMPLATES = (
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", 'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance '
                   "with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0"),
    ("Apache-2.0", 'Unless required by applicable law or agreed to in writing, software distributed under the License is distributed '
                   'on an "AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied.'),
    ("Apache-2.0", "SPDX-License-Identifier: Apache-2.0"),
    ("MIT", "Released under the MIT License."),
    ("MIT", 'Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated '
            'documentation files (the "Software"), to deal in the Software without restriction, including without limitation the '
            "rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software"),
    ("MIT", "SPDX-License-Identifier: MIT"),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-3.0", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public "
                "License as published by the Free Software Foundation, either version 3 of the License, or any later version."),
    ("GPL-3.0", "SPDX-License-Identifier: GPL-3.0-only"),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-NC-4.0", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License."),
    ("CC-BY-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    ("BSD-3-Clause", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that "
                     "the following conditions are met"),
    ("BSD-3-Clause", "SPDX-License-Identifier: BSD-3-Clause"),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
)
#: Whole texts, for licence files only: their frequent words would make candidates of any long text. Fixed values.
WHOLE = (
    ("MIT", "MIT License Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
            'documentation files (the "Software"), to deal in the Software without restriction, including without limitation the '
            "rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit "
            "persons to whom the Software is furnished to do so, subject to the following conditions: The above copyright notice and "
            "this permission notice shall be included in all copies or substantial portions of the Software. THE SOFTWARE IS PROVIDED "
            '"AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF '
            "MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS "
            "BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, "
            "OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."),
    ("BSD-3-Clause", "BSD 3-Clause License All rights reserved. Redistribution and use in source and binary forms, with or without "
                     "modification, are permitted provided that the following conditions are met: 1. Redistributions of source code "
                     "must retain the above copyright notice, this list of conditions and the following disclaimer. 2. Redistributions "
                     "in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in "
                     "the documentation and/or other materials provided with the distribution. 3. Neither the name of the copyright "
                     "holder nor the names of its contributors may be used to endorse or promote products derived from this software "
                     "without specific prior written permission. THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "
                     '"AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF '
                     "MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR "
                     "CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES "
                     "(INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR "
                     "BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR "
                     "TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF "
                     "THE POSSIBILITY OF SUCH DAMAGE."),
    ("ISC", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, "
            "provided that the above copyright notice and this permission notice appear in all copies. THE SOFTWARE IS PROVIDED "
            '"AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF '
            "MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL "
            "DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, "
            "NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE."),
)

#: The marks before the text of a comment line; a line of marks alone is a blank one.
MARKS = r"(?m)^[ \t]*(#+|//+|/\*+|\*+/|\*+|--+|;+|%+|<!--)?[ \t]*(-->|\*+/)?"
#: The comment lines that a text begins with.
HEADER = r"\A(?:[ \t]*(?:#|//|/\*|\*|--|;|%)[^\n]*\n)+"


def _terms(text: str) -> Counter:
    return Counter(w.strip(".") for w in re.split(WORD, text.lower()) if w.strip("."))


def prefix_tree(words: list[str]) -> str:
    """A pattern for any of ``words`` in which shared beginnings are tried once."""
    tails: dict[str, list[str]] = {}
    for w in words:
        tails.setdefault(w[:1], []).append(w[1:])
    ways = [re.escape(head) + (prefix_tree(rest) if any(rest) else "") for head, rest in sorted(tails.items()) if head]
    return f"(?:{'|'.join(ways)}){'?' * ('' in tails)}"


class Model:
    """Term and template weights. ``unseen`` is the weight of a term of no template."""

    def __init__(self, templates=TEMPLATES, threshold: float = THRESHOLD):
        counts = [_terms(text) for _, text in templates]
        df = Counter(t for c in counts for t in c)
        weigh = lambda n: 1000 + round(1000 * math.log((1 + len(templates)) / (1 + n)))
        self.threshold, self.unseen = threshold, weigh(0)
        self.weights = {t: weigh(n) for t, n in df.items()}
        self.postings = [(t, i, n * self.weights[t]) for i, c in enumerate(counts) for t, n in sorted(c.items())]
        self.norms = [(i, templates[i][0], sum((n * self.weights[t]) ** 2 for t, n in c.items())) for i, c in enumerate(counts)]
        leading = set()
        for (i, _, norm), c in zip(self.norms, counts):
            light = 0
            for t in sorted(c, key=lambda t: (t not in COMMON, c[t] * self.weights[t], t)):
                light += (c[t] * self.weights[t]) ** 2
                if light >= threshold ** 2 * norm:
                    leading.add(t)
        self.leading = sorted(leading)

    def pattern(self) -> str:
        """Finds texts that hold a leading term."""
        return rf"(?i)(?<![a-z0-9]){prefix_tree(self.leading)}(?![a-z0-9])"

    def enough(self, known: str) -> str:
        """SQL for: the array ``known`` holds terms of enough norm of a template."""
        sums = {i: [] for i, _, _ in self.norms}
        for term, i, part in self.postings:
            sums[i].append(f"if(array_contains({known}, '{term}'), {part * part}L, 0L)")
        return " OR ".join(f"{' + '.join(sums[i])} >= {math.floor(self.threshold ** 2 * norm)}L" for i, _, norm in self.norms)


def tokens(line: Column) -> Column:
    return F.filter(F.transform(F.split(F.lower(line), WORD), lambda x: F.btrim(x, F.lit("."))), lambda x: x != "")


def one_line(text: Column) -> Column:
    """``text`` without comment marks, as one line."""
    return F.regexp_replace(F.regexp_replace(text, MARKS, ""), "\n", " ")


def blocks(text: Column) -> Column:
    """The units of a text that are compared: its lines, its runs of lines up to
    a blank one and its leading comment lines, these two without comment marks
    and as one line each."""
    runs = F.transform(F.split(F.regexp_replace(text, MARKS, ""), "\n\n+"), lambda t: F.regexp_replace(t, "\n", " "))
    return F.concat(F.split(text, "\n"), runs, F.array(one_line(F.regexp_extract(text, HEADER, 0))))


def candidate_lines(rows: DataFrame, lines: Column, model: Model) -> DataFrame:
    """The rows' other columns with each of their ``lines`` that may match."""
    vocabulary = F.array(*map(F.lit, sorted(model.weights)))
    leading = F.filter(lines, lambda x: x.rlike(model.pattern()))
    known = F.transform(leading, lambda x: F.struct(x.alias("line"), F.array_intersect(tokens(x), vocabulary).alias("known")))
    # The outer form: the plain one would have a filter inferred that computes all this twice.
    return rows.select("*", F.inline_outer(known)).where(f"line IS NOT NULL AND ({model.enough('known')})").drop("known")


def _rows(spark, rows: list[tuple], schema: str) -> DataFrame:
    """A fixed small table out of literals."""
    names = [c.split()[0] for c in schema.split(", ")]
    made = F.array(*(F.struct(*(F.lit(v).alias(n) for v, n in zip(r, names))) for r in rows))
    return spark.range(1).select(F.inline(made)).select(*(F.col(n).cast(c.split()[1]) for n, c in zip(names, schema.split(", "))))


def scores(candidates: DataFrame, model: Model) -> DataFrame:
    """(line_id, license, score) of the rows (line_id, line) that match."""
    spark = candidates.sparkSession
    terms = (candidates.groupBy("line_id").agg(F.first("line").alias("line"))
             .select("line_id", F.explode(tokens(F.col("line"))).alias("term"))
             .groupBy("line_id", "term").agg(F.count("*").alias("tf")))
    # All three tables are the templates', a fixed few hundred rows.
    weights = F.broadcast(_rows(spark, sorted(model.weights.items()), "term string, weight bigint"))
    postings = F.broadcast(_rows(spark, model.postings, "term string, template int, part bigint"))
    norms = F.broadcast(_rows(spark, model.norms, "template int, license string, norm bigint"))
    weighed = cut(terms.join(weights, "term", "left")
                  .select("line_id", "term", (F.col("tf") * F.coalesce("weight", F.lit(model.unseen))).alias("part_a")))
    own = weighed.groupBy("line_id").agg(F.sum(F.col("part_a") * F.col("part_a")).alias("norm_a"))
    dots = (weighed.join(postings, "term").groupBy("line_id", "template")
            .agg(F.sum(F.col("part_a") * F.col("part")).alias("dot")))
    cosine = F.col("dot").cast("double") / F.sqrt(F.col("norm").cast("double") * F.col("norm_a").cast("double"))
    return (dots.join(norms, "template").join(own, "line_id").withColumn("score", cosine)
            .where(F.col("score") >= model.threshold)
            .groupBy("line_id").agg(F.min(F.struct((-F.col("score")).alias("s"), "license")).alias("best"))
            .select("line_id", F.col("best.license").alias("license"), (-F.col("best.s")).alias("score")))


def scan(files: DataFrame, path_col: str = "path", text_col: str = "text", model: Model | None = None,
         license_file: Column | None = None, whole_model: Model | None = None) -> DataFrame:
    """(path, license, score, origin, inherited_from): ``origin`` is ``own``,
    ``inherited`` or null, ``inherited_from`` the directory of the licence file."""
    prepare(files.sparkSession)
    model, whole_model = model or Model(), whole_model or Model(TEMPLATES + WHOLE)
    rows = files.select(files[path_col].alias("path"), files[text_col].alias("text"))
    named = F.coalesce(license_file if license_file is not None else F.col("path").rlike(LICENSE_FILE), F.lit(False))
    # Texts without a leading term hold no match; the others are taken apart.
    parts = candidate_lines(rows.where(F.col("text").rlike(model.pattern())), blocks(F.col("text")), model)
    wholes = candidate_lines(rows.where(named), F.array(one_line(F.col("text"))), whole_model)
    # Read several times below: the scan of all texts is cut off here.
    lines = cut(parts.withColumn("whole", F.lit(False)).unionByName(wholes.withColumn("whole", F.lit(True)))
                .select("path", "whole", F.sha2("line", 256).alias("line_id"), "line").distinct())
    matched = bounded(cut(scores(lines.where("NOT whole"), model).withColumn("whole", F.lit(False))
                          .unionByName(scores(lines.where("whole"), whole_model).withColumn("whole", F.lit(True)))))
    own = cut(lines.select("path", "line_id", "whole").join(matched, ["line_id", "whole"]).groupBy("path")
              .agg(F.min(F.struct((-F.col("score")).alias("s"), "license")).alias("best"))
              .select("path", F.col("best.license").alias("own"), (-F.col("best.s")).alias("own_score")))
    directory = F.regexp_replace("path", r"/?[^/]*$", "")
    licensed = (own.where(F.col("path").rlike(LICENSE_FILE) if license_file is None else license_file)
                .groupBy(directory.alias("above"))
                .agg(F.min(F.struct((-F.col("own_score")).alias("s"), F.col("own").alias("license"))).alias("best"))
                .select("above", F.col("best.license").alias("given"), (-F.col("best.s")).alias("given_score")))
    above = F.expr("""transform(sequence(0, if(dir = '', 0, size(split(dir, '/')))),
                                k -> struct(array_join(slice(split(dir, '/'), 1, k), '/') AS above, k AS depth))""")
    nearest = (rows.where("path IS NOT NULL").select(directory.alias("dir")).distinct()
               .select("dir", F.inline(above)).join(licensed, "above").groupBy("dir")
               .agg(F.max(F.struct("depth", "above", "given", "given_score")).alias("n")).select("dir", "n.above", "n.given", "n.given_score"))
    return (rows.select("path", directory.alias("dir"))
            .join(bounded(own), "path", "left").join(bounded(nearest), "dir", "left")
            .select(F.col("path").alias(path_col), F.coalesce("own", "given").alias("license"),
                    F.coalesce("own_score", "given_score").alias("score"),
                    F.when(F.col("own").isNotNull(), "own").when(F.col("given").isNotNull(), "inherited").alias("origin"),
                    F.when(F.col("own").isNull(), F.col("above")).alias("inherited_from")))
