"""Licence scans: sparse TF-IDF cosine to templates, then inheritance from the nearest ancestor directory.

A unit of text is a vector over words, weighted by term count times ln((1 + N) / (1 + df)) + 1 where df counts the documents of the
corpus that have the word, whichever word it is. The units of a whole text are its lines' sentences, the sentences of its
paragraphs (lines joined, comment signs at their ends dropped), its paragraphs, and the text as a whole; the templates are notices of one
sentence, headers and licence texts. A file's own licence is the template of the highest cosine of any unit, if it reaches the threshold. A
file is a licence file if its name says so or if at least half of its words are in units of one kind that match. Files without a licence take that
of the nearest ancestor directory with a licence file, by joining the ancestors of the distinct directories.

The df of the templates' words, a fixed number, and the number of documents go to the driver. That of all other words is a
distributed table, joined by word with the sentences that share enough of a template to match.

Defined cases: a null or blank text has no licence of its own and may inherit. A null path has the directory "" and does
not inherit. Of several licence files in a directory the highest cosine counts, then the first name; equal cosines of one file go to the
first template by name. Repeated rows are answered each. An empty table gives an empty result. Columns besides path,
text and those kept are ignored.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import materialize, small

# Notices by SPDX name.
TEMPLATES = {
    "Apache-2.0": ["Licensed under the Apache License, Version 2.0", "You may not use this file except in compliance with the License", "You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0"],
    "MIT": ["Released under the MIT License", "Licensed under the MIT license", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files"],
    "BSD-3-Clause": ["Licensed under the BSD 3-Clause License", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met"],
    "GPL-2.0": ["Licensed under the GNU General Public License, version 2"],
    "GPL-3.0": ["Licensed under the GNU General Public License, version 3", "This work is licensed under the GNU General Public License, version 3", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License version 3"],
    "LGPL-3.0": ["Licensed under the GNU Lesser General Public License, version 3"],
    "AGPL-3.0": ["Licensed under the GNU Affero General Public License, version 3"],
    "MPL-2.0": ["This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0", "Licensed under the Mozilla Public License, Version 2.0"],
    "CC-BY-4.0": ["Licensed under CC BY 4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License"],
    "CC-BY-SA-4.0": ["Licensed under CC BY-SA 4.0", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License"],
    "CC-BY-NC-4.0": ["Licensed under CC BY-NC 4.0", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License"],
    "CC0-1.0": ["Released under CC0 1.0", "To the extent possible under law, the author has waived all copyright and related rights to this work"],
    "Unlicense": ["This is free and unencumbered software released into the public domain"],
    "Proprietary": ["All rights reserved", "Unauthorized copying of this file is strictly prohibited"],
}
# Headers and licence texts by SPDX name, in their published wording.
TEXTS = {
    "MIT": [
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions: The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software. THE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."
    ],
    "ISC": [
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies. THE SOFTWARE IS PROVIDED \"AS IS\" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE."
    ],
    "BSD-3-Clause": [
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met: 1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer. 2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution. 3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission."
    ],
    "Apache-2.0": [
        "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing permissions and limitations under the License."
    ],
    "GPL-2.0": ["This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation; either version 2 of the License, or (at your option) any later version."],
    "GPL-3.0": ["This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version."],
    "LGPL-3.0": ["This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation; either version 3 of the License, or (at your option) any later version."],
    "AGPL-3.0": ["This program is free software: you can redistribute it and/or modify it under the terms of the GNU Affero General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version."],
    "Unlicense": [
        "This is free and unencumbered software released into the public domain. Anyone is free to copy, modify, publish, use, compile, sell, or distribute this software, either in source code form or as a compiled binary, for any purpose, commercial or non-commercial, and by any means."
    ],
}
LICENSE_NAME = r"(?i)(^|/)(licen[cs]e|copying|unlicense)([.-][^/]*)?$"
_WORD = re.compile(r"[a-z]+|[0-9]+(?:\.[0-9]+)*")
_SENTENCE = re.compile(r"\n|(?<=[.!?;])\W*\s+")
_PARAGRAPH, _END, _SIGNS = re.compile(r"\n[ \t\r#*/;%-]*\n"), re.compile(r"(?<=[.!?])\W*\s+"), re.compile(r"^[\s#*/;%-]+|[\s#*/%]+$")


def words(sentence: str) -> list[str]:
    return _WORD.findall(sentence.lower())


def units(text: str) -> list[tuple[int, str]]:
    """The units of a text that are compared with templates, each with its kind: sentences of lines, sentences of paragraphs, paragraphs, all of it."""
    out = [(0, s) for s in _SENTENCE.split(text)]
    paragraphs = [" ".join(_SIGNS.sub("", line) for line in p.split("\n")) for p in _PARAGRAPH.split(text)] if "\n" in text else [text]
    out += [(1, s) for p in paragraphs for s in _END.split(p)]
    out += [(2, p) for p in paragraphs]
    return [*out, (3, " ".join(paragraphs))] if len(paragraphs) > 1 else out


VOCABULARY = sorted({w for templates in (TEMPLATES, TEXTS) for texts in templates.values() for t in texts for w in words(t)})


class Scorer:
    """Cosines of units of text to all templates, given the vocabulary's df and the number of documents."""

    def __init__(self, df: dict[str, int], n: int) -> None:
        self.n = n
        self.idf = {w: math.log((1 + n) / (1 + df.get(w, 0))) + 1 for w in VOCABULARY}
        self.vectors = [(name, self.vector(t, {})) for name in sorted({*TEMPLATES, *TEXTS}) for t in [*TEMPLATES.get(name, ()), *TEXTS.get(name, ())]]

    def weight(self, w: str, df: dict[str, int]) -> float:
        return self.idf[w] if w in self.idf else math.log((1 + self.n) / (1 + df.get(w, 0))) + 1

    def vector(self, sentence: str, df: dict[str, int]) -> dict[str, float]:
        v = {w: c * self.weight(w, df) for w, c in Counter(words(sentence)).items()}
        norm = math.sqrt(sum(x * x for x in v.values())) or 1.0
        return {w: x / norm for w, x in v.items()}

    def possible(self, found: set[str], threshold: float) -> bool:
        """Whether a text of these words can reach threshold: a cosine is at most the length of the template's part that is shared."""
        return any(sum(x * x for w, x in t.items() if w in found) >= threshold * threshold - 1e-9 for _, t in self.vectors)

    def best(self, sentence: str, df: dict[str, int] | None = None) -> tuple[float, str | None]:
        """The highest cosine and its template's name, given the df of the words outside the vocabulary."""
        v = self.vector(sentence, df or {})
        score, name = 0.0, None
        for n, t in self.vectors:
            dot = round(sum(x * v[w] for w, x in t.items() if w in v), 9)
            if dot > score:
                score, name = dot, n
        return score, name


def document_frequencies(files: DataFrame) -> tuple[dict[str, int], int]:
    """df of the templates' words over all texts, and the number of texts."""
    import pyarrow as pa

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, seen = set(VOCABULARY), Counter()
        for b in batches:
            for t in b.column(0):
                seen.update(known.intersection(words(t.as_py() or "")))
            seen[""] += b.num_rows
        yield pa.RecordBatch.from_arrays([pa.array(list(seen), pa.string()), pa.array(list(seen.values()), pa.int64())], ["w", "n"])

    rows = files.select("text").mapInArrow(count, "w string, n long").groupBy("w").agg(F.sum("n").alias("n")).collect()  # at most one for each word
    df = {r["w"]: r["n"] for r in rows}
    return df, df.pop("", 0)


def all_frequencies(files: DataFrame) -> DataFrame:
    """w and n: df of every word outside the vocabulary over all texts."""
    import pyarrow as pa

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = set(VOCABULARY)
        for b in batches:
            seen = Counter()
            for t in b.column(0):
                seen.update(set(words(t.as_py() or "")) - known)
            yield pa.RecordBatch.from_arrays([pa.array(list(seen), pa.string()), pa.array(list(seen.values()), pa.int64())], ["w", "n"])

    return files.select("text").mapInArrow(count, "w string, n long").groupBy("w").agg(F.sum("n").alias("n"))


def scan(files: DataFrame, threshold: float = 0.6, keep: tuple[str, ...] = ()) -> DataFrame:
    """keep's columns, path, license (own; null if none), cosine and license_file of every file."""
    import pyarrow as pa

    df, n = document_frequencies(files)
    scorer, k = Scorer(df, n), len(keep)

    def look(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        known, row = set(VOCABULARY), TaskContext.get().partitionId() << 33
        for b in batches:
            totals, possible, others = [], [], []
            for text in b.column(k + 1).to_pylist():
                total, own_units, other = 0, [], set()
                all_words = words(text or "")
                if scorer.possible(known.intersection(all_words), threshold):
                    total = len(all_words)
                    for kind, s in units(text):
                        own = words(s)
                        if scorer.possible(known.intersection(own), threshold):
                            own_units.append(f"{kind}{s}")
                            other.update(set(own) - known)
                totals.append(total)
                possible.append(own_units)
                others.append(sorted(other))
            strings = pa.list_(pa.string())
            rows = pa.array(range(row, row + b.num_rows), pa.int64())
            row += b.num_rows
            yield pa.RecordBatch.from_arrays([*(b.column(i) for i in range(k + 1)), rows, pa.array(totals, pa.int64()), pa.array(possible, strings), pa.array(others, strings)], [*keep, "path", "_row", "_total", "_units", "_others"])

    def match(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            names, scores, files_ = [], [], []
            for total, possible, ws, ns in zip(*(b.column(i).to_pylist() for i in range(k + 1, k + 5)), strict=True):
                best, name, inside, own = 0.0, None, [0] * 4, dict(zip(ws or (), ns or (), strict=True))
                for kind, s in ((int(x[0]), x[1:]) for x in possible):
                    score, found = scorer.best(s, own)
                    if score >= threshold:
                        inside[kind] += len(words(s))
                        if (-score, found) < (-best, name or "~"):
                            best, name = score, found
                names.append(name)
                scores.append(best)
                files_.append(bool(total) and 2 * max(inside) >= total)
            yield pa.RecordBatch.from_arrays([*(b.column(i) for i in range(k + 1)), pa.array(names, pa.string()), pa.array(scores, pa.float64()), pa.array(files_, pa.bool_())], [*keep, "path", "license", "cosine", "mostly"])

    kept = "".join(f"`{c}` {files.schema[c].dataType.simpleString()}, " for c in keep) + "path string, "
    looked = files.select(*keep, F.col("path").cast("string").alias("path"), "text").mapInArrow(look, kept + "_row long, _total long, _units array<string>, _others array<string>")
    looked = materialize(looked, "sentences")
    asked = looked.select("_row", F.explode("_others").alias("w"))
    wanted = small(materialize(asked.select("w").distinct(), "words"))
    df_ = small(materialize(all_frequencies(files).join(wanted, "w", "left_semi"), "frequencies"))
    got = asked.join(df_, "w").groupBy("_row").agg(F.collect_list(F.struct("w", "n")).alias("g"))
    out = looked.join(got, "_row", "left").select(*keep, "path", "_total", "_units", F.col("g.w").alias("_w"), F.col("g.n").alias("_n"))
    out = out.mapInArrow(match, kept + "license string, cosine double, mostly boolean")
    named = F.coalesce(F.col("path").rlike(LICENSE_NAME), F.lit(False))
    return out.withColumn("license_file", F.col("license").isNotNull() & (named | F.col("mostly"))).drop("mostly")


def directory_of(path: str = "path") -> Column:
    """Everything before the last slash; "" if there is none."""
    return F.regexp_replace(F.regexp_extract(F.coalesce(path, F.lit("")), r"(?s)^(.*)/[^/]*$", 1), "/+$", "")


def inherit(scanned: DataFrame) -> DataFrame:
    """scanned with effective_license, and inherited_from (the directory; null if the licence is the file's own or there is none)."""
    s = scanned.withColumn("_dir", directory_of())
    given = s.filter("license_file AND path IS NOT NULL").groupBy(F.col("_dir").alias("_anc"))
    given = given.agg(F.min(F.struct((-F.col("cosine")).alias("c"), F.col("path").alias("p"), F.col("license").alias("l"))).alias("g")).select("_anc", F.col("g.l").alias("_given"))
    dirs = s.filter("license IS NULL AND path IS NOT NULL").select("_dir").distinct()
    parts = "split(_dir, '/')"
    chain = f"array_union(transform(sequence(size({parts}), 1), i -> array_join(slice({parts}, 1, i), '/')), array(''))"
    up = dirs.select("_dir", F.explode(F.expr(chain)).alias("_anc")).join(given, "_anc")
    near = up.groupBy("_dir").agg(F.max(F.struct(F.length("_anc").alias("n"), F.col("_anc").alias("a"), F.col("_given").alias("l"))).alias("g"))
    near = materialize(near.select(F.col("_dir").alias("_of"), F.col("g.a").alias("_from"), F.col("g.l").alias("_taken")), "directories")
    out = s.join(near, (F.col("_dir") == F.col("_of")) & F.col("license").isNull() & F.col("path").isNotNull(), "left")
    out = out.withColumn("effective_license", F.coalesce("license", "_taken")).withColumn("inherited_from", F.when(F.col("license").isNull(), F.col("_from")))
    return out.drop("_dir", "_of", "_from", "_taken")


def license_scan(files: DataFrame, threshold: float = 0.6, keep: tuple[str, ...] = ()) -> DataFrame:
    """keep's columns, path, license, cosine, license_file, effective_license and inherited_from of every file."""
    return inherit(materialize(scan(files, threshold, keep), "scanned"))
