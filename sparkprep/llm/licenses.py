"""License scans by conditional compression.

Candidate blocks are the words around every license cue, as many on both sides as a
template may take, whatever line breaks, comment signs or long lines they are in;
overlapping ones are joined and cut into pieces of twice that length, each half in two pieces.
Lengths go by powers of two, so a one-line grant is held against a line and a notice against a page.
The words of a piece, lower-cased and one space apart, are
compressed alone and with each template of that length as a zstandard raw-content dictionary. A template is
a winner if the bytes it saves are ``MARGIN`` or more of those that it saves on itself;
winners are ranked by the bytes they save, and only they are looked for: one is
confirmed where its wording holds: at most one word in ten of the template may be missing
or replaced, none with a digit (a version) and none that sets it apart from another
license's template, by a word-by-word comparison. Words belong to the winner with the
greatest saving that is confirmed there, so a notice that holds another license's wording
(GPL in LGPL, one preamble of several licenses) is reported as itself. Every occurrence is
reported with the range of its own words.

Defined results: null or empty texts have no blocks; every cue of a text is looked
at, however long; repeated rows each get their result; an empty table gives an empty one;
columns besides id and text are not read, whatever their names; no shuffle is needed.
"""

from __future__ import annotations

import re
from bisect import bisect_right
from collections.abc import Iterator
from difflib import SequenceMatcher

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from sparkprep.llm.common import of
from sparkprep.session import ship_package

#: Names by which licenses are granted in one line, by SPDX name.
SPOKEN: dict[str, tuple[str, ...]] = {
    "0BSD": ("BSD Zero Clause License", "Zero-Clause BSD License"),
    "AGPL-3.0": ("GNU Affero General Public License, version 3", "AGPL-3.0 License"),
    "Apache-2.0": ("Apache License, Version 2.0", "Apache 2.0 License"),
    "BSD-2-Clause": ("BSD 2-Clause License", "Simplified BSD License"),
    "BSD-3-Clause": ("BSD 3-Clause License", "Revised BSD License"),
    "BSL-1.0": ("Boost Software License, Version 1.0",),
    "GPL-2.0": ("GNU General Public License, version 2", "GPL-2.0 License"),
    "GPL-3.0": ("GNU General Public License, version 3", "GPL-3.0 License"),
    "ISC": ("ISC License",),
    "LGPL-2.1": ("GNU Lesser General Public License, version 2.1", "LGPL-2.1 License"),
    "LGPL-3.0": ("GNU Lesser General Public License, version 3", "LGPL-3.0 License"),
    "MIT": ("MIT License",),
    "MPL-2.0": ("Mozilla Public License, Version 2.0", "MPL-2.0 License"),
    "Unlicense": ("Unlicense",),
    "Zlib": ("zlib License",),
}
#: Names that only a tag has.
TAGGED = ("CC-BY-4.0", "CC-BY-NC-4.0", "CC-BY-SA-4.0", "CC0-1.0")
GRANT = "under the {}."

_AS_IS = ('THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT '
          "LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO "
          "EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER "
          "IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR "
          "THE USE OR OTHER DEALINGS IN THE SOFTWARE.")
_MIT_GRANT = ("Permission is hereby granted, free of charge, to any person obtaining a copy of this "
              'software and associated documentation files (the "Software"), to deal in the Software '
              "without restriction, including without limitation the rights to use, copy, modify, "
              "merge, publish, distribute, sublicense, and/or sell copies of the Software")
_BSD_GRANT = ("Redistribution and use in source and binary forms, with or without modification, are "
              "permitted provided that the following conditions are met:")
_BSD_TWO = ("1. Redistributions of source code must retain the above copyright notice, this list of conditions and "
            "the following disclaimer. 2. Redistributions in binary form must reproduce the above copyright notice, "
            "this list of conditions and the following disclaimer in the documentation and/or other materials "
            "provided with the distribution.")
_BSD_THIRD = ("3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse "
              "or promote products derived from this software without specific prior written permission.")
_BSD_AS_IS = ('THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED '
              "WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A "
              "PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR "
              "ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT "
              "LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS "
              "INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR "
              "TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF "
              "ADVISED OF THE POSSIBILITY OF SUCH DAMAGE.")
_ISC_AS_IS = ('THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE '
              "INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE "
              "FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM "
              "LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, "
              "ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE.")
_ISC_GRANT = ("Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is "
              "hereby granted")


def _gnu(name: str, version: str, stop: str) -> str:
    return ("This program is free software{} you can redistribute it and/or modify it under the "
            "terms of the GNU {} as published by the Free Software "
            "Foundation{} either version {} of the License, or (at your option) any later version."
            ).format(*((";", name, ";", version) if stop == ";" else (":", name, ",", version)))


#: Public notices by SPDX name.
NOTICES: dict[str, tuple[str, ...]] = {
    "0BSD": (f"{_ISC_GRANT}. {_ISC_AS_IS}",),
    "AGPL-3.0": (_gnu("Affero General Public License", "3", ":"),),
    "Apache-2.0": (
        'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file '
        "except in compliance with the License. You may obtain a copy of the License at "
        "http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to "
        'in writing, software distributed under the License is distributed on an "AS IS" BASIS, '
        "WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied.",),
    "BSD-2-Clause": (f"{_BSD_GRANT} {_BSD_TWO} {_BSD_AS_IS}",),
    "BSD-3-Clause": (_BSD_GRANT, f"{_BSD_GRANT} {_BSD_TWO} {_BSD_THIRD} {_BSD_AS_IS}"),
    "BSL-1.0": ("Permission is hereby granted, free of charge, to any person or organization obtaining a copy of the "
                "software and accompanying documentation covered by this license (the \"Software\") to use, "
                "reproduce, display, distribute, execute, and transmit the Software, and to prepare derivative works "
                "of the Software, and to permit third-parties to whom the Software is furnished to do so",),
    "CC-BY-4.0": ("Licensed under CC BY 4.0.",
                  "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    "CC-BY-NC-4.0": ("Licensed under CC BY-NC 4.0.",
                     "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 "
                     "International License."),
    "CC-BY-SA-4.0": ("Licensed under CC BY-SA 4.0.",
                     "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 "
                     "International License."),
    "CC0-1.0": ("To the extent possible under law, the author has waived all copyright and related or neighboring "
                "rights to this work.",),
    "GPL-2.0": ("This work is licensed under the GNU General Public License, version 2.",
                _gnu("General Public License", "2", ";")),
    "GPL-3.0": ("This work is licensed under the GNU General Public License, version 3.",
                _gnu("General Public License", "3", ":")),
    "ISC": (f"{_ISC_GRANT}, provided that the above copyright notice and this permission notice appear in all "
            f"copies. {_ISC_AS_IS}",),
    "LGPL-2.1": (_gnu("Lesser General Public License", "2.1", ";"),),
    "LGPL-3.0": (_gnu("Lesser General Public License", "3", ":"),),
    "MIT": (_MIT_GRANT,
            f"{_MIT_GRANT}, and to permit persons to whom the Software is furnished to do so, subject to the following "
            "conditions: The above copyright notice and this permission notice shall be included in all copies or "
            f"substantial portions of the Software. {_AS_IS}"),
    "MPL-2.0": ("This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the "
                "MPL was not distributed with this file, You can obtain one at https://mozilla.org/MPL/2.0/.",),
    "Unlicense": ("This is free and unencumbered software released into the public domain. Anyone is free to copy, "
                  "modify, publish, use, compile, sell, or distribute this software, either in source code form or as "
                  "a compiled binary, for any purpose, commercial or non-commercial, and by any means.",),
    "Zlib": ("This software is provided 'as-is', without any express or implied warranty. In no event will the authors "
             "be held liable for any damages arising from the use of this software. Permission is granted to anyone "
             "to use this software for any purpose, including commercial applications, and to alter it and "
             "redistribute it freely, subject to the following restrictions:",),
}
#: All templates: tags, one-line grants and notices.
TEMPLATES: dict[str, tuple[str, ...]] = {
    name: (*NOTICES.get(name, ()), *map(GRANT.format, SPOKEN.get(name, ())), f"SPDX-License-Identifier: {name}")
    for name in sorted({*SPOKEN, *TAGGED, *NOTICES})}
CUE = re.compile(r"licen[sc]|copyright|permission (?:is|to use)|redistribut|creative commons|\bCC[ -]BY\b"
                 r"|free software|unencumbered", re.I)
WORD = re.compile(r"\w+(?:[.-]\w+)*")
#: Differing words allowed per word of the template.
TOLERANCE = 0.1
#: Least share of the bytes a template saves on itself that a winner saves on a piece. Notices
#: reworded within the tolerance in random places saved 0.46 and more.
MARGIN = 0.4
#: Words on both sides of a cue for the shortest templates.
NEAREST = 8


def words_of(text: str) -> list[str]:
    return [w.lower() for w in WORD.findall(text)]


class LicenseScanner:
    def __init__(self, templates: dict[str, tuple[str, ...]] = TEMPLATES, margin: float = MARGIN):
        import zstandard as zstd

        # literals stay as they are (a target length with the fast strategy): on pieces this
        # short, whether they are entropy-coded would weigh more than what a template saves
        params = zstd.ZstdCompressionParameters.from_level(
            1, strategy=zstd.STRATEGY_FAST, target_length=1, min_match=4, hash_log=14,
            write_content_size=False, write_checksum=False, write_dict_id=False)

        def compressor(**kw):
            return zstd.ZstdCompressor(compression_params=params, **kw)

        self.alone = compressor()
        wordings = [(name, words_of(t)) for name in sorted(templates) for t in templates[name]]
        self.templates = [
            (name, w, compressor(dict_data=zstd.ZstdCompressionDict(
                self.spaced(w), dict_type=zstd.DICT_TYPE_RAWCONTENT))) for name, w in wordings]
        #: Bytes that each template saves on itself.
        self.worth = [self.saved(self.spaced(w), i) for i, (_, w) in enumerate(wordings)]
        self.margin = margin
        #: Per number of words on both sides of a cue, the templates that need so many.
        self.by_reach: dict[int, list[int]] = {}
        for i, (_, w, _) in enumerate(self.templates):
            reach = NEAREST
            while reach < len(w) + self.allowed(w):
                reach *= 2
            self.by_reach.setdefault(reach, []).append(i)
        #: Per template, the words it lacks in other licenses' templates within the tolerance.
        self.apart: list[set[str]] = []
        for name, mine, _ in self.templates:
            lacking = [self.differences(mine, w) for other, w, _ in self.templates
                       if other != name and abs(len(w) - len(mine)) <= self.allowed(mine)]
            self.apart.append({w for lack, added, *_ in lacking if max(len(lack), added) <= self.allowed(mine)
                               for w in lack})

    @staticmethod
    def spaced(words: list[str]) -> bytes:
        """What is compressed; the margins let matches reach the first and last words."""
        return b"\n" * 8 + " ".join(words).encode("utf-8", "surrogatepass") + b"\n" * 8

    @staticmethod
    def allowed(wording: list[str]) -> int:
        return int(TOLERANCE * len(wording))

    @staticmethod
    def blocks(cues: list[int], n_words: int, reach: int) -> list[tuple[int, int]]:
        """The candidate blocks around the words ``cues``, as ranges of words."""
        out: list[list[int]] = []
        for at in cues:
            a, b = max(0, at - reach), min(n_words, at + reach + 1)
            if out and a <= out[-1][1]:
                out[-1][1] = b
            else:
                out.append([a, b])
        return [(a, b) for a, b in out]

    def differences(self, template: list[str], block: list[str]) -> tuple[list[str], int, int, int]:
        """Words of the template that the block lacks, the number of words put between its
        others, and the range of the block from the first of these to the last."""
        pieces = [m for m in SequenceMatcher(None, template, block, autojunk=False)
                  .get_matching_blocks() if m.size]
        there = {i for m in pieces for i in range(m.a, m.a + m.size)}
        lacking = [w for i, w in enumerate(template) if i not in there]
        between = sum(y.b - (x.b + x.size) for x, y in zip(pieces, pieces[1:]))
        return (lacking, between, *((pieces[0].b, pieces[-1].b + pieces[-1].size) if pieces else (0, 0)))

    def occurrences(self, index: int, words: list[str], matcher: SequenceMatcher) -> Iterator[tuple]:
        """(missing, added, first word, end) wherever the wording of a template holds in
        ``words``, which ``matcher`` has as its second sequence."""
        wording = self.templates[index][1]
        n, t = len(wording), self.allowed(wording)
        least = -((t - n) // (2 * t + 1))  # so long is the longest of the pieces left by t and t words
        matcher.set_seq1(wording)
        todo = [(0, len(words))]
        while todo:
            lo, hi = todo.pop()
            m = matcher.find_longest_match(0, n, lo, hi)
            if m.size < least:
                continue
            todo += [(m.b + m.size, hi), (lo, m.b)]
            first = max(0, m.b - m.a - t)
            lacking, added, a, b = self.differences(wording, words[first:m.b + n - m.a + t])
            if max(len(lacking), added) <= t and not any(
                    w in self.apart[index] or any(c.isdigit() for c in w) for w in lacking):
                yield len(lacking), added, first + a, first + b

    def saved(self, data: bytes, index: int, plain: int | None = None) -> int:
        """Bytes by which the template as a dictionary shortens the compressed ``data``."""
        plain = len(self.alone.compress(data)) if plain is None else plain
        return plain - len(self.templates[index][2].compress(data))

    def winners(self, words: list[str], reach: int) -> list[tuple[int, float, int]]:
        """(bytes saved, size reduction, template index) of the templates that save enough."""
        data = self.spaced(words)
        plain = len(self.alone.compress(data))
        found = []
        for i in self.by_reach[reach]:
            saved = self.saved(data, i, plain)
            if saved >= self.margin * self.worth[i]:
                found.append((saved, saved / plain, i))
        return found

    def matches(self, text: str) -> tuple[int, list[dict]]:
        """Number of candidate blocks, and the confirmed occurrences."""
        if not CUE.search(text):
            return 0, []
        spans = [m.span() for m in WORD.finditer(text)]
        words = [text[a:b].lower() for a, b in spans]
        starts = [a for a, _ in spans]
        cues = [max(0, bisect_right(starts, m.start()) - 1) for m in CUE.finditer(text)]
        ranked = []
        for reach in self.by_reach:
            for start, stop in self.blocks(cues, len(words), reach):
                for at in range(start, max(start + 1, stop - reach), reach):
                    end = min(stop, at + 2 * reach)
                    ranked += [(-saved, i, at, end, reduction)
                               for saved, reduction, i in self.winners(words[at:end], reach)]
        taken: list[tuple[int, int]] = []  # of words, in order; they do not overlap
        out = []
        for _, i, at, end, reduction in sorted(ranked):
            name, wording, _ = self.templates[i]
            most = len(wording) + self.allowed(wording)
            at = max(0, at - most)  # an occurrence across the edge of the piece is seen whole
            piece = words[at:end + most]
            if len(set(wording).difference(piece)) > self.allowed(wording):
                continue
            for missing, added, a, b in self.occurrences(i, piece, SequenceMatcher(None, (), piece, autojunk=False)):
                a, b = at + a, at + b
                k = bisect_right(taken, (a, b))
                if k and taken[k - 1][1] > a or k < len(taken) and taken[k][0] < b:
                    continue
                taken.insert(k, (a, b))
                out.append({"start": spans[a][0], "end": spans[b - 1][1], "license": name,
                            "reduction": round(reduction, 6), "missing": missing, "added": added})
        n_blocks = len(self.blocks(cues, len(words), max(self.by_reach)))
        return n_blocks, sorted(out, key=lambda m: (m["start"], m["end"]))


MATCHES = T.ArrayType(T.StructType([
    T.StructField("start", T.IntegerType()), T.StructField("end", T.IntegerType()),
    T.StructField("license", T.StringType()), T.StructField("reduction", T.DoubleType()),
    T.StructField("missing", T.IntegerType()), T.StructField("added", T.IntegerType())]))


def scanned(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
            templates: dict[str, tuple[str, ...]] = TEMPLATES) -> DataFrame:
    """id, n_blocks and matches array<struct<start, end, license, reduction, missing, added>>."""
    ship_package(docs.sparkSession)
    out = T.StructType([T.StructField(id_col, docs.schema[id_col].dataType),
                        T.StructField("n_blocks", T.LongType()), T.StructField("matches", MATCHES)])
    kind = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32()), ("license", pa.string()),
                               ("reduction", pa.float64()), ("missing", pa.int32()), ("added", pa.int32())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scanner = LicenseScanner(templates)
        for batch in batches:
            found = [scanner.matches(t or "") for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array([n for n, _ in found], pa.int64()),
                 pa.array([m for _, m in found], kind)], names=out.names)

    return docs.select(of(docs, id_col), of(docs, text_col)).mapInArrow(run, out)
