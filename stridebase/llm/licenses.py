"""License notices in documents, by conditional compression and word differences.

Lines that read like legal text form candidate blocks. For each template, a block is cut into windows about as
long as the template, around its rarest telling word, so that the length of a block does not count. A
window is compressed alone, and again with the template as raw zstandard dictionary. What a dictionary saves,
in bytes, ranks windows and templates; pairs that save less than a share of the template's own size are out.
Down that ranking, the words of the window are aligned with the template, and a place is confirmed if few words
and no telling one (name, version) differ and no earlier winner has taken its words.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stridebase.llm.words import rows_of

# Wordings of common notices. "..." stands for any words.
TEMPLATES = {
    "Apache-2.0/short": "Licensed under the Apache License, Version 2.0.",
    "Apache-2.0/header": (
        'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the '
        "License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable "
        'law or agreed to in writing, software distributed under the License is distributed on an "AS IS" BASIS, WITHOUT '
        "WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing "
        "permissions and limitations under the License."
    ),
    "MIT/short": "Released under the MIT License.",
    "MIT/text": (
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation "
        'files (the "Software"), to deal in the Software without restriction, including without limitation the rights to use, copy, '
        "modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the "
        "Software is furnished to do so, subject to the following conditions: The above copyright notice and this permission notice "
        "shall be included in all copies or substantial portions of the Software."
    ),
    "GPL-3.0/short": "This work is licensed under the GNU General Public License, version 3.",
    "GPL-2.0/short": "This work is licensed under the GNU General Public License, version 2.",
    "LGPL-3.0/short": "This work is licensed under the GNU Lesser General Public License, version 3.",
    "AGPL-3.0/short": "This work is licensed under the GNU Affero General Public License, version 3.",
    "GPL-3.0/header": (
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License "
        "as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version."
    ),
    "BSD-3-Clause/short": "Use of this source code is governed by a BSD-style license that can be found in the LICENSE file.",
    "ISC/text": (
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, "
        "provided that the above copyright notice and this permission notice appear in all copies."
    ),
    "MPL-2.0/header": (
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not "
        "distributed with this file, You can obtain one at http://mozilla.org/MPL/2.0/."
    ),
    "CC-BY-4.0/short": "Licensed under CC BY 4.0.",
    "CC-BY-SA-4.0/short": "Licensed under CC BY-SA 4.0.",
    "CC-BY-NC-4.0/short": "Licensed under CC BY-NC 4.0.",
    "CC-BY-ND-4.0/short": "Licensed under CC BY-ND 4.0.",
    "CC0-1.0/short": "Released into the public domain under CC0 1.0.",
    "all-rights-reserved/short": "All rights reserved.",
    "MIT/licensed": "Licensed under the MIT License.",
    "MIT/project": "This project is licensed under the MIT License.",
    "Apache-2.0/licensed": "Licensed under the Apache License 2.0.",
    "Apache-2.0/project": "This project is licensed under the Apache License 2.0.",
    "BSD-2-Clause/licensed": "Licensed under the BSD 2-Clause License.",
    "BSD-3-Clause/licensed": "Licensed under the BSD 3-Clause License.",
    "BSD-2-Clause/text": (
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following "
        "conditions are met: 1. Redistributions of source code must retain the above copyright notice, this list of conditions and "
        "the following disclaimer. 2. Redistributions in binary form must reproduce the above copyright notice, this list of "
        "conditions and the following disclaimer in the documentation and/or other materials provided with the distribution."
    ),
    "BSD-3-Clause/text": (
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following "
        "conditions are met: 1. Redistributions of source code must retain the above copyright notice, this list of conditions and "
        "the following disclaimer. 2. Redistributions in binary form must reproduce the above copyright notice, this list of "
        "conditions and the following disclaimer in the documentation and/or other materials provided with the distribution. "
        "3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products "
        "derived from this software without specific prior written permission."
    ),
    "GPL-2.0/header": (
        "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public License "
        "as published by the Free Software Foundation; either version 2 of the License, or (at your option) any later version."
    ),
    "Unlicense/text": "This is free and unencumbered software released into the public domain.",
    "Zlib/text": (
        "This software is provided 'as-is', without any express or implied warranty. In no event will the authors be held liable for "
        "any damages arising from the use of this software. Permission is granted to anyone to use this software for any purpose, "
        "including commercial applications, and to alter it and redistribute it freely, subject to the following restrictions"
    ),
    "BSL-1.0/short": "Distributed under the Boost Software License, Version 1.0.",
    "EPL-2.0/short": (
        "This program and the accompanying materials are made available under the terms of the Eclipse Public License 2.0"
    ),
}
# Identifiers in tags.
SPDX = (
    "0BSD Apache-2.0 AGPL-3.0-only AGPL-3.0-or-later BSD-2-Clause BSD-3-Clause BSL-1.0 CC0-1.0 CC-BY-4.0 CC-BY-SA-4.0 EPL-2.0 "
    "GPL-2.0-only GPL-2.0-or-later GPL-3.0-only GPL-3.0-or-later ISC LGPL-2.1-only LGPL-2.1-or-later LGPL-3.0-only "
    "LGPL-3.0-or-later MIT MPL-2.0 Unlicense Zlib"
).split()
TEMPLATES |= {f"{name}/tag": f"SPDX-License-Identifier: {name}" for name in SPDX}
# What a block must mention to be a candidate.
CUE = r"(?i)licen[cs]e|copyright|all rights reserved|public domain|permission (is hereby granted|to use)|redistribute"

# Words that tell nothing about a line.
FUNCTION_WORDS = frozenset(
    "a an and any are as at be been by can do for from has have if in into is it its may no not of on or other such that the their "
    "there these this to was were which will with you your".split()
)

LEAST_GAIN = 0.3  # of the template's own compressed size
MOST_DIFFERENT = 0.2  # of a template's words
NEVER = 1 << 20  # differences that no notice has
LEVEL = 9
_WORD = re.compile(r"[^\W_]+(?:[.\-][^\W_]+)*")
_COMMON = re.compile(r"^[a-z]+$")  # without digits or upper case


def words_of(text: str) -> list[str]:
    return [w.lower() for w in _WORD.findall(text)]


@dataclass(frozen=True)
class Template:
    name: str
    words: tuple[str, ...]
    telling: frozenset[str]
    compressor: zstandard.ZstdCompressor
    size: int  # compressed alone

    @property
    def license(self) -> str:
        return self.name.split("/")[0]


def _plain() -> dict:
    return {"write_content_size": False, "write_checksum": False, "write_dict_id": False}


def _alone(words: str) -> int:
    return len(zstandard.ZstdCompressor(level=LEVEL, **_plain()).compress(words.encode("utf-8", "replace")))


@lru_cache(maxsize=1)
def templates() -> tuple[Template, ...]:
    """Telling words of a template are those with a capital or a digit inside a sentence, and
    those that similar templates do not have."""
    out = []
    for name, text in TEMPLATES.items():
        words = _WORD.findall(text)
        telling = {w.lower() for w in words[1:] if not _COMMON.match(w)} | {w for w in words_of(text) if len(words) < 8 and w not in ("the", "under")}
        data = zstandard.ZstdCompressionDict(" ".join(words_of(text)).encode(), dict_type=zstandard.DICT_TYPE_RAWCONTENT)
        compressor = zstandard.ZstdCompressor(level=LEVEL, dict_data=data, **_plain())
        out.append(Template(name, tuple(words_of(text)), frozenset(telling), compressor, _alone(" ".join(words_of(text)))))
    return tuple(out)


@lru_cache(maxsize=1)
def vocabulary() -> frozenset[str]:
    return frozenset(w for t in templates() for w in t.words)


def candidate_blocks(text: str) -> list[tuple[int, int, str]]:
    """(first line, last line, block) of runs of lines whose words are mostly those of notices,
    with a cue in them. Blank lines, and lines of words that tell nothing, inside a run do not end it."""
    known, cue = vocabulary() - FUNCTION_WORDS, re.compile(CUE)
    blocks: list[list[tuple[int, str]]] = [[]]
    between: list[tuple[int, str]] = []
    for number, line in enumerate(text.split("\n")):
        words = words_of(line)
        telling = [w for w in words if w not in FUNCTION_WORDS]
        if (telling and 2 * sum(w in known for w in telling) >= len(telling)) or (words and cue.search(line)):
            blocks[-1] += [*between, (number, line)] if blocks[-1] else [(number, line)]
            between = []
        elif telling:
            between = []
            if blocks[-1]:
                blocks.append([])
        elif words:
            between.append((number, line))
    found = []
    for lines in blocks:
        block = "\n".join(line for _, line in lines)
        if lines and cue.search(block):
            found.append((lines[0][0], lines[-1][0], block))
    return found


def gains(words: str, by: tuple[Template, ...] | None = None) -> list[tuple[float, Template]]:
    """Relative size reductions by each template, best first."""
    alone = _alone(words)
    ranked = [(saving(words, t) / alone, t) for t in by or templates()]
    return sorted(ranked, key=lambda x: (-x[0], x[1].name))


@lru_cache(maxsize=1 << 14)
def _saving(words: str, template: str) -> int:
    compressor = next(t.compressor for t in templates() if t.name == template)
    return _alone(words) - len(compressor.compress(words.encode("utf-8", "replace")))


def saving(words: str, template: Template) -> int:
    """Bytes that the template saves as dictionary."""
    return _saving(words, template.name)


def windows(words: np.ndarray, template: Template) -> list[tuple[int, int]]:
    """First word and one past the last of the parts of a block that may hold the template.

    Every place that can be confirmed holds all telling words, or, where there are none, one at least of any more words
    than may be missing; so the parts around the rarest of these in the block hold all such places.
    """
    counts = Counter(words.tolist())
    most = MOST_DIFFERENT * len(template.words)
    if not template.telling <= counts.keys() or (Counter(template.words) - counts).total() > most:
        return []
    rarest = sorted(template.telling or set(template.words), key=lambda w: (counts[w], w))
    anchors = rarest[:1] if template.telling else rarest[: int(most) + 1]
    parts = set()
    for anchor in anchors:
        places = np.flatnonzero(words == anchor).tolist()
        # With at most so many words missing or added, the anchor is about as far from both ends as in the template.
        for k in (k for k, word in enumerate(template.words) if word == anchor):
            parts |= {(max(0, p - k - int(most)), min(len(words), p - k + len(template.words) + int(most))) for p in places}
    return sorted(parts)


@dataclass(frozen=True)
class Candidate:
    """A window and a template that saves enough of it."""

    saved: int
    template: Template
    first: int
    end: int

    @property
    def gain(self) -> float:
        return self.saved / self.template.size

    @property
    def rank(self) -> tuple:
        return -self.saved, self.template.name, self.first


def candidates(words: np.ndarray) -> list[Candidate]:
    """Pairs of a window and a template, by the bytes that the template saves."""
    found = [
        Candidate(saving(" ".join(words[first:end]), template), template, first, end)
        for template in templates()
        for first, end in windows(words, template)
    ]
    return sorted((c for c in found if c.gain >= LEAST_GAIN), key=lambda c: c.rank)


@dataclass(frozen=True)
class Notice:
    """Words of a block that agree with a template, and how the two differ there."""

    template: Template
    gain: float
    missing: tuple[str, ...]  # words of the template that the notice lacks
    added: tuple[str, ...]  # words inside the notice that the template lacks
    taken: tuple[int, ...]  # places of the words they share

    @property
    def differences(self) -> int:
        return len(self.missing) + len(self.added)


def _rows(words: np.ndarray, template: Template) -> Iterator[np.ndarray]:
    """After each word of the template, the fewest differences of the template so far from words that
    end at each place, wherever they begin. Telling words must not be missing."""
    place, row = np.arange(len(words) + 1), np.zeros(len(words) + 1, np.int64)
    same = {word: words == word for word in set(template.words)}
    yield row
    for word in template.words:
        best = row + (NEVER if word in template.telling else 1)
        best[1:] = np.minimum(best[1:], np.where(same[word], row[:-1], NEVER))
        row = np.minimum.accumulate(best - place) + place
        yield row


def _align(words: np.ndarray, template: Template, end: int, gain: float) -> Notice:
    """The words up to ``end`` that differ least from the template."""
    first = max(0, end - int((1 + MOST_DIFFERENT) * len(template.words)) - 1)
    near = words[first:end]
    rows = list(_rows(near, template))
    i, j = len(template.words), len(near)
    missing, added, taken = [], [], []
    while i:
        if j and near[j - 1] == template.words[i - 1] and rows[i][j] == rows[i - 1][j - 1]:
            i, j = i - 1, j - 1
            taken.append(first + j)
        elif j and rows[i][j] == rows[i][j - 1] + 1:
            j -= 1
            added.append(str(near[j]))
        else:
            i -= 1
            missing.append(template.words[i])
    return Notice(template, gain, *(tuple(x[::-1]) for x in (missing, added, taken)))


def notices_of(words: np.ndarray, template: Template, gain: float = 0.0) -> list[Notice]:
    """The places of a window that differ from the template in few words, none of them telling."""
    most = MOST_DIFFERENT * len(template.words)
    counts = Counter(words.tolist())
    if not template.telling <= counts.keys() or (Counter(template.words) - counts).total() > most:
        return []
    *_, fewest = _rows(words, template)
    ends = np.flatnonzero(fewest <= most)
    runs = np.split(ends, np.flatnonzero(np.diff(ends) > 1) + 1) if len(ends) else []
    return [_align(words, template, int(run[np.argmin(fewest[run])]), gain) for run in runs]


@lru_cache(maxsize=4096)
def identify(block: str) -> tuple[tuple[str, float, str, str], ...]:
    """(license, gain, missing words, added words) of the confirmed notices of a block.

    Candidates are tried in the order of what their template saves, and a word belongs to one notice; the rest
    is judged anew without these words, until nothing in it is confirmed.
    """
    confirmed, left = [], np.array(words_of(block), object)
    while len(left):
        stays = np.ones(len(left), bool)
        for c in candidates(left):
            if not stays[c.first : c.end].any():
                continue
            for notice in sorted(notices_of(left[c.first : c.end], c.template, c.gain), key=lambda n: (n.differences, n.taken)):
                places = [c.first + i for i in notice.taken]
                if stays[places].all():
                    stays[places] = False
                    confirmed.append((notice.template.license, notice.gain, " ".join(notice.missing), " ".join(notice.added)))
        if stays.all():
            break
        left = left[stays]
    return tuple(confirmed)


def scan_licenses(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """One row per confirmed notice: the id, ``first_line``, ``last_line`` (from 0) of its block, ``license``,
    ``gain`` (bytes saved by the template, over its own size), ``missing`` and ``added`` (words that differ from the template, else
    empty), and ``block``.

    Whole texts are scanned, and the length of a block does not matter. NULL and empty texts have no notice, and neither have blocks that no
    template explains. NULL ids are kept, repeated rows give repeated notices, an empty table gives no
    rows, other columns are not read. Ties between templates go to the name that sorts first.
    """
    schema = T.StructType(
        [
            T.StructField(id_column, docs.schema[id_column].dataType),
            *(T.StructField(n, T.IntegerType()) for n in ("first_line", "last_line")),
            T.StructField("license", T.StringType()),
            T.StructField("gain", T.DoubleType()),
            *(T.StructField(n, T.StringType()) for n in ("missing", "added", "block")),
        ]
    )

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start, texts in rows_of(batch, 1):
                found = [
                    (i, first, last, *notice, block)
                    for i, text in enumerate(texts, start)
                    for first, last, block in candidate_blocks(text)
                    for notice in identify(block)
                ]
                if found:
                    rows, *columns = zip(*found)
                    arrays = [pa.array(c, t) for c, t in zip(columns, (pa.int32(), pa.int32(), pa.string(), pa.float64(), *[pa.string()] * 3))]
                    yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(rows)), *arrays], names=schema.names)

    mentions = docs.select(id_column, text_column).where(F.col(text_column).rlike(CUE))
    return mentions.mapInArrow(scan, schema)
