"""License scan by conditional compression.

Candidate blocks are runs of lines around license words. In each, windows about as long as a template are cut around its
rarest key word and aligned with it; the aligned stretch is compressed alone and with the template as raw dictionary of
the compressor. A license is confirmed by the relative size reduction of that stretch and by the exact wording: the
differing words are listed, the key words must all stand in it and enough of the template must. So text before and
after a statement does not count. Where no window confirms any license the whole block is tried in the same way.
"""

from __future__ import annotations

import difflib
import re
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

CUES = r"(?i)licen[cs]e|copyright|permission is hereby|redistribut|warrant|spdx|public domain|creative commons|copyleft|all rights reserved|\bCC[ -]BY|\bCC0"
GAP = 2
RANKED, LEAST_REDUCTION, LEAST_SHARE = 4, 0.25, 0.75

# Wording of public licenses and of the statements that refer to them, with the words that tell them apart.
TEMPLATES: list[tuple[str, str, str]] = [
    ("MIT", "released under the MIT License", "mit license"),
    ("MIT", "licensed under the MIT License", "mit license"),
    ("MIT", "SPDX-License-Identifier: MIT", "spdx mit"),
    (
        "MIT",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal in the Software without restriction,"
        " including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so,"
        " subject to the following conditions: The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.",
        "permission sublicense furnished",
    ),
    ("Apache-2.0", "licensed under the Apache License, Version 2.0", "apache 2.0"),
    ("Apache-2.0", "SPDX-License-Identifier: Apache-2.0", "spdx apache 2.0"),
    (
        "Apache-2.0",
        "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License. You may obtain a copy of the License at"
        " http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an \"AS IS\" BASIS,"
        " WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied.",
        "apache 2.0 compliance",
    ),
    ("GPL-3.0", "this work is licensed under the GNU General Public License, version 3", "gnu general public 3"),
    ("GPL-3.0", "SPDX-License-Identifier: GPL-3.0-or-later", "spdx gpl 3.0"),
    (
        "GPL-3.0",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License,"
        " or (at your option) any later version.",
        "gnu general public 3 redistribute",
    ),
    ("GPL-2.0", "this work is licensed under the GNU General Public License, version 2", "gnu general public 2"),
    ("GPL-2.0", "SPDX-License-Identifier: GPL-2.0-only", "spdx gpl 2.0"),
    (
        "GPL-2.0",
        "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation; either version 2 of the License,"
        " or (at your option) any later version.",
        "gnu general public 2 redistribute",
    ),
    ("LGPL-3.0", "licensed under the GNU Lesser General Public License, version 3", "gnu lesser public 3"),
    ("LGPL-2.1", "licensed under the GNU Lesser General Public License, version 2.1", "gnu lesser public 2.1"),
    ("AGPL-3.0", "licensed under the GNU Affero General Public License, version 3", "gnu affero public 3"),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.", "mozilla public 2.0"),
    ("BSD-3-Clause", "licensed under the BSD 3-Clause License", "bsd 3 clause"),
    ("BSD-2-Clause", "licensed under the BSD 2-Clause License", "bsd 2 clause"),
    (
        "BSD-2-Clause",
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met: Redistributions of source code must retain the above copyright notice,"
        " this list of conditions and the following disclaimer. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation"
        " and/or other materials provided with the distribution.",
        "redistribution retain reproduce",
    ),
    (
        "BSD-3-Clause",
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met: Redistributions of source code must retain the above copyright notice,"
        " this list of conditions and the following disclaimer. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation"
        " and/or other materials provided with the distribution. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software"
        " without specific prior written permission.",
        "redistribution retain reproduce neither endorse",
    ),
    (
        "ISC",
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies.",
        "permission fee copies",
    ),
    ("CC-BY-4.0", "licensed under CC BY 4.0", "cc by 4.0"),
    ("CC-BY-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License", "creative commons attribution 4.0"),
    ("CC-BY-SA-4.0", "licensed under CC BY-SA 4.0", "cc by sa 4.0"),
    ("CC-BY-SA-4.0", "licensed under a Creative Commons Attribution-ShareAlike 4.0 International License", "creative commons sharealike 4.0"),
    ("CC-BY-NC-4.0", "licensed under CC BY-NC 4.0", "cc by nc 4.0"),
    ("CC-BY-NC-4.0", "licensed under a Creative Commons Attribution-NonCommercial 4.0 International License", "creative commons noncommercial 4.0"),
    ("CC-BY-NC-SA-4.0", "licensed under CC BY-NC-SA 4.0", "cc by nc sa 4.0"),
    ("CC-BY-ND-4.0", "licensed under CC BY-ND 4.0", "cc by nd 4.0"),
    ("CC0-1.0", "released under CC0 1.0 Universal, dedicated to the public domain", "cc0"),
    ("Unlicense", "This is free and unencumbered software released into the public domain.", "unencumbered public domain"),
    ("Proprietary", "Copyright. All rights reserved.", "all rights reserved"),
]

_WORD = re.compile(r"[a-z0-9]+(?:\.[0-9]+)*")


#: Words a window has on either side beyond its template: half of it, this many at least.
SLACK = 4


def wording(text: str) -> list[str]:
    return _WORD.findall(text.lower())


@lru_cache(maxsize=1)
def _compressors():
    import zstandard

    plain = zstandard.ZstdCompressor(level=3, write_content_size=False, write_checksum=False, write_dict_id=False)
    with_template = []
    for name, text, keys in TEMPLATES:
        content = f" {text} {text.lower()} ".encode()
        dictionary = zstandard.ZstdCompressionDict(content, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
        own = zstandard.ZstdCompressor(level=3, dict_data=dictionary, write_content_size=False, write_checksum=False, write_dict_id=False)
        with_template.append((name, own, wording(text), set(wording(keys))))
    return plain, with_template


def _compared(wanted: list[str], words: list[str]) -> tuple[list[tuple[int, int]], list[str], list[str]]:
    """(spans of matched words, template words missing, words added) of a template's words and others."""
    spans, missing, added = [], [], []
    for kind, a, b, c, d in difflib.SequenceMatcher(None, wanted, words, autojunk=False).get_opcodes():
        if kind == "equal":
            spans.append((c, d))
        else:
            missing += wanted[a:b]
            added += words[c:d]
    return spans, missing, added


def _stretches(text: str) -> Iterator[tuple[tuple, tuple[int, int], str, float, str, str]]:
    """(strength, word span, license, reduction, missing, added) of the parts of a block that confirm a template."""
    plain, templates = _compressors()
    found = list(_WORD.finditer(text.lower()))
    words = [m.group() for m in found]
    places: dict[str, list[int]] = {}
    for i, w in enumerate(words):
        places.setdefault(w, []).append(i)
    # Lower-casing may change the length of other letters; spans are then taken in the lower-case text.
    shown = text if len(text.lower()) == len(text) else text.lower()
    for name, own, wanted, keys in templates:
        if not all(k in places for k in keys):
            continue
        rare = min(sorted(keys), key=lambda k: len(places[k]))
        own_places = [i for i, w in enumerate(wanted) if w == rare]
        slack, done = max(SLACK, len(wanted) // 2), -1
        for p in places[rare]:
            if p < done:
                continue
            low, high = max(0, p - own_places[-1] - slack), p + len(wanted) - own_places[0] + slack
            if not keys <= set(words[low:high]):
                continue
            spans, missing, _ = _compared(wanted, words[low:high])
            if not spans or sum(d - c for c, d in spans) < LEAST_SHARE * len(wanted):
                continue
            first, last = low + spans[0][0], low + spans[-1][1]
            stretch = words[first:last]
            if not keys <= set(stretch):
                continue
            data = shown[found[first].start() : found[last - 1].end()].encode()
            reduction = 1 - len(own.compress(data)) / len(plain.compress(data))
            if reduction < LEAST_REDUCTION:
                continue
            spans, missing, added = _compared(wanted, stretch)
            done = last
            yield (not missing, sum(d - c for c, d in spans), reduction), (first, last), name, reduction, " ".join(missing), " ".join(added)


@lru_cache(maxsize=4096)
def scan_licenses_of(text: str) -> list[tuple[str | None, float, int, str, str]]:
    """(license, reduction, words of the block, template words it lacks, words it adds) of the licenses that one block confirms.

    Licenses stand on disjoint words and come best first, each once. Without any there is one row of no license.
    """
    taken, chosen, size = [], {}, len(wording(text))
    for _, (first, last), name, reduction, missing, added in sorted(_stretches(text), key=lambda x: x[0], reverse=True):
        if not any(first < d and c < last for c, d in taken):
            if name not in chosen:
                chosen[name] = (name, reduction, size, missing, added)
            taken.append((first, last))
    return list(chosen.values()) or [_whole_block(text)]


def scan_block(text: str) -> tuple[str | None, float, int, str, str]:
    """The best of ``scan_licenses_of``."""
    return scan_licenses_of(text)[0]


def _whole_block(text: str) -> tuple[str | None, float, int, str, str]:
    """(license or None, best reduction, words of the block, template words it lacks, words it adds) of one block."""
    plain, templates = _compressors()
    data = text.encode()
    alone = len(plain.compress(data))
    words = wording(text)
    ranked = sorted(((1 - len(own.compress(data)) / alone, k) for k, (_, own, _, _) in enumerate(templates)), reverse=True)
    best = None
    for place, (reduction, k) in enumerate(ranked):
        name, _, wanted, keys = templates[k]
        if place >= RANKED and (best or reduction < LEAST_REDUCTION):
            break
        if reduction < LEAST_REDUCTION or not keys <= set(words):
            continue
        matcher = difflib.SequenceMatcher(None, wanted, words, autojunk=False)
        matched, missing, added = 0, [], []
        for kind, a, b, c, d in matcher.get_opcodes():
            if kind == "equal":
                matched += b - a
            else:
                missing += wanted[a:b]
                added += words[c:d]
        share = matched / len(wanted)
        if share >= LEAST_SHARE and (best is None or (len(missing) == 0, matched, reduction) > best[0]):
            best = ((len(missing) == 0, matched, reduction), name, reduction, " ".join(missing), " ".join(added))
    if best is None:
        return None, max(0.0, ranked[0][0]), len(words), "", ""
    return best[1], best[2], len(words), best[3], best[4]


def candidate_blocks(text: str, cues: re.Pattern) -> Iterator[tuple[int, str]]:
    """(first line, text) of runs of lines with license words, with up to GAP other lines between them."""
    lines = text.split("\n")
    marked = [i for i, line in enumerate(lines) if cues.search(line)]
    first = last = None
    for i in [*marked, None]:
        if first is not None and (i is None or i - last > GAP + 1):
            yield first, "\n".join(lines[first : last + 1])
            first = None
        if i is not None:
            first, last = (i if first is None else first), i


def _scanned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    cues = re.compile(CUES)
    names = ["doc_id", "line", "license", "reduction", "n_words", "missing_words", "added_words"]
    types = [pa.int64(), pa.int32(), pa.string(), pa.float64(), pa.int32(), pa.string(), pa.string()]
    for batch in batches:
        rows = []
        for doc, text in zip(batch.column("doc_id").to_pylist(), batch.column("text"), strict=True):
            for line, block in candidate_blocks(text.as_py(), cues):
                rows.extend((doc, line, *found) for found in scan_licenses_of(block))
        columns = list(zip(*rows, strict=True)) or [[] for _ in names]
        yield pa.record_batch([pa.array(c, t) for c, t in zip(columns, types, strict=True)], names)


def scan_licenses(docs: DataFrame) -> DataFrame:
    """One row per candidate block of ``docs`` (doc_id, text) and license confirmed in it, or one row if none is.

    line counts from 0; license is NULL if no template is confirmed; missing_words and added_words are the exact
    differences in wording. NULL and empty texts have no block; repeated rows and equal blocks give equal rows; ties go to
    the template with more matched words. No rows give no rows.
    """
    rows = docs.select("doc_id", "text").where(F.col("text").rlike(CUES))
    return rows.mapInArrow(_scanned, "doc_id long, line int, license string, reduction double, n_words int, missing_words string, added_words string")
