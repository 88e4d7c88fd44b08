"""Licence scan by conditional compression.

Texts with a licence cue are cut into blocks around their cues, and long blocks into overlapping pieces of
a few template lengths. A piece is compressed alone and once with each template as a zstandard raw
dictionary; the bytes saved, as a share of what the template itself compresses to, rank the templates.
Ranked templates are confirmed by aligning their words with the piece's: only a wording with few
differences is reported, and the differences with it.
"""

from __future__ import annotations

import re
from bisect import bisect_left
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import text_or_empty

#: Production parameters: saved share that makes a template a candidate; different words allowed, as a share.
MIN_SAVED = 0.2
MAX_DIFFERENT = 0.1
LEVEL = 3

# Notice wordings of well-known licences, by SPDX identifier.
TEMPLATES = [
    ("MIT", "Released under the MIT License."),
    ("MIT", "Licensed under the MIT License."),
    ("MIT", """Permission is hereby granted, free of charge, to any person obtaining a copy of this software and
        associated documentation files (the "Software"), to deal in the Software without restriction, including
        without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell
        copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the
        following conditions:"""),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", """Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except
        in compliance with the License. You may obtain a copy of the License at"""),
    ("GPL-3.0-only", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-3.0-or-later", """This program is free software: you can redistribute it and/or modify it under the terms of
        the GNU General Public License as published by the Free Software Foundation, either version 3 of the License,
        or (at your option) any later version."""),
    ("MPL-2.0", """This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of
        the MPL was not distributed with this file, You can obtain one at"""),
    ("LicenseRef-BSD-family", """Redistribution and use in source and binary forms, with or without modification, are
        permitted provided that the following conditions are met:"""),
    ("CC-BY-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC0-1.0", "Dedicated to the public domain under CC0 1.0."),
    ("LicenseRef-All-Rights-Reserved", "All rights reserved."),
]

_GNU = [("GPL", "GNU General Public License", ("1.0", "2.0", "3.0")), ("LGPL", "GNU Lesser General Public License", ("2.1", "3.0")),
        ("LGPL", "GNU Library General Public License", ("2.0",)), ("AGPL", "GNU Affero General Public License", ("3.0",))]
for _id, _name, _versions in _GNU:
    for _v in _versions:
        _either = [f"version {_v.removesuffix('.0')}"] + [f"version {_v}"] * _v.endswith(".0")
        for _version in _either:
            TEMPLATES += [
                (f"{_id}-{_v}-only", f"This work is licensed under the {_name}, {_version}."),
                (f"{_id}-{_v}-or-later", f"This work is licensed under the {_name}, {_version} or later."),
                (f"{_id}-{_v}-or-later", f"This work is licensed under the {_name}, {_version} or any later version."),
                (f"{_id}-{_v}-or-later", f"This work is licensed under the {_name}, {_version} or (at your option) any later version."),
                (f"{_id}-{_v}-or-later", f"""you can redistribute it and/or modify it under the terms of the {_name} as published by
                    the Free Software Foundation, either {_version} of the License, or (at your option) any later version."""),
                (f"{_id}-{_v}-only", f"""you can redistribute it and/or modify it under the terms of the {_name} as published by
                    the Free Software Foundation, {_version} of the License."""),
                (f"{_id}-{_v}-only", f"""you can redistribute it and/or modify it under the terms of the {_name}, {_version},
                    as published by the Free Software Foundation.""")]
_BY = [("BY", "Attribution"), ("BY-SA", "Attribution-ShareAlike"), ("BY-NC", "Attribution-NonCommercial"),
       ("BY-NC-SA", "Attribution-NonCommercial-ShareAlike"), ("BY-ND", "Attribution-NoDerivatives"),
       ("BY-NC-ND", "Attribution-NonCommercial-NoDerivatives"), ("BY-ND", "Attribution-NoDerivs"),
       ("BY-NC-ND", "Attribution-NonCommercial-NoDerivs")]
for _id, _name in _BY:
    for _v, _port in (("4.0", "International"), ("3.0", "Unported"), ("2.5", "Generic"), ("2.0", "Generic")):
        TEMPLATES += [(f"CC-{_id}-{_v}", f"This work is licensed under a Creative Commons {_name} {_v} {_port} License."),
                      (f"CC-{_id}-{_v}", f"Licensed under CC {_id} {_v}.")]
_SOURCE = """Redistribution and use in source and binary forms, with or without modification, are permitted provided that
    the following conditions are met: 1. Redistributions of source code must retain the above copyright notice, this list of
    conditions and the following disclaimer. 2. Redistributions in binary form must reproduce the above copyright notice, this
    list of conditions and the following disclaimer in the documentation and/or other materials provided with the
    distribution. """
_ENDORSE = """Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote
    products derived from this software without specific prior written permission."""
TEMPLATES += [
    ("BSD-2-Clause", _SOURCE + "THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS"),
    ("BSD-3-Clause", _SOURCE + "3. " + _ENDORSE),
    ("BSD-4-Clause", _SOURCE + """3. All advertising materials mentioning features or use of this software must display the
        following acknowledgement: This product includes software developed by the organization. 4. """ + _ENDORSE),
    ("EPL-2.0", """This program and the accompanying materials are made available under the terms of the Eclipse Public
        License 2.0"""),
    ("EPL-1.0", """This program and the accompanying materials are made available under the terms of the Eclipse Public
        License v1.0"""),
    ("MPL-1.1", """The contents of this file are subject to the Mozilla Public License Version 1.1 (the "License"); you may
        not use this file except in compliance with the License."""),
    ("BSL-1.0", "Distributed under the Boost Software License, Version 1.0."),
    ("ISC", """Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is
        hereby granted, provided that the above copyright notice and this permission notice appear in all copies."""),
    ("Unlicense", "This is free and unencumbered software released into the public domain."),
]
TEMPLATES = list(dict.fromkeys((_id, " ".join(_text.split())) for _id, _text in TEMPLATES))

#: Words that tell licences apart, besides versions: no difference in them is allowed.
DISTINGUISHING = frozenset("""lesser library affero general gnu mozilla apache eclipse boost mit bsd isc cc by sa nc nd
    attribution sharealike share alike noncommercial commercial noderivatives noderivs derivatives derivs only later
    endorse advertising contributors international unported generic""".split())
CUES = (r"(?i)licen[cs]e|rights\s+reserved|permission\s+is\s+hereby|creative\s+commons|public\s+domain"
        r"|permission\s+to\s+use"
        r"|free\s+software|redistribution\s+and\s+use")

_FOUND = {"start": "int", "end": "int", "license": "string", "template": "int", "saved_bytes": "int",
          "saved_share": "double", "differences": "array<string>", "exact": "boolean"}
_WORD = re.compile(r"\w+(?:[.\-]\w+)*")


def _compressor(raw: bytes = b"") -> zstandard.ZstdCompressor:
    options = {"level": LEVEL, "write_checksum": False, "write_content_size": False, "write_dict_id": False}
    if raw:
        options["dict_data"] = zstandard.ZstdCompressionDict(raw, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
    return zstandard.ZstdCompressor(**options)


class Template:
    def __init__(self, license_id: str, text: str):
        self.license, self.text = license_id, " ".join(text.split())
        self.words = [w.lower() for w in _WORD.findall(self.text)]
        self.rare = sorted(set(self.words), key=lambda w: (-len(w), w))
        raw = self.text.lower().encode()
        self.compressor = _compressor(raw)
        self.own_bytes = len(_compressor().compress(raw)) - len(_compressor().compress(b""))


    def lacks(self, lower: str, most: int) -> bool:
        """Whether more than ``most`` of the template's words are not in the text: no match is that near then."""
        missing = 0
        for word in self.rare:
            if word not in lower:
                missing += 1
                if missing > most:
                    return True
        return False


@lru_cache(maxsize=4)
def _templates(pairs: tuple[tuple[str, str], ...]) -> list[Template]:
    return [Template(*p) for p in pairs]


def blocks(text: str, reach: int) -> Iterator[tuple[int, int]]:
    """Spans of ``text`` around its cues, ``reach`` characters to either side; overlapping ones are one."""
    start = end = -1
    for cue in re.finditer(CUES, text):
        if end < 0 or cue.start() - reach > end:
            if end >= 0:
                yield start, end
            start = max(0, cue.start() - reach)
        end = min(len(text), cue.end() + reach)
    if end >= 0:
        yield start, end


def pieces(text: str, reach: int) -> Iterator[tuple[int, int, int, int]]:
    """The blocks of ``text``, long ones as pieces of six reaches that overlap by half: start and end of the piece and
    of its block. A wording of up to two reaches stands whole in a piece, half a reach from its cut ends."""
    for start, end in blocks(text, reach):
        at = start
        while end - at > 6 * reach:
            yield at, at + 6 * reach, start, end
            at += 3 * reach
        yield at, end, start, end


def tells_apart(difference: str) -> bool:
    """Whether a difference is in a version or in another word that tells licences apart."""
    for word in (x[1:] for x in difference.split(" ")):
        if any(c.isdigit() for c in word) or not DISTINGUISHING.isdisjoint(word.split("-")):
            return True
    return False


def align(template: list[str], block: list[str]) -> tuple[int, int, list[str]]:
    """The words first to last (exclusive) of ``block`` nearest to ``template``, and their differences.

    Fewest words changed, missing (-) or extra (+); of equal matches the first that ends earliest.
    """
    codes: dict[str, int] = {}
    t = np.array([codes.setdefault(w, len(codes)) for w in template])
    b = np.array([codes.setdefault(w, len(codes)) for w in block], np.int64)
    steps = np.arange(len(b) + 1)
    costs = np.zeros((len(t) + 1, len(b) + 1), np.int32)
    for i, word in enumerate(t, 1):
        row = np.minimum(costs[i - 1] + 1, np.concatenate([[i], costs[i - 1, :-1] + (b != word)]))
        costs[i] = np.minimum.accumulate(row - steps) + steps
    j = last = int(costs[-1].argmin())
    i, differences = len(t), []
    while i:
        if j and costs[i, j] == costs[i - 1, j - 1] + (t[i - 1] != b[j - 1]):
            i, j = i - 1, j - 1
            if t[i] != b[j]:
                differences.append(f"-{template[i]} +{block[j]}")
        elif costs[i, j] == costs[i - 1, j] + 1:
            i -= 1
            differences.append(f"-{template[i]}")
        else:
            j -= 1
            differences.append(f"+{block[j]}")
    return j, last, differences[::-1]


def notices(text: str, templates: list[Template], min_saved: float = MIN_SAVED,
            max_different: float = MAX_DIFFERENT) -> list[tuple]:
    """The notices in ``text``, in its order: start, end, licence, template number, bytes saved and their share
    of the template, differences, exact."""
    plain = _compressor()
    ranked = []
    alone: dict[tuple[int, int], int] = {}
    whole = text.lower()
    for i, template in enumerate(templates):  # a block is as wide as the template can stand around a cue
        most = int(max_different * len(template.words))
        if template.lacks(whole, most):
            continue
        for start, end, *block in pieces(text, len(template.text) + 8):
            lower = text[start:end].lower()
            if template.lacks(lower, most):
                continue
            raw = lower.encode()
            if (start, end) not in alone:
                alone[start, end] = len(plain.compress(raw))
            saved = alone[start, end] - len(template.compressor.compress(raw))
            # The frame of a short piece can cost more than a short wording saves: with all its words there, it is aligned.
            if saved >= min_saved * template.own_bytes or all(w in lower for w in template.words):
                ranked.append((-saved, i, start, end, block))
    found: list[tuple] = []
    starts: list[int] = []
    for less, i, start, end, block in sorted(ranked):
        template = templates[i]
        most = int(max_different * len(template.words))
        words = [(m.group().lower(), m.start(), m.end()) for m in _WORD.finditer(text, start, end)]
        left = [w for w, _, _ in words]
        low = most + 1 if start > block[0] else 0  # a wording that a cut end may have changed is whole in the next piece
        high = len(words) - (most + 1 if end < block[1] else 0)
        while True:  # every place of the piece where the wording stands
            first, last, differences = align(template.words, left)
            if last == first or len(differences) > max_different * len(template.words):
                break
            left[first:last] = ["\0"] * (last - first)
            if differences and (first < low or last > high) or any(map(tells_apart, differences)):
                continue
            place = words[first][1], words[last - 1][2]
            at = bisect_left(starts, place[1])  # what is found doesn't overlap
            if not at or found[at - 1][1] <= place[0]:
                starts.insert(at, place[0])
                found.insert(at, (*place, template.license, i, -less, round(-less / template.own_bytes, 6),
                                  differences, not differences))
    return found


def license_scan(docs: DataFrame, templates: list[tuple[str, str]] = TEMPLATES) -> DataFrame:
    """One row per notice found in ``docs`` (doc_id, text): doc_id and the columns of _FOUND.

    start and end are character positions in the whole text. Where wordings overlap, the one that
    saves more bytes is reported, and of equal ones the earlier template. Texts without a notice, null
    and empty texts give no row; repeated rows give their notices each; other columns are not read.
    """
    pairs = tuple(tuple(p) for p in templates)

    @F.pandas_udf("array<struct<" + ",".join(f"{k}:{v}" for k, v in _FOUND.items()) + ">>")
    def scan(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in batches:
            yield texts.map(lambda x: [dict(zip(_FOUND, f, strict=True)) for f in notices(x, _templates(pairs))])

    cued = docs.select("doc_id", text_or_empty().alias("text")).filter(F.col("text").rlike(CUES))
    return cued.select("doc_id", F.inline(scan("text")))
