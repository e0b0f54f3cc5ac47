"""License scans by conditional compression.

A block of a text is a line with a word of licensing in it, or of a long line what is near that word. Each block is compressed alone and with every template as a raw Zstandard dictionary; templates are
ranked by the share of the block's bytes that they save. The winner is confirmed by its wording: in an
alignment of words, the template's words must be found in the block in order, but for a share
of differences, and the words that differ are reported.

Defined results: NULL and empty texts, and texts without a candidate line, give no row; equal rankings go to the first
template by name; repeated rows repeat their blocks; rows without an id give rows without an id; other columns are
not looked at.
"""

from __future__ import annotations

import difflib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wardloom.llm.common import table

# Short forms by which texts and files declare a licence.
TEMPLATES = {
    "apache-2.0": "Licensed under the Apache License, Version 2.0.",
    "apache-2.0-notice": (
        'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the License. '
        "You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in "
        'writing, software distributed under the License is distributed on an "AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, '
        "either express or implied. See the License for the specific language governing permissions and limitations under the License."
    ),
    "bsd-3-clause": "Use of this source code is governed by a BSD-style license that can be found in the LICENSE file.",
    "cc-by-4.0": "Licensed under CC BY 4.0.",
    "cc-by-sa-4.0": "Licensed under CC BY-SA 4.0.",
    "cc-by-nc-4.0": "Licensed under CC BY-NC 4.0.",
    "cc0-1.0": "To the extent possible under law, the author has waived all copyright and related or neighboring rights to this work.",
    "gpl-2.0": "This work is licensed under the GNU General Public License, version 2.",
    "gpl-3.0": "This work is licensed under the GNU General Public License, version 3.",
    "gpl-3.0-notice": (
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published "
        "by the Free Software Foundation, either version 3 of the License, or (at your option) any later version."
    ),
    "lgpl-3.0": "This work is licensed under the GNU Lesser General Public License, version 3.",
    "mit": "Released under the MIT License.",
    "mit-permission": (
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the "
        '"Software"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, '
        "distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to "
        "the following conditions:"
    ),
    "mpl-2.0": "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
}
CUE = r"(?i)licen[sc]e|copyright|permission is hereby granted|spdx-|waived all|public domain|free software"

LEVEL = 19
WORD_CHARS = 12  # room for a word of a template
MAX_DIFFERENCES = 0.1  # share of the template's words that may be missing or replaced
CODE_DIGITS = re.compile(r"\d")


def spoken(text: str) -> list[str]:
    """Words as compared: lower case, joined signs kept within a word only."""
    return re.findall(r"[a-z0-9]+(?:[-.:/][a-z0-9]+)*", text.lower())


def _compressor(template: str | None) -> zstandard.ZstdCompressor:
    plain = {"write_checksum": False, "write_content_size": False, "write_dict_id": False}
    if template is None:
        return zstandard.ZstdCompressor(level=LEVEL, **plain)
    held = zstandard.ZstdCompressionDict(template.encode(), dict_type=zstandard.DICT_TYPE_RAWCONTENT)
    held.precompute_compress(level=LEVEL)
    return zstandard.ZstdCompressor(level=LEVEL, dict_data=held, **plain)


def differences(template: list[str], block: list[str]) -> tuple[int, list[str]]:
    """Template words not met in order in ``block``, and what differs, as ``-missing`` and ``+instead``.

    Text before the first and after the last shared word is not part of the notice.
    """
    ops = difflib.SequenceMatcher(None, template, block, autojunk=False).get_opcodes()
    if ops and ops[0][0] == "insert":
        ops = ops[1:]
    if ops and ops[-1][0] == "insert":
        ops = ops[:-1]
    missing = sum(b - a for kind, a, b, _, _ in ops if kind != "equal")
    missing += sum(d - c for kind, _, _, c, d in ops if kind == "insert")
    words = [f"-{w}" for kind, a, b, _, _ in ops if kind != "equal" for w in template[a:b]]
    words += [f"+{w}" for k, (kind, _, _, c, d) in enumerate(ops) if kind != "equal" and 0 < k < len(ops) - 1 for w in block[c:d]]
    return missing, words


class Scanner:
    def __init__(self, templates: dict[str, str]):
        self.names = sorted(templates)
        self._words = {k: spoken(v) for k, v in templates.items()}
        self._alone = _compressor(None)
        self._given = {k: _compressor(" ".join(self._words[k])) for k in self.names}

    def rank(self, block: str) -> list[tuple[float, str]]:
        """Share of bytes each template saves, best first."""
        body = " ".join(spoken(block)).encode()
        alone = len(self._alone.compress(body))
        saved = [((alone - len(self._given[k].compress(body))) / max(1, alone), k) for k in self.names]
        return sorted(saved, key=lambda x: (-x[0], x[1]))

    def confirm(self, name: str, block: str) -> tuple[bool, list[str]]:
        """Whether the wording is the template's. Digits and short names decide between licences, so none of them may differ."""
        n, words = differences(self._words[name], spoken(block))
        telling = any(CODE_DIGITS.search(w) or len(w) <= 4 and w[0] == "-" for w in words)
        return n <= MAX_DIFFERENCES * len(self._words[name]) and not telling, words

    def best(self, block: str) -> tuple[str, float, bool, list[str]]:
        """The first template of the ranking that the wording confirms, else the first of all.

        Templates that save as much as the winner within a tenth are looked at too: a notice and its
        short form explain nearly the same bytes.
        """
        ranked = self.rank(block)
        for saving, name in ranked:
            if saving < ranked[0][0] - 0.1:
                break
            sure, words = self.confirm(name, block)
            if sure:
                return name, saving, True, words
        saving, name = ranked[0]
        return name, saving, False, self.confirm(name, block)[1]


def candidate_blocks(text: str, cue: re.Pattern, longest: int) -> Iterator[tuple[int, int]]:
    """Spans around cues that do not overlap: from the start of the cue's line to its end.

    Of a long line only the words around the cue count, as many as the longest template has on
    either side, so a whole text in one line costs no more than its cues.
    """
    covered = 0
    for hit in cue.finditer(text):
        if hit.start() < covered:
            continue
        left = max(covered, text.rfind("\n", 0, hit.start()) + 1, hit.start() - longest * WORD_CHARS)
        line_end = text.find("\n", hit.end())
        right = min(len(text) if line_end < 0 else line_end, hit.end() + longest * WORD_CHARS)
        yield left, right
        covered = right


def scan_licenses(docs: DataFrame, templates: dict[str, str] | None = None, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``(key, block_start, block_end, license, saved_share, confirmed, differing_words)`` of every candidate block.

    Starts and ends count characters of the text.
    """
    templates = templates or TEMPLATES
    kind = docs.schema[key].dataType.simpleString()
    longest = max(len(spoken(v)) for v in templates.values())
    source = docs.filter(F.col(text).rlike(CUE)).select(F.col(key).alias(key), F.col(text).alias("_ls_text"))

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scanner, cue = Scanner(templates), re.compile(CUE)
        seen: dict[str, tuple[str, float, bool, list[str]]] = {}
        for batch in batches:
            at, rows = [], []
            for i, body in enumerate(batch.column(1).to_pylist()):
                for begin, end in candidate_blocks(body, cue, longest):
                    block = body[begin:end]
                    found = seen.get(block)
                    if found is None:
                        if len(seen) > 10_000:
                            seen.clear()
                        found = seen[block] = scanner.best(block)
                    at.append(i)
                    rows.append((begin, end, *found))
            columns = [list(c) for c in zip(*rows, strict=True)] if rows else [[] for _ in range(6)]
            kinds = (pa.int64(), pa.int64(), pa.string(), pa.float64(), pa.bool_(), pa.list_(pa.string()))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(pa.array(np.array(at, np.int64))), *(pa.array(c, t) for c, t in zip(columns, kinds, strict=True))],
                names=[key, "block_start", "block_end", "license", "saved_share", "confirmed", "differing_words"],
            )

    return source.mapInArrow(scan, f"`{key}` {kind}, block_start long, block_end long, license string, saved_share double, confirmed boolean, differing_words array<string>")


def license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Query: every candidate block of every document with its licence."""
    return scan_licenses(table(spark, sf_dir, "documents"))
