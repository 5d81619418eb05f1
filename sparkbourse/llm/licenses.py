"""License notices in texts: MinHash bands over overlapping windows find templates, exact containment verifies them."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sparkbourse.llm.common import small_batches
from sparkbourse.llm.shingles import mix, shingle_hashes, slices, word_hashes

#: Short notices and the opening paragraphs of licenses. Fixed values.
TEMPLATES = (
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", 'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0'),
    ("Apache-2.0", 'Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an "AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied.'),
    ("MIT", "Released under the MIT License."),
    ("MIT", "Licensed under the MIT License."),
    ("MIT", 'Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the "Software"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software'),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-3.0", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version."),
    ("GPL-2.0", "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation; either version 2 of the License, or (at your option) any later version."),
    ("BSD", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met"),
    ("ISC", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies."),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
    ("CC-BY-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    ("proprietary", "All rights reserved."),
    ("AGPL-3.0", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU Affero General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version."),
    ("LGPL-3.0", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version."),
    ("LGPL-3.0", "This library is free software: you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version."),
    ("LGPL-2.1", "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation; either version 2.1 of the License, or (at your option) any later version."),
    ("EPL-1.0", "This program and the accompanying materials are made available under the terms of the Eclipse Public License v1.0 which accompanies this distribution"),
    ("EPL-2.0", "This program and the accompanying materials are made available under the terms of the Eclipse Public License 2.0 which is available at https://www.eclipse.org/legal/epl-2.0"),
    ("Unlicense", "This is free and unencumbered software released into the public domain."),
    ("CC0-1.0", "To the extent possible under law, the author(s) have dedicated all copyright and related and neighboring rights to this software to the public domain worldwide."),
    ("Zlib", "This software is provided 'as-is', without any express or implied warranty. In no event will the authors be held liable for any damages arising from the use of this software."),
    ("BSL-1.0", "Distributed under the Boost Software License, Version 1.0."),
)
#: Words in a shingle, and the share of a template's shingles that a window must hold.
WORDS, CONTAINMENT = 2, 0.8
#: Bands of one hash each. A window of twice the template's length that holds four fifths of its shingles has a similarity
#: of at least 0.36 to it, so all bands miss it with probability 0.64^40, about 2 in 10^8.
BANDS = 40
FOUND = "doc_id long, licenses array<struct<license:string,start_word:long,end_word:long,containment:double>>"


class Scanner:
    """The templates' shingles and smallest hashes, by template length."""

    def __init__(self, templates: tuple[tuple[str, str], ...], words: int, containment: float, bands: int):
        self.words, self.containment, self.names = words, containment, [name for name, _ in templates]
        found, at = word_hashes(pa.array([text for _, text in templates], pa.string()))
        hashes, owner = shingle_hashes(found, at, words)
        self.shingles = [np.unique(hashes[owner == i]) for i in range(len(templates))]
        self.seeds = mix(np.arange(1, bands + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))
        self.least = [[mix(s ^ seed).min() if len(s) else None for seed in self.seeds] for s in self.shingles]
        self.by_length: dict[int, list[int]] = {}
        for i, n in enumerate(np.diff(at).tolist()):
            if n:
                self.by_length.setdefault(n, []).append(i)

    def scan(self, texts: pa.Array) -> list[list[tuple[str, int, int, float]]]:
        """License, first and last word (exclusive) and containment of every match, by text."""
        found, at = word_hashes(texts)
        hashes, owner = shingle_hashes(found, at, self.words)
        matches: list[list] = [[] for _ in range(len(texts))]
        if not len(hashes):
            return matches
        begin = np.searchsorted(owner, np.arange(len(texts) + 1))
        runs = np.diff(begin)
        windows = {}
        for length in self.by_length:
            blocks = -(-runs // length)
            text = np.repeat(np.arange(len(texts)), blocks)
            first = begin[:-1][text] + length * (np.arange(len(text)) - np.repeat(np.cumsum(blocks) - blocks, blocks))
            windows[length] = first, text, np.append(text[1:] == text[:-1], False)
        hits = {i: np.zeros(len(windows[n][0]), bool) for n, own in self.by_length.items() for i in own}
        for band, seed in enumerate(self.seeds):
            values = mix(hashes ^ seed)
            for length, (first, _, more) in windows.items():
                low = np.minimum.reduceat(values, first)
                both = np.where(more, np.minimum(low, np.append(low[1:], low[:1])), low)
                for i in self.by_length[length]:
                    hits[i] |= both == self.least[i][band]
        for length, own in self.by_length.items():
            first, text, _ = windows[length]
            for i in own:
                for w in np.flatnonzero(hits[i]).tolist():
                    a, b = first[w], min(first[w] + 2 * length, begin[text[w] + 1])
                    inside = np.isin(hashes[a:b], self.shingles[i])
                    share = len(np.unique(hashes[a:b][inside])) / len(self.shingles[i])
                    if share >= self.containment:
                        span = np.flatnonzero(inside)
                        start, end = a - begin[text[w]] + span[0], a - begin[text[w]] + span[-1] + self.words
                        matches[text[w]].append((self.names[i], int(start), int(min(end, at[text[w] + 1] - at[text[w]])), share))
        return [_merged(m) for m in matches]


def _merged(matches: list[tuple[str, int, int, float]]) -> list[tuple[str, int, int, float]]:
    """Matches of one license that overlap are one; of different ones that overlap, the larger containment stays."""
    done: list[list] = []
    for name, start, end, share in sorted(matches):
        if done and done[-1][0] == name and start < done[-1][2]:
            done[-1][2], done[-1][3] = max(end, done[-1][2]), max(share, done[-1][3])
        else:
            done.append([name, start, end, share])
    beaten = [any(o[1] < d[2] and d[1] < o[2] and o[3] > d[3] for o in done) for d in done]
    return sorted((tuple(d) for d, lost in zip(done, beaten, strict=True) if not lost), key=lambda d: (d[1], d[2], d[0]))


def scan(docs: DataFrame, templates: tuple[tuple[str, str], ...] = TEMPLATES, words: int = WORDS, containment: float = CONTAINMENT, bands: int = BANDS) -> DataFrame:
    """``doc_id, licenses`` for every row of ``docs``: license, words it spans and containment, in order of the text.

    Case and punctuation do not count. A template matches where a window of twice its length holds ``containment`` of its
    distinct shingles; matches of one license that overlap are one, and of different licenses that overlap those with
    the largest containment stay. Null and empty texts have none; null ids and repeated
    rows stay; other columns are not read. Whole texts are scanned; rows never leave their partition.
    """
    small_batches(docs.sparkSession)
    kind = pa.list_(pa.struct([("license", pa.string()), ("start_word", pa.int64()), ("end_word", pa.int64()), ("containment", pa.float64())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scanner = Scanner(templates, words, containment, bands)
        names = ("license", "start_word", "end_word", "containment")
        for whole in batches:
            for a, b in slices(whole.column(1)):
                batch = whole.slice(a, b - a)
                found = [[dict(zip(names, m, strict=True)) for m in matches] for matches in scanner.scan(batch.column(1))]
                yield pa.record_batch([batch.column(0), pa.array(found, kind)], ["doc_id", "licenses"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).mapInArrow(run, FOUND)
