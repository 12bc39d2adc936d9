"""Licence notices: a trained paragraph classifier over sparse word n-grams, confirmed by comparison with templates.

A multinomial logistic model tells the licence families, other licences and ordinary text apart. It is fitted here on
variations of the families' notices, on notices of made-up licences, and on a bounded sample of the corpus. Its
temperature, and the probability below which a notice counts as of unknown licence, are calibrated on variations that the
fit has not seen and on notices of a family that was left out of it; ordinary text that the fit has not seen sets how sure
the model must be that something is a notice at all.

Paragraphs end at blank lines, so notices broken into lines are whole. Inside them lines and overlapping windows of a few
lengths are classified, too, so a notice in a long paragraph is found; logits of all of these come from two running sums.
Hits that overlap become one span.
"""

from __future__ import annotations

import random
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabwright.llm.blocks import WORD_BASE, Block, Rolling, Words, blocks, lower_ascii, words_of
from tabwright.llm.sampling import first_by_hash

#: Public notices of the families, as they stand in files and on pages.
TEMPLATES = {
    "MIT": (
        "Released under the MIT License.",
        "This project is licensed under the MIT License.",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files",
        "SPDX-License-Identifier: MIT",
    ),
    "Apache-2.0": (
        "Licensed under the Apache License, Version 2.0.",
        'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the License.',
        "This software is released under the Apache 2.0 license.",
        "SPDX-License-Identifier: Apache-2.0",
    ),
    "BSD-3-Clause": (
        "Licensed under the BSD 3-Clause License.",
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met",
        "Use of this source code is governed by a BSD-style license.",
        "SPDX-License-Identifier: BSD-3-Clause",
    ),
    "GPL-3.0": (
        "This work is licensed under the GNU General Public License, version 3.",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License",
        "Distributed under the GNU GPL v3.",
        "SPDX-License-Identifier: GPL-3.0-or-later",
    ),
    "LGPL-3.0": (
        "This library is licensed under the GNU Lesser General Public License, version 3.",
        "you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation",
        "SPDX-License-Identifier: LGPL-3.0-only",
    ),
    "AGPL-3.0": (
        "This program is licensed under the GNU Affero General Public License, version 3.",
        "under the terms of the GNU Affero General Public License as published by the Free Software Foundation",
        "SPDX-License-Identifier: AGPL-3.0-only",
    ),
    "MPL-2.0": (
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
        "Licensed under the Mozilla Public License 2.0.",
        "SPDX-License-Identifier: MPL-2.0",
    ),
    "CC-BY-4.0": (
        "Licensed under CC BY 4.0.",
        "This work is licensed under a Creative Commons Attribution 4.0 International License.",
        "SPDX-License-Identifier: CC-BY-4.0",
    ),
    "CC-BY-SA-4.0": (
        "Licensed under CC BY-SA 4.0.",
        "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.",
        "SPDX-License-Identifier: CC-BY-SA-4.0",
    ),
    "CC-BY-NC-4.0": (
        "Licensed under CC BY-NC 4.0.",
        "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License.",
        "SPDX-License-Identifier: CC-BY-NC-4.0",
    ),
    "CC0-1.0": (
        "To the extent possible under law, the author has waived all copyright and related or neighboring rights to this work.",
        "Dedicated to the public domain under CC0 1.0 Universal.",
        "SPDX-License-Identifier: CC0-1.0",
    ),
}
FAMILIES = tuple(TEMPLATES)
OTHER, NONE = len(FAMILIES), len(FAMILIES) + 1
#: Forms of notices whose licence is made up for the class of other licences.
OTHER_FORMS = (
    "Licensed under the {} License.",
    "Released under the {} Public License, version {}.",
    "This software is distributed under the terms of the {} licence.",
    "You may use, copy and modify this work under the {} license agreement.",
    "All rights reserved. Proprietary and confidential; no license is granted to {}.",
    "SPDX-License-Identifier: LicenseRef-{}",
)
#: log2 of the hashed features, most paragraphs of the corpus that are fitted on, and least overlap with a template.
BITS, SAMPLE, OVERLAP = 12, 2000, 0.8
#: Share of a left-out family's notices that may pass for a known family when the limit is set.
PASSING = 0.05
#: Words of the windows, and of the longest line or paragraph that is classified whole.
WINDOWS, LONGEST = (10, 20, 40, 80), 200
#: Characters of ordinary text that are taken from a line, and pairs of words known from notices that an unknown one needs.
PIECE, KNOWN_PAIRS = 2000, 2
#: What may close a notice after its last word.
CLOSING = ".)\"'"
#: Words whose sums are held at once.
SEGMENT = 200_000


def ngram_slots(words: Words) -> list[np.ndarray]:
    """Slots of single words and of pairs; a pair belongs to its first word's place and may cross a paragraph's end."""
    roll = Rolling(words.ids, WORD_BASE)
    return [(roll.windows(n) >> np.uint64(64 - BITS)).astype(np.int64) for n in (1, 2)]


def units(words: Words, block: Block) -> np.ndarray:
    """Ranges of words [a, b) to be classified: paragraphs, lines, and windows inside paragraphs; none crosses documents."""
    n = len(words.starts)
    if not n:
        return np.zeros((0, 2), np.int64)
    doc = np.searchsorted(block.bounds, words.starts, side="right")
    line = np.searchsorted(np.flatnonzero(block.data == 10), words.starts)
    new_doc = doc[1:] != doc[:-1]
    out = []

    def ranges(breaks: np.ndarray) -> np.ndarray:
        first = np.flatnonzero(np.append(True, breaks))
        return np.stack([first, np.append(first[1:], n)], axis=1)

    paragraphs = ranges(new_doc | (line[1:] > line[:-1] + 1))
    for whole in (paragraphs, ranges(new_doc | (line[1:] > line[:-1]))):
        out.append(whole[whole[:, 1] - whole[:, 0] <= LONGEST])
    for size in WINDOWS:
        long = paragraphs[paragraphs[:, 1] - paragraphs[:, 0] > size]
        steps = -(-(long[:, 1] - long[:, 0] - size) // (size // 2)) + 1
        a = np.repeat(long[:, 0], steps) + (np.arange(steps.sum()) - np.repeat(np.cumsum(steps) - steps, steps)) * (size // 2)
        out.append(np.stack([a, np.minimum(a + size, np.repeat(long[:, 1], steps))], axis=1))
    return np.unique(np.concatenate(out), axis=0)


def _vectors(texts: list[str]) -> np.ndarray:
    """Dense rows of n-gram shares, for fitting."""
    out = np.zeros((len(texts), 1 << BITS), np.float32)
    for i, t in enumerate(texts):
        words = words_of(next(blocks(pa.array([t]))), lower_ascii(np.frombuffer(t.encode(), np.uint8)), plain=True)
        if len(words.ids):
            for s in ngram_slots(words):
                np.add.at(out[i], s, 1.0)
            out[i] /= np.sqrt(len(words.ids))
    return out


def variations(rng: random.Random, notice: str, filler: list[str]) -> str:
    """A notice as it may occur: in other case, after a name, among other words."""
    out = notice
    if rng.random() < 0.2:
        out = rng.choice((str.upper, str.lower))(out)
    if rng.random() < 0.3:
        out = out.replace("License", "Licence").replace("license", "licence")
    if rng.random() < 0.3:
        out = f"Copyright (c) {rng.randint(1990, 2030)} {' '.join(rng.choices(filler, k=2))}. {out}"
    if rng.random() < 0.4:
        out = " ".join([*rng.choices(filler, k=rng.randint(1, 6)), out])
    if rng.random() < 0.4:
        out = " ".join([out, *rng.choices(filler, k=rng.randint(1, 6))])
    return out


@dataclass
class Classifier:
    """``least``: how likely a family must be; ``ordinary``: how unlikely ordinary text must be in a notice."""

    weights: np.ndarray
    bias: np.ndarray
    temperature: float = 1.0
    least: float = 0.5
    ordinary: float = 0.5

    def probabilities(self, logits: np.ndarray) -> np.ndarray:
        z = logits / self.temperature
        z = np.exp(z - z.max(axis=1, keepdims=True))
        return z / z.sum(axis=1, keepdims=True)


def _fit(x: np.ndarray, y: np.ndarray, steps: int = 100, rate: float = 0.1, decay: float = 1e-4) -> Classifier:
    w, b = np.zeros((x.shape[1], NONE + 1), np.float32), np.zeros(NONE + 1, np.float32)
    model = Classifier(w, b)
    goal = np.eye(NONE + 1, dtype=np.float32)[y]
    first, second = np.zeros((x.shape[1] + 1, NONE + 1)), np.zeros((x.shape[1] + 1, NONE + 1))
    for t in range(1, steps + 1):
        error = (model.probabilities(x @ model.weights + model.bias) - goal) / len(x)
        g = np.vstack([x.T @ error + decay * model.weights, error.sum(axis=0, keepdims=True)])
        first, second = 0.9 * first + 0.1 * g, 0.999 * second + 0.001 * g * g
        move = (rate * (first / (1 - 0.9**t)) / (np.sqrt(second / (1 - 0.999**t)) + 1e-8)).astype(np.float32)
        model.weights, model.bias = model.weights - move[:-1], model.bias - move[-1]
    return model


def _among(rng: random.Random, notice: str, filler: list[str]) -> str:
    """A notice inside a window that is longer than itself, broken into lines or not."""
    size = len(notice.split())
    room = next((w for w in WINDOWS if w > size), size) - size
    before = rng.randint(0, room)
    text = " ".join([*rng.choices(filler, k=before), notice, *rng.choices(filler, k=room - before)])
    if rng.random() < 0.3:
        width = rng.randint(5, 12)
        parts = text.split()
        text = "\n".join(" ".join(parts[i : i + width]) for i in range(0, len(parts), width))
    return text


def _pieces(texts: list[str]) -> list[str]:
    """Lines and windows of ordinary text, as they will be classified."""
    out = []
    for t in texts:
        w = t.split()
        out.append(t if len(w) <= LONGEST else " ".join(w[:LONGEST]))
        out += [" ".join(w[i : i + size]) for size in WINDOWS for i in range(0, len(w) - size + 1, size)]
    return out


def train(sample: list[str], seed: int = 7) -> Classifier:
    """Fit and calibrate; ``sample`` are ordinary paragraphs. Those that speak like notices are not used."""
    rng = random.Random(seed)
    plain = [p for p in sample if p.strip() and len(_shingles(p) & _NOTICE_PAIRS) < KNOWN_PAIRS + 1]
    rng.shuffle(plain)
    filler = [w for p in plain[:200] for w in p.split()[:20]] or ["the", "work", "is", "by", "its", "author"]
    unseen = _pieces(plain[: len(plain) // 4])
    fitted = _pieces(plain[len(plain) // 4 :])
    fitted = rng.sample(fitted, min(len(fitted), SAMPLE))

    def notices(families: tuple[str, ...], each: int) -> tuple[list[str], list[int]]:
        texts = [(variations(rng, rng.choice(TEMPLATES[f]), filler), FAMILIES.index(f)) for f in families for _ in range(each)]
        made_up = [rng.choice(OTHER_FORMS).format(rng.choice(filler).title(), rng.randint(1, 9)) for _ in range(4 * each)]
        texts += [(variations(rng, t, filler), OTHER) for t in made_up]
        return [_among(rng, t, filler) if rng.random() < 0.4 else t for t, _ in texts], [y for _, y in texts]

    def model_of(families: tuple[str, ...]) -> Classifier:
        texts, y = notices(families, 60)
        x = _vectors(texts + fitted)
        return _fit(x, np.array(y + [NONE] * len(fitted)))

    model = model_of(FAMILIES)
    texts, y = notices(FAMILIES, 30)
    logits, y = _vectors(texts) @ model.weights + model.bias, np.array(y)
    losses = {}
    for t in np.geomspace(0.05, 4, 45):
        model.temperature = float(t)
        losses[float(t)] = -np.log(model.probabilities(logits)[np.arange(len(y)), y] + 1e-12).mean()
    model.temperature = min(losses, key=losses.get)
    # a family that the model has never seen should stay unknown
    left_out = "MPL-2.0"
    partial = model_of(tuple(f for f in FAMILIES if f != left_out))
    partial.temperature = model.temperature
    notes = [variations(rng, rng.choice(TEMPLATES[left_out]), filler) for _ in range(100)]
    strange = partial.probabilities(_vectors(notes) @ partial.weights + partial.bias)[:, :OTHER].max(axis=1)
    model.least = float(np.clip(np.quantile(strange, 1 - PASSING), 0.5, 0.9))
    # ordinary text that the fit has not seen: all of it is to stay ordinary
    surest = 1.0
    for at in range(0, len(unseen), SAMPLE):
        surest = min(surest, float(model.probabilities(_vectors(unseen[at : at + SAMPLE]) @ model.weights + model.bias)[:, NONE].min()))
    model.ordinary = float(np.clip(surest, 0.02, 0.5))
    return model


def _shingles(text: str) -> set[tuple[str, ...]]:
    """Pairs of words, spelling of licence made one."""
    words = [w.replace("licence", "license") for w in re.findall(r"[^\W_]+", text.lower())]
    return set(zip(words, words[1:], strict=False))


_TEMPLATE_SETS = {f: [_shingles(t) for t in notices] for f, notices in TEMPLATES.items()}


#: Pairs of words that occur in notices.
_NOTICE_PAIRS = set().union(*(p for sets in _TEMPLATE_SETS.values() for p in sets), *(_shingles(t.format("", "")) for t in OTHER_FORMS))


def overlap(have: set, templates: list[set]) -> float:
    """Largest share of a template's pairs of words that occur."""
    return max(len(have & t) / len(t) for t in templates)


def _sums(model: Classifier, words: Words, a: int, b: int) -> tuple[np.ndarray, np.ndarray]:
    """Running sums of the weights of single words and of pairs, by the pair's first word, over words [a, b)."""
    some = Words(words.starts[a:b], words.ends[a:b], words.ids[a:b], words.bounds)
    out = []
    for slots in ngram_slots(some):
        sums = np.zeros((len(slots) + 1, NONE + 1))
        np.cumsum(model.weights[slots], axis=0, out=sums[1:])
        out.append(sums)
    return out[0], out[1]


def suspects(model: Classifier, words: Words, ranges: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The ranges that are hardly ordinary text, and their class probabilities."""
    kept, chances = [np.zeros((0, 2), np.int64)], [np.zeros((0, NONE + 1))]
    for at in range(0, len(words.starts), SEGMENT):
        lo, hi = np.searchsorted(ranges[:, 0], (at, at + SEGMENT))
        mine = ranges[lo:hi]
        if not len(mine):
            continue
        singles, pairs = _sums(model, words, at, int(mine[:, 1].max()))
        a, b = mine[:, 0] - at, mine[:, 1] - at
        logits = singles[b] - singles[a] + pairs[b - 1] - pairs[a]
        p = model.probabilities(logits / np.sqrt(b - a)[:, None] + model.bias)
        few = p[:, NONE] < model.ordinary
        kept.append(mine[few])
        chances.append(p[few])
    return np.concatenate(kept), np.concatenate(chances)


@dataclass(frozen=True)
class Notice:
    """A hit: bytes [start, end), family or unknown, probability, overlap with a template of the likeliest family.

    ``shared`` is the number of pairs that it shares with the template, ``reach`` the bytes that were classified.
    """

    start: int
    end: int
    family: str
    probability: float
    overlap: float
    shared: int
    reach: tuple[int, int]

    def rank(self) -> tuple:
        """Confirmed hits first, those that share most with a template; unknown ones by their probability; short before long."""
        if self.family != "unknown":
            return (False, -self.shared, -self.overlap, self.reach[1] - self.reach[0], self.start)
        return (True, -self.probability, self.end - self.start, self.start)

    def within(self, better: Notice) -> bool:
        """Whether this hit overlaps a better one; an unknown one is also part of what a known one was seen in."""
        a, b = better.reach if self.family == "unknown" else (better.start, better.end)
        return self.end > a and self.start < b


def judged(model: Classifier, text: str, start: int, p: np.ndarray) -> Notice | None:
    """What a suspect is: a family whose template confirms it, an unknown notice, or nothing.

    Its family is the likeliest one if that is likelier than the calibrated limit and a template of that family confirms
    it; a confirmed notice begins and ends where the template does. An unknown one speaks like notices do.
    """
    found = list(re.finditer(r"[^\W_]+", text.lower()))
    said = [m[0].replace("licence", "license") for m in found]
    pairs = list(zip(said, said[1:], strict=False))
    best = int(p[:OTHER].argmax())
    shares = [(len(t.intersection(pairs)), len(t), t) for t in _TEMPLATE_SETS[FAMILIES[best]]]
    full = [x for x in shares if x[0] >= OVERLAP * x[1]]
    shared, size, template = max(full, key=lambda x: x[0]) if full else max(shares, key=lambda x: x[0] / x[1])
    reach = (start, start + len(text.encode()))
    if p[best] >= model.least and full:
        a, b = 0, len(text)
        if len(text.lower()) == len(text):
            hits = [i for i, x in enumerate(pairs) if x in template]
            a, b = found[hits[0]].start(), found[hits[-1] + 1].end()
            while b < len(text) and text[b] in CLOSING:
                b += 1
        span = (start + len(text[:a].encode()), start + len(text[:b].encode()))
        return Notice(*span, FAMILIES[best], float(p[best]), shared / size, shared, reach)
    if len(_NOTICE_PAIRS.intersection(pairs)) < KNOWN_PAIRS:
        return None
    return Notice(*reach, "unknown", float(1 - p[NONE]), shared / size, shared, reach)


def notices_in(model: Classifier, block: Block) -> list[tuple[int, int, int, str, float, float]]:
    """(document row, start, end in code points, family or unknown, probability, template overlap) of each notice."""
    words = words_of(block, lower_ascii(block.data), plain=True)
    ranges, chances = suspects(model, words, units(words, block))
    hits: dict[int, list[Notice]] = {}
    for (a, b), p in zip(ranges.tolist(), chances, strict=True):
        start, end = int(words.starts[a]), int(words.ends[b - 1])
        stop = int(words.starts[b]) if b < len(words.starts) else len(block.data)
        while end < stop and chr(block.data[end]) in CLOSING:
            end += 1
        one = judged(model, block.data[start:end].tobytes().decode(), start, p)
        if one:
            hits.setdefault(int(np.searchsorted(block.bounds, start, side="right") - 1), []).append(one)
    found = []
    for doc, some in sorted(hits.items()):
        chosen: list[Notice] = []
        for one in sorted(some, key=Notice.rank):  # what overlaps a better hit is part of it
            if not any(one.within(c) for c in chosen):
                chosen.append(one)
        first = int(block.bounds[doc])
        points = np.append(0, np.cumsum((block.data[first : int(block.bounds[doc + 1])] & 0xC0) != 0x80))
        for c in sorted(chosen, key=lambda c: c.start):
            found.append((doc, int(points[c.start - first]), int(points[c.end - first]), c.family, c.probability, c.overlap))
    return found


def sample_paragraphs(docs: DataFrame, most: int = SAMPLE) -> list[str]:
    """At most ``most`` lines with a letter, one each of as many rows (doc_id, text), all chosen by hash.

    Of a line longer than PIECE characters a piece of that length is taken, its place chosen by hash, too.
    """
    texts = docs.where("text is not null").select("text", F.xxhash64("doc_id", "text").alias("h"))
    lines = F.filter(F.split("text", "\n"), lambda x: x.rlike("[A-Za-z]"))
    one = F.get(lines, F.pmod(F.col("h"), F.greatest(F.size(lines), F.lit(1))).cast("int"))
    place = F.pmod(F.shiftright("h", 16), F.greatest(F.length("line") - PIECE + 1, F.lit(1))) + 1
    every = texts.select("h", one.alias("line")).where("line is not null").select("h", F.substring("line", place, F.lit(PIECE)).alias("line"))
    chosen = first_by_hash(every, most, docs.count())
    return sorted(r[0] for r in chosen.select("line").collect())


def _scan(model):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block in blocks(batch.column(1)):
                by_doc: list[list[dict]] = [[] for _ in range(block.last - block.first)]
                for doc, a, b, family, chance, near in notices_in(model.value, block):
                    by_doc[doc].append({"start": a, "end": b, "family": family, "probability": chance, "overlap": near})
                kind = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64()), ("family", pa.string()), ("probability", pa.float64()), ("overlap", pa.float64())]))
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(block.first, len(by_doc)), pa.array(by_doc, kind)], names=["doc_id", "notices"])

    return run


def license_notices(docs: DataFrame, sample: int = SAMPLE, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: doc_id and its notices (start, end, family, probability, overlap) in order of place.

    Paragraphs of whole texts, their lines and overlapping windows are classified. Null and empty texts have none; each row is scanned on its own, also where
    its id is null or repeated; other columns are not read. Without ordinary text to sample the model knows notices only,
    and the template comparison alone keeps other lines out.
    """
    texts = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    model = docs.sparkSession.sparkContext.broadcast(train(sample_paragraphs(texts, sample)))  # 2**BITS rows of one weight per class
    kind = texts.schema["doc_id"].dataType.simpleString()
    notice = "start: bigint, end: bigint, family: string, probability: double, overlap: double"
    return texts.mapInArrow(_scan(model), f"doc_id {kind}, notices array<struct<{notice}>>")
