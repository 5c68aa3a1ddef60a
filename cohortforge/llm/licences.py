"""Licence scans: a generalised suffix automaton over the tokens of licence templates.

A text is streamed token by token through the automaton, which gives at each
token the longest template substring that ends there (matching statistics).
Maximal matches of at least ``MIN_MATCH`` words are chained along the template
into covered spans; a chain that covers enough of its template labels the text.
Where chains of several templates overlap in the text, the longest covering wins.

Base phrases ("mit license", ...) are found wherever their words stand
consecutively and label a text on their own.  Null and empty texts have no words
and no labels; score is the largest covered share of any template (a base phrase
counts as fully covered).

Templates are short notices, the whole texts of short licences (``licence_texts``) and those of the general public licences,
Apache's and Mozilla's, which lie beside this module as files; others are read from a folder with ``templates_from`` and passed
as ``templates``.
"""

from __future__ import annotations

import pkgutil
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cohortforge.llm import bytesops as B
from cohortforge.llm import licence_texts
from cohortforge.llm.shared import table

MIN_MATCH = 4
MAX_GAP = 8
LEAST_SHARE = 0.6

# Base phrases, and the wording of common public licence notices.
BASE = {"mit license": "mit", "apache license": "apache", "general public license": "gpl"}
TEMPLATES = {
    "mit": [
        "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files the software to deal in the software without restriction including without limitation the rights to use copy modify merge publish distribute sublicense and or sell copies of the software",
        "the above copyright notice and this permission notice shall be included in all copies or substantial portions of the software",
        "released under the mit license",
        "licensed under the mit license",
    ],
    "apache": [
        "licensed under the apache license version 2 0 the license you may not use this file except in compliance with the license you may obtain a copy of the license at",
        "licensed under the apache license version 2 0",
        "unless required by applicable law or agreed to in writing software distributed under the license is distributed on an as is basis without warranties or conditions of any kind either express or implied",
    ],
    "gpl": [
        "this program is free software you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation either version 3 of the license or at your option any later version",
        "this work is licensed under the gnu general public license version 3",
        "this program is distributed in the hope that it will be useful but without any warranty without even the implied warranty of merchantability or fitness for a particular purpose",
    ],
    "bsd": [
        "redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met",
        "redistributions of source code must retain the above copyright notice this list of conditions and the following disclaimer",
    ],
    "isc": ["permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted provided that the above copyright notice and this permission notice appear in all copies"],
    "mpl": ["this source code form is subject to the terms of the mozilla public license v 2 0"],
    "cc-by": ["licensed under cc by 4 0", "this work is licensed under a creative commons attribution 4 0 international license"],
    "cc-by-sa": ["licensed under cc by sa 4 0", "this work is licensed under a creative commons attribution sharealike 4 0 international license"],
    "cc-by-nc": ["licensed under cc by nc 4 0", "this work is licensed under a creative commons attribution noncommercial 4 0 international license"],
    "unlicense": ["this is free and unencumbered software released into the public domain"],
}
#: Files of whole texts and their labels.
FILES = {"Apache-2.0": "apache", "GPL-2": "gpl", "GPL-3": "gpl", "LGPL-2.1": "lgpl", "LGPL-3": "lgpl", "MPL-2.0": "mpl"}
_LONG: dict[str, list[str]] = {}
for _name, _label in FILES.items():
    _LONG.setdefault(_label, []).append(pkgutil.get_data(__package__, f"licence_files/{_name}.txt").decode())
TEMPLATES = {label: [*TEMPLATES.get(label, []), *licence_texts.WHOLE.get(label, []), *_LONG.get(label, [])] for label in {**TEMPLATES, **licence_texts.WHOLE, **_LONG}}


def templates_from(spark: SparkSession, folder: str, labels: dict[str, str], most_bytes: int = 4 << 20) -> dict[str, list[str]]:
    """TEMPLATES and the whole text of each file of a folder whose name is a key of ``labels`` (name to label), at most so many bytes in all."""
    files = spark.read.text(folder, wholetext=True).select(F.element_at(F.split(F.col("_metadata.file_path"), "/"), -1).alias("name"), "value").where(F.col("name").isin(*labels))
    size = files.agg(F.coalesce(F.sum(F.octet_length("value")), F.lit(0))).first()[0]
    if size > most_bytes:
        raise ValueError(f"licence texts of {size} bytes are too many for one automaton")
    out = {label: list(texts) for label, texts in TEMPLATES.items()}
    for name, text in sorted(map(tuple, files.collect())):
        out.setdefault(labels[name], []).append(text)
    return out


class SuffixAutomaton:
    """All substrings of several token sequences; each state knows where its substrings end."""

    def __init__(self, sequences: list[list[int]]):
        self.next: list[dict[int, int]] = [{}]
        self.link, self.length, self.ends = [-1], [0], [set()]
        for number, sequence in enumerate(sequences):
            at = 0
            for position, token in enumerate(sequence):
                at = self._add(at, token)
                self.ends[at].add((number, position + 1))
        for state in sorted(range(1, len(self.next)), key=self.length.__getitem__, reverse=True):
            if self.link[state] > 0:
                self.ends[self.link[state]] |= self.ends[state]

    def _state(self, length: int, link: int, onward: dict[int, int]) -> int:
        self.next.append(onward)
        self.length.append(length)
        self.link.append(link)
        self.ends.append(set())
        return len(self.next) - 1

    def _split(self, before: int, token: int, onto: int) -> int:
        """The state of exactly one token more than ``before``; parts ``onto`` if it also holds longer strings."""
        if self.length[onto] == self.length[before] + 1:
            return onto
        part = self._state(self.length[before] + 1, self.link[onto], dict(self.next[onto]))
        self.link[onto] = part
        while before >= 0 and self.next[before].get(token) == onto:
            self.next[before][token] = part
            before = self.link[before]
        return part

    def _add(self, last: int, token: int) -> int:
        if token in self.next[last]:
            return self._split(last, token, self.next[last][token])
        new, at = self._state(self.length[last] + 1, 0, {}), last
        while at >= 0 and token not in self.next[at]:
            self.next[at][token] = new
            at = self.link[at]
        if at >= 0:
            self.link[new] = self._split(at, token, self.next[at][token])
        return new

    def statistics(self, tokens):
        """For each token, the state and length of the longest substring that ends there."""
        state = length = 0
        for token in tokens:
            while state and token not in self.next[state]:
                state = self.link[state]
                length = self.length[state]
            state = self.next[state].get(token, 0)
            length = length + 1 if state else 0
            yield state, length


class Scanner:
    def __init__(self, templates=TEMPLATES, base=BASE, min_match=MIN_MATCH):
        pairs = [(label, text.encode().translate(B.NON_WORD).split()) for label, texts in templates.items() for text in texts]
        self.labels, self.templates = [x for x, _ in pairs], [x for _, x in pairs]
        self.vocabulary: dict[bytes, int] = {}
        phrases = [(p.encode().split(), label) for p, label in base.items()]
        for words in [*self.templates, *(p for p, _ in phrases)]:
            for w in words:
                self.vocabulary.setdefault(w, len(self.vocabulary))
        coded = [[self.vocabulary[w] for w in words] for words in self.templates]
        self.phrases = [([self.vocabulary[w] for w in words], label) for words, label in phrases]
        self.lasts = {p[-1] for p, _ in self.phrases}
        self.automaton, self.min_match = SuffixAutomaton(coded), min_match

    def runs(self, words: list[bytes]) -> list[tuple[int, list[int]]]:
        """Starts and codes of two or more template words in a row; any other word ends all matches."""
        codes = np.fromiter(map(self.vocabulary.get, words, repeat(-1)), np.int32, len(words))
        known = np.concatenate([[False], codes >= 0, [False]])
        edge = np.flatnonzero(known[1:] != known[:-1])
        return [(a, codes[a:b].tolist()) for a, b in zip(edge[::2].tolist(), edge[1::2].tolist()) if b - a > 1]

    def base_places(self, runs) -> list[tuple[int, str]]:
        out = []
        for start, codes in runs:
            if not self.lasts.isdisjoint(codes):
                for phrase, label in self.phrases:
                    k = len(phrase)
                    out += [(start + i, label) for i in range(len(codes) - k + 1) if codes[i : i + k] == phrase]
        return sorted(out)

    def matches(self, runs) -> list[tuple[int, int, int, int]]:
        """Maximal long matches: template, start in it, start in the text, words."""
        out = []
        for start, codes in runs:
            if len(codes) < self.min_match:
                continue
            stats = list(self.automaton.statistics(codes))
            for i, (state, length) in enumerate(stats):
                if length >= self.min_match and (i + 1 == len(stats) or stats[i + 1][1] <= length):
                    out += [(number, end - length, start + i + 1 - length, length) for number, end in self.automaton.ends[state]]
        return sorted(out, key=lambda m: (m[0], m[2], m[1]))

    def chains(self, matches) -> list[dict]:
        """Matches of a template that follow one another in text and template, as covered spans."""
        done, open_ = [], {}
        for number, there, here, length in matches:
            chain = open_.get(number)
            if chain and chain["there"] <= there and chain["last"] <= here <= chain["last"] + MAX_GAP:
                chain["there"], chain["last"], chain["covered"] = there + length, here + length, chain["covered"] + length
            elif not chain or here >= chain["last"] or length > chain["covered"]:
                open_[number] = chain = {"number": number, "first": here, "there": there + length, "last": here + length, "covered": length}
                done.append(chain)
        for chain in done:
            chain["share"] = chain["covered"] / len(self.templates[chain["number"]])
        return done

    def scan(self, text: bytes) -> tuple:
        """Word count, base places, labels of long chains, score and label spans (words) of one text."""
        words = text.translate(B.NON_WORD).split()
        runs = self.runs(words)
        if not runs:
            return len(words), [], [], 0.0, []
        places, chains = self.base_places(runs), self.chains(self.matches(runs))
        score = 1.0 if places else max((c["share"] for c in chains), default=0.0)
        spans: list[tuple[int, int, str]] = []
        for c in sorted(chains, key=lambda c: (-c["covered"], -c["share"], c["first"], c["number"])):
            if c["share"] >= LEAST_SHARE and all(c["last"] <= a or b <= c["first"] for a, b, _ in spans):
                spans.append((c["first"], c["last"], self.labels[c["number"]]))
        return len(words), places, sorted({x for *_, x in spans}), min(1.0, score), sorted(spans)


_OUT = [("n_words", pa.int64()), ("n_base", pa.int64()), ("first_word", pa.int64()), ("last_word", pa.int64()), ("base_labels", pa.string()), ("labels", pa.string()), ("score", pa.float64()), ("licence_spans", pa.list_(pa.struct([("first", pa.int64()), ("last", pa.int64()), ("label", pa.string())])))]
_TYPES = ["long", "long", "long", "long", "string", "string", "double", "array<struct<first:bigint,last:bigint,label:string>>"]


def scan(df: DataFrame, *, text_col="text", templates=TEMPLATES, base=BASE) -> DataFrame:
    """``df`` with n_words, n_base, first_word, last_word, base_labels, labels, score and licence_spans (word ranges)."""
    new = [n for n, _ in _OUT]
    kept = df.drop(*new)
    names = kept.columns

    def run(batches):
        scanner = Scanner(templates, base)
        for batch in batches:
            column = batch.column(names.index(text_col))
            _, off = B.utf8(column)
            for a, b in B.chunks(off):
                rows = []
                for text in B.texts_of(column.slice(a, b - a)):
                    n, places, labels, score, spans = scanner.scan(text)
                    held = sorted({x for _, x in places})
                    rows.append((n, len(places), places[0][0] if places else None, places[-1][0] if places else None, ",".join(held), ",".join(sorted({*held, *labels})), score, [dict(zip(("first", "last", "label"), s)) for s in spans]))
                cols = list(zip(*rows))
                yield pa.RecordBatch.from_arrays([*(c.slice(a, b - a) for c in batch.columns), *(pa.array(v, t) for v, (_, t) in zip(cols, _OUT))], names=[*names, *new])

    return kept.mapInArrow(run, kept.withColumns({n: F.lit(None).cast(t) for n, t in zip(new, _TYPES)}).schema)


def query(spark, sf_dir) -> DataFrame:
    return scan(table(spark, sf_dir, "documents").select("doc_id", "text")).drop("text")
