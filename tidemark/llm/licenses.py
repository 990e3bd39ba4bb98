"""License scan: template markup compiled to token automata.

A template is a line of words in which ``[ ... ]`` is wording that may be left out and
``{name:n}`` stands for up to ``n`` words of any kind. The rest is mandatory and must be
there word for word. A template compiles to a small automaton over words: state ``i``
stands before word ``i``, optional wording adds a jump over it, a replaceable region one
jump per word it may take. Templates begin with mandatory words, and the automaton runs
from every place where that opening stands; it accepts at the longest end it reaches.

Beside the automata, the base phrases count wherever their words stand one after the
other. A null text has no words. Repeated rows are judged alone and come out equal. Other
columns are not read.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.common import WORD_BYTES, chunks, table

# Phrases and their labels.
BASE = {
    "gnu general public license": "gpl",
    "apache license": "apache",
    "cc by": "cc-by",
    "mit license": "mit",
}

TEMPLATES = (
    ("apache-2.0", "licensed under the apache license [version 2 0] [the license]"),
    ("apache-2.0", "you may obtain a copy of the license at [http] [https] www apache org "
                   "licenses license 2 0"),
    ("gpl", "this {what:4} is licensed under the gnu [lesser] [affero] general public license "
            "[version {number:2}] [or any later version]"),
    ("gpl", "under the terms of the gnu [lesser] [affero] general public license as published "
            "by the free software foundation [either] [version {number:2}]"),
    ("cc-by-nc", "licensed under [a] [the] cc by nc [{more:1}] [4 0] [3 0]"),
    ("cc-by-sa", "licensed under [a] [the] cc by sa [4 0] [3 0]"),
    ("cc-by", "licensed under [a] [the] cc by [4 0] [3 0]"),
    ("cc-by", "licensed under a creative commons attribution [{kind:2}] [4 0] [international] "
              "license"),
    ("mit", "permission is hereby granted free of charge to any person obtaining a copy of "
            "this software [and associated documentation files] {scope:4} to deal in the "
            "software without restriction"),
    ("mit", "released under the [terms of the] mit license"),
    ("mit", "licensed under the [terms of the] mit license"),
    ("bsd", "redistribution and use in source and binary forms with or without modification "
            "are permitted provided that the following conditions are met"),
    ("spdx", "spdx license identifier {identifier:1}"),
)


@dataclass(frozen=True)
class Automaton:
    """Steps from a state: the word it needs (None: any word) and the state it leads to;
    jumps that need no word."""

    label: str
    opening: bytes  # the mandatory words it begins with, space between
    steps: tuple[tuple[bytes | None, int] | None, ...]
    jumps: tuple[tuple[int, ...], ...]

    def _reach(self, states: set[int]) -> set[int]:
        todo = list(states)
        while todo:
            for to in self.jumps[todo.pop()]:
                if to not in states:
                    states.add(to)
                    todo.append(to)
        return states

    def longest(self, words: list[bytes], at: int) -> int | None:
        """The end of the longest accepted run of words from ``at``."""
        final, found = len(self.steps) - 1, None
        states = self._reach({0})
        for i in range(at, len(words) + 1):
            if final in states:
                found = i
            if i == len(words):
                break
            step = set()
            for s in states:
                if self.steps[s] is not None and self.steps[s][0] in (None, words[i]):
                    step.add(self.steps[s][1])
            if not step:
                break
            states = self._reach(step)
        return found


def compile_template(label: str, markup: str) -> Automaton:
    steps: list[tuple[bytes | None, int] | None] = []
    jumps: list[set[int]] = []
    open_at: list[int] = []
    opening: list[str] = []
    plain = True
    for part in re.findall(r"\[|\]|\{\w+:\d+\}|[^\s\[\]{}]+", markup):
        if part == "[":
            open_at.append(len(steps))
            plain = False
        elif part == "]":
            jumps[open_at.pop()].add(len(steps))
        elif part.startswith("{"):
            n, first = int(part[1:-1].split(":")[1]), len(steps)
            plain = False
            for _ in range(n):
                steps.append((None, len(steps) + 1))
                jumps.append(set())
            for s in range(first, first + n):
                jumps[s].add(first + n)
        else:
            if plain:
                opening.append(part)
            steps.append((part.encode(), len(steps) + 1))
            jumps.append(set())
    if open_at or not opening:
        raise ValueError(f"template must open with a word and close its brackets: {markup}")
    return Automaton(label, " ".join(opening).encode(), (*steps, None),
                     (*map(tuple, jumps), ()))


def find_phrase(line: bytes, phrase: bytes) -> list[int]:
    """Places of a phrase in " word word ", as numbers of its first word. Places may
    overlap."""
    out, wanted, word, seen = [], b" " + phrase + b" ", 0, 0
    at = line.find(wanted)
    while at >= 0:
        word += line.count(b" ", seen, at)
        seen = at
        out.append(word)
        at = line.find(wanted, at + 1)
    return out


class Scanner:
    def __init__(self, templates=TEMPLATES):
        self.automata = [compile_template(*t) for t in templates]

    def scan(self, text: str | None) -> tuple:
        """n_words, n_base, first_word, last_word, base labels, labels, score, accepted
        templates as (label, first word, end word). The score is 1 for an accepted
        template, 0.5 for a base phrase alone, else 0."""
        words = (text or "").encode().translate(WORD_BYTES).split()
        line = b" " + b" ".join(words) + b" "
        base = [(at, label) for phrase, label in BASE.items()
                for at in find_phrase(line, phrase.encode())]
        accepted = []
        for automaton in self.automata:
            for at in find_phrase(line, automaton.opening):
                end = automaton.longest(words, at)
                if end is not None:
                    accepted.append((automaton.label, at, end))
        places = [at for at, _ in base]
        base_labels = {label for _, label in base}
        labels = base_labels | {label for label, _, _ in accepted}
        return (len(words), len(base), min(places, default=None), max(places, default=None),
                ",".join(sorted(base_labels)), ",".join(sorted(labels)),
                1.0 if accepted else 0.5 if base else 0.0, sorted(set(accepted)))


def scan(df: DataFrame, doc_id: str = "doc_id", text: str = "text",
         templates=TEMPLATES) -> DataFrame:
    """Findings of every text; ``accepted`` lists the accepted templates with their words."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scanner = Scanner(templates)
        kinds = [pa.int64()] * 4 + [pa.string()] * 2 + [pa.float64(), pa.list_(pa.struct(
            [("label", pa.string()), ("first", pa.int64()), ("end", pa.int64())]))]
        names = ["n_words", "n_base", "first_word", "last_word", "base_labels", "labels",
                 "score", "accepted"]
        for batch in chunks(batches, "text"):
            rows = [scanner.scan(t) for t in batch.column(1).to_pylist()]
            rows = [(*r[:7], [{"label": l, "first": a, "end": e} for l, a, e in r[7]])
                    for r in rows]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0)] + [pa.array([r[i] for r in rows], kind)
                                     for i, kind in enumerate(kinds)], ["doc_id", *names])

    source = df.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    kind = source.schema["doc_id"].dataType.simpleString()
    return source.mapInArrow(run, f"doc_id {kind}, n_words long, n_base long, first_word long, "
                                  "last_word long, base_labels string, labels string, score "
                                  "double, accepted array<struct<label:string,first:long,end:long>>")


def op7_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Licenses named in every whole text."""
    return scan(table(spark, sf_dir, "documents")).drop("accepted")
