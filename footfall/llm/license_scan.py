"""License scan: templates with optional and replaceable regions as token automata.

A template is a line of words with three kinds of markup:

* ``[ ... ]``      an optional region, which may be nested;
* ``( a | b )``    alternatives, of which one stands;
* ``{m,n}``        a replaceable region of m to n arbitrary words.

Everything else is mandatory wording. All templates are compiled into automata
over words; a text carries a label where an automaton can walk from a start word
to its end over consecutive words, so the mandatory wording has to match exactly.
Texts are read once, in one pass, without a shuffle; an automaton is started only
at words with which a template can begin.

Null and empty texts have no words and no labels. Repeated rows are judged one by
one, ties do not occur, and columns other than the id and the text are not read.
An empty table gives no rows.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import DataFrame

from footfall.llm.common import word_list
from footfall.session import carry_to_workers

carry_to_workers(__name__)

# Label, kind, wording. "base" phrases are the ones that n_base,
# first_word and last_word count; the rest are public license notices and texts.
TEMPLATES = (
    ("mit", "base", "under the mit license"),
    ("apache-2", "base", "apache license version 2"),
    ("cc-by-nc", "base", "cc by nc"),
    ("mit", "text", "permission is hereby granted free of charge to any person obtaining a copy of"
     " this software and [associated] documentation files [the software] to deal in the software"
     " without restriction"),
    ("apache-2", "text", "licensed under the apache license version 2 0 [the license] you may not use"
     " this file except in compliance with the license"),
    ("gpl-3", "notice", "gnu general public license [as published by the free software foundation]"
     " [either] version 3"),
    ("gpl-2", "notice", "gnu general public license [as published by the free software foundation]"
     " [either] version 2"),
    ("lgpl", "notice", "gnu (lesser|library) general public license"),
    ("agpl-3", "notice", "gnu affero general public license"),
    ("mpl-2", "notice", "mozilla public license [version|v] 2 [0]"),
    ("bsd", "notice", "under the [{1,1}] bsd [{1,2}] license"),
    ("bsd", "text", "redistribution and use in source and binary forms with or without modification"
     " are permitted provided that the following conditions are met"),
    ("isc", "text", "permission to use copy modify and [or] distribute this software for any purpose"
     " with or without fee is hereby granted provided that the above copyright notice and this"
     " permission notice appear in all copies"),
    ("zlib", "text", "this software is provided as is without any express or implied warranty in no"
     " event will the authors be held liable for any damages arising from the use of this software"),
    ("cc-by-sa", "notice", "cc by sa"),
    ("cc-by-nd", "notice", "cc by nd"),
    ("cc-by", "notice", "cc by (1|2|3|4) [0|5]"),
    ("cc0", "notice", "(cc0|cc zero) [1] [0]"),
    ("unlicense", "text", "this is free and unencumbered software released into the public domain"),
)
#: Confidence of a match by kind: the wording of the license, a notice that names it.
KIND_SCORE = {"text": 1.0, "notice": 0.8, "base": 0.8}

ANY = None  # the label of an arc that takes every word


@dataclass
class Automaton:
    """Arcs ``state -> [(word or ANY, state)]`` and free moves ``state -> [state]``."""

    label: str
    kind: str
    arcs: list[list[tuple[bytes | None, int]]] = field(default_factory=lambda: [[]])
    free: list[list[int]] = field(default_factory=lambda: [[]])
    end: int = 0

    def state(self) -> int:
        self.arcs.append([])
        self.free.append([])
        return len(self.arcs) - 1

    def closure(self, states: Iterable[int]) -> set[int]:
        seen, todo = set(), list(states)
        while todo:
            s = todo.pop()
            if s not in seen:
                seen.add(s)
                todo.extend(self.free[s])
        return seen

    def starts(self) -> set[bytes | None]:
        return {word for s in self.closure([0]) for word, _ in self.arcs[s]}

    def match(self, words: list[bytes], at: int) -> bool:
        """Whether the wording stands at word ``at``."""
        now = self.closure([0])
        for i in range(at, len(words)):
            now = self.closure(t for s in now for word, t in self.arcs[s]
                               if word is ANY or word == words[i])
            if self.end in now:
                return True
            if not now:
                return False
        return False


def compile_template(label: str, kind: str, wording: str) -> Automaton:
    """Compiles the markup described above; raises ValueError where it is unbalanced."""
    tokens = re.findall(r"\{\d+,\d+\}|[\[\]()|]|[^\s\[\]()|{}]+", wording)
    machine, at = Automaton(label, kind), 0

    def branch(state: int, closing: str | None) -> int:
        """Compiles up to ``closing``; returns the state behind it."""
        nonlocal at
        start, ends = state, []
        while at < len(tokens) and tokens[at] != closing:
            token = tokens[at]
            at += 1
            if token == "|":
                ends.append(state)
                state = start
            elif token in ("[", "("):
                inner = machine.state()
                machine.free[state].append(inner)
                after = branch(inner, "]" if token == "[" else ")")
                if token == "[":
                    machine.free[state].append(after)
                state = after
            elif token[0] == "{":
                least, most = map(int, token[1:-1].split(","))
                short = []
                for n in range(most):
                    if n >= least:
                        short.append(state)
                    following = machine.state()
                    machine.arcs[state].append((ANY, following))
                    state = following
                for s in short:
                    machine.free[s].append(state)
            elif token in ("]", ")"):
                raise ValueError(f"unbalanced {token} in template {label!r}")
            else:
                following = machine.state()
                machine.arcs[state].append((token.encode(), following))
                state = following
        if closing is not None:
            if at == len(tokens):
                raise ValueError(f"{closing} is missing in template {label!r}")
            at += 1
        join = machine.state()
        for s in [*ends, state]:
            machine.free[s].append(join)
        return join

    machine.end = branch(0, None)
    if machine.end in machine.closure([0]):
        raise ValueError(f"template {label!r} has no mandatory wording")
    if ANY in machine.starts():
        raise ValueError(f"template {label!r} starts with a replaceable region")
    return machine


def start_table(machines: list[Automaton]) -> dict[bytes, list[Automaton]]:
    table: dict[bytes, list[Automaton]] = {}
    for machine in machines:
        for word in machine.starts():
            table.setdefault(word, []).append(machine)
    return table


def find(words: list[bytes], table: dict[bytes, list[Automaton]]) -> list[tuple[int, str, str]]:
    """(word, label, kind) of every place where a template stands."""
    return [(i, m.label, m.kind) for i, word in enumerate(words) if word in table
            for m in table[word] if m.match(words, i)]


def judge(text: str | None, table: dict[bytes, list[Automaton]]) -> tuple:
    words = word_list(text)
    found = find(words, table) if words else []
    base = [i for i, _, kind in found if kind == "base"]
    return (
        len(words), len(base), min(base, default=None), max(base, default=None),
        ",".join(sorted({label for _, label, kind in found if kind == "base"})),
        ",".join(sorted({label for _, label, _ in found})),
        max((KIND_SCORE[kind] for _, _, kind in found), default=0.0))


FOUND = "n_words long, n_base long, first_word long, last_word long, base_labels string, labels string, score double"
_KINDS = [pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.string(), pa.float64()]
_NAMES = [part.split()[0] for part in FOUND.split(", ")]


def scan_licenses(docs: DataFrame, doc_id: str = "doc_id", text: str = "text",
                  templates: Iterable[tuple[str, str, str]] = TEMPLATES) -> DataFrame:
    """One row per document: the id and what ``FOUND`` lists.

    ``n_base`` counts all places of ``base`` phrases; ``first_word`` and ``last_word``
    are their smallest and largest start, null without any. ``labels`` also has
    what the other templates found; ``score`` is the best match's confidence.
    """
    machines = [compile_template(*t) for t in templates]
    id_type = docs.schema[doc_id].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = start_table(machines)
        for batch in batches:
            rows = [judge(t.as_py(), table) for t in batch.column(1)]
            columns = list(zip(*rows)) or [[]] * len(_KINDS)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *(pa.array(c, k) for c, k in zip(columns, _KINDS))], ["doc_id", *_NAMES])

    return docs.select(docs[doc_id], docs[text]).mapInArrow(run, f"doc_id {id_type}, {FOUND}")
