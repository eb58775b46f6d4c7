"""License notices found by template markup compiled into token automata.

A template is wording with two kinds of markup::

    [[ ... ]]      an optional region, which may be left out as a whole (nests)
    {{ a | b }}    a replaceable region: one of the alternatives
    {{ *n }}       a replaceable region: any 0 to n words

Everything else is mandatory wording. Both kinds may hold alternatives. All templates compile into one
non-deterministic automaton over words, whose states carry epsilon-free
successor tables; a text is accepted for a template when some run of its
consecutive words leads from a start state to the template's final state, so
mandatory words must match exactly and in full. Every whole text is read word by
word in pieces; only the live states are kept, so memory does not depend on the
text's length.

Base phrases (same word rule) are counted at every place they stand.

Defined results: null counts as the empty text, which has no words, no labels
and score 0; repeated rows are answered one by one; an empty table gives an
empty result. ``score`` is 1 when a template accepts the text, 0.5 when only
base phrases stand in it, else 0.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pathcredit.llm.common import whole_text

WORD = re.compile(rb"[0-9a-z\x80-\xff]+")  # of lower-cased UTF-8: what [^\x00-\x2F\x3A-\x60\x7B-\x7F]+ is of text
PIECE = 1 << 16

BASE_PHRASES = {"cc by": "cc-by", "general public license": "gpl", "all rights reserved": "reserved"}

# The wording of licence notices and licence texts.
TEMPLATES = {
    "apache-2.0": "{{licensed|released|distributed}} under the [[terms of the]] apache license [[version]] 2 0",
    "mit": "{{licensed|released|distributed}} under the [[terms of the]] mit license",
    "bsd": "{{licensed|released|distributed}} under the [[terms of the]] {{bsd|{{2|3}} clause bsd}} license",
    "mpl-2.0": "subject to the terms of the mozilla public license {{v|version}} 2 0",
    "gpl-3.0": "[[this {{work|program|software}} is]] {{licensed|released|distributed}} under the [[terms of the]] gnu "
               "general public license {{version|v}} 3 [[or [[at your option]] any later version]]",
    "gpl-2.0": "[[this {{work|program|software}} is]] {{licensed|released|distributed}} under the [[terms of the]] gnu "
               "general public license {{version|v}} 2 [[or [[at your option]] any later version]]",
    "cc-by-4.0": "licensed under [[a|the]] {{cc by|creative commons attribution}} 4 0 [[international]] [[license]]",
    "cc-by-sa-4.0": "licensed under {{cc by sa|[[a]] creative commons attribution {{sharealike|share alike}}}} 4 0",
    "cc-by-nc-4.0": "licensed under {{cc by nc|[[a]] creative commons attribution {{noncommercial|non commercial}}}} 4 0",
    "copyright-line": "{{copyright|copr}} [[c]] {{*8}} all rights reserved",
    # Whole licence texts; holders are replaceable, clauses that some versions lack optional.
    "mit-text": """
        permission is hereby granted free of charge to any person obtaining a copy of this {{software|font software}} and
        associated documentation files [[the software]] to deal in the software without restriction including without
        limitation the rights to use copy modify merge publish distribute sublicense and or sell copies of the software
        and to permit persons to whom the software is furnished to do so subject to the following conditions
        [[the above copyright notice and this permission notice [[including the next paragraph]] shall be included in all
        copies or substantial portions of the software]]
        the software is provided as is without warranty of any kind express or implied including but not limited to the
        warranties of merchantability fitness for a particular purpose and {{noninfringement|non infringement}}
        in no event shall {{*12}} be liable for any claim damages or other liability whether in an action of contract tort
        or otherwise arising from out of or in connection with the software or the use or other dealings in the software""",
    "bsd-text": """
        redistribution and use in source and binary forms with or without modification are permitted provided that the
        following conditions are met [[1|a]] redistributions of source code must retain the above copyright notice this list
        of conditions and the following disclaimer [[2|b]] redistributions in binary form must reproduce the above copyright
        notice this list of conditions and the following disclaimer in the documentation and or other materials provided
        with the distribution
        [[ [[3|c]] all advertising materials mentioning features or use of this software must display the following
        acknowledgement this product includes software developed by {{*16}} ]]
        [[ [[3|4|c|d]] {{neither the name of {{*16}} nor the names of {{its|their}} contributors may|
        the name of {{*16}} may not}} be used to endorse or promote products derived from this software without specific
        prior written permission ]]
        this software is provided by {{*16}} as is and any express or implied warranties including but not limited to the
        implied warranties of merchantability and fitness for a particular purpose are disclaimed in no event shall {{*16}} be
        liable for any direct indirect incidental special exemplary or consequential damages including but not limited to
        procurement of substitute goods or services loss of use data or profits or business interruption however caused and
        on any theory of liability whether in contract strict liability or tort including negligence or otherwise arising in
        any way out of the use of this software even if advised of the possibility of such damage""",
    "isc-text": """
        permission to use copy modify [[and or|and]] distribute this software for any purpose with or without fee is hereby
        granted provided that the above copyright notice and this permission notice appear in all copies
        the software is provided as is and {{*12}} {{disclaims|disclaim}} all warranties with regard to this software including
        all implied warranties of merchantability and fitness in no event shall {{*12}} be liable for any special direct
        indirect or consequential damages or any damages whatsoever resulting from loss of use data or profits whether in an
        action of contract negligence or other tortious action arising out of or in connection with the use or performance
        of this software""",
}


# ------------------------------------------------------------------ compiling

@dataclass
class Automaton:
    """States with one-word steps; ``any_word`` steps take every word."""

    steps: list[dict[bytes, set[int]]] = field(default_factory=list)
    any_word: list[set[int]] = field(default_factory=list)
    free: list[set[int]] = field(default_factory=list)
    final: dict[int, str] = field(default_factory=dict)
    start: set[int] = field(default_factory=set)

    def state(self) -> int:
        self.steps.append({})
        self.any_word.append(set())
        self.free.append(set())
        return len(self.steps) - 1

    def closure(self, states: set[int]) -> frozenset[int]:
        todo, out = list(states), set(states)
        while todo:
            for s in self.free[todo.pop()] - out:
                out.add(s)
                todo.append(s)
        return frozenset(out)


_TOKEN = re.compile(r"\[\[|\]\]|\{\{|\}\}|\||\*\d+|[0-9a-z]+")


def _sequence(tokens: list[str], a: Automaton, at: int) -> int:
    """Read parts up to a closing mark or ``|``; returns the state after them."""
    while tokens and tokens[0] not in ("]]", "}}", "|"):
        token = tokens.pop(0)
        if token in ("[[", "{{"):
            close = "]]" if token == "[[" else "}}"
            end = a.state()
            if token == "[[":
                a.free[at].add(end)
            while True:
                a.free[_sequence(tokens, a, at)].add(end)
                mark = tokens.pop(0) if tokens else None
                if mark == close:
                    break
                if mark != "|":
                    raise ValueError(f"unbalanced template mark, expected {close}")
            at = end
        elif token.startswith("*"):
            end = a.state()
            a.free[at].add(end)
            for _ in range(int(token[1:])):
                after = a.state()
                a.any_word[at].add(after)
                a.free[after].add(end)
                at = after
            at = end
        else:
            after = a.state()
            a.steps[at].setdefault(token.encode(), set()).add(after)
            at = after
    return at


def compile_templates(templates: dict[str, str]) -> Automaton:
    a = Automaton()
    for label, text in templates.items():
        tokens = _TOKEN.findall(text.lower())
        first = a.state()
        end = _sequence(tokens, a, first)
        if tokens:
            raise ValueError(f"unbalanced template {label!r}")
        if end in a.closure({first}):
            raise ValueError(f"template {label!r} has no mandatory word")
        a.start.add(first)
        a.final[end] = label
    return a


class Matcher:
    """The automaton without free steps, and the base phrases, run over a text's words."""

    def __init__(self, templates: dict[str, str], phrases: dict[str, str]) -> None:
        a = compile_templates(templates)
        start = a.closure(a.start)
        self.first: dict[bytes, frozenset[int]] = {}
        for s in start:
            for w, to in a.steps[s].items():
                self.first[w] = self.first.get(w, frozenset()) | a.closure(to)
        if any(a.any_word[s] for s in start):
            raise ValueError("a template may not begin with any words")
        self.steps = [{w: a.closure(to) for w, to in s.items()} for s in a.steps]
        self.any_word = [a.closure(s) if s else frozenset() for s in a.any_word]
        self.final = a.final
        self.phrases = [(tuple(p.encode().split()), label) for p, label in phrases.items()]
        self.longest = max(len(p) for p, _ in self.phrases)
        self.begins = frozenset(self.first) | {p[0] for p, _ in self.phrases}

    @staticmethod
    def _pieces(data: bytes) -> Iterator[list[bytes]]:
        """The words, some tens of thousands of bytes at a time."""
        at = 0
        while at < len(data):
            end = at + PIECE
            if end < len(data):  # go on to the end of the word that is cut
                tail = WORD.match(data, end)
                end = tail.end() if tail else end
            yield WORD.findall(data, at, end)
            at = end

    def read(self, text: bytes) -> tuple[int, int, int | None, int | None, str, str, float]:
        """(n_words, n_base, first_word, last_word, base_labels, labels, score)."""
        before, places, base, found = 0, [0, None, None], set(), set()
        live: frozenset[int] = frozenset()
        carried: list[bytes] = []  # last words of the piece before, for phrases that reach over its end
        for words in self._pieces(text.lower()):
            if live or not self.begins.isdisjoint(words):
                for w in words:
                    if live or w in self.first:
                        nxt = set(self.first.get(w, ()))
                        for s in live:
                            nxt |= self.steps[s].get(w, frozenset()) | self.any_word[s]
                        live = frozenset(nxt)
                        if not self.final.keys().isdisjoint(live):
                            found.update(self.final[s] for s in live if s in self.final)
            reach = carried + words
            offset = before - len(carried)
            for phrase, label in self.phrases:
                if phrase[0] not in reach:
                    continue
                size, at = len(phrase), -1
                while True:
                    try:
                        at = reach.index(phrase[0], at + 1)
                    except ValueError:
                        break
                    if at + size > len(carried) and tuple(reach[at:at + size]) == phrase:
                        places[0] += 1
                        base.add(label)
                        start = offset + at
                        places[1] = start if places[1] is None else min(places[1], start)
                        places[2] = start if places[2] is None else max(places[2], start)
            before += len(words)
            carried = reach[-(self.longest - 1):] if self.longest > 1 else []
        score = 1.0 if found else 0.5 if base else 0.0
        return (before, *places, ",".join(sorted(base)), ",".join(sorted(base | found)), score)


SCHEMA = ("n_words long, n_base long, first_word long, last_word long, base_labels string, labels string, "
          "score double")


def scan_licenses(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                  templates: dict[str, str] | None = None, phrases: dict[str, str] | None = None) -> DataFrame:
    """(id, n_words, n_base, first_word, last_word, base_labels, labels, score) for every row of ``docs``."""
    matcher = Matcher(templates or TEMPLATES, phrases or BASE_PHRASES)  # compiled once, sent with the tasks
    names = [c.split()[0] for c in SCHEMA.split(", ")]

    @F.pandas_udf(SCHEMA)
    def scan(texts: pd.Series) -> pd.DataFrame:
        out = pd.DataFrame([matcher.read(bytes(t)) for t in texts], columns=names)
        return out.astype({"first_word": "Int64", "last_word": "Int64"})

    found = docs.select(F.col(id_col), scan(whole_text(text_col).cast("binary")).alias("found"))
    return found.select(id_col, "found.*")
