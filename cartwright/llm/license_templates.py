"""License scans by template markup.

A template is text with ``[[optional]]`` and ``{{replaceable:min-max}}``
regions.  It compiles to a token automaton: mandatory words must match
exactly, optional regions may be skipped, replaceable regions take any words
within their bounds.  Words are runs of characters other than ASCII
punctuation, space and control characters, with A-Z lower-cased.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame

from cartwright.llm.common import map_texts

# The base phrases and their labels.
PHRASES = (
    ("gnu general public license", "gpl"),
    ("apache license", "apache"),
    ("cc by", "cc-by"),
    ("mit license", "mit"),
)

# Notices in template markup; labels are the templates' own.
TEMPLATES = (
    ("apache-2.0", "licensed under the apache license [[,]] version 2 0 [[(the {{name:1-2}})]]"
                   " [[you may not use this {{thing:1-3}} except in compliance with the license]]"),
    ("gpl-2.0", "{{subject:1-6}} [[is]] [[are]] [[free software you can redistribute it and or modify it]]"
                " [[licensed]] under the [[terms of the]] gnu general public license"
                " [[as published by the free software foundation]] [[either]] version 2"),
    ("gpl-3.0", "{{subject:1-6}} [[is]] [[are]] [[free software you can redistribute it and or modify it]]"
                " [[licensed]] under the [[terms of the]] gnu general public license"
                " [[as published by the free software foundation]] [[either]] version 3"),
    ("mit-notice", "{{verb:1-1}} under the [[terms of the]] mit license"),
    ("mit-grant", "permission is hereby granted free of charge to any person obtaining a copy of this software"
                  " and associated documentation files [[the software]] to deal in the {{work:1-2}}"
                  " without restriction"),
    ("bsd-redistribution", "redistribution and use in source and binary forms with or without modification"
                           " are permitted provided that the following conditions are met"),
    ("bsd-disclaimer", "this software is provided by the {{holder:2-8}} as is and any express or implied warranties"
                       " including but not limited to the implied warranties of merchantability and fitness for a"
                       " particular purpose are disclaimed"),
    ("lgpl-2.1", "{{subject:1-6}} [[is]] [[free software you can redistribute it and or modify it]] [[licensed]] under the"
                 " [[terms of the]] gnu lesser general public license [[as published by the free software foundation]]"
                 " [[either]] version 2 1"),
    ("agpl-3.0", "{{subject:1-6}} [[is]] [[free software you can redistribute it and or modify it]] [[licensed]] under the"
                 " [[terms of the]] gnu affero general public license [[as published by the free software foundation]]"
                 " [[either]] version 3"),
    ("mpl-2.0", "this source code form is subject to the terms of the mozilla public license v 2 0"
                " [[if a copy of the mpl was not distributed with this file you can obtain one at {{where:1-8}}]]"),
    ("isc", "permission to use copy modify and [[or]] distribute this software for any purpose with or without fee is"
            " hereby granted provided that the above copyright notice and this permission notice appear in all copies"),
    ("unlicense", "this is free and unencumbered software released into the public domain"
                  " [[anyone is free to copy modify publish use compile sell or distribute this software]]"),
    ("cc-by-4.0", "licensed under [[a]] [[the]] cc by 4 0"),
    ("cc-by-nc-4.0", "licensed under [[a]] [[the]] cc by nc 4 0"),
    ("cc-by-4.0", "licensed under [[a]] [[the]] creative commons attribution 4 0 international {{license:0-1}}"),
)

# Separators become a space and A-Z lower case, so split() gives the words;
# bytes of characters beyond ASCII are word bytes, as their characters are.
_WORD = re.compile(rb"[0-9A-Za-z\x80-\xff]")
FOLD = bytes(b + 32 if 65 <= b <= 90 else b if _WORD.match(bytes([b])) else 32 for b in range(256))
_PARTS = re.compile(r"\[\[|\]\]|\{\{\w+:(\d+)-(\d+)\}\}|[^\s\[\]{}]+")


def words_of(utf8: bytes) -> list[bytes]:
    return utf8.translate(FOLD).split()


class Automaton:
    """States are numbered along the template; ``word[s]`` is what leads from
    s to s + 1 (None: any word), ``skip[s]`` the state that an optional region
    or a replaceable word beyond the minimum may jump to."""

    def __init__(self, template: str):
        self.word: list[bytes | None] = []
        self.skips: dict[int, set[int]] = {}
        opened: list[int] = []
        mandatory: list[tuple[int, bytes]] = []
        for m in _PARTS.finditer(template):
            at = len(self.word)
            if m[0] == "[[":
                opened.append(at)
            elif m[0] == "]]":
                self.skips.setdefault(opened.pop(), set()).add(at)
            elif m[1]:
                least, most = int(m[1]), int(m[2])
                self.word += [None] * most
                for s in range(at + least, at + most):
                    self.skips.setdefault(s, set()).add(at + most)
            else:
                for w in words_of(m[0].encode()):
                    if not opened:
                        mandatory.append((len(self.word), w))
                    self.word.append(w)
        self.final = len(self.word)
        # a run of mandatory words without which no text matches
        runs: list[list[bytes]] = []
        for k, (s, w) in enumerate(mandatory):
            if k and mandatory[k - 1][0] == s - 1 and s not in self.skips:
                runs[-1].append(w)
            else:
                runs.append([w])
        self.needs = b" " + b" ".join(max(runs, key=lambda r: sum(map(len, r)))) + b" "
        self.first = self._closed({0})

    def _closed(self, states: set[int]) -> frozenset[int]:
        todo = list(states)
        seen = set(states)
        while todo:
            for t in self.skips.get(todo.pop(), ()):
                if t not in seen:
                    seen.add(t)
                    todo.append(t)
        return frozenset(seen)

    def accepts(self, words: list[bytes]) -> bool:
        """Whether some stretch of the words matches; one pass, all starts at
        once, as many states as the template has words."""
        states: frozenset[int] = frozenset()
        for w in words:
            moved = {s + 1 for s in states | self.first if s < self.final and self.word[s] in (None, w)}
            states = self._closed(moved)
            if self.final in states:
                return True
        return False


class LicenseScanner:
    def __init__(self, phrases=PHRASES, templates=TEMPLATES):
        self.phrases = [(b" " + p.encode() + b" ", label) for p, label in phrases]
        self.automata = [(label, Automaton(t)) for label, t in templates]

    def scan(self, utf8: bytes) -> tuple:
        """n_words, n_base, first_word, last_word, base labels, all labels, score."""
        words = words_of(utf8)
        line = b" " + b" ".join(words) + b" "
        n, first, last, base = 0, None, None, set()
        for phrase, label in self.phrases:
            at, word, counted = line.find(phrase), 0, 0
            while at >= 0:
                word, counted = word + line.count(b" ", counted, at), at
                n, first = n + 1, word if first is None else min(first, word)
                last = word if last is None else max(last, word)
                base.add(label)
                at = line.find(phrase, at + 1)
        own = {label for label, a in self.automata if a.needs in line and a.accepts(words)}
        return len(words), n, first, last, sorted(base), sorted(base | own), 1.0 if own else 0.7 if base else 0.0


def scan_licenses(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                  phrases=PHRASES, templates=TEMPLATES) -> DataFrame:
    """Per document: n_words, n_base, first_word, last_word, base_labels,
    labels, score.

    The score is 1 if a template's mandatory wording matches exactly, 0.7 for
    a base phrase alone, else 0.  NULL and empty texts have 0 words and no
    labels; repeated rows are scanned each; further columns are ignored; no
    shuffle.
    """
    def make():
        scanner = LicenseScanner(phrases, templates)

        def one(raw: bytes) -> tuple:
            n, k, first, last, base, labels, score = scanner.scan(raw)
            return n, k, first, last, ",".join(base), ",".join(labels), score
        return one

    return map_texts(docs, make, [("n_words", "bigint"), ("n_base", "bigint"), ("first_word", "bigint"),
                                  ("last_word", "bigint"), ("base_labels", "string"), ("labels", "string"),
                                  ("score", "double")], id_col, text_col)
