"""Licence scan (operator 9): an Aho-Corasick automaton over notice phrases
and identifier tags, and a shunting-yard evaluation of licence expressions.

Texts are lower-cased (A-Z) and reduced to words; a phrase matches where its
words stand consecutively, whatever lies between them. A tag such as
``SPDX-License-Identifier:`` is followed by an expression in the raw text,
which is parsed with the precedence or < and < with.

A null or empty text has no words, no places and score 0. Every row is
scanned on its own: repeated rows, null ids and extra columns change nothing.
"""

from __future__ import annotations

import re
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from cadenza.llm.common import in_batches, slices

BASE_PHRASES = {"cc by": "cc-by", "general public license": "gpl", "all rights reserved": "reserved"}
# Own phrases: label, and how sure the phrase alone makes us of a licence (0-1).
PHRASES = {
    "licensed under the apache license": ("apache", 0.95), "apache license version 2 0": ("apache-2.0", 0.95),
    "mit license": ("mit", 0.9), "permission is hereby granted free of charge": ("mit", 0.9),
    "bsd 3 clause": ("bsd-3-clause", 0.9), "bsd 2 clause": ("bsd-2-clause", 0.9),
    "redistribution and use in source and binary forms": ("bsd", 0.9),
    "lesser general public license": ("lgpl", 0.95), "affero general public license": ("agpl", 0.95),
    "gnu gpl": ("gpl", 0.85), "mozilla public license": ("mpl", 0.95), "eclipse public license": ("epl", 0.95),
    "cc by sa": ("cc-by-sa", 0.85), "cc by nc": ("cc-by-nc", 0.85), "cc by nd": ("cc-by-nd", 0.85),
    "cc by nc sa": ("cc-by-nc-sa", 0.85), "cc by nc nd": ("cc-by-nc-nd", 0.85), "cc0": ("cc0", 0.8),
    "creative commons attribution": ("cc-by", 0.9), "public domain": ("public-domain", 0.5),
    "boost software license": ("bsl-1.0", 0.95), "the unlicense": ("unlicense", 0.8), "isc license": ("isc", 0.85),
    "without warranty of any kind": ("warranty-notice", 0.5), "proprietary and confidential": ("proprietary", 0.8),
    "licensed under": ("notice", 0.4),
}
BASE_SURE = {"cc by": 0.8, "general public license": 0.9, "all rights reserved": 0.6}
TAGS = ("spdx license identifier", "license expression", "license spdx")
_TAG = re.compile(r"(?i)(?:spdx-license-identifier|license-expression|license-spdx)\s*[:=]\s*([^\r\n]*)")
_TOKEN = re.compile(r"[()]|[A-Za-z0-9][A-Za-z0-9.+\-:]*")
_BINDS = {"or": 1, "and": 2, "with": 3}


def parse_expression(text: str) -> list[str]:
    """Postfix form of the longest well-formed licence expression that begins ``text``.

    Empty if none does. Words after a complete expression end it.
    """
    out: list[str] = []
    ops: list[str] = []
    operand_next, best = True, []
    for token in _TOKEN.findall(text):
        low = token.lower()
        if operand_next:
            if token == "(":
                ops.append(token)
                continue
            if token == ")" or low in _BINDS:
                break
            out.append(low)
            operand_next = False
        elif low in _BINDS:
            while ops and ops[-1] != "(" and _BINDS[ops[-1]] >= _BINDS[low]:
                out.append(ops.pop())
            ops.append(low)
            operand_next = True
        elif token == ")":
            while ops and ops[-1] != "(":
                out.append(ops.pop())
            if not ops:
                break
            ops.pop()
        else:
            break
        if not operand_next and "(" not in ops:
            best = out + ops[::-1]
    return best


def evaluate(postfix: list[str]) -> tuple[list[str], float]:
    """Labels of an expression and its weight: ``and`` needs both sides, ``or``
    either, and ``with`` qualifies the licence to its left by an exception."""
    stack: list[tuple[list[str], float]] = []
    for token in postfix:
        if token not in _BINDS:
            stack.append(([token], 1.0))
            continue
        (right, r), (left, s) = stack.pop(), stack.pop()
        if token == "with":
            stack.append(([f"{x} with {y}" for x in left for y in right], s))
        elif token == "and":
            stack.append((left + right, min(s, r)))
        else:
            stack.append((left + right, max(s, r)))
    return stack[0] if stack else ([], 0.0)


def _word_table() -> bytes:
    """Bytes map: A-Z lowered, word bytes (0-9, a-z, 0x80 and up) kept, all others a blank."""
    return bytes(b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256))


WORD_TABLE = _word_table()


@lru_cache(1)
def _automaton():
    import ahocorasick
    a = ahocorasick.Automaton()
    found: dict[str, dict] = {}
    for phrase, label in BASE_PHRASES.items():
        found.setdefault(phrase, {}).update(base=label, label=label, sure=BASE_SURE[phrase])
    for phrase, (label, sure) in PHRASES.items():
        found.setdefault(phrase, {}).update(label=label, sure=sure)
    for phrase in TAGS:
        found.setdefault(phrase, {}).update(tag=True)
    for phrase, what in found.items():
        a.add_word(f" {phrase} ", what | {"length": len(phrase) + 2})
    a.make_automaton()
    return a


def scan(text: str | None) -> tuple:
    """n_words, n_base, first_word, last_word, base_labels, labels, score of one text."""
    data = (text or "").encode()
    words = data.translate(WORD_TABLE).split()
    line = " " + b" ".join(words).decode("latin-1") + " "
    base, labels, first, last, n_base, doubt, tagged = set(), set(), None, None, 0, 1.0, False
    sure: dict[str, float] = {}
    for end, what in _automaton().iter(line):
        if "tag" in what:
            tagged = True
            continue
        labels.add(what["label"])
        sure[what["label"]] = max(sure.get(what["label"], 0.0), what["sure"])
        if "base" in what:
            base.add(what["base"])
            n_base += 1
            last = end + 1 - what["length"]
            first = last if first is None else first
    if tagged:
        for m in _TAG.finditer(text):
            ids, weight = evaluate(parse_expression(m[1]))
            labels.update(ids)
            sure.update({x: max(sure.get(x, 0.0), 0.98 * weight) for x in ids})
    for label in sorted(sure):
        doubt *= 1.0 - sure[label]
    word_at = lambda at: line.count(" ", 0, at)
    return (len(words), n_base, None if first is None else word_at(first), None if last is None else word_at(last),
            ",".join(sorted(base)), ",".join(sorted(labels)), 1.0 - doubt)


def license_scan(docs: DataFrame) -> DataFrame:
    """doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score for every row."""
    types = [pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.string(), pa.float64()]
    names = ["n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score"]

    def run(batches):
        for b in slices(batches):
            found = list(zip(*(scan(x) for x in b.column("text").to_pylist()), strict=True))
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), *(pa.array(x, t) for x, t in zip(found, types, strict=True))], ["doc_id", *names])
    return docs.select("doc_id", "text").transform(
        in_batches, run, "doc_id long, n_words long, n_base long, first_word long, last_word long, base_labels string, labels string, score double")


def op9_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_scan(spark.read.parquet(f"{sf_dir}/documents.parquet"))
