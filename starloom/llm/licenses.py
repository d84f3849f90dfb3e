"""License scan: Aho-Corasick over notice phrases and identifier tags, and a shunting-yard evaluation of expressions.

Two automata are built from the tables below in every task: one over a text's words, for phrases, one over its lower-cased
letters, for tags such as `SPDX-License-Identifier:`. What follows a tag is read as a licence expression as far as it is
one, put into postfix order by the shunting-yard algorithm (WITH binds before AND, AND before OR) and evaluated to how
freely it lets the text be used: AND takes the least of its sides, OR the most, WITH an exception lies half-way to 1.
"""

from __future__ import annotations

import functools
import re
from collections.abc import Iterator

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from starloom.llm.common import bounded_batches

#: Phrases of the base, by their words.
BASE = {"gnu general public license": "gpl", "apache license": "apache", "cc by": "cc-by", "mit license": "mit"}

#: Further notice phrases of the method, by their words.
NOTICES = {
    "gnu lesser general public license": "lgpl",
    "gnu library general public license": "lgpl",
    "gnu affero general public license": "agpl",
    "gnu free documentation license": "gfdl",
    "gnu gpl": "gpl",
    "licensed under the gpl": "gpl",
    "mozilla public license": "mpl",
    "eclipse public license": "epl",
    "common development and distribution license": "cddl",
    "european union public licence": "eupl",
    "boost software license": "bsl-1.0",
    "bsd license": "bsd",
    "bsd 2 clause": "bsd",
    "bsd 3 clause": "bsd",
    "isc license": "isc",
    "zlib license": "zlib",
    "artistic license": "artistic",
    "python software foundation license": "psf",
    "cc by sa": "cc-by-sa",
    "cc by nc": "cc-by-nc",
    "cc by nd": "cc-by-nd",
    "cc by nc sa": "cc-by-nc-sa",
    "cc by nc nd": "cc-by-nc-nd",
    "creative commons attribution": "cc-by",
    "creative commons attribution sharealike": "cc-by-sa",
    "creative commons attribution share alike": "cc-by-sa",
    "creative commons attribution noncommercial": "cc-by-nc",
    "creative commons attribution non commercial": "cc-by-nc",
    "creative commons zero": "cc0",
    "cc0 1 0 universal": "cc0",
    "released into the public domain": "public-domain",
    "dedicated to the public domain": "public-domain",
    "permission is hereby granted free of charge to any person obtaining a copy": "mit",
    "redistribution and use in source and binary forms with or without modification": "bsd",
    "permission to use copy modify and or distribute this software for any purpose": "isc",
    "this is free and unencumbered software released into the public domain": "unlicense",
}

#: Tags that an expression follows: whether operands that no family is known of count as licences too.
TAGS = {
    "spdx-license-identifier:": True,
    "license:": False,
    "licence:": False,
    "license-expression:": False,
    '"license":': False,
    "license =": False,
}

#: Families by the start of an identifier, the longest first to fit; how freely each lets a text be used, from 0 to 1.
FAMILIES = {
    "public-domain": 1.0, "cc0": 1.0, "unlicense": 1.0, "0bsd": 1.0, "wtfpl": 1.0,
    "mit": 0.9, "bsd": 0.9, "isc": 0.9, "zlib": 0.9, "apache": 0.9, "bsl-1.0": 0.9, "psf": 0.9, "python": 0.9, "artistic": 0.8,
    "cc-by": 0.8, "mpl": 0.6, "epl": 0.6, "cddl": 0.6, "lgpl": 0.5, "eupl": 0.4, "cc-by-sa": 0.4, "gfdl": 0.4, "gpl": 0.3,
    "agpl": 0.2, "cc-by-nd": 0.2, "cc-by-nc": 0.1, "cc-by-nc-sa": 0.1, "cc-by-nc-nd": 0.1,
}
UNKNOWN = 0.05

WORD_BREAK = re.compile(r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+")
PART = re.compile(r"[ \t\"']*(?:([()])|([a-z0-9][a-z0-9.+-]*)(:[a-z0-9.+-]+)?)")
BINDS = {"or": 1, "and": 2, "with": 3}


@functools.cache
def phrase_automaton() -> ahocorasick.Automaton:
    """All phrases between spaces, each with (words, label, whether it is of the base)."""
    out = ahocorasick.Automaton()
    for phrases, base in ((NOTICES, False), (BASE, True)):
        for phrase, label in phrases.items():
            out.add_word(f" {phrase} ", (phrase.count(" ") + 1, label, base))
    out.make_automaton()
    return out


@functools.cache
def tag_automaton() -> ahocorasick.Automaton:
    out = ahocorasick.Automaton()
    for tag, free in TAGS.items():
        out.add_word(tag, (tag, free))
    out.make_automaton()
    return out


def family(identifier: str) -> str | None:
    """The longest family that the identifier is or starts with, up to a sign."""
    ends = [i for i in range(len(identifier), 0, -1) if i == len(identifier) or identifier[i] in "-.+"]
    return next((identifier[:i] for i in ends if identifier[:i] in FAMILIES), None)


def phrases(low: str) -> tuple[int, list[tuple[int, int, str, bool]]]:
    """Number of words, and (first word, end word, label, base) of every phrase, by its end."""
    line = WORD_BREAK.sub(" ", low).strip(" ")
    if not line:
        return 0, []
    line = f" {line} "
    found, at, words = [], 0, 0
    for last, (n, label, base) in phrase_automaton().iter(line):
        words += line.count(" ", at, last)  # spaces before the one that ends the phrase: words up to here
        at = last
        found.append((words - n, words, label, base))
    return line.count(" ") - 1, found


def shunted(low: str, at: int, free: bool) -> tuple[list[tuple[str, str]], str, int]:
    """The longest licence expression from `at` on: in postfix order of (kind, value), as it stands, and where it ends.

    Kinds are id, exception and op. Reading stops at the end of the line, at a word that does not fit, or at the end of
    the last complete expression. Unless `free`, licences have to be of a known family. Time is linear in the length.
    """
    out: list[tuple[str, str]] = []
    ops: list[str] = []
    read: list[str] = []
    whole: tuple[int, list[str], int, int] = (0, [], 0, at)
    depth, operand, exception = 0, True, False
    while m := PART.match(low, at):
        sign, word, ref = m.group(1), m.group(2), m.group(3)
        if word and ref and operand:
            word += ref  # a reference to a document, written document:licence
        if sign == "(":
            if not operand or exception:
                break
            ops.append("(")
            depth += 1
        elif sign == ")":
            if operand or not depth:
                break
            while ops[-1] != "(":
                out.append(("op", ops.pop()))
            ops.pop()
            depth -= 1
        elif operand:
            word = word.rstrip(".-")
            if word in BINDS or not (exception or free or family(word)):
                break
            out.append(("exception" if exception else "id", word))
            operand, exception = False, False
        elif word in BINDS:
            if word == "with" and (read[-1] == ")" or out[-1][0] != "id"):
                break  # an exception belongs to one licence
            while ops and ops[-1] != "(" and BINDS[ops[-1]] >= BINDS[word]:
                out.append(("op", ops.pop()))
            ops.append(word)
            operand, exception = True, word == "with"
        else:
            break
        read.append(sign or (word.upper() if operand else word))
        at = m.end()
        if not operand and not depth:  # complete so far; outside brackets at most three operators wait
            whole = len(out), ops[:], len(read), at
    n, waiting, parts, end = whole
    return out[:n] + [("op", x) for x in reversed(waiting)], " ".join(read[:parts]), end


def evaluated(postfix: list[tuple[str, str]]) -> float:
    """How freely the expression lets a text be used."""
    stack: list[float] = []
    for kind, value in postfix:
        if kind == "op":
            y, x = stack.pop(), stack.pop()
            stack.append((x + 1) / 2 if value == "with" else min(x, y) if value == "and" else max(x, y))
        else:
            stack.append(FAMILIES.get(family(value) or "", UNKNOWN))
    return stack[-1]


def expressions(low: str) -> list[tuple[int, int, str, float, list[str]]]:
    """(start, end, expression, freedom, labels) behind every tag; a tag within what another tag's expression took is none."""
    out: list[tuple[int, int, str, float, list[str]]] = []
    seen = 0
    for last, (tag, free) in tag_automaton().iter(low):
        start = last + 1 - len(tag)
        if start < seen or (start and (low[start - 1].isalnum() or low[start - 1] in "-_")):
            continue
        postfix, text, end = shunted(low, last + 1, free)
        if postfix:
            out.append((start, end, text, evaluated(postfix), [family(v) or v for k, v in postfix if k != "op"]))
            seen = end
    return out


def scanned(text: str | None) -> dict:
    """All that scan_licenses tells of one text."""
    low = (text or "").encode("utf-8", "surrogatepass").lower().decode("utf-8", "surrogatepass")
    n_words, found = phrases(low)
    tagged = expressions(low)
    base = [x for x in found if x[3]]
    labels = {x[2] for x in found} | {y for x in tagged for y in x[4]}
    freedom = [FAMILIES[x[2]] for x in found] + [x[3] for x in tagged]
    return {
        "n_words": n_words,
        "n_base": len(base),
        "first_word": min((x[0] for x in base), default=None),
        "last_word": max((x[0] for x in base), default=None),
        "base_labels": ",".join(sorted({x[2] for x in base})),
        "labels": ",".join(sorted(labels)),
        "score": min(freedom, default=0.0),
        "notices": [{"start_word": s, "end_word": e, "label": label} for s, e, label, _ in sorted(found)],
        "expressions": [{"start": s, "end": e, "expression": x, "freedom": f} for s, e, x, f, _ in tagged],
    }


RESULT = T.StructType(
    [T.StructField(x, T.LongType()) for x in ("n_words", "n_base", "first_word", "last_word")]
    + [T.StructField("base_labels", T.StringType()), T.StructField("labels", T.StringType()), T.StructField("score", T.DoubleType())]
    + [
        T.StructField("notices", T.ArrayType(T.StructType().add("start_word", T.LongType()).add("end_word", T.LongType()).add("label", T.StringType()))),
        T.StructField(
            "expressions",
            T.ArrayType(T.StructType().add("start", T.LongType()).add("end", T.LongType()).add("expression", T.StringType()).add("freedom", T.DoubleType())),
        ),
    ]
)
NOTICE_KIND = pa.list_(pa.struct([("start_word", pa.int64()), ("end_word", pa.int64()), ("label", pa.string())]))
EXPRESSION_KIND = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64()), ("expression", pa.string()), ("freedom", pa.float64())]))


def scan_licenses(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", keep: list[str] | None = None) -> DataFrame:
    """doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score, notices, expressions (and keep) by row.

    notices are the phrases found (words from 0, end exclusive), expressions what follows a tag (code points, with the tag).
    labels are those of all notices and the families of all licences in expressions; an identifier without a family, or an
    exception, is its own label. score is the least freedom of all that was found, 0 where nothing was. Overlapping
    phrases all count. Whole texts are scanned row by row; null and empty texts have no words and no labels; null ids
    and repeated rows pass through; an empty table gives an empty result; further columns are ignored.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kinds = [*[pa.int64()] * 4, pa.string(), pa.string(), pa.float64(), NOTICE_KIND, EXPRESSION_KIND]
        for b in batches:
            rows = [scanned(t.as_py()) for t in b.column(1)]
            columns = [pa.array([r[f] for r in rows], kind) for f, kind in zip(RESULT.names, kinds)]
            yield pa.RecordBatch.from_arrays([b.column(0), *columns, *b.columns[2:]], names)

    carried = [F.col(c).alias(f"_keep_{c}") for c in keep or []]
    src = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("t"), *carried)
    schema = T.StructType([src.schema.fields[0], *RESULT.fields, *src.schema.fields[2:]])
    names = schema.names
    out = bounded_batches(src).mapInArrow(run, schema)
    return out.select("doc_id", *RESULT.names, *[F.col(f"_keep_{c}").alias(c) for c in keep or []])
