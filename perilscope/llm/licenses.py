"""Licence scan: an automaton finds identifier tags and notice phrases, a parser evaluates expressions.

Two Aho-Corasick automata run over a whole text once: one over its words joined by single blanks (notice
phrases, whatever stands between the words), one over the lower-cased text (identifier tags, which
announce a licence expression).  Behind a tag the longest prefix that can be an expression is read and
evaluated with two stacks (Dijkstra's shunting yard): ``with`` binds before ``and``, ``and`` before ``or``.
"""

from __future__ import annotations

import re
import string

from pyspark.sql import DataFrame, functions as F

# fixed values: the base phrases and their labels
BASE = (("mit license", "mit"), ("apache license", "apache"), ("general public license", "gpl"))

#: notice phrases of the method: words, label
NOTICES = (
    ("bsd license", "bsd"), ("2 clause bsd", "bsd"), ("3 clause bsd", "bsd"),
    ("redistribution and use in source and binary forms", "bsd"),
    ("permission is hereby granted free of charge to any person", "mit"),
    ("permission to use copy modify and or distribute this software for any purpose", "isc"),
    ("isc license", "isc"), ("licensed under the apache license", "apache"),
    ("lesser general public license", "lgpl"), ("library general public license", "lgpl"),
    ("affero general public license", "agpl"), ("mozilla public license", "mpl"), ("eclipse public license", "epl"),
    ("boost software license", "bsl"), ("this is free and unencumbered software released into the public domain", "unlicense"),
    ("released into the public domain", "public-domain"),
    ("creative commons attribution", "cc-by"), ("creative commons zero", "cc0"),
    ("cc by", "cc-by"), ("cc by sa", "cc-by-sa"), ("cc by nc", "cc-by-nc"), ("cc by nd", "cc-by-nd"),
    ("cc by nc sa", "cc-by-nc-sa"), ("cc by nc nd", "cc-by-nc-nd"), ("cc0", "cc0"),
    ("all rights reserved", "proprietary"),
)
#: tags that announce an expression, lower-cased
TAGS = ("spdx-license-identifier:", "license-expression:")

#: families of identifiers: prefix, label, obligation (0 none .. 1 all rights kept)
FAMILIES = (
    ("agpl", "agpl", 0.8), ("lgpl", "lgpl", 0.5), ("gpl", "gpl", 0.7), ("mpl", "mpl", 0.4), ("epl", "epl", 0.4),
    ("apache", "apache", 0.2), ("mit-0", "mit", 0.1), ("mit", "mit", 0.2), ("0bsd", "bsd", 0.1), ("bsd", "bsd", 0.2),
    ("bsl", "bsl", 0.2), ("isc", "isc", 0.2), ("unlicense", "unlicense", 0.0), ("cc0", "cc0", 0.0),
    ("cc-by-nc-nd", "cc-by-nc-nd", 0.9), ("cc-by-nc-sa", "cc-by-nc-sa", 0.9), ("cc-by-nc", "cc-by-nc", 0.9),
    ("cc-by-nd", "cc-by-nd", 0.6), ("cc-by-sa", "cc-by-sa", 0.5), ("cc-by", "cc-by", 0.2),
)
#: what an exception (``with``) takes off an obligation
EXCEPTION_RELIEF = 0.2
#: how far each kind of evidence is believed
BELIEF = {"expression": 0.95, "base": 0.8, "notice": 0.7, "tag": 0.4}

_KEEP = set(string.ascii_lowercase + string.digits)
#: bytes of a text with A-Z lower-cased / with all that is in no word as a blank besides
_LOWER = bytes(ord(chr(i).lower()) if i < 128 else i for i in range(256))
_WORDS = bytes(i if i >= 128 or chr(i) in _KEEP else 32 for i in _LOWER)
_TOKEN = re.compile(r"[ \t]*([()]|[a-z0-9][a-z0-9.+:_-]*)")

SPAN = "struct<kind:string,label:string,word:bigint>"
EXPRESSION = "struct<at:bigint,text:string,valid:boolean,labels:array<string>,obligation:double>"


# expressions ---------------------------------------------------------------------------------------

def family(identifier: str) -> tuple[str | None, float | None]:
    """Label and obligation of an identifier, (None, None) of an unknown one."""
    for prefix, label, obligation in FAMILIES:
        if identifier == prefix or identifier.startswith((prefix + "-", prefix + "+")):
            return label, obligation
    return None, None


_ORDER = {"or": 1, "and": 2, "with": 3}


def _apply(op: str, a: tuple, b: tuple) -> tuple:
    """(normal form, binding, labels, obligation) of two operands joined."""
    (ta, pa, la, oa), (tb, pb, lb, ob) = a, b
    p = _ORDER[op]
    if op == "with":                                   # the right side names an exception, not a licence
        return f"{ta} WITH {tb}", p, la, None if oa is None else max(0.0, round(oa - EXCEPTION_RELIEF, 6))
    known = [o for o in (oa, ob) if o is not None]
    # all of the terms hold with ``and``: the strictest counts; ``or`` leaves the choice
    o = (max if op == "and" else min)(known) if known and (op == "or" or len(known) == 2) else None
    text = [f"({t})" if q < p else t for t, q in ((ta, pa), (tb, pb))]
    return f"{text[0]} {op.upper()} {text[1]}", p, la | lb, o


def read_expression(text: str, at: int = 0) -> dict | None:
    """The expression that begins at ``at`` of a lower-cased text, on one line; None where there is none.

    Reading stops before the first token that cannot follow.  If what was read is no whole expression
    (an operator without its right side, an open bracket), it is not valid: it has the labels of the
    identifiers read and no obligation.
    """
    values: list[tuple] = []
    operators: list[str] = []
    names: list[str] = []
    wants, whole, begin = True, True, at

    def reduce():
        op = operators.pop()
        b, a = values.pop(), values.pop()
        values.append(_apply(op, a, b))

    while m := _TOKEN.match(text, at):
        t = m.group(1)
        if wants:
            if t == "(":
                if operators[-1:] == ["with"]:         # an exception is a name
                    break
                operators.append(t)
            elif t == ")" or t in _ORDER:
                break
            else:
                t = t.rstrip(".:_-") or t              # the end of a sentence is no part of a name
                names.append(t)
                label, obligation = family(t)
                values.append((t, 4, frozenset([label] if label and operators[-1:] != ["with"] else []), obligation))
                wants = False
                at = m.start(1) + len(t)
                continue
        elif t in _ORDER:
            while operators and operators[-1] != "(" and _ORDER[operators[-1]] >= _ORDER[t]:
                reduce()
            # an exception modifies one licence, not a bracket or another exception
            if t == "with" and values[-1][1] != 4:
                break
            operators.append(t)
            wants = True
        elif t == ")" and "(" in operators:
            while operators[-1] != "(":
                reduce()
            operators.pop()
            top = values.pop()
            values.append((top[0], min(top[1], 3), *top[2:]))
        else:
            break
        at = m.end()
    if not names:
        return None
    whole = not wants and "(" not in operators
    if whole:
        while operators:
            reduce()
        form, _, labels, obligation = values[0]
        return {"text": form, "valid": True, "labels": sorted(labels), "obligation": obligation, "end": at}
    found = {family(n)[0] for n in names} - {None}
    return {"text": text[begin:at].strip(), "valid": False, "labels": sorted(found), "obligation": None, "end": at}


# the scan ------------------------------------------------------------------------------------------

class Scanner:
    """Both automata; one per Python worker."""

    def __init__(self, notices=NOTICES, tags=TAGS):
        import ahocorasick
        self.phrases, self.tags = ahocorasick.Automaton(), ahocorasick.Automaton()
        by_phrase: dict[str, list] = {}
        for kind, table in (("base", BASE), ("notice", notices)):
            for phrase, label in table:
                by_phrase.setdefault(phrase, []).append((kind, label))
        for phrase, found in by_phrase.items():
            self.phrases.add_word(f" {phrase} ", (len(phrase) + 1, found))
        for tag in tags:
            self.tags.add_word(tag, len(tag))
        self.phrases.make_automaton()
        self.tags.make_automaton()

    def scan(self, text: bytes) -> tuple[int, list[dict], list[dict]]:
        """(words, spans by their first word, expressions by place) of a text in UTF-8."""
        words = text.translate(_WORDS).split()
        joined = f" {b' '.join(words).decode('latin-1')} "
        hits = sorted((end - length, i, found) for i, (end, (length, found)) in enumerate(self.phrases.iter(joined)))
        spans, seen, at = [], 0, 0
        for start, _, found in hits:                   # ``start``: the blank before the phrase
            seen += joined.count(" ", at, start)
            at = start
            spans += [{"kind": kind, "label": label, "word": seen} for kind, label in found]
        lower = text.translate(_LOWER).decode("latin-1")
        expressions = []
        for end, _ in self.tags.iter(lower):
            e = read_expression(lower, end + 1)
            if e:
                expressions.append({"at": end + 1, **{k: e[k] for k in ("text", "valid", "labels", "obligation")}})
        return len(words), spans, expressions


_SCANNER: list[Scanner] = []


def scan(docs: DataFrame) -> DataFrame:
    """``doc_id, n_words, spans, expressions`` of every document.

    A span has the number of its first word (from 0); an expression its byte, its normal form, whether
    it is whole, its labels and its obligation (null where a licence is unknown).  A null or empty text
    has no words.  Every row is scanned whole and alone, so repeated rows repeat their result; an empty
    table gives no rows.  Other columns are not read.
    """
    def run(batches):
        import pyarrow as pa
        if not _SCANNER:
            _SCANNER.append(Scanner())
        scanner = _SCANNER[0]
        span = pa.list_(pa.struct([("kind", pa.string()), ("label", pa.string()), ("word", pa.int64())]))
        expression = pa.list_(pa.struct([("at", pa.int64()), ("text", pa.string()), ("valid", pa.bool_()),
                                         ("labels", pa.list_(pa.string())), ("obligation", pa.float64())]))
        for b in batches:
            found = [scanner.scan(t.as_py() or b"") for t in b.column(1)]      # one text at a time in Python
            n, spans, expressions = zip(*found) if found else ((), (), ())
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array(n, pa.int64()), pa.array(spans, span), pa.array(expressions, expression)],
                ["doc_id", "n_words", "spans", "expressions"])
    return docs.select(F.col("doc_id").cast("bigint"), F.col("text").cast("string").cast("binary")).mapInArrow(
        run, f"doc_id bigint, n_words bigint, spans array<{SPAN}>, expressions array<{EXPRESSION}>")


def report(docs: DataFrame) -> DataFrame:
    """One row per document: counts, places and labels of its licence statements, and ``score``.

    ``score`` is how sure it is that the text states a licence: one minus the product of the doubts
    left by each distinct (kind, label).  ``obligation`` is the strictest of the valid expressions.
    Edge cases are those of ``scan``.
    """
    def joined(labels):
        return F.array_join(F.array_sort(F.array_distinct(labels)), ",")

    s = scan(docs)
    base = F.filter("spans", lambda x: x["kind"] == "base")
    words = F.transform(base, lambda x: x["word"])
    pairs = F.array_distinct(F.concat(
        F.transform("spans", lambda x: F.struct(x["kind"].alias("kind"), x["label"].alias("label"))),
        F.flatten(F.transform("expressions", lambda e: F.transform(
            F.when(F.size(e["labels"]) > 0, e["labels"]).otherwise(F.array(F.lit("other"))),
            lambda label: F.struct(F.when(e["valid"], "expression").otherwise("tag").alias("kind"), label.alias("label")))))))
    doubt = F.create_map(*[F.lit(v) for k, p in BELIEF.items() for v in (k, 1.0 - p)])
    return s.select(
        "doc_id", "n_words", F.size(base).cast("bigint").alias("n_base"),
        F.array_min(words).alias("first_word"), F.array_max(words).alias("last_word"),
        joined(F.transform(base, lambda x: x["label"])).alias("base_labels"),
        joined(F.transform(F.filter(pairs, lambda p: p["label"] != "other"), lambda p: p["label"])).alias("labels"),
        (F.lit(1.0) - F.aggregate(F.array_sort(pairs), F.lit(1.0), lambda acc, p: acc * doubt[p["kind"]])).alias("score"),
        F.size("expressions").cast("bigint").alias("n_expressions"),
        F.array_max(F.transform("expressions", lambda e: e["obligation"])).alias("obligation"))
