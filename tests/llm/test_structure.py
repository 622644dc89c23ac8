"""Merkle manifest, conversation repair and licence scan against brute force."""

import hashlib
import itertools
import random
import re
import zlib

import numpy as np
import pytest

from perilscope.llm import licenses, merkle, queries, repair
from tests.llm import data


# merkle manifest -----------------------------------------------------------------------------------

def sha(s):
    return hashlib.sha256(s.encode()).hexdigest()


def leaf_of(doc_id, source, lang, n_chars, text):
    return sha("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in (doc_id, source, lang, n_chars, text)))


def tree(nodes):
    """(root, the siblings of every leaf as (left, right), lowest first)."""
    paths, at = [[] for _ in nodes], list(range(len(nodes)))
    while len(nodes) > 1:
        for i, a in enumerate(at):
            run = nodes[a // 2 * 2:a // 2 * 2 + 2]
            paths[i].append(("".join(run[:a % 2]), "".join(run[a % 2 + 1:])))
            at[i] = a // 2
        nodes = [sha("".join(nodes[i:i + 2])) for i in range(0, len(nodes), 2)]
    return nodes[0], paths


def brute_manifest(rows):
    """Sorted result rows from (doc_id, text, lang, source, n_chars)."""
    groups = {}
    for doc_id, text, lang, source, n in rows:
        chosen = doc_id is not None and n is not None and zlib.crc32(str(doc_id).encode()) % 7 == 0
        leaf = leaf_of(doc_id, source, lang, n, text)
        groups.setdefault(lang, []).append((doc_id, leaf, leaf_of(doc_id, source, lang, n + 1, text) if chosen else leaf))
    langs = sorted(groups, key=lambda x: (x is not None, (x or "").encode()))
    trees = {}
    for g in langs:
        groups[g].sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1]))
        trees[g] = tree([r[1] for r in groups[g]])
    root, tops = tree([trees[g][0] for g in langs])
    out = []
    for g, top in zip(langs, tops):
        for (doc_id, leaf, used), path in zip(groups[g], trees[g][1]):
            folded = used
            for left, right in path + top:
                folded = sha(left + folded + right)
            out.append((doc_id, leaf, trees[g][0], root, sha("".join(a + b for a, b in path + top)), folded, folded == root))
    return sorted(out, key=repr)


def manifest_rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


@pytest.mark.parametrize("segment", [1, 2, 8])
def test_manifest_of_awkward_rows(spark, segment):
    d = data.clashing(spark).repartition(4)
    got = merkle.manifest(d, segment=segment)
    assert got.columns == ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]
    assert manifest_rows(got) == brute_manifest(data.awkward_rows())


def test_manifest_of_the_table_and_its_records(spark):
    d = spark.read.parquet(f"{data.SF}/documents.parquet")
    rows = [tuple(r) for r in d.select(*COLUMNS).collect()]
    got = manifest_rows(queries.QUERIES["op11_merkle_manifest"](spark, data.SF))
    assert got == brute_manifest(rows) and {r[-1] for r in got} == {True, False}
    m = merkle.Manifest(d, segment=3)
    for r in m.records.collect():                      # a digest is that of its children
        levels = merkle.raise_levels(list(r["levels"][0]), len(r["levels"]), 2)
        assert levels[-1][0] == r["digest"] and levels[:-1] == [list(x) for x in r["levels"]]
    assert m.root.first()["digest"].hex() == got[0][3]


def test_manifest_small_tables(spark):
    assert merkle.manifest(data.empty(spark)).count() == 0
    one = spark.createDataFrame([(5, "x", None, None, None)], data.SCHEMA)
    r = merkle.manifest(one).first()
    assert r["leaf"] == r["subroot"] == r["root"] == r["folded_root"] and r["proof_sha256"] == sha("") and r["verified"]


def test_manifest_equal_rows_are_split_and_share_records(spark):
    rows = [(None, None, None, None, None)] * 700 + [(i, "t%d" % i, "en", "s", i) for i in range(500)]
    d = spark.createDataFrame(rows, data.SCHEMA).repartition(6)
    assert manifest_rows(merkle.manifest(d, segment=2)) == brute_manifest(rows)
    m = merkle.Manifest(d, segment=2)
    assert m.docs.records.count() < 200 + 60 and m.docs.blocks.count() == 175 + 125
    ranks = merkle.ranked(merkle.leaves(d), "lang", ["doc_id", "leaf"], "t").select("lang", "rank", "n").collect()
    assert sorted(r["rank"] for r in ranks if r["lang"] is None) == list(range(700))
    assert {(r["lang"], r["n"]) for r in ranks} == {(None, 700), ("en", 500)}


def test_manifest_long_text(spark):
    rows = [(1, "é" * 1_500_000, "en", "s", 1_500_000), (2, "x", "en", "s", 2 ** 63 - 1), (21, "y", "en", "s", 2 ** 63 - 1)]
    got = {r["doc_id"]: r for r in merkle.manifest(spark.createDataFrame(rows, data.SCHEMA)).collect()}
    assert got[1]["leaf"] == leaf_of(1, "s", "en", 1_500_000, rows[0][1]) and len(got) == 3


# conversation repair -------------------------------------------------------------------------------

def crc(conv, turn):
    return zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20


def damage(rows):
    out = []
    for conv, turn, role, text in rows:
        f, role, text = crc(conv, turn), " " if role is None else role, " " if text is None else text
        if f == 0:
            continue
        if f == 1:
            text = ""
        if f == 2:
            text = re.sub("[.!?]", "", text)
        if f == 4:
            role = "user"
        out += [(conv, turn, role, text)] * (2 if f == 3 else 1)
    return out


def cheapest(cells):
    """Least (cost, audit) over all edits, from the end: cells are (initial, status)."""
    after = {0: {"s": 1, "u": 2}, 1: {"u": 2}, 2: {"a": 3}, 3: {"u": 2}}
    give = {0: 2, 1: 2, 2: 3, 3: 2}

    def with_inserts(best):
        for _ in range(3):
            for q in range(4):
                if give[q] in best:
                    c, s = best[give[q]]
                    best[q] = min(best.get(q, (c + 3, "~")), (c + 2, "I" + s))
        return best
    best = with_inserts({0: (0, ""), 3: (0, "")})
    for initial, status in reversed(cells):
        now = {}
        for q in range(4):
            options = [(best[q][0] + 3, "D" + best[q][1])] if q in best else []
            if status in ("ok", "truncated"):
                extra = status == "truncated"
                if initial in after[q] and after[q][initial] in best:
                    c, s = best[after[q][initial]]
                    options.append((c + extra, "K" + s))
                if give[q] in best:
                    c, s = best[give[q]]
                    options.append((c + 2 + extra, "R" + s))
            if options:
                now[q] = min(options)
        best = with_inserts(now)
    return best[0]


def brute_repair(rows):
    out = []
    for conv in {r[0] for r in rows}:
        mine = sorted((r for r in damage(rows) if r[0] == conv), key=lambda r: (
            r[1] is not None, r[1] or 0, hashlib.sha256(f"{len(r[2])}:{r[2]}{r[3]}".encode()).digest()))
        seen, cells = set(), []
        for _, _, role, text in mine:
            ink = re.findall(r"[^\x20\x09-\x0D]", text)
            status = ("blank" if not ink else "duplicate" if (role, text) in seen
                      else "truncated" if ink[-1] not in ".!?" else "ok")
            seen.add((role, text))
            cells.append((role[:1], status))
        turns = [r[1] for r in mine if r[1] is not None]
        cost, audit = cheapest(cells)
        lines, last, i = [], "", 0
        for e in audit:
            role, text = ("", "") if e == "I" else mine[i][2:]
            i += e != "I"
            if e == "D":
                continue
            if e != "K":
                role = "assistant" if last == "u" else "user"
            lines.append(f"{role}:{text}")
            last = role[:1]
        count = [s for _, s in cells].count
        illegal = sum(a[0] + b[0] not in ("su", "ua", "au") for a, b in zip(cells, cells[1:]))
        out.append((conv, max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0, count("blank"), count("duplicate"),
                    count("truncated"), illegal, cost, audit, sha("\n".join(lines))))
    return sorted(out, key=repr)


CONV = "conv_id bigint, turn bigint, role string, text string"


def repaired(spark, rows, **kw):
    df = spark.createDataFrame(rows, CONV).repartition(5)
    return sorted((tuple(r) for r in repair.repair(df, **kw).collect()), key=repr)


def some_conversations(seed, n=60, longest=12):
    r = random.Random(seed)
    texts = ["Yes.", "No", "why?", "", " \t", "a b c!", "well... ", None, "é.", "long " * 50 + "."]
    rows = []
    for c in range(n):
        for t in range(r.randint(1, longest)):
            rows.append((c if c else None, r.choice([t, t, t, t, None, t // 2, t * 3]), r.choice(
                ["user", "assistant", "user", "assistant", "system", "tool", None, "", "Users", "aide"]), r.choice(texts)))
    return rows + rows[::17]


@pytest.mark.parametrize("piece_cells", [1, 3, repair.PIECE])
def test_repair_against_all_edits(spark, piece_cells):
    rows = some_conversations(piece_cells)
    assert repaired(spark, rows, piece_cells=piece_cells) == brute_repair(rows)


def test_repair_of_the_table(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{data.SF}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    got = queries.QUERIES["op12_conversation_repair"](spark, data.SF)
    assert sorted((tuple(r) for r in got.collect()), key=repr) == brute_repair(rows)


def test_repair_of_a_hot_conversation(spark):
    """A conversation with most rows, many of them equal, spans partitions and pieces."""
    r = random.Random(8)
    rows = [(7, t, ["user", "assistant"][t % 2], r.choice(["same.", "same.", f"text {t}.", f"cut {t}"])) for t in range(1500)]
    rows += [(7, None, "user", "again.")] * 300 + some_conversations(4, 20)
    assert repaired(spark, rows, piece_cells=100) == brute_repair(rows)


def test_repair_edges(spark):
    nothing = spark.createDataFrame([], CONV)
    assert repair.repair(nothing).count() == 0
    lost = next(c for c in range(1000) if crc(c, 0) == 0)
    whole = next(c for c in range(1000) if crc(c, 2 ** 62) > 4 and crc(c, -2 ** 62) > 4 and crc(c, None) > 4)
    rows = [(lost, 0, "user", "Hi."), (whole, 2 ** 62, "user", "x" * 3_000_000 + "."), (whole, -2 ** 62, "system", "Go."), (whole, None, None, "a.")]
    got = {r[0]: r for r in repaired(spark, rows)}
    assert got[lost] == (lost, 0, 0, 0, 0, 0, 0, "", sha(""))
    assert got[whole][1] == 2 ** 63 - 1 and [got[whole]] == [x for x in ((*b[:1], 2 ** 63 - 1, *b[2:]) for b in brute_repair(rows)) if x[0] == whole]
    clash = spark.createDataFrame([(1, 0, "user", "Hi."), (1, 1, "assistant", "Yes.")], CONV)
    more = clash.selectExpr("*", "1 as p", "2 as kind", "'x' as digest", "3 as n", "4 as times", "5 as part")
    assert repair.repair(more).collect() == repair.repair(clash).collect()


def test_ranks_order_the_least_strings():
    r = np.random.default_rng(5)
    cells = r.integers(0, 16, 400).astype(np.int64)
    off = np.array([0, 1, 1 + 37, 1 + 37 + 260, 400])
    end = np.broadcast_to(repair.final_end(), (4, 4))
    cost = repair.costs(cells, off, end[:, :, None])[:, :, 0]
    target, good = repair.optimal(cells, off, cost, np.ones(4, bool))
    letter, pointers, rank = repair.rank_paths(target, good)
    begin = np.flatnonzero(letter >= 0)
    strings, ends = repair.read_paths(letter, pointers, begin)
    assert (letter[ends] == 0).all() and all(b"\0" not in s for s in strings)
    order = sorted(range(len(begin)), key=lambda i: strings[i])
    for i, j in itertools.pairwise(order):
        assert (rank[i] < rank[j]) == (strings[i] < strings[j])


# licence scan --------------------------------------------------------------------------------------

BASE = {"mit license": "mit", "apache license": "apache", "general public license": "gpl"}


def brute_base(text):
    low = "".join(c.lower() if c.isascii() else c for c in text or "")
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low)
    places = sorted((i, lab) for p, lab in BASE.items() for i in range(len(words)) if words[i:i + len(p.split())] == p.split())
    return (len(words), len(places), places[0][0] if places else None, places[-1][0] if places else None,
            ",".join(sorted({lab for _, lab in places})))


TEXTS = [None, "", " \n", "MIT License", "the mit-LICENSE, mit license; apache\x00license general\npublic license license",
         "mit licenses and mité license é mit license", "GNU Lesser General Public License", "mit mit license license",
         "x " * 700_000 + "Apache License " + "é" * 1000 + " general public  license",
         "// SPDX-License-Identifier: (MIT OR Apache-2.0) AND GPL-2.0-only WITH Classpath-exception-2.0\nint x;",
         "Licensed under CC BY-NC 4.0."]


def test_scan_against_word_lists(spark):
    rows = [(i, t, "en", "s", 0) for i, t in enumerate(TEXTS)] + [(None, "mit license", None, None, None)] * 2
    d = spark.createDataFrame(rows, data.SCHEMA).selectExpr("*", "1 as spans", "'q' as score", "2 as n_words", "3 as labels")
    got = licenses.report(d).collect()
    assert len(got) == len(rows) and licenses.report(data.empty(spark)).count() == 0
    for r in got:
        text = "mit license" if r["doc_id"] is None else TEXTS[r["doc_id"]]
        assert tuple(r[c] for c in ("n_words", "n_base", "first_word", "last_word", "base_labels")) == brute_base(text), text[:80]
        assert set(r["base_labels"].split(",")) - {""} <= set(r["labels"].split(",")) and 0 <= r["score"] <= 1
    by = {r["doc_id"]: r for r in got}
    assert by[9]["labels"] == "apache,gpl,mit" and by[9]["n_base"] == 0 and by[9]["obligation"] == pytest.approx(0.5)
    assert by[10]["labels"] == "cc-by,cc-by-nc" and by[6]["labels"] == "gpl,lgpl"
    assert by[9]["score"] > by[3]["score"] > by[10]["score"] * 0 == by[0]["score"]


def test_scan_of_the_table(spark):
    texts = dict(data_rows("documents", "doc_id, text"))
    got = queries.QUERIES["op13_license_scan"](spark, data.SF).collect()
    assert len(got) == len(texts) and sum(r["n_base"] for r in got) > 0
    for r in got:
        assert tuple(r[c] for c in ("n_words", "n_base", "first_word", "last_word", "base_labels")) == brute_base(texts[r["doc_id"]])


def data_rows(name, columns):
    import duckdb
    return duckdb.sql(f"select {columns} from '{data.SF}/{name}.parquet'").fetchall()


def brute_obligation(e):
    """Nested (op, a, b) | identifier -> the strictest of what has to hold, by listing every choice."""
    if isinstance(e, str):
        return [[licenses.family(e)[1]]]
    op, a, b = e
    if op == "with":
        return [[round(x - licenses.EXCEPTION_RELIEF, 6) if (x := brute_obligation(a)[0][0]) > 0.2 else max(0, round(x - 0.2, 6))]]
    left, right = brute_obligation(a), brute_obligation(b)
    return left + right if op == "or" else [x + y for x in left for y in right]


def shown(e, r):
    if isinstance(e, str):
        return r.choice([e, e.upper(), e.title()])
    op, a, b = e
    return f"({shown(a, r)}) {op} ( {shown(b, r)} )" if op != "with" else f"{shown(a, r)} WITH {b}"


def test_expressions_against_listed_choices():
    r = random.Random(2)
    names = ["mit", "gpl-2.0-only", "apache-2.0", "lgpl-2.1+", "mpl-2.0", "cc-by-nc-4.0", "bsd-3-clause"]

    def grow(depth):
        if depth == 0 or r.random() < 0.2:
            n = r.choice(names)
            return ("with", n, "some-exception") if r.random() < 0.2 else n
        return (r.choice(["and", "or"]), grow(depth - 1), grow(depth - 1))
    for _ in range(300):
        e = grow(3)
        got = licenses.read_expression(shown(e, r).lower())
        assert got["valid"] and got["obligation"] == pytest.approx(min(max(c) for c in brute_obligation(e)))
        again = licenses.read_expression(got["text"].lower())
        assert {k: again[k] for k in ("text", "labels", "obligation")} == {k: got[k] for k in ("text", "labels", "obligation")}


@pytest.mark.parametrize("text,form,valid", [
    ("mit or apache-2.0 and gpl-3.0", "mit OR apache-2.0 AND gpl-3.0", True),
    ("(mit or apache-2.0) and gpl-3.0", "(mit OR apache-2.0) AND gpl-3.0", True),
    ("mit. the rest", "mit", True), ("mit or", "mit or", False), ("(mit", "(mit", False), ("mit)", "mit", True),
    ("gpl-2.0 with a with b", "gpl-2.0 WITH a", True), ("mit with (b)", "mit with", False),
    ("mit\nor gpl-2.0", "mit", True), ("nothing-known", "nothing-known", True)])
def test_expression_forms(text, form, valid):
    got = licenses.read_expression(text)
    assert (got["text"], got["valid"]) == (form, valid)


def test_no_expression():
    assert licenses.read_expression("") is None and licenses.read_expression("or mit") is None
