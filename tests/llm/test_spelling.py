"""Spelling variants against brute force, and their defined cases."""

import re
import zlib
from collections import Counter

from hypothesis import given, settings
from hypothesis import strategies as st

from quarryline.llm import spelling

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def brute_words(docs, min_letters=6, min_count=5):
    found = Counter()
    for doc_id, text in docs:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(c.lower() if c.isascii() else c for c in run)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            found[run[: h % len(run)] + run[h % len(run) + 1 :] if h % 199 == 0 else run] += 1
    return {w: n for w, n in found.items() if len(w) >= min_letters and n >= min_count}


def is_near(a, b):
    if len(a) > len(b):
        a, b = b, a
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    return len(b) == len(a) + 1 and any(b[:k] + b[k + 1 :] == a for k in range(len(b)))


def brute(docs):
    words = brute_words(docs)
    near = {w: sorted((v for v in words if is_near(w, v)), key=lambda v: (-words[v], v)) for w in words}
    form = {w: next((v for v in near[w][:1] if words[v] >= 5 * words[w]), None) for w in words}
    out = set()
    for w in words:
        root = w
        while form[root]:
            root = form[root]
        out.add((w, form[w], root, words[w], len(near[w]), words.get(form[w])))
    return out


def got(spark, docs):
    df = spark.createDataFrame([(i, t, "en", "s", 0) for i, t in docs], SCHEMA).selectExpr("*", "'x' as word", "'x' as id", "1 as n", "'x' as root")
    rows = spelling.variants(df).collect()
    assert len(rows) == len({r.word for r in rows})
    return {tuple(r) for r in rows}


@settings(max_examples=80, deadline=None)
@given(st.lists(st.text(alphabet="abé", max_size=9), max_size=12))
def test_deletion_keys(words):
    of, keys = spelling.deletion_keys(words)
    strings = {}
    want = [{w} | {w[:k] + w[k + 1 :] for k in range(len(w))} for w in words]
    assert [sum(1 for x in of if x == k) for k in range(len(words))] == [len(s) for s in want]
    for k in range(len(words)):
        strings[k] = {int(x) for x in keys[of == k]}
    for a in range(len(words)):
        for b in range(len(words)):
            assert bool(strings[a] & strings[b]) == bool(want[a] & want[b])


def test_variants_equal_brute_force(spark):
    docs = [(k, "straße " * 40 + "strase strasse strassen strassen " * (k % 4) + "Ünderword underword underwort " * 3 + "naïvely naively ") for k in range(40)]
    docs += [(None, "colour " * 9 + "color colours colourss " * 6), (None, "colour " * 9 + "color colours colourss " * 6), (7, None), (8, ""), (9, "42 -- !!"), (10, "ÉCOLES écoles école×s " * 30)]
    docs += [(100 + k, "banana bananna bannana anana " + "bananas " * (2 + k)) for k in range(30)]
    assert got(spark, docs) == brute(docs)


def test_chain_of_forms_and_ties(spark):
    # a form's form's form: counts rise fivefold at each step; two near words of one count tie by code points
    docs = [(k, " ".join(["chainaa"] * 1 + ["chainab"] * 5 + ["chainbb"] * 25 + ["chaincb"] * 125 + ["tiewora"] * 30 + ["tieworz"] * 30 + ["tiewor"] * 1)) for k in range(6)]
    rows = got(spark, docs)
    assert rows == brute(docs)
    assert {r[0]: r[2] for r in rows}["chainaa"] == "chaincb"


def test_words_of_many_letters(spark):
    # words of 30,000 letters, two of them apart by one letter; a word costs a key a letter, not a copy
    long = "ab" * 15_000
    docs = [(k, f"{long} {long[:-1]}z {long}q zz{long}") for k in range(8)]
    rows = got(spark, docs)
    assert {(r[0][-1], len(r[0])): r[4] for r in rows if r[3] >= 5} == {("b", 30_000): 2, ("z", 30_000): 1, ("q", 30_001): 1, ("b", 30_002): 0}


def test_empty_table(spark):
    assert got(spark, []) == set()
    assert got(spark, [(1, None), (None, None)]) == set()
