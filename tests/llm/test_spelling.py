"""Spelling variants against a plain version, and the neighbourhoods against all strings."""

import itertools
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from compare import connect, differences
from hypothesis import given, settings
from hypothesis import strategies as st

from paytrail.llm import queries, spelling

SCHEMA = "doc_id long, text string, word string"
LOWER = {code: code + 32 for code in range(65, 91)}


def plain(rows):
    """(word, form, root, n, n_near, form_n) by comparing all pairs of words."""
    counts = Counter()
    for doc_id, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = run.translate(LOWER)
            sign = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            if sign % 97 == 0:
                run = run[: sign % len(run)] + run[sign % len(run) + 1 :]
            counts[run] += 1
    known = {w: n for w, n in counts.items() if len(w) >= 5 and n >= 3}

    def near(a, b):
        if a == b or abs(len(a) - len(b)) > 1:
            return False
        if len(a) == len(b):
            return sum(x != y for x, y in zip(a, b, strict=True)) == 1
        long, short = (a, b) if len(a) > len(b) else (b, a)
        return any(long[:i] + long[i + 1 :] == short for i in range(len(long)))

    form, n_near = {}, {}
    for word, n in known.items():
        found = [w for w in known if near(word, w)]
        n_near[word] = len(found)
        best = min(found, key=lambda w: (-known[w], w), default=None)
        form[word] = best if best and known[best] >= 2 * n else None
    result = set()
    for word in known:
        root = word
        while form[root]:
            root = form[root]
        result.add((word, form[word], root, known[word], n_near[word], known.get(form[word])))
    return result


def found(spark, table, rows):
    docs = table([(d, t, "clash") for d, t in rows], SCHEMA)
    return sorted(map(tuple, spelling.variants(docs).collect()), key=repr)


def test_a_plain_version_agrees(spark, table):
    rng = np.random.default_rng(3)
    base = ["colour", "colours", "color", "harbour", "école", "ÉCOLE", "straße", "strasse", "naïve", "×÷ababa", "aaaaa", "aaaaaa"]
    rows = []
    for doc_id in range(120):
        words = []
        for word in rng.choice(base, 40, p=np.arange(1, 13) / 78):
            at = rng.integers(len(word))
            words.append({0: word[:at] + word[at + 1 :], 1: word[:at] + "z" + word[at:]}.get(rng.integers(9), word))
        rows.append((doc_id, " ,中3".join(words)))
    expected = plain(rows)
    assert len(expected) > 50 and any(row[1] and row[1] != row[2] for row in expected)
    assert found(spark, table, rows) == sorted(expected, key=repr)


def test_ties_nulls_repeats_and_long_texts(spark, table):
    rows = [
        (1, "abcde " * 3 + "abcdf " * 6 + "abcdg " * 6), (None, "nullid " * 4), (None, None), (2, ""), (3, "12 !?"),
        (4, "twice twice"), (4, "twice twice"), (5, "longword " * 300_000), (6, ("x" * 5000 + " ") * 3),
    ]
    result = found(spark, table, rows)
    assert result == sorted(plain(rows), key=repr)
    by_word = {row[0]: row for row in result}
    assert by_word["abcde"][1:] == ("abcdf", "abcdf", 3, 2, 6)
    assert by_word["twice"][3] == 4 and by_word["longword"][3] == 300_000


def test_an_empty_table_has_no_words(spark, table):
    assert found(spark, table, []) == []
    assert found(spark, table, [(1, "a few short words")]) == []


def test_one_frequent_word_is_a_few_rows_before_the_shuffle(spark, table):
    docs = table([(i, "common common common") for i in range(4000)], "doc_id long, text string")
    assert [tuple(r)[3] for r in spelling.variants(docs).collect() if r.word == "common"][0] > 11_000


@pytest.mark.parametrize("length", [1, 2, 3, 5])
def test_neighbourhoods_are_full_and_without_repeats(length):
    symbols = 3
    for word in itertools.product(range(1, symbols + 1), repeat=length):
        made = spelling.neighbourhood(np.array(word, np.uint64), symbols)
        edits = {word}
        for i in range(length):
            edits.add(word[:i] + word[i + 1 :])
            edits |= {word[:i] + (s,) + word[i + 1 :] for s in range(1, symbols + 1)}
        for i in range(length + 1):
            edits |= {word[:i] + (s,) + word[i:] for s in range(1, symbols + 1)}
        codes = {int(spelling.code(np.array(e, np.uint64), symbols)) for e in edits}
        assert len(codes) == len(edits) == len(made) and set(made.tolist()) == codes


@settings(max_examples=200, deadline=None)
@given(st.text("abcdeéÿ", min_size=1, max_size=30), st.data())
def test_one_edit_of_a_word_is_in_the_neighbourhood(word, data):
    at = data.draw(st.integers(0, len(word)))
    letter = data.draw(st.sampled_from("abzß"))
    edited = data.draw(st.sampled_from([word[:at] + letter + word[at:], word[:at] + letter + word[at + 1 :], word[:at] + word[at + 1 :]]))
    if edited:
        one, two = spelling.reduced([word, edited], spelling.SYMBOLS)
        assert spelling.code(two, spelling.SYMBOLS) in spelling.neighbourhood(one, spelling.SYMBOLS)


def test_the_query_equals_its_sql(spark, sf_dir):
    name = "op11_spelling_variants"
    assert differences(connect(sf_dir), queries.ORACLES[name], queries.QUERIES[name](spark, sf_dir)) == []
