import random

import numpy as np
import pytest
from llm_corpus import corpus, words

from salesmart.llm.periodic_runs import Grammar, RunSettings, group_runs, judged, periodic_runs
from salesmart.llm.queries import repeating


def runs_of(text, least):
    """All runs, from every period by itself."""
    found = {}
    for period in range(1, len(text) // 2 + 1):
        i = 0
        while i + period < len(text):
            j = i
            while j + period < len(text) and text[j] == text[j + period]:
                j += 1
            if j + period - i >= max(least, 2 * period):
                found.setdefault((i, j + period), period)
            i = j + 1
    return sorted((start, end - start, period) for (start, end), period in found.items())


def collapsed(text, runs):
    gone = {i for start, length, period in runs for i in range(start + period, start + length)}
    return [w for i, w in enumerate(text) if i not in gone]


def random_text(chance, longest=120):
    text = [chance.randrange(chance.choice([1, 2, 3, 5, 30])) for _ in range(chance.randint(0, longest))]
    if text and chance.random() < 0.5:
        start = chance.randrange(len(text))
        period = 1 + chance.randrange(max(1, (len(text) - start) // 2))
        text = [text[i if i < start else start + (i - start) % period] for i in range(len(text))]
    return text


@pytest.mark.parametrize("least", [4, 12])
def test_equals_brute_force(least):
    chance = random.Random(least)
    for _ in range(60):
        texts = [random_text(chance) for _ in range(chance.randint(1, 10))]
        found = judged([[b"%d" % w for w in t] for t in texts], least)
        for text, (runs, body) in zip(texts, found, strict=True):
            assert [tuple(r) for r in runs.tolist()] == runs_of(text, least)
            assert body.split() == [b"%d" % w for w in collapsed(text, runs_of(text, least))]


def test_fibonacci_words_hold_many_overlapping_runs():
    a, b = [0], [0, 1]
    while len(b) < 600:
        a, b = b, b + a
    runs = group_runs([np.array(b)], 4)
    assert [tuple(r[1:]) for r in runs.tolist()] == runs_of(b, 4) and len(runs) > 100


def test_extensions_to_both_sides():
    chance = random.Random(5)
    texts = [random_text(chance, 80) or [1] for _ in range(6)]
    marks = len(texts) + 1
    flat, spots, at = [0], [], 1
    for mark, text in enumerate(texts, 1):
        spots += [(at + i, at + j) for i in range(len(text)) for j in range(i + 1, len(text))]
        flat += [w + marks for w in text] + [mark]
        at += len(text) + 1
    symbols = np.array(flat)
    grammar = Grammar(symbols, marks)
    one, other = np.array(spots).T
    for step in (1, -1):
        for i, j, length in zip(one, other, grammar.extension(one, other, step), strict=True):
            plain = 0
            while symbols[i + step * plain] == symbols[j + step * plain]:
                plain += 1
            assert plain == length


def test_grammar_of_one_repeated_word_is_shallow():
    symbols = np.array([0, *[2] * 100_000, 1])
    assert len(Grammar(symbols, 2).levels) == 1


def test_documents(spark, documents):
    """Nulls, blanks, a very long text, repeated rows and ids, more columns."""
    found = periodic_runs(documents, RunSettings(least=4)).collect()
    wanted = []
    for doc_id, text, *_ in corpus():
        w = words(text)
        runs = runs_of(w, 4) if len(w) < 1000 else None
        wanted.append((doc_id, len(w), runs, " ".join(collapsed(w, runs)) if runs is not None else None))
    plain = [
        (r["doc_id"], r["n_words"], [tuple(x) for x in r["runs"]] if r["n_words"] < 1000 else None,
         r["collapsed_text"] if r["n_words"] < 1000 else None)
        for r in found
    ]
    assert sorted(plain, key=repr) == sorted(wanted, key=repr)


def test_no_rows(nothing):
    assert periodic_runs(nothing).count() == 0


def test_a_very_long_run(spark):
    text = " ".join(["head"] + ["a b c"] * 30_000)
    row = periodic_runs(spark.createDataFrame([(1, text)], "doc_id INT, text STRING")).first()
    assert [tuple(r) for r in row["runs"]] == [(1, 90_000, 3)] and row["collapsed_text"] == "head a b c"


def test_repeating_takes_a_tenth_and_leaves_the_rest(spark):
    rows = [(i, " ".join(f"w{i}x{j}" for j in range(40))) for i in range(200)]
    rows += [(i, t) for i, t in enumerate([None, "", " "])]
    found = repeating(spark.createDataFrame([*rows, (None, "a")], "doc_id LONG, text STRING")).collect()
    changed = sum(a[1] != b["text"] for a, b in zip(rows, found, strict=False))
    assert 10 <= changed <= 40 and found[-1]["text"] == "a" and len(found) == 204
