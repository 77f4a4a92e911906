import itertools
import random
import time
from collections import defaultdict

import pytest
from llm_corpus import corpus, words
from pyspark.sql import functions as F

from salesmart.llm.mixing import capped_targets, mixed, routed, word_count


def test_targets_stop_and_are_dealt_again():
    sizes = {"b": 100, "a": 10, None: 1000}
    # Order a, b, null with weights 3, 1, 2; 1665 to share: a stops at 20, b at 200.
    assert capped_targets(sizes, (3, 1, 2), 1.5, 2) == {"a": 20.0, "b": 200.0, None: pytest.approx(1445)}
    assert capped_targets({"a": 0, "b": 5}, (1,), 1.5, 2) == {"a": 0.0, "b": pytest.approx(7.5)}
    assert capped_targets({}, (1,), 1.5, 2) == {}


def test_flow_serves_overlapping_sources_with_few_repeats():
    patterns = [(frozenset({"a"}), 100), (frozenset({"a", "b"}), 100), (frozenset({"b"}), 10)]
    given = routed(patterns, {"a": 100, "b": 110}, 2)
    assert sum(given) == 210 and given == [100, 100, 10]  # nothing twice
    given = routed(patterns, {"a": 150, "b": 150}, 2)
    assert sum(given) == 300 and all(g <= 2 * w for g, (_, w) in zip(given, patterns, strict=True))
    # The convex costs: all first copies are used before any second one.
    assert all(g >= w for g, (_, w) in zip(given, patterns, strict=True))


def test_flow_is_the_cheapest_of_the_largest():
    """On small random graphs, against all choices of words that the quotas can take."""
    chance = random.Random(2)
    for _ in range(150):
        quotas = {s: chance.randint(0, 5) for s in "abc"[: chance.randint(1, 3)]}
        subsets = [frozenset(c) for n in range(1, len(quotas) + 1) for c in itertools.combinations(quotas, n)]
        patterns = [(m, chance.randint(0, 3)) for m in chance.sample(subsets, min(len(subsets), chance.randint(1, 4)))]
        copies = chance.randint(1, 3)

        def fits(taken, patterns=patterns, quotas=quotas):
            """Hall: the words of any patterns are no more than the quotas of their sources."""
            picks = itertools.chain.from_iterable(itertools.combinations(range(len(taken)), n) for n in range(1, len(taken) + 1))
            return all(sum(taken[i] for i in p) <= sum(quotas[s] for s in set().union(*(patterns[i][0] for i in p))) for p in picks)

        def rating(taken, patterns=patterns):
            # The k-th copy of a pattern costs k a word.
            cost = sum(sum(j // w for j in range(t)) for t, (_, w) in zip(taken, patterns, strict=True) if w)
            return -sum(taken), cost

        choices = itertools.product(*(range(copies * w + 1) for _, w in patterns))
        best = min(rating(t) for t in choices if fits(t))
        given = routed(patterns, quotas, copies)
        assert fits(given) and rating(given) == best


def test_many_sources_and_overlaps_take_seconds():
    began = time.perf_counter()
    assert routed([(frozenset({i}), 10) for i in range(100_000)], {i: 15 for i in range(100_000)}, 2) == [15] * 100_000
    chance = random.Random(3)
    overlapping = [(frozenset(f"s{n}" for n in chance.sample(range(300), 2)), chance.randint(1, 50)) for _ in range(2000)]
    quotas = {f"s{n}": 150 for n in range(300)}
    given = routed(overlapping, quotas, 2)
    assert all(0 <= g <= 2 * w for g, (_, w) in zip(given, overlapping, strict=True)) and sum(given) > 40_000
    assert time.perf_counter() - began < 30


def test_each_source_comes_near_its_target(documents):
    rows = mixed(documents, F.array("source"), word_count(), (3, 1, 2)).collect()
    again = mixed(documents, F.array("source"), word_count(), (3, 1, 2)).collect()
    assert sorted(map(repr, rows)) == sorted(map(repr, again)) and len(rows) == len(corpus())
    sizes, longest = defaultdict(int), defaultdict(int)
    for _, text, source, *_ in corpus():
        sizes[source] += len(words(text))
        longest[source] = max(longest[source], len(words(text)))
    targets = capped_targets(sizes, (3, 1, 2), 1.5, 2)
    taken = defaultdict(int)
    for r in rows:
        source = r["pattern"][0]
        assert 0 <= r["taken"] <= 2 * r["size"] and r["source_size"] == sizes[source]
        assert r["target"] == pytest.approx(targets[source])
        taken[source] += r["taken"]
    for source, target in targets.items():
        assert abs(taken[source] - target) <= longest[source] / 2 + 1


def test_a_document_of_two_sources(spark):
    df = spark.createDataFrame([(i, ["x", "y"] if i % 2 else ["y"], 10) for i in range(40)], "doc_id INT, s ARRAY<STRING>, n INT")
    rows = mixed(df, "s", F.col("n"), (1, 1), share=0.5).collect()
    assert sum(r["taken"] for r in rows) == 300 and {r["copies"] for r in rows} <= {0, 1, 2}


def test_no_rows(nothing):
    assert mixed(nothing, F.array("source"), word_count(), (1,)).count() == 0


def test_too_many_patterns(documents):
    with pytest.raises(ValueError, match="membership patterns"):
        mixed(documents, F.array("source"), word_count(), (1,), max_patterns=2)


def test_many_single_sources_in_tables(documents, nothing):
    few, many = (
        mixed(documents, F.array("source"), word_count(), (3, 1, 2), driver_patterns=n).collect() for n in (100, 0)
    )
    assert len(few) == len(corpus()) and sorted(map(repr, few)) == sorted(map(repr, many))
    assert mixed(nothing, F.array("source"), word_count(), (1,), driver_patterns=0).count() == 0


def test_only_overlaps_go_to_the_driver(spark):
    """Forty sources of their own beside three patterns that share two."""
    rows = [(i, [f"s{i % 40}"], i % 9) for i in range(400)] + [(400 + i, [["x"], ["x", "y"], ["y"]][i % 3], 10) for i in range(90)]
    df = spark.createDataFrame(rows, "doc_id INT, s ARRAY<STRING>, n INT")
    few, many = (mixed(df, "s", F.col("n"), (5, 1, 2), driver_patterns=n).collect() for n in (100, 3))
    assert len(few) == len(rows) and sorted(map(repr, few)) == sorted(map(repr, many))
    with pytest.raises(ValueError, match="overlapping membership patterns"):
        mixed(df, "s", F.col("n"), (5, 1, 2), driver_patterns=2)
