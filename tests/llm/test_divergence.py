import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest

from salesmart.llm import divergence, perfect_hash
from salesmart.llm.divergence import DivergenceSettings, Recount, kept_terms, recounted, rounds_of, source_divergence, terms_of
from salesmart.llm.perfect_hash import PerfectHash, built, key_hashes
from salesmart.llm.tables import Workspace

DOCUMENTS = "doc_id LONG, text STRING, lang STRING, source STRING, term STRING, slot INT, n STRING, p DOUBLE"
TERM = re.compile("[^\x00-\x40\x5b-\x60\x7b-\x7f]+")


def plain_terms(text):
    return ["".join(c.lower() if "A" <= c <= "Z" else c for c in t) for t in TERM.findall(text or "")]


def corpus(seed=1):
    chance = random.Random(seed)
    vocabulary = [f"w{chr(97 + i % 26)}{chr(97 + i // 26)}" for i in range(120)] + ["Übung", "ÜBUNG", "übung", "日本", "don't", "x1y"]
    rows = []
    for i in range(90):
        lang, source = chance.choice(["en", "en", "de", None]), chance.choice(["a", "a", "b", "ß", "z", None])
        words = chance.choices(vocabulary[: chance.choice([20, 126])], k=chance.randint(0, 60))
        rows.append((i, chance.choice([" ", "-", "7", "\n"]).join(words), lang, source, "t", 1, "n", 0.5))
    rows += [(200, None, "en", "silent", "t", 1, "n", 0.5), (201, "only once here", "rare", "a", "t", 1, "n", 0.5)]
    rows += [(202, "", "rare", "b", "t", 1, "n", 0.5), (203, None, None, None, "t", 1, "n", 0.5), (None, "waa wba", "en", "a", "t", 1, "n", 0.5)]
    return [*rows, rows[3], rows[3], rows[4], (204, "long " * 30_000, "de", "b", "t", 1, "n", 0.5)]


def expected(rows, least=3, ranks=200):
    held, counts, groups = defaultdict(Counter), defaultdict(Counter), set()
    for _, text, lang, source, *_ in rows:
        lang, source = lang or "", source or ""
        groups.add((lang, source))
        terms = plain_terms(text)
        held[lang].update(set(terms))
        counts[lang, source].update(terms)
    kept = {lang: sorted(t for t, n in c.items() if n >= least) for lang, c in held.items()}

    def shares(n, lang):
        total = sum(n[t] for t in kept.get(lang, []))
        return {t: 1 + 10**9 * (n[t] + 1) // (total + len(kept[lang])) for t in kept.get(lang, [])}

    found = []
    for lang, source in groups:
        p = shares(counts[lang, source], lang)
        pairs = []
        for _, other in (g for g in groups if g[0] == lang and g[1] != source):
            q = shares(counts[lang, other], lang)
            pairs.append((sum((p[t] - q[t]) ** 2 // q[t] for t in p), other))
        whole = shares(sum((counts[g] for g in groups if g[0] == lang), Counter()), lang)
        terms = [((p[t] - whole[t]) ** 2 // whole[t], t) for t in p if counts[lang, source][t] and p[t] > whole[t]]
        for part, items, most in (("pair", pairs, None), ("term", terms, ranks)):
            items = sorted(items, key=lambda x: (-x[0], x[1].encode()))[:most]
            found += [(lang, source, part, item, value, rank) for rank, (value, item) in enumerate(items, 1)]
    return sorted(found)


@pytest.mark.parametrize(
    "settings",
    [
        DivergenceSettings(),
        # Several shards, a round for each, arrays handed on at once, many tiles and blocks.
        DivergenceSettings(ranks=5, shard_terms=7, round_bytes=1, task_bytes=1, block=3, tile=2),
    ],
)
def test_equals_brute_force(spark, settings):
    documents = spark.createDataFrame(corpus(), DOCUMENTS)
    found = source_divergence(documents, settings)
    assert found.columns == ["lang", "source", "part", "item", "value", "rank"]
    assert sorted(map(tuple, found.collect())) == expected(corpus(), ranks=settings.ranks)


def test_no_rows(spark):
    assert source_divergence(spark.createDataFrame([], DOCUMENTS)).count() == 0


def test_no_kept_terms(spark):
    rows = [(1, "a b", "en", "x"), (2, "c", "en", "y"), (3, None, "de", "x")]
    found = source_divergence(spark.createDataFrame(rows, "doc_id INT, text STRING, lang STRING, source STRING")).collect()
    assert sorted(map(tuple, found)) == [("en", "x", "pair", "y", 0, 1), ("en", "y", "pair", "x", 0, 1)]


def test_terms():
    text = "Don't STOP_42 @Ünï[x]日本{Ä}\x7fÉé b"
    assert [t.decode() for t in terms_of(text)] == plain_terms(text)
    assert terms_of(None) == []


@pytest.mark.parametrize("n", [0, 1, 2, 1000])
def test_perfect_hashes_are_minimal_and_reject_others(n):
    keys = [b"key%d" % i for i in range(n)]
    hashes = key_hashes(keys)[:, 1] if keys else np.zeros(0, np.uint64)
    levels, numbers = built(hashes)
    assert sorted(numbers.tolist()) == list(range(n))
    if n:
        text = b" ".join(k for _, k in sorted(zip(numbers.tolist(), keys, strict=True)))
        lookup = PerfectHash(levels, text)
        others = [b"other%d" % i for i in range(1000)]
        assert lookup.numbers(keys, hashes).tolist() == numbers.tolist()
        assert set(lookup.numbers(others, key_hashes(others)[:, 1]).tolist()) == {-1}


def test_keys_that_share_a_hash_are_found_by_their_text(monkeypatch):
    keys, hashes = [b"a", b"b", b"c", b"d"], np.array([5, 5, 5, 9], np.uint64)
    levels, numbers = built(hashes)
    text = b" ".join(k for _, k in sorted(zip(numbers.tolist(), keys, strict=True)))
    assert len(levels.sizes) == perfect_hash.LEVELS
    lookup = PerfectHash(levels, text)
    assert lookup.numbers([*keys, b"e"], np.append(hashes, hashes[:1])).tolist() == [*numbers.tolist(), -1]


def test_rounds_hold_all_in_order():
    assert list(rounds_of([3, 3, 3, 10, 1], 6)) == [(0, 1), (2, 2), (3, 3), (4, 4)]
    assert list(rounds_of([], 6)) == []


def test_a_term_is_looked_up_once(monkeypatch):
    keys = [b"one", b"two", b"three"]
    levels, numbers = built(key_hashes(keys)[:, 1])
    text = b" ".join(k for _, k in sorted(zip(numbers.tolist(), keys, strict=True))).decode()
    recount, asked = Recount([("en", 1, 0, levels.sizes, levels.bits, text)]), []
    monkeypatch.setattr(divergence, "key_hashes", lambda terms: asked.extend(terms) or key_hashes(terms))
    known = recount.known["en"]
    assert [known[t] for t in (b"two", b"other", b"two")] == [0, 1, 0]
    assert recount.slots("en").tolist() == [numbers[1], -1]
    assert known[b"one"] == 2
    assert recount.slots("en").tolist() == recount.slots("en").tolist() == [numbers[1], -1, numbers[0]]
    assert asked == [b"two", b"other", b"one"]
    recount.forget()
    assert known is not recount.known["en"] and recount.slots("en").tolist() == []


def test_counts_of_tasks_are_added_up_after_the_shuffle_only(spark):
    """A task's rows are hardly ever of one key: adding them up before they leave spares none."""
    documents = spark.createDataFrame(corpus(), DOCUMENTS).select("lang", "source", "text")
    levels, _ = built(key_hashes([b"waa"])[:, 1])
    counts = recounted(documents, [("en", 1, 0, levels.sizes, levels.bits, "waa")], DivergenceSettings())
    for found in (kept_terms(documents, DivergenceSettings()), counts):
        plan = found._jdf.queryExecution().executedPlan().toString()
        between = plan[plan.index("Exchange") : plan.index("MapInArrow")]
        assert "Aggregate" not in between and plan.count("Exchange") == 1


def test_texts_are_counted_in_small_batches(spark, monkeypatch):
    made, init = [], Workspace.__init__
    monkeypatch.setattr(Workspace, "__init__", lambda self, *a, **b: (init(self, *a, **b), made.append(self.lean))[0])
    assert source_divergence(spark.createDataFrame(corpus(), DOCUMENTS)).count() and made == [True]
