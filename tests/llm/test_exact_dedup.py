import hashlib
from collections import defaultdict

import pytest
from llm_corpus import corpus

from salesmart.llm.exact_dedup import exact_duplicates


def expected(rows):
    groups = defaultdict(list)
    for doc_id, text, *_ in rows:
        groups["".join(c for c in text or "" if c not in " \t\n\x0b\x0c\r")].append((doc_id, text or ""))
    found = []
    for body, members in groups.items():
        best = min(members, key=lambda m: (-len(m[1]), m[0] is None, m[0]))
        digest = hashlib.sha256(body.encode()).hexdigest()
        found += [(doc_id, best[0], len(members), digest) for doc_id, _ in members]
    return sorted(found, key=repr), len(groups)


@pytest.mark.parametrize("block_bytes, key_bits", [(2048, 64), (16, 64), (7, 3)])
def test_equals_grouping_by_the_text(documents, block_bytes, key_bits):
    """Also where blocks split characters, and where most block keys clash."""
    found = exact_duplicates(documents, block_bytes, key_bits).collect()
    wanted, groups = expected(corpus())
    assert sorted([(r["doc_id"], r["keep_id"], r["group_size"], r["text_sha256"]) for r in found], key=repr) == wanted
    kept = [r for r in found if r["kept"]]
    assert len(kept) == groups == len({r["text_sha256"] for r in kept})
    assert all(r["doc_id"] == r["keep_id"] for r in kept)


def test_odd_and_even_blocks_do_not_meet(spark):
    """Texts whose blocks are alike but differ in number or order."""
    texts = ["ab", "abab", "ababab", "abababab", "abcd", "cdab", "abcdab", "ab" * 5, "ab" * 5]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id BIGINT, text STRING")
    sizes = {r["doc_id"]: r["group_size"] for r in exact_duplicates(df, block_bytes=2).collect()}
    assert sizes == {i: 1 + (i > 6) for i in range(len(texts))}


def test_no_rows(nothing):
    assert exact_duplicates(nothing).count() == 0
