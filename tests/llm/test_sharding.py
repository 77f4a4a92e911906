import zlib
from collections import Counter, defaultdict

from llm_corpus import corpus

from salesmart.llm.sharding import interleaved_shards
from salesmart.llm.tables import Workspace, bit_set, bitmap, ranked


def test_every_shard_matches_the_mixture(documents):
    rows = interleaved_shards(documents, shards=8).collect()
    given = corpus()
    assert Counter((r["doc_id"], r["size"], r["text_crc32"]) for r in rows) == Counter(
        (i, len((t or "").encode()) + 1, zlib.crc32((t or "").encode())) for i, t, *_ in given
    )
    slots, sources = defaultdict(list), defaultdict(Counter)
    for r in rows:
        slots[r["shard"]].append(r["slot"])
        sources[r["source"]][r["shard"]] += 1
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    assert max(map(len, slots.values())) - min(map(len, slots.values())) <= 1
    for counts in sources.values():
        per_shard = [counts[s] for s in range(8)]
        assert max(per_shard) - min(per_shard) <= 3
    again = interleaved_shards(documents.repartition(3), shards=8).collect()
    assert Counter(map(repr, again)) == Counter(map(repr, rows))


def test_fewer_rows_than_shards(spark, nothing):
    df = spark.createDataFrame([(i, None, None) for i in range(3)], "doc_id BIGINT, text STRING, source STRING")
    assert sorted((r["size"], r["slot"]) for r in interleaved_shards(df, 8).collect()) == [(1, 0)] * 3
    assert interleaved_shards(nothing, 8).count() == 0


def test_positions(spark):
    df = spark.range(1000).selectExpr("id * 7919 % 1000 AS k", "id % 3 AS v").repartition(7)
    found = ranked(Workspace(spark, "ranked"), df, "t", "v", "k")
    places = {r["position"]: (r["v"], r["k"]) for r in found.collect()}
    assert [places[i] for i in range(1000)] == sorted((i % 3, i * 7919 % 1000) for i in range(1000))


def test_bitmap(spark):
    import numpy as np

    cells = np.random.default_rng(1).choice(1 << 18, 5000)
    packed = bitmap(spark.createDataFrame([(int(c),) for c in cells], "c BIGINT"), 18)
    assert len(packed) == (1 << 18) // 8
    assert bit_set(packed, np.arange(1 << 18)).nonzero()[0].tolist() == sorted(set(cells.tolist()))
