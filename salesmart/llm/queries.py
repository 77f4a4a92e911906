"""The queries of the corpus operators, over their whole tables, and their SQL."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from salesmart.llm.divergence import source_divergence
from salesmart.llm.exact_dedup import exact_duplicates
from salesmart.llm.mixing import mixed, word_count
from salesmart.llm.near_dedup import NearSettings, near_duplicates
from salesmart.llm.neighbours import nearest
from salesmart.llm.packing import packed_sequences
from salesmart.llm.periodic_runs import periodic_runs
from salesmart.llm.sharding import interleaved_shards
from salesmart.llm.substring_dedup import repeated_passages
from salesmart.llm.token_count import token_counts
from salesmart.llm.toxicity import fold, toxicity_scores, train
from salesmart.llm.tables import Workspace
from salesmart.llm.url_filter import Rule, url_verdicts
from salesmart.llm.warc import convert_arc, plain_uri, read_warc, spread_lookup, write_arc

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(build):
    QUERIES[build.__name__] = build
    return build


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


# The shares of the sources in code-point order, repeating.
MIX_WEIGHTS = (3, 1, 2)

URL_RULES = (
    Rule("org", "/", "allow"),
    Rule("example.org", "/es/", "block"),
    Rule("example.org", "/en/1", "block"),
    Rule("com", "/fr/", "allow"),
    Rule("com", "/de/", "block"),
)


@query
def op1_near_dedup(spark, folder):
    return near_duplicates(table(spark, folder, "documents"), NearSettings(words=2))


ORACLES["op1_near_dedup"] = r"""
WITH RECURSIVE d AS (
  SELECT doc_id, list_filter(
    regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'),
    lambda x: x <> '') AS ws
  FROM documents
), s AS (
  SELECT DISTINCT doc_id, unnest(CASE WHEN len(ws) < 2 THEN ws
    ELSE list_transform(range(1, len(ws)), lambda i: ws[i] || ' ' || ws[i + 1]) END) AS shingle
  FROM d
), n AS (
  SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id
), links AS (
  SELECT a.doc_id AS x, b.doc_id AS y
  FROM s a JOIN s b ON a.shingle = b.shingle AND a.doc_id < b.doc_id
  JOIN n na ON na.doc_id = a.doc_id JOIN n nb ON nb.doc_id = b.doc_id
  GROUP BY a.doc_id, b.doc_id, na.n, nb.n
  HAVING 100 * count(*) >= 80 * (na.n + nb.n - count(*))
), ways AS (
  SELECT x, y FROM links UNION ALL SELECT y, x FROM links
), reach AS (
  SELECT doc_id, doc_id AS other FROM documents
  UNION
  SELECT r.doc_id, w.y FROM reach r JOIN ways w ON w.x = r.other
), least AS (
  SELECT doc_id, min(other) AS component_id FROM reach GROUP BY doc_id
)
SELECT l.doc_id, coalesce(n.n, 0)::BIGINT AS n_shingles, component_id, l.doc_id = component_id AS kept
FROM least l LEFT JOIN n USING (doc_id)
"""


@query
def op2_mixing(spark, folder):
    mix = mixed(table(spark, folder, "documents"), F.array("source"), word_count(), MIX_WEIGHTS)
    return mix.select("doc_id", "size", "source_size", "target", "taken", "copies")


@query
def op3_packing(spark, folder):
    return packed_sequences(table(spark, folder, "documents"), public_tokenizers.path("byte_bpe_50k.json"))


@query
def op4_sharding(spark, folder):
    shards = interleaved_shards(table(spark, folder, "documents"), shards=8)
    return shards.select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("rows").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
        "source",
    )


@query
def op5_url_filters(spark, folder):
    return url_verdicts(table(spark, folder, "pages"), URL_RULES)


@query
def op6_token_counts(spark, folder):
    return token_counts(table(spark, folder, "documents"), public_tokenizers.path("word_bpe_49k.json"))


@query
def op7_neighbours(spark, folder):
    return nearest(table(spark, folder, "embeddings"), F.col("vec_id") % 50 == 0, k=5)


@query
def op8_toxicity(spark, folder):
    documents = table(spark, folder, "documents").select("doc_id", "text")
    model = train(documents, table(spark, folder, "labels").filter(fold() != 0))
    return toxicity_scores(documents, model).select(
        "doc_id",
        F.coalesce(fold() == 0, F.lit(False)).alias("held_out"),
        "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"),
    )


@query
def op9_substring_dedup(spark, folder):
    return repeated_passages(table(spark, folder, "documents"))


ORACLES["op9_substring_dedup"] = r"""
WITH d AS (
  SELECT doc_id, list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS ws
  FROM documents
), windows AS (
  SELECT doc_id, s, array_to_string(ws[s:s + 49], ' ') AS body
  FROM (SELECT doc_id, ws, unnest(range(1, len(ws) - 48)) AS s FROM d)
), marks AS (
  SELECT doc_id, s FROM windows JOIN (SELECT body, min(doc_id) AS first FROM windows GROUP BY body) USING (body)
  WHERE first < doc_id
), words AS (
  SELECT doc_id, unnest(range(1, len(ws) + 1)) AS i, unnest(ws) AS word FROM d
), judged AS (
  SELECT doc_id, i, word, coalesce(i - max(s) OVER (PARTITION BY doc_id ORDER BY i) < 50, false) AS gone
  FROM words LEFT JOIN (SELECT doc_id, s, s AS i FROM marks) USING (doc_id, i)
)
SELECT d.doc_id, len(ws)::BIGINT AS n_words, coalesce(n_removed, 0)::BIGINT AS n_removed,
       sha256(coalesce(body, '')) AS kept_sha256
FROM d LEFT JOIN (
  SELECT doc_id, count(*) FILTER (gone) AS n_removed, string_agg(word, ' ' ORDER BY i) FILTER (NOT gone) AS body
  FROM judged GROUP BY doc_id
) j USING (doc_id)
"""


@query
def op10_exact_dedup(spark, folder):
    return exact_duplicates(table(spark, folder, "documents"))


ORACLES["op10_exact_dedup"] = r"""
WITH n AS (
  SELECT doc_id, length(coalesce(text, '')) AS points,
         regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g') AS body
  FROM documents
)
SELECT doc_id,
       first_value(doc_id) OVER best AS keep_id,
       count(*) OVER (PARTITION BY body) AS group_size,
       doc_id = first_value(doc_id) OVER best AS kept,
       sha256(body) AS text_sha256
FROM n
WINDOW best AS (PARTITION BY body ORDER BY points DESC, doc_id)
"""


def repeating(documents: DataFrame) -> DataFrame:
    """The documents, of which about one in ten gets a periodic end: where the CRC-32 of
    the id ends in the digit 0, words from a drawn one on repeat the first few of them."""
    crc = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    words = F.filter(F.split("text", r"[\x20\x09-\x0D]+"), lambda w: w != "")
    n, drawn = F.size("words"), F.floor(crc / 10)
    start = F.pmod(drawn, n)
    period = 1 + F.floor((n - F.col("start")) / (3 + F.pmod(drawn, F.lit(8))))
    place = lambda i: F.when(i < F.col("start"), i).otherwise(F.col("start") + F.pmod(i - F.col("start"), F.col("period")))
    repeated = F.transform(F.sequence(F.lit(0).cast("long"), (n - 1).cast("long")), lambda i: F.get("words", place(i).cast("int")))
    changed = (crc % 10 == 0) & (n > 0)
    return (
        documents.select("doc_id", "text", F.when(crc % 10 == 0, words).otherwise(F.array().cast("array<string>")).alias("words"))
        .withColumn("start", F.when(changed, start))
        .withColumn("period", F.when(changed, period))
        .select("doc_id", F.when(changed, F.array_join(repeated, " ")).otherwise(F.col("text")).alias("text"))
    )


@query
def op11_periodic_runs(spark, folder):
    found = periodic_runs(repeating(table(spark, folder, "documents")))
    # The longest run; of several the first, and of these the one of the smallest period.
    longest = F.array_max(F.transform("runs", lambda r: F.struct(r["length"], -r["start"], -r["period"])))
    lines = F.transform("runs", lambda r: F.concat_ws(",", r["start"], r["length"], F.concat(r["period"].cast("string"), F.lit("\n"))))
    length, period = F.col("longest.length"), -F.col("longest.col3")
    return found.withColumn("longest", longest).select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        (-F.col("longest.col2")).alias("start"),
        length.alias("length"),
        period.alias("period"),
        F.floor(length * 1000 / period).cast("long").alias("exponent_milli"),
        F.sha2(F.array_join(lines, "").cast("binary"), 256).alias("runs_sha256"),
        F.sha2(F.col("collapsed_text").cast("binary"), 256).alias("collapsed_sha256"),
    )


ORACLES["op11_periodic_runs"] = r"""
WITH d AS (
  SELECT doc_id, list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS ws,
    xor(4294967295, list_reduce(
      list_prepend(4294967295, list_transform(string_split(doc_id::VARCHAR, ''), lambda c: ord(c)::BIGINT)),
      lambda a, b: list_reduce(list_prepend(xor(a, b), range(8)),
        lambda x, i: CASE WHEN x & 1 = 1 THEN xor(x >> 1, 3988292384) ELSE x >> 1 END))) AS h
  FROM documents
), planned AS (
  SELECT doc_id, ws, len(ws) AS n, h, CASE WHEN h % 10 = 0 AND len(ws) > 0 THEN (h // 10) % len(ws) END AS a FROM d
), texts AS (
  SELECT doc_id, n, CASE WHEN a IS NULL THEN ws ELSE list_transform(range(n),
    lambda i: ws[1 + CASE WHEN i < a THEN i ELSE a + (i - a) % (1 + (n - a) // (3 + (h // 10) % 8)) END]) END AS ws
  FROM planned
), w AS MATERIALIZED (
  SELECT doc_id, n, unnest(range(n)) AS i, unnest(ws) AS word FROM texts
), same AS (
  SELECT x.doc_id, y.i - x.i AS q, x.i
  FROM w x JOIN w y ON x.doc_id = y.doc_id AND x.word = y.word AND y.i > x.i AND 2 * (y.i - x.i) <= x.n
), stretches AS (
  SELECT doc_id, q, min(i) AS s, max(i) + q + 1 AS e
  FROM (SELECT *, i - row_number() OVER (PARTITION BY doc_id, q ORDER BY i) AS island FROM same)
  GROUP BY doc_id, q, island
  HAVING count(*) + q >= greatest(12, 2 * q)
), runs AS (
  SELECT doc_id, s, e - s AS length, min(q) AS period FROM stretches GROUP BY doc_id, s, e
), gone AS (
  SELECT DISTINCT doc_id, unnest(range(s + period, s + length)) AS i FROM runs
), kept AS (
  SELECT doc_id, string_agg(word, ' ' ORDER BY i) AS body FROM w ANTI JOIN gone USING (doc_id, i) GROUP BY doc_id
), summed AS (
  SELECT doc_id, count(*) AS n_runs, string_agg(s || ',' || length || ',' || period || chr(10), '' ORDER BY s, period) AS lines,
    first({'start': s, 'length': length, 'period': period} ORDER BY length DESC, s, period) AS longest
  FROM runs GROUP BY doc_id
)
SELECT doc_id, coalesce(n_runs, 0)::BIGINT AS n_runs, longest.start::BIGINT AS start, longest.length::BIGINT AS length,
  longest.period::BIGINT AS period, (1000 * longest.length // longest.period)::BIGINT AS exponent_milli,
  sha256(coalesce(lines, '')) AS runs_sha256, sha256(coalesce(body, '')) AS collapsed_sha256
FROM texts LEFT JOIN summed USING (doc_id) LEFT JOIN kept USING (doc_id)
"""


PAGE_HEADER = "X-Page-Id"
CRAWLED = "20010203040506"


def page_captures(pages: DataFrame) -> DataFrame:
    """Pages as HTTP responses that carry their number; a null page has no body."""
    body = F.coalesce("html", F.lit("")).cast("binary")
    number = F.concat(F.lit(f"{PAGE_HEADER}: "), F.col("page_id").cast("string"), F.lit("\r\n"))
    head = F.concat(
        F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"),
        F.coalesce(number, F.lit("")),
        F.lit("Content-Length: "),
        F.octet_length(body).cast("string"),
        F.lit("\r\n\r\n"),
    )
    return pages.select(
        "page_id",
        plain_uri(F.col("url")).alias("uri"),
        F.lit("192.0.2.1").alias("ip"),
        F.lit(CRAWLED).alias("moment"),
        F.lit("text/html").alias("mime"),
        F.concat(head.cast("binary"), body).alias("block"),
    )


@query
def op12_warc(spark, folder):
    """Pages as legacy archives, even numbers in version 1 and the others in version 2,
    converted to WARC and read back."""
    return archived_pages(table(spark, folder, "pages"))


def archived_pages(pages: DataFrame) -> DataFrame:
    spark = pages.sparkSession
    work = Workspace(spark, "warc")
    captures = page_captures(pages)
    even = F.coalesce(F.col("page_id") % 2 == 0, F.lit(False))
    arcs = [work.path("arc-1"), work.path("arc-2")]
    write_arc(captures.filter(even), arcs[0], 1)
    write_arc(captures.filter(~even), arcs[1], 2)
    number = F.regexp_extract(F.col("head").cast("string"), rf"(?i)\n{PAGE_HEADER}: *(-?[0-9]+)\r", 1).try_cast("long")
    convert_arc(spark, arcs, work.path("warc"), work, number)
    page_id = F.col("http_headers")[PAGE_HEADER.lower()].cast("long")
    records = work.stored(
        read_warc(spark, work.path("warc"), bodies=False)
        .filter("record_type <> 'warcinfo'")
        .select(page_id.alias("page_id"), "payload_bytes", "payload_digest", "record_type", "record_id", "refers_to_id"),
        "records",
    )
    work.drop("arc-1", "arc-2", "groups")
    revisits = records.filter("record_type = 'revisit'").groupBy("refers_to_id").agg(F.count("*").alias("n"))
    firsts = records.filter("record_type = 'response'").groupBy("record_id").agg(F.min("page_id").alias("refers_to"))
    referred = work.stored(
        revisits.join(firsts, revisits["refers_to_id"] == firsts["record_id"]).select("refers_to_id", "n", "refers_to"), "referred"
    )
    total = referred.agg(F.sum("n")).first()[0] or 0
    found = spread_lookup(records, referred, "refers_to_id", "n", total, F.xxhash64("record_id"))
    return found.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


ORACLES["op12_warc"] = """
WITH p AS (
  SELECT page_id, strlen(coalesce(html, ''))::BIGINT AS payload_bytes, sha256(coalesce(html, '')) AS payload_digest FROM pages
), f AS (
  SELECT *, min(page_id) OVER (PARTITION BY payload_digest) AS first FROM p
)
SELECT page_id, payload_bytes, payload_digest,
  CASE WHEN payload_bytes >= 100 AND page_id <> first THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN payload_bytes >= 100 AND page_id <> first THEN first END AS refers_to
FROM f
"""


@query
def op13_divergence(spark, folder):
    return source_divergence(table(spark, folder, "documents"))


ORACLES["op13_divergence"] = r"""
WITH d AS (
  SELECT doc_id, coalesce(lang, '') AS lang, coalesce(source, '') AS source, regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') AS terms
  FROM documents
), w AS MATERIALIZED (
  SELECT doc_id, lang, source, unnest(terms) AS term FROM d
), kept AS MATERIALIZED (
  SELECT lang, term FROM w GROUP BY lang, term HAVING count(DISTINCT doc_id) >= 3
), v AS (
  SELECT lang, count(*) AS v FROM kept GROUP BY lang
), groups AS (
  SELECT DISTINCT lang, source FROM d
), n AS MATERIALIZED (
  SELECT lang, source, term, count(*) AS n FROM w JOIN kept USING (lang, term) GROUP BY lang, source, term
), slots AS MATERIALIZED (
  SELECT lang, source, term, coalesce(n, 0) AS n,
    1 + (1000000000::HUGEINT * (coalesce(n, 0) + 1)) // (sum(coalesce(n, 0)) OVER (PARTITION BY lang, source) + v) AS p
  FROM groups JOIN kept USING (lang) JOIN v USING (lang) LEFT JOIN n USING (lang, source, term)
), whole AS (
  SELECT lang, term, 1 + (1000000000::HUGEINT * (sum(n) + 1)) // (sum(sum(n)) OVER (PARTITION BY lang) + any_value(v)) AS q
  FROM slots JOIN v USING (lang) GROUP BY lang, term
), pairs AS (
  SELECT a.lang, a.source, b.source AS item, sum((a.p - b.p) * (a.p - b.p) // b.p) AS value
  FROM slots a JOIN slots b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source
  GROUP BY a.lang, a.source, b.source
), parts AS (
  SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(value, 0)::BIGINT AS value
  FROM groups a JOIN groups b ON a.lang = b.lang AND a.source <> b.source
  LEFT JOIN pairs ON pairs.lang = a.lang AND pairs.source = a.source AND pairs.item = b.source
  UNION ALL
  SELECT lang, source, 'term', term, ((p - q) * (p - q) // q)::BIGINT
  FROM slots JOIN whole USING (lang, term) WHERE n > 0 AND p > q
)
SELECT lang, source, part, item, value, rank::INT AS rank FROM (
  SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS rank FROM parts
) WHERE part = 'pair' OR rank <= 200
"""
