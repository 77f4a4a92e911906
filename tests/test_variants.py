"""Documents that are parsed once, as they land, against those parsed from text."""

import datetime as dt
import json

import pytest
from helpers import rows
from pyspark.sql import functions as F

from salesmart import jobs
from salesmart.functions.documents import text_fields, variant_fields
from salesmart.plans import movies
from salesmart.sources.lake import read_dataset, write_dataset

DAY = dt.date(2026, 3, 15)
RAW = "id BIGINT, movie_id BIGINT, payload STRING, ingested_at TIMESTAMP, load_date DATE"
DETAIL = {
    "title": 'a "b"\nä', "overview": "", "tagline": None, "runtime": 95, "budget": 30_000_000_000, "revenue": "",
    "release_date": "", "popularity": 7.25, "vote_average": 1e3, "adult": False, "video": "yes", "genres": [{"id": 3, "name": "x"}],
    "spoken_languages": [], "production_companies": {"a": [1, None]},
}


def raw(spark, *payloads):
    at = dt.datetime(2026, 3, 15, 8)
    return spark.createDataFrame([(i, i, p, at, DAY) for i, p in enumerate(payloads)], RAW)


def stored(df, folder):
    write_dataset(df, f"{folder}/raw", ["load_date"])
    return read_dataset(df.sparkSession, f"{folder}/raw", df.schema)


@pytest.mark.parametrize("stage", [movies.stage_listing, movies.stage_details])
def test_staging_is_that_of_text(spark, folder, stage):
    table = raw(spark, json.dumps(DETAIL), "{}", None, json.dumps({"title": 7, "vote_count": "5"}))
    of_text = stage(table).drop("raw_payload")
    of_variants = stage(stored(movies.parsed_once(table), folder))
    assert rows(of_variants.drop("raw_payload").select(*of_text.columns)) == rows(of_text)
    kept = [r[0] for r in of_variants.orderBy("raw_id").select("raw_payload").collect()]
    assert json.loads(kept[0]) == DETAIL and kept[1:3] == ["{}", None]


def test_text_that_is_no_json(spark, folder):
    table = raw(spark, '{"title": "a"}', "busy", '{"title": 1, "title": 2}', "")
    with pytest.raises(Exception, match="MALFORMED_RECORD_IN_PARSING|DUPLICATE"):
        movies.parsed_once(table).collect()
    staged = movies.stage_listing(stored(movies.parsed_once(table, lenient=True), folder))
    found = [tuple(r) for r in staged.orderBy("raw_id").select("title", "raw_payload").collect()]
    assert found == [("a", '{"title":"a"}'), (None, "busy"), (None, '{"title": 1, "title": 2}'), (None, "")]


def test_bad_values(spark):
    table = movies.parsed_once(raw(spark, '{"vote_count": "many"}'))
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        movies.stage_listing(table).collect()
    assert movies.stage_listing(table, lenient=True).first()["vote_count"] is None


def test_keys_of_any_name(spark):
    text = json.dumps({"a.b": 1, "it's": "x", "$": True, "c": {"z": 1, "a": 2}})
    df = spark.createDataFrame([(text,)], "d STRING")
    keys = ["a.b", "it's", "$", "none"]
    first = df.select(*variant_fields(F.parse_json("d"), keys).values()).first()
    second = df.select(text_fields(F.col("d"), keys)).first()[0]
    assert tuple(first) == tuple(second) == ("1", "x", "true", None)
    # Keys come in order of their names.
    assert df.select(variant_fields(F.parse_json("d"), ["c"])["c"]).first()[0] == '{"a":2,"z":1}'


def test_documents_that_are_no_objects_have_no_fields(spark):
    staged = movies.stage_listing(movies.parsed_once(raw(spark, "null", "[1]", "7")))
    assert [tuple(r) for r in staged.orderBy("raw_id").select("title", "raw_payload").collect()] == [
        (None, "null"), (None, "[1]"), (None, "7"),
    ]


def test_a_scan_brings_the_wanted_keys_and_parses_nothing(spark, folder):
    table = stored(movies.parsed_once(raw(spark, json.dumps(DETAIL))), folder)
    staged = movies.stage_listing(table, DAY).select("movie_id", "title", "popularity")
    plan = staged._jdf.queryExecution().executedPlan().toString()
    assert "json" not in plan and "document:struct<0:string,1:string>" in plan


def test_jobs_from_pages_to_staging(spark, folder):
    listed = [{"id": 1, "title": "old"}, {"id": 2, "title": "b", "popularity": 1.5}, {"id": 1, "title": "a", "genre_ids": [4]}]
    pages = [(DAY, 1, json.dumps({"results": listed})), (DAY, 2, json.dumps({"results": None}))]
    spark.createDataFrame(pages, "load_date DATE, page INT, body STRING").write.parquet(f"{folder}/pages")
    at = dt.datetime(2026, 3, 15, 9)
    details = [(DAY, at, json.dumps({"id": 1} | DETAIL)), (DAY, at, json.dumps({"id": 9}))]
    spark.createDataFrame(details, "load_date DATE, fetched_at TIMESTAMP, body STRING").write.parquet(f"{folder}/details")
    found = {}
    for root, options in ((f"{folder}/text", []), (f"{folder}/variant", ["--variant"])):
        inputs = ["--pages", f"{folder}/pages", "--details", f"{folder}/details", "--date", str(DAY)]
        jobs.main(["ingest", "--root", root, *inputs, *options], spark)
        jobs.main(["stage", "--root", root, *options], spark)
        found[root] = [rows(t.drop("ingested_at", "raw_payload")) for t in jobs.movie_tables(spark, root, "stage")]
    first, second = found.values()
    assert first == second and [len(t) for t in first] == [2, 1]
