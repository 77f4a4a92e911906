"""Movies: raw JSON documents to typed staging rows and marts.

Raw tables have the columns ``id, load_date, movie_id, payload, ingested_at``, or, where
documents are parsed once and for all as they land, ``document`` (VARIANT) and
``unparsed`` (text that is no JSON) in place of ``payload``.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from salesmart.functions.documents import json_text, text_fields, typed_columns, variant_fields, variant_text
from salesmart.functions.values import dated_id, row_key
from salesmart.operators.keys import enriched, last_per_key
from salesmart.operators.pages import flatten_pages

NUMBER = "decimal(20,6)"
MOVIE_KEY = ("load_date", "movie_id")
# What stands for ``payload`` where it is parsed as it lands.
DOCUMENT = ("document", "unparsed")

# The checks both staging tables must pass.
STAGE_NOT_NULL = ("raw_id", "movie_id", "load_date")
STAGE_UNIQUE = ("raw_id",)

# Staging column -> (JSON key, type), in table order. Sub-documents
# stay JSON text.
LISTING_COLUMNS: dict[str, tuple[str, str]] = {
    "title": ("title", "string"),
    "original_title": ("original_title", "string"),
    "original_language": ("original_language", "string"),
    "overview": ("overview", "string"),
    "release_date": ("release_date", "date"),
    "popularity": ("popularity", NUMBER),
    "vote_average": ("vote_average", NUMBER),
    "vote_count": ("vote_count", "int"),
    "is_adult": ("adult", "boolean"),
    "is_video": ("video", "boolean"),
    "poster_path": ("poster_path", "string"),
    "backdrop_path": ("backdrop_path", "string"),
    "genre_ids_json": ("genre_ids", "string"),
}
DETAIL_COLUMNS: dict[str, tuple[str, str]] = {
    "title": ("title", "string"),
    "original_title": ("original_title", "string"),
    "original_language": ("original_language", "string"),
    "overview": ("overview", "string"),
    "tagline": ("tagline", "string"),
    "movie_status": ("status", "string"),
    "homepage": ("homepage", "string"),
    "imdb_id": ("imdb_id", "string"),
    "release_date": ("release_date", "date"),
    "runtime_minutes": ("runtime", "int"),
    "budget": ("budget", "bigint"),
    "revenue": ("revenue", "bigint"),
    "popularity": ("popularity", NUMBER),
    "vote_average": ("vote_average", NUMBER),
    "vote_count": ("vote_count", "int"),
    "is_adult": ("adult", "boolean"),
    "is_video": ("video", "boolean"),
    "poster_path": ("poster_path", "string"),
    "backdrop_path": ("backdrop_path", "string"),
    "genres_json": ("genres", "string"),
    "production_companies_json": ("production_companies", "string"),
    "production_countries_json": ("production_countries", "string"),
    "spoken_languages_json": ("spoken_languages", "string"),
}
# The columns of the marts.
DETAIL_MART = (
    "load_date", "movie_id", "title", "original_language", "release_date", "runtime_minutes",
    "budget", "revenue", "popularity", "vote_average", "vote_count",
)
FROM_LISTING = ("title", "original_language", "release_date", "popularity", "vote_average", "vote_count")
FROM_DETAILS = ("runtime_minutes", "budget", "revenue")


def on_date(df: DataFrame, load_date: dt.date | None) -> DataFrame:
    """The rows of one load date, or all of them."""
    return df if load_date is None else df.filter(F.col("load_date") == F.lit(load_date))


def land_documents(records: DataFrame, load_date: Column, key: str = "id", order_by: str | None = None) -> DataFrame:
    """Records of any shape as ``load_date, movie_id, payload`` rows.

    With ``order_by``, a record that came more than once is kept in its last form.
    """
    landed = records.select(
        load_date.alias("load_date"),
        F.col(key).alias("movie_id"),
        json_text(*[c for c in records.columns if c != order_by]).alias("payload"),
        *([F.col(order_by).alias("_order")] if order_by else []),
    )
    if order_by is None:
        return landed
    return last_per_key(landed, MOVIE_KEY, ["_order"]).drop("_order")


def listed_in_pages(
    pages: DataFrame,
    max_pages: int | None = None,
    lenient: bool = False,
    observe: Observation | str | None = None,
    as_variant: bool = False,
) -> DataFrame:
    """The movies on result pages (``load_date, page, body``) as ``load_date, movie_id, payload`` rows.

    With ``as_variant`` the parse of a page gives its items as VARIANT, in ``document``
    in place of ``payload``, and nothing is parsed after it.

    A movie that a load date lists more than once is kept as it came last. Pages
    that cannot be read raise, or are counted by ``observe`` when ``lenient``.
    """
    if as_variant:
        items = flatten_pages(pages, "VARIANT", max_pages, lenient=lenient, observe=observe)
        number = variant_text(F.col("item"), "id").cast("bigint")
        keyed = items.withColumns({"movie_id": number, "document": F.col("item"), "unparsed": F.lit(None).cast("string")})
        return last_per_key(keyed, MOVIE_KEY, ["page", "position"]).select(*MOVIE_KEY, *DOCUMENT)
    items = flatten_pages(pages, "STRING", max_pages, lenient=lenient, observe=observe)
    keyed = items.withColumns({"movie_id": F.get_json_object("item", "$.id").cast("bigint"), "payload": F.col("item")})
    return last_per_key(keyed, MOVIE_KEY, ["page", "position"]).select(*MOVIE_KEY, "payload")


def listed_details(details: DataFrame, listed: DataFrame) -> DataFrame:
    """The details (``load_date, fetched_at, body``) of listed movies as landed rows.

    Of details that were fetched more than once the last ones stay; what no page
    of the load date lists is left out.
    """
    number = F.get_json_object("body", "$.id").cast("bigint")
    landed = details.select("load_date", number.alias("movie_id"), F.col("body").alias("payload"), "fetched_at")
    last = last_per_key(landed, MOVIE_KEY, ["fetched_at", "payload"]).drop("fetched_at")
    return enriched(listed.select(*MOVIE_KEY), last, MOVIE_KEY)


def parsed_once(raw: DataFrame, lenient: bool = False) -> DataFrame:
    """Rows with ``payload`` as rows with ``document``, a VARIANT, and ``unparsed``.

    Text that is no JSON, or names a key twice, raises; when ``lenient`` it is kept in
    ``unparsed``, and staging gives NULL for its columns.
    """
    text = F.col("payload")
    document = F.try_parse_json(text) if lenient else F.parse_json(text)
    others = [c for c in raw.columns if c not in ("payload", *MOVIE_KEY[:1])]
    return raw.select(
        *others, document.alias("document"), F.when(document.isNull(), text).alias("unparsed"), *MOVIE_KEY[:1]
    )


def as_raw(landed: DataFrame, ingested_at: Column) -> DataFrame:
    """Landed rows with the columns of the raw table; the id is the same on every run."""
    return landed.select(
        dated_id(F.col("load_date"), F.col("movie_id")).alias("id"),
        "movie_id",
        *(DOCUMENT if "document" in landed.columns else ["payload"]),
        ingested_at.alias("ingested_at"),
        "load_date",
    )


def stage_documents(
    raw: DataFrame,
    columns: Mapping[str, tuple[str, str]],
    load_date: dt.date | None = None,
    lenient: bool = False,
    with_row_key: bool = True,
) -> DataFrame:
    """Raw documents as typed columns; every payload is parsed once, a VARIANT not at all.

    Text that does not fit its type raises, or becomes NULL when ``lenient``.
    """
    keys = [key for key, _ in columns.values()]
    parsed, payload, fields = on_date(raw, load_date), F.col("payload"), F.col("_fields")
    if "document" in raw.columns:
        fields, payload = variant_fields(F.col("document"), keys), F.coalesce("unparsed", F.to_json("document"))
    else:
        parsed = parsed.withColumn("_fields", text_fields(payload, keys, lenient))
    return parsed.select(
        *([row_key(*MOVIE_KEY).alias("stage_row_key")] if with_row_key else []),
        F.col("id").alias("raw_id"),
        *MOVIE_KEY,
        "ingested_at",
        *typed_columns(fields, columns, lenient),
        payload.alias("raw_payload"),
    )


def stage_listing(raw: DataFrame, load_date: dt.date | None = None, lenient: bool = False) -> DataFrame:
    return stage_documents(raw, LISTING_COLUMNS, load_date, lenient)


def stage_details(
    raw: DataFrame, load_date: dt.date | None = None, lenient: bool = False, with_row_key: bool = True
) -> DataFrame:
    return stage_documents(raw, DETAIL_COLUMNS, load_date, lenient, with_row_key)


def mart_from_details(details: DataFrame, load_date: dt.date | None = None) -> DataFrame:
    """The mart that takes every attribute from the details."""
    return on_date(details, load_date).select(*DETAIL_MART)


def mart_from_listing(listing: DataFrame, details: DataFrame, load_date: dt.date | None = None) -> DataFrame:
    """The mart that keeps every listed movie and adds the details where there are any."""
    left = on_date(listing, load_date).select(*MOVIE_KEY, *FROM_LISTING)
    right = on_date(details, load_date).select(*MOVIE_KEY, *FROM_DETAILS)
    joined = enriched(left, right, MOVIE_KEY, "left")
    return joined.select(
        row_key(*MOVIE_KEY).alias("mart_row_key"), *MOVIE_KEY, *FROM_LISTING, *FROM_DETAILS
    )
