"""Source URLs and object-store URIs as table columns."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The URL rewrite and the URI form.
REWRITE_HOST = "github.com"
REWRITE_FROM = "/blob/"
REWRITE_TO = "/raw/"
URI_FORM = r"^s3://([^/]*)/([\s\S]*)$"


def download_url(url: Column) -> Column:
    """Web page address of a hosted file -> address of the file itself."""
    page = url.contains(REWRITE_HOST) & url.contains(REWRITE_FROM)
    return F.when(page, F.replace(url, F.lit(REWRITE_FROM), F.lit(REWRITE_TO))).otherwise(url)


def source_manifest(sources: DataFrame, url_col: str = "url") -> DataFrame:
    """Distinct download addresses with how many source rows name each."""
    return (
        sources.select(download_url(F.col(url_col)).alias("url"))
        .groupBy("url")
        .agg(F.count(F.lit(1)).alias("n_sources"))
    )


def parse_uri(uri: Column, strict: bool = False) -> Column:
    """Struct (bucket, key, is_valid); an invalid URI gives nulls, or an error if strict."""
    valid = F.coalesce(uri.rlike(URI_FORM), F.lit(False))
    otherwise = (
        F.raise_error(F.concat(F.lit("Invalid object URI: "), F.coalesce(uri, F.lit("null"))))
        if strict
        else F.lit(None)
    ).cast("string")
    return F.struct(
        F.when(valid, F.regexp_extract(uri, URI_FORM, 1)).otherwise(otherwise).alias("bucket"),
        F.when(valid, F.regexp_extract(uri, URI_FORM, 2)).otherwise(otherwise).alias("key"),
        valid.alias("is_valid"),
    )
