"""Page main-text extraction as a column job over a (url, html) table, and artifact listing."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from feedlake import config as C
from feedlake.functions.markup import page_main_text
from feedlake.session import small_batches


def page_text(pages: DataFrame, max_chars: int = C.ARTICLE_TEXT_CHARS) -> DataFrame:
    """(url, full_text, page_text): full_text is what the memo keeps, page_text the cut
    handed to the summariser. NULL/blank html -> ''. A Python worker gets few pages at a time."""
    small_batches(pages.sparkSession)
    full = page_main_text("html")
    return (pages.withColumn("full_text", full)
            .withColumn("page_text", F.substring("full_text", 1, max_chars)))


def artifact_listing(spark: SparkSession, folder: str, glob: str = "*.html") -> DataFrame:
    """(name, path, modificationTime) of the files matching `glob`; the content column of the
    binaryFile source is never selected, so file bodies are not read."""
    df = (spark.read.format("binaryFile").option("pathGlobFilter", glob).load(folder)
          .select("path", "modificationTime"))
    return df.withColumn("name", F.element_at(F.split("path", "/"), -1)).select("name", "path", "modificationTime")
