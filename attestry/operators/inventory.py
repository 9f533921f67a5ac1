"""Line inventories of file texts."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from attestry.functions.yamljson import spread, yaml_to_json


def headings(files: DataFrame, key: str, text: str) -> DataFrame:
    """Markdown headings, one row per heading in file order."""
    found = F.regexp_extract_all(F.col(text), F.lit(r"(?m)^#+\s.+"), F.lit(0))
    return files.select(F.col(key), F.posexplode(found).alias("ordinal", "heading"))


def instructions(files: DataFrame, key: str, text: str) -> DataFrame:
    """Lines that start with capitals once trimmed, one row each in file order.

    One expression extracts all of them; blanks before a line are no part of it.
    """
    lines = F.split(F.col(text), "\n")
    trimmed = F.transform(lines, lambda l: F.regexp_replace(l, r"^\s+|\s+$", ""))
    kept = F.filter(trimmed, lambda l: l.rlike("^[A-Z]+"))
    return files.select(F.col(key), F.posexplode(kept).alias("ordinal", "line")).withColumn(
        "instruction", F.regexp_extract("line", "^[A-Z]+", 0)
    )


def instruction_counts(lines: DataFrame) -> DataFrame:
    """How often each instruction word occurs."""
    return lines.groupBy("instruction").agg(F.count("*").alias("line_count"))


def land_yaml(files: DataFrame, key: str, text: str) -> tuple[DataFrame, DataFrame]:
    """Texts as JSON documents, and the rows that are not YAML."""
    texts = spread(files.select(F.col(key), F.col(text).alias("content")))
    landed = texts.select(key, "content", yaml_to_json(F.col("content")).alias("document"))
    good = landed.filter(F.col("document").isNotNull()).select(key, "document")
    bad = landed.filter(F.col("document").isNull()).select(key, "content")
    return good, bad
