"""Prompt registry: versioned prompt files of a folder."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from recordqa.functions.ids import prompt_version, version_number


def prompt_registry(spark: SparkSession, directory: str) -> DataFrame:
    """One row per ``<base>_v*.txt``: base, version, version_num, file, text."""
    files = spark.read.text(f"{directory.rstrip('/')}/*_v*.txt", wholetext=True)
    # the scan names files as in a URL, where a plus sign stands for itself
    name = F.url_decode(F.replace(F.col("_metadata.file_name"), F.lit("+"), F.lit("%2B")))
    version = prompt_version(name)
    return files.select(
        F.regexp_extract(name, r"^(.+)_v[^/]*\.txt$", 1).alias("base"),
        version.alias("version"),
        version_number(version).alias("version_num"),
        name.alias("file"),
        F.col("value").alias("text"),
    )


def latest_prompts(registry: DataFrame) -> DataFrame:
    """Latest prompt per base: highest version number, then highest file name."""
    newest = F.max_by(
        F.struct("version", "version_num", "file", "text"), F.struct("version_num", "file")
    )
    return registry.groupBy("base").agg(newest.alias("p")).select("base", "p.*")
