"""Posts: markdown files with frontmatter, from a folder or a table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from draftloom.functions.blocks import frontmatter_udf


def valid_post_path(path: Column) -> Column:
    """A .qmd file, not ``_``-prefixed, not below a hidden folder or a build folder."""
    parts = F.split(path, "/")
    folders = F.slice(parts, F.lit(1), F.size(parts) - 1)
    name = F.element_at(parts, -1)
    bad = F.exists(folders, lambda p: (F.startswith(p, F.lit(".")) & ~p.isin(".", "..")) | p.isin("renv", "_site"))
    return F.coalesce(F.endswith(F.lower(name), F.lit(".qmd")) & ~F.startswith(name, F.lit("_")) & ~F.startswith(name, F.lit(".")) & ~bad, F.lit(False))


def source_label(path: Column, root: str) -> Column:
    """The path relative to the root, if it lies under it."""
    r = root.rstrip("/") + "/"
    plain = F.regexp_replace(path, "^file:(?://)?(?=/)", "")
    return F.when(F.startswith(plain, F.lit(r)), F.substr(plain, F.lit(len(r) + 1))).otherwise(plain)


def read_posts(spark: SparkSession, root: str, pattern: str = "*.qmd") -> DataFrame:
    """(source, raw) of every valid post below a folder."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", pattern).option("recursiveFileLookup", True).load(root)
    rows = files.select(source_label(F.col("path"), root).alias("source"), F.decode("content", "UTF-8").alias("raw"))
    return rows.filter(valid_post_path(F.col("source")))


def with_frontmatter(posts: DataFrame, raw: str = "raw") -> DataFrame:
    """Adds ``meta`` (the frontmatter as JSON text) and ``body``; malformed frontmatter is body."""
    f = posts.withColumn("_f", frontmatter_udf(raw))
    return f.withColumn("meta", F.col("_f.meta")).withColumn("body", F.col("_f.body")).drop("_f")
