"""Maps of sites whose index names further indexes, to any depth."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Indexes below indexes that are followed.
DEPTH = 5


def nested(documents: DataFrame, roots: DataFrame, depth: int = DEPTH) -> DataFrame:
    """root, url and depth (of the map that names it; the least): the pages that a root's maps name, through indexes up to
    `depth` below it. documents: url and xml, a map (`<urlset>`) or an index (`<sitemapindex>`); roots: root.

    Indexes are followed by a recursive query. One that names itself, or one above it, is not followed again; a map that is
    not there, and what a root beyond the depth names, gives no rows.
    """
    spark, name = documents.sparkSession, f"q{uuid.uuid4().hex}"
    loc = F.explode(F.regexp_extract_all("xml", F.lit(r"(?s)<loc>\s*(.*?)\s*</loc>"), F.lit(1)))
    named = documents.select(F.col("url").alias("parent"), F.contains("xml", F.lit("<sitemapindex")).alias("is_index"), loc.alias("child")).distinct()
    named.filter("is_index").createOrReplaceTempView(f"{name}_links")
    roots.select("root").distinct().createOrReplaceTempView(f"{name}_roots")
    found = spark.sql(f"""
        with recursive seen(root, url, depth, above) max recursion level {depth + 2} as (
          select root, root as url, 0 as depth, array(root) as above from {name}_roots
          union all
          select root, child, depth + 1, array_append(above, child)
          from seen join {name}_links on url = parent where depth < {depth} and not array_contains(above, child))
        select root, url, min(depth) as depth from seen group by root, url""")
    maps = named.filter("not is_index").select(F.col("parent").alias("url"), F.col("child").alias("page"))
    return found.join(maps, "url").groupBy("root", "page").agg(F.min("depth").alias("depth")).select("root", F.col("page").alias("url"), "depth")
