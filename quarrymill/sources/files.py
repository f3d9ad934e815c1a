"""Readers and writers of the file kinds in use. Schemas are given, never inferred."""

from __future__ import annotations

import json
import re
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from quarrymill.operators.scans import scan


def json_array(spark: SparkSession, path: str, schema: StructType | str) -> DataFrame:
    """A file that is one JSON array, or one object."""
    return spark.read.schema(schema).option("multiLine", True).json(path)


def json_lines(spark: SparkSession, path: str, schema: StructType | str) -> DataFrame:
    return spark.read.schema(schema).json(path)


def csv(spark: SparkSession, path: str, schema: StructType | str) -> DataFrame:
    return spark.read.schema(schema).option("header", True).csv(path)


def tsv(spark: SparkSession, path: str, schema: StructType | str) -> DataFrame:
    """Without a header; empty fields are null."""
    return spark.read.schema(schema).option("sep", "\t").option("nullValue", "").csv(path)


def text_lines(spark: SparkSession, path: str) -> DataFrame:
    """Column url: lines that are neither blank nor comments, without slashes at the end."""
    line = F.trim("value")
    return spark.read.text(path).filter((line != "") & ~F.startswith(line, F.lit("#"))).select(F.rtrim(line, F.lit("/")).alias("url"))


def yaml(spark: SparkSession, path: str, schema: StructType, key: str = "sources") -> DataFrame:
    """A list of mappings under `key`. Keys that the schema lacks are an error. Needs PyYAML; read on the driver."""
    try:
        import yaml as parser
    except ImportError as error:
        raise RuntimeError("reading YAML needs PyYAML") from error
    rows = parser.safe_load(Path(path).read_text())[key]
    known = set(schema.fieldNames())
    for row in rows:
        if extra := set(row) - known:
            raise ValueError(f"unknown keys: {sorted(extra)}")
    return spark.createDataFrame([tuple(r.get(c) for c in schema.fieldNames()) for r in rows], schema)


def xml_rows(spark: SparkSession, path: str, tag: str, schema: StructType | str) -> DataFrame:
    """Items of a feed or a sitemap: elements `tag`."""
    return spark.read.format("xml").option("rowTag", tag).schema(schema).load(path)


def reports(spark: SparkSession, folder: str, schema: StructType | str, latest: int | None = None) -> DataFrame:
    """Reports of a folder, one JSON object each, with the file's name; the last by name if so many are asked for."""
    found = spark.read.schema(schema).option("multiLine", True).json(folder).withColumn("file", F.col("_metadata.file_name"))
    return found.orderBy(F.desc("file")).limit(latest) if latest else found


def keyset_pages(rows: DataFrame, key: str, size: int) -> DataFrame:
    """All rows in pages of `size` by a key without ties: page and the columns of rows."""
    placed = scan(rows, [], [key], {"_place": ("sum", F.lit(1).cast("long"))})
    return placed.select(F.floor((F.col("_place") - 1) / size).cast("long").alias("page"), *rows.columns)


def deep_rows(document: Column, keys: list[str], depth: int = 5) -> Column:
    """The first array in a JSON document, going into objects up to `depth` deep, whose first element is an object with one
    of the keys; as the text of its elements."""
    listed = lambda x: F.from_json(x, "array<string>")
    fits = lambda x: F.startswith(F.trim(x), F.lit("[")) & F.exists(F.coalesce(F.json_object_keys(F.get(listed(x), F.lit(0))), F.array()), lambda k: k.isin(keys))
    level, found = F.array(document), F.lit(None).cast("string")
    for _ in range(depth + 1):
        found = F.coalesce(found, F.get(F.filter(level, fits), F.lit(0)))
        level = F.flatten(F.transform(F.filter(level, lambda x: F.startswith(F.trim(x), F.lit("{"))), lambda x: F.coalesce(F.map_values(F.from_json(x, "map<string,string>")), F.array())))
    return listed(found)


def sitemap_pages(maps: DataFrame, url_col: str = "url", xml_col: str = "xml", most: int = 20) -> DataFrame:
    """Addresses of pages: those of sitemaps, and of the first `most` sitemaps that an index names, where they are there."""
    told = maps.select(F.col(url_col).alias("_url"), F.col(xml_col).contains("<sitemapindex").alias("_index"), F.transform(sitemap_urls(F.col(xml_col)), lambda u: F.trim(u)).alias("_locs"))
    named = told.filter("_index").select(F.col("_url").alias("root"), F.explode(F.slice("_locs", 1, most)).alias("_sub"))
    plain = told.filter("not _index")
    below = named.join(plain, F.col("_sub") == F.col("_url")).select("root", F.explode("_locs").alias("url"))
    alone = plain.join(named.select("_sub").distinct(), F.col("_sub") == F.col("_url"), "left_anti").select(F.col("_url").alias("root"), F.explode("_locs").alias("url"))
    return below.union(alone)


# ---- parts of pages ----


def json_ld(page: Column) -> Column:
    """Array of the texts of a page's JSON-LD blocks."""
    return F.regexp_extract_all(page, F.lit(r'(?is)<script[^>]*type=["\']application/ld\+json["\'][^>]*>(.*?)</script>'), F.lit(1))


def vehicle_block(page: Column) -> Column:
    """The first block about a vehicle, else the first about a product; null if there is neither."""
    first = lambda kinds: F.get(F.filter(json_ld(page), lambda b: b.rlike(rf'"@type"\s*:\s*"(?:{kinds})"')), F.lit(0))
    return F.coalesce(first("Vehicle|Car"), first("Product"))


def next_data(page: Column) -> Column:
    return F.nullif(F.regexp_extract(page, r'(?is)<script[^>]*id="__NEXT_DATA__"[^>]*>(.*?)</script>', 1), F.lit(""))


def inertia_data(page: Column) -> Column:
    """The JSON in a page's data-page attribute, its quotes decoded."""
    raw = F.regexp_extract(page, r"(?s)data-page=\"([^\"]*)\"", 1)
    return F.nullif(F.replace(F.replace(raw, F.lit("&quot;"), F.lit('"')), F.lit("&amp;"), F.lit("&")), F.lit(""))


def _opening(simple: str) -> str:
    """A pattern for the opening tag of `tag.class#id[name=value]`, any part of which may be missing."""
    tag = re.match(r"[A-Za-z][A-Za-z0-9]*", simple)
    needs = [r"class\s*=\s*[\"'][^\"']*(?<![\w-])" + re.escape(c) + r"(?![\w-])" for c in re.findall(r"\.([\w-]+)", simple)]
    needs += [r"id\s*=\s*[\"']" + re.escape(i) + "[\"']" for i in re.findall(r"#([\w-]+)", simple)]
    needs += [rf"{re.escape(n)}\s*=\s*[\"']{re.escape(v)}[\"']" if v else re.escape(n) for n, v in re.findall(r"\[([\w-]+)(?:=[\"']?([^\"'\]]*)[\"']?)?\]", simple)]
    return f"<({tag[0] if tag else '[a-zA-Z][a-zA-Z0-9]*'})(?=[\\s>/])" + "".join(rf"(?=[^>]*\s{n})" for n in needs) + "[^>]*>"


def select_one(page: Column, selector: str) -> Column:
    """The text of the first element that a selector finds, tags as nothing and white space at the ends cut; null if there
    is none. Selectors are simple ones parted by spaces: each is looked for after the opening tag of the one before; an
    element ends at the first closing tag of its name."""
    rest, name = page, None
    for simple in selector.replace(">", " ").split():
        pattern = "(?is)^.*?" + _opening(simple) + "(.*)$"
        name, rest = F.regexp_extract(rest, pattern, 1), F.regexp_extract(rest, pattern, 2)
    end = F.concat(F.lit("</"), name)
    inner = F.when(name != "", F.regexp_replace(F.split_part(F.replace(rest, F.upper(end), end), end, F.lit(1)), "(?s)<[^>]*>", ""))
    return F.nullif(F.regexp_replace(inner, r"^\s+|\s+$", ""), F.lit(""))


def sitemap_urls(xml: Column) -> Column:
    return F.regexp_extract_all(xml, F.lit(r"(?s)<loc>\s*(.*?)\s*</loc>"), F.lit(1))


def links(page: Column) -> Column:
    """Distinct addresses of a page's links, sorted."""
    return F.array_sort(F.array_distinct(F.regexp_extract_all(page, F.lit(r"""href=["']([^"']+)["']"""), F.lit(1))))


# ---- writers ----


def replace_table(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").parquet(path)


def append(df: DataFrame, path: str) -> None:
    df.write.mode("append").parquet(path)


def write_tsv(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").option("sep", "\t").option("header", True).csv(path)


def write_report(df: DataFrame, folder: str, name: str, at_most: int = 10_000) -> None:
    """A small result as JSON and Markdown, and copies named latest. Over at_most rows is an error."""
    rows = [r.asDict(recursive=True) for r in df.limit(at_most + 1).collect()]
    if len(rows) > at_most:
        raise ValueError(f"a report of over {at_most} rows")
    out = Path(folder)
    out.mkdir(parents=True, exist_ok=True)
    head = df.columns
    table = ["| " + " | ".join(head) + " |", "|" + "---|" * len(head), *("| " + " | ".join(str(r[c]) for c in head) + " |" for r in rows)]
    for stem in (name, "latest"):
        (out / f"{stem}.json").write_text(json.dumps(rows, default=str, indent=1))
        (out / f"{stem}.md").write_text("\n".join(table) + "\n")


def report(df: DataFrame, folder: str) -> None:
    """df as JSON lines and as a Markdown table, in the folders json and md below; any size, any file system."""
    df.write.mode("overwrite").json(f"{folder}/json")
    cells = [F.coalesce(F.replace(F.col(c).cast("string"), F.lit("|"), F.lit("\\|")), F.lit("")) for c in df.columns]
    head = ["| " + " | ".join(df.columns) + " |", "|" + "---|" * len(df.columns)]
    lines = df.select(F.concat(F.lit("| "), F.concat_ws(" | ", *cells), F.lit(" |")).alias("value"))
    df.sparkSession.createDataFrame([(x,) for x in head], "value string").coalesce(1).union(lines).write.mode("overwrite").text(f"{folder}/md")
