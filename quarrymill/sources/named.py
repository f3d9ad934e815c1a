"""Extractors that a reader names: a data source of files or pages whose rows a named function gives.

`register(spark)` makes the format `extracted`; `spark.read.format("extracted").schema(...).option("extractor", name)
.load(folder)` reads it, and `df.write.format("extracted").option("extractor", "jsonl").option("key", column).save(folder)`
writes pages with the least and greatest key of each, of which a reader opens only those that its filters allow.
"""

from __future__ import annotations

import csv
import io
import json
import os
import uuid
from collections.abc import Callable, Iterator
from dataclasses import dataclass

from pyarrow import fs
from pyspark.sql import SparkSession
from pyspark.sql.datasource import (
    DataSource,
    DataSourceReader,
    DataSourceWriter,
    EqualTo,
    Filter,
    GreaterThan,
    GreaterThanOrEqual,
    InputPartition,
    LessThan,
    LessThanOrEqual,
    WriterCommitMessage,
)
from pyspark.sql.types import StructType

#: Rows of a page that is written.
PAGE = 10_000
MANIFEST = "pages.json"

Extractor = Callable[[str], Iterator[dict]]


def json_lines(text: str) -> Iterator[dict]:
    return (json.loads(line) for line in text.splitlines() if line.strip())


def json_rows(text: str) -> Iterator[dict]:
    """An array of objects, one object, or an answer of a procedure call with its rows under `result`."""
    found = json.loads(text)
    found = found.get("result", found) if isinstance(found, dict) else found
    return iter(found if isinstance(found, list) else [found])


def comma_rows(text: str) -> Iterator[dict]:
    return csv.DictReader(io.StringIO(text))


def yaml_rows(text: str) -> Iterator[dict]:
    """A document that is a list of maps; PyYAML must be there."""
    import yaml

    return iter(yaml.safe_load(text) or [])


#: What a reader may name; more are added by add().
EXTRACTORS: dict[str, Extractor] = {"jsonl": json_lines, "json": json_rows, "rpc": json_rows, "csv": comma_rows, "yaml": yaml_rows}


def add(name: str, extractor: Extractor) -> None:
    if name in EXTRACTORS:
        raise ValueError(f"there is an extractor {name}")
    EXTRACTORS[name] = extractor


def _opened(path: str) -> tuple[fs.FileSystem, str]:
    return fs.FileSystem.from_uri(path) if "://" in path else (fs.LocalFileSystem(), path.removeprefix("file:"))


def _text(path: str) -> str:
    system, at = _opened(path)
    with system.open_input_stream(at) as f:
        return f.read().decode("utf-8", "replace")


@dataclass
class Page(InputPartition):
    path: str


@dataclass
class Written(WriterCommitMessage):
    pages: list


class _Reader(DataSourceReader):
    """One partition for each file. Filters on the key column close pages; Spark still applies them to rows."""

    def __init__(self, options: dict, schema: StructType, extractor: Extractor):
        self.folder, self.key = options["path"].rstrip("/"), options.get("key")
        self.schema, self.extractor, self.bounds = schema, extractor, []

    def pushFilters(self, filters: list[Filter]) -> Iterator[Filter]:
        for f in filters:
            if isinstance(f, EqualTo | GreaterThan | GreaterThanOrEqual | LessThan | LessThanOrEqual) and f.attribute == (self.key,):
                self.bounds.append((type(f).__name__, f.value))
            yield f

    def partitions(self) -> list[Page]:
        system, at = _opened(self.folder)
        names = sorted(x.path for x in system.get_file_info(fs.FileSelector(at)) if x.type == fs.FileType.File and not os.path.basename(x.path).startswith(("_", ".")))
        prefix = self.folder.removesuffix(at)
        known = {}
        if any(os.path.basename(n) == MANIFEST for n in names):
            known = {p["name"]: p for p in json.loads(_text(f"{self.folder}/{MANIFEST}"))["pages"]}
            # what a writer left that never committed is not there
            names = [n for n in names if os.path.basename(n) in known]
        return [Page(prefix + n) for n in names if self._may(known.get(os.path.basename(n)))]

    def _may(self, page: dict | None) -> bool:
        if page is None or page["low"] is None or page.get("key") != self.key:
            return True
        low, high = page["low"], page["high"]
        fits = {"EqualTo": lambda v: low <= v <= high, "GreaterThan": lambda v: high > v, "GreaterThanOrEqual": lambda v: high >= v, "LessThan": lambda v: low < v, "LessThanOrEqual": lambda v: low <= v}
        return all(fits[kind](v) for kind, v in self.bounds)

    def read(self, partition: Page) -> Iterator[tuple]:
        kinds = {f.name: f.dataType.simpleString() for f in self.schema}
        made = {"bigint": int, "int": int, "double": float, "float": float}
        for row in self.extractor(_text(partition.path)):
            yield tuple(None if (v := row.get(c)) is None or v == "" and k in made else made[k](v) if k in made else v for c, k in kinds.items())


class _Writer(DataSourceWriter):
    """Tasks write pages under names of their own; only the commit names them to readers, in one file."""

    def __init__(self, options: dict, overwrite: bool):
        self.folder, self.key, self.size, self.overwrite = options["path"].rstrip("/"), options.get("key"), int(options.get("page", PAGE)), overwrite

    def write(self, rows: Iterator) -> Written:
        system, at = _opened(self.folder)
        system.create_dir(at, recursive=True)
        out, page = [], []

        def put() -> None:
            name = f"page-{uuid.uuid4().hex}.jsonl"
            with system.open_output_stream(f"{at}/{name}") as f:
                f.write("".join(json.dumps(r, ensure_ascii=False, default=str) + "\n" for r in page).encode())
            keys = [r[self.key] for r in page if r[self.key] is not None] if self.key else []
            # a page with a row without a key has no bounds, so that no filter closes it
            sure = self.key and len(keys) == len(page)
            out.append({"name": name, "n": len(page), "key": self.key, "low": min(keys) if sure else None, "high": max(keys) if sure else None})
            page.clear()

        for row in rows:
            page.append(row.asDict(recursive=True))
            if len(page) >= self.size:
                put()
        if page:
            put()
        return Written(out)

    def commit(self, messages: list) -> None:
        system, at = _opened(self.folder)
        old = []
        if system.get_file_info(f"{at}/{MANIFEST}").type == fs.FileType.File:
            old = json.loads(_text(f"{self.folder}/{MANIFEST}"))["pages"]
        pages = ([] if self.overwrite else old) + [p for m in messages if m for p in m.pages]
        with system.open_output_stream(f"{at}/_next") as f:
            f.write(json.dumps({"pages": pages}).encode())
        system.move(f"{at}/_next", f"{at}/{MANIFEST}")
        if self.overwrite:
            for p in old:
                system.delete_file(f"{at}/{p['name']}")

    def abort(self, messages: list) -> None:
        system, at = _opened(self.folder)
        for p in (p for m in messages if m for p in m.pages):
            system.delete_file(f"{at}/{p['name']}")


class Extracted(DataSource):
    @classmethod
    def name(cls) -> str:
        return "extracted"

    def _extractor(self) -> Extractor:
        name = self.options.get("extractor", "jsonl")
        if name not in EXTRACTORS:
            raise ValueError(f"no extractor {name}; there are {', '.join(sorted(EXTRACTORS))}")
        return EXTRACTORS[name]

    def reader(self, schema: StructType) -> DataSourceReader:
        return _Reader(self.options, schema, self._extractor())

    def writer(self, schema: StructType, overwrite: bool) -> DataSourceWriter:
        return _Writer(self.options, overwrite)


def register(spark: SparkSession) -> None:
    """Makes the format known to a session, and lets Spark hand filters to it."""
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    spark.dataSource.register(Extracted)
