"""Readers: members of archives, descriptors, delimited text, JSON lines, pages."""

from __future__ import annotations

import json
import re
import xml.etree.ElementTree as ET
import zipfile
from collections.abc import Sequence
from dataclasses import dataclass
from html.parser import HTMLParser
from urllib.parse import urljoin

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fieldlark.operators.joins import with_ordinal
from fieldlark.operators.parse_rows import Contract, Field, broken_rows, valid_rows

# Texts that mean a missing value in archive members.
NULLS = ("", "NULL", "null", "NA", "N/A")


@dataclass(frozen=True)
class Member:
    """One table of an archive as its descriptor states it."""

    location: str
    row_type: str
    separator: str
    enclosure: str
    header_lines: int
    fields: tuple[str, ...]
    constants: tuple[tuple[str, str], ...]


def _unescape(text: str | None, default: str) -> str:
    return default if text is None else text.replace("\\t", "\t").replace("\\n", "\n").replace("\\r", "\r")


def inspect_archive(path: str) -> list[Member]:
    """The tables that ``meta.xml`` in a zip archive describes, core first."""
    with zipfile.ZipFile(path) as z:
        root = ET.fromstring(z.read("meta.xml"))
    out = []
    for node in root:
        tag = node.tag.rpartition("}")[2]
        if tag not in ("core", "extension"):
            continue
        where = next((x.text for x in node.iter() if x.tag.endswith("location")), None)
        names, constants = {}, []
        for f in node:
            kind = f.tag.rpartition("}")[2]
            if kind in ("id", "coreid"):
                names.setdefault(int(f.get("index", 0)), "id")
            elif kind == "field":
                term = (f.get("term") or "").rpartition("/")[2]
                if f.get("index") is None:
                    constants.append((term, f.get("default") or ""))
                else:
                    names[int(f.get("index"))] = term
        width = max(names, default=-1) + 1
        fields = tuple(names.get(i, f"column_{i}") for i in range(width))
        out.append((tag != "core", Member(where or "", node.get("rowType") or "", _unescape(node.get("fieldsTerminatedBy"), ","), _unescape(node.get("fieldsEnclosedBy"), ""), int(node.get("ignoreHeaderLines") or 0), fields, tuple(constants))))
    return [m for _, m in sorted(out, key=lambda x: x[0])]


def unpack_member(path: str, member: str, folder: str) -> str:
    """Copies one member of a zip archive to a folder the cluster shares, block by block."""
    target = f"{folder.rstrip('/')}/{member}"
    with zipfile.ZipFile(path) as z, z.open(member) as src, open(target, "wb") as dst:
        while chunk := src.read(16 << 20):
            dst.write(chunk)
    return target


def text_contract(fields: Sequence[str], *, sep: str = "\t", quote: str = "", nulls: Sequence[str] = NULLS) -> Contract:
    """All fields as nullable text: a line breaks this contract by its number of fields or its quoting."""
    return Contract([Field(f) for f in fields], sep, nulls, quote)


def numbered_lines(spark: SparkSession, path: str, header_lines: int = 0) -> DataFrame:
    """``file, line_at, line``: the lines of text files but their first ``header_lines``. ``line_at``
    rises along each file; the place where a file begins is found by its first block."""
    lines = spark.read.text(path).select(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("__block"), F.monotonically_increasing_id().alias("line_at"), F.col("value").alias("line"))
    if not header_lines:
        return lines.drop("__block")
    begin = lines.where(F.col("__block") == 0).groupBy("file").agg(F.min("line_at").alias("__begin"))
    return lines.join(begin, "file", "left").where(F.coalesce(F.col("line_at") >= F.col("__begin") + header_lines, F.lit(True))).drop("__block", "__begin")


def load_delimited(spark: SparkSession, path: str, contract: Contract, header_lines: int = 0) -> tuple[DataFrame, DataFrame]:
    """The rows that keep the contract, typed, and the lines that break it with their ``errors``.
    Both have ``file`` and ``line_at``; no line is in neither or in both. A quoted line break ends
    a line, whose parts then come out as broken quoting."""
    lines = numbered_lines(spark, path, header_lines)
    return valid_rows(lines, "line", contract), broken_rows(lines, "line", contract)


def load_archive_member(spark: SparkSession, archive: str, folder: str, member: str | None = None, constants: dict[str, str] | None = None, row_number: str | None = None) -> tuple[DataFrame, DataFrame]:
    """A member of an archive by its descriptor: its rows, with constant columns and, if named, the
    1-based number of each among the rows and rejected lines of the file, and the rejected lines."""
    tables = inspect_archive(archive)
    m = next(t for t in tables if member in (None, t.location))
    lines = numbered_lines(spark, unpack_member(archive, m.location, folder), m.header_lines).drop("file")
    if row_number:
        lines = with_ordinal(lines, ["line_at"], row_number).withColumn(row_number, F.col(row_number) + 1)
    lines = lines.drop("line_at")
    contract = text_contract(m.fields, sep=m.separator, quote=m.enclosure)
    given = {**dict(m.constants), **(constants or {})}
    rows = valid_rows(lines, "line", contract).withColumns({k: F.lit(v) for k, v in given.items()})
    return rows, broken_rows(lines, "line", contract)


def read_workload(spark: SparkSession, path: str, columns: Sequence[str], kind: str = "auto", schema: T.StructType | None = None) -> DataFrame:
    """JSON lines or Parquet by suffix, only the columns that are there; others come as NULL text."""
    if kind == "auto":
        kind = "json" if path.rstrip("/").endswith((".json", ".jsonl", ".ndjson")) else "parquet"
    df = (spark.read.schema(schema) if schema else spark.read).format(kind).load(path)
    return df.select(*[F.col(f"`{c}`") if c in df.columns else F.lit(None).cast("string").alias(c) for c in columns])


class _Page(HTMLParser):
    def __init__(self) -> None:
        super().__init__()
        self.ld: list[str] = []
        self.meta: list[str] = []
        self.links: list[str] = []
        self.images: list[str] = []
        self._in_ld = False

    def handle_starttag(self, tag: str, attrs: list) -> None:
        a = {k: v or "" for k, v in attrs}
        if tag == "script" and a.get("type") == "application/ld+json":
            self._in_ld = True
        elif tag == "meta" and (a.get("property") or a.get("name")) in ("og:image", "og:image:url", "og:image:secure_url", "twitter:image"):
            self.meta.append(a.get("content", ""))
        elif tag == "link" and a.get("rel") == "image_src":
            self.links.append(a.get("href", ""))
        elif tag == "img":
            self.images.append(a.get("src", ""))

    def handle_endtag(self, tag: str) -> None:
        self._in_ld = self._in_ld and tag != "script"

    def handle_data(self, data: str) -> None:
        if self._in_ld:
            self.ld.append(data)


def image_candidates(html: str | None, base: str) -> list[str]:
    """Image addresses of a page from the first source that has any: structured data, preview
    tags, image links, images; resolved against the page and without repeats, in order."""
    if not html:
        return []
    page = _Page()
    page.feed(html)
    found: list[str] = []

    def walk(x: object) -> None:
        if isinstance(x, dict):
            kind = x.get("@type")
            if kind == "ImageObject" or (isinstance(kind, list) and "ImageObject" in kind):
                found.extend(str(x[k]) for k in ("contentUrl", "url") if isinstance(x.get(k), str))
            for v in x.values():
                walk(v)
        elif isinstance(x, list):
            for v in x:
                walk(v)

    for text in page.ld:
        try:
            walk(json.loads(text))
        except ValueError:
            continue
    for tier in (found, page.meta, page.links, page.images):
        urls = [urljoin(base, u.strip()) for u in tier if u.strip()]
        urls = [u for u in dict.fromkeys(urls) if re.match(r"https?://", u)]
        if urls:
            return urls
    return []


@F.pandas_udf(T.ArrayType(T.StringType()))
def page_images(html: pd.Series, base: pd.Series) -> pd.Series:
    return pd.Series([image_candidates(h if isinstance(h, str) else None, b or "") for h, b in zip(html, base, strict=True)])


def inventory(spark: SparkSession, paths: Sequence[str]) -> DataFrame:
    """``path, n_bytes, digest`` of the files under the paths; digests are made where the
    blocks lie, by tasks that read one file at a time."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(list(paths))
    return files.select("path", F.col("length").alias("n_bytes"), F.concat(F.lit("sha256:"), F.sha2("content", 256)).alias("digest"))
