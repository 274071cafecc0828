"""Documents as units: files through a registry of parsers, or rows of a table; blank units go, the others are numbered."""

from __future__ import annotations

import hashlib
import html
import json
import re
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions import exprs as X
from . import web
from .office import parse_docx, parse_xlsx

UNITS = "document_id string, position int, content string, structured boolean, path array<string>"
#: What a parser makes of a document: (content, heading path) for each unit; structured parsers give heading paths.
Parser = Callable[..., list[tuple[str, list[str]]]]


def parse_text(text: str) -> list[tuple[str, list[str]]]:
    return [(text, [])]


def parse_markdown(text: str) -> list[tuple[str, list[str]]]:
    """Blocks of a Markdown text with the headings above them; a fenced block is one unit, a heading by itself none."""
    out, path, lines, fence = [], [], [], None

    def close() -> None:
        if block := "\n".join(lines).strip("\n"):
            out.append((block, [t for _, t in path]))
        lines.clear()

    for line in text.splitlines():
        mark = line.lstrip()[:3]
        if fence:
            lines.append(line)
            if mark == fence:
                fence = None
                close()
        elif mark in ("```", "~~~"):
            close()
            fence = mark
            lines.append(line)
        elif (level := len(line) - len(line.lstrip("#"))) and level <= 6 and line[level : level + 1] in (" ", ""):
            close()
            path[:] = [x for x in path if x[0] < level]
            path.append((level, line[level:].strip().rstrip("#").strip()))
        elif line.strip():
            lines.append(line)
        else:
            close()
    close()
    return out


_html = re.compile(r"""(?is)<!--.*?(?:-->|\Z)|<(?P<raw>script|style|title)\b.*?(?:</(?P=raw)\s*>|\Z)|<(?P<end>/?)(?P<tag>[a-z][a-z0-9-]*)(?:[^>"']|"[^"]*"|'[^']*')*>|<[!?/][^>]*>|[^<]+|<""")
#: Elements that begin and end blocks of text; those of them that are headings; cells of a row.
BLOCKS = frozenset("address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol option p pre search section select summary table tbody textarea tfoot thead tr ul".split())
HEADINGS = {f"h{i}": i for i in range(1, 7)}
CELLS = frozenset(("td", "th"))


def parse_html(text: str) -> list[tuple[str, list[str]]]:
    """All text of a page in blocks, each under the headings above it; comments, scripts, styles and the title are dropped.

    A block is the text between two tags of elements that begin or end one; tags within it are dropped, a line break is a new
    line, a table's cells are between tabs, entities are what they stand for. A heading ends with the next block of any kind,
    and isn't a block itself. Blank blocks are left out.
    """
    out: list[tuple[str, list[str]]] = []
    path: list[tuple[int, str]] = []
    pieces: list[str] = []
    level = 0

    def close() -> None:
        block = html.unescape("".join(pieces)).strip()
        pieces.clear()
        if not block:
            return
        if level:
            path[:] = [p for p in path if p[0] < level]
            path.append((level, " ".join(block.split())))
        else:
            out.append((block, [t for _, t in path]))

    for m in _html.finditer(text):
        tag = (m["tag"] or "").lower()
        if not tag:
            if m[0] == "<" or m[0][0] != "<":
                pieces.append(m[0])
        elif tag == "br":
            pieces.append("\n")
        elif tag in CELLS:
            if not m["end"] and pieces:
                pieces.append("\t")
        elif tag in BLOCKS:
            close()
            level = 0 if m["end"] else HEADINGS.get(tag, 0)
    close()
    return out


#: Media types by extension.
MIME_TYPES = {
    "md": "text/markdown", "markdown": "text/markdown", "txt": "text/plain", "html": "text/html", "htm": "text/html",
    "docx": "application/vnd.openxmlformats-officedocument.wordprocessingml.document", "xlsx": "application/vnd.openxmlformats-officedocument.spreadsheetml.sheet",
}
PARSERS: dict[str, tuple[Parser, bool]] = {
    "md": (parse_markdown, True), "markdown": (parse_markdown, True), "txt": (parse_text, False), "html": (parse_html, True), "htm": (parse_html, True),
    "docx": (parse_docx, True), "xlsx": (parse_xlsx, True),
}
#: Kinds whose parsers take bytes; the others take UTF-8 text.
BINARY = frozenset(("docx", "xlsx"))


def parsed(files: DataFrame, parsers: dict[str, tuple[Parser, bool]] = PARSERS) -> DataFrame:
    """Units of files (uri, kind, content): each parsed by its kind, an unknown kind is an error.

    content_sha256 is the hash of a file's bytes: what a parser leaves out changes the version too.
    """

    def work(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            rows = []
            for uri, kind, content in zip(b.uri, b.kind, b.content, strict=True):
                if kind not in parsers:
                    raise ValueError(f"no parser for .{kind}")
                parser, structured = parsers[kind]
                digest, mime = hashlib.sha256(content).hexdigest(), MIME_TYPES.get(kind, "application/octet-stream")
                rows += [(uri, i, text, structured, path, digest, mime) for i, (text, path) in enumerate(parser(bytes(content) if kind in BINARY else content.decode()))]
            yield pd.DataFrame(rows, columns=["uri", "position", "content", "structured", "path", "content_sha256", "mime_type"])

    found = files.select("uri", "kind", "content").mapInPandas(work, "uri string, " + UNITS.split(", ", 1)[1] + ", content_sha256 string, mime_type string")
    return found.withColumn("document_id", X.document_id(F.col("uri")))


def extension(path: Column) -> Column:
    return F.lower(F.regexp_extract(path, r"\.([^./\\]+)$", 1))


def read_files(spark: SparkSession, path: str, parsers: dict[str, tuple[Parser, bool]] = PARSERS, most_bytes: int = 64 << 20) -> DataFrame:
    """Units of the files under a path of any store, parsed by extension; too large files are errors."""
    files = spark.read.format("binaryFile").load(path)
    if files.filter(F.col("length") > most_bytes).limit(1).count():
        raise ValueError(f"a file has more than {most_bytes} bytes")
    return parsed(files.select(F.col("path").alias("uri"), extension(F.col("path")).alias("kind"), "content"), parsers)


def read_web(spark: SparkSession, addresses: list[str], parsers: dict[str, tuple[Parser, bool]] = PARSERS, **options: object) -> DataFrame:
    """Units of the documents at http(s) addresses, parsed by the extension of the address that answered, or else by its media type.

    options: those of the data source `web_documents`. The units' `uri` is the address that was asked for.
    """
    spark.dataSource.register(web.WebDocuments)
    reader = spark.read.format("web_documents").option("addresses", json.dumps(addresses))
    for name, value in options.items():
        reader = reader.option(name, str(value))
    kinds = F.create_map(*(F.lit(x) for k, m in reversed(MIME_TYPES.items()) for x in (m, k) if m not in ("text/markdown", "text/html") or k in ("md", "html")))
    own = extension(F.col("final_uri"))
    return parsed(reader.load().withColumn("kind", F.when(own.isin(*parsers), own).otherwise(F.coalesce(kinds[F.col("mime_type")], own))), parsers)


def read_source(spark: SparkSession, address: str) -> DataFrame:
    """Units of one source: by HTTP(S), or from a store of Spark's."""
    return read_web(spark, [address]) if re.match("(?i)https?:", address) else read_files(spark, address)


def synthetic_uri(doc_id: Column) -> Column:
    return F.concat(F.lit("synthetic://documents/"), doc_id.cast("string"))


def of_table(docs: DataFrame) -> DataFrame:
    """Documents (doc_id, text, lang, source) as units in the scopes of their source and language."""
    return docs.select(
        X.document_id(synthetic_uri(F.col("doc_id"))).alias("document_id"),
        F.col("source").alias("tenant_id"),
        F.col("lang").alias("knowledge_base_id"),
        synthetic_uri(F.col("doc_id")).alias("uri"),
        X.sha256(F.col("text")).alias("content_sha256"),
        F.lit(0).alias("position"),
        F.col("text").alias("content"),
    )


def prepared(units: DataFrame) -> DataFrame:
    """Drops blank units, numbers the others of a document from 1 by position, and derives ids from version, number and content."""
    order = Window.partitionBy("document_id").orderBy("position")
    kept = units.filter(~X.blank("content")).withColumn("unit_index", F.row_number().over(order))
    return kept.withColumn("unit_id", X.unit_id(F.col("content_sha256"), F.col("unit_index"), F.col("content")))


def prepared_rows(units: DataFrame) -> DataFrame:
    """`prepared` for documents that have one unit each: its number is 1, nothing is shuffled."""
    kept = units.filter(~X.blank("content")).withColumn("unit_index", F.lit(1))
    return kept.withColumn("unit_id", X.unit_id(F.col("content_sha256"), F.col("unit_index"), F.col("content")))


def stamped(units: DataFrame, source_uri: Column, mime_type: Column, unit_type: str = "document") -> DataFrame:
    """Adds to prepared units their metadata: what a column `metadata` (a map of texts) has, under six keys of the document's own."""
    own = F.create_map(*(x for k, v in (("source_uri", source_uri), ("mime_type", mime_type), ("document_id", F.col("document_id")), ("document_version_id", F.col("content_sha256")), ("unit_type", F.lit(unit_type)), ("unit_index", F.col("unit_index").cast("string"))) for x in (F.lit(k), v)))
    if "metadata" not in units.columns:
        return units.withColumn("metadata", own)
    kept = F.map_filter(F.coalesce("metadata", F.create_map().cast("map<string,string>")), lambda k, _: ~F.array_contains(F.map_keys(own), k))
    return units.withColumn("metadata", F.map_concat(kept, own))
