"""Chunks of units: windows of parents and children for texts, heading sections for structured documents.

The split points and ids are this engine's own: windows of a fixed number of code points, blank ones dropped.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..errors import InvalidConfig, OversizeBlock
from ..functions import exprs as X
from ..sources.shared import in_batches

PARENT_CHILD, STRUCTURE_AWARE = "parent_child", "structure_aware"


@dataclass(frozen=True)
class ChunkConfig:
    profile_name: str = "rag-document-indexing"
    profile_version: str = "v2"
    parent_max: int = 2000
    child_max: int = 500
    structure_max: int = 1800
    structure_min: int = 600
    heading_context: str = "prepend"

    def __post_init__(self) -> None:
        if not self.profile_name.strip() or not self.profile_version.strip():
            raise InvalidConfig("the profile has no name or version")
        if not 0 < self.child_max <= self.parent_max or not 0 < self.structure_min <= self.structure_max:
            raise InvalidConfig("limits must be positive, a lower one no more than its upper one")
        if self.heading_context not in ("prepend", "metadata_only"):
            raise InvalidConfig(f"unknown heading context {self.heading_context}")


def windows(text: Column, size: int) -> Column:
    """(at, content) of the windows of `size` code points of a text, without blank ones."""
    cut = F.transform(F.sequence(F.lit(0), F.greatest(F.ceil(F.length(text) / size) - 1, F.lit(0)).cast("int")), lambda i: F.struct(i.alias("at"), F.substr(text, i * size + 1, F.lit(size)).alias("content")))
    return F.filter(cut, lambda w: ~X.blank(w["content"]))


def parents(units: DataFrame, config: ChunkConfig) -> DataFrame:
    """A row for each parent window of each unit (document_id, unit_id, unit_index, content)."""
    rows = units.select("document_id", "unit_id", "unit_index", F.explode(windows(F.col("content"), config.parent_max)).alias("w"))
    rows = rows.select("document_id", "unit_id", "unit_index", F.col("w.at").alias("parent_at"), F.col("w.content").alias("content"))
    return rows.withColumn("chunk_id", F.sha2(F.concat_ws(":", "document_id", F.lit("parent"), "unit_index", "parent_at", "content"), 256))


def children(found: DataFrame, config: ChunkConfig) -> DataFrame:
    """A row for each child window of each parent, with its neighbours: all inside the parent's row, nothing is shuffled."""
    cut = found.withColumn("windows", windows(F.col("content"), config.child_max)).withColumnRenamed("chunk_id", "parent_chunk_id")
    child_id = lambda w: F.sha2(F.concat_ws(":", "parent_chunk_id", F.lit("child"), w["at"], w["content"]), 256)
    cut = cut.withColumn("ids", F.transform("windows", child_id))
    rows = cut.select("document_id", "unit_id", "unit_index", "parent_at", "parent_chunk_id", "ids", F.posexplode("windows").alias("child_at", "w"))
    return rows.select(
        "document_id", "unit_id", "unit_index", "parent_at", "parent_chunk_id", "child_at",
        F.col("w.content").alias("content"), F.get("ids", F.col("child_at")).alias("chunk_id"),
        F.when(F.col("child_at") > 0, F.get("ids", F.col("child_at") - 1)).alias("previous_chunk_id"), F.get("ids", F.col("child_at") + 1).alias("next_chunk_id"),
    )


def _sequenced(rows: DataFrame, order: list[str]) -> DataFrame:
    return rows.withColumn("sequence", F.row_number().over(Window.partitionBy("document_id").orderBy(*order)))


def _finished(rows: DataFrame, sources: Column) -> DataFrame:
    """token_count is this engine's own measure: words between white space."""
    return rows.withColumns({"character_count": F.length("content"), "token_count": F.regexp_count("content", F.lit(r"(?U)\S+")), "source_unit_ids": sources}).select(
        "document_id", "chunk_id", "kind", "level", "parent_chunk_id", "previous_chunk_id", "next_chunk_id", "sequence", "content", "character_count", "token_count", "source_unit_ids", "metadata"
    )


def parent_child(units: DataFrame, config: ChunkConfig = ChunkConfig()) -> DataFrame:
    top = parents(units, config)
    none = F.lit(None).cast("string")
    upper = top.select("document_id", "unit_id", "unit_index", "parent_at", F.lit(-1).alias("child_at"), "content", "chunk_id", none.alias("parent_chunk_id"), none.alias("previous_chunk_id"), none.alias("next_chunk_id"), F.lit("parent").alias("kind"), F.lit(0).alias("level"))
    lower = children(top, config).withColumns({"kind": F.lit("child"), "level": F.lit(1)})
    rows = _sequenced(upper.unionByName(lower), ["unit_index", "parent_at", "child_at"])
    return _finished(rows.withColumn("metadata", F.lit("{}")), F.array("unit_id"))


#: What `windows_of` makes of a document, and the code points of content that it gives back at once.
ROWS = "document_id string, chunk_id string, parent_chunk_id string, previous_chunk_id string, next_chunk_id string, sequence int, content string, character_count int, token_count int, unit_id string"
MOST = 1 << 20
#: White space as `X.blank` has it; the four controls that Python alone counts among it are letters to a count of words.
SPACES = "\t\n\v\f\r \x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000"
CONTROLS = dict.fromkeys(range(0x1C, 0x20), "x")


def words(text: str) -> int:
    """Matches of `(?U)\\S+`."""
    return len((text.translate(CONTROLS) if any(c in text for c in "\x1c\x1d\x1e\x1f") else text).split())


def windows_of(document: str | None, unit: str, index: int, text: str, config: ChunkConfig) -> Iterator[tuple]:
    """A document's parents, each before its children, as ROWS.

    Every window is one slice, so a long text costs no more by the character. A parent has the words of its children, but one
    less where a cut between two of them is inside a word.
    """
    most, size, sequence = config.parent_max, config.child_max, 0
    begin = "".join(f"{p}:" for p in (document, "parent", index) if p is not None)
    for at in range(0, len(text), most):
        content = text[at : at + most]
        if not content.strip(SPACES):
            continue
        parent = hashlib.sha256(f"{begin}{at // most}:{content}".encode()).hexdigest()
        cut = [(i // size, content[i : i + size]) for i in range(0, len(content), size)]
        cut = [(i, w, n) for i, w in cut if (n := words(w))]
        ids = [None, *(hashlib.sha256(f"{parent}:child:{i}:{w}".encode()).hexdigest() for i, w, _ in cut), None]
        split = sum(content[i - 1] not in SPACES and content[i] not in SPACES for i in range(size, len(content), size))
        sequence += 1
        yield document, parent, None, None, None, sequence, content, len(content), sum(n for _, _, n in cut) - split, unit
        for k, (_, w, n) in enumerate(cut, 1):
            sequence += 1
            yield document, ids[k], parent, ids[k - 1], ids[k + 1], sequence, w, len(w), n, unit


def parent_child_rows(units: DataFrame, config: ChunkConfig = ChunkConfig()) -> DataFrame:
    """`parent_child`'s chunks for documents that have one unit each, a row: they are cut, numbered and linked there, nothing is shuffled."""
    integer, names = {"sequence", "character_count", "token_count"}, [c.split()[0] for c in ROWS.split(", ")]
    schema = pa.schema([(n, pa.int32() if n in integer else pa.string()) for n in names])

    def batch(rows: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(v, f.type) for v, f in zip(zip(*rows, strict=True), schema, strict=True)], schema=schema)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows, size = [], 0
        for b in batches:
            for document, unit, index, text in zip(*(c.to_pylist() for c in b.columns), strict=True):
                for row in windows_of(document, unit, index, text or "", config):
                    rows.append(row)
                    size += row[7]
                    if size >= MOST:
                        yield batch(rows)
                        rows, size = [], 0
        if rows:
            yield batch(rows)

    made = in_batches(units.select("document_id", "unit_id", "unit_index", "content"), work, ROWS)
    parent = F.col("parent_chunk_id").isNull()
    return made.select(
        "document_id", "chunk_id", F.when(parent, "parent").otherwise("child").alias("kind"), F.when(parent, 0).otherwise(1).alias("level"), "parent_chunk_id", "previous_chunk_id", "next_chunk_id",
        "sequence", "content", "character_count", "token_count", F.array("unit_id").alias("source_unit_ids"), F.lit("{}").alias("metadata"),
    )


def _size(texts: list[tuple[str, str]]) -> int:
    return sum(len(x) for _, x in texts) + 2 * max(0, len(texts) - 1)


def section_chunks(texts: list[tuple[str, str]], most: int, least: int) -> list[list[tuple[str, str]]]:
    """The texts (unit, text) of a section in runs of at most `most` characters, blank lines between texts included.

    Runs are filled in order. If the last one then has fewer than `least`, it takes texts over from the end of the one before,
    as long as that keeps `least` and it has room.
    """
    out: list[list[tuple[str, str]]] = []
    for x in texts:
        if out and _size([*out[-1], x]) <= most:
            out[-1].append(x)
        else:
            out.append([x])
    if len(out) > 1:
        before, last = out[-2:]
        while _size(last) < least and _size(before[:-1]) >= least and _size([before[-1], *last]) <= most:
            last.insert(0, before.pop())
    return out


def structured(units: list[tuple[str, str, list[str]]], config: ChunkConfig) -> list[tuple[str, list[str], list[str], bool]]:
    """(content, path, units, apart) of each chunk of a document's units (id, content, path).

    A chunk holds units of one heading section; a fenced block is a chunk by itself. With `prepend` the headings and a blank
    line go before the content and count. Headings that would take more than half of a chunk, or no room beside a fenced
    block, stay `apart`: the content is without them, and they go into the text that is embedded. A text that is too long by
    itself is cut; a fenced block is an error.
    """
    most, least, out = config.structure_max, config.structure_min, []
    at = 0
    while at < len(units):
        path = units[at][2]
        end = at
        while end < len(units) and units[end][2] == path:
            end += 1
        head = " > ".join(path) + "\n\n" if config.heading_context == "prepend" and path else ""
        long = len(head) > most // 2
        head = "" if long else head
        room, run = most - len(head), []

        def close(run: list = run, head: str = head, path: list[str] = path, room: int = room, long: bool = long) -> None:
            out.extend((head + "\n\n".join(x for _, x in some), path, [u for u, _ in some], long) for some in section_chunks(run, room, min(least, room)))
            run.clear()

        for unit, content, _ in units[at:end]:
            if content.lstrip()[:3] in ("```", "~~~"):
                if len(content) > most:
                    raise OversizeBlock(f"a block of {len(content)} characters; a chunk has at most {most}")
                close()
                fits = len(content) <= room
                out.append(((head if fits else "") + content, path, [unit], long or not fits))
            else:
                run += [(unit, content[i : i + room]) for i in range(0, len(content), room)]
        close()
        at = end
    return out


def structure_aware(units: DataFrame, config: ChunkConfig = ChunkConfig()) -> DataFrame:
    """Units (document_id, unit_id, unit_index, content, path) as chunks of heading sections (`structured`).

    Documents are grouped, so one document's units are in one task; a null path is an empty one. The metadata of a chunk whose
    headings stay apart from its content say so (`headings_apart`).
    """
    schema = "document_id string, content string, at int, path array<string>, units array<string>, apart boolean"

    def work(t: pd.DataFrame) -> pd.DataFrame:
        rows = t.sort_values("unit_index")[["unit_id", "content", "path"]].itertuples(index=False)
        made = structured([(u, c, [] if p is None else list(p)) for u, c, p in rows], config)
        doc = t["document_id"].iloc[0]
        return pd.DataFrame([(doc, c, i, p, us, a) for i, (c, p, us, a) in enumerate(made)], columns=["document_id", "content", "at", "path", "units", "apart"])

    made = units.select("document_id", "unit_id", "unit_index", "content", "path").groupBy("document_id").applyInPandas(work, schema)
    none = F.lit(None).cast("string")
    before, after = F.lag("chunk_id"), F.lead("chunk_id")
    rows = _sequenced(made, ["at"]).withColumn("chunk_id", structure_id(F.col("sequence"), F.col("content")))
    order = Window.partitionBy("document_id").orderBy("sequence")
    rows = rows.withColumns({"previous_chunk_id": before.over(order), "next_chunk_id": after.over(order), "parent_chunk_id": none, "kind": F.lit("structure"), "level": F.lit(0), "metadata": structure_metadata(F.col("path"), F.col("apart"))})
    return _finished(rows, F.array_distinct("units"))


def structure_id(sequence: Column, content: Column) -> Column:
    return F.sha2(F.concat_ws(":", "document_id", F.lit("structure"), sequence, content), 256)


def structure_metadata(path: Column, apart: Column) -> Column:
    return F.to_json(F.struct(path.alias("semantic_path"), F.when(apart, True).alias("headings_apart")))


def structure_aware_rows(documents: DataFrame, config: ChunkConfig = ChunkConfig()) -> DataFrame:
    """The same chunks for documents that are a row each: document_id and `units`, an array of (unit_id, content, path) in order.

    Nothing is shuffled: a document's chunks are made, numbered and linked in its own row.
    """
    chunk = pa.struct([("content", pa.string()), ("path", pa.list_(pa.string())), ("units", pa.list_(pa.string())), ("apart", pa.bool_())])

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            found = [structured([(u["unit_id"], u["content"], u["path"] or []) for u in units or []], config) for units in b["units"].to_pylist()]
            rows = [[dict(zip(("content", "path", "units", "apart"), c, strict=True)) for c in made] for made in found]
            yield pa.RecordBatch.from_arrays([b["document_id"], pa.array(rows, pa.list_(chunk))], ["document_id", "chunks"])

    made = in_batches(documents.select("document_id", "units"), work, "document_id string, chunks array<struct<content: string, path: array<string>, units: array<string>, apart: boolean>>")
    made = made.withColumn("ids", F.transform("chunks", lambda c, i: structure_id(i + 1, c["content"])))
    rows = made.select("document_id", "ids", F.posexplode("chunks").alias("at", "c"))
    rows = rows.select(
        "document_id", F.get("ids", F.col("at")).alias("chunk_id"), F.lit("structure").alias("kind"), F.lit(0).alias("level"), F.lit(None).cast("string").alias("parent_chunk_id"),
        F.when(F.col("at") > 0, F.get("ids", F.col("at") - 1)).alias("previous_chunk_id"), F.get("ids", F.col("at") + 1).alias("next_chunk_id"),
        (F.col("at") + 1).alias("sequence"), F.col("c.content").alias("content"), F.col("c.units").alias("units"), structure_metadata(F.col("c.path"), F.col("c.apart")).alias("metadata"),
    )
    return _finished(rows, F.array_distinct("units"))


@dataclass(frozen=True)
class AutomaticChunker:
    """Structured units go by their headings, others by windows; never by a file's extension."""

    config: ChunkConfig = ChunkConfig()

    def chunk(self, units: DataFrame) -> DataFrame:
        text = parent_child(units.filter(~F.col("structured")), self.config).withColumn("strategy_name", F.lit(PARENT_CHILD))
        return text.unionByName(structure_aware(units.filter("structured"), self.config).withColumn("strategy_name", F.lit(STRUCTURE_AWARE)))


def statistics(chunks: DataFrame) -> DataFrame:
    return chunks.groupBy("kind").agg(F.count("*").alias("chunks"), F.sum("character_count").alias("characters"), F.max("character_count").alias("longest"))
