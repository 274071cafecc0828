"""The three tables' schemas, and drift of a table from its schema."""

from __future__ import annotations

import re
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..errors import InvalidConfig


def _schema(fields: str) -> T.StructType:
    kinds = {"string": T.StringType(), "int": T.IntegerType(), "boolean": T.BooleanType(), "timestamp": T.TimestampType(), "strings": T.ArrayType(T.StringType()), "floats": T.ArrayType(T.FloatType())}
    return T.StructType([T.StructField(n.rstrip("?"), kinds[k], n.endswith("?")) for n, k in (f.split(":") for f in fields.split())])


SETS = _schema("id:string tenant_id:string knowledge_base_id:string document_id:string source_uri:string source_name:string content_sha256:string strategy_name:string profile_name:string profile_version:string config:string status:string created_at:timestamp activated_at?:timestamp")
CHUNKS = _schema("chunk_set_id:string chunk_id:string kind:string level:int parent_chunk_id?:string previous_chunk_id?:string next_chunk_id?:string sequence:int content:string character_count:int token_count:int source_unit_ids:strings metadata:string created_at:timestamp")
EMBEDDINGS = _schema("chunk_set_id:string chunk_id:string model_key:string embedding_text:string embedding_token_count:int input_sha256:string embedding:floats searchable:boolean created_at:timestamp updated_at:timestamp")
TABLES = {"chunk_sets": SETS, "chunks": CHUNKS, "chunk_embeddings": EMBEDDINGS}


def qualified(schema: str, table: str) -> str:
    """A table's quoted name in a catalog; a schema's name that isn't a plain identifier is refused."""
    name = schema.strip()
    if not re.fullmatch(r"[A-Za-z_][A-Za-z0-9_]*", name, re.ASCII):
        raise InvalidConfig("the schema's name isn't an identifier")
    return ".".join(f"`{x.replace('`', '``')}`" for x in (name, table))


@dataclass(frozen=True)
class Drift:
    table: str
    column: str
    problem: str


def drift(found: dict[str, T.StructType], nullability: bool = True) -> list[Drift]:
    """Differences in the order of table and column names; further columns are allowed.

    nullability: also where a column may be null on one side alone. Not for schemas of read Parquet files, where all may be.
    """
    out = []
    for name, schema in sorted(TABLES.items()):
        if name not in found:
            out.append(Drift(name, "", "missing table"))
            continue
        for f in sorted(schema.fields, key=lambda f: f.name):
            have = next((x for x in found[name].fields if x.name == f.name), None)
            if have is None:
                out.append(Drift(name, f.name, "missing column"))
            elif have.dataType.simpleString() != f.dataType.simpleString():
                out.append(Drift(name, f.name, f"{have.dataType.simpleString()} instead of {f.dataType.simpleString()}"))
            elif nullability and have.nullable != f.nullable:
                out.append(Drift(name, f.name, "may be null" if have.nullable else "may not be null"))
    return out


def nulls(name: str, df: DataFrame) -> list[Drift]:
    """Columns of a table that have a null where its schema allows none, counted in one pass: stored Parquet can't say so by itself."""
    needed = sorted(f.name for f in TABLES[name].fields if not f.nullable and f.name in df.columns)
    found = df.agg(*(F.count_if(F.col(c).isNull()).alias(c) for c in needed)).first()
    return [Drift(name, c, f"{found[c]} nulls") for c in needed if found[c]]
