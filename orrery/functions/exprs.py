"""Identifiers, hashes, texts and vectors as Column expressions that stay inside the JVM."""

from __future__ import annotations

import hashlib
import struct

from pyspark.sql import Column
from pyspark.sql import functions as F

HEX64, UUID = "^[0-9a-f]{64}$", "^[0-9a-fA-F]{8}(-[0-9a-fA-F]{4}){3}-[0-9a-fA-F]{12}$"
LOCK_NAMESPACE = "index-publish:v1"


def trim(c: Column | str) -> Column:
    """Without Unicode white space at either end (Spark's own trim only takes spaces)."""
    return F.regexp_replace(c, r"(?U)^\s+|\s+$", "")


def blank(c: Column | str) -> Column:
    return ~F.coalesce(F.rlike(c, F.lit(r"(?U)\S")), F.lit(False))


def padded(c: Column | str) -> Column:
    """Blank, or with white space at an end: what a stored identifier must not be."""
    c = F.col(c) if isinstance(c, str) else c
    return blank(c) | (c != trim(c))


def sha256(c: Column | str) -> Column:
    return F.sha2(c, 256)


def model_key(model: Column, dimensions: Column, distance: Column, version: Column) -> Column:
    """`model:` and the hash of the model space: its name, dimensions, distance and configuration, joined by NUL."""
    parts = [trim(model), dimensions.cast("string"), trim(distance), trim(version)]
    return F.concat(trim(model), F.lit(":"), F.sha2(F.concat_ws("\0", *parts), 256))


def document_id(uri: Column) -> Column:
    return F.concat(F.lit("document-"), F.substring(F.sha2(trim(uri), 256), 1, 32))


def unit_id(version: Column, index: Column, content: Column) -> Column:
    return F.sha2(F.concat_ws(":", version, index.cast("string"), content), 256)


def display_name(uri: Column) -> Column:
    """The last part of the path of an address or file name, or "document"."""
    path = F.regexp_replace(F.regexp_replace(trim(uri), r"^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*", ""), r"[?#].*$", "")
    base = F.regexp_extract(F.regexp_replace(path, r"[/\\]+$", ""), r"([^/\\]*)$", 1)
    return F.when(base.isin("", "."), F.lit("document")).otherwise(base)


def title(name: Column) -> Column:
    return F.regexp_replace(name, r"\.[^.]*$", "")


def bad_uri(uri: Column) -> Column:
    """Whether a source address breaks the policy: absolute paths, no scheme, credentials, queries, fragments, files, no host."""
    u = trim(uri)
    scheme = F.lower(F.regexp_extract(u, r"^([A-Za-z][A-Za-z0-9+.-]*):", 1))
    authority = F.regexp_extract(u, r"^[^:]*://([^/?#]*)", 1)
    path_like = u.startswith("/") | u.rlike(r"^[A-Za-z]:[\\/]")
    hostless = scheme.isin("http", "https") & (F.regexp_replace(authority, r":\d*$", "") == "")
    return blank(uri) | path_like | (scheme == "") | u.rlike(r"\s") | F.contains(u, F.lit("?")) | F.contains(u, F.lit("#")) | F.contains(authority, F.lit("@")) | (scheme == "file") | hostless


def dot(a: Column, b: Column) -> Column:
    return F.aggregate(F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double")), F.lit(0.0), lambda s, x: s + x)


def norm(v: Column) -> Column:
    return F.sqrt(dot(v, v))


def cosine_distance(a: Column, b: Column, norms: Column | None = None) -> Column:
    """1 - cosine, in doubles from vectors of floats, within 0 and 2; null for a zero vector or unequal dimensions.

    norms: the product of the vectors' norms, where many pairs share them.
    """
    raw = 1 - F.try_divide(dot(a, b), F.sqrt(dot(a, a) * dot(b, b)) if norms is None else norms)
    return F.when((F.size(a) == F.size(b)) & raw.isNotNull(), F.greatest(F.lit(0.0), F.least(F.lit(2.0), raw)))


def narrow(v: Column) -> Column:
    return v.cast("array<float>")


def finite(v: Column) -> Column:
    """Whether every number is one and stays finite as a 32-bit float."""
    return F.coalesce(F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x.cast("double")) & (F.abs(x.cast("float")) < F.lit(float("inf")).cast("float"))), F.lit(False))


def embedding_text_parent_child(heading: Column, content: Column) -> Column:
    return F.when(blank(heading), content).otherwise(F.concat(trim(heading), F.lit("\n\n"), content))


def embedding_text_structure(context: Column, path: Column, content: Column, apart: Column | None = None) -> Column:
    """prepend: the content has its headings already, unless they are `apart`; metadata_only, or apart: headings joined by " > ", a blank line, the content."""
    joined = F.array_join(F.transform(path, trim), " > ")
    there = trim(context) == "prepend"
    if apart is not None:
        there &= ~F.coalesce(apart, F.lit(False))
    return F.when(there, content).when(F.coalesce(F.size(path), F.lit(0)) > 0, F.concat(joined, F.lit("\n\n"), content)).otherwise(content)


def config_parent_child(parent: Column, child: Column) -> Column:
    return F.to_json(F.named_struct(F.lit("parent_max_runes"), parent, F.lit("child_max_runes"), child, F.lit("embedding_input_policy"), F.lit("v1")))


def config_structure(most: Column, least: Column, context: Column) -> Column:
    return F.to_json(F.named_struct(F.lit("max_runes"), most, F.lit("min_runes"), least, F.lit("heading_context"), context, F.lit("embedding_input_policy"), F.lit("v1")))


def lock_key(tenant: str, knowledge_base: str, document: str, strategy: str) -> int:
    """A signed 64-bit number for a scope: fields with their lengths, so that no two scopes have the same bytes."""
    fields = [x.encode() for x in (LOCK_NAMESPACE, tenant, knowledge_base, document, strategy)]
    digest = hashlib.sha256(b"".join(struct.pack(">Q", len(x)) + x for x in fields)).digest()
    return int.from_bytes(digest[:8], "big", signed=True)
