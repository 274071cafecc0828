"""JSON objects: strict checks by VARIANT; canonical text and removal of keys in Arrow batches, as a variant doesn't keep how numbers are written."""

from __future__ import annotations

import json

import pandas as pd
from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Metadata keys that belong to the document, not to the chunk.
SET_KEYS = ("content_sha256", "document_id", "document_version_id", "source_name", "source_uri")


def parse_object(text: str | None) -> dict | None:
    """The object that `text` is, or None: no other value, nothing after it, no NaN or infinities."""

    def refuse(word: str) -> None:
        raise ValueError(word)

    try:
        found = json.loads(text, parse_constant=refuse) if text is not None else None
    except ValueError:
        return None
    return found if isinstance(found, dict) else None


def canonical_text(value: object) -> str:
    return json.dumps(value, sort_keys=True, separators=(",", ":"), ensure_ascii=False)


@F.pandas_udf(T.StringType())
def _canonical(texts: pd.Series) -> pd.Series:
    return texts.map(lambda t: None if (x := parse_object(t)) is None else canonical_text(x))


@F.pandas_udf(T.StringType())
def _stripped(texts: pd.Series) -> pd.Series:
    return texts.map(lambda t: None if (x := parse_object(t)) is None else canonical_text({k: v for k, v in x.items() if k not in SET_KEYS}))


#: Spark's setting: of a key that an object has twice the last value counts, instead of an error.
DUPLICATES = "spark.sql.variant.allowDuplicateKeys"


def is_object(c: Column) -> Column:
    """Whether a text is one JSON object, in the JVM; null texts aren't.

    Spark's parser ends after the first value and ignores the rest. So the text is read as the first of two items of an array,
    the second one being the text's own hash, which no text holds: only if that follows, and follows at once, was it all.
    """
    if spark := SparkSession.getActiveSession():
        spark.conf.set(DUPLICATES, "true")
    items = F.try_parse_json(F.concat(F.lit("["), c, F.lit(',"'), F.sha2(c, 256), F.lit('"]')))
    whole = F.try_variant_get(items, "$[1]", "string") == F.sha2(c, 256)
    return F.coalesce(whole & F.schema_of_variant(F.try_variant_get(items, "$[0]", "variant")).startswith("OBJECT"), F.lit(False))


def canonical(c: Column) -> Column:
    return _canonical(c)


def without_set_keys(c: Column) -> Column:
    return _stripped(c)
