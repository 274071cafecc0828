"""The queries of the training-data operators, and SQL for those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from .decontamination import op4_decontamination
from .fingerprints import op10_fingerprints
from .jaccard import op7_jaccard
from .languages import op5_languages
from .medians import op11_medians
from .middle import op12_middle
from .pieces import op9_pieces
from .quality import op8_quality
from .secrets import op13_secrets
from .shards import op2_shards
from .token_files import op1_token_files
from .toxicity import op6_toxicity
from .warc import op3_warc


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "op1_token_files": op1_token_files,
        "op2_shards": op2_shards,
        "op3_warc": op3_warc,
        "op4_decontamination": op4_decontamination,
        "op5_languages": op5_languages,
        "op6_toxicity": op6_toxicity,
        "op7_jaccard": op7_jaccard,
        "op8_quality": op8_quality,
        "op9_pieces": op9_pieces,
        "op10_fingerprints": op10_fingerprints,
        "op11_medians": op11_medians,
        "op12_middle": op12_middle,
        "op13_secrets": op13_secrets,
    }


#: base32 in SQL: the digest's 160 bits, five at a time, as letters of its alphabet.
WARC_SQL = """WITH p AS (SELECT page_id, coalesce(html, '') AS h FROM pages),
d AS (SELECT page_id, strlen(h)::BIGINT AS payload_bytes, CAST(unhex(sha1(h)) AS BIT)::VARCHAR AS bits, max(page_id) OVER (PARTITION BY h) AS kept FROM p)
SELECT page_id, payload_bytes, array_to_string(list_transform(range(32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', 1 + CAST(CAST(substr(bits, CAST(i * 5 + 1 AS BIGINT), 5) AS BIT) AS INTEGER), 1)), '') AS payload_digest,
CASE WHEN page_id = kept THEN 'response' ELSE 'revisit' END AS record_type, CASE WHEN page_id <> kept THEN kept END AS refers_to FROM d"""

JACCARD_SQL = """WITH RECURSIVE w AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x20\\x09-\\x0D]+') AS w FROM documents),
s AS MATERIALIZED (SELECT doc_id, list_distinct(CASE WHEN len(w) >= 3 THEN list_transform(range(1, len(w) - 1), lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2]) WHEN len(w) > 0 THEN [array_to_string(w, ' ')] ELSE [] END) AS s FROM w),
u AS MATERIALIZED (SELECT doc_id, len(s) AS n, unnest(s) AS g FROM s),
l AS MATERIALIZED (SELECT a.doc_id AS a, b.doc_id AS b FROM u a JOIN u b ON a.g = b.g AND a.doc_id <> b.doc_id AND a.n * 100 >= b.n * 90 AND b.n * 100 >= a.n * 90 GROUP BY a.doc_id, b.doc_id, a.n, b.n HAVING count(*) * 100 >= (a.n + b.n - count(*)) * 90),
r(a, b) AS (SELECT doc_id, doc_id FROM s UNION SELECT r.a, l.b FROM r JOIN l ON r.b = l.a)
SELECT s.doc_id, len(s.s) AS n_shingles, min(r.b) AS component_id FROM s JOIN r ON r.a = s.doc_id GROUP BY s.doc_id, s.s"""


MEDIANS_SQL = """WITH d AS (SELECT DISTINCT ON (click_id) click_id, ts, kind, CAST(floor(100 * value + 0.5) AS BIGINT) AS c FROM clicks WHERE ts IS NOT NULL ORDER BY click_id, ts, kind, value),
w AS (SELECT click_id, kind, c, list_sort(list(c) FILTER (WHERE c IS NOT NULL) OVER (PARTITION BY kind ORDER BY ts RANGE BETWEEN INTERVAL 60 MINUTES PRECEDING AND CURRENT ROW)) AS s FROM d),
m AS (SELECT *, coalesce(len(s), 0) AS n, CASE WHEN len(s) >= 2 THEN s[(len(s) + 1) // 2] + s[len(s) // 2 + 1] END AS m FROM w),
r AS (SELECT *, list_sort(list_transform(s, lambda x: abs(2 * x - m))) AS d FROM m)
SELECT click_id, kind, n::BIGINT AS n, m AS median2, CASE WHEN n >= 2 THEN d[(n + 1) // 2] + d[n // 2 + 1] END AS mad4,
2 * abs(2 * c - m) > 3 * CASE WHEN n >= 2 THEN d[(n + 1) // 2] + d[n // 2 + 1] END AS far FROM r"""

MIDDLE_SQL = """WITH h AS (SELECT doc_id, coalesce(text, '') AS t, sha256('7:' || coalesce(doc_id::VARCHAR, '')) AS h, regexp_extract_all(coalesce(text, ''), '[^\n]*\n|[^\n]+') AS u FROM documents),
g AS (SELECT *, len(u)::BIGINT AS n, list_transform(range(4), lambda i: CAST('0x' || substr(h, CAST(1 + 8 * i AS BIGINT), 8) AS BIGINT)) AS g FROM h),
c AS (SELECT *, least(g[1] % (n + 1), g[2] % (n + 1)) AS a, greatest(g[1] % (n + 1), g[2] % (n + 1)) AS b, CASE WHEN t = '' OR contains(t, '<P>') OR contains(t, '<S>') OR contains(t, '<M>') OR g[3] % 100 >= 100 THEN 'plain' WHEN g[4] % 100 < 50 THEN 'spm' ELSE 'psm' END AS form FROM g),
p AS (SELECT *, array_to_string(u[:a], '') AS p, array_to_string(u[a + 1:b], '') AS m, array_to_string(u[b + 1:], '') AS s FROM c)
SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN length(p)::BIGINT END AS prefix_chars, CASE WHEN form <> 'plain' THEN length(m)::BIGINT END AS middle_chars,
sha256(CASE form WHEN 'plain' THEN t WHEN 'psm' THEN '<P>' || p || '<S>' || s || '<M>' || m ELSE '<S>' || s || '<P>' || p || '<M>' || m END) AS output_sha256, sha256(t) AS restored_sha256 FROM p"""


def oracle_sql() -> dict[str, str]:
    """Scheduling through a heap, trained models, edit distances, Viterbi and the hashes of fingerprints aren't SQL's."""
    return {"op3_warc": WARC_SQL, "op7_jaccard": JACCARD_SQL, "op11_medians": MEDIANS_SQL, "op12_middle": MIDDLE_SQL}
