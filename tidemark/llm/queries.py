"""The queries of this package and, where SQL can express them, their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .bpe import op9_bpe
from .common import table
from .exact_dedup import OP7_SQL, op7_exact_dedup
from .hamming_topk import OP8_SQL, op8_hamming_topk
from .language_id import op4_language_id
from .line_dedup import OP2_SQL, op2_line_dedup
from .mixing import mix, op3_mixing
from .ngram_join import op6_ngram_join
from .secrets import op1_secrets, scan_secrets
from .sharding import op5_sharding, shard_by_bytes
from .suffix_dedup import op10_suffix_dedup


def secrets_base(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What of the secret scan SQL can express: the base spans' numbers and length."""
    found = scan_secrets(table(spark, sf_dir, "documents")).select("doc_id", F.explode("base").alias("s"))
    return found.groupBy("doc_id", F.col("s.kind").alias("kind")).agg(F.count("*").alias("n"), F.sum(F.col("s.end") - F.col("s.start")).alias("code_points"))


def _either_case(word: str) -> str:
    return "".join(f"[{c}{c.upper()}]" if c.isalpha() else c for c in word)


_ASSIGN = "(?:" + "|".join(map(_either_case, ("password", "passwd", "secret", "token", "api_?key"))) + r""")["'']?\x20*[:=]\x20*["'']?([A-Za-z0-9+/_.=-]+)"""
SECRETS_SQL = f"""
WITH t AS (SELECT doc_id, coalesce(text, '') AS text FROM documents),
m AS (SELECT doc_id, 'assign' AS kind, unnest(list_zip(regexp_extract_all(text, '{_ASSIGN}'), regexp_extract_all(text, '{_ASSIGN}', 1))) AS z FROM t),
s AS (SELECT doc_id, kind, length(z[1]) AS size FROM m WHERE length(z[2]) >= 6
  UNION ALL SELECT doc_id, 'access', length(x) FROM (SELECT doc_id, unnest(regexp_extract_all(text, 'AKIA[A-Z0-9]+')) AS x FROM t) WHERE length(x) >= 20
  UNION ALL SELECT doc_id, 'hex', length(x) FROM (SELECT doc_id, unnest(regexp_extract_all(text, '[0-9a-f]+')) AS x FROM t) WHERE length(x) >= 24)
SELECT doc_id, kind, count(*) AS n, CAST(sum(size) AS BIGINT) AS code_points FROM s GROUP BY doc_id, kind
"""


def mix_targets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What of the mix SQL can express: sizes and targets of the sources; and whether no document exceeds twice its size."""
    found = mix(table(spark, sf_dir, "documents"))
    return found.groupBy("source").agg(F.first("source_size").alias("source_size"), F.round(F.first("target")).cast("long").alias("target"), F.count("*").alias("docs"), F.bool_and(F.col("taken") <= 2 * F.col("size")).alias("within"))


MIX_SQL = r"""
WITH d AS (SELECT source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS size FROM documents),
s AS (SELECT source, sum(size) AS size, count(*) AS docs, CASE (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 WHEN 0 THEN 5.0 WHEN 1 THEN 2.0 ELSE 1.0 END AS w FROM d GROUP BY source),
-- Sources at their cap are a prefix in the order of cap over weight.
o AS (SELECT *, 2 * size / w AS ratio, row_number() OVER (ORDER BY 2 * size / w, source NULLS LAST) AS i FROM s),
p AS (SELECT *, 1.5 * sum(size) OVER () - coalesce(sum(2 * size) OVER (ORDER BY i ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS free, sum(w) OVER (ORDER BY i ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS rest FROM o),
u AS (SELECT min(i) AS i, min_by(free / rest, i) AS unit FROM p WHERE free / rest <= ratio)
SELECT source, CAST(size AS BIGINT) AS source_size, CAST(round(CASE WHEN p.i < u.i THEN 2 * size ELSE w * unit END) AS BIGINT) AS target, docs, TRUE AS within FROM p, u
"""


def shard_sizes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What of the sharding SQL can express: sizes, and that all bytes are there once."""
    return shard_by_bytes(table(spark, sf_dir, "documents")).select("doc_id", "size", F.col("shard").between(0, 15).alias("in_range"))


SHARD_SQL = "SELECT doc_id, CAST(coalesce(octet_length(encode(text)), 0) + 1 AS BIGINT) AS size, TRUE AS in_range FROM documents"


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "op1_secrets": op1_secrets,
        "op2_line_dedup": op2_line_dedup,
        "op3_mixing": op3_mixing,
        "op4_language_id": op4_language_id,
        "op5_sharding": op5_sharding,
        "op6_ngram_join": op6_ngram_join,
        "op7_exact_dedup": op7_exact_dedup,
        "op8_hamming_topk": op8_hamming_topk,
        "op9_bpe": op9_bpe,
        "op10_suffix_dedup": op10_suffix_dedup,
        "secrets_base": secrets_base,
        "mix_targets": mix_targets,
        "shard_sizes": shard_sizes,
    }


def oracle_sql() -> dict[str, str]:
    return {"op2_line_dedup": OP2_SQL, "op7_exact_dedup": OP7_SQL, "op8_hamming_topk": OP8_SQL, "secrets_base": SECRETS_SQL, "mix_targets": MIX_SQL, "shard_sizes": SHARD_SQL}
