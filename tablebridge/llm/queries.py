"""One registered query per operator, and SQL where SQL can express it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tablebridge.llm.brown import score_texts
from tablebridge.llm.decontamination import find_contaminated
from tablebridge.llm.jaccard import jaccard_groups
from tablebridge.llm.licenses import scan_licenses
from tablebridge.llm.lines import drop_recurring_lines
from tablebridge.llm.onebit import nearest_neighbours
from tablebridge.llm.packing import pack_documents
from tablebridge.llm.quality import classify_quality
from tablebridge.llm.runs import collapse_runs, plant_runs, run_digests
from tablebridge.llm.secrets import scan_secrets
from tablebridge.llm.token_counts import count_tokens
from tablebridge.llm.topk import top_inner_products
from tablebridge.llm.vector_codes import codebooks_digest, compress_vectors, with_label_errors

Query = Callable[[SparkSession, str], DataFrame]


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def vocabulary_path(name: str = "byte_bpe_50k.json") -> str:
    """Place of a public vocabulary file, the same on every machine."""
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_find_contaminated(spark: SparkSession, folder: str) -> DataFrame:
    return find_contaminated(table(spark, folder, "documents"), table(spark, folder, "benchmark"))


def op2_jaccard_groups(spark: SparkSession, folder: str) -> DataFrame:
    return jaccard_groups(table(spark, folder, "documents"))


def op3_pack(spark: SparkSession, folder: str) -> DataFrame:
    return pack_documents(table(spark, folder, "documents"), vocabulary_path())


def op4_top_inner_products(spark: SparkSession, folder: str) -> DataFrame:
    return top_inner_products(table(spark, folder, "embeddings"), F.pmod("vec_id", F.lit(20)) == 0)


def op5_drop_recurring_lines(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text")
    return drop_recurring_lines(docs, dropped="dropped")


def op6_classify_quality(spark: SparkSession, folder: str) -> DataFrame:
    return classify_quality(table(spark, folder, "documents"), table(spark, folder, "labels"))


def op7_count_tokens(spark: SparkSession, folder: str) -> DataFrame:
    return count_tokens(table(spark, folder, "documents"), vocabulary_path())


def op8_scan_licenses(spark: SparkSession, folder: str) -> DataFrame:
    return scan_licenses(table(spark, folder, "documents"))


def op9_scan_secrets(spark: SparkSession, folder: str) -> DataFrame:
    return scan_secrets(table(spark, folder, "documents"))


def op10_score_texts(spark: SparkSession, folder: str) -> DataFrame:
    return score_texts(table(spark, folder, "documents"))


def op11_collapse_runs(spark: SparkSession, folder: str) -> DataFrame:
    return run_digests(collapse_runs(plant_runs(table(spark, folder, "documents"))))


def op12_nearest_neighbours(spark: SparkSession, folder: str) -> DataFrame:
    return nearest_neighbours(table(spark, folder, "embeddings"), F.pmod("vec_id", F.lit(20)) == 0)


def op13_compress_vectors(spark: SparkSession, folder: str) -> DataFrame:
    coded, books = compress_vectors(table(spark, folder, "embeddings"))
    rows = with_label_errors(coded).withColumn("codebooks_sha256", F.lit(codebooks_digest(books)))
    return rows.select("vec_id", "code", "error", "label_error", "codebooks_sha256")


QUERIES: dict[str, Query] = {
    f.__name__: f
    for f in (
        op1_find_contaminated,
        op2_jaccard_groups,
        op3_pack,
        op4_top_inner_products,
        op5_drop_recurring_lines,
        op6_classify_quality,
        op7_count_tokens,
        op8_scan_licenses,
        op9_scan_secrets,
        op10_score_texts,
        op11_collapse_runs,
        op12_nearest_neighbours,
        op13_compress_vectors,
    )
}
TOP_SQL = """
WITH rows AS (
  SELECT vec_id, row_number() OVER () AS r, list_transform(embedding, lambda x: CAST(floor(64 * CAST(x AS DOUBLE)) AS BIGINT)) AS v
  FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), scored AS (
  SELECT q.r, q.vec_id AS query_id, c.vec_id AS vec_id, CAST(list_sum(list_transform(list_zip(q.v, c.v), lambda p: p[1] * p[2])) AS BIGINT) AS score
  FROM (SELECT * FROM rows WHERE vec_id % 20 = 0) q JOIN rows c ON q.r <> c.r
), ranked AS (
  SELECT query_id, CAST(row_number() OVER (PARTITION BY r ORDER BY score DESC, vec_id) AS INTEGER) AS rank, vec_id, score FROM scored
)
SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= 20
"""

GROUPS_SQL = r"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w
  FROM documents
), s AS (
  SELECT doc_id, CASE WHEN len(w) >= 3
      THEN list_distinct(list_transform(range(1, len(w) - 1), lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2]))
    WHEN len(w) > 0 THEN [array_to_string(w, ' ')] ELSE [] END AS g
  FROM w
), n AS (
  SELECT doc_id, len(g) AS n, md5(array_to_string(list_sort(g), chr(10))) AS k FROM s
), nodes AS (
  SELECT k, min(doc_id) AS rep, any_value(n) AS n FROM n WHERE n > 0 GROUP BY k
), e AS (
  SELECT nodes.rep, nodes.n, unnest(s.g) AS g FROM nodes JOIN s ON s.doc_id = nodes.rep
), pairs AS (
  SELECT x.rep AS a, y.rep AS b FROM e x JOIN e y
  ON x.g = y.g AND x.rep < y.rep AND least(x.n, y.n) * 100 >= greatest(x.n, y.n) * 90
  GROUP BY x.rep, y.rep, x.n, y.n HAVING 100 * count(*) >= 90 * (x.n + y.n - count(*))
), links AS (
  SELECT a, b FROM pairs UNION ALL SELECT b, a FROM pairs
), reach AS (
  SELECT rep AS a, rep AS b FROM nodes UNION SELECT reach.a, links.b FROM reach JOIN links ON reach.b = links.a
), least_of AS (
  SELECT a, min(b) AS component FROM reach GROUP BY a
)
SELECT n.doc_id, n.n AS n_shingles, coalesce(c.component, n.doc_id) AS component_id
FROM n LEFT JOIN nodes ON n.k = nodes.k AND n.n > 0 LEFT JOIN least_of c ON c.a = nodes.rep
"""


def _round_sql(turn: int) -> str:
    """Assign all parts by the codebook before, then average; for the codes SQL."""
    return f"""
), a{turn} AS MATERIALIZED (
  SELECT rid, p, min(struct_pack(d := CAST(list_sum(list_transform(list_zip(x, c), lambda z: (z[1] - z[2]) * (z[1] - z[2]))) AS BIGINT), e := e)) AS best
  FROM parts JOIN b{turn - 1} USING (p) GROUP BY rid, p
), s{turn} AS (
  SELECT p, best.e AS e, i, CAST(sum(x[i]) AS BIGINT) AS s, count(*) AS n
  FROM a{turn} JOIN parts USING (rid, p), (SELECT unnest(range(1, 17)) AS i) GROUP BY p, best.e, i
), b{turn} AS MATERIALIZED (
  SELECT b.p, b.e, coalesce(m.c, b.c) AS c FROM b{turn - 1} b
  LEFT JOIN (SELECT p, e, list((s - ((s % n + n) % n)) // n ORDER BY i) AS c FROM s{turn} GROUP BY p, e) m USING (p, e)"""


CODES_SQL = f"""
WITH kept AS MATERIALIZED (
  SELECT row_number() OVER (ORDER BY vec_id) AS rid, vec_id, label, list_transform(embedding, lambda x: CAST(floor(1024 * CAST(x AS DOUBLE)) AS BIGINT)) AS v
  FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), parts AS MATERIALIZED (
  SELECT rid, p, v[p * 16 + 1 : p * 16 + 16] AS x FROM kept, (SELECT unnest(range(4)) AS p)
), b0 AS MATERIALIZED (
  SELECT p, rid - 1 AS e, x AS c FROM parts WHERE rid <= 256{"".join(_round_sql(turn) for turn in range(1, 6))}
), coded AS (
  SELECT rid, string_agg(printf('%02x', best.e), '' ORDER BY p) AS code, CAST(sum(best.d) AS BIGINT) AS error FROM a5 GROUP BY rid
), books AS (
  SELECT sha256(string_agg(array_to_string(c, ','), ',' ORDER BY p, e)) AS codebooks_sha256 FROM b4
)
SELECT vec_id, code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error, codebooks_sha256
FROM kept JOIN coded USING (rid), books
"""

ORACLES: dict[str, str] = {"op2_jaccard_groups": GROUPS_SQL, "op4_top_inner_products": TOP_SQL, "op13_compress_vectors": CODES_SQL}
