"""Query and SQL of the n-gram Jaccard join."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from opinionlens.llm.common import read_table
from opinionlens.llm.jaccard import jaccard_components


def op4_jaccard_join(spark: SparkSession, sf: str) -> DataFrame:
    return jaccard_components(read_table(spark, sf, "documents").select("doc_id", "text"))


def jaccard_ctes(source: str = "documents", n: int = 4, percent: int = 85, prefix: str = "j") -> str:
    """Common table expressions that end in ``<prefix>_result`` (doc_id, n_shingles, component_id)."""
    p = prefix
    gram = " || ' ' || ".join(f"w[i + {k}]" for k in range(n))
    return f"""{p}_words AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''),
            'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x20\\x09-\\x0D]+') AS w FROM {source}),
        {p}_grams AS (SELECT DISTINCT doc_id, {gram} AS g
            FROM (SELECT doc_id, w, unnest(range(1, len(w) - {n - 2})) AS i FROM {p}_words WHERE len(w) >= {n})
          UNION ALL SELECT doc_id, array_to_string(w, ' ') FROM {p}_words WHERE len(w) BETWEEN 1 AND {n - 1}),
        {p}_sizes AS (SELECT doc_id, count(*) AS n FROM {p}_grams GROUP BY doc_id),
        {p}_same AS (SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS c FROM {p}_grams x JOIN {p}_grams y
          ON x.g = y.g AND x.doc_id < y.doc_id GROUP BY ALL),
        {p}_links AS MATERIALIZED (SELECT a, b FROM {p}_same JOIN {p}_sizes s ON a = s.doc_id JOIN {p}_sizes t ON b = t.doc_id
          WHERE 100 * c >= {percent} * (s.n + t.n - c)),
        {p}_both AS (SELECT a, b FROM {p}_links UNION ALL SELECT b, a FROM {p}_links),
        {p}_reach AS (SELECT doc_id, doc_id AS r FROM {source} WHERE doc_id IN (SELECT a FROM {p}_both)
          UNION SELECT e.b, w.r FROM {p}_reach w JOIN {p}_both e ON e.a = w.doc_id),
        {p}_least AS (SELECT doc_id, min(r) AS r FROM {p}_reach GROUP BY doc_id),
        {p}_result AS (SELECT d.doc_id, coalesce(s.n, 0) AS n_shingles, coalesce(l.r, d.doc_id) AS component_id
          FROM {source} d LEFT JOIN {p}_sizes s USING (doc_id) LEFT JOIN {p}_least l USING (doc_id))"""


ORACLE = f"WITH RECURSIVE {jaccard_ctes()} SELECT * FROM j_result"
