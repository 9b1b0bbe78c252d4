"""Query and SQL of the URL filter."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from opinionlens.llm.common import read_table
from opinionlens.llm.urls import build_digest_store, filter_urls, rule_rows

# The rules of the query.
RULES = (
    ("allow", "com/"),
    ("block", "example.com/en/"),
    ("allow", "www.example.com/en/"),
    ("block", "net/es/"),
    ("block", "net/fr/"),
)


def op2_url_filter(spark: SparkSession, sf: str) -> DataFrame:
    store = build_digest_store(rule_rows(spark, RULES), files=2)
    return filter_urls(read_table(spark, sf, "pages").select("page_id", "url"), store).drop("url")


def _fits(rule: str) -> str:
    host, slash, rest = rule.partition("/")
    return f"((host = '{host}' OR ends_with(host, '.{host}')) AND starts_with(path, '{slash}{rest}'))"


_LONGEST = " ".join(f"WHEN {_fits(r)} THEN '{r}'" for _, r in sorted(RULES, key=lambda x: -len(x[1])))
_BLOCKED = ", ".join(f"'{r}'" for v, r in RULES if v == "block")

ORACLE = f"""WITH u AS (SELECT page_id, translate(regexp_extract(coalesce(url, ''), '(?s)^.*?://([^/?#]*)', 1),
        'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
      regexp_extract(coalesce(url, ''), '(?s)^.*?://[^/?#]*([^?#]*)', 1) AS path FROM pages),
    r AS (SELECT *, CASE {_LONGEST} END AS rule FROM u)
    SELECT page_id, host, path, rule, CASE WHEN rule IN ({_BLOCKED}) THEN 'block' ELSE 'allow' END AS verdict FROM r"""
