"""Query of periodic run detection."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from opinionlens.llm.common import read_table
from opinionlens.llm.periodic import find_runs


def repeating_text(doc_id: str, text: str) -> Column:
    """The text, or for one document in ten its words with the end replaced by repetitions of what begins there."""
    key = F.crc32(F.col(doc_id).cast("string").cast("binary"))
    g = F.floor(key / 10).cast("long")
    words = F.array_remove(F.split(text, "[\\x20\\x09-\\x0D]+"), "")

    def repeated(own: Column) -> Column:
        n = F.size(own).cast("long")
        a = F.pmod(g, n)
        p = 1 + F.floor((n - a) / (3 + F.pmod(g, F.lit(8)))).cast("long")
        place = lambda i: F.when(i < a, i).otherwise(a + F.pmod(i - a, p)).cast("int")
        return F.array_join(F.transform(own, lambda _, i: F.get(own, place(i.cast("long")))), " ")

    # A one-element transform binds the words once, where a plain reuse would split the text for each of them.
    return F.when(F.pmod(key, F.lit(10)) == 0, F.transform(F.array(words), repeated)[0]).otherwise(F.col(text))


def op12_periodic_runs(spark: SparkSession, sf: str) -> DataFrame:
    docs = read_table(spark, sf, "documents").select("doc_id", repeating_text("doc_id", "text").alias("text"))
    found = find_runs(docs)
    lines = F.transform("runs", lambda r: F.concat(r["start"].cast("string"), F.lit(","), r["length"].cast("string"), F.lit(","), r["period"].cast("string"), F.lit("\n")))
    greatest = F.array_max(F.transform("runs", lambda r: F.struct(r["length"].alias("length"), (-r["start"]).alias("start"), (-r["period"]).alias("period"))))
    best = found.withColumns({"__lines": F.array_join(lines, ""), "__best": greatest, "n_runs": F.size("runs").cast("long")})
    return best.select(
        "doc_id",
        "n_runs",
        (-F.col("__best.start")).alias("start"),
        F.col("__best.length").alias("length"),
        (-F.col("__best.period")).alias("period"),
        F.floor(1000 * F.col("__best.length") / -F.col("__best.period")).cast("long").alias("exponent_milli"),
        F.sha2(F.col("__lines").cast("binary"), 256).alias("runs_sha256"),
        F.sha2(F.col("collapsed").cast("binary"), 256).alias("collapsed_sha256"),
    )
