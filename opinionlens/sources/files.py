"""Comment CSVs, article text files and word lists."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Fixed texts that pandas reads as missing.
PANDAS_NULLS = (
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN",
    "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
)


def read_csv(
    spark: SparkSession, path: str | Sequence[str], schema: str, multi_line: bool = True, pandas_nulls: bool = False
) -> DataFrame:
    """CSV with header, doubled quotes and quoted line breaks.

    Columns are taken by the header's names. A multi-line file is read by one
    task, so pass many files, or ``multi_line=False`` where no field has a
    line break and large files should be split.
    """
    paths = [path] if isinstance(path, str) else list(path)
    reader = (
        spark.read.schema(schema)
        .option("header", True)
        .option("escape", '"')
        .option("multiLine", multi_line)
        .option("enforceSchema", False)
    )
    df = reader.csv(paths)
    if not pandas_nulls:
        return df
    cells = [
        F.when(~F.col(f"`{f.name}`").isin(*PANDAS_NULLS), F.col(f"`{f.name}`")).alias(f.name)
        if f.dataType.typeName() == "string"
        else F.col(f"`{f.name}`")
        for f in df.schema
    ]
    return df.select(*cells)


def read_articles(spark: SparkSession, path: str) -> DataFrame:
    """(file_name, content): one row per text file."""
    return spark.read.text(path, wholetext=True).select(
        F.col("_metadata.file_name").alias("file_name"), F.col("value").alias("content")
    )


def read_word_lists(spark: SparkSession, paths: Sequence[str], separator: str | None = None) -> DataFrame:
    """Distinct lines of several word lists as (word).

    Lines are kept as they are. With ``separator`` only the first field is
    the word, as in lexicons that carry a frequency.
    """
    lines = spark.read.text(list(paths))
    word = F.col("value") if separator is None else F.split_part("value", F.lit(separator), F.lit(1))
    return lines.select(word.alias("word")).distinct()


def read_lexicon(spark: SparkSession, paths: Sequence[str], separator: str = "\t") -> DataFrame:
    """(word, freq) from ``word<separator>freq`` lines; no number counts as 1."""
    parts = spark.read.text(list(paths)).select(F.split("value", separator).alias("p"))
    word, freq = F.trim(F.get("p", F.lit(0))), F.expr("try_cast(trim(get(p, 1)) as double)")
    return parts.select(word.alias("word"), F.coalesce(freq, F.lit(1.0)).alias("freq")).filter("word <> ''")


def union_words(*lists: DataFrame) -> DataFrame:
    """Distinct words of several one-column DataFrames."""
    out = lists[0].select(F.col(lists[0].columns[0]).alias("word"))
    for other in lists[1:]:
        out = out.union(other.select(other.columns[0]))
    return out.distinct()
