"""Column expressions that several operators on texts share.

Operators that hand texts to Python rely on spark.sql.execution.arrow.maxBytesPerBatch (64 MB unless set), which bounds a
batch by bytes whatever its number of rows; one text is never cut by it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: A word is a run of anything but these six characters.
WORD = r"[^\x20\x09-\x0D]+"
BLANKS = " \t\n\u000b\f\r"


def words(text: Column) -> Column:
    """The words of a text; an empty array for null."""
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), r"[\x20\x09-\x0D]+"), "")


def n_words(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def row_key(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> Column:
    """A long that equal rows share and no others: the id where it is there and in one row only throughout df (which is looked up), else a 64-bit hash of id and text, so rows that repeat an id with another text stay apart.

    Call it once for a table and hand the result on; it reads the id column.
    """
    id_ = F.col(id_col).cast("long")
    odd = df.select(id_.alias("id")).groupBy("id").agg(F.count("*").alias("n")).where("n > 1 or id is null")
    return id_ if odd.isEmpty() else F.xxhash64(F.col(id_col), F.col(text_col))


def packed(df: DataFrame, key: Column) -> DataFrame:
    """row (all columns of df in a struct, whatever their names) and key; row.* gives them back."""
    return df.select(F.struct(*[F.col(f"`{c}`") for c in df.columns]).alias("row"), key.alias("key"))


def read(spark, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")
