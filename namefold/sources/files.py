"""Reading inputs and writing results."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructType

# Texts that stand for a missing value in CSV input (tables keep them as they are).
CSV_NULLS = (
    "",
    "#N/A",
    "#N/A N/A",
    "#NA",
    "-1.#IND",
    "-1.#QNAN",
    "-NaN",
    "-nan",
    "1.#IND",
    "1.#QNAN",
    "<NA>",
    "N/A",
    "NA",
    "NULL",
    "NaN",
    "None",
    "n/a",
    "nan",
    "null",
)


def read_csv(
    spark: SparkSession, path: str, name_col: str, schema: StructType | str | None = None, multi_line: bool = True
) -> DataFrame:
    """CSV with a header. The name column is text; null texts become null in every column.

    With ``multi_line`` a quoted field may hold line breaks, and a file is read by one task; without it files are
    split, which suits few large files that are known to have no such field.

    Give ``schema`` for large inputs: without it the types of the other columns are inferred, which
    reads the data one extra time.
    """
    options = {"header": True, "multiLine": multi_line, "quote": '"', "escape": '"', "emptyValue": "", "nullValue": ""}
    if schema is None:
        inferred = spark.read.options(**options, inferSchema=True).csv(path).schema
        for field in inferred.fields:
            if field.name == name_col:
                field.dataType = StringType()
        schema = inferred
    rows = spark.read.options(**options).schema(schema).csv(path)
    texts = [f.name for f in rows.schema.fields if isinstance(f.dataType, StringType)]
    return rows.withColumns({c: F.when(~F.col(c).isin(*CSV_NULLS), F.col(c)) for c in texts})


def read_table(spark: SparkSession, name_or_path: str) -> DataFrame:
    """A catalog table, or a Parquet folder when the argument is a path.

    Not cached: the input is read once for its distinct names and once for the final join, and at full
    size it does not fit in memory.
    """
    if "/" in name_or_path:
        return spark.read.parquet(name_or_path)
    return spark.table(name_or_path)


# Line breaks, quotes and blanks at the ends are part of a text.
_EXACT = {"header": True, "escape": '"', "ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False}


def write_mapping_csv(mapping: DataFrame, path: str) -> None:
    """The mapping as CSV with a header; replaces what is there."""
    mapping.write.mode("overwrite").options(**_EXACT).csv(path)


def read_mapping_csv(spark: SparkSession, path: str) -> DataFrame:
    """A mapping written by :func:`write_mapping_csv`; tells a name that cleans to nothing from a null."""
    schema = "original_name string, cleaned_name string, cluster_id bigint, representative_name string"
    # Spark reads an unquoted empty field as the null text and a quoted one as the empty text.
    options = {"header": True, "multiLine": True, "escape": '"', "emptyValue": "", "nullValue": "\u0000"}
    return spark.read.schema(schema).options(**options).csv(path)


def write_dataset(final: DataFrame, path: str, fmt: str = "parquet") -> None:
    """The resolved rows as Parquet or CSV; replaces what is there."""
    writer = final.write.mode("overwrite")
    if fmt == "csv":
        writer.options(**_EXACT).csv(path)
    else:
        writer.format(fmt).save(path)


def write_tables(
    mapping: DataFrame, final: DataFrame, mapping_table: str, final_table: str, location: str | None = None
) -> None:
    """Both results as catalog tables in the catalog's default format; replaces what is there.

    With ``location`` the tables are external ones below that folder.
    """
    for df, table in ((mapping, mapping_table), (final, final_table)):
        writer = df.write.mode("overwrite")
        if location:
            writer = writer.option("path", f"{location.rstrip('/')}/{table.split('.')[-1]}")
        writer.saveAsTable(table)
