"""Payee-like names and rows derived from the given tables, as SQL that Spark and DuckDB both run."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

# Twelve spellings per part: prefixes, dates, junk words, brackets, digits, noise, letter case, spacing,
# dropped and doubled letters, word order, nulls, and a name that cleans to nothing.
PAYEE_NAMES = """
select p_partkey, case p_partkey % 12
 when 0 then p_name || ' ' || lower(p_type)
 when 1 then 'Mr. ' || p_name || ' ' || lower(p_type)
 when 2 then p_name || ' ' || lower(p_type) || ' 12/01/2023'
 when 3 then upper(p_name || ' ' || p_type) || ' LTD.'
 when 4 then '##' || p_name || ' ' || lower(p_type) || '!!!'
 when 5 then substring(p_name,1,2) || substring(p_name,4) || ' ' || lower(p_type)
 when 6 then substring(p_name,1,4) || substring(p_name,4) || ' ' || lower(p_type)
 when 7 then lower(p_type) || ' ' || p_name
 when 8 then p_name || '  ' || lower(p_type) || ' 15 Jan 2020'
 when 9 then replace(p_name,' ','') || ' ' || lower(p_type)
 when 10 then p_name || ' [BACS] ' || lower(p_type) || ' 1234'
 else case when p_partkey % 24 = 11 then null else '#12345678' end
end as payee_name from part
"""

PAYEE_TX = """
select l.l_orderkey, l.l_linenumber, l.l_extendedprice, f.payee_name
from lineitem l join payee_names f on l.l_partkey = f.p_partkey
"""


def payee_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    part = spark.read.parquet(f"{sf_dir}/part.parquet")
    return spark.sql(PAYEE_NAMES.replace("from part", "from {part}"), part=part)


def payee_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    lineitem = spark.read.parquet(f"{sf_dir}/lineitem.parquet")
    sql = PAYEE_TX.replace("from lineitem", "from {lineitem}").replace("join payee_names", "join {names}")
    return spark.sql(sql, lineitem=lineitem, names=payee_names(spark, sf_dir))


# Every kind of text that CSV makes hard, by row number.
HARD_ROWS = """
select l_orderkey, l_linenumber, l_extendedprice, case (l_orderkey + l_linenumber) % 7
 when 0 then payee_name || chr(10) || 'second line' when 1 then '"' || payee_name || '", "quoted"'
 when 2 then 'N/A' when 3 then '  ' || payee_name || ' ' when 4 then 'nan'
 else payee_name end as payee_name from payee_tx
"""


def hard_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    sql = HARD_ROWS.replace("from payee_tx", "from {rows}")
    return spark.sql(sql, rows=payee_rows(spark, sf_dir))
