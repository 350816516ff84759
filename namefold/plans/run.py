"""One call from an input to written results."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from namefold.config import ResolveConfig
from namefold.plans.resolve import resolve
from namefold.sources import files


@dataclass(frozen=True)
class Written:
    """The results, read from where they were written; nothing else of the run is left."""

    mapping: DataFrame
    final: DataFrame


def run(
    spark: SparkSession,
    source: str,
    sink: str,
    name_col: str,
    cfg: ResolveConfig | None = None,
    schema: StructType | str | None = None,
    multi_line: bool = True,
) -> Written:
    """Load ``source``, resolve its names and write mapping and resolved rows to ``sink``.

    ``source``: a path that ends in ``.csv``, a Parquet path, or a catalog table. ``sink``: a folder, which gets
    ``mapping`` as CSV and ``final`` as Parquet, or, without a slash, the beginning of the names of two catalog
    tables. ``schema`` and ``multi_line`` are for CSV.
    """
    if source.rstrip("/").endswith(".csv"):
        rows = files.read_csv(spark, source, name_col, schema, multi_line)
    else:
        rows = files.read_table(spark, source)
    with resolve(rows, name_col, cfg) as result:
        if "/" not in sink:
            names = f"{sink}_mapping", f"{sink}_final"
            files.write_tables(result.mapping, result.final, *names)
            return Written(*(spark.table(n) for n in names))
        folder = sink.rstrip("/")
        files.write_mapping_csv(result.mapping, f"{folder}/mapping")
        files.write_dataset(result.final, f"{folder}/final")
        return Written(files.read_mapping_csv(spark, f"{folder}/mapping"), files.read_table(spark, f"{folder}/final"))
