"""Bulk identifier mappings: headerless two-column TSV dumps, one per source."""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import scratch_dir

MAPPING_SCHEMA = "molecule_chembl_id string, source string, xref_id string"


#: Endings of files that are read front to back by one task.
UNSPLITTABLE = (".gz", ".zst", ".xz")
_LINE = "molecule_chembl_id string, xref_id string"


def splittable_lines(spark: SparkSession, path: str, rows_per_file: int) -> DataFrame:
    """The lines of a compressed text file, written once as files of ``rows_per_file`` lines (``value``).

    The one pass over the dump inflates and writes, and holds a buffer of lines; parsing and what follows read the
    written files in as many tasks as they have splits.
    """
    folder = scratch_dir(spark, "lines")
    spark.read.text(path).write.option("maxRecordsPerFile", rows_per_file).parquet(folder)
    return spark.read.schema("value string").parquet(folder)


def _parsed(lines: DataFrame) -> DataFrame:
    """Two tab-separated columns of each line; lines of another shape are dropped, as the file reader does."""
    options = {"sep": "\t", "columnNameOfCorruptRecord": "_bad"}
    row = F.from_csv("value", f"{_LINE}, _bad string", options).alias("r")
    return lines.where(F.length("value") > 0).select(row).where("r._bad is null").select("r.molecule_chembl_id", "r.xref_id")


def read_bulk_mapping(
    spark: SparkSession,
    directory: str,
    files: Mapping[str, str],
    ids: DataFrame,
    partitions: int | None = None,
    rows_per_file: int = 2_000_000,
) -> DataFrame:
    """(molecule, source, reference) of every dump present, limited to known ids.

    ``files`` maps a source name to its file (or folder) below ``directory``; absent ones
    are skipped. A header line is just a row whose id is unknown, so the semi join drops
    it. A compressed file is inflated by one task, which writes its lines to the scratch folder in files of
    ``rows_per_file``; the rest works on those. ``partitions`` redistributes the rows before the join.
    """
    frames: list[DataFrame] = []
    for source, name in files.items():
        path = f"{directory.rstrip('/')}/{name}"
        try:
            if name.endswith(UNSPLITTABLE):
                lines = _parsed(splittable_lines(spark, path, rows_per_file))
            else:
                lines = spark.read.csv(path, sep="\t", schema=_LINE, mode="DROPMALFORMED")
        except AnalysisException as error:
            if "PATH_NOT_FOUND" not in str(error):
                raise
            continue
        frames.append(lines.select("molecule_chembl_id", F.lit(source).alias("source"), "xref_id"))
    if not frames:
        return spark.createDataFrame([], MAPPING_SCHEMA)
    merged = reduce(DataFrame.unionByName, frames)
    if partitions:
        merged = merged.repartition(partitions)
    return merged.join(ids.select("molecule_chembl_id").distinct(), "molecule_chembl_id", "left_semi")
