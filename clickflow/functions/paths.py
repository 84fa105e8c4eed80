"""Part-file path helpers.

Two layouts are understood:
  * ``.../<table>_part_<n>.parquet`` (one file per part);
  * ``.../<table>/part_number=<n>/<file>.parquet`` (what ``export_parts`` writes).
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

_DIR_LAYOUT = r"([^/]+)/part_number=([0-9]+)/[^/]*$"
_FILE_LAYOUT = r"_part_([0-9]+)[.]parquet$"


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def file_name(c) -> Column:
    """Last path segment."""
    return F.regexp_extract(_c(c), r"([^/]*)$", 1)


def part_table_name(c) -> Column:
    """Table of a part file: the name before the first ``_part_``, else the folder above
    ``part_number=<n>``."""
    name = file_name(c)
    return (F.when(name.contains("_part_"), F.substring_index(name, "_part_", 1))
            .otherwise(F.nullif(F.regexp_extract(_c(c), _DIR_LAYOUT, 1), F.lit(""))))


def part_number(c) -> Column:
    """Part number from either layout, null when absent."""
    a = F.nullif(F.regexp_extract(file_name(c), _FILE_LAYOUT, 1), F.lit(""))
    b = F.nullif(F.regexp_extract(_c(c), _DIR_LAYOUT, 2), F.lit(""))
    return F.coalesce(a, b).cast("int")


def staging_name(c) -> Column:
    """Staging name of a one-file part: ``_part_`` -> ``_temp_part_``, extension dropped."""
    name = file_name(c)
    return F.replace(F.replace(name, F.lit("_part_"), F.lit("_temp_part_")), F.lit(".parquet"), F.lit(""))
