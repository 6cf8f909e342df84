"""File numbers and file names."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: naming of the yearly record files.
FILE_NAME_FORMAT = "pubmed26n%04d.xml.gz"


def file_name_of(number: Column) -> Column:
    return F.format_string(FILE_NAME_FORMAT, number)


def file_number_of(name: Column) -> Column:
    """Number in a file name, NULL when there is none."""
    digits = F.regexp_extract(name, r"n(\d{4,})\.xml", 1)
    return F.nullif(digits, F.lit("")).cast("int")
