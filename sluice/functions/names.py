"""File-name expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def base_name(path: Column) -> Column:
    """Last part of a path; a trailing slash is ignored."""
    return F.substring_index(F.rtrim(path, F.lit("/")), "/", -1)


def strip_extension(name: Column) -> Column:
    """Name without its last extension; unchanged when there is no dot."""
    return F.regexp_replace(name, r"\.[^.]*$", "")


def path_suffix(path: Column) -> Column:
    """Last extension of the file name with its dot, or empty; a leading dot starts no extension."""
    return F.regexp_extract(base_name(path), r"^.+(\.[^.]+)$", 1)


def path_stem(path: Column) -> Column:
    """File name without folder and last extension."""
    return F.regexp_replace(base_name(path), r"(?<=.)\.[^.]+$", "")


def ingest_name(path: Column, modified: Column) -> Column:
    """Name a member lands under: stem, modification time, suffix."""
    stamp = F.date_format(modified, "yyyyMMddHHmmss")
    return F.concat(path_stem(path), F.lit("_"), stamp, path_suffix(path))
