"""Writes: landing files, tables, tables by bucket, staged copies."""

from chuvisco.sinks.buckets import open_buckets, write_buckets
from chuvisco.sinks.landing import land_csv, land_documents
from chuvisco.sinks.staging import holds_files, path_exists, release, remove_file, remove_path, staged, work_path
from chuvisco.sinks.tables import replace_table, write_table

__all__ = [
    "holds_files",
    "land_csv",
    "land_documents",
    "open_buckets",
    "path_exists",
    "release",
    "remove_file",
    "remove_path",
    "replace_table",
    "staged",
    "work_path",
    "write_buckets",
    "write_table",
]
