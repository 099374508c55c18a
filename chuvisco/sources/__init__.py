"""Scans: CSV, JSON documents, tables, views."""

from chuvisco.sources.delimited import header_mismatch, read_csv
from chuvisco.sources.documents import read_documents, split_documents
from chuvisco.sources.files import list_files, unread_files
from chuvisco.sources.tables import read_declared, read_table, register_views

__all__ = [
    "header_mismatch",
    "list_files",
    "read_csv",
    "read_declared",
    "read_documents",
    "read_table",
    "register_views",
    "split_documents",
    "unread_files",
]
