from fieldmill.sources.delimited import read_delimited, read_with_borrowed_header
from fieldmill.sources.documents import json_view, read_document_records, read_json, write_documents
from fieldmill.sources.footers import filled_columns, footer_stats
from fieldmill.sources.quarantine import read_delimited_apart, read_json_lines_apart
from fieldmill.sources.shared import new_shared_folder, path_exists, remove_shared_folders, stored, stored_path
from fieldmill.sources.tables import bucketed_table, drop_table, load_table, replace_table

__all__ = [
    "bucketed_table",
    "drop_table",
    "filled_columns",
    "footer_stats",
    "json_view",
    "load_table",
    "new_shared_folder",
    "path_exists",
    "read_delimited",
    "read_delimited_apart",
    "read_document_records",
    "read_json",
    "read_json_lines_apart",
    "read_with_borrowed_header",
    "remove_shared_folders",
    "replace_table",
    "stored",
    "stored_path",
    "write_documents",
]
