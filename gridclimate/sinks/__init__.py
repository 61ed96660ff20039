from .scratch import shared_folder
from .tables import merge_table, write_table
from .text import (
    export_csv,
    register_summary_view,
    summary_text,
    text_values,
    to_json_documents,
    write_document,
)

__all__ = [
    "export_csv",
    "merge_table",
    "register_summary_view",
    "shared_folder",
    "summary_text",
    "text_values",
    "to_json_documents",
    "write_document",
    "write_table",
]
