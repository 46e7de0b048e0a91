from tidemark.sources.files import preview, read_table, replace_table, write_table
from tidemark.sources.invoices import clean_invoice_lines, clean_purchases, union_sheets

__all__ = [
    "clean_invoice_lines",
    "clean_purchases",
    "preview",
    "read_table",
    "replace_table",
    "union_sheets",
    "write_table",
]
