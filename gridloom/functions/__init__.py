"""Column functions: keys, cell texts, file names, tolerant casts."""

from .cells import cell_text, header_names, safe_tab_name
from .files import file_meta
from .keys import derived_key, full_row_key
from .times import tolerant_timestamp

__all__ = ["cell_text", "derived_key", "file_meta", "full_row_key", "header_names", "safe_tab_name", "tolerant_timestamp"]
