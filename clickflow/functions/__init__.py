"""Column-expression helpers (all JVM-side built-ins, no Python UDF)."""

from clickflow.functions.text import blank_to_null, first_truthy, is_blank, strip_ws, to_text, truthy_text
from clickflow.functions.ipv4 import ipv4_to_long, is_ipv4, is_ipv6
from clickflow.functions.paths import part_number, part_table_name, staging_name
from clickflow.functions.html import decode_entities, extract_product_name, strip_tags

__all__ = [
    "blank_to_null", "first_truthy", "is_blank", "strip_ws", "to_text", "truthy_text",
    "ipv4_to_long", "is_ipv4", "is_ipv6", "part_number", "part_table_name", "staging_name",
    "decode_entities", "extract_product_name", "strip_tags",
]
