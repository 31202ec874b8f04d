from pagemill.functions.html import decode_entities, hold_raw_content, paragraph_text, strip_tags
from pagemill.functions.response import (
    external_links,
    first_redirect_target,
    link_titles,
    page_id,
    page_title,
    response_text,
    section_names,
    visible_categories,
)
from pagemill.functions.text import (
    cast_int,
    cast_string,
    category_fields,
    content_length,
    format_line,
    newline_to_dot,
    parse_list_literal,
    square,
    strip_blanks,
    strip_entity_prefix,
    title_from_line,
    to_list_literal,
)

__all__ = [
    "cast_int", "cast_string", "category_fields", "content_length", "decode_entities",
    "external_links", "first_redirect_target", "format_line", "hold_raw_content", "link_titles",
    "newline_to_dot", "page_id", "page_title", "paragraph_text", "parse_list_literal",
    "response_text", "section_names", "square", "strip_blanks", "strip_entity_prefix",
    "strip_tags", "title_from_line", "to_list_literal", "visible_categories",
]
