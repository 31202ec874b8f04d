from pagemill.operators.chunking import split_byte_ranges, split_bytes, split_even, split_floor, with_position
from pagemill.operators.dedup import count_rows, dedup_any, dedup_keep_first
from pagemill.operators.graph import (
    JOINED,
    TripleGraph,
    alt_label_concat,
    entity_articles,
    instance_of_closure,
    label_lookup,
    language_site_filter,
    optional_match,
    required_match,
    series_mapping,
    subclass_closure,
    with_alt_labels,
)
from pagemill.operators.joins import attach_entity_id, exclude_known_titles
from pagemill.operators.key_filter import MOST_KEYS, KeyFilter
from pagemill.operators.rows import (
    drop_columns,
    drop_disambiguation,
    main_pages,
    parse_ok,
    resolve_redirect_title,
    select_columns,
    split_redirects,
    suffix_filter,
    title_not_null,
    to_page_table,
)
from pagemill.operators.sampling import sample_exact, take_first_n
from pagemill.operators.setops import append_by_name, union_all_list
from pagemill.operators.skew import hot_values, hot_values_by, lookup_join, spread_join
from pagemill.operators.star import AltLabels, Fixed, Label, Values, article_parts, bgp_join, star_match
from pagemill.operators.triple_store import TripleStore

__all__ = [
    "JOINED", "MOST_KEYS", "AltLabels", "Fixed", "KeyFilter", "Label", "TripleGraph", "TripleStore", "Values", "alt_label_concat", "append_by_name",
    "article_parts", "attach_entity_id", "bgp_join",
    "count_rows", "dedup_any", "dedup_keep_first", "drop_columns", "drop_disambiguation",
    "entity_articles",
    "exclude_known_titles", "hot_values", "hot_values_by", "instance_of_closure", "label_lookup",
    "language_site_filter", "lookup_join", "main_pages", "optional_match", "parse_ok",
    "required_match", "resolve_redirect_title", "sample_exact", "select_columns", "series_mapping",
    "split_byte_ranges", "split_bytes", "split_even", "split_floor", "split_redirects", "spread_join",
    "star_match", "subclass_closure", "suffix_filter", "take_first_n", "title_not_null", "to_page_table",
    "union_all_list", "with_alt_labels", "with_position",
]
