from pagemill.sources.fetch import fetch_map
from pagemill.sources.files import (
    FILE_ORDER,
    list_files,
    lists_to_literals,
    parse_list_columns,
    query_result_columns,
    read_lines,
    read_page_csv,
    read_query_result,
    records_to_table,
    write_csv_with_lists,
    write_table,
)
from pagemill.sources.listing_chain import batch_links, listing_breaks, listing_complete
from pagemill.sources.listings import (
    batch_count,
    load_category_listing,
    load_page_listing,
    parse_listing_batches,
    read_category_list,
    read_listing_batches,
    read_title_list,
    to_delimited,
    write_delimited,
)
from pagemill.sources.responses import load_parse_responses, load_parsed_pages
from pagemill.sources.storage import (
    shared_root,
    spread_few_splits,
    stage,
    stage_sized,
    work_path,
)
from pagemill.sources.triples import (
    Statement,
    read_triples,
    triple_view,
    triples_from,
    write_triples,
)

__all__ = [
    "FILE_ORDER", "Statement", "batch_count", "batch_links", "fetch_map", "list_files", "listing_breaks", "listing_complete",
    "lists_to_literals",
    "load_category_listing", "load_page_listing", "load_parse_responses", "load_parsed_pages",
    "parse_list_columns", "parse_listing_batches", "query_result_columns", "read_category_list",
    "read_lines", "read_listing_batches", "read_page_csv", "read_query_result", "read_title_list", "read_triples",
    "records_to_table", "shared_root", "spread_few_splits", "stage", "stage_sized", "to_delimited",
    "triple_view", "triples_from",
    "work_path", "write_csv_with_lists", "write_delimited", "write_table", "write_triples",
]
