from pagemill.plans.categories import build_category_table
from pagemill.plans.extract import extract_page_info, extract_pages
from pagemill.plans.graph_queries import games_query, mapping_query, series_query
from pagemill.plans.metrics import PageMetrics, metered_pages
from pagemill.plans.pages import (
    build_game_pages,
    build_nongame_sample,
    build_pages_chunked,
    content_lengths,
    game_names,
    saved_responses,
)

__all__ = [
    "PageMetrics", "build_category_table", "build_game_pages", "build_nongame_sample", "build_pages_chunked",
    "content_lengths", "extract_page_info", "extract_pages", "game_names", "games_query",
    "mapping_query", "metered_pages", "saved_responses", "series_query",
]
