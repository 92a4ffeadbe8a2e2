"""Search addresses and API query strings."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from gleanwell.config import RESULTS_PER_SEARCH_PAGE, SEARCH_ENDPOINT
from gleanwell.functions.text import as_column


def search_term(language: Column, keyword: Column | str) -> Column:
    return F.concat_ws("+", language, F.translate(as_column(keyword), " ", "+"))


def search_url(term: Column | str, page_no: Column | str, start_offset: Column | int = 0) -> Column:
    """Address of a result page.

    Only the first page uses the saved offset, and only when it is not zero; later pages
    count from the start again.
    """
    page = as_column(page_no) if not isinstance(page_no, int) else F.lit(page_no)
    start = F.lit(start_offset) if isinstance(start_offset, int) else start_offset
    first = F.when(page == 1, start).otherwise((page - 1) * RESULTS_PER_SEARCH_PAGE)
    address = F.concat(F.lit(SEARCH_ENDPOINT), as_column(term))
    return F.when(first == 0, address).otherwise(F.concat(address, F.lit("&first="), first.cast("string")))


def api_query(
    language: Column | str,
    keywords: Column | str,
    exclusions: Column | str,
    exclusion_separator: str = " ",
) -> Column:
    """``in <language> k1|k2 -w1 -w2``; the variant joins the exclusions with ``|``."""
    minus = F.transform(as_column(exclusions), lambda w: F.concat(F.lit("-"), w))
    return F.concat(
        F.lit("in "),
        as_column(language),
        F.lit(" "),
        F.array_join(as_column(keywords), "|"),
        F.lit(" "),
        F.array_join(minus, exclusion_separator),
    )


def cc_api_query(keyword: Column | str, language: Column | str) -> Column:
    return F.concat(as_column(keyword), F.lit(" in "), as_column(language))
