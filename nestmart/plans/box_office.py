"""Landed summary pages to the clean box office dataset (FI-7, SE-3, PG-1, CJ-4 as one flow)."""

from __future__ import annotations

from pyspark.sql import DataFrame

from nestmart.operators.keys import require
from nestmart.operators.pages import extract_box_office
from nestmart.operators.selection import failed_response, settle, to_retry
from nestmart.plans.clean import clean_box_office
from nestmart.session import materialize


def read_pages(first: DataFrame, retry: DataFrame, key: str = "imdb_id",
               html: str = "html") -> DataFrame:
    """Figures of both passes, one row per settled page, as strings (raw ``box_office`` rows).

    A page whose worldwide gross is blank counts as failed. Retry pages are
    parsed only for keys that failed; a key that fails again keeps its blank
    row (the other two datasets drop such keys, ``reconcile_strict``). Each
    pass's figures, three short strings a page, are written to the shared
    scratch folder, since they are read more than once and parsing is what
    costs.
    """
    figures = materialize(extract_box_office(first, key, html), "figures")
    failed = failed_response("box_office")
    again = extract_box_office(to_retry(figures, retry, key, failed), key, html)
    return settle(figures, materialize(again, "figures-retry"), key, failed)


def pages_to_box_office(first: DataFrame, retry: DataFrame, key: str = "imdb_id",
                        html: str = "html") -> DataFrame:
    """Clean box office (typed money, one row per film id) from two passes of landed pages.

    Pages without an id have no place in it and go before they are parsed.
    """
    rows = read_pages(require(first, [key]), retry, key, html).withColumnRenamed(key, "imdb_id")
    return clean_box_office(rows)
