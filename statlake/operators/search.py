"""Catalogue search over a flattened catalogue DataFrame.

The remote service evaluated these filters; here they run over our own
``catalog`` table (one row per statistical table), so predicates on plain
columns push down to the parquet scan.
"""

from __future__ import annotations

import re
from functools import reduce
from operator import and_, or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from statlake.operators.paging import take_rows
from statlake.operators.quality import InvalidArgument, validate_search_args

# Friendly search column -> raw catalogue column, in the
# order the friendly columns are placed at the front of a search result.
SEARCH_COLUMNS = {
    "id": "id",
    "stat_name": "STAT_NAME",
    "statistics_name": "STATISTICS_NAME",
    "title": "TITLE",
    "gov_org": "GOV_ORG",
    "survey_date": "SURVEY_DATE",
    "cycle": "CYCLE",
    "open_date": "OPEN_DATE",
    "updated_date": "UPDATED_DATE",
}

TEXT_COLUMNS = ["STAT_NAME", "STATISTICS_NAME", "TITLE", "GOV_ORG"]


def parse_keyword(keyword: str) -> list[list[str]]:
    """``"a AND b OR c d"`` -> [[a, b], [c, d]]: alternatives, each a list of
    terms that must all occur; AND binds tighter, a space means AND."""
    parts = (re.split(r"\s+AND\s+|\s+", p.strip()) for p in re.split(r"\sOR\s", keyword))
    return [terms for p in parts if (terms := [t for t in p if t])]


def keyword_predicate(df: DataFrame, keyword: str, text_cols: list[str] | None = None) -> Column:
    """Case-insensitive substring match: some alternative of the keyword has
    all its terms in the text columns."""
    cols = [c for c in (text_cols or TEXT_COLUMNS) if c in df.columns]
    def hit(term):
        return reduce(or_, [F.coalesce(F.lower(F.col(c)).contains(F.lit(term.lower())), F.lit(False)) for c in cols], F.lit(False))

    ways = [reduce(and_, map(hit, terms)) for terms in parse_keyword(keyword)]
    return reduce(or_, ways) if ways else F.lit(True)


def collapse_date_range(date_from: str | None, date_to: str | None) -> str | None:
    """None/None -> None; one bound -> that single value; both -> 'from-to'."""
    if date_from is None and date_to is None:
        return None
    if date_to is None:
        return date_from
    if date_from is None:
        return date_to
    return f"{date_from}-{date_to}"


def _digits(c: Column) -> Column:
    return F.regexp_replace(c, "[^0-9]", "")


def period_predicate(col: Column, spec: str, width: int) -> Column:
    """``spec`` is a single period (prefix match) or ``lo-hi`` (inclusive,
    zero-padded low bound, nine-padded high bound) over digit strings."""
    value = F.rpad(_digits(col), width, "0")
    if "-" in spec:
        lo, hi = spec.split("-", 1)
        lo_p = lo.ljust(width, "0")
        hi_p = hi.ljust(width, "9")
        v = F.substring(value, 1, width)
        return v.between(F.lit(lo_p), F.lit(hi_p))
    return value.startswith(F.lit(spec))


def _need(df: DataFrame, column: str, argument: str) -> Column:
    """The column a filter works on; a filter is never skipped in silence."""
    if column not in df.columns:
        raise InvalidArgument(f"{argument} needs the catalogue column {column}")
    return F.col(column)


def search_catalog(catalog: DataFrame, keyword: str | None = None, stats_code: str | None = None,
                   gov_org: str | None = None, survey_years: str | None = None,
                   stats_field: str | None = None, search_kind: str | None = None,
                   updated_from: str | None = None, updated_to: str | None = None,
                   open_years: str | None = None, start_position: int | None = None,
                   limit: int | None = None, order_by: list[str] | None = None) -> DataFrame:
    """Filter the catalogue like the list endpoint does.

    ``start_position``/``limit`` page through the matches in source order
    (``order_by``, default ``id``).
    """
    validate_search_args(stats_code=stats_code, search_kind=search_kind,
                         limit=limit, start_position=start_position)
    df = catalog
    if keyword:
        df = df.where(keyword_predicate(df, keyword))
    if stats_code is not None:
        df = df.where(F.col("STAT_NAME_code").startswith(F.lit(str(stats_code))))
    if gov_org is not None:
        df = df.where(F.col("GOV_ORG_code") == F.lit(str(gov_org)))
    if survey_years is not None:
        df = df.where(period_predicate(F.col("SURVEY_DATE"), str(survey_years), 6))
    if stats_field is not None:
        sf = str(stats_field)
        col = "MAIN_CATEGORY_code" if len(sf) == 2 else "SUB_CATEGORY_code"
        df = df.where(_need(df, col, "stats_field") == F.lit(sf))
    if search_kind is not None:
        _need(df, "SEARCH_KIND", "search_kind")
        df = df.where(F.col("SEARCH_KIND") == F.lit(str(search_kind)))
    updated = collapse_date_range(updated_from, updated_to)
    if updated is not None:
        df = df.where(period_predicate(F.col("UPDATED_DATE"), updated, 8))
    if open_years is not None:
        _need(df, "OPEN_DATE", "open_years")
        df = df.where(period_predicate(F.col("OPEN_DATE"), str(open_years), 8))
    if start_position is not None or limit is not None:
        df = take_rows(df, limit, start_position or 1, order_by=order_by or ["id"], keys=[])
    return df


def reorder_search_columns(df: DataFrame) -> DataFrame:
    """Friendly snake_case names first (in ``SEARCH_COLUMNS`` order), all
    other columns after them in their original order."""
    present = [(new, old) for new, old in SEARCH_COLUMNS.items() if old in df.columns]
    front = [F.col(old).alias(new) for new, old in present]
    used = {old for _, old in present}
    rest = [c for c in df.columns if c not in used]
    return df.select(*front, *rest)


def search_tables(catalog: DataFrame, keyword: str | None = None, gov_org: str | None = None,
                  updated_from: str | None = None, updated_to: str | None = None,
                  limit: int = 100, **filters) -> DataFrame:
    """Interactive search: filters, friendly columns first, 100 rows by default."""
    out = search_catalog(catalog, keyword=keyword, gov_org=gov_org, updated_from=updated_from,
                         updated_to=updated_to, limit=limit, **filters)
    return reorder_search_columns(out)
