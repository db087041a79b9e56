"""Filtered extracts of the current-claims and transitions marts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from claimtide.functions.formatting import display_column_name
from claimtide.sources.tables import write_csv

CLAIM_FILTERS = ("country", "status", "source", "carrier_name")
TRANSITION_FILTERS = ("country", "current_status", "source", "carrier_name", "transition_type")
HIDDEN_COLUMNS = ("claim_snapshot_key", "snapshot_date")


def runs_away(search: str) -> bool:
    """Whether a pattern repeats, without a bound, a group that itself holds an
    unbounded repeat or alternatives, as ``(a+)+`` does: matching it may take
    time exponential in the text."""
    inside = [False]  # of the groups open here: holds a repeat or alternatives
    at, closed = 0, False  # closed: the group that ends right before holds one
    while at < len(search):
        c, closing = search[at], False
        if c == "\\":
            at += 1
        elif c == "[":
            end = search.find("]", at + 2 if search[at + 1 : at + 2] != "^" else at + 3)
            at = end if end > 0 else len(search)
        elif c == "(":
            inside.append(False)
        elif c == ")" and len(inside) > 1:
            closing = inside.pop()
            inside[-1] |= closing
        elif c == "|":
            inside[-1] = True
        elif c in "*+" or c == "{" and "," in search[at : search.find("}", at) + 1] and search[search.find("}", at) - 1] == ",":
            if closed:
                return True
            inside[-1] = True
        closed = closing
        at += 1
    return False


def claim_search(search: str, literal: bool = False) -> Column:
    """Case-insensitive 'contains' on the claim number (a regular expression
    unless ``literal``); null claim numbers never match.  A pattern that may run
    away is refused: one row could hold a task for good."""
    text = F.col("claim_number").cast("string")
    if literal:
        return F.lower(text).contains(search.lower())
    if runs_away(search):
        raise ValueError(f"the pattern {search!r} repeats a group of repeats or alternatives; search for the text itself (literal)")
    return text.rlike("(?iu)" + search)


def _filter(df: DataFrame, selections: dict[str, list[str] | None], search: str | None, literal: bool) -> DataFrame:
    for column, values in selections.items():
        if values:
            df = df.where(F.col(column).isin(list(values)))
    if search:
        df = df.where(claim_search(search, literal))
    return df


def filter_claims(
    current: DataFrame,
    country: list[str] | None = None,
    status: list[str] | None = None,
    source: list[str] | None = None,
    carrier_name: list[str] | None = None,
    search: str | None = None,
    literal: bool = False,
) -> DataFrame:
    """AND-ed IN-filters (empty = no filter) and the claim-number search."""
    selections = dict(zip(CLAIM_FILTERS, (country, status, source, carrier_name)))
    return _filter(current, selections, search, literal)


def filter_transitions(
    transitions: DataFrame,
    country: list[str] | None = None,
    current_status: list[str] | None = None,
    source: list[str] | None = None,
    carrier_name: list[str] | None = None,
    transition_type: list[str] | None = None,
    search: str | None = None,
    literal: bool = False,
) -> DataFrame:
    selections = dict(zip(TRANSITION_FILTERS, (country, current_status, source, carrier_name, transition_type)))
    return _filter(transitions, selections, search, literal)


def filter_options(df: DataFrame, columns: tuple[str, ...] | list[str]) -> DataFrame:
    """(dimension, value): sorted distinct non-null values of each column, in
    one distinct over all dimensions (one shuffle, not one per column)."""
    pairs = F.array(*(F.struct(F.lit(c).alias("dimension"), F.col(c).cast("string").alias("value")) for c in columns))
    return (
        df.select(F.inline(pairs))
        .where(F.col("value").isNotNull())
        .distinct()
        .orderBy("dimension", "value")
    )


def drop_hidden(df: DataFrame) -> DataFrame:
    """Drop the key and snapshot date; absent columns are ignored."""
    return df.drop(*HIDDEN_COLUMNS)


def title_case_columns(df: DataFrame) -> DataFrame:
    return df.toDF(*(display_column_name(c) for c in df.columns))


def claims_extract(current: DataFrame, **filters) -> DataFrame:
    """Current Claims extract: filtered, internal columns dropped, headers in
    Title Case."""
    return title_case_columns(drop_hidden(filter_claims(current, **filters)))


def transitions_extract(transitions: DataFrame, **filters) -> DataFrame:
    """Transitions extract, newest report week first."""
    filtered = filter_transitions(transitions, **filters).orderBy(F.col("week_end_date").desc())
    return title_case_columns(drop_hidden(filtered))


def matching_caption(rows: DataFrame | int, noun: str) -> str:
    """``"1,234 matching <noun>"`` for a number of rows, or for a filtered
    extract that isn't written (one count job)."""
    return f"{rows if isinstance(rows, int) else rows.count():,} matching {noun}"


def export(extract: DataFrame, path: str, noun: str) -> str:
    """Writes an extract as CSV and returns its caption; the rows are counted
    on their way into the file, so the extract is computed once."""
    return matching_caption(write_csv(extract, path), noun)


def has_rows(df: DataFrame) -> bool:
    """Emptiness guard without counting everything (stops at the first row)."""
    return not df.isEmpty()
