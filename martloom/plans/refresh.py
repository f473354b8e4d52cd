"""One run for one table: landed documents, cleaning, column rules, load, audit row."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession, functions as F

from martloom import settings as S
from martloom.functions.cleaning import clean_connector, clean_entity
from martloom.operators.columns import drop_columns, keep_columns
from martloom.operators.loading import SYNC_SCHEMA, key_faults, load_if_nonempty, log_sync, retype_dates
from martloom.operators.quality import date_columns
from martloom.sources.pages import LANDED, TYPED_ROWS, check_pages, dedupe_pages, matrix_columns, read_envelope, read_matrix, spread_map, survey_pages
from martloom.sources.tables import MAIN, table_path


def audit_row(spark: SparkSession, at: datetime, database: str, table: str, loaded: int,
              declared: int | None, error: str | None = None) -> DataFrame:
    """One audit entry; ``at`` is passed in, so that a run can be repeated with the same result."""
    # as text, for a datetime literal would be moved to the time zone of the session
    cells = (at.isoformat(sep=" "), database, table, loaded, declared, error)
    values = (F.lit(v).cast(f.dataType).alias(f.name) for v, f in zip(cells, SYNC_SCHEMA))
    return spark.range(1).select(*values)


def refresh_entity(pages: DataFrame, root: str, entity: str, at: datetime, database: str = MAIN,
                   json_col: str = "value", payload: str = "result", items: str | None = None,
                   fields: Sequence[str] | None = None, reshape: Callable[[DataFrame], DataFrame] | None = None,
                   include: Sequence[str] | None = None, exclude: Sequence[str] = (),
                   find_dates: bool = False, recreate: bool = False, once_by: str | None = None) -> bool:
    """Load ``entity_<entity>`` from landed API pages; False when there was nothing to load.

    ``fields`` lists the columns to take (all that occur, by default), ``reshape`` works on the raw
    columns before they are cleaned (unwrapping properties, picking owners), ``once_by`` is an id that
    counts once, from the earliest page that has it,
    ``find_dates`` types columns made of timestamps only, ``recreate`` drops the stored schema.
    A page that is no complete JSON stops the load, so the stored table stays. The audit row holds the stored and the declared count, and what is wrong
    with the key (``id`` or ``ID``) or the values.
    """
    if fields is None:
        fields, declared = survey_pages(pages, json_col, payload, items)
    else:
        declared = check_pages(pages, json_col)
    if not fields:
        return False
    if once_by:
        numbered = pages if LANDED in pages.columns else pages.withColumn(LANDED, F.monotonically_increasing_id())
        rows = read_envelope(numbered, json_col, payload, items, TYPED_ROWS, keep=[LANDED], place="_place")
        named = rows.withColumn("_id", F.try_element_at("row", F.lit(once_by)).cast("string")).withColumn("_first", F.struct(LANDED, "_place"))
        first = dedupe_pages(named, "_id", "_first")
        raw = spread_map(first, fields)
    else:
        raw = spread_map(read_envelope(pages, json_col, payload, items, TYPED_ROWS), fields)
    raw = reshape(raw) if reshape else raw
    if include is not None:
        raw, _ = keep_columns(raw, include)
    raw = drop_columns(raw, exclude)
    rows = clean_entity(raw)
    if find_dates:
        rows = retype_dates(rows, date_columns(raw))
    table = f"entity_{entity}"
    id_col = next((c for c in ("id", "ID") if c in rows.columns), None)
    loaded = load_if_nonempty(rows, table_path(root, table, database), recreate, id_col)
    if loaded:
        log_sync(audit_row(pages.sparkSession, at, database, table, loaded.rows, declared, key_faults(loaded)), root, database)
    return loaded is not None


def refresh_connector(documents: DataFrame, root: str, table: str, database: str = MAIN,
                      json_col: str = "value", empty_for_null: bool = False,
                      exclude: Sequence[str] | None = None, at: datetime | None = None) -> bool:
    """Load a connector table from landed header-row matrices; it has no declared count, and an audit row only if its key is broken.

    ``exclude`` lists the columns that are not stored, by default those of the settings; ``at`` is the time of the audit row.
    """
    exclude = S.EXCLUDED_COLUMNS.get(table, []) if exclude is None else exclude
    columns = matrix_columns(documents, json_col)
    if not columns:
        return False
    rows = read_matrix(documents, json_col, columns)
    rows = clean_connector(drop_columns(rows, exclude), empty_for_null)
    key = S.TABLE_KEYS.get(table)
    loaded = load_if_nonempty(rows, table_path(root, table, database), id_col=key if key in rows.columns else None)
    if loaded and at and (faults := key_faults(loaded)):
        log_sync(audit_row(documents.sparkSession, at, database, table, loaded.rows, None, faults), root, database)
    return loaded is not None


def run_all(spark: SparkSession, jobs: Sequence[tuple[str, Callable[[], bool | list]]], root: str, at: datetime,
            database: str = MAIN) -> list[str]:
    """Run the named jobs in turn; a job that returns a list has made jobs, which are run next. A job that fails leaves an audit row
    with its error; the others go on.

    Returns the names of the failed ones.
    """
    failed = []
    for table, job in jobs:
        try:
            more = job()
            if isinstance(more, list):
                failed += run_all(spark, more, root, at, database)
        except Exception as e:  # noqa: BLE001 - one source must not stop the others
            failed.append(table)
            log_sync(audit_row(spark, at, database, table, 0, None, (str(e).splitlines() or [type(e).__name__])[0]), root, database)
    return failed
