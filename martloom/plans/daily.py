"""The daily run of one source: which tables are loaded from which landed pages, and how.

Pages land as text files, one JSON document per line, below ``<landing>/<database>/``:
``product``, ``productsection``, ``productrow``, ``lists`` (the list catalogue), ``list/<list id>``,
``types`` (the type catalogue), ``item/<type id>``, ``fields/<entity>`` (field catalogues),
``<entity>`` for deal, contact, lead and company, and ``connector/<table>``.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, field
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession, functions as F

from martloom import settings as S
from martloom.operators.columns import fields_of_type
from martloom.operators.loading import reset_log
from martloom.plans.refresh import refresh_connector, refresh_entity, run_all
from martloom.sources.catalogs import (
    entity_type_ids, field_catalogue, list_catalogue, positive_ids, rows_for_owners,
)
from martloom.sources.pages import LANDED, landing_order, read_envelope, unwrap_first, unwrap_key
from martloom.sources.tables import load_table


@dataclass(frozen=True)
class Source:
    """One source database and the optional parts of its run."""

    database: str
    product_sections: bool = False
    product_rows: Mapping[str, str] = field(default_factory=dict)
    invoice_columns: list[str] | None = None
    connector: bool = True
    #: Columns that are not stored, by table; sources differ in them.
    excluded: Mapping[str, Sequence[str]] = field(default_factory=lambda: S.EXCLUDED_COLUMNS)


#: A table and its load, or a catalogue and what makes the jobs it lists.
Job = tuple[str, Callable[[], "bool | list[Job]"]]


def _text(spark: SparkSession, landing: str, source: Source, name: str) -> DataFrame:
    """Landed pages with their place in landing order."""
    return spark.read.text(f"{landing.rstrip('/')}/{source.database}/{name}").select("value", landing_order().alias(LANDED))


def list_jobs(spark: SparkSession, landing: str, root: str, source: Source, at: datetime) -> list[Job]:
    """One job per list of the list catalogue; the catalogue's names come to the driver."""
    pages = _text(spark, landing, source, "lists")
    rows = read_envelope(pages, "value", keep=[LANDED], place="place").select(
        F.col("row")["NAME"].alias("NAME"), F.col("row")["ID"].alias("ID"), F.struct(LANDED, "place").alias("position"))

    def job(name: str, list_id: str) -> Job:
        return f"entity_{name}", lambda: refresh_entity(
            _text(spark, landing, source, f"list/{list_id}"), root, name, at, source.database, reshape=unwrap_first)

    catalogue = list_catalogue(rows, "NAME", "ID", "position").orderBy("name").collect()
    return [job(r.name, r.list_id) for r in catalogue]


def type_jobs(spark: SparkSession, landing: str, root: str, source: Source, at: datetime) -> list[Job]:
    """One job per smart entity type, invoices included."""
    rows = read_envelope(_text(spark, landing, source, "types"), "value", items="types")
    ids = entity_type_ids(rows.select(F.col("row")["entityTypeId"].alias("id")), "id")

    def job(type_id: int) -> Job:
        include = source.invoice_columns if type_id == S.INVOICE_TYPE else None
        return f"entity_{type_id}", lambda: refresh_entity(
            _text(spark, landing, source, f"item/{type_id}"), root, str(type_id), at, source.database,
            items="items", include=include, exclude=source.excluded.get(f"entity_{type_id}", ()), find_dates=True)

    return [job(r.entity_type_id) for r in ids.distinct().orderBy("entity_type_id").collect()]


def entity_job(spark: SparkSession, landing: str, root: str, source: Source, at: datetime, entity: str) -> Job:
    """Id and relation fields of deals, contacts, leads or companies; the table is recreated."""
    def run() -> bool:
        names = fields_of_type(field_catalogue(_text(spark, landing, source, f"fields/{entity}"), "value"))
        columns = ["ID", *(n for n in names if n != "ID")]
        return refresh_entity(_text(spark, landing, source, entity), root, entity, at, source.database,
                              fields=columns, recreate=True)

    return f"entity_{entity}", run


def product_row_job(spark: SparkSession, landing: str, root: str, source: Source, at: datetime, owner: str,
                    owner_type: str) -> Job:
    """Product rows of the owners, stored in ``owner``, whose opportunity is above zero."""
    def of_owners(rows: DataFrame) -> DataFrame:
        stored = load_table(spark, root, owner, source.database)
        stored = stored.withColumn("opportunity", F.col("opportunity").try_cast("double"))
        return rows_for_owners(rows, positive_ids(stored, "id", "opportunity"), "ownerId", "id", "ownerType", owner_type)

    return f"entity_product_{owner}", lambda: refresh_entity(
        _text(spark, landing, source, "productrow"), root, f"product_{owner}", at, source.database,
        items="productRows", reshape=of_owners, find_dates=True)


def daily_jobs(spark: SparkSession, landing: str, root: str, source: Source, at: datetime) -> list[Job]:
    """Every table of a source in loading order.

    The jobs of a catalogue are made when its turn comes, so a missing catalogue stops neither what comes before it nor
    what comes after. Product rows are picked by the stored smart entities, which are loaded in the same run, so they
    come after them.
    """
    def pages(name: str) -> DataFrame:
        return _text(spark, landing, source, name)

    jobs: list[Job] = [("entity_product", lambda: refresh_entity(
        pages("product"), root, "product", at, source.database, reshape=unwrap_key))]
    if source.product_sections:
        jobs.append(("entity_productsection", lambda: refresh_entity(
            pages("productsection"), root, "productsection", at, source.database,
            once_by="ID")))
    jobs += [("lists", lambda: list_jobs(spark, landing, root, source, at)), ("types", lambda: type_jobs(spark, landing, root, source, at))]
    jobs += [product_row_job(spark, landing, root, source, at, o, t) for o, t in source.product_rows.items()]
    jobs += [entity_job(spark, landing, root, source, at, e) for e in S.RECREATED]
    if source.connector:
        jobs += [(t, lambda t=t: refresh_connector(
            pages(f"connector/{t}"), root, t, source.database, exclude=source.excluded.get(t, ()), at=at))
                 for t in S.CONNECTOR_TABLES]
    return jobs


def run_sources(spark: SparkSession, landing: str, root: str, sources: Sequence[Source], at: datetime) -> dict[str, list[str]]:
    """Run all sources in turn; the failed tables of each. A source that fails as a whole is listed as ``*`` and the others go on."""
    failed = {}
    for source in sources:
        try:
            failed[source.database] = run_source(spark, landing, root, source, at)
        except Exception:  # noqa: BLE001 - one source must not stop the others
            failed[source.database] = ["*"]
    return failed


def run_source(spark: SparkSession, landing: str, root: str, source: Source, at: datetime) -> list[str]:
    """Reset the audit table, run every job, and return the tables that failed."""
    reset_log(spark, root, source.database)
    return run_all(spark, daily_jobs(spark, landing, root, source, at), root, at, source.database)
