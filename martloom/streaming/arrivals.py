"""Pages that arrive while the tables are in use."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Observation, SparkSession, functions as F

from martloom.functions.cleaning import clean_entity
from martloom.operators.joins import one_per_key
from martloom.operators.loading import append_new
from martloom.sources.pages import CORRUPT, LANDED, TYPED_ROWS, landing_order, page_rows, parse_pages, spread_map

#: Folder of a table with the landed pages that are no complete JSON.
QUARANTINE = "_quarantine"


def stream_new_rows(spark: SparkSession, in_dir: str, target: str, checkpoint: str, fields: Sequence[str],
                    id_col: str = "ID", payload: str = "result", items: str | None = None,
                    files_per_batch: int | None = None) -> int:
    """Append the records of newly landed pages whose id is not stored yet, then return the number of pages set aside.

    Pages are text files with one JSON document per line. The checkpoint remembers the files that
    are done. A batch that is run again after a failure appends nothing twice, because its ids are
    looked up in the bitmaps beside the stored files; of an id that comes twice the page that landed first counts, in one page the first by
    ``fields``. Rows without an id could not be told from stored ones, so they are left out.

    A page that is no complete JSON does not stop the others: its text and file are kept below ``<target>/_quarantine`` by batch.
    """
    reader = spark.readStream.format("text")
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    pages = reader.load(in_dir).select("value", F.col("_metadata"))
    aside = 0

    def add(batch: DataFrame, number: int) -> None:
        nonlocal aside
        counter = Observation()
        parsed = parse_pages(batch.withColumn(LANDED, landing_order()), "value", payload, items, TYPED_ROWS, [LANDED], corrupt=True)
        parsed = parsed.observe(counter, F.count_if(F.col(f"_page.`{CORRUPT}`").isNotNull()).alias("bad"))
        rows = clean_entity(spread_map(page_rows(parsed, payload, items, [LANDED]), fields, keep=[LANDED]))
        append_new(one_per_key(rows, id_col, [LANDED, *fields]).drop(LANDED), target, id_col)
        if counter.get["bad"]:
            bad = parse_pages(batch.withColumn("file", F.col("_metadata.file_path")), "value", payload, items, TYPED_ROWS, ["value", "file"], corrupt=True)
            bad = bad.where(F.col(f"_page.`{CORRUPT}`").isNotNull()).select("value", "file")
            bad.write.mode("overwrite").json(f"{target.rstrip('/')}/{QUARANTINE}/{number}")
            aside += counter.get["bad"]

    query = pages.writeStream.foreachBatch(add).option("checkpointLocation", checkpoint)
    query.trigger(availableNow=True).start().awaitTermination()
    return aside
