"""Incremental landing: new receipt files appended idempotently, batch by batch; bad lines go to quarantine."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from ..functions import fixed_values as fixed
from ..sources.files import RECEIPT_SCHEMA, receipt_value_rules
from ..sources.sinks import append_receipts

_BROKEN = "_corrupt_record"
_READ = T.StructType([*RECEIPT_SCHEMA.fields, T.StructField(_BROKEN, T.StringType())])


def parsed_receipts(lines: DataFrame) -> DataFrame:
    """``value`` (a line) with its receipt fields and the line itself where it is not JSON of this shape."""
    return lines.withColumn("_r", F.from_json("value", _READ, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": _BROKEN})).select(
        "value", "_r.*"
    )


def split_receipts(lines: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(receipts that keep every rule, quarantined lines with the rules that each breaks)."""
    names = [f.name for f in RECEIPT_SCHEMA.fields]
    rules = {
        "not a receipt record": F.col(_BROKEN).isNull(),
        **{f"{name} is missing": F.col(name).isNotNull() for name in names},
        **receipt_value_rules(),
        "rights_status is unknown": F.col("rights_status").isin(*fixed.RIGHTS_RANK),
    }
    broken = [F.when(~F.coalesce(ok, F.lit(False)), F.lit(rule)) for rule, ok in rules.items()]
    judged = parsed_receipts(lines).withColumn("broken", F.array_compact(F.array(*broken)))
    return judged.where(F.size("broken") == 0).select(*names), judged.where(F.size("broken") > 0).select("value", "broken")


def land_receipts(
    spark: SparkSession, landing: str, table_path: str, checkpoint: str, quarantine: str | None = None
) -> StreamingQuery:
    """Land JSON receipts that appeared since the last run, then stop.

    A batch replayed after a failure adds nothing to the table, because the append
    compares facts by receipt key; a changed pinned path fails the batch.  Lines that
    are not receipts, or break a receipt rule, are written to ``quarantine``
    (one folder per batch, replaced when the batch is replayed), never appended.
    """
    place = quarantine or f"{table_path.rstrip('/')}-quarantine"

    def land(batch: DataFrame, number: int) -> None:
        good, bad = split_receipts(batch)
        bad.write.mode("overwrite").parquet(f"{place}/batch={number}")
        append_receipts(batch.sparkSession, table_path, good)

    stream = spark.readStream.text(landing).where(F.trim("value") != "")
    return stream.writeStream.foreachBatch(land).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
