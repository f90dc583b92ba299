"""Documents written once: ids that a retry repeats, and a ledger of the batches a sink holds."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from throngcast.sources.files import create_once, delete_folder, folder_names
from throngcast.sources.keyed import KeyedTable

ID = "_id"
#: What tells the documents of one batch apart, whatever else a retry computes anew.
ID_COLUMNS = ("station_complex_id", "event_timestamp")


@dataclass(frozen=True)
class CommitLedger:
    """The newest batch of a query that its sink holds for certain, as an empty file below ``path``.

    Batches of a query are written one after the other, so those before the newest are held too.
    """

    path: str
    query: str

    def newest(self, spark: SparkSession) -> int | None:
        numbers = [int(n.split("=", 1)[1]) for n in folder_names(spark, self.path) if n.startswith("batch=")]
        return max(numbers, default=None)

    def holds(self, spark: SparkSession, batch_id: int) -> bool:
        newest = self.newest(spark)
        return newest is not None and batch_id <= newest

    def commit(self, spark: SparkSession, batch_id: int) -> None:
        create_once(spark, f"{self.path}/batch={int(batch_id)}")
        for name in folder_names(spark, self.path):
            if name.startswith("batch=") and int(name.split("=", 1)[1]) < batch_id:
                delete_folder(spark, f"{self.path}/{name}")


def document_id(query: str, batch_id: int, columns: Sequence[str]) -> Column:
    """Id of a document by its query, batch and the named columns; null and empty values differ."""
    values = [F.coalesce(F.concat(F.lit("="), F.col(name).cast("string")), F.lit("?")) for name in columns]
    return F.sha2(F.concat_ws("\x1f", F.lit(query), F.lit(str(int(batch_id))), *values), 256)


def document_table(path: str, schema: T.StructType) -> KeyedTable:
    """The Parquet table that stands in for a document store: documents by id, parted by event day."""
    full = schema if ID in schema.names else T.StructType([*schema.fields, T.StructField(ID, T.StringType())])
    return KeyedTable(path, full, [ID], part=F.coalesce(F.date_format("event_timestamp", "yyyy-MM-dd"), F.lit("none")))


def write_documents_once(
    df: DataFrame,
    batch_id: int,
    sink: str,
    ledger: CommitLedger,
    *,
    path: str | None = None,
    id_columns: Sequence[str] = ID_COLUMNS,
    **options: str,
) -> bool:
    """Write the documents of a batch so that a retry, wherever the first attempt ended, repeats none.

    A batch that the ledger holds is left alone (false). Otherwise documents are replaced by their
    id, which the batch and ``id_columns`` decide, and the batch is entered in the ledger after.
    Rows of a batch that agree in ``id_columns`` are one document.
    """
    spark = df.sparkSession
    if ledger.holds(spark, batch_id):
        return False
    documents = df.withColumn(ID, document_id(ledger.query, batch_id, id_columns))
    if sink == "documents":
        document_table(path, df.schema).upsert(documents, batch_id)
    elif sink == "mongodb":
        replacing = {"operationType": "replace", "idFieldList": ID, "upsertDocument": "true", **options}
        documents.write.format("mongodb").options(**replacing).mode("append").save()
    else:
        raise ValueError(f"unsupported sink {sink!r}")
    ledger.commit(spark, batch_id)
    return True
