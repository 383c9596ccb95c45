from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import IntegerType, StructField, StructType

from ledgerlake.config import MONTH_SHEETS
from ledgerlake.plans.accounts import actuals_from_cells
from ledgerlake.sources.cells import CELL_SCHEMA


def ingest_new_sheets(spark: SparkSession, landing_dir: str, structure_map: DataFrame, out_dir: str,
                      checkpoint_dir: str):
    """Long facts of the sheets landed since the last run; a sheet that lands
    again replaces its old facts.

    ``landing_dir`` holds ``year=/sheet=`` folders of cell parquet, each landing
    of a sheet as one file with the whole sheet. A micro-batch is a static frame
    of complete sheets, resolved with the batch operator (header and label cells
    meet the cells of their sheet, which a stream-stream join could not express
    without watermarks); a sheet with values and no header row stops the run. Of
    several landings of a sheet in one batch the newest file counts. Facts stand
    in ``year=/sheet=`` folders too, and a batch overwrites just the folders of
    its sheets, so a batch that is replayed after a failure writes the same
    folders again. A landing without any value leaves the old facts.
    """
    schema = StructType([*CELL_SCHEMA.fields, StructField("year", IntegerType())])
    cells = spark.readStream.schema(schema).option("basePath", landing_dir).option("maxFileAge", "36500d") \
        .parquet(landing_dir).withColumn("__landing", F.struct("_metadata.file_modification_time", "_metadata.file_path"))

    def write_batch(batch: DataFrame, batch_id: int) -> None:
        newest = batch.groupBy("year", "sheet").agg(F.max("__landing").alias("__landing"))
        facts = actuals_from_cells(batch.join(newest, ["year", "sheet", "__landing"], "left_semi").drop("__landing"), structure_map)
        facts.withColumn("sheet", F.element_at(F.lit(list(MONTH_SHEETS)), F.col("month"))).write.mode("overwrite") \
            .option("partitionOverwriteMode", "dynamic").partitionBy("year", "sheet").parquet(out_dir)

    return (cells.writeStream.foreachBatch(write_batch).option("checkpointLocation", checkpoint_dir)
            .trigger(availableNow=True).start())
