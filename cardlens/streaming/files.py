"""Incremental processing of monthly files as they land (Structured Streaming).

The original is run by hand on a folder of monthly files.  The same two
jobs as streams over a landing folder:

* ``per_file_churn_stream`` - H3 on every new file.  The unit is the named
  file, not the part or the batch, so the result does not depend on how
  parts fall into micro-batches.
* ``scoring_stream`` - the scoring pipeline on every new snapshot file,
  with a saved model + preparation artifacts and a per-customer
  transaction-feature table.

Both write through ``foreachBatch`` with dynamic partition overwrite (by
file, or by batch id when scoring), so a replayed batch (after a failure)
rewrites its own partitions instead of appending duplicates.  Checkpoints
go under the shared checkpoint folder unless a location is given.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from cardlens import schemas
from cardlens.operators import churn as ch
from cardlens.session import scratch_path
from cardlens.sources.files import file_name


def _text(reader, landing: str, columns: list[str], encoding: str) -> DataFrame:
    schema = T.StructType([T.StructField(c, T.StringType()) for c in columns])
    df = reader.schema(schema).option("header", True).option("encoding", encoding).csv(landing)
    df = df.withColumns({c: F.when(~F.trim(c).isin(list(schemas.NA_TOKENS)), F.col(c)) for c in columns})
    if schemas.SOURCE_FILE_COL in df.columns:      # ``source_file=<name>/`` folders
        return df.withColumn(schemas.SOURCE_FILE_COL, F.col(schemas.SOURCE_FILE_COL).cast("string"))
    return df.withColumn(schemas.SOURCE_FILE_COL, file_name())


def _text_stream(spark: SparkSession, landing: str, columns: list[str], encoding: str = "ISO-8859-1") -> DataFrame:
    return _text(spark.readStream, landing, columns, encoding)


def per_file_churn_stream(spark: SparkSession, landing: str, out: str, columns: list[str],
                          statuses=schemas.CHURN_STATUSES_PER_FILE, checkpoint: str | None = None,
                          available_now: bool = True) -> StreamingQuery:
    """H3 as files arrive: every row of each new file with its CHURN flag.

    A monthly file may land as any number of parts, in any batches: each batch
    names the files it touched, and those are labelled anew from all their
    landed parts and replace their partition of ``out`` (column ``file``).
    """
    stream = _text_stream(spark, landing, columns)
    name = schemas.SOURCE_FILE_COL

    def label(batch: DataFrame, batch_id: int) -> None:
        touched = batch.select(name).distinct()
        landed = _text(spark.read, landing, columns, "ISO-8859-1").join(touched, name, "left_semi")
        (ch.churn_per_file(landed, statuses).withColumn("file", F.col(name))
         .write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("file").parquet(out))

    w = stream.writeStream.foreachBatch(label).option(
        "checkpointLocation", checkpoint or scratch_path(spark, "stream-ckpt/per-file-churn"))
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime="1 minute")
    return w.start()


def scoring_stream(spark: SparkSession, landing: str, out: str, columns: list[str], model_dir: str,
                   txn_features: DataFrame, as_of, checkpoint: str | None = None,
                   date_formats=None, available_now: bool = True) -> StreamingQuery:
    """The scoring pipeline on each newly landed snapshot file.

    As in ``per_file_churn_stream``, a file may land as any number of parts in any batches: the files that
    a batch touched are scored anew, one by one, from all their landed parts. So a file's statistics
    (median fee, cap) are its own, whatever the batches, and a replayed batch changes nothing.
    """
    from cardlens.functions import drop_present, parse_float, parse_int, parse_timestamp, rename_customer_id
    from cardlens.operators import account_features as af
    from cardlens.operators import joins, sinks
    from cardlens.operators import prepare as pp

    model, art = sinks.load_model(spark, model_dir)
    stream = _text_stream(spark, landing, columns)
    name = schemas.SOURCE_FILE_COL

    def score(batch: DataFrame, batch_id: int) -> None:
        touched = sorted(r[0] for r in batch.select(name).distinct().collect())  # the files of one trigger
        landed = _text(spark.read, landing, columns, "ISO-8859-1")
        for file in touched:
            df = drop_present(rename_customer_id(landed.where(F.col(name) == F.lit(file))), schemas.RETIRED_PRIME_COLS)
            typed = {c: parse_float(c) for c in schemas.PRIME_FLOAT_COLS if c in df.columns}
            typed.update({c: parse_int(c) for c in schemas.PRIME_INT_COLS if c in df.columns})
            typed.update({c: parse_timestamp(c, date_formats) for c in schemas.DATE_COLS_PRIME if c in df.columns})
            wide = joins.merge_features(af.account_features(df.withColumns(typed), as_of), txn_features)
            prepared = pp.transform(wide, art, keep=[schemas.CUSTOMER_ID, name])
            (model.score(prepared, keep=[schemas.CUSTOMER_ID, name]).withColumn("file", F.col(name))
             .write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("file").parquet(out))

    w = stream.writeStream.foreachBatch(score).option(
        "checkpointLocation", checkpoint or scratch_path(spark, "stream-ckpt/scoring"))
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime="1 minute")
    return w.start()
