"""Land a Spark table as dated JSON deliveries, for scenarios and tests.

Writes ``<root>/<dataset>/<yyyyMMdd>/part-*.txt``, each file one envelope
document ``{"Data": [records...], "Meta": ...}``. Each day's records are
split into ``ceil(rows of the day / rows_per_document)`` documents by a hash
of the row, so no document grows with the data, even for a day holding a
third of all rows; ``maxRecordsPerFile=1`` makes every document its own file
(a multiline JSON file holds one document).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quayside.functions.names import col
from quayside.session import new_scratch_path
from quayside.sources import fs
from quayside.sources.landing import LandingFeed


def write_deliveries(df: DataFrame, feed: LandingFeed, day: Column, *, rows_per_document: int = 2000,
                     envelope: str = "Data", meta: str = "delivery") -> list[str]:
    """Write ``df`` as deliveries, one folder per distinct ``day`` value.

    Returns the folders written. Fails if a day folder already exists.
    """
    spark = df.sparkSession
    record = F.struct(*[col(c) for c in df.columns])
    rows = df.select(F.date_format(day, "yyyyMMdd").alias("__day"),
                     F.xxhash64(*[col(c) for c in df.columns]).alias("__hash"), record.alias("__rec"))
    # Documents per day, from one row per day (partial counts before the shuffle).
    per_day = (rows.groupBy("__day").agg(F.count(F.lit(1)).alias("__n"))
               .select("__day", F.greatest(F.lit(1), F.ceil(F.col("__n") / F.lit(rows_per_document)))
                       .alias("__docs")))
    docs = (rows.join(per_day, "__day")
            .select("__day", F.pmod(F.col("__hash"), F.col("__docs")).alias("__doc"), "__rec")
            .groupBy("__day", "__doc")
            .agg(F.collect_list("__rec").alias(envelope))
            .select("__day", F.to_json(F.struct(F.col(envelope), F.lit(meta).alias("Meta"))).alias("value")))
    staging = new_scratch_path(spark, "landing-staging")
    docs.write.option("maxRecordsPerFile", 1).partitionBy("__day").text(staging)
    written = []
    for entry in fs.list_dir(spark, staging):
        if entry.is_dir and entry.name.startswith("__day="):
            target = feed.folder(entry.name.split("=", 1)[1])
            if fs.exists(spark, target):
                raise FileExistsError(target)
            fs.rename(spark, entry.path, target)
            written.append(target)
    fs.delete(spark, staging)
    return sorted(written)
