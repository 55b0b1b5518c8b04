"""What the operators of this subpackage share: input columns, materialised tables, sizes."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ohmbridge.storage import materialize, release, scratch_path  # noqa: F401

#: Rows that one Arrow batch carries to Python; texts are long, so few rows keep a batch to some MB.
ARROW_ROWS = 1000


def tune(spark: SparkSession) -> None:
    """Keep Arrow batches of whole texts small; a smaller setting of the session stays. Spark bounds their bytes."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if int(spark.conf.get(key, "10000")) > ARROW_ROWS:
        spark.conf.set(key, ARROW_ROWS)


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def free_names(taken, *names: str) -> list[str]:
    """``names``, each with underscores put before it until no name of ``taken`` is the same, in upper or lower case."""
    low, out = {x.lower() for x in taken}, []
    for name in names:
        while name.lower() in low:
            name = "_" + name
        low.add(name.lower())
        out.append(name)
    return out


def crc_mod(doc_id, modulus: int):
    """crc32 of the id's decimal text, modulo ``modulus``; null for a null id."""
    return F.crc32(doc_id.cast("string").cast("binary")) % F.lit(modulus)
