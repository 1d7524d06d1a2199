"""Earlier silver partitions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from reviewloom import schemas
from reviewloom.functions import formats
from reviewloom.sources import layouts, parquet


def read_history(
    spark: SparkSession,
    path: str,
    as_of: str,
    schema: StructType = schemas.HISTORY,
    partition_column: str = schemas.PARTITION,
    pending: Sequence[str] = (),
) -> DataFrame:
    """Rows of every partition before ``as_of`` (``yyyyMMdd``).

    The partition column is kept and compared as declared, so the filter prunes
    folders. A first run, with no folder yet, gives an empty frame. Files older
    than the ``segmento`` column read as ``NA``; a null in a newer one stays null.
    ``pending`` are load dates whose run has not been completed: they are left out.
    """
    layout = layouts.with_default(schema, "segmento", formats.NOT_AVAILABLE)
    found = parquet.scan(spark, path, layout, base_path=path)
    if found is None:
        return parquet.empty(spark, schema)
    earlier = found.filter(F.col(partition_column) < F.lit(as_of))
    if pending:
        earlier = earlier.filter(~F.col(partition_column).isin(*pending))
    if "segmento" not in schema.fieldNames():
        return earlier.withColumn("segmento", F.lit(formats.NOT_AVAILABLE))
    return earlier
