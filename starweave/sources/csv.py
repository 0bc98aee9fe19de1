"""CSV landing with an explicit all-string schema.

* The header is checked by name (``enforceSchema=false``): a file whose
  columns arrive in another order fails instead of being silently
  mis-assigned by position.
* PERMISSIVE mode keeps malformed lines (too few / too many fields) and
  puts the raw line into ``_corrupt_record`` so Silver can quarantine it.
"""
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StringType, StructField, StructType

from .contracts import Contract

CORRUPT_COLUMN = "_corrupt_record"


def read_extract(spark: SparkSession, path: str, contract: Contract,
                 check_header: bool = True) -> DataFrame:
    schema = StructType(contract.schema().fields + [StructField(CORRUPT_COLUMN, StringType(), True)])
    return (
        spark.read
        .option("header", "true")
        .option("mode", "PERMISSIVE")
        .option("columnNameOfCorruptRecord", CORRUPT_COLUMN)
        .option("enforceSchema", "false" if check_header else "true")
        .schema(schema)
        .csv(path)
    )
