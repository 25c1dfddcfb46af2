"""What a positional file says that its typed table does not: values lost to a cast, incomplete lines."""

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.types import StructType

REJECTED = "line string, field string, value string, reason string"
NOT_OF_TYPE, NO_TITLE, FIELD_COUNT = "not a value of type %s", "missing", "number of fields"


@dataclass(frozen=True)
class Check:
    """A value that is NULL or useless further on: ``lost`` is a condition on the fields as text."""

    field: str
    value: Column
    reason: str
    lost: Column


@dataclass(frozen=True)
class CheckedFile:
    """``rows`` of the lines without any fault, and ``rejected``: one row per fault of the others."""

    rows: DataFrame
    rejected: DataFrame


def check_positional_csv(
    spark: SparkSession, path: str, schema: str, title: tuple[str, str], checks: tuple[Check, ...] = ()
) -> CheckedFile:
    """Each line of a comma-separated file, typed or rejected with the reasons.

    A line is rejected if a field has text that its type does not take, if it has fewer or more
    fields than the schema, if the column that title rows are told by is empty, or by one of
    ``checks``. Title rows and empty lines are neither. Types are read as the reader of the table
    reads them, so a rejected field is one that is NULL there. One pass over the file, no shuffle.
    """
    fields = StructType.fromDDL(schema).fields
    texts = ", ".join(f"`{f.name}` string" for f in fields) + ", `_whole` string"
    lines = spark.read.text(path).where(F.trim("value") != "").withColumnRenamed("value", "_line")
    said = F.from_csv("_line", texts, {"columnNameOfCorruptRecord": "_whole"})
    typed = F.from_csv("_line", ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in fields))
    read = lines.select("_line", typed.alias("_typed"), said.alias("_said")).select("_line", "_typed", "_said.*")

    def fault(when: Column, field: str | None, value: Column, reason: str) -> Column:
        found = (F.lit(field).alias("field"), value.cast("string").alias("value"), F.lit(reason).alias("reason"))
        return F.when(when, F.struct(*found))

    column, text = title
    none = F.lit(None).cast("string")
    faults = [
        fault(F.col(f.name).isNotNull() & F.col("_typed")[f.name].isNull(), f.name, F.col(f.name), NOT_OF_TYPE % f.dataType.simpleString())
        for f in fields
        if f.dataType.simpleString() != "string"
    ]
    faults.append(fault(F.col("_whole").isNotNull(), None, none, FIELD_COUNT))
    faults.append(fault(F.col(column).isNull(), column, none, NO_TITLE))
    faults += [fault(c.lost, c.field, c.value, c.reason) for c in checks]
    judged = read.where(F.coalesce(F.col(column) != text, F.lit(True)))
    judged = judged.select("_line", "_typed", F.array_compact(F.array(*faults)).alias("_faults"))
    rejected = judged.select(F.col("_line").alias("line"), F.inline("_faults"))
    return CheckedFile(judged.where(F.size("_faults") == 0).select("_typed.*"), rejected)
