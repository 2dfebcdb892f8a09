"""Order within files, without one task that sees a whole file."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

#: Lines of a run of a file's order that one task goes through.
RUN = 100_000


def with_last(lines: DataFrame, value: str, name: str, ord_: str = "ord", file: str = "file") -> DataFrame:
    """Adds the last non-null `value` at or before each row in order of `ord_`, in place of `value`.

    Rows are taken in runs of the order; a run's last value is handed on by a window of one row for each run. Files are
    apart where the lines name theirs.
    """
    own = F.col(file) if file in lines.columns else F.lit("")
    runs = lines.withColumns({"_file": own, "_run": F.floor(F.col(ord_) / RUN)})
    ends = runs.groupBy("_file", "_run").agg(F.max_by(value, F.when(F.col(value).isNotNull(), F.col(ord_))).alias("_end"))
    earlier = Window.partitionBy("_file").orderBy("_run").rowsBetween(Window.unboundedPreceding, -1)
    carried = ends.select(F.col("_file").alias("_from"), F.col("_run").alias("_of"), F.last("_end", ignorenulls=True).over(earlier).alias("_carried"))
    inside = Window.partitionBy("_file", "_run").orderBy(ord_).rowsBetween(Window.unboundedPreceding, 0)
    last = F.coalesce(F.last(value, ignorenulls=True).over(inside), F.col("_carried"))
    joined = runs.join(carried, (F.col("_run") == F.col("_of")) & (F.col("_file") == F.col("_from")))
    return joined.select(*[c for c in lines.columns if c != value], last.alias(name))
