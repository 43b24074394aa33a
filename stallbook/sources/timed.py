"""Tables laid out by time, so that "the newest" and "the last hour" read the newest files only.

Rows lie in one folder per period (an hour or a day), in files sorted by time. The newest time is looked up in the newest
folder that has one; an interval reads the folders of its periods, and within them the row groups that its bounds leave.
The driver sees the names of period folders, never rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

_PERIODS = {"hour": "yyyy-MM-dd-HH", "day": "yyyy-MM-dd"}
_FOLDER = "period"
# Fixed value: the name Spark gives to the folder of rows whose partition column is null.
_UNDATED = "__HIVE_DEFAULT_PARTITION__"


class TimedTable:
    """A Parquet table under ``folder``, clustered by the column ``when``.

    Rows without a time are kept in a folder of their own: they are never recent, and come last in ``latest``. Periods
    follow the session's time zone, so writer and reader need the same, and are in order for years of four digits.
    ``schema`` is that of the rows.
    """

    def __init__(self, spark: SparkSession, folder: str, schema: StructType, when: str, period: str = "hour"):
        if _FOLDER in (name.lower() for name in schema.names):
            raise ValueError(f"the table's folders are named by a column {_FOLDER}, which its rows may not have")
        self.spark, self.folder, self.schema, self.when = spark, folder.rstrip("/"), schema, when
        self._label = lambda time: F.date_format(time, _PERIODS[period])
        self._stored = StructType([*schema.fields, StructField(_FOLDER, StringType())])

    def append(self, rows: DataFrame) -> None:
        """Add rows. A period is cut by time into files; rows of one time are dealt by their hash."""
        placed = rows.select(*self.schema.names).withColumn(_FOLDER, self._label(F.col(self.when)))
        order = (_FOLDER, self.when, F.xxhash64(*self._hashable()))
        placed = placed.repartitionByRange(*order).sortWithinPartitions(_FOLDER, self.when)
        placed.write.mode("append").partitionBy(_FOLDER).parquet(self.folder)

    def _hashable(self) -> list[str]:
        plain = [f.name for f in self.schema.fields if f.dataType.typeName() not in ("map", "variant")]
        return plain or [self.when]

    def periods(self) -> list[str]:
        """Names of the stored periods, newest first, without that of undated rows; a listing of one folder."""
        place = self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(self.folder)
        store = place.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration())
        if not store.exists(place):
            return []
        names = [status.getPath().getName() for status in store.listStatus(place)]
        labels = (name.split("=", 1)[1] for name in names if name.startswith(f"{_FOLDER}="))
        return sorted((label for label in labels if label != _UNDATED), reverse=True)

    def _read(self, labels: list[str]) -> DataFrame:
        """Rows of some periods; the folders of others are not even listed."""
        if not labels:
            return self.spark.createDataFrame([], self.schema)
        paths = [f"{self.folder}/{_FOLDER}={label}" for label in labels]
        reader = self.spark.read.schema(self._stored).option("basePath", self.folder)
        return reader.parquet(*paths).select(*self.schema.names)

    def rows(self) -> DataFrame:
        """All rows, undated ones too."""
        if not self.periods() and not self._has_undated():
            return self.spark.createDataFrame([], self.schema)
        return self.spark.read.schema(self._stored).parquet(self.folder).select(*self.schema.names)

    def _has_undated(self) -> bool:
        place = self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{self.folder}/{_FOLDER}={_UNDATED}")
        return place.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()).exists(place)

    def newest(self) -> str | None:
        """The newest time as Spark writes it, from the newest period that has rows; None in an empty table."""
        for label in self.periods():
            found = self._read([label]).agg(F.max(self.when).cast("string")).first()[0]
            if found is not None:
                return found
        return None

    def as_of(self) -> Column:
        """The newest time as a constant, for operators that otherwise look for it in their rows."""
        return self._constant(self.newest())

    def _constant(self, time: str | None) -> Column:
        return F.lit(time).cast(self.schema[self.when].dataType)

    def recent(self, within: str, inclusive: bool = False) -> DataFrame:
        """Rows of the interval that ends with the newest time; ``inclusive`` takes its first instant in."""
        now = self.newest()
        if now is None:
            return self._read([])
        start = self._constant(now) - F.expr(f"INTERVAL {within}")
        first = self.spark.range(1).select(self._label(start)).first()[0]
        rows = self._read([label for label in self.periods() if label >= first])
        return rows.filter(F.col(self.when) >= start if inclusive else F.col(self.when) > start)

    def latest(self, n: int, *ties: str) -> DataFrame:
        """The n newest rows; of equal times those with the highest ``ties``.

        Periods are read backwards, each time twice as many, until they hold n rows: older ones cannot take part.
        Row counts come from file footers.
        """
        labels, taken, found = self.periods(), 0, 0
        while taken < len(labels) and found < n:
            step = labels[taken : taken + max(taken, 1)]
            found += self._read(step).count()
            taken += len(step)
        kept = labels[:taken]
        if found < n and self._has_undated():
            kept.append(_UNDATED)
        return self._read(kept).orderBy(F.desc(self.when), *(F.desc(key) for key in ties)).limit(n)
