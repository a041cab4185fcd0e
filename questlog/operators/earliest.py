"""The earliest value of each attribute as one number, so that hash aggregates can find it.

The least of (time, value) pairs is a struct with text, which Spark's hash
aggregate cannot keep in place: it would sort all events, before and after the
shuffle. Here values are coded in their own order, and a time and a code make
one number of fixed width, whose least is the value of the earliest row that
has one, the smallest on a tie.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from questlog.functions import minute_index

ATTRIBUTES = ["platform", "country", "app_version"]

#: Bits of a code, and of the microseconds in a minute.
_CODE_BITS, _MICRO_BITS = 17, 26
#: Later than any time: rows without one come last.
_FAR = 1 << 60
#: Combinations of values up to which the driver numbers them and their codes are broadcast, some 10 MB. Beyond, pairs
#: are compared as such.
MAX_COMBINATIONS = 1 << _CODE_BITS


def moment(time: Column) -> Column:
    """A time as a number that orders like it: its minute and the microseconds in that."""
    micros = (F.extract(F.lit("SECOND"), time) * F.lit(1_000_000)).cast("bigint")
    return F.coalesce(F.shiftleft(minute_index(time), _MICRO_BITS) + micros, F.lit(_FAR))


def pair(attribute: str, time: Column) -> Column:
    """(moment, value) of an attribute; NULL without a value."""
    value = F.col(attribute)
    return F.when(value.isNotNull(), F.struct(moment(time).alias("at"), value.alias("value")))


class Codes:
    """Numbers for the values that ``ATTRIBUTES`` have in some rows, in the order of the values.

    ``pack`` makes numbers of pairs, ``unpack`` pairs of numbers; with too many
    combinations to broadcast both leave pairs as they are.
    """

    def __init__(self, values: DataFrame, most: int = MAX_COMBINATIONS):
        spark = values.sparkSession
        found = values.select(*ATTRIBUTES).distinct().limit(most + 1).collect()
        self.few = len(found) <= most
        if not self.few:
            return
        # text orders alike here and in Spark: by code points
        numbers = {a: {v: n for n, v in enumerate(sorted({r[a] for r in found} - {None}))} for a in ATTRIBUTES}
        rows = [(*r, *(numbers[a].get(r[a]) for a in ATTRIBUTES)) for r in found]
        kind = ", ".join([f"_{a} string" for a in ATTRIBUTES] + [f"{a}_code int" for a in ATTRIBUTES])
        self._combinations = spark.createDataFrame(rows, kind)
        self._values = {a: spark.createDataFrame(list(numbers[a].items()), "_value string, _code int") for a in ATTRIBUTES}

    def _with_codes(self, rows: DataFrame, values: dict[str, Column]) -> DataFrame:
        same = [values[a].eqNullSafe(F.col(f"_{a}")) for a in ATTRIBUTES]
        return rows.join(F.broadcast(self._combinations), same).drop(*[f"_{a}" for a in ATTRIBUTES])

    def _without_codes(self, rows: DataFrame, packed: dict[str, Column]) -> DataFrame:
        codes = [f"{a}_code" for a in ATTRIBUTES]
        return rows.withColumns(packed).drop(*codes)

    def pack_in_minute(self, events: DataFrame) -> DataFrame:
        """Events with each attribute as a whole number that orders within their minute."""
        if not self.few:
            return events.withColumns({a: pair(a, F.col("event_time")) for a in ATTRIBUTES})
        micros = (F.extract(F.lit("SECOND"), F.col("event_time")) * F.lit(1_000_000)).cast("bigint")
        rows = self._with_codes(events, {a: F.col(a) for a in ATTRIBUTES})
        return self._without_codes(rows, {a: F.shiftleft(micros, _CODE_BITS) + F.col(f"{a}_code") for a in ATTRIBUTES})

    def lift(self, minutes: DataFrame) -> DataFrame:
        """What ``pack_in_minute`` gave, by minute, as numbers that order over all time."""
        if not self.few:
            return minutes
        minute = F.col("minute").cast("decimal(18,0)") * F.lit(1 << (_MICRO_BITS + _CODE_BITS)).cast("decimal(18,0)")
        return minutes.withColumns({a: (minute + F.col(a)).cast("decimal(38,0)") for a in ATTRIBUTES})

    def pack(self, rows: DataFrame) -> DataFrame:
        """Rows with their pairs as numbers."""
        if not self.few:
            return rows
        coded = self._with_codes(rows, {a: F.col(a)["value"] for a in ATTRIBUTES})
        step = F.lit(1 << _CODE_BITS).cast("decimal(18,0)")
        numbers = {a: (F.col(a)["at"].cast("decimal(20,0)") * step + F.col(f"{a}_code")).cast("decimal(38,0)") for a in ATTRIBUTES}
        return self._without_codes(coded, numbers)

    def unpack(self, rows: DataFrame) -> DataFrame:
        """Rows with their numbers as pairs."""
        if not self.few:
            return rows
        step = F.lit(1 << _CODE_BITS).cast("decimal(18,0)")
        for a in ATTRIBUTES:
            code = F.pmod(F.col(a), step).cast("int")
            rows = rows.join(F.broadcast(self._values[a]), code == F.col("_code"), "left")
            at = ((F.col(a) - code) / step).cast("bigint")
            rows = rows.withColumn(a, F.when(F.col(a).isNotNull(), F.struct(at.alias("at"), F.col("_value").alias("value"))))
            rows = rows.drop("_code", "_value")
        return rows
