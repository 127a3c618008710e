"""Integer-range and time partitioning as a derived partition column.

The table is partitioned by a derived column (``<field>__range`` or
``<field>__<unit>``); writers add it, readers hide it and turn predicates on
the source column into predicates on it, so the scan prunes folders.
"""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import quote_ident

TIME_UNITS = ("HOUR", "DAY", "MONTH", "YEAR")


class _Unset:
    """Marks an argument that was not given, where ``None`` names the null partition."""

    def __repr__(self):
        return "UNSET"


UNSET = _Unset()


def utc_naive(value):
    """A driver-side time as a naive UTC ``datetime`` (naive times are UTC already)."""
    if isinstance(value, str):
        value = dt.datetime.fromisoformat(value)
    if not isinstance(value, dt.datetime):
        return dt.datetime(value.year, value.month, value.day)
    if value.tzinfo is not None:
        value = value.astimezone(dt.timezone.utc).replace(tzinfo=None)
    return value


def typed_literal(value, dtype: T.DataType) -> Column:
    """Literal of ``dtype`` built from text, so no local time zone enters the value.

    For ``timestamp``, naive values are UTC.
    """
    if value is None:
        return F.lit(None).cast(dtype)
    if isinstance(dtype, T.TimestampType):
        return F.lit(utc_naive(value).isoformat(sep=" ") + "+00:00").cast(dtype)
    if isinstance(dtype, (T.TimestampNTZType, T.DateType)):
        if isinstance(value, dt.datetime):
            text = value.isoformat(sep=" ")
        elif isinstance(value, dt.date):
            text = value.isoformat() + (" 00:00:00" if isinstance(dtype, T.TimestampNTZType) else "")
        else:
            text = str(value)
        return F.lit(text).cast(dtype)
    return F.lit(value).cast(dtype)


@dataclass(frozen=True)
class RangePartitioning:
    """Integer ranges: ``[start, end)`` cut every ``interval``; other keys → null partition."""

    start: int
    end: int
    interval: int

    def __post_init__(self):
        if self.interval <= 0 or self.end <= self.start:
            raise ValueError("range partitioning needs start < end and interval > 0")


@dataclass(frozen=True)
class TimePartitioning:
    """Time buckets by ``unit`` with an optional partition lifetime in milliseconds."""

    unit: str = "DAY"
    expiration_ms: int | None = None

    def __post_init__(self):
        if self.unit.upper() not in TIME_UNITS:
            raise ValueError(f"time unit must be one of {TIME_UNITS}")
        object.__setattr__(self, "unit", self.unit.upper())


@dataclass(frozen=True)
class PartitionSpec:
    """Partition ``column`` of kind ``column_type`` (``int64``, ``timestamp`` or ``date``)."""

    column: str
    column_type: str
    metadata: RangePartitioning | TimePartitioning = field(default_factory=TimePartitioning)

    def __post_init__(self):
        kind = self.column_type.strip().lower()
        object.__setattr__(self, "column_type", kind)
        if kind == "int64":
            if not isinstance(self.metadata, RangePartitioning):
                raise ValueError("int64 partitioning needs RangePartitioning")
        elif kind in ("timestamp", "date"):
            if not isinstance(self.metadata, TimePartitioning):
                raise ValueError(f"{kind} partitioning needs TimePartitioning")
            if kind == "date" and self.metadata.unit == "HOUR":
                raise ValueError("HOUR partitioning needs a timestamp column")
        else:
            raise ValueError(f"partition column type {self.column_type!r} is not supported")

    @property
    def partition_column(self) -> str:
        if isinstance(self.metadata, RangePartitioning):
            return f"{self.column}__range"
        return f"{self.column}__{self.metadata.unit.lower()}"

    @property
    def partition_type(self) -> T.DataType:
        if isinstance(self.metadata, RangePartitioning):
            return T.LongType()
        return T.TimestampNTZType() if self.metadata.unit == "HOUR" else T.DateType()

    # ------------------------------------------------------------ values

    def derive(self, c: Column, source_type: T.DataType | None = None) -> Column:
        """Partition value of a source value, as a column expression.

        ``timestamp_ntz`` and ``date`` sources are truncated with date
        arithmetic, ``timestamp`` sources by whole seconds since the epoch, in
        UTC: the result never depends on a session's or machine's time zone.
        Ranges use integer arithmetic only, exact for every bigint.
        """
        m = self.metadata
        if isinstance(m, RangePartitioning):
            x = c.cast("bigint")
            # a range wider than bigint is cut in decimals
            wide = x.cast("decimal(38,0)") if m.end - m.start >= 2**63 else x
            start = F.lit(m.start).cast("decimal(38,0)" if m.end - m.start >= 2**63 else "bigint")
            bucket = wide - F.pmod(wide - start, F.lit(m.interval).cast("bigint"))
            return F.when((x >= m.start) & (x < m.end), bucket.cast("bigint"))
        if isinstance(source_type, (T.TimestampNTZType, T.DateType)):
            if m.unit == "HOUR":
                return F.make_timestamp_ntz(F.year(c), F.month(c), F.dayofmonth(c), F.hour(c),
                                            F.lit(0), F.lit(0))
            d = c.cast("date")
            return {"DAY": d, "MONTH": F.trunc(d, "MM"), "YEAR": F.trunc(d, "YEAR")}[m.unit]
        seconds = F.unix_seconds(c.cast("timestamp"))
        of_day = F.pmod(seconds, F.lit(86400))
        day = F.date_from_unix_date(((seconds - of_day) / F.lit(86400)).cast("int"))
        if m.unit == "HOUR":
            hour = F.floor(of_day / F.lit(3600)).cast("int")
            return F.make_timestamp_ntz(F.year(day), F.month(day), F.dayofmonth(day), hour, F.lit(0), F.lit(0))
        return {"DAY": day, "MONTH": F.trunc(day, "MM"), "YEAR": F.trunc(day, "YEAR")}[m.unit]

    def with_partition_column(self, df: DataFrame) -> DataFrame:
        src = df.schema[self.column].dataType
        return df.withColumn(self.partition_column, self.derive(df[quote_ident(self.column)], src))

    def values(self, given) -> object:
        """Partition value that holds the source value ``given``; None names the null partition."""
        if given is None:
            return None
        value = self.derive_python(given)
        if value is None:
            raise ValueError(f"{given!r} maps to no partition")
        return value

    def value_literal(self, value) -> Column:
        return typed_literal(value, self.partition_type)

    def derive_python(self, value):
        """Partition value of one driver-side source value (for bounds)."""
        if value is None:
            return None
        m = self.metadata
        if isinstance(m, RangePartitioning):
            if not (m.start <= value < m.end):
                return None
            return m.start + ((value - m.start) // m.interval) * m.interval
        value = utc_naive(value)
        if m.unit == "HOUR":
            return value.replace(minute=0, second=0, microsecond=0)
        if m.unit == "DAY":
            return value.date()
        if m.unit == "MONTH":
            return value.date().replace(day=1)
        return value.date().replace(month=1, day=1)

    def between_predicate(self, lo, hi) -> Column:
        """Predicate on the partition column implied by ``lo <= source <= hi``.

        The bucket function is monotone, so the bucket of the bounds bounds
        the buckets; keys outside an integer range live in the null partition.
        """
        p = F.col(quote_ident(self.partition_column))
        m = self.metadata
        plo, phi = self.derive_python(lo), self.derive_python(hi)
        if isinstance(m, RangePartitioning):
            lo_c = plo if plo is not None else (m.start if lo < m.start else None)
            hi_c = phi if phi is not None else (m.end if hi >= m.end else None)
            conds = p.isNull() if (lo < m.start or hi >= m.end) else F.lit(False)
            if lo_c is not None and hi_c is not None and lo_c <= hi_c:
                conds = conds | p.between(F.lit(lo_c), F.lit(hi_c))
            return conds
        return p.between(self.value_literal(plo), self.value_literal(phi))

    def source_between(self, c: Column, source_type: T.DataType, lo, hi) -> Column:
        """``lo <= source <= hi`` with literals typed like the source column."""
        return c.between(typed_literal(lo, source_type), typed_literal(hi, source_type))

    # ----------------------------------------------------------- lifetime

    def partition_start(self, value) -> dt.datetime | None:
        if value is None or isinstance(self.metadata, RangePartitioning):
            return None
        if isinstance(value, str):
            value = dt.datetime.fromisoformat(value)
        if isinstance(value, dt.datetime):
            return value
        return dt.datetime(value.year, value.month, value.day)

    def expired(self, value, as_of: dt.datetime) -> bool:
        """Partition past its lifetime at ``as_of`` (lifetime counts from its start)."""
        m = self.metadata
        if not isinstance(m, TimePartitioning) or m.expiration_ms is None:
            return False
        start = self.partition_start(value)
        if start is None:
            return False
        return start + dt.timedelta(milliseconds=m.expiration_ms) <= as_of

    # ------------------------------------------------------ table property

    def to_properties(self) -> dict[str, str]:
        m = self.metadata
        props = {"tessera.partition.column": self.column,
                 "tessera.partition.type": self.column_type,
                 "tessera.partition.derived": self.partition_column}
        if isinstance(m, RangePartitioning):
            props.update({"tessera.partition.range": f"{m.start},{m.end},{m.interval}"})
        else:
            props["tessera.partition.unit"] = m.unit
            if m.expiration_ms is not None:
                props["tessera.partition.expiration_ms"] = str(m.expiration_ms)
        return props

    @staticmethod
    def from_properties(props: dict[str, str]) -> "PartitionSpec | None":
        col = props.get("tessera.partition.column")
        if not col:
            return None
        kind = props["tessera.partition.type"]
        if kind == "int64":
            s, e, i = (int(v) for v in props["tessera.partition.range"].split(","))
            return PartitionSpec(col, kind, RangePartitioning(s, e, i))
        exp = props.get("tessera.partition.expiration_ms")
        return PartitionSpec(col, kind, TimePartitioning(props["tessera.partition.unit"],
                                                         int(exp) if exp else None))
