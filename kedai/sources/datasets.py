"""The three periodic datasets and the lookup seed."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import types as T

DATE_COLUMN = "ymd_date"
MONTHLY = ("year", "month")
DAILY = ("year", "month", "day")


@dataclass(frozen=True, eq=False)
class Dataset:
    """How one dataset arrives and how it is laid out in the raw zone."""

    name: str
    schema: T.StructType  # raw zone, without the period columns
    renames: dict[str, str]  # landing name -> raw name
    series: str = "series"  # the column staging filters on
    periods: tuple[str, ...] = MONTHLY
    lenient_dates: bool = False
    nanos_dates: bool = False  # dates may come as nanoseconds since the epoch
    accepted: dict[str, tuple[str, ...]] = field(default_factory=dict)

    @property
    def raw_schema(self) -> T.StructType:
        """Raw zone schema with the zero-padded period columns."""
        fields = list(self.schema.fields)
        return T.StructType(fields + [T.StructField(p, T.StringType()) for p in self.periods])


def _schema(**columns: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, kind) for name, kind in columns.items()])


_TEXT, _TIME, _NUMBER = T.StringType(), T.TimestampType(), T.DoubleType()
_TRADE_SERIES = {"series": ("abs", "growth_yoy", "growth_mom")}

IOWRT = Dataset(
    name="iowrt",
    schema=_schema(
        series=_TEXT, ymd_date=_TIME, sales=_NUMBER, volume=_NUMBER, volume_sa=_NUMBER
    ),
    renames={"date": DATE_COLUMN},
    accepted=_TRADE_SERIES,
)

IOWRT_3D = Dataset(
    name="iowrt_3d",
    schema=_schema(
        series=_TEXT, ymd_date=_TIME, group_code=_TEXT, sales=_NUMBER, volume=_NUMBER
    ),
    renames={"date": DATE_COLUMN, "group": "group_code"},
    accepted=_TRADE_SERIES,
)

FUELPRICE = Dataset(
    name="fuelprice",
    schema=_schema(
        series_type=_TEXT,
        ymd_date=_TIME,
        ron95=_NUMBER,
        ron97=_NUMBER,
        diesel=_NUMBER,
        diesel_eastmsia=_NUMBER,
    ),
    renames={"date": DATE_COLUMN},
    series="series_type",
    periods=DAILY,
    lenient_dates=True,
    nanos_dates=True,
    accepted={"series_type": ("level", "change_weekly")},
)

DATASETS = {d.name: d for d in (IOWRT, IOWRT_3D, FUELPRICE)}

SEED_COLUMNS = ("group_code", "desc_en", "desc_bm")
