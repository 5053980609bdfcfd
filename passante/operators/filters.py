"""Filter set of the map/compare API compiled to Column predicates.

Semantics kept from the reference:
* one value -> equality, many -> IN; case-sensitive location matching;
* hours are parsed from "00".."23", invalid entries dropped;
* demographic predicates use strict ``>`` thresholds, OR inside a dimension,
  AND across dimensions;
* unknown values are ignored, and a dimension whose values are all unknown
  imposes no condition.
"""

from __future__ import annotations

from dataclasses import dataclass, field, replace

from pyspark.sql import Column
from pyspark.sql import functions as F

from passante.functions.columns import all_of, any_of, try_double
from passante.schemas import (
    AGE_THRESHOLD, CLASS_THRESHOLD, DEFAULT_POINT_LIMIT, GENDER_THRESHOLD, MAX_POINT_LIMIT,
)


def _age_expr(label: str) -> Column | None:
    single = {
        "18-19": "x18_19", "20-29": "x20_29", "30-39": "x30_39", "40-49": "x40_49",
        "50-59": "x50_59", "60-69": "x60_69", "70-79": "x70_79", "80+": "x80_plus",
    }
    if label in single:
        return F.col(single[label])
    if label == "50+":
        return F.col("x50_59") + F.col("x60_69") + F.col("x70_79") + F.col("x80_plus")
    return None


def _class_expr(label: str) -> Column | None:
    single = {"a": "a_class", "b1": "b1_class", "b2": "b2_class",
              "c1": "c1_class", "c2": "c2_class", "de": "de_class"}
    if label in single:
        return F.col(single[label])
    if label == "ab":
        return F.col("a_class") + F.col("b1_class") + F.col("b2_class")
    if label == "c":
        return F.col("c1_class") + F.col("c2_class")
    return None


def _gender_expr(label: str) -> Column | None:
    return {"feminino": F.col("feminine"), "masculino": F.col("masculine")}.get(label)


def parse_hours(raw: list[str]) -> list[int]:
    out = []
    for h in raw:
        try:
            v = int(str(h).strip(), 10)
        except ValueError:
            continue
        if 0 <= v <= 23:
            out.append(v)
    return out


def clamp_limit(n: int | None) -> int:
    if n is None or n <= 0:
        return DEFAULT_POINT_LIMIT
    return min(n, MAX_POINT_LIMIT)


def _membership(c: str, values: list[str]) -> Column:
    return F.col(c) == F.lit(values[0]) if len(values) == 1 else F.col(c).isin(values)


@dataclass(frozen=True)
class GeoFilters:
    uf_estado: tuple[str, ...] = ()
    cidade: tuple[str, ...] = ()
    endereco: tuple[str, ...] = ()
    horario: tuple[str, ...] = ()
    genero: tuple[str, ...] = ()
    faixa_etaria: tuple[str, ...] = ()
    classe_social: tuple[str, ...] = ()
    limit: int = 0
    hour_range: tuple[int, int] | None = None  # start..end, wraps past midnight
    extra: tuple = field(default=(), compare=False)

    def with_(self, **kw) -> "GeoFilters":
        kw = {k: tuple(v) if isinstance(v, list) else v for k, v in kw.items()}
        return replace(self, **kw)

    # -- compile -------------------------------------------------------
    def location_conditions(self) -> list[Column]:
        out = []
        for c in ("uf_estado", "cidade", "endereco"):
            vals = list(getattr(self, c))
            if vals:
                out.append(_membership(c, vals))
        return out

    def hour_conditions(self) -> list[Column]:
        out = []
        hours = parse_hours(list(self.horario)) if self.horario else []
        hcol = F.col("impression_hour").try_cast("bigint")
        if len(hours) == 1:
            out.append(hcol == F.lit(hours[0]))
        elif len(hours) > 1:
            out.append(hcol.isin(hours))
        if self.hour_range is not None:
            out.append(hour_range_predicate(hcol, *self.hour_range))
        return out

    def demographic_conditions(self) -> list[Column]:
        out = []
        for values, to_expr, thr in ((self.genero, _gender_expr, GENDER_THRESHOLD),
                                     (self.faixa_etaria, _age_expr, AGE_THRESHOLD),
                                     (self.classe_social, _class_expr, CLASS_THRESHOLD)):
            conds = [e > F.lit(thr) for e in (to_expr(v) for v in values) if e is not None]
            if conds:
                out.append(any_of(conds))
        return out

    def conditions(self) -> list[Column]:
        return self.location_conditions() + self.hour_conditions() + self.demographic_conditions()

    def predicate(self) -> Column | None:
        conds = self.conditions()
        return all_of(conds) if conds else None

    def apply(self, df):
        p = self.predicate()
        return df if p is None else df.where(p)


def hour_range_predicate(hcol: Column, start: int, end: int) -> Column:
    """inclusive hour window; start > end wraps past midnight."""
    if start <= end:
        return hcol.between(start, end)
    return (hcol >= start) | (hcol <= end)


def valid_coordinates(lat: str = "latitude", lon: str = "longitude", ranged: bool = False) -> Column:
    """coordinates that cast to double (and, with ``ranged``, lie on the globe)."""
    la, lo = try_double(lat), try_double(lon)
    cond = la.isNotNull() & lo.isNotNull()
    if ranged:
        cond = cond & la.between(-90, 90) & lo.between(-180, 180)
    return cond


def bounding_box(lat_min: float, lat_max: float, lon_min: float, lon_max: float,
                 lat: str = "latitude", lon: str = "longitude") -> Column:
    """two BETWEENs on double coordinates."""
    return F.col(lat).between(lat_min, lat_max) & F.col(lon).between(lon_min, lon_max)
