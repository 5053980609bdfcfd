"""Column expressions shared by the operators.

All of these are built-in Catalyst expressions, so they stay inside
whole-stage codegen; none of them calls back into Python.
"""

from __future__ import annotations

import math
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from passante.schemas import EARTH_RADIUS_M, UUID_NAMESPACE_HEX


def scalar_struct(df) -> Column:
    """A one-row DataFrame (a global aggregate) as a scalar-subquery struct
    Column: it is evaluated once and attached to every row without a join."""
    return df.select(F.struct(*[F.col(f"`{c}`") for c in df.columns]).alias("v")).scalar()


def col_(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def try_double(c: str | Column) -> Column:
    """SAFE_CAST(x AS FLOAT64): NULL for malformed text such as '-2.358.334'."""
    return col_(c).try_cast("double")


def haversine_m(lat1, lon1, lat2, lon2) -> Column:
    """Great-circle distance in metres, ``2R asin(min(1, sqrt(h)))``."""
    lat1, lon1, lat2, lon2 = (col_(x) if not isinstance(x, (int, float)) else F.lit(float(x))
                              for x in (lat1, lon1, lat2, lon2))
    dlat = F.radians(lat2 - lat1)
    dlon = F.radians(lon2 - lon1)
    h = (F.pow(F.sin(dlat / 2), 2)
         + F.cos(F.radians(lat1)) * F.cos(F.radians(lat2)) * F.pow(F.sin(dlon / 2), 2))
    return F.lit(2 * EARTH_RADIUS_M) * F.asin(F.least(F.lit(1.0), F.sqrt(h)))


def bbox_predicate(lat: str | Column, lon: str | Column, center_lat: float, center_lon: float,
                   radius_m: float) -> Column:
    """A conservative lat/lon box around a circle; reaches the Parquet reader
    as a range filter when the coordinates are stored as doubles."""
    dlat = math.degrees(radius_m / EARTH_RADIUS_M)
    coslat = math.cos(math.radians(min(89.9, abs(center_lat) + dlat)))
    dlon = 180.0 if coslat <= 1e-9 else min(180.0, math.degrees(radius_m / (EARTH_RADIUS_M * coslat)))
    box = col_(lat).between(center_lat - dlat, center_lat + dlat)
    if dlon < 180.0:
        box = box & col_(lon).between(center_lon - dlon, center_lon + dlon)
    return box


def any_of(conds: list[Column]) -> Column:
    return reduce(lambda a, b: a | b, conds)


def all_of(conds: list[Column]) -> Column:
    return reduce(lambda a, b: a & b, conds)


def dominant_label(cols: list[str], labels: list[str], prefix: str = "") -> Column:
    """First bucket whose share is >= every other share (ties: first wins);
    the last label is the ELSE branch, exactly like the CASE chain."""
    expr = None
    for i, (c, lab) in enumerate(zip(cols[:-1], labels[:-1])):
        others = [F.col(prefix + o) for j, o in enumerate(cols) if j != i]
        cond = F.col(prefix + c) >= F.greatest(*others)
        expr = F.when(cond, F.lit(lab)) if expr is None else expr.when(cond, F.lit(lab))
    return expr.otherwise(F.lit(labels[-1]))


def gender_label(feminine: str = "feminine") -> Column:
    from passante.schemas import GENDER_THRESHOLD
    return F.when(F.col(feminine) > GENDER_THRESHOLD, F.lit("feminino")).otherwise(F.lit("masculino"))


def uuid5(seed: Column) -> Column:
    """RFC 4122 version-5 UUID of ``seed`` in the DNS namespace, as text.

    sha1(namespace bytes || seed bytes), first 16 bytes, version nibble 5 and
    variant bits 10.  Pure SQL, deterministic under task retries.
    """
    h = F.sha1(F.concat(F.unhex(F.lit(UUID_NAMESPACE_HEX)), seed.cast("binary")))  # lower-case hex
    # byte 6 high nibble -> 5; byte 8 top two bits -> 10: (x & 3) | 8 on that hex digit
    variant = F.translate(F.substring(h, 17, 1), "0123456789abcdef", "89ab89ab89ab89ab")
    return F.concat(
        F.substring(h, 1, 8), F.lit("-"),
        F.substring(h, 9, 4), F.lit("-"),
        F.lit("5"), F.substring(h, 14, 3), F.lit("-"),
        variant, F.substring(h, 18, 3), F.lit("-"),
        F.substring(h, 21, 12),
    )


def deterministic_id(topic: Column, partition: Column, offset: Column, table: str) -> Column:
    """Key of one warehouse row: uuid5("topic:partition:offset:table")."""
    seed = F.concat_ws(":", topic.cast("string"), partition.cast("string"),
                       offset.cast("string"), F.lit(table))
    return uuid5(seed)


def normalize_quotes(c: Column) -> Column:
    """'x' -> "x" for every paired single-quoted run (python-dict text -> JSON)."""
    return F.regexp_replace(c, "'([^']*)'", '"$1"')


def address_label(endereco: str = "endereco", numero: str = "numero", cidade: str = "cidade") -> Column:
    """trim(endereco) + ', ' + numero + ' — ' + cidade (NULL if any part is NULL)."""
    return F.concat(F.trim(F.col(endereco)), F.lit(", "), F.col(numero).cast("string"),
                    F.lit(" — "), F.col(cidade))


def rfc3339(ts: Column) -> Column:
    return F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss'Z'")


def basename(path: Column) -> Column:
    return F.element_at(F.split(path, "/"), -1)
