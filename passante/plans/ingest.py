"""Ingest: flow CSV scans (S1, S2), profile parsing (N4), completeness check
(F14), shredding into the five warehouse tables (N1) with deterministic keys
(N2, N3), and the bulk five-table write (K2).

The whole path is column expressions over a DataFrame: the profile text is
parsed once with ``from_json`` into ``map<string, map<string, double>>`` and
the five tables are five ``select``s of that one parsed frame.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from passante.functions.columns import deterministic_id, normalize_quotes, try_double, uuid5
from passante.plans.model import with_counts
from passante.session import drop_path, shuffles_dropped
from passante.sources.csv_records import read_records
from passante.schemas import (
    AGE_COLUMNS, AGE_KEYS, CLASS_COLUMNS, CLASS_KEYS, CSV_COLUMNS, CSV_SCHEMA, GENDER_COLUMNS,
    GENDER_KEYS, PROFILE_TYPE, TABLES,
)

DIM_KEYS = {"idade": (AGE_KEYS, AGE_COLUMNS), "genero": (GENDER_KEYS, GENDER_COLUMNS),
            "classe_social": (CLASS_KEYS, CLASS_COLUMNS)}


# ------------------------------------------------------------------ S1 / S2


def read_flow_csv(spark: SparkSession, path: str, mode: str = "lenient") -> DataFrame:
    """Flow CSV: files with a header each, records of ten positional text columns that
    may run over several lines; columns after the tenth are ignored.

    * ``lenient`` (S1, the producer): a record whose number of fields is not that of
      its file's header, or below ten, is skipped (see :func:`rejected_records`); numeric
      parse failures become 0 / 0 / 0.0 and ``numero`` NULL; the profile is parsed
      with a blanket quote swap and kept NULL when it does not parse.
    * ``bulk`` (S2, the bulk loader): such a record fails the load; rows whose profile
      does not parse are dropped by :func:`shred`.

    All fields are read whatever the query selects, so the same records are
    accepted in every use.  Adds ``_source_file`` and ``_row_digest`` for N3.
    """
    return typed_flow(_flow_texts(spark, path, mode), blanket_quotes=True)


def _flow_texts(spark: SparkSession, path: str, mode: str) -> DataFrame:
    """The ten texts of every accepted record, its file and its digest."""
    df = read_records(spark, path)
    if mode == "bulk":
        shape = F.concat_ws(" ", F.lit("malformed record:"), F.size("fields").cast("string"), F.lit("fields in"), "_source_file")
        df = df.select("_source_file", F.when(_whole(), F.col("fields")).otherwise(F.raise_error(shape).cast("array<string>")).alias("fields"))
    else:
        df = df.where(_whole())
    named = [F.col("fields")[k].alias(f.name) for k, f in enumerate(CSV_SCHEMA.fields)]
    digest = F.sha2(F.array_join("fields", "\x01"), 256)
    return df.select(*named, "_source_file", digest.alias("_row_digest"))


def _whole() -> Column:
    return (F.size("fields") == F.col("_width")) & (F.size("fields") >= len(CSV_SCHEMA.fields))


def rejected_records(spark: SparkSession, path: str) -> DataFrame:
    """The records that a lenient scan skips: (_source_file, fields)."""
    return read_records(spark, path).where(~_whole()).select("_source_file", "fields")


def typed_flow(df: DataFrame, blanket_quotes: bool = True) -> DataFrame:
    """Numeric defaults of the loaders and the parsed profile map."""
    text = F.col("target")
    fixed = F.regexp_replace(text, "'", '"') if blanket_quotes else normalize_quotes(text)
    return df.withColumns({
        "impression_hour": F.coalesce(F.col("impression_hour").try_cast("bigint"), F.lit(0).cast("bigint")),
        "location_id": F.coalesce(F.col("location_id").try_cast("bigint"), F.lit(0).cast("bigint")),
        "uniques": F.coalesce(F.col("uniques").try_cast("double"), F.lit(0.0)),
        "numero": F.col("numero").try_cast("bigint"),
        "target": F.from_json(fixed, PROFILE_TYPE),
    })


def require_rows(df: DataFrame, what: str = "CSV") -> DataFrame:
    """S1's 'error when zero rows remain' (a cheap ``limit 1`` probe)."""
    if df.isEmpty():
        raise ValueError(f"{what} is empty")
    return df


# ------------------------------------------------------------------ F14


def _has_key(m: Column):
    return lambda k: F.map_contains_key(m, k)


def profile_complete(target: Column) -> Column:
    """All 8 + 2 + 6 bucket keys present (extra keys allowed, zeros valid);
    a NULL or empty profile is invalid."""
    conds = []
    for dim, (keys, _) in DIM_KEYS.items():
        m = target.getItem(dim)
        conds.append(m.isNotNull() & F.forall(F.array(*[F.lit(k) for k in keys]), _has_key(m)))
    out = target.isNotNull()
    for c in conds:
        out = out & c
    return F.coalesce(out, F.lit(False))


def missing_key_reason(target: Column) -> Column:
    """First missing key, in the order the check visits them, as text."""
    expr = F.when(target.isNull(), F.lit("profile missing or unparsable"))
    for dim, (keys, _) in DIM_KEYS.items():
        m = target.getItem(dim)
        expr = expr.when(m.isNull(), F.lit(f"missing {dim}"))
        for k in keys:
            expr = expr.when(~F.map_contains_key(m, F.lit(k)), F.lit(f"missing {dim} key {k}"))
    return expr


# ------------------------------------------------------------------ N1 / N2 / N3


TEXT_COLUMNS = ["latitude", "longitude", "uf_estado", "cidade", "endereco"]


@dataclass
class Shredded:
    geodata: DataFrame
    target: DataFrame
    age: DataFrame
    gender: DataFrame
    social_class: DataFrame
    quarantine: DataFrame
    #: J3 rows: the parsed event holds its own profile, so they need no join (J1 is for back-fills)
    wide: DataFrame

    def tables(self) -> dict[str, DataFrame]:
        return {"age": self.age, "gender": self.gender, "social_class": self.social_class,
                "target": self.target, "geodata": self.geodata}


def stream_keys(topic: str = "topic", partition: str = "partition", offset: str = "offset"):
    """Per-table key = uuid5("topic:partition:offset:table")."""
    return lambda table: deterministic_id(F.col(topic), F.col(partition), F.col(offset), table)


def numbered(rows: DataFrame) -> DataFrame:
    """Adds ``_row_key``: digest of the row's text and a number among the equal rows
    of its file, so it does not depend on how the file is split or listed."""
    w = Window.partitionBy("_source_file", "_row_digest").orderBy("_row_digest")
    return rows.withColumn("_row_key", F.concat_ws(":", "_row_digest", F.row_number().over(w).cast("string")))


def bulk_keys(row_key: str = "_row_key", source: str = "_source_file"):
    """N3 made deterministic: uuid5 of (file name, row content, table); the same
    file gives the same ids on any cluster."""
    name = F.regexp_extract(F.col(source), r"[^/]+/?\z", 0)
    return lambda table: uuid5(F.concat_ws(":", name, F.col(row_key), F.lit(table)))


def with_keys(events: DataFrame, key_of) -> DataFrame:
    """Add the five per-table keys as ``__{table}_id`` (kept if already there,
    e.g. computed once in a cached micro-batch)."""
    missing = {f"__{t}_id": key_of(t) for t in TABLES if f"__{t}_id" not in events.columns}
    return events.withColumns(missing) if missing else events


def with_profile(events: DataFrame, strict: bool = True) -> DataFrame:
    """Add ``__complete`` (the profile is good enough to store), ``__reason`` (what it
    lacks) and the 16 buckets ``__{share}`` (kept if already there: a table that is stored or
    persisted with them reads a few columns of numbers, not the profile map)."""
    if "__complete" in events.columns:
        return events
    ok = profile_complete(F.col("target")) if strict else F.col("target").isNotNull()
    # an absent bucket (lenient) or one with a null value is 0.0
    shares = {f"__{c}": F.coalesce(F.col("target").getItem(dim).getItem(key), F.lit(0.0))
              for dim, (keys, cols) in DIM_KEYS.items() for key, c in zip(keys, cols)}
    return events.withColumns({"__complete": ok, "__reason": F.when(~ok, missing_key_reason(F.col("target"))), **shares})


def shred(events: DataFrame, key_of, strict: bool = True) -> Shredded:
    """One event -> age, gender, social_class, target and geodata rows.

    ``strict`` (the stream writer): an incomplete profile is rejected to the
    quarantine frame.  Lenient (the bulk loader): only a missing/unparsable
    profile is rejected; absent buckets become 0.0.
    """
    base = with_profile(with_keys(events, key_of), strict)
    good = base.where("__complete")
    added = [f"__{t}_id" for t in TABLES] + ["__complete", "__reason"] + [f"__{c}" for _, cols in DIM_KEYS.values() for c in cols]
    bad = base.where("not __complete").withColumn("reason", F.col("__reason")).drop(*added)

    def zero(name):
        return F.coalesce(F.col(name), F.lit("" if name in TEXT_COLUMNS else 0)).alias(name)

    def dim_table(dim, table):
        return good.select(F.col(f"__{table}_id").alias("id"), *[F.col(f"__{c}").alias(c) for c in DIM_KEYS[dim][1]])

    target = good.select(F.col("__target_id").alias("id"), F.col("__age_id").alias("age_id"),
                         F.col("__gender_id").alias("gender_id"),
                         F.col("__social_class_id").alias("social_class_id"))
    # an absent or null field has its type's zero value
    geodata = good.select(
        F.col("__geodata_id").alias("id"), zero("impression_hour"), zero("location_id"), zero("uniques"),
        *[zero(c) for c in TEXT_COLUMNS], zero("numero"), F.col("__target_id").alias("target_id"))
    shares = [F.col(f"__{c}").alias(c) for _, cols in DIM_KEYS.values() for c in cols]
    facts = [zero(c) for c in ("impression_hour", "location_id", "uniques", *TEXT_COLUMNS, "numero")]
    view = good.select(F.col("__geodata_id").alias("id"), *facts, F.col("__target_id").alias("target_id"), *shares)
    view = with_counts(view.withColumns({"latitude": try_double("latitude"), "longitude": try_double("longitude")}))
    return Shredded(geodata, target, dim_table("idade", "age"), dim_table("genero", "gender"),
                    dim_table("classe_social", "social_class"), bad, view)


# ------------------------------------------------------------------ K2

#: Parquet codec of the tables: half of their bytes are keys in hexadecimal, which snappy stores as they are.
STORED = "zstd"


def load_csv(spark: SparkSession, path: str, warehouse: str, mode: str = "bulk", drop_source: bool = False) -> None:
    """K2: CSV -> five tables.  The parsed and keyed rows are written once, and
    every table is a projection of what was written, so an event keeps its own
    profile whatever is evaluated again.  The texts are numbered before they are parsed,
    since they are shuffled for it, and the staged rows are deleted in the end.
    ``drop_source`` deletes the files as soon as their rows are staged."""
    w = warehouse.rstrip("/")
    with shuffles_dropped(spark):
        texts = numbered(_flow_texts(spark, path, mode))
        rows = with_profile(with_keys(typed_flow(texts, blanket_quotes=True), bulk_keys()), strict=False)
        rows.drop("target", "_row_digest", "_row_key").write.mode("overwrite").option("compression", STORED).parquet(f"{w}/_staged")
    if drop_source:
        drop_path(spark, path)
    write_tables(shred(spark.read.parquet(f"{w}/_staged"), bulk_keys(), strict=False), w)
    drop_path(spark, f"{w}/_staged")


def write_tables(sh: Shredded, warehouse: str, mode: str = "append", partition_col: str | None = None) -> None:
    """The five tables in foreign-key order (dimensions first, geodata last), and
    the wide view before geodata."""
    for name, table in [*list(sh.tables().items())[:-1], ("enriched", sh.wide), ("geodata", sh.geodata)]:
        w = table.write.mode(mode).option("compression", STORED)
        if partition_col:
            w = w.partitionBy(partition_col)
        w.parquet(f"{warehouse.rstrip('/')}/{name}")


# ------------------------------------------------------------------ profile text


def profile_text(df: DataFrame, quote: str = "'") -> Column:
    """Serialise the 16 share columns back to the python-dict text carried by
    the flow CSV (``{'idade': {'18-19': 0.1, ...}, ...}``)."""
    q = quote

    def block(dim, keys, cols):
        items = [F.concat(F.lit(f"{q}{k}{q}: "), F.col(c).cast("string")) for k, c in zip(keys, cols)]
        return F.concat(F.lit(f"{q}{dim}{q}: {{"), F.concat_ws(", ", *items), F.lit("}"))

    return F.concat(F.lit("{"), F.concat_ws(", ", *[block(d, *DIM_KEYS[d]) for d in DIM_KEYS]), F.lit("}"))


def to_flow_rows(joined: DataFrame) -> DataFrame:
    """J1 rows -> the ten text columns of the flow CSV."""
    return joined.select(*[F.col(c).cast("string").alias(c) for c in CSV_COLUMNS[:-1]],
                         profile_text(joined).alias("target"))
