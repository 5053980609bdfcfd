"""CSV records that may run over several lines, read in parallel splits.

A line break inside a quoted field belongs to the record, so where a split begins says
nothing about whether it begins inside a field.  A first pass scans every split under
both assumptions and keeps where each ends: one small row per split.  These rows, in
order, tell how each split really begins.  A second pass reads the records of every split
and, of those that cross its ends, the pieces, which are put together by an aggregation.
No file is read by one task, and no ``multiLine`` reader is needed.  The driver holds
the splits that begin inside a field, at most as many as the scan's own list of splits.

Fields are read as encoders of real files write them: a field that begins with a quote
ends at a quote before a comma or the end of a line; two quotes in it are one, and any
other quote is itself.  A quote within an unquoted field is itself.  Empty lines between
records are skipped, ``\\r\\n`` is a line break like ``\\n``, and the end of a file ends a
record.  The first record of a file is its header.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from passante.session import scratch_path

ENDS = "_file string, _block bigint, records boolean, width int, after_outside int, after_inside int"
RECORDS = "_file string, _block bigint, _first boolean, fields array<string>"
PIECES = "_file string, _block bigint, _first boolean, head string, tail string"


class Reader:
    """Fields of one record after the other, line by line."""

    def __init__(self, inside: bool = False):
        self.fields, self.field, self.lines = [], [] if inside else None, []

    @property
    def open(self) -> bool:
        """A quoted field goes on in the next line."""
        return self.field is not None

    def feed(self, line: str) -> list[str] | None:
        """The record that ``line`` completes, if it does."""
        at = 0
        self.lines.append(line)
        while True:
            if self.field is None:
                if line.startswith('"', at):
                    self.field, at = [], at + 1
                    continue
                comma = line.find(",", at)
                self.fields.append(line[at:] if comma < 0 else line[at:comma])
                if comma < 0:
                    break
                at = comma + 1
                continue
            quote = line.find('"', at)
            if quote < 0:
                self.field.append(line[at:] + "\n")
                return None
            self.field.append(line[at:quote])
            after = line[quote + 1:quote + 2]
            if after in ("", ","):
                self.fields.append("".join(self.field))
                self.field, at = None, quote + 2
                if not after:
                    break
            else:
                self.field.append('"')
                at = quote + (2 if after == '"' else 1)
        done, self.fields, self.lines = self.fields, [], []
        return done


def parsed(text: str) -> list[str]:
    """Fields of one record's whole text; one that its file's end cuts off ends there."""
    reader, done = Reader(), None
    for line in text.split("\n"):
        done = reader.feed(line)
    if done is None:
        done = [*reader.fields, "".join(reader.field).removesuffix("\n")]
    return done


def lines_of(spark: SparkSession, path: str) -> DataFrame:
    """Lines in order within each split, and the split they belong to."""
    lines = spark.read.option("recursiveFileLookup", True).option("lineSep", "\n").text(path)
    return lines.select(F.make_valid_utf8(F.col("value")).alias("value"), F.col("_metadata.file_path").alias("_file"),
                        F.col("_metadata.file_block_start").alias("_block"))


def _keyed(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[tuple[str, int], str]]:
    """(split, line without its line break); a split's lines come one after the other."""
    for batch in batches:
        values, files, blocks = (batch.column(k).to_pylist() for k in range(3))
        for line, file, block in zip(values, files, blocks, strict=True):
            yield (file, block), line[:-1] if line.endswith("\r") else line


def _batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), schema, strict=True)], schema=schema)


_ENDS = pa.schema([("_file", pa.string()), ("_block", pa.int64()), ("records", pa.bool_()), ("width", pa.int32()),
                   ("after_outside", pa.int32()), ("after_inside", pa.int32())])
_RECORDS = pa.schema([("_file", pa.string()), ("_block", pa.int64()), ("_first", pa.bool_()), ("fields", pa.list_(pa.string()))])
_PIECES = pa.schema([("_file", pa.string()), ("_block", pa.int64()), ("_first", pa.bool_()), ("head", pa.string()), ("tail", pa.string())])
#: Records of a batch that goes back to the JVM, and their characters, about.
ROWS, CHARACTERS = 4096, 1 << 20


def _ends(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A row per split: has it records, the fields of the first (null if it does not end
    here), and whether its end is inside a field, by how it begins."""
    rows = []
    for key, lines in itertools.groupby(_keyed(batches), key=lambda x: x[0]):
        outside, inside = Reader(), Reader(inside=True)
        records, width, agreed = False, None, False
        for _, line in lines:
            if line or outside.open:
                first, records = not records or (width is None and outside.open), True
                done = outside.feed(line)
                width = len(done) if done is not None and first else width
            if not agreed:
                if line or inside.open:
                    inside.feed(line)
                agreed = not inside.open and not outside.open
        rows.append((*key, records, width, int(outside.open), int(outside.open if agreed else inside.open)))
    if rows:
        yield _batch(rows, _ENDS)


def _read(inside: frozenset[tuple[str, int]], pieces: bool):
    """The records that lie within a split, or the pieces of those that do not."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows, held = [], 0
        for key, lines in itertools.groupby(_keyed(batches), key=lambda x: x[0]):
            head = [] if key in inside else None
            reader, first = Reader(inside=head is not None), True
            for _, line in lines:
                if not line and not reader.open:
                    continue
                done = reader.feed(line)
                if head is not None:
                    head.append(line)
                    if done is not None:
                        rows += [(*key, False, "\n".join(head), None)] if pieces else []
                        head, first = None, False
                elif done is not None:
                    rows += [] if pieces else [(*key, first, done)]
                    held, first = held + len(line) + 64, False
                if len(rows) >= ROWS or held > CHARACTERS:
                    yield from [_batch(rows, _PIECES if pieces else _RECORDS)] if rows else []
                    rows, held = [], 0
            if pieces and reader.open:
                rows.append((*key, first, "\n".join(head), None) if head is not None else (*key, first, None, "\n".join(reader.lines)))
        if rows:
            yield _batch(rows, _PIECES if pieces else _RECORDS)

    return run


def _crossing(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        fields = pa.array([parsed(t) for t in batch.column("text").to_pylist()], pa.list_(pa.string()))
        yield pa.RecordBatch.from_arrays([batch.column("_file"), batch.column("_block"), batch.column("_first"), fields], schema=_RECORDS)


def read_records(spark: SparkSession, path: str) -> DataFrame:
    """(_source_file, _width, fields): every record but the headers; ``_width`` is the
    number of fields of its file's header."""
    lines, stored = lines_of(spark, path), scratch_path(spark, "csv-splits")
    lines.mapInArrow(_ends, ENDS).write.parquet(stored)  # a row per split
    # how each split begins: the splits of a file in order, one step each
    step = "named_struct('all', array_append(s.all, named_struct('split', p, 'begin', s.now)), 'now', if(s.now = 1, p.after_inside, p.after_outside))"
    each = "struct<_block: bigint, records: boolean, width: int, after_outside: int, after_inside: int>"
    start = f"named_struct('all', cast(array() as array<struct<split: {each}, begin: int>>), 'now', 0)"
    ends = spark.read.schema(ENDS).parquet(stored)
    known = (ends.groupBy("_file").agg(F.array_sort(F.collect_list(F.struct("_block", "records", "width", "after_outside", "after_inside"))).alias("splits"))
             .select("_file", F.inline(F.expr(f"aggregate(splits, {start}, (s, p) -> {step}, s -> s.all)"))).select("_file", "split.*", "begin"))
    end = F.when(F.col("begin") == 1, F.col("after_inside")).otherwise(F.col("after_outside"))
    inside = frozenset((r["_file"], r["_block"]) for r in known.where("begin = 1").select("_file", "_block").collect())
    within = lines.mapInArrow(_read(inside, False), RECORDS)
    # the header: the first record of the first split in which one begins
    headers = (known.where("records and begin = 0").groupBy("_file").agg(F.min(F.struct("_block", "width")).alias("h"))
               .select("_file", F.col("h._block").alias("_header"), F.col("h.width").alias("_width")))
    if not known.where(end == 1).isEmpty():
        pieces = lines.mapInArrow(_read(inside, True), PIECES)
        # a row or two per split, in order: a head belongs to the last tail before it
        order = Window.partitionBy("_file").orderBy("_block", F.col("tail").isNotNull())
        owned = pieces.withColumn("_owner", F.last(F.when(F.col("tail").isNotNull(), F.col("_block")), ignorenulls=True).over(order))
        whole = owned.groupBy("_file", F.col("_owner").alias("_block")).agg(
            F.bool_or(F.col("tail").isNotNull() & F.col("_first")).alias("_first"),
            F.array_sort(F.collect_list(F.struct(F.col("tail").isNull().alias("later"), F.col("_block").alias("at"), F.coalesce("tail", "head").alias("text")))).alias("parts"))
        crossing = (whole.select("_file", "_block", "_first", F.array_join(F.transform("parts", lambda x: x["text"]), "\n").alias("text"))
                    .mapInArrow(_crossing, RECORDS))
        within = within.unionByName(crossing)
        long = crossing.where("_first").select("_file", F.col("_block").alias("_header"), F.size("fields").alias("long"))
        headers = headers.join(long, ["_file", "_header"], "left").select("_file", "_header", F.coalesce("_width", "long").alias("_width"))
    header = F.col("_first") & (F.col("_block") == F.col("_header"))
    return within.join(headers, "_file").where(~header).select(F.col("_file").alias("_source_file"), "_width", "fields")
