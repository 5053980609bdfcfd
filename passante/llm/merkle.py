"""Merkle manifest of a dataset by sibling-shift self-joins.

Every row is a leaf: the SHA-256 of its columns, each written as its length and
value.  The leaves of a group (a source) are put in order and hashed up to the
group's subroot; the subroots, in order, are the leaves of one more tree and give
the root.  A level is built by equi-joins of its nodes with themselves: a node in slot
s of its run is looked for under the index of the run's first node (its own index
XOR 1 in a binary tree, its index less s otherwise), and the rows in slot zero, now
with all their siblings, emit the parents.  Rows are shuffled once per level, each
level is ``arity`` times smaller than the last, and a join key names one run, so a
group with any share of all rows is spread over all tasks.

Leaves are numbered without a window per group: rows are partitioned by ranges of
(group, order) and sorted, every task counts on within its rows, and the counts of
the tasks before, a row per task and group, are added.

The siblings on a leaf's way to the root are its proof.  They go from the
top down: each run of a level gets the proof of its parent's run by an equi-join.
``folded`` hashes any leaf up along a proof; the result is the root if the row
is what the manifest was made of.

Defined cases: a null value is written ``-``; a null group is a group of its own, the
first; null ids come first in their group.  Rows of equal order are ordered by their
leaves; repeated rows are leaves of their own, side by side.  A lone leaf is its
group's subroot, a lone subroot the root.  An empty table has no leaves, and its
root is None.  Extra columns are only hashed if named.
"""

from __future__ import annotations

import functools
import operator
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, LongType, StructField, StructType

from passante.llm.common import written

#: Nodes of a run.
ARITY = 3
COLUMNS = ("doc_id", "source", "lang", "n_chars", "text")


def leaf_hash(columns: list[Column]) -> Column:
    """SHA-256, in hex, of the columns: UTF-8 bytes, a colon and the value, or ``-``."""
    texts = [c.cast("string") for c in columns]
    return F.sha2(F.concat(*[F.coalesce(F.concat(F.octet_length(t).cast("string"), F.lit(":"), t), F.lit("-")) for t in texts]), 256)


def numbered(rows: DataFrame, order: list[str]) -> DataFrame:
    """``rows`` (with a column ``tree`` that is not null) with ``idx``, the number of
    a row within its tree in the given order, and ``n``, the tree's rows."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, last, seen = TaskContext.get().partitionId(), None, 0
        for batch in batches:
            local = []
            for tree, n in _runs(batch.column("tree")):
                seen = seen if tree == last else 0
                local += range(seen, seen + n)
                last, seen = tree, seen + n
            yield (batch.append_column("part", pa.array([part] * batch.num_rows, pa.int32()))
                   .append_column("local", pa.array(local, pa.int64())))

    added = [StructField("part", IntegerType()), StructField("local", LongType())]
    keys = ["tree", *order]
    ranged = rows.repartitionByRange(*keys).sortWithinPartitions(*keys)
    ranged = written(ranged.mapInArrow(count, StructType([*rows.schema.fields, *added])), "merkle-order")
    tree = Window.partitionBy("tree")
    before = F.sum("rows").over(tree.orderBy("part")) - F.col("rows")
    places = (ranged.groupBy("part", "tree").agg(F.count("*").alias("rows"))
              .select("part", "tree", before.alias("before"), F.sum("rows").over(tree).alias("n")))
    return (ranged.join(places, ["part", "tree"]).withColumn("idx", F.col("before") + F.col("local"))
            .drop("part", "local", "before"))


def _runs(trees: pa.Array) -> Iterator[tuple[str, int]]:
    """(value, length) of the runs of equal values."""
    coded = trees.dictionary_encode()
    codes, names = coded.indices.to_pylist(), coded.dictionary.to_pylist()
    start = 0
    for i in range(1, len(codes) + 1):
        if i == len(codes) or codes[i] != codes[start]:
            yield names[codes[start]], i - start
            start = i


class Forest:
    """Trees over numbered leaves (tree, idx, n, hash); ``runs[k]`` has a row per
    run of level k: tree, run, n (nodes of the level), h0, h1, ... (null beyond the last)."""

    def __init__(self, leaves: DataFrame, arity: int = ARITY):
        if arity < 2:
            raise ValueError("a run has two nodes at least")
        self.leaves, self.arity, self.runs = leaves, arity, []
        self.slots = [f"h{s}" for s in range(arity)]
        nodes = leaves.select("tree", "idx", "n", "hash")
        size = nodes.agg(F.max("n")).first()[0] or 0
        while size > 1:
            self.runs.append(written(self._joined(nodes.where("n > 1")), "merkle-level"))
            nodes = self._parents(self.runs[-1])
            size = -(-size // arity)

    def _joined(self, nodes: DataFrame) -> DataFrame:
        idx, slot = F.col("idx"), F.pmod(F.col("idx"), F.lit(self.arity))
        out = nodes.where(slot == 0).select("tree", idx.alias("first"), "n", F.col("hash").alias("h0"))
        for s in range(1, self.arity):
            sibling = idx.bitwiseXOR(F.lit(1)) if self.arity == 2 else idx - s
            shifted = nodes.where(slot == s).select("tree", sibling.alias("first"), F.col("hash").alias(f"h{s}"))
            out = out.join(shifted, ["tree", "first"], "left")
        return out.select("tree", self._above("first").alias("run"), "n", *self.slots)

    def _above(self, name: str) -> Column:
        return F.expr(f"{name} div {self.arity}")

    def _parents(self, runs: DataFrame) -> DataFrame:
        return runs.select("tree", F.col("run").alias("idx"), F.expr(f"(n + {self.arity - 1}) div {self.arity}").alias("n"),
                           F.sha2(F.concat_ws("", *self.slots), 256).alias("hash"))

    def tops(self) -> DataFrame:
        """(tree, hash): the last node of every tree."""
        levels = [self.leaves.select("tree", "idx", "n", "hash"), *map(self._parents, self.runs)]
        return functools.reduce(DataFrame.unionByName, [x.where("n = 1").select("tree", "hash") for x in levels])

    def proofs(self, above: DataFrame) -> DataFrame:
        """The leaves with ``proof``, an array of (left, right) from the leaf's level
        upwards, and the columns of ``above``, which has a row per tree: tree, proof (from the top
        on) and further columns."""
        further = [c for c in above.columns if c not in ("tree", "proof")]
        found = None
        for level, runs in reversed(list(enumerate(self.runs))):
            highest = runs.where(F.col("n") <= self.arity).join(above, "tree")
            if found is not None:
                lower = runs.where(F.col("n") > self.arity)
                highest = highest.unionByName(self._proved(lower, "run", found, further).select(*highest.columns))
            # the plan of many levels at once would weigh on the driver
            found = written(highest, "merkle-proofs") if level % 4 == 3 else highest
        lone = self.leaves.where("n = 1").join(above, "tree")
        if found is None:
            return lone
        return lone.unionByName(self._proved(self.leaves.where("n > 1"), "idx", found, further).select(*lone.columns))

    def _proved(self, nodes: DataFrame, place: str, runs: DataFrame, further: list[str]) -> DataFrame:
        """``nodes`` with the proof of the run each belongs to, longer by its siblings."""
        mine = runs.select("tree", F.col("run").alias("up"), F.struct(*self.slots).alias("level"), F.col("proof").alias("rest"), *further)
        joined = nodes.withColumn("up", self._above(place)).join(mine, ["tree", "up"])
        ours = joined.select(*nodes.columns, *further, "rest", *[F.col(f"level.{h}").alias(f"level_{h}") for h in self.slots])
        slot = F.pmod(F.col(place), F.lit(self.arity))
        left, right = (F.concat_ws("", *[F.when(keep(F.lit(s), slot), F.col(f"level_{h}")) for s, h in enumerate(self.slots)])
                       for keep in (operator.lt, operator.gt))
        step = F.array(F.struct(left.alias("left"), right.alias("right")))
        return ours.select(*nodes.columns, *further, F.concat(step, F.col("rest")).alias("proof"))


def folded(leaf: Column, proof: Column) -> Column:
    """The root that ``leaf`` has with the siblings of ``proof``."""
    return F.aggregate(proof, leaf, lambda h, step: F.sha2(F.concat(step["left"], h, step["right"]), 256))


def proof_text(proof: Column) -> Column:
    """All siblings, level by level, left to right."""
    return F.array_join(F.transform(proof, lambda step: F.concat(step["left"], step["right"])), "")


class Manifest:
    """The trees of a dataset.  ``carried`` columns of the rows stay with their leaves."""

    def __init__(self, docs: DataFrame, columns: tuple[str, ...] = COLUMNS, group: str = "source", order: str = "doc_id",
                 carried: dict[str, Column] | None = None, arity: int = ARITY):
        # a mark before the name keeps the order of the names, and a null apart from every name
        tree = F.coalesce(F.concat(F.lit("="), F.col(group).cast("string")), F.lit(""))
        leaves = docs.select(F.col(order).alias("place"), tree.alias("tree"), leaf_hash([F.col(c) for c in columns]).alias("hash"),
                             F.monotonically_increasing_id().alias("number"), *[c.alias(name) for name, c in (carried or {}).items()])
        self.carried = list(carried or {})
        self.groups = Forest(numbered(written(leaves, "merkle-leaves"), ["place", "hash", "number"]), arity)
        subroots = self.groups.tops().select(F.lit("").alias("tree"), F.col("tree").alias("name"), "hash")
        self.all = Forest(numbered(written(subroots, "merkle-subroots"), ["name"]), arity)
        found = self.all.tops().first()
        self.root: str | None = found.hash if found else None

    def proofs(self) -> DataFrame:
        """(place, leaf, subroot, proof) and the carried columns, per row; ``place`` is the order's value."""
        spark = self.all.leaves.sparkSession
        top = spark.createDataFrame([("", [])], "tree string, proof array<struct<left: string, right: string>>")
        subroots = written(self.all.proofs(top).select(F.col("name").alias("tree"), "proof", F.col("hash").alias("subroot")), "merkle-roots")
        return self.groups.proofs(subroots).select("place", F.col("hash").alias("leaf"), "subroot", "proof", *self.carried)
