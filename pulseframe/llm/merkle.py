"""Merkle manifest of a table: a hash tree for each group of rows, one over the groups, a proof per row.

Every node is one row of a table. A node starts with the siblings of its own run as a segment towards
its parent. Each round joins the nodes with themselves: the segment of the ancestor a node points to
is appended to its own, and it points to that ancestor's ancestor. The distance doubles, so a proof of
``d`` levels is complete after log2(d) rounds.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from pulseframe.session import scratch_path

# Consecutive nodes that share a parent.
FAN_OUT = 3
# Rows that meet one copy of an ancestor in a join; nodes with more of them below get more copies.
BLOCK = 1000

# A node: the tree it is in (that of a group, or TOP over the groups), its height there, its place.
NODE = ("tree", "level", "pos")
TOP = -1


def field(c: Column) -> Column:
    """A value as part of a leaf: ``-`` if null, else its UTF-8 byte count, a colon, and it."""
    text = c.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf(*columns: Column) -> Column:
    """Digest of a row, as 32 bytes."""
    return F.unhex(F.sha2(F.concat(*[field(c) for c in columns]), 256))


def as_hex(digest: Column) -> Column:
    """Lower-case hexadecimal text of bytes."""
    return F.lower(F.hex(digest))


def _joined(digests: Column) -> Column:
    """Digest of a list of digests, which are put together as hexadecimal text."""
    return F.unhex(F.sha2(F.concat_ws("", F.transform(digests, as_hex)), 256))


def fold(start: Column, proof: Column) -> Column:
    """Root that a leaf digest and a proof lead to, as 32 bytes."""
    return F.aggregate(
        proof, start,
        lambda digest, step: F.unhex(
            F.sha2(F.concat(as_hex(step["before"]), as_hex(digest), as_hex(step["after"])), 256)
        ),
    )


def proof_digest(proof: Column) -> Column:
    """Digest of all siblings of a proof, level by level, left to right; as 32 bytes."""
    steps = F.transform(proof, lambda s: F.concat(as_hex(s["before"]), as_hex(s["after"])))
    return F.unhex(F.sha2(F.concat_ws("", steps), 256))


def _table(df: DataFrame, path: str) -> DataFrame:
    """Write the rows and read them again: a lost executor does not undo what is in the shared folder."""
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.parquet(path)


def _delete(spark: SparkSession, path: str) -> None:
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark._jsc.hadoopConfiguration()).delete(where, True)


def numbered(rows: DataFrame, group: str | None, order: list[str], path: str) -> DataFrame:
    """The rows with ``pos``, their place from 0 on within the group, and ``n``, its size.

    Rows are sorted over all tasks by range, so a group is as many tasks as it fills; a row's place is
    the number of rows of its group in earlier tasks, and before it in its own. Rows alike in
    ``order`` are spread too: any order of them is right.
    """
    keys = [group] if group else []
    ranged = rows.withColumn("_spread", F.rand(7)).repartitionByRange(*keys, *order, "_spread")
    ranged = ranged.sortWithinPartitions(*keys, *order, "_spread").drop("_spread")
    # the upper bits are the task, the lower ones the row in it
    written = _table(ranged.withColumn("_at", F.monotonically_increasing_id()), path)
    written = written.withColumn("_task", F.shiftright("_at", 33))
    # one row for each task and group in it
    parts = written.groupBy(*keys, "_task").agg(F.count("*").alias("_rows"), F.min("_at").alias("_first"))
    every = Window.partitionBy(*keys)
    before = every.orderBy("_task").rowsBetween(Window.unboundedPreceding, -1)
    parts = parts.select(
        *[F.col(k).alias("_group") for k in keys],
        F.col("_task").alias("_part"),
        (F.coalesce(F.sum("_rows").over(before), F.lit(0)) - F.col("_first")).alias("_shift"),
        F.sum("_rows").over(every).alias("n"),
    )
    same = F.col("_task") == F.col("_part")
    for k in keys:
        same = same & F.col(k).eqNullSafe(F.col("_group"))
    placed = written.join(parts, same).withColumn("pos", F.col("_at") + F.col("_shift"))
    return placed.drop("_at", "_task", "_part", "_shift", "_group")


def _levels(n: int) -> int:
    """Height of a tree over so many leaves."""
    height = 0
    while n > 1:
        n, height = -(-n // FAN_OUT), height + 1
    return height


def _runs(nodes: DataFrame, most: int, path: str) -> DataFrame:
    """Runs of every level: (tree, level, pos, n, kids, digest) of the parent, and its children's digests.

    ``nodes`` are leaves (tree, pos, n, digest). A parent has at most three children, so no key is
    hot; each level is a third of the one below.
    """
    spark = nodes.sparkSession
    for level in range(1, max(_levels(most), 1) + 1):
        kids = F.array_sort(F.collect_list(F.struct("pos", "digest")))
        parents = (
            nodes.filter("n > 1")
            .groupBy("tree", F.expr(f"pos div {FAN_OUT}").alias("up"), F.expr(f"(n + {FAN_OUT - 1}) div {FAN_OUT}").alias("n"))
            .agg(F.transform(kids, lambda k: k["digest"]).alias("kids"))
        )
        parents = parents.select("tree", F.col("up").alias("pos"), "n", "kids", _joined(F.col("kids")).alias("digest"))
        nodes = _table(parents, f"{path}/level={level}")
    schema = "tree long, pos long, n long, kids array<binary>, digest binary, level int"
    return spark.read.schema(schema).parquet(path)


def _edges(runs: DataFrame) -> DataFrame:
    """Every child of a run: (tree, level, pos), its parent (to_tree, to_level, to_pos), and a segment of one step.

    The last node of a group is a leaf of the tree over all groups. Whoever points to it has it as
    ``subroot``.
    """
    child = runs.withColumn("i", F.explode(F.sequence(F.lit(0), F.size("kids") - 1)))
    side = lambda part: F.coalesce(F.array_join(F.transform(part, F.hex), ""), F.lit(""))
    step = F.struct(
        F.unhex(side(F.slice("kids", 1, F.col("i")))).alias("before"),
        F.unhex(side(F.slice("kids", F.col("i") + 2, FAN_OUT))).alias("after"),
    )
    last = (F.col("n") == 1) & (F.col("tree") != TOP)
    return child.select(
        "tree",
        (F.col("level") - 1).alias("level"),
        (F.col("pos") * FAN_OUT + F.col("i")).alias("pos"),
        F.when(last, F.lit(TOP).cast("long")).otherwise(F.col("tree")).alias("to_tree"),
        F.when(last, F.lit(0)).otherwise(F.col("level")).alias("to_level"),
        F.when(last, F.col("tree")).otherwise(F.col("pos")).alias("to_pos"),
        F.array(step).alias("proof"),
        F.when(last, F.col("digest")).alias("subroot"),
    )


def manifest(docs: DataFrame, digest: str, group: str, order: str, carry: tuple[str, ...] = ()) -> DataFrame:
    """A proof for every row: (group, order, carry columns.., leaf, subroot, root, proof).

    ``digest`` names the column with a row's leaf digest (see :func:`leaf`). Within a group the leaves
    ascend by ``order``; every three consecutive nodes are hashed to one, until one is left, the
    subroot, which is the leaf itself in a group of one row. Subroots, by group, give the root in the same
    way. ``proof`` is a list of steps from the leaf to the root; each has the siblings
    ``before`` and ``after`` the node in its run, as bytes. Digests are bytes.

    Nulls: a null group is a group of its own, the first one; a null in ``order`` comes first. Rows
    alike in ``order`` ascend by their leaf; repeated rows are leaves of their own. An empty
    table gives no rows. Other columns of ``docs`` are left out, whatever their names.
    """
    spark = docs.sparkSession
    path = scratch_path(spark, "merkle")
    names = list(dict.fromkeys([group, order, *carry]))
    row = F.struct(*[F.col(f"`{c}`") for c in names])
    leaves = docs.select(
        row.alias("row"), F.col(f"`{group}`").alias("group"), F.col(f"`{order}`").alias("order"),
        F.col(f"`{digest}`").alias("digest"),
    )
    placed = numbered(leaves, "group", ["order", "digest"], f"{path}/leaves")
    groups = placed.groupBy("group").agg(F.max("n").alias("size"))
    trees = _table(numbered(groups, None, ["group"], f"{path}/groups"), f"{path}/trees")
    largest, count, rows = trees.agg(F.max("size"), F.count("*"), F.sum("size")).first()
    trees = trees.select(F.col("group").alias("_tree_group"), F.col("pos").alias("tree"))
    placed = placed.join(trees, F.col("group").eqNullSafe(F.col("_tree_group"))).drop("_tree_group")
    base = _table(placed.select("tree", "pos", "n", "digest", "row"), f"{path}/base")
    if not count:
        kind = base.select("row.*", F.col("digest").alias("leaf"), F.col("digest").alias("subroot"))
        return kind.withColumns({"root": F.col("leaf"), "proof": F.array(_no_step())})

    runs = _runs(base.select("tree", "pos", "n", "digest"), largest, f"{path}/runs")
    single = base.filter("n = 1")
    tops = runs.filter("n = 1").select("tree", "digest").unionByName(single.select("tree", "digest"))
    tops = _table(
        tops.select(F.lit(TOP).cast("long").alias("tree"), F.col("tree").alias("pos"), F.lit(count).cast("long").alias("n"), "digest"),
        f"{path}/tops",
    )
    top_runs = _runs(tops, count, f"{path}/top-runs")
    height = _levels(count)
    # one digest of 32 bytes
    root = bytes((top_runs.filter(f"level = {height}") if height else tops).first()["digest"])

    alone = single.select(
        "tree", F.lit(0).alias("level"), "pos", F.lit(TOP).cast("long").alias("to_tree"), F.lit(0).alias("to_level"),
        F.col("tree").alias("to_pos"), F.slice(F.array(_no_step()), 1, 0).alias("proof"), F.col("digest").alias("subroot"),
    )
    nodes = _edges(runs).unionByName(_edges(top_runs)).unionByName(alone)
    owners = base.select("tree", F.lit(0).alias("level"), "pos", F.col("digest").alias("leaf"), "row")
    nodes = nodes.join(owners, list(NODE), "left")
    proofs = _jump(nodes, (TOP, height, 0), max(_levels(largest), 1) + height, rows, path)
    found = proofs.filter(f"tree <> {TOP} and level = 0")
    return found.select("row.*", "leaf", "subroot", F.lit(root).alias("root"), "proof")


def _no_step() -> Column:
    return F.struct(F.lit(b"").alias("before"), F.lit(b"").alias("after"))


def _jump(nodes: DataFrame, root: tuple[int, int, int], distance: int, rows: int, path: str) -> DataFrame:
    """Double every node's distance until it points to the root.

    Of the nodes inside a group only those that a leaf still meets on its way are kept. At a distance
    of d a node has at most 3**d nodes below it, so the number of its copies is known: each
    meets about ``BLOCK`` rows, the copy chosen by the place of the row.
    """
    spark = nodes.sparkSession
    to = [f"to_{c}" for c in NODE]
    at_root = F.lit(True)
    for c, v in zip(to, root, strict=True):
        at_root = at_root & (F.col(c) == v)
    step, number = 1, 0
    while step < distance:
        number += 1
        nodes = _table(nodes, f"{path}/nodes-{number}")
        if number > 1:
            _delete(spark, f"{path}/nodes-{number - 1}")
        copies = -(-min(FAN_OUT**step, rows) // BLOCK)
        met = nodes.filter(f"level > 0 or tree = {TOP}").select(
            *[F.col(c).alias(f"_{c}") for c in NODE],
            *[F.col(c).alias(f"_{c}") for c in to],
            F.col("proof").alias("_proof"),
            F.col("subroot").alias("_subroot"),
            F.explode(F.sequence(F.lit(0), F.lit(copies - 1))).alias("_copy"),
        )
        # nodes that the next round still needs
        wanted = nodes.filter(f"tree = {TOP} or level % {2 * step} = 0")
        going = wanted.filter(~at_root).withColumn("copy", (F.col("pos") % copies).cast("int"))
        same = F.col("copy") == F.col("_copy")
        for c in NODE:
            same = same & (F.col(f"to_{c}") == F.col(f"_{c}"))
        gone = going.join(met, same).select(
            *NODE,
            *[F.col(f"_{c}").alias(c) for c in to],
            F.concat("proof", "_proof").alias("proof"),
            F.coalesce("subroot", "_subroot").alias("subroot"),
            "leaf",
            "row",
        )
        nodes = gone.unionByName(wanted.filter(at_root))
        step *= 2
    return nodes
