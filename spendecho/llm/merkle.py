"""A Merkle manifest of a table, with a proof for every row by pointer jumping.

Rows are leaves, in order within their group (here: `source`). Every `FAN`
consecutive nodes become their digest until a group has one node, its subroot;
subroots in group order become the root in the same way.

    tree = build(rows, group, order)       digests level by level, written as tables
    tree.proofs()                          rows with `proof`, `subroot`, `root`
    fold(leaf, proof)                      the root that a leaf and its siblings give

The leaves of one run of siblings share all of their way up, so the way belongs to
the run. Each inner node starts with the step to its parent (digests before and
after it). A round joins the nodes with themselves: the way to an ancestor and the
ancestor's own way are put together, which doubles the distance, until all ways end
at the root: the number of rounds is the logarithm of the height.

Rows are numbered by a range sort with one total per partition, so a group may hold
any share of them; a run has at most `FAN` rows. Empty table: no rows. NULL fields,
groups and ids are values of their own (NULL first); texts of any length are read
once and only their digest is kept. Rows with one id are ordered by their leaf;
repeated rows are leaves each.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from .common import discard, running_totals, small, written

FAN = 16
FIELDS = ["doc_id", "source", "lang", "n_chars", "text"]
STEP = "struct<before: string, after: string>"
#: Ancestors that are broadcast in a round; each carries at most some kilobytes.
NEAR = 4096


def leaf(fields: dict[str, Column]) -> Column:
    """Digest of the fields, each with its length in front, so that none can pass for another."""
    parts = []
    for value in fields.values():
        text = value.cast("string")
        parts.append(F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-")))
    return F.sha2(F.concat(*parts), 256)


def fold(start: Column, proof: Column) -> Column:
    return F.aggregate(proof, start, lambda digest, step: F.sha2(F.concat(step["before"], digest, step["after"]), 256))


def siblings(proof: Column) -> Column:
    """All siblings of a proof as one text, lowest level first, left to right."""
    return F.array_join(F.transform(proof, lambda step: F.concat(step["before"], step["after"])), "")


def _height(n: Column) -> Column:
    powers = F.array(*[F.lit(FAN**i).cast("long") for i in range(15)])
    return F.size(F.filter(powers, lambda p: p < n))


def _digest(kids: Column) -> Column:
    return F.sha2(F.array_join(kids, ""), 256)


def _steps(kids: str) -> Column:
    """The step of each kid: what stands before it and after it."""
    return F.expr(
        f"transform({kids}, (k, i) -> named_struct('before', array_join(slice({kids}, 1, i), ''), "
        f"'after', array_join(slice({kids}, i + 2, {FAN}), '')))"
    )


def _node(level: Column | str, pos: Column) -> Column:
    """Name of a group's node; its last one, the subroot, goes by the group alone."""
    top = F.concat(F.lit("s"), F.col("gid").cast("string"))
    return F.when(F.col("height") == level, top).otherwise(F.concat_ws("/", "gid", level, pos))


def _climb(nodes: DataFrame) -> DataFrame:
    """The next level of `nodes` (gid, height, level, pos, digest): runs with their kids."""
    runs = nodes.groupBy("gid", "height", "level", F.floor(F.col("pos") / FAN).alias("run"))
    kids = F.sort_array(F.collect_list(F.struct("pos", "digest")))["digest"]  # at most FAN of them
    up = runs.agg(kids.alias("kids")).withColumn("digest", _digest(F.col("kids")))
    return up.select("gid", "height", (F.col("level") + 1).alias("level"), F.col("run").alias("pos"), "digest", "kids")


@dataclass
class Tree:
    runs: DataFrame  # node, height, members (the rows of a run, with leaf), digest
    nodes: DataFrame | None  # inner nodes with the step to their parent: node, above, way
    root_node: str
    root: str

    def ways(self) -> DataFrame | None:
        """(node, way to the root) of every inner node but the root itself."""
        if self.nodes is None:
            return None
        table, at_root = self.nodes, F.col("above") == self.root_node
        while True:
            open_ = table.filter(~at_root)
            wanted = open_.select(F.col("above").alias("node")).distinct()
            next_ = table.join(wanted, "node", "left_semi")
            next_ = next_.select(F.col("node").alias("_at"), F.col("above").alias("_above"), F.col("way").alias("_way"))
            if open_.isEmpty():
                return table
            if wanted.limit(NEAR + 1).count() <= NEAR:
                next_ = F.broadcast(next_)
            jumped = open_.join(next_, F.col("above") == F.col("_at"))
            jumped = jumped.select("node", F.col("_above").alias("above"), F.concat("way", "_way").alias("way"))
            new = written(table.filter(at_root).unionByName(jumped), "merkle-ways")
            discard(table)
            table = new

    def proofs(self) -> DataFrame:
        """The rows of `build` with `proof` (a step a level, lowest first), `subroot` and `root`."""
        ways, none = self.ways(), F.array().cast(f"array<{STEP}>")
        runs = self.runs if ways is None else self.runs.join(ways.select("node", "way"), "node", "left")
        runs = runs.withColumn("way", none if ways is None else F.coalesce("way", none))
        inside = F.slice("way", F.lit(1), F.greatest(F.col("height") - 1, F.lit(0)))
        runs = runs.withColumn("subroot", fold(F.col("digest"), inside))
        runs = runs.withColumn("_kids", F.col("members.leaf"))
        rows = runs.select("height", "way", "subroot", F.inline(F.arrays_zip("members", _steps("_kids").alias("step"))))
        own = F.when(F.col("height") > 0, F.array("step")).otherwise(none)
        return rows.select("members.*", F.concat(own, "way").alias("proof"), "subroot", F.lit(self.root).alias("root"))


def build(rows: DataFrame, group: str, order: str) -> Tree | None:
    """The tree over `rows`, which have `leaf`; None if there are none. All columns of
    `rows` come back in `Tree.proofs`; keep them narrow."""
    by = [F.col(group).asc_nulls_first(), F.col(order).asc_nulls_first(), F.col("leaf").asc()]
    placed = written(running_totals(rows, by, {"_at": F.lit(1)}, "merkle-sorted"), "merkle-placed")
    groups = placed.groupBy(group).agg(F.count("*").alias("_n"), F.min("_at").alias("_first"))
    groups = running_totals(groups, [F.col("_first")], {"gid": F.lit(1)}, "merkle-groups")
    groups = groups.withColumnRenamed(group, "_group").withColumn("height", _height(F.col("_n")))
    groups = written(groups, "merkle-groups")
    total = groups.agg(F.count("*"), F.max("height")).head()
    if not total[0]:
        return None
    joined = placed.join(small(groups), placed[group].eqNullSafe(groups["_group"]))
    runs = joined.groupBy("gid", "height", F.floor((F.col("_at") - F.col("_first")) / FAN).alias("pos"))
    members = F.transform(F.sort_array(F.collect_list(F.struct("_at", F.struct(*rows.columns).alias("row")))), lambda m: m["row"])
    runs = runs.agg(members.alias("members")).withColumn("level", F.least(F.col("height"), F.lit(1)))
    digest = F.when(F.col("height") == 0, F.col("members")[0]["leaf"]).otherwise(_digest(F.col("members.leaf")))
    runs = runs.withColumns({"digest": digest, "node": _node(F.col("level"), F.col("pos"))})
    runs = written(runs, "merkle-runs")
    discard(placed)
    level = runs.select("gid", "height", "level", "pos", "digest")
    subroots, steps = [level.filter("level = height")], []
    for i in range(2, total[1] + 1):
        level = written(_climb(level.filter(F.col("height") >= i)), "merkle-level")
        subroots.append(level.filter("level = height"))
        steps.append(_up(level, lambda pos: _node(F.col("level") - 1, pos)))
    tops = subroots[0]
    for more in subroots[1:]:
        tops = tops.unionByName(more.select(tops.columns))
    height = sum(FAN**i < total[0] for i in range(15))
    top = tops.select(F.lit(-1).alias("gid"), F.lit(height).alias("height"), F.lit(0).alias("level"), F.col("gid").alias("pos"), "digest")
    for i in range(1, height + 1):
        top = written(_climb(top), "merkle-level")
        if i == 1:
            steps.append(_up(top, lambda pos: F.concat(F.lit("s"), pos)))
        else:
            steps.append(_up(top, lambda pos: _node(F.col("level") - 1, pos)))
    if not steps:
        return Tree(runs, None, "s0", top.head().digest)
    nodes = steps[0]
    for more in steps[1:]:
        nodes = nodes.unionByName(more)
    return Tree(runs, written(nodes, "merkle-steps"), "s-1" if height else "s0", top.head().digest)


def _up(level: DataFrame, name) -> DataFrame:
    """Each kid of `level` with the step to its parent."""
    above = _node(F.col("level"), F.col("pos"))
    kids = level.select("gid", "height", "level", "pos", above.alias("above"), F.posexplode(_steps("kids")).alias("i", "step"))
    return kids.select(name(F.col("pos") * FAN + F.col("i")).alias("node"), "above", F.array("step").alias("way"))
