"""Category trees stored as parent links."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyline.session import stored_sums

ARROW = " → "


#: Rounds after which nodes that have not come to a root are looked at without their paths.
ROUNDS = 14


def category_tree(edges: DataFrame) -> DataFrame:
    """Level, indented label and path of every node reachable from a root.

    Pointer doubling: every node holds the path down from some ancestor and that
    ancestor's id, at first its parent. In each round it is put behind the path of its
    ancestor, and takes over the ancestor of that, so paths double in length and a tree of
    depth d takes about log2(d) joins. A round is written once, with the number of nodes
    that have not come to a root; adaptive execution splits the children of a parent that
    has most of them. A node that is its own ancestor, by a loop under a repeated id, is
    an error; nodes and loops that no root leads to are left out.
    """
    nodes = edges.select("category_id", "category_name", "level", F.col("parent_category_id").alias("_above"),
                         F.col("category_name").alias("full_path"))
    repeated = not edges.groupBy("category_id").count().filter("count > 1").isEmpty()
    paths, seen = stored_sums(_rooted(nodes) if repeated else nodes, "paths", open=F.count("_above"))
    rounds = 0
    while seen["open"]:
        rounds += 1
        if rounds == ROUNDS and not repeated:
            # Deep, or a loop that no root leads to, whose paths would grow for ever.
            paths = _rooted(paths)
        upper = paths.select(F.col("category_id").alias("_id"), F.col("full_path").alias("_path"), F.col("_above").alias("_next"))
        grown = (paths.filter("_above IS NOT NULL").join(upper, F.col("_above") == F.col("_id"))
                 .withColumns({"full_path": F.concat("_path", F.lit(ARROW), "full_path"), "_above": F.col("_next")})
                 .select(*paths.columns))
        paths, seen = stored_sums(paths.filter("_above IS NULL").unionByName(grown), "paths", open=F.count("_above"))
    return _labelled(paths)


def _rooted(nodes: DataFrame) -> DataFrame:
    """The rows of ``nodes`` that a root leads to, by doubling of ids alone; loops among them are an error."""
    steps = nodes.select(F.col("category_id").alias("_id"), F.col("_above").alias("_up")).distinct()
    steps, seen = stored_sums(steps, "steps", rows=F.count(F.lit(1)), open=F.count("_up"))
    length, most = 1, seen["rows"]
    while seen["open"] and length <= most:
        further = steps.select(F.col("_id").alias("_up"), F.col("_up").alias("_next"))
        grown = steps.filter("_up IS NOT NULL").join(further, "_up").select("_id", F.col("_next").alias("_up"))
        steps, seen = stored_sums(steps.filter("_up IS NULL").unionByName(grown).distinct(), "steps", open=F.count("_up"))
        length *= 2
    rooted = steps.filter("_up IS NULL").select(F.col("_id"))
    if seen["open"]:   # a walk longer than there are nodes goes round a loop
        loop = steps.filter("_up IS NOT NULL").select(F.col("_up").alias("_id")).join(rooted, "_id", "left_semi").first()
        if loop:
            raise ValueError(f"a node is its own ancestor: {loop[0]}")
    return nodes.filter("_above IS NULL").unionByName(nodes.join(rooted, F.col("_above") == F.col("_id"), "left_semi"))


def category_tree_sql(spark: SparkSession, edges_view: str) -> DataFrame:
    """The same as one recursive query, for trees within the recursion limits of
    the session (``spark.sql.cteRecursionLevelLimit`` and ``...RowLimit``)."""
    return _labelled(spark.sql(f"""
        WITH RECURSIVE tree(category_id, category_name, level, full_path) AS (
            SELECT category_id, category_name, level, category_name
            FROM {edges_view} WHERE parent_category_id IS NULL
            UNION ALL
            SELECT c.category_id, c.category_name, c.level,
                   t.full_path || '{ARROW}' || c.category_name
            FROM {edges_view} c JOIN tree t ON c.parent_category_id = t.category_id)
        SELECT level, category_name, full_path FROM tree"""))


def _labelled(tree: DataFrame) -> DataFrame:
    label = F.concat(F.repeat(F.lit("  "), F.col("level").cast("int")), F.col("category_name"))
    return tree.select("level", label.alias("category_tree"), "full_path").orderBy("full_path")
