"""Idempotent loads: last wins and first wins."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Observation, Window, functions as F

from ..sources.scratch import scratch


def handed_over(df: DataFrame, label: str) -> DataFrame:
    """``df`` as a table in the shared scratch folder, which cuts its lineage."""
    path = scratch(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def last_wins(target: DataFrame, updates: list[DataFrame], keys: list[str], order: str) -> DataFrame:
    """``target`` after loading ``updates`` in order: a key's last row stays, within a
    load the one with the largest ``order`` (a line number, say; nulls come first).
    Null keys are values like any other, as in a keyed document store."""
    steps = [df.withColumn("__seq", F.lit(i)) for i, df in enumerate([target, *updates])]
    every = reduce(DataFrame.unionByName, steps)
    newest = Window.partitionBy(*keys).orderBy(F.desc("__seq"), F.desc_nulls_last(order))
    return every.withColumn("__rank", F.row_number().over(newest)).where("__rank = 1").drop("__seq", "__rank")


def _firsts(left: DataFrame, uniques: list[list[str]], order: str) -> DataFrame:
    """The rows that come first under all their keys."""
    firsts = left
    for i, k in enumerate(uniques):
        whole = reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in k])
        # rows without a whole key are ranked alone, so that they do not meet in one task
        rank = F.row_number().over(Window.partitionBy(*k, F.when(~whole, F.col(order))).orderBy(order))
        firsts = firsts.withColumn(f"__rank{i}", F.when(whole, rank).otherwise(1))
    return firsts.where(" and ".join(f"__rank{i} = 1" for i in range(len(uniques)))).select(*left.columns)


def _groups(links: DataFrame) -> DataFrame:
    """(node, root) of the connected nodes of ``links`` (node, other), the root being the least
    of them.  Each round a node and its root take the least root among the node's
    neighbours, and roots are followed one step further, so rounds grow with the logarithm of a chain."""
    both = handed_over(links.unionByName(links.select(F.col("other").alias("node"), F.col("node").alias("other"))).distinct(), "links")
    now = handed_over(both.groupBy("node").agg(F.min("other").alias("m")).select("node", F.least("node", "m").alias("root")), "roots")
    mark = None
    while (after := tuple(now.agg(F.count("*"), F.bit_xor(F.xxhash64("node", "root"))).first())) != mark:
        mark = after
        near = both.join(now.select(F.col("node").alias("other"), F.col("root").alias("m")), "other").groupBy("node").agg(F.min("m").alias("m"))
        told = now.join(near, "node").select("node", "root", F.least("root", "m").alias("m"))
        told = told.select("node", "m").unionByName(told.select(F.col("root").alias("node"), "m")).groupBy("node").agg(F.min("m").alias("root"))
        further = told.select(F.col("node").alias("root"), F.col("root").alias("next"))
        now = handed_over(told.join(further, "root", "left").select("node", F.coalesce("next", "root").alias("root")), "roots")
    return now


def _in_order(left: DataFrame, uniques: list[list[str]], order: str, most: int) -> tuple[DataFrame, DataFrame]:
    """The rows (node) that win in groups of conflicts of at most ``most`` rows, each taken in
    order by one task, and the rows (node) of larger groups."""
    keys = []
    for i, k in enumerate(uniques):
        whole = reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in k])
        keys.append(F.when(whole, F.to_json(F.array(*[F.col(c).cast("string") for c in k]))).alias(f"k{i}"))
    named = handed_over(left.select(F.col(order).alias("node"), *keys), "keys")
    links = []
    for i in range(len(uniques)):
        first = named.where(F.col(f"k{i}").isNotNull()).groupBy(f"k{i}").agg(F.min("node").alias("other"))
        links.append(named.join(first, f"k{i}").select("node", "other"))
    grouped = named.join(_groups(reduce(DataFrame.unionByName, links)), "node", "left").withColumn("root", F.coalesce("root", "node"))
    sizes = grouped.groupBy("root").agg((F.count("*") <= most).alias("fits"))
    grouped = handed_over(grouped.join(sizes, "root"), "groups")

    def run(rows):  # type: ignore[no-untyped-def]
        rows = rows.sort_values("node")
        seen: list[set] = [set() for _ in uniques]
        won = []
        for keys in zip(*[rows[f"k{i}"] for i in range(len(uniques))]):
            free = all(k is None or k not in s for k, s in zip(keys, seen))
            won.append(free)
            if free:
                for k, s in zip(keys, seen):
                    s.add(k)
        return rows.loc[won, ["node"]]

    kind = left.schema[order].dataType.simpleString()
    return grouped.where("fits").drop("fits").groupBy("root").applyInPandas(run, f"node {kind}"), grouped.where("not fits").select("node")


ROUNDS = 3  # rounds before what is left is taken by groups of conflicts
MOST_ROWS = 1_000_000  # rows of a group that one task takes in order; larger groups go on by rounds


def first_wins(target: DataFrame | None, rows: DataFrame, uniques: list[list[str]], order: str, most: int = MOST_ROWS, audit: dict[str, int] | None = None) -> DataFrame:
    """The rows that a load with ON CONFLICT DO NOTHING inserts, in file order.

    ``uniques`` are the unique keys; a key with a null part never conflicts.  ``order`` is
    unique and not null.  A row that was not inserted blocks no later one.  A round inserts the
    rows that come first under all their keys and drops those in conflict with them;
    clean data needs one, and rows that are repeated often are gone after it.  What
    ROUNDS leave are chains of conflicts: they are cut into groups that do not touch each
    other, in a number of passes that grows with the logarithm of a chain, and each group is
    taken in order at once.

    ``audit`` gets the counts valid, inserted and skipped, observed while the load writes.
    """
    seen = [Observation("valid")]
    if audit is not None:
        rows = rows.observe(seen[0], F.count("*").alias("n"))

    def write_won(won: DataFrame) -> DataFrame:
        if audit is None:
            return handed_over(won, "inserted")
        seen.append(Observation(f"inserted-{len(seen)}"))
        return handed_over(won.observe(seen[-1], F.count("*").alias("n")), "inserted")

    left = rows if target is None else reduce(lambda df, k: df.join(target.select(*k), k, "left_anti"), uniques, rows)
    inserted, done = None, 0
    while True:
        if done and done % ROUNDS == 0:
            taken, larger = _in_order(left, uniques, order, most)
            won = left.join(taken.withColumnRenamed("node", order), order, "left_semi").select(*rows.columns)
            left = left.join(larger.withColumnRenamed("node", order), order, "left_semi").select(*rows.columns)
            won, left = write_won(won), handed_over(left, "waiting")
        else:
            won = write_won(_firsts(left, uniques, order))
            rest = left.join(won.select(F.col(order).alias("__won")), F.col(order) == F.col("__won"), "left_anti")
            left = handed_over(reduce(lambda df, k: df.join(won.select(*k), k, "left_anti"), uniques, rest).select(*rows.columns), "waiting")
        inserted = won if inserted is None else inserted.unionByName(won)
        done += 1
        if left.isEmpty():
            break
    if audit is not None:
        valid, *won = [o.get["n"] for o in seen]
        audit.update(valid=valid, inserted=sum(won), skipped=valid - sum(won))
    return inserted
