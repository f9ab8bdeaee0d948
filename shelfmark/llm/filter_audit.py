"""What every order of a set of filters removes, and what each filter would remove without the others.

A document is reduced to a mask of the filters it fails. Documents with one part and one mask are a cell,
so everything after the first pass works on at most 2**filters cells a part. Orders are enumerated by a
recursive common table expression: a level extends each prefix with every unused letter, meets the cells of
its part, carries the applied bits and emits the figures of that step.

Copies are found without a join: rows meet their label by id, then equal texts (by digest) meet as one row a
part, with the counts of their smallest id apart. A text that a third of all documents share reaches the
later shuffles as one row for each task.
"""

from __future__ import annotations

import uuid
from math import factorial

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shelfmark.llm.common import checkpointed, clean_text

#: Order of rows without doc_id: after all others.
LAST = (1 << 63) - 1
SPACE = "[\\x20\\x09-\\x0D]+"
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
#: Rows that a recursive query may return otherwise (Spark's default is a million, 3,067 parts).
ROW_LIMIT = "spark.sql.cteRecursionRowLimit"


def text_filters(text: Column) -> list[Column]:
    """Failure conditions of A to D, for a text that is not null."""
    words = F.filter(F.split(text, SPACE), lambda w: w != "")
    n = F.size(words)
    capitals = F.length(text) - F.length(F.translate(text, UPPER, ""))
    return [n < 200, 100 * F.size(F.array_distinct(words)) < 50 * n, 100 * capitals > 2 * F.length(text),
            text.rlike("[#$%&*|]")]


def mask_cells(docs: DataFrame, labels: DataFrame, checks=text_filters, copies: bool = True) -> DataFrame:
    """(part, mask, n, good, toxic): documents of each source by the filters they fail.

    Bit k of the mask is the k-th condition of `checks`; with `copies`, one more bit tells that the text is
    that of a smaller doc_id anywhere in the table. A part is a source value, the empty string for null.
    A document is good or toxic if any label row of its id says so. A row without doc_id has no label and
    counts as a copy of any row that has one; such rows are no copies of each other.
    """
    conditions = checks(F.col("_text"))
    bits = sum((F.when(c, 1 << k).otherwise(0) for k, c in enumerate(conditions)), F.lit(0))
    rows = docs.select("doc_id", F.coalesce("source", F.lit("")).alias("part"), clean_text().alias("_text")).select(
        "doc_id", "part", bits.cast("int").alias("mask"), F.sha2("_text", 256).alias("digest"))
    flags = labels.filter(F.col("doc_id").isNotNull()).groupBy("doc_id").agg(
        F.max(F.when(F.col("quality") == 1, 1).otherwise(0)).alias("good"),
        F.max(F.when(F.col("toxic") == 1, 1).otherwise(0)).alias("toxic"))
    known = rows.filter(F.col("doc_id").isNotNull()).join(flags, "doc_id", "left").select(
        F.col("doc_id").cast("bigint").alias("doc_id"), "part", "mask", "digest", "good", "toxic")
    unknown = rows.filter(F.col("doc_id").isNull()).select(
        F.lit(LAST).alias("doc_id"), "part", "mask", "digest", F.lit(0).alias("good"), F.lit(0).alias("toxic"))
    sums = [F.sum(c).cast("bigint").alias(c) for c in ("n", "good", "toxic")]
    by_id = known.unionByName(unknown).groupBy("digest", "part", "mask", "doc_id").agg(
        F.count("*").alias("n"), F.sum(F.coalesce("good", F.lit(0))).alias("good"),
        F.sum(F.coalesce("toxic", F.lit(0))).alias("toxic"))
    if not copies:
        return by_id.groupBy("part", "mask").agg(*sums)
    one_text = by_id.groupBy("digest", "part", "mask").agg(
        *sums, F.min(F.struct("doc_id", F.struct("n", "good", "toxic").alias("own"))).alias("first"))
    first = F.min("first.doc_id").over(Window.partitionBy("digest"))
    # The rows of the smallest id are no copies; the rest of the group is.
    own = F.when(F.col("first.doc_id") == F.col("_first"), F.col("first.own"))
    mine = {c: F.coalesce(own[c], F.lit(0)) for c in ("n", "good", "toxic")}
    split = F.array(
        F.struct(F.col("mask"), *(mine[c].alias(c) for c in mine)),
        F.struct(F.col("mask").bitwiseOR(F.lit(1 << len(conditions))).alias("mask"),
                 *((F.col(c) - mine[c]).alias(c) for c in mine)))
    cells = one_text.withColumn("_first", first).select("part", F.inline(split)).filter("n > 0")
    return cells.groupBy("part", "mask").agg(*sums)


def audit_orders(cells: DataFrame, letters: str) -> DataFrame:
    """(part, filter_order, step, kept, removed, redundant, unique_fails, good_lost, toxic_lost, shapley).

    One row per part, order of all letters and step, zeros included. `shapley` is what the step's filter
    removes, summed over all orders.
    """
    spark = cells.sparkSession
    name = f"cells_{uuid.uuid4().hex}"
    total = "aggregate({0}, 0L, (acc, x) -> acc + if({1}, x.{2}, 0L))"
    fails, before, after = "x.mask & (1 << f.k) <> 0", "x.mask & s.applied", "x.mask & (s.applied | (1 << f.k))"

    def of(condition: str, value: str = "n", cells: str = "c.cells") -> str:
        return total.format(cells, condition, value)

    by_part = checkpointed(cells.groupBy("part").agg(F.collect_list(F.struct("mask", "n", "good", "toxic")).alias("cells")))
    by_part.createOrReplaceTempView(name)
    limit = spark.conf.get(ROW_LIMIT)
    spark.conf.set(ROW_LIMIT, "-1")
    try:
        steps = checkpointed(spark.sql(f"""
            WITH RECURSIVE steps(part, prefix, applied, step, kept, removed, redundant, unique_fails, good_lost, toxic_lost) AS (
                SELECT part, '', 0, 0, {of('true', 'n', 'cells')}, 0L, 0L, 0L, 0L, 0L FROM {name}
                UNION ALL
                SELECT s.part, concat(s.prefix, substr('{letters}', f.k + 1, 1)), s.applied | (1 << f.k), s.step + 1,
                    {of(f'{after} = 0')}, {of(f'{fails} AND {before} = 0')}, {of(f'{fails} AND {before} <> 0')},
                    {of('x.mask = 1 << f.k')}, {of(f'{fails} AND {before} = 0', 'good')},
                    {of(f'{fails} AND {before} = 0', 'toxic')}
                FROM steps s JOIN {name} c ON c.part = s.part LATERAL VIEW explode(sequence(0, {len(letters) - 1})) f AS k
                WHERE s.applied & (1 << f.k) = 0)
            SELECT * FROM steps"""))
    finally:
        spark.conf.set(ROW_LIMIT, limit)
        spark.catalog.dropTempView(name)
    # A prefix of d letters begins (letters - d)! orders, so its last letter removes that often what it removes here.
    times = F.element_at(F.array(*(F.lit(factorial(len(letters) - d)) for d in range(1, len(letters) + 1))), F.col("step"))
    credit = steps.filter("step > 0").groupBy("part", F.substring("prefix", -1, 1).alias("letter")).agg(
        F.sum(F.col("removed") * times).alias("shapley"))
    orders = steps.filter(F.col("step") == len(letters)).select(
        "part", F.col("prefix").alias("filter_order"), F.explode(F.sequence(F.lit(1), F.lit(len(letters)))).alias("step"))
    orders = orders.withColumns({"prefix": F.expr("left(filter_order, step)"), "letter": F.expr("substr(filter_order, step, 1)")})
    return orders.join(steps.drop("applied", "step"), ["part", "prefix"]).join(credit, ["part", "letter"]).select(
        "part", "filter_order", "step", "kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley")


def audit_filters(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The audit of filters A to E over documents, for every order and step.

    A: under 200 words; B: under half of the words are distinct; C: over 2% capitals A-Z; D: any of `#$%&*|`;
    E: the text of a smaller doc_id, wherever that is and whether or not another filter removes it.

    - a null or empty text has no words: it fails A and, unless it is the first, E;
    - source null and the empty string are one part; no documents, no rows;
    - rows that share doc_id and text are no copies of each other; labels of an id count for each of its rows;
    - other columns are ignored, as are labels without doc_id or for absent documents.
    """
    return audit_orders(mask_cells(docs, labels), "ABCDE")
