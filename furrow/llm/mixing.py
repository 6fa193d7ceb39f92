"""Mixing sources to target weights by weighted fair queueing, in DataFrame operations only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from furrow.llm.common import in_order, kept, partitions, query, table

WORDS = r"[^\x20\x09-\x0D]+"
ROWS_A_BUCKET = 4096
HASH_BITS = 60


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORDS)), F.lit(0)).cast("long")


def shuffle_key(doc_id: Column, seed: str) -> Column:
    """Place of a document in its source's shuffled order: 60 bits of an MD5, the same in every run and engine."""
    digest = F.md5(F.concat(F.coalesce(doc_id.cast("string"), F.lit("")), F.lit(seed)).cast("binary"))
    return F.conv(F.substring(digest, 1, HASH_BITS // 4), 16, 10).cast("long")


def source_targets(sizes: DataFrame, weights=(5, 2, 1), share: float = 1.5, max_repeats: int = 2) -> DataFrame:
    """Targets of sources: ``source, source_size, rank, weight, target``.

    ``sizes`` has ``source`` and ``source_size``. Sources in code-point order, null last, take the weights in turn and
    share ``share`` times all sizes; a target stops at ``max_repeats`` times its source's size and the excess is shared
    again by weight among the others until none is above.
    """
    null_last = [F.col("source").isNull(), F.col("source")]
    ranged = in_order(sizes, null_last, "mix-sources")
    before = ranged.groupBy("_part").count().select(
        "_part", (F.sum("count").over(W.orderBy("_part")) - F.col("count")).alias("_before"))  # one row per partition
    rank = F.row_number().over(W.partitionBy("_part").orderBy(*null_last)) - 1 + F.col("_before")
    ws = F.array(*[F.lit(int(w)) for w in weights])
    ranked = kept(
        ranged.join(before, "_part").select("source", "source_size", rank.alias("rank"))
        .withColumn("weight", F.get(ws, (F.col("rank") % len(weights)).cast("int"))), "mix-ranked")
    total = ranked.agg(F.sum("source_size")).first()[0] or 0
    budget = share * total
    most, capped, weight_left = max_repeats * F.col("source_size"), 0, None
    level = F.lit(False)
    while True:
        # sources that are not yet at their cap share what the capped ones leave over
        row = ranked.agg(F.sum(F.when(level, most).otherwise(0)).alias("c"), F.sum(F.when(level, 0).otherwise(F.col("weight"))).alias("w")).first()
        if (row["c"] or 0, row["w"]) == (capped, weight_left):
            break
        capped, weight_left = row["c"] or 0, row["w"]
        if not weight_left:
            break
        level = F.lit(budget - capped) * F.col("weight") / F.lit(weight_left) > most
    shared = F.lit(budget - capped) * F.col("weight") / F.lit(weight_left or 1)
    return ranked.withColumn("target", F.when(level, most.cast("double")).otherwise(shared) if weight_left else most.cast("double"))


def _each(df: DataFrame, number: str, name: str) -> DataFrame:
    """Each row ``number`` times, numbered from 1 in ``name``; no array holds more than a block of numbers."""
    blocks = F.sequence(F.lit(0).cast("long"), F.floor((F.col(number) - 1) / ROWS_A_BUCKET))
    first = F.col("_block") * ROWS_A_BUCKET + 1
    return (df.where(F.col(number) > 0).withColumn("_block", F.explode(blocks))
            .withColumn(name, F.explode(F.sequence(first, F.least(first + ROWS_A_BUCKET - 1, F.col(number))))).drop("_block"))


def mix(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
        weights=(5, 2, 1), share: float = 1.5, max_repeats: int = 2, seed: str = ":mix") -> DataFrame:
    """How often the mix takes each document: ``doc_id, source, size, source_size, target, copies, rows, unit_rows, first``.

    Every document of a source gets, in the source's shuffled order and once per repeat, the virtual finish time
    (words of its source up to its end) / (its source's target). All of them are range-sorted by that time, and the
    mix is what comes before the running total of words passes ``share`` times all words.

    Rows of equal id, source and size are a unit: they stand together in the shuffled order, one behind the other, each with
    its own finish time, so that the budget may end among them. One row per unit and number of copies; ``rows`` counts the
    input rows of the unit that are taken so often, ``first`` those that are taken more often. Null text counts no words;
    documents without words have ``copies`` 0, as do all of an empty table's. Null sources are one source, null ids are one
    id. Further columns of ``docs`` play no part.

    A hot source is split: its words are summed by ranges of the shuffle key first, so a window holds one range only. A hot
    unit is one row of its window, and its rows are numbered in blocks that are dealt out to all tasks.
    """
    spark = docs.sparkSession
    units = kept(
        docs.select(F.col(id_col).alias("doc_id"), F.col(source_col).alias("source"), word_count(F.col(text_col)).alias("size"))
        .groupBy("doc_id", "source", "size").agg(F.count(F.lit(1)).alias("rows"))
        .withColumn("h", shuffle_key(F.col("doc_id"), seed)).withColumn("words", F.col("size") * F.col("rows")), "mix-units")
    per_source = units.groupBy("source").agg(F.sum("words").alias("source_size"))
    targets = kept(source_targets(per_source, weights, share, max_repeats), "mix-targets")
    n_units, n_rows, most_rows, total = units.agg(
        F.count(F.lit(1)), F.coalesce(F.sum("rows"), F.lit(0)), F.coalesce(F.max("rows"), F.lit(0)), F.coalesce(F.sum("words"), F.lit(0))).first()
    budget = share * total

    ranges = max(1, n_units // ROWS_A_BUCKET)
    placed = (units.withColumn("range", F.floor(F.col("h") / F.lit(float(1 << HASH_BITS)) * ranges))
              .join(targets.withColumnRenamed("source", "_s"), F.col("source").eqNullSafe(F.col("_s"))).drop("_s", "weight"))
    sums = placed.groupBy("rank", "range").agg(F.sum("words").alias("_words"))
    offsets = sums.select("rank", "range", (F.sum("_words").over(W.partitionBy("rank").orderBy("range")) - F.col("_words")).alias("_before"))
    order = W.partitionBy("rank", "range").orderBy("h", "doc_id", "size").rowsBetween(W.unboundedPreceding, 0)
    ended = (placed.join(offsets, ["rank", "range"])
             .withColumn("_begin", F.col("_before") + F.sum("words").over(order) - F.col("words")))
    if most_rows > 1:
        blocks = ended.withColumn("_b", F.explode(F.sequence(F.lit(0).cast("long"), F.floor((F.col("rows") - 1) / ROWS_A_BUCKET))))
        if most_rows > ROWS_A_BUCKET:
            blocks = blocks.repartition("rank", "h", "doc_id", "size", "_b")
        first = F.col("_b") * ROWS_A_BUCKET + 1
        ended = blocks.withColumn("row", F.explode(F.sequence(first, F.least(first + ROWS_A_BUCKET - 1, F.col("rows"))))).drop("_b")
    else:
        ended = ended.withColumn("row", F.lit(1).cast("long"))
    finish = (F.col("repeat") * F.col("source_size") + F.col("_begin") + F.col("row") * F.col("size")) / F.col("target")
    queue = (ended.withColumn("repeat", F.explode(F.sequence(F.lit(0), F.lit(max_repeats - 1))))
             .withColumn("finish", F.when(F.col("target") > 0, finish).otherwise(F.lit(float("inf"))))
             .select("rank", "h", "doc_id", "source", "size", "rows", "row", "source_size", "target", "repeat", "finish"))

    by_time = [F.col(c) for c in ("finish", "rank", "h", "doc_id", "size", "row", "repeat")]
    ranged = in_order(queue, by_time, "mix-queue", max(partitions(spark), n_rows // 100_000))
    parts = ranged.groupBy("_part").agg(F.sum("size").alias("_words"))
    before = parts.select("_part", (F.sum("_words").over(W.orderBy("_part")) - F.col("_words")).alias("_before"))  # one row per partition
    run = F.col("_before") + F.sum("size").over(W.partitionBy("_part").orderBy(*by_time).rowsBetween(W.unboundedPreceding, 0))
    taken = (F.col("_run") <= F.lit(budget)) & (F.col("size") > 0)
    # of a unit the rows taken k times or more are its first ones
    counted = [F.count_if(taken & (F.col("repeat") == k)) for k in range(max_repeats)]
    found = (ranged.join(before, "_part").withColumn("_run", run)
             .groupBy("doc_id", "source", "size", "rows", "source_size", "target").agg(F.array(*counted).alias("_taken")))
    level = F.transform(F.sequence(F.lit(0), F.lit(max_repeats)), lambda k: F.struct(
        k.cast("long").alias("copies"), (F.when(k == 0, F.col("rows")).otherwise(F.get("_taken", k - 1)) - F.coalesce(F.get("_taken", k), F.lit(0))).alias("rows"),
        F.coalesce(F.get("_taken", k), F.lit(0)).alias("first")))
    return found.withColumn("_l", F.explode(F.filter(level, lambda v: v["rows"] > 0))).select(
        "doc_id", "source", "size", "source_size", "target", "_l.copies", "_l.rows", F.col("rows").alias("unit_rows"), "_l.first")


def mixed_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
                    max_repeats: int = 2, seed: str = ":mix", **options) -> DataFrame:
    """The rows of ``docs``, all columns kept, each repeated as often as the mix takes it; rows it leaves out go.

    The mix takes the units of a source in their shuffled order, up to one unit for the first time, to an earlier one for the
    second, and so on. These last units, a row per source, say of every document how often it is taken, so documents do not
    travel. Where the mix takes rows of one unit differently often (one unit a source and repeat at most), the unit's rows are
    numbered by the hash of their text, in sorted ranges, so that no task holds a unit; only such units are numbered.
    """
    columns = docs.columns
    unit = [F.col("_id"), F.col("_source"), F.col("_size")]

    def place(doc_id: Column, size: Column) -> Column:
        return F.struct(shuffle_key(doc_id, seed).alias("h"), doc_id.alias("doc_id"), size.alias("size"))

    def repeated(rows: DataFrame) -> DataFrame:
        copies = rows.where("copies > 0").withColumn("_copy", F.explode(F.sequence(F.lit(1).cast("long"), F.col("copies"))))
        return copies.select(*[F.col(f"_doc.`{c}`").alias(c) for c in columns])

    mixed = kept(mix(docs, id_col, text_col, source_col, max_repeats=max_repeats, seed=seed, **options), "mix-taken")
    at, even = place(F.col("doc_id"), F.col("size")), F.col("rows") == F.col("unit_rows")
    last = [F.max(F.when(even & (F.col("copies") >= k), at)).alias(f"_last{k}") for k in range(1, max_repeats + 1)]
    # stored, so that Spark knows how small they are before the documents are read
    ends = kept(mixed.where("copies > 0 OR rows < unit_rows").groupBy(F.col("source").alias("_source")).agg(
        *last, F.collect_set(F.when(~even, F.struct("doc_id", "size"))).alias("_uneven")), "mix-ends")
    whole = docs.select(F.struct("*").alias("_doc"), word_count(F.col(text_col)).alias("_words"))
    doc_id, source, words = F.col(f"_doc.`{id_col}`"), F.col(f"_doc.`{source_col}`"), F.col("_words")
    here = place(doc_id, words)
    copies = sum((F.coalesce(here <= F.col(f"_last{k}"), F.lit(False)).cast("long") for k in range(1, max_repeats + 1)), F.lit(0).cast("long"))
    split = F.exists("_uneven", lambda u: u["doc_id"].eqNullSafe(doc_id) & (u["size"] == words))
    counted = F.when((words > 0) & ~split, copies).otherwise(0)  # after the join, or words would be counted twice
    out = repeated(whole.join(ends, source.eqNullSafe(F.col("_source"))).withColumn("copies", counted))
    uneven = kept(mixed.where("rows < unit_rows").select(
        F.col("doc_id").alias("_id"), F.col("source").alias("_source"), F.col("size").alias("_size"), "copies", "first", "rows"), "mix-uneven-units")
    if uneven.isEmpty():
        return out
    same = doc_id.eqNullSafe(F.col("_id")) & source.eqNullSafe(F.col("_source")) & (words == F.col("_size"))
    by_text = [*unit, F.xxhash64(F.col(f"_doc.`{text_col}`")), F.col("_at")]
    ranged = in_order(whole.withColumn("_at", F.monotonically_increasing_id()).join(uneven.select(*unit).distinct(), same), by_text, "mix-uneven")
    parts = ranged.groupBy(*unit, "_part").agg(F.count(F.lit(1)).alias("_c"))
    before = parts.withColumn("_before", F.sum("_c").over(W.partitionBy(*unit).orderBy("_part")) - F.col("_c")).drop("_c")  # a row per part
    row = F.row_number().over(W.partitionBy(*unit, "_part").orderBy(*by_text))
    met = [F.col(f"a.{c}").eqNullSafe(F.col(f"b.{c}")) for c in ("_id", "_source", "_size")]
    placed = ranged.withColumn("_row", row).alias("a").join(before.alias("b"), [*met, F.col("a._part") == F.col("b._part")]).select(
        "a._id", "a._source", "a._size", "_doc", (F.col("_row") + F.col("_before")).alias("_place"))
    reached = (F.col("_place") > F.col("first")) & (F.col("_place") <= F.col("first") + F.col("rows"))
    return out.unionByName(repeated(placed.alias("a").join(uneven.alias("b"), [*met, reached])))


OP5_SQL = r"""
WITH d AS (
  SELECT doc_id, source, row_number() OVER (PARTITION BY doc_id, source, coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)) AS j,
         CAST(coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0) AS BIGINT) AS size,
         ('0x' || substr(md5(coalesce(CAST(doc_id AS VARCHAR), '') || ':mix'), 1, 15))::BIGINT AS h
  FROM documents),
s AS (
  SELECT source, CAST(sum(size) AS BIGINT) AS source_size, row_number() OVER (ORDER BY source IS NULL, source) - 1 AS rank
  FROM d GROUP BY source),
w AS (
  SELECT *, CASE rank % 3 WHEN 0 THEN 5 WHEN 1 THEN 2 ELSE 1 END AS weight, CAST(sum(source_size) OVER () AS DOUBLE) * 1.5 AS budget FROM s),
o AS (
  SELECT *, coalesce(sum(2 * source_size) OVER (ORDER BY 2.0 * source_size / weight, rank ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS below,
         sum(weight) OVER (ORDER BY 2.0 * source_size / weight, rank ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS weight_left FROM w),
c AS (SELECT *, (budget - below) * weight / weight_left > 2 * source_size AS full_ FROM o),
k AS (SELECT coalesce(sum(CASE WHEN full_ THEN 2 * source_size END), 0) AS capped, sum(CASE WHEN NOT full_ THEN weight END) AS weight_left FROM c),
t AS (
  SELECT c.source, c.source_size, c.rank, c.budget,
         CASE WHEN full_ THEN CAST(2 * source_size AS DOUBLE) ELSE (c.budget - CAST(k.capped AS DOUBLE)) * c.weight / CAST(k.weight_left AS DOUBLE) END AS target
  FROM c CROSS JOIN k),
q AS (
  SELECT d.doc_id, d.size, d.h, d.j, t.source_size, t.rank, t.target, t.budget, r.e,
         CAST(r.e * t.source_size + sum(d.size) OVER (PARTITION BY t.rank, r.e ORDER BY d.h, d.doc_id, d.size, d.j ROWS UNBOUNDED PRECEDING) AS DOUBLE) / t.target AS finish
  FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source CROSS JOIN (SELECT unnest([0, 1]) AS e) AS r),
g AS (
  SELECT *, sum(size) OVER (ORDER BY finish, rank, h, doc_id, size, j, e ROWS UNBOUNDED PRECEDING) <= budget AS taken FROM q)
SELECT doc_id, size, source_size, target, CAST(sum(CASE WHEN taken THEN size ELSE 0 END) AS BIGINT) AS taken
FROM g GROUP BY doc_id, rank, j, size, source_size, target
"""


@query("op5_fair_queueing_mix", OP5_SQL)
def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    taken = mix(table(spark, sf_dir, "documents"))
    return _each(taken, "rows", "_row").select("doc_id", "size", "source_size", "target", (F.col("size") * F.col("copies")).alias("taken"))
