"""Mixing sources to target weights by Pfair scheduling.

Each source is cut into blocks of rows in the order of a hash. With weight p / P, the j-th
block of a source is released at floor((j - 1) P / p) and due at ceil(j P / p); in every slot
the released block with the earliest deadline runs, sources in order of name breaking ties.
Then no source is a whole block away from its share, at any size and for any number of sources.
Once a source has run out, slots would stay empty: they go to the block with the earliest
deadline, released or not, so the others keep their proportions and every slot has a block.

The schedule knows one counter for each source. It is worked out in stretches of slots, each of
which starts from the counters that the one before stored; the rows themselves are numbered and
find their slots in parallel. Only DataFrame functions are used.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from corpusflow.session import fresh_path, stored

BLOCK_ROWS = 32
#: Rows that are numbered in one task.
BUCKET_ROWS = 200_000
#: Weights are whole parts of about this total, one at least: as many slots stay within a block of the weights.
WHOLE = 1 << 31
#: Slots of a run of the schedule's inner loop, and runs of a stretch.
RUN_SLOTS = 512
RUNS = 128

#: The counters and the slots' sources after a run from slot ``first`` on: early blocks last, then by deadline.
_RUN = f"""
aggregate(
  sequence(first, least(first + {RUN_SLOTS}, slots) - 1),
  named_struct('next', s.next, 'chosen', cast(array() AS array<int>)),
  (r, t) -> transform(
    array(array_min(transform(sources, (x, i) -> if(
      r.next[i] <= x.blocks,
      named_struct(
        'early', ((r.next[i] - 1) * period) div x.part > t,
        'deadline', (r.next[i] * period + x.part - 1) div x.part,
        'i', i),
      NULL)))),
    c -> named_struct(
      'next', transform(r.next, (j, i) -> if(i = c.i, j + 1, j)),
      'chosen', concat(r.chosen, array(c.i))))[0],
  r -> named_struct('next', r.next, 'runs', concat(s.runs, array(r.chosen))))
"""
_STRETCH = f"""
aggregate(
  sequence(start, least(start + {RUN_SLOTS * RUNS}, slots) - 1, {RUN_SLOTS}L),
  named_struct('next', next, 'runs', cast(array() AS array<array<int>>)),
  (s, first) -> {_RUN})
"""


def square_root_weights(sizes: DataFrame) -> DataFrame:
    """Weights between the sources' own sizes and equal shares: ``src, weight``."""
    return sizes.select("src", F.sqrt("rows").alias("weight"))


def schedule(sources: DataFrame) -> DataFrame:
    """``src, block, slot`` for each block, from 0, of ``sources`` (``src, weight, blocks``).

    A weight that is zero or NULL counts as the least one, a part of ``WHOLE``. All sources are
    listed in one row, so their number must be one that a task can hold; blocks may be any
    number. A slot takes time that grows with the sources, and stretches follow one another.
    """
    spark = sources.sparkSession
    total = sources.agg(F.sum("weight").alias("total"))
    share = F.coalesce(F.try_divide(F.lit(WHOLE) * F.col("weight"), F.col("total")), F.lit(0.0))
    part = F.greatest(F.lit(1), F.round(share).cast("long")).alias("part")
    parts = sources.join(F.broadcast(total)).select("src", part, F.col("blocks").cast("long").alias("blocks"))  # one row
    listed = parts.agg(F.array_sort(F.collect_list(F.struct("src", "part", "blocks"))).alias("sources"))
    state = stored(
        listed.select(
            "sources",
            F.expr("aggregate(sources, 0L, (a, s) -> a + s.part)").alias("period"),
            F.expr("aggregate(sources, 0L, (a, s) -> a + s.blocks)").alias("slots"),
            F.expr("transform(sources, s -> 1L)").alias("next"),
        ),
        "sources",
    )
    slots = state.first()["slots"]
    path = fresh_path(spark, "schedule")
    schema = "src string, block long, slot long"
    spark.createDataFrame([], schema).write.parquet(path)
    for start in range(0, slots, RUN_SLOTS * RUNS):
        run = state.withColumn("start", F.lit(start).cast("long")).withColumn("run", F.expr(_STRETCH))
        run = stored(run, "stretch")
        chosen = run.select("sources", "next", "start", F.posexplode(F.flatten("run.runs")).alias("at", "i"))
        slot, src, first = (F.col("start") + F.col("at"), F.expr("sources[i].src"), F.expr("next[i]"))
        chosen = chosen.select("i", slot.alias("slot"), src.alias("src"), first.alias("first"))
        within = F.row_number().over(Window.partitionBy("i").orderBy("slot")) - 2
        chosen.select("src", (F.col("first") + within).alias("block"), "slot").write.mode("append").parquet(path)
        state = run.select("sources", "period", "slots", F.col("run.next").alias("next"))
    return spark.read.schema(schema).parquet(path)


def mix(docs: DataFrame, source: str = "source", weights: DataFrame | None = None, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """``row, src, slot, place``: each row, its source, its block's slot and its place in the block.

    Sorted by ``slot, place`` the rows are the mixture; none is dropped or repeated, and the slots
    are the numbers from 0 on. ``weights`` holds ``src, weight`` (``src`` is the text of the
    source); a source without a weight comes last. Without ``weights`` the square roots of the
    row counts are the targets.

    ``row`` is a struct of all columns of ``docs``, so other columns may have any name. Rows
    without a source share one, named by the empty text; rows of one source with equal ids are
    interchangeable. Rows without an id are spread by the hash of their other columns. An empty
    table gives no rows, a single source every slot.
    """
    columns = [F.col(f"`{c}`") for c in docs.columns]
    text_id = F.coalesce(F.col("doc_id").cast("string"), F.lit(""))
    hashed = [F.col(f"`{f.name}`") for f in docs.schema if "map<" not in f.dataType.simpleString()]
    spread = F.when(F.col("doc_id").isNull(), F.xxhash64(*hashed)).otherwise(0)
    keyed = docs.select(
        F.coalesce(F.col(source).cast("string"), F.lit("")).alias("src"),
        F.md5(F.concat(F.lit("mix:"), text_id)).alias("h"),
        spread.alias("spread"),
        F.struct(*columns).alias("row"),
    )
    buckets = max(1, -(-docs.count() // BUCKET_ROWS))
    upper = F.conv(F.substring("h", 1, 8), 16, 10).cast("long")
    # Rows without an id share one hash, hence one bucket: there they are cut by their spread, others follow by hash.
    part = (
        F.when(F.col("row.doc_id").isNull(), F.pmod(F.shiftright("spread", 32), F.lit(buckets)))
        .when(F.col("h") <= F.md5(F.lit("mix:")), 0)
        .otherwise(buckets)
    )
    keyed = keyed.withColumn("bucket", F.shiftright(upper * buckets, 32)).withColumn("part", part)

    counts = stored(keyed.groupBy("src", "bucket", "part").agg(F.count("*").alias("n")), "counts")
    before = F.sum("n").over(Window.partitionBy("src").orderBy("bucket", "part")) - F.col("n")
    sizes = counts.groupBy("src").agg(F.sum("n").alias("rows"))
    if weights is None:
        weights = square_root_weights(sizes)
    blocks = F.ceil(F.col("rows") / block_rows).alias("blocks")
    planned = schedule(sizes.join(weights, "src", "left").select("src", "weight", blocks))

    starts = counts.select("src", "bucket", "part", "n", before.alias("before"))
    first, last = F.expr(f"before div {block_rows}"), F.expr(f"(before + n - 1) div {block_rows}")
    starts = starts.withColumn("first", first).withColumn("block", F.explode(F.sequence(first, last)))
    starts = starts.join(planned, ["src", "block"]).groupBy("src", "bucket", "part", "before", "first")
    starts = starts.agg(F.expr("transform(array_sort(collect_list(struct(block, slot))), b -> b.slot)").alias("slots"))

    in_bucket = F.row_number().over(Window.partitionBy("src", "bucket", "part").orderBy("h", "row.doc_id", "spread")) - 1
    numbered = keyed.withColumn("n", in_bucket).join(starts, ["src", "bucket", "part"])
    numbered = numbered.withColumn("number", F.col("before") + F.col("n"))
    return numbered.select(
        "row",
        "src",
        F.expr(f"slots[int(number div {block_rows} - first)]").alias("slot"),
        (F.col("number") % block_rows).alias("place"),
    )


def mixture(docs: DataFrame, source: str = "source") -> DataFrame:
    """The rows of ``docs``, all columns, in the order of the mixture."""
    return mix(docs, source).orderBy("slot", "place").select("row.*")


def written_places(docs: DataFrame, columns: list[str]) -> tuple[DataFrame, DataFrame]:
    """``columns`` of ``docs``, read from Parquet files, with ``file, at``; and the files: ``file, before``.

    Sorted rows are written in order of the files' numbers, and in order within each file: a row's
    place among all is ``before + at``, however a reader splits the files. One task numbers the
    files, not the rows.
    """
    path = F.col("_metadata.file_path")
    file, at = F.xxhash64(path).alias("file"), F.col("_metadata.row_index").alias("at")
    number = F.regexp_extract(path, r"part-(\d+)[^/]*$", 1).try_cast("long").alias("number")
    files = docs.select(path.alias("path"), number, file, at).groupBy("number", "path", "file")
    files = files.agg((F.max("at") + 1).alias("n"))
    before = F.sum("n").over(Window.orderBy("number", "path")) - F.col("n")
    return docs.select(*columns, file, at), stored(files.select("file", before.alias("before")), "files")


def positions(docs: DataFrame) -> DataFrame:
    """``doc_id, source, slot, place`` per row."""
    return mix(docs.select("doc_id", "source")).select("row.doc_id", "row.source", "slot", "place")


#: The same rows in SQL, the schedule by recursion over its slots.
ORACLE = f"""
WITH RECURSIVE sizes AS (
  SELECT coalesce(source, '') AS src, count(*) AS n FROM documents GROUP BY 1
), shares AS (
  SELECT src, greatest(1, round({WHOLE} * sqrt(n) / (SELECT sum(sqrt(n)) FROM sizes)))::BIGINT AS p,
    ((n + {BLOCK_ROWS - 1}) // {BLOCK_ROWS})::BIGINT AS blocks
  FROM sizes
), listed AS (
  SELECT list(src ORDER BY src) AS srcs, list(p ORDER BY src) AS parts, list(blocks ORDER BY src) AS blocks,
    sum(p)::BIGINT AS period, sum(blocks)::BIGINT AS slots
  FROM shares
), run AS (
  SELECT -1::BIGINT AS t, list_transform(parts, lambda p: 1::BIGINT) AS nxt, 0::BIGINT AS i FROM listed
  UNION ALL
  SELECT t, list_transform(nxt, lambda j, k: CASE WHEN k = i THEN j + 1 ELSE j END), i
  FROM (
    SELECT run.t + 1 AS t, run.nxt, list_min(list_filter(list_transform(parts, lambda p, k:
      CASE WHEN nxt[k] <= blocks[k]
      THEN {{'early': ((nxt[k] - 1) * period) // p > run.t + 1, 'deadline': (nxt[k] * period + p - 1) // p, 'i': k::BIGINT}} END),
      lambda x: x IS NOT NULL)).i AS i
    FROM run, listed WHERE run.t + 1 < slots)
), slots AS (
  SELECT srcs[i] AS src, t, row_number() OVER (PARTITION BY i ORDER BY t) - 1 AS block FROM run, listed WHERE t >= 0
), numbered AS (
  SELECT doc_id, source, coalesce(source, '') AS src, row_number() OVER (
    PARTITION BY coalesce(source, '') ORDER BY md5('mix:' || coalesce(doc_id::VARCHAR, '')), doc_id) - 1 AS number
  FROM documents
)
SELECT doc_id, source, t AS slot, number % {BLOCK_ROWS} AS place
FROM numbered JOIN slots ON slots.src = numbered.src AND slots.block = number // {BLOCK_ROWS}
"""
