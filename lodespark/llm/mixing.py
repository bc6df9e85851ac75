"""Mixing sources to target weights by hash thresholds, in DataFrame operations only.

Every document draws a ticket, a 60-bit hash. A source gives its documents as often as its target
holds it whole, and those with a ticket below a threshold once more. The threshold is found
in histograms: sizes are summed by source and leading bits of the ticket, the bucket in
which the budget ends is split by the next bits, and so on until it holds a single ticket.
Nothing is sorted and no group is gathered; a histogram has at most 1024 buckets per source.

Defined cases: a null text has size 0; documents without source are one source, the last; rows with
equal id and text have equal tickets and are taken or left together, so that a source
which consists of few such rows may miss its target by some of them; a source without
words, and every source of an empty table, gets target 0. Other columns are carried along, but those
called like one that is added are replaced.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lodespark.llm.storage import ranked
from lodespark.staging import stage

BITS, STEP = 60, 10
WEIGHTS = (1, 2, 3)
MOST = 3
WORD = r"[^\x20\x09-\x0D]+"


def measured(docs: DataFrame) -> DataFrame:
    """Add ``size``, the number of words, and ``ticket``."""
    text = F.coalesce("text", F.lit(""))
    name = F.concat_ws(":", F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.md5(text))
    ticket = F.conv(F.substring(F.md5(name), 1, BITS // 4), 16, 10).cast("long")
    size = F.regexp_count(text, F.lit(WORD)).cast("long")
    return docs.withColumns({"size": size, "ticket": ticket})


def targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, most: int = MOST) -> DataFrame:
    """``source, source_size, target`` from ``source, source_size``, one row for each source.

    Sources in code-point order, null last, weigh ``weights`` in turn and share the sum of all
    sizes. What a source gets beyond ``most`` times its size goes to the others by weight,
    until none is above; each round sums the sources again.
    """
    numbered = ranked(
        sizes.withColumn("last", F.col("source").isNull()), ["last", "source"], "number"
    )
    turn = F.element_at(
        F.array(*map(F.lit, weights)), (F.col("number") % len(weights) + 1).cast("int")
    )
    weighed = stage(numbered.select("source", "source_size", turn.cast("long").alias("weight")))
    limit = F.col("source_size") * most
    rest, weight = weighed.agg(F.sum("source_size"), F.sum("weight")).first()
    total, capped = rest, 0
    while weight:
        share = F.col("weight") * F.lit(rest) / F.lit(weight)
        above = share >= limit
        row = weighed.agg(
            F.count_if(above).alias("n"),
            F.coalesce(F.sum(F.when(above, limit)), F.lit(0)).alias("given"),
            F.sum(F.when(~above, F.col("weight"))).alias("weight"),
        ).first()
        if row["n"] == capped or row["weight"] is None:
            break
        capped, rest, weight = row["n"], total - row["given"], row["weight"]
    share = F.col("weight") * F.lit(rest or 0) / F.lit(weight or 1)
    return weighed.select(
        "source", "source_size", F.least(share, limit.cast("double")).alias("target")
    )


def _in_bucket(done: int) -> Column:
    return F.shiftright("ticket", BITS - done)


def thresholds(rows: DataFrame, wanted: DataFrame) -> DataFrame:
    """Add to ``wanted`` the whole ``rounds`` of a source and the ``threshold`` of one more.

    ``rows`` has ``source, size, ticket``. The threshold ends where the sum of sizes below it is
    nearest to what the rounds leave of the target.
    """
    rounds = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size")))
    planned = wanted.withColumn("rounds", F.coalesce(rounds, F.lit(0)).cast("long"))
    planned = stage(
        planned.withColumn("budget", F.col("target") - F.col("rounds") * F.col("source_size"))
    )
    open_ = planned.select(
        "source", F.lit(0).cast("long").alias("bucket"), F.col("budget").alias("left")
    )
    found = []
    for done in range(STEP, BITS + 1, STEP):
        keys = open_.withColumnRenamed("source", "of")
        inside = rows.join(keys, rows["source"].eqNullSafe(keys["of"])).where(
            _in_bucket(done - STEP) == F.col("bucket")
        )
        histogram = inside.groupBy("source", _in_bucket(done).alias("part")).agg(
            F.first("left").alias("left"),
            F.sum("size").alias("size"),
            F.min("ticket").alias("low"),
            F.max("ticket").alias("high"),
        )
        before = Window.partitionBy("source").orderBy("part")
        ended = stage(
            histogram.withColumn("end", F.sum("size").over(before))
            .where("end > left and end - size <= left")
            .withColumn("nearer", F.col("end") - F.col("left") < F.col("left") - F.col("end") + F.col("size"))
        )
        found.append(
            ended.where("low = high").select(
                F.col("source").alias("of"),
                (F.col("low") + F.col("nearer").cast("long")).alias("threshold"),
            )
        )
        open_ = ended.where("low < high").select(
            "source",
            F.col("part").alias("bucket"),
            (F.col("left") - F.col("end") + F.col("size")).alias("left"),
        )
        if open_.isEmpty():
            break
    ends = reduce(DataFrame.unionByName, found)
    return planned.join(ends, planned["source"].eqNullSafe(ends["of"]), "left").select(
        "source",
        "source_size",
        "target",
        "rounds",
        F.coalesce("threshold", F.lit(0).cast("long")).alias("threshold"),
    )


def plan(rows: DataFrame) -> DataFrame:
    """Size, target, rounds and threshold of each source; ``rows`` has source, size, ticket."""
    sizes = rows.groupBy("source").agg(F.sum("size").alias("source_size"))
    return stage(thresholds(rows.select("source", "size", "ticket"), targets(sizes)))


def taken(rows: DataFrame, planned: DataFrame) -> DataFrame:
    """Add ``source_size, target, copies, taken``: how often, and how many words, the mix takes."""
    keys = planned.withColumnRenamed("source", "_source")
    rows = rows.drop("source_size", "target", "rounds", "threshold", "_source")
    copies = F.col("rounds") + (F.col("ticket") < F.col("threshold")).cast("long")
    return (
        rows.join(keys, rows["source"].eqNullSafe(keys["_source"]))
        .withColumn("copies", copies)
        .withColumn("taken", F.col("copies") * F.col("size"))
        .drop("_source", "rounds", "threshold", "ticket")
    )


# The same in SQL, with a sort by ticket where the histograms above search.
SQL = r"""
WITH rows AS (
  SELECT doc_id, source,
    len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::BIGINT AS size,
    ('0x' || substr(md5(coalesce(doc_id::VARCHAR, '') || ':' || md5(coalesce(text, ''))), 1, 15))
      ::BIGINT AS ticket
  FROM documents),
sizes AS (SELECT source, sum(size)::BIGINT AS source_size FROM rows GROUP BY source),
weighed AS (
  SELECT *, 1 + (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 AS weight FROM sizes),
ordered AS (
  SELECT *, sum(source_size) OVER () AS total, sum(weight) OVER () AS weights,
    row_number() OVER by_limit AS n,
    sum(3 * source_size) OVER by_limit - 3 * source_size AS given,
    sum(weight) OVER by_limit - weight AS spent
  FROM weighed
  WINDOW by_limit AS (ORDER BY source_size / weight, source NULLS LAST
                      ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)),
uncapped AS (
  SELECT total - given AS rest, weights - spent AS weight FROM ordered
  WHERE 3.0 * source_size * (weights - spent) >= weight * (total - given) ORDER BY n LIMIT 1),
wanted AS (
  SELECT source, source_size,
    least((w.weight * u.rest)::DOUBLE / u.weight, 3.0 * source_size)::DOUBLE AS target
  FROM weighed w, uncapped u),
planned AS (
  SELECT *, CASE WHEN source_size > 0 THEN floor(target / source_size) ELSE 0 END::BIGINT AS rounds
  FROM wanted),
tickets AS (
  SELECT source, ticket, sum(size) AS part,
    sum(sum(size)) OVER (PARTITION BY source ORDER BY ticket) AS ending
  FROM rows GROUP BY source, ticket)
SELECT r.doc_id, r.size, p.source_size, p.target,
  (r.size * (p.rounds + CASE
    WHEN t.ending <= p.target - p.rounds * p.source_size THEN 1
    WHEN t.ending - t.part <= p.target - p.rounds * p.source_size
      AND t.ending - (p.target - p.rounds * p.source_size)
        < (p.target - p.rounds * p.source_size) - t.ending + t.part THEN 1
    ELSE 0 END))::BIGINT AS taken
FROM rows r
JOIN planned p ON r.source IS NOT DISTINCT FROM p.source
JOIN tickets t ON r.source IS NOT DISTINCT FROM t.source AND r.ticket = t.ticket
"""
