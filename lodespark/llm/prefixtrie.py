"""Trie of the turn sequences of conversations that share heads, by composed fingerprints.

A conversation is rebuilt: the first turns of the base conversation of its block, then its own from
there on. The rebuilt turns are never written. The fingerprint of a sequence is a product of one
element a turn, ``(n, a) * (m, b) = (n + m, a * R ** m + b)`` for two multipliers ``R`` modulo a prime; it
is associative and has inverses, so the product of a rebuilt beginning follows from the products of
the stored ones: that of the base head, times the inverse of the own head, times the own beginning.

A node is a fingerprint and a depth; its members are the rebuilt conversations with it. Elements are the
references of stored turns, 120 bits of a digest, and it is checked on the stored texts that a
reference has one role and text. A group is verified through them: all members have the same last reference and
the same group before, so by induction the same turns. If a check fails, all is done again with another seed, so that
the result is exact.

A node belongs to its smallest member, which then has all deeper nodes of its own. So a sum over a
subtree is a sum over the members of the node of what they have from there on, a running sum along
each conversation, and no walk of the tree is needed.

Defined cases: rows without ``conv_id`` belong to no conversation; null roles and texts are empty; a null
turn comes first, equal turns go by the first 200 characters of role and text, then by digest; equal
rows are as many turns; an empty table has no nodes, not even a root. Other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lodespark.llm.lookup import looked_up
from lodespark.llm.scans import STATE, State, scan
from lodespark.llm.storage import partitions
from lodespark.staging import stage

BLOCK, HEAD = 20, 4
PRIME = (1 << 61) - 1
# Longest head: the turns of it are found in one row per conversation.
LONGEST = HEAD - 1
# Turns of a conversation that meet its plan in one join key.
SPLIT = 4096
# Characters of ids that are hashed together.
CHUNK = 1 << 16
WORD = r"[^\x20\x09-\x0D]+"
NODE = ["depth", "a", "b"]


def _multipliers(seed: int) -> tuple[int, int]:
    digest = hashlib.sha256(f"multipliers {seed}".encode()).digest()
    return tuple(2 + int.from_bytes(digest[n : n + 16]) % (PRIME - 3) for n in (0, 16))


def stored_turns(conversations: DataFrame, seed: int) -> DataFrame:
    """``conv_id, turn, role, text, e, f, words, one`` with the reference (e, f) of each turn."""
    rows = conversations.where("conv_id is not null").select(
        F.col("conv_id").cast("long").alias("conv_id"),
        F.col("turn").cast("long").alias("turn"),
        *(F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in ("role", "text")),
    )
    told = F.concat(F.lit(f"{seed}:"), F.char_length("role"), F.lit(":"), "role", "text")
    rows = rows.withColumn("digest", F.sha2(told, 256))

    def part(first: int) -> Column:
        return (F.conv(F.substring("digest", first, 15), 16, 10).cast("long") + 1).alias("e" if first == 1 else "f")

    return rows.select(
        *("conv_id", "turn", "role", "text", "digest", part(1), part(16)),
        F.regexp_count("text", F.lit(WORD)).cast("long").alias("words"),
        F.lit(1).cast("long").alias("one"),
    )


def one_text_each(turns: DataFrame) -> bool:
    """Whether every reference stands for one role and text."""
    texts = turns.select("e", "f", "role", "text").distinct()
    return texts.groupBy("e", "f").count().where("count > 1").isEmpty()


def _product(seed: int):
    one, two = _multipliers(seed)

    def product(left: State, right: State) -> State:
        size = right[0]
        return (
            left[0] + size,
            (left[1] * (one if size == 1 else pow(one, size, PRIME)) + right[1]) % PRIME,
            (left[2] * (two if size == 1 else pow(two, size, PRIME)) + right[2]) % PRIME,
        )

    return product


def plans(beginnings: DataFrame) -> DataFrame:
    """How each conversation is rebuilt: ``conv_id, n, base, h, head, total, da, db``.

    ``beginnings`` has (conv_id, position, a, b). ``head`` turns of ``base`` come first, then the own
    behind position ``h``. ``(da, db)`` is by how much the product of the head differs from that of
    the own turns it replaces.
    """
    nth = [
        F.max(F.when(F.col("position") == n, F.col(c))).alias(f"{c}{n}") for n in range(1, HEAD) for c in ("a", "b")
    ]
    convs = stage(beginnings.groupBy("conv_id").agg(F.max("position").alias("n"), *nth))
    h = F.crc32(F.col("conv_id").cast("string")) % HEAD
    own = convs.withColumns({"h": h, "base": F.col("conv_id") - F.col("conv_id") % BLOCK})
    bases = convs.select(
        F.col("conv_id").alias("base"), F.col("n").alias("base_n"),
        *(F.col(f"{c}{n}").alias(f"base_{c}{n}") for n in range(1, HEAD) for c in "ab"),
    )
    # A base has a conversation for each id of its block at most.
    both = own.join(bases, "base", "left").withColumn("head", F.least("h", F.coalesce("base_n", F.lit(0)).cast("long")))

    def at(place: str, prefix: str, name: str) -> Column:
        found = F.lit(0).cast("long")
        for n in range(1, HEAD):
            found = F.when(F.col(place) == n, F.col(f"{prefix}{name}{n}")).otherwise(found)
        return F.coalesce(found, F.lit(0))  # of a conversation that ends before, none is asked for

    return both.select(
        *("conv_id", "n", "base", "h", "head"),
        (F.col("head") + F.greatest(F.col("n") - F.col("h"), F.lit(0))).alias("total"),
        *(F.pmod(at("head", "base_", c) - at("h", "", c), F.lit(PRIME)).alias(f"d{c}") for c in "ab"),
    )


def paths(turns: DataFrame, plan: DataFrame, seed: int) -> DataFrame:
    """A row for each beginning of each rebuilt conversation.

    ``conv_id, depth, a, b, pa, pb, e, f, words, last``: the fingerprint of the beginning, that without its
    last turn, the reference of that turn, and whether nothing follows. ``turns`` has (conv_id, position, a, b, e, f, words).
    """
    heads = (
        turns.where(F.col("position") <= LONGEST)
        .withColumnRenamed("conv_id", "base")
        .join(plan.select("conv_id", "base", "head", "total"), "base")
        .where("position <= head")
        .select(
            *("conv_id", F.col("position").alias("depth"), "total", "a", "b", "e", "f", "words"),
            *(F.lit(0).cast("long").alias(c) for c in ("da", "db", "further")),
        )
    )
    # The turns of a long conversation meet its plan under many keys.
    split = F.floor(F.col("position") / SPLIT)
    places = plan.withColumn("split", F.explode(F.sequence(F.lit(0).cast("long"), F.floor(F.col("n") / SPLIT))))
    rest = (
        turns.withColumn("split", split)
        .join(places, ["conv_id", "split"])
        .where("position > h")
        .select(
            *("conv_id", (F.col("head") + F.col("position") - F.col("h")).alias("depth"), "total"),
            *("a", "b", "e", "f", "words", "da", "db", (F.col("position") - F.col("h")).alias("further")),
        )
    )
    one, two = _multipliers(seed)
    back = pow(one, -1, PRIME), pow(two, -1, PRIME)

    def composed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = []
            columns = (batch[c].to_pylist() for c in ("a", "b", "da", "db", "further", "e", "f"))
            for a, b, da, db, further, e, f in zip(*columns):
                if da:
                    a = (a + da * pow(one, further, PRIME)) % PRIME
                if db:
                    b = (b + db * pow(two, further, PRIME)) % PRIME
                found.append((a, b, (a - e) * back[0] % PRIME, (b - f) * back[1] % PRIME))
            arrays = [pa.array(c, pa.int64()) for c in zip(*found)] or [pa.array([], pa.int64())] * 4
            kept = ("conv_id", "depth", "e", "f", "words", "last")
            yield pa.RecordBatch.from_arrays([*arrays, *(batch[c] for c in kept)], names=["a", "b", "pa", "pb", *kept])

    rows = heads.unionByName(rest).withColumn("last", F.col("depth") == F.col("total"))
    told = rows.mapInArrow(
        composed,
        "a long, b long, pa long, pb long, conv_id long, depth long, e long, f long, words long, last boolean",
    )
    zero, none = F.lit(0).cast("long"), F.lit(None).cast("long")
    roots = plan.select(
        *("conv_id", *(zero.alias(c) for c in ("depth", "a", "b", "words"))),
        *(none.alias(c) for c in ("pa", "pb", "e", "f")),
        (F.col("total") == 0).alias("last"),
    )
    return told.unionByName(roots)


def groups(path: DataFrame) -> DataFrame:
    """The members of each node: smallest, number, and bounds of what all must have alike."""
    alike = [f(c).alias(f"{n}_{c}") for c in ("e", "f", "pa", "pb") for n, f in (("least", F.min), ("most", F.max))]
    return path.groupBy(*NODE).agg(
        F.min("conv_id").alias("conv_id"), F.count("*").alias("n_convs"), F.max("words").alias("words"), *alike
    )


def _verified(nodes: DataFrame) -> bool:
    differs = " or ".join(f"least_{c} != most_{c}" for c in ("e", "f", "pa", "pb"))
    return nodes.where(differs).isEmpty()


def ends(path: DataFrame) -> DataFrame:
    """``depth, a, b, ends_sha256`` of the nodes at which conversations end.

    Ids are put in order and joined to pieces by all tasks. Only these pieces stream through the task of their
    node, as the digest is sequential by definition.
    """

    def pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        node, ids, size = None, [], 0

        def piece() -> pa.RecordBatch:
            kinds = (pa.int64(),) * 4 + (pa.string(),)
            values = (*node, ids[0], ",".join(map(str, ids)))
            arrays = [pa.array([v], k) for v, k in zip(values, kinds)]
            return pa.RecordBatch.from_arrays(arrays, names=[*NODE, "first", "ids"])

        for batch in batches:
            for *own, conv in zip(*(batch[c].to_pylist() for c in (*NODE, "conv_id"))):
                if ids and (own != node or size >= CHUNK):
                    yield piece()
                    ids, size = [], 0
                node = own
                ids.append(conv)
                size += len(str(conv)) + 1
        if ids:
            yield piece()

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        node, digest = None, None
        for batch in batches:
            done = []
            for *own, ids in zip(*(batch[c].to_pylist() for c in (*NODE, "ids"))):
                if own == node:
                    digest.update(b",")
                else:
                    if node is not None:
                        done.append((*node, digest.hexdigest()))
                    node, digest = own, hashlib.sha256()
                digest.update(ids.encode())
            yield told(done)
        if node is not None:
            yield told([(*node, digest.hexdigest())])

    def told(rows: list[tuple]) -> pa.RecordBatch:
        names = [*NODE, "ends_sha256"]
        schema = pa.schema([*((n, pa.int64()) for n in NODE), ("ends_sha256", pa.string())])
        return pa.RecordBatch.from_pylist([dict(zip(names, r)) for r in rows], schema)

    last = path.where("last").select(*NODE, "conv_id")
    order = [*NODE, "conv_id"]
    cut = last.repartitionByRange(partitions(path), *order).sortWithinPartitions(*order)
    joined = cut.mapInArrow(pieces, "depth long, a long, b long, first long, ids string")
    return (
        joined.repartition(partitions(path), *NODE)
        .sortWithinPartitions(*NODE, "first")
        .mapInArrow(hashed, "depth long, a long, b long, ends_sha256 string")
    )


def subtree_sums(path: DataFrame, nodes: DataFrame) -> DataFrame:
    """``depth, a, b, n_leaves, saved_tokens`` of the nodes with several members."""
    shared = nodes.where("n_convs > 1")
    owner = shared.select(*NODE, F.col("conv_id").alias("owner"), "n_convs", "n_children")
    members = looked_up(path.select(*NODE, "conv_id", "words", "last"), owner, NODE, "n_convs")
    owned = F.col("owner") == F.col("conv_id")
    zero, one = F.lit(0).cast("long"), F.lit(1).cast("long")
    rows = members.select(
        *("conv_id", *NODE),
        F.when(owned, (F.col("n_convs") - 1) * F.col("words")).otherwise(zero).alias("saved"),
        F.when(owned & F.col("last") & (F.col("n_children") == 0), one).otherwise(zero).alias("leaf"),
    )
    alone = nodes.where("n_convs = 1 and n_children = 0").select(
        "conv_id", *NODE, zero.alias("saved"), one.alias("leaf")
    )
    told = stage(rows.unionByName(alone).withColumn("none", zero))
    sums = scan(
        told,
        "conv_id",
        [F.col("conv_id"), F.desc("depth")],
        ("none", "saved", "leaf"),
        (0, 0, 0),
        lambda left, right: (0, left[1] + right[1], left[2] + right[2]),
    )
    found = sums.rows(*NODE).groupBy(*NODE)
    return found.agg(F.sum("_z").alias("n_leaves"), F.sum("_y").alias("saved_tokens"))


def trie(conversations: DataFrame) -> DataFrame:
    """``conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256`` of
    each node, and ``turn_conv_id, turn_position``: a stored turn that equals its last one."""
    seed = 0
    while True:
        turns = stored_turns(conversations, seed)
        order = [
            F.col("conv_id"), F.asc_nulls_first("turn"), F.substring("role", 1, 200), F.substring("text", 1, 200), F.col("digest")
        ]
        stored = scan(turns, "conv_id", order, ("one", "e", "f"), (0, 0, 0), _product(seed))
        found = stored.rows("e", "f", "words").select(
            *("conv_id", "e", "f", "words"), *(F.col(s).alias(n) for s, n in zip(STATE, ("position", "a", "b")))
        )
        found = stage(found)
        plan = stage(plans(found))
        path = stage(paths(found, plan, seed))
        nodes = stage(groups(path))
        if _verified(nodes) and one_text_each(stored.local.where("not _tail")):
            break
        seed += 1
    children = (
        nodes.where("depth > 0")
        .groupBy((F.col("depth") - 1).alias("depth"), F.col("least_pa").alias("a"), F.col("least_pb").alias("b"))
        .agg(F.count("*").alias("n_children"))
    )
    nodes = stage(
        nodes.join(children, NODE, "left")
        .select(
            *(*NODE, "conv_id", "n_convs", "words", F.coalesce("n_children", F.lit(0)).alias("n_children")),
            *(F.col(f"least_{c}").alias(c) for c in ("pa", "pb")),
        )
    )
    up = ["up", "pa", "pb"]
    parents = nodes.where("n_children > 0").select(
        F.col("depth").alias("up"), F.col("a").alias("pa"), F.col("b").alias("pb"),
        F.col("conv_id").alias("parent_conv_id"), F.col("n_children").alias("siblings"),
    )
    below = nodes.where("depth > 0").withColumn("up", F.col("depth") - 1)
    linked = looked_up(below, parents, up, "siblings").drop("up", "siblings")
    root = nodes.where("depth = 0").withColumn("parent_conv_id", F.lit(None).cast("long"))
    facts = subtree_sums(path, nodes).join(ends(path), NODE, "full")
    # The last turn of a node is that of its smallest member, stored with it or with its base.
    place = plan.select("conv_id", "base", "head", "h")
    in_head = F.col("depth") <= F.col("head")
    return (
        linked.unionByName(root)
        .join(facts, NODE, "left")
        .join(place, "conv_id")
        .select(
            *("conv_id", "depth", "parent_conv_id", "n_convs", "n_children"),
            F.coalesce("n_leaves", F.lit(1)).alias("n_leaves"),
            F.coalesce("saved_tokens", F.lit(0)).alias("saved_tokens"),
            F.coalesce("ends_sha256", F.sha2(F.lit(""), 256)).alias("ends_sha256"),
            F.when(F.col("depth") > 0, F.when(in_head, F.col("base")).otherwise(F.col("conv_id"))).alias("turn_conv_id"),
            F.when(
                F.col("depth") > 0,
                F.when(in_head, F.col("depth")).otherwise(F.col("depth") - F.col("head") + F.col("h")),
            ).alias("turn_position"),
        )
    )


# The same in SQL, with beginnings by a chain of digests.
SQL = r"""
WITH own AS (
  SELECT conv_id, coalesce(role, '') AS role, coalesce(text, '') AS text,
    row_number() OVER (PARTITION BY conv_id
      ORDER BY turn NULLS FIRST, coalesce(role, ''), coalesce(text, '')) AS pos
  FROM conversations WHERE conv_id IS NOT NULL),
named AS (SELECT conv_id, CAST(conv_id AS VARCHAR) AS s FROM own GROUP BY conv_id),
plans AS (
  SELECT conv_id, conv_id - conv_id % 20 AS base,
    xor(list_reduce(list_concat([4294967295::BIGINT], range(8 * length(s))), lambda c, i: xor(
      CASE WHEN i % 8 = 0 THEN xor(c, ascii(s[i // 8 + 1])::BIGINT) ELSE c END >> 1,
      3988292384 * (CASE WHEN i % 8 = 0 THEN xor(c, ascii(s[i // 8 + 1])::BIGINT) ELSE c END & 1))),
      4294967295::BIGINT) % 4 AS h
  FROM named),
heads AS (
  SELECT p.conv_id, o.pos AS depth, o.role, o.text
  FROM plans p JOIN own o ON o.conv_id = p.base AND o.pos <= p.h),
sizes AS (SELECT conv_id, count(*) AS head FROM heads GROUP BY conv_id),
rebuilt AS (
  SELECT * FROM heads
  UNION ALL SELECT o.conv_id, coalesce(head, 0) + pos - h, role, text
  FROM own o JOIN plans USING (conv_id) LEFT JOIN sizes USING (conv_id) WHERE pos > h),
paths AS (
  SELECT conv_id, depth, sha256(string_agg(sha256(length(role) || ':' || role || text), '')
      OVER (PARTITION BY conv_id ORDER BY depth)) AS node,
    len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')) AS words FROM rebuilt
  UNION ALL SELECT conv_id, 0, '', 0 FROM plans),
placed AS (
  SELECT *, lag(node) OVER (PARTITION BY conv_id ORDER BY depth) AS up,
    lead(node) OVER (PARTITION BY conv_id ORDER BY depth) IS NULL AS last FROM paths),
nodes AS (
  SELECT node, min(conv_id) AS conv_id, first(depth) AS depth, first(up) AS up, first(words) AS words,
    count(*) AS n_convs FROM placed GROUP BY node),
children AS (SELECT up AS node, count(*) AS n_children FROM nodes GROUP BY up),
below AS (
  SELECT p.node, sum((v.n_convs - 1) * v.words) AS saved, count(*) FILTER (c.n_children IS NULL) AS leaves
  FROM nodes v LEFT JOIN children c ON v.node = c.node
  JOIN placed p ON p.conv_id = v.conv_id AND p.depth <= v.depth GROUP BY p.node),
ends AS (
  SELECT node, sha256(string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id)) AS ends
  FROM placed WHERE last GROUP BY node)
SELECT n.conv_id, n.depth::BIGINT AS depth, u.conv_id AS parent_conv_id, n.n_convs,
  coalesce(n_children, 0)::BIGINT AS n_children, leaves::BIGINT AS n_leaves, saved::BIGINT AS saved_tokens,
  coalesce(ends, sha256('')) AS ends_sha256
FROM nodes n LEFT JOIN nodes u ON n.up = u.node LEFT JOIN children c ON n.node = c.node
  LEFT JOIN below b ON n.node = b.node LEFT JOIN ends e ON n.node = e.node
"""
