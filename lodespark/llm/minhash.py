"""Near-duplicate documents: MinHash bands, signature and set verification, components.

Texts with equal sets of shingles form a class, and one of them stands for it. Candidates share
a band of minima. Instead of listing the pairs of a band, each class is first compared with one
centre among its bands, then classes are only compared with those of another component.

Defined cases: documents without words (null, empty or white space) have no shingles and are linked with
nothing; a text of fewer words than a shingle has one, its whole sequence; rows with a null id
are linked with nothing; rows that repeat an id are linked by it, whatever their texts, and so are all
that each of them is linked with. Other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lodespark.llm.components import connected_components
from lodespark.llm.lookup import looked_up
from lodespark.llm.storage import partitions
from lodespark.llm.words import WordIds, groups, spaced, tidied
from lodespark.staging import spread, stage

# A pair of similarity 0.8 shares no band with probability (1 - 0.8 ** 6) ** 40 = 5e-6.
ROWS_PER_BAND = 6
BANDS = 40
SEED = 11
WORDS = -(-BANDS * ROWS_PER_BAND // 32)  # of a signature
# A signature has two bits of each minimum. At a similarity of 0.8 a pair of bits is equal with
# probability 0.85, so that 36 of 240 differ, with a deviation of 5.5; pairs of classes beyond are
# not verified on their sets.
MOST_DIFFERENT = 61
# Rounds in which each class is compared with one other of its bands before all others are.
STAR_ROUNDS = 1
# Classes of a band whose pairs are joined; those of a larger band are compared in blocks of two
# chunks of about so many classes.
LARGE_BAND, CHUNK = 64, 512
# Members that are compared with one copy of a hot class.
SALT = 500
# Texts that are broadcast, in 16 bytes each, to pick texts without a shuffle; more are joined.
SENT_IDS = 1_000_000
# A class, and the text that stands for it.
TEXT_OF = ("node", "code", "doc_id", "text_key")


def _odd(rng: np.random.Generator, size) -> np.ndarray:
    return rng.integers(0, 2**64, size, np.uint64, endpoint=False) | np.uint64(1)


def shingle_sets(texts: list[bytes], width: int, ids: WordIds) -> list[np.ndarray]:
    """Sorted distinct 64-bit codes of the runs of ``width`` words of each text."""
    ids.trim()
    words = [spaced(text) for text in texts]
    codes = ids.codes([w for some in words for w in some])
    factors = _odd(np.random.default_rng(SEED), 64 if width <= 64 else width)
    found, at = [], 0
    for some in words:
        own = codes[at : at + len(some)]
        at += len(some)
        if not len(own):
            found.append(own)
            continue
        span = min(width, len(own))
        runs = np.zeros(len(own) - span + 1, np.uint64)
        for n in range(span):
            runs = (runs ^ (runs >> np.uint64(29))) * factors[0] + own[n : n + len(runs)]
        runs += np.uint64(span)  # a whole short text differs from a longer one's shingle
        found.append(np.unique(runs))
    return found


class Signer:
    """Minima of many functions ``a * x + b`` modulo 2 ** 64 over sets of codes."""

    def __init__(self):
        rng = np.random.default_rng(SEED + 1)
        size = BANDS * ROWS_PER_BAND
        self.a, self.b = _odd(rng, size), _odd(rng, size)
        self.mix, self.row = _odd(rng, ROWS_PER_BAND), _odd(rng, BANDS)

    def minima(self, sets: list[np.ndarray]) -> np.ndarray:
        """One row for each set, none of which is empty, and one column for each function."""
        out = np.empty((len(sets), len(self.a)), np.uint64)
        low = 0
        while low < len(sets):
            high, size = low, 0
            while high < len(sets) and (high == low or size + len(sets[high]) <= 1 << 15):
                size += len(sets[high])
                high += 1
            codes = np.concatenate(sets[low:high])
            starts = np.cumsum([0, *map(len, sets[low : high - 1])])
            hashed = np.empty_like(codes)
            for n, (a, b) in enumerate(zip(self.a, self.b)):
                np.multiply(codes, a, out=hashed)
                hashed += b
                out[low:high, n] = np.minimum.reduceat(hashed, starts)
            low = high
        return out

    def bands(self, minima: np.ndarray) -> np.ndarray:
        parts = minima.reshape(len(minima), BANDS, ROWS_PER_BAND)
        keys = ((parts ^ (parts >> np.uint64(31))) * self.mix).sum(axis=2, dtype=np.uint64)
        return ((keys ^ (keys >> np.uint64(30))) * self.row).view(np.int64)

    def signature(self, minima: np.ndarray) -> np.ndarray:
        """Two bits of each minimum, those of 32 in a 64-bit number."""
        bits = (minima * self.a[0]) >> np.uint64(62)
        padded = np.zeros((len(bits), WORDS * 32), np.uint64)
        padded[:, : bits.shape[1]] = bits << (np.arange(bits.shape[1], dtype=np.uint64) % 32 * 2)
        return np.bitwise_or.reduce(padded.reshape(len(bits), WORDS, 32), axis=2).view(np.int64)


def _binary(values: list[bytes]) -> pa.Array:
    return pa.array(values, pa.binary())


def keyed(docs: DataFrame) -> DataFrame:
    return docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("text_key"), "text"
    )


def sketches(docs: DataFrame, width: int) -> DataFrame:
    """``doc_id, text_key, n_shingles, code, bands, signature``; the last three null for an empty set.

    ``code`` stands for the whole set: equal for texts with equal sets. ``text_key`` is a hash of the text.
    """

    @tidied
    def sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, signer = WordIds(), Signer()
        for batch in batches:
            for first, texts in groups(batch):
                sets = shingle_sets(texts, width, ids)
                full = [s for s in sets if len(s)]
                minima = signer.minima(full)
                bands = signer.bands(minima)
                signatures = signer.signature(minima)
                place = iter(range(len(full)))
                rows = [next(place) if len(s) else None for s in sets]
                yield pa.RecordBatch.from_pydict(
                    {
                        "doc_id": batch["doc_id"].slice(first, len(texts)),
                        "text_key": batch["text_key"].slice(first, len(texts)),
                        "n_shingles": pa.array([len(s) for s in sets], pa.int64()),
                        "code": _binary(
                            [xxhash.xxh3_128_digest(s.tobytes()) if len(s) else None for s in sets]
                        ),
                        "bands": pa.array(
                            [None if r is None else bands[r] for r in rows], pa.list_(pa.int64())
                        ),
                        "signature": pa.array(
                            [None if r is None else signatures[r] for r in rows],
                            pa.list_(pa.int64()),
                        ),
                    }
                )

    rows = spread(keyed(docs))
    return rows.mapInArrow(
        sketch,
        "doc_id long, text_key long, n_shingles long, code binary, bands array<long>, signature array<long>",
    )


def _alike(left: str, right: str, percent: int) -> Column:
    """Whether the signatures and set sizes of two classes leave it open that they are linked."""
    different = F.lit(0)
    for n in range(WORDS):
        both = F.get(f"{left}.signature", F.lit(n)).bitwiseXOR(F.get(f"{right}.signature", F.lit(n)))
        pairs = both.bitwiseOR(F.shiftrightunsigned(both, 1)).bitwiseAND(F.lit(0x5555555555555555))
        different = different + F.bit_count(pairs)
    small, large = (f(f"{left}.n_shingles", f"{right}.n_shingles") for f in (F.least, F.greatest))
    return (different <= MOST_DIFFERENT) & (small * 100 >= large * percent)


def _sets(texts: DataFrame, nodes: DataFrame, wanted: DataFrame, width: int) -> DataFrame:
    """``(node, codes)``: the shingles of the wanted classes.

    ``nodes`` (node, code, doc_id, text_key) says which of the texts (doc_id, text_key, text) stands for a class.
    """

    @tidied
    def encoded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids = WordIds()
        for batch in batches:
            for first, group in groups(batch):
                sets = [s.tobytes() for s in shingle_sets(group, width, ids)]
                codes = batch["code"].slice(first, len(group)).to_pylist()
                own = [xxhash.xxh3_128_digest(s) == c for s, c in zip(sets, codes)]
                yield pa.RecordBatch.from_pydict(
                    {"node": batch["node"].slice(first, len(group)), "codes": _binary(sets)}
                ).filter(pa.array(own))

    return (
        texts.join(nodes.join(wanted, "node", "left_semi"), ["doc_id", "text_key"])
        .select("node", "text", "code")
        .mapInArrow(encoded, "node long, codes binary")
    )


def _linked(left: np.ndarray, right: np.ndarray, percent: int) -> bool:
    """Whether two sets share enough of their union."""
    at = np.searchsorted(left, right)
    at[at == len(left)] = 0
    shared = int((left[at] == right).sum())
    return 100 * shared >= percent * (len(left) + len(right) - shared)


def _edges(found: list[tuple[int, int]]) -> pa.RecordBatch:
    left, right = zip(*found) if found else ((), ())
    return pa.RecordBatch.from_pydict(
        {"a": pa.array(left, pa.int64()), "b": pa.array(right, pa.int64())}
    )


def verified(
    pairs: DataFrame, nodes: DataFrame, texts: DataFrame, width: int, percent: int
) -> DataFrame:
    """Pairs (a, b) with 100 * shared >= percent * united shingles, compared on whole sets.

    The set of ``a`` meets those of its partners in sorted order within a partition; a class with
    many partners is copied to several partitions.
    """

    @tidied
    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, own = None, np.empty(0, np.uint64)
        for batch in batches:
            found = []
            for a, b, codes in zip(*(batch[c].to_pylist() for c in ("a", "b", "codes"))):
                other = np.frombuffer(codes, np.uint64)
                if b is None:
                    key, own = a, other
                    continue
                if key != a:
                    raise ValueError(f"the set of document {a} is missing")
                if _linked(own, other, percent):
                    found.append((a, b))
            yield _edges(found)

    counts = stage(
        pairs.groupBy("a").agg(F.ceil(F.count("*") / SALT).cast("int").alias("copies"))
    )
    salted = pairs.join(counts, "a").withColumn(
        "salt", F.pmod(F.xxhash64("b"), F.col("copies")).cast("int")
    )
    wanted = pairs.select(F.col("a").alias("node")).union(pairs.select("b")).distinct()
    sets = _sets(texts, nodes, wanted, width)
    own = (
        sets.join(counts, F.col("node") == F.col("a"))
        .withColumn("salt", F.explode(F.sequence(F.lit(0), F.col("copies") - 1)))
        .select("a", "salt", F.lit(None).cast("long").alias("b"), "codes")
    )
    members = sets.join(salted, F.col("node") == F.col("b")).select("a", "salt", "b", "codes")
    return (
        own.unionByName(members)
        .repartition(partitions(texts), "a", "salt")
        .sortWithinPartitions("a", "salt", F.col("b").asc_nulls_first())
        .mapInArrow(compare, "a long, b long")
        .distinct()
    )


def _star_pairs(members: DataFrame, sharing: DataFrame, turn: int, percent: int) -> DataFrame:
    """At most one pair for each class: with a class of another component in one of its bands.

    The centre of a band is first the class that shares its bands with the most others, as the
    original of a family of edited copies does, then one by an order that changes with the turn.
    """
    order = F.xxhash64(F.col("node"), F.lit(turn)) if turn else F.col("degree")
    ranked = members.withColumn("order", order)
    centres = ranked.groupBy("band").agg(
        F.max(F.struct("order", "node", "component")).alias("centre"), F.count("*").alias("size")
    )
    pairs = (
        looked_up(members, centres, ["band"], "size")
        .where("component != centre.component")
        .groupBy("node")
        .agg(F.max(F.struct("centre.order", "centre.node")).alias("centre"))
        .select(F.col("centre.node").alias("a"), F.col("node").alias("b"))
    )
    classes = sharing.select("node", "n_shingles", "signature").alias
    return (
        pairs.join(classes("x"), F.col("a") == F.col("x.node"))
        .join(classes("y"), F.col("b") == F.col("y.node"))
        .where(_alike("x", "y", percent))
        .select("a", "b")
    )


def _cross_pairs(members: DataFrame, sharing: DataFrame, percent: int) -> DataFrame:
    """Likely pairs of classes that share a small band and lie in different components.

    A pair is taken in the first band that it shares.
    """
    dealt = members.join(
        sharing.select("node", "n_shingles", "signature", "bands"), "node"
    ).withColumn("number", F.array_position("bands", F.col("band")))
    equal = F.zip_with("x.bands", "y.bands", lambda p, q: p == q)
    first = F.array_position(equal, True) == F.col("x.number")
    other = F.expr("x.band = y.band and x.component != y.component and x.node < y.node")
    joined = dealt.alias("x").join(dealt.alias("y"), [other, _alike("x", "y", percent), first])
    return joined.select(F.col("x.node").alias("a"), F.col("y.node").alias("b"))


def _block_pairs(
    members: DataFrame, sharing: DataFrame, texts: DataFrame, width: int, percent: int
) -> DataFrame:
    """Likely pairs of classes that share a large band and lie in different components.

    ``members`` has ``size``, the number of classes of the band. A band is dealt into chunks, and each
    two of them form a block, whose classes meet in a task. There their sets are compared as 32-bit
    codes, of which so few coincide that they move a similarity by less than a per cent: hardly a
    pair leaves the task that is not a link, and of two components only one sure link does.
    """

    @tidied
    def shortened(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            codes = [np.frombuffer(c, np.uint64) >> np.uint64(32) for c in batch["codes"].to_pylist()]
            short = [np.unique(c.astype(np.uint32)).tobytes() for c in codes]
            yield pa.RecordBatch.from_pydict({"node": batch["node"], "codes": _binary(short)})

    @tidied
    def blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, rows = None, []
        for batch in batches:
            for row in batch.to_pylist():
                if (place := (row["band"], row["low"], row["high"])) != key:
                    yield _edges(likely(key, rows))
                    key, rows = place, []
                rows.append(row)
        yield _edges(likely(key, rows))

    def likely(key: tuple | None, rows: list[dict]) -> list[tuple[int, int]]:
        left, right = ([r for r in rows if r["chunk"] == c] for c in (key or (0, 0, 0))[1:])
        if not left or not right:
            return []
        names = ("node", "component", "n_shingles", "signature")
        x, y = ({n: np.array([r[n] for r in side]) for n in names} for side in (left, right))
        pairs = x["component"][:, None] != y["component"]
        if key[1] == key[2]:
            pairs &= x["node"][:, None] < y["node"]
        small, large = (f(x["n_shingles"][:, None], y["n_shingles"]) for f in (np.minimum, np.maximum))
        pairs &= small * 100 >= large * percent
        bits = x["signature"][:, None, :] ^ y["signature"]
        bits = (bits | bits >> 1) & 0x5555555555555555
        different = np.bitwise_count(bits).sum(axis=2)
        at = np.argwhere(pairs & (different <= MOST_DIFFERENT))
        at = at[np.argsort(different[at[:, 0], at[:, 1]], kind="stable")]
        sets = [[np.frombuffer(r["codes"], np.uint32) for r in side] for side in (left, right)]
        found, joined = [], set()
        for i, j in at.tolist():  # the most alike first: a sure link joins two components
            both = frozenset((left[i]["component"], right[j]["component"]))
            if both in joined or not _linked(sets[0][i], sets[1][j], percent - 1):
                continue
            if _linked(sets[0][i], sets[1][j], percent + 1):
                joined.add(both)
            a, b = left[i]["node"], right[j]["node"]
            found.append((min(a, b), max(a, b)))
        return found

    wanted = members.select("node").distinct()
    sets = _sets(texts, sharing.select(*TEXT_OF), wanted, width)
    sets = stage(sets.mapInArrow(shortened, "node long, codes binary"))
    chunks = F.ceil(F.col("size") / CHUNK).cast("int")
    dealt = (
        members.join(sharing.select("node", "n_shingles", "signature"), "node")
        .join(sets, "node")
        .withColumn("chunk", F.pmod(F.xxhash64("node"), chunks).cast("int"))
        .withColumn("other", F.explode(F.sequence(F.lit(0), chunks - 1)))
        .withColumns({"low": F.least("chunk", "other"), "high": F.greatest("chunk", "other")})
    )
    kept = ("band", "low", "high", "chunk", "node", "component", "n_shingles", "signature", "codes")
    return (
        dealt.select(*kept)
        .repartition(partitions(texts), "band", "low", "high")
        .sortWithinPartitions("band", "low", "high")
        .mapInArrow(blocks, "a long, b long")
    )


def _open_bands(shared: DataFrame, components: DataFrame | None) -> DataFrame:
    """Members of the bands that hold more than one component, with their component."""
    if components is None:
        return shared.withColumn("component", F.col("node"))
    labelled = shared.join(
        components.withColumnRenamed("node", "node"), "node", "left"
    ).select("band", "node", "degree", F.coalesce("component", "node").alias("component"))
    mixed = (
        labelled.groupBy("band")
        .agg(F.min("component").alias("low"), F.max("component").alias("high"), F.count("*").alias("size"))
        .where("low < high")
    )
    return looked_up(labelled, stage(mixed.select("band", "size")), ["band"], "size").drop("size")


def _few(docs: DataFrame, wanted: DataFrame) -> DataFrame:
    """The wanted texts (doc_id, text_key), which are sent to all executors if they are few."""
    if wanted.count() <= SENT_IDS:
        wanted = F.broadcast(wanted)
    return docs.join(wanted, ["doc_id", "text_key"], "left_semi")


def _same_id(sketched: DataFrame, classes: DataFrame) -> DataFrame | None:
    """Edges between the classes of an id that has several; None if there is no such id."""
    rows = sketched.where("doc_id is not null and n_shingles > 0").select("doc_id", "code")
    several = rows.groupBy("doc_id").agg(
        F.min("code").alias("low"), F.max("code").alias("high"), F.count("*").alias("n")
    )
    several = stage(several.where("low != high").select("doc_id", "n"))
    if several.isEmpty():
        return None
    own = looked_up(rows, several, ["doc_id"], "n").select("doc_id", "code").distinct()
    sizes = classes.select("code", "node", "n")
    placed = stage(looked_up(own, sizes, ["code"], "n").select("doc_id", "node"))
    least = placed.groupBy("doc_id").agg(F.min("node").alias("v"), F.count("*").alias("n"))
    return looked_up(placed, least, ["doc_id"], "n").where("node != v").select(F.col("node").alias("u"), "v")


def link(docs: DataFrame, width: int = 5, percent: int = 80) -> DataFrame:
    """``doc_id, n_shingles, component_id, kept`` for every row of ``docs`` (doc_id, text).

    Documents are linked if their sets of ``width``-word shingles share at least ``percent``
    of their union; ``component_id`` is the smallest id that can be reached, and ``kept``
    marks the document that has it.
    """
    sketched = stage(sketches(docs, width))
    kept = ("n_shingles", "bands", "signature")
    # A class is a node of its own, which one of its rows stands for.
    classes = stage(
        sketched.where("doc_id is not null and n_shingles > 0")
        .groupBy("code")
        .agg(F.min(F.struct("doc_id", "text_key", *kept)).alias("first"), F.count("*").alias("n"))
        .select(F.monotonically_increasing_id().alias("node"), "code", "n", "first.*")
    )
    banded = classes.select("node", F.explode("bands").alias("band"))
    common = banded.groupBy("band").agg(F.count("*").alias("n")).where("n > 1")
    # Most bands are of one class: these rows go before skewed bands are looked up.
    shared = stage(banded.join(common, "band"))
    degrees = shared.groupBy("node").agg(F.sum("n").alias("degree"))
    sharing = stage(classes.select(*TEXT_OF, *kept).join(degrees, "node"))
    shared = shared.select("band", "node").join(sharing.select("node", "degree"), "node")
    texts = _few(keyed(docs), sharing.select("doc_id", "text_key"))
    again = sketched.groupBy("doc_id", "text_key").count().where("count > 1 and doc_id is not null")
    texts = stage(texts if again.isEmpty() else texts.dropDuplicates(["doc_id", "text"]))

    edges = components = None
    text_of = sharing.select(*TEXT_OF)

    def linked(found: DataFrame) -> None:
        nonlocal edges, components
        edges = stage(found.toDF("u", "v") if edges is None else edges.union(found))
        components = stage(connected_components(edges))

    by_id = _same_id(sketched, classes)
    if by_id is not None:
        linked(by_id)
    members = stage(_open_bands(shared, components))
    for turn in range(STAR_ROUNDS):
        likely = stage(_star_pairs(members, sharing, turn, percent))
        if not likely.isEmpty():
            linked(verified(likely, text_of, texts, width, percent))
            members = stage(_open_bands(shared, components))
    sizes = members.groupBy("band").agg(F.count("*").alias("size"))
    members = stage(looked_up(members, stage(sizes), ["band"], "size"))
    small, large = members.where(F.col("size") <= LARGE_BAND), members.where(F.col("size") > LARGE_BAND)
    likely = _cross_pairs(small, sharing, percent)
    if not large.isEmpty():
        likely = likely.union(_block_pairs(large, sharing, texts, width, percent)).distinct()
    likely = stage(likely)
    if not likely.isEmpty():
        linked(verified(likely, text_of, texts, width, percent))

    named = classes.select("code", "n", F.col("doc_id").alias("component_id"))
    if components is not None:
        reached = stage(components.join(classes.select("node", "doc_id"), "node"))
        least = reached.groupBy("component").agg(F.min("doc_id").alias("component_id"), F.count("*").alias("n"))
        found = looked_up(reached, stage(least), ["component"], "n").select("node", F.col("component_id").alias("least"))
        named = classes.join(found, "node", "left").select(
            "code", "n", F.coalesce("least", "doc_id").alias("component_id")
        )
    rows = sketched.select("doc_id", "n_shingles", "code")
    alone = F.col("doc_id").isNull() | (F.col("n_shingles") == 0)
    return (
        looked_up(rows.where(~alone), stage(named), ["code"], "n")
        .select("doc_id", "n_shingles", "component_id")
        .unionByName(rows.where(alone).select("doc_id", "n_shingles", F.col("doc_id").alias("component_id")))
        .withColumn("kept", F.coalesce(F.col("component_id") == F.col("doc_id"), F.lit(True)))
    )
