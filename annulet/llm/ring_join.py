"""Near-duplicate rings: exact similarity joins of circular sequences and of circles of segments.

Both joins gather in regions what may be alike, so that every pair within the threshold meets in at least one, and
then decide each candidate exactly.

Sequences (``ring_pairs``). Equal rings, whatever their starting base, are one class with one representative. Every
ring is looked up by its first shingles in one order of all shingles, as many as its pairs may have edits and one
more side by side (see ``ring_kernel.keys``); two rings within ``percent`` % edits share one of them, with nearly the
same letters after it. Only these entries (hash, ring, following letters) are shuffled, a number of bytes in
proportion to the letters however many there are; the parts they go to are ranges of the hash, as many as the data
asks for, and a part that a frequent shingle makes too large is met in pairs of blocks. Lengths must fit by the
triangle inequality (the distance to the empty ring is the length). Sequences are fetched for candidates only,
where a bound on the Jaccard distance of shingle multisets and a banded table of edit costs decide.

Circles (``circle_pairs``). A circle's segments are points (start0, end0) per chromosome and strand; pivots are
the centres of a grid over start0, its cells the Voronoi regions, and the window replicates segments within
``reach`` of a border. Two neighbouring segments of the circle with fewer segments are looked up among pairs of
segments (next, or next but one) of the other; then all segments are compared, going round.

Defined cases: rows with a missing sequence (null, empty) or a circle with a missing chromosome, strand, start or
end are in no pair; letter case is ignored; a repeated row counts once; rings too short for an edit are only in
pairs with equal rings; empty tables give no pairs.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from annulet.functions.rings import least_rotation
from annulet.llm import ring_kernel
from annulet.operators.graph import components
from annulet.operators.interval_sweep import chromosome
from annulet.session import cut

LONGEST = 13  # letters of a shingle
ENTRIES_PER_PART = 1_000_000  # about so many in a part if shingles are spread evenly
ENTRIES_PER_TASK = 4_000_000  # a part with more, for a frequent shingle, is met in pairs of blocks
ENTRIES_OF_A_RING = 4  # so many a shingle may have in one ring, on the average, with different letters after it
MOST_PARTS = 20_000
LETTERS_AT_ONCE = 4_000_000

_ENTRY = "part int, i int, j int, own int, entries int, base bigint, runs binary, sizes binary, h binary, ring binary, context binary"
_ENTRY_ARROW = pa.schema([(c.split()[0], {"int": pa.int32(), "bigint": pa.int64(), "binary": pa.binary()}[c.split()[1]]) for c in _ENTRY.split(", ")])


def _turned(df: DataFrame) -> DataFrame:
    """id, n, ring: the least rotation of every sequence, in upper case and packed, with its length."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rings = ring_kernel.canonical([s.encode() for s in batch.column(1).to_pylist()])
            packed = pa.array(map(ring_kernel.pack, rings), pa.binary())
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(map(len, rings), pa.int32()), packed], ["id", "n", "ring"])

    # Rotation is counted in bytes, so letters outside ASCII are left out as no bases.
    rows = df.select(F.col("id").cast("bigint"), F.upper("seq").alias("seq")).where(r"length(seq) > 0 and length(seq) = octet_length(seq) and id is not null")
    return rows.mapInArrow(run, "id bigint, n int, ring binary")


def spark_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def classes(df: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Representatives (cls, n, ring, and num that numbers them by length in each partition) and membership (id, cls) of rings that are equal, from (id, seq)."""
    spark = df.sparkSession
    keys = [F.xxhash64("ring", "n").alias("h1"), F.xxhash64(F.lit(1), "ring", "n").alias("h2")]
    turned = _turned(df).select("id", "n", "ring", *keys)
    # A fixed number of partitions: what follows costs much per row, and the rows are few.
    spread = turned.repartition(max(spark.sparkContext.defaultParallelism, spark_partitions(spark)), "h1", "h2")
    best = spread.groupBy("h1", "h2").agg(F.min(F.struct("id", "n", "ring")).alias("r"), F.max("id").alias("top"))
    reps = cut(best.select("h1", "h2", F.col("r.id").alias("cls"), "top", "r.n", "r.ring").sortWithinPartitions("n"))
    several = reps.where("cls < top").select("h1", "h2", "cls")
    members = cut(turned.select("id", "h1", "h2").join(several, ["h1", "h2"]).select("id", "cls").distinct())  # read several times
    return reps.select("cls", "n", "ring", F.monotonically_increasing_id().alias("num")), members


def shingle_length(letters: int) -> int:
    """Letters of a shingle for rings of so many letters in all: an entry meets few others by chance, up to LONGEST letters."""
    return min(max(math.ceil(math.log(max(letters / 256, 1), 4)), ring_kernel.CONTEXT), LONGEST)


def _entries(reps: DataFrame, percent: int, most: int, parts: int, blocks: dict[int, int]) -> DataFrame:
    """The entries of some rings that belong to one part of the hashes, packed: rising hashes, ring numbers from ``base`` on, their lengths, contexts.

    A part of several ``blocks`` is met in pairs of blocks (i, j), so its entries go to as many tasks; which of the two they are is ``own``.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            nums, sizes = batch.column(0).to_numpy(), batch.column(1).to_numpy()
            cuts = np.flatnonzero((np.diff(np.cumsum(sizes, dtype=np.int64) // LETTERS_AT_ONCE) > 0) | (np.diff(nums) != 1)) + 1
            for lo, hi in zip([0, *cuts], [*cuts, len(nums)]):
                rings = [ring_kernel.unpack(p, n) for p, n in zip(batch.column(2).slice(lo, hi - lo).to_pylist(), sizes[lo:hi].tolist())]
                for at in range(0, len(rings), 1 << 16):
                    some = rings[at : at + (1 << 16)]
                    yield from packed(some, nums[lo + at : lo + at + len(some)])

    def packed(rings: list[bytes], nums: np.ndarray) -> Iterator[pa.RecordBatch]:
        h, ring, context = ring_kernel.keys(rings, percent, most)
        bounds = np.searchsorted(h, (np.arange(parts + 1, dtype=np.uint64) << np.uint64(32)) // np.uint64(parts))
        n = np.array([len(s) for s in rings], np.int64)
        runs = _runs(n)
        if len(runs) * parts > 2 * h.size:  # then lengths cost less where they are wanted
            runs = None
        rows = []
        for part in np.flatnonzero(bounds[1:] > bounds[:-1]).tolist():
            k = slice(bounds[part], bounds[part + 1])
            b = blocks.get(part, 1)
            own = zlib.crc32(nums[:1].tobytes()) % b
            row = {"part": part, "own": own, "entries": int(k.stop - k.start), "base": int(nums[0]), "runs": runs, "sizes": None if runs else _planes(n[ring[k]].astype(np.uint32)), "h": _planes(np.diff(h[k], prepend=np.uint32(0))), "ring": _planes(ring[k].astype(np.uint16)), "context": context[k].tobytes()}
            rows += [row | {"i": min(own, o), "j": max(own, o)} for o in range(b)]
        if rows:
            yield pa.RecordBatch.from_pylist(rows, schema=_ENTRY_ARROW)

    return reps.select("num", "n", "ring").mapInArrow(run, _ENTRY)


def _planes(x: np.ndarray) -> bytes:
    """The bytes of all numbers, first the lowest of each: what is mostly zero stands together and packs well."""
    return np.ascontiguousarray(x.view(np.uint8).reshape(x.size, -1).T).tobytes()


def _from_planes(b: bytes, kind: type) -> np.ndarray:
    width = np.dtype(kind).itemsize
    return np.ascontiguousarray(np.frombuffer(b, np.uint8).reshape(width, -1).T).view(kind).ravel()


def _runs(sizes: np.ndarray) -> bytes:
    """Lengths of rings in a row, as stretches (length, rings): few, for rings come sorted by length."""
    heads = np.flatnonzero(np.diff(sizes, prepend=-1))
    return np.stack([sizes[heads], np.diff(np.append(heads, sizes.size))], axis=1).astype(np.uint32).tobytes()


def _from_runs(b: bytes) -> np.ndarray:
    size, count = np.frombuffer(b, np.uint32).reshape(-1, 2).T
    return np.repeat(size, count)


def class_pairs(reps: DataFrame, percent: int) -> DataFrame:
    """cls_a, cls_b of representatives within the threshold, each pair once."""
    spark = reps.sparkSession
    cores = spark.sparkContext.defaultParallelism
    letters, rings = reps.agg(F.coalesce(F.sum("n"), F.lit(0)), F.count("*")).first()
    most = shingle_length(letters)
    parts = min(max(2 * cores, math.ceil(letters / 3 / ENTRIES_PER_PART)), MOST_PARTS)
    blocks: dict[int, int] = {}
    if rings * ENTRIES_OF_A_RING > ENTRIES_PER_TASK:  # with fewer rings no shingle has too many entries: equal ones of a ring are one
        sizes = _entries(reps, percent, most, parts, {}).groupBy("part").agg(F.sum(F.col("entries").cast("bigint")).alias("n"))
        blocks = {r["part"]: math.ceil(2 * r["n"] / ENTRIES_PER_TASK) for r in sizes.where(F.col("n") > ENTRIES_PER_TASK).collect()}  # at most MOST_PARTS
    entries = _entries(reps, percent, most, parts, blocks)

    def run(key: tuple, table: pa.Table) -> pa.Table:
        one = key[1].as_py() == key[2].as_py()
        held = [table[c].to_pylist() for c in ("base", "runs", "sizes", "h", "ring", "context", "own")]
        columns: list[list[np.ndarray]] = [[] for _ in range(5)]
        for base, runs, sizes, h, ring, context, own in zip(*held):
            at = _from_planes(ring, np.uint16)
            n = _from_planes(sizes, np.uint32) if runs is None else _from_runs(runs)[at]
            for c, v in zip(columns, (np.cumsum(_from_planes(h, np.uint32), dtype=np.uint32), n.astype(np.int64), base + at.astype(np.int64), np.frombuffer(context, np.uint16), np.full(at.size, own))):
                c.append(v)
        h, n, num, context, own = (np.concatenate(c) for c in columns)
        a, b = ring_kernel.meeting(h, n, num, context, None if one else own, percent)
        return pa.table({"num_a": a, "num_b": b})

    at = ["part", "i", "j"]
    tasks = parts + sum(b * (b + 1) // 2 - 1 for b in blocks.values())
    maybe = entries.repartition(min(tasks, MOST_PARTS), *at).groupBy(*at).applyInArrow(run, "num_a bigint, num_b bigint").distinct()
    side = lambda s: reps.select(F.col("num").alias(f"num_{s}"), F.col("cls").alias(f"cls_{s}"), F.col("n").alias(f"n_{s}"), F.col("ring").alias(f"ring_{s}"))
    both = maybe.join(side("a"), "num_a").repartition(max(cores, spark_partitions(spark)), "num_b").join(side("b"), "num_b")

    def decide(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            a, b = ([ring_kernel.unpack(p, n) for p, n in zip(batch[f"ring_{s}"].to_pylist(), batch[f"n_{s}"].to_pylist())] for s in "ab")
            yield batch.select(["cls_a", "cls_b"]).filter(pa.array(ring_kernel.close(a, b, percent)))

    return both.select("cls_a", "n_a", "ring_a", "cls_b", "n_b", "ring_b").mapInArrow(decide, "cls_a bigint, cls_b bigint")


def _spread(pairs: DataFrame, members: DataFrame, side: str) -> DataFrame:
    """The class on one side replaced by each of its members."""
    m = members.select(F.col("cls").alias(f"cls_{side}"), F.col("id").alias(f"id_{side}"))
    return pairs.join(m, f"cls_{side}", "left").withColumn(f"id_{side}", F.coalesce(f"id_{side}", f"cls_{side}"))


def all_pairs(pairs: DataFrame, members: DataFrame) -> DataFrame:
    """id_a < id_b of all rows of linked classes, and of all rows of one class."""
    across = _spread(_spread(pairs, members, "a"), members, "b").select("id_a", "id_b")
    a, b = members.select("cls", F.col("id").alias("id_a")), members.select("cls", F.col("id").alias("id_b"))
    inside = a.join(b, "cls").where("id_a < id_b").select("id_a", "id_b")
    across = across.select(F.least("id_a", "id_b").alias("id_a"), F.greatest("id_a", "id_b").alias("id_b"))
    return across.unionByName(inside)


def groups(reps: DataFrame, members: DataFrame, pairs: DataFrame) -> DataFrame:
    """id, class_id, links, group_id: one row for each row of the join, whatever the number of its partners.

    Rows of one class are equal; ``links`` counts the partners of a row, without listing pairs of copies; a group is
    what pairs connect, named after its smallest id.
    """
    pairs = cut(pairs.select(F.least("cls_a", "cls_b").alias("src"), F.greatest("cls_a", "cls_b").alias("dst")).distinct())
    sizes = members.groupBy("cls").agg(F.count("*").alias("size"))
    table = reps.select("cls").join(sizes, "cls", "left").select("cls", F.coalesce("size", F.lit(1)).alias("size"))
    ways = pairs.unionByName(pairs.select(F.col("dst").alias("src"), F.col("src").alias("dst")))
    near = ways.join(table.select(F.col("cls").alias("dst"), "size"), "dst").groupBy(F.col("src").alias("cls")).agg(F.sum("size").alias("n"))
    # Only linked classes take part in the components; what has no partner is a group of its own.
    placed = components(ways.select(F.col("src").alias("node")), pairs).select(F.col("node").alias("cls"), F.col("component").alias("group_id"))
    facts = table.join(near, "cls", "left").join(placed, "cls", "left")
    facts = facts.select("cls", F.coalesce("group_id", "cls").alias("group_id"), (F.coalesce("n", F.lit(0)) + F.col("size") - 1).alias("links"))
    others = members.where("id <> cls").join(facts, "cls").select("id", F.col("cls").alias("class_id"), "links", "group_id")
    return facts.select(F.col("cls").alias("id"), F.col("cls").alias("class_id"), "links", "group_id").unionByName(others)


def ring_pairs(df: DataFrame, percent: int = 6) -> DataFrame:
    """id_a < id_b of rows (id, seq) whose rings a rotation and at most ``percent`` % edits make equal."""
    reps, members = classes(df)
    return all_pairs(class_pairs(reps, percent), members)


def ring_groups(df: DataFrame, percent: int = 6) -> DataFrame:
    """Classes, links and groups of the rows (id, seq) that have a ring."""
    reps, members = classes(df)
    return groups(reps.select("cls"), members, class_pairs(reps, percent))


def circles(df: DataFrame) -> DataFrame:
    """circle, segs: segments of each complete circle in their order, in the version loaded last, turned to the least rotation."""
    seg = F.struct("seg_index", "loaded_at", F.struct(chromosome(F.col("chr")).alias("chr"), "strand", F.col("start0").cast("bigint").alias("start0"), F.col("end0").cast("bigint").alias("end0")).alias("s"))
    rows = df.where("circle_no is not null").groupBy(F.col("circle_no").alias("circle")).agg(F.array_sort(F.collect_set(seg)).alias("v"))
    last = F.filter("v", lambda x, i: ~F.coalesce(F.get(F.col("v"), i + 1)["seg_index"] == x["seg_index"], F.lit(False)))
    rows = rows.select("circle", F.transform(last, lambda x: x["s"]).alias("segs"))
    missing = lambda s: s["chr"].isNull() | s["strand"].isNull() | s["start0"].isNull() | s["end0"].isNull()
    rows = rows.where(~F.exists("segs", missing) & (F.size("segs") > 0))
    return rows.withColumn("segs", _least_turn(F.col("segs")))


def _least_turn(segs: Column) -> Column:
    """An array turned to its least rotation, its items in the order of their hashes, in linear time whatever its length."""

    @F.pandas_udf("int")
    def among_equals(ranks: pd.Series) -> pd.Series:
        return pd.Series([None if r is None else least_rotation(list(r)) for r in ranks], dtype="Int32")

    ranks = F.transform(segs, lambda s: F.xxhash64(s["chr"], s["strand"], s["start0"], s["end0"]))
    least = F.array_min(ranks)
    several = F.size(F.filter(ranks, lambda r: r == least)) > 1  # only then does more than the least one decide
    at = F.coalesce(among_equals(F.when(several, ranks)), F.array_position(ranks, least).cast("int") - 1)
    return F.concat(F.slice(segs, at + 1, F.size(segs)), F.slice(segs, F.lit(1), at))


def _circle_classes(df: DataFrame, reach: int, cell: int) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Representatives (cls), membership (id, cls) of classes with several, and pairs of representatives."""
    rows = cut(circles(df))  # one row a circle, read several times
    reps = rows.groupBy("segs").agg(F.min("circle").alias("cls"), F.max("circle").alias("top"), F.size("segs").alias("n"))
    members = rows.join(reps.where("cls < top").select("segs", "cls"), "segs").select(F.col("circle").alias("id"), "cls")
    at = lambda c: F.floor(c / cell)
    window = lambda s: F.array_distinct(F.array(at(s["start0"] - reach), at(s["start0"] + reach)))
    key = lambda s, t: F.xxhash64(s["chr"], s["strand"], t["chr"], t["strand"])
    probe = reps.select(F.col("cls").alias("a"), F.col("n").alias("na"), F.col("segs")[0].alias("s"), F.get("segs", 1 % F.col("n")).alias("t"))
    ends = lambda s, name: [s["start0"].alias(f"{name}0"), s["end0"].alias(f"{name}1")]
    probe = probe.select("a", "na", *ends(F.col("s"), "pa"), *ends(F.col("t"), "pt"), key(F.col("s"), F.col("t")).alias("k"), at(F.col("s.start0")).alias("c1"), at(F.col("t.start0")).alias("c2"))
    steps = F.flatten(F.transform(F.sequence(F.lit(0), F.col("n") - 1), lambda i: F.array(F.struct(i.alias("i"), ((i + 1) % F.col("n")).alias("j")), F.struct(i.alias("i"), ((i + 2) % F.col("n")).alias("j")))))
    base = reps.select(F.col("cls").alias("b"), F.col("n").alias("nb"), "segs", F.explode(F.array_distinct(steps)).alias("x"))
    base = base.select("b", "nb", F.get("segs", F.col("x.i")).alias("bs"), F.get("segs", F.col("x.j")).alias("bt"))
    # Chromosomes and strands travel as a hash; the comparison of all segments settles them.
    base = base.select("b", "nb", *ends(F.col("bs"), "bs"), "bt", key(F.col("bs"), F.col("bt")).alias("k"), F.explode(window(F.col("bs"))).alias("c1"))
    base = base.select("b", "nb", "bs0", "bs1", *ends(F.col("bt"), "bt"), "k", "c1", F.explode(window(F.col("bt"))).alias("c2"))
    near = lambda x, y: f"abs({x}.start0 - {y}.start0) <= {reach} and abs({x}.end0 - {y}.end0) <= {reach} and {x}.chr = {y}.chr and {x}.strand = {y}.strand"
    both_ends = " and ".join(f"abs({x}{i} - {y}{i}) <= {reach}" for x, y in (("pa", "bs"), ("pt", "bt")) for i in (0, 1))
    maybe = probe.join(base, ["k", "c1", "c2"]).where(f"a <> b and nb - na between 0 and 1 and {both_ends}")
    maybe = maybe.select("a", "b").distinct()
    both = maybe.join(reps.select(F.col("cls").alias("a"), F.col("segs").alias("sa")), "a").join(reps.select(F.col("cls").alias("b"), F.col("segs").alias("sb")), "b")
    same = f"forall(sequence(0, size(sa) - 1), i -> exists(array(named_struct('x', get(sa, (o + i) % size(sa)), 'y', get(sb, (t + i) % size(sb)))), p -> {near('p.x', 'p.y')}))"
    agrees = f"exists(sequence(0, size(sb) - 1), t -> exists(sequence(0, if(size(sa) = size(sb), 0, size(sa) - 1)), o -> {same}))"
    pairs = both.where(agrees).select(F.least("a", "b").alias("cls_a"), F.greatest("a", "b").alias("cls_b")).distinct()
    return reps.select("cls"), members, pairs


def circle_pairs(df: DataFrame, reach: int = 20, cell: int = 256) -> DataFrame:
    """id_a < id_b of circles whose segments agree, going round, one of them passed over at most."""
    _, members, pairs = _circle_classes(df, reach, cell)
    return all_pairs(pairs, members)


def circle_groups(df: DataFrame, reach: int = 20, cell: int = 256) -> DataFrame:
    """Classes, links and groups of the complete circles."""
    return groups(*_circle_classes(df, reach, cell))
