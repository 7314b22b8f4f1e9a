"""Near duplicates: MinHash bands for candidates, odd sketches to weigh them, full sets to confirm.

Documents with the same shingle set form a class.  128 MinHash samples of each class give 24 band keys of
three samples, and a 512-bit odd sketch: each sample flips one bit, so the XOR of two sketches counts the
samples that differ.  Candidates are classes that share a band key.  Links are confirmed on the whole sets.

Only what can still join two components is compared.  First every class is compared with the one centre,
of those of its buckets, whose sketch is nearest; that is done twice, and each time the components found are
folded once, which may leave some apart.  Then all classes outside a bucket's largest component are compared
with all other components of the bucket, in blocks of bounded size that give back links only, and all links
are followed to the end.  So copies of one text cost a comparison each, no link between components is
passed over, and no list of pairs is made.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from . import kernels
from .shared import Scratch, without

WIDTH = 5
PERCENT = 75
SAMPLES = 128
BANDS, ROWS = 24, 3
BITS = 512
# Of 512 bits, sketches of sets with similarity 0.75 differ in 57 on average, with a deviation of 10:
# a pair that differs in more than 120 is more than six deviations away.
MOST_BITS = 120
STAR_ROUNDS = 2
# A block compares about this many classes outside the largest component with this many of the bucket.
BLOCK = (256, 1024)
_U = np.uint64
_RNG = np.random.default_rng(20240229)
_FACTORS = _RNG.integers(0, 1 << 63, SAMPLES, dtype=np.uint64) * _U(2) + _U(1)
_SALTS = _RNG.integers(0, 1 << 63, SAMPLES, dtype=np.uint64)


def _sets(text: pa.Array, width: int) -> Iterator[tuple[int, np.ndarray]]:
    """(row, sorted distinct shingle hashes) of every row of a text column."""
    data, starts = kernels.column_bytes(text)
    for a, b in kernels.stretches(starts):
        hashes, rows = kernels.word_hashes(data, starts[a : b + 1])
        all_shingles, bounds = kernels.shingles(hashes, rows, width)
        for r in range(a, b):
            yield r, kernels.distinct(all_shingles[bounds[r - a] : bounds[r - a + 1]])


def _minima(values: np.ndarray) -> np.ndarray:
    """MinHash samples of a set, a bounded part of it at a time."""
    least = np.full(SAMPLES, np.iinfo(np.uint64).max, _U)
    for i in range(0, len(values), 4096):
        part = values[i : i + 4096]
        np.minimum(least, (_FACTORS[:, None] * part[None, :] + _SALTS[:, None]).min(axis=1), out=least)
    return least


def _sketches(minima: np.ndarray) -> np.ndarray:
    """Odd sketches of rows of samples, as rows of 64-bit integers."""
    place = (kernels.mix(minima ^ _SALTS[None, :]) % _U(BITS)).astype(np.int64)
    rows = np.repeat(np.arange(len(minima)), SAMPLES)
    flips = np.bincount(rows * BITS + place.ravel(), minlength=len(minima) * BITS) & 1
    return np.packbits(flips.astype(np.uint8).reshape(len(minima), BITS), axis=1).view(np.int64)


def _bands(minima: np.ndarray) -> np.ndarray:
    parts = minima[:, : BANDS * ROWS].reshape(len(minima), BANDS, ROWS)
    total = np.broadcast_to(np.arange(1, BANDS + 1, dtype=np.uint64)[None, :], parts.shape[:2]).copy()
    for k in range(ROWS):
        total = kernels.mix(total * _U(kernels.BASE) + parts[:, :, k])
    return total.view(np.int64)


def _lists(rows: np.ndarray) -> pa.Array:
    width = rows.shape[1]
    return pa.ListArray.from_arrays(pa.array(np.arange(0, rows.size + 1, width, dtype=np.int32)), pa.array(rows.ravel()))


def _sign(width: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n = batch.num_rows
            counts, classes = np.zeros(n, np.int64), [None] * n
            minima = np.zeros((n, SAMPLES), _U)
            for r, values in _sets(batch.column("__text"), width):
                counts[r] = len(values)
                if len(values):
                    classes[r] = hashlib.blake2b(values.tobytes(), digest_size=16).digest()
                    minima[r] = _minima(values)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("__id"), batch.column("__key"), pa.array(counts), pa.array(classes, pa.binary()),
                    _lists(_sketches(minima)) if n else pa.array([], pa.list_(pa.int64())),
                    _lists(_bands(minima)) if n else pa.array([], pa.list_(pa.int64())),
                ],
                ["id", "key", "n", "cls", "sketch", "bands"],
            )
        # The worker waits for its next task; what Arrow has pooled meanwhile goes back.
        pa.default_memory_pool().release_unused()

    return run


def _bits_apart(a: str, b: str) -> Column:
    return sum(
        (F.bit_count(F.get(a, F.lit(i)).bitwiseXOR(F.get(b, F.lit(i)))) for i in range(BITS // 64)), start=F.lit(0)
    )


def _sizes_allow(a: str, b: str) -> Column:
    return (F.col(a) * 100 >= F.col(b) * PERCENT) & (F.col(b) * 100 >= F.col(a) * PERCENT)


def _confirm(width: int, percent: int):
    """Rows ``(a, b, text, other)``: yields the pairs whose whole sets are linked.

    The join leaves rows of one b beside each other, so its set is made once for them.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ends = batch.column("b").to_pylist()
            fresh = [r for r in range(batch.num_rows) if not r or ends[r] != ends[r - 1]]
            others = _sets(batch.column("other").take(pa.array(fresh, pa.int64())), width)
            turns, held, linked = set(fresh), np.zeros(0, _U), []
            for r, values in _sets(batch.column("text"), width):
                if r in turns:
                    held = next(others)[1]
                both = len(values) + len(held)
                common = both - len(kernels.distinct(np.concatenate([values, held])))
                if 100 * common >= percent * (both - common):
                    linked.append(r)
            yield batch.select(["a", "b"]).take(pa.array(linked, pa.int64()))

    return run


def _verify(pairs: DataFrame, texts: DataFrame, width: int, percent: int) -> DataFrame:
    """The pairs ``(a, b)`` whose whole sets are similar enough.

    Both texts come by joins, so a b with very many members is a skewed join, which Spark splits.
    """
    mine = texts.select(F.col("cls").alias("a"), "text")
    theirs = texts.select(F.col("cls").alias("b"), F.col("text").alias("other"))
    both = pairs.join(mine, "a").join(theirs, "b").select("a", "b", "text", "other")
    return both.mapInArrow(_confirm(width, percent), "a binary, b binary")


def _edges(links: DataFrame, comps: DataFrame) -> DataFrame:
    """``(x, y)``: links as pairs of different components, each pair once, x the smaller."""
    x, y = comps.select(F.col("cls").alias("a"), F.col("comp").alias("x")), comps.select(F.col("cls").alias("b"), F.col("comp").alias("y"))
    named = links.select("a", "b").join(x, "a").join(y, "b").filter(F.col("x") != F.col("y"))
    return named.select(F.least("x", "y").alias("x"), F.greatest("x", "y").alias("y")).distinct()


def _roots(scratch: Scratch, edges: DataFrame, name: str) -> DataFrame:
    """``(x, root)``: every node hangs below its greatest neighbour, if that is greater, and follows to the root.

    A turn goes up three steps and no turn is left once no node finds a fourth; paths of n steps need about
    log n turns, and those of up to three a single one.
    """
    up, turn = edges.groupBy("x").agg(F.max("y").alias("up")), 0
    while True:
        over = up.select(F.col("x").alias("at"), F.col("up").alias("next"))
        seen = up.withColumn("further", F.lit(True))
        for _ in range(3):
            seen = seen.join(over, F.col("up") == F.col("at"), "left").select(
                "x", F.coalesce("next", "up").alias("up"), F.col("next").isNotNull().alias("further")
            )
        seen = scratch.save(seen, f"{name}up{turn}")
        scratch.drop(f"{name}up{turn - 1}")
        up, turn = seen.select("x", "up"), turn + 1
        if seen.filter("further").isEmpty():
            return up.withColumnRenamed("up", "root")


def _renamed(comps: DataFrame, roots: DataFrame) -> DataFrame:
    renamed = comps.join(roots.withColumnRenamed("x", "comp"), "comp", "left")
    return renamed.select("cls", F.coalesce("root", "comp").alias("comp"))


def components(scratch: Scratch, comps: DataFrame, links: DataFrame, name: str = "", whole: bool = True) -> DataFrame:
    """``(cls, comp)`` after ``links`` between classes have joined the components ``comps``.

    Each round contracts the components: all that hang together by greatest neighbours become one, and
    only links between what is left go on.  Without ``whole`` a single round is made.
    """
    edges, turn = scratch.save(_edges(links, comps), f"{name}edges0"), 0
    while not edges.isEmpty():
        roots = _roots(scratch, edges, f"{name}{turn}")
        comps = scratch.save(_renamed(comps, roots), f"{name}comps{turn}")
        if not whole:
            break
        ends = edges.select(F.col("x").alias("cls")).union(edges.select(F.col("y").alias("cls"))).distinct()
        named = _renamed(ends.withColumn("comp", F.col("cls")), roots)
        edges = scratch.save(_edges(edges.toDF("a", "b"), named), f"{name}edges{turn + 1}")
        turn += 1
    return comps


def _keyed(docs: DataFrame, text: str, ident: str) -> DataFrame:
    return docs.withColumn("__key", F.xxhash64(F.col(ident), F.col(text)))


def _classes(
    scratch: Scratch, docs: DataFrame, text: str, ident: str, width: int, percent: int
) -> tuple[DataFrame, DataFrame]:
    """``(id, key, n, cls)`` of every row, and ``(cls, component_id, head)`` of every class.

    ``head`` is the class whose rows stand for the component: the smallest of those with its id.
    """
    keyed = _keyed(docs, text, ident).select(F.col(ident).alias("__id"), "__key", F.col(text).alias("__text"))
    kind = dict(docs.dtypes)[ident]
    signed = scratch.save(
        keyed.mapInArrow(_sign(width), f"id {kind}, key long, n long, cls binary, sketch array<long>, bands array<long>"),
        "signed",
    )
    has = signed.filter(F.col("cls").isNotNull())
    classes = scratch.save(
        has.groupBy("cls").agg(
            F.min("id").alias("id"), F.min("key").alias("key"), F.max("n").alias("n"),
            F.min("sketch").alias("sketch"), F.min("bands").alias("bands"),
        ), "classes",
    )
    placed = classes.select("cls", F.explode("bands").alias("bucket"))
    shared = placed.groupBy("bucket").agg(F.count(F.lit(1)).alias("size"), F.max("cls").alias("centre")).filter("size > 1")
    buckets = scratch.save(placed.join(shared.drop("size"), "bucket"), "buckets")
    centres = buckets.groupBy("cls").agg(F.collect_set("centre").alias("centres"))
    facts = scratch.save(centres.join(classes.select("cls", "key", "n", "sketch", "bands"), "cls"), "facts")
    keys = facts.select(F.col("key").alias("__key"), "cls").hint("shuffle_hash")
    found = keyed.select("__key", "__text").join(keys, "__key")
    texts = scratch.save(found.groupBy("cls").agg(F.max("__text").alias("text")), "texts")
    comps = _components(scratch, buckets, facts, texts, width, percent)
    of_class = classes.select("cls", "id").join(comps, "cls", "left").select("cls", "id", F.coalesce("comp", "cls").alias("comp"))
    of_class = scratch.save(of_class, "of_class")
    rows = scratch.save(signed.select("id", "key", "n", "cls"), "rows")
    scratch.drop("signed", "classes", "buckets", "facts", "texts")
    heads = of_class.groupBy("comp").agg(
        F.min("id").alias("component_id"), F.min(F.struct(F.col("id").isNull(), "id", "cls"))["cls"].alias("head")
    )
    return rows, of_class.join(heads, "comp").select("cls", "component_id", "head")


def _nearest(near: DataFrame, facts: DataFrame) -> DataFrame:
    """Of rows ``(a, b, n_a, s_a)``, for each a the b whose sketch is nearest, where sizes and sketches allow a link."""
    b = facts.select(F.col("cls").alias("b"), F.col("n").alias("n_b"), F.col("sketch").alias("s_b"))
    joined = near.join(b, "b").filter(_sizes_allow("n_a", "n_b"))
    weighed = joined.select("a", "b", _bits_apart("s_a", "s_b").alias("apart")).filter(F.col("apart") <= MOST_BITS)
    return weighed.groupBy("a").agg(F.min_by("b", F.struct("apart", "b")).alias("b"))


def _components(
    scratch: Scratch, buckets: DataFrame, facts: DataFrame, texts: DataFrame, width: int, percent: int
) -> DataFrame:
    """``(cls, comp)`` of the classes that share a bucket with another."""
    comps, links = facts.select("cls", F.col("cls").alias("comp")), []

    def add(confirmed: DataFrame, turn: int) -> DataFrame:
        links.append(scratch.save(confirmed, f"links{turn}"))
        if turn == 0:
            # No class has joined another yet, so links are edges, and each goes from a class to a greater one.
            return scratch.save(_renamed(comps, _roots(scratch, links[0].toDF("x", "y"), "first")), "comps")
        whole = turn == STAR_ROUNDS
        out = components(scratch, comps, reduce(DataFrame.union, links) if whole else links[-1], f"turn{turn}", whole)
        scratch.drop(f"main{turn}")
        return out

    def largest(turn: int) -> tuple[DataFrame, DataFrame]:
        """Buckets with their classes' components, and of those with several the largest component."""
        in_bucket = buckets.select("bucket", "cls").join(comps, "cls")
        parts = in_bucket.groupBy("bucket", "comp").agg(
            F.count(F.lit(1)).alias("size"), F.min_by("cls", F.xxhash64("cls", F.lit(turn))).alias("centre")
        )
        main = parts.groupBy("bucket").agg(
            F.max(F.struct("size", "comp", "centre")).alias("main"), F.sum("size").alias("total"), F.count(F.lit(1)).alias("n_comps")
        ).filter("n_comps > 1")
        named = main.select("bucket", F.col("main.comp").alias("main_comp"), "main.centre", (F.col("total") - F.col("main.size")).alias("outside"), "total")
        return in_bucket, scratch.save(named, f"main{turn}")

    # At first each class is a component, and the centre of a bucket is the greatest.
    near = facts.select(F.col("cls").alias("a"), F.explode("centres").alias("b"), F.col("n").alias("n_a"), F.col("sketch").alias("s_a"))
    comps = add(_verify(_nearest(near.filter("a != b"), facts), texts, width, percent), 0)
    for turn in range(1, STAR_ROUNDS):
        in_bucket, main = largest(turn)
        near = in_bucket.join(main, "bucket").filter(F.col("comp") != F.col("main_comp"))
        near = near.groupBy("cls").agg(F.collect_set("centre").alias("centres")).join(facts.select("cls", "n", "sketch"), "cls")
        near = near.select(F.col("cls").alias("a"), F.explode("centres").alias("b"), F.col("n").alias("n_a"), F.col("sketch").alias("s_a"))
        comps = add(_verify(_nearest(near, facts), texts, width, percent), turn)
    in_bucket, main = largest(STAR_ROUNDS)
    return add(_rest(in_bucket, main, facts, texts, width, percent), STAR_ROUNDS)


def _blocks(rows: DataFrame, columns: list[str]) -> DataFrame:
    """Rows ``(bucket, comp, main_comp, outside, total, cls, ...)`` dealt to blocks ``(bucket, i, j)``.

    A class outside the largest component is ``asking`` in the blocks of its i, and every class is asked in
    those of its j; both numbers of blocks follow from the bucket's counts.
    """
    wide, tall = F.ceil(F.col("outside") / BLOCK[0]).cast("int"), F.ceil(F.col("total") / BLOCK[1]).cast("int")
    share = lambda n: F.pmod(F.xxhash64("cls"), n).cast("int")
    upto = lambda n: F.explode(F.sequence(F.lit(0), n - 1))
    asking = rows.filter(F.col("comp") != F.col("main_comp")).select("bucket", share(wide).alias("i"), upto(tall).alias("j"), F.lit(True).alias("asking"), "comp", *columns)
    asked = rows.select("bucket", upto(wide).alias("i"), share(tall).alias("j"), F.lit(False).alias("asking"), "comp", *columns)
    return asking.unionByName(asked)


def _dealt(blocks: DataFrame) -> DataFrame:
    return blocks.repartition("bucket", "i", "j").sortWithinPartitions("bucket", "i", "j", F.col("asking").desc(), "cls")


def _rest(in_bucket: DataFrame, main: DataFrame, facts: DataFrame, texts: DataFrame, width: int, percent: int) -> DataFrame:
    """All links between a bucket's components: sketches name the classes to read, whole sets confirm."""
    rows = in_bucket.join(main.drop("centre"), "bucket").join(facts.select("cls", "n", "sketch", "bands"), "cls")
    plausible = _dealt(_blocks(rows, ["cls", "n", "sketch", "bands"])).mapInArrow(
        _plausible(percent), "bucket long, i int, j int, asking boolean, comp binary, cls binary"
    )
    return _dealt(plausible.join(texts, "cls")).mapInArrow(_links(width, percent), "a binary, b binary")


def _by_block(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
    """The rows of one block after another; a block may reach over batches."""
    held: list[pa.RecordBatch] = []
    key = None
    for batch in batches:
        if not batch.num_rows:
            continue
        keys = np.stack([batch.column(c).to_numpy().astype(np.int64) for c in ("bucket", "i", "j")], 1)
        edges = np.concatenate([[0], np.flatnonzero((keys[1:] != keys[:-1]).any(axis=1)) + 1, [len(keys)]])
        for a, b in zip(edges[:-1].tolist(), edges[1:].tolist(), strict=True):
            if held and tuple(keys[a]) != key:
                yield pa.Table.from_batches(held).combine_chunks()
                held = []
            key = tuple(keys[a])
            held.append(batch.slice(a, b - a))
    if held:
        yield pa.Table.from_batches(held).combine_chunks()


def _matrix(column: pa.ChunkedArray) -> np.ndarray:
    values = column.combine_chunks().flatten().to_numpy()
    return values.reshape(len(column), -1)


def _components_in(table: pa.Table) -> tuple[np.ndarray, np.ndarray]:
    """Which rows ask, and a number for each row's component."""
    comps = table.column("comp").combine_chunks().dictionary_encode().indices.to_numpy()
    return table.column("asking").to_numpy(), comps


def _plausible(percent: int):
    """Of each block, the rows with a pair that sizes and sketches allow and no earlier band brought together."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in _by_block(batches):
            asking, comps = _components_in(table)
            apart = comps[asking][:, None] != comps[~asking][None, :]
            n = table.column("n").to_numpy()
            small, large = np.minimum(n[asking][:, None], n[~asking][None, :]), np.maximum(n[asking][:, None], n[~asking][None, :])
            apart &= 100 * small >= percent * large
            x, y = np.nonzero(apart)
            sketch, bands = _matrix(table.column("sketch")), _matrix(table.column("bands"))
            mine, theirs = np.flatnonzero(asking)[x], np.flatnonzero(~asking)[y]
            passed = np.zeros(table.num_rows, bool)
            for k in range(0, len(x), 65_536):
                a, b = mine[k : k + 65_536], theirs[k : k + 65_536]
                near = np.bitwise_count((sketch[a] ^ sketch[b]).view(np.uint64)).sum(axis=1) <= MOST_BITS
                a, b = a[near], b[near]
                band = (bands[a] == table.column("bucket")[0].as_py()).argmax(axis=1)
                first = (bands[a] == bands[b]).argmax(axis=1) == band
                passed[a[first]] = passed[b[first]] = True
            if passed.any():
                kept = table.select(["bucket", "i", "j", "asking", "comp", "cls"]).filter(pa.array(passed))
                yield from kept.combine_chunks().to_batches()

    return run


def _links(width: int, percent: int):
    """Of each block, one link of whole sets for each pair of components that have any."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in _by_block(batches):
            asking, comps = _components_in(table)
            sets = [values for _, values in _sets(table.column("text").combine_chunks(), width)]
            sizes = np.array([len(v) for v in sets])
            known, number = np.unique(np.concatenate(sets), return_inverse=True)
            bounds = np.cumsum(sizes) - sizes
            theirs = np.flatnonzero(~asking)
            if not len(theirs) or len(theirs) == len(asking):
                continue
            flat = np.concatenate([number[bounds[r] : bounds[r] + sizes[r]] for r in theirs])
            begins = np.cumsum(sizes[theirs]) - sizes[theirs]
            cls, found = table.column("cls"), {}
            for r in np.flatnonzero(asking):
                marks = np.zeros(len(known), np.int32)
                marks[number[bounds[r] : bounds[r] + sizes[r]]] = 1
                common = np.add.reduceat(marks[flat], begins)
                alike = 100 * common >= percent * (sizes[r] + sizes[theirs] - common)
                linked = theirs[alike & (comps[theirs] != comps[r])]
                for c, at in zip(*np.unique(comps[linked], return_index=True), strict=True):
                    found.setdefault((min(comps[r], c), max(comps[r], c)), (int(r), int(linked[at])))
            yield pa.RecordBatch.from_arrays(
                [pa.array([cls[x[k]].as_py() for x in found.values()], pa.binary()) for k in (0, 1)], ["a", "b"]
            )

    return run


def near_duplicates(
    docs: DataFrame, *, text: str = "text", ident: str = "doc_id", width: int = WIDTH, percent: int = PERCENT,
) -> DataFrame:
    """``(ident, n_shingles, component_id, kept)`` of every row.

    Null and empty texts have an empty set, are linked with nothing and stay.  Ids may be null or repeated:
    a component's id is its smallest id that is not null, rows with that id are kept, and a component
    without any id keeps its rows.  An empty table stays empty; other columns don't matter.
    """
    rows, classes = _classes(Scratch(docs.sparkSession), docs.select(ident, text), text, ident, width, percent)
    component = F.when(F.col("cls").isNull(), F.col("id")).otherwise(F.col("component_id"))
    return rows.join(classes, "cls", "left").select(
        F.col("id").alias(ident), F.col("n").alias("n_shingles"), component.alias("component_id"),
        F.coalesce(F.col("id") == component, component.isNull()).alias("kept"),
    )


def deduplicate(
    docs: DataFrame, *, text: str = "text", ident: str = "doc_id", width: int = WIDTH, percent: int = PERCENT,
) -> DataFrame:
    """One row of each component, with all its columns; rows without words all stay.

    The row with the component's id stays.  Of several such rows (repeated rows, or texts that share an
    id) one stays, the same in every run but for columns other than text and id.
    """
    clean = without(docs, "__key", "__once")
    rows, classes = _classes(Scratch(docs.sparkSession), clean.select(ident, text), text, ident, width, percent)
    heads = classes.filter(F.col("cls") == F.col("head")).select("cls", "component_id")
    with_words = rows.join(heads, "cls").filter(F.col("id").eqNullSafe(F.col("component_id")))
    stays = with_words.groupBy("cls").agg(F.min("key").alias("__key")).select("__key", F.lit(False).alias("__empty"))
    empty = rows.filter(F.col("cls").isNull()).select(F.col("key").alias("__key"), F.lit(True).alias("__empty")).distinct()
    joined = _keyed(clean, text, ident).join(stays.union(empty), "__key")
    once = F.when(F.col("__empty"), F.monotonically_increasing_id()).otherwise(F.lit(0))
    return joined.withColumn("__once", once).dropDuplicates(["__key", "__once"]).select(*[f"`{c}`" for c in clean.columns])
