"""Near duplicates: banded MinHash, odd sketches to screen candidates, whole shingle sets to confirm.

Every text is a set of 64-bit hashes of its word shingles. Equal sets are one class from the start.
Class representatives get MinHash samples, cut into bands whose hashes are buckets, and an odd
sketch: a bitmap in which each sample flips one bit. The population count of the XOR of two
sketches grows with the number of samples that differ, so it tells high similarities apart
precisely, and only pairs under a cut that a true link passes all but once in a million are looked
at again. Those are confirmed on whole sets.

Buckets are never expanded into all pairs. Members of a small bucket whose sketches agree form a
group around their smallest id; a large bucket is first compared with its smallest id. Each group
is checked as a whole by a product of its shingle incidence matrix, in blocks of bounded size, and
gives a row for each linked member. What then still has several components in a large bucket, or in
a small one of a group that took several blocks, is compared block against block (everything outside the largest component against everything), which
loses no link and ships each block's sets only where sketches agree.

A bucket that would take many blocks is first dealt anew. Its rows' shingles have one order, the rare ones
first, and two sets over the threshold always share one of the few that come first in each: so rows
meet by those, and rows that have only frequent shingles in common meet no more.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import broadcast_if_small, cut, shared_dir, small_batches, table
from .components import components

#: Members of a bucket that is grouped in one piece, and of one block of a larger one.
SMALL, BLOCK = 32, 128
#: Shingles of the sets of one block; blocks of a bucket above which its rows meet by rare shingles instead.
HASHES, WIDE = 1 << 21, 32
#: Bits of a shingle's hash by which its frequency is told: a table of fixed size.
RARITY_BITS = 18
#: A set or vertex is hot above so many rows, and above this share of all rows: at most 1 / HOT_SHARE are.
HOT_ROWS, HOT_SHARE = 500, 1e-4
#: Centres of groups of several parts are broadcast up to this number.
BROADCAST_ROWS = 100_000
#: Rows of a MinHash band, bits of an odd sketch, chance at most of a true link failing in either step.
ROWS, BITS, MISS = 6, 256, 1e-6
_MASK = (1 << 64) - 1


def _odd(seed: int, n: int, kind=np.uint64) -> np.ndarray:
    return np.random.default_rng(seed).integers(0, np.iinfo(kind).max, n, kind, True) | kind(1)


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def shingle_hashes(text: str, n: int = 5) -> np.ndarray:
    """The sorted distinct hashes of a text's n-word shingles, A-Z lower-cased; of fewer words, one for all."""
    from xxhash import xxh3_64_intdigest

    words = text.encode().lower().split()
    if not words:
        return np.empty(0, np.uint64)
    h = np.fromiter(map(xxh3_64_intdigest, words), np.uint64, len(words))
    width = min(n, len(words))
    k = _odd(7, n)
    s = np.full(len(h) - width + 1, width, np.uint64)
    for j in range(width):
        s += h[j : j + len(s)] * k[j]
    return np.unique(_mix(s))


def n_bands(threshold: float) -> int:
    """Bands so that a pair at the threshold shares none with a chance under MISS."""
    return math.ceil(math.log(MISS) / math.log(1 - threshold**ROWS))


def sketch_cut(threshold: float) -> int:
    """The most bits that the odd sketches of a linked pair differ in, but for a chance under MISS.

    Of k samples, k (1 - J) differ with a binomial spread, and each flips a bit in both sketches. The
    bound takes five standard deviations of both chances: of that number, and of the bits that so
    many flips leave odd.
    """
    k, j = n_bands(threshold) * ROWS, threshold
    mean = BITS / 2 * (1 - (1 - 2 / BITS) ** (2 * k * (1 - j)))
    slope = 2 * (1 - 2 * mean / BITS)
    return math.ceil(mean + 5 * math.sqrt(slope**2 * k * j * (1 - j) + mean * (1 - mean / BITS)))


def signature(sets: np.ndarray, bands: int) -> tuple[np.ndarray, np.ndarray]:
    """Band hashes and the odd sketch's four words, both as signed 64-bit integers."""
    k = bands * ROWS
    low = (sets >> np.uint64(32)).astype(np.uint32)
    a = _odd(11, k, np.uint32)
    samples = np.full(k, 0xFFFFFFFF, np.uint32)
    for at in range(0, len(low), 512):
        x = low[at : at + 512, None] * a
        x ^= x >> np.uint32(15)
        x *= np.uint32(0x2C1B3C6D)
        x ^= x >> np.uint32(13)
        np.minimum(samples, x.min(0), out=samples)
    wide = samples.astype(np.uint64)
    keys = _mix(_mix((wide.reshape(bands, ROWS) * _odd(13, ROWS)).sum(1, dtype=np.uint64)) + np.arange(bands, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))
    flips = _mix(wide + np.arange(k, dtype=np.uint64) * np.uint64(0xD1B54A32D192ED03)) % np.uint64(BITS)
    odd = np.bincount(flips.astype(np.int64), minlength=BITS) & 1
    return keys.view(np.int64), np.packbits(odd.astype(np.uint8)).view(np.int64)


def _groups(batches: Iterator, n_keys: int) -> Iterator[list[tuple]]:
    """The rows of each run of equal first n_keys columns, over all of a partition's batches."""
    key, rows = None, []
    for b in batches:
        for row in zip(*(c.to_pylist() for c in b.columns)):
            if row[:n_keys] != key:
                if rows:
                    yield rows
                key, rows = row[:n_keys], []
            rows.append(row)
    if rows:
        yield rows


def _by_groups(df: DataFrame, keys: list[str], f: Callable[[list[tuple]], Iterator[tuple]], schema: str) -> DataFrame:
    """f over the rows of each group; a group's rows are sorted together and read as they come."""
    import pyspark.sql.types as T

    types = [{T.LongType: "int64", T.StringType: "string", T.BinaryType: "binary", T.IntegerType: "int32"}[type(x.dataType)] for x in T._parse_datatype_string(schema)]
    names = [x.name for x in T._parse_datatype_string(schema)]
    n = len(keys)

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        out: list[tuple] = []
        kinds = [getattr(pa, t)() for t in types]
        for rows in _groups(batches, n):
            out.extend(f(rows))
            if len(out) >= 20_000:
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out), kinds)], names=names)
                out = []
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out), kinds)], names=names)

    ordered = df.select(*keys, *[c for c in df.columns if c not in keys])
    return ordered.repartition(*keys).sortWithinPartitions(*keys).mapInArrow(run, schema)


def _labels(linked: np.ndarray) -> np.ndarray:
    """For each row of a symmetric link matrix the first row that it reaches."""
    m = len(linked)
    label = np.arange(m)
    while True:
        new = np.minimum(label, np.where(linked, label[None, :], m).min(1))
        new = new[new]
        if (new == label).all():
            return label
        label = new


def linked_sets(sets: list[np.ndarray], num: int, den: int) -> np.ndarray:
    """Which pairs have den * intersection >= num * union, exactly, as a matrix."""
    m, size = len(sets), np.array([len(s) for s in sets])
    values, at, count = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    owner = np.repeat(np.arange(m), size)
    shared = count > 1
    column = np.cumsum(shared) - 1
    use = shared[at]
    rows, cols = owner[use], column[at[use]]
    both = np.zeros((m, m))
    for lo in range(0, int(shared.sum()), 4096):
        here = (cols >= lo) & (cols < lo + 4096)
        x = np.zeros((m, min(4096, int(shared.sum()) - lo)), np.float32)
        x[rows[here], cols[here] - lo] = 1
        both += x @ x.T
    union = size[:, None] + size[None, :] - both
    linked = (den * both >= num * union) & (union > 0)
    np.fill_diagonal(linked, False)
    return linked


def rare_prefix(hashes: np.ndarray, level: np.ndarray, num: int, den: int) -> np.ndarray:
    """The shingles of a set that come first by level, then hash: two sets with den * intersection >= num * union share one."""
    n = len(hashes)
    order = np.lexsort((hashes, level[(hashes >> np.uint64(64 - RARITY_BITS)).astype(np.int64)]))
    return hashes[order[: n - -(-num * n // den) + 1]]


def by_rare_shingles(rows: DataFrame, num: int, den: int) -> DataFrame:
    """(key, id, label, size) of rows (id, label, size, hashes) that share a shingle of their prefixes and differ in label.

    About (1 - num / den) of a row's shingles are entries, and only those that a row of another label has too are
    kept. Of keys with the same rows one is kept, told by their number and two 64-bit hashes.
    """

    def tally(batches: Iterator) -> Iterator:
        import pyarrow as pa

        total = np.zeros(1 << RARITY_BITS, np.int64)
        for b in batches:
            h = np.frombuffer(b"".join(b.column(0).to_pylist()), np.uint64)
            total += np.bincount((h >> np.uint64(64 - RARITY_BITS)).astype(np.int64), minlength=len(total))
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at, pa.int32()), pa.array(total[at], pa.int64())], names=["slot", "n"])

    counts = rows.select("hashes").mapInArrow(tally, "slot int, n long").groupBy("slot").agg(F.sum("n").alias("n")).toPandas()  # 2 ** RARITY_BITS rows at most
    level = np.zeros(1 << RARITY_BITS, np.uint8)
    level[counts["slot"].to_numpy()] = np.ceil(4 * np.log2(counts["n"].to_numpy())).astype(np.uint8)

    def entries(batches: Iterator) -> Iterator:
        import pyarrow as pa

        for b in batches:
            keys = [rare_prefix(np.frombuffer(h, np.uint64), level, num, den).view(np.int64) for h in b.column("hashes").to_pylist()]
            at = pa.array(np.repeat(np.arange(len(keys)), [len(k) for k in keys]), pa.int64())
            cols = [b.column(c).take(at) for c in ("id", "label", "size")]
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(keys) if keys else [], pa.int64()), *cols], names=["key", "id", "label", "size"])

    all_ = cut(rows.select("id", "label", "size", "hashes").mapInArrow(entries, "key long, id long, label long, size long"))
    told = [F.count(F.lit(1)).alias("n"), F.bit_xor(F.xxhash64("id")).alias("x"), F.bit_xor(F.xxhash64("id", F.lit(1))).alias("y")]
    mixed = all_.groupBy("key").agg(*told, F.min("label").alias("lo"), F.max("label").alias("hi")).where("lo <> hi")
    return all_.join(mixed.groupBy("n", "x", "y").agg(F.min("key").alias("key")).select("key"), "key", "left_semi")


def near_duplicates(docs: DataFrame, *, num: int = 80, den: int = 100, shingle: int = 5, id_col: str = "doc_id", text_col: str = "text", small: int = SMALL, block: int = BLOCK, wide: int = WIDE) -> DataFrame:
    """doc_id, n_shingles, component_id and kept of each row.

    Rows are linked if den * |intersection| >= num * |union| of their sets of shingles; a component's
    id is the smallest id in it, and the row with that id is kept. Null, empty and blank texts have
    no shingles and are linked with nothing. A null id is linked with nothing and kept. Rows that
    share an id are one vertex with the links of all their texts. Ids are whole numbers, or of a type that
    casts to them: one that doesn't fails the job. An empty table gives no rows. Other columns are not read.
    """
    spark = docs.sparkSession
    small_batches(spark)
    threshold = num / den
    bands, most = n_bands(threshold), sketch_cut(threshold)
    texts = docs.select(F.col(id_col).cast("long").alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))

    def sign(batches: Iterator) -> Iterator:
        import pyarrow as pa
        from xxhash import xxh3_128_digest

        for b in batches:
            n, digest, keys, odd = [], [], [], []
            for t in b.column("text").to_pylist():
                s = shingle_hashes(t, shingle)
                n.append(len(s))
                digest.append(xxh3_128_digest(s.tobytes()) if len(s) else None)
                k, o = signature(s, bands) if len(s) else (None, (None,) * 4)
                keys.append(k)
                odd.append(o)
            cols = [b.column("id"), pa.array(n, pa.int64()), pa.array(digest, pa.binary()), pa.array(keys, pa.list_(pa.int64())), *(pa.array(list(c), pa.int64()) for c in zip(*odd))]
            yield pa.RecordBatch.from_arrays(cols, names=["id", "n", "digest", "bands", "s0", "s1", "s2", "s3"])

    base = shared_dir(spark)
    texts.mapInArrow(sign, "id long, n long, digest binary, bands array<long>, s0 long, s1 long, s2 long, s3 long").write.parquet(f"{base}/signs")
    signs = spark.read.parquet(f"{base}/signs")

    copies = signs.where("n > 0 and id is not null").groupBy("digest").agg(F.min("id").alias("rep"), F.count(F.lit(1)).alias("copies")).withColumn("v", F.col("rep"))
    # sets that more than a ten-thousandth of the rows have: at most 10,000, and their rows are spared a shuffle by the digest
    hot = cut(copies.where(F.col("copies") > max(HOT_ROWS, int(signs.count() * HOT_SHARE))).select(F.col("digest").alias("hot_digest")))
    classes = copies.drop("copies")
    # ids with several texts: a class whose smallest id is another's too gets a vertex of its own, above all ids
    several = cut(signs.where("id is not null").groupBy("id").agg(F.min(F.coalesce("digest", F.lit(b""))).alias("lo"), F.max(F.coalesce("digest", F.lit(b""))).alias("hi")).where("lo <> hi").select("id"))
    repeated = several.limit(1).count() > 0
    if repeated:
        top = signs.agg(F.max("id")).first()[0]
        order = F.row_number().over(Window.partitionBy("rep").orderBy("digest"))
        ranked = cut(classes.select("digest", "rep").withColumn("k", order))
        classes = cut(ranked.withColumn("v", F.when(F.col("k") == 1, F.col("rep")).otherwise(F.lit(top + 1) + F.monotonically_increasing_id())).select("digest", "rep", "v"))
    words = ["s0", "s1", "s2", "s3"]
    reps = cut(
        signs.where("n > 0").join(classes.withColumnRenamed("digest", "d"), (F.col("digest") == F.col("d")) & (F.col("id") == F.col("rep"))).select(F.col("v").alias("id"), "bands", *words, F.col("n").alias("size")).dropDuplicates(["id"])
    )
    sketches = reps.select("id", *words, "size")

    def n_blocks(n: Column, size: Column) -> Column:
        return F.ceil(F.greatest(n / block, size / HASHES)).cast("long")

    entries = reps.select("id", F.explode("bands").alias("key"))
    buckets = entries.groupBy("key").agg(F.count(F.lit(1)).alias("n"), F.min("id").alias("first")).where("n > 1")
    members = cut(entries.join(buckets, "key"))

    def near(rows: list[tuple]) -> Iterator[tuple]:
        """(centre, member, size) of each group of sketches that agree, of a bucket's (key, id, s0 .. s3, size)."""
        ids = [r[1] for r in rows]
        o = np.array([r[2:6] for r in rows], np.int64).view(np.uint64)  # counts would take absolute values
        differ = np.bitwise_count(o[:, None, :] ^ o[None, :, :]).sum(2)
        label = _labels(differ <= most)
        for k, x in enumerate(label):
            c = min(i for i, y in zip(ids, label) if y == x)
            if ids[k] != c:
                yield c, ids[k], rows[k][6]

    few = members.where(F.col("n") <= small).select("key", "id").join(sketches, "id").select("key", "id", *words, "size")
    pairs = _by_groups(few, ["key"], near, "centre long, id long, size long")
    far = sketches.select(F.col("id").alias("first"), *[F.col(w).alias(f"f{k}") for k, w in enumerate(words)])
    bits = sum((F.bit_count(F.col(w).bitwiseXOR(F.col(f"f{k}"))) for k, w in enumerate(words)), F.lit(0))
    many = members.where(F.col("n") > small).select("key", "id", "first")
    stars = many.select("id", "first").distinct().where("id <> first").join(sketches, "id").join(far, "first").where(bits <= most).select(F.col("first").alias("centre"), "id", "size")
    groups = cut(pairs.unionByName(stars).distinct())
    size = groups.groupBy("centre").agg(n_blocks(F.count(F.lit(1)), F.sum("size")).alias("parts"))
    size = cut(size)
    several_parts = broadcast_if_small(size.where("parts > 1").withColumnRenamed("centre", "c"), BROADCAST_ROWS)
    sized = groups.join(several_parts, F.col("centre") == F.col("c"), "left")
    placed = sized.select("centre", F.pmod(F.xxhash64("id"), F.coalesce("parts", F.lit(1))).alias("part"), "id")
    placed = placed.unionByName(size.select("centre", F.explode(F.sequence(F.lit(0).cast("long"), F.col("parts") - 1)).alias("part"), F.col("centre").alias("id")))

    # a group of several parts is compared with its centre only: its small buckets go on with the large ones
    parted = sized.where("parts is not null").select("id").distinct()
    large = cut(many.select("key", "id").unionByName(few.select("key", "id").join(parted, "id", "left_semi").select("key", "id")))
    wanted = groups.select("id").unionByName(groups.select(F.col("centre").alias("id"))).unionByName(large.select("id")).distinct()

    def whole(batches: Iterator) -> Iterator:
        import pyarrow as pa
        from xxhash import xxh3_128_digest

        for b in batches:
            sets = [shingle_hashes(t, shingle).tobytes() for t in b.column("text").to_pylist()]
            digests = [[xxh3_128_digest(s) for s in sets]] if repeated else []
            yield pa.RecordBatch.from_arrays([b.column("id"), pa.array(sets, pa.binary()), *(pa.array(d, pa.binary()) for d in digests)], names=["id", "hashes"] + ["digest"] * len(digests))

    if repeated:
        wanted = wanted.join(classes.select(F.col("v").alias("id"), "rep"), "id").select(F.col("rep").alias("id")).distinct()
    texts.join(wanted, "id", "left_semi").mapInArrow(whole, "id long, hashes binary" + ", digest binary" * repeated).write.parquet(f"{base}/sets")
    sets = spark.read.parquet(f"{base}/sets")
    if repeated:
        owners = classes.select(F.col("digest").alias("d"), "rep", "v")
        sets = cut(sets.join(owners, (F.col("digest") == F.col("d")) & (F.col("id") == F.col("rep"))).select(F.col("v").alias("id"), "hashes").dropDuplicates(["id"]))

    def confirm(n_keys: int) -> Callable[[list[tuple]], Iterator[tuple]]:
        def f(rows: list[tuple]) -> Iterator[tuple]:
            ids = [r[n_keys] for r in rows]
            label = _labels(linked_sets([np.frombuffer(r[n_keys + 1], np.uint64) for r in rows], num, den))
            least: dict[int, int] = {}
            for i, x in zip(ids, label):
                least[x] = min(i, least.get(x, i))
            for i, x in zip(ids, label):
                if i != least[x]:
                    yield i, least[x]

        return f

    links = cut(_by_groups(placed.join(sets, "id").select("centre", "part", "id", "hashes"), ["centre", "part"], confirm(2), "a long, b long"))
    if repeated:
        links = cut(links.unionByName(signs.select("id", "digest").join(several, "id").join(classes, "digest").select(F.col("id").alias("a"), F.col("v").alias("b")).distinct()))
    labels = components(links)

    main = F.when(F.col("top.n") > block, F.col("top.label"))

    def opened(at: DataFrame) -> DataFrame:
        """Buckets of several components, the largest of each, and the number of blocks of the rows outside and inside it."""
        per = at.groupBy("key", "label").agg(F.count(F.lit(1)).alias("n"), F.sum("size").alias("size"))
        kinds = per.groupBy("key").agg(F.count(F.lit(1)).alias("parts"), F.sum("n").alias("n"), F.sum("size").alias("size"), F.max(F.struct("n", "label", "size")).alias("top")).where("parts > 1").withColumn("main", main)
        inside = lambda c: F.when(F.col("main").isNotNull(), F.col(f"top.{c}")).otherwise(0)
        n_in = F.when(F.col("main").isNotNull(), n_blocks(F.col("top.n"), F.col("top.size"))).otherwise(0)
        return cut(kinds.select("key", "main", n_blocks(F.col("n") - inside("n"), F.col("size") - inside("size")).alias("n_out"), n_in.cast("long").alias("n_in")))

    at = cut(large.join(labels.withColumnRenamed("v", "id"), "id", "left").join(reps.select("id", "size"), "id").select("key", "id", F.coalesce("label", "id").alias("label"), "size"))
    open_ = opened(at)
    split = open_.where(F.col("n_out") > wide).select("key")
    if split.limit(1).count():
        loose = at.join(split, "key", "left_semi").select("id", "label", "size").distinct()
        anew = by_rare_shingles(loose.join(sets.select("id", "hashes"), "id"), num, den)
        at = cut(at.join(split, "key", "left_anti").unionByName(anew))
        open_ = opened(at)
    if open_.limit(1).count():
        rest = (
            at.join(open_, "key")
            .withColumn("inside", F.coalesce(F.col("label") == F.col("main"), F.lit(False)))
            .withColumn("own", F.pmod(F.xxhash64("id"), F.when(F.col("inside"), F.col("n_in")).otherwise(F.col("n_out"))))
        )
        outs, ins = F.sequence(F.lit(0).cast("long"), F.col("n_out") - 1), F.when(F.col("n_in") > 0, F.sequence(F.lit(0).cast("long"), F.col("n_in") - 1)).otherwise(F.array().cast("array<bigint>"))
        with_outs = F.transform(outs, lambda j: F.struct(F.least("own", j).alias("i"), F.greatest("own", j).alias("j"), F.lit(0).cast("long").alias("side")))
        with_ins = F.transform(ins, lambda j: F.struct(F.col("own").alias("i"), j.alias("j"), F.lit(1).cast("long").alias("side")))
        inner = F.transform(outs, lambda i: F.struct(i.alias("i"), F.col("own").alias("j"), F.lit(1).cast("long").alias("side")))
        blocks = rest.withColumn("b", F.explode(F.when(F.col("inside"), inner).otherwise(F.concat(with_outs, with_ins)))).select("key", "b.side", "b.i", "b.j", "id", "label")

        def screened(rows: list[tuple]) -> Iterator[tuple]:
            """The rows of a pair of blocks that have a partner in another component whose sketch agrees."""
            o, label = np.array([r[6:10] for r in rows], np.int64).view(np.uint64), np.array([r[5] for r in rows])
            differ = np.bitwise_count(o[:, None, :] ^ o[None, :, :]).sum(2)
            for k in np.flatnonzero(((differ <= most) & (label[:, None] != label[None, :])).any(1)):
                yield rows[k][:5]

        keys = ["key", "side", "i", "j"]
        left = _by_groups(blocks.join(sketches, "id").select(*keys, "id", "label", *words), keys, screened, "key long, side long, i long, j long, id long")
        more = _by_groups(left.join(sets, "id").select(*keys, "id", "hashes"), keys, confirm(4), "a long, b long")
        labels = components(links.unionByName(cut(more)))

    # rows of hot sets get their vertex and label by broadcast; they, and rows without a set or id, are spread evenly
    heads = cut(classes.join(broadcast_if_small(hot, int(1 / HOT_SHARE)), F.col("digest") == F.col("hot_digest")).join(labels.withColumnRenamed("v", "w"), F.col("v") == F.col("w"), "left").select("hot_digest", F.col("v").alias("hot_v"), F.col("label").alias("hot_label")))
    rows = signs.select("id", "n", "digest").join(broadcast_if_small(heads, int(1 / HOT_SHARE)), F.col("digest") == F.col("hot_digest"), "left")
    spread = -1 - F.monotonically_increasing_id()
    cold = F.col("hot_v").isNull() & F.col("digest").isNotNull()
    rows = rows.withColumn("by", F.when(cold, F.col("digest")).otherwise(F.lpad(spread.cast("string"), 24, " ").cast("binary")))
    found = rows.join(classes.select(F.col("digest").alias("by"), F.col("v").alias("cold_v")), "by", "left").withColumn("v", F.coalesce("cold_v", F.when(F.col("hot_v").isNull(), F.col("id"))))
    found = found.withColumn("at", F.coalesce("v", spread)).join(labels.select(F.col("v").alias("at"), "label"), "at", "left")
    found = found.withColumn("label", F.when(F.col("hot_v").isNull(), F.when(F.col("v").isNotNull(), F.col("label"))).otherwise(F.col("hot_label"))).withColumn("v", F.coalesce("v", "hot_v"))
    component = F.when(F.col("id").isNotNull(), F.coalesce("label", "v"))
    return found.select(F.col("id").alias("doc_id"), F.col("n").alias("n_shingles"), component.alias("component_id"), component.eqNullSafe(F.col("id")).alias("kept"))


def op2_minhash_odd_sketches(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents"), num=85)
