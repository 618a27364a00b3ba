"""Exact Jaccard join of word-shingle sets by PartEnum signatures, and the components of its links.

Sets are put in bands of sizes; a set takes part in its own band and, as the smaller side, in the next one. In a band
two similar sets differ in at most ``K`` elements. The domain is dealt into blocks, more than ``K / 2`` of them, so some
blocks hold at most one difference; each block has two parts, and every subset of one part is a signature: in such a
block one of them is equal for both sets. Signatures are candidates only; every link is verified on the sets.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gridframe.llm.components import components
from gridframe.llm.idmap import IdMap, id_map
from gridframe.llm.textbytes import ASCII_LOWER, Words, blocks, mix, powers, window_hashes
from gridframe.session import cut

#: Similarity as a fraction: two sets link when DEN * |A n B| >= NUM * |A u B|.
NUM, DEN = 4, 5
#: Blocks beyond the least number, so that parts without elements need not be signatures.
SLACK = 1.2
#: Groups of up to this many sets give all pairs at once.
SMALL = 16

_BITS = np.uint64((1 << 48) - 1)
_PACKED = "bucket int, entries binary, docs binary, doc_id long, n int, least int, d1 long, d2 long, sketch array<long>"
_FOUND = "kind int, a long, b long, n int, least int, d1 long, d2 long, sketch array<long>"
INFO, PAIR, GROUP = 0, 1, 2
_ANY = 1 << 30


def shingle_sets(column: pa.Array, size: int = 5) -> tuple[np.ndarray, np.ndarray]:
    """(text, element) of the distinct shingles of each text, sorted; at most 65,536 texts.

    Words are lower-cased over A-Z. A text of fewer words than ``size`` has its whole sequence as its one shingle; one
    without words has none. Elements are 48-bit hashes.
    """
    words = Words(column, fold=ASCII_LOWER)
    hashes, of = words.hashes(), words.text_of_word()
    shingles = window_hashes(hashes, size)
    inside = of[: len(shingles)] == of[size - 1 :] if len(shingles) else np.zeros(0, dtype=bool)
    counts = np.diff(words.of_text)
    short = np.flatnonzero((counts > 0) & (counts < size))
    tails = np.zeros(len(short), dtype="uint64")
    for i, factor in enumerate(powers(size)):
        more = counts[short] > i
        tails[more] += hashes[words.of_text[short[more]] + i] * factor
    tails = mix(tails + counts[short].astype("uint64"))
    text = np.concatenate([of[: len(shingles)][inside], short]).astype("uint64")
    value = np.concatenate([shingles[inside], tails]) >> np.uint64(16)
    key = np.sort((text << np.uint64(48)) | value)
    key = key[np.append(True, key[1:] != key[:-1])] if len(key) else key
    return (key >> np.uint64(48)).astype("int64"), key & _BITS


def _bands(most: int) -> tuple[np.ndarray, np.ndarray]:
    """Smallest and largest size of each band up to the one after that of ``most``."""
    low, high, spare = [1], [1], 2
    while spare:
        low.append(high[-1] + 1)
        high.append(low[-1] * DEN // NUM)
        spare -= high[-1] >= most
    return np.array(low), np.array(high)


def _slices(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    for part in blocks(batch, most_bytes=2_000_000):
        for start in range(0, part.num_rows, 60_000):
            yield part.slice(start, 60_000)


def _sum(values: np.ndarray, of: np.ndarray, rows: int) -> np.ndarray:
    out = np.zeros(rows, dtype="uint64")
    np.add.at(out, of, values)
    return out


def _signatures(doc: np.ndarray, value: np.ndarray, n: np.ndarray, upper: bool) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(document, signature) of each set in its own band, or in the next one where it can have larger partners; and how
    many signatures a set shares at least with any that it links to in the band.

    Of the blocks, at most ``K / 2`` have two differences; each other one has a part equal in both sets, which is a
    signature unless it is empty in both.
    """
    low, high = _bands(int(n.max()))
    band = np.searchsorted(high, n)
    takes_part = n > 0
    if upper:
        takes_part &= n * DEN // NUM > high[band]
        band = band + 1
    most = 2 * high[band] * (DEN - NUM) // (DEN + NUM)
    n_blocks = np.maximum(1, np.ceil(SLACK * (most // 2 + 1)).astype("int64"))
    good = n_blocks - most // 2
    n_blocks[~takes_part] = 0
    parts = 2 * n_blocks
    offset = np.cumsum(parts) - parts
    use = takes_part[doc]
    doc, value = doc[use], value[use]
    draw = mix(value ^ (band[doc].astype("uint64") << np.uint64(50)))
    place = ((draw >> np.uint64(32)) * parts[doc].astype("uint64") >> np.uint64(32)).astype("int64")
    total = int(parts.sum())
    content = _sum(mix(value + np.uint64(0x9E3779B9)), offset[doc] + place, total)
    owner = np.repeat(np.arange(len(n)), parts)
    part = np.arange(total) - offset[owner]
    empty = content == 0
    with_empty = np.bincount(owner[::2][empty[::2] | empty[1::2]], minlength=len(n))
    keep = ~empty | (with_empty >= good)[owner]
    signature = mix(content + mix((band[owner].astype("uint64") << np.uint64(32)) | part.astype("uint64")))
    least = np.where(takes_part, np.maximum(good - with_empty, 1), _ANY)
    return owner[keep], signature[keep], least


def _sketches(doc: np.ndarray, value: np.ndarray, n: np.ndarray) -> pa.Array:
    """Parities of the elements in each of 2^i places, two for each element or more, as words of 64 bits.

    Two sets differ in at least as many elements as their sketches in bits. Folding a sketch in half, by exclusive or,
    gives the sketch of half the length.
    """
    bits = 1 << np.maximum(np.ceil(np.log2(np.maximum(2 * n, 1))).astype("int64"), 6)
    ends = np.append(0, np.cumsum(bits))
    place = ends[doc] + (value & (bits[doc] - 1).astype("uint64")).astype("int64")
    parity = (np.bincount(place, minlength=int(ends[-1])) & 1).astype("uint8")
    words = np.packbits(parity, bitorder="little").view("int64")
    return pa.ListArray.from_arrays((ends // 64).astype("int32"), pa.array(words))


def _pack(buckets: int):
    """Each slice's signatures, one row per bucket, and one row per document with size, digest and sketch."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in _slices(batch):
                ids = part.column("doc_id").to_numpy(zero_copy_only=False)
                doc, value = shingle_sets(part.column("text"))
                n = np.bincount(doc, minlength=len(ids))
                d1 = _sum(mix(value + np.uint64(1 << 50)), doc, len(ids))
                d2 = _sum(mix(value + np.uint64(1 << 51)), doc, len(ids))
                lists = _sketches(doc, value, n)
                spread = (mix(ids.view("uint64")) % np.uint64(buckets)).astype("int32")
                # Equal sets of a slice send their signatures once.
                order = np.lexsort((d2, d1, n))
                first = np.zeros(len(ids), dtype=bool)
                first[order] = np.append(True, (d1[order][1:] != d1[order][:-1]) | (d2[order][1:] != d2[order][:-1]) | (n[order][1:] != n[order][:-1]))
                chosen = first[doc]
                sizes = np.where(first, n, 0)
                known = [_signatures(doc[chosen], value[chosen], sizes, upper) for upper in (False, True)] if len(value) else []
                least = np.minimum(known[0][2], known[1][2]) if known else np.full(len(ids), _ANY)
                nothing = pa.nulls(len(ids), pa.binary())
                yield pa.RecordBatch.from_arrays(
                    [pa.array(spread), nothing, nothing, pa.array(ids), pa.array(n.astype("int32")), pa.array(least.astype("int32")),
                     pa.array(d1.view("int64")), pa.array(d2.view("int64")), lists],
                    names=[f.split()[0] for f in _PACKED.split(", ")],
                )
                if not known:
                    continue
                owner, signature = (np.concatenate([k[i] for k in known]) for i in (0, 1))
                bucket = (signature >> np.uint64(32)) % np.uint64(buckets)
                key = np.unique((bucket << np.uint64(48)) | ((signature & np.uint64(0xFFFFFFFF)) << np.uint64(16)) | owner.astype("uint64"))
                of = (key >> np.uint64(48)).astype("int64")
                cuts = np.flatnonzero(np.append(True, of[1:] != of[:-1]))
                entries, tables = [], []
                for a, b in zip(cuts, np.append(cuts[1:], len(key))):
                    used, local = np.unique((key[a:b] & np.uint64(0xFFFF)).astype("int64"), return_inverse=True)
                    packed = (key[a:b] & ~np.uint64(0xFFFF)) | local.astype("uint64")
                    entries.append(np.ascontiguousarray(packed.view("uint8").reshape(-1, 8)[:, :6]).tobytes())
                    tables.append(ids[used].tobytes())
                k = len(cuts)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(of[cuts].astype("int32")), pa.array(entries, pa.binary()), pa.array(tables, pa.binary()),
                     pa.nulls(k, pa.int64()), pa.nulls(k, pa.int32()), pa.nulls(k, pa.int32()), pa.nulls(k, pa.int64()),
                     pa.nulls(k, pa.int64()), pa.nulls(k, pa.list_(pa.int64()))],
                    names=[f.split()[0] for f in _PACKED.split(", ")],
                )

    return run


def _found(kind: int, a: np.ndarray, b: np.ndarray, n: np.ndarray) -> pa.RecordBatch:
    k = len(a)
    return pa.RecordBatch.from_arrays(
        [pa.array(np.full(k, kind, dtype="int32")), pa.array(a), pa.array(b), pa.array(n.astype("int32")), pa.nulls(k, pa.int32()),
         pa.nulls(k, pa.int64()), pa.nulls(k, pa.int64()), pa.nulls(k, pa.list_(pa.int64()))],
        names=[f.split()[0] for f in _FOUND.split(", ")],
    )


def _match(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pairs and large groups of a partition sorted by bucket; document rows pass through."""
    bucket, held = None, []
    for batch in batches:
        info = batch.filter(batch.column("entries").is_null())
        if info.num_rows:
            kind = pa.array(np.full(info.num_rows, INFO, dtype="int32"))
            yield pa.RecordBatch.from_arrays(
                [kind, info.column("doc_id"), pa.nulls(info.num_rows, pa.int64()), *[info.column(c) for c in ("n", "least", "d1", "d2", "sketch")]],
                names=[f.split()[0] for f in _FOUND.split(", ")],
            )
        packed = batch.filter(batch.column("entries").is_valid())
        for at, entries, table in zip(packed.column("bucket").to_pylist(), packed.column("entries"), packed.column("docs")):
            if at != bucket and held:
                yield from _bucket(bucket, held)
                held = []
            bucket = at
            raw = np.frombuffer(entries.as_buffer(), dtype="uint8").reshape(-1, 6)
            wide = np.zeros((len(raw), 8), dtype="uint8")
            wide[:, :6] = raw
            key = wide.view("uint64").ravel()
            docs = np.frombuffer(table.as_buffer(), dtype="int64")
            held.append(((key >> np.uint64(16)).astype("uint32"), docs[(key & np.uint64(0xFFFF)).astype("int64")]))
    if held:
        yield from _bucket(bucket, held)


def _bucket(bucket: int, held: list) -> Iterator[pa.RecordBatch]:
    """Pairs with the number of signatures they share here, and the members of larger groups with the group's size."""
    value, doc = map(np.concatenate, zip(*held))
    order = np.argsort(value, kind="stable")
    value, doc = value[order], doc[order]
    first = np.flatnonzero(np.append(True, value[1:] != value[:-1]))
    size = np.diff(np.append(first, len(value)))
    shared = np.repeat(size > 1, size)
    value, doc = value[shared], doc[shared]
    if not len(value):
        return
    order = np.lexsort((doc, value))
    value, doc = value[order], doc[order]
    new = np.append(True, (value[1:] != value[:-1]) | (doc[1:] != doc[:-1]))
    value, doc = value[new], doc[new]
    first = np.flatnonzero(np.append(True, value[1:] != value[:-1]))
    size = np.diff(np.append(first, len(value)))
    left, right = [], []
    small = np.repeat(size <= SMALL, size)
    for step in range(1, SMALL):
        i = np.flatnonzero((value[step:] == value[:-step]) & small[step:])
        left.append(i)
        right.append(i + step)
    head = np.repeat(first, size)
    star = np.flatnonzero(~small & (head != np.arange(len(value))))
    left, right = np.concatenate([*left, head[star]]), np.concatenate([*right, star])
    names, number = np.unique(doc, return_inverse=True)
    pair, times = np.unique((number[left].astype("uint64") << np.uint64(32)) | number[right].astype("uint64"), return_counts=True)
    for start in range(0, len(pair), 100_000):
        part = pair[start : start + 100_000]
        ends = names[(part >> np.uint64(32)).astype("int64")], names[(part & np.uint64(0xFFFFFFFF)).astype("int64")]
        yield _found(PAIR, *ends, times[start : start + 100_000])
    large, members = np.flatnonzero(~small), np.repeat(size, size)
    for start in range(0, len(large), 100_000):
        part = large[start : start + 100_000]
        yield _found(GROUP, (np.int64(bucket) << np.int64(32)) | value[part].astype("int64"), doc[part], members[part])


def _across(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pairs of different components in groups sorted by group, unless their sizes or sketches rule a link out."""

    def pairs(table: pa.Table) -> Iterator[pa.RecordBatch]:
        table = table.combine_chunks()
        doc, part, n = (table[c].to_numpy() for c in ("doc", "component", "n"))
        words = [np.array(x, dtype="int64").view("uint64") for x in table["sketch"].to_pylist()]
        shortest = min(map(len, words))
        flat = np.array([np.bitwise_xor.reduce(x.reshape(-1, shortest), axis=0) for x in words])
        for i in range(len(doc) - 1):
            rest = slice(i + 1, None)
            fits = (part[rest] != part[i]) & (NUM * np.maximum(n[rest], n[i]) <= DEN * np.minimum(n[rest], n[i]))
            j = np.flatnonzero(fits) + i + 1
            apart = np.bitwise_count(flat[j] ^ flat[i]).sum(1)
            j = j[(DEN + NUM) * apart.astype("int64") <= (DEN - NUM) * (n[j].astype("int64") + n[i])]
            if len(j):
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.minimum(doc[j], doc[i])), pa.array(np.maximum(doc[j], doc[i]))], names=["a", "b"]
                )

    held = None
    for batch in batches:
        table = pa.Table.from_batches([batch])
        key = batch.column("sig").to_numpy()
        cuts = np.flatnonzero(np.append(True, key[1:] != key[:-1])).tolist() + [len(key)]
        for a, b in zip(cuts[:-1], cuts[1:]):
            piece = table.slice(a, b - a)
            if held is not None and held["sig"][0].as_py() == int(key[a]):
                held = pa.concat_tables([held, piece])
            else:
                if held is not None:
                    yield from pairs(held)
                held = piece
    if held is not None:
        yield from pairs(held)


def _sets(wanted: IdMap):
    """Sets of the documents whose place in the map is wanted."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            chosen = batch.filter(pa.array(wanted.holds(batch.column("place").to_numpy())))
            for part in _slices(chosen):
                doc, value = shingle_sets(part.column("text"))
                ends = np.searchsorted(doc, np.arange(part.num_rows + 1)).astype("int32")
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), pa.ListArray.from_arrays(ends, pa.array(value.view("int64")))], names=["doc_id", "items"]
                )

    return run


def _linked(pairs: DataFrame, docs: DataFrame) -> DataFrame:
    """The pairs whose sets are similar enough, by their intersection.

    A bit map of bounded size tells which documents may be in a pair; only their sets are made and shuffled. Where the
    map is too small for the pairs, more sets move and the result is the same, as the join is by id.
    """
    wanted = id_map(pairs.select(F.col("a").alias("doc_id")).union(pairs.select("b")))
    places = docs.select("doc_id", "text", wanted.place("doc_id").alias("place"))
    sets = places.mapInArrow(_sets(wanted), "doc_id long, items array<long>")
    left = pairs.join(sets.select(F.col("doc_id").alias("a"), F.col("items").alias("x")), "a")
    both = left.join(sets.select(F.col("doc_id").alias("b"), F.col("items").alias("y")), "b")
    common = F.size(F.array_intersect("x", "y"))
    return both.where(DEN * common >= NUM * (F.size("x") + F.size("y") - common)).select("a", "b").distinct()


def _folded(sketch: Column, other: Column) -> Column:
    """A sketch at the length of the other, if that is half of it; sizes of possible links do not lie further apart."""
    half = (F.size(sketch) / 2).cast("int")
    return F.when(
        F.size(sketch) > F.size(other),
        F.zip_with(F.slice(sketch, 1, half), F.slice(sketch, half + 1, half), lambda x, y: x.bitwiseXOR(y)),
    ).otherwise(sketch)


def _sharing(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """Pairs that can share as many signatures as linked sets do: those counted, in ``shared``, and at most all larger
    groups of one of them. One is spared, as two signatures of a set may have one number."""
    for side in ("a", "b"):
        pairs = pairs.join(sets.select(F.col("doc").alias(side), *[F.col(c).alias(f"{c}_{side}") for c in ("n", "least", "groups")]), side)
    sizes = NUM * F.greatest("n_a", "n_b") <= DEN * F.least("n_a", "n_b")
    enough = F.col("shared") + F.least("groups_a", "groups_b") >= F.greatest("least_a", "least_b") - 1
    return pairs.where(sizes & enough).select("a", "b")


def _rarest(groups: DataFrame, sets: DataFrame) -> DataFrame:
    """Group memberships without the most frequent ones of each set, as many as linked sets share for certain but one.

    The rarest signature that two linked sets share has all others that they share behind it, so it stays in both.
    """
    rank = F.row_number().over(Window.partitionBy("doc").orderBy(F.desc("size"), F.desc("sig")))
    ranked = groups.join(sets.select("doc", "least"), "doc").withColumn("rank", rank)
    return ranked.where(F.col("rank") >= F.col("least") - 1).select("sig", "doc")


def _possible(pairs: DataFrame, info: DataFrame) -> DataFrame:
    """Pairs of different sets whose sizes and parity sketches leave a link possible."""
    side = lambda s: info.select(F.col("doc").alias(s), F.col("n").alias(f"n{s}"), F.col("sketch").alias(f"s{s}"))
    sizes = NUM * F.greatest("na", "nb") <= DEN * F.least("na", "nb")
    both = pairs.join(side("a"), "a").join(side("b"), "b").where(sizes)
    a, b = _folded(F.col("sa"), F.col("sb")), _folded(F.col("sb"), F.col("sa"))
    apart = F.aggregate(F.zip_with(a, b, lambda x, y: F.bit_count(x.bitwiseXOR(y)).cast("int")), F.lit(0), lambda x, y: x + y)
    return both.where((DEN + NUM) * apart <= (DEN - NUM) * (F.col("na") + F.col("nb"))).select("a", "b")


def _apart(pairs: DataFrame, parts: DataFrame) -> DataFrame:
    """The pairs that do not lie in one component yet."""
    for side in ("a", "b"):
        named = parts.select(F.col("node").alias(side), F.col("component").alias(f"c{side}"))
        pairs = pairs.join(named, side, "left").withColumn(f"c{side}", F.coalesce(f"c{side}", side))
    return pairs.where("ca <> cb").select("a", "b")


def similar_components(docs: DataFrame, buckets: int | None = None) -> DataFrame:
    """``doc_id, n_shingles, component_id`` of documents (``doc_id, text``) linked by Jaccard similarity of 0.8 or more.

    ``component_id`` is the smallest id reachable over links. A null or blank text has no shingle and no link. Rows of
    equal id count as one document each; null ids have a null component. Other columns are ignored.

    Signatures travel packed, one row per slice of documents and bucket. Equal sets meet by a digest, never as pairs.
    The signature matches are kept on the executors' disks while they are read; a lost part is made again.
    Signature groups of up to SMALL sets give all pairs; larger ones give pairs with their first set, and, once linked
    sets share a component, every pair across the components that are left. So no link is lost, and a group of near
    copies is compared once per set and signature at most. Linked sets share a known number of signatures at least:
    pairs that cannot reach it, and the most frequent signatures that it makes needless, go before anything else is
    joined to them. Sizes and parity sketches then rule out pairs; sets are fetched for the documents of the others only.
    """
    spark = docs.sparkSession
    buckets = buckets or 2 * int(spark.conf.get("spark.sql.shuffle.partitions"))
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    known = docs.where("doc_id IS NOT NULL")
    packed = known.mapInArrow(_pack(buckets), _PACKED)
    dealt = packed.repartitionById(buckets, F.col("bucket")).sortWithinPartitions("bucket")
    found = dealt.mapInArrow(_match, _FOUND).persist(StorageLevel.DISK_ONLY)

    info = found.where(f"kind = {INFO}").select(F.col("a").alias("doc_id"), "n", "least", "d1", "d2", "sketch")
    digest = F.struct("n", "d1", "d2")
    one = [F.min("doc_id").alias("doc"), F.min("least").alias("least"), F.first("sketch").alias("sketch")]
    heads = info.where("n > 0").groupBy(digest.alias("digest")).agg(*one)
    heads = cut(heads.select("doc", "digest.*", "least", "sketch"))
    member = cut(info.join(heads.select("doc", "n", "d1", "d2"), ["n", "d1", "d2"], "left").select("doc_id", "n", "doc"))
    to_head = member.where("doc IS NOT NULL").select("doc_id", "doc")

    def by_head(df: DataFrame, column: str) -> DataFrame:
        return df.join(to_head.select(F.col("doc_id").alias(column), "doc"), column).drop(column).withColumnRenamed("doc", column)

    groups = by_head(found.where(f"kind = {GROUP}").select(F.col("a").alias("sig"), F.col("n").alias("size"), "b"), "b")
    groups = cut(groups.distinct().withColumnRenamed("b", "doc"))
    sets = heads.select("doc", "n", "least").join(groups.groupBy("doc").agg(F.count("*").alias("groups")), "doc", "left")
    sets = cut(sets.withColumn("groups", F.coalesce("groups", F.lit(0))))
    pairs = found.where(f"kind = {PAIR}").groupBy("a", "b").agg(F.sum("n").alias("n"))
    pairs = by_head(by_head(pairs, "a"), "b").where("a <> b")
    pairs = pairs.groupBy(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).agg(F.sum("n").alias("shared"))
    texts = known.where("text IS NOT NULL")
    possible = cut(_possible(_sharing(pairs, sets), heads))
    # One partner for each set first; the other pairs only where that has left them apart.
    tried = cut(possible.groupBy("b").agg(F.min("a").alias("a")).select("a", "b"))
    edges = cut(_linked(tried, texts))
    parts = components(edges)
    others = cut(_apart(possible.join(tried, ["a", "b"], "left_anti"), parts))
    if not others.isEmpty():
        edges = cut(edges.union(_linked(others, texts)))
        parts = components(edges)

    groups = _rarest(groups, sets).join(parts.withColumnRenamed("node", "doc"), "doc", "left")
    groups = cut(groups.withColumn("component", F.coalesce("component", "doc")))
    mixed = groups.groupBy("sig").agg(F.min("component").alias("low"), F.max("component").alias("high")).where("low < high")
    rest = groups.join(mixed.select("sig"), "sig", "left_semi").join(heads.select("doc", "n", "sketch"), "doc")
    across = rest.repartition("sig").sortWithinPartitions("sig").mapInArrow(_across, "a long, b long")
    more = cut(across.distinct())
    if not more.isEmpty():
        edges = cut(edges.union(_linked(more, texts)))
        parts = components(edges)
    named = member.join(parts.select(F.col("node").alias("doc"), "component"), "doc", "left")
    found.unpersist()
    # A component's name is its smallest set head, and a head is the smallest document of its set.
    named = named.select("doc_id", F.col("n").cast("long").alias("n_shingles"), F.coalesce("component", "doc", "doc_id").alias("component_id"))
    unknown = docs.where("doc_id IS NULL").mapInArrow(_counted, "doc_id long, n_shingles long, component_id long")
    return named.unionByName(unknown)


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Set sizes of rows without an id."""
    for batch in batches:
        for part in _slices(batch):
            doc, _ = shingle_sets(part.column("text"))
            n = np.bincount(doc, minlength=part.num_rows)
            nothing = pa.nulls(part.num_rows, pa.int64())
            yield pa.RecordBatch.from_arrays([nothing, pa.array(n), nothing], names=["doc_id", "n_shingles", "component_id"])
