"""N-gram Jaccard join: size-banded tiles, hashed bitmaps, exact intersection of sorted arrays.

The set of a document is its distinct word shingles, as 64-bit hashes. Sizes are cut into bands; tile i holds the
documents of band i and those of the next that may still be linked with one of them. A linked pair of a tile differs in at
most d shingles, so of the tile's K > d parts of the hash space at least K - d hold the same shingles in both. Each
document emits one key per non-empty part; documents with a common key are candidates. A document with K - d or more
empty parts repeats this with another split of the hash space, after the last of these with its empty parts as well, so
no link is lost.

Candidates of a key form a tree, not all pairs: each block of documents keeps its smallest document as leader, and the
leaders of the blocks meet at the smallest one. So a key of very many documents is one entry per block. Of its edges, a
document is verified with the leader it shares most keys with: bit counts of hashed bitmaps bound the overlap from above,
then sorted arrays are intersected. Keys whose documents are then in different components are open: large ones are tried
again around their best connected document, and what is still apart is compared key by key. A linked pair has not one but many parts in common; how many follows from its sizes and
empty parts. So the keys that two documents share are counted, and only pairs with enough are verified. Keys of very many
documents are not counted: as many as a document has of them are taken off what it needs. A sketch
of 1024 parities per document, in which two documents differ at most as often as in shingles, drops pairs that are not
linked before their sets are looked at. Only documents that then need
none, which have as many such keys as a link needs, are compared tile by tile within their clusters: a tile holds a bounded
number of shingles, and only links leave it, not pairs. Clusters hang together by the rarest of these keys, of which two
documents that link share one: a short passage that very many texts hold makes no cluster alone.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from grainline.llm import tokens
from grainline.llm.batches import planes, unplanes
from grainline.llm.common import settle, whole

BITS = 4096
# Parities of a sketch: 2 to this power.
PARITIES = 10
SEEDS = 4
# Keys of a block of documents that are combined before the shuffle, and keys per shuffled bucket.
BLOCK_KEYS = 1_000_000
BUCKET_KEYS = 1_000_000
# Shingles and documents of a side that one verifying group holds.
GROUP_SHINGLES = 200_000
GROUP_DOCUMENTS = 1000
# Documents of a key up to which the keys of two documents are counted, and rows of keys that one counting group holds.
COUNTED_DOCUMENTS = 64
COUNTED_ROWS = 20_000
# Rounds in which each document is verified with one other; what is then left is verified at once.
ROUNDS = 2


class Tiles:
    """Bands of set sizes for a threshold of ``num`` / ``den``, and the parts of each tile."""

    def __init__(self, num: int, den: int):
        self.num, self.den = num, den

    def band(self, n: int) -> tuple[int, int]:
        """Number and largest size of the band of sets of n shingles."""
        low, k = 1, 0
        while True:
            high = max(low, low * self.den * self.den // (self.num * self.num))
            if n <= high:
                return k, high
            low, k = high + 1, k + 1

    def of(self, n: int) -> list[tuple[int, int, int]]:
        """(tile, parts, least number of parts in common) of the tiles a set of n shingles is in; none if links are copies only."""
        found, (k, high) = [], self.band(n)
        while True:
            differ = high * (self.den - self.num) // self.num
            if n * self.num <= high * self.den and differ:
                parts = differ + 1 + max(1, -(-differ // 6))
                found.append((k, parts, parts - differ))
            low = n
            if k == 0:
                return found
            k, high = self._before(k)
            if low * self.num > high * self.den:
                return found

    @staticmethod
    def differ(parts):
        """The most shingles in which a linked pair of a tile with so many parts (a number or a column) differs."""
        most = (parts - 1) * 6
        return most // 7 if isinstance(parts, int) else F.floor(most / 7)

    def _before(self, k: int) -> tuple[int, int]:
        low = 1
        for _ in range(k - 1):
            low = max(low, low * self.den * self.den // (self.num * self.num)) + 1
        return k - 1, max(low, low * self.den * self.den // (self.num * self.num))


def shingle_sets(texts: pa.Array, size: int):
    """(doc position, hash) of the distinct shingles, sorted by both, and the set size of each text."""
    found = tokens.Words(texts, lower=True)
    hashed = found.hashes()
    start, total = found.windows(size, hashed)
    doc = found.doc[start]
    short = [(d, found.starts[d], n) for d, n in enumerate(found.counts) if 0 < n < size]
    if short:
        extra = np.zeros(len(short), np.uint64)
        for i, (_, a, n) in enumerate(short):
            value = int(n)
            for h in hashed[a : a + n].tolist():
                value = (value * int(tokens.BASE) + h) % (1 << 64)
            extra[i] = value
        total = np.concatenate((total, extra))
        doc = np.concatenate((doc, np.array([d for d, _, _ in short], doc.dtype)))
    total = tokens.mix(total)
    order = np.argsort(total, kind="stable")
    narrow = doc[order].astype(np.uint16) if len(texts) <= 65_536 else doc[order]
    order = order[np.argsort(narrow, kind="stable")]
    doc, total = doc[order], total[order]
    new = np.ones(len(doc), bool)
    new[1:] = (doc[1:] != doc[:-1]) | (total[1:] != total[:-1])
    doc, total = doc[new], total[new]
    return doc, total, np.bincount(doc, minlength=len(texts))


def _part_keys(values, parts, need, tile, seed_first=0):
    """Keys of one sorted set in one tile."""
    keys = []
    for seed in range(seed_first, SEEDS):
        own = values if seed == 0 else np.sort(tokens.mix(values + np.uint64(seed)))
        part = ((own >> np.uint64(32)) * np.uint64(parts)) >> np.uint64(32)
        first = np.flatnonzero(np.concatenate(([True], part[1:] != part[:-1])))
        name = (np.uint64((tile << 8) | seed) << np.uint64(32)) | part[first]
        keys.append(tokens.mix(np.add.reduceat(own, first) + tokens.mix(name)))
        empty = parts - len(first)
        if empty < need:
            break
        if seed == SEEDS - 1:
            gone = np.setdiff1d(np.arange(parts, dtype=np.uint64), part[first])
            keys.append(tokens.mix(tokens.mix((np.uint64((tile << 8) | seed) << np.uint64(32)) | gone) + np.uint64(1)))
    return keys


def document_keys(doc, values, sizes, tiles: Tiles, known: dict):
    """(key, doc position) of all documents of a slice."""
    return shaped_keys(doc, values, sizes, tiles, known)[:2]


def shaped_keys(doc, values, sizes, tiles: Tiles, known: dict):
    """(key, doc position) of all documents of a slice, and per document its band, parts and parts held in two tiles.

    The tiles are that of its own band and the one before; parts are 0 where it is in none.
    """
    keys, owner, shape = [], [], np.zeros((5, len(sizes)), np.int64)
    ends = np.concatenate(([0], np.cumsum(sizes)))
    for d in np.flatnonzero(sizes):
        n = int(sizes[d])
        if n not in known:
            known[n] = tiles.of(n)
        band = shape[0, d] = tiles.band(n)[0]
        for tile, parts, need in known[n]:
            found = _part_keys(values[ends[d] : ends[d + 1]], parts, need, tile)
            shape[1 + 2 * (band - tile) : 3 + 2 * (band - tile), d] = parts, len(found[0])
            for k in found:
                keys.append(k)
                owner.append(np.full(len(k), d))
    if not keys:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64), shape
    return np.concatenate(keys), np.concatenate(owner), shape


def led(keys: np.ndarray, ids: np.ndarray):
    """(key, smallest id) per key, and the edges (key, smallest id, other id)."""
    order = np.lexsort((ids, keys))
    keys, ids = keys[order], ids[order]
    first = np.ones(len(keys), bool)
    first[1:] = keys[1:] != keys[:-1]
    leader = ids[np.flatnonzero(first)[np.cumsum(first) - 1]] if len(keys) else ids
    edge = ids != leader
    edge[1:] &= (ids[1:] != ids[:-1]) | first[1:]
    return keys[first], ids[first], keys[edge], leader[edge], ids[edge]


SHAPE = ("band", "own_parts", "own_held", "before_parts", "before_held")
SCAN = "kind int, doc_id bigint, n bigint, a bigint, b bigint, bucket int, keys binary, ids binary, shape array<int>"


def _scan(size, num, den, buckets):
    at = 0

    def rows(kind, **columns):
        nonlocal at
        n = len(next(iter(columns.values())))
        if "bucket" not in columns:
            # facts and finished edges travel along, spread evenly
            columns["bucket"] = ((at + np.arange(n)) % buckets).astype(np.int32)
            at += n
        kinds = {"doc_id": pa.int64(), "n": pa.int64(), "a": pa.int64(), "b": pa.int64(), "bucket": pa.int32(), "keys": pa.binary(), "ids": pa.binary(), "shape": pa.list_(pa.int32())}
        arrays = [pa.array([kind] * n, "int32")]
        for name, type_ in kinds.items():
            value = columns.get(name)
            arrays.append(pa.nulls(n, type_) if value is None else value if isinstance(value, pa.Array) else pa.array(value, type_))
        return pa.RecordBatch.from_arrays(arrays, ["kind", *kinds])

    def block(held):
        keys, ids, edge_key, parent, child = led(np.concatenate([k for k, _ in held]), np.concatenate([i for _, i in held]))
        if len(edge_key):
            yield rows(2, doc_id=child, n=parent, a=edge_key.view(np.int64))
        bucket = ((keys >> np.uint64(32)) * np.uint64(buckets)) >> np.uint64(32)
        cut = np.flatnonzero(np.concatenate(([True], bucket[1:] != bucket[:-1])))
        ends = [*cut[1:], len(keys)]
        yield rows(1, bucket=bucket[cut].astype(np.int32), keys=[planes(keys[i:j]) for i, j in zip(cut, ends)], ids=[planes(ids[i:j]) for i, j in zip(cut, ends)])

    def run(batches):
        tiles, known, held, n = Tiles(num, den), {}, [], 0
        for batch in batches:
            for part in tokens.slices(batch):
                doc, values, sizes = shingle_sets(part.column("text"), size)
                ends = np.concatenate(([0], np.cumsum(sizes)))
                some = np.flatnonzero(sizes)
                a, b = np.zeros(len(sizes), np.uint64), np.zeros(len(sizes), np.uint64)
                if len(some):
                    a[some], b[some] = np.add.reduceat(values, ends[some]), np.add.reduceat(tokens.mix(values), ends[some])
                named = part.column("doc_id").is_valid().to_numpy(zero_copy_only=False)
                ids = part.column("doc_id").fill_null(0).to_numpy(zero_copy_only=False)
                # equal sets are tied elsewhere; within the slice only the smallest id of a set emits keys
                emit = np.zeros(len(sizes), bool)
                use = np.flatnonzero((sizes > 0) & named)
                use = use[np.lexsort((ids[use], b[use], a[use]))]
                if len(use):
                    emit[use] = np.concatenate(([True], (a[use][1:] != a[use][:-1]) | (b[use][1:] != b[use][:-1])))
                keys, owner, shape = shaped_keys(doc[emit[doc]], values[emit[doc]], np.where(emit, sizes, 0), tiles, known)
                shapes = pa.array(shape.T.astype(np.int32).tolist(), pa.list_(pa.int32()))
                yield rows(0, doc_id=part.column("doc_id"), n=sizes.astype(np.int64), a=a.view(np.int64), b=b.view(np.int64), shape=shapes)
                held.append((keys, ids[owner]))
                n += len(keys)
                if n >= BLOCK_KEYS:
                    yield from block(held)
                    held, n = [], 0
        if n:
            yield from block(held)

    return run


FOUND = "kind int, doc_id bigint, n bigint, a bigint, b bigint, shape array<int>"


def _bucket_edges(table: pa.Table) -> pa.Table:
    """The edges of the keys of a bucket, and all other rows as they are."""
    names = [c.split()[0] for c in FOUND.split(", ")]
    is_keys = pc.equal(table.column("kind"), 1)
    others, packed = table.filter(pc.invert(is_keys)).select(names), table.filter(is_keys)
    if not len(packed):
        return others
    keys = np.concatenate([unplanes(x, np.uint64) for x in packed.column("keys").to_pylist()])
    ids = np.concatenate([unplanes(x, np.int64) for x in packed.column("ids").to_pylist()])
    _, _, key, parent, child = led(keys, ids)
    made = {"kind": np.full(len(key), 2, np.int32), "doc_id": child, "n": parent, "a": key.view(np.int64)}
    arrays = [pa.array(made[f.name], f.type) if f.name in made else pa.nulls(len(key), f.type) for f in others.schema]
    return pa.concat_tables([others, pa.table(arrays, schema=others.schema)])


# Bytes of a shingle in a set that is sent to another task.
SET_BYTES = 6


def packed_set(values: np.ndarray) -> bytes:
    """The first 48 bits of sorted hashes, as steps from one to the next with their bytes transposed: the high ones are few."""
    steps = np.diff(values >> np.uint64(16), prepend=np.uint64(0))
    return np.ascontiguousarray(steps.view(np.uint8).reshape(-1, 8).T[:SET_BYTES]).tobytes()


def unpacked_set(data: bytes) -> np.ndarray:
    held = np.frombuffer(data, np.uint8).reshape(SET_BYTES, -1)
    steps = np.zeros((held.shape[1], 8), np.uint8)
    steps[:, :SET_BYTES] = held.T
    return np.cumsum(steps.reshape(-1).view(np.uint64), dtype=np.uint64) << np.uint64(16)


def parities(doc: np.ndarray, values: np.ndarray, count: int) -> np.ndarray:
    """Per document, as 64-bit words, whether an odd number of its hashes begins with each run of PARITIES bits.

    A shingle that only one of two documents has changes one parity, so they have at most as many different ones as shingles.
    """
    place = (doc.astype(np.int64) << PARITIES) | (values >> np.uint64(64 - PARITIES)).astype(np.int64)
    odd = np.bincount(place, minlength=count << PARITIES).astype(np.uint8) & 1
    return np.packbits(odd.reshape(count, -1), axis=1).view(np.int64)


SETS = "doc_id bigint, n bigint, shingles binary, parities array<bigint>"


def _sets(size):
    def run(batches):
        for batch in batches:
            for part in tokens.slices(batch):
                doc, values, sizes = shingle_sets(part.column("text"), size)
                ends = np.concatenate(([0], np.cumsum(sizes)))
                arrays = [packed_set(values[i:j]) for i, j in zip(ends[:-1], ends[1:])]
                odd = pa.array(list(parities(doc, values, len(sizes))), pa.list_(pa.int64()))
                columns = [part.column("doc_id"), pa.array(sizes, pa.int64()), pa.array(arrays, "binary"), odd]
                yield pa.RecordBatch.from_arrays(columns, ["doc_id", "n", "shingles", "parities"])

    return run


def _bitmaps(sets):
    bits = np.zeros((len(sets), BITS), bool)
    for k, values in enumerate(sets):
        bits[k, values >> np.uint64(64 - 12)] = True
    return np.packbits(bits, axis=1).view(np.uint64)


def _compared(num, den):
    """Links of a tile pair: sets with role 0 against those with role 1, where components differ; one link per component."""

    def run(table: pa.Table) -> pa.Table:
        ids, comps = (table.column(c).to_numpy() for c in ("doc_id", "c"))
        role = table.column("role").to_numpy()
        sets = [unpacked_set(x) for x in table.column("shingles").to_pylist()]
        sizes = np.array([len(x) for x in sets])
        bits = _bitmaps(sets)
        right = np.flatnonzero(role == 1)
        found = set()
        for i in np.flatnonzero(role == 0):
            own, n = sets[i], sizes[i]
            least = -(-num * (n + sizes[right]) // (num + den))
            most = np.minimum(
                n - np.bitwise_count(bits[i] & ~bits[right]).sum(axis=1), sizes[right] - np.bitwise_count(bits[right] & ~bits[i]).sum(axis=1)
            )
            known = set()
            for j, need in zip(right[(most >= least) & (comps[right] != comps[i])], least[(most >= least) & (comps[right] != comps[i])]):
                if comps[j] in known:
                    continue
                other = sets[j]
                at = np.minimum(np.searchsorted(own, other), n - 1)
                if int((own[at] == other).sum()) >= need:
                    known.add(comps[j])
                    found.add((int(ids[i]), int(ids[j])))
        pairs = sorted(found)
        return pa.table({"parent": pa.array([p for p, _ in pairs], "int64"), "child": pa.array([c for _, c in pairs], "int64")})

    return run


def _verify(sets, info, pairs, num, den):
    """parent, child, linked per pair. A parent meets its children in groups of a bounded number of shingles."""
    one = info.select(F.col("doc_id").alias("parent"), F.col("n").alias("pn"), F.col("a").alias("pa"), F.col("b").alias("pb"))
    two = info.select(F.col("doc_id").alias("child"), F.col("n").alias("cn"), F.col("a").alias("ca"), F.col("b").alias("cb"))
    equal = (F.col("pn") == F.col("cn")) & (F.col("pa") == F.col("ca")) & (F.col("pb") == F.col("cb"))
    near = F.least("pn", "cn") * den >= F.greatest("pn", "cn") * num
    # rows that repeat an id have sets of their own: a pair is then looked at if any of them may link
    sized = settle(
        pairs.join(one, "parent").join(two, "child").groupBy("parent", "child")
        .agg(F.max(equal).alias("equal"), F.max(near).alias("near"), F.max("cn").alias("cn")),
        "jaccard-sized",
    )
    done = sized.where("equal or not near").select("parent", "child", F.col("equal").alias("linked"))
    todo = sized.where("near and not equal")
    load = todo.groupBy("parent").agg(F.greatest(F.ceil(F.sum("cn") / GROUP_SHINGLES), F.ceil(F.count("*") / GROUP_DOCUMENTS)).alias("slots"))
    todo = settle(
        todo.join(load, "parent").select("parent", "child", F.pmod(F.xxhash64("child"), F.greatest("slots", F.lit(1))).alias("slot")), "jaccard-todo"
    )
    kids = todo.join(sets, todo["child"] == sets["doc_id"]).select("parent", "slot", "doc_id", F.col("doc_id").alias("c"), F.lit(1).alias("role"), "shingles")
    heads = todo.select("parent", "slot").distinct()
    heads = heads.join(sets, heads["parent"] == sets["doc_id"]).select("parent", "slot", "doc_id", F.col("doc_id").alias("c"), F.lit(0).alias("role"), "shingles")
    yes = kids.unionByName(heads).groupBy("parent", "slot").applyInArrow(_compared(num, den), "parent bigint, child bigint")
    marked = todo.select("parent", "child").join(settle(yes, "jaccard-yes").distinct().withColumn("yes", F.lit(True)), ["parent", "child"], "left")
    return settle(done.unionByName(marked.select("parent", "child", F.coalesce("yes", F.lit(False)).alias("linked"))), "jaccard-verified")


def _labelled(docs: DataFrame, found: DataFrame) -> DataFrame:
    """Add the component ``c`` of each doc_id, itself where it has no link."""
    known = found.select("doc_id", F.col("component_id").alias("__c"))
    return docs.join(known, "doc_id", "left").withColumn("c", F.coalesce("__c", "doc_id")).drop("__c")


def _within_clusters(edges, sets, sizes, found, num, den):
    """Links between different components of the same cluster of keys, by tiles of neighbouring size bands."""
    cluster = components(edges.select("parent", "child").distinct()).select("doc_id", F.col("component_id").alias("cluster"))
    docs = _labelled(cluster.join(sizes, "doc_id"), found)
    largest = docs.groupBy("cluster", "c").agg(F.count("*").alias("m")).groupBy("cluster").agg(
        F.max(F.struct("m", "c"))["c"].alias("top"), F.count("*").alias("parts")
    ).where("parts > 1").drop("parts")
    step = F.lit(2 * np.log(den / num))
    docs = docs.join(settle(largest, "jaccard-largest"), "cluster").select(
        "cluster", "doc_id", "n", "c", (F.col("c") != F.col("top")).alias("minor"), F.floor(F.log("n") / step).alias("band")
    )
    docs = settle(docs, "jaccard-clusters")
    need = lambda rows: F.greatest(F.ceil(F.sum(F.when(rows, F.col("n"))) / GROUP_SHINGLES), F.ceil(F.count_if(rows) / GROUP_DOCUMENTS))
    tiles = docs.groupBy("cluster", "band").agg(need(F.lit(True)).alias("tiles"), need(F.col("minor")).alias("minor_tiles"))
    tiles = settle(tiles, "jaccard-tiles")
    number = lambda seed, count: F.pmod(F.xxhash64("doc_id", F.lit(seed)), count)
    # each minor document to every tile of the neighbouring bands, each document to every minor tile there
    mine = tiles.select("cluster", F.col("band").alias("mband"), "minor_tiles").where("minor_tiles > 0")
    other = tiles.select("cluster", F.explode(F.array(*(F.col("band") + k for k in (-1, 0, 1)))).alias("mband"), F.col("band").alias("aband"), F.col("tiles").alias("all_tiles"))
    pairs = settle(mine.join(other, ["cluster", "mband"]), "jaccard-tile-pairs")
    key = ["cluster", "mband", "aband", "mt", "at"]
    left = docs.where("minor").withColumnRenamed("band", "mband").join(pairs, ["cluster", "mband"])
    left = left.select("cluster", "mband", "aband", number(1, F.col("minor_tiles")).alias("mt"), F.explode(F.sequence(F.lit(0), F.col("all_tiles") - 1)).alias("at"), "doc_id", "c", F.lit(0).alias("role"))
    right = docs.withColumnRenamed("band", "aband").join(pairs, ["cluster", "aband"])
    right = right.select("cluster", "mband", "aband", F.explode(F.sequence(F.lit(0), F.col("minor_tiles") - 1)).alias("mt"), number(2, F.col("all_tiles")).alias("at"), "doc_id", "c", F.lit(1).alias("role"))
    filled = left.unionByName(right).join(sets, "doc_id")
    return filled.groupBy(*key).applyInArrow(_compared(num, den), "parent bigint, child bigint")


def _counted(num, den):
    """i, j, shared: the keys that two documents of different components and near sizes share, over the keys of a group."""

    def run(table: pa.Table) -> pa.Table:
        key, ids, comps, low, high = (table.column(c).to_numpy() for c in ("key", "doc_id", "c", "low", "high"))
        order = np.lexsort((ids, key))
        key, ids, comps, low, high = key[order], ids[order], comps[order], low[order], high[order]
        one, two = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
        # the step-th next row of each row, as long as any row has one of the same key
        for step in range(1, COUNTED_DOCUMENTS):
            same = key[step:] == key[:-step]
            if not same.any():
                break
            near = (high[step:] * den >= low[:-step] * num) & (high[:-step] * den >= low[step:] * num)
            at = np.flatnonzero(same & near & (comps[step:] != comps[:-step]))
            one.append(ids[at])
            two.append(ids[at + step])
        one, two = np.concatenate(one), np.concatenate(two)
        order = np.lexsort((two, one))
        one, two = one[order], two[order]
        first = np.ones(len(one), bool)
        first[1:] = (one[1:] != one[:-1]) | (two[1:] != two[:-1])
        shared = np.diff(np.append(np.flatnonzero(first), len(one)))
        return pa.table({"i": one[first], "j": two[first], "shared": shared.astype(np.int64)})

    return run


def _open(members, found):
    """key, doc_id, c, documents of the keys whose documents are in several components."""
    rows = _labelled(members, found)
    sizes = rows.groupBy("key").agg(F.count("*").alias("documents"), F.min("c").alias("low"), F.max("c").alias("high"))
    return rows.join(sizes.where("low <> high").drop("low", "high"), "key")


def _ends(pairs, found):
    """The pairs with the components ``pc`` and ``c`` of their ends."""
    parents = _labelled(pairs.withColumn("doc_id", F.col("parent")), found).withColumnRenamed("c", "pc")
    return _labelled(parents.withColumn("doc_id", F.col("child")), found).drop("doc_id")


def extended(found: DataFrame, links: DataFrame) -> DataFrame:
    """The components ``found`` (doc_id, component_id) with more links (parent, child): only what these join is looked at anew."""
    ends = settle(_ends(links, found), "component-ends")
    joined = components(ends.where("pc <> c").select(F.col("pc").alias("parent"), F.col("c").alias("child")).distinct())
    both = ends.select(F.col("parent").alias("doc_id"), F.col("pc").alias("component_id")).union(ends.select("child", "c"))
    rows = found.select("doc_id", "component_id").union(both).distinct()
    joined = joined.select(F.col("doc_id").alias("component_id"), F.col("component_id").alias("joined"))
    return rows.join(joined, "component_id", "left").select("doc_id", F.coalesce("joined", "component_id").alias("component_id"))


def _more_links(found, sets, named, pairs, num, den):
    """The components with those of the pairs that are linked."""
    more = _verify(sets, named, pairs, num, den).where("linked").select("parent", "child")
    return settle(extended(found, more), "jaccard-found")


def _rounds(found, sets, named, pairs, num, den):
    """The components with those of the pairs that matter.

    In a round each document is verified with the one of another component that it shares most keys with; pairs whose ends
    have met need no verification. So two large groups that link are joined by some pairs, not by all.
    """
    for step in range(ROUNDS + 1):
        pairs = settle(_ends(pairs, found).where("pc <> c").select("parent", "child", "shared"), "jaccard-apart")
        if pairs.isEmpty():
            break
        chosen = pairs
        if step < ROUNDS:
            both = pairs.select("parent", "child", "shared", F.explode(F.array("parent", "child")).alias("doc_id"))
            best = both.groupBy("doc_id").agg(F.max(F.struct("shared", "parent", "child")).alias("best"))
            chosen = settle(best.select("best.parent", "best.child").distinct(), "jaccard-chosen")
        found = _more_links(found, sets, named, chosen, num, den)
        if step < ROUNDS:
            pairs = pairs.join(chosen, ["parent", "child"], "left_anti")
    return found


def _across_keys(members, named, sketches, found, num, den):
    """(pairs, edges): pairs (parent, child, shared) of different components that share as many keys as a link needs, and edges
    (parent, child) between the documents that very large keys alone may link.

    Parts that differ are at most D = (n + m)(den - num) / (num + den), so of K parts K - D are equal, and not empty but
    for those that both documents lack. All keys that two documents of different components share are open keys.
    ``sketches`` (doc_id, n, parities) of two linked documents differ in at most D parities.
    """
    held = settle(_open(members, found), "jaccard-open-keys")
    large = held.where(F.col("documents") > COUNTED_DOCUMENTS)
    loads = large.groupBy("doc_id").agg(F.count("*").alias("large"))
    shapes = named.select("doc_id", "n", *[F.col("shape")[k].alias(c) for k, c in enumerate(SHAPE)]).where("own_parts > 0 or before_parts > 0")
    shapes = shapes.join(held.select("doc_id").distinct(), "doc_id", "left_semi").join(loads, "doc_id", "left").fillna(0, ["large"])
    # rows that repeat an id and a size get each sketch of these: a pair is then looked at if any of them may link
    shapes = settle(shapes.distinct().join(sketches.distinct(), ["doc_id", "n"]), "jaccard-shapes")
    counted = held.where(F.col("documents") <= COUNTED_DOCUMENTS)
    groups = 1 + counted.count() // COUNTED_ROWS
    # rows that repeat an id have sets of their own
    size = shapes.groupBy("doc_id").agg(F.min("n").alias("low"), F.max("n").alias("high"))
    counted = counted.join(size, "doc_id").select("key", "doc_id", "c", "low", "high", F.pmod("key", F.lit(groups)).alias("group"))
    shared = counted.groupBy("group").applyInArrow(_counted(num, den), "i bigint, j bigint, shared bigint").groupBy("i", "j").agg(F.sum("shared").alias("shared"))
    one = shapes.select(*[F.col(c).alias(f"i_{c}") for c in shapes.columns])
    two = shapes.select(*[F.col(c).alias(f"j_{c}") for c in shapes.columns])
    both = shared.join(one, F.col("i") == F.col("i_doc_id")).join(two, F.col("j") == F.col("j_doc_id"))
    differ = F.floor((F.col("i_n") + F.col("j_n")) * (den - num) / (num + den))

    def need(a, b):
        """Parts that a and b have in common if they link, in the tile of a's band."""
        held_b = F.when(F.col(f"{b}_band") == F.col(f"{a}_band"), F.col(f"{b}_own_held")).otherwise(F.col(f"{b}_before_held"))
        return F.greatest(F.col(f"{a}_own_held"), held_b) - differ

    least = F.when(F.col("i_band") <= F.col("j_band"), need("i", "j")).otherwise(need("j", "i")) - F.least("i_large", "j_large")
    near = F.least("i_n", "j_n") * den >= F.greatest("i_n", "j_n") * num
    odd = F.zip_with("i_parities", "j_parities", lambda x, y: F.bit_count(x.bitwiseXOR(y)))
    alike = F.aggregate(odd, F.lit(0), lambda x, y: x + y) <= differ
    pairs = both.where(near & (F.col("shared") >= least)).where(alike).groupBy(F.col("i").alias("parent"), F.col("j").alias("child")).agg(F.max("shared").alias("shared"))
    # parts in common with any partner in the tile of its own band and in the one before: from a smaller partner it differs
    # by no more than any link of that tile
    most = F.floor(F.col("n") * (den - num) / num)
    common_parts = [F.when(F.col(f"{t}_parts") > 0, F.col(f"{t}_held") - d) for t, d in (("own", most), ("before", Tiles.differ(F.col("before_parts"))))]
    made = shapes.where("large > 0").groupBy("doc_id", "large").agg(F.greatest(F.min(F.least(*common_parts)), F.lit(1)).alias("least")).where("least <= large")
    # two documents that share as many large keys as both need share one of the rarest that each has beyond that number less one
    rare = Window.partitionBy("doc_id").orderBy("documents", "key")
    heavy = large.join(made, "doc_id").withColumn("rank", F.row_number().over(rare)).where("rank <= large - least + 1").select("key", "doc_id")
    first = heavy.groupBy("key").agg(F.min("doc_id").alias("parent"))
    stars = settle(heavy.join(first, "key").where("doc_id <> parent").select("parent", F.col("doc_id").alias("child")).distinct(), "jaccard-stars")
    # a document in many stars holds to the smallest, which holds to the others: the same clusters by far fewer edges
    least = stars.groupBy("child").agg(F.min("parent").alias("top"))
    tied = stars.join(least, "child").where("parent <> top").select(F.col("top").alias("parent"), F.col("parent").alias("child")).distinct()
    edges = least.select(F.col("top").alias("parent"), "child").unionByName(tied)
    return settle(pairs, "jaccard-counted"), settle(edges.distinct(), "jaccard-heavy")


def components(links: DataFrame) -> DataFrame:
    """doc_id, component_id of every end of ``links`` (parent, child): the smallest id that links lead to.

    Each round takes the smallest label of the neighbours, then the label of that label, until nothing changes.
    """
    both = settle(links.union(links.select("child", "parent")).toDF("x", "y").where("x <> y").distinct(), "component-links")
    labels = settle(both.groupBy("x").agg(F.least(F.min("y"), F.col("x")).alias("label")), "component-labels")
    while True:
        near = both.join(labels.select(F.col("x").alias("y"), F.col("label").alias("other")), "y").groupBy("x").agg(F.min("other").alias("other"))
        low = labels.join(near, "x").select("x", "label", F.least("label", "other").alias("low"))
        jump = labels.select(F.col("x").alias("low"), F.col("label").alias("far"))
        after = settle(low.join(jump, "low", "left").select("x", F.least("low", F.coalesce("far", "low")).alias("new"), "label"), "component-labels")
        labels = after.select("x", F.col("new").alias("label"))
        if after.where("new <> label").isEmpty():
            return labels.select(F.col("x").alias("doc_id"), F.col("label").alias("component_id"))


def join(documents: DataFrame, size: int = 5, num: int = 80, den: int = 100) -> DataFrame:
    """doc_id, n_shingles, component_id per row; documents link from a Jaccard similarity of num / den.

    Words are runs of characters other than white space, in ASCII lower case. A text of fewer than ``size`` words is one
    shingle; NULL texts and texts without words have none and link with nothing, also not with each other. The ids are
    integers. A row without id has no component. Rows that repeat an id are one document with the links of each of them.
    An empty table gives no rows; only doc_id and text are read.
    """
    rows = documents.select(F.col("doc_id").cast("bigint").alias("doc_id"), whole(F.col("text")).alias("text"))
    total = rows.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()[0]
    # about one key per four words at 0.9, and one per two at 0.8
    buckets = max(64, int(total / 6 * (den - num) / num * 3 / BUCKET_KEYS))
    # keys meet in buckets; the facts and edges of each slice travel with them, so the keys are never written as a table
    scanned = rows.mapInArrow(_scan(size, num, den, buckets), SCAN).groupBy("bucket").applyInArrow(_bucket_edges, FOUND)
    scanned = settle(scanned, "jaccard-scan")
    info = scanned.where("kind = 0").select("doc_id", "n", "a", "b", "shape")
    edges = scanned.where("kind = 2").select(F.col("a").alias("key"), F.col("n").alias("parent"), F.col("doc_id").alias("child"))
    named = info.where("doc_id is not null and n > 0")
    # equal sets are one class: a star around its smallest id, without a look at the texts
    least = named.groupBy("n", "a", "b").agg(F.min("doc_id").alias("parent"), F.count("*").alias("copies")).where("copies > 1").drop("copies")
    copies = named.join(settle(least, "jaccard-classes"), ["n", "a", "b"]).where("doc_id <> parent").select("parent", F.col("doc_id").alias("child"))
    ends = edges.select(F.col("parent").alias("doc_id")).union(edges.select("child")).distinct()
    sets = settle(rows.join(ends, "doc_id", "left_semi").mapInArrow(_sets(size), SETS), "jaccard-sets")
    sketches, sets = sets.select("doc_id", "n", "parities"), sets.select("doc_id", "shingles")
    # first each document with the one it shares most keys with
    shared = edges.groupBy("parent", "child").agg(F.count("*").alias("shared"))
    best = shared.groupBy("child").agg(F.max(F.struct("shared", (-F.col("parent")).alias("minus"))).alias("best"))
    best = settle(best.select((-F.col("best.minus")).alias("parent"), "child"), "jaccard-best")
    tested = _verify(sets, named, best, num, den)
    links = copies.distinct().unionByName(tested.where("linked").select("parent", "child"))
    found = settle(components(links), "jaccard-found")
    # keys whose documents are in several components are open
    members = settle(edges.select("key", F.col("parent").alias("doc_id")).union(edges.select("key", "child")).distinct(), "jaccard-members")
    large = _open(members, found).where(F.col("documents") > COUNTED_DOCUMENTS)
    # the best connected document of a large key, such as the text that the others were made from
    degree = large.groupBy("doc_id").agg(F.count("*").alias("degree"))
    placed = settle(large.join(degree, "doc_id"), "jaccard-large")
    hubs = placed.groupBy("key").agg(F.min(F.struct((-F.col("degree")).alias("minus"), "doc_id", "c")).alias("hub"))
    again = placed.join(settle(hubs, "jaccard-hubs"), "key").where(F.col("c") != F.col("hub.c"))
    again = settle(again.select(F.col("hub.doc_id").alias("parent"), F.col("doc_id").alias("child")).distinct(), "jaccard-again")
    if not again.isEmpty():
        found = _more_links(found, sets, named, again, num, den)
    pairs, heavy = _across_keys(members, named, sketches, found, num, den)
    found = _rounds(found, sets, named, pairs, num, den)
    if not heavy.isEmpty():
        sizes = named.select("doc_id", "n").distinct()
        last = settle(_within_clusters(heavy, sets, sizes, found, num, den), "jaccard-last")
        if not last.isEmpty():
            found = extended(found, last)
    known = settle(found, "jaccard-components").withColumnRenamed("doc_id", "__id")
    return (
        info.join(known, info["doc_id"] == known["__id"], "left")
        .select("doc_id", F.col("n").alias("n_shingles"), F.coalesce("component_id", "doc_id").alias("component_id"))
    )


def keep_one(documents: DataFrame, size: int = 5, num: int = 80, den: int = 100) -> DataFrame:
    """The documents, with all their columns, without those that link to one with a smaller id; rows without id stay."""
    found = join(documents, size, num, den)
    gone = found.where("component_id < doc_id").select(F.col("doc_id").alias("__id")).distinct()
    return documents.join(gone, documents["doc_id"] == gone["__id"], "left_anti")
