"""SimHash near-dedup with bit-sliced comparison.

A fingerprint bit is set if more than half of the XXH64 hashes of a text's word shingles set it.
Fingerprints are compared inside buckets that agree on two of ``radius + 2`` runs of bits (one of
the choices holds for any pair within the radius). A bucket's fingerprints are stored as vertical bit
planes, 64 to a machine word; a query's differences are added to carry-save counters plane by
plane, and a word of 64 candidates is abandoned as soon as all of them exceed the radius.

Scale: only distinct fingerprints are compared, and a bucket gives links to the smallest member
of each of its local components, not pairs. A bucket with more than ``cap`` distinct fingerprints, in
which so many links exist, is linked exactly by another way: each member names itself and its
64 one-bit neighbours; two are within two bits if and only if they name a common one; that is linear,
and no name is shared by more than 65. Components come from large-star/small-star rounds.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations, repeat

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quorumlake.operators.graph import connected_components
from quorumlake.plans.joins import join_dim
from quorumlake.plans.staging import Scope, Stage

RADIUS = 2
CAP = 4096
SEED = 42

# ---------------------------------------------------------------- fingerprints


def shingle_hashes(text: bytes | None, width: int) -> np.ndarray:
    """XXH64 of each shingle of ``width`` words, with repeats (fewer words: one of all of them; no words: none)."""
    words = (text or b"").lower().split()
    if not words:
        return np.zeros(0, np.uint64)
    if len(words) < width:
        words = [b" ".join(words)]
        width = 1
    runs = zip(*(words[i:] for i in range(width)))
    return np.fromiter(map(xxhash.xxh64_intdigest, map(b" ".join, runs), repeat(SEED)), np.uint64, len(words) - width + 1)


def fingerprint(text: bytes | None, width: int = 3) -> int:
    """Unsigned 64-bit SimHash of UTF-8 text: A-Z lower-cased, words split at ASCII space, shingles of
    ``width`` words with repeats (fewer words: all of them; no words: 0)."""
    return simhash(shingle_hashes(text, width))


def simhash(h: np.ndarray) -> int:
    """The bits that more than half of the hashes set; 0 for none."""
    n = len(h)
    votes = np.zeros(64, np.int64)
    for at in range(0, n, 1 << 14):
        part = h[at : at + (1 << 14)]
        votes += np.unpackbits(part.view(np.uint8), bitorder="little").reshape(-1, 64).sum(0, dtype=np.uint32)
    return int(np.packbits(2 * votes > n, bitorder="little").view(np.uint64)[0])


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text: str = "text", width: int = 3) -> DataFrame:
    """``(id, fp)`` of every row, fp as a signed bigint; null text counts as no words."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            got = [fingerprint(t.as_buffer().to_pybytes() if t.is_valid else None, width) for t in b.column(1).cast(pa.large_binary())]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(np.array(got, np.uint64).view(np.int64))], ["id", "fp"])

    return docs.select(F.col(id_col).cast("long").alias("id"), F.col(text).alias("t")).mapInArrow(run, "id bigint, fp bigint")


# ---------------------------------------------------------------- bit-sliced comparison


def planes(f: np.ndarray) -> np.ndarray:
    """Bit planes [64, words]: bit j of word w of plane b is bit b of fingerprint 64 w + j."""
    bits = ((f[None, :] >> np.arange(64, dtype=np.uint64)[:, None]) & np.uint64(1)).astype(np.uint8)
    bits = np.pad(bits, ((0, 0), (0, -len(f) % 64)))
    return np.packbits(bits, axis=1, bitorder="little").view(np.uint64)


def _add(state: list[np.ndarray], x: np.ndarray) -> None:
    """Adds a bit to each lane's vertical counter: low digits first, the last array keeps overflow."""
    for c in state[:-1]:
        c ^= x
        x = x & ~c  # lanes that held 1 and got 1 carry
    state[-1] |= x


def _exceeds(state: list[np.ndarray], radius: int) -> np.ndarray:
    """Lanes whose count is over ``radius``."""
    over, equal = state[-1].copy(), ~state[-1]
    for digit in range(len(state) - 2, -1, -1):
        c = state[digit]
        if radius >> digit & 1:
            equal &= c
        else:
            over |= equal & c
            equal &= ~c
    return over


def within(f: np.ndarray, queries: np.ndarray, radius: int, step: int = 8) -> tuple[np.ndarray, np.ndarray]:
    """Index pairs (i of ``queries``, j of ``f``) at distance ``radius`` or less."""
    p = planes(f)
    ask = (queries[None, :] >> np.arange(64, dtype=np.uint64)[:, None]) & np.uint64(1)
    ask = np.uint64(0) - ask  # 0 or all ones
    q = np.repeat(np.arange(len(queries)), p.shape[1])
    w = np.tile(np.arange(p.shape[1]), len(queries))
    state = [np.zeros(len(q), np.uint64) for _ in range(radius.bit_length() + 1)]
    for b in range(64):
        _add(state, p[b][w] ^ ask[b][q])
        if b % step == step - 1:
            live = _exceeds(state, radius) != np.uint64(0xFFFFFFFFFFFFFFFF)
            if not live.all():
                q, w, state = q[live], w[live], [c[live] for c in state]
            if not len(q):
                break
    near = ~_exceeds(state, radius)
    lanes = np.unpackbits(near.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
    at, lane = np.nonzero(lanes)
    i, j = q[at], w[at] * 64 + lane
    real = j < len(f)
    return i[real], j[real]


def local_links(f: np.ndarray, bucket: np.ndarray, radius: int, block: int = 512) -> tuple[np.ndarray, np.ndarray]:
    """Pairs (member, smallest index of its local component) that connect all fingerprints of a bucket
    that lie within the radius of one another, directly or by others of the bucket."""
    label = np.arange(len(f))
    for start in range(0, len(f), block):
        i, j = within(f[start:], f[start : start + block], radius)
        i, j = i + start, j + start
        keep = (j > i) & (bucket[i] == bucket[j])
        i, j = i[keep], j[keep]
        while len(i):
            a, b = label[i], label[j]
            differ = a != b
            if not differ.any():
                break
            i, j, a, b = i[differ], j[differ], a[differ], b[differ]
            low = np.minimum(a, b)
            np.minimum.at(label, a, low)
            np.minimum.at(label, b, low)
            while True:
                up = label[label]
                if (up == label).all():
                    break
                label = up
    moved = np.nonzero(label != np.arange(len(f)))[0]
    return moved, label[moved]


def _compare(radius: int, tile: int = 256):
    def links(t: np.ndarray, k: np.ndarray, f: np.ndarray) -> Iterator[pa.RecordBatch]:
        """Of whole buckets in order: tiles of several small buckets, or of one large bucket."""
        new = np.concatenate([[True], (t[1:] != t[:-1]) | (k[1:] != k[:-1])])
        bucket = np.cumsum(new)
        ends = np.append(np.nonzero(new)[0][1:], len(f))
        start = 0
        for e, nxt in zip(ends, np.append(ends[1:], len(f) + tile)):
            if nxt - start > tile:
                a, b = local_links(f[start:e], bucket[start:e], radius)
                if len(a):
                    part = f[start:e].view(np.int64)
                    yield pa.RecordBatch.from_arrays([pa.array(part[a]), pa.array(part[b])], ["src", "dst"])
                start = e

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = [np.zeros(0, np.int32), np.zeros(0, np.int64), np.zeros(0, np.uint64)]
        for batch in batches:
            cols = [c.to_numpy(zero_copy_only=False) for c in batch.columns]
            t, k, f = (np.concatenate([h, c.view(h.dtype)]) for h, c in zip(held, cols))
            if not len(t):
                continue
            cut = int(np.nonzero((t != t[-1]) | (k != k[-1]))[0][-1]) + 1 if ((t != t[-1]) | (k != k[-1])).any() else 0
            if cut:
                yield from links(t[:cut], k[:cut], f[:cut])
            held = [t[cut:], k[cut:], f[cut:]]
        if len(held[0]):
            yield from links(*held)

    return run


# ---------------------------------------------------------------- links and components


def masks(radius: int) -> list[int]:
    """Masks of two of ``radius + 2`` equal runs of bits: any pair within the radius agrees on one."""
    cuts = [round(i * 64 / (radius + 2)) for i in range(radius + 3)]
    run = [((1 << (b - a)) - 1) << a for a, b in zip(cuts, cuts[1:])]
    signed = lambda m: m - (1 << 64) if m >> 63 else m
    return [signed(a | b) for a, b in combinations(run, 2)]


def links(distinct: DataFrame, radius: int = RADIUS, cap: int = CAP) -> DataFrame:
    """``(src, dst)``: edges between distinct fingerprints (column fp) whose components are those of
    all pairs within ``radius`` bits. The linear way for hot buckets needs radius 2."""
    spark = distinct.sparkSession
    stage = Stage(spark, "links")
    keys = F.array(*[F.col("fp").bitwiseAND(F.lit(m).cast("long")) for m in masks(radius)])
    tables = distinct.select("fp", F.posexplode(keys).alias("t", "k"))
    sized = tables.groupBy("t", "k").agg(F.count("*").alias("n")).where("n > 1")
    shared = stage.put(tables.join(sized, ["t", "k"]), "shared")
    small = shared if radius != 2 else shared.where(F.col("n") <= cap)
    edges = small.repartition("t", "k").select("t", "k", "fp").sortWithinPartitions("t", "k").mapInArrow(_compare(radius), "src bigint, dst bigint")
    if radius == 2:
        hot = shared.where(F.col("n") > cap).select("fp").distinct()
        if not hot.isEmpty():
            flips = F.array(F.col("fp"), *[F.col("fp").bitwiseXOR(F.lit(1 << b if b < 63 else -(1 << 63)).cast("long")) for b in range(64)])
            named = hot.repartition("fp").select("fp", F.explode(flips).alias("z"))
            near = named.groupBy("z").agg(F.collect_set("fp").alias("fps")).where(F.size("fps") > 1)
            edges = edges.unionByName(near.select(F.explode("fps").alias("src"), F.array_min("fps").alias("dst")).where("src <> dst"))
    return stage.put(edges.distinct(), "edges")


def components(docs: DataFrame, id_col: str = "doc_id", text: str = "text", radius: int = RADIUS, width: int = 3, cap: int = CAP) -> DataFrame:
    """``(id, fp, component_id)`` of every row: the smallest id that links within ``radius`` bits reach.

    Defined cases: null, empty and blank texts have fingerprint 0 and link like any other; rows that
    repeat an id keep a row each; a null id is nobody's smallest (a group of null ids alone has a
    null component); an empty table gives no rows. Other columns are ignored.
    """
    with Scope(docs.sparkSession) as made:
        stage = Stage(docs.sparkSession, "dedup")
        prints = stage.put(fingerprints(docs, id_col, text, width), "prints")
        distinct = stage.put(prints.groupBy("fp").agg(F.min("id").alias("rep"), F.count("*").alias("n")), "distinct")
        of = stage.put(_lowest(distinct, links(distinct.select("fp"), radius, cap), "fp"), "of")
        made.keep(prints, of)
    out = join_dim(prints, of, "fp")
    return out.select(F.col("id").alias(id_col), "fp", F.when(F.col("_grouped"), F.col("component_id")).otherwise(F.col("id")).alias("component_id"))


def _lowest(distinct: DataFrame, edges: DataFrame, key: str) -> DataFrame:
    """``(key, component_id, _grouped)`` of the distinct values that edges link or that several rows have, with the smallest
    id of all of them; ``distinct`` is (key, rep, n)."""
    found = connected_components(edges).withColumnRenamed("node", key)
    named = distinct.select(key, "rep", "n").join(found, key, "left")
    lowest = named.where("component is not null").groupBy("component").agg(F.min("rep").alias("low"))
    of = named.where("n > 1 or component is not null").join(lowest, "component", "left")
    return of.select(key, F.coalesce("low", "rep").alias("component_id"), F.lit(True).alias("_grouped"))


def keep_one(docs: DataFrame, id_col: str = "doc_id", text: str = "text", **how) -> DataFrame:
    """The rows of ``docs`` whose id is the smallest of its group, all columns as they were.

    Rows that repeat an id are one document and stay or go together; rows without id stay.
    """
    return _kept(docs, lambda: components(docs, id_col, text, **how), id_col)


def _kept(docs: DataFrame, find, id_col: str) -> DataFrame:
    with Scope(docs.sparkSession) as made:
        dropped = find().groupBy(id_col).agg(F.max(F.col(id_col) == F.col("component_id")).alias("_kept")).where("not _kept").select(id_col)
        dropped = Stage(docs.sparkSession, "dedup").put(dropped, "dropped")
        made.keep(dropped)
    return join_dim(docs, dropped, id_col, "left_anti")


def hexadecimal(fp):
    return F.lower(F.lpad(F.hex(fp), 16, "0"))


# ---------------------------------------------------------------- similarity of word shingles

#: SimHash radius of candidates: distinct shingles at a Jaccard similarity of 0.8 differ in some 10 of 64 bits, 5 deviations less than this.
WIDE = 24
#: 16 bands of 4 minima: a pair at 0.8 shares one with a probability of 0.9998.
BANDS, ROWS = 16, 4
#: Texts of a chunk of a large group; two are compared at once.
TILE = 128
#: Leaders that a large group is compared with before its chunks are.
LEADERS = 3
#: Bytes of leaders' texts that may be sent to every executor.
BROADCAST_BYTES = 32 << 20
_XOR, _MUL = np.random.default_rng(SEED).integers(0, 1 << 64, (2, BANDS * ROWS), np.uint64)
_MUL |= np.uint64(1)


def band_keys(h: np.ndarray) -> list[int]:
    """A signed key for each band of the set's minimum hashes; none for an empty set."""
    if not len(h):
        return []
    least = np.full(BANDS * ROWS, np.iinfo(np.uint64).max, np.uint64)
    for at in range(0, len(h), 1 << 12):
        least = np.minimum(least, ((h[at : at + (1 << 12), None] ^ _XOR) * _MUL).min(0))
    return np.array([xxhash.xxh64_intdigest(b.tobytes()) for b in least.reshape(BANDS, ROWS)], np.uint64).view(np.int64).tolist()


def _sketches(width: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            names, fps, keys = [], [], []
            for t in b.column(1).cast(pa.large_binary()):
                h = np.unique(shingle_hashes(t.as_buffer().to_pybytes() if t.is_valid else None, width))
                names.append(xxhash.xxh3_128_hexdigest(h.tobytes()))
                fps.append(simhash(h))
                keys.append(band_keys(h))
            new = [pa.array(names), pa.array(np.array(fps, np.uint64).view(np.int64)), pa.array(keys, pa.list_(pa.int64()))]
            yield pa.RecordBatch.from_arrays([*b.columns, *new], ["id", "t", "name", "fp", "bands"])

    return run


def _shingle_set(text: str | None, width: int) -> np.ndarray:
    return np.unique(shingle_hashes(text.encode() if text is not None else None, width))


def _similar(x: np.ndarray, y: np.ndarray, least: float) -> bool:
    """Whether two sorted sets have a Jaccard similarity of ``least`` or more."""
    if min(len(x), len(y)) < least * max(len(x), len(y)):
        return False
    both = len(np.intersect1d(x, y, assume_unique=True))
    return both >= least * (len(x) + len(y) - both)


def _alike(width: int, least: float):
    def run(tile: pa.Table) -> pa.Table:
        """Edges that connect the texts of a tile whose shingles have a Jaccard similarity of ``least`` or more;
        those that one leader has linked before are not compared."""
        names, led = tile.column("name").to_pylist(), tile.column("led").to_pylist()
        sets = [_shingle_set(t.as_py(), width) for t in tile.column("t")]
        f = np.array([simhash(h) for h in sets], np.uint64)
        first: dict[str, int] = {}
        label = np.array([i if of is None else first.setdefault(of, i) for i, of in enumerate(led)], np.int64)
        src, dst = [], []
        for i, j in zip(*within(f, f, WIDE)):
            if i < j and label[i] != label[j] and _similar(sets[i], sets[j], least):
                label[label == label[j]] = label[i]
                src.append(names[i])
                dst.append(names[j])
        return pa.table({"src": pa.array(src, pa.string()), "dst": pa.array(dst, pa.string())})

    return run


def _near_leader(width: int, least: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Whether each text is similar to its group's leader."""
        last, of = None, None
        for b in batches:
            near = []
            for name, leader, t, lt in zip(b.column(1).to_pylist(), b.column(2).to_pylist(), b.column(3), b.column(4)):
                if leader != last:
                    last, of = leader, _shingle_set(lt.as_py(), width)
                near.append(name == leader or _similar(_shingle_set(t.as_py(), width), of, least))
            yield pa.RecordBatch.from_arrays([*b.columns[:3], pa.array(near, pa.bool_())], ["g", "name", "leader", "near"])

    return run


def _led(held: DataFrame, width: int, least: float, tile: int, rounds: int) -> tuple[DataFrame, DataFrame | None]:
    """``held`` (g, m, name, t) with ``led``, the leader that a text of a group of over two ``tile`` texts is similar to or
    null, and the edges to the leaders. A group has up to ``rounds`` leaders, each the first of those that none had linked."""
    stage = Stage(held.sparkSession, "similar")
    rest = held.where(F.col("m") > 2 * tile).select("g", "name", "t")
    found = None
    for _ in range(rounds):
        lead = rest.groupBy("g").agg(F.min("name").alias("leader"), F.count("*").alias("_n")).where(F.col("_n") > 2 * tile)
        lead = stage.put(lead.join(held.select(F.col("name").alias("leader"), F.col("t").alias("lt")), "leader").select("g", "leader", "lt"), "lead")
        n, size = lead.agg(F.count("*"), F.sum(F.octet_length("lt"))).first()
        if not n:
            break
        pairs = rest.join(F.broadcast(lead) if (size or 0) <= BROADCAST_BYTES else lead, "g")
        near = pairs.select("g", "name", "leader", "t", "lt").mapInArrow(_near_leader(width, least), "g bigint, name string, leader string, near boolean")
        near = stage.put(near, "near")
        hit = near.where("near").select("name", "leader")
        found = hit if found is None else found.unionByName(hit)
        rest = rest.join(near.where("not near").select("name"), "name").select("g", "name", "t")
    if found is None:
        return held.withColumn("led", F.lit(None).cast("string")), None
    found = stage.put(found, "led")
    out = held.join(found.withColumnRenamed("leader", "led"), "name", "left")
    return out, found.where("name <> leader").select(F.col("name").alias("src"), F.col("leader").alias("dst"))


def _tiles(led: DataFrame, tile: int) -> DataFrame:
    """``(g, x, y, name, t, led)``: each text in the tiles of its group. A small group is one tile. Of a large one the texts of the
    leader with most of them need no comparison with one another: their chunks meet the chunks of the rest alone,
    and those all of one another. A group that its leader links whole has no tile."""
    stage = Stage(led.sparkSession, "similar")
    led = stage.put(led, "held")
    small = led.where(F.col("m") <= 2 * tile).select("g", F.lit(0).alias("x"), F.lit(0).alias("y"), "name", "t", "led")
    large = led.where(F.col("m") > 2 * tile)
    counts = stage.put(large.groupBy("g", "led").agg(F.count("*").alias("n")), "counts")
    if counts.isEmpty():
        return small
    by = counts.groupBy("g").agg(F.sum("n").alias("all"), F.max_by(F.struct("n", "led"), F.struct(F.when(F.col("led").isNotNull(), F.col("n")).otherwise(0), "led")).alias("top"))
    main = F.when(F.col("top.led").isNotNull(), F.col("top.n")).otherwise(0)
    chunks = lambda n: F.ceil(n / tile).cast("int")
    by = by.select("g", F.col("top.led").alias("main"), chunks(main).alias("d"), chunks(F.col("all") - main).alias("c"))
    large = join_dim(large, by, "g", "inner").where("c > 0")
    at = F.xxhash64("name")
    each = F.when(F.col("led") == F.col("main"), F.array(-1 - F.pmod(at, F.col("d")))).otherwise(F.array(F.pmod(at, F.col("c")))).getItem(0).cast("int")
    large = large.withColumn("a", each).withColumn("b", F.explode(F.expr("sequence(if(a < 0, 0, -d), c - 1)")))
    return small.unionByName(large.select("g", F.least("a", "b").alias("x"), F.greatest("a", "b").alias("y"), "name", "t", "led"))


def similar_components(docs: DataFrame, id_col: str = "doc_id", text: str = "text", width: int = 5, least: float = 0.8, cap: int = CAP, tile: int = TILE, leaders: int = LEADERS) -> DataFrame:
    """``(id, component_id)`` of every row: the smallest id that links between texts reach whose distinct
    ``width``-word shingles have a Jaccard similarity of ``least`` or more.

    Texts that share a band of minimum hashes are compared by bit-sliced SimHash at a wide radius; what that links
    are candidate groups, in which all pairs within the radius are then checked exactly. Equal shingle
    sets are one member. Groups of over two ``tile`` members are first compared with up to ``leaders`` of their
    own, which links most groups whole in proportion to their size; only what no leader links meets all others, in
    pairs of chunks. Ids and empty texts are treated as in ``components``.
    """
    with Scope(docs.sparkSession) as made:
        stage = Stage(docs.sparkSession, "similar")
        rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text).alias("t"))
        prints = stage.put(rows.mapInArrow(_sketches(width), "id bigint, t string, name string, fp bigint, bands array<bigint>"), "prints")
        distinct = stage.put(prints.groupBy("name").agg(F.min("id").alias("rep"), F.count("*").alias("n"), F.first("fp").alias("fp"), F.first("bands").alias("bands")), "distinct")
        tables = distinct.select("fp", F.posexplode("bands").alias("t", "k")).distinct()
        sized = tables.groupBy("t", "k").agg(F.count("*").alias("m"), F.min("fp").alias("low")).where("m > 1")
        shared = stage.put(tables.join(sized, ["t", "k"]), "shared")
        edges = shared.where(F.col("m") <= cap).repartition("t", "k").select("t", "k", "fp").sortWithinPartitions("t", "k").mapInArrow(_compare(WIDE), "src bigint, dst bigint")
        edges = edges.unionByName(shared.where(F.col("m") > cap).select(F.col("fp").alias("src"), F.col("low").alias("dst")))
        found = connected_components(stage.put(edges.distinct(), "edges")).withColumnRenamed("node", "fp")
        groups = distinct.join(found, "fp", "left").select("name", F.coalesce("component", "fp").alias("g"))
        many = groups.groupBy("g").agg(F.count("*").alias("m")).where("m > 1")
        members = stage.put(groups.join(many, "g"), "members")
        texts = join_dim(prints.select("name", "t"), members, "name", "inner").dropDuplicates(["name"])
        texts, edges = _led(stage.put(texts, "texts"), width, least, tile, leaders)
        alike = _tiles(texts, tile).groupBy("g", "x", "y").applyInArrow(_alike(width, least), "src string, dst string")
        alike = stage.put(alike if edges is None else alike.unionByName(edges), "alike")
        of = stage.put(_lowest(distinct, alike, "name"), "of")
        ids = stage.put(prints.select("id", "name"), "ids")
        made.keep(ids, of)
    out = join_dim(ids, of, "name")
    return out.select(F.col("id").alias(id_col), F.when(F.col("_grouped"), F.col("component_id")).otherwise(F.col("id")).alias("component_id"))


def keep_one_similar(docs: DataFrame, id_col: str = "doc_id", text: str = "text", **how) -> DataFrame:
    """``keep_one`` by ``similar_components``."""
    return _kept(docs, lambda: similar_components(docs, id_col, text, **how), id_col)
