"""N-gram Jaccard join at 0.8 over five-word shingles, by parity sketches.

Sets A, B reach 0.8 exactly when their symmetric difference has at most (|A| + |B|) / 9 shingles.

* Sketch.  In a size band the shingle hashes are dealt to ``k`` blocks; a block holds the XOR of its shingles.
  A shingle in one set only changes one block, so the number of differing blocks never exceeds the symmetric
  difference ``d``.  By the pigeonhole rule, of the first ``p`` blocks in one global order (fullest first, then by
  value) two similar sets share at least the smaller ``p`` less ``d``; ``need`` is the least of that over all partners' sizes.
  A set with fewer than ``p`` filled blocks shows empty ones as well (the last in that order), so ``p`` always holds.
* Join.  Blocks are counted per key.  Keys with very many sets are found beforehand (each task counts its own, 1,000,000
  blocks at a time), and their rows are salted, so no task gets more than about HOT_KEY rows of one key and flush.
  A document is only kept if enough of its blocks occur in another document too, and only its rarest blocks can then be needed.  Every block's members are linked to the block's smallest member: a linear number of
  candidate links whose clusters contain every true link.
* Verify.  Within a cluster, chunk by chunk, dense bit sketches (one flipped bit per shingle; their Hamming
  distance bounds the symmetric difference from below) drop most pairs, exact set intersections decide the rest, and
  pairs already connected are skipped.  Chunks of a large cluster share anchors; what is then not in
  the cluster's main component is compared with all other chunks.  So every pair is either connected or compared.

Copies with equal sets are one node throughout.  A document of size n belongs to the band of its size, and to the
next one if a partner up to 1.25 times its size falls there.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ledgerlark.llm.common import TEXT_BATCH, Scratch, freeing, setting, with_row_key
from ledgerlark.llm.graph import components
from ledgerlark.llm.hashing import mix, shingle_set, word_hashes

_U = np.uint64
#: Band 0 holds sets below this size; there every shingle is a block of its own.
SMALLEST_BAND = 64
CHUNK_DOCS, CHUNK_SHINGLES = 400, 400_000
ANCHORS = 16
SEEN_SETS = 500_000
BROADCAST_KEYS = 1_000_000
EMIT = 200_000
#: Blocks that a task counts at a time; a key counts where it is met twice or more among them.
TALLY = 1_000_000
#: Keys counted above this, and above one in MAX_HOT_KEYS of all that is counted, are hot: MAX_HOT_KEYS at most.
HOT_KEY, MAX_HOT_KEYS = 200, 500_000
SALTS = 1024


def similar(inter: int, a: int, b: int) -> bool:
    return 100 * inter >= 80 * (a + b - inter)


def _node(s: np.ndarray) -> np.uint64:
    """64-bit identity of a set."""
    if not len(s):
        return _U(0)
    folded = np.bitwise_xor.reduce(mix(s), keepdims=True) + np.sum(s, dtype=_U, keepdims=True) * _U(3)
    return mix(folded + _U(len(s)))[0]


def band_of(n: int) -> int:
    return max(0, n.bit_length() - SMALLEST_BAND.bit_length() + 1) if n >= SMALLEST_BAND else 0


def _band_top(band: int) -> int:
    return SMALLEST_BAND << band


@cache
def _distance(n: int, band: int) -> int:
    """Largest distance of a set of size n to a similar one in the band."""
    return (n + (n * 5 // 4 if n < _band_top(band) // 2 and band else min(n * 5 // 4, _band_top(band) - 1))) // 9


def _length(n: int, band: int) -> int:
    """Blocks that a set of size n shows in the band."""
    d = _distance(n, band)
    return n if band == 0 else d + max(2, d // 2)


@cache
def _need(n: int, band: int) -> int:
    """Blocks that a set of size n shares with any similar set in the band: the least over the sizes of partners.

    Of two sets the shorter list of blocks counts.  In band 0 both show everything, so the intersection counts.  A set
    from the band below has partners of the band's own sizes only; two sets from below meet there.
    """
    top = _band_top(band)
    own = 0 if band == 0 else top // 2
    smallest = own if n < own else max(-(-4 * n // 5), -(-2 * top // 5) if band else 1)
    sizes = range(smallest, min(n * 5 // 4, top - 1) + 1)
    if band == 0:
        return min(-(-4 * (n + m) // 9) for m in sizes)
    return min(min(_length(n, band), _length(m, band)) - (n + m) // 9 for m in sizes)


def blocks(s: np.ndarray, band: int) -> tuple[np.ndarray, int]:
    """(block keys, need): at least ``need`` of them are shared with any similar set in the band."""
    n = len(s)
    if band == 0:
        keys, counts = s, None
    else:
        k = (17 * (2 * _band_top(band) // 9 + 1)) // 10 + 16
        at = ((s >> _U(32)) * _U(k)) >> _U(32)  # rises with s, and s is sorted
        first = np.flatnonzero(np.concatenate(([True], at[1:] != at[:-1])))
        counts = np.diff(np.append(first, n))
        keys = np.bitwise_xor.reduceat(mix(s), first) + at[first]
        if len(keys) < _length(n, band):  # an empty block is the XOR of nothing; it counts like any other
            empty = np.setdiff1d(np.arange(k, dtype=_U), at[first])
            keys, counts = np.concatenate([keys, empty]), np.concatenate([counts, np.zeros(len(empty), counts.dtype)])
    keys = mix(keys + _U((band + 1) * 0x9E3779B97F4A7C15 % (1 << 64)))
    length = _length(n, band)
    order = np.argsort(keys) if counts is None else np.lexsort((keys, -counts))
    return keys[order[:length]], max(1, _need(n, band))


def elements(s: np.ndarray) -> Iterator[tuple[np.ndarray, int]]:
    """Block keys in each band of the set; need is negative in the band above the set's own."""
    n = len(s)
    band = band_of(n)
    keys, need = blocks(s, band)
    yield keys, need
    if n * 5 // 4 >= _band_top(band):
        keys, need = blocks(s, band + 1)
        yield keys, -need


def _texts(column: pa.Array) -> list[bytes]:
    return [(t or "").encode() for t in column.to_pylist()]


def _repeated(keys: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Keys met twice or more, and how often."""
    found, hits = np.unique(np.concatenate(keys), return_counts=True)
    return found[hits > 1], hits[hits > 1]


def _sizes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row (doc_id, _rk1, _rk2, n, node) for each text, and rows (key, hits) for blocks that this task met more than once."""
    names = ["doc_id", "_rk1", "_rk2", "n", "node", "key", "hits"]
    seen: set[int] = set()
    keys: list[np.ndarray] = []
    held = 0

    def tally() -> pa.RecordBatch:
        found, hits = _repeated(keys)
        keys.clear()
        cols = [pa.nulls(len(found), pa.int64())] * 5 + [pa.array(found.view(np.int64)), pa.array(hits.astype(np.int64))]
        return pa.RecordBatch.from_arrays(cols, names=names)

    for rb in batches:
        n, nodes = [], []
        for _, words in word_hashes(_texts(rb.column(0))):
            s = shingle_set(words)
            n.append(len(s))
            nodes.append(_node(s))
            if len(s) >= 4 and (node := int(nodes[-1])) not in seen:
                if len(seen) >= SEEN_SETS:
                    seen.clear()
                seen.add(node)
                for k, _ in elements(s):
                    keys.append(k)
                    held += len(k)
            if held >= TALLY:
                yield tally()
                held = 0
        ids = [rb.column(i).cast(pa.int64()) for i in (1, 2, 3)]
        cols = [*ids, pa.array(n, pa.int64()), pa.array(np.array(nodes, dtype=_U).view(np.int64)), *[pa.nulls(len(n), pa.int64())] * 2]
        yield pa.RecordBatch.from_arrays(cols, names=names)
    if keys:
        yield tally()


def _elements(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(key, node, need) of every set; a set that this task has just seen is not sent again."""
    seen: set[int] = set()
    keys, nodes, needs, held = [], [], [], 0

    def out() -> pa.RecordBatch:
        sizes = [len(k) for k in keys]
        return pa.RecordBatch.from_arrays(
            [pa.array(np.concatenate(keys).view(np.int64)), pa.array(np.repeat(np.array(nodes, dtype=_U), sizes).view(np.int64)),
             pa.array(np.repeat(np.array(needs, dtype=np.int32), sizes))],
            names=["key", "node", "need"],
        )

    for rb in batches:
        for _, words in word_hashes(_texts(rb.column(0))):
            s = shingle_set(words)
            if len(s) < 4 or (node := int(_node(s))) in seen:  # two different sets below four shingles are never similar
                continue
            if len(seen) >= SEEN_SETS:
                seen.clear()
            seen.add(node)
            for k, need in elements(s):
                keys.append(k)
                nodes.append(node)
                needs.append(need)
                held += len(k)
            if held >= EMIT:
                yield out()
                keys, nodes, needs, held = [], [], [], 0
    if keys:
        yield out()


def _sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for rb in batches:
        nodes, sets = [], []
        for i, words in word_hashes(_texts(rb.column(0))):
            s = shingle_set(words)
            nodes.append(rb.column(1)[i].as_py())
            sets.append(s)
        offsets = np.zeros(len(sets) + 1, dtype=np.int32)
        np.cumsum([len(s) for s in sets], out=offsets[1:])
        values = np.concatenate(sets).view(np.int64) if sets else np.zeros(0, np.int64)
        yield pa.RecordBatch.from_arrays(
            [pa.array(nodes, pa.int64()), pa.ListArray.from_arrays(pa.array(offsets), pa.array(values))], names=["node", "shingles"]
        )


def _common(a: np.ndarray, b: np.ndarray) -> int:
    if len(a) > len(b):
        a, b = b, a
    at = np.searchsorted(b, a)
    at[at == len(b)] = 0
    return int(np.count_nonzero(b[at] == a))


def _bit_sketches(sets: list[np.ndarray]) -> np.ndarray:
    bits = 1 << min(16, max(9, (8 * max(map(len, sets))).bit_length()))
    out = np.zeros((len(sets), bits // 64), dtype=_U)
    for i, s in enumerate(sets):
        flips = np.bincount((s & _U(bits - 1)).astype(np.int64), minlength=bits) & 1
        out[i] = np.packbits(flips.astype(np.uint8)).view(_U)
    return out


def verified_links(nodes: list[int], comps: list[int], sets: list[np.ndarray], probe: np.ndarray) -> list[tuple[int, int]]:
    """Links that connect what is similar.  Compared are pairs with at least one probe, unless already connected."""
    parent: dict[int, int] = {c: c for c in comps}

    def root(x: int) -> int:
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    sketch, sizes = _bit_sketches(sets), np.array([len(s) for s in sets])
    links = []
    for i in range(1, len(sets)):
        total = sizes[:i] + sizes[i]
        close = 9 * np.bitwise_count(sketch[:i] ^ sketch[i]).sum(axis=1, dtype=np.int64) <= total
        if not probe[i]:
            close &= probe[:i]
        for j in np.flatnonzero(close):
            a, b = root(comps[i]), root(comps[j])
            if a != b and similar(_common(sets[i], sets[j]), len(sets[i]), len(sets[j])):
                parent[max(a, b)] = min(a, b)
                links.append((nodes[i], nodes[j]))
    return links


def _verify(table: pa.Table) -> pa.Table:
    """One chunk (node, comp, probe, shingles) -> links (a, b)."""
    table = table.combine_chunks()
    lists = table.column("shingles")
    lists = lists.chunk(0) if isinstance(lists, pa.ChunkedArray) else lists
    ends, values = lists.offsets.to_numpy(), lists.values.to_numpy().view(_U)
    sets = [values[a:b] for a, b in zip(ends[:-1], ends[1:], strict=True)]
    order = np.argsort([len(s) for s in sets], kind="stable")
    nodes, comps = table.column("node").to_pylist(), table.column("comp").to_pylist()
    probe = np.array(table.column("probe").to_pylist(), dtype=bool)[order]
    links = verified_links([nodes[i] for i in order], [comps[i] for i in order], [sets[i] for i in order], probe)
    return pa.table({"a": pa.array([x[0] for x in links], pa.int64()), "b": pa.array([x[1] for x in links], pa.int64())})


def _links(rows: DataFrame, by: list[str]) -> DataFrame:
    return rows.select(*by, "node", "comp", "probe", "shingles").groupBy(*by).applyInArrow(_verify, "a long, b long")


def hot_keys(counted: DataFrame) -> DataFrame:
    """(key, hits) of at most MAX_HOT_KEYS keys that very many sets show, from the tasks' own counts (key, hits)."""
    every = counted.agg(F.coalesce(F.sum("hits"), F.lit(0)).alias("hits")).first()["hits"]
    return counted.groupBy("key").agg(F.sum("hits").alias("hits")).where(F.col("hits") > max(HOT_KEY, every // MAX_HOT_KEYS))


def _candidates(docs: DataFrame, hot: DataFrame, scratch: Scratch) -> DataFrame:
    """(a, b): every block's members linked to its smallest member.

    ``hot`` lists very frequent keys; there the listed count stands for the number of members, the same in every row.
    """
    mine = Window.partitionBy("node", F.col("need") > 0)

    def enough(met: DataFrame) -> DataFrame:
        """Of the shared blocks (key, node, need, n) those of sets that still have enough of them."""
        counted = met.withColumns({"have": F.count("*").over(mine), "must": F.min(F.abs("need")).over(mine)})
        return counted.where(F.col("have") >= F.col("must"))

    # the rows of a key that is not hot fit into one task; those of a hot key are dealt over many places, unseen
    listed = F.broadcast(hot.select("key", F.col("key").alias("hot_key"), "hits"))
    place = F.when(F.col("hits").isNull(), F.col("key")).otherwise(F.xxhash64("key", F.pmod("node", F.lit(SALTS))))
    rows = docs.select("text").mapInArrow(freeing(_elements), "key long, node long, need int").join(listed, "key", "left")
    one = Window.partitionBy("place")  # a single number, so that the sort stays a radix sort
    met = rows.select(place.alias("place"), "node", "need", "hot_key", "hits").withColumns(
        {"n": F.coalesce("hits", F.count("*").over(one)), "low": F.min("node").over(one), "high": F.max("node").over(one)}
    )
    met = met.where(F.col("hits").isNotNull() | (F.col("low") != F.col("high"))).select("place", "node", "need", "hot_key", "n").distinct()
    met = met.select(F.coalesce("hot_key", "place").alias("key"), "node", "need", "n")
    first = scratch.write(enough(met).select("key", "node", "need"), "shared")

    # partners may have gone; few rows are left, and adaptive execution splits the keys that still have very many
    stats = first.groupBy("key").agg(F.count("*").alias("n"), F.min("node").alias("low"), F.max("node").alias("high")).where("low != high")
    again = enough(first.join(stats.select("key", "n"), "key"))
    ranked = again.withColumn("rank", F.row_number().over(mine.orderBy("n", "key")))
    useful = scratch.write(ranked.where(F.col("rank") <= F.col("have") - F.col("must") + 1).select("key", "node"), "useful")
    lows = useful.groupBy("key").agg(F.min("node").alias("low"))
    return useful.join(lows, "key").where(F.col("node") != F.col("low")).select(F.col("node").alias("a"), F.col("low").alias("b")).distinct()


def near_duplicates(docs: DataFrame) -> DataFrame:
    """(doc_id, n_shingles, component_id) for each row of ``docs`` (doc_id, text; other columns are not read).

    component_id is the smallest doc_id reachable by links, the document's own included.  A text without words has
    no shingles and links with nothing; texts of fewer than five words count as one shingle.  Rows with a null
    doc_id take part in links but name no component.  Repeated rows are one node and come back once each.  An empty
    table gives an empty result.  Shingles and sets are compared by 64-bit hashes.
    """
    sized, final = _grouped(docs)
    ids = sized.groupBy("node").agg(F.min("doc_id").alias("low")).join(final, "node", "left").withColumn("comp", F.coalesce("comp", "node"))
    named = ids.select("node", "comp").join(ids.groupBy("comp").agg(F.min("low").alias("component_id")), "comp").select("node", "component_id")
    alone = F.when(F.col("n") == 0, F.col("doc_id")).otherwise(F.when(F.col("doc_id").isNotNull(), F.col("component_id")))
    return sized.join(named, "node").select("doc_id", F.col("n").alias("n_shingles"), alone.alias("component_id"))


def _grouped(docs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(doc_id, _rk1, _rk2, n, node) of each row, and (node, comp) of the nodes that link with others."""
    with setting(docs.sparkSession, *TEXT_BATCH):  # all passes over texts are written in here
        return _linked(docs)


def _linked(docs: DataFrame) -> tuple[DataFrame, DataFrame]:
    spark = docs.sparkSession
    scratch = Scratch(spark, "near")
    keyed = with_row_key(docs.select("doc_id", "text"), "doc_id", "text")
    schema = "doc_id long, _rk1 long, _rk2 long, n long, node long, key long, hits long"
    both = scratch.write(keyed.select("text", "doc_id", "_rk1", "_rk2").mapInArrow(freeing(_sizes), schema), "sized")
    sized = both.where("hits IS NULL").drop("key", "hits")
    hot = scratch.write(hot_keys(both.where("hits IS NOT NULL").select("key", "hits")), "hot")
    star = scratch.write(_candidates(docs, hot, scratch), "candidates")
    clusters = scratch.write(components(star, scratch, "clusters"), "clusters").withColumnRenamed("comp", "cluster")
    scratch.drop("candidates", "shared", "useful", "hot")

    one = sized.groupBy("node").agg(F.min(F.struct("_rk1", "_rk2", "n")).alias("r")).join(clusters, "node")
    members = scratch.write(one.select("node", "cluster", "r.n", "r._rk1", "r._rk2"), "members")
    wanted = members.select("_rk1", "_rk2", "node")
    few = members.count() <= BROADCAST_KEYS  # rows of a few numbers; beyond that both sides of a join are shuffled
    if few:
        wanted = F.broadcast(wanted)
    # a repeated row has the same key, node and text
    chosen = keyed.join(wanted, ["_rk1", "_rk2"]).select("text", "node")
    sets = scratch.write(chosen.mapInArrow(freeing(_sets), "node long, shingles array<long>"), "sets")

    parts = members.groupBy("cluster").agg(F.count("*").alias("docs"), F.sum("n").alias("total"))
    chunks = F.greatest(F.ceil(F.col("docs") / CHUNK_DOCS), F.ceil(F.col("total") / CHUNK_SHINGLES)).cast("int")
    spread = scratch.write(
        members.select("node", "cluster").join(parts.select("cluster", "docs", chunks.alias("chunks")), "cluster")
        .withColumn("chunk", F.pmod(F.xxhash64("node"), F.col("chunks")).cast("int")),
        "spread",
    )
    anchor = (F.col("chunks") > 1) & (F.pmod(F.xxhash64("node", F.lit(1)), F.lit(1 << 30)) < F.lit(ANCHORS * (1 << 30)) / F.col("docs"))
    own = spread.select("cluster", "chunk", "node")
    lent = spread.where(anchor).select("cluster", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)).alias("chunk"), "node")
    placed = own.unionAll(lent).distinct().withColumns({"comp": F.col("node"), "probe": F.lit(True)})
    with_sets = lambda rows: sets.join(F.broadcast(rows) if few else rows, "node")
    links = scratch.write(_links(with_sets(placed), ["cluster", "chunk"]), "links")
    comps = scratch.write(components(links, scratch, "first"), "first")

    large = spread.where("chunks > 1").join(comps, "node", "left").withColumn("comp", F.coalesce("comp", "node"))
    main = large.groupBy("cluster", "comp").agg(F.count("*").alias("size")).groupBy("cluster").agg(F.max_by("comp", F.struct("size", "comp")).alias("main"))
    marked = scratch.write(large.join(main, "cluster").withColumn("probe", F.col("comp") != F.col("main")), "marked")
    n_probes = marked.where("probe").groupBy("cluster").agg(F.ceil(F.count("*") / CHUNK_DOCS).cast("int").alias("deals"))
    probes = marked.where("probe").join(n_probes, "cluster").select(
        "cluster", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)).alias("chunk"), F.pmod(F.xxhash64("node", F.lit(2)), F.col("deals")).cast("int").alias("deal"),
        "node", "comp", F.lit(True).alias("probe"),
    )
    others = marked.join(n_probes, "cluster").select(
        "cluster", "chunk", F.explode(F.sequence(F.lit(0), F.col("deals") - 1)).alias("deal"), "node", "comp", F.lit(False).alias("probe")
    )
    again = scratch.write(probes.unionAll(others), "again")
    few = again.count() <= BROADCAST_KEYS
    more = scratch.write(_links(with_sets(again), ["cluster", "chunk", "deal"]), "more")
    final = scratch.write(components(links.unionAll(more), scratch, "final"), "final")
    scratch.drop("sets", "links", "more", "again", "members", "spread", "marked", "first", "clusters")

    return sized, final


def keep_one(docs: DataFrame) -> DataFrame:
    """Rows of ``docs`` left when one document of each component stays: the one with the smallest doc_id, null last, then by row key.

    What goes is named by (doc_id, text), so two texts that share a doc_id are judged one by one, and copies without a
    doc_id go as well.  Rows without words link with nothing and stay.  Of repeated rows with words one stays, the smallest by
    all columns.  An empty table gives an empty result; extra columns may have any name.
    """
    scratch = Scratch(docs.sparkSession, "kept")
    sized, final = _grouped(docs)
    comp = F.coalesce("comp", "node").alias("comp")
    key = ["_rk1", "_rk2"]
    worded = sized.where("n > 0").groupBy("node", "doc_id", *key).agg(F.count("*").alias("copies"))
    found = scratch.write(worded.join(final, "node", "left").select(comp, F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", *key).alias("row"), "copies"), "found")
    stays = found.groupBy("comp").agg(F.min("row").alias("first"))
    judged = scratch.write(found.join(stays, "comp").select("row._rk1", "row._rk2", "copies", (F.col("row") == F.col("first")).alias("kept")), "judged")
    scratch.drop("found")

    def few(rows: DataFrame) -> DataFrame:
        return F.broadcast(rows) if rows.count() <= BROADCAST_KEYS else rows

    keyed = with_row_key(docs.select("doc_id", "text", F.struct(*docs.columns).alias("_row")), "doc_id", "text").select("_row", *key)
    left = keyed.join(few(judged.where("NOT kept").select(*key)), key, "left_anti")
    repeats = judged.where("kept AND copies > 1").select(*key)
    if repeats.isEmpty():
        return left.select("_row.*")
    repeats = few(repeats)
    once = left.join(repeats, key, "left_semi").groupBy(*key).agg(F.min("_row").alias("_row"))
    return left.join(repeats, key, "left_anti").select("_row.*").unionByName(once.select("_row.*"))
