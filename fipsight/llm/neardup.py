"""Near-duplicate classes by BagMinHash signatures, banding and exact multiset overlap.

Words are runs without white space, A-Z lower-cased; a text's bag holds its runs of five words (a
shorter text is one run of all its words). Two texts are linked when the weighted Jaccard similarity
of their bags, sum of minima / sum of maxima, is at least ``threshold``; classes are the connected
components of the links. Texts with the same words are one node (``key``, a 64-bit hash of the word
sequence), however many copies there are.

1. Signatures of REGISTERS registers for all texts; BANDS bands of ROWS registers. A pair at 0.8
   misses every band with probability 3e-6.
2. Bands that different nodes share (partial sums, no group is gathered), and the bags of the nodes
   that stand in one.
3. Star: each node is verified against the least node of each of its bands, and the links are
   joined to components. That settles a band of near copies with one comparison for each node.
4. Tiles: what is left are pairs of one band in different components. A band's largest component
   and its other nodes are cut into tiles of about ``TILE`` nodes, and the pairs between two tiles
   are compared in one task: signatures first (pairs that agree in fewer than LEAST registers are
   passed over; a pair at 0.8 does with probability 1e-9), then bags, leaving out pairs that the
   task's links have joined. A pair is looked at only in the first band it shares. Nothing is capped:
   a larger band has more tiles.
5. Components of all links; the class id is the least doc_id of the class.

Intermediate tables are written to the shared checkpoint folder, so a lost executor costs a task.

Cases: null, empty and blank texts have no words and stand alone (class id = their doc_id); repeated
rows and copies fall into one class; a null doc_id is never a class id unless the class has no
other; an id that several rows have, or none, names no row: such texts are found by their key; very long
texts are handled in their row; empty table = no rows; clashing extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fipsight.llm.graph import components
from fipsight.llm.store import Folder, broadcast_ids
from fipsight.llm.text import chunks, mix, ngram_hashes, run_lengths, word_hashes

U = np.uint64
WORDS = 5
ROWS, BANDS = 5, 32
REGISTERS = ROWS * BANDS
LEAST = 97  # of 160 registers; 0.8 - 6 standard deviations
TILE = 512
GOLD = U(0x9E3779B97F4A7C15)


def text_keys(words: np.ndarray, doc: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """(64-bit hash of the whole word sequence, number of words) of each of n texts."""
    count = np.bincount(doc, minlength=n)
    first = np.cumsum(count) - count
    place = (np.arange(len(words)) - first[doc]).astype(U)
    total = np.zeros(n, U)
    at = np.flatnonzero(count)
    if len(at):
        total[at] = np.add.reduceat(mix(words + mix(place * GOLD + U(1))), first[at])
    return mix(total + count.astype(U)), count


def bags(words: np.ndarray, doc: np.ndarray, n: int):
    """(text, shingle hash, times) of every distinct shingle, in order of text and hash."""
    key, at = ngram_hashes(words, doc, WORDS)
    whole, count = text_keys(words, doc, n)
    short = np.flatnonzero((count > 0) & (count < WORDS))
    key, at = np.concatenate([key, whole[short]]), np.concatenate([at, short])
    order = np.lexsort((key, at))
    key, at = key[order], at[order]
    st, size = run_lengths(at, key)
    return at[st], key[st], size


def _unit(h: np.ndarray) -> np.ndarray:
    return (h >> U(11)).astype(np.float64) * 2.0 ** -53


def signatures(text: np.ndarray, key: np.ndarray, times: np.ndarray, n: int, registers: int = REGISTERS) -> np.ndarray:
    """BagMinHash signatures (n, registers) of bags given by ``bags``; rows of empty bags are 0.

    A shingle's weight axis is cut into [0, 1), [1, 2), [2, 4), [4, 8), ... Each interval that the
    weight reaches runs a Poisson process with the interval's length as its rate; a point falls on a
    random register and, by halving the interval, on a unit of weight, and counts only if the weight
    covers that unit. A register keeps its earliest point. The points depend on the shingle alone,
    so two bags agree in a register with a probability equal to their weighted Jaccard similarity.
    Processes stop at a text's time limit, which is doubled for texts with an empty register: about
    registers * log(registers) points per text, instead of registers * weight draws.
    """
    out = np.zeros((n, registers), U)
    if not len(text):
        return out
    best = np.full(n * registers, np.inf)
    owner = np.zeros(n * registers, U)
    # processes: one for each shingle and interval
    levels = np.ones(len(times), np.int64)  # number of intervals: 1 + ceil(log2(times))
    big = times > 1
    levels[big] += np.ceil(np.log2(times[big])).astype(np.int64)
    item = np.repeat(np.arange(len(times)), levels)
    level = np.arange(len(item)) - np.repeat(np.cumsum(levels) - levels, levels)
    low = np.where(level == 0, 0, 1 << np.maximum(level - 1, 0))
    rate = np.maximum(low, 1).astype(np.float64)
    seed = mix(key[item] + level.astype(U) * GOLD)
    doc, weight = text[item], times[item]
    total = np.bincount(text, weights=times, minlength=n)
    limit = registers * (np.log(registers) + 3.0) / np.maximum(total, 1.0)
    now, step = np.zeros(len(item)), np.zeros(len(item), np.int64)
    active = np.arange(len(item))
    present = np.zeros(n, bool)
    present[text] = True
    while True:
        while len(active):
            # the next few points of every process that has not reached its limit
            some = np.minimum(np.ceil(rate[active] * np.maximum(limit[doc[active]] - now[active], 0)) + 1, 4096)
            some = some.astype(np.int64)
            p = np.repeat(active, some)
            first = np.cumsum(some) - some
            k = np.arange(len(p)) - np.repeat(first, some) + step[p]
            h = mix(seed[p] + k.astype(U) * GOLD)
            gap = -np.log1p(-_unit(h)) / rate[p]
            run = np.cumsum(gap)
            time = run - np.repeat(run[first] - gap[first], some) + now[p]
            last = first + some - 1
            now[active], step[active] = time[last], step[active] + some
            g = mix(h + U(0x5851F42D4C957F2D))
            unit = low[p] + (mix(g) & (rate[p].astype(U) - U(1))).astype(np.int64)
            ok = np.flatnonzero((time <= limit[doc[p]]) & (unit < weight[p]))
            place = doc[p[ok]] * registers + (g[ok] >> U(8)).astype(np.int64) % registers
            np.minimum.at(best, place, time[ok])
            won = time[ok] == best[place]
            owner[place[won]] = mix(h[ok[won]] + U(3))
            active = active[now[active] <= limit[doc[active]]]
        empty = present & ~np.isfinite(best.reshape(n, registers)).all(1)
        if not empty.any():
            break
        limit[empty] *= 2  # those texts start again
        active = np.flatnonzero(empty[doc])
        now[active], step[active] = 0.0, 0
    return owner.reshape(n, registers)


def signature_rows(docs: DataFrame) -> DataFrame:
    """doc_id, key, bands, sig of all texts; key (hash of the word sequence) is null without words.
    ``bands`` are the hashes of ROWS registers each, ``sig`` keeps 8 bits of every register."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = np.arange(BANDS).astype(U)
        for batch in batches:
            for i, j, data, off in chunks(batch.column(1), 1 << 18):
                n = j - i
                words, doc = word_hashes(data, off)
                key, count = text_keys(words, doc, n)
                full = signatures(*bags(words, doc, n), n)
                band = full[:, :BANDS].copy()
                for r in range(1, ROWS):
                    band = mix(band * GOLD + full[:, r * BANDS:(r + 1) * BANDS])
                band = mix(band + number).view(np.int64)
                none = pa.array(count == 0)
                null = pa.array([None] * n, pa.int64())
                edge = np.arange(n + 1, dtype=np.int32) * BANDS
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(i, n), pc.if_else(none, null, pa.array(key.view(np.int64))),
                     pa.ListArray.from_arrays(pa.array(edge), pa.array(band.ravel())),
                     pa.array([x.tobytes() for x in (full >> U(24)).astype(np.uint8)], pa.binary())],
                    ["doc_id", "key", "bands", "sig"])
    return docs.select("doc_id", "text").mapInArrow(run, "doc_id long, key long, bands array<long>, sig binary")


def shared_bands(rows: DataFrame) -> DataFrame:
    """Distinct (band, key) of the bands that different texts share. Copies meet in the partial
    sums of their task; a band of many copies is a few rows, not a group."""
    each = rows.where("key IS NOT NULL").select("key", F.explode("bands").alias("band"))
    many = each.groupBy("band").agg(F.min("key").alias("lo"), F.max("key").alias("hi")).where("lo < hi").select("band")
    return each.join(many, "band").select("band", "key").distinct()


def _pack_bag(key: np.ndarray, times: np.ndarray) -> bytes:
    """Sorted shingles; behind them the times, unless all are 1."""
    n = len(key).to_bytes(4, "little")
    return n + key.astype("<u8").tobytes() + (times.astype("<u4").tobytes() if (times > 1).any() else b"")


def _bag(raw: bytes) -> tuple[np.ndarray, np.ndarray, int]:
    n = int.from_bytes(raw[:4], "little")
    times = np.frombuffer(raw, "<u4", n, 4 + 8 * n) if len(raw) > 4 + 8 * n else np.ones(n, np.int64)
    return np.frombuffer(raw, "<u8", n, 4), times, int(times.sum())


def similarity(a: tuple, b: tuple) -> float:
    """Weighted Jaccard similarity of two bags."""
    if len(a[0]) > len(b[0]):
        a, b = b, a
    at = np.minimum(np.searchsorted(b[0], a[0]), len(b[0]) - 1)
    same = b[0][at] == a[0]
    both = int(np.minimum(a[1][same], b[1][at[same]]).sum())
    return both / (a[2] + b[2] - both)


def ambiguous_ids(rows: DataFrame, folder: Folder) -> DataFrame:
    """Ids that do not name one row (column ``near_id``); null names none."""
    many = rows.where("doc_id IS NOT NULL").groupBy("doc_id").agg(F.count("*").alias("times")).where("times > 1")
    return folder.keep(many.select(F.col("doc_id").alias("near_id")), "repeated-ids")


def with_keys(docs: DataFrame, text_at: int, key_col: str) -> DataFrame:
    """All columns of ``docs`` and the key of the text in column ``text_at`` (null without words)."""
    names = docs.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i, j, data, off in chunks(batch.column(text_at), 1 << 18):
                key, count = text_keys(*word_hashes(data, off), j - i)
                yield pa.RecordBatch.from_arrays(batch.slice(i, j - i).columns + [pa.array(key.view(np.int64), mask=count == 0)],
                                                 [*names, key_col])

    return docs.mapInArrow(run, T.StructType([*docs.schema.fields, T.StructField(key_col, T.LongType())]))


def bag_rows(docs: DataFrame, rows: DataFrame, shared: DataFrame, many: DataFrame, folder: Folder) -> DataFrame:
    """key, bag, sig, bands of every node that shares a band; one text stands for each node: that of a row
    which its id names, or else one found by its key."""
    named = rows.where("key IS NOT NULL").join(broadcast_ids(many), F.col("doc_id") == F.col("near_id"), "left")
    # copies meet in the partial sums of their task before they are dealt by key
    nodes = named.groupBy("key").agg(F.min(F.when(F.col("near_id").isNull(), F.col("doc_id"))).alias("doc_id"),
                                     F.first("sig").alias("sig"), F.first("bands").alias("bands"))
    inside = folder.keep(nodes.join(shared.select("key").distinct(), "key", "left_semi"), "texts")
    one, signed = inside.where("doc_id IS NOT NULL").select("doc_id", "key"), inside.select("key", "sig", "bands")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i, j, data, off in chunks(batch.column(0), 1 << 18):
                words, doc = word_hashes(data, off)
                text, shingle, times = bags(words, doc, j - i)
                edge = np.searchsorted(text, np.arange(j - i + 1))
                out = [_pack_bag(shingle[a:b], times[a:b]) for a, b in zip(edge[:-1].tolist(), edge[1:].tolist())]
                yield pa.RecordBatch.from_arrays([batch.column(1).slice(i, j - i), pa.array(out, pa.binary())], ["key", "bag"])

    d = docs.select("doc_id", "text")
    bag = d.join(broadcast_ids(one), "doc_id").select("text", "key").mapInArrow(run, "key long, bag binary")
    rest = inside.where("doc_id IS NULL").select("key")
    if not rest.isEmpty():  # only texts without an id, or with one that several rows have
        unnamed = d.join(broadcast_ids(many), F.col("doc_id") == F.col("near_id"), "left").where("doc_id IS NULL OR near_id IS NOT NULL")
        keyed = with_keys(unnamed.select("text"), 0, "key").join(broadcast_ids(rest), "key").groupBy("key").agg(F.first("text").alias("text"))
        bag = bag.unionByName(keyed.select("text", "key").mapInArrow(run, "key long, bag binary"))
    return bag.join(signed, "key")


def star_links(shared: DataFrame, nodes: DataFrame, threshold: float) -> DataFrame:
    """Verified links (u, v) between each node and the least node of each of its bands."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            a, b = ([np.frombuffer(x.as_py(), np.uint8) for x in batch.column(k)] for k in (2, 4))
            keep = []
            for k in range(batch.num_rows):
                keep.append(int((a[k] == b[k]).sum()) >= LEAST and
                            similarity(_bag(batch.column(3)[k].as_py()), _bag(batch.column(5)[k].as_py())) >= threshold)
            yield batch.select(["u", "v"]).filter(pa.array(keep, pa.bool_()))

    least = shared.groupBy("band").agg(F.min("key").alias("v"))
    pairs = shared.join(least, "band").where("key <> v").select(F.col("key").alias("u"), "v").distinct()
    u = nodes.select(F.col("key").alias("u"), F.col("sig").alias("su"), F.col("bag").alias("bu"))
    v = nodes.select(F.col("key").alias("v"), F.col("sig").alias("sv"), F.col("bag").alias("bv"))
    return (pairs.join(u, "u").join(v, "v").select("u", "v", "su", "bu", "sv", "bv")
            .mapInArrow(run, "u long, v long"))


def tiles(shared: DataFrame, labels: DataFrame) -> DataFrame:
    """band, i, j, side, key, label: the tiles whose pairs are still open."""
    least = shared.groupBy("band").agg(F.min("key").alias("least"))  # compared with all by the star
    rows = (shared.join(least, "band").where("key <> least")
            .join(labels.withColumnRenamed("node", "key"), "key", "left")
            .select("band", "key", F.coalesce("label", "key").alias("label")))
    sizes = rows.groupBy("band", "label").agg(F.count("*").alias("n"))
    bands = (sizes.groupBy("band").agg(F.max(F.struct("n", "label")).alias("top"), F.sum("n").alias("n"))
             .where("n > top.n")
             .select("band", F.col("top.label").alias("main"), F.ceil(F.col("top.n") / TILE).alias("main_tiles"),
                     F.ceil((F.col("n") - F.col("top.n")) / TILE).alias("rest_tiles")))
    x = rows.join(bands, "band")
    place = F.xxhash64("key", F.lit(5))
    # a main row meets every rest tile; a rest row every main tile (i >= 0, j < 0) and every rest tile
    main = x.where("label = main").select("band", "key", "label", F.explode(F.expr("sequence(1L, rest_tiles)")).alias("i"),
                                          (-1 - F.pmod(place, F.col("main_tiles"))).alias("j"), F.lit(1).alias("side"))
    rest = x.where("label <> main").withColumn("t", F.pmod(place, F.col("rest_tiles")) + 1)
    against_main = rest.select("band", "key", "label", F.col("t").alias("i"),
                               F.explode(F.expr("sequence(-1L, -main_tiles, -1L)")).alias("j"), F.lit(0).alias("side"))
    among = (rest.select("band", "key", "label", "t", F.explode(F.expr("sequence(1L, rest_tiles)")).alias("o"))
             .select("band", "key", "label", F.least("t", "o").alias("i"), F.greatest("t", "o").alias("j"),
                     F.when(F.col("t") < F.col("o"), 0).when(F.col("t") > F.col("o"), 1).otherwise(2).alias("side")))
    return main.unionByName(against_main).unionByName(among)


def tile_links(tiled: DataFrame, nodes: DataFrame, threshold: float) -> DataFrame:
    """Verified links (u, v) that join components inside the tiles."""
    def run(key: tuple, rows: pa.Table) -> pa.Table:
        band = key[0].as_py()
        node, label = rows.column("key").to_pylist(), rows.column("label").to_pylist()
        side = rows.column("side").to_numpy()
        left = np.flatnonzero(side != 1)
        right = np.flatnonzero(side != 0)
        out_u, out_v = [], []
        if len(left) and len(right):
            sig = np.stack([np.frombuffer(x.as_py(), np.uint8) for x in rows.column("sig")])
            bands = np.array(rows.column("bands").to_pylist(), np.int64)
            raw = rows.column("bag")
            bag: dict = {}
            above = {x: x for x in label}

            def root(x):
                while above[x] != x:
                    above[x] = above[above[x]]
                    x = above[x]
                return x

            found = []
            for a in left.tolist():
                other = right[right > a] if side[a] == 2 else right
                agree = (sig[other] == sig[a]).sum(1)
                first = (bands[other] == bands[a]).argmax(1)
                here = (agree >= LEAST) & (bands[a][first] == band)
                found += [(-int(n), a, b) for n, b in zip(agree[here].tolist(), other[here].tolist())]
            for _, a, b in sorted(found):
                x, y = root(label[a]), root(label[b])
                if x == y:
                    continue
                for k in (a, b):
                    if k not in bag:
                        bag[k] = _bag(raw[k].as_py())
                if similarity(bag[a], bag[b]) >= threshold:
                    above[max(x, y)] = min(x, y)
                    out_u.append(node[a])
                    out_v.append(node[b])
        return pa.table([pa.array(out_u, pa.int64()), pa.array(out_v, pa.int64())], ["u", "v"])

    return tiled.join(nodes, "key").groupBy("band", "i", "j").applyInArrow(run, "u long, v long")


def _classified(d: DataFrame, threshold: float, folder: Folder) -> tuple[DataFrame, DataFrame]:
    """((doc_id, key, c) of every row of ``d`` (doc_id, text), ids that several rows have). ``c`` names the class."""
    rows = folder.keep(signature_rows(d), "signatures")
    shared = folder.keep(shared_bands(rows), "bands")
    many = ambiguous_ids(rows, folder)
    nodes = folder.keep(bag_rows(d, rows, shared, many, folder), "bags")
    star = folder.keep(star_links(shared, nodes, threshold), "star")
    rest = tile_links(tiles(shared, components(star, folder)), nodes, threshold)
    links = folder.keep(star.unionByName(rest), "links")
    labels = components(links, folder).withColumnRenamed("node", "key")
    named = rows.select("doc_id", "key").join(labels, "key", "left")
    # without words: a class for each doc_id
    return named.select("doc_id", "key", F.struct(F.coalesce("label", "key").alias("label"),
                                                  F.when(F.col("key").isNull(), F.col("doc_id")).alias("own")).alias("c")), many


def near_duplicates(docs: DataFrame, threshold: float = 0.8, id_col: str = "doc_id",
                    text_col: str = "text") -> DataFrame:
    """doc_id, class_id, class_size (rows of the class) of every row of ``docs``."""
    d = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    named, _ = _classified(d, threshold, Folder(docs.sparkSession, "neardup"))
    classes = named.groupBy("c").agg(F.min("doc_id").alias("class_id"), F.count("*").alias("class_size"))
    return named.join(classes.withColumnRenamed("c", "k"), F.col("c").eqNullSafe(F.col("k"))).select(
        "doc_id", "class_id", "class_size")


def one_of_each(docs: DataFrame, threshold: float = 0.8, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row of each class of ``docs``, all columns: that with the least doc_id (null last), of the rows
    with that id the one with the least key. Rows are told apart by (doc_id, key), so unlike texts that
    share an id are decided each for itself, and copies without an id leave one row."""
    folder = Folder(docs.sparkSession, "one-of-each")
    d = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    named, many = _classified(d, threshold, folder)
    named = folder.keep(named, "classes")
    place = F.struct(F.col("doc_id").isNull().alias("none"), F.col("doc_id").alias("id"), F.col("key").alias("key"))
    best = folder.keep(named.groupBy("c").agg(F.min(place).alias("best")).select("best.id", "best.key"), "best")
    # rows that their id names are decided by it
    own = named.where("doc_id IS NOT NULL").select("doc_id")
    goes = folder.keep(own.join(best.where("id IS NOT NULL").select(F.col("id").alias("doc_id")), "doc_id", "left_anti")
                       .distinct().select(F.col("doc_id").alias("near_copy_id")), "goes")
    at = F.col(id_col).cast("long")
    kept = docs.join(broadcast_ids(goes), at == F.col("near_copy_id"), "left_anti")
    unnamed = named.where("doc_id IS NULL").limit(1).count() + many.limit(1).count()
    if not unnamed:
        return kept
    plain = kept.where(at.isNotNull()).join(broadcast_ids(many), at == F.col("near_id"), "left_anti")
    rest = kept.join(broadcast_ids(many), at == F.col("near_id"), "left").where(at.isNull() | F.col("near_id").isNotNull())
    names = docs.columns
    keyed = with_keys(rest.select(*names), names.index(text_col), "near_key")
    chosen = best.select(F.col("id").alias("near_best_id"), F.col("key").alias("near_best_key"))
    alone = keyed.join(chosen, at.eqNullSafe(F.col("near_best_id")) & F.col("near_key").eqNullSafe(F.col("near_best_key")), "left_semi")
    return plain.unionByName(alone.dropDuplicates([id_col, "near_key"]).select(*names))
