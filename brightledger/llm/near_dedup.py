"""Near-duplicate groups by HyperMinHash.

A document's set is its distinct shingles of ``shingle`` consecutive words, A-Z lower-cased. Documents are linked if the similarity of their sets is at least
``percent`` of a hundred, and a group is all that links connect.

1. Each document gets its signature (see ``hyperminhash``) and the keys of its bands. Documents with equal sets are one node from here on, so copies cost
   nothing however many there are.
2. In each band bucket, every node is paired with the smallest node there: as many pairs as rows, never all pairs. Pairs whose estimated similarity,
   corrected for chance agreement, is clearly too low are dropped; the rest are confirmed on the full sets.
3. The links found so far give groups. A bucket whose nodes are all in one group can add nothing. In the others only pairs across groups matter, between nodes that are
   not of the bucket's largest group and the rest; they are compared in blocks of ``BLOCK`` nodes, first by their signatures to see which nodes take part at
   all, then on the full sets, about ``BLOCK_BYTES`` of them at a time. Only links come out of a block, one for each node and group.

Nothing is capped: a bucket of any size is dealt out to as many blocks as it needs. A pair at a similarity of exactly 0.8 shares no band with probability 3e-6, and passes the
estimate with probability above 0.999999; more similar pairs miss far less.

Defined cases: null text counts as empty, and a text without words has an empty set and is linked with nothing; a text of fewer words than a
shingle is one shingle; a null doc_id is larger than any other; rows that share a doc_id are separate rows with equal or different sets; an empty table gives
an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from . import hyperminhash as H
from .common import settle, text_or_empty
from .graph import components

BLOCK = 1024
#: Bytes of full sets that are compared in one block; a block with more is dealt out to smaller ones.
BLOCK_BYTES = 64 << 20
#: Rows that a task compares at least, where a table has so few that its shuffle partitions hold less.
WORK_ROWS = 2 * BLOCK
#: Values of sets that are looked at at once within a block.
VALUES = 1 << 20
#: A pair is dropped if its estimated similarity is lower than the threshold by more than this, 4.8 standard deviations.
MARGIN = 0.12

_SIGNED = "doc_id long, th long, n long, key binary, signatures array<struct<level:int,registers:binary,bands:array<long>>>"
_SIGNATURES = pa.list_(pa.struct([("level", pa.int32()), ("registers", pa.binary()), ("bands", pa.list_(pa.int64()))]))


def _key(shingles: np.ndarray) -> bytes:
    import xxhash

    return xxhash.xxh3_128_digest(shingles.tobytes())


def _margin(share: float) -> float:
    """Five standard deviations of the estimate, ``MARGIN`` at least."""
    return max(MARGIN, 5 * (share * (1 - share) / H.REGISTERS) ** 0.5 if share < 0.8 else 0)


def _sign(shingle: int, share: float):
    band = H.band_rows(share)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for low in range(0, batch.num_rows, 512):
                part = batch.slice(low, 512)
                sets = H.shingle_sets([t.encode() for t in part.column(2).to_pylist()], shingle)
                signed = []
                for s in sets:
                    own = []
                    for at in H.levels(len(s), share):
                        r = H.registers(s, at)
                        own.append({"level": at, "registers": r.tobytes(), "bands": H.band_keys(r, at, band).view(np.int64)})
                    signed.append(own)
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), part.column(1), pa.array([len(s) for s in sets], pa.int64()), pa.array([_key(s) for s in sets], pa.binary()), pa.array(signed, _SIGNATURES)],
                    names=["doc_id", "th", "n", "key", "signatures"],
                )

    return run


def _sets(shingle: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for low in range(0, batch.num_rows, 512):
                part = batch.slice(low, 512)
                sets = H.shingle_sets([t.encode() for t in part.column(3).to_pylist()], shingle)
                good = pa.array([_key(s) == k for s, k in zip(sets, part.column(1).to_pylist(), strict=True)])
                shingles = pa.array([s.tobytes() for s in sets], pa.binary())
                yield pa.RecordBatch.from_arrays([part.column(0), shingles, part.column(2)], names=["node", "shingles", "signatures"]).filter(good)

    return run


def _unpack(data: bytes) -> np.ndarray:
    return np.frombuffer(data, np.uint64)


def _confirm(percent: int, share: float):
    """Pairs (a, b, shingles and signatures of both) to the links among them."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found, last, other = [], None, None
            for low in range(0, batch.num_rows, 256):
                for a, b, one, two, sig1, sig2 in zip(*(c.to_pylist() for c in batch.slice(low, 256).columns), strict=True):
                    n1, n2 = len(one) // 8, len(two) // 8
                    if 100 * min(n1, n2) < percent * max(n1, n2):
                        continue
                    regs = [{s["level"]: s["registers"] for s in sig} for sig in (sig1, sig2)]
                    at = H.level(max(n1, n2))
                    if at in regs[0] and at in regs[1]:
                        r1, r2 = (np.frombuffer(r[at], np.uint8)[None] for r in regs)
                        if H.estimate(r1, r2, np.array([n1]), np.array([n2]))[0] < share - _margin(share):
                            continue
                    if b != last:
                        last, other = b, _unpack(two)
                    if H.alike(_unpack(one), other, percent):
                        found.append((a, b))
            if found:
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*found, strict=True)], names=["a", "b"])

    return run


def _crossing(group: dict[str, list]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of a block: rows that stand as members, rows that are compared with them, and the groups of all rows."""
    role, stray = np.array(group["role"]), np.array(group["stray"])
    # With one block of each kind the strays are among the members and not sent twice.
    asked = np.flatnonzero(role == 1) if (role == 1).any() else np.flatnonzero(stray)
    return np.flatnonzero(role == 0), asked, np.array(group["component"], np.int64)


def _plausible(share: float):
    """The rows of a block that have a partner in another group which their signatures don't rule out."""

    def run(table: pa.Table) -> pa.Table:
        group = table.to_pydict()
        members, asked, component = _crossing(group)
        regs = np.stack([np.frombuffer(r, np.uint8) for r in group["registers"]])
        bands = np.array(group["bands"], np.int64)
        size = np.array(group["n"], np.int64)
        place = int(np.flatnonzero((bands == group["band"][0]).all(axis=0))[0])
        takes = np.zeros(len(size), bool)
        for i in asked.tolist():
            near = members[component[members] != component[i]]
            near = near[np.minimum(size[near], size[i]) >= share * np.maximum(size[near], size[i]) - 1e-9]
            # A pair that shares an earlier band is seen there.
            near = near[~(bands[near, :place] == bands[i, :place]).any(axis=1)]
            if not len(near):
                continue
            near = near[H.estimate(regs[near], regs[i][None], size[near], size[i][None]) >= share - _margin(share)]
            if len(near):
                takes[near] = takes[i] = True
        return table.select(["band", "mb", "sb", "role", "stray", "node", "component", "n"]).filter(pa.array(takes))

    return run


def _block_links(percent: int):
    """Links across groups in a block, one for each row and group of its partners."""

    def run(table: pa.Table) -> pa.Table:
        group = table.to_pydict()
        members, asked, component = _crossing(group)
        found = []
        if len(members) and len(asked):
            sets = [_unpack(s) for s in group["shingles"]]
            size = np.array([len(s) for s in sets], np.int64)
            common = _common([sets[i] for i in asked], [sets[i] for i in members])
            ok = 100 * common >= percent * (size[asked][:, None] + size[members][None] - common)
            ok &= component[asked][:, None] != component[members][None]
            for k, i in enumerate(asked.tolist()):
                hits = members[ok[k]]
                _, first = np.unique(component[hits], return_index=True)
                found += [(group["node"][i], group["node"][j]) for j in hits[first].tolist()]
        return pa.table({"a": pa.array([a for a, _ in found], pa.int64()), "b": pa.array([b for _, b in found], pa.int64())})

    return run


def _common(rows: list[np.ndarray], cols: list[np.ndarray], width: int = 4096) -> np.ndarray:
    """How many values each row set shares with each column set."""
    total = sum(len(s) for s in rows + cols)
    if total > VALUES:
        # Sets are sorted and values are spread evenly: a range of them after the other, so that the arrays below stay small.
        bounds = np.linspace(0, 2.0**64, -(-2 * total // VALUES) + 1)[1:-1].astype(np.uint64)
        cuts = [[np.split(s, np.searchsorted(s, bounds)) for s in side] for side in (rows, cols)]
        return sum(_common(*([s[k] for s in side] for side in cuts), width) for k in range(len(bounds) + 1))
    values, at = np.unique(np.concatenate(rows + cols), return_inverse=True)
    owner = np.repeat(np.arange(len(rows) + len(cols)), [len(s) for s in rows + cols])
    order = np.argsort(at, kind="stable")
    at, owner = at[order], owner[order]
    out = np.zeros((len(rows), len(cols)), np.float64)
    for low in range(0, len(values), width):
        a, b = np.searchsorted(at, [low, low + width])
        dense = np.zeros((len(rows) + len(cols), width), np.float32)
        dense[owner[a:b], at[a:b] - low] = 1
        out += dense[: len(rows)] @ dense[len(rows) :].T
    return out.astype(np.int64)


def groups(docs: DataFrame, shingle: int = 2, percent: int = 80, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: doc_id, th (xxhash64 of the text), n_shingles, component_id, first (the row that stays for its group)."""
    share = percent / 100
    picked = docs.select(F.col(id_col).cast("long").alias("doc_id"), text_or_empty(text_col).alias("text"))
    picked = picked.select("doc_id", F.xxhash64("text").alias("th"), "text")
    signed = settle(picked.mapInArrow(_sign(shingle, share), _SIGNED).withColumn("rid", F.monotonically_increasing_id()), "signatures")
    filled = signed.where("n > 0")
    most = signed.count()
    nodes = settle(filled.groupBy("key").agg(F.min("rid").alias("node"), F.min("doc_id").alias("least")), "nodes", most)
    # The band keys of one row for each distinct set.
    single = filled.join(nodes.select(F.col("node").alias("rid")), "rid", "left_semi")
    each = single.select(F.col("rid").alias("node"), F.explode("signatures").alias("s"))
    bands = settle(each.select("node", F.col("s.level").alias("level"), F.explode("s.bands").alias("band")), "bands")
    banded = bands.count()
    buckets = settle(bands.groupBy("band").agg(F.min("node").alias("rep"), F.count(F.lit(1)).alias("rows")).where("rows > 1").drop("rows"), "buckets", banded)
    crowd = settle(bands.join(buckets, "band"), "crowd", banded)
    crowded = crowd.count()

    # Full sets of the nodes that share a band with any other, from their texts.
    needed = crowd.select("node").distinct().join(signed.withColumnRenamed("rid", "node"), "node").select("node", "doc_id", "th", "key", "signatures")
    same = (picked["th"] == needed["th"]) & picked["doc_id"].eqNullSafe(needed["doc_id"])
    texts = picked.join(needed, same).select("node", "key", "signatures", "text")
    sets = settle(
        texts.mapInArrow(_sets(shingle), "node long, shingles binary, " + _SIGNED.rpartition(", ")[2]).dropDuplicates(["node"]), "sets", crowded, WORK_ROWS
    )

    def side(name: str, k: int) -> DataFrame:
        return sets.select(F.col("node").alias(name), F.col("shingles").alias(f"set{k}"), F.col("signatures").alias(f"sig{k}"))

    pairs = crowd.where("node != rep").select(F.col("node").alias("a"), F.col("rep").alias("b")).distinct()
    known = pairs.join(side("a", 1), "a").join(side("b", 2), "b").select("a", "b", "set1", "set2", "sig1", "sig2")
    links = settle(known.mapInArrow(_confirm(percent, share), "a long, b long"), "links", crowded, WORK_ROWS)

    def labelled(rows: DataFrame, label: DataFrame) -> DataFrame:
        return rows.join(label, "node", "left").withColumn("component", F.coalesce("component", "node"))

    placed = settle(labelled(crowd.drop("rep"), components(links)), "placed")
    links = links.unionByName(_across(placed, sets, percent, share))
    label = components(links)

    least = settle(labelled(nodes, label), "labelled")
    smallest = least.groupBy("component").agg(F.min("least").alias("component_id"))
    by_key = settle(least.join(smallest, "component").select("key", "component", "component_id"), "groups")
    rows = filled.select("doc_id", "th", "n", "rid", "key").join(by_key, "key")
    order = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "rid")
    stays = settle(rows.groupBy("component").agg(F.min(order).alias("stays")).select(F.col("stays.rid").alias("rid"), F.lit(True).alias("first")), "stays", most)
    linked = rows.join(stays, "rid", "left").select("doc_id", "th", "n", "component_id", F.coalesce("first", F.lit(False)).alias("first"))
    empty = signed.where("n = 0").select("doc_id", "th", "n", F.col("doc_id").alias("component_id"), F.lit(True).alias("first"))
    return linked.unionByName(empty).withColumnRenamed("n", "n_shingles")


def _across(placed: DataFrame, sets: DataFrame, percent: int, share: float) -> DataFrame:
    """Links between nodes of one bucket that the first links left in different groups."""
    sizes = placed.groupBy("band", "component").agg(F.count(F.lit(1)).alias("n"))
    largest = sizes.groupBy("band").agg(
        F.max(F.struct("n", "component")).alias("main"), F.sum("n").alias("rows"), F.count(F.lit(1)).alias("groups")
    )
    blocks = (F.ceil(F.col(n) / BLOCK).cast("int") for n in ("rows", "others"))
    mixed = settle(
        largest.where("groups > 1")
        .withColumn("others", F.col("rows") - F.col("main.n"))
        .select("band", F.col("main.component").alias("main"), *(b.alias(c) for b, c in zip(blocks, ("mbs", "sbs"), strict=True))),
        "mixed",
        placed.count(),
    )
    rows = placed.join(mixed, "band").withColumn("stray", F.col("component") != F.col("main"))

    def dealt(df: DataFrame, role: int, mb: Column, sb: Column) -> DataFrame:
        return df.select("band", "level", "node", "component", "stray", F.lit(role).alias("role"), mb.alias("mb"), sb.alias("sb"))

    own = F.pmod(F.xxhash64("node"), F.col("mbs")).cast("int"), F.pmod(F.xxhash64("node", "band"), F.col("sbs")).cast("int")
    members = dealt(rows, 0, own[0], F.explode(F.sequence(F.lit(0), F.col("sbs") - 1)))
    strays = dealt(rows.where("stray and (mbs > 1 or sbs > 1)"), 1, F.explode(F.sequence(F.lit(0), F.col("mbs") - 1)), own[1])
    block = settle(members.unionByName(strays), "blocks")
    size = block.count()
    signature = F.filter("signatures", lambda s: s["level"] == F.col("level"))[0]
    seen = block.join(sets.select("node", F.length("shingles").alias("bytes"), "signatures"), "node").select(
        "band", "mb", "sb", "role", "stray", "node", "component", (F.col("bytes") / 8).cast("long").alias("n"),
        signature["registers"].alias("registers"), signature["bands"].alias("bands"),
    )
    plausible = settle(
        seen.groupBy("band", "mb", "sb").applyInArrow(_plausible(share), "band long, mb int, sb int, role int, stray boolean, node long, component long, n long"),
        "plausible",
        size,
        WORK_ROWS,
    )
    full = _by_bytes(plausible).join(sets.select("node", "shingles"), "node")
    return settle(full.groupBy("band", "mb", "sb", "mp", "sp").applyInArrow(_block_links(percent), "a long, b long"), "links", plausible.count(), WORK_ROWS)


def _by_bytes(rows: DataFrame) -> DataFrame:
    """Rows of blocks with mp and sp, the parts of a block in which its members and strays meet: one part, or as many of each as its sets need."""
    block = W.partitionBy("band", "mb", "sb")
    rows = rows.withColumn("parts", F.ceil(8 * F.sum("n").over(block) / BLOCK_BYTES).cast("int")).withColumn("asked", F.max("role").over(block)).drop("n")
    parts = F.explode(F.sequence(F.lit(0), F.col("parts") - 1))
    whole = rows.where("parts <= 1").withColumns({"mp": F.lit(0), "sp": F.lit(0)})
    large = rows.where("parts > 1")
    members = large.where("role = 0").withColumn("mp", F.pmod(F.xxhash64("node", F.lit(1)), "parts").cast("int")).withColumn("sp", parts)
    # In a block that holds its whole bucket the strays are among the members.
    strays = large.where("role = 1 or asked = 0 and stray").withColumn("role", F.lit(1))
    strays = strays.withColumn("mp", parts).withColumn("sp", F.pmod(F.xxhash64("node", F.lit(2)), "parts").cast("int"))
    return whole.unionByName(members).unionByName(strays).drop("parts", "asked")


def deduplicate(docs: DataFrame, shingle: int = 5, percent: int = 80, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows that stay, one of each group, with all their columns."""
    stays = settle(groups(docs, shingle, percent, id_col, text_col).where("first").select(F.col("doc_id").alias("id"), F.col("th").alias("hash")), "stays")
    whole = docs.select(F.struct("*").alias("row"), F.col(id_col).cast("long").alias("id"), F.xxhash64(text_or_empty(text_col)).alias("hash"))
    # Two hashes name a row, null ids included, so that the join and the numbering below share one shuffle of the texts.
    place = ["hash", "both"]
    both = F.xxhash64("id", "hash").alias("both")
    counts = stays.groupBy("hash", both).agg(F.count(F.lit(1)).alias("copies"))
    kept = whole.select("row", "hash", both).join(counts, place)
    # Rows that share doc_id and text are numbered, as they are in the list of those that stay.
    copy = W.partitionBy(*place).orderBy(F.xxhash64("row"))
    return kept.withColumn("copy", F.row_number().over(copy)).where("copy <= copies").select("row.*")
