"""Prefix trie of conversations, packed as double arrays per prefix shard.

A node is a sequence of first turns that some conversation has; the root has
none. The distinct turn sequences are put in lexicographic order and cut into
shards by range, so a shard holds one stretch of the trie and a prefix that a
third of all conversations share is cut by the turns after it. In a shard:

1. Turns get dense ids in the order in which the trie meets them.
2. BASE and CHECK arrays are packed depth by depth: the child of state ``s``
   by turn ``c`` is slot ``t = BASE[s] + c`` with ``CHECK[t] = s``. Nodes of
   several children take the first base that fits, the others fill the holes.
3. All sequences are walked through the arrays at once, which counts members;
   leaves and saved tokens are summed from the deepest nodes up.

Only nodes on a shard's first or last sequence can also be in another shard.
These upper nodes are merged in rounds: ``FAN`` neighbouring shards give one,
in which all but the outermost sequences' nodes are settled, until one is left.

Long conversations are cut into segments of ``SEGMENT`` turns, so no row grows
with a conversation; the segments of a depth are tries of their own below the
nodes that they hang on, and hand their sums up. A node is named by 128 bits:
the exclusive-or over its turns of hashes of SHA-256 digest and place.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from trackmart.llm.common import CRC32_SQL, WORD, prepare, spread, stored, table

FAMILY = 20  # conversation c takes its first turns from c - c % FAMILY
SEGMENT = 4096  # turns of a conversation in one row
SHARD_TURNS = 400_000  # turns of the sequences packed into one double array
FAN = 32  # shards merged into one in a round
CHUNK_IDS = 4096  # conversation ids joined in one row
NO_ENDS = hashlib.sha256(b"").hexdigest()


# --- rebuilt conversations ---------------------------------------------------------

def _number(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by conversation get their place among the conversation's
    rows of this partition."""
    part, last, seen = TaskContext.get().partitionId(), None, 0
    for batch in batches:
        if not batch.num_rows:
            continue
        conv = batch.column(0).to_numpy()
        new = np.flatnonzero(np.append(True, conv[1:] != conv[:-1]))
        if conv[0] != last:
            seen = 0
        start = np.repeat(new, np.diff(np.append(new, len(conv))))
        place = np.arange(len(conv)) - start
        place[start == 0] += seen
        last, seen = conv[-1], int(place[-1]) + 1
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(np.full(len(conv), part, np.int32)), pa.array(place), *batch.columns[2:]],
                                         names=["conv_id", "part", "place", "a", "b", "w"])


def numbered_turns(turns: DataFrame) -> DataFrame:
    """``conv_id, pos, a, b, w``: every turn's place in its conversation (from
    0), the two halves of its digest and its words.

    The order is by turn (null first), then by digest. A conversation may
    stretch over several range partitions, each of which counts on from the
    one before; the driver gets one row per partition for that.
    """
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    mark = F.sha2(F.concat(F.length(role).cast("string"), F.lit(":"), role, text), 256)
    rows = turns.where("conv_id IS NOT NULL").select(
        F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"),
        F.conv(F.substring(mark, 1, 16), 16, -10).cast("long").alias("a"), F.conv(F.substring(mark, 17, 16), 16, -10).cast("long").alias("b"),
        F.regexp_count(text, F.lit(WORD)).cast("long").alias("w"))
    keys = ["conv_id", "turn"]
    digest = [x for c in ("a", "b") for x in (F.shiftrightunsigned(c, 1), c)]  # as unsigned numbers
    rows = rows.repartitionByRange(spread(turns), *keys).sortWithinPartitions(*keys, *digest)
    rows = stored(rows.mapInArrow(_number, "conv_id long, part int, place long, a long, b long, w long"), "trie-turns")
    ends = rows.groupBy("part").agg(F.min("conv_id").alias("first"), F.max(F.struct("conv_id", "place")).alias("last")).orderBy("part").collect()
    shifts, before, total = [], None, 0
    for e in ends:
        shift = total if e["first"] == before else 0
        if shift:
            shifts.append((e["part"], e["first"], shift))
        before = e["last"]["conv_id"]
        total = e["last"]["place"] + 1 + (shift if before == e["first"] else 0)
    pos = F.col("place")
    if shifts:  # at most one conversation a partition
        rows = rows.join(rows.sparkSession.createDataFrame(shifts, "part int, conv_id long, shift long"), ["part", "conv_id"], "left")
        pos = pos + F.coalesce("shift", F.lit(0))
    return rows.select("conv_id", pos.alias("pos"), "a", "b", "w")


def _borrowed() -> Column:
    return F.crc32(F.col("conv_id").cast("string")) % 4


def rebuilt_turns(rows: DataFrame, family: int = FAMILY) -> DataFrame:
    """``conv_id, pos, a, b, w`` of every rebuilt conversation: the first ``h``
    turns of the family's first one (crc32 of the id, modulo 4), then its own
    after its first ``h``; and one row with null ``pos`` for each conversation,
    so that one without turns is not lost."""
    head = F.col("conv_id") - F.pmod("conv_id", F.lit(family))
    heads = (rows.where(f"pos < 3 AND pmod(conv_id, {family}) = 0").groupBy(F.col("conv_id").alias("head"))
             .agg(F.sort_array(F.collect_list(F.struct("pos", "a", "b", "w"))).alias("turns")))  # three at most
    convs = rows.where("pos = 0").select("conv_id", head.alias("head"), _borrowed().cast("int").alias("h")).join(heads, "head", "left")
    convs = stored(convs.select("conv_id", F.when(F.col("h") > 0, F.slice(F.coalesce("turns", F.expr("array()")), 1, F.greatest("h", F.lit(1))))
                                .otherwise(F.expr("array()")).alias("turns")), "trie-heads")
    first = convs.select("conv_id", F.explode("turns").alias("t")).select("conv_id", "t.*")
    own = rows.where(F.col("pos") >= _borrowed()).join(convs.select("conv_id", F.size("turns").alias("n")), "conv_id")
    own = own.select("conv_id", (F.col("pos") - _borrowed() + F.col("n")).alias("pos"), "a", "b", "w")
    nothing = F.lit(None).cast("long")
    marks = convs.select("conv_id", *[nothing.alias(c) for c in ("pos", "a", "b", "w")])
    return first.unionByName(own).unionByName(marks)


def segments(turns: DataFrame, size: int) -> DataFrame:
    """One row per conversation and ``size`` turns: ``path`` (the turns), ``n``,
    ``p1, p2`` (name of the node it hangs on), ``e1, e2`` (of its last one) and
    whether it is the conversation's last."""
    pos = F.col("pos")
    rows = turns.select("conv_id", F.coalesce(F.floor(pos / size), F.lit(0)).cast("int").alias("seg"),
                        F.when(pos.isNotNull(), F.struct(pos, "a", "b", F.xxhash64("a", "pos").alias("x"), F.xxhash64("pos", "b").alias("y"), "w")).alias("t"))
    zero = F.lit(0).cast("long")
    segs = rows.groupBy("conv_id", "seg").agg(
        F.sort_array(F.collect_list("t")).alias("path"), F.count("t").alias("n"),
        F.coalesce(F.bit_xor("t.x"), zero).alias("x"), F.coalesce(F.bit_xor("t.y"), zero).alias("y"))
    segs = stored(segs, "trie-segments")
    if not segs.where("seg > 0").limit(1).count():
        return segs.select("*", zero.alias("p1"), zero.alias("p2"), F.col("x").alias("e1"), F.col("y").alias("e2"), F.lit(True).alias("last"))
    order = Window.partitionBy("conv_id").orderBy("seg")
    upto = order.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    segs = segs.select("*", F.bit_xor("x").over(upto).alias("e1"), F.bit_xor("y").over(upto).alias("e2"), F.lead("seg").over(order).isNull().alias("last"))
    return stored(segs.select("*", F.expr("e1 ^ x").alias("p1"), F.expr("e2 ^ y").alias("p2")), "trie-chained")


# --- double arrays -----------------------------------------------------------------

class DoubleArray:
    """A trie over dense codes from 1: ``base[s] + c`` is the slot of the child
    of state ``s`` by ``c`` if ``check`` there is ``s``. State 0 is the root."""

    def __init__(self, size: int) -> None:
        self.base, self.check = np.zeros(size + 2, np.int64), np.full(size + 2, -1, np.int64)
        self.check[0], self.low = 0, 1

    def _room(self, n: int) -> None:
        if n > len(self.check):
            more = max(n, len(self.check) * 3 // 2) - len(self.check)
            self.base = np.append(self.base, np.zeros(more, np.int64))
            self.check = np.append(self.check, np.full(more, -1, np.int64))

    def _fit(self, steps: np.ndarray) -> int:
        """First free slot from which all ``steps`` ahead are free too."""
        at, width = self.low, max(1, (1 << 18) // len(steps))
        while True:
            self._room(at + width + int(steps[-1]) + 1)
            free = at + np.flatnonzero(self.check[at:at + width] < 0)
            fits = free[(self.check[free[:, None] + steps] < 0).all(axis=1)] if len(free) else free
            if len(fits):
                return int(fits[0])
            at += width

    def add(self, parents: np.ndarray, codes: np.ndarray) -> None:
        """Children of states that have none, as pairs sorted by parent and code."""
        first = np.flatnonzero(np.append(True, parents[1:] != parents[:-1]))
        sizes = np.diff(np.append(first, len(parents)))
        for k in np.flatnonzero(sizes > 1).tolist():
            s, own = parents[first[k]], codes[first[k]:first[k] + sizes[k]]
            self.base[s] = self._fit(own - own[0]) - own[0]
            self.check[self.base[s] + own] = s
        single = first[sizes == 1]
        if len(single):
            self._room(self.low + int((self.check[self.low:] >= 0).sum()) + len(single))
            slots = self.low + np.flatnonzero(self.check[self.low:] < 0)[:len(single)]
            self.base[parents[single]] = slots - codes[single]
            self.check[slots] = parents[single]
        taken = self.check[self.low:] >= 0
        self.low += int(taken.argmin()) if not taken.all() else len(taken)

    def step(self, states: np.ndarray, codes: np.ndarray) -> np.ndarray:
        """The states that follow, -1 where there is none."""
        to = self.base[states] + codes
        inside = (to > 0) & (to < len(self.check))
        to = np.where(inside, to, 0)
        return np.where(inside & (self.check[to] == states), to, -1)


def pack(turns: np.ndarray, offsets: np.ndarray) -> tuple[DoubleArray, np.ndarray]:
    """The double array of sequences laid end to end (``turns``: any numbers
    that tell turns apart), and the dense code of every turn, from 1."""
    codes_of, known = np.zeros(int(turns.max(initial=-1)) + 1, np.int64), 0
    trie, sizes = DoubleArray(len(turns) + 1), np.diff(offsets)
    state = np.zeros(len(sizes), np.int64)
    for depth in range(int(sizes.max(initial=0))):
        live = np.flatnonzero(sizes > depth)
        own = turns[offsets[:-1][live] + depth]
        order = np.lexsort((own, state[live]))
        s, u = state[live][order], own[order]
        new = np.append(True, (s[1:] != s[:-1]) | (u[1:] != u[:-1]))
        s, u = s[new], u[new]
        fresh = u[codes_of[u] == 0]  # coded in the order of their parents, so brothers are neighbours
        fresh = fresh[np.sort(np.unique(fresh, return_index=True)[1])]
        codes_of[fresh] = known + 1 + np.arange(len(fresh))
        known += len(fresh)
        order = np.lexsort((codes_of[u], s))
        trie.add(s[order], codes_of[u][order])
        state[live] = trie.step(state[live], codes_of[own])
    return trie, codes_of[turns]


# --- shards ------------------------------------------------------------------------

_NODE = ("id1 long, id2 long, up1 long, up2 long, depth long, conv long, up_conv long, n long, w long, "
         "kids long, leaves long, saved long, shard long, first boolean, last boolean")
_NAMES = [x.split()[0] for x in _NODE.split(", ")]


def _arrow(cols: dict, some: np.ndarray) -> pa.RecordBatch:
    hide = ~cols["known"][some]
    arrays = [pa.array(cols[c][some], mask=hide) if c == "up_conv" else pa.array(cols[c][some]) for c in _NAMES]
    return pa.RecordBatch.from_arrays(arrays, names=_NAMES)


def _settle(cols: dict, up: np.ndarray) -> None:
    """Sum leaves and saved tokens of settled nodes into their parents, deepest
    first, and give them their parents' least conversation."""
    settled = ~(cols["first"] | cols["last"])
    by_depth = np.argsort(cols["depth"], kind="stable")[::-1]
    for at in np.split(by_depth, np.flatnonzero(np.diff(cols["depth"][by_depth])) + 1):
        at = at[settled[at]]
        cols["leaves"][at[cols["kids"][at] == 0]] = 1
        cols["saved"][at] += (cols["n"][at] - 1) * cols["w"][at]
        at = at[up[at] >= 0]
        np.add.at(cols["kids"], up[at], 1)
        np.add.at(cols["leaves"], up[at], cols["leaves"][at])
        np.add.at(cols["saved"], up[at], cols["saved"][at])
    has = settled & (up >= 0)
    has[has] = settled[up[has]]
    cols["known"] = has
    cols["up_conv"] = np.where(has, cols["conv"][up], 0)


def _shard(rows: pa.Table, number: int) -> pa.RecordBatch:
    """Nodes of one stretch of sorted sequences."""
    path = rows["path"].combine_chunks()
    n = np.diff(path.offsets.to_numpy().astype(np.int64))
    turns = path.flatten()
    col = lambda name: rows[name].to_numpy()
    offsets = np.append(0, np.cumsum(n + 1))  # every sequence begins with the node it hangs on
    top = np.zeros(int(offsets[-1]), bool)
    top[offsets[:-1]] = True

    def field(name: str, first: np.ndarray) -> np.ndarray:
        out = np.empty(len(top), np.int64)
        out[top], out[~top] = first, turns.field(name).to_numpy()
        return out
    a, b = field("a", col("p1")), field("b", col("p2"))
    order = np.lexsort((b, a))
    turn = np.empty(len(order), np.int64)
    turn[order] = np.cumsum(np.append(0, (np.diff(a[order]) != 0) | (np.diff(b[order]) != 0)))
    trie, codes = pack(turn, offsets)

    x, y, w = field("x", col("p1")), field("y", col("p2")), field("w", np.zeros(len(n), np.int64))
    slots = len(trie.check)
    cols = {c: np.zeros(slots, np.int64) for c in _NAMES}
    cols["conv"][:] = np.iinfo(np.int64).max
    cols["first"], cols["last"] = np.zeros(slots, bool), np.zeros(slots, bool)
    cols["shard"][:] = number
    state, id1, id2 = np.zeros(len(n), np.int64), np.zeros(len(n), np.int64), np.zeros(len(n), np.int64)
    for depth in range(int((n + 1).max(initial=0))):
        live = np.flatnonzero(n >= depth)
        at = offsets[:-1][live] + depth
        to = trie.step(state[live], codes[at])
        cols["up1"][to], cols["up2"][to] = id1[live], id2[live]
        id1[live] ^= x[at]
        id2[live] ^= y[at]
        cols["id1"][to], cols["id2"][to], cols["depth"][to], cols["w"][to] = id1[live], id2[live], depth, w[at]
        np.add.at(cols["n"], to, col("copies")[live])
        np.minimum.at(cols["conv"], to, col("conv")[live])
        for edge, k in (("first", 0), ("last", len(n) - 1)):
            if n[k] >= depth:
                cols[edge][to[np.searchsorted(live, k)]] = True
        state[live] = to
    for c in ("kids", "leaves", "saved"):
        np.add.at(cols[c], state, col(c))
    used = np.flatnonzero(trie.check >= 0)[1:]
    place = np.full(slots, -1, np.int64)
    place[used] = np.arange(len(used))
    cols = {c: v[used] for c, v in cols.items()}
    _settle(cols, place[trie.check[used]])
    return _arrow(cols, np.arange(len(used)))


def _shards(limit: int):
    def shards(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number, held, size = TaskContext.get().partitionId() << 24, [], 0
        for batch in batches:
            for k in range(0, batch.num_rows, 256):
                part = batch.slice(k, 256)
                held.append(part)
                size += len(part.column(2).flatten()) + part.num_rows
                if size >= limit:
                    yield _shard(pa.Table.from_batches(held), number)
                    number, held, size = number + 1, [], 0
        if held:
            yield _shard(pa.Table.from_batches(held), number)
    return shards


def _merge(rows: pa.Table) -> pa.Table:
    """Upper nodes of neighbouring shards, settled but for the outermost
    sequences of all."""
    cols = {c: rows[c].to_numpy() for c in _NAMES if c != "up_conv"}
    order = np.lexsort((cols["id2"], cols["id1"], cols["depth"]))
    cols = {c: v[order] for c, v in cols.items()}
    low, high = cols["shard"].min(), cols["shard"].max()
    cols["first"], cols["last"] = cols["first"] & (cols["shard"] == low), cols["last"] & (cols["shard"] == high)
    whole = rows["final"][0].as_py()
    same = np.append(False, np.all([np.diff(cols[c]) == 0 for c in ("depth", "id1", "id2")], axis=0))
    at = np.flatnonzero(~same)
    for c in ("n", "kids", "leaves", "saved"):
        cols[c] = np.add.reduceat(cols[c], at)
    for c in ("first", "last"):
        cols[c] = np.logical_or.reduceat(cols[c], at) & (not whole)
    cols["conv"] = np.minimum.reduceat(cols["conv"], at)
    cols = {c: v if len(v) == len(at) else v[at] for c, v in cols.items()}
    cols["shard"] = np.full(len(at), rows["group"][0].as_py(), np.int64)
    place = {key: k for k, key in enumerate(zip(cols["depth"].tolist(), cols["id1"].tolist(), cols["id2"].tolist(), strict=True))}
    up = np.array([place.get(key, -1) for key in zip((cols["depth"] - 1).tolist(), cols["up1"].tolist(), cols["up2"].tolist(), strict=True)], np.int64)
    _settle(cols, up)
    return pa.Table.from_batches([_arrow(cols, np.arange(len(at)))])


def trie_nodes(paths: DataFrame, limit: int = SHARD_TURNS) -> tuple[DataFrame, DataFrame]:
    """``(nodes, upper)``: the nodes of all sequences ``p1, p2, path, copies,
    conv, kids, leaves, saved``, and those of them that several shards may have
    had. ``up_conv`` of a node below one of the latter is null."""
    turns = paths.agg(F.coalesce(F.sum(F.col("n") + 1), F.lit(0))).first()[0]
    ordered = paths.repartitionByRange(max(spread(paths), -(-turns // limit)), "p1", "p2", "path").sortWithinPartitions("p1", "p2", "path")
    rows = stored(ordered.select("p1", "p2", "path", "copies", "conv", "kids", "leaves", "saved").mapInArrow(_shards(limit), _NODE), "trie-nodes")
    settled = [rows.where("NOT first AND NOT last")]
    edge = rows.where("first OR last")
    bits = 24 + FAN.bit_length() - 1  # the first round also merges what one task cut apart
    while True:
        high = edge.agg(F.max("shard")).first()[0]
        if high is None:
            break
        final = (high >> bits) == 0
        merged = stored(edge.select("*", F.shiftright("shard", bits).alias("group"), F.lit(final).alias("final"))
                        .groupBy("group").applyInArrow(_merge, _NODE), "trie-upper")
        settled.append(merged.where("NOT first AND NOT last"))
        if final:
            break
        edge, bits = merged.where("first OR last"), FAN.bit_length() - 1
    nodes, upper = settled[0], rows.limit(0)
    for part in settled[1:]:
        nodes, upper = nodes.unionByName(part), upper.unionByName(part)
    return nodes, upper


# --- conversations that end at a node ----------------------------------------------

def _runs(batch: pa.RecordBatch) -> tuple[np.ndarray, list[tuple]]:
    one, two = batch.column(0).to_numpy(), batch.column(1).to_numpy()
    cuts = np.flatnonzero(np.append(True, (one[1:] != one[:-1]) | (two[1:] != two[:-1])))
    return np.append(cuts, len(one)).tolist(), list(zip(one[cuts].tolist(), two[cuts].tolist(), strict=True))


def _join_ids(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorted ids to rows of joined ids, ``CHUNK_IDS`` at most in each."""
    for batch in batches:
        if not batch.num_rows:
            continue
        cuts, names = _runs(batch)
        ids, out = batch.column(2).to_pylist(), []
        for (one, two), a, b in zip(names, cuts[:-1], cuts[1:], strict=True):
            for k in range(a, b, CHUNK_IDS):
                out.append((one, two, ids[k], ",".join(map(str, ids[k:min(k + CHUNK_IDS, b)]))))
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out, strict=True), (pa.int64(), pa.int64(), pa.int64(), pa.string()), strict=True)],
                                         names=["e1", "e2", "least", "ids"])


def _hash_ids(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Joined ids in order to one SHA-256 per node; only the hash is held."""
    name, sha = None, None

    def flush(done: list) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([d[0][0] for d in done], pa.int64()), pa.array([d[0][1] for d in done], pa.int64()),
                                           pa.array([d[1] for d in done], pa.string())], names=["e1", "e2", "ends_sha256"])
    for batch in batches:
        done = []
        for one, two, ids in zip(*(batch.column(k).to_pylist() for k in (0, 1, 3)), strict=True):
            if (one, two) != name:
                if sha is not None:
                    done.append((name, sha.hexdigest()))
                name, sha = (one, two), hashlib.sha256(ids.encode())
            else:
                sha.update(b"," + ids.encode())
        if done:
            yield flush(done)
    if sha is not None:
        yield flush([(name, sha.hexdigest())])


def end_hashes(ends: DataFrame) -> DataFrame:
    """``e1, e2, ends_sha256`` of ``e1, e2, conv_id``. The ids of a node with
    very many are sorted and joined in many tasks; the hash runs over the
    joined pieces."""
    n, node = spread(ends), ["e1", "e2"]
    joined = (ends.repartitionByRange(n, *node, "conv_id").sortWithinPartitions(*node, "conv_id")
              .mapInArrow(_join_ids, "e1 long, e2 long, least long, ids string"))
    return (joined.repartition(n, *node).sortWithinPartitions(*node, "least")
            .mapInArrow(_hash_ids, "e1 long, e2 long, ends_sha256 string"))


def conversation_trie(conversations: DataFrame, size: int = SEGMENT, limit: int = SHARD_TURNS, family: int = FAMILY) -> DataFrame:
    """One row per node of the trie of rebuilt conversations: ``conv_id`` (least
    member), ``depth``, ``parent_conv_id``, ``n_convs``, ``n_children``,
    ``n_leaves``, ``saved_tokens``, ``ends_sha256``.

    Null roles and texts are empty ones, empty texts are texts; equal turn
    numbers (null ones too) are ordered by digest, repeated rows are turns of
    their own; rows without conv_id belong to no conversation; other columns
    are ignored, whatever their names; an empty table gives no row, not even a
    root. The family of a negative id is the multiple below it.
    """
    segs = segments(rebuilt_turns(numbered_turns(conversations.select("conv_id", "turn", "role", "text")), family), size)
    deepest = segs.agg(F.max("seg")).first()[0]
    ends = end_hashes(segs.where("last").select("e1", "e2", "conv_id"))
    levels, upper, below = [], [], None
    zero = F.lit(0).cast("long")
    for level in range(deepest if deepest is not None else 0, -1, -1):
        paths = segs.where(F.col("seg") == level).groupBy("p1", "p2", "e1", "e2", "n").agg(
            F.count("*").alias("copies"), F.min("conv_id").alias("conv"), F.any_value("path").alias("path"))
        if below is not None:
            paths = paths.join(below, ["e1", "e2", "n"], "left")
        sums = [F.coalesce(c, zero).alias(c) if below is not None else zero.alias(c) for c in ("kids", "leaves", "saved")]
        paths = stored(paths.select("p1", "p2", "path", "n", "copies", "conv", *sums), "trie-paths")
        nodes, shared = trie_nodes(paths, limit)
        here = nodes.where("depth > 0") if level else nodes
        # The nodes that lower segments hang on are settled one level up.
        hung = here.withColumn("up_conv", F.when(F.col("depth") > 1, F.col("up_conv"))) if level else here
        levels.append(hung.withColumn("depth", F.col("depth") + level * size))
        upper += [shared.where("depth > 0") if level else shared, nodes.where(F.col("depth") == size)]
        below = nodes.where("depth = 0").select(F.col("id1").alias("e1"), F.col("id2").alias("e2"), F.lit(size).cast("long").alias("n"), "kids", "leaves", "saved")
    nodes, known = levels[0], upper[0]
    for part in levels[1:]:
        nodes = nodes.unionByName(part)
    for part in upper[1:]:
        known = known.unionByName(part)
    known = known.select(F.col("id1").alias("up1"), F.col("id2").alias("up2"), F.col("conv").alias("upper_conv")).dropDuplicates(["up1", "up2"])
    open_ = nodes.where("up_conv IS NULL AND depth > 0").join(known, ["up1", "up2"], "left").withColumn("up_conv", F.col("upper_conv"))
    nodes = nodes.where("up_conv IS NOT NULL OR depth = 0").unionByName(open_.drop("upper_conv"))
    nodes = nodes.join(ends, (F.col("id1") == F.col("e1")) & (F.col("id2") == F.col("e2")), "left")
    return nodes.select(F.col("conv").alias("conv_id"), "depth", F.when(F.col("depth") > 0, F.col("up_conv")).alias("parent_conv_id"),
                        F.col("n").alias("n_convs"), F.col("kids").alias("n_children"), F.col("leaves").alias("n_leaves"),
                        F.col("saved").alias("saved_tokens"), F.coalesce("ends_sha256", F.lit(NO_ENDS)).alias("ends_sha256"))


def op11_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Contract query: the trie of all conversations."""
    prepare(spark)
    return conversation_trie(table(spark, sf_dir, "conversations"))


SQL = rf"""
WITH turns AS (
  SELECT conv_id, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, mark) - 1 AS pos, role, text FROM (
    SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text,
           sha256(length(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, '')) AS mark
    FROM conversations WHERE conv_id IS NOT NULL)),
convs AS (SELECT conv_id, conv_id - (conv_id % 20 + 20) % 20 AS head, {CRC32_SQL.format("conv_id")} % 4 AS h
          FROM (SELECT DISTINCT conv_id FROM turns)),
rebuilt AS (
  SELECT c.conv_id, 0 AS own, t.pos, t.role, t.text FROM convs c JOIN turns t ON t.conv_id = c.head AND t.pos < c.h
  UNION ALL
  SELECT c.conv_id, 1, t.pos, t.role, t.text FROM convs c JOIN turns t ON t.conv_id = c.conv_id AND t.pos >= c.h),
paths AS (
  SELECT c.conv_id, coalesce(r.path, []) AS path
  FROM convs c LEFT JOIN (SELECT conv_id, list({{'role': role, 'text': text}} ORDER BY own, pos) AS path FROM rebuilt GROUP BY conv_id) r USING (conv_id)),
members AS (SELECT conv_id, path, unnest(range(len(path) + 1)) AS depth FROM paths),
nodes AS (
  SELECT path[1:depth] AS node, depth, min(conv_id) AS conv_id, count(*) AS n_convs,
         sha256(coalesce(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (len(path) = depth), '')) AS ends_sha256
  FROM members GROUP BY ALL),
kids AS (SELECT node[1:depth - 1] AS node, depth - 1 AS depth, count(*) AS n FROM nodes WHERE depth > 0 GROUP BY ALL),
sized AS (
  SELECT n.*, coalesce(k.n, 0) AS n_children,
         CASE WHEN n.depth = 0 THEN 0 ELSE (n.n_convs - 1) * len(regexp_extract_all(n.node[n.depth].text, '{WORD}')) END AS saved
  FROM nodes n LEFT JOIN kids k ON n.node = k.node AND n.depth = k.depth),
above AS (SELECT node[1:d] AS node, d AS depth, n_children, saved FROM (SELECT *, unnest(range(depth + 1)) AS d FROM sized)),
totals AS (SELECT node, depth, count(*) FILTER (n_children = 0) AS n_leaves, sum(saved) AS saved_tokens FROM above GROUP BY ALL)
SELECT s.conv_id, s.depth, p.conv_id AS parent_conv_id, s.n_convs, s.n_children, t.n_leaves,
       t.saved_tokens::BIGINT AS saved_tokens, s.ends_sha256
FROM sized s JOIN totals t ON s.node = t.node AND s.depth = t.depth
LEFT JOIN nodes p ON s.depth > 0 AND p.depth = s.depth - 1 AND p.node = s.node[1:s.depth - 1]
"""
