"""Counts over the prefix trie of conversations, by node tables with minimal perfect hashes.

Turns are sorted over the whole table; each task chains the digests of its conversations' prefixes, and a conversation cut by a
task's edge is completed from the edges alone. Pieces of conversations meet in shards. A shard
lists its distinct prefix digests, gives each a slot by a minimal perfect hash that is verified against the stored digest, and
scatters counts into flat arrays; sums run to the root through an array of parent slots, the deepest first.
Partial results of the shards add up by digest.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from itertools import groupby

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import from_arrow_schema

from threadloom.session import stored

#: Conversations of a hundred share the first turns of the conversation that begins the hundred, up to five.
GROUP, MOST_SHARED = 100, 5
#: Turns of one conversation in a shard, rows of a shard, conversation ids hashed at once. None changes a result.
SEGMENT, SHARD_ROWS, CHUNK_IDS = 4096, 50_000, 1000
#: Prefixes are named by a polynomial over the turns' digests: modulus and base.
PRIME = (1 << 127) - 1
BASE = int.from_bytes(hashlib.sha256(b"prefix").digest()[:15], "big") | 1
HEAD, TURN, END = 0, 1, 2


def name(value: int) -> bytes:
    return value.to_bytes(16, "big")


class PerfectHash:
    """A minimal perfect hash of distinct 16-byte digests: levels of bits, a digest alone in its cell stays.

    ``slots`` gives each digest its place, -1 where the digest stored in that place is another one.
    """

    def __init__(self, digests: np.ndarray, room: float = 1.5):
        self.levels: list[tuple[np.ndarray, np.ndarray]] = []
        rest, base = digests, 0
        while len(rest):
            size = int(len(rest) * room) + 1
            cell = self._cell(rest, len(self.levels), size)
            taken = np.bincount(cell, minlength=size) == 1
            self.levels.append((taken, base + np.cumsum(taken) - taken))
            base += int(taken.sum())
            rest = rest[~taken[cell]]
        self.stored = np.zeros((base, 2), np.uint64)
        self.stored[self._place(digests)] = digests

    @staticmethod
    def _cell(digests: np.ndarray, level: int, size: int) -> np.ndarray:
        x = digests[:, 0] ^ (digests[:, 1] + np.uint64((level + 1) * 0x9E3779B97F4A7C15 & (1 << 64) - 1))
        x = (x ^ x >> np.uint64(30)) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ x >> np.uint64(27)) * np.uint64(0x94D049BB133111EB)
        return ((x ^ x >> np.uint64(31)) % np.uint64(size)).astype(np.int64)

    def _place(self, digests: np.ndarray) -> np.ndarray:
        made = np.full(len(digests), -1, np.int64)
        open_ = np.arange(len(digests))
        for level, (taken, place) in enumerate(self.levels):
            cell = self._cell(digests[open_], level, len(taken))
            here = taken[cell]
            made[open_[here]] = place[cell[here]]
            open_ = open_[~here]
        return made

    def slots(self, digests: np.ndarray) -> np.ndarray:
        made = self._place(digests)
        found = np.flatnonzero(made >= 0)
        wrong = (self.stored[made[found]] != digests[found]).any(1)
        made[found[wrong]] = -1
        return made


def digests(column: pa.ChunkedArray) -> np.ndarray:
    """16-byte values as two numbers each; null as zeros, which no prefix is."""
    flat = b"".join(v or bytes(16) for v in column.to_pylist())
    return np.frombuffer(flat, ">u8").astype(np.uint64).reshape(-1, 2)


def turn_rows(conversations: DataFrame, conv: str, turn: str, role: str, text: str) -> DataFrame:
    """Narrow rows of all turns: conversation, turn, digest of role and text, code points, a number of their own."""
    r, t = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in (role, text))
    return conversations.filter(F.col(conv).isNotNull()).select(
        F.col(conv).cast("long").alias("conv"),
        F.col(turn).cast("long").alias("turn"),
        F.substring(F.unhex(F.sha2(F.concat(F.length(r).cast("string"), F.lit(":"), r, t), 256)), 1, 15).alias("digest"),
        F.length(t).cast("long").alias("chars"),
        F.monotonically_increasing_id().alias("row"),
    )


#: A prefix of a conversation: its digest, that of the prefix before, the code points of its last text. With ``last``
#: the digest of the whole conversation. In a piece, a conversation that began in an earlier task, the digests
#: (``value``, ``before``) count from the piece's beginning and ``at`` is the place in the piece.
ROW = pa.schema(
    [("conv", pa.int64()), ("depth", pa.int64()), ("key", pa.binary()), ("parent", pa.binary()), ("chars", pa.int64()),
     ("last", pa.bool_()), ("task", pa.int32()), ("at", pa.int64()), ("value", pa.binary()), ("before", pa.binary())]
)
#: What a task knows of a conversation at its edge: of a piece the size, the digests after its first turns and at
#: its end; of a beginning the depth and digest so far and how many of the next turns are left out.
EDGE = pa.struct(
    [("conv", pa.int64()), ("task", pa.int32()), ("size", pa.int64()), ("firsts", pa.list_(pa.binary())),
     ("whole", pa.binary()), ("depth", pa.int64()), ("key", pa.binary()), ("more", pa.int64())]
)


class _Chain:
    """Prefix digests of one conversation as its turns come; without a head row it is a piece."""

    def __init__(self, conv: int, task: int, kind: int, shared: int | None, head: list):
        self.conv, self.task, self.piece = conv, task, kind != HEAD
        self.skip = shared or 0
        self.at = self.depth = self.value = 0
        self.firsts: list[bytes] = []
        self.rows: list[tuple] = []
        if not self.piece:
            self.rows.append((conv, 0, name(0), None, 0, False, None, None, None, None))
            for digest, chars in head:
                self.push(digest, chars)

    def push(self, digest: bytes, chars: int) -> None:
        before, self.value = self.value, following(self.value, digest)
        self.depth += 1
        self.rows.append((self.conv, self.depth, name(self.value), name(before), chars, False, None, None, None, None))

    def turn(self, digest: bytes, chars: int) -> None:
        self.at += 1
        if self.piece:
            before, self.value = self.value, following(self.value, digest)
            if len(self.firsts) < MOST_SHARED:
                self.firsts.append(name(self.value))
            place = (self.task, self.at, name(self.value), name(before))
            self.rows.append((self.conv, None, None, None, chars, False, *place))
        elif self.at > self.skip:
            self.push(digest, chars)

    def end(self) -> None:
        if self.piece:
            self.rows.append((self.conv, None, None, None, None, True, self.task, self.at, name(self.value), None))
        else:
            self.rows.append((self.conv, self.depth, name(self.value), None, None, True, None, None, None, None))

    def edge(self) -> dict:
        if self.piece:
            known = (self.at, self.firsts, name(self.value), None, None, None)
        else:
            known = (None, None, None, self.depth, name(self.value), max(0, self.skip - self.at))
        return dict(zip((f.name for f in EDGE), (self.conv, self.task, *known)))


def following(value: int, digest: bytes) -> int:
    return (value * BASE + int.from_bytes(digest, "big") + 1) % PRIME


def chains(turns: DataFrame, tasks: int) -> DataFrame:
    """The prefixes of all rebuilt conversations, with a ``last`` row for each conversation."""
    convs = turns.groupBy("conv").agg(F.lit(1).alias("one")).select("conv")
    base = F.col("conv") - F.col("conv") % GROUP
    shared = F.crc32(F.col("conv").cast("string").cast("binary")) % (MOST_SHARED + 1)
    first = Window.partitionBy("conv").orderBy("turn", "digest", "row")
    # Only the first few turns of the conversations that begin a hundred: Spark drops the others before the shuffle.
    heads = (
        turns.filter(base == F.col("conv"))
        .withColumn("at", F.row_number().over(first))
        .filter(F.col("at") <= MOST_SHARED)
        .groupBy(F.col("conv").alias("base"))
        .agg(F.array_sort(F.collect_list(F.struct("at", "digest", "chars"))).alias("head"))
    )
    begin = convs.withColumns({"base": base, "shared": shared.cast("int")}).join(heads, "base", "left")
    none = lambda kind: F.lit(None).cast(kind)
    order = ["conv", "kind", "turn", "digest", "row"]
    head = F.slice(F.coalesce("head", F.array()), 1, F.col("shared"))
    begin = begin.select(
        "conv", F.lit(HEAD).alias("kind"), none("long").alias("turn"), none("binary").alias("digest"),
        none("long").alias("chars"), none("long").alias("row"), "shared",
        F.transform(head, lambda x: x["digest"]).alias("digests"), F.transform(head, lambda x: x["chars"]).alias("lengths"),
    )
    empty = [none("int").alias("shared"), none("array<binary>").alias("digests"), none("array<long>").alias("lengths")]
    own = turns.select("conv", F.lit(TURN).alias("kind"), "turn", "digest", "chars", "row", *empty)
    ends = begin.select("conv", F.lit(END).alias("kind"), "turn", "digest", "chars", "row", *empty)
    rows = begin.unionByName(own).unionByName(ends)
    rows = rows.repartitionByRange(tasks, *order).sortWithinPartitions(*order)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task = TaskContext.get().partitionId()
        chain = None
        for batch in batches:
            made: list[tuple] = []
            edges: list[dict] = []
            columns = [batch[c].to_pylist() for c in ("conv", "kind", "digest", "chars", "shared", "digests", "lengths")]
            for conv, kind, digest, chars, left_out, first_digests, lengths in zip(*columns):
                if chain is None or chain.conv != conv:
                    if chain is not None:
                        made += chain.rows
                        if chain.piece:
                            edges.append(chain.edge())
                    chain = _Chain(conv, task, kind, left_out, zip(first_digests or (), lengths or ()))
                if kind == TURN:
                    chain.turn(digest, chars)
                elif kind == END:
                    chain.end()
            if chain is not None:
                made += chain.rows
                chain.rows = []
            yield _batch(made, edges)
        if chain is not None:
            yield _batch([], [chain.edge()])

    schema = from_arrow_schema(pa.schema([*ROW, ("edge", EDGE)]))
    found = stored(rows.mapInArrow(run, schema), "chains")
    edges = found.filter("edge IS NOT NULL").select("edge.*")
    rows = found.filter("edge IS NULL").drop("edge")
    carried = edges.groupBy("conv").applyInArrow(_carry, CARRY)
    pieces = rows.filter("task IS NOT NULL").join(carried, ["conv", "task"])
    done = pieces.select("conv", "chars", "last", "at", "value", "before", "out", "above", "shift").mapInArrow(_place, PREFIX)
    names = [c.split()[0] for c in PREFIX.split(", ")]
    return rows.filter("task IS NULL").select(*names).unionByName(done)


def _batch(rows: list[tuple], edges: list[dict]) -> pa.RecordBatch:
    columns = list(zip(*rows)) if rows else [()] * len(ROW)
    arrays = [pa.array([*c, *[None] * len(edges)], f.type) for c, f in zip(columns, ROW)]
    arrays.append(pa.array([*[None] * len(rows), *edges], EDGE))
    return pa.RecordBatch.from_arrays(arrays, [*ROW.names, "edge"])


PREFIX = "conv long, depth long, key binary, parent binary, chars long, last boolean"
#: Of a piece: how many of its turns are left out, the depth above the others, and the digest above them less that of
#: the turns left out.
CARRY = "conv long, task int, out long, above long, shift binary"


def _carry(edges: pa.Table) -> pa.Table:
    """What each piece of one conversation begins with; there is one row a task."""
    made: list[tuple] = []
    depth = value = more = 0
    for e in sorted(edges.to_pylist(), key=lambda e: e["task"]):
        if e["size"] is None:
            depth, value, more = e["depth"], int.from_bytes(e["key"], "big"), e["more"]
            continue
        out = min(more, e["size"])
        shift = (value - (int.from_bytes(e["firsts"][out - 1], "big") if out else 0)) % PRIME
        made.append((e["conv"], e["task"], out, depth, name(shift)))
        if e["size"] > out:
            value = (shift * pow(BASE, e["size"] - out, PRIME) + int.from_bytes(e["whole"], "big")) % PRIME
        depth, more = depth + e["size"] - out, more - out
    columns = list(zip(*made)) if made else [()] * 5
    kinds = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.binary()]
    return pa.table([pa.array(c, k) for c, k in zip(columns, kinds)], ["conv", "task", "out", "above", "shift"])


def _place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows of pieces as prefixes of their conversations."""

    def digest(shift: int, length: int, value: bytes) -> bytes:
        return name((shift * pow(BASE, length, PRIME) + int.from_bytes(value, "big")) % PRIME)

    for batch in batches:
        made = []
        for r in batch.to_pylist():
            length, shift = r["at"] - r["out"], int.from_bytes(r["shift"], "big")
            if length > 0 or r["last"]:
                parent = None if r["last"] else digest(shift, length - 1, r["before"])
                key = digest(shift, length, r["value"])
                made.append((r["conv"], r["above"] + length, key, parent, r["chars"], r["last"]))
        columns = list(zip(*made)) if made else [()] * 6
        fields = [ROW.field(c.split()[0]) for c in PREFIX.split(", ")]
        yield pa.RecordBatch.from_arrays(
            [pa.array(c, f.type) for c, f in zip(columns, fields)], [f.name for f in fields]
        )


def _shard(conv: str | Column, depth: str | Column, segment: int, shards: int) -> Column:
    depth = F.col(depth) if isinstance(depth, str) else depth
    return F.pmod(F.xxhash64(conv, F.floor(depth / segment)), F.lit(shards)).cast("int")


LOCAL = "shard int, key binary, parent binary, depth long, chars long, n long, conv long"


def _list_nodes(rows: pa.Table) -> pa.Table:
    """The distinct prefixes of a shard with their members' number and smallest, by slots of a perfect hash.

    Rows without a conversation stand for the prefix above a piece of a conversation; they are no members.
    """
    keys = digests(rows["key"])
    distinct, first = np.unique(keys, axis=0, return_index=True)
    slot = PerfectHash(distinct).slots(keys)
    conv = rows["conv"].fill_null(MOST_ID).to_numpy()
    n, least = np.zeros(len(distinct), np.int64), np.full(len(distinct), MOST_ID)
    np.add.at(n, slot, rows["conv"].is_valid().to_numpy().astype(np.int64))
    np.minimum.at(least, slot, conv)
    place = slot[first]
    made = rows.take(first)
    return pa.table(
        {
            **{c: made[c] for c in ("shard", "key", "parent", "depth", "chars")},
            "n": pa.array(n[place]),
            "conv": pa.array(least[place], mask=n[place] == 0),
        }
    )


MOST_ID = (1 << 63) - 1
PARTS = "key binary, leaves long, saved long, conv long, depth long, parent_conv long, n long, children long"


def _accumulate(rows: pa.Table, segment: int) -> pa.Table:
    """A shard's share of each prefix's sums over its subtree, and the facts of the prefixes that are at home here.

    Sums stop at the first depth of a segment; what goes further up comes to the segments above as inflow.
    """
    node = rows["depth"].is_valid().to_numpy()
    inflow, rows = rows.filter(pa.array(~node)), rows.filter(pa.array(node))
    keys = digests(rows["key"])
    table = PerfectHash(keys)
    slot = table.slots(keys)
    size = len(keys)

    def by_slot(values: np.ndarray) -> np.ndarray:
        made = np.zeros(size, values.dtype)
        made[slot] = values
        return made

    of = lambda c: by_slot(rows[c].to_numpy())
    parent = table.slots(digests(rows["parent"]))
    parent[rows["parent"].is_null().to_numpy()] = -1
    parent, depth, home = by_slot(parent), of("depth"), of("home")
    leaves = (home & (of("children") == 0)).astype(np.int64)
    saved = np.where(home, (of("n") - 1) * of("chars"), 0)
    for name_, total in (("leaves", leaves), ("saved", saved)):
        np.add.at(total, table.slots(digests(inflow["key"])), inflow[name_].to_numpy())
    order = np.argsort(-depth, kind="stable")
    cuts = np.flatnonzero(np.diff(depth[order])) + 1
    for level in np.split(order, cuts):
        level = level[(parent[level] >= 0) & (depth[level] % segment > 0)]
        np.add.at(leaves, parent[level], leaves[level])
        np.add.at(saved, parent[level], saved[level])
    member = of("member")
    conv = of("conv")
    above = np.where(parent >= 0, conv[parent], 0)
    back = slot[member[slot]]
    keep = rows.filter(pa.array(member[slot]))
    away = ~home[back]
    return pa.table(
        {
            "key": keep["key"],
            "leaves": pa.array(leaves[back]),
            "saved": pa.array(saved[back]),
            "conv": pa.array(conv[back], mask=away),
            "depth": pa.array(depth[back], mask=away),
            "parent_conv": pa.array(above[back], mask=away | (parent[back] < 0)),
            "n": pa.array(of("n")[back], mask=away),
            "children": pa.array(of("children")[back], mask=away),
        }
    )


def _joined_ids(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Runs of ids of one prefix, comma-joined, with the first id of each run."""
    for batch in batches:
        made = []
        for key, rows in groupby(zip(batch["key"].to_pylist(), batch["conv"].to_pylist()), lambda r: r[0]):
            ids = [conv for _, conv in rows]
            made += [(key, ids[a], ",".join(map(str, ids[a : a + CHUNK_IDS]))) for a in range(0, len(ids), CHUNK_IDS)]
        columns = list(zip(*made)) if made else [()] * 3
        kinds = [pa.binary(), pa.int64(), pa.string()]
        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], ["key", "first", "ids"])


def _hashed_ids(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    key, running = None, None

    def out(rows: list[tuple]) -> pa.RecordBatch:
        columns = list(zip(*rows)) if rows else [(), ()]
        return pa.RecordBatch.from_arrays(
            [pa.array(columns[0], pa.binary()), pa.array(columns[1], pa.string())], ["key", "ends"]
        )

    for batch in batches:
        made = []
        for next_key, ids in zip(batch["key"].to_pylist(), batch["ids"].to_pylist()):
            if next_key != key:
                if running is not None:
                    made.append((key, running.hexdigest()))
                key, running = next_key, hashlib.sha256(ids.encode())
            else:
                running.update(b"," + ids.encode())
        yield out(made)
    if running is not None:
        yield out([(key, running.hexdigest())])


def trie(
    conversations: DataFrame,
    conv: str = "conv_id",
    turn: str = "turn",
    role: str = "role",
    text: str = "text",
    segment: int = SEGMENT,
    shard_rows: int = SHARD_ROWS,
) -> DataFrame:
    """One row for each node of the prefix trie of the rebuilt conversations.

    Conversation c takes the first h turns of conversation c - c % 100 and goes on with its own turns after
    its first h, where h is the unsigned CRC-32 of its decimal id modulo 6. Nodes are the distinct sequences of the first
    turns (role, text), the root has none. Columns: ``conv_id`` (smallest member), ``depth``, ``parent_conv_id``, ``n_convs``,
    ``n_children``, ``n_leaves`` and ``saved_tokens`` of the subtree, ``ends_sha256`` of the ids that end there.

    Turns go by ``turn``, null first; equal ones by the SHA-256 of role and text, and repeated rows are turns each.
    Null roles and texts are empty. Rows without a conversation id belong to none. The remainder has the sign of c. Other
    columns are not read; an empty table gives no node, not even a root. The ids that end at one node are
    hashed by one task, as SHA-256 goes in order, in runs of ``CHUNK_IDS`` made and sorted by all.
    """
    turns = stored(turn_rows(conversations, conv, turn, role, text), "turns")
    tasks = max(1, -(-turns.count() // shard_rows))
    prefixes = chains(turns, tasks)
    members = prefixes.filter("NOT last")
    here = _shard("conv", "depth", segment, tasks)
    edge = members.filter((F.col("depth") % segment == 0) & (F.col("depth") > 0))
    above = edge.select(
        here.alias("shard"), F.col("parent").alias("key"), F.lit(None).cast("binary").alias("parent"),
        (F.col("depth") - 1).alias("depth"), F.lit(0).cast("long").alias("chars"), F.lit(None).cast("long").alias("conv"),
    )
    rows = members.select(here.alias("shard"), "key", "parent", "depth", "chars", "conv").unionByName(above)
    local = stored(rows.groupBy("shard").applyInArrow(_list_nodes, LOCAL), "local")
    nodes = stored(
        local.filter("n > 0").groupBy("key").agg(
            F.min("conv").alias("conv"), F.sum("n").alias("n"), F.max("chars").alias("chars"),
            F.max("depth").alias("depth"), F.max("parent").alias("parent"),
        ),
        "nodes",
    )
    children = nodes.filter("parent IS NOT NULL").groupBy(F.col("parent").alias("key")).agg(F.count("*").alias("children"))
    full = nodes.join(children, "key", "left").withColumn("children", F.coalesce("children", F.lit(0).cast("long")))
    # A conversation longer than a segment: what its later segments hold flows into the end of each earlier one.
    number = F.floor(F.col("depth") / segment).alias("number")
    held = full.filter(F.col("depth") >= segment).groupBy("conv", number).agg(
        F.sum((F.col("children") == 0).cast("long")).alias("leaves"), F.sum((F.col("n") - 1) * F.col("chars")).alias("saved")
    )
    later = Window.partitionBy("conv").orderBy(F.desc("number"))
    inflow = edge.select("conv", "depth", "parent", number).join(held, ["conv", "number"], "left").select(
        _shard("conv", F.col("depth") - 1, segment, tasks).alias("shard"), F.col("parent").alias("key"),
        *(F.sum(F.coalesce(c, F.lit(0).cast("long"))).over(later).alias(c) for c in ("leaves", "saved")),
    )
    placed = local.select("shard", "key", "parent", (F.col("n") > 0).alias("member")).join(full.drop("parent"), "key")
    home = F.col("member") & (_shard("conv", "depth", segment, tasks) == F.col("shard"))
    parts = (
        placed.withColumn("home", home)
        .unionByName(inflow, allowMissingColumns=True)
        .groupBy("shard")
        .applyInArrow(lambda rows: _accumulate(rows, segment), PARTS)
    )
    one = lambda c, to: F.max(c).alias(to)
    sums = parts.groupBy("key").agg(
        one("conv", "conv_id"), one("depth", "depth"), one("parent_conv", "parent_conv_id"), one("n", "n_convs"),
        one("children", "n_children"), F.sum("leaves").alias("n_leaves"), F.sum("saved").alias("saved_tokens"),
    )
    ids = prefixes.filter("last").select("key", "conv").repartitionByRange(tasks, "key", "conv").sortWithinPartitions("key", "conv")
    runs = ids.mapInArrow(_joined_ids, "key binary, first long, ids string")
    ends = runs.repartition("key").sortWithinPartitions("key", "first").mapInArrow(_hashed_ids, "key binary, ends string")
    return sums.join(ends, "key", "left").select(
        *(c for c in sums.columns if c != "key"), F.coalesce("ends", F.sha2(F.lit("").cast("binary"), 256)).alias("ends_sha256")
    )
