"""Trie of the conversations' common beginnings, from their sorted order.

Conversations are sequences of (role, text).  They are sorted by their turns' digests
(a shorter one stands before those that it begins), and each gets the length of what it
has in common with the one before it.  These lengths (``lcp``) are the leaves of a
Cartesian tree: a length and its nearest smaller values on both sides are a branching
node and the interval of its members.  Nearest smaller values are found inside blocks of
positions; what a block leaves open is looked up in the blocks' minima and answered by
the block that has it, once for each length.  Equal lengths of one interval merge, depths
between a node and its parent are added, and all figures are sums or minima over
intervals: leaves and shared words from running sums of blocks, least ids from the ends
of two blocks and the minima of those between.

Order: sorting goes by runs of ``RUN`` turns; only conversations equal so far go on to
their next run.  Places inside a conversation come from one sorted numbering of all
turns, so no task holds a conversation, whatever its length, and a block's size is
bounded by the number of conversations over ``MOST_BLOCKS``.

Rows without a ``conv_id`` belong to no conversation and take no part.  Null roles and
texts are empty; turns are ordered null first, equal ones by role, then by digest;
repeated rows are turns of their own.  A conversation whose rebuilt form has no turn is a
member of the root alone.  An empty table has no node.  Extra columns are not read.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import LongType

from tracequarry.lineage import discard, materialize
from tracequarry.llm.components import with_values

#: Turns of a run, and characters of a turn's digest.
RUN, WIDTH = 1024, 32
#: Positions of a block, unless there are more than so many blocks.
BLOCK, MOST_BLOCKS = 8192, 4096
#: Ids in one row of those that end at a node.
PIECE = 256
#: Every conversation begins with up to three turns of the first one of its score.
SCORE, MOST_BORROWED = 20, 4
WORD = r"[^\x20\x09-\x0D]+"
NODE = "conv_id long, depth long, parent_conv_id long, n_convs long, n_children long, n_leaves long, saved_tokens long, ends_sha256 string"


def numbered(rows: DataFrame, *order: Column | str, name: str = "pos") -> DataFrame:
    """``rows`` plus their place in this order, from 0; written to the shared folder."""
    spark = rows.sparkSession
    dealt = rows.repartitionByRange(*order).sortWithinPartitions(*order)
    local = F.monotonically_increasing_id().bitwiseAND((1 << 33) - 1)
    told = materialize(dealt.withColumns({"__part": F.spark_partition_id(), "__at": local}), "numbered")
    first, sizes = 0, []
    for part, n in sorted(map(tuple, told.groupBy("__part").count().collect())):  # a row for each partition
        sizes.append((part, first))
        first += n
    offsets = spark.createDataFrame(sizes, "__part int, __first long")
    out = told.join(F.broadcast(offsets), "__part").withColumn(name, F.col("__first") + F.col("__at")).drop("__part", "__at", "__first")
    out._tracequarry_path = told._tracequarry_path
    return out


def rebuilt(conversations: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Turns (conv_id, depth from 1, digest, words) and conversations (conv_id, len) after each has got its beginning.

    A conversation c takes the first h turns of the conversation c - c % 20 in place of its own first h; h is the
    checksum of c modulo 4."""
    blank = F.lit("")
    role, text = F.coalesce("role", blank), F.coalesce("text", blank)
    digest = F.substring(F.sha2(F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text), 256), 1, WIDTH)
    each = conversations.select(
        F.col("conv_id").cast("long").alias("conv_id"), F.col("turn"), role.alias("role"), digest.alias("digest"), F.regexp_count(text, F.lit(WORD)).cast("long").alias("words")
    )
    told = numbered(each.where("conv_id is not null"), F.col("conv_id"), F.asc_nulls_first("turn"), F.col("role"), F.col("digest"), name="row")
    h = F.crc32(F.col("conv_id").cast("string").cast("binary")) % MOST_BORROWED
    own = told.groupBy("conv_id").agg(F.min("row").alias("first"), F.count("*").alias("__n"))
    own = materialize(own.withColumns({"h": h, "base": F.col("conv_id") - F.col("conv_id") % SCORE}), "conversations")
    lent = own.select(F.col("conv_id").alias("base"), F.col("__n").alias("has"))
    convs = own.join(lent, "base", "left").withColumn("borrowed", F.least("h", F.coalesce("has", F.lit(0))).cast("long"))
    convs = materialize(convs.select("conv_id", "base", "first", "h", "borrowed", "__n"), "conversations")
    rows = with_values(told, convs.select("conv_id", "first", "h", "borrowed", "__n"), "conv_id", told.count())
    rows = materialize(rows.withColumn("place", F.col("row") - F.col("first")), "turns")
    kept = rows.where("place >= h").select("conv_id", (F.col("borrowed") + F.col("place") - F.col("h") + 1).alias("depth"), "digest", "words")
    heads = rows.where((F.col("conv_id") % SCORE == 0) & (F.col("place") < MOST_BORROWED)).select(F.col("conv_id").alias("base"), "place", "digest", "words")
    taken = convs.select("conv_id", "base", "h").join(heads, "base").where("place < h").select("conv_id", (F.col("place") + 1).alias("depth"), "digest", "words")
    turns = materialize(kept.unionByName(taken), "rebuilt")
    lens = materialize(convs.select("conv_id", (F.col("borrowed") + F.greatest(F.col("__n") - F.col("h"), F.lit(0))).alias("len")), "lengths")
    for done in (told, own, convs, rows):
        discard(done)
    return turns, lens


def words_before(turns: DataFrame) -> DataFrame:
    """conv_id, depth and upto, the words of its turns up to this one."""
    cell = ["conv_id", "run"]
    told = turns.select("conv_id", "depth", "words", F.floor((F.col("depth") - 1) / RUN).alias("run"))
    earlier = Window.partitionBy("conv_id").orderBy("run").rowsBetween(Window.unboundedPreceding, -1)
    runs = told.groupBy(*cell).agg(F.sum("words").alias("n")).select(*cell, F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("base"))
    inside = F.sum("words").over(Window.partitionBy(*cell).orderBy("depth").rowsBetween(Window.unboundedPreceding, 0))
    return told.withColumn("n", inside).join(runs, cell).select("conv_id", "depth", (F.col("base") + F.col("n")).alias("upto"))


@F.pandas_udf(LongType())
def _in_common(a: pd.Series, b: pd.Series) -> pd.Series:
    """Turns that two strings of digests begin with together."""

    def one(x: str, y: str | None) -> int:
        if y is None:
            return 0
        low, high = 0, min(len(x), len(y)) // WIDTH
        while low < high:
            mid = (low + high + 1) // 2
            low, high = (mid, high) if x.startswith(y[: mid * WIDTH]) else (low, mid - 1)
        return low

    return pd.Series([one(x, y) for x, y in zip(a, b)], dtype="int64")


def ordered(turns: DataFrame, lens: DataFrame, run: int = RUN) -> DataFrame:
    """conv_id, pos (place in the sorted order, equal sequences by id) and lcp (-1 for the first) of each conversation."""
    told = turns.select("conv_id", F.floor((F.col("depth") - 1) / run).alias("run"), "depth", "digest")
    joined = F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("depth", "digest"))), lambda x: x["digest"]), "")
    runs = materialize(told.groupBy("conv_id", "run").agg(joined.alias("key")), "runs")

    def with_key(rows: DataFrame, k: int) -> DataFrame:
        return rows.join(runs.where(F.col("run") == k).select("conv_id", "key"), "conv_id", "left").withColumn("key", F.coalesce("key", F.lit("")))

    now = with_key(lens.select("conv_id", F.lit(0).cast("long").alias("g"), F.lit(-1).cast("long").alias("g_lcp")), 0)
    k, placed = 0, None
    while True:
        rows = numbered(now, "g", "key", "conv_id", name="row")
        if k:
            least = rows.groupBy("g").agg(F.min("row").alias("g_row"), F.count("*").alias("__n"))
            rows = with_values(rows, least, "g", lens.count())
            rows = rows.withColumn("pos", F.col("g") + F.col("row") - F.col("g_row"))
        else:
            rows = rows.withColumn("pos", F.col("row"))
        before = rows.select((F.col("row") + 1).alias("row"), F.col("g").alias("g_before"), F.col("key").alias("key_before"))
        rows = rows.join(before, "row", "left")
        inside = F.coalesce(F.col("g") == F.col("g_before"), F.lit(False))
        rows = rows.withColumn("lcp", F.when(inside, k * run + _in_common("key", "key_before")).otherwise(F.col("g_lcp")))
        rows = materialize(rows.select("conv_id", "pos", "lcp", F.struct("g", "key").alias("same")), "sorted")
        # runs that are full and equal: only these go on
        ties = rows.where(F.length("same.key") == run * WIDTH).groupBy("same")
        ties = materialize(ties.agg(F.min("pos").alias("g"), F.min_by("lcp", "pos").alias("g_lcp"), F.count("*").alias("__n")).where("__n > 1"), "ties")
        here = rows.select("conv_id", "pos", "lcp")
        if not ties.head(1):
            return here if placed is None else placed.unionByName(here)
        k += 1
        open_ = materialize(with_values(rows, ties, "same", lens.count()).select("conv_id", "g", "g_lcp"), "open")
        here = here.join(open_.select("conv_id"), "conv_id", "left_anti")
        placed = here if placed is None else placed.unionByName(here)
        now = with_key(open_, k)


def _nearest_smaller(values: np.ndarray) -> np.ndarray:
    """Place of the last smaller value before each one, -1: none."""
    out, stack, said = np.full(len(values), -1, np.int64), [], values.tolist()
    for i, v in enumerate(said):
        while stack and said[stack[-1]] >= v:
            stack.pop()
        if stack:
            out[i] = stack[-1]
        stack.append(i)
    return out


POSITION = "pos long, block long, conv_id long, len long, lcp long, next_lcp long, leaves long, shared long, left long, right long"


def _inside(frame: pd.DataFrame) -> pd.DataFrame:
    """Nearest smaller values inside a block (-1: not in it), and running sums over the block."""
    frame = frame.sort_values("pos", ignore_index=True)
    lcp, pos = frame["lcp"].to_numpy(), frame["pos"].to_numpy()
    left, right = _nearest_smaller(lcp), _nearest_smaller(lcp[::-1])[::-1]
    frame["left"] = np.where(left >= 0, pos[left], -1)
    frame["right"] = np.where(right >= 0, pos[len(pos) - 1 - np.maximum(right, 0)], -1)
    frame["leaves"] = np.cumsum(frame["next_lcp"].to_numpy() < frame["len"].to_numpy())
    frame["shared"] = np.cumsum(frame["shared"].to_numpy())
    return frame


class Blocks:
    """What all tasks know of the blocks, of which there are at most ``MOST_BLOCKS``."""

    def __init__(self, rows: list):
        rows = sorted(rows, key=lambda r: r.block)
        column = lambda name: np.array([r[name] for r in rows], np.int64)
        self.lcp, self.conv, self.start = column("lcp"), column("conv"), column("start")
        self.leaves = np.concatenate([[0], np.cumsum(column("leaves"))])
        self.shared = np.concatenate([[0], np.cumsum(column("shared"))])

    def nearest(self, block: int, value: int, side: int) -> int:
        """The next block to the left (side 0) or right with a smaller minimum, -1: none."""
        found = np.flatnonzero((self.lcp[:block] if side == 0 else self.lcp[block + 1 :]) < value)
        return -1 if not len(found) else int(found[-1]) if side == 0 else block + 1 + int(found[0])


def _answer(asked: pd.DataFrame, rows: pd.DataFrame) -> pd.DataFrame:
    """Where a block has its last (side 0) or first value below those asked for."""
    rows = rows.sort_values("pos")
    lcp, pos = rows["lcp"].to_numpy(), rows["pos"].to_numpy()
    v = asked["value"].to_numpy()
    ahead = np.searchsorted(-np.minimum.accumulate(lcp), -v, side="right") if len(lcp) else v
    back = len(lcp) - 1 - np.searchsorted(-np.minimum.accumulate(lcp[::-1]), -v, side="right") if len(lcp) else v
    side = asked["side"].to_numpy()
    return pd.DataFrame({"target": asked["target"], "value": v, "side": side, "at": pos[np.where(side == 0, back, ahead)] if len(v) else v})


def _filled(rows: pd.DataFrame, answers: pd.DataFrame) -> pd.DataFrame:
    for side, name in enumerate(("left", "right")):
        known = answers[answers["side"] == side]
        known = dict(zip(known["value"], known["at"]))
        rows[name] = [at if at >= 0 else known.get(v, -1) for at, v in zip(rows[name], rows["lcp"])]
    return rows


def _least(values: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Minimum of values[a:b] for each a < b."""
    levels, n = [values], 1
    while 2 * n <= len(values):
        levels.append(np.minimum(levels[-1][:-n], levels[-1][n:]))
        n *= 2
    size = np.maximum(b - a, 1)
    level = np.floor(np.log2(size)).astype(np.int64)
    out = np.empty(len(a), np.int64)
    for k in np.unique(level):
        w = np.flatnonzero(level == k)
        out[w] = np.minimum(levels[k][a[w]], levels[k][b[w] - (1 << int(k))])
    return out


def positions(turns: DataFrame, lens: DataFrame, block: int = BLOCK, run: int = RUN, upto: DataFrame | None = None) -> tuple[DataFrame, Blocks, int]:
    """A row for each conversation in sorted order with its nearest smaller values, the blocks' figures and a block's size."""
    spark = turns.sparkSession
    placed = materialize(ordered(turns, lens, run), "placed")
    n = placed.count()
    size = max(block, -(-n // MOST_BLOCKS))
    upto = words_before(turns) if upto is None else upto
    shared = upto.select("conv_id", F.col("depth").alias("lcp"), F.col("upto").alias("shared"))
    after = placed.select((F.col("pos") - 1).alias("pos"), F.col("lcp").alias("next_lcp"))
    rows = placed.join(lens, "conv_id").join(after, "pos", "left").join(shared, ["conv_id", "lcp"], "left")
    zero, none = F.lit(0).cast("long"), F.lit(-1).cast("long")
    rows = rows.select(
        "pos", F.floor(F.col("pos") / size).alias("block"), "conv_id", "len", "lcp", F.coalesce("next_lcp", none).alias("next_lcp"), zero.alias("leaves"),
        F.coalesce("shared", zero).alias("shared"), none.alias("left"), none.alias("right"),
    )
    rows = materialize(rows.groupBy("block").applyInPandas(_inside, POSITION), "blocks")
    sums = rows.groupBy("block").agg(
        F.min("lcp").alias("lcp"), F.min("conv_id").alias("conv"), F.min("pos").alias("start"), F.max("leaves").alias("leaves"), F.max("shared").alias("shared")
    )
    blocks = Blocks(sums.collect())  # at most MOST_BLOCKS rows
    known = spark.sparkContext.broadcast(blocks)

    def aim(frames):
        for frame in frames:
            frame["target"] = [known.value.nearest(b, v, s) for b, v, s in zip(frame["block"], frame["value"], frame["side"])]
            yield frame

    lack = lambda name, side: rows.where((F.col(name) < 0) & (F.col("pos") > 0)).select("block", F.col("lcp").alias("value"), F.lit(side).alias("side"))
    asked = lack("left", 0).unionByName(lack("right", 1)).distinct().mapInPandas(aim, "block long, value long, side int, target long")
    asked = materialize(asked, "asked")  # at most a row for each length in each block
    wanted = asked.where("target >= 0").select("target", "value", "side").distinct()
    told = wanted.groupBy("target").cogroup(rows.groupBy("block")).applyInPandas(lambda a, b: _answer(a, b), "target long, value long, side int, at long")
    told = asked.join(told, ["target", "value", "side"], "left").select("block", "value", "side", F.coalesce("at", F.lit(n)).alias("at"))
    return materialize(rows.groupBy("block").cogroup(told.groupBy("block")).applyInPandas(lambda a, b: _filled(a, b), POSITION), "smaller"), blocks, size


def compact(rows: DataFrame, blocks: Blocks, size: int) -> DataFrame:
    """Branching and last nodes: members [l, r), depth, parent's depth p and first member pl, head (id at l), conv_id, figures."""
    known = rows.sparkSession.sparkContext.broadcast(blocks)
    inner = rows.where("pos > 0").select(F.col("left").alias("l"), F.col("right").alias("r"), F.col("lcp").alias("depth")).distinct()
    ends = rows.where(F.col("len") > F.greatest("lcp", "next_lcp")).select(F.col("pos").alias("l"), (F.col("pos") + 1).alias("r"), F.col("len").alias("depth"))
    nodes = inner.unionByName(ends)

    def at_start(nodes: pd.DataFrame, rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values("pos")
        b, start = int(rows["block"].iloc[0]), int(rows["pos"].iloc[0])
        at = nodes["l"].to_numpy() - start
        conv = rows["conv_id"].to_numpy()
        leaves, shared = rows["leaves"].to_numpy(), rows["shared"].to_numpy()
        took = lambda name: rows[name].to_numpy()[at]
        before = np.where(at > 0, leaves[at - 1], 0)
        least = _least(conv, at, np.minimum(nodes["r"].to_numpy() - start, len(conv)))
        return nodes.assign(l_lcp=took("lcp"), l_left=took("left"), head=took("conv_id"), conv_id=least, n_leaves=-(before + known.value.leaves[b]), saved=-(shared[at] + known.value.shared[b]))

    def at_end(nodes: pd.DataFrame, rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values("pos")
        b, start = int(rows["block"].iloc[0]), int(rows["pos"].iloc[0])
        at = nodes["r"].to_numpy() - 1 - start
        first = np.minimum.accumulate(rows["conv_id"].to_numpy())
        from_block = nodes["l"].to_numpy() // size
        least = nodes["conv_id"].to_numpy().copy()
        far = from_block < b
        least[far] = np.minimum(least[far], first[at[far]])
        between = far & (from_block + 1 < b)
        if between.any():
            least[between] = np.minimum(least[between], _least(known.value.conv, from_block[between] + 1, np.full(int(between.sum()), b)))
        p = np.maximum(nodes["l_lcp"].to_numpy(), rows["next_lcp"].to_numpy()[at])
        pl = np.where(nodes["l_lcp"].to_numpy() == p, nodes["l_left"].to_numpy(), nodes["l"].to_numpy())
        return pd.DataFrame({
            "l": nodes["l"], "r": nodes["r"], "depth": nodes["depth"], "p": p, "pl": np.where(p < 0, -1, pl), "head": nodes["head"], "conv_id": least,
            "n_leaves": nodes["n_leaves"].to_numpy() + rows["leaves"].to_numpy()[at] + known.value.leaves[b], "saved": nodes["saved"].to_numpy() + rows["shared"].to_numpy()[at] + known.value.shared[b],
        })

    columns = "l long, r long, depth long, {}head long, conv_id long, n_leaves long, saved long"
    half = nodes.withColumn("block", F.floor(F.col("l") / size)).groupBy("block").cogroup(rows.groupBy("block")).applyInPandas(
        lambda a, b: at_start(a.drop(columns="block"), b), columns.format("l_lcp long, l_left long, ")
    )
    return half.withColumn("block", F.floor((F.col("r") - 1) / size)).groupBy("block").cogroup(rows.groupBy("block")).applyInPandas(
        lambda a, b: at_end(a.drop(columns="block"), b), columns.format("p long, pl long, ")
    )


def ends(rows: DataFrame) -> DataFrame:
    """l, depth and ends_sha256 of nodes at which conversations end: the digest of their ids, streamed in order.

    Members that end at a node stand at the front of its interval by ascending id; a row carries ``PIECE`` of them."""
    told = rows.select(F.when(F.col("lcp") < F.col("len"), F.col("pos")).otherwise(F.col("left")).alias("l"), F.col("len").alias("depth"), "pos", "conv_id")
    ids = F.transform(F.sort_array(F.collect_list(F.struct("pos", "conv_id"))), lambda x: x["conv_id"].cast("string"))
    pieces = told.groupBy("l", "depth", F.floor((F.col("pos") - F.col("l")) / PIECE).alias("k")).agg(F.array_join(ids, ",").alias("ids"))

    def digest(batches):
        now, hashed = None, None
        for batch in batches:
            out = []
            for l, depth, ids in zip(*(batch.column(c).to_pylist() for c in ("l", "depth", "ids"))):
                if now == (l, depth):
                    hashed.update(b"," + ids.encode())
                    continue
                if now is not None:
                    out.append((*now, hashed.hexdigest()))
                now, hashed = (l, depth), hashlib.sha256(ids.encode())
            yield table(out)
        yield table([] if now is None else [(*now, hashed.hexdigest())])

    def table(out: list) -> pa.RecordBatch:
        columns = list(zip(*out)) or [[], [], []]
        return pa.RecordBatch.from_arrays([pa.array(columns[0], pa.int64()), pa.array(columns[1], pa.int64()), pa.array(columns[2], pa.string())], ["l", "depth", "ends_sha256"])

    return pieces.repartition("l", "depth").sortWithinPartitions("l", "depth", "k").mapInArrow(digest, "l long, depth long, ends_sha256 string")


def trie(conversations: DataFrame, block: int = BLOCK, run: int = RUN) -> DataFrame:
    """A row for each node of the trie of the rebuilt conversations; see the module for the cases."""
    turns, lens = rebuilt(conversations)
    if not lens.head(1):
        return conversations.sparkSession.createDataFrame([], NODE)
    upto = materialize(words_before(turns), "words")
    rows, blocks, size = positions(turns, lens, block, run, upto)
    found = materialize(compact(rows, blocks, size), "nodes")
    deep, total = found.agg(F.max("depth"), F.count("*")).first()
    name = lambda first, depth: (F.col(first) * (deep + 1) + F.col(depth)).alias("node")
    found = found.withColumn("node", name("l", "depth"))
    # what a parent has to tell its children, of whom it may have very many, and how many they are
    kids = found.where("p >= 0").groupBy(name("pl", "p")).agg(F.count("*").alias("__n"))
    parents = materialize(found.select("node", F.col("conv_id").alias("parent")).join(kids, "node"), "parents")
    below = with_values(found.where("p >= 0").drop("node").withColumn("above", name("pl", "p")), parents.withColumnRenamed("node", "above"), "above", total)
    top = found.where("p < 0").drop("node").withColumns({"above": F.lit(None).cast("long"), "parent": F.lit(None).cast("long")})
    each = below.unionByName(top).withColumn("node", name("l", "depth")).join(parents.select("node", F.col("__n").alias("kids")), "node", "left")
    spread = each.withColumnRenamed("depth", "last").withColumn("depth", F.explode(F.sequence(F.col("p") + 1, F.col("last"))))
    before = upto.select(F.col("conv_id").alias("head"), (F.col("depth") + 1).alias("depth"), "upto")
    spread = spread.join(before, ["head", "depth"], "left").join(ends(rows), ["l", "depth"], "left")
    n = F.col("r") - F.col("l")
    zero = F.lit(0).cast("long")
    return spread.select(
        "conv_id", "depth", F.when(F.col("depth") == F.col("p") + 1, F.col("parent")).otherwise(F.col("conv_id")).alias("parent_conv_id"), n.alias("n_convs"),
        F.when(F.col("depth") < F.col("last"), F.lit(1)).otherwise(F.coalesce("kids", zero)).cast("long").alias("n_children"), "n_leaves",
        (F.col("saved") - (n - 1) * F.coalesce("upto", zero)).alias("saved_tokens"), F.coalesce("ends_sha256", F.sha2(F.lit(""), 256)).alias("ends_sha256"),
    )
