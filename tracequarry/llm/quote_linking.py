"""Quotation linking: reply-ordered conversations without quotes.

A line's quote level is the number of ``>`` in the marks that it starts with; lines
of level 0 are a message's own.  Neighbouring lines of one level without a blank
line between them are a passage.  Passages, their sentences and their lines are
normalised (marks and white space off, lower case, so wrapping doesn't matter) and
hashed.  The original of a quoted unit, whatever its level, is the first earlier
turn of the conversation that has it among its own.

A message replies to the turn that most characters of its lowest linked level come
from (the latest of several).  A message without a linked quote replies to the
latest turn before it.  The conversation is read in the order of the reply tree,
each message followed by its replies in order of turn.  Places come from ranking the
linked list of the tree's tour by doubling steps, so no task holds a whole
conversation, a whole thread or all replies to one message.

Only DataFrame operations are used.  Null text is empty.  A message with a null
conversation or turn stands alone: it has no parent, thread or position.  Repeated
(conversation, turn) rows are one message for linking, and keep a row and a position
each, in any order.  An empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tracequarry.lineage import materialize

#: A line's leading quote marks.
MARKS = r"^[ \t]*(>[ \t>]*)?"
KEY = ["conv_id", "turn"]
#: Turns of a bucket in which neighbours are found.
BUCKET = 1000
_NONE = -(2**63)


def level(line: Column) -> Column:
    return F.length(F.regexp_replace(F.regexp_extract(line, MARKS, 1), "[^>]", ""))


def normal(line: Column) -> Column:
    """The line without marks, with single spaces, in lower case."""
    return F.lower(F.trim(F.regexp_replace(F.regexp_replace(line, MARKS, ""), r"[ \t\r]+", " ")))


def passages(text: Column) -> Column:
    """Level and wording of each passage; its lines are kept apart by line ends."""
    marked = F.transform(F.split(text, "\n"), lambda x: F.struct(level(x).alias("lvl"), normal(x).alias("line")))

    def joined(lines: Column) -> Column:
        def piece(x: Column, i: Column) -> Column:
            before = F.get(lines, i - 1)
            same = F.coalesce((before["lvl"] == x["lvl"]) & (before["line"] != ""), F.lit(False))
            head = F.when(same, "\n").otherwise(F.concat(F.lit("\x02"), x["lvl"].cast("string"), F.lit("\x01")))
            return F.when(x["line"] == "", "").otherwise(F.concat(head, F.regexp_replace(x["line"], "[\x01\x02]", " ")))

        return F.array_join(F.transform(lines, piece), "")

    found = F.filter(F.split(F.transform(F.array(marked), joined)[0], "\x02"), lambda x: x != "")
    return F.transform(
        found, lambda x: F.struct(F.substring_index(x, "\x01", 1).cast("int").alias("lvl"), F.substring_index(x, "\x01", -1).alias("wording"))
    )


def units(messages: DataFrame) -> DataFrame:
    """conv_id, turn, lvl, hash and n (characters) of each distinct passage, sentence and line."""
    each = messages.where("conv_id is not null and turn is not null").select(*KEY, F.explode(passages(F.col("text"))).alias("p"))
    whole = F.replace("p.wording", F.lit("\n"), F.lit(" "))
    sentences = F.split(F.regexp_replace(whole, "([.!?]) ", "$1\n"), "\n")
    kinds = F.array_distinct(F.transform(F.concat(F.array(whole), sentences, F.split("p.wording", "\n")), lambda x: F.replace(x, F.lit(" "), F.lit(""))))
    each = each.select(*KEY, "p.lvl", F.explode(kinds).alias("unit")).where("unit <> ''")
    return each.select(*KEY, "lvl", F.sha2("unit", 256).alias("hash"), F.length("unit").cast("long").alias("n")).distinct()


def neighbour(rows: DataFrame, keys: list[str], order: str, name: str) -> DataFrame:
    """Distinct keys and ``order`` plus ``name``, the next smaller value of ``order`` under the same keys (null: none).

    Values are dealt to buckets; only the buckets' largest values meet under a key."""
    cell = [*keys, "__bucket"]
    rows = rows.select(*keys, order).distinct().withColumn("__bucket", F.floor(F.col(order) / BUCKET))
    last = rows.groupBy(*cell).agg(F.max(order).alias("__last"))
    before = last.withColumn("__before", F.lag("__last").over(Window.partitionBy(*keys).orderBy("__bucket"))).drop("__last")
    inside = rows.withColumn(name, F.lag(order).over(Window.partitionBy(*cell).orderBy(order)))
    return inside.join(before, cell).select(*keys, order, F.coalesce(name, "__before").alias(name))


def parents(messages: DataFrame) -> DataFrame:
    """conv_id, turn, parent_turn (null: none), by_quote and n_linked (quoted units with an original) of each distinct message."""
    there = messages.where("conv_id is not null and turn is not null").select(*KEY).distinct()
    quoting = messages.where(F.col("text").rlike(r"(?m)^[ \t]*>"))
    quoted = units(quoting).where("lvl > 0")
    talks = quoting.select("conv_id").distinct()  # originals matter only where something is quoted
    originals = units(messages.join(talks, "conv_id", "left_semi")).where("lvl = 0").groupBy("conv_id", "hash").agg(F.min("turn").alias("original"))
    linked = quoted.join(originals, ["conv_id", "hash"]).where("original < turn")
    linked = linked.groupBy(*KEY, "lvl", "original").agg(F.sum("n").alias("n"), F.count("*").alias("units"))
    best = F.max(F.struct((-F.col("lvl")).alias("lvl"), "n", "original"))["original"]
    linked = linked.groupBy(*KEY).agg(best.alias("quoted_turn"), F.sum("units").alias("n_linked"))
    before = neighbour(there, ["conv_id"], "turn", "turn_before")
    out = before.join(linked, KEY, "left")
    return out.select(
        *KEY, F.coalesce("quoted_turn", "turn_before").alias("parent_turn"), F.col("quoted_turn").isNotNull().alias("by_quote"),
        F.coalesce("n_linked", F.lit(0).cast("long")).alias("n_linked"),
    )


def threads(replies: DataFrame) -> DataFrame:
    """``replies`` plus thread_turn, the message that its chain of replies starts from, and depth below it."""
    root = F.col("parent_turn").isNull()
    start = replies.withColumns({"up": F.coalesce("parent_turn", "turn"), "depth": F.when(root, 0).otherwise(1).cast("long"), "done": root})
    kept = [*replies.columns]
    now = materialize(start.select(*kept, "up", "depth", "done"), "threads")
    finished, open_rows = now.where("done"), now.where("not done")
    while open_rows.limit(1).count():
        # only messages whose chain isn't followed to its start move on; what they point at may be done
        above = finished.unionByName(open_rows).select("conv_id", F.col("turn").alias("up"), F.col("up").alias("next"), F.col("depth").alias("more"), F.col("done").alias("end"))
        new = open_rows.drop("done").join(above, ["conv_id", "up"])
        new = new.select(*kept, F.col("next").alias("up"), (F.col("depth") + F.col("more")).alias("depth"), F.col("end").alias("done"))
        new = materialize(new, "threads")
        finished, open_rows = finished.unionByName(new.where("done")), new.where("not done")
    return finished.drop("done").withColumnRenamed("up", "thread_turn")


def tree_places(replies: DataFrame, sizes: DataFrame) -> DataFrame:
    """conv_id, turn and first: rows of the conversation that stand before the message in the order of the tree.

    The tour enters a message, passes its replies by turn and leaves it.  Each step knows the one before it; doubling these
    distances sums up the rows entered before. ``sizes``: rows of each message."""
    under = F.coalesce("parent_turn", F.lit(_NONE)).alias("under")
    nodes = replies.select(*KEY, "parent_turn", under)
    siblings = neighbour(nodes.select("conv_id", "under", "turn"), ["conv_id", "under"], "turn", "sibling")
    last = nodes.groupBy("conv_id", F.col("under").alias("turn")).agg(F.max("turn").alias("last"))
    known = nodes.join(siblings, ["conv_id", "under", "turn"]).join(last, KEY, "left").join(sizes, KEY)
    enter = F.struct(
        F.lit(False).alias("out"),
        F.when(F.col("sibling").isNotNull(), F.struct(F.col("sibling").alias("turn"), F.lit(True).alias("out")))
        .when(F.col("parent_turn").isNotNull(), F.struct(F.col("parent_turn").alias("turn"), F.lit(False).alias("out"))).alias("back"),
        F.col("n").alias("sum"),
    )
    leave = F.struct(
        F.lit(True).alias("out"),
        F.when(F.col("last").isNotNull(), F.struct(F.col("last").alias("turn"), F.lit(True).alias("out")))
        .otherwise(F.struct(F.col("turn"), F.lit(False).alias("out"))).alias("back"),
        F.lit(0).cast("long").alias("sum"),
    )
    steps = known.select(*KEY, F.explode(F.array(enter, leave)).alias("s")).select(*KEY, "s.out", "s.back", "s.sum")
    now = materialize(steps, "tour")
    finished, open_rows = now.where("back is null"), now.where("back is not null")
    while open_rows.limit(1).count():
        earlier = finished.unionByName(open_rows).select("conv_id", F.struct("turn", "out").alias("at"), F.col("back").alias("next"), F.col("sum").alias("more"))
        met = open_rows.select("*", F.col("back").alias("at")).join(earlier, ["conv_id", "at"])
        new = materialize(met.select(*KEY, "out", F.col("next").alias("back"), (F.col("sum") + F.col("more")).alias("sum")), "tour")
        finished, open_rows = finished.unionByName(new.where("back is null")), new.where("back is not null")
    return finished.where("not out").join(sizes, KEY).select(*KEY, (F.col("sum") - F.col("n")).alias("first"))


def link(conversations: DataFrame) -> DataFrame:
    """One row per message, without its quotes, and its place in the conversation in the order of the reply tree."""
    text = F.coalesce(F.col("text"), F.lit(""))
    kind = conversations.schema["turn"].dataType
    messages = conversations.select("conv_id", F.col("turn").cast("long").alias("turn"), "role", text.alias("text"))
    split = F.split("text", "\n")
    own = F.array_join(F.filter(split, lambda x: level(x) == 0), "\n")
    found = materialize(threads(parents(messages)), "replies")
    counted = messages.select(
        *KEY,
        "role",
        own.alias("own_text"),
        F.size(F.filter(split, lambda x: level(x) > 0)).cast("long").alias("n_quoted_lines"),
        F.array_max(F.transform(split, level)).cast("long").alias("max_level"),
        F.spark_partition_id().alias("part"),
    )
    counted = materialize(counted, "messages")
    # repeated rows of a message are dealt out by the part that they were read in
    cells = counted.groupBy(*KEY, "part").agg(F.count("*").alias("n"))
    sizes = cells.groupBy(*KEY).agg(F.sum("n").alias("n"))
    before = F.coalesce(F.sum("n").over(Window.partitionBy(*KEY).orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    cells = cells.where("conv_id is not null and turn is not null").select(*KEY, "part", before.alias("before"))
    places = cells.join(tree_places(found.select(*KEY, "parent_turn"), sizes), KEY)
    within = F.row_number().over(Window.partitionBy(*KEY, "part").orderBy("role", "own_text")) - 1
    placed = counted.where("conv_id is not null and turn is not null").withColumn("r", within).join(places, [*KEY, "part"]).join(found, KEY)
    alone = counted.where("conv_id is null or turn is null")
    columns = ["parent_turn", "by_quote", "n_linked", "thread_turn", "depth", "position"]
    place = (F.col("first") + F.col("before") + F.col("r")).cast("long")
    nothing = {"by_quote": F.lit(False), "n_linked": F.lit(0).cast("long"), "depth": F.lit(0).cast("long")}
    nothing |= {c: F.lit(None).cast("long") for c in columns if c not in nothing}
    rows = placed.withColumn("position", place).select(*KEY, "role", *columns, "n_quoted_lines", "max_level", "own_text")
    rows = rows.unionByName(alone.withColumns(nothing).select(*rows.columns))
    return rows.withColumns({c: F.col(c).cast(kind) for c in ("turn", "parent_turn", "thread_turn")})


ORACLE = r"""
WITH RECURSIVE m AS (
  SELECT conv_id, turn, role, string_split(coalesce(text, ''), chr(10)) AS ls FROM conversations),
l AS (SELECT conv_id, turn, generate_subscripts(ls, 1) AS i, unnest(ls) AS line FROM m),
n AS (
  SELECT conv_id, turn, i, length(regexp_replace(regexp_extract(line, '^[ \t]*(>[ \t>]*)?', 1), '[^>]', '', 'g')) AS lvl,
    lower(trim(regexp_replace(regexp_replace(line, '^[ \t]*(>[ \t>]*)?', ''), '[ \t\r]+', ' ', 'g'))) AS line
  FROM l),
b AS (SELECT *, CASE WHEN lag(lvl) OVER w = lvl AND lag(line) OVER w <> '' THEN 0 ELSE 1 END AS start FROM n WINDOW w AS (PARTITION BY conv_id, turn ORDER BY i)),
g AS (SELECT *, sum(start) OVER (PARTITION BY conv_id, turn ORDER BY i) AS run FROM b),
ps AS (SELECT conv_id, turn, lvl, run, string_agg(line, chr(10) ORDER BY i) AS wording FROM g WHERE line <> '' GROUP BY ALL),
us AS (
  SELECT DISTINCT conv_id, turn, lvl, replace(x, ' ', '') AS unit FROM (
    SELECT conv_id, turn, lvl, replace(wording, chr(10), ' ') AS x FROM ps
    UNION ALL SELECT conv_id, turn, lvl, unnest(string_split(regexp_replace(replace(wording, chr(10), ' '), '([.!?]) ', '\1' || chr(10), 'g'), chr(10))) FROM ps
    UNION ALL SELECT conv_id, turn, lvl, unnest(string_split(wording, chr(10))) FROM ps) WHERE replace(x, ' ', '') <> ''),
o AS (SELECT conv_id, unit, min(turn) AS original FROM us WHERE lvl = 0 GROUP BY ALL),
q AS (
  SELECT us.conv_id, us.turn, us.lvl, o.original, sum(length(unit)) AS k, count(*) AS units FROM us JOIN o USING (conv_id, unit)
  WHERE us.lvl > 0 AND o.original < us.turn GROUP BY ALL),
p AS (SELECT conv_id, turn, original AS quoted_turn, sum(units) OVER (PARTITION BY conv_id, turn) AS n_linked
  FROM q QUALIFY row_number() OVER (PARTITION BY conv_id, turn ORDER BY lvl, k DESC, original DESC) = 1),
d AS (SELECT DISTINCT conv_id, turn FROM m WHERE conv_id IS NOT NULL AND turn IS NOT NULL),
e AS (SELECT conv_id, turn, lag(turn) OVER (PARTITION BY conv_id ORDER BY turn) AS turn_before FROM d),
r AS (
  SELECT e.conv_id, e.turn, coalesce(p.quoted_turn, e.turn_before) AS parent_turn, p.quoted_turn IS NOT NULL AS by_quote, coalesce(n_linked, 0)::BIGINT AS n_linked
  FROM e LEFT JOIN p USING (conv_id, turn)),
t AS (
  SELECT conv_id, turn, parent_turn, by_quote, n_linked, turn AS thread_turn, 0 AS depth, [turn] AS path FROM r WHERE parent_turn IS NULL
  UNION ALL
  SELECT r.conv_id, r.turn, r.parent_turn, r.by_quote, r.n_linked, t.thread_turn, t.depth + 1, list_append(t.path, r.turn)
  FROM r JOIN t ON r.conv_id = t.conv_id AND r.parent_turn = t.turn)
SELECT m.conv_id, m.turn, m.role, t.parent_turn, coalesce(t.by_quote, false) AS by_quote, coalesce(t.n_linked, 0) AS n_linked, t.thread_turn, coalesce(t.depth, 0)::BIGINT AS depth,
  CASE WHEN t.turn IS NOT NULL THEN row_number() OVER (PARTITION BY m.conv_id ORDER BY t.path, m.role) - 1 END AS position,
  len(list_filter(ls, lambda x: regexp_matches(x, '^[ \t]*>')))::BIGINT AS n_quoted_lines,
  list_max(list_transform(ls, lambda x: length(regexp_replace(regexp_extract(x, '^[ \t]*(>[ \t>]*)?', 1), '[^>]', '', 'g'))))::BIGINT AS max_level,
  array_to_string(list_filter(ls, lambda x: NOT regexp_matches(x, '^[ \t]*>')), chr(10)) AS own_text
FROM m LEFT JOIN t ON t.conv_id = m.conv_id AND t.turn = m.turn
"""

#: A stand-in with real quotes: each turn but the first quotes one of the three before it, and what that one quoted.
QUOTED = r"""
SELECT conv_id, turn, role, CASE WHEN quoted IS NULL THEN text
  ELSE concat('> ', replace(quoted, chr(10), concat(chr(10), '> ')), chr(10), chr(10), text) END AS text
FROM (
  SELECT c.conv_id, c.turn, c.role, c.text, CASE WHEN b.text IS NULL THEN a.text
    ELSE concat('> ', replace(b.text, chr(10), concat(chr(10), '> ')), chr(10), chr(10), a.text) END AS quoted
  FROM conversations c
  LEFT JOIN conversations a ON a.conv_id = c.conv_id AND a.turn = c.turn - 1 - c.turn % 3
  LEFT JOIN conversations b ON b.conv_id = a.conv_id AND b.turn = a.turn - 1 - a.turn % 3)
"""
QUOTED_ORACLE = ORACLE.replace("FROM conversations)", f"FROM ({QUOTED}))", 1)
