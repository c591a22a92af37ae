"""Conversations from reply trees, with DataFrame functions only.

Messages reply to messages. Self-joins in rounds, each of which doubles the distance that it looks up the
tree, give every message its depth and the scores on its way to the root. A message without a
reply ends a branch; the branches of a tree are ranked by score. The chosen ones are walked back by
the same jumps, from the longest to the shortest, so that a path of n messages takes
log n rounds, and each is formatted as one text. Only ids take part in the rounds; texts are joined once.

A template marks the turns. Its control strings inside roles and texts get a backslash behind
their first character (and one more where there were some), which `read_back` takes away again.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from skymart.cluster import settle
from skymart.llm.components import settle_narrow
from skymart.operators.numbering import dense, placed
from skymart.operators.skew import heat, salted_lookup

#: The marks of a turn. START role HEAD text END, turn after turn.
START, HEAD, END = "<s>[INST] ", " [/INST]\n", "</s>\n"
#: What may not stand in a role or text: <s> </s> [INST] [/INST], plain or already escaped.
_CONTROL = r"([<\[])(\\*)(/?(?:s>|INST\]))"
_ESCAPED = r"([<\[])\\(\\*)(/?(?:s>|INST\]))"
LEARNED_ROLES = ("assistant",)
_SORTED_CHARS = 100
#: UTF-32 of the mark that its decoder takes away in front of a text.
_MARK = "0000FEFF"


def messages(conversations: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Conversations of turns as trees without branches: links (id, parent, tree, score) and bodies.

    Each turn replies to the one before it. Turns of a conversation are taken by turn, null first, then by
    role and text (null: empty); repeated rows are turns of their own. A null conv_id is a
    conversation too. ids are dense from 1 in that order. Other columns are not read.
    """
    text = [F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in ("role", "text")]
    rows = conversations.select(
        F.col("conv_id").cast("long").alias("tree"), F.col("turn").cast("long").alias("turn"), *text
    )
    # A sample of the keys passes through the driver: they are kept short.
    dealt = rows.repartitionByRange("tree", "turn", F.left("role", F.lit(_SORTED_CHARS)))
    written = settle(placed(dealt.sortWithinPartitions("tree", "turn", "role", "text"), "place"))
    numbered = dense(written, "place", "id")
    ids = numbered.select("id", "tree")
    before = numbered.select((F.col("id") + 1).alias("next"), F.col("tree").alias("before"))
    same = F.col("next").isNotNull() & F.col("before").eqNullSafe(F.col("tree"))
    links = ids.join(before, F.col("id") == F.col("next"), "left").select(
        "id", F.when(same, F.col("id") - 1).alias("parent"), "tree", F.lit(0.0).alias("score")
    )
    return links, numbered.select("id", "role", "text")


def best_branches(links: DataFrame, keep: int = 1) -> DataFrame:
    """tree, leaf, rank, mean, size, place and id of every message on the best branches of a tree.

    links has a row for each message: id (unique), parent (id or null), tree, score (null: 0). The
    keep branches with the largest mean score are chosen; ties go to the longer, then the smaller
    leaf. place is 0 at the root. A parent that is no message counts as none; messages on or below
    a circle of replies have no root and are on no branch. Parents with very many
    replies are dealt over tasks. No messages give no rows.
    """
    if keep < 1:
        raise ValueError("keep at least one branch")
    score = F.coalesce(F.col("score").cast("double"), F.lit(0.0)).alias("score")
    own = settle(links.select(F.col("id").cast("long"), F.col("parent").cast("long"), "tree", score))
    total = own.count()
    ids = own.select(F.col("id").alias("known"), F.col("id").alias("up"))
    first = salted_lookup(own, heat(own, "parent"), ids, "parent", "known", F.col("id"), "left")
    one = F.lit(1).cast("long").alias("size")
    state = settle_narrow(first.select("id", "up", one, F.col("score").alias("sum")))
    # up is null once the way to the root is known, else the message 2 ** round above.
    jumps: list[DataFrame] = []
    while 1 << len(jumps) <= 2 * total:
        moving = state.filter("up is not null")
        if not (heated := heat(moving, "up")).rows:
            break
        jumps.append(moving.select(F.col("id").alias("low"), F.col("up").alias("high")))
        beyond = state.select(
            F.col("id").alias("known"), F.col("up").alias("upper"),
            F.col("size").alias("more"), F.col("sum").alias("more_sum"),
        )
        moved = salted_lookup(moving, heated, beyond, "up", "known", F.col("id")).select(
            "id", F.col("upper").alias("up"),
            (F.col("size") + F.col("more")).alias("size"), (F.col("sum") + F.col("more_sum")).alias("sum"),
        )
        # Written whole in each round: a stack of rounds would take the optimizer ever longer.
        state = settle_narrow(moved.union(state.filter("up is null")))
    answered = own.select(F.col("parent").alias("id")).distinct()
    leaves = state.filter("up is null").join(answered, "id", "left_anti")
    leaves = leaves.join(own.select("id", "tree"), "id")
    mean = F.col("sum") / F.col("size")
    best = Window.partitionBy("tree").orderBy(F.desc("mean"), F.desc("size"), "id")
    chosen = leaves.select("tree", "id", "size", mean.alias("mean"))
    chosen = chosen.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= keep)
    walk = settle_narrow(
        chosen.select(
            "tree", F.col("id").alias("leaf"), "rank", "mean", "size",
            (F.col("size") - 1).alias("place"), "id",
        )
    )
    for level in reversed(range(len(jumps))):
        step = 1 << level
        far = walk.filter(F.col("place") >= step)
        if not (heated := heat(far, "id")).rows:
            continue
        more = salted_lookup(far, heated, jumps[level], "id", "low", F.col("leaf"))
        more = more.withColumn("place", F.col("place") - step).withColumn("id", F.col("high"))
        walk = walk.union(settle_narrow(more.drop("high").select(*walk.columns)))
    return walk


def escaped(text: Column) -> Column:
    return F.regexp_replace(text, _CONTROL, r"$1\\$2$3")


def unescaped(text: Column) -> Column:
    return F.regexp_replace(text, _ESCAPED, "$1$2$3")


def formatted(branches: DataFrame, bodies: DataFrame) -> DataFrame:
    """Each branch as one conversation: tree, leaf, rank, mean, text and its loss mask.

    bodies has id, role and text of every message (null: empty). loss is an array of start and
    stop, in code points of the text: what a model shall learn, the texts of LEARNED_ROLES. A
    conversation is one value, so it may have 2 GB.
    """
    known = bodies.select(
        F.col("id").alias("known"),
        escaped(F.coalesce("role", F.lit(""))).alias("role"),
        escaped(F.coalesce("text", F.lit(""))).alias("body"),
        F.coalesce("role", F.lit("")).isin(*LEARNED_ROLES).alias("learned"),
    )
    turns = salted_lookup(branches, heat(branches, "id"), known, "id", "known", F.col("leaf"))
    head = F.concat(F.lit(START), F.col("role"), F.lit(HEAD))
    turns = turns.withColumn("head", F.char_length(head).cast("long"))
    turns = turns.withColumn("chars", F.char_length("body").cast("long"))
    turns = turns.withColumn("piece", F.concat(head, F.col("body"), F.lit(END)))
    before = Window.partitionBy("leaf").orderBy("place").rowsBetween(Window.unboundedPreceding, -1)
    at = F.coalesce(F.sum(F.col("head") + F.col("chars") + len(END)).over(before), F.lit(0))
    turns = turns.withColumn("start", (at + F.col("head")).cast("long"))
    turn = F.struct("place", "piece", "learned", "start", (F.col("start") + F.col("chars")).alias("stop"))
    # All that is constant on a branch is taken along, not grouped by: trees may be null.
    own = [F.first(c).alias(c) for c in ("tree", "rank", "mean")]
    whole = turns.groupBy("leaf").agg(*own, F.array_sort(F.collect_list(turn)).alias("turns"))
    learned = F.filter("turns", lambda t: t["learned"])
    return whole.select(
        "tree", "leaf", "rank", "mean",
        F.array_join(F.transform("turns", lambda t: t["piece"]), "").alias("text"),
        F.transform(learned, lambda t: F.struct(t["start"].alias("start"), t["stop"].alias("stop"))).alias("loss"),
    )


def read_back(text: Column) -> Column:
    """The turns of a formatted conversation: an array of role and text."""
    pieces = F.split(text, rf"\Q{END}\E", -1)
    pieces = F.slice(pieces, F.lit(1), F.size(pieces) - 1)

    def turn(piece: Column) -> Column:
        head = F.instr(piece, HEAD)
        role = F.substring(piece, F.lit(len(START) + 1), head - F.lit(len(START) + 1))
        body = F.substring(piece, head + F.lit(len(HEAD)), F.char_length(piece))
        return F.struct(unescaped(role).alias("role"), unescaped(body).alias("text"))

    return F.transform(pieces, turn)


def learned_text(text: Column, loss: Column) -> Column:
    """What lies under the loss mask, unescaped, one span behind the other.

    Four bytes for each code point, so that a span is cut out without a look at what is before it.
    """
    mark = F.unhex(F.lit(_MARK))

    def cut(wide: Column, span: Column) -> Column:
        begin, size = span["start"] * 4 + 1, (span["stop"] - span["start"]) * 4
        part = F.substring(wide, begin.cast("int"), size.cast("int"))
        return unescaped(F.decode(F.concat(mark, part), "UTF-32"))

    # The text is encoded once: inside a lambda a variable stands for it.
    joined = F.transform(
        F.array(F.encode(text, "UTF-32")),
        lambda wide: F.array_join(F.transform(loss, lambda span: cut(wide, span)), ""),
    )
    return joined[0]


def digests(conversations: DataFrame) -> DataFrame:
    """tree, n_turns, turns_sha256, loss_chars, loss_sha256, formatted_chars, from the texts alone."""
    read = conversations.select(
        "tree", "text", read_back(F.col("text")).alias("turns"),
        learned_text(F.col("text"), F.col("loss")).alias("learned"),
    )
    turns = F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n")))
    return read.select(
        "tree",
        F.size("turns").cast("long").alias("n_turns"),
        F.sha2(F.array_join(turns, ""), 256).alias("turns_sha256"),
        F.char_length("learned").cast("long").alias("loss_chars"),
        F.sha2("learned", 256).alias("loss_sha256"),
        F.char_length("text").cast("long").alias("formatted_chars"),
    )
