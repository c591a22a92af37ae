"""Line dedup by a segment-partition edit join, with DataFrame functions only.

A line of a text is dropped if the same line, or one within EDITS character edits of it, stands
earlier in the corpus (in the order of doc_id, then text, then line number). Blank lines are never
dropped, and lines under NEAR_CHARS characters only for an equal one.

Equal lines are one through a 128-bit hash. Each distinct line is cut into EDITS + 1 segments of
even length. Two lines within EDITS edits share at least one segment, at places that differ by no
more than the edits before and behind it allow. So a line is indexed under each of its segments
(with its length), and looked up under those substrings of it that can be a segment of a line of
the same or a smaller length. Lines that share no key go first. Of the rest, the lines of a key meet
its earliest lines, and those that are near none of them meet all earlier ones. A pair is let through
only if the character counts of the lines, and those of their beginnings of several lengths, differ by
at most two for each edit, and is verified on its texts with a banded bit-parallel edit distance.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from skymart.cluster import settle
from skymart.llm.arrow import fresh, named

EDITS = 2
NEAR_CHARS = 20
#: Groups of characters whose counts a signature holds, four bits each; others are not counted.
GROUPS = (*"aeinorst", "h", "dl", "cmu", "fgwy", "bjkpqvxz", "01234", "56789", " ,-.")
#: Lengths of a line's beginnings that have a signature each, besides the whole line.
BEGINNINGS = (24, 48, 96, 160, 240, 320, 416, 512)
#: Four bits for a count modulo 8: as many of them differ as the counts do, the short way round.
_RING = sum(code << 4 * k for k, code in enumerate((0, 1, 3, 7, 15, 14, 12, 8)))
#: Candidate lines are fetched by broadcasting their hashes up to this many (16 bytes each).
BROADCAST_LINES = 500_000
_BAND = 2 * EDITS + 1
_MASK = (1 << _BAND) - 1


def _lines(docs: DataFrame) -> DataFrame:
    """doc_id, body (a hash of the text), line_no from 0, line, its hashes h and g, and its size."""
    text = F.col("text").cast("string")
    bodies = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64(text).alias("body"), text.alias("text")
    )
    lines = bodies.select("doc_id", "body", F.posexplode(F.split("text", "\n")).alias("line_no", "line"))
    return lines.filter(F.length(F.trim("line")) > 0).select(
        "*",
        F.xxhash64("line").alias("h"),
        F.xxhash64(F.lit(1), "line").alias("g"),
        F.char_length("line").alias("size"),
    )


def _probes() -> list[tuple[int, int, int]]:
    """Missing characters, segment and shift of each substring that can be a segment."""
    found = []
    for missing in range(EDITS + 1):
        for number in range(EDITS + 1):
            behind = EDITS - number
            low, high = max(-number, missing - behind), min(number, missing + behind)
            found += [(missing, number, shift) for shift in range(low, high + 1)]
    return found


#: Places in _probes() of a line's own segments, under which it is indexed.
_OWN = [place for place, (missing, _, shift) in enumerate(_probes()) if missing == shift == 0]


def _keys(line: Column, length: Column) -> Column:
    """The hash of each of _probes(), as a segment of a line of that length.

    A line of NEAR_CHARS holds them all. They stand one by one, as plain expressions are compiled.
    """

    def key(missing: int, number: int, shift: int) -> Column:
        other = length - missing
        start, stop = (F.call_function("div", other * k, F.lit(EDITS + 1)).cast("int") for k in (number, number + 1))
        return F.xxhash64(F.lit(number), other, F.substring(line, start + (shift + 1), stop - start))

    return F.array(*[key(*probe) for probe in _probes()])


def _marked(line: Column) -> Column:
    """The line with a letter for each counted character, from A on, one for each of GROUPS."""
    marks = "".join(chr(ord("A") + k) * len(group) for k, group in enumerate(GROUPS))
    letters = "".join(GROUPS)
    return F.translate(line, letters + letters.upper(), marks + marks)


def _signature(marked: Column) -> Column:
    """For each of BEGINNINGS and the whole line, counts of the GROUPS packed in one number.

    An edit changes two counts of a beginning by one at most: that of a character that comes in
    there, and that of one that goes or is moved across its end.
    """

    def counts(part: Column) -> Column:
        bits = []
        for k in range(len(GROUPS)):
            count = F.octet_length(part) - F.octet_length(F.replace(part, F.lit(chr(ord("A") + k)), F.lit("")))
            code = F.call_function("shiftright", F.lit(_RING), (count % 8 * 4).cast("int"))
            bits.append(F.shiftleft(code.cast("long").bitwiseAND(F.lit(15).cast("long")), 4 * k))
        return reduce(lambda a, b: a.bitwiseOR(b), bits)

    return F.array(*[counts(F.substring(marked, 1, length)) for length in BEGINNINGS], counts(marked))


def _alike(a: Column, b: Column) -> Column:
    """Whether these signatures leave room for EDITS edits; more of a line differs in longer beginnings."""
    places = reversed(range(len(BEGINNINGS) + 1))
    return reduce(lambda x, y: x & y, [F.bit_count(a[k].bitwiseXOR(b[k])) <= 2 * EDITS for k in places])


def _met(lines: DataFrame) -> DataFrame:
    """key, h and own of the lines that share a key with another line, which is a segment of one of them."""
    long = lines.filter(F.col("size") >= NEAR_CHARS)
    # Equal lines are one before their keys are dealt. The outer form of explode keeps Spark from
    # testing the arrays in a filter below, which would make them twice.
    keys = long.select("h", _keys(F.col("line"), F.col("size")).alias("keys")).distinct()
    dealt = keys.select("h", F.posexplode_outer("keys").alias("place", "key"))
    dealt = dealt.select("key", "h", F.col("place").isin(_OWN).alias("own"))
    group = Window.partitionBy("key")
    several = F.min("h").over(group) < F.max("h").over(group)
    marked = dealt.select("*", several.alias("several"), F.max("own").over(group).alias("any"))
    found = marked.filter(F.col("several") & F.col("any"))
    return found.groupBy("key", "h").agg(F.max("own").alias("own"))


def edit_distance(long: Column, short: Column) -> Column:
    """Edits between two lines, exact up to EDITS and more than EDITS beyond.

    long has up to EDITS characters more. Column i of the table of distances is held on a band of
    rows i - EDITS to i + EDITS, as bits of vertical steps up (vp) and down (vn); the distance is
    followed along the diagonal that ends at the last characters.
    """
    # A one-element array binds what is read at every step, so that it is computed once.
    both = F.struct(F.split(long, "").alias("rows"), F.split(short, "").alias("columns"))
    return F.transform(F.array(both), lambda x: _banded(x["rows"], x["columns"]))[0]


def _banded(rows: Column, columns: Column) -> Column:
    ahead = F.size(rows) - F.size(columns)

    def band(vector: Column) -> Column:
        return vector.bitwiseAND(F.lit(_MASK))

    def other(vector: Column) -> Column:
        return vector.bitwiseXOR(F.lit(_MASK))

    def matches(column: Column) -> Column:
        own = F.get(columns, column)
        bits = [
            F.when(F.get(rows, column + (k - EDITS)) == own, 1 << k).otherwise(0)
            for k in range(_BAND)
        ]
        return reduce(lambda a, b: a + b, bits)

    def first(state: Column, column: Column) -> Column:
        """The state and the vector d of rows that equal their upper left neighbour."""
        x, vp, vn = matches(column), state["vp"], state["vn"]
        return F.struct(
            vp.alias("vp"),
            vn.alias("vn"),
            state["edits"].alias("edits"),
            band((x.bitwiseAND(vp) + vp).bitwiseXOR(vp).bitwiseOR(x).bitwiseOR(vn)).alias("d"),
        )

    def second(state: Column) -> Column:
        vp, vn, d = state["vp"], state["vn"], state["d"]
        hp, hn = vn.bitwiseOR(other(d.bitwiseOR(vp))), d.bitwiseAND(vp)
        below = F.shiftright(d, 1)
        step = 1 - F.call_function("getbit", d, ahead + EDITS)
        return F.struct(
            hn.bitwiseOR(other(below.bitwiseOR(hp))).alias("vp"),
            below.bitwiseAND(hp).alias("vn"),
            (state["edits"] + step).cast("int").alias("edits"),
        )

    def step(state: Column, column: Column) -> Column:
        return F.transform(F.array(first(state, column)), second)[0]

    begin = F.struct(
        F.lit(_MASK ^ ((1 << EDITS) - 1)).alias("vp"),
        F.lit(0).alias("vn"),
        ahead.cast("int").alias("edits"),
    )
    places = F.sequence(F.lit(0), F.size(columns) - 1)
    return F.aggregate(places, begin, step, lambda s: s["edits"])


def _pair(one: str, two: str) -> list[Column]:
    """later and earlier of two lines."""
    a, b = F.col(one), F.col(two)
    swap = a["place"] < b["place"]
    return [F.when(swap, b).otherwise(a).alias("later"), F.when(swap, a).otherwise(b).alias("earlier")]


def _close(one: str, two: str) -> Column:
    """Whether sizes and letters of two different lines leave room for EDITS edits."""
    a, b = F.col(one), F.col(two)
    other = (a["h"] != b["h"]) | (a["g"] != b["g"])
    return other & (F.abs(a["size"] - b["size"]) <= EDITS) & _alike(a["of"], b["of"])


def _linked(pairs: DataFrame, texts: DataFrame) -> DataFrame:
    """h and g of the later line of each pair that is within EDITS edits."""
    ends = [F.col(f"{end}.{c}").alias(f"{end}_{c}") for end in ("later", "earlier") for c in ("h", "g")]
    pairs = pairs.select(*ends).distinct()
    for end in ("later", "earlier"):
        own = texts.select(*[F.col(c).alias(f"{end}_{c}") for c in ("h", "g", "line")])
        pairs = pairs.join(own, [f"{end}_h", f"{end}_g"])
    # Few rows with much work each: dealt anew, as their bytes alone would go to few tasks. They are
    # written, as their check would else move in front of the dealing.
    tasks = int(texts.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    pairs = settle(pairs.repartition(tasks, "later_h", "earlier_h"))
    one, two = F.col("later_line"), F.col("earlier_line")
    swap = F.char_length(one) < F.char_length(two)
    long, short = F.when(swap, two).otherwise(one), F.when(swap, one).otherwise(two)
    linked = pairs.filter(edit_distance(long, short) <= EDITS)
    return linked.select(F.col("later_h").alias("h"), F.col("later_g").alias("g")).distinct()


def _near(lines: DataFrame) -> DataFrame:
    """h and g of the lines that an earlier line within EDITS edits makes superfluous.

    One earlier line is enough. So the lines of a key first meet its earliest ones and its most
    frequent one, and only those that are near no earlier of them meet all earlier lines of their keys.
    """
    met = settle(_met(lines))
    wanted = settle(met.select("h").distinct())
    wanted = F.broadcast(wanted) if wanted.count() <= BROADCAST_LINES else wanted
    place = F.struct(F.col("doc_id"), F.col("body"), F.col("line_no"))
    texts = lines.join(wanted, "h", "left_semi").groupBy("h", "g", "line")
    texts = settle(texts.agg(F.min(place).alias("place"), F.count("*").alias("times")))
    marked = texts.withColumn("size", F.char_length("line")).withColumn("marked", _marked(F.col("line")))
    known = marked.select("h", "times", F.struct("place", "h", "g", "size", _signature(F.col("marked")).alias("of")).alias("me"))
    members = settle(met.join(known, "h").select("key", "own", "times", "me"))

    firsts = members.groupBy("key").agg(
        F.min(F.when(F.col("own"), F.col("me"))).alias("indexed"),
        F.min("me").alias("first"),
        F.max(F.when(F.col("own"), F.struct("times", "me")))["me"].alias("common"),
    )
    firsts = settle(firsts)
    heads = members.join(firsts, "key")
    pairs = heads.filter(_close("me", "indexed")).select(*_pair("me", "indexed"))
    pairs = pairs.union(heads.filter(F.col("own") & _close("me", "first")).select(*_pair("me", "first")))
    pairs = pairs.union(heads.filter(_close("me", "common")).select(*_pair("me", "common")))
    gone = settle(_linked(pairs, texts))

    ids = (F.col("me.h") == F.col("h")) & (F.col("me.g") == F.col("g"))
    left = members.join(gone, ids, "left_anti").join(firsts, "key")
    left = left.select(F.col("key").alias("of_key"), F.col("own").alias("open"), F.col("me").alias("one"), "indexed", "first", "common")
    one, me = F.col("one"), F.col("me")

    def same(name: str) -> Column:
        other = F.col(name)
        return F.coalesce((me["h"] == other["h"]) & (me["g"] == other["g"]), F.lit(False))

    # What has met before: two indexed lines, and of an indexed one the earliest line.
    done = same("indexed") | same("common") | (F.col("open") & same("first"))
    earlier = (F.col("open") | F.col("own")) & _close("one", "me") & (me["place"] < one["place"]) & ~done
    pairs = left.join(members, (F.col("of_key") == F.col("key")) & earlier)
    pairs = pairs.select(one.alias("later"), me.alias("earlier"))
    return gone.union(_linked(pairs, texts)).distinct()


def dropped_lines(docs: DataFrame) -> DataFrame:
    """doc_id, body and dropped: the numbers of the lines that go, of documents that lose any."""
    lines = _lines(docs)
    place = F.struct("doc_id", "body", "line_no")
    repeated = lines.groupBy("h", "g").agg(F.count("*").alias("times"), F.min(place).alias("first"))
    near = _near(lines).withColumn("near", F.lit(True))
    gone = repeated.join(near, ["h", "g"], "left").filter((F.col("times") > 1) | F.col("near"))
    gone = gone.select("h", "g", "first", F.coalesce("near", F.lit(False)).alias("near"))
    lost = lines.select("doc_id", "body", "line_no", "h", "g").join(gone, ["h", "g"])
    lost = lost.filter(F.col("near") | ~F.struct("doc_id", "body", "line_no").eqNullSafe(F.col("first")))
    return lost.groupBy("doc_id", "body").agg(
        F.sort_array(F.collect_set("line_no")).alias("dropped")
    )


def _with_dropped(
    rows: DataFrame, dropped: DataFrame, doc_id: Column, body: Column
) -> tuple[DataFrame, Column]:
    """rows with the numbers of their dropped lines in a column of a name that no table has."""
    of, own_body, numbers = fresh("of", "body", "dropped")
    own = dropped.select(F.col("doc_id").alias(of), F.col("body").alias(own_body), F.col("dropped").alias(numbers))
    same = doc_id.cast("long").eqNullSafe(F.col(of)) & (body == F.col(own_body))
    return rows.join(own, same, "left").drop(of, own_body), F.col(numbers)


def line_report(docs: DataFrame) -> DataFrame:
    """doc_id, n_lines, n_dropped and dropped (line numbers from 0) of every row of docs.

    A null text has no line, an empty one has one blank line. Rows with equal doc_id and text are
    one document: lines within it are compared, but its repetition drops nothing. Among documents
    of one doc_id the order is that of a hash of their texts, and a null doc_id comes first. No
    rows give none; columns other than doc_id and text are not read.
    """
    text = F.col("text").cast("string")
    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.xxhash64(text).alias("body"),
        F.coalesce(F.size(F.split(text, "\n")), F.lit(0)).alias("n_lines"),
    )
    found, numbers = _with_dropped(rows, dropped_lines(docs), F.col("doc_id"), F.col("body"))
    lost = F.coalesce(numbers, F.array().cast("array<int>"))
    return found.select("doc_id", F.when(F.col("n_lines") < 0, 0).otherwise(F.col("n_lines")).alias("n_lines"), F.size(lost).alias("n_dropped"), lost.alias("dropped"))


def without_repeats(docs: DataFrame) -> DataFrame:
    """docs, with all their columns, whose texts have lost the dropped lines. Null texts stay null."""
    text = F.col("text").cast("string")
    found, numbers = _with_dropped(docs, dropped_lines(docs), F.col("doc_id"), F.xxhash64(text))
    kept = F.filter(F.split(text, "\n"), lambda _, place: ~F.array_contains(numbers, place))
    rebuilt = F.when(numbers.isNull(), text).otherwise(F.array_join(kept, "\n"))
    return found.select(*[rebuilt.alias(c) if c == "text" else named(c) for c in docs.columns])
