"""Personal data by candidate gradient boosting, with DataFrame functions only.

Rules give the base spans (e-mail addresses, IPv4 addresses, card and phone numbers). Generators
of high recall propose further, overlapping spans. Boosted trees score each candidate by its
format and its surroundings, and those that pass their kind's check and the calibrated threshold of their kind
join the base spans, where they overlap none of them and no better candidate. So numbers that the rules lose
because they stand side by side are found, and decoys are left alone.

The trees learn from every candidate of the corpus, labelled by the rules' checks applied to the
candidate alone; every fourth (by its hash) is kept for calibration. Candidates with equal features
are one row with their number, so only those rows are shuffled, and trees and thresholds come from
all of them; kinds and labels are balanced by weights. The fitted trees become one SQL expression,
so spans are found row by row: nothing is shuffled and each text is read whole.

Patterns are written so that Java matches them in linear time and without recursion: separators
that the rules allow are marked first, then a run is a loop over one character class.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.ml.classification import GBTClassificationModel, GBTClassifier
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from skymart.cluster import settle

KINDS = ("email", "ip", "card", "phone")
#: Weight that the training candidates of a kind and label have together, if they are more than that.
BALANCE = 1_875
#: A leaf holds at least so much weight, as far as that is less than LEAST_SHARE of all.
LEAST_WEIGHT, LEAST_SHARE = 3.0, 0.1
#: Values of a feature up to which the trees may split between any two of them.
VALUES = 512
#: Rows of equal candidates that a task learns from.
TASK_VECTORS = 50_000
#: Steps of a margin of one that thresholds tell apart.
MARGIN_STEPS = 1024
#: A kind with fewer right candidates in its calibration part is accepted from even odds on.
FEW = 10
#: Least share of right candidates beyond a kind's threshold, on the calibration part.
PRECISION = 0.98
ROUNDS, DEPTH = 12, 3

#: Two private-use characters that mark a separator inside a number or domain.
DIGIT_LINK, LABEL_LINK = "\ue000", "\ue001"
_LABEL, _LOCAL = "A-Za-z0-9\\-", "A-Za-z0-9._%+\\-" + LABEL_LINK
_EMAIL = (
    f"(?:(?<![{_LOCAL}])|\\G)[{_LOCAL}]++@[{_LABEL}]++{LABEL_LINK}[{_LABEL}{LABEL_LINK}]+"
)
_IP = r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]+"
_CARD = f"[0-9{DIGIT_LINK}]{{2,}}"
_PHONE = r"\+[0-9][\x20().0-9\-]+[0-9]"
#: Candidate patterns: those that match side by side, and those that match nothing and look ahead,
#: so that every start of a group of digits is tried with every end (one for each number of digits)
#: and candidates of a kind overlap. No two patterns propose the same span.
_PROPOSALS = {
    "email": [r"(?<!\S)\S{1,64}@\S{1,255}"],
    "ip": [r"(?<![0-9.])[0-9]{1,4}(?:\.[0-9]{1,4}){2,4}(?![0-9])"],
}
_AHEAD = {
    "card": [rf"(?<![0-9])(?=([0-9](?:[ \-]?[0-9]){{{n - 1}}})(?![0-9]))" for n in range(12, 21)],
    "phone": [rf"(?=(\+[0-9](?:[\x20().\-]*+[0-9]){{{n - 1}}})(?![0-9]))" for n in range(8, 17)],
}
#: Card numbers as they are usually written; all groups have one separator.
_USUAL_CARD = (
    r"^[0-9]+$|^[0-9]{4}([ \-])(?:[0-9]{4}\1[0-9]{4}\1[0-9]{4}(?:\1[0-9]{3})?|[0-9]{6}\1[0-9]{4,5})$"
    r"|^[0-9]{6}[ \-][0-9]{13}$"
)
_CONTEXT = (
    r"(?i)\b(?:e-?mail|correo|courriel|tel|phone|call|fax|anruf|telefon|card|karte|carte|tarjeta"
    r"|visa|host|server|address|adresse|ip)\b"
)
_CONTEXT_CHARS = 24
_LIKE_EMAIL = r"^[^@]*[\p{L}0-9][^@]*@[^@]*[\p{L}0-9]\.\p{L}{2}"
FEATURES = (
    "kind", "length", "digits", "letters", "separators", "plus", "checksum", "octets", "number",
    "domain", "before", "after", "context", "usual",
)
_SPANS = "array<struct<kind:int,start:int,stop:int>>"
_CANDIDATES = (
    "array<struct<kind:int,start:int,stop:int,found:string,before:string,after:string>>"
)
#: Matches whose places are summed up at once.
BLOCK = 256
#: Characters of a place where chosen spans are looked for.
PLACE = 64


def _nothing() -> Column:
    return F.array().cast("array<struct<start:int,stop:int,found:string>>")


def _let(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with a value that is computed once, however often it is used."""
    return F.transform(F.array(value), use)[0]


def _placed(gaps: Column, found: Column, begin: int, wide: bool) -> Column:
    """start, stop and found of each match, from the characters between them.

    Running sums in blocks: an array that grows match by match would be copied as often. With
    ``wide`` matches take the place of their characters, else they only look ahead.
    """
    steps = F.arrays_zip(F.slice(gaps, F.lit(1), F.size(found)).alias("gap"), found.alias("found"))

    def ahead(step: Column) -> Column:
        return step["gap"] + F.char_length(step["found"]) if wide else step["gap"]

    def put(state: Column, step: Column) -> Column:
        start = state["at"] + step["gap"]
        stop = start + F.char_length(step["found"])
        match = F.struct(start.alias("start"), stop.alias("stop"), step["found"].alias("found"))
        at = (stop if wide else start).alias("at")
        return F.struct(F.concat(state["all"], F.array(match)).alias("all"), at)

    def all_of(block: Column) -> Column:
        first = F.struct(_nothing().alias("all"), block["at"].alias("at"))
        return F.aggregate(block["steps"], first, put, lambda state: state["all"])

    def sums(blocks: Column) -> Column:
        none = F.array().cast("array<struct<at:int,steps:array<struct<gap:int,found:string>>>>")
        first = F.struct(none.alias("all"), F.lit(begin).alias("at"))

        def add(state: Column, block: Column) -> Column:
            own = F.struct(state["at"].alias("at"), block.alias("steps"))
            size = F.aggregate(block, F.lit(0), lambda total, step: total + ahead(step))
            return F.struct(F.concat(state["all"], F.array(own)).alias("all"), (state["at"] + size).alias("at"))

        return F.aggregate(blocks, first, add, lambda state: state["all"])

    def blocks(steps: Column) -> Column:
        last = F.floor((F.greatest(F.size(steps), F.lit(1)) - 1) / BLOCK).cast("int")
        return F.transform(F.sequence(F.lit(0), last), lambda b: F.slice(steps, b * BLOCK + 1, F.lit(BLOCK)))

    return F.flatten(F.transform(sums(_let(steps, blocks)), all_of))


def _matches(text: Column, pattern: str) -> Column:
    """start, stop (code points, end exclusive) and found of each match, from left to right."""
    gaps = F.transform(F.split(text, pattern, -1), F.char_length)
    found = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    return _let(found, lambda f: _placed(gaps, f, 0, True))


def _ahead(text: Column, pattern: str) -> Column:
    """What _matches gives, for a pattern that matches nothing and looks ahead at its group."""
    # A match of no width ends a gap only behind the first character.
    text = F.concat(F.lit(" "), text)
    gaps = F.transform(F.split(text, pattern, -1), F.char_length)
    found = F.regexp_extract_all(text, F.lit(pattern), F.lit(1))
    return _let(found, lambda f: _placed(gaps, f, -1, False))


def _digits(found: Column) -> Column:
    return F.regexp_replace(found, "[^0-9]", "")


def _octets(found: Column) -> Column:
    """Four numbers of at most 255."""
    parts = F.split(found, "\\.")
    small = F.forall(
        parts,
        lambda p: p.rlike("^0*[0-9]{1,3}$") & (F.right(p, F.lit(3)).cast("int") <= 255),
    )
    return (F.size(parts) == 4) & small


def _checksum(found: Column) -> Column:
    digits = _digits(found)
    return F.char_length(digits).between(13, 19) & F.call_function("luhn_check", digits)


def _number(found: Column) -> Column:
    return F.char_length(_digits(found)).between(9, 15)


def _linked(text: Column, mark: str, pattern: str) -> Column:
    return F.regexp_replace(F.replace(text, F.lit(mark), F.lit("?")), pattern, mark)


def _passing(matches: Column, check: Callable[[Column], Column]) -> Column:
    return F.filter(matches, lambda m: check(m["found"]))


def _base(text: Column) -> list[Column]:
    """The base matches of each kind."""
    at = F.contains(text, F.lit("@"))
    some = text.rlike("[0-9]{2}|[0-9][ .\\-][0-9]")
    domains = _linked(text, LABEL_LINK, f"(?<=[{_LABEL}])\\.(?=[{_LABEL}])")
    numbers = _linked(text, DIGIT_LINK, r"(?<=[0-9])[ \-](?=[0-9])")
    checked: list[tuple[Column, Column, str, Callable[[Column], Column] | None]] = [
        (at, domains, _EMAIL, None),
        (some, text, _IP, _octets),
        (some, numbers, _CARD, _checksum),
        (F.contains(text, F.lit("+")), text, _PHONE, _number),
    ]
    result = []
    for needed, where, pattern, check in checked:
        matches = _matches(where, pattern)
        if check:
            matches = _passing(matches, check)
        result.append(F.when(needed, matches).otherwise(_nothing()))
    return result


def _of(kind: int, matches: Column) -> Column:
    return F.transform(
        matches,
        lambda m: F.struct(
            F.lit(kind).alias("kind"),
            m["start"].alias("start"),
            m["stop"].alias("stop"),
            m["found"].alias("found"),
        ),
    )


_CHECKS: list[Callable[[Column], Column]] = [
    lambda found: found.rlike(_LIKE_EMAIL), lambda found: _octets(found),
    lambda found: _checksum(found), lambda found: _number(found),
]


def _proposed(text: Column, likely: bool) -> Column:
    """kind, start, stop, found, before and after of candidates; only those that pass if ``likely``.

    The surroundings are cut from four bytes for each code point, without a look at what is before them.
    """
    digits = text.rlike("[0-9]{4}|[0-9][.][0-9]|[+][0-9]|[0-9][ \\-][0-9]")
    needed = F.contains(text, F.lit("@")) | digits
    lists = []
    for kind, name in enumerate(KINDS):
        own = [_matches(text, pattern) for pattern in _PROPOSALS.get(name, [])]
        own += [_ahead(text, pattern) for pattern in _AHEAD.get(name, [])]
        lists += [_of(kind, _passing(m, _CHECKS[kind]) if likely else m) for m in own]

    def cut(wide: Column, begin: Column, stop: Column) -> Column:
        part = F.substring(wide, begin * 4 + 1, (stop - begin) * 4)
        return F.decode(F.concat(F.unhex(F.lit("0000FEFF")), part), "UTF-32")

    def surrounded(wide: Column) -> Column:
        return F.transform(
            F.concat(*lists),
            lambda m: F.struct(
                m["kind"].alias("kind"),
                m["start"].alias("start"),
                m["stop"].alias("stop"),
                m["found"].alias("found"),
                cut(wide, F.greatest(m["start"] - _CONTEXT_CHARS, F.lit(0)), m["start"]).alias("before"),
                cut(wide, m["stop"], m["stop"] + 1).alias("after"),
            ),
        )

    every = _let(F.encode(text, "UTF-32"), surrounded)
    return F.coalesce(F.when(needed, every), F.array().cast(_CANDIDATES))


def _features(match: Column) -> Column:
    found, before, after = match["found"], match["before"], match["after"]
    digits, letters = _digits(found), F.regexp_replace(found, r"[^\p{L}]", "")
    length = F.char_length(found)
    values = [
        match["kind"],
        length,
        F.char_length(digits),
        F.char_length(letters),
        length - F.char_length(digits) - F.char_length(letters),
        found.startswith("+"),
        _checksum(found),
        _octets(found),
        _number(found),
        found.rlike(_LIKE_EMAIL),
        F.right(before, F.lit(1)).rlike(r"[\p{L}0-9+.\-]"),
        after.rlike(r"[\p{L}0-9]"),
        before.rlike(_CONTEXT),
        found.rlike(_USUAL_CARD),
    ]
    return F.array(*[F.coalesce(v.cast("double"), F.lit(0.0)) for v in values])


def _feature(features: Column, name: str) -> Column:
    return features[FEATURES.index(name)]


def _tree(node, features: Column) -> Column:
    """A fitted tree as nested conditions."""
    if node.subtreeDepth() == 0:
        return F.lit(float(node.prediction()))
    split = node.split()
    return F.when(
        features[split.featureIndex()] <= F.lit(float(split.threshold())),
        _tree(node.leftChild(), features),
    ).otherwise(_tree(node.rightChild(), features))


class Scorer:
    """Fitted trees and the threshold of each kind; without trees usual forms are accepted."""

    def __init__(self, model: GBTClassificationModel | None, thresholds: list[float]) -> None:
        self.model, self.thresholds = model, thresholds

    def score(self, features: Column) -> Column:
        """The margin of the trees: positive for likely personal data."""
        if self.model is None:
            usual = (_feature(features, "kind") != 2) | (_feature(features, "usual") == 1)
            return usual.cast("double") - 0.5
        parts = [
            F.lit(float(weight)) * _tree(tree._call_java("rootNode"), features)
            for tree, weight in zip(self.model.trees, self.model.treeWeights, strict=True)
        ]
        total = parts[0]
        for part in parts[1:]:
            total = total + part
        return total

    def accepted(self, kind: Column, score: Column) -> Column:
        return score >= F.element_at(F.array(*map(F.lit, self.thresholds)), kind + 1)


def _counted(docs: DataFrame) -> DataFrame:
    """kind, label, held, features and times of all candidates; held ones are kept for calibration."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    candidates = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.explode(_proposed(text, False)).alias("c")
    )
    passes = F.coalesce(*[F.when(F.col("c.kind") == k, f(F.col("c.found"))) for k, f in enumerate(_CHECKS)])
    usual = (F.col("c.kind") != 2) | F.col("c.found").rlike(_USUAL_CARD)
    order = F.xxhash64("doc_id", "c.kind", "c.start", "c.stop")
    vectors = candidates.select(
        F.col("c.kind").alias("kind"),
        (passes & usual).cast("double").alias("label"),
        (order % 4 == 0).alias("held"),
        _features(F.col("c")).alias("features"),
    )
    return vectors.groupBy("kind", "label", "held", "features").agg(F.count("*").alias("times"))


def fit(docs: DataFrame) -> Scorer | None:
    """Learn from all candidates of all texts; None without any.

    Rows of equal candidates stay with the tasks: the driver gets the counts of kinds and labels, the
    trees, and the counts of each kind's margins in steps. (Beyond VALUES ** 2 rows the places where
    the trees may split are found by Spark's learner from so many of them; it weighs all rows.)
    """
    vectors = settle(_counted(docs))
    totals = vectors.groupBy("kind", "label").agg(
        F.count("*").alias("rows"), F.sum(F.when(~F.col("held"), F.col("times"))).alias("train")
    ).collect()
    if not totals:
        return None
    trained = {(r.kind, r.label): r.train for r in totals if r.train}
    if len({label for _, label in trained}) < 2:
        return Scorer(None, [0.0] * len(KINDS))
    weight = F.coalesce(
        *[
            F.when((F.col("kind") == kind) & (F.col("label") == label), F.lit(min(1.0, BALANCE / times)))
            for (kind, label), times in sorted(trained.items())
        ]
    )
    # Dealt by their values and sorted, so that equal tables give equal trees.
    tasks = max(2, -(-sum(r.rows for r in totals) // TASK_VECTORS))
    vectors = vectors.repartition(tasks, "kind", "features").sortWithinPartitions("kind", "features", "label", "held")
    vectors = vectors.withColumn("weight", F.col("times") * weight)
    vectors = vectors.withColumn("features", array_to_vector("features"))
    least = LEAST_WEIGHT / sum(min(BALANCE, times) for times in trained.values())
    model = GBTClassifier(
        maxIter=ROUNDS, maxDepth=DEPTH, seed=1, weightCol="weight", maxBins=VALUES,
        minWeightFractionPerNode=min(LEAST_SHARE, least),
    ).fit(vectors.filter(~F.col("held")))
    judged = model.transform(vectors.filter("held"))
    # A model's raw prediction for a class is twice the margin of its trees.
    step = F.floor(vector_to_array("rawPrediction")[1] / 2 * MARGIN_STEPS).alias("step")
    judged = judged.groupBy("kind", "label", step).agg(F.sum("times").alias("times")).collect()
    return Scorer(
        model,
        [
            _threshold([(r.step / MARGIN_STEPS, r.label, float(r.times)) for r in judged if r.kind == k])
            for k in range(len(KINDS))
        ],
    )


def _threshold(judged: list[tuple[float, float, float]]) -> float:
    """The lowest margin from which on the share of right candidates is PRECISION at least.

    judged are margins, labels and weights; with FEW right ones it is even odds.
    """
    if sum(weight for _, label, weight in judged if label == 1.0) < FEW:
        return 0.0
    best, right, every = float("inf"), 0.0, 0.0
    ordered = sorted(judged, reverse=True)
    for place, (margin, label, weight) in enumerate(ordered):
        every += weight
        right += weight * (label == 1.0)
        last = place + 1 == len(ordered) or ordered[place + 1][0] < margin
        if last and right >= PRECISION * every:
            best = margin
    return best


def _overlap(a: Column, b: Column) -> Column:
    return (a["start"] < b["stop"]) & (b["start"] < a["stop"])


def _spans(kind: int, matches: Column) -> Column:
    return F.transform(
        matches,
        lambda m: F.struct(
            F.lit(kind).alias("kind"), m["start"].alias("start"), m["stop"].alias("stop")
        ),
    )


def _of_kind(spans: str, kind: int) -> Column:
    return F.filter(spans, lambda s: s["kind"] == kind)


def _last_before(starts: Column, place: Column) -> Column:
    """How many of the sorted starts lie before a place, by halving."""

    def halve(state: Column, _: Column) -> Column:
        middle = F.floor((state["low"] + state["high"]) / 2).cast("int")
        before = F.coalesce(F.get(starts, middle) < place, F.lit(False))
        open_ = state["low"] < state["high"]
        return F.struct(
            F.when(open_ & before, middle + 1).otherwise(state["low"]).alias("low"),
            F.when(open_ & ~before, middle).otherwise(state["high"]).alias("high"),
        )

    begin = F.struct(F.lit(0).alias("low"), F.size(starts).alias("high"))
    steps = F.sequence(F.lit(1), F.floor(F.log2(F.size(starts) + 1.0)).cast("int") + 1)
    return F.aggregate(steps, begin, halve, lambda state: state["low"])


def _of_kinds(base: Column) -> Column:
    """Starts and stops of the base spans of each kind, which are sorted and don't overlap."""

    def own(kind: int) -> Column:
        return _let(
            F.filter(base, lambda b: b["kind"] == kind),
            lambda spans: F.struct(
                F.transform(spans, lambda b: b["start"]).alias("starts"),
                F.transform(spans, lambda b: b["stop"]).alias("stops"),
            ),
        )

    return F.array(*[own(kind) for kind in range(len(KINDS))])


def _free(kinds: Column, candidate: Column) -> Column:
    """Whether a candidate overlaps no base span: none that starts before its end ends behind its start."""

    def meets(own: Column) -> Column:
        last = _last_before(own["starts"], candidate["stop"]) - 1
        return F.coalesce(F.get(own["stops"], last) > candidate["start"], F.lit(False))

    return ~F.exists(kinds, meets)


def _best(candidates: Column, first: Column, end: Column) -> Column:
    """Best first; a candidate that overlaps one chosen before it is left out.

    The chosen lie in places of PLACE characters from ``first`` to ``end``, each in all that it covers, so
    that a candidate meets those of its own places only.
    """
    none = F.array().cast(_SPANS)

    def put(kept: Column, c: Column) -> Column:
        begin = F.floor((c["start"] - first) / PLACE).cast("int")
        count = F.floor((c["stop"] - 1 - first) / PLACE).cast("int") - begin + 1
        own = F.slice(kept, begin + 1, count)
        span = F.array(F.struct(c["kind"], c["start"], c["stop"]).cast(_SPANS[6:-1]))
        added = F.concat(
            F.slice(kept, F.lit(1), begin),
            F.transform(own, lambda place: F.concat(place, span)),
            F.slice(kept, begin + count + 1, F.size(kept)),
        )
        taken = F.exists(own, lambda place: F.exists(place, lambda k: _overlap(k, c)))
        return F.when(taken, kept).otherwise(added)

    places = F.array_repeat(none, F.floor((end - 1 - first) / PLACE).cast("int") + 1)
    kept = F.aggregate(F.array_sort(candidates), places, put)

    def of_place(place: Column, at: Column) -> Column:
        return F.filter(place, lambda k: F.floor((k["start"] - first) / PLACE) == at)

    return F.flatten(F.transform(kept, of_place))


def find(docs: DataFrame, scorer: Scorer | None) -> DataFrame:
    """doc_id, base and spans of every whole text: arrays of kind (index in KINDS), start, stop.

    A null or empty text has no spans. Candidates that tie in score go to the one that starts
    first, then to the longer, then to the kind listed first. Repeated rows get equal spans; other
    columns are not read; no rows give none. Without a scorer spans are the base spans.

    Candidates are chosen among those that overlap, directly or through others, one such group at a
    time; so the time is in proportion to the text, however many candidates it has.
    """
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text.alias("text"))
    base = [_spans(kind, matches) for kind, matches in enumerate(_base(F.col("text")))]
    base = F.concat(*base).cast(_SPANS)
    if scorer is None:
        return rows.select("doc_id", base.alias("base")).withColumn("spans", F.col("base"))
    scored = F.transform(
        _proposed(F.col("text"), True),
        lambda c: _let(
            _features(c),
            lambda features: F.struct(
                (-scorer.score(features)).alias("rank"),
                c["start"].alias("start"),
                (-c["stop"]).alias("longest"),
                c["kind"].alias("kind"),
                c["stop"].alias("stop"),
            ),
        ),
    )
    likely = F.filter(scored, lambda c: scorer.accepted(c["kind"], -c["rank"]))
    fresh = _let(_of_kinds(F.col("base")), lambda kinds: F.filter(likely, lambda c: _free(kinds, c)))
    found = rows.withColumn("base", base)
    found = settle(
        found.select(F.monotonically_increasing_id().alias("row"), "doc_id", "base", fresh.alias("fresh"))
    )
    several = found.filter(F.size("fresh") > 1).select("row", F.inline("fresh"))
    before = Window.partitionBy("row").orderBy("start", "stop", "kind")
    reached = F.max("stop").over(before.rowsBetween(Window.unboundedPreceding, -1))
    several = several.withColumn("apart", F.coalesce(F.col("start") >= reached, F.lit(True)))
    several = several.withColumn("group", F.count_if("apart").over(before))
    own = F.collect_list(F.struct("rank", "start", "longest", "kind", "stop")).alias("own")
    groups = several.groupBy("row", "group").agg(own, F.min("start").alias("first"), F.max("stop").alias("end"))
    groups = groups.select("row", _best(F.col("own"), F.col("first"), F.col("end")).alias("best"))
    chosen = groups.groupBy(F.col("row").alias("of")).agg(F.flatten(F.collect_list("best")).alias("best"))
    whole = found.join(chosen, F.col("row") == F.col("of"), "left")
    best = F.coalesce("best", _spans_of("fresh"))
    return whole.select("doc_id", "base", F.array_sort(F.concat("base", best)).alias("spans"))


def _spans_of(candidates: str) -> Column:
    return F.transform(
        candidates,
        lambda c: F.struct(c["kind"].alias("kind"), c["start"].alias("start"), c["stop"].alias("stop")),
    )


def listed(spans: Column) -> Column:
    """Spans as text: kind:start:end, by kind and start, with commas between."""
    names = F.array(*map(F.lit, KINDS))
    return F.array_join(
        F.transform(
            spans,
            lambda s: F.concat_ws(
                ":", F.element_at(names, s["kind"] + 1), s["start"].cast("string"), s["stop"].cast("string")
            ),
        ),
        ",",
    )


def digests(found: DataFrame) -> DataFrame:
    """doc_id, the number of base spans of each kind, the digest of their list, and all spans."""
    counts = [
        F.size(_of_kind("base", kind)).cast("long").alias(f"n_{name}")
        for kind, name in enumerate(KINDS)
    ]
    return found.select(
        "doc_id",
        *counts,
        F.sha2(listed(F.col("base")), 256).alias("base_sha256"),
        listed(F.col("spans")).alias("spans"),
    )
