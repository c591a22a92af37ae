"""Exact dedup, near duplicates and line dedup against brute force."""

from __future__ import annotations

import hashlib
import random
import re
from collections import Counter

import numpy as np
from pyspark.sql import functions as F

import corpus_pipeline
from skymart.llm import exact_dedup, line_dedup, mixing, shingle_join


def lowered(text: str | None) -> bytes:
    return (text or "").encode().lower()


def key(row) -> tuple:
    return tuple((x is not None, x) for x in row)


def test_exact_duplicates_keep_the_largest_id(corpus):
    docs, rows = corpus
    groups: dict[bytes, list] = {}
    for doc_id, text, _ in rows:
        groups.setdefault(lowered(text), []).append(doc_id)
    found = exact_dedup.exact_duplicates(docs, block_bytes=16).collect()
    assert len(found) == len(rows)
    texts: dict = {}
    for doc_id, text, _ in rows:
        texts.setdefault(hashlib.sha256(lowered(text)).hexdigest(), lowered(text))
    for row in found:
        own = groups[texts[row.text_sha256]]
        assert row.group_size == len(own)
        assert row.keep_id == max((i for i in own if i is not None), default=None)
        assert not row.kept or row.doc_id == row.keep_id
    assert Counter(r.text_sha256 for r in found if r.kept) == Counter(texts.keys())


def test_block_names_survive_equal_digests(spark, monkeypatch):
    """If digests collide, naming starts again with another seed."""

    class Weak:
        @staticmethod
        def xxh3_128_digest(block: bytes, seed: int) -> bytes:
            return hashlib.md5(block + bytes([seed])).digest() if seed else b"same"

    monkeypatch.setattr(exact_dedup, "xxhash", Weak)
    docs = spark.createDataFrame([(1, "a"), (2, "b"), (3, "A")], "doc_id long, text string")
    found = {r.doc_id: (r.keep_id, r.kept) for r in exact_dedup.exact_duplicates(docs).collect()}
    assert found == {1: (3, False), 2: (2, True), 3: (3, True)}


def components(rows) -> list[tuple]:
    sets = {}
    for doc_id, text, _ in rows:
        words = lowered(text).split()
        own = frozenset(tuple(words[k : k + 5]) for k in range(max(1, len(words) - 4))) if words else frozenset()
        sets[doc_id, text] = own
    nodes = list(sets)
    label = {n: n for n in nodes}

    def root(n):
        while label[n] != n:
            n = label[n]
        return n

    for i, a in enumerate(nodes):
        for b in nodes[:i]:
            x, y = sets[a], sets[b]
            if x and 100 * len(x & y) >= 80 * len(x | y):
                label[root(a)] = root(b)
    result = []
    for doc_id, text, _ in rows:
        ids = [n[0] for n in nodes if root(n) == root((doc_id, text)) and n[0] is not None]
        result.append((doc_id, len(sets[doc_id, text]), min(ids, default=None)))
    return sorted(result, key=key)


def test_near_duplicates_match_all_pairs(corpus):
    docs, rows = corpus
    found = [tuple(r) for r in shingle_join.near_duplicates(docs, chunk_docs=7).collect()]
    assert sorted(found, key=key) == components(rows)


def test_near_duplicates_in_a_large_group(spark, monkeypatch):
    """A chain of documents that changes little by little, so that its ends don't link."""
    monkeypatch.setattr(shingle_join, "SMALL_PIVOTS", 2)
    draw = random.Random(5)
    words = [f"w{draw.randrange(10_000)}" for _ in range(100)]
    rows = []
    for i in range(40):
        rows.append((i, " ".join(words), None))
        words[draw.randrange(100)] = f"n{i}"
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    found = [tuple(r) for r in shingle_join.near_duplicates(docs).collect()]
    assert sorted(found, key=key) == components(rows)


def test_near_duplicates_that_share_most_but_do_not_link(spark, monkeypatch):
    """Documents that differ from one text by two words each are in each other's lists, and are no pairs."""
    draw = random.Random(2)
    words = [f"w{k}" for k in range(100)]
    rows = []
    for i in range(60):
        own = list(words)
        for at in draw.sample(range(5, 95, 5), 2):
            own[at] = f"n{i}x{at}"
        rows.append((i, " ".join(own), None))
    rows += [(100, rows[7][1].replace("w99", "end"), None), (101, rows[30][1].replace("w0 ", "begin "), None)]
    met, linked = [], shingle_join._links
    monkeypatch.setattr(shingle_join, "_links", lambda pairs, sets: met.append(pairs.count()) or linked(pairs, sets))
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    found = [tuple(r) for r in shingle_join.near_duplicates(docs).collect()]
    assert sorted(found, key=key) == components(rows)
    assert sum(met) < 3 * len(rows)


def test_near_duplicates_meet_in_one_of_their_lists(spark, monkeypatch):
    """Near copies of one text share many lists, and copies of a pair share lists of the same members."""
    draw = random.Random(6)
    words = [f"w{k}" for k in range(300)]
    rows = []
    for i in range(50):
        own = list(words)
        for at in draw.sample(range(300), 4):
            own[at] = f"n{i}x{at}"
        rows.append((i, " ".join(own), None))
    for i in range(100, 130):
        own = [f"p{i}x{k}" for k in range(120)]
        rows += [(i, " ".join(own), None), (i + 100, " ".join(["new", *own[1:]]), None)]
    lists, members, passed, kept = [], [], [], shingle_join._one_of_equal
    pairs = shingle_join._pairs

    def one_of_equal(rows):
        found = kept(rows)
        lists.append((rows.select("list").distinct().count(), found.select("list").distinct().count()))
        members.extend(set(x.members) for x in found.groupBy("list").agg(F.collect_list("node").alias("members")).collect())
        return found

    def counted(live, heads):
        found = pairs(live, heads)
        passed.append((found.count(), found.distinct().count()))
        return found

    monkeypatch.setattr(shingle_join, "_one_of_equal", one_of_equal)
    monkeypatch.setattr(shingle_join, "_pairs", counted)
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    found = [tuple(r) for r in shingle_join.near_duplicates(docs).collect()]
    assert sorted(found, key=key) == components(rows)
    (before, after), = lists
    assert after < before / 2 and len({frozenset(x) for x in members}) == len(members) == after
    assert sum(n for n, _ in passed) <= 2 * sum(n for _, n in passed) < 10 * len(rows)


def test_bits_leave_room_for_every_link():
    """Sets that link differ in no more bits than shingles, and all their shingles but few are shared."""
    draw = np.random.default_rng(1)
    for size in (1, 4, 9, 90, 400, 3000):
        one = np.unique(draw.integers(0, 2**64, size, np.uint64))
        own = len(one) // 9 // 2
        other = np.concatenate([one[own:], draw.integers(0, 2**64, own, np.uint64)])
        bits = [np.array(shingle_join._bits(x)).view(np.uint64) for x in (one, other)]
        apart = sum(int(x).bit_count() for x in bits[0] ^ bits[1])
        assert len(bits[0]) == shingle_join.BITS // 64 and apart <= len(set(one.tolist()) ^ set(other.tolist()))
        if size == 90:
            assert apart > 0


def test_near_duplicates_of_chunks_without_words(spark):
    """Partitions of null and blank texts only, and an empty document left behind a full chunk."""
    rows = [(i, None if i % 3 else " \n ", None) for i in range(6)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string").repartition(2)
    found = [tuple(r) for r in shingle_join.near_duplicates(docs).collect()]
    assert sorted(found, key=key) == [(i, 0, i) for i in range(6)]
    rows = [(0, "one two", None), (1, "one two", None), (2, "", None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string").coalesce(1)
    found = [tuple(r) for r in shingle_join.near_duplicates(docs, chunk_docs=2).collect()]
    assert sorted(found, key=key) == components(rows)


def test_pipeline_over_a_partition_of_copies(spark):
    """Copies lose all their lines; a partition that holds nothing else has no words."""
    body = [f"document {i} tells of river number {i * 7919}" for i in range(10)]
    rows = [(i, body[i % 10], "s", 0) for i in range(60)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string, n_chars long")
    shorter = corpus_pipeline.lines(spark, docs, "").repartitionByRange(6, "doc_id")
    parts = shorter.groupBy(F.spark_partition_id()).agg(F.max(F.length("text")).alias("most"))
    assert 0 in {r.most for r in parts.collect()}
    kept = corpus_pipeline.near_duplicates(spark, shorter, "")
    assert sorted((r.doc_id, r.text) for r in kept.collect()) == sorted(
        (r.doc_id, r.text) for r in shorter.collect()
    )


def test_one_of_each_keeps_one_row_of_a_component(corpus):
    """Also of several rows of one doc_id, of which one text has copies and another has none."""
    docs, rows = corpus
    odd = {c: F.lit("x") for c in ("gone", "__id", "__at", "__dropped", "mix_slot", "a.b", "of", "body")}
    docs = docs.withColumns(odd)
    more = [(3, "a text without any copy at all"), (3, rows[8][1]), (900, "blank beside words"), (900, "")]
    more += [(901, "Same Words in other letters"), (901, "same words IN other letters"), (None, "alone without id")]
    extra = docs.sparkSession.createDataFrame(more, "doc_id long, text string").withColumn("source", F.lit("s"))
    docs = docs.unionByName(extra, allowMissingColumns=True)
    every = [(i, t) for i, t, *_ in rows] + more
    kept = shingle_join.one_of_each(docs)
    assert kept.columns == docs.columns
    found = Counter((r.doc_id, r.text) for r in kept.select("doc_id", "text").collect())
    # Components by brute force over texts, which stand for their rows.
    sets = [own_shingles(t) for _, t in every]
    label = list(range(len(every)))
    for i, one in enumerate(sets):
        for j in range(i):
            both = len(one & sets[j])
            if one and sets[j] and 100 * both >= 80 * len(one | sets[j]):
                old, new = label[i], label[j]
                label = [new if x == old else x for x in label]
    for component in set(label):
        members = [every[i] for i, x in enumerate(label) if x == component and sets[i]]
        if members:
            smallest = min((i for i, _ in members if i is not None), default=None)
            stays = [m for m in dict.fromkeys(members) if found[m]]
            assert len(stays) == 1 and stays[0][0] == smallest and found[stays[0]] == 1, members
    blank = Counter(row for row, own in zip(every, sets, strict=True) if not own)
    assert Counter({row: n for row, n in found.items() if not own_shingles(row[1])}) == blank


def own_shingles(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m.group().lower(), text or ""))
    if not words:
        return frozenset()
    return frozenset(tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4)))


def test_dedup_of_nothing(no_docs):
    assert exact_dedup.exact_duplicates(no_docs).count() == 0
    assert shingle_join.near_duplicates(no_docs).count() == 0
    assert line_dedup.line_report(no_docs).count() == 0


def distance(a: str, b: str) -> int:
    before = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        row = [i]
        for j, y in enumerate(b, 1):
            row.append(min(before[j] + 1, row[-1] + 1, before[j - 1] + (x != y)))
        before = row
    return before[-1]


def edited(draw: random.Random, line: str, times: int) -> str:
    chars = list(line)
    for _ in range(times):
        at = draw.randrange(len(chars))
        match draw.randrange(3):
            case 0:
                chars[at] = draw.choice("abé😀")
            case 1:
                chars.insert(at, draw.choice("abé"))
            case _ if len(chars) > 3:
                del chars[at]
    return "".join(chars)


def test_banded_edit_distance(spark):
    draw = random.Random(3)
    pairs = []
    for _ in range(1000):
        a = "".join(draw.choice("abé ") for _ in range(draw.randrange(5, 40)))
        b = edited(draw, a, draw.randrange(5))
        a, b = sorted((a, b), key=len, reverse=True)
        if len(a) - len(b) <= line_dedup.EDITS:
            pairs.append((a, b))
    frame = spark.createDataFrame(pairs, "a string, b string")
    for row in frame.withColumn("d", line_dedup.edit_distance(F.col("a"), F.col("b"))).collect():
        exact = distance(row.a, row.b)
        assert row.d == exact if exact <= line_dedup.EDITS else row.d > line_dedup.EDITS


def test_lines_match_all_pairs(spark):
    draw = random.Random(9)
    words = ["alpha", "beta", "gamma", "delta", "lorem", "ipsum", "é", "a"]
    base = [" ".join(draw.choice(words) for _ in range(draw.randrange(2, 9))) for _ in range(40)]
    rows: list[tuple] = []
    for i in range(90):
        lines = [draw.choice(base) for _ in range(draw.randrange(6))]
        lines = [edited(draw, x, draw.randrange(1, 5)) if draw.random() < 0.5 else x for x in lines]
        lines += [""] * (draw.random() < 0.2)
        rows.append((i if draw.random() < 0.9 else None, "\n".join(lines) if i % 17 else None))
    rows += rows[:4]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumn("h", F.lit(1))
    body = {r.text: r.b for r in docs.select("text", F.xxhash64("text").alias("b")).collect()}
    places = {}
    for doc_id, text in set(rows):
        for number, line in enumerate(text.split("\n") if text is not None else []):
            if line.strip(" "):
                order = (doc_id is not None, doc_id or 0, body[text], number)
                places[order] = (line, doc_id, text)
    first: dict[str, tuple] = {}
    for order in sorted(places):
        first.setdefault(places[order][0], order)
    near = {
        a
        for a in first
        if any(
            b != a and first[b] < first[a] and min(len(a), len(b)) >= line_dedup.NEAR_CHARS
            and abs(len(a) - len(b)) <= line_dedup.EDITS and distance(a, b) <= line_dedup.EDITS
            for b in first
        )
    }
    gone: dict[tuple, list[int]] = {}
    for order, (line, doc_id, text) in sorted(places.items()):
        if line in near or first[line] != order:
            gone.setdefault((doc_id, text), []).append(order[3])
    assert near and gone
    expected = [
        (i, len(t.split("\n")) if t is not None else 0, len(gone.get((i, t), [])), gone.get((i, t), []))
        for i, t in rows
    ]
    found = [tuple(r) for r in line_dedup.line_report(docs).collect()]
    order = lambda r: (r[0] is not None, r[0] or 0, *r[1:])
    assert sorted(found, key=order) == sorted(expected, key=order)

    rebuilt = line_dedup.without_repeats(docs)
    assert rebuilt.columns == docs.columns
    texts = Counter((r.doc_id, r.text) for r in rebuilt.collect())
    for (i, t), times in Counter(rows).items():
        lost = gone.get((i, t), [])
        kept = None if t is None else "\n".join(x for n, x in enumerate(t.split("\n")) if n not in lost)
        assert texts[i, kept] >= times


def test_stages_keep_columns_of_any_name(corpus):
    """Names that the operators use inside, dots, and the name of the column that mixing adds."""
    docs, rows = corpus
    names = ("gone", "__id", "__source", "__hash", "__at", "__dropped", "__of", "__body", "mix_slot", "a.b", "c`d")
    docs = docs.withColumns({c: F.lit(c) for c in names})
    lines = line_dedup.without_repeats(docs)
    assert lines.columns == docs.columns and lines.count() == len(rows)
    mixed = mixing.mixed(docs)
    assert sorted(mixed.columns) == sorted(docs.columns) and mixed.count() == len(rows)
    row = mixed.first().asDict()
    assert row["a.b"] == "a.b" and row["__at"] == "__at" and isinstance(row["mix_slot"], int)


def test_copies_of_a_line_are_not_paired_with_each_other(spark, monkeypatch):
    """Many forms of one line meet the earliest line, not each other."""
    base, forms = "one line that stands in very many forms here", 300
    changed = [base[: 20 + k % 20] + chr(0x100 + k) + base[21 + k % 20 :] for k in range(forms)]
    rows = [(0, base), *((k + 1, line) for k, line in enumerate(changed))]
    met, linked = [], line_dedup._linked
    monkeypatch.setattr(line_dedup, "_linked", lambda pairs, texts: met.append(pairs.count()) or linked(pairs, texts))
    found = line_dedup.line_report(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert {r.doc_id for r in found if r.n_dropped} == set(range(1, forms + 1))
    assert sum(met) < 30 * forms


def test_signatures_leave_room_for_every_near_line(spark):
    draw = random.Random(8)
    pairs = []
    for _ in range(600):
        line = "".join(draw.choice("ab eZsQ7é😀.İxyH") for _ in range(draw.choice([20, 24, 25, 60, 97, 400, 600])))
        pairs.append((line, edited(draw, line, draw.randrange(1, 3))))
    marked = spark.createDataFrame(pairs, "a string, b string").select(
        *[line_dedup._signature(line_dedup._marked(F.col(c))).alias(c) for c in "ab"]
    )
    assert marked.filter(line_dedup._alike(F.col("a"), F.col("b"))).count() == len(pairs)


def test_lines_of_one_key_that_are_not_near_are_not_paired(spark, monkeypatch):
    """Forms of one line that differ by a word each at any place share keys, and few are verified."""
    draw, forms = random.Random(4), 160
    base = " ".join(draw.choice(WORDS_OF_LINES) for _ in range(60))
    rows = []
    for k in range(forms):
        at, word = draw.randrange(len(base)), "".join(draw.choice("bcdghklm") for _ in range(4))
        rows.append((k, base[:at] + word + base[at:]))
    rows += [(forms + k, edited(draw, rows[k][1], 2)) for k in range(20)]
    met, linked = [], line_dedup._linked
    monkeypatch.setattr(line_dedup, "_linked", lambda pairs, texts: met.append(pairs.count()) or linked(pairs, texts))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    found = {r.doc_id for r in line_dedup.line_report(docs).collect() if r.n_dropped}
    one, two = (docs.select(F.col("doc_id").alias(f"d{x}"), F.col("text").alias(f"t{x}")) for x in "12")
    near = one.join(two, (F.col("d2") < F.col("d1")) & (F.levenshtein("t1", "t2") <= line_dedup.EDITS))
    assert found == {r.d1 for r in near.select("d1").collect()} >= set(range(forms, forms + 20))
    assert sum(met) < 40 * forms


WORDS_OF_LINES = ["the", "one", "tion", "in", "on", "hand", "er", "thor", "is", "sheat"]
