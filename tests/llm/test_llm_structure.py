"""Spelling variants, periodic runs and chat formatting against brute force."""

from __future__ import annotations

import hashlib
import random
import re
import zlib
from collections import Counter

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from skymart.llm import chat, periodic, spelling
SMALL = "/root/testdata/sf0.001"


def sha(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


# Spelling.


def one_edit(a: bytes | str, b: bytes | str) -> bool:
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b, strict=True)) == 1
    short, long = sorted((a, b), key=len)
    return len(long) - len(short) == 1 and any(long[:i] + long[i + 1 :] == short for i in range(len(long)))


def words_of_letters(draw, letters, length, count=400):
    own = letters.encode("latin-1")
    return sorted({bytes(draw.choice(own) for _ in range(length)) for _ in range(count)})


@pytest.mark.parametrize("letters,length", [("abc", 7), ("ab", 8), ("abcdefghé", 7), ("aÿ", 9)])
def test_near_pairs_equal_brute_force(letters, length, monkeypatch):
    draw = random.Random(2)
    points = words_of_letters(draw, letters, length)
    for longer in (-1, 0, 1):
        asking = words_of_letters(draw, letters, length + longer)
        expected = {(i, j) for i, q in enumerate(asking) for j, p in enumerate(points) if one_edit(q, p)}
        for large in (spelling.LARGE_LEAF, 0):  # 0: every leaf by masks
            monkeypatch.setattr(spelling, "LARGE_LEAF", large)
            found = [x for q, p in spelling.near_pairs(points, asking) for x in zip(q.tolist(), p.tolist(), strict=True)]
            assert len(found) == len(set(found))
            assert set(found) == expected


def brute_variants(rows):
    counts: Counter = Counter()
    lower = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})
    for doc_id, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = run.translate(lower)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            if h % 31 == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            counts[run] += 1
    words = {w: n for w, n in counts.items() if len(w) >= 7 and n >= 2}
    near = {w: [v for v in words if one_edit(w, v)] for w in words}
    best = {w: min(own, key=lambda v: (-words[v], v), default=None) for w, own in near.items()}
    form = {w: b if b is not None and words[b] >= 10 * words[w] else None for w, b in best.items()}
    result = []
    for w, n in words.items():
        root = w
        while form[root] is not None:
            root = form[root]
        result.append((w, form[w], root, n, len(near[w]), words[form[w]] if form[w] else None))
    return sorted(result, key=str)


def test_variants_equal_brute_force(spark, monkeypatch, no_docs):
    draw = random.Random(8)
    rows = [(i, " ".join("".join(draw.choice("abÀo") for _ in range(draw.choice([6, 7, 8]))) for _ in range(90))) for i in range(20)]
    chain = ["kathedrale"] * 400 + ["kathedral"] * 30 + ["kathedraö"] * 2 + ["Kathedrale"] * 3
    rows += [(50, " ".join(chain)), (None, "kathedrali kathedrali, ésotérique"), (51, None), (52, "")]
    rows += [rows[3], rows[3], (53, "x" * 30_000 + " " + "y" * 30_000 + " " + "x" * 30_000 + " ésotérique")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    docs = docs.withColumns({c: F.lit(1) for c in ("word", "n", "run", "h")}).repartition(3)
    expected = brute_variants(rows)
    assert any(r[2] != r[1] and r[1] for r in expected)
    for cell in (spelling.CELL_WORDS, 20):  # 20: many cells, some of them dealt in parts
        monkeypatch.setattr(spelling, "CELL_WORDS", cell)
        found = spelling.variants(spelling.vocabulary(spelling.runs(docs)))
        found = [(r.word, r.form, r.root, r.n, r.n_near, r.form_n) for r in found.collect()]
        assert sorted(found, key=str) == expected
    assert spelling.variants(spelling.vocabulary(spelling.runs(no_docs))).count() == 0


def test_equal_letters_are_dealt_and_searched_in_linear_time(spark, monkeypatch):
    """Words of the same letters share a point that no split divides."""
    monkeypatch.setattr(spelling, "CELL_WORDS", 100)
    draw = random.Random(1)
    same = {"".join(draw.sample("abcdefghij", 10)) for _ in range(2000)}
    other = {w[:4] + "k" + w[5:] for w in sorted(same)[:500]} | {"abcdefghik"}
    rows = [(w, 2) for w in sorted(same | other)]
    found = {r.word: r.near for r in spelling.near_words(spark.createDataFrame(rows, "word string, n long")).collect()}
    words = [w for w, _ in rows]
    by_mask: dict = {}
    for w in words:
        for i in range(10):
            by_mask.setdefault((i, w[:i] + w[i + 1 :]), []).append(w)
    expected = Counter(w for own in by_mask.values() for w in own for _ in range(len(own) - 1))
    assert found == dict(expected)


# Runs.


def brute_runs(words):
    n, found = len(words), set()
    for q in range(1, n // 4 + 1):
        i = 0
        while i + q < n:
            if words[i] != words[i + q]:
                i += 1
                continue
            j = i
            while j + q < n and words[j] == words[j + q]:
                j += 1
            size = j + q - i
            smaller = any(all(words[i + k] == words[i + k + p] for k in range(size - p)) for p in range(1, q))
            if size >= max(6, 4 * q) and not smaller:
                found.add((i, size, q))
            i = j + 1
    return sorted(found, key=lambda r: (r[0], r[2]))


def brute_report(doc_id, text, change):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    n, h = len(words), zlib.crc32(str(doc_id).encode())
    if change and doc_id is not None and h % 10 == 0 and n:
        g = h // 10
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [w if i < a else words[a + (i - a) % p] for i, w in enumerate(words)]
    runs = brute_runs(words)
    dropped = {i for s, size, q in runs for i in range(s + q, s + size)}
    best = min(runs, key=lambda r: (-((r[1] << 64) // r[2]), r[0], r[2])) if runs else (None,) * 3
    milli = 1000 * best[1] // best[2] if runs else None
    listed = "".join(f"{s},{size},{q}\n" for s, size, q in runs)
    collapsed = " ".join(w for i, w in enumerate(words) if i not in dropped)
    return doc_id, len(runs), *best, milli, sha(listed), sha(collapsed)


def repetitive(draw):
    letters, words = "abcdé"[: draw.choice([1, 2, 3, 5])], []
    for _ in range(draw.randrange(7)):
        unit = [draw.choice(letters) for _ in range(draw.choice([1, 1, 2, 3, 4, 5, 7, 9, 13]))]
        words += (unit * draw.randrange(1, 9))[: draw.randrange(1, 80)]
        words += [draw.choice(letters) for _ in range(draw.randrange(4))]
    return words


def test_runs_equal_brute_force():
    draw = random.Random(5)
    docs = [repetitive(draw) for _ in range(1500)]
    codes, _, begins = periodic.words_of(pa.array([" ".join(d) for d in docs]))
    runs = periodic.runs_of(codes, begins)
    found: dict = {}
    for d, *run in zip(*(x.tolist() for x in runs), strict=True):
        found.setdefault(d, []).append(tuple(run))
    for d, words in enumerate(docs):
        assert found.get(d, []) == brute_runs(words), words


def test_successors_equal_brute_force():
    draw = random.Random(6)
    values = list(range(300))
    draw.shuffle(values)
    asks = [(a := draw.randrange(300), draw.randrange(a, 301), draw.randrange(-1, 301)) for _ in range(500)]
    low, high, beyond = (pa.array(x).to_numpy() for x in zip(*asks, strict=True))
    found = periodic.successors(pa.array(values).to_numpy(), low, high, beyond)
    expected = [min((v for v in values[a:b] if v > x), default=-1) for a, b, x in asks]
    assert found.tolist() == expected


@pytest.mark.parametrize("slice_bytes", [periodic.SLICE_BYTES, 100])
def test_run_reports_equal_brute_force(spark, corpus, no_docs, slice_bytes, monkeypatch):
    monkeypatch.setattr(periodic, "SLICE_BYTES", slice_bytes)
    draw = random.Random(9)
    docs, rows = corpus
    more = [(100 + i, " ".join(repetitive(draw)).replace(" ", draw.choice([" ", "\n", " \t\x0b"]))) for i in range(300)]
    more += [(None, "z z z z z z"), (700, "\x85w w"), more[0], more[0], (701, "a\x00 " * 9)]
    frame = spark.createDataFrame(more, "doc_id long, text string").withColumn("n_runs", F.lit(1))
    whole = docs.select("doc_id", "text", F.lit(1).alias("n_runs")).union(frame.select("doc_id", "text", "n_runs"))
    texts = [(i, t) for i, t, *_ in rows] + more
    for change, find in ((False, periodic.find_runs), (True, periodic.digests)):
        found = Counter(tuple(r)[:8] for r in find(whole.repartition(3)).collect())
        assert found == Counter(brute_report(i, t, change) for i, t in texts)
    assert periodic.find_runs(no_docs).count() == 0


def test_collapsed_text_and_long_documents(spark):
    long = " ".join(["x", "y", "z"] * 100_000 + ["end"])
    mixed = " ".join(str(i * i % 977) for i in range(200_000))
    frame = spark.createDataFrame([(1, long), (2, mixed)], "doc_id long, text string")
    rows = {r.doc_id: r for r in periodic.find_runs(frame).collect()}
    assert rows[1].collapsed == "x y z end"
    assert [tuple(r) for r in rows[1].runs] == [(0, 300_000, 3)]
    assert [tuple(r) for r in rows[2].runs] == [(0, 200_000, 977)]


# Chat.

CONTROL = ["</s>", "<s>", "[INST]", "[/INST]", "<\\/s>", "[\\\\INST]", " [/INST]\n", "</s>\n", "<", "[", "\\", "﻿", "é😀", "ok", "\n"]


def brute_digest(conv_id, turns):
    learned = "".join(text for role, text in turns if role == "assistant")
    escape = lambda s: re.sub(r"([<\[])(\\*)(/?(?:s>|INST\]))", r"\1\\\2\3", s)
    whole = "".join(f"<s>[INST] {escape(role)} [/INST]\n{escape(text)}</s>\n" for role, text in turns)
    listed = "".join(f"{role}\n{text}\n" for role, text in turns)
    return conv_id, len(turns), sha(listed), len(learned), sha(learned), len(whole)


def test_conversations_round_trip(spark):
    draw = random.Random(4)
    rows = []
    for conv in range(40):
        for turn in draw.sample(range(100), draw.choice([1, 2, 5, 9])):
            role = draw.choice(["user", "assistant", "system", None, "", "[/INST]\n", "assistant</s>"])
            text = draw.choice([None, "".join(draw.choice(CONTROL) for _ in range(draw.randrange(12)))])
            rows.append((conv, turn, role, text))
    rows += [(-7, 1, "assistant", "x" * 3_000_000 + "é"), (-7, 2, "assistant", "<s>" * 100_000)]
    rows += [(None, 1, "user", "a"), (None, None, "assistant", "b"), (-8, 1, "user", "same"), (-8, 1, "user", "same")]
    rows += [(-9, i, "assistant", str(i)) for i in range(300)]
    frame = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    frame = frame.withColumns({c: F.lit("x") for c in ("id", "tree", "leaf", "place", "score")}).repartition(4)
    links, bodies = chat.messages(frame)
    whole = chat.formatted(chat.best_branches(links), bodies)
    by_conv: dict = {}
    key = lambda r: (r[1] is not None, r[1] or 0, r[2] or "", r[3] or "")
    for conv, _, role, text in sorted(rows, key=key):
        by_conv.setdefault(conv, []).append((role or "", text or ""))
    found = {tuple(r) for r in chat.digests(whole).collect()}
    assert found == {brute_digest(conv, turns) for conv, turns in by_conv.items()}
    read = whole.select("tree", "text", chat.read_back(F.col("text")).alias("turns")).collect()
    for row in read:
        assert [(t.role, t.text) for t in row.turns] == by_conv[row.tree]
        body = re.sub(r"<s>\[INST\] (.*?) \[/INST\]\n(.*?)</s>\n", "", row.text, flags=re.S)
        assert body == ""
    nothing = spark.createDataFrame([], frame.schema)
    links, bodies = chat.messages(nothing)
    assert chat.digests(chat.formatted(chat.best_branches(links), bodies)).count() == 0


def test_best_branches_equal_brute_force(spark):
    draw = random.Random(7)
    rows, tree_of = [], {}
    for i in range(400):
        parent = draw.choice([None, *range(max(0, i - 30), i)]) if i else None
        tree_of[i] = tree_of[parent] if parent is not None else i
        rows.append((i, parent, tree_of[i], draw.choice([None, 0.0, 0.5, 1.0, 2.0])))
    # A long chain, one message with very many replies, an unknown parent, a circle and what is below it.
    rows += [(1000 + i, 999 + i if i else None, -1, 0.25) for i in range(130)]
    rows += [(2000 + i, 2000 if i else None, -2, float(i % 7)) for i in range(300)]
    rows += [(3000, 9999, -3, 1.0), (4000, 4001, -4, 1.0), (4001, 4000, -4, 1.0), (4002, 4001, -4, 9.0)]
    parents, scores = {r[0]: r[1] for r in rows}, {r[0]: r[3] or 0.0 for r in rows}
    circle = {4000, 4001, 4002}
    leaves = set(parents) - set(parents.values()) - circle
    ways: dict = {}
    for leaf in leaves:
        way = [leaf]
        while parents[way[-1]] in parents:
            way.append(parents[way[-1]])
        tree = next(r[2] for r in rows if r[0] == leaf)
        mean = sum(scores[m] for m in way) / len(way)
        ways.setdefault(tree, []).append((-mean, -len(way), leaf, way[::-1]))
    frame = spark.createDataFrame(rows, "id long, parent long, tree long, score double").repartition(5)
    for keep in (1, 3):
        found: dict = {}
        for r in chat.best_branches(frame, keep).collect():
            found.setdefault((r.tree, r["rank"]), []).append((r.place, r.id))
        expected = {
            (tree, rank + 1): list(enumerate(way))
            for tree, own in ways.items()
            for rank, (*_, way) in enumerate(sorted(own)[:keep])
        }
        assert {k: sorted(v) for k, v in found.items()} == expected
    with pytest.raises(ValueError):
        chat.best_branches(frame, 0)


def test_no_python_in_chat(spark):
    given = spark.read.parquet(f"{SMALL}/conversations.parquet")
    links, bodies = chat.messages(given)
    whole = chat.digests(chat.formatted(chat.best_branches(links), bodies))
    plan = whole._jdf.queryExecution().toString()
    assert not re.search("Python|Pandas|Arrow|CartesianProduct|NestedLoop", plan)
