"""Mixing and nearest neighbours, the registered queries and the pipeline."""

from __future__ import annotations

from collections import Counter

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from skymart.llm import language_id, line_dedup, mixing, nearest, queries, shingle_join

SMALL = "/root/testdata/sf0.001"


@pytest.mark.parametrize("shares", [None, {"s0": 7, "s1": 3}])
def test_mix_is_fair(corpus, monkeypatch, shares):
    monkeypatch.setattr(mixing, "BLOCK_ROWS", 4)
    docs, rows = corpus
    found = mixing.schedule(docs, shares).collect()
    assert Counter((r.doc_id, r.source) for r in found) == Counter((i, s) for i, _, s in rows)
    blocks = {}
    for r in found:
        blocks.setdefault(r.slot, []).append(r)
    assert sorted(blocks) == list(range(len(blocks)))
    for slot, own in blocks.items():
        assert len({(r.source, r.block) for r in own}) == 1
        assert own[0].release <= slot < own[0].deadline
        assert sorted(r.place for r in own) == list(range(len(own)))
    if shares:
        # While no source has ended, each has had its weight of the slots, less than a block apart.
        sizes = Counter(s for _, _, s in rows)
        weight = {s: shares.get(s, 1) for s in sizes}
        whole = sum(weight.values())
        full = min(-(-n // 4) // weight[s] for s, n in sizes.items()) * whole
        had: Counter = Counter()
        for slot in range(full):
            had[blocks[slot][0].source] += 1
            assert all(abs(had[s] - w * (slot + 1) / whole) < 1 for s, w in weight.items())


def test_mixed_keeps_rows_and_columns(corpus, no_docs):
    docs, rows = corpus
    mixed = mixing.mixed(docs.drop("slot"))
    assert mixed.columns == [*docs.drop("slot").columns, "mix_slot"]
    found = mixed.collect()
    assert Counter((r.doc_id, r.text, r.source) for r in found) == Counter(rows)
    slots = [r.mix_slot for r in found]
    assert slots == sorted(slots)
    assert mixing.mixed(no_docs).count() == 0
    with pytest.raises(ValueError):
        mixing.schedule(docs, {"s0": 0})


def vectors(spark, rows):
    return spark.createDataFrame(rows, "vec_id long, embedding array<float>, rank int")


def exact(ids: np.ndarray, rows: np.ndarray, query: int) -> list[tuple[int, float]]:
    gaps = np.sqrt(((rows - rows[query]) ** 2).sum(axis=1))
    order = [i for i in np.lexsort((ids, gaps)) if ids[i] != ids[query]][: nearest.K]
    return [(int(ids[i]), float(gaps[i])) for i in order]


def test_nearest_recall_and_scores(spark, monkeypatch):
    monkeypatch.setattr(nearest, "BLOCK_ROWS", 1000)
    random = np.random.default_rng(1)
    rows = random.standard_normal((3000, 32)).astype(np.float32)
    rows[100:140] = rows[100]  # ties
    table = [(i, r.tolist(), 1) for i, r in enumerate(rows)]
    found: dict[int, list] = {}
    for r in nearest.nearest(vectors(spark, table)).orderBy("query_id", "rank").collect():
        found.setdefault(r.query_id, []).append((r.vec_id, r.score))
        assert r["rank"] == len(found[r.query_id])
    assert set(found) == set(range(0, 3000, 100))
    wide = rows.astype(np.float64)
    hits = 0
    for query, own in found.items():
        best = exact(np.arange(3000), wide, query)
        hits += len({i for i, _ in best} & {i for i, _ in own})
        for vec_id, score in own:
            assert score == pytest.approx(np.sqrt(((wide[vec_id] - wide[query]) ** 2).sum()), abs=1e-12)
    assert hits / (len(found) * nearest.K) >= 0.95
    assert found[100] == [(i, 0.0) for i in range(101, 111)]


def test_nearest_of_odd_vectors(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 0.0], 1), (1, [1.0, 1.0], 1), (2, None, 1), (3, [0.0, 0.0], 1), (4, [nan, 1.0], 1),
            (5, [inf, 1.0], 1), (6, [None, 1.0], 1), (7, [1.0, 1.0, 1.0], 1), (8, [], 1),
            (None, [1.0, 0.0], 1), (1, [1.0, 1.0], 1), (100, [0.0, 0.0], 1)]
    found = [tuple(r) for r in nearest.nearest(vectors(spark, rows)).collect()]
    assert found == [(0, 1, 1, 1.0), (0, 2, 1, 1.0)]
    assert nearest.nearest(vectors(spark, [])).count() == 0


def test_queries_equal_their_sql(spark):
    names, oracles = queries.queries(), queries.oracle_sql()
    assert set(oracles) <= set(names)
    assert sorted(int(n[2:].split("_")[0]) for n in names) == list(range(1, 14))
    base = duckdb.connect()
    for table in ("documents", "conversations"):
        base.sql(f"CREATE VIEW {table} AS SELECT * FROM '{SMALL}/{table}.parquet'")
    for name, sql in oracles.items():
        expected = base.sql(sql)
        got = names[name](spark, SMALL).select(*expected.columns)
        assert Counter(map(tuple, got.collect())) == Counter(expected.fetchall()), name


def test_pipeline_stages(spark, tmp_path):
    """Each stage against what its operator says of its own input."""
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    columns = docs.columns
    for number, (name, stage) in enumerate(corpus_pipeline.STAGES):
        before = docs
        stage(spark, docs, SMALL).write.parquet(str(tmp_path / name))
        docs = spark.read.parquet(str(tmp_path / name))
        ids = {r.doc_id for r in docs.select("doc_id").collect()}
        if number < 4:
            assert set(columns) <= set(docs.columns)
        if name == "language":
            judged = language_id.predict(before, language_id.fit(before, F.lit(True)))
            assert ids == {r.doc_id for r in judged.filter("not rejected").collect()}
            assert len(ids) > 0.97 * before.count()
        elif name == "lines":
            assert docs.count() == before.count()
            lost = {r.doc_id: set(r.dropped) for r in line_dedup.line_report(before).collect()}
            texts = {r.doc_id: r.text.split("\n") for r in before.collect()}
            for r in docs.collect():
                kept = [x for n, x in enumerate(texts[r.doc_id]) if n not in lost[r.doc_id]]
                assert r.text == "\n".join(kept) and r.n_chars == len(r.text)
        elif name == "near_duplicates":
            found = shingle_join.near_duplicates(before).filter("doc_id = component_id")
            assert ids == {r.doc_id for r in found.collect()}
        else:
            assert docs.count() == before.count()
    assert docs.columns == [
        "doc_id", "mix_slot", "n_tokens", "ids", "ids_sha256", "decoded_sha256",
    ]
    assert [r.n_tokens == len(r.ids) for r in docs.collect()].count(False) == 0


def test_stages_take_empty_tables(spark, tmp_path):
    docs = spark.createDataFrame(
        [], "doc_id long, text string, lang string, source string, n_chars long"
    )
    for name, stage in corpus_pipeline.STAGES:
        stage(spark, docs, SMALL).write.parquet(str(tmp_path / name))
        docs = spark.read.parquet(str(tmp_path / name))
        assert docs.count() == 0
