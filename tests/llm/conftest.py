from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

WORDS = [f"{a}{b}" for a in ("lo", "ti", "da", "mé", "ku") for b in ("ra", "ne", "SO", "pi", "xu")]


@pytest.fixture(scope="session")
def corpus(spark):
    """Small documents: copies, near copies, shared passages, nulls, blanks, repeated rows.

    Other columns have names that the operators use inside.
    """
    draw = random.Random(11)
    passage = " ".join(draw.choice(WORDS) for _ in range(60))
    texts: list[str | None] = [None, "", "  \n ", "one", "one two", "ONE two", passage]
    for _ in range(60):
        size = draw.choice([3, 30, 80, 200])
        text = " ".join(draw.choice(WORDS) + draw.choice(["", "", ".", "\n"]) for _ in range(size))
        texts.append(text)
        if draw.random() < 0.3:
            texts.append(text.upper() if draw.random() < 0.5 else text)
        if draw.random() < 0.3:
            words = text.split(" ")
            words[draw.randrange(len(words))] = "changed"
            texts.append(" ".join(words))
        if draw.random() < 0.2:
            texts.append(passage + " " + text)
    rows = [(i, t, "s0" if i % 3 else f"s{i % 7}") for i, t in enumerate(texts)]
    rows += [rows[8], rows[8], (None, texts[9], None)]
    frame = spark.createDataFrame(rows, "doc_id long, text string, source string")
    clashing = {c: F.lit("x") for c in ("h", "node", "list", "row", "name", "slot", "rank", "size")}
    return frame.withColumns(clashing).repartition(5), rows


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], "doc_id long, text string, source string, lang string")
