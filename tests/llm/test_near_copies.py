"""Near copies of the pipeline against brute-force Jaccard components."""

from __future__ import annotations

import re

import numpy as np
import pytest

import corpus_pipeline
from lagwatch.llm import near_copies

WORD = re.compile(r"[^\x20\x09-\x0d]+")
SF = "/root/testdata/sf0.001"


def shingles(text):
    w = WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    return frozenset(" ".join(w[i : i + 5]) for i in range(max(1, len(w) - 4))) if w else frozenset()


def survivors(rows):
    """Smallest id of each component of the pairs of similarity 4/5 or more."""
    sets = {i: shingles(t) for i, t in rows}
    ids, parent = sorted(sets), {i: i for i in sets}

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for at, i in enumerate(ids):
        for j in ids[at + 1 :]:
            both = len(sets[i] & sets[j])
            if sets[i] == sets[j] or 5 * both >= 4 * len(sets[i] | sets[j]) > 0:
                x, y = find(i), find(j)
                parent[max(x, y)] = min(x, y)
    return {i for i in ids if find(i) == i}


def corpus():
    rng = np.random.default_rng(7)
    rows = [(0, None), (1, ""), (2, "one two"), (3, "One  two"), (4, "one two three")]
    passage = [f"p{k}" for k in range(60)]
    for base in range(12):
        words = [f"b{base}w{k}" for k in rng.integers(0, 400, 120)]
        for edits in (0, 1, 2, 3, 4, 5, 6):
            copy = list(words)
            for at in rng.integers(0, 120, edits):
                copy[at] = f"e{len(rows)}x{at}"
            rows.append((len(rows), " ".join(copy)))
    words = [f"g{k}" for k in range(150)]
    for _ in range(90):  # one large group, some of it out of reach
        copy = list(words)
        for at in rng.integers(0, 150, rng.integers(0, 9)):
            copy[at] = f"e{len(rows)}x{at}"
        rows.append((len(rows), " ".join(copy)))
    for _ in range(50):  # unlike texts around one passage
        rows.append((len(rows), " ".join([*passage, *(f"o{len(rows)}x{k}" for k in range(60))])))
    return rows


@pytest.mark.parametrize(("bucket", "block"), [(32, 128), (4, 32)])
def test_kept_ids_are_those_of_brute_force(spark, bucket, block):
    rows = corpus()
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    got = near_copies.near_copies(docs, bucket=bucket, block=block).collect()
    assert len(got) == len(rows)
    assert {r.component_id for r in got} == survivors(rows)


def test_stage_of_the_pipeline(spark):
    rows = corpus()
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    assert {r.doc_id for r in corpus_pipeline.dedup_near(spark, docs, SF).collect()} == survivors(rows)
    assert corpus_pipeline.dedup_near(spark, docs.limit(0), SF).count() == 0
    small = spark.read.parquet(f"{SF}/documents.parquet")
    want = survivors([(r.doc_id, r.text) for r in small.collect()])
    assert {r.doc_id for r in corpus_pipeline.dedup_near(spark, small, SF).collect()} == want


def test_simhash_links_count_in_the_pipeline(spark):
    """Texts that say seven words over and over, then differ: few bits apart, but sets of shingles below 4/5."""
    from lagwatch.llm import simhash

    rng = np.random.default_rng(3)
    hot = " ".join(["a b c d e f g"] * 400)
    tails = [" ".join(f"{side}{k}" for k in rng.integers(0, 10**6, 6)) for side in ("x", "y")]
    rows = [(1, f"{hot} {tails[0]}"), (2, f"{hot} {tails[1]}"), (3, "something else altogether in here")]
    bits = simhash.fingerprint(rows[0][1].encode()) ^ simhash.fingerprint(rows[1][1].encode())
    assert bits.bit_count() <= 2
    a, b = shingles(rows[0][1]), shingles(rows[1][1])
    assert 5 * len(a & b) < 4 * len(a | b)
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert {r.doc_id for r in corpus_pipeline.dedup_near(spark, docs, SF).collect()} == {1, 3}
    assert {r.component_id for r in near_copies.near_copies(docs).collect()} == {1, 2, 3}
