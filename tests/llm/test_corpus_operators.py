"""Corpus operators against brute force, on edge cases and on the small tables."""

from __future__ import annotations

import hashlib
import re
import zlib
from collections import Counter

import numpy as np
import pytest
import sentencepiece
import xxhash
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from lagwatch.llm import (
    common,
    exact_dedup,
    packing,
    quality_classifier,
    quality_rules,
    queries,
    sentence_pieces,
    simhash,
    substring_dedup,
    toxicity,
    url_filter,
    wordpiece,
)

SF = "/root/testdata/sf0.001"
WORD = re.compile(r"[^\x20\x09-\x0d]+")
LONG = " ".join(f"w{i % 977}x" for i in range(12_000))
PASSAGE = " ".join(f"p{i}" for i in range(60))
TEXTS = [
    (1, "Hello  world\tagain and again"),
    (2, "Hello world again\nand again"),
    (3, None),
    (4, ""),
    (5, " \n\t "),
    (6, LONG),
    (7, "start " + PASSAGE + " end"),
    (8, PASSAGE + " other tail"),
    (9, "x " + PASSAGE),
    (10, "漢字 café 🙂 ﬁ İstanbul don't I'LL 123 ▁ <s> \x00 ß"),
    (11, "la " * 200),
    (12, LONG),
    (12, LONG),
    (None, "Hello world again and again"),
    (14, "one"),
]


@pytest.fixture(scope="module")
def edge(spark):
    rows = [(i, t, 7, "clash") for i, t in TEXTS]
    return spark.createDataFrame(rows, "doc_id long, text string, n int, place string").repartition(3).cache()


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], "doc_id long, text string, n int")


@pytest.fixture(scope="module")
def small(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")


@pytest.fixture(scope="module")
def labels(spark):
    return spark.read.parquet(f"{SF}/labels.parquet")


def words(text):
    return WORD.findall(text or "")


def test_tokens_equal_the_library(spark, edge, small):
    library = Tokenizer.from_file(queries.WORD_BPE)
    marked = ["hello <|endoftext|> world", "<|startoftext|>a<|ENDOFTEXT|>b " + LONG, "a <| endoftext|> b", "<|endoftext|>"]
    added = spark.createDataFrame(list(enumerate(marked)), "doc_id long, text string")
    for docs in (edge, small, added):
        got = packing.tokenize_pieces(docs, queries.WORD_BPE, with_ids=True).collect()
        by_doc = {}
        for r in got:
            assert zlib.crc32(bytes(r.ids)) == r.ids_crc32 and len(r.ids) == 4 * r.length
            by_doc.setdefault((r.doc_id, r.piece, r.start), bytes(r.ids))
        for r in docs.select("doc_id", "text").distinct().collect():
            want = np.array([*library.encode(r.text or "", add_special_tokens=False).ids, 1], "<u4").tobytes()
            parts = sorted((k[2], v) for k, v in by_doc.items() if k[0] == r.doc_id)
            assert b"".join(v for _, v in parts) == want
            assert all(len(v) == 4 * 4096 for _, v in parts[:-1])


def test_packing_carries_columns_called_like_its_own(spark):
    rows = [(i, 100 + i % 3_900, f"p{i}", i % 2 == 0, "old", "x.y") for i in range(300)]
    given = spark.createDataFrame(
        rows, "doc_id long, length int, _part string, _STAYS boolean, offset string, `a.b` string"
    )
    packed = packing.pack(given, per_task=40, name="clash")
    assert set(packed.columns) == {"doc_id", "length", "_part", "_STAYS", "a.b", "sequence_id", "offset", "certified"}
    found = {(r.doc_id, r.length, r["_part"], r["_STAYS"], r["a.b"]) for r in packed.collect()}
    assert found == {(d, n, part, stays, dotted) for d, n, part, stays, _, dotted in rows}
    assert packed.schema["offset"].dataType.simpleString() == "bigint"


def test_packing_is_gapless_and_near_the_bound(edge, small, none):
    for docs in (edge, small):
        packed = packing.pack(packing.tokenize_pieces(docs, queries.WORD_BPE), per_task=40)
        rows = packed.collect()
        assert len(rows) == packing.tokenize_pieces(docs, queries.WORD_BPE).count()
        bins = {}
        for r in rows:
            bins.setdefault(r.sequence_id, []).append((r.offset, r.length))
        for parts in bins.values():
            at = 0
            for offset, length in sorted(parts):
                assert offset == at
                at += length
            assert at <= 4096
        bound = packing.lower_bound(np.array([r.length for r in rows]), 4096)
        assert bound <= len(bins) <= bound * 1.02 + 1
    assert packing.pack_documents(none, queries.WORD_BPE).count() == 0


def test_lower_bound_and_best_fit_on_known_cases():
    assert packing.lower_bound(np.array([6, 6, 6]), 10) == 3
    assert packing.lower_bound(np.array([4, 4, 4, 4]), 10) == 2
    assert packing.lower_bound(np.array([], np.int64), 10) == 0
    bins, offsets = packing.best_fit(np.array([5, 7, 3, 5]), 10)
    assert bins.max() == 1 and sorted(offsets.tolist()) == [0, 0, 5, 7]


def test_assembled_sequences_hold_the_pieces(small):
    packed = packing.pack(packing.tokenize_pieces(small.limit(20), queries.WORD_BPE, with_ids=True)).cache()
    whole = {r.sequence_id: bytes(r.ids) for r in packing.assemble(packed).collect()}
    for r in packed.collect():
        assert whole[r.sequence_id][4 * r.offset : 4 * (r.offset + r.length)] == bytes(r.ids)


def test_statistics_and_rules(edge, small, labels, none):
    for docs in (edge, small):
        got = Counter(tuple(r) for r in quality_rules.statistics(docs).select(
            "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words").collect())
        want = Counter()
        for r in docs.collect():
            text, w = r.text or "", words(r.text)
            runs = [tuple(w[i : i + 3]) for i in range(len(w) - 2)]
            seen = Counter(runs)
            inside = {i + j for i, run in enumerate(runs) if seen[run] > 1 for j in range(3)}
            lines = [x for x in text.split("\n") if WORD.search(x)]
            want[(r.doc_id, len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(inside))] += 1
        assert got == want
    judged, rules = quality_rules.judge(small, labels)
    assert judged.filter("base_failed and kept").count() == 0 and len(rules) <= quality_rules.MOST_RULES
    judged, rules = quality_rules.judge(none, labels)
    assert judged.count() == 0 and rules == []
    judged, rules = quality_rules.judge(edge, labels.limit(0))
    assert rules == [] and judged.count() == len(TEXTS)


def test_exact_duplicates(edge, small, none):
    weak = lambda t: F.substring(F.sha2(t.cast("binary"), 256), 1, 1)
    for docs, digest in ((edge, exact_dedup.sha256_of), (edge, weak), (small, exact_dedup.sha256_of)):
        groups = {}
        rows = docs.collect()
        for r in rows:
            groups.setdefault(re.sub(r"[\x20\x09-\x0d]+", " ", r.text or ""), []).append(r.doc_id)
        got = exact_dedup.exact_duplicates(docs, digest).collect()
        assert len(got) == len(rows)
        by_sha = {}
        for g in got:
            by_sha.setdefault(g.text_sha256, []).append(g)
        for text, ids in groups.items():
            found = by_sha[hashlib.sha256(text.encode()).hexdigest()]
            keep = min((i for i in ids if i is not None), default=None)
            assert sorted(map(str, ids)) == sorted(str(f.doc_id) for f in found)
            assert {(f.keep_id, f.group_size) for f in found} == {(keep, len(ids))}
            assert sum(f.kept for f in found) == 1
        left = exact_dedup.drop_duplicates(docs)
        assert left.columns == docs.columns and left.count() == len(groups)
    assert exact_dedup.exact_duplicates(none).count() == 0


def test_urls(spark):
    link = '<html><link rel="canonical" href="{}"></html>'
    jump = '<meta http-equiv="refresh" content="0; url={}">'
    rows = [
        (1, "http://a.net/x", link.format("https://b.com/de/1")),
        (2, "http://c.net/y?q=1#f", jump.format("http://a.net/x")),
        (3, "http://www.b.com/de/9", None),
        (4, "http://d.net/", link.format("/z")),
        (5, None, "x"),
        (6, "no scheme", link.format("http://b.com/de/1")),
        (7, "http://Sub.Example.ORG/es/1", None),
        (8, "http://e.net/", jump.format("http://e.org/a")),
        (9, "http://f.net/", link.format("http://e.net/")),
        (10, "http://f.net/", link.format("http://b.com/de/2")),
        (11, "https://g.org/ok", link.format("http://b.com/de/1")),
        (11, "https://g.org/ok", link.format("http://b.com/de/1")),
        (12, "http://org.evil.net?x=://y", None),
    ]
    pages = spark.createDataFrame([(*r, 1) for r in rows], "page_id long, url string, html string, node int")
    got = [(r.page_id, r.rule, r.verdict) for r in url_filter.judge(pages, queries.URL_RULES).collect()]
    verdicts = dict((i, v) for i, _, v in got)
    assert len(got) == len(rows)
    # 1 and 2 are aliases of a blocked page, but 11, an alias too, is allowed by rule
    assert verdicts == {1: "allow", 2: "allow", 3: "block", 4: "allow", 5: "allow", 6: "allow", 7: "block", 8: "allow",
                        9: "allow", 10: "allow", 11: "allow", 12: "allow"}
    less = url_filter.judge(pages.filter("page_id not in (8, 11)"), queries.URL_RULES)
    assert {r.page_id for r in less.collect() if r.verdict == "block"} == {1, 2, 3, 7, 9, 10}
    assert url_filter.judge(pages.limit(0), queries.URL_RULES).count() == 0


def test_components_on_chains_and_stars(spark):
    chain = [(i, i + 1) for i in range(200)]
    star = [(1000, 1000 + i) for i in range(1, 150)]
    edges = spark.createDataFrame([*chain, *star, (5000, 5000)], "a long, b long")
    got = {r.node: r.component for r in common.connected_components(edges).collect()}
    assert got == {**{i: 0 for i in range(201)}, **{1000 + i: 1000 for i in range(150)}, 5000: 5000}


def kept_words(rows):
    """Rows of op5 by its definition, window by window."""
    holder = {}
    split = [(2**63 if r.doc_id is None else r.doc_id, r.doc_id, words(r.text)) for r in rows]
    for key, _, w in split:
        for i in range(len(w) - 49):
            run = tuple(w[i : i + 50])
            holder[run] = min(holder.get(run, key), key)
    want = Counter()
    for key, i, w in split:
        gone = {at + j for at in range(len(w) - 49) if holder[tuple(w[at : at + 50])] < key for j in range(50)}
        kept = " ".join(x for at, x in enumerate(w) if at not in gone)
        want[(i, len(w), len(gone), hashlib.sha256(kept.encode()).hexdigest())] += 1
    return want


def op5_rows(docs, **parameters):
    return Counter((r.doc_id, r.n_words, r.n_removed, r.kept_sha256) for r in substring_dedup.digests(docs, **parameters).collect())


def test_substrings(edge, small, none):
    for docs in (edge, small):
        assert op5_rows(docs) == kept_words(docs.collect())
    changed = substring_dedup.rewrite(edge)
    assert changed.columns == edge.columns and changed.count() == len(TEXTS)
    assert {r.doc_id: r.text for r in changed.collect()}[9] == "x"
    assert substring_dedup.digests(none).count() == 0


def test_substrings_of_repeated_phrases(spark):
    """A phrase said over and over makes one row for each of its windows, however often it is said."""
    texts = ["a " + "la " * 300 + "b", "c " + "la " * 450 + "d e " + "la " * 60, "la " * 90 + "z " * 70 + "la " * 200]
    for period in (2, 7, 49, 50, 51, 53):
        phrase = [f"p{period}w{i}" for i in range(period)]
        for times, head in ((5, "x"), (8, "y z"), (3, "")):
            texts.append(" ".join([head, *phrase * times, "apart", *phrase[: period // 2], *phrase * 2]))
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3)
    assert op5_rows(docs) == kept_words(docs.collect())

    run, schema = substring_dedup._windows(50, 10)
    for n in (300, 3_000):
        asked = [(1, 1, "la " * n, [(0, n - 49)])]
        rows = spark.createDataFrame(asked, "doc long, mark long, text string, asked array<struct<start:int,windows:int>>")
        assert [(r.start, r.stop) for r in rows.mapInArrow(run, schema).collect()] == [(0, n)]


def fingerprint(text):
    w = words(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    if not w:
        return 0
    hashes = [xxhash.xxh64_intdigest(" ".join(w[i : i + 3]).encode(), 42) for i in range(max(1, len(w) - 2))]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def test_simhash(edge, small, none):
    for docs in (edge, small):
        rows = docs.collect()
        got = simhash.near_duplicates(docs).collect()
        assert Counter((r.doc_id, r.fp % 2**64) for r in got) == Counter((r.doc_id, fingerprint(r.text)) for r in rows)
        kept = simhash.keep_one(docs)
        assert kept.columns == docs.columns and kept.count() == len({r.component_id for r in got})
    assert simhash.near_duplicates(none).count() == 0


@pytest.mark.parametrize("bucket", [1, 64])
def test_fingerprint_links(spark, bucket):
    rng = np.random.default_rng(3)
    values = set()
    for _ in range(40):
        at = int(rng.integers(0, 2**63))
        for _ in range(12):
            values.add(at)
            for b in rng.integers(0, 64, rng.integers(1, 4)):
                at ^= 1 << int(b)
    values = sorted(v - 2**64 if v >> 63 else v for v in values)
    parent = {v: v for v in values}

    def find(v):
        while parent[v] != v:
            v = parent[v]
        return v

    for i, a in enumerate(values):
        for b in values[:i]:
            if ((a ^ b) % 2**64).bit_count() <= 2:
                x, y = find(a), find(b)
                parent[max(x, y)] = min(x, y)
    nodes = spark.createDataFrame([(v,) for v in values], "fp long")
    edges = simhash.links(nodes, bucket=bucket)
    got = {r.node: r.component for r in common.connected_components(edges).collect()}
    assert {v: got.get(v, v) for v in values} == {v: find(v) for v in values}


def greedy(word, pieces):
    at = n = 0
    while at < len(word):
        for stop in range(len(word), at, -1):
            if ("▁" if at == 0 else "") + word[at:stop] in pieces:
                break
        else:
            return 1
        at, n = stop, n + 1
    return n


def test_token_counts(edge, small, none):
    pieces = set(wordpiece.pieces_of_model(queries.PIECE_BPE))
    for docs in (edge, small.limit(40)):
        got = Counter(tuple(r) for r in wordpiece.token_counts(docs, queries.PIECE_BPE).collect())
        want = Counter((r.doc_id, len(words(r.text)), sum(greedy(w, pieces) for w in words(r.text))) for r in docs.collect())
        assert got == want
    few = ["▁ab", "▁a", "b", "c", "bc", "cd", "▁abcz", "abcab"]
    match = wordpiece.LongestMatch(few)
    rng = np.random.default_rng(1)
    for _ in range(5000):
        word = "".join(rng.choice(list("abcdz"), rng.integers(1, 9)))
        assert match.count(word) == greedy(word, set(few))
    assert wordpiece.token_counts(none, queries.PIECE_BPE).count() == 0


def test_quality_classifier_on_held_out_rows(spark, edge, none):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet")
    judged = quality_classifier.judge(docs, labels).join(labels, "doc_id").filter("held_out")
    right = judged.filter("predicted = quality").count()
    assert right >= 0.95 * judged.count() > 0
    got = quality_classifier.judge(edge, labels).collect()
    assert len(got) == len(TEXTS) and all(0 <= r.score <= 1 for r in got)
    assert quality_classifier.judge(none, labels).count() == 0
    assert {r.score for r in quality_classifier.judge(edge, labels.limit(0)).collect()} == {1.0}
    assert quality_classifier.keep_good(edge, labels).columns == edge.columns


def test_sentence_pieces_equal_the_library(edge, small, none):
    library = sentencepiece.SentencePieceProcessor(model_file=queries.PIECE_BPE)
    codec = sentence_pieces.PieceCodec(queries.PIECE_BPE)
    rng = np.random.default_rng(2)
    letters = list("ab théeé ▁ \n\t  ing漢🙂123<s></s>▁▁.,\x00́")
    texts = ["".join(rng.choice(letters, rng.integers(0, 40))) for _ in range(1500)]
    for text in texts:
        pieces = codec.encode(text)
        ids = library.encode(text)
        assert [i for i, _, _ in pieces] == ids and codec.decode(ids) == library.decode(ids)
        ends = [0, *(e for _, _, e in pieces)]
        assert [b for _, b, _ in pieces] == ends[:-1] and ends[-1] == len(text.encode())  # spans tile the source
        crc = zlib.crc32(np.array(ends[1:], "<u4").tobytes())
        sha = [hashlib.sha256(x.encode()).hexdigest() for x in (",".join(map(str, ids)), library.decode(ids))]
        assert codec.digest([text])[0] == (len(ids), *sha, crc)
    for docs in (edge, small):
        want = Counter((r.doc_id, len(i := library.encode(r.text or "")), hashlib.sha256(",".join(map(str, i)).encode()).hexdigest(),
                        hashlib.sha256(library.decode(i).encode()).hexdigest()) for r in docs.collect())
        assert Counter(tuple(r)[:4] for r in sentence_pieces.digests(docs, queries.PIECE_BPE).collect()) == want
    assert sentence_pieces.digests(none, queries.PIECE_BPE).count() == 0
    row = sentence_pieces.encode(edge.filter("doc_id = 14"), queries.PIECE_BPE).first()
    assert [p.id for p in row.pieces] == library.encode("one")


def test_compiled_character_map():
    normaliser = sentencepiece.SentencePieceNormalizer(rule_name="nmt_nfkc")
    model = sentence_pieces.sentencepiece_model_pb2.ModelProto()
    model.ParseFromString(normaliser.serialized_model_proto())
    table = sentence_pieces.CharacterMap(model.normalizer_spec.precompiled_charsmap)
    codec = sentence_pieces.PieceCodec(queries.PIECE_BPE)
    codec.map, codec.prefix, codec.tidy = table, True, False
    for text in ("ﬁne ①②", "ｆｕｌｌ　width", "㍿ ½", "plain", "é"):
        got, origin = codec.normalise(text)
        assert got == normaliser.normalize(text)
        assert len(origin) == len(got.encode()) + 1 and list(origin) == sorted(origin)


def test_toxicity(spark, edge, none):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet")
    judged = toxicity.judge(docs, labels).join(labels, "doc_id").filter("held_out")
    assert judged.filter("predicted = toxic").count() >= 0.95 * judged.count() > 0
    assert toxicity.fold("You 1d10t, lοser! ​X4b") == " you idiot loser xab "
    model = toxicity.Model({" trash ": 5.0, " idio": 4.0}, (-3.0, 1.0, 1.0))
    assert model.weight(toxicity.fold("TR4SH and 1d10ts")) == 9.0
    assert model.weight(toxicity.fold("the trash can is full")) == 0.0
    got = toxicity.judge(edge, labels).collect()
    assert len(got) == len(TEXTS) and all(0 <= r.score <= 1 for r in got)
    assert toxicity.judge(none, labels).count() == 0
    assert {r.predicted for r in toxicity.judge(edge, labels.limit(0)).collect()} == {0}


def test_pipeline_against_its_stages(spark):
    import corpus_pipeline

    docs = spark.read.parquet(f"{SF}/documents.parquet")
    texts = {r.doc_id: r.text for r in docs.collect()}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        kept = stage(spark, docs, SF)
        assert kept.columns == docs.columns
        rows = {r.doc_id: r.text for r in kept.collect()}
        if name == "exact_dedup":
            first = {}
            for i in sorted(texts):
                first.setdefault(re.sub(r"[\x20\x09-\x0d]+", " ", texts[i] or ""), i)
            assert set(rows) == set(first.values())
        if name == "substring_dedup":
            assert set(rows) == set(texts)
        docs, texts = common.stage(kept, "test"), rows
    packed = corpus_pipeline.pack(spark, docs, SF)
    assert packed.select("doc_id").distinct().count() == len(texts)
