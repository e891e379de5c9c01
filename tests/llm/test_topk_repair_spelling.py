"""Exact top-k, conversation repair and spelling variants against brute force."""

from __future__ import annotations

import hashlib
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from lagwatch.llm import conversation_repair, queries, spelling, topk

SF = "/root/testdata/sf0.001"


# --- top-k ------------------------------------------------------------------------------------


def usable(vector):
    return vector is not None and all(x is not None and np.isfinite(x * 1024.0) for x in vector)


def best_rows(rows, every, k):
    whole = [(i, [int(np.floor(x * 1024.0)) for x in v]) for i, v in rows if i is not None and usable(v)]
    asked = {}
    for i, v in rows:
        if i is not None and i % every == 0 and usable(v):
            asked[i] = min(asked.get(i, v), v)
    out = []
    for i, v in asked.items():
        q = [int(np.floor(x * 1024.0)) for x in v]
        near = sorted(
            (-min(max(sum(a * b for a, b in zip(q, p, strict=True)), -(1 << 63)), (1 << 63) - 1), j)
            for j, p in whole
            if j != i and len(p) == len(q)
        )
        out += [(i, r + 1, j, -s) for r, (s, j) in enumerate(near[:k])]
    return sorted(out)


def vector_rows():
    rng = np.random.default_rng(3)
    rows = [(i, [round(float(x), 3) for x in rng.normal(0, 0.3, 5)]) for i in range(240)]
    rows += [(1000 + i, [0.5, 0.25, -0.125, 0.0, 1.0]) for i in range(120)]  # a third of all rows alike
    rows += [(2000, None), (2010, []), (2011, []), (2020, [1.0, None]), (2030, [float("nan")] * 5)]
    rows += [(2040, [float("inf"), 0.0, 0.0, 0.0, 0.0]), (2050, [1e306] * 5), (None, [0.1] * 5)]
    rows += [(2060, [1e9, -1e9, 1e9]), (2061, [1e9, 1e9, 1e9]), (2062, [3e9, 1.0, 2e9]), (2070, [4.0, 5.0, 6.0])]
    rows += [(20, rows[20][1]), (21, rows[21][1]), (30, [0.0] * 5)]
    return rows


@pytest.mark.parametrize(("shard", "block", "leaf"), [(40, 60, 2), (200, 1 << 20, 8), (1 << 17, 1 << 20, 64)])
def test_top_k_equals_brute_force(spark, shard, block, leaf):
    rows = vector_rows()
    df = spark.createDataFrame([(i, v, 1, "x", 2.0) for i, v in rows], "vec_id long, embedding array<double>, lane int, tree string, rank double")
    found = topk.top_k(df.repartition(3), lambda i: i % 10 == 0, 7, shard_values=shard, block_values=block, leaf=leaf)
    assert found.columns == ["query_id", "rank", "vec_id", "score"]
    assert sorted(map(tuple, found.collect())) == best_rows(rows, 10, 7)


def test_top_k_of_an_empty_table(spark):
    none = spark.createDataFrame([], "vec_id long, embedding array<float>")
    assert topk.top_k(none, lambda i: i % 10 == 0).count() == 0


def test_search_prunes_boxes():
    rng = np.random.default_rng(5)
    points = np.floor(rng.normal(0, 30, (4_096, 2)))
    tree = topk.build(points, np.arange(4_096), 16)
    start, stop, child = topk.layout(4_096, 16)
    assert all(tree["points"][a:b].min(0).tolist() == low.tolist() for a, b, low in zip(start, stop, tree["low"], strict=True))
    seen = []

    class Counting(topk.Best):
        def add(self, scores, ids):
            seen.append(len(scores))
            super().add(scores, ids)

    best = Counting(-1, 5, [])
    topk.search(tree, np.array([[50.0, 10.0]]), [best], 16)
    wanted = sorted((points @ [50.0, 10.0]).tolist(), reverse=True)[:5]
    assert [-s for s, _, _ in best.rows] == wanted
    first = sum(seen)
    assert first < 400
    later = Counting(-1, 5, [(int(wanted[0]) + 1, i) for i in range(5)])
    seen.clear()
    topk.search(tree, np.array([[50.0, 10.0]]), [later], 16)
    assert sum(seen) < first and not any(fresh for _, _, fresh in later.rows)


# --- conversations ----------------------------------------------------------------------------

NEXT = {0: "user", 1: "user", 2: "assistant", 3: "user"}
AFTER = {("s", 0): 1, ("u", 0): 2, ("u", 1): 2, ("u", 3): 2, ("a", 2): 3}


def repaired_by_hand(rows, hurt=True):
    conversations = defaultdict(list)
    for conv, turn, role, text in rows:
        conversations[conv]
        read = [" " if x is None else x for x in (conv, turn, role, text)]
        kind = zlib.crc32(f"{read[0]}:{read[1]}".encode()) % 20 if hurt else 9
        role, text = read[2], read[3]
        text = "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text
        role = "user" if kind == 4 else role
        if kind:
            conversations[conv] += [(turn is not None, turn or 0, role, text)] * (2 if kind == 3 else 1)
    out = {}
    for conv, own in conversations.items():
        own.sort()
        seen, faults = set(), []
        for _, _, role, text in own:
            shown = re.sub(r"[\x20\x09-\x0d]", "", text)
            last = "truncated" if shown[-1:] not in (".", "!", "?") else ""
            faults.append("blank" if not shown else "duplicate" if (role, text) in seen else last)
            seen.add((role, text))
        initials = [r[:1] for _, _, r, _ in own]
        illegal = sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:], strict=False))
        turns = {t for known, t, _, _ in own if known}
        ways = {0: (0, "", ())}

        def inserted(ways):
            for _ in range(3):
                for state, (cost, audit, made) in list(ways.items()):
                    after = AFTER[NEXT[state][0], state]
                    way = (cost + 5, audit + "I", (*made, f"{NEXT[state]}:"))
                    if after not in ways or way[:2] < ways[after][:2]:
                        ways[after] = way
            return ways

        for (_, _, role, text), fault in zip(own, faults, strict=True):
            found = {}
            for state, (cost, audit, made) in inserted(ways).items():
                more = 5 if fault == "truncated" else 0
                options = [(state, cost + 2, "D", ())]
                if fault not in ("blank", "duplicate"):
                    options.append((AFTER.get((role[:1], state)), cost + more, "K", (f"{role}:{text}",)))
                    due = NEXT[state]
                    options.append((AFTER[due[0], state], cost + more + 1, "R", (f"{due}:{text}",)))
                for after, price, letter, kept in options:
                    way = (price, audit + letter, made + kept)
                    if after is not None and (after not in found or way[:2] < found[after][:2]):
                        found[after] = way
            ways = found
        ways = inserted(ways) if own else ways
        cost, audit, made = min((ways[s] for s in (0, 3) if s in ways), key=lambda w: w[:2])
        gaps = max(turns) - min(turns) + 1 - len(turns) if turns else 0
        counts = [faults.count(f) for f in ("blank", "duplicate", "truncated")]
        out[conv] = (gaps, *counts, illegal, cost, audit, hashlib.sha256("\n".join(made).encode()).hexdigest())
    return out


def conversation_rows():
    rng = random.Random(11)
    texts = ["Fine.", "Why?", "No end", "", " \t\n", None, "Fine.", "x. ", "ends! \n", "long " * 3_000 + "."]
    rows = []
    for conv in range(120):
        for turn in range(rng.randint(0, 9)):
            role = rng.choice(["user", "assistant", "user", "assistant", "system", "tool", "", None, "student"])
            rows.append((conv, turn if rng.random() < 0.9 else None, role, rng.choice(texts) if rng.random() < 0.3 else f"t{turn % 3} {conv}."))
    rows += rows[:40]
    rows += [(None, 1, "user", "a."), (None, 2, "assistant", "b."), (7_000, None, "user", "z.")]
    rows += [(9_000, t, rng.choice(["user", "assistant", "system"]), rng.choice(["y.", "y", f"n{t}.", f"n{t}"])) for t in range(700)]
    rows += [(9_001, 3, "user", "the same row.")] * 300
    return rows


NAMES = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]


@pytest.mark.parametrize("hurt", [True, False])
@pytest.mark.parametrize(("piece", "group"), [(1_024, 64), (5, 3)])
def test_repair_equals_brute_force(spark, hurt, piece, group):
    rows = conversation_rows()
    df = spark.createDataFrame([(*r, 1, "x") for r in rows], "conv_id long, turn long, role string, text string, n int, audit string")
    read = conversation_repair.damage if hurt else conversation_repair.undamaged
    found = conversation_repair.repair(read(df.repartition(3)), piece, group)
    got = {r.conv_id: tuple(r[c] for c in NAMES) for r in found.collect()}
    assert got == repaired_by_hand(rows, hurt)


def test_repair_of_nothing(spark):
    none = spark.createDataFrame([], "conv_id long, turn long, role string, text string")
    assert conversation_repair.repair(conversation_repair.damage(none)).count() == 0


def test_rules_share_symbols_and_give_the_same_matrices(spark):
    rng = random.Random(2)
    texts = ["".join(rng.choice("sua" * 3 + "SUAOox") for _ in range(rng.randint(1, 30))) for _ in range(80)]
    sequences = spark.createDataFrame([(t, 1) for t in texts], "seq string, n int")
    rules = conversation_repair.grammar(sequences)
    assert len(rules) > 8
    plain = conversation_repair.symbol_matrices()
    for row in conversation_repair.solved(sequences, rules).collect():
        want = conversation_repair.solve(row.seq, plain)
        flat = [e for line in want for e in line]
        assert row.costs == [e and e[0] for e in flat]
        assert row.audits == [e and str(e[1]) for e in flat]


# --- spelling ---------------------------------------------------------------------------------

ALPHABET = [*"abcdefghijklmnopqrstuvwxyz", *map(chr, range(0xC0, 0x100))]


def variants_by_hand(rows, least=5):
    n = Counter()
    for doc_id, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = re.sub("[A-Z]", lambda m: m[0].lower(), run)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            if h % 199 == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            n[run] += 1
    known = {w: k for w, k in n.items() if len(w) >= 6 and k >= least}

    def near(w):
        found = {w[:i] + w[i + 1 :] for i in range(len(w))}
        found |= {w[:i] + c + w[i + 1 :] for i in range(len(w)) for c in ALPHABET}
        found |= {w[:i] + c + w[i:] for i in range(len(w) + 1) for c in ALPHABET}
        return [x for x in found if x in known and x != w]

    around = {w: near(w) for w in known}
    form = {}
    for w, others in around.items():
        best = min(others, key=lambda x: (-known[x], x), default=None)
        form[w] = best if best and known[best] >= 5 * known[w] else None

    def root(w):
        while form[w]:
            w = form[w]
        return w

    return {w: (form[w], root(w), k, len(around[w]), known[form[w]] if form[w] else None) for w, k in known.items()}


def spelling_rows():
    rng = random.Random(4)
    words = [f"{a}{b}tion" for a in ("compos", "direc", "rela", "naïve", "ÀÉüber", "posi") for b in ("", "a", "i")] + ["aabbccdd", "letter", "lettter"]
    rows = []
    for doc in range(300):
        picked = [rng.choice(words) for _ in range(30)] + ["compostion"] * (doc % 7 == 0) + ["Frequent"] * 20
        picked += ["frequnt"] * (doc % 8 == 0) + ["frequt"] * (doc % 60 == 0)
        if rng.random() < 0.3:
            w = rng.choice(words)
            at = rng.randrange(len(w))
            picked += [rng.choice([w[:at] + w[at + 1 :], w[:at] + "e" + w[at:], w[:at] + "ÿ" + w[at + 1 :]])] * 3
        rows.append((doc, " ".join(picked) + ", 12-Über's " + "çÿ×÷ÀBCdef"))
    rows += [(None, "frequent word forms"), (5, None), (6, ""), (7, " \n"), (8, "z" * 5_000 + " " + ("y" * 300 + " ") * 6)]
    return rows + rows[:20]


@pytest.mark.parametrize("blocks", [spelling.FILTER_BLOCKS, 70])
def test_variants_equal_brute_force(spark, blocks):
    rows = spelling_rows()
    docs = spark.createDataFrame([(i, t, 1, "x", "y") for i, t in rows], "doc_id long, text string, n int, word string, form string")
    got = {r.word: (r.form, r.root, r.n, r.n_near, r.form_n) for r in spelling.variants(docs.repartition(3), most=blocks).collect()}
    want = variants_by_hand(rows)
    assert got == want
    assert any(w[0] and w[1] != w[0] for w in want.values())  # a chain of forms
    assert spelling.variants(docs.limit(0)).count() == 0


def test_filters_lose_no_word_and_rule_out_most_others(spark):
    rng = random.Random(6)
    words = sorted({"".join(rng.choice("abcdefgh") for _ in range(rng.randint(6, 9))) for _ in range(3_000)})
    table = spark.createDataFrame([(w, 5) for w in words], "word string, n long")
    known = spelling.hashed(table)
    bloom = spelling.filters(known)
    for length in (6, 7, 8, 9):
        same = [w for w in words if len(w) == length]
        block, mask = spelling._place(spelling._hash(spelling._code_points(same), spelling._BASES[0]), len(bloom[length]))
        assert (bloom[length][block] & mask == mask).all()
    passed = spelling.positives(known, bloom).count()
    probed = sum(len(w) * 90 for w in words)
    assert passed < probed * 0.05


def test_queries_on_the_small_tables(spark):
    def table(name, *columns):
        return [tuple(r) for r in spark.read.parquet(f"{SF}/{name}.parquet").select(*columns).collect()]

    got = sorted(map(tuple, queries.op11_topk(spark, SF).collect()))
    assert got == best_rows(table("embeddings", "vec_id", F.col("embedding").cast("array<double>")), 100, 10)
    got = {r.conv_id: tuple(r[c] for c in NAMES) for r in queries.op12_conversation_repair(spark, SF).collect()}
    assert got == repaired_by_hand(table("conversations", "conv_id", "turn", "role", "text"))
    got = {r.word: (r.form, r.root, r.n, r.n_near, r.form_n) for r in queries.op13_spelling(spark, SF).collect()}
    assert got == variants_by_hand(table("documents", "doc_id", "text"))
