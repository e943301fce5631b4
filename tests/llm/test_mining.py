"""Prefix trie, collocations and vantage-point trees against brute force, and on odd rows."""

import hashlib
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from rareflow.llm import collocations, prefix_trie, vantage
from rareflow.llm.common import documents


# ---- prefix trie -----------------------------------------------------------

CLASH = "path string, sizes string, shard string, skeleton string, kind string"


def brute_trie(rows):
    """{(conv_id, depth, parent, n_convs, n_children, n_leaves, saved, ends)} from (conv_id, turn, role, text) rows."""
    own = {}
    for conv, turn, role, text in rows:
        if conv is not None:
            role, text = role or "", text or ""
            digest = hashlib.sha256(f"{len(role)}:{role}:{text}".encode()).hexdigest()
            own.setdefault(conv, []).append((turn is not None, turn or 0, digest, role, text))
    rebuilt = {}
    for conv, turns in own.items():
        h = zlib.crc32(str(conv).encode()) % 6
        block = conv - int(np.fmod(conv, 100))
        rebuilt[conv] = [t[3:] for t in sorted(own.get(block, []))[:h]] + [t[3:] for t in sorted(turns)[h:]]
    members, ends, children = {}, {}, {}
    for conv, path in rebuilt.items():
        for d in range(len(path) + 1):
            members.setdefault(tuple(path[:d]), []).append(conv)
        ends.setdefault(tuple(path), []).append(conv)
    for node in members:
        if node:
            children.setdefault(node[:-1], []).append(node)
    leaves, saved, out = {}, {}, []
    for node in sorted(members, key=len, reverse=True):
        kids = children.get(node, [])
        leaves[node] = sum(leaves[k] for k in kids) or 1
        saved[node] = sum(saved[k] for k in kids) + ((len(members[node]) - 1) * len(node[-1][1]) if node else 0)
        ids = ",".join(map(str, sorted(ends.get(node, []))))
        out.append(
            (min(members[node]), len(node), min(members[node[:-1]]) if node else None, len(members[node]), len(kids),
             leaves[node], saved[node], hashlib.sha256(ids.encode()).hexdigest())
        )
    return Counter(out)


def trie(spark, rows, shards=None):
    df = spark.createDataFrame([(*r, *["clash"] * 5) for r in rows], f"conv_id long, turn long, role string, text string, {CLASH}")
    return Counter(tuple(r) for r in prefix_trie.prefix_nodes(df, shards=shards).collect())


@pytest.fixture(scope="module")
def talks():
    """Shared beginnings, a conversation that a third of all are copies of, short and long ones, odd turns."""
    rng = np.random.default_rng(6)
    rows = []
    for conv in range(400):
        if conv % 3 == 0 or conv % 100 == 0:
            turns = [("user", "hot"), ("bot", "hot too")] * 5
        else:
            turns = [("user" if i % 2 else "bot", f"t{rng.integers(0, 3)}" * int(rng.integers(1, 4))) for i in range(rng.integers(1, 9))]
        rows += [(conv, i, r, t) for i, (r, t) in enumerate(turns)]
    rows += [(700, i, "user", "deep中") for i in range(300)] + [(701, i, "user", "deep中") for i in range(280)]
    rows += [(900, None, None, None), (900, 1, "user", ""), (900, 1, "user", ""), (901, 0, "", "user"), (-5, 0, "user", "minus"), (-105, 0, "user", "minus")]
    rows += [(None, 0, "user", "nobody's"), (1205, 0, "user", "x"), (1206, 0, "us", "erx")]
    return rows


@pytest.mark.parametrize("shards", [1, 2, 7, 40])
def test_trie_equals_brute_force(spark, talks, shards):
    assert trie(spark, talks, shards) == brute_trie(talks)


def test_hot_conversation_spreads_over_shards(spark, talks, monkeypatch):
    """Long lists of ids go in chunks, and a splitter cut short is still a splitter."""
    monkeypatch.setattr(prefix_trie, "CHUNK", 64)
    monkeypatch.setattr(prefix_trie, "BATCH_ROWS", 10)
    monkeypatch.setattr(prefix_trie, "SPLITTER_TURNS", 12)
    assert trie(spark, talks, 9) == brute_trie(talks)
    convs = prefix_trie.rebuilt(spark.createDataFrame(talks, "conv_id long, turn long, role string, text string"))
    cuts = prefix_trie.find_splitters(convs, 400, 9)
    hot = Counter(p for p, _ in cuts).most_common(1)[0]
    assert hot[1] >= 2 and cuts == sorted(cuts) and max(len(p) for p, _ in cuts) <= 12 * prefix_trie.DIGITS


def test_trie_of_nothing(spark):
    assert not trie(spark, []) and not trie(spark, [(None, 1, "user", "x")])
    # without its base, this conversation keeps no turn and is a member of the root alone
    lone = next(c for c in range(101, 200) if zlib.crc32(str(c).encode()) % 6)
    assert trie(spark, [(lone, 0, "user", "x")]) == Counter(
        [(lone, 0, None, 1, 0, 1, 0, hashlib.sha256(str(lone).encode()).hexdigest())]
    )


def test_skeleton_holds_every_splitter_prefix():
    a, b, c = "a" * 32, "b" * 32, "c" * 32
    child, parent = prefix_trie.skeleton_of([(a + b, 1), (a + b, 9), (a + c, 2), ("", 4)])
    assert parent == [-1, 0, 1, 1] and child == {(0, a): 1, (1, b): 2, (1, c): 3}


# ---- collocations ----------------------------------------------------------


def brute_phrases(docs, least, reported=2000):
    counts, totals = {}, Counter()
    for text, lang in docs:
        lang = "und" if lang is None else lang
        totals[lang] += 0
        low = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", low):
            w = re.findall(r"[^\x20\x09]+", piece)
            totals[lang] += len(w)
            for m in range(1, 5):
                for i in range(len(w) - m + 1):
                    key = (lang, tuple(w[i : i + m]))
                    counts[key] = counts.get(key, 0) + 1
    often = {k: a for k, a in counts.items() if a >= least}
    out = []
    for (lang, g), a in often.items():
        if len(g) < 2:
            continue
        inside = [
            b for (other, long), b in often.items()
            if other == lang and len(long) > len(g) and any(long[i : i + len(g)] == g for i in range(len(long)))
        ]
        if any(100 * b >= 80 * a for b in inside):
            continue
        cuts = [(2_000_000 * a // (counts[lang, g[:k]] + counts[lang, g[k:]]), k) for k in range(1, len(g))]
        score, k = min(cuts)
        out.append((lang, -score, -a, " ".join(g).encode(), counts[lang, g[:k]], counts[lang, g[k:]]))
    rows, rank = [], Counter()
    for lang, score, a, phrase, l, r in sorted(out):
        rank[lang] += 1
        if rank[lang] <= reported:
            rows.append((lang, rank[lang], phrase.decode(), -a, l, r, totals[lang], -score))
    return sorted(rows)


@pytest.fixture(scope="module")
def prose(spark):
    rng = np.random.default_rng(8)
    docs = []
    for i in range(240):
        words = [f"w{int(x)}" for x in rng.zipf(1.4, 30) % 12]
        words[5:5] = ["New", "york", "city"] if i % 3 else ["new", "York", "times"]
        text = " ".join(w + (rng.choice([",", ".", "!", "\n", "\t"]) if rng.random() < 0.1 else "") for w in words)
        docs.append((text, [None, "en", "é"][i % 3 if i % 7 else 1]))
    docs += [("a a a a a a a", "en")] * 12 + [(None, "en"), ("", None), ("...", "en"), ("ÄB äb Äb", "de"), ("x" * 100_000 + " y", "en")]
    return docs


@pytest.mark.parametrize("broadcast_rows", [0, 600_000])
def test_collocations_equal_brute_force(spark, prose, broadcast_rows):
    df = spark.createDataFrame([(t, l, 1, 2, 3) for t, l in prose], "text string, lang string, part int, at int, id int").repartition(3)
    got = collocations.collocations(df, least=12, reported=25, broadcast_rows=broadcast_rows)
    assert sorted(map(tuple, got.collect())) == brute_phrases(prose, 12, 25)
    assert not [t for t in spark.catalog.listTables() if t.name.startswith("occurrences_")]


@pytest.mark.parametrize("packed_rows, broadcast_rows", [(0, 0), (0, 600_000), (60, 0), (60, 600_000), (600_000, 0)])
def test_collocations_as_rows_and_packed(spark, prose, packed_rows, broadcast_rows, monkeypatch):
    monkeypatch.setattr(collocations, "CHUNK_BYTES", 500)
    monkeypatch.setattr(collocations, "PAIRS_AT_ONCE", 100)
    monkeypatch.setattr(collocations, "PAIRS_A_RANGE", 1000)
    df = spark.createDataFrame([(t, l, 1) for t, l in prose], "text string, lang string, names int").repartition(3)
    got = collocations.collocations(df, least=12, reported=25, broadcast_rows=broadcast_rows, packed_rows=packed_rows)
    assert sorted(map(tuple, got.collect())) == brute_phrases(prose, 12, 25)


def test_packed_relations_join_without_a_shuffle(spark, prose):
    texts = spark.createDataFrame(prose, "text string, lang string").select(F.coalesce("text", F.lit("")).alias("text"), "lang")
    runs = collocations.word_runs(texts.na.fill("und", ["lang"]))
    assert runs.agg(F.sum(F.aggregate("counts", F.lit(0).cast("long"), lambda a, x: a + x))).first()[0] == runs.agg(F.sum(F.length("gaps"))).first()[0]
    packed = runs.select("gaps", F.col("codes").alias("ids"))
    table = spark.sparkContext.broadcast((np.array([1 << 32 | 2]), np.array([7], np.int32)))
    kept = collocations.frequent_pairs(packed, table)
    plan = kept._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Sort" not in plan


def test_collocations_of_the_table(spark, sf_dir):
    docs = documents(spark, sf_dir)
    rows = [(r.text, r.lang) for r in docs.select("text", "lang").collect()]
    assert sorted(map(tuple, collocations.collocations(docs).collect())) == brute_phrases(rows, 30)


def test_collocations_of_nothing(spark):
    df = spark.createDataFrame([("one two", "en"), (None, None)], "text string, lang string")
    assert collocations.collocations(df).collect() == [] and collocations.collocations(df.limit(0)).collect() == []


def test_words_keep_their_neighbours():
    import pyarrow as pa

    rng = np.random.default_rng(2)
    letters = ["a", "B", " ", "\t", ".", "\n", "é", "x1", "中"]
    for _ in range(300):
        texts = ["".join(rng.choice(letters, rng.integers(0, 12))) for _ in range(rng.integers(0, 6))]
        split, got, want = collocations.Words(), [], []
        half = len(texts) // 2
        for base, part in ((0, texts[:half]), (half, texts[half:])):
            words, rows, at = split.split(pa.array(part, pa.string()))
            got += list(zip(words.to_pylist(), (rows + base).tolist(), at.tolist()))
        for i, text in enumerate(texts):
            for j, piece in enumerate(re.split(r"[.,;:!?\x0A-\x0D]", text)):
                want += [(re.sub("[A-Z]", lambda m: m[0].lower(), w), i, j) for w in re.findall(r"[^\x20\x09]+", piece)]
        assert [g[:2] for g in got] == [w[:2] for w in want]
        for (a, b), (u, v) in zip(zip(got, got[1:]), zip(want, want[1:])):
            assert (b[2] - a[2] == 1) == (u[1:] == v[1:]) and b[2] > a[2]


def test_products_pass_64_bits(spark):
    big = 4_000_000_000_000_000_000
    row = spark.createDataFrame([("en", "p q", 1, big, [big], [big])], "lang string, phrase string, id long, n long, before array<long>, after array<long>")
    # l + r would pass 64 bits, too
    row = row.withColumn("after", F.array(F.lit(big).cast("long"))).withColumn("before", F.array(F.lit(big).cast("long")))
    got = collocations.score_cuts(row).first()
    assert (got.a, got.l, got.r, got.score) == (big, big, big, 1_000_000)


def test_join_of_neighbours_needs_no_shuffle(spark):
    rows = spark.range(1000).select((F.col("id") % 3).cast("int").alias("part"), F.col("id").alias("at"), (F.col("id") % 7).alias("id"))
    with collocations.Relations(spark) as relations:
        relations.buckets = 4
        pairs = collocations.adjacent(relations.keep(rows, 1))
        plan = pairs._jdf.queryExecution().executedPlan().toString()
        assert "SortMergeJoin" in plan and "Exchange" not in plan
        assert pairs.count() == 0
    assert not [t for t in spark.catalog.listTables() if t.name.startswith("occurrences_")]


# ---- vantage-point trees ---------------------------------------------------


def brute_nearest(rows, k, every):
    fine = [(i, np.array(v)) for i, v in rows if i is not None and v and all(x is not None and np.isfinite(x) for x in v) and any(v)]
    out = []
    for n, (i, q) in enumerate(fine):
        if i % every:
            continue
        near = []
        for m, (j, v) in enumerate(fine):
            if m != n and len(v) == len(q):
                s = 0.0
                for x, y in zip(q.tolist(), v.tolist()):
                    s += x * y
                near.append((-s, j))
        out += [(i, r + 1, j, -s) for r, (s, j) in enumerate(sorted(near)[:k])]
    return sorted(out)


@pytest.fixture(scope="module")
def vectors():
    rng = np.random.default_rng(3)
    rows = [(i, (rng.normal(size=6) * rng.uniform(0.1, 3)).tolist()) for i in range(700)]
    hot = rng.normal(size=6).tolist()
    rows += [(700 + i, hot) for i in range(350)]
    rows += [(5000, None), (5001, [0.0] * 6), (5002, [1.0, None, 0.0, 0.0, 0.0, 0.0]), (5003, [float("nan")] * 6), (5004, [float("inf")] + [0.0] * 5)]
    rows += [(5010, []), (5020, [1.0, 2.0]), (5030, [2.0, 1.0]), (None, hot), (5040, [1e-300] * 6), (5050, [1e200, -1e200, 0.0, 0.0, 0.0, 0.0])]
    return rows


@pytest.mark.parametrize("shard_rows, block_rows, leaf", [(8192, 1024, 256), (100, 7, 8), (37, 50, 1)])
def test_neighbours_equal_brute_force(spark, vectors, shard_rows, block_rows, leaf, monkeypatch):
    monkeypatch.setattr(vantage, "LEAF_ROWS", leaf)
    df = spark.createDataFrame([(*r, "a", "b") for r in vectors], "vec_id long, embedding array<double>, shard string, row string")
    got = vantage.nearest(df, k=7, every=10, shard_rows=shard_rows, block_rows=block_rows)
    assert sorted(map(tuple, got.collect())) == brute_nearest(vectors, 7, 10)


def test_neighbours_of_repeated_ids_and_few_rows(spark):
    rows = [(20, [1.0, 0.0]), (20, [1.0, 0.0]), (3, [0.5, 0.5]), (40, [0.0, 1.0])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    got = Counter((r.query_id, r["rank"], r.vec_id) for r in vantage.nearest(df).collect())
    assert got == Counter({(20, 1, 20): 2, (20, 2, 3): 2, (20, 3, 40): 2, (40, 1, 3): 1, (40, 2, 20): 1, (40, 3, 20): 1})
    assert vantage.nearest(df.limit(0)).collect() == [] and vantage.nearest(df.where("vec_id = 3")).collect() == []


def test_larger_factors_save_work_and_keep_recall():
    """On clustered vectors a factor of two works out fewer products and finds over 0.9 of the neighbours."""
    rng = np.random.default_rng(4)
    points = np.repeat(rng.normal(size=(40, 8)) * 4, 50, axis=0) + rng.normal(size=(2000, 8)) * 0.4
    points /= np.linalg.norm(points, axis=1)[:, None]
    tree = vantage.build_tree(points, 32)
    queries, own = points[::20], np.array([int(np.flatnonzero(tree.order == i)[0]) for i in range(0, 2000, 20)])
    floor, work, found = np.full(len(queries), -np.inf), {}, {}
    for factor in (1.0, 2.0, 1e9):
        q, p, work[factor] = vantage.search_tree(tree, queries, own, floor, 20, factor)
        score = vantage.exact_products(queries[q], tree.points[p])
        by = np.lexsort((tree.order[p], -score, q))
        rank = np.arange(len(q)) - np.searchsorted(q[by], q[by])
        found[factor] = {(int(a), int(b)) for a, b in zip(q[by][rank < 20], tree.order[p[by]][rank < 20])}
    scores = queries @ points.T
    scores[np.arange(len(queries)), np.arange(0, 2000, 20)] = -np.inf
    want = {(i, int(j)) for i in range(len(queries)) for j in np.argsort(-scores[i], kind="stable")[:20]}
    assert found[1.0] == want and len(found[2.0] & want) >= 0.9 * len(want)
    assert work[1e9] < work[2.0] < work[1.0] < 0.8 * len(queries) * 2000


def test_bounds_never_exceed_true_distances():
    rng = np.random.default_rng(5)
    points, queries = rng.normal(size=(500, 5)), rng.normal(size=(40, 5)) * 2
    tree = vantage.build_tree(points, 10)
    bounds = vantage.least_distances(tree, queries)
    square = (queries**2).sum(axis=1)[:, None] + tree.longest - 2 * queries @ tree.points.T
    for leaf, (a, b) in enumerate(tree.leaves):
        assert (bounds[:, leaf] <= np.sqrt(square[:, a:b]).min(axis=1) + 1e-9).all()
    assert sorted(tree.order.tolist()) == list(range(500)) and sum(b - a for a, b in tree.leaves) == 500
