"""Every corpus operator against brute force, and on odd rows."""

import hashlib
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from rareflow.llm import (
    components,
    exact_dedup,
    language_id,
    license_scan,
    mixing,
    packing,
    quality_nbsvm,
    quality_rules,
    queries,
    sharding,
    simhash,
    toxicity,
)
from rareflow.llm.common import documents, labels

WORD = r"[^\x20\x09-\x0D]+"
SCHEMA = (
    "doc_id long, text string, lang string, source string, n_chars long, "
    "id string, line string, label string, words string, size string, key string, fp string, _id string, place string"
)
PROSE = "one two three four five six seven eight nine ten eleven twelve thirteen"
TEXTS = [
    None, "", " \n\t", PROSE, PROSE, PROSE.replace(" ", "  "), PROSE + " x" * 30_000, "!!! ### 123", "a", "A\na\n\nA\nA b",
    "Released under the MIT License.", "d\u00e9j\u00e0 vu \u4e2d\u6587 <|endoftext|> end", PROSE + "\n" + PROSE,
]


@pytest.fixture(scope="module")
def odd(spark):
    rows = [(i, t, "en" if i % 3 else None, None if i % 4 == 0 else f"s{i % 3}", None) for i, t in enumerate(TEXTS)]
    rows += [rows[3], (None, PROSE, None, None, None), (None, None, None, None, None)]
    return spark.createDataFrame([(*r, *["clash"] * 9) for r in rows], SCHEMA)


@pytest.fixture(scope="module")
def some_labels(spark):
    rows = [(i, i % 2, int(i % 5 == 1)) for i in range(len(TEXTS))] + [(None, 1, 1), (2, None, None), (999, 1, 0)]
    return spark.createDataFrame(rows, "doc_id long, quality int, toxic int")


@pytest.fixture(scope="module")
def docs(spark, sf_dir):
    return documents(spark, sf_dir)


@pytest.fixture(scope="module")
def texts(docs):
    return {r.doc_id: r.text or "" for r in docs.select("doc_id", "text").collect()}


def run_all(spark, docs, labels_, few=False):
    """Row counts of every operator over ``docs``."""
    import public_tokenizers

    out = {
        "exact": exact_dedup.exact_groups(docs),
        "copies": exact_dedup.drop_copies(docs),
        "rules": quality_rules.judge(docs),
        "near": simhash.near_duplicates(docs),
        "near kept": simhash.drop_near_copies(docs),
        "shards": sharding.shard_rows(docs, rounds=2),
        "mix": mixing.taken(docs),
        "mixed": mixing.mixed(docs),
        "packed": packing.pack(docs, public_tokenizers.path("byte_bpe_50k.json")),
        "language": language_id.train_and_identify(docs),
        "quality": quality_nbsvm.score(docs, quality_nbsvm.train(docs, labels_)),
        "toxic": toxicity.score(docs, toxicity.train(docs, labels_)),
        "clean": toxicity.drop_toxic(docs, labels_),
    }
    return {k: v.collect() for k, v in out.items()}


def test_odd_rows(spark, odd, some_labels):
    got = run_all(spark, odd, some_labels)
    n = odd.count()
    for name in ("exact", "rules", "near", "shards", "mix", "language", "quality", "toxic"):
        assert len(got[name]) == n, name
    # equal texts: null, "" ; blanks ; the prose six times in two spellings; the rest alone
    assert len(got["copies"]) == len({re.sub(r"[\x20\x09-\x0D]+", " ", t or "") for t in TEXTS})
    assert sum(r.kept for r in got["exact"]) == len(got["copies"])
    assert got["copies"][0].asDict().keys() == set(odd.columns)
    assert got["mixed"][0].asDict().keys() == set(odd.columns)
    assert {r.lang_pred for r in got["language"] if r.doc_id in (0, 1, 2, 7)} == {"und"}
    assert all(0 <= r.score <= 1 for k in ("quality", "toxic", "language") for r in got[k])
    assert len({r.fp for r in got["near"] if r.doc_id in (0, 1, 2)}) == 1
    assert len({(r.doc_id, r.start) for r in got["packed"] if r.doc_id in (0, 1)}) == 2


def test_empty_tables(spark, odd, some_labels):
    got = run_all(spark, odd.limit(0), some_labels.limit(0))
    assert all(rows == [] for rows in got.values())


def test_licences_on_odd_rows(spark, odd):
    model = license_scan.train(odd)
    found = license_scan.scan(odd, model).collect()
    assert [(r.doc_id, r.paragraph, r.family, r.confirmed) for r in found] == [(10, 0, "mit", True)]
    assert license_scan.scan(odd.limit(0), model).collect() == []
    foreign = spark.createDataFrame([(1, "Released under the EUPL license."), (2, "Ouen the of nterti. All rights reserved.")], "doc_id long, text string")
    got = {r.doc_id: r.family for r in license_scan.scan(foreign, model).collect()}
    assert got.get(1) in (None, "unknown") and got.get(2) in ("proprietary", "unknown")


def test_every_template_has_a_telling_word():
    for notices in license_scan.TEMPLATES.values():
        for known in map(license_scan.known_words, notices):
            assert len(set(known) & license_scan.COMMON) < license_scan.CONFIRMING * len(known)


def test_licences_wrapped_over_lines(spark, docs):
    gpl = (
        "This program is free software: you can redistribute it and/or modify\n"
        "it under the terms of the GNU General Public License as published by\n"
        "the Free Software Foundation, either version 3 of the License, or\n"
        "(at your option) any later version."
    )
    rows = [
        (1, gpl), (2, "# Some words here\n#\n# " + gpl.replace("\n", "\n# ")),
        (3, "Licensed under the Apache\nLicense, Version 2.0."),
        (4, "Ouen the of nterti.\nReleased under the MIT License.\nOuen the of nterti."),
        (5, "This program is free software: you can redistribute it\n\nand modify it"),
        (6, "\n".join("Redistribution and use in source and binary forms, with or without modification, are permitted.".split())),
    ]
    model = license_scan.train(docs)
    got = defaultdict(list)
    for r in license_scan.scan(spark.createDataFrame(rows, "doc_id long, text string"), model).collect():
        if r.confirmed:
            got[r.doc_id].append((r.paragraph, r.family))
    assert got[1] == [(0, "gpl-3.0")] and got[2] == [(2, "gpl-3.0")] and got[4] == [(1, "mit")]
    assert got[3] == [(0, "apache-2.0")] and [f for _, f in got[6]] == ["bsd"] and got[5] == []


def test_lines_of_their_own_stay_as_they_were(docs):
    model = license_scan.train(docs)
    lines = model.chances(license_scan.paragraphs(docs)).where("none < 0.5")
    lines = lines.withColumn("s", license_scan.similarity(F.col("words"), F.col("family")))
    sure = lines.where((F.col("chance") >= model.least) & (F.col("s") >= license_scan.CONFIRMING))
    want = {(r.id, r.paragraph, r.family) for r in sure.collect()}
    got = {(r.doc_id, r.paragraph, r.family) for r in license_scan.scan(docs, model).where("confirmed").collect()}
    assert want and want <= got


def test_exact_groups(docs, texts):
    groups = defaultdict(list)
    for i, t in texts.items():
        groups[re.sub(r"[\x20\x09-\x0D]+", " ", t)].append(i)
    want = {i: (min(g), len(g), i == min(g)) for g in groups.values() for i in g}
    got = {r.doc_id: (r.keep_id, r.group_size, r.kept) for r in exact_dedup.exact_groups(docs).collect()}
    assert got == want


def test_rule_order_does_not_change_verdicts(docs):
    names = list(quality_rules.RULES)
    a, b = (quality_rules.judge(docs, order=o).orderBy("doc_id").collect() for o in (names, names[::-1]))
    assert a == b


def chain(pairs, ids):
    parent = {i: i for i in ids}

    def find(x):
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    for a, b in pairs:
        a, b = find(a), find(b)
        parent[max(a, b)] = min(a, b)
    return {i: find(i) for i in ids}


def test_components(spark):
    rng = np.random.default_rng(0)
    pairs = [(i, i + 1) for i in range(0, 60)] + [tuple(map(int, rng.integers(100, 160, 2))) for _ in range(40)]
    want = chain(pairs, range(200))
    got = {r.node: r.root for r in components.components(spark.createDataFrame(pairs, "u long, v long")).collect()}
    assert all(want[i] == r for i, r in got.items()) and {a for a, b in pairs if a != b} <= set(got)


def brute_fingerprint(text):
    import xxhash

    w = re.findall(WORD.encode(), re.sub(b"[A-Z]", lambda m: m[0].lower(), text.encode()))
    h = [xxhash.xxh64_intdigest(b" ".join(w[i : i + 3]), 42) for i in range(max(1, len(w) - 2))] if w else []
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def test_simhash_components(docs, texts):
    prints = {i: brute_fingerprint(t) for i, t in texts.items()}
    ids = sorted(prints)
    pairs = [(a, b) for a in ids for b in ids if a < b and (prints[a] ^ prints[b]).bit_count() <= 2]
    got = {r.doc_id: (r.fp % 2**64, r.component_id) for r in simhash.near_duplicates(docs).collect()}
    assert got == {i: (prints[i], root) for i, root in chain(pairs, ids).items()}


def test_crowded_buckets_lose_no_link(spark):
    """More fingerprints around one point than a bucket may pair, and a chain leading away from it."""
    rng = np.random.default_rng(1)
    near = {0} | {1 << int(a) | 1 << int(b) for a, b in rng.integers(0, 62, (300, 2))}
    near |= {0b11, 0b1111, 0b111111, 0b11111111 << 50}
    edges = simhash.linked_fingerprints(spark.createDataFrame([(x,) for x in near], "fp long"))
    got = chain([(r.u, r.v) for r in edges.collect()], near)
    assert got == chain([(a, b) for a in near for b in near if a < b and (a ^ b).bit_count() <= 2], near)


def test_pivots_never_discard_a_link():
    rng = np.random.default_rng(2)
    for _ in range(300):
        a = int(rng.integers(0, 2**63))
        b = a ^ (1 << int(rng.integers(64))) ^ (1 << int(rng.integers(64)))
        assert all(abs((a ^ p % 2**64).bit_count() - (b ^ p % 2**64).bit_count()) <= 2 for p in simhash.pivots())


def test_near_copies_leave_one_row_of_each_group(docs, texts):
    prints = {i: brute_fingerprint(t) for i, t in texts.items()}
    ids = sorted(prints)
    pairs = [(a, b) for a in ids for b in ids if a < b and (prints[a] ^ prints[b]).bit_count() <= 2]
    kept = simhash.drop_near_copies(docs)
    assert kept.columns == docs.columns
    assert sorted(r.doc_id for r in kept.collect()) == sorted(set(chain(pairs, ids).values()))


def test_near_copies_with_repeated_ids(spark):
    """An id that unlike texts share drops neither; rows count by themselves."""
    other = "quite other words stand in this text and nothing is like it at all"
    rows = [(3, PROSE), (5, PROSE), (5, other), (None, PROSE), (7, None), (8, ""), (None, other + " x y z")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = {(r.doc_id, r.text) for r in simhash.drop_near_copies(docs).collect()}
    assert got == {(3, PROSE), (5, other), (7, None), (None, other + " x y z")}


def test_packing_round_trip(spark, sf_dir, texts):
    import public_tokenizers
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    ids = {i: [*t.encode(x, add_special_tokens=False).ids, 0] for i, x in texts.items()}
    pieces = queries.harmonic_packing(spark, sf_dir).collect()
    by_doc, by_seq = defaultdict(list), defaultdict(list)
    for p in pieces:
        part = ids[p.doc_id][p.start : p.start + p.length]
        assert zlib.crc32(np.array(part, "<u4").tobytes()) == p.ids_crc32 and p.doc_tokens == len(ids[p.doc_id])
        by_doc[p.doc_id].append((p.start, p.length))
        by_seq[p.sequence_id].append((p.offset, p.length))
    for i, x in ids.items():
        at = 0
        for start, length in sorted(by_doc[i]):
            assert start == at
            at += length
        assert at == len(x)
    padding = total = 0
    for parts in by_seq.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= 1024
        total += at
        padding += 0 if at & (at - 1) == 0 else 1024 - at
    assert padding < 0.04 * total


def test_short_texts_are_packed_with_little_padding(spark):
    import public_tokenizers

    docs = spark.range(5000).select(F.col("id").alias("doc_id"), F.lit("a b c d e f").alias("text")).coalesce(2)
    rows = packing.pack(docs, public_tokenizers.path("byte_bpe_50k.json")).groupBy("sequence_id").agg(F.sum("length").alias("n")).collect()
    assert sum(0 if r.n & (r.n - 1) == 0 else 1024 - r.n for r in rows) < 0.04 * sum(r.n for r in rows)
    assert max(r.n for r in rows) == 1024


def test_rank_file_has_the_vocabulary():
    import base64

    import public_tokenizers

    path = public_tokenizers.path("byte_bpe_50k.json")
    with open(public_tokenizers.path("byte_bpe_50k.tiktoken"), "rb") as lines:
        ranks = {base64.b64decode(a): int(b) for a, b in (line.split() for line in lines)}
    assert packing.same_vocabulary(path, ranks)
    first, second = list(ranks)[300:302]
    assert not packing.same_vocabulary(path, ranks | {first: ranks[second], second: ranks[first]})
    encoder = packing.Encoder(path, public_tokenizers.path("byte_bpe_50k.tiktoken"))
    assert encoder.fast is not None
    rng = np.random.default_rng(5)
    letters = [chr(c) for c in (*range(9, 127), 0xE4, 0x3A3, 0x4E2D, 0x1F600, 0xD800)]
    for _ in range(400):
        text = "".join(rng.choice(letters, rng.integers(0, 60)))
        assert encoder.ids(text) == encoder.slow.encode(text.encode("utf-8", "replace").decode(), add_special_tokens=False).ids


@pytest.mark.parametrize("ids", [(2**53 + 1, None, -5), ("a", None, "b")])
def test_ids_come_out_as_they_went_in(spark, some_labels, ids):
    import public_tokenizers

    kind = "string" if isinstance(ids[0], str) else "long"
    docs = spark.createDataFrame([(i, PROSE, "en") for i in ids], f"doc_id {kind}, text string, lang string").coalesce(1)
    names = some_labels.select(F.col("doc_id").cast(kind).alias("doc_id"), "quality", "toxic")
    out = [
        packing.pack(docs, public_tokenizers.path("byte_bpe_50k.json")), simhash.near_duplicates(docs),
        toxicity.score(docs, toxicity.train(docs, names)), quality_nbsvm.score(docs, quality_nbsvm.train(docs, names)),
        language_id.train_and_identify(docs),
    ]
    for rows in out:
        assert dict(rows.dtypes)["doc_id"] == ("string" if kind == "string" else "bigint")
        assert {r.doc_id for r in rows.collect()} == set(ids)


def test_columns_that_clash_with_helpers_stay(spark):
    names = "doc_id long, text string, source string, line_number string, fingerprint string, __line string, __full string, mix_times string, mix_of string"
    docs = spark.createDataFrame([(i, PROSE + f" {i % 3}", "a", *"xyzuvw") for i in range(9)], names)
    for out in (exact_dedup.drop_copies(docs), simhash.drop_near_copies(docs), mixing.mixed(docs)):
        rows = out.collect()
        assert out.columns == docs.columns and rows and {tuple(r)[3:] for r in rows} == {tuple("xyzuvw")}


def test_grams_over_the_edge_of_a_piece(monkeypatch):
    text = "\n".join(f"word{i} other{i % 7} A{i}!" for i in range(500))
    whole = quality_nbsvm.Grams().of(text)
    monkeypatch.setattr(quality_nbsvm, "CHUNK_WORDS", 40)
    assert np.array_equal(quality_nbsvm.Grams().of(text), whole)


def test_trigrams_over_the_edge_of_a_piece(monkeypatch):
    text = " .Ab cd,  ef--gh\u00c4\u4e2d 12 x" * 40
    whole = language_id.trigram_counts(text)
    for size in (1, 2, 3, 7, 50):
        monkeypatch.setattr(language_id, "CHUNK", size)
        assert all(np.array_equal(a, b) for a, b in zip(language_id.trigram_counts(text), whole))


def test_mix_of_many_sources(spark):
    docs = spark.range(10_000).select(
        F.col("id").alias("doc_id"), F.concat(F.lit("s"), F.col("id") % 5000).alias("source"), F.lit("some words here now").alias("text")
    )
    got = mixing.taken(docs).groupBy("source").agg(F.sum("taken").alias("took"), F.max("target").alias("goal")).collect()
    assert len(got) == 5000 and all(abs(r.took - r.goal) <= 0.5 for r in got)


def test_rule_costs_stand_clear_of_an_empty_rule(spark):
    text = "some words stand here, one after the other! " * 60
    sample = spark.createDataFrame([(text,)] * 60, "text string").coalesce(1).persist()
    rules = {"none": lambda: F.length("text") < 0, "slow": lambda: F.length(F.regexp_replace("text", "[aeiou]+", "")) < 0}
    costs = quality_rules.rule_costs(sample, rules)
    assert costs["slow"] > 5 * costs["none"]


def test_pieces_cover_every_length():
    for n in range(1, 4000):
        pieces = packing.pieces_of(n)
        assert sum(p for p, _ in pieces) == n and all(p * k <= 1024 and p > 0 for p, k in pieces)


def test_shards_stay_even_and_keep_groups(spark, docs):
    first, last = (sharding.shard_rows(docs, rounds=r).collect() for r in (0, 6))
    text = {r.doc_id: hashlib.sha256((r.text or "").encode()).hexdigest() for r in docs.collect()}

    def cut(rows):
        shards = defaultdict(set)
        for r in rows:
            shards[text[r.doc_id]].add(r.shard)
        return sum(len(s) - 1 for s in shards.values())

    counts = Counter(r.shard for r in last)
    assert max(counts.values()) - min(counts.values()) <= 1 and len(counts) == 24
    for s, n in counts.items():
        assert sorted(r.slot for r in last if r.shard == s) == list(range(n))
    assert cut(last) < 0.3 * cut(first)


def test_quotas_keep_counts():
    wanted, spare = {(0, 1): 7, (1, 0): 3, (2, 0): 5}, {0: 1, 1: 2, 2: 0}
    linked, filling = sharding.quotas(wanted, spare, 3)
    for a in range(3):
        out = sum(n for m in (linked, filling) for (x, _), n in m.items() if x == a)
        into = sum(n for m in (linked, filling) for (_, y), n in m.items() if y == a)
        assert out == into
    assert all(n <= wanted.get(k, 0) for k, n in linked.items())


def test_mix_comes_near_its_targets(docs):
    rows = mixing.taken(docs).collect()
    took, goal = Counter(), {}
    for r in rows:
        assert r.taken <= 3 * r.size
        took[r.source] += r.taken
        goal[r.source] = r.target
    assert all(abs(took[s] - g) <= 0.02 * g + 5 for s, g in goal.items())
    assert sorted(r.taken for r in mixing.taken(docs.repartition(5)).collect()) == sorted(r.taken for r in rows)


def test_mix_keeps_sources_below_a_block(spark):
    def of(n, words, source):
        text = F.array_join(F.array_repeat(F.lit("word"), words), " ")
        return spark.range(n).select(F.concat(F.lit(f"{source}-"), "id").alias("doc_id"), text.alias("text"), F.lit(source).alias("source"))

    tiny, none = of(4, 5, "a"), of(10, 10, None)
    odd = of(1, 1, "b").unionByName(of(3, 0, "c"))
    docs = of(20_000, 400, "huge").unionByName(of(500, 400, "z")).unionByName(tiny).unionByName(none).unionByName(odd)
    assert mixing.block_words(20_000 * 400) > 100
    rows = mixing.taken(docs)
    got = {r.source: (r.took, r.target, r.least) for r in rows.groupBy("source").agg(
        F.sum("taken").alias("took"), F.max("target").alias("target"), F.min("taken").alias("least")).collect()}
    assert got["a"] == (60, 60.0, 15) and got[None] == (300, 300.0, 30) and got["b"] == (3, 3.0, 3) and got["c"][0] == 0
    assert all(abs(took - target) <= 0.5 for took, target, _ in got.values())
    kept = Counter(r.source for r in mixing.mixed(docs).where("source is null or source in ('a', 'b', 'c')").collect())
    assert kept == {"a": 12, None: 30, "b": 3, "c": 3}


def test_mix_spreads_sources_over_slots(docs):
    counts = [0, 700, 1, 299, 3000, 2]
    slots = sorted((r.slot, r.place, r.rank) for r in mixing.schedule(docs, counts).collect())
    assert [s for s, _, _ in slots] == list(range(sum(counts)))
    for place, n in enumerate(counts):
        assert [r for _, p, r in slots if p == place] == list(range(n))
        for start in range(0, len(slots) - 400, 400):
            assert abs(sum(p == place for _, p, _ in slots[start : start + 400]) - 400 * n / len(slots)) <= 4


def test_targets_share_what_a_source_cannot_take():
    got = mixing.targets({"a": 10, "b": 1000, None: 1000})
    assert got["a"] == 30 and abs(sum(got.values()) - 2010) < 1e-6 and got["b"] == 2 * got[None]


def brute_chances(scores, moves):
    import itertools

    total, toxic = 0.0, np.zeros(len(scores))
    for path in itertools.product((0, 1), repeat=len(scores)):
        w = np.exp(sum(s for s, y in zip(scores, path) if y) + sum(moves[a, b] for a, b in zip(path, path[1:])))
        total += w
        toxic += w * np.array(path)
    return toxic / total


def test_forward_backward_equals_enumeration():
    rng = np.random.default_rng(3)
    lengths = np.array([1, 5, 3, 7])
    scores, moves = rng.normal(size=lengths.sum()), rng.normal(size=(2, 2))
    want = np.concatenate([brute_chances(s, moves) for s in np.split(scores, np.cumsum(lengths)[:-1])])
    assert np.allclose(toxicity.token_chances(scores, lengths, moves), want)
    chances, pairs = toxicity.move_chances(scores, lengths, moves)
    assert np.allclose(chances, want) and np.isclose(pairs.sum(), (lengths - 1).sum())


def test_dual_coordinate_descent_meets_its_optimality_conditions():
    rng = np.random.default_rng(4)
    rows = [np.flatnonzero(rng.random(12) < 0.4) for _ in range(60)]
    values, signs = rng.normal(size=12), rng.choice([-1, 1], 60)
    w = quality_nbsvm.dual_coordinate_descent(rows, values, signs, penalty=0.2, epochs=400)
    share = {s: (signs == s).mean() for s in (-1, 1)}

    def loss(v):
        return 0.5 * v @ v + sum(0.2 * 0.5 / share[s] * max(0, 1 - s * (v[r] @ values[r] + v[-1])) for r, s in zip(rows, signs))

    assert all(loss(w) <= loss(w + 0.05 * rng.normal(size=13)) + 1e-6 for _ in range(200))


@pytest.mark.parametrize(
    "name, column, label, least",
    [("op1_toxicity_crf", "predicted", "toxic", 0.93), ("op8_quality_nb_svm", "predicted", "quality", 0.95)],
)
def test_held_out_accuracy(spark, name, column, label, least):
    sf_dir = "/root/testdata/sf0.01"
    got = queries.QUERIES[name](spark, sf_dir).where("held_out").join(labels(spark, sf_dir), "doc_id")
    assert got.agg(F.avg((F.col(column) == F.col(label)).cast("int"))).first()[0] >= least


def test_language_accuracy(spark):
    sf_dir = "/root/testdata/sf0.01"
    got = queries.language_hyperdimensional(spark, sf_dir).where("held_out").join(documents(spark, sf_dir), "doc_id")
    assert got.agg(F.avg((F.col("lang_pred") == F.col("lang")).cast("int"))).first()[0] >= 0.97


def test_pipeline_stages(spark, sf_dir, docs):
    kept, sizes = docs, [docs.count()]
    for name, stage in corpus_pipeline.STAGES[:-1]:
        kept = corpus_pipeline.written(stage(spark, kept, sf_dir), f"test-{name}")
        assert kept.columns == docs.columns
        sizes.append(kept.count())
    assert sizes[0] > sizes[1] > sizes[2] >= sizes[3]
    packed = corpus_pipeline.STAGES[-1][1](spark, kept, sf_dir)
    assert packed.agg(F.countDistinct("doc_id")).first()[0] == kept.select("doc_id").distinct().count()
