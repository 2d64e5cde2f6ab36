"""Mixing, source divergence and collocations against brute force, on odd rows and at their edges."""

import collections
import itertools
import math
import random
import re
import tracemalloc

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from docloom.llm import collocations, divergence, mixing
from tests.llm.fixtures import SCHEMA, empty, frame, odd_rows, words

DOC = "doc_id long, text string, lang string, source string"


def docs(spark, rows):
    return spark.createDataFrame(rows, DOC)


# --- mixing ------------------------------------------------------------------------------------


def fill(sizes, weights, budget, epochs):
    """Targets by clamping one source after the other."""
    clamped = set()
    while True:
        rest = budget - sum(epochs * sizes[i] for i in clamped)
        total = sum(w for i, w in enumerate(weights) if i not in clamped)
        over = [i for i, w in enumerate(weights) if i not in clamped and total and w * rest / total > epochs * sizes[i]]
        if not over:
            return [epochs * s if i in clamped else w * rest / total if total else 0 for i, (s, w) in enumerate(zip(sizes, weights))]
        clamped |= set(over)


@pytest.mark.parametrize("seed", range(4))
def test_targets_are_filled_and_met(spark, seed):
    rng = random.Random(seed)
    names = ["b", "", "é", None, "Z", "zz", "a"]
    rows = [(i, words(seed * 1000 + i, rng.randint(0, 30)), "en", rng.choices(names, [60, 1, 5, 30, 2, 2, 8])[0]) for i in range(400)]
    rows.append((9000, words(5, 3000), "en", "zz"))  # one document longer than all others of its source
    got = mixing.plan(docs(spark, rows)).collect()
    assert len(got) == len(rows)
    size = collections.Counter()
    for _, text, _, source in rows:
        size[source] += len(text.split())
    order = sorted((s for s in size if s is not None), key=lambda s: s.encode()) + [None] * (None in size)
    want = dict(zip(order, fill([size[s] for s in order], [(3, 1, 2)[i % 3] for i in range(len(order))], 1.5 * sum(size.values()), 2.0)))
    taken = collections.Counter()
    for r in got:
        taken[r.source] += r.taken
        assert r.source_size == size[r.source] and r.target == pytest.approx(want[r.source], rel=1e-12)
        assert 0 <= r.taken <= 2 * r.size and r.taken == r.copies * r.size + r.cut
    assert all(abs(taken[s] - want[s]) <= 0.5 for s in order)
    assert sum(1 for r in got if r.cut) <= len(order)
    again = mixing.plan(docs(spark, rows).repartition(7)).collect()
    assert sorted(map(tuple, again)) == sorted(map(tuple, got))


def test_many_slices_meet_the_target(spark, monkeypatch):
    monkeypatch.setattr(mixing, "SLICE_ROWS", 3)
    rows = [(i, words(i, 1 + i % 13), "en", "hot" if i % 3 else "cold") for i in range(300)]
    got = mixing.plan(docs(spark, rows), weights=(1, 4), share=0.7)
    for r in got.groupBy("source").agg(F.sum("taken").alias("taken"), F.max("target").alias("target")).collect():
        assert abs(r.taken - r.target) <= 0.5


def test_mixture_holds_what_was_planned(spark):
    rows = [(i, "  " * (i % 2) + words(i, 2 + i), "en", "ab"[i % 2]) for i in range(30)]
    df = docs(spark, rows).withColumn("row", F.lit(1)).withColumn("cut", F.lit("x"))
    planned = mixing.plan(df)
    mixed = mixing.mixture(df, planned)
    assert mixed.columns == df.columns
    had = collections.Counter()
    texts = {i: t for i, t, _, _ in rows}
    for r in mixed.collect():
        had[r.doc_id] += len(r.text.split())
        assert texts[r.doc_id].startswith(r.text)
    assert had == {r.doc_id: r.taken for r in planned.collect() if r.taken}


def test_mixing_of_odd_rows(spark):
    got = mixing.plan(frame(spark, odd_rows()))
    assert got.count() == len(odd_rows()) and mixing.plan(empty(spark)).count() == 0
    none = mixing.plan(docs(spark, [(1, None, None, None), (2, "", "en", "a"), (2, " \t", "en", "a")])).collect()
    assert all((r.size, r.source_size, r.target, r.taken, r.copies, r.cut) == (0, 0, 0.0, 0, 0, 0) for r in none) and len(none) == 3
    assert mixing.mixture(frame(spark, odd_rows()), got).count() > 0
    all_capped = mixing.plan(docs(spark, [(1, "a b", "en", "x"), (2, "c", "en", "y")]), share=9.0).collect()
    assert {(r.doc_id, r.taken) for r in all_capped} == {(1, 4), (2, 2)}


# --- divergence --------------------------------------------------------------------------------


def audit(rows, least=10, top=10):
    groups, langs, held = collections.defaultdict(collections.Counter), collections.defaultdict(collections.Counter), collections.defaultdict(collections.Counter)
    for _, text, lang, source in rows:
        lang, source = lang or "", source or ""
        found = [re.sub("[A-Z]", lambda m: m[0].lower(), t) for t in re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", text or "")]
        groups[lang, source].update(found), langs[lang].update(found), held[lang].update(set(found))
    out = []
    for (lang, source), counts in groups.items():
        kept = [t for t, n in held[lang].items() if n >= least]
        share = lambda c, n, t: 1 + 10**9 * (c[t] + 2) // (n + 2 * len(kept))
        total = {s: sum(c[t] for t in kept) for (other, s), c in groups.items() if other == lang}
        whole = sum(langs[lang][t] for t in kept)
        price = lambda p, q: (p - q) ** 2 // (p + q)
        pairs = [(s, sum(price(share(counts, total[source], t), share(groups[lang, s], total[s], t)) for t in kept)) for s in total if s != source]
        marked = [(t, price(p, q)) for t in kept if counts[t] and (p := share(counts, total[source], t)) > (q := share(langs[lang], whole, t))]
        for part, items, most in (("pair", pairs, None), ("term", marked, top)):
            ranked = sorted(items, key=lambda x: (-x[1], x[0].encode()))[:most]
            out += [(lang, source, part, item, value, rank) for rank, (item, value) in enumerate(ranked, 1)]
    return sorted(out)


def audit_rows(seed):
    rng = random.Random(seed)
    vocabulary = {lang: [words(hash(lang) % 97 + i, 1) + lang for i in range(200)] for lang in ("en", "dé")}
    rows = []
    for i in range(260):
        lang, source = rng.choice(["en", "en", "dé", None]), rng.choice(["a", "a", "a", "b", "C", "é", None, ""])
        draw = vocabulary.get(lang, ["One", "2two"])
        text = " ".join(draw[min(int(rng.expovariate(0.03)), len(draw) - 1)] for _ in range(rng.randint(0, 60)))
        rows.append((i, text.upper() if i % 11 == 0 else text + " x1y_z@é", lang, source))
    return [*rows, (900, "unseen word", "xx", "a"), (901, None, "xx", "b"), (902, "", "en", "bare")]


@pytest.mark.parametrize("block,tile", [(4096, 256), (40, 2)])
def test_audit_equals_brute_force(spark, monkeypatch, block, tile):
    monkeypatch.setattr(divergence, "BLOCK_CELLS", block)
    monkeypatch.setattr(divergence, "BLOCK_GROUPS", tile)
    rows = audit_rows(3)
    got = sorted(map(tuple, divergence.audit(docs(spark, rows).repartition(5)).collect()))
    assert got == audit(rows)


def test_tree_walk_prices_each_pair_once():
    rng = np.random.default_rng(2)
    for rows, others, cols in ((1, 1, 1), (9, 20, 70), (33, 4, 500), (5, 40, 31)):
        one, two = (np.where(rng.random((n, cols)) < 0.02, rng.integers(1, 10**9, (n, cols)), 0) for n in (rows, others))
        e, f = rng.integers(1, 10**6, rows), rng.integers(1, 10**6, others)
        p, q = np.where(one > 0, one, e[:, None]), np.where(two > 0, two, f[:, None])
        want = [[sum(int(a - b) ** 2 // int(a + b) for a, b in zip(p[i], q[j])) for j in range(others)] for i in range(rows)]
        assert divergence.pair_sums(one, two, e, f).tolist() == want
    # Only leaves with a cell of either side are visited.
    sparse = np.zeros((64, 2048), np.int64)
    sparse[40, 1000] = 5
    tree = divergence.Quadtree(sparse)
    assert len(list(divergence.met_leaves(tree, tree))) == 2 * 64 // divergence.LEAF_GROUPS - 1


def test_shares_of_huge_counts_are_exact(spark):
    n, total, terms = 3 * 10**15 + 7, 8 * 10**15 + 9, 10**6
    got = spark.range(1).select(divergence.share(F.lit(n), F.lit(total), F.lit(terms)).alias("p")).first().p
    assert got == 1 + 10**9 * (n + 2) // (total + 2 * terms)


def test_counts_are_handed_on_in_bounded_memory(spark, monkeypatch):
    monkeypatch.setattr(divergence, "HELD", 5)
    rows = audit_rows(4)
    assert sorted(map(tuple, divergence.audit(docs(spark, rows)).collect())) == audit(rows)


def test_counting_holds_little_however_many_terms_there_are(spark):
    class Table:
        select = mapInArrow = lambda self, first, *rest: self.__dict__.update(task=first) or self
        groupBy = agg = lambda self, *columns: self

    letters = str.maketrans("0123456789", "abcdefghij")
    texts = [" ".join(f"w{w:07d}".translate(letters) for w in range(at, at + 1000)) for at in range(0, 1_000_000, 1000)]
    batches = [pa.RecordBatch.from_arrays([pa.array(["en"] * 50), pa.array(["a", "b"] * 25), pa.array(texts[at:at + 50])], ["lang", "source", "text"])
               for at in range(0, 1000, 50)]
    table, n = Table(), 0
    divergence.count_terms(table)
    tracemalloc.start()
    try:
        for batch in table.task(iter(batches)):
            n += int(batch.column("n").to_numpy().sum())
        assert tracemalloc.get_traced_memory()[1] < 120e6
    finally:
        tracemalloc.stop()
    assert n == 1_000_000


@pytest.mark.parametrize("piece", [3, 90, 10_000])
def test_terms_are_counted_over_stretches_and_long_texts(monkeypatch, piece):
    monkeypatch.setattr(divergence, "PIECE_BYTES", piece)
    texts = [r[1] or "" for r in audit_rows(5)] + ["", "Z" * 50, "a9b-c" * 40, "é", "Éa éA"]
    group = np.arange(len(texts)) % 3
    got = divergence.Entries.joined(list(divergence._counted(pa.array(texts).slice(0), group)))
    ends = np.cumsum(got.lengths)
    named = {(int(g), got.data[e - n:e].tobytes().decode()): (int(c), int(d)) for g, e, n, c, d in zip(got.group, ends, got.lengths, got.n, got.docs)}
    n, held = collections.Counter(), collections.Counter()
    for text, g in zip(texts, group.tolist()):
        found = [re.sub("[A-Z]", lambda m: m[0].lower(), t) for t in re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", text)]
        n.update((g, t) for t in found)
        held.update((g, t) for t in set(found))
    assert named == {k: (n[k], held[k]) for k in n}


def test_audit_of_odd_rows(spark):
    rows = odd_rows()
    got = sorted(map(tuple, divergence.audit(frame(spark, rows), least_docs=2).collect()))
    assert got == audit([r[:4] for r in rows], least=2) and got
    assert divergence.audit(empty(spark)).count() == 0


# --- collocations ------------------------------------------------------------------------------


def phrases(rows):
    counts, totals = collections.defaultdict(collections.Counter), collections.Counter()
    for _, text, lang, _ in rows:
        text = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", text):
            w = re.findall(r"[^\x20\x09]+", piece)
            totals["und" if lang is None else lang] += len(w)
            for n in range(1, 5):
                counts["und" if lang is None else lang].update(tuple(w[i:i + n]) for i in range(len(w) - n + 1))
    return counts, totals


def mine(rows, support=30, top=2000):
    counts, totals = phrases(rows)
    out = []
    for lang, f in counts.items():
        found = {p: a for p, a in f.items() if len(p) > 1 and a >= support}
        inner = collections.Counter()
        for p, a in found.items():
            for i, j in itertools.combinations(range(len(p) + 1), 2):
                if 1 < j - i < len(p):
                    inner[p[i:j]] = max(inner[p[i:j]], a)
        scored = []
        for p, a in found.items():
            if 100 * inner[p] >= 80 * a:
                continue
            score, _, left, right = min((2_000_000 * a // (f[p[:k]] + f[p[k:]]), k, f[p[:k]], f[p[k:]]) for k in range(1, len(p)))
            scored.append((-score, -a, " ".join(p).encode(), left, right))
        out += [(lang, n, p.decode(), -a, x, y, totals[lang], -s) for n, (s, a, p, x, y) in enumerate(sorted(scored)[:top], 1)]
    return sorted(out)


def phrase_rows(seed, n=220):
    rng = random.Random(seed)
    vocabulary = [words(i, 1) for i in range(40)]
    fixed = ["New York City", "é à ü", "to be or not", "a a a a a", "kind of"]
    rows = []
    for i in range(n):
        parts = [rng.choice(fixed) if rng.random() < 0.3 else vocabulary[min(39, int(rng.expovariate(0.15)))] for _ in range(rng.randint(0, 40))]
        text = "".join(p + rng.choice([" ", " ", " ", "  ", "\t", ". ", ",", "\n", " ; ", "!?"]) for p in parts)
        rows.append((i, text.upper() if i % 9 == 0 else text, rng.choice(["en", "en", "de", None, "und"]), "s"))
    return rows


@pytest.mark.parametrize("shards", [1, 3, 10])
def test_collocations_equal_brute_force(spark, shards):
    rows = phrase_rows(1)
    got = collocations.collocations(docs(spark, rows).repartition(7), shards=shards, top=60).collect()
    assert sorted((r.lang, r["rank"], r.phrase, r.a, r.l, r.r, r.n, r.score) for r in got) == mine(rows, top=60)


def test_collocations_of_lopsided_shards(spark, monkeypatch):
    # Files sorted by language and topic: what is frequent stands in one shard or is spread thinly over all.
    monkeypatch.setattr(collocations, "HELD", 50)
    rows = [(i, "thin phrase here" if i % 20 == 0 else "thick phrase there" if i < 40 else words(i, 6), "en" if i < 500 else "de", "s") for i in range(700)]
    df = docs(spark, rows).repartitionByRange(7, "doc_id")
    got = collocations.collocations(df, support=25, shards=4).collect()
    assert sorted((r.lang, r["rank"], r.phrase, r.a, r.l, r.r, r.n, r.score) for r in got) == mine(rows, support=25)


def test_crowded_table_only_costs_rows(spark):
    rows = phrase_rows(2, 120)
    got = collocations.collocations(docs(spark, rows), support=20, table_bits=6).collect()
    assert sorted((r.lang, r["rank"], r.phrase, r.a, r.l, r.r, r.n, r.score) for r in got) == mine(rows, support=20)


def test_mining_drops_only_what_cannot_reach_the_support(spark):
    rows = phrase_rows(5)
    df = docs(spark, rows).select(F.coalesce("lang", F.lit("und")).alias("lang"), F.coalesce("text", F.lit("")).alias("text")).repartition(8)
    found = {(r.lang, r.phrase): r.n for r in collocations.frequent_phrases(df, 30, 4).where("words > 0").collect()}
    counts, _ = phrases(rows)
    assert found == {(lang, " ".join(p)): a for lang, f in counts.items() for p, a in f.items() if a >= 30}


def test_long_texts_are_cut_between_pieces_only(monkeypatch):
    monkeypatch.setattr(collocations, "PIECE_BYTES", 1000)
    text = "ab cd " * 3000 + ". x y! " + "é " * 50
    whole = [w for w in collocations._readings([text, None, "", "z"], np.array([0, 0, 0, 1]))]
    assert sum(map(len, whole)) == 6000 + 2 + 50 + 1 and whole[-1].lang.tolist()[-1] == 1
    # A piece longer than a stretch stays whole; beyond it the cuts fall between pieces.
    parts = ["one piece of words " * 100, *(words(k, 12) for k in range(60))]
    seeds = np.array([3], np.uint64)

    def count(texts):
        out = collections.Counter()
        for w in collocations._readings(texts, np.zeros(len(texts), int)):
            flat, places = w.spelled()
            for n, at, _ in w.hashes(seeds):
                out.update(flat[places[i]:places[i + n] - 1].tobytes() for i in at.tolist())
        return out

    assert count([". ".join(parts)]) == count(parts)


def test_collocations_of_odd_rows(spark):
    rows = odd_rows() * 3
    got = collocations.collocations(frame(spark, rows), support=6).collect()
    assert sorted((r.lang, r["rank"], r.phrase, r.a, r.l, r.r, r.n, r.score) for r in got) == mine([r[:4] for r in rows], support=6)
    assert collocations.collocations(empty(spark)).count() == 0
    assert collocations.collocations(spark.createDataFrame([(1, None, None, None, None)], SCHEMA)).count() == 0


def test_scores_pass_64_bits(spark):
    found = spark.createDataFrame([("en", 0, "", 10**15), ("en", 1, "a", 6 * 10**14), ("en", 1, "b", 5 * 10**14), ("en", 2, "a b", 4 * 10**14)], "lang string, words int, phrase string, n long")
    collocations_of = collocations.frequent_phrases
    try:
        collocations.frequent_phrases = lambda *a, **k: found
        r = collocations.collocations(empty(spark)).first()
    finally:
        collocations.frequent_phrases = collocations_of
    assert (r.a, r.l, r.r, r.score) == (4 * 10**14, 6 * 10**14, 5 * 10**14, math.floor(2_000_000 * 4 / 11))


@pytest.mark.parametrize("bits", [0, 3, 9])
def test_packed_counts_come_back_and_are_small(bits):
    rng = np.random.default_rng(4)
    key = np.unique(rng.integers(0, 1 << 64, 30_000, dtype=np.uint64) & collocations._BEGINNING)
    code, n = rng.integers(0, 3, len(key)), rng.integers(1, 4, len(key))
    phrases = [f"word{k % 977} und{k % 89}" for k in key.tolist()]
    lengths = np.array([len(p) for p in phrases])
    data = np.frombuffer("".join(phrases).encode(), np.uint8)
    for what, strings in ((key.tolist(), ()), (phrases, (lengths, data))):
        rows = pa.Table.from_batches(list(collocations._packed(2, bits, ["en", "und", "ü"], code, key, n, *strings)))
        assert rows.num_rows == 1 << bits and rows.nbytes < (8 if not strings else 16) * len(key)
        got = {(lang, w): c for lang, pieces in collocations._unpacked(rows).items() for words, counts in pieces for w, c in zip(words.tolist(), counts.tolist())}
        want = {}
        for c, w, many in zip(code.tolist(), what, n.tolist()):
            want.setdefault((["en", "und", "ü"][c], w), []).append(many)
        assert got.keys() == want.keys() and all(c in want[k] for k, c in got.items())
