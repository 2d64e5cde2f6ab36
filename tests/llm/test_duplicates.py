"""Near duplicates of texts and vectors, and repeated passages, against brute force."""

import hashlib
import random
import re
import tracemalloc
import zlib

import numpy as np
import pyarrow as pa
import pytest

from docloom.llm import common, minhash, suffixes, vectors
from tests.llm.fixtures import by_id, empty, frame, odd_rows, words


def grouped(ids, links):
    root = {i: i for i in ids}

    def top(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in links:
        a, b = top(a), top(b)
        root[max(a, b)] = min(a, b)
    return {i: top(i) for i in ids}


def shingles(text, size):
    text = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    w = re.findall("[^\x20\x09-\x0d]+", text)
    return {tuple(w[i:i + size]) for i in range(max(1, len(w) - size + 1))} if w else set()


def near_copies(seed, groups=12, alone=30):
    rng, out, n = random.Random(seed), [], 100
    for g in range(groups):
        base = words(seed * 100 + g, rng.randint(8, 120)).split()
        for _ in range(rng.randint(2, 25)):
            copy = list(base)
            for _ in range(rng.randint(0, max(1, len(base) // 18))):
                copy[rng.randrange(len(copy))] = words(rng.random(), 1)
            out.append((n, " ".join(copy), "en", "s", 0))
            n += 1
    return out + [(n + i, words((seed, i).__hash__(), rng.randint(1, 80)), "en", "s", 0) for i in range(alone)]


@pytest.mark.parametrize("size", [2, 5])
def test_minhash_components(spark, size):
    rows = near_copies(3 + size)
    sets = {i: shingles(t, size) for i, t, *_ in rows}
    ids = sorted(sets)
    links = [(a, b) for k, a in enumerate(ids) for b in ids[k + 1:]
             if sets[a] and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b])]
    want = grouped(ids, links)
    got = by_id(minhash.near_duplicates(frame(spark, rows), size).collect())
    assert {i: r["component_id"] for i, r in got.items()} == want
    assert all(r["n_shingles"] == len(sets[i]) and r["kept"] == (want[i] == i) for i, r in got.items())
    kept = {r["doc_id"] for r in minhash.keep_first(frame(spark, rows), size).collect()}
    assert kept == set(want.values())


def test_minhash_odd_rows(spark):
    rows = minhash.near_duplicates(frame(spark, odd_rows())).collect()
    assert len(rows) == len(odd_rows())
    got = by_id(rows)
    assert [got[i]["component_id"] for i in (1, 2, 3)] == [1, 2, 3] and got[1]["n_shingles"] == 0 and got[3]["kept"]
    assert got[5]["component_id"] == 4 and not got[5]["kept"] and got[11]["component_id"] == 4
    assert got[8]["component_id"] == 7 and got[12]["n_shingles"] == 2
    loose = [r for r in rows if r["doc_id"] is None]
    assert sorted((r["component_id"], r["kept"]) for r in loose if r["component_id"]) == [(4, False)]
    assert minhash.near_duplicates(empty(spark)).count() == 0
    assert set(minhash.keep_first(frame(spark, odd_rows()), 2).columns) == set(frame(spark, odd_rows()).columns)


def test_rows_stay_whatever_their_columns_are_called(spark):
    from docloom.llm import decontaminate

    item = " ".join(f"item{k}" for k in range(30))
    rows = [(1, "alpha beta gamma " * 9, "en", "s", 0), (2, "alpha beta gamma " * 9, "en", "s", 0), (3, words(4, 20) + " " + item, "en", "s", 0), (None, None, None, None, None), (5, "", "en", "s", 0)]
    df = frame(spark, rows).selectExpr("*", "1 as _gone", "2 as _found", "3 as _FOUND_", "array(4) as tokens")
    bench = spark.createDataFrame([(9, item)], "item_id long, text string")
    first, clean = minhash.keep_first(df, 5), decontaminate.keep_clean(df, bench)
    assert first.columns == clean.columns == df.columns
    assert {r.doc_id for r in first.collect()} == {1, 3, None, 5} and {r.doc_id for r in clean.collect()} == {1, 2, None, 5}


def test_forest_pairs_stay_linear_in_a_large_group():
    keys = np.zeros((3000, 8), np.int64)
    left, right = minhash._neighbours(keys, np.zeros(3000, int))
    assert len(left) < 3000 * (minhash.NEXT + 1) and set(zip(range(2999), range(1, 3000))) <= set(zip(left.tolist(), right.tolist()))


def test_minhash_finds_the_only_link_inside_a_large_family(spark):
    page = [f"page{k}" for k in range(151)]
    rows = []
    for i in range(2000):
        # Each member is alike to all others below the similarity; 100 pairs share six more words and are above it.
        twin = [f"twin{i // 2}w{k}" for k in range(6)] if i < 200 else []
        rows.append((i, " ".join(page + twin + [f"own{i}w{k}" for k in range(24 - len(twin))]), "en", "s", 0))
    sets = [shingles(t, 2) for _, t, *_ in rows]
    alike = [len(sets[a] & sets[b]) / len(sets[a] | sets[b]) for a, b in [(0, 1), (0, 2), (300, 301)]]
    assert alike[0] >= 0.8 > 0.77 > max(alike[1:])
    got = by_id(minhash.near_duplicates(frame(spark, rows), 2).collect())
    assert [got[i]["component_id"] for i in range(2000)] == [i - i % 2 if i < 200 else i for i in range(2000)]


@pytest.mark.parametrize("tile", [1024, 70])
def test_tiles_link_what_all_pairs_would(spark, monkeypatch, tile):
    monkeypatch.setattr(minhash, "TILE", tile)
    monkeypatch.setattr(minhash, "TILE_SHINGLES", tile * 64)
    rng, rows = random.Random(tile), []
    for base in range(3):  # families of three base similarities, with twins at 0.80 to 0.82, copies in between and other sizes
        page = [f"p{base}x{k}" for k in range(130 + 15 * base)]
        for i in range(250):
            twin = [f"t{base}x{i // 2}x{k}" for k in range(9)] if i < 60 else []
            own = [f"o{base}x{i}x{k}" for k in range(24 + 2 * base - len(twin) + (i % 7) * 3)]
            rows.append((1000 * base + i, page + twin + own))
    sets = {i: {hash(w) for w in t} for i, t in rows}
    ids = sorted(sets)
    truth = [(a, b) for k, a in enumerate(ids) for b in ids[k + 1:] if 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b])]
    assert truth
    known = [p for p in truth if rng.random() < 0.3]
    now = grouped(ids, known)
    frame_ = spark.createDataFrame([(i, now[i], 1000 * (i // 1000), sorted(sets[i])) for i in ids], "doc_id long, component long, cluster long, shingles array<long>")
    links = [(r.a, r.b) for r in minhash.exact_links(frame_.repartition(4), 80).collect()]
    assert all(100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b]) for a, b in links)
    assert grouped(ids, known + links) == grouped(ids, truth)


def test_components_of_long_chains_and_stars(spark):
    chain = [(i, i + 1) for i in range(50, 120)]
    star = [(500, i) for i in range(501, 560)]
    got = common.components(spark.createDataFrame([*chain, *star, (7, 7), (560, 559)], "a long, b long")).collect()
    want = grouped([*range(50, 121), *range(500, 561)], [*chain, *star, (560, 559)])
    assert {r["node"]: r["component_id"] for r in got} == want


@pytest.mark.parametrize("tile", [4096, 40])
def test_vector_links(spark, tile):
    rng = np.random.default_rng(5)
    base = rng.normal(size=(30, 16))
    x = np.concatenate([base, *(base[:10] + rng.normal(size=(10, 16)) * s for s in (0.1, 0.3, 0.4)), np.repeat(base[:1], 40, axis=0), 3 * base[1:4]])
    x = x.astype(np.float32)
    u = x.astype(float) / np.linalg.norm(x.astype(float), axis=1, keepdims=True)
    near = u @ u.T >= 0.9
    np.fill_diagonal(near, False)
    want = grouped(range(len(x)), list(zip(*map(list, np.nonzero(near)))))
    df = spark.createDataFrame([(i, v.tolist(), 0) for i, v in enumerate(x)], "vec_id long, embedding array<float>, node int")
    for r in vectors.near_duplicates(df, 0.9, tile=tile).collect():
        assert (r["n_links"], r["component_id"], r["kept"]) == (near[r["vec_id"]].sum(), want[r["vec_id"]], want[r["vec_id"]] == r["vec_id"])


def test_vectors_without_meaning_link_with_nothing(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(1, None), (2, [0.0, 0.0]), (3, [nan, 1.0]), (4, [inf, 1.0]), (5, [None, 1.0]), (6, [1.0, 0.0]), (7, [1.0, 0.0]), (None, [1.0, 0.0]), (8, []), (9, [1e30, 0.0])]
    got = vectors.near_duplicates(spark.createDataFrame(rows, "vec_id long, embedding array<float>")).collect()
    facts = {r["vec_id"]: (r["n_links"], r["component_id"], r["kept"]) for r in got}
    assert len(got) == len(rows) and facts[6] == (2, 6, True) and facts[7] == (2, 6, False) and facts[9] == (2, 6, False)
    assert all(facts[i] == (0, i, True) for i in (1, 2, 3, 4, 5, 8, None))
    assert vectors.near_duplicates(spark.createDataFrame([], "vec_id long, embedding array<float>")).count() == 0


def removed(rows):
    seen, out = {}, {}
    for i, t in sorted((i, (t or "").encode()) for i, t in rows):
        mark = bytearray(len(t))
        for p in range(len(t) - 49):
            if seen.setdefault(t[p:p + 50], i) < i:
                mark[p:p + 50] = b"\1" * 50
        runs = sum(1 for p in range(len(t)) if mark[p] and (p == 0 or not mark[p - 1]))
        kept = bytes(c for c, m in zip(t, mark) if not m)
        out[i] = (len(t), sum(mark), runs, hashlib.sha256(kept).hexdigest(), kept)
    return out


@pytest.mark.parametrize("batches", [1, 2, 5])
def test_repeated_passages(spark, batches):
    rng = random.Random(9)
    shared = [words(i, rng.randint(9, 40)) for i in range(6)]
    rows = []
    for i in range(60):
        parts = [words(1000 + i, rng.randint(1, 30))]
        for _ in range(rng.randint(0, 3)):
            s = rng.choice(shared)
            cut = rng.randint(0, len(s) // 2)
            parts += [s[cut:cut + rng.choice([49, 50, 51, 500])], words(rng.random(), rng.randint(0, 20))]
        rows.append((i * 7 % 61, " ".join(parts)))
    # One phrase in so many surroundings that its strings are compared one by one.
    phrase, tails = words(777, 9)[:40], [words(778 + k, 4) for k in range(3)]
    rows += [(300 + i, f"{words(5000 + i, 6)} {phrase} {tails[i % 3][:12 + i % 9]} {words(6000 + i, 6)}") for i in range(90)]
    rows += [(200, "ab" * 400), (201, "ab" * 30), (202, "é" * 40), (203, "é" * 60), (204, None), (205, "short")]
    want = removed(rows)
    got = suffixes.remove_repeats(frame(spark, [(i, t, "en", "s", 0) for i, t in rows]), batches).collect()
    assert {r["doc_id"]: (r["n_bytes"], r["n_removed"], r["n_spans"], r["kept_sha256"], bytes(r["kept"])) for r in got} == want


@pytest.mark.parametrize("parts,batches", [(1, 1), (5, 1), (5, 3), (3, 5)])
def test_repeats_among_negative_ids(spark, parts, batches):
    same = words(31, 16)[:89]
    rows = [(i, f"{words(40 + i, 3 + i % 4)} {same} {words(80 + i, 5)}") for i in (-(2**63), -3, -2, -1, 0, 5, 6, 2**62)]
    df = frame(spark, [(i, t, "en", "s", 0) for i, t in rows]).repartition(parts, "doc_id")
    got = suffixes.remove_repeats(df, batches).collect()
    assert {r["doc_id"]: (r["n_bytes"], r["n_removed"], r["n_spans"], r["kept_sha256"], bytes(r["kept"])) for r in got} == removed(rows)


def test_repeats_in_odd_rows(spark, monkeypatch):
    rows = suffixes.remove_repeats(frame(spark, odd_rows())).collect()
    assert len(rows) == len(odd_rows())
    got = by_id(rows)
    assert got[1]["n_bytes"] == 0 and got[2]["n_removed"] == 0 and got[4]["n_removed"] == 0
    assert got[5]["n_removed"] == got[5]["n_bytes"] and got[5]["n_spans"] == 1 and 0 < got[9]["n_removed"] < got[9]["n_bytes"]
    assert all(r["n_removed"] == 0 for r in rows if r["doc_id"] is None)
    assert suffixes.remove_repeats(empty(spark)).count() == 0


def open_bucket(entries, anchors):
    """One bucket of stretches whose anchors stand in ever different surroundings, a few copied to later documents."""
    rng, flat, at = np.random.default_rng(5), [], 0
    for _ in range(entries):
        flat.append(rng.integers(97, 105, 84, np.uint8))
        if rng.random() < 0.1 and at >= anchors:
            flat[-1][20:75] = flat[at - anchors][20:75]
        at += 1
    flat = np.concatenate(flat)
    doc = np.arange(entries)
    (sent,) = suffixes._send(suffixes.STRETCHES, np.zeros(entries, int), doc, doc, doc, lambda i: flat.reshape(-1, 84)[i].tobytes(),
                             names=(doc % anchors).astype(np.uint64), wholes=doc.astype(np.uint64), places=np.zeros(entries, np.uint32), counts=np.full(entries, 35, np.uint8))
    return pa.Table.from_batches([sent])


def test_a_bucket_holds_little_however_many_strings_it_compares():
    table = open_bucket(40_000, 4_000)
    tracemalloc.start()
    try:
        out = suffixes._settle_stretches(32)(table)
        assert tracemalloc.get_traced_memory()[1] < 100e6
    finally:
        tracemalloc.stop()
    assert sum(len(p or b"") for p in out.column("places").to_pylist())


@pytest.mark.parametrize("at_once", [1, 40, 10_000])
def test_strings_compared_in_parts_give_the_same_runs(monkeypatch, at_once):
    table = open_bucket(300, 30)
    flat = zlib.decompress(table.column("texts")[0].as_py())
    seen, want = {}, set()
    for i in range(300):
        gone = bytearray(84)
        for p in range(35):
            if seen.setdefault((i % 30, flat[84 * i + p:84 * i + p + 50]), i) < i:
                gone[p:p + 50] = b"\1" * 50
        want |= {(i, p) for p in range(84) if gone[p]}
    monkeypatch.setattr(suffixes, "AT_ONCE", at_once)
    monkeypatch.setattr(suffixes, "PIECE", 500)
    out = suffixes._settle_stretches(32)(table)
    got = {(d, p) for d, spans in zip(out.column("doc").to_pylist(), out.column("places").to_pylist()) for a, b in np.frombuffer(spans, np.int64).reshape(-1, 2) for p in range(a, b)}
    assert want and got == want


def test_long_texts_are_taken_in_pieces(monkeypatch):
    monkeypatch.setattr(suffixes, "PIECE", 256)
    body = words(4, 400).encode()
    starts = [at + i for at, a in suffixes._pieces(body) for i in range(len(a) - 49)]
    assert starts == list(range(len(body) - 49))
