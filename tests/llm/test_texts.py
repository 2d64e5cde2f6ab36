"""Toxicity, pieces, quotations, sharding and the pipeline."""

import collections
import random
import re
import zlib

import numpy as np
import pytest

import corpus_pipeline
from docloom.llm import pieces, quotes, sharding, toxicity
from tests.llm.fixtures import by_id, empty, frame, odd_rows, words

BAD = ["scoundrel", "dimwit", "rotter"]


def labelled(n=240, seed=1):
    rng = random.Random(seed)
    texts, toxic = [], []
    for i in range(n):
        w = words(seed * 10_000 + i, rng.randint(5, 60)).split()
        label = int(i % 3 == 0)
        if label:
            w.insert(rng.randrange(len(w)), rng.choice(BAD))
        texts.append(" ".join(w)), toxic.append(label)
    return texts, toxic


@pytest.fixture(scope="module")
def model():
    return toxicity.train(*labelled())


def test_classifier_on_unseen_texts(model):
    texts, toxic = labelled(seed=7)
    assert ((toxicity.score_texts(model, texts) >= 0.5) == np.array(toxic)).mean() > 0.97


def test_gaps_and_insertions_are_seen_through(model):
    around = words(5, 6)
    score = lambda w: toxicity.score_texts(model, [f"{around} {w} {around}"])[0]
    assert all(score(w) > 0.5 for w in ("SCOUNDREL", "sc0undrel", "s.c.o.u.n.d.r.e.l", "s c o u n d r e l", "scounxdrel", "rotter,")) and score("meadow") < 0.5


def kernel(a, b):
    """Shared subsequences of four symbols within six, by definition."""
    def parts(w):
        s, out = bytes([27]) + w + bytes([27]), collections.Counter()
        squares = 0.0
        for i in range(len(s)):
            for x in toxicity.PATTERNS:
                if i + x[2] < len(s):
                    out[s[i], *(s[i + k] for k in x)] += toxicity.SKIP ** (x[2] - 3)
                    squares += toxicity.SKIP ** (2 * x[2] - 6)
        return {k: v / squares ** 0.5 for k, v in out.items()}

    x, y = parts(a), parts(b)
    return sum(v * y.get(k, 0.0) for k, v in x.items())


def test_landmark_values_are_the_kernel():
    bags = [toxicity._words(toxicity._sequence([words(i, 12)])[0]) for i in (1, 2)]
    space = toxicity._Nystroem(bags[0])
    want = np.array([[kernel(a, b) for b in bags[0]] for a in bags[1]])
    assert np.allclose(space._kernel(bags[1]), want, atol=1e-4)
    # With every landmark kept, the turned products are the kernel itself on the landmarks.
    turned = space(bags[0])
    assert np.allclose(turned @ turned.T, [[kernel(a, b) for b in bags[0]] for a in bags[0]], atol=1e-2)


def test_folded_weights_score_like_the_machine(model):
    bag = toxicity._words(toxicity._sequence(["alpha scoundrel beta"])[0])
    word, number, weight = toxicity._features(bag)
    want = np.bincount(word, weight * model.weights[number], len(bag)) + model.bias
    assert np.allclose(model.decisions(["alpha scoundrel beta"])[2], want, atol=1e-4)


def test_toxicity_of_odd_rows(spark, model):
    df = frame(spark, odd_rows())
    rows = toxicity.score(df, model).collect()
    assert len(rows) == len(odd_rows()) and all(0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.5) for r in rows)
    got = by_id(rows)
    assert got[1]["score"] == got[2]["score"] == got[3]["score"]
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0) for r in rows if r["doc_id"] is not None)
    assert toxicity.score(empty(spark), model).count() == 0
    assert toxicity.keep_clean(df, model).columns == df.columns


def test_training_without_labels(spark):
    labels = spark.createDataFrame([(4, None), (None, 1)], "doc_id long, toxic int")
    fitted = toxicity.fit_model(frame(spark, odd_rows()), labels)
    assert all(s < 0.5 for s in toxicity.score_texts(fitted, ["a", None, ""]))
    assert toxicity.score_texts(toxicity.train(["a"], [1]), ["b"])[0] > 0.5


def test_training_draws_among_texts_that_are_there(spark):
    # Most labelled ids have no text, and the toxic texts are all longer than the limit.
    texts, toxic = labelled()
    rows = [(i, t + " " + words(i, 150) if k else t, "en", "s", 0) for i, (t, k) in enumerate(zip(texts, toxic))]
    labels = spark.createDataFrame([(i, k) for i, k in enumerate(toxic)] + [(10_000 + i, i % 2) for i in range(4000)], "doc_id long, toxic int")
    fitted = toxicity.fit_model(frame(spark, rows), labels, per_label=200, longest=400)
    assert fitted.slope > 0
    with pytest.warns(UserWarning, match="label 1"):
        toxicity.fit_model(frame(spark, [r for r, k in zip(rows, toxic) if not k]), labels, per_label=200, longest=400)


def test_long_texts_are_scored_whole(model, monkeypatch):
    monkeypatch.setattr(toxicity, "CHUNK", 100)
    text = words(3, 400)
    assert toxicity.score_texts(model, [text + " scoundrel"])[0] > toxicity.score_texts(model, [text + " meadow"])[0]
    assert "".join(toxicity._pieces(text)) == text


def tiny():
    rng = random.Random(1)
    entries = {}
    for i, c in enumerate("▁abcde"):
        entries[c] = -5.0 - rng.random()
    for _ in range(60):
        entries["▁" * rng.randint(0, 2) + "".join(rng.choice("abcde") for _ in range(rng.randint(1, 4)))] = -rng.random() * 9
    listed = [(p, i + 256, s) for i, (p, s) in enumerate(entries.items())]
    bodies = [bytes([i]) for i in range(256)] + [p.replace("▁", " ").encode() for p, _, _ in listed]
    return pieces.Vocabulary.of(listed, np.arange(256), bodies, -30.0), dict(entries)


def best_score(text, scores):
    t = "▁" + text.replace(" ", "▁")
    best = [0.0] + [float("-inf")] * len(t)
    for j in range(1, len(t) + 1):
        for i in range(max(0, j - 8), j):
            s = scores.get(t[i:j], -30.0 if j - i == 1 else None)
            if s is not None:
                best[j] = max(best[j], best[i] + s)
    return best[-1]


def test_pieces_have_the_greatest_score():
    vocabulary, scores = tiny()
    by_number = {i: s for i, s in zip(vocabulary.ids.tolist(), vocabulary.scores.tolist())}
    rng = random.Random(2)
    texts = ["".join(rng.choice("abcde  xé") for _ in range(rng.randint(1, 40))) for _ in range(200)]
    coder = pieces.Encoder(vocabulary)
    for t, ids in zip(texts, coder.encode(texts)):
        assert coder.decode(ids) == t
        unknown = sum(c not in "abcde " for c in t)
        got = sum(by_number[i] for i in ids.tolist() if i >= 256) - 30.0 * unknown
        assert abs(got - best_score(t, scores)) < 1e-6


def test_public_vocabulary_returns_every_text(spark):
    vocabulary = pieces.Vocabulary.load()
    df = frame(spark, odd_rows())
    rows = pieces.decode(pieces.encode(df, vocabulary), vocabulary).collect()
    assert len(rows) == len(odd_rows()) and all(r["decoded"] == r["text"] for r in rows)
    got = by_id(rows)
    assert got[1]["tokens"] is None and got[2]["tokens"] == [] and len(got[10]["tokens"]) > 100
    assert pieces.decode(pieces.encode(empty(spark), vocabulary), vocabulary).count() == 0
    both = pieces.encode(df, vocabulary, decoded="back")
    assert sorted(map(str, both.select("doc_id", "text", "tokens", "back").collect())) == sorted(
        str(r).replace("decoded=", "back=") for r in pieces.decode(pieces.encode(df, vocabulary), vocabulary).select("doc_id", "text", "tokens", "decoded").collect())


def test_pieces_of_a_vocabulary_that_crosses_words_are_refused():
    with pytest.raises(ValueError, match="across words"):
        pieces.Vocabulary.of([("a▁b", 256, -1.0)], np.arange(256), [b""] * 257, -9.0)


MESSAGES = [
    (1, 0, "a", "Hello all. What is the plan?\nSecond line here."), (1, 1, "b", "> hello ALL.  What is\n> the plan?\nThe plan is lunch."),
    (1, 2, "c", "I disagree."), (1, 3, "a", "On Monday b wrote:\n> The plan is lunch.\n>> What is the plan?\nWhere do we meet?"), (1, 4, "b", "At noon."),
    (1, 5, "c", "> Second line\n> here.\nWhich line?"), (1, 6, "c", "No quotation, so still about that."), (1, 7, "b", "> I disagree.\nWhy?"),
    (2, 5, "x", "> never said\nok"), (2, 9, "y", None), (2, 9, "y", None), (None, 1, "x", "> q\nown"), (3, None, "y", ""),
]


def test_reply_order(spark):
    df = spark.createDataFrame(MESSAGES, "conv_id long, turn long, role string, text string").selectExpr("*", "1 as position", "'k' as key", "2 as run")
    rows = quotes.thread(df).collect()
    assert len(rows) == len(MESSAGES)
    got = {(r["conv_id"], r["turn"]): r for r in rows}
    assert [got[1, t]["parent_turn"] for t in range(8)] == [None, 0, 1, 1, 3, 0, 5, 2]
    assert [got[1, t]["linked"] for t in range(8)] == [False, True, False, True, False, True, False, True]
    # Branches: turns 3-4 leave turn 1, 5-6 leave turn 0, 7 leaves turn 2; the latest way out comes first.
    assert sorted(range(8), key=lambda t: got[1, t]["reply_order"]) == [0, 1, 2, 7, 3, 4, 5, 6]
    assert got[1, 3]["text"] == "Where do we meet?" and got[1, 3]["depth"] == 2 and got[1, 3]["n_quotes"] == 2 and got[1, 1]["n_linked"] == 2
    assert got[2, 5]["n_linked"] == 0 and not got[2, 5]["linked"] and got[2, 5]["n_quotes"] == 1
    assert sorted(r["reply_order"] for r in rows if r["conv_id"] == 2) == [0, 1, 2]
    assert got[None, 1]["reply_order"] is None and got[None, 1]["text"] == "own" and got[3, None]["parent_turn"] is None
    assert quotes.thread(df.limit(0)).count() == 0


def threaded(messages):
    """Parents, link counts and reply order of one conversation, message by message."""
    def sentences(text):
        parts = re.split(r"(?<=[.!?]) ", re.sub(r"\s+", " ", text))
        return {n for p in parts if (n := re.sub(r"[\W_]+", " ", p.lower()).strip())}

    first, out = {}, []
    for at, (turn, text) in enumerate(messages):
        own, quoted, level, passage = [], collections.defaultdict(set), 0, []
        lines = [(len(re.match(r"(?:> ?)*", x)[0].replace(" ", "")), re.sub(r"^(?:> ?)*", "", x)) for x in (text or "").split("\n")] + [(0, None)]
        for deep, line in lines:
            if deep != level and level:
                quoted[level] |= sentences("\n".join(passage))
                passage = []
            level = deep
            if deep:
                passage.append(line)
            elif line is not None:
                own.append(line)
        votes = collections.Counter()
        for deep, said in quoted.items():
            votes.update((deep, first[x]) for x in said if x in first)
        parent = max(votes, key=lambda v: (-v[0], votes[v], v[1]))[1] if votes else None
        for x in sentences("\n".join(own)):
            first.setdefault(x, at)
        out.append({"turn": turn, "quoted": parent, "n_linked": sum(votes.values()), "depth": max(quoted, default=0), "text": "\n".join(own).strip("\n")})
    starts = [0] + [i for i, m in enumerate(out) if m["quoted"] is not None and m["quoted"] < i - 1]
    run_of = {i: max(x for x in starts if x <= i) for i in range(len(out))}
    order = []

    def follow(run):
        order.extend(i for i in range(len(out)) if run_of[i] == run)
        for x in sorted((x for x in starts[1:] if run_of[out[x]["quoted"]] == run), key=lambda x: (-out[x]["quoted"], x)):
            follow(x)

    follow(0)
    for i, m in enumerate(out):
        parent = m["quoted"] if m["quoted"] is not None else i - 1 if i else None
        m.update(reply_order=order.index(i), parent_turn=None if parent is None else messages[parent][0], linked=m["quoted"] is not None)
    return out


def test_threads_equal_brute_force(spark):
    rng, rows, want = random.Random(8), [], {}
    for conv in range(5):
        said, messages = [], []
        for t in range(rng.choice([1, 2, 30, 45])):
            lines = []
            for _ in range(rng.choice([0, 0, 1, 1, 2])):  # quotations of one to three levels, in another case and spacing
                deep, line = rng.randint(1, 3), rng.choice(said) if said and rng.random() < 0.9 else "Nobody said that."
                lines += [("> " * deep if rng.random() < 0.5 else ">" * deep + " ") + (line.upper().replace(" ", "  ") if rng.random() < 0.3 else line)]
                lines += ["Agreed." if rng.random() < 0.3 else f"Re {conv} {t} {rng.randint(0, 9)}!"]
            own = [f"{words(conv * 100 + t, rng.randint(2, 5))}{rng.choice('.!?')}" for _ in range(rng.randint(1, 3))]
            said += own
            messages.append((3 * t + rng.randint(0, 2), "\n".join([*lines, " ".join(own)])))
        rows += [(conv, turn, "user", text) for turn, text in messages]
        want.update({(conv, m["turn"]): m for m in threaded(messages)})
    got = quotes.thread(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").repartition(4)).collect()
    assert len(got) == len(want) and any(m["linked"] for m in want.values()) and max(m["depth"] for m in want.values()) == 3
    for r in got:
        m = want[r["conv_id"], r["turn"]]
        assert {k: r[k] for k in ("reply_order", "parent_turn", "linked", "n_linked", "depth", "text")} == {k: m[k] for k in (
            "reply_order", "parent_turn", "linked", "n_linked", "depth", "text")}, (r["conv_id"], r["turn"])


def test_stretches_of_a_long_conversation(spark, monkeypatch):
    monkeypatch.setattr(quotes, "STRETCH", 3)
    rows = [(1, t, "r", f"line {t}." if t % 5 else f"> line {max(0, t - 4)}.\nline {t}.") for t in range(40)]
    got = {r["turn"]: r for r in quotes.thread(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")).collect()}
    assert [got[t]["parent_turn"] for t in range(40)] == [None if t == 0 else t - 4 if t % 5 == 0 else t - 1 for t in range(40)]
    assert sorted(r["reply_order"] for r in got.values()) == list(range(40))
    assert all(got[t]["reply_order"] > got[got[t]["parent_turn"]]["reply_order"] for t in range(1, 40))


def test_shards_by_the_definition(spark):
    rng = random.Random(3)
    rows = [(i, words(i, 3), "en", rng.choice(["big"] * 6 + ["mid"] * 2 + ["small", None, ""]), 0) for i in range(1500)]
    df = frame(spark, rows)
    draws = {r["doc_id"]: r["d"] for r in df.selectExpr("doc_id", "shiftrightunsigned(xxhash64(7L, doc_id), 1) as d").collect()}
    strata = collections.defaultdict(list)
    for i, _, _, s, _ in rows:
        strata["" if s is None else "=" + s].append(i)
    order = []
    for s, ids in strata.items():
        ids.sort(key=lambda i: draws[i])
        order += [((2 * k + 1) / (2 * len(ids)), s, draws[i], i) for k, i in enumerate(ids)]
    order.sort()
    want = {i: (n * 24 // 1500, n) for n, (*_, i) in enumerate(order)}
    got = sharding.interleave(df).collect()
    text = {i: t for i, t, *_ in rows}
    slots = collections.defaultdict(list)
    for r in got:
        assert r["shard"] == want[r["doc_id"]][0] and r["size"] == len(text[r["doc_id"]]) + 8 and r["text_crc32"] == zlib.crc32(text[r["doc_id"]].encode())
        assert r["slot"] == want[r["doc_id"]][1] - -(-r["shard"] * 1500 // 24)
        slots[r["shard"]].append(r["slot"])
    assert len(slots) == 24 and all(sorted(s) == list(range(len(s))) for s in slots.values())
    counts = collections.Counter((r["shard"], r["source"]) for r in got)
    for s in ("big", "mid"):
        share = sum(x == s for *_, x, _ in rows) / 24
        assert all(abs(counts[k, s] - share) <= 2 for k in range(24))


def test_shards_of_odd_rows(spark):
    rows = sharding.interleave(frame(spark, odd_rows()), shards=5).collect()
    sizes = collections.Counter(r["shard"] for r in rows)
    assert len(rows) == len(odd_rows()) and max(sizes.values()) - min(sizes.values()) <= 1
    assert all(sorted(r["slot"] for r in rows if r["shard"] == k) == list(range(n)) for k, n in sizes.items())
    assert by_id(rows)[1]["size"] == 8 and by_id(rows)[1]["text_crc32"] == 0
    assert sharding.interleave(empty(spark)).count() == 0


def test_pipeline_stages(spark, tmp_path):
    texts, toxic = labelled(150)
    rows = [(i, t, "en", "s", len(t)) for i, t in enumerate(texts)]
    item = words(77, 30)
    whole = words(88, 50)
    rows += [(500, f"{words(1, 9)} {item} {words(2, 9)}", "en", "s", 0), (501, whole, "en", "s", 0), (502, whole + " end", "en", "s", 0),
             (503, f"{words(3, 20)} password=abcdef123456 {words(4, 5)}", "en", "s", 0), (504, None, None, None, None), (505, "", "en", "s", 0)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    df.write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame(list(enumerate(toxic)), "doc_id long, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    spark.createDataFrame([(1, item)], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    docs, left = spark.read.parquet(f"{tmp_path}/documents.parquet"), {}
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, str(tmp_path))
        assert name == corpus_pipeline.STAGES[-1][0] or out.columns == df.columns
        docs = spark.createDataFrame(out.collect(), out.schema)
        left[name] = {r["doc_id"]: r["text"] for r in docs.collect()}
    clean = {i for i, k in enumerate(toxic) if not k}
    assert len(clean ^ {i for i in left["toxicity"] if i < 150}) <= 4 and {500, 501, 502, 503, 504, 505} <= set(left["toxicity"])
    assert set(left["toxicity"]) - set(left["near_duplicates"]) == {502}
    assert set(left["near_duplicates"]) - set(left["decontamination"]) == {500}
    assert "[SECRET]" in left["secret_scan"][503] and "password" not in left["secret_scan"][503]
    assert left["pieces"] == left["secret_scan"]
    assert {r["doc_id"]: r["text"] for r in corpus_pipeline.run(spark, str(tmp_path)).collect()} == left["pieces"]
