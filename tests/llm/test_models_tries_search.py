"""Language model, conversation trie and ranked search against plain Python."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from conftest import noise
from tablewright.llm import hmm, lexical, tries
from tablewright.llm.common import find_package

# language model


def tokens_of(text):
    return [*(text or "").encode().lower().split(), hmm.END]


def held(doc):
    return doc is not None and zlib.crc32(str(doc).encode()) % 7 == 2


def held_out():
    return F.crc32(F.col("doc_id").cast("string").cast("binary")) % 7 == 2



@pytest.fixture(scope="module")
def learned(tricky_docs):
    text = hmm.read(tricky_docs, held_out())
    return text, hmm.train(text, states=4, rounds=2)


def test_base_scores_and_counts(tricky_docs, tricky_rows):
    counts = Counter(w for doc, t, _ in tricky_rows if not held(doc) for w in tokens_of(t))
    n, v = sum(counts.values()), len(counts)
    want = Counter()
    for doc, t, _ in tricky_rows:
        found = tokens_of(t)
        base = sum(math.log10((counts[w] + 1) / (n + v + 1)) for w in found)
        want[doc, held(doc), len(found), sum(counts[w] > 0 for w in found), n, round(base, 5)] += 1
    done = hmm.score_texts(tricky_docs, held_out(), states=2, rounds=1)
    rows = done.select("doc_id", "held", "n_tokens", "n_known", "tokens", "base").collect()
    assert Counter((*r[:5], round(r.base, 5)) for r in rows) == want


def plain_forward(model, symbols):
    """Sum over all paths in the log domain, one step at a time."""
    logs = np.log(model.start) + np.log(model.emits[symbols[0]])
    for s in symbols[1:]:
        step = logs[:, None] + np.log(model.moves)
        top = step.max(axis=0)
        logs = top + np.log(np.exp(step - top).sum(axis=0)) + np.log(model.emits[s])
    top = logs.max()
    return (top + math.log(np.exp(logs - top).sum())) / math.log(10)


def test_scores_are_whole_sequence_likelihoods(learned):
    text, model = learned
    scores = Counter(round(r.score, 3) for r in hmm.score(text, model).collect())
    rows = text.coded.collect()
    want = Counter(round(plain_forward(model, np.frombuffer(r.symbols, np.uint16)) + r.inside, 3) for r in rows)
    assert scores == want
    assert all(len(r.symbols) == 2 * r.n_tokens for r in rows)


def test_model_is_a_distribution(learned):
    text, model = learned
    assert model.start.sum() == pytest.approx(1) and model.moves.sum(axis=1) == pytest.approx(1)
    assert model.emits.sum(axis=0) == pytest.approx(1) and (model.emits > 0).all()
    assert text.shares.sum() == pytest.approx(1)


def test_words_of_a_class_add_up(as_documents, monkeypatch):
    """With three symbols of their own, known words and one new one share each class fully."""
    monkeypatch.setattr(hmm, "WORDS", 3)
    monkeypatch.setattr(hmm, "LEAST", 1)
    monkeypatch.setattr(hmm, "SYMBOLS", 3 + hmm.CLASSES)
    docs = as_documents([(i, noise(i, 50), "s") for i in range(30)] + [(100 + i, f"{w} new{w}", "s") for i, w in enumerate("abcdef")])
    text = hmm.read(docs, F.lit(False))
    rows = {r.key: r for r in text.coded.collect()}
    symbols = np.concatenate([np.frombuffer(r.symbols, np.uint16) for r in rows.values()])
    assert symbols.max() < 3 + hmm.CLASSES and (symbols >= 3).any()
    counts = Counter(w for i in rows for w in tokens_of(noise(i, 50) if i < 100 else f"{'abcdef'[i - 100]} new{'abcdef'[i - 100]}"))
    top = sorted(counts, key=lambda w: (-counts[w], w))[:3]
    by_class = defaultdict(dict)
    for doc, r in rows.items():
        words = tokens_of(noise(doc, 50) if doc < 100 else f"{'abcdef'[doc - 100]} new{'abcdef'[doc - 100]}")
        for w, s in zip(words, np.frombuffer(r.symbols, np.uint16).tolist()):
            assert (w in top) == (s < 3)
            if s >= 3:
                by_class[s][w] = counts[w]
        assert r.inside <= 0
    for s, own in by_class.items():
        whole = sum(own.values()) + hmm.NOVEL * (len(own) + 1)
        assert sum((n + hmm.NOVEL) / whole for n in own.values()) + hmm.NOVEL / whole == pytest.approx(1)


def plain_counts(model, pieces, first, states, symbols):
    """Expected counts by forward and backward in doubles, piece by piece."""
    start, moves, emits = np.zeros(states), np.zeros((states, states)), np.zeros((symbols, states))
    for piece, is_first in zip(pieces, first):
        a = np.zeros((len(piece), states))
        b = np.ones((len(piece), states))
        a[0] = (model.start if is_first else model.middle) * model.emits[piece[0]]
        for t in range(1, len(piece)):
            a[t] = (a[t - 1] @ model.moves) * model.emits[piece[t]]
        for t in range(len(piece) - 2, -1, -1):
            b[t] = model.moves @ (model.emits[piece[t + 1]] * b[t + 1])
        whole = a[-1].sum()
        for t, s in enumerate(piece):
            emits[s] += a[t] * b[t] / whole
            if t:
                moves += a[t - 1][:, None] * model.moves * (model.emits[s] * b[t])[None, :] / whole
        if is_first:
            start += a[0] * b[0] / whole
    return start, moves, emits


def test_expected_counts_against_plain_sums():
    dice = np.random.default_rng(5)
    shares = dice.dirichlet(np.ones(12))
    model = hmm.Model.drawn(shares, 3)
    pieces = [dice.integers(0, 12, n) for n in (1, 2, 7, 7, 15, 3)]
    first = np.array([True, False, True, False, True, True])
    counts = hmm.Counts(3, 12)
    counts.add(model.packed(), pieces, first)
    for found, want in zip((counts.start, counts.moves, counts.emits), plain_counts(model, pieces, first, 3, 12)):
        assert found == pytest.approx(want, rel=1e-3, abs=1e-4)
    assert counts.emits.sum() == pytest.approx(sum(map(len, pieces)), rel=1e-4)


def test_training_raises_the_likelihood_of_held_out_texts(as_documents):
    """Two languages that are never mixed: states tell them apart."""
    dice = random.Random(3)
    words = [[f"{c}{i}" for i in range(200)] for c in "ab"]
    rows = [(i, " ".join(dice.choices(words[i % 2], k=80)), "s") for i in range(300)]
    done = hmm.score_texts(as_documents(rows), held_out(), states=2, rounds=2).filter("held").collect()
    assert len(done) > 20 and all(r.score > r.base + 10 for r in done)


def test_states_start_from_every_training_text(as_documents, monkeypatch):
    """Without a round over the text the model holds the exact shares of all symbols; one round sees every token."""
    rows = [(i, noise(i, 300), "s") for i in range(1500)]
    text = hmm.read(as_documents(rows), F.lit(False))
    started = hmm.train(text, states=2, rounds=0)
    drawn = hmm.Model.drawn(text.shares, 2)
    assert all((a == b).all() for a, b in zip(started.packed(), drawn.packed()))
    seen, of_counts = [], hmm.Model.of_counts
    monkeypatch.setattr(hmm.Model, "of_counts", lambda shares, start, moves, emits: seen.append(emits.sum()) or of_counts(shares, start, moves, emits))
    hmm.train(text, states=2, rounds=2)
    assert seen == pytest.approx([text.tokens] * 2, rel=1e-4)


def test_no_partition_of_the_text_changes_the_model(as_documents):
    rows = [(i, noise(i, 60), "s") for i in range(80)]
    scores = []
    for parts in (1, 5):
        done = hmm.score_texts(as_documents(rows).repartition(parts), held_out(), states=3, rounds=2).collect()
        scores.append({r.doc_id: r.score for r in done})
    assert scores[0] == pytest.approx(scores[1], rel=1e-4)


def test_language_model_without_texts_or_training(no_docs, as_documents):
    assert hmm.score_texts(no_docs, held_out()).count() == 0
    row = hmm.score_texts(as_documents([(1, "one two", "s")]), F.lit(True), states=2).first()
    assert (row.n_tokens, row.n_known, row.tokens, row.base) == (3, 0, 0, 0.0) and row.score < 0


# conversations

TURNS = "conv_id long, turn long, role string, text string, path string, n int, least long, ends string, id int, up int"


@pytest.fixture(scope="module")
def as_turns(spark):
    find_package(spark)

    def build(rows):
        return spark.createDataFrame([(*r, "p", 1, 2, "e", 3, 4) for r in rows], TURNS).repartition(3)

    return build


def conversations():
    dice, rows = random.Random(4), []
    for c in range(120):
        start = dice.choice(["hello", "hé", "who?"])
        for t in range(dice.randint(1, 8)):
            rows.append((c, t, "user" if t % 2 == 0 else "bot", start if t == 0 else f"{dice.randint(0, 2)} answer"))
    rows += [(500 + c, t, "user", f"copy {t}") for c in range(60) for t in range(3)]  # copies
    rows += [(1000 + c, t, "user", f"long {t}") for c in range(2) for t in range(400)]  # deeper than the skeleton
    rows += [(1000, 400, "user", "one more"), (1001, None, "user", "first"), (1003, 0, None, None), (1004, 0, "", "")]
    rows += [(1005, 0, "a", "b"), (1005, 0, "a", "b"), (1006, 0, "ab", ""), (1007, 0, "a", "b"), (None, 0, "a", "b")]
    rows += [(-7, 0, "user", "hello"), (-5, 0, "user", "hello")]
    return rows


def plain_paths(rows):
    by = defaultdict(list)
    for conv, turn, role, text in rows:
        if conv is not None:
            by[conv].append(((turn is not None, turn or 0), role or "", text or ""))
    return {c: [(r, t) for _, r, t in sorted(found)] for c, found in by.items()}


def plain_rethreaded(own, block=5, most=9):
    made = {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % most
        made[c] = own.get(c - int(math.fmod(c, block)), [])[:h] + turns[h:]
    return made


def plain_trie(found):
    members, ends = defaultdict(list), defaultdict(list)
    for c, turns in found.items():
        for d in range(len(turns) + 1):
            members[tuple(turns[:d])].append(c)
        ends[tuple(turns)].append(c)
    children = Counter(p[:-1] for p in members if p)
    leaves, saved = Counter(), Counter()
    for p, own in members.items():
        more = (len(own) - 1) * len(p[-1][1].encode()) if p else 0
        for d in range(len(p) + 1):
            saved[p[:d]] += more
            leaves[p[:d]] += not children[p]
    made = Counter()
    for p, own in members.items():
        text = ",".join(map(str, sorted(ends[p])))
        above = min(members[p[:-1]]) if p else None
        made[min(own), len(p), above, len(own), children[p], leaves[p], saved[p], hashlib.sha256(text.encode()).hexdigest()] += 1
    return made


@pytest.mark.parametrize("shards", [None, 1, 40])
def test_trie(as_turns, shards):
    rows = conversations()
    held = tries.rethreaded(tries.paths(as_turns(rows)))
    assert Counter(tuple(r) for r in tries.prefix_trie(held, shards).collect()) == plain_trie(plain_rethreaded(plain_paths(rows)))


def test_trie_without_rethreading_and_of_nothing(as_turns):
    rows = conversations()
    assert Counter(tuple(r) for r in tries.prefix_trie(tries.paths(as_turns(rows)), 9).collect()) == plain_trie(plain_paths(rows))
    assert tries.prefix_trie(tries.rethreaded(tries.paths(as_turns([])))).count() == 0


def test_a_list_of_members_over_many_tasks(as_turns, spark, monkeypatch):
    monkeypatch.setattr(tries, "PIECE", 200)
    rows = [(c, 0, "user", "same") for c in range(3000)] + [(5000, 0, "user", "other")]
    found = tries.prefix_trie(tries.paths(as_turns(rows))).filter("depth = 1").collect()
    assert Counter(tuple(r) for r in found) == Counter({k: n for k, n in plain_trie(plain_paths(rows)).items() if k[1] == 1})


def test_skeleton_nodes_are_the_prefixes_of_splitters():
    turn = [bytes([i]) * 16 + (i).to_bytes(8, "big") for i in range(4)]
    made = list(tries.Skeleton([turn[0] + turn[1], turn[0] + turn[2], turn[3]]).rows())
    assert [(r["up"], r["depth"], r["bytes"], r["above"]) for r in made] == [
        (-1, 0, 0, [0]), (0, 1, 0, [1, 0]), (1, 2, 1, [2, 1, 0]), (1, 2, 2, [3, 1, 0]), (0, 1, 3, [4, 0]),
    ]


# ranked search

ITEMS = "item_id long, text string, score string, rank int, query long, key string, doc_id string"
TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def plain_terms(text):
    return TERM.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))


def plain_search(rows, items, k):
    docs = [(doc, Counter(found)) for doc, t, _ in rows if (found := plain_terms(t))]
    whole = sum(sum(tf.values()) for _, tf in docs)
    df = Counter(t for _, tf in docs for t in tf)
    asked = defaultdict(set)
    for item, text in items:
        asked[item] |= set(plain_terms(text))
    made = Counter()
    for item, own in asked.items():
        scored = []
        for doc, tf in docs:
            m = 50 + 50 * sum(tf.values()) * len(docs) // whole
            total = sum(
                math.floor(1000 * math.log((2 * len(docs) + 2) / (2 * df[t] + 1))) * (1_000_000_000 * tf[t] // (1000 * tf[t] + 20 * m))
                for t in own
                if t in tf
            )
            if total > 0:
                scored.append((-total, doc is None, doc or 0))
        for rank, (score, null, doc) in enumerate(sorted(scored)[:k], 1):
            made[item, rank, None if null else doc, -score] += 1
    return made


def items_of(rows):
    items = [(i, " ".join(plain_terms(t)[:12])) for i, (_, t, _) in enumerate(rows) if i % 5 == 0]
    return [*items, (900, "line SHARE that share"), (901, None), (902, ""), (903, "nothing of this here zz9"), (None, "word two"), (900, "la"), (904, noise(50, 60))]


@pytest.mark.parametrize("k", [1, 7, 50])
def test_search(spark, tricky_docs, tricky_rows, k, monkeypatch):
    monkeypatch.setattr(lexical, "BLOCK_BYTES", 20_000)
    monkeypatch.setattr(lexical, "RUN", 4)
    monkeypatch.setattr(lexical, "FIRST", 2)
    items = items_of(tricky_rows)
    queries = spark.createDataFrame([(*i, "s", 1, 2, "k", "d") for i in items], ITEMS)
    found = lexical.search(tricky_docs, queries, k=k)
    assert found.columns == ["item_id", "rank", "doc_id", "score"]
    assert Counter(tuple(r) for r in found.collect()) == plain_search(tricky_rows, items, k)


def test_search_in_rounds_and_over_copies(spark, as_documents, monkeypatch):
    """Queries dealt into rounds; a third of all documents are one text, so the edge is a tie of many."""
    monkeypatch.setattr(lexical, "QUERY_BYTES", 300)
    rows = [(i, noise(i % 40, 30), "s") for i in range(400)] + [(1000 + i, "same text again", "s") for i in range(200)]
    items = [(i, noise(i, 8)) for i in range(30)] + [(99, "same text")]
    queries = spark.createDataFrame([(*i, "s", 1, 2, "k", "d") for i in items], ITEMS)
    found = lexical.search(as_documents(rows), queries, k=10)
    assert Counter(tuple(r) for r in found.collect()) == plain_search(rows, items, 10)


def test_search_of_nothing(spark, no_docs, tricky_docs):
    none = spark.createDataFrame([], ITEMS)
    some = spark.createDataFrame([(1, "word", "s", 1, 2, "k", "d")], ITEMS)
    assert lexical.search(no_docs, some).count() == 0
    assert lexical.search(tricky_docs, none).count() == 0


def test_pair_bounds_hold_and_are_tighter(spark, as_documents):
    """No document's share of a pair is above the pair's bound of its run; on the whole the bounds are lower than sums."""
    rows = [(i, noise(i % 90, 40) + (" rare" if i % 7 == 0 else " common"), "s") for i in range(600)]
    docs = as_documents(rows)
    index = lexical.build(docs)
    asked = sorted({t for i in range(5) for t in plain_terms(noise(i, 20))} | {"rare", "common"} )
    asked = [t.encode() for t in asked]
    documents, total, df = lexical._statistics(index, asked)
    weights = np.array([lexical.weight(documents, int(n)) if n else 0 for n in df], np.int64)
    plan = lexical._Plan([0], [list(range(len(asked)))], weights, 16)
    sent = spark.sparkContext.broadcast((asked, plan))
    tighter = looser = 0
    for batch in lexical._impacts(index, sent, documents, total).toArrow().to_batches():
        for i in range(batch.num_rows):
            block = lexical._Block(batch, i, 16)
            for part in plan.parts[0]:
                bound = block.bound(plan, part)
                if bound is None:
                    continue
                shares, single = np.zeros(block.runs * 16, np.int64), np.zeros(block.runs, np.int64)
                for t in part:
                    if t in block.at:
                        a, b = block.starts[block.at[t] : block.at[t] + 2]
                        own = np.zeros_like(shares)
                        own[block.docs[a:b]] = plan.weights[t] * block.impacts[a:b]
                        shares += own
                        single += own.reshape(-1, 16).max(axis=1)
                assert (shares.reshape(-1, 16).max(axis=1) == bound).all()
                tighter += (bound < single).sum()
                looser += (bound > single).sum()
    assert tighter > 0 and looser == 0
