"""Near copies by five-word similarity, as the pipeline drops them."""

import random
from collections import Counter

import numpy as np
import pytest

import corpus_pipeline
from conftest import noise
from tablewright.llm import simhash
from tablewright.llm.common import find_package, stage


def shingle_set(text, words=5):
    found = (text or "").encode().lower().split()
    size = min(words, len(found))
    return {tuple(found[i : i + size]) for i in range(len(found) - size + 1)} if found else set()


def jaccard(a, b):
    one, two = shingle_set(a), shingle_set(b)
    return len(one & two) / len(one | two) if one | two else 1.0


def edited(text, least, most, dice):
    """A copy with words changed one by one until its similarity lies between the bounds."""
    words = text.split()
    while jaccard(text, " ".join(words)) >= most:
        tried = list(words)
        tried[dice.randrange(len(words))] = f"changed{dice.randrange(10**9)}"
        if jaccard(text, " ".join(tried)) >= least:
            words = tried
    return " ".join(words)


BANDS = [(0.8, 0.83), (0.83, 0.87), (0.87, 0.92), (0.92, 0.98)]


def planted():
    dice, rows, band = random.Random(1), [], {}
    for size in (120, 300, 800):
        for k, (low, high) in enumerate(BANDS):
            for _ in range(60):
                at = 2 * len(band)
                text = noise(10_000 + at, size)
                rows += [(at, text, "s"), (at + 1, edited(text, low, high, dice), "s")]
                band[at + 1] = k
    return rows, band


def test_pipeline_drops_planted_near_copies(spark, as_documents):
    rows, band = planted()
    docs = stage(as_documents(rows).select(*corpus_pipeline.COLUMNS))
    kept = {r.doc_id for r in corpus_pipeline.drop_near_copies(spark, docs, "").collect()}
    assert {at for at in range(len(rows)) if at % 2 == 0} <= kept  # originals have the least keys
    found = Counter(k for at, k in band.items() if at not in kept)
    recall = [found[k] / 180 for k in range(len(BANDS))]
    print("recall", dict(zip(BANDS, recall)))
    assert min(recall) >= 0.93 and min(recall[1:]) >= 0.97


def test_links_differ_in_few_bits(spark):
    """Fingerprints that share bytes are linked only within ``BITS`` bits, in lists and between groups."""
    find_package(spark)
    rng = np.random.default_rng(6)
    one = rng.integers(0, 256, simhash.WIDE, np.uint8)
    near, far, alike = one.copy(), one.copy(), one.copy()
    near[:10] ^= np.uint8(255)  # 80 bits
    alike[10 : 10 + simhash.BITS // 8] ^= np.uint8(255)  # just as many as may differ
    far[-1 - simhash.BITS // 8 :] ^= np.uint8(255)  # a byte more
    prints = [(n, p.tobytes(), n) for n, p in enumerate((one, near, far, alike))]
    frame = stage(spark.createDataFrame(prints, "node long, fp binary, root long"))
    bits = {(i, j): int(np.unpackbits(np.frombuffer(prints[i][1], np.uint8) ^ np.frombuffer(prints[j][1], np.uint8)).sum()) for j in range(4) for i in range(j)}
    want = {pair for pair, n in bits.items() if n <= simhash.BITS}
    assert want == {(0, 1), (0, 3)}
    found = {(r.a, r.b): r.far for r in simhash.candidates(frame).filter("b is not null").collect()}
    assert found == {pair: bits[pair] for pair in want}
    lists = stage(simhash._dealt(frame, 2, ("node",)).select("list").distinct())
    assert {(r.a, r.b) for r in simhash.between_groups(frame, lists).collect()} == want


@pytest.mark.parametrize("size", [4, 5, 7, 8, 9, 10, 20, 100, 1000])
def test_similar_texts_are_within_the_bits(size):
    """The bound on bits loses no pair of a Jaccard similarity of 0.8, however few shingles there are."""
    rng, most = np.random.default_rng(size), 0
    for _ in range(400):
        alone = rng.integers(0, size // 4 + 1)  # shingles of one text only, the other has the rest
        others = size // 4 - alone
        hashes = rng.integers(0, 1 << 63, size + alone + others, np.uint64)
        a, b = np.sort(hashes[: size + alone]), np.sort(np.append(hashes[:size], hashes[size + alone :]))
        assert size >= 0.8 * len(hashes)
        most = max(most, int(np.bitwise_count(np.frombuffer(simhash._wide(a), np.uint8) ^ np.frombuffer(simhash._wide(b), np.uint8)).sum()))
    assert most <= simhash.BITS


def test_texts_are_cut_into_shingles_once(spark, as_documents, monkeypatch):
    """Pairs are verified on sets that each text gives once, however many pairs it is in."""
    dice, base = random.Random(8), noise(5, 60)
    rows = [(i, t, "s") for i, t in enumerate([base, edited(base, 0.82, 0.9, dice), edited(base, 0.6, 0.75, dice), noise(6, 60), "", None, "one"])]
    texts = stage(as_documents(rows).selectExpr("doc_id AS node", "text"))
    pairs = stage(spark.createDataFrame([(i, j) for j in range(len(rows)) for i in range(j)], "a long, b long"))
    shingled = stage(simhash._shingled(texts, 5))
    monkeypatch.setattr(simhash, "text_bytes", None)
    found = {(r.a, r.b) for r in simhash._similar(pairs, shingled, 0.8).collect()}
    assert found == {(i, j) for j in range(len(rows)) for i in range(j) if jaccard(rows[i][1], rows[j][1]) >= 0.8}
    for _ in range(50):
        one, two = (np.unique(np.array([dice.randrange(30) for _ in range(dice.randrange(20))], np.uint64)) for _ in range(2))
        assert simhash._shared(one, two) == len(set(one.tolist()) & set(two.tolist()))


def plain_groups(rows, least=0.8):
    """The group of each row, by comparing all pairs."""
    parent = list(range(len(rows)))

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    sets = [shingle_set(t) for _, t, _ in rows]
    for i, one in enumerate(sets):
        for j, two in enumerate(sets[:i]):
            if len(one & two) >= least * len(one | two):
                a, b = root(i), root(j)
                parent[max(a, b)] = min(a, b)
    return [root(i) for i in range(len(rows))]


def plain_kept(rows):
    roots, want = plain_groups(rows), Counter()
    for group in set(roots):
        keys = [rows[i][0] for i in range(len(rows)) if roots[i] == group]
        want[min((k for k in keys if k is not None), default=None)] += 1
    return want


def test_only_similar_texts_are_linked(spark, as_documents, tricky_rows):
    dice, rows = random.Random(2), list(tricky_rows)
    for k in range(40):  # near misses
        text = noise(500 + k, 150)
        rows += [(1000 + 2 * k, text, "s"), (1001 + 2 * k, edited(text, 0.7, 0.795, dice), "s")]
    base = noise(77, 200)
    rows += [(2000 + k, edited(base, 0.85, 0.95, dice), "s") for k in range(60)]  # one large group
    docs = stage(as_documents(rows))
    kept = simhash.keep_dissimilar(docs)
    assert Counter(r.doc_id for r in kept.collect()) == plain_kept(rows) and kept.columns == docs.columns


@pytest.fixture(scope="module")
def loose_groups():
    """Texts edited from bases that are left out: few of many candidates are links."""
    dice, rows = random.Random(9), []
    for g in range(2):
        base = noise(300 + g, 200)
        rows += [(100 * g + k, edited(base, 0.85, 0.885, dice), "s") for k in range(80)]
    return rows


def grouped(docs, **bounds):
    made = {}
    for r in simhash.similar_groups(docs, **bounds).collect():
        made.setdefault(r.root, set()).add(r.doc_id)
    return sorted(map(sorted, made.values()))


def test_thinned_lists_lose_no_link(as_documents, loose_groups):
    """Far more thinning than in production leaves the groups of all candidates; those find 0.9 of the true merges."""
    docs = stage(as_documents(loose_groups))
    every = grouped(docs, together=10_000, partners=10_000)
    true = len(set(plain_groups(loose_groups)))
    found = (len(loose_groups) - len(every)) / (len(loose_groups) - true)
    print("merges found", found, "of", len(loose_groups) - true)
    assert true > 50 and 0.9 <= found <= 1
    for bounds in ({"together": 5, "partners": 1},):
        assert grouped(docs, **bounds) == every, bounds


def test_links_that_meet_in_no_list_are_found(as_documents, loose_groups, tricky_rows, monkeypatch):
    """Groups are those of all pairs, however little the index of positions finds, with long lists of shingles too."""
    rows = [*loose_groups, *[(10_000 + i, t, s) for i, (_, t, s) in enumerate(tricky_rows)]]
    docs, want = stage(as_documents(rows)), {}
    for (key, _, _), root in zip(rows, plain_groups(rows), strict=True):
        want.setdefault(root, set()).add(key)
    want = sorted(map(sorted, want.values()))
    assert grouped(docs) == want
    monkeypatch.setattr(simhash, "CHOICES", {2: 1, 3: 1})
    for known, bounds in ((simhash.KNOWN, {}), (8, {"together": 5, "partners": 1}), (0, {"together": 30})):
        monkeypatch.setattr(simhash, "KNOWN", known)
        assert grouped(docs, **bounds) == want, bounds


@pytest.mark.parametrize("seed", range(4))
def test_similar_sets_meet_at_a_first_shingle(seed):
    """Sets of a Jaccard similarity of 0.8 have a first shingle in common from which enough are left in both."""
    rng, met = np.random.default_rng(seed), 0
    known = np.sort(rng.choice(2000, 300, replace=False)).astype(np.uint64)
    counts = rng.integers(1, 5, len(known))
    for known, counts in ((known, counts), (known[:0], counts[:0])):
        for _ in range(2000):
            base = rng.choice(2000, rng.integers(1, 60), replace=False)
            one, two = (np.unique(np.append(base[rng.random(len(base)) > 0.06], rng.integers(0, 2000, rng.integers(0, 4)))).astype(np.uint64) for _ in range(2))
            shared = len(np.intersect1d(one, two))
            if not shared or shared < 0.8 * (len(one) + len(two) - shared):
                continue
            met += 1
            a, b = (simhash._rarest(x, known, counts, 0.8).tolist() for x in (one, two))
            rests = [min(len(one) - a.index(x), len(two) - b.index(x)) for x in a if x in b]
            assert rests and max(rests) >= 0.8 / 1.8 * (len(one) + len(two)) - 1e-6
    assert met > 500


def test_common_shingles_are_counted(as_documents, monkeypatch):
    """The commonest are known, whatever is counted at once."""
    shared = noise(3, 30)
    docs = as_documents([(i, noise(900 + i, 20) + " " + shared, "s") for i in range(40)] + [(99, None, "s")])
    want = set(simhash._shingles(shared.encode()).tolist())
    for bounds in ({}, {"KNOWN": 60, "COUNTED": 100}):
        for name, value in bounds.items():
            monkeypatch.setattr(simhash, name, value)
        hashes, counts = simhash.common_shingles(docs)
        found = dict(zip(hashes.tolist(), counts.tolist(), strict=True))
        assert want <= set(found) and min(found[x] for x in want) >= (3 if bounds else 40)
        assert hashes.tolist() == sorted(found) and len(found) <= simhash.KNOWN


def test_blocks_of_shared_shingles_meet_where_roots_differ(spark):
    """Every pair of different roots that has enough left, whatever the blocks; repeated rows change nothing."""
    dice = np.random.default_rng(4)
    for roots in ([7] * 30 + [9] * 3, list(range(15)), [1] * 4 + [2] * 4 + [3] * 12 + [4], [5] * 9):
        rests = dice.integers(7, 10, len(roots)).tolist()
        rows = [(lst, n, 9, rest) for n, rest in enumerate(rests) for lst in (0, 1) for _ in range(1 + n % 2)] + [(2, 0, 9, 9)]
        postings = stage(spark.createDataFrame(rows, "list long, node long, size long, rest long"))
        of = spark.createDataFrame(list(enumerate(roots)), "node long, root long")
        want = {(i, j) for j in range(len(roots)) for i in range(j) if roots[i] != roots[j] and min(rests[i], rests[j]) >= 8}
        for together in (1, 4, 1000):
            got = [(r.a, r.b) for r in simhash.sharing(postings, of, together=together).collect()]
            assert len(got) == len(set(got)) and set(got) == want


def test_unlike_pairs_of_a_dense_group_are_not_emitted(as_documents, loose_groups, monkeypatch):
    """Only links leave the blocks, of short texts; long ones are verified after, with the same groups."""
    docs, met = stage(as_documents(loose_groups)), {}
    monkeypatch.setattr(simhash, "stage", lambda df, label, f=stage: met.setdefault(label, f(df, label)) if label == "between" else f(df, label))
    groups = grouped(docs, together=5, partners=1)
    sets = len(loose_groups)
    assert met["between"].filter("not sure").count() == 0 and met["between"].count() < sets
    met.clear()
    monkeypatch.setattr(simhash, "SHORT", 0)
    assert grouped(docs, together=5, partners=1) == groups
    assert met["between"].filter("sure").count() == 0 and met["between"].count() > sets


def test_blocks_of_a_long_list_meet_where_roots_differ(spark):
    """Every pair of different roots once, whatever the blocks; equal roots never."""
    find_package(spark)
    dice = np.random.default_rng(3)
    for roots in ([7] * 30 + [9] * 3, list(range(15)), [1] * 4 + [2] * 4 + [3] * 12 + [4]):
        rows = [(int(n), bytes(simhash.WIDE), int(r)) for n, r in enumerate(roots)]
        prints = spark.createDataFrame([rows[i] for i in dice.permutation(len(rows))], "node long, fp binary, root long")
        lists = simhash._dealt(prints, 2, ("node",)).select("list").distinct().limit(1)
        for together in (1, 4):
            got = {(r.a, r.b) for r in simhash.between_groups(prints, stage(lists), together=together).collect()}
            assert got == {(i, j) for j in range(len(roots)) for i in range(j) if roots[i] != roots[j]}


def test_lists_of_three_positions(as_documents, monkeypatch):
    monkeypatch.setattr(simhash, "MANY", 0)
    dice, rows = random.Random(4), []
    for k in range(60):
        text = noise(700 + k, 150)
        rows += [(2 * k, text, "s"), (2 * k + 1, edited(text, 0.85, 0.95, dice), "s")]
    kept = {r.doc_id for r in simhash.keep_dissimilar(stage(as_documents(rows))).collect()}
    assert {2 * k for k in range(60)} <= kept and len(kept) <= 62


def test_near_copies_of_nothing(no_docs):
    assert simhash.keep_dissimilar(no_docs).count() == 0


@pytest.mark.parametrize("seed", range(5))
def test_forest_spans_and_is_least(seed):
    dice = np.random.default_rng(seed)
    a, b = dice.integers(0, 40, (2, 120))
    a, b = a[a != b], b[a != b]
    far = dice.integers(0, 9, len(a))
    taken = simhash._forest(40, a, b, far)
    tree, total = list(range(40)), 0
    for i in np.argsort(far, kind="stable"):
        x, y = tree[a[i]], tree[b[i]]
        if x != y:
            tree = [y if t == x else t for t in tree]
            total += far[i]
    assert far[taken].sum() == total and taken.sum() == 40 - len(set(tree))
