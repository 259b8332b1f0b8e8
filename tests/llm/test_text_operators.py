"""Operators on documents against plain Python on small tables with every awkward case."""

import hashlib
import math
import random
import re
import time
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from conftest import noise

from tablewright.llm import fuzzy, lines, mixing, packing, passages, pii, quality, sharding, simhash
from tablewright.llm.common import find_package
from tablewright.llm.queries import hex_digest, token_file

SPACES = " \t\n\x0b\x0c\r"


def counted(df):
    return Counter(tuple(r) for r in df.collect())


# lines


def plain_lines(rows, least):
    def key(line):
        return line.strip(SPACES).encode().lower()

    found = Counter(k for _, t, _ in rows for k in {key(ln) for ln in (t or "").split("\n")})
    made = Counter()
    for doc, text, _ in rows:
        own = (text or "").split("\n")
        kept = [ln for ln in own if not (key(ln) and found[key(ln)] >= least)]
        made[doc, "\n".join(kept), len(own), len(own) - len(kept)] += 1
    return made


@pytest.mark.parametrize("least", [2, 10])
def test_lines(tricky_docs, tricky_rows, least):
    done = lines.dedup_lines(tricky_docs, least=least)
    assert counted(done.select("doc_id", "__kept", "__lines", "__dropped")) == plain_lines(tricky_rows, least)
    assert done.columns[: len(tricky_docs.columns)] == tricky_docs.columns


def test_lines_of_nothing(no_docs):
    assert lines.dedup_lines(no_docs).count() == 0


def test_line_index_is_reversible(spark, as_documents, tricky_rows):
    first, second = tricky_rows[::2], tricky_rows[1::2]
    one = lines.LineIndex.empty(spark, least=3, shards=4).insert(as_documents(first))
    both = one.insert(as_documents(second))
    back = both.delete(as_documents(second))
    assert counted(back.counts) == counted(one.counts)
    whole = lines.LineIndex.empty(spark, least=3, shards=4).insert(as_documents(tricky_rows))
    assert counted(both.counts) == counted(whole.counts)
    hot = {(r.k1, r.k2) for r in both.counts.filter("n >= 3").collect()}
    found = lines.occurrences(as_documents(tricky_rows))
    assert {(r.k1, r.k2) for r in both.shared(found, salts=3).collect()} == hot
    hot = {(r.k1, r.k2) for r in back.counts.filter("n >= 3").collect()}
    assert {(r.k1, r.k2) for r in back.shared(found, salts=3).collect()} == hot


def test_index_of_documents_is_made_at_once(spark, as_documents, tricky_rows, monkeypatch):
    """No join with an index of nothing: one table of counts and one of filters."""
    docs, made = as_documents(tricky_rows), []
    grown = lines.LineIndex.empty(spark, least=3, shards=4).insert(docs)
    monkeypatch.setattr(lines, "stage", lambda df, label, f=lines.stage: made.append(label) or f(df, label))
    at_once = lines.LineIndex.of(lines.occurrences(docs), least=3, shards=4)
    assert made == ["line-counts", "line-filters"] and at_once.shards == grown.shards
    assert set(at_once.counts.collect()) == set(grown.counts.collect())
    found = lines.occurrences(docs)
    one, two = (Counter(i.shared(found).select("k1", "k2").collect()) for i in (at_once, grown))
    assert one == two and one


def test_line_filter_grows_when_it_overflows(spark, as_documents):
    few = as_documents([(i, "same", "s") for i in range(2)])
    many = as_documents([(i, "\n".join(f"line {n}" for n in range(3000)), "s") for i in range(2)])
    index = lines.LineIndex.empty(spark, least=2, shards=1).insert(few).insert(many)
    assert index.shared(lines.occurrences(many)).select("k1", "k2").distinct().count() == 3000
    assert index.filters.count() == 1


def test_cuckoo_filter():
    dice = np.random.default_rng(1)
    hashes = np.unique(dice.integers(0, 2**63, 5000).astype(np.uint64))
    made = lines.CuckooFilter.of(hashes)
    assert made.has(hashes).all() and (made.table != 0).sum() == len(hashes)
    for h in hashes[:1000].tolist():
        assert made.remove(h)
    assert made.has(hashes[1000:]).all()
    assert made.has(hashes[:1000]).mean() < 0.01
    assert lines.CuckooFilter.from_bytes(made.to_bytes()).has(hashes[1000:]).all()
    assert not lines.CuckooFilter.sized(1).add(hashes[:200])
    part = lines.CuckooFilter.sized(5000)
    assert all(part.add(hashes[i : i + 7]) for i in range(0, 4000, 7)) and part.has(hashes[:4000]).all()
    assert part.add(hashes[:0]) and part.add(np.repeat(hashes[4500:4501], 8)) and part.has(hashes[4500:4501]).all()


def test_a_million_keys_enter_a_filter_in_seconds():
    hashes = np.unique(np.random.default_rng(2).integers(0, 2**63, 1_000_000).astype(np.uint64))
    start = time.perf_counter()
    made = lines.CuckooFilter.of(hashes)
    assert time.perf_counter() - start < 15
    assert made.has(hashes).all() and (made.table != 0).sum() == len(hashes)


def test_shards_grow_with_the_keys(spark, as_documents, monkeypatch):
    monkeypatch.setattr(lines, "SHARD_KEYS", 40)
    docs = as_documents([(i, "\n".join(f"line {n}" for n in range(i % 2 * 200, i % 2 * 200 + 300)), "s") for i in range(4)])
    index = lines.LineIndex.empty(spark, least=2, shards=2).insert(docs)
    assert index.shards == 26 and index.filters.count() == 26
    found = lines.occurrences(docs)
    assert index.shared(found, salts=2).select("k1", "k2").distinct().count() == 500
    gone = index.delete(as_documents([(3, "\n".join(f"line {n}" for n in range(200, 500)), "s")]))
    assert gone.shards == 26 and gone.shared(found, salts=2).select("k1", "k2").distinct().count() == 300
    one, many = (lines.dedup_lines(docs, least=2, shards=n) for n in (1, 50))
    assert counted(one) == counted(many)


def test_columns_of_any_names_pass_through(spark):
    names = ["__kept", "__lines", "__dropped", "__k1", "__k2", "__r1", "__r2", "__n", "r1", "row", "body", "n", "root"]
    find_package(spark)
    docs = spark.createDataFrame([(i, f"line\n{noise(i % 3, 9)}", *[f"{c}{i}" for c in names]) for i in range(6)], ["doc_id", "text", *names])
    done = lines.dedup_lines(docs, least=3)
    assert done.columns == ["doc_id", "text", *names[3:], "__kept", "__lines", "__dropped"]
    assert {(r.doc_id, r["__n"], r["__kept"], r["__dropped"]) for r in done.collect()} == {(i, f"__n{i}", noise(i % 3, 9), 1) for i in range(6)}
    for kept in (simhash.keep_one(docs), simhash.keep_dissimilar(docs)):
        assert kept.columns == docs.columns and {(r.doc_id, r["__r1"], r["__kept"]) for r in kept.collect()} == {(i, f"__r1{i}", f"__kept{i}") for i in range(3)}


# passages


def plain_passages(rows, window):
    """Of each row: words, removed words, digest of the rest."""
    first = {}
    order = sorted(range(len(rows)), key=lambda i: (rows[i][0] is None, rows[i][0] or 0))
    for i in order:
        words = (rows[i][1] or "").encode().split()
        for at in range(len(words) - window + 1):
            place = (rows[i][0] is None, rows[i][0] or 0, at)
            text = tuple(words[at : at + window])
            first[text] = min(first.get(text, place), place)
    made = Counter()
    for doc, text, _ in rows:
        words = (text or "").encode().split()
        gone = [False] * len(words)
        for at in range(len(words) - window + 1):
            if first[tuple(words[at : at + window])] != (doc is None, doc or 0, at):
                gone[at : at + window] = [True] * window
        kept = [w for w, g in zip(words, gone) if not g]
        made[doc, len(words), sum(gone), hex_digest(kept).decode()] += 1
    return made


@pytest.mark.parametrize("window", [20, 14])
def test_passages(tricky_docs, tricky_rows, window):
    done = passages.dedup_passages(tricky_docs, window=window, render=hex_digest)
    assert counted(done.select("doc_id", "n_words", "n_removed", F.col("kept").cast("string"))) == plain_passages(tricky_rows, window)


def test_passages_of_rows_that_share_key_and_tag(as_documents, monkeypatch):
    """Rows without a key whose 32 bits agree keep their own words, however short."""
    monkeypatch.setattr(passages, "_tag", lambda r1="r1": F.lit(1))
    shared = noise(70, 30)
    rows = [(None, f"{noise(600 + i, 3 * i)} {shared} {noise(700 + i, 40 - i)}", "s") for i in range(40)]
    rows += [(None, noise(800 + i, 21 + i), "s") for i in range(5)] + [(1, noise(900, 25), "s"), (2, shared, "s")]
    docs = as_documents(rows)
    done = passages.dedup_passages(docs, window=20, render=hex_digest)
    assert counted(done.select("doc_id", "n_words", "n_removed", F.col("kept").cast("string"))) == plain_passages(rows, 20)


def test_passages_of_nothing_and_of_short_windows(no_docs):
    assert passages.dedup_passages(no_docs).count() == 0
    with pytest.raises(ValueError):
        passages.dedup_passages(no_docs, window=13)


def test_cover_meets_every_pair_of_places():
    for shift in range(passages.PERIOD):
        differences = {(a - b) % passages.PERIOD for a in passages.COVER for b in passages.COVER}
        assert shift in differences


# near duplicates


def plain_fingerprint(text):
    words = (text or "").encode().lower().split()
    grams = [b" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))] if words else []
    hashes = [xxhash.xxh64_intdigest(g, seed=42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_components(prints, bits):
    """Least reachable index of each of a list of fingerprints."""
    parent = list(range(len(prints)))

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i in range(len(prints)):
        for j in range(i):
            if (prints[i] ^ prints[j]).bit_count() <= bits:
                a, b = root(i), root(j)
                parent[max(a, b)] = min(a, b)
    return [root(i) for i in range(len(prints))]


def test_near_duplicates(tricky_docs, tricky_rows):
    prints = [plain_fingerprint(t) for _, t, _ in tricky_rows]
    roots = plain_components(prints, 2)
    least = {}
    for (doc, _, _), root in zip(tricky_rows, roots):
        if doc is not None:
            least[root] = min(least.get(root, doc), doc)
    want = Counter((d, p - (1 << 64) if p >> 63 else p, least.get(r)) for (d, _, _), p, r in zip(tricky_rows, prints, roots))
    assert counted(simhash.near_duplicates(tricky_docs).select("doc_id", "fp", "component")) == want
    kept = simhash.keep_one(tricky_docs)
    assert kept.count() == len(set(roots)) and kept.columns == tricky_docs.columns


@pytest.mark.parametrize("bits", [1, 2])
def test_links_lose_nothing(spark, bits):
    dice = np.random.default_rng(bits)
    seeds = dice.integers(0, 2**63, 40, dtype=np.uint64)
    prints = set(seeds.tolist())
    for seed in seeds.tolist():
        at = seed
        for _ in range(12):  # chains of small steps
            at ^= 1 << int(dice.integers(64))
            prints.add(at)
    base = int(seeds[0])
    prints |= {base ^ low for low in range(600)}  # one list above the size that is compared pair by pair
    prints = sorted(prints)
    frame = spark.createDataFrame([(p - (1 << 64) if p >> 63 else p,) for p in prints], "fp long").repartition(5)
    roots = {r.node: r.root for r in simhash.connected_components(simhash.links(frame, bits)).collect()}
    want = plain_components(prints, bits)
    groups = defaultdict(set)
    for p, w in zip(prints, want):
        signed = p - (1 << 64) if p >> 63 else p
        groups[w].add(roots.get(signed, signed))
    assert all(len(g) == 1 for g in groups.values()) and len(set(map(min, groups.values()))) == len(groups)


def test_identity_tells_nulls_apart(as_documents):
    docs = as_documents([(None, "5", "s"), (5, None, "s")])
    assert simhash.fingerprints(docs).select("r1", "r2").distinct().count() == 2
    assert counted(simhash.keep_one(docs).select("doc_id", "text")) == Counter([(None, "5"), (5, None)])


def test_near_duplicates_of_nothing(no_docs):
    assert simhash.near_duplicates(no_docs).count() == 0 and simhash.keep_one(no_docs).count() == 0


# packing


def test_packing_is_a_round_trip(tricky_docs, tricky_rows):
    path = token_file()
    items = packing.stage(packing.pieces(tricky_docs, path, ids=True))
    placed = packing.pack(items, salts=3).collect()
    encode = packing.tokenizer(path)
    want = Counter()
    for doc, text, _ in tricky_rows:
        want[doc, np.array([*encode.encode(text or "", add_special_tokens=False).ids, 1], "<u4").tobytes()] += 1
    bodies, found = defaultdict(list), Counter()
    for r in sorted(placed, key=lambda r: (r.r1, r.start)):
        assert zlib.crc32(r.ids) == r.ids_crc32 and len(r.ids) == 4 * r.length <= 4 * 2048
        bodies[r.doc_id, r.r1, r.r2].append(r)
    for (doc, _, _), parts in bodies.items():
        copies = Counter(p.start for p in parts)
        times = set(copies.values())
        assert len(times) == 1
        one = {p.start: p.ids for p in parts}
        found[doc, b"".join(one[s] for s in sorted(one))] += times.pop()
    assert found == want
    held = defaultdict(list)
    for r in placed:
        held[r.sequence_id].append((r.offset, r.length))
    assert sorted(held) == list(range(len(held)))
    for parts in held.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= 2048
    made = packing.sequences(packing.pack(items)).collect()
    assert len(made) == len(held) and all(len(r.ids) == 4 * 2048 for r in made)


def test_packing_of_nothing(no_docs):
    assert packing.pack_documents(no_docs, token_file()).count() == 0


def test_packed_documents_rebuild_sequences_and_copies(tricky_docs, tricky_rows):
    path = token_file()
    encode = packing.tokenizer(path)
    placed = packing.stage(packing.pack_documents(tricky_docs, path, ids=True))
    rows, want, found = placed.collect(), Counter(), defaultdict(dict)
    for doc, text, _ in tricky_rows:
        want[doc, np.array([*encode.encode(text or "", add_special_tokens=False).ids, 1], "<u4").tobytes()] += 1
    for r in rows:
        parts = found[r.doc_id, r.r1, r.r2, r.copy]
        assert r.start not in parts
        parts[r.start] = r.ids
    assert Counter((doc, b"".join(parts[s] for s in sorted(parts))) for (doc, *_), parts in found.items()) == want
    whole = {r.sequence_id: r.ids for r in packing.sequences(placed).collect()}
    assert {r.sequence_id for r in rows} == set(whole)
    assert all(whole[r.sequence_id][4 * r.offset : 4 * (r.offset + r.length)] == r.ids for r in rows)
    assert packing.pack_documents(tricky_docs, path).columns == [
        "doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"
    ]


def test_encoder_equals_the_tokenizer():
    path = token_file()
    encode, plain = packing.encoder(path), packing.tokenizer(path)
    texts = ["", " ", "  a", "a  b", "a b ", "it's 'tis don't", "x\n y", "a b c", "a  b", "<|endoftext|> a", "1 22 a1", "日本 語", "a\tb c\r\n d"]
    for text in texts * 2:
        assert encode(text) == np.array(plain.encode(text, add_special_tokens=False).ids, "<u4").tobytes(), text


def test_best_fill_is_best():
    dice = np.random.default_rng(3)
    for _ in range(60):
        room = int(dice.integers(1, 60))
        counts = {int(n): int(c) for n, c in zip(dice.integers(1, 30, 5), dice.integers(1, 4, 5))}
        reach = {0}
        for n, c in counts.items():
            reach = {s + n * k for s in reach for k in range(c + 1)}
        used = packing._best_fill(counts, room)
        assert all(c <= counts[n] for n, c in used.items())
        assert sum(n * c for n, c in used.items()) == max(s for s in reach if s <= room)


# mixing


def test_mixing(tricky_docs, tricky_rows):
    sizes = Counter()
    for _, text, source in tricky_rows:
        sizes[source] += len((text or "").encode().split())
    order = sorted((s for s in sizes if s is not None), key=lambda s: s.encode()) + ([None] if None in sizes else [])
    weights = {s: (5, 2, 1)[i % 3] for i, s in enumerate(order)}
    capped, level = set(), 0
    while True:
        rest = sum(sizes.values()) - sum(3 * sizes[s] for s in capped)
        level = rest / sum(w for s, w in weights.items() if s not in capped)
        more = {s for s in sizes if s not in capped and weights[s] * level > 3 * sizes[s]}
        if not more:
            break
        capped |= more
    got = mixing.taken(tricky_docs).collect()
    assert Counter((r.doc_id, r.size) for r in got) == Counter((d, len((t or "").encode().split())) for d, t, _ in tricky_rows)
    assert all(0 <= r.copies <= 3 for r in got)
    by = {r.source: r for r in mixing.targets(mixing.measured(tricky_docs)).collect()}
    for s in sizes:
        assert by[s].source_size == sizes[s]
        assert by[s].target == pytest.approx(min(3 * sizes[s], weights[s] * level))
    assert counted(mixing.taken(tricky_docs)) == Counter(tuple(r) for r in got)
    mixed = mixing.mix(tricky_docs)
    assert mixed.columns == tricky_docs.columns and mixed.count() == sum(r.copies for r in got)


def test_mixing_comes_near_its_targets(as_documents):
    rows = [(i, "w " * (1 + i * 7919 % 200), f"s{i % 5}") for i in range(600)]
    docs = as_documents(rows)
    taken = mixing.taken(docs).collect()
    source = {i: s for i, _, s in rows}
    for s in set(source.values()):
        own = [r for r in taken if source[r.doc_id] == s]
        assert sum(r.size * r.copies for r in own) == pytest.approx(own[0].target, rel=0.05)


def test_mixing_of_nothing(no_docs, as_documents):
    assert mixing.taken(no_docs).count() == 0 and mixing.mix(no_docs).count() == 0
    assert mixing.taken(as_documents([(1, None, "a"), (2, "", None)])).count() == 2


# sharding


@pytest.mark.parametrize("ranges", [16, 1024])
def test_sharding(tricky_docs, tricky_rows, ranges):
    got = sharding.shard(tricky_docs, shards=4, ranges=ranges).collect()
    want = Counter((d, len((t or "").encode()) + 1, zlib.crc32((t or "").encode())) for d, t, _ in tricky_rows)
    assert Counter((r.doc_id, r.size, r.text_crc32) for r in got) == want
    slots = defaultdict(list)
    for r in got:
        slots[r.shard].append(r.slot)
    assert all(sorted(s) == list(range(len(s))) for s in slots.values()) and set(slots) <= set(range(4))


def test_sharding_cuts_a_hot_text(as_documents):
    rows = [(i, "the same text", "s") for i in range(900)] + [(1000 + i, f"text number {i}", "s") for i in range(900)]
    held = Counter()
    for r in sharding.shard(as_documents(rows), shards=4, ranges=64).collect():
        held[r.shard] += r.size
    assert len(held) == 4 and max(held.values()) < 1.1 * min(held.values())


def test_sharding_of_nothing(no_docs):
    assert sharding.shard(no_docs).count() == 0


# fuzzy fingerprints


def test_edit_trial(tricky_docs, tricky_rows):
    rows = [r for r in tricky_rows if r[0] not in (None, 400, 401)]
    docs = tricky_docs.filter("doc_id is not null and doc_id not in (400, 401)")
    order = sorted(rows, key=lambda r: -r[0])
    got = {r.doc_id: r for r in fuzzy.edit_trial(docs).collect()}
    for i, (doc, text, _) in enumerate(order):
        own, after = text or "", order[(i + 1) % len(order)][1] or ""
        half = len(own) // 2
        body = own[: len(own) - half] + after[:half]
        r = got[doc]
        assert r.n_chars == len(own) and r.edited == hashlib.sha256(body.encode()).hexdigest()
        assert r.fingerprint == fuzzy.fingerprint(own.encode())
        assert r.edited_fingerprint == fuzzy.fingerprint(body.encode())
        assert r.near_next == fuzzy.likeness(r.fingerprint, fuzzy.fingerprint(after.encode()))
        assert 0 <= r.near_edited <= 1
    assert fuzzy.edit_trial(tricky_docs).count() == len(tricky_rows)


def test_edit_trial_of_one_and_of_nothing(as_documents, no_docs):
    assert fuzzy.edit_trial(no_docs).count() == 0
    (row,) = fuzzy.edit_trial(as_documents([(1, "abcd", None)])).collect()
    assert row.edited == hashlib.sha256(b"abab").hexdigest() and row.near_next == 1


def test_edit_distance():
    dice = np.random.default_rng(5)
    for _ in range(200):
        a, b = ("".join(dice.choice(list("ABC"), dice.integers(0, 20))) for _ in range(2))
        table = [[i + j if i * j == 0 else 0 for j in range(len(b) + 1)] for i in range(len(a) + 1)]
        for i in range(1, len(a) + 1):
            for j in range(1, len(b) + 1):
                same = table[i - 1][j - 1] if a[i - 1] == b[j - 1] else 10**9
                table[i][j] = min(table[i - 1][j] + 1, table[i][j - 1] + 1, same)
        assert fuzzy._distance(a, b) == table[-1][-1]


# personal data


def luhn(digits):
    total = 0
    for i, d in enumerate(reversed(digits)):
        n = int(d) * (1 + i % 2)
        total += n - 9 if n > 9 else n
    return total % 10 == 0


def plain_spans(text):
    found = [("email", *m.span()) for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text)]
    for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text):
        if all(int(x) <= 255 for x in m[0].split(".")):
            found.append(("ip", *m.span()))
    for kind, pattern, least, most in (("card", r"[0-9]([\x20-]?[0-9])+", 13, 19), ("phone", r"\+[0-9][\x20().0-9-]+[0-9]", 9, 15)):
        for m in re.finditer(pattern, text):
            digits = re.sub("[^0-9]", "", m[0])
            if least <= len(digits) <= most and (kind == "phone" or luhn(digits)):
                found.append((kind, *m.span()))
    return found


PRIVATE = [
    "a@b.c_d@e.f x@y z@z..z q@w.e.", "@@a@b.co", "é@x.de 👍 me@x.de", "1.2.3.4.5 01.002.0003.4 256.1.1.1 1.2.3",
    "4111111111111111 4111111111111112 4-1-1-1 1111 1111 1111 1", "+1 (555) 555-2368 +49-30-1234567 +1 +12", "+1 (988) 555-2485 4041894974608795",
    "9" * 5000, "a" * 50_000, "a.b@" * 3000, "+" * 3000 + "1" * 30, "1.1.1." * 2000, "\n".join(["x@y.zz"] * 50), "", None,
    "1" * 3000 + " 4111 1111 1111 1111", "tel 555-123-4567, order 12345678901234567",
]


def test_personal_data(as_documents, tricky_rows):
    rows = [(i, t, "s") for i, t in enumerate(PRIVATE)] + [r for r in tricky_rows if r[0] is not None and r[0] < 400]
    rows = [(1000 + i, t, s) for i, (_, t, s) in enumerate(rows)]
    got = {r.doc_id: r for r in pii.find_spans(as_documents(rows)).collect()}
    for doc, text, _ in rows:
        want = plain_spans(text or "")
        assert [tuple(s) for s in got[doc].base] == want, text[:60]
        assert set(want) <= {tuple(s) for s in got[doc].spans}


def plain_masked(text, spans):
    made, at = "", 0
    for start, end, kind in sorted((s, e, k) for k, s, e in spans):
        made += text[at:start] if start > at else ""
        made += f"<{kind}>" if end > at else ""
        at = max(at, end)
    return made + text[at:]


def test_personal_data_of_nothing_and_masked(no_docs, as_documents, tricky_rows):
    assert pii.find_spans(no_docs).count() == 0 and pii.mask(no_docs).count() == 0
    docs = as_documents([(1, "to é@x me@x.de, 1.2.3.4!", "s"), (2, None, "s"), (3, "none", "s"), (None, "👍 a@b.co", "s"), (None, "c@d.eu", "t"), (3, "+1 (555) 555-2368", "s")])
    masked = pii.mask(docs)
    assert masked.columns == docs.columns and masked.dtypes == docs.dtypes
    assert Counter((r.doc_id, r.text, r.source) for r in masked.collect()) == Counter(
        [(1, "to é@x <email>, <ip>!", "s"), (2, None, "s"), (3, "none", "s"), (None, "👍 <email>", "s"), (None, "<email>", "t"), (3, "<phone>", "s")]
    )
    rows = [(i, t, "s") for i, t in enumerate(PRIVATE)] + tricky_rows
    rows = [(1000 + i, t, s) for i, (_, t, s) in enumerate(rows)]
    found = {r.doc_id: [tuple(s) for s in r.spans] for r in pii.find_spans(as_documents(rows)).collect()}
    assert {r.doc_id: r.text for r in pii.mask(as_documents(rows)).collect()} == {
        doc: None if text is None else plain_masked(text, found[doc]) for doc, text, _ in rows
    }


def test_places_and_surroundings_of_matches(as_documents):
    """Places and contexts as slices of the text give them, with short gaps and none."""
    dice, rows = random.Random(2), []
    for i in range(60):
        parts = [dice.choice(["1.2.3.4", "10.0.0.1", ".", " ", "é", "x y z", "9" * dice.randint(1, 4), "👍" * dice.randint(0, 40)]) for _ in range(40)]
        rows.append((i, dice.choice(["", " ", "-"]).join(parts), "s"))
    pattern = pii.LOOSE["ip"]
    found = as_documents(rows).select("doc_id", pii._located(F.col("text"), pattern, pii.LOOSE_GUARD["ip"], True).alias("s")).collect()
    texts = {doc: t for doc, t, _ in rows}
    for r in found:
        text = texts[r.doc_id]
        want = [(m.start(), m.end(), m[0], text[max(0, m.start() - 24) : m.start()].lower(), text[m.end() : m.end() + 1]) for m in re.finditer(pattern, text)]
        assert [tuple(s) for s in r.s] == want


@pytest.mark.parametrize("size", [0, 1, 127, 128, 129, 1000])
def test_running_totals(spark, size):
    dice = np.random.default_rng(size)
    values = dice.integers(0, 50, size).tolist()
    df = spark.createDataFrame([(values,)], "v array<int>")
    row = df.select(pii._running(F.col("v"), lambda a, b: a + b).alias("s"), pii._running(F.col("v"), F.greatest).alias("m")).first()
    assert row.s == np.cumsum(values).tolist() and row.m == (np.maximum.accumulate(values).tolist() if size else [])


def test_candidates_that_touch_no_base_span(spark):
    dice = random.Random(6)
    for _ in range(5):
        base = [(s, s + dice.randint(1, 9)) for s in (dice.randint(0, 3000) for _ in range(200))]
        found = sorted((s, s + dice.randint(1, 9)) for s in (dice.randint(0, 3000) for _ in range(300)))
        df = spark.createDataFrame([(found, base)], "c array<struct<start:int,end:int>>, b array<struct<start:int,end:int>>")
        got = df.select(pii._free(F.col("c"), F.col("b")).alias("f")).first().f
        assert sorted(map(tuple, got)) == [c for c in found if not any(b[0] < c[1] and c[0] < b[1] for b in base)]


def test_texts_of_many_matches_and_nested_labels(as_documents):
    """Long texts take time in proportion, and none needs a deep stack."""
    rows = [(1, "a(at)b" + ".aa" * 20_000, "s"), (2, "555-123-4567 " * 300_000, "s"), (3, "4111111111111111, 1.2.3.4 x@y.zz " * 20_000, "s")]
    start = time.perf_counter()
    got = {r.doc_id: r for r in pii.find_spans(as_documents(rows)).select("doc_id", F.size("base").alias("base"), F.size("spans").alias("spans")).collect()}
    assert got[3].base == 60_000 and got[2].base == 0
    assert time.perf_counter() - start < 150


def test_labelers_that_agree_are_believed():
    counts = {("card", 1, 1, 1, 1, 1): 50, ("card", 1, 1, 0, 1, 1): 200, ("card", -1, -1, 0, 1, -1): 40, ("card", -1, 1, 0, 1, 1): 10}
    real = pii.reliabilities(counts)
    assert real["card", 1, 1, 0, 1, 1] > 0.95 and real["card", -1, -1, 0, 1, -1] < 0.05


# quality


def test_quality_learns_and_scores_every_text(spark, as_documents, tricky_docs, tricky_rows):
    good = [(i, " ".join(f"word{(i * 31 + j * 7) % 97}" for j in range(60)) + ".", "s") for i in range(200)]
    bad = [(1000 + i, " ".join(f"JUNK{(i * 13 + j * 5) % 89}$$$" for j in range(60)), "s") for i in range(100)]
    labels = spark.createDataFrame([(i, int(i < 1000), None) for i, _, _ in good[::2] + bad[::2]] + [(None, 1, 0), (5, None, 0)], "doc_id long, quality int, toxic int")
    model = quality.fit(as_documents(good + bad), labels)
    scored = quality.score(as_documents(good[1::2] + bad[1::2]), model).collect()  # takes the place of the column there
    assert all((r.score >= 0.7) == (r.doc_id < 1000) for r in scored)
    every = quality.score(tricky_docs, model, "made").collect()
    assert len(every) == len(tricky_rows) and all(0 <= r.made <= 1 for r in every)
    again = quality.fit(as_documents(good + bad), labels)
    assert np.array_equal(model.at, again.at) and np.allclose(model.weights, again.weights)


def plain_model(rows, epochs=4):
    """FTRL-proximal over dictionaries, in the order that the operator documents: (key hash, rows) permuted by epoch."""
    z, n = defaultdict(float), defaultdict(float)

    def weight(c):
        slack = math.copysign(max(abs(z[c]) - 0.01, 0), z[c])
        return -slack / ((1 + math.sqrt(n[c])) / 1.0 + 0.1)

    for epoch in range(epochs):
        for i in np.random.default_rng(epoch).permutation(len(rows)):
            label, vector = rows[i]
            held = {c: weight(c) for c in vector}
            guess = 1 / (1 + math.exp(-max(-40, min(40, sum(held[c] * x for c, x in vector.items())))))
            for c, x in vector.items():
                g = (guess - label) * x
                z[c] += g - (math.sqrt(n[c] + g * g) - math.sqrt(n[c])) * held[c]
                n[c] += g * g
    return {c: weight(c) for c in z if weight(c)}


def test_quality_against_plain_ftrl(spark, as_documents):
    texts = {i: noise(i, 20 + i) + (" GOOD." if i % 2 else " ###") for i in range(30)}
    labels = spark.createDataFrame([(i, i % 2) for i in texts], "doc_id long, quality int")
    model = quality.fit(as_documents([(i, t, "s") for i, t in texts.items()]), labels)
    order = {r.doc_id: r.h for r in labels.select("doc_id", F.xxhash64("doc_id").alias("h")).collect()}
    rows = []
    for i in sorted(texts, key=order.get):
        found = Counter(quality.columns(texts[i].encode())[0].tolist())
        total = sum(found.values())
        rows.append((i % 2, {0: 1.0} | {c: float(np.float32(k * quality.SCALE / total)) for c, k in found.items()}))
    want = plain_model(rows)
    got = dict(zip(model.at.tolist(), model.weights.tolist()))
    assert got.keys() == want.keys() and all(got[c] == pytest.approx(want[c], rel=1e-6, abs=1e-9) for c in want)


def test_quality_learns_from_a_bounded_number_of_documents(spark, as_documents):
    """One key on many documents does not send all of them to the task that trains."""
    docs = as_documents([(7, f"{noise(i, 12)} good", "s") for i in range(10_000)] + [(8, "bad ###", "s")])
    labels = spark.createDataFrame([(7, 1), (8, 0)], "doc_id long, quality int")
    few = quality.fit(docs, labels, sample=64)
    again = quality.fit(docs.repartition(5), labels, sample=64)
    assert len(few.at) < 64 * 80 and np.array_equal(few.at, again.at) and np.allclose(few.weights, again.weights)


def test_quality_of_nothing(spark, no_docs, tricky_docs):
    labels = spark.createDataFrame([], "doc_id long, quality int")
    model = quality.fit(no_docs, labels)
    assert quality.score(no_docs, model, "made").count() == 0
    assert {r.made for r in quality.score(tricky_docs, model, "made").collect()} == {0.5}
