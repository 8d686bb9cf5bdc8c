"""SimHash classes, token alignment and vector codes against brute force."""

import hashlib
import random
from collections import Counter
from itertools import combinations

import numpy as np
import pytest
import xxhash
from llm_data import COLUMNS, frame, texts

from ledgerlake.llm import simhash, tokenalign, vectorcodes


@pytest.fixture(scope="module")
def odd(spark):
    return frame(spark).repartition(3).cache()


# ----------------------------------------------------------------------- SimHash


def brute_fingerprint(text):
    words = (text or "").encode().lower().split()
    grams = [b" ".join(words[i : i + 3]) for i in range(len(words) - 2)] or ([b" ".join(words)] if words else [])
    votes = [sum(xxhash.xxh64_intdigest(g, 42) >> b & 1 for g in grams) for b in range(64)]
    return sum(1 << b for b in range(64) if 2 * votes[b] > len(grams))


def brute_components(values, radius):
    root = {v: v for v in values}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in combinations(sorted(root), 2):
        if (a ^ b).bit_count() <= radius:
            low, high = sorted((find(a), find(b)))
            root[high] = low
    return {v: find(v) for v in root}


def test_simhash_classes(spark, odd):
    found = Counter((r["id"], r["fingerprint"] % 2**64, r["class_id"], r["n_class"]) for r in simhash.near_classes(odd).collect())
    prints = [(i, brute_fingerprint(t)) for i, t in texts()]
    roots = brute_components({f for _, f in prints}, 2)
    least, sizes = {}, Counter(roots[f] for _, f in prints)
    for i, f in prints:
        if i is not None:
            least[roots[f]] = min(i, least.get(roots[f], i))
    assert found == Counter((i, f, least.get(roots[f]), sizes[roots[f]]) for i, f in prints)


def test_very_long_texts_vote_in_blocks(monkeypatch):
    text = next(t for i, t in texts() if i == 50)
    monkeypatch.setattr(simhash, "VOTES_AT_ONCE", 1000)
    assert simhash.fingerprint(text) == brute_fingerprint(text)


@pytest.mark.parametrize("radius", [0, 2, 4])
def test_balls_link_what_is_near(spark, radius):
    rng = random.Random(radius)
    values = {rng.getrandbits(64) for _ in range(20)}
    for v in list(values):  # chains, and a centre with all its neighbours
        for _ in range(6):
            v ^= 1 << rng.randrange(64)
            v ^= 1 << rng.randrange(64)
            values.add(v)
    centre = rng.getrandbits(64)
    values |= {centre ^ 1 << b for b in range(64)}
    signed = np.array(sorted(values), np.uint64).view(np.int64).tolist()
    links = simhash.ball_links(spark.createDataFrame([(v,) for v in signed], "fingerprint long"), radius).collect()
    assert all(0 < ((a ^ b) % 2**64).bit_count() <= radius for a, b in links)
    assert len(links) == len(set(links))
    classes = brute_components({v % 2**64 for v in signed}, radius)
    joined = {v: v for v in values}

    def find(x):
        while joined[x] != x:
            x = joined[x]
        return x

    for a, b in links:
        low, high = sorted((find(a % 2**64), find(b % 2**64)))
        joined[high] = low
    assert Counter(Counter(find(v) for v in values).values()) == Counter(Counter(classes.values()).values())
    # No more than the neighbours of a variant meet, so links grow with values, not their pairs.
    assert len(links) <= 65 * len(values) or radius == 4


def test_odd_radius_is_refused(spark):
    with pytest.raises(ValueError, match="radius"):
        simhash.ball_links(spark.createDataFrame([(1,)], "fingerprint long"), 3)


def test_hot_fingerprint_and_null_ids(spark):
    rows = spark.range(20000).selectExpr("CAST(NULL AS bigint) AS doc_id", "IF(id % 3 = 0, 'a b c d', '') AS text")
    found = simhash.near_classes(rows)
    assert sorted(tuple(r) for r in found.groupBy("class_id", "n_class").count().collect()) == [
        (None, 6667, 6667), (None, 13333, 13333),
    ]


# --------------------------------------------------------------- token alignment

MORE = [(100, "a▁b"), (101, "<|endoftext|> x <s></s>"), (102, "  lead"), (103, "😀😀é é"), (104, "a" * 3000)]


@pytest.fixture(scope="module")
def aligner():
    with open(tokenalign.BYTE_BPE, "rb") as one, open(tokenalign.PIECE_BPE, "rb") as two:
        return tokenalign.Aligner(one.read(), two.read())


def brute_groups(aligner, text):
    """Token ids of both by group, from ends alone."""
    (a,), (b,) = aligner.tokens([text])
    ends_a = np.cumsum([len(aligner.one.token_bytes[i]) for i in a]).tolist()
    ends_b = np.cumsum([len(aligner.two.token_bytes[i]) for i in b]).tolist()
    groups = []
    for end in sorted(set(ends_a) & set(ends_b)):
        i, j = sum(len(g[0]) for g in groups), sum(len(g[1]) for g in groups)
        groups.append((a[i : ends_a.index(end) + 1], b[j : ends_b.index(end) + 1]))
    return groups


def shown(groups):
    return ";".join(",".join(map(str, a)) + "|" + ",".join(map(str, b)) for a, b in groups)


def test_tokens_are_those_of_the_vocabulary_file(aligner):
    tokenizers = pytest.importorskip("tokenizers")
    plain = tokenizers.Tokenizer.from_file(tokenalign.BYTE_BPE)
    plain.encode_special_tokens = True
    given = [t or "" for _, t in texts() + MORE]
    expected = [e.ids for e in plain.encode_batch([" " + t for t in given], add_special_tokens=False)]
    assert aligner.one.encode(given) == expected


@pytest.mark.parametrize("part_tokens", [500, 1 << 22])
def test_aligned_documents(spark, aligner, monkeypatch, part_tokens):
    monkeypatch.setattr(tokenalign, "PART_TOKENS", part_tokens)
    monkeypatch.setattr(tokenalign, "MATRIX_BYTES", 2000)
    rows = texts() + MORE
    groups = [brute_groups(aligner, t) for _, t in rows]
    linked = [Counter((x, y) for a, b in g for x in a for y in b) for g in groups]
    held = Counter(pair for c in linked for pair in c)
    highest = {}
    for (a, _), n in held.items():
        highest[a] = max(n, highest.get(a, 0))
    expected = Counter()
    for (i, _), g, c in zip(rows, groups, linked):
        best = sum(m for pair, m in c.items() if held[pair] == highest[pair[0]])
        total = sum(m * held[pair] for pair, m in c.items())
        digest = hashlib.sha256(shown(g).encode()).hexdigest() if g else ""
        expected[(i, sum(len(a) for a, _ in g), sum(len(b) for _, b in g), len(g), sum(c.values()), best, total, digest)] += 1
    found = tokenalign.aligned_documents(frame(spark, rows).repartition(3)).collect()
    assert Counter(tuple(r) for r in found) == expected


def test_documents_without_tokens(spark):
    rows = [(1, None), (2, ""), (None, "a▁b"), (1, None)]
    found = tokenalign.aligned_documents(frame(spark, rows)).collect()
    assert Counter(tuple(r) for r in found) == Counter((i, 0, 0, 0, 0, 0, 0, "") for i, _ in rows)
    assert tokenalign.aligned_documents(spark.createDataFrame([], COLUMNS)).collect() == []


def test_overlap_links(spark, aligner):
    rows = texts() + MORE
    found = tokenalign.links(frame(spark, rows).limit(100)).collect()
    by_id = {r["id"]: r for r in found}
    assert len(found) == len(rows)
    for i in (10, 30, 34, 51, 90, 91, 100, 103):
        (a,), (b,) = aligner.tokens([dict(rows)[i]])
        row, cover = by_id[i], [[], []]
        for side, ids, own in ((0, a, aligner.one), (1, b, aligner.two)):
            for k, token in enumerate(ids):
                cover[side] += [k] * len(own.token_bytes[token])
        shared = Counter(zip(*cover))
        assert [tuple(o) for o in row["overlaps"]] == [(x, y, n) for (x, y), n in sorted(shared.items())]
        for x, y, _ in row["overlaps"]:
            assert row["a_group"][x] == row["b_group"][y]


@pytest.mark.parametrize("block", [1, 7, 1 << 20])
def test_products(block):
    rng = np.random.default_rng(block)
    left, right = rng.integers(0, 3, (9, 6)), rng.integers(0, 2, (6, 11))
    left[3], right[2] = 0, 0

    def sparse(dense):
        rows, cols = np.nonzero(dense)
        ptr = np.concatenate([[0], np.cumsum((dense > 0).sum(1))])
        return tokenalign.Csr(ptr, cols, dense[rows, cols], dense.shape[1])

    out = tokenalign.product(sparse(left), sparse(right), block)
    dense = np.zeros((9, 11), np.int64)
    dense[np.repeat(np.arange(9), np.diff(out.ptr)), out.idx] = out.val
    assert (dense == left @ right).all() and (out.val > 0).all()


# ------------------------------------------------------------------ vector codes


def brute_codes(rows, parts=8, entries=16, rounds=6, scale=4096):
    """Codes, errors and final entries in plain Python; rows of (id, vector, label)."""
    kept = [r for r in rows if r[1] is not None and all(x is not None and np.isfinite(x) for x in r[1])]
    kept.sort(key=lambda r: (r[0] is None, r[0] or 0, r[1]))
    whole = [[int(np.floor(scale * float(x))) for x in v] for _, v, _ in kept]
    width = len(whole[0]) // parts
    cut = [[tuple(v[p * width : (p + 1) * width]) for p in range(parts)] for v in whole]
    books = [[c[p] for c in cut[:entries]] for p in range(parts)]

    def nearest(x, book):
        return min((sum((i - j) ** 2 for i, j in zip(x, c)), e) for e, c in enumerate(book))

    for _ in range(rounds):
        found = [[nearest(c[p], books[p])[1] for p in range(parts)] for c in cut]
        for p in range(parts):
            for e in range(len(books[p])):
                own = [c[p] for c, f in zip(cut, found) if f[p] == e]
                if own:
                    books[p][e] = tuple(sum(col) // len(own) for col in zip(*own))
    last = [[nearest(c[p], books[p]) for p in range(parts)] for c in cut]
    codes = Counter((r[0], "".join(f"{e:02x}" for _, e in f), sum(d for d, _ in f)) for r, f in zip(kept, last))
    return codes, np.array(books)


SCHEMA = "vec_id long, embedding array<float>, label int, code string, error double, v int, n int"


def vectors(count, dims, seed, spread=0.2):
    rng = random.Random(seed)
    centres = [[rng.gauss(0, 1) for _ in range(dims)] for _ in range(5)]
    rows = []
    for k in range(count):
        centre = centres[k % 5]
        v = [float(np.float32(c + rng.gauss(0, spread))) for c in centre]
        rows.append((k, v, [None, 1, 2][k % 3]))
    return rows


def table(spark, rows):
    return spark.createDataFrame([(i, v, label, "c", 0.5, 1, 2) for i, v, label in rows], SCHEMA).repartition(3)


@pytest.mark.parametrize("count, dims", [(300, 64), (200, 16), (10, 8)])
def test_vector_codes(spark, count, dims):
    rows = vectors(count, dims, count)
    rows += [(5, rows[0][1], 1), (5, rows[0][1], 1), (None, rows[3][1], None)]  # equal ids, rows and a null id
    rows += [(-1, None, 1), (-2, [None] * dims, 1), (-3, [float("nan")] * dims, 1), (-4, [float("-inf")] * dims, 2)]
    coding = vectorcodes.coded_vectors(table(spark, rows))
    expected, books = brute_codes(rows)
    assert (coding.codebooks == books).all()
    assert Counter((r["id"], r["code"], r["error"]) for r in coding.codes.collect()) == expected


def test_bounds_save_comparisons(spark):
    coding = vectorcodes.coded_vectors(table(spark, vectors(600, 32, 3)))
    assert coding.compared[0] == 600 * 8
    assert sum(coding.compared[1:]) < 0.6 * 5 * 600 * 8


def test_net_displacement_is_no_longer_than_the_way():
    rng = np.random.default_rng(1)
    history = [rng.integers(-50, 50, (2, 4, 3)) for _ in range(4)]
    net = vectorcodes.displacements(history)
    steps = [vectorcodes.displacements(history[k : k + 2])[0] for k in range(3)]
    assert (net[0] <= sum(steps) + 1e-9).all() and (net[3] == 0).all()


def test_ties_take_the_lower_entry():
    book = np.array([[0, 0], [2, 0], [0, 0]])
    nearest, second = vectorcodes.two_nearest(np.array([[1, 0], [0, 0]]), book)
    assert nearest.tolist() == [0, 0] and second.tolist() == [1.0, 0.0]


def test_vectors_of_other_lengths_and_sizes(spark):
    rows = vectors(40, 16, 1)
    coding = vectorcodes.coded_vectors(table(spark, rows + [(99, [1.0], 1), (98, [], None)]))
    by_id = {r["id"]: (r["code"], r["error"]) for r in coding.codes.collect()}
    assert by_id[99] == by_id[98] == (None, None)
    assert (coding.codebooks == brute_codes(rows)[1]).all()
    with pytest.raises(ValueError, match="equal parts"):
        vectorcodes.coded_vectors(table(spark, [(1, [1.0] * 9, 1)]))
    assert vectorcodes.coded_vectors(spark.createDataFrame([], SCHEMA)).codes.collect() == []
    only_nulls = vectorcodes.coded_vectors(table(spark, [(1, None, 1)]))
    assert only_nulls.codes.collect() == []


def test_large_components_are_exact_in_64_bits(spark):
    rows = [(i, [float(np.float32(x * 30000)) for x in v], label) for i, v, label in vectors(60, 8, 9)]
    coding = vectorcodes.coded_vectors(table(spark, rows))
    expected, books = brute_codes(rows)
    assert (coding.codebooks == books).all()
    assert Counter((r["id"], r["code"], r["error"]) for r in coding.codes.collect()) == expected
