"""The operators on a small table with every kind of trouble, against brute force."""

import hashlib
import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest
from llm_data import COLUMNS, frame, texts
from pyspark.sql import functions as F

import corpus_pipeline
from ledgerlake.llm import (
    bytededup,
    components,
    decontam,
    fingerprints,
    htmltext,
    licenses,
    linedup,
    mixing,
    ngramjoin,
    quality,
    tokencounts,
)


@pytest.fixture(scope="module")
def odd(spark):
    return frame(spark).repartition(3).cache()


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], COLUMNS)


def sorted_key(value):
    return (value is not None, value if value is not None else 0)


# ------------------------------------------------------------------ fingerprints


def test_fingerprints(odd):
    found = fingerprints.with_next(odd, group_rows=4).collect()
    rows = sorted(texts(), key=lambda r: (*sorted_key(r[0]), hashlib.md5((r[1] or "").encode()).hexdigest() if r[1] is not None else ""))
    assert Counter(r["id"] for r in found) == Counter(i for i, _ in rows)
    singles = {i for i, n in Counter(i for i, _ in rows).items() if n == 1 and i is not None}
    by_id = {r["id"]: r for r in found}
    checked = 0
    for k, (i, text) in enumerate(rows):
        after = rows[(k + 1) % len(rows)]
        if i not in singles or after[0] not in singles:
            continue
        text, following = text or "", after[1] or ""
        gone = len(text) // 4
        changed = text[: len(text) - gone] + following[:gone]
        row = by_id[i]
        assert row["n_chars"] == len(text)
        assert row["edited_sha256"] == hashlib.sha256(changed.encode()).hexdigest()
        assert row["near_edited"] == pytest.approx(fingerprints.likeness(row["fingerprint"], row["edited_fingerprint"]))
        assert row["near_next"] == pytest.approx(fingerprints.likeness(row["fingerprint"], by_id[after[0]]["fingerprint"]))
        checked += 1
    assert checked > 30
    assert by_id[10]["fingerprint"] == by_id[11]["fingerprint"] and by_id[31]["fingerprint"] == b""
    plain = {(r["id"], bytes(r["fingerprint"])) for r in fingerprints.fingerprints(odd).collect()}
    assert {(r["id"], bytes(r["fingerprint"])) for r in found} == plain


def test_fingerprint_of_one_row_and_none(odd, empty):
    (row,) = fingerprints.with_next(odd.where("doc_id = 53")).collect()
    assert row["near_next"] == 1.0
    assert fingerprints.with_next(empty).count() == 0


# ------------------------------------------------------------------ mixing


def test_mix(odd):
    rows = mixing.mix(odd, block_words=16).collect()
    assert len(rows) == len(texts())
    again = mixing.mix(odd.repartition(5), block_words=16).collect()
    assert Counter(map(tuple, rows)) == Counter(map(tuple, again))
    total = sum(r["size"] for r in rows)
    target = {r["source_size"]: r["target"] for r in rows}
    taken = defaultdict(int)
    for r in rows:
        assert 0 <= r["taken"] <= 2 * r["size"]
        taken[r["source_size"]] += r["taken"]
    assert sum(target.values()) == pytest.approx(1.5 * total)
    for source_size, words in taken.items():
        assert abs(words - target[source_size]) < 1
        assert target[source_size] <= 2 * source_size


def test_targets_share_what_full_sources_leave(spark):
    sizes = spark.createDataFrame([("a", 10), ("b", 1000), ("c", 1000), ("d", 0), (None, 500)], "source string, size long")
    rows = {r["source"]: r["target"] for r in mixing.source_targets(sizes).collect()}
    # Weights 3, 1, 2, 3, 1: a and d are full, the rest share 3765 - 20 by 1, 2, 1.
    assert rows["a"] == 20 and rows["d"] == 0
    assert rows["b"] == pytest.approx(rows[None]) and rows["c"] == pytest.approx(2 * rows["b"])
    assert sum(rows.values()) == pytest.approx(1.5 * 2510)


def test_schedule_is_even(spark):
    sizes = spark.createDataFrame([(s, 100) for s in "abcdef" for _ in range(200)], "source string, size long")
    sources = mixing.source_targets(sizes)
    slots = mixing.schedule(spark, sources, 50).collect()
    quota = {r["sid"]: r["quota"] for r in sources.collect()}
    by_source = defaultdict(list)
    for r in sorted(slots):
        by_source[r["sid"]].append(r["rank"])
    for sid, ranks in by_source.items():
        assert ranks == list(range(-(-quota[sid] // 50)))
    half = sorted(slots)[: len(slots) // 2]
    for sid, ranks in by_source.items():
        assert abs(sum(r["sid"] == sid for r in half) - len(ranks) / 2) <= 6


def test_mix_of_repeated_rows_without_ids(spark, empty):
    rows = spark.range(100_000, numPartitions=8).selectExpr(
        "CAST(NULL AS bigint) AS doc_id", "IF(id % 2 = 0, 'some words here', 'other') AS text", "'a' AS source"
    )
    taken = mixing.mix(rows).groupBy("size").agg(F.sum("taken").alias("n"), F.count("*").alias("rows")).collect()
    assert {r["rows"] for r in taken} == {50_000} and sum(r["n"] for r in taken) == 300_000
    blocks = mixing.mixed_blocks(rows).select("n_words", F.size("pieces").alias("pieces")).collect()
    assert sorted(r["n_words"] for r in blocks) == [300_000 % 1024] + [1024] * (300_000 // 1024)
    # No array is longer than the words of its block.
    assert max(r["pieces"] for r in blocks) <= 1024
    assert mixing.mix(empty).count() == mixing.mixed_blocks(empty).count() == 0


def test_mixed_blocks(odd, empty):
    blocks = sorted(mixing.mixed_blocks(odd, block_words=16).collect(), key=lambda r: r["slot"])
    assert len({r["slot"] for r in blocks}) == len(blocks)
    split = {(i, t): re.findall(r"[^\x20\x09-\x0D]+", t or "") for i, t in texts()}
    taken, by_source = Counter(), defaultdict(list)
    for r in blocks:
        words = re.findall(r"[^\x20\x09-\x0D]+", r["text"])
        assert len(words) == r["n_words"] == sum(p["words"] for p in r["pieces"])
        by_source[r["source"]].append((r["rank"], r["n_words"]))
        at = 0
        for p in r["pieces"]:
            part = words[at : at + p["words"]]
            at += p["words"]
            assert any(i == p["doc_id"] and w[p["start"] : p["start"] + p["words"]] == part for (i, _), w in split.items())
            taken[p["doc_id"]] += p["words"]
    for found in by_source.values():
        assert [rank for rank, _ in found] == list(range(len(found)))
        assert all(n == 16 for _, n in found[:-1])
    expected = Counter()
    for r in mixing.mix(odd, block_words=16).collect():
        expected[r["key_id"]] += r["taken"]
    assert taken == +expected
    # The sources take turns, and their order is that of the schedule.
    half = Counter(r["source"] for r in blocks[: len(blocks) // 2])
    assert all(abs(half[s] - len(found) / 2) <= 6 for s, found in by_source.items())
    assert any(p["pass"] == 1 for r in blocks for p in r["pieces"])
    assert mixing.mixed_blocks(empty).count() == 0


def test_mixed_blocks_keep_white_space(spark):
    docs = spark.createDataFrame([(1, " a\n\nb  c\td ", "s")], "doc_id long, text string, source string")
    (one, two) = sorted(mixing.mixed_blocks(docs, block_words=3, share_percent=100).collect())
    assert (one["text"], two["text"]) == (" a\n\nb  c\t", "d ")


# ------------------------------------------------------------------ n-gram join


def brute_classes(rows, k, percent):
    sets = []
    for _, text in rows:
        w = (text or "").encode().lower().split()
        sets.append({tuple(w[i : i + k]) for i in range(len(w) - k + 1)} or ({tuple(w)} if w else set()))
    root = list(range(len(rows)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a in range(len(rows)):
        for b in range(a):
            both = len(sets[a] & sets[b])
            if both and both * 100 >= percent * len(sets[a] | sets[b]):
                root[find(a)] = find(b)
    groups = defaultdict(list)
    for x in range(len(rows)):
        groups[find(x)].append(rows[x][0])
    smallest = {g: min((i for i in ids if i is not None), default=None) for g, ids in groups.items()}
    return [(rows[x][0], len(sets[x]), smallest[find(x)]) for x in range(len(rows))]


@pytest.mark.parametrize("k, percent", [(3, 90), (5, 80), (2, 60)])
def test_jaccard_classes(odd, k, percent):
    found = ngramjoin.jaccard_classes(odd, words=k, percent=percent)
    rows = Counter((r["id"], r["n_shingles"], r["class_id"]) for r in found.collect())
    assert rows == Counter(brute_classes(texts(), k, percent))


def test_chains_of_near_copies(spark):
    base = [f"w{k}" for k in range(100)]
    rows = []
    for k in range(40):
        for edit in range(3):
            changed = list(base)
            changed[2 * k : 2 * k + edit] = [f"x{k}{e}" for e in range(edit)]
            rows.append((1000 - 7 * k - edit, " ".join(changed)))
        base[2 * k] = f"y{k}"
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    found = ngramjoin.jaccard_classes(docs, words=3, percent=90).collect()
    assert Counter((r["id"], r["n_shingles"], r["class_id"]) for r in found) == Counter(brute_classes(rows, 3, 90))


def test_texts_of_one_passage_are_not_compared(spark, tmp_path):
    rng = random.Random(5)
    passage = " ".join(f"p{k}" for k in range(12))
    rows = [(k, " ".join([passage, *(f"w{rng.randrange(10**6)}" for _ in range(600))])) for k in range(150)]
    rows += [(1000 + k, rows[k][1].replace(" w", " ", 3)) for k in range(20)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    marked = ngramjoin.sketches(docs, "doc_id", "text", 5, 80)
    entries = ngramjoin._lane_entries(marked, str(tmp_path)).select("key", "node")
    met = entries.alias("a").join(entries.alias("b"), F.expr("a.key = b.key AND a.node < b.node"))
    # All but the 20 pairs share the passage alone.
    assert 20 <= met.select("a.node", "b.node").distinct().count() < 200
    found = ngramjoin.jaccard_classes(docs, words=5, percent=80)
    assert {(r["id"], r["class_id"]) for r in found.collect()} == {(k, k % 1000) for k, _ in rows}


def edited(rng, words, edits):
    """`words` with so many of them replaced, dropped or doubled by new ones."""
    words = list(words)
    for _ in range(edits):
        k = rng.randrange(len(words))
        words[k : k + 1] = [f"e{rng.randrange(10**6)}" for _ in range(rng.choice([0, 1, 1, 2]))]
    return words


@pytest.mark.parametrize("percent", [60, 80, 90])
def test_pairs_by_hubs(spark, monkeypatch, percent):
    monkeypatch.setattr(ngramjoin, "LANE_NODES", 1)
    rng = random.Random(percent)
    rows = []
    for _ in range(4):
        base = [f"w{rng.randrange(10**6)}" for _ in range(rng.randrange(90, 220))]
        most = max(3, len(base) * (100 - percent) // 300)
        for _ in range(25):
            copy = edited(rng, base, rng.randrange(most))[: rng.choice([None, None, -len(base) // 10])]
            rows.append((len(rows), " ".join(copy)))
            # A near copy of a copy that may itself be too far from the others.
            rows.append((len(rows), " ".join(edited(rng, copy, rng.randrange(1, 4)))))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    found = ngramjoin.jaccard_classes(docs, words=3, percent=percent).collect()
    expected = Counter(brute_classes(rows, 3, percent))
    assert len({c for _, _, c in expected}) > 8
    assert Counter((r["id"], r["n_shingles"], r["class_id"]) for r in found) == expected


@pytest.mark.parametrize("k, percent", [(3, 90), (5, 80), (2, 60)])
def test_odd_texts_by_hubs(odd, monkeypatch, k, percent):
    monkeypatch.setattr(ngramjoin, "LANE_NODES", 1)
    found = ngramjoin.jaccard_classes(odd, words=k, percent=percent)
    rows = Counter((r["id"], r["n_shingles"], r["class_id"]) for r in found.collect())
    assert rows == Counter(brute_classes(texts(), k, percent))


def test_copies_too_far_from_each_other_are_not_listed(spark, monkeypatch):
    listed, verified = [], ngramjoin._verified

    def count(pairs, *more):
        listed.append(pairs.count())
        return verified(pairs, *more)

    monkeypatch.setattr(ngramjoin, "_verified", count)
    rng = random.Random(11)
    base = [f"w{k}" for k in range(300)]
    rows = [(0, " ".join(base))]
    rows += [(k, " ".join(edited(rng, base, rng.randrange(1, 16)))) for k in range(1, 300)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    found = ngramjoin.jaccard_classes(docs, words=5, percent=80).collect()
    assert Counter((r["id"], r["n_shingles"], r["class_id"]) for r in found) == Counter(brute_classes(rows, 5, 80))
    assert sum(r["class_id"] > 0 for r in found) > 50
    assert sum(listed) < 5 * len(rows)


def test_one_of_each(odd, empty):
    kept = ngramjoin.one_of_each(odd)
    assert kept.columns == odd.columns
    expected = brute_classes(texts(), 5, 80)
    assert kept.count() == len({c for _, n, c in expected if n}) + sum(n == 0 for _, n, _ in expected)
    assert ngramjoin.one_of_each(empty).count() == ngramjoin.jaccard_classes(empty).count() == 0


def test_components(spark):
    links = [(k, k + 1) for k in range(60) if k % 10] + [(200, k) for k in range(100, 160)] + [(5, 5), (300, 7), (7, 300)]
    found = dict(map(tuple, components.components(spark.createDataFrame(links, "a long, b long")).collect()))
    assert all(found[k] == k - (k - 1) % 10 for k in range(2, 60) if (k - 1) % 10)
    assert all(found[k] == 100 for k in [*range(101, 160), 200]) and found[300] == 1


# ------------------------------------------------------------------ decontamination


def test_decontamination(spark, odd, empty):
    words = texts()[-4][1].split()
    passage, near = " ".join(words[5:20]), " ".join(words[25:40])
    bench = spark.createDataFrame(
        [(1, passage.replace("a", "A"), "x"), (2, near[:40] + "#" + near[41:], "x"), (3, "not in any text at all, nowhere", "x"),
         (4, None, "x"), (5, "", "x"), (None, passage, "x"), (6, passage, "x")],
        "item_id long, text string, doc_id string",
    )
    found = decontam.leaks(odd, bench, block_chars=150).collect()
    hits = Counter((r["id"], leak["item"], leak["edits"]) for r in found for leak in r["leaks"])
    at = texts()[-4][0]
    assert hits == Counter({(at, 1, 0): 1, (at, 2, 1): 1, (at, 6, 0): 1})
    kept = decontam.clean(odd, bench)
    assert kept.columns == odd.columns and kept.count() == len(texts()) - 1
    assert decontam.clean(odd, bench.limit(0)).count() == len(texts())
    assert all(not r["leaks"] for r in decontam.leaks(odd, bench.limit(0)).collect())
    assert decontam.leaks(empty, bench).count() == 0


# ------------------------------------------------------------------ lines


def brute_lines(rows):
    places = defaultdict(list)
    for key in sorted(set(rows), key=lambda r: (*sorted_key(r[0]), hashlib.md5(r[1].encode()).digest() if r[1] is not None else b"")):
        lines = (key[1] or "").split("\n")
        for k in range(len(lines) - 2):
            places[tuple(lines[k : k + 3])].append((key, k))
    gone = defaultdict(set)
    for found in places.values():
        for key, k in found[1:]:
            gone[key] |= {k, k + 1, k + 2}
    return Counter(
        (i, None if t is None else "\n".join(x for k, x in enumerate(t.split("\n")) if k not in gone[i, t]), len(gone[i, t]))
        for i, t in rows
    )


def test_line_dedup(odd, empty):
    cut = linedup.dedup_lines(odd)
    rows = Counter((r["doc_id"], r["text"], r["_ll_removed"]) for r in cut.collect())
    assert rows == brute_lines(texts())
    assert any(n for _, _, n in rows)
    kept = linedup.remaining(odd)
    assert kept.columns == odd.columns
    lost = sum(c for (_, t, n), c in rows.items() if n and not t.strip())
    assert kept.count() == len(texts()) - lost
    assert linedup.remaining(empty).count() == 0


# ------------------------------------------------------------------ bytes


@pytest.mark.parametrize("length, anchor, most", [(60, 20, 4096), (60, 30, 1), (400, 200, 4096)])
def test_byte_dedup(odd, length, anchor, most):
    raws = [(i, (t or "").encode()) for i, t in texts()]
    counts = Counter(r[k : k + length] for _, r in raws for k in range(len(r) - length + 1))
    expected = Counter()
    for i, r in raws:
        hit = bytearray(len(r))
        for k in range(len(r) - length + 1):
            if counts[r[k : k + length]] > 1:
                hit[k : k + length] = b"\1" * length
        runs = sum(h and not (k and hit[k - 1]) for k, h in enumerate(hit))
        expected[i, len(r), bytes(b for b, h in zip(r, hit) if not h), runs] += 1
    found = bytededup.dedup_bytes(odd, length=length, anchor=anchor, most=most)
    rows = Counter((r["id"], r["n_bytes"], bytes(r["kept"]), len(r["spans"])) for r in found.collect())
    assert rows == expected


def test_byte_dedup_of_nothing(empty):
    assert bytededup.dedup_bytes(empty).count() == 0


# ------------------------------------------------------------------ the rest


def test_pages(spark):
    rows = [(1, "u", "<article><p>Text.</p></article>", "x"), (1, "u", None, None), (None, None, "", "y")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string, text string")
    found = Counter(map(tuple, htmltext.extract(pages).collect()))
    assert found == Counter([(1, "u", "Text."), (1, "u", ""), (None, None, "")])
    assert htmltext.extract(pages.limit(0)).count() == 0


def test_token_counts(odd, empty):
    encoding = tokencounts.load_encoding()
    flat = tokencounts.write_flat(odd, block_tokens=50)
    names = flat.select("file", "block", F.posexplode("ids").alias("place", "doc_id"))
    found = tokencounts.documents(flat).join(names, ["file", "block", "place"]).collect()
    expected = Counter((i, len(encoding.encode_ordinary(t or ""))) for i, t in texts())
    assert Counter((r["doc_id"], r["n_tokens"]) for r in found) == expected
    by_file = defaultdict(list)
    for r in sorted(found, key=lambda r: (r["file"], r["ordinal"])):
        by_file[r["file"]].append((r["ordinal"], r["start"], r["n_tokens"]))
    for docs in by_file.values():
        assert [d[0] for d in docs] == list(range(len(docs)))
        assert all(a[1] + a[2] + 1 == b[1] for a, b in zip(docs, docs[1:]))
    assert tokencounts.documents(tokencounts.write_flat(empty)).count() == 0


@pytest.mark.parametrize("largest, odd_byte", [(1 << 30, b""), (1 << 30, b"x"), (50, b"")])
def test_scan_of_flat_files(spark, tmp_path, monkeypatch, largest, odd_byte):
    monkeypatch.setattr(tokencounts, "CHUNK_BLOCKS", 2)
    monkeypatch.setattr(tokencounts, "LARGEST", largest)
    end, rng = tokencounts.END_OF_DOCUMENT, np.random.default_rng(5)
    expected = Counter()
    for name, lengths, tail in [("a", [0, 3, 0, 50, 7], 0), ("b", [40], 9), ("c", [], 4), ("d", [], 0), ("e", [1] * 30, 0)]:
        tokens = [t for n in lengths for t in [*rng.integers(0, 50000, n), end]] + [5] * tail
        (tmp_path / name).write_bytes(np.array(tokens, tokencounts.TOKEN).tobytes() + odd_byte)
        expected.update((name, k, n, True) for k, n in enumerate(lengths))
        expected.update([(name, len(lengths), tail, False)] if tail else [])
    blocks = tokencounts.read_flat(spark, f"file://{tmp_path}", block_tokens=6)
    found = tokencounts.documents(blocks).collect()
    assert Counter((r["file"].rsplit("/", 1)[1], r["ordinal"], r["n_tokens"], r["terminated"]) for r in found) == expected


def test_license_scan(odd, empty):
    rows = licenses.scan(odd.withColumn("text", F.concat("text", F.lit("\nReleased under the MIT-License.")))).collect()
    assert len(rows) == len(texts())
    for r in rows:
        assert (r["base_labels"] == "mit") == (r["n_words"] > 0)
        assert r["n_base"] == (r["n_words"] > 0) and r["first_word"] == r["last_word"]
        assert r["labels"] == ("mit,mit-notice" if r["n_words"] else "")
    assert licenses.scan(empty).count() == 0


def labelled(spark):
    good = [(k, f"These are plain words of text number {k}, as people write them. " * (1 + k % 3), 1) for k in range(120)]
    bad = [(200 + k, f"BUY!!! NOW### {k} $$$ ||| @@@ !!! {k} " * (1 + k % 4), 0) for k in range(120)]
    docs = spark.createDataFrame([(i, t) for i, t, _ in good + bad], "doc_id long, text string")
    labels = spark.createDataFrame(
        [(i, q, 0, "x") for i, _, q in good + bad] + [(None, 1, 0, "x"), (7, None, 1, "x"), (9999, 0, 0, "x")],
        "doc_id long, quality int, toxic int, text string",
    )
    return docs, labels


def test_quality(spark, odd, empty):
    docs, labels = labelled(spark)
    model = quality.train(docs, labels)
    scored = docs.join(labels.drop("text"), "doc_id").where(quality.is_held_out(F.col("doc_id")))
    rows = scored.select("quality", quality.score(model, F.col("text")).alias("score")).collect()
    right = sum((r["score"] >= quality.THRESHOLD) == (r["quality"] == 1) for r in rows)
    assert len(rows) > 30 and right / len(rows) > 0.95
    scores = odd.select(quality.score(model, F.col("text")).alias("score")).collect()
    assert len(scores) == len(texts()) and all(0 <= r["score"] <= 1 for r in scores)
    assert quality.accepted(odd, labels).columns == odd.columns
    assert quality.accepted(empty, labels).count() == 0
    assert quality.accepted(docs, labels.limit(0)).count() == docs.count()


def test_quality_never_learns_from_held_out_rows(spark):
    docs, labels = labelled(spark)
    turned = labels.withColumn(
        "quality", F.when(quality.is_held_out(F.col("doc_id")), 1 - F.col("quality")).otherwise(F.col("quality"))
    )
    one, two = (quality.train(docs, x) for x in (labels, turned))
    assert one.base == two.base and all((a == b).all() for a, b in zip(one.tables, two.tables))


def test_pipeline_stages(spark, odd, empty, tmp_path):
    docs, labels = labelled(spark)
    folder = f"file://{tmp_path}"
    odd.write.parquet(f"{folder}/documents.parquet")
    labels.write.parquet(f"{folder}/labels.parquet")
    bench = spark.createDataFrame([(1, " ".join(texts()[-4][1].split()[3:30]))], "item_id long, text string")
    bench.write.parquet(f"{folder}/benchmark.parquet")
    for start in (odd, empty):
        kept = start
        for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
            before = kept.count()
            kept = stage(spark, kept, folder)
            kept.write.parquet(f"{folder}/{name}-{start.count()}")
            kept = spark.read.parquet(f"{folder}/{name}-{start.count()}")
            assert kept.count() <= before
            if k < 4:
                assert kept.columns == start.columns
    assert corpus_pipeline.run(spark, folder).count() > 0


def brute_targets(sizes):
    """Target per source, by pouring 150 % of all words in proportion to 3, 1, 2, at most twice a source's own."""
    names = sorted(sizes, key=lambda n: (n is None, n or ""))
    weight = {n: (3, 1, 2)[k % 3] for k, n in enumerate(names)}
    left, target, open_names = 1.5 * sum(sizes.values()), {}, set(names)
    while open_names:
        level = left / sum(weight[n] for n in open_names)
        full = {n for n in open_names if weight[n] * level >= 2 * sizes[n]}
        if not full:
            target |= {n: weight[n] * level for n in open_names}
            break
        target |= {n: 2.0 * sizes[n] for n in full}
        left -= sum(2 * sizes[n] for n in full)
        open_names -= full
    return target


def test_every_stage_against_brute_force(spark, odd, tmp_path):
    docs, labels = labelled(spark)
    folder, at = f"file://{tmp_path}", texts()[-4][0]
    odd.write.parquet(f"{folder}/documents.parquet")
    labels.write.parquet(f"{folder}/labels.parquet")
    item = " ".join(texts()[-4][1].split()[3:30])
    spark.createDataFrame([(1, item)], "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")
    model = quality.train(odd, labels)
    stages = dict(corpus_pipeline.STAGES)
    kept, rows = odd, texts()

    def after(name):
        nonlocal kept
        stages[name](spark, kept, folder).write.parquet(f"{folder}/{name}")
        kept = spark.read.parquet(f"{folder}/{name}")
        return kept

    def found(frame):
        return Counter((r["doc_id"], r["text"]) for r in frame.collect())

    good = [r for r in rows if model.score(np.stack([quality.describe(r[1])]))[0] >= quality.THRESHOLD]
    assert found(after("quality classifier")) == Counter(good)
    # A document goes with its last line.
    lines = [(i, t) for (i, t, gone), n in brute_lines(good).items() for _ in range(n) if not (gone and t == "")]
    assert found(after("line dedup")) == Counter(lines)
    near = after("n-gram Jaccard join")
    classes = defaultdict(list)
    roots = brute_roots(lines, 5, 80)
    for k, (row, (_, n, _)) in enumerate(zip(lines, brute_classes(lines, 5, 80))):
        classes[roots[k] if n else -1 - k].append(row)
    least = [min(c, key=lambda r: sorted_key(r[0]))[0] for c in classes.values()]
    assert Counter(r["doc_id"] for r in near.collect()) == Counter(least)
    assert not found(near) - Counter(lines)
    remaining = found(near)
    clean = Counter({r: n for r, n in remaining.items() if decontam.normal(item) not in decontam.normal(r[1])})
    assert found(after("benchmark decontamination")) == clean and at not in {i for i, _ in clean}
    sizes = Counter()
    for r in kept.collect():
        sizes[r["source"]] += len((r["text"] or "").encode().split())
    taken = Counter()
    blocks = after("mixing sources").collect()
    for r in blocks:
        taken[r["source"]] += r["n_words"]
        assert len(r["text"].encode().split()) == r["n_words"]
    target = brute_targets(sizes)
    assert all(abs(taken[n] - target[n]) < 1 for n in sizes)
    whole = corpus_pipeline.run(spark, folder).collect()
    assert Counter(map(str, whole)) == Counter(map(str, blocks))


def brute_roots(rows, k, percent):
    sets = []
    for _, text in rows:
        w = (text or "").encode().lower().split()
        sets.append({tuple(w[i : i + k]) for i in range(len(w) - k + 1)} or ({tuple(w)} if w else set()))
    root = list(range(len(rows)))
    changed = True
    while changed:
        changed = False
        for a in range(len(rows)):
            for b in range(a):
                both = len(sets[a] & sets[b])
                if both and both * 100 >= percent * len(sets[a] | sets[b]) and root[a] != root[b]:
                    root[a] = root[b] = min(root[a], root[b])
                    changed = True
    return root
