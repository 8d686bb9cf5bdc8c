"""The numpy parts of the operators against plain definitions."""

import hashlib
import math
import random
import time
from collections import Counter

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from ledgerlake.llm import bytededup, decontam, fingerprints, htmltext, licenses, linedup, ngramjoin, quality
from ledgerlake.llm.suffixes import common_prefixes, repeated, suffix_array


@settings(max_examples=300, deadline=None)
@given(st.binary(max_size=60) | st.lists(st.sampled_from(b"ab"), max_size=60).map(bytes))
def test_suffix_array_and_common_prefixes(raw):
    text = np.frombuffer(raw, np.uint8)
    order = suffix_array(text)
    assert order.tolist() == sorted(range(len(raw)), key=lambda i: raw[i:])
    shared = common_prefixes(text, order)
    for before, at in zip(order, order[1:]):
        k = 0
        while max(before, at) + k < len(raw) and raw[before + k] == raw[at + k]:
            k += 1
        assert shared[at] == k


@settings(max_examples=100, deadline=None)
@given(st.lists(st.sampled_from(b"abc"), min_size=1, max_size=80).map(bytes), st.integers(1, 5))
def test_repeated_places(raw, length):
    windows = [raw[i : i + length] for i in range(len(raw))]
    counts = Counter(w for w in windows if len(w) == length)
    expected = [counts[w] > 1 and len(w) == length for w in windows]
    assert repeated(np.frombuffer(raw, np.uint8), length).tolist() == expected


def test_equal_windows_have_equal_anchors():
    rng = random.Random(3)
    shared = bytes(rng.randrange(97, 101) for _ in range(60))
    found = []
    for k in range(4):
        raw = bytes(rng.randrange(97, 101) for _ in range(40 + k)) + shared + b"z" * 30
        lo, hi, a = bytededup.anchored_runs(raw, 30, 12)
        assert lo[0] == 0 and hi[-1] == len(raw) - 30 and (lo[1:] == hi[:-1] + 1).all()
        by_window = {raw[s : s + 30]: x for i, j, x in zip(lo, hi, a) for s in range(i, j + 1)}
        found.append({w: x for w, x in by_window.items() if w in shared})
    assert found[0] and all(f == found[0] for f in found)


def test_anchors_do_not_depend_on_pieces(monkeypatch):
    raw = bytes(random.Random(5).randrange(97, 123) for _ in range(3000))
    whole = bytededup.anchored_runs(raw, 50, 20)
    monkeypatch.setattr(bytededup, "_PIECE_BITS", 8)
    lo, hi, a = bytededup.anchored_runs(raw, 50, 20)

    def by_window(runs):
        return [x for i, j, x in zip(*runs) for _ in range(i, j + 1)]

    assert by_window((lo, hi, a)) == by_window(whole)


def test_entropies():
    raw = random.Random(1).randbytes(70) + b"aaaa" * 20 + b"abcd" * 30
    found = fingerprints.entropies(np.frombuffer(raw, np.uint8))
    for at, level in enumerate(found):
        counts = Counter(raw[at : at + 64]).values()
        entropy = -sum(c / 64 * math.log2(c / 64) for c in counts) / 6 * 1000
        assert abs(level - entropy) <= 1.001


def test_levels_of_many_texts_are_those_of_each():
    rng = random.Random(2)
    raws = [rng.randbytes(n) for n in (0, 5, 63, 64, 65, 300, 0, 128)]
    for raw, levels in zip(raws, fingerprints.levels_of(raws)):
        assert levels.tolist() == fingerprints.entropies(np.frombuffer(raw, np.uint8)).tolist()


def _text(rng, count):
    return " ".join(rng.choice(["alpha", "beta", "gamma", "delta"]) + str(rng.randrange(999)) for _ in range(count))


def test_redone_fingerprints_are_those_of_the_whole_text():
    rng, ranks = random.Random(4), np.arange(1001)
    raws = [_text(rng, n).encode() for n in (1, 20, 60, 61, 80, 200, 700)]
    places = [p for _, p in fingerprints.digests(raws, ranks)]
    same = [len(r) * 3 // 4 for r in raws]
    changed = [r[:n] + _text(rng, 30).encode() for r, n in zip(raws, same)]
    assert fingerprints.redone(changed, same, places, ranks) == [fingerprints.digest(c, ranks) for c in changed]


def test_likeness():
    rng, ranks = random.Random(6), np.arange(1001)
    one, two = _text(rng, 900), _text(rng, 900)
    mixed = one[: len(one) * 3 // 4] + two[: len(two) // 4]
    a, b, c = (fingerprints.digest(x.encode(), ranks) for x in (one, two, mixed))
    assert fingerprints.likeness(a, a) == 1.0 and fingerprints.likeness(b"", b"") == 1.0
    assert fingerprints.likeness(a, b"") == 0.0
    assert fingerprints.likeness(a, c) == fingerprints.likeness(c, a) > 0.4
    assert fingerprints.likeness(a, b) < 0.1
    short = fingerprints.digest(b"a few short words here", ranks)
    other = fingerprints.digest(b"a few short words there", ranks)
    assert fingerprints.likeness(short, other) > 0.5
    assert 0 <= fingerprints.likeness(a, short) <= 1


def _shingles(text, k):
    w = [x.lower() for x in text.split()]
    return {tuple(w[i : i + k]) for i in range(len(w) - k + 1)} or ({tuple(w)} if w else set())


@pytest.mark.parametrize("words, percent", [(3, 90), (5, 80), (1, 50)])
def test_similar_sets_share_a_lane(words, percent):
    rng = random.Random(words)
    met = 0
    for _ in range(400):
        base = [str(rng.randrange(10**6)) for _ in range(rng.randrange(1, 300))]
        other = list(base)
        for _ in range(rng.randrange(0, 1 + len(base) // 25)):
            other[rng.randrange(len(other))] = str(rng.randrange(10**6))
        if rng.random() < 0.3:
            other = other[: max(1, len(other) - rng.randrange(1, 9))]
        a, b = (ngramjoin.shingles(" ".join(x), words) for x in (base, other))
        shared = len(np.intersect1d(a, b))
        if shared * 100 < percent * (len(a) + len(b) - shared) or (len(a) == len(b) == shared):
            continue
        met += 1
        lanes = [set(ngramjoin.lane_keys(x, percent).tolist()) for x in (a, b)]
        assert lanes[0] & lanes[1]
        bits = ngramjoin.folded(a) ^ ngramjoin.folded(b)
        assert sum(int(x & 0xFFFFFFFFFFFFFFFF).bit_count() for x in bits.tolist()) <= len(a) + len(b) - 2 * shared
    assert met > 50


@pytest.mark.parametrize("words, percent", [(3, 90), (5, 80), (1, 50)])
def test_similar_sets_share_a_lane_they_keep(words, percent):
    rng = random.Random(100 + words)
    spread, met = 0.3 * (100 - percent) / words / 100, 0
    for _ in range(300):
        base = [str(rng.randrange(10**6)) for _ in range(rng.randrange(20, 400))]
        edits = rng.randrange(0, 2 + int(3 * spread * len(base)))
        other = list(base)
        for _ in range(edits):
            other[rng.randrange(len(other))] = str(rng.randrange(10**6))
        a, b = (ngramjoin.shingles(" ".join(x), words) for x in (base, other))
        shared = len(np.intersect1d(a, b))
        if shared * 100 < percent * (len(a) + len(b) - shared) or (len(a) == len(b) == shared):
            continue
        met += 1
        # Whatever lanes are the most shared ones, here first all in which the two agree.
        agreed = set(ngramjoin.lane_keys(a, percent).tolist()) & set(ngramjoin.lane_keys(b, percent).tolist())
        kept = []
        for values in (a, b):
            keys, spares = ngramjoin.lanes_of(values, percent)
            bands, left = keys & np.uint64((1 << ngramjoin.BAND_BITS) - 1), set()
            for band, spare in enumerate(spares, ngramjoin.band_of(len(values))):
                own = keys[bands == band].tolist()
                left |= set(sorted(own, key=lambda k: (k not in agreed, k))[spare:])
            assert len(left) <= len(keys)
            kept.append(left)
        assert kept[0] & kept[1]
    assert met > 50


def test_shingles():
    assert len(ngramjoin.shingles(None, 3)) == len(ngramjoin.shingles(" \n", 3)) == 0
    assert len(ngramjoin.shingles("a b", 3)) == 1
    assert ngramjoin.shingles("A b", 3).tolist() == ngramjoin.shingles("a  B", 3).tolist()
    assert ngramjoin.shingles("a b", 3).tolist() != ngramjoin.shingles("b a", 3).tolist()
    assert ngramjoin.shingles("É x", 3).tolist() != ngramjoin.shingles("é x", 3).tolist()
    text = " ".join(random.Random(1).choices("abc", k=60))
    assert len(ngramjoin.shingles(text, 3)) == len(_shingles(text, 3))


def _edit_distance_inside(item, text):
    """The least edits of `item` against any part of `text`."""
    row = [0] * (len(text) + 1)
    for i, x in enumerate(item, 1):
        new = [i]
        for j, y in enumerate(text, 1):
            new.append(min(row[j - 1] + (x != y), row[j] + 1, new[j - 1] + 1))
        row = new
    return min(row)


def test_leaks_against_brute_force():
    rng = random.Random(8)
    letters = "abcdefgh "
    items = [(k, decontam.normal("".join(rng.choices(letters, k=rng.randrange(30, 90))))) for k in range(6)]
    items += [(90, "abc"), (91, items[0][1])]
    scanner = decontam.Items(items, 4, 8)
    hits = 0
    for trial in range(60):
        text = list("".join(rng.choices(letters, k=rng.randrange(0, 150))))
        planted = list(rng.choice(items)[1])
        for _ in range(rng.randrange(0, 8)):
            at, kind = rng.randrange(len(planted)), rng.randrange(3)
            planted[at : at + 1] = [[], [rng.choice(letters)], [planted[at], rng.choice(letters)]][kind]
        at = rng.randrange(len(text) + 1)
        full = "".join(text[:at] + planted + text[at:])
        plain = decontam.normal(full)
        expected = {}
        for k, (item_id, item) in enumerate(items):
            least = _edit_distance_inside(item, plain)
            if least <= scanner.edits[k]:
                expected[item_id] = least
        found = scanner.leaks(full)
        assert {i: e for i, e, _, _ in found} == expected
        for item_id, edits, start, end in found:
            item = dict(items)[item_id]
            assert _edit_distance_inside(item, plain[start:end]) == edits
        hits += len(expected)
    assert hits > 20
    assert scanner.leaks(None) == scanner.leaks("") == []


def test_every_place_and_long_parts():
    rng = random.Random(12)

    def text(count):
        return " ".join("".join(rng.choices("abcdefghij", k=rng.randrange(3, 8))) for _ in range(count))

    item, short, tail = text(36), "abc", text(30)
    scanner = decontam.Items([(1, item), (2, short)], 8, 5, 50)
    edited = item[:40] + "##" + item[42:]
    head = text(20)
    full = f"{head} {item} {tail} {edited} {tail} {item}"
    found = [x for x in scanner.places(full) if x[0] == 1]
    starts = [len(head) + 1 + k * (len(item) + len(tail) + 2) for k in range(3)]
    assert sorted(x[1:4] for x in found) == sorted((e, s, s + len(item)) for e, s in zip((0, 2, 0), starts))
    assert all(x[4:] == (0, len(item)) for x in found)
    places = [k for k in range(len(full)) if full.startswith(short, k)]
    assert [x[2] for x in scanner.places(full) if x[0] == 2] == places
    # Cut off at either end: the part is found, to the letter or one more by chance.
    for cut in (item[: len(item) * 9 // 10], item[len(item) // 2 :]):
        (part,) = (x for x in scanner.places(f"{head} {cut}") if x[0] == 1)
        first = item.index(cut)
        assert part[1] == 0 and abs(part[4] - first) <= 1 and part[5] == first + len(cut)
    assert not [x for x in scanner.places(f"{head} {item[:40]}## {tail}") if x[0] == 1]
    # Three words of it replaced, and a part with edits between its stretches.
    words = item.split()
    for k in (9, 18, 27):
        words[k] = "#" * 9
    hit = [x for x in scanner.places(f"{head} {' '.join(words)} {tail}") if x[0] == 1]
    assert hit and all(x[5] - x[4] >= 50 and x[1] * 100 <= 5 * (x[5] - x[4]) for x in hit)
    broken = item[:45] + "###" + item[46:100]
    (part,) = (x for x in scanner.places(f"{head} {broken} {tail}") if x[0] == 1)
    assert part[1] == 3 and part[4] == 0 and abs(part[5] - 100) <= 1
    for _, edits, start, end, first, last in hit + [part]:
        assert last - first >= 50 and edits * 20 <= last - first
    assert scanner.places(None) == [] and not scanner.places(tail.replace("abc", "x"))


def test_budget_keeps_the_lemma_useful():
    for length in range(1, 200):
        edits = decontam.budget(length, 8, 5)
        assert edits == 0 or length + 1 - 8 - 8 * edits >= 1


def test_covered_lines():
    assert linedup.covered([1, 2, 7], 12).tolist() == [False, *[True] * 4, False, False, *[True] * 3, False, False]


def _plain_phrases(text):
    words, word = [], ""
    for c in (text or "") + " ":
        c = c.lower() if "A" <= c <= "Z" else c
        if c > "\x7f" or c.isascii() and c.isalnum():
            word += c
        elif word:
            words.append(word)
            word = ""
    starts, labels = [], set()
    for phrase, label in licenses.PHRASES:
        part = phrase.split()
        for i in range(len(words) - len(part) + 1):
            if words[i : i + len(part)] == part:
                starts.append(i)
                labels.add(label)
    return len(words), len(starts), min(starts, default=None), max(starts, default=None), ",".join(sorted(labels))


def _scanner():
    return licenses.Scanner(licenses.PHRASES, [licenses.notice(*n) for n in licenses.NOTICES])


@settings(max_examples=200, deadline=None)
@given(st.lists(st.sampled_from(
    ["gnu", "General", "public", "LICENSE", "apache", "cc", "by", "mit", "ü", "x", ".", "-", "\n", "K", "9"]
)).flatmap(lambda w: st.sampled_from([" ", "-", ", ", "\x0b"]).map(lambda s: s.join(w))))
def test_base_phrases(text):
    found = _scanner().scan(text)
    assert tuple(found[c] for c in ("n_words", "n_base", "first_word", "last_word", "base_labels")) == _plain_phrases(text)
    assert set(filter(None, found["base_labels"].split(","))) <= set(found["labels"].split(","))
    assert 0 <= found["score"] <= 1


def test_fuzzy_notices_against_every_region():
    import regex

    rng, scanner = random.Random(9), _scanner()
    met = 0
    for _ in range(150):
        text = list(rng.choice(licenses.NOTICES)[0])
        for _ in range(rng.randrange(0, 7)):
            text[rng.randrange(len(text))] = rng.choice("abcdefgh ")
        full = "some words before " + "".join(text) + " and after"
        words = " ".join(full.split()).encode()
        fits = {
            n.label for n, p in zip(scanner.notices, scanner.patterns) if p.search(words)
        }
        labels = {s["label"] for s in scanner.scan(full)["spans"]}
        assert labels <= fits and bool(labels) == bool(fits)
        met += bool(fits)
    assert met > 40
    empty = scanner.scan(None)
    assert (empty["n_words"], empty["first_word"], empty["labels"], empty["score"]) == (0, None, "", 0.0)
    assert regex


def test_every_one_of_adjacent_notices():
    scanner, plain, edited = _scanner(), "released under the mit license", "released under the mit licence"
    for parts in ([edited, plain], [plain, edited], [edited, edited, plain, edited], [plain] * 3, [edited, plain, edited]):
        found = scanner.scan(" ".join(parts))["spans"]
        places = [(31 * k, 31 * k + 30) for k in range(len(parts))]
        assert [(s["start"], s["end"], s["edits"]) for s in found] == [(*p, int(t == edited)) for p, t in zip(places, parts)]


def _flow_cost(weights, links, side):
    cost = sum(w for w, s in zip(weights, side) if w > 0 and not s)
    cost += sum(-w for w, s in zip(weights, side) if w < 0 and s)
    return cost + sum(c for a, b, c in links if side[a] != side[b])


def test_minimum_cut():
    rng = random.Random(10)
    for _ in range(200):
        size = rng.randrange(1, 9)
        weights = [rng.randrange(-9, 10) for _ in range(size)]
        links = [(a, a + 1, rng.randrange(1, 7)) for a in range(size - 1)]
        links += [tuple(sorted(rng.sample(range(size), 2))) + (rng.randrange(1, 5),) for _ in range(size // 2)]
        side = htmltext.min_cut(weights, links)
        sides = ([bool(m >> k & 1) for k in range(size)] for m in range(1 << size))
        assert _flow_cost(weights, links, side) == min(_flow_cost(weights, links, s) for s in sides)


PAGE = """<!DOCTYPE html><html><head><title>T</title><style>p{}</style><script>var a="<p>no</p>";</script></head>
<body class="content"><header><h1>Site</h1></header><nav><ul><li><a href="/">Home</a><li><a href="/b">B</a></ul></nav>
<div class="cookie-notice">We use cookies.</div><div class="ad">Buy &amp; save.</div>
<article><h1>A&nbsp;title</h1><p>First <b>bold</b>paragraph,
  with&#32;a&lt;b &eacute;.<p>Second one<br>with a break. <ul><li>an item<li>another</ul>
<form><input value="x">Your name</form><aside>See also</aside><script>track()</script></article>
<section id="comments"><article><p>A reader's long comment that says quite a lot, to look like text.</p></article></section>
<div class="sidebar"><p>Most read</p></div><footer>&copy; 2026</footer></body></html>"""


def test_main_text():
    text = htmltext.main_text(PAGE)
    assert text == (
        "A title First boldparagraph, with a<b é. Second one with a break. an item another"
    )
    assert htmltext.main_text(None) == htmltext.main_text("") == htmltext.main_text("<nav>x</nav>") == ""


def test_main_text_without_marks():
    body = "<div><p>A long paragraph of plain words, one after the other, that reads like an article.</p>" * 3
    menu = "<ul>" + "<li><a href='#'>Link</a></li>" * 5 + "</ul>"
    text = htmltext.main_text(f"<body>{menu}{body}<p>Short end.</p></div>{menu}")
    assert text.startswith("A long") and "Link" not in text


def test_marks_are_evidence_among_the_rest():
    long = "A long paragraph of plain words, one after the other, that reads like an article and goes on for a while."
    for opening in ('<article class="post comments-open">', '<div class="content no-sidebar">', '<div class="page nav-fixed">'):
        tag = opening[1:].split()[0]
        assert htmltext.main_text(f"{opening}<p>{long}</p><p>{long}</p></{tag}>") == f"{long} {long}"
    # The cut keeps a marked block between content, and drops links that an article holds.
    notice = '<p class="notice">This paragraph tells the reader what the next one is about, in enough words.</p>'
    alone = htmltext.main_text(f"<body>{notice}</body>")
    within = htmltext.main_text(f"<article><p>{long}</p>{notice}<p>{long}</p></article>")
    assert alone == "" and "what the next one" in within
    links = "<p>" + "<a href='#'>More of the same</a> " * 4 + "</p>"
    assert htmltext.main_text(f"<article><p>{long}</p>{links}</article>") == long
    assert htmltext.main_text(f'<p>{long}</p><div class="comments"><article><p>{long}</p></article></div>') == long


def test_broken_and_deep_pages():
    assert htmltext.main_text("<article><p>a<b>b<p>c</div></span>d") == "ab cd"
    deep = "<div>" * 3000 + "<article><p>deep text here.</p></article>" + "</div>" * 10
    assert htmltext.main_text(deep) == "deep text here."
    assert htmltext.main_text("<article>" + "<p>x.</p>" * 4000) == " ".join(["x."] * 4000)


def test_additive_model_learns_a_pair():
    rng = np.random.default_rng(3)
    x = rng.random((3000, 5)).astype(np.float32)
    y = ((x[:, 0] > 0.5) ^ (x[:, 1] > 0.5) | (x[:, 2] > 0.95)).astype(float)
    model = quality.fit(x[:2000], y[:2000])
    right = ((model.score(x[2000:]) > 0.5) == y[2000:]).mean()
    assert right > 0.9
    assert {(a, b) for a, b, _ in model.pairs[:1]} == {(1, 0)}


def test_models_of_no_rows_and_one_kind():
    none = quality.fit(np.zeros((0, 16), np.float32), np.array([]))
    assert none.score(np.zeros((2, 16), np.float32)).tolist() == [0.5, 0.5]
    ones = quality.fit(np.random.default_rng(1).random((50, 16)).astype(np.float32), np.ones(50))
    assert (ones.score(np.zeros((1, 16), np.float32)) > 0.9).all()
    assert (quality.describe(None) == 0).all() and (quality.describe("") == 0).all()
    assert len(quality.describe("a\n" * 10)) == len(quality.FEATURES)


def test_hash_of_digest_is_stable():
    assert hashlib.sha256(fingerprints.digest(b"equal text", np.arange(1001))).digest() == hashlib.sha256(
        fingerprints.digest(b"equal text", np.arange(1001))
    ).digest()


@pytest.mark.parametrize("size", [40, 550, 8000, 60000])
def test_band_sketches_tell_sets_of_any_size_apart(size):
    rng = np.random.default_rng(size)
    one, two = (rng.integers(0, 2**63, size, np.uint64) for _ in range(2))
    near = np.concatenate([one[: size - size // 20], two[: size // 20]])
    sketch = [ngramjoin.band_sketches(np.unique(x), 80)[0] for x in (one, two, near)]
    words = [np.frombuffer(s, np.uint64) for s in sketch]
    allowed = 2 * size * 20 / 180
    assert int(np.bitwise_count(words[0] ^ words[1]).sum()) > allowed
    assert int(np.bitwise_count(words[0] ^ words[2]).sum()) <= allowed
    # The sketch is a small part of the set.
    assert len(sketch[0]) <= 8 * size / 20 + 8


LONG = "This sentence is a part of the main text, and it goes on for a while, as articles do. " * 3


@pytest.mark.parametrize("name", [
    "comment-list", "post-comments", "cookie-banner", "site-footer", "ad-container", "commentList", "comments_area",
    "user-comments", "page-sidebar", "share-buttons", "related-posts-widget", "google-ad", "header-menu",
])
def test_compound_names_of_other_parts(name):
    inner = f"<p>{LONG}</p>" if "comment" in name.lower() else "<p>We use some of your data to improve this.</p>"
    page = f'<article><p>{LONG}</p><p>{LONG}</p><div class="{name}">{inner}</div></article>'
    assert htmltext.main_text(page) == f"{LONG.strip()} {LONG.strip()}"


@pytest.mark.parametrize("opening, tag", [
    ('<article class="post comments-open">', "article"), ('<div class="content no-sidebar">', "div"),
    ('<div class="page nav-fixed">', "div"), ('<div class="layout-with-sidebar">', "div"),
    ('<div class="hasSidebar">', "div"), ('<div class="sidebar-layout">', "div"), ('<section class="social-studies">', "section"),
])
def test_names_that_an_article_overturns(opening, tag):
    page = f"<nav><a>Home</a></nav>{opening}<p>{LONG}</p><p>{LONG}</p></{tag}><footer>End</footer>"
    assert htmltext.main_text(page) == f"{LONG.strip()} {LONG.strip()}"


def test_formulas_stay_in_their_sentence():
    formula = "<math><mi>x</mi><mo>=</mo><msup><mi>y</mi><mn>2</mn></msup><annotation>x=y^2</annotation></math>"
    assert htmltext.main_text(f"<article><p>{LONG}so {formula} holds.</p></article>") == f"{LONG}so x=y2 holds."


def test_deeply_nested_inline_elements_keep_their_place():
    deep = "<span>" * 60 + LONG + "</span>" * 60
    page = f'<div class="comment-list"><p>{deep}</p></div><article><p>{deep}</p></article>'
    assert htmltext.main_text(page) == LONG.strip()


def test_many_notices_in_one_text():
    scanner = licenses.Scanner(licenses.PHRASES, [licenses.notice(*n) for n in licenses.NOTICES])
    edited = "released under the mit licence"
    text = f"{edited} released under the mit license " * 800 + "x " * 20000 + edited
    start = time.process_time()
    found = scanner.scan(text)
    assert time.process_time() - start < 20
    spans = [s for s in found["spans"] if s["label"] == "mit-notice"]
    assert len(spans) == 1601
    assert found["n_base"] == 800 and found["first_word"] == 8 and found["last_word"] == 8 + 10 * 799
    assert all(a["end"] <= b["start"] for a, b in zip(spans, spans[1:]))


def test_short_and_long_texts_are_compared_by_features():
    rng = random.Random(5)
    lines = [" ".join(f"w{rng.randrange(5000)}" for _ in range(9)) + "." for _ in range(60)]
    ranks = np.random.default_rng(5).permutation(fingerprints.LEVELS + 1)
    short, long = (" ".join(lines[:n]).encode() for n in (8, 60))
    assert 380 < len(short) < 512 and len(long) > 2000
    digests = [fingerprints.digest(x, ranks) for x in (short, long, " ".join(lines[40:48]).encode())]
    assert fingerprints.likeness(digests[0], digests[1]) == fingerprints.likeness(digests[1], digests[0]) > 0.4
    assert fingerprints.likeness(digests[0], digests[2]) < 0.2
    # One word changed in a short text leaves it alike.
    changed = short.replace(short.split()[40], b"other")
    assert fingerprints.likeness(digests[0], fingerprints.digest(changed, ranks)) > 0.6


def brute_place(item, region, limit):
    """(edits, start, end) by the full table, cell after cell."""
    row = [(0, -j) for j in range(len(region) + 1)]
    for i, code in enumerate(item, 1):
        new = [(row[0][0] + 1, row[0][1])]
        for j, other in enumerate(region, 1):
            diagonal = (row[j - 1][0] + (other != code), row[j - 1][1])
            new.append(min(diagonal, (row[j][0] + 1, row[j][1]), (new[-1][0] + 1, new[-1][1])))
        row = new
    edits = min(e for e, _ in row)
    end = next(j for j, (e, _) in enumerate(row) if e == edits)
    return (edits, end) if edits <= limit else None


@given(st.integers(0, 10**6))
@settings(max_examples=150, deadline=None)
def test_banded_alignment_finds_what_the_full_table_does(seed):
    rng = random.Random(seed)
    item = [rng.randrange(4) for _ in range(rng.randrange(1, 40))]
    limit, shift = rng.randrange(0, 5), rng.randrange(0, 12)
    near = list(item)
    for _ in range(rng.randrange(0, limit + 2)):
        at = rng.randrange(len(near) + 1)
        near[at : at + rng.randrange(2)] = [rng.randrange(4)] * rng.randrange(2)
    region = [rng.randrange(4, 8) for _ in range(shift)] + near + [rng.randrange(4, 8) for _ in range(rng.randrange(6))]
    codes = [np.array(x, np.uint64) for x in (item, region)]
    expected = brute_place(item, region, limit)
    whole = decontam.align(*codes, limit, -len(item), len(region))
    assert (whole and (whole[0], whole[2])) == expected
    banded = decontam.align(*codes, limit, shift - 2 * limit - 1, shift + 2 * limit + 1)
    if expected and abs(expected[1] - len(item) - shift) <= limit:
        assert banded[0] == expected[0]
    if banded:
        edits, start, end = banded
        assert edits == decontam.distance(codes[0], codes[1][start:end]) <= limit
