"""Small documents with every kind of trouble, shared by the tests."""

import random

COLUMNS = (
    "doc_id long, text string, lang string, source string, n_chars long, size long, row long, id long,"
    " digest string, leaks string, taken long, starts long, `class` string, first boolean, `key id` string,"
    " window string, score double, node long"
)


def words(rng, count):
    return " ".join(rng.choice(SYLLABLES) + rng.choice(SYLLABLES) for _ in range(count))


SYLLABLES = ["an", "be", "ción", "de", "ß", "for", "ing", "lá", "mo", "nt", "or", "re", "st", "th", "ue"]


def texts(seed=7):
    """(id, text): near copies, copies, empty and null texts, long ones, repeated lines and rows."""
    rng = random.Random(seed)
    base = words(rng, 120)
    lines = [words(rng, 8) for _ in range(6)]
    out = [(10, base), (11, base), (12, base.replace("an", "AN", 3)), (None, base)]
    for k in range(5):
        changed = base.split()
        changed[3 + 17 * k] = "changed"
        out.append((20 + k, " ".join(changed)))
    out += [(30, ""), (31, None), (32, "   \n\t "), (33, "one two"), (34, "One TWO"), (33, "one two")]
    out += [(None, None), (None, "")]
    out += [(40, "\n".join(lines)), (41, "start\n" + "\n".join(lines[1:5]) + "\nend"), (42, "\n".join(lines[:2]))]
    out += [(43, "\n".join(["same"] * 7)), (44, "\n\n\n\n"), (40, "\n".join(lines))]
    out += [(50, words(rng, 9000)), (51, "a" * 5000), (52, "a" * 5000 + "b"), (53, words(rng, 300))]
    out += [(60 + k, words(rng, rng.randrange(1, 200))) for k in range(25)]
    out += [(90, words(rng, 40) + " " + base + " " + words(rng, 40)), (91, "x y   z\U0001f600" * 40)]
    return out


def frame(spark, rows=None):
    """The texts as a table with more columns, whose names the operators use themselves."""
    rows = texts() if rows is None else rows
    sources = ["b", None, "a", "ä", "b"]
    full = [
        (i, t, None, sources[k % 5], len(t) if t else None, 1, k, 5, "d", "l", 2, 3, "c", None, "k", "w", 0.5, 9)
        for k, (i, t) in enumerate(rows)
    ]
    return spark.createDataFrame(full, COLUMNS)
