"""Rows that the tests of this folder share."""

from __future__ import annotations

import random
import re
from collections import defaultdict

WORD = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
#: Columns that clash with names the operators use inside.
EXTRA = ["key", "words", "n", "score", "ids", "label", "fp", "hits", "window", "token", "place"]
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, " + ", ".join(f"{c} string" for c in EXTRA)


def lower(text):
    return (text or "").translate(str.maketrans(UPPER, UPPER.lower()))


def prose(seed, n, vocabulary="the of and thing onan erhe tion bleen wh ser and or at haed nding".split()):
    r = random.Random(seed)
    return " ".join(r.choice(vocabulary) + r.choice(["", "", "s", "ed", str(r.randrange(90))]) for _ in range(n))


def near(text, seed, edits):
    words = text.split(" ")
    r = random.Random(seed)
    for _ in range(edits):
        words[r.randrange(len(words))] = f"edit{r.randrange(10 ** 6)}"
    return " ".join(words)


def edge_rows():
    """(doc_id, text, lang, source): nulls in each column, empty and very long texts, ties,
    repeated rows, ids that are null or repeated."""
    base = [prose(k, 120) for k in range(6)]
    rows = [(k, t, "en", "a") for k, t in enumerate(base)]
    rows += [(100 + k, near(base[0], k, 1 + k % 3), "en", "a") for k in range(25)]  # near copies
    rows += [(200 + k, base[1], "en", "b") for k in range(12)]  # exact copies
    rows += [(300, None, "en", "a"), (301, "", "en", "a"), (302, " \n\t ", None, "a"), (303, "...!?", "en", None),
             (304, "one", "en", "a"), (305, "one two three", "en", "a"), (306, "ONE two Three", "en", "a")]
    rows += [(None, base[2], "en", "a"), (None, None, None, None), (7, base[3], None, None), (7, base[4], "en", "a")]
    rows += [(308, "repeated row " * 30, "en", "a")] * 3
    rows += [(309, prose(99, 30_000), "en", "a"), (310, "x" * 60_000, "en", "a"), (311, "ü" * 3000 + " 日本語 👍🏽" * 50, "de", "a")]
    rows += [(312, "Straße über öffentliche Wörter der die das und nicht mit " * 8, "de", "b"),
             (313, "LINE\nLINE\nLINE\n" * 30, "en", "b")]
    return rows


def brute_hits(text, items, n=13):
    w, hit, found = WORD.findall(lower(text)), set(), set()
    for item_id, item in items:
        v = WORD.findall(lower(item))
        size = min(n, len(v))
        wins = {tuple(v[i:i + size]) for i in range(len(v) - size + 1)} if size else set()
        for i in range(len(w) - size + 1) if size else ():
            if tuple(w[i:i + size]) in wins:
                hit.update(range(i, i + size))
                if item_id is not None:
                    found.add(str(item_id))
    return len(w), hit, sorted(found)


def brute_links(rows, threshold=0.8):
    sets = []
    for _, text, _, _ in rows:
        w = WORD.findall(lower(text))
        sets.append(frozenset(tuple(w[i:i + 5]) for i in range(len(w) - 4)) if len(w) >= 5 else frozenset([tuple(w)] if w else []))
    links = [[j for j, b in enumerate(sets) if j != i and a and b and len(a & b) >= threshold * len(a | b) - 1e-9] for i, a in enumerate(sets)]
    label = list(range(len(sets)))
    for _ in sets:
        label = [min([label[i], *(label[j] for j in links[i])]) for i in range(len(sets))]
    ids = defaultdict(list)
    for i, r in enumerate(rows):
        if r[0] is not None:
            ids[label[i]].append(r[0])
    return sets, [(r[0], min(ids[label[i]], default=None), len(links[i])) for i, r in enumerate(rows)], label
