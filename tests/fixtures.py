"""Small hand-made tables and a brute-force reading of what the operators should say of them."""

from __future__ import annotations

from collections import defaultdict

# Keys that a textual comparison would confuse, NULL parts, repeated keys, and a row that is NULL beyond its key.
TARGET = [
    ("a|b", "c", 1, "x"),
    ("a::b", "c", 2, "y"),
    (None, "1", 3, None),
    ("k", None, 4, "n"),
    ("same", "s", 5, "s"),
    ("blank", "b", None, None),
    ("changed", "c", 7, "old"),
    ("nulled", "n", 8, "v"),
    ("twice", "t", 9, "p"),
    ("twice", "t", 9, "q"),
    ("lone", "l", 10, None),
]
GIVEN = [
    ("a", "b|c", 1, "x"),
    ("a", "b::c", 2, "y"),
    ("1", None, 3, None),
    ("k", None, 4, "n"),
    ("same", "s", 5, "s"),
    ("changed", "c", 7, "new"),
    ("nulled", "n", None, "v"),
    ("twice", "t", 9, "p"),
    ("extra", "e", 11, "z"),
    ("extra", "e", 11, "z"),
]
SCHEMA = "k1 string, k2 string, n int, s string"
KEYS = ["k1", "k2"]


def by_key(rows):
    grouped = defaultdict(list)
    for row in rows:
        grouped[row[:2]].append(row)
    return grouped


def statuses(target, given):
    ours, theirs = by_key(target), by_key(given)
    found = {}
    for key in {*ours, *theirs}:
        a, b = ours.get(key, []), theirs.get(key, [])
        if len(a) > 1 or len(b) > 1:
            found[key] = ("duplicate_key", ())
        elif not b:
            found[key] = ("missing_in_given", ())
        elif not a:
            found[key] = ("only_in_given", ())
        else:
            changed = tuple(name for name, x, y in zip(("n", "s"), a[0][2:], b[0][2:], strict=True) if x != y)
            found[key] = ("changed" if changed else "same", changed)
    return found


def bag(rows):
    counted = defaultdict(int)
    for row in rows:
        counted[tuple(row)] += 1
    return dict(counted)
