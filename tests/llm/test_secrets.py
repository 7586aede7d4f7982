import hashlib
import math
import random
import re
import string
from collections import Counter

import numpy as np

from driftmend.llm.secrets import ENCODINGS, KEYBOARD, KINDS, VOWELS, redacted, scan, with_ordinariness

ASSIGN = re.compile(r"((?i:password|passwd|secret|token|api_?key))[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)")
ACCESS = re.compile("AKIA[A-Z0-9]+")
HEX = re.compile("[0-9a-f]+")


def base(text):
    text = text or ""
    out = [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= 6]
    out += [(m.start(), 1, m.end()) for m in ACCESS.finditer(text) if len(m[0]) >= 20]
    out += [(m.start(), 2, m.end()) for m in HEX.finditer(text) if len(m[0]) >= 24]
    return sorted(out)


def joined(spans):
    return ",".join(f"{KINDS[k]}:{a}:{b}" for a, k, b in spans)


def check(row, text):
    own = base(text)
    assert [row.n_assign, row.n_access, row.n_hex] == [sum(k == i for _, k, _ in own) for i in range(3)], text
    assert row.base_sha256 == hashlib.sha256(joined(own).encode()).hexdigest(), text
    named = [s.split(":") for s in row.spans.split(",")] if row.spans else []
    assert ",".join(":".join(s) for s in named if s[0] != "random") == joined(own)


EDGES = [
    None, "", "secret=token\": abcdef", "PassWord = 'abc.def=' passwd:12345 passwd:123456", "api_key='x1y2z3' APIKEY:abcdef apikey = abcdef",
    "\N{GRINNING FACE}é token = abcdefgh \N{GRINNING FACE} token=abcdefgh", "AKIA" + "A" * 16 + " AKIA" + "B" * 15 + " xAKIAAKIA" + "9" * 16,
    "f" * 24 + " " + "e" * 23 + " " + "0" * 70, "password==abcdef", "secret:token=abcdef:token='xyzxyz'", "toKen\"= 'aaaaaa", "token  :\n abcdef",
    "token=abcdef\ntoken=abcdef", "=" * 50, "AKIA" * 20,
]


def test_patterns_agree_with_another_engine(spark, documents):
    draw = random.Random(5)
    parts = ["token", "SECRET", "api_key", "=", ":", " ", "'", "\"", "abc123", "AKIA", "ABCDEFGH1234567890", "0123456789abcdef", "é", "x", "\n", "passwd"]
    texts = EDGES + ["".join(draw.choice(parts) for _ in range(draw.randrange(1, 60))) for _ in range(300)]
    found = {r.doc_id: r for r in scan(documents(list(enumerate(texts)))).collect()}
    assert len(found) == len(texts)
    for i, text in enumerate(texts):
        check(found[i], text)


def ordinary(draw):
    words = ["internationalization", "counterrevolutionaries", "the_quick_brown_fox_jumps", "abcdefghijklmnopqrstuvwxyz", "01234567890123456789", "aaaaaaaaaaaaaaaaaaaaaaaa"]
    return draw.choice(words) + draw.choice(["", "s", "-based", "/path/to/some/file"])


# Alphabets of planted strings, and the least share of them to be found by length where a tenth of all candidates is planted.
PLANTED = {
    "upper hex": "0123456789ABCDEF",
    "base32": string.ascii_uppercase + "234567",
    "small letters and digits": string.ascii_lowercase + string.digits,
    "capitals and digits": string.ascii_uppercase + string.digits,
    "base62": string.ascii_letters + string.digits,
    "base64": string.ascii_letters + string.digits + "+/",
    "small letters": string.ascii_lowercase,
    "capitals": string.ascii_uppercase,
}
LEAST = {20: 0.0, 24: 0.0, 32: 0.5, 40: 0.85, 64: 0.95}


def test_recall_by_kind_and_length(spark, documents):
    """Each kind by itself among nine times as many ordinary strings; prints the table that the README has."""
    draw = random.Random(6)
    for name, letters in PLANTED.items():
        told = []
        for length, least in LEAST.items():
            planted = ["".join(draw.choice(letters) for _ in range(length)) for _ in range(60)]
            rows = [(i, f"x {p} y") for i, p in enumerate(planted)] + [(100 + i, " ".join(ordinary(draw) for _ in range(3))) for i in range(180)]
            found = {r.doc_id: r.spans for r in scan(documents(rows, False)).collect()}
            assert not [found[i] for i, _ in rows if i >= 100 and "random" in found[i]]
            hits = sum(found[i] == f"random:2:{2 + length}" for i in range(60)) / 60
            told.append(f"{length}: {hits:.2f}")
            assert hits >= (least if name not in ("small letters", "capitals", "upper hex", "base32") or length >= 40 else 0.0), (name, length, hits)
        print(name, *told)


def phi(z):
    z = max(-8.0, min(8.0, z))
    return math.erfc(-z / math.sqrt(2)) / 2


def ordinariness(value):
    """The three tests as the module describes them."""
    for pattern, letters, equal, rate in ENCODINGS:
        if re.search(pattern, value):
            break
    n, size = len(value), len(letters)
    chi = size / n * sum(c * c for c in Counter(value).values()) - n
    excess = size * equal - 1
    even = phi((chi - (size - 1) - n * excess) / math.sqrt(2 * (size - 1) + 4 * n * excess))
    one_case = value.isalpha() and (value.islower() or value.isupper())
    kind = (lambda c: c in VOWELS) if one_case else (lambda c: c.isupper() + 2 * c.isdigit())
    classes = [kind(c) for c in value if c.isalnum()]
    places = max(1, len(classes) - 1)
    changes = sum(a != b for a, b in zip(classes, classes[1:], strict=False))
    p = even
    if rate is not None:
        z = 2 * math.sqrt(places) * (math.asin(math.sqrt(changes / places)) - math.asin(math.sqrt(rate)))
        product = max(even * phi(z if one_case else -z), 1e-300)
        p = min(1.0, product * (1 - math.log(product)))
    r = -0.999
    for order in (letters, KEYBOARD):
        codes = np.array([order.find(c if order == letters else c.lower()) for c in value], float)
        around = codes - codes.mean()
        square = (around**2).sum()
        r = max(r, min(0.999, (around[:-1] * around[1:]).sum() / square) if square > 0 else 0.999)
    return max(p, phi((math.atanh(r) - math.atanh(0.8)) * math.sqrt(n - 3)), 1e-12)


def test_the_tests_agree_with_brute_force(spark):
    draw = random.Random(7)
    values = ["".join(draw.choice(letters) for _ in range(draw.randrange(20, 90))) for letters in PLANTED.values() for _ in range(12)]
    values += [ordinary(draw).replace(".", "") for _ in range(40)] + ["+" * 20, "a" * 30, "0" * 25, "_-" * 12, "getElementByIdAndClassName", "20240115103000123456"]
    values = [v for v in values if len(v) >= 20]
    rows = spark.createDataFrame([(v,) for v in values], "value string")
    for r in with_ordinariness(rows).collect():
        assert math.isclose(math.log(r.p), math.log(ordinariness(r.value)), abs_tol=0.3), (r.value, r.p, ordinariness(r.value))


def test_ordinary_strings_of_many_sorts_stay(spark, documents):
    names = ["getElementByIdAndClassName", "the_quick_brown_fox_jumps_over", "Donaudampfschifffahrtsgesellschaft", "counterrevolutionaries", "usr/local/share/doc/packages/readme",
             "2024-01-15-backup-of-the-database", "IMG_20240115_103000_portrait", "THE-TERMS-AND-CONDITIONS-OF-USE", "MAXIMUM_NUMBER_OF_CONNECTIONS", "qwertyuiopasdfghjklzxcvbnm",
             "aHundredTimesSaidItsNotTrue", "anticonstitutionnellement", "electroencefalografistas", "abcdefghijklmnopqrstuvwxyz0123456789"]
    rows = [(i, f"see {name} there") for i, name in enumerate(names)]
    assert {r.spans for r in scan(documents(rows)).collect()} == {""}


def test_masks(spark, documents):
    rows = [(1, "a token = abcdefgh b " + "f" * 30 + " c"), (2, "clean"), (3, None), (4, ""), (None, "é api_key=" + "0" * 40), (2, "clean"), (6, "password: " + "a1" * 20)]
    found = redacted(documents(rows))
    assert found.columns == documents(rows).columns
    assert sorted((str(r.doc_id), str(r.text)) for r in found.collect()) == sorted(
        [("1", "a [SECRET] b [SECRET] c"), ("2", "clean"), ("2", "clean"), ("3", "None"), ("4", ""), ("None", "é [SECRET]"), ("6", "[SECRET]")]
    )


def test_repeated_rows_and_many_matches(spark, documents):
    long = "token=abcdef " * 3000
    found = scan(documents([(1, long), (1, long), (None, "x")])).collect()
    assert sorted((str(r.doc_id), r.n_assign) for r in found) == [("1", 3000), ("1", 3000), ("None", 0)]
    check(next(r for r in found if r.doc_id == 1), long)


def test_empty_table_and_no_python(spark, documents):
    result = scan(documents([]))
    assert result.collect() == []
    plan = result._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Pandas|Arrow", plan)
