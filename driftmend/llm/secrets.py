"""Secrets in texts: fixed patterns, and a battery of randomness tests for strings that no pattern names.

All work is DataFrame expressions. Matches and what stands between them come from two calls with one pattern, and
their lengths add up to positions. A candidate string is put to three tests under the alphabet it seems to be written
in, each of which gives a p-value for an ordinary string (words, names, paths, dates) of that length:

* how even its characters are (chi squared);
* how often the class of character changes (runs): between capitals, small letters and digits it changes more often in a
  random string, and between vowels and consonants, where all are letters of one case, less often;
* how far each character follows from the one before (serial correlation), in the alphabet or on the keyboard.

The first two are independent evidence and combined by Fisher's method; the third can only speak against a string, since
a sequence is as even as can be. Where an alphabet has no classes to change between, the first stands alone. Within each
band of lengths the Benjamini-Hochberg procedure keeps the share of ordinary strings among those reported below ``rate``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from driftmend.sources.sinks import staged

KINDS = ("assign", "access", "hex", "random")
ASSIGN = "((?i:password|passwd|secret|token|api_?key))[\"']?\\x20*[:=]\\x20*[\"']?([A-Za-z0-9+/_.=-]+)"
ACCESS = "AKIA[A-Z0-9]{16,}"
HEX = "[0-9a-f]{24,}"
CANDIDATE = "[A-Za-z0-9+/_-]{20,}"

LOWER = "abcdefghijklmnopqrstuvwxyz"
UPPER = LOWER.upper()
DIGITS = "0123456789"
VOWELS = "aeiouAEIOU"
# Fixed values, by encoding: its pattern, its alphabet, the chance that two characters of an ordinary string of it are
# equal, and how often its class changes from one character to the next (of letters of one case: vowel or consonant).
ENCODINGS = (
    ("^[0-9]+$", DIGITS, 0.12, None),
    ("^[0-9a-f]+$", DIGITS + "abcdef", 0.1, 0.15),
    ("^[0-9A-F]+$", DIGITS + "ABCDEF", 0.1, 0.15),
    ("^[a-z]+$", LOWER, 0.066, 0.65),
    ("^[A-Z]+$", UPPER, 0.066, 0.65),
    ("^[A-Z2-7]+$", UPPER + "234567", 0.065, 0.06),
    ("^[a-z0-9]+$", LOWER + DIGITS, 0.065, 0.12),
    ("^[A-Z0-9]+$", UPPER + DIGITS, 0.065, 0.12),
    ("^[A-Za-z0-9]+$", UPPER + LOWER + DIGITS, 0.06, 0.3),
    ("", UPPER + LOWER + DIGITS + "+/-_", 0.055, 0.3),
)
LETTERS = "^([a-z]+|[A-Z]+)$"
BANDS = (24, 32, 48, 96)
# The order of keys of a keyboard.
KEYBOARD = "1234567890qwertyuiopasdfghjklzxcvbnm"
# Correlation of neighbours in an ordinary counted or keyboard sequence.
FOLLOWS = 0.8
STEPS = 8


def _parts(text: Column, kind: int, pattern: str, group: int, present: Column) -> Column:
    """What stands before each match, the match and one of its groups, in order."""
    zipped = F.arrays_zip(
        F.split(text, pattern, -1).alias("gap"),
        F.regexp_extract_all(text, F.lit(pattern), F.lit(0)).alias("found"),
        F.regexp_extract_all(text, F.lit(pattern), F.lit(group)).alias("value"),
    )
    parts = F.transform(
        zipped,
        lambda p, i: F.struct(
            F.lit(kind).alias("kind"), i.alias("i"), F.char_length(p["gap"]).alias("gap"), F.char_length(p["found"]).alias("length"), p["value"].alias("value")
        ),
    )
    none = F.array().cast("array<struct<kind:int,i:int,gap:int,length:int,value:string>>")
    return F.when(present, parts).otherwise(none)


def _matches(docs: DataFrame) -> DataFrame:
    """(doc_id, digest, kind, start, end, value) of all matches of the patterns, candidates included."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    named = docs.select(F.col("doc_id").cast("long"), F.xxhash64("text").alias("digest"), text.alias("_text"))
    t = F.col("_text")
    low = F.lower(t)
    keyword = F.lit(False)
    for word in ("password", "passwd", "secret", "token", "apikey", "api_key"):
        keyword = keyword | low.contains(word)
    parts = F.concat(
        _parts(t, 0, ASSIGN, 2, keyword),
        _parts(t, 1, ACCESS, 0, t.contains("AKIA")),
        _parts(t, 2, HEX, 0, t.rlike(HEX)),
        _parts(t, 3, CANDIDATE, 0, t.rlike(CANDIDATE)),
    )
    # Rows with the same id and text have the same matches.
    each = named.select("doc_id", "digest", F.explode(parts).alias("p")).select("doc_id", "digest", "p.*").distinct()
    order = Window.partitionBy("doc_id", "digest", "kind").orderBy("i")
    end = F.sum(F.col("gap") + F.coalesce("length", F.lit(0))).over(order)
    placed = each.withColumn("end", end).where("length IS NOT NULL").withColumn("start", F.col("end") - F.col("length"))
    return placed.where("kind <> 0 OR length(value) >= 6").select("doc_id", "digest", "kind", "start", "end", "value")


def _normal(z: Column) -> Column:
    """The normal distribution function, to about 0.0002 and in its tails to some hundredths of its value."""
    z = F.greatest(F.lit(-8.0), F.least(F.lit(8.0), z))
    size = F.abs(z)
    tail = F.exp(-size * size / 2) / (size * 2.5066282746310002) * (1 - 1 / (size * size) + 3 / F.pow(size, F.lit(4.0)))
    middle = 1 / (1 + F.exp(-1.5976 * z - 0.07056 * z * z * z))
    return F.when(z < -3, tail).when(z > 3, 1 - tail).otherwise(middle)


def _both(one: Column, other: Column) -> Column:
    """Fisher's combination of two p-values."""
    product = F.greatest(one * other, F.lit(1e-300))
    return F.least(F.lit(1.0), product * (1 - F.log(product)))


def with_ordinariness(rows: DataFrame) -> DataFrame:
    """``rows`` with ``p``, the p-value of ``value``, a string of the candidates' characters, being an ordinary string.

    Each intermediate value is a column of its own, so that it is worked out once a row.
    """
    value, n = F.col("value"), F.col("_n")
    size, alphabet, equal, rate = F.lit(0.0), F.lit(""), F.lit(0.0), F.lit(None).cast("double")
    for pattern, letters, chance, changes in reversed(ENCODINGS):
        own = value.rlike(pattern) if pattern else F.lit(True)
        size = F.when(own, F.lit(float(len(letters)))).otherwise(size)
        alphabet = F.when(own, F.lit(letters)).otherwise(alphabet)
        equal = F.when(own, F.lit(chance)).otherwise(equal)
        rate = F.when(own, F.lit(changes).cast("double")).otherwise(rate)
    total = lambda x: F.aggregate(x, F.lit(0.0), lambda sum, v: sum + v)
    chars = F.filter(F.split(value, ""), lambda c: c != "")
    first = rows.withColumns({"_n": F.length(value).cast("double"), "_size": size, "_alphabet": alphabet, "_equal": equal, "_rate": rate, "_chars": chars})
    orders = [F.transform("_chars", lambda c: F.instr(F.col("_alphabet"), c).cast("double")), F.transform("_chars", lambda c: F.instr(F.lit(KEYBOARD), F.lower(c)).cast("double"))]
    count = lambda sum, c: sum + F.pow(n - F.length(F.replace(value, c, F.lit(""))), F.lit(2))
    second = first.withColumns({f"_codes_{i}": codes for i, codes in enumerate(orders)} | {"_squares": F.aggregate(F.array_distinct("_chars"), F.lit(0.0), count)})
    third = second.withColumns({f"_mean_{i}": total(F.col(f"_codes_{i}")) / n for i in (0, 1)})
    less = lambda codes, mean: F.transform(codes, lambda v: v - F.col(mean))
    centred = third.withColumns({f"_centred_{i}": less(f"_codes_{i}", f"_mean_{i}") for i in (0, 1)})

    size, excess = F.col("_size"), F.col("_size") * F.col("_equal") - 1
    chi = size / n * F.col("_squares") - n
    even = _normal((chi - (size - 1) - n * excess) / F.sqrt(2 * (size - 1) + 4 * n * excess))

    letters = value.rlike(LETTERS)
    consonants = "".join(c for c in LOWER + UPPER if c not in VOWELS)
    kinds = F.translate(value, UPPER + LOWER + DIGITS + "+/-_", "u" * 26 + "l" * 26 + "d" * 10)
    classes = F.when(letters, F.translate(value, VOWELS + consonants, "v" * len(VOWELS) + "c" * len(consonants))).otherwise(kinds)
    # A run of a class is what remains of it when neighbours of one class are merged; signs are left out.
    places = F.greatest(F.length(classes).cast("double") - 1, F.lit(1.0))
    changes = F.greatest(F.length(F.regexp_replace(classes, "(.)\\1+", "$1")).cast("double") - 1, F.lit(0.0))
    angle = lambda share: F.asin(F.sqrt(share))
    unlike = 2 * F.sqrt(places) * (angle(changes / places) - angle(F.col("_rate")))
    changing = F.when(letters, _normal(unlike)).otherwise(_normal(-unlike))

    def products(i: int) -> dict[str, Column]:
        around = F.col(f"_centred_{i}")
        cross = F.zip_with(F.slice(around, 1, F.size(around) - 1), F.slice(around, 2, F.size(around) - 1), lambda a, b: a * b)
        return {f"_square_{i}": total(F.transform(around, lambda v: v * v)), f"_cross_{i}": total(cross)}

    last = centred.withColumns({"_even": even, "_changing": changing} | products(0) | products(1))
    correlated = [F.when(F.col(f"_square_{i}") > 0, F.col(f"_cross_{i}") / F.col(f"_square_{i}")).otherwise(0.999) for i in (0, 1)]
    follows = last.withColumn("_r", F.greatest(F.lit(-0.999), F.least(F.lit(0.999), F.greatest(*correlated))))
    atanh = lambda x: F.log((1 + x) / (1 - x)) / 2
    serial = _normal((atanh(F.col("_r")) - atanh(F.lit(FOLLOWS))) * F.sqrt(n - 3))
    random = F.when(F.col("_changing").isNull(), F.col("_even")).otherwise(_both(F.col("_even"), F.col("_changing")))
    return follows.withColumn("p", F.greatest(random, serial, F.lit(1e-12))).select(*rows.columns, "p")


def _limits(tested: DataFrame, rate: float) -> dict[int, int]:
    """For each band the least step reported, from counts of p-values in steps of exp(1 / STEPS)."""
    counts = tested.groupBy("band", "step").count().collect()
    limits = {}
    for band in {r.band for r in counts}:
        own = sorted(((r.step, r["count"]) for r in counts if r.band == band), reverse=True)
        m, k, best = sum(c for _, c in own), 0, None
        for step, c in own:
            k += c
            if 2.718281828459045 ** (-step / STEPS) * m <= rate * k:
                best = step
        if best is not None:
            limits[band] = best
    return limits


def secret_spans(docs: DataFrame, rate: float = 0.002) -> DataFrame:
    """(doc_id, digest, kind, start, end) of all secrets, as a written table; kind is a place in KINDS.

    start and end count code points, end is exclusive. A random string that lies within a match of a pattern, or
    begins within one, is left out; digest is the xxhash64 of the text and tells apart rows that share a doc_id.
    """
    found = staged(_matches(docs), "matches")
    band = F.lit(len(BANDS))
    for i, below in reversed(list(enumerate(BANDS))):
        band = F.when(F.length("value") < below, F.lit(i)).otherwise(band)
    judged = with_ordinariness(found.where("kind = 3"))
    candidates = judged.withColumn("step", F.floor(-F.log("p") * STEPS).cast("int")).withColumn("band", band)
    tested = staged(candidates.drop("value", "p"), "tested")
    reported = F.lit(False)
    for own, step in _limits(tested, rate).items():
        reported = reported | ((F.col("band") == own) & (F.col("step") >= step))
    columns = ["doc_id", "digest", "kind", "start", "end"]
    spans = found.where("kind < 3").select(columns).unionByName(tested.where(reported).select(columns))
    earlier = Window.partitionBy("doc_id", "digest").orderBy("start", "kind").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    covered = F.max(F.when(F.col("kind") < 3, F.col("end"))).over(earlier)
    kept = spans.withColumn("_covered", covered).where("kind < 3 OR _covered IS NULL OR start >= _covered")
    return staged(kept.select(columns), "secrets")


def _by_document(docs: DataFrame, spans: DataFrame, columns: list[Column]) -> DataFrame:
    """Each row of ``docs`` with ``spans``: its spans in order, an empty list if it has none."""
    listed = spans.groupBy("doc_id", "digest").agg(
        F.array_sort(F.collect_list(F.struct("start", "kind", "end"))).alias("spans")
    )
    key = [F.col("d._id").eqNullSafe(F.col("s.doc_id")), F.col("d._digest").eqNullSafe(F.col("s.digest"))]
    own = docs.select(F.col("doc_id").cast("long").alias("_id"), F.xxhash64("text").alias("_digest"), *columns)
    none = F.array().cast("array<struct<start:bigint,kind:int,end:bigint>>")
    return own.alias("d").join(listed.alias("s"), key, "left").select("d.*", F.coalesce("s.spans", none).alias("_spans"))


def scan(docs: DataFrame, rate: float = 0.002) -> DataFrame:
    """(doc_id, n_assign, n_access, n_hex, base_sha256, spans, n_random) of each row of ``docs`` (doc_id, text, ...).

    Matches of a pattern are the leftmost that do not overlap, an assignment from its keyword to the end of its value.
    base_sha256 is of kind:start:end of the patterns' matches by start, then kind, joined by commas; spans holds the
    random strings too. A null or empty text has no spans. Repeated rows each get their row, a null doc_id is passed
    on, other columns play no part, an empty table gives none.
    """
    rows = _by_document(docs, secret_spans(docs, rate), [])
    name = F.array(*[F.lit(k) for k in KINDS])
    text = lambda spans: F.array_join(
        F.transform(spans, lambda s: F.concat_ws(":", F.element_at(name, s["kind"] + 1), s["start"].cast("string"), s["end"].cast("string"))), ","
    )
    spans = F.col("_spans")
    count = lambda kind: F.size(F.filter(spans, lambda s: s["kind"] == kind)).cast("long")
    return rows.select(
        F.col("_id").alias("doc_id"),
        *[count(i).alias(f"n_{k}") for i, k in enumerate(KINDS)],
        F.sha2(text(F.filter(spans, lambda s: s["kind"] < 3)).cast("binary"), 256).alias("base_sha256"),
        text(spans).alias("spans"),
    )


def redacted(docs: DataFrame, mask: str = "[SECRET]", rate: float = 0.002) -> DataFrame:
    """``docs`` with every secret of ``text`` replaced by ``mask``; overlapping secrets become one mask."""
    spans = secret_spans(docs, rate)
    rows = _by_document(docs, spans, [F.col(c).alias(f"_c{i}") for i, c in enumerate(docs.columns)])
    text = F.col(f"_c{docs.columns.index('text')}")
    state = F.struct(F.lit(0).cast("long").alias("upto"), F.lit("").alias("out"))

    def step(sum: Column, s: Column) -> Column:
        begin = F.greatest(s["start"], sum["upto"])
        between = F.substring(text, sum["upto"].cast("int") + 1, (begin - sum["upto"]).cast("int"))
        fresh = F.when(s["start"] >= sum["upto"], F.lit(mask)).otherwise(F.lit(""))
        return F.struct(F.greatest(sum["upto"], s["end"]).alias("upto"), F.concat(sum["out"], between, fresh).alias("out"))

    rest = lambda sum: F.concat(sum["out"], F.substring(text, sum["upto"].cast("int") + 1, F.char_length(text)))
    clean = F.when(F.size("_spans") > 0, F.aggregate("_spans", state, step, rest)).otherwise(text)
    return rows.select(*[(clean if c == "text" else F.col(f"_c{i}")).alias(c) for i, c in enumerate(docs.columns)])
