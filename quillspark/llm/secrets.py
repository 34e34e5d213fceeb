"""Secret scan: fixed patterns, and a battery of randomness tests.

Tokens of key-like characters are put to three tests under the alphabet that
their encoding implies: chi-squared uniformity, runs about the median, and
serial correlation. What is to be refuted is that a token is not random, thus
that its letters are spread like text or that it is ordered; so each test gives
the chance that such a token looks this random, and the largest of the three is
the token's p-value. Found is what false-discovery control over all tokens of
the corpus lets through, in classes of length, and what the three tests taken
the other way, combined by Fisher, do not reject as random. Short tokens can
only be found where many are random; the control sees to that. Built-in
functions only.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import let, stored, text_or_empty

# The base patterns, in the order of their kinds.
ASSIGN = (r"((?i:password|passwd|secret|token|api_?key))[\"']?\x20*[:=]\x20*[\"']?"
          r"([A-Za-z0-9+/_.=-]+)")
ASSIGN_LEAST = 6
ACCESS = r"AKIA[A-Z0-9]{16,}+"  # AKIA and what follows, 20 characters at least
HEX = r"[0-9a-f]{24,}+"  # whole runs of at least 24 characters
KINDS = ("assign", "access", "hex", "random")

# Tokens put to the tests: whole runs of at least 16 key-like characters. Over 64
# letters a random token of 16 has a p-value of some 0.002, of 12 some 0.01, which
# no share of random tokens brings under a false-discovery rate of 0.01.
TOKEN = r"(?<![A-Za-z0-9+/_=-])[A-Za-z0-9+/_=-]{16,}+"
# Encodings from the narrowest: name, test on the token, alphabet, and how far
# text over that alphabet is from uniform (its chi-squared per character).
ENCODINGS = (
    ("digits", r"^[0-9]+$", "0123456789", 0.1),
    ("hex", r"^(?=.*[0-9])[0-9a-f]+$", "0123456789abcdef", 0.6),
    ("HEX", r"^(?=.*[0-9])[0-9A-F]+$", "0123456789ABCDEF", 0.6),
    ("lower", r"^[a-z]+$", "abcdefghijklmnopqrstuvwxyz", 0.7),
    ("upper", r"^[A-Z]+$", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", 0.7),
    ("base32", r"^[A-Z2-7]+=*$", "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567", 1.1),
    ("base64", r"", "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/", 3.2),
)
REJECT = 1e-3  # combined p-value below which a token is not random
FDR = 1e-2
LENGTHS = (20, 24, 32, 48, 64, 128)  # bounds of the length classes


def located(text: Column, pattern: str) -> Column:
    """All leftmost non-overlapping matches with their places: array of
    (``start, end, match``) in code points, end exclusive. Splitting by the
    pattern gives what lies between matches, so places are running lengths."""
    none = F.array().cast("array<struct<start:int,end:int,match:string>>")

    def places(parts: Column) -> Column:
        def step(acc: Column, i: Column) -> Column:
            start = acc["at"] + F.length(parts["gaps"][i - 1])
            end = start + F.length(parts["found"][i - 1])
            return F.struct(end.alias("at"), F.array_append(acc["out"], F.struct(
                start.alias("start"), end.alias("end"), parts["found"][i - 1].alias("match")))
                .alias("out"))

        return F.aggregate(F.sequence(F.lit(1), F.size(parts["found"])),
                           F.struct(F.lit(0).alias("at"), none.alias("out")), step,
                           lambda acc: acc["out"])

    parts = F.struct(F.regexp_extract_all(text, F.lit(pattern), F.lit(0)).alias("found"),
                     F.split(text, pattern, -1).alias("gaps"))
    return F.when(text.rlike(pattern), let(parts, places)).otherwise(none)


def _normal_tail(z: Column) -> Column:
    """P(N > z) by the logistic form of its approximation."""
    return F.lit(1.0) / (F.lit(1.0) + F.exp(z * 1.5976 + z * z * z * 0.07056))


def _two_sided(z: Column) -> Column:
    return F.greatest(F.lit(1e-12), F.least(F.lit(1.0), _normal_tail(F.abs(z)) * 2))


def battery(token: Column) -> Column:
    """Struct of ``random`` (combined p-value of a random token), ``other`` (that
    of one which is not: the largest of the three tests') and ``kind``."""
    kind = None
    for name, test, _, _ in ENCODINGS[:-1]:
        kind = F.when(token.rlike(test), name) if kind is None else kind.when(token.rlike(test), name)
    kind = kind.otherwise(ENCODINGS[-1][0])

    def pick(kind: Column, values: list) -> Column:
        out = None
        for (name, _, _, _), v in zip(ENCODINGS, values):
            out = F.when(kind == name, v) if out is None else out.when(kind == name, v)
        return out

    def with_kind(kind: Column) -> Column:
        alphabet = pick(kind, [F.lit(a) for _, _, a, _ in ENCODINGS])
        # URL-safe base64 counts as base64; padding carries nothing.
        plain = F.rtrim(F.translate(token, "-_=", "+/ "))
        codes = F.transform(F.filter(F.split(plain, ""), lambda c: c != ""),
                            lambda c: F.position(c, alphabet))
        sums = let(codes, lambda codes: _sums(codes, F.length(alphabet)))
        return let(sums, lambda s: _p_values(s, kind, pick(kind, [F.lit(d) for *_, d in ENCODINGS])))

    return let(kind, with_kind)


def _sums(codes: Column, letters: Column) -> Column:
    """What the tests need of the codes (1 to ``letters``) of a token."""
    middle = (letters + 1) / 2
    squares = F.aggregate(  # of the counts, from the runs of the sorted codes
        F.array_sort(codes),
        F.struct(F.lit(-1).alias("last"), F.lit(0).alias("run"), F.lit(0).alias("sum")),
        lambda acc, c: F.struct(
            c.alias("last"), F.when(c == acc["last"], acc["run"] + 1).otherwise(1).alias("run"),
            (acc["sum"] + F.when(c == acc["last"], acc["run"] * 2 + 1).otherwise(1)).alias("sum")),
        lambda acc: acc["sum"].cast("double"))
    side = lambda c: F.when(c > middle, 1).otherwise(-1)
    walk = F.aggregate(
        codes,
        F.struct(F.lit(0).alias("side"), F.lit(0).alias("runs"), F.lit(0).alias("high"),
                 F.lit(0.0).alias("last"), F.lit(0.0).alias("products"), F.lit(0.0).alias("sum"),
                 F.lit(0.0).alias("squares")),
        lambda acc, c: F.struct(
            side(c).alias("side"),
            (acc["runs"] + (acc["side"] != side(c)).cast("int")).alias("runs"),
            (acc["high"] + (c > middle).cast("int")).alias("high"),
            (c - middle).cast("double").alias("last"),
            (acc["products"] + acc["last"] * (c - middle)).alias("products"),
            (acc["sum"] + (c - middle)).alias("sum"),
            (acc["squares"] + (c - middle) * (c - middle)).alias("squares")))
    return F.struct(F.size(codes).cast("double").alias("n"), letters.cast("double").alias("k"),
                    squares.alias("counts"), walk.alias("walk"))


def _p_values(s: Column, kind: Column, shift: Column) -> Column:
    n, k, walk = s["n"], s["k"], s["walk"]
    free = k - 1
    chi = s["counts"] * k / n - n
    # Wilson-Hilferty: the cube root of chi-squared over its freedom is normal.
    wh = (F.pow(F.greatest(chi, F.lit(1e-9)) / free, F.lit(1 / 3))
          - (1 - F.lit(2.0) / (free * 9))) / F.sqrt(F.lit(2.0) / (free * 9))
    p_chi = F.greatest(F.lit(1e-12), _normal_tail(wh))
    high = walk["high"].cast("double")
    expect = high * (n - high) * 2 / n + 1
    spread = (expect - 1) * (expect - 2) / F.greatest(n - 1, F.lit(1.0))
    z_runs = F.when(spread > 0, (walk["runs"] - expect) / F.sqrt(spread)).otherwise(F.sqrt(n))
    mean = walk["sum"] / n
    variance = walk["squares"] / n - mean * mean
    serial = F.when(variance > 0, (walk["products"] / n - mean * mean) / variance * F.sqrt(n)) \
        .otherwise(F.sqrt(n))
    # Fisher: minus twice the log of the product is chi-squared with six degrees.
    fisher = -(F.log(p_chi) + F.log(_two_sided(z_runs)) + F.log(_two_sided(serial)))
    p_random = let(fisher, lambda half: F.exp(-half) * (1 + half + half * half / 2))
    # Chi-squared of text is shifted by ``shift`` per character; in ordered tokens
    # the other two are the root of the length.
    far = n * shift
    p_text = _normal_tail((free + far - chi) / F.sqrt((free + far * 2) * 2))
    ordered = [_normal_tail(F.sqrt(n) - F.abs(z)) for z in (z_runs, serial)]
    return F.struct(p_random.alias("random"),
                    F.greatest(F.lit(1e-19), p_text, *ordered).alias("other"), kind.alias("kind"))


def length_class(n: Column) -> Column:
    return sum(((n >= b).cast("int") for b in LENGTHS), F.lit(0))


def _cell(p: Column) -> Column:
    """Grid cell whose upper end is the smallest step not below p."""
    return F.ceil(F.log10(p) * 10).cast("int")


def thresholds(tokens: DataFrame, fdr: float = FDR) -> DataFrame:
    """Benjamini-Hochberg within length classes, on a grid of p-values: per
    class the largest step t with t <= fdr * (tokens at or below t) / (tokens).
    A partial count per class and step, a fixed number of rows."""
    cells = tokens.groupBy(length_class(F.col("length")).alias("class"),
                           _cell(F.col("other")).alias("cell")).agg(F.count(F.lit(1)).alias("n"))
    upto = Window.partitionBy("class").orderBy("cell")
    whole = Window.partitionBy("class")
    ranked = cells.select("class", "cell", F.sum("n").over(upto).alias("rank"),
                          F.sum("n").over(whole).alias("all"))
    good = F.pow(F.lit(10.0), F.col("cell") / 10.0) <= F.lit(fdr) * F.col("rank") / F.col("all")
    return ranked.where(good).groupBy("class").agg(F.max("cell").alias("cell"))


def scan(docs: DataFrame, keep: tuple[str, ...] = ("doc_id",), fdr: float = FDR) -> DataFrame:
    """Secrets of every text: ``keep, base, found``, arrays of (``start, kind,
    end``) in that order, in code points, end exclusive, the kind as its number
    in KINDS. ``base`` is what the fixed patterns match,
    ``found`` adds the random tokens that overlap none of those.

    Null and empty texts have none. Texts are read whole, once; only places and
    p-values are kept for the second step. Copies and repeated rows are
    scanned as they come, and their tokens count as often in the control. No
    rows give no rows. Other columns are ignored.
    """
    text = F.col("text")

    def spans(name: str, pattern: str, ok=None) -> Column:
        found = located(text, pattern)
        found = F.filter(found, ok) if ok else found
        return F.transform(found, lambda x: F.struct(
            x["start"].alias("start"), F.lit(KINDS.index(name)).alias("kind"),
            x["end"].alias("end")))

    long_enough = lambda x: F.length(F.regexp_extract(x["match"], ASSIGN, 2)) >= ASSIGN_LEAST
    base = F.array_sort(F.concat(spans("assign", ASSIGN, long_enough), spans("access", ACCESS),
                                 spans("hex", HEX)))
    def tested(base: Column, tokens: Column) -> Column:
        free = F.filter(tokens, lambda t: ~F.exists(
            base, lambda b: (b["start"] < t["end"]) & (t["start"] < b["end"])))
        return F.transform(free, lambda t: F.struct(
            t["start"].alias("start"), t["end"].alias("end"), battery(t["match"]).alias("p")))

    # All of a row at once: the steps read each other's results, not the text.
    both = let(F.struct(base.alias("base"), located(text, TOKEN).alias("tokens")), lambda r: F.struct(
        r["base"].alias("base"), tested(r["base"], r["tokens"]).alias("tested")))
    rows = docs.select(*[F.col(c).alias(f"k_{c}") for c in keep], text_or_empty().alias("text"))
    rows = stored(rows.select(*[F.col(f"k_{c}") for c in keep], both.alias("both"))) \
        .select(*[F.col(f"k_{c}") for c in keep], "both.*")
    tokens = rows.select(F.explode("tested").alias("t")) \
        .select((F.col("t.end") - F.col("t.start")).alias("length"), "t.p.other")
    limit = {r["class"]: r["cell"] for r in thresholds(tokens, fdr).collect()}
    limits = F.array(*[F.lit(limit.get(c, -1000)) for c in range(len(LENGTHS) + 1)])
    random = F.filter("tested", lambda t: (t["p"]["random"] >= REJECT) & (
        _cell(t["p"]["other"]) <= F.element_at(limits, length_class(t["end"] - t["start"]) + 1)))
    random = F.transform(random, lambda t: F.struct(
        t["start"].alias("start"), F.lit(KINDS.index("random")).alias("kind"),
        t["end"].alias("end")))
    return rows.select(*[F.col(f"k_{c}").alias(c) for c in keep], "base",
                       F.array_sort(F.concat("base", random)).alias("found"))


def joined(spans: Column) -> Column:
    """``kind:start:end`` of each span, comma-joined."""
    names = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(
        ":", F.element_at(names, s["kind"] + 1), s["start"].cast("string"),
        s["end"].cast("string"))), ",")


def count_of(spans: Column, kind: str) -> Column:
    return F.size(F.filter(spans, lambda s: s["kind"] == KINDS.index(kind))).cast("long")
