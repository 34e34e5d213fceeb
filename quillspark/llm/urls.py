"""URL filter: fixed rules first, then a character language-model ratio.

Two variable-order Markov models are learned, one from the URLs that the rules
accept and one from those that they reject. A URL that no rule decides is
accepted or rejected by the difference of the two log-likelihoods per
character, against a threshold calibrated on rule-decided URLs held out of the
models. The models are tables of exact n-gram counts that grow with the URLs;
URLs meet them in joins. Built-in functions only.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import ascii_lower, let, stored

ORDER = 4  # characters of context at most
STRENGTH = 2.0  # how many observations the shorter context counts as
LETTERS = 96.0  # size of the alphabet behind the empty context
UNIT = 1e9  # log-ratios are summed as whole billionths, so in any order alike

Rule = tuple[str, str, str]  # verdict, host, path


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Host (A-Z lower-cased) after the first ``://`` up to ``/ ? #``, and the
    path from there up to ``? #``; both empty for null and without ``://``."""
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substr(url, at + 3)).otherwise(F.lit(""))
    rest = F.coalesce(rest, F.lit(""))
    host = F.regexp_extract(rest, r"(?s)^([^/?#]*)", 1)
    path = F.regexp_extract(rest, r"(?s)^[^/?#]*([^?#]*)", 1)
    return ascii_lower(host), path


def matched_rule(host: Column, path: Column, rules: Sequence[Rule]) -> tuple[Column, Column]:
    """Longest fitting rule as text and its verdict, both null if none fits."""
    name, verdict = None, None
    for kind, rule_host, rule_path in sorted(rules, key=lambda r: -len(r[1] + r[2])):
        fits = ((host == rule_host) | host.endswith("." + rule_host)) & path.startswith(rule_path)
        text = F.lit(rule_host + rule_path)
        name = F.when(fits, text) if name is None else name.when(fits, text)
        verdict = F.when(fits, F.lit(kind)) if verdict is None else verdict.when(fits, F.lit(kind))
    if name is None:
        return F.lit(None).cast("string"), F.lit(None).cast("string")
    return name, verdict


def _grams(text: Column, sizes: Sequence[int]) -> Column:
    """For each character of a text and its end mark, the n-grams of ``sizes``
    characters that end there; start marks stand before the first."""
    padded = F.concat(F.lit("\x02" * ORDER), text, F.lit("\x03"))

    def at(chars: Column) -> Column:
        places = F.sequence(F.lit(ORDER + 1), F.length(text) + (ORDER + 1))
        return F.flatten(F.transform(places, lambda i: F.array(
            *[F.array_join(F.slice(chars, i - (n - 1), n), "") for n in sizes])))

    return let(F.split(padded, ""), at)


def models(urls: DataFrame) -> DataFrame:
    """Both models in one table ``gram, yes, no, after_yes, after_no``: how
    often a string of up to ORDER + 1 characters occurs in either class, and
    how often some character comes after it. ``urls`` has ``text`` and the flag
    ``yes``. The empty string has the number of all characters.

    One row per different string, made by partial sums: frequent strings meet
    as one row per task.
    """
    yes, no = F.col("yes").cast("long"), (~F.col("yes")).cast("long")
    counts = urls.select("yes", F.explode(_grams(F.col("text"), range(1, ORDER + 2))).alias("gram")) \
        .groupBy("gram").agg(F.sum(yes).alias("yes"), F.sum(no).alias("no"))
    zero, context = F.lit(0).cast("long"), F.expr("left(gram, length(gram) - 1)")
    roles = F.array(
        F.struct(F.col("gram"), F.col("yes"), F.col("no"), zero.alias("after_yes"),
                 zero.alias("after_no")),
        F.struct(context.alias("gram"), zero.alias("yes"), zero.alias("no"),
                 F.col("yes").alias("after_yes"), F.col("no").alias("after_no")))
    names = ("yes", "no", "after_yes", "after_no")
    return counts.select(F.explode(roles).alias("r")).select("r.*") \
        .groupBy("gram").agg(*[F.sum(c).alias(c) for c in names])


def ratios(grams: DataFrame, model: DataFrame) -> DataFrame:
    """``gram, units`` for each of the ``grams`` of ORDER + 1 characters: the
    difference of the log-probabilities of its last character after the rest,
    in UNIT-ths.

    The probability of a character after k characters is its share there, with
    its probability after k - 1 added as STRENGTH further observations; a
    context never seen falls through to the shorter one, so the order varies
    with the evidence. Each gram looks up its endings and their contexts, nine
    strings, in one join."""
    ending = lambda n: F.expr(f"right(gram, {n})")
    before = lambda n: F.expr(f"left(right(gram, {n + 1}), {n})")
    looked = F.array(*[F.struct(F.lit(k).alias("slot"), ending(k + 1).alias("part"))
                       for k in range(ORDER + 1)],
                     *[F.struct(F.lit(-k).alias("slot"), before(k).alias("part"))
                       for k in range(1, ORDER + 1)])
    parts = grams.select("gram", F.explode(looked).alias("l")).select("gram", "l.slot", "l.part")
    stats = model.withColumnRenamed("gram", "part")
    total = model.where("gram = ''").first()  # one row, or none without learned URLs
    kinds = ("yes", "no")

    def of(slot: int, column: str) -> Column:
        return F.coalesce(F.max(F.when(F.col("slot") == slot, F.col(column))), F.lit(0)).cast("double")

    met = parts.join(stats, "part", "left").groupBy("gram").agg(
        *[of(k, c).alias(f"{c}{k}") for c in kinds for k in range(ORDER + 1)],
        *[of(-k, f"after_{c}").alias(f"after_{c}{k}") for c in kinds for k in range(1, ORDER + 1)])

    def p(kind: str) -> Column:
        characters = float(total[f"after_{kind}"]) if total else 0.0
        out = (F.col(f"{kind}0") + 1.0) / (characters + LETTERS)
        for k in range(1, ORDER + 1):
            out = (F.col(f"{kind}{k}") + out * STRENGTH) / (F.col(f"after_{kind}{k}") + STRENGTH)
        return out

    return met.select("gram", F.round(F.log(p("yes") / p("no")) * UNIT).cast("long").alias("units"))


def _key(text: str = "text") -> Column:
    return F.unhex(F.md5(F.col(text).cast("binary")))


def scores(texts: DataFrame, model: DataFrame) -> DataFrame:
    """``key, yes, score`` of distinct ``texts`` (``text, yes``): the
    log-likelihood difference per character, the end mark counted; ``key`` is
    the digest of the text. Frequent grams have one row in the table of ratios;
    it is broadcast only if its written size allows, else the join shuffles and
    may split what meets a frequent gram."""
    whole = F.explode(_grams(F.col("text"), [ORDER + 1])).alias("gram")
    table = stored(ratios(texts.select(whole).distinct(), model))
    return texts.select(_key().alias("key"), "yes", whole).join(table, "gram") \
        .groupBy("key", "yes").agg((F.sum("units") / UNIT / F.count(F.lit(1))).alias("score"))


def _threshold(held: DataFrame) -> float:
    """Equally many deviations from both means of ``yes, score``; 0 if a class
    is missing."""
    yes, no = F.when(F.col("yes"), F.col("score")), F.when(~F.col("yes"), F.col("score"))
    row = held.agg(F.avg(yes).alias("my"), F.avg(no).alias("mn"),
                   F.stddev_pop(yes).alias("sy"), F.stddev_pop(no).alias("sn")).first()
    if row["my"] is None or row["mn"] is None:
        return 0.0
    spread = row["sy"] + row["sn"]
    return ((row["my"] * row["sn"] + row["mn"] * row["sy"]) / spread if spread
            else (row["my"] + row["mn"]) / 2)


def judge(pages: DataFrame, rules: Sequence[Rule], keep: Sequence[str] = ("page_id",),
          url: str = "url", fold: int = 4) -> DataFrame:
    """Verdict of every URL: ``keep, host, path, rule, verdict, score``.

    ``score`` is the log-likelihood difference per character, accepted minus
    rejected; null where a rule decides. The models learn from distinct
    rule-decided addresses (host and path) but for one in ``fold`` by hash.
    Those give mean and spread of the score in either class, and the threshold
    stands equally many deviations from both means. If a class is missing
    there, the threshold is 0; with nothing to learn from every score is 0, and
    scores that reach the threshold are allowed.

    Null and empty URLs have an empty host and path and are judged as such.
    Repeated rows come out repeated; they do not weigh twice in the models, and
    an address is scored once however many pages have it. No rows give no rows.
    Other columns are ignored. The driver sees the number of characters of
    either class and the calibration's four figures.
    """
    host, path = host_and_path(F.col(url).cast("string"))
    rows = pages.select(*[F.col(c).alias(f"k_{c}") for c in keep], host.alias("host"),
                        path.alias("path"))
    rule, by_rule = matched_rule(F.col("host"), F.col("path"), rules)
    rows = rows.select("*", rule.alias("rule"), by_rule.alias("by_rule"),
                       F.concat("host", "path").alias("text"))
    # Host and path follow from the address, so a rule decides all of its pages or none.
    addresses = stored(rows.select("text", (F.col("by_rule") == "allow").alias("yes")).distinct())
    part = F.pmod(F.xxhash64(F.lit("fold"), F.col("text")), F.lit(fold))
    model = stored(models(addresses.where(F.col("yes").isNotNull() & (part != 0))))
    scored = stored(scores(addresses.where(F.col("yes").isNull() | (part == 0)), model))
    threshold = _threshold(scored.where("yes is not null"))
    free = scored.where("yes is null").select("key", "score")
    # Decided rows find nothing; they keep their key, so that the join spreads them too.
    rows = rows.withColumn("key", _key()).join(free, "key", "left")
    verdict = F.coalesce("by_rule", F.when(F.col("score") >= threshold, F.lit("allow"))
                         .otherwise(F.lit("block")))
    return rows.select(*[F.col(f"k_{c}").alias(c) for c in keep], "host", "path", "rule",
                       verdict.alias("verdict"), "score")
