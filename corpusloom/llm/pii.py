"""Personal data: candidate spans scored by boosted trees, in DataFrame functions only.

Plain patterns give the base spans of each kind; they always stay. High-recall generators propose
more spans, which may overlap one another: addresses written with words, numbers without their
prefix or separators, addresses next to odd characters. Boosted trees, trained on the format and
the context of candidates, score them; a kind's threshold is calibrated on candidates that training
did not see, and a candidate over it is added where it overlaps no base span and no better one.

There are no labels for personal data. Positive are candidates that lie on a base span of their kind and pass
its check. Negative are candidates off those that cannot be added: they fail the check (Luhn, octets, number of
digits, standing alone, a domain) or lie on a base span of another kind. What may be added, a candidate that passes and
touches no base span, is never an example. The trees see no sign or separator, which tell base patterns from the rest.

A null text counts as empty. Offsets are code points, ends exclusive. Rows that repeat are returned
as often as they came in. Other columns are ignored. Texts are read whole at any length: every
pattern takes time linear in the text.
"""

from __future__ import annotations

from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from corpusloom.session import written

KINDS = ("email", "ip", "card", "phone")

# Base patterns. The loops are possessive: nothing after them could use what they give back, and the
# regular expression engine then neither recurses nor tries a run again from each of its characters.
BASE = {
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[\x20-]?[0-9]){12,}+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
# What a text must hold before its pattern is tried.
NEEDS = {
    "email": lambda t: F.contains(t, F.lit("@")),
    "ip": lambda t: F.rlike(t, F.lit(r"[0-9]\.[0-9]")),
    "card": lambda t: F.rlike(t, F.lit(r"[0-9][\x20-]?[0-9][\x20-]?[0-9][\x20-]?[0-9][\x20-]?[0-9]")),
    "phone": lambda t: F.contains(t, F.lit("+")),
}
# Generators of further candidates; what they propose may overlap the base spans and one another.
GENERATORS = {
    "email": (
        r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]++(?:@| ?[(\[](?:at|AT)[)\]] ?| at )[A-Za-z0-9-]{1,63}+"
        r"(?:(?:\.| ?[(\[](?:dot|DOT)[)\]] ?| dot )[A-Za-z0-9-]{1,63}+){0,8}+",
        lambda t: F.contains(t, F.lit("@")) | F.rlike(t, F.lit(r"[(\[](?:at|AT)[)\]]| at ")),
    ),
    "ip": (r"(?<![0-9])[0-9]{1,3}+(?:\x20?[.,:_]\x20?[0-9]{1,3}+){3}(?![0-9])", lambda t: F.rlike(t, F.lit(r"[0-9]\x20?[.,:_]\x20?[0-9]"))),
    "card": (r"(?<![0-9])[0-9](?:[\x20./_-]{0,2}+[0-9]){11,22}+", lambda t: F.rlike(t, F.lit(r"[0-9][\x20./_-]{0,2}[0-9][\x20./_-]{0,2}[0-9][\x20./_-]{0,2}[0-9]"))),
    "phone": (
        r"(?<![0-9])(?=[+(0-9])(?:(?:\+|00)?[0-9]{0,3}[\x20.-]{0,2}+\(?[0-9]{3}\)?[\x20.-]{0,2}[0-9]{3}[\x20.-]{0,2}[0-9]{4}(?![0-9])"
        r"|\+?\(?[0-9](?:[\x20().-]{0,2}+[0-9]){6,17}+(?![0-9]))",
        lambda t: F.rlike(t, F.lit(r"[0-9](?:[\x20().-]{0,2}[0-9]){6}")),
    ),
}
# Candidates that the trees learn from, at most; each kind and label has an equal part. Calibration covers all.
MOST_EXAMPLES = 20_000
# A kind's threshold is the lowest score over which at least this share is right, were there as many negatives as positives.
PRECISION = 0.95
# A kind with fewer examples to learn from, or a quarter of them to calibrate with, of either label is added
# only after a word that names it.
LEAST_EXAMPLES = 40
# Negatives that pass the check by chance for each that fails it.
BY_CHANCE = {"card": 1 / 9}
NAMED_BY = {
    "email": "mail|contact|address|reach|write", "ip": "ip|address|server|host", "card": "card|visa|mastercard",
    "phone": "phone|tel|call|mobile|contact|reach",
}
_CONTEXT = 24
# Digits that are a date and no phone.
_DATE = r"(?<![0-9])(?:19|20)[0-9]{2}[./-][01][0-9][./-][0-3][0-9]"
# The dot of a domain in any notation.
_DOT = r"(?:\.| ?[(\[]dot[)\]] ?| dot )"


def _hits(text: Column, pattern: str, needed: Column) -> Column:
    """Each match with the code points between it and the one before, and the text around it."""
    def around(found: Column) -> Column:
        # The pieces between the matches are bound once, not split again for every match.
        return F.flatten(F.transform(F.array(F.split(text, pattern, -1)), lambda pieces: F.transform(
            found, lambda m, i: F.struct(
                F.char_length(F.get(pieces, i)).alias("gap"), m.alias("match"),
                F.right(F.get(pieces, i), F.lit(_CONTEXT)).alias("before"), F.left(F.get(pieces, i + 1), F.lit(_CONTEXT)).alias("after"),
            ),
        )))

    none = F.expr("cast(array() as array<struct<gap:int,match:string,before:string,after:string>>)")
    found = F.when(needed, F.regexp_extract_all(text, F.lit(pattern), F.lit(0)))
    return F.flatten(F.transform(F.array(found), lambda m: F.when(F.size(m) > 0, around(m)).otherwise(none)))


def _digits(match: Column) -> Column:
    return F.regexp_replace(match, "[^0-9]", "")


def luhn(digits: Column) -> Column:
    """Whether a string of digits passes the Luhn check."""
    each = F.transform(F.split(F.reverse(digits), ""), lambda d, i: F.when(i % 2 == 0, d.try_cast("int")).otherwise(
        d.try_cast("int") * 2 - F.when(d.try_cast("int") > 4, 9).otherwise(0)
    ))
    return F.aggregate(each, F.lit(0), lambda a, x: a + F.coalesce(x, F.lit(0))) % 10 == 0


def _passes(kind: Column, match: Column) -> Column:
    digits = _digits(match)
    n = F.char_length(digits)
    parts = F.transform(F.split(match, r"\."), lambda p: F.regexp_replace(p, "^0+(?=.)", ""))
    small = F.forall(parts, lambda p: (F.char_length(p) <= 3) & (F.coalesce(p.try_cast("int"), F.lit(256)) <= 255))
    return (
        F.when(kind == "ip", small).when(kind == "card", n.between(13, 19) & luhn(digits))
        .when(kind == "phone", n.between(9, 15)).otherwise(True)
    )


def _valid(kind: Column, match: Column, before: Column, after: Column) -> Column:
    """Whether a candidate in any notation passes the check of its kind."""
    digits = _digits(match)
    n = F.char_length(digits)
    parts = F.regexp_extract_all(match, F.lit("[0-9]+"), F.lit(0))
    alone = ~F.rlike(before, F.lit(r"[\p{L}\p{N}]$")) & ~F.rlike(after, F.lit(r"^[\p{L}\p{N}]"))
    return (
        F.when(kind == "ip", F.forall(parts, lambda p: F.coalesce(p.try_cast("int"), F.lit(256)) <= 255) & alone)
        .when(kind == "card", n.between(13, 19) & luhn(digits) & alone).when(kind == "phone", n.between(9, 15) & alone & ~F.rlike(match, F.lit(_DATE)))
        .otherwise(F.rlike(match, F.lit(rf"(?i){_DOT}[a-z]{{2,24}}$")))
    )


def _named(kind: Column) -> Column:
    """Whether the word before a candidate names its kind."""
    out = F.lit(False)
    for k, words in NAMED_BY.items():
        out = F.when(kind == k, F.rlike(F.col("before"), F.lit(rf"(?i)(?:{words})\W{{0,3}}$"))).otherwise(out)
    return out


def _features(c: DataFrame) -> tuple[DataFrame, list[str]]:
    """Content and context of a candidate as numbers, the same in every notation."""
    match, before, after, kind = F.col("match"), F.col("before"), F.col("after"), F.col("kind")
    number = lambda condition: condition.cast("double")
    digits = _digits(match)
    made = {
        # Of phones the first digit would tell the prefix.
        "first_digit": F.when(kind == "card", F.substring(digits, 1, 1).try_cast("double")).otherwise(-1.0),
        "distinct_digits": F.when(kind == "card", F.size(F.array_distinct(F.split(digits, ""))).cast("double")).otherwise(-1.0),
        "domain_parts": F.when(kind == "email", F.size(F.regexp_extract_all(match, F.lit(rf"(?i){_DOT}"), F.lit(0))).cast("double")).otherwise(-1.0),
        "ending": F.when(kind == "email", F.char_length(F.regexp_extract(match, "[A-Za-z]*$", 0)).cast("double")).otherwise(-1.0),
        "named": number(_named(kind)), "other_named": number(~_named(kind) & F.rlike(before, F.lit(rf"(?i)(?:{'|'.join(NAMED_BY.values())})\W{{0,3}}$"))),
        "glued_before": number(F.rlike(before, F.lit(r"[\p{L}\p{N}]$"))), "glued_after": number(F.rlike(after, F.lit(r"^[\p{L}\p{N}]"))),
        "quoted": number(F.rlike(before, F.lit("[\"'=]$"))), "space_before": number(F.rlike(before, F.lit(r"(^|\s)$"))),
        "space_after": number(F.rlike(after, F.lit(r"^(\s|$)"))), "digit_near": number(F.rlike(F.concat(before, F.lit("|"), after), F.lit("[0-9]"))),
    }
    for k in KINDS:
        made[f"is_{k}"] = number(kind == k)
    return c.withColumns(made), list(made)


def _examples(data: DataFrame, names: list[str]) -> DataFrame:
    """Examples of each kind and label, bounded and as evenly weighted, one of each text and context."""
    keys = data.where(~F.col("unseen") & F.col("label").isNotNull()).select("kind", "label", "order").distinct()
    place = F.row_number().over(Window.partitionBy("kind", "label").orderBy("order"))
    keys = keys.withColumn("place", place).where(F.col("place") <= MOST_EXAMPLES // (2 * len(KINDS))).drop("place")
    sample = data.join(F.broadcast(keys), ["kind", "label", "order"]).groupBy("kind", "label", "order").agg(*[F.min(n).alias(n) for n in names])
    sample = written(sample, "pii-examples")
    parts = sample.groupBy("kind").agg(F.count(F.when(F.col("label") == 0, 1)).alias("bad"), F.count(F.when(F.col("label") == 1, 1)).alias("good"))
    parts = parts.where(F.least("bad", "good") >= LEAST_EXAMPLES)
    return sample.join(F.broadcast(parts), "kind").withColumn("weight", 1000 / F.when(F.col("label") == 1, F.col("good")).otherwise(F.col("bad")))


def _threshold(steps: list[tuple[int, float, int]], chance: float) -> float | None:
    """The threshold from the positives and all examples of each step of the score; None with too few, over 1 if no score is enough."""
    all_good = sum(g for _, g, _ in steps)
    all_bad = sum(n for _, _, n in steps) - all_good
    if min(all_good, all_bad) < LEAST_EXAMPLES // 4:
        return None
    good = bad = 0
    least = 2.0
    for step, g, n in sorted(steps, reverse=True):
        good, bad = good + g, bad + n - g
        right, wrong = good / all_good, chance * bad / all_bad
        if right and right >= PRECISION * (right + wrong):
            least = step / 100
    return least


def _scored(candidates: DataFrame) -> tuple[DataFrame, Column]:
    """Candidates with the trees' score, and whether it is enough for their kind."""
    featured, names = _features(candidates)
    # Null for what may be added.
    label = F.when(F.col("on_base"), F.when(F.col("valid"), 1.0)).when(~(F.col("free") & F.col("valid")), 0.0)
    order = F.xxhash64("match", "before", "after")
    data = featured.withColumns({"label": label, "order": order, "unseen": F.pmod(order, F.lit(10)) >= 7})
    assembler = VectorAssembler(inputCols=names, outputCol="features")
    examples = assembler.transform(_examples(data, names))
    learned = [r["kind"] for r in examples.select("kind").distinct().collect()]
    thresholds: dict[str, float] = {}
    if learned:
        model = GBTClassifier(maxIter=12, maxDepth=3, stepSize=0.3, seed=1, weightCol="weight").fit(examples)
        data = model.transform(assembler.transform(data)).withColumn("score", vector_to_array("probability")[1])
        held = data.where(F.col("unseen") & F.col("label").isNotNull()).groupBy("kind", F.floor(F.col("score") * 100).alias("step"))
        steps = held.agg(F.sum("label").alias("good"), F.count("*").alias("n")).collect()
        for kind in learned:
            least = _threshold([(r["step"], r["good"], r["n"]) for r in steps if r["kind"] == kind], BY_CHANCE.get(kind, 1.0))
            if least is not None:
                thresholds[kind] = least
    else:
        data = data.withColumn("score", F.lit(0.0))
    enough = F.lit(False)
    for kind in KINDS:
        enough = enough | ((F.col("kind") == kind) & (F.col("score") >= thresholds[kind] if kind in thresholds else _named(F.col("kind"))))
    return data, enough


def _touching(spans: DataFrame, name: str, *keys: str) -> DataFrame:
    """Whether a span overlaps a base span of the same keys, from running extremes in both directions."""
    base_end, base_start = F.when(F.col("base"), F.col("end")), F.when(F.col("base"), F.col("start"))
    down = Window.partitionBy(*keys).orderBy("start").rangeBetween(Window.unboundedPreceding, 0)
    up = Window.partitionBy(*keys).orderBy(F.desc("start")).rangeBetween(Window.unboundedPreceding, 0)
    return spans.withColumn(name, F.coalesce(F.max(base_end).over(down) > F.col("start"), F.lit(False))
                            | F.coalesce(F.min(base_start).over(up) < F.col("end"), F.lit(False)))


def _apart(chosen: DataFrame) -> DataFrame:
    """The best scored, then the longest, then the first of the spans of each row, and all next ones that overlap no better one."""
    before = Window.partitionBy("row").orderBy("start", "end").rowsBetween(Window.unboundedPreceding, -1)
    so_far = Window.partitionBy("row").orderBy("start", "end").rowsBetween(Window.unboundedPreceding, 0)
    apart = F.coalesce(F.col("start") >= F.max("end").over(before), F.lit(True)).cast("int")
    chains = chosen.withColumn("apart", apart).withColumn("chain", F.sum("apart").over(so_far))
    ranked = F.sort_array(F.collect_list(F.struct((-F.col("score")).alias("worse"), (F.col("start") - F.col("end")).alias("shorter"), "start", "kind", "end", "match")))
    chains = chains.groupBy("row", "chain").agg(ranked.alias("spans"))
    kept = F.aggregate("spans", F.filter("spans", lambda s: F.lit(False)), lambda kept, s: F.when(
        F.exists(kept, lambda k: (k["start"] < s["end"]) & (s["start"] < k["end"])), kept
    ).otherwise(F.concat(kept, F.array(s))))
    return chains.select("row", F.explode(kept).alias("b")).select("row", "b.kind", "b.start", "b.end", "b.match")


def find_pii(docs: DataFrame, text: str = "text", doc_id: str = "doc_id") -> tuple[DataFrame, DataFrame]:
    """All rows as ``row, doc_id``, and their spans as ``row, kind, start, end, base, match``."""
    whole = F.coalesce(F.col(f"`{text}`"), F.lit(""))
    found = [F.struct(F.lit(k).alias("kind"), F.lit(True).alias("base"), _hits(F.col("text"), BASE[k], NEEDS[k](F.col("text"))).alias("hits")) for k in KINDS]
    found += [F.struct(F.lit(k).alias("kind"), F.lit(False).alias("base"), _hits(F.col("text"), p, needs(F.col("text"))).alias("hits")) for k, (p, needs) in GENERATORS.items()]
    rows = written(
        docs.select(F.col(f"`{doc_id}`").alias("doc_id"), whole.alias("text"))
        .select(F.monotonically_increasing_id().alias("row"), "doc_id", F.filter(F.array(*found), lambda x: F.size(x["hits"]) > 0).alias("found")),
        "pii-hits",
    )
    each = rows.select("row", F.explode("found").alias("f")).select("row", "f.kind", "f.base", F.posexplode("f.hits").alias("number", "h")).select("row", "kind", "base", "number", "h.*")
    so_far = Window.partitionBy("row", "kind", "base").orderBy("number")
    length = F.char_length("match")
    placed = (
        each.withColumn("end", F.sum(F.col("gap") + length).over(so_far)).withColumn("start", F.col("end") - length)
        .where(~F.col("base") | _passes(F.col("kind"), F.col("match"))).drop("number", "gap")
    )
    placed = written(placed, "pii-spans")
    base = placed.where("base").select("row", "kind", "start", "end", "base", "match")
    marked = _touching(_touching(placed, "free", "row"), "on_base", "row", "kind").withColumn("free", ~F.col("free"))
    valid = _valid(F.col("kind"), F.col("match"), F.col("before"), F.col("after"))
    candidates = marked.where("not base").drop("base").withColumn("valid", valid)
    candidates, enough = _scored(written(candidates, "pii-candidates"))
    chosen = candidates.where(F.col("free") & F.col("valid") & enough).select("row", "kind", "start", "end", "match", "score")
    best = _apart(chosen)
    added = best.select("row", "kind", "start", "end", F.lit(False).alias("base"), "match")
    return rows.select("row", "doc_id"), base.unionByName(added)


def _listed(spans: Column) -> Column:
    return F.array_join(F.transform(F.array_sort(spans), lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def pii_summary(docs: DataFrame, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """``doc_id``, base counts by kind, ``base_sha256`` of the base spans, and all ``spans`` of every row."""
    rows, spans = find_pii(docs, text, doc_id)
    number = F.lit(0)
    for i, k in enumerate(KINDS):
        number = F.when(F.col("kind") == k, i).otherwise(number)
    span = F.struct(number.alias("number"), "start", "end", "kind")
    counts = [F.count(F.when(F.col("base") & (F.col("kind") == k), 1)).alias(f"n_{k}") for k in KINDS]
    summed = spans.groupBy("row").agg(*counts, F.collect_list(F.when(F.col("base"), span)).alias("base"), F.collect_list(span).alias("all"))
    out = rows.join(summed, "row", "left")
    return out.select(
        "doc_id", *[F.coalesce(f"n_{k}", F.lit(0)).cast("long").alias(f"n_{k}") for k in KINDS],
        F.sha2(F.coalesce(_listed(F.col("base")), F.lit("")), 256).alias("base_sha256"),
        F.coalesce(_listed(F.col("all")), F.lit("")).alias("spans"),
    )

