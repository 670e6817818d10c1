"""Personal data by weak supervision, with DataFrame and SQL functions only.

Labelers vote on candidate spans, expectation-maximisation estimates how reliable each of them is per kind of data, and
a classifier trained on the resulting soft labels decides which spans are added to those of the base rules.
"""

from __future__ import annotations

from functools import reduce

from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import Column, DataFrame, functions as F

from ledgerline.llm.common import cut, row_key, text_of

KINDS = ["email", "ip", "card", "phone"]

#: The base patterns, written so that Java's matcher neither recurses nor scans a run of characters again for each
#: start in it: possessive repeats, and starts only at a run's beginning or where the last match ended.
BASE = {
    "email": r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}

#: Looser forms that only the method may accept: spelled-out addresses, version 6 addresses, cards with other
#: separators, national phone numbers.
LOOSE = {
    "email": r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]{1,64}+ ?[\[(](?:at|AT)[\])] ?[A-Za-z0-9-]++(?: ?(?:\.|[\[(](?:dot|DOT)[\])]) ?[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9A-Fa-f:])(?:[0-9A-Fa-f]{1,4}:){7}[0-9A-Fa-f]{1,4}(?![0-9A-Fa-f:])",
    "card": r"(?<![0-9./_])[0-9]{4}([./_])[0-9]{4}\1[0-9]{4}\1[0-9]{4}(?![0-9./_])",
    "phone": r"(?<![0-9+(-])(?:\([2-9][0-9]{2}\) ?|[2-9][0-9]{2}[ .-])[0-9]{3}[ .-][0-9]{4}(?![0-9.-])",
}

#: What a text must hold for a pattern to be tried: one of these strings, or a digit and a match of this pattern.
NEEDED_STRINGS = {"base_email": ["@"], "loose_email": ["(at)", "[at]", "(AT)", "[AT]"], "base_phone": ["+"], "loose_ip": [":"]}
NEEDED_DIGITS = {"base_ip": r"[0-9]\.[0-9]", "base_card": r"[0-9][\x20-]?[0-9]", "loose_card": r"[0-9]{4}[./_][0-9]{4}", "loose_phone": r"[0-9]{3}[ .-][0-9]{4}"}

#: Cue words, fixed values of the context labeler: for each kind, and those that speak against every kind.
CUES = {"email": "mail|contact|write to", "ip": "ip|host|server|address", "card": "card|visa|credit|payment", "phone": "phone|tel|call|mobile|fax"}
COUNTER_CUES = "token|version|hash|isbn|order|invoice|serial"

#: Fixed values of the gazetteer labeler: top-level domains, country calling codes, card issuer digits, address blocks
#: that belong to no one.
DOMAINS = "com|org|net|edu|gov|info|io|de|fr|es|uk|it|nl|eu|ch|at|be|us|ca|mx|br|ar"
CALLING = "1|7|20|27|3[0-469]|4[013-9]|5[1-8]|6[0-6]|8[1246]|9[0-58]"
ISSUERS = "4|5[1-5]|2[2-7]|3[47]|6011|65"
NO_ONE = r"^(?:0|127|255)\."

LABELERS = ["shape", "gazetteer", "context", "edges", "layout"]

#: Rounds of expectation-maximisation, and the classifier's probability from which a span is added.
ROUNDS = 8
ACCEPT = 0.9

_MARK, _OTHER = "\uE000", "\uE001"
_BLOCK = 256


def running(lengths: Column) -> Column:
    """Sums before each element, in blocks, so that long arrays are not copied for every element."""
    at = lambda b: F.slice(lengths, b * _BLOCK + 1, F.lit(_BLOCK))
    append = lambda a, x: F.concat(a, F.array(F.element_at(a, -1) + x))
    blocks = F.sequence(F.lit(0), F.floor((F.size(lengths) - 1) / _BLOCK).cast("int"))
    sums = F.transform(blocks, lambda b: F.aggregate(at(b), F.lit(0), lambda a, x: a + x))
    bases = F.aggregate(sums, F.array(F.lit(0)), append)
    return F.flatten(F.transform(blocks, lambda b: F.slice(F.aggregate(at(b), F.array(F.get(bases, b)), append), 1, _BLOCK)))


def spans(df: DataFrame, name: str, text: str, pattern: str, worth: Column) -> DataFrame:
    """Adds array ``name`` of structs (start, end, match, before, after) for the leftmost non-overlapping matches.

    Rows that are not ``worth`` a try, because they can have no match, get none.
    Matches are fenced with a private-use character, which the text is first cleared of, and the text is split at
    the fences; lengths are in code points.
    """
    fenced = F.regexp_replace(F.translate(F.col(text), _MARK, _OTHER), pattern, f"{_MARK}$0{_MARK}")
    parts = F.when(worth, F.split(fenced, _MARK, -1)).otherwise(F.array(F.lit("")))
    cutted = df.withColumn("__parts", parts).withColumn("__lengths", F.transform("__parts", F.length))
    placed = cutted.withColumn("__starts", F.when(F.size("__parts") > 1, running(F.col("__lengths"))))
    found = F.transform(
        F.when(F.size("__parts") > 1, F.sequence(F.lit(1), F.size("__parts") - 2, F.lit(2))).otherwise(F.array().cast("array<int>")),
        lambda i: F.struct(
            F.get("__starts", i).alias("start"),
            (F.get("__starts", i) + F.get("__lengths", i)).alias("end"),
            F.get("__parts", i).alias("match"),
            F.right(F.get("__parts", i - 1), F.lit(32)).alias("before"),
            F.left(F.get("__parts", i + 1), F.lit(8)).alias("after"),
        ),
    )
    return placed.withColumn(name, found).drop("__parts", "__lengths", "__starts")


def digits(match: Column) -> Column:
    return F.regexp_replace(match, "[^0-9]", "")


def luhn(number: Column) -> Column:
    """Whether the checksum of a digit string holds."""
    backwards = F.reverse(number)

    def add(total, i):
        d = F.substr(backwards, i + 1, F.lit(1)).cast("int")
        return total + F.when(i % 2 == 1, 2 * d - F.when(d > 4, 9).otherwise(0)).otherwise(d)

    return F.aggregate(F.sequence(F.lit(0), F.length(number) - 1), F.lit(0), add) % 10 == 0


_PART = r"0*+(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[0-9]{0,2})"


def holds(kind: str, match: Column) -> Column:
    """The check that a match of the base pattern must pass."""
    if kind == "ip":
        return match.rlike(rf"^{_PART}\.{_PART}\.{_PART}\.{_PART}$")
    if kind == "card":
        return F.when(F.length(digits(match)).between(16, 19), luhn(digits(match))).otherwise(F.lit(False))
    if kind == "phone":
        return F.length(digits(match)).between(8, 15)
    return F.lit(True)


def checked(kind: str):
    return lambda s: holds(kind, s["match"])


def worth_a_try(name: str) -> Column:
    if name in NEEDED_STRINGS:
        return reduce(lambda a, b: a | b, [F.contains("__text", F.lit(x)) for x in NEEDED_STRINGS[name]])
    return F.col("__digit") & F.col("__text").rlike(NEEDED_DIGITS[name])


def apart(span: Column) -> Column:
    """Whether a span overlaps no base span of its row."""
    hits = [F.exists(f"base_{k}", lambda t: (t["start"] < span["end"]) & (span["start"] < t["end"])) for k in KINDS]
    return ~reduce(lambda a, b: a | b, hits)


def candidates_by_row(docs: DataFrame) -> DataFrame:
    """(doc_id, row_key, base_<kind>, failed_<kind>, loose_<kind>): one scan of the texts, one row per input row.

    Loose matches that overlap a base span are left out.
    """
    out = docs.select("doc_id", row_key(docs).alias("row_key"), text_of(docs).alias("__text")).withColumn("__digit", F.col("__text").rlike("[0-9]"))
    for kind in KINDS:
        right = checked(kind)
        out = spans(out, "__all", "__text", BASE[kind], worth_a_try(f"base_{kind}"))
        out = out.withColumn(f"base_{kind}", F.filter("__all", right))
        out = out.withColumn(f"failed_{kind}", F.filter("__all", lambda s: ~right(s))).drop("__all")
    for kind in KINDS:
        out = spans(out, f"__loose_{kind}", "__text", LOOSE[kind], worth_a_try(f"loose_{kind}"))
    out = out.drop("__text", "__digit")
    for kind in KINDS:
        out = out.withColumn(f"loose_{kind}", F.filter(f"__loose_{kind}", apart)).drop(f"__loose_{kind}")
    return out


def votes(kind: Column) -> dict[str, Column]:
    """Each labeler's vote on a candidate: 1 for, -1 against, 0 for neither."""
    match, number = F.col("match"), digits(F.col("match"))
    context = F.lower(F.concat("before", F.lit(" "), "after"))

    def by_kind(**rules: Column) -> Column:
        return reduce(lambda c, k: c.when(kind == k, rules[k]), KINDS[1:], F.when(kind == KINDS[0], rules[KINDS[0]]))

    def sign(condition: Column, otherwise: int = -1) -> Column:
        return F.when(condition, 1).otherwise(otherwise)

    cue = by_kind(**{k: context.rlike(rf"\b(?:{w})") for k, w in CUES.items()})
    return {
        "shape": sign(F.col("form") != "failed"),
        "gazetteer": by_kind(
            email=sign(F.lower(match).rlike(rf"\b(?:{DOMAINS})$")),
            ip=F.when(match.rlike(NO_ONE), -1).otherwise(0),
            card=sign(number.rlike(f"^(?:{ISSUERS})")),
            phone=F.when(~match.startswith("+"), 0).otherwise(sign(number.rlike(f"^(?:{CALLING})"))),
        ),
        "context": F.when(context.rlike(rf"\b(?:{COUNTER_CUES})"), -1).when(cue, 1).otherwise(0),
        "edges": sign(~F.col("before").rlike(r"[\p{L}0-9\"'=_/#-]$") & ~F.col("after").rlike(r"^[\p{L}0-9\"'=_/@]")),
        "layout": by_kind(
            email=sign(match.rlike("^[^@]*[A-Za-z]")),
            ip=sign(~match.rlike(r"(?:^|\.)0[0-9]")),
            card=sign(match.rlike(r"^(?:[0-9]{16,19}|[0-9]{4}(?:[ ./_-][0-9]{4}){3}(?:[ -]?[0-9]{1,3})?)$")),
            phone=sign(match.rlike(r"[0-9)][ .-]\(?[0-9]")),
        ),
    }


def exploded(rows: DataFrame) -> DataFrame:
    """(doc_id, row_key, kind, form, start, end, match, before, after, votes): one row per candidate."""
    def named(kind: str, form: str) -> Column:
        return F.transform(f"{form}_{kind}", lambda s: F.struct(F.lit(kind).alias("kind"), F.lit(form).alias("form"), s.alias("s")))

    every = F.flatten(F.array(*[named(kind, form) for kind in KINDS for form in ("base", "failed", "loose")]))
    flat = rows.select("doc_id", "row_key", F.explode(every).alias("c")).select("doc_id", "row_key", "c.kind", "c.form", "c.s.*")
    return flat.withColumns({f"v_{name}": vote.cast("int") for name, vote in votes(F.col("kind")).items()})


PATTERN = ["kind", *[f"v_{n}" for n in LABELERS]]


def reliabilities(patterns: DataFrame, rounds: int = ROUNDS) -> DataFrame:
    """Vote patterns (PATTERN, n) with ``p``, the estimated share of personal data among them.

    Labelers are taken as independent given the truth. From each kind's patterns, a round sums how often each labeler
    gives each vote to true and to false candidates and weighs the votes anew. There are at most 3^5 patterns a kind,
    whatever the number of candidates.
    """
    majority = sum((F.col(f"v_{n}") for n in LABELERS), F.lit(0)).cast("double")
    current = patterns.withColumn("p", 1 / (1 + F.exp(-majority)))
    for _ in range(rounds):
        sums = []
        for y, share in ((1, F.col("n") * F.col("p")), (0, F.col("n") * (1 - F.col("p")))):
            sums.append(F.sum(share).alias(f"t{y}"))
            sums += [F.sum(F.when(F.col(f"v_{n}") == v, share).otherwise(0.0)).alias(f"s_{n}_{v + 1}_{y}") for n in LABELERS for v in (-1, 0, 1)]
        learned = current.groupBy("kind").agg(*sums)
        odds = F.log((F.col("t1") + 1) / (F.col("t0") + 1))
        for n in LABELERS:
            for v in (-1, 0, 1):
                given = [(F.col(f"s_{n}_{v + 1}_{y}") + 1) / (F.col(f"t{y}") + 3) for y in (1, 0)]
                odds = odds + F.when(F.col(f"v_{n}") == v, F.log(given[0] / given[1])).otherwise(0.0)
        current = patterns.join(learned, "kind").select(*patterns.columns, (1 / (1 + F.exp(-odds))).alias("p"))
    return current


def _features() -> dict[str, Column]:
    out = {}
    for kind in KINDS:
        own = F.when(F.col("kind") == kind, 1.0).otherwise(0.0)
        out[f"f_{kind}"] = own
        out |= {f"f_{kind}_{n}": own * F.col(f"v_{n}") for n in LABELERS}
    return out


def span_classifier(weighted: DataFrame) -> Column | None:
    """Probability of a candidate by its votes and kind, from a logistic regression on the soft labels; None without any.

    It is trained on patterns with their weights, so on a bounded number of rows that stand for all candidates.
    """
    labels = F.explode(F.array(
        F.struct(F.lit(1.0).alias("label"), (F.col("n") * F.col("p")).alias("weight")),
        F.struct(F.lit(0.0).alias("label"), (F.col("n") * (1 - F.col("p"))).alias("weight")),
    ))
    rows = weighted.withColumn("l", labels).select(*PATTERN, "l.*").where("weight > 0").withColumns(_features())
    if rows.isEmpty():
        return None
    names = list(_features())
    train = VectorAssembler(inputCols=names, outputCol="features").transform(rows).select("features", "label", "weight")
    model = LogisticRegression(weightCol="weight", maxIter=50, regParam=1e-3).fit(train)
    terms = [F.lit(float(c)) * f for c, f in zip(model.coefficients, _features().values())]
    return 1 / (1 + F.exp(-(sum(terms, F.lit(float(model.intercept))))))


def find(docs: DataFrame, accept: float = ACCEPT) -> DataFrame:
    """(doc_id, row_key, base, added), one row per input row: arrays of structs (kind, start, end) in order of kind and start.

    ``base`` holds the matches of the base patterns that pass their checks, all of them; ``added`` the loose candidates that
    the classifier accepts and that overlap no base span. Positions are code points, the end exclusive. Null and
    empty texts have no spans; equal rows get equal spans; a table without candidates trains nothing and adds nothing;
    an empty table gives an empty table. Only doc_id and text are read.
    """
    rows = cut(candidates_by_row(docs))
    flat = exploded(rows)
    patterns = cut(flat.groupBy(*PATTERN).agg(F.count("*").cast("double").alias("n")))
    probability = span_classifier(cut(reliabilities(patterns)))
    numbered = {k: n for n, k in enumerate(KINDS)}

    def plain(array: str, kind: str) -> Column:
        return F.transform(array, lambda s: F.struct(F.lit(numbered[kind]).alias("order"), s["start"].alias("start"), s["end"].alias("end")))

    base = F.flatten(F.array(*[plain(f"base_{k}", k) for k in KINDS]))
    if probability is None:
        return rows.select("doc_id", "row_key", base.alias("base"), F.filter(base, lambda s: F.lit(False)).alias("added"))
    judged = flat.where("form = 'loose'").where(probability >= accept)
    order = reduce(lambda c, k: c.when(F.col("kind") == k, numbered[k]), KINDS[1:], F.when(F.col("kind") == KINDS[0], 0))
    more = judged.groupBy("doc_id", "row_key").agg(F.sort_array(F.collect_set(F.struct(order.alias("order"), "start", "end"))).alias("added"))
    keyed = more.withColumnRenamed("doc_id", "_id").withColumnRenamed("row_key", "_key")
    joined = rows.join(keyed, rows["doc_id"].eqNullSafe(keyed["_id"]) & (rows["row_key"] == keyed["_key"]), "left")
    return joined.select("doc_id", "row_key", base.alias("base"), F.coalesce("added", F.filter(base, lambda s: F.lit(False))).alias("added"))


def count_of(array: str, kind: str) -> Column:
    return F.size(F.filter(array, lambda s: s["order"] == KINDS.index(kind))).cast("long")


def listed(array: Column) -> Column:
    """kind:start:end of each span, comma-joined."""
    names = F.array(*map(F.lit, KINDS))
    return F.array_join(F.transform(array, lambda s: F.concat_ws(":", F.get(names, s["order"]), s["start"], s["end"])), ",")
