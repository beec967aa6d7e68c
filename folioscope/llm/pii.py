"""Personal data by rules and boosted candidates, in DataFrame functions alone.

Rules find the base spans of four kinds: email, ip, card, phone. They always stay.

On top, generators of high recall propose further, overlapping spans: written-out addresses,
numbers in groups of any separator, addresses of colons. They propose the formats of the rules as
well. Boosted trees score a candidate by its format and the characters around it, with the mark
stripped that the rule decides by: the plus sign, the ``@``, the separators. So spans that only
lack the mark look like those that have it.

The trees learn from all candidates to tell those that cover a base span of their kind from all
others. Candidates of equal features and label are one row with a weight, their number; a fifth, by a
hash, is held out for the thresholds. The others are not negatives but unlabelled: among
candidates that look alike the trees give the share that has the mark. Where nearly all are
personal data that share is as high as it gets, so per kind it is compared with that of the surest
held-out positives: a candidate is selected from ``PURITY`` of it on. Clear negatives (numbers of a
wrong length or check digit, addresses out of range, what the rules find to be of another kind)
hold the threshold where at least ``PRECISION`` of held-out labelled candidates are positive. Without
``SUPPORT`` held-out positives nothing of the kind is added. An added span touches no base span, nor
an added one before it.

Texts are scanned once, in the row they lie in; what is found is stored, and nothing is
shuffled.

Defined cases: a null text is empty and has no spans. Repeated rows are judged each. Null ids are
passed on. Without candidates, or with those of one class only, nothing is added. An empty table
gives no rows. Positions are code points, ends exclusive. A very long text is scanned in its row, in
time that grows with it. Other columns, of any name, are not read, and pass through ``redact``.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.ml.classification import GBTClassificationModel, GBTClassifier
from pyspark.ml.functions import array_to_vector
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from folioscope.functions.names import fresh
from folioscope.functions.text import bind
from folioscope.llm.arrays import running
from folioscope.llm.storage import store

KINDS = ("email", "ip", "card", "phone")

#: The patterns of the rules. Repetitions are possessive, and a run is entered at
#: its start or where the last match ended, which finds the same matches in linear time.
BASE = {
    "email": r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?:(?<![0-9])|\G)[0-9]++(?:\.[0-9]++)(?:\.[0-9]++)(?:\.[0-9]++)",
    "card": r"[0-9](?:[\x20-]?+[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
#: What a text must hold for a span of the kind to pass its rule.
NEEDS = {
    "email": "@",
    "ip": r"[0-9]\.[0-9]",
    "card": r"[0-9](?:[\x20-]?[0-9]){13}",
    "phone": r"\+[0-9]",
}
#: An at sign and a dot, as they are or written out.
AT, DOT = r"(?:@|\s?[(\[]\s?at\s?[)\]]\s?)", r"(?:\.|\s?[(\[]\s?dot\s?[)\]]\s?)"
LABEL = r"[\p{L}\p{N}-]{1,63}"
#: Candidate generators: kind, what a text must hold, pattern.
GENERATORS = (
    ("email", r"@|[(\[]\s?at\s?[)\]]", rf"[\p{{L}}\p{{N}}._%+-]{{1,64}}{AT}{LABEL}(?:{DOT}{LABEL})+"),
    (
        "ip", r"[0-9]\.[0-9]|[0-9A-Fa-f]:[0-9A-Fa-f:]",
        r"(?<![0-9A-Fa-f:.])(?:[0-9]{1,3}(?:\.[0-9]{1,3}){3}|[0-9A-Fa-f]{1,4}(?::{1,2}[0-9A-Fa-f]{1,4}){2,7})",
    ),
    ("card", r"[0-9]{4}[\x20.-]?[0-9]{4}", r"[0-9]{3,6}(?:[\x20.-]?[0-9]{2,6}){2,6}"),
    ("phone", r"[0-9][\x20().0-9/-]{5}", r"\+?[(]?[0-9][\x20().0-9/-]{5,30}[0-9]"),
)

#: Bounds of the trees. Up to ``SPLIT_ROWS`` rows Spark ML reads all of them to place its splits, and
#: beyond that a sample of the square of the number of bins.
TREES, DEPTH = 20, 3
BINS, SPLIT_ROWS = 32, 10_000
STEP = 0.3
PRECISION, PURITY, SUPPORT = 0.98, 0.9, 30
#: The surest share of held-out positives, which shows how pure candidates get.
SUREST = 0.2
CONTEXT = 24

SPAN = "array<struct<start:int,end:int,match:string,left:string,right:string>>"


def found_spans(text: Column, pattern: str, needs: str) -> Column:
    """Leftmost non-overlapping matches with their places and neighbouring characters."""
    gaps, matches = F.split(text, pattern, -1), F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    pieces = F.zip_with(
        F.slice(gaps, 1, F.size(matches)),
        F.zip_with(matches, F.slice(gaps, 2, F.size(matches) + 1), lambda m, after: F.struct(m.alias("m"), after.alias("after"))),
        lambda gap, rest: F.struct(gap.alias("gap"), rest["m"].alias("m"), rest["after"].alias("after")),
    )

    def placed(found: Column) -> Column:
        sizes = F.transform(found, lambda p: F.char_length(p["gap"]) + F.char_length(p["m"]))
        return bind(running(sizes, F.lit(0), lambda x, y: x + y), lambda ends: F.transform(found, lambda p, i: span(p, F.get(ends, i))))

    def span(piece: Column, at: Column) -> Column:
        start = at + F.char_length(piece["gap"])
        return F.struct(
            start.alias("start"), (start + F.char_length(piece["m"])).alias("end"), piece["m"].alias("match"),
            F.right(piece["gap"], F.lit(CONTEXT)).alias("left"), F.left(piece["after"], F.lit(CONTEXT)).alias("right"),
        )

    spans = bind(pieces, placed)
    return F.when(text.rlike(needs), spans).otherwise(F.array().cast(SPAN))


def _luhn(digits: Column) -> Column:
    backward = F.reverse(digits)

    def add(total: Column, i: Column) -> Column:
        d = F.substr(backward, i, F.lit(1)).cast("int")
        double = F.when(d > 4, 2 * d - 9).otherwise(2 * d)
        return total + F.when(i % 2 == 1, d).otherwise(double)

    return F.aggregate(F.sequence(F.lit(1), F.char_length(digits)), F.lit(0), add) % 10 == 0


def _valid(kind: str, match: Column) -> Column:
    digits = F.regexp_replace(match, "[^0-9]", "")
    n = F.char_length(digits)
    if kind == "ip":
        small = "^0*(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[0-9]{1,2})$"
        return F.forall(F.split(match, "\\."), lambda part: part.rlike(small))
    if kind == "card":
        return n.between(14, 19) & _luhn(digits)
    if kind == "phone":
        return n.between(10, 15)
    return F.lit(True)


def _ends(kind: str, spans: Column) -> Column:
    """Spans as (start, place of the kind in the list, end)."""
    number = KINDS.index(kind)
    return F.transform(spans, lambda s: F.struct(s["start"].alias("start"), F.lit(number).alias("kind"), s["end"].alias("end")))


def _base(kind: str, text: Column) -> Column:
    return _ends(kind, F.filter(found_spans(text, BASE[kind], NEEDS[kind]), lambda s: _valid(kind, s["match"])))


def base_spans(text: Column) -> dict[str, Column]:
    return {kind: _base(kind, text) for kind in KINDS}


#: Words before a candidate, by kind; all lower case.
HINTS = {
    "email": "mail|contact|write|reply",
    "ip": "ip|host|server|address",
    "card": "card|visa|credit|account|konto|carte|tarjeta",
    "phone": "tel|phone|call|fax|mobile|handy|ruf",
}


def _digits(match: Column) -> Column:
    return F.regexp_replace(match, "[^0-9]", "")


def _well_formed(match: Column) -> Column:
    """An address of dots in range, or of eight groups between colons, or fewer with one gap."""
    groups, gaps = F.size(F.split(match, ":+")), F.size(F.split(match, "::")) - 1
    colons = ((gaps == 0) & (groups == 8)) | ((gaps == 1) & (groups < 8))
    return F.when(F.contains(match, F.lit(":")), colons).otherwise(_valid("ip", match))


def _format(kind: str, match: Column) -> list[Column]:
    """Numbers on the format without the mark that the rule of the kind decides by."""
    if kind == "email":
        plain = F.regexp_replace(F.regexp_replace(match, AT, "@"), DOT, ".")
        domain = F.split(F.element_at(F.split(plain, "@"), -1), "\\.")
        local = F.element_at(F.split(plain, "@"), 1)
        return [F.char_length(local), F.size(domain), F.char_length(F.element_at(domain, -1)), local.rlike("[0-9]")]
    if kind == "ip":
        return [_well_formed(match)]
    groups = F.filter(F.split(match, "[^0-9]+"), lambda g: g != "")
    sizes = F.transform(groups, F.char_length)
    found = [F.char_length(_digits(match)), F.size(groups), F.array_max(sizes), F.array_min(sizes)]
    if kind == "card":
        return [*found, _luhn(_digits(match))]
    spaces, hyphens, parens, slashes = (F.char_length(F.regexp_replace(match, f"[^{c}]", "")) for c in (" ", "-", "()", "/."))
    return [*found, spaces, hyphens, parens, slashes]


#: Numbers on the format that any kind has at most.
FORMATS = 8


def _features(kind: str, s: Column) -> list[Column]:
    """Format and context of a candidate."""
    left, right = F.lower(s["left"]), s["right"]
    numbers = _format(kind, s["match"])
    numbers += [F.lit(0)] * (FORMATS - len(numbers)) + [F.lit(KINDS.index(kind))]
    hints = [left.rlike(f"(?:{HINTS[k]})[^a-z0-9]*$") for k in KINDS]
    flags = [
        left.rlike("[a-z]$"), left.rlike("[0-9]$"), left.rlike("[\\s]$"), left.rlike("[$€£#=/.:-]\\s?$"),
        right.rlike("^[A-Za-z]"), right.rlike("^[0-9]"), right.rlike("^\\s"), right.rlike("^[%€$/:=-]"),
    ]
    return [F.coalesce(c.cast("double"), F.lit(0.0)) for c in [*numbers, *hints, *flags]]


def _cannot_be(kind: str, match: Column) -> Column:
    """Evidence against a candidate that needs no mark of the rule."""
    n = F.char_length(_digits(match))
    if kind == "card":
        return ~n.between(14, 19) | ~_luhn(_digits(match))
    if kind == "phone":
        return ~n.between(10, 15)
    return ~_well_formed(match) if kind == "ip" else F.lit(False)


def _overlap(a: Column, b: Column) -> Column:
    return (a["start"] < b["end"]) & (b["start"] < a["end"])


def _generated(kind: str, needs: str, pattern: str, text: Column, base: Column) -> Column:
    number = KINDS.index(kind)

    def candidate(s: Column) -> Column:
        return F.struct(
            s["start"].alias("start"),
            F.lit(number).alias("kind"),
            s["end"].alias("end"),
            F.array(*_features(kind, s)).alias("features"),
            F.when(F.exists(base, lambda b: (b["kind"] == number) & _overlap(b, s)), 1)
            .when(F.exists(base, lambda b: _overlap(b, s)) | _cannot_be(kind, s["match"]), -1)
            .otherwise(0)
            .alias("label"),
        )

    return F.transform(found_spans(text, pattern, needs), candidate)


def _candidates(text: Column, base: Column) -> Column:
    """All candidates, with features and a label: 1 if they cover a base span of their kind, -1 if
    they can't be of it, 0 otherwise."""
    return F.concat(*[_generated(*generator, text, base) for generator in GENERATORS])


@dataclass
class Selector:
    """Boosted trees as an expression of a feature array, and a threshold for each kind."""

    model: GBTClassificationModel | None
    thresholds: dict[int, float]

    def score(self, features: Column) -> Column:
        total = F.lit(0.0)
        for tree, weight in zip(self.model.trees, self.model.treeWeights):
            total = total + F.lit(weight) * self._branch(tree._java_obj.rootNode(), features)
        return total

    def _branch(self, node, features: Column) -> Column:
        if not node.subtreeDepth():
            return F.lit(node.prediction())
        split = node.split()
        left, right = self._branch(node.leftChild(), features), self._branch(node.rightChild(), features)
        return F.when(features[split.featureIndex()] <= split.threshold(), left).otherwise(right)

    def selects(self, candidate: Column) -> Column:
        if not self.thresholds:
            return F.lit(False)
        chosen = F.lit(False)
        for kind, threshold in self.thresholds.items():
            chosen = chosen | ((candidate["kind"] == kind) & (candidate["score"] >= threshold))
        return chosen


def fit_selector(scanned: DataFrame, precision: float = PRECISION, support: int = SUPPORT) -> Selector:
    """Learn from all candidates of ``scanned`` (``doc``, ``candidates``)."""
    place = F.xxhash64("doc", "c.start", "c.kind")
    rows = scanned.select("doc", F.explode("candidates").alias("c"))
    rows = rows.select("c.kind", "c.features", "c.label", (F.pmod(place, F.lit(5)) == 0).alias("held"))
    groups = store(rows.groupBy("kind", "features", "label", "held").agg(F.count("*").alias("n")))
    train = groups.where(~F.col("held")).select(
        array_to_vector("features").alias("vector"), (F.col("label") == 1).cast("double").alias("marked"), F.col("n").cast("double").alias("n")
    )
    marks = train.groupBy("marked").agg(F.count("*").alias("rows")).collect()
    if len(marks) < 2:
        return Selector(None, {})
    distinct = sum(r.rows for r in marks)
    # so many bins that splits are placed by all rows; a feature has as many as it has values at most
    bins = BINS if distinct <= SPLIT_ROWS else math.ceil(math.sqrt(distinct))
    trees = GBTClassifier(featuresCol="vector", labelCol="marked", weightCol="n", maxIter=TREES, maxDepth=DEPTH, maxBins=bins, stepSize=STEP, seed=1)
    model = trees.fit(train)
    selector = Selector(model, {})
    scored = groups.where("held").select("kind", "label", F.round(selector.score(F.col("features")), 2).alias("score"), "n")
    steps = scored.groupBy("kind", "label", "score").agg(F.sum("n").alias("n")).collect()
    for kind in range(len(KINDS)):
        found = threshold([(r.score, r.label, r.n) for r in steps if r.kind == kind], precision, support)
        if found is not None:
            selector.thresholds[kind] = found
    return selector


def threshold(steps: list[tuple[float, int, int]], precision: float = PRECISION, support: int = SUPPORT) -> float | None:
    """The lowest score to select from, out of held-out ``(score, label, number)``."""
    positives = sum(n for _, label, n in steps if label == 1)
    if positives < support:
        return None
    hits = against = 0
    surest = lowest = None
    for score in sorted({s for s, _, _ in steps}, reverse=True):
        hits += sum(n for s, label, n in steps if s == score and label == 1)
        against += sum(n for s, label, n in steps if s == score and label == -1)
        if surest is None and hits >= SUREST * positives:
            surest = score
        if hits >= support and hits >= precision * (hits + against):
            lowest = score
    if lowest is None:
        return None
    # the score at which the share of marked candidates is that part of the surest one's
    share = PURITY / (1 + math.exp(-2 * surest))
    return max(lowest, 0.5 * math.log(share / (1 - share))) - 0.005


def _text_of(spans: Column) -> Column:
    names = F.array(*map(F.lit, KINDS))
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", names[s["kind"]], s["start"], s["end"])), ",")


def find_personal_data(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Per row: id, counts of base spans, ``base`` and ``spans`` as arrays of (start, kind, end)."""
    narrow = docs.select(F.col(doc_id).alias("doc"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    scanned = narrow.select("doc", "text", *[column.alias(kind) for kind, column in base_spans(F.col("text")).items()])
    scanned = scanned.withColumn("base", F.array_sort(F.concat(*KINDS)))
    scanned = scanned.select("doc", *[F.size(k).cast("long").alias(f"n_{k}") for k in KINDS], "base", _candidates(F.col("text"), F.col("base")).alias("candidates"))
    scanned = store(scanned)
    selector = fit_selector(scanned)
    added = F.array().cast("array<struct<start:int,kind:int,end:int>>")
    if selector.model is not None and selector.thresholds:
        untouched = F.filter("candidates", lambda c: ~F.exists("base", lambda b: _overlap(b, c)))
        scored = F.transform(
            untouched,
            lambda c: F.struct(c["start"].alias("start"), c["kind"].alias("kind"), c["end"].alias("end"), selector.score(c["features"]).alias("score")),
        )
        chosen = F.array_sort(F.filter(scored, selector.selects))
        added = F.aggregate(
            chosen,
            added,
            lambda kept, c: F.when(
                F.exists(kept, lambda k: _overlap(k, c)), kept
            ).otherwise(F.concat(kept, F.array(F.struct(c["start"].alias("start"), c["kind"].alias("kind"), c["end"].alias("end"))))),
        )
    return scanned.select(
        F.col("doc").alias(doc_id), *[f"n_{k}" for k in KINDS], "base", F.array_sort(F.concat("base", added)).alias("spans")
    )


def with_digests(found: DataFrame) -> DataFrame:
    """``base_sha256`` and ``spans`` as text in place of the arrays."""
    return found.withColumn("base_sha256", F.sha2(_text_of(F.col("base")), 256)).withColumn("spans", _text_of(F.col("spans"))).drop("base")


def redact(docs: DataFrame, found: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``docs`` with every found span replaced by its kind in brackets; ids must be unique."""
    names = F.array(*map(F.lit, KINDS))
    of, own = fresh("_of", docs), fresh("_spans", docs)
    merged = docs.join(found.select(F.col(doc_id).alias(of), F.col("spans").alias(own)), F.col(doc_id).eqNullSafe(F.col(of)), "left")

    def step(state: Column, s: Column) -> Column:
        skip = s["start"] < state["at"]
        before = F.substr(F.col(text), state["at"] + 1, s["start"] - state["at"])
        out = F.when(skip, state["out"]).otherwise(F.concat(state["out"], before, F.lit("["), names[s["kind"]], F.lit("]")))
        return F.struct(F.greatest(state["at"], s["end"]).alias("at"), out.alias("out"))

    zero = F.struct(F.lit(0).alias("at"), F.lit("").alias("out"))
    clean = F.aggregate(F.coalesce(own, F.array().cast("array<struct<start:int,kind:int,end:int>>")), zero, step)
    tail = F.substr(F.col(text), clean["at"] + 1)
    return merged.select(*[F.concat(clean["out"], tail).alias(text) if c == text else F.col(c) for c in docs.columns])
