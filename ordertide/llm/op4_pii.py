"""Operator 4: personal data by weak supervision, in DataFrame functions only.

1. *Candidates.*  Four base kinds (email, ip, card, phone) and four loose ones
   (national phone numbers, social security numbers, IBANs, spelt-out emails)
   are found in the whole text: the text is split at a kind's matches, and a
   running sum over the pieces gives every match its place in code points.
2. *Labelers* vote yes, no or nothing on every candidate: a format regex, a
   checksum, gazetteers of trigger words and of words that mark other numbers,
   the character context and neighbouring personal data.
3. *Expectation-maximisation* (one hidden class, labelers independent given
   it) estimates every labeler's reliability from the counts of vote patterns,
   at most 3^6 rows, and so every candidate's odds of being personal data.
4. *Span classifier.*  Those odds train a naive Bayes classifier over features
   that are not votes alone (kind, digits, separators, neighbouring words in
   256 hashed slots); its log-odds, at most ``MAX_FEATURES`` numbers, decide
   on the loose candidates.  Base spans always stay.

The driver only sees the vote patterns and the feature sums; both are bounded.

Defined results: a null or empty text has no span; repeated rows are handled
separately; an empty table gives an empty result; a text of any length is
searched whole; spans added by the method never overlap base spans.
"""

from __future__ import annotations

import math
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ordertide.llm import common as C

# Patterns of the kinds, in their order of report.  Base kinds
# match as the plain patterns in the comments do, leftmost and non-overlapping;
# lookbehinds and possessive repeats only avoid futile starts and backtracking.
PATTERNS = {
    # [A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    # [0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)
    "ip": r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    # [0-9]([\x20-]?[0-9])+ of 14 to 19 digits: a longest run of digits with single separators
    "card": r"(?<![0-9])(?<![0-9][\x20-])[0-9](?:[\x20-]?[0-9]){13,18}(?![\x20-]?[0-9])",
    # \+[0-9][\x20().0-9-]+[0-9]
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
    "phone_national": r"(?<![0-9A-Za-z+.-])(?:\([0-9]{3}\)\x20?|[0-9]{3}[\x20.-])[0-9]{3}[\x20.-][0-9]{4}(?![0-9A-Za-z])",
    "ssn": r"(?<![0-9A-Za-z-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9A-Za-z-])",
    "iban": r"(?<![0-9A-Za-z])[A-Z]{2}[0-9]{2}(?:\x20?[A-Z0-9]{4}){2,7}(?:\x20?[A-Z0-9]{1,3})?(?![0-9A-Za-z])",
    "email_spelt": r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]{2,40}\x20?[\[(]\x20?at\x20?[\])]\x20?[A-Za-z0-9-]{2,40}"
    r"(?:\x20?(?:[\[(]\x20?dot\x20?[\])]|\.)\x20?[A-Za-z0-9-]{2,20})+",
}
BASE = ("email", "ip", "card", "phone")
# A cheap sign without which a text can't hold the kind.
SIGNS = {"email": "@", "ip": ".", "phone": "+", "ssn": "-", "email_spelt": "at"}
# Gazetteers.
TRIGGERS = (
    "phone|tel|telephone|call|cell|mobile|fax|email|e-mail|mail|contact|write|reach|card|visa|mastercard|credit|payment|account|iban|bank|ssn|"
    "social security|ip|address|host|server|login|name|born|telefon|handy|konto|kontakt|karte|adresse|téléphone|courriel|carte|compte|"
    "teléfono|móvil|correo|tarjeta|cuenta|dirección"
)
OTHER_NUMBERS = (
    "version|release|v|ver|page|pages|chapter|section|isbn|issn|doi|order|invoice|serial|model|part|price|usd|eur|figure|table|line|cc|"
    "license|kapitel|seite|preis|prix|precio|página|rev"
)
TOP_DOMAINS = "com|org|net|edu|gov|info|io|de|fr|es|uk|eu|it|nl|ch|at|be|us|ca|biz|me|co"

CONTEXT = 48  # code points of context on either side
LABELERS = ("format", "checksum", "trigger", "other", "place", "neighbour")
SLOTS = 256
MAX_FEATURES = len(PATTERNS) * 4 * 8 + 3 * SLOTS
EM_ROUNDS = 40


def _found(kind: str, text: Column) -> Column:
    """Array of (kind, at, gap, match, before, after) for a kind's matches."""
    pattern = PATTERNS[kind]
    matches = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))

    def placed(ms: Column) -> Column:
        pieces = F.split(text, pattern, -1)

        def one(ps: Column) -> Column:
            return F.transform(
                ms,
                lambda m, i: F.struct(
                    F.lit(kind).alias("kind"),
                    i.alias("at"),
                    F.char_length(F.get(ps, i)).alias("gap"),
                    m.alias("match"),
                    F.right(F.get(ps, i), F.lit(CONTEXT)).alias("before"),
                    F.left(F.get(ps, i + 1), F.lit(CONTEXT)).alias("after"),
                ),
            )

        return F.when(F.size(ms) > 0, F.element_at(F.transform(F.array(pieces), one), 1))

    hits = F.element_at(F.transform(F.array(matches), placed), 1)
    sign = SIGNS.get(kind)
    return F.when(text.contains(sign), hits) if sign else hits


def candidates(docs: DataFrame) -> DataFrame:
    """One row per candidate span, and one without a kind for every document
    that has none: row (a number per document), doc_id, kind, start, end,
    match, before, after."""
    rows = docs.select(F.monotonically_increasing_id().alias("row"), "doc_id", F.coalesce("text", F.lit("")).alias("text"))
    none = F.array().cast("array<struct<kind:string,at:int,gap:int,match:string,before:string,after:string>>")
    every = F.concat(*[F.coalesce(_found(k, F.col("text")), none) for k in PATTERNS])
    hits = rows.select("row", "doc_id", F.explode_outer(every).alias("hit")).select("row", "doc_id", "hit.*")
    # One narrow shuffle: a document's matches, never its text.
    run = Window.partitionBy("row", "kind").orderBy("at").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    end = F.sum(F.col("gap") + F.char_length("match")).over(run)
    hits = hits.repartition("row").withColumn("end", end)
    return hits.select("row", "doc_id", "kind", (F.col("end") - F.char_length("match")).alias("start"), "end", "match", "before", "after")


def _digits(match: Column) -> Column:
    return F.regexp_replace(match, "[^0-9]", "")


def _iban_ok(match: Column) -> Column:
    """ISO 13616 check: moved and spelt in digits, the number is 1 mod 97."""
    plain = F.regexp_replace(match, " ", "")
    moved = F.concat(F.substring(plain, 5, 64), F.substring(plain, 1, 4))
    spelt = F.transform(F.split(moved, ""), lambda c: F.when(c.rlike("[A-Z]"), (F.ascii(c) - 55).cast("string")).otherwise(c))
    digits = F.split(F.array_join(spelt, ""), "")
    rest = F.aggregate(digits, F.lit(0), lambda a, d: ((a * 10 + F.coalesce(d.try_cast("int"), F.lit(0))) % 97).cast("int"))
    return rest == 1


def valid_base(kind: Column, match: Column) -> Column:
    """Whether a base match passes its kind's rule."""
    parts = F.transform(F.split(match, r"\."), lambda p: F.regexp_replace(p, "^0+(?=[0-9])", ""))
    small = F.forall(parts, lambda p: (F.length(p) <= 3) & (F.coalesce(p.try_cast("int"), F.lit(999)) <= 255))
    n = F.length(_digits(match))
    return (
        F.when(kind == "email", F.lit(True))
        .when(kind == "ip", small)
        .when(kind == "card", F.call_function("luhn_check", _digits(match)) & n.between(14, 19))
        .when(kind == "phone", n.between(10, 15))
        .otherwise(F.lit(False))
    )


def votes(spans: DataFrame) -> DataFrame:
    """``spans`` with ``base`` and one column per labeler: 1, 0 or null."""
    kind, match, before, after = (F.col(c) for c in ("kind", "match", "before", "after"))
    digits = _digits(match)

    def when_kind(cases: dict[str, Column]) -> Column:
        return F.coalesce(*[F.when(kind == k, v.cast("int")) for k, v in cases.items()])

    local = F.regexp_extract(match, r"^(.*?)[\x20@\[(]", 1)
    email_form = match.rlike(rf"(?i)[a-z0-9]\.({TOP_DOMAINS})$|dot\x20?[\])]\x20?({TOP_DOMAINS})$") & ~local.rlike(r"^\.|\.$|\.\.")
    ssn_form = ~match.rlike(r"^(000|666|9)|-00-|-0000$")
    phone_form = match.rlike(r"^\+[0-9]{1,3}[\x20(.-]*[0-9(][\x20().0-9-]+$") & ~match.rlike(r"[\x20().-]{4,}")
    national_form = match.rlike(r"^\(?[2-9]")
    return spans.select(
        "*",
        (F.col("kind").isin(*BASE) & valid_base(kind, match)).alias("base"),
        when_kind(
            {
                "email": email_form,
                "email_spelt": email_form,
                "ip": ~match.rlike(r"(^|\.)0[0-9]") & valid_base(kind, match),
                "card": match.rlike(r"^[0-9]+$|^([0-9]{4}[\x20-]){3}[0-9]{2,7}$|^[0-9]{4}[\x20-][0-9]{6}[\x20-][0-9]{4,5}$"),
                "phone": phone_form,
                "phone_national": national_form,
                "ssn": ssn_form,
                "iban": F.length(F.regexp_replace(match, " ", "")).between(15, 34),
            }
        ).alias("format"),
        when_kind({"card": F.call_function("luhn_check", digits), "iban": _iban_ok(match), "ip": valid_base(kind, match), "phone": F.length(digits).between(10, 15)}).alias(
            "checksum"
        ),
        F.when(before.rlike(rf"(?iu)(?<!\pL)({TRIGGERS})[:.#]?(\x20\pL+)?\x20?[:=(]?\x20?$"), 1).alias("trigger"),
        F.when(before.rlike(rf"(?iu)(?<!\pL)({OTHER_NUMBERS})[:.#]?\x20?$") | before.rlike(r"[$€£#§=/_]\x20?$") | after.rlike(r"^\x20?(%|€|kg\b|km\b|mm\b|cm\b|/)"), 0).alias(
            "other"
        ),
        F.when(before.rlike(r"(^|[\s(,;:\"'<])$") & after.rlike(r"^($|[\s),;:.!?\"'>])"), 1).when(before.rlike(r"[0-9A-Za-z_.-]$") | after.rlike("^[0-9A-Za-z_-]"), 0).alias(
            "place"
        ),
        F.when(F.concat_ws(" ", before, after).rlike(r"[A-Za-z0-9]@[A-Za-z0-9]|\+[0-9][0-9 (]|[0-9]{3}-[0-9]{4}"), 1).alias("neighbour"),
    )


def reliabilities(patterns: list[dict], rounds: int = EM_ROUNDS) -> tuple[float, dict[str, tuple[float, float]]]:
    """EM over vote patterns (a vote per labeler and the count ``n``): the
    share of personal data, and per labeler the odds of a yes vote, among its
    votes, on personal data and on other spans."""
    share = 0.5
    yes = {name: (0.8, 0.3) for name in LABELERS}
    for _ in range(rounds):
        total = positive = 0.0
        sums = {name: [1.6, 2.0, 0.6, 2.0] for name in LABELERS}  # starting beliefs as two votes a class
        for row in patterns:
            p = posterior(row, share, yes)
            total += row["n"]
            positive += p * row["n"]
            for name in LABELERS:
                if row[name] is not None:
                    s = sums[name]
                    s[0] += p * row["n"] * row[name]
                    s[1] += p * row["n"]
                    s[2] += (1 - p) * row["n"] * row[name]
                    s[3] += (1 - p) * row["n"]
        share = (positive + 1.0) / (total + 2.0)
        yes = {name: (s[0] / s[1], s[2] / s[3]) for name, s in sums.items()}
    return share, yes


def posterior(row: dict, share: float, yes: dict[str, tuple[float, float]]) -> float:
    """Odds that a span with these votes is personal data."""
    log_odds = math.log(share / (1 - share))
    for name in LABELERS:
        if row[name] is not None:
            a, b = (min(max(q if row[name] else 1 - q, 1e-4), 1 - 1e-4) for q in yes[name])
            log_odds += math.log(a / b)
    return 1 / (1 + math.exp(-max(-30.0, min(30.0, log_odds))))


def _features() -> Column:
    """Features of a span, as strings; at most MAX_FEATURES in all."""
    kind, match = F.col("kind"), F.col("match")
    n = F.length(_digits(match))
    seps = F.when(match.rlike("[ ]"), 1).when(match.rlike("[-]"), 2).when(match.rlike("[(.]"), 3).otherwise(0)

    def slot(name: str, value: Column) -> Column:
        return F.concat(F.lit(name), F.pmod(F.hash(F.lower(value)), F.lit(SLOTS)).cast("string"))

    return F.array(
        F.concat_ws("|", kind, seps.cast("string"), F.least(F.floor(n / 4), F.lit(7)).cast("string")),
        slot("b", F.regexp_extract("before", r"(\S+)\s*$", 1)),
        slot("a", F.regexp_extract("after", r"^\s*(\S+)", 1)),
        slot("c", F.concat(F.right("before", F.lit(1)), F.lit("~"), F.left("after", F.lit(1)))),
    )


def classify(voted: DataFrame) -> DataFrame:
    """``voted`` with ``personal``: base spans, and the loose ones that the
    trained classifier accepts."""
    spans = voted.filter("kind IS NOT NULL")
    patterns = [r.asDict() for r in spans.groupBy(*LABELERS).agg(F.count(F.lit(1)).alias("n")).collect()]
    share, yes = reliabilities(patterns)
    # The posterior is a sum of one term per labeler.
    log_odds = F.lit(math.log(share / (1 - share)))
    for name in LABELERS:
        a, b = (min(max(q, 1e-4), 1 - 1e-4) for q in yes[name])
        log_odds = log_odds + F.when(F.col(name) == 1, math.log(a / b)).when(F.col(name) == 0, math.log((1 - a) / (1 - b))).otherwise(0.0)
    p = 1 / (1 + F.exp(-log_odds))
    parts = spans.select(p.alias("p"), F.explode(_features()).alias("feature"))
    sums = parts.groupBy("feature").agg(F.sum("p").alias("yes"), F.sum(1 - F.col("p")).alias("no")).collect()
    total_yes = sum(r["yes"] for r in sums) / 4 + 1
    total_no = sum(r["no"] for r in sums) / 4 + 1
    weights = {r["feature"]: math.log((r["yes"] + 0.5) / (total_yes + 1)) - math.log((r["no"] + 0.5) / (total_no + 1)) for r in sums}
    score = F.lit(math.log(total_yes / total_no))
    if weights:
        table = F.create_map(*[F.lit(x) for pair in sorted(weights.items()) for x in pair])
        score = F.aggregate(_features(), score, lambda s, f: s + F.coalesce(F.element_at(table, f), F.lit(0.0)))
    # A loose span needs the classifier and the votes to agree.
    accept = ~F.col("kind").isin(*BASE) & (score > 0) & (p > 0.5)
    return voted.withColumn("personal", F.coalesce(F.col("base") | accept, F.lit(False)))


def personal_data(docs: DataFrame) -> DataFrame:
    """One row per document: doc_id and ``found``, an array of base and added
    spans (start, order of the kind, kind, end, base)."""
    judged = classify(C.cut(votes(candidates(docs))))
    order = reduce(lambda c, k: c.when(F.col("kind") == k[1], k[0]), enumerate(PATTERNS), F).otherwise(-1)
    span = F.struct("start", order.alias("order"), "kind", "end", "base")
    # collect_list leaves out the nulls of rows that are not personal data.
    rows = judged.groupBy("row").agg(F.first("doc_id").alias("doc_id"), F.array_sort(F.collect_list(F.when(F.col("personal"), span))).alias("all"))
    base = F.filter("all", lambda s: s["base"])
    rows = rows.select("doc_id", "all", base.alias("kept"))
    clear = F.filter(
        "all", lambda s: s["base"] | ~F.exists("kept", lambda b: (b["start"] < s["end"]) & (s["start"] < b["end"]))
    )
    return rows.select("doc_id", clear.alias("found"))


def _joined(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def op4_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = personal_data(C.table(spark, sf_dir, "documents"))
    base = F.filter("found", lambda s: s["base"])

    def count(kind: str) -> Column:
        return F.size(F.filter("found", lambda s: s["base"] & (s["kind"] == kind))).cast("long").alias(f"n_{kind}")

    counts = [count(kind) for kind in BASE]
    return rows.select("doc_id", *counts, F.sha2(_joined(base), 256).alias("base_sha256"), _joined(F.col("found")).alias("spans"))
