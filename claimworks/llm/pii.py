"""Personal data by weak supervision: labelers vote, EM weighs them, a span classifier decides."""

from __future__ import annotations

import math
from collections import defaultdict
from collections.abc import Callable
from itertools import chain

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .text import table

KINDS = ("email", "ip", "card", "phone", "secret")
# The base patterns. Possessive forms match the same texts in linear time and bounded stack:
# what follows a repeated class never belongs to it. \G lets a match start where the last one ended.
PATTERNS = {
    "email": r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
# Spans that the base patterns miss; the classifier decides on them.
EXTRA = {
    "email": r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]{1,64}+\x20?[\[(](?:at|AT)[\])]\x20?[A-Za-z0-9-]{1,63}+(?:\x20?(?:\.|[\[(](?:dot|DOT)[\])])\x20?[A-Za-z0-9-]{1,63}+)++",
    "phone": r"(?<![0-9+(.-])(?:\([0-9]{3}\)\x20?|[0-9]{3}[.\x20-])[0-9]{3}[.\x20-][0-9]{4}(?![0-9])",
    "secret": r"(?<![A-Za-z0-9])(?=[A-Za-z]*+[0-9])[A-Fa-f0-9]{32,128}+(?![A-Za-z0-9])",
}
# Cheap tests a text must pass before the patterns run.
_MAY = {
    "email": r"@", "ip": r"[0-9]\.[0-9]++\.[0-9]++\.[0-9]", "card": r"[0-9](?:[\x20-]?[0-9]){15}", "phone": r"\+[0-9]",
    "email+": r"[\[(](?:at|AT)[\])]", "phone+": r"[0-9]{3}[.\x20-][0-9]{4}", "secret+": r"[A-Fa-f0-9]{32}",
}
# Gazetteers and context words.
ENDINGS = "com org net edu gov mil int info biz io dev app de fr es it nl uk eu us ca ch at be pl".split()
ISSUERS = r"4|5[1-5]|2[2-7]|3[47]|6(?:011|5|4[4-9])|35|62"
PREFIXES = r"1|20|27|3[0-469]|4[0-9]|5[1-8]|6[0-6]|7|8[1246]|9[0-58]"
CONTEXT = {
    "email": r"(?i)(?:e-?mail|contact|write|mailto|from|to|cc)\W{0,3}$",
    "ip": r"(?i)(?:\bip|addr(?:ess)?|host|server|client|from|login)\W{0,3}$",
    "card": r"(?i)(?:card|visa|master(?:card)?|amex|credit|payment|pay)\W{0,3}(?:no|number)?\W{0,3}$",
    "phone": r"(?i)(?:tel|phone|call|fax|mobile|cell|contact)\W{0,3}$",
    "secret": r"(?i)(?:token|key|secret|password|passwd|pwd|auth|bearer)\W{0,6}$",
}
AGAINST = r"(?i)(?:version|ver|v|build|release|isbn|issn|doi|section|chapter|sha|md5|commit|page|fig)\W{0,3}$"
LABELERS = ("shape", "gazetteer", "context", "border")
_CONTEXT_CHARS = 40
_SPAN = "struct<kind:string,start:int,end:int,base:boolean,shape:int,gazetteer:int,context:int,border:int,length:int,left:string,right:string>"


def _digits(span: Column) -> Column:
    return F.regexp_replace(span, "[^0-9]", "")


def _valid(kind: str, span: Column) -> Column:
    """The base rules a match must pass."""
    n = F.length(_digits(span))
    if kind == "ip":
        part = r"0*+(?:25[0-5]|2[0-4][0-9]|1?[0-9]{1,2}|)"
        return span.rlike(rf"^(?:{part}\.){{3}}{part}$")
    if kind == "card":
        return n.between(16, 19) & F.call_function("luhn_check", _digits(span))
    if kind == "phone":
        return n.between(8, 15)
    return F.lit(True)


def _vote(yes: Column, no: Column | None = None) -> Column:
    """1, 0 (against) or -1 (abstains)."""
    vote = F.when(yes, 1)
    return (vote if no is None else vote.when(no, 0)).otherwise(-1)


def _votes(kind: str, span: Column, before: Column, after: Column) -> dict[str, Column]:
    digits, last, following = _digits(span), F.substring(before, -1, 1), F.substring(after, 1, 1)
    shape = {
        "email": _vote(span.rlike(r"^[A-Za-z0-9](?:[A-Za-z0-9_%+-]|\.(?!\.))*+.*[A-Za-z]{2}$"), span.rlike(r"\.\.|[0-9]$|^[.%+-]")),
        "ip": _vote(span.rlike(r"^[1-9][0-9]{0,2}\.(?:[0-9]{1,3}\.){2}[0-9]{1,3}$") & span.rlike("[0-9]{2}"), span.rlike(r"^(?:[0-9]\.){3}[0-9]$|^0")),
        "card": _vote(F.length(digits).between(13, 19) & F.call_function("luhn_check", digits), ~F.call_function("luhn_check", digits)),
        "phone": _vote(F.length(digits).between(9, 13), ~F.length(digits).between(8, 15)),
        "secret": _vote(F.length(span).isin(32, 40, 64, 128) & span.rlike("[0-9]") & span.rlike("[A-Fa-f]"), ~span.rlike("[A-Fa-f]")),
    }
    gazetteer = {
        "email": _vote(F.lower(span).rlike(rf"[.\])\x20](?:{'|'.join(ENDINGS)})$"), span.rlike(r"\.(?:png|jpg|py|js|html)$")),
        "ip": _vote(span.rlike(r"^(?:10|172|192|8|1[0-9]{2}|2[0-1][0-9]|22[0-3]|[1-9][0-9]?)\."), span.rlike(r"^(?:0|127|2[45][0-9])\.")),
        "card": _vote(digits.rlike(rf"^(?:{ISSUERS})"), digits.rlike("^[01789]")),
        "phone": _vote(span.rlike(rf"^\+?(?:{PREFIXES})|^\("), span.rlike(r"^\+?0")),
        "secret": F.lit(-1),
    }
    votes = {
        "shape": shape[kind], "gazetteer": gazetteer[kind],
        "context": _vote(before.rlike(CONTEXT[kind]), before.rlike(AGAINST)),
        "border": _vote(~last.rlike(r"[\p{L}\p{N}_/=-]") & ~following.rlike(r"[\p{L}\p{N}_/-]"), last.rlike(r"[\p{N}_/-]") | following.rlike(r"[\p{N}_/]")),
    }
    kind_of = lambda c: (F.when(c == "", "none").when(c.rlike(r"\p{L}"), "letter").when(c.rlike(r"\p{N}"), "digit")
                         .when(c.rlike(r"\s"), "space").otherwise("sign"))
    return {**{k: v.cast("int") for k, v in votes.items()}, "length": F.least(F.floor(F.length(span) / 4), F.lit(12)).cast("int"),
            "left": kind_of(last), "right": kind_of(following)}


def _running(values: Column, join: Callable[[Column, Column], Column], none: int) -> Column:
    """``values`` joined with all before them, by doubling: n log n steps, where a fold that grows a list takes n squared."""
    n = F.size(values)
    rounds = F.slice(F.sequence(F.lit(0), F.lit(31)), 1, F.ceil(F.log2(F.greatest(n, F.lit(1)))).cast("int"))

    def step(acc: Column, k: Column) -> Column:
        shift = F.least(F.call_function("shiftleft", F.lit(1), k), n)
        return F.zip_with(acc, F.concat(F.array_repeat(F.lit(none), shift), F.slice(acc, 1, n - shift)), join)

    return F.aggregate(rounds, values, step)


def _found(text: Column, kind: str, base: bool) -> Column:
    """Array of spans of one pattern: matches and the pieces between them, laid end to end."""
    pattern = PATTERNS[kind] if base else EXTRA[kind]

    def spans(x: Column) -> Column:
        matches, pieces = x["matches"], x["pieces"]
        n = F.size(matches)
        lengths = F.zip_with(pieces, F.concat(matches, F.array(F.lit(""))), lambda p, m: F.length(p) + F.length(m))
        laid = F.slice(F.arrays_zip(pieces.alias("piece"), matches.alias("span"), F.slice(pieces, 2, F.greatest(n, F.lit(1))).alias("next"),
                                    _running(lengths, lambda a, b: a + b, 0).alias("end")), 1, n)
        return F.transform(F.filter(laid, lambda m: _valid(kind, m["span"])) if base else laid, one)

    def one(x: Column) -> Column:
        votes = _votes(kind, x["span"], F.right(x["piece"], F.lit(_CONTEXT_CHARS)), F.coalesce(x["next"], F.lit("")))
        return F.struct(F.lit(kind).alias("kind"), (x["end"] - F.length(x["span"])).alias("start"), x["end"].alias("end"),
                        F.lit(base).alias("base"), *[votes[c].alias(c) for c in (*LABELERS, "length", "left", "right")])

    # A lambda's argument is worked out once, however often it is used.
    found = F.array(F.struct(F.regexp_extract_all(text, F.lit(pattern), F.lit(0)).alias("matches"), F.split(text, pattern, -1).alias("pieces")))
    nothing = F.expr(f"CAST(array() AS ARRAY<{_SPAN}>)")
    return F.when(text.rlike(_MAY[kind if base else kind + "+"]), F.transform(found, spans)[0]).otherwise(nothing)


def _apart(base: Column, extra: Column) -> Column:
    """The spans of ``extra`` that overlap none of ``base``: of all spans by start, a base one before ends first, one after starts later."""
    far = 2**31 - 1
    laid = F.array_sort(F.concat(
        F.transform(base, lambda s: F.struct(s["start"].alias("start"), F.lit(0).alias("extra"), s["end"].alias("end"), s.alias("span"))),
        F.transform(extra, lambda s: F.struct(s["start"].alias("start"), F.lit(1).alias("extra"), s["end"].alias("end"), s.alias("span")))))

    def kept(all_spans: Column) -> Column:
        ends = F.transform(all_spans, lambda x: F.when(x["extra"] == 0, x["end"]).otherwise(0))
        starts = F.transform(F.reverse(all_spans), lambda x: F.when(x["extra"] == 0, x["start"]).otherwise(far))
        zipped = F.arrays_zip(all_spans.alias("x"), _running(ends, lambda a, b: F.greatest(a, b), 0).alias("before"),
                              F.reverse(_running(starts, lambda a, b: F.least(a, b), far)).alias("after"))
        clear = F.filter(zipped, lambda z: (z["x"]["extra"] == 1) & (z["before"] <= z["x"]["start"]) & (z["after"] >= z["x"]["end"]))
        return F.transform(clear, lambda z: z["x"]["span"])

    return F.when((F.size(base) == 0) | (F.size(extra) == 0), extra).otherwise(F.transform(F.array(laid), kept)[0])


def candidates(text: Column) -> Column:
    """All base spans, and other spans that overlap none of their kind, with votes and features.

    Places count code points from 0, ends are exclusive. Null texts have none.
    Time is in proportion to the text and its spans, but for a logarithm.
    """
    text = F.coalesce(text, F.lit(""))
    base = F.concat(*[_found(text, kind, True) for kind in PATTERNS])
    extra = F.concat(*[_found(text, kind, False) for kind in EXTRA])
    both = F.array(F.struct(base.alias("base"), extra.alias("extra")))
    return F.transform(both, lambda s: F.concat(s["base"], _apart(s["base"], s["extra"])))[0]


def estimate(patterns: list, rounds: int = 50) -> dict[tuple, float]:
    """Probability that a span is personal data, by (kind, votes), from rows with counts ``n``.

    Expectation-maximisation. A labeler abstains alike on both classes; where it
    votes on a kind it is right with a probability that is estimated, never below
    0.55: labelers are better than chance, which also tells the classes apart.
    """
    sums = defaultdict(float)
    for r in patterns:
        sums[r.kind, tuple(r[c] for c in LABELERS)] += r.n
    belief = {key: min(0.95, max(0.05, 0.5 + 0.2 * sum((v > 0) - (v == 0) for v in key[1]))) for key in sums}
    for _ in range(rounds):
        share, right, voted = defaultdict(lambda: [1.0, 1.0]), defaultdict(lambda: 3.0), defaultdict(lambda: 4.0)
        for (kind, votes), n in sums.items():
            p = belief[kind, votes]
            share[kind][0] += n * (1 - p)
            share[kind][1] += n * p
            for i, v in enumerate(votes):
                if v >= 0:
                    right[kind, i] += n * (p if v else 1 - p)
                    voted[kind, i] += n
        for kind, votes in sums:
            odds = math.log(share[kind][1] / share[kind][0])
            for i, v in enumerate(votes):
                if v >= 0:
                    sure = min(0.99, max(0.55, right[kind, i] / voted[kind, i]))
                    odds += math.log(sure / (1 - sure)) * (1 if v else -1)
            belief[kind, votes] = 1 / (1 + math.exp(-max(-30.0, min(30.0, odds))))
    return belief


def train(patterns: list) -> dict[str, float]:
    """Log-odds of a naive Bayes span classifier, by feature name, from EM's beliefs as soft labels."""
    belief = estimate(patterns)
    classes, counts, totals = defaultdict(lambda: [1.0, 1.0]), defaultdict(lambda: [0.5, 0.5]), defaultdict(lambda: [0.0, 0.0])
    for r in patterns:
        p = belief[r.kind, tuple(r[c] for c in LABELERS)]
        for z, n in enumerate((r.n * (1 - p), r.n * p)):
            classes[r.kind][z] += n
            for f in chain(LABELERS, ("length", "left", "right")):
                counts[f"{r.kind}:{f}:{r[f]}"][z] += n
                totals[f"{r.kind}:{f}"][z] += n
    weights = {kind: math.log(c[1] / c[0]) for kind, c in classes.items()}
    for name, c in counts.items():
        t = totals[name.rpartition(":")[0]]
        weights[name] = math.log(c[1] / (t[1] + 1)) - math.log(c[0] / (t[0] + 1))
    return weights


def fit(docs: DataFrame, text_col: str = "text") -> dict[str, float]:
    """Train on every candidate span of ``docs``; the driver gets counts by votes and features (a fixed number of kinds of rows)."""
    by = ("kind", *LABELERS, "length", "left", "right")
    spans = docs.select(F.explode(candidates(F.col(text_col))).alias("s")).select(*[F.col(f"s.{c}").alias(c) for c in by])
    return train(spans.groupBy(*by).agg(F.count("*").alias("n")).collect())


def decided(spans: Column, weights: dict[str, float]) -> Column:
    """The base spans and those the classifier takes, as (kind, start, end, base, score) by kind, then start."""
    known = F.create_map(*[F.lit(v) for item in sorted(weights.items()) for v in item]) if weights else None

    def score(s: Column) -> Column:
        if known is None:
            return F.lit(0.5)
        names = [s["kind"], *[F.concat(s["kind"], F.lit(f":{f}:"), s[f].cast("string")) for f in (*LABELERS, "length", "left", "right")]]
        odds = sum((F.coalesce(known[n], F.lit(0.0)) for n in names), F.lit(0.0))
        return 1 / (1 + F.exp(-odds))

    order = F.create_map(*[F.lit(v) for i, k in enumerate(KINDS) for v in (k, i)])
    found = F.transform(spans, lambda s: F.struct(
        order[s["kind"]].alias("place"), s["start"].alias("start"), s["end"].alias("end"), s["kind"].alias("kind"),
        s["base"].alias("base"), score(s).alias("score")))
    return F.array_sort(F.filter(found, lambda s: s["base"] | (s["score"] >= 0.5)))


def find(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """``docs`` with ``pii_spans``: every base span and every other span the trained classifier takes.

    A column of that name is replaced. Null texts have no spans; without any
    candidate in ``docs`` nothing is learned and only base spans could be there.
    """
    return docs.withColumn("pii_spans", decided(candidates(F.col(text_col)), fit(docs, text_col)))


def _code_points(data: Column, start: Column, end: Column) -> Column:
    """Text of a range of code points of UTF-32 data, at once; a letter ahead keeps a first byte-order mark from being dropped."""
    part = F.substring(data, 4 * start + 1, 4 * F.greatest(end - start, F.lit(0)))
    return F.substring(F.decode(F.concat(F.encode(F.lit("x"), "UTF-32"), part), "UTF-32"), F.lit(2), F.length(data))


def replaced(text: Column, spans: Column) -> Column:
    """``text`` with its spans replaced by their kind in brackets; one that starts inside those before it only adds to the gap."""
    laid = F.array_sort(F.transform(spans, lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end"), s["kind"].alias("kind"))))

    def written(x: Column) -> Column:
        ends = F.concat(F.array(F.lit(0)), _running(F.transform(x["spans"], lambda s: s["end"]), lambda a, b: F.greatest(a, b), 0))
        begun = F.filter(F.arrays_zip(x["spans"].alias("s"), F.slice(ends, 1, F.size(x["spans"])).alias("at")), lambda z: z["s"]["start"] >= z["at"])
        parts = F.transform(begun, lambda z: F.concat(
            _code_points(x["data"], z["at"], z["s"]["start"]), F.lit("["), F.upper(z["s"]["kind"]), F.lit("]")))
        tail = _code_points(x["data"], F.element_at(ends, -1), (F.length(x["data"]) / 4).cast("int"))
        return F.concat(F.array_join(parts, ""), tail)

    one = F.array(F.struct(laid.alias("spans"), F.encode(text, "UTF-32").alias("data")))
    return F.when(F.size(spans) > 0, F.transform(one, written)[0]).otherwise(text)


def redact(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """``docs`` with every found span in its text replaced by its kind in brackets; overlapping spans become one.

    All other columns stay, whatever their names. Null texts stay null, texts without a span as they are.
    """
    spans = decided(candidates(F.col(text_col)), fit(docs, text_col))
    found = docs.select(F.struct(*docs.columns).alias("row"), F.col(text_col).alias("text"), spans.alias("spans"))
    done = replaced(F.col("text"), F.col("spans")).alias(text_col)
    return found.select(*[done if c == text_col else F.col(f"row.`{c}`").alias(c) for c in docs.columns])


def op1_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = find(table(spark, sf_dir, "documents").select("doc_id", "text"))
    spans = F.col("pii_spans")
    written = lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))

    def count(kind: str) -> Column:
        return F.size(F.filter(spans, lambda s: s["base"] & (s["kind"] == kind))).cast("long").alias(f"n_{kind}")

    base = F.array_join(F.transform(F.filter(spans, lambda s: s["base"]), written), ",")
    return found.select("doc_id", *map(count, PATTERNS), F.sha2(base, 256).alias("base_sha256"), F.array_join(F.transform(spans, written), ",").alias("spans"))
