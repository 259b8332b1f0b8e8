"""Personal data: exact patterns, and more spans found by weak supervision.

Base spans follow fixed patterns and always count. Looser patterns give
candidates for what those miss, such as a number that runs into its neighbour.
Five labelers, of shape, lists, context, borders and separators, vote for or
against each candidate or abstain. Expectation-maximisation over the counts of
vote patterns estimates how reliable each labeler is, and a logistic classifier
of span features is trained on the resulting probabilities; the candidates that
it accepts are added.

Everything that touches texts or spans is a Spark expression. The driver gets
counts of vote and feature patterns only, whose number the labelers bound.
"""

from __future__ import annotations

import math
from collections import defaultdict
from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import stage

KINDS = ("email", "ip", "card", "phone")

# The base patterns. Runs are possessive and start where a run
# starts or the last match ended, which changes no match, as a run that fails
# fails at its later characters too, but keeps long runs linear.
BASE = {
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?:\G|(?<![0-9]))[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
# What a text has to hold for its pattern to be tried at all.
GUARD = {"email": "@", "ip": r"[0-9]\.[0-9]", "card": r"[0-9][\x20-]?[0-9]", "phone": r"\+[0-9]"}

LOOSE = {
    "email": (
        r"[A-Za-z0-9._%+-]{1,64}+\x20?(?:\(at\)|\[at\]|\{at\})\x20?[A-Za-z0-9-]{1,63}"
        r"(?:\x20?(?:\(dot\)|\[dot\]|\{dot\}|\.)\x20?[A-Za-z0-9-]{2,63}+)++"
    ),
    "ip": r"(?<![0-9.])[0-9]{1,3}(?:\.[0-9]{1,3}){3}(?![0-9])",
    "card": (
        r"(?<![\p{L}0-9])(?:[0-9]{4}([\x20-])[0-9]{4}\1[0-9]{4}\1[0-9]{1,7}|[0-9]{13,19})(?![\p{L}0-9])"
    ),
    "phone": (
        r"(?:\+[0-9]{1,3}[\x20.-]?\(?[0-9]{2,4}\)?[\x20.-]?[0-9]{3}[\x20.-]?[0-9]{4}"
        r"|(?:\([0-9]{3}\)\x20?|(?<![\p{L}0-9+.-])[0-9]{3}[\x20.-])[0-9]{3}[\x20.-][0-9]{4})(?![\p{L}0-9])"
    ),
}
LOOSE_GUARD = {"email": r"[(\[{]at[)\]}]", "ip": GUARD["ip"], "card": r"[0-9]{4}", "phone": r"[0-9]{3}"}

BEFORE = 24  # characters of context before a span
TOP_LEVELS = "com org net edu gov info io eu uk de fr es it nl example"
CALLING_CODES = "1 7 20 27 30 31 32 33 34 36 39 40 41 43 44 45 46 47 48 49 52 55 61 62 65 81 82 86 90 91"
CUES = {
    "email": r"mail|contact|write|correo|courriel|kontakt",
    "ip": r"\bip\b|server|host|addr|login|client",
    "card": r"card|visa|credit|payment|karte|carte|tarjeta",
    "phone": r"phone|tel|call|mobile|fax|anruf|appel|llam",
}
AGAINST = r"version|\bv\.?\s?$|isbn|invoice|order|page|\bid\b|hash|serial|ref\b|[=#$€£]\s?$"
LABELERS = ("shape", "lists", "context", "borders", "separators")
TRUST = (5, 1, 1, 1, 1)  # votes that a labeler's vote counts as where learning starts: shape has a checksum or bounds
FEATURES = ("digits", "lists", "shape", "before", "after", "separators")
ACCEPTED = 0.9  # probability from which a candidate is added: what is added should be right

_BLOCK = 128  # elements of an array that are added up one by one


def _bind(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use`` of a value that is computed once."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def _running(values: Column, join: Callable[[Column, Column], Column]) -> Column:
    """Totals of an array of integers from 0 on, so far, by ``join`` (a sum or a maximum).

    An array grows by copying, so only ``_BLOCK`` elements are totalled at a time
    and the blocks after that: a million elements take about a second.
    """

    def within(part: Column) -> Column:
        def step(held: Column, value: Column) -> Column:
            total = join(held["at"], value)
            return F.struct(total.alias("at"), F.concat(held["done"], F.array(total)).alias("done"))

        start = F.struct(F.lit(0).alias("at"), F.array().cast("array<int>").alias("done"))
        return F.aggregate(part, start, step, lambda held: held["done"])

    def glue(blocks: Column) -> Column:
        def shifted(before: Column) -> Column:
            def shift(block: Column, i: Column) -> Column:
                return F.when(i == 0, block).otherwise(F.transform(block, lambda v: join(F.get(before, i - 1), v)))

            return F.flatten(F.transform(blocks, shift))

        return _bind(within(F.transform(blocks, lambda b: F.element_at(b, -1))), shifted)

    def cut(values: Column) -> Column:
        firsts = F.sequence(F.lit(1), F.size(values), F.lit(_BLOCK))
        blocks = F.transform(firsts, lambda first: within(F.slice(values, first, F.lit(_BLOCK))))
        return F.when(F.size(values) == 0, F.array().cast("array<int>")).otherwise(_bind(blocks, glue))

    return _bind(values, cut)


def _located(text: Column, pattern: str, guard: str, around: bool) -> Column:
    """Leftmost non-overlapping matches with their places in code points and, if asked, what stands ``around`` them.

    Places are running sums of the lengths of matches and gaps, and the context
    comes from the gaps and matches before, so that the time is nearly linear in
    the text; taking it from the text would read that from its start each time.
    """
    kind = "array<struct<start:int,end:int,value:string" + (",before:string,after:string>>" if around else ">>")

    def place(found: Column) -> Column:
        matches, gaps = found["matches"], found["gaps"]

        def spans(ends: Column, tails: Column) -> Column:
            def span(value: Column, i: Column) -> Column:
                end = F.get(ends, i)
                parts = [(end - F.length(value)).alias("start"), end.alias("end"), value.alias("value")]
                if around:
                    # four matches are longer than the context
                    pieces = [F.coalesce(F.get(a, i - k + n), F.lit("")) for k in range(4, 0, -1) for n, a in enumerate((matches, tails))]
                    after = F.left(F.get(gaps, i + 1), F.lit(1))
                    after = F.when(after == "", F.coalesce(F.left(F.get(matches, i + 1), F.lit(1)), F.lit(""))).otherwise(after)
                    parts += [F.lower(F.right(F.concat(*pieces), F.lit(BEFORE))).alias("before"), after.alias("after")]
                return F.struct(*parts)

            return F.transform(matches, span)

        sizes = F.transform(matches, lambda m, i: F.length(F.get(gaps, i)) + F.length(m))
        tails = F.transform(gaps, lambda g: F.right(g, F.lit(BEFORE))) if around else F.array(F.lit(""))
        return _bind(_running(sizes, lambda a, b: a + b), lambda ends: _bind(tails, lambda own: spans(ends, own)))

    both = F.struct(
        F.regexp_extract_all(text, F.lit(pattern), F.lit(0)).alias("matches"), F.split(text, pattern, -1).alias("gaps")
    )
    holds = text.contains(guard) if guard == "@" else text.rlike(guard)
    return F.when(holds, _bind(both, place)).otherwise(F.array()).cast(kind)


def _digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def _octets(value: Column) -> Column:
    """All parts are numbers up to 255, leading zeros allowed."""
    parts = F.transform(F.split(value, r"\."), lambda p: F.regexp_replace(p, "^0+(?=[0-9])", ""))
    return F.forall(parts, lambda p: (F.length(p) <= 3) & (F.lpad(p, 3, "0") <= "255"))


def _valid(kind: str) -> Callable[[Column], Column]:
    """The test that a base span of a kind has to pass."""

    def test(span: Column) -> Column:
        value = span["value"]
        digits = _digits(value)
        if kind == "ip":
            return _octets(value)
        if kind == "card":
            return F.length(digits).between(13, 19) & F.call_function("luhn_check", digits)
        if kind == "phone":
            return F.length(digits).between(9, 15)
        return F.lit(True)

    return test


def _any(words: str) -> str:
    return "|".join(words.split())


def _sign(yes: Column, no: Column) -> Column:
    return F.when(yes, 1).when(no, -1).otherwise(0)


def _votes(kind: str, span: Column) -> dict[str, Column]:
    """1 for, -1 against, 0 abstains, by labeler."""
    value, before, after = span["value"], span["before"], span["after"]
    digits = _digits(value)
    last = F.lower(F.regexp_extract(value, r"([A-Za-z]+)$", 1))
    shape = {
        "email": F.length(last) >= 2,
        "ip": _octets(value),
        "card": F.length(digits).between(13, 19) & F.call_function("luhn_check", digits),
        "phone": F.length(digits).between(10, 13),
    }[kind]
    lists = {
        "email": _sign(last.rlike(f"^({_any(TOP_LEVELS)})$"), F.length(last) < 2),
        "ip": _sign(value.rlike(r"^(?!0|127\.)[0-9]"), value.rlike(r"^(0|127\.)")),
        "card": _sign(digits.rlike(r"^(4|5[1-5]|2[2-7]|3[47]|6011|65)"), digits.rlike("^[01789]")),
        "phone": _sign(
            F.when(value.startswith("+"), digits.rlike(f"^({_any(CALLING_CODES)})")).otherwise(digits.rlike("^[2-9]")),
            ~value.startswith("+") & digits.rlike("^[01]"),
        ),
    }[kind]
    separators = F.array_distinct(F.split(F.regexp_replace(value, r"[A-Za-z0-9+()]", ""), ""))
    used = F.size(F.filter(separators, lambda s: s != ""))
    return {
        "shape": _sign(shape, ~shape),
        "lists": lists,
        "context": _sign(before.rlike(CUES[kind]), before.rlike(AGAINST)),
        "borders": _sign(~before.rlike(r"[\p{L}\p{N}]$") & ~after.rlike(r"[\p{L}\p{N}]"), F.lit(True)),
        "separators": _sign(F.lit(kind == "email") | (used <= (2 if kind == "phone" else 1)), F.lit(True)),
    }


def _border(side: Column) -> Column:
    return F.when(side.rlike(r"\p{L}"), "letter").when(side.rlike(r"\p{N}"), "digit").when(
        side.rlike(r"\s") | (side == ""), "space"
    ).otherwise("mark")


def _features(kind: str, span: Column) -> dict[str, Column]:
    """Categories of a span, few of each."""
    votes = _votes(kind, span)
    return {
        "digits": F.least(F.length(_digits(span["value"])), F.lit(20)).cast("string"),
        "lists": votes["lists"].cast("string"),
        "shape": votes["shape"].cast("string"),
        "before": _border(F.right(span["before"], F.lit(1))),
        "after": _border(span["after"]),
        "separators": votes["separators"].cast("string"),
    }


def reliabilities(counts: dict[tuple, int], rounds: int = 60) -> dict[tuple, float]:
    """Probability that a candidate is real, for each (kind, *votes), by EM over their counts.

    Real and unreal candidates differ in how often a labeler votes each way;
    given that, labelers are taken to be independent. It starts from the
    majority of the votes, counted by ``TRUST``.
    """
    real = {p: 1 / (1 + math.exp(-sum(t * v for t, v in zip(TRUST, p[1:], strict=True)))) for p in counts}
    for _ in range(rounds):
        mass: dict = defaultdict(float)
        for pattern, n in counts.items():
            for truth, share in ((1, real[pattern]), (0, 1 - real[pattern])):
                mass[pattern[0], truth] += n * share
                for labeler, vote in enumerate(pattern[1:]):
                    mass[pattern[0], truth, labeler, vote] += n * share
        for pattern in counts:
            logs = []
            for truth in (1, 0):
                whole = mass[pattern[0], truth]
                log = math.log(whole + 1)
                for labeler, vote in enumerate(pattern[1:]):
                    prior = 2.0 if vote == (1 if truth else -1) else 1.0
                    log += math.log((mass[pattern[0], truth, labeler, vote] + prior) / (whole + 4))
                logs.append(log)
            real[pattern] = 1 / (1 + math.exp(max(-60.0, min(60.0, logs[1] - logs[0]))))
    return real


def fit_classifier(rows: list[tuple[tuple[str, ...], float, float]], steps: int = 400, rate: float = 0.5, ridge: float = 1e-3) -> dict[str, float]:
    """Logistic weights of categories from (categories, rows, sum of probabilities), by gradient steps."""
    weights: dict[str, float] = defaultdict(float)
    total = sum(n for _, n, _ in rows) or 1.0
    for _ in range(steps):
        slope: dict[str, float] = defaultdict(float)
        for names, n, real in rows:
            guess = 1 / (1 + math.exp(-max(-40.0, min(40.0, sum(weights[c] for c in names)))))
            for name in names:
                slope[name] += (n * guess - real) / total
        for name, s in slope.items():
            weights[name] -= rate * (s + ridge * weights[name])
    return dict(weights)


def _probability(kind: str, span: Column, weights: dict[str, float]) -> Column:
    total = F.lit(weights.get(kind, 0.0))
    for name, value in _features(kind, span).items():
        prefix = f"{kind} {name} "
        known = {c.removeprefix(prefix): w for c, w in weights.items() if c.startswith(prefix)}
        if known:
            table = F.create_map(*[F.lit(x) for pair in sorted(known.items()) for x in pair])
            total = total + F.coalesce(F.try_element_at(table, value), F.lit(0.0))
    return 1 / (1 + F.exp(-total))


def _spans_of(docs: DataFrame, text: str, kept: list[Column]) -> DataFrame:
    """``kept``, and b_<kind>, c_<kind>: base spans and candidates of each row, stored; texts are read once."""
    body = F.coalesce(F.col(text), F.lit(""))
    columns = {}
    for kind in KINDS:
        found = F.filter(_located(body, BASE[kind], GUARD[kind], False), _valid(kind))
        columns[f"b_{kind}"] = F.transform(found, lambda s: F.struct(s["start"], s["end"]))
        columns[f"c_{kind}"] = _located(body, LOOSE[kind], LOOSE_GUARD[kind], True)
    return stage(docs.select(*kept, *[c.alias(n) for n, c in columns.items()]), "spans")


def train(spans: DataFrame) -> dict[str, float]:
    """Weights of the span classifier from all candidates of ``spans``."""
    patterns: dict = defaultdict(list)
    for kind in KINDS:
        each = spans.select(F.explode(f"c_{kind}").alias("s"))
        s = F.col("s")
        votes = [v.alias(f"v_{n}") for n, v in _votes(kind, s).items()]
        features = [f.alias(f"f_{n}") for n, f in _features(kind, s).items()]
        counted = each.select(*votes, *features).groupBy(*[f"v_{n}" for n in LABELERS], *[f"f_{n}" for n in FEATURES]).count()
        for row in counted.collect():  # one row for each pattern
            patterns[(kind, *row[: len(LABELERS)])].append((row[len(LABELERS) : -1], row["count"]))
    real = reliabilities({p: sum(n for _, n in found) for p, found in patterns.items()})
    rows = [
        ((p[0], *(f"{p[0]} {name} {value}" for name, value in zip(FEATURES, values, strict=True))), n, n * real[p])
        for p, found in patterns.items()
        for values, n in found
    ]
    return fit_classifier(rows)


def _free(candidates: Column, base: Column) -> Column:
    """The candidates that touch no base span.

    Starts of base spans and ends of candidates are sorted together. A candidate
    is free if no base span that starts before its end reaches past its start.
    """

    def event(at: Column, kind: int, value: Column, number: Column) -> Column:
        return F.struct(at.alias("at"), F.lit(kind).alias("kind"), value.alias("value"), number.alias("number"))

    starts = F.transform(base, lambda b: event(b["start"], 1, b["end"], F.lit(-1)))
    ends = F.transform(candidates, lambda c, i: event(c["end"], 0, c["start"], i))

    def pick(events: Column) -> Column:
        reach = F.transform(events, lambda e: F.when(e["kind"] == 1, e["value"]).otherwise(0))

        def chosen(reached: Column) -> Column:
            free = F.filter(events, lambda e, i: (e["kind"] == 0) & (F.get(reached, i) <= e["value"]))
            return F.transform(free, lambda e: F.get(candidates, e["number"]))

        return _bind(_running(reach, F.greatest), chosen)

    merged = _bind(F.sort_array(F.concat(starts, ends)), pick)
    return F.when((F.size(candidates) == 0) | (F.size(base) == 0), candidates).otherwise(merged)


def _judged(found: DataFrame, kept: list[str]) -> DataFrame:
    """``kept``, base and spans, by a classifier trained on all candidates of ``found``."""
    weights = train(found)

    def named(kind: str, spans: Column) -> Column:
        return F.transform(spans, lambda s: F.struct(F.lit(kind).alias("kind"), s["start"].alias("start"), s["end"].alias("end")))

    def accepted(kind: str) -> Callable[[Column], Column]:
        return lambda s: _probability(kind, s, weights) >= ACCEPTED

    every = F.concat(*[F.col(f"b_{k}") for k in KINDS])
    base, more = [], []
    for kind in KINDS:
        free = _free(F.col(f"c_{kind}"), F.col("every"))
        own = F.filter(free, accepted(kind))
        base.append(named(kind, F.col(f"b_{kind}")))
        more.append(named(kind, F.sort_array(F.concat(f"b_{kind}", F.transform(own, lambda s: F.struct(s["start"], s["end"]))))))
    return found.withColumn("every", every).select(*kept, F.concat(*base).alias("base"), F.concat(*more).alias("spans"))


def find_spans(docs: DataFrame, text: str = "text", key: str = "doc_id") -> DataFrame:
    """(key, base, spans): arrays of (kind, start, end), by kind and then by start.

    ``spans`` holds the base spans and the accepted candidates that touch none of
    them. Places are code points, the end exclusive. Null and empty texts have no
    spans; repeated rows have the same ones each; an empty table gives no rows;
    other columns are not looked at. Texts of millions of matches take time in
    proportion.
    """
    return _judged(_spans_of(docs, text, [F.col(key).alias("key")]), ["key"]).withColumnRenamed("key", key)


def listed(spans: Column) -> Column:
    """``kind:start:end`` of each span, comma-joined."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def mask(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` with every span of each row replaced by ``<kind>``; spans that overlap run together.

    A row keeps its spans, so null and repeated keys and repeated rows do no harm,
    and columns may have any names. Null texts stay null.
    """
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row")
    found = _judged(_spans_of(docs.select(row, F.col(f"`{text}`").alias("body")), "body", [F.col("row"), F.col("body")]), ["row", "body"])
    # four bytes a character, so that a piece is cut without reading the text before it
    wide = F.encode("body", "UTF-32")

    def pieces(spans: Column, reached: Column) -> Column:
        def piece(s: Column, i: Column) -> Column:
            at = F.when(i == 0, F.lit(0)).otherwise(F.get(reached, i - 1))
            gap = F.decode(F.substring(F.col("wide"), at * 4 + 1, F.greatest(s["start"] - at, F.lit(0)) * 4), "UTF-32")
            return F.concat(gap, F.when(s["end"] > at, F.concat(F.lit("<"), s["kind"], F.lit(">"))).otherwise(""))

        rest = F.substring(F.col("wide"), F.element_at(reached, -1) * 4 + 1, F.length("wide"))
        return F.concat(F.array_join(F.transform(spans, piece), ""), F.decode(rest, "UTF-32"))

    def masked(spans: Column) -> Column:
        return _bind(_running(F.transform(spans, lambda s: s["end"]), F.greatest), lambda reached: pieces(spans, reached))

    ordered = F.sort_array(F.transform("spans", lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end"), s["kind"].alias("kind"))))
    done = F.when(F.size("spans") > 0, _bind(ordered, masked)).otherwise(F.col("body")).alias("made")
    cleaned = found.withColumn("wide", wide).select("row", done)
    return cleaned.select(*[F.col("made").alias(c) if c == text else F.col("row").getField(c).alias(c) for c in docs.columns])
