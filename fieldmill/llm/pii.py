"""Personal data by weak supervision, in DataFrame and SQL functions only.

Patterns find candidate spans. Labelers vote on each for or against, or abstain: the form of the match, a list of
known words, the words before it, its edges, and a check of its content. The votes of all documents are
counted by pattern; expectation-maximisation estimates from the counts how reliable each labeler is, and the labels it
infers train a final logistic classifier over the votes and the kind. Spans of the base kinds (email, ip, card,
phone) that pass their rules always stay; of the added kinds those that the classifier accepts.

The counts have at most one row for each kind and combination of votes, whatever the input's size, so estimating
and training take place on the driver over a few hundred numbers.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fieldmill.llm.storage import step

BASE_KINDS = ("email", "ip", "card", "phone")
#: ``*_part`` finds numbers in their usual grouping where a base match runs on into what follows and so fails its rule.
ADDED_KINDS = ("card_part", "phone_part", "secret", "name")
LABELERS = ("form", "known", "context", "edges", "content")

# In the patterns below ``(?:(?<![set])|\G)`` starts a match only where a run of the set starts, or where the match
# before ended: the same matches as without it, without trying each place of a long run. Possessive
# repetition never goes back, which changes nothing where what follows can't match inside the run.
_LOCAL = "A-Za-z0-9._%+-"
_PATTERNS = {
    "email": rf"(?:(?<![{_LOCAL}])|\G)[{_LOCAL}]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?:(?<![0-9])|\G)[0-9]++(?:\.[0-9]++){3}",
    "card": r"(?<![0-9])(?<![0-9][ -])[0-9](?:[ -]?[0-9]){15,18}+(?![ -]?[0-9])",
    "phone": r"\+[0-9][ ().0-9-]+[0-9]",
    "card_part": r"(?<![0-9])(?:[0-9]{16,19}+|[0-9]{4}(?:([ -])[0-9]{4})(?:\1[0-9]{4}){2})(?![0-9])",
    "phone_part": r"\+[0-9]{1,3}[ .-]?(?:\([0-9]{1,4}\)[ .-]?)?[0-9]{2,4}(?:[ .-]?[0-9]{2,4}){1,4}(?![0-9])",
    "secret": r"(?i)\b(?:password|passwd|pwd|secret|token|api[_-]?key)\b[ ]{0,3}[=:][ ]{0,3}[\"']?[A-Za-z0-9+/_-]{8,}+[\"']?",
    "name": r"\b(?:Mr|Mrs|Ms|Dr|Prof)\.? [A-Z][a-z]{1,30}(?: [A-Z][a-z]{1,30})?\b",
}
#: A text without this can't hold the kind.
_NEEDS = {"email": "%@%.%", "ip": "%.%.%.%", "card": None, "phone": "%+%", "card_part": None, "phone_part": "%+%", "secret": None, "name": None}

#: Words before a span that speak for it.
_CUES = {
    "email": "mail|contact|write|reach|address",
    "ip": "ip|server|host|addr|address|login",
    "card": "card|visa|credit|pay|payment|account",
    "phone": "phone|tel|call|mobile|fax|contact",
    "secret": "config|export|set|env|key|login|auth",
    "name": "by|from|with|dear|contact|signed|author",
}
#: Known words inside a span that speak for it.
_KNOWN = {
    "email": r"(?i)(?:\.(?:com|org|net|edu|gov|io|de|fr|es|uk)$|@mail)",
    "ip": r"^(?:10|127|169\.254|172\.(?:1[6-9]|2[0-9]|3[01])|192\.168)\.",
    "card": r"^(?:4|5[1-5]|2[2-7]|3[47]|6)",
    "phone": r"^\+(?:1|33|34|44|49)(?![0-9]{12})",
    "secret": r"(?i)^(?:password|passwd|token|api)",
    "name": r" (?:James|John|Robert|Michael|William|David|Mary|Anna|Maria|Linda|Susan|Thomas|Peter|Paul|Laura|Julia)\b",
}
_FORM = {
    "email": r"^[A-Za-z0-9][A-Za-z0-9._%+-]{0,62}[A-Za-z0-9]?@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)*\.[A-Za-z]{2,24}$",
    "ip": r"^(?:0|[1-9][0-9]*)(?:\.(?:0|[1-9][0-9]*)){3}$",
    "card": r"^(?:[0-9]+|[0-9]{4}(?:[ -][0-9]{4}){3}(?:[ -][0-9]{1,3})?)$",
    "phone": r"^\+[0-9]{1,3}[ .-]?(?:\([0-9]{1,4}\))?[ 0-9.-]+$",
    "secret": r"^[A-Za-z_-]+ ?[=:] ?[\"']?[^ ]+$",
    "name": r"^[A-Za-z]+\. ",
}
_BEFORE = 40


def _luhn(digits: str) -> str:
    """SQL that is true where the string of digits ``digits`` passes the Luhn check."""
    doubled = f"int(substr(reverse({digits}), k, 1)) * if(k % 2 = 0, 2, 1)"
    total = f"aggregate(transform(sequence(1, length({digits})), k -> {doubled} - if({doubled} > 9, 9, 0)), 0, (a, b) -> a + b)"
    return f"{total} % 10 = 0"


_DIGITS = "regexp_replace(m.value, '[^0-9]', '')"
_RULES = {
    "email": "true",
    "ip": "forall(split(m.value, '[.]'), p -> length(ltrim('0', p)) < 3 or (length(ltrim('0', p)) = 3 and int(ltrim('0', p)) <= 255))",
    "card": f"length({_DIGITS}) between 16 and 19 and {_luhn(_DIGITS)}",
    "phone": f"length({_DIGITS}) between 8 and 15",
    "secret": "true",
    "name": "true",
}
_CONTENT = {
    "email": "length(m.value) <= 254 and not contains(m.value, '..')",
    "ip": "not startswith(m.value, '0.') and not startswith(m.value, '255.')",
    "card": "length(array_join(array_distinct(split(m.value, '')), '')) > 3",
    "phone": f"length({_DIGITS}) >= 10",
    "secret": "m.value rlike '[0-9]' and m.value rlike '[=:].*[A-Za-z]'",
    "name": "length(m.value) between 6 and 60",
}


def _quoted(text: str) -> str:
    return "r'" + text.replace("'", "\\x27") + "'"


def _placed(kind: str) -> Column:
    """Matches of a kind with their places in code points, leftmost first."""
    return F.expr(
        f"""if(size(found_{kind}) = 0, array(), aggregate(
            zip_with(found_{kind}, slice(gaps_{kind}, 1, size(found_{kind})), (m, g) -> struct(length(g) as gap, m as value)),
            struct(0 as at, cast(array() as array<struct<start: int, end: int, value: string>>) as out),
            (acc, x) -> struct(
                acc.at + x.gap + length(x.value) as at,
                concat(acc.out, array(struct(acc.at + x.gap as start, acc.at + x.gap + length(x.value) as end, x.value as value))) as out
            ),
            acc -> acc.out))"""
    )


def _voted(kind: str) -> Column:
    """The matches that pass the kind's rule, with one vote (1, -1, or 0 to abstain) of each labeler."""
    base = _base_of(kind)
    before = f"substr(text, greatest(m.start + 1 - {_BEFORE}, 1), least(m.start, {_BEFORE}))"
    cue = _quoted(rf"(?i)\b(?:{_CUES[base]})s?\b[^A-Za-z0-9]{{0,3}}(?:[A-Za-z]+[^A-Za-z0-9]{{1,3}}){{0,2}}$")
    inside = _quoted(r"[A-Za-z0-9]$"), _quoted(r"^[A-Za-z0-9]")
    return F.expr(
        f"""transform(filter(at_{kind}, m -> {_RULES[base]}), m -> struct(
            '{kind}' as kind, m.start as start, m.end as end,
            if(m.value rlike {_quoted(_FORM[base])}, 1, -1) as form,
            if(m.value rlike {_quoted(_KNOWN[base])}, 1, 0) as known,
            if({before} rlike {cue}, 1, 0) as context,
            if({before} rlike {inside[0]} or substr(text, m.end + 1, 1) rlike {inside[1]}, -1, 1) as edges,
            if({_CONTENT[base]}, 1, -1) as content))"""
    )


def candidates(docs: DataFrame, keep: list[str], text_col: str = "text") -> DataFrame:
    """The columns ``keep`` as the struct ``doc``, and ``spans``: candidates of every kind with their votes.

    Places count code points, ends are exclusive. A null text is empty and has no spans. Every kind is matched leftmost
    and without overlaps over the whole text; base kinds don't see each other, added spans inside a base span are dropped.
    """
    kinds = (*BASE_KINDS, *ADDED_KINDS)
    rows = docs.select(
        F.struct(*[docs[c] for c in keep]).alias("doc"), F.coalesce(docs[text_col], F.lit("")).alias("text")
    )
    none = F.array().cast("array<string>")
    rows = rows.select(
        "*",
        *[
            (
                F.regexp_extract_all("text", F.lit(_PATTERNS[k]), 0)
                if _NEEDS[k] is None
                else F.when(F.col("text").like(_NEEDS[k]), F.regexp_extract_all("text", F.lit(_PATTERNS[k]), 0)).otherwise(none)
            ).alias(f"found_{k}")
            for k in kinds
        ],
    )
    rows = rows.select(
        "*", *[F.when(F.size(f"found_{k}") > 0, F.split("text", _PATTERNS[k], -1)).otherwise(none).alias(f"gaps_{k}") for k in kinds]
    )
    rows = rows.select("doc", "text", *[_placed(k).alias(f"at_{k}") for k in kinds])
    rows = rows.select(
        "doc",
        F.concat(*[_voted(k) for k in BASE_KINDS]).alias("base"),
        F.concat(*[_voted(k) for k in ADDED_KINDS]).alias("added"),
    )
    new = F.expr("filter(added, s -> not exists(base, b -> b.start <= s.start and s.end <= b.end))")
    return rows.select("doc", F.concat("base", new).alias("spans"))


def _base_of(kind: str) -> str:
    return kind.removesuffix("_part")


@dataclass
class SpanModel:
    """What the labelers are worth: reliabilities by expectation-maximisation and the classifier's weights."""

    prior: dict[str, float]
    reliability: dict[str, tuple[float, float]]  # share of right votes on true and on false spans
    intercept: float
    votes: dict[str, float]
    kinds: dict[str, float]

    def accepts(self, span: str) -> str:
        """SQL that is true where the struct named ``span`` is a base kind or accepted by the classifier."""
        votes = " + ".join(f"{w:.9f} * {span}.{name}" for name, w in self.votes.items())
        kind = " ".join(f"when '{k}' then {w:.9f}" for k, w in self.kinds.items())
        base = ", ".join(f"'{k}'" for k in BASE_KINDS)
        return f"({span}.kind in ({base}) or {self.intercept:.9f} + {votes} + (case {span}.kind {kind} else 0 end) >= 0)"


def _posteriors(patterns: list[dict], rounds: int) -> tuple[list[float], dict, dict]:
    """Probability that a span with each pattern is true, the kinds' priors and the labelers' reliabilities."""
    truth = [min(0.95, max(0.05, 0.6 + 0.12 * sum(p[name] for name in LABELERS))) for p in patterns]
    prior: dict[str, float] = {}
    right: dict[str, tuple[float, float]] = {}
    for _ in range(rounds):
        for kind in {p["kind"] for p in patterns}:
            own = [(p["n"], t) for p, t in zip(patterns, truth) if p["kind"] == kind]
            prior[kind] = (sum(n * t for n, t in own) + 1) / (sum(n for n, _ in own) + 2)
        for name in LABELERS:
            sums = [[2.0, 3.0], [2.0, 3.0]]  # right and all votes on true spans, on false spans, with a weak prior
            for p, t in zip(patterns, truth):
                if p[name]:
                    for side, weight in ((0, p["n"] * t), (1, p["n"] * (1 - t))):
                        sums[side][0] += weight * ((p[name] > 0) == (side == 0))
                        sums[side][1] += weight
            right[name] = (sums[0][0] / sums[0][1], sums[1][0] / sums[1][1])
        for i, p in enumerate(patterns):
            odds = math.log(prior[p["kind"]] / (1 - prior[p["kind"]]))
            for name in LABELERS:
                on_true, on_false = right[name]
                if p[name] > 0:
                    odds += math.log(on_true / max(1e-9, 1 - on_false))
                elif p[name] < 0:
                    odds += math.log(max(1e-9, 1 - on_true) / on_false)
            truth[i] = 1 / (1 + math.exp(-max(-30.0, min(30.0, odds))))
    return truth, prior, right


def fit(counted: list[dict], rounds: int = 30, steps: int = 400) -> SpanModel:
    """Estimate reliabilities and train the classifier from counts of vote patterns.

    ``counted`` has one dict for each kind and combination of votes, with its count ``n``; without any the model
    accepts added spans by a plain majority of votes.
    """
    kinds = (*BASE_KINDS, *ADDED_KINDS)
    if not counted:
        return SpanModel({}, {}, 0.0, dict.fromkeys(LABELERS, 1.0), dict.fromkeys(kinds, 0.0))
    truth, prior, right = _posteriors(counted, rounds)
    total = sum(p["n"] for p in counted)
    names = [*LABELERS, *kinds, "one"]
    features = [[*(p[x] for x in LABELERS), *(float(p["kind"] == k) for k in kinds), 1.0] for p in counted]
    weights = [0.0] * len(names)
    for _ in range(steps):
        slope = [0.01 * w for w in weights]
        for x, p, t in zip(features, counted, truth):
            z = max(-30.0, min(30.0, sum(w * v for w, v in zip(weights, x))))
            miss = (1 / (1 + math.exp(-z)) - t) * p["n"] / total
            for j, v in enumerate(x):
                slope[j] += miss * v
        weights = [w - 1.0 * g for w, g in zip(weights, slope)]
    values = dict(zip(names, weights))
    return SpanModel(prior, right, values["one"], {n: values[n] for n in LABELERS}, {k: values[k] for k in kinds})


def find_spans(docs: DataFrame, keep: list[str], text_col: str = "text") -> DataFrame:
    """The columns ``keep`` as the struct ``doc``, and ``spans``: ``array<struct<kind, start, end>>`` by kind, then start.

    Defined for null and empty texts (no spans), repeated rows (each on its own), empty tables, and any other
    columns. The candidates are stored once; the model is estimated over all of them.
    """
    found = step(candidates(docs, keep, text_col), "spans")
    votes = found.select(F.explode("spans").alias("s")).groupBy("s.kind", *[f"s.{name}" for name in LABELERS])
    model = fit([row.asDict() for row in votes.agg(F.count("*").alias("n")).orderBy("kind", *LABELERS).collect()])
    accepted = f"transform(filter(spans, s -> {model.accepts('s')}), s -> struct(s.kind, s.start, s.end))"
    return found.select("doc", F.expr(accepted).alias("spans"))


def listed(spans: Column) -> Column:
    """``kind:start:end`` of each span, comma-joined."""
    return F.array_join(
        F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ","
    )


def redacted(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """``docs`` with every span replaced by its kind in brackets; overlapping spans become one, named by the first.

    All columns stay; a null text stays null, a text without spans stays as it is.
    """
    found = find_spans(docs, docs.columns, text_col)
    text = F.col("doc")[text_col]
    merged = F.expr(
        """aggregate(
            array_sort(transform(spans, s -> struct(s.start, -s.end as back, s.kind))),
            cast(array() as array<struct<start: int, end: int, kind: string>>),
            (acc, s) -> case
                when size(acc) = 0 or element_at(acc, -1).end <= s.start
                then concat(acc, array(struct(s.start, -s.back as end, s.kind)))
                else concat(slice(acc, 1, size(acc) - 1), array(struct(
                    element_at(acc, -1).start as start, greatest(element_at(acc, -1).end, -s.back) as end, element_at(acc, -1).kind as kind)))
            end)"""
    )
    pieces = F.expr(
        """concat_ws('', transform(merged, (s, i) -> concat(
            substr(text, if(i = 0, 1, get(merged, i - 1).end + 1), s.start - if(i = 0, 0, get(merged, i - 1).end)),
            '[', upper(replace(s.kind, '_part', '')), ']')), substr(text, element_at(merged, -1).end + 1))"""
    )
    rows = found.select("doc", text.alias("text"), merged.alias("merged"))
    rows = rows.select("doc", F.when(F.size("merged") > 0, pieces).otherwise(F.col("text")).alias("text"))
    kind = found.schema["doc"].dataType
    return rows.select(*[F.col("text" if c == text_col else f"doc.`{c}`").alias(c) for c in kind.names])
