"""Personal data by weak supervision.

*Candidates.*  Per kind (email, ip, card, phone) a base pattern finds
leftmost, non-overlapping matches; those that also pass the kind's test
are base spans and always stay.  Matches that fail the test, and matches
of a looser pattern (bracketed ``(at)``/``(dot)`` addresses, phone numbers
without a country code), are candidates for the method.

*Labelers.*  Each candidate gets votes of -1, 0 (abstains) or 1: the base
rule and checksum (regex), number ranges, domains and issuer prefixes
(gazetteer), the words before it, and the characters around it (context).

*Aggregation.*  Expectation-maximisation over the counts of vote patterns
estimates, per kind, how often each labeler is right when it votes, and
from that the probability of every pattern.  Those probabilities train
the final span classifier, a logistic regression on features of the span
itself (digits, separators, grouping, checksum, neighbours).  Both fits
see only counts per pattern, whose number is fixed by the labelers and
features (at most 4 * 3**5 and 4 * 324), never rows.

*Result.*  Base spans plus the candidates the classifier accepts.

Everything that touches rows is a DataFrame function: a table scan that
writes narrow candidates to the shared folder, two aggregations into the
pattern counts, and a scan of the candidates.  Nothing is joined and no
text is shuffled.  Offsets come from pairing the matches of a pattern with
the gaps that a split by the same pattern leaves, in one linear fold.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starledger.llm.common import shared_table, text_of

KINDS = ("email", "ip", "card", "phone")

# The base patterns of the contract, with possessive loops and
# start guards that keep matching linear and leave every match as it is.
BASE = {
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?:\G|(?<![0-9]))[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
#: Looser patterns; the phone one also matches base numbers, so that a
#: loose match never starts inside one.
LOOSE = {
    "email": r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]++ ?[\[(] ?at ?[\])] ?[A-Za-z0-9-]++"
             r"(?: ?[\[(] ?dot ?[\])] ?[A-Za-z0-9-]++)++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]"
             r"|(?<![0-9+(.-])(?:\([0-9]{3}\) ?|[0-9]{3}[ .-])[0-9]{3}[ .-][0-9]{4}(?![0-9-])",
}
#: What a text must contain for a pattern to be tried at all.
NEEDS = {"email": r"@", "ip": r"[0-9]\.[0-9]", "card": r"[0-9][\x20-]?[0-9]", "phone": r"\+[0-9]",
         "loose email": r"[\[(] ?at ?[\])]", "loose phone": r"[0-9]{3}[ .-][0-9]{4}"}

# Gazetteers.
ISSUERS = r"^(?:4|5[1-5]|2[2-7]|3[4789]|6)"
DOMAINS = r"(?i)(?:mail|example|[.](?:com|org|net|edu|de|fr|es|info|io)$)"
PHONE_CODES = r"^\+(?:1|7|2[0-9]|3[0-9]|4[0-9]|5[0-9]|6[0-9]|8[0-9]|9[0-9])"
RESERVED_IP = r"^(?:0|127|255)\."
CONTEXT_YES = {
    "email": r"(?i)(?:mail|contact|kontakt|write|from|to)[^A-Za-z]*$",
    "ip": r"(?i)(?:ip|host|server|addr\w*|address|login)[^A-Za-z]*$",
    "card": r"(?i)(?:card|visa|credit|debit|karte|carte|tarjeta|pay)[^A-Za-z]*$",
    "phone": r"(?i)(?:phone|tel|call|mobile|fax|telefon|cell)[^A-Za-z]*$",
}
CONTEXT_NO = r"(?i)(?:version|release|isbn|order|invoice|section|figure|page|id|no|nr|token|serial|sku)[^A-Za-z]*$"
#: The labelers and how often each is taken to be right before any count.
LABELERS = {"rule": 0.9, "checksum": 0.95, "gazetteer": 0.6, "context": 0.75, "neighbours": 0.55}
PRIOR_VOTES = 4.0


def _triples(found: Column, gaps: Column) -> Column:
    """Array of (gap, match, next gap), empty where nothing was found.
    ``gaps`` is the split by the same pattern: one more than matches."""
    n = F.size(found)
    triple = F.transform(F.arrays_zip(F.slice(gaps, 1, n), F.slice(found, 1, n), F.slice(gaps, 2, n)), lambda x: F.struct(
        x["0"].alias("gap"), x["1"].alias("match"), x["2"].alias("after")))
    return F.when(n > 0, triple).otherwise(F.array().cast("array<struct<gap:string,match:string,after:string>>"))


def _luhn(digits: Column) -> Column:
    n = F.length(digits)
    total = F.aggregate(F.sequence(F.lit(1), n), F.lit(0), lambda acc, i: acc + _luhn_digit(digits, n, i))
    return (total % 10) == 0


def _luhn_digit(digits: Column, n: Column, i: Column) -> Column:
    d = digits.substr(i, F.lit(1)).cast("int")
    twice = 2 * d
    return F.when((n - i) % 2 == 1, F.when(twice > 9, twice - 9).otherwise(twice)).otherwise(d)


def _passes(kind: str, match: Column, digits: Column, n_digits: Column) -> Column:
    """The kind's own test of a base match."""
    if kind == "ip":
        part = r"0*(?:[0-9]{1,2}|1[0-9]{2}|2[0-4][0-9]|25[0-5])"
        return match.rlike(rf"^{part}\.{part}\.{part}\.{part}$")
    if kind == "card":
        return F.when((n_digits >= 12) & (n_digits <= 19), _luhn(digits)).otherwise(False)
    if kind == "phone":
        return (n_digits >= 9) & (n_digits <= 15)
    return F.lit(True)


def _gazetteer(kind: str, match: Column, digits: Column) -> Column:
    if kind == "email":
        return F.when(match.rlike(DOMAINS), 1).otherwise(0)
    if kind == "ip":
        return F.when(match.rlike(RESERVED_IP), -1).otherwise(0)
    if kind == "card":
        return F.when(digits.rlike(ISSUERS), 1).otherwise(-1)
    return F.when(match.rlike(PHONE_CODES), 1).otherwise(0)


def _candidates(found: Column, gaps: Column, kind: str, loose: bool) -> Column:
    """Array of candidate structs of one pattern, in text order."""
    triples = _triples(found, gaps)

    def judged(x):
        match, before = x["match"], F.substring(x["gap"], -24, 24)
        digits = F.regexp_replace(match, "[^0-9]", "")
        n = F.length(digits)
        fits = F.lit(False) if loose else _passes(kind, match, digits, n)
        skip = match.startswith("+") if loose and kind == "phone" else F.lit(False)  # the base pattern's
        checksum = (F.when(fits, 1).otherwise(-1) if kind in ("card", "ip") and not loose else F.lit(0))
        context = F.when(before.rlike(CONTEXT_YES[kind]), 1).when(before.rlike(CONTEXT_NO), -1).otherwise(0)
        tight = before.rlike("[A-Za-z0-9.-]$") | x["after"].rlike("^[A-Za-z0-9]")
        neighbours = F.when(tight, -1).otherwise(1)
        votes = [F.when(fits, 1).otherwise(0), checksum, _gazetteer(kind, match, digits), context, neighbours]
        code = F.lit(0)
        for vote in votes:
            code = code * 3 + vote + 1
        separators = (F.when(match.rlike("[0-9][ ][0-9]"), 2).when(match.rlike("[-.()]"), 1).otherwise(0))
        size = F.when(n == 0, 0).when(n < 9, 1).when(n < 12, 2).when(n < 16, 3).when(n == 16, 4).otherwise(5)
        groups = F.when(match.rlike(r"^[0-9]{4}([ -])[0-9]{4}\1[0-9]{4}\1[0-9]{1,7}$"), 1).when(
            match.rlike(r"^[0-9]+$"), 2).otherwise(0)
        features = (size * 3 + separators) * 3 + groups
        features = (features * 3 + checksum + 1) * 2 + tight.cast("int")
        return F.struct(x["gap"].alias("gap"), match.alias("match"), fits.alias("base"), skip.alias("skip"),
                        code.cast("int").alias("votes"), features.cast("int").alias("shape"))

    judged_array = F.transform(triples, judged)

    # The fold keeps the position and writes one short text per candidate;
    # appending to one string is linear where growing an array is not.
    def step(acc, x):
        start = acc["at"] + F.length(x["gap"])
        end = start + F.length(x["match"])
        entry = F.concat_ws(":", start.cast("string"), end.cast("string"), x["base"].cast("int").cast("string"),
                            x["votes"].cast("string"), x["shape"].cast("string"))
        return F.struct(end.cast("long").alias("at"),
                        F.when(x["skip"], acc["out"]).otherwise(F.concat(acc["out"], entry, F.lit(","))).alias("out"))

    start = F.struct(F.lit(0).cast("long").alias("at"), F.lit("").alias("out"))
    folded = F.aggregate(judged_array, start, step)["out"]
    entries = F.filter(F.split(folded, ","), lambda e: e != "")
    number = KINDS.index(kind)

    def parsed(e):
        p = F.split(e, ":")
        return F.struct(p[0].cast("long").alias("start"), F.lit(number).alias("kind"), p[1].cast("long").alias("end"),
                        (p[2] == "1").alias("base"), p[3].cast("int").alias("votes"), p[4].cast("int").alias("shape"))

    return F.transform(entries, parsed)


def candidates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, cands) per row of ``docs``: all candidates, base and other,
    sorted by start, then kind.  A loose match that overlaps a base span of
    its kind is left out."""
    scans = {k: (k, False, BASE[k], NEEDS[k]) for k in KINDS}
    scans |= {f"loose_{k}": (k, True, LOOSE[k], NEEDS[f"loose {k}"]) for k in LOOSE}
    nothing = F.array().cast("array<string>")
    # one projection per step: Spark keeps them apart, so each pattern runs
    # over a text once for its matches and, if there are any, once to split
    steps = docs.select(docs[id_col].alias("id"), text_of(docs, text_col).alias("text"))
    steps = steps.select("id", "text", *[
        F.when(F.col("text").rlike(needs), F.regexp_extract_all("text", F.lit(pattern), F.lit(0))).otherwise(nothing)
        .alias(f"m_{n}") for n, (_, _, pattern, needs) in scans.items()])
    steps = steps.select("id", *[f"m_{n}" for n in scans], *[
        F.when(F.size(f"m_{n}") > 0, F.split("text", pattern, -1)).otherwise(nothing).alias(f"g_{n}")
        for n, (_, _, pattern, _) in scans.items()])
    steps = steps.select("id", *[_candidates(F.col(f"m_{n}"), F.col(f"g_{n}"), kind, loose).alias(n)
                                 for n, (kind, loose, _, _) in scans.items()])
    extra = [F.filter(F.col(f"loose_{k}"), _clear_of(F.col(k))) for k in LOOSE]
    return steps.select("id", F.sort_array(F.concat(*KINDS, *extra)).alias("cands"))


def _clear_of(base: Column):
    """Test of a candidate: it overlaps no base span of the array."""
    return lambda c: ~F.exists(base, lambda b: b["base"] & (b["start"] < c["end"]) & (c["start"] < b["end"]))


# --- the two fits, on pattern counts only -----------------------------------

def _votes_of(code: int) -> list[int]:
    out = []
    for _ in LABELERS:
        out.append(code % 3 - 1)
        code //= 3
    return out[::-1]


def fit_reliabilities(counts: list[tuple[int, int, int]], rounds: int = 50) -> dict[tuple[int, int], float]:
    """Expectation-maximisation over (kind, vote code, count): probability
    of personal data for each (kind, vote code).  A labeler's accuracy is
    the chance that its vote is right, given that it votes; it starts at its
    value in ``LABELERS``, which stays as ``PRIOR_VOTES`` votes.  No counts
    give an empty map."""
    out: dict[tuple[int, int], float] = {}
    for kind in sorted({k for k, _, _ in counts}):
        rows = [(code, _votes_of(code), n) for k, code, n in counts if k == kind]
        accuracy, share = list(LABELERS.values()), 0.5
        for _ in range(rounds):
            posterior = {}
            for code, votes, _ in rows:
                odds = math.log(share / (1 - share))
                for v, a in zip(votes, accuracy):
                    odds += v * math.log(a / (1 - a))
                posterior[code] = 1 / (1 + math.exp(-max(-30.0, min(30.0, odds))))
            total = sum(n for _, _, n in rows)
            share = (sum(posterior[c] * n for c, _, n in rows) + 1) / (total + 2)
            for j, start in enumerate(LABELERS.values()):
                right, voted = start * PRIOR_VOTES, PRIOR_VOTES
                for code, votes, n in rows:
                    if votes[j]:
                        right += n * (posterior[code] if votes[j] > 0 else 1 - posterior[code])
                        voted += n
                accuracy[j] = min(0.99, max(0.5, right / voted))
        out.update({(kind, code): posterior[code] for code, _, _ in rows})
    return out


def _shape_vector(kind: int, shape: int) -> list[int]:
    """Indices of the active features of a (kind, shape): every feature is
    one-hot within its kind."""
    tight, rest = shape % 2, shape // 2
    check, rest = rest % 3, rest // 3
    groups, rest = rest % 3, rest // 3
    separators, size = rest % 3, rest // 3
    at = kind * 18
    return [at, at + 1 + size, at + 7 + separators, at + 10 + groups, at + 13 + check, at + 16 + tight]


N_FEATURES = 18 * len(KINDS)


def fit_classifier(counts: list[tuple[int, int, float, int]], rounds: int = 300, rate: float = 1.0,
                   ridge: float = 1e-3) -> list[float]:
    """Logistic regression on (kind, shape, mean probability, count) by
    gradient steps; the weights of the one-hot features."""
    weights = [0.0] * N_FEATURES
    rows = [(_shape_vector(k, s), p, n) for k, s, p, n in counts]
    totals: dict[int, float] = {}
    for on, _, n in rows:
        totals[on[0]] = totals.get(on[0], 0.0) + n
    for _ in range(rounds):
        step = [-ridge * w for w in weights]
        for on, p, n in rows:
            z = sum(weights[j] for j in on)
            error = (p - 1 / (1 + math.exp(-max(-30.0, min(30.0, z))))) * n / totals[on[0]]
            for j in on:
                step[j] += error
        weights = [w + rate * s for w, s in zip(weights, step)]
    return weights


def find_pii(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", accept: float = 0.5) -> DataFrame:
    """One row per row of ``docs``: ``id_col``; ``n_email``, ``n_ip``,
    ``n_card``, ``n_phone`` (base spans); ``base`` and ``found``, arrays of
    (start, kind, end, probability) in code points, sorted by start, then
    kind; ``found`` holds the base spans and the accepted candidates.

    Null text is empty and has no spans.  Repeated rows give repeated
    result rows; extra columns are ignored; an empty table, or one without
    candidates, gives its rows with empty arrays."""
    rows = shared_table(candidates(docs, id_col, text_col), "pii-candidates")
    flat = rows.select(F.explode("cands").alias("c")).select("c.kind", "c.votes", "c.shape")
    patterns = flat.groupBy("kind", "votes", "shape").agg(F.count(F.lit(1)).alias("n"))
    patterns = shared_table(patterns, "pii-patterns")
    counts = [(r.kind, r.votes, r.n) for r in
              patterns.groupBy("kind", "votes").agg(F.sum("n").alias("n")).orderBy("kind", "votes").collect()]
    belief = fit_reliabilities(counts)
    if belief:
        key = F.col("kind") * 1000 + F.col("votes")
        table = F.create_map(*[F.lit(x) for (k, code), p in belief.items() for x in (k * 1000 + code, p)])
        soft = (patterns.withColumn("p", F.element_at(table, key)).groupBy("kind", "shape")
                .agg((F.sum(F.col("p") * F.col("n")) / F.sum("n")).alias("p"), F.sum("n").alias("n"))
                .orderBy("kind", "shape").collect())
        weights = fit_classifier([(r.kind, r.shape, r.p, r.n) for r in soft])
        score = {r.kind * 1000 + r["shape"]: 1 / (1 + math.exp(-sum(weights[j] for j in _shape_vector(r.kind, r["shape"]))))
                 for r in soft}
        scores = F.create_map(*[F.lit(x) for k, p in sorted(score.items()) for x in (k, p)])
    else:
        scores = F.create_map(F.lit(-1), F.lit(0.0))
    scored = F.transform("cands", lambda c: F.struct(
        c["start"].alias("start"), c["kind"].alias("kind"), c["end"].alias("end"), c["base"].alias("base"),
        F.coalesce(F.try_element_at(scores, c["kind"] * 1000 + c["shape"]), F.lit(0.0)).alias("probability")))
    slim = lambda c: F.struct(c["start"].alias("start"), F.element_at(
        F.array(*[F.lit(k) for k in KINDS]), c["kind"] + 1).alias("kind"), c["end"].alias("end"),
        c["probability"].alias("probability"))
    out = rows.select("id", scored.alias("cands")).select(
        "id", F.filter("cands", lambda c: c["base"]).alias("base"),
        F.filter("cands", lambda c: c["base"] | (c["probability"] >= accept)).alias("found"))
    of_kind = lambda i: lambda c: c["kind"] == i
    counted = [F.size(F.filter("base", of_kind(i))).cast("long").alias(f"n_{k}") for i, k in enumerate(KINDS)]
    return out.select(F.col("id").alias(id_col), *counted, F.transform("base", slim).alias("base"),
                      F.transform("found", slim).alias("found"))


def span_text(spans: Column) -> Column:
    """``kind:start:end`` of every span, comma-joined."""
    return F.concat_ws(",", F.transform(spans, lambda s: F.concat_ws(
        ":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))))
