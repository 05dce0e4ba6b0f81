"""Personal data by weak supervision, in DataFrame functions only.

Candidates are all matches of a few patterns, valid or not: e-mail and IP
addresses, card and phone numbers, and long secrets.  Four labelers vote on each
(+1, 0, -1): a strict format check, a gazetteer (top-level domains, number
blocks, issuer and country prefixes, key prefixes), words of the context that
speak for the kind, and signs that speak against.  Vote patterns are counted
over the whole corpus (at most 81 per kind); expectation-maximisation over these
counts estimates, per kind, how often a labeler is right in each class.  The
posteriors then train the final span classifier, a naive Bayes model over
features that the labelers don't see (length, digits, neighbouring characters).

Matches that pass the base rules are always reported.  Others are added if the
classifier accepts them and they overlap no base span.

Positions: a match is put between two marks, the text is split at them, and the
lengths of the pieces add up.  Texts that hold the marks themselves (two private
use characters) get another private use character for them first, so positions
stay.  Patterns start only where a match can start and don't backtrack into what
they took, so they are linear in the text.

Defined results: null and empty texts have no spans; a corpus without
candidates adds none; repeated rows count as given; other columns are ignored
(kept by ``redact``, which also sets ``n_chars`` where there is one).
"""

from __future__ import annotations

import math
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import common

OPEN, CLOSE, OTHER = "", "", ""
#: Base kinds in their order, and the pattern of each (fixed values, written without backtracking).
PATTERNS = {
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"(?<![0-9])[0-9]++(?:[ -][0-9]++)*+",
    "phone": r"\+[0-9][ ().0-9-]+[0-9]",
}
#: Candidates beyond the base rules.
MORE = {
    "phone": r"(?<![0-9+(.-])(?:\([0-9]{3}\) ?|[0-9]{3}[ .-])[0-9]{3}[ .-][0-9]{4}(?![0-9-])",
    "secret": r"(?<![A-Za-z0-9+/_=-])[A-Za-z0-9+/_-]{20,}+",
}
KINDS = [*PATTERNS, "secret"]
#: What a document must hold to be searched at all.
NEEDS = {"email": "@", "phone": "+"}
#: Gazetteer entries at the start (or, for e-mail, the end) of a match (fixed values).
GAZETTEER = {
    "email": r"\.(?i:com|org|net|edu|gov|info|io|de|fr|es|uk|eu|it|nl|ch|at|us|ca)$",
    "ip": r"^(?:1?[0-9]?[0-9]|2[0-4][0-9]|25[0-5])\.",
    "card": r"^(?:4|5[1-5]|2[2-7]|3[47]|35|6011|65)",
    "phone": r"^\+?\(?(?:1|2[07]|3[0-469]|4[013-9]|5[1-8]|6[0-6]|7|8[1246]|9[0-58])",
    "secret": r"^(?:ghp_|gho_|sk-|sk_|pk_|AKIA|xox[bp]-|AIza|eyJ)|^[0-9a-f]{32}$|^[0-9a-f]{40}$|^[0-9a-f]{64}$",
}
CONTEXT = {
    "email": r"(?i)(?:e-?mail|contact|write|mailto|reach|at|:)[^A-Za-z0-9]*$|[a-z][.,]? ?$",
    "ip": r"(?i)\b(?:ip|host|server|address|addr|ping|from|client)\b",
    "card": r"(?i)\b(?:card|visa|mastercard|credit|debit|amex|pay|payment)\b",
    "phone": r"(?i)\b(?:phone|tel|call|mobile|fax|fon|cell|telefon|tél)\b",
    "secret": r"(?i)(?:token|secret|password|passwd|api[_-]?key|key|auth)[\"']?\s*[:=]\s*[\"']?$",
}
AGAINST = r"(?i)(?:version|isbn|order|invoice|no\.|nr\.|#|\$|€|v|id)\s*$|[0-9][.,]$"
BEFORE = 40
ROUNDS = 25
ACCEPT = 0.5
#: Spans gathered in one list before it is set aside (keeps long lists linear).
CHUNK = 256

_SPAN = "struct<kind:string,start:int,end:int,body:string,before:string,after:string,base:boolean>"


def _luhn(digits: Column) -> Column:
    n = F.length(digits)

    def value(i: Column) -> Column:
        d = F.substring(digits, n - i, F.lit(1)).cast("int")
        return F.when(i % 2 == 0, d).otherwise(d * 2 - F.when(d > 4, 9).otherwise(0))

    return F.aggregate(F.sequence(F.lit(0), n - 1), F.lit(0), lambda a, i: a + value(i)) % 10 == 0


def _valid(kind: str, body: Column) -> Column:
    """The base rule that a match must pass."""
    digits = F.regexp_replace(body, "[^0-9]", "")
    if kind == "ip":
        return F.forall(F.split(body, r"\."), lambda p: (F.length(F.ltrim(p, F.lit("0"))) < 4)
                        & (F.right(p, F.lit(3)).cast("int") <= 255))
    if kind == "card":
        return F.when(F.length(digits).between(13, 19), _luhn(digits)).otherwise(False)
    if kind == "phone":
        return F.length(digits).between(9, 15)
    return F.lit(True)


def _spans(parts: str, kind: str, base: bool) -> Column:
    """Spans from the pieces of a marked text: every second piece is a match."""
    pieces = F.col(parts)
    empty = F.array().cast(f"array<{_SPAN}>")

    def step(a: Column, p: Column) -> Column:
        end = a["at"] + F.length(p)
        span = F.struct(F.lit(kind).alias("kind"), a["at"].alias("start"), end.alias("end"), p.alias("body"),
                        F.right(a["last"], F.lit(BEFORE)).alias("before"),
                        F.left(F.get(pieces, a["i"] + 1), F.lit(1)).alias("after"),
                        (_valid(kind, p) if base else F.lit(False)).alias("base"))
        full = F.size(a["buffer"]) >= CHUNK
        return F.struct(
            end.alias("at"), (a["i"] + 1).alias("i"), p.alias("last"),
            F.when(a["i"] % 2 == 0, a["buffer"]).when(full, F.array(span))
            .otherwise(F.concat(a["buffer"], F.array(span))).cast(f"array<{_SPAN}>").alias("buffer"),
            F.when((a["i"] % 2 == 1) & full, F.concat(a["done"], F.array(a["buffer"]))).otherwise(a["done"])
            .cast(f"array<array<{_SPAN}>>").alias("done"))

    start = F.struct(F.lit(0).alias("at"), F.lit(0).alias("i"), F.lit("").alias("last"), empty.alias("buffer"),
                     F.array().cast(f"array<array<{_SPAN}>>").alias("done"))
    found = F.aggregate(pieces, start, step, lambda a: F.flatten(F.concat(a["done"], F.array(a["buffer"]))))
    return F.when(F.size(pieces) > 1, found).otherwise(empty)


def with_candidates(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """``docs`` with the array ``_candidates`` of all matches of all patterns."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    held = F.contains(text, F.lit(OPEN)) | F.contains(text, F.lit(CLOSE))
    out = docs.withColumn("_clean", F.when(held, F.translate(text, OPEN + CLOSE, OTHER * 2)).otherwise(text))
    searches = [(f"_parts{i}", kind, pattern, base) for i, (kind, pattern, base) in enumerate(
        [(k, p, True) for k, p in PATTERNS.items()] + [(k, p, False) for k, p in MORE.items()])]

    def parts(kind: str, pattern: str, base: bool) -> Column:
        marked = F.split(F.regexp_replace("_clean", pattern, f"{OPEN}$0{CLOSE}"), f"[{OPEN}{CLOSE}]")
        return F.when(F.contains(F.col("_clean"), F.lit(NEEDS[kind])), marked) if base and kind in NEEDS else marked

    out = out.withColumns({name: parts(kind, pattern, base) for name, kind, pattern, base in searches})
    found = {f"_spans{i}": F.coalesce(_spans(name, kind, base), F.array().cast(f"array<{_SPAN}>"))
             for i, (name, kind, _, base) in enumerate(searches)}
    names = [name for name, *_ in searches]
    out = out.withColumns(found).drop("_clean", *names)
    # numbers too short for any rule are no candidates
    kept = F.filter(F.concat(*found), lambda s: s["base"] | (s["kind"] != "card") | (F.length(s["body"]) >= 12))
    return out.withColumn("_candidates", kept).drop(*found)


def _by_kind(kind: Column, values: dict[str, Column]) -> Column:
    return reduce(lambda out, k: F.when(kind == k, values[k]).otherwise(out), values, F.lit(None))


def _votes(s: Column) -> Column:
    """The four labelers' votes on a span."""
    digits = F.length(F.regexp_replace(s["body"], "[^0-9]", ""))
    strict = _by_kind(s["kind"], {
        "email": F.rlike(s["body"], F.lit(r"^[^.@][^@]*@[^@]*\.[A-Za-z]{2,24}$")), "ip": s["base"], "card": s["base"],
        "phone": s["base"] | digits.between(10, 11),
        "secret": F.rlike(s["body"], F.lit("[0-9]")) & F.rlike(s["body"], F.lit("[A-Za-z]")) & (digits >= 4)})
    known = _by_kind(s["kind"], {k: F.rlike(s["body"], F.lit(p)) for k, p in GAZETTEER.items()})
    context = _by_kind(s["kind"], {k: F.rlike(s["before"], F.lit(p)) for k, p in CONTEXT.items()})
    against = F.rlike(s["before"], F.lit(AGAINST)) | F.rlike(s["after"], F.lit("[%$€0-9A-Za-z]"))
    return F.array(F.when(strict, 1).otherwise(-1), F.when(known, 1).otherwise(-1), F.when(context, 1).otherwise(0),
                   F.when(against, -1).otherwise(0))


N_VOTERS = 4


def _posterior(votes: Column, theta: Column) -> Column:
    """P(personal | votes); theta: prior, then per labeler P(+|1), P(-|1), P(+|0), P(-|0)."""
    def chance(j: int, c: int) -> Column:
        up, down = theta[1 + 4 * j + 2 * c], theta[2 + 4 * j + 2 * c]
        return F.when(votes[j] == 1, up).when(votes[j] == -1, down).otherwise(1 - up - down)

    yes = reduce(lambda a, j: a * chance(j, 0), range(N_VOTERS), theta[0])
    no = reduce(lambda a, j: a * chance(j, 1), range(N_VOTERS), 1 - theta[0])
    return yes / (yes + no)


def _reliabilities(patterns: DataFrame) -> DataFrame:
    """EM over the counted vote patterns: one row (kind, theta)."""
    start = F.array(*map(F.lit, [0.5] + [0.6, 0.15, 0.15, 0.6] * N_VOTERS))

    def estimate(weighed: Column) -> Column:
        """Weighted shares with one pseudo-count a vote; weighed: (votes, w1, w0)."""
        def total(w: str, vote: int | None = None, j: int = 0) -> Column:
            return F.aggregate(weighed, F.lit(0.0), lambda a, p: a + (
                p[w] if vote is None else F.when(p["votes"][j] == vote, p[w]).otherwise(0.0)))

        one, none = total("w1"), total("w0")
        shares = [(one + 1) / (one + none + 2)]
        for j in range(N_VOTERS):
            shares += [(total(w, vote, j) + 1) / (all_ + 3) for w, all_ in (("w1", one), ("w0", none)) for vote in (1, -1)]
        return F.array(*shares)

    def step(theta: Column, _: Column) -> Column:
        weighed = F.transform("patterns", lambda p: F.struct(
            p["votes"].alias("votes"), (p["n"] * _posterior(p["votes"], theta)).alias("w1"),
            (p["n"] * (1 - _posterior(p["votes"], theta))).alias("w0")))
        return F.aggregate(F.array(weighed), start, lambda _, w: estimate(w))

    return (patterns.groupBy("kind").agg(F.sort_array(F.collect_list(F.struct("votes", "n"))).alias("patterns"))
            .select("kind", F.aggregate(F.sequence(F.lit(1), F.lit(ROUNDS)), start, step).alias("theta")))


def _char_class(c: Column) -> Column:
    return (F.when(c == "", "none").when(F.rlike(c, F.lit(r"\s")), "space").when(F.rlike(c, F.lit("[0-9]")), "digit")
            .when(F.rlike(c, F.lit("[\"'`]")), "quote").when(F.rlike(c, F.lit("[A-Za-z]")), "letter")
            .when(F.rlike(c, F.lit("[=:]")), "sign").otherwise("other"))


def _features(s: Column) -> Column:
    """Features of a span that the labelers don't use; few values each."""
    digits = F.length(F.regexp_replace(s["body"], "[^0-9]", ""))
    n = F.greatest(F.length(s["body"]), F.lit(1))
    return F.array(F.concat(F.lit("length "), F.least(F.floor(F.log2(n)), F.lit(8)).cast("string")),
                   F.concat(F.lit("digits "), F.floor(digits * 4 / n).cast("string")),
                   F.concat(F.lit("before "), _char_class(F.right(s["before"], F.lit(1)))),
                   F.concat(F.lit("after "), _char_class(F.coalesce(s["after"], F.lit("")))))


def fit(candidates: DataFrame) -> dict[str, dict[str, float]]:
    """Per kind the classifier: "" is the prior's log-odds, others the features' weights."""
    spans = common.stored(candidates.select(F.explode("_candidates").alias("s")).select(
        F.col("s.kind").alias("kind"), _votes(F.col("s")).alias("votes"), _features(F.col("s")).alias("features"))
        .groupBy("kind", "votes", "features").agg(F.count("*").alias("n")), "span-votes")
    patterns = spans.groupBy("kind", "votes").agg(F.sum("n").alias("n"))
    theta = {r.kind: r.theta for r in _reliabilities(patterns).collect()}  # a row per kind
    if not theta:
        return {}
    by_kind = _by_kind(F.col("kind"), {k: F.array(*map(F.lit, v)) for k, v in sorted(theta.items())})
    weighed = spans.withColumn("theta", by_kind).withColumn("p", _posterior(F.col("votes"), F.col("theta")))
    sums = [F.sum(F.col("n") * F.col("p")).alias("w1"), F.sum(F.col("n") * (1 - F.col("p"))).alias("w0")]
    rows = (weighed.select("kind", "n", "p", F.explode(F.array_append("features", F.lit(""))).alias("feature"))
            .groupBy("kind", "feature").agg(*sums).collect())  # under 40 rows a kind
    whole = {r.kind: (r.w1, r.w0) for r in rows if r.feature == ""}
    model: dict[str, dict[str, float]] = {}
    for r in rows:
        one, none = whole[r.kind]
        model.setdefault(r.kind, {})[r.feature] = math.log((one + 1) / (none + 1)) if r.feature == "" else \
            math.log((r.w1 + 1) / (one + 2)) - math.log((r.w0 + 1) / (none + 2))
    return model


def with_spans(candidates: DataFrame, model: dict[str, dict[str, float]]) -> DataFrame:
    """Replaces ``_candidates`` by ``_base`` and ``_added``, each sorted by kind and start."""
    rank = {k: i for i, k in enumerate(KINDS)}
    base = F.filter("_candidates", lambda s: s["base"])
    other = F.filter("_candidates", lambda s: ~s["base"] & (F.lit(bool(model))))
    if model:
        weights = F.create_map(*[F.lit(x) for k, own in sorted(model.items()) for f, w in sorted(own.items())
                                 for x in (f"{k} {f}", w)])

        def odds(s: Column) -> Column:
            own = F.array_append(_features(s), F.lit(""))
            return F.aggregate(own, F.lit(0.0), lambda a, f: a + F.coalesce(
                F.try_element_at(weights, F.concat_ws(" ", s["kind"], f)), F.lit(0.0)))

        # a match that failed its base rule stays out; only the wider patterns add
        wide = lambda s: _by_kind(s["kind"], {"phone": ~s["body"].startswith("+"), "secret": F.lit(True)})
        other = F.filter(other, lambda s: F.coalesce(wide(s), F.lit(False)) & (odds(s) > F.lit(0.0))
                         & (_votes(s)[0] == 1))
    out = candidates.withColumns({"_base": base, "_other": other})
    apart = F.filter("_other", lambda s: ~F.exists("_base", lambda b: (b["start"] < s["end"]) & (s["start"] < b["end"])))

    def ordered(spans: Column) -> Column:
        return F.transform(F.array_sort(F.transform(spans, lambda s: F.struct(
            _by_kind(s["kind"], {k: F.lit(i) for k, i in rank.items()}).alias("rank"), s["start"].alias("start"),
            s["end"].alias("end"), s["kind"].alias("kind")))), lambda s: F.struct(s["kind"].alias("kind"), s["start"].alias("start"), s["end"].alias("end")))

    return (out.withColumns({"_base": ordered(F.col("_base")), "_added": ordered(apart)})
            .drop("_candidates", "_other"))


def _listed(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def find_personal_data(documents: DataFrame, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Counts and digest of the base spans and the list of all spans."""
    docs = documents.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    candidates = common.stored(with_candidates(docs).drop("text"), "pii-candidates")
    out = with_spans(candidates, fit(candidates))

    def count(kind: str) -> Column:
        return F.size(F.filter("_base", lambda s: s["kind"] == kind)).cast("long")

    both = F.array_sort(F.concat(*[F.transform(c, lambda s: F.struct(
        _by_kind(s["kind"], {k: F.lit(i) for i, k in enumerate(KINDS)}).alias("rank"), s["start"].alias("start"),
        s["end"].alias("end"), s["kind"].alias("kind"))) for c in ("_base", "_added")]))
    return out.select("doc_id", *[count(k).alias(f"n_{k}") for k in PATTERNS], F.sha2(_listed(F.col("_base")), 256).alias("base_sha256"),
                      _listed(both).alias("spans"))


def redact(documents: DataFrame, *, text_col: str = "text") -> DataFrame:
    """The documents with every span replaced by its kind in angle brackets;
    overlapping spans are replaced together by the first one's kind."""
    columns = documents.columns
    candidates = with_candidates(documents, text_col)
    out = with_spans(candidates, fit(candidates))
    spans = F.array_sort(F.transform(F.concat("_base", "_added"), lambda s: F.struct(
        s["start"].alias("start"), (-s["end"]).alias("less"), s["kind"].alias("kind"))))
    text = F.col(text_col)

    def step(a: Column, s: Column) -> Column:
        fresh = s["start"] >= a["at"]
        piece = F.concat(F.substring(text, a["at"] + 1, s["start"] - a["at"]), F.lit("<"), F.upper(s["kind"]), F.lit(">"))
        return F.struct(F.greatest(a["at"], -s["less"]).alias("at"),
                        F.when(fresh, F.concat(a["pieces"], F.array(piece))).otherwise(a["pieces"]).alias("pieces"))

    start = F.struct(F.lit(0).alias("at"), F.array().cast("array<string>").alias("pieces"))
    whole = F.aggregate("_spans", start, step, lambda a: F.concat(
        F.array_join(a["pieces"], ""), F.substring(text, a["at"] + 1, F.length(text) - a["at"])))
    out = out.withColumn("_spans", spans).withColumn(
        text_col, F.when(F.size("_spans") > 0, whole).otherwise(text))
    if "n_chars" in columns and columns != [text_col]:
        kind = documents.schema["n_chars"].dataType
        out = out.withColumn("n_chars", F.when(F.size("_spans") > 0, F.length(text_col).cast(kind)).otherwise(F.col("n_chars")))
    return out.select(*columns)
