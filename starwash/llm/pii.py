"""Personal data by candidate gradient boosting.

Base spans: per kind (email, ip, card, phone) the leftmost non-overlapping matches
of a fixed pattern that pass its check (parts at most 255, Luhn, digit counts).
They are always kept.

The method adds spans. High-recall generators propose overlapping candidates
(any run of digits and separators as a card and as a phone, any dotted number as
an ip, anything around an at sign as an email). Boosted trees of depth two score
a candidate by its format and context (length, digits, groups, separators, glued
neighbours, key words before it), without the checks above: what they learn is
which formats in which contexts are personal data, so they also find values that a
check misses. Labels are the base spans themselves: a candidate is positive if it
is a base span. Every candidate of every document counts, copies as often as they occur:
they are combined to distinct feature vectors first (a table, one row each). The trees
are fitted on the half of the texts that a hash chooses, by sums over that table;
thresholds per kind are calibrated on the other half: the least score above which the
precision is at least ``precision``. A kind that never reaches it adds nothing. Added spans do not overlap
base spans; of overlapping added ones the best score stays.

All work on texts is one narrow pass of built-in functions: patterns mark their
matches and a split finds the places, so time is linear in the text, and scores
are CASE expressions. Training is one more such pass.

Defined cases: null and empty texts have no spans; a text with U+FFFF is read with
that character replaced by another of no meaning (U+FFFE); repeated rows are each
judged; an empty table fits no trees. Output columns replace input columns of the
same name.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from starwash.llm.common import save, text_or_empty

KINDS = ("email", "ip", "card", "phone")
_MARK, _OTHER = "\uffff", "\ufffe"

#: the contract's patterns. A match can start only at the first character of its run
#: (or where the last match ended), and runs never give back: the same matches in linear time
_PATTERNS = (
    "(?:\\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\\.[A-Za-z0-9-]++)++",
    "(?:\\G|(?<![0-9]))[0-9]++\\.[0-9]++\\.[0-9]++\\.[0-9]++",
    "[0-9](?:[\\x20-]?[0-9])++",
    "\\+[0-9][\\x20().0-9-]+[0-9]",
)
_PART = "0*(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[1-9]?[0-9])"
_IP_VALID = f"^{_PART}(?:\\.{_PART}){{3}}$"

#: the generators: pattern, and the kinds that a match is a candidate of
_GENERATORS = (
    ("[^\\s@]{1,80}+ ?@ ?[^\\s@]{1,80}+", (0,)),
    ("(?<![0-9.])[0-9]{1,4}+(?:\\.[0-9]{1,4}+){2,4}+", (1,)),
    ("[0-9(+][0-9 ().+/-]{5,40}+", (2, 3)),
)
#: key words that announce a kind, in four languages
_HINTS = (
    "mail|correo|courriel|kontakt|contact",
    "\\bip\\b|host|server|addr|adresse",
    "card|karte|carte|tarjeta|visa|master|credit|iban|konto",
    "tel|phone|fon|mobil|call|fax|llam|appel",
)
FEATURES = ("kind", "digits", "groups", "longest", "length", "plus", "brackets", "dots", "spaces", "letters", "glued_left", "glued_right", "hint")
_BINS = 41  # the features' values are 0 to 40
_SCALE = 1000  # scores are whole thousandths of log-odds
_SPAN = "array<struct<start:int,kind:int,end:int,text:string>>"


def matches(text: Column, pattern: str) -> Column:
    """(start, end, text) of every match, in code points."""
    marked = F.regexp_replace(text, F.lit(f"({pattern})"), F.lit(f"{_MARK}$1{_MARK}"))
    parts = F.split(marked, _MARK, -1)  # texts at even places, matches at odd ones
    placed = F.aggregate(
        parts, F.struct(F.lit(0).alias("at"), F.lit(False).alias("odd"), F.array().cast("array<struct<start:int,end:int,text:string>>").alias("found")),
        lambda a, p: F.struct(
            (a["at"] + F.length(p)).alias("at"), (~a["odd"]).alias("odd"),
            F.when(a["odd"], F.concat(a["found"], F.array(F.struct(a["at"].alias("start"), (a["at"] + F.length(p)).alias("end"), p.alias("text")))))
            .otherwise(a["found"]).alias("found")))
    return placed["found"]


def _digits(text: Column) -> Column:
    return F.regexp_replace(text, F.lit("[^0-9]+"), F.lit(""))


def _valid(kind: int, text: Column) -> Column:
    if kind == 0:
        return F.lit(True)
    if kind == 1:
        return text.rlike(_IP_VALID)
    digits = _digits(text)
    if kind == 2:
        return F.length(digits).between(12, 19) & F.call_function("luhn_check", digits)
    return F.length(digits).between(9, 15)


def base_spans(text: Column) -> Column:
    """Base spans of all kinds, by start, then kind."""
    asked = (F.contains(text, F.lit("@")), text.rlike("[0-9]\\.[0-9]"), text.rlike("[0-9]"), F.contains(text, F.lit("+")))
    found = []
    for kind, (pattern, some) in enumerate(zip(_PATTERNS, asked)):
        spans = F.transform(F.filter(matches(text, pattern), _checked(kind)), _as_span(kind))
        found.append(F.when(some, spans).otherwise(F.array().cast(_SPAN)))
    return F.array_sort(F.concat(*found))


def _candidates(text: Column) -> Column:
    some = F.contains(text, F.lit("@")) | text.rlike("[0-9]")
    found = []
    for pattern, kinds in _GENERATORS:
        met = matches(text, pattern)
        found += [F.transform(met, _as_span(kind)) for kind in kinds]
    # a run may end in separators: the candidate ends with its last digit
    trimmed = F.transform(F.concat(*found), lambda s: F.when(s["kind"] >= 2, _cut_tail(s)).otherwise(s))
    return F.when(some, trimmed).otherwise(F.array().cast(_SPAN))


def _cut_tail(s: Column) -> Column:
    text = F.regexp_replace(s["text"], F.lit("[^0-9]+$"), F.lit(""))
    return F.struct(s["start"].alias("start"), s["kind"].alias("kind"), (s["start"] + F.length(text)).cast("int").alias("end"), text.alias("text"))


def _described(text: Column) -> Column:
    """Candidates and base spans with their features, in bins."""
    def of(s: Column) -> Column:
        t = s["text"]
        left = F.lower(F.substring(text, F.greatest(s["start"] - 23, F.lit(1)), F.least(s["start"], F.lit(24))))
        hint = F.lit(0)
        for kind, words in enumerate(_HINTS):
            hint = F.when(left.rlike(words), kind + 1).otherwise(hint)
        groups = F.array_remove(F.split(t, "[^0-9]+"), "")
        glued = lambda at: F.substring(text, at, 1).rlike("[\\p{L}\\p{N}]").cast("int")
        digits = F.length(_digits(t))
        values = (
            s["kind"], F.least(digits, F.lit(24)), F.least(F.size(groups), F.lit(8)),
            F.least(F.coalesce(F.array_max(F.transform(groups, lambda g: F.length(g))), F.lit(0)), F.lit(20)),
            F.least(F.length(t), F.lit(40)), t.startswith("+").cast("int"), F.contains(t, F.lit("(")).cast("int"),
            F.least(F.length(t) - F.length(F.replace(t, F.lit("."), F.lit(""))), F.lit(6)),
            F.least(F.length(t) - F.length(F.replace(t, F.lit(" "), F.lit(""))), F.lit(6)),
            F.least(F.length(F.regexp_replace(t, F.lit("[^A-Za-z]+"), F.lit(""))), F.lit(30)),
            F.when(s["start"] > 0, glued(s["start"])).otherwise(0), F.coalesce(glued(s["end"] + 1), F.lit(0)), hint)
        return F.struct(s["start"].alias("start"), s["kind"].alias("kind"), s["end"].alias("end"),
                        *[v.cast("int").alias(n if n != "kind" else "kind_") for n, v in zip(FEATURES, values)])

    return F.transform(F.array_distinct(F.concat("base", "proposed")), of)


def _checked(kind: int):
    return lambda m: _valid(kind, m["text"])


def _as_span(kind: int):
    return lambda m: F.struct(m["start"].cast("int").alias("start"), F.lit(kind).alias("kind"), m["end"].cast("int").alias("end"), m["text"].alias("text"))


@dataclass
class PiiModel:
    start: float
    trees: list           # (feature, cut, (feature, cut, low, high), (feature, cut, low, high))
    thresholds: dict[int, float]

    def score(self, s: Column) -> Column:
        """The trees' sum, as a CASE expression over a described candidate."""
        def value(name):
            return s["kind_" if name == "kind" else name]

        total = F.lit(float(self.start))
        for feature, cut, low, high in self.trees:
            leaf = lambda n: F.when(value(n[0]) <= int(n[1]), float(n[2])).otherwise(float(n[3]))
            total = total + F.when(value(feature) <= int(cut), leaf(low)).otherwise(leaf(high))
        return total


def _best_split(g: np.ndarray, h: np.ndarray):
    """(gain, feature, cut, low leaf, high leaf) from the gradients' sums: a row for each feature, a column for each bin."""
    gs, hs = g.cumsum(axis=1), h.cumsum(axis=1)
    all_g, all_h = gs[:, -1:], hs[:, -1:]
    gain = gs**2 / (hs + 1) + (all_g - gs) ** 2 / (all_h - hs + 1) - all_g**2 / (all_h + 1)
    f, k = divmod(int(np.argmax(gain)), gain.shape[1])
    if gain[f, k] <= 1e-9:
        leaf = -all_g[0, 0] / (all_h[0, 0] + 1)
        return 0.0, 0, 0, leaf, leaf
    return gain[f, k], f, k, -gs[f, k] / (hs[f, k] + 1), -(all_g[f, 0] - gs[f, k]) / (all_h[f, 0] - hs[f, k] + 1)


def _as_candidate() -> Column:
    """A row of the table of vectors as ``PiiModel.score`` reads it."""
    return F.struct(*[F.col(n).alias("kind_" if n == "kind" else n) for n in FEATURES])


def _gradients(vectors: DataFrame, model: PiiModel, high: Column) -> tuple[np.ndarray, np.ndarray]:
    """Gradients and curvatures of the logistic loss, summed on the executors: [side, feature, bin]."""
    p = 1 / (1 + F.exp(-F.col("_z") / _SCALE))
    x = vectors.select(model.score(_as_candidate()).alias("_z"), high.cast("int").alias("side"), "n", "y", *FEATURES)
    x = x.select("side", (F.col("n") * p - F.col("y")).alias("g"), (F.col("n") * p * (1 - p)).alias("h"),
                 F.posexplode(F.array(*FEATURES)).alias("f", "bin"))
    # whole numbers, so sums do not depend on their order
    whole = lambda c: F.sum(F.round(F.col(c) * (1 << 20)).cast("long")).alias(c)
    g, h = np.zeros((2, 2, len(FEATURES), _BINS))
    for r in x.groupBy("side", "f", "bin").agg(whole("g"), whole("h")).collect():
        g[r.side, r.f, r.bin], h[r.side, r.f, r.bin] = r.g / (1 << 20), r.h / (1 << 20)
    return g, h


def fit_trees(vectors: DataFrame, positive: int, total: int, rounds: int = 30, rate: float = 0.3) -> PiiModel:
    """Boosted depth-two trees (logistic loss) on a table of weighted distinct feature vectors. Two sums over
    it a tree, on the executors; the driver gets one number for each feature and bin. Scores are whole thousandths."""
    share = positive / total
    model = PiiModel(float(round(_SCALE * np.log((share + 1e-6) / (1 - share + 1e-6)))), [], {})
    for _ in range(rounds):
        g, h = _gradients(vectors, model, F.lit(False))
        _, f, cut, _, _ = _best_split(g[0], h[0])
        g, h = _gradients(vectors, model, F.col(FEATURES[f]) > cut)
        halves = []
        for side in (0, 1):
            _, f2, cut2, low, high = _best_split(g[side], h[side])
            halves.append((FEATURES[f2], cut2, float(round(_SCALE * rate * low)), float(round(_SCALE * rate * high))))
        model.trees.append((FEATURES[f], cut, *halves))
    return model


def candidate_vectors(documents: DataFrame, text_col: str = "text") -> DataFrame:
    """Every candidate of every document as (``half``, features): how many (``n``) and how many base spans (``y``)."""
    text = text_or_empty(text_col)
    texts = documents.select(_clean(text).alias("t"), F.pmod(F.xxhash64(F.lit(5), text), F.lit(2)).alias("half"))
    rows = described(texts, "half").select("half", "base", F.explode("described").alias("c")).select(
        "half", F.exists("base", lambda b: (b["start"] == F.col("c")["start"]) & (b["end"] == F.col("c")["end"]) & (b["kind"] == F.col("c")["kind"])).alias("y"),
        *[F.col("c")["kind_" if n == "kind" else n].alias(n) for n in FEATURES])
    return rows.groupBy("half", *FEATURES).agg(F.count(F.lit(1)).alias("n"), F.sum(F.col("y").cast("int")).alias("y"))


def train(documents: DataFrame, precision: float = 0.98, text_col: str = "text") -> PiiModel:
    """Fit trees and thresholds on the candidates of all documents."""
    vectors = save(candidate_vectors(documents, text_col), "pii-vectors")
    fit = vectors.filter("half = 0")
    total, positive = fit.agg(F.sum("n"), F.sum("y")).first()
    if not positive or positive == total:
        return PiiModel(0.0, [], {})
    model = fit_trees(fit, positive, total)
    scored = vectors.filter("half = 1").select("kind", model.score(_as_candidate()).alias("z"), "n", "y")
    scored = scored.groupBy("kind", "z").agg(F.sum("n").alias("n"), F.sum("y").alias("y"))
    best = Window.partitionBy("kind").orderBy(F.desc("z"))  # a row for each thousandth
    scored = scored.select("kind", "z", F.sum("y").over(best).alias("hits"), F.sum("n").over(best).alias("seen"))
    # (hits + 1) / (seen + 2): few candidates do not make a sure threshold
    sure = scored.filter((F.col("hits") + 1) / (F.col("seen") + 2) >= precision).groupBy("kind").agg(F.min("z").alias("z"))
    model.thresholds.update({r.kind: float(r.z) for r in sure.orderBy("kind").collect()})
    return model


def _clean(text: Column) -> Column:
    return F.replace(text, F.lit(_MARK), F.lit(_OTHER))


def described(texts: DataFrame, *keep: str) -> DataFrame:
    """Of texts in column t: base spans and described candidates."""
    found = texts.select(*keep, "t", base_spans(F.col("t")).alias("base"), _candidates(F.col("t")).alias("proposed"))
    return found.select(*keep, "t", "base", F.when(F.size("base") + F.size("proposed") > 0, _described(F.col("t"))).otherwise(F.array()).alias("described"))


def detect(documents: DataFrame, model: PiiModel, text_col: str = "text") -> DataFrame:
    """``documents`` with ``base`` and ``spans``: arrays of (start, kind, end), by start, then kind."""
    keep = [c for c in documents.columns if c.lower() not in ("base", "spans")]
    inner = [f"_in_{k}" for k in range(len(keep))]
    texts = documents.select(*[F.col(c).alias(n) for c, n in zip(keep, inner)], _clean(text_or_empty(text_col)).alias("t"))
    rows = described(texts, *inner)

    def bound(s):
        out = F.lit(float("inf"))
        for kind, least in model.thresholds.items():
            out = F.when(s["kind"] == kind, least).otherwise(out)
        return out

    apart = lambda a, b: (a["end"] <= b["start"]) | (b["end"] <= a["start"])
    plain = lambda s: F.struct(s["start"].alias("start"), s["kind"].alias("kind"), s["end"].alias("end"))
    free = F.filter("described", lambda s: F.forall("base", lambda b: apart(s, b)))
    scored = F.transform(free, lambda s: F.struct(
        model.score(s).alias("z"), s["start"].alias("start"), s["kind"].alias("kind"), s["end"].alias("end"), bound(s).alias("least")))
    rows = rows.select(*inner, "base", scored.alias("c"))
    rows = rows.select(*inner, "base", F.filter("c", lambda s: s["z"] >= s["least"]).alias("c"))
    # best score first; a span that meets a better one goes
    ranked = F.array_sort(F.transform("c", lambda s: F.struct((-s["z"]).alias("z"), s["start"].alias("start"), s["kind"].alias("kind"), s["end"].alias("end"))))
    picked = F.aggregate(ranked, F.array().cast("array<struct<start:int,kind:int,end:int>>"),
                         lambda done, s: F.when(F.forall(done, lambda d: apart(s, d)), F.concat(done, F.array(plain(s)))).otherwise(done))
    base = F.transform("base", plain)
    return rows.select(*[F.col(n).alias(c) for c, n in zip(keep, inner)], base.alias("base"),
                       F.array_sort(F.concat(base, picked)).alias("spans"))


def spans_text(spans: str) -> Column:
    """kind:start:end, comma-joined."""
    names = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", F.get(names, s["kind"]), s["start"].cast("string"), s["end"].cast("string"))), ",")


def redact(detected: DataFrame, text_col: str = "text") -> DataFrame:
    """Texts with every span replaced by its kind in brackets (of overlapping spans, the first)."""
    names = F.array(*[F.lit(f"[{k}]") for k in KINDS])
    text = text_or_empty(text_col)
    step = F.aggregate(
        "spans", F.struct(F.lit(0).alias("at"), F.lit("").alias("out")),
        lambda a, s: F.when(s["start"] < a["at"], a).otherwise(F.struct(
            s["end"].alias("at"), F.concat(a["out"], F.substring(text, a["at"] + 1, s["start"] - a["at"]), F.get(names, s["kind"])).alias("out"))))
    return detected.withColumn("_r", step).withColumn(text_col, F.when(F.size("spans") == 0, F.col(text_col)).otherwise(
        F.concat("_r.out", F.substring(text, F.col("_r.at") + 1, F.length(text))))).drop("_r")
