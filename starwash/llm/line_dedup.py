"""Line dedup by winnowing.

Texts are cut into words, at white space, and after each character of scripts that
are written without spaces (there a code point counts as a word). Repeats often
begin and end inside a line, so what is winnowed are grams of ``gram`` words in a
row, which may span lines; a line that repeats is the case of a run that fills it.

1. Each start of a gram has its first word's hash. Of every ``min_words - gram + 1``
   starts in a row the least hash is selected (ties: the last start). A run of
   ``min_words`` equal words holds a whole window of starts with their grams, so both
   texts select the same start in it: every such run has a fingerprint in common.
2. Within a text a gram that occurs again is matched with its occurrence before, in
   the text's own row. Across texts only a text's first occurrence counts. A gram's
   first text (least id) is found by one hash aggregation, and its other texts are
   joined with that one only, so a passage in m documents makes m pairs.
3. A match fixes a shift between two texts. Along it all words are compared, which
   extends the match both ways, into partial lines, to maximal runs of equal words.
4. Runs with at least ``min_words`` words are deleted from the later text (greater
   id; in one document, the later place). Words go only if the same run stands
   earlier, so the first occurrence of every run stays.

A gram is compared with its first text only. Where that text has fewer than ``min_words``
words in common around it, two later texts may share more: texts with such a match are
fingerprinted again with grams of ``min_words`` words, whose matches are all long enough.
So what a run of ``2 * min_words - gram`` (28) words or more loses does not depend on
shorter passages that its parts share with other texts.

Only hashes are shuffled, and the texts of matched documents, until the last step,
which joins the runs to the texts.

Defined cases: null and empty texts have no lines and are kept as they are; rows
that share an id are versions of one document and not matched with each other; rows
with a null id come last and are never the first text; columns of the input are
kept, and an input column named like an output (n_lines, n_removed) is replaced.
Lines end at line breaks and sentence ends; ``n_removed`` counts those that lost words.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starwash.llm.common import save

#: a line's end, with the white space behind it; and what a word that ends a line has behind it
_END, _ENDS = "(?:\\n|[.?!] )\\s*+(?=\\S)", "\\n|[.?!] "
_RUNS = "array<struct<from:int,to:int>>"
#: scripts without spaces, and the cuts between words: with the white space kept, and without it
_DENSE = "[\\p{IsHan}\\p{IsHiragana}\\p{IsKatakana}\\p{IsThai}\\p{IsLao}\\p{IsKhmer}\\p{IsMyanmar}\\p{IsTibetan}]"
_MAYBE_DENSE = "[\\u0e00-\\u109f\\u1780-\\u17ff\\u2e80-\\ud7ff\\uf900-\\uffff\\x{10000}-\\x{3ffff}]"  # ranges are quick to sort out
_AFTER = f"(?<=[^\\x00-\\u0dff])(?<={_DENSE})(?=\\S)"
_CUT, _GAP = "(?<=\\s)(?=\\S)", "\\s+"
_LAST = (1 << 63) - 1  # stands for a null id: after all others
_PLACES = (1 << 31) - 1


def _words(text: Column, cut: str) -> Column:
    """Dense scripts need the slower pattern; most texts have none."""
    plain = (F.octet_length(text) == F.char_length(text)) | ~text.rlike(_MAYBE_DENSE)
    return F.when(plain, F.split(text, cut, -1)).otherwise(F.split(text, f"{cut}|{_AFTER}", -1))


def _keyed(documents: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(d, v, t): id, version and text of the texts that have one."""
    text = F.col(text_col).cast("string")
    return documents.filter(F.length(text) > 0).select(F.coalesce(F.col(id_col).cast("long"), F.lit(_LAST)).alias("d"), F.xxhash64(text).alias("v"), text.alias("t"))


def _hashes(text: Column) -> Column:
    return F.transform(_words(text, _GAP), lambda w: F.hash(w))


def _let(value: Column, use) -> Column:
    """``use(value)`` with the value computed once."""
    return F.get(F.transform(F.array(value), use), 0)


def _minima(keys: Column, window: int) -> Column:
    """The least of every ``window`` keys in a row (of all, if they are fewer), each once:
    widths are put together from shorter ones."""
    def widened(mins: Column, offsets: list[int]) -> Column:
        return _let(mins, lambda m: F.transform(m, lambda x, i: F.least(x, *[F.get(m, i + o) for o in offsets])))

    mins, width = keys, 1
    while width < window:
        offsets = [min(width * k, window - width) for k in range(1, min(3, -(-window // width)))]
        mins, width = widened(mins, offsets), offsets[-1] + width
    return F.array_distinct(F.slice(mins, 1, F.greatest(F.size(keys) - window + 1, F.least(F.size(keys), F.lit(1)))))


def fingerprints(hashed: DataFrame, window: int, gram: int) -> DataFrame:
    """(d, v, ps, inner) from (d, v, ws): the selected grams' hashes and first places, and the
    distances between an occurrence and the next one in the same text."""
    # filters stand before costly columns only: Spark would push one behind them down and compute them twice
    starts = F.slice("ws", 1, F.greatest(F.size("ws") - (gram - 1), F.lit(0)))
    keys = F.transform(starts, lambda h, i: F.shiftleft(h.cast("long"), 31) + (F.lit(_PLACES) - i))
    x = hashed.select("d", "v", "ws", keys.alias("ks"))
    x = x.select("d", "v", "ws", _minima(F.col("ks"), window).alias("ms"))
    place = lambda m: (F.lit(_PLACES) - m.bitwiseAND(F.lit(_PLACES))).cast("int")
    prints = F.transform("ms", lambda m: F.struct(F.xxhash64(F.slice("ws", place(m) + 1, gram)).alias("h"), place(m).alias("p")))
    x = x.select("d", "v", prints.alias("ps"))
    again = F.size(F.array_distinct(F.transform("ps", lambda s: s["h"]))) < F.size("ps")
    x = x.select("d", "v", "ps", F.when(again, F.sort_array("ps")).alias("s"))
    before = lambda i: F.get("s", i - 1)
    first = F.filter("s", lambda a, i: (i == 0) | (before(i)["h"] != a["h"]))
    inner = F.transform(F.filter(F.transform("s", lambda a, i: F.struct(a["h"].alias("h"), a["p"].alias("p"), F.when(i > 0, before(i)).alias("b"))),
                                 lambda a: F.coalesce(a["b"]["h"] == a["h"], F.lit(False))), lambda a: a["p"] - a["b"]["p"])
    return x.select("d", "v", F.when(F.col("s").isNull(), F.col("ps")).otherwise(first).alias("ps"), F.array_distinct(inner).alias("inner"))


def matches(found: DataFrame, name: str) -> DataFrame:
    """(d, v, d0, v0, shifts): each text with the first text of its grams, and with itself, from written ``fingerprints``."""
    prints = found.select("d", "v", F.explode("ps").alias("x")).select("x.h", "d", "v", "x.p")
    first = prints.groupBy("h").agg(F.min(F.struct("d", "v", "p")).alias("o"), F.count(F.lit(1)).alias("n")).filter("n > 1")
    first = save(first.select("h", F.col("o.d").alias("d0"), F.col("o.v").alias("v0"), F.col("o.p").alias("p0")), f"{name}-firsts")
    across = prints.join(first, "h").filter("d != d0").select("d", "v", "d0", "v0", (F.col("p") - F.col("p0")).alias("shift"))
    across = across.groupBy("d", "v", "d0", "v0").agg(F.collect_set("shift").alias("shifts"))
    inside = found.filter(F.size("inner") > 0).select("d", "v", F.col("d").alias("d0"), F.col("v").alias("v0"), F.col("inner").alias("shifts"))
    return save(across.unionByName(inside), f"{name}-shifts")


def extended(shifts: DataFrame, hashed: DataFrame, min_words: int) -> DataFrame:
    """(d, v, d0, r): the long runs of equal words along the shifts of each match."""
    both = (shifts.join(hashed.select(F.col("d").alias("d0"), F.col("v").alias("v0"), F.col("ws").alias("ws0")), ["d0", "v0"])
            .join(hashed, ["d", "v"]))

    # along a shift: the places where the two texts differ, and the borders
    def runs(shift):
        low, high = F.greatest(F.lit(0), shift), F.least(F.size("ws"), F.size("ws0") + shift)
        part = F.slice("ws", low + 1, F.greatest(high - low, F.lit(0)))
        differ = F.array_compact(F.transform(part, lambda w, i: F.when(w != F.get("ws0", i + low - shift), i + low)))
        return _let(F.concat(F.array(low - 1), differ, F.array(high)), lambda e: F.filter(
            F.zip_with(e, F.slice(e, 2, F.size(e)), lambda a, b: F.struct((a + 1).alias("from"), b.alias("to"))),
            lambda r: F.coalesce(r["to"] - r["from"] >= min_words, F.lit(False))))

    return both.select("d", "v", "d0", F.flatten(F.transform("shifts", runs)).alias("r"))


def _merged(runs: Column) -> Column:
    """Sorted runs without overlaps."""
    last = lambda a: F.element_at(a, -1)
    grow = lambda a, r: F.concat(F.slice(a, 1, F.size(a) - 1), F.array(F.struct(
        last(a)["from"].alias("from"), F.greatest(last(a)["to"], r["to"]).alias("to"))))
    return F.aggregate(F.slice(runs, 2, F.size(runs)), F.slice(runs, 1, 1), lambda a, r: F.when(last(a)["to"] >= r["from"], grow(a, r)).otherwise(F.concat(a, F.array(r))))


def repeated_runs(documents: DataFrame, min_words: int = 20, gram: int = 12, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(d, v, runs): the word ranges (from, to, end exclusive) to delete from each text, sorted, without overlaps."""
    gram = min(gram, min_words)
    window = min_words - gram + 1
    keyed = _keyed(documents, id_col, text_col)
    found = save(fingerprints(keyed.select("d", "v", _hashes(F.col("t")).alias("ws")), window, gram), "prints")
    shifts = matches(found, "grams")
    asked = shifts.select("d", "v").unionByName(shifts.select(F.col("d0").alias("d"), F.col("v0").alias("v"))).distinct()
    asked = keyed.join(asked, ["d", "v"], "left_semi").dropDuplicates(["d", "v"])
    asked = save(asked.select("d", "v", _hashes(F.col("t")).alias("ws")), "asked")
    long = save(extended(shifts, asked, min_words), "long")
    # grams whose first text has too little in common around them: again, by grams that are long enough themselves
    failed = long.filter((F.size("r") == 0) & (F.col("d") != F.col("d0"))).select("d", "v").distinct()
    found = save(fingerprints(asked.join(failed, ["d", "v"], "left_semi"), window, min_words), "long-prints")
    more = extended(matches(found, "long-grams"), asked, min_words)
    long = long.unionByName(more).filter(F.size("r") > 0).groupBy("d", "v").agg(F.collect_set("r").alias("r"))
    return long.select("d", "v", _merged(F.sort_array(F.array_distinct(F.flatten("r")))).cast(_RUNS).alias("runs"))


def _without(words: Column, runs: Column) -> Column:
    """(text, lost): the words outside the runs, and the number of lines that lost words."""
    begins = F.concat(F.array(F.lit(0)), F.transform(runs, lambda r: r["to"]))
    ends = F.concat(F.transform(runs, lambda r: r["from"]), F.array(F.size(words)))
    kept = F.zip_with(begins, ends, lambda a, b: F.array_join(F.slice(words, a + 1, F.greatest(b - a, F.lit(0))), ""))
    breaks = F.array_compact(F.transform(words, lambda w, i: F.when(w.rlike(_ENDS), i)))

    def lines(at):
        line = lambda i: F.size(F.filter(at, lambda b: b < i))
        spans = F.transform(runs, lambda r: F.struct(line(r["from"]).alias("a"), line(r["to"] - 1).alias("b")))
        start = F.struct(F.lit(0).alias("n"), F.lit(-1).alias("b"))
        count = lambda s, x: F.struct((s["n"] + x["b"] - x["a"] + F.when(x["a"] == s["b"], 0).otherwise(1)).alias("n"), x["b"].alias("b"))
        return F.aggregate(spans, start, count, lambda s: s["n"])

    return F.struct(F.array_join(kept, "").alias("text"), _let(breaks, lines).alias("lost"))


def dedup_lines(documents: DataFrame, min_words: int = 20, gram: int = 12, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``documents`` with later repeats deleted from the texts, ``n_lines`` (before) and ``n_removed``."""
    runs = save(repeated_runs(documents, min_words, gram, id_col, text_col), "runs")
    runs = runs.select(F.col("d").alias("_d0"), F.col("v").alias("_v0"), F.col("runs").alias("_runs"))
    names = [c for c in documents.columns if c.lower() not in ("n_lines", "n_removed")]
    # input columns ride in a struct, so that none can clash with those used here
    x = documents.select(F.struct(*[F.col(f"`{c}`") for c in names]).alias("_row"))
    text = F.col("_row").getField(text_col).cast("string")
    x = x.select("_row", F.coalesce(F.col("_row").getField(id_col).cast("long"), F.lit(_LAST)).alias("_d"), F.xxhash64(text).alias("_v"))
    x = x.join(runs, (F.col("_d") == F.col("_d0")) & (F.col("_v") == F.col("_v0")), "left")
    new = F.when(F.col("_runs").isNotNull(), _let(_words(text, _CUT), lambda w: _without(w, F.col("_runs"))))
    lines = F.when(F.length(text) > 0, F.regexp_count(text, F.lit(_END)) + 1).otherwise(0)
    x = x.select("_row", new.alias("_new"), lines.alias("_lines"))
    kept = F.when(F.col("_new").isNotNull(), F.col("_new.text")).otherwise(text)
    return x.select(*[kept.alias(c) if c == text_col else F.col("_row").getField(c).alias(c) for c in names],
                    F.col("_lines").alias("n_lines"), F.coalesce("_new.lost", F.lit(0)).alias("n_removed"))
