"""Document fingerprints: invertible Bloom lookup sketches of paragraph digests.

A text's paragraphs (lines, sentences within them, and those of more than ``UNIT`` bytes
cut after each word whose hash is 0 modulo ``STEP``) are hashed to 40-bit digests;
with a 24-bit check they make one 64-bit value each. The distinct values are dealt
by digest bits to shards of about ``SHARD`` values, and each shard is a lookup table
of 3 x ``CELLS`` cells: a value goes to one cell of each third, and a cell is the XOR of
its values. The fingerprint is the list of cells, in hex; equal texts have equal ones.

Two sketches are subtracted cell by cell (XOR; the one with more shards is folded
to the other's number first), which leaves a sketch of the paragraphs that only one of
them has. Peeling recovers these: a cell whose check fits holds a single value, which
is taken out of its other cells, round by round, until all cells are zero. A shard
that does not peel out is built again with four times the cells, as four shards dealt
by further digest bits, up to ``LEVELS`` times; what is left then is compared value by
value. With D recovered values of sets of a and b values, the likeness is the
Jaccard similarity (a + b - D) / (a + b + D).

``with_next`` pairs each document with the one of the next greater id, without one
global sort: ids are cut at quantiles into ranges, each range is one window, and the
first row of the following range is added to each. Only ranges' borders (at most
``ranges`` numbers) are on the driver.

All is built-in functions; each row is sketched and compared where it stands.

Defined cases: a null text is empty; an empty text has no paragraphs, likeness 1 with
an empty one and 0 with any other; rows with a null id come first; rows of one id are
ordered by a hash of their texts; a single row is its own next.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from starwash.llm.common import text_or_empty

#: a line's end, with the white space behind it; and the character that marks it
_END, _MARK = "(?:\\n|[.?!] )\\s*+(?=\\S)", "\uffff"
_WHITE = " \n\r\t\x0b\f"
#: scripts without spaces, and the cuts between words, with the white space kept
_DENSE = "[\\p{IsHan}\\p{IsHiragana}\\p{IsKatakana}\\p{IsThai}\\p{IsLao}\\p{IsKhmer}\\p{IsMyanmar}\\p{IsTibetan}]"
_AFTER = f"(?<=[^\\x00-\\u0dff])(?<={_DENSE})(?=\\S)"  # one comparison sorts out most characters
_CUT = "(?<=\\s)(?=\\S)"
SHARD, CELLS, ROUNDS, LEVELS = 16, 8, 6, 5
UNIT, STEP = 200, 8
_ITEM = "array<struct<v:bigint,a:int,b:int,c:int>>"
_PLACES = list(range(CELLS))


def _let(value: Column, body) -> Column:
    """``body`` of a value that is computed once, however often ``body`` uses it."""
    return F.get(F.transform(F.array(value), body), 0)


def lines_of(text: Column) -> Column:
    cut = F.split(F.regexp_replace(text, F.lit(_END), F.lit("$0" + _MARK)), _MARK, -1)
    return F.when(F.length(text) > 0, F.when(F.contains(text, F.lit(_MARK)), F.array(text)).otherwise(cut))


def _words(line: Column, cut: str) -> Column:
    """Dense scripts need the slower pattern; lines of ASCII characters have none."""
    return F.when(F.octet_length(line) == F.char_length(line), F.split(line, cut, -1)).otherwise(F.split(line, f"{cut}|{_AFTER}", -1))


def _check(digest: Column) -> Column:
    return F.xxhash64(F.lit(9), digest).bitwiseAND(F.lit(0xFFFFFF))


def _items(values: Column) -> Column:
    """Values with their cell in each third."""
    hashed = F.transform(values, lambda v: F.struct(v.alias("v"), F.xxhash64(F.lit(3), v).alias("g")))
    place = lambda x, shift: F.shiftrightunsigned(x["g"], shift).bitwiseAND(F.lit(CELLS - 1)).cast("int")
    return F.transform(hashed, lambda x: F.struct(x["v"].alias("v"), place(x, 0).alias("a"), place(x, 16).alias("b"), place(x, 32).alias("c")))


def _units(line: Column) -> Column:
    """A long line in pieces that end at words chosen by their hashes, so an edit changes only those near it."""
    ends = lambda w: F.hash(F.rtrim(w, F.lit(_WHITE))) % STEP == 0
    marked = F.array_join(F.transform(_words(line, _CUT), lambda w: F.when(ends(w), F.concat(w, F.lit(_MARK))).otherwise(w)), "")
    return F.when(F.octet_length(line) > UNIT, F.filter(F.split(marked, _MARK, -1), lambda p: p != "")).otherwise(F.array(line))


def paragraph_items(text: Column) -> Column:
    """Distinct 64-bit values (digest and check) of a text's paragraphs, with their cells."""
    pieces = F.flatten(F.transform(F.coalesce(lines_of(text), F.array().cast("array<string>")), _units))
    digests = F.transform(pieces, lambda p: F.xxhash64(F.rtrim(p, F.lit(" \n\r\t"))).bitwiseAND(F.lit((1 << 40) - 1)))
    return _items(F.transform(F.array_distinct(digests), lambda d: F.shiftleft(d, 24).bitwiseOR(_check(d))))


def shard_count(n: Column) -> Column:
    """The power of two of shards for n values, about SHARD to each."""
    return F.pow(F.lit(2.0), F.ceil(F.log2(F.greatest(n / SHARD, F.lit(1.0))))).cast("int")


def table_of(items: Column) -> Column:
    """The cells of one shard (``items`` must be a bound value)."""
    def third(name):
        return F.transform(F.array(*map(F.lit, _PLACES)), lambda j: F.aggregate(
            items, F.lit(0).cast("long"), lambda x, it: F.when(it[name] == j, x.bitwiseXOR(it["v"])).otherwise(x)))

    return F.concat(third("a"), third("b"), third("c"))


def sketch(items: Column) -> Column:
    """One (items, table) per shard; shards are dealt by the digests' low bits."""
    def dealt(x):
        return F.transform(F.sequence(F.lit(0), x["n"] - 1), lambda s: F.filter(
            x["i"], lambda it: F.shiftrightunsigned(it["v"], 24).bitwiseAND(x["m"]) == s))

    bound = _let(items, lambda i: F.struct(i.alias("i"), shard_count(F.size(i)).alias("n"), (shard_count(F.size(i)) - 1).cast("long").alias("m")))
    return F.transform(_let(bound, dealt), lambda i: F.struct(i.alias("i"), table_of(i).alias("t")))


def _xor(x: Column, y: Column) -> Column:
    return F.zip_with(x, y, lambda a, b: a.bitwiseXOR(b))


def _folded(sketched: Column, n: Column) -> Column:
    """A sketch of fewer shards: shards that agree modulo n are added up."""
    def one(s):
        parts = F.filter(sketched, lambda x, k: F.pmod(k, n) == s)
        return F.struct(F.flatten(F.transform(parts, lambda x: x["i"])).alias("i"),
                        F.aggregate(F.transform(parts, lambda x: x["t"]), F.array_repeat(F.lit(0).cast("long"), 3 * CELLS), _xor).alias("t"))

    return F.when(F.size(sketched) == n, sketched).otherwise(F.transform(F.sequence(F.lit(0), n - 1), one))


def peel(cells: Column) -> Column:
    """(left, pure, found): what remains of the cells (all zero if done) and the recovered values."""
    fits = lambda v: (v != 0) & (_check(F.shiftrightunsigned(v, 24)) == v.bitwiseAND(F.lit(0xFFFFFF)))
    start = F.struct(cells.alias("left"), F.array().cast(_ITEM).alias("pure"), F.array().cast("array<bigint>").alias("found"))

    def look(state):  # find single values
        pure = _items(F.array_distinct(F.filter(state["left"], fits)))
        return F.struct(state["left"].alias("left"), pure.alias("pure"), state["found"].alias("found"))

    def take(state):  # take them out of their cells
        return F.struct(_xor(state["left"], table_of(state["pure"])).alias("left"), F.array().cast(_ITEM).alias("pure"),
                        F.concat(state["found"], F.transform(state["pure"], lambda p: p["v"])).alias("found"))

    turns = F.array(*[F.lit(k % 2 == 0) for k in range(2 * ROUNDS)])
    return F.aggregate(turns, start, lambda state, looking: F.when(
        looking, F.when(F.exists(state["left"], lambda c: c != 0), look(state)).otherwise(state)).when(
        F.size(state["pure"]) > 0, take(state)).otherwise(state))


def _differing(x: Column, y: Column, tx: Column, ty: Column, level: int = 0) -> Column:
    """Number of values that only one of two shards has, by peeling, retrying larger."""
    if level == LEVELS:
        values = lambda s: F.transform(s, lambda it: it["v"])
        larger = F.size(F.array_except(values(x), values(y))) + F.size(F.array_except(values(y), values(x)))
    else:
        part = lambda s, k: F.filter(s, lambda it: F.shiftrightunsigned(it["v"], 62 - 2 * level).bitwiseAND(F.lit(3)) == k)
        larger = F.aggregate(
            F.transform(F.transform(F.array(*map(F.lit, range(4))), lambda k: F.struct(part(x, k).alias("x"), part(y, k).alias("y"))),
                        lambda s: _differing(s["x"], s["y"], table_of(s["x"]), table_of(s["y"]), level + 1)),
            F.lit(0), lambda a, d: a + d)
    return _let(peel(_xor(tx, ty)), lambda r: F.when(F.forall(r["left"], lambda c: c == 0), F.size(r["found"])).otherwise(larger))


def likeness(x: Column, y: Column) -> Column:
    """Jaccard similarity of two texts' paragraph values, from their sketches."""
    def values(s):
        return F.aggregate(F.transform(s, lambda p: F.size(p["i"])), F.lit(0), lambda a, n: a + n)

    def compare(p):
        pairs = F.zip_with(_folded(p["x"], p["n"]), _folded(p["y"], p["n"]), lambda a, b: F.struct(a.alias("a"), b.alias("b")))
        differ = F.aggregate(F.transform(pairs, lambda s: _differing(s["a"]["i"], s["b"]["i"], s["a"]["t"], s["b"]["t"])), F.lit(0), lambda a, d: a + d)
        return _let(F.struct(differ.alias("d"), (values(p["x"]) + values(p["y"])).alias("n")),
                    lambda r: F.when(r["n"] == 0, 1.0).otherwise((r["n"] - r["d"]) / (r["n"] + r["d"])))

    return _let(F.struct(x.alias("x"), y.alias("y"), F.least(F.size(x), F.size(y)).alias("n")), compare)


def fingerprint(sketched: Column) -> Column:
    """The sketch's cells in hex, shard by shard."""
    return F.array_join(F.transform(sketched, lambda s: F.array_join(F.transform(s["t"], lambda c: F.lpad(F.hex(c), 16, "0")), "")), "")


def with_next(documents: DataFrame, ranges: int = 4096, range_rows: int = 4096, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, text, next_text): each row with the text of the row after it by id, the last with the first."""
    rows = documents.select(F.col(id_col).cast("long").alias("doc_id"), text_or_empty(text_col).alias("text"))
    wanted = min(ranges, max(1, -(-rows.count() // range_rows)))
    cuts = rows.agg(F.percentile_approx("doc_id", [k / wanted for k in range(1, wanted)] or [0.5], 10 * wanted).alias("c")).first()["c"]
    cuts = sorted(set(cuts or []))
    steps = [1 << k for k in reversed(range(max(1, len(cuts)).bit_length()))]
    border = F.array(*[F.lit(c) for c in cuts] or [F.lit(0)])
    # binary search: the number of borders below the id
    found = F.aggregate(F.array(*[F.lit(s) for s in steps]), F.lit(0),
                        lambda at, s: F.when(F.get(border, at + s - 1) < F.col("doc_id"), at + s).otherwise(at))
    in_range = F.when(F.col("doc_id").isNull(), -1).otherwise(found)
    rows = rows.withColumn("r", in_range)
    # at most ranges + 2 rows: each range with its first id, and the range before it (the last one, for the first)
    heads = rows.groupBy("r").agg(F.min("doc_id").alias("i"))
    heads = heads.select("i", F.col("r").alias("head"), F.coalesce(
        F.lag("r").over(W.orderBy("r")), F.max("r").over(W.orderBy("r").rowsBetween(W.unboundedPreceding, W.unboundedFollowing))).alias("before"))
    head = rows.join(F.broadcast(heads), F.col("doc_id").eqNullSafe(F.col("i")) & (F.col("r") == F.col("head")))
    head = head.groupBy("before").agg(F.min(F.struct(F.xxhash64("text").alias("h"), "text")).alias("x"))
    added = head.select(F.lit(None).cast("long").alias("doc_id"), F.col("x.text").alias("text"), F.col("before").alias("r"), F.lit(1).alias("last"))
    every = rows.withColumn("last", F.lit(0)).unionByName(added)
    following = F.lead("text").over(W.partitionBy("r").orderBy("last", F.col("doc_id").asc_nulls_first(), F.xxhash64("text")))
    return every.withColumn("next_text", following).filter("last = 0").select("doc_id", "text", "next_text")


def edited(text: Column, following: Column) -> Column:
    """The text with its last quarter replaced by as much of the following text's beginning."""
    quarter = F.floor(F.length(text) / 4).cast("int")
    return F.concat(F.substring(text, F.lit(1), F.length(text) - quarter), F.substring(following, F.lit(1), quarter))


def fingerprints(documents: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: fingerprints of the text and its edited text, and their likenesses."""
    rows = with_next(documents, id_col=id_col, text_col=text_col).withColumn("edited", edited(F.col("text"), F.col("next_text")))
    rows = rows.select("doc_id", F.length("text").cast("long").alias("n_chars"), F.sha2("edited", 256).alias("edited_sha256"),
                       *[sketch(paragraph_items(F.col(c))).alias(n) for c, n in (("text", "t"), ("edited", "e"), ("next_text", "n"))])
    return rows.select("doc_id", "n_chars", "edited_sha256", fingerprint(F.col("t")).alias("fingerprint"),
                       fingerprint(F.col("e")).alias("edited_fingerprint"),
                       likeness(F.col("t"), F.col("e")).alias("near_edited"), likeness(F.col("t"), F.col("n")).alias("near_next"))
